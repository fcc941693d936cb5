"""Benchmark passages in documents, by SimHash of item-sized windows.

An item of n shingles is looked for in every window of n shingles of a document (of the whole
document, if that is shorter). Both have a SimHash fingerprint of 128 bits, cut into 16
blocks of 8. Fingerprints that differ in at most 31 bits differ in at most one bit in some
block, so an index of the items' blocks and of each of their one-bit variants meets
all of them. What meets within this distance is verified by the exact weighted
similarity: shingles shared, counted as often as both have them, over those of either.

A window without any shingle of an item of its size has similarity 0 to all of them, so
only windows that have one are fingerprinted. Similarity 0.8 makes two fingerprints
differ in 18 bits on average, with a standard deviation of 4.

All of it is DataFrame work. Benchmark shingles and the item index are broadcast up to a
counted size and shuffled beyond it; documents never are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepstream.llm.tables import settled
from stepstream.llm.words import word_array

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS = 16, 8
DISTANCE = 2 * BLOCKS - 1
BROADCAST_ROWS = 500_000  # rows of up to 40 bytes
_FP = ("fp_1", "fp_2")  # the halves of a fingerprint
_LANES = 0x0000000100000001  # two counters of 32 bits
_LANE_TOP = 30  # the highest bit that a counter may reach


def _hashed(rows: DataFrame, *keep: str, text: str) -> DataFrame:
    """``keep`` and ``hashes``, a hash for each shingle of a text: five words without regard to case, or all if fewer."""
    words = rows.select(*keep, word_array(F.lower(text)).alias("_words"))
    coded = words.select(*keep, F.transform("_words", lambda w: F.xxhash64(w)).alias("_coded"))
    starts = F.sequence(F.lit(0), F.size("_coded") - SHINGLE)
    many = F.transform(starts, lambda i: F.xxhash64(*[F.get("_coded", i + j) for j in range(SHINGLE)]))
    one = F.when(F.size("_coded") > 0, F.array(F.xxhash64("_coded"))).otherwise(F.array().cast("array<bigint>"))
    return coded.select(*keep, F.when(F.size("_coded") >= SHINGLE, many).otherwise(one).alias("hashes"))


def _small(df: DataFrame) -> DataFrame:
    """A settled table, marked for broadcast if it is counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _fingerprints(windows: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``width`` and the halves of the fingerprint of ``windows (keys, window)``.

    Each bit is set in over half of the shingle hashes. The counts of two bits share one sum.
    """
    exploded = windows.select(*keys, F.explode("window").alias("h"))
    exploded = exploded.withColumn("h2", F.xxhash64(F.lit(1), "h"))
    sums = [
        F.sum(F.shiftrightunsigned(half, i).bitwiseAND(_LANES)).alias(f"{half}_{i}")
        for half in ("h", "h2")
        for i in range(32)
    ]
    counted = exploded.groupBy(*keys).agg(F.count("*").alias("width"), *sums)
    # Lifts a count above half of the width, and no other, to the top bit of its lane.
    lift = (F.lit((1 << _LANE_TOP) - 1) - F.expr("width div 2")) * F.lit(_LANES)
    counted = counted.withColumn("lift", lift)
    fp = []
    for half in ("h", "h2"):
        lifted = [(F.col(f"{half}_{i}") + F.col("lift")).bitwiseAND(_LANES << _LANE_TOP) for i in range(32)]
        *most, last = [F.shiftrightunsigned(top, max(0, _LANE_TOP - i)) for i, top in enumerate(lifted)]
        fp.append(reduce(Column.bitwiseOR, most, F.shiftleft(last, 1)))
    return counted.select(*keys, "width", *[half.alias(name) for name, half in zip(_FP, fp)])


def _blocks() -> Column:
    half = 64 // BLOCK_BITS
    return F.array(
        *[
            F.shiftrightunsigned(_FP[i // half], i % half * BLOCK_BITS).bitwiseAND((1 << BLOCK_BITS) - 1).cast("int")
            for i in range(BLOCKS)
        ]
    )


def _distance() -> Column:
    first, second = (F.bit_count(F.col(name).bitwiseXOR(F.col(f"item_{name}"))) for name in _FP)
    return first + second


def _index(items: DataFrame) -> DataFrame:
    """Each block of the items' fingerprints, as it is and with each of its bits changed."""
    changes = F.array(F.lit(0), *[F.lit(1 << j) for j in range(BLOCK_BITS)])
    own = [F.col(name).alias(f"item_{name}") for name in _FP]
    blocks = items.select("_item", "size", *own, F.posexplode(_blocks()).alias("block", "value"))
    changed = blocks.withColumn("change", F.explode(changes))
    value = F.col("value").bitwiseXOR(F.col("change")).alias("value")
    return changed.select("_item", "size", *[f"item_{name}" for name in _FP], "block", value)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc, item, similarity, start, width``: each item found in a document, with its most similar window.

    ``doc`` is a struct of the id and a hash of the text, and ``item`` likewise, so NULL ids
    and ids that name several texts are told apart. Repeated rows are one document, or one item.
    ``start`` and ``width`` count shingles (words, but for the last four); of windows
    equally similar the first is given. Texts and items without words match nothing.
    An item of fewer than five words is one shingle and is found only in a document
    that is this shingle alone. Other columns are not looked at.
    """
    doc = F.struct(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"))
    item = F.struct(F.col(item_id).alias("id"), F.xxhash64(item_text).alias("text_hash"))
    texts = docs.select(doc.alias("_doc"), F.col(text).alias("_text"))
    sought = benchmark.select(item.alias("_item"), F.col(item_text).alias("_text")).dropDuplicates(["_item"])
    sought = settled(_hashed(sought, "_item", text="_text").withColumn("size", F.size("hashes"))).where("size > 0")
    counts = settled(sought.select("_item", "size", F.explode("hashes").alias("h")).groupBy("_item", "size", "h").count())
    sizes = settled(counts.select("h", "size").distinct())

    at = _hashed(texts, "_doc", text="_text")
    # An outer explode, since for an inner one Spark would hash the array once more to drop empty ones early.
    at = at.select("_doc", F.size("hashes").alias("length"), F.posexplode_outer("hashes").alias("pos", "h"))
    anchors = settled(at.join(_small(sizes), "h").select("_doc", "length", "pos", "size").distinct())
    windows = settled(_windows(anchors, texts))
    fps = _fingerprints(windows.select("_doc", "size", "start", "window"), "_doc", "size", "start")
    item_fps = _fingerprints(sought.select("_item", "size", F.col("hashes").alias("window")), "_item", "size")
    index = _small(settled(_index(item_fps)))
    probes = fps.select("_doc", "size", "start", "width", *_FP, F.posexplode(_blocks()).alias("block", "value"))
    met = (probes["size"] == index["size"]) & (probes["block"] == index["block"]) & (probes["value"] == index["value"])
    near = probes.join(index, met & (_distance() <= DISTANCE))
    near = settled(near.select("_doc", probes["size"], "start", "width", "_item").distinct())
    return _verified(near, windows, counts, similarity)


def _windows(anchors: DataFrame, texts: DataFrame) -> DataFrame:
    """``_doc, size, start, window``: every window with a shingle of an item of that size.

    A window belongs to the first such shingle in it, so it is made once.
    """
    width = F.least("size", "length")
    before = F.lag("pos").over(Window.partitionBy("_doc", "size").orderBy("pos"))
    first = F.greatest(F.coalesce(before + 1, F.lit(0)), F.col("pos") - width + 1)
    last = F.least(F.col("pos"), F.col("length") - width)
    starts = anchors.select("_doc", "size", first.alias("first"), last.alias("last"), width.alias("width"))
    starts = starts.where("first <= last")
    spans = starts.groupBy("_doc").agg(F.collect_list(F.struct("size", "first", "last", "width")).alias("spans"))
    found = texts.join(spans.hint("shuffle_hash"), "_doc")
    found = _hashed(found, "_doc", "spans", text="_text").dropDuplicates(["_doc"])
    cut = found.select("_doc", "hashes", F.explode_outer("spans").alias("s"))
    starts = F.explode_outer(F.sequence("s.first", "s.last")).alias("start")
    cut = cut.select("_doc", "s.size", "s.width", "hashes", starts)
    return cut.select("_doc", "size", "start", F.slice("hashes", F.col("start") + 1, F.col("width")).alias("window"))


def _verified(near: DataFrame, windows: DataFrame, counts: DataFrame, similarity: float) -> DataFrame:
    shingles = near.join(windows, ["_doc", "size", "start"])
    shingles = shingles.select("_doc", "_item", "size", "start", "width", F.explode("window").alias("h"))
    own = shingles.groupBy("_doc", "_item", "size", "start", "width", "h").count()
    items = _small(counts.select("_item", "h", F.col("count").alias("item_count")))
    shared = own.join(items, ["_item", "h"]).groupBy("_doc", "_item", "size", "start", "width")
    shared = shared.agg(F.sum(F.least("count", "item_count")).alias("shared"))
    alike = shared.withColumn("similarity", F.col("shared") / (F.col("size") + F.col("width") - F.col("shared")))
    best = F.min(F.struct((-F.col("similarity")).alias("rank"), "start", "width")).alias("best")
    found = alike.where(F.col("similarity") >= similarity).groupBy("_doc", "_item").agg(best)
    return found.select(
        F.col("_doc").alias("doc"),
        F.col("_item").alias("item"),
        (-F.col("best.rank")).alias("similarity"),
        F.col("best.start").alias("start"),
        F.col("best.width").alias("width"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows in which :func:`find_passages` finds an item."""
    id, text = options.get("id", "doc_id"), options.get("text", "text")
    found = find_passages(docs, benchmark, **options).select(F.col("doc").alias("_doc")).distinct()
    doc = F.struct(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"))
    own = docs.select(F.struct("*").alias("_row"), doc.alias("_doc"))
    return own.join(found.hint("shuffle_hash"), "_doc", "left_anti").select("_row.*")
