"""Mixing sources to target weights, by fitting a budget of words from documents of known length.

For each source, documents are counted by exact length. Whole copies of the source go in
while they fit; of what the target then still asks for, each length first gives its share
of documents, rounded down. A bounded knapsack over the lengths that are left fills the
rest to the word, if any choice of lengths can. Which documents of a length are
taken is drawn by a seeded hash of their id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stepstream.llm.tables import settled
from stepstream.llm.words import word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5  # of all words
MOST_COPIES = 2
SEED = 42
KNAPSACK_WORDS = 1 << 16
BUCKETS = 256  # parts of the documents of one source and length that are drawn from one by one
_MIX = ("_source", "_size", "_bucket")


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_COPIES
) -> DataFrame:
    """``source, source_size, target`` of ``sizes (source, source_size)``, which has a row for each source.

    Sources in code point order, NULL last, have the weights in turn. A source's target is its
    weight times one level, at most ``most`` times its size; the level is where all targets
    add up to ``share`` of all sizes. Sources by rising limit per weight: up to some
    source all are at their limit, and the rest share what is left.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1) % len(weights)
    weight = F.get(F.array(*map(F.lit, weights)), turn)
    limited = sizes.withColumns({"weight": weight, "limit": F.col("source_size") * F.lit(float(most))})
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    full_before = F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight_left = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    levels = limited.withColumns({"fills_at": F.col("limit") / F.col("weight"), "order": F.row_number().over(by_limit)})
    # The level if this source and all after it shared what is left: true for the first that it does not fill.
    shared = F.when((total - full_before) / weight_left <= F.col("fills_at"), (total - full_before) / weight_left)
    levels = levels.withColumn("level", shared)
    level = F.min(F.when(F.col("level").isNotNull(), F.struct("order", "level"))).over(Window.partitionBy())["level"]
    target = F.least(F.col("weight") * F.coalesce(level, F.col("fills_at")), F.col("limit"))
    return levels.withColumn("target", target).select("source", "source_size", "target")


def fit_lengths(sizes: np.ndarray, counts: np.ndarray, target: float) -> tuple[int, np.ndarray]:
    """Whole copies of all, and how many of each size to take once more, for a total next to ``target``.

    ``sizes`` are distinct and ``counts`` say how many there are of each. The shares rounded
    down leave less than one document of each size. If that is much, large sizes fill in first;
    the last ``KNAPSACK_WORDS``, or the length of the longest document, are left to the knapsack.
    """
    sizes, counts = np.asarray(sizes, dtype=np.int64), np.asarray(counts, dtype=np.int64)
    extra = np.zeros(len(sizes), dtype=np.int64)
    whole = int((sizes * counts).sum())
    if not whole or target <= 0:
        return 0, extra
    copies = int(target // whole)
    wanted = round(target - copies * whole)
    extra = np.floor(counts * (wanted / whole)).astype(np.int64)
    extra = np.minimum(extra, counts)
    left = wanted - int((extra * sizes).sum())
    for i in np.argsort(-sizes, kind="stable"):
        spare = left - max(KNAPSACK_WORDS, int(sizes.max()))  # the rest is for the knapsack
        if spare < sizes[i] or not sizes[i]:
            continue
        more = min(int(counts[i] - extra[i]), spare // int(sizes[i]))
        extra[i] += more
        left -= more * int(sizes[i])
    for i, more in _knapsack(sizes, counts - extra, left).items():
        extra[i] += more
    return copies, extra


def _knapsack(sizes, spare, budget) -> dict[int, int]:
    """How many of each size add up to ``budget``, or to the most below it, at most ``spare`` of each.

    The sums in reach are the bits of one integer. Counts are cut into powers of two, so each
    chunk is used or not; the first chunk that reaches a sum tells the way back.
    """
    if budget <= 0:
        return {}
    mask, reach = (1 << (budget + 1)) - 1, 1
    chunk_of = np.full(budget + 1, -1, dtype=np.int64)
    chunks = []
    for i in np.argsort(-sizes, kind="stable"):
        size, left, power = int(sizes[i]), min(int(spare[i]), budget // max(int(sizes[i]), 1)), 1
        while left > 0 and size and not reach >> budget:
            many = min(power, left)
            left, power = left - many, power * 2
            new = (reach << (many * size)) & mask & ~reach
            if new:
                reach |= new
                bits = np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8)
                chunk_of[np.flatnonzero(np.unpackbits(bits, bitorder="little")[: budget + 1])] = len(chunks)
                chunks.append((int(i), many, many * size))
    best, taken = reach.bit_length() - 1, {}
    while best:
        i, many, words = chunks[chunk_of[best]]
        taken[i] = taken.get(i, 0) + many
        best -= words
    return taken


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with ``size``, ``source_size``, ``target`` and ``copies`` (0, 1 or 2).

    ``size`` is the number of words of the text, 0 for NULL. NULL is a source of its own.
    Rows are drawn by a hash of their id, NULL ids too; rows of the same id, source and size
    are drawn in any order, and if they are repeated rows that makes no difference. A source
    without words has target 0. An empty table gives no rows. In the struct, no other column of
    ``docs`` can clash with a name used here.
    """
    drawn_by = F.xxhash64(F.col(id), F.lit(SEED))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id).alias("_id"),
        F.struct(F.col(source).alias("source")).alias("_source"),  # structs compare with NULL equal to NULL
        word_count(F.col(text)).alias("_size"),
        F.pmod(drawn_by, F.lit(BUCKETS)).cast("int").alias("_bucket"),
    )
    counts = settled(rows.groupBy(*_MIX).count())
    lengths = counts.groupBy("_source", "_size").agg(F.sum("count").alias("n"))
    sizes = lengths.groupBy("_source").agg(F.sum(F.col("_size") * F.col("n")).alias("source_size"))
    sizes = sizes.select("_source.source", "source_size")
    targets = settled(source_targets(sizes, **options).withColumn("_source", F.struct("source")))
    fitted = settled(
        lengths.join(targets, "_source")
        .groupBy("_source")
        .applyInPandas(_fit, _fit_schema(counts))
        .join(targets.select("_source", "source_size", "target"), "_source")
    )
    # Buckets of a length fill one after the other; only in the last is it drawn who comes in.
    in_turn = Window.partitionBy("_source", "_size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.coalesce(F.sum("count").over(in_turn), F.lit(0)))
    quota = F.greatest(F.lit(0), F.least(F.col("count"), F.col("extra") - F.col("before")))
    quotas = before.join(fitted, ["_source", "_size"]).select(
        *_MIX, "source_size", "target", "whole", quota.alias("quota"), F.col("count").alias("members")
    )
    placed = rows.join(quotas, list(_MIX))
    rank = F.row_number().over(Window.partitionBy(*_MIX).orderBy(F.xxhash64("_id", F.lit(SEED + 1)), "_id"))
    copies = F.col("whole") + (rank <= F.col("quota")).cast("int")
    return placed.select("row", F.col("_size").alias("size"), "source_size", "target", copies.alias("copies"))


def _fit_schema(counts):
    kind = counts.schema["_source"].dataType.simpleString()
    return f"_source {kind}, _size bigint, whole int, extra bigint"


def _fit(lengths: pd.DataFrame) -> pd.DataFrame:
    """One source: a row for each length of its documents."""
    lengths = lengths.sort_values("_size")
    copies, extra = fit_lengths(lengths["_size"].to_numpy(), lengths["n"].to_numpy(), lengths["target"].iloc[0])
    return lengths[["_source", "_size"]].assign(whole=copies, extra=extra)


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it has copies."""
    mixed = mix(docs, **options).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
