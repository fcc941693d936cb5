"""Near duplicates by SimHash, linked through deletion-variant signatures.

A fingerprint of 64 bits is cut into three segments. Two fingerprints that differ in
at most four bits differ in at most one bit in some segment, since two in each would be
six. So each segment is indexed with each of its bits left out in turn: 64 keys per
fingerprint, and an equality join on a key meets every pair within the distance. A
distance of the whole fingerprints verifies what meets.

Exact copies share a fingerprint and enter the index once. Fingerprints that meet under
a key are not all paired: a bucket first links each member to its most frequent member and
to its neighbour. That is all there is to link in a bucket of up to three. In larger buckets,
only members that the links so far leave in different components are compared, and any pair
in distance joins these. No link between components is lost, and a dense group of k
near copies costs about 64 k links instead of k squared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepstream.llm.cache import give_back
from stepstream.llm.components import connected_components
from stepstream.llm.tables import settled

SHINGLE = 4
SEED = 42
DISTANCE = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # lowest bit, bits
_PAIRED_BY_STAR = 3  # members of a bucket up to which star and neighbour links are all pairs
_AT_ONCE = 1 << 14  # shingles whose bits are unpacked at a time


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text as a signed 64-bit integer; 0 for a text without words."""
    words = (text or b"").lower().split()  # both touch ASCII only
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = ends - [len(w) for w in words]
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
        hashes = [digest(joined[a:b], SEED) for a, b in spans]
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _AT_ONCE):
        part = np.array(hashes[i : i + _AT_ONCE], dtype=">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprint_column(text: Column) -> Column:
    @F.pandas_udf("bigint")
    def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield batch.map(fingerprint).astype("int64")
        give_back()

    return fingerprints(text.cast("binary"))


def hex_fingerprint(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _distance(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _signatures(value: Column) -> Column:
    """One integer per left-out bit: the bit's number, and the rest of its segment."""
    keys = []
    for low, bits in SEGMENTS:
        segment = F.shiftrightunsigned(value, low).bitwiseAND((1 << bits) - 1)
        for j in range(bits):
            rest = segment.bitwiseAND(((1 << bits) - 1) ^ (1 << j))
            keys.append(rest.bitwiseOR((low + j) << 22).cast("int"))
    return F.array(*keys)


def link_fingerprints(prints: DataFrame) -> DataFrame:
    """``node, component`` of the fingerprints that have a partner; ``prints`` is ``fp, n`` with distinct ``fp``."""
    keyed = prints.select("fp", "n", F.explode(_signatures(F.col("fp"))).alias("key"))
    in_bucket = Window.partitionBy("key")
    ordered = in_bucket.orderBy(F.desc("n"), "fp")
    met = keyed.select(
        "key",
        "fp",
        F.first("fp").over(ordered).alias("centre"),
        F.lag("fp").over(ordered).alias("neighbour"),
        F.count("*").over(in_bucket).alias("members"),
    )
    met = met.withColumns(
        {
            name: F.when((_distance("fp", name) <= DISTANCE) & (F.col("fp") != F.col(name)), F.col(name))
            for name in ("centre", "neighbour")
        }
    )
    large = F.col("members") > _PAIRED_BY_STAR
    met = settled(met.where(large | F.col("centre").isNotNull() | F.col("neighbour").isNotNull()))
    centres, neighbours = (
        met.where(F.col(name).isNotNull()).select(F.col("fp").alias("a"), F.col(name).alias("b")).distinct()
        for name in ("centre", "neighbour")
    )
    starred = settled(centres.unionByName(neighbours))
    found = settled(connected_components(starred))
    # What star and neighbour links left apart in the larger buckets.
    rest = met.where(large).select("key", "fp").join(found.withColumnRenamed("node", "fp"), "fp", "left")
    rest = rest.select("key", "fp", F.coalesce("component", "fp").alias("component"))
    left = rest.select("key", F.col("fp").alias("fa"), F.col("component").alias("a"))
    right = rest.select("key", F.col("fp").alias("fb"), F.col("component").alias("b"))
    apart = (F.col("fa") < F.col("fb")) & (F.col("a") != F.col("b")) & (_distance("fa", "fb") <= DISTANCE)
    bridges = settled(left.join(right, (left["key"] == right["key"]) & apart).select("a", "b").distinct())
    if bridges.isEmpty():
        return found
    edges = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(bridges)
    return connected_components(edges)


def near_duplicates(docs: DataFrame, *keep: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's ``id``, the columns ``keep``, ``fp`` and ``component_id``, the smallest id of its near duplicates.

    A NULL text counts as empty; all texts without words have fingerprint 0 and are
    linked like others. A NULL id is larger than any other: a component has it only
    if all its ids are NULL. Repeated rows are linked as copies. Columns other than
    ``id``, ``text`` and ``keep`` are not looked at. ``component``, the smallest linked
    fingerprint, tells groups apart that have no id.
    """
    prints = settled(docs.select(id, *keep, fingerprint_column(F.col(text)).alias("fp")))
    distinct = settled(prints.groupBy("fp").agg(F.count("*").alias("n"), F.min(id).alias("least")))
    linked = link_fingerprints(distinct.select("fp", "n")).withColumnRenamed("node", "fp")
    placed = distinct.join(linked, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return prints.join(placed.join(smallest, "component").select("fp", "component", "component_id"), "fp")


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that with the smallest id.

    Among rows with that id the smallest hash of the text decides, and repeated rows
    are one. A group whose ids are all NULL keeps one row as well.
    """
    itself = F.struct(F.col(id), F.xxhash64(text).alias("text_hash"))
    grouped = near_duplicates(docs.select(id, text, itself.alias("_itself")), "_itself", id=id, text=text)
    first = F.min(F.struct(F.col(id).isNull(), F.col("_itself"))).alias("first")
    kept = grouped.groupBy("component").agg(first).select("first._itself")
    own = docs.select(F.struct("*").alias("_row"), itself.alias("_itself"))  # structs compare with NULL equal to NULL
    return own.join(kept, "_itself", "left_semi").dropDuplicates(["_itself"]).select("_row.*")
