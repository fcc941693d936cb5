"""Removes every byte that lies in a string of 200 bytes which starts somewhere else as well.

Strings that are equal have the same least hash among their runs of 32 bytes (grams). So each text is cut into
stretches of consecutive strings with the same least hash, and only stretches whose hash occurs again, in any text, can hold a
repeated string, or those that have one twice themselves, as a run of one character does; the rest is settled by counting hashes.
Of the stretches left, equal ones with equal bytes around are repeated as a whole and need no look at their texts.

What differs is compared in full. The distinct stretches, each with the bytes of all its strings, are dealt into shards by their hash.
A shard sorts all suffixes of its bytes by Larsson and Sadakane's refinement: sorted by
eight bytes first, then groups of equal rank are sorted by the rank of what follows, which doubles the length
compared; groups of one are left alone. Kasai's rule gives the common prefixes of neighbours, for all
stretches side by side. A string is repeated where a neighbour shares 200 bytes.

A hash with very many distinct stretches, such as a common line in different surroundings, is spread over several
shards. Each gives a sorted list of digests of its distinct strings, cut into ranges; the lists of a range are merged by binary search,
and a digest that is found in two shards marks its strings in both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepstream.llm.tables import settled
from stepstream.workspace import new_dir

STRING = 200  # bytes
GRAM = 32
GRAMS = STRING - GRAM + 1  # in a string
SHARD_BYTES = 1 << 20
SPREAD_FROM = 4096  # distinct stretches of a hash that one shard takes
MERGED = 1 << 18  # digests merged at a time, on average
BROADCAST_SPANS = 1_000_000  # removed runs, and texts that have some, of 16 bytes
_AT_ONCE = 1 << 20  # strings of a text hashed at a time
_TEXTS_KNOWN = 1 << 16  # that a task remembers to have met
_ROWS_AT_ONCE = 1 << 13
_MIXED_BY = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]  # odd numbers that mix bits well
_STRETCHES = "hash bigint, same bigint, text_id bigint, size int, first int, strings int, twice boolean"
_PIECES = "shard int, hash bigint, same bigint, spread int, piece binary"
_FOUND = "hash bigint, same bigint, first int, last int, part int, digests binary, owners binary, places binary"


def gram_hashes(text: bytes) -> np.ndarray:
    """A hash of each run of 32 bytes, put together from those of 8 and 16."""
    eights = np.ndarray((len(text) - 7,), dtype="<u8", buffer=text, strides=(1,))
    hashes = eights * _MIXED_BY[0]
    for step, by in zip((8, 16), _MIXED_BY[1:]):
        hashes ^= hashes >> np.uint64(29)
        hashes *= by
        hashes ^= hashes >> np.uint64(32)
        hashes = hashes[:-step] * np.uint64(step + 1) + hashes[step:]
    hashes ^= hashes >> np.uint64(30)
    return hashes


def _least_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(hashes)
    rows = np.full((-(-n // width), width), np.iinfo(np.uint64).max, dtype=np.uint64)
    rows.ravel()[:n] = hashes
    up_to = np.minimum.accumulate(rows, axis=1).ravel()
    onwards = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onwards[: n - width + 1], up_to[width - 1 : n])


def stretches(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least hash, first string and number of strings of each stretch; a stretch has at most as many strings as a string has grams."""
    total, found = len(text) - STRING + 1, []
    for begin in range(0, max(total, 0), _AT_ONCE):
        part = text[begin : begin + _AT_ONCE + STRING - 1]
        least = _least_of(gram_hashes(part), GRAMS)
        first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        count = np.diff(np.append(first, len(least)))
        pieces = -(-count // GRAMS)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        cut = np.repeat(first, pieces) + nth * GRAMS
        strings = np.minimum(np.repeat(first + count, pieces) - cut, GRAMS)
        found.append((least[cut], cut + begin, strings))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _may_repeat(piece: bytes, strings: int) -> bool:
    """Whether a stretch can have a string twice. All of its strings have the run of 32 bytes at the start of the last, so it must come again."""
    shared = piece[strings - 1 : strings - 1 + GRAM]
    return piece.find(shared, strings, 2 * strings - 2 + GRAM) >= 0


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of each text. Of copies that a task meets, two are enough to know that they are repeated."""
    names = [f.split()[0] for f in _STRETCHES.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]
    met, waiting, amount = {}, [], 0

    def batch_of(rows):
        columns = [np.concatenate(column) for column in zip(*rows)]
        return pa.RecordBatch.from_arrays([pa.array(c, type=kind) for c, kind in zip(columns, kinds)], names=names)

    for batch in batches:
        for text_id, size, text in zip(*(batch[name] for name in ("text_id", "size", "text"))):
            known = text_id.as_py(), size.as_py()
            times = met.get(known, 0)
            if times > 1:
                continue
            if len(met) >= _TEXTS_KNOWN:
                met.clear()
            met[known] = times + 1
            text = text.as_py()
            hashes, first, strings = stretches(text)
            ends = (first + strings + STRING - 1).tolist()
            pieces = [text[a:b] for a, b in zip(first.tolist(), ends)]
            n = len(hashes)
            same = np.fromiter(map(xxhash.xxh3_64_intdigest, pieces), np.uint64, n).view(np.int64)
            twice = np.fromiter(map(_may_repeat, pieces, strings.tolist()), bool, n)
            waiting.append((hashes.view(np.int64), same, *(np.full(n, x) for x in known), first, strings, twice))
            amount += n
            if amount >= _ROWS_AT_ONCE:
                yield batch_of(waiting)
                waiting, amount = [], 0
    if waiting:
        yield batch_of(waiting)


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches that each text is asked for."""
    kinds = {"shard": pa.int32(), "hash": pa.int64(), "same": pa.int64(), "spread": pa.int32(), "piece": pa.binary()}
    for batch in batches:
        for text, asked in zip(batch["text"], batch["asked"]):
            text, rows = text.as_py(), asked.as_py()
            for row in rows:
                row["piece"] = text[row["first"] : row["first"] + row["strings"] + STRING - 1]
            columns = [pa.array([row[name] for row in rows], type=kind) for name, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays(columns, names=list(kinds))


class SuffixArray:
    """All suffixes of the ``pieces`` in order; a suffix ends with its piece. Equal ones stand in order of place.

    ``order`` has their places in the joined pieces, of fewer than 2^31 bytes, ``left`` how many bytes a suffix has.
    """

    def __init__(self, pieces: list[bytes]):
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.first = np.cumsum(sizes) - sizes  # place of each piece
        self.n = int(sizes.sum())
        self.left = np.repeat(self.first + sizes, sizes) - np.arange(self.n)
        joined = b"".join(pieces) + bytes(8)
        self.eights = np.ndarray((self.n + 1,), dtype=">u8", buffer=joined, strides=(1,)).astype(np.uint64)
        self._sort()

    def _sort(self) -> None:
        n, left = self.n, self.left
        beyond = (8 - np.minimum(left, 8)).astype(np.uint64) * np.uint64(8)  # bits that are no longer of the piece
        keys = (self.eights[:n] >> beyond) << beyond
        size = np.minimum(left, 8)
        order = np.argsort(keys)
        if (size < 8).any():  # zero bytes tie with those beyond the end: the shorter suffix comes first
            order = order[_runs_sorted(keys[order], size[order])]
        fresh = np.ones(n, dtype=bool)  # at the first of each group of equal rank
        fresh[1:] = (keys[order[1:]] != keys[order[:-1]]) | (size[order[1:]] != size[order[:-1]])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        depth = 8
        while True:
            at = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))  # in groups of more than one
            at = at[left[order[at]] >= depth]  # a group of suffixes that have ended is one of equals
            if not len(at):
                break
            places = order[at]
            after = np.minimum(places + depth, n - 1)
            second = np.where(left[places] > depth, rank[after] + 1, 0)
            keys = rank[places] << 32 | second
            by = np.argsort(keys)
            places, keys = places[by], keys[by]
            order[at] = places  # a group keeps its places in the order, and its members are dealt anew
            new = np.ones(len(at), dtype=bool)
            new[1:] = keys[1:] != keys[:-1]
            fresh[at] = new
            rank[places] = np.maximum.accumulate(np.where(new, at, 0))
            depth *= 2
        at = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
        order[at] = np.sort(rank[order[at]] << 32 | order[at]) & 0xFFFFFFFF  # equal ones by place
        self.order = order

    def common_prefixes(self, most: int) -> np.ndarray:
        """For each place how many bytes, up to ``most``, its suffix shares with the one before it in order.

        Kasai's rule: a place shares at most one byte less than the place before it in the text did. All pieces are gone through
        side by side, each from its start.
        """
        n, left = self.n, self.left
        before = np.full(n, -1, dtype=np.int64)
        before[self.order[1:]] = self.order[:-1]
        shared = np.zeros(n, dtype=np.int64)
        lanes, step = self.first, 0
        known = np.zeros(len(lanes), dtype=np.int64)
        while len(lanes):
            places = lanes + step
            other = before[places]
            known = np.where(other >= 0, known, 0)
            limit = np.minimum(np.minimum(left[places], np.where(other >= 0, left[other], 0)), most)
            known = np.minimum(known, limit)
            open_ = np.flatnonzero(known < limit)
            while len(open_):
                a, b = places[open_] + known[open_], other[open_] + known[open_]
                differ = self.eights[a] ^ self.eights[b]
                alike = np.where(differ == 0, 8, _leading_zero_bytes(differ))
                known[open_] = np.minimum(known[open_] + alike, limit[open_])
                open_ = open_[(alike == 8) & (known[open_] < limit[open_])]
            shared[places] = known
            step += 1
            going = left[places] > 1
            lanes, known = lanes[going], np.maximum(known[going] - 1, 0)
        return shared


def _runs_sorted(keys: np.ndarray, second: np.ndarray) -> np.ndarray:
    """How to go through sorted ``keys`` so that equal ones come by ``second``."""
    by = np.arange(len(keys))
    equal = keys[1:] == keys[:-1]
    at = np.flatnonzero(np.append(equal, False) | np.append(False, equal))
    by[at] = at[np.lexsort((second[at], keys[at]))]
    return by


def _leading_zero_bytes(values: np.ndarray) -> np.ndarray:
    found = np.zeros(len(values), dtype=np.int64)
    for bits in (32, 16, 8):
        empty = values < (np.uint64(1) << np.uint64(64 - bits))
        found += np.where(empty, bits // 8, 0)
        values = np.where(empty, values << np.uint64(bits), values)
    return found


def _intervals(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of marked places."""
    edges = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


def _sort_shard(shard: pd.DataFrame) -> pd.DataFrame:
    """Repeated strings of a shard as intervals; and for stretches of spread hashes the digests of its distinct strings."""
    shard = shard.drop_duplicates(["hash", "same"])
    pieces = shard["piece"].tolist()
    suffixes = SuffixArray(pieces)
    before = suffixes.common_prefixes(STRING) >= STRING  # as the suffix before
    order = suffixes.order
    after = np.zeros(suffixes.n, dtype=bool)
    after[order[:-1]] = before[order[1:]]
    repeated = before | after
    found = []
    for i, (key, same, piece) in enumerate(zip(shard["hash"], shard["same"], pieces)):
        begin, strings = suffixes.first[i], len(piece) - STRING + 1
        for first, last in zip(*_intervals(repeated[begin : begin + strings])):
            found.append((key, same, first, last, None, None, None, None))
    for (key, spread), rows in shard[shard["spread"] > 1].groupby(["hash", "spread"]):
        digests, owners, places = [], [], []
        for i in shard.index.get_indexer(rows.index):
            begin, piece = suffixes.first[i], pieces[i]
            # Of equal strings the first in order stands for all: they are marked here already.
            for at in np.flatnonzero(~before[begin : begin + len(piece) - STRING + 1]):
                digests.append(xxhash.xxh3_128_digest(piece[at : at + STRING]))
                owners.append(shard["same"].iat[i])
                places.append(at)
        digests, owners, places = np.array(digests, "S16"), np.array(owners, "<i8"), np.array(places, "<i4")
        by = np.argsort(digests)
        digests, owners, places = digests[by], owners[by], places[by]
        parts = max(1, spread * SPREAD_FROM * GRAMS // 2 // MERGED)
        part_of = (digests.view(">u8")[::2].astype(np.uint64) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        for part in np.unique(part_of):
            own = part_of == part
            columns = (x[own].tobytes() for x in (digests, owners, places))
            found.append((key, None, None, None, int(part), *columns))
    frame = pd.DataFrame(found, columns=[f.split()[0] for f in _FOUND.split(", ")], dtype=object)
    return frame.astype({name: "Int64" for name in ("hash", "same", "first", "last", "part")})


def _merge(lists: pd.DataFrame) -> pd.DataFrame:
    """The strings of which other lists have an equal one, found by binary search in the merged lists."""
    own = [np.frombuffer(x, "S16") for x in lists["digests"]]
    merged = np.sort(np.concatenate(own))
    found = []
    for digests, owners, places in zip(own, lists["owners"], lists["places"]):
        times = np.searchsorted(merged, digests, "right") - np.searchsorted(merged, digests, "left")
        again = times > 1
        found.append(
            pd.DataFrame({"same": np.frombuffer(owners, "<i8")[again], "first": np.frombuffer(places, "<i4")[again]})
        )
    result = pd.concat(found)
    return result.assign(hash=lists["hash"].iloc[0], last=result["first"])[["hash", "same", "first", "last"]]


def repeated_strings(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``text_id, size, starts, ends`` of the texts with repeated strings: the longest runs of bytes that these cover, in order."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id).alias("id"), F.xxhash64(text).alias("text_id"), F.octet_length(text).alias("size"), F.col(text).cast("binary").alias("text")
    ).where(F.col("size") >= STRING)
    folder = new_dir(spark, "stretches")
    texts.select("text_id", "size", "text").mapInArrow(_cut_texts, _STRETCHES).write.option("compression", "zstd").parquet(folder)
    every = spark.read.schema(_STRETCHES).parquet(folder)
    again = every.groupBy("hash").agg(F.count("*").alias("n"), F.bool_or("twice").alias("twice")).where("n > 1 or twice").select("hash")
    kept = settled(every.join(again, "hash"))

    at = F.struct("text_id", "size", "first", "strings")
    open_ = ((F.count("*") == 1) & F.bool_or("twice")).alias("open")  # classes of more are repeated as a whole
    classes = settled(kept.groupBy("hash", "same").agg(F.count("*").alias("n"), F.min(at).alias("at"), open_))
    kinds = classes.groupBy("hash").agg(F.count("*").alias("kinds"), F.bool_or("open").alias("open")).where("kinds > 1 or open")
    unlike = settled(classes.join(kinds.drop("open"), "hash").select("hash", "same", "kinds", "at.*"))
    found = _compared(texts, unlike)

    whole = classes.where("n > 1").select("hash", "same", F.array(F.struct(F.lit(0).alias("first"), (F.col("at.strings") - 1).alias("last"))).alias("marks"))
    alone = classes.where("n = 1").select("hash", "same")
    partly = found.join(alone, ["hash", "same"]).groupBy("hash", "same").agg(F.collect_set(F.struct("first", "last")).alias("marks"))
    marks = settled(whole.unionByName(partly))
    marked = kept.join(marks, ["hash", "same"]).select("text_id", "size", F.col("first").alias("at"), F.explode("marks").alias("mark"))
    start = (F.col("at") + F.col("mark.first")).alias("start")
    end = (F.col("at") + F.col("mark.last") + STRING).alias("end")
    marked = marked.select("text_id", "size", start, end)
    cover = marked.groupBy("text_id", "size").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("cover"))
    return cover.select("text_id", "size", _joined(F.col("cover")).alias("runs")).select("text_id", "size", "runs.*")


def _compared(texts: DataFrame, unlike: DataFrame) -> DataFrame:
    """``hash, same, first, last``: strings of the stretches ``unlike`` that others of the same hash have as well."""
    amount = unlike.agg(F.sum(F.col("strings") + STRING)).first()[0] or 0
    shards = max(1, -(-amount // SHARD_BYTES))
    spread = F.ceil(F.col("kinds") / SPREAD_FROM).cast("int")
    dealt = F.pmod(F.xxhash64("hash", F.pmod("same", spread)), F.lit(shards)).cast("int")
    asked = F.struct(dealt.alias("shard"), "hash", "same", spread.alias("spread"), "first", "strings")
    wanted = unlike.groupBy("text_id", "size").agg(F.collect_list(asked).alias("asked"))
    # One of the rows with that text is read, or those that share its id.
    readers = texts.groupBy("text_id", "size").agg(F.min("id").alias("reader"))
    wanted = wanted.join(readers, ["text_id", "size"]).withColumnsRenamed({"text_id": "of_id", "size": "of_size"})
    here = (F.col("text_id") == F.col("of_id")) & (F.col("size") == F.col("of_size")) & F.col("id").eqNullSafe(F.col("reader"))
    pieces = texts.join(wanted, here).select("text", "asked").mapInArrow(_cut_pieces, _PIECES)
    found = settled(pieces.groupBy("shard").applyInPandas(_sort_shard, _FOUND))
    lists = found.where("part is not null").select("hash", "part", "digests", "owners", "places")
    marks = "hash bigint, same bigint, first int, last int"
    merged = lists.groupBy("hash", "part").applyInPandas(_merge, marks)
    return found.where("part is null").select("hash", "same", "first", "last").unionByName(merged)


def _joined(cover: Column) -> Column:
    """Sorted intervals ``start, end``, joined where they overlap or touch."""

    @F.pandas_udf("starts array<int>, ends array<int>")
    def join(starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        rows = []
        for first, last in zip(starts, ends):
            reach = np.maximum.accumulate(last)
            new = np.append(True, first[1:] > reach[:-1])
            rows.append((first[new], reach[np.append(new[1:], True)]))
        return pd.DataFrame(rows, columns=["starts", "ends"])

    return join(cover["start"], cover["end"])


def _without(text: Column, starts: Column, ends: Column) -> Column:
    """The bytes outside the runs; NULL for a NULL text."""

    @F.pandas_udf("binary")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        kept = []
        for body, first, last in zip(texts, starts, ends):
            if body is not None:
                body = b"".join(body[a:b] for a, b in zip([0, *last.tolist()], [*first.tolist(), len(body)]))
            kept.append(body)
        return pd.Series(kept, dtype=object)

    return cut(text, starts, ends)


def drop_repeated_strings(docs: DataFrame, *keep: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``keep``, ``n_bytes``, ``kept`` (the bytes that stay) and ``starts`` and ``ends`` of the removed runs, of every row.

    Texts are taken as UTF-8 bytes, a NULL text as empty. Strings are judged on the input, in the same text
    too, and where they overlap. So texts of at least 200 bytes that occur twice, as repeated rows do, go whole; shorter ones never lose
    anything. Any id may be NULL or repeated. Texts are told apart by a 64-bit hash and their size. An empty table gives no rows.
    Columns other than ``keep``, ``id`` and ``text`` are not looked at.
    """
    covers = settled(repeated_strings(docs, id, text))
    rows = docs.select(
        F.struct(*keep).alias("_keep"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_text"),
        F.xxhash64(text).alias("text_id"),
        F.octet_length(F.coalesce(F.col(text), F.lit(""))).alias("size"),
    )
    if (covers.agg(F.sum(F.size("starts") + 1)).first()[0] or 0) <= BROADCAST_SPANS:
        covers = F.broadcast(covers)
    met = rows.join(covers, ["text_id", "size"], "left")
    touched = F.when(F.col("starts").isNotNull(), F.col("_text"))  # other texts do not go to Python
    nothing = F.array().cast("array<int>")
    return met.select(
        "_keep.*",
        F.col("size").cast("bigint").alias("n_bytes"),
        F.coalesce(_without(touched, F.col("starts"), F.col("ends")), "_text").alias("kept"),
        F.coalesce("starts", nothing).alias("starts"),
        F.coalesce("ends", nothing).alias("ends"),
    )
