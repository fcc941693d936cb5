"""Token counts of a byte-level BPE vocabulary, by merging with a heap over a linked list.

A text is cut as the vocabulary's tokenizer cuts it, and each piece of it is merged: the
adjacent pair of the lowest rank is popped and joined until no ranked pair is left. A piece
has as many tokens as it had bytes, less the merges. Token ids are never formed.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from stepstream.llm.cache import Recent, give_back, in_worker
from stepstream.llm.token_files import _lots

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
CHUNKS_KEPT = 500_000  # that a Python worker remembers, in about 10 MB
PIECES_KEPT = 50_000  # in each of two lots; about 10 MB
BYTES_KEPT = 64  # of the longest chunk or piece that is remembered
_NEW_AT_ONCE = 1 << 14  # chunks that are Python objects together
_STARTS_WITH_SPACE = regex.compile(r"\s")


def _byte_letters() -> dict[str, int]:
    """The letter that a vocabulary file writes for each byte: itself if it is printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TokenCounter:
    """Counts the tokens of texts for a vocabulary file of the byte-level kind."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = _byte_letters()
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, merge in enumerate(model["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[bytes(map(letters.get, left)), bytes(map(letters.get, right))] = rank
        specials = sorted((t["content"] for t in model["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.special_bytes = [s.encode() for s in specials]
        self.pattern = regex.compile(pattern)
        self.chunks = _Counts(CHUNKS_KEPT, self._chunk)
        self.pieces = Recent(PIECES_KEPT, lambda piece: self.merge(piece.encode()))

    def merge(self, piece: bytes) -> int:
        """Tokens of one piece: its bytes less the merges."""
        n = len(piece)
        if n < 2:
            return n
        ranks = self.ranks
        parts: list = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = ranks.get((parts[i], parts[i + 1]))
            if rank is not None:
                heap.append((rank, i, parts[i], parts[i + 1]))
        heapq.heapify(heap)
        tokens = n
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] is not left or j >= n or parts[j] is not right:
                continue  # one of the two has been merged since
            joined = left + right
            parts[i], parts[j] = joined, None
            tokens -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get((joined, parts[k]))
                if rank is not None:
                    heapq.heappush(heap, (rank, i, joined, parts[k]))
            k = before[i]
            if k >= 0:
                rank = ranks.get((parts[k], joined))
                if rank is not None:
                    heapq.heappush(heap, (rank, k, parts[k], joined))
        return tokens

    def _segment(self, text: str) -> int:
        return sum(map(self._piece, self.pattern.findall(text)))

    def _piece(self, piece: str) -> int:
        long = len(piece) * 4 > BYTES_KEPT and len(piece.encode()) > BYTES_KEPT
        return self.merge(piece.encode()) if long else self.pieces[piece]

    def _chunk(self, chunk: bytes) -> int:
        """Tokens of a chunk after a space, or -1: it goes on in white space, which the tokenizer cuts otherwise."""
        text = chunk.decode()
        if not text or _STARTS_WITH_SPACE.match(text):
            return -1
        return self._segment(" " + text)

    def _whole(self, text: str) -> int:
        if not self.special:
            return self._segment(text)
        return sum(map(self._segment, self.special.split(text))) + len(self.special.findall(text))

    def counts(self, texts: pa.BinaryArray) -> np.ndarray:
        """Tokens of whole texts; special strings in them are one token each.

        A space before a character that is not white always starts a piece, so chunks
        from space to space can be counted apart, each distinct one of the texts once,
        and remembered.
        """
        cut = pc.split_pattern(texts, b" ")
        chunks, sizes = cut.flatten(), pc.list_value_length(cut).to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        later = np.ones(len(chunks), bool)
        later[starts] = False
        words = chunks.filter(pa.array(later)).dictionary_encode()
        found = np.zeros(len(chunks), np.int64)
        found[later] = self.chunks.of(words.dictionary)[words.indices.to_numpy(zero_copy_only=False)]
        whole = np.logical_or.reduceat(found < 0, starts)
        for special in self.special_bytes:
            whole |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        counts = np.add.reduceat(found, starts)
        for i, start in enumerate(starts):
            if whole[i]:
                counts[i] = self._whole(texts[i].as_py().decode())
            else:
                counts[i] += self._segment(chunks[start].as_py().decode())
        return counts

    def count(self, text: bytes) -> int:
        """Tokens of one whole text."""
        return int(self.counts(pa.array([text], pa.binary()))[0])


class _Counts:
    """Remembers ``compute`` of short byte strings in whole columns; beyond ``most`` it goes on with those of the last call alone."""

    def __init__(self, most: int, compute: Callable[[bytes], int]):
        self.most, self.compute = most, compute
        self.words, self.found = pa.array([], pa.binary()), np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.words)

    def of(self, words: pa.BinaryArray) -> np.ndarray:
        """``compute`` of each of these distinct strings."""
        known = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(known))
        some = (new.slice(i, _NEW_AT_ONCE).to_pylist() for i in range(0, len(new), _NEW_AT_ONCE))
        counted = np.fromiter((self.compute(word) for lot in some for word in lot), np.int64, len(new))
        place = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).copy()
        place[place < 0] = len(self.words) + np.arange(len(new))
        found = np.append(self.found, counted)[place]
        self._remember(*_short(new, counted), *_short(words, found))
        return found

    def _remember(self, new: pa.BinaryArray, counted: np.ndarray, words: pa.BinaryArray, found: np.ndarray) -> None:
        if len(self.words) + len(new) > self.most:
            # a copy, as a slice would keep all it was cut from
            self.words, self.found = pa.concat_arrays([words.slice(0, self.most), words.slice(0, 0)]), found[: self.most].copy()
        elif len(new):
            self.words, self.found = pa.concat_arrays([self.words, new]), np.append(self.found, counted)


def _short(words: pa.BinaryArray, found: np.ndarray) -> tuple[pa.BinaryArray, np.ndarray]:
    short = pc.less_equal(pc.binary_length(words), BYTES_KEPT)
    return words.filter(short), found[short.to_numpy(zero_copy_only=False)]


def _count_last(path: str):
    """A function that puts token counts in place of the last column, which has texts as bytes."""

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter, *keep = in_worker(TokenCounter, path), *batch.columns[:-1]
        counts = [np.empty(0, np.int64)]
        for _, texts in _lots(batch.columns[-1]):
            counts.append(counter.counts(texts))
            give_back()
        return pa.RecordBatch.from_arrays([*keep, pa.array(np.concatenate(counts))], batch.schema.names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(counted, batches)  # no batch is held while the next one comes
        give_back()

    return count


def count_tokens(
    docs: DataFrame, *keep: str, text: str = "text", path: str | None = None, limit: int = LIMIT
) -> DataFrame:
    """``keep``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    A NULL text counts as empty and has 0 of both. Repeated rows come out repeated,
    an empty table gives no rows, and other columns are not looked at. The vocabulary at
    ``path`` must be readable on every executor.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    rows = docs.select(
        *keep,
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("n_tokens"),
    )
    counted = rows.mapInArrow(_count_last(path), StructType(rows.schema.fields[:-1]).add("n_tokens", LongType()))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
