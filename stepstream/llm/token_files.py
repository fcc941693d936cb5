"""Token ids of documents in binary blocks, with Elias-Fano coded document bounds.

The documents are sorted into ranges of their id. Each range is one part of the output
and a run of blocks. A block has the ids of some documents one after the other as
little-endian integers (two bytes each where the vocabulary allows), the ends of the
documents in it as an Elias-Fano code, and the documents' own ids. Blocks are rows of a
Parquet table, so any file system that Spark writes to will do, and a task that is lost
or run twice leaves no trace. A reader needs one block in memory.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepstream.llm.cache import give_back, in_worker
from stepstream.llm.elias_fano import EliasFano
from stepstream.workspace import new_dir

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
BLOCK_IDS = 1 << 21  # a block ends with the document that reaches so many ids
WORDS_KEPT = 800_000  # that a Python worker remembers, in about 20 MB
BYTES_KEPT = 1 << 25  # of these words
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~\\"  # all of ASCII but the apostrophe, which the tokenizer may join to letters
_ALNUM = np.array([chr(c).isascii() and chr(c).isalnum() for c in range(256)])
_MARK, _MARKED = "\x01", 256  # words at a time
_BYTES_AT_ONCE = 1 << 22  # of texts whose distinct words are found together
_WORDS_AT_ONCE = 1 << 18
_NEW_AT_ONCE = 1 << 14  # words that are Python objects together
_BLOCKS = (
    "part int, block int, base bigint, id_bytes int, doc_ids array<bigint>, "
    "count int, limit bigint, width int, low binary, high binary, samples binary, ids binary"
)
_READ = "doc_id bigint, part int, start bigint, n_tokens bigint, ids_crc32 bigint"


class TextEncoder:
    """Ids of whole texts as bytes, for a vocabulary whose tokenizer never looks past white space, and drops it.

    So texts are cut at ASCII white space, and each distinct word of a lot of texts is encoded once by the library and
    remembered, in whole columns: an Arrow array of the words, the ids of all, and how many each has. Other white space stays in the words for the library. Of words that are ASCII throughout, capitals are taken as
    small letters and signs at the end apart, as the tokenizer does, before that; any other word is left to it as it stands. The library gets many
    words at a time with a mark between them.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.id_bytes = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.id_bytes}"
        self._forget()

    def _forget(self) -> None:
        self.words, self.ids, self.sizes = pa.array([], pa.string()), np.empty(0, self.kind), np.empty(0, np.int32)

    def encode(self, texts: pa.StringArray, end: int | None = END_ID) -> list[bytes]:
        """Ids of each text, in little-endian integers of ``id_bytes``, each followed by ``end``."""
        last = b"" if end is None else end.to_bytes(self.id_bytes, "little")
        cut = pc.ascii_split_whitespace(texts)
        words = cut.flatten().dictionary_encode()
        parts = _parts(words.dictionary).dictionary_encode()
        pool, sizes, place = self._coded(parts.dictionary)
        at = place[parts.indices.to_numpy(zero_copy_only=False)]
        of_words = _joined(pool, sizes, at)
        sizes, index = sizes[at].reshape(-1, 2).sum(axis=1), words.indices.to_numpy(zero_copy_only=False)
        ids = _joined(of_words, sizes, index)
        word_ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))
        ends = np.append(0, np.cumsum(sizes[index]))[np.append(0, word_ends)].tolist()
        return [ids[a:b].tobytes() + last for a, b in zip(ends, ends[1:])]

    def _coded(self, parts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the words remembered and of the new ones of ``parts``, how many each has, and the place of each part among them."""
        known = pc.index_in(parts, value_set=self.words)
        new = parts.filter(pc.is_null(known))
        found = [self._library(new.slice(i, _NEW_AT_ONCE).to_pylist()) for i in range(0, len(new), _NEW_AT_ONCE)]
        ids = np.concatenate([self.ids, *[some for some, _ in found]])
        sizes = np.concatenate([self.sizes, *[some for _, some in found]])
        place = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).copy()
        place[place < 0] = len(self.words) + np.arange(len(new))
        self._remember(parts, new, ids, sizes, place)
        return ids, sizes, place

    def _remember(self, parts: pa.StringArray, new: pa.StringArray, ids: np.ndarray, sizes: np.ndarray, place: np.ndarray) -> None:
        """The new words too; if that is too many, those of ``parts`` alone, or none if these are too many as well."""
        if _fit(self.words, new):
            if len(new):
                self.words, self.ids, self.sizes = pa.concat_arrays([self.words, new]), ids, sizes
        elif _fit(parts):
            self.words, self.ids, self.sizes = parts, _joined(ids, sizes, place), sizes[place]
        else:
            self._forget()

    def _library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has. The mark is a pre-token of its own and has one id, which only a word with the mark could have as well."""
        encode, mark = self.tokenizer.encode_batch_fast, f" {_MARK} "
        found = dict.fromkeys(words)
        alone = [word for word in words if _MARK in word]
        for word, encoding in zip(alone, encode(alone, add_special_tokens=False)):
            found[word] = np.array(encoding.ids, self.kind).tobytes()
        rest = [word for word in words if found[word] is None]
        lots = [rest[i : i + _MARKED] for i in range(0, len(rest), _MARKED)]
        mark_id = encode([_MARK], add_special_tokens=False)[0].ids[0]
        for lot, encoding in zip(lots, encode([mark.join(lot) + mark for lot in lots], add_special_tokens=False)):
            ids = np.array(encoding.ids, self.kind)
            coded, ends = ids.tobytes(), (np.flatnonzero(ids == mark_id) * self.id_bytes).tolist()
            starts = [0, *[end + self.id_bytes for end in ends]]
            found.update(zip(lot, [coded[a:b] for a, b in zip(starts, ends)]))
        sizes = np.fromiter(map(len, found.values()), np.int32, len(found)) // self.id_bytes
        return np.frombuffer(b"".join(found.values()), self.kind), sizes


def _fit(*words: pa.StringArray) -> bool:
    """Whether a worker may remember these."""
    return sum(map(len, words)) <= WORDS_KEPT and sum(pc.sum(pc.binary_length(some)).as_py() or 0 for some in words) <= BYTES_KEPT


def _parts(words: pa.StringArray) -> pa.StringArray:
    """Two parts of each word, one after the other: what the library gets, and the signs at its end or nothing.

    Both lie side by side in the words' own buffer, so only the bounds are new.
    """
    plain = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<|")))
    words = pc.if_else(plain, pc.ascii_lower(words), words)  # any other may compose or change with its case, or be a special token
    letters = words.buffers()[2] or pa.py_buffer(b"")
    starts = np.frombuffer(words.buffers()[1] or bytes(4), np.int32)[words.offset : words.offset + len(words) + 1]
    body = pc.binary_length(pc.ascii_rtrim(words, _SIGNS)).to_numpy(zero_copy_only=False)
    last = np.append(np.frombuffer(letters, np.uint8), 0)[starts[:-1] + body - 1]
    cut = plain.to_numpy(zero_copy_only=False) & (body > 0) & _ALNUM[last]
    bounds = np.empty(2 * len(words) + 1, np.int32)
    bounds[::2], bounds[1::2] = starts, np.where(cut, starts[:-1] + body, starts[1:])
    return pa.StringArray.from_buffers(2 * len(words), pa.py_buffer(bounds), letters)


def _joined(pool: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` named by ``index``, one after the other; ``sizes`` has the length of each run."""
    starts, parts = np.cumsum(sizes) - sizes, []
    for i in range(0, len(index), _WORDS_AT_ONCE):
        some = index[i : i + _WORDS_AT_ONCE]
        size = sizes[some]
        before = np.cumsum(size) - size
        parts.append(pool[np.repeat(starts[some] - before, size) + np.arange(size.sum())])
    return np.concatenate(parts) if parts else pool


def _lots(texts: pa.StringArray) -> Iterator[tuple[int, pa.StringArray]]:
    """The texts in lots of some megabytes, each with the place of its first; a longer text is one of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(texts):
        reached = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, reached + _BYTES_AT_ONCE)))
        yield begin, texts.slice(begin, end - begin)
        begin = end


def _write_part(path: str, block_ids: int, end: int | None):
    """A function that turns a sorted run of documents into blocks."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = in_worker(TextEncoder, path), TaskContext.get().partitionId()
        doc_ids, coded, ends, base, block = [], [], [0], 0, 0

        def row():
            code = EliasFano.of(np.array(ends[1:]))
            values = [part, block, base, encoder.id_bytes, doc_ids, *code, b"".join(coded)]
            return pa.RecordBatch.from_pydict(
                {name: [value] for name, value in zip(_arrow_schema().names, values)}, schema=_arrow_schema()
            )

        for batch in batches:
            for begin, texts in _lots(batch["text"]):
                for doc_id, ids in zip(batch["doc_id"].slice(begin, len(texts)).to_pylist(), encoder.encode(texts, end)):
                    doc_ids.append(doc_id)
                    coded.append(ids)
                    ends.append(ends[-1] + len(ids) // encoder.id_bytes)
                    if ends[-1] >= block_ids:
                        yield row()
                        base, block = base + ends[-1], block + 1
                        doc_ids, coded, ends = [], [], [0]
        if doc_ids:
            yield row()
        give_back()

    return write


def _arrow_schema():
    kinds = {
        "int": pa.int32(),
        "bigint": pa.int64(),
        "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in _BLOCKS.split(", "))])


def write_token_files(
    docs: DataFrame,
    folder: str,
    id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    block_ids: int = BLOCK_IDS,
    end: int | None = END_ID,
) -> None:
    """Encode all of ``docs`` into ``folder``, by rising id (NULL first), then by hash of the text.

    A NULL text counts as empty: such a document has the end id alone. Repeated rows
    stay repeated. An empty table makes a folder without blocks. The vocabulary at
    ``path`` must be readable on every executor.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    blocks = rows.mapInArrow(_write_part(path, block_ids, end), _BLOCKS)
    blocks.write.option("compression", "zstd").parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of each document, decoded from the blocks.

    ``start`` counts the ids of all documents before it. Parts know their own counts only,
    so the sums over parts, one number for each, are worked out first.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(folder)
    ends = blocks.groupBy("part").agg(F.max(F.col("base") + F.col("limit")).alias("ids")).collect()
    before, starts = 0, []
    for row in sorted(ends):
        starts.append((row["part"], before))
        before += row["ids"]
    offsets = F.broadcast(spark.createDataFrame(starts, "part int, before bigint"))  # one row per part
    found = blocks.mapInPandas(_read_blocks, _READ).join(offsets, "part")
    return found.select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def _read_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.itertuples(index=False):
            bounds = EliasFano(row.count, row.limit, row.width, row.low, row.high, row.samples)
            ends = np.array([0, *map(bounds.select, range(row.count))])
            ids = np.frombuffer(row.ids, f"<u{row.id_bytes}")
            crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(ends[:-1], ends[1:])]
            yield pd.DataFrame(
                {
                    "doc_id": pd.array(row.doc_ids, dtype="Int64"),
                    "part": row.part,
                    "start": row.base + ends[:-1],
                    "n_tokens": np.diff(ends),
                    "ids_crc32": crc,
                }
            )
    give_back()


def token_table(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` to a new folder among those that all executors share, and read it back."""
    folder = new_dir(docs.sparkSession, "tokens")
    write_token_files(docs, folder, **options)
    return read_token_files(docs.sparkSession, folder)
