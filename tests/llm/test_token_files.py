import random
import tracemalloc
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stepstream.llm import token_files
from stepstream.llm.elias_fano import EliasFano
from stepstream.llm.token_files import TextEncoder, read_token_files, token_table, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000) | st.just(0), max_size=400))
def test_elias_fano_round_trip(steps):
    values = np.cumsum(steps, dtype=np.int64)
    code = EliasFano.of(values)
    assert code.all().tolist() == values.tolist()
    assert [code.select(i) for i in range(len(values))] == values.tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.full(10_000, 700))
    code = EliasFano.of(values)
    assert 8 * sum(map(len, (code.low, code.high, code.samples))) < 10_000 * (2.6 + np.log2(700))


PARTS = st.sampled_from([" ", "\n", "\u00a0", "\u2003", "\x1c", "'s", "12", "<|endoftext|>", "É", "é", "ẞ", "Σας", "İ", "BELGESİ."])


def ids_of(texts):
    return [np.frombuffer(ids, "<u2").tolist() for ids in TextEncoder(PATH).encode(pa.array(texts, pa.string()), None)]


@settings(max_examples=200, deadline=None)
@given(st.lists(PARTS | st.text(max_size=6), max_size=12).map("".join))
def test_ids_equal_the_library(library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids_of([text]) == [library.encode(text, add_special_tokens=False).ids]


def test_fuzz_of_changing_characters(library):
    """Characters that change with case or composition, marks, signs and white space, in any order."""
    rng = random.Random(5)
    changing = [c for c in map(chr, range(0x80, 0x20000)) if c.lower() != c or c.upper() != c or unicodedata.decomposition(c)]
    marks = [c for c in map(chr, range(0x300, 0x3100)) if unicodedata.combining(c)]
    ascii_ = [chr(i) for i in range(32, 127)]
    white = [c for c in map(chr, range(0x3001)) if c.isspace()]
    kinds = (changing, marks, ascii_, ascii_, list("İıſKÅΣςß"), white, ["<|startoftext|>", "'ll", ""])
    texts = ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(1, 9))) for _ in range(50_000)]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(texts) == expected


def test_a_small_memory_and_long_texts(library, prose, monkeypatch):
    for name, value in {"WORDS_KEPT": 20, "_WORDS_AT_ONCE": 7, "_BYTES_AT_ONCE": 500}.items():
        monkeypatch.setattr(token_files, name, value)
    texts = [prose(300, i % 4) for i in range(9)] + ["", " ", "one"]
    encoder, found = TextEncoder(PATH), []
    for begin, lot in token_files._lots(pa.array(texts)):
        assert begin == len(found)
        found += encoder.encode(lot, 1)
    assert found == [np.array([*e.ids, 1], "<u2").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("most_words, most_bytes", [(150, 1 << 20), (1 << 20, 700), (1 << 20, 40), (0, 0)])
def test_forgotten_words_come_out_the_same(library, prose, monkeypatch, most_words, most_bytes):
    monkeypatch.setattr(token_files, "WORDS_KEPT", most_words)
    monkeypatch.setattr(token_files, "BYTES_KEPT", most_bytes)
    encoder, seen = TextEncoder(PATH), set()
    for i in range(30):
        texts = [prose(20, i % 7), prose(10, i), "", "Ǆ é's \x01 b!"][i % 2 :]
        expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(ids, "<u2").tolist() for ids in encoder.encode(pa.array(texts), None)] == expected
        assert len(encoder.words) <= most_words and sum(len(w.encode()) for w in encoder.words.to_pylist()) <= most_bytes
        assert len(encoder.words) == len(encoder.sizes) and len(encoder.ids) == encoder.sizes.sum()
        seen.add(len(encoder.words))
    assert (len(seen) > 2) == (most_bytes > 40)


def test_remembered_words_are_small():
    words, encoder = 30_000, TextEncoder(PATH)
    encoder.encode(pa.array(["a few"]))
    text = pa.array([" ".join(f"w{i:x}" for i in range(words))])
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    encoder.encode(text)
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert len(encoder.words) >= words
    assert held < 50 * words


def expected(library, rows):
    """By rising id, NULL first; rows of one id in the order of their start."""
    out = []
    for d, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_ids", [1, 300, 1 << 21])
def test_files_give_back_every_document(spark, make_docs, library, awkward, tmp_path, block_ids):
    folder = str(tmp_path / "tokens")
    write_token_files(make_docs(awkward, "part", "ids"), folder, block_ids=block_ids)
    found = sorted(read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    assert sorted(((r[0], r[2], r[3]) for r in found), key=repr) == expected(library, awkward)
    assert [r["start"] for r in found] == np.cumsum([0] + [r["n_tokens"] for r in found[:-1]]).tolist()
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
    assert ids == sorted(ids)


def test_query_form(make_docs, prose, library):
    rows = [(i, prose(20 + i, i)) for i in range(50)]
    found = token_table(make_docs(rows)).collect()
    assert sorted(((r[0], r[2], r[3]) for r in found), key=repr) == expected(library, rows)


def test_empty_table(make_docs):
    assert token_table(make_docs([(1, "a")]).where("doc_id < 0")).count() == 0
