import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stepstream.llm import token_count
from stepstream.llm.token_count import TokenCounter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(PATH)


PARTS = st.sampled_from([" ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "'s", "12", "-", "<|endoftext|>", "<|", "é", "é", "日本"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS | st.text(max_size=6), max_size=12).map("".join))
def test_counts_equal_the_library(library, counter, text):
    text = text.encode("utf-8", "ignore").decode()
    assert counter.count(text.encode()) == len(library.encode(text, add_special_tokens=False).ids)


def test_column(make_docs, library, awkward):
    found = count_tokens(make_docs(awkward, "n_tokens"), "doc_id").collect()
    expected = []
    for d, t in awkward:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.append((d, len((t or "").encode()), n, n > 1024))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_memory_is_bounded(library, prose):
    counter = TokenCounter(PATH)
    counter.chunks.most = counter.pieces.most = 50
    text = prose(2000, 5)
    assert counter.count(text.encode()) == len(library.encode(text, add_special_tokens=False).ids)
    assert len(counter.chunks) <= 50 and len(counter.pieces.before) <= 50


def test_empty_table(make_docs):
    assert count_tokens(make_docs([(1, "a")]).where("doc_id < 0"), "doc_id").count() == 0


def held_after(counter, text):
    """Bytes that the counter keeps of a text, in Python and in Arrow."""
    counter.count(b"a few words")
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    counter.count(text.encode())
    held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    return held


def test_long_words_are_not_held():
    text = " ".join(f"{'xyz' * 1000}{'q' * i}" for i in range(200))
    assert held_after(TokenCounter(PATH), text) < len(text) / 2  # Python's own free lists are a quarter of it


def test_remembered_chunks_are_small():
    counter, words = TokenCounter(PATH), 30_000
    counter.pieces.most = 100
    held = held_after(counter, " ".join(f"w{i:x}" for i in range(words)))
    assert len(counter.chunks) >= words - 1
    assert held < 50 * words


@pytest.mark.parametrize("most, longest", [(500_000, 64), (40, 64), (500_000, 3), (0, 0)])
def test_forgotten_chunks_come_out_the_same(library, prose, monkeypatch, most, longest):
    monkeypatch.setattr(token_count, "BYTES_KEPT", longest)
    counter = TokenCounter(PATH)
    counter.chunks.most = most
    for i in range(20):
        texts = ["", prose(20, i % 7), "a  b " + prose(3, i), f"<|endoftext|> {i}", " ", prose(10, i), "日本語" * 40 + f" {i}", " é x"]
        expected = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
        assert counter.counts(pa.array([t.encode() for t in texts])).tolist() == expected
        assert len(counter.chunks) <= most and all(len(w) <= longest for w in counter.chunks.words.to_pylist())


def test_kept_columns_of_other_kinds(spark, library):
    rows = [(None, [1, None], {"a": 1}, "a b"), ("k", None, None, None), ("k", [], {}, "c" * 90)] * 3
    docs = spark.createDataFrame(rows, "k string, l array<int>, m map<string,int>, text string")
    found = count_tokens(docs.repartition(2), "k", "l", "m", limit=1).collect()
    sizes = [(len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for *_, t in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(((*r[:3], *n, n[1] > 1) for r, n in zip(rows, sizes)), key=repr)


def test_no_text_waits_in_a_queue(make_docs):
    plan = count_tokens(make_docs([(1, "a")]), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
