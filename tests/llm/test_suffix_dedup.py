import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from stepstream.llm import suffix_dedup
from stepstream.llm.queries import suffix_dedup as query
from stepstream.llm.suffix_dedup import STRING, SuffixArray, drop_repeated_strings, gram_hashes, stretches


def plain(texts):
    """Which bytes of each text lie in a string that starts elsewhere, too."""
    bodies = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + STRING] for b in bodies for i in range(len(b) - STRING + 1))
    found = []
    for body in bodies:
        gone = np.zeros(len(body), dtype=bool)
        for i in range(len(body) - STRING + 1):
            if times[body[i : i + STRING]] > 1:
                gone[i : i + STRING] = True
        found.append((body, gone))
    return found


def expected(rows):
    found = []
    for (doc_id, *_), (body, gone) in zip(rows, plain([r[1] for r in rows])):
        kept = bytes(np.frombuffer(body, np.uint8)[~gone])
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        found.append((doc_id, len(body), int(gone.sum()), spans, kept))
    return sorted(found, key=repr)


def dropped(docs):
    rows = drop_repeated_strings(docs, "doc_id").collect()
    for r in rows:
        assert all(a < b for a, b in zip([-1, *r["ends"]], [*r["starts"], r["n_bytes"] + 1]))  # apart, and in order
    return sorted(
        [(r["doc_id"], r["n_bytes"], sum(r["ends"]) - sum(r["starts"]), len(r["starts"]), bytes(r["kept"])) for r in rows], key=repr
    )


@given(st.lists(st.binary(min_size=1, max_size=40).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=12))
def test_suffix_array_and_common_prefixes(pieces):
    suffixes = SuffixArray(pieces)
    text = b"".join(pieces)
    ends = np.repeat(np.cumsum([len(p) for p in pieces]), [len(p) for p in pieces])
    whole = [text[i:end] for i, end in enumerate(ends)]
    assert suffixes.order.tolist() == sorted(range(len(text)), key=lambda i: (whole[i], i))
    shared = suffixes.common_prefixes(20)
    for before, place in zip(suffixes.order, suffixes.order[1:]):
        a, b = whole[before], whole[place]
        same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[place] == min(same, 20)


def test_stretches_hold_every_string_once(monkeypatch, prose):
    text = (prose(400, 1) + "x" * 1000 + "line\n" * 90 + prose(30, 1)).encode()
    strings = {}
    for at_once in (1 << 20, 700):
        monkeypatch.setattr(suffix_dedup, "_AT_ONCE", at_once)
        hashes, first, count = stretches(text)
        assert first.tolist() == np.cumsum([0, *count[:-1]]).tolist() and count.max() <= suffix_dedup.GRAMS
        for key, at, n in zip(hashes.tolist(), first.tolist(), count.tolist()):
            for i in range(at, at + n):  # equal strings have equal hashes, wherever they are cut
                assert strings.setdefault(text[i : i + STRING], key) == key == gram_hashes(text[i : i + STRING]).min()
    assert [len(x) for x in stretches(b"x" * (STRING - 1))] == [0, 0, 0]


@pytest.fixture
def rows(awkward, prose):
    """Copies, passages in different surroundings, passages cut short, repeats in one text, and periodic texts."""
    passage = prose(80, 50)
    texts = [f"{prose(30 + i, 60 + i)} {passage} {prose(25, 100 + i)}" for i in range(25)]
    texts += [f"{prose(20, 200 + i)} {passage[i * 7 :]}{prose(20, 300 + i)}" for i in range(25)]
    texts += [passage[:199], passage[:200], passage[1:200] + "!", prose(60, 7) * 2, "ab" * 150, "ba" * 150 + "c", "é" * 100, "é" * 99 + "e"]
    texts += [prose(100, 8), prose(100, 8), prose(100, 8)[1:], prose(100, 8)[:-1], prose(100, 9)]
    line = prose(20, 11)[:120]
    texts += [f"{prose(40, 400 + i)}\n{line}\n{prose(40, 500 + i % 9)}" for i in range(40)]
    random.Random(3).shuffle(texts)
    return awkward + [(100 + i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("few", [False, True])
def test_equals_plain(make_docs, rows, few, monkeypatch):
    if few:  # shards of a few stretches, so that hashes are spread and lists merged
        for name, value in {"SHARD_BYTES": 2000, "SPREAD_FROM": 3, "MERGED": 200, "BROADCAST_SPANS": 0, "_ROWS_AT_ONCE": 5}.items():
            monkeypatch.setattr(suffix_dedup, name, value)
    docs = make_docs(rows, "hash", "text_id", "size", "kept", "n")
    assert dropped(docs) == expected(rows)


def test_nothing_repeated_and_empty(make_docs, prose):
    rows = [(i, prose(90, i)) for i in range(3)] + [(9, None)]
    assert dropped(make_docs(rows)) == expected(rows)
    assert dropped(make_docs(rows).where("doc_id < 0")) == []


def test_query(spark, make_docs, rows, tmp_path):
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = sorted(map(tuple, query(spark, str(tmp_path)).collect()), key=repr)
    assert found == sorted([(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in expected(rows)], key=repr)


@pytest.mark.parametrize("few", [False, True])
def test_repeats_within_one_stretch(make_docs, prose, few, monkeypatch):
    """Runs that are periodic and short, so their strings have one hash, which no other place has."""
    if few:
        for name, value in {"SHARD_BYTES": 2000, "SPREAD_FROM": 3, "MERGED": 200}.items():
            monkeypatch.setattr(suffix_dedup, name, value)
    texts = ["x" * 250, "x" * 199 + "y", "é" * 101, prose(40, 1) + "=" * 230 + prose(40, 2)]
    for i in range(1, 200, 9):
        unit = prose(60, 20 + i).encode()[:i].decode(errors="ignore")
        texts += [prose(9, 300 + i) + (unit * 300)[: 200 + i + i % 4] + prose(9, 600 + i), unit * (400 // i)]
    rows = list(enumerate(texts))
    wanted = expected(rows)
    assert sum(r[2] > 0 for r in wanted) > 25
    assert dropped(make_docs(rows)) == wanted
