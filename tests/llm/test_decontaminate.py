import random
from collections import Counter

import pytest

from stepstream.llm.decontaminate import drop_contaminated, find_passages

ITEMS = "item_id bigint, text string, fp_1 string"


def shingles(text):
    words = (text or "").lower().split()
    return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def plain(docs, items):
    """Every window against every item: the best similarity of each pair, where it is 0.8 or more."""
    found = {}
    for d, text in docs:
        own = shingles(text)
        for i, item_text in items:
            item = shingles(item_text)
            width = min(len(item), len(own))
            if not width:
                continue
            best = (0, 0)
            for start in range(len(own) - width + 1):
                both = sum((Counter(own[start : start + width]) & Counter(item)).values())
                best = max(best, (both / (len(item) + width - both), -start))
            if best[0] >= 0.8:
                key = (d, i)
                found[key] = max(found.get(key, (0, 0)), (round(best[0], 9), -best[1]))
    return found


@pytest.fixture
def benchmark(spark, prose):
    rows = [(i, prose(15 + 4 * i, 1000 + i)) for i in range(10)]
    rows += [(20, None), (21, ""), (22, "two words"), (3, prose(27, 1003)), (None, prose(20, 1100))]
    rows += [(23, "a b a b a b a b a b a b a b"), (24, prose(300, 1200))]
    return rows, spark.createDataFrame([(*r, "own") for r in rows], ITEMS)


def test_equals_brute_force(make_docs, benchmark, prose, awkward):
    items, table = benchmark
    rng, docs = random.Random(4), []
    for n in range(150):
        passage = rng.choice([t for _, t in items if t]).split()
        for _ in range(rng.choice([0, 0, 0, 1, 2])):  # changes of words, cuts and insertions
            at = rng.randrange(len(passage))
            passage[at : at + rng.choice([0, 1])] = [rng.choice(["x", "Y", ""])]
        docs.append((n, f"{prose(rng.choice([0, 3, 60]), n)} {' '.join(passage).upper()} {prose(rng.choice([0, 40]), n + 500)}"))
    docs += [(200, "two words"), (201, "Two  words"), (202, "two words more"), (203, "b a b a b a b a b")]
    docs += [r for r in awkward if r[1] is None or len(r[1]) < 10_000]
    found = find_passages(make_docs(docs, "start", "size"), table).collect()
    best = {}
    for r in found:
        key = (r["doc"]["id"], r["item"]["id"])
        best[key] = max(best.get(key, (0, 0)), (round(r["similarity"], 9), r["start"]))
    assert best.keys() == plain(docs, items).keys()
    assert {k: v[0] for k, v in best.items()} == {k: v[0] for k, v in plain(docs, items).items()}


def test_a_very_long_document(make_docs, benchmark, awkward, prose):
    _, table = benchmark
    long_text = f"{awkward[6][1]} {prose(39, 1006)} {prose(500, 77)}"
    found = find_passages(make_docs([(1, long_text)]), table).collect()
    assert [(r["item"]["id"], r["start"], r["similarity"]) for r in found] == [(6, 30_000, 1.0)]


def test_contaminated_documents_go(make_docs, benchmark, prose, awkward):
    _, table = benchmark
    docs = make_docs([*awkward, (50, "some " + prose(19, 1001)), (51, prose(60, 51)), (51, prose(60, 51))], "_doc", "_row")
    left = drop_contaminated(docs, table)
    assert left.columns == docs.columns
    expected = [d for d, _ in awkward] + [51, 51]
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted(expected, key=repr)


def test_empty_tables(make_docs, benchmark):
    _, table = benchmark
    docs = make_docs([(1, "a b c d e f")])
    assert find_passages(docs.where("doc_id < 0"), table).count() == 0
    assert drop_contaminated(docs, table.where("item_id < 0")).count() == 1
