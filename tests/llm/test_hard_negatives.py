import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stepstream.llm import hard_negatives
from stepstream.llm.hard_negatives import mine_hard_negatives
from stepstream.llm.queries import hard_negatives as query

VECTORS = "vec_id bigint, embedding array<double>, label int, row string, slot string"


def plain(rows, is_anchor, scale=256, positives=5, negatives=3):
    usable = {}
    for vec_id, vector, label, *_ in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            usable[vec_id, label, tuple(math.floor(scale * x) for x in vector)] = None
    usable = list(usable)
    found = []
    for a in usable:
        if a[0] is None or not is_anchor(a[0]):
            continue
        near = [(sum(map(int.__mul__, a[2], b[2])), b) for b in usable if b != a and len(b[2]) == len(a[2]) > 0]
        near.sort(key=lambda x: (-x[0], x[1][0] is None, x[1][0] or 0))
        for p, b in [x for x in near if x[1][1] == a[1]][:positives]:
            window = [(n, c[0]) for n, c in near if c[1] != a[1] and 50 * p <= 100 * n <= 95 * p]
            found += [(a[0], b[0], i, c, p, n) for i, (n, c) in enumerate(window[:negatives], 1)]
    return sorted(found, key=repr)


def mined(spark, rows, **options):
    full = [(*r, "own", "own") for r in rows]
    table = mine_hard_negatives(spark.createDataFrame(full, VECTORS), F.col("vec_id") % 50 == 0, **options)
    assert table.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, table.collect()), key=repr)


@pytest.fixture
def rows():
    rng = random.Random(3)
    near = [rng.gauss(0, 1) for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.3) for x in near], i % 3) for i in range(160)]
    rows += [(500 + i, [-x for x in near], i % 2) for i in range(6)]  # anchors among rows of negative scores
    rows += [(700, near, 1), (701, near, 1), (702, near, 2), (703, near, 2), (None, near, 2), (None, near, 1)]  # ties
    rows += [rows[0], rows[0], (50, [0.5] * 6, 0)]  # repeated rows, and an id that stands for two
    rows += [(800, None, 1), (801, near, None), (802, [math.nan] + near[1:], 1), (803, [None] + near[1:], 1)]
    return rows + [(804, [math.inf] + near[1:], 1), (850, [], 1), (851, [], 2), (900, [1.0, 2.0], 1), (901, [1.0, 1.9], 2)]


@pytest.mark.parametrize("cell", [hard_negatives.CELL, 120])  # many groups of anchors and of rows
def test_equals_all_pairs(spark, rows, cell, monkeypatch):
    monkeypatch.setattr(hard_negatives, "CELL", cell)
    expected = plain(rows, lambda i: i % 50 == 0)
    assert len({r[:2] for r in expected}) > 15
    assert mined(spark, rows) == expected


def test_sums_beyond_floats_are_exact(spark):
    rows = [(50 * i, [float(2**24 + i), 1.0], 0) for i in range(4)] + [(50 * i + 1, [float(2**24 - 99 * 2**16 - i), 1.0], 1) for i in range(9)]
    assert mined(spark, rows, scale=1) == plain(rows, lambda i: i % 50 == 0, scale=1) != []


def test_other_numbers_of_positives_and_negatives(spark, rows):
    expected = plain(rows, lambda i: i % 50 == 0, positives=2, negatives=7)
    assert mined(spark, rows, positives=2, negatives=7) == expected


def test_without_anchors_or_rows(spark):
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, []) == []


def as_contracted(rows):
    """Every row by itself, in whole numbers of any size; one vector in seven has the label after its own."""
    usable = []
    for i, vector, label in rows:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            usable.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in vector]))
    found = []
    for a in [r for r in usable if r[0] % 50 == 0]:
        near = [(sum(map(int.__mul__, a[2], b[2])), b) for b in usable if b is not a and len(b[2]) == len(a[2])]
        near.sort(key=lambda x: (-x[0], x[1][0]))
        for p, b in [x for x in near if x[1][1] == a[1]][:5]:
            window = [(n, c[0]) for n, c in near if c[1] != a[1] and 50 * p <= 100 * n <= 95 * p]
            found += [(a[0], b[0], i, c, p, n) for i, (n, c) in enumerate(window[:3], 1)]
    return sorted(found)


def queried(spark, rows, folder):
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return sorted(map(tuple, query(spark, str(folder)).collect()))


def some_vectors(size):
    rng = random.Random(9)
    return [(i, [size * (1 + rng.gauss(0, 0.3)) for _ in range(5)], i % 3) for i in range(160)]


def test_query_takes_repeated_rows_and_empty_vectors(spark, tmp_path):
    rows = some_vectors(1.0)
    rows += rows[:60] + rows[:60:7] + [(200 + i, [], i % 3) for i in range(60)] + [(401, rows[0][1], 2**31 - 1), (7, rows[0][1], 2**31 - 1)]
    assert queried(spark, rows, tmp_path) == as_contracted(rows) != []


@pytest.mark.parametrize("size", [3e5, 3e6, 2e6])  # scores up to 9e18, a hundred times which is no long
def test_query_on_large_scores(spark, tmp_path, size):
    rows = [(i, [min(x, 4e6) for x in v], label) for i, v, label in some_vectors(size)]
    rows += [(1000 + i, [-1e300] + [1.0] * 4, i % 3) for i in range(3)]  # far below any long
    assert queried(spark, rows, tmp_path) == as_contracted(rows) != []


def test_limits_are_exact_and_keys_stay_in_range():
    scores = hard_negatives._scores(np.full((1, 1), 2.0**26), np.full((5000, 1), 2.0**26 - np.arange(5000)[:, None]))
    assert scores[0].tolist() == [2**52 - 2**26 * i for i in range(5000)]
    line, column = hard_negatives._best(scores, np.ones(scores.shape, dtype=bool), 3)
    assert sorted(column.tolist()) == [0, 1, 2]


def test_shares_of_longs_are_exact(spark):
    values = [0, 1, -1, 99, -250, 2**55 + 1, 10**18 + 20, 2**63 - 1, -(2**63), 95 * 10**15 + 7, -(10**17) - 3]
    row = spark.createDataFrame([(v,) for v in values], "v bigint")
    down, up = hard_negatives._per_cent(F.col("v"), 95), hard_negatives._per_cent(F.col("v"), 50, up=True)
    assert sorted(map(tuple, row.select("v", down, up).collect())) == sorted((v, v * 95 // 100, -(-v * 50 // 100)) for v in values)


def test_query_with_ids_beyond_floats(spark, tmp_path):
    start = 2**62 - 2**62 % 50
    rows = [(start + i, vector, label) for i, vector, label in some_vectors(1.0)]
    assert queried(spark, rows, tmp_path) == as_contracted(rows) != []
