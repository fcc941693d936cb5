import random
import re
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from stepstream.llm.simhash_dedup import (
    SEGMENTS,
    drop_near_duplicates,
    hex_fingerprint,
    link_fingerprints,
    near_duplicates,
)


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    runs = [words[i : i + 4] for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(run).encode(), 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """``prints`` maps a node to its fingerprint; gives the smallest linked node of each."""
    root = {n: n for n in prints}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {n: find(n) for n in prints}


def test_segments_cover_all_bits_once():
    assert [low for low, _ in SEGMENTS] == [0, 22, 43]
    assert sum(bits for _, bits in SEGMENTS) == 64


def test_fingerprints(make_docs, awkward):
    rows = near_duplicates(make_docs(awkward, "fp", "component")).select(
        "doc_id", hex_fingerprint(F.col("fp")).alias("fp")
    )
    found = sorted(rows.collect(), key=repr)
    assert found == sorted(((d, f"{plain_fingerprint(t):016x}") for d, t in awkward), key=repr)


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


@pytest.mark.parametrize("seed", range(3))
def test_links_equal_those_of_all_pairs(spark, seed):
    """Dense groups, chains, and fingerprints one bit too far away."""
    rng = random.Random(seed)
    prints = set()
    for _ in range(12):
        now = rng.getrandbits(64)
        prints.add(now)
        for _ in range(rng.choice([1, 5, 60])):
            near = now if rng.random() < 0.7 else rng.choice(sorted(prints))
            prints.add(near ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    prints = {signed(p): p for p in prints}
    table = spark.createDataFrame([(p, 1 + p % 3) for p in prints], "fp bigint, n bigint")
    found = {r["node"]: r["component"] for r in link_fingerprints(table).collect()}
    expected = plain_components(prints)
    sizes = {c: list(expected.values()).count(c) for c in expected.values()}
    assert found == {n: c for n, c in expected.items() if sizes[c] > 1}


def test_groups_take_their_smallest_id(make_docs, awkward, prose):
    rows = awkward + [(20 + i, prose(200, 7) + f" tail{i}") for i in range(8)]
    found = near_duplicates(make_docs(rows)).select("doc_id", "component_id").distinct().collect()
    prints = {i: plain_fingerprint(t) for i, (_, t) in enumerate(rows)}
    groups = {}
    for i, root in plain_components(prints).items():
        groups.setdefault(root, []).append(rows[i][0])
    smallest = {(d, min((x for x in g if x is not None), default=None)) for g in groups.values() for d in g}
    assert set(map(tuple, found)) == smallest


def test_one_row_of_each_group_stays(make_docs, awkward):
    docs = make_docs(awkward, "_row", "kept")
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    # All blank texts are one group with the NULL one of the smallest id; ids 5 and 6 share a text.
    kept = sorted((r["doc_id"] for r in left.collect()), key=lambda d: (d is None, d))
    assert kept == [0, 3, 4, 5, 5, 7, 8, None]


def test_empty_table(make_docs):
    docs = make_docs([(1, "a")]).where("doc_id < 0")
    assert near_duplicates(docs).count() == 0
    assert drop_near_duplicates(docs).count() == 0


def test_components_of_a_chain(spark):
    from stepstream.llm.components import connected_components

    edges = [(i, i + 1) for i in range(200)] + [(300, 301), (301, 301)]
    found = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r["node"]: r["component"] for r in found} == {**dict.fromkeys(range(201), 0), 300: 300, 301: 300}
