"""Fingerprints against a word-by-word version, links and components against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from scholaris.llm import simhash
from scholaris.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    digests = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(d >> b & 1 for d in digests) > len(digests))


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_fingerprints(spark, documents, odd_texts):
    rows = simhash.fingerprints(documents(odd_texts)).collect()
    assert {r.doc_id: r.fp % (1 << 64) for r in rows} == {i: brute_fingerprint(t) for i, t in enumerate(odd_texts)}


def clustered(rng, n):
    """Fingerprints around a few centres, so that many lie within 0 to 5 bits."""
    centres = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    return [rng.choice(centres) ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) for _ in range(n)]


@pytest.mark.parametrize("parts", [2, 3, 4])
def test_links_are_all_pairs_within_the_distance(spark, parts, monkeypatch):
    monkeypatch.setattr(simhash, "PART_COUNTS", (parts,))
    values = sorted({simhash._signed(x % (1 << 64)) for x in clustered(random.Random(parts), 400)})
    distinct = spark.createDataFrame([(v,) for v in values], "fp long")
    chosen = simhash.plan(distinct)
    assert sorted(b for part in chosen.parts for b in part) == list(range(64))
    assert sum(t + 1 for t in chosen.thresholds) == 4
    found = {tuple(r) for r in simhash.links(distinct, chosen).distinct().collect()}
    far = np.array(values, np.int64)
    apart = np.bitwise_count((far[:, None] ^ far[None, :]).view(np.uint64))
    a, b = np.where(np.triu(apart <= 3, 1))
    assert found == {(values[i], values[j]) for i, j in zip(a, b, strict=True)}


def test_allocation_is_the_cheapest():
    costs = [[0, 5, 9, 40], [0, 4, 30, 90], [0, 8, 9, 10]]
    cost, chosen = simhash.allocate(costs, 3)
    options = [(a, b, c) for a in range(4) for b in range(4) for c in range(4) if a + b + c == 3]
    assert cost == min(costs[0][a] + costs[1][b] + costs[2][c] for a, b, c in options)
    assert sum(t + 1 for t in chosen) == 3


def test_near_duplicates(spark, documents, odd_texts):
    rng = random.Random(9)
    base = [" ".join(f"w{rng.randint(0, 300)}" for _ in range(200)) for _ in range(20)]
    near = [t.replace(" ", "  ", 3) + " tail" for t in base[:10]]
    texts = [*odd_texts, *base, *near, *base[:5]]
    rows = simhash.near_duplicates(documents(texts)).collect()
    prints = {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert {r.doc_id: r.component for r in rows} == brute_components(prints, linked)


def test_odd_tables(spark, documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert [tuple(r) for r in simhash.near_duplicates(documents([None])).collect()] == [(0, 0, 0)]
    rows = simhash.near_duplicates(documents(["a b c", "a b c", "", None, "a b c"], [7, 7, None, None, None])).collect()
    assert sorted((r.doc_id, r.component) for r in rows if r.doc_id) == [(7, 7), (7, 7)]
    assert [r.component for r in rows if r.fp == 0] == [None, None]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, i) for i in range(101, 180)]
    other = [(200, 200), (301, 300), (300, 301), (None, 5), (7, None)]
    edges = spark.createDataFrame([*chain, *star, *other], "a int, b int")
    found = {r.node: r.component for r in components(edges).collect()}
    nodes = {n for e in [*chain, *star, *other[:3]] for n in e}
    assert found == brute_components(nodes, [*chain, *star, *other[:3]])
    assert components(edges.limit(0)).count() == 0
