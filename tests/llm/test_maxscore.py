"""Top-k against scoring every pair."""

import math
import random

import numpy as np
import pytest

from scholaris.llm import maxscore
from scholaris.llm.maxscore import LOWEST, search, top_k


def brute(rows, k=20, every=20, scale=64):
    vectors = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and not any(x is None or not math.isfinite(x) for x in v)
    ]
    found = []
    for place, (q, asked) in enumerate(vectors):
        if q % every == 0:
            scores = [(-sum(a * b for a, b in zip(asked, v, strict=False)), i) for n, (i, v) in enumerate(vectors) if n != place]
            found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(found)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string").repartition(3)


def f32(values):
    return [None if x is None else float(np.float32(x)) for x in values]


@pytest.mark.parametrize("kind", ["dense", "sparse", "negative", "equal"])
def test_whole_table(spark, monkeypatch, kind):
    monkeypatch.setattr(maxscore, "SHARD", 100)
    rng = random.Random(kind)
    make = {
        "dense": lambda: [rng.gauss(0, 0.15) for _ in range(16)],
        "sparse": lambda: [rng.gauss(0, 1) if rng.random() < 0.1 else 0.0 for _ in range(16)],
        "negative": lambda: [-abs(rng.gauss(0, 1)) if i % 2 else abs(rng.gauss(0, 1)) for i in range(16)],
        "equal": lambda: [0.25, -0.5, 0.0],
    }[kind]
    rows = [(i, f32(make())) for i in range(600)]
    found = top_k(table(spark, [(i, v, "clash") for i, v in rows]), task_vectors=200, block_cells=160).collect()
    assert sorted(map(tuple, found)) == brute(rows)


def test_every_row_is_a_candidate_and_a_query_of_its_own(spark):
    rows = [(20, [1.0, 1.0]), (20, [0.5, 1.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 0.0]), (40, [1.0, 1.0]), (40, [1.0, 1.0])]
    found = sorted(map(tuple, top_k(table(spark, [(i, v, None) for i, v in rows])).collect()))
    assert found == brute(rows) and len(found) == 4 * 6


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []), (None, [1.0, 1.0]),
        (20, [-1.0, 0.5, 3.0]), (20, [-1.0, 0.5, 3.0]), (6, [2.0, 2.0]), (6, [1.0, 2.0]), (-40, [0.5, 0.5]), (7, [float("-inf")]),
    ]
    found = top_k(table(spark, [(i, v, None) for i, v in rows])).collect()
    assert sorted(map(tuple, found)) == brute(rows)
    assert top_k(table(spark, [])).count() == 0
    assert top_k(table(spark, [(20, [1.0], "x")])).count() == 0
    assert top_k(table(spark, [(20, [], "x"), (1, [], "x")])).count() == 1


@pytest.mark.parametrize("many", [0, 64, 10**9])
@pytest.mark.parametrize("known", [False, True])
def test_search_prunes_and_stays_exact(monkeypatch, known, many):
    """With and without scores to beat, probing one by one or together, over hot copies, whichever way ties fall."""
    monkeypatch.setattr(maxscore, "MANY", many)
    rng = np.random.default_rng(2)
    vectors = np.floor(64 * rng.normal(0, 1, (9000, 32)) * (rng.random((9000, 32)) < 0.15)).astype(np.int64)
    vectors[::3] = vectors[0]
    ids, rows = rng.integers(0, 5000, 9000), rng.permutation(9000)
    asked = np.arange(0, 9000, 300)
    scores = vectors @ vectors[asked].T
    expected = []
    for place, own in enumerate(asked):
        others = np.flatnonzero(rows != rows[own])
        best = others[np.lexsort((ids[others], -scores[others, place]))[:20]]
        expected += [(place, int(scores[b, place]), int(ids[b])) for b in best]
    least = np.array([sorted(scores[:, p])[-60] for p in range(len(asked))]) if known else np.full(len(asked), LOWEST)
    found = search(ids, rows, vectors, vectors[asked], rows[asked], least, 20)
    assert sorted(map(tuple, found[:3].T.tolist())) == sorted(expected)


def test_few_terms_are_essential_against_a_score_to_beat():
    rng = np.random.default_rng(5)
    vectors = np.floor(rng.normal(0, 1, (4000, 64)) * 1000 / (1 + np.arange(64)) ** 2).astype(float)
    shard, query = maxscore.Shard(np.arange(4000), np.arange(4000), vectors), vectors[7:8]
    scores = np.sort(vectors @ query[0])
    order, open_after, essential = shard.terms(query, scores[-20:-19])
    assert essential[0] < 8 and (open_after[0, essential[0]] < scores[-20] <= open_after[0, essential[0] - 1])
    assert shard.terms(query, np.array([LOWEST]))[2][0] == 64
    postings = vectors[:, order[0, : essential[0]]] * query[0, order[0, : essential[0]]] > 0
    assert postings.any(axis=1)[np.argsort(vectors @ query[0])[-20:]].all()


def test_scores_beyond_doubles(spark):
    rows = [(i, f32([1e6 * (i % 7), -1e6 * (i % 5), 3e6])) for i in range(60)]
    found = top_k(table(spark, [(i, v, None) for i, v in rows]), k=5).collect()
    assert sorted(map(tuple, found)) == brute(rows, k=5)
    assert maxscore.K == 20
