"""Ranked search against scoring every document by plain Python."""

import math
import pickle
import random
import re
from collections import Counter

import pytest

from scholaris.llm.lexscan import automaton_of, ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    found = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    total, documents = sum(n for *_, n in found), sum(n > 0 for *_, n in found)
    df = Counter(term for _, tf, _ in found for term in tf)
    out = []
    for item, text in items:
        scores = []
        for i, tf, n in found:
            if n:
                m = 25 + 75 * n * documents // total
                part = [
                    math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                    for t in terms(text)
                    if t in tf
                ]
                if sum(part) > 0:
                    scores.append((-sum(part), i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(map(repr, out))


def frames(spark, docs, items):
    schema = "doc_id long, text string, item_id string, score string, n int"
    left = spark.createDataFrame([(i, t, "clash", "clash", 1) for i, t in docs], schema).repartition(4)
    right = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int").repartition(2)
    return left, right


def rows(frame):
    return sorted(repr(tuple(r)) for r in frame.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("block_bytes", [40, 1 << 20])
def test_whole_tables(spark, odd_texts, block_bytes):
    rng = random.Random(3)
    vocabulary = ["the", "of", "The", "é", "É", "naïve", "a1", "1", "x-y", "日本", "w17", "don't", "rare", "a", "a a"]
    texts = [*odd_texts, *(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 80))) for _ in range(120))]
    texts += [texts[-1]] * 5
    docs = list(enumerate(texts)) + [(3, "rare a1 twice"), (3, "rare a1 twice"), (None, "rare"), (None, "rare")]
    items = [
        (0, "the rare of rare"), (1, None), (2, ""), (3, "... !"), (4, "absent term"), (5, "A1/1 x-Y"), (5, "a1"), (None, "日本 é É"),
        (6, " ".join(vocabulary * 4)), (7, "w17"), (7, "w17"), (8, "a"),
    ]
    found = ranked(*frames(spark, docs, items), block_bytes=block_bytes)
    assert rows(found) == brute(docs, items)


def test_k_larger_than_the_table_and_ties(spark):
    docs = [(i, "same words here" if i % 3 else "other") for i in range(30)]
    items = [(1, "same"), (2, "other same"), (3, "here here words")]
    for k in (1, 4, 100):
        assert rows(ranked(*frames(spark, docs, items), k=k)) == brute(docs, items, k)


def test_empty_tables(spark):
    assert rows(ranked(*frames(spark, [], [(1, "a")]))) == []
    assert rows(ranked(*frames(spark, [(1, "a")], []))) == []
    assert rows(ranked(*frames(spark, [(1, None), (2, "!")], [(1, "a")]))) == []


def test_guards_find_whole_terms_only():
    automaton = pickle.loads(pickle.dumps(automaton_of(["a", "ab", "b", "é", "日本"])))
    found = Counter(n for _, n in automaton.iter(" a a ab b  b é 日本 日 aé "))
    assert found == {0: 2, 1: 1, 2: 2, 3: 1, 4: 1}
