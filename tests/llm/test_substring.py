"""Substring dedup against a version that keeps every window as a tuple."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from scholaris.llm import substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, n=35):
    words = [WORD.findall(t or "") for t in texts]
    windows = Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1))
    found = []
    for w in words:
        gone = {j for i in range(len(w) - n + 1) if windows[tuple(w[i : i + n])] > 1 for j in range(i, i + n)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        found.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return found


def sharing(rng):
    """Texts that share passages of 34, 35, 36 and 80 words at all kinds of places."""
    def fresh(n):
        return [f"t{rng.getrandbits(40):x}" for _ in range(n)]

    passages = [fresh(n) for n in (34, 35, 36, 80)]
    texts = [" ".join(fresh(rng.randint(0, 50)) + p + fresh(rng.randint(0, 50))) for p in passages for _ in range(3)]
    twice = passages[1] + fresh(3) + passages[1]
    return [*texts, " ".join(twice), " ".join(passages[2]), " ".join(["again"] * 70), " ".join(["ab", "cd"] * 40), " ".join(fresh(34))]


def test_removed(spark, documents, odd_texts):
    texts = [*odd_texts, *sharing(random.Random(2))]
    rows = substring.removed(documents(texts)).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    expected = brute(texts)
    for row in rows:
        assert tuple(row[1:]) == expected[row.doc_id], texts[row.doc_id][:80]


@pytest.mark.parametrize("window", [1, 2, 5, 8, 13])
def test_other_window_lengths(spark, documents, window):
    rng = random.Random(window)
    texts = [" ".join(rng.choice("abcdef") + rng.choice("xyz") for _ in range(rng.randint(0, 30))) for _ in range(40)]
    rows = substring.removed(documents(texts), window=window).collect()
    assert {r.doc_id: tuple(r[1:]) for r in rows} == dict(enumerate(brute(texts, window)))


def test_segments_do_not_change_the_windows(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcd") for _ in range(n)).encode() for n in (0, 34, 35, 500, 36, 1000)]

    def rows():
        windows = substring.Windows(texts, substring._WordDigests(), 35)
        parts = []
        for first, digests, runs, anchors, offsets in windows.segments():
            which = np.cumsum(np.isin(np.arange(len(first)), runs)) - 1
            parts.append((first, digests, anchors[which], offsets[which] + first[runs][which]))
        return [np.concatenate(x) for x in zip(*parts, strict=True)]

    whole = rows()
    monkeypatch.setattr(substring, "SEGMENT", 97)
    assert all((a == b).all() for a, b in zip(whole, rows(), strict=True))


def test_a_full_sketch_changes_nothing(spark, documents, monkeypatch):
    """With far fewer cells than anchors every window goes to the exact pass."""
    texts = sharing(random.Random(8))
    monkeypatch.setattr(substring, "CELL_BITS", 17)
    monkeypatch.setattr(substring, "_cells", lambda anchors: [np.zeros(len(anchors), np.uint32)] * substring.ROWS)
    rows = substring.removed(documents(texts)).collect()
    assert {r.doc_id: tuple(r[1:]) for r in rows} == dict(enumerate(brute(texts)))


def test_odd_tables(spark, documents):
    assert substring.removed(documents([])).count() == 0
    text = " ".join(f"w{i}" for i in range(40))
    rows = substring.removed(documents([text, text, text + " x", None], [1, 1, None, None])).collect()
    assert sorted((r.doc_id is None, r.n_words, r.n_removed) for r in rows) == [(False, 40, 40), (False, 40, 40), (True, 0, 0), (True, 41, 40)]


def test_rows_of_one_id_with_other_texts_stay_apart(spark, documents):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = substring.removed(documents([a, b, a], [1, 1, 2])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (1, 40), (2, 40)]


def test_deduplicated_leaves_other_texts_alone(spark, documents):
    texts = [*sharing(random.Random(3)), "left  as\n it is ", None]
    rows = {r.doc_id: r for r in substring.deduplicated(documents(texts)).collect()}
    assert rows[len(texts) - 2].text == texts[-2] and rows[len(texts) - 1].text is None
    assert rows[0].fp == "clash" and len(rows) == len(texts)
    for i, (_, gone, digest) in enumerate(brute(texts)):
        if gone:
            assert hashlib.sha256(rows[i].text.encode()).hexdigest() == digest
        else:
            assert rows[i].text == texts[i]


def test_rows_that_share_id_and_text_list_each_run_once(spark, documents):
    rng = random.Random(7)
    words = lambda n: " ".join(f"c{rng.getrandbits(40):x}" for _ in range(n))
    copied, other = words(300), words(200)
    texts = [copied] * 40 + [other] * 30 + [words(100)]
    ids = [None] * 40 + [7] * 30 + [8]
    docs = documents(texts, ids)
    found = {r.id: r.runs for r in substring.repeated_windows(docs).collect()}
    assert set(found) == {None, 7}
    for runs, n in ((found[None], 300), (found[7], 200)):
        starts = [run.first + i for run in runs for i in range(run.n)]
        assert sorted(starts) == list(range(n - 34))
    rows = sorted((r.doc_id or 0, *r[1:]) for r in substring.removed(docs).collect())
    assert rows == sorted((i or 0, *x) for i, x in zip(ids, brute(texts), strict=True))
