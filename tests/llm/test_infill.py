"""Fill-in-middle against plain slices, its tree against plain sums, and exact restoring."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from scholaris.llm.infill import Cutter, Fenwick, Rule, rearranged, restored, transformed


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(b"1:" + ("" if doc_id is None else str(doc_id)).encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_whole_table(spark, documents, odd_texts):
    marked = ["has <P> inside", "<S>", "a<M>", "<p> is no mark", "<P", "é" * 5000, "𝄞clef" * 3000, "<\nP>", "ends with <"]
    given = [*odd_texts, *marked] * 3
    docs = documents(given)
    assert transformed(docs).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    rows = transformed(docs).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == len(given) and {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        assert tuple(r[1:6]) == brute(r.doc_id, given[r.doc_id])
        assert r.back == (given[r.doc_id] or "")


def test_null_and_repeated_ids_and_no_rows(spark, documents):
    given = ["null id here", "null id here", "one text", "another, longer text"]
    rows = transformed(documents(given, [None, None, 7, 7])).collect()
    expected = [brute(i, t) for i, t in zip([None, None, 7, 7], given, strict=True)]
    assert sorted(map(repr, (tuple(r[1:]) for r in rows))) == sorted(map(repr, expected))
    assert transformed(documents([])).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 8, 9, 64, 100])
def test_tree_finds_the_block_of_every_unit(size):
    rng = np.random.default_rng(size)
    counts = rng.integers(0, 4, (2, size))
    tree = Fenwick(counts)
    owner = np.repeat(np.arange(size), counts[0])
    for unit, block in enumerate(owner):
        assert tree.find(unit) == (block, counts[0, :block].sum(), counts[1, :block].sum())


@pytest.mark.parametrize("block", [1, 2, 3, 5, 16, 4096])
def test_cuts_by_points_and_words(block):
    rng = random.Random(block)
    for _ in range(40):
        text = "".join(rng.choice(["a", "é", "日", "𝄞", " ", "\n", "  "]) for _ in range(rng.randint(0, 60)))
        raw = text.encode()
        points = Cutter(raw, "points", block)
        assert points.n_units == len(text)
        assert [points.cut(i) for i in range(len(text) + 1)] == [(len(text[:i].encode()), i) for i in range(len(text) + 1)]
        words = Cutter(raw, "words", block)
        starts = [m.start() for m in re.finditer(r"[^ \n]+", text)]
        edges = ([0] + starts[1:] if text else []) + [len(text)]
        assert words.n_units == len(edges) - 1
        assert [words.cut(i) for i in range(len(edges))] == [(len(text[:e].encode()), e) for e in edges]


def test_other_rules():
    text = b"one two three four"
    assert rearranged(text, 1, Rule(plain_from=0))[1] == "plain"
    n, form, before, middle, output = rearranged(text, 1, Rule(units="words", plain_from=100, suffix_first_below=100))
    assert (n, form) == (4, "spm") and output.startswith(b"<S>") and b"<P>" in output and middle + before <= len(text)
