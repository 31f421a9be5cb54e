"""Base measures against plain Python; verdicts on text that must go and text that must stay."""

import base64
import random
import re
import string
from collections import Counter

import pytest
import zstandard

from scholaris.llm import quality
from scholaris.llm.quality import Bands, Measure, measured

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def test_base_measures(spark, documents, odd_texts):
    rows = measured(documents(odd_texts)).collect()
    assert len(rows) == len(odd_texts)
    for row in rows:
        assert tuple(row[1:7]) == brute(odd_texts[row.doc_id]), row
        assert not (row.base_failed and row.kept)


def test_empty_table_and_null_ids(spark, documents):
    assert measured(documents([])).count() == 0
    rows = measured(documents(["a b", "a b", None], [None, 1, 1])).collect()
    assert sorted((r.doc_id is None, r.n_words, r.kept) for r in rows) == [(False, 0, False), (False, 2, False), (True, 2, False)]


def prose(rng, n):
    syllables = "the an re on er ti en es or te of ed is it al ar st to nt ng".split()
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(300)]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.mark.parametrize("n", [60, 400, 3000, 20000])
def test_bands(n):
    rng = random.Random(n)
    measure = Measure(Bands())
    clean = prose(rng, n)
    assert measure(clean.encode())[-1]
    noise = " ".join(base64.b64encode(rng.randbytes(24)).decode() for _ in range(n))
    if n >= 400:
        assert not measure(noise.encode())[-1]
        repeated = " ".join(f"{i} all rights reserved by the owner of this page and its parts" for i in range(n))
        assert not measure(repeated.encode())[-1]
        half = clean + " " + " ".join("A" * 200 for _ in range(n))
        assert not measure(half.encode())[-1]


def test_ratio_of_the_whole_text():
    measure = Measure(Bands())
    text = b"word " * 5000 + b"z"
    row = measure(text)
    assert row[7] == len(text) / len(zstandard.ZstdCompressor(level=3).compress(text))
    assert row[8] == len(text) // 4096


def test_kept_returns_the_rows_as_they_were(spark, documents, odd_texts):
    texts = [*odd_texts, prose(random.Random(1), 200)]
    docs = documents(texts)
    rows = quality.kept(docs)
    assert rows.schema == docs.schema
    expected = {r.doc_id for r in measured(docs).where("kept").collect()}
    assert {r.doc_id for r in rows.collect()} == expected and len(texts) - 1 in expected
    assert all(r.text == texts[r.doc_id] and r.kept == "clash" for r in rows.collect())


def noise_words(rng, n_bytes):
    letters = string.ascii_letters + string.digits
    words = " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 10))) for _ in range(n_bytes // 3))
    return words[:n_bytes]


@pytest.mark.parametrize("n", [256, 320, 384, 448, 512, 600, 640, 768, 900, 1020, 1536, 2048, 3000, 4090, 6000, 16384, 40000])
def test_noise_and_half_noise_of_every_band(n):
    rng = random.Random(n)
    measure = Measure(Bands())
    assert all(measure(prose(rng, n)[:n].encode())[-1] for _ in range(5) if n >= 400)
    for _ in range(20):
        clean, noise = prose(rng, n)[: n // 2], noise_words(rng, n)
        for text in (noise, clean + " " + noise[: n // 2], noise[: n // 2] + " " + clean):
            assert not measure(text.encode())[-1], text


def test_chunks_cover_the_text():
    measure = Measure(Bands())
    for n in (0, 1, 127, 255, 256, 383, 384, 2047, 2048, 5000, 16383, 16384, 18431, 18432, 40000):
        text = random.Random(n).randbytes(n)
        chunks = measure.chunks(text)
        size = 256 if n < 2048 else 512 if n < 16384 else 4096
        assert b"".join(chunks) == text
        assert all(len(x) == size for x in chunks[:-1])
        assert n < size or size // 2 <= len(chunks[-1]) < size * 3 // 2


LENGTHS = [400, 512, 640, 768, 1024, 1536, 2048, 4096, 9000, 16384, 40000, 70000]


@pytest.mark.parametrize("n", LENGTHS)
def test_templates_of_every_band(n):
    """Lines of one template with three changing numbers, which the base rules let through."""
    rng = random.Random(n)
    measure = Measure(Bands())
    for _ in range(10):
        words = " ".join("".join(rng.choice(string.ascii_lowercase) for _ in range(rng.randint(2, 8))) for _ in range(6))
        lines = [f"{rng.randint(0, 999)} {words} {rng.randint(0, 99)} {rng.randint(0, 9999)}" for _ in range(n // len(words) + 1)]
        text = "\n".join(lines)[:n]
        assert not measure(text.encode())[-1], text[:200]


@pytest.mark.parametrize("n", LENGTHS)
@pytest.mark.parametrize("times", [2, 3, 5])
def test_prose_written_several_times_over(n, times):
    rng = random.Random(n * times)
    measure = Measure(Bands())
    for _ in range(10):
        part = prose(rng, n)[: n // times]
        assert not measure(" ".join([part] * times).encode())[-1]


@pytest.mark.parametrize("n", LENGTHS)
def test_prose_stays_far_from_the_greatest_ratios(n):
    rng = random.Random(n)
    bands = Bands()
    measure = Measure(bands)
    for _ in range(10):
        text = prose(rng, n)[:n].encode()
        most = [limit[2] for limit in bands.limits if limit[0] <= len(text)][-1]
        assert measure(text)[-1] and measure.ratio(text) < most / 1.15
