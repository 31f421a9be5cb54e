"""Ids against the library; blocks and files read back as they were written."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scholaris.llm import pfor, tokenfiles
from scholaris.llm.wordids import WordIds

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = (
    "aAbBzZ éÉßẞüÜñÑçſĶ̌́jJ 'sSt'tmM\"#$%&--__09½²٣あ漢\U0001f642"
    "\t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　ĲĳǅΣςσİı\xb5\xaa\xba\xd7\xf7<|endoftext|>"
)


def library():
    return Tokenizer.from_file(PATH)


def test_special_strings_are_tokens_as_they_stand():
    """Next to words, marks that compose, blanks and each other, in all cases of letters, whole and broken."""
    strings = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|endoftext|", "<|", "|>", "<|endof", "text|>"]
    around = ["", " ", "\n", "a", "É", "e", "\u0301", "'s", "'", "#", "<", "é", "\u3000", "9"]
    texts = [a + s + b + t + c for s in strings for t in strings[:3] for a in around for b in around for c in ("", "\u0301", " x")]
    words = WordIds(PATH)
    for text, found in zip(texts, library().encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(words.ids(text.encode()), "<u4").tolist() == found.ids, ascii(text)
    assert np.frombuffer(words.ids(b"a <|endoftext|> b"), "<u4").tolist() == [320, 49407, 321]


def test_ids_are_the_librarys(odd_texts):
    rng = random.Random(6)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 60))) for _ in range(5000)]
    made += ["<|endoftext|> x <|startoftext|>y", "don't we'll I'M ''s ''s 'S it's#'s a'b'c", "a" * 5000, "#" * 3000]
    texts = [*(t or "" for t in odd_texts), *made]
    words = WordIds(PATH, most_words=500, most_runs=200)  # so small that its stores are emptied again and again
    for text, found in zip(texts, library().encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(words.ids(text.encode()), "<u4").tolist() == found.ids, ascii(text)


@settings(max_examples=60, deadline=None)
@given(
    st.integers(0, 3000), st.sampled_from([1, 2, 300, 50_000, 1 << 32]), st.sampled_from([0, 50, 90, 99, 100]), st.randoms(use_true_random=False)
)
def test_blocks_round_trip(n, top, percentile, rng):
    numbers = np.array([rng.randrange(top) if rng.random() < 0.95 else rng.randrange(1 << 32) for _ in range(n)], np.uint32)
    image = pfor.encode(numbers, percentile)
    assert (pfor.decode(image) == numbers).all()
    a, b = sorted((rng.randint(0, n), rng.randint(0, n)))
    assert (pfor.decode(image, a, b) == numbers[a:b]).all()


def test_blocks_are_patched_and_small():
    numbers = np.full(10_000, 1_000_000, np.uint32) + np.arange(10_000, dtype=np.uint32) % 4
    numbers[::500] = 7
    numbers[1::500] = 4_000_000_000
    assert (pfor.decode(pfor.encode(numbers)) == numbers).all()
    assert len(pfor.encode(np.full(10_000, 5, np.uint32))) < 400
    with pytest.raises(ValueError):
        pfor.decode(b"x" * 100)


def expected(texts, ids):
    tokenizer, start, rows = library(), 0, []
    for i, text in sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is not None, x[0])):
        tokens = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        rows.append((i, start, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())))
        start += len(tokens)
    return rows


@pytest.mark.parametrize("image_ids", [1, 500, 1 << 20])
def test_files(spark, documents, odd_texts, image_ids, tmp_path):
    ids = random.Random(1).sample(range(10_000), len(odd_texts))
    path = f"file:{tmp_path}/files"
    tokenfiles.write(documents(odd_texts, ids), path, PATH, image_ids=image_ids)
    rows = tokenfiles.read(spark.read.parquet(path)).collect()
    assert sorted(map(tuple, rows)) == expected(odd_texts, ids)


def test_odd_tables(spark, documents):
    assert tokenfiles.round_trip(documents([]), PATH).count() == 0
    rows = tokenfiles.round_trip(documents(["b", "b", "a", None], [3, 3, None, 1]), PATH).collect()
    found = sorted(map(tuple, rows), key=lambda r: r[1])
    assert found == expected(["b", "b", "a", None], [3, 3, None, 1])


@pytest.mark.parametrize("hot", [7, None])
def test_a_hot_id_is_split_over_ranges(spark, partitions, tmp_path, hot):
    """A third of all rows under one id, or none, over eight ranges."""
    partitions(8)
    rows = [(hot if i % 3 == 0 else i, f"text {i % 50} of some words") for i in range(6000)]
    path = str(tmp_path / "files")
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    tokenfiles.write(docs, path, PATH)
    files = spark.read.parquet(path)
    sizes = [r.n for r in files.selectExpr("part", "size(ids) as n").groupBy("part").sum("n").toDF("part", "n").collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 2 * 6000 / 8
    found = tokenfiles.read(files).orderBy("start").collect()
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(found) == 6000
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:], strict=False))
