"""Longest-match counts against cutting every word piece by piece."""

import random
import re

import public_tokenizers
import pytest
import sentencepiece

from scholaris.llm import tokencount
from scholaris.llm.queries import QUERIES
from scholaris.llm.tokencount import LongestMatch

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(word, starting, continuing):
    """The number of pieces of greedy cutting, 0 if some part fits no piece."""
    at, n = 0, 0
    while at < len(word):
        pieces = starting if at == 0 else continuing
        size = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in pieces), 0)
        if not size:
            return 0
        at, n = at + size, n + 1
    return n


@pytest.mark.parametrize("seed", range(8))
def test_counts_of_random_vocabularies(seed):
    rng = random.Random(seed)
    made = lambda n: {"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(n)}
    starting, continuing = made(12), made(12)
    match = LongestMatch(starting, continuing)
    for _ in range(3000):
        word = "".join(rng.choice("abcd" if rng.random() < 0.1 else "abc") for _ in range(rng.randint(1, 14)))
        assert match.count(word) == brute(word, starting, continuing), word


def test_every_character_is_read_once():
    """Each step back follows a link and takes off pieces, so there are at most as many as characters."""
    match = LongestMatch(["a" * 50], ["a"])
    assert match.count("a" * 50) == 1 and match.count("a" * 49) == 0
    match = LongestMatch(["a", "a" * 50], ["a"])
    assert match.count("a" * 100_000) == 1 + 100_000 - 50
    assert match.count("a" * 49) == 49


def vocabulary():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {p[1:] for p in pieces if p[0] == "▁"} - {""}, {p for p in pieces if "▁" not in p}


def test_table(spark, documents, odd_texts):
    starting, continuing = vocabulary()
    rows = tokencount.token_counts(documents(odd_texts), PATH).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(odd_texts)))
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", odd_texts[row.doc_id] or "")
        if all(len(w) < 1000 for w in words):
            counts = [brute(w, starting, continuing) for w in words]
            assert tuple(row[1:]) == (len(words), sum(counts) + counts.count(0), counts.count(0))


def test_odd_tables(spark, documents):
    assert tokencount.token_counts(documents([]), PATH).count() == 0
    rows = tokencount.token_counts(documents(["the", "the", None], [None, 1, 1]), PATH).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_tokens) for r in rows) == [(0, 1, 1), (1, 0, 0), (1, 1, 1)]


def brute_bytes(word, pieces, longest):
    """Greedy cutting of the marked word over one set of pieces, bytes where none fits."""
    word, at, n = "▁" + word, 0, 0
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces), 0)
        n += 1 if size else len(word[at].encode())
        at += max(size, 1)
    return n


@pytest.mark.parametrize("seed", range(8))
def test_lone_mark_and_bytes_in_random_vocabularies(seed):
    rng = random.Random(seed)
    made = lambda n, least: {"".join(rng.choice("abé") for _ in range(rng.randint(least, 6))) for _ in range(n)}
    starting, continuing = made(8, 1) | {""}, made(8, 2)
    match = LongestMatch(starting, continuing, by_bytes=True)
    pieces = {"▁" + p for p in starting} | continuing
    for _ in range(3000):
        word = "".join(rng.choice("日dé" if rng.random() < 0.2 else "abé") for _ in range(rng.randint(1, 14)))
        assert match.count(word) == brute_bytes(word, pieces, 7), word


def full_vocabulary():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    numbers = range(model.get_piece_size())
    return {model.id_to_piece(i) for i in numbers if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}


def test_the_query_counts_by_the_full_vocabulary(spark, documents, odd_texts, tmp_path):
    words = ["2016", "100,000", "中国人民大学生", "ñandú", "x🦄y", "🦄🦄", "▁a▁▁b", "\x00", "ﬁne", "é\u0301"]
    texts = [*words, *odd_texts]
    documents(texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op2_longest_match"](spark, str(tmp_path)).collect()}
    assert sorted(rows) == list(range(len(texts)))
    assert [rows[i].n_tokens for i in range(4)] == [5, 8, 8, 4]
    pieces = full_vocabulary()
    longest = max(map(len, pieces))
    for i, text in enumerate(texts):
        cut = [brute_bytes(w, pieces, longest) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        assert tuple(rows[i][1:]) == (len(cut), sum(cut), 0), text
