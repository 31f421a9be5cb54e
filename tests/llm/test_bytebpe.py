"""Encoding against tiktoken, decoding against the bytes, the border rule against the merges."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from scholaris.llm import bytebpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = (
    "aAbBzZ éÉßẞüÜñÑçſĶ̌ jJ 'sSt'tmM\"#$%&--__09½²٣あ漢\U0001f642"
    "\t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　ĲĳΣςσİı\xaa\xd7\xf7<|endoftext|>"
)


def library(path=PATH):
    ranks = bytebpe.read_ranks(path)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bytebpe.Encoder(PATH, public_tokenizers.PATTERN)


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


def test_ids_are_the_librarys(encoder, odd_texts):
    rng = random.Random(3)
    texts = [t or "" for t in odd_texts]
    texts += ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    texts += ["".join(rng.choice("the a in on re er") for _ in range(rng.randint(1, 40))) for _ in range(4000)]
    texts += ["a" * 3000, "#" * 3000, " " * 3000, "\n" * 999 + "x", "  x", "x \n y", "\r\n\r\n z"]
    known = library()
    for text in texts:
        assert numbers(encoder.ids(text)) == known.encode_ordinary(text), ascii(text[:80])


def test_another_vocabulary_and_small_stores():
    small = bytebpe.Encoder(MULTI, public_tokenizers.PATTERN, most=20)
    small.transducer.most_states = small.transducer.most_pairs = 50
    known, rng = library(MULTI), random.Random(4)
    for _ in range(800):
        text = "".join(rng.choice(ALPHABET + "einerunddiela") for _ in range(rng.randint(1, 60)))
        assert numbers(small.ids(text)) == known.encode_ordinary(text), ascii(text)


def test_borders_hold_exactly_where_the_merges_leave_them(encoder):
    merges, rng = encoder.transducer.merges, random.Random(5)
    for _ in range(6000):
        a, b = rng.randrange(50256), rng.randrange(50256)
        assert merges.compatible(a, b) == (merges.apply(merges.bytes[a] + merges.bytes[b]) == [a, b])


def test_tokens_are_emitted_while_the_text_still_comes(encoder):
    transducer, state, out = encoder.transducer, encoder.transducer.start, b""
    for _ in range(400):
        for byte in b"qzx1":
            state, emitted = transducer._move(state, byte)
            out += emitted
    assert len(out) > 4 * 400


def test_decoding(encoder, odd_texts):
    words = bytebpe.vocabulary(PATH)
    for text in [t or "" for t in odd_texts] + ["é漢\U0001f642" * 50]:
        ids = np.frombuffer(encoder.ids(text), "<u4")
        for chunk in (1, 3, 1 << 16):
            parts = list(bytebpe.decoded(ids, words, chunk)) if chunk > 1 or len(ids) < 5000 else []
            if parts:
                assert b"".join(p for p, _ in parts).decode() == text
                assert parts[-1][1] == bytebpe.START and all(s != bytebpe.BROKEN for _, s in parts)


def test_the_utf8_machine_agrees_with_python():
    rng = random.Random(6)
    for _ in range(20_000):
        data = bytes(rng.choice([0x41, 0x80, 0x9F, 0xA0, 0xBF, 0xC1, 0xC3, 0xE0, 0xE2, 0xED, 0xEF, 0xF0, 0xF4, 0xF5]) for _ in range(rng.randint(0, 5)))
        state = bytebpe.START
        for byte in data:
            state = bytebpe.utf8_next(state, byte)
        try:
            data.decode()
            assert state == bytebpe.START
        except UnicodeDecodeError:
            assert state != bytebpe.START


def test_broken_sequences_are_seen(encoder):
    words, ranks = bytebpe.vocabulary(PATH), encoder.transducer.ranks
    lead, follow, letter = (ranks[x] for x in (b"\xc3", b"\xa9", b"a"))
    end = lambda ids: list(bytebpe.decoded(np.array(ids), words))[-1][1]
    assert end([lead, follow, letter]) == bytebpe.START
    assert end([lead, letter, letter]) == end([follow]) == end([letter, lead, letter, lead, follow]) == bytebpe.BROKEN
    assert end([letter, lead]) not in (bytebpe.START, bytebpe.BROKEN)
    assert bytebpe.decode_text([lead, follow, lead], words) == "é\ufffd"


def test_round_trip(spark, documents, odd_texts):
    known = library()
    rows = bytebpe.round_trip(documents(odd_texts), PATH, public_tokenizers.PATTERN).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(odd_texts)))
    for row in rows:
        text = odd_texts[row.doc_id] or ""
        ids = np.array(known.encode_ordinary(text), "<u4")
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert row.valid and row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_tables(spark, documents):
    assert bytebpe.round_trip(documents([]), PATH, public_tokenizers.PATTERN).count() == 0
    rows = bytebpe.encoded(documents(["a b", "a b", None], [None, 1, 1]), PATH, public_tokenizers.PATTERN).collect()
    ids = library().encode_ordinary("a b")
    assert sorted((r.doc_id or 0, r.ids) for r in rows) == [(0, ids), (1, []), (1, ids)]
