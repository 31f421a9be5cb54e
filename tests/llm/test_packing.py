"""Packing: pieces against the library, places without gaps, few sequences, provable choices."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scholaris.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def laid_out(counts, capacity):
    """The sequences that the runs of `pack_counts` describe, as lists of lengths by offset."""
    sequences = defaultdict(dict)
    for length, runs in packing.pack_counts(counts, capacity).items():
        for i in range(counts[length]):
            before, sequence, each, offset = [r for r in runs if r[0] <= i][-1]
            number, at = sequence + (i - before) // each, offset + (i - before) % each * length
            assert at not in sequences[number]
            sequences[number][at] = length
    for places in sequences.values():
        at = 0
        for offset in sorted(places):
            assert offset == at
            at += places[offset]
        assert at <= capacity
    return [[p[o] for o in sorted(p)] for p in sequences.values()]


def fewest(pieces, capacity):
    """The least number of sequences, by trying all (small instances only)."""
    pieces = sorted(pieces, reverse=True)

    def fits(bins, i):
        if i == len(pieces):
            return True
        for j in sorted(set(bins)):
            if j >= pieces[i]:
                rest = list(bins)
                rest.remove(j)
                if fits([*rest, j - pieces[i]], i + 1):
                    return True
        return False

    n = -(-sum(pieces) // capacity)
    while not fits([capacity] * n, 0):
        n += 1
    return n


@pytest.mark.parametrize("seed", range(6))
def test_counts_are_packed_whole_and_tightly(seed):
    rng = random.Random(seed)
    capacity = 512
    pieces = [min(capacity, int(rng.lognormvariate(4, 1.2)) + 1) for _ in range(5000)]
    pieces += [capacity] * 30 + [rng.choice([100, 101, 200])] * 3000
    sequences = laid_out(dict(Counter(pieces)), capacity)
    assert Counter(x for s in sequences for x in s) == Counter(pieces)
    assert len(sequences) <= 1.03 * sum(pieces) / capacity + 2


@pytest.mark.parametrize("seed", range(40))
def test_a_dominant_set_never_costs_a_sequence(seed):
    rng = random.Random(seed)
    capacity = rng.choice([20, 30, 50])
    pieces = [rng.randint(max(1, capacity // 6), capacity) for _ in range(9)]
    counts = packing.Counts(dict(Counter(pieces)))
    best = fewest(pieces, capacity)
    for j in counts.lengths:
        chosen = packing.dominant_set(counts, j, capacity)
        if chosen is not None:
            rest = list(pieces)
            for x in [j, *chosen]:
                rest.remove(x)
            assert sum([j, *chosen]) <= capacity
            assert fewest(rest, capacity) + 1 == best
    assert len(laid_out(dict(Counter(pieces)), capacity)) <= best + 1


def test_cases_of_the_reduction():
    assert packing.dominant_set(packing.Counts({90: 1, 20: 2}), 90, 100) == []
    assert packing.dominant_set(packing.Counts({60: 1, 40: 1, 10: 9}), 60, 100) == [40]
    assert packing.dominant_set(packing.Counts({60: 1, 30: 1, 25: 1}), 60, 100) == [30]
    assert packing.dominant_set(packing.Counts({50: 1, 26: 1, 24: 1, 23: 1}), 50, 100) == [26, 24]
    assert packing.dominant_set(packing.Counts({50: 1, 5: 20}), 50, 100) is None
    assert packing.dominant_set(packing.Counts({50: 2}), 50, 100) == [50]


def placed(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == list(np.cumsum([0] + [n for _, n in pieces[:-1]]))
        assert sum(n for _, n in pieces) <= capacity
    return sequences


def test_documents(spark, documents, odd_texts):
    texts = [*odd_texts, *[f"short {i % 3}" for i in range(300)], "a <|endoftext|> b", "<|ENDOFTEXT|>", "x<|startoftext|>\u0301"]
    tokenizer = Tokenizer.from_file(PATH)
    rows = packing.packed_documents(documents(texts), PATH).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert sorted(pieces) == list(range(len(texts)))
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == list(range(0, len(ids), 4096))
        assert [r.length for r in own] == [len(ids[r.start : r.start + 4096]) for r in own]
        assert [r.ids_crc32 for r in own] == [zlib.crc32(np.array(ids[r.start : r.start + 4096], "<u4").tobytes()) for r in own]
    sequences = placed(rows, 4096)
    assert len(sequences) <= sum(r.length for r in rows) / 4096 * 1.02 + 1


def test_rows_keep_their_columns_and_odd_lengths_have_no_place(spark):
    lengths = [None, 0, -3, 11, *[7] * 50, *[3] * 50, 10]
    clashing = "id int, length int, runs string, offset string, sequence_id string, count string, __n string"
    rows = spark.createDataFrame([(i, n, "x", "x", "x", "x", "x") for i, n in enumerate(lengths)], clashing)
    frame = packing.packed(rows, capacity=10)
    assert frame.columns == ["id", "length", "runs", "count", "__n", "sequence_id", "offset"]
    found = frame.collect()
    assert all((r.runs, r["count"], r["__n"]) == ("x", "x", "x") for r in found)
    assert sorted(r.id for r in found) == list(range(len(lengths)))
    assert all((r.sequence_id is None) == (r.length not in (7, 3, 10)) for r in found)
    assert len(placed([r for r in found if r.sequence_id is not None], 10)) == 51
    assert packing.packed(rows.limit(0), capacity=10).count() == 0


def test_the_search_for_the_fewest_sequences():
    assert fewest([6, 5, 5, 4], 10) == 2 and fewest([6, 6, 6], 10) == 3
