"""Windows, scoring against one window at a time, what is learned from, and held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scholaris.llm import gru, toxicity
from scholaris.llm.toxicity import Model, Scorer, Training, sample, scored, segments_of, starts_of, train, windows_of, words_of

SHAPE = gru.Shape(character=6, character_state=5, word=6, state=6, attention=4, window=8, step=6)
QUICK = Training(toxic_rows=150, clean_rows=300, windows=1200, first_passes=2, later_passes=3, rate=2e-2, vocabulary=300)


def model():
    return Model(gru.start(np.random.default_rng(3), SHAPE, 5), {"the": 1, "of": 2, "a": 3}, SHAPE, 1.5, -0.2)


def alone(m, text):
    """The greatest logit over windows that are run one by one, from words cut by plain Python."""
    words = list(words_of(text))
    best = []
    for first in range(0, max(len(words) - (SHAPE.window - SHAPE.step), 1), SHAPE.step):
        part = words[first : first + SHAPE.window]
        rows = m.rows(part) if part else np.zeros((1, 6 * SHAPE.state), np.float32)
        best.append(gru.window_logits(m.weights, rows, np.arange(max(len(part), 1))[None], np.array([len(part)]))[0][0])
    return max(best)


def test_scores_equal_windows_one_by_one(odd_texts):
    m = model()
    given = [(t or "").encode() for t in odd_texts if len(t or "") < 5000]
    expected = [alone(m, text) for text in given]
    assert Scorer(m)(given) == pytest.approx(expected, abs=1e-4)
    few = Scorer(m, most=40)
    assert np.concatenate([few(given[i : i + 3]) for i in range(0, len(given), 3)]) == pytest.approx(expected, abs=1e-4)
    assert len(Scorer(m)([])) == 0 and Scorer(m)([b""]) == pytest.approx([float(m.weights["out_bias"][0])])


@pytest.mark.parametrize("n", [0, 1, 2, 6, 7, 8, 9, 14, 15, 50])
def test_windows_cover_all_words_and_overlap(n):
    windows, lengths = windows_of(np.arange(1, n + 1), SHAPE)
    seen = [w[:k].tolist() for w, k in zip(windows, lengths, strict=True)]
    assert set().union(*seen) == set(range(1, n + 1))
    assert len(seen) == len(starts_of(n, SHAPE)) and all(len(w) == SHAPE.window for w in seen[:-1])
    assert all(a[-2:] == b[:2] for a, b in zip(seen, seen[1:], strict=False))


def test_a_long_text_in_parts_has_the_same_windows(monkeypatch):
    rng = random.Random(1)
    text = " ".join(f"wört{rng.randint(0, 99)}" for _ in range(5000)).encode()
    whole = list(words_of(text))
    monkeypatch.setattr(toxicity, "PIECE", 1000)
    assert list(words_of(text)) == whole
    for most in (SHAPE.step, 30, 31, 600, 10_000):
        parts = list(segments_of(text, SHAPE, most))
        expected = {tuple(whole[i : i + SHAPE.window]) for i in starts_of(len(whole), SHAPE)}
        found = {tuple(p[i : i + SHAPE.window]) for p in parts for i in starts_of(len(p), SHAPE)}
        assert found == expected
    joined = "語" * 5000
    assert "".join(words_of(joined.encode())) == joined


def corpus(n, seed):
    """Clean and toxic texts: insults of a list, and any word with a certain beginning."""
    rng = random.Random(seed)
    syllables = "an re on er ti en es or te of ed is it al ar st to nt ng ou".split()
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 60))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                bad = rng.choice(["vermin", "Louse!", "zogg" + rng.choice(syllables), "zogg" + rng.choice(syllables)])
                words.insert(rng.randint(0, len(words)), bad)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def tables(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, "clash", 7.0) for i, t in rows], "doc_id long, text string, score string, toxic double")
    return docs.repartition(4), spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, labels = corpus(1200, 5)
    extra = [(None, "null id"), (5000, None), (5001, ""), (3, rows[3][1]), (5002, "long " * 40_000 + "vermin louse zoggan")]
    found = scored(*tables(spark, rows + extra, labels), QUICK, SHAPE).collect()
    assert len(found) == len(rows) + len(extra)
    label, by_id = dict(labels), {}
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        by_id.setdefault(r.doc_id, []).append(r)
    assert len({r.score for r in by_id[3]}) == 1 and by_id[5000][0].score == by_id[5001][0].score
    assert by_id[5001][0].predicted == 0 and by_id[5002][0].predicted == 1
    held = [(label[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in label]
    caught = np.mean([p for y, p in held if y])
    false = np.mean([p for y, p in held if not y])
    assert len(held) > 300 and caught > 0.85 and false < 0.05


def test_sample_is_bounded_and_never_held_out(spark):
    rows, labels = corpus(300, 6)
    labels += [(0, 0), (1, None), (None, 1), (9999, 1)]
    rows += [(6, "a second text"), (7, "x" * 30_000)]
    few = Training(toxic_rows=20, clean_rows=30)
    picked = sample(*tables(spark, rows, labels), few, "doc_id", "text", "toxic").collect()
    assert sum(r.label for r in picked) <= 20 and len(picked) <= 50 and len({r.id for r in picked}) == len(picked)
    assert all(zlib.crc32(str(r.id).encode()) % 3 != 1 and len(r.text) <= 20_000 for r in picked)
    whole = sample(*tables(spark, rows, labels), Training(), "doc_id", "text", "toxic")
    assert {r.id for r in whole.collect()} == {i for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1}
    assert whole.where(F.col("id") == 0).first().label == 1


def test_empty_tables_and_one_class(spark):
    assert scored(*tables(spark, [], []), QUICK, SHAPE).count() == 0
    found = scored(*tables(spark, [(1, "a"), (2, None)], [(1, 1)]), QUICK, SHAPE).collect()
    assert len(found) == 2 and all(0 <= r.score <= 1 for r in found)


def test_training_is_repeatable():
    rows, labels = corpus(90, 8)
    once, again = (train([t.encode() for _, t in rows], np.array([y for _, y in labels]), QUICK, SHAPE) for _ in range(2))
    assert all((once.weights[k] == again.weights[k]).all() for k in once.weights) and once.offset == again.offset
