"""The pipeline, stage by stage, against brute force on what each stage was given."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from test_packing import placed
from test_simhash import brute_components, brute_fingerprint
from test_substring import WORD, brute
from tokenizers import Tokenizer

import corpus_pipeline
from scholaris.llm.quality import BANDS, Measure

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def near(texts):
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    values = sorted(set(prints.values()))
    array = np.array(values, np.uint64)
    a, b = np.where(np.triu(np.bitwise_count(array[:, None] ^ array[None, :]) <= 3, 1))
    groups = brute_components(values, [(values[i], values[j]) for i, j in zip(a, b, strict=True)])
    least = {}
    for i in sorted(texts):
        least.setdefault(groups[prints[i]], i)
    return set(least.values())


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_stages(spark, size):
    directory = f"/root/testdata/{size}"
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    results = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, directory).collect(), docs.schema)
        assert docs.columns == COLUMNS
        results.append({r.doc_id: r.text for r in docs.collect()})
        assert len(results[-1]) == docs.count()
    first, second, third = results
    given = {r.doc_id: r.text for r in spark.read.parquet(f"{directory}/documents.parquet").collect()}
    measure = Measure(BANDS)
    assert first == {i: t for i, t in given.items() if measure((t or "").encode())[-1]} and len(first) < len(given)
    assert set(second) == near(first) and all(second[i] == first[i] for i in second) and len(second) < len(first)
    expected = dict(zip(second, brute(list(second.values())), strict=True))
    assert set(third) == set(second)
    for i, text in third.items():
        n, gone, _ = expected[i]
        assert text == second[i] if not gone else len(WORD.findall(text)) == n - gone
    assert any(gone for _, gone, _ in expected.values())
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, directory).collect()
    check_pieces(rows, third)


def check_pieces(rows, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    assert {(r.doc_id, r.start) for r in rows} == {(i, s) for i, x in ids.items() for s in range(0, len(x), 4096)}
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + 4096], "<u4")
        assert (r.length, r.ids_crc32) == (len(part), zlib.crc32(part.tobytes()))
    assert len(placed(rows, 4096)) <= sum(map(len, ids.values())) / 4096 * 1.02 + 1


def test_run_is_its_stages(spark):
    directory = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, directory).collect()
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, directory)
    check_pieces(rows, {r.doc_id: r.text for r in docs.collect()})


def test_an_empty_table_and_odd_rows(spark, documents, odd_texts):
    for texts in ([], odd_texts, [None], [""]):
        docs = documents(texts).select(COLUMNS)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.columns == COLUMNS and docs.count() <= len(texts)
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "")
        assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}


def test_one_row_of_repeated_rows_stays(spark, documents):
    text = " ".join(f"w{i}" for i in range(80))
    docs = documents([text, text, text, "other words entirely"], [4, 4, None, 9])
    rows = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in rows) == [(0, text), (9, "other words entirely")]
