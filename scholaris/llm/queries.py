"""The registered queries of this package, with SQL for those that SQL can express."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholaris.llm import bytebpe, infill, lexscan, licenses, maxscore, packing, quality, simhash, substring, tokencount, tokenfiles, toxicity, urlfilter
from scholaris.llm.licensedigests import DIGESTS
from scholaris.llm.oracle import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


@query
def op1_simhash(spark: SparkSession, directory: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, directory, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))


@query
def op4_lazy_transducer(spark: SparkSession, directory: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bytebpe.round_trip(table(spark, directory, "documents"), path, public_tokenizers.PATTERN)


@query
def op5_redirect_aliases(spark: SparkSession, directory: str) -> DataFrame:
    return urlfilter.judged(table(spark, directory, "pages"), urlfilter.rules_frame(spark))


@query
def op6_maxscore(spark: SparkSession, directory: str) -> DataFrame:
    return maxscore.top_k(table(spark, directory, "embeddings"))


@query
def op7_patched_frame_files(spark: SparkSession, directory: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return tokenfiles.round_trip(table(spark, directory, "documents"), path)


@query
def op8_reduced_best_fit(spark: SparkSession, directory: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed_documents(table(spark, directory, "documents"), path)


@query
def op9_license_digests(spark: SparkSession, directory: str) -> DataFrame:
    known = spark.createDataFrame(list(licenses.KNOWN), "license string, text string")
    found = licenses.scanned(table(spark, directory, "documents"), known, known_digests=DIGESTS)
    return found.withColumn("notices", F.array_join("notices", ","))


@query
def op10_compression_bands(spark: SparkSession, directory: str) -> DataFrame:
    return quality.measured(table(spark, directory, "documents"))


@query
def op2_longest_match(spark: SparkSession, directory: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return tokencount.token_counts(table(spark, directory, "documents"), path, all_pieces=True)


@query
def op3_count_min_windows(spark: SparkSession, directory: str) -> DataFrame:
    return substring.removed(table(spark, directory, "documents"))


@query
def op11_fenwick_infill(spark: SparkSession, directory: str) -> DataFrame:
    found = infill.transformed(table(spark, directory, "documents"))
    back = infill.restored(F.col("output"), F.col("form"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")]
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query
def op12_automaton_search(spark: SparkSession, directory: str) -> DataFrame:
    return lexscan.ranked(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


@query
def op13_recurrent_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    return toxicity.scored(table(spark, directory, "documents"), table(spark, directory, "labels"))
