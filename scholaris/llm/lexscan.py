"""Ranked lexical search that scans the documents for the items' terms.

The documents have no index. All terms of a block of items make one Aho-Corasick automaton,
each term between two guards, so that it is found as a whole term only. The automaton is
broadcast; every document, its terms set apart by guards as well, runs through it once and
the outputs are its term frequencies. Document frequencies and lengths are summed from
these, and the outputs are mapped to items: each task keeps the best documents of each
item, and the tasks' best are merged.
"""

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholaris.llm.arrow import map_batches, small_batches, texts
from scholaris.sources.workspace import stored

K = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Terms: runs of ASCII letters and digits and of everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Bytes of the terms in one automaton, and so of what is broadcast and collected at a time.
BLOCK_BYTES = 4 << 20
# Scores that a task adds up at a time.
CELLS = 1 << 20
GUARD = " "


def _folding() -> bytes:
    """By byte: what separates terms becomes a guard, A to Z become small, all else stays."""
    table = bytearray(b" " * 128) + bytearray(range(128, 256))
    for byte in (*range(0x30, 0x3A), *range(0x61, 0x7B)):
        table[byte] = byte
    for byte in range(0x41, 0x5B):
        table[byte] = byte + 32
    return bytes(table)


FOLDING = _folding()


def automaton_of(terms: list[str]) -> ahocorasick.Automaton:
    """Finds each of the terms between guards; the output is its place in the list."""
    automaton = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        automaton.add_word(f"{GUARD}{term}{GUARD}", number)
    if terms:
        automaton.make_automaton()
    return automaton


def hits(docs: DataFrame, automaton, n_terms: int, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, n long, terms array<int>, tfs array<int>) of every document: its length in terms and its item terms."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton.value
        number = itemgetter(1)
        for batch in small_batches(batches, "text"):
            lengths, keys = [], []
            for row, text in enumerate(texts(batch.column(1))):
                folded = text.translate(FOLDING)
                lengths.append(len(folded.split()))
                if n_terms:
                    outputs = found.iter(f"{GUARD}{folded.decode()}{GUARD}")
                    keys.append(np.fromiter(map(number, outputs), np.int64) + row * n_terms)
            each, tfs = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
            row, term = np.divmod(each, max(n_terms, 1))
            offsets = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (term, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"])

    return map_batches(rows, work, "doc_id long, n long, terms array<int>, tfs array<int>")


class Postings:
    """For each term its items and how often they hold it, one term after another."""

    def __init__(self, items: list[list[str]]):
        held = [Counter(terms) for terms in items]
        self.terms = sorted({term for terms in held for term in terms})
        number = {term: i for i, term in enumerate(self.terms)}
        rows = sorted((number[term], item, n) for item, terms in enumerate(held) for term, n in terms.items())
        term, self.items, self.times = np.array(rows, np.int64).reshape(-1, 3).T
        self.lengths = np.bincount(term, minlength=len(self.terms))
        self.starts = np.cumsum(self.lengths) - self.lengths


def term_weights(terms: int, documents: int, holding: dict[int, int]) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2 df + 1))) of each term; `holding` has the df by term."""
    odds = [(2 * documents + 2) / (2 * holding.get(term, 0) + 1) for term in range(terms)]
    return np.array([math.floor(1000 * math.log(x)) for x in odds], np.int64)


def _scores(n: np.ndarray, lengths: np.ndarray, terms: np.ndarray, tfs: np.ndarray, postings: Postings, weights: np.ndarray, n_items: int, totals) -> np.ndarray:
    """Scores by document and item, of documents given by their lengths and their terms."""
    documents, all_terms = totals
    row = np.repeat(np.arange(len(n)), lengths)
    m = 25 + 75 * n * documents // all_terms
    part = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 8 * m[row]))
    width = postings.lengths[terms]
    before = np.cumsum(width) - width
    at = np.repeat(postings.starts[terms] - before, width) + np.arange(width.sum())
    scores = np.zeros(len(n) * n_items, np.int64)
    np.add.at(scores, np.repeat(row, width) * n_items + postings.items[at], np.repeat(part, width) * postings.times[at])
    return scores.reshape(len(n), n_items)


class Best:
    """The k best documents of each item so far; equal scores by ascending id, a null id last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.most_held = max(4 * k * n_items, 1 << 16)
        self.held, self.n_held = [np.zeros((4, 0), np.int64)], 0

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        self.held.append(np.stack((item, scores[row, item], ids[row], null[row])))
        self.n_held += len(row)
        if self.n_held > self.most_held:
            self.cut()

    def cut(self) -> np.ndarray:
        """(item, score, id, null id) in rows, at most k of an item."""
        rows = np.concatenate(self.held, axis=1)
        rows = rows[:, np.lexsort((rows[2], rows[3], -rows[1], rows[0]))]
        place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0])
        last = rows[:, place == self.k - 1]
        self.least[last[0]] = last[1]
        rows = rows[:, place < self.k]
        self.held, self.n_held = [rows], rows.shape[1]
        return rows


def best_of_tasks(found: DataFrame, postings, weights, totals: tuple[int, int], n_items: int, k: int) -> DataFrame:
    """(item int, doc_id, score): the k best of each item among each task's documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, table, weight = Best(n_items, k), postings.value, weights.value
        step = max(1, CELLS // n_items)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                terms, tfs = (np.asarray(part.column(c).flatten()).astype(np.int64) for c in (2, 3))
                lengths = np.asarray(pa.compute.list_value_length(part.column(2)))
                scores = _scores(np.asarray(part.column(1)), lengths, terms, tfs, table, weight, n_items, totals)
                ids = part.column(0)
                best.add(scores, np.asarray(ids.fill_null(0)), np.asarray(ids.is_null(), np.int64))
        item, score, ids, null = best.cut()
        columns = [pa.array(item, pa.int32()), pa.array(ids, mask=null.astype(bool)), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return map_batches(found, work, "item int, doc_id long, score long")


def item_terms(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(row, item_id, terms): the terms of each item, repeats included; `row` tells apart items of one id."""
    small = F.translate(F.coalesce(F.col(text_column), F.lit("")), UPPER, LOWER)
    terms = F.regexp_extract_all(small, F.lit(TERM), F.lit(0))
    return items.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("item_id"), terms.alias("terms"))


def ranked(
    docs: DataFrame, items: DataFrame, k: int = K, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank int, doc_id long, score long): each item's k documents of the highest scores above 0.

    Equal scores go by ascending document id, null ids last. Null and empty texts have no
    terms. Every row counts as a document and as an item of its own: rows that share an id,
    or are equal, are ranked side by side. Items without terms, or whose terms no document
    has, give no rows, as do empty tables. Other columns are neither read nor returned.

    Items are dealt into blocks of about `block_bytes` of terms by their size as it is
    counted first, and each block is one pass over the documents: what is collected and
    broadcast does not grow with either table. One item's own terms must fit in memory, as
    must one document's text.
    """
    spark = docs.sparkSession
    asked = stored(item_terms(items, item_column, item_text).where(F.size("terms") > 0), "items")
    length = F.aggregate("terms", F.lit(0).cast("long"), lambda total, term: total + F.octet_length(term) + 2)
    blocks = -(-(asked.agg(F.sum(length)).first()[0] or 0) // block_bytes)
    parts, totals = [], None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).collect()
        if not rows:
            continue
        postings = Postings([r["terms"] for r in rows])
        n_terms = len(postings.terms)
        automaton = spark.sparkContext.broadcast(automaton_of(postings.terms))
        found = stored(hits(docs, automaton, n_terms, id_column, text_column), "hits")
        if totals is None:
            totals = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        counts = found.select(F.explode("terms").alias("term")).groupBy("term").count()
        holding = {r["term"]: r["count"] for r in counts.collect()}
        weights = spark.sparkContext.broadcast(term_weights(n_terms, totals[0], holding))
        best = best_of_tasks(found, spark.sparkContext.broadcast(postings), weights, tuple(totals), len(rows), k)
        names = [(i, r["row"], r["item_id"]) for i, r in enumerate(rows)]
        kind = asked.schema["item_id"].dataType.simpleString()
        parts.append(best.join(F.broadcast(spark.createDataFrame(names, f"item int, row long, item_id {kind}")), "item"))
    if not parts:
        kind = asked.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    # The limit on the rank also holds within each task, before rows are shuffled by item.
    placed = whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return placed.select("item_id", "rank", "doc_id", "score")
