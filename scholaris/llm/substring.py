"""Exact substring dedup: words inside any window of 35 words that occurs twice go.

A window is represented by its anchor, the eight-word gram of least digest within it. Two
equal windows have equal anchors at equal offsets, and different starts have different
anchor places or offsets, so an anchor occurs at least as often as any window it stands
for. An anchor's windows start one after another: there are about a fifteenth as many
anchors as windows.

First pass: every task adds its anchors to a count-min sketch of two rows; the partition
sketches are merged, cell by cell, by a shuffle. A cell only has to tell "once" from "more".
Estimates can only be too high. Second pass: windows whose anchor is estimated repeated,
and no others, are grouped exactly. Anchors whose words all around are the same have all
their windows in common; where an anchor stands in several surroundings, its windows are
compared one by one, one place of each surrounding for all. Digests that are compared have
128 bits together.

The sketch has a fixed size, whatever the input: where many more anchors than cells make
it useless, more windows go to the second pass, and the result stays the same.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.llm.arrow import map_batches, small_batches, text_key, texts
from scholaris.sources.workspace import intermediate_tables, new_path, stored

WINDOW = 35
# Words of an anchor: a power of two, at most WINDOW.
GRAM = 8
# The sketch: two rows of 2**26 cells. What is broadcast is one bit a cell, 16 MB in all.
CELL_BITS = 26
ROWS = 2
SHARD_BITS = 16
SEGMENT = 1 << 18

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One digest for each pair of digests; the order of the two matters."""
    x = a * _A
    x ^= x >> np.uint64(32)
    x += b
    x *= _B
    x ^= x >> np.uint64(29)
    return x


def _digests(h: np.ndarray, length: int, memo: dict[int, np.ndarray]) -> np.ndarray:
    """Digests of all runs of `length` words, put together from runs of half the length."""
    if length not in memo:
        half = 1 << (length - 1).bit_length() - 1
        a, b = _digests(h, half, memo), _digests(h, length - half, memo)
        memo[length] = _mixed(a[: len(h) - length + 1], b[half : half + len(h) - length + 1])
    return memo[length]


def _least_places(g: np.ndarray, width: int) -> np.ndarray:
    """For every window of `width` entries, the place of the leftmost least one."""
    places, size = np.arange(len(g), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        left, right = places[: len(places) - step], places[step:]
        places = np.where(g[right] < g[left], right, left)
        size += step
    return places


class _WordDigests(dict):
    """XXH3 digests of words, kept for words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        self[word] = digest = xxhash.xxh3_64_intdigest(word)
        return digest


class Windows:
    """The windows of a batch of texts, in segments of bounded size.

    Windows are numbered by their first word, counted over the batch.
    """

    def __init__(self, batch_texts: list[bytes], cache: dict, window: int):
        words = [text.split() for text in batch_texts]
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        total = int(self.starts[-1])
        self.digests = np.fromiter((cache[w] for text in words for w in text), np.uint64, total)
        self.window = window

    def segments(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(first words, digests) of windows; (first window, digest, offset in it) of their anchors."""
        gram = min(GRAM, self.window)
        rooms = np.repeat(self.starts[1:], self.lengths)
        for at in range(0, max(0, len(self.digests) - self.window + 1), SEGMENT):
            h = self.digests[at : at + SEGMENT + self.window - 1]
            first = np.arange(at, at + len(h) - self.window + 1)
            inside = first + self.window <= rooms[first]
            if not inside.any():
                continue
            memo = {1: h}
            grams = _digests(h, gram, memo)
            places = _least_places(grams, self.window - gram + 1)[inside]
            runs = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
            first, digests = first[inside], _digests(h, self.window, memo)[inside]
            yield first, digests, runs, grams[places[runs]], places[runs] + at - first[runs]


def _cells(anchors: np.ndarray) -> list[np.ndarray]:
    """The anchor's cell in each row of the sketch."""
    x = _mixed(anchors, anchors)
    return [((x >> np.uint64(row * 32)) & np.uint64((1 << CELL_BITS) - 1)).astype(np.uint32) for row in range(ROWS)]


def _at_most_two(cells: list[np.ndarray]) -> list[np.ndarray]:
    """Cells sorted, each at most twice: more is not told apart."""
    values, counts = np.unique(np.concatenate(cells), return_counts=True)
    return [np.repeat(values, np.minimum(counts, 2))]


def repeated_cells(docs: DataFrame, text_column: str = "text", window: int = WINDOW) -> list[np.ndarray]:
    """For each row of the merged sketch, one bit a cell: it counted two anchors or more.

    Each task sends its cells by shard of 2**16 cells; a merging task holds one byte a cell
    of the shards it gets. The driver receives the bits, 16 MB for any input.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, rows, size = _WordDigests(), [[] for _ in range(ROWS)], 0
        for batch in small_batches(batches, "text"):
            for _, _, _, anchors, _ in Windows(texts(batch.column(0)), cache, window).segments():
                for row, cells in zip(rows, _cells(anchors), strict=True):
                    row.append(cells)
                size += len(anchors)
                if size > 1 << 20:
                    rows = [_at_most_two(row) for row in rows]
                    size = 0
        shards, payloads = [], []
        for number, row in enumerate(rows):
            if not row:
                continue
            cells = _at_most_two(row)[0]
            shard = cells >> SHARD_BITS
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for part in np.split(cells, cuts):
                shards.append((number << (CELL_BITS - SHARD_BITS)) + int(part[0] >> SHARD_BITS))
                payloads.append(part.astype(np.uint16).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(payloads, pa.binary())], ["shard", "cells"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.bincount(np.frombuffer(cells, np.uint16), minlength=1 << SHARD_BITS).astype(np.uint8)
                counts[shard] = np.minimum(counts[shard] + found, 2) if shard in counts else found
        for shard, count in counts.items():
            bits = np.packbits(count > 1).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([bits], pa.binary())], ["shard", "bits"])

    parts = map_batches(docs.select(F.col(text_column).alias("text")), sketch, "shard int, cells binary")
    merged = map_batches(parts.repartition("shard"), merge, "shard int, bits binary")
    found = np.zeros(ROWS << CELL_BITS - 3, np.uint8)
    size = 1 << SHARD_BITS - 3
    for shard, bits in merged.collect():
        found[shard * size : (shard + 1) * size] = np.frombuffer(bits, np.uint8)
    return np.split(found, ROWS)


def repeated_windows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, key, runs array<struct<first, n>>): the windows of each row that occur elsewhere too.

    `key` is `text_key`; a run is n windows that start at words first, first + 1 and so on,
    counted from 0. Rows without such windows are left out. Repeated rows share an id and
    key: each has its windows repeated by the others, and all have one list, of each run once.
    """
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(repeated_cells(docs, text_column, window))
    rows = docs.select(
        F.col(id_column).alias("id"), text_key(id_column, text_column).alias("key"), F.col(text_column).alias("text")
    )
    kind = rows.schema["id"].dataType.simpleString()

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, repeated = _WordDigests(), bits.value
        names = ["id", "key", "first", "anchor", "around", "windows"]
        for batch in small_batches(batches, "text"):
            all_windows = Windows(texts(batch.column(2)), cache, window)
            for first, digests, runs, anchors, offsets in all_windows.segments():
                likely = np.ones(len(anchors), bool)
                for cells, row in zip(_cells(anchors), repeated, strict=True):
                    likely &= (row[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8) & 1).astype(bool)
                sizes = np.diff(np.append(runs, len(first)))
                begin, size = runs[likely], sizes[likely]
                # The first and the last window of an anchor overlap: they are all the words around it.
                ends = _mixed(digests[begin], digests[begin + size - 1])
                around = _mixed(ends, (offsets[likely] * window + size).astype(np.uint64))
                text = np.searchsorted(all_windows.starts, first[begin], side="right") - 1
                windows = digests[np.repeat(likely, sizes)].view(np.int64)
                take = pa.array(text)
                columns = [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array((first[begin] - all_windows.starts[text]).astype(np.int32)),
                    pa.array(anchors[likely].view(np.int64)),
                    pa.array(around.view(np.int64)),
                    pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(size))).astype(np.int32), windows),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {kind}, key long, first int, anchor long, around long, windows array<long>"
    path = new_path(spark, "repeated")
    with intermediate_tables(spark):
        found = stored(map_batches(rows, candidates, schema), "anchors")
        place = F.struct("key", "first")
        # One row an anchor and surrounding; a frequent one leaves each task as one row.
        around = stored(found.groupBy("anchor", "around").agg(F.count("*").alias("n"), F.min(place).alias("one")), "around")
        # Written down, so that the join with it may split an anchor of very many surroundings.
        mixed = stored(around.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"), "mixed")
        kinds = around.join(mixed, "anchor", "left").where("n > 1 or kinds is not null")
        # Of a surrounding met more than once, all windows are known: one place stands for it.
        compared = F.col("kinds").isNotNull() & ((F.col("n") == 1) | (place == F.col("one")))
        met = found.join(kinds, ["anchor", "around"]).select(
            "id", "key", "first", "anchor", "n", F.size("windows").alias("size"), F.when(compared, F.col("windows")).alias("windows")
        )
        met = stored(met, "met")
        whole = met.where("n > 1").select("id", "key", "first", F.col("size").alias("n"))
        single = met.select("id", "key", "first", "n", "anchor", F.posexplode("windows").alias("i", "window"))
        twice = single.groupBy("anchor", "window").count().where("count > 1")
        parts = single.where("n = 1").join(twice.select("anchor", "window"), ["anchor", "window"], "left_semi")
        parts = parts.select("id", "key", (F.col("first") + F.col("i")).alias("first"), F.lit(1).alias("n"))
        # A set: every task leaves the runs of rows that share an id and key once, however many rows there are.
        repeated = whole.union(parts).groupBy("id", "key").agg(F.collect_set(F.struct("first", "n")).alias("runs"))
        repeated.write.parquet(path)
    return spark.read.schema(repeated.schema).parquet(path)


def _kept(text: bytes, runs: list[dict] | None, window: int) -> tuple[int, int, list[bytes]]:
    words = text.split()
    steps = np.zeros(len(words) + 1, np.int64)
    for run in runs or ():
        steps[run["first"]] += 1
        steps[run["first"] + run["n"] - 1 + window] -= 1
    gone = np.cumsum(steps)[:-1] > 0
    if not gone.any():
        return len(words), 0, words
    return len(words), int(gone.sum()), [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def _with_runs(docs: DataFrame, id_column: str, text_column: str, window: int) -> DataFrame:
    """`docs` with a last column `__runs`, null where nothing repeats."""
    runs = repeated_windows(docs, id_column, text_column, window)
    runs = runs.select(F.col("id").alias("__id"), F.col("key").alias("__key"), F.col("runs").alias("__runs"))
    keyed = docs.withColumn("__key2", text_key(id_column, text_column))
    same = F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__key2") == F.col("__key"))
    return keyed.join(runs, same, "left").select(*docs.columns, "__runs")


def removed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row.

    Words are what ASCII white space separates. Every word inside a window that also starts
    anywhere else, in the same text or another, is removed; windows are judged on the
    input. The digest is of the kept words joined by single spaces. Null, empty and short
    texts have no windows and keep all; repeated rows repeat all their windows; an empty
    table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias(id_column), F.col(text_column).alias("text"))
    kind = rows.schema[id_column].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = []
            for text, runs in zip(texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                n, gone, kept = _kept(text, runs, window)
                found.append((n, gone, hashlib.sha256(b" ".join(kept)).hexdigest()))
            columns = [pa.array(x) for x in zip(*found, strict=True)]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [id_column, "n_words", "n_removed", "kept_sha256"])

    joined = _with_runs(rows, id_column, "text", window)
    return map_batches(joined, work, f"`{id_column}` {kind}, n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows with all their columns, their text without repeated windows.

    A text that loses words is its kept words joined by single spaces; any other text stays
    as it is, white space included.
    """
    at = docs.columns.index(text_column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_column):
            new = []
            for text, runs in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                if runs:
                    text = b" ".join(_kept(text.encode(), runs, window)[2]).decode()
                new.append(text)
            columns = [pa.array(new, x.type) if i == at else x for i, x in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    return map_batches(_with_runs(docs, id_column, text_column, window), work, docs.schema)
