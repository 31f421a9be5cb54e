"""SimHash near-duplicates, found by the generalised pigeonhole principle.

The 64 bits of a fingerprint are dealt into parts, and part i gets a threshold t(i) of its
own with sum(t(i) + 1) = k + 1, where -1 skips a part. Two fingerprints within k bits are
then within t(i) bits in some part: were every part further away, the distance would be
at least the sum of t(i) + 1. So it is enough to probe each part for values within its own
threshold and to verify the whole distance of what is found.

Correlated bits go to one part, which leaves the other parts more even. The thresholds
come out of a dynamic programme over estimated costs: the rows that probing a part at a
threshold makes, and the candidates that the counts of the part's values let expect.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.llm.arrow import map_batches, small_batches, text_key, texts
from scholaris.llm.components import components
from scholaris.sources.workspace import stored

BITS = 64
SHINGLE = 3
DISTANCE = 3
# A candidate is one comparison inside a join, a probe a row through a shuffle.
CANDIDATE_COST = 0.05
PART_COUNTS = (2, 3, 4)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit b is 1 if it is set in over half of the shingles' XXH64 digests (seed 42)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_digest
    hashed = b"".join(
        [digest(joined[s:e], 42) for s, e in zip(starts[:last].tolist(), ends[min(shingle, len(words)) - 1 :].tolist(), strict=True)]
    )
    counts = np.zeros(BITS, np.int64)
    rows = np.frombuffer(hashed, np.uint8).reshape(-1, 8)
    for at in range(0, len(rows), 1 << 16):
        counts += np.unpackbits(rows[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp long) of every row; a text without words, or null, has fingerprint zero.

    The long holds the 64 bits as a signed number. ASCII letters are lower-cased, words
    are what ASCII white space separates, a text of fewer words than a shingle is one
    shingle. Other columns are not read.
    """
    rows = docs.select(F.col(id_column).alias(id_column), F.col(text_column).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = np.array([fingerprint(x, shingle) for x in texts(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [id_column, "fp"])

    return map_batches(rows, work, f"`{id_column}` {rows.schema[id_column].dataType.simpleString()}, fp long")


@dataclass(frozen=True)
class Plan:
    """The parts, as lists of bit numbers, and the threshold of each."""

    parts: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _mask(bits) -> int:
    return sum(1 << b for b in bits)


def bit_counts(distinct: DataFrame) -> np.ndarray:
    """How many fingerprints have bits a and b set, as a 64 x 64 matrix, counted over all rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            values = np.ascontiguousarray(np.asarray(batch.column(0))).view(np.uint8).reshape(-1, 8)
            for at in range(0, len(values), 1 << 14):
                bits = np.unpackbits(values[at : at + (1 << 14)], axis=1, bitorder="little").astype(np.float64)
                total += (bits.T @ bits).astype(np.int64)
        a, b = np.triu_indices(BITS)
        yield pa.RecordBatch.from_arrays([pa.array(a * BITS + b), pa.array(total[a, b])], ["pair", "n"])

    matrix = np.zeros((BITS, BITS))
    for pair, n in map_batches(distinct.select("fp"), work, "pair long, n long").groupBy("pair").sum("n").collect():
        matrix[pair // BITS, pair % BITS] = matrix[pair % BITS, pair // BITS] = n
    return matrix


def correlated_parts(counts: np.ndarray, n: int, parts: int) -> tuple[tuple[int, ...], ...]:
    """The bits dealt into parts of nearly equal size, each grown by its most correlated bit."""
    p = np.diag(counts) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    correlation = np.abs(counts / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0)
    left, dealt = list(range(BITS)), []
    for k in range(parts):
        size = -(-len(left) // (parts - k))
        part = [max(left, key=lambda b: (correlation[b, left].max(), -b))]
        left.remove(part[0])
        while len(part) < size:
            part.append(max(left, key=lambda b: (correlation[b, part].sum(), -b)))
            left.remove(part[-1])
        dealt.append(tuple(sorted(part)))
    return tuple(dealt)


def allocate(costs: list[list[float]], total: int) -> tuple[float, tuple[int, ...]]:
    """Thresholds of least cost with sum(t + 1) = total; costs[i][t + 1] is part i's at t."""
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for part in costs:
        following: dict[int, tuple[float, tuple[int, ...]]] = {}
        for used, (cost, chosen) in best.items():
            for step, extra in enumerate(part):
                if used + step <= total:
                    option = (cost + extra, (*chosen, step - 1))
                    following[used + step] = min(following.get(used + step, option), option)
        best = following
    return best[total]


def plan(distinct: DataFrame, distance: int = DISTANCE) -> Plan:
    """Parts and thresholds for fingerprints `distinct` (column fp).

    Counts cover all rows: the bits' co-occurrence (2,080 numbers a task) and, for every
    part of every partitioning tried, the pairs of rows that share its value, summed by
    Spark. Pairs within t bits are estimated from those as for independent bits.
    """
    n = distinct.count()
    counts = bit_counts(distinct)
    options = [correlated_parts(counts, n, m) for m in PART_COUNTS if m <= distance + 1]
    options = options or [(tuple(range(BITS)),)]
    flat = [(k, i, part) for k, parts in enumerate(options) for i, part in enumerate(parts)]
    keys = F.explode(F.array(*[
        F.struct(F.lit(j).alias("j"), F.col("fp").bitwiseAND(F.lit(_signed(_mask(part)))).alias("value"))
        for j, (_, _, part) in enumerate(flat)
    ]))
    shared = distinct.select(keys.alias("k")).groupBy("k.j", "k.value").count().where("count > 1")
    pairs = dict(shared.groupBy("j").agg(F.sum(F.expr("count * (count - 1) / 2"))).collect())
    best = None
    for k, parts in enumerate(options):
        costs = []
        for part in parts:
            j = flat.index((k, parts.index(part), part))
            near, cost = 0, [0.0]
            for t in range(distance + 1):
                near += comb(len(part), t)
                rows = n * (1 + near if t else 1)
                cost.append(rows + CANDIDATE_COST * near * pairs.get(j, 0.0))
            costs.append(cost)
        found = (*allocate(costs, distance + 1), parts)
        best = min(best or found, found)
    return Plan(best[2], best[1])


def links(distinct: DataFrame, chosen: Plan, distance: int = DISTANCE) -> DataFrame:
    """(a, b) for every two fingerprints of `distinct` within the distance, a < b.

    A row appears once for every part that finds it. The verification is part of the join,
    so that candidates are compared where they meet and never become rows.
    """
    index, probes = [], []
    for i, (part, t) in enumerate(zip(chosen.parts, chosen.thresholds, strict=True)):
        flips = [_mask(bits) for size in range(t + 1) for bits in combinations(part, size)]
        probes += [(i, _mask(part), flip) for flip in flips]
        index += [(i, _mask(part), 0)] * (t >= 0)

    def keyed(name: str, keys: list[tuple[int, int, int]]) -> DataFrame:
        key = [
            F.struct(F.lit(i).alias("part"), F.lit(_signed(mask)).alias("mask"), F.lit(_signed(flip)).alias("flip"))
            for i, mask, flip in keys
        ]
        value = F.col("fp").bitwiseAND(F.col("k.mask")).bitwiseXOR(F.col("k.flip"))
        exploded = distinct.select("fp", F.explode(F.array(*key)).alias("k"))
        return exploded.select(F.col("fp").alias(name), F.col("k.part").alias("part"), value.alias("value"))

    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    a, b = keyed("a", probes), keyed("b", index)
    same = (a["part"] == b["part"]) & (a["value"] == b["value"])
    return a.join(b, same & near).select("a", "b")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """(id, fp long, component) of every row of `docs`.

    Rows are linked if their fingerprints differ in `distance` bits or fewer; the component
    is the least id that links lead to, the row's own included. Texts without words, nulls
    included, share fingerprint zero and are linked with it like any other. Equal
    fingerprints are one node, so copies cost nothing after the fingerprint; repeated rows
    and ids stay repeated. A null id never becomes a component unless its component holds
    no other. An empty table gives no rows; other columns are not read.
    """
    rows = stored(fingerprints(docs, id_column, text_column, shingle), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min(id_column).alias("least")), "distinct")
    found = components(links(distinct, plan(distinct, distance), distance))
    joined = stored(found.join(distinct, found["node"] == distinct["fp"]).select("node", F.col("component").alias("root"), "least"), "linked")
    names = joined.groupBy("root").agg(F.min("least").alias("component"))
    linked = joined.join(names, "root").select(F.col("node").alias("fp"), "component")
    nodes = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component", "least").alias("component"))
    return rows.join(nodes, "fp").select(id_column, "fp", "component")


def representatives(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of every group of near-duplicates, with all its columns.

    It is the row of the least id, a null id before all others; of repeated rows one stays.
    """
    names = docs.columns
    keyed = docs.withColumn("__key", text_key(id_column, text_column))
    row = F.struct(F.col(id_column).alias("id"), F.col("__key").alias("key"))
    found = near_duplicates(keyed.select(row.alias("__row"), F.col(text_column)), "__row", text_column)
    first = found.where("__row <=> component").select(F.col("__row.id").alias("__id"), F.col("__row.key").alias("__first"))
    same = F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__first"))
    return keyed.join(first.distinct(), same, "left_semi").dropDuplicates([id_column, "__key"]).select(names)
