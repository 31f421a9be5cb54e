"""Best-fit packing of token pieces into sequences, after Martello and Toth's reduction.

How pieces are packed depends on their lengths only, and there are at most `capacity`
lengths: Spark counts the pieces of each length, the driver packs the counts (a table of
at most `capacity` rows for any input) and gives each length a list of runs, places for
so many pieces in a row. Spark then numbers the pieces of each length, and each looks up
its run.

The reduction fixes a sequence for good where it provably does no harm: the largest piece
left with a set that dominates whatever else could go with it. What is left is packed
largest first, each piece into the fullest sequence that takes it.
"""

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholaris.llm.arrow import map_batches, small_batches, texts
from scholaris.llm.wordids import word_ids
from scholaris.operators.ranking import POSITION, positioned
from scholaris.sources.workspace import stored

CAPACITY = 4096
END_ID = 1

# (pieces of this length that went before, first sequence, pieces a sequence, offset)
Run = tuple[int, int, int, int]


class Counts:
    """How many pieces of each length are left, and which lengths there are."""

    def __init__(self, counts: dict[int, int]):
        self.left = {length: n for length, n in counts.items() if n}
        self.lengths = sorted(self.left)

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def smallest(self, n: int, besides: int) -> list[int]:
        """The n least pieces left, one of length `besides` set aside; fewer if there are not so many."""
        found: list[int] = []
        for length in self.lengths:
            found += [length] * min(n - len(found), self.left[length] - (length == besides))
            if len(found) == n:
                break
        return found

    def largest_up_to(self, most: int, besides: tuple[int, ...] = ()) -> int | None:
        """The greatest piece of at most that length, pieces `besides` set aside."""
        for i in range(bisect_right(self.lengths, most) - 1, -1, -1):
            length = self.lengths[i]
            if self.left[length] > besides.count(length):
                return length
        return None


def dominant_set(counts: Counts, j: int, capacity: int) -> list[int] | None:
    """Pieces to go with j, at least as good as any other set that fits beside j.

    A set is as good as another if the other's pieces can be dealt into places of the
    set's pieces. None where none of the provable cases holds.
    """
    room = capacity - j
    small = counts.smallest(3, j)
    fits = 0
    while fits < len(small) and sum(small[: fits + 1]) <= room:
        fits += 1
    if fits == 0:
        return []
    largest = counts.largest_up_to(room, (j,))
    if fits == 1 or largest == room:
        return [largest]
    if fits > 2 or len(small) > 2 and sum(small) <= room:
        return None
    # At most two pieces fit beside j: the best pair, largest first.
    best: tuple[int, int] | None = None
    for a in reversed(counts.lengths[: bisect_right(counts.lengths, room)]):
        if counts.left[a] <= (a == j) or best and 2 * a <= sum(best):
            continue
        b = counts.largest_up_to(min(a, room - a), (j, a))
        if b is not None and (best is None or a + b > sum(best)):
            best = (a, b)
    if best is None or largest >= sum(best):
        return [largest]
    a, b = best
    if a != largest:
        return None
    # Any other pair must have its smaller piece within b: no two pieces over b may fit.
    over = [x for x in counts.lengths[bisect_right(counts.lengths, b) :] for _ in range(min(2, counts.left[x] - (x == j)))][:2]
    return [a, b] if len(over) < 2 or sum(over) > room else None


def pack_counts(counts: dict[int, int], capacity: int) -> dict[int, list[Run]]:
    """For each length, the runs that place its pieces, in order."""
    runs: dict[int, list[Run]] = {length: [] for length in counts}
    placed = dict.fromkeys(counts, 0)
    sequences = 0

    def place(length: int, sequence: int, bins: int, each: int, offset: int, n: int | None = None) -> None:
        runs[length].append((placed[length], sequence, each, offset))
        placed[length] += bins * each if n is None else n

    left = Counts(counts)
    # Dominated choices: one pass from the largest piece down, again while it fixes any.
    changed = True
    while changed:
        changed, j = False, capacity
        while (j := left.largest_up_to(j)) is not None:
            chosen = dominant_set(left, j, capacity)
            if chosen is None:
                j -= 1
                continue
            whole = [j, *chosen]
            # Removing pieces never breaks the proof while the chosen lengths last.
            bins = min(left.left[x] // whole.count(x) for x in set(whole))
            offset = 0
            for length in whole:
                place(length, sequences, bins, 1, offset)
                left.take(length, bins)
                offset += length
            sequences += bins
            changed = True

    # Best fit, largest first. Sequences with the same room stand in blocks (first, how many).
    blocks: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def put(room: int, first: int, bins: int) -> None:
        if bins and room:
            if room not in blocks:
                blocks[room] = []
                insort(rooms, room)
            blocks[room].append((first, bins))

    for length in reversed(left.lengths.copy()):
        n = left.left[length]
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                first, bins, room = sequences, -(-n // each), capacity
                sequences += bins
            else:
                room = rooms[at]
                first, bins = blocks[room].pop()
                if not blocks[room]:
                    del blocks[room]
                    rooms.pop(at)
                each = room // length
            # A sequence takes as many as fit before the next is opened, the last what is left.
            full = min(bins, n // each)
            if full:
                place(length, first, full, each, capacity - room)
                put(room - each * length, first, full)
                n -= full * each
            if n and full < bins:
                place(length, first + full, 1, n, capacity - room, n)
                put(room - n * length, first + full, 1)
                n, full = 0, full + 1
            put(room, first + full, bins - full)
    return runs


# Runs that are broadcast; beyond it, the plan is joined as any other table.
MOST_RUNS = 200_000


def packed(pieces: DataFrame, length_column: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """The rows of `pieces` with `sequence_id` and `offset`, both long, as the last columns.

    In every sequence the pieces follow each other from 0 without a gap and end by
    `capacity`. Which of equally long pieces goes where is arbitrary, but settled: pieces are
    numbered by their places in files, so that tasks run again give the same. A length that
    is null, below 1 or over the capacity has no place: both columns are null. Columns of
    these two names in `pieces` are replaced, all others stay whatever their names. An empty
    table gives no rows. `pieces` is computed once and written to the shared folder.
    """
    spark = pieces.sparkSession
    # Pieces of one length are numbered in groups, so that a frequent length is no hot key.
    groups = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One struct for all that came, so that no name inside can clash with a name out there.
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    own = pieces.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("piece"), F.col(length_column).cast("long").alias("length"))
    salted = positioned(stored(own.withColumn("group", F.floor(F.rand(17) * groups)), "salted"), in_files=True)
    counted = stored(salted.where(F.col("length").between(1, capacity)).groupBy("length", "group").count(), "lengths")
    totals = dict(counted.groupBy("length").agg(F.sum("count")).collect())
    runs = pack_counts(totals, capacity)
    schema = "length long, runs array<struct<before long, sequence long, each long, offset long>>"
    plan = spark.createDataFrame([(int(k), v) for k, v in runs.items()], schema)
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("length", "group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    # At most `capacity` rows, and so many runs in them as are counted here.
    few = sum(map(len, runs.values())) <= MOST_RUNS
    bases = bases.join(F.broadcast(plan) if few else plan, "length")
    place = Window.partitionBy("length", "group").orderBy(*POSITION)
    joined = salted.withColumn("n", F.row_number().over(place)).join(bases, ["length", "group"], "left")
    number = F.col("base") + F.col("n") - 1
    run = F.element_at(F.filter("runs", lambda r: r["before"] <= number), -1)
    found = joined.select("piece", "length", number.alias("number"), run.alias("run"))
    past = F.col("number") - F.col("run.before")
    return found.select(
        "piece.*",
        (F.col("run.sequence") + F.floor(past / F.col("run.each"))).cast("long").alias("sequence_id"),
        (F.col("run.offset") + past % F.col("run.each") * F.col("length")).cast("long").alias("offset"),
    )


def token_pieces(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(id, piece int, start long, length long, ids_crc32 long): every text's tokens in pieces.

    The ids of a text, by the tokenizer file, and `end_id` are cut every `capacity` ids. A
    null or empty text is its end id alone. The crc is of the piece's ids as little-endian
    uint32. Repeated rows and null ids stay; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_column).alias(id_column), F.col(text_column).alias("text"))
    kind = rows.schema[id_column].dataType.simpleString()
    names = [id_column, "piece", "start", "length", "ids_crc32"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_ids(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in small_batches(batches, "text"):
            found = []
            for row, text in enumerate(texts(batch.column(1))):
                ids = encoder.ids(text) + end
                cuts = [*range(0, len(ids), 4 * capacity), len(ids)]
                found += [(row, i, a // 4, (b - a) // 4, zlib.crc32(ids[a:b])) for i, (a, b) in enumerate(pairwise(cuts))]
            if found:
                row, piece, *rest = zip(*found, strict=True)
                columns = [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), *map(pa.array, rest)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return map_batches(rows, work, f"`{id_column}` {kind}, piece int, start long, length long, ids_crc32 long")


def packed_documents(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """The pieces of `token_pieces` with their places, `sequence_id` and `offset`."""
    pieces = token_pieces(docs, tokenizer, id_column, text_column, capacity, end_id)
    return packed(pieces, "length", capacity)
