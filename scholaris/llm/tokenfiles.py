"""Token ids of a corpus in binary files, in the order of the document ids.

Texts are encoded where they lie, and their token ids, two to four bytes each, go to ranges
of document ids whose bounds come from a sample of the ids alone. Each task sorts its range
and writes it as images in the format of `pfor`. Spark's Parquet writer stores an image as one row,
beside the ids and lengths of its documents: the commit is Spark's, so a lost executor
leaves no half file, and any store that Spark writes to will do.
"""

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholaris.llm import pfor
from scholaris.llm.arrow import map_batches, small_batches, texts
from scholaris.llm.wordids import word_ids
from scholaris.sources.workspace import new_path

END_ID = 2
# An image is closed once it holds so many ids; a document is never cut.
IMAGE_IDS = 1 << 20
# Ids drawn for each range to find the bounds, and for all of them at the most.
SAMPLED, MOST_SAMPLED = 100, 1_000_000


@dataclass(frozen=True)
class Ranges:
    """Parts of the order of the ids: the first `nulls` of them for null, then those between the bounds."""

    nulls: int
    bounds: list

    def of(self, value) -> tuple[int, int]:
        """The first and the last part that a row of this id may be in; more than one for a frequent id."""
        if value is None:
            return 0, max(self.nulls - 1, 0)
        return self.nulls + bisect.bisect_left(self.bounds, value), self.nulls + bisect.bisect_right(self.bounds, value)


def ranges(docs: DataFrame, id_column: str, parts: int) -> Ranges:
    """Ranges of about equally many rows, by a sample of bounded size; an id on many rows is several bounds."""
    column = F.col(id_column)
    rows, known = docs.agg(F.count("*"), F.count(column)).first()
    nulls = round(parts * (rows - known) / max(rows, 1))
    wanted = min(SAMPLED * parts, MOST_SAMPLED)
    drawn = docs.select(column).where(column.isNotNull() & (F.rand(11) * known < wanted)).limit(2 * wanted)
    values = sorted(r[0] for r in drawn.collect())
    left = max(parts - nulls, 1)
    return Ranges(min(nulls, parts - 1), [values[len(values) * i // left] for i in range(1, left)] if values else [])


def encoded(docs: DataFrame, tokenizer: str, id_column: str, text_column: str, parts: int) -> DataFrame:
    """(part, id, tokens binary) of every text: the range of its id, and its token ids as little-endian
    unsigned numbers, of 16 bits if all of the vocabulary fit in.

    Rows of an id that has several parts take turns, from one that each task begins with.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    given = ranges(docs, id_column, parts)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, turn = word_ids(tokenizer), TaskContext.get().partitionId()
        for batch in small_batches(batches, "text"):
            places = []
            for value in batch.column(0).to_pylist():
                first, last = given.of(value)
                places.append(first + turn % (last - first + 1))
                turn += 1
            found = [np.frombuffer(encoder.ids(text), "<u4").astype(encoder.kind).tobytes() for text in texts(batch.column(1))]
            columns = [pa.array(places, pa.int32()), batch.column(0), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "id", "tokens"])

    return map_batches(rows, work, f"part int, id {kind}, tokens binary")


def write(
    docs: DataFrame, path: str, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = END_ID, image_ids: int = IMAGE_IDS
) -> None:
    """Write the ids of every text, and `end_id` after each, to `path`.

    Null ids come first, equal ids in any order, null texts are empty. An empty table gives
    no images. Other columns are not read. An id, or null, on a third of all rows has a
    third of the ranges, over which its rows are dealt in turn.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tokens = encoded(docs, tokenizer, id_column, text_column, parts)
    kind = tokens.schema["id"].dataType.simpleString()
    ordered = tokens.repartitionById(parts, "part").sortWithinPartitions("id")
    names = ["part", "before", "n", "ids", "lengths", "image"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored_as = word_ids(tokenizer).kind
        end = np.array([end_id], "<u4")
        part, before = None, 0
        ids, lengths, numbers_of, held = [], [], [], 0

        def image() -> pa.RecordBatch:
            numbers = np.concatenate(numbers_of)
            columns = [
                pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([len(numbers)], pa.int64()),
                pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)),
                pa.array([lengths], pa.list_(pa.int32())), pa.array([pfor.encode(numbers)], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in small_batches(batches, "tokens"):
            part = batch.column(0)[0].as_py()
            ids.append(batch.column(1))
            for one in batch.column(2).to_pylist():
                own = np.frombuffer(one, stored_as).astype("<u4")
                numbers_of += (own, end)
                lengths.append(len(own) + 1)
                held += len(own) + 1
            if held >= image_ids:
                yield image()
                before += held
                ids, lengths, numbers_of, held = [], [], [], 0
        if lengths:
            yield image()

    schema = f"part int, before long, n long, ids array<{kind}>, lengths array<int>, image binary"
    # Ids are packed already; compressing them again would only cost time.
    map_batches(ordered, work, schema).write.option("compression", "none").parquet(path)


def placed_images(files: DataFrame) -> DataFrame:
    """The images with `start`, the ids in all images before.

    An image knows the ids before it in its part. The parts' own sums run over one row a
    part, and no more than that is broadcast: the parts are a setting of the writer.
    """
    parts = files.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return files.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("before"))


def read(files: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, start long, n_tokens long, ids_crc32 long) of every document in the files.

    `start` counts the ids of all documents before it, the crc is over its ids as
    little-endian uint32; both cover the end id.
    """
    kind = files.schema["ids"].dataType.elementType.simpleString()
    images = placed_images(files).select("ids", "lengths", "image", "start")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lengths = np.array(batch.column(1)[i].as_py(), np.int64)
                numbers = pfor.decode(batch.column(2)[i].as_py())
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(numbers[e - n : e].astype("<u4").tobytes()) for e, n in zip(ends, lengths, strict=True)]
                starts = batch.column(3)[i].as_py() + ends - lengths
                columns = [batch.column(0)[i].values, pa.array(starts), pa.array(lengths), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [id_column, "start", "n_tokens", "ids_crc32"])

    return map_batches(images, work, f"`{id_column}` {kind}, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    spark = docs.sparkSession
    path = new_path(spark, "tokens")
    write(docs, path, tokenizer, id_column, text_column, end_id)
    return read(spark.read.parquet(path), id_column)
