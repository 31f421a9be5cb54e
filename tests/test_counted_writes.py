"""Rows counted while they are written: retried tasks, shuffles before, empty frames."""

import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from scholaris.functions.numeric import map_total
from scholaris.sources import files

# Each task fails once, after some rows were written; then half of the tasks are slow.
RETRIED = """
import sys, pathlib
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession
from scholaris.sources import files
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
def once(batches):
    for batch in batches:
        yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise OSError("lost")
rows = spark.range(0, 10_000, 1, 4).mapInArrow(once, "id long")
print("first", files.saved(rows, {path!r} + "/a")[1])
print("after", files.saved(rows.repartition(4, "id"), {path!r} + "/b")[1])
spark.stop()
"""


def test_a_retried_task_is_counted_once(tmp_path):
    code = RETRIED.format(root=str(Path(__file__).resolve().parent.parent), path=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.stdout.split() == ["first", "10000", "after", "10000"], done.stderr[-2000:]


def test_counts_of_any_frame(spark, tmp_path):
    left = spark.range(5000).withColumn("k", F.col("id") % 7)
    joined = left.join(spark.range(3).withColumnRenamed("id", "k"), "k")
    frames = {
        "join": joined, "sorted": joined.orderBy("id"), "empty": left.where("id < 0"), "grouped": left.groupBy("k").count(),
        "none": joined.where("1 = 0"), "limit": left.limit(10), "union": left.union(left),
    }
    for name, frame in frames.items():
        found, rows = files.saved(frame, str(tmp_path / name))
        assert rows == found.count() == frame.count(), name
    by = files.saved(left, str(tmp_path / "by"), "k")
    assert by[1] == 5000 and len(list((tmp_path / "by").glob("k=*"))) == 7


def test_a_range_shuffle_is_not_counted_twice(spark, tmp_path):
    df = spark.range(20_000).withColumn("y", F.col("id") % 3)
    assert files.write_partitioned(df, str(tmp_path / "p"), "y", ["id"]) == 20_000


def test_map_total(spark):
    rows = spark.createDataFrame([({"a": 1, "b": 2},), ({},), (None,), ({"a": None, "b": 5},)], "m map<string,long>")
    assert [r[0] for r in rows.select(map_total("m")).collect()] == [3, 0, None, 5]
