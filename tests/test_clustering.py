"""Files clustered on several columns: how little of them a filter on either has to read."""

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from scholaris.sources import clustering


def row_groups(path, column):
    """(least, greatest, nulls) of each row group, from the footers."""
    found = []
    for file in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        for i in range(meta.num_row_groups):
            stats = meta.row_group(i).column(at).statistics
            found.append((stats.min, stats.max, meta.row_group(i).num_rows) if stats.has_min_max else (None, None, meta.row_group(i).num_rows))
    return found


def share_read(path, column, value):
    groups = row_groups(path, column)
    return sum(low is not None and low <= value <= high for low, high, _ in groups) / len(groups)


@pytest.fixture
def many_files(spark, partitions):
    partitions(64)


def made(spark, n=40_000):
    rng = random.Random(5)
    rows = [(rng.randint(1, 5000), f"CRS_{rng.randint(1, 800):05d}", i, rng.choice([2018, 2019])) for i in range(n)]
    return spark.createDataFrame(rows, "student long, course string, id long, year long")


def test_a_filter_on_either_column_reads_few_row_groups(spark, tmp_path, many_files):
    df, path, sorted_path = made(spark), str(tmp_path / "c"), str(tmp_path / "s")
    assert clustering.write_clustered(df, path, ["student", "course"]) == 40_000
    df.repartitionByRange("student", "course").sortWithinPartitions("student", "course").write.parquet(sorted_path)
    assert len(row_groups(path, "student")) >= 48
    for column, values in (("student", [17, 2500, 4990]), ("course", ["CRS_00007", "CRS_00400", "CRS_00799"])):
        for value in values:
            # 64 files, eight ranges of either column: an eighth, and what lies across a border.
            assert share_read(path, column, value) <= 0.3, (column, value)
    assert all(share_read(sorted_path, "course", v) > 0.9 for v in ("CRS_00007", "CRS_00400"))
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select(df.columns).collect())) == sorted(map(tuple, df.collect()))


def test_hot_values_are_split_and_nulls_kept(spark, tmp_path, many_files):
    rng = random.Random(2)
    rows = [(7 if i % 3 == 0 else rng.randint(1, 9999), None if i % 5 == 0 else f"c{rng.randint(0, 300)}", i) for i in range(20_000)]
    df, path = spark.createDataFrame(rows, "student long, course string, id long"), str(tmp_path / "h")
    clustering.write_clustered(df, path, ["student", "course"])
    sizes = [n for *_, n in row_groups(path, "student")]
    assert max(sizes) <= 3 * 20_000 / 64
    back = spark.read.parquet(path)
    assert sorted(map(repr, map(tuple, back.select("student", "course", "id").collect()))) == sorted(map(repr, rows))


def test_folders_by_value_inside_which_rows_are_clustered(spark, tmp_path, many_files):
    df, path = made(spark), str(tmp_path / "y")
    clustering.write_clustered(df, path, ["student", "course"], by="year")
    assert sorted(p.name for p in Path(path).glob("year=*")) == ["year=2018", "year=2019"]
    assert share_read(f"{path}/year=2019", "course", "CRS_00400") <= 0.45
    assert spark.read.parquet(path).where("year = 2018").count() == df.where("year = 2018").count()


def test_ranks_and_interleaved_bits(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate([None, "a", "b", "bb", "c", "z"])], "i long, c string")
    ranks = [r[0] for r in df.orderBy("i").select(clustering.rank("c", ["b", "c"])).collect()]
    assert ranks == [0, 0, 1, 1, 2, 2]
    numbers = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    found = numbers.select("a", "b", clustering.interleaved([numbers.a, numbers.b], 2).alias("z")).collect()
    assert all(r.z == (r.a >> 1) * 8 + (r.b >> 1) * 4 + (r.a & 1) * 2 + (r.b & 1) for r in found)


def test_empty_and_all_null(spark, tmp_path):
    for name, rows in (("e", []), ("n", [(None, None), (None, None)])):
        df = spark.createDataFrame(rows, "a long, b string")
        assert clustering.write_clustered(df, str(tmp_path / name), ["a", "b"]) == len(rows)
