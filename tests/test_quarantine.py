"""Bad lines: all of them and only they are set aside, with what is wrong."""

import pytest

from scholaris.schemas import STAGING
from scholaris.sources import files, quarantine

HEADER = ",".join(STAGING["faculty"].names)
GOOD = [
    "F1,Full Professor,2001-02-03,Math,100,Active,Tenured,x",
    'F2,"Lecturer, ""senior""",,,,,,',
    "F3,r,2020-01-01,d,-5,a,t,r",
]
BAD = {
    "F4,r,2020-01-01,d,lots,a,t,r": "salary is no bigint: lots",
    "F5,r,soon,d,1.5,a,t,r": "hire_date is no date: soon; salary is no bigint: 1.5",
    "F6,r,2020-01-01,d,1,a,t,r,more": "not 8 values",
    "F7,r": "not 8 values",
    "F8,r,2020-13-01,d,1,a,t,r": "hire_date is no date: 2020-13-01",
    "F9,r,2020-01-01,d,99999999999999999999,a,t,r": "salary is no bigint: 99999999999999999999",
}


def inbox(tmp_path, name, lines):
    (tmp_path / name).write_text("\n".join([HEADER, *lines]) + "\n")
    return str(tmp_path / name)


def test_all_and_only_the_bad_lines(spark, tmp_path):
    lines = [line for pair in zip(GOOD, list(BAD)[:3], strict=True) for line in pair] + list(BAD)[3:]
    found = quarantine.read_checked(spark, "faculty", inbox(tmp_path, "f.csv", lines))
    assert (found.n_good, found.n_bad) == (3, 6) and found.share == pytest.approx(6 / 9)
    assert found.good.schema == STAGING["faculty"]
    good = sorted(found.good.collect(), key=lambda r: r.faculty_id)
    assert [r.faculty_id for r in good] == ["F1", "F2", "F3"]
    assert good[1].rank == 'Lecturer, "senior"' and good[1].salary is None and good[2].salary == -5
    bad = {r.line: "; ".join(r.faults) for r in found.bad.collect()}
    assert bad == BAD
    assert all(r.file.endswith("f.csv") for r in found.bad.collect())


def test_good_rows_are_those_of_the_strict_reader(spark, tmp_path):
    path = inbox(tmp_path, "g.csv", GOOD)
    strict = files.read_csv(spark, "faculty", path).collect()
    found = quarantine.read_checked(spark, "faculty", path)
    assert sorted(map(repr, found.good.collect())) == sorted(map(repr, strict)) and found.n_bad == 0
    assert found.bad.collect() == []


def test_a_column_alone_keeps_its_faults(spark, tmp_path):
    """Reading few columns must not hide faults in the others."""
    found = quarantine.read_checked(spark, "faculty", inbox(tmp_path, "c.csv", [*GOOD, *BAD]))
    assert sorted(r.faculty_id for r in found.good.select("faculty_id").collect()) == ["F1", "F2", "F3"]
    assert found.bad.select("file").count() == 6 and found.good.count() == 3


def test_extract_sets_lines_aside_and_goes_on_below_the_limit(spark, tmp_path):
    clean = inbox(tmp_path, "clean.csv", GOOD)
    few = inbox(tmp_path, "few.csv", GOOD * 100 + list(BAD)[:2])
    tables = quarantine.extract(spark, {"faculty": few}, str(tmp_path / "hub"), "r1")
    assert tables["faculty"].count() == 300
    lines = spark.read.parquet(str(tmp_path / "hub/quarantine/run_id=r1/faculty"))
    assert sorted(r.line for r in lines.collect()) == sorted(list(BAD)[:2])
    assert lines.columns == ["table_name", "file", "line", "faults", "set_aside_at"]
    quarantine.extract(spark, {"faculty": clean}, str(tmp_path / "hub"), "r2")
    assert not (tmp_path / "hub/quarantine/run_id=r2").exists()


def test_too_many_bad_lines_end_the_load_with_the_lines_kept(spark, tmp_path):
    path = inbox(tmp_path, "bad.csv", [*GOOD, *BAD])
    with pytest.raises(quarantine.QuarantineError, match="faculty 6 of 9"):
        quarantine.extract(spark, {"faculty": path}, str(tmp_path / "hub"), "r3")
    assert spark.read.parquet(str(tmp_path / "hub/quarantine/run_id=r3/faculty")).count() == 6


def test_an_empty_file(spark, tmp_path):
    found = quarantine.read_checked(spark, "faculty", inbox(tmp_path, "e.csv", []))
    assert (found.n_good, found.n_bad, found.share) == (0, 0, 0.0)
