"""Shape of the physical plans: what would not hold up on large tables."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scholaris.operators import integrity, star
from scholaris.operators.ranking import positioned
from scholaris.plans.catalog import QUERIES, load
from scholaris.sources.workspace import clear_workspace, stored, workspace

load()
DIRECTORY = "/root/testdata/sf0.001"
# Runs a whole batch before it returns; its parts are covered by the other queries.
SKIPPED = {"run_log"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIPPED))
def test_plan(spark, name):
    """No row-wise Python, no cross join and no sort or window over a whole table in one task."""
    plan = plan_of(QUERIES[name](spark, DIRECTORY))
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        below = lines[i + 1].strip(" :+-*()0123456789")
        above = lines[i - 1]
        # Allowed: the merge of one partial row per task, and numbering the range partitions.
        assert re.match(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(keys=\[\]", below) or (
            "__part" in above or "__part" in below
        ), plan
    clear_workspace(spark)


NO_KEYS = """
    enrollment_summary enrollment_by_major_year enrollment_by_year enrollment_detail student_enrollment_safe null_key_counts
    orphan_rows orphan_keys fact_has_rows cost_per_publication faculty_research_safe invalid_gpa_count research_roi gpa_trend
""".split()


@pytest.mark.parametrize("name", NO_KEYS)
def test_reports_without_surrogate_keys_write_nothing(spark, name):
    clear_workspace(spark)
    QUERIES[name](spark, DIRECTORY).collect()
    folder = Path(workspace(spark).removeprefix("file:"))
    assert not folder.exists() or not list(folder.iterdir())


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_sums_come_before_the_join(spark):
    """A student or investigator with a third of all rows is a handful of rows in the join."""
    for name, key in (("enrollment_by_year", "student_id"), ("award_by_department", None), ("gpa_trend", "student_id")):
        plan = plan_of(QUERIES[name](spark, DIRECTORY))
        if key:
            assert "partial_" in plan[plan.index(f"Exchange hashpartitioning({key}") :]


@pytest.mark.parametrize("name", ["award_by_department", "students_by_major_share", "term_retention"])
def test_inputs_are_joined_once(spark, name):
    plan = plan_of(QUERIES[name](spark, DIRECTORY))
    assert len(re.findall(r"Join", plan)) <= 1
    clear_workspace(spark)


def test_duplicates_take_two_shuffles(spark):
    """One by range, seen in the stored table; one to look at the row before."""
    plan = plan_of(QUERIES["duplicate_rows_marked"](spark, DIRECTORY))
    rows = plan.split("BroadcastExchange")[0]
    assert len(re.findall(r"Exchange rangepartitioning\(__part", rows)) == 1 and "Exchange hashpartitioning" not in rows
    assert "SortMergeJoin" not in plan
    clear_workspace(spark)


def test_ranges_are_dealt_evenly_where_duplicates_are_marked(spark, partitions):
    partitions(16)
    rows = spark.range(160_000).selectExpr("if(id % 3 = 0, 0, id) as key", "id as place").repartition(4)
    marked = integrity.duplicate_rows(positioned(rows), "key", ["place"])
    sizes = [r[1] for r in marked.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 160_000 and max(sizes) <= 2 * 160_000 / 16
    assert marked.where("is_duplicate").count() == 160_000 - marked.select("key").distinct().count()


def test_a_scorecard_passes_three_times_over_a_table(spark):
    plan = plan_of(QUERIES["quality_scorecard"](spark, DIRECTORY))
    # Keys and outliers of five tables, their one-row statistics, and the supplier count of the fixture.
    tables = len(re.findall(r"FileScan parquet", plan)) - len(re.findall(r"FileScan parquet \[(?:total|\w+_moments)", plan))
    assert tables <= 24, plan
    clear_workspace(spark)


@pytest.mark.parametrize("student", ["STU_00000001", "STU_99999999"])
def test_a_hot_student_is_split_in_the_fact(spark, partitions, student):
    """A third of all enrollments on one student: the join that carries rows is dealt anew."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    partitions(20)
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 200_000
        rows = spark.range(0, n, 1, 8).select(
            F.format_string("ENR_%010d", "id").alias("enrollment_id"),
            F.when(F.col("id") % 3 == 0, student).otherwise(F.format_string("STU_%08d", F.col("id") % 5000)).alias("student_id"),
            F.lit("CRS_1").alias("course_id"), F.lit("A").alias("grade"), F.lit(4.0).alias("grade_point"), F.lit(2020).cast("long").alias("year"),
        )
        students = spark.range(5000).select(F.format_string("STU_%08d", "id").alias("student_id"), F.lit("M").alias("major"), F.col("id").alias("student_key"))
        used = ["enrollment_id", "course_id", "grade", "grade_point", "year"]
        joined = rows.join(students, "student_id").select(*used, "student_key")
        plan = final_plan(joined)
        assert "skew=true" in plan, plan
        fact = star.fact_enrollment(stored(rows, "hot"), students)
        assert fact.count() == (n if student != "STU_99999999" else rows.filter("student_id <> 'STU_99999999'").count())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        clear_workspace(spark)


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["validity_faculty"](spark, DIRECTORY))
    assert "ReadSchema: struct<s_suppkey:bigint,s_nationkey:int,s_acctbal:double>" in plan
    plan = plan_of(QUERIES["enrollment_by_year"](spark, DIRECTORY))
    assert "ReadSchema: struct<l_orderkey:bigint," in plan and "l_shipdate:timestamp_ntz>" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan


def test_per_student_work_starts_from_partial_counts(spark):
    """A student with a third of all rows leaves each scan task as one row."""
    plan = plan_of(QUERIES["weighted_gpa"](spark, DIRECTORY))
    exchange = plan.index("Exchange hashpartitioning(student_id")
    assert "partial_sum" in plan[exchange:]
