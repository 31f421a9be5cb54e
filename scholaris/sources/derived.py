"""The five staging tables, derived from the star-schema parquet tables on hand.

Each function returns the declared columns in the declared order, and the `extra`
columns of its main table where it takes them. The branches on remainders plant the
defects that the quality checks look for.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholaris.functions import grades
from scholaris.operators.ranking import POSITION, positioned
from scholaris.schemas import STAGING

C = F.col

# Declared columns of the source tables, so that reading one needs no look at its files.
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _id(prefix, number, width):
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def _date(year, month, day):
    return F.make_date(*[p.cast("int") if not isinstance(p, int) else F.lit(p) for p in (year, month, day)])


def students(customer: DataFrame) -> DataFrame:
    k = C("c_custkey")
    withdrawn, graduated = k % 10 == 3, k % 11 <= 6
    none = F.lit(None)
    return customer.select(
        _id("STU_", k, 8).alias("student_id"),
        F.when(k % 131 == 6, 1990).otherwise(2016 + k % 11).cast("long").alias("cohort_year"),
        C("c_mktsegment").alias("major"),
        F.when(k % 97 == 5, 4.5)
        .when(k % 89 == 7, none.cast("double"))
        .otherwise(F.round((C("c_acctbal") + 1000.0) / 2750.0, 2))
        .alias("gpa"),
        F.when(withdrawn, "Withdrawn").when(graduated, "Graduated").otherwise("Active").alias("enrollment_status"),
        _date(2016 + k % 11, 8, 1 + k % 31).alias("date_enrolled"),
        F.when(withdrawn | ~graduated, none.cast("date"))
        .when(k % 53 == 0, _date(2015 + k % 11, 5, 1))
        .when(k % 4 == 0, _date(2021 + k % 11, 5, 1 + k % 31))
        .otherwise(_date(2020 + k % 11, 5, 1 + k % 31))
        .alias("date_graduated"),
        F.when(withdrawn, k % 60)
        .when(graduated, F.when(k % 41 == 0, 100).otherwise(120 + k % 15))
        .otherwise(F.when(k % 37 == 0, 0).otherwise(30 + k % 60))
        .cast("long")
        .alias("credits_completed"),
        F.when(k % 6 == 0, "Asian")
        .when(k % 6 == 1, "White")
        .when(k % 6 == 2, "Hispanic")
        .when(k % 6 == 3, "Black")
        .when(k % 6 == 4, "Non-Resident Alien")
        .otherwise("Two or More Races")
        .alias("ethnicity"),
        (k % 4 == 0).alias("first_generation"),
    )


def faculty(supplier: DataFrame, nation: DataFrame, extra: list[str] = ()) -> DataFrame:
    k = C("s_suppkey")
    five = k % 5
    return supplier.join(nation, C("s_nationkey") == C("n_nationkey")).select(
        _id("FAC_", k, 8).alias("faculty_id"),
        F.when(five == 0, "Assistant Professor")
        .when(five == 1, "Associate Professor")
        .when(five == 2, "Full Professor")
        .when(five == 3, "Lecturer")
        .otherwise("Adjunct")
        .alias("rank"),
        F.when(k % 61 == 8, F.make_date(F.lit(2999), F.lit(1), F.lit(1)))
        .otherwise(_date(2000 + k % 25, 1 + k % 12, 1 + k % 28))
        .alias("hire_date"),
        C("n_name").alias("department"),
        F.when(k % 43 == 7, 0).otherwise(F.floor(65000.0 + C("s_acctbal") * 20.0)).cast("long").alias("salary"),
        F.when(k % 20 == 0, "On Leave").otherwise("Active").alias("employment_status"),
        F.when(five == 0, "Tenure-Track")
        .when(five.isin(1, 2), "Tenured")
        .otherwise("Non-Tenure-Track")
        .alias("tenure_status"),
        F.when(k % 3 == 0, "Biology").when(k % 3 == 1, "Chemistry").otherwise("Physics").alias("research_focus"),
        *extra,
    )


def grants(orders: DataFrame, supplier: DataFrame) -> DataFrame:
    k, price = C("o_orderkey"), C("o_totalprice")
    faculty_count = supplier.agg(F.count("*")).scalar()
    start = C("o_orderdate").cast("date")
    return orders.select(
        _id("GNT_", k, 10).alias("grant_id"),
        F.when(k % 71 == 9, "FAC_99999999").otherwise(_id("FAC_", C("o_custkey") % faculty_count, 8)).alias("pi_id"),
        F.when(k % 59 == 3, 0)
        .when(k % 397 == 5, F.floor(price * 20.0))
        .otherwise(F.floor(price))
        .cast("long")
        .alias("award_amount"),
        C("o_orderpriority").alias("funding_agency"),
        start.alias("start_date"),
        F.date_add(start, F.when(k % 83 == 4, -30).otherwise(365 * (1 + k % 5)).cast("int")).alias("end_date"),
        F.lit("College").alias("department"),
        F.when(C("o_orderstatus") == "O", "Active")
        .when(k % 20 == 0, "Cancelled")
        .otherwise("Completed")
        .alias("status"),
        F.floor(price / 100000.0 * (1 + k % 5)).cast("long").alias("publication_count"),
    )


def courses(part: DataFrame, supplier: DataFrame) -> DataFrame:
    k = C("p_partkey")
    faculty_count = supplier.agg(F.count("*")).scalar()
    return part.select(
        _id("CRS_", k, 8).alias("course_id"),
        C("p_brand").alias("course_code"),
        C("p_name").alias("course_title"),
        F.when(k % 101 == 3, 6).otherwise(1 + k % 4).cast("long").alias("credits"),
        F.when(k % 3 == 0, "Fall").when(k % 3 == 1, "Spring").otherwise("Summer").alias("semester"),
        (2016 + k % 11).cast("long").alias("year"),
        _id("FAC_", k % faculty_count, 8).alias("instructor_id"),
        (15 + k % 235).cast("long").alias("enrollment"),
        F.when(k % 113 == 2, 1.2).otherwise(F.round(0.75 + (k % 24) / 100.0, 3)).alias("pass_rate"),
        F.when(k % 127 == 4, 5.5).otherwise(F.round(1.0 + (C("p_size") % 41) / 10.0, 1)).alias("avg_rating"),
    )


def enrollments(lineitem: DataFrame, orders: DataFrame, extra: list[str] = ()) -> DataFrame:
    k, line, course = C("l_orderkey"), C("l_linenumber"), C("l_partkey")
    ship_month = F.month("l_shipdate")
    graded = (
        # Both sides grow with the data: neither is ever broadcast.
        lineitem.join(orders.hint("merge"), C("l_orderkey") == C("o_orderkey"))
        .withColumn("grade_point", F.when(k % 307 == 11, 4.8).otherwise(F.round(C("l_quantity") * 0.08, 2)))
        .withColumn("grade", grades.letter_grade(C("grade_point"), grades.TRANSCRIPT_SCALE))
    )
    return graded.select(
        _id("ENR_", k * 10 + line, 10).alias("enrollment_id"),
        F.when(k % 67 == 1, "STU_99999999")
        .when(k % 211 == 2, F.lit(None).cast("string"))
        .otherwise(_id("STU_", C("o_custkey"), 8))
        .alias("student_id"),
        _id("CRS_", course, 8).alias("course_id"),
        F.when(ship_month >= 8, "Fall").when(ship_month <= 5, "Spring").otherwise("Summer").alias("semester"),
        (F.year("l_shipdate") + 21).cast("long").alias("year"),
        "grade",
        "grade_point",
        F.when(k % 401 == 12, -1)
        .when((C("grade") == "F") & (line != 7), 0)
        .otherwise(1 + course % 4)
        .cast("long")
        .alias("credits_earned"),
        *extra,
    )


class StagingTables:
    """The staging tables over one directory of parquet tables."""

    names = list(STAGING)

    def __init__(self, spark: SparkSession, directory: str):
        self.spark, self.directory = spark, directory

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCES[name]).parquet(f"{self.directory}/{name}.parquet")

    def all(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.names}

    def positioned(self, name: str) -> DataFrame:
        """A staging table with the file positions of the rows it is made from."""
        if name == "faculty":
            return faculty(positioned(self.source("supplier"), in_files=True), self.source("nation"), POSITION)
        if name == "enrollments":
            return enrollments(positioned(self.source("lineitem"), in_files=True), self.source("orders"), POSITION)
        return positioned(getattr(self, name), in_files=True)

    @cached_property
    def students(self) -> DataFrame:
        return students(self.source("customer"))

    @cached_property
    def faculty(self) -> DataFrame:
        return faculty(self.source("supplier"), self.source("nation"))

    @cached_property
    def grants(self) -> DataFrame:
        return grants(self.source("orders"), self.source("supplier"))

    @cached_property
    def courses(self) -> DataFrame:
        return courses(self.source("part"), self.source("supplier"))

    @cached_property
    def enrollments(self) -> DataFrame:
        return enrollments(self.source("lineitem"), self.source("orders"))
