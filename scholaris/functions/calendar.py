"""Academic calendar, fiscal calendar and date spines."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholaris.functions.numeric import _col


def academic_year(d) -> Column:
    """Named after the year it ends in; starts in August."""
    return _year_starting(d, 8)


def fiscal_year(d) -> Column:
    """Named after the year it ends in; starts in July."""
    return _year_starting(d, 7)


def _year_starting(d, first_month: int) -> Column:
    d = _col(d)
    return (F.year(d) + (F.month(d) >= first_month).cast("int")).cast("long")


def semester(d) -> Column:
    month = F.month(_col(d))
    return (
        F.when(month.between(8, 12), "Fall")
        .when(month.between(1, 5), "Spring")
        .when(month.between(6, 7), "Summer")
    )


def date_key(d) -> Column:
    return F.date_format(_col(d), "yyyyMMdd").cast("long")


def term_index(year, semester_name) -> Column:
    """Consecutive Spring and Fall terms differ by one; null for Summer."""
    name = _col(semester_name)
    return F.when(name == "Fall", _col(year) * 2 + 1).when(name == "Spring", _col(year) * 2)


def date_spine(bounds: DataFrame, first: str, last: str, freq: str = "D") -> DataFrame:
    """Dates from `first` to `last` of the one-row frame `bounds`, both ends included.

    D gives every day, W Sundays, M month ends, Y year ends.
    """
    keep = {
        "D": lambda d: F.lit(True),
        "W": lambda d: F.dayofweek(d) == 1,
        "M": lambda d: d == F.last_day(d),
        "Y": lambda d: (F.month(d) == 12) & (F.dayofmonth(d) == 31),
    }[freq]
    days = bounds.filter(F.col(first) <= F.col(last)).select(
        F.explode(F.sequence(F.col(first), F.col(last))).alias("calendar_date")
    )
    return days.filter(keep(F.col("calendar_date")))


def grant_status(end_date, as_of: date) -> Column:
    return F.when(_col(end_date) > F.lit(as_of), "Active").when(_col(end_date).isNotNull(), "Completed")
