"""Grade scales, grade points, credits and degree progress."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholaris.functions.numeric import _col, nan_to_null, ratio

# Lowest grade point of each letter, highest first. Below the last cut is F.
CATALOG_SCALE = [
    (3.7, "A"),
    (3.3, "A-"),
    (3.0, "B+"),
    (2.7, "B"),
    (2.3, "B-"),
    (2.0, "C+"),
    (1.3, "C"),
    (1.0, "D"),
]
TRANSCRIPT_SCALE = [
    (3.7, "A"),
    (3.3, "A-"),
    (3.0, "B+"),
    (2.7, "B"),
    (2.3, "B-"),
    (2.0, "C"),
    (1.0, "D"),
]

# Grade points of each letter. I and W carry none.
LETTER_POINTS = {
    "A": 4.0,
    "A-": 3.7,
    "B+": 3.3,
    "B": 3.0,
    "B-": 2.7,
    "C+": 2.3,
    "C": 2.0,
    "C-": 1.7,
    "D+": 1.3,
    "D": 1.0,
    "D-": 0.7,
    "F": 0.0,
}

# Lowest GPA of each band, highest first.
GPA_BANDS = [(3.5, "3.5 and above"), (3.0, "3.0 to 3.5"), (2.5, "2.5 to 3.0")]
LOWEST_GPA_BAND = "below 2.5"

# Tenure status that a rank implies.
TENURE_BY_RANK = {"Full Professor": "Tenured", "Assistant Professor": "Tenure-Track"}

DEGREE_CREDITS = 120


def _by_cut(c: Column, cuts, lowest: str) -> Column:
    (cut, name), rest = cuts[0], cuts[1:]
    chain = reduce(lambda w, step: w.when(c >= step[0], step[1]), rest, F.when(c >= cut, name))
    return chain.when(c.isNotNull(), lowest)


def letter_grade(points, scale=CATALOG_SCALE) -> Column:
    """Letter of a grade point; null for null and NaN."""
    return _by_cut(nan_to_null(points), scale, "F")


def letter_points(letter) -> Column:
    """Grade points of a letter; null for I, W and unknown letters."""
    pairs = [F.lit(x) for pair in LETTER_POINTS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), _col(letter))


def gpa_band(gpa) -> Column:
    return _by_cut(nan_to_null(gpa), GPA_BANDS, LOWEST_GPA_BAND)


def weighted_gpa(points, credits) -> Column:
    """Aggregate: credit-weighted mean; rows without points do not count, 0 without credits."""
    return F.coalesce(credit_weighted_mean(points, credits), F.lit(0.0))


def credit_weighted_mean(points, credits) -> Column:
    """Aggregate: credit-weighted mean, null where no credits were graded."""
    points, credits = _col(points), _col(credits)
    return ratio(F.sum(points * credits), F.sum(F.when(points.isNotNull(), credits)))


def degree_progress(done, required=None) -> Column:
    """Share of the required credits, at most 1; 0 where nothing is required."""
    required = F.lit(DEGREE_CREDITS) if required is None else _col(required)
    done = _col(done)
    share = F.least(ratio(done, required), F.lit(1.0))
    return F.when(required == 0, F.lit(0.0)).when(done.isNotNull(), share)


def credits_for_grade(grade, course_credits) -> Column:
    return F.when(_col(grade) == "F", F.lit(0).cast("long")).otherwise(_col(course_credits))


def tenure_status(rank, recorded) -> Column:
    """Tenure implied by rank. Associates may hold either, so the recorded value stands."""
    rank = _col(rank)
    chain = F.when(rank == "Associate Professor", _col(recorded))
    for name, status in TENURE_BY_RANK.items():
        chain = chain.when(rank == name, status)
    return chain.when(rank.isNotNull(), "Non-Tenure-Track")
