"""Click-to-install latency: JSON click time, exact difference, bucket labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_HOUR = 3_600 * MICROS_PER_SECOND

# Labels with their inclusive upper bound, and the label beyond them.
COHORT_SECONDS = (("<30", 30), ("<120", 120))
COHORT_BEYOND = ">120"
COHORT_LABELS = ("<30", "<120", ">120")
DISTRIBUTION_HOURS = (
    ("first_hour", 1),
    ("first_day", 24),
    ("second_day", 48),
    ("third_day", 72),
)
DISTRIBUTION_BEYOND = "more_than_3_days"


CLICK_TIME = "click_time"


def click_time(raw_data: Column, strict: bool = False) -> Column:
    """Timestamp under the key ``Click Time``; NULL when missing.

    One that is not a timestamp is NULL too, or an error when ``strict``.
    """
    found = F.get_json_object(raw_data, "$['Click Time']")
    return found.cast("timestamp_ntz") if strict else found.try_cast("timestamp_ntz")


def clicked(installs: DataFrame, strict: bool = False) -> Column:
    """The click time of an install: the stored column, or else parsed from the JSON."""
    if CLICK_TIME in installs.columns:
        return F.col(CLICK_TIME)
    return click_time(F.col("raw_data"), strict).alias(CLICK_TIME)


def latency_micros(clicked: Column, installed: Column) -> Column:
    """Whole microseconds from click to install.

    Integer microseconds keep fractions of a second (30.4 s is not within 30 s)
    without floating point. A click after the install gives a negative number.
    """
    return F.timestamp_diff("MICROSECOND", clicked, installed)


def bucket(
    micros: Column, bounds: Sequence[tuple[str, int]], unit: int, beyond: str
) -> Column:
    """Label of the first bound (in ``unit`` microseconds) not below ``micros``.

    There is no lower bound, so negative latency gets the first label; NULL latency
    gets ``beyond``.
    """
    (first_label, first_bound), *rest = bounds
    label = F.when(micros <= first_bound * unit, first_label)
    for name, bound in rest:
        label = label.when(micros <= bound * unit, name)
    return label.otherwise(beyond)


def cohort_label(micros: Column) -> Column:
    return bucket(micros, COHORT_SECONDS, MICROS_PER_SECOND, COHORT_BEYOND)


def distribution_label(micros: Column) -> Column:
    return bucket(micros, DISTRIBUTION_HOURS, MICROS_PER_HOUR, DISTRIBUTION_BEYOND)
