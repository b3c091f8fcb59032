"""As-of lookup of effective-dated attributes.

A history table holds attribute rows, each valid from its effective date until the next
later date of the same key. A fact takes the rows of the latest effective date not after
its own date. All rows tied on that date match, so a fact can come out more than once;
a fact without a match is kept with NULL attributes.

The history side is prepared alone: each row gets the date its version ends on. The facts
are then joined once, by equality on the key (a fact is compared with the versions of its
key in the report period) or, for a history without key, on the day. ``asof_join_bucketed``
is for facts without a known period: it joins by key and month, so that a fact meets the
versions of one month, however long its key's history is.

Tables carry no broadcast hint. Spark broadcasts a side whose size it has checked against
``autoBroadcastJoinThreshold``; past that the joins are sort-merge joins whose hot keys
AQE splits on the fact side.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FROM = "__asof_from"
_UNTIL = "__asof_until"
_EFFECTIVE = "__asof_effective"
_DAY = "__asof_day"
_MONTH = "__asof_month"
_BUCKET = "__asof_bucket"


def asof_join(
    facts: DataFrame,
    history: DataFrame,
    keys: Mapping[str, str],
    fact_date: str,
    effective: str,
    attributes: Mapping[str, str],
    since: date | Column | None = None,
    until: date | Column | None = None,
) -> DataFrame:
    """Left as-of join on equal keys.

    A fact is compared with all usable versions of its key: give the bounds, or use
    ``asof_join_bucketed`` where histories are long.

    ``keys`` maps fact columns to history columns, ``attributes`` maps output names to
    history columns. ``since`` and ``until`` are promises about the facts: none is dated
    before or after them. They drop versions no fact can use, which leaves at most one
    version per day of the period and key to choose from.
    """
    rows = _versions(history, keys, effective, attributes, until)
    if since is not None:
        rows = rows.where(F.col(_UNTIL).isNull() | (F.col(_UNTIL) > F.lit(since)))
    row_keys = _row_keys(keys)
    return facts.join(
        rows, [*_equal(keys, row_keys), _in_force(fact_date)], "left"
    ).drop(*row_keys, _FROM, _UNTIL)


def asof_join_bucketed(
    facts: DataFrame,
    history: DataFrame,
    keys: Mapping[str, str],
    fact_date: str,
    effective: str,
    attributes: Mapping[str, str],
) -> DataFrame:
    """``asof_join`` over any span of dates, by key and month.

    A version is stored under its key and the month it begins in, and again under every
    later month that has facts of the key and that it is still in force at the start of.
    A fact then meets, by equality, the versions that begin in its month and the one its
    month opens with: at most one per day and tied row, not a key's whole history, and a
    hot key is spread over its months. What versions are stored again grows with the
    (key, month) pairs of the facts, which are counted in one more pass over two columns,
    combined before the shuffle; far dates of the history cost nothing.
    """
    row_keys = _row_keys(keys)
    rows = _versions(history, keys, effective, attributes).withColumn(
        _MONTH, F.trunc(_FROM, "month")
    )
    months = (
        facts.select(*_renamed(keys, row_keys), F.trunc(fact_date, "month").alias(_MONTH))
        .where(F.col(_MONTH).isNotNull())
        .distinct()
    )
    # The last version before each month, by one pass over months and distinct versions.
    marks = (
        rows.select(*row_keys, F.col(_FROM).alias(_DAY), F.col(_FROM).alias(_EFFECTIVE))
        .distinct()
        .withColumn(_MONTH, F.lit(None).cast("date"))
        .unionByName(
            months.withColumn(_DAY, F.col(_MONTH)).withColumn(
                _EFFECTIVE, F.lit(None).cast("date")
            )
        )
    )
    # A version that begins on the first of a month is not before it: months come first.
    before = Window.partitionBy(*row_keys).orderBy(_DAY, F.col(_MONTH).isNull())
    opening = (
        marks.withColumn(_EFFECTIVE, F.last(_EFFECTIVE, ignorenulls=True).over(before))
        .where(F.col(_MONTH).isNotNull() & F.col(_EFFECTIVE).isNotNull())
        .select(*row_keys, F.col(_EFFECTIVE).alias(_FROM), _MONTH)
    )
    stored_again = rows.drop(_MONTH).join(opening, [*row_keys, _FROM])
    buckets = rows.unionByName(stored_again).withColumnRenamed(_MONTH, _BUCKET)
    same_month = F.trunc(fact_date, "month") == F.col(_BUCKET)
    return facts.join(
        buckets, [*_equal(keys, row_keys), same_month, _in_force(fact_date)], "left"
    ).drop(*row_keys, _FROM, _UNTIL, _BUCKET)


def asof_join_unkeyed(
    facts: DataFrame,
    history: DataFrame,
    fact_date: str,
    effective: str,
    attributes: Mapping[str, str],
    since: date | Column | None = None,
    until: date | Column | None = None,
) -> DataFrame:
    """Left as-of join where every fact uses the same history (a user-wide default).

    Without a key the range condition alone would be a nested-loop join. The history is
    written out as a calendar instead, the attributes of each day between ``since`` and
    ``until``, so that a fact finds its rows by equality on the day. The two are promises
    about the facts (dates, or scalar columns); left out, they are the facts' own first and
    last day. The calendar has one row per day and tied row, whatever the history spans.
    """
    # Both from one pass over one column.
    span = facts.agg(F.struct(F.min(fact_date).alias("first"), F.max(fact_date).alias("last")))
    first = F.lit(since) if since is not None else span.scalar()["first"]
    last = F.lit(until) if until is not None else span.scalar()["last"]
    usable = history.where(F.col(effective).isNotNull())
    # One row per distinct effective date meets here.
    by_date = Window.partitionBy(F.lit(0)).orderBy(_FROM)
    versions = (
        usable.select(F.col(effective).alias(_FROM))
        .distinct()
        .withColumn(_UNTIL, F.lead(_FROM).over(by_date))
        .where((F.col(_FROM) <= last) & (F.col(_UNTIL).isNull() | (F.col(_UNTIL) > first)))
    )
    days = F.sequence(
        F.greatest(F.col(_FROM), first), F.least(F.coalesce(F.date_sub(_UNTIL, 1), last), last)
    )
    rows = usable.select(
        F.col(effective).alias(_EFFECTIVE), *_renamed(attributes.values(), attributes)
    )
    calendar = versions.select(_FROM, F.explode(days).alias(_DAY)).join(
        rows, F.col(_FROM) == F.col(_EFFECTIVE)
    )
    return facts.join(
        calendar.select(_DAY, *attributes), F.col(fact_date) == F.col(_DAY), "left"
    ).drop(_DAY)


def _row_keys(keys: Mapping[str, str]) -> list[str]:
    return [f"__asof_key{i}" for i in range(len(keys))]


def _versions(
    history: DataFrame,
    keys: Mapping[str, str],
    effective: str,
    attributes: Mapping[str, str],
    until: date | Column | None = None,
) -> DataFrame:
    """Usable history rows with the date their version ends on, NULL for the last one."""
    row_keys = _row_keys(keys)
    usable = F.col(effective).isNotNull()
    for column in keys.values():
        usable = usable & F.col(column).isNotNull()
    if until is not None:
        usable = usable & (F.col(effective) <= F.lit(until))
    # Rows tied on a date end together, on the next later date of their key. From the last
    # date down the frame only grows, so a long history takes linear time.
    later = (
        Window.partitionBy(*row_keys)
        .orderBy(F.unix_date(_FROM).desc())
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    return (
        history.where(usable)
        .select(
            *_renamed(keys.values(), row_keys),
            F.col(effective).alias(_FROM),
            *_renamed(attributes.values(), attributes),
        )
        .withColumn(_UNTIL, F.min(_FROM).over(later))
    )


def _in_force(fact_date: str) -> Column:
    day = F.col(fact_date)
    return (F.col(_FROM) <= day) & (F.col(_UNTIL).isNull() | (day < F.col(_UNTIL)))


def _renamed(columns: Iterable[str], names: Iterable[str]) -> list[Column]:
    return [F.col(column).alias(name) for column, name in zip(columns, names)]


def _equal(left: Iterable[str], right: Iterable[str]) -> list[Column]:
    return [F.col(a) == F.col(b) for a, b in zip(left, right)]
