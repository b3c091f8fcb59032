from __future__ import annotations

import random
import time
from datetime import date, timedelta

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from adlytics.operators import asof_join, asof_join_bucketed, asof_join_unkeyed

FACTS = "fact bigint, key bigint, day date"
HISTORY = "owner bigint, eff date, value bigint"


def jan(day: int) -> date:
    return date(2024, 1, day)


def keyed(facts, history, **bounds):
    return asof_join(
        facts, history, {"key": "owner"}, "day", "eff", {"value": "value"}, **bounds
    )


def bucketed(facts, history):
    return asof_join_bucketed(
        facts, history, {"key": "owner"}, "day", "eff", {"value": "value"}
    )


def brute_force(facts, history, by_key=True):
    """Every fact against every history row."""
    found = []
    for fact, key, day in facts:
        known = [
            (eff, value)
            for owner, eff, value in history
            if eff is not None
            and day is not None
            and eff <= day
            and (not by_key or (owner is not None and owner == key))
        ]
        latest = max((eff for eff, _ in known), default=None)
        values = [value for eff, value in known if eff == latest] or [None]
        found += [(fact, key, day, value) for value in values]
    return sorted(found, key=str)


def random_tables(seed: int):
    rng = random.Random(seed)
    start = jan(1)
    facts = [
        (
            i,
            rng.choice([None, 1, 1, 1, 2, 3]),
            rng.choice([None] + [start + timedelta(days=rng.randrange(40))] * 9),
        )
        for i in range(80)
    ]
    history = [
        (
            rng.choice([None, 1, 1, 2, 4]),
            rng.choice([None] + [start + timedelta(days=rng.randrange(45))] * 9),
            i,
        )
        for i in range(60)
    ]
    return facts, history


def test_latest_date_wins_ties_fan_out_and_unmatched_facts_stay(spark):
    facts = spark.createDataFrame(
        [(1, 1, jan(4)), (2, 1, jan(5)), (3, 1, jan(9)), (4, 1, jan(30)), (5, 2, jan(9)),
         (6, None, jan(9))],
        FACTS,
    )
    history = spark.createDataFrame(
        [(1, jan(5), 10), (1, jan(9), 20), (1, jan(9), 21), (None, jan(1), 99), (1, None, 98)],
        HISTORY,
    )
    assert rows(keyed(facts, history), "fact", "value") == [
        (1, None), (2, 10), (3, 20), (3, 21), (4, 20), (4, 21), (5, None), (6, None),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_keyed_equals_brute_force(spark, seed):
    facts, history = random_tables(seed)
    result = keyed(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(history, HISTORY)
    )
    assert rows(result) == brute_force(facts, history)


def test_keyed_equals_brute_force_without_broadcast(spark, sort_merge):
    facts, history = random_tables(7)
    result = keyed(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(history, HISTORY)
    )
    assert rows(result) == brute_force(facts, history)
    text = plan(result)
    assert text.count("SortMergeJoin") == 1
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_bounds_drop_versions_but_no_results(spark):
    facts, history = random_tables(11)
    facts = [f for f in facts if f[2] is not None and jan(10) <= f[2] <= jan(20)]
    result = keyed(
        spark.createDataFrame(facts, FACTS),
        spark.createDataFrame(history, HISTORY),
        since=jan(10),
        until=jan(20),
    )
    assert rows(result) == brute_force(facts, history)


@pytest.mark.parametrize("seed", range(3))
def test_unkeyed_equals_brute_force(spark, seed):
    facts, history = random_tables(seed)
    result = asof_join_unkeyed(
        spark.createDataFrame(facts, FACTS),
        spark.createDataFrame(history, HISTORY),
        "day",
        "eff",
        {"value": "value"},
    )
    assert rows(result) == brute_force(facts, history, by_key=False)
    text = plan(result)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_unkeyed_without_history_keeps_every_fact(spark):
    facts = spark.createDataFrame([(1, 1, jan(4)), (2, 1, None)], FACTS)
    result = asof_join_unkeyed(
        facts, spark.createDataFrame([], HISTORY), "day", "eff", {"value": "value"}
    )
    assert rows(result, "fact", "value") == [(1, None), (2, None)]


def test_two_keys(spark):
    facts = spark.createDataFrame(
        [(1, 1, "a", jan(5)), (2, 1, "b", jan(5)), (3, 2, "a", jan(5))],
        "fact bigint, key bigint, part string, day date",
    )
    history = spark.createDataFrame(
        [(1, "a", jan(1), 10), (1, "b", jan(2), 20), (1, "b", jan(6), 30)],
        "owner bigint, piece string, eff date, value bigint",
    )
    result = asof_join(
        facts, history, {"key": "owner", "part": "piece"}, "day", "eff", {"out": "value"}
    )
    assert rows(result, "fact", "out") == [(1, 10), (2, 20), (3, None)]


@pytest.mark.parametrize("bounds", [{}, {"since": jan(3), "until": jan(9)}])
def test_sentinel_dates_do_not_stretch_the_calendar(spark, sort_merge, bounds):
    history = [(None, date(1, 1, 1), 1), (None, jan(5), 2), (None, jan(5), 3)]
    history += [(None, date(9999, 12, 31), 4)]
    facts = [(1, 1, jan(3)), (2, 1, jan(5)), (3, 1, jan(9)), (4, 1, None)]
    result = asof_join_unkeyed(
        spark.createDataFrame(facts, FACTS),
        spark.createDataFrame(history, HISTORY),
        "day",
        "eff",
        {"value": "value"},
        **bounds,
    )
    assert rows(result) == brute_force(facts, history, by_key=False)
    text = plan(result)
    assert "NestedLoop" not in text and "Cartesian" not in text
    if bounds:
        # The facts cross the network once, by day.
        assert text.count("hashpartitioning(day") == 1


def long_history(spark, versions: int):
    """One key with two tied rows on each of ``versions / 2`` dates from 1900 on."""
    return spark.range(versions).select(
        F.lit(1).cast("bigint").alias("owner"),
        F.date_add(F.lit(date(1900, 1, 1)), (F.col("id") / 2).cast("int")).alias("eff"),
        F.col("id").alias("value"),
    )


def test_a_long_history_takes_linear_time(spark):
    facts = spark.createDataFrame(
        [(i, 1, date(1900, 1, 1) + timedelta(days=700 * i)) for i in range(10)], FACTS
    )

    def seconds(versions: int) -> float:
        history = long_history(spark, versions)
        best = 1e9
        for _ in range(3):
            begun = time.time()
            found = rows(keyed(facts, history), "fact", "value")
            best = min(best, time.time() - begun)
        assert [f for f, _ in found] == sorted([*range(10), *range(10)], key=str)
        return best

    seconds(1000)
    # Twice the versions; a window read again from every row would take four times as long.
    assert seconds(80_000) < 2 * seconds(40_000)


@pytest.mark.parametrize("seed", range(4))
def test_bucketed_equals_brute_force(spark, seed):
    rng = random.Random(100 + seed)
    days = [jan(1) + timedelta(days=rng.randrange(200)) for _ in range(60)]
    days += [date(2024, m, 1) for m in (1, 2, 3, 4, 5)] + [date(1, 1, 1), date(9999, 12, 31)]
    facts = [(i, rng.choice([None, 1, 1, 1, 2, 3]), rng.choice([None, *days])) for i in range(150)]
    history = [(rng.choice([None, 1, 1, 2, 4]), rng.choice([None, *days]), i) for i in range(80)]
    result = bucketed(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(history, HISTORY)
    )
    assert rows(result) == brute_force(facts, history)


def test_bucketed_edges(spark):
    facts = [(1, 1, jan(31)), (2, 1, date(2024, 3, 1)), (3, 1, date(2024, 2, 29)), (4, 2, jan(5))]
    facts += [(5, None, jan(5)), (6, 1, None)]
    history = [(1, jan(31), 10), (1, date(2024, 3, 1), 20), (1, date(2024, 3, 1), 21)]
    history += [(1, None, 97), (None, jan(1), 98), (2, jan(6), 99)]
    for known in (history, []):
        result = bucketed(
            spark.createDataFrame(facts, FACTS), spark.createDataFrame(known, HISTORY)
        )
        assert rows(result) == brute_force(facts, known)
    none = bucketed(spark.createDataFrame([], FACTS), spark.createDataFrame(history, HISTORY))
    assert rows(none) == []


def test_a_hot_key_meets_one_month_of_its_history(spark, sort_merge):
    """20,000 facts of one key against 40,000 dates: no pair outside a fact's month."""
    facts = spark.range(20_000).select(
        F.col("id").alias("fact"),
        (F.col("id") % 1 + 1).alias("key"),
        F.date_add(F.lit(date(1900, 1, 1)), (F.col("id") * 2).cast("int")).alias("day"),
    )
    result = bucketed(facts, long_history(spark, 80_000))
    text = plan(result)
    assert "NestedLoop" not in text and "Cartesian" not in text
    # The month is a key of the join, so the hot key is dealt out by month.
    assert "SortMergeJoin [key#" in text.split("hashpartitioning")[0]
    assert "trunc(day" in text.split("hashpartitioning")[1]
    begun = time.time()
    assert result.count() == 40_000
    assert time.time() - begun < 30
    # Tied rows 4 * id and 4 * id + 1 begin on the fact's own day.
    wrong = result.where(F.floor(F.col("value") / 4) != F.col("fact"))
    assert wrong.count() == 0
