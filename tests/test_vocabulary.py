import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import top_items
from clickloom.plans.vocabulary import add_dates, summaries, top_items_by_date
from clickloom.versions import VersionedFolder

DATES = [f"202001{d:02d}" for d in range(1, 9)]


def visits(spark, seed=1, items=60, size=900, dates=DATES):
    rng = random.Random(seed)
    names = [f"d{i:02d}" for i in range(items)] + ["null", None]
    rows = [(rng.choice(dates), rng.choices(names, [3 + i % 7 for i in range(len(names))])[0]) for _ in range(size)]
    return spark.createDataFrame([*rows, (None, "d00")], "date string, item string")


def plain(df, n):
    return [tuple(r) for r in top_items(df.where("date IS NOT NULL"), "item", n).collect()]


@pytest.mark.parametrize("m", [1, 5, 1000])
@pytest.mark.parametrize("n", [1, 12, 100])
def test_equals_one_count_over_all_visits(spark, tmp_path, m, n):
    """Even counts and few visits: nearly all is ties, and short summaries must be widened."""
    df = visits(spark).cache()
    root = str(tmp_path)
    for dates in (DATES[:5], DATES[5:]):
        add_dates(df.where(F.col("date").isin(dates)), root, m)
    assert [tuple(r) for r in top_items_by_date(spark, root, n).collect()] == plain(df, n)
    some = DATES[1:4] + ["20300101"]
    assert [tuple(r) for r in top_items_by_date(spark, root, n, some).collect()] == plain(df.where(F.col("date").isin(some)), n)


def test_an_item_below_every_summary_can_be_first(spark, tmp_path):
    """Second on every date, first over all of them."""
    rows = [(d, f"only-{d}") for d in DATES for _ in range(5)] + [(d, "everywhere") for d in DATES for _ in range(4)]
    df = spark.createDataFrame(rows, "date string, item string")
    add_dates(df, str(tmp_path), 1)
    assert [tuple(r) for r in top_items_by_date(spark, str(tmp_path), 1).collect()] == [(0, "everywhere", 32)]
    assert VersionedFolder(spark, str(tmp_path)).latest().notes == {"m": 4}


def test_long_summaries_are_not_widened(spark, tmp_path):
    rows = [(d, f"i{i}") for d in DATES for i in range(20) for _ in range(2**max(0, 8 - i))]
    add_dates(spark.createDataFrame(rows, "date string, item string"), str(tmp_path), 8)
    assert [r.item for r in top_items_by_date(spark, str(tmp_path), 3).collect()] == ["i0", "i1", "i2"]
    assert VersionedFolder(spark, str(tmp_path)).numbers() == [1]


def test_a_date_that_comes_again_is_replaced_and_no_other_is_written(spark, tmp_path):
    df = visits(spark)
    store = VersionedFolder(spark, str(tmp_path))
    old = add_dates(df, str(tmp_path), 5)
    new = add_dates(visits(spark, 2, dates=DATES[:1]), str(tmp_path), 5)
    assert {n for n in new.parts if new.parts[n] != old.parts[n]} == {f"{p}/{DATES[0]}" for p in ("counts", "tops")}
    both = df.where(F.col("date") > DATES[0]).unionByName(visits(spark, 2, dates=DATES[:1]))
    assert [tuple(r) for r in top_items_by_date(spark, str(tmp_path), 10).collect()] == plain(both, 10)
    assert add_dates(df.limit(0), str(tmp_path)) == store.latest()


def test_empty_store(spark, tmp_path):
    assert top_items_by_date(spark, str(tmp_path)).collect() == []
    assert VersionedFolder(spark, str(tmp_path)).numbers() == []


def test_summary_bounds(spark):
    counts = spark.createDataFrame([("a", 5, "d"), ("b", 3, "d"), ("c", 3, "d"), ("x", 1, "e")], "item string, n bigint, date string")
    found = sorted(tuple(r) for r in summaries(counts, 2).collect())
    assert found == [("a", 5, "d", 3), ("b", 3, "d", 3), ("x", 1, "e", 0)]
