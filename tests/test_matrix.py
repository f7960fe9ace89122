from collections import Counter
import random

import pytest

from clickloom.operators import (
    count_map,
    count_long,
    count_matrix,
    distinct_values,
    max_event_date,
    merge_matrix,
    sum_by_key,
    to_long,
    to_wide,
    union_missing,
)

VISITS = [
    ("u1", "view_a"), ("u1", "view_a"), ("u1", "buy_b.x"), ("u2", "view_summer_1"),
    (None, "view_a"), ("u3", None), ("u3", "it's"),
]


def visits(spark, data=VISITS):
    return spark.createDataFrame(data, "uid string, item_id string")


def as_dicts(df):
    return {r["uid"]: {k: v for k, v in r.asDict().items() if k != "uid"} for r in df.collect()}


def test_count_long_drops_null_keys(spark, rows):
    assert rows(count_long(visits(spark), "uid", "item_id")) == [
        ("u1", "buy_b.x", 1), ("u1", "view_a", 2), ("u2", "view_summer_1", 1), ("u3", "it's", 1),
    ]


def test_count_matrix_columns_are_sorted_and_absent_is_zero(spark):
    wide = count_matrix(visits(spark), "uid", "item_id")
    assert wide.columns == ["uid", "buy_b.x", "it's", "view_a", "view_summer_1"]
    assert as_dicts(wide)["u1"] == {"buy_b.x": 1, "it's": 0, "view_a": 2, "view_summer_1": 0}


def test_item_names_may_be_numbers(spark, rows):
    df = spark.createDataFrame([("u", 7), ("u", 7), ("v", 10)], "uid string, item int")
    wide = count_matrix(df, "uid", "item")
    assert wide.columns == ["uid", "7", "10"]
    assert rows(wide) == [("u", 2, 0), ("v", 0, 1)]


def test_rows_without_any_listed_value_stay(spark):
    wide = count_matrix(visits(spark), "uid", "item_id", ["view_a"])
    assert as_dicts(wide) == {"u1": {"view_a": 2}, "u2": {"view_a": 0}, "u3": {"view_a": 0}}
    assert sorted(r.uid for r in count_matrix(visits(spark), "uid", "item_id", []).collect()) == [
        "u1", "u2", "u3",
    ]


def test_wide_and_back(spark, rows):
    counts = count_long(visits(spark), "uid", "item_id")
    wide = to_wide(counts, "uid", "item_id", distinct_values(counts, "item_id"))
    back = to_long(wide, "uid", "item_id")
    assert rows(back.where("n > 0")) == rows(counts)
    assert rows(back.select("uid").distinct()) == [("u1",), ("u2",), ("u3",)]


def test_distinct_values_refuses_more_columns_than_a_table_can_have(spark):
    before = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "3")
    try:
        with pytest.raises(ValueError, match="long form"):
            distinct_values(visits(spark), "item_id")
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", before)


def test_union_missing_fills_only_what_one_side_lacks(spark, rows):
    a = spark.createDataFrame([("x", 1, None)], "uid string, `m.n` bigint, k bigint")
    b = spark.createDataFrame([("y", 2)], "uid string, z int")
    both = union_missing(a, b)
    assert both.columns == ["k", "m.n", "uid", "z"]
    assert rows(both) == [(0, 0, "y", 2), (None, 1, "x", 0)]
    assert dict(both.dtypes)["z"] == "int"


def test_sum_by_key_keeps_names(spark, rows):
    df = spark.createDataFrame(
        [("x", 1, 2, "t"), ("x", 3, 4, "t"), ("y", 5, 6, "t")],
        "uid string, view_summer_1 bigint, `a.b` bigint, note string",
    )
    total = sum_by_key(df, "uid")
    assert total.columns == ["uid", "view_summer_1", "a.b"]
    assert rows(total) == [("x", 4, 6), ("y", 5, 6)]


@pytest.mark.parametrize("seed", range(3))
def test_merging_two_periods_equals_counting_both(spark, rows, seed):
    rng = random.Random(seed)

    def period(users, items):
        return [
            (f"u{rng.randrange(*users)}", f"item_{rng.randrange(*items)}.sum") for _ in range(200)
        ]

    first, second = period((0, 12), (0, 6)), period((8, 20), (4, 9))
    old, new = (count_matrix(visits(spark, p), "uid", "item_id") for p in (first, second))
    merged = merge_matrix(old, new, "uid")
    whole = count_matrix(visits(spark, first + second), "uid", "item_id")
    assert merged.columns == whole.columns
    assert rows(merged) == rows(whole)
    by_sums = sum_by_key(union_missing(old, new), "uid").select(
        *[f"`{c}`" for c in whole.columns]
    )
    assert rows(by_sums) == rows(whole)
    cells = Counter(first + second)
    assert as_dicts(merged)[first[0][0]][first[0][1]] == cells[first[0]]


def test_merge_keeps_a_row_of_zeros(spark, rows):
    old = spark.createDataFrame([("u", 0, 0), ("v", 1, 0)], "uid string, a bigint, b bigint")
    new = spark.createDataFrame([("v", 2)], "uid string, c bigint")
    assert rows(merge_matrix(old, new, "uid")) == [("u", 0, 0, 0), ("v", 1, 0, 2)]


def test_max_event_date(spark):
    df = spark.createDataFrame([("20200430",), ("20200501",), (None,)], "date string")
    assert max_event_date(df) == "20200501"
    assert max_event_date(df.where("date is null")) is None


def test_items_that_differ_in_case_only_are_refused(spark):
    df = spark.createDataFrame([("u", "X"), ("u", "x")], "uid string, item string")
    with pytest.raises(ValueError, match="'X' and 'x'"):
        count_matrix(df, "uid", "item")
    assert count_map(count_long(df, "uid", "item"), "uid", "item").head()["items"] == {"X": 1, "x": 1}
