import random

import pytest

from clickloom.operators import count_matrix
from clickloom.plans import update_users_items
from clickloom.schemas import EVENT
from clickloom.sinks import split_by_kind, write_snapshot
from clickloom.sources import (
    latest_snapshot,
    read_events_dir,
    read_snapshot,
    read_snapshot_counts,
)
from clickloom.sources.paths import Directory

DAY = 86_400_000
START = 1587340800000  # 2020-04-20 00:00 UTC


def random_events(seed, days, users, items, size=200):
    rng = random.Random(seed)
    return [
        (
            "c",
            rng.choice(["buy", "view", "cart"]),
            f"Item-{rng.randrange(*items)}.sum",
            5,
            START + rng.randrange(*days) * DAY + 1,
            rng.choice([None, *[f"u{u}" for u in range(*users)]]),
        )
        for _ in range(size)
    ]


def split(spark, events, path):
    split_by_kind(spark.createDataFrame(events, EVENT), str(path))
    return str(path)


def whole_matrix(spark, *dirs):
    both = None
    for path in dirs:
        for kind in ("view", "buy"):
            part = read_events_dir(spark, path, kind)
            both = part if both is None else both.unionByName(part)
    return count_matrix(both, "uid", "item_id")


FIRST = random_events(1, (0, 10), (0, 8), (0, 5))
SECOND = random_events(2, (10, 11), (5, 12), (3, 8))


def test_update_adds_users_and_items_to_the_newest_snapshot(spark, rows, tmp_path):
    out = str(tmp_path / "users-items")
    one, two = split(spark, FIRST, tmp_path / "v1"), split(spark, SECOND, tmp_path / "v2")
    assert update_users_items(spark, one, out).endswith("/20200429")
    assert update_users_items(spark, two, out).endswith("/20200430")
    assert latest_snapshot(spark, out) == "20200430"
    got, expected = read_snapshot(spark, out, "20200430"), whole_matrix(spark, one, two)
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)
    assert rows(read_snapshot(spark, out, "20200429")) == rows(whole_matrix(spark, one))
    assert not [p.name for p in (tmp_path / "users-items").iterdir() if not p.name.isdigit()]


def test_update_off_starts_anew(spark, rows, tmp_path):
    out = str(tmp_path / "users-items")
    one, two = split(spark, FIRST, tmp_path / "v1"), split(spark, SECOND, tmp_path / "v2")
    update_users_items(spark, one, out)
    update_users_items(spark, two, out, update=False)
    assert rows(read_snapshot(spark, out, "20200430")) == rows(whole_matrix(spark, two))


def test_merging_into_the_same_date_reads_before_it_replaces(spark, rows, tmp_path):
    """The snapshot that is read is the one that is replaced; counts add up when asked to."""
    out = str(tmp_path / "users-items")
    path = split(spark, SECOND, tmp_path / "v")
    update_users_items(spark, path, out)
    update_users_items(spark, path, out, same_date="add")
    once = whole_matrix(spark, path)
    doubled = [(u, *[2 * n for n in cells]) for u, *cells in rows(once)]
    assert rows(read_snapshot(spark, out, "20200430")) == doubled


def test_update_on_a_snapshot_without_long_counts(spark, rows, tmp_path):
    out = str(tmp_path / "users-items")
    one, two = split(spark, FIRST, tmp_path / "v1"), split(spark, SECOND, tmp_path / "v2")
    write_snapshot(whole_matrix(spark, one), out, "20200429")
    update_users_items(spark, two, out)
    assert rows(read_snapshot(spark, out, "20200430")) == rows(whole_matrix(spark, one, two))
    counts = read_snapshot_counts(spark, out, "20200430", "uid", "item_id")
    assert counts.columns == ["uid", "item_id", "n"]


def test_date_is_that_of_the_newest_row_even_if_anonymous(spark, tmp_path):
    events = [("c", "view", "a", 1, START, "u"), ("c", "view", "a", 1, START + 3 * DAY, None)]
    out = str(tmp_path / "out")
    path = update_users_items(spark, split(spark, events, tmp_path / "v"), out)
    assert path.endswith("/20200423")
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("u", 1)]


def test_no_events_write_nothing(spark, tmp_path):
    empty = split(spark, FIRST[:0], tmp_path / "v")
    assert update_users_items(spark, empty, str(tmp_path / "out")) is None
    assert latest_snapshot(spark, str(tmp_path / "out")) is None


def test_latest_snapshot_takes_digits_only_as_numbers(spark, tmp_path):
    assert latest_snapshot(spark, str(tmp_path / "none")) is None
    for name in ("20200429", "20200501", "99", "20200601-bad", "_staging-1", "zzz"):
        (tmp_path / name).mkdir()
    (tmp_path / "20210101").write_text("a file, no snapshot")
    assert latest_snapshot(spark, str(tmp_path)) == "20200501"


def test_failed_write_leaves_the_old_snapshot(spark, rows, tmp_path):
    good = spark.createDataFrame([("u", 1)], "uid string, a bigint")
    write_snapshot(good, str(tmp_path), "20200101")
    broken = good.selectExpr("uid", "raise_error('no') AS a")
    with pytest.raises(Exception, match="no"):
        write_snapshot(broken, str(tmp_path), "20200101")
    assert rows(read_snapshot(spark, str(tmp_path), "20200101")) == [("u", 1)]
    assert [p.name for p in tmp_path.iterdir()] == ["20200101"]


def test_replace_never_loses_the_old_content(spark, tmp_path):
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "data").write_text("1")
    missing = Directory(spark, str(tmp_path / "missing"))
    with pytest.raises(Exception):
        missing.replace(Directory(spark, str(tmp_path / "old")))
    assert [p.name for p in tmp_path.iterdir()] == ["old"]
    assert (tmp_path / "old" / "data").read_text() == "1"


def test_a_day_that_comes_again_is_replaced(spark, rows, tmp_path):
    out = str(tmp_path / "users-items")
    one, two = split(spark, FIRST, tmp_path / "v1"), split(spark, SECOND, tmp_path / "v2")
    for path in (one, two, two, one):
        update_users_items(spark, path, out)
    assert rows(read_snapshot(spark, out, "20200430")) == rows(whole_matrix(spark, one, two))
    with pytest.raises(ValueError, match="same_date"):
        update_users_items(spark, two, out, same_date="both")


def test_late_batch_is_in_the_newest_snapshot(spark, rows, tmp_path):
    out = str(tmp_path / "users-items")
    late = random_events(3, (0, 1), (20, 22), (0, 5))
    parts = [random_events(4, (9, 10), (0, 5), (0, 5)), late, random_events(5, (10, 11), (0, 5), (0, 5))]
    dirs = [split(spark, part, tmp_path / f"v{i}") for i, part in enumerate(parts)]
    names = [update_users_items(spark, path, out).rpartition("/")[2] for path in dirs]
    assert names == ["20200429", "20200429", "20200430"]
    assert rows(read_snapshot(spark, out, "20200430")) == rows(whole_matrix(spark, *dirs))


def test_too_many_items_for_a_table_keep_all_counts(spark, tmp_path):
    out = str(tmp_path / "users-items")
    one, two = split(spark, FIRST, tmp_path / "v1"), split(spark, SECOND, tmp_path / "v2")
    spark.conf.set("spark.sql.pivotMaxValues", "2")
    try:
        for path in (one, two):
            with pytest.raises(ValueError, match="long form"):
                update_users_items(spark, path, out)
        update_users_items(spark, two, out, wide=False)
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
    counts = read_snapshot_counts(spark, out, "20200430", "uid", "item_id")
    events = [e for e in FIRST + SECOND if e[1] in ("buy", "view") and e[5] is not None]
    assert counts.agg({"n": "sum"}).head()[0] == len(events)
    # The wide form is made on demand once a table may have the columns.
    whole = whole_matrix(spark, one, two)
    assert sorted(map(tuple, read_snapshot(spark, out, "20200430").collect())) == sorted(map(tuple, whole.collect()))


def test_writer_restores_what_a_dead_one_set_aside(spark, rows, tmp_path):
    good = spark.createDataFrame([("u", 1)], "uid string, a bigint")
    write_snapshot(good, str(tmp_path), "20200101")
    (tmp_path / "20200101").rename(tmp_path / "_old-0123abcd-20200101")
    assert latest_snapshot(spark, str(tmp_path)) is None
    write_snapshot(good, str(tmp_path), "20200102")
    assert rows(read_snapshot(spark, str(tmp_path), "20200101")) == [("u", 1)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["20200101", "20200102"]


def test_dates_prune_directories(spark, tmp_path):
    path = split(spark, FIRST, tmp_path / "v")
    day = read_events_dir(spark, path, "view", dates=["20200421"])
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_date" in plan
    expected = [e for e in FIRST if e[1] == "view" and e[4] // DAY == START // DAY + 1]
    assert day.count() == len(expected)
    late = read_events_dir(spark, path, "view", since="20200425")
    assert late.count() == sum(e[1] == "view" and e[4] // DAY >= START // DAY + 5 for e in FIRST)
