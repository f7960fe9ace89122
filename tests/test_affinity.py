from collections import Counter
from decimal import Decimal
import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import fits_broadcast, segment_affinity, valid_log_rows
from clickloom.plans import rank_domains
from clickloom.sources import read_segment, read_weblog

LOG = """\
123\t1354546464.210\thttp%3A%2F%2Fwww.cars.ru%2Fsample-page-1
123\t1354546464.211\thttp%3A%2F%2Fauto.ru%2Fsample-page-2
123\t8452135545.123\thttp%3A%2F%2Fya.ru%2Fsample-page-1
456\t1234564654.231\thttp%3A%2F%2Fwww.ya.ru%2Fsample-page-1
456\t8452135545.123\thttp%3A%2F%2Fauto.ru%2Fsample-page-1
456\t4568797889.549\thttp%3A%2F%2Fya.ru%2Fstart
456\t4568797889.549\thttp%3A%2F%2Fmarket.ya.ru%2Fstart
789\t1234564654.231\thttp%3A%2F%2Fwww.auto.ru%2Fsample-page-1
789\t1354546464.211\thttp%3A%2F%2Fwww.cars.ru%2Fsample-page-2
789\t4568797889.549\thttp%3A%2F%2Fya.ru%2Fstart
"""
JUNK = """\
-\t1.0\thttp%3A%2F%2Fanonymous.ru%2F
123\t1.0\t-
123\t1.0\tftp%3A%2F%2Ffiles.ru%2F
123\t1.0\thttp%3A%2F%2F
123\t1.0\thttpx%3A%2F%2Fother.ru%2F
"""


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_golden_ranking_from_files(spark, tmp_path):
    write(tmp_path / "logs" / "part-1", LOG)
    write(tmp_path / "logs" / "part-2", JUNK)
    segment = write(tmp_path / "autousers.json", '{"autousers": ["123", "789", "123"]}')
    out = str(tmp_path / "ranked")
    rank_domains(spark, str(tmp_path / "logs"), segment, out)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines == [
        "cars.ru\t0.33333333333333330000",
        "auto.ru\t0.22222222222222220000",
        "ya.ru\t0.16666666666666666000",
        "market.ya.ru\t0.00000000000000000000",
    ]


def test_unreadable_time_does_not_drop_a_row(spark, tmp_path):
    path = write(tmp_path / "log", "7\tnever\thttp%3A%2F%2Fa%2Bb.ru%2F%zz\n8\t1.5\t\n")
    got = valid_log_rows(read_weblog(spark, path)).collect()
    assert [(r.uid, r.ts, r.domain) for r in got] == [(7, None, "a+b.ru")]


def test_segment_reader(spark, tmp_path):
    path = write(tmp_path / "s.json", '{"ids": ["1", "2",\n "2", "-", "x"]}')
    got = read_segment(spark, path, field="ids", multi_line=True)
    assert sorted(r.uid for r in got.collect()) == [1, 2]


def brute_force(log, segment, k):
    every, own = Counter(), Counter()
    for uid, item in log:
        if item is not None and uid is not None:
            every[item] += 1
            own[item] += uid in segment
    total = sum(own.values())
    scored = [
        (Decimal(own[i] ** 2 / (every[i] * total)).quantize(Decimal(10) ** -12), i) for i in every
    ]
    return [i for _, i in sorted(scored, key=lambda s: (-s[0], s[1]))][:k]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_ranking_matches_brute_force_with_a_hot_user(spark, broadcast_bytes):
    rng = random.Random(3)
    log = [(rng.randrange(40), f"i{rng.randrange(30):02d}") for _ in range(1500)]
    log += [(5, f"i{rng.randrange(30):02d}") for _ in range(900)] 
    log += [(5, None)] * 3 + [(None, "i01")] * 50
    segment = set(range(0, 40, 5))
    df = spark.createDataFrame(log, "uid bigint, item string")
    members = spark.createDataFrame([(u,) for u in segment] * 2 + [(None,)], "uid bigint")
    got = segment_affinity(df, members, "item", 12, broadcast_bytes=broadcast_bytes).collect()
    assert [r.item for r in got] == brute_force(log, segment, 12)


def test_perfect_score_and_empty_segment(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a")], "uid bigint, item string")
    one = spark.createDataFrame([(1,)], "uid bigint")
    assert segment_affinity(df, one, "item").first()["relevance"] == Decimal(1)
    none = spark.createDataFrame([(2,)], "uid bigint")
    assert segment_affinity(df, none, "item").first()["relevance"] is None


def test_ties_are_ordered_by_item(spark):
    df = spark.createDataFrame([(1, i) for i in "dbca"], "uid bigint, item string")
    one = spark.createDataFrame([(1,)], "uid bigint")
    assert [r.item for r in segment_affinity(df, one, "item", 3).collect()] == ["a", "b", "c"]


def test_fits_broadcast(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 100, "x").alias("k"))
    assert fits_broadcast(df, 1000 * 140) and not fits_broadcast(df, 1000 * 139)
    assert fits_broadcast(df.where("k = 'none'"), 0)
