from collections import Counter, defaultdict
import datetime
import json
import random

import pytest

from clickloom import schemas
from clickloom.operators import (
    count_vector,
    feature_matrix,
    time_features,
    top_items,
    vocabulary,
)
from clickloom.plans import build_features
from clickloom.sinks import write_snapshot

START = 1577836800000  # 2020-01-01, a Wednesday


def frame(spark, data):
    return spark.createDataFrame(data, "uid string, domain string")


def vectors(df):
    return {r.uid: r.domain_features for r in df.collect()}


def test_top_items_breaks_ties_and_sorts(spark, rows):
    data = [(None, d) for d in ["b", "b", "b", "a", "a", "d", "c", "null", "null", "null", None]]
    assert [tuple(r) for r in top_items(frame(spark, data), "domain", 3).collect()] == [
        (0, "a", 2), (1, "b", 3), (2, "c", 1),
    ]
    assert vocabulary(frame(spark, data), "domain", 3) == ["a", "b", "c"]
    assert vocabulary(frame(spark, data), "domain") == ["a", "b", "c", "d"]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_vector_matches_brute_force(spark, broadcast_bytes):
    rng = random.Random(11)
    domains = [f"d{i:02d}.ru" for i in range(25)]
    data = [(f"u{rng.randrange(15)}", rng.choice([*domains, None])) for _ in range(600)]
    data += [("hot", "d03.ru")] * 400 + [("outside", "zzz.ru"), ("empty", None), (None, "d03.ru")]
    vocab = vocabulary(frame(spark, data), "domain", 12)
    got = vectors(
        count_vector(frame(spark, data), "uid", "domain", vocab, broadcast_bytes=broadcast_bytes)
    )
    seen = defaultdict(Counter)
    for uid, domain in data:
        if uid is not None:
            seen[uid][domain] += 1
    assert got == {u: [c[d] for d in vocab] for u, c in seen.items()}
    assert got["outside"] == got["empty"] == [0] * 12


@pytest.mark.parametrize("at", [0, 1, 4])
def test_vector_places_a_single_entry(spark, at):
    vocab = list("abcde")
    got = vectors(count_vector(frame(spark, [("u", vocab[at])]), "uid", "domain", vocab))
    assert got == {"u": [int(i == at) for i in range(5)]}


def test_vector_of_full_and_empty_vocabulary(spark):
    data = [("u", d) for d in "abcab"]
    assert vectors(count_vector(frame(spark, data), "uid", "domain", list("abc"))) == {
        "u": [2, 2, 1]
    }
    assert vectors(count_vector(frame(spark, data), "uid", "domain", [])) == {"u": []}
    wide = count_vector(frame(spark, data), "uid", "domain", ["a"], element_type="bigint")
    assert dict(wide.dtypes)["domain_features"] == "array<bigint>"


def test_time_features_match_brute_force(spark):
    rng = random.Random(2)
    data = [(f"u{rng.randrange(6)}", START + rng.randrange(40 * 86_400_000)) for _ in range(300)]
    got = time_features(spark.createDataFrame(data, "uid string, timestamp bigint"))
    by_user = defaultdict(list)
    for uid, ts in data:
        by_user[uid].append(
            datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=ts)
        )
    for row in got.collect():
        moments = by_user.pop(row.uid)
        days = Counter(m.strftime("%a").lower() for m in moments)
        hours = Counter(m.hour for m in moments)
        for name in ("sun", "mon", "tue", "wed", "thu", "fri", "sat"):
            assert row[f"web_day_{name}"] == days[name]
        for h in range(24):
            assert row[f"web_hour_{h}"] == hours[h]
        size = len(moments)
        assert row.web_fraction_work_hours == sum(hours[h] for h in range(9, 18)) / size
        assert row.web_fraction_evening_hours == sum(hours[h] for h in range(18, 24)) / size
    assert not by_user


def test_fractions_count_visits_without_a_domain_and_skip_anonymous(spark):
    data = [("u", START + 10 * 3_600_000), ("u", START), (None, START)]
    got = time_features(spark.createDataFrame(data, "uid string, timestamp bigint")).collect()
    assert [(r.uid, r.web_fraction_work_hours) for r in got] == [("u", 0.5)]


def test_feature_matrix_keeps_common_users_only(spark):
    a = spark.createDataFrame([("1", 1), ("2", 1)], "uid string, `view_a.b` bigint")
    b = spark.createDataFrame([("2", [1]), ("3", [1])], "uid string, domain_features array<int>")
    c = spark.createDataFrame([("2", 0.5), ("1", 0.5)], "uid string, f double")
    joined = feature_matrix(a, b, c)
    assert joined.columns == ["uid", "view_a.b", "domain_features", "f"]
    assert [r.uid for r in joined.collect()] == ["2"]


def test_feature_job_end_to_end(spark, tmp_path):
    visits = [
        {"uid": "1", "visits": [
            {"timestamp": START + 3_600_000 * 9, "url": "http://WWW.B.ru/"},
            {"timestamp": START + 3_600_000 * 18, "url": "http://a.ru/x"},
            {"timestamp": START + 3_600_000 * 18, "url": "http://a.ru/x"},
            {"timestamp": START, "url": "broken url"},
        ]},
        {"uid": "2", "visits": [{"timestamp": START, "url": "http://my.www.c.ru/"}]},
        {"uid": "3", "visits": []},
        {"uid": None, "visits": [{"timestamp": START, "url": "http://a.ru/"}]},
    ]
    (tmp_path / "weblogs.json").write_text("\n".join(json.dumps(v) for v in visits))
    matrix = spark.createDataFrame([("1", 4), ("3", 5)], "uid string, view_x bigint")
    write_snapshot(matrix, str(tmp_path / "users-items"), "20200101")
    build_features(
        spark, str(tmp_path / "weblogs.json"), str(tmp_path / "users-items"), "20200101",
        str(tmp_path / "features"), n=2,
    )
    (row,) = spark.read.parquet(str(tmp_path / "features")).collect()
    assert row.uid == "1" and row.view_x == 4
    assert row.domain_features == [2, 1]  # a.ru, b.ru
    assert row.web_day_wed == 4 and row.web_hour_18 == 2
    assert row.web_fraction_work_hours == 0.25 and row.web_fraction_evening_hours == 0.5


def test_schema_names_of_the_feature_table():
    assert schemas.USER_VISITS.fieldNames() == ["uid", "visits"]
