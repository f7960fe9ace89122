import json

import pytest

from clickloom import schemas
from clickloom.operators import (
    bucket_distribution,
    explode_visits,
    profile_mart,
    shop_category_matrix,
    web_category_matrix,
)
from clickloom.plans import build_mart
from clickloom.sinks import SinkSpec
from clickloom.sources import SourceSpec, json_files

CLIENTS = [("1", "F", 17), ("2", "M", 30), ("3", "F", 100), ("4", "M", 55)]
SHOP = [
    ("Everyday Jewelry", "view", "i", 1, 0, "2"), ("Everyday Jewelry", "buy", "i", 1, 0, "2"),
    ("Mobile-phones", "view", "i", 1, 0, "3"), ("Mobile-phones", "view", "i", 1, 0, None),
    (None, "view", "i", 1, 0, "4"),
]
LOGS = [
    ("2", [(1, "http://www.a.ru/x"), (1, "http://www.a.ru/x"), (2, "http://none.ru/")]),
    ("3", []), ("4", None), (None, [(1, "http://a.ru/")]), ("3", [(3, "http://sub.b.ru/")]),
    ("4", [(4, "bad url")]),
]
CATS = [("a.ru", "Arts and-Entertainment"), ("b.ru", "Never seen"), (None, "x")]


def inputs(spark):
    return (
        spark.createDataFrame(CLIENTS, schemas.CLIENT),
        spark.createDataFrame(SHOP, schemas.EVENT),
        spark.createDataFrame(LOGS, schemas.USER_VISITS),
        spark.createDataFrame(CATS[:2], schemas.DOMAIN_CATEGORY),
    )


def test_explode_keeps_duplicates_and_loses_empty(spark, rows):
    got = rows(explode_visits(inputs(spark)[2]).select("uid", "timestamp"))
    assert got == [("2", 1), ("2", 1), ("2", 2), ("3", 3), ("4", 4), (None, 1)]


def test_shop_matrix_counts_every_kind_of_known_users(spark, rows):
    matrix = shop_category_matrix(inputs(spark)[1])
    assert matrix.columns == ["uid", "shop_everyday_jewelry", "shop_mobile_phones"]
    assert rows(matrix) == [("2", 2, 0), ("3", 0, 1)]


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_web_matrix_joins_on_the_full_host(spark, rows, broadcast_bytes):
    _, _, logs, cats = inputs(spark)
    matrix = web_category_matrix(logs, cats, broadcast_bytes=broadcast_bytes)
    assert matrix.columns == ["uid", "web_arts_and_entertainment", "web_never_seen"]
    assert rows(matrix) == [("2", 2, 0)]


def test_mart_keeps_nulls_or_fills(spark, rows):
    clients, shop, logs, cats = inputs(spark)
    parts = shop_category_matrix(shop), web_category_matrix(logs, cats)
    mart = profile_mart(clients, *parts)
    assert mart.columns == [
        "uid", "gender", "age_cat", "shop_everyday_jewelry", "shop_mobile_phones",
        "web_arts_and_entertainment", "web_never_seen",
    ]
    assert rows(mart) == [
        ("1", "F", None, None, None, None, None),
        ("2", "M", "25-34", 2, 0, 2, 0),
        ("3", "F", ">=55", 0, 1, None, None),
        ("4", "M", ">=55", None, None, None, None),
    ]
    filled = profile_mart(clients, *parts, fill=0, max_age=99)
    assert rows(filled)[2] == ("3", "F", None, 0, 1, 0, 0)
    assert rows(bucket_distribution(mart)) == [
        ("F", ">=55", 1), ("F", None, 1), ("M", "25-34", 1), ("M", ">=55", 1),
    ]


def test_mart_plan_reads_four_sources_and_writes(spark, rows, tmp_path):
    clients, shop, logs, cats = inputs(spark)
    specs = []
    for name, df in (("clients", clients), ("shop", shop), ("cats", cats)):
        df.write.parquet(str(tmp_path / name))
        specs.append(SourceSpec("parquet", path=str(tmp_path / name)))
    lines = [
        {"uid": u, "visits": v and [{"timestamp": t, "url": x} for t, x in v]} for u, v in LOGS
    ]
    (tmp_path / "logs.json").write_text("\n".join(json.dumps(line) for line in lines))
    sink = SinkSpec("parquet", path=str(tmp_path / "mart"), partitions=1)
    build_mart(
        spark, specs[0], specs[1], json_files(str(tmp_path / "logs.json")), specs[2], sink
    )
    written = spark.read.parquet(str(tmp_path / "mart"))
    assert rows(written)[1] == ("2", "M", "25-34", 2, 0, 2, 0)
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        build_mart(
            spark, specs[0], specs[1], json_files(str(tmp_path / "logs.json")), specs[2], sink,
            mode="errorifexists",
        )
