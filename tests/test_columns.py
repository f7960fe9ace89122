import datetime
import random
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from clickloom.functions import (
    age_bucket,
    decode_events,
    decode_payload,
    domain_of,
    encode_payload,
    event_date,
    label,
    sql_text,
    unescape_url,
    utc_hour,
    utc_weekday,
    visit_indicators,
)
from clickloom.schemas import EVENT


def ms(*parts):
    moment = datetime.datetime(*parts, tzinfo=datetime.timezone.utc)
    return int(moment.timestamp() * 1000)


def values(spark, data, column, kind="string"):
    df = spark.createDataFrame([(v,) for v in data], f"v {kind}")
    return [r[0] for r in df.select(column(F.col("v"))).collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata", "America/Sao_Paulo"])
def test_dates_are_utc_in_every_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(
            spark,
            [
                1577865600000,
                1588107480000,
                ms(2020, 3, 1) - 1,
                ms(2020, 3, 1),
                ms(2018, 11, 4, 3),
                None,
                -1,
            ],
            event_date,
            "bigint",
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [
        "20200101",
        "20200428",
        "20200229",
        "20200301",
        "20181104",
        None,
        "19691231",
    ]


def test_hours_and_weekdays_match_the_calendar(spark):
    rng = random.Random(7)
    stamps = [rng.randrange(-(10**12), 4 * 10**12) for _ in range(500)]
    moments = [
        datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=s) for s in stamps
    ]
    assert values(spark, stamps, utc_hour, "bigint") == [m.hour for m in moments]
    assert values(spark, stamps, utc_weekday, "bigint") == [
        m.isoweekday() % 7 for m in moments
    ]
    assert values(spark, stamps, event_date, "bigint") == [m.strftime("%Y%m%d") for m in moments]


@pytest.mark.parametrize(
    "hour, minute, work, evening",
    [(8, 59, 0, 0), (9, 0, 1, 0), (17, 59, 1, 0), (18, 0, 0, 1), (23, 59, 0, 1), (0, 0, 0, 0)],
)
def test_visit_indicators(spark, hour, minute, work, evening):
    df = spark.createDataFrame([(ms(2024, 1, 6, hour, minute),)], "t bigint")
    row = df.select(*visit_indicators(F.col("t"))).first().asDict()
    assert (row["web_work_hours"], row["web_evening_hours"]) == (work, evening)
    assert row["web_day_sat"] == 1 and row["all_visits"] == 1
    assert sum(v for k, v in row.items() if k.startswith("web_day_")) == 1
    hours = {k: v for k, v in row.items() if k.startswith("web_hour_")}
    assert [k for k, v in hours.items() if v] == [f"web_hour_{hour}"]
    assert len(row) == 7 + 24 + 3


def test_strict_domain(spark):
    cases = {
        "http://www.ya.ru/start": "ya.ru",
        "https://market.ya.ru/": "market.ya.ru",
        "http://www2.x.com/a": "www2.x.com",
        "http://my.www.x.com/": "my.www.x.com",
        "http://WWW.Up.com/": "WWW.Up.com",
        "http://u:p@host.com:8080/x": "host.com",
        "not a url": None,
        "-": None,
        "http://host/a b": None,
        None: None,
    }
    assert values(spark, list(cases), domain_of) == list(cases.values())


def test_strip_modes_and_case(spark):
    urls = ["http://awwwb.com/", "http://my.www.x.com/", "http://WWW.Up.com/"]
    anywhere = values(
        spark, urls, lambda c: domain_of(c, strip="anywhere", lower=True)
    )
    assert anywhere == ["a.com", "my.x.com", "up.com"]
    assert values(spark, urls, lambda c: domain_of(c, strip=None)) == [
        "awwwb.com",
        "my.www.x.com",
        "WWW.Up.com",
    ]
    with pytest.raises(ValueError):
        domain_of(F.lit(""), parser="other")


def test_lenient_domain_takes_what_a_strict_parser_rejects(spark):
    cases = {
        "http://www.a.ru/x y": "a.ru",
        "http://b.ru/x|y": "b.ru",
        "http://c.ru/100%": "c.ru",
        "http://пример.рф/": "пример.рф",
        "http://my_host.ru/": "my_host.ru",
        "https://u@d.ru:81?q": "d.ru",
        "http://": None,
        "http:///path": None,
        "ftp://e.ru/": None,
    }
    assert values(spark, list(cases), lambda c: domain_of(c, parser="lenient")) == list(
        cases.values()
    )


def test_unescape_agrees_with_the_standard_library(spark):
    texts = [
        "http%3A%2F%2Frzd.ru%2F",
        "a+b",
        "100%",
        "%zz%41",
        "%D0%BF%D1%80",
        "%",
        "%2",
        "%2520",
        "",
        "plain",
    ]
    assert values(spark, texts, unescape_url) == [unquote(t) for t in texts]


def test_label(spark):
    assert values(spark, ["Everyday Jewelry"], lambda c: label("shop_", c)) == [
        "shop_everyday_jewelry"
    ]
    assert values(spark, ["Arts and-Entertainment", "a -b", None], lambda c: label("web_", c)) == [
        "web_arts_and_entertainment",
        "web_a__b",
        None,
    ]
    assert values(spark, ["Computers-2"], lambda c: label("view_", c)) == ["view_computers_2"]


def test_age_bucket_edges(spark):
    ages = [None, 17, 18, 24, 25, 34, 35, 44, 45, 54, 55, 99, 100]
    expected = [
        None, None, "18-24", "18-24", "25-34", "25-34", "35-44", "35-44",
        "45-54", "45-54", ">=55", ">=55", ">=55",
    ]
    assert values(spark, ages, age_bucket, "int") == expected
    bounded = values(spark, ages, lambda c: age_bucket(c, max_age=99), "int")
    assert bounded == [*expected[:-1], None]


def test_payload_round_trip_and_broken_json(spark):
    event = ("c", "buy", "i-1", 2529, 1577865600000, None)
    df = spark.createDataFrame([event], EVENT)
    packed = encode_payload(df, EVENT.fieldNames(), "out")
    row = packed.first()
    assert row["topic"] == "out" and '"uid"' not in row["value"]
    assert tuple(decode_payload(packed, EVENT).first()) == event
    raw = spark.createDataFrame(
        [(1, bytearray(b'{"item_price": "7", "timestamp": 5}')), (2, bytearray(b"{broken"))],
        "offset bigint, value binary",
    )
    got = {r["offset"]: r for r in decode_events(raw, keep=["offset"]).collect()}
    assert got[1]["item_price"] == "7" and got[1]["timestamp"] == 5
    assert all(v is None for k, v in got[2].asDict().items() if k != "offset")


def test_numbers_travel_as_numbers_or_text(spark):
    messages = [
        ('{"item_price": 2529, "timestamp": 1577865600000}',),
        ('{"item_price": "2529", "timestamp": "1577865600000"}',),
        ('{"item_price": null, "timestamp": "never"}',),
    ]
    raw = spark.createDataFrame(messages, "value string")
    got = [(r["item_price"], r["timestamp"]) for r in decode_events(raw).collect()]
    assert got == [("2529", 1577865600000), ("2529", 1577865600000), (None, None)]


def test_sql_text(spark):
    for text in ["plain", "it's", "back\\slash", 'dou"ble', "\\'"]:
        assert spark.sql(f"SELECT {sql_text(text)} AS t").first()["t"] == text
