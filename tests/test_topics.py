import json
import uuid

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.schemas import EVENT
from clickloom.operators import kind_checksums, reconcile
from clickloom.plans import split_events
from clickloom.sinks import split_by_kind
from clickloom.sinks.split import finish_split
from clickloom.sources import (
    TopicSpec,
    read_events_dir,
    read_split_events,
    read_topic_batch,
)
from clickloom.sources.paths import Directory
from clickloom.sources.topics import starting_offsets

SAMPLE = {
    "event_type": "view",
    "category": "Mobile-phones",
    "item_id": "Mobile-phones-5",
    "item_price": 1029,
    "uid": "1f295269",
    "timestamp": 1588107480000,
}
LAST_MS = 1588118399999  # 2020-04-28 23:59:59.999 UTC


def message(**changes):
    return json.dumps({**SAMPLE, **changes})


MESSAGES = [
    message(),
    message(event_type="buy", timestamp=LAST_MS),
    message(event_type="buy", timestamp=LAST_MS + 1, item_price=7, uid=None),
    message(event_type="cart"),
    "{broken",
]


def text_topic(tmp_path, messages=MESSAGES):
    (tmp_path / "topic").mkdir()
    (tmp_path / "topic" / "0.txt").write_text("\n".join(messages))
    return TopicSpec("shop", "text", path=str(tmp_path / "topic"))


@pytest.mark.parametrize("rebalance", [True, False])
def test_split_layout_and_lines(spark, tmp_path, rebalance):
    out = tmp_path / "visits"
    split_events(spark, text_topic(tmp_path), str(out), rebalance=rebalance)
    assert sorted(p.name for p in out.iterdir()) == ["buy", "view"]
    days = sorted(p.name for p in (out / "buy").iterdir() if p.is_dir())
    assert days == ["p_date=20200428", "p_date=20200429"]
    lines = [r.value for r in spark.read.text(str(out / "view")).collect()]
    assert lines == [
        '{"category":"Mobile-phones","event_type":"view","item_id":"Mobile-phones-5",'
        '"item_price":"1029","timestamp":1588107480000,"uid":"1f295269","date":"20200428"}'
    ]


def test_split_replaces_earlier_output_also_with_nothing(spark, tmp_path):
    out = str(tmp_path / "visits")
    split_events(spark, text_topic(tmp_path), out)
    only_views = spark.createDataFrame([tuple(SAMPLE.values())], list(SAMPLE))
    split_by_kind(only_views, out)
    split_by_kind(only_views, out)
    assert read_events_dir(spark, out, "view").count() == 1
    assert read_events_dir(spark, out, "buy").count() == 0


def test_split_may_rewrite_its_own_input(spark, tmp_path):
    out = str(tmp_path / "visits")
    split_events(spark, text_topic(tmp_path), out)
    split_by_kind(read_split_events(spark, out, ("view", "buy")), out)
    assert read_split_events(spark, out, ("view", "buy")).count() == 3


@pytest.mark.parametrize("form", ["file://{0}", "{0}/"])
def test_output_path_forms(spark, tmp_path, form):
    out = form.format(tmp_path / "visits")
    for _ in range(2):
        split_by_kind(spark.createDataFrame([tuple(SAMPLE.values())], list(SAMPLE)), out)
    assert sorted(p.name for p in (tmp_path / "visits").iterdir()) == ["buy", "view"]
    assert read_events_dir(spark, out, "view").count() == 1


def test_relative_output_path(spark):
    """Relative to the working directory of the file system, as Spark reads it."""
    name = f"relative-{uuid.uuid4().hex}"
    home = Directory(spark, name)
    try:
        split_by_kind(spark.createDataFrame([tuple(SAMPLE.values())], list(SAMPLE)), name)
        assert sorted(home.children()) == ["buy", "view"]
        assert read_events_dir(spark, name, "view").count() == 1
    finally:
        home.delete()


def test_events_dir_keeps_text_dates_and_names_items(spark, tmp_path, rows):
    out = str(tmp_path / "visits")
    split_events(spark, text_topic(tmp_path), out)
    assert rows(read_events_dir(spark, out, "buy")) == [
        ("20200428", "1f295269", "buy_mobile_phones_5"),
        ("20200429", None, "buy_mobile_phones_5"),
    ]


def test_offsets():
    spec = TopicSpec("t", partitions=3)
    assert starting_offsets(spec, "earliest") == "earliest"
    assert json.loads(starting_offsets(spec, "17")) == {"t": {"0": 17, "1": -2, "2": -2}}


def test_numeric_offset_holds_for_partition_zero_only(spark, tmp_path, rows):
    path = str(tmp_path / "topic")
    places = [(p, o, f"{p}-{o}") for p in range(2) for o in range(4)]
    spark.createDataFrame(places, "partition int, offset bigint, value string").write.json(path)
    spec = TopicSpec("t", "json", path=path, partitions=2)
    got = rows(read_topic_batch(spark, spec, 2).select("value"))
    assert got == [("0-2",), ("0-3",), ("1-0",), ("1-1",), ("1-2",), ("1-3",)]
    assert read_topic_batch(spark, spec).count() == 8
    with pytest.raises(ValueError):
        read_topic_batch(spark, TopicSpec("t", "text", path=path), 3)


def test_checks(spark, tmp_path, rows):
    events = spark.createDataFrame(
        [("view", "5"), ("view", "x"), ("buy", "7"), ("cart", "1"), (None, None)],
        "event_type string, item_price string",
    )
    assert rows(kind_checksums(events)) == [
        ("buy", 1, 7), ("cart", 1, 1), ("view", 2, 5), (None, 1, None),
    ]
    received = events.where(F.col("event_type").isin("view", "buy"))
    assert rows(reconcile(events, received)) == [
        ("buy", 1, 1, True), ("cart", 1, 0, False), ("view", 2, 2, True), (None, 1, 0, False),
    ]


def test_split_schema_is_declared(spark, tmp_path):
    out = str(tmp_path / "visits")
    split_events(spark, text_topic(tmp_path), out)
    types = dict(read_split_events(spark, out, ("view",)).dtypes)
    assert types["p_date"] == types["date"] == types["item_price"] == "string"
    assert types["timestamp"] == "bigint"
    assert set(types) == {*schemas.SPLIT_EVENT.fieldNames(), "p_date"}


def test_split_is_finished_by_the_next_writer(spark, tmp_path):
    """A writer died after its first move: the other kind is still the old one."""
    old = spark.createDataFrame([("c", "view", "old", 1, 0, "u"), ("c", "buy", "old", 1, 0, "u")], EVENT)
    new = spark.createDataFrame([("c", "view", "new", 1, 0, "u"), ("c", "buy", "new", 1, 0, "u")], EVENT)
    split_by_kind(new, str(tmp_path / "fresh"))
    split_by_kind(old, str(tmp_path / "out"))
    ready = tmp_path / "out" / "_ready-1"
    ready.mkdir()
    (tmp_path / "fresh" / "buy").rename(ready / "kind=buy")
    finish_split(spark, str(tmp_path / "out"))
    lines = read_split_events(spark, str(tmp_path / "out"), ("view", "buy"))
    assert {(r.event_type, r.item_id) for r in lines.collect()} == {("view", "old"), ("buy", "new")}
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["buy", "view"]


def test_partition_layout_needs_no_move(spark, tmp_path):
    events = spark.createDataFrame([("c", "view", "a", 1, 0, "u"), ("c", "view", "a", 1, None, "u")], EVENT)
    split_by_kind(events, str(tmp_path / "out"), layout="partitions")
    split_by_kind(events, str(tmp_path / "out"), layout="partitions")
    lines = read_split_events(spark, str(tmp_path / "out"), ("view", "buy"))
    assert sorted((r.date, r.p_date) for r in lines.collect() if r.date) == [("19700101", "19700101")]
    assert lines.count() == 2
    with pytest.raises(ValueError, match="layout"):
        split_by_kind(events, str(tmp_path / "out"), layout="other")


def test_unknown_offset_is_an_error(spark, tmp_path):
    topic = TopicSpec("t", "parquet", path=str(tmp_path))
    for offset in ("latest", "earlyest", "-1"):
        with pytest.raises(ValueError, match="offset"):
            read_topic_batch(spark, topic, offset)
