import json

from pyspark.sql import functions as F

from clickloom.functions import decode_events, decode_with_reason
from clickloom.operators import KindChecks, KindTotals, kind_checksums
from clickloom.plans import split_topic
from clickloom.schemas import EVENT
from clickloom.sinks import split_by_kind
from clickloom.sources import TopicSpec, read_rejected, read_split_events
from clickloom.versions import VersionedFolder

KINDS = ("view", "buy")


def message(**fields):
    return json.dumps({"event_type": "view", "item_id": "a", "item_price": "1.5", "timestamp": 0, "uid": "u"} | fields)


GOOD = [message(), message(event_type="buy", timestamp="86400000.0"), message(item_price="?"), message(uid=None)]
BAD = {
    "broken JSON": ["", "{", message()[:-1], "[1]", "7", "no", '"text"'],
    "unknown kind": [message(event_type="cart"), message(event_type=None), "{}", message(event_type="View")],
    "bad time": [message(timestamp=None), message(timestamp="x"), message(timestamp=10**18), message(timestamp=[1])],
}


def sent(spark):
    lines = [*GOOD, *(line for lines in BAD.values() for line in lines)]
    return spark.createDataFrame([(line,) for line in lines], "value string").repartition(2)


def test_every_message_has_its_reason(spark):
    found = decode_with_reason(sent(spark), KINDS).collect()
    assert {r.value for r in found if r.reason is None} == set(GOOD)
    for reason, lines in BAD.items():
        assert sorted(r.value for r in found if r.reason == reason) == sorted(lines)
    none = spark.createDataFrame([(None, 4)], "value string, offset int")
    (row,) = decode_with_reason(none, keep=["offset"]).collect()
    assert (row.offset, row.reason) == (4, "broken JSON")


def test_good_messages_decode_as_the_jobs_do(spark, rows):
    decoded = decode_with_reason(sent(spark), KINDS).where("reason IS NULL").drop("value", "reason")
    expected = decode_events(spark.createDataFrame([(line,) for line in GOOD], "value string"))
    assert decoded.columns == expected.columns and rows(decoded) == rows(expected)
    # Without kinds none is unknown, but a message without one is.
    kinds = decode_with_reason(sent(spark)).where("reason IS NULL").select("event_type")
    assert {r.event_type for r in kinds.collect()} >= {"cart", "View"}


def test_accepted_and_rejected_add_up_to_those_sent(spark, rows, tmp_path):
    topic = TopicSpec("t", "text", path=str(tmp_path / "topic"))
    # A line of text per message; the text source gives no row for none.
    sent(spark).write.text(topic.path)
    out = str(tmp_path / "out")
    checks = split_topic(spark, topic, out)
    accepted = read_split_events(spark, out, KINDS)
    assert sorted(r.event_type for r in accepted.collect()) == ["buy", "view", "view", "view"]
    assert rows(read_rejected(spark, out)) == sorted(((line, reason) for reason, lines in BAD.items() for line in lines), key=repr)
    assert rows(checks) == [("buy", 1, 1), ("view", 3, 3), (None, 15, 10)]
    assert sum(r.n_rows for r in checks.collect()) == sent(spark).count()
    assert {n.partition("/")[2] for n in VersionedFolder(spark, out).latest().parts if n.startswith("_rejected")} == set(BAD)
    # The rejected rows are no event of any kind.
    assert "value" not in accepted.columns


def test_nothing_rejected_and_nothing_sent(spark, tmp_path):
    for name, lines in (("good", GOOD), ("none", [])):
        path = str(tmp_path / name)
        spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
        split_topic(spark, TopicSpec("t", "text", path=path), path + "-out")
        assert read_rejected(spark, path + "-out").collect() == []
        assert read_split_events(spark, path + "-out", KINDS).count() == len(lines)


def priced(spark):
    rows = [("view", 5), ("view", None), ("buy", 7), ("cart", 1), (None, 2), ("free", None)]
    return spark.createDataFrame([("c", kind, "i", value, 0, "u") for kind, value in rows], EVENT)


def test_observed_checksums_equal_those_of_a_second_read(spark, rows, tmp_path):
    checks = KindChecks(["view", "buy", "cart", "free", "absent"])
    split_by_kind(checks.watch(priced(spark)), str(tmp_path), layout="versions")
    expected = kind_checksums(priced(spark))
    assert checks.result(spark).columns == expected.columns
    assert rows(checks.result(spark)) == rows(expected)


def test_rows_that_are_seen_but_not_written(spark, rows, tmp_path):
    checks = KindChecks(["cart"])
    split_by_kind(checks.watch(priced(spark).where("event_type = 'cart'")), str(tmp_path), layout="versions")
    assert rows(checks.result(spark)) == [("cart", 1, 1)]


def test_other_kinds_are_counted_together(spark, rows):
    checks = KindChecks(["view"])
    checks.watch(priced(spark)).write.format("noop").mode("overwrite").save()
    assert rows(checks.result(spark)) == [("view", 2, 5), (None, 4, 10)]


def test_the_input_is_read_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(kind):
        reads.add(1)
        return kind

    events = priced(spark).withColumn("event_type", counted.asNondeterministic()("event_type"))
    checks = KindChecks(KINDS)
    split_by_kind(checks.watch(events), str(tmp_path), rebalance=False, layout="versions")
    assert sum(r.n_rows for r in checks.result(spark).collect()) == 6 and reads.value == 6


def test_checks_of_a_stream(spark, rows, tmp_path):
    checks = KindChecks(["view", "buy"])
    totals = KindTotals(checks)
    spark.streams.addListener(totals)
    try:
        source = str(tmp_path / "in")
        for _ in range(2):
            priced(spark).write.mode("append").json(source)
            stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).json(source)
            query = checks.watch(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
            query.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        # Reports come through their own queue.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        import time

        for _ in range(50):
            if sum(r.n_rows for r in totals.result(spark).collect()) == 12:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(totals)
    assert rows(totals.result(spark)) == [("buy", 2, 14), ("view", 4, 10), (None, 6, 6)]
