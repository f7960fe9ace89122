import pytest
from pyspark.sql import functions as F

from clickloom.paths import Directory
from clickloom.schemas import EVENT
from clickloom.sinks import split_by_kind
from clickloom.sources import read_events_dir, read_split_events
from clickloom.versions import VersionedFolder

DAY = 86_400_000
KINDS = ("view", "buy")


def events(spark, *rows):
    return spark.createDataFrame([("c", kind, item, 1, at, "u") for kind, item, at in rows], EVENT)


def lines(spark, out, kinds=KINDS):
    return sorted((r.event_type, r.item_id, r.p_date or "") for r in read_split_events(spark, out, kinds).collect())


def test_versions_hold_what_moves_hold(spark, tmp_path):
    rows = [("view", "a", 0), ("view", "b", DAY), ("buy", "c", DAY), ("cart", "d", 0), ("view", "e", None)]
    for layout in ("moved", "versions"):
        split_by_kind(events(spark, *rows), str(tmp_path / layout), layout=layout)
    assert lines(spark, str(tmp_path / "versions")) == lines(spark, str(tmp_path / "moved"))
    assert {p.name for p in (tmp_path / "versions").iterdir()} == {"_data", "_versions"}
    for only in ({"dates": ["19700102"]}, {"since": "19700102"}, {"dates": []}, {}):
        for kind in KINDS:
            got = [read_events_dir(spark, str(tmp_path / name), kind, **only).collect() for name in ("versions", "moved")]
            assert sorted(map(str, got[0])) == sorted(map(str, got[1]))


def test_a_rewrite_replaces_all_and_the_version_before_stays(spark, tmp_path):
    out = str(tmp_path / "out")
    split_by_kind(events(spark, ("view", "a", 0), ("buy", "b", 0)), out, layout="versions")
    reader = read_split_events(spark, out, KINDS)
    split_by_kind(events(spark, ("view", "new", 0)), out, layout="versions")
    assert lines(spark, out) == [("view", "new", "19700101")]
    assert reader.count() == 2
    split_by_kind(events(spark, ("cart", "x", 0)), out, layout="versions")
    assert lines(spark, out) == []
    assert VersionedFolder(spark, out).numbers() == [2, 3]
    # An output without rows names no data.
    assert len(list((tmp_path / "out" / "_data").iterdir())) == 1


def test_a_rewrite_may_read_what_it_replaces(spark, tmp_path):
    out = str(tmp_path / "out")
    split_by_kind(events(spark, ("view", "a", 0), ("buy", "b", 0)), out, layout="versions")
    split_by_kind(read_split_events(spark, out, KINDS), out, layout="versions")
    assert lines(spark, out) == [("buy", "b", "19700101"), ("view", "a", "19700101")]


@pytest.mark.parametrize("layout", ["versions", "partitions", "moved"])
@pytest.mark.parametrize("rebalance", [True, False])
def test_a_failing_rewrite_keeps_every_old_row(spark, tmp_path, layout, rebalance):
    out = str(tmp_path / "out")
    split_by_kind(events(spark, ("view", "a", 0), ("buy", "b", DAY)), out, layout=layout)
    before = lines(spark, out)
    # The first rows are written before one fails.
    many = spark.range(2000, numPartitions=2).select(
        F.lit("c").alias("category"), F.lit("view").alias("event_type"), F.lit("x").alias("item_id"),
        F.when(F.col("id") == 1999, F.raise_error(F.lit("broken"))).otherwise(F.lit(1)).cast("bigint").alias("item_price"),
        (F.col("id") * DAY).alias("timestamp"), F.lit("u").alias("uid"),
    )
    with pytest.raises(Exception, match="broken"):
        split_by_kind(many, out, rebalance=rebalance, layout=layout)
    assert lines(spark, out) == before


@pytest.mark.parametrize("step", ["write_text", "rename_file"])
def test_death_before_the_manifest_is_in_place(spark, tmp_path, monkeypatch, step):
    out = str(tmp_path / "out")
    split_by_kind(events(spark, ("view", "old", 0)), out, layout="versions")

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(Directory, step, die)
        with pytest.raises(RuntimeError, match="killed"):
            split_by_kind(events(spark, ("view", "new", 0)), out, layout="versions")
    assert lines(spark, out) == [("view", "old", "19700101")]
    split_by_kind(events(spark, ("view", "new", 0)), out, layout="versions")
    assert lines(spark, out) == [("view", "new", "19700101")]


def test_layouts_are_not_mixed(spark, tmp_path):
    out = str(tmp_path / "out")
    split_by_kind(events(spark, ("view", "a", 0)), out, layout="versions")
    with pytest.raises(ValueError, match="versions"):
        split_by_kind(events(spark, ("view", "b", 0)), out)
    assert lines(spark, out) == [("view", "a", "19700101")]
