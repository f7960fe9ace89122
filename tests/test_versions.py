import json

import pytest

from clickloom.versions import VersionedFolder, partition_folders


def write(spark, store, rows):
    folder = store.fresh()
    spark.createDataFrame(rows, "kind string, n bigint").write.partitionBy("kind").json(store.path(folder))
    return {kind: [at] for (kind,), at in partition_folders(spark, store.root, folder, "kind").items()}


def test_versions_follow_one_another_and_old_ones_stay(spark, tmp_path, rows):
    store = VersionedFolder(spark, str(tmp_path))
    assert store.latest().number == 0 and store.numbers() == []
    one = store.publish(store.latest(), write(spark, store, [("a", 1), ("b:c", 2)]), {"x": 1})
    two = store.publish(one, one.parts | write(spark, store, [("a", 9)]))
    assert (store.numbers(), store.latest()) == ([1, 2], two)
    assert store.at(1).notes == {"x": 1} and set(two.parts) == {"a", "b:c"}
    assert two.parts["b:c"] == one.parts["b:c"] != two.parts["a"]
    for version, expected in ((one, [(1,), (2,)]), (two, [(2,), (9,)])):
        assert rows(spark.read.schema("n bigint").json(store.paths(version))) == expected
    assert store.paths(two, ["a", "none"]) == store.paths(two, ["a"])


def test_a_second_writer_of_the_same_version_fails(spark, tmp_path):
    store = VersionedFolder(spark, str(tmp_path))
    base = store.latest()
    store.publish(base, {"a": ["_data/1"]})
    with pytest.raises(FileExistsError):
        store.publish(base, {"a": ["_data/2"]})
    assert store.latest().parts == {"a": ["_data/1"]}


def test_expire_deletes_what_no_kept_version_names(spark, tmp_path):
    store = VersionedFolder(spark, str(tmp_path))
    one = store.publish(store.latest(), write(spark, store, [("a", 1), ("b", 2)]))
    two = store.publish(one, one.parts | write(spark, store, [("a", 3)]))
    store.publish(two, two.parts | write(spark, store, [("a", 4)]))
    write(spark, store, [("a", 5)])  # of a writer that died
    (tmp_path / "_versions" / "_draft-1").write_text("{")
    assert len(store.expire(2)) == 1
    assert store.numbers() == [2, 3]
    # The first folder goes on to hold part b.
    assert len(store.expire(1)) == 1 and store.expire(1) == []
    assert len(list((tmp_path / "_data").iterdir())) == 2
    assert not list((tmp_path / "_versions").glob("*draft*"))


def test_manifests_are_small_text(spark, tmp_path):
    store = VersionedFolder(spark, str(tmp_path))
    store.publish(store.latest(), {"20200101": ["_data/x/p_date=20200101"], "gone": []}, {"snapshot": "20200101"})
    found = json.loads((tmp_path / "_versions" / "000000000001.json").read_text())
    assert found == {"parts": {"20200101": ["_data/x/p_date=20200101"]}, "notes": {"snapshot": "20200101"}}
