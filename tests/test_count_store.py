import pytest

from clickloom.paths import Directory
from clickloom.plans.count_store import (
    compact_count_store,
    read_count_store,
    snapshot_version,
    store_counts,
    store_matrix,
    update_count_store,
)
from clickloom.plans.users_items import update_users_items
from clickloom.sources import read_snapshot
from clickloom.versions import VersionedFolder

from .test_users_items import DAY, FIRST, SECOND, START, random_events, split, whole_matrix


def folders(root):
    return {p.relative_to(root).as_posix() for p in (root / "_data").glob("*/p_date=*")}


def test_store_equals_snapshots_of_the_job(spark, rows, tmp_path):
    one, two = split(spark, FIRST, tmp_path / "v1"), split(spark, SECOND, tmp_path / "v2")
    store, job = str(tmp_path / "store"), str(tmp_path / "job")
    for path, date in ((one, "20200429"), (two, "20200430")):
        assert update_count_store(spark, path, store).notes["snapshot"] == date
        update_users_items(spark, path, job)
        assert rows(store_matrix(spark, store)) == rows(read_snapshot(spark, job, date))
    assert rows(store_matrix(spark, store)) == rows(whole_matrix(spark, one, two))
    old = snapshot_version(spark, store, "20200429")
    assert old.number == 1 and rows(store_matrix(spark, store, old)) == rows(whole_matrix(spark, one))
    assert snapshot_version(spark, store, "20200101") is None


def test_one_changed_date_writes_one_partition(spark, rows, tmp_path):
    root = tmp_path / "store"
    update_count_store(spark, split(spark, FIRST, tmp_path / "v1"), str(root))
    before, old = folders(root), VersionedFolder(spark, str(root)).latest()
    day = random_events(3, (4, 5), (0, 8), (0, 5))
    new = update_count_store(spark, split(spark, day, tmp_path / "v2"), str(root))
    assert [f.rpartition("=")[2] for f in folders(root) - before] == ["20200424"]
    assert {d for d in new.parts if new.parts[d] != old.parts[d]} == {"20200424"}
    kept = [e for e in FIRST if (e[4] - START) // DAY != 4]
    expected = whole_matrix(spark, split(spark, kept + day, tmp_path / "all"))
    assert rows(store_matrix(spark, str(root))) == rows(expected)


def test_dates_are_chosen_by_the_manifest(spark, rows, tmp_path):
    root = str(tmp_path / "store")
    update_count_store(spark, split(spark, FIRST, tmp_path / "v"), root)
    chosen = read_count_store(spark, root, dates=["20200422", "20210101"])
    assert {r.date for r in chosen.collect()} == {"20200422"}
    assert len(chosen.inputFiles()) == len([f for f in chosen.inputFiles() if "p_date=20200422" in f]) > 0
    late = read_count_store(spark, root, since="20200428")
    assert {r.date for r in late.collect()} == {"20200428", "20200429"}
    assert read_count_store(spark, root, dates=[]).collect() == []


def test_added_dates_keep_both_folders_until_compacted(spark, rows, tmp_path):
    root, path = str(tmp_path / "store"), split(spark, SECOND, tmp_path / "v")
    for _ in range(3):
        version = update_count_store(spark, path, root, same_date="add")
    assert [len(f) for f in version.parts.values()] == [3]
    tripled = [(u, *[3 * n for n in cells]) for u, *cells in rows(whole_matrix(spark, path))]
    assert rows(store_matrix(spark, root)) == tripled
    assert compact_count_store(spark, root, 3) == version
    merged = compact_count_store(spark, root, 2)
    assert [len(f) for f in merged.parts.values()] == [1] and merged.notes == version.notes
    assert rows(store_matrix(spark, root)) == tripled
    assert read_count_store(spark, root).count() == store_counts(spark, root).count()
    with pytest.raises(ValueError, match="same_date"):
        update_count_store(spark, path, root, same_date="other")


def test_undated_anonymous_and_empty(spark, rows, tmp_path):
    events = [("c", "view", "a", 1, START, "u"), ("c", "view", "a", 1, START + 3 * DAY, None), ("c", "buy", "b", 1, None, "u")]
    root, path = str(tmp_path / "store"), split(spark, events, tmp_path / "v")
    empty = split(spark, events[:0], tmp_path / "none")
    assert update_count_store(spark, empty, root) is None
    assert VersionedFolder(spark, root).numbers() == []
    version = update_count_store(spark, path, root)
    assert version.notes["snapshot"] == "20200423" and set(version.parts) == {"20200420", "undated"}
    # A day that comes again is replaced; rows without a day cannot be told apart and are added.
    update_count_store(spark, path, root)
    assert rows(store_counts(spark, root)) == [("u", "buy_b", 2), ("u", "view_a", 1)]
    assert update_count_store(spark, path, root, update=False).parts.keys() == version.parts.keys()
    assert rows(store_counts(spark, root)) == [("u", "buy_b", 1), ("u", "view_a", 1)]


def test_anonymous_rows_alone_name_the_snapshot(spark, tmp_path):
    root = str(tmp_path / "store")
    nobody = [("c", "view", "a", 1, START + 3 * DAY, None)]
    version = update_count_store(spark, split(spark, nobody, tmp_path / "v"), root)
    assert version.notes["snapshot"] == "20200423" and version.parts == {}
    assert store_matrix(spark, root).collect() == []


def test_late_batch_and_first_date_to_read(spark, rows, tmp_path):
    root = str(tmp_path / "store")
    update_count_store(spark, split(spark, SECOND, tmp_path / "v2"), root)
    version = update_count_store(spark, split(spark, FIRST, tmp_path / "v1"), root, since="20200428")
    assert version.notes["snapshot"] == "20200430"
    assert set(version.parts) == {"20200428", "20200429", "20200430"}


@pytest.mark.parametrize("step", ["write", "write_text", "rename_file"])
def test_death_at_any_step_leaves_a_readable_version(spark, rows, tmp_path, monkeypatch, step):
    """Killed before, within and after each step; the next update goes on from the old version."""
    root = str(tmp_path / "store")
    one, two = split(spark, FIRST, tmp_path / "v1"), split(spark, SECOND, tmp_path / "v2")
    update_count_store(spark, one, root)
    expected = rows(whole_matrix(spark, one))

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        if step == "write":
            patch.setattr("clickloom.plans.count_store.partition_folders", die)
        else:
            patch.setattr(Directory, step, die)
        with pytest.raises(RuntimeError, match="killed"):
            update_count_store(spark, two, root)
    assert rows(store_matrix(spark, root)) == expected
    update_count_store(spark, two, root)
    assert rows(store_matrix(spark, root)) == rows(whole_matrix(spark, one, two))
    store = VersionedFolder(spark, root)
    assert len(store.expire()) == 1 and rows(store_matrix(spark, root)) == rows(whole_matrix(spark, one, two))


def test_a_failing_task_leaves_the_old_version(spark, rows, tmp_path):
    root, path = str(tmp_path / "store"), split(spark, FIRST, tmp_path / "v1")
    update_count_store(spark, path, root)
    bad = tmp_path / "v2"
    (bad / "view").mkdir(parents=True)
    (bad / "buy").mkdir()
    (bad / "view" / "part.json.gz").write_bytes(b"no gzip")
    with pytest.raises(Exception):
        update_count_store(spark, str(bad), root)
    assert rows(store_matrix(spark, root)) == rows(whole_matrix(spark, path))


def test_no_join_over_history(spark, tmp_path):
    """The plan of the newest version is a scan of its parts and one aggregate."""
    root = str(tmp_path / "store")
    for i, events in enumerate((FIRST, SECOND)):
        update_count_store(spark, split(spark, events, tmp_path / f"v{i}"), root)
    plan = store_counts(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
