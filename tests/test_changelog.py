import time

import pytest

from ledgerlake.sinks import changelog
from ledgerlake.sinks.folders import Folder


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "log")


def batch(spark, *rows):
    return spark.createDataFrame(rows, "k string, n int, v string")


def current(spark, path):
    return {tuple(row) for row in changelog.latest(spark, path, ["k"]).collect()}


def test_last_row_of_each_key(spark, path):
    write = changelog.batch_writer(path)
    write(batch(spark, ("a", 1, "x"), ("b", 1, None)), 0)
    write(batch(spark, ("a", 2, None)), 1)
    write(batch(spark), 2)
    assert current(spark, path) == {("a", 2, None), ("b", 1, None)}


def test_a_repeated_batch_replaces_itself(spark, path):
    write = changelog.batch_writer(path)
    write(batch(spark, ("a", 1, "x")), 0)
    write(batch(spark, ("a", 2, "y"), ("lost", 9, "z")), 1)
    write(batch(spark, ("a", 2, "y"), ("c", 3, "w")), 1)
    assert current(spark, path) == {("a", 2, "y"), ("c", 3, "w")}


def test_a_batch_in_writing_is_not_read(spark, path):
    write = changelog.batch_writer(path)
    write(batch(spark, ("a", 0, "x"), ("b", 0, "x")), 0)
    batch(spark, ("a", 1, "y")).write.parquet(f"{path}/changes/batch_id=1/attempt=half")
    assert current(spark, path) == {("a", 0, "x"), ("b", 0, "x")}
    write(batch(spark, ("a", 1, "y"), ("b", 1, "y")), 1)
    batch(spark, ("a", 7, "y")).write.parquet(f"{path}/changes/batch_id=1/attempt=again")
    assert current(spark, path) == {("a", 1, "y"), ("b", 1, "y")}


def test_an_empty_log(spark, path):
    empty = changelog.latest(spark, path, ["k"], "k string, n int")
    assert empty.columns == ["k", "n"] and empty.count() == 0
    with pytest.raises(ValueError):
        changelog.latest(spark, path, ["k"])
    assert changelog.prune(spark, path) is None


def test_batch_ids_are_ordered_as_numbers(spark, path):
    write = changelog.batch_writer(path)
    write(batch(spark, ("a", 9, "x")), 9)
    write(batch(spark, ("a", 10, "y")), 10)
    assert current(spark, path) == {("a", 10, "y")}


def test_compaction(spark, path):
    write = changelog.batch_writer(path)
    write(batch(spark, ("a", 1, "x"), ("b", 1, "y")), 0)
    assert changelog.compact(spark, path, ["k"]) is None
    write(batch(spark, ("a", 2, "x")), 1)
    write(batch(spark, ("d", 1, "x")), 2)
    before = current(spark, path)
    assert changelog.compact(spark, path, ["k"]) == 1
    assert changelog.compact(spark, path, ["k"]) == 1
    assert current(spark, path) == before
    # Changes up to the base are not read any more.
    write(batch(spark, ("gone", 0, "-")), 0)
    assert current(spark, path) == before
    # The newest batch is still read from the changes, so it may be written again.
    write(batch(spark, ("e", 2, "x")), 2)
    write(batch(spark, ("b", 3, "z"), ("c", 3, "w")), 3)
    after = {("a", 2, "x"), ("b", 3, "z"), ("c", 3, "w"), ("e", 2, "x")}
    assert current(spark, path) == after
    assert changelog.compact(spark, path, ["k"]) == 2
    assert current(spark, path) == after


def test_an_unfinished_base_does_not_count(spark, path):
    write = changelog.batch_writer(path)
    write(batch(spark, ("a", 1, "x"), ("b", 1, "y")), 0)
    write(batch(spark, ("c", 1, "z")), 1)
    everything = current(spark, path)
    batch(spark, ("a", 1, "x")).write.parquet(f"{path}/base/upto=0")
    assert current(spark, path) == everything
    assert changelog.compact(spark, path, ["k"]) == 0
    assert current(spark, path) == everything


def test_old_changes_are_not_scanned(spark, path):
    write = changelog.batch_writer(path)
    for number in range(3):
        write(batch(spark, ("a", number, "x")), number)
    changelog.compact(spark, path, ["k"])
    read = {name.split("/log/")[1].rsplit("/", 1)[0][:16] for name in changelog.latest(spark, path, ["k"]).inputFiles()}
    assert read == {"base/upto=1", "changes/batch_id"}
    assert not any("batch_id=0" in n or "batch_id=1" in n for n in changelog.latest(spark, path, ["k"]).inputFiles())


def test_what_is_not_read_can_be_removed(spark, path, tmp_path):
    write = changelog.batch_writer(path)
    for number in range(5):
        write(batch(spark, ("a", number, "x"), (str(number), number, "y")), number)
        if number == 2:
            changelog.compact(spark, path, ["k"])
    assert changelog.compact(spark, path, ["k"]) == 3
    before = current(spark, path)
    assert changelog.prune(spark, path) == changelog.prune(spark, path) == 3
    assert current(spark, path) == before
    log = tmp_path / "log"
    assert [p.name for p in (log / "changes").iterdir()] == ["batch_id=4"]
    assert [p.name for p in (log / "base").iterdir()] == ["upto=3"]
    write(batch(spark, ("a", 9, "z")), 5)
    assert ("a", 9, "z") in current(spark, path)


def test_attempts_are_ordered_without_a_clock(spark, path, monkeypatch):
    """The restarted driver's clock is behind; its attempt counts nevertheless."""
    moments = iter(range(1_000, 0, -1))
    monkeypatch.setattr(time, "time", lambda: next(moments))
    monkeypatch.setattr(time, "time_ns", lambda: next(moments) * 1_000_000_000)
    write = changelog.batch_writer(path)
    write(batch(spark, ("a", 1, "old")), 0)
    write(batch(spark, ("a", 2, "new")), 0)
    monkeypatch.undo()
    assert current(spark, path) == {("a", 2, "new")}


def test_an_attempt_that_was_overtaken_does_not_count(spark, path, monkeypatch):
    """It began before the restart, and finishes after the restarted one."""
    write, late = changelog.batch_writer(path), []
    touch = Folder.touch

    def held(self, name):
        if name == "0.0":
            late.append((self, name))
        else:
            touch(self, name)

    monkeypatch.setattr(Folder, "touch", held)
    write(batch(spark, ("a", 1, "old")), 0)
    write(batch(spark, ("a", 2, "new")), 0)
    assert current(spark, path) == {("a", 2, "new")}
    touch(*late[0])
    assert current(spark, path) == {("a", 2, "new")}


def test_all_rows_of_the_batches_that_count(spark, path):
    write = changelog.batch_writer(path)
    write(batch(spark, ("a", 1, "x"), ("a", 1, "x")), 0)
    write(batch(spark, ("a", 9, "lost")), 1)
    write(batch(spark, ("a", 1, "x")), 1)
    assert sorted(map(tuple, changelog.rows(spark, path).collect())) == [("a", 1, "x")] * 3
