"""Versions of a table: what is rewritten, what a failure leaves, two writers at once."""
import pytest
from pyspark.sql import functions as F

from lakeforge.sources.versioned import Conflict, VersionedTable

KIND = "id long, name string, month string"


@pytest.fixture()
def made(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    table = VersionedTable(spark, str(tmp_path / "t"), "id")
    table.overwrite(spark.createDataFrame([(k, f"n{k}", f"m{k % 3}") for k in range(1000)], KIND))
    yield table
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows(df):
    return {r.id: r.name for r in df.collect()}


def test_only_touched_files_change(spark, made):
    before = set(made.files())
    assert len(before) == 4 and {r.file for r in made.manifest().collect()} == before
    v = made.upsert(spark.createDataFrame([(3, "new", "m"), (5000, "added", "m")], KIND), spark.createDataFrame([(4,), (77777,)], "id long"))
    after = set(made.files())
    assert v == 2 and len(before & after) == 3  # untouched files keep their names
    want = {k: f"n{k}" for k in range(1000) if k != 4} | {3: "new", 5000: "added"}
    assert rows(made.read()) == want and made.read().count() == len(want)
    assert rows(made.read(1)) == {k: f"n{k}" for k in range(1000)}
    assert sum(r.n for r in made.manifest().collect()) == len(want)


def test_keys_in_no_file_rewrite_nothing(spark, made):
    before = set(made.files())
    made.upsert(spark.createDataFrame([(-5, "low", "m"), (None, "null", "m")], KIND), spark.createDataFrame([(2000,)], "id long"))
    assert before < set(made.files()) and made.read().count() == 1002
    made.upsert(spark.createDataFrame([(None, "null", "m")], KIND))
    assert made.read().where("id IS NULL").count() == 2
    made.upsert(spark.createDataFrame([], KIND))
    assert made.read().count() == 1003 and made.version() == 4


@pytest.mark.parametrize("step", ["swap", "commit", "stored"])
def test_failure_changes_nothing(spark, made, monkeypatch, step):
    before, want = made.files(), rows(made.read())

    def fail(*a):
        raise OSError("lost")

    monkeypatch.setattr(made, step, fail)
    with pytest.raises(OSError):
        made.upsert(spark.createDataFrame([(3, "new", "m")], KIND))
    monkeypatch.undo()
    assert made.version() == 1 and made.files() == before and rows(made.read()) == want
    assert made.vacuum() > 0 or step == "stored"  # what the failed commit wrote goes
    assert rows(made.read()) == want
    made.upsert(spark.createDataFrame([(3, "again", "m")], KIND))
    assert rows(made.read())[3] == "again"


def test_two_writers(spark, made, monkeypatch):
    other = VersionedTable(spark, made.path, "id")
    real = made.stored

    def between(new, name):
        lines = real(new, name)
        other.upsert(spark.createDataFrame([(8, "other", "m")], KIND))
        return lines

    monkeypatch.setattr(made, "stored", between)
    with pytest.raises(Conflict):
        made.upsert(spark.createDataFrame([(3, "mine", "m")], KIND))
    assert made.version() == 2 and rows(made.read())[8] == "other" and rows(made.read())[3] == "n3"


def test_vacuum(spark, made):
    for k in range(4):
        made.upsert(spark.createDataFrame([(k, "x", "m")], KIND))
    want = rows(made.read())
    live = set(made.files()) | set(made.files(4))
    every = {f for v in range(1, 6) for f in made.files(v)}
    assert made.vacuum(keep=2) == len(every - live) > 0 and made.vacuum(keep=2) == 0
    assert rows(made.read()) == want and made.version() == 5
    assert rows(made.read(4))[3] == "n3"
    made.overwrite(made.read().where(F.col("id") < 10))
    assert made.read().count() == 10


def test_empty_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "e"), "id")
    assert table.version() == 0
    table.overwrite(spark.createDataFrame([], KIND))
    assert table.read().count() == 0
    table.upsert(spark.createDataFrame([(1, "a", "m")], KIND))
    assert rows(table.read()) == {1: "a"}
