"""Shards that lag and repeat, marks that outlive a restart, batches handed over twice, tables that aren't shuffled, filters
and bounds that reach the scan."""
import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeforge.operators import audit, cdc
from lakeforge.sources import bucketed, files
from lakeforge.spec import TableSpec
from lakeforge.streaming import audit_stream, marks, once, shards

T0 = datetime(2024, 1, 1)
EVENT = "id long, at timestamp, v string"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def put(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"id": i, "at": (T0 + timedelta(hours=h)).isoformat() if h is not None else None, "v": v}) for i, h, v in rows))


@pytest.mark.parametrize("policy", ["min", "max"])
def test_shards(spark, tmp_path, policy):
    """The second shard is 20 hours behind the first; both repeat events, and one event is in both."""
    fast, slow = tmp_path / "fast", tmp_path / "slow"
    paths = [str(fast), str(slow)]

    def run():
        events = shards.merged_shards(spark, paths, EVENT, "at", ["id"], delay="2 hours", policy=policy)
        audit_stream.append_stream(events, str(tmp_path / "out"), str(tmp_path / "state"), ["shard"]).awaitTermination()

    put(fast, "a", [(1, 30, "x"), (1, 30, "x"), (2, 30.5, "x"), (10, 9, "y"), (9, None, "no instant")])
    put(slow, "a", [(10, 9, "y")])
    run()
    put(fast, "b", [(3, 31, "x"), (2, 30.5, "x")])
    put(slow, "b", [(11, 10, "y"), (10, 9, "y")])
    run()
    put(fast, "c", [(4, 32, "x")])
    put(slow, "c", [(12, 11, "y")])
    run()
    got = sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == ([1, 2, 3, 4, 10, 11, 12] if policy == "min" else [1, 2, 3, 4, 10])
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"
    with pytest.raises(ValueError):
        shards.merged_shards(spark, paths, EVENT, "at", ["id"], policy="mean")


def audit_row(table, batch, end, **more):
    return {"tablename": table, "batch": batch, "ingestiondt": "2024-01-01", "loadstatus": "success", "batchwindowstart": "5", "batchwindowend": end, "harddeletebatch": "n"} | more


ROUNDS = [
    [audit_row("a", "9", "900"), audit_row("a", "10", "80"), audit_row("b", "1", "null"), audit_row("c", "1", "2024-01-01 00:00:00")],
    [audit_row("a", "2", "1000", ingestiondt="2024-02-01"), audit_row("b", "7", "7", loadstatus="failedUnknown"), audit_row("c", "1", "2023-01-01 00:00:00", batchwindowstart=None)],
    [audit_row("a", "11", "3", harddeletebatch="y"), audit_row("b", "3", "12345678901234567890"), audit_row("d", "000", "0")],
]


def test_marks_outlive_a_restart(spark, tmp_path):
    """Each round is a run of its own, which goes on from the checkpoint; the whole audit says the same at each point."""
    sink = once.OncePerBatch(str(tmp_path / "marks"), "q")
    schema = f"tablename string, {marks.STATE}"
    for k, rows in enumerate(ROUNDS):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.txt").write_text("\n".join(map(json.dumps, rows)))
        events = audit_stream.audit_events(spark.readStream.text(str(tmp_path / "in")))
        marks.watermark_stream(events).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
        whole = audit.watermarks(audit_stream.audit_events(spark.createDataFrame([(json.dumps(x),) for r in ROUNDS[: k + 1] for x in r], "value string")))
        names = ["tablename", "ingestiondt", *marks.MARKS]
        now = once.newest(sink.read(spark, schema), ["tablename"]).select(*names)
        assert sorted(map(tuple, now.collect())) == sorted(map(tuple, whole.select(*names).collect()))
    assert len(sink.logged(spark)) == 3


def test_batches_count_once(spark, tmp_path, monkeypatch):
    sink, kind = once.OncePerBatch(str(tmp_path), "q"), "id long"
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], kind)
    seen = lambda: sorted((r.id, r.batch_no) for r in sink.read(spark, kind).collect())
    assert seen() == []
    sink(rows(1, 2), 0)
    sink(rows(3), 1)
    sink(rows(1, 2), 0)  # handed over again
    assert seen() == [(1, 0), (2, 0), (3, 1)]
    rows(7, 8, 9).write.parquet(sink.rows_at(2))  # what a failure before the log leaves
    assert seen() == [(1, 0), (2, 0), (3, 1)]
    sink(rows(4), 2)
    assert seen() == [(1, 0), (2, 0), (3, 1), (4, 2)]
    other = once.OncePerBatch(str(tmp_path), "other")
    other(rows(5), 0)
    assert seen() == [(1, 0), (2, 0), (3, 1), (4, 2)] and [r.id for r in other.read(spark, kind).collect()] == [5]


def test_bucketed_upsert_shuffles_the_changes_alone(spark, tmp_path):
    kind = "id long, name string"
    base = spark.createDataFrame([(k, f"n{k}") for k in range(2000)] + [(None, "null")], kind)
    bucketed.write_bucketed(base, "staged_rows", str(tmp_path / "a"), "id", 4)
    delta = spark.createDataFrame([(5, "new"), (5000, "added"), (None, "null too")], kind)
    gone = spark.createDataFrame([(7,), (8,), (None,)], "id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = bucketed.changed_rows(spark.table("staged_rows"), delta, "id", gone)
        plan = rows._jdf.queryExecution().sparkPlan().toString()
        whole = physical(rows)
        assert "Bucketed: true" in whole and "Bucketed: true" in plan
        lines = whole.split("\n")
        scan = next(k for k, x in enumerate(lines) if "FileScan" in x)
        depth = lambda x: len(x) - len(x.lstrip(" :+-"))
        above, at = [], depth(lines[scan])
        for x in reversed(lines[:scan]):
            if depth(x) < at:
                above, at = [*above, x], depth(x)
        assert above and not any("Exchange" in x for x in above)  # from the table's scan to the top, nothing is shuffled
        bucketed.upsert_bucketed(spark, "staged_rows", str(tmp_path / "b"), delta, "id", 4, deleted=gone)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {k: f"n{k}" for k in range(2000) if k not in (7, 8)} | {5: "new", 5000: "added"}
    now = [(r.id, r.name) for r in spark.table("staged_rows").collect()]
    assert {i: n for i, n in now if i is not None} == want and len(now) == len(want) + 2
    assert sorted(n for i, n in now if i is None) == ["null", "null too"]
    bucketed.upsert_bucketed(spark, "staged_rows", str(tmp_path / "b"), spark.createDataFrame([(5, "again")], kind), "id", 4)
    assert {r.name for r in spark.table("staged_rows").where("id = 5").collect()} == {"again"} and spark.table("staged_rows").count() == len(now)
    spark.sql("DROP TABLE staged_rows")


def test_windows_and_cut_offs_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(k, T0 + timedelta(hours=k)) for k in range(200)] + [(999, datetime(9999, 12, 31))], "id long, at timestamp_ntz").write.parquet(path)
    rows = cdc.read_window(spark.read.parquet(path), TableSpec("t", cdc_col="at"), "di", end=F.lit(str(T0)).cast("timestamp_ntz"))
    limits = cdc.bounds(rows, F.col("at"))
    assert "LessThan(at,9999-01-01" in physical(limits)
    out = cdc.up_to(rows, F.col("at"), limits, T0 + timedelta(days=30), cdc.CutOff(lag_minutes=600))
    plan = physical(out)
    assert "GreaterThan(at,2024-01-01" in plan and "LessThanOrEqual(at,2024-01-08T21:00" in plan
    assert sorted(r.id for r in out.collect()) == list(range(1, 190))


def test_bounds_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(k, k) for k in (5, -3, 900)], "id long, v int").write.parquet(path)
    out = files.footer_bounds(spark, path, "id")
    assert "PushedAggregation: [MIN(id), MAX(id)]" in physical(out)
    assert tuple(out.first()) == (-3, 900)
