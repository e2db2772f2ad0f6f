import glob
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeforge.functions.text import shifted, unshifted
from lakeforge.functions.xml_flatten import ESTIMATE, estimate_tables, lineage, parse_failures, rough_draft_schema, walked
from lakeforge.operators import audit, merge
from lakeforge.plans import ingest
from lakeforge.sources import files, jdbc, sinks
from lakeforge.streaming import audit_stream

KIND = "id long, v string, p string"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 8), st.text("ab", max_size=2), max_size=6), st.dictionaries(st.integers(0, 8), st.text("cd", max_size=2), max_size=6))
def test_upsert_is_idempotent(spark, base, delta):
    a, b = (spark.createDataFrame([(k, v, "x") for k, v in d.items()], KIND) for d in (base, delta))
    once = merge.upserted(a, b, "id")
    want = base | delta
    assert {r.id: r.v for r in once.collect()} == want and once.count() == len(want)
    assert sorted(merge.upserted(once, b, "id").collect()) == sorted(once.collect())


def test_upsert_moves_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "m1"), (2, "b", "m1"), (3, "c", "m2"), (4, "d", "m3")], KIND).write.partitionBy("p").parquet(path)
    untouched = glob.glob(f"{path}/p=m2/*.parquet")
    sinks.upsert_partitions(spark, path, spark.createDataFrame([(1, "new", "m3"), (9, "i", "m4")], KIND), "id", "p", deleted=spark.createDataFrame([(4,)], "id long"))
    assert sorted((r.id, r.v, r.p) for r in spark.read.parquet(path).collect()) == [(1, "new", "m3"), (2, "b", "m1"), (3, "c", "m2"), (9, "i", "m4")]
    assert glob.glob(f"{path}/p=m2/*.parquet") == untouched


def test_vanished_uses_one_row(spark):
    lake = spark.createDataFrame([(1, "2024-01-01", "9", 0), (1, "2024-02-01", "1", 0), (2, "2024-01-01", "1", 1), (3, "2024-01-01", "1", 0)], "id long, ingestiondt string, batch string, deleted_flag int")
    got = merge.vanished(lake, spark.createDataFrame([(3,)], "id long"), "id").collect()
    assert [tuple(r) for r in got] == [(1, "2024-02-01", "1")]
    assert [tuple(r) for r in merge.tombstones(lake, spark.createDataFrame([(3,)], "id long"), "id", "d", "b").collect()] == [(1, "d", "b", 1)]


def test_most_recent_orders_texts(spark):
    rows = spark.createDataFrame([(1, "5", "9"), (1, "5", "10"), (1, "41", "1")], "id long, uniqueid string, batch string")
    assert [r.batch for r in merge.most_recent(rows, ["id"]).collect()] == ["9"]
    assert [r.batch for r in merge.most_recent(rows, ["id"], typed=True).collect()] == ["10"]


def test_retry_statuses():
    tries = []

    def write(result):
        tries.append(1)
        if isinstance(result, Exception):
            raise result
        return result

    results = iter([(2, 1), (2, 2)])
    assert sinks.write_with_retry(lambda: write(next(results))) == "success" and len(tries) == 2
    assert sinks.write_with_retry(lambda: write((2, 1))) == "failed"
    assert sinks.write_with_retry(lambda: write(OSError())) == "failedUnknown"


def test_key_values_reports_and_backup(spark, tmp_path):
    rows = spark.createDataFrame([(1, "<a>" + "x" * 30), (2, None)], "id long, v string")
    out = str(tmp_path / "kv")

    class Store:
        def put(self, rows):
            import uuid

            with open(f"{out}-{uuid.uuid4().hex}", "w") as f:
                f.write("".join(f"{r['id']}\n" for r in rows))

    sinks.write_key_values(rows, Store, "id", partitions=2, batch=1)
    assert sorted(int(x) for p in glob.glob(f"{out}-*") for x in open(p)) == [1, 2]
    page = sinks.html_table(rows)
    assert "&lt;a&gt;xxxxxxxxxxxxxx..." in page and page.count("<tr>") == 3
    rows.write.parquet(str(tmp_path / "main"))
    assert sinks.backed_up(spark, str(tmp_path / "main"), str(tmp_path / "copy"), drop=True)
    assert not (tmp_path / "main").exists() and spark.read.parquet(str(tmp_path / "copy")).count() == 2
    assert sinks.valid_address("a@b.c") and not sinks.valid_address("ab.c")
    assert sinks.save_mode("tl", False) == sinks.save_mode("di", True) == "overwrite" and sinks.save_mode("di", False) == "append"
    assert len(sinks.create_statements("t", "/p", rows, ["id"])) == 2


def test_jdbc_options():
    o = jdbc.connection("SqlServer", "h", 1, "d", "u", lambda: "p")
    assert o["url"] == "jdbc:sqlserver://h:1;databaseName=d"
    assert jdbc.ranged(o, "select 1", "id", 0, 10**9)["numPartitions"] == "80"
    with pytest.raises(ValueError):
        jdbc.ranged(o, "select 1", "id")


def test_audit_marks_and_gate(spark):
    rows = [("d1", "9", "t", "success", "9", "n"), ("d2", "10", "t", "success", "10", "n"), ("d3", "11", "t", "failed", "null", "n"), ("d4", "12", "t", "failedUnknown", "99", "n"), ("d5", "13", "t", "success", "99", "y")]
    a = spark.createDataFrame([(*r[:4], r[4], r[4], r[5], str(i)) for i, r in enumerate(rows)], "ingestiondt string, batch string, tablename string, loadstatus string, batchwindowstart string, batchwindowend string, harddeletebatch string, loadendtime string")
    assert tuple(audit.watermarks(a).first()) == ("t", "d2", "10", "10", "10")
    assert not audit.gate_passes(spark.createDataFrame([("1", "t", "failed", "x")], "batch string, tablename string, loadstatus string, loadendtime string"))
    assert audit.gate_passes(a.where("batch = '9'"))
    assert sinks.failure_report(a.withColumn("exception", a.tablename).withColumn("loadtype", a.tablename)).startswith("<h3>d3 11 t")


def test_two_run_stream_appends_once(spark, tmp_path):
    base = str(tmp_path)
    full = {"ingestiondt": "d", "batch": "1", "tablename": "t", "sourcecount": 3}
    import json

    for k in range(2):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.txt").write_text(json.dumps(full | {"batch": str(k)}) + "\nnot json\n")
        events = audit_stream.audit_events(audit_stream.text_stream(spark, f"{base}/in"))
        audit_stream.append_stream(events, f"{base}/out", f"{base}/state", ["ingestiondt"]).awaitTermination()
    got = spark.read.parquet(f"{base}/out").select("batch", "sourcecount", "loadtype").collect()
    assert sorted(map(tuple, got)) == [("0", 3, None), ("1", 3, None)]


def test_loops():
    now = [datetime(2024, 1, 1)]
    assert audit_stream.continuous(lambda a: (a or 0) + 1, lambda: now[0], datetime(2024, 1, 1), once=True) == 1
    ticks = iter([datetime(2024, 1, 1, h) for h in range(12)])
    assert audit_stream.continuous(lambda a: (a or 0) + 1, lambda: next(ticks), datetime(2024, 1, 1, 6), sleep=lambda s: None) > 1
    with pytest.raises(TimeoutError):
        audit_stream.wait_for(lambda: datetime(2024, 1, 1), datetime(2025, 1, 1), tries=2, sleep=lambda s: None)


def test_tables_run_side_by_side(spark):
    out = dict(ingest.all_tables([1, 2, 0], lambda x: 10 // x, spark, pool="a"))
    assert out[1] == 10 and out[2] == 5 and isinstance(out[0], ZeroDivisionError)


def test_xml_file_and_lineage(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<estimate><claim>c1</claim><groups><node id="1" name="A"/><node id="2" parent="1" name="B"/><node id="3" parent="2" name="C"/></groups><items><item group="3" text="t" amount="5"/></items></estimate>')
    (tmp_path / "b.xml").write_text("<estimate><claim>c2</claim></estimate>")
    docs = files.xml(spark, str(tmp_path), "estimate", ESTIMATE)
    tables = estimate_tables(docs)
    assert sorted((r.claim, r.total) for r in tables["header"].collect()) == [("c1", ""), ("c2", "")]
    assert [(r["group"], r.amount) for r in tables["item"].collect()] == [("3", "5")]
    tree = {r.id: (r.lineage, r.depth) for r in lineage(tables["group"], ["claim"]).collect()}
    assert tree == {"1": ("A", 1), "2": ("A || B", 2), "3": ("A || B || C", 3)}
    seen = spark.createDataFrame([(docs.select("source_file").first()[0],)], "source_file string")
    assert files.unseen(docs, seen).count() == 1


def test_malformed_lines_are_dropped(spark, tmp_path):
    (tmp_path / "x.tsv").write_text("1\ta\n2\nx\tb\n3\tc\n")
    assert [r.k for r in files.tsv(spark, str(tmp_path / "x.tsv"), "k int, v string").orderBy("k").collect()] == [1, 3]
    (tmp_path / "f.txt").write_text("AB12 x\n")
    assert files.fixed_width(spark, str(tmp_path / "f.txt"), [("a", 1, 2), ("b", 3, 3)]).first().asDict() == {"a": "AB", "b": "12"}


@given(st.text(), st.integers(-200, 200))
def test_shift_round_trip(text, by):
    assert unshifted(shifted(text, by), by) == text


def test_deeper_drafts_raise(spark):
    draft = "<draft><claim>1</claim><groups><group name='a'><group name='b'><group name='c'/></group></group></groups></draft>"
    parsed = lambda n: spark.createDataFrame([(draft, "f")], "value string, source_file string").select(F.from_xml("value", rough_draft_schema(n)).alias("d"), "source_file").select("d.*", "source_file")
    names = lambda n: sorted(r.lineage for r in walked(parsed(n), "groups.group", [], {"claim": "claim"}, levels=n).collect())
    assert names(3) == names(5) == ["a", "a || b", "a || b || c"]
    with pytest.raises(Exception, match="deeper than 2 levels"):
        names(2)


def test_parse_failures(spark):
    rows = spark.createDataFrame([("<a", "f1"), (None, "f2")], "_corrupt_record string, source_file string")
    assert [tuple(r) for r in parse_failures(rows, "estimate", "t").collect()] == [("t", "estimate", "f1")]


def test_connected():
    waits, left = [], [OSError(), OSError(), 7]

    def connect():
        x = left.pop(0)
        if isinstance(x, OSError):
            raise x
        return x

    assert sinks.connected(connect, sleep=waits.append) == 7 and waits == [300, 300]
    left[:] = [OSError(), OSError()]
    with pytest.raises(OSError):
        sinks.connected(connect, tries=2, sleep=waits.append)


def test_upsert_that_empties_partitions(spark, tmp_path):
    """A partition whose only row moves or is deleted is gone afterwards."""
    path = f"{tmp_path}/emptied"
    sinks.write_partitioned(spark.createDataFrame([(1, "m1"), (2, "m2"), (3, "m 3/x"), (4, "m4")], "k int, month string"), path, ["month"], "overwrite")
    delta, deleted = spark.createDataFrame([(1, "m4")], "k int, month string"), spark.createDataFrame([(2,), (3,)], "k int")
    sinks.upsert_partitions(spark, path, delta, "k", "month", deleted=deleted)
    assert sorted(map(tuple, spark.read.parquet(path).select("k", "month").collect())) == [(1, "m4"), (4, "m4")]


def test_batches_of_different_lengths(spark):
    """Batch 10 comes after batch 9."""
    rows = [("a", "9", "success", "t1"), ("a", "10", "failed", "t2")]
    log = spark.createDataFrame(rows, "tablename string, batch string, loadstatus string, loadendtime string")
    assert audit.delete_gate(log).first()["blocked"] == 1
    assert audit.latest_by_table(log).first()["batch"] == "10"
    lake = spark.createDataFrame([(1, "d", "9", 0), (1, "d", "10", 1), (2, "d", "9", 1), (2, "d", "10", 0)], "k int, ingestiondt string, batch string, deleted_flag int")
    gone = merge.vanished(lake, spark.createDataFrame([], "k int"), "k").collect()
    assert [(r.k, r.batch) for r in gone] == [(2, "10")]


def test_published_lists_lose_removed_rows(spark, tmp_path):
    path, kind = f"{tmp_path}/lists", "typelistname string, id int, code string"
    sinks.publish_lists(spark, path, spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("c", 1, "w")], kind).select("id", "code", "typelistname"))
    sinks.publish_lists(spark, path, spark.createDataFrame([("a", 1, "x"), ("b", 1, "z")], kind).select("id", "code", "typelistname"))
    assert sorted(map(tuple, spark.read.parquet(path).select("typelistname", "id", "code").collect())) == [("a", 1, "x"), ("b", 1, "z")]


def test_loads_follow_each_other(spark, tmp_path):
    """Nothing after the watermark is empty; a failed write of unknown state is loaded again; a restart after success does nothing."""
    from datetime import datetime

    from lakeforge.plans import ingest
    from lakeforge.spec import TableSpec

    path, log = str(tmp_path / "table"), str(tmp_path / "audit")
    source = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-01-01 00:00:00'), (2, TIMESTAMP_NTZ'2024-02-01 00:00:00'), (3, NULL) AS x(id, at)")
    load = lambda batch, **x: ingest.Load(TableSpec("x", cdc_col="at"), "id", "di", batch, datetime(2024, 6, 1), **x)

    def broken(*_, **__):
        raise OSError("no space")

    assert ingest.load_next(spark, source, {}, load("0009"), path, log, write=broken, retries=0) == "failedUnknown"
    assert ingest.load_next(spark, source, {}, load("0010"), path, log) == "success"
    assert ingest.load_next(spark, source, {}, load("0011"), path, log) == "empty"
    assert ingest.load_next(spark, source, {}, load("0012", restart=True), path, log) == "empty"
    rows = spark.read.schema("id int, batch string").parquet(path).select("id", "batch")
    assert sorted(map(tuple, rows.collect())) == [(1, "0010"), (2, "0010")]
    assert sorted((r.batch, r.loadstatus, r.targetcount) for r in ingest.audit_log(spark, log).collect()) == [("0009", "failedUnknown", None), ("0010", "success", 2)]


def test_load_needs_instants(spark, tmp_path):
    from datetime import datetime

    from lakeforge.plans import ingest
    from lakeforge.spec import TableSpec

    with pytest.raises(ValueError):
        ingest.load_next(spark, spark.range(1), {}, ingest.Load(TableSpec("x", cdc_col="id"), "id", "di", "1", datetime(2024, 1, 1)), str(tmp_path / "t"), str(tmp_path / "a"))
