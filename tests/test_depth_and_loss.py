"""Trees of any depth, broken documents, loads that lost rows, tables that say which rows can be missing."""
import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.functions import xml_groups
from lakeforge.functions.xml_flatten import GROUP_FIELDS, lineage, rough_draft_schema, rough_draft_tables
from lakeforge.functions.xml_groups import groups_at_any_depth
from lakeforge.operators import merge
from lakeforge.plans import ingest
from lakeforge.sources import sinks
from lakeforge.spec import TableSpec, table_specs


def test_lineage_of_any_forest(spark):
    """A chain of 500, two documents with the same ids, a missing parent, circles of one and of three."""
    rows = [("d", str(k), str(k - 1) if k else None, f"n{k}") for k in range(500)]
    rows += [("e", "0", "", "root"), ("e", "1", "0", "leaf"), ("e", "2", "gone", "lost"), ("e", "3", "2", "lost too"), ("e", "4", "4", "self"), ("e", "5", "7", "a"), ("e", "6", "5", "b"), ("e", "7", "6", "c"), ("e", "8", "5", "below a circle")]
    out = {(r.doc, r.id): (r.lineage, r.depth) for r in lineage(spark.createDataFrame(rows, "doc string, id string, parent string, name string"), ["doc"], separator="/").collect()}
    assert {k: v for k, v in out.items() if k[0] == "e"} == {("e", "0"): ("root", 1), ("e", "1"): ("root/leaf", 2)}
    assert len(out) == 502 and all(out["d", str(k)] == ("/".join(f"n{j}" for j in range(k + 1)), k + 1) for k in range(500))
    assert lineage(spark.createDataFrame([], "id string, parent string, name string")).count() == 0


def test_one_deep_or_broken_document_fails_no_other(spark):
    deep = "<draft><claim>1</claim><groups>" + "".join(f'<group name="g{k}"><room walls="{k}"/>' for k in range(2000)) + "</group>" * 2000 + "</groups></draft>"
    plain = '<draft><claim>2</claim><groups><group name="a"><items><item line="1" total="2"/><item line="2"/></items><totals total="3.50" tax="x"/></group><group name="b"><totals total="1"/></group></groups></draft>'
    raw = spark.createDataFrame([(deep, "f1"), (plain, "f2"), (plain[:90], "f3"), (None, "f4"), ("", "f5"), ("<draft/>", "f6")], "value string, source_file string")
    out = groups_at_any_depth(raw, "groups.group", GROUP_FIELDS, ["claim"], separator="/").collect()
    assert {r.source_file for r in out} == {"f1", "f2"} and max(r.depth for r in out) == 2000
    last = next(r for r in out if r.depth == 2000)
    assert last.lineage == "/".join(f"g{k}" for k in range(2000)) and last.room["_walls"] == "1999" and last.claim == "1"
    a = next(r for r in out if r.lineage == "a")
    assert [(x["_line"], x["_total"]) for x in a["items"]["item"]] == [("1", "2"), ("2", None)] and a.room is None
    parsed = raw.where("source_file = 'f2'").select(F.from_xml("value", rough_draft_schema(0)).alias("d"), "source_file").select("d.*", "source_file")
    sums = rough_draft_tables(parsed, raw=raw.where("source_file = 'f2'"))["dimension_totals"].first()
    assert (float(sums.total), sums.tax) == (4.5, None)


def test_a_group_costs_what_it_holds(spark):
    """Fields that a group lacks are neither looked for nor written; the first of repeated single children counts, an empty
    one is there, and documents without groups come between others."""
    kind = T.StructType.fromDDL(GROUP_FIELDS)
    text = '<draft><claim>1</claim><groups><group name="a"><group name="b"><room/></group></group><group name="c"><room walls="1"/><room walls="2" floor=""/><items/></group></groups></draft>'
    found = [(g[1], json.loads(g[3])) for g in xml_groups.groups(text, ["groups", "group"], ["claim"], xml_groups.reader(kind), "/")]
    assert found == [("a", {}), ("a/b", {"room": {}}), ("c", {"room": {"_walls": "1"}, "items": {"item": []}})]
    raw = spark.createDataFrame([(text, "f1"), ("<draft/>", "f2"), (None, "f3"), (text, "f4")], "value string, source_file string")
    out = groups_at_any_depth(raw, "groups.group", GROUP_FIELDS, ["claim"], separator="/").collect()
    shown = lambda r: (r.source_file, r.lineage, r.depth, r.room and tuple(r.room), r["items"] and r["items"]["item"], r.totals)
    want = [("a", 1, None, None, None), ("a/b", 2, (None,) * 4, None, None), ("c", 1, ("1", None, None, None), [], None)]
    assert sorted(map(shown, out), key=lambda r: r[:2]) == [(f, *w) for f in ("f1", "f4") for w in want]


T0 = datetime(2024, 1, 1)


def rows_until(spark, n):
    return spark.createDataFrame([(k, T0 + timedelta(hours=k)) for k in range(n)], "id long, at timestamp_ntz")


def half(rows, path, by, mode, *, batch):
    """A write that loses every second row."""
    return rows.count(), sinks.counted_write(rows.where("id % 2 = 0"), path, by, mode, batch=batch)[1]


def test_a_load_after_lost_rows_loads_them_again(spark, tmp_path):
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    load = lambda batch, kind="di": ingest.Load(TableSpec("t", cdc_col="at"), "id", kind, batch, T0 + timedelta(days=30))
    assert ingest.load_next(spark, rows_until(spark, 50), {}, load("1"), path, log, write=half, retries=0) == "failed"
    assert spark.read.parquet(path).count() == 25
    assert ingest.load_next(spark, rows_until(spark, 100), {}, load("2"), path, log) == "success"
    there = spark.read.parquet(path)
    assert sorted(r.id for r in there.collect()) == list(range(100)) and {r.batch for r in there.select(F.col("batch").cast("string").alias("batch")).collect()} == {"2"}
    assert ingest.load_next(spark, rows_until(spark, 120), {}, load("3"), path, log) == "success"
    assert spark.read.parquet(path).count() == 120
    assert ingest.load_next(spark, rows_until(spark, 120), {}, load("4"), path, log) == "empty"


def test_a_full_load_takes_the_place_only_when_whole(spark, tmp_path):
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    load = lambda batch: ingest.Load(TableSpec("t", cdc_col="at"), "id", "tl", batch, T0 + timedelta(days=30))
    assert ingest.load_next(spark, rows_until(spark, 10), {}, load("1"), path, log) == "success"
    assert ingest.load_next(spark, rows_until(spark, 30), {}, load("2"), path, log, write=half, retries=0) == "failed"
    assert spark.read.parquet(path).count() == 10
    assert ingest.load_next(spark, rows_until(spark, 30), {}, load("3"), path, log) == "success"
    assert spark.read.parquet(path).count() == 30 and sorted(x.name for x in tmp_path.iterdir()) == ["log", "t"]


def test_specs_say_which_rows_can_be_missing(spark):
    (spec,) = table_specs("table|cdc_col|missing where\nt|at|retired = 0\n")
    assert spec.missing_where == "retired = 0"
    source = spark.createDataFrame([(k, T0, k % 2) for k in range(10)], "id long, at timestamp_ntz, retired int")
    for by_checksum in (False, True):
        out = ingest.missing_rows(source, source.where("id < 4"), {}, ingest.Load(spec, "id", "di", "1", T0), by_checksum=by_checksum)
        assert sorted(r.id for r in out.collect()) == [4, 6, 8]


def test_seed_of_the_last_full_batch(spark):
    rows = spark.createDataFrame([(1, "9"), (2, "10"), (3, "10"), (4, "11")], "id long, batch string")
    full = spark.createDataFrame([("10",)], "batch string")
    assert sorted(r.id for r in merge.seeded(rows, "id", "last_full", full=full).collect()) == [2, 3]
