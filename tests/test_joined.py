"""Metrics over joins: folded tables against real joins, plans, specifications that are refused."""
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeforge.operators.joined import Edge, JoinSpec, Measure, Window, joined, measured
from lakeforge.operators import recon
from lakeforge.plans import billing
from lakeforge.sources import sinks

W = Window(1, datetime(2020, 1, 1), datetime(2020, 6, 15))
ALL = lambda w: F.lit(True)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    return {
        "fact": make([(k, k % 7 if k % 5 else None, k % 3, float(k)) for k in range(100)], "id long, a long, kind long, amount double"),
        "a": make([(k % 7, k, k % 2 == 0) for k in range(30) if k % 7 != 6], "id long, b long, live boolean"),
        "b": make([(k % 10, k) for k in range(25)], "id long, x long"),
        "hot": make([(3, k) for k in range(5000)], "id long, x long"),
    }


def total(df, weight=1):
    return df.agg(F.sum(F.col("amount") * weight)).first()[0]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("below", ["inner", "left"])
def test_folded_tables_count_like_joins(spark, tables, how, below):
    spec = JoinSpec("f", "fact", (Edge("a", "a", "id", "f.a", how, where="live", given="f.kind < 2"), Edge("b", "b", "id", "a.b", below), Edge("h", "hot", "id", "f.a", "left")))
    rows = joined(spec, tables)
    inner = tables["a"].where("live").alias("a")
    if below == "left":
        pairs = inner.join(tables["b"].alias("b"), F.expr("b.id = a.b"), "left").select(F.col("a.id").alias("aid"))
    else:
        pairs = inner.join(tables["b"].alias("b"), F.expr("b.id = a.b")).select(F.col("a.id").alias("aid"))
    want = tables["fact"].join(pairs, F.expr("aid = a AND kind < 2"), how).join(tables["hot"].select(F.col("id").alias("hid")), F.expr("hid = a"), "left")
    assert total(rows, F.col("weight")) == total(want)
    assert rows.agg(F.sum("weight")).first()[0] == want.count()
    assert rows.count() <= 100  # nothing fans out


@pytest.mark.parametrize("how", ["inner", "left"])
def test_tables_below_an_edge_are_counted_with_it(spark, tables, how):
    inner = (Edge("b", "b", "id", "a.b", needed=True), Edge("h", "hot", "id", "b.x", "left", given="a.live"))
    rows = joined(JoinSpec("f", "fact", (Edge("a", "a", "id", "f.a", how, below=inner),)), tables)
    pairs = tables["a"].select(F.col("id").alias("aid"), "b", "live").join(tables["b"].select(F.col("id").alias("bid"), F.col("x").alias("bx")), F.expr("bid = b"))
    pairs = pairs.join(tables["hot"].select(F.col("id").alias("hid")), F.expr("hid = bx AND live"), "left").select("aid")
    want = tables["fact"].join(pairs, F.expr("aid = a"), how)
    assert rows.count() <= 100 and rows.agg(F.sum("weight")).first()[0] == want.count() > 100
    assert total(rows, F.col("weight")) == total(want)
    assert JoinSpec("f", "fact", (Edge("a", "a", "id", "f.a", below=inner),)).tables() == {"fact", "a", "b", "hot"}
    with pytest.raises(ValueError):
        Edge("a", "a", "id", "f.a", needed=True, below=inner)


@pytest.mark.parametrize("weighted", [False, True])
def test_many_windows_are_bits_and_sums_go_without_keys(spark, weighted):
    """Conditions beyond one long; a counted value's rows hold a set of conditions and no sums."""
    start, data = datetime(2020, 1, 1), [(k, k % 37 if k % 5 else None, k / 8 if k % 7 else None, k % 3) for k in range(400)]
    rows = spark.createDataFrame(data, "at long, a long, amount double, weight long")
    rows = rows if weighted else rows.drop("weight")
    windows = [Window(k, start, start) for k in range(40)]
    until, within, never = (lambda w: F.col("at") <= w.id * 9), (lambda w: F.col("at").between(w.id * 9, w.id * 10)), lambda w: F.col("at") > 1000 + w.id
    out = measured(rows, (Measure("N", "distinct", "a", until), Measure("S", "sum", "amount", until), Measure("M", "sum", "amount", within), Measure("Z", "sum", "amount", never), Measure("D", "distinct", "a", within)), windows)
    keyed = [x for x in plan(out).splitlines() if "Aggregate [key#" in x]
    assert keyed and not any("sum(" in x for x in keyed)
    got = {(r.window, r.auditentity): (r.value, r.n_rows) for r in out.collect()}
    for k in range(40):
        for names, rows_in in (("NS", [x for x in data if x[0] <= k * 9]), ("DM", [x for x in data if k * 9 <= x[0] <= k * 10]), ("_Z", [])):
            of = lambda x: x[3] if weighted else 1
            n, money = sum(map(of, rows_in)), [round(x[2] * 100 + 1e-6) * of(x) for x in rows_in if x[2] is not None]
            assert got[k, names[1]] == (sum(money) / 100 if money else None, n)
            assert names[0] == "_" or got[k, names[0]] == (len({x[1] for x in rows_in} - {None}), n)


def test_refused_specs(tables):
    for edges in ((Edge("a", "a", "id", "x.a"),), (Edge("a", "a", "id", "f.a"), Edge("a", "b", "id", "f.b"))):
        with pytest.raises(ValueError):
            JoinSpec("f", "fact", edges)
    with pytest.raises(ValueError):
        Edge("a", "a", "id", "f.a", "cross")
    with pytest.raises(ValueError):  # refers to a folded table and another
        joined(JoinSpec("f", "fact", (Edge("a", "a", "id", "f.a"), Edge("b", "b", "id", "a.b", given="f.kind = 1"))), tables)


def test_measures_share_one_scan(spark, tables):
    wanted = (Measure("N", "distinct", "a", ALL), Measure("S", "sum", "amount", lambda w: F.col("kind") == 1), Measure("NONE", "sum", "amount", lambda w: F.col("kind") > 5), Measure("N1", "distinct", "a", lambda w: F.col("kind") == 1))
    out = measured(tables["fact"], wanted, [W, Window(2, W.start, W.end)])
    assert "Expand" not in plan(out)
    got = {(r.window, r.auditentity): (r.value, r.n_rows) for r in out.collect()}
    assert len(got) == 8 and got[1, "N"] == (7.0, 100) and got[2, "N1"][0] == 7.0
    assert got[1, "S"][0] == sum(k for k in range(100) if k % 3 == 1) and got[1, "NONE"] == (None, 0)
    assert all(r.value in (None, 0.0) and r.n_rows == 0 for r in measured(tables["fact"].limit(0), wanted, [W]).collect())
    with pytest.raises(ValueError):
        measured(tables["fact"], (Measure("A", "distinct", "a", ALL), Measure("B", "distinct", "kind", ALL)), [W])


def test_load_cycles(spark):
    rows = [(k, datetime(2020, 1, 1 + k), datetime(2020, 2, 1 + k), "BILL" if k % 4 else "OTHER", "STAGE") for k in range(9)]
    cycles = spark.createDataFrame(rows + rows[:2], "load_cycle_id long, pv_startdate timestamp_ntz, pv_enddate timestamp_ntz, source_system_code string, cycle_type_code string")
    found = billing.load_cycles(cycles, "BILL", "STAGE")
    assert [w.id for w in found] == [1, 2, 3, 5, 6, 7] and found[0].end == datetime(2020, 2, 2)
    with pytest.raises(ValueError):
        billing.load_cycles(cycles, "BILL", "STAGE", most=5)
    assert billing.load_cycles(cycles, "NONE", "STAGE") == []


def test_compared_and_written_by_system(spark, tmp_path):
    schema = "etl_load_cycle_id long, auditentity string, auditfrom string, auditthru string, value double"
    source = spark.createDataFrame([(1, "A", "f", "t", 1.0), (2, "A", "f", "t", 2.0), (1, "B", "f", "t", None)], schema)
    lake = spark.createDataFrame([(1, "A", "f", "t", 1.0), (2, "A", "f", "t", 3.0), (1, "B", "f", "t", None), (1, "C", "g", "u", 4.0)], schema)
    out = recon.reconciled_each(source, lake, "BILL", "2020-06-15")
    status = {(r.etl_load_cycle_id, r.auditentity): (r.recon_status, r.auditfrom, r.polstatus) for r in out.collect()}
    assert status == {(1, "A"): ("success", "f", None), (2, "A"): ("failed", "f", None), (1, "B"): ("failed", "f", None), (1, "C"): ("missing", "g", None)}
    sinks.append_recon(out, str(tmp_path / "recon"))
    sinks.append_recon(out.withColumn("source_system_cd", F.lit("POL")), str(tmp_path / "recon"))
    sinks.append_recon(out, str(tmp_path / "recon"))
    back = spark.read.parquet(str(tmp_path / "recon"))
    assert {(r.source_system_cd, r["count"]) for r in back.groupBy("source_system_cd").count().collect()} == {("BILL", 8), ("POL", 4)}
