from datetime import datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeforge.operators import cdc, recon, schema, stamp
from lakeforge.spec import TableSpec

NOON = datetime(2024, 1, 1, 12)


@given(st.datetimes(datetime(2000, 1, 1), datetime(2030, 1, 1)), st.integers(0, 10_000), st.integers(0, 600))
def test_cut_off_never_exceeds_the_largest(low, minutes, lag):
    high = low + timedelta(minutes=minutes)
    end = cdc.cut_off(low, high, NOON, cdc.CutOff(lag))
    assert end in (high, high - timedelta(minutes=lag))


def test_cut_off_rules():
    assert cdc.cut_off(None, None, NOON) is None
    assert cdc.cut_off(NOON, NOON + timedelta(seconds=59), NOON, cdc.CutOff(10)) == NOON + timedelta(seconds=59)
    assert cdc.cut_off(NOON - timedelta(days=1), NOON + timedelta(minutes=31), NOON, cdc.CutOff(10)) == NOON + timedelta(minutes=31)
    assert cdc.staging_cut_off("MIDNIGHT", NOON) == datetime(2023, 12, 31, 23, 59, 59, 999000)
    assert cdc.staging_cut_off("2024-02-03 04:05:06", NOON) == datetime(2024, 2, 3, 4, 5, 6)
    assert cdc.staging_cut_off("clock", NOON) == NOON


@pytest.mark.parametrize("low, high, unit, want", [(0, 10**6, 5e7, 1), (0, 10**7, 5e7, 10), (0, 10**8, 5e7, 8), (0, 10**9, 5e7, 80), (0, 10**10, 5e7, 100), (0, 3 * 10**7, 1e7, 12), ("a", "b", 5e7, 5)])
def test_partition_count(low, high, unit, want):
    assert cdc.partition_count(low, high, unit=unit) == want
    assert cdc.partition_count(low, high, 7) == 7


def test_consecutive_windows_take_each_row_once(spark):
    rows = spark.createDataFrame([(i, NOON + timedelta(hours=i)) for i in range(20)], "id long, at timestamp_ntz")
    spec = TableSpec("t", cdc_col="at")
    edge = [F.lit(NOON + timedelta(hours=h)).cast("timestamp_ntz") for h in (-1, 5, 11, 40)]
    got = [r.id for a, b in zip(edge, edge[1:]) for r in cdc.read_window(rows, spec, "ci", use_window=True, start=a, end=b).collect()]
    assert sorted(got) == list(range(20))


def test_nulls_and_sentinels(spark):
    rows = spark.createDataFrame([(1, None, None), (2, datetime(9999, 12, 31), NOON), (3, NOON, NOON)], "id int, a timestamp_ntz, b timestamp_ntz")
    c = cdc.cdc_column(TableSpec("t", cdc_col="coalesce(a, b)"))
    assert cdc.bounds(rows, c).first().asDict() == {"low": NOON, "high": NOON}
    assert [r.id for r in cdc.up_to(rows, c, cdc.bounds(rows, c), NOON).collect()] == [3]
    none = rows.where("id = 1")
    assert cdc.up_to(none, c, cdc.bounds(none, c), NOON).count() == 0


def test_stamps_at_year_end(spark):
    rows = spark.createDataFrame([(7, datetime(2024, 12, 30, 23, 59, 59, 999_000)), (8, datetime(1969, 12, 31, 23, 59, 59, 500_000))], "id long, at timestamp_ntz")
    got = [(r.ingestiondt, r.uniqueid, r.bucket) for r in stamp.with_bucket(stamp.with_month_and_uid(rows.withColumn("k", -F.col("id")), "at", "id"), "k").orderBy("id").collect()]
    assert got == [("2024-12-01", "17356031997", 3), ("1969-12-01", "-18", 2)]


def test_recon_statuses(spark):
    f = lambda *x: spark.createDataFrame(list(x), "auditentity string, value double")
    out = recon.reconciled(f(("a", 1.0), ("b", 2.0), ("c", None), ("d", 4.0)), f(("a", 1.0), ("b", 3.0), ("c", None), ("e", 5.0)), "s", "d", "x", "y")
    assert {r.auditentity: r.recon_status for r in out.collect()} == {"a": "success", "b": "failed", "c": "failed", "d": "missing", "e": "missing"}


def test_schema_drift_ignores_case(spark):
    old, new = (spark.createDataFrame([], s).schema for s in ("A int, b string, c string", "a bigint, B string, d string"))
    d = schema.drift(old, new)
    assert (d.added, d.removed, d.retyped) == (("d",), ("c",), (("a", "int", "bigint"),))
    assert schema.alter_statements("t", d, new) == ["ALTER TABLE t ADD COLUMNS (`d` string)"]


def test_dimensions_are_broadcast_by_rows_and_bytes(spark):
    from lakeforge.operators.lookup import sized

    df = spark.createDataFrame([(k, "x" * 100) for k in range(50)], "id long, text string")
    hinted = lambda x: "ResolvedHint (strategy=broadcast)" in x._jdf.queryExecution().analyzed().toString()
    assert hinted(sized(df, 50)) and not hinted(sized(df, 49)) and not hinted(sized(df, 50, 5000)) and hinted(sized(df.limit(0), 0, 0))
