"""Missing rows by checksums, distinct counts by bitmaps, numbers by ranges: results, and how much is shuffled or read."""
import random

import pytest
from pyspark.sql import functions as F

from lakeforge.operators import recon, reserve
from lakeforge.operators.recon import Metric


def shuffled(spark, run):
    """Rows that run() writes to shuffles."""
    tracker = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.jvm.java.util.ArrayList()
    quantiles = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)
    stages = lambda: {s.stageId(): s.shuffleWriteRecords() for s in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(tracker.stageList(none, False, False, quantiles, none))}
    last = max(stages(), default=-1)  # the store forgets its oldest stages, so only new ones are added up
    out = run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    return out, sum(n for k, n in stages().items() if k > last)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_missing_by_checksum(spark, kind):
    r = random.Random(1)
    source = [(k * 3 - 5000, f"v{k % 7}") for k in range(20_000)] + [(None, "x"), (None, "y"), (7 * 3 - 5000, "v0")]
    gone, stale = set(r.sample(range(20_000), 5)), set(r.sample(range(20_000), 5))
    target = [(k * 3 - 5000, "old" if k in stale else f"v{k % 7}") for k in range(20_000) if k not in gone] + [(None, "x"), (10**7, "only there")]
    a, b = (spark.createDataFrame([(None if i is None else i if kind == "long" else f"k{i}", v) for i, v in x], f"id {kind}, v string").repartition(6) for x in (source, target))
    for columns in (["id"], ["id", "v"]):
        want = rows_of(recon.missing_keys(a, b, columns))
        got, moved = shuffled(spark, lambda columns=columns: rows_of(recon.missing_by_checksum(a, b, columns, ranges=64, leaf=50)))
        assert got == want and 5 <= len(want) <= 11
    _, whole = shuffled(spark, lambda: rows_of(recon.missing_keys(a, b, ["id", "v"])))
    assert whole > 39_000  # of both sides, every row
    sums, _ = shuffled(spark, lambda: None)
    cached = a.cache(), b.cache()  # so that dealing the fixture isn't counted
    [x.count() for x in cached]
    _, moved = shuffled(spark, lambda: rows_of(recon.missing_by_checksum(a, b, ["id", "v"], ranges=64, leaf=50)))
    assert moved < 8_000
    [x.unpersist() for x in cached]


def test_missing_by_checksum_of_awkward_sides(spark):
    kind = "id long, v string"
    full, none = spark.createDataFrame([(k, "v") for k in range(100)] + [(-(2**63), "low"), (2**63 - 1, "high")], kind), spark.createDataFrame([], kind)
    for a, b in ((full, none), (none, full), (none, none), (full, full), (full, full.where("id % 2 = 0")), (full.where("id > 5"), full.where("id <= 5"))):
        for most in (1, 1000):
            assert rows_of(recon.missing_by_checksum(a, b, ["id", "v"], ranges=8, leaf=1, most=most)) == rows_of(recon.missing_keys(a, b, ["id", "v"]))
    assert rows_of(recon.missing_by_checksum(full, none, ["id"], F.col("id") < 3, ranges=8)) == rows_of(recon.missing_keys(full, none, ["id"], F.col("id") < 3))


def test_distinct_counts_by_bitmaps(spark):
    r = random.Random(2)
    rows = [(r.randrange(-50_000, 50_000) if r.random() < 0.9 else None, r.choice(["a", "b", None, ""]), r.choice([0.0, -0.0, 1.5, None]), r.randrange(100), k) for k in range(5000)]
    df = spark.createDataFrame(rows, "n long, s string, x double, day int, amount long")
    as_of = F.lit(60)
    wanted = [Metric("N", "distinct", "n", "day"), Metric("N2", "distinct", "n", "day", "s = 'a'"), Metric("SUM", "sum", "amount", "day"), Metric("S", "distinct", "s", "day"), Metric("X", "distinct", "x", "day")]
    live = [x for x in rows if x[3] <= 60]
    want = {"N": len({x[0] for x in live} - {None}), "N2": len({x[0] for x in live if x[1] == "a"} - {None}), "SUM": sum(x[4] for x in live), "S": 3, "X": 2}
    for specs in (wanted, wanted[:3], wanted[3:4], wanted[2:3]):
        out = recon.metrics(df, specs, as_of)
        assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert {r.auditentity: r.value for r in out.collect()} == {m.entity: float(want[m.entity]) for m in specs}
        assert {r.value for r in recon.metrics(df.limit(0), specs, as_of).collect()} == {0.0}
    out, moved = shuffled(spark, lambda: recon.metrics(df, wanted[:3], as_of).collect())
    assert moved < 100  # bitmaps, not values


def test_numbers_by_ranges(spark):
    r = random.Random(3)
    rows = [(k, "big" if k % 10 else r.choice("abc")) for k in range(4000)]
    r.shuffle(rows)
    new = spark.createDataFrame(rows, "k long, month string").repartition(5)
    old = spark.createDataFrame([(7,), (41,)], "row_id long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    out = reserve.numbered(new, old, [F.asc("k")], F.col("month"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted(out.collect(), key=lambda x: x.row_id)
    assert [(x.month, x.k) for x in got] == sorted((m, k) for k, m in rows) and [x.row_id for x in got] == list(range(42, 4042))
    tasks = out.where("month = 'big'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 2  # one month is numbered by several tasks
    assert reserve.numbered(new.limit(0), old, [F.asc("k")], F.col("month")).count() == 0
    assert reserve.numbered(new.limit(1), old.limit(0), [F.asc("k")], F.col("month")).first().row_id == 1
