"""Queries over the driver's tables: each applies a library operator, beside SQL for the same rows."""
from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.functions import xml_flatten, xml_groups
from lakeforge.operators import audit, cdc, lookup, merge, pii, recon, reserve, schema, stamp
from lakeforge.operators.joined import Edge, JoinSpec, joined
from lakeforge.plans import billing_queries, ingest, recon_suites, stream_queries  # noqa: F401
from lakeforge.plans.base import AS_OF, ORACLES, QUERIES, at, query, t  # noqa: F401
from lakeforge.sources import files, sinks
from lakeforge.sources.versioned import VersionedTable
from lakeforge.spec import LookupSpec, TableSpec, lookup_specs, table_specs
from lakeforge.streaming import audit_stream

LOW, HIGH, CLOCK = "1994-01-01 00:00:00", "1996-06-30 23:59:59.999", datetime(1998, 1, 1)
ORDERS = TableSpec("orders", cdc_col="o_orderdate", hard_delete_flag="id")
CUSTOMER_NATION = (
    LookupSpec("orders", "o_custkey", "c_custkey", "customer", (("c_name", "customer_name"), ("c_nationkey", "nation_key"))),
    LookupSpec("orders", "nation_key", "n_nationkey", "nation", (("n_name", "nation_name"), ("n_regionkey", "region_key"))),
)
EPOCH = "cast(floor(epoch({c})) AS BIGINT)"

# --- CDC windows -----------------------------------------------------------------------------------------------------


@query(f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate <= TIMESTAMP '{HIGH}'")
def cdc_window_tl(spark, d):
    return cdc.read_window(t(spark, d, "orders"), ORDERS, "tl", use_window=True, end=at(HIGH)).select("o_orderkey", "o_orderdate")


@query("SELECT o_orderkey, o_orderdate FROM orders")
def cdc_window_tl_all(spark, d):
    return cdc.read_window(t(spark, d, "orders"), ORDERS, "tl").select("o_orderkey", "o_orderdate")


@query(f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '{LOW}'")
def cdc_window_incr(spark, d):
    return cdc.read_window(t(spark, d, "orders"), ORDERS, "di", end=at(LOW)).select("o_orderkey", "o_orderdate")


@query(f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '{LOW}' AND o_orderdate <= TIMESTAMP '{HIGH}'")
def cdc_window_batch(spark, d):
    return cdc.read_window(t(spark, d, "orders"), ORDERS, "ci", use_window=True, start=at(LOW), end=at(HIGH)).select("o_orderkey", "o_orderdate")


@query(f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate > TIMESTAMP '{LOW}' AND o_orderdate <= TIMESTAMP '{HIGH}'")
def cdc_window_restart(spark, d):
    return cdc.read_window(t(spark, d, "orders"), ORDERS, "di", restart=True, start=at(LOW), end=at(HIGH)).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 1000")
def cdc_window_numeric(spark, d):
    return cdc.after_number(t(spark, d, "orders"), "o_orderkey", 1000).select("o_orderkey", "o_custkey")


@query("SELECT event_id, user_id FROM events WHERE event_id % 5 = 1")
def cdc_deletes_only(spark, d):
    changes = t(spark, d, "events").withColumn("__$operation", (F.col("event_id") % 5).cast("int"))
    return stamp.without_operational(cdc.deletes_only(changes)).select("event_id", "user_id")


CHANGED = "CASE WHEN l_linenumber = 1 THEN TIMESTAMP '9999-12-31 00:00:00' WHEN l_linenumber = 2 THEN NULL ELSE l_shipdate END"


@query(f"""
WITH x AS (SELECT l_orderkey, l_linenumber, l_shipdate, {CHANGED} AS changed FROM lineitem),
c AS (SELECT *, coalesce(changed, l_shipdate) AS cdc FROM x),
b AS (SELECT min(cdc) FILTER (year(cdc) < 9999) AS low, max(cdc) FILTER (year(cdc) < 9999) AS high FROM c),
e AS (SELECT CASE WHEN high - TIMESTAMP '1998-01-01' > INTERVAL 30 MINUTE OR high - low < INTERVAL 1 MINUTE THEN high ELSE high - INTERVAL 90 MINUTE END AS cut FROM b)
SELECT l_orderkey, l_linenumber, cdc FROM c, e WHERE cdc <= cut""")
def cdc_coalesce_cutoff(spark, d):
    rows = t(spark, d, "lineitem").withColumn("changed", F.expr(CHANGED.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")))
    c = cdc.cdc_column(TableSpec("lineitem", cdc_col="coalesce(changed, l_shipdate)"))
    out = cdc.up_to(rows, c, cdc.bounds(rows, c), CLOCK, cdc.CutOff(lag_minutes=90))
    return out.select("l_orderkey", "l_linenumber", c.alias("cdc"))


@query(f"SELECT min(CASE WHEN year(greatest(l_shipdate, {CHANGED})) < 9999 THEN greatest(l_shipdate, {CHANGED}) END) AS low, max(CASE WHEN year(greatest(l_shipdate, {CHANGED})) < 9999 THEN greatest(l_shipdate, {CHANGED}) END) AS high FROM lineitem")
def cdc_greatest_bounds(spark, d):
    rows = t(spark, d, "lineitem").withColumn("changed", F.expr(CHANGED.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")))
    return cdc.bounds(rows, cdc.cdc_column(TableSpec("lineitem", cdc_col="l_shipdate, changed")))


@query("SELECT min(o_orderkey) AS lower, max(o_orderkey) AS upper FROM orders")
def cdc_bounds_full(spark, d):
    """The ends of a full load's ranges, whatever the CDC columns."""
    spec = TableSpec("orders", cdc_col="coalesce(changed, o_orderdate)", partition_by="o_orderkey")
    return cdc.load_bounds(spec, "tl", t(spark, d, "orders"), t(spark, d, "lineitem"))


@query(f"""WITH lake AS (SELECT l_shipdate, CASE WHEN l_linenumber = 2 THEN l_shipdate + INTERVAL '9' DAY END AS changed, CAST(NULL AS TIMESTAMP) AS never FROM lineitem WHERE l_shipdate < TIMESTAMP '{HIGH}')
SELECT 'coalesce' AS kind, greatest(max(changed), max(l_shipdate)) AS upper FROM lake UNION ALL SELECT 'greatest', greatest(max(l_shipdate), max(never), max(changed)) FROM lake
UNION ALL SELECT 'timestamp', max(l_shipdate) FROM lake UNION ALL SELECT 'tl of several', greatest(max(l_shipdate), max(changed)) FROM lake""")
def cdc_bounds_lake(spark, d):
    """Where an incremental load goes on, by kind of CDC column."""
    lake = t(spark, d, "lineitem").where(F.col("l_shipdate") < at(HIGH)).withColumns({"changed": F.when(F.col("l_linenumber") == 2, F.col("l_shipdate") + F.expr("INTERVAL '9' DAY")), "never": F.lit(None).cast("timestamp_ntz")})
    kinds = (("coalesce", "coalesce(changed, l_shipdate)", "di"), ("greatest", "l_shipdate, never, changed", "di"), ("timestamp", "l_shipdate", "di"), ("tl of several", "l_shipdate,changed", "tl"))
    return recon.together([cdc.load_bounds(TableSpec("lineitem", cdc_col=c), load, t(spark, d, "orders"), lake).select(F.lit(kind).alias("kind"), "upper") for kind, c, load in kinds])


@query("SELECT c_custkey AS custkey, c_name AS customername, c_mktsegment AS segmentid FROM customer")
def project_plain_names(spark, d):
    """A reference list's columns without dots and spaces in their names."""
    return stamp.plain_names(t(spark, d, "customer").select(F.col("c_custkey").alias("cust key"), F.col("c_name").alias("customer.name"), F.col("c_mktsegment").alias(" segment. id")))


@query("SELECT max(ts) + INTERVAL 15 MINUTE AS clock FROM events")
def source_clock(spark, d):
    return cdc.source_clock(t(spark, d, "events"), "ts", 15)


COUNT = "CASE WHEN {h} - {l} <= 1000000 THEN 1 WHEN (({h} - {l}) // {u}) * 4 < 5 THEN 10 ELSE least((({h} - {l}) // {u}) * 4, 100) END"


def count_sql(name, key, unit, times):
    low, high = f"min({key}) * {times}", f"max({key}) * {times}"
    return f"SELECT '{name}' AS name, {low} AS low, {high} AS high, CAST({COUNT.format(h=f'({high})', l=f'({low})', u=unit)} AS INTEGER) AS partitions FROM {name}"


@query(" UNION ALL ".join([count_sql("orders", "o_orderkey", 50_000_000, 100_000), count_sql("customer", "c_custkey", 10_000_000, 100_000), count_sql("events", "event_id", 5_000_000, 1)]))
def partition_bounds(spark, d):
    def one(name, key, unit, times):
        b = t(spark, d, name).agg((F.min(key) * times).alias("low"), (F.max(key) * times).alias("high"))
        return b.select(F.lit(name).alias("name"), "low", "high", cdc.partition_count_column(F.col("low"), F.col("high"), unit=unit).alias("partitions"))

    return one("orders", "o_orderkey", 50_000_000, 100_000).union(one("customer", "c_custkey", 10_000_000, 100_000)).union(one("events", "event_id", 5_000_000, 1))


# --- stamps, lookups, PII --------------------------------------------------------------------------------------------


@query(f"""SELECT event_id, strftime(date_trunc('month', ts), '%Y-%m-%d') AS ingestiondt, {EPOCH.format(c='ts')}::VARCHAR || event_id::VARCHAR AS uniqueid,
'1700000000000' AS batch, ((user_id - 500) % 10 + 10) % 10 AS bucket FROM events""")
def stamp_month_uid_bucket(spark, d):
    rows = t(spark, d, "events").withColumn("k", F.col("user_id") - 500)
    rows = stamp.with_bucket(stamp.with_month_and_uid(stamp.with_batch(rows, "", "1700000000000"), "ts", "event_id"), "k")
    return rows.select("event_id", "ingestiondt", "uniqueid", "batch", "bucket")


@query("SELECT count(DISTINCT date_trunc('month', o_orderdate)) * 2 AS partitions FROM orders")
def write_partition_count(spark, d):
    return stamp.months_times_two(t(spark, d, "orders"), "o_orderdate")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def drop_operational_columns(spark, d):
    rows = t(spark, d, "customer").withColumns({"__$start_lsn": F.lit(1), "__$operation": F.lit(2)})
    return stamp.without_operational(rows).select("c_custkey", "c_name", "c_mktsegment")


@query("""SELECT o_orderkey, c_name AS customer_name, n_name AS nation_name, n_regionkey AS region_key
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def lookup_chain(spark, d):
    refs = {n: t(spark, d, n) for n in ("customer", "nation")}
    return lookup.lookup_chain(t(spark, d, "orders"), refs, list(CUSTOMER_NATION)).select("o_orderkey", "customer_name", "nation_name", "region_key")


@query("""SELECT c_custkey, n_name AS nation_name FROM customer LEFT JOIN (
SELECT * FROM (SELECT n_nationkey, n_name, n_regionkey, CASE WHEN n_nationkey % 7 = 0 THEN 1 END AS retired FROM nation) WHERE n_regionkey = 1 AND retired IS NULL) ON c_nationkey = n_nationkey""")
def lookup_conditional(spark, d):
    nation = t(spark, d, "nation").withColumn("retired", F.when(F.col("n_nationkey") % 7 == 0, 1))
    text = "table|source|ref|reftable|names|what\ncustomer|c_nationkey|n_nationkey|nation|nation_name|select n_name from nation where n_regionkey = 1 and retired is null"
    return lookup.lookup_chain(t(spark, d, "customer"), {"nation": nation}, lookup_specs(text)).select("c_custkey", "nation_name")


@query("""SELECT s_suppkey, a.n_name AS nation, a.n_regionkey AS region, b.n_name AS neighbour FROM supplier
LEFT JOIN nation a ON s_nationkey = a.n_nationkey LEFT JOIN nation b ON (s_nationkey + 20) = b.n_nationkey""")
def lookup_same_reference_twice(spark, d):
    rows = t(spark, d, "supplier").withColumn("next_key", F.col("s_nationkey") + 20)
    text = "table|source|ref|reftable|names|what\nsupplier|s_nationkey|n_nationkey|nation|nation/region|n_name/n_regionkey\nsupplier|next_key|n_nationkey|nation|neighbour|n_name"
    return lookup.lookup_chain(rows, {"nation": t(spark, d, "nation")}, lookup_specs(text)).select("s_suppkey", "nation", "region", "neighbour")


@query("""SELECT l_orderkey, l_linenumber, l_quantity, p_brand AS brand FROM lineitem LEFT JOIN (
SELECT p_partkey, min(p_brand) AS p_brand FROM (SELECT * FROM part UNION ALL SELECT p_partkey, p_name, 'zz', p_type, p_size, p_retailprice FROM part WHERE p_partkey % 2 = 0) GROUP BY 1) ON l_partkey = p_partkey""")
def lookup_repeated_dimension(spark, d):
    part = t(spark, d, "part")
    twice = part.unionByName(part.where("p_partkey % 2 = 0").withColumn("p_brand", F.lit("zz")))
    spec = LookupSpec("lineitem", "l_partkey", "p_partkey", "part", (("p_brand", "brand"),))
    return lookup.lookup(t(spark, d, "lineitem"), twice, spec).select("l_orderkey", "l_linenumber", "l_quantity", "brand")


TYPES = {"priority": ("orders", "o_orderpriority"), "segment": ("customer", "c_mktsegment"), "flag": ("lineitem", "l_returnflag"), "event": ("events", "event_type")}


def type_lists(spark, d):
    return {n: t(spark, d, table).select(F.col(c).alias("typecode")).distinct() for n, (table, c) in TYPES.items()}


TYPES_SQL = " UNION ALL ".join(f"SELECT DISTINCT {c} AS typecode, '{n}' AS typelistname FROM {x}" for n, (x, c) in TYPES.items())
OLD_SQL = f"SELECT * FROM ({TYPES_SQL}) WHERE NOT (typelistname = 'flag' AND typecode = 'R') AND NOT (typelistname = 'segment' AND typecode = 'BUILDING')"


@query(TYPES_SQL)
def typelist_consolidate(spark, d):
    return lookup.consolidated(type_lists(spark, d))


def old_lists(new):
    return new.where("NOT (typelistname = 'flag' AND typecode = 'R') AND NOT (typelistname = 'segment' AND typecode = 'BUILDING')")


@query(f"({TYPES_SQL}) EXCEPT ({OLD_SQL})")
def typelist_diff(spark, d):
    new = lookup.consolidated(type_lists(spark, d))
    return lookup.changed(new, old_lists(new))


@query(f"SELECT DISTINCT typelistname FROM (({TYPES_SQL}) EXCEPT ({OLD_SQL}))")
def typelist_changed(spark, d):
    new = lookup.consolidated(type_lists(spark, d))
    return lookup.changed_lists(new, old_lists(new))


@query("SELECT DISTINCT c_mktsegment AS typecode FROM customer")
def typelist_one(spark, d):
    return lookup.one_list(lookup.consolidated(type_lists(spark, d)), "segment")


@query("SELECT c_custkey, '' AS c_name, c_nationkey, '' AS c_acctbal FROM customer")
def pii_mask(spark, d):
    return pii.masked(t(spark, d, "customer"), ["C_NAME", "c_acctbal", "none"]).select("c_custkey", "c_name", "c_nationkey", "c_acctbal")


@query("SELECT count(*) AS n, count(DISTINCT c_name) AS secured_names, 1 AS masked_names FROM customer")
def pii_split(spark, d):
    secured, masked = pii.split(t(spark, d, "customer"), ["c_name"])
    a = secured.agg(F.count("*").alias("n"), F.countDistinct("c_name").alias("secured_names"))
    return a.join(masked.agg(F.countDistinct("c_name").cast("int").alias("masked_names")))


@query("SELECT c_custkey, '' AS c_name, c_mktsegment, '2' AS batch, (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0) AS sent FROM customer WHERE c_custkey % 2 = 0")
def masked_from_secured(spark, d):
    """The second batch's masked copy, from the secured table; a first run of the batch left rows that go."""
    base = sinks.scratch(spark)
    rows = t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", F.lit("2024-01-01").alias("ingestiondt"), F.when(F.col("c_custkey") % 2 == 0, "2").otherwise("1").alias("batch"))
    sinks.write_partitioned(rows, f"{base}/secured", ["ingestiondt", "batch"])
    sinks.write_partitioned(pii.masked(rows.where("batch = '2'").limit(5), ["c_name"]), f"{base}/masked", ["ingestiondt", "batch"])
    load = ingest.Load(TableSpec("customer"), "c_custkey", "di", "2", CLOCK, pii=("c_name",))
    sent, there = ingest.masked_from_secured(spark, f"{base}/secured", f"{base}/masked", load)
    out = spark.read.schema("c_custkey long, c_name string, c_mktsegment string, ingestiondt string, batch string").parquet(f"{base}/masked")
    return out.select("c_custkey", F.coalesce("c_name", F.lit("")).alias("c_name"), "c_mktsegment", "batch", F.lit(min(sent, there)).cast("long").alias("sent"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS secret_decrypted FROM customer")
def decrypt_case(spark, d):
    key = "0123456789abcdef"
    secret = F.when(F.col("c_custkey") % 3 == 1, F.base64(F.aes_encrypt("c_name", F.lit(key)))).when(F.col("c_custkey") % 3 == 2, F.base64(F.aes_encrypt("c_name", F.lit(key)))).when(F.col("c_custkey") % 2 == 0, "")
    return pii.decrypted(t(spark, d, "customer").withColumn("secret", secret), ["secret"], pii.aes(key)).select("c_custkey", "secret_decrypted")


@query(f"""SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ingestiondt, n_name AS nation_name, count(*) AS orders,
count(DISTINCT {EPOCH.format(c='o_orderdate')}::VARCHAR || o_orderkey::VARCHAR) AS uniqueids, CAST(round(sum(CAST(o_totalprice AS DECIMAL(20,2))), 2) AS DOUBLE) AS total, max('') AS customer_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderdate > TIMESTAMP '{LOW}' AND o_orderdate <= TIMESTAMP '{HIGH}' GROUP BY 1, 2""")
def cdc_pipeline(spark, d):
    load = ingest.Load(ORDERS, "o_orderkey", "ci", "1", CLOCK, start=at(LOW), end=at(HIGH), use_window=True, lookups=CUSTOMER_NATION, pii=("customer_name",))
    rows = ingest.harmonised(t(spark, d, "orders"), {n: t(spark, d, n) for n in ("customer", "nation")}, load)
    _, masked = ingest.secured_and_masked(rows, load)
    return masked.groupBy("ingestiondt", "nation_name").agg(
        F.count("*").alias("orders"), F.countDistinct("uniqueid").alias("uniqueids"), F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("double").alias("total"), F.max("customer_name").alias("customer_name")
    )


# --- loads, batch after batch ----------------------------------------------------------------------------------------

#: Two loads of orders: when the first one runs, the source has those before 1996; each ends 90 minutes before its last value.
TWO_LOADS = f"""first AS (SELECT max(o_orderdate) - INTERVAL 90 MINUTE AS cut FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
second AS (SELECT max(o_orderdate) - INTERVAL 90 MINUTE AS cut FROM orders),
loaded AS (SELECT o_orderkey, o_orderdate, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ingestiondt, CASE WHEN o_orderdate <= first.cut THEN '1001' ELSE '1002' END AS batch, {EPOCH.format(c='o_orderdate')}::VARCHAR || o_orderkey::VARCHAR AS uniqueid,
c_name AS customer_name, n_name AS nation_name FROM first, second, orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey WHERE o_orderdate <= second.cut)"""
LOADED_SQL = f"WITH {TWO_LOADS} SELECT o_orderkey, ingestiondt, batch, uniqueid, customer_name, nation_name FROM loaded"


def two_loads(spark, d, second_write=None):
    """(table, audit) after two loads of orders; the second one is written by second_write, where that is given, and then
    restarted."""
    path, log = sinks.scratch(spark), sinks.scratch(spark)
    path, log = f"{path}/table", f"{log}/audit"
    orders, refs = t(spark, d, "orders"), {n: t(spark, d, n) for n in ("customer", "nation")}
    load = lambda batch, day, **x: ingest.Load(TableSpec("orders", cdc_col="o_orderdate"), "o_orderkey", "ci", batch, datetime(2002, 1, day), lookups=CUSTOMER_NATION, rule=cdc.CutOff(lag_minutes=90), **x)
    ingest.load_next(spark, orders.where(F.col("o_orderdate") < at("1996-01-01 00:00:00")), refs, load("1001", 1), path, log)
    if second_write is None:
        ingest.load_next(spark, orders, refs, load("1002", 2), path, log)
    else:
        ingest.load_next(spark, orders, refs, load("1002", 2), path, log, write=second_write, retries=0)
        ingest.load_next(spark, orders, refs, load("1003", 3, restart=True), path, log)
    return path, log


def loaded(spark, path):
    rows = spark.read.parquet(path)
    return rows.select("o_orderkey", F.col("ingestiondt").cast("string").alias("ingestiondt"), F.col("batch").cast("string").alias("batch"), "uniqueid", "customer_name", "nation_name")


def half_written(df, path, by, mode, *, batch):
    """A write that loses every other order."""
    return 2 * sinks.counted_write(df.where("o_orderkey % 2 = 0"), path, by, mode, batch=batch)[0] + 1, 0


@query(LOADED_SQL)
def load_two_batches(spark, d):
    return loaded(spark, two_loads(spark, d)[0])


@query(LOADED_SQL)
def load_restart(spark, d):
    """The second load loses rows and fails; its restart takes the same window and batch, and repeats none."""
    return loaded(spark, two_loads(spark, d, half_written)[0])


@query(f"""WITH {TWO_LOADS}, ends AS (SELECT '1001' AS batch, TIMESTAMP '1900-01-01' AS start, cut FROM first UNION ALL SELECT '1002', first.cut, second.cut FROM first, second)
SELECT batch, 'success' AS loadstatus, start AS batchwindowstart, cut AS batchwindowend, count(o_orderkey) AS sourcecount, count(o_orderkey) AS targetcount FROM ends LEFT JOIN loaded USING (batch) GROUP BY ALL""")
def load_audit(spark, d):
    """What the audit says of both loads: windows that meet, and counts."""
    rows = ingest.audit_log(spark, two_loads(spark, d)[1])
    return rows.select("batch", "loadstatus", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("batchwindowstart", "batchwindowend")), "sourcecount", "targetcount")


# --- current state ---------------------------------------------------------------------------------------------------


@query("SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_per_key(spark, d):
    return merge.latest(t(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "ts", "event_type")


@query(f"""SELECT user_id, event_id, uniqueid, batch FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY uniqueid DESC, batch DESC) AS n FROM (
SELECT user_id, event_id, {EPOCH.format(c='ts')}::VARCHAR || event_id::VARCHAR AS uniqueid, (event_id % 13)::VARCHAR AS batch FROM events)) WHERE n = 1""")
def latest_array_order(spark, d):
    rows = stamp.with_month_and_uid(t(spark, d, "events"), "ts", "event_id").withColumn("batch", (F.col("event_id") % 13).cast("string"))
    return merge.most_recent(rows, ["user_id"]).select("user_id", "event_id", "uniqueid", "batch")


LAKE_SQL = "SELECT o_orderkey, o_totalprice, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ingestiondt, (100 + o_orderkey % 3)::VARCHAR AS batch, CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS deleted_flag FROM orders"


def lake_orders(spark, d):
    rows = t(spark, d, "orders").withColumns({"ingestiondt": stamp.month_of(F.col("o_orderdate")), "batch": (100 + F.col("o_orderkey") % 3).cast("string"), "deleted_flag": F.when(F.col("o_orderkey") % 11 == 0, 1).otherwise(0)})
    return rows.select("o_orderkey", "o_totalprice", "ingestiondt", "batch", "deleted_flag")


def source_orders(spark, d):
    return t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))


@query(f"SELECT o_orderkey, ingestiondt, batch FROM ({LAKE_SQL}) x WHERE deleted_flag = 0 AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def hard_delete_detect(spark, d):
    return merge.vanished(lake_orders(spark, d), source_orders(spark, d), "o_orderkey")


@query(f"SELECT o_orderkey, o_totalprice, '2024-02-01' AS ingestiondt, '999' AS batch, 1 AS deleted_flag FROM ({LAKE_SQL}) x WHERE deleted_flag = 0 AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def hard_delete_tombstone(spark, d):
    return merge.tombstones(lake_orders(spark, d), source_orders(spark, d), "o_orderkey", "2024-02-01", "999")


@query("SELECT o_orderkey, o_orderstatus, 0 AS deleted_flag FROM orders UNION ALL SELECT o_orderkey, NULL, 1 FROM orders WHERE o_orderkey % 4 = 0")
def cdc_union_flag(spark, d):
    orders = t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return merge.with_deleted_flag(orders, orders.where("o_orderkey % 4 = 0").select("o_orderkey"))


@query(f"SELECT o_orderkey, batch FROM ({LAKE_SQL}) WHERE deleted_flag = 0")
def live_rows(spark, d):
    return merge.live_only(lake_orders(spark, d)).select("o_orderkey", "batch")


DELTA_SQL = "SELECT o_orderkey + CASE WHEN o_orderkey % 10 = 0 THEN 10000000 ELSE 0 END AS o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderkey % 5 = 0"


def base_and_delta(spark, d):
    base = t(spark, d, "orders").select("o_orderkey", "o_totalprice")
    moved = F.col("o_orderkey") + F.when(F.col("o_orderkey") % 10 == 0, 10_000_000).otherwise(0)
    return base, base.where("o_orderkey % 5 = 0").select(moved.alias("o_orderkey"), (F.col("o_totalprice") * 2).alias("o_totalprice"))


@query(f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({DELTA_SQL})) UNION ALL {DELTA_SQL}")
def upsert_stage(spark, d):
    return merge.upserted(*base_and_delta(spark, d), "o_orderkey")


@query(f"SELECT * FROM (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({DELTA_SQL})) UNION ALL {DELTA_SQL}) WHERE o_orderkey % 7 <> 0")
def upsert_with_deletes(spark, d):
    base, delta = base_and_delta(spark, d)
    gone = base.union(delta).where("o_orderkey % 7 = 0").select("o_orderkey")
    return merge.upserted(base, delta, "o_orderkey", gone)


@query("""SELECT DISTINCT ingestiondt FROM (SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ingestiondt FROM orders WHERE o_orderkey % 5 = 2
UNION ALL SELECT '2030-01-01' FROM orders WHERE o_orderkey % 5 = 2)""")
def upsert_touched_partitions(spark, d):
    base = t(spark, d, "orders").select("o_orderkey", stamp.month_of(F.col("o_orderdate")).alias("ingestiondt"))
    return merge.touched_partitions(base, base.where("o_orderkey % 5 = 2").withColumn("ingestiondt", F.lit("2030-01-01")), "o_orderkey", "ingestiondt")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, batch, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY batch DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS n
FROM (SELECT *, l_suppkey % 4 AS batch FROM lineitem)) WHERE n = 1""")
def dedupe_max_batch(spark, d):
    rows = t(spark, d, "lineitem").withColumn("batch", F.col("l_suppkey") % 4)
    order = [F.desc(c) for c in ("batch", "l_partkey", "l_suppkey", "l_quantity")]
    return merge.without_duplicates(rows, ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "batch", "l_quantity")


@query("SELECT l_orderkey, count(*) AS n, max(l_suppkey % 4) AS last_batch FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, d):
    return merge.duplicates(t(spark, d, "lineitem").withColumn("batch", F.col("l_suppkey") % 4), "l_orderkey")


@query(f"SELECT o_orderkey, o_totalprice, ingestiondt, '777' AS batch, o_orderkey % 10 AS bucket FROM ({LAKE_SQL}) WHERE deleted_flag = 0")
def stage_full_load(spark, d):
    return merge.staged(lake_orders(spark, d), "o_orderkey", "2024-01-01", "777").select("o_orderkey", "o_totalprice", "ingestiondt", "batch", "bucket")


@query("SELECT event_id, batch FROM (SELECT event_id, (event_id % 4)::VARCHAR AS batch, CASE WHEN event_id % 4 < 3 THEN 'tl' ELSE 'di' END AS load_type FROM events) WHERE batch = '2'")
def stage_seed_last_full(spark, d):
    rows = t(spark, d, "events").withColumn("batch", (F.col("event_id") % 4).cast("string")).withColumn("load_type", F.when(F.col("batch") < "3", "tl").otherwise("di"))
    return merge.seeded(rows, "user_id", "last_full").select("event_id", "batch")


@query("""SELECT kv_key, price, shipped FROM (SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS kv_key, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped,
row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_linenumber DESC, l_orderkey DESC, CAST(l_extendedprice AS DECIMAL(18,2)) DESC) AS n FROM lineitem) WHERE n = 1""")
def kv_projection(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), F.col("l_shipdate").alias("shipped"))
    return merge.kv_items(rows, ["l_orderkey", "l_linenumber"], "shipped").select("kv_key", "price", "shipped")


# --- missing rows, histories -----------------------------------------------------------------------------------------


@query("SELECT o_orderkey FROM orders WHERE o_orderkey <= (SELECT max(l_orderkey) FROM lineitem) EXCEPT SELECT l_orderkey FROM lineitem")
def missing_rows(spark, d):
    return recon.missing_keys(t(spark, d, "orders"), t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"], F.col("o_orderkey") <= t(spark, d, "lineitem").agg(F.max("l_orderkey")).first()[0])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey <= (SELECT max(l_orderkey) FROM lineitem) EXCEPT SELECT l_orderkey FROM lineitem")
def missing_rows_by_checksum(spark, d):
    """missing_rows, by ranges whose checksums differ; the lake has each key once, as source and lake mostly agree."""
    lake = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return recon.missing_by_checksum(t(spark, d, "orders"), lake, ["o_orderkey"], F.col("o_orderkey") <= lake.agg(F.max("o_orderkey")).first()[0])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber <= 2)")
def missing_live_rows(spark, d):
    """Missing rows of a table whose spec looks at live rows alone."""
    load = ingest.Load(replace(ORDERS, missing_where="o_orderstatus <> 'P'"), "o_orderkey", "di", "1", CLOCK)
    lake = t(spark, d, "lineitem").where("l_linenumber <= 2").select(F.col("l_orderkey").alias("o_orderkey"))
    return ingest.missing_rows(t(spark, d, "orders"), lake, {}, load, by_checksum=True).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 997 = 0")
def missing_stale_rows_by_checksum(spark, d):
    orders = t(spark, d, "orders")
    lake = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 997 == 0, F.col("o_orderdate") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("o_orderdate")))
    return recon.missing_by_checksum(orders, lake, ["o_orderkey", "o_orderdate"], leaf=100)


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 9 = 0")
def missing_stale_rows(spark, d):
    orders = t(spark, d, "orders")
    lake = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 9 == 0, F.col("o_orderdate") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("o_orderdate")))
    return recon.missing_keys(orders, lake, ["o_orderkey", "o_orderdate"])


@query("SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem ORDER BY 1 LIMIT 500")
def missing_report(spark, d):
    keys = recon.missing_keys(t(spark, d, "orders"), t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])
    return recon.first_missing(keys, "o_orderkey", 500)


@query(f"""SELECT o_orderkey, o_totalprice, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS ingestiondt, '55' AS batch, {EPOCH.format(c='o_orderdate')}::VARCHAR || o_orderkey::VARCHAR AS uniqueid, c_name AS customer_name, n_name AS nation_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def missing_reload(spark, d):
    load = ingest.Load(ORDERS, "o_orderkey", "di", "55", CLOCK, lookups=CUSTOMER_NATION)
    rows = ingest.missing_rows(t(spark, d, "orders"), source_orders(spark, d), {n: t(spark, d, n) for n in ("customer", "nation")}, load)
    return rows.select("o_orderkey", "o_totalprice", "ingestiondt", "batch", "uniqueid", "customer_name", "nation_name")


@query("SELECT DISTINCT event_type AS tablename, (user_id % 7)::VARCHAR AS missingdatabatch FROM events EXCEPT SELECT event_type, (user_id % 5)::VARCHAR FROM events WHERE event_id % 2 = 0")
def missing_batches(spark, d):
    rows = lambda n: t(spark, d, "events").select(F.col("event_type").alias("tablename"), (F.col("user_id") % n).cast("string").alias("missingdatabatch"), "event_id")
    return recon.batches_to_load(rows(7), rows(5).where("event_id % 2 = 0"))


def part_tsv(spark, d) -> str:
    """part as tab-delimited lines without a header; every 50th has a key that isn't a number."""
    path = sinks.scratch(spark)
    key = F.when(F.col("p_partkey") % 50 == 0, F.concat(F.lit("x"), F.col("p_partkey"))).otherwise(F.col("p_partkey").cast("string"))
    t(spark, d, "part").select(key, "p_name", "p_brand", F.col("p_size").cast("string"), F.lit("202312")).write.mode("overwrite").csv(path, sep="\t")
    return path


@query("SELECT p_partkey, p_name, p_brand, p_size, '2023-12-01' AS ingestiondt, 'h1' AS batch FROM part WHERE p_partkey % 50 <> 0")
def history_load(spark, d):
    raw = files.tsv(spark, part_tsv(spark, d), "a string, b string, c string, d string, e string")
    target = t(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size", F.lit(1).alias("yyyymm"))
    return ingest.history(raw, target, "yyyymm", "h1").select("p_partkey", "p_name", "p_brand", "p_size", "ingestiondt", "batch")


@query("SELECT 'x' || p_partkey::VARCHAR AS p_partkey FROM part WHERE p_partkey % 50 = 0")
def rejected_ids(spark, d):
    raw = files.tsv(spark, part_tsv(spark, d), "p_partkey string, b string, c string, d string, e string")
    loaded = raw.select(F.expr("cast(try_cast(p_partkey AS BIGINT) AS STRING)").alias("p_partkey"))
    return files.rejected(raw, loaded, "p_partkey")


# --- audit -----------------------------------------------------------------------------------------------------------

AUDIT_SQL = """SELECT '2024-01-' || lpad((1 + event_id % 9)::VARCHAR, 2, '0') AS ingestiondt, (1000 + event_id % 400)::VARCHAR AS batch, 't' || (user_id % 40)::VARCHAR AS tablename,
CASE event_type WHEN (SELECT min(event_type) FROM events) THEN 'failed' WHEN (SELECT max(event_type) FROM events) THEN 'failedUnknown' ELSE 'success' END AS loadstatus,
CASE WHEN user_id % 40 < 10 THEN (event_id % 5000)::VARCHAR ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS batchwindowstart,
CASE WHEN event_id % 17 = 0 THEN 'null' WHEN event_id % 19 = 0 THEN NULL WHEN user_id % 40 < 10 THEN (event_id % 7000)::VARCHAR ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS batchwindowend,
CASE WHEN event_id % 23 = 0 THEN 'y' ELSE 'n' END AS harddeletebatch, strftime(ts, '%Y-%m-%d %H:%M:%S') AS loadendtime, 'p' || (event_id % 2)::VARCHAR AS processname, event_id FROM events"""


def audit_rows(spark, d):
    e = t(spark, d, "events")
    ends = e.agg(F.min("event_type").alias("a"), F.max("event_type").alias("z"))
    s = lambda c: c.cast("string")
    when = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    n, u = F.col("event_id"), F.col("user_id") % 40
    return e.join(F.broadcast(ends)).select(
        F.concat(F.lit("2024-01-"), F.lpad(s(1 + n % 9), 2, "0")).alias("ingestiondt"), s(1000 + n % 400).alias("batch"), F.concat(F.lit("t"), s(u)).alias("tablename"),
        F.when(F.col("event_type") == F.col("a"), "failed").when(F.col("event_type") == F.col("z"), "failedUnknown").otherwise("success").alias("loadstatus"),
        F.when(u < 10, s(n % 5000)).otherwise(when).alias("batchwindowstart"),
        F.when(n % 17 == 0, "null").when(n % 19 == 0, F.lit(None)).when(u < 10, s(n % 7000)).otherwise(when).alias("batchwindowend"),
        F.when(n % 23 == 0, "y").otherwise("n").alias("harddeletebatch"), when.alias("loadendtime"), F.concat(F.lit("p"), s(n % 2)).alias("processname"), "event_id",
    )


def mark_sql(c):
    m = f"max(CASE WHEN regexp_full_match({c}, '\\d+') THEN lpad({c}, 15, '0') ELSE {c} END)"
    return f"CASE WHEN regexp_full_match({m}, '\\d+') THEN coalesce(nullif(ltrim({m}, '0'), ''), '0') ELSE {m} END AS {c}"


@query(f"""SELECT tablename, max(ingestiondt) AS ingestiondt, {mark_sql('batch')}, {mark_sql('batchwindowstart')}, {mark_sql('batchwindowend')} FROM ({AUDIT_SQL})
WHERE harddeletebatch <> 'y' AND loadstatus <> 'failedUnknown' AND batchwindowend <> 'null' AND processname = 'p1' GROUP BY 1""")
def audit_watermark(spark, d):
    return audit.watermarks(audit_rows(spark, d), "p1")


@query(f"SELECT cast(max(cast(batch AS BIGINT)) AS VARCHAR) AS batch FROM ({AUDIT_SQL}) WHERE tablename LIKE '%7'")
def audit_last_batch_like(spark, d):
    return audit.last_batch_like(audit_rows(spark, d), "%7")


@query(ORACLES["audit_watermark"])
def stream_watermarks(spark, d):
    return stream_queries.stream_watermarks_of(spark, audit_rows(spark, d).where("processname = 'p1'").drop("event_id"))


@query(f"SELECT DISTINCT tablename FROM ({AUDIT_SQL}) WHERE loadstatus = 'failed' AND ingestiondt = '2024-01-09'")
def audit_failed_tables(spark, d):
    return audit.failed_tables(audit_rows(spark, d))


TABLES_SQL = f"SELECT DISTINCT tablename FROM ({AUDIT_SQL})"


@query(f"SELECT tablename FROM ({TABLES_SQL}) WHERE tablename NOT IN (SELECT tablename FROM ({AUDIT_SQL}) WHERE batch = (SELECT max(batch) FROM ({AUDIT_SQL})))")
def restart_remaining_tables(spark, d):
    rows = audit_rows(spark, d)
    return audit.tables_to_run(rows.select("tablename").distinct(), rows, True, "batch")


@query(f"SELECT DISTINCT tablename FROM ({AUDIT_SQL}) WHERE loadstatus = 'failed' AND ingestiondt = '2024-01-09'")
def restart_failed_tables(spark, d):
    rows = audit_rows(spark, d)
    return audit.tables_to_run(rows.select("tablename").distinct(), rows, True, "table")


@query(f"""SELECT tablename, batch, loadendtime, loadstatus FROM (SELECT *, row_number() OVER (PARTITION BY tablename ORDER BY batch DESC, loadendtime DESC, loadstatus DESC) AS n FROM ({AUDIT_SQL})) WHERE n = 1""")
def audit_latest(spark, d):
    return audit.latest_by_table(audit_rows(spark, d)).select("tablename", "batch", "loadendtime", "loadstatus")


@query(f"""SELECT count(*) FILTER (loadstatus <> 'success') AS blocked FROM (SELECT *, row_number() OVER (PARTITION BY tablename ORDER BY batch DESC, loadendtime DESC, loadstatus DESC) AS n FROM ({AUDIT_SQL}))
WHERE n = 1 AND batch = (SELECT max(batch) FROM ({AUDIT_SQL}))""")
def pre_delete_gate(spark, d):
    return audit.delete_gate(audit_rows(spark, d))


@query(f"""WITH a AS (SELECT tablename, loadendtime, loadstatus, event_id % 400 AS batch FROM ({AUDIT_SQL}))
SELECT count(*) FILTER (loadstatus <> 'success') AS blocked FROM (SELECT *, row_number() OVER (PARTITION BY tablename ORDER BY batch DESC, loadendtime DESC, loadstatus DESC) AS n FROM a) WHERE n = 1 AND batch = (SELECT max(batch) FROM a)""")
def pre_delete_gate_lengths(spark, d):
    """Batches of one to three digits: 399 is the last, not 99."""
    return audit.delete_gate(audit_rows(spark, d).withColumn("batch", (F.col("event_id") % 400).cast("string")))


@query(f"SELECT event_id, batchwindowend FROM ({AUDIT_SQL}) WHERE batchwindowend IS NOT NULL")
def audit_loggable(spark, d):
    return audit.loggable(audit_rows(spark, d)).select("event_id", "batchwindowend")


@query(f"SELECT processname, ingestiondt, batch, min(loadendtime) AS batchstarttime, min(batchwindowstart) AS batchwindowstart, max(batchwindowend) AS batchwindowend, max(harddeletebatch) AS harddeletebatch FROM ({AUDIT_SQL}) GROUP BY 1, 2, 3")
def audit_batch_stats(spark, d):
    return audit.batch_stats(audit_rows(spark, d).withColumn("batchstarttime", F.col("loadendtime")))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_audit(spark, d):
    return t(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query(f"SELECT tablename, batch, loadstatus, count(*) AS n FROM ({AUDIT_SQL}) GROUP BY 1, 2, 3")
def stream_audit_parity(spark, d):
    """Audit rows through JSON, a stream and its sink, read back."""
    base = sinks.scratch(spark)
    rows = audit_rows(spark, d).drop("event_id")
    audit_stream.to_events(rows).select("value").write.mode("overwrite").text(f"{base}/in")
    events = audit_stream.audit_events(audit_stream.text_stream(spark, f"{base}/in"))
    audit_stream.append_stream(events, f"{base}/out", f"{base}/state", ["ingestiondt"]).awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("tablename", "batch", "loadstatus").agg(F.count("*").alias("n"))


# --- reconciliation --------------------------------------------------------------------------------------------------

DEC = lambda c: f"CAST({c} AS DECIMAL(20,2))"
ONE = lambda entity, value, rest: f"SELECT '{entity}' AS auditentity, CAST({value} AS DOUBLE) AS value FROM {rest}"
DISTINCT_SQL = ONE("ORDERS_OPEN", "count(DISTINCT o_custkey)", f"orders WHERE o_orderdate <= TIMESTAMP '{AS_OF}' AND o_orderstatus = 'O'")
SUM_SQL = ONE("ORDERS_TOTAL", f"coalesce(sum({DEC('o_totalprice')}), 0)", f"orders WHERE o_orderdate <= TIMESTAMP '{AS_OF}'")
MTD_SQL = ONE("MTD_TOTAL", f"coalesce(sum({DEC('o_totalprice')}), 0)", f"orders WHERE o_orderdate <= TIMESTAMP '{AS_OF}' AND o_orderdate >= TIMESTAMP '1996-06-01'")
YTD_SQL = ONE("YTD_TOTAL", f"coalesce(sum({DEC('o_totalprice')}), 0)", f"orders WHERE o_orderdate <= TIMESTAMP '{AS_OF}' AND o_orderdate >= TIMESTAMP '1996-01-01'")


def source_metrics(spark, d):
    o = t(spark, d, "orders")
    return [
        recon.as_of_distinct(o, "ORDERS_OPEN", "o_custkey", "o_orderdate", at(AS_OF), F.col("o_orderstatus") == "O"),
        recon.as_of_sum(o, "ORDERS_TOTAL", "o_totalprice", "o_orderdate", at(AS_OF)),
        recon.month_to_date(o, "MTD_TOTAL", "o_totalprice", "o_orderdate", at(AS_OF)),
        recon.year_to_date(o, "YTD_TOTAL", "o_totalprice", "o_orderdate", at(AS_OF)),
    ]


@query(DISTINCT_SQL)
def recon_asof_distinct(spark, d):
    return source_metrics(spark, d)[0]


@query(SUM_SQL)
def recon_asof_sum(spark, d):
    return source_metrics(spark, d)[1]


@query(MTD_SQL)
def recon_mtd(spark, d):
    return source_metrics(spark, d)[2]


@query(YTD_SQL)
def recon_ytd(spark, d):
    return source_metrics(spark, d)[3]


CUSTOMERS_SQL = ONE("CUSTOMERS", "count(DISTINCT o_custkey)", f"orders WHERE o_orderdate <= TIMESTAMP '{AS_OF}'")


@query(f"{DISTINCT_SQL} UNION ALL {CUSTOMERS_SQL} UNION ALL {SUM_SQL} UNION ALL {MTD_SQL} UNION ALL {YTD_SQL}")
def recon_metrics_one_scan(spark, d):
    m = [recon.Metric(*x, "o_orderdate") for x in (("CUSTOMERS", "distinct", "o_custkey"), ("ORDERS_TOTAL", "sum", "o_totalprice"), ("MTD_TOTAL", "mtd", "o_totalprice"), ("YTD_TOTAL", "ytd", "o_totalprice"))]
    return recon.metrics(t(spark, d, "orders"), [*m, recon.Metric("ORDERS_OPEN", "distinct", "o_custkey", "o_orderdate", "o_orderstatus = 'O'")], at(AS_OF))


@query(f"{DISTINCT_SQL} UNION ALL {SUM_SQL} UNION ALL {MTD_SQL} UNION ALL {YTD_SQL} UNION ALL {MTD_SQL}")
def recon_union_all(spark, d):
    m = source_metrics(spark, d)
    return recon.together([*m, m[2]])


@query(f"{DISTINCT_SQL} UNION {SUM_SQL} UNION {MTD_SQL} UNION {YTD_SQL} UNION {MTD_SQL}")
def recon_union(spark, d):
    m = source_metrics(spark, d)
    return recon.together([*m, m[2]], distinct=True)


@query("SELECT 'NULL_FORM' AS auditentity, CAST(NULL AS DOUBLE) AS value UNION ALL SELECT 'ZERO_FORM', 0.0")
def recon_empty_sums(spark, d):
    o, never = t(spark, d, "orders"), at("1900-01-01 00:00:00")
    return recon.together([recon.as_of_sum(o, "NULL_FORM", "o_totalprice", "o_orderdate", never, empty_is_zero=False), recon.as_of_sum(o, "ZERO_FORM", "o_totalprice", "o_orderdate", never)])


@query(f"""WITH s AS ({DISTINCT_SQL} UNION ALL {SUM_SQL} UNION ALL {MTD_SQL}), l AS ({DISTINCT_SQL} UNION ALL {YTD_SQL} UNION ALL SELECT 'MTD_TOTAL', -1.0)
SELECT '1996-06-15' AS extractdate, auditentity, '1900-01-01' AS auditfrom, '{AS_OF}' AS auditthru, s.value AS src_value, 'SYS' AS source_system_cd, l.value AS lake_value,
CASE WHEN s.auditentity IS NULL OR l.auditentity IS NULL THEN 'missing' WHEN s.value = l.value THEN 'success' ELSE 'failed' END AS recon_status FROM s FULL JOIN l USING (auditentity)""")
def recon_status(spark, d):
    m = source_metrics(spark, d)
    lake = recon.together([m[0], m[3], recon.metric(t(spark, d, "region"), "MTD_TOTAL", F.max(F.lit(-1)))])
    return recon.reconciled(recon.together(m[:3]), lake, "SYS", "1996-06-15", "1900-01-01", AS_OF)


@query(f"""SELECT n_name AS nation, CAST(sum({DEC('l_extendedprice')}) AS DOUBLE) AS value, count(DISTINCT o_orderkey) AS orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 LEFT JOIN nation ON c_nationkey = n_nationkey WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '{AS_OF}' AND l_returnflag IN ('A', 'R') AND l_linestatus <> 'X' GROUP BY 1""")
def recon_star(spark, d):
    star = JoinSpec("l", "lineitem", (Edge("o", "orders", "o_orderkey", "l.l_orderkey", needed=True), Edge("c", "customer", "c_custkey", "o.o_custkey", "left", where="c_acctbal > 0", needed=True), Edge("n", "nation", "n_nationkey", "c.c_nationkey", "left", needed=True)))
    rows = joined(star, {x: t(spark, d, x) for x in star.tables()})
    rows = rows.where(F.col("o_orderdate").between(at("1995-01-01 00:00:00"), at(AS_OF)) & F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") != "X"))
    return rows.groupBy(F.col("n_name").alias("nation")).agg(F.sum(F.col("l_extendedprice").cast("decimal(20,2)")).cast("double").alias("value"), F.countDistinct("o_orderkey").alias("orders"))


@query(f"""SELECT CAST(sum({DEC('o_totalprice')}) AS DOUBLE) AS value, count(*) AS orders FROM orders JOIN (SELECT TIMESTAMP '{AS_OF}' AS as_of) ON 1 = 1 WHERE o_orderdate <= as_of""")
def recon_constant_join(spark, d):
    one = t(spark, d, "region").agg(F.max(at(AS_OF)).alias("as_of"))
    rows = t(spark, d, "orders").join(F.broadcast(one), F.col("o_orderdate") <= F.col("as_of"))
    return rows.agg(F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("double").alias("value"), F.count("*").alias("orders"))


@query("""SELECT o_orderkey, shipped FROM orders LEFT JOIN (SELECT coalesce(l_orderkey, -1) AS k, max(CASE WHEN l_returnflag = 'R' THEN l_shipdate ELSE NULL END) AS shipped FROM lineitem GROUP BY 1) ON o_orderkey = k""")
def recon_case_max(spark, d):
    last = recon.greatest_case(t(spark, d, "lineitem"), ["l_orderkey"], [(F.col("l_returnflag") == "R", F.col("l_shipdate"))], name="shipped")
    return t(spark, d, "orders").join(last, F.col("o_orderkey") == F.col("key"), "left").select("o_orderkey", "shipped")


# --- schemas, sinks, XML, reserves -----------------------------------------------------------------------------------


@query("""SELECT 'c_mail' AS name, 'added' AS change, CAST(NULL AS VARCHAR) AS old_type, CAST(NULL AS VARCHAR) AS new_type, count(*) AS n_rows FROM customer
UNION ALL SELECT 'c_nationkey', 'removed', NULL, NULL, count(c_nationkey) FROM customer UNION ALL SELECT 'c_acctbal', 'retyped', 'double', 'string', 0
UNION ALL SELECT 'c_mktsegment', 'retyped', 'string', 'int', count(c_mktsegment) FROM customer""")
def schema_drift(spark, d):
    """What changes, and for how many rows that loses or lacks a value."""
    old = t(spark, d, "customer")
    new = old.drop("c_nationkey").withColumns({"C_ACCTBAL": F.col("c_acctbal").cast("string"), "c_mail": F.lit(""), "c_mktsegment": F.lit(1)}).withColumnRenamed("c_name", "C_NAME")
    return schema.drift_report(old, new.schema)


@query("SELECT c_custkey, c_name, c_acctbal, CAST(NULL AS VARCHAR) AS c_mail FROM customer")
def schema_evolve(spark, d):
    rows = t(spark, d, "customer")
    target = rows.select("c_custkey", "c_name", "c_acctbal").withColumn("c_mail", F.lit("")).schema
    return schema.evolved(rows.withColumn("c_acctbal", F.col("c_acctbal").cast("string")), target)


def lake_path(spark, d) -> str:
    path = sinks.scratch(spark)
    sinks.write_partitioned(lake_orders(spark, d).repartition("ingestiondt"), path, ["ingestiondt"], "overwrite")
    return path


@query(f"SELECT o_orderkey, o_totalprice, ingestiondt, batch, deleted_flag FROM ({LAKE_SQL})")
def sink_partitioned(spark, d):
    return spark.read.parquet(lake_path(spark, d)).select("o_orderkey", "o_totalprice", F.col("ingestiondt").cast("string").alias("ingestiondt"), F.col("batch").cast("string").alias("batch"), "deleted_flag")


@query(f"SELECT o_orderkey, CASE WHEN ingestiondt = '1995-03-01' THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM ({LAKE_SQL})")
def sink_dynamic_overwrite(spark, d):
    path = lake_path(spark, d)
    month = lake_orders(spark, d).where("ingestiondt = '1995-03-01'").withColumn("o_totalprice", F.lit(0.0))
    sinks.write_partitioned(month, path, ["ingestiondt"], "overwrite", dynamic=True)
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice")


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 2 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM ({LAKE_SQL}) WHERE o_orderkey % 5 <> 3")
def sink_upsert(spark, d):
    path, rows = lake_path(spark, d), lake_orders(spark, d)
    delta = rows.where("o_orderkey % 5 = 2").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    sinks.upsert_partitions(spark, path, delta, "o_orderkey", "ingestiondt", deleted=rows.where("o_orderkey % 5 = 3"))
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice")


@query(f"SELECT o_orderkey, CASE WHEN ingestiondt = '1995-04-01' THEN '1995-05-01' ELSE ingestiondt END AS ingestiondt FROM ({LAKE_SQL}) WHERE ingestiondt <> '1995-03-01'")
def sink_upsert_emptied(spark, d):
    """One month's rows are all deleted and another's all move: both partitions end."""
    path, rows = lake_path(spark, d), lake_orders(spark, d)
    moved = rows.where("ingestiondt = '1995-04-01'").withColumn("ingestiondt", F.lit("1995-05-01"))
    sinks.upsert_partitions(spark, path, moved, "o_orderkey", "ingestiondt", deleted=rows.where("ingestiondt = '1995-03-01'"))
    return spark.read.parquet(path).select("o_orderkey", F.col("ingestiondt").cast("string").alias("ingestiondt"))


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 2 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, ingestiondt FROM ({LAKE_SQL}) WHERE o_orderkey % 5 <> 3
UNION ALL SELECT o_orderkey + 10000000, o_totalprice, ingestiondt FROM ({LAKE_SQL}) WHERE o_orderkey % 5 = 4""")
def sink_upsert_files(spark, d):
    """Changed, deleted and new keys in a table with versions; the month before the last version is still there to read."""
    rows = lake_orders(spark, d)
    made = VersionedTable(spark, sinks.scratch(spark), "o_orderkey", ("ingestiondt",))
    made.overwrite(rows)
    delta = rows.where("o_orderkey % 5 = 2").withColumn("o_totalprice", F.col("o_totalprice") + 1).unionByName(rows.where("o_orderkey % 5 = 4").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000))
    made.upsert(delta, rows.where("o_orderkey % 5 = 3"))
    return made.read().select("o_orderkey", "o_totalprice", F.col("ingestiondt").cast("string").alias("ingestiondt"))


@query("SELECT count(*) AS sent, count(*) AS there FROM orders")
def sink_count_check(spark, d):
    sent, there = sinks.counted_write(lake_orders(spark, d), sinks.scratch(spark), ["ingestiondt", "batch"], "overwrite")
    return spark.createDataFrame([(sent, there)], "sent long, there long")


@query("SELECT c_custkey, c_name FROM customer")
def sink_promote_restore(spark, d):
    """A table replaced by a new copy and restored from its backup."""
    base = sinks.scratch(spark)
    rows = t(spark, d, "customer").select("c_custkey", "c_name")
    rows.write.parquet(f"{base}/main")
    rows.withColumn("c_name", F.lit("new")).write.parquet(f"{base}/temp")
    sinks.promote(spark, f"{base}/temp", f"{base}/main", f"{base}/backup")
    sinks.promote(spark, f"{base}/backup", f"{base}/main", f"{base}/undone")
    return spark.read.parquet(f"{base}/main")


@query("SELECT 'customer.parquet' AS file, count(*) AS n FROM customer")
def parquet_lineage(spark, d):
    rows = files.parquet_with_lineage(spark, f"{d}/customer.parquet")
    return rows.groupBy(F.regexp_extract("source_file", r"(customer\.parquet)", 1).alias("file")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT o_orderpriority AS f FROM orders WHERE o_orderpriority NOT LIKE '1%'")
def unseen_files(spark, d):
    f = t(spark, d, "orders").select(F.col("o_orderpriority").alias("f"))
    return files.unseen(f.distinct(), f.where("f LIKE '1%'"), "f")


@query("""WITH RECURSIVE nodes AS (SELECT 'r' || r_regionkey AS id, NULL AS parent, r_name AS name FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, s_name FROM supplier),
walk AS (SELECT id, name AS lineage, 1 AS depth FROM nodes WHERE parent IS NULL UNION ALL SELECT n.id, w.lineage || ' || ' || n.name, w.depth + 1 FROM nodes n JOIN walk w ON n.parent = w.id)
SELECT id, lineage, depth FROM walk UNION ALL SELECT 'c' || k, array_to_string(list_transform(range(1, k + 1), lambda i: 'name ' || i), ' || '), CAST(k AS INTEGER) FROM (SELECT unnest(range(1, 101)) AS k)""")
def xml_lineage(spark, d):
    """The forest of regions, and a chain of 100 nodes beside it."""
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    r = t(spark, d, "region").select(key("r", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("name"))
    n = t(spark, d, "nation").select(key("n", "n_nationkey"), key("r", "n_regionkey"), "n_name")
    s = t(spark, d, "supplier").select(key("s", "s_suppkey"), key("n", "s_nationkey"), "s_name")
    chain = spark.range(1, 101).select(key("c", "id"), F.when(F.col("id") > 1, F.concat(F.lit("c"), (F.col("id") - 1).cast("string"))), F.concat(F.lit("name "), F.col("id").cast("string")))
    return xml_flatten.lineage(r.union(n).union(s).union(chain))


def notification_files(spark, d) -> str:
    """A notification for each customer, as XML: 0 to 2 phones, a name, and for some no contact methods at all."""
    path = sinks.scratch(spark)
    phone = lambda n: F.format_string('<phone number="%d-%d" type="home"/>', F.col("c_custkey"), F.lit(n))
    k = F.col("c_custkey") % 4
    phones = F.when(k == 1, phone(1)).when(k == 2, F.concat(phone(1), phone(2))).otherwise("")
    methods = F.when(k == 3, "<methods/>").otherwise(F.concat(F.lit("<methods>"), phones, F.format_string('<email address="c%d@example.org"/>', F.col("c_custkey")), F.lit("</methods>")))
    doc = F.concat(F.format_string("<notification><claim>%d</claim><transaction_id>t%d</transaction_id>", F.col("c_custkey"), F.col("c_nationkey")), F.format_string('<control stamp="2024-01-01T00:00:00" type="x"/><contacts><contact name="%s">', F.col("c_name")), methods, F.lit("</contact></contacts></notification>"))
    t(spark, d, "customer").select(doc.alias("value")).write.mode("overwrite").text(path)
    return path


def notifications(spark, d):
    return files.xml_lines(spark, notification_files(spark, d), xml_flatten.NOTIFICATION)


@query("""SELECT c_custkey::VARCHAR AS claim, 't' || c_nationkey AS transaction_id, '' AS recipients, 'x' AS control_type FROM customer""")
def xml_notification_header(spark, d):
    return xml_flatten.notification_tables(notifications(spark, d))["header"].select("claim", "transaction_id", "recipients", "control_type")


@query("""SELECT c_custkey::VARCHAR AS claim, c_name AS contact, CASE WHEN c_custkey % 4 IN (1, 2) THEN c_custkey || '-' || n ELSE '' END AS number FROM customer, (VALUES (1), (2)) v(n) WHERE n = 1 OR c_custkey % 4 = 2""")
def xml_notification_phones(spark, d):
    return xml_flatten.notification_tables(notifications(spark, d))["phone"].select("claim", "contact", "number")


@query("""SELECT c_custkey::VARCHAR AS claim, CASE WHEN c_custkey % 4 = 3 THEN '' ELSE 'c' || c_custkey || '@example.org' END AS address FROM customer""")
def xml_notification_emails(spark, d):
    return xml_flatten.notification_tables(notifications(spark, d))["email"].select("claim", "address")


@query("SELECT count(*) AS documents, 0 AS failures FROM customer")
def xml_run_summary(spark, d):
    return xml_flatten.run_summary(notifications(spark, d))


def estimates(spark, d):
    """An estimate for each nation, as XML lines: a group for its region, in it one for itself, an item for each supplier."""
    path = sinks.scratch(spark)
    s = t(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.format_string('<item group="n%d" text="%s" amount="%d"/>', "s_nationkey", "s_name", "s_suppkey"))).alias("items"))
    n = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    groups = F.format_string('<groups><node id="r" name="%s"/><node id="n%d" parent="r" name="%s"/></groups>', "r_name", "n_nationkey", "n_name")
    items = F.concat(F.lit("<items>"), F.coalesce(F.array_join("items", ""), F.lit("")), F.lit("</items>"))
    n.select(F.concat(F.format_string("<estimate><claim>%d</claim>", "n_nationkey"), groups, items, F.lit("</estimate>")).alias("value")).write.mode("overwrite").text(path)
    return xml_flatten.estimate_tables(files.xml_lines(spark, path, xml_flatten.ESTIMATE))


@query("""SELECT n_nationkey::VARCHAR AS claim, s_name AS text, s_suppkey::VARCHAR AS amount, r_name || ' || ' || n_name AS lineage FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def xml_estimate_items(spark, d):
    return xml_flatten.items_with_lineage(estimates(spark, d)).select("claim", "text", "amount", "lineage")


@query("SELECT n_nationkey::VARCHAR AS claim, '' AS total FROM nation")
def xml_estimate_header(spark, d):
    return estimates(spark, d)["header"].select("claim", "total")


@query(f"""WITH old AS (SELECT o_orderkey AS row_id, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'), last AS (SELECT coalesce(max(row_id), 0) AS m FROM old)
SELECT o_orderkey, m + row_number() OVER (ORDER BY strftime(date_trunc('month', o_orderdate), '%Y-%m-%d'), o_orderkey) AS row_id FROM orders, last WHERE o_orderdate >= TIMESTAMP '1996-01-01'""")
def reserve_row_ids(spark, d):
    orders = t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    old = orders.where(F.col("o_orderdate") < at("1996-01-01 00:00:00")).select(F.col("o_orderkey").alias("row_id"))
    new = orders.where(F.col("o_orderdate") >= at("1996-01-01 00:00:00"))
    return reserve.numbered(new, old, [F.asc("o_orderkey")], stamp.month_of(F.col("o_orderdate"))).select("o_orderkey", "row_id")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN DATE '1995-01-01' ELSE DATE '1996-01-31' END AS expiration_date FROM orders")
def reserve_expire(spark, d):
    old = t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit("1995-01-01").cast("date")).alias("expiration_date"))
    return reserve.expired(old, F.lit("1996-01-31").cast("date"))


@query("SELECT 'r1' AS run_name, (SELECT count(*) FROM orders) AS source_count, (SELECT count(*) FROM customer) AS target_count, (SELECT count(*) FROM orders) = (SELECT count(*) FROM customer) AS matches")
def reserve_run_statistics(spark, d):
    return reserve.run_statistics("r1", t(spark, d, "orders"), t(spark, d, "customer"))


SPECS = "TableName|SendToLake|CDCCol|LookUpColRef|Rows|Note\nORDERS|Y|coalesce(changed,o_orderdate)|y|12|x\nNATION|Y||typelist|3|\nLINEITEM|Y|l_shipdate,changed|n||\nPART|N|x|n||"


@query(f"""SELECT 'orders' AS name, 'coalesce' AS kind, count(*) AS n FROM orders WHERE coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL '90' DAY END, o_orderdate) > TIMESTAMP '{HIGH}'
UNION ALL SELECT 'nation', 'none', count(*) FROM nation UNION ALL SELECT 'lineitem', 'greatest', count(*) FROM lineitem WHERE greatest(l_shipdate, l_shipdate + INTERVAL '30' DAY) > TIMESTAMP '{HIGH}'""")
def table_spec_kinds(spark, d):
    """How many rows an incremental load takes of each table that a spec's text sends to the lake, by kind of its CDC column."""
    given = {"orders": t(spark, d, "orders").withColumn("changed", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate") + F.expr("INTERVAL '90' DAY"))), "lineitem": t(spark, d, "lineitem").withColumn("changed", F.col("l_shipdate") + F.expr("INTERVAL '30' DAY"))}
    loads = [(s, cdc.read_window(given.get(s.table, t(spark, d, s.table)), s, "di", end=at(HIGH))) for s in table_specs(SPECS)]
    return recon.together([rows.agg(F.count("*").alias("n")).select(F.lit(s.table).alias("name"), F.lit(s.cdc_kind).alias("kind"), "n") for s, rows in loads])


# --- suites of metrics -----------------------------------------------------------------------------------------------


def policy_tables(spark, d) -> recon_suites.PolicyTables:
    """orders as policy periods, customers as policies, orders as jobs of their own, with type lists."""
    o = t(spark, d, "orders").withColumn("n", F.col("o_orderkey"))
    code = lambda *names: spark.createDataFrame(list(enumerate(names)), "id long, typecode string")
    period = o.select(
        F.col("n").alias("id"), F.col("o_custkey").alias("policyid"), F.col("n").alias("jobid"), (F.col("n") % 4).alias("status"), F.concat(F.lit("P"), (F.col("n") % 900).cast("string")).alias("policynumber"),
        F.col("o_orderdate").alias("periodstart"), (F.col("o_orderdate") + F.expr("INTERVAL 365 DAYS")).alias("periodend"), F.col("o_orderdate").alias("cancellationdate"), (F.col("n") % 7 == 0).cast("int").alias("retired"),
    )
    return recon_suites.PolicyTables(
        period, t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("productcode")), o.select(F.col("n").alias("id"), (F.col("n") % 3).alias("subtype"), F.col("o_orderdate").alias("closedate")),
        code("Bound", "Quoted", "Draft", "AuditComplete"), code("Submission", "Cancellation", "Audit"),
    )


PERIODS_SQL = f"""SELECT o_orderkey AS id, c_mktsegment AS productcode, 'P' || o_orderkey % 900 AS policynumber, ['Bound', 'Quoted', 'Draft', 'AuditComplete'][o_orderkey % 4 + 1] AS state, ['Submission', 'Cancellation', 'Audit'][o_orderkey % 3 + 1] AS job,
o_orderdate AS starts, o_orderdate + INTERVAL 365 DAYS AS ends FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate <= TIMESTAMP '{AS_OF}'"""
LIVE_SQL = f"SELECT * FROM ({PERIODS_SQL}) WHERE id % 7 <> 0 AND productcode <> 'BUILDING'"


@query(f"""WITH p AS ({LIVE_SQL}), x AS (
SELECT 'TOTAL_INFORCE_' || productcode AS auditentity, policynumber FROM p WHERE state = 'Bound' AND job <> 'Cancellation' AND TIMESTAMP '{AS_OF}' BETWEEN starts AND ends
UNION ALL SELECT 'TOTAL_EXPIRED', policynumber FROM p WHERE state IN ('Bound', 'Quoted') AND job IN ('Submission', 'Cancellation') AND ends <= TIMESTAMP '{AS_OF}'
UNION ALL SELECT 'TOTAL_CANCELLED', policynumber FROM p WHERE state = 'Bound' AND job = 'Cancellation')
SELECT auditentity, CAST(count(DISTINCT policynumber) AS DOUBLE) AS value FROM x GROUP BY 1""")
def recon_policy_counts(spark, d):
    return recon_suites.policy_counts(policy_tables(spark, d), at(AS_OF), all_but=["BUILDING"])


@query(f"""WITH p AS ({PERIODS_SQL}), x AS (
SELECT 'TOTAL_INFORCE_' || productcode AS auditentity, policynumber FROM p WHERE productcode NOT IN ('BUILDING', 'MACHINERY') AND state = 'Bound' AND job <> 'Cancellation' AND TIMESTAMP '{AS_OF}' BETWEEN starts AND ends
UNION ALL SELECT 'TOTAL_EXPIRED', policynumber FROM p WHERE state IN ('Bound', 'Quoted') AND job IN ('Submission', 'Cancellation') AND ends <= TIMESTAMP '{AS_OF}'
UNION ALL SELECT 'TOTAL_CANCELLED', policynumber FROM p WHERE state = 'Bound' AND job = 'Cancellation')
SELECT auditentity, CAST(count(DISTINCT policynumber) AS DOUBLE) AS value FROM x GROUP BY 1""")
def recon_policy_counts_ended_of_all(spark, d):
    """Expired and cancelled periods count though their policy's row is missing or its product isn't asked for."""
    tables = policy_tables(spark, d)
    tables = replace(tables, policy=tables.policy.where("productcode <> 'BUILDING'"))
    return recon_suites.policy_counts(tables, at(AS_OF), all_but=["MACHINERY"], live_only=False, ended_of_all=True)


PREMIUM_SQL = f"""SELECT {DEC('l_extendedprice')} AS amount, l_shipdate AS written FROM lineitem JOIN ({PERIODS_SQL}) ON l_orderkey = id WHERE state IN ('Bound', 'AuditComplete') AND l_linenumber % 3 <> 0 AND l_partkey % 5 <> 0"""


PREMIUMS_SQL = f"""SELECT 'YTD_PA_PREM' AS auditentity, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS value FROM ({PREMIUM_SQL}) WHERE year(written) = 1996 AND month(written) <= 6
UNION ALL SELECT 'ALL_PA_PREM', CAST(coalesce(sum(amount), 0) AS DOUBLE) FROM ({PREMIUM_SQL})"""


def premiums(spark, d, tables):
    l = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("branchid"), F.concat_ws("-", (F.col("l_linenumber") % 3).cast("string"), (F.col("l_partkey") % 5).cast("string")).alias("cost"), F.col("l_extendedprice").alias("amountbilling"), F.col("l_shipdate").alias("writtendate"))
    costs = spark.createDataFrame([(f"{a}-{b}", a, None if b else "fee") for a in range(3) for b in range(5)], "id string, chargepattern long, feename string")
    charges = spark.createDataFrame([(0, "Tax"), (1, "Premium"), (2, "MCCA")], "id long, typecode string")
    return recon_suites.policy_premiums(tables, l, costs, charges, "PA", at(AS_OF))


@query(PREMIUMS_SQL)
def recon_policy_premiums(spark, d):
    return premiums(spark, d, policy_tables(spark, d))


@query(PREMIUMS_SQL)
def recon_policy_premiums_unmatched(spark, d):
    """Half of the policies' rows and a job's type are missing; premiums count all the same."""
    tables = policy_tables(spark, d)
    return premiums(spark, d, replace(tables, policy=tables.policy.where("id % 2 = 0"), job_types=tables.job_types.where("typecode <> 'Audit'")))


CLAIM_SQL = f"SELECT DISTINCT c_custkey AS id, c_name AS nbr FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderdate <= TIMESTAMP '{AS_OF}' AND o_orderkey % 9 = 8"
LOSS_SQL = f"SELECT {DEC('l_extendedprice')} AS amount, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 20 DAYS END, o_orderdate) AS lossdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < TIMESTAMP '{AS_OF}'"
LOSS = lambda kind, since: ONE(f"{kind}_LOSSAMT", "coalesce(sum(amount), 0)", f"({LOSS_SQL}) WHERE lossdate < TIMESTAMP '{AS_OF}' AND lossdate >= TIMESTAMP '{since}'")


@query(f"""{ONE('CLAIM_ID_CNT', 'count(DISTINCT id)', f'({CLAIM_SQL})')} UNION ALL {ONE('CLAIM_NBR_CNT', 'count(DISTINCT nbr)', f'({CLAIM_SQL})')}
UNION ALL {LOSS('MTD', '1996-06-01')} UNION ALL {LOSS('YTD', '1996-01-01')} UNION ALL {LOSS('ALL', '1900-01-01')}""")
def recon_claims(spark, d):
    claim = t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("claimnumber"), at("1990-01-01 00:00:00").alias("createtime"))
    o, day = t(spark, d, "orders"), F.col("o_orderdate")
    trans = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("claimid"), day.alias("createtime"), day.alias("updatetime"), (F.col("o_orderkey") % 9).alias("lifecyclestate"), F.when(F.col("o_orderkey") % 2 == 0, day + F.expr("INTERVAL 20 DAYS")).alias("originalcreatedate"))
    item = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("transactionid"), F.col("l_extendedprice").alias("transactionamount"), F.col("l_shipdate").alias("createtime"))
    return recon_suites.claim_metrics(claim, trans, item, at(AS_OF))


# --- whole documents -------------------------------------------------------------------------------------------------


def rough_drafts(spark, d) -> dict[str, DataFrame]:
    """A rough draft for each nation: its region as outer group, itself within, a room with an item for each supplier."""
    path = sinks.scratch(spark)
    s = t(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.format_string('<group name="%s"><items><item line="%d" total="1"/></items><room walls="%d"/></group>', "s_name", "s_suppkey", "s_suppkey"))).alias("rooms"))
    n = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    rooms = F.coalesce(F.array_join("rooms", ""), F.lit(""))
    head = F.format_string('<draft><claim>%d</claim><contacts><contact id="k" name="%s"><phones><phone number="1"/><phone number="2"/></phones></contact></contacts>', "n_nationkey", "n_name")
    groups = F.concat(F.format_string('<groups><group name="%s"><totals total="9"/><group name="%s">', "r_name", "n_name"), rooms, F.lit("</group></group></groups>"))
    recap = F.format_string('<recap><group name="%s" subtotal="5"><group name="%s" subtotal="4"><coverages><coverage name="c" amount="3"/></coverages></group></group></recap></draft>', "r_name", "n_name")
    n.select(F.concat(head, groups, recap).alias("value")).write.mode("overwrite").text(path)
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    return xml_flatten.rough_draft_tables(files.xml_lines(spark, path, xml_flatten.rough_draft_schema(0)), raw=raw)


PLACES_SQL = "FROM nation JOIN region ON n_regionkey = r_regionkey"


@query(f"SELECT n_nationkey::VARCHAR AS claim, r_name || ' || ' || n_name || ' || ' || s_name AS lineage, '3' AS depth, s_suppkey::VARCHAR AS line, '' AS text, '1' AS total {PLACES_SQL} JOIN supplier ON s_nationkey = n_nationkey")
def xml_rough_draft_items(spark, d):
    return rough_drafts(spark, d)["item"].select("claim", "lineage", "depth", "line", "text", "total")


@query(f"SELECT n_nationkey::VARCHAR AS claim, r_name || ' || ' || n_name || ' || ' || s_name AS lineage, s_suppkey::VARCHAR AS walls, '' AS floor {PLACES_SQL} JOIN supplier ON s_nationkey = n_nationkey")
def xml_rough_draft_rooms(spark, d):
    return rough_drafts(spark, d)["room"].select("claim", "lineage", "walls", "floor")


@query(f"SELECT n_nationkey::VARCHAR AS claim, r_name AS lineage, '9' AS total {PLACES_SQL}")
def xml_rough_draft_totals(spark, d):
    return rough_drafts(spark, d)["totals"].select("claim", "lineage", "total")


@query("SELECT n_nationkey::VARCHAR AS claim, CAST(9 AS DOUBLE) AS total FROM nation")
def xml_rough_draft_dimension_totals(spark, d):
    return rough_drafts(spark, d)["dimension_totals"].select("claim", F.col("total").cast("double").alias("total"))


@query("SELECT c_custkey::VARCHAR AS claim, array_to_string(list_transform(range(1, k + 1), lambda i: 'g' || i), ' || ') AS lineage, CAST(k AS INTEGER) AS depth, CASE WHEN k % 2 = 0 THEN c_custkey::VARCHAR END AS walls FROM (SELECT c_custkey, unnest(range(1, c_custkey % 100 + 2)) AS k FROM customer WHERE c_custkey % 50 <> 1)")
def xml_deep_groups(spark, d):
    """A chain of 1 to 100 groups, one in another, for each customer; every fiftieth document is broken off."""
    path, key = sinks.scratch(spark), F.col("c_custkey").cast("string")
    group = lambda i: F.concat(F.lit('<group name="g'), i.cast("string"), F.lit('">'), F.when(i % 2 == 0, F.concat(F.lit('<room walls="'), key, F.lit('"/>'))).otherwise(""))
    deep = (F.col("c_custkey") % 100 + 1).cast("int")
    doc = F.concat(F.lit("<draft><claim>"), key, F.lit("</claim><groups>"), F.array_join(F.transform(F.sequence(F.lit(1), deep), group), ""), F.repeat(F.lit("</group>"), deep), F.lit("</groups></draft>"))
    t(spark, d, "customer").select(F.when(F.col("c_custkey") % 50 == 1, F.substring(doc, 1, 45)).otherwise(doc).alias("value")).write.text(path)
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    return xml_groups.groups_at_any_depth(raw, "groups.group", xml_flatten.GROUP_FIELDS, ["claim"]).select("claim", "lineage", "depth", F.col("room._walls").alias("walls"))


@query(f"SELECT n_nationkey::VARCHAR AS claim, r_name AS lineage, '5' AS subtotal, '' AS coverage, '' AS amount {PLACES_SQL} UNION ALL SELECT n_nationkey::VARCHAR, r_name || ' || ' || n_name, '4', 'c', '3' {PLACES_SQL}")
def xml_rough_draft_recap(spark, d):
    return rough_drafts(spark, d)["recap"].select("claim", "lineage", "subtotal", "coverage", "amount")


@query("SELECT n_nationkey::VARCHAR AS claim, 'k' AS contact_id, n::VARCHAR AS number FROM nation, (VALUES (1), (2)) v(n)")
def xml_rough_draft_phones(spark, d):
    return rough_drafts(spark, d)["phone"].select("claim", "contact_id", "number")


def carrier_documents(spark, d) -> DataFrame:
    """An estimate for each customer with two control points and a minimum; every tenth one is broken off."""
    path = sinks.scratch(spark)
    doc = F.format_string('<estimate><claim>%d</claim><total>5</total><contacts><contact id="c" name="%s"><emails><email address="a%d"/></emails></contact></contacts><control_points><control_point stamp="s" type="a"/><control_point stamp="s" type="b"/></control_points><minimums><minimum id="m" amount="7"/></minimums></estimate>', "c_custkey", "c_name", "c_custkey")
    t(spark, d, "customer").select(F.when(F.col("c_custkey") % 10 == 0, F.substring(doc, 1, 40)).otherwise(doc).alias("value")).write.mode("overwrite").text(path)
    return files.xml_lines(spark, path, xml_flatten.CARRIER_ESTIMATE)


def carrier_tables(spark, d) -> dict[str, DataFrame]:
    return xml_flatten.carrier_estimate_tables(carrier_documents(spark, d).where("_corrupt_record IS NULL"))


@query("SELECT c_custkey::VARCHAR AS claim, k AS kind FROM customer, (VALUES ('a'), ('b')) v(k) WHERE c_custkey % 10 <> 0")
def xml_carrier_control_points(spark, d):
    return carrier_tables(spark, d)["control_point"].select("claim", "kind")


@query("SELECT c_custkey::VARCHAR AS claim, 'm' AS id, '7' AS amount, '' AS text FROM customer WHERE c_custkey % 10 <> 0")
def xml_carrier_minimums(spark, d):
    return carrier_tables(spark, d)["minimum"].select("claim", "id", "amount", "text")


@query("SELECT c_custkey::VARCHAR AS claim, 'c' AS contact_id, 'a' || c_custkey AS address FROM customer WHERE c_custkey % 10 <> 0")
def xml_carrier_emails(spark, d):
    return carrier_tables(spark, d)["email"].select("claim", "contact_id", "address")


@query("SELECT '1' AS started, '2' AS ended, count(*) FILTER (c_custkey % 10 = 0) AS estimate_failures, count(*) FILTER (c_custkey % 10 <> 0) AS estimate_successes, count(*) AS documents FROM customer")
def xml_kinds_summary(spark, d):
    return xml_flatten.kinds_summary({"estimate": carrier_documents(spark, d)}, "1", "2")


# --- publishing reference tables, audit files, text sources ----------------------------------------------------------


@query(TYPES_SQL)
def typelist_refresh(spark, d):
    """Published lists after a refresh: only those that changed are written again."""
    path, new = sinks.scratch(spark), lookup.consolidated(type_lists(spark, d))
    sinks.publish_lists(spark, path, old_lists(new))
    sinks.publish_lists(spark, path, new)
    return spark.read.parquet(path).select("typecode", "typelistname")


@query(TYPES_SQL)
def typelist_refresh_removed(spark, d):
    """Every published list has codes that the refresh lacks; they go."""
    path, new = sinks.scratch(spark), lookup.consolidated(type_lists(spark, d))
    sinks.publish_lists(spark, path, new.unionByName(new.withColumn("typecode", F.concat(F.lit("gone "), F.col("typecode").cast("string")))))
    sinks.publish_lists(spark, path, new)
    return spark.read.parquet(path).select("typecode", "typelistname")


@query(f"SELECT processname, batch, tablename, count(*) AS n FROM ({AUDIT_SQL}) WHERE batch <= '1200' GROUP BY 1, 2, 3")
def audit_restored(spark, d):
    """Audit files compacted, then taken back to an earlier batch."""
    path = sinks.scratch(spark)
    rows = audit_rows(spark, d).drop("event_id").repartition(4)
    sinks.write_partitioned(rows, path, ["processname", "ingestiondt"], "overwrite")
    sinks.compact(spark, path, ["processname", "ingestiondt"])
    sinks.restore_audit(spark, path, "1200", ["processname", "ingestiondt"])
    return spark.read.parquet(path).groupBy("processname", F.col("batch").cast("string").alias("batch"), "tablename").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, r_name AS group_name FROM supplier JOIN region ON s_suppkey % 5 = r_regionkey")
def reserve_files_by_group(spark, d):
    """Fixed-width reserve lines joined to a CSV of groups by group number."""
    base = sinks.scratch(spark)
    t(spark, d, "supplier").select(F.format_string("%08d%03d", F.col("s_suppkey"), F.col("s_suppkey") % 5).alias("value")).write.text(f"{base}/lines")
    t(spark, d, "region").select("r_regionkey", "r_name").write.csv(f"{base}/groups")
    lines = files.fixed_width(spark, f"{base}/lines", [("id", 1, 8), ("group", 9, 3)]).select(F.col("id").cast("long").alias("s_suppkey"), F.col("group").cast("int").alias("group"))
    groups = spark.read.csv(f"{base}/groups", schema="group int, group_name string")
    return lines.join(lookup.sized(groups), "group").select("s_suppkey", "group_name")


@query("SELECT c_custkey, c_name FROM customer")
def sink_csv(spark, d):
    path = sinks.scratch(spark)
    written = sinks.write_csv(t(spark, d, "customer").select("c_custkey", "c_name"), path, "customers", "20240101000000")
    return spark.read.csv(written, header=True, schema="c_custkey long, c_name string")
