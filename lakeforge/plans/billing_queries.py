"""Queries of the billing suite, over the given tables in a billing system's shape."""
from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lakeforge.operators import recon
from lakeforge.operators.joined import Window
from lakeforge.plans import billing
from lakeforge.plans.base import AS_OF, query, shaped, shaped_sql, t

LATER, EARLIER = "INTERVAL '40' DAY", "INTERVAL '90' DAY"
CHANGED = f"CASE WHEN l_partkey % 3 = 0 THEN l_shipdate - {EARLIER} ELSE l_shipdate + {LATER} END"
MADE = "CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_shipdate END"
TRANSACTION_OF = {"transactionid": "o_orderkey"}
#: Keys that repeat (rows fan out), that nothing matches (rows drop or stay) and that are null, on purpose.
SHAPES = {
    "invoiceitem": ("lineitem", {"publicid": "l_orderkey * 8 + l_linenumber % 4", "amount": "l_extendedprice", "createtime": MADE, "updatetime": CHANGED}, "true"),
    "charge": ("orders", {"id": "o_orderkey", "publicid": "o_orderkey", "amount": "o_totalprice", "createtime": "o_orderdate", "taccountcontainerid": "CASE WHEN o_orderkey % 11 > 0 THEN o_custkey END"}, "true"),
    "basedistitem": ("lineitem", {"publicid": "l_partkey", "activedistid": "CASE WHEN l_linenumber % 3 > 0 THEN l_orderkey END", "reverseddistid": "l_orderkey + 1", "grossamounttoapply": "l_extendedprice", "commissionamounttoapply": "l_tax", "createtime": MADE, "updatetime": CHANGED}, "true"),
    "basedist": ("orders", {"id": "o_orderkey", "publicid": "o_custkey", "writeoffamount": "o_totalprice", "createtime": "o_orderdate + INTERVAL '200' DAY", "updatetime": "o_orderdate + INTERVAL '300' DAY"}, "true"),
    "writeoff": ("orders", {"publicid": "o_orderkey", "amount": "o_totalprice", "reversedamount": "o_totalprice * 2", "createtime": "o_orderdate"}, "o_orderstatus <> 'P'"),
    "negativewriteoff": ("lineitem", {"publicid": "l_partkey", "amount": "l_extendedprice", "createtime": "l_shipdate"}, "l_returnflag = 'R'"),
    "disbursement": ("orders", {"amount": "o_totalprice", "createtime": "o_orderdate"}, "o_orderstatus = 'F'"),
    "fundstransfer": ("orders", {"amount": "o_totalprice", "createtime": f"o_orderdate + {LATER}"}, "o_orderkey % 3 = 0"),
    "nonreceivabledistitem": ("lineitem", {"id": "l_orderkey * 4 + l_linenumber % 3", "publicid": "l_suppkey", "grossamounttoapply": "l_extendedprice", "commissionamounttoapply": "l_discount", "createtime": MADE, "updatetime": CHANGED, "matchingpolicyid": "l_partkey"}, "true"),
    "transaction": ("orders", {"id": "o_orderkey", "amount": "o_totalprice", "transactiondate": "o_orderdate"}, "o_orderkey % 13 > 0"),
    "taccountcontainer": ("customer", {"id": "c_custkey", "subtype": "c_nationkey"}, "c_custkey % 7 > 0"),
    "taccountcontainertype": ("nation", {"id": "n_nationkey", "typecode": "CASE n_nationkey % 3 WHEN 0 THEN 'PolTAcctContainer' WHEN 1 THEN 'AcctTAcctContainer' ELSE 'Other' END"}, "true"),
    "policyperiod": ("orders", {"id": "o_orderkey", "hiddentaccountcontainerid": "CASE WHEN o_orderkey % 5 > 0 THEN o_custkey + 1 END", "policyid": "o_orderkey % 500"}, "o_orderkey % 4 = 0"),
    "policy": ("part", {"id": "p_partkey % 100", "pcpublicid": "CASE WHEN p_size % 2 = 0 THEN p_name END", "accountid": "p_partkey % 80"}, "true"),
    "account": ("supplier", {"id": "s_suppkey % 70", "hiddentaccountcontainerid": "s_suppkey % 50"}, "true"),
    "chargeinstancecontext": ("lineitem", {"transactionid": "l_orderkey", "chargeid": "l_partkey"}, "true"),
    "producercontext": ("lineitem", {"transactionid": "l_orderkey", "chargecommissionid": "CASE WHEN l_linenumber > 1 THEN l_partkey END"}, "true"),
    "chargecommission": ("part", {"id": "p_partkey", "chargeid": "p_partkey * 3"}, "p_partkey % 4 > 0"),
    "accountcontext": ("orders", {**TRANSACTION_OF, "accountid": "o_custkey % 150"}, "true"),
    "dbmoneyrcvdcontext": ("orders", {**TRANSACTION_OF, "accountid": "o_custkey % 60", "directbillmoneyrcvdid": "o_orderkey % 97"}, "true"),
    "basemoneyreceived": ("supplier", {"id": "s_suppkey % 40", "policyperiodid": "s_suppkey * 4"}, "true"),
    "susppymtcontext": ("orders", {**TRANSACTION_OF, "suspensepaymentid": "o_orderkey % 90"}, "true"),
    "suspensepayment": ("supplier", {"id": "s_suppkey % 60", "policyperiodappliedtoid": "s_suppkey * 4"}, "true"),
    "transfertxcontext": ("orders", {**TRANSACTION_OF, "sourceaccountid": "o_custkey % 90", "targetaccountid": "o_orderkey % 130"}, "true"),
    "nonreceivableitemctx": ("lineitem", {"transactionid": "l_orderkey", "basenonreceivabledistitemid": "l_orderkey * 4 + l_linenumber % 4", "accountwithsuspenseid": "l_suppkey"}, "true"),
    "creditcontext": ("orders", {**TRANSACTION_OF, "accountid": "o_custkey % 40"}, "o_orderstatus <> 'O'"),
}

#: What each kind of transaction is joined to, as SQL would write it.
FROM = {
    "CHRG": """chargeinstancecontext cix JOIN transaction trans ON trans.id = cix.transactionid JOIN charge chrg ON chrg.id = cix.chargeid JOIN taccountcontainer tac ON tac.id = chrg.taccountcontainerid
      JOIN taccountcontainertype tc ON tc.id = tac.subtype LEFT JOIN policyperiod polper ON polper.hiddentaccountcontainerid = chrg.taccountcontainerid AND tc.typecode = 'PolTAcctContainer'
      LEFT JOIN policy pol ON pol.id = polper.policyid AND pol.pcpublicid IS NOT NULL LEFT JOIN account a ON a.id = pol.accountid LEFT JOIN account ta ON ta.hiddentaccountcontainerid = chrg.taccountcontainerid AND tc.typecode = 'AcctTAcctContainer'""",
    "PROD": """producercontext cix JOIN transaction trans ON trans.id = cix.transactionid LEFT JOIN chargecommission comm ON comm.id = cix.chargecommissionid LEFT JOIN charge chrg ON chrg.id = comm.chargeid
      LEFT JOIN policyperiod polper ON polper.hiddentaccountcontainerid = chrg.taccountcontainerid LEFT JOIN policy pol ON pol.id = polper.policyid AND pol.pcpublicid IS NOT NULL LEFT JOIN account a ON a.id = pol.accountid""",
    "ACCT": "accountcontext cix JOIN transaction trans ON trans.id = cix.transactionid JOIN account acc ON acc.id = cix.accountid",
    "DBMR": """dbmoneyrcvdcontext cix JOIN account acc ON acc.id = cix.accountid LEFT JOIN basemoneyreceived bsmr ON bsmr.id = cix.directbillmoneyrcvdid LEFT JOIN policyperiod polper ON polper.id = bsmr.policyperiodid
      JOIN transaction trans ON trans.id = cix.transactionid""",
    "SUSPYMT": """susppymtcontext cix JOIN suspensepayment spmt ON spmt.id = cix.suspensepaymentid LEFT JOIN policyperiod polper ON polper.id = spmt.policyperiodappliedtoid
      LEFT JOIN policy pol ON pol.id = polper.policyid AND pol.pcpublicid IS NOT NULL LEFT JOIN account a ON a.id = pol.accountid JOIN transaction trans ON trans.id = cix.transactionid""",
    "TRANSFR": "transfertxcontext cix LEFT JOIN account sa ON sa.id = cix.sourceaccountid LEFT JOIN account ta ON ta.id = cix.targetaccountid JOIN transaction trans ON trans.id = cix.transactionid",
    "NONRECV": """nonreceivableitemctx cix JOIN nonreceivabledistitem bndi ON bndi.id = cix.basenonreceivabledistitemid LEFT JOIN account acc ON acc.id = cix.accountwithsuspenseid
      LEFT JOIN policyperiod polper ON polper.id = bndi.matchingpolicyid JOIN transaction trans ON trans.id = cix.transactionid""",
    "CREDIT": "creditcontext cix JOIN account acc ON acc.id = cix.accountid JOIN transaction trans ON trans.id = cix.transactionid",
}
WINDOW = Window(1, datetime(1996, 1, 1), datetime.fromisoformat(AS_OF))
#: Load cycles: the days on which a few of the customers' numbers fall; one of another system and one before any row.
CYCLES = {
    "cycle": ("nation", {
        "load_cycle_id": "CAST(n_nationkey + 100 AS BIGINT)", "pv_startdate": "TIMESTAMP '1992-06-30 12:00:00' + n_nationkey * INTERVAL '300' DAY", "pv_enddate": "TIMESTAMP '1993-04-26 12:00:00' + n_nationkey * INTERVAL '300' DAY",
        "source_system_code": "CASE WHEN n_nationkey = 3 THEN 'OTHER' ELSE 'BILL' END", "cycle_type_code": "'STAGE'"}, "n_nationkey < 6")
}
DAY = "'%Y-%m-%d %H:%M:%S'"


def metric_sql(entity: str, value: str, rest: str, since: str, cycle: str = "") -> str:
    """One metric of the window, or one for each load cycle that has rows; rest: what cycles c is joined to."""
    ids, how = ("c.load_cycle_id AS etl_load_cycle_id, ", "JOIN") if cycle else ("", "LEFT JOIN")
    return f"""SELECT {ids}'{entity}' AS auditentity, strftime({since}, {DAY}) AS auditfrom, strftime(c.pv_enddate, {DAY}) AS auditthru, CAST({value} AS DOUBLE) AS value
      FROM cycles c {how} {rest} GROUP BY c.load_cycle_id, c.pv_enddate"""


EVER, MONTH, YEAR = "TIMESTAMP '1900-01-01'", "date_trunc('month', c.pv_enddate)", "date_trunc('year', c.pv_enddate)"
MONEY = "sum(CAST({} AS DECIMAL(20,2)))"


def totals_sql(cycle: str = "") -> str:
    out = []
    for table, times, count, amounts in (
        ("invoiceitem", "uc", "TOTAL_BILL_INV_ITM_CNT", {"TOTAL_BILL_INV_ITM_AMT": "amount"}),
        ("charge", "c", "TOTAL_BILL_CHRG_CNT", {"TOTAL_BILL_CHRG_AMT": "amount"}),
        ("basedistitem", "uc", "TOTAL_BILL_DIST_ITM_CNT", {"TOTAL_GROSS_APPLY_AMT": "grossamounttoapply", "TOTAL_COMM_APPLY_AMT": "commissionamounttoapply"}),
        ("writeoff", "c", "TOTAL_BILL_WO_CNT", {"TOTAL_REVERSED_AMT": "reversedamount", "TOTAL_WO_AMT": "amount"}),
        ("negativewriteoff", "c", "TOTAL_BILL_NWO_CNT", {"TOTAL_NWO_AMT": "amount"}),
        ("disbursement", "c", None, {"TOTAL_DISB_AMT": "amount"}),
        ("fundstransfer", "c", None, {"TOTAL_FUND_TRANFR_AMT": "amount"}),
        ("nonreceivabledistitem", "uc", "TOTAL_BILL_NONRECV_DIST_ITM_CNT", {"TOTAL_GROSS_NONRECV_APPLY_AMT": "grossamounttoapply", "TOTAL_COMM_NONRECV_APPLY_AMT": "commissionamounttoapply"}),
    ):
        when = " OR ".join(f"{x} <= c.pv_enddate" for x in (["updatetime"] if "u" in times else []) + ["createtime"])
        wanted = ({count: "count(DISTINCT publicid)"} if count else {}) | {e: MONEY.format(a) for e, a in amounts.items()}
        out += [metric_sql(e, v, f"{table} ON {when}", EVER, cycle) for e, v in wanted.items()]
    return " UNION ALL ".join(out)


def distributions_sql(cycle: str = "") -> str:
    within = "({0} > c.pv_startdate AND {0} <= c.pv_enddate)"
    made, changed = within.format("i.createtime"), within.format("i.updatetime")
    item = f"""SELECT c.load_cycle_id, coalesce(activedistid, reverseddistid) AS distid, max(CASE WHEN {made} THEN i.createtime ELSE i.updatetime END) AS processed
      FROM cycles c CROSS JOIN basedistitem i WHERE {made} OR {changed} GROUP BY ALL"""
    rows = f"""(SELECT c.load_cycle_id, d.publicid, d.writeoffamount FROM cycles c CROSS JOIN basedist d LEFT JOIN ({item}) i ON i.distid = d.id AND i.load_cycle_id = c.load_cycle_id
      WHERE d.updatetime <= c.pv_enddate OR d.createtime <= c.pv_enddate OR i.processed <= c.pv_enddate) r ON r.load_cycle_id = c.load_cycle_id"""
    return " UNION ALL ".join(metric_sql(e, v, rows, EVER, cycle) for e, v in (("TOTAL_BILL_DIST_CNT", "count(DISTINCT publicid)"), ("TOTAL_BILL_DIST_WO_AMT", MONEY.format("writeoffamount"))))


def periods_sql(kinds, cycle: str = "") -> str:
    out = []
    for kind in kinds:
        for p, since in (("MTD", MONTH), ("YTD", YEAR)):
            rows = f"(SELECT trans.amount, trans.transactiondate FROM {FROM[kind]}) ON transactiondate BETWEEN {since} AND c.pv_enddate"
            out.append(metric_sql(f"{p}_BILL_{kind}_TRANS_AMT", MONEY.format("amount"), rows, since, cycle))
    return " UNION ALL ".join(out)


ONE_WINDOW = f"cycles AS (SELECT 1 AS load_cycle_id, TIMESTAMP '{WINDOW.start}' AS pv_startdate, TIMESTAMP '{AS_OF}' AS pv_enddate)"
OUT = ("auditentity", "auditfrom", "auditthru", "value")


@query(f"WITH {shaped_sql(SHAPES)}, {ONE_WINDOW} {totals_sql()}")
def recon_billing_totals(spark, d):
    return billing.totals(shaped(spark, d, SHAPES), [WINDOW]).select(*OUT)


@query(f"WITH {shaped_sql(SHAPES)}, {ONE_WINDOW} {distributions_sql()}")
def recon_billing_distributions(spark, d):
    return billing.distributions(shaped(spark, d, SHAPES), [WINDOW]).select(*OUT)


@query(f"WITH {shaped_sql(SHAPES)}, {ONE_WINDOW} {periods_sql(['CHRG'])}")
def recon_billing_charge_periods(spark, d):
    return billing.periods(shaped(spark, d, SHAPES), [WINDOW], ["CHRG"]).select(*OUT)


@query(f"WITH {shaped_sql(SHAPES)}, {ONE_WINDOW} {periods_sql([k for k in FROM if k != 'CHRG'])}")
def recon_billing_periods(spark, d):
    return billing.periods(shaped(spark, d, SHAPES), [WINDOW], [k for k in billing.CONTEXTS if k != "CHRG"]).select(*OUT)


@query(f"""WITH {shaped_sql(SHAPES | CYCLES)}, cycles AS (SELECT load_cycle_id, pv_startdate, pv_enddate FROM cycle WHERE source_system_code = 'BILL' AND cycle_type_code = 'STAGE')
{totals_sql('each')} UNION ALL {distributions_sql('each')} UNION ALL {periods_sql(FROM, 'each')}""")
def recon_billing_load_cycle(spark, d):
    """The whole suite for each of the system's load cycles at once."""
    cycles = billing.load_cycles(shaped(spark, d, CYCLES)["cycle"], "BILL", "STAGE")
    return billing.by_load_cycle(shaped(spark, d, SHAPES), cycles)


@query(f"""WITH {shaped_sql(SHAPES)}, {ONE_WINDOW}, source AS ({totals_sql()}), kept AS (SELECT * FROM source WHERE auditentity NOT LIKE '%_WO_%')
SELECT '{AS_OF}' AS extractdate, CAST(NULL AS VARCHAR) AS polstatus, auditentity, s.auditfrom, s.auditthru, s.value AS src_value, 'BILL' AS source_system_cd,
CASE WHEN auditentity = 'TOTAL_BILL_CHRG_AMT' THEN NULL ELSE k.value END AS lake_value,
CASE WHEN k.auditentity IS NULL THEN 'missing' WHEN auditentity = 'TOTAL_BILL_CHRG_AMT' OR s.value IS NULL THEN 'failed' ELSE 'success' END AS recon_status
FROM source s LEFT JOIN kept k USING (auditentity)""")
def recon_billing_compared(spark, d):
    """Both sides' metrics, each with the times that it is about."""
    found = billing.totals(shaped(spark, d, SHAPES), [WINDOW])
    lake = found.where("auditentity NOT LIKE '%_WO_%'").withColumn("value", F.when(F.col("auditentity") != "TOTAL_BILL_CHRG_AMT", F.col("value")))
    return recon.reconciled_each(found, lake, "BILL", AS_OF)
