"""The reconciliation metrics of a billing system: totals of its tables, distributions by when they were processed, and the
month's and the year's transactions by context, for one window or for the load cycles of a batch at once."""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.operators import recon
from lakeforge.operators.joined import Edge, JoinSpec, Measure, Window, instant, joined, measured


def until(*columns: str) -> Callable[[Window], Column]:
    """Any of these times is not after the window's end; a null one isn't."""
    return lambda w: reduce(lambda a, b: a | b, (F.coalesce(F.col(c) <= instant(w.end), F.lit(False)) for c in columns))


def month_start(w: Window) -> datetime:
    return datetime(w.end.year, w.end.month, 1)


def year_start(w: Window) -> datetime:
    return datetime(w.end.year, 1, 1)


def total(times: Sequence[str], count: str | None, *amounts: tuple[str, str]) -> tuple[Measure, ...]:
    when = until(*times)
    sums = (Measure(entity, "sum", column, when) for entity, column in amounts)
    return (*([Measure(count, "distinct", "publicid", when)] if count else []), *sums)


#: Which times of a table decide, what is counted and what is summed.
CHANGED, MADE = ("updatetime", "createtime"), ("createtime",)
TOTALS = {
    "invoiceitem": total(CHANGED, "TOTAL_BILL_INV_ITM_CNT", ("TOTAL_BILL_INV_ITM_AMT", "amount")),
    "charge": total(MADE, "TOTAL_BILL_CHRG_CNT", ("TOTAL_BILL_CHRG_AMT", "amount")),
    "basedistitem": total(CHANGED, "TOTAL_BILL_DIST_ITM_CNT", ("TOTAL_GROSS_APPLY_AMT", "grossamounttoapply"), ("TOTAL_COMM_APPLY_AMT", "commissionamounttoapply")),
    "writeoff": total(MADE, "TOTAL_BILL_WO_CNT", ("TOTAL_REVERSED_AMT", "reversedamount"), ("TOTAL_WO_AMT", "amount")),
    "negativewriteoff": total(MADE, "TOTAL_BILL_NWO_CNT", ("TOTAL_NWO_AMT", "amount")),
    "disbursement": total(MADE, None, ("TOTAL_DISB_AMT", "amount")),
    "fundstransfer": total(MADE, None, ("TOTAL_FUND_TRANFR_AMT", "amount")),
    "nonreceivabledistitem": total(CHANGED, "TOTAL_BILL_NONRECV_DIST_ITM_CNT", ("TOTAL_GROSS_NONRECV_APPLY_AMT", "grossamounttoapply"), ("TOTAL_COMM_NONRECV_APPLY_AMT", "commissionamounttoapply")),
}

def context(table: str, *edges: Edge) -> JoinSpec:
    """Transactions with the rows of their context, of which a metric needs only how many there are."""
    return JoinSpec("trans", "transaction", (Edge("cix", table, "transactionid", "trans.id"), *edges))


#: What a transaction's context is joined to.
POLICY = (Edge("pol", "policy", "id", "polper.policyid", "left", where="pcpublicid IS NOT NULL"), Edge("a", "account", "id", "pol.accountid", "left"))
CONTEXTS = {
    "CHRG": context("chargeinstancecontext", Edge("chrg", "charge", "id", "cix.chargeid", below=(
        Edge("tac", "taccountcontainer", "id", "chrg.taccountcontainerid", needed=True),
        Edge("tc", "taccountcontainertype", "id", "tac.subtype", needed=True),
        Edge("polper", "policyperiod", "hiddentaccountcontainerid", "chrg.taccountcontainerid", "left", given="tc.typecode = 'PolTAcctContainer'"),
        *POLICY,
        Edge("ta", "account", "hiddentaccountcontainerid", "chrg.taccountcontainerid", "left", given="tc.typecode = 'AcctTAcctContainer'")))),
    "PROD": context(
        "producercontext",
        Edge("comm", "chargecommission", "id", "cix.chargecommissionid", "left"),
        Edge("chrg", "charge", "id", "comm.chargeid", "left"),
        Edge("polper", "policyperiod", "hiddentaccountcontainerid", "chrg.taccountcontainerid", "left"),
        *POLICY),
    "ACCT": context("accountcontext", Edge("acc", "account", "id", "cix.accountid")),
    "DBMR": context(
        "dbmoneyrcvdcontext",
        Edge("acc", "account", "id", "cix.accountid"),
        Edge("bsmr", "basemoneyreceived", "id", "cix.directbillmoneyrcvdid", "left"),
        Edge("polper", "policyperiod", "id", "bsmr.policyperiodid", "left")),
    "SUSPYMT": context(
        "susppymtcontext",
        Edge("spmt", "suspensepayment", "id", "cix.suspensepaymentid"),
        Edge("polper", "policyperiod", "id", "spmt.policyperiodappliedtoid", "left"),
        *POLICY),
    "TRANSFR": context(
        "transfertxcontext",
        Edge("sa", "account", "id", "cix.sourceaccountid", "left"),
        Edge("ta", "account", "id", "cix.targetaccountid", "left")),
    "NONRECV": context(
        "nonreceivableitemctx",
        Edge("bndi", "nonreceivabledistitem", "id", "cix.basenonreceivabledistitemid"),
        Edge("acc", "account", "id", "cix.accountwithsuspenseid", "left"),
        Edge("polper", "policyperiod", "id", "bndi.matchingpolicyid", "left")),
    "CREDIT": context("creditcontext", Edge("acc", "account", "id", "cix.accountid")),
}


def period_measures(kind: str) -> tuple[Measure, Measure]:
    """The month's and the year's amount, up to the window's end; as ranges, which a scan can use."""
    within = lambda since: lambda w: F.col("trans.transactiondate").between(instant(since(w)), instant(w.end))
    return tuple(Measure(f"{p}_BILL_{kind}_TRANS_AMT", "sum", "trans.amount", within(since), since) for p, since in (("MTD", month_start), ("YTD", year_start)))


def totals(tables: Mapping[str, DataFrame], windows: Sequence[Window]) -> DataFrame:
    """The totals of those tables that are given, each scanned once."""
    return recon.together([measured(tables[name], measures, windows) for name, measures in TOTALS.items() if name in tables])


def distributions(tables: Mapping[str, DataFrame], windows: Sequence[Window]) -> DataFrame:
    """TOTAL_BILL_DIST_CNT and TOTAL_BILL_DIST_WO_AMT: distributions that changed by the window's end, or one of whose items
    was processed by then. An item belongs to its active distribution, else to the one that it reverses; of the items that
    were made or changed within the window the latest processing counts, the time made where that is within the window."""
    made, changed = (lambda w, c=c: (F.col(c) > instant(w.start)) & (F.col(c) <= instant(w.end)) for c in ("createtime", "updatetime"))
    # a window's processing time: the greatest of the time made, if within it, else of the time changed, if that is
    each = [F.max(F.when(made(w), F.col("createtime")).when(changed(w), F.col("updatetime"))).alias(f"processed{j}") for j, w in enumerate(windows)]
    span = Window(0, min(w.start for w in windows), max(w.end for w in windows))  # a row that no window has gives nulls
    processed = tables["basedistitem"].where(made(span) | changed(span)).groupBy(F.coalesce("activedistid", "reverseddistid").alias("distid")).agg(*each)
    spec = JoinSpec("dist", "basedist", (Edge("item", "processed", "distid", "dist.id", "left", needed=True),))
    rows = joined(spec, {**tables, "processed": processed})
    place = {w: j for j, w in enumerate(windows)}
    when = lambda w: until("dist.updatetime", "dist.createtime", f"item.processed{place[w]}")(w)
    return measured(rows, (Measure("TOTAL_BILL_DIST_CNT", "distinct", "dist.publicid", when), Measure("TOTAL_BILL_DIST_WO_AMT", "sum", "dist.writeoffamount", when)), windows)


def periods(tables: Mapping[str, DataFrame], windows: Sequence[Window], kinds: Sequence[str] = tuple(CONTEXTS)) -> DataFrame:
    """MTD_ and YTD_BILL_<kind>_TRANS_AMT of those kinds whose tables are all given; a transaction counts once for each row
    of the join, so inner edges drop it and repeated keys multiply it."""
    given = [k for k in kinds if CONTEXTS[k].tables() <= tables.keys()]
    return recon.together([measured(joined(CONTEXTS[k], tables), period_measures(k), windows) for k in given])


def suite(tables: Mapping[str, DataFrame], windows: Sequence[Window]) -> DataFrame:
    """All metrics of the billing system: window, auditentity, auditfrom, auditthru, value, n_rows."""
    return recon.together([totals(tables, windows), distributions(tables, windows), periods(tables, windows)])


def load_cycles(cycles: DataFrame, system: str, kind: str, *, most: int = 32) -> list[Window]:
    """The windows of cycles(load_cycle_id, pv_startdate, pv_enddate, source_system_code, cycle_type_code). They become
    literals of one plan, so more than `most` are refused and none is left out."""
    mine = cycles.where((F.col("source_system_code") == system) & (F.col("cycle_type_code") == kind)).select("load_cycle_id", "pv_startdate", "pv_enddate").distinct()
    rows = mine.orderBy("load_cycle_id", "pv_enddate").take(most + 1)
    if len(rows) > most:
        raise ValueError(f"more than {most} load cycles of {system}: run them in several batches")
    return [Window(int(r["load_cycle_id"]), r["pv_startdate"], r["pv_enddate"]) for r in rows]


def by_load_cycle(tables: Mapping[str, DataFrame], cycles: Sequence[Window]) -> DataFrame:
    """The suite for each load cycle, as etl_load_cycle_id; here a metric without rows isn't there at all."""
    found = suite(tables, cycles).where("n_rows > 0")
    return found.select(F.col("window").alias("etl_load_cycle_id"), "auditentity", "auditfrom", "auditthru", "value")
