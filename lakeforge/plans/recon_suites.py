"""The reconciliation metrics of policy and claim systems, as suites over their tables.

Each suite returns auditentity, value and can be given for source and lake alike; recon.reconciled() compares them.
Tables are joined once for all metrics that share them, and all metrics of a join come from one scan of it.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.operators import recon
from lakeforge.operators.lookup import sized
from lakeforge.operators.recon import Metric

#: Type codes that decide what a policy period counts as.
IN_FORCE, CANCELLATION = "Bound", "Cancellation"
EXPIRING_JOBS = ("Submission", "Issuance", "Renewal", "Reinstatement", "Rewrite", "RewriteNewAccount", "Cancellation")
EXPIRING_STATES = ("Quoted", "Bound", "Canceling")
PREMIUM_STATES, PREMIUM_CHARGES = ("Bound", "AuditComplete"), ("Premium", "MCCA")
LIVE_TRANSACTION = 8


def with_code(df: DataFrame, column: str, types: DataFrame, name: str) -> DataFrame:
    """The type code of an id column, from a type list(id, typecode); rows of an unknown type are left out."""
    return df.join(sized(types.select(F.col("id").alias("__t"), F.col("typecode").alias(name))), F.col(column) == F.col("__t")).drop("__t")


@dataclass(frozen=True)
class PolicyTables:
    """policyperiod(id, policyid, jobid, status, policynumber, periodstart, periodend, cancellationdate, retired),
    policy(id, productcode), job(id, subtype, closedate) and the type lists of status and job."""

    period: DataFrame
    policy: DataFrame
    job: DataFrame
    status_types: DataFrame
    job_types: DataFrame

    def joined(self) -> DataFrame:
        """Periods with their job's and status's codes, and their policy's product; has_policy is null where there is none."""
        rows = self.period.join(self.policy.select(F.col("id").alias("policyid"), "productcode", F.lit(True).alias("has_policy")), "policyid", "left")
        rows = rows.join(self.job.select(F.col("id").alias("jobid"), "subtype", "closedate"), "jobid")
        return with_code(with_code(rows, "status", self.status_types, "state"), "subtype", self.job_types, "job_type")


def policy_counts(tables: PolicyTables, as_of: Column, *, products: Sequence[str] = (), all_but: Sequence[str] = (), live_only: bool = True, ended_of_all: bool = False) -> DataFrame:
    """TOTAL_INFORCE_<product>, TOTAL_EXPIRED and TOTAL_CANCELLED: distinct policy numbers as of an instant, of some
    products or of all but some. With live_only, retired periods don't count. With ended_of_all, the choice of products
    is for TOTAL_INFORCE alone: the other two count periods of any product, and of none."""
    rows, chosen = tables.joined().where(F.col("closedate") <= as_of), F.col("has_policy")
    if products:
        chosen &= F.col("productcode").isin(*products)
    if all_but:
        chosen &= ~F.col("productcode").isin(*all_but)
    if not ended_of_all:
        rows = rows.where(chosen)
    if live_only:
        rows = rows.where("retired = 0")
    state, job = F.col("state"), F.col("job_type")
    in_force = chosen & (job != CANCELLATION) & (state == IN_FORCE) & as_of.between(F.col("periodstart"), F.col("periodend"))
    expired = job.isin(*EXPIRING_JOBS) & state.isin(*EXPIRING_STATES) & (F.col("periodend") <= as_of) & (F.coalesce("policynumber", F.lit("")) != "")
    cancelled = (state == IN_FORCE) & (job == CANCELLATION) & (F.col("cancellationdate") <= as_of)
    # each period counts for the entities that it fits; one aggregation for all
    entities = F.array(F.when(in_force, F.concat(F.lit("TOTAL_INFORCE_"), F.col("productcode"))), F.when(expired, "TOTAL_EXPIRED"), F.when(cancelled, "TOTAL_CANCELLED"))
    each = rows.select("policynumber", F.explode(F.array_compact(entities)).alias("auditentity"))
    return each.groupBy("auditentity").agg(F.countDistinct("policynumber").cast("double").alias("value"))


def policy_premiums(tables: PolicyTables, transactions: DataFrame, costs: DataFrame, charge_types: DataFrame, line: str, as_of: Column) -> DataFrame:
    """YTD_<line>_PREM and ALL_<line>_PREM: premium billed, from transactions(branchid, cost, amountbilling,
    writtendate) and costs(id, chargepattern, feename); the year's months up to the instant's one count for YTD."""
    closed = tables.period.join(tables.job.where(F.col("closedate") <= as_of).select(F.col("id").alias("jobid")), "jobid")
    # premiums count whether or not the policy's row and the job's type are there
    periods = with_code(closed, "status", tables.status_types, "state").where(F.col("state").isin(*PREMIUM_STATES)).select(F.col("id").alias("branchid"))
    premium = with_code(costs.where("feename IS NULL"), "chargepattern", charge_types, "charge").where(F.col("charge").isin(*PREMIUM_CHARGES)).select(F.col("id").alias("cost"))
    rows = transactions.join(periods, "branchid").join(premium, "cost")
    written = F.col("writtendate")
    this_year = (F.year(written) == F.year(as_of)) & (F.month(written) <= F.month(as_of))
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("amountbilling").cast("decimal(20,2)"))), F.lit(0)).cast("double")
    wide = rows.agg(total(this_year).alias("ytd"), total(F.lit(True)).alias("all"))
    return wide.select(F.explode(F.array(*(F.struct(F.lit(f"{k.upper()}_{line}_PREM").alias("auditentity"), F.col(k).alias("value")) for k in ("ytd", "all")))).alias("x")).select("x.*")


def claim_metrics(claim: DataFrame, transaction: DataFrame, line_item: DataFrame, as_of: Column) -> DataFrame:
    """CLAIM_ID_CNT, CLAIM_NBR_CNT and {MTD,YTD,ALL}_LOSSAMT, from claim(id, claimnumber, createtime), transaction(id,
    claimid, createtime, updatetime, lifecyclestate, originalcreatedate) and line_item(transactionid,
    transactionamount, createtime)."""
    trans = transaction.where((F.col("createtime") <= as_of) & (F.col("updatetime") <= as_of) & (F.col("lifecyclestate") == LIVE_TRANSACTION)).select(F.col("claimid").alias("id")).distinct()
    live = claim.where(F.col("createtime") <= as_of).join(trans, "id", "left_semi").withColumn("__at", as_of)
    counts = recon.metrics(live, [Metric("CLAIM_ID_CNT", "distinct", "id", "__at"), Metric("CLAIM_NBR_CNT", "distinct", "claimnumber", "__at")], as_of)
    when = transaction.select(F.col("id").alias("transactionid"), F.coalesce("originalcreatedate", "createtime").alias("lossdate"))
    losses = line_item.where(F.col("createtime") < as_of).join(when, "transactionid").where(F.col("lossdate") < as_of)
    sums = recon.metrics(losses, [Metric(f"{kind}_LOSSAMT", how, "transactionamount", "lossdate") for kind, how in (("MTD", "mtd"), ("YTD", "ytd"), ("ALL", "sum"))], as_of)
    return counts.unionByName(sums)
