"""Nested documents as flat tables: one row for each repeated element, absent attributes as empty texts."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.functions.xml_groups import groups_at_any_depth
from lakeforge.operators.durable import durable

NOTIFICATION = """claim string, transaction_id string, recipients string,
  control struct<_stamp:string,_type:string>,
  contacts struct<contact:array<struct<_name:string,methods:struct<phone:array<struct<_number:string,_type:string>>,email:array<struct<_address:string>>>>>>"""
ESTIMATE = """claim string, total string,
  coverages struct<coverage:array<struct<_name:string,_amount:string>>>,
  attachments struct<attachment:array<struct<_file:string>>>,
  groups struct<node:array<struct<_id:string,_parent:string,_name:string>>>,
  items struct<item:array<struct<_group:string,_text:string,_amount:string>>>"""


def or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def header(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row a document: result name -> path."""
    return df.select("source_file", *(or_empty(F.col(p)).alias(n) for n, p in columns.items()))


def children(df: DataFrame, path: str, columns: dict[str, str], keys: dict[str, str], *, blank: bool = False) -> DataFrame:
    """One row for each element of the array at path: keys of the document, then name -> field of the element. With
    blank, a document without elements has one row of empty texts."""
    explode = F.explode_outer if blank else F.explode
    rows = df.select("source_file", *(or_empty(F.col(p)).alias(n) for n, p in keys.items()), explode(F.col(path)).alias("e"))
    return rows.select("source_file", *keys, *(or_empty(F.col(f"e.{p}")).alias(n) for n, p in columns.items()))


def notification_tables(df: DataFrame) -> dict[str, DataFrame]:
    keys = {"claim": "claim", "transaction_id": "transaction_id"}
    contact = df.select("source_file", "claim", "transaction_id", F.explode_outer("contacts.contact").alias("c"))
    return {
        "header": header(df, keys | {"recipients": "recipients", "control_stamp": "control._stamp", "control_type": "control._type"}),
        "phone": children(contact, "c.methods.phone", {"number": "_number", "kind": "_type"}, keys | {"contact": "c._name"}, blank=True),
        "email": children(contact, "c.methods.email", {"address": "_address"}, keys | {"contact": "c._name"}, blank=True),
    }


def estimate_tables(df: DataFrame) -> dict[str, DataFrame]:
    keys = {"claim": "claim"}
    return {
        "header": header(df, {"claim": "claim", "total": "total"}),
        "coverage": children(df, "coverages.coverage", {"name": "_name", "amount": "_amount"}, keys),
        "attachment": children(df, "attachments.attachment", {"file": "_file"}, keys),
        "group": children(df, "groups.node", {"id": "_id", "parent": "_parent", "name": "_name"}, keys),
        "item": children(df, "items.item", {"group": "_group", "text": "_text", "amount": "_amount"}, keys),
    }


def lineage(nodes: DataFrame, keys: Sequence[str] = (), *, separator: str = " || ") -> DataFrame:
    """keys, id, lineage, depth of a forest nodes(keys..., id, parent, name): names from the root down, at any depth.

    Each round doubles how far a node looks up, so a tree of depth d takes log2(d) rounds. First with ids alone, which tells
    the nodes that reach a root from those under a parent that isn't there or in a circle, which are left out; then with
    names."""
    own = [*keys, "id"]
    above = F.when(F.col("parent") != "", F.col("parent")).alias("up")
    at = durable(nodes.select(*own, above, F.lit(1).cast("long").alias("depth")))
    most, far = nodes.count(), 1
    while not at.where("up IS NOT NULL").isEmpty() and far <= 2 * most:
        at, far = durable(higher(at, keys, {"depth": F.col("depth") + F.col("far_depth")})), 2 * far
    at = at.where("up IS NULL").select(*own, "depth")
    deepest = at.agg(F.max("depth")).first()[0] or 1
    rows = nodes.join(at, own, "left_semi").select(*own, above, F.col("name").alias("lineage"))
    for _ in range((deepest - 1).bit_length()):
        rows = durable(higher(rows, keys, {"lineage": F.when(F.col("far_lineage").isNull(), F.col("lineage")).otherwise(F.concat("far_lineage", F.lit(separator), "lineage"))}))
    return rows.select(*own, "lineage").join(at, own).select(*own, "lineage", F.col("depth").cast("int").alias("depth"))


def higher(at: DataFrame, keys: Sequence[str], put: dict[str, Column]) -> DataFrame:
    """at(keys..., id, up, ...) with what `up` has put together with each row's own, and that row's `up` in place of its;
    rows at a root (up is null) stay, those whose `up` isn't there go."""
    own = [c for c in at.columns if c not in keys]
    there = at.select(*keys, *(F.col(c).alias(f"far_{c}") for c in own))
    match = F.col("a.up") == F.col("b.far_id")
    for k in keys:
        match &= F.col(f"a.{k}") == F.col(f"b.{k}")
    met = at.where("up IS NOT NULL").alias("a").join(there.alias("b"), match).select(*(F.col(f"a.{c}").alias(c) for c in at.columns), *(F.col(f"b.far_{c}").alias(f"far_{c}") for c in own))
    return met.withColumns(put | {"up": F.col("far_up")}).select(at.columns).unionByName(at.where("up IS NULL"))


def items_with_lineage(tables: dict[str, DataFrame]) -> DataFrame:
    """Line items with the lineage of the group that they are in; an item of no known group has an empty one."""
    tree = lineage(tables["group"], ["source_file", "claim"]).select("source_file", "claim", F.col("id").alias("group"), "lineage", "depth")
    return tables["item"].join(tree, ["source_file", "claim", "group"], "left").withColumn("lineage", F.coalesce("lineage", F.lit("")))


def run_summary(parsed: DataFrame) -> DataFrame:
    """One row: documents, and how many of them couldn't be parsed."""
    return parsed.agg(F.count("*").alias("documents"), F.count("_corrupt_record").alias("failures"))


ADDRESS = "struct<_type:string,_street:string,_city:string,_state:string,_postal:string>"
PHONE = "struct<_type:string,_number:string>"
CONTACTS = f"contacts struct<contact:array<struct<_id:string,_type:string,_name:string,addresses:struct<address:array<{ADDRESS}>>,phones:struct<phone:array<{PHONE}>>,emails:struct<email:array<struct<_address:string>>>>>>"
CARRIER_ESTIMATE = f"""claim string, policy string, transaction_id string, total string, {CONTACTS},
  coverages struct<coverage:array<struct<_id:string,_name:string,_type:string,_deductible:string,_limit:string,_reserve:string>>>,
  attachments struct<attachment:array<struct<_file:string,_kind:string,_date:string,_text:string>>>,
  control_points struct<control_point:array<struct<_stamp:string,_type:string>>>,
  minimums struct<minimum:array<struct<_id:string,_category:string,_text:string,_amount:string>>>"""
GROUP_FIELDS = "items:struct<item:array<struct<_line:string,_text:string,_quantity:string,_total:string>>>,room:struct<_walls:string,_ceiling:string,_floor:string,_perimeter:string>,totals:struct<_acv:string,_rcv:string,_tax:string,_total:string>"
RECAP_FIELDS = "_items:string,_subtotal:string,coverages:struct<coverage:array<struct<_name:string,_amount:string>>>"


def nested(fields: str, levels: int) -> str:
    """The type of groups in groups; below the last level, what is there stays as text."""
    inner = "array<string>"
    for _ in range(levels):
        inner = f"array<struct<_name:string,{fields},group:{inner}>>"
    return inner


def rough_draft_schema(levels: int = 8) -> str:
    """With levels 0, of the documents without their groups, which groups_at_any_depth() reads."""
    grouped = f""",
  groups struct<group:{nested(GROUP_FIELDS, levels)}>, recap struct<group:{nested(RECAP_FIELDS, levels)}>""" if levels else ""
    return f"""claim string, transaction_id string, created string, {CONTACTS},
  coversheet struct<addresses:struct<address:array<{ADDRESS}>>,phones:struct<phone:array<{PHONE}>>>,
  coverages struct<coverage:array<struct<_id:string,_name:string,_type:string,_deductible:string>>>{grouped}"""


def walked(df: DataFrame, path: str, fields: Sequence[str], keys: dict[str, str], *, levels: int = 8, separator: str = " || ") -> DataFrame:
    """One row for each group at any depth of the groups in groups at path: keys, lineage (names from the outermost
    group inwards), depth, fields. The walk is within each document's row, so documents are read once. A document
    whose groups go deeper than the schema's levels raises: none is left out silently."""
    rows = df.select("source_file", *(or_empty(F.col(p)).alias(n) for n, p in keys.items()), F.col(path).alias("__g"))
    none = lambda kind: F.array().cast(kind)
    kept = lambda g, lineage, depth: F.struct(lineage.alias("lineage"), F.lit(depth).alias("depth"), *(g[f].alias(f) for f in fields))
    step = lambda g, lineage, depth: F.struct(kept(g, lineage, depth).alias("own"), g["group"].alias("sub"))
    rows = rows.withColumn("__l", F.transform("__g", lambda g: step(g, or_empty(g["_name"]), 1))).drop("__g")
    found = rows.withColumn("__all", F.transform("__l", lambda x: x["own"]))
    for depth in range(2, levels + 1):
        below = F.flatten(F.transform("__l", lambda x: F.transform(x["sub"], lambda g: step(g, F.concat(x["own"]["lineage"], F.lit(separator), or_empty(g["_name"])), depth))))  # noqa: B023
        # a group without groups has a null list, and flatten() of a null is null
        found = found.withColumn("__l", F.filter("__l", lambda x: x["sub"].isNotNull())).withColumn("__l", below)
        kind = found.schema["__all"].dataType
        found = found.withColumn("__all", F.concat(F.coalesce("__all", none(kind)), F.coalesce(F.transform("__l", lambda x: x["own"]), none(kind))))
    deeper = F.exists("__l", lambda x: F.size(F.coalesce(x["sub"], F.array().cast("array<string>"))) > 0)
    checked = F.when(F.coalesce(deeper, F.lit(False)), F.raise_error(F.lit(f"deeper than {levels} levels")).cast(found.schema["__all"].dataType)).otherwise(F.col("__all"))
    return found.select("source_file", *keys, F.explode(checked).alias("g")).select("source_file", *keys, "g.*")


def contact_tables(df: DataFrame, keys: dict[str, str]) -> dict[str, DataFrame]:
    contact = df.select("source_file", *(or_empty(F.col(p)).alias(n) for n, p in keys.items()), F.explode("contacts.contact").alias("c"))
    own = {n: n for n in keys} | {"contact_id": "c._id"}
    return {
        "contact": children(df, "contacts.contact", {"contact_id": "_id", "kind": "_type", "name": "_name"}, keys),
        "address": children(contact, "c.addresses.address", {"kind": "_type", "street": "_street", "city": "_city", "state": "_state", "postal": "_postal"}, own),
        "phone": children(contact, "c.phones.phone", {"kind": "_type", "number": "_number"}, own),
        "email": children(contact, "c.emails.email", {"address": "_address"}, own),
    }


def carrier_estimate_tables(df: DataFrame) -> dict[str, DataFrame]:
    """The flat tables of estimates as carriers get them."""
    keys = {"claim": "claim", "transaction_id": "transaction_id"}
    return contact_tables(df, keys) | {
        "header": header(df, keys | {"policy": "policy", "total": "total"}),
        "coverage": children(df, "coverages.coverage", {"id": "_id", "name": "_name", "kind": "_type", "deductible": "_deductible", "policy_limit": "_limit", "reserve": "_reserve"}, keys | {"policy": "policy"}),
        "attachment": children(df, "attachments.attachment", {"file": "_file", "kind": "_kind", "date": "_date", "text": "_text"}, keys),
        "control_point": children(df, "control_points.control_point", {"stamp": "_stamp", "kind": "_type"}, keys),
        "minimum": children(df, "minimums.minimum", {"id": "_id", "category": "_category", "text": "_text", "amount": "_amount"}, keys),
    }


def rough_draft_tables(df: DataFrame, levels: int = 8, raw: DataFrame | None = None) -> dict[str, DataFrame]:
    """The flat tables of rough drafts; line items, rooms and totals carry the lineage of their group. With raw(value,
    source_file), the documents' texts, groups are read from these at any depth; else from df, `levels` deep at most."""
    keys = {"claim": "claim", "transaction_id": "transaction_id"}
    place = {"kind": "_type", "street": "_street", "city": "_city", "state": "_state", "postal": "_postal"}
    if raw is None:
        groups = walked(df, "groups.group", ["items", "room", "totals"], keys, levels=levels)
        recap = walked(df, "recap.group", ["_items", "_subtotal", "coverages"], keys, levels=levels)
    else:
        groups = groups_at_any_depth(raw, "groups.group", GROUP_FIELDS, list(keys))
        recap = groups_at_any_depth(raw, "recap.group", RECAP_FIELDS, list(keys))
    dimensions = ("acv", "rcv", "tax", "total")
    by_claim = header(groups.where("totals IS NOT NULL AND depth = 1"), {n: n for n in keys} | {n: f"totals._{n}" for n in dimensions})
    own = {n: n for n in keys} | {"lineage": "lineage", "depth": "depth"}
    return contact_tables(df, keys) | {
        "header": header(df, keys | {"created": "created"}),
        "coversheet_address": children(df, "coversheet.addresses.address", place, keys),
        "coversheet_phone": children(df, "coversheet.phones.phone", {"kind": "_type", "number": "_number"}, keys),
        "coverage": children(df, "coverages.coverage", {"id": "_id", "name": "_name", "kind": "_type", "deductible": "_deductible"}, keys),
        "item": children(groups, "items.item", {"line": "_line", "text": "_text", "quantity": "_quantity", "total": "_total"}, own),
        "room": header(groups.where("room IS NOT NULL"), own | {"walls": "room._walls", "ceiling": "room._ceiling", "floor": "room._floor", "perimeter": "room._perimeter"}),
        "totals": header(groups.where("totals IS NOT NULL"), own | {"acv": "totals._acv", "rcv": "totals._rcv", "tax": "totals._tax", "total": "totals._total"}),
        "dimension_totals": by_claim.groupBy("source_file", *keys).agg(*(F.sum(F.expr(f"try_cast(nullif({n}, '') AS decimal(20,2))")).alias(n) for n in dimensions)),
        "recap": children(recap.withColumns({"__i": F.col("_items"), "__s": F.col("_subtotal")}), "coverages.coverage", {"coverage": "_name", "amount": "_amount"}, own | {"items": "__i", "subtotal": "__s"}, blank=True),
    }


def parse_failures(parsed: DataFrame, kind: str, at: str) -> DataFrame:
    """error_time, kind, source_file of the documents that couldn't be parsed."""
    return parsed.where("_corrupt_record IS NOT NULL").select(F.lit(at).alias("error_time"), F.lit(kind).alias("kind"), "source_file")


def kinds_summary(parsed: dict[str, DataFrame], started: str, ended: str) -> DataFrame:
    """One row of a run over several kinds of documents: <kind>_successes, <kind>_failures, documents. A file that is
    tried as two kinds counts in both."""
    one = None
    for kind, df in sorted(parsed.items()):
        own = df.agg(F.count(F.when(F.col("_corrupt_record").isNull(), 1)).alias(f"{kind}_successes"), F.count("_corrupt_record").alias(f"{kind}_failures"))
        one = own if one is None else one.join(F.broadcast(own))
    counts = [c for c in one.columns if c.endswith(("_successes", "_failures"))]
    return one.select(F.lit(started).alias("started"), F.lit(ended).alias("ended"), *counts, sum((F.col(c) for c in counts), F.lit(0)).alias("documents"))
