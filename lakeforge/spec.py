"""Declarative specs: tables, lookups, PII columns and job options, parsed by header name and validated.

All names and values are lower-cased and trimmed, as identifiers in the lake are.
"""
from __future__ import annotations

import re
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class TableSpec:
    table: str
    send_to_lake: str = "y"
    has_pii: str = "n"
    cdc_col: str = ""
    lookup_ref: str = ""
    hard_delete_flag: str = ""
    partition_by: str = ""
    num_partitions: int | None = None
    decrypt_cols: tuple[str, ...] = ()
    missing_where: str = ""  # SQL: which source rows can be missing at all (live ones, say); empty for all

    @property
    def cdc_kind(self) -> str:
        """timestamp, coalesce, greatest, number, month or none; from the spec's own words, never from a name's end
        alone: `paid` isn't an id."""
        c = self.cdc_col
        if not c or "truncate" in c:
            return "none"
        if c.startswith("coalesce("):
            return "coalesce"
        if "," in c:
            return "greatest"
        if c.endswith("yyyymm"):
            return "month"
        return "number" if c == "id" or c.endswith("_id") else "timestamp"

    @property
    def is_reference(self) -> bool:
        return self.lookup_ref == "typelist"


@dataclass(frozen=True)
class LookupSpec:
    """One lookup: main.source_col = ref.ref_col, and the reference's attributes under their harmonised names."""

    table: str
    source_col: str
    ref_col: str
    ref_table: str
    attributes: tuple[tuple[str, str], ...]  # (attribute of the reference, its name in the result)
    equals: tuple[tuple[str, str], ...] = ()  # reference column = literal
    nulls: tuple[str, ...] = ()  # reference columns that must be null


#: Modes that a job may name.
ALLOWED = {"load_type": {"tl", "di", "ci", "rb"}, "restartability_level": {"table", "batch"}, "partition_overwrite_mode": {"static", "dynamic"}, "missing_data_action": {"identify", "load", "both"}}


@dataclass(frozen=True)
class JobConfig:
    load_type: str = "di"
    consider_batch_window: str = "n"
    restartability_ind: str = "n"
    restartability_level: str = "table"
    hard_delete_batch: str = "n"
    stage_load_batch: str = "n"
    partition_overwrite_mode: str = "static"
    missing_data_action: str = "both"
    time_lag_in_mins: int = 0
    time_zone: str = "UTC"
    process_name: str = "lake"

    def __post_init__(self):
        for name, allowed in ALLOWED.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {sorted(allowed)}, not {getattr(self, name)!r}")


#: Header spellings (letters only) -> field.
HEADERS = {
    "table": "table", "tablename": "table", "sendtolake": "send_to_lake", "pii": "has_pii", "haspii": "has_pii", "cdccol": "cdc_col", "cdccolumn": "cdc_col",
    "lookupcolref": "lookup_ref", "lookupref": "lookup_ref", "harddeleteflag": "hard_delete_flag", "partitionby": "partition_by", "numpartitions": "num_partitions",
    "decrypt": "decrypt_cols", "decryptcol": "decrypt_cols", "decryptcols": "decrypt_cols", "missingwhere": "missing_where", "missingfilter": "missing_where",
}


def rows_of(text: str) -> list[dict[str, str]]:
    """Rows of a `|`-delimited text by header name (letters of it, lower case). Short rows end in empty fields."""
    lines = [x for x in text.splitlines() if x.strip()]
    if not lines:
        return []
    head = [re.sub(r"[^a-z]", "", h.lower()) for h in lines[0].split("|")]
    out = []
    for line in lines[1:]:
        cells = [c.strip().lower() for c in line.split("|")]
        out.append(dict(zip(head, cells + [""] * (len(head) - len(cells)))))
    return out


def table_specs(text: str) -> list[TableSpec]:
    """Specs of the tables that go to the lake. Unknown columns (rows, note) are ignored wherever they stand."""
    out = []
    for row in rows_of(text):
        known = {HEADERS[k]: v for k, v in row.items() if k in HEADERS}
        if known.get("send_to_lake", "y") != "y":
            continue
        known["num_partitions"] = int(known["num_partitions"]) if known.get("num_partitions", "").isdigit() else None
        known["decrypt_cols"] = tuple(x.strip() for x in known.get("decrypt_cols", "").split(",") if x.strip())
        out.append(TableSpec(**known))
    return out


def lookup_specs(text: str) -> list[LookupSpec]:
    out = []
    for row in rows_of(text):
        table, source, ref, ref_table, names, what = list(row.values())[:6]
        if what.startswith("select"):
            out.append(parse_lookup_sql(table, source, ref, ref_table, names, what))
        else:
            pairs = tuple(zip((x.strip() for x in what.split("/")), (x.strip() for x in names.split("/"))))
            out.append(LookupSpec(table, source, ref, ref_table, pairs))
    return out


def parse_lookup_sql(table: str, source: str, ref: str, ref_table: str, names: str, sql: str) -> LookupSpec:
    """A lookup given as `select a [as b], ... from t [where x = 'lit' and y is null ...]`. Anything else raises."""
    m = re.fullmatch(r"select\s+(?P<cols>.+?)\s+from\s+(?P<from>[\w.$]+)(?:\s+where\s+(?P<where>.+))?", sql.strip())
    if not m:
        raise ValueError(f"not a lookup query: {sql}")
    wanted = [x.strip() for x in names.split("/") if x.strip()]
    pairs = []
    for k, item in enumerate(m["cols"].split(",")):
        one = re.fullmatch(r"(\w+)(?:\s+as\s+(\w+)|\s+(\w+))?", item.strip())
        if not one:
            raise ValueError(f"not a column: {item}")
        pairs.append((one[1], one[2] or one[3] or (wanted[k] if k < len(wanted) else one[1])))
    equals, nulls = [], []
    for term in re.split(r"\s+and\s+", m["where"] or ""):
        if not term:
            continue
        if same := re.fullmatch(r"(\w+)\s*=\s*('[^']*'|-?\d+(?:\.\d+)?)", term.strip()):
            equals.append((same[1], same[2].strip("'")))
        elif null := re.fullmatch(r"(\w+)\s+is\s+null", term.strip()):
            nulls.append(null[1])
        else:
            raise ValueError(f"not a lookup condition: {term}")
    return LookupSpec(table, source, ref, ref_table, tuple(pairs), tuple(equals), tuple(nulls))


def pii_columns(text: str, lookups: list[LookupSpec] = ()) -> dict[str, set[str]]:
    """PII columns by table. A lookup's result column that a PII attribute of its reference feeds is PII too."""
    out: dict[str, set[str]] = {}
    for row in rows_of(text):
        table, column = list(row.values())[:2]
        out.setdefault(table, set()).add(column)
    for x in lookups:
        for attribute, name in x.attributes:
            if attribute in out.get(x.ref_table, ()):
                out.setdefault(x.table, set()).add(name)
    return out


def job_config(text: str) -> JobConfig:
    """`key:value` lines, split at the first colon; lines that are blank or begin with # or a tab are skipped. Keys are
    field names in any case, with or without underscores; an unknown key raises."""
    known = {f.name.replace("_", ""): f for f in fields(JobConfig)}
    values: dict[str, object] = {}
    for line in text.splitlines():
        if not line.strip() or line[0] in "#\t":
            continue
        key, _, value = line.partition(":")
        name = re.sub(r"[^a-z]", "", key.lower())
        if name not in known:
            raise ValueError(f"unknown property {key.strip()!r}")
        value = value.strip()
        values[known[name].name] = int(value) if known[name].type == "int" else value if name == "timezone" else value.lower()
    return JobConfig(**values)


@dataclass(frozen=True)
class StageTable:
    table: str
    full_load: bool


def stage_list(text: str) -> list[StageTable]:
    """`table` or `table|TL` lines; the suffix asks for a full load of that table."""
    return [StageTable(x.split("|")[0].strip().lower(), x.strip().lower().endswith("|tl")) for x in text.splitlines() if x.strip()]


@dataclass(frozen=True)
class KvMap:
    source: str
    target: str
    key: str
    source_keys: tuple[str, ...]
    sort_key: str = ""
    indexes: tuple[tuple[str, ...], ...] = field(default=())


def kv_maps(text: str) -> list[KvMap]:
    """`source->target->key->source keys (comma)->sort key->indexes (a|b,c)` lines."""
    out = []
    for line in filter(str.strip, text.splitlines()):
        p = [x.strip().lower() for x in line.split("->")] + [""] * 6
        out.append(KvMap(p[0], p[1], p[2], tuple(filter(None, p[3].split(","))), p[4], tuple(tuple(i.split("|")) for i in p[5].split(",") if i)))
    return out


def split_name(name: str) -> tuple[str, str, str]:
    """(db, schema, table) of a three-part name; brackets go and `-` in the database becomes `_`."""
    db, schema, table = name.lower().split(".", 2)
    return db.strip("[]").replace("-", "_"), schema.strip("[]"), table.strip("[]")
