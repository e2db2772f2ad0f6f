import pytest

from lakeforge import spec


@pytest.mark.parametrize("head, row", [
    ("TableName|SendToLake|PII|CDCCol|LookUpColRef|HardDeleteFlag|PartitionBy|NumPartitions|Rows|Note", "DB.DBO.Orders|Y|Y|UpdateTime|y|id|ID|12|99|x"),
    ("TableName|SendToLake|PII|CDCCol|LookUpColRef|HardDeleteFlag|PartitionBy|Rows|Note", "DB.DBO.Orders|Y|Y|UpdateTime|y|id|ID|99|x"),
    ("TableName|SendToLake|PII|CDCCol|LookUpColRef|HardDeleteFlag|PartitionBy|NumPartitions|Decrypt|Rows|Note", "DB.DBO.Orders|Y|Y|UpdateTime|y|id|ID|12|a,b|99|x"),
])
def test_header_shapes(head, row):
    (s,) = spec.table_specs(f"{head}\n{row}\nDB.DBO.Other|N|||||||")
    assert (s.table, s.cdc_col, s.hard_delete_flag, s.cdc_kind) == ("db.dbo.orders", "updatetime", "id", "timestamp")
    assert s.num_partitions == (12 if "NumPartitions" in head else None)
    assert s.decrypt_cols == (("a", "b") if "Decrypt" in head else ())


def test_cdc_kinds():
    kinds = {"id": "number", "claim_id": "number", "paid": "timestamp", "load_yyyymm": "month", "coalesce(a,b)": "coalesce", "a,b": "greatest", "": "none"}
    assert {c: spec.TableSpec("t", cdc_col=c).cdc_kind for c in kinds} == kinds


def test_lookup_forms():
    text = "t|s|r|rt|names|what\nmain|a|id|types|x/y|name/code\nmain|b|id|types|z|select name from types where kind = 'k' and retired is null"
    one, two = spec.lookup_specs(text)
    assert one.attributes == (("name", "x"), ("code", "y"))
    assert (two.attributes, two.equals, two.nulls) == ((("name", "z"),), (("kind", "k"),), ("retired",))
    with pytest.raises(ValueError):
        spec.lookup_specs("t|s|r|rt|names|what\nm|a|id|types|x|select name from types where a < 3")


def test_pii_follows_lookups():
    lookups = spec.lookup_specs("t|s|r|rt|names|what\nmain|a|id|people|owner/code|name/code")
    assert spec.pii_columns("table|column\npeople|name\nmain|phone", lookups) == {"people": {"name"}, "main": {"phone", "owner"}}


def test_properties():
    c = spec.job_config("# note\n\tskipped\n\nloadType:DI\ntimeLagInMins: 5\ntimeZone:America/New_York\nprocessName:a:b")
    assert (c.load_type, c.time_lag_in_mins, c.time_zone, c.process_name) == ("di", 5, "America/New_York", "a:b")
    for bad in ("restatabilityLevel:table", "loadType:XX"):
        with pytest.raises(ValueError):
            spec.job_config(bad)


def test_other_lists():
    assert spec.stage_list("A\nB|TL\n") == [spec.StageTable("a", False), spec.StageTable("b", True)]
    (m,) = spec.kv_maps("src->dst->k->a,b->s->x|y,z")
    assert (m.source_keys, m.sort_key, m.indexes) == (("a", "b"), "s", (("x", "y"), ("z",)))
    assert spec.split_name("[DB-1].dbo.T") == ("db_1", "dbo", "t")
