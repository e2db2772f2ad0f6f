"""Sources that are read through real drivers, catalogs and schemas."""
import pytest

from lakeforge.sources import files, jdbc, sinks

XSD = '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="{tag}"><xs:complexType><xs:sequence><xs:element name="claim" type="xs:string"/><xs:element name="{number}" type="xs:integer"/></xs:sequence></xs:complexType></xs:element></xs:schema>'


def test_jdbc_read_in_ranges(spark):
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "url": "jdbc:derby:memory:lakeforge;create=true", "user": "", "password": ""}
    spark.range(100).selectExpr("id", "id % 7 AS v").write.format("jdbc").options(**options).option("dbtable", "orders").mode("overwrite").save()
    df = jdbc.read(spark, jdbc.ranged(options, 'SELECT "id", "v" FROM orders', "id", 0, 100, partitions=4))
    assert df.rdd.getNumPartitions() == 4
    some = df.where("v = 3 AND id < 50")
    assert sorted(r.id for r in some.collect()) == [i for i in range(50) if i % 7 == 3]
    assert "EqualTo(v,3)" in some._jdf.queryExecution().executedPlan().toString().replace("*", "")
    whole = jdbc.read(spark, jdbc.ranged(options, 'SELECT "id" FROM orders', None))
    assert whole.rdd.getNumPartitions() == 1 and whole.count() == 100


def test_catalog_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "m1"), (2, "b", "m2")], "id long, v string, month string")
    path = str(tmp_path / "plain")
    sinks.write_partitioned(rows, path, ["month"], "overwrite")
    for statement in sinks.create_statements("plain_copy", path, rows, ["month"]):
        spark.sql(statement)
    try:
        assert files.table(spark, "secured_copy", "plain_copy").count() == 2
        sinks.write_partitioned(rows.selectExpr("id + 2 AS id", "v", "'m3' AS month"), path, ["month"])
        spark.sql(sinks.create_statements("plain_copy", path, rows, ["month"])[1])
        assert sorted(r.id for r in spark.table("plain_copy").collect()) == [1, 2, 3, 4]
        rows.limit(1).write.saveAsTable("secured_copy")
        assert files.table(spark, "secured_copy", "plain_copy").count() == 1
        with pytest.raises(Exception, match="no_such_copy"):
            files.table(spark, "no_such_copy")
    finally:
        spark.sql("DROP TABLE IF EXISTS plain_copy")
        spark.sql("DROP TABLE IF EXISTS secured_copy")


def test_xsd_rejects_documents(spark, tmp_path):
    """A document that one kind's XSD rejects is tried as the other kind."""
    (tmp_path / "in").mkdir()
    for name, text in {"a": "<doc><claim>c1</claim><total>5</total></doc>", "b": "<doc><claim>c2</claim><total>five</total></doc>", "c": "<doc><claim>c3</claim><pages>7</pages></doc>"}.items():
        (tmp_path / "in" / f"{name}.xml").write_text(text)
    found = {}
    for number in ("total", "pages"):
        (tmp_path / f"{number}.xsd").write_text(XSD.format(tag="doc", number=number))
        docs = files.xml(spark, str(tmp_path / "in"), "doc", f"claim string, {number} long, _corrupt_record string", str(tmp_path / f"{number}.xsd")).cache()
        found[number] = {r.source_file[-5:]: (r.claim, r[number], r._corrupt_record is None) for r in docs.collect()}
        docs.unpersist()
    assert found["total"]["a.xml"] == ("c1", 5, True) and found["pages"]["c.xml"] == ("c3", 7, True)
    assert [k for k in sorted(found["total"]) if not (found["total"][k][2] or found["pages"][k][2])] == ["b.xml"]
