"""Table schemas from template documents and from the catalog."""

import os

import pytest
from pyspark.sql.types import StructType

from tidelog.plans.maintain import compute_stats, recover_partitions, recreate_table, refresh
from tidelog.sources.schema import TableSpec, from_catalog, from_template, table_location

FIXTURES = os.path.join(os.path.dirname(__file__), "fixtures", "templates")

# A catalog table of one column more than the template.
DDL_COLUMNS = [f"Column{i:02d}" for i in range(25)]


def test_template_gives_27_fields(spark):
    spec = from_template("common", "visit_log", root=FIXTURES)
    assert len(spec.columns.fields) == 24
    assert spec.partition_names == ["dt", "appid", "storeid"]
    assert len(spec.row_schema.fields) == 27
    assert spec.location == "file:/data/common/visit_log_write"


def test_packaged_template(spark):
    spec = from_template("demo", "events")
    assert spec.field_list()[0] == (0, "eventid", "string", False)
    assert spec.field_list()[-1] == (7, "storeid", "string", True)


def test_document_roundtrip_and_types(spark):
    doc = {"columns": [{"name": "a", "type": "String"}, {"name": "b", "type": "decimal(10,2)"},
                       {"name": "c", "type": "array<string>"}],
           "partitions": [{"name": "dt", "type": "string"}], "locations": []}
    spec = TableSpec.from_document(doc)
    assert [f.dataType.simpleString() for f in spec.row_schema.fields] == [
        "string", "decimal(10,2)", "array<string>", "string"]
    assert TableSpec.from_document(spec.to_document()).row_schema == spec.row_schema


def _write_table(spark, tmp_root, name, cols):
    path = f"{tmp_root}/{name}"
    ddl = ", ".join(f"`{c}` string" for c in cols)
    spec = TableSpec.from_ddl(ddl, "dt string, appid string, storeid string")
    spark.sql(spec.create_table_sql(name, path))
    row = [f"v{i}" for i in range(len(cols))] + ["20240101", "007", "0905"]
    df = spark.createDataFrame([row], StructType.fromDDL(ddl + ", dt string, appid string, storeid string"))
    df.write.mode("append").partitionBy("dt", "appid", "storeid").parquet(path)
    return path


def test_catalog_schema_28_fields_once(spark, tmp_root):
    path = _write_table(spark, tmp_root, "visit_log_write", DDL_COLUMNS)
    spec = from_catalog(spark, "visit_log_write")
    assert len(spec.columns.fields) == 25 and spec.partition_names == ["dt", "appid", "storeid"]
    assert len(spec.row_schema.fields) == 28
    assert spec.location.rstrip("/").endswith(path.rstrip("/").split(":")[-1])
    assert table_location(spark, "visit_log_write") == spec.location


def test_recover_refresh_and_recreate(spark, tmp_root):
    path = _write_table(spark, tmp_root, "t_recover", ["a", "b"])
    assert spark.table("t_recover").count() == 0          # written by path: not registered yet
    recover_partitions(spark, "t_recover")
    refresh(spark, "t_recover")
    r = spark.table("t_recover").collect()[0]
    assert (r.appid, r.storeid) == ("007", "0905")        # partition values unchanged
    compute_stats(spark, "t_recover")
    spec = recreate_table(spark, "t_recover")
    assert spec.partition_names == ["dt", "appid", "storeid"]
    recover_partitions(spark, "t_recover")
    assert spark.table("t_recover").count() == 0          # folded data does not come back
    assert from_catalog(spark, "t_recover").row_schema == spec.row_schema
    assert os.path.isdir(path)


def test_create_table_sql(spark):
    spec = TableSpec.from_ddl("a string", "dt string")
    sql = spec.create_table_sql("db.t", "/x")
    assert sql == "CREATE TABLE db.t (`a` string, `dt` string) USING PARQUET PARTITIONED BY (`dt`) LOCATION '/x'"


def test_add_written_partitions_without_full_recovery(spark, tmp_root, events):
    from tidelog.plans.compact import compact
    from tidelog.plans.maintain import add_written_partitions, register_areas
    from tidelog.plans.table import LogicalTable
    from tidelog.sources.events_feed import EVENTS_SPEC, raw_log_dirty
    from tidelog.streaming.ingest import decode_and_derive, ingest_batch
    t = LogicalTable.create(spark, f"{tmp_root}/lt", EVENTS_SPEC)
    register_areas(t, "awp_write", "awp_read")
    rows = decode_and_derive(raw_log_dirty(events), t, tz="UTC")   # includes null dt rows
    ingest_batch(t, rows, "k1")
    n = rows.count()
    assert spark.table("awp_write").count() == 0
    found = add_written_partitions(t, "awp_write", key="k1")
    assert found > 0
    assert spark.table("awp_write").count() == n
    assert spark.table("awp_write").where("dt is null").count() == rows.where("dt is null").count() > 0
    res = compact(t, catalog_table="awp_read", analyze=True)
    assert spark.table("awp_read").count() == n
    parts = spark.sql(f"SHOW PARTITIONS awp_read").collect()
    assert len(parts) > 0 and all(res.gen in r[0] for r in parts)
    desc = spark.sql(f"DESCRIBE EXTENDED awp_read PARTITION ({parts[0][0].replace('/', ', ').replace('=', '=' + chr(39)).replace(', ', chr(39) + ', ')}')")
    stats = [r.data_type for r in desc.collect() if r.col_name == "Partition Statistics"]
    assert stats and "rows" in stats[0]
    ingest_batch(t, rows, "k2", catalog_table="awp_write")
    assert spark.table("awp_write").count() == 2 * n


def test_recreate_loses_nothing_when_it_dies(spark, tmp_root, monkeypatch):
    from tidelog.plans import fs
    spec = TableSpec.from_ddl("a int", "dt string")
    path = f"{tmp_root}/t_dies"
    spark.createDataFrame([(1, "x"), (2, "y")], "a int, dt string").write.partitionBy("dt").parquet(path)
    spark.sql(spec.create_table_sql("t_dies", path))
    spark.sql(spec.create_table_sql("t_dies__kept", path))      # a user's table
    recover_partitions(spark, "t_dies")

    def fails(*_):
        raise OSError("crash")
    with monkeypatch.context() as m:
        m.setattr(fs, "delete", fails)
        with pytest.raises(OSError):
            recreate_table(spark, "t_dies")
    recover_partitions(spark, "t_dies")
    assert spark.table("t_dies").count() == 2       # the definition stands, the files too
    recreate_table(spark, "t_dies")
    recover_partitions(spark, "t_dies")
    assert spark.table("t_dies").count() == 0 and spark.catalog.tableExists("t_dies__kept")
    for t in [r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith("t_dies")]:
        spark.sql(f"DROP TABLE {t}")
