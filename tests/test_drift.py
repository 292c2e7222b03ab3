"""Drifted and broken files show up file by file."""

from __future__ import annotations

from tenderlake.sources import drift as D


def test_drift_of_single_files(spark, tmp_path):
    folder = tmp_path / "lake"
    ok = spark.createDataFrame([(1, "a", 2.0)], "id long, name string, value double")
    ok.coalesce(1).write.parquet(str(folder / "orders.parquet"))
    ok.drop("name").selectExpr("id", "CAST(value AS string) AS value", "1 AS extra").coalesce(1).write.mode("append").parquet(str(folder / "orders.parquet"))
    (folder / "orders.parquet" / "part-broken.parquet").write_bytes(b"not parquet")
    ok.coalesce(1).write.parquet(str(folder / "other.parquet"))
    contract = D.declared(spark, {"orders": "id name value | note", "gone": "id |"})
    got = {(r.table_name, r.column_name, r.column_type): (r.status, r.n_files)
           for r in D.drift(D.list_parquet(spark, str(folder)), contract, parts=3).collect()}
    assert got == {
        ("orders", "id", "bigint"): ("ok", 2), ("orders", "name", "string"): ("ok", 1), ("orders", "name", None): ("missing", 1),
        ("orders", "value", "double"): ("types", 1), ("orders", "value", "string"): ("types", 1), ("orders", "extra", "int"): ("unexpected", 1),
        ("orders", "note", None): ("documented missing", 2), ("orders", None, None): ("unreadable", 1), ("gone", "id", None): ("missing", 0)}


def test_given_tables_have_what_is_declared(spark):
    found = D.drift(D.list_parquet(spark, "/root/testdata/sf0.001"), D.declared(spark), parts=4)
    assert found.where("status NOT IN ('ok', 'unexpected')").count() == 0
    assert found.where("status = 'ok'").count() == D.declared(spark).count()
