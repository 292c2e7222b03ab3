"""The SQL surface runs queries and nothing else."""

from __future__ import annotations

import pytest

from tenderlake.context import Lake
from tenderlake.plans.interactive import sql_over_views
from tenderlake.sources.catalog import read_only


@pytest.mark.parametrize("statement", [
    "SELECT 1", "WITH a AS (SELECT 1 AS x) SELECT * FROM a WHERE x IN (SELECT max(x) FROM a)",
    "SELECT n_name FROM nation UNION ALL SELECT r_name FROM region ORDER BY 1 LIMIT 3", "VALUES (1, 2)",
    "SELECT 'DROP TABLE x; reflect(a)' AS text"])
def test_queries_pass(spark, statement):
    read_only(spark, statement)


@pytest.mark.parametrize("statement", [
    "DROP TABLE nation", "CREATE TABLE t AS SELECT 1", "INSERT INTO t SELECT 1", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a",
    "INSERT OVERWRITE DIRECTORY '/tmp/x' USING parquet SELECT 1", "SET spark.sql.ansi.enabled=false", "CACHE TABLE nation", "SELECT 1; DROP TABLE t",
    "CREATE TEMP VIEW v AS SELECT 1", "TRUNCATE TABLE t", "MERGE INTO a USING b ON a.x = b.x WHEN MATCHED THEN DELETE", "DELETE FROM t",
    "FROM nation INSERT INTO t SELECT n_name", "SELECT reflect('java.lang.System', 'exit', 1)", "ADD JAR '/x.jar'", "nonsense",
    "SELECT * FROM (SELECT TRANSFORM(n_name) USING 'cat' AS x FROM nation)", "SELECT * FROM parquet.`/root/x.parquet`",
    "SELECT (SELECT java_method('java.lang.System', 'getenv', 'HOME')) AS home", ""])
def test_anything_else_is_refused(spark, statement):
    with pytest.raises(ValueError):
        read_only(spark, statement)


def test_refused_before_anything_is_registered(spark):
    with pytest.raises(ValueError):
        sql_over_views(Lake.get(spark, "/root/testdata/sf0.001"), "DROP VIEW IF EXISTS nation")
