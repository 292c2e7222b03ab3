"""Schema drift of Parquet files, file by file, against what is declared (O-VLD-02, O-VLD-20).

Files are listed by Spark (names and sizes only) and their footers read by tasks, each the few
files that it got, through pyarrow's file systems; no data page is read and no schema is merged, so that a
table whose files disagree shows which ones do.  A file whose footer can't be read is a row with
its problem, not an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOOTERS = "path string, column_name string, column_type string, problem string"

# FIXED VALUES: the columns of the driver's tables that the library reads; those after the bar may be missing.
DECLARED = {
    "region": "r_regionkey r_name |",
    "nation": "n_nationkey n_name n_regionkey |",
    "customer": "c_custkey c_name c_nationkey c_mktsegment c_acctbal |",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal |",
    "part": "p_partkey p_size |",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority |",
    "lineitem": "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_returnflag l_linestatus l_shipdate |",
    "events": "event_id ts user_id event_type value |",
    "documents": "doc_id text lang | source n_chars",
    "labels": "doc_id quality | toxic",
    "conversations": "conv_id turn text | role",
}


def declared(spark: SparkSession, tables: dict[str, str] | None = None) -> DataFrame:
    """(table_name, column_name, optional) of declared columns."""
    rows = []
    for table, columns in (tables or DECLARED).items():
        needed, _, optional = columns.partition("|")
        rows += [(table, c, False) for c in needed.split()] + [(table, c, True) for c in optional.split()]
    return spark.createDataFrame(rows, "table_name string, column_name string, optional boolean")


def footers(files: DataFrame, parts: int = 64) -> DataFrame:
    """(path, column_name, column_type, problem): a row for each column of each file of ``files`` (path); one row
    with a problem for a file that can't be read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet
        from pyspark.sql.pandas.types import from_arrow_type
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                try:
                    system, name = fs.FileSystem.from_uri(path)
                    with system.open_input_file(name) as f:
                        schema = parquet.read_schema(f)
                    for field in schema:
                        try:
                            kind = from_arrow_type(field.type).simpleString()
                        except Exception:  # a type that Spark has no name for
                            kind = str(field.type)
                        rows.append((path, field.name, kind, None))
                except Exception as wrong:  # reported, whatever it is
                    rows.append((path, None, None, f"{type(wrong).__name__}: {str(wrong)[:200]}"))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows)],
                                                     names=["path", "column_name", "column_type", "problem"])

    return files.select("path").repartition(parts).mapInArrow(run, FOOTERS)


def list_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, path) of every Parquet file below ``folder``: the table is the file, or the folder of its parts, that is
    named ``<table>.parquet``."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
             .load(folder).select("path"))
    table = F.coalesce(F.nullif(F.regexp_extract("path", r"/([^/]+)\.parquet/[^/]+$", 1), F.lit("")),
                       F.regexp_extract("path", r"/([^/]+)\.parquet$", 1))
    return files.select(table.alias("table_name"), "path")


def drift(files: DataFrame, contract: DataFrame, parts: int = 64) -> DataFrame:
    """(table_name, column_name, column_type, status, n_files, example): how the files (table_name, path) of each
    declared table differ from ``contract`` (table_name, column_name, optional), a row for each column, type and
    status: ok, unexpected, missing (from n_files of the readable files; documented missing if it is optional),
    types (one of several in the table's files) or unreadable.  Tables without any file miss all their columns."""
    known = files.join(contract.select("table_name").distinct(), "table_name", "left_semi")
    read = known.join(footers(known, parts), "path")
    good = read.where(F.col("problem").isNull())
    readable = good.groupBy("table_name").agg(F.count_distinct("path").alias("files"))
    seen = good.groupBy("table_name", "column_name", "column_type").agg(
        F.count_distinct("path").alias("n_files"), F.min("path").alias("example"))
    kinds = seen.groupBy("table_name", "column_name").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n_files").alias("having"))
    status = F.when(F.col("optional").isNull(), "unexpected").when(F.col("kinds") > 1, "types").otherwise("ok")
    present = (seen.join(kinds, ["table_name", "column_name"]).join(contract, ["table_name", "column_name"], "left")
               .select("table_name", "column_name", "column_type", status.alias("status"), "n_files", "example"))
    absent = (contract.join(readable, "table_name", "left").join(kinds, ["table_name", "column_name"], "left")
              .withColumn("n_files", F.coalesce("files", F.lit(0)) - F.coalesce("having", F.lit(0)))
              .where((F.col("n_files") > 0) | F.col("files").isNull())
              .select("table_name", "column_name", F.lit(None).cast("string").alias("column_type"),
                      F.when(F.col("optional"), "documented missing").otherwise("missing").alias("status"), "n_files",
                      F.lit(None).cast("string").alias("example")))
    broken = read.where(F.col("problem").isNotNull()).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_files"), F.min(F.concat("path", F.lit(": "), "problem")).alias("example")).select(
        "table_name", F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("column_type"),
        F.lit("unreadable").alias("status"), "n_files", "example")
    return present.unionByName(absent).unionByName(broken)
