"""Table discovery and the SQL surface.

* ``discover``: every ``*.parquet`` under a folder, found with the
  ``binaryFile`` listing (path / size / mtime only; the content column is
  pruned), as (table_name, path, modification_time, length).
* ``register_views``: raw tables, silver and gold layers as temp views, so
  users ask questions with ``spark.sql`` (no expression ``eval``).
* ``read_only``: refuses statements that are more than one query over registered names.
* ``newest``: the most recently modified of several candidate files.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SILVER = ["notices", "lots", "organisations", "cpv_codes", "lot_results", "contracts", "tendering_parties", "tenders"]
GOLD = ["gold_notices", "gold_lots", "gold_awards", "gold_opportunities", "gold_notice_awards", "gold_country_kpis",
        "gold_cpv_kpis", "gold_market_summary", "gold_cpv_analysis"]


def discover(spark: SparkSession, folder: str) -> DataFrame:
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(folder).select("path", "modificationTime", "length"))
    return files.select(F.regexp_extract("path", r"([^/]+)\.parquet$", 1).alias("table_name"),
                        F.col("path"), F.col("modificationTime").alias("modification_time"), "length")


def newest(spark: SparkSession, folder: str, names: list[str] | None = None) -> DataFrame:
    """Newest (by modification time) of the candidate files; ties by path."""
    d = discover(spark, folder)
    if names:
        d = d.where(F.col("table_name").isin(*names))
    return d.agg(F.max_by(F.struct("table_name", "path", "modification_time"),
                          F.struct("modification_time", "path")).alias("n")).select("n.*")


#: Functions that call any Java method by name.
_CALLS_OUT = {"reflect", "java_method", "try_reflect"}


def read_only(spark: SparkSession, statement: str) -> None:
    """Raises ValueError unless ``statement`` is a single query that reads registered names only: Spark's own
    parser makes its plan, and commands, inserts, scripts, files named as tables and calls of Java methods are
    refused wherever they stand in it."""
    from pyspark.errors import ParseException
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    except ParseException as wrong:
        raise ValueError(f"not one SQL query: {str(wrong).splitlines()[0]}") from None
    except Exception as wrong:  # the gateway's error, where it isn't converted
        raise ValueError(f"not one SQL query: {str(wrong).splitlines()[0]}") from None
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    command = loader.loadClass("org.apache.spark.sql.catalyst.plans.logical.Command")
    statements = loader.loadClass("org.apache.spark.sql.catalyst.plans.logical.ParsedStatement")
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        if command.isInstance(node) or statements.isInstance(node) or node.nodeName().startswith("Insert"):
            raise ValueError(f"only queries are run, not {node.nodeName()}")
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    text = plan.toString()
    if "ScriptTransform" in text:
        raise ValueError("scripts are not run")
    called = {f.lower() for f in re.findall(r"'+(\w+)\(", text)} & _CALLS_OUT
    if called:
        raise ValueError(f"not allowed: {', '.join(sorted(called))}")
    for name in re.findall(r"UnresolvedRelation \[([^\]]*)\]", text):
        if "," in name:
            raise ValueError(f"only registered names are read, not {name}")


def register_views(lake, prefix: str = "", statement: str | None = None) -> list[str]:
    """Register raw tables, silver (``silver_*``) and gold marts as temp views;
    with ``statement``, only those whose names occur in it, so that no other layer is built."""
    from .tables import TABLES
    makers = {**{f"{prefix}{t}": partial(lake.table, t) for t in TABLES},
              **{f"{prefix}silver_{t}": partial(lake.silver, t) for t in SILVER},
              **{f"{prefix}{g}": partial(lake.gold, g) for g in GOLD}}
    words = None if statement is None else set(re.findall(r"\w+", statement.lower()))
    names = [n for n in makers if words is None or n.lower() in words]
    for n in names:
        makers[n]().createOrReplaceTempView(n)
    return names
