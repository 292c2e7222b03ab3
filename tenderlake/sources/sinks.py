"""Outputs for users: partitioned Parquet tables, CSV, JSON lines and Markdown reports.

Every writer is a Spark job into a folder of the caller's; nothing is collected except the
rows of a Markdown report, which is for summaries and refuses more than its ``limit``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tables(tables: dict[str, DataFrame], folder: str, partition_by: dict[str, list[str]] | None = None,
                 mode: str = "overwrite") -> list[str]:
    """A Parquet table for each name, partitioned as asked; tables without rows are skipped.  Returns the names written."""
    done = []
    for name, df in tables.items():
        if df.isEmpty():
            continue
        df.write.mode(mode).partitionBy(*(partition_by or {}).get(name, [])).parquet(f"{folder.rstrip('/')}/{name}")
        done.append(name)
    return done


def write_csv(df: DataFrame, folder: str, one_file: bool = False) -> None:
    """CSV with a header; arrays as JSON.  ``one_file`` is for small results: a single task writes it."""
    flat = df.select(*[F.to_json(c.name).alias(c.name) if c.dataType.typeName() in ("array", "map", "struct") else F.col(c.name)
                       for c in df.schema.fields])
    (flat.coalesce(1) if one_file else flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(folder)


def write_json(df: DataFrame, folder: str) -> None:
    """One JSON object a line; nulls are written out."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(folder)


def write_report(summaries: dict[str, DataFrame], folder: str, limit: int = 1000) -> None:
    """A Markdown file with a table for each summary (at most ``limit`` rows; more is an error, not a cut)."""
    lines = []
    for title, df in summaries.items():
        rows = df.limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"{title}: a report holds at most {limit} rows; write it as a table")
        cells = [["" if v is None else str(v).replace("|", "\\|").replace("\n", " ") for v in r] for r in rows]
        lines += [f"## {title}", "", *["| " + " | ".join(x) + " |" for x in (df.columns, ["---"] * len(df.columns), *cells)], ""]
    spark = next(iter(summaries.values())).sparkSession
    text = spark.createDataFrame([("\n".join(lines),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(folder)
