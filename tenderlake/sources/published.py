"""Published layers: versions that readers see whole, bucketed by notice_id.

``publish`` writes the tables of a layer into a new version folder and then switches the
manifest, one small file that is replaced by a rename.  Whoever opens the layer reads the manifest once and
stays on its version; versions are never written again, and ``prune`` removes old ones only when asked.
A publication that fails leaves the manifest, and so every reader, where it was.

Tables are bucketed and sorted by notice_id with one number of buckets.  Joins and
aggregations on notice_id between them need no exchange: Spark plans them bucket by bucket.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

KEY = "notice_id"
MANIFEST = "CURRENT"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a file beside ``path`` and renames it over it."""
    jvm = spark._jvm
    fs, p = _path(spark, path)
    fs.mkdirs(p.getParent())
    _, new = _path(spark, f"{path}-{uuid.uuid4().hex}")
    out = fs.create(new, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(new), fs.makeQualified(p), options)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


@dataclass
class Version:
    """A published version of a layer: its tables, as they were when it was opened."""

    spark: SparkSession
    folder: str
    tables: dict[str, str]  # name -> DDL
    buckets: int

    def table(self, name: str) -> DataFrame:
        """A table of this version, known to the session's catalog as bucketed."""
        known = f"published_{self.folder.rsplit('=', 1)[1]}_{name}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {known} ({self.tables[name]}) USING parquet CLUSTERED BY ({KEY}) "
                       f"SORTED BY ({KEY}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{name}'")
        return self.spark.table(known)

    def forget(self) -> None:
        """Drops the catalog's entries; the files stay."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS published_{self.folder.rsplit('=', 1)[1]}_{name}")


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], buckets: int = 200) -> Version:
    """Writes ``tables``, each with a notice_id, as the next version below ``root``, then switches the manifest to it."""
    root = root.rstrip("/")
    folder = f"{root}/version={uuid.uuid4().hex}"
    for name, df in tables.items():
        staged = f"staged_{uuid.uuid4().hex}"
        # One file a bucket: rows meet in their bucket before they are written.
        (df.repartition(buckets, KEY).write.format("parquet").bucketBy(buckets, KEY).sortBy(KEY)
         .option("path", f"{folder}/{name}").saveAsTable(staged))
        spark.sql(f"DROP TABLE {staged}")  # an external table: its files stay
    described = {"folder": folder, "buckets": buckets, "tables": {n: _ddl(df) for n, df in tables.items()}}
    _replace_text(spark, f"{root}/{MANIFEST}", json.dumps(described))
    return Version(spark, folder, described["tables"], buckets)


def current(spark: SparkSession, root: str) -> Version:
    """The version that the manifest names now."""
    text = _read_text(spark, f"{root.rstrip('/')}/{MANIFEST}")
    if text is None:
        raise FileNotFoundError(f"nothing is published below {root}")
    found = json.loads(text)
    return Version(spark, found["folder"], found["tables"], found["buckets"])


def prune(spark: SparkSession, root: str, keep: set[str] = frozenset()) -> list[str]:
    """Removes all versions but the current one and those in ``keep`` (folders); returns the removed ones."""
    root = root.rstrip("/")
    fs, p = _path(spark, root)
    spared = {v.rstrip("/").rsplit("/", 1)[1] for v in {current(spark, root).folder, *keep}}
    gone = []
    for f in fs.listStatus(p):
        name = f.getPath().getName()
        if name.startswith("version=") and name not in spared:
            fs.delete(f.getPath(), True)
            gone.append(f"{root}/{name}")
    return gone
