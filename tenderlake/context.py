"""Per-session access to the layered tables (src views -> silver -> gold).

``Lake(spark, sf_dir)`` hands out DataFrame *plans*; nothing is computed until
an action runs.  With ``materialize=True`` the silver and gold layers (and the
reused ML intermediates) are written once as Parquet tables into the shared
folder named by ``spark.checkpoint.dir`` and read back: the medallion edges the
surveyed pipeline writes as Parquet.  Analytics over the marts then do not
recompute the joins below them, keep scan pruning / pushdown, and a lost
executor only recomputes from the last written layer.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .functions.lookups import NATURAL_KEYS
from .operators import gold as G
from .operators import silver as S
from .sources import views as V
from .sources import xml_notices as X
from .sources.tables import read_table

_LOCK = threading.Lock()
_LAKES: dict[tuple, "Lake"] = {}


def _join(folder: str, *names: str) -> str:
    return "/".join([folder.rstrip("/"), *names])


def write_table(spark: SparkSession, df: DataFrame, name: str, folder: str | None = None,
                schema: StructType | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and
    read it back (as ``schema``, if given): computed once, lineage cut, and later scans keep column
    pruning and predicate pushdown (unlike RDD checkpoint files)."""
    path = _join(folder or _join(ensure_checkpoint_dir(spark), "tenderlake-tables"), f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.  Without one, a session on one
    machine gets a temporary folder; a cluster's executors could not read that."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tenderlake-checkpoints-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def _listing(spark: SparkSession, folder: str) -> tuple:
    """(name, bytes, modification time) of what lies in a folder, by Spark's file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


class Lake:
    """Layers over a folder of tables, or over a folder of notice XML (``from_xml``)."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = False, xml: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.materialize = materialize
        self.xml = xml
        self._id = uuid.uuid4().hex
        self._cache: dict[str, DataFrame] = {}
        self._made: dict[str, object] = {}

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str, materialize: bool | None = None) -> "Lake":
        """The lake of this application over these very input files: changed input makes a new lake."""
        if materialize is None:
            # Layers are written tables by default (the medallion edges); set
            # tenderlake.materialize=false to keep every query one lazy plan.
            materialize = spark.conf.get("tenderlake.materialize", "true").lower() == "true"
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), materialize, _listing(spark, sf_dir))
        with _LOCK:
            if key not in _LAKES:
                _LAKES[key] = cls(spark, sf_dir, materialize)
            return _LAKES[key]

    @classmethod
    def from_xml(cls, spark: SparkSession, path: str, materialize: bool = True) -> "Lake":
        """XML folder -> bronze -> silver -> gold: every notice below ``path``, parsed once."""
        return cls(spark, path, materialize, xml=X.read_xml_files(spark, path))

    @classmethod
    def from_documents(cls, spark: SparkSession, docs: DataFrame, materialize: bool = True) -> "Lake":
        """The same over (file_name, xml) rows."""
        return cls(spark, "", materialize, xml=docs)

    def folder(self) -> str:
        return _join(ensure_checkpoint_dir(self.spark), "tenderlake-tables", self._id)

    def close(self) -> None:
        """Removes the tables that this lake has written, and forgets it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder())
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self._cache.clear()
        self._made.clear()
        with _LOCK:
            for key in [k for k, lake in _LAKES.items() if lake is self]:
                del _LAKES[key]

    def once(self, name: str, build: Callable[[], object]):
        """What ``build`` makes (a fitted model, a number), made once for this lake."""
        if name not in self._made:
            self._made[name] = build()
        return self._made[name]

    # ---- helpers --------------------------------------------------------- #
    def _memo(self, name: str, build: Callable[[], DataFrame], layer_edge: bool = False) -> DataFrame:
        if name not in self._cache:
            df = build()
            if layer_edge and self.materialize:
                df = write_table(self.spark, df, name, self.folder())
            self._cache[name] = df
        return self._cache[name]

    def table(self, name: str, *columns: str) -> DataFrame:
        df = self._memo(f"raw.{name}", lambda: read_table(self.spark, self.sf_dir, name))
        return df.select(*columns) if columns else df

    def src(self, name: str) -> DataFrame:
        if self.xml is not None and name in X.BRONZE:
            return self._memo(f"bronze.{name}", lambda: X.BRONZE[name](self.notices_parsed()), True)
        return self._memo(f"src.{name}", lambda: V.SRC_VIEWS[name](self.spark, self.sf_dir))

    def notices_parsed(self) -> DataFrame:
        return X.well_formed(self._memo("bronze.parsed", lambda: X.parse_all(self.xml), True))

    def quarantine(self) -> DataFrame:
        """Files among the notices that did not parse."""
        return X.malformed(self._memo("bronze.parsed", lambda: X.parse_all(self.xml), True))

    # ---- silver ---------------------------------------------------------- #
    def silver(self, name: str) -> DataFrame:
        if name == "notices":
            return self._memo("silver.notices", lambda: S.enrich_buyers(
                S.silver_table(self.src("notices"), "notices"), self.silver("organisations")), True)
        return self._memo(f"silver.{name}", lambda: S.silver_table(self.src(name), name), True)

    def silver_keys(self, name: str) -> DataFrame:
        """The natural keys of a silver table, one row for each of its rows: without deciding which row of a key is
        kept, unless the table is there already."""
        key = NATURAL_KEYS[name]
        if f"silver.{name}" in self._cache or not self.materialize:
            return self.silver(name).select(*key)
        return S.TRANSFORMS[name](self.src(name)).select(*key).distinct()

    def silver_notices_unenriched(self) -> DataFrame:
        return self._memo("silver.notices_raw", lambda: S.silver_table(self.src("notices"), "notices"))

    # ---- gold ------------------------------------------------------------ #
    def gold(self, name: str, *columns: str) -> DataFrame:
        """A mart; with ``columns`` only these, and unless the whole mart is there already no more is built than they need."""
        if columns:
            if name in self._cache or not self.materialize:
                return self.gold(name).select(*columns)
            slim = f"{name}-of-{'-'.join(columns)}"
            # Written like the whole mart, but for a mere projection of a silver table.
            return self._memo(slim, lambda: G.build_mart(self, name, columns), G.joins(name, columns)).select(*columns)
        builders = {
            **{mart: (lambda mart=mart: G.build_mart(self, mart)) for mart in G.MARTS},
            "gold_country_kpis": lambda: G.build_country_kpis(self.gold("gold_notices"), self.gold("gold_awards")),
            "gold_cpv_kpis": lambda: G.build_cpv_kpis(self.gold("gold_notices"), self.gold("gold_awards")),
            "gold_market_summary": lambda: G.build_market_summary(self.gold("gold_notice_awards")),
            "gold_cpv_analysis": lambda: G.build_cpv_analysis(self.gold("gold_notice_awards"),
                                                              self.gold("gold_opportunities")),
        }
        return self._memo(name, builders[name], True)

    def derived(self, name: str, build: Callable[[], DataFrame], persist: bool = False) -> DataFrame:
        """Memoise an analytics base frame (e.g. ``notice_awards``)."""
        return self._memo(name, build, persist)
