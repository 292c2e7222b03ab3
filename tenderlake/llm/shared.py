"""Helpers that several operators use: shared scratch tables, Arrow mapping, words."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: The six ASCII white-space characters that the contracts name, as a Java / Python class body.
SPACE = r"\x20\x09-\x0D"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a session on one machine may go without it; then a temporary folder serves.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python this package, once for each application, so that
    functions of it run there however the application was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{package.name}-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: computed
    once, and no lost executor makes anything above it run again."""
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def map_columns(df: DataFrame, schema: StructType | str, make: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """``mapInArrow`` where ``make()`` runs once in each task and returns a
    function from a record batch to a dict of column name to values."""
    ship(df.sparkSession)
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            if batch.num_rows:
                got = f(batch)
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x := got[c.name], pa.Array) else pa.array(x, c.type) for c in arrow], schema=arrow)

    return df.mapInArrow(run, kind)


def blocks(texts: list[str], chars: int = 4_000_000) -> Iterator[list[str]]:
    """Runs of texts with about so many characters in all, so that what is made of a run stays small."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


class BoundedCache(dict):
    """A dict that forgets everything at ``limit`` entries, so that a task's memory stays bounded."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def room_for(self, n: int) -> None:
        if len(self) + n > self.limit:
            self.clear()


class Learned:
    """What was worked out for keys, in two generations of ``limit`` entries at most.

    ``young`` has everything that was asked for since the generations last changed;
    what was not asked for during a whole generation is forgotten.
    """

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def provide(self, keys: set, learn: Callable[[set], dict]) -> dict:
        """A dict that has all of ``keys``."""
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        young = self.young
        missing = keys.difference(young)
        if self.old and missing:
            old = self.old
            again = missing.intersection(old)
            young.update((k, old[k]) for k in again)
            missing -= again
        if not missing:
            return young
        found = learn(missing)
        if len(young) + len(found) <= 2 * self.limit and not any(len(k) > KEPT_CHARS for k in found):
            young.update(found)
            return young
        # Too much for keeping: keep the short ones that there is room for, and give out a table of its own.
        every = {k: young[k] for k in keys - missing}
        every.update(found)
        for k, x in found.items():
            if len(young) >= self.limit:
                break
            if len(k) <= KEPT_CHARS:
                young[k] = x
        return every


#: What operators keep in a Python worker beyond a task: name -> how to drop it.
KEPT: dict[str, Callable[[], None]] = {}


def keep_only(*names: str) -> None:
    """At a task's start: drops what tasks of other operators have left in this Python worker, which serves
    one after another."""
    for name, drop in KEPT.items():
        if name not in names:
            drop()
    gc.collect()


#: Longer keys are worked out when met and not kept.
KEPT_CHARS = 64
