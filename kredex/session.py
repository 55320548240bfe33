"""Spark session settings for the engine.

Tests and the benchmark build a local session; on a cluster the session is
given and only the SQL settings the engine relies on are applied to it.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans are designed for.
ENGINE_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot loan, client or application is split at runtime on join inputs
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # joins partition on all their keys (Spark's default), so a salted join's
    # (key, salt) partitioning is never collapsed onto the key alone
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # child tables also hold loans that no balance row has: where a child scan is
    # large, its rows are thinned by a Bloom filter of the spine's loan keys before
    # they are aggregated and shuffled. The filter is built from a side of a
    # checked size (its scan below 256 MB, about 16 million loans) and has 16 MB at
    # most; a larger spine goes without
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "16000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "16000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "134217728",
    "spark.sql.optimizer.runtimeFilter.number.threshold": "24",
    # the JVM never compiles a method past 8,000 bytes of bytecode: it runs row by
    # row in the interpreter. Stages that would have one (the 60 column rules, the
    # checks of all columns) run on projections that Spark cuts into small methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a write split by a flag keeps a file open per value instead of sorting
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in ENGINE_SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


def build_local(cpus: int | str = 8, shuffle_partitions: int | None = None,
                app: str = "kredex", extra: dict[str, str] | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
         .config("spark.sql.session.timeZone", "UTC"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``, or
    the one set through ``setCheckpointDir``. Only a local master (tests) may
    go without and then gets a scratch folder; elsewhere that is an error, as
    executors do not share the driver's disk."""
    set_by_call = spark.sparkContext._jsc.sc().getCheckpointDir()
    d = (spark.conf.get("spark.checkpoint.dir", None)
         or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
         or (set_by_call.get() if set_by_call.isDefined() else None))
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="kredex-shared-")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder (by the file system that holds it)."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def folders(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(path, age in seconds) of the folders right below ``path``."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    return [(x.getPath().toString(), time.time() - x.getModificationTime() / 1000)
            for x in fs.listStatus(where) if x.isDirectory()]


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished jobs: it does so
    once the driver has collected what refers to them, which may otherwise not
    happen before a long job ends."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scope:
    """Owns the folder of one piece of work under the shared folder, and all
    intermediate tables in it. As a context manager it removes the folder on
    success and on failure; the scope of a session (``session_scope``) removes
    it when the session's process ends, as session tables vanish by themselves.
    Folders of runs that died are removed by ``sweep``."""

    PREFIX = "kredex-scope-"

    def __init__(self, spark: SparkSession, base: str | None = None):
        self.spark = spark
        self.folder = f"{base or shared_folder(spark)}/{self.PREFIX}{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once and read back: cuts the lineage, and gives later
        joins its size."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def step(self, df: DataFrame, name: str) -> "Step":
        """A step of a long job: ``df`` written once; the shuffle files behind it
        are freed."""
        path = self.path(name)
        df.write.parquet(path)
        free_shuffles(self.spark)
        return Step(self.spark.read.schema(df.schema).parquet(path), path)

    def drop(self, step: "Step") -> None:
        """Remove a step that later ones replace."""
        remove_path(self.spark, step.path)

    def close(self) -> None:
        remove_path(self.spark, self.folder)

    def __enter__(self) -> "Scope":
        return self

    def __exit__(self, *why) -> None:
        self.close()


@dataclass
class Step:
    rows: DataFrame
    path: str


_SESSIONS: dict[str, Scope] = {}


def session_scope(spark: SparkSession) -> Scope:
    """The scope of tables that a result reads lazily: it lives as long as the
    session's application."""
    app = spark.sparkContext.applicationId
    if app not in _SESSIONS:
        _SESSIONS[app] = Scope(spark)
    return _SESSIONS[app]


def release(spark: SparkSession) -> None:
    """Remove the session's intermediate tables; results not yet consumed can
    no longer be read."""
    scope = _SESSIONS.pop(spark.sparkContext.applicationId, None)
    if scope is not None:
        scope.close()


@atexit.register
def _release_all() -> None:
    for app in list(_SESSIONS):
        scope = _SESSIONS.pop(app)
        try:
            scope.close()
        except Exception:       # the session is gone already: ``sweep`` of a later run finds the folder
            pass


def sweep(spark: SparkSession, older_than_hours: float = 72, base: str | None = None) -> int:
    """Remove scopes of runs that died: older than the longest run may take,
    and not of this process."""
    own = {s.folder.rsplit("/", 1)[1] for s in _SESSIONS.values()}
    gone = 0
    for path, age in folders(spark, base or shared_folder(spark)):
        name = path.rsplit("/", 1)[1]
        if name.startswith(Scope.PREFIX) and name not in own and age > older_than_hours * 3600:
            remove_path(spark, path)
            gone += 1
    return gone


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for an intermediate table of the session."""
    return session_scope(spark).path(name)
