"""Source tables stored by loan: bucketed and sorted on the loan key.

Every child table of the report is folded per loan and then meets the spine on
the loan. Stored in the same number of buckets on that key, the folds and joins
need no exchange: a task reads one bucket of each table. The layout is plain
Parquet in folders; the bucketing is declared when a table is opened, so no
metastore has to outlive a session. Dated tables keep their ``fecha``
partitions, each bucketed alike, and a run reads its own day only.

A loan's rows share a bucket, which one task reads. ``store`` therefore refuses
a table in which a single loan holds more than ``MOST_ROWS`` rows: such a table
stays in the plain layout, where its loans are combined before their exchange.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import DATED, INPUT_SCHEMAS, TableSource

#: The loan key of each table that is stored by it.
LOAN_KEYS = {"saldos": "jts_oid", "universe": "jts_oid", "miembros": "saldo_jts_oid", "historia": "saldos_jts_oid",
             "plan_pagos": "saldo_jts_oid", "plan_pagos_original": "saldos_jts_oid", "gastos": "saldos_jts_oid",
             "devengamiento": "saldo_jts_oid"}
#: Tables with a folder per ``fecha``.
BY_DATE = (*DATED, "devengamiento")
MOST_ROWS = 2_000_000


def table_name(path: str, buckets: int) -> str:
    return f"kredex_{hashlib.sha256(f'{path}:{buckets}'.encode()).hexdigest()[:24]}"


def store(name: str, df: DataFrame, path: str, buckets: int, most_rows: int = MOST_ROWS) -> None:
    """Write ``df`` as table ``name``, one sorted file per bucket (and date)."""
    spark, key = df.sparkSession, LOAN_KEYS[name]
    most = df.groupBy(*{key, *(("fecha",) if name in BY_DATE else ())}).count().agg(F.max("count")).first()[0] or 0
    if most > most_rows:
        raise ValueError(f"a loan of {name} holds {most} rows; a bucket would hold them all (at most {most_rows})")
    temp = f"{table_name(path, buckets)}_written"
    # rows of a bucket meet in one task by the bucketing's own hash: a file each
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in _schema(spark, name)]).repartition(buckets, key)
    out = rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path)
    if name in BY_DATE:
        out = out.partitionBy("fecha")
    out.saveAsTable(temp)
    spark.sql(f"DROP TABLE {temp}")         # external: its files stay


def _schema(spark: SparkSession, name: str):
    return spark.createDataFrame([], INPUT_SCHEMAS[name]).schema


def open_table(spark: SparkSession, name: str, path: str, buckets: int) -> DataFrame:
    """The stored table, with its bucketing known to the planner."""
    table, key = table_name(path, buckets), LOAN_KEYS[name]
    dated = "PARTITIONED BY (fecha)" if name in BY_DATE else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({INPUT_SCHEMAS[name]}) USING parquet {dated} "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    if dated:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table)


class BucketedSource(TableSource):
    """The source tables under ``root``, those of ``LOAN_KEYS`` stored by
    ``store`` in ``buckets`` buckets, the others plain."""

    def __init__(self, spark: SparkSession, root: str, buckets: int, cutoff: dt.date | None = None,
                 paths: dict[str, str] | None = None, collation: str | None = None):
        super().__init__(spark, root, cutoff=cutoff, paths=paths, collation=collation)
        self.buckets = buckets

    def read(self, name: str) -> DataFrame:
        if name not in LOAN_KEYS:
            return super().read(name)
        return open_table(self.spark, name, self.path(name), self.buckets)
