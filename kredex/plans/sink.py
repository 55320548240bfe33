"""The result as a catalog table that holds its own constraints.

Text columns are ``VARCHAR(n)``, the generated-at column has its default in the
table, and the run's cutoff and version are partition columns. Rows come in by
an ``INSERT`` with a positional column list under ANSI store assignment, as in
the report's own load: an over-long text or a value out of range fails the
statement, and the column left out of the list takes its default.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..schemas import GENERATED, PARTITION_COLUMNS, RESULT_COLUMNS

SQL_TYPES = {"string": "STRING", "int": "INT", "timestamp_ntz": "TIMESTAMP_NTZ"}


def column_types() -> dict[str, str]:
    """Declared SQL type of each result column."""
    return {c: f"VARCHAR({n})" if n else SQL_TYPES.get(t, t.upper()) for c, t, n in RESULT_COLUMNS}


def table_name(location: str) -> str:
    return f"kredex_result_{hashlib.sha256(location.encode()).hexdigest()[:24]}"


def create(spark: SparkSession, location: str) -> str:
    """Create (or open) the result table at ``location``; returns its name."""
    name = table_name(location)
    columns = ", ".join(f"{c} {t}" + (" DEFAULT current_timestamp()::TIMESTAMP_NTZ" if c == GENERATED else "")
                        for c, t in column_types().items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{location}'")
    return name


def insert(rows: DataFrame, table: str) -> None:
    """Insert result rows by position; the generated-at column is left out and
    takes the table's default."""
    spark = rows.sparkSession
    columns = [c for c, _, _ in RESULT_COLUMNS if c != GENERATED]
    view = f"{table}_rows"
    rows.select(*columns).createOrReplaceTempView(view)
    old = spark.conf.get("spark.sql.storeAssignmentPolicy")
    spark.conf.set("spark.sql.storeAssignmentPolicy", "ANSI")
    try:
        spark.sql(f"INSERT INTO {table} ({', '.join(columns)}) SELECT * FROM {view}")
    finally:
        spark.conf.set("spark.sql.storeAssignmentPolicy", old)
        spark.catalog.dropTempView(view)
