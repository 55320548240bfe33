"""Registered queries: one per operator group of the report.

Every query runs over the whole shared tables of ``sf_dir`` through the
adapter views; the Spark side uses the fused engine operators. ``oracle.py``
holds the DuckDB statement of each.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..operators import facts as fx_
from ..params import RunParams
from ..sources.adapters import CUTOFF_TC, TestWorld
from ..sources.collation import CASE_INSENSITIVE, CASE_SENSITIVE, CollatedTables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


class Ctx:
    """Adapter tables + resolved run parameters for one call."""

    def __init__(self, spark: SparkSession, sf_dir: str, collation: str = CASE_INSENSITIVE):
        from ..session import configure
        self.spark = configure(spark)
        self.raw = TestWorld(spark, sf_dir)
        self.p = RunParams.resolve(self.raw["parametros"], self.raw["maestro"], tc=CUTOFF_TC, collation=collation)
        self.w = CollatedTables(self.raw, self.p.collation)

    def __getitem__(self, name: str) -> DataFrame:
        return self.w[name]

    def loans(self, *universe_cols: str) -> DataFrame:
        """Loans of the report: valid balance rows joined to the universe."""
        s = fx_.valid(self.w["saldos"]).drop("tz_lock")
        u = self.w["universe"].select("jts_oid", "nro_prestamo", *universe_cols)
        return s.join(u, "jts_oid")


#: Queries registered for a case-sensitive database too, under this ending.
CASED = "_case_sensitive"


def register(name: str, both_collations: bool = False):
    """Register a Spark query over the test-data views; ``both_collations``
    registers it for either rule of comparing codes."""
    def deco(fn: Callable[[Ctx], DataFrame]) -> QueryFn:
        def under(collation: str) -> QueryFn:
            @wraps(fn)
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return fn(Ctx(spark, sf_dir, collation))
            return run
        QUERIES[name] = under(CASE_INSENSITIVE)
        if both_collations:
            QUERIES[name + CASED] = under(CASE_SENSITIVE)
        return QUERIES[name]
    return deco
