"""The batch job: parameters -> extract -> checks -> dated partition -> text.

    python -m kredex.plans.job --root <sources> --out <result> [--export <dir>]
                               [--tc 32.1234] [--policy strict|quarantine] [--collation nocase|case]
"""

from __future__ import annotations

import argparse
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ..params import RunParams
from ..session import Scope, configure
from ..sources.collation import CASE_INSENSITIVE, COLLATIONS
from ..sources.tables import TableSource
from . import publish as pub
from .extract import build_extract


def run_extract(spark: SparkSession, root: str, out: str, *, tc: Decimal | str | None = None,
                policy: str = "strict", export_path: str | None = None,
                reject_path: str | None = None, collation: str = CASE_INSENSITIVE) -> RunParams:
    """Build and publish the extract of the cutoff named in the source's
    parameter table; optionally export it as delimited text."""
    if policy == "quarantine" and not reject_path:
        raise ValueError("the quarantine policy needs a path for the rejected rows")
    configure(spark)
    base = TableSource(spark, root)
    p = RunParams.resolve(base["parametros"], base["maestro"],
                          fx_rates=base["tipo_cambio"], tc=tc, collation=collation)
    src = TableSource(spark, root, cutoff=p.cutoff.date(), collation=p.collation)
    # quarantine: an out-of-range decimal rejects its row instead of the job
    with Scope(spark) as steps:
        result = build_extract(src, p, with_generated=True, checked=(policy == "quarantine"), scope=steps)
        pub.publish(result, out, p, policy=policy, reject_path=reject_path)
    if export_path:
        pub.export_text(pub.read_partition(spark, out, p.cutoff, p.version), export_path)
    return p


def extract(spark: SparkSession, root: str, tc: Decimal | str | None = None) -> DataFrame:
    """The extract rows without publishing (lazy)."""
    base = TableSource(spark, root)
    p = RunParams.resolve(base["parametros"], base["maestro"],
                          fx_rates=base["tipo_cambio"], tc=tc)
    return build_extract(TableSource(spark, root, cutoff=p.cutoff.date(), collation=p.collation), p)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--root", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--export")
    ap.add_argument("--rejects")
    ap.add_argument("--tc")
    ap.add_argument("--collation", default="nocase", choices=sorted(COLLATIONS))
    ap.add_argument("--policy", default="strict", choices=["strict", "quarantine"])
    a = ap.parse_args(argv)
    if a.policy == "quarantine" and not a.rejects:
        ap.error("--policy quarantine needs --rejects")
    spark = SparkSession.builder.appName("kredex-extract").getOrCreate()
    p = run_extract(spark, a.root, a.out, tc=a.tc, policy=a.policy,
                    export_path=a.export, reject_path=a.rejects,
                    collation=COLLATIONS[a.collation])
    print(f"published cutoff {p.cutoff:%Y-%m-%d} version {p.version}")


if __name__ == "__main__":
    main()
