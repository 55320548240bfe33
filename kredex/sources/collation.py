"""Comparison rules of coded text columns, declared once per run.

The report compares codes and states as the source database does: trailing
blanks never count, and letter case counts or not by the database's collation.
Here the rule is a Spark string collation on the coded columns themselves, set
by one run parameter (``RunParams.collation``): ``=``, ``IN``, ``CASE`` and
containment on those columns follow it everywhere, with no trimming or case
folding in the rules. The columns are projected with the collation over a plain
read, so filters on the raw text still reach the Parquet scan: Parquet's own
filters compare bytes and cannot take a collated comparison.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Case does not count (the default collation of the source database); case counts.
CASE_INSENSITIVE = "UTF8_LCASE_RTRIM"
CASE_SENSITIVE = "UTF8_BINARY_RTRIM"
COLLATIONS = {"nocase": CASE_INSENSITIVE, "case": CASE_SENSITIVE}

# Columns that a rule compares with a code, by source table.
CODED: dict[str, tuple[str, ...]] = {
    "saldos": ("c1677",),
    "universe": ("tipo_prestamo", "tipo_persona", "situacion_prestamo", "codigo_estado", "producto",
                 "clasificacion_prestamo", "calificacion_utilizada"),
    "historia": ("tipomov",),
    "relacion_grupo": ("c3201", "c3210"),
    "persona_documento": ("estado", "principal"),
}
#: Values of a column outside which no rule reads the table's rows.
READ_CODES: dict[str, dict[str, tuple[str, ...]]] = {
    "historia": {"tipomov": ("P", "A", "I", "S")},
    "relacion_grupo": {"c3201": ("S",), "c3210": ("AC",)},
    "persona_documento": {"estado": ("A",), "principal": ("S",)},
}


def check(collation: str) -> str:
    if collation not in COLLATIONS.values():
        raise ValueError(f"unknown collation {collation!r}; one of {sorted(COLLATIONS.values())}")
    return collation


def may_equal(column: str, codes: tuple[str, ...], collation: str) -> Column:
    """A filter on the raw text that every row equal to one of ``codes``
    passes: it starts like the code in some case. It is pushed to the scan; the
    collated comparison behind it decides."""
    starts = []
    for code in codes:
        first = code[0]
        forms = {first} if collation == CASE_SENSITIVE else {first.lower(), first.upper()}
        starts += [F.col(column).startswith(f) for f in sorted(forms)]
    out = starts[0]
    for s in starts[1:]:
        out = out | s
    return out


def collated(name: str, df: DataFrame, collation: str) -> DataFrame:
    """A source table with the collation on its coded columns; rows whose code
    no rule reads are left at the scan."""
    check(collation)
    for column, codes in READ_CODES.get(name, {}).items():
        df = df.where(may_equal(column, codes, collation))
    have = [c for c in CODED.get(name, ()) if c in df.columns]
    return df.withColumns({c: F.collate(F.col(c), collation) for c in have}) if have else df


def padded(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with trailing blanks not counting in its plain text ``columns``
    either; columns that have a collation keep theirs."""
    plain = [c for c in columns if df.schema[c].dataType == StringType()]
    return df.withColumns({c: F.collate(F.col(c), CASE_SENSITIVE) for c in plain}) if plain else df


class CollatedTables(Mapping):
    """The tables of ``base`` with their coded columns collated."""

    def __init__(self, base: Mapping[str, DataFrame], collation: str):
        self.base, self.collation = base, check(collation)

    #: Views that hold a source table's rows under another name.
    SAME = {"historia_raw": "historia"}

    def __getitem__(self, name: str) -> DataFrame:
        return collated(self.SAME.get(name, name), self.base[name], self.collation)

    def __iter__(self) -> Iterator[str]:
        return iter(self.base)

    def __len__(self) -> int:
        return len(self.base)
