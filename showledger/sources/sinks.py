"""Report files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def report_rows(df: DataFrame, parent: list[str], children: str, child_fields: list[str]) -> DataFrame:
    """Flat text rows: one per child, a parent-only row when there is none.

    Doubles are written with three decimals, booleans as true/false, NULLs blank.
    """
    flat = df.select(*parent, F.explode_outer(children).alias("_c"))
    flat = flat.select(*parent, *[F.col("_c." + f).alias(f) for f in child_fields])
    kinds = dict(flat.dtypes)

    def shown(c: str) -> Column:
        text = F.format_string("%.3f", F.col(c).cast("double")) if kinds[c] in ("double", "float") else F.col(c).cast("string")
        return F.when(F.col(c).isNull(), "").otherwise(text).alias(c)

    return flat.select(*[shown(c) for c in flat.columns])


def write_report_csv(df: DataFrame, path: str, parent: list[str] | None = None, children: str | None = None,
                     child_fields: list[str] | None = None) -> None:
    rows = report_rows(df, parent, children, child_fields) if children else df
    rows.write.mode("overwrite").csv(path, header=True, emptyValue="")


def write_report_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
