"""Dimension encoding of name lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import none_if_blank
from .ranking import dense_index


def _side(dim: DataFrame) -> DataFrame:
    """The dimension as a join side: broadcast where its codes are smallints, which
    bounds it at 32,767 rows; otherwise left to the planner."""
    pair = dim.select("code", "name")
    return F.broadcast(pair) if dict(dim.dtypes)["code"] in ("smallint", "tinyint") else pair


def encode_array(df: DataFrame, key: str, names: str, dim: DataFrame, out: str = "codes") -> DataFrame:
    """(key, sorted codes[]); names missing from the dimension are dropped."""
    rows = df.select(key, F.explode_outer(names).alias("name"))
    coded = rows.join(_side(dim), "name", "left")
    return coded.groupBy(key).agg(F.sort_array(F.collect_set("code")).alias(out))


def decode_array(df: DataFrame, key: str, codes: str, dim: DataFrame, out: str = "names") -> DataFrame:
    """(key, names[] in code order)."""
    rows = df.select(key, F.explode_outer(F.array_distinct(codes)).alias("code"))
    named = rows.join(_side(dim), "code", "left")
    pair = F.when(F.col("name").isNotNull(), F.struct("code", "name"))
    listed = F.sort_array(F.collect_list(pair))
    return named.groupBy(key).agg(F.transform(listed, lambda x: x["name"]).alias(out))


def new_names(dim: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """Distinct trimmed names not yet in the dimension."""
    seen = names.select(none_if_blank(column).alias("name")).filter(F.col("name").isNotNull()).distinct()
    return seen.join(dim.select("name"), "name", "left_anti")


def ensure_dim(dim: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """Dimension plus new names, which get the next codes in name order."""
    top = dim.agg(F.coalesce(F.max("code"), F.lit(0)).alias("m")).first()["m"]
    numbered = dense_index(new_names(dim, names, column), [F.col("name")], "code", start=int(top))
    kind = dict(dim.dtypes)["code"]
    return dim.select("code", "name").unionByName(numbered.select(F.col("code").cast(kind).alias("code"), "name"))
