"""Column housekeeping that tolerates missing columns."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def lower_case_names(df: DataFrame) -> DataFrame:
    names = [name.lower() for name in df.columns]
    twice = sorted(name for name, n in Counter(names).items() if n > 1)
    if twice:
        raise ValueError(f"columns that differ in case only: {twice}")
    return df.toDF(*names)


def drop_containing(df: DataFrame, text: str) -> DataFrame:
    return df.drop(*[name for name in df.columns if text in name])


def cast_present(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts the columns that exist; a value that does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def fill_zero(df: DataFrame, *names: str) -> DataFrame:
    """Missing and NaN become 0 in the numeric columns that exist."""
    present = [name for name in names if name in df.columns]
    return df.fillna(0, subset=present) if present else df


def alphabetical(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def is_known(df: DataFrame, name: str) -> Column:
    """Neither null nor NaN; true or false, never null."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return F.coalesce(_not_nan(column), F.lit(False))
    return column.isNotNull()


def _not_nan(column: Column) -> Column:
    """NaN sorts above infinity, so one comparison refuses it and, in a filter, null as well."""
    return column <= F.lit(float("inf"))


def drop_incomplete(df: DataFrame, *names: str) -> DataFrame:
    """Keeps rows in which every named column (default: every column) is known.

    One plain predicate per column, which the file scan can use.
    """
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    known = [_not_nan(F.col(n)) if n in floating else F.col(n).isNotNull() for n in names or df.columns]
    return df.where(reduce(Column.__and__, known))


def select_if(df: DataFrame, condition: Column, *columns: Column | str) -> DataFrame:
    """Columns of the rows that meet the condition.

    For conditions on parsed or decoded columns: a plain filter is moved below
    the projection that computes them, which then does its work twice.
    """
    kept = F.explode(F.when(condition, F.array(F.struct(*columns))))
    return df.select(kept.alias("_kept")).select("_kept.*")
