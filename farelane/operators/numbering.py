"""Gap-free numbers at scale."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.operators.lookups import small_side
from farelane.scratch import scratch_folder

#: Rows of a range, as far as the number of ranges allows, and keys drawn for each bound.
ROWS_PER_RANGE, MAX_RANGES, DRAWN_PER_BOUND = 250_000, 16_384, 32

# Types that Spark and Arrow sort alike, NaN apart.
SORTED_ALIKE = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)

# monotonically_increasing_id keeps the partition number above the lowest 33 bits.
PARTITION_SHIFT = 33


def _spread_ties(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds a last sort key that differs between rows that tie, copies too.

    The key is the row's place within its task. Sorting the task's rows first
    makes that place the same when the task is repeated, up to copies.
    """
    row = F.xxhash64(*df.columns)
    return df.sortWithinPartitions(*order, row).withColumn("_spread", F.monotonically_increasing_id())


def _bounds(keys: DataFrame, ranges: int, rows: int) -> DataFrame:
    """One row with ``ranges`` - 1 ascending keys at most, at even steps through a bounded draw.

    The draw guides the balance of the ranges only. It is written, as a second draw would differ.
    """
    spark = keys.sparkSession
    wanted = DRAWN_PER_BOUND * ranges
    drawn = keys if rows <= wanted else keys.sample(wanted / rows, seed=1)
    drawn = drawn.agg(F.sort_array(F.collect_set(F.struct(*keys.columns))).alias("drawn"))
    steps = F.sequence(F.lit(1), F.lit(ranges - 1))
    size = F.size("drawn")
    picked = F.filter(
        F.transform(steps, lambda i: F.get("drawn", F.floor(i * size / ranges).cast("int"))), lambda key: key.isNotNull()
    )
    folder = scratch_folder(spark, "bounds")
    drawn.select(F.array_distinct(picked).alias("bounds")).write.parquet(folder)
    return spark.read.parquet(folder)


def _sort_keys(df: DataFrame, columns: list[str]) -> list[Column] | None:
    """Columns that Arrow sorts as Spark sorts the key, null first and NaN last; None if it cannot."""
    keys = []
    for name in columns:
        kind = df.schema[name].dataType
        if not (kind == T.StringType() or isinstance(kind, SORTED_ALIKE)):
            return None
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            keys.append(F.isnan(name))
        keys.append(F.col(name))
    return keys


def _range_finder(bounds: pa.RecordBatch):
    """Finds how many bounds are at most each key, by one stable sort of a batch's keys behind the bounds.

    It counts as not deterministic so that filters on its result do not call it again.
    """

    @F.arrow_udf("int")
    def find(*keys: pa.Array) -> pa.Array:
        both = [pa.concat_arrays([bound.cast(key.type), key]) for bound, key in zip(bounds.columns, keys)]
        names = [str(i) for i in range(len(both))]
        sorting = pc.SortOptions([(name, "ascending") for name in names], null_placement="at_start")
        order = pc.sort_indices(pa.record_batch(both, names=names), options=sorting).to_numpy()
        passed, is_key = np.cumsum(order < bounds.num_rows, dtype=np.int32), order >= bounds.num_rows
        found = np.empty(len(keys[0]), np.int32)
        found[order[is_key] - bounds.num_rows] = passed[is_key]
        return pa.array(found)

    return find.asNondeterministic()


def _with_range(df: DataFrame, columns: list[str], bounds: DataFrame | None, ranges: int) -> DataFrame:
    """Adds ``_range``: how many bounds are at most the key; by bisection where Arrow has no such order."""
    if bounds is None:
        return df.withColumn("_range", F.lit(0))
    keys = _sort_keys(df, columns)
    if keys is not None:
        listed = bounds.select(F.inline("bounds"))
        held = listed.select(*[key.alias(f"_{i}") for i, key in enumerate(_sort_keys(listed, columns))]).toArrow()
        return df.withColumn("_range", _range_finder(pa.record_batch([c.combine_chunks() for c in held.columns], names=held.column_names))(*keys))
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(ranges.bit_length()))))

    def step(found: Column, width: Column) -> Column:
        further = F.get("_bounds", found + width - 1)
        return F.when(further <= F.struct(*columns), found + width).otherwise(found)

    return df.withColumn("_bounds", bounds.scalar()).withColumn("_range", F.aggregate(steps, F.lit(0), step)).drop("_bounds")


def _number_by_bounds(df: DataFrame, name: str, order: list[str], within: list[str]) -> DataFrame:
    spark, columns = df.sparkSession, [*within, *order]
    keys = df.select(*columns)
    rows = keys.count()
    ranges = min(MAX_RANGES, rows // ROWS_PER_RANGE + 1)
    groups = [F.col(key).alias(f"_group{i}") for i, key in enumerate(within)]
    names = [f"_group{i}" for i in range(len(within))]
    bounds = _bounds(keys, ranges, rows) if ranges > 1 else None
    sizes = _with_range(keys, columns, bounds, ranges).select("_range", *groups).groupBy("_range", *names).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*names).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_range").alias("_of_range"), *[F.col(g).alias(f"{g}s") for g in names], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    folder = scratch_folder(spark, "range-starts")
    starts.write.parquet(folder)
    starts = spark.read.parquet(folder)
    mine = Window.partitionBy("_range", *within).orderBy(*order)
    placed = _with_range(df, columns, bounds, ranges).withColumn("_place", F.row_number().over(mine))
    same = F.col("_range").eqNullSafe(F.col("_of_range"))
    for key, g in zip(within, names):
        same = same & placed[key].eqNullSafe(F.col(f"{g}s"))
    return placed.join(small_side(starts), same).withColumn(name, F.col("_place") + F.col("_before")).select(*df.columns, name)


def number_rows(
    df: DataFrame,
    name: str,
    order: list[str],
    within: list[str] | None = None,
    unique: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """Numbers rows 1, 2, … in ``order``, restarting for each value of ``within``.

    No task sees more than its own range. ``unique`` says that no rows of a group tie in
    ``order``: bounds of ranges are drawn from the keys and kept, the keys alone are counted by
    range, and a row gets the size of the earlier ranges plus its place in its own. The other
    columns are shuffled once and not written.

    Without ``unique`` rows that tie are numbered in any order and spread over several
    ranges: a range sort marks each row with its partition and place, the marked rows are
    written once, which keeps the numbers fixed if an executor is lost, and the sizes of the
    earlier ranges are added.
    """
    if unique:
        return _number_by_bounds(df, name, order, within or [])
    spark, within = df.sparkSession, within or []
    keys = [F.col(key).alias(f"_group{i}") for i, key in enumerate(within)]
    groups = [f"_group{i}" for i in range(len(within))]
    target = folder or scratch_folder(spark, "numbered")
    (
        _spread_ties(df, [*within, *order])
        .orderBy(*within, *order, "_spread")
        .select(*df.columns, F.monotonically_increasing_id().alias("_place"))
        .write.parquet(target)
    )
    placed = spark.read.parquet(target).select(
        "*", F.shiftright("_place", PARTITION_SHIFT).alias("_range"), *keys
    )
    sizes = placed.groupBy("_range", *groups).agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_range",
        *[F.col(g).alias(f"{g}s") for g in groups],
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    starts.write.parquet(f"{target}-starts")
    starts = spark.read.parquet(f"{target}-starts")
    same = placed["_range"] == starts["_range"]
    for g in groups:
        same = same & placed[g].eqNullSafe(starts[f"{g}s"])
    return (
        placed.join(small_side(starts), same)
        .withColumn(name, F.col("_place") + F.col("_shift"))
        .select(*df.columns, name)
    )
