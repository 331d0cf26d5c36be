"""Small helpers that several operators of this folder share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.scratch import scratch_folder


def saved(df: DataFrame, label: str) -> DataFrame:
    """Writes a table into the shared scratch folder and reads it back: short lineage, safe from lost executors."""
    spark = df.sparkSession
    folder = scratch_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives executors this package, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


#: What worker processes remember over tasks: how to forget it, by the modules that use it.
_MEMORIES: list[tuple[tuple[str, ...], Callable[[], None]]] = []


def remembered_for(modules: tuple[str, ...], forget: Callable[[], None]) -> None:
    """Says that only functions of ``modules`` use a cache of this process, and how to empty it."""
    _MEMORIES.append((modules, forget))


def forget_others(module: str) -> None:
    """Empties the caches that functions of a module do not use: a worker serves one operator after another."""
    for modules, forget in _MEMORIES:
        if module not in modules:
            forget()


def mapped(df: DataFrame, function: Callable, ddl: str) -> DataFrame:
    """``mapInArrow`` with a function of this package; caches of other operators are emptied first."""
    ship_package(df.sparkSession)
    module = function.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(module)
        return function(batches)

    return df.mapInArrow(run, ddl)


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key() -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64("text")


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as bytes, null as the empty text."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Texts, null as the empty text."""
    return [value or "" for value in column.to_pylist()]


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that work per batch needs little memory."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every range, one range after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def tokenizer_file(name: str) -> str:
    """Place of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)
