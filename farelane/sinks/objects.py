"""One file per row, for stores that hold images and sound."""

from __future__ import annotations

import math
import os
import sys
from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.scratch import scratch_folder

# Tasks get these functions themselves, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])

Put = Callable[[str, bytes, str], None]

LISTED = "path string, length bigint, folder boolean"
STORED = "path string, length bigint, content binary"
# Names told at a time, bytes of content sent at a time, bytes of files for a task, and what opening a file counts for.
NAMES, SENT_BYTES, TASK_BYTES, OPEN_BYTES = 4096, 4 * 1024 * 1024, 32 * 1024 * 1024, 4096


def _opened(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))


def put_object(root: str) -> Put:
    """Writes below ``root``, any URI Arrow knows. A file appears under its name only when whole."""
    store, base = _opened(root)

    def put(path: str, content: bytes, content_type: str) -> None:
        target = f"{base}/{path}"
        if not isinstance(store, fs.LocalFileSystem):
            with store.open_output_stream(target, metadata={"Content-Type": content_type}) as out:
                out.write(content)
            return
        store.create_dir(target.rsplit("/", 1)[0], recursive=True)
        part = f"{target}.{uuid4().hex}"
        with store.open_output_stream(part) as out:
            out.write(content)
        store.move(part, target)

    return put


def write_objects(objects: DataFrame, make_put: Callable[[], Put]) -> DataFrame:
    """Writes ``content`` to ``path`` and reports each row: path, bytes, error.

    Files are written when the report is computed. A failed file does not stop
    the others; a repeated task writes the same files again. Paths must be
    unique, see ``latest_per_path``.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = make_put()
        for batch in batches:
            errors = []
            for path, content, kind in zip(*[batch.column(c) for c in ("path", "content", "content_type")]):
                try:
                    put(path.as_py(), content.as_py(), kind.as_py())
                    errors.append(None)
                except Exception as problem:
                    errors.append(f"{type(problem).__name__}: {problem}")
            yield pa.RecordBatch.from_pydict(
                {
                    "path": batch.column("path"),
                    "n_bytes": batch.column("n_bytes"),
                    "error": pa.array(errors, pa.string()),
                }
            )

    needed = objects.select("path", "content_type", "n_bytes", "content")
    return needed.mapInArrow(write, "path string, n_bytes bigint, error string")


def _children(store: fs.FileSystem, place: str) -> Iterator[tuple[str, int, bool]]:
    """Name, length and kind of what lies in a folder, but for names that Spark's readers skip; a local folder is never held whole."""

    def found() -> Iterator[tuple[str, int, bool]]:
        if isinstance(store, fs.LocalFileSystem):
            with os.scandir(place) as entries:
                for x in entries:
                    yield x.name, x.stat().st_size, x.is_dir()
        else:
            for x in store.get_file_info(fs.FileSelector(place)):
                yield x.base_name, x.size or 0, x.type == fs.FileType.Directory

    for name, length, folder in found():
        own = name.startswith("_") and "=" not in name and not name.startswith(("_metadata", "_common_metadata"))
        if not own and not name.startswith(".") and not name.endswith("._COPYING_"):
            yield name, length, folder


def _list_folders(root: str):
    """The children of folders given by their paths below ``root``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(root)
        kinds = (pa.string(), pa.int64(), pa.bool_())
        told = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["path", "length", "folder"])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                for name, length, folder in _children(store, f"{base}/{path}".rstrip("/")):
                    rows.append((f"{path}/{name}".lstrip("/"), length, folder))
                    if len(rows) == NAMES:
                        yield told(rows)
                        rows = []
                if rows:
                    yield told(rows)

    return run


def _read_files(root: str):
    """The content of files given by their paths below ``root``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(root)
        told = lambda rows: pa.RecordBatch.from_pydict(
            {
                "path": pa.array([r[0] for r in rows], pa.string()),
                "length": pa.array([len(r[1]) for r in rows], pa.int64()),
                "content": pa.array([r[1] for r in rows], pa.binary()),
            }
        )
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.open_input_stream(f"{base}/{path}", compression=None) as file:
                    rows.append((path, file.read()))
                held += len(rows[-1][1])
                if held >= SENT_BYTES or len(rows) == NAMES:
                    yield told(rows)
                    rows, held = [], 0
        if rows:
            yield told(rows)

    return run


def get_objects(spark: SparkSession, root: str) -> DataFrame:
    """The files that ``put_object`` left below ``root``: path there, length and content.

    As Spark's reader of binary files gives them, but the driver never holds their names: tasks list
    the folders, a job for each level of them, and tasks of about equal size read the files. Like
    that reader it skips hidden names and files without a byte.
    """
    scratch, levels = scratch_folder(spark, "listing"), []
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders = spark.createDataFrame([("",)], "path string")
    while not levels or (n := folders.count()):
        levels.append(f"{scratch}/{len(levels)}")
        dealt = folders.repartition(min(n, partitions), "path") if levels[1:] else folders.coalesce(1)
        dealt.mapInArrow(_list_folders(root), LISTED).write.parquet(levels[-1])
        folders = spark.read.schema(LISTED).parquet(levels[-1]).where("folder").select("path")
    files = spark.read.schema(LISTED).parquet(*levels).where("NOT folder AND length > 0")
    n_bytes = files.agg(F.sum(F.col("length") + OPEN_BYTES)).first()[0] or 0
    dealt = files.select("path").repartition(math.ceil(n_bytes / TASK_BYTES) or 1, "path")
    return dealt.mapInArrow(_read_files(root), STORED)
