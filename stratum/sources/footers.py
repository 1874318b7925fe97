"""Which Parquet files can be read together: their column types, from the footers alone."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names that a task opens one after the other.
FILES_PER_TASK = 100


def _address(path: str) -> str:
    """The path as a URI: Hadoop writes local ones with one slash, and leaves blanks as they are."""
    scheme, _, rest = path.partition(":")
    return f"{scheme}:{'//' if not rest.startswith('//') else ''}{quote(rest, safe='/:@')}"


def _kind(path: str) -> str | None:
    """Names and types of the columns; None if the footer cannot be read here."""
    try:
        system, name = fs.FileSystem.from_uri(_address(path))
        with system.open_input_file(name) as file:
            return json.dumps([[field.name, str(field.type)] for field in pq.read_schema(file)])
    except (pa.ArrowException, OSError):
        return None


def kinds(files: DataFrame) -> DataFrame:
    """``files(path)`` with ``kind``: equal for files with the same columns of the same types, in one order.

    Executors read the footers, through ``pyarrow.fs``. The kind is NULL where that does not know the store.
    """
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path")
            yield pa.RecordBatch.from_arrays(
                [paths, pa.array([_kind(p) for p in paths.to_pylist()], pa.string())], ["path", "kind"])

    spark = files.sparkSession
    tasks = max(1, min(files.count() // FILES_PER_TASK, spark.sparkContext.defaultParallelism * 4))
    return files.select("path").repartition(tasks).mapInArrow(read, "path string, kind string")


def groups_that_agree(files: DataFrame) -> list[list[str]]:
    """The files of one load, whose names the driver holds anyway, in groups with one type for each column.

    Kinds that do not contradict each other go together: columns may be missing or in another order. Files of unknown
    kind are a group of their own.
    """
    found = kinds(files).groupBy("kind").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    groups: list[tuple[dict[str, str], list[str]]] = []
    unknown: list[str] = []
    for row in sorted(found, key=lambda r: r.paths):
        if row.kind is None:
            unknown = row.paths
            continue
        types = dict(json.loads(row.kind))
        for held, paths in groups:
            if all(held.get(name, kind) == kind for name, kind in types.items()):
                held.update(types)
                paths.extend(row.paths)
                break
        else:
            groups.append((types, list(row.paths)))
    return [sorted(paths) for _, paths in groups] + ([unknown] if unknown else [])
