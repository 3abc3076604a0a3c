"""Small helpers for functions that stream Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from hazardgrid.session import delete_dir, shared_dir


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys from a partition sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        change = np.zeros(n, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), n]
        for i, j in zip(cuts[:-2], cuts[1:-1]):
            held.append(batch.slice(i, j - i))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cuts[-2], n - cuts[-2]))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def stored(spark: SparkSession, df: DataFrame, name: str, under: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: it is computed once,
    and a lost executor costs at most a reread. The folder goes when the
    application ends, or with the scratch folder it is ``under``."""
    path = f"{under}/{name}-{uuid.uuid4().hex}" if under else run_folder(spark, name)
    df.write.parquet(path)
    drop_at_exit(spark, path)
    # Spark deletes a finished job's shuffle files once the driver has collected its plan,
    # which a driver with much memory may not do before the disks of the workers are full.
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def run_folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder."""
    return f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for frames that are read within the block only; it is deleted with them."""
    folder = run_folder(spark, name)
    try:
        yield folder
    finally:
        delete_dir(spark, folder.rsplit("/", 1)[0])


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Have the store delete the run's folder when the application ends; results that are
    read later than that must be written elsewhere by then."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def lists(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """List column from flat values and n+1 offsets."""
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def binaries(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())
