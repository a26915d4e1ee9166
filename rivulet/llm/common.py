"""Small helpers that the operators of this package share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivulet.sources.tables import scratch_root, settle

__all__ = ["settle", "scratch_root", "slices", "byte_views", "share_file", "shared_path",
           "by_row", "free_name", "text_or_empty", "finite_vectors", "crc_remainder", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; the fold of a row."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20
           ) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``most_bytes``; no copy is made.

    A row is never cut, so a run holds one longer text at worst.
    """
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = (np.cumsum(sizes.astype(np.int64)) - sizes) // most_bytes
    edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def byte_views(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; NULL is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def share_file(spark: SparkSession, data: bytes, stem: str) -> str:
    """Put a small file into the shared folder and have each executor fetch it; returns its name.

    The file is written through the session's file system, so no machine's own
    folder takes part; ``shared_path`` finds the executor's copy.
    """
    name = f"{stem}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    for at in range(0, len(data), 1 << 20):
        out.write(bytearray(data[at:at + (1 << 20)]))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def shared_path(name: str) -> str:
    return os.path.join(SparkFiles.getRootDirectory(), name)


def by_row(df: DataFrame, tasks: int) -> DataFrame:
    """Deal rows evenly, whatever their values."""
    return df.repartition(tasks)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name like ``stem`` that the table does not have, in any spelling."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def finite_vectors(df: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """(id, vector of doubles), one row per id, of the vectors that take part in a search.

    Out go rows without id or vector, empty vectors, vectors with a NULL or
    non-finite component and, unless ``zero``, zero vectors. Of rows that share an
    id the smallest vector stands for all; the minimum is taken before the shuffle
    too, so a hot id moves one row per task.
    """
    whole = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x)
                     & (F.abs(x) < F.lit(float("inf"))))
    keep = F.col(id_col).isNotNull() & (F.size(vector_col) > 0) & whole
    if not zero:
        keep &= F.exists(vector_col, lambda x: x != 0)
    return (df.select(F.col(id_col).cast("bigint").alias("id"),
                      F.col(vector_col).cast("array<double>").alias("vec"),
                      keep.alias("keep"))
            .where("keep").groupBy("id").agg(F.min("vec").alias("vec")))
