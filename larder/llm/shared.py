"""Where intermediate tables go, and small things that several operators need."""

from __future__ import annotations

import functools
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    A session in one process (master ``local[...]``) that names none gets a
    temporary folder; a cluster that names none is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="larder-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def release() -> None:
    """Give back what a task's columns and tables took; for the end of tasks that hold much."""
    gc.collect()
    pa.default_memory_pool().release_unused()


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/larder/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "embeddings.parquet"))


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file, the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    """The pattern by which the byte-level tokenizers cut texts."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that text operators read; whatever else the table has stays in the scan."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


_shipped: set[str] = set()
#: Rows that Spark hands to Python at a time: whole texts are wide rows.
TEXTS_AT_ONCE = 1000


def ship_package(spark: SparkSession) -> None:
    """Let the executors' Python import this package, once per application, through Spark's own file distribution.

    Also sees to it that batches of whole texts stay small in the session, on both sides of the pipe to Python.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= TEXTS_AT_ONCE:
        spark.conf.set(rows, str(TEXTS_AT_ONCE))
    application = spark.sparkContext.applicationId
    package = Path(__file__).resolve().parents[1]
    if application not in _shipped and package.is_dir():
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="larder-"), package.name), "zip", package.parent, package.name
        )
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)


def shipped(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``run(spark, ...)`` after the executors can import this package."""

    @functools.wraps(run)
    def first(spark: SparkSession, *args, **kwargs) -> DataFrame:
        ship_package(spark)
        return run(spark, *args, **kwargs)

    return first


def with_text(docs: DataFrame, change: Callable[[str | None], str | None]) -> DataFrame:
    """``docs`` with ``change`` applied to every text, and ``n_chars``, where there is one, brought up to date."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            field = batch.schema.field(at)
            for some in by_bytes(batch):
                yield some.set_column(at, field, pa.array(map(change, some["text"].to_pylist()), field.type))

    return counted(docs.mapInArrow(run, docs.schema))


def counted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars``, where there is one, as the length of the text."""
    if "n_chars" not in docs.columns:
        return docs
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.select(*(length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


#: Bytes of text that are turned into Python objects at a time.
TEXT_BYTES = 1 << 22


def by_bytes(batch: pa.RecordBatch, column: str = "text", limit: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of ``column`` each, one row at least; never an empty slice."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    share = np.cumsum(sizes, dtype=np.int64) // limit
    edges = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(lo, hi - lo)


def word_lists(raw: bytes, limit: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words between white space, in lists of about ``limit`` bytes; only spaces are looked at to cut."""
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + limit) if len(raw) - at > limit else -1
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def list_array(parts: list[np.ndarray]) -> pa.ListArray:
    """A list column from one array per row."""
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))
