"""Vectors described by the order of their nearest reference points (pivots).

The pivots are taken from a bounded sample, the ``4 n`` valid vectors with the smallest hash of their id:
one after the other, unless a pivot near to it is there already, so that a large group of near copies does
not take many of them. Everything else covers all vectors. Vectors that are null, zero, or hold null or non-finite components
take no part, nor do vectors of another length than the pivots'.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cosine below which pivots are far enough from each other.
APART = 0.7
PLACED = "vec_id bigint, vector binary, nearest array<smallint>"


def valid_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the vectors that take part."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = "x is not null and not isnan(x) and abs(x) < double('infinity')"
    return rows.filter(
        f"vec_id is not null and size(embedding) > 0 and forall(embedding, x -> coalesce({finite}, false)) "
        "and exists(embedding, x -> x <> 0)"
    )


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def choose(valid: DataFrame, n: int) -> np.ndarray:
    """At most ``n`` unit vectors, all of the length that most of the sampled vectors have."""
    rows = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * n).collect()
    sample = [row.embedding for row in rows]
    lengths = [len(v) for v in sample]
    usual = max(sorted(set(lengths)), key=lengths.count, default=0)
    kept = [v for v in sample if len(v) == usual]
    if not kept:
        return np.zeros((0, 0))
    candidates = units(np.array(kept, float))
    taken: list[int] = []
    for at, vector in enumerate(candidates):
        if len(taken) < n and (not taken or (candidates[taken] @ vector).max() < APART):
            taken.append(at)
    return candidates[taken]


def placed(valid: DataFrame, pivots: np.ndarray, nearest: int) -> DataFrame:
    """Each vector, as bytes of doubles, with its nearest pivots in order (ties to the smaller number)."""
    dimension = pivots.shape[1] if len(pivots) else -1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
            order = np.argsort(-(units(flat) @ pivots.T), axis=1, kind="stable")[:, :nearest].astype(np.int16)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"],
                    pa.array([v.tobytes() for v in flat], pa.binary()),
                    pa.array(list(order), pa.list_(pa.int16())),
                ],
                ["vec_id", "vector", "nearest"],
            )

    return valid.filter(F.size("embedding") == dimension).mapInArrow(place, PLACED)


def matrix(vectors) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), float).reshape(len(vectors), -1)
