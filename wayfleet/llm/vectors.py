"""Vectors of a table as rows of integers, for the operators that need exact sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfleet.llm.work import batches

#: Components beyond this are an error: sums of products would not be exact.
LARGEST = 4096


def integer_vectors(rows: DataFrame, factor: int, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``v``: little-endian int32 of floor(factor * x) for
    each component of ``embedding``.  Rows whose vector is null or holds null or
    non-finite components are left out."""
    names = [f"k{i}" for i in range(len(keep))]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            column = batch.column(len(names))
            flat = pc.fill_null(column.flatten(), float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            end = np.cumsum(size)
            bad = np.r_[0, np.cumsum(~np.isfinite(flat))]
            good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[end] == bad[end - size])
            kept = np.repeat(good, size)
            if (np.abs(flat[kept]) > LARGEST).any():
                raise ValueError(f"a component of a vector lies beyond {LARGEST}")
            whole = np.floor(factor * flat[kept]).astype("<i4").tobytes()
            stop = np.cumsum(4 * size[good])
            v = pa.array([whole[a:b] for a, b in zip(stop - 4 * size[good], stop, strict=True)], pa.binary())
            own = [batch.column(i).filter(pa.array(good)) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*own, v], names=[*names, "v"])

    narrow = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col("embedding"))
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in narrow.schema[:-1])
    made = narrow.mapInArrow(run, f"{kinds}v binary")
    return made.withColumnsRenamed(dict(zip(names, keep, strict=True)))


def matrix(v: list[bytes], width: int) -> np.ndarray:
    """float64 rows of ``width`` components; shorter vectors end in zeros."""
    padded = b"".join([x.ljust(4 * width, b"\0") for x in v])
    return np.frombuffer(padded, dtype="<i4").reshape(len(v), width).astype(np.float64)


def length(vectors: DataFrame) -> int:
    """Components of the longest vector."""
    return (vectors.agg(F.max(F.length("v"))).first()[0] or 0) // 4
