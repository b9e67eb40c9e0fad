"""Matrices added up over tasks. A task packs its sums into bands of bounded size; bands of the same place are merged in levels
of ``FAN_IN``, so that no task and not the driver gathers what all tasks gave, unless it is known to be small."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from flowlab.storage import scratch_path

BAND_BYTES = 1 << 20
FAN_IN = 16
#: What tasks gave is joined on the driver if it is no more than this, which is read off before.
DRIVER_BYTES = 16 << 20

PARTS = "part int, band int, data binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("band", pa.int32()), ("data", pa.binary())])


@dataclass(frozen=True)
class Layout:
    """``planes`` matrices of one shape; of square ones with ``upper`` only what is right of a band's first row is moved."""

    planes: int
    rows: int
    columns: int
    upper: bool = False
    band_bytes: int = BAND_BYTES

    def bands(self) -> list[tuple[int, int]]:
        """First row and end of each band."""
        step = max(1, self.band_bytes // (8 * self.planes * max(1, self.columns)))
        return [(a, min(a + step, self.rows)) for a in range(0, self.rows, step)]

    def cut(self, total: np.ndarray, part: int) -> Iterator[pa.RecordBatch]:
        for k, (a, b) in enumerate(self.bands()):
            data = np.ascontiguousarray(total[:, a:b, a if self.upper else 0:], np.float64).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(([part], [k], [data]), _SCHEMA)], schema=_SCHEMA)

    def band(self, k: int, data: bytes) -> np.ndarray:
        a, b = self.bands()[k]
        return np.frombuffer(data, np.float64).reshape(self.planes, b - a, self.columns - (a if self.upper else 0))


def summed(
    rows: DataFrame, layout: Layout, term: Callable[[pa.RecordBatch], np.ndarray],
    join: Callable[[np.ndarray, np.ndarray], np.ndarray] = np.add, driver_bytes: int = DRIVER_BYTES,
) -> DataFrame:
    """``part, band, data`` with one part: ``term`` of all batches, joined. A table without rows gives none.

    ``join`` works cell by cell. What tasks give is written first and joined in the order of their numbers, so that lost
    executors and the order in which tasks end do not show in the last digits.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = term(batch)
                total = found if total is None else join(total, found)
        if total is not None:
            yield from layout.cut(total, TaskContext.get().partitionId())

    def joined(table: pa.Table) -> pa.Table:
        band, data = table.column("band")[0].as_py(), table.column("data")
        total = None
        for i in np.argsort(table.column("part").to_numpy()):
            found = layout.band(band, data[int(i)].as_py())
            total = found if total is None else join(total, found)
        up = table.column("part")[0].as_py() // FAN_IN
        return pa.table([[up], [band], [total.tobytes()]], schema=_SCHEMA)

    spark = rows.sparkSession
    path = scratch_path(spark, "bands")
    rows.mapInArrow(partial, PARTS).write.parquet(path)
    parts = spark.read.schema(PARTS).parquet(path)
    last, size = parts.agg(F.max("part"), F.sum(F.octet_length("data"))).first()
    if (size or 0) <= driver_bytes:
        totals: dict[int, np.ndarray] = {}
        for row in sorted(parts.collect(), key=lambda r: r.part):
            found = layout.band(row.band, row.data)
            totals[row.band] = join(totals[row.band], found) if row.band in totals else found
        return spark.createDataFrame([(0, k, bytearray(v.tobytes())) for k, v in totals.items()], PARTS).coalesce(1)
    while last > 0:
        parts = parts.groupBy((F.col("part") / FAN_IN).cast("int"), "band").applyInArrow(joined, PARTS)
        last //= FAN_IN
    return parts


def gathered(parts: DataFrame, layout: Layout) -> np.ndarray:
    """The sums on the driver, for a layout that fits there; zeros if there were no rows."""
    total = np.zeros((layout.planes, layout.rows, layout.columns))
    for row in parts.collect():
        a, b = layout.bands()[row.band]
        total[:, a:b, a if layout.upper else 0:] = layout.band(row.band, row.data)
    if layout.upper:
        total = np.triu(total) + np.triu(total, 1).transpose(0, 2, 1)
    return total


def upper_cells(parts: DataFrame, layout: Layout, names: Sequence[str]) -> DataFrame:
    """``i, j`` and a column per plane: the cells on and above the diagonal of square matrices."""
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, data in zip(batch.column("band").to_pylist(), batch.column("data")):
                a, found = layout.bands()[k][0], layout.band(k, data.as_py())
                i, j = np.triu_indices(found.shape[1], m=found.shape[2])
                values = [pa.array(plane[i, j]) for plane in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i + a, pa.int32()), pa.array(j + a, pa.int32()), *values], names=["i", "j", *names]
                )

    return parts.mapInArrow(cells, "i int, j int, " + ", ".join(f"{c} double" for c in names))
