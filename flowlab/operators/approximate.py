"""Approximate k-nearest-neighbour classification by p-stable hash tables with multi-probing.

A table hashes a vector by several random projections, each cut into steps of one width: near vectors tend to fall into
the same step of all of them. A query looks into its own bucket of every table and into the buckets that lie just across
the steps it is closest to, which saves tables. Buckets are joined by their key; what meets is measured exactly, and a task
emits k candidates per query and bucket at most.

Buckets are gathered in bins of a fixed expected size and tiled like the cells of the exact search, so that a bucket with a
third of all rows is many small tasks. Every row is in the index; only the step is fitted on a sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from flowlab.operators.batches import matrix
from flowlab.operators.neighbours import TILE_ROWS, _distances, _matrix, _Sides, exact_neighbours, tiled_candidates

#: Rows from which the width of a step is fitted, picked by the hash of their ids.
SAMPLE_ROWS = 2000
#: Steps are this many times as wide as the distance to the k-th neighbour.
STEP_SHARE = 3.5
#: Pairs of a row and a bucket that leave a task at a time; each holds a copy of the vector.
CHUNK_PAIRS = 1 << 13


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass(frozen=True)
class Tables:
    """``directions``: tables x projections x width; ``shifts``: tables x projections, in steps."""

    directions: np.ndarray
    shifts: np.ndarray
    step: float

    @classmethod
    def drawn(cls, width: int, tables: int, hashes: int, step: float, seed: int) -> Tables:
        draw = np.random.default_rng(seed)
        return cls(draw.normal(size=(tables, hashes, width)), draw.random((tables, hashes)), step)

    def _places(self, points: np.ndarray) -> np.ndarray:
        return np.einsum("nd,thd->nth", points, self.directions) / self.step + self.shifts

    def _parts(self, steps: np.ndarray) -> np.ndarray:
        """A hash of each step, told apart by table and projection; a bucket's key is made of their sum."""
        at = np.arange(steps.shape[1] * steps.shape[2], dtype=np.uint64).reshape(1, *steps.shape[1:])
        return _mixed(steps.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _mixed(at + np.uint64(1)))

    def keys(self, points: np.ndarray) -> np.ndarray:
        """The bucket of each point in each table."""
        return _mixed(self._parts(np.floor(self._places(points))).sum(axis=2, dtype=np.uint64)).view(np.int64)

    def probes(self, points: np.ndarray, count: int) -> np.ndarray:
        """The own bucket in each table and the ``count`` buckets that are least far across one or two steps."""
        places = self._places(points)
        steps = np.floor(places)
        rest = places - steps
        own = self._parts(steps)
        total = own.sum(axis=2, dtype=np.uint64)
        # A move by one step down or up along each projection: how far it is, and what it changes in the hash.
        far = np.concatenate([rest, 1 - rest], axis=2) ** 2
        change = np.concatenate([self._parts(steps - 1) - own, self._parts(steps + 1) - own], axis=2)
        h = steps.shape[2]
        pairs = np.array([(i, j) for i, j in combinations(range(2 * h), 2) if i % h != j % h], int).reshape(-1, 2)
        cost = np.concatenate([far, far[..., pairs[:, 0]] + far[..., pairs[:, 1]]], axis=2)
        moves = np.concatenate([change, change[..., pairs[:, 0]] + change[..., pairs[:, 1]]], axis=2)
        best = np.argsort(cost, axis=2, kind="stable")[..., :count]
        moved = total[..., None] + np.take_along_axis(moves, best, axis=2)
        return _mixed(np.concatenate([total[..., None], moved], axis=2)).view(np.int64)


def fitted_step(known: DataFrame, k: int) -> float:
    """A step from the distances to the k-th neighbour within a sample of at most SAMPLE_ROWS rows."""
    sample = np.unique(_matrix(known.orderBy(F.xxhash64("id"), "id").select("x").limit(SAMPLE_ROWS).toPandas()["x"]), axis=0)
    if len(sample) < 2:
        return 1.0
    gaps = np.sort(_distances(sample[:200], sample), axis=1)
    typical = float(np.median(gaps[:, min(k, len(sample) - 1)]))
    return STEP_SHARE * typical if typical > 0 else 1.0


def keyed_rows(part: pa.RecordBatch, keys_of: Callable[[np.ndarray], np.ndarray], bins: int) -> pa.RecordBatch:
    """Each row once for each of its different buckets, with the bucket's ``key`` and ``bin``. All vectors have one width."""
    points = matrix(part.column("x"), len(part.column("x")[0]))
    keys = np.sort(keys_of(points).reshape(len(points), -1), axis=1)
    new = np.ones(keys.shape, bool)
    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
    row, key = np.nonzero(new)[0], keys[new]
    out = part.take(pa.array(row))
    columns = [*out.columns, pa.array(key), pa.array((key % bins).astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "key", "bin"])


def approximate_neighbours(
    sides: _Sides, k: int, tables: int, hashes: int, probes: int, seed: int, tile_rows: int
) -> DataFrame:
    """``q, distance, id, label`` of the k nearest rows found for each query."""
    held = Tables.drawn(sides.width, tables, hashes, fitted_step(sides.known, k), seed)
    bins = -(-sides.rows * tables // tile_rows)
    names = sides.names

    def spread(each: int, keys_of) -> object:
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                step = max(1, CHUNK_PAIRS // each)
                for at in range(0, batch.num_rows, step):
                    yield keyed_rows(batch.slice(at, step), keys_of, bins)

        return send

    placed = sides.known.mapInArrow(
        spread(tables, held.keys), f"id {names.id_type}, label {names.label_type}, x array<double>, key long, bin int"
    )
    sent = sides.asked.mapInArrow(
        spread(tables * (probes + 1), lambda points: held.probes(points, probes)), f"q {names.query_type}, x array<double>, key long, bin int"
    ).withColumn("bound", F.lit(float("inf")))
    # At most as many rows as there are bins, one for each ``tile_rows`` rows of the index.
    sizes = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("rows")).toPandas()
    found = tiled_candidates(sent, placed, sizes, k, names, tile_rows, keyed=True)
    # A row that several tables find counts once.
    place = F.dense_rank().over(Window.partitionBy("q").orderBy("distance", "id"))
    return found.withColumn("place", place).filter(F.col("place") <= k).drop("place").dropDuplicates(["q", "id"])


def knn_approximate(
    train: DataFrame,
    queries: DataFrame,
    features: str | Sequence[str],
    label: str,
    train_id: str,
    query_id: str | None = None,
    k: int = 7,
    tables: int = 8,
    hashes: int = 8,
    probes: int = 40,
    seed: int = 2,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``(query id, prediction)`` as ``knn_classify`` gives it, from the neighbours that the hash tables find.

    More tables or probes raise the share of true neighbours found and the work. A query that meets no row at all gets
    the prediction NULL.
    """
    sides = _Sides.of(train, queries, features, label, train_id, query_id)
    best = approximate_neighbours(sides, k, tables, hashes, probes, seed, tile_rows)
    found = sides.voted(best)
    every = queries.select(F.col(sides.query_id))
    return every.join(found, sides.query_id, "left").select(sides.query_id, "prediction")


def knn_recall(
    train: DataFrame, queries: DataFrame, features: str | Sequence[str], label: str, train_id: str, query_id: str | None = None,
    k: int = 7, tables: int = 8, hashes: int = 8, probes: int = 40, seed: int = 2, tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``(query id, n_found, n_right, n_exact)``: how many neighbours the hash tables find for each query, how many of
    these the exact search finds as well, and how many it finds in all."""
    sides = _Sides.of(train, queries, features, label, train_id, query_id)
    found = approximate_neighbours(sides, k, tables, hashes, probes, seed, tile_rows).select("q", "id", F.lit(1).alias("found"))
    exact = exact_neighbours(sides, k).select("q", "id", F.lit(1).alias("exact"))
    both = found.join(exact, ["q", "id"], "full").groupBy("q").agg(
        F.count("found").alias("n_found"), F.count_if(F.col("found").isNotNull() & F.col("exact").isNotNull()).alias("n_right"),
        F.count("exact").alias("n_exact"),
    )
    return both.withColumnRenamed("q", sides.query_id)
