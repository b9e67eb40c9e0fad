"""Centroid clustering with a progressive search over Walsh-Hadamard coefficients.

Vectors become integers and are transformed once, exactly: the Walsh-Hadamard matrix holds only 1 and -1, so sums of
squared differences of coefficients are 64 times those of the components. Coefficients are ordered by their number of sign
changes, coarse to fine. A search adds up squared differences a few coefficients at a time; a centroid whose sum already
exceeds the finished distance of another one is strictly worse and goes, the rest are finished with all 64.

A round is one pass of tasks over the written coefficients. Tasks return a row of sums for each centroid, so the driver
sees clusters x components whole numbers and nothing that grows with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowlab.llm.tables import batch_of, written

WIDTH = 64
SCALE = 256
#: Coefficients added up before each elimination.
LEVELS = (4, 8, 16, 32, WIDTH)
#: Components beyond this many 256ths could overflow a 64-bit distance.
LARGEST = 1 << 24
ROWS = 4096


def _natural_order() -> np.ndarray:
    """Rows of the Walsh-Hadamard matrix by their number of sign changes."""
    h = walsh(np.eye(WIDTH, dtype=np.int64), np.arange(WIDTH))
    return np.argsort((np.diff(h, axis=1) != 0).sum(axis=1), kind="stable")


def walsh(values: np.ndarray, order: np.ndarray | None = None) -> np.ndarray:
    """The coefficients of each row of whole numbers, coarse to fine, by sums and differences alone."""
    order = ORDER if order is None else order
    out = values.copy()
    half = 1
    while half < WIDTH:
        pairs = out.reshape(len(out), WIDTH // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), WIDTH)
        half *= 2
    return out[:, order]


ORDER = _natural_order()
BACK = np.argsort(ORDER)


def components(coefficients: np.ndarray) -> np.ndarray:
    """The whole numbers whose coefficients these are."""
    return walsh(coefficients[:, BACK], np.arange(WIDTH)) // WIDTH


def nearest(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of coefficients the nearest centre (ties: the smaller number) and the squared distance."""
    sums = ((vectors[:, None, : LEVELS[0]] - centres[None, :, : LEVELS[0]]) ** 2).sum(axis=2)
    bound = ((vectors - centres[sums.argmin(axis=1)]) ** 2).sum(axis=1)
    row, centre = np.nonzero(sums <= bound[:, None])
    sums = sums[row, centre]
    for low, high in zip(LEVELS, LEVELS[1:]):
        sums = sums + ((vectors[row, low:high] - centres[centre, low:high]) ** 2).sum(axis=1)
        stay = sums <= bound[row]
        row, centre, sums = row[stay], centre[stay], sums[stay]
    order = np.lexsort((centre, sums, row))
    first = order[np.searchsorted(row[order], np.arange(len(vectors)))]
    return centre[first], sums[first] // WIDTH


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, WIDTH)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def coefficients(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, coefs`` for every vector of exactly WIDTH finite components; ``coefs`` is null where a component lies
    beyond 65,536, as its distances would not fit 64 bits."""
    x = F.col(vector_column).cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    kept = vectors.filter((F.size(x) == WIDTH) & finite)
    whole = F.transform(x, lambda v: F.floor(v * SCALE))
    fits = F.forall(x, lambda v: F.abs(v) <= LARGEST // SCALE)
    kept = kept.select(F.col(id_column).alias("id"), F.when(fits, whole).alias("coefs"))
    schema = pa.schema([("coefs", pa.list_(pa.int32()))])

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column("coefs").is_valid()
            made = walsh(_matrix(batch.column("coefs").drop_null())).astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(known.to_numpy(zero_copy_only=False)) * WIDTH])
            column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(made.ravel()), mask=pa.compute.invert(known))
            yield pa.RecordBatch.from_arrays([batch.column("id"), column.cast(schema.field(0).type)], ["id", "coefs"])

    kind = kept.schema["id"].dataType.simpleString()
    return kept.mapInArrow(change, f"id {kind}, coefs array<int>")


def first_centres(coefs: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``<seed>:<id>``; rows of equal hash in the order of their coefficients."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = coefs.orderBy(F.asc_nulls_last(order), "coefs").limit(clusters).collect()
    return components(np.array([r.coefs for r in rows], np.int64).reshape(-1, WIDTH))


def cluster_sums(coefs: DataFrame, centres: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """Number of rows and sum of coefficients of each non-empty cluster."""
    goals = walsh(centres)
    schema = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(goals), np.int64), np.zeros(goals.shape, np.int64)
        for batch in _pieces(batches):
            values = _matrix(batch.column("coefs"))
            cluster, _ = nearest(values, goals)
            n += np.bincount(cluster, minlength=len(goals))
            np.add.at(sums, cluster, values)
        held = np.flatnonzero(n)
        yield batch_of(schema, pa.array(held.astype(np.int32)), pa.array(n[held]), pa.array(list(sums[held]), schema.field("sums").type))

    parts = coefs.select("coefs").mapInArrow(summed, "cluster int, n long, sums array<long>")
    # A row for each component, so that the few keys there are spread over many tasks. Decimals keep sums of any size exact.
    cells = parts.select("cluster", "n", F.posexplode("sums").alias("place", "x"))
    cells = cells.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    sizes: dict[int, int] = {}
    sums: dict[int, list[int]] = {}
    for r in cells.collect():
        sizes[r.cluster] = r.n
        sums.setdefault(r.cluster, [0] * WIDTH)[r.place] = int(r.x)
    return [(c, sizes[c], sums[c]) for c in sorted(sums)]


def fitted(coefs: DataFrame, centres: np.ndarray, rounds: int) -> np.ndarray:
    """The centres after so many rounds: each non-empty one becomes the floor of the mean of its vectors."""
    centres = centres.copy()
    for _ in range(rounds if len(centres) else 0):
        for cluster, n, sums in cluster_sums(coefs, centres):
            total = components(np.array([sums], object))[0]
            centres[cluster] = [s // n for s in total]
    return centres


def assigned(coefs: DataFrame, centres: np.ndarray) -> DataFrame:
    """``id, cluster, distance`` of every row."""
    goals = walsh(centres)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            cluster, distance = nearest(_matrix(batch.column("coefs")), goals)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"]
            )

    kind = coefs.schema["id"].dataType.simpleString()
    return coefs.mapInArrow(found, f"id {kind}, cluster int, distance long")


def clustered(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", clusters: int = 40, rounds: int = 5, seed: int = 2
) -> DataFrame:
    """``<id>, cluster, distance, cluster_inertia, inertia, centroid`` for every row whose vector has WIDTH components, none
    null, NaN or infinite; the others are left out.

    Vectors are counted in 256ths, rounded down. Fewer rows than ``clusters`` start as many centroids; rows of one id are
    vectors of their own; a null id is chosen as a start last. A vector with a component beyond 65,536 takes no part and has
    null in all other columns, as do sums that do not fit 64 bits. No rows give no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    coefs = written(coefficients(vectors, id_column, vector_column), "coefficients")
    near = coefs.filter("coefs is not null")
    centres = fitted(near, first_centres(near, clusters, seed), rounds)
    if not len(centres):
        empty = "cast(null as {0}) as {1}"
        return coefs.select(F.col("id").alias(id_column), *[
            F.expr(empty.format(kind, name)) for kind, name in (
                ("int", "cluster"), ("long", "distance"), ("long", "cluster_inertia"), ("long", "inertia"), ("array<long>", "centroid"))
        ])
    found = written(assigned(near, centres), "clusters")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(exact.alias("total")).collect()}
    whole = sum(inertia.values())
    fits = lambda v: v if v < 1 << 63 else None
    facts = spark.createDataFrame(
        [(c, fits(total), fits(whole), [int(x) for x in centres[c]]) for c, total in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    far = coefs.filter("coefs is null").select("id", F.expr("cast(null as int)").alias("cluster"), F.expr("cast(null as long)").alias("distance"))
    # One row for each of the clusters.
    joined = found.union(far).join(F.broadcast(facts), "cluster", "left")
    return joined.select(F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(centroid: str = "centroid"):
    """SHA-256 of the components as decimal numbers with commas between them."""
    return F.sha2(F.concat_ws(",", F.col(centroid).cast("array<string>")), 256)

