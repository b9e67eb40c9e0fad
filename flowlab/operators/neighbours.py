"""Exact k-nearest-neighbour classification.

A training set whose size was checked is broadcast and each task scores its own query rows.

Beyond that size the search takes two rounds over an index of pivots. Training rows are put into cells around pivots, found
by way of a coarser level of pivots; the number of cells follows the number of rows. Cells that lie close together share
a bin. In the first round a query meets the rows of its own bin, whose k-th distance is a bound that real rows have set. In
the second it visits the other bins that hold a cell which, by the triangle inequality, can hold a nearer row. Large bins
are tiled on both sides, so a cell with a third of all rows is many small tasks. A task emits k candidates per query and
tile at most, none beyond the bound, and never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlab.functions.names import quoted
from flowlab.storage import checkpointed

# Every Python worker of an executor holds a broadcast table of its own.
BROADCAST_BYTES = 16 << 20
# Distances held at a time, rows per tile side, rows of a cell on average.
SLICE_CELLS = 1 << 19
TILE_ROWS = 1 << 15
CELL_ROWS = 1 << 10
# The pivots travel to every task: beyond these bytes cells grow instead of their number.
PIVOT_BYTES = 32 << 20


def _sql_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float) if len(column) else np.empty((0, 0))


def nearest(queries: np.ndarray, train: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Yield ``(query row, train row, distance)`` of the k nearest, ties to the lower train row.

    A matrix product screens the pairs with room for its rounding; the distances of those left
    are then computed exactly, dimension by dimension.
    """
    k = min(k, len(train))
    if not k or not len(queries):
        return
    train_sq = np.einsum("ij,ij->i", train, train)
    step = max(1, SLICE_CELLS // len(train))
    for start in range(0, len(queries), step):
        q = queries[start:start + step]
        q_sq = np.einsum("ij,ij->i", q, q)
        rough = q_sq[:, None] + train_sq[None, :] - 2.0 * (q @ train.T)
        limit = np.partition(rough, k - 1, axis=1)[:, k - 1] + 1e-9 * (q_sq + train_sq.max())
        row, col = np.nonzero(rough <= limit[:, None])
        squares = np.zeros(len(row))
        for d in range(train.shape[1]):
            gap = q[row, d] - train[col, d]
            squares += gap * gap
        distance = np.sqrt(squares)
        order = np.lexsort((col, distance, row))
        row, col, distance = row[order], col[order], distance[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < k
        yield row[best] + start, col[best], distance[best]


@dataclass(frozen=True)
class _Columns:
    """The columns of a training table under fixed names, with the SQL types of the originals."""

    id_type: str
    label_type: str
    query_type: str

    @property
    def candidates(self) -> str:
        return f"q {self.query_type}, distance double, id {self.id_type}, label {self.label_type}"


def _candidates(
    queries: pd.DataFrame, train: pd.DataFrame, k: int, points: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, pd.DataFrame]]:
    """The k nearest training rows of each query, given as columns q/x and id/label/x sorted by id, and the place of the
    query of each. ``points`` are the training vectors, if they do not come as the column x."""
    for row, col, distance in nearest(_matrix(queries["x"]), _matrix(train["x"]) if points is None else points, k):
        yield row, pd.DataFrame({
            "q": queries["q"].to_numpy()[row], "distance": distance,
            "id": train["id"].to_numpy()[col], "label": train["label"].to_numpy()[col],
        })


def _usable(vector: Column) -> Column:
    """True where a vector and all its elements are known and finite."""
    return F.coalesce(F.forall(vector, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)) & ~F.isnan(v)), F.lit(False))


def _by_broadcast(train: DataFrame, queries: DataFrame, k: int, names: _Columns) -> DataFrame:
    rows = train.toArrow().to_pandas().sort_values("id", kind="stable", ignore_index=True)
    # The vectors as one matrix: no batch of queries copies them again.
    table = train.sparkSession.sparkContext.broadcast((rows.drop(columns="x"), _matrix(rows["x"])))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from (found for _, found in _candidates(batch, table.value[0], k, table.value[1]))

    return queries.mapInPandas(score, names.candidates)


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (points * points).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2.0 * (points @ pivots.T)
    return np.sqrt(np.clip(squares, 0.0, None))


def _binned(cells: pd.DataFrame, pivots: np.ndarray, tile_rows: int) -> pd.DataFrame:
    """The cells in the order of their pivots' main axis, cut into bins of about ``tile_rows``."""
    here = pivots[cells["cell"]]
    axis = np.linalg.svd(here - here.mean(0), full_matrices=False)[2][0]
    cells = cells.iloc[np.argsort(here @ axis, kind="stable")].reset_index(drop=True)
    return cells.assign(bin=(cells["rows"].cumsum() - cells["rows"]) // tile_rows)


@dataclass(frozen=True)
class _Pivots:
    """Pivots in two levels: ``fine[first[g]:first[g + 1]]`` belong to ``coarse[g]``."""

    coarse: np.ndarray
    fine: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray) -> _Pivots:
        """Every so manyth point is a coarse pivot; the fine ones go to their nearest."""
        coarse = points[:: max(1, round(len(points) ** 0.5))]
        group = np.concatenate([_distances(points[i:i + 4096], coarse).argmin(1) for i in range(0, len(points), 4096)])
        order = group.argsort(kind="stable")
        return cls(coarse, points[order], np.searchsorted(group[order], np.arange(len(coarse) + 1)))

    def cells(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A cell for each point, and the distance to its pivot: the nearest pivot of the nearest coarse one. Another
        pivot may be nearer; a cell's radius covers the points that are put there, which is all that the search needs."""
        group = _distances(points, self.coarse).argmin(1)
        # A coarse pivot is one of the points, but an equal one may have taken its whole group.
        group = np.where(np.diff(self.first)[group] > 0, group, np.diff(self.first).argmax())
        cell, gap = np.empty(len(points), np.int64), np.empty(len(points))
        for g in np.unique(group):
            here = np.flatnonzero(group == g)
            gaps = _distances(points[here], self.fine[self.first[g]:self.first[g + 1]])
            nearest_one = gaps.argmin(1)
            cell[here], gap[here] = self.first[g] + nearest_one, gaps[np.arange(len(here)), nearest_one]
        return cell, gap

    def reach(self, radius: np.ndarray) -> np.ndarray:
        """For each coarse pivot a ball that holds all rows of its cells; ``radius`` is negative for a cell without rows."""
        out = np.full(len(self.coarse), -np.inf)
        for g in range(len(self.coarse)):
            at = slice(self.first[g], self.first[g + 1])
            if at.stop > at.start and (radius[at] >= 0).any():
                far = _distances(self.coarse[g:g + 1], self.fine[at])[0] + radius[at]
                out[g] = far[radius[at] >= 0].max()
        return out

    def open_cells(self, points: np.ndarray, bound: np.ndarray, radius: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(point, cell)`` of all cells whose ball comes within ``bound`` of a point."""
        rows, cells = [], []
        gaps = _distances(points, self.coarse)
        for g in np.flatnonzero(np.isfinite(reach)):
            near = np.flatnonzero(gaps[:, g] - reach[g] <= bound)
            if not len(near):
                continue
            at = slice(self.first[g], self.first[g + 1])
            open_here = (_distances(points[near], self.fine[at]) - radius[at] <= bound[near, None]) & (radius[at] >= 0)
            row, cell = np.nonzero(open_here)
            rows.append(near[row])
            cells.append(cell + at.start)
        if not rows:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(rows), np.concatenate(cells)


def _picked_pivots(train: DataFrame, rows: int, cell_rows: int) -> _Pivots:
    """A repeatable pick of training rows by the hash of their ids, about one for each cell; equal rows count once."""
    width = len(train.first().x)
    wanted = int(max(1, min(rows // cell_rows, PIVOT_BYTES // (8 * max(width, 1)))))
    share = max(1, rows // wanted)
    chosen = train.filter(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).select("x").limit(2 * wanted).toPandas()
    points = _matrix(chosen["x"])
    if not len(points):
        points = _matrix(train.select("x").limit(1).toPandas()["x"])
    return _Pivots.of(np.unique(points, axis=0))


@dataclass(frozen=True)
class _Index:
    """Training rows in cells and bins."""

    placed: DataFrame
    cells: pd.DataFrame
    pivots: _Pivots
    names: _Columns
    tile_rows: int

    @classmethod
    def of(cls, train: DataFrame, rows: int, names: _Columns, tile_rows: int, cell_rows: int) -> _Index:
        pivots = _picked_pivots(train, rows, cell_rows)

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    cell, gap = pivots.cells(_matrix(batch["x"]))
                    yield batch.assign(cell=cell.astype("int32"), gap=gap)

        # Kept as written: a second assignment on other hardware could round a near tie to another
        # cell, whose radius would then not cover the row.
        placed = checkpointed(train.mapInPandas(
            assign, f"id {names.id_type}, label {names.label_type}, x array<double>, cell int, gap double"
        ))
        # A row for each pivot at most.
        cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("gap").alias("radius")).toPandas()
        return cls(placed, _binned(cells, pivots.fine, tile_rows), pivots, names, tile_rows)

    def _facts(self) -> tuple[np.ndarray, np.ndarray]:
        """Radius (negative without rows) and bin of every cell."""
        radius, bins = np.full(len(self.pivots.fine), -1.0), np.zeros(len(self.pivots.fine), np.int64)
        radius[self.cells["cell"]], bins[self.cells["cell"]] = self.cells["radius"], self.cells["bin"]
        return radius, bins

    def homes(self, queries: DataFrame) -> DataFrame:
        """``q, x, bin``: the bin of the nearest cell that has rows."""
        pivots, (radius, bins) = self.pivots, self._facts()
        filled = np.flatnonzero(radius >= 0)

        def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    cell, _ = pivots.cells(_matrix(batch["x"]))
                    # A cell without rows has a neighbour with some.
                    cell = np.where(radius[cell] >= 0, cell, filled[np.minimum(np.searchsorted(filled, cell), len(filled) - 1)])
                    yield batch.assign(bin=bins[cell].astype("int32"))

        return queries.mapInPandas(send, f"q {self.names.query_type}, x array<double>, bin int")

    def visits(self, bounded: DataFrame) -> DataFrame:
        """``q, x, bin, bound`` for each other bin that may hold a row within ``bound`` of the query (``q, x, bin, bound``,
        bin: the one it comes from)."""
        pivots, (radius, bins) = self.pivots, self._facts()
        reach = pivots.reach(radius)
        length = float(np.sqrt((pivots.fine * pivots.fine).sum(1)).max()) + float(radius.max())

        def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                points = _matrix(batch["x"])
                # Room for the rounding of the distances, which is about 3e-8 of the lengths.
                slack = 1e-6 * (np.sqrt((points * points).sum(1)) + length)
                row, cell = pivots.open_cells(points, batch["bound"].to_numpy() + slack, radius, reach)
                pairs = np.unique(row * (int(bins.max()) + 1) + bins[cell])
                row, found = np.divmod(pairs, int(bins.max()) + 1)
                away = found != batch["bin"].to_numpy()[row]
                row, found = row[away], found[away]
                yield pd.DataFrame({
                    "q": batch["q"].to_numpy()[row], "x": batch["x"].to_numpy()[row], "bin": found.astype("int32"),
                    "bound": batch["bound"].to_numpy()[row],
                })

        return bounded.mapInPandas(send, f"q {self.names.query_type}, x array<double>, bin int, bound double")

    def matched(self, sent: DataFrame, k: int) -> DataFrame:
        """At most k candidates for each query, bin and tile, none beyond the ``bound`` of the query."""
        # Bins of both sides need one type: rows are dealt out by the hash of their keys, which tells int from long.
        homes = sent.sparkSession.createDataFrame(self.cells[["cell", "bin"]], "cell int, bin int")
        sizes = self.cells.groupby("bin", as_index=False)["rows"].sum()
        return tiled_candidates(sent, self.placed.join(F.broadcast(homes), "cell"), sizes, k, self.names, self.tile_rows)


def tiled_candidates(
    sent: DataFrame, placed: DataFrame, sizes: pd.DataFrame, k: int, names: _Columns, tile_rows: int, keyed: bool = False
) -> DataFrame:
    """At most k candidates for each query (``q, x, bin, bound``) among the rows (``id, label, x, bin``) of its bin, and
    for each tile of the bin; none beyond the bound. ``sizes`` counts the rows of every bin (``bin, rows``).

    With ``keyed`` both sides have a ``key`` too, and a query meets rows of its own key alone.
    """
    spark = sent.sparkSession
    # Both sides of a bin are tiled by its own row counts.
    asked = sent.groupBy("bin").agg(F.count(F.lit(1)).alias("queries")).toPandas()
    sizes = sizes.merge(asked, on="bin")
    if sizes.empty:
        return spark.createDataFrame([], names.candidates)
    sizes["t"], sizes["u"] = -(-sizes["rows"] // tile_rows), -(-sizes["queries"] // tile_rows)
    grid = F.broadcast(spark.createDataFrame(sizes[["bin", "t", "u"]], "bin int, t long, u long"))
    key = ["key"] if keyed else []
    train_tiles = placed.join(grid, "bin").select(
        "id", "label", "x", *key, "bin", F.pmod(F.xxhash64("id"), "t").cast("int").alias("tile"),
        F.explode(F.sequence(F.lit(0), F.col("u").cast("int") - 1)).alias("part"),
    )
    query_tiles = sent.join(grid, "bin").select(
        "q", "x", "bound", *key, "bin", F.explode(F.sequence(F.lit(0), F.col("t").cast("int") - 1)).alias("tile"),
        F.pmod(F.xxhash64("q"), "u").cast("int").alias("part"),
    )

    def met(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[pd.DataFrame]:
        limit = left["bound"].to_numpy()
        for row, part in _candidates(left, right, k):
            yield part[part["distance"].to_numpy() <= limit[row]]

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            right = right.sort_values("id", kind="stable", ignore_index=True)
            if keyed:
                groups = right.groupby("key").indices
                for value, rows in left.groupby("key").indices.items():
                    if value in groups:
                        found += met(left.iloc[rows], right.iloc[groups[value]])
            else:
                found += met(left, right)
        return pd.concat(found) if found else pd.DataFrame(columns=["q", "distance", "id", "label"])

    keys = ["bin", "tile", "part"]
    return query_tiles.groupBy(*keys).cogroup(train_tiles.groupBy(*keys)).applyInPandas(score, names.candidates)


def _first_k(candidates: DataFrame, k: int) -> DataFrame:
    nearest_first = Window.partitionBy("q").orderBy("distance", "id")
    return candidates.withColumn("place", F.row_number().over(nearest_first)).filter(F.col("place") <= k).drop("place")


def _two_rounds(index: _Index, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The k nearest of each query as ``q, distance, id, label``, and the visits of the second round."""
    home = checkpointed(index.homes(queries))
    unbounded = home.withColumn("bound", F.lit(float("inf")))
    first = checkpointed(_first_k(index.matched(unbounded, k), k))
    # Fewer than k rows in the home bin set no bound.
    limits = first.groupBy("q").agg(F.count("*").alias("n"), F.max("distance").alias("farthest"))
    limits = limits.filter(F.col("n") == k).select("q", F.col("farthest").alias("bound"))
    bounded = home.join(limits, "q", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    visits = checkpointed(index.visits(bounded.select("q", "x", "bin", "bound")))
    second = index.matched(visits, k)
    return _first_k(first.unionByName(second), k), visits


@dataclass(frozen=True)
class _Sides:
    """Both tables under fixed names, checked."""

    known: DataFrame
    asked: DataFrame
    unanswered: DataFrame
    names: _Columns
    rows: int
    bytes: int
    width: int
    query_id: str

    @classmethod
    def of(cls, train: DataFrame, queries: DataFrame, features: str | Sequence[str], label: str, train_id: str, query_id: str | None) -> _Sides:
        query_id = query_id or train_id
        vector = (
            quoted(features).cast("array<double>") if isinstance(features, str)
            else F.array(*[quoted(c).cast("double") for c in features])
        )
        names = _Columns(_sql_type(train, train_id), _sql_type(train, label), _sql_type(queries, query_id))
        known = train.select(quoted(train_id).alias("id"), quoted(label).alias("label"), vector.alias("x"))
        asked = queries.select(quoted(query_id).alias("q"), vector.alias("x"))
        size = known.agg(
            F.count(F.lit(1)), F.sum(F.size("x") * 8 + F.octet_length(F.to_json(F.struct("id", "label"))) + 64),
            F.count_if(~_usable(F.col("x"))), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most"),
        ).first()
        if not size[0]:
            raise ValueError("the training table is empty")
        if size[2] or size.least != size.most:
            raise ValueError(f"{size[2]} training rows are not finite; widths {size.least} to {size.most}")
        if not asked.groupBy("q").count().filter("count > 1").isEmpty():
            raise ValueError("query ids repeat")
        fit = _usable(F.col("x")) & (F.size("x") == size.most)
        unanswered = asked.filter(~fit).select("q", F.lit(None).cast(names.label_type).alias("prediction"))
        return cls(known, asked.filter(fit), unanswered, names, size[0], size[1], size.most, query_id)

    def voted(self, best: DataFrame) -> DataFrame:
        """The most frequent label of each query, the lowest on a tie."""
        votes = best.groupBy("q", "label").agg(F.count(F.lit(1)).alias("n"))
        found = votes.groupBy("q").agg(F.min_by("label", F.struct((-F.col("n")).alias("n"), "label")).alias("prediction"))
        return found.union(self.unanswered).select(F.col("q").alias(self.query_id), "prediction")


def exact_neighbours(
    sides: _Sides, k: int, broadcast_bytes: int = BROADCAST_BYTES, tile_rows: int = TILE_ROWS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``q, distance, id, label`` of the k nearest training rows of each query that can be compared."""
    if sides.bytes <= broadcast_bytes:
        # Every candidate list is complete: each query was scored against the whole table.
        return _by_broadcast(sides.known, sides.asked, k, sides.names)
    return _two_rounds(_Index.of(sides.known, sides.rows, sides.names, tile_rows, cell_rows), sides.asked, k)[0]


def knn_classify(
    train: DataFrame,
    queries: DataFrame,
    features: str | Sequence[str],
    label: str,
    train_id: str,
    query_id: str | None = None,
    k: int = 7,
    broadcast_bytes: int = BROADCAST_BYTES,
    tile_rows: int = TILE_ROWS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``(query id, prediction)`` by majority of the k nearest training rows (Euclidean).

    ``features`` names one array column or several numeric ones. Equal distances go to the lower
    training id, equal votes to the lower label. Training rows must be known and finite and of one
    width; a query with a NULL, NaN or infinite feature, or of another width, has no neighbours and
    gets the prediction NULL. Query ids must be unique; ids that repeat are refused.
    """
    sides = _Sides.of(train, queries, features, label, train_id, query_id)
    best = exact_neighbours(sides, k, broadcast_bytes, tile_rows, cell_rows)
    return sides.voted(best)


def knn_visits(
    train: DataFrame, queries: DataFrame, features: str, label: str, train_id: str, k: int = 7,
    tile_rows: int = TILE_ROWS, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``(query id, bins, of)``: how many bins the two rounds of the search visit for each query, its own included, and
    how many there are. For finite vectors of one width, given as an array column; see ``knn_classify``."""
    names = _Columns(_sql_type(train, train_id), _sql_type(train, label), _sql_type(queries, train_id))
    vector = quoted(features).cast("array<double>")
    known = train.select(quoted(train_id).alias("id"), quoted(label).alias("label"), vector.alias("x"))
    asked = queries.select(quoted(train_id).alias("q"), vector.alias("x"))
    index = _Index.of(known, known.count(), names, tile_rows, cell_rows)
    _, visits = _two_rounds(index, asked, k)
    others = visits.groupBy("q").count()
    counted = asked.select("q").join(others, "q", "left")
    return counted.select(
        F.col("q").alias(train_id), (F.coalesce("count", F.lit(0)) + 1).alias("bins"), F.lit(int(index.cells["bin"].nunique())).alias("of")
    )
