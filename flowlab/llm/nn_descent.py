"""Approximate nearest neighbours: a graph by NN-descent, searched greedily.

Nearness is the inner product. Vectors that are equal form a class, of which one goes into the graph; the others come
back with the result. The first graph joins rows whose signs agree on random planes, several times over. Each round
of NN-descent then looks at neighbours of neighbours: the neighbours of a node, forward and reverse, of which at least
one is new, are compared with each other, and those nearer than what a node has enter its list, until few lists change. Reverse neighbours of a
hub are drawn, about as many as a list has, so that no node gathers an unbounded group.

Equal queries are searched once. A query starts at entry nodes and, if an equal vector is in the graph, at its node and the
list of it. In each step its best nodes that have not been opened are opened: their neighbours, forward and reverse, are
scored, and the best ``pool`` stay, until all of the pool have been opened. The scores of the result are inner products in
double precision of the original vectors, added up in the order of the components.

Recall is a property of the data; the README gives what was measured.

Defined results: vectors that are null, zero, of another width than most or that hold null or non-finite components take
no part; a query's own row is never its neighbour; ties go to the smaller id; rows that repeat an id and vector count
once, with another vector the id is an error; fewer candidates than ``k`` give all; an empty table gives no rows. Only
the named columns are read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from flowlab.llm.tables import batch_of, written

K = 48
TREES = 4
LEAF = 200
SETTLED = 0.02
FIRST_LINKS = 5
POOL = 120
OPENED = 40
ENTRIES = 64
QUERY_BLOCK = 50_000
GROUP_NODES = 256

EDGE = "u long, v long, s float, fresh boolean"


def released(spark) -> None:
    """Lets Spark drop the shuffles of rounds that are over: it does so when the driver collects its garbage."""
    spark.sparkContext._jvm.System.gc()


def matrix(column: pa.ChunkedArray | pa.Array, kind: str = "<f4") -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), -1)


# ---------------------------------------------------------------- vectors


def valid_vectors(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id, vec`` (doubles): what takes part, one row an id. Of several vectors under one id the least in array order counts."""
    rows = table.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vec"))
    rows = rows.filter("id is not null and vec is not null").filter(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    )
    width = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if width is None:
        return rows
    return rows.filter(F.size("vec") == width.n).groupBy("id").agg(F.min("vec").alias("vec"))


def with_class(rows: DataFrame) -> DataFrame:
    """With ``h1, h2``, which equal vectors share."""
    return rows.withColumns({"h1": F.xxhash64("vec"), "h2": F.hash("vec")})


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """``node`` (the smallest id), ``vec`` and the ``k + 1`` smallest ids of each distinct vector."""
    named = with_class(rows)
    groups = named.groupBy("h1", "h2").agg(F.min("id").alias("node"), F.count("*").alias("size"))
    # Ids of copies: a running number over a class would gather it, so they come in two steps of a salt.
    salted = named.join(groups.filter("size > 1").select("h1", "h2"), ["h1", "h2"]).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    inner = Window.partitionBy("h1", "h2", "salt").orderBy("id")
    outer = Window.partitionBy("h1", "h2").orderBy("id")
    few = salted.select("h1", "h2", "salt", "id").withColumn("r", F.row_number().over(inner)).filter(F.col("r") <= k + 1)
    few = few.withColumn("r", F.row_number().over(outer)).filter(F.col("r") <= k + 1).groupBy("h1", "h2").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    reps = named.join(groups.select("h1", "h2", F.col("node").alias("id")), ["h1", "h2", "id"])
    return reps.join(few, ["h1", "h2"], "left").select(
        F.col("id").alias("node"), "vec", F.coalesce("ids", F.array("id")).alias("ids")
    )


def packed_vectors(classes: DataFrame) -> DataFrame:
    """``node, vec`` with the vector as bytes of 32-bit floats, for the graph."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("vec", pa.binary())])
        for batch in batches:
            if batch.num_rows:
                flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                # Very large components would overflow; nearness of directions is what the graph needs then.
                scale = np.maximum(1.0, np.abs(flat).max(axis=1, keepdims=True) / 1e15)
                yield batch_of(schema, batch.column(0), [v.tobytes() for v in (flat / scale).astype("<f4")])

    return written(classes.select("node", "vec").mapInArrow(pack, "node long, vec binary"), "vectors")


# ---------------------------------------------------------------- graph


def best(u: np.ndarray, v: np.ndarray, s: np.ndarray, k: int, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """The ``k`` greatest ``s`` of each ``u``, ties to the smaller ``v``; of a repeated pair the row that comes first."""
    order = np.lexsort((np.arange(len(u)), v, u))
    first = np.ones(len(u), bool)
    first[1:] = (u[order][1:] != u[order][:-1]) | (v[order][1:] != v[order][:-1])
    order = order[first]
    order = order[np.lexsort((v[order], -s[order], u[order]))]
    place = np.arange(len(order)) - np.searchsorted(u[order], u[order])
    order = order[place < k]
    return tuple(a[order] for a in (u, v, s, *more))


def first_graph(vectors: DataFrame, n: int, k: int, seed: int = 11) -> DataFrame:
    """Neighbours among the rows of equal signs on random planes. Crowded cells are cut by a hash."""
    planes = max(0, math.ceil(math.log2(max(1, n / LEAF))))
    each = math.ceil(k / TREES)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("vec", pa.binary()), ("tree", pa.int32()), ("cell", pa.int64())])
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            for tree in range(TREES):
                normals = np.random.default_rng([seed, tree]).normal(size=(x.shape[1], planes))
                signs = (x @ normals > 0) @ (1 << np.arange(planes)) if planes else np.zeros(len(x))
                yield batch_of(schema, *batch.columns, np.full(len(x), tree), signs.astype(np.int64))

    def joined(table: pa.Table) -> pa.Table:
        ids, x = table.column("node").to_numpy(), matrix(table.column("vec"))
        u, v, s = [], [], []
        for start in range(0, len(ids), 1024):
            near = x[start:start + 1024] @ x.T
            near[np.arange(len(near)), np.arange(start, start + len(near))] = -np.inf
            width = min(each, len(ids) - 1)
            if width < 1:
                continue
            at = np.argpartition(-near, width - 1, axis=1)[:, :width]
            u.append(np.repeat(ids[start:start + 1024], width))
            v.append(ids[at].ravel())
            s.append(np.take_along_axis(near, at, 1).ravel())
        return edges_table(u, v, s)

    rows = vectors.mapInArrow(cells, "node long, vec binary, tree int, cell long")
    sizes = rows.groupBy("tree", "cell").count()
    rows = rows.join(sizes, ["tree", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.ceil(F.col("count") / (4 * LEAF)))
    )
    return rows.select("node", "vec", "tree", "cell", "part").groupBy("tree", "cell", "part").applyInArrow(joined, EDGE)


def edges_table(u: list, v: list, s: list) -> pa.Table:
    u, v, s = (np.concatenate(a) if a else np.empty(0) for a in (u, v, s))
    return pa.table({
        "u": pa.array(u.astype(np.int64)), "v": pa.array(v.astype(np.int64)), "s": pa.array(s.astype(np.float32)),
        "fresh": pa.array(np.ones(len(u), bool)),
    })


def bucket(column: str, groups: int):
    return F.pmod(F.xxhash64(F.col(column)), F.lit(groups)).alias("bucket")


def merged(edges: DataFrame, groups: int, k: int) -> DataFrame:
    """The best ``k`` of each node; an edge known before is not new."""
    def keep(table: pa.Table) -> pa.Table:
        u, v, s, fresh = (table.column(c).to_numpy() for c in ("u", "v", "s", "fresh"))
        order = np.argsort(fresh, kind="stable")
        u, v, s, fresh = best(*(a[order] for a in (u, v, s)), k, fresh[order])
        return pa.table({"u": u, "v": v, "s": s, "fresh": fresh})

    return edges.select("u", "v", "s", "fresh", bucket("u", groups)).groupBy("bucket").applyInArrow(keep, EDGE)


def reverse_edges(graph: DataFrame, k: int, salt: int) -> DataFrame:
    """Edges turned round; those into a hub are drawn, about ``k`` of them."""
    degrees = graph.groupBy("v").count()
    draw = F.pmod(F.xxhash64("u", "v", F.lit(salt)), F.lit(1 << 20)) * F.col("count") < k * (1 << 20)
    return graph.join(degrees, "v").filter(draw).select(F.col("v").alias("u"), F.col("u").alias("v"), "s", "fresh")


def neighbours_of_neighbours(graph: DataFrame, vectors: DataFrame, groups: int, k: int, number: int) -> DataFrame:
    """New edges found among the neighbours of each node."""
    worst = graph.groupBy("u").agg(F.when(F.count("*") >= k, F.min("s")).otherwise(-float("inf")).cast("float").alias("least"))
    known = vectors.join(worst, vectors.node == worst.u, "left").select(
        F.col("node").alias("v"), "vec", F.coalesce("least", F.lit(-float("inf"))).cast("float").alias("least")
    )
    members = graph.union(reverse_edges(graph, k, number)).select(F.col("u").alias("w"), "v", "fresh")
    members = members.join(known, "v").select("w", "v", "fresh", "vec", "least", bucket("w", groups))
    limit = FIRST_LINKS if number == 0 else None

    def local_join(table: pa.Table) -> pa.Table:
        w, v, fresh, least = (table.column(c).to_numpy() for c in ("w", "v", "fresh", "least"))
        x = matrix(table.column("vec"))
        order = np.lexsort((~fresh, v, w))
        first = np.ones(len(order), bool)
        first[1:] = (w[order][1:] != w[order][:-1]) | (v[order][1:] != v[order][:-1])
        order = order[first]
        us, vs, ss = [], [], []
        for at in np.split(order, np.flatnonzero(np.diff(w[order])) + 1):
            new = fresh[at]
            if len(at) < 2 or not new.any():
                continue
            near = x[at] @ x[at].T
            np.fill_diagonal(near, -np.inf)
            ok = (near > least[at][:, None]) & (new[:, None] | new[None, :])
            if limit and len(at) > limit:
                # The first lists are so poor that nearly everything would enter; the best of each node do.
                near_ok = np.where(ok, near, -np.inf)
                ok &= near_ok >= -np.partition(-near_ok, limit - 1, axis=1)[:, limit - 1:limit]
            a, b = np.nonzero(ok)
            us.append(v[at[a]])
            vs.append(v[at[b]])
            ss.append(near[a, b])
        return edges_table(us, vs, ss)

    return members.groupBy("bucket").applyInArrow(local_join, EDGE)


def neighbour_graph(vectors: DataFrame, n: int, k: int = K) -> DataFrame:
    """``u, v, s, fresh``: about ``k`` neighbours of each node."""
    groups = max(1, math.ceil(n / GROUP_NODES))
    graph = written(merged(first_graph(vectors, n, k), groups, k), "graph")
    for number in itertools.count():
        old = graph.withColumn("fresh", F.lit(False))
        graph = written(merged(old.union(neighbours_of_neighbours(graph, vectors, groups, k, number)), groups, k), "graph")
        released(vectors.sparkSession)
        share = graph.agg(F.avg(F.col("fresh").cast("double"))).first()[0]
        if (share or 0) < SETTLED:
            break
    return graph


# ---------------------------------------------------------------- search


POOLED = "q long, v long, s float, opened boolean"


def searched(
    queries: DataFrame, homes: DataFrame, graph: DataFrame, vectors: DataFrame, *, k: int, pool: int, opened: int,
) -> DataFrame:
    """``q, v, s``: the best nodes found for each query of one block (``node, vec`` as bytes). ``homes``: ``q, home``, the
    node that equals a query, if there is one."""
    spark = queries.sparkSession
    rows = queries.collect()  # a block of bounded size
    ids = np.array([r.node for r in rows], np.int64)
    order = np.argsort(ids)
    shared = spark.sparkContext.broadcast((ids[order], np.stack([np.frombuffer(r.vec, "<f4") for r in rows])[order]))
    groups = max(1, math.ceil(len(rows) / GROUP_NODES))
    both = written(graph.select("u", "v").union(reverse_edges(graph, k, -1).select("u", "v")).distinct(), "both-ways")
    asked = spark.createDataFrame([(int(i),) for i in ids], "q long")
    entries = [r.node for r in vectors.select("node").orderBy(F.xxhash64("node"), "node").limit(ENTRIES).collect()]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, x = shared.value
        schema = pa.schema([("q", pa.int64()), ("v", pa.int64()), ("s", pa.float32()), ("opened", pa.bool_())])
        for batch in batches:
            if batch.num_rows:
                q = batch.column(0).to_numpy()
                s = np.einsum("ij,ij->i", x[np.searchsorted(names, q)], matrix(batch.column(2)))
                yield batch_of(schema, batch.column(0), batch.column(1), s, np.zeros(len(q), bool))

    def keep(table: pa.Table) -> pa.Table:
        q, v, s, was = (table.column(c).to_numpy() for c in ("q", "v", "s", "opened"))
        first = np.argsort(~was, kind="stable")
        q, v, s, was = best(*(a[first] for a in (q, v, s)), pool, was[first])
        return pa.table({"q": q, "v": v, "s": s, "opened": was})

    def rescored(pairs: DataFrame) -> DataFrame:
        found = pairs.join(vectors.withColumnRenamed("node", "v"), "v").select("q", "v", "vec")
        return found.mapInArrow(score, POOLED)

    def best_of(found: DataFrame) -> DataFrame:
        grouped = found.select("q", "v", "s", "opened", bucket("q", groups)).groupBy("bucket")
        return written(grouped.applyInArrow(keep, POOLED), "pool")

    # Every query meets the few entry nodes; those with a node of their own also that and its list.
    own = homes.join(F.broadcast(asked), "q")
    start = asked.withColumn("v", F.explode(F.array(*map(F.lit, entries)).cast("array<long>")))
    start = start.union(own.select("q", F.col("home").alias("v"))).union(both.join(F.broadcast(own), F.col("u") == F.col("home")).select("q", "v"))
    now = best_of(rescored(start.distinct()))
    # A pool only improves, so what it drops never comes back: a node is opened once a query at most, and this ends.
    while True:
        order_ = Window.partitionBy("q").orderBy(F.desc("s"), "v")
        front = now.filter("not opened").withColumn("r", F.row_number().over(order_)).filter(F.col("r") <= opened).select("q", F.col("v").alias("u"))
        front = written(front, "front")
        if front.isEmpty():
            break
        pairs = front.join(both, "u").select("q", "v").distinct()
        marked = now.join(front.select("q", F.col("u").alias("v"), F.lit(True).alias("now")), ["q", "v"], "left").select(
            "q", "v", "s", (F.col("opened") | F.coalesce("now", F.lit(False))).alias("opened")
        )
        now = best_of(marked.union(rescored(pairs)))
        released(spark)
    return now.select("q", "v", "s")


def nearest(
    table: DataFrame, queries: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", neighbours: int = 20,
    k: int = K, pool: int = POOL, opened: int = OPENED,
) -> DataFrame:
    """Per query and rank: ``query_id, rank, vec_id, score``. ``queries`` has the columns of ``table``; a query whose id
    is in the table is not compared with its own row."""
    everything = written(valid_vectors(table, vec_id, vector), "valid-vectors")
    classes = written(classes_of(everything, neighbours), "vector-classes")
    n = classes.count()
    asked = valid_vectors(queries, vec_id, vector)
    schema = "query_id long, rank int, vec_id long, score double"
    if not n or asked.isEmpty():
        return table.sparkSession.createDataFrame([], schema)
    vectors = packed_vectors(classes)
    graph = neighbour_graph(vectors, n, k)
    asked = written(with_class(asked), "queries")
    heads = asked.groupBy("h1", "h2").agg(F.min("id").alias("q"))
    # Copies among the queries are searched once, and the result is handed to all of them.
    members = written(asked.join(heads, ["h1", "h2"]).select("id", "q", "vec"), "query-classes")
    homes = written(heads.join(with_class(classes), ["h1", "h2"]).select("q", F.col("node").alias("home")), "homes")
    searching = members.filter("id = q").select("q", "vec")
    packed = packed_vectors(searching.withColumnRenamed("q", "node"))
    blocks = max(1, math.ceil(packed.count() / QUERY_BLOCK))
    found = None
    for number in range(blocks):
        block = packed.filter(F.pmod(F.xxhash64("node"), F.lit(blocks)) == number)
        part = searched(block, homes, graph, vectors, k=k, pool=max(pool, 2 * neighbours), opened=opened)
        found = part if found is None else found.union(part)
    return ranked(found, searching, members, classes, neighbours)


def exact_score(a, b):
    """The inner product in double precision, added up from the first component on."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def ranked(found: DataFrame, searching: DataFrame, members: DataFrame, classes: DataFrame, neighbours: int) -> DataFrame:
    pairs = found.join(searching, "q").join(
        classes.select(F.col("node").alias("v"), F.col("vec").alias("other"), "ids"), "v"
    )
    pairs = pairs.select("q", exact_score(F.col("vec"), F.col("other")).alias("score"), F.explode("ids").alias("id"))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    # One more than asked for, as one of them may be the row of the query itself.
    top = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= neighbours + 1)
    lists = written(top.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("near")), "lists")
    near = F.slice(F.filter("near", lambda x: x.id != F.col("own")), 1, neighbours)
    listed = members.select(F.col("id").alias("own"), "q").join(lists, "q").select("own", F.posexplode(near).alias("at", "x"))
    return listed.select(
        F.col("own").alias("query_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")
    )
