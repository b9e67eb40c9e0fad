"""Near duplicates by MinHash with tensored banding, confirmed on full sets.

Two collections of ``SIDE`` half keys each, of ``ROWS`` minhashes a half key, give ``SIDE * SIDE`` tables: the key of
table (i, j) combines half key i of the first and half key j of the second collection. 2 * SIDE * ROWS minhashes thus
stand for SIDE * SIDE * 2 * ROWS. Two sets of similarity s meet in no table with probability
1 - (1 - (1 - s^ROWS)^SIDE)^2, which is 0.0004 at s = 0.8 and 0.00002 at s = 0.85 for the defaults.

1. Texts with equal word sequences form a class, of which one row goes on: copies never make pairs.
2. Rows of a table key are linked to the smallest of them, a line for each row; the components of these links hold
   every pair that shares a key.
3. Inside a component all sets are compared, exactly and on whole texts, by products of incidence matrices. Components
   of more than ``TILE`` classes are cut into tiles, and each pair of tiles is one group, so that no task holds an
   unbounded group. A group returns a spanning forest of its links, not the links.
4. The components of those forests are the result.

A set: the distinct ``shingle``-word shingles of the words (A-Z in lower case, split at ASCII white space); fewer words
are one shingle; texts without words, or null, have the empty set and link with nothing. Links have
100 * intersection >= ``PERCENT`` * union.

Defined results: rows that repeat an id and text are one class and share its component; rows that repeat an id with
different texts are different; a null id never names a component unless it has no other; an empty table gives no rows.
Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from flowlab.llm.components import components
from flowlab.llm.tables import batch_of, written
from flowlab.llm.words import RecentCache, hashed, mixed, spaced_words, word_hashes

SHINGLE = 4
PERCENT = 80
SIDE = 12
ROWS = 3
TILE = 256
#: Rows of 16 to 40 bytes that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000
COLUMNS = 4096


# ---------------------------------------------------------------- sets


def shingles(words: list[bytes], cache: RecentCache, size: int = SHINGLE) -> np.ndarray:
    """The set as sorted 64-bit hashes."""
    h = hashed(words, cache)
    if len(h) == 0:
        return h
    if len(h) < size:
        h = np.pad(h, (0, size - len(h)))
    with np.errstate(over="ignore"):
        out = mixed(h[:len(h) - size + 1] + np.uint64(size))
        for k in range(1, size):
            out = mixed(out ^ h[k:len(h) - size + 1 + k])
    return np.unique(out)


class Tensor:
    """The two collections of half keys."""

    def __init__(self, side: int, rows: int, seed: int = 7):
        self.side, self.rows = side, rows
        random = np.random.default_rng(seed)
        self.factors = random.integers(0, 1 << 63, 2 * side * rows, np.uint64) * np.uint64(2) + np.uint64(1)

    def half_keys(self, items: np.ndarray) -> np.ndarray:
        """2 * side numbers: a minhash is the least product with an odd factor, a half key combines ``rows`` of them."""
        least = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(0, len(items), 4096):
                np.minimum(least, (self.factors[:, None] * items[None, i:i + 4096]).min(axis=1), out=least)
            parts = least.reshape(2 * self.side, self.rows)
            key = np.zeros(2 * self.side, np.uint64)
            for r in range(self.rows):
                key = mixed(key ^ parts[:, r])
        return key


def name_of(words: list[bytes]) -> tuple[int, int]:
    """A 128-bit hash of the word sequence as two signed numbers."""
    h = xxhash.xxh3_128_intdigest(b" ".join(words))
    high, low = h >> 64, h & (1 << 64) - 1
    return high - (1 << 64) * (high >> 63), low - (1 << 64) * (low >> 63)


def prints(docs: DataFrame, doc_id: str, text: str, shingle: int, side: int, rows: int) -> DataFrame:
    """Per row: a number of its own, ``doc_id``, a hash of the raw text, the class, the size of its set, its half keys."""
    source = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("raw"),
        F.col(f"`{text}`").cast("string").alias("body"),
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, tensor = word_hashes(), Tensor(side, rows)
        for batch in batches:
            out = []
            for body in batch.column(2):
                words = spaced_words(body.as_py())
                items = shingles(words, cache, shingle)
                keys = tensor.half_keys(items).view(np.int64).tolist() if len(items) else []
                out.append((*name_of(words), len(items), keys[:side], keys[side:]))
            if out:
                yield batch_of(schema, *batch.columns[:2], *zip(*out))

    schema = pa.schema([
        ("doc_id", pa.int64()), ("raw", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int64()),
        ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64())),
    ])
    kinds = "doc_id long, raw long, h1 long, h2 long, n long, left array<long>, right array<long>"
    return written(source.mapInArrow(sketch, kinds).withColumn("row", F.monotonically_increasing_id()), "prints")


# ---------------------------------------------------------------- candidates


def table_links(reps: DataFrame) -> DataFrame:
    """``leader, node``: every row of a table key with the smallest row of that key."""
    keyed = reps.select("node", "right", F.posexplode("left").alias("i", "a")).select(
        "node", "i", "a", F.posexplode("right").alias("j", "b")
    ).select("node", F.xxhash64("i", "a", "j", "b").alias("key"))
    # Nearly all keys have one row: the rows are dealt out by key once, and nothing is summed up before that.
    leader = F.min("node").over(Window.partitionBy("key"))
    return keyed.select("node", leader.alias("leader")).filter("node <> leader").select("leader", "node").distinct()


# ---------------------------------------------------------------- confirmation


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets are similar enough, as a square matrix of booleans."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # What only one set holds is in no intersection.
    shared = np.cumsum(count > 1) - 1
    use = count[place] > 1
    owner, column = owner[use], shared[place[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (start, start + COLUMNS))
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        common += part @ part.T
    both = common.astype(np.int64)
    return 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)


def forest(near: np.ndarray) -> np.ndarray:
    """The smallest place that each place can reach."""
    reach = np.arange(len(near))
    while True:
        new = np.where(near, reach[None, :], len(near)).min(axis=1)
        new = np.minimum(new, reach)
        new = new[new]
        if (new == reach).all():
            return reach
        reach = new


def confirm(table: pa.Table, percent: int) -> pa.Table:
    """Links ``u, v`` that span what is similar among the rows of each component of a group."""
    u, v = [], []
    component = table.column("component").to_numpy()
    node = table.column("node").to_numpy()
    order = np.lexsort((node, component))
    first = np.ones(len(order), bool)
    first[1:] = (component[order][1:] != component[order][:-1]) | (node[order][1:] != node[order][:-1])
    order = order[first]  # a class comes once, even if its row is repeated
    cuts = np.flatnonzero(np.diff(component[order])) + 1
    blobs = table.column("items")
    for members in np.split(order, cuts):
        if len(members) < 2:
            continue
        sets = [np.frombuffer(blobs[int(i)].as_py(), np.uint64) for i in members]
        least = forest(linked(sets, percent))
        names = node[members]
        moved = least != np.arange(len(members))
        u += names[moved].tolist()
        v += names[least[moved]].tolist()
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def confirmed_links(docs: DataFrame, members: DataFrame, text: str, doc_id: str, shingle: int, percent: int, tile: int) -> DataFrame:
    """``members``: ``doc_id, h1, h2, node, component``. Sets are built anew from whole texts of the rows that matter."""
    count = members.count()
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    placed = members.join(sizes, "component")
    if count <= BROADCAST_ROWS:
        placed = F.broadcast(placed)
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("body"))
    rows = source.join(placed, F.col("id").eqNullSafe(F.col("doc_id"))).select("body", "h1", "h2", "node", "component", "size")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_hashes()
        for batch in batches:
            out = []
            body, *rest = (c.to_pylist() for c in batch.columns)
            for b, h1, h2, *names in zip(body, *rest):
                words = spaced_words(b)
                if name_of(words) == (h1, h2):
                    out.append((*names, shingles(words, cache, shingle).tobytes()))
                    if len(out) >= 500:
                        yield batch_of(schema, *zip(*out))
                        out = []
            if out:
                yield batch_of(schema, *zip(*out))

    schema = pa.schema([("node", pa.int64()), ("component", pa.int64()), ("size", pa.int64()), ("items", pa.binary())])
    found = rows.mapInArrow(sets, "node long, component long, size long, items binary")
    # Small components share groups; a large one has a group for each pair of its tiles.
    tiles = F.ceil(F.col("size") / tile).cast("int")
    own = F.pmod(F.xxhash64("node"), tiles).cast("int")
    bins = max(1, count // tile)
    found = found.withColumns({"tiles": tiles, "own": own}).withColumn(
        "other", F.explode(F.when(F.col("tiles") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("tiles") - 1)))
    ).select(
        "node", "component", "items",
        F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("component"), F.lit(bins))).otherwise(F.col("component")).alias("group"),
        F.when(F.col("tiles") == 1, -1).otherwise(F.least("own", "other")).alias("a"),
        F.when(F.col("tiles") == 1, -1).otherwise(F.greatest("own", "other")).alias("b"),
    )
    return found.groupBy("group", "a", "b").applyInArrow(lambda table: confirm(table, percent), "u long, v long")


# ---------------------------------------------------------------- operator


def assigned(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
    side: int = SIDE, rows: int = ROWS, tile: int = TILE,
) -> DataFrame:
    """Per row: ``row, doc_id, raw, n_shingles, group, component_id``; ``group`` numbers the component, also without ids."""
    table = prints(docs, doc_id, text, shingle, side, rows)
    classes = written(
        table.filter("n > 0").groupBy("h1", "h2").agg(F.min("row").alias("node"), F.min("doc_id").alias("class_doc")), "classes"
    )
    reps = table.join(classes.select("node"), F.col("row") == F.col("node"), "left_semi")
    reps = reps.select(F.col("row").alias("node"), "left", "right")
    candidates = written(components(table_links(reps), "leader", "node"), "candidates")
    # The text of a class is fetched by the id of its first row.
    members = candidates.join(
        table.select(F.col("row").alias("node"), "doc_id", "h1", "h2"), "node"
    ).select("doc_id", "h1", "h2", "node", "component")
    links = confirmed_links(docs, written(members, "members"), text, doc_id, shingle, percent, tile)
    final = components(links, "u", "v")
    groups = classes.join(final, "node", "left").withColumn("group", F.coalesce("component", "node"))
    named = groups.groupBy("group").agg(F.min("class_doc").alias("component_id"))
    groups = groups.select("h1", "h2", "group").join(named, "group")
    return table.drop("left", "right").join(groups, ["h1", "h2"], "left").select(
        "row", "doc_id", "raw", F.col("n").alias("n_shingles"), F.coalesce("group", "row").alias("group"),
        F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``."""
    return assigned(docs, **options).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def deduplicated(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component, that of the smallest id, with the columns of ``docs``; texts without words all stay."""
    rows = written(assigned(docs, doc_id=doc_id, text=text, **options), "assigned")
    keepers = rows.groupBy("group").agg(F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("row"))
    marked = rows.join(keepers.select("row", F.lit(1).alias("stays")), "row", "left")
    # Rows are told apart by id and text; only rows that repeat both need a choice.
    gone = written(
        marked.groupBy("doc_id", "raw").agg(F.count("stays").alias("stay"), F.count("*").alias("all")).filter("stay < all"), "gone"
    ).select(F.col("doc_id").alias("gone_id"), F.col("raw").alias("gone_raw"), "stay")
    hint = F.broadcast if gone.count() <= BROADCAST_ROWS else (lambda df: df)

    def same(other: DataFrame):
        return F.col(f"`{doc_id}`").cast("long").eqNullSafe(other.gone_id) & (F.xxhash64(F.col(f"`{text}`")) == other.gone_raw)

    kept = docs.join(hint(gone), same(gone), "left_anti")
    repeated = gone.filter("stay > 0")
    if not repeated.isEmpty():
        # All rows that repeat an id and a text have one class, so at most one of them stays.
        one = docs.join(hint(repeated), same(repeated), "left_semi")
        kept = kept.union(one.dropDuplicates([doc_id, text]))
    return kept
