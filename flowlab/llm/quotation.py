"""Quotation linking: messages that quote others, joined to the originals, and conversations in reply order.

Lines that open with ``>`` are quoted, each further mark is one level more; a line that announces a quotation
("... wrote:") right before it belongs to it. What remains is the message's own text. Consecutive lines of one level
are a passage. Passages are compared by a hash of their normalised text: lower case, white space as one blank. A quoted
passage is looked up whole and, where that finds nothing, line by line.

The original of a passage is the first message of the conversation whose own text has it, as a whole, as a paragraph or
as a line, and only if it came before. A message replies to the original of its shallowest level; of those, to the one
that most quoted characters come from, then to the latest. A message that quotes nothing known opens a thread. Reply
order is by thread (turn of its first message), depth in the thread and turn, so an answer never precedes its question.

Only the first message of each hash is kept for the join, so a line that everyone writes or quotes matches one row, and
joins on a hot conversation can be split. Depths come from doubling of the parent links. Positions are running numbers over
range partitions, so that no conversation is gathered.

Defined results: a null or empty text has no passages, its own text is empty; rows that repeat a conversation and turn
are messages of their own and link alike, of rows with equal texts neither is before the other; a null conversation or
turn links with nothing and comes first; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from flowlab.llm.tables import batch_of, written

MARKS = re.compile(r"[ \t]{0,3}((?:>[ \t]?)+)")
ANNOUNCES = re.compile(r"(?:wrote|writes|a écrit|escribió|schrieb\b.*)\s*:\s*$", re.I)


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def name_of(text: str) -> int | None:
    """A 64-bit hash of the normalised text; none for blank text."""
    text = normalised(text)
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63) if text else None


def levels(text: str) -> list[tuple[int, str]]:
    """Each line with its quote level and without its marks."""
    out = []
    for line in text.split("\n"):
        m = MARKS.match(line)
        out.append((m[1].count(">"), line[m.end():]) if m else (0, line))
    for i, (level, line) in enumerate(out[:-1]):
        if out[i + 1][0] == level + 1 and ANNOUNCES.search(line):
            out[i] = (level + 1, "")
    return out


def parsed(text: str | None) -> tuple[str, list[int], list[tuple[int, int, int, int]]]:
    """Own text, the hashes it can be quoted by, and the quoted parts: (level, passage, line, hash, characters), where
    passages count from 0 and lines from 1, and the whole passage has 0 as its line."""
    lines = levels(text or "")
    own = "\n".join(line for level, line in lines if level == 0).strip()
    names: dict[int, None] = {}
    passages: list[tuple[int, list[str]]] = []
    for level, line in lines:
        blank = not line.strip()
        if passages and passages[-1][0] == level and not (level == 0 and blank):
            passages[-1][1].append(line)
        elif not blank or level > 0:
            passages.append((level, [line]))
        else:
            passages.append((-1, []))  # a blank line parts paragraphs
    quotes = []
    for number, (level, part) in enumerate(passages):
        whole = name_of("\n".join(part))
        if whole is None:
            continue
        if level == 0:
            names.update(dict.fromkeys(n for n in (whole, *map(name_of, part)) if n is not None))
        else:
            quotes.append((level, number, 0, whole, len(normalised("\n".join(part)))))
            for k, line in enumerate(part, 1):
                if len(part) > 1 and (n := name_of(line)) is not None:
                    quotes.append((level, number, k, n, len(normalised(line))))
    if (n := name_of(own)) is not None:
        names[n] = None
    return own, list(names), quotes


def messages(table: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row a message, with a number of its own."""
    rows = table.select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.col(f"`{role}`").cast("string").alias("role"), F.col(f"`{text}`").cast("string").alias("body"),
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parsed(t) for t in batch.column(3).to_pylist()]
            if found:
                own, names, quotes = zip(*found)
                quotes = [[dict(zip(("level", "passage", "line", "name", "chars"), q)) for q in qs] for qs in quotes]
                yield batch_of(schema, *batch.columns[:3], own, names, quotes)

    quote = pa.struct([("level", pa.int32()), ("passage", pa.int64()), ("line", pa.int64()), ("name", pa.int64()), ("chars", pa.int64())])
    schema = pa.schema([
        ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("names", pa.list_(pa.int64())),
        ("quotes", pa.list_(quote)),
    ])
    kinds = (
        "conv_id long, turn long, role string, text string, names array<long>, "
        "quotes array<struct<level:int,passage:long,line:long,name:long,chars:long>>"
    )
    return written(rows.mapInArrow(parse, kinds).withColumn("message", F.monotonically_increasing_id()), "messages")


def reply_links(rows: DataFrame) -> DataFrame:
    """``message, parent, parent_turn``: the message each one replies to."""
    quoted = rows.filter(F.size("quotes") > 0).select("message", "conv_id", "turn", F.explode("quotes").alias("q")).select(
        "message", "conv_id", "turn", "q.*"
    )
    # The first message of each text in a conversation; the smaller number decides between rows of one turn.
    first = rows.filter("conv_id is not null and turn is not null").select(
        "conv_id", F.explode("names").alias("name"), F.struct("turn", "message").alias("at")
    ).groupBy("conv_id", "name").agg(F.min("at").alias("at"))
    found = quoted.join(first, ["conv_id", "name"]).filter(F.col("at.turn") < F.col("turn")).withColumn("whole", F.col("line") == 0)
    # Lines count where their passage as a whole is not known.
    known = found.groupBy("message", "passage").agg(F.max("whole").alias("known"))
    found = found.join(known, ["message", "passage"]).filter("whole or not known")
    votes = found.groupBy("message", "at").agg(F.min("level").alias("level"), F.sum("chars").alias("chars"))
    best = F.max_by("at", F.struct(-F.col("level"), "chars", "at.turn", -F.col("at.message")))
    return votes.groupBy("message").agg(best.alias("at")).select(
        "message", F.col("at.message").alias("parent"), F.col("at.turn").alias("parent_turn")
    )


def threads(links: DataFrame) -> DataFrame:
    """``message, root, depth`` of every message with a parent, in a number of joins that grows with the logarithm of
    the greatest depth."""
    at = written(links.select("message", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        above = at.select(F.col("message").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"))
        if at.join(above.select("up"), "up", "left_semi").isEmpty():
            return at.withColumnRenamed("up", "root")
        at = written(at.join(above, "up", "left").select(
            "message", F.coalesce("further", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
        ), "threads")


def numbered(rows: DataFrame, keys: list[str], start: list[str]) -> DataFrame:
    """``position`` of each row among those of equal ``start``, from 1, in the order of ``keys``, which open with it.

    Rows are sorted by ranges, so a group may span partitions. Counts of each partition and group, a few numbers for a
    partition, tell how many rows of the group came before.
    """
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = written(ordered.withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()), "ordered")
    # monotonically_increasing_id counts rows within a partition.
    counts = ordered.groupBy("part", *start).agg(F.count("*").alias("n"), F.min("place").alias("first"))
    named = {s: f"start_{i}" for i, s in enumerate(start)}
    before = Window.partitionBy(*start).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumnsRenamed({**named, "part": "in_part"})
    same = F.col("part") == F.col("in_part")
    for s, name in named.items():
        same = same & F.col(s).eqNullSafe(F.col(name))
    return ordered.join(counts, same).withColumn(
        "position", (F.col("place") - F.col("first") + F.col("earlier") + 1).cast("long")
    ).drop("part", "in_part", "place", "n", "first", "earlier", *named.values())


def linked_conversations(
    table: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Per message: ``conv_id, position, turn, role, text`` (its own), ``n_quotes`` (quoted passages), ``reply_to`` (turn),
    ``thread`` (turn of its first message) and ``depth``."""
    rows = messages(table, conv, turn, role, text)
    links = written(reply_links(rows), "reply-links")
    tree = threads(links).join(rows.select(F.col("message").alias("root"), F.col("turn").alias("thread")), "root").drop("root")
    found = rows.join(links.select("message", F.col("parent_turn").alias("reply_to")), "message", "left").join(tree, "message", "left")
    found = found.select(
        "conv_id", "turn", "role", "text", F.expr("cast(size(filter(quotes, q -> q.line = 0)) as bigint)").alias("n_quotes"),
        "reply_to", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "message",
    )
    return numbered(found, ["conv_id", "thread", "depth", "turn", "message"], ["conv_id"]).drop("message")
