import random

from hypothesis import given, settings, strategies as st

from flowlab.llm.queries import ORACLES, QUERIES
from flowlab.llm.quotation import levels, linked_conversations, numbered, parsed
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.01"


def test_query(spark):
    assert differences(QUERIES["op1_quotation_linking"](spark, SF_DIR), ORACLES["op1_quotation_linking"], connect(SF_DIR)) is None


def test_levels():
    text = "Hi\nAnn wrote:\n> one\n>> two\n > > three\n\nown > not quoted"
    assert levels(text) == [(0, "Hi"), (1, ""), (1, "one"), (2, "two"), (2, "three"), (0, ""), (0, "own > not quoted")]
    assert parsed(text)[0] == "Hi\n\nown > not quoted"
    assert parsed(None) == ("", [], []) == parsed("")


CHAT = [
    (1, 0, "a", "How do I sort a table?\nIt is large."), (1, 1, "b", "> how do  I sort\n> a table?\nUse order by."),
    (1, 2, "c", "> How do I sort a table?\n> It is large.\nBy ranges."), (1, 3, "a", "b wrote:\n>> It is large.\n> Use order by.\nThanks."),
    (1, 4, "d", "Something else."), (1, 5, "b", "> By ranges.\n> Use order by.\nBoth."), (1, 6, "e", "> never said\nWhat?"),
    (2, 0, "a", "> It is large.\nOther conversation."), (2, 1, "b", "> Later text\nx"), (2, 2, "c", "Later text"),
    (None, 3, "z", "> Later text"), (3, None, "z", "Later text"), (4, 1, None, None), (4, 2, "q", ""), (4, 2, "q", ""),
]


def test_links_and_order(spark):
    table = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as message", "2 as depth")
    got = {(r.conv_id, r.turn): (r.reply_to, r.thread, r.depth, r.position, r.n_quotes) for r in linked_conversations(table).collect()}
    # Turn 1 quotes a line broken in two: its whole passage matches that line after normalising.
    assert got[1, 2] == (0, 0, 1, 3, 1)
    assert got[1, 3][:3] == (1, 0, 2)
    assert got[1, 5][:3] == (1, 0, 2)  # neither line makes a known passage; the longer of the lines decides
    assert got[1, 6][:3] == (None, 6, 0)
    assert got[2, 0][:3] == (None, 0, 0) and got[2, 1][:3] == (None, 1, 0)
    assert got[None, 3][:3] == (None, 3, 0)
    ordered = sorted((p, t) for (c, t), (_, _, _, p, _) in got.items() if c == 1)
    assert [t for _, t in ordered] == [0, 1, 2, 3, 5, 4, 6]
    assert sorted(r.position for r in linked_conversations(table).collect() if r.conv_id == 4) == [1, 2, 3]
    assert linked_conversations(table.limit(0)).count() == 0


def brute(rows):
    """Parents by looking through all earlier messages of the conversation."""
    out = {}
    for c, t, _, text in rows:
        _, _, quotes = parsed(text)
        votes, numbers = {}, {}
        for level, passage, line, name, chars in quotes:
            first = min((u for d, u, _, other in rows if d == c and name in parsed(other)[1]), default=None)
            if first is not None and first < t:
                numbers.setdefault(passage, []).append((line == 0, level, chars, first))
        for found in numbers.values():
            whole = any(w for w, *_ in found)
            for w, level, chars, first in found:
                if w or not whole:
                    low, total = votes.get(first, (99, 0))
                    votes[first] = (min(low, level), total + chars)
        out[c, t] = max(votes, key=lambda u: (-votes[u][0], votes[u][1], u)) if votes else None
    return out


def test_random_threads_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for c in range(12):
        own = []
        for t in range(rng.randrange(3, 25)):
            text = "\n".join(rng.choice(["same line", f"line {rng.randrange(40)}"]) for _ in range(rng.randrange(1, 4)))
            quoted = "".join(f"{'>' * rng.randrange(1, 3)} {line}\n" for line in rng.choice(own).split("\n")) if own and rng.random() < 0.8 else ""
            own.append(text)
            rows.append((c, t, "u", quoted + text))
    got = linked_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    parents = brute(rows)
    assert {(r.conv_id, r.turn): r.reply_to for r in got} == parents
    for r in got:
        root, depth = r.turn, 0
        while parents[r.conv_id, root] is not None:
            root, depth = parents[r.conv_id, root], depth + 1
        assert (r.thread, r.depth) == (root, depth)
        if r.reply_to is not None:
            assert next(p.position for p in got if (p.conv_id, p.turn) == (r.conv_id, r.reply_to)) < r.position


def test_a_passage_of_a_million_lines_is_one(spark):
    _, _, quotes = parsed("> some quoted line\n" * 1_000_002 + "own")
    assert [q[:3] for q in quotes if q[2] == 0] == [(1, 0, 0)] and quotes[-1][1:3] == (0, 1_000_002)


def test_long_chain_and_one_conversation(spark):
    rows = [(1, t, "u", (f"> message {t - 1}\n" if t else "") + f"message {t}") for t in range(200)]
    got = linked_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r.position, r.depth, r.thread) for r in got) == [(t + 1, t, 0) for t in range(200)]


def test_numbers_run_over_partitions(spark):
    rows = spark.range(1000).selectExpr("id % 3 as g", "id as x")
    got = numbered(rows, ["g", "x"], ["g"]).collect()
    assert all(r.position == r.x // 3 + 1 for r in got)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("> ab\n\t"), max_size=40))
def test_any_text(text):
    own, names, quotes = parsed(text)
    assert len(set(names)) == len(names)
    assert all(level > 0 for level, *_ in quotes)
