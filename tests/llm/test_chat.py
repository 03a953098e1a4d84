import duckdb
import pandas as pd
import pytest

from quern.llm import chat, q_chat

TALK = [
    (1, 0, "user", "How do I sort a long list?\nI tried the plain way."),
    (1, 1, "assistant", "Use the sort function of the library.\n\nIt is stable."),
    (1, 2, "user", "On Monday Ann wrote:\n> How do I sort a long list?\nI mean in place."),
    (1, 3, "assistant", "> > How do I sort a long list?\n> I mean in place.\nThen call sort in place."),
    (1, 4, "user", ">> Use  the SORT function of the library.\n> nothing known stands here\nThanks!"),
    (2, 0, "user", "> It is stable.\nWhat does this mean? I read it elsewhere."),
    (2, 1, "assistant", "> yes\nIt keeps equal items in order."),
    (3, 0, "system", None),
    (3, 1, "user", ""),
    (3, 1, "user", ""),
    (3, 2, None, ">>> \n>"),
    (4, 0, "user", "word " * 50_000),
    (None, None, "user", "lost\n> It keeps equal items in order."),
    (5, 0, "user", "A first sentence stands here, and it is a rather long one. Then a second\nfollows it on the next line.\n\nx = 1"),
    (5, 1, "assistant", "yes"),
    (5, 2, "user", "El lunes Ann escribió:\n> A first sentence stands\n> here, and it is a\n>\trather long one. Then a\n> second follows it on\n> the next line.\nWrapped anew."),
    (5, 3, "assistant", "> Yes\nA short one."),
    (5, 4, "user", "> Then a second follows it\n> on the next line.\n\n> x = 1\nA part of it."),
    (6, 0, "user", "> yes\nTold in another conversation."),
    (7, None, "assistant", "Without any turns."),
    (7, None, "user", "> Without any turns.\nStill linked."),
    (7, None, "user", "> Without any turns.\nStill linked."),
]
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def got(spark):
    df = spark.createDataFrame([(*r, 1, "x") for r in TALK], SCHEMA + ", position int, Own string")
    return chat.threads(df).collect()


def test_links(got):
    reply = {(r.conv_id, r.turn): (r.reply_conv_id, r.reply_turn, r.quoted) for r in got}
    assert reply[1, 1] == (1, 0, False) and reply[1, 2] == (1, 0, True)
    assert reply[1, 3] == (1, 2, True), "the lower level wins"
    assert reply[1, 4] == (1, 1, True) and reply[2, 0] == (1, 1, True) and reply[2, 1] == (2, 0, False)
    assert reply[3, 0] == (None, None, False) and reply[-1, -1] == (2, 1, True)


def test_passages(got):
    reply = {(r.conv_id, r.text.partition("\n")[0]): (r.reply_conv_id, r.reply_turn, r.quoted) for r in got}
    assert reply[5, "Wrapped anew."] == (5, 0, True), "line breaks do not matter"
    assert reply[5, "A short one."] == (5, 1, True), "a whole short message"
    assert reply[5, "A part of it."] == (5, 0, True)
    assert reply[6, "Told in another conversation."] == (None, None, False), "short ones count only in their conversation"
    assert reply[7, "Still linked."] == (7, -1, True), "without turns, by the order"
    assert sum(r.quoted for r in got if r.conv_id == 7) == 2


def test_long_quote(spark):
    lines = [f"line {i} of many" for i in range(30_000)]
    rows = [(1, 0, "user", "\n".join(lines)), (1, 1, "user", "another"), (1, 2, "user", "\n".join("> " + x for x in lines))]
    got = chat.threads(spark.createDataFrame(rows, SCHEMA)).where("turn = 2").first()
    assert (got.reply_turn, got.quoted, got.text) == (0, True, "")


def test_texts_and_order(got):
    text = {(r.conv_id, r.turn): r.text for r in got}
    assert text[1, 2] == "I mean in place." and text[1, 4] == "Thanks!" and text[3, 2] == "" and text[1, 1].endswith("\n\nIt is stable.")
    assert len(got) == len(TALK) and all(r.formatted == f"<|{r.role}|>\n{r.text}" for r in got)
    for c in {r.conv_id for r in got}:
        own = sorted((r for r in got if r.conv_id == c), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(1, len(own) + 1)) and [r.turn for r in own] == sorted(r.turn for r in own)


def test_sql_agrees(got):
    conversations = pd.DataFrame(TALK, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    want = duckdb.sql(q_chat.ORACLE_SQL["op9_chat"]).df().astype(object)
    clean = lambda row: tuple(None if x is None or x is pd.NA or x != x else x for x in row)
    names = list(got[0].asDict())
    assert sorted(map(repr, map(clean, want[names].values.tolist()))) == sorted(map(repr, [tuple(r) for r in got]))


def depth_first(rows):
    """Reply order of (position, parent) rows of one conversation, by walking the tree."""
    below = {}
    for position, parent in sorted(rows):
        below.setdefault(parent, []).append(position)
    out, stack = {}, below.get(0, [])[::-1]
    while stack:
        at = stack.pop()
        out[at] = len(out) + 1
        stack.extend(below.get(at, [])[::-1])
    return out


def test_reply_order_is_depth_first(got):
    order = {(r.conv_id, r.turn): r.reply_position for r in got}
    assert [order[1, t] for t in range(5)] == [1, 2, 4, 5, 3], "turn 4 quotes turn 1, turn 2 quotes turn 0"
    for c in {r.conv_id for r in got}:
        own = [r for r in got if r.conv_id == c]
        assert sorted(r.reply_position for r in own) == list(range(1, len(own) + 1))


@pytest.mark.parametrize("parts", [1, 7])
def test_reply_order_of_any_tree(spark, parts):
    """Random trees, a chain of quotes, a place that hundreds quote, a hot conversation, quotes of other conversations."""
    import random

    rng = random.Random(parts)
    quote = {}
    for c in range(12):
        for p in range(2, rng.randint(2, 40)):
            quote[c, p] = rng.choice([None, (c, rng.randint(1, p - 1)), (c, rng.randint(1, p - 1)), (c + 1, 1)])
        quote[c, 1] = None
    quote |= {(20, p): (20, 3) if p > 3 else None for p in range(1, 400)}
    quote |= {(21, p): (21, max(1, p - 2)) if p > 1 else None for p in range(1, 300)}
    quote |= {(22, p): None for p in range(1, 50)}
    want = {}
    for c in {c for c, _ in quote}:
        rows = [(p, q[1] if q and q[0] == c else 0 if q else p - 1) for (k, p), q in quote.items() if k == c]
        want |= {(c, p): n for p, n in depth_first(rows).items()}
    df = spark.createDataFrame([(c, p, *(q or (None, None))) for (c, p), q in quote.items()], "conv long, position long, to_conv long, to_place long")
    found = {(r.conv, r.position): r.reply_position for r in chat.reply_positions(df.repartition(parts)).collect()}
    assert {k: found.get(k, k[1]) for k in quote} == want and not any(c == 22 for c, _ in found)


def test_empty(spark):
    assert chat.threads(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_large_conversation(spark):
    df = spark.range(20_000).selectExpr("1 as conv_id", "id as turn", "'user' as role", "concat('message number ', id) as text")
    got = chat.threads(df).selectExpr("count(*)", "sum(cast(position - 1 = turn as int))", "sum(cast(reply_turn = turn - 1 as int))").first()
    assert tuple(got) == (20_000, 20_000, 19_999)
