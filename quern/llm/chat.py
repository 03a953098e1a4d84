"""Chat formatting with quotation linking (operator 9).

Lines of a message that begin with ``>`` are quotes, of a level that is the number of such marks. A passage is a
run of lines of one level without a blank one between them, its white space and line breaks made single
spaces, so that a quote which was wrapped anew is the passage it was. Quoted passages are hashed, and so are their sentences
and lines, for quotes of a part; the hashes are joined to the message that first wrote the same passage, sentence or
line. A message replies to the message that it quotes at its lowest level, or else to the one before it. The quotes are cut
from the text, and the messages numbered twice: by turn, and in reply order, in which the answers to a message, and
the answers to those, stand below it before anything else does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import discard, quoted, stored

#: How the line that announces a quote begins and ends in some languages.
ANNOUNCES = r"(?i)^(on|am|el|le)\b.*(wrote|schrieb|escribió|a écrit)\s*:$"
MARKS = r"^([ \t]*>)+"
#: Parts into which the quotes of one passage are dealt for the join.
SALTS = 8
#: Hashes and links up to this number are broadcast; more are joined by shuffle.
BROADCAST_KEYS = 1_000_000


def level(line: Column) -> Column:
    """The number of quote marks that a line begins with."""
    return F.length(F.translate(F.regexp_extract(line, MARKS, 0), " \t", ""))


def normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"[ \t\r]+", " ")))


def own_lines(text: Column) -> Column:
    """array<struct(line, level, own)> of a message; own: neither quoted nor announcing a quote."""
    lines = F.split(text, "\n", -1)
    levels = F.transform(lines, level)
    following = F.concat(F.slice(levels, F.lit(2), F.size(levels)), F.array(F.lit(0)))
    parts = F.arrays_zip(lines.alias("line"), levels.alias("level"), following.alias("next"))

    def marked(x: Column) -> Column:
        announces = F.trim(x["line"]).rlike(ANNOUNCES) & (x["next"] > 0)
        return F.struct(x["line"].alias("line"), x["level"].alias("level"), ((x["level"] == 0) & ~announces).alias("own"))

    return F.transform(parts, marked)


def passages(marked: Column) -> Column:
    """array<string> from ``own_lines``: ``level:words`` of each passage, ``\\r`` between its lines; announcing lines give none.

    Each line is put down with a mark of whether it goes on with the line before, and the whole is cut at those
    that do not: one pass, however long the message.
    """
    tags = F.transform(marked, lambda x: F.when(x["own"] | (x["level"] > 0), x["level"]).otherwise(-1))
    words = F.transform(marked, lambda x: normalised(x["line"]))
    shifted = lambda array, first: F.concat(F.array(first), F.slice(array, F.lit(1), F.size(array) - 1))
    rows = F.arrays_zip(tags.alias("tag"), words.alias("words"), shifted(tags, F.lit(-2)).alias("last"), shifted(words, F.lit("")).alias("before"))
    goes_on = lambda x: (x["tag"] == x["last"]) & (x["words"] != "") & (x["before"] != "")
    cut = F.transform(rows, lambda x: F.concat(F.when(goes_on(x), F.lit("\r")).otherwise(F.concat(F.lit("\n"), x["tag"].cast("string"), F.lit(":"))), x["words"]))
    return F.filter(F.split(F.array_join(cut, ""), "\n", -1), lambda p: p.rlike(r"(?s)^\d+:."))


def pieces(messages: DataFrame, shortest: int) -> DataFrame:
    """(conv, position, turn, level, size, hash): whole passages, and their sentences and lines of ``shortest`` characters and more."""
    found = messages.select("conv", "position", "turn", F.explode(passages(own_lines(F.col("text")))).alias("p"))
    told = found.select("conv", "position", "turn", F.substring_index("p", ":", 1).cast("int").alias("level"), F.regexp_replace("p", r"^\d+:", "").alias("p"))
    whole = F.translate(F.col("p"), "\r", " ")
    parts = F.concat(F.split("p", "\r"), F.split(F.regexp_replace(whole, r"([.!?]) ", "$1\n"), "\n"))
    every = F.concat(F.array(whole), F.filter(parts, lambda x: F.length(x) >= shortest))
    each = told.select("conv", "position", "turn", "level", F.explode(every).alias("words"))
    return each.select("conv", "position", "turn", "level", F.length("words").alias("size"), F.md5("words").alias("hash"))


def numbered(messages: DataFrame) -> DataFrame:
    """(conv, turn, role, text, times, position, before) of messages (conv, turn, role, text).

    Equal rows are one that stands several ``times``. ``position``: its first place in its conversation, from 1,
    by turn, role and digest of the text; ``before``: the turn of the message before. Rows are dealt by ranges
    and counted range by range, so that a conversation of any size is spread over tasks; only the
    counts of each conversation in each range meet.
    """
    order = ["turn", "role", "digest"]
    same = messages.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times")).withColumn("digest", F.sha2("text", 256))
    dealt = stored(same.repartitionByRange("conv", *order).withColumn("range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("conv", "range").orderBy(*order)
    earlier = Window.partitionBy("conv").orderBy("range")
    counts = dealt.groupBy("conv", "range").agg(F.sum("times").alias("n"), F.max("turn").alias("last"))
    offset = F.coalesce(F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("conv", "range", offset.alias("offset"), F.lag("last").over(earlier).alias("last"))
    upto = F.sum("times").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("times")
    joined = dealt.withColumn("upto", upto).withColumn("lag", F.lag("turn").over(inside)).join(offsets, ["conv", "range"])
    done = joined.select("conv", "turn", "role", "text", "times", (F.col("upto") + F.col("offset") + 1).alias("position"), F.coalesce("lag", "last").alias("before"))
    ordered = stored(done, "ordered")
    discard(dealt)
    return ordered


def bounded(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it has no more than ``BROADCAST_KEYS`` rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS else df


def originals(ordered: DataFrame, shortest: int) -> DataFrame:
    """(conv, position, to_conv, to_turn, to_place): the message that each quoting message quotes.

    A piece's origin is the first message of the same conversation, else of all, that wrote it itself; it must
    stand before the quoting message or in another conversation, where a piece shorter than ``shortest``
    proves nothing. At the lowest level with an origin, the message that wrote most characters of all pieces is quoted; ties
    go to the same conversation, then to the later place. Only what is quoted is looked for among the
    originals, and origins are aggregated before the join, so passages that many share cause no more rows.
    """
    quotes = pieces(ordered.where(F.col("text").rlike(r"(?m)" + MARKS)), shortest).where("level > 0")
    quotes = stored(quotes.groupBy("conv", "position", "hash").agg(F.min("level").alias("level"), F.max("size").alias("size")), "quotes")
    own = pieces(ordered, shortest).where("level = 0").join(bounded(quotes.select("hash").distinct()), "hash", "left_semi")
    salts = F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt")
    first = own.groupBy("conv", "hash").agg(F.min(F.struct("position", "turn")).alias("here"))
    first = stored(first, "first")
    here = first.select("conv", "hash", "here", salts)
    anywhere = first.groupBy("hash").agg(F.min(F.struct("conv", "here")).alias("first")).select("hash", "first", salts)
    dealt = quotes.withColumn("salt", F.pmod(F.xxhash64("conv", "position"), F.lit(SALTS)).cast("int"))
    traced = dealt.join(here, ["conv", "hash", "salt"], "left").join(anywhere, ["hash", "salt"], "left")
    to = lambda conv, place: F.struct(conv.alias("conv"), place["turn"].alias("turn"), place["position"].alias("place"))
    inside = F.col("here.position") < F.col("position")
    elsewhere = (F.col("first.conv") != F.col("conv")) & (F.col("size") >= shortest)
    linked = traced.withColumn("to", F.when(inside, to(F.col("conv"), F.col("here"))).when(elsewhere, to(F.col("first.conv"), F.col("first.here")))).where("to is not null")
    sums = linked.groupBy("conv", "position", "level", "to").agg(F.sum("size").alias("size"))
    same = F.col("to.conv") == F.col("conv")
    best = F.max(F.struct((-F.col("level")).alias("low"), "size", same.alias("same"), F.col("to.turn").alias("turn"), F.col("to.place").alias("place"), (-F.col("to.conv")).alias("minus")))
    found = stored(sums.groupBy("conv", "position").agg(best.alias("b")).select("conv", "position", (-F.col("b.minus")).alias("to_conv"), F.col("b.turn").alias("to_turn"), F.col("b.place").alias("to_place")), "origins")
    discard(quotes, first)
    return found


def runs(messages: DataFrame, heads: DataFrame) -> DataFrame:
    """(conv, kind, who, run): the last head at or before each message (kind 0) and before the place that each head replies to (kind 1).

    Counted range by range like ``numbered``, so neither a long conversation nor a place that many reply to is one task.
    """
    rows = messages.select("conv", F.col("position").alias("at"), F.lit(0).alias("kind"), F.col("position").alias("who"))
    own = rows.join(heads.select("conv", F.col("head").alias("at"), F.col("head")), ["conv", "at"], "left")
    asked = heads.where("parent > 0").select("conv", F.col("parent").alias("at"), F.lit(1).alias("kind"), F.col("head").alias("who"), F.lit(None).cast("long").alias("head"))
    order = ["at", "kind", "who"]
    dealt = stored(own.unionByName(asked).repartitionByRange("conv", *order).withColumn("range", F.spark_partition_id()), "places")
    inside = Window.partitionBy("conv", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = dealt.groupBy("conv", "range").agg(F.max("head").alias("head")).select("conv", "range", F.max("head").over(earlier).alias("carried"))
    run = F.coalesce(F.last("head", ignorenulls=True).over(inside), F.col("carried"))
    told = stored(dealt.join(carried, ["conv", "range"]).select("conv", "kind", "who", run.alias("run")), "runs")
    discard(dealt)
    return told


def tour(nodes: DataFrame) -> DataFrame:
    """(conv, e, rest, next) of nodes (conv, head, up, low, n): the walk around the trees of heads, as a list.

    A node is walked into (e = 2 head, costing its n messages) and out of (2 head + 1, costing none): in, then its children by
    ``low`` and head, then out. Next siblings are told range by range, however many a node has.
    """
    order = ["low", "head"]
    dealt = stored(nodes.repartitionByRange("conv", "up", *order).withColumn("range", F.spark_partition_id()), "siblings")
    inside = Window.partitionBy("conv", "up", "range").orderBy(*order)
    edges = dealt.groupBy("conv", "up", "range").agg(F.min(F.struct("low", "head"))["head"].alias("edge"))
    later = edges.select("conv", "up", "range", F.lead("edge").over(Window.partitionBy("conv", "up").orderBy("range")).alias("later"))
    beside = dealt.withColumn("beside", F.lead("head").over(inside)).join(later, ["conv", "up", "range"]).withColumn("beside", F.coalesce("beside", "later"))
    first = dealt.groupBy("conv", F.col("up").alias("head")).agg(F.min(F.struct("low", "head"))["head"].alias("child"))
    whole = beside.join(first, ["conv", "head"], "left")
    out = F.when(F.col("beside").isNotNull(), F.col("beside") * 2).when(F.col("up") > 0, F.col("up") * 2 + 1)
    enter = F.struct((F.col("head") * 2).alias("e"), F.col("n").alias("rest"), F.coalesce(F.col("child") * 2, F.col("head") * 2 + 1).alias("next"))
    leave = F.struct((F.col("head") * 2 + 1).alias("e"), F.lit(0).cast("long").alias("rest"), out.alias("next"))
    steps = stored(whole.select("conv", F.explode(F.array(enter, leave)).alias("s")).select("conv", "s.*"), "tour")
    discard(dealt)
    return steps


def ranked(steps: DataFrame) -> DataFrame:
    """(conv, e, rest) of a list (conv, e, rest, next): ``rest`` summed from e to the list's end, by doubling the steps.

    Each round halves the number of steps left; places have one predecessor, so its join has no frequent key.
    """
    while True:
        going = steps.where("next is not null")
        if going.isEmpty():
            return steps.select("conv", "e", "rest")
        ahead = steps.select("conv", F.col("e").alias("next"), F.col("rest").alias("more"), F.col("next").alias("after"))
        gone = going.join(ahead, ["conv", "next"]).select("conv", "e", (F.col("rest") + F.col("more")).alias("rest"), F.col("after").alias("next"))
        before, steps = steps, stored(steps.where("next is null").unionByName(gone), "tour")
        discard(before)


def reply_positions(messages: DataFrame) -> DataFrame | None:
    """(conv, position, reply_position) of messages (conv, position, to_conv, to_place), for the conversations whose
    reply order is not that of their positions; None if there are none.

    A message's parent is what it quotes in its own conversation, or else the message before; the first one and
    those that quote another conversation have none. The order is depth first, children by position. A message that has no
    quote, or quotes the one before, comes right after that one; so such runs stay whole, and the trees need one node a
    run: the runs that quote a run stand below it, those that quote its later messages first.
    """
    same = F.col("to_conv") == F.col("conv")
    turns = messages.where(F.col("to_conv").isNotNull() & (F.col("position") > 1) & ~(same & (F.col("to_place") == F.col("position") - 1)))
    turns = stored(turns.select("conv", F.col("position").alias("head"), F.when(same, F.col("to_place")).otherwise(0).alias("parent")), "heads")
    live = turns.where("parent > 0").select("conv").distinct()
    if live.isEmpty():
        discard(turns)
        return None
    live = bounded(live)
    heads = turns.join(live, "conv", "left_semi").unionByName(live.select("conv", F.lit(1).cast("long").alias("head"), F.lit(0).cast("long").alias("parent")))
    told = runs(messages.select("conv", "position").join(live, "conv", "left_semi"), heads)
    sizes = told.where("kind = 0").groupBy("conv", F.col("run").alias("head")).agg(F.count(F.lit(1)).alias("n"))
    ups = told.where("kind = 1").select("conv", F.col("who").alias("head"), F.col("run").alias("up"))
    nodes = heads.join(ups, ["conv", "head"], "left").join(sizes, ["conv", "head"])
    ranks = ranked(tour(nodes.select("conv", "head", F.coalesce("up", F.lit(0)).alias("up"), (-F.col("parent")).alias("low"), "n")))
    entered = ranks.where("e % 2 = 0").select("conv", (F.col("e") / 2).cast("long").alias("run"), "rest")
    starts = entered.join(ranks.groupBy("conv").agg(F.max("rest").alias("all")), "conv").select("conv", "run", (F.col("all") - F.col("rest") + 1).alias("start"))
    salts = F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt")
    dealt = told.where("kind = 0").withColumn("salt", F.pmod(F.xxhash64("who"), F.lit(SALTS)).cast("int"))
    placed = dealt.join(starts.select("*", salts), ["conv", "run", "salt"])
    found = stored(placed.select("conv", F.col("who").alias("position"), (F.col("start") + F.col("who") - F.col("run")).alias("reply_position")), "reply-order")
    discard(turns, told, ranks)
    return found


def threads(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", shortest: int = 8) -> DataFrame:
    """One row for each message: conv_id, turn, role, position, reply_position, reply_conv_id, reply_turn, quoted, text, formatted.

    ``position`` numbers a conversation's messages by turn, ``reply_position`` in reply order (see ``reply_positions``).

    ``text`` is the message without quotes and the lines that announce them, white space trimmed off its
    ends; ``formatted`` puts the role before it. ``quoted`` tells whether the reply goes by a quote;
    otherwise it goes to the message before in the conversation (null for the first). Sentences and lines of fewer
    than ``shortest`` normalised characters prove no quote; a whole passage of any length does inside its conversation.
    A null text counts as empty, a null role as "user". Messages with equal turns are ordered by role, then by a digest of the
    text, and quote by that order; repeated rows are kept, and all reply alike to quotes. Rows with a null
    conversation or turn are ordered as if these were -1. Whole texts are read, however long. Other columns are not
    returned, whatever their names; an empty table gives an empty one.
    """
    get = lambda c: F.col(quoted(c))
    base = df.select(
        F.coalesce(get(conv).cast("long"), F.lit(-1)).alias("conv"),
        F.coalesce(get(turn).cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(get(role), F.lit("user")).alias("role"),
        F.coalesce(get(text), F.lit("")).alias("text"),
    )
    ordered = numbered(base)
    whole = ordered.join(bounded(originals(ordered, shortest)), ["conv", "position"], "left")
    kept = F.array_join(F.transform(F.filter(own_lines(F.col("text")), lambda x: x["own"]), lambda x: x["line"]), "\n")
    body = F.regexp_replace(F.regexp_replace(kept, r"^\s+", ""), r"\s+$", "")
    each = lambda df: df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("times").cast("int") - 1))).withColumn("position", F.col("position") + F.col("copy"))
    copies = each(whole.withColumn("body", body).drop("text"))
    moved = reply_positions(each(whole.select("conv", "position", "times", "to_conv", "to_place")))
    if moved is None:
        copies = copies.withColumn("reply_position", F.col("position"))
    else:
        copies = copies.join(bounded(moved), ["conv", "position"], "left").withColumn("reply_position", F.coalesce("reply_position", "position"))
    quoting = F.col("to_turn").isNotNull()
    before = F.when(F.col("copy") > 0, F.col("turn")).otherwise(F.col("before"))
    return copies.select(
        F.col("conv").alias(conv),
        F.col("turn").alias(turn),
        F.col("role").alias(role),
        "position",
        "reply_position",
        F.when(quoting, F.col("to_conv")).when(before.isNotNull(), F.col("conv")).alias("reply_conv_id"),
        F.when(quoting, F.col("to_turn")).otherwise(before).alias("reply_turn"),
        quoting.alias("quoted"),
        F.col("body").alias(text),
        F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("body")).alias("formatted"),
    )
