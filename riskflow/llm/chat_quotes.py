"""Quotation linking in conversations; DataFrame operations only.

A line's quote level is the number of > signs that it begins with (blanks between them allowed). A passage is a maximal run
of lines of one level; its units are the whole passage, its paragraphs (parted by blank lines) and its lines. Units are
normalised (lower case, runs of white space to one blank) and hashed. A unit of a passage of level 1 or more has its original
in the latest earlier turn of the conversation that holds the hash at level 0. The whole passage's original counts first,
otherwise those of its paragraphs, and after them its lines: the turn that most of them name, the latest of equals. A message
replies to an original that it quotes at its lowest level, passages before paragraphs and lines, the latest of these, or else
to the turn before it. Bodies keep level 0 alone.

Parents have smaller turns than their replies, so a conversation in the order of `position` is reply-ordered; `root` and
`depth` say where a message hangs: the turn that its chain of replies starts at, and the number of replies up to there.

No conversation and no common passage is gathered into one task: what the latest earlier turn is comes from sorted range
partitions, with the end of each carried into the next; chains are followed by doubling, in written rounds.

Nulls and odd input: null text is empty; rows with a null conv_id or turn are kept and link to nothing, without a position;
rows that repeat (conv_id, turn) are kept each, link to earlier turns, never to each other, and replies to them follow the
largest turn that one of them replies to; empty passages link to nothing; an empty table gives no row; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, maybe_broadcast

MARKS = r"^([ \t]*>)+"
#: Where a passage is cut into paragraphs and into lines.
CUTS = [r"\n\s*\n", r"\n"]


def normal(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


#: Signs that part runs and levels in a joined text, and how they are written where a text has them itself.
ESCAPES = [("\x01", "\x01a"), ("\x02", "\x01b"), ("\x03", "\x01c")]


def passages(messages: DataFrame) -> DataFrame:
    """messages with `parts`: array of (level, text) of their passages in order. Lines are joined with a sign before each run
    and cut again at the signs, so the work is linear in the text."""
    text = F.coalesce("text", F.lit(""))
    for sign, written in ESCAPES:
        text = F.replace(text, F.lit(sign), F.lit(written))
    lines = F.transform(F.split(text, "\n"), lambda s: F.struct(F.length(F.regexp_replace(F.regexp_extract(s, MARKS, 0), r"[^>]", "")).alias("level"), F.regexp_replace(s, MARKS + "[ \t]?", "").alias("text")))
    before = F.concat(F.array(F.lit(-1)), F.transform(lines, lambda x: x["level"]))
    signed = F.zip_with(lines, before, lambda x, level: F.when(x.isNull(), "").when(x["level"] == level, F.concat(F.lit("\n"), x["text"])).otherwise(F.concat(F.lit("\x02"), x["level"].cast("string"), F.lit("\x03"), x["text"])))

    def part(piece: Column) -> Column:
        own = F.substr(piece, F.instr(piece, "\x03") + 1)
        for sign, written in reversed(ESCAPES):
            own = F.replace(own, F.lit(written), F.lit(sign))
        return F.struct(F.substring_index(piece, "\x03", 1).cast("int").alias("level"), own.alias("text"))

    pieces = F.filter(F.split(F.array_join(signed, ""), "\x02"), lambda x: x != "")
    return messages.withColumn("parts", F.transform(pieces, part))


def units(text: str) -> Column:
    """Array of (kind, text): the passage, its paragraphs, its lines; those of one piece only once."""

    def cut(kind: int, at: str) -> Column:
        pieces = F.split(text, at)
        return F.when(F.size(pieces) > 1, F.transform(pieces, lambda s: F.struct(F.lit(kind).alias("kind"), s.alias("text")))).otherwise(F.array().cast("array<struct<kind:int,text:string>>"))

    whole = F.array(F.struct(F.lit(0).alias("kind"), F.col(text).alias("text")))
    return F.concat(whole, *[cut(k, at) for k, at in enumerate(CUTS, 1)])


def carried(rows: DataFrame, group: list[str], order: list[str], value: str, scratch: Scratch, name: str) -> DataFrame:
    """rows with `_last`, the last value (not NULL) of the rows before in the group, and `_before`, the number of rows before.

    Rows are sorted in range partitions; each partition takes over from the one before it what that knows of its last group,
    which is one row for each partition.
    """
    rows = scratch.keep(rows.repartitionByRange(*group, *order).withColumn("_p", F.spark_partition_id()), name)
    ends = rows.groupBy("_p", *group).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("v"), F.count(F.lit(1)).alias("n"))
    tail = ends.groupBy("_p").agg(F.max_by(F.struct(F.struct(*group).alias("g"), "v", "n"), F.struct(*group)).alias("e")).select("_p", "e.*")
    upto = Window.partitionBy("g").orderBy("_p")
    tail = tail.select("_p", F.struct("g", F.last("v", ignorenulls=True).over(upto).alias("v"), F.sum("n").over(upto).alias("n")).alias("_end"))
    tail = tail.select("_p", F.lag("_end").over(Window.orderBy("_p")).alias("_end"))
    inside = Window.partitionBy("_p", *group).orderBy(*order)
    same = F.col("_end.g") == F.struct(*group)
    last = F.coalesce(F.last(value, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.when(same, F.col("_end.v")))
    before = F.row_number().over(inside) - 1 + F.when(same, F.col("_end.n")).otherwise(0)
    return rows.join(F.broadcast(tail), "_p").withColumns({"_last": last, "_before": before}).drop("_p", "_end")


def threads(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, turn, root and depth of each turn (conv_id, turn, parent); parents are smaller turns of the conversation."""
    state = scratch.keep(turns.select("conv_id", "turn", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.col("parent").isNull().alias("done")), "chain-0")
    step = 0
    while state.filter("not done").limit(1).count():
        step += 1
        above = state.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("done").alias("_done"))
        moved = state.filter("not done").join(above.hint("merge"), ["conv_id", "up"], "left")
        moved = moved.select("conv_id", "turn", F.coalesce("_up", "up").alias("up"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), F.coalesce("_done", F.lit(True)).alias("done"))
        state = scratch.keep(state.filter("done").unionByName(moved), f"chain-{step}")
    return state.select("conv_id", "turn", F.coalesce("up", "turn").alias("root"), "depth")


def linked(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, body, reply_to, root, depth, position, quote_depth, n_quotes, n_linked, markup for each row of
    messages (conv_id, turn, role, text)."""
    scratch = Scratch(messages.sparkSession, "quotes")
    rows = messages.select("conv_id", "turn", "role", "text")
    # Lines of one level are joined natively where a quote is present; other texts are one passage as they are.
    own = F.when(F.rlike(F.coalesce("text", F.lit("")), F.lit(r"(?m)" + MARKS)), F.col("parts")).otherwise(F.array(F.struct(F.lit(0).alias("level"), F.coalesce("text", F.lit("")).alias("text"))))
    rows = passages(rows).withColumn("parts", own).drop("text")
    rows = rows.withColumn("mark", F.md5(F.to_json(F.struct("conv_id", "turn", "role", "parts"))))  # equal rows share a mark and have equal links
    parts = rows.filter("conv_id is not null and turn is not null").select("conv_id", "turn", "mark", F.explode("parts").alias("part")).select("conv_id", "turn", "mark", "part.level", "part.text")
    parts = parts.select("conv_id", "turn", "mark", "level", F.when(F.col("level") > 0, F.md5(normal("text"))).alias("passage"), F.explode(units("text")).alias("unit"))
    parts = parts.withColumn("text", normal("unit.text")).filter("text <> ''").select("conv_id", "turn", "mark", "level", "passage", "unit.kind", F.md5("text").alias("hash"))
    quotes = scratch.keep(parts.filter("level > 0").distinct(), "quotes")
    wanted = quotes.select("conv_id", "hash").distinct()
    originals = parts.filter("level = 0").select("conv_id", "hash", "turn").distinct()
    originals = originals.join(maybe_broadcast(wanted, quotes.count(), 64), ["conv_id", "hash"], "left_semi")
    # A turn's quotes come before its own text, so a message isn't its own original.
    both = quotes.withColumns({"_own": F.lit(0), "_turn": F.lit(None).cast("long")}).unionByName(originals.withColumns({"_own": F.lit(1), "_turn": F.col("turn").cast("long")}), allowMissingColumns=True)
    links = carried(both, ["conv_id", "hash"], ["turn", "_own"], "_turn", scratch, "units").filter("_own = 0 and _last is not null")
    links = links.groupBy("mark", "level", "passage", "kind", F.col("_last").alias("turn")).agg(F.count_distinct("hash").alias("n"))
    links = links.groupBy("mark", "level", "passage").agg(F.max_by(F.struct("kind", "turn"), F.struct(-F.col("kind"), "n", "turn")).alias("best")).select("mark", "level", "best.*")
    by_row = links.groupBy("mark").agg(F.count(F.lit(1)).alias("n_linked"), F.max_by("turn", F.struct(-F.col("level"), -F.col("kind"), F.col("turn"))).alias("quoted"))
    turns = rows.select("conv_id", "turn").filter("conv_id is not null and turn is not null").distinct().withColumn("_turn", F.col("turn").cast("long"))
    turns = carried(turns, ["conv_id"], ["turn"], "_turn", scratch, "turns").select("conv_id", "turn", F.col("_last").alias("before"), F.col("_before").cast("long").alias("position"))
    out = rows.join(by_row.hint("merge"), "mark", "left").join(turns.hint("merge"), ["conv_id", "turn"], "left").withColumn("reply_to", F.coalesce("quoted", "before"))
    out = scratch.keep(out, "replies")
    chain = threads(out.filter("position is not null").groupBy("conv_id", F.col("turn").cast("long").alias("turn")).agg(F.max("reply_to").alias("parent")), scratch)
    above = chain.select("conv_id", F.col("turn").alias("reply_to"), F.col("root").alias("_root"), F.col("depth").alias("_depth"))
    out = out.join(above.hint("merge"), ["conv_id", "reply_to"], "left")
    body = F.trim(F.array_join(F.transform(F.filter("parts", lambda p: p["level"] == 0), lambda p: p["text"]), "\n"))
    quoted = F.filter("parts", lambda p: p["level"] > 0)
    place = [F.when(F.col("position").isNotNull(), F.coalesce("_root", F.col("turn").cast("long"))).alias("root"), F.when(F.col("position").isNotNull(), F.coalesce(F.col("_depth") + 1, F.lit(0))).cast("long").alias("depth"), "position"]
    out = out.select("conv_id", "turn", "role", body.alias("body"), "reply_to", *place, F.coalesce(F.array_max(F.transform("parts", lambda p: p["level"])), F.lit(0)).alias("quote_depth"), F.size(quoted).cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"))
    return out.withColumn("markup", F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("body")))
