"""Chat formatting by quotation linking.

Lines of a message that begin with ``>`` are quotes, one level per mark. Normalised quoted
lines, and the passages that adjacent lines of a level make when joined, are hashed and joined to
the lines and passages of all earlier messages of the conversation; the message that holds most
of the quoted lines is the one replied to, the last of equals, and without quotes it is the
message before. Messages that hold the same quoted lines are one candidate, whose last turn
before the quote counts, so the work grows with the different ones.
A conversation is then the depth-first walk of its replies, the earliest first: role headers and
texts without the quotes, joined in pieces of bounded length. Turns that follow each other and
each answer the one before are one segment; only segments are ranked, by doubling the pointers
of a tour that enters and leaves each, so a plain conversation needs no round.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loghaven.lake import stored

MARKS = r"^(?:[ \t]*>)+"
#: Turns of a slice; a long conversation, or a line that fills one, is cut into slices.
SLICE = 4096
ENDING = "<|end|>"
#: Characters of a conversation at which a new piece begins, with the next whole message.
PIECE_CHARS = 1 << 20


def quote_level(line: Column) -> Column:
    """Marks that the line begins with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), r"[^>]+", ""))


def normalised(line: Column) -> Column:
    """The line without marks, case and space runs."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"[\s\p{Z}]+", " ")))


def without_quotes(text: Column) -> Column:
    """The text's own lines; blank lines at its ends are dropped."""
    own = F.filter(F.split(text, "\n"), lambda line: quote_level(line) == 0)
    return F.regexp_replace(F.array_join(own, "\n"), r"\A\s*\n|\s+\z", "")


def _joined(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``a`` with the other columns of ``b`` where the keys are equal or both null."""
    named = b.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return a.join(named, same, how).drop(*[f"__{k}" for k in keys])


def _before(rows: DataFrame, keys: list[str], turn: str, value: str, out: str) -> DataFrame:
    """Add the last non-null ``value`` at an earlier turn of the same keys, by slices of turns."""
    rows = rows.withColumn("__slice", F.floor(F.col(turn) / SLICE))
    within = Window.partitionBy(*keys, "__slice").orderBy(turn).rangeBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy(*keys, "__slice").agg(F.max(value).alias("__last"))
    over = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col("__slice").alias("__at"), F.max("__last").over(over).alias("__carried")
    )
    same = F.col("__slice").eqNullSafe(F.col("__at"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    found = F.coalesce(F.max(value).over(within), F.col("__carried"))
    return rows.join(carried, same, "left").withColumn(out, found).drop("__slice", "__last", "__at", "__carried", *[f"__{k}" for k in keys])


def _lines(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, line, passage: hashes of each line that is not blank and of the run
    of adjacent lines of its level, joined by spaces."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # These separate runs, a run's level and a run's lines.
    run, body, line = "\x01", "\x02", "\x03"
    cells = F.transform(
        F.split(text, "\n"),
        lambda x: F.struct(quote_level(x).alias("level"), normalised(F.translate(x, run + body + line, "   ")).alias("body")),
    )
    shifted = F.concat(F.array(F.struct(F.lit(-1).alias("level"), F.lit("").alias("body"))), cells)
    tagged = F.zip_with(
        cells,
        shifted,
        lambda x, last: F.when(F.coalesce(x["body"], F.lit("")) == "", F.lit(""))
        .when((last["body"] != "") & (last["level"] == x["level"]), F.concat(F.lit(line), x["body"]))
        .otherwise(F.concat(F.lit(run), x["level"].cast("string"), F.lit(body), x["body"])),
    )
    runs = messages.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.explode(F.split(F.array_join(tagged, ""), run)).alias("run")
    ).where("run <> ''")
    return runs.select(
        "conv_id",
        "turn",
        F.substring_index("run", body, 1).cast("int").alias("level"),
        F.xxhash64(F.translate(F.substring_index("run", body, -1), line, " ")).alias("passage"),
        F.explode(F.split(F.substring_index("run", body, -1), line)).alias("line"),
    ).withColumn("line", F.xxhash64("line"))


def _linked(messages: DataFrame) -> DataFrame:
    """conv_id, turn, quoted_turn, n_quoted, n_linked of the messages that quote."""
    lines = _lines(messages)
    marks = F.explode(F.array_distinct(F.array("line", "passage"))).alias("mark")
    asked = stored(lines.where("level > 0").select("conv_id", "turn", "line", "level", marks).distinct(), "quotes")
    # Only what some message of the conversation quotes is looked up.
    wanted = asked.select("conv_id", "mark").distinct()
    own = lines.where("level = 0 and turn is not null").select("conv_id", "turn", marks).distinct()
    held = stored(_joined(own, wanted, ["conv_id", "mark"], "left_semi"), "quoted")
    first = held.groupBy("conv_id", "mark").agg(F.min("turn").alias("first"))
    counts = (
        _joined(asked, first, ["conv_id", "mark"], "left")
        .groupBy("conv_id", "turn", "line")
        .agg(F.max(F.coalesce(F.col("first") < F.col("turn"), F.lit(False))).alias("found"))
        .groupBy("conv_id", "turn")
        .agg(F.count("*").alias("n_quoted"), F.count(F.when(F.col("found"), 1)).alias("n_linked"))
    )
    # Messages that hold the same are one holder, and messages that quote the same one asker.
    holders = stored(held.groupBy("conv_id", "turn").agg(F.xxhash64(F.array_sort(F.collect_set("mark"))).alias("holder")), "holders")
    quote = F.struct("line", "level", "mark")
    askers = stored(asked.groupBy("conv_id", "turn").agg(F.xxhash64(F.array_sort(F.collect_set(quote))).alias("asker")), "askers")
    holds = _joined(held, holders, ["conv_id", "turn"]).select("conv_id", "holder", "mark").distinct()
    asks = _joined(asked, askers, ["conv_id", "turn"]).select("conv_id", "asker", "line", "level", "mark").distinct()
    votes = (
        _joined(asks, holds, ["conv_id", "mark"])
        .groupBy("conv_id", "asker", "holder", "line")
        .agg(F.min("level").alias("level"))
        .groupBy("conv_id", "asker", "holder")
        .agg(F.count("*").alias("votes"), F.min("level").alias("level"))
    )
    candidates = _joined(askers, votes, ["conv_id", "asker"]).select("conv_id", "holder", "turn", "votes", "level")
    both = stored(candidates.unionByName(holders.withColumn("own", F.col("turn")), allowMissingColumns=True), "candidates")
    found = _before(both, ["conv_id", "holder"], "turn", "own", "source").where("votes is not null and source is not null")
    best = found.groupBy("conv_id", "turn").agg(F.max(F.struct(-F.col("level"), "votes", "source"))["source"].alias("quoted_turn"))
    return _joined(counts, best, ["conv_id", "turn"], "left")


def reply_links(messages: DataFrame) -> DataFrame:
    """conv_id, turn, last_turn, reply_to, n_quoted, n_linked: one row per conversation and turn."""
    turns = messages.select("conv_id", F.col("turn").cast("long").alias("turn")).distinct()
    ordered = _before(turns.withColumn("own", F.col("turn")), ["conv_id"], "turn", "own", "last_turn")
    return _joined(ordered, _linked(messages), ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "last_turn",
        F.coalesce("quoted_turn", "last_turn").alias("reply_to"),
        F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    )


def _running(rows: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over the rows before, by slices; ``order`` is distinct per keys, a null first."""
    rows = rows.withColumn("__slice", F.floor(F.col(order) / SLICE))
    slices = rows.groupBy(*keys, "__slice").agg(F.sum(value).alias("__sum"))
    over = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(*keys, "__slice", F.coalesce(F.sum("__sum").over(over), F.lit(0)).alias("__carried"))
    within = Window.partitionBy(*keys, "__slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = _joined(rows.withColumn("__within", F.coalesce(F.sum(value).over(within), F.lit(0))), carried, [*keys, "__slice"], "left")
    return rows.withColumn(out, F.col("__within") + F.col("__carried")).drop("__slice", "__within", "__carried")


def _ranked(segments: DataFrame) -> DataFrame:
    """conv_id, seg, after: messages from each segment to the end of the depth-first walk.

    Needs conv_id, seg, parent, attach (the turn answered), size. A segment is walked to its end,
    then what answers its last turn, and so on back to what answers its first.
    """
    siblings = Window.partitionBy("conv_id", "parent").orderBy(F.col("attach").desc(), "seg")
    tree = segments.withColumn("sibling", F.lead("seg").over(siblings)).withColumn("__n", F.row_number().over(siblings))
    children = tree.where("__n = 1 and parent is not null").select("conv_id", F.col("parent").alias("seg"), F.col("seg").alias("child"))
    tree = _joined(tree, children, ["conv_id", "seg"], "left")
    enter = tree.select(
        "conv_id", "seg", F.lit(0).alias("way"), F.col("size").alias("after"),
        F.coalesce("child", "seg").alias("to"), F.when(F.col("child").isNull(), 1).otherwise(0).alias("to_way"),
    )
    leave = tree.select(
        "conv_id", "seg", F.lit(1).alias("way"), F.lit(0).cast("long").alias("after"),
        F.coalesce("sibling", "parent").alias("to"),
        F.when(F.col("sibling").isNotNull(), 0).when(F.col("parent").isNotNull(), 1).alias("to_way"),
    )
    now = stored(enter.unionByName(leave), "walk")
    while now.where("to is not null").limit(1).count():
        far = now.select(
            "conv_id", F.col("seg").alias("to"), F.col("way").alias("to_way"),
            F.col("after").alias("more"), F.col("to").alias("next"), F.col("to_way").alias("next_way"),
        )
        gone = _joined(now.where("to is not null"), far, ["conv_id", "to", "to_way"]).select(
            "conv_id", "seg", "way", (F.col("after") + F.col("more")).alias("after"), F.col("next").alias("to"), F.col("next_way").alias("to_way")
        )
        now = stored(now.where("to is null").unionByName(gone), "walk")
    return now.where("way = 0").select("conv_id", "seg", "after")


def _shifts(turns: DataFrame) -> DataFrame:
    """conv_id, turn, shift: how far the depth-first walk moves a turn of a branched conversation.

    Needs conv_id, turn, last_turn, reply_to, n (rows of the turn), first (their first place by turn).
    """
    begins = F.col("reply_to").isNull() | (F.col("reply_to") != F.col("last_turn"))
    known = turns.where("turn is not null").withColumn("begin", F.when(begins, F.col("turn")))
    known = _before(known, ["conv_id"], "turn", "begin", "__seg").withColumn("seg", F.coalesce("begin", "__seg"))
    attach = F.max(F.when(F.col("begin").isNotNull(), F.col("reply_to")))
    segments = known.groupBy("conv_id", "seg").agg(F.sum("n").alias("size"), F.min("first").alias("first"), attach.alias("attach"))
    segments = stored(segments, "segments")
    branched = segments.where("attach is not null").select("conv_id").distinct()
    known = stored(_joined(known, branched, ["conv_id"], "left_semi").select("conv_id", "turn", "seg"), "branched")
    segments = _joined(segments, branched, ["conv_id"], "left_semi")
    parents = known.select("conv_id", F.col("turn").alias("attach"), F.col("seg").alias("parent"))
    segments = stored(_joined(segments, parents, ["conv_id", "attach"], "left"), "segments")
    whole = segments.groupBy("conv_id").agg(F.sum("size").alias("all"), F.min("first").alias("from"))
    ranked = _joined(_joined(segments, _ranked(segments), ["conv_id", "seg"]), whole, ["conv_id"])
    shift = (F.col("from") + F.col("all") - F.col("after") - F.col("first")).alias("shift")
    return _joined(known, ranked.select("conv_id", "seg", shift), ["conv_id", "seg"]).drop("seg")


def format_chats(messages: DataFrame) -> DataFrame:
    """Messages with reply_to, n_quoted, n_linked, body, position, formatted.

    Needs conv_id, turn, role, text; other columns stay, those of the new names are replaced.
    reply_to is a turn of the same conversation, null for its first; n_quoted and n_linked
    count the message's distinct quoted lines and those found before, alone or by their passage.
    body is the text without quotes, position the place by turn from 0 (equal turns come by role
    and text), reply_position the place in the depth-first walk of the replies, formatted the role
    header, body and end mark, piece the part of the conversation that it falls in. Null texts
    count as empty, a null role as ``user``; a null conv_id is a conversation of its own and a null
    turn comes first and links with nothing. Repeated rows stay, each at a place. An empty table
    gives no rows. A conversation is never gathered in one row or task.
    """
    new = ("reply_to", "n_quoted", "n_linked", "body", "position", "reply_position", "formatted", "piece")
    kept = [c for c in messages.columns if c not in new]
    counts = messages.groupBy("conv_id", F.col("turn").cast("long").alias("turn")).agg(F.count("*").alias("n"))
    turns = stored(_running(_joined(reply_links(messages), counts, ["conv_id", "turn"]), ["conv_id"], "turn", "n", "first"), "turns")
    turns = _joined(turns, _shifts(turns), ["conv_id", "turn"], "left")
    places = turns.select(
        "conv_id", F.col("turn").alias("__at"), "reply_to", "n_quoted", "n_linked",
        F.col("first").alias("__first"), F.coalesce("shift", F.lit(0)).alias("__shift"),
    )
    within = Window.partitionBy("conv_id", "__at").orderBy("role", F.xxhash64("text"))
    body = without_quotes(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = (
        _joined(messages.select(*kept).withColumn("__at", F.col("turn").cast("long")), places, ["conv_id", "__at"], "left")
        .withColumn("position", F.col("__first") + F.row_number().over(within) - 1)
        .withColumn("reply_position", F.col("position") + F.col("__shift"))
        .withColumn("body", body)
        .withColumn("formatted", F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), "body", F.lit("\n" + ENDING)))
        .withColumn("__chars", F.length("formatted").cast("long"))
    )
    rows = stored(rows.drop("__at", "__first", "__shift"), "chats")
    before = _running(rows.select("conv_id", "reply_position", "__chars"), ["conv_id"], "reply_position", "__chars", "__before")
    piece = before.select("conv_id", "reply_position", F.floor(F.col("__before") / PIECE_CHARS).alias("piece"))
    return _joined(rows, piece, ["conv_id", "reply_position"]).select(*kept, *new)


def chat_texts(chats: DataFrame) -> DataFrame:
    """conv_id, piece, n_messages, text: the conversations of ``format_chats`` in reply order, cut
    between messages; a piece has ``PIECE_CHARS`` and one message more at most."""
    rows = F.array_sort(F.collect_list(F.struct("reply_position", "formatted")))
    return chats.groupBy("conv_id", "piece").agg(
        F.count("*").alias("n_messages"), F.array_join(F.transform(rows, lambda r: r["formatted"]), "\n").alias("text")
    )
