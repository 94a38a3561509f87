"""Chat formatting with quotation linking.

Every line of a message has a quote level (its leading ``>`` marks). Runs of
lines of one level are passages. Own passages are hashed after normalisation,
quoted ones likewise, each as a whole, by paragraph, by two lines and by line; a
quoted one votes for the latest earlier message of its conversation that has it
among its own. Whole passages outvote parts of them. The
message with most votes is the parent. Conversations come out in reply order,
without the quotes. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, saved

MARKS = r"^[ \t]*(?:>[ \t]*)+"


def normalised(line: Column) -> Column:
    """White space runs as one blank, none at the ends, A-Z lower-cased."""
    return ascii_lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


#: Kinds of units; a quote of a longer unit outvotes those of shorter ones.
LINE, TWO_LINES, PARAGRAPH, PASSAGE = range(4)


def units_of(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, kind, h1, h2, n): the passages of every message and their parts; equal rows once.

    ``level`` is the number of quote marks, 0 for own lines. A passage is a run
    of lines of one level, a paragraph one without blank lines; white space is
    joined across the ``n`` lines of a unit, so the width of lines does not matter.
    """
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    level = F.transform(lines, lambda l: F.length(F.regexp_replace(F.regexp_extract(l, MARKS, 0), "[^>]", "")))
    norm = F.transform(lines, lambda l: normalised(F.regexp_replace(l, MARKS, "")))

    def changes(i: Column) -> Column:
        return (i == 0) | (F.get("levels", i) != F.get("levels", i - 1))

    def blank_border(i: Column) -> Column:
        return (F.get("norms", i) == "") | (F.get("norms", i - 1) == "")

    def cut(starts: str) -> Column:
        """(level, lines that are not blank) of each part that begins at ``starts``."""
        end = lambda k: F.coalesce(F.get(starts, k + 1), F.size("norms"))
        return F.transform(
            starts,
            lambda s, k: F.struct(F.get("levels", s).alias("level"), F.filter(F.slice("norms", s + 1, end(k) - s), lambda x: x != "").alias("lines")),
        )

    def unit(level: Column, kind: int, text: Column, n: Column) -> Column:
        return F.struct(level.alias("level"), F.lit(kind).alias("kind"), text.alias("text"), n.cast("int").alias("n"))

    def whole(parts: str, kind: int) -> Column:
        return F.transform(parts, lambda r: unit(r["level"], kind, F.array_join(r["lines"], " "), F.size(r["lines"])))

    def twos(r: Column) -> Column:
        first = F.slice(r["lines"], 1, F.greatest(F.size(r["lines"]) - 1, F.lit(0)))
        return F.transform(first, lambda x, i: unit(r["level"], TWO_LINES, F.concat(x, F.lit(" "), F.get(r["lines"], i + 1)), F.lit(2)))

    def singles(r: Column) -> Column:
        return F.transform(r["lines"], lambda x: unit(r["level"], LINE, x, F.lit(1)))

    at = F.sequence(F.lit(0), F.size("norms") - 1)
    return (
        messages.select("conv_id", "turn", F.xxhash64("text").alias("digest"), level.alias("levels"), norm.alias("norms"))
        .dropDuplicates(["conv_id", "turn", "digest"])
        .withColumn("run_starts", F.filter(at, changes))
        .withColumn("paragraph_starts", F.filter(at, lambda i: changes(i) | blank_border(i)))
        .withColumn("runs", cut("run_starts"))
        .withColumn("paragraphs", cut("paragraph_starts"))
        .select(
            "conv_id",
            "turn",
            F.explode(
                F.concat(
                    whole("runs", PASSAGE),
                    whole("paragraphs", PARAGRAPH),
                    F.flatten(F.transform("runs", twos)),
                    F.flatten(F.transform("runs", singles)),
                )
            ).alias("unit"),
        )
        # a part of one line is a line
        .where((F.col("unit.n") > 1) | (F.col("unit.kind") == LINE))
        .select("conv_id", "turn", "unit.level", "unit.kind", F.xxhash64("unit.text").alias("h1"), F.xxhash64(F.reverse("unit.text")).alias("h2"), "unit.n")
    )


def parents(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, votes): the earlier message that a message quotes most; ties to the later one.

    Whole passages count first, then paragraphs, pairs of lines and lines. The
    outermost quote level that finds an original tells the parent; deeper ones
    are quotes that the parent itself had. ``votes`` are the quoted lines.
    """
    units = units_of(messages.where("conv_id IS NOT NULL AND turn IS NOT NULL"))
    hashed = units.groupBy("conv_id", "h1", "h2", "turn", "level", "kind").agg(F.sum("n").alias("n"))
    # the latest earlier message with this unit among its own: no pairs of messages are made
    before = Window.partitionBy("conv_id", "h1", "h2").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    original = F.max(F.when(F.col("level") == 0, F.col("turn"))).over(before)

    def lines(kind: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))

    votes = (
        hashed.withColumn("parent_turn", original)
        .where("level > 0 AND parent_turn IS NOT NULL")
        .groupBy("conv_id", "turn", "level", "parent_turn")
        .agg(lines(PASSAGE).alias("passages"), lines(PARAGRAPH).alias("paragraphs"), lines(TWO_LINES).alias("twos"), lines(LINE).alias("lines"))
    )
    order = F.struct((-F.col("level")).alias("outermost"), "passages", "paragraphs", "twos", "lines", "parent_turn")
    best = votes.groupBy("conv_id", "turn").agg(F.max(order).alias("best"))
    return best.select(
        "conv_id",
        "turn",
        F.col("best.parent_turn").alias("parent_turn"),
        F.greatest("best.passages", "best.paragraphs", "best.lines").alias("votes"),
    )


def reply_roots(links: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) of every linked message, by pointer doubling."""
    state = saved(links.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).alias("depth")), "replies")
    while True:
        up = state.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next"), F.col("depth").alias("more"))
        state = saved(
            state.join(up, ["conv_id", "root_turn"], "left").select(
                "conv_id",
                "turn",
                F.coalesce("next", "root_turn").alias("root_turn"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "replies",
        )
        if not state.where("moved").limit(1).count():
            return state.drop("moved")


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, parent_turn, root_turn, depth, n_quoted, votes, text, formatted.

    Rows ordered by (conv_id, root_turn, depth, turn) are in reply order: a
    reply stands after its parent. A message without a linked quote is its own
    root at depth 0. ``text`` is the message without quoted lines and blank
    ends; ``formatted`` puts the role before it.

    Null texts are empty, a null role is ``user``. Rows with a null conv_id or
    turn are formatted and linked with nothing. Rows that repeat a turn are
    formatted each and share the parent that their quotes together choose.
    Other columns are not read. An empty table gives an empty result.
    """
    links = saved(parents(messages), "quotes")
    placed = links.join(reply_roots(links), ["conv_id", "turn"]).select(
        F.col("conv_id").alias("l_conv"), F.col("turn").alias("l_turn"), "parent_turn", "root_turn", "depth", "votes"
    )
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    own = F.filter(lines, lambda l: ~l.rlike(MARKS))
    text = F.btrim(F.array_join(own, "\n"), F.lit(" \t\n\r"))
    m = messages.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("user")).alias("role"),
        (F.size(lines) - F.size(own)).cast("long").alias("n_quoted"),
        text.alias("text"),
    )
    return m.join(placed, (m["conv_id"] == placed["l_conv"]) & (m["turn"] == placed["l_turn"]), "left").select(
        "conv_id",
        "turn",
        "role",
        "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        "n_quoted",
        F.coalesce("votes", F.lit(0)).cast("long").alias("votes"),
        "text",
        F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n")).alias("formatted"),
    )


def render(formatted: DataFrame) -> DataFrame:
    """(conv_id, chat): whole conversations as one text each, in reply order. For conversations of ordinary length."""
    ordered = F.array_sort(F.collect_list(F.struct("root_turn", "depth", "turn", "formatted")))
    return formatted.groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda m: m["formatted"]), "").alias("chat"))
