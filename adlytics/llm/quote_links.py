"""Quotation linking: who replies to whom, by what messages quote.

Lines that begin with ``>`` are quoted, at a level of as many ``>``. Paragraphs of one level
and their single lines are passages; a passage is compared by the hash of its words in lower
case. A quoted passage belongs to the first message of its conversation that wrote it
itself. A message replies to the message whose passages it quotes at the least level, most
characters first, then the latest; without such a quote it replies to the message before it.
Conversations come back without quotes, each message after the one it replies to: by
distance from the first message, then by turn.

No conversation is gathered anywhere: messages are numbered over ranges of (conversation,
turn), predecessors are found by number, originals are one row per passage. Messages that
reply to the one before them form runs, whose hops are counted by number; distances double
along the heads of runs, in as many rounds as the logarithm of the longest chain of these.

Defined results: equal rows are one message. NULL text is empty. A NULL conversation is one
conversation, NULL turns come first. Messages of equal turns are ordered by role, then by a
hash of their text. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlytics.llm.common import checkpointed, numbered, stored

#: Messages in a block, at least.
LEAST_BLOCK = 1024
_PREFIX = r"^(?:[ \t]*>)+"
#: A line that announces a quote.
_ATTRIBUTION = r"(?i)\b(?:wrote|writes|schrieb|écrit|escribió)\s*:\s*$"


def _levels(text: Column) -> Column:
    """Lines of a text as (level, body)."""

    def parse(line: Column) -> Column:
        prefix = F.regexp_extract(line, _PREFIX, 0)
        level = F.char_length(prefix) - F.char_length(F.translate(prefix, ">", ""))
        body = F.substring(line, F.char_length(prefix) + 1, F.char_length(line))
        return F.struct(level.alias("level"), body.alias("body"))

    return F.transform(F.split(text, "\n"), parse)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """Adds ``passages`` (level, words) and ``own`` (text without quotes) from ``content``."""
    lines, starts = F.col("lines"), F.col("starts")
    blank = lambda x: ~F.rlike(x["body"], F.lit(r"\S"))
    begins = lambda x, i: (
        (i == 0)
        | (F.get(lines, i - 1)["level"] != x["level"])
        | (blank(F.get(lines, i - 1)) != blank(x))
    )
    places = F.filter(
        F.transform(lines, lambda x, i: F.when(begins(x, i), i)), lambda i: i.isNotNull()
    )
    paragraph = lambda s, i: F.struct(
        F.get(lines, s)["level"].alias("level"),
        F.transform(
            F.slice(lines, s + 1, F.coalesce(F.get(starts, i + 1), F.size(lines)) - s),
            lambda x: x["body"],
        ).alias("bodies"),
    )
    whole = F.transform(
        "paragraphs",
        lambda p: F.struct(p["level"], normalised(F.array_join(p["bodies"], " ")).alias("words")),
    )
    single = F.flatten(
        F.transform(
            F.filter("paragraphs", lambda p: F.size(p["bodies"]) > 1),
            lambda p: F.transform(
                p["bodies"],
                lambda body: F.struct(p["level"], normalised(body).alias("words")),
            ),
        )
    )
    announces = lambda x, i: (
        F.rlike(x["body"], F.lit(_ATTRIBUTION))
        & F.coalesce(F.get(lines, i + 1)["level"] > 0, F.lit(False))
    )
    own = F.filter(lines, lambda x, i: (x["level"] == 0) & ~announces(x, i))
    quotes = F.exists(lines, lambda x: x["level"] > 0)
    own_text = F.array_join(F.transform(own, lambda x: x["body"]), "\n")
    return (
        messages.withColumn("lines", _levels(F.col("content")))
        .withColumn("starts", places)
        .withColumn("paragraphs", F.transform(starts, paragraph))
        .withColumn(
            "passages", F.filter(F.concat(whole, single), lambda p: F.char_length(p["words"]) > 0)
        )
        .withColumn("own", F.when(quotes, F.btrim(own_text, F.lit(" \t\n\r"))).otherwise(F.col("content")))
        .drop("lines", "starts", "paragraphs")
    )


def _in_order(messages: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Messages read and numbered ``m`` (0, 1, 2, ...) in ``order``, and how many there are.

    The places come from the sorted ranges themselves, as in ``numbered``; texts are moved
    into their range and written once, already without quotes.
    """
    spark = messages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = messages.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    written = stored(
        parsed(ranges.withColumn("at", F.monotonically_increasing_id())).drop("content")
    )
    part = F.shiftright("at", 33)
    counts = written.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    starts, total = [], 0
    for part_id, n in sorted((row["part"], row["n"]) for row in counts):
        starts.append((part_id, total))
        total += n
    offsets = spark.createDataFrame(starts, "part bigint, before bigint")
    m = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    numbers = written.withColumn("part", part).join(F.broadcast(offsets), "part")
    return numbers.withColumn("m", m).drop("part", "before", "at"), total


def _runs(replies: DataFrame, total: int) -> DataFrame:
    """Adds ``head``: the last message up to this one that does not reply to the one before it.

    Heads are looked for in blocks of neighbouring messages, about as many as partitions; a
    block gets the last head before it from the driver, which holds one number a block.
    """
    spark = replies.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = max(LEAST_BLOCK, -(-total // (4 * parts)))
    heads = F.when(~F.col("parent").eqNullSafe(F.col("m") - 1), F.col("m"))
    so_far = Window.partitionBy("block").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    inside = checkpointed(
        replies.withColumn("block", F.floor(F.col("m") / width).cast("bigint"))
        .withColumn("head", F.max(heads).over(so_far))
    )
    last = inside.groupBy("block").agg(F.max("head").alias("head")).collect()
    before, head = [], None
    for block, own in sorted((row["block"], row["head"]) for row in last):
        before.append((block, head))
        head = head if own is None else own
    earlier = spark.createDataFrame(before, "block bigint, earlier bigint")
    return (
        inside.join(F.broadcast(earlier), "block")
        .withColumn("head", F.coalesce("head", "earlier"))
        .drop("block", "earlier")
    )


def _distances(hops: DataFrame) -> DataFrame:
    """(m, depth) from (m, up, depth): ``m`` is ``depth`` hops behind ``up``, or where its
    chain ends if that is NULL. Hops double; a chain that has reached its end takes no part
    in further rounds.
    """
    ended, running = hops.where(F.col("up").isNull()), hops.where(F.col("up").isNotNull())
    while not running.isEmpty():
        above = running.union(ended).select(
            F.col("m").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more")
        )
        hops = checkpointed(
            running.join(above, "up").select(
                "m", F.col("further").alias("up"), (F.col("depth") + F.col("more")).alias("depth")
            )
        )
        ended = ended.union(hops.where(F.col("up").isNull()))
        running = hops.where(F.col("up").isNotNull())
    return ended.select("m", "depth")


def _depths(runs: DataFrame) -> DataFrame:
    """Adds ``depth``: hops to the first message.

    Within a run of messages that each reply to the one before, hops are counted by number.
    Only the heads of runs inside a conversation are followed: to the message they reply to,
    from there to the head of its run, and so on.
    """
    inner = runs.where((F.col("head") == F.col("m")) & F.col("parent").isNotNull())
    replied = runs.select(
        F.col("m").alias("parent"),
        F.when(F.col("head") != F.col("start"), F.col("head")).alias("up"),
        (F.col("m") - F.col("head") + 1).alias("depth"),
    )
    hops = checkpointed(inner.select("m", "parent").join(replied, "parent").select("m", "up", "depth"))
    of_head = _distances(hops).select(F.col("m").alias("head"), F.col("depth").alias("of_head"))
    along = F.col("m") - F.col("head")
    return runs.join(of_head, "head", "left").withColumn(
        "depth", along + F.coalesce("of_head", F.lit(0).cast("bigint"))
    )


def link_quotes(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conversation, turn, role, position, reply_to, depth, n_passages, n_linked, text) of
    every message; ``reply_to`` is the position it replies to."""
    content = F.coalesce(F.col(text), F.lit(""))
    named = messages.select(
        F.col(conversation).alias("conversation"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        content.alias("content"),
        F.unhex(F.md5(content.cast("binary"))).alias("digest"),
    )
    identity = ["conversation", "turn", "role", "digest"]
    unique = named.groupBy(identity).agg(F.first("content").alias("content"))
    texts, total = _in_order(unique, identity)
    passages = texts.select("m", "conversation", F.explode("passages").alias("p")).select(
        "m",
        "conversation",
        F.col("p.level").alias("level"),
        F.unhex(F.md5(F.col("p.words").cast("binary"))).alias("hash"),
        F.char_length("p.words").alias("chars"),
    )
    written = passages.where("level = 0").groupBy("conversation", "hash").agg(F.min("m").alias("by"))
    quoted = passages.where("level > 0")
    written = written.withColumnsRenamed({"conversation": "in_conversation", "hash": "of_hash"})
    linked = quoted.join(
        written,
        (F.col("hash") == F.col("of_hash"))
        & F.col("conversation").eqNullSafe(F.col("in_conversation"))
        & (F.col("by") < F.col("m")),
    )
    best = (
        linked.groupBy("m", "level", "by")
        .agg(F.sum("chars").alias("chars"), F.count("*").alias("n"))
        .groupBy("m")
        .agg(
            F.max(F.struct(-F.col("level"), "chars", "by"))["by"].alias("quotes"),
            F.sum("n").alias("n_linked"),
        )
    )
    # The numbers of a conversation are gapless; the first one stands for it from here on.
    starts = texts.groupBy(F.col("conversation").alias("of")).agg(F.min("m").alias("start"))
    replies = (
        texts.select("m", "conversation")
        .join(starts, F.col("conversation").eqNullSafe(F.col("of")))
        .join(best, "m", "left")
        .select(
            "m",
            "start",
            F.coalesce("quotes", F.when(F.col("m") > F.col("start"), F.col("m") - 1)).alias("parent"),
            F.coalesce("n_linked", F.lit(0).cast("bigint")).alias("n_linked"),
        )
    )
    depths = _depths(_runs(replies, total)).select("m", "start", "parent", "depth", "n_linked")
    placed = numbered(depths, [F.col("start"), F.col("depth"), F.col("m")], "place")
    # A conversation takes the same numbers in either order.
    positions = placed.select("m", "parent", "depth", "n_linked", (F.col("place") - F.col("start")).alias("position"))
    above = positions.select(F.col("m").alias("parent"), F.col("position").alias("reply_to"))
    return (
        texts.join(positions.join(above, "parent", "left"), "m")
        .select(
            "conversation",
            "turn",
            "role",
            "position",
            "reply_to",
            "depth",
            F.size(F.filter("passages", lambda p: p["level"] > 0)).cast("bigint").alias("n_passages"),
            "n_linked",
            F.col("own").alias("text"),
        )
    )
