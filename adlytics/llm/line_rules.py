"""Quality rules, line first: lines are judged and removed, then documents that lost too much.

A line fails by the first rule that holds: ``navigation`` (menus: words between separators,
or mark-up characters), ``boilerplate`` (a short line with a stock phrase) or
``punctuation`` (a fragment of few words, or a long run of words, without a sentence mark).
Lines without a word neither fail nor count. A document is kept if it passes the base
rules (length, repeated words) and at most ``max_lost`` of its words stood in failed lines.

Everything is a column expression over one row: no shuffle, no Python, any text length.

Defined results: NULL text has no words and fails the base rules; equal rows get equal
results; an empty table gives no rows. Input columns stay inside the struct ``__doc``, so
their names cannot clash with those added. Repeated windows are found by 64-bit hashes of
their words within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import SPACE_RUN, SPACES, rolling_hashes, words

# Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Characters that stand between the entries of a menu.
SEPARATORS = "|›»•·"
#: Share of words next to a separator from which a line is a menu.
MENU_SHARE = 0.25
#: Symbols per word from which a line is mark-up.
MARKUP_SHARE = 0.5
SENTENCE_MARKS = r"[.!?…:;。！？؟।]"
#: A line without sentence mark fails with fewer words than the first or more than the second.
FRAGMENT_WORDS, RUN_WORDS = 4, 100
BOILERPLATE_WORDS = 20
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "back to top",
    "click here to",
    "cookie policy",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "privacy policy",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
)
MIN_WORDS = 50
MAX_REPEATED = 0.5
MAX_LOST = 0.3


def _count_words(line: Column) -> Column:
    trimmed = F.btrim(line, F.lit(SPACES))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE_RUN)))


def _count_chars(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def failed_rule(line: Column, n_words: Column) -> Column:
    """Name of the rule a line fails by, NULL if it passes."""
    menu = _count_chars(line, SEPARATORS) >= F.greatest(F.lit(2), n_words * MENU_SHARE)
    markup = _count_chars(line, SYMBOLS) > n_words * MARKUP_SHARE
    stock = F.lit(False)
    lowered = F.lower(line)
    for phrase in BOILERPLATE:
        stock = stock | F.contains(lowered, F.lit(phrase))
    unmarked = ~F.rlike(line, F.lit(SENTENCE_MARKS))
    odd_length = (n_words < FRAGMENT_WORDS) | (n_words > RUN_WORDS)
    return (
        F.when(n_words == 0, F.lit(None))
        .when(menu | markup, "navigation")
        .when((n_words <= BOILERPLATE_WORDS) & stock, "boilerplate")
        .when(unmarked & odd_length, "punctuation")
    )


def _repeated_words(df: DataFrame, window: int = 3) -> DataFrame:
    """Adds ``n_repeat_words`` from ``words``: those in windows found twice or more."""
    hashes = F.col("hashes")
    nothing = F.array().cast("array<struct<hash:bigint,at:int>>")
    ranked = F.sort_array(
        F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("at")))
    )
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    pairs = F.col("pairs")
    twin = lambda x, i: (
        F.coalesce(F.get(pairs, i - 1)["hash"] == x["hash"], F.lit(False))
        | F.coalesce(F.get(pairs, i + 1)["hash"] == x["hash"], F.lit(False))
    )
    starts = F.col("starts")
    covered = F.transform(
        starts,
        lambda s, i: F.least(F.lit(window), F.coalesce(F.get(starts, i + 1) - s, F.lit(window))),
    )
    return (
        df.withColumn("hashes", rolling_hashes("words", window))
        .withColumn("pairs", F.when(some, ranked).otherwise(nothing))
        .withColumn("starts", F.sort_array(F.transform(F.filter(pairs, twin), lambda x: x["at"])))
        .withColumn(
            "n_repeat_words",
            F.aggregate(covered, F.lit(0).cast("bigint"), lambda acc, n: acc + n),
        )
        .drop("hashes", "pairs", "starts")
    )


def clean_lines(docs: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """Base counts, verdict and cleaned text of every document, beside the struct ``__doc``."""
    content = F.coalesce(F.col(text), F.lit(""))
    measured = docs.select(F.struct("*").alias("__doc"), content.alias("content")).select(
        "__doc",
        "content",
        words(F.col("content")).alias("words"),
        F.transform(
            F.split("content", "\n"),
            lambda line: F.struct(line.alias("line"), _count_words(line).alias("n")),
        ).alias("counted"),
    )
    judged = _repeated_words(measured).withColumn(
        "judged",
        F.transform(
            "counted",
            lambda x: F.struct(
                x["line"].alias("line"),
                x["n"].alias("n"),
                failed_rule(x["line"], x["n"]).alias("rule"),
            ),
        ),
    )
    with_word = F.transform(F.filter("counted", lambda x: x["n"] > 0), lambda x: x["line"])
    passed = F.filter("judged", lambda x: x["rule"].isNull())
    lost = F.aggregate(
        F.filter("judged", lambda x: x["rule"].isNotNull()),
        F.lit(0).cast("bigint"),
        lambda acc, x: acc + x["n"],
    )
    n_words = F.size("words").cast("bigint")
    base = judged.select(
        "__doc",
        n_words.alias("n_words"),
        F.char_length(F.translate("content", SPACES, "")).cast("bigint").alias("word_chars"),
        _count_chars(F.col("content"), SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.size(with_word) - F.size(F.array_distinct(with_word)))
        .cast("bigint")
        .alias("n_dup_lines"),
        "n_repeat_words",
        lost.alias("n_lost_words"),
        F.array_join(F.transform(passed, lambda x: x["line"]), "\n").alias("cleaned"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )
    kept = ~failed & (F.col("n_lost_words") <= max_lost * F.col("n_words"))
    verdict = base.withColumn("base_failed", failed).withColumn("kept", kept)
    # A generator of one row: a filter on the verdict stays above it, where the arrays are
    # built already; below a projection each of their elements would build them again.
    measures = F.struct(*(c for c in verdict.columns if c != "__doc"))
    return verdict.select("__doc", F.inline_outer(F.array(measures)))


def kept_documents(judged: DataFrame) -> DataFrame:
    """Rows of ``clean_lines`` that are kept."""
    return judged.where("kept")
