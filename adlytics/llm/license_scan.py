"""License scan by diagonal voting.

All windows of ``K`` words of every text are joined by hash with the windows of the
templates, a small fixed table. A hit at text word p and template word t votes for the
diagonal p - t. Votes are counted per diagonal, neighbouring diagonals (a word added or
left out) are merged into one span, and a span is verified: enough of the template's
windows must be in it, within little more than the template's own length. A phrase stands
somewhere exactly where one diagonal has all its windows. A diagonal that alone holds enough
is verified before any merging, so that a mention close by cannot take it away.

Only hits are grouped, so frequent words cost nothing after the join; a text's hits are
bounded by its own length. Templates are a table (label, exact, wording), whole licenses too:
the phrases and notices below where none is given. Up to ``LISTED`` of its windows are
looked up where they stand in a text, and broadcast; a larger table meets all windows of
the texts in a join whose sides Spark chooses by their sizes.

Defined results: NULL text is empty and has no words. Rows with equal id and text get equal
results. An empty table gives no rows. Only the named columns are read. Windows are
compared by 64-bit hash and then by their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlytics.llm.common import lower_ascii, rolling_hashes

K = 3
#: Windows of templates that are listed in the plan and broadcast.
LISTED = 20_000
#: Diagonals at most so far apart are one span.
DRIFT = 4
#: Share of a template's windows a span must hold, and its length in template lengths.
COVERAGE, STRETCH = 0.6, 1.5
#: A notice of at most so many windows must be whole, as its versions differ in one word.
SHORT = 8

# Phrases that must stand word for word, and their labels.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
#: Wording of common notices, matched with gaps.
NOTICES = (
    ("all-rights-reserved", "all rights reserved"),
    (
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of"
        " the license at",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
    ),
    ("cc-by-4", "licensed under a creative commons attribution 4 0 international license"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files to deal in the software without restriction",
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def alnum_words(text: Column) -> Column:
    """Runs of 0-9, a-z and characters beyond ASCII, A-Z lower-cased."""
    lowered = lower_ascii(F.coalesce(text, F.lit("")))
    return F.filter(F.split(lowered, SEPARATORS), lambda w: w != "")


def common_templates(spark: SparkSession) -> DataFrame:
    """(label, exact, wording) of the phrases and notices above."""
    rows = [(label, True, wording) for label, wording in PHRASES]
    rows += [(label, False, wording) for label, wording in NOTICES]
    return spark.createDataFrame(rows, "label string, exact boolean, wording string")


def template_windows(templates: DataFrame) -> DataFrame:
    """(template, label, exact, windows, at, hash, words): each window of each template.

    A template is told by its hash; one of fewer than ``K`` words has no window.
    """
    return (
        templates.select("label", "exact", alnum_words(F.col("wording")).alias("w"))
        .distinct()
        .withColumn("template", F.xxhash64("label", "exact", "w"))
        .withColumn("windows", F.size("w") - (K - 1))
        .select(
            "template",
            "label",
            "exact",
            "windows",
            "w",
            F.posexplode(rolling_hashes("w", K)).alias("at", "hash"),
        )
        .withColumn("words", F.slice("w", F.col("at") + 1, K))
        .drop("w")
    )


def verified_spans(
    docs: DataFrame, doc_id: str, text: str, templates: DataFrame | None = None
) -> DataFrame:
    """(doc, row, label, exact, start, coverage) of every verified span."""
    content = F.coalesce(F.col(text), F.lit(""))
    if templates is None:
        templates = common_templates(docs.sparkSession)
    templates = template_windows(templates)
    known = [r["hash"] for r in templates.select("hash").distinct().limit(LISTED + 1).collect()]
    places = F.sequence(F.lit(0), F.size("h") - 1)
    if len(known) <= LISTED:
        # Words are cut out where a hash is a template's only.
        places = F.filter(places, lambda i: F.get("h", i).isin(known))
        templates = F.broadcast(templates)
    window = lambda i: F.struct(
        i.alias("pos"), F.get("h", i).alias("hash"), F.slice("w", i + 1, K).alias("words")
    )
    hits = (
        docs.select(
            F.col(doc_id).alias("doc"),
            F.xxhash64(F.col(doc_id), content).alias("row"),
            alnum_words(content).alias("w"),
        )
        .select("doc", "row", "w", rolling_hashes("w", K).alias("h"))
        .select("doc", "row", "w", "h", F.when(F.size("h") > 0, places).alias("places"))
        # Outer: else the planner tests that hits exist by building them once more for each.
        .select("doc", "row", F.explode_outer(F.transform("places", window)).alias("hit"))
        .select("doc", "row", "hit.*")
        .join(templates, ["hash", "words"])
    )
    span = ["doc", "row", "template", "label", "exact", "windows"]
    votes = hits.groupBy(*span, (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.array_sort(F.collect_set("at")).alias("at")
    )
    needed = F.when(F.col("exact") | (F.col("windows") <= SHORT), 1.0).otherwise(COVERAGE)
    alone = (
        votes.withColumn("coverage", F.size("at") / F.col("windows"))
        .where(F.col("coverage") >= needed)
        .select(*span, (F.col("diagonal") + F.element_at("at", 1)).alias("start"), "coverage")
    )
    # Diagonals of one text and template: bounded by the text's own words.
    near = Window.partitionBy("doc", "row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(near) > DRIFT
    merged = (
        votes.where(~F.col("exact"))
        .withColumn("fresh", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("fresh").over(near))
        .groupBy(*span, "span")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("held"),
            F.min(F.col("diagonal") + F.element_at("at", 1)).alias("start"),
            F.max(F.col("diagonal") + F.element_at("at", -1)).alias("end"),
        )
    )
    length = F.col("end") - F.col("start") + 1
    notices = (
        merged.withColumn("coverage", F.col("held") / F.col("windows"))
        .where((F.col("coverage") >= needed) & (length <= STRETCH * F.col("windows") + 1))
        .select(*span, F.col("start").cast("int").alias("start"), "coverage")
    )
    return alone.union(notices).select("doc", "row", "label", "exact", "start", "coverage")


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: DataFrame | None = None,
) -> DataFrame:
    """Words, phrase places, labels and score of every document."""
    content = F.coalesce(F.col(text), F.lit(""))
    spans = verified_spans(docs, doc_id, text, templates)
    base = F.when(F.col("exact"), F.col("start")).cast("bigint")
    labels = lambda kept: F.array_join(F.array_sort(F.collect_set(kept)), ",")
    found = (
        spans.groupBy("doc", "row")
        .agg(
            F.count(base).alias("n_base"),
            F.min(base).alias("first_word"),
            F.max(base).alias("last_word"),
            labels(F.when(F.col("exact"), F.col("label"))).alias("base_labels"),
            labels(F.col("label")).alias("labels"),
            F.max("coverage").alias("score"),
        )
        .withColumnsRenamed({"doc": "found_doc", "row": "found_row"})
    )
    counted = docs.select(
        F.col(doc_id).alias("doc"),
        F.xxhash64(F.col(doc_id), content).alias("row"),
        F.size(alnum_words(content)).cast("bigint").alias("n_words"),
    )
    same = (F.col("row") == F.col("found_row")) & F.col("doc").eqNullSafe(F.col("found_doc"))
    return counted.join(found, same, "left").select(
        "doc",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
