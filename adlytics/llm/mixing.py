"""Mixing sources to target weights, block by block.

1. Targets: the words of all sources are shared by weight; no source gets more than
   ``max_repeats`` times its words, and what it cannot use is shared by the others.
2. Packing: the words of a source, document after document, are cut into blocks of fixed
   length. A block is a list of spans of documents; text is not moved.
3. Draws: the mix has as many slots as targets ask for, in output shards of ``shard_slots``.
   Each shard draws how many slots each source gets: multinomial counts, drawn under the
   condition that all shards together meet the targets. The slots of all sources stand in
   one row, source after source; a pseudorandom permutation, computed and not stored, deals
   them to the shards, and a shard counts what it is dealt. That is the draw without
   replacement itself, the same at every size; any shard finds its counts, and which slots
   of a source they are, alone, and a rerun or a lost task draws the same.
4. Permutation: the slots of a source, counted over all shards, walk through its blocks in
   epochs; inside an epoch a pseudorandom permutation of the block numbers, computed and
   not stored, says which block a slot takes. So no block is taken twice as often as
   another plus once.
5. Join: slots meet blocks on (source, block number); no key is hot, as block numbers are
   spread evenly.

Sources are the rows of the mixing recipe: their sizes and weights are held by the driver
and by each task, as a recipe's are. Their documents and blocks never are.

Defined results: a NULL source is one source after all others. NULL or blank text has no
words and is in no block. Rows with equal ids are separate documents. With no words at all,
nothing is mixed. Word positions count whole texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import checkpointed, words

BLOCK_WORDS = 128
SHARD_SLOTS = 1024
MAX_REPEATS = 3
WEIGHTS = (5, 2, 1)
SEED = 20240501
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes: list[int], weights: list[float], max_repeats: float) -> list[float]:
    """Words each source should give: shares by weight under the cap, the excess reshared."""
    total, goal = float(sum(sizes)), [0.0] * len(sizes)
    open_, left = list(range(len(sizes))), total
    while open_:
        share = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if share * weights[i] > max_repeats * sizes[i]]
        if not over:
            for i in open_:
                goal[i] = share * weights[i]
            break
        for i in over:
            goal[i] = float(max_repeats * sizes[i])
            left -= goal[i]
        open_ = [i for i in open_ if i not in set(over)]
    return goal


def permuted(index: np.ndarray, n: int, key: str) -> np.ndarray:
    """Place of each index in a pseudorandom permutation of 0 .. ``n`` - 1.

    Four Feistel rounds over the next even number of bits; numbers that fall outside are
    sent round again until they are inside.
    """
    bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << bits) - 1)
    rounds = np.frombuffer(hashlib.sha256(key.encode()).digest(), "<u8")

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(bits), x & mask
        for k in rounds:
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return (left << np.uint64(bits)) | right

    out = once(np.asarray(index).astype(np.uint64))
    while True:
        outside = out >= n
        if not outside.any():
            return out.astype(np.int64)
        out[outside] = once(out[outside])


def shard_draw(
    slots: np.ndarray, shard_slots: int, shard: int, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """(source, number among the source's slots) of each slot of a shard."""
    stops = np.cumsum(slots.astype(np.int64))
    total = int(stops[-1])
    places = np.arange(shard * shard_slots, min((shard + 1) * shard_slots, total))
    dealt = permuted(places, total, f"{seed}/slots")
    source = np.searchsorted(stops, dealt, "right")
    return source, dealt - (stops - slots)[source]


def measured(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    """(at, doc, row, source, size) of each document, sorted by source and document in ranges.

    ``at`` is a document's own number, ``row`` the hash of its text. Ranges are cut by
    (source, doc, row), so a source with most rows fills many of them.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").asc_nulls_last(), F.col("doc"), F.col("row"), F.col("size")]
    sized = docs.select(
        F.col(doc_id).cast("bigint").alias("doc"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row"),
        F.col(source).cast("string").alias("source"),
        F.size(words(F.col(text))).cast("bigint").alias("size"),
    )
    ranges = sized.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return checkpointed(ranges.withColumn("at", F.monotonically_increasing_id()))


def recipe(sized: DataFrame, weights: tuple[float, ...], max_repeats: float) -> list[dict]:
    """One entry per source in code point order, NULL last: size, weight, target."""
    found = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found = sorted(found, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    cycle = [float(weights[i % len(weights)]) for i in range(len(found))]
    goals = targets([r["size"] for r in found], cycle, max_repeats)
    return [
        {"source": r["source"], "size": r["size"], "weight": w, "target": goal}
        for r, w, goal in zip(found, cycle, goals)
    ]


SPANS = "at bigint, source_no bigint, block bigint, from_word bigint, n_words bigint"


def block_spans(sized: DataFrame, entries: list[dict], block_words: int) -> DataFrame:
    """(at, source_no, block, from_word, n_words): each block's spans of documents."""
    number = {e["source"]: i for i, e in enumerate(entries)}
    part = F.shiftright("at", 33).alias("part")
    sums = sized.groupBy(part, "source").agg(F.sum("size").alias("n")).collect()
    # Where each source stands at the start of each partition: at most one entry per
    # partition and one per source, as ranges are sorted by source.
    starts: dict[tuple[int, str | None], int] = {}
    reached = [0] * len(entries)
    for row in sorted(sums, key=lambda r: r["part"]):
        starts[row["part"], row["source"]] = reached[number[row["source"]]]
        reached[number[row["source"]]] += row["n"]
    held = sized.sparkSession.sparkContext.broadcast((starts, number))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, number = held.value
        reached: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column(0).to_numpy()
            sizes = batch.column(2).to_numpy()
            sources = batch.column(1).to_pylist()
            edges = [i for i in range(len(at)) if i == 0 or sources[i] != sources[i - 1]]
            begins = np.zeros(len(at), np.int64)
            numbers = np.zeros(len(at), np.int64)
            for a, b in zip(edges, [*edges[1:], len(at)]):
                source = sources[a]
                first = reached.get(source, starts[int(at[a]) >> 33, source])
                stops = first + np.cumsum(sizes[a:b])
                begins[a:b], numbers[a:b] = stops - sizes[a:b], number[source]
                reached[source] = int(stops[-1])
            first = begins // block_words
            n = np.where(sizes > 0, (begins + sizes - 1) // block_words - first + 1, 0)
            row = np.repeat(np.arange(len(sizes)), n)
            block = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            start = np.maximum(block * block_words, begins[row])
            end = np.minimum((block + 1) * block_words, begins[row] + sizes[row])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (at[row], numbers[row], block, start - begins[row], end - start)],
                names=["at", "source_no", "block", "from_word", "n_words"],
            )

    return sized.select("at", "source", "size").mapInArrow(cut, SPANS)


def slot_counts(entries: list[dict], block_words: int, max_repeats: float) -> list[tuple[int, int]]:
    """(slots, blocks) of each source; the last block of a source may be short."""
    out = []
    for e in entries:
        blocks = -(-e["size"] // block_words)
        slots = round(e["target"] * blocks / e["size"]) if e["size"] else 0
        out.append((min(slots, int(max_repeats * blocks)), blocks))
    return out


def mixed_slots(
    docs: DataFrame, counts: list[tuple[int, int]], shard_slots: int, seed: int
) -> DataFrame:
    """(shard, slot, source_no, block): which block every slot of every output shard takes."""
    spark = docs.sparkSession
    slots = np.array([s for s, _ in counts], np.int64)
    blocks = [b for _, b in counts]
    shards = -(-int(slots.sum()) // shard_slots) if len(slots) else 0

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                numbers, ordinals = shard_draw(slots, shard_slots, shard, seed)
                taken = np.empty(len(numbers), np.int64)
                for source in np.unique(numbers).tolist():
                    own = numbers == source
                    taken[own] = slot_blocks(source, ordinals[own])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(numbers), shard)),
                        pa.array(np.arange(len(numbers))),
                        pa.array(numbers.astype(np.int64)),
                        pa.array(taken),
                    ],
                    names=["shard", "slot", "source_no", "block"],
                )

    def slot_blocks(source: int, ordinal: np.ndarray) -> np.ndarray:
        """Blocks of slots of a source, epoch by epoch."""
        epoch, index = ordinal // blocks[source], ordinal % blocks[source]
        taken = np.empty(len(ordinal), np.int64)
        for e in np.unique(epoch).tolist():
            taken[epoch == e] = permuted(index[epoch == e], blocks[source], f"{seed}/{source}/{e}")
        return taken

    parts = max(1, min(shards, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.range(0, shards, 1, parts).mapInArrow(
        draw, "shard bigint, slot bigint, source_no bigint, block bigint"
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    max_repeats: float = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame, list[dict]]:
    """The mix, the measured documents and the recipe.

    The mix has a row per slot and span of its block: (shard, slot, source_no, block, at,
    from_word, n_words).
    """
    sized = measured(docs, doc_id, source, text)
    entries = recipe(sized, weights, max_repeats)
    spans = block_spans(sized, entries, block_words)
    counts = slot_counts(entries, block_words, max_repeats)
    slots = mixed_slots(docs, counts, shard_slots, seed)
    # Both sides grow with the corpus, which the planner cannot see: no broadcast.
    return slots.join(spans.hint("merge"), ["source_no", "block"]), sized, entries


def taken_words(mixed: DataFrame, sized: DataFrame, entries: list[dict]) -> DataFrame:
    """(at, doc, row, size, source_size, target, taken) of every document."""
    rows = [(e["source"], e["size"], e["target"]) for e in entries]
    facts = sized.sparkSession.createDataFrame(
        rows, "source string, source_size bigint, target double"
    ).withColumnRenamed("source", "of")
    taken = mixed.groupBy("at").agg(F.sum("n_words").alias("taken"))
    return (
        sized.join(F.broadcast(facts), F.col("source").eqNullSafe(F.col("of")))
        .join(taken, "at", "left")
        .select(
            "at",
            "doc",
            "row",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"),
        )
    )


def mixed_documents(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **recipe
) -> DataFrame:
    """The mix as documents: (struct ``__doc``, ``repeat``, ``mixed_text``).

    Repeat 0 of a document holds its words that the mix takes at least once, repeat 1 those
    taken at least twice, and so on, in the document's order; a document the mix takes no
    word of is left out. Runs of words keep the white space between them.
    """
    mixed, sized, _ = mix(docs, doc_id, source, text, **recipe)
    uses = mixed.groupBy("at", "from_word", "n_words").agg(F.count("*").alias("uses"))
    # A document's spans are no more than its own words allow.
    spans = uses.groupBy("at").agg(
        F.sort_array(F.collect_list(F.struct("from_word", "n_words", "uses"))).alias("spans")
    )
    plan = sized.join(spans, "at").select(
        "doc", "row", F.col("spans"), F.array_max(F.transform("spans", lambda s: s["uses"])).alias("most")
    )
    content = F.coalesce(F.col(text), F.lit(""))
    texts = (
        docs.select(
            F.struct("*").alias("__doc"),
            F.col(doc_id).cast("bigint").alias("doc"),
            F.xxhash64(content).alias("row"),
            content.alias("content"),
        )
        .groupBy("doc", "row")
        .agg(F.first("__doc").alias("__doc"), F.first("content").alias("content"))
    )
    same = texts["doc"].eqNullSafe(plan["doc"]) & (texts["row"] == plan["row"])
    joined = texts.join(plan, same).select("__doc", "content", "spans", "most")
    return joined.select(
        "__doc",
        "content",
        "spans",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("most") - 1)).alias("repeat"),
    ).select("__doc", "repeat", F.pandas_udf(cut_words, "string")("content", "spans", "repeat").alias("mixed_text"))


def cut_words(content: pd.Series, spans: pd.Series, repeat: pd.Series) -> pd.Series:
    """The words of spans used more than ``repeat`` times; neighbouring spans stay joined."""

    def cut(text: str, own: list, least: int) -> str:
        found = [m.span() for m in _WORD.finditer(text)]
        parts: list[list[int]] = []
        for span in own:
            if span["uses"] <= least:
                continue
            a, b = span["from_word"], span["from_word"] + span["n_words"]
            if parts and parts[-1][1] == a:
                parts[-1][1] = b
            else:
                parts.append([a, b])
        return "\n".join(text[found[a][0] : found[b - 1][1]] for a, b in parts)

    return pd.Series([cut(*row) for row in zip(content, spans, repeat)], dtype=object)
