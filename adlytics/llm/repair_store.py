"""Token files compressed by a Re-Pair grammar, with random access to documents.

Documents are range-partitioned by id. A partition is written as shards of about
``SHARD_TOKENS`` tokens, one row of a Parquet file each: the rules of a grammar of its own,
the expansion length of each rule, and the sequence of ids and nonterminals, document by
document. In each round frequent pairs of neighbours in a document become nonterminals, and
each rule has ``LEAST_USES`` uses when it is made. Rounds end when no pair has ``MIN_COUNT``
places that do not overlap.

A document is read back from its shard alone: the documents' symbol counts say where its
symbols are, and expansion lengths how many tokens a symbol stands for.

A shard's start among all tokens needs only the totals of the partitions (one row each).
Tasks hold one shard at a time, or one document if that is longer.

Defined results: NULL text is empty and gives the end token alone; NULL ids sort first;
rows with equal ids stay next to each other, each with its own tokens; an empty table gives
an empty file. Only the named columns are read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlytics.llm.common import shared_folder
from adlytics.llm.tokens import encode_column, tokenizer

SHARD_TOKENS = 1 << 20
#: Nonterminals are numbered from here, above any vocabulary of the library's files.
FIRST_RULE = 1 << 17
MIN_COUNT = 16
#: A rule is stored as two symbols and a length; with fewer uses it would not pay.
LEAST_USES = 4
#: As many as the 20 bits that ``_bucket`` gives.
_BUCKETS = 1 << 20

SHARDS = (
    "part bigint, shard bigint, first_token bigint, n_tokens bigint, doc_ids binary, known binary,"
    " doc_tokens binary, doc_symbols binary, rules binary, expansions binary, low binary,"
    " high binary"
)


def _every_other(at: np.ndarray, kind: np.ndarray | None, after: np.ndarray) -> np.ndarray:
    """Marks the first, third, ... of each run of neighbouring places of one kind, or of any."""
    same = np.arange(len(at) - 1) if kind is None else np.flatnonzero(kind[1:] == kind[:-1])
    # Places that continue a run; those of one run follow each other.
    same = same[after[at[same]] == at[same + 1]] + 1
    fresh = np.ones(len(same), bool)
    fresh[1:] = same[1:] != same[:-1] + 1
    marks = np.ones(len(at), bool)
    marks[same[(same - np.maximum.accumulate(np.where(fresh, same, 0))) % 2 == 0]] = False
    return marks


def _frequent(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs with at least ``MIN_COUNT`` places, ascending, and their counts."""
    ordered = np.sort(pairs)
    ends = np.append(np.flatnonzero(ordered[1:] != ordered[:-1]), len(ordered) - 1) + 1
    counts = np.diff(ends, prepend=0)
    often = counts >= MIN_COUNT
    return ordered[ends[often] - 1], counts[often]


def _find(kinds: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The place of each pair among the ascending ``kinds``, -1 for those not there."""
    table = np.full(_BUCKETS, -1, np.int32)
    bucket = _bucket(kinds)
    table[bucket] = np.arange(len(kinds))
    found = table[_bucket(pairs)]
    missed = (found >= 0) & (kinds[found] != pairs)
    # Kinds whose bucket another one took are few; they are looked up by value.
    rest = np.flatnonzero(table[bucket] != np.arange(len(kinds)))
    shared = np.zeros(_BUCKETS, bool)
    shared[bucket[rest]] = True
    other = np.flatnonzero(missed)
    other = other[shared[_bucket(pairs[other])]]
    found[missed] = -1
    if len(other):
        place = np.minimum(np.searchsorted(kinds[rest], pairs[other]), len(rest) - 1)
        found[other] = np.where(kinds[rest][place] == pairs[other], rest[place], -1)
    return found


def _bucket(pairs: np.ndarray) -> np.ndarray:
    # The highest bits of the product: both symbols of a pair reach them.
    return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


def compress(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, their ends by document and the rules (left, right) of one shard.

    A replaced pair keeps its first place; the second one is unlinked. A pair's count only
    falls, other than of pairs with a new nonterminal. So a round looks at the places next
    to those and at the pairs that were frequent already, and never at the others again.
    """
    n = len(ids)
    symbols = np.append(ids, 0).astype(np.int64)
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    # Place n stands for the end of every document, from either side.
    filled = np.diff(ends, prepend=0) > 0
    last = ends[filled] - 1
    first = np.concatenate([[0], last + 1])[:-1] if len(last) else last
    after[last], before[first], after[n], before[n] = n, n, n, n
    stays = np.ones(n, bool)
    rules = np.empty((0, 2), np.int64)
    at = np.flatnonzero(after[:n] != n)
    while len(at):
        pair = (symbols[at] << 32) | symbols[after[at]]
        # A pair of equal symbols overlaps itself: every other one counts, from the left.
        own = _every_other(at, pair, after)
        kinds, counts = _frequent(pair[own])
        if not len(kinds):
            break
        inverse = _find(kinds, pair)
        # Those that may still be replaced in a later round.
        waiting = at[inverse >= 0]
        own &= inverse >= 0
        at, inverse = at[own], inverse[own]
        # Of overlapping pairs every other one is replaced, from the left of each run.
        wins = _every_other(at, None, after)
        used = np.bincount(inverse[wins], minlength=len(kinds)) >= LEAST_USES
        if not used.any():
            # None is left enough: the more frequent one is replaced, the most frequent always.
            rank = np.empty(len(kinds), np.int64)
            rank[np.argsort(counts, kind="stable")] = np.arange(len(kinds))
            beside = np.concatenate([[-1], rank[inverse], [-1]])
            touch = np.concatenate([[False], after[at[:-1]] == at[1:], [False]])
            wins = ~(touch[:-1] & (beside[:-2] > beside[1:-1]))
            wins &= ~(touch[1:] & (beside[2:] > beside[1:-1]))
            used = np.bincount(inverse[wins], minlength=len(kinds)) >= LEAST_USES
        at, inverse = at[wins], inverse[wins]
        at, inverse = at[used[inverse]], inverse[used[inverse]]
        number = np.cumsum(used) - 1 + FIRST_RULE + len(rules)
        rules = np.concatenate(
            [rules, np.stack([kinds[used] >> 32, kinds[used] & 0xFFFFFFFF], axis=1)]
        )
        symbols[at] = number[inverse]
        gone = after[at]
        stays[gone] = False
        after[at] = after[gone]
        before[after[at]] = at
        after[n], before[n] = n, n
        # A place may be next to two new symbols and wait as well.
        marked = np.zeros(n + 1, bool)
        marked[waiting] = marked[at] = marked[before[at]] = True
        marked[gone] = marked[n] = False
        at = np.flatnonzero(marked)
        at = at[after[at] != n]
    kept = np.concatenate([[0], np.cumsum(stays)])
    return symbols[:n][stays], kept[ends], rules


def expansion_lengths(rules: np.ndarray) -> np.ndarray:
    """Number of ids each rule stands for; a rule only uses earlier ones."""
    lengths: list[int] = []
    for left, right in rules.tolist():
        a = lengths[left - FIRST_RULE] if left >= FIRST_RULE else 1
        b = lengths[right - FIRST_RULE] if right >= FIRST_RULE else 1
        lengths.append(a + b)
    return np.array(lengths, np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """The ids that symbols stand for."""
    symbols = symbols.astype(np.int64)
    while True:
        rule = symbols >= FIRST_RULE
        if not rule.any():
            return symbols.astype("<u4")
        width = 1 + rule
        start = np.cumsum(width) - width
        longer = np.repeat(symbols, width)
        used = rules[symbols[rule] - FIRST_RULE]
        longer[start[rule]], longer[start[rule] + 1] = used[:, 0], used[:, 1]
        symbols = longer


def _bytes(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values.astype(kind)).tobytes()


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Writes the token file at ``path``, documents by ascending id."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = tokenizer(tokenizer_path)
        keys: list = []
        tokens: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = shard = first_token = 0

        def flush() -> pa.RecordBatch:
            ids, ends = np.concatenate(tokens), np.cumsum(np.concatenate(sizes))
            symbols, symbol_ends, rules = compress(ids, ends)
            columns = {
                "part": part,
                "shard": shard,
                "first_token": first_token,
                "n_tokens": len(ids),
                "doc_ids": _bytes(np.array([k or 0 for k in keys], np.int64), "<i8"),
                "known": _bytes(np.array([k is not None for k in keys]), "u1"),
                "doc_tokens": _bytes(np.diff(ends, prepend=0), "<i8"),
                "doc_symbols": _bytes(np.diff(symbol_ends, prepend=0), "<i8"),
                "rules": _bytes(rules, "<u4"),
                "expansions": _bytes(expansion_lengths(rules), "<u4"),
                "low": _bytes(symbols & 0xFFFF, "<u2"),
                "high": _bytes(symbols >> 16, "u1"),
            }
            return pa.RecordBatch.from_pylist([columns], schema=_arrow_schema())

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, end, ids, ends in encode_column(encoder, batch.column(1)):
                ids = np.insert(ids, ends, end_id)
                ends = ends + np.arange(1, len(ends) + 1)
                row = done = 0
                # A shard ends with the document that fills it.
                while row < end - first:
                    full = np.searchsorted(ends, done + shard_tokens - held)
                    stop = min(int(full) + 1, end - first)
                    keys += names[first + row : first + stop]
                    tokens.append(ids[done : ends[stop - 1]])
                    sizes.append(np.diff(ends[row:stop], prepend=done))
                    held += int(ends[stop - 1]) - done
                    row, done = stop, int(ends[stop - 1])
                    if held >= shard_tokens:
                        yield flush()
                        first_token, shard = first_token + held, shard + 1
                        keys, tokens, sizes, held = [], [], [], 0
        if tokens:
            yield flush()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.select(F.col(doc_id).cast("bigint").alias("k"), F.col(text).alias("t"))
        .repartitionByRange(parts, F.col("k"), F.xxhash64("t"))
        .sortWithinPartitions("k", F.xxhash64("t"))
        .mapInArrow(shards, SHARDS)
        .write.parquet(path)
    )


def _arrow_schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    fields = (field.split() for field in SHARDS.split(","))
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


class Shard:
    """One shard of a token file, for random access."""

    def __init__(self, row: dict) -> None:
        self.doc_ids = [
            int(k) if known else None
            for k, known in zip(
                np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["known"], "u1")
            )
        ]
        self.doc_tokens = np.frombuffer(row["doc_tokens"], "<i8")
        self.symbol_ends = np.cumsum(np.frombuffer(row["doc_symbols"], "<i8"))
        self.rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2).astype(np.int64)
        self.expansions = np.frombuffer(row["expansions"], "<u4")
        self.symbols = np.frombuffer(row["low"], "<u2").astype(np.int64) | (
            np.frombuffer(row["high"], "u1").astype(np.int64) << 16
        )

    def document(self, place: int) -> np.ndarray:
        """The ids of one document, decoding nothing else."""
        begin = self.symbol_ends[place - 1] if place else 0
        return expand(self.symbols[begin : self.symbol_ends[place]], self.rules)

    def tokens(self) -> np.ndarray:
        """The ids of all documents, one after the other.

        Each rule is expanded once and copied to where it stands, unless the expansions
        together are longer than the documents.
        """
        if int(self.expansions.sum(dtype=np.int64)) > int(self.doc_tokens.sum()):
            return expand(self.symbols, self.rules)
        rules = expand(np.arange(len(self.rules)) + FIRST_RULE, self.rules)
        # A symbol that is an id is a copy of itself, kept behind the rules' expansions.
        rule = self.symbols >= FIRST_RULE
        of = self.symbols[rule] - FIRST_RULE
        widths = self.expansions.astype(np.int64)
        length, begin = np.ones(len(rule), np.int64), np.empty(len(rule), np.int64)
        length[rule], begin[rule] = widths[of], (np.cumsum(widths) - widths)[of]
        begin[~rule] = len(rules) + np.arange(len(rule) - len(of))
        known = np.concatenate([rules, self.symbols[~rule].astype("<u4")])
        stops = np.cumsum(length)
        return known[np.repeat(begin - stops + length, length) + np.arange(self.doc_tokens.sum())]

    def token(self, place: int, at: int) -> int:
        """One id of one document: skips symbols by their expansion lengths."""
        begin = self.symbol_ends[place - 1] if place else 0
        own = self.symbols[begin : self.symbol_ends[place]]
        rule = own >= FIRST_RULE
        lengths = np.ones(len(own), np.int64)
        lengths[rule] = self.expansions[own[rule] - FIRST_RULE]
        stops = np.cumsum(lengths)
        which = int(np.searchsorted(stops, at, "right"))
        symbol, at = int(own[which]), at - int(stops[which] - lengths[which])
        while symbol >= FIRST_RULE:
            left, right = (int(x) for x in self.rules[symbol - FIRST_RULE])
            width = int(self.expansions[left - FIRST_RULE]) if left >= FIRST_RULE else 1
            symbol, at = (left, at) if at < width else (right, at - width)
        return symbol


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the file."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, start = Shard(row), row["__start"] + row["first_token"]
                starts = start + np.cumsum(shard.doc_tokens) - shard.doc_tokens
                raw = memoryview(shard.tokens()).cast("B")
                bounds = (4 * np.cumsum(shard.doc_tokens)).tolist()
                crc = [zlib.crc32(raw[a:b]) for a, b in zip([0, *bounds], bounds)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(shard.doc_tokens, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    rows = spark.read.schema(SHARDS).parquet(path)
    # One row per partition of the writing job.
    totals, starts = 0, []
    for part in rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        starts.append((part["part"], totals))
        totals += part["n"]
    offsets = spark.createDataFrame(starts, "part bigint, __start bigint")
    return rows.join(F.broadcast(offsets), "part").mapInArrow(
        decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def fresh_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/token-files/{uuid.uuid4().hex}"
