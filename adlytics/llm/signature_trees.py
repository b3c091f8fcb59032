"""Jaccard join of word shingle sets by a forest of signature trees.

Documents with equal sets are one class. Two different sets that link must share one of
the first few tokens of each (the part a set may lose and still link), in any order of
tokens that is the same for all; tokens found in many sets come last in that order. Every
token so shared has a tree over its classes (tokens shared by the very same classes have one
together): leaves hold sets sorted by size, a node the OR of the token bitmaps below it and
their range of sizes. Two nodes are traversed together:
a pair goes when the sizes cannot link, when the bitmaps leave too little possible overlap,
or when both lie in one known component. Surviving pairs are checked on the whole sets.

Hot tokens: members of a token are dealt into blocks of at most ``BLOCK`` sets of about the
same size, and each pair of blocks of neighbouring sizes is a task of its own. Before the
trees, every class is compared with the first members of its tokens (``SPOKES`` of them at
most). Then the trees of tokens with more than ``LEAF`` classes are traversed for a spanning
forest of the pairs they find, fewer pairs than members. So a large group of near copies is
one component when all trees are traversed for every pair left, and needs no pairs among
itself, however its links run.

Texts are split once: what is stored of a set are its size, digest, bitmaps and a few more
tokens than its first ones, from which these follow when the frequent tokens are known. Only
sets of mostly frequent tokens, and those of pairs left to be checked, are made again.

Exact: no link is lost. A shingle is its 64-bit hash; among the shingles of two documents
equal hashes of different shingles are out of the question (1 in 10**13 for 1,000 each).
Sets are equal by a 128-bit digest.

Defined results: text without words, or NULL, has the empty set and links with nothing. A
text shorter than a shingle is one shingle. Rows with equal texts are linked, whatever
their ids; a component is named by its smallest known id. An empty table gives no rows. Only
the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import checkpointed, lower_ascii, rolling_hashes, stored, words
from adlytics.llm.graph import components

#: Longs of a bitmap.
WORDS = 16
#: Sets of a leaf, children of a node, sets of a block.
LEAF, FANOUT, BLOCK = 32, 16, 2048
#: Tokens in more sets than ``HOT_COUNT`` and than ``HOT_SHARE`` of all first tokens come
#: last; there are at most 1 / HOT_SHARE of them, which bounds the broadcast of them.
HOT_COUNT, HOT_SHARE = 32, 1e-6
#: Members of its tokens that a class is first compared with.
SPOKES = 3
#: Tokens of a class that say where else it is met; a pair met there before is not sent again.
KNOWN = 8
#: Pairs a task gathers before it sends them on, each once.
GATHERED = 1 << 20
#: Rows of 8 bytes that may be broadcast to pick texts; beyond, Spark shuffles.
BROADCAST_ROWS = 4_000_000

FEATURES = (
    "doc bigint, row bigint, n bigint, sig binary, first array<bigint>, bitmap array<bigint>,"
    " wide binary"
)


def _row(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id).cast("bigint"), F.coalesce(F.col(text), F.lit("")))


def _tokenised(docs: DataFrame, doc_id: str, text: str, width: int, *keep: str) -> DataFrame:
    """(doc, row, tokens): distinct hashed shingles of each text."""
    content = F.coalesce(F.col(text), F.lit(""))
    whole = F.when(F.size("w") > 0, F.array(F.xxhash64("w"))).otherwise(
        F.array().cast("array<bigint>")
    )
    return (
        docs.select(
            F.col(doc_id).cast("bigint").alias("doc"),
            _row(doc_id, text).alias("row"),
            words(lower_ascii(content)).alias("w"),
            *keep,
        )
        .withColumn("h", rolling_hashes("w", width))
        .select(
            "doc",
            "row",
            F.when(F.size("h") > 0, F.array_distinct("h")).otherwise(whole).alias("t"),
            *keep,
        )
    )


def _first_tokens(n: int, percent: int) -> int:
    """How many tokens a set shares one of with every set it links with."""
    return n - (percent * n + 99) // 100 + 1 if n else 0


def _features(tokenised: DataFrame, percent: int) -> DataFrame:
    """Size, digest, smallest tokens and bitmaps of each set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = batch.column(2).offsets.to_numpy()
            tokens = batch.column(2).values.to_numpy(zero_copy_only=False)
            sizes, sigs, firsts, maps, wides = [], [], [], [], []
            for a, b in zip(bounds[:-1], bounds[1:]):
                own = np.unique(tokens[a:b])
                n = len(own)
                sizes.append(n)
                sigs.append(hashlib.md5(own.tobytes()).digest())
                bits = np.zeros(WORDS, np.uint64)
                if n:
                    bit = (own.view(np.uint64) >> np.uint64(13)) % np.uint64(64 * WORDS)
                    np.bitwise_or.at(
                        bits, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))
                    )
                maps.append(bits.view(np.int64))
                wides.append(_wide(own))
                # A quarter more than the first ones, for those that turn out frequent.
                first = _first_tokens(n, percent)
                firsts.append(own[: first + first // 4 + 16])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(sigs, pa.binary()),
                    pa.array(firsts, pa.list_(pa.int64())),
                    pa.array(maps, pa.list_(pa.int64())),
                    pa.array(wides, pa.binary()),
                ],
                names=["doc", "row", "n", "sig", "first", "bitmap", "wide"],
            )

    return tokenised.mapInArrow(describe, FEATURES)


def _hot_tokens(classes: DataFrame, percent: int) -> np.ndarray:
    """Sorted tokens that are among the smallest ones of many different sets."""
    n = F.col("n")
    first = (n - F.floor((percent * n + 99) / 100) + 1).cast("int")
    entries = classes.select(F.explode(F.slice("first", 1, first)).alias("t"))
    counts = entries.groupBy("t").agg(F.count("*").alias("n")).where(F.col("n") > HOT_COUNT)
    counts = checkpointed(counts)
    total = classes.agg(F.sum(first)).first()[0] or 0
    found = counts.where(F.col("n") > HOT_SHARE * total).select("t").toPandas()["t"]
    return np.sort(found.to_numpy(np.int64))


def _prefixes(
    classes: DataFrame, docs: DataFrame, doc_id: str, text: str, width: int, percent: int, hot: np.ndarray
) -> DataFrame:
    """(cid, n, prefix): the first tokens of each class, frequent ones last."""
    held = classes.sparkSession.sparkContext.broadcast(hot)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = held.value
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            bounds = batch.column(2).offsets.to_numpy()
            tokens = batch.column(2).values.to_numpy(zero_copy_only=False)
            late = np.zeros(len(tokens), bool)
            if len(hot):
                late = hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens
            out = []
            for a, b, n in zip(bounds[:-1], bounds[1:], sizes.tolist()):
                own, frequent = tokens[a:b], late[a:b]
                first = _first_tokens(n, percent)
                cold = own[~frequent][:first]
                if len(cold) < first and b - a == n:
                    cold = np.concatenate([cold, own[frequent]])[:first]
                out.append(cold if len(cold) == first else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))],
                names=["cid", "n", "prefix"],
            )

    schema = "cid bigint, n bigint, prefix array<bigint>"
    found = stored(classes.select("cid", "n", "first").mapInArrow(order, schema))
    lacking = found.where(F.col("prefix").isNull()).join(classes.select("cid", "row"), "cid")
    whole = _sets_of(lacking.select("cid", "row"), docs, doc_id, text, width)
    again = (
        whole.select("cid", F.size("t").cast("bigint").alias("n"), F.sort_array("t").alias("first"))
        .mapInArrow(order, schema)
        .groupBy("cid")
        .agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    )
    return found.where(F.col("prefix").isNotNull()).union(stored(again))


def _sets_of(wanted: DataFrame, docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """(cid, t): whole sets of the classes asked for (cid, row), made from their texts.

    A row that the table holds more than once gives its set as often.
    """
    keys = checkpointed(wanted)
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    picked = docs.select(
        F.col(doc_id).alias("id"), F.col(text).alias("text"), _row(doc_id, text).alias("row")
    ).join(keys, "row")
    return _tokenised(picked, "id", "text", width, "cid").select("cid", "t")


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _bound_fits(a: str, b: str, percent: int) -> Column:
    """Whether the bitmaps of a pair leave enough overlap to link."""

    def outside(x: str, y: str) -> Column:
        bits = F.zip_with(
            f"{x}_bitmap", f"{y}_bitmap", lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))
        )
        return F.aggregate(bits, F.lit(0), lambda acc, n: acc + n)

    n = F.col(f"{a}_n") + F.col(f"{b}_n")
    most = F.least(F.col(f"{a}_n") - outside(a, b), F.col(f"{b}_n") - outside(b, a))
    return (100 + percent) * most >= percent * n


def _tree(order: np.ndarray, n: np.ndarray, bits: np.ndarray, comp: np.ndarray) -> list[dict]:
    """Levels of a tree over sets in the given order, leaves first."""
    levels = []
    excess = n - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    low, high, mask, extra = n[order], n[order], bits[order], excess[order]
    first, last, width = comp[order], comp[order], LEAF
    while True:
        starts = np.arange(0, len(low), width)
        low = np.minimum.reduceat(low, starts)
        high = np.maximum.reduceat(high, starts)
        mask = np.bitwise_or.reduceat(mask, starts, axis=0)
        extra = np.maximum.reduceat(extra, starts)
        first = np.minimum.reduceat(first, starts)
        last = np.maximum.reduceat(last, starts)
        levels.append(
            {"low": low, "high": high, "bits": mask, "extra": extra, "first": first, "last": last}
        )
        if len(low) == 1:
            return levels
        width = FANOUT


def _nodes_fit(x: dict, i: np.ndarray, y: dict, j: np.ndarray, percent: int) -> np.ndarray:
    fit = (100 * x["high"][i] >= percent * y["low"][j]) & (100 * y["high"][j] >= percent * x["low"][i])
    fit &= ~((x["first"][i] == x["last"][i]) & (y["first"][j] == y["last"][j]) & (x["first"][i] == y["first"][j]))
    most = np.bitwise_count(x["bits"][i] & y["bits"][j]).sum(axis=1).astype(np.int64)
    most += np.minimum(x["extra"][i], y["extra"][j])
    return fit & ((100 + percent) * most >= percent * (x["low"][i] + y["low"][j]))


def _children(i: np.ndarray, width: int, total: int) -> tuple[np.ndarray, np.ndarray]:
    first = i * width
    return first, np.minimum(first + width, total)


def _expand(i, j, width, left_total, right_total) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children of each pair of nodes."""
    a, a_end = _children(i, width, left_total)
    b, b_end = _children(j, width, right_total)
    wa, wb = a_end - a, b_end - b
    each = np.repeat(np.arange(len(i)), wa * wb)
    k = np.arange(len(each)) - np.repeat(np.cumsum(wa * wb) - wa * wb, wa * wb)
    return a[each] + k // wb[each], b[each] + k % wb[each]


def _sets_fit(i, j, n, bits, comp, percent) -> np.ndarray:
    """Which pairs of sets may link and are not known to be connected."""
    fit = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (comp[i] != comp[j])
    at = np.flatnonzero(fit)
    i, j = i[at], j[at]
    only_i = np.bitwise_count(bits[i] & ~bits[j]).sum(axis=1).astype(np.int64)
    only_j = np.bitwise_count(bits[j] & ~bits[i]).sum(axis=1).astype(np.int64)
    most = np.minimum(n[i] - only_i, n[j] - only_j)
    return at[(100 + percent) * most >= percent * (n[i] + n[j])]


def tree_pairs(left: np.ndarray, right: np.ndarray | None, n, bits, comp, percent) -> Iterator:
    """Pairs of sets that may link: within ``left``, or between ``left`` and ``right``.

    Both trees are traversed together from their roots; frontiers are cut in slices, so
    memory stays bounded.
    """
    left = left[np.lexsort((comp[left], n[left]))]
    within = right is None
    right = left if within else right[np.lexsort((comp[right], n[right]))]
    x = _tree(left, n, bits, comp)
    y = x if within else _tree(right, n, bits, comp)
    depth = max(len(x), len(y))
    x, y = x + [x[-1]] * (depth - len(x)), y + [y[-1]] * (depth - len(y))

    def descend(level: int, i: np.ndarray, j: np.ndarray) -> Iterator:
        keep = _nodes_fit(x[level], i, y[level], j, percent)
        i, j = i[keep], j[keep]
        if level:
            below = (len(x[level - 1]["low"]), len(y[level - 1]["low"]))
            same_x, same_y = x[level] is x[level - 1], y[level] is y[level - 1]
            for a in range(0, len(i), 4096 // FANOUT):
                p, q = i[a : a + 4096 // FANOUT], j[a : a + 4096 // FANOUT]
                if same_x or same_y:
                    fan = FANOUT
                    ci = [p] if same_x else [np.minimum(p * fan + k, below[0]) for k in range(fan)]
                    cj = [q] if same_y else [np.minimum(q * fan + k, below[1]) for k in range(fan)]
                    p = np.concatenate([u for u in ci for _ in cj])
                    q = np.concatenate([v for _ in ci for v in cj])
                    real = (p < below[0]) & (q < below[1])
                    p, q = p[real], q[real]
                else:
                    p, q = _expand(p, q, FANOUT, *below)
                if within:
                    p, q = p[p <= q], q[p <= q]
                yield from descend(level - 1, p, q)
            return
        for a in range(0, len(i), 64):
            p, q = _expand(i[a : a + 64], j[a : a + 64], LEAF, len(left), len(right))
            if within:
                p, q = p[p < q], q[p < q]
            p, q = left[p], right[q]
            at = _sets_fit(p, q, n, bits, comp, percent)
            if len(at):
                yield p[at], q[at]

    yield from descend(depth - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Where a row's keys differ from those of the row before."""
    fresh = np.ones(len(keys[0]), bool)
    fresh[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
    return fresh


def _first_meetings(table: pa.Table):
    """A function that says which pairs of rows share no smaller token than the one here.

    Each row carries the smallest ``KNOWN`` tokens its class is met at. Two classes that
    share a token are thus sent once, where the smallest such token is among them, and
    never left out.
    """
    token = table.column("token").to_numpy()
    lists = table.column("known").combine_chunks()
    bounds = lists.offsets.to_numpy()
    bounds, values = bounds - bounds[0], lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(token)), np.diff(bounds))
    below = values < token[row]
    bit = np.uint64(1) << ((values.view(np.uint64) >> np.uint64(20)) & np.uint64(63))
    masks = np.zeros(len(token), np.uint64)
    np.bitwise_or.at(masks, row[below], bit[below])
    sets: dict[int, frozenset] = {}

    def smaller(i: int) -> frozenset:
        if i not in sets:
            own = slice(bounds[i], bounds[i + 1])
            sets[i] = frozenset(values[own][below[own]].tolist())
        return sets[i]

    def new(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        keep = (masks[p] & masks[q]) == 0
        for at in np.flatnonzero(~keep).tolist():
            keep[at] = smaller(int(p[at])).isdisjoint(smaller(int(q[at])))
        return np.flatnonzero(keep)

    return new


def _groups(fresh: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Numbers 0, 1, ... for the components of each task; ``fresh`` marks where tasks start."""
    task = np.cumsum(fresh)
    order = np.lexsort((comp, task))
    groups = np.empty(len(comp), np.int64)
    groups[order] = np.cumsum(_changes(task[order], comp[order])) - 1
    return groups


def _joining(groups: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Which pairs of rows join two groups that none before has; ``groups`` takes the joins in."""
    a, b = groups[p], groups[q]
    apart = np.flatnonzero(a != b)
    kept: list[int] = []
    up: dict[int, int] = {}
    for k, x, y in zip(apart.tolist(), a[apart].tolist(), b[apart].tolist()):
        while x in up:
            x = up[x]
        while y in up:
            y = up[y]
        if x != y:
            up[max(x, y)] = min(x, y)
            kept.append(k)
    if up:
        names = np.arange(int(groups.max()) + 1)
        for x in sorted(up):
            names[x] = names[up[x]]
        groups[:] = names[groups]
    return np.array(kept, np.int64)


def _traverse(percent: int, forest: bool = False):
    """Streams tasks sorted by key; each is one tree, or two trees traversed together.

    ``forest`` sends of the pairs of a task a spanning forest only.
    """

    def leaves(starts, sizes, n, bits, comp):
        """Pairs of tasks with a single leaf, many tasks at once."""
        for m in np.unique(sizes):
            i, j = np.triu_indices(m, 1)
            own = starts[sizes == m]
            step = max(1, 200_000 // len(i))
            for a in range(0, len(own), step):
                p = (own[a : a + step, None] + i).ravel()
                q = (own[a : a + step, None] + j).ravel()
                at = _sets_fit(p, q, n, bits, comp, percent)
                if len(at):
                    yield p[at], q[at]

    def pairs(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        fresh = _changes(table.column("token").to_numpy(), table.column("block").to_numpy())
        side = table.column("side").to_numpy()
        n = table.column("n").to_numpy()
        comp = table.column("comp").to_numpy()
        flat = table.column("bitmap").combine_chunks().flatten().to_numpy()
        bits = flat.view(np.uint64).reshape(-1, WORDS)
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.concatenate([starts, [len(fresh)]]))
        new = _first_meetings(table)
        if forest:
            comp = _groups(fresh, comp)
        for p, q in found(starts, sizes, side, n, comp, bits):
            at = new(p, q)
            if forest:
                at = at[_joining(comp, p[at], q[at])]
            if len(at):
                yield p[at], q[at]

    def found(starts, sizes, side, n, comp, bits) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        two = np.maximum.reduceat(side, starts) > 0
        small = (sizes <= LEAF) & ~two
        yield from leaves(starts[small & (sizes > 1)], sizes[small & (sizes > 1)], n, bits, comp)
        for start, size, both in zip(starts[~small], sizes[~small], two[~small]):
            rows = np.arange(start, start + size)
            if both:
                left, right = rows[side[rows] == 0], rows[side[rows] == 1]
                if len(left) and len(right):
                    yield from tree_pairs(left, right, n, bits, comp, percent)
            else:
                yield from tree_pairs(rows, None, n, bits, comp, percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        gathered: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def send() -> pa.RecordBatch:
            a, b = (np.concatenate(part) for part in zip(*gathered))
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            fresh = _changes(a, b)
            return pa.RecordBatch.from_arrays([pa.array(a[fresh]), pa.array(b[fresh])], names=["a", "b"])

        def whole_tasks() -> Iterator[pa.Table]:
            nonlocal held, last
            for batch in batches:
                if not batch.num_rows:
                    continue
                token, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                cut = int(np.flatnonzero(_changes(token, block))[-1])
                if cut == 0 and held and last == (token[0], block[0]):
                    held.append(batch)
                    continue
                last = (token[-1], block[-1])
                # Everything before the last key of this batch is whole.
                yield pa.Table.from_batches([*held, batch.slice(0, cut)])
                held = [batch.slice(cut)]
            if held:
                yield pa.Table.from_batches(held)

        for table in whole_tasks():
            if not table.num_rows:
                continue
            cid = table.column("cid").to_numpy()
            for p, q in pairs(table):
                a, b = cid[p], cid[q]
                gathered.append((np.minimum(a, b), np.maximum(a, b)))
                waiting += len(a)
                if waiting >= GATHERED:
                    yield send()
                    gathered, waiting = [], 0
        if gathered:
            yield send()

    return run


def _wide(own: np.ndarray) -> bytes:
    """Size and bitmap of a set, with four to eight bits for each token."""
    width = 1 << max(0, (8 * len(own)).bit_length() - 7)
    bit = (own.view(np.uint64) >> np.uint64(7)) % np.uint64(64 * width)
    bits = np.zeros(width * 8, np.uint8)
    at = (bit >> np.uint64(3)).astype(np.int64)
    np.bitwise_or.at(bits, at, np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
    return np.int64(len(own)).tobytes() + bits.tobytes()


def _wide_may_link(x: pa.Buffer, y: pa.Buffer, percent: int) -> bool:
    n, m = (int(np.frombuffer(b, np.int64, 1)[0]) for b in (x, y))
    a, b = np.frombuffer(x, np.uint64, offset=8), np.frombuffer(y, np.uint64, offset=8)
    width = min(len(a), len(b))
    # A bitmap twice as wide folds onto the narrower one.
    a, b = (np.bitwise_or.reduce(z.reshape(-1, width), axis=0) for z in (a, b))
    only_a, only_b = int(np.bitwise_count(a & ~b).sum()), int(np.bitwise_count(b & ~a).sum())
    return (100 + percent) * min(n - only_a, m - only_b) >= percent * (n + m)


def _links(x: pa.Buffer, y: pa.Buffer, percent: int) -> bool:
    left, right = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * shared >= percent * (len(left) + len(right) - shared)


def _tested(pairs: DataFrame, sets: DataFrame, test) -> DataFrame:
    """Pairs (a, b) of classes that pass a test on what ``sets`` (cid, own) holds of them."""
    sets = sets.groupBy("cid").agg(F.first("own").alias("own"))
    both = pairs.join(sets.select(F.col("cid").alias("a"), F.col("own").alias("a_own")), "a").join(
        sets.select(F.col("cid").alias("b"), F.col("own").alias("b_own")), "b"
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = zip(batch.column(2), batch.column(3))
            keep = [test(x.as_buffer(), y.as_buffer()) for x, y in own]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    found = both.select("a", "b", "a_own", "b_own").mapInArrow(check, "a bigint, b bigint")
    return checkpointed(found)


def _wanted(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    both = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    return both.join(classes.select("cid", "row"), "cid")


def _checked(
    pairs: DataFrame,
    classes: DataFrame,
    sets: DataFrame,
    docs: DataFrame,
    doc_id: str,
    text: str,
    width: int,
    percent: int,
) -> DataFrame:
    """Pairs (a, b) of classes whose sets really link.

    Wide bitmaps, stored with the sets, come first: few pairs are left for whole sets.
    """
    pairs = checkpointed(pairs)
    keys = checkpointed(_wanted(pairs, classes))
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    wide = sets.select("row", F.col("wide").alias("own")).join(keys, "row").select("cid", "own")
    near = _tested(pairs, wide, lambda x, y: _wide_may_link(x, y, percent))

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = batch.column(1).offsets.to_numpy()
            tokens = batch.column(1).values.to_numpy(zero_copy_only=False)
            own = [np.sort(tokens[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.binary())], names=["cid", "own"]
            )

    whole = _sets_of(_wanted(near, classes), docs, doc_id, text, width)
    whole = whole.mapInArrow(sort, "cid bigint, own binary")
    return _tested(near, whole, lambda x, y: _links(x, y, percent))


def _tasks(members: DataFrame, percent: int) -> DataFrame:
    """(token, block, side, cid, n, comp): members dealt to tasks of at most two blocks."""
    columns = ["token", "block", "side", "cid", "n", "comp"]
    small = (
        members.where(F.col("size") <= BLOCK)
        .withColumn("block", F.lit(0).cast("bigint"))
        .withColumn("side", F.lit(0))
        .select(columns)
    )
    band = F.floor(F.log("n") / math.log(100 / percent)).cast("int")
    large = members.where(F.col("size") > BLOCK).withColumn("band", band)
    bands = large.groupBy("token", "band").agg(F.count("*").alias("held"))
    salts = F.ceil(F.col("held") / BLOCK).cast("int")
    dealt = large.join(bands.select("token", "band", salts.alias("salts")), ["token", "band"])
    dealt = dealt.withColumn("salt", F.pmod(F.xxhash64("cid"), F.col("salts")).cast("int"))
    blocks = checkpointed(
        bands.select("token", "band", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    )
    # Sizes that link differ by one band at most.
    other = blocks.select(
        "token",
        F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"),
        F.col("band").alias("band2"),
        F.col("salt").alias("salt2"),
    )
    pairs = blocks.join(other, ["token", "band"]).where(
        (F.col("band") != F.col("band2")) | (F.col("salt") <= F.col("salt2"))
    )
    pairs = checkpointed(
        pairs.withColumn("block", F.xxhash64("band", "salt", "band2", "salt2"))
    )
    left = pairs.select("token", "band", "salt", "block", F.lit(0).alias("side"))
    right = pairs.where(
        (F.col("band") != F.col("band2")) | (F.col("salt") != F.col("salt2"))
    ).select(
        "token",
        F.col("band2").alias("band"),
        F.col("salt2").alias("salt"),
        "block",
        F.lit(1).alias("side"),
    )
    big = dealt.join(left.union(right), ["token", "band", "salt"])
    return small.union(big.select(columns))


def similar_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """(doc, row, n_shingles, component_id, keeper) of every document.

    ``row`` is the hash of id and text; ``keeper`` says whether the row is the first (by id,
    then hash) of its component, which holds for all rows with empty sets.
    """
    sets = stored(_features(_tokenised(docs, doc_id, text, width), percent))
    classes = stored(
        sets.where("n > 0")
        .groupBy("sig")
        .agg(
            F.min(F.struct(F.col("doc").isNull().alias("unknown"), "doc", "row")).alias("rep"),
            F.first("n").alias("n"),
            F.first("first").alias("first"),
            F.first("bitmap").alias("bitmap"),
        )
        .select("sig", "n", "first", "bitmap", "rep.doc", "rep.row")
        .withColumn("cid", F.monotonically_increasing_id())
    )
    how = (docs, doc_id, text, width, percent)
    prefixes = _prefixes(classes, *how, _hot_tokens(classes, percent))
    entries = prefixes.select("cid", "n", F.explode("prefix").alias("token"))
    shared = (
        entries.groupBy("token")
        .agg(
            F.count("*").alias("size"),
            F.min(F.struct("cid", "n")).alias("hub"),
            F.bit_xor(F.xxhash64("cid")).alias("these"),
            F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("those"),
        )
        .where("size > 1")
        # Of tokens shared by the very same classes one is enough.
        .groupBy("size", "hub", "these", "those")
        .agg(F.min("token").alias("token"))
    )
    members = stored(
        entries.join(shared, "token").select(
            "token", "cid", "n", "size", F.col("hub.cid").alias("hub"), F.col("hub.n").alias("hub_n")
        )
    )
    maps = {
        side: classes.select(
            F.col("cid").alias(side), F.col("n").alias(f"{side}_n"), F.col("bitmap").alias(f"{side}_bitmap")
        )
        for side in "ab"
    }
    spokes = (
        members.where((F.col("cid") != F.col("hub")) & _sizes_fit(F.col("n"), F.col("hub_n"), percent))
        .groupBy(F.col("cid").alias("b"))
        .agg(F.slice(F.sort_array(F.collect_set("hub")), 1, SPOKES).alias("hubs"))
        .select(F.explode("hubs").alias("a"), "b")
        .join(maps["a"], "a")
        .join(maps["b"], "b")
        .where(_bound_fits("a", "b", percent))
        .select("a", "b")
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def candidates(members: DataFrame, links: DataFrame, forest: bool) -> DataFrame:
        """Pairs (a, b) of classes that ``links`` does not connect and that may link."""
        placed = members.join(components(links), F.col("cid") == F.col("node"), "left").select(
            "token", "cid", "n", "size", F.coalesce("root", "cid").alias("comp")
        )
        mixed = (
            placed.groupBy("token")
            .agg(F.min("comp").alias("least"), F.max("comp").alias("most"))
            .where(F.col("least") < F.col("most"))
            .select("token")
        )
        placed = checkpointed(placed.join(mixed, "token"))
        known = placed.groupBy("cid").agg(
            F.slice(F.sort_array(F.collect_list("token")), 1, KNOWN).alias("known")
        )
        return (
            _tasks(placed, percent)
            .join(classes.select("cid", "bitmap").join(known, "cid"), "cid")
            .select("token", "block", "side", "cid", "n", "comp", "bitmap", "known")
            .repartition(parts, "token", "block")
            .sortWithinPartitions("token", "block", "side")
            .mapInArrow(_traverse(percent, forest), "a bigint, b bigint")
            .distinct()
        )

    links = _checked(spokes, classes, sets, *how)
    # Tokens of few classes give few pairs each: they need no forest.
    trees = candidates(members.where(F.col("size") > LEAF), links, True)
    links = links.union(_checked(trees, classes, sets, *how))
    links = links.union(_checked(candidates(members, links, False), classes, sets, *how))
    final = components(links)

    named = classes.join(final, F.col("cid") == F.col("node"), "left").select(
        "sig", "doc", "row", F.coalesce("root", "cid").alias("root")
    )
    firsts = named.groupBy("root").agg(
        F.min(F.struct(F.col("doc").isNull().alias("unknown"), "doc", "row")).alias("first")
    )
    by_class = named.join(firsts, "root").select(
        "sig", F.col("first.doc").alias("component_id"), F.col("first.row").alias("first_row")
    )
    return sets.select("doc", "row", "n", "sig").join(by_class, "sig", "left").select(
        "doc",
        "row",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc")).otherwise(F.col("component_id")).alias("component_id"),
        ((F.col("n") == 0) | (F.col("row") == F.col("first_row"))).alias("keeper"),
    )
