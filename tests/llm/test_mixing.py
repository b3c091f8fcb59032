"""Mixing: targets, permutations, draws and the words each document gives."""

from __future__ import annotations

import random
from collections import Counter

import brute
import numpy as np
import pytest

from adlytics.llm import mixing


def shares(sizes, weights, cap):
    """Water level by bisection: every source gives min(cap, weight * level)."""
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        given = sum(min(cap * s, w * mid) for s, w in zip(sizes, weights))
        low, high = (mid, high) if given < sum(sizes) else (low, mid)
    return [min(cap * s, w * low) for s, w in zip(sizes, weights)]


@pytest.mark.parametrize("seed", range(20))
def test_targets_reshare_the_excess(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 10, 500, 100_000]) for _ in range(rng.randint(1, 12))]
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, weights, 3)
    assert got == pytest.approx(shares(sizes, weights, 3), rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutations_hit_every_index_once(n):
    got = mixing.permuted(np.arange(n), n, "k")
    assert sorted(got.tolist()) == list(range(n))
    assert (got == mixing.permuted(np.arange(n), n, "k")).all()


def test_shard_draws_meet_the_totals():
    slots = np.array([1000, 0, 37, 512, 3])
    shards = -(-int(slots.sum()) // 64)
    drawn = [mixing.shard_draw(slots, 64, i, 7) for i in range(shards)]
    seen = Counter((s, o) for own in drawn for s, o in zip(*(x.tolist() for x in own)))
    # Every slot of every source is dealt once.
    assert seen == Counter((i, o) for i, n in enumerate(slots) for o in range(n))
    assert [len(s) for s, _ in drawn] == [64] * (shards - 1) + [int(slots.sum()) % 64 or 64]
    assert len({tuple(np.bincount(s, minlength=5)) for s, _ in drawn}) > 5
    again = mixing.shard_draw(slots, 64, 3, 7)
    assert all((a == b).all() for a, b in zip(drawn[3], again))
    assert not all((a == b).all() for a, b in zip(again, mixing.shard_draw(slots, 64, 3, 8)))


@pytest.mark.parametrize("scale", [10**3, 10**8, 10**9 + 7, 10**12, 10**17])
def test_draws_follow_one_law_at_every_size(scale):
    """Counts of 1,024 slots: mean and spread of draws without replacement."""
    slots = np.array([6, 3, 1]) * scale
    total, shards = int(slots.sum()), 300
    step = max(1, total // 1024 // shards)
    counts = np.array(
        [
            np.bincount(mixing.shard_draw(slots, 1024, i * step, 11)[0], minlength=3)
            for i in range(min(shards, total // 1024))
        ]
    )
    share = slots / total
    left = (total - 1024) / (total - 1)
    spread = np.sqrt(1024 * share * (1 - share) * left)
    assert (np.abs(counts.mean(axis=0) - 1024 * share) < 5 * spread / np.sqrt(len(counts)) + 1e-9).all()
    if len(counts) > 100:
        assert (np.abs(counts.std(axis=0) / spread - 1) < 0.25).all()


@pytest.mark.parametrize("source", ["plain", "awkward", "empty"])
def test_mixed_words(source, documents, awkward, empty):
    df = {"plain": documents, "awkward": awkward, "empty": empty}[source]
    mixed, sized, entries = mixing.mix(df, block_words=16, shard_slots=50)
    rows = [(r.doc_id, r.source, r.text) for r in df.collect()]
    sizes = {}
    for _, src, text in rows:
        sizes[src] = sizes.get(src, 0) + len(brute.WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    assert [(e["source"], e["size"], e["weight"]) for e in entries] == [
        (s, sizes[s], (5, 2, 1)[i % 3]) for i, s in enumerate(order)
    ]
    got = mixing.taken_words(mixed, sized, entries).collect()
    assert Counter((r.doc, r.size) for r in got) == Counter(
        (d, len(brute.WORD.findall(t or ""))) for d, _, t in rows
    )
    assert all(r.taken <= 3 * r.size for r in got)
    parts = mixed.collect()
    per_slot = Counter()
    for r in parts:
        per_slot[r.shard, r.slot] += r.n_words
    assert all(n <= 16 for n in per_slot.values())
    taken = Counter()
    for r in parts:
        taken[r.source_no] += r.n_words
    for i, e in enumerate(entries):
        assert abs(taken[i] - e["target"]) <= 16 + 0.02 * e["target"]
    again, *_ = mixing.mix(df, block_words=16, shard_slots=50)
    key = lambda r: (r.shard, r.slot, r.source_no, r.block, r.from_word, r.n_words)
    assert Counter(map(key, parts)) == Counter(map(key, again.collect()))


@pytest.mark.parametrize("source", ["plain", "awkward", "empty"])
def test_mixed_documents_hold_the_taken_words(source, documents, awkward, empty):
    df = {"plain": documents, "awkward": awkward, "empty": empty}[source]
    mixed, sized, entries = mixing.mix(df, block_words=16)
    want = Counter()
    for r in mixing.taken_words(mixed, sized, entries).collect():
        want[r.doc] += r.taken
    got, texts = Counter(), {}
    for r in df.collect():
        texts.setdefault(r.doc_id, []).append(brute.WORD.findall(r.text or ""))
    for r in mixing.mixed_documents(df, block_words=16).collect():
        own = brute.WORD.findall(r.mixed_text)
        got[r["__doc"].doc_id] += len(own)
        assert own and any(set(own) <= set(t) for t in texts[r["__doc"].doc_id])
    assert got == Counter({k: v for k, v in want.items() if v})
