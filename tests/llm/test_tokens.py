"""Token helper, packing and token files: exact ids, exact best fit, exact round trips."""

from __future__ import annotations

import random
import subprocess
import sys
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adlytics.llm import best_fit, repair_store, tokens

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ENCODERS = {path: tokens.tokenizer(path) for path in (BYTES, WORDS)}
ODD = st.text(alphabet=".,<>|_'s \t\n\x0b\x1c\u0085  　aB'sé́ñ9,|", max_size=40)


def encoded(path, texts):
    out = []
    for _, _, ids, ends in tokens.encode_column(ENCODERS[path], pa.array(texts, pa.string())):
        out += np.split(ids, ends[:-1])
    return [x.tolist() for x in out]


def direct(path, texts):
    return [ENCODERS[path].tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), ODD, st.text(max_size=30)), min_size=1, max_size=6))
def test_units_encode_as_whole_texts(texts):
    for path in ENCODERS:
        assert encoded(path, texts) == direct(path, texts)


def test_real_texts_encode_alike(pairs, monkeypatch):
    texts = [t for _, t in pairs[:150]] + ["a <|endoftext|> b", "x <|startoftext|>y", ""]
    for size in (1 << 22, 5000):
        monkeypatch.setattr(tokens, "CHUNK_BYTES", size)
        for path in ENCODERS:
            assert encoded(path, texts) == direct(path, texts)


def test_units_that_give_way_are_encoded_anew(pairs, monkeypatch):
    texts = [t for _, t in pairs[:200]]
    monkeypatch.setattr(tokens, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(tokens, "REMEMBERED", 1500)
    encoder = tokens.Encoder(BYTES)
    got = []
    for _, _, ids, ends in tokens.encode_column(encoder, pa.array(texts, pa.string())):
        got += [x.tolist() for x in np.split(ids, ends[:-1])]
    assert got == direct(BYTES, texts)
    assert len(encoder.known) == len(encoder.sizes) == len(encoder.seen)


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, whole):
        self.whole, self.texts = whole, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.whole.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_new_units_are_encoded_as_few_texts(path):
    encoder = tokens.Encoder(path)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdeéßЖ語0!", k=rng.randint(1, 9))) for _ in range(5000)]
    texts = [" ".join(words[i : i + 50]) for i in range(0, 5000, 50)]
    ((_, _, ids, ends),) = tokens.encode_column(encoder, pa.array(texts))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == direct(path, texts)
    assert len(encoder.known) > 3000 and counted.texts <= len(encoder.known) // tokens.AT_ONCE + 1


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_units_with_the_mark_or_parts_of_it(path):
    mark = ENCODERS[path].mark
    units = ["a", f" {mark}", f"b{mark}c", mark[:-1], mark[1:], f"{mark}{mark}", "<", ">", f" {mark[:5]}", " z"]
    for own in (units, [u for u in units if mark not in u]):
        sizes, ids = ENCODERS[path].encode(pa.array(own, pa.large_string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == direct(path, own)


def test_a_token_that_overlaps_another_is_no_mark():
    from tokenizers import AddedToken

    own = Tokenizer.from_file(BYTES)
    assert tokens._mark(own) == (50256, "<|endoftext|>")
    own.add_special_tokens([AddedToken("x<|end", special=True)])
    assert tokens._mark(own) == (None, None)


@pytest.mark.parametrize("seed", range(4))
def test_every_other_place_of_a_run(seed):
    rng = np.random.default_rng(seed)
    after = np.append(np.where(rng.random(400) < 0.2, 400, np.arange(1, 401)), 400)
    at = np.flatnonzero(rng.random(400) < 0.8)
    kinds = rng.integers(0, 2, len(at))
    for kind in (kinds, None):
        want: list[bool] = []
        for i, place in enumerate(at):
            goes_on = i and after[at[i - 1]] == place and (kind is None or kind[i] == kind[i - 1])
            want.append(not want[-1] if goes_on else True)
        assert repair_store._every_other(at, kind, after).tolist() == want


def best_fit_sequences(counts, capacity):
    """Best-fit decreasing, one piece at a time."""
    gaps = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fitting = [g for g in gaps if g >= length]
            if fitting:
                gaps.remove(min(fitting))
                gaps.append(min(fitting) - length)
            else:
                gaps.append(capacity - length)
    return len(gaps), sorted(gaps)


@pytest.mark.parametrize("seed", range(25))
def test_class_rounds_are_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 64])
    counts = {}
    for _ in range(rng.choice([1, 5, 200])):
        counts[rng.randint(1, capacity)] = rng.randint(1, 9)
    taken, used = {}, {n: [] for n in counts}
    for length, rank, n, first, offset in best_fit.best_fit_runs(counts, capacity):
        used[length] += range(rank, rank + n)
        for s in range(first, first + n):
            taken.setdefault(s, []).append((offset, length))
    assert all(sorted(used[n]) == list(range(counts[n])) for n in counts)
    fill = []
    for spans in taken.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        fill.append(at)
    assert max(fill) <= capacity
    sequences, gaps = best_fit_sequences(counts, capacity)
    assert len(taken) == sequences and sorted(capacity - f for f in fill) == gaps


def test_rounds_at_a_large_capacity():
    """The driver's state is bounded by the capacity, whatever the number of pieces."""
    rng = np.random.default_rng(0)
    capacity = 131_072
    drawn = np.clip(np.exp(rng.normal(8, 1.3, 500_000)).astype(int), 1, capacity)
    for times in (1, 10**6):
        counts = {n: c * times for n, c in Counter(drawn.tolist()).items()}
        begun = time.time()
        runs = np.array(best_fit.best_fit_runs(counts, capacity))
        assert time.time() - begun < 60
        assert runs[:, 2].sum() == sum(counts.values())
        # A few dozen runs for each length there is.
        assert len(runs) < 48 * len(counts)
        words = sum(n * c for n, c in counts.items())
        used = int((runs[:, 3] + runs[:, 2]).max())
        assert used < 1.02 * words / capacity + 1


def test_packing_without_broadcast(spark):
    rows = [(i, 0, 0, 1 + i * 37 % 500) for i in range(3000)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        packed = best_fit.pack(pieces, 1024)
        fill = Counter()
        for r in packed.collect():
            fill[r.sequence_id] += r.length
        text = packed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(fill.values()) == sum(r[3] for r in rows) and max(fill.values()) <= 1024
    assert len(fill) == best_fit_sequences(Counter(r[3] for r in rows), 1024)[0]
    assert "SortMergeJoin" in text and "NestedLoop" not in text


@pytest.mark.parametrize("source", ["plain", "awkward", "empty"])
def test_packing(source, documents, pairs, awkward, awkward_pairs, empty):
    df, rows = {"plain": (documents, pairs), "awkward": (awkward, awkward_pairs), "empty": (empty, [])}[source]
    pieces = best_fit.token_pieces(df, BYTES, 2, 1024)
    got = best_fit.pack(pieces, 1024).collect()
    want = []
    for (doc_id, _), ids in zip(rows, direct(BYTES, [t for _, t in rows])):
        ids = np.array([*ids, 2], "<u4")
        first = len(ids) % 1024 or 1024
        for i, a in enumerate([0, *range(first, len(ids), 1024)]):
            own = ids[a : a + (1024 if i else first)]
            want.append((doc_id, i, a, len(own), zlib.crc32(own.tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    counts = {}
    for r in got:
        counts[r.length] = counts.get(r.length, 0) + 1
    assert len(by_sequence) == best_fit_sequences(counts, 1024)[0]


def test_pieces_carry_their_ids(documents, pairs):
    got = best_fit.token_pieces(documents.limit(20), BYTES, 2, 64, with_ids=True).collect()
    texts = dict(pairs)
    for doc_id in {r.doc_id for r in got}:
        own = sorted((r for r in got if r.doc_id == doc_id), key=lambda r: r.piece)
        assert sum((r.ids for r in own), []) == direct(BYTES, [texts[doc_id]])[0] + [2]


@pytest.mark.parametrize("seed", range(8))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    docs = [rng.integers(0, rng.choice([1, 3, 50, 49408]), n) for n in rng.integers(0, 4000, 12)]
    docs.append(np.zeros(5001, np.int64))
    ids, ends = np.concatenate(docs), np.cumsum([len(d) for d in docs])
    symbols, symbol_ends, rules = repair_store.compress(ids, ends)
    assert (repair_store.expand(symbols, rules) == ids).all()
    begin = 0
    for doc, end in zip(docs, symbol_ends):
        assert (repair_store.expand(symbols[begin:end], rules) == doc).all()
        begin = end
    assert len(symbols) < len(ids)


@pytest.mark.parametrize("seed", range(6))
def test_rounds_look_at_every_frequent_pair(seed):
    """The same symbols as rounds over all places."""
    rng = np.random.default_rng(seed)
    docs = [rng.integers(0, rng.choice([1, 2, 5, 300]), n) for n in rng.integers(0, 900, 20)]
    docs += [np.tile(rng.integers(0, 9, 7), 60), np.zeros(0, np.int64)]
    ids, ends = np.concatenate(docs), np.cumsum([len(d) for d in docs])
    symbols, symbol_ends, rules = repair_store.compress(ids, ends)
    again, again_ends, more = repair_store.compress(symbols, symbol_ends)
    # Nothing frequent is left, so nothing is found by looking at all places once more.
    assert len(more) == 0 and (again == symbols).all() and (again_ends == symbol_ends).all()
    assert (repair_store.expand(symbols, rules) == ids).all()


@pytest.mark.parametrize("source", ["plain", "awkward", "empty"])
def test_token_files(source, spark, tmp_path, documents, pairs, awkward, awkward_pairs, empty):
    df, rows = {"plain": (documents, pairs), "awkward": (awkward, awkward_pairs), "empty": (empty, [])}[source]
    path = str(tmp_path / "tokens")
    repair_store.write_tokens(df, path, WORDS, 1, shard_tokens=30_000)
    got = repair_store.read_documents(spark, path).collect()
    want = {}
    for (doc_id, _), ids in zip(rows, direct(WORDS, [t for _, t in rows])):
        ids = np.array([*ids, 1], "<u4")
        want.setdefault(doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    known = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert known == sorted(known, key=lambda k: -1 if k is None else k)


def test_random_access(spark, tmp_path, documents, pairs):
    path = str(tmp_path / "tokens")
    repair_store.write_tokens(documents, path, WORDS, 1)
    texts = dict(pairs)
    for row in spark.read.parquet(path).collect():
        shard = repair_store.Shard(row.asDict())
        for place in range(0, len(shard.doc_ids), 25):
            ids = direct(WORDS, [texts[shard.doc_ids[place]]])[0] + [1]
            assert shard.document(place).tolist() == ids
            assert [shard.token(place, i) for i in range(0, len(ids), 37)] == ids[::37]


@pytest.mark.parametrize("seed", range(4))
def test_rounds_go_on_while_a_pair_is_frequent_and_rules_are_used(seed):
    rng = np.random.default_rng(seed)
    common = np.tile(np.arange(40), 20)
    ids = np.concatenate([rng.integers(100, 60_000, 30_000), common, np.full(50, 7), rng.integers(0, 6, 3000)])
    ends = np.array([5, 5, 30_000, len(ids) - 1000, len(ids)])
    symbols, symbol_ends, rules = repair_store.compress(ids, ends)
    assert (repair_store.expand(symbols, rules) == ids).all()
    # No pair of two different symbols is left frequent within documents.
    own = [symbols[a:b] for a, b in zip([0, *symbol_ends], symbol_ends)]
    left = Counter((a, b) for d in own for a, b in zip(d.tolist(), d[1:].tolist()) if a != b)
    assert max(left.values()) < repair_store.MIN_COUNT
    assert len(rules) == len(np.unique(rules, axis=0)) > 0


@pytest.mark.parametrize("seed", range(6))
def test_a_shard_expands_each_rule_once(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    docs = [rng.integers(0, rng.choice([3, 50, 49408]), n) for n in rng.integers(0, 4000, 12)]
    docs += [np.tile(rng.integers(0, 9, 7), 60 * seed), np.zeros(0, np.int64)]
    ids, ends = np.concatenate(docs), np.cumsum([len(d) for d in docs])
    symbols, symbol_ends, rules = repair_store.compress(ids, ends)
    row = {
        "doc_ids": np.arange(len(docs)).astype("<i8").tobytes(),
        "known": np.ones(len(docs), "u1").tobytes(),
        "doc_tokens": np.diff(ends, prepend=0).astype("<i8").tobytes(),
        "doc_symbols": np.diff(symbol_ends, prepend=0).astype("<i8").tobytes(),
        "rules": rules.astype("<u4").tobytes(),
        "expansions": repair_store.expansion_lengths(rules).astype("<u4").tobytes(),
        "low": (symbols & 0xFFFF).astype("<u2").tobytes(),
        "high": (symbols >> 16).astype("u1").tobytes(),
    }
    shard, taken = repair_store.Shard(row), []
    whole = repair_store.expand

    def counted(symbols, rules):
        taken.append(len(symbols))
        return whole(symbols, rules)

    monkeypatch.setattr(repair_store, "expand", counted)
    got = shard.tokens()
    assert got.dtype == np.dtype("<u4") and (got == ids).all()
    short = shard.expansions.sum() <= len(ids)
    assert taken == [len(rules) if short else len(symbols)]


def test_buckets_tell_pairs_of_one_right_symbol_apart():
    pairs = (np.arange(4096, dtype=np.int64) << 32) | 77
    assert len(np.unique(repair_store._bucket(pairs))) > 4000


def test_a_worker_gives_memory_back():
    """What an idle worker holds after a column of new words, in a process of its own."""
    code = (
        "import random, re, sys\n"
        "import pyarrow as pa\n"
        "from adlytics.llm.tokens import encode_column, tokenizer\n"
        "r = random.Random(1)\n"
        "word = lambda: ''.join(r.choices('abcdefghij', k=r.randint(4, 9)))\n"
        "texts = pa.array([' '.join(word() for _ in range(2000)) for _ in range(600)])\n"
        "encoder = tokenizer(sys.argv[1])\n"
        "def held():\n"
        "    found = open('/proc/self/smaps_rollup').read()\n"
        "    return int(re.search(r'\\nPss_Anon:\\s+(\\d+)', found)[1]) // 1024\n"
        "before = held()\n"
        "for part in encode_column(encoder, texts):\n"
        "    del part\n"
        "print(held() - before)\n"
    )
    root = str(Path(__file__).parents[2])
    run = subprocess.run([sys.executable, "-c", code, BYTES], cwd=root, capture_output=True, text=True, check=True)
    assert int(run.stdout) < 30
