"""The pipeline: each stage's decisions on its own input, and the whole run."""

from __future__ import annotations

import hashlib
from collections import Counter

import brute
import corpus_pipeline
import pytest
from text_helpers import SF
from test_signature_trees import components_by_brute_force

from adlytics.llm import mixing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_documents(spark, documents):
    stages = dict(corpus_pipeline.STAGES)
    docs = documents
    seen = {}
    for name in list(stages)[:-1]:
        before = docs.collect()
        docs = spark.createDataFrame(stages[name](spark, docs, SF).collect(), documents.schema)
        assert docs.columns == COLUMNS
        seen[name] = before, docs.collect()

    before, after = seen["quality_rules"]
    failed = {r[0] for r in brute.base_quality([(r.doc_id, r.text) for r in before]) if r[-1]}
    assert not failed & {r.doc_id for r in after}
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()
    clean = {r.doc_id for r in labels} & {r.doc_id for r in before} - failed
    assert clean <= {r.doc_id for r in after}

    before, after = seen["line_dedup"]
    want = Counter((i, n - d) for i, n, d, _ in brute.dedup([(r.doc_id, r.text) for r in before]))
    lines = lambda text: len(text.split("\n"))
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert all(lines(r.text) == max(1, n) for r in after for i, n in want if i == r.doc_id)

    before, after = seen["near_duplicates"]
    found, _ = components_by_brute_force([(r.doc_id, r.text) for r in before], 5, 80)
    assert {r.doc_id for r in after} == {c if n else i for i, n, c in found}

    before, after = seen["mix_sources"]
    size = lambda t: len(brute.WORD.findall(t or ""))
    given = {r.doc_id: size(r.text) for r in before}
    taken = Counter()
    for r in after:
        taken[r.doc_id] += size(r.text)
    assert all(n <= 3 * given[i] for i, n in taken.items())
    assert sum(taken.values()) == pytest.approx(sum(given.values()), rel=0.1)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert rows and max(fill.values()) <= 1024


STAGE = dict(corpus_pipeline.STAGES)


def texts_by_id(rows):
    return Counter((r.doc_id, r.text) for r in rows)


def test_quality_rules_on_awkward_rows(spark, awkward, awkward_pairs):
    words = [f"Abc{i} def{i} ghi{i} jkl{i}." for i in range(30)]
    menu = "Home | About | News | Contact | Search"
    more = [(50, "\n".join([*words, menu])), (51, " ".join(words)), (51, " ".join(words)), (52, "\n".join([menu] * 30))]
    df = awkward.unionByName(
        spark.createDataFrame([(i, t, None, None, None, 1, "x") for i, t in more], awkward.schema)
    )
    out = STAGE["quality_rules"](spark, df, SF)
    assert out.columns == df.columns
    # Every awkward row is too short, blank or repeats itself; of the others the menu goes.
    assert all(r[-1] for r in brute.base_quality(awkward_pairs))
    assert texts_by_id(out.collect()) == Counter(
        {(50, "\n".join(words)): 1, (51, " ".join(words)): 2}
    )
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_line_dedup_on_awkward_rows(spark, awkward, awkward_pairs):
    out = STAGE["line_dedup"](spark, awkward, SF)
    assert out.columns == awkward.columns
    got = Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in out.collect())
    assert got == Counter((i, digest) for i, _, _, digest in brute.dedup(awkward_pairs))


def test_near_duplicates_on_awkward_rows(spark, awkward, awkward_pairs):
    out = STAGE["near_duplicates"](spark, awkward, SF)
    assert out.columns == awkward.columns
    found, groups = components_by_brute_force(awkward_pairs, 5, 80)
    empty = Counter(i for i, n, _ in found if not n)
    rows = out.collect()
    size = lambda t: len(brute.WORD.findall(t or ""))
    assert Counter(r.doc_id for r in rows if not size(r.text)) == empty
    worded = Counter(r.doc_id for r in rows if size(r.text))
    assert sum(worded.values()) == groups
    assert set(worded) == {c for _, n, c in found if n}


def test_mix_sources_on_awkward_rows(spark, awkward, awkward_pairs):
    out = STAGE["mix_sources"](spark, awkward, SF)
    assert out.columns == awkward.columns
    mixed, sized, entries = mixing.mix(awkward)
    want = Counter()
    for r in mixing.taken_words(mixed, sized, entries).collect():
        want[r.doc] += r.taken
    own = {}
    for i, text in awkward_pairs:
        own.setdefault(i, []).append(brute.WORD.findall(text or ""))
    got = Counter()
    for r in out.collect():
        words = brute.WORD.findall(r.text)
        got[r.doc_id] += len(words)
        assert words and any(set(words) <= set(w) for w in own[r.doc_id])
    assert got == Counter({k: v for k, v in want.items() if v})


def test_pack_sequences_on_awkward_rows(spark, awkward, awkward_pairs):
    rows = STAGE["best_fit"](spark, awkward, SF).collect()
    fill, starts = Counter(), Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
        starts[r.doc_id] += r.piece == 0
    assert starts == Counter(i for i, _ in awkward_pairs) and max(fill.values()) <= 1024
    empty = [r for r in rows if r.doc_id in (0, 1)]
    assert [(r.piece, r.start, r.length) for r in empty] == [(0, 0, 1)] * 2


@pytest.mark.parametrize("name", STAGE)
def test_empty_tables(name, spark, empty):
    out = STAGE[name](spark, empty, SF)
    if name != "best_fit":
        assert out.columns == empty.columns
    assert out.collect() == []
