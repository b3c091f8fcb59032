"""License scan: phrase places by plain Python, notices with gaps."""

from __future__ import annotations

import re

import brute
import duckdb
import pytest

from adlytics.llm import license_scan, oracles

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_scan(rows):
    out = []
    for doc_id, text in rows:
        own = WORD.findall((text or "").translate(brute.LOWER))
        places, labels = [], set()
        for label, phrase in license_scan.PHRASES:
            want = phrase.split()
            for i in range(len(own) - len(want) + 1):
                if own[i : i + len(want)] == want:
                    places.append(i)
                    labels.add(label)
        out.append(
            (
                doc_id,
                len(own),
                len(places),
                min(places, default=None),
                max(places, default=None),
                ",".join(sorted(labels)),
            )
        )
    return out


@pytest.mark.parametrize("source", ["plain", "awkward", "empty"])
def test_phrases(source, documents, pairs, awkward, awkward_pairs, empty):
    df, rows = {"plain": (documents, pairs), "awkward": (awkward, awkward_pairs), "empty": (empty, [])}[source]
    got = license_scan.scan(df).collect()
    base = [(r.doc, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert sorted(base, key=str) == sorted(base_scan(rows), key=str)
    for r in got:
        base, every = set(r.base_labels.split(",")) - {""}, r.labels.split(",") if r.labels else []
        assert base <= set(every) and every == sorted(set(every))
        assert (r.score > 0) == bool(every) and 0 <= r.score <= 1


def test_notices_bear_gaps_and_scattered_words_do_not_count(spark):
    wording = dict((label, text) for label, text in license_scan.NOTICES)
    bsd = wording["bsd"].split()
    gap = " ".join([*bsd[:8], "or", "maybe", *bsd[8:14], *bsd[15:]])
    scattered = " x y z ".join(" ".join(bsd[i : i + 3]) for i in range(0, len(bsd), 3))
    rows = [
        (1, f"Foo. {wording['bsd'].title()}: bar"),
        (2, "a b " + gap),
        (3, scattered),
        (4, "This work is licensed under the GNU General Public License, version 3."),
        (5, "All rights reserved. Released under the MIT license, under the MIT license"),
        (6, "cc by nc " * 3000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc: r for r in license_scan.scan(df).collect()}
    assert [got[i].labels for i in range(1, 7)] == [
        "bsd", "bsd", "", "gpl-3", "all-rights-reserved,mit", "cc-by-nc",
    ]
    assert got[1].score == 1.0 and 0.6 <= got[2].score < 1.0 and got[3].score == 0.0
    assert (got[6].n_base, got[6].first_word, got[6].last_word) == (3000, 0, 8997)


def test_mentions_close_to_each_other_stay(spark):
    gpl = "gnu general public license"
    mpl = dict(license_scan.NOTICES)["mpl-2"]
    rows = [
        (1, "All rights reserved. Acme. All rights reserved"),
        (2, "All rights reserved. " * 50),
        (3, f"the {gpl} {gpl} version 2"),
        (4, f"{mpl} v 2 0 x v 2 0 x x x"),
        (5, "all rights are reserved and all rights"),
        (6, "All rights reserved"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc: (r.labels, r.score) for r in license_scan.scan(df).collect()}
    own = ("all-rights-reserved", 1.0)
    assert got == {1: own, 2: own, 3: ("gpl-2", 1.0), 4: ("mpl-2", 1.0), 5: ("", 0.0), 6: own}


def test_rows_of_all_kinds_equal_the_sql(spark, awkward):
    """The rules of notices, each on its own, against the SQL."""
    wording = dict((label, text) for label, text in license_scan.NOTICES)
    bsd, mpl = wording["bsd"].split(), wording["mpl-2"]
    texts = [
        "All rights reserved. Acme. All rights reserved",
        "All rights reserved. " * 50,
        "all rights are reserved and all rights",
        f"{mpl} v 2 0 x v 2 0 x x x",
        "the gnu general public license gnu general public license version 2",
        " ".join([*bsd[:8], "or", "maybe", *bsd[8:14], *bsd[15:]]),
        " x y z ".join(" ".join(bsd[i : i + 3]) for i in range(0, len(bsd), 3)),
        " ".join(bsd[:12]), " ".join(bsd[:6]), " ".join(bsd + bsd),
        "under the MIT license", "cc by nc cc by nc",
    ]
    ids = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    one_each = awkward.where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text")
    df = one_each.union(ids)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [tuple(r) for r in df.collect()])
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({oracles.LICENSE_SCAN})").fetchall()
    found = license_scan.scan(df).withColumnRenamed("doc", "doc_id").select(columns).collect()
    cells = lambda rows: sorted((*r[:-1], round(r[-1], 9)) for r in map(tuple, rows))
    assert cells(found) == cells(want)
    labels = {r.doc_id: r.labels for r in found}
    assert labels[1000] == "all-rights-reserved" and labels[1002] == ""


@pytest.mark.parametrize("listed", [20_000, 3])
def test_templates_are_a_table(listed, spark, monkeypatch):
    monkeypatch.setattr(license_scan, "LISTED", listed)
    license_text = " ".join(f"word{i}" for i in range(400))
    templates = spark.createDataFrame(
        [("own-1", False, f"{license_text}. THE END"), ("own-2", True, "Free as in Beer!"), ("short", True, "mit"),
         ("own-2", True, "free as in beer")],
        "label string, exact boolean, wording string",
    )
    rows = [(1, f"x {license_text[:2800]} y"), (2, "free as in beer, free as in speech"), (3, "mit"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc: (r.labels, r.n_base, r.first_word) for r in license_scan.scan(df, templates=templates).collect()}
    assert got == {1: ("own-1", 0, None), 2: ("own-2", 1, 0), 3: ("", 0, None), 4: ("", 0, None)}


def test_windows_of_one_hash_are_told_apart_by_their_words(spark, monkeypatch):
    from pyspark.sql import functions as F

    hashes = license_scan.rolling_hashes
    monkeypatch.setattr(
        license_scan, "rolling_hashes", lambda *a: F.transform(hashes(*a), lambda h: F.pmod(h, F.lit(2)))
    )
    rows = [(1, "some words of no license at all " * 9), (2, "All rights reserved, cc by nc")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc: (r.labels, r.n_base) for r in license_scan.scan(df).collect()}
    assert got == {1: ("", 0), 2: ("all-rights-reserved,cc-by-nc", 1)}
