from __future__ import annotations

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import DATA
from sparrowgrid.llm import ngram_join as nj

from .conftest import ODD
from .test_components import brute

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected(rows):
    """doc_id -> (n_shingles, component) of rows without repeated ids."""
    sets = {i: shingle_set(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    comp = brute(links)
    return {i: (len(sets[i]), comp.get(i, i)) for i in ids}


def copies(rng, n):
    """Texts of all sizes, with near copies around the threshold."""
    out, i = [], 0
    for size in [1, 2, 4, 5, 6, 7, 8, 9, 11, 14, 18, 25, 40, 90] * n:
        base = [f"w{rng.randrange(400)}" for _ in range(size)]
        for _ in range(rng.randrange(1, 5)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, max(1, size // 20)])):
                k = rng.randrange(len(text))
                text[k : k + rng.randrange(2)] = [f"n{rng.randrange(9)}"] * rng.randrange(2)
            out.append((i, " ".join(text).upper() if rng.random() < 0.2 else "  ".join(text)))
            i += 1
    return out


def test_planted_copies(spark, docs):
    rows = copies(random.Random(3), 6)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.components(docs(rows)).collect()}
    assert found == expected(rows)


def test_whole_table(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.components(df).collect()}
    assert found == expected([(r.doc_id, r.text) for r in df.collect()])


def test_several_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 3)
    rng = random.Random(8)
    base = [f"w{rng.randrange(999)}" for _ in range(80)]
    rows = []
    for i in range(25):
        text = list(base)
        text[rng.randrange(80)] = f"x{i}"
        rows.append((i, " ".join(text)))
    assert {r.component_id for r in nj.components(docs(rows)).collect()} == {0}


def test_odd_tables(docs):
    found = nj.components(docs(ODD, True)).collect()
    assert len(found) == len(ODD)
    assert all(r.component_id == r.doc_id for r in found)
    assert {r.doc_id for r in found if r.n_shingles == 0} == {1, 2, 3}
    kept = nj.one_of_each(docs(ODD, True))
    assert kept.columns == docs(ODD, True).columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    assert nj.components(docs([])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**40), min_size=1, max_size=60, unique=True), st.integers(0, 25), st.integers(0, 25))
def test_similar_sets_share_a_kept_signature(items, cut, add):
    """The filter loses no pair: whatever frequencies the index shows, a similar pair's rarest common signature stays."""
    x = np.sort(nj.mix(np.array(items, np.uint64)))
    y = np.sort(np.concatenate([x[min(cut, len(x) - 1) :], nj.mix(np.arange(2**50, 2**50 + add, dtype=np.uint64))]))
    small, large = sorted((x, y), key=len)
    common = len(np.intersect1d(x, y))
    if common * 100 < 75 * (len(x) + len(y) - common):
        return
    band = int(np.searchsorted(nj.BANDS, len(small), "right")) - 1
    assert -(-len(large) * 3 // 4) <= len(small)
    (a, spare_a), (b, spare_b) = nj.signatures(small, band), nj.signatures(large, band)
    frequency = {int(s): 2 + int(s) % 7 for s in np.concatenate([a, b])}
    stay = []
    for sig, spare in ((a, spare_a), (b, spare_b)):
        f = np.array([frequency[int(s)] for s in sig], np.uint32)
        stay.append(set(sig[nj.kept(np.zeros(len(sig), np.int64), f, sig, np.array([spare]))].tolist()))
    assert stay[0] & stay[1]


def test_similar_counts_exactly():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(80)]
    i, j = nj.similar(sets)
    want = {(p, q) for q in range(80) for p in range(q) if 100 * len(np.intersect1d(sets[p], sets[q])) >= 75 * len(np.union1d(sets[p], sets[q]))}
    assert set(zip(i.tolist(), j.tolist())) == want


def test_rows_without_an_id_and_ids_of_several_texts(docs):
    base = [f"w{k}" for k in range(60)]
    near = " ".join([*base[:-1], "other"])
    rows = [(None, " ".join(base)), (None, " ".join(base)), (None, near), (7, near), (8, "quite another text of some words"), (8, "and one more that shares the id only"), (None, "alone without an id or a twin here"), (9, None), (9, None)]
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in nj.components(docs(rows)).collect())
    assert [x[3] for x in found if x[0]] == [None, 7, 7, 7] and [x[3] for x in found if not x[0]] == [7, 8, 8, 9, 9]
    kept = sorted((r.doc_id or 0, r.text or "") for r in nj.one_of_each(docs(rows, True)).collect())
    assert kept == [(0, rows[6][1]), (7, near), (8, rows[5][1]), (8, rows[4][1]), (9, "")]


def test_both_kinds_of_allocation_are_used():
    """Small sets go by one-deletion neighbourhoods, larger ones by subsets."""
    kinds = [nj.design(b)[2] for b in range(30)]
    assert 1 in kinds and kinds[-1] == 0


def test_names_that_clash(docs):
    from pyspark.sql import functions as F

    df = docs([(1, "one two three four five six"), (2, "one two three four five six")])
    for name in ("_id", "_version", "_many", "_own", "version", "component"):
        df = df.withColumn(name, F.lit("kept"))
    out = nj.one_of_each(df).collect()
    assert len(out) == 1 and all(out[0][c] == "kept" for c in df.columns[2:])
