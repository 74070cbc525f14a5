from __future__ import annotations

import random

from conftest import DATA
from sparrowgrid.llm import decontaminate as dc

from .conftest import ODD
from .test_line_dedup import norm


def test_planted_passages(spark, docs):
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(4000)}"
    items = [(k, " ".join(word() for _ in range(rng.randrange(12, 60)))) for k in range(60)]
    rows, truth = [], {}
    for i in range(200):
        text = [word() for _ in range(rng.randrange(5, 300))]
        truth[i] = set()
        if i % 3 == 0:
            k, passage = rng.choice(items)
            passage = passage.upper().split()
            for _ in range(len(passage) // 12):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(text))
            text[at:at] = passage
            truth[i] = {k}
        rows.append((i, ", ".join(text)))
    bench = spark.createDataFrame(items + items[:5], "item_id long, text string")
    found = {r.doc_id: {o.item_id for o in r.overlaps} for r in dc.find(docs(rows), bench).collect()}
    assert found == truth
    # Joined on seeds, the benchmark gives the same rows.
    every = [sorted(map(repr, dc.find(docs([*rows, *ODD], True), bench, most_words=n).collect())) for n in (dc.MOST_WORDS, 300)]
    assert every[0] == every[1]
    clean = dc.clean(docs(rows), bench)
    assert {r.doc_id for r in clean.collect()} == {i for i, t in truth.items() if not t}


def test_whole_items_of_the_table_are_found(spark):
    df, bench = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    items = {r.item_id: " ".join(norm(r.text)) for r in bench.collect()}
    whole = {(r.doc_id, i) for r in df.collect() for i, t in items.items() if f" {t} " in f" {' '.join(norm(r.text or ''))} "}
    found = {(r.doc_id, o.item_id) for r in dc.find(df, bench).collect() for o in r.overlaps}
    assert whole and whole <= found


def test_odd_tables(spark, docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "short item"), (None, "a b c d e f g h i"), (4, "one two three four five six seven eight nine")], "item_id long, text string")
    out = dc.clean(docs(ODD, True), bench)
    assert out.columns == docs(ODD, True).columns and out.count() == len(ODD)
    assert dc.report(docs(ODD), bench.limit(0)).filter("contaminated").count() == 0
    assert dc.report(docs([]), bench).count() == 0
    assert dc.report(docs([(1, "and one two three four five six seven eight nine and")]), bench).first().items == "4"


def diagonals(text, item):
    """Overlaps of two word sequences by brute force: on each diagonal the span with the most equal words at 75 %, of all spans."""
    out = set()
    for d in range(-len(item) + 1, len(text)):
        lo, hi = max(0, d), min(len(text), d + len(item))
        equal = [text[k] == item[k - d] for k in range(lo, hi)]
        best = 0
        for a in range(len(equal)):
            n = 0
            for b in range(a, len(equal)):
                n += equal[b]
                if n * 4 >= 3 * (b + 1 - a) and equal[a] and equal[b]:
                    best = max(best, n)
        if best >= min(dc.LEAST_WORDS, len(item)) and len(item) >= dc.SHORTEST:
            out.add(best)
    return max(out, default=0)


def test_overlaps_against_every_diagonal(spark, docs):
    rng = random.Random(9)
    items = [[f"b{rng.randrange(60)}" for _ in range(rng.randrange(3, 40))] for _ in range(25)]
    rows = []
    for i in range(60):
        text = [f"t{rng.randrange(60)}" for _ in range(rng.randrange(0, 40))]
        own = list(rng.choice(items))
        for _ in range(rng.randrange(0, len(own) // 2 + 1)):
            own[rng.randrange(len(own))] = "other"
        at = rng.randrange(len(text) + 1)
        rows.append((i, " ".join(text[:at] + own + text[at:])))
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    for most in (dc.MOST_WORDS, 10):
        found = {r.doc_id: {o.item_id: 0 for o in r.overlaps} | {o.item_id: max(p.equal_words for p in r.overlaps if p.item_id == o.item_id) for o in r.overlaps} for r in dc.find(docs(rows), bench, most_words=most).collect()}
        assert found == {i: {k: n for k, x in enumerate(items) if (n := diagonals(t.split(), x))} for i, t in rows}


def test_masks_are_complete():
    """Of all patterns of equal words without a seed, the most equal ones by length: never eight and three quarters."""
    longest = max(map(len, dc.MASKS)) - 1
    masks = [(len(m), int(m, 2)) for m in dc.MASKS]
    states = {(1, 1): 1}
    for n in range(2, 65):
        after = {}
        for (bits, size), ones in states.items():
            for bit in (0, 1):
                now = bits << 1 | bit
                if not any(size + 1 >= k and now & m == m for k, m in masks):
                    key = now & (1 << longest) - 1, min(size + 1, longest)
                    after[key] = max(after.get(key, 0), ones + bit)
        states = after
        most = max((ones for (bits, _), ones in states.items() if bits & 1), default=0)
        assert most < 8 or most < 0.75 * n, n


def test_types_and_names(spark, docs):
    bench = spark.createDataFrame([("q1", "one two three four five six seven eight nine"), (None, "a b c d e f g h i j")], "item_id string, text string")
    from pyspark.sql import functions as F

    df = docs([(1, "and one two three four five six seven eight nine"), (2, "a b c d e f g h i j"), (3, "clean")]).withColumns({c: F.lit("kept") for c in ("overlaps", "_overlaps", "_row")})
    for most in (dc.MOST_WORDS, 5):
        out = {r.doc_id: [o.item_id for o in r.overlaps] for r in dc.find(df, bench, most_words=most).collect()}
        assert out == {1: ["q1"], 2: [None], 3: []}
    left = dc.clean(df, bench).collect()
    assert [(r.doc_id, r.overlaps, r._overlaps) for r in left] == [(3, "kept", "kept")]


def test_one_very_long_text(docs, spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine")], "item_id long, text string")
    r = dc.report(docs([(1, "word " * 3_000_000 + "one two three four five six seven eight nine")]), bench).first()
    assert (r.contaminated, r.most_equal) == (True, 9)
