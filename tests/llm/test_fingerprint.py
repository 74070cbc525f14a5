from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from conftest import DATA
from sparrowgrid.llm import fingerprint as fp
from sparrowgrid.llm.queries import op3_fingerprint

from .conftest import ODD


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    order = sorted(texts, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    rows = op3_fingerprint(spark, DATA).collect()
    assert len(rows) == len(texts)
    by_text = {}
    for r in rows:
        text, other = texts[r.doc_id], texts[after[r.doc_id]]
        k = len(text) // 2
        edited = text[: len(text) - k] + other[:k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) <= (r.near_edited == 1.0)
    assert len(set(by_text.values())) == len(by_text)
    long = [r for r in rows if r.n_chars > 1000]
    assert sum(r.near_edited for r in long) / len(long) > 0.35 > sum(r.near_next for r in long) / len(long) + 0.2


def test_native_plan(spark):
    plan = op3_fingerprint(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def prints(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string")
    return {r.k: r.fingerprint for r in fp.fingerprints(df, ["k"], "t").collect()}


def plain(text):
    """The fingerprint by hand, from the reference xxHash."""
    import re
    import struct

    import xxhash

    sums, lanes, pieces = [0] * (2 * fp.SEEDS), [0] * fp.LANES, 0
    for paragraph in text.split("\n"):
        for s in range(fp.SEEDS):
            h = xxhash.xxh64_intdigest(paragraph.encode(), seed=xxhash.xxh64_intdigest(struct.pack("<i", s), seed=42))
            sums[2 * s], sums[2 * s + 1] = (sums[2 * s] + h % 2**32) % 2**32, (sums[2 * s + 1] + h // 2**32) % 2**32
        for piece in re.findall(fp.PIECE, paragraph):
            h = xxhash.xxh64_intdigest(piece.encode(), seed=42)
            lanes = [n + (1 if h >> j & 1 else -1) for j, n in enumerate(lanes)]
            pieces += 1
    return sums, lanes, pieces


def test_fingerprints_by_hand(spark):
    texts = ["one two three four five. six\n\nseven eight", "", "x", "a.b.c d", "\n", "word " * 400_000, *(r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(40).collect() if r.text)]
    found = prints(spark, texts)
    for k, text in enumerate(texts):
        assert (list(found[k].sums), list(found[k].lanes), found[k].pieces) == plain(text)


def test_order_insertion_and_deletion(spark):
    a, b = "first paragraph of some words\nsecond one here", "third paragraph. with more words\nfourth"
    whole, swapped, x, y = (prints(spark, [f"{a}\n{b}", f"{b}\n{a}", a, b])[k] for k in range(4))
    assert whole == swapped
    rows = spark.createDataFrame([(x, y, whole)], "x {0}, y {0}, whole {0}".format("struct<sums: array<bigint>, lanes: array<int>, pieces: bigint>"))
    out = rows.select(fp.combine(F.col("x"), F.col("y")).alias("put"), fp.combine(F.col("whole"), F.col("y"), -1).alias("took")).first()
    assert out.put == whole and out.took == x


def test_odd_tables(spark, docs):
    rows = fp.compare_neighbours(docs(ODD)).collect()
    assert len(rows) == len(ODD)
    lone = next(r for r in rows if r.doc_id is None)
    text = next(t for i, t in ODD if i is None)
    assert lone.near_next == 0 and lone.n_chars == len(text) and lone.edited_sha256 == hashlib.sha256(text[: len(text) - len(text) // 2].encode()).hexdigest()
    assert {r.n_chars for r in rows if r.doc_id == 1} == {0}
    assert len([r for r in rows if r.doc_id == 5]) == 2
    assert fp.compare_neighbours(docs([])).count() == 0
    one = fp.compare_neighbours(docs([(9, "only this text")])).first()
    assert one.near_next == 1.0


def test_names_that_clash(docs):
    df = docs([(1, "one two"), (2, "three four")])
    for name in ("row", "first", "edited", "fp", "_paragraph", "pred_id", "side"):
        df = df.withColumn(name, F.lit("kept"))
    assert [r.n_chars for r in fp.compare_neighbours(df).orderBy("doc_id").collect()] == [7, 10]
