from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from sparrowgrid.llm.queries import bpe_path

from .test_line_dedup import expected as deduped
from .test_ngram_join import expected as joined

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages(spark):
    from tokenizers import Tokenizer

    from sparrowgrid.llm import decontaminate, quality

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], DATA).cache())
    good, lines, distinct, clean, ids = out[1:]
    assert all(x.columns == docs.columns for x in out[:-1])
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    kept = {r.doc_id for r in quality.classify(docs, labels, keep=["doc_id"]).filter("predicted = 1").collect()}
    assert {i for i, _ in rows(good)} == kept
    # Line dedup against all pairs of lines; a document that loses lines goes when only blanks are left.
    before = dict(rows(good))
    want = {i: t for i, t in deduped(list(before.items())).items() if t == before[i] or t.strip()}
    assert dict(rows(lines)) == want
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    component = joined(rows(lines))
    assert {i for i, _ in rows(distinct)} == {i for i, (_, c) in component.items() if i == c}
    hit = {r.doc_id for r in decontaminate.find(distinct, spark.read.parquet(f"{DATA}/benchmark.parquet")).collect() if r.overlaps}
    assert {i for i, _ in rows(clean)} == {i for i, _ in rows(distinct)} - hit
    library, texts = Tokenizer.from_file(bpe_path()), dict(rows(clean))
    final = ids.collect()
    assert {r.doc_id for r in final} == texts.keys() and all(r.round_trip for r in final)
    assert all(r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in final)
    again = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, DATA).collect()}
    assert again == {r.doc_id: r.n_tokens for r in final}


def test_line_dedup_keeps_what_is_left(spark, docs):
    footer = "all rights reserved by the makers"
    given = [(1, footer), (2, f"* salt\n* flour\n{footer}"), (3, f"{footer}\n \n\t "), (4, footer), (5, "  "), (6, f"一行没有空格的文字\n{footer}"), (7, None)]
    found = dict(rows(corpus_pipeline.distinct_lines(spark, docs([r for r in given if r[1] is not None]), DATA)))
    assert found == {1: footer, 2: "* salt\n* flour", 5: "  ", 6: "一行没有空格的文字"}
    kept = corpus_pipeline.distinct_lines(spark, docs([r for r in given if r[1]], True).withColumn("_removed", F.lit("mine")), DATA)
    assert {r._removed for r in kept.collect()} == {"mine"} and {r.n_lines for r in kept.collect()} == {"kept"}
    assert corpus_pipeline.distinct_lines(spark, docs(given), DATA).count() == 5


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/empty/{name}.parquet")
        for other in ("documents", "labels", "benchmark"):
            df = spark.read.parquet(f"{DATA}/{other}.parquet")
            (df.limit(0) if other == name else df.limit(40)).write.parquet(f"{tmp_path}/{name}/{other}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/documents").count() == 0
    # Without labels every score is one half, which is kept; without a benchmark nothing leaks.
    assert corpus_pipeline.run(spark, f"{tmp_path}/labels").count() > 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/benchmark").count() > 0
