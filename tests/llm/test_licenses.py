from __future__ import annotations

from conftest import DATA
from sparrowgrid.llm import licenses as lic

from .conftest import ODD
from .test_line_dedup import norm


def expected(text):
    words = norm(text or "")
    base = []
    for phrase, label in lic.PHRASES.items():
        p = tuple(phrase.split())
        base += [(k, label) for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
    labels, score = {x for _, x in base}, 1.0 if base else 0.0
    for block in (text or "").split("\n"):
        block = set(norm(block))
        for label, template in lic.TEMPLATES:
            t = set(template.split())
            if len(t & block) >= -(-800 * len(t) // 1000):
                labels.add(label)
                score = max(score, len(t & block) / len(t))
    at = [k for k, _ in base]
    return len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), score


def check(df):
    for r in lic.scan(df).collect():
        want = expected(r.text)
        assert tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")) == want[:6], r
        assert abs(r.score - want[6]) < 1e-12


def test_whole_table(spark):
    check(spark.read.parquet(DATA.replace("0.001", "0.01") + "/documents.parquet"))


def test_planted(docs):
    check(docs([
        (1, "Under the MIT\nLicense. under the mit license under the MIT license"), (2, "This work is licensed under the GNU Public License, v3"),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and docs"), (4, "cc by-nc CC BY NC\n\n" + "word " * 400 + "the apache license, version 2"),
        (5, "License GNU the under general public version 3 work is licensed this"), *ODD,
    ]))


def test_odd_tables(docs):
    out = lic.scan(docs(ODD, True))
    assert out.count() == len(ODD) and out.select("ids").distinct().collect()[0].ids == "kept"
    assert lic.scan(docs([])).count() == 0
    assert lic.scan(docs(ODD), templates=[], phrases={}).filter("labels <> ''").count() == 0


def test_wrapped_texts_are_found(docs):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal"
    gpl = " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
    apart = "permission is hereby granted free of charge to any person " + "word " * 60 + "\nobtaining a copy of this software and associated documentation files"
    rows = [(1, mit), (2, gpl), (3, "\n".join(lic.words_of(mit))), (4, apart), (5, "some words\n" * 30 + gpl + "some words\n" * 30), (6, mit[:40]), (7, mit[40:])]
    found = {r.doc_id: (r.labels, r.score) for r in lic.scan(docs(rows)).collect()}
    assert found == {1: ("mit", 1.0), 2: ("gpl-3", 1.0), 3: ("mit", 1.0), 4: ("", 0.0), 5: ("gpl-3", 1.0), 6: ("", 0.0), 7: ("", 0.0)}


def test_any_size_of_template_table_gives_the_same(docs):
    rows = [*ODD, (10, "released under the mit license\n" + " ".join(t for _, t in lic.TEMPLATES[3:6])), (11, lic.TEMPLATES[8][1]), (12, "cc by nc " + lic.TEMPLATES[9][1])]
    key = lambda r: (r.doc_id or 0, r.text or "")
    one, many = (sorted(lic.scan(docs(rows), most_words=n).collect(), key=key) for n in (1_000_000, 20))
    assert one == many and {r.doc_id: r.labels for r in one}[12] == "cc-by-nc,mpl-2"


def test_many_templates(docs):
    """Each block is tried only against templates that share a word of their prefix with it."""
    templates = [(f"l{k}", " ".join(f"w{k}x{j}" for j in range(12)) + " the same last words") for k in range(3000)]
    rows = [(k, f"before it\n{templates[k * 7][1]}\nafter") for k in range(40)]
    assert {r.doc_id: r.labels for r in lic.scan(docs(rows), templates=templates, phrases={}).collect()} == {k: f"l{k * 7}" for k in range(40)}


def test_one_very_long_text(docs):
    text = "word " * 3_000_000 + "this work is licensed under the gnu\ngeneral public license version 3"
    r = lic.scan(docs([(1, text)])).first()
    assert (r.n_words, r.labels, r.score) == (3_000_012, "gpl-3", 1.0)
