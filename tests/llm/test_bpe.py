from __future__ import annotations

import hashlib
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from conftest import DATA
from sparrowgrid.llm import bpe
from sparrowgrid.llm.queries import bpe_path, op1_bpe

from .conftest import ODD


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_path())


TEXTS = ["", "a" * 3000, "ab<|endoftext|> x<|endoftext|><|endoftext|>", "x" * 70 + "é" * 40, "  \n\n \t a  b", "don't we'LL 12'3s", "\u0085  x\x1c\x1fy", "日本語 テキスト" * 30, "The the  THE\r\n\r\n!!?", "ab" * 40 + " " + "ba" * 33]


def test_encodes_as_the_library(library):
    model = bpe.Bpe(bpe_path())
    for text in TEXTS:
        ids = library.encode(text, add_special_tokens=False).ids
        assert model.encode(text) == ids
        assert model.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_texts_are_encoded_together(library, monkeypatch):
    model, ids = bpe.Bpe(bpe_path()), [library.encode(text, add_special_tokens=False).ids for text in TEXTS]
    monkeypatch.setattr(bpe, "SPANS", 7)
    # The second time a few pretokens are remembered, the third time all are forgotten first.
    for most in (250_000, 250_000, 3):
        monkeypatch.setattr(bpe, "REMEMBERED", most)
        found, ends = model.encode_flat(TEXTS)
        assert [found[a:b].tolist() for a, b in zip(ends, ends[1:])] == ids
        assert model.decode_flat(found, ends) == TEXTS
    # Ids that break a character are decoded text by text, as the library does.
    odd = [x[k : k + 3] for x in ids for k in range(min(len(x), 60))]
    ends = np.cumsum([0, *map(len, odd)])
    assert model.decode_flat(np.concatenate(odd), ends) == [model.decode(x) for x in odd] == [library.decode(x, skip_special_tokens=False) for x in odd]
    assert model.encode_flat([])[0].size == 0


def test_rows_and_single_trees_agree():
    model = bpe.Bpe(bpe_path())
    words = [w.encode() for w in ("Thtionwh", "enenhastinguish", "aaaaaaaaaaaaaaaaa", "zqxj", "réêou", "1234567890" * 6)]
    assert model.encode_words(words) == [model._one(w) for w in words]


def test_query(spark, library):
    rows = {r.doc_id: r for r in op1_bpe(spark, DATA).collect()}
    for doc_id, text in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert rows[doc_id].n_tokens == len(ids)
        assert rows[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[doc_id].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_odd_tables(spark, docs, library):
    out = bpe.encode(docs(ODD, True), bpe_path(), decoded="decoded").collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in out) == sorted((i or 0, t or "") for i, t in ODD)
    assert all(r.ids == library.encode(r.text or "", add_special_tokens=False).ids and r.score == "kept" for r in out)
    back = bpe.decode(bpe.encode(docs(ODD), bpe_path()), bpe_path()).collect()
    assert all(r.decoded == (r.text or "") for r in back)
    assert bpe.digests(docs([]), bpe_path()).count() == 0


def test_other_settings_are_refused(tmp_path):
    import json

    import pytest

    from sparrowgrid.llm.bpe import Bpe
    from sparrowgrid.llm.queries import bpe_path

    spec = json.load(open(bpe_path(), encoding="utf-8"))
    token = spec["added_tokens"][0]
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}}, {"pre_tokenizer": None}, {"decoder": None}, {"added_tokens": [token | {"lstrip": True}]}, {"model": spec["model"] | {"ignore_merges": True}}):
        (tmp_path / "odd.json").write_text(json.dumps(spec | change))
        with pytest.raises(ValueError):
            Bpe(str(tmp_path / "odd.json"))


def test_what_a_worker_has_freed_goes_back():
    """In a process of its own: half a gigabyte is freed below a block that stays."""
    code = """
import re
from sparrowgrid.llm.shared import give_back
held = lambda: sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())))
blocks = [bytes(1000 + k % 7) for k in range(500_000)]
last = bytes(2000)
del blocks
before = held()
give_back()
assert before - held() > 300_000, (before, held())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[2], timeout=60)
