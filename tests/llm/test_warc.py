from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import DATA, canonical_rows
from sparrowgrid.llm import warc
from sparrowgrid.llm.queries import ORACLE, op8_warc


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_query_equals_sql(spark, size):
    import duckdb

    d = DATA.replace("0.001", size)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{d}/pages.parquet')")
    ours = op8_warc(spark, d).toPandas()
    assert canonical_rows(ours) == canonical_rows(con.execute(ORACLE["op8_warc"]).df())
    assert size == "0.001" or set(ours.kind) == {"intact", "changed", "missing", "extra"}


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def audit(spark, a, b, compared=None):
    a, b = pages(spark, a), pages(spark, b)
    parted = warc.large(a, b)
    return Counter((r.page_id, r.kind) for r in warc.audit(warc.records(a, parted=parted), warc.records(b, parted=parted), compared).collect())


def test_changes_losses_and_additions(spark):
    a = [(k, f"https://x.example.com/{k}", f"<p>{k}</p>") for k in range(1200)]
    b = [r if r[0] not in (17, 333, 1100) else (*r[:2], r[2].replace("p", "q")) for r in a]
    assert audit(spark, a, b) == Counter({(17, "changed"): 1, (333, "changed"): 1, (1100, "changed"): 1})
    # What follows a lost or added record, or one of another length, is intact.
    assert audit(spark, a, a[:5] + a[6:]) == Counter({(5, "missing"): 1})
    assert audit(spark, a[:5] + a[6:], a) == Counter({(5, "extra"): 1})
    longer = [*a[:40], (40, a[40][1], "x" * 999), *a[41:600], *a[601:], (2000, "u", "new")]
    assert audit(spark, a, longer) == Counter({(40, "changed"): 1, (600, "missing"): 1, (2000, "extra"): 1})
    assert audit(spark, a, a[::-1]) == Counter()


def test_the_descent_follows_the_damage(spark):
    a = [(k, f"u{k}", f"text {k}") for k in range(4000)]
    b = [r if r[0] != 2345 else (*r[:2], "other") for r in a]
    compared: list[int] = []
    assert audit(spark, a, b, compared) == Counter({(2345, "changed"): 1})
    # Four roots, then the children of one node on each level.
    assert compared[0] == 4 and all(n <= warc.FANOUT for n in compared[1:]) and len(compared) == warc.HEIGHT + 1


def test_plans_do_not_double_with_the_levels(spark, monkeypatch):
    joins: list[int] = []
    count = lambda df: str(df._jdf.queryExecution().optimizedPlan()).count("Join ")

    def seen(df, *rest, write=warc.through_parquet):
        joins.append(count(df))
        return write(df, *rest)

    monkeypatch.setattr(warc, "through_parquet", seen)
    a = pages(spark, [(k, f"u{k}", f"text {k}") for k in range(300)])
    out = warc.audited(a, warc.decayed(a))
    assert out.count() >= 300 and max([*joins, count(out)]) <= 3


def test_roots_by_hand(spark):
    leaves = warc.records(pages(spark, [(k, "u", "x" * k) for k in range(40)]))
    rows = leaves.orderBy("seq").collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    level = [(r.end - r.begin, sha(f"{r.end - r.begin} {r.digest}")) for r in rows]
    for _ in range(warc.HEIGHT):
        groups = [level[k : k + warc.FANOUT] for k in range(0, len(level), warc.FANOUT)]
        level = [(sum(n for n, _ in g), sha("|".join(f"{n} {d}" for n, d in g))) for g in groups]
    root = warc.tree(leaves)[-1].first()
    assert (root.length, root.digest) == level[0] and root.length == rows[-1].end


def test_a_record_by_hand(spark):
    r = warc.records(pages(spark, [(7, "https://x.example.com/", "é")])).first()
    text = warc.record_text(F.lit("id"), F.lit("https://x.example.com/"), F.lit("é"))
    lines = spark.range(1).select(text.alias("t")).first().t.split("\r\n")
    assert lines == ["WARC/1.1", "WARC-Type: resource", "WARC-Record-ID: <urn:uuid:id>", "WARC-Date: 1970-01-01T00:00:00Z", "WARC-Target-URI: https://x.example.com/", "Content-Type: text/html", "Content-Length: 2", "", "é", "", ""]
    assert len(r.identity) == 36 and r.end - r.begin == len("\r\n".join(lines).encode()) - 2 + 36


def test_large_archives_are_parted(spark):
    a = [(None, f"u{k}", "same") for k in range(300)] + [(5, "u", f"t{k % 200}") for k in range(300)]
    x = pages(spark, a)
    y = pages(spark, a[1:] + [(5, "u", "t3"), (None, "v", None)])
    parted = warc.large(x, y, most=50)
    rows = warc.records(x, parted=parted)
    sizes = {(r.archive, r.part): r["count"] for r in rows.groupBy("archive", "part").count().collect()}
    assert len(sizes) >= 12 and max(sizes.values()) < 120 and sum(sizes.values()) == 600
    found = Counter((r.page_id, r.kind) for r in warc.audit(rows, warc.records(y, parted=parted)).collect())
    assert found == Counter({(None, "missing"): 1, (5, "extra"): 1, (None, "extra"): 1})


def test_odd_tables(spark):
    odd = pages(spark, [(None, None, None), (1, None, ""), (1, None, ""), (2, "u", "é" * 1000), (None, "u", "x"), (3, "u", "long " * 400_000)])
    odd = odd.withColumns({c: F.lit("kept") for c in ("seq", "digest", "archive", "part", "identity", "_a")})
    out = warc.audited(odd, odd)
    assert out.count() == 6 and out.filter("archive = -1").count() == 2 and {r.kind for r in out.collect()} == {"intact"}
    assert warc.audited(odd, odd.limit(0)).filter("kind = 'missing'").count() == 6 and warc.audited(odd.limit(0), odd).filter("kind = 'extra'").count() == 6
    assert warc.audited(odd.limit(0), odd.limit(0)).count() == 0
