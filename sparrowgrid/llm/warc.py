"""Operator 8: WARC fixity audit with Merkle trees.

``records`` lays pages out as WARC resource records (id, date, target, type and length, then the body), in archives of a range of page ids with running byte offsets.
``tree`` hashes them: a leaf holds the records of one place of an archive (a page id), and a node on level k its ``FANOUT`` children in order. A node's digest is over
its children's lengths in bytes and their digests: the offset ranges follow from the lengths, and what comes after a lost or added record keeps its hashes.
All levels are stored once. ``audit`` compares the roots of two replicas and then only the children of nodes that differ; at the leaves that are left, records are matched by digest,
then by identity. So what is compared below the roots follows the damage (``compared`` counts it); stored levels are read by the columns needed.

All of it is DataFrame functions. An archive of more than ``MOST`` records (rows without page_id, a page id of very many rows) is parted by digest, and so is its place: no group
follows the largest key.

Edge cases: null urls and texts are empty; rows without page_id are archive -1; rows that share a page_id are records of one place, ordered by digest; repeated rows are
matched one by one; an empty table has no archive; a record that a replica lacks is ``missing`` (in a parted archive also what was changed, with an ``extra`` one), one that only it has ``extra``; other
columns of pages, whatever they are called, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import apart, discard, ready, through_parquet

FANOUT = 16
#: Page ids to an archive, and the levels above its places.
PAGES, HEIGHT = 1000, 3
#: Records of an archive that is not parted.
MOST = 8000
#: Pages have no time of capture; records that came without one are dated alike.
DATE = "1970-01-01T00:00:00Z"

PLACE = ["archive", "part"]


def record_text(identity: Column, url: Column, body: Column) -> Column:
    """A WARC resource record: header fields, an empty line, the body, two empty lines."""
    end = F.lit("\r\n")
    fields = {"WARC-Type": F.lit("resource"), "WARC-Record-ID": F.concat(F.lit("<urn:uuid:"), identity, F.lit(">")), "WARC-Date": F.lit(DATE), "WARC-Target-URI": url, "Content-Type": F.lit("text/html"), "Content-Length": F.octet_length(body).cast("string")}
    return F.concat(F.lit("WARC/1.1"), end, *[x for name, value in fields.items() for x in (F.lit(f"{name}: "), value, end)], end, body, end, end)


def identity_of(page_id: Column, url: Column) -> Column:
    """The record id of a page: the same in every replica, whatever became of its body."""
    h = F.sha2(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("")), url), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12))


def _hashed(pages: DataFrame, body: str) -> DataFrame:
    url, held = F.coalesce("url", F.lit("")), F.coalesce(F.col(body), F.lit(""))
    rows = pages.select("page_id", identity_of(F.col("page_id"), url).alias("identity"), url.alias("url"), held.alias("body"))
    rows = rows.select("page_id", "identity", record_text(F.col("identity"), F.col("url"), F.col("body")).alias("text"))
    return rows.select("page_id", "identity", F.coalesce(F.floor(F.col("page_id") / PAGES), F.lit(-1)).cast("long").alias("archive"), F.octet_length("text").cast("long").alias("size"), F.sha2("text", 256).alias("digest"))


def large(*replicas: DataFrame, body: str = "html", most: int = MOST) -> DataFrame:
    """archive, parts: those with more records than stay together, by the replica that has most. All replicas are parted alike."""
    counts = [_hashed(x, body).groupBy("archive").agg(F.count("*").alias("n")) for x in replicas]
    every = counts[0]
    for more in counts[1:]:
        every = every.unionAll(more)
    return every.groupBy("archive").agg(F.max("n").alias("n")).filter((F.col("n") > most) | (F.col("archive") < 0)).select("archive", F.expr(f"cast((n - 1) div {most} + 1 as int)").alias("parts"))


def records(pages: DataFrame, body: str = "html", parted: DataFrame | None = None) -> DataFrame:
    """page_id, identity, archive, part, place (within it), seq (from 0), begin, end (bytes), digest of each record. parted: as ``large`` gives it."""
    rows = _hashed(pages, body)
    parted = large(pages, body=body) if parted is None else parted
    hashed = F.xxhash64("digest")
    rows = rows.join(apart(parted, "archive"), "archive", "left").withColumns({
        "part": F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(hashed, F.col("parts"))).cast("int"),
        "place": F.when(F.col("parts").isNull(), F.pmod("page_id", F.lit(PAGES))).otherwise(F.pmod(F.shiftright(hashed, 20), F.lit(PAGES))).cast("int"),
    })
    order = Window.partitionBy(*PLACE).orderBy("place", "page_id", "digest")
    rows = rows.withColumns({"seq": F.row_number().over(order).cast("long") - 1, "end": F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    return rows.select("page_id", "identity", "archive", "part", "place", "seq", (F.col("end") - F.col("size")).alias("begin"), "end", "digest")


def tree(rows: DataFrame, written: list[str] | None = None) -> list[DataFrame]:
    """Levels 0 (places) to HEIGHT (roots) of ``records``, each stored: archive, part, node, length, digest."""
    over = lambda children: F.sha2(F.array_join(F.transform(F.array_sort(children), lambda x: F.concat_ws(" ", x["length"].cast("string"), x["digest"])), "|"), 256)
    leaves = rows.groupBy(*PLACE, F.col("place").alias("node")).agg(F.sum(F.col("end") - F.col("begin")).alias("length"), F.collect_list(F.struct("seq", (F.col("end") - F.col("begin")).alias("length"), "digest")).alias("c"))
    levels = [through_parquet(leaves.select(*PLACE, "node", "length", over(F.col("c")).alias("digest")), "level0", written)]
    for k in range(1, HEIGHT + 1):
        above = levels[-1].groupBy(*PLACE, F.expr(f"node div {FANOUT}").cast("int").alias("up")).agg(F.sum("length").alias("sum"), F.collect_list(F.struct("node", "length", "digest")).alias("c"))
        levels.append(through_parquet(above.select(*PLACE, F.col("up").alias("node"), F.col("sum").alias("length"), over(F.col("c")).alias("digest")), f"level{k}", written))
    return levels


def differing(a: list[DataFrame], b: list[DataFrame], compared: list[int] | None = None, written: list[str] | None = None) -> DataFrame:
    """archive, part, node of the places that differ, found from the roots down. compared: gets how many nodes were compared on each level.

    What differs on a level is stored: it is read for both replicas on the next, so a plan of all levels would double with each.
    """
    bad: DataFrame | None = None
    for x, y in zip(reversed(a), reversed(b)):
        if bad is not None:
            parents = bad.select(*PLACE, F.col("node").alias("_up"))
            x, y = (t.withColumn("_up", F.expr(f"node div {FANOUT}").cast("int")).join(parents, [*PLACE, "_up"], "left_semi").drop("_up") for t in (x, y))
        met = x.select(*PLACE, "node", F.struct("length", "digest").alias("_a")).join(y.select(*PLACE, "node", F.struct("length", "digest").alias("_b")), [*PLACE, "node"], "full_outer")
        if compared is not None:
            compared.append(met.count())
        bad = through_parquet(met.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*PLACE, "node"), "differing", written)
    return bad


def audit(a: DataFrame, b: DataFrame, compared: list[int] | None = None) -> DataFrame:
    """archive, part, seq, begin, end, page_id, digest (a's, else b's) and kind (changed, missing from b, extra in b) of all records of two ``records`` that differ."""
    mine: list[str] = []
    out = _audit(through_parquet(a, "records", mine), through_parquet(b, "records", mine), compared)
    discard(a.sparkSession, mine)
    return out


def _audit(a: DataFrame, b: DataFrame, compared: list[int] | None = None) -> DataFrame:
    """``audit`` of stored records."""
    spark = ready(a.sparkSession)
    mine: list[str] = []
    bad = differing(tree(a, mine), tree(b, mine), compared, mine).withColumnRenamed("node", "place")
    place = [*PLACE, "place"]
    # Equal records are matched one by one; of the others, those of one identity in order.
    nth = lambda t, *by: t.withColumn("_nth", F.row_number().over(Window.partitionBy(*place, *by).orderBy("seq")))
    x, y = (through_parquet(nth(t.join(bad, place, "left_semi"), "digest"), "damaged", mine) for t in (a, b))
    same = [*place, "digest", "_nth"]
    x, y = (nth(t.join(other.select(*same), same, "left_anti").drop("_nth"), "identity") for t, other in ((x, y), (y, x)))
    held = F.struct("page_id", "seq", "begin", "end", "digest")
    key = [*place, "identity", "_nth"]
    met = x.select(*key, held.alias("_a")).join(y.select(*key, held.alias("_b")), key, "full_outer")
    kind = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").otherwise("changed")
    out = through_parquet(met.select(*PLACE, F.coalesce("_a", "_b").alias("r"), kind.alias("kind")).select(*PLACE, "r.*", "kind"), "audit")
    discard(spark, mine)
    return out


def decayed(pages: DataFrame) -> DataFrame:
    """A replica of pages that has suffered, by the first digit of a text's digest: 0, one byte has changed; 1, the record is lost; 2, there is one more."""
    digest = F.sha2(F.coalesce("html", F.lit("")), 256)
    starts = lambda text: F.substring(digest, 1, 1) == text
    hit = starts("0") & (F.length("html") > 0)
    kept = pages.filter(~starts("1")).withColumn("html", F.when(hit, F.concat(F.lit("#"), F.expr("substring(html, 2)"))).otherwise(F.col("html")))
    return kept.unionByName(pages.filter(starts("2")).withColumn("html", F.concat(F.lit("extra"), F.coalesce("html", F.lit("")))))


def audited(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """Every record of pages and what became of it in the replica, and the replica's extra ones: page_id, archive, part, seq, begin, end, digest, kind (intact, changed, missing, extra)."""
    mine: list[str] = []
    parted = through_parquet(large(pages, replica), "parted", mine)
    own = through_parquet(records(pages, parted=parted), "records")
    found = _audit(own, through_parquet(records(replica, parted=parted), "records", mine))
    discard(pages.sparkSession, mine)
    names = ["page_id", *PLACE, "seq", "begin", "end", "digest"]
    marks = found.filter("kind <> 'extra'").select(*PLACE, "seq", "kind")
    out = own.select(*names).join(marks, [*PLACE, "seq"], "left").select(*names, F.coalesce("kind", F.lit("intact")).alias("kind"))
    return out.unionByName(found.filter("kind = 'extra'").select(*names, "kind"))
