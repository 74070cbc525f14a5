"""Operator 3 [native]: document fingerprints by a homomorphic multiset hash.

A paragraph (a line) is hashed to a wide vector, and a document's fingerprint is the sum of its paragraphs' vectors
modulo powers of two. So the order of paragraphs does not matter, equal multisets have equal fingerprints, and a
paragraph is inserted or deleted by adding or subtracting its vector (``combine``), without the rest of the text.

A vector has two parts. ``sums``: ``2 * SEEDS`` uniform lanes modulo 2^32, hashed from the whole paragraph; they decide
equality. ``lanes``: 64 signed counters modulo 2^16, the sum of the +1/-1 hash bits of the paragraph's pieces (runs of up to four
words within a sentence); the cosine of two documents' lanes estimates that of their multisets of pieces (``likeness``).

All of it is DataFrame functions: texts meet their neighbours in two equi-joins on doc_id over one shared exchange,
and sums are hash aggregates in the partitions where the texts already are.

Edge cases: a null text is empty; an empty text is one empty paragraph, and two empty texts are alike (1.0); a text
without pieces is unlike (0.0) any other text; rows may repeat, and of rows that share a doc_id the smallest text is the one the
neighbour borrows from; a row without doc_id has no neighbour, so nothing is put in the place of its second half;
a lone document is its own neighbour. Other columns of the input are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import ready

#: 64-bit hashes a paragraph; each gives two lanes of 32 bits.
SEEDS = 6
LANES = 64
_LOW = (1 << 32) - 1
#: Bits j and j + 32 of a hash, in two fields of a long.
_PAIR = (1 << 32) | 1
#: Runs of one to four words within a sentence.
PIECE = r"(?:[^\s.]++\s*+){1,4}+[.\s]*+"


def neighbours(docs: DataFrame) -> DataFrame:
    """Per distinct doc_id: longest (its longest text), next_id and pred_id, in a ring by descending doc_id.

    Ids are dealt into ranges; a window within each range finds all neighbours but those across the ranges' ends,
    which come from a table of one row a range.
    """
    spark = ready(docs.sparkSession)
    ids = docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.length("text")).alias("longest"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.repartitionByRange(ranges, "doc_id").withColumn("part", F.spark_partition_id()).checkpoint()
    ends = ranged.groupBy("part").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    order, whole = Window.orderBy("part"), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "part",
        F.coalesce(F.lag("high").over(order), F.max("high").over(whole)).alias("below"),
        F.coalesce(F.lead("low").over(order), F.min("low").over(whole)).alias("above"),
    )
    within = Window.partitionBy("part").orderBy(F.desc("doc_id"))
    found = ranged.select("part", "doc_id", "longest", F.lead("doc_id").over(within).alias("next_id"), F.lag("doc_id").over(within).alias("pred_id"))
    return found.join(ends, "part").select("doc_id", "longest", F.coalesce("next_id", "below").alias("next_id"), F.coalesce("pred_id", "above").alias("pred_id"))


def edited(docs: DataFrame, ring: DataFrame) -> DataFrame:
    """doc_id, row, first, text, edited, pred_id: the last half of each text replaced by the start of the next document.

    docs holds no null doc_id; so both joins read one and the same exchange of the texts.
    """
    by_id = Window.partitionBy("doc_id").orderBy("text")
    rows = docs.select("doc_id", "text", F.row_number().over(by_id).alias("row"), F.lag(F.lit(1)).over(by_id).isNull().alias("first"))
    lent = rows.filter("first").select(F.col("doc_id").alias("next_id"), F.col("text").alias("lent"))
    lent = ring.join(lent, "next_id").select("doc_id", "pred_id", F.expr("substring(lent, 1, cast(longest div 2 as int))").alias("lent"))
    return rows.join(lent, "doc_id", "left").select("doc_id", "row", "first", "text", "pred_id", _swapped(F.coalesce("lent", F.lit(""))).alias("edited"))


def _swapped(lent: Column) -> Column:
    half = F.expr("cast(length(text) div 2 as int)")
    return F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring(lent, F.lit(1), half))


def fingerprints(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, which must tell the rows apart, and ``fingerprint``: struct<sums: array<bigint>, lanes: array<int>, pieces: bigint>."""
    paragraphs = df.select(*keys, F.explode(F.split(text, "\n")).alias("_paragraph"))
    pieces = paragraphs.select(*keys, "_paragraph", F.posexplode_outer(F.regexp_extract_all("_paragraph", F.lit(PIECE), F.lit(0))).alias("_at", "_piece"))
    start = F.col("_at").isNull() | (F.col("_at") == 0)
    hashed = pieces.select(
        *keys, F.col("_piece").isNotNull().cast("long").alias("_n"), F.when(F.col("_piece").isNotNull(), F.xxhash64("_piece")).otherwise(F.lit(0)).alias("_h"),
        *[F.when(start, F.xxhash64(F.lit(s), F.col("_paragraph"))).otherwise(F.lit(0)).alias(f"_p{s}") for s in range(SEEDS)],
    )
    sums = [F.sum(F.col(f"_p{s}").bitwiseAND(F.lit(_LOW))).alias(f"_s{2 * s}") for s in range(SEEDS)]
    sums += [F.sum(F.shiftrightunsigned(F.col(f"_p{s}"), 32)).alias(f"_s{2 * s + 1}") for s in range(SEEDS)]
    bits = [F.sum(F.shiftrightunsigned(F.col("_h"), j).bitwiseAND(F.lit(_PAIR))).alias(f"_b{j}") for j in range(32)]
    found = hashed.groupBy(*keys).agg(F.sum("_n").alias("_n"), *sums, *bits)
    signed = lambda count: (F.lit(2) * count - F.col("_n")).cast("int")
    lanes = [signed(F.col(f"_b{j}").bitwiseAND(F.lit(_LOW))) for j in range(32)] + [signed(F.shiftrightunsigned(F.col(f"_b{j}"), 32)) for j in range(32)]
    return found.select(*keys, F.struct(
        F.array(*[F.col(f"_s{i}") % F.lit(1 << 32) for i in range(2 * SEEDS)]).alias("sums"), F.array(*lanes).alias("lanes"), F.col("_n").alias("pieces")
    ).alias("fingerprint"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of a's paragraphs with b's put in (sign 1) or taken out (sign -1)."""
    return F.struct(
        F.zip_with(a["sums"], b["sums"], lambda x, y: F.pmod(x + y * F.lit(sign), F.lit(1 << 32))).alias("sums"),
        F.zip_with(a["lanes"], b["lanes"], lambda x, y: (x + y * F.lit(sign)).cast("int")).alias("lanes"),
        (a["pieces"] + b["pieces"] * F.lit(sign)).alias("pieces"),
    )


def to_text(fingerprint: Column) -> Column:
    """Hexadecimal: the sums of 8 digits each, then the lanes modulo 2^16 of 4 digits each."""
    digits = lambda column, n: F.array_join(F.transform(column, lambda x: F.lpad(F.lower(F.hex(F.pmod(x.cast("long"), F.lit(1 << 4 * n)))), n, "0")), "")
    return F.concat(digits(fingerprint["sums"], 8), F.lit("."), digits(fingerprint["lanes"], 4))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: 1 for equal fingerprints, else the lanes' cosine, not below 0."""
    lanes = [(a["lanes"][j].cast("double"), b["lanes"][j].cast("double")) for j in range(LANES)]
    add = lambda values: reduce(lambda x, y: x + y, values)
    dot, norm = add(x * y for x, y in lanes), F.sqrt(add(x * x for x, _ in lanes)) * F.sqrt(add(y * y for _, y in lanes))
    return F.when(a["sums"] == b["sums"], F.lit(1.0)).when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot / norm))).otherwise(F.lit(0.0))


def _both(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """Fingerprints fp of text and edited_fp of edited for each row of ``edited``, and the names of the columns that go along."""
    # An explicit pair of rows keeps one pass over the joined texts; sha2 is taken before the texts are cut up.
    both = rows.select("doc_id", "row", "first", "pred_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("body")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("body")))).alias("one"))
    keys = ["doc_id", "row", "first", "pred_id", "n_chars", "edited_sha256"]
    found = fingerprints(both.select(*keys, "one.side", "one.body"), [*keys, "side"], "body")
    pick = lambda side: F.max(F.when(F.col("side") == side, F.col("fingerprint")))
    return found.groupBy(*keys).agg(pick(0).alias("fp"), pick(1).alias("edited_fp")), keys


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Per row of docs: n_chars, edited_sha256, both fingerprints and how alike its fingerprint is to the edited and the next text's."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = texts.filter(F.col("doc_id").isNotNull())
    own, keys = _both(edited(known, neighbours(known)))
    # Each first row also sends its fingerprint to the row before it in the ring.
    sent = own.select(*keys, F.explode(F.array(
        F.struct(F.col("doc_id").alias("to"), F.lit(True).alias("mine"), F.col("fp"), F.col("edited_fp")),
        F.struct(F.when(F.col("first"), F.col("pred_id")).alias("to"), F.lit(False).alias("mine"), F.col("fp"), F.lit(None).cast(own.schema["edited_fp"].dataType).alias("edited_fp")),
    )).alias("x")).filter("x.mine or x.to is not null")
    met = sent.select("doc_id", "n_chars", "edited_sha256", "x.*").withColumn("next_fp", F.max(F.when(~F.col("mine"), F.col("fp"))).over(Window.partitionBy("to"))).filter("mine")
    # Rows without doc_id are not dealt out by it.
    lone = texts.filter(F.col("doc_id").isNull()).select("doc_id", F.monotonically_increasing_id().alias("row"), F.lit(False).alias("first"), "text", F.lit(None).cast(docs.schema["doc_id"].dataType).alias("pred_id"), _swapped(F.lit("")).alias("edited"))
    lone = _both(lone)[0].withColumn("next_fp", F.lit(None).cast(own.schema["fp"].dataType))
    fp, efp = F.col("fp"), F.col("edited_fp")
    return met.select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp").union(lone.select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp")).select(
        "doc_id", "n_chars", "edited_sha256", to_text(fp).alias("fingerprint"), to_text(efp).alias("edited_fingerprint"),
        likeness(fp, efp).alias("near_edited"), F.coalesce(likeness(fp, F.col("next_fp")), F.lit(0.0)).alias("near_next"),
    )
