"""Operator 5: benchmark decontamination by spaced-seed hashing.

A mask keeps some of the word positions of a short window and ignores the others, so a seed survives a substituted word there. The
seeds of all masks over the benchmark are met by those of every position of every document. Around each hit the two word
sequences are laid side by side on its diagonal, and the overlap is the span with the most equal words among the spans in which at
least ``IDENTITY`` of the words are equal; it counts from ``LEAST_WORDS`` equal words on (or all words of a shorter item).

Words are runs of letters and digits, lower-cased. The masks are complete: every overlap of eight equal words and more at 75 % identity, up to 64 words long, holds a seed (a test
proves it for all patterns of substitutions).

A benchmark that has at most ``MOST_WORDS`` words, as its bytes prove, is sent along, and texts are not shuffled. A larger one is joined on its seeds: documents' seeds are sieved by a bitmap
of fixed size (``SIEVE`` bits), those that pass meet the benchmark's in a join that Spark can split at frequent seeds, and only the spans around hits cross the network. Both ways give the same rows.

Edge cases: null and empty texts or items match nothing; items of fewer than ``SHORTEST`` words are no evidence and match nothing; an item without item_id counts, and is null in the overlaps;
item_id has any type; repeated items count once each; repeated documents repeat; texts of any length are read whole; an empty benchmark leaves all documents clean; a column called overlaps is
replaced by ``find`` and kept by ``clean``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import apart, free, ready, through_parquet
from .textnp import NOT_ALNUM, PLACE, mix, slices, words

#: 1: the position counts; 0: it is ignored.
MASKS = ("11111", "110111", "1011011", "11010011", "1101000011")
IDENTITY = 0.75
LEAST_WORDS = 8
SHORTEST = 5
#: Words of a benchmark that is sent along, and bits of the sieve for a larger one.
MOST_WORDS = 1_000_000
SIEVE = 1 << 26


def seeds(h: np.ndarray, mask: str, which: int) -> np.ndarray:
    """The seed that starts at each word; the last ones, which would run over the end, are left out."""
    n = len(h) - len(mask) + 1
    out = np.full(max(n, 0), PLACE[50 + which])
    for k, c in enumerate(mask):
        if c == "1" and n > 0:
            out += h[k : k + n] * PLACE[k]
    return mix(out)


def overlap(equal: np.ndarray) -> tuple[int, int, int]:
    """(first, end, equal words) of the span with the most equal words among those in which IDENTITY of the words are equal."""
    penalty = IDENTITY / (1 - IDENTITY)
    s = np.concatenate([[0.0], np.cumsum(np.where(equal, 1.0, -penalty))])
    e = np.concatenate([[0], np.cumsum(equal)])
    low = np.minimum.accumulate(s)
    first = np.searchsorted(-low, -s, "left")
    gain = e - e[first]
    j = int(gain.argmax())
    i = int(first[j])
    at = np.flatnonzero(equal[i:j])
    return (i + int(at[0]), i + int(at[-1]) + 1, int(gain[j])) if len(at) else (0, 0, 0)


class Block:
    """Some items of the benchmark, and their seeds."""

    def __init__(self, items: list[tuple[int, str | None]]):
        import pyarrow as pa

        self.ids = [i for i, _ in items]
        parts, self.start = [], [0]
        for _, _, buf, offsets in slices(pa.array([t for _, t in items], pa.string())):
            h, _, _, rows = words(buf, offsets, NOT_ALNUM)
            parts.append(h)
            self.start += (self.start[-1] + rows[1:]).tolist()
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.start = np.array(self.start, np.int64)
        self.item_of = np.repeat(np.arange(len(items)), np.diff(self.start))
        self.tables = []
        size = 1 << max(16, min(24, (4 * len(self.words)).bit_length()))
        for w, mask in enumerate(MASKS):
            key = seeds(self.words, mask, w)
            at = np.flatnonzero(self.item_of[: len(key)] == self.item_of[len(mask) - 1 :]) if len(key) else np.zeros(0, np.int64)
            at = at[np.argsort(key[at], kind="stable")]
            maybe = np.zeros(size, bool)
            maybe[(key[at] & np.uint64(size - 1)).astype(np.int64)] = True
            self.tables.append((key[at], at, maybe))

    def search(self, h: np.ndarray, rows: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, first word, end word, equal words) of all overlaps with a run of texts' word hashes."""
        row_of = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        pairs = []
        for w, mask in enumerate(MASKS):
            key, at, maybe = self.tables[w]
            own = seeds(h, mask, w)
            if not len(key) or not len(own):
                continue
            p = np.flatnonzero(maybe[(own & np.uint64(len(maybe) - 1)).astype(np.int64)])
            a, b = np.searchsorted(key, own[p], "left"), np.searchsorted(key, own[p], "right")
            p, a, n = p[b > a], a[b > a], (b - a)[b > a]
            keep = row_of[p] == row_of[p + len(mask) - 1]
            p, a, n = p[keep], a[keep], n[keep]
            q = at[np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            p = np.repeat(p, n)
            pairs.append(np.stack([row_of[p], self.item_of[q], p - q], axis=1))
        if not pairs:
            return []
        out = []
        # One row for each text, item and diagonal, however many seeds lie on it.
        for row, item, diagonal in np.unique(np.concatenate(pairs), axis=0).tolist():
            lo = max(int(rows[row]) - diagonal, int(self.start[item]))
            hi = min(int(rows[row + 1]) - diagonal, int(self.start[item + 1]))
            first, end, equal = overlap(h[lo + diagonal : hi + diagonal] == self.words[lo:hi])
            if equal >= min(LEAST_WORDS, size := int(self.start[item + 1] - self.start[item])) and size >= SHORTEST:
                base = lo + diagonal - int(rows[row])
                out.append((row, item, base + first, base + end, equal))
        return out


def found_type(benchmark: DataFrame) -> str:
    return f"array<struct<item_id: {benchmark.schema['item_id'].dataType.simpleString()}, first_word: bigint, end_word: bigint, equal_words: bigint>>"


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None, most_words: int = MOST_WORDS) -> DataFrame:
    """docs' columns (or those of keep) and ``overlaps``, sorted: every overlap of the text with an item of benchmark (item_id, text)."""
    names = [c for c in (docs.columns if keep is None else keep) if c != "overlaps"]
    items = benchmark.select("item_id", "text").filter("text is not null").distinct()
    # A word has a byte at least, and another one before the next.
    bound = items.agg(F.sum(F.expr("octet_length(text) div 2 + 1"))).first()[0] or 0
    if bound > most_words:
        return _joined(docs, items, text, names, found_type(benchmark))
    # At most most_words words.
    block = Block([(r["item_id"], r["text"]) for r in items.orderBy("item_id", "text").collect()])
    carried = list(dict.fromkeys([*names, text]))
    held = free(carried, "_overlaps")
    schema = ", ".join([*(f"`{c}` {t}" for c, t in docs.select(*carried).dtypes), f"{held} {found_type(benchmark)}"])
    out = docs.select(*carried).mapInArrow(_searcher(docs.sparkSession.sparkContext.broadcast(block), carried, text, held, benchmark.schema["item_id"].dataType), schema)
    return out.select(*names, F.array_sort(held).alias("overlaps"))


def _word_rows(batches):
    """Per text of (id, text): id and its words' hashes."""
    for batch in batches:
        for first, end, buf, offsets in slices(batch.column(1)):
            h, _, _, rows = words(buf, offsets, NOT_ALNUM)
            for k in range(first, end):
                yield batch.column(0)[k], h[rows[k - first] : rows[k - first + 1]]


def _seed_rows(sieve: np.ndarray | None):
    def run(batches):
        import pyarrow as pa

        ids, keys, at = [], [], []

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (ids, keys, at)], ["id", "seed", "at"])
            ids.clear(), keys.clear(), at.clear()
            return batch

        for row, h in _word_rows(batches):
            for w, mask in enumerate(MASKS):
                key = seeds(h, mask, w)
                slot = key & np.uint64(SIEVE - 1)
                place = np.arange(len(key)) if sieve is None else np.flatnonzero((sieve[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1))
                if len(place):
                    ids.append(np.full(len(place), row.as_py(), np.int64)), keys.append(key[place].view(np.int64)), at.append(place.astype(np.int64))
            if sum(map(len, ids)) > 1 << 16:
                yield out()
        if ids:
            yield out()

    return run


def _spans(batches):
    """Rows (id, text, hits) to (id, item, diagonal, first word, words of the text around the diagonal)."""
    import pyarrow as pa

    for batch in batches:
        hits = iter(batch.column(2).to_pylist())
        for row, h in _word_rows(iter([batch])):
            out = []
            for x in next(hits):
                lo, hi = max(0, x["diagonal"]), min(len(h), x["diagonal"] + x["size"])
                out.append((row.as_py(), x["item"], x["diagonal"], lo, h[lo:hi].tobytes()))
            for part in range(0, len(out), 1000):
                columns = zip(*out[part : part + 1000])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["id", "item", "diagonal", "lo", "span"])


def _lengths(batches):
    import pyarrow as pa

    for batch in batches:
        found = [(row.as_py(), len(h), h.tobytes()) for row, h in _word_rows(iter([batch]))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*zip(*found)] or [()] * 3, (pa.int64(), pa.int64(), pa.binary()))], ["item", "size", "words"])


def _measured(batches):
    import pyarrow as pa

    for batch in batches:
        out = []
        row, item, diagonal, lo, span, size, own = (c.to_pylist() for c in batch.columns)
        for k in range(batch.num_rows):
            x, y = np.frombuffer(span[k], np.uint64), np.frombuffer(own[k], np.uint64)
            start = lo[k] - diagonal[k]
            first, end, equal = overlap(x == y[start : start + len(x)])
            if equal >= min(LEAST_WORDS, size[k]):
                out.append((row[k], item[k], lo[k] + first, lo[k] + end, equal))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in ([*zip(*out)] or [()] * 5)], ["id", "item", "first_word", "end_word", "equal_words"])


def _joined(docs: DataFrame, items: DataFrame, text: str, names: list[str], kind: str) -> DataFrame:
    """``find`` by a join on seeds."""
    spark = ready(docs.sparkSession)
    key = free([*names, text], "_row")
    source = through_parquet(docs.select(*dict.fromkeys([*names, text])).withColumn(key, F.monotonically_increasing_id()), "searched")
    named = through_parquet(items.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text"), "items")
    sizes = through_parquet(named.select("item", "text").mapInArrow(_lengths, "item long, size long, words binary").filter(f"size >= {SHORTEST}"), "sizes")
    seeds_of = "id long, seed long, at long"
    theirs = through_parquet(named.select("item", "text").mapInArrow(_seed_rows(None), seeds_of).withColumnRenamed("id", "item").join(sizes.select("item", "size"), "item"), "seeds")
    slot = F.col("seed").bitwiseAND(F.lit(SIEVE - 1))
    bits = theirs.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(seed & 63 as int))")).alias("bits"))
    # SIEVE / 64 rows at most, whatever the benchmark.
    sieve = np.zeros(SIEVE // 64, np.int64)
    for batch in bits.toPandas().itertuples():
        sieve[batch.word] = batch.bits
    ours = source.select(key, text).mapInArrow(_seed_rows(sieve.view(np.uint64)), seeds_of).withColumnRenamed("at", "place")
    hits = ours.join(theirs, "seed").select("id", "item", (F.col("place") - F.col("at")).alias("diagonal"), "size").distinct()
    wanted = hits.groupBy("id").agg(F.collect_list(F.struct("item", "diagonal", "size")).alias("hits")).withColumnRenamed("id", key)
    spans = source.select(key, text).join(wanted, key).select(key, text, "hits").mapInArrow(_spans, "id long, item long, diagonal long, lo long, span binary")
    met = spans.join(apart(sizes, "item"), "item").select("id", "item", "diagonal", "lo", "span", "size", "words").mapInArrow(_measured, "id long, item long, first_word long, end_word long, equal_words long")
    met = met.join(named.select("item", "item_id"), "item").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("item_id", "first_word", "end_word", "equal_words"))).alias("overlaps")).withColumnRenamed("id", key)
    return source.join(met, key, "left").select(*names, F.coalesce("overlaps", F.array().cast(kind)).alias("overlaps"))


def _searcher(shared, carried: list[str], text: str, held: str, kind):
    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        block = shared.value
        struct = pa.struct([("item_id", to_arrow_type(kind)), *((c, pa.int64()) for c in ("first_word", "end_word", "equal_words"))])
        for batch in batches:
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for first, _, buf, offsets in slices(batch.column(carried.index(text))):
                h, _, _, rows = words(buf, offsets, NOT_ALNUM)
                for row, item, a, b, n in block.search(h, rows):
                    found[first + row].append({"item_id": block.ids[item], "first_word": a, "end_word": b, "equal_words": n})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(struct))], [*carried, held])

    return run


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, contaminated, n_overlaps, items (comma-joined), most_equal."""
    found = find(docs, benchmark, keep=["doc_id"])
    return found.select(
        "doc_id", (F.size("overlaps") > 0).alias("contaminated"), F.size("overlaps").cast("long").alias("n_overlaps"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("overlaps", lambda x: x["item_id"]))).cast("array<string>"), ",").alias("items"),
        F.coalesce(F.array_max(F.transform("overlaps", lambda x: x["equal_words"])), F.lit(0)).cast("long").alias("most_equal"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, columns as they are, whose text overlaps with no item."""
    name = free(docs.columns, "_overlaps")
    found = find(docs.withColumnRenamed("overlaps", name) if "overlaps" in docs.columns else docs, benchmark)
    kept = found.filter(F.size("overlaps") == 0).drop("overlaps")
    return (kept.withColumnRenamed(name, "overlaps") if name in kept.columns else kept).select(*docs.columns)
