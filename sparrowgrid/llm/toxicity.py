"""Operator 7: toxicity by noisy-channel deobfuscation.

Disguised spots (digits or signs standing for letters; letters, or signs for them, set apart by one or two separators; letters repeated, once where that hides a known term) are lattices: each character may stand for
several letters, for a repetition or for nothing, at a channel cost. Viterbi decoding finds the letters that are
likeliest under the channel and a character trigram model, which is counted over all documents and mixed with the
spellings of the learned terms. The plain words and the restored ones are then scored.

A term is a word, or a beginning of words together with how many distinct words of the document have it. Terms are learned from at
most ``TRAIN_ROWS`` labelled rows (those of the smallest hashed doc_id), of which near copies count once: terms that stand in
enough toxic training documents, seldom in others, and hardly by chance. A few boosted trees turn what a document
holds of them (how many, how telling, in how long a text) into its score; they are fitted on the two halves of the training rows, each with the
terms of the other half, so that no term speaks for the documents that it was found in.

Edge cases: null and empty texts have the score of a text without terms; without labels every score is 0.5; a null doc_id is never a training row
nor held out; of labels that share a doc_id the largest counts; repeated rows repeat; texts of any length are read whole; columns called like those added are replaced; of equally likely readings the first
letters by the channel's order count.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quality import Trees, fit, held_out
from .shared import ready
from .textnp import _BYTE, _POLY, LOWER, PLACE, SPACES, mix, shingles, slices, words

#: The most labelled rows that terms are learned from.
TRAIN_ROWS = 10_000
#: Bytes of a word's beginning that can be a term.
PREFIXES = range(3, 11)
LEAST_DOCS, LEAST_SHARE, LEAST_RATIO = 4, 0.8, 20.0
#: Beginnings count up to so many distinct words. A whole word has to be this telling; it then explains itself and not its beginnings.
MOST_WORDS, TELLING = 3, 0.95
#: Letters that digits and signs stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
EVIDENCE = 8
LEET_COST, DROP_COST, REPEAT_COST, GAP_COST = 1.0, 3.0, 0.5, 0.0

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_NOT_LETTERS = ~_LETTERS
_ASCII = np.zeros(256, bool)
_ASCII[0x61:0x7B] = True
_LEET = np.zeros(256, bool)
_LEET[[ord(c) for c in LEET]] = True
_GAP = np.zeros(256, bool)
_GAP[[ord(c) for c in " .-_*"]] = True
#: 0: not a letter; 1 to 26: a to z; 27: a byte of any other letter.
_CLASS = np.zeros(256, np.int64)
_CLASS[0x61:0x7B] = np.arange(1, 27)
_CLASS[0x80:] = 27
CLASSES = 28


def lower(buf: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the Latin-1 letters in UTF-8."""
    out = LOWER[buf]
    second = np.flatnonzero(buf[:-1] == 0xC3) + 1 if len(buf) > 1 else np.zeros(0, np.int64)
    up = second[(buf[second] >= 0x80) & (buf[second] <= 0x9E) & (buf[second] != 0x97)]
    out[up] += 0x20
    return out


def count_trigrams(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of letter trigrams over all documents (CLASSES^3); each task sends one table."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for _, _, buf, _ in slices(batch.column(0)):
                c = _CLASS[lower(buf)]
                if len(c) > 2:
                    total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["gram", "n"])

    out = np.zeros(CLASSES**3)
    for gram, n in docs.select(text).mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n")).collect():
        out[gram] = n
    return out.reshape(CLASSES, CLASSES, CLASSES)


def word_spans(buf: np.ndarray, offsets: np.ndarray):
    return words(buf, offsets, _NOT_LETTERS, lower=False)


def count_terms(rows: DataFrame, explained: set[bytes] | None) -> DataFrame:
    """term binary, times int, toxic, other: in how many of the labelled rows (text, y) it stands.

    explained None: whole words, with times 0. Else: beginnings of words but those, with the number of distinct words that have them.
    """

    def run(batches):
        import pyarrow as pa

        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            ys = batch.column(1).to_pylist()
            for first, _, buf, offsets in slices(batch.column(0)):
                low = lower(buf)
                _, starts, ends, at = word_spans(low, offsets)
                raw = low.tobytes()
                for k in range(len(offsets) - 1):
                    found = {raw[a:b] for a, b in zip(starts[at[k] : at[k + 1]].tolist(), ends[at[k] : at[k + 1]].tolist())}
                    if explained is None:
                        counts[int(ys[first + k])].update((w, 0) for w in found)
                    else:
                        own = Counter(w[:n] for w in found - explained for n in PREFIXES if len(w) > n)
                        counts[int(ys[first + k])].update((t, times) for t, most in own.items() for times in range(1, min(most, MOST_WORDS) + 1))
        every = [*(counts[0] | counts[1])]
        if every:
            yield pa.RecordBatch.from_arrays(
                [pa.array([t[0] for t in every], pa.binary()), pa.array([t[1] for t in every], pa.int32()), pa.array([counts[1][t] for t in every], pa.int64()), pa.array([counts[0][t] for t in every], pa.int64())],
                ["term", "times", "toxic", "other"],
            )

    found = rows.select("text", "y").mapInArrow(run, "term binary, times int, toxic long, other long")
    return found.groupBy("term", "times").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def without_copies(rows: DataFrame) -> DataFrame:
    """One row of those (text, y) whose smallest 5-word shingle is the same, under each of three orders."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.uint64)
            for first, _, buf, offsets in slices(batch.column(0)):
                h, _, _, at = words(buf, offsets)
                own, at = shingles(h, at, 5)
                for order in range(3):
                    x = mix(own ^ PLACE[60 - order])
                    for k in range(len(offsets) - 1):
                        out[order, first + k] = x[at[k] : at[k + 1]].min(initial=np.uint64(2**64 - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x.view(np.int64)) for x in out)], ["text", "y", "m0", "m1", "m2"])

    out = rows.select("text", "y").mapInArrow(run, "text string, y int, m0 long, m1 long, m2 long")
    for m in ("m0", "m1", "m2"):
        out = out.withColumn("_row", F.row_number().over(Window.partitionBy(m).orderBy(F.xxhash64("text")))).filter("_row = 1").drop("_row")
    return out.select("text", "y")


def ratio(k1: int, n1: int, k0: int, n0: int) -> float:
    """Log-likelihood ratio of two shares."""
    term = lambda k, e: k * math.log(k / e) if k and e else 0.0
    share = (k1 + k0) / max(n1 + n0, 1)
    return 2 * (term(k1, n1 * share) + term(k0, n0 * share) + term(n1 - k1, n1 * (1 - share)) + term(n0 - k0, n0 * (1 - share)))


class Decoder:
    """Viterbi decoding of a disguised spot under a character trigram model."""

    def __init__(self, counts: np.ndarray, spellings: list[tuple[str, float]]):
        general = (counts + 0.1) / (counts + 0.1).sum(axis=2, keepdims=True)
        own = np.zeros_like(general)
        for word, weight in spellings:
            c = [0, 0, *(ord(x) - 96 if "a" <= x <= "z" else 27 for x in word), 0]
            for x, y, z in zip(c, c[1:], c[2:]):
                own[x, y, z] += weight
        total = own.sum(axis=2, keepdims=True)
        mixed = np.where(total > 0, 0.5 * general + 0.5 * own / np.maximum(total, 1e-9), general)
        self.cost = (-np.log(mixed)).tolist()
        self._cached = None

    def restore(self, spot: str) -> str:
        if self._cached is None:
            self._cached = lru_cache(100_000)(self._restore)
        return self._cached(spot)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_cached": None}

    def _restore(self, spot: str) -> str:
        cost = self.cost
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        before = ""
        for ch in spot:
            options: list[tuple[str, float]] = []
            if ch.isalpha():
                options.append((ch, 0.0))
                if ch == before:
                    options.append(("", REPEAT_COST))
            elif ch in LEET:
                options += [(x, LEET_COST) for x in LEET[ch]]
                options.append(("", DROP_COST))
            else:
                options.append(("", GAP_COST))
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (so_far, path) in states.items():
                for out, channel in options:
                    if out:
                        z = ord(out) - 96 if "a" <= out <= "z" else 27
                        key, value, way = (b, z), so_far + channel + cost[a][b][z], (path, out)
                    else:
                        key, value, way = (a, b), so_far + channel, path
                    if key not in new or value < new[key][0]:
                        new[key] = (value, way)
            states, before = new, ch
        _, path = min((v + cost[a][b][0], k) for k, ((a, b), (v, _)) in enumerate(states.items()))
        way = [*states.values()][path][1]
        out = []
        while way:
            out.append(way[1])
            way = way[0]
        return "".join(reversed(out))


class Scorer:
    def __init__(self, terms: list[tuple[bytes, int, float]], decoder: Decoder):
        self.decoder = decoder
        self.whole = {t: p for t, times, p in terms if not times}
        self.prefix: dict[bytes, list[float]] = {}
        for t, times, p in terms:
            if times:
                own = self.prefix.setdefault(t, [0.0] * (MOST_WORDS + 1))
                own[times:] = [max(p, x) for x in own[times:]]
        self.keys = {0: self._table([t for t in self.whole], 0)} | {n: self._table([t for t in self.prefix if len(t) == n], n) for n in PREFIXES}
        self.long = [t.decode("utf-8", "ignore") for t in self.whole if len(t) >= 4]
        # Terms without repeated letters: what words that hide one by repetition come down to.
        self.pressed = self._table(sorted({re.sub(rb"([a-z])\1+", rb"\1", t) for t in self.whole}), 0)

    @staticmethod
    def _prefix_hash(buf: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        acc, power = np.zeros(len(starts), np.uint64), np.uint64(1)
        for k in range(n):
            acc += _BYTE[buf[starts + k]] * power
            power = np.uint64(int(power) * int(_POLY) & 0xFFFFFFFFFFFFFFFF)
        return acc

    def _table(self, terms: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
        if not terms:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        buf = np.frombuffer(b" ".join(terms) + b" ", np.uint8)
        starts = np.cumsum([0, *(len(t) + 1 for t in terms[:-1])])
        keys = np.sort(word_spans(buf, np.array([0, len(buf)]))[0] if n == 0 else self._prefix_hash(buf, starts, n))
        maybe = np.zeros(1 << 16, bool)
        maybe[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
        return keys, maybe

    def evidence(self, words: set[bytes], n_words: int) -> list[float]:
        """What the words of a document that hold a term tell: numbers for the trees."""
        whole = [p for w in words if (p := self.whole.get(w, 0.0))]
        begun = Counter(w[:n] for w in words if w not in self.whole for n in PREFIXES if len(w) > n and w[:n] in self.prefix)
        shares = [self.prefix[t][min(n, MOST_WORDS)] for t, n in begun.items()]
        odd = sum(1 for w in words if w not in self.whole and any(self.prefix.get(w[:n], (0,) * 2)[1] for n in PREFIXES if len(w) > n))
        return [len(whole), max(begun.values(), default=0), max(whole, default=0.0), max(shares, default=0.0), odd, math.log1p(n_words), (len(whole) + odd) / max(n_words, 1), len(words)]

    def _among(self, h: np.ndarray, n: int) -> np.ndarray:
        keys, maybe = self.keys[n]
        if not len(keys):
            return np.zeros(0, np.int64)
        at = np.flatnonzero(maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
        return at[keys[np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)] == h[at]]

    def spots(self, low: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """Spans that look disguised."""
        if len(low) < 3:
            return []
        space, letter = SPACES[low], _LETTERS[low]
        odd = np.zeros(len(low), bool)
        odd[:-1] |= _LEET[low[:-1]] & letter[1:]
        odd[:-2] |= _ASCII[low[:-2]] & (low[:-2] == low[1:-1]) & (low[1:-1] == low[2:])
        # A sign or digit between letters on either side, as well as those with letters before and a leet sign after.
        odd[1:-1] |= letter[:-2] & _LEET[low[1:-1]] & (letter[2:] | (low[1:-1] < 0x3A) & (low[1:-1] > 0x2F))
        out = []
        # What is parted by white space or by the end of a text.
        gaps = np.flatnonzero(space)
        begins, stops = np.unique(np.concatenate([gaps + 1, offsets])), np.unique(np.concatenate([gaps, offsets[1:]]))
        found = np.flatnonzero(odd)
        for a in np.unique(begins[np.searchsorted(begins, found, "right") - 1]).tolist():
            out.append((a, int(stops[np.searchsorted(stops, a, "right")])))
        first = np.zeros(len(low) + 1, bool)
        first[offsets] = True
        first = first[:-1]
        # Single letters or signs for them, at least three, with one or two separators between.
        sign = _ASCII[low] | _LEET[low]
        solid = letter | sign | ((low >= 0x30) & (low <= 0x39))
        alone = sign.copy()
        alone[1:] &= ~solid[:-1] | first[1:]
        alone[:-1] &= ~solid[1:] | first[1:]
        at = np.flatnonzero(alone)
        step = np.diff(at)
        near = (step == 2) | (step == 3)
        if near.any():
            # Nothing but separators between, and no text's end.
            gap, texts = np.concatenate([[0], np.cumsum(~_GAP[low])]), np.cumsum(first)
            near &= (gap[at[1:]] - gap[at[:-1] + 1] == 0) & (texts[at[1:]] == texts[at[:-1]])
        ends = np.flatnonzero(np.append(~near, True))
        for a, b in zip(np.append(0, ends[:-1] + 1), ends) if len(at) else ():
            if b - a >= 2 and _ASCII[low[at[a : b + 1]]].any():
                out.append((int(at[a]), int(at[b]) + 1))
        return out

    def doubled(self, low: np.ndarray, offsets: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Numbers of the words, beyond ``known`` ones, that come down to a term when repeated letters are taken once."""
        same = np.zeros(len(low), bool)
        same[1:] = (low[1:] == low[:-1]) & _ASCII[low[1:]]
        # A text's first letter repeats nothing.
        same[offsets[offsets < len(low)]] = False
        if not same.any() or not len(self.pressed[0]):
            return np.zeros(0, np.int64)
        h = word_spans(low[~same], offsets - np.concatenate([[0], np.cumsum(same)])[offsets])[0]
        keys, maybe = self.pressed
        at = np.flatnonzero(maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
        at = at[keys[np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)] == h[at]]
        return at[~np.isin(at, known)]

    def features(self, column) -> np.ndarray:
        """EVIDENCE numbers for each text of an Arrow string column."""
        out = np.zeros((len(column), EVIDENCE))
        for first, _, buf, offsets in slices(column):
            low = lower(buf)
            h, starts, ends, rows = word_spans(low, offsets)
            raw = low.tobytes()
            found: dict[int, set[bytes]] = {}

            def put(at: int, word: bytes) -> None:
                found.setdefault(int(np.searchsorted(offsets, at, "right")) - 1, set()).add(word)

            hits = [self._among(h, 0)]
            length, acc, power, at = ends - starts, np.zeros(len(h), np.uint64), np.uint64(1), np.arange(len(h))
            for k in range(max(PREFIXES)):
                keep = length[at] > k
                at, acc = at[keep], acc[keep]
                acc = acc + _BYTE[low[starts[at] + k]] * power
                power = np.uint64(int(power) * int(_POLY) & 0xFFFFFFFFFFFFFFFF)
                if k + 1 in PREFIXES:
                    hits.append(at[self._among(acc, k + 1)])
            for k in np.unique(np.concatenate(hits)):
                put(starts[k], raw[starts[k] : ends[k]])
            again = self.doubled(low, offsets, hits[0])
            for a, b in [*self.spots(low, offsets), *zip(starts[again].tolist(), ends[again].tolist())]:
                word = raw[a:b].decode("utf-8", "ignore").strip(".,;:?\"'#&%*^~ ")
                restored = self.decoder.restore(word)
                if restored != word:
                    put(a, restored.encode())
                if " " in word or "." in word or "-" in word:
                    for t in self.long:
                        if t in restored:
                            put(a, t.encode())
            for k in range(len(offsets) - 1):
                n = int(rows[k + 1] - rows[k])
                if k in found:
                    out[first + k] = self.evidence(found[k], n)
                else:
                    out[first + k, 5] = math.log1p(n)
        return out


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = TRAIN_ROWS) -> tuple[Scorer, Trees]:
    """Terms from a bounded sample of labelled rows outside the held-out fifth; characters from all documents."""
    ready(docs.sparkSession)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"), 5, 0))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # At most `most` rows of two numbers are sent along.
    rows = without_copies(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "y"))
    rows = rows.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "text"), F.lit(2)).cast("int")).checkpoint()
    counts = count_trigrams(docs)

    def scorer_of(part: DataFrame) -> Scorer:
        total = {r["y"]: r["count"] for r in part.groupBy("y").count().collect()}
        toxic, other = total.get(1, 0), total.get(0, 0)

        def telling(explained: set[bytes] | None) -> list[tuple[bytes, int, float]]:
            least = F.lit(TELLING if explained is None else LEAST_SHARE)
            found = count_terms(part, explained).filter((F.col("toxic") >= LEAST_DOCS) & (F.col("toxic") + F.lit(0.2) >= least * (F.col("toxic") + F.col("other") + F.lit(0.4))))
            return [(bytes(t["term"]), t["times"], (t["toxic"] + 0.2) / (t["toxic"] + t["other"] + 0.4)) for t in found.collect() if ratio(t["toxic"], toxic, t["other"], other) >= LEAST_RATIO]

        terms = telling(None)
        terms = sorted(terms + telling({t for t, _, _ in terms}))
        return Scorer(terms, Decoder(counts, [(t.decode("utf-8", "ignore"), p) for t, times, p in terms if not times]))

    x, y = np.zeros((0, EVIDENCE)), np.zeros(0)
    for half in (0, 1):
        scorer = scorer_of(rows.filter(F.col("half") == half))
        found = rows.filter(F.col("half") != half).select("text", "y").mapInArrow(_evidence(scorer), "x array<double>, y int").toPandas()
        x, y = np.concatenate([x, np.array(found["x"].tolist(), float).reshape(-1, EVIDENCE)]), np.concatenate([y, found["y"].to_numpy(float)])
    order = np.lexsort((y, *x.T))
    return scorer_of(rows), fit(x[order], y[order], trees=40, depth=3)


def _evidence(scorer: Scorer):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = scorer.features(batch.column(0))
            column = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, EVIDENCE, dtype=np.int32)), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([column, batch.column(1)], ["x", "y"])

    return run


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """docs' columns (or those of keep) and ``score``, ``predicted``."""
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    scorer, trees = learn(docs.select("doc_id", F.col(text).alias("text")), labels)
    source = docs.select(*dict.fromkeys([*names, text]))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in source.select(*names).dtypes), "score double", "predicted int"])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            score = trees.score(scorer.features(batch.column(batch.schema.get_field_index(text))))
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(score), pa.array((score >= threshold).astype(np.int32))], [*names, "score", "predicted"])

    return source.mapInArrow(run, schema)
