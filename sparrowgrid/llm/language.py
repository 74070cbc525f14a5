"""Operator 10: language identification by multilingual mixture inference.

Each language has a distribution over hashed byte trigrams of lower-cased words, counted over all training documents. A document is
taken as a mixture of languages; expectation-maximisation estimates its proportions from its trigrams' likelihoods.
The language set is the one of the highest penalised likelihood: for k = 1, 2, ... the k largest languages are refitted, and
each language beyond the first has to earn ``PENALTY`` times the logarithm of the number of trigrams.

A model holds at most ``MOST_LANGUAGES`` languages, those with the most training rows (ties by name): this is the bound of the classifier's fit and of what is sent along
(128 KB a language). Of equal likelihoods and shares the language that is first by name counts.

Edge cases: null texts and texts without a letter (Unicode category L) are ``und`` with score 0 and no languages; without training rows all are ``und``;
rows with a null doc_id or lang are never learned from; repeated rows repeat; texts of any length are read whole; columns called like those added are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import held_out
from .textnp import LOWER, slices

#: Hash buckets of trigrams; a fixed table that all trigrams are counted in.
BUCKETS = 1 << 15
PENALTY = 3.0
ROUNDS = 12
#: Digits, white space and ASCII punctuation end a word and count as one boundary byte.
_FOLD = LOWER.copy()
_FOLD[[*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20
#: Languages that a model holds.
MOST_LANGUAGES = 512


def has_letter(raw: bytes) -> bool:
    """Whether a text has a character of Unicode category L; bytes cut in two count as none."""
    import regex

    return regex.search(r"\p{L}", raw.decode("utf-8", "ignore")) is not None


def grams(buf: np.ndarray) -> np.ndarray:
    """Buckets of all byte trigrams that do not lie wholly in white space."""
    x = _FOLD[buf].astype(np.uint32)
    if len(x) < 3:
        x = np.concatenate([np.full(1, 0x20, np.uint32), x, np.full(2, 0x20, np.uint32)])
    key = x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]
    key = key[(x[1:-1] != 0x20)]
    return ((key * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int64)


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = MOST_LANGUAGES) -> DataFrame:
    """lang, bucket, n over all rows of the ``most`` languages with the most rows; each task adds up before anything is shuffled."""
    known = docs.filter(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "lang").limit(most)
    names = sorted(r["lang"] for r in known.collect())
    place = {name: k for k, name in enumerate(names)}

    def run(batches):
        import pyarrow as pa

        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            langs = [place.get(x) for x in batch.column(1).to_pylist()]
            for first, end, buf, offsets in slices(batch.column(0)):
                for k in range(first, end):
                    if langs[k] is not None:
                        own = totals.setdefault(langs[k], np.zeros(BUCKETS, np.int64))
                        own += np.bincount(grams(buf[offsets[k - first] : offsets[k - first + 1]]), minlength=BUCKETS)
        for which, own in totals.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([names[which]] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(own[at])], ["lang", "bucket", "n"])

    return docs.select(text, lang).mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fitted(p: np.ndarray, c: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Shares of the languages (rows of p) by expectation-maximisation, and their log-likelihood. c: counts of the trigrams (columns)."""
    share, total = start, c.sum()
    for _ in range(rounds):
        new = share * (p @ (c / (share @ p))) / total
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(c @ np.log(share @ p))


def mixture(log_p: np.ndarray, p: np.ndarray, c: np.ndarray) -> tuple[list[int], list[float]]:
    """The language set of the highest penalised likelihood, largest share first, and its shares. p: languages x distinct trigrams; c: their counts."""
    alone = log_p @ c
    if len(p) == 1:
        return [0], [1.0]
    start = np.exp((alone - alone.max()) / max(c.sum(), 1) * 4)
    share, _ = fitted(p, c, start / start.sum())
    order = np.argsort(-share, kind="stable")
    single = int(alone.argmax())
    best, found, parts = float(alone[single]), [single], [1.0]
    for k in range(2, len(p) + 1):
        rows = order[:k]
        if share[rows[-1]] < 0.02:
            break
        own, fit = fitted(p[rows], c, share[rows] / share[rows].sum())
        fit -= PENALTY * (k - 1) * np.log(c.sum() + 1)
        if fit <= best:
            break
        by_share = np.lexsort((rows, -own))
        best, found, parts = fit, rows[by_share].tolist(), own[by_share].tolist()
    return found, parts


def identify(df: DataFrame, counts: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """df's columns (or those of keep) and ``lang_pred``, ``score`` (the main language and its share), ``languages`` (all of the set, largest share first); counts as ``count_grams`` gives them."""
    added = ("lang_pred", "score", "languages")
    names = [c for c in (df.columns if keep is None else keep) if c not in added]
    # At most MOST_LANGUAGES x BUCKETS rows.
    table = counts.toPandas()
    langs = sorted(table["lang"].unique())
    n = np.zeros((len(langs), BUCKETS))
    if langs:
        n[np.searchsorted(langs, table["lang"]), table["bucket"]] = table["n"]
        n = np.log((n + 0.5) / (n + 0.5).sum(axis=1, keepdims=True))
    model = df.sparkSession.sparkContext.broadcast((langs, n.astype(np.float32)))
    source = df.select(*dict.fromkeys([*names, text]))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in source.select(*names).dtypes), "lang_pred string, score double, languages array<string>"])

    def run(batches):
        import pyarrow as pa

        langs, log_p = model.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            pred, score, every = ["und"] * len(column), [0.0] * len(column), [[] for _ in range(len(column))]
            for first, end, buf, offsets in slices(column) if langs else ():
                for k in range(first, end):
                    own = buf[offsets[k - first] : offsets[k - first + 1]]
                    if not has_letter(own[:400].tobytes()) and not has_letter(own.tobytes()):
                        continue
                    c = np.bincount(grams(own), minlength=BUCKETS)
                    at = np.flatnonzero(c)
                    own_p = log_p[:, at].astype(float)
                    found, parts = mixture(own_p, np.exp(own_p), c[at].astype(float))
                    pred[k], score[k], every[k] = langs[found[0]], min(1.0, parts[0]), [langs[x] for x in found]
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(every, pa.list_(pa.string()))], [*names, *added])

    return source.mapInArrow(run, schema)


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages; learned from the rows whose crc32 remainder by 4 is not 2."""
    out = held_out(F.col("doc_id"), 4, 2)
    counts = count_grams(docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~out))
    return identify(docs, counts, keep=["doc_id"]).select("doc_id", out.alias("held_out"), "lang_pred", "score", "languages")
