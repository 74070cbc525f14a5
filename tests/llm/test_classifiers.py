from __future__ import annotations

import re

import numpy as np

from conftest import DATA
from sparrowgrid.llm import language, quality, toxicity
from sparrowgrid.llm.queries import op6_quality, op7_toxicity, op10_language

from .conftest import ODD

LARGER = DATA.replace("0.001", "0.01")


def area(y, p):
    order = np.argsort(p, kind="stable")
    ranks = np.empty(len(p))
    ranks[order] = np.arange(1, len(p) + 1)
    for v in np.unique(p):
        ranks[p == v] = ranks[p == v].mean()
    ones = y.sum()
    return (ranks[y == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


def held_out(spark, query, column):
    rows = query(spark, LARGER)
    met = rows.join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").toPandas()
    own = met[met.held_out]
    return own[column].to_numpy(), own.score.to_numpy(), own.predicted.to_numpy(), rows


def test_quality(spark):
    y, p, predicted, rows = held_out(spark, op6_quality, "quality")
    assert area(y, p) > 0.97 and (predicted == y).mean() > 0.95
    assert rows.count() == spark.read.parquet(f"{LARGER}/documents.parquet").count()


def test_toxicity(spark):
    y, p, predicted, _ = held_out(spark, op7_toxicity, "toxic")
    assert area(y, p) > 0.85 and predicted[y == 0].mean() < 0.05 and predicted[y == 1].mean() > 0.6


def test_language(spark):
    rows = op10_language(spark, LARGER).join(spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    own = rows[rows.held_out]
    assert (own.lang == own.lang_pred).mean() > 0.98


def test_languages_of_a_mixture():
    p = np.array([[0.5, 0.4, 0.05, 0.05], [0.05, 0.05, 0.4, 0.5]])
    found, shares = language.mixture(np.log(p), p, np.array([300.0, 200, 90, 110]))
    assert found == [0, 1] and 0.6 < shares[0] < 0.85
    assert language.mixture(np.log(p), p, np.array([300.0, 300, 30, 30])) == ([0], [1.0])
    # Equal likelihoods: the first.
    same = np.array([[0.5, 0.5], [0.5, 0.5]])
    assert language.mixture(np.log(same), same, np.array([5.0, 5.0])) == ([0], [1.0])


def plain_em(p, c, rows):
    """Shares and likelihood of a language set, by the textbook: expected counts of each trigram in each language, a thousand rounds."""
    share = {r: 1 / len(rows) for r in rows}
    for _ in range(1000):
        got = dict.fromkeys(rows, 0.0)
        for g, n in enumerate(c):
            whole = sum(share[r] * p[r][g] for r in rows)
            for r in rows:
                got[r] += n * share[r] * p[r][g] / whole
        share = {r: got[r] / sum(c) for r in rows}
    return share, sum(n * np.log(sum(share[r] * p[r][g] for r in rows)) for g, n in enumerate(c))


def test_language_sets_against_all_subsets():
    from itertools import combinations

    rng = np.random.default_rng(12)
    right = 0
    for _ in range(40):
        p = rng.dirichlet(np.full(12, 0.4), 3) * 0.98 + 0.02 / 12
        truth = rng.choice([0, 1, 2], rng.integers(1, 3), replace=False)
        shares = rng.dirichlet(np.full(len(truth), 3.0))
        c = rng.multinomial(400, shares @ p[truth] / (shares @ p[truth]).sum()).astype(float)
        best = max((plain_em(p, c, rows)[1] - language.PENALTY * (len(rows) - 1) * np.log(c.sum() + 1), rows) for k in (1, 2, 3) for rows in combinations(range(3), k))
        found, parts = language.mixture(np.log(p), p, c)
        plain, fit = plain_em(p, c, tuple(found))
        assert np.allclose([plain[r] for r in found], parts, atol=0.05)
        # The set found is the best of all subsets, or as good but for a few units of likelihood.
        assert fit - language.PENALTY * (len(found) - 1) * np.log(c.sum() + 1) > best[0] - 8
        right += sorted(found) == list(best[1])
    assert right >= 37


def test_more_languages_than_a_model_holds(spark):
    rows = [("the cat and the hat", "en")] * 9 + [("der hund und die katze", "de")] * 8 + [(f"x{k} y{k}", f"dirty{k}") for k in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert {r.lang for r in language.count_grams(docs, most=2).select("lang").distinct().collect()} == {"en", "de"}


def test_letters_are_letters(docs, spark):
    counts = language.count_grams(spark.createDataFrame([("the cat and the hat", "en")], "text string, lang string"))
    texts = ["²³½", "Ⅷ", "123 !_", "७८", "a", "ª", "漢", "1 é"]
    out = {r.doc_id: (r.lang_pred, r.languages) for r in language.identify(docs(list(enumerate(texts))), counts).collect()}
    assert [out[k][0] for k in range(8)] == ["und"] * 4 + ["en"] * 4 and out[0][1] == [] and out[4][1] == ["en"]


def test_trees_walk_as_they_say():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality.fit(x, y, trees=30, depth=3)
    assert area(y, model.score(x)) > 0.95
    raw = np.full(len(x), model.base)
    for t in range(len(model.feature)):
        for k in range(len(x)):
            node = 0
            for _ in range(model.depth):
                node = 2 * node + 1 + int(x[k, model.feature[t, node]] > model.threshold[t, node])
            raw[k] += model.value[t, node - (2**model.depth - 1)]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-raw)))


def test_statistics_match_plain_counts():
    import pyarrow as pa

    text = "The THE the, end!\nTwo lines | here 12"
    row = dict(zip(quality.FEATURES, quality.features_of(pa.array([text, None, ""]))[0]))
    words = re.findall(r"\S+", text)
    assert np.isclose(row["log_words"], np.log1p(len(words))) and np.isclose(row["upper"], sum(c.isupper() for c in text) / len(text))
    assert np.isclose(row["distinct_words"], len({w.lower() for w in words}) / len(words)) and np.isclose(row["repeated_next"], 1 / len(words))


def plain_fit(x, y, trees, depth, rate, bins, least, shrink):
    """Boosting node by node, each cut tried on the rows themselves."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    share = (y.sum() + 0.5) / (len(y) + 1)
    raw = np.full(len(y), np.log(share / (1 - share)))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        parts = [np.arange(len(y))]
        for _ in range(depth):
            below = []
            for rows in parts:
                best, split = 0.0, (0, np.inf)
                for j, c in enumerate(cuts):
                    for cut in c:
                        left = x[rows, j] <= cut
                        gl, hl, gr, hr = g[rows][left].sum(), h[rows][left].sum(), g[rows][~left].sum(), h[rows][~left].sum()
                        gain = gl**2 / (hl + shrink) + gr**2 / (hr + shrink) - (gl + gr) ** 2 / (hl + hr + shrink) if hl >= least and hr >= least else 0.0
                        if gain > best + 1e-9:
                            best, split = gain, (j, cut)
                go_left = x[rows, split[0]] <= split[1]
                below += [rows[go_left], rows[~go_left]]
            parts = below
        for rows in parts:
            raw[rows] -= rate * g[rows].sum() / (h[rows].sum() + shrink)
    return 1 / (1 + np.exp(-raw))


def test_fit_against_plain_boosting():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(150, 4)).round(1)
    # Ties: a feature twice, and one that never changes.
    x[:, 2], x[:, 3] = x[:, 0], 7.0
    y = ((x[:, 0] + x[:, 1] > 0) ^ (rng.random(150) < 0.1)).astype(float)
    for depth in (1, 3):
        model = quality.fit(x, y, trees=6, depth=depth, bins=16)
        assert np.allclose(model.score(x), plain_fit(x, y, 6, depth, 0.2, 16, 1.0, 1.0))
        assert not (model.feature == 2).any() and not (model.feature == 3).any()


def test_viterbi_against_all_paths():
    from itertools import product

    rng = np.random.default_rng(7)
    decoder = toxicity.Decoder(rng.integers(0, 50, (toxicity.CLASSES,) * 3).astype(float), [("idiot", 3.0), ("moron", 1.0)])
    letter = lambda c: ord(c) - 96 if "a" <= c <= "z" else 27

    def price(out, channel):
        c = [0, 0, *map(letter, out), 0]
        return channel + sum(decoder.cost[x][y][z] for x, y, z in zip(c, c[1:], c[2:]))

    for spot in ["1d10t", "i d i 0 t", "idiiot", "m0r0n", "6o0d", "aab", "a.a", "5$", "x", "é1", "t_0-o"]:
        options = []
        for k, ch in enumerate(spot):
            if ch.isalpha():
                options.append([(ch, 0.0)] + ([("", toxicity.REPEAT_COST)] if k and spot[k - 1] == ch else []))
            elif ch in toxicity.LEET:
                options.append([(x, toxicity.LEET_COST) for x in toxicity.LEET[ch]] + [("", toxicity.DROP_COST)])
            else:
                options.append([("", toxicity.GAP_COST)])
        best = min(price("".join(o for o, _ in way), sum(c for _, c in way)) for way in product(*options))
        restored = decoder.restore(spot)
        own = min(sum(c for _, c in way) for way in product(*options) if "".join(o for o, _ in way) == restored)
        assert abs(price(restored, own) - best) < 1e-9, spot


def test_disguised_words_are_restored(spark, docs):
    rng = np.random.default_rng(5)
    syllables = ["ba", "ren", "to", "li", "sam", "due", "or", "ka"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    rows = []
    for k in range(400):
        text = [word() for _ in range(40)]
        text[rng.integers(40)] = rng.choice(["idiot", "moron"]) if k % 4 == 0 else "weather"
        rows.append((k, " ".join(text)))
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int")
    odd = [(1000, "you are an 1d10t truly"), (1001, "such an i d i o t here"), (1002, "what an idiooooot he is"), (1003, "a m0r0n."), (1004, "the weather is 10 degrees, room a1b"), (1005, "w w w and soooo on"),
           (1006, "one i d 1 0 t more"), (1007, "1-d-1-0-t said"), (1008, "an i  d  i  o  t"), (1009, "what an iddiot"), (1010, "such a mm00r0n"), (1011, "a m.0_r - 0. n"), (1012, "1 2 3 4 5 and a b c d, 7 - 8 - 9"), (1013, "a good book, all well")]
    out = {r.doc_id: r.predicted for r in toxicity.classify(docs(rows + odd), labels).collect()}
    assert [out[k] for k, _ in odd[:-4]] == [1, 1, 1, 1, 0, 0, 1, 1, 1, 1] and out[1010] == 1 and out[1012] == out[1013] == 0
    assert all(out[k] == int(k % 4 == 0) for k in range(400))


def test_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (quality.classify(docs(ODD, True), none), toxicity.classify(docs(ODD, True), none)):
        rows = out.collect()
        assert len(rows) == len(ODD) and {round(r.score, 9) for r in rows} == {0.5} and rows[0].labels == "kept"


def test_odd_tables(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 8)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for out in (quality.classify(docs(ODD), labels), toxicity.classify(docs(ODD), labels)):
        assert all(0 <= r.score <= 1 for r in out.collect()) and out.count() == len(ODD)
    assert quality.classify(docs([]), labels).count() == 0 and toxicity.classify(docs([]), labels).count() == 0
    kept = quality.keep_good(docs(ODD, True), labels)
    assert kept.columns == docs(ODD, True).columns
    counts = language.count_grams(spark.createDataFrame([("the cat and the hat", "en"), ("der hund und die katze", "de")], "text string, lang string"))
    out = language.identify(docs([*ODD, (8, "und die der katze hund"), (9, "1234 !!")], True), counts).collect()
    assert {r.doc_id: r.lang_pred for r in out if r.doc_id in (1, 2, 3, 8, 9)} == {1: "und", 2: "und", 3: "und", 8: "de", 9: "und"}
    assert all(r.ids == "kept" for r in out)
    assert {r.lang_pred for r in language.identify(docs(ODD), counts.limit(0)).collect()} == {"und"}
