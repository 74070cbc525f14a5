"""Operator 9: license scans by an exact set-similarity join of text blocks with license templates.

Blocks are the lines, and, so that wrapped texts are found, every window of consecutive words of a text, whatever lines it spans, of up to the template's
number of words over t. A template's distinct words are ordered by their frequency over all documents, rarest first. A block contains
a template when at least ceil(t * |T|) of its |T| words occur in it; so it must hold one of the first
|T| - ceil(t * |T|) + 1 words (prefix filter), have at least ceil(t * |T|) words (length filter), and after the i-th of the ordered words the
matches so far plus those still to come must reach the bound (positional filter). A window must hold ceil(t * |T|) places of template words, repeated ones
included (length filter). What is left is counted exactly.

Fixed phrases are found beside it wherever their words stand consecutively, across lines too.

An index from prefix words to templates tells which templates a block is tried against. The template table is a parameter; it is sent along in blocks of at most
``MOST_TEMPLATE_WORDS`` words (a longer template is a block of its own), each of which takes a pass over the texts, so that any table gives the same labels.

Edge cases: columns called like those added are replaced; a null text is empty; texts without words have null first_word and last_word and empty labels; repeated
rows repeat; lines and texts of any length are read whole.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free, through_parquet
from .textnp import NOT_ALNUM, slices, words

#: Phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Label and words of license statements.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd-3", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
THRESHOLD = 0.8
#: Words of the template table that are sent along at a time.
MOST_TEMPLATE_WORDS = 1_000_000
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


def hash_words(items: list[str]) -> np.ndarray:
    """The hashes that textnp.words gives these words."""
    raw = [w.encode() for w in items]
    ends = np.cumsum([0, *(len(w) + 1 for w in raw)])
    return words(np.frombuffer(b" ".join(raw) + b" ", np.uint8), np.array([0, ends[-1]]), NOT_ALNUM)[0] if raw else np.zeros(0, np.uint64)


def count_words(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """How often each word of a small vocabulary occurs in all documents; tasks add up first."""
    names = sorted(set(vocabulary))
    key = hash_words(names)
    order = np.argsort(key)

    def run(batches):
        import pyarrow as pa

        total = np.zeros(len(names), np.int64)
        for batch in batches:
            for _, _, buf, offsets in slices(batch.column(0)):
                h = words(buf, offsets, NOT_ALNUM)[0]
                at = np.minimum(np.searchsorted(key[order], h), len(names) - 1)
                total += np.bincount(order[at[key[order][at] == h]], minlength=len(names))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(total)], ["word", "n"])

    return dict(docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n")).collect()) if names else {}


class Scanner:
    """Templates with words ordered by frequency, and phrases; ``scan`` reads an Arrow string column."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str], counts: dict[str, int], threshold: float):
        self.templates, self.spans = [], []
        for label, text in templates:
            distinct = sorted(dict.fromkeys(words_of(text)), key=lambda w: (counts.get(w, 0), w))
            need = -(-int(round(threshold * 1000)) * len(distinct) // 1000)
            if distinct:
                self.templates.append((label, hash_words(distinct), need, len(distinct) - need + 1))
                self.spans.append(-(-len(words_of(text)) * 1000 // int(round(threshold * 1000))))
        self.phrases = [(label, hash_words(words_of(text))) for text, label in phrases.items()]
        # Prefix words with their templates, by word.
        self.prefix = np.concatenate([h[:k] for _, h, _, k in self.templates]) if self.templates else np.zeros(0, np.uint64)
        self.of = np.repeat(np.arange(len(self.templates)), [k for _, _, _, k in self.templates])
        order = np.argsort(self.prefix, kind="stable")
        self.prefix, self.of = self.prefix[order], self.of[order]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.prefix & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.known = np.zeros(1 << 16, bool)
        for _, t, _, _ in self.templates:
            self.known[(t & np.uint64(0xFFFF)).astype(np.int64)] = True

    def tried(self, h: np.ndarray) -> np.ndarray:
        """Templates that have one of these words in their prefix."""
        h = np.unique(h)
        a, b = np.searchsorted(self.prefix, h, "left"), np.searchsorted(self.prefix, h, "right")
        return np.unique(np.concatenate([self.of[x:y] for x, y in zip(a, b)])) if len(h) else np.zeros(0, np.int64)

    def windows(self, h: np.ndarray, row_of: np.ndarray, tried: np.ndarray):
        """(row, label, containment) of the windows of words that contain one of the templates to be tried."""
        known = np.flatnonzero(self.known[(h & np.uint64(0xFFFF)).astype(np.int64)])
        for which in tried.tolist():
            (label, t, need, _), span = self.templates[which], self.spans[which]
            at = known[np.isin(h[known], t)]
            if len(at) < need:
                continue
            # A window may as well begin at a template's word.
            start = np.flatnonzero((at[need - 1 :] - at[: len(at) - need + 1] < span) & (row_of[at[need - 1 :]] == row_of[at[: len(at) - need + 1]]))
            for k in start.tolist():
                end = int(np.searchsorted(at, at[k] + span))
                inside = at[k:end]
                found = len(np.unique(h[inside[row_of[inside] == row_of[at[k]]]]))
                if found >= need:
                    yield int(row_of[at[k]]), label, found / len(t)

    def scan(self, column) -> list[tuple]:
        """Per text: n_words, n_base, first_word, last_word, base labels, labels, score."""
        out: list[tuple] = []
        for first, end, buf, offsets in slices(column):
            h, starts, _, rows = words(buf, offsets, NOT_ALNUM)
            row_of = np.repeat(np.arange(end - first), np.diff(rows))
            base: dict[int, list[tuple[int, str]]] = {}
            for label, p in self.phrases:
                at = np.flatnonzero(h == p[0]) if len(p) else np.zeros(0, np.int64)
                at = at[at + len(p) <= len(h)]
                for k in range(1, len(p)):
                    at = at[h[at + k] == p[k]]
                for a in at[row_of[at] == row_of[at + len(p) - 1]] if len(at) else ():
                    base.setdefault(int(row_of[a]), []).append((int(a - rows[row_of[a]]), label))
            more: dict[int, dict[str, float]] = {}
            hit = np.flatnonzero(self.maybe[(h & np.uint64(0xFFFF)).astype(np.int64)])
            hit = hit[np.isin(h[hit], self.prefix)]
            if len(hit):
                breaks = np.flatnonzero(buf == 10)
                # A line's end, or a text's: whichever bounds the block that a word stands in.
                edges = np.union1d(np.union1d(breaks, offsets), [0, len(buf)])
                line = np.searchsorted(edges, starts[hit], "right")
                for own_hits in np.split(hit, np.flatnonzero(np.diff(line)) + 1):
                    a = own_hits[0]
                    e = int(np.searchsorted(edges, starts[a], "right"))
                    lo, hi = np.searchsorted(starts, [edges[e - 1], edges[e] if e < len(edges) else len(buf)])
                    block = np.unique(h[lo:hi])
                    for which in self.tried(h[own_hits]).tolist():
                        label, t, need, prefix = self.templates[which]
                        if len(block) < need:
                            continue
                        found = 0
                        for k, w in enumerate(t):
                            i = np.searchsorted(block, w)
                            found += bool(i < len(block) and block[i] == w)
                            if (k + 1 == prefix and not found) or found + len(t) - k - 1 < need:
                                break
                        else:
                            own = more.setdefault(int(row_of[a]), {})
                            own[label] = max(own.get(label, 0.0), found / len(t))
            for k, label, part in self.windows(h, row_of, self.tried(h[hit])):
                own = more.setdefault(k, {})
                own[label] = max(own.get(label, 0.0), part)
            for k in range(end - first):
                places, extra = base.get(k, []), more.get(k, {})
                labels = {x for _, x in places}
                at = [a for a, _ in places]
                out.append((int(rows[k + 1] - rows[k]), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | extra.keys())), 1.0 if labels else max(extra.values(), default=0.0)))
        return out


def scan(df: DataFrame, templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None, threshold: float = THRESHOLD, text: str = "text", keep: list[str] | None = None, most_words: int = MOST_TEMPLATE_WORDS) -> DataFrame:
    """df's columns (or those of keep) and n_words, n_base, first_word, last_word, base_labels, labels, score."""
    templates, phrases = TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases
    blocks, size = [[]], 0
    for label, t in templates:
        n = len(words_of(t))
        if size and size + n > most_words:
            blocks.append([])
            size = 0
        blocks[-1].append((label, t))
        size += n
    added = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string", "labels": "string", "score": "double"}
    names = [c for c in (df.columns if keep is None else keep) if c not in added]
    held = free([*names, *added], "_scanned")
    source = df.select(*names, F.col(text).alias(held))
    written: list[str] = []
    for k, block in enumerate(blocks):
        # Before each further pass, what was found is written with the texts.
        out = _passed(source if k == 0 else through_parquet(source, "licenses", written), held, names, added, block, phrases if k == 0 else {}, threshold)
        source = out
    return out.select(*names, *added)


def _passed(source: DataFrame, text: str, names: list[str], added: dict[str, str], templates: list, phrases: dict[str, str], threshold: float) -> DataFrame:
    """source with what these templates and phrases tell besides what it says already."""
    scanner = Scanner(templates, phrases, count_words(source, [w for _, t in templates for w in words_of(t)], text), threshold)
    before = all(c in source.columns for c in added)
    columns = source.columns
    schema = ", ".join([*(f"`{c}` {t}" for c, t in source.select(*names, text).dtypes), *(f"{c} {t}" for c, t in added.items())])

    def joined(old: tuple, new: tuple) -> tuple:
        labels = sorted({*filter(None, old[5].split(",")), *filter(None, new[5].split(","))})
        return (*old[:5], ",".join(labels), max(old[6], new[6]))

    def run(batches):
        import pyarrow as pa

        types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
        for batch in batches:
            found = scanner.scan(batch.column(columns.index(text)))
            if before:
                found = [joined(o, n) for o, n in zip(zip(*(batch.column(columns.index(c)).to_pylist() for c in added)), found)]
            found = [*zip(*found)] or [()] * len(added)
            yield pa.RecordBatch.from_arrays([*(batch.column(columns.index(c)) for c in (*names, text)), *(pa.array(x, types[t]) for x, t in zip(found, added.values()))], [*names, text, *added])

    return source.mapInArrow(run, schema)
