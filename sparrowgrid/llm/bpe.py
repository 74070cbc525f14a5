"""Operator 1: byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

A pretoken's symbols are leaves; leaf i of the tree holds (rank of the pair that starts at symbol i, i), so the root is
the leftmost pair of the lowest rank. A merge changes three leaves and their ancestors: O(log n) work, until the root
is infinite. Short pretokens are merged many at a time: their trees are rows of one numpy array, and each round applies
every row's root merge at once. Long pretokens use one tree in Python lists, O(n log n) however long they are.

The vocabulary is a file of the public tokenizers; its path is a parameter, and it is read where it is used.

Edge cases: a null text is encoded as the empty text (no ids, decoded ""); texts of any length are encoded whole;
repeated rows give repeated results; an empty table gives an empty table. Columns named as the outputs are replaced,
other columns are kept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice, pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import give_back

_INF = np.int64(1) << np.int64(62)
#: Pretokens of up to so many bytes are merged by rows; it only decides how the same tree is held.
ROW_BYTES = 64
#: Pretokens remembered by a Python worker, but for those of the texts in hand.
REMEMBERED = 250_000

#: Pretokens or ids whose ids or bytes are looked up at once.
SPANS = 1 << 18


class _Places(dict):
    """Places of pretokens in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        return place


def _taken(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What stands in the given spans of values, one span after another: some spans at a time, so that a very long text takes little more."""
    out, at = np.empty(int(size.sum()), values.dtype), 0
    for k in range(0, len(size), SPANS):
        s, n = start[k : k + SPANS], size[k : k + SPANS]
        end = np.cumsum(n)
        out[at : at + int(end[-1])] = values[np.arange(int(end[-1])) + np.repeat(s - (end - n), n)]
        at += int(end[-1])
    return out


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def check_settings(spec: dict) -> None:
    """ValueError for a vocabulary file that asks for anything but plain byte-level BPE: it would give other ids."""
    model, before, after = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
    flags = ("single_word", "lstrip", "rstrip", "normalized")
    odd = {
        "model": model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")),
        "normalizer": spec.get("normalizer") is not None, "pre_tokenizer": before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True),
        "decoder": after.get("type") != "ByteLevel", "added_tokens": any(t.get(k) for t in spec.get("added_tokens", []) for k in flags),
    }
    if wrong := [name for name, on in odd.items() if on]:
        raise ValueError(f"not a plain byte-level BPE file: {', '.join(wrong)}")


class Bpe:
    """A byte-level BPE vocabulary: ``encode_words`` for pretokens, ``encode`` and ``decode`` for texts."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        check_settings(spec)
        letters, vocab = _byte_letters(), spec["model"]["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.byte_id = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.byte_id[b] = vocab[c]
        merges = [m if isinstance(m, (list, tuple)) else m.split(" ") for m in spec["model"]["merges"]]
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        pairs = {(vocab[a], vocab[b]): rank for rank, (a, b) in reversed([*enumerate(merges)])}
        self.rank = pairs
        keys = np.array([a << 20 | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.fromiter(pairs.values(), np.int64, len(pairs))[order]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # White space as the Unicode property; regex's own \s is wider by the separators U+001C to U+001F.
        s = r"\p{White_Space}"
        self.pattern = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{s}\p{{L}}\p{{N}}]+|{s}+(?!\P{{White_Space}})|{s}+")
        most = max(self.bytes_of) + 1
        self.size_of = np.array([len(self.bytes_of.get(i, b"")) for i in range(most)], np.int64)
        self.begin_of = np.cumsum(self.size_of) - self.size_of
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(most)), np.uint8)
        self.forget()

    def forget(self) -> None:
        """No pretoken is remembered: places of pretokens, and by place where their ids begin and how many there are."""
        self.known, self.ids_of = _Places(), np.zeros(0, np.int32)
        self.first_of = self.count_of = np.zeros(0, np.int64)

    def _leaf(self, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.ranks[i] << 16 | at, _INF)

    def _rows(self, words: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Words of 2 to width + 1 bytes, width a power of two: one tree of width leaves a row."""
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        sym = np.full((n, width + 2), -1, np.int64)
        raw = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        row = np.repeat(np.arange(n), size)
        col = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
        sym[row, col] = raw
        nxt = np.broadcast_to(np.arange(1, width + 3), (n, width + 2)).copy()
        prv = np.broadcast_to(np.arange(-1, width + 1), (n, width + 2)).copy()
        tree = np.full((n, 2 * width), _INF, np.int64)
        pair = col + 1 < size[row]
        r, c = row[pair], col[pair]
        tree[r, width + c] = self._leaf(sym[r, c], sym[r, c + 1], c)
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level = half
        live = np.zeros((n, width + 2), bool)
        live[row, col] = True
        r = np.flatnonzero(tree[:, 1] < _INF)
        while len(r):
            root = tree[r, 1]
            i = root & 0xFFFF
            j = nxt[r, i]
            k = nxt[r, j]
            sym[r, i] = self.merged[root >> 16]
            live[r, j] = False
            nxt[r, i] = k
            inner = k < size[r]
            prv[r[inner], k[inner]] = i[inner]
            p = prv[r, i]
            tree[r, width + np.minimum(j, width - 1)] = np.where(j < width, _INF, tree[r, 2 * width - 1])
            kk = np.where(inner, k, 0)
            tree[r, width + i] = np.where(inner, self._leaf(sym[r, i], sym[r, kk], i), _INF)
            back = p >= 0
            rb, pb = r[back], p[back]
            tree[rb, width + pb] = self._leaf(sym[rb, pb], sym[rb, i[back]], pb)
            rows = np.concatenate([r, r, rb])
            node = (width + np.concatenate([i, np.minimum(j, width - 1), pb])) >> 1
            while node[0] >= 1 if len(node) else False:
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                node = node >> 1
            r = r[tree[r, 1] < _INF]
        ids = sym[live].tolist()
        end = np.cumsum(live.sum(axis=1)).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *end[:-1]], end)]

    def _one(self, word: bytes) -> tuple[int, ...]:
        """A word of any length by one tree."""
        n = len(word)
        width = 1 << max(1, (n - 1).bit_length())
        inf = 1 << 62
        shift = width.bit_length() + 1
        low = (1 << shift) - 1
        rank, merged = self.rank, self.merged
        sym = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        nxt, prv = [*range(1, n + 1)], [*range(-1, n - 1)]
        tree = [inf] * (2 * width)
        for i in range(n - 1):
            if (x := rank.get((sym[i], sym[i + 1]))) is not None:
                tree[width + i] = x << shift | i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(i: int, value: int) -> None:
            node = width + i
            tree[node] = value
            node >>= 1
            while node:
                value = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == value:
                    return
                tree[node] = value
                node >>= 1

        def leaf(i: int, j: int) -> int:
            x = rank.get((sym[i], sym[j]))
            return inf if x is None else x << shift | i

        while tree[1] < inf:
            i = tree[1] & low
            j = nxt[i]
            k = nxt[j]
            sym[i] = int(merged[tree[1] >> shift])
            sym[j] = -1
            nxt[i] = k
            put(j, inf)
            if k < n:
                prv[k] = i
            put(i, leaf(i, k) if k < n else inf)
            if (p := prv[i]) >= 0:
                put(p, leaf(p, i))
        return tuple(x for x in sym if x >= 0)

    def encode_words(self, words: list[bytes]) -> list[tuple[int, ...]]:
        out: list[tuple[int, ...]] = [()] * len(words)
        groups: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            if len(w) > ROW_BYTES:
                out[k] = self._one(w)
            elif len(w) == 1:
                out[k] = (int(self.byte_id[w[0]]),)
            elif w:
                groups.setdefault(max(2, 1 << (len(w) - 2).bit_length()), []).append(k)
        for width, members in groups.items():
            step = (1 << 19) // width
            for a in range(0, len(members), step):
                part = members[a : a + step]
                for k, ids in zip(part, self._rows([words[k] for k in part], width)):
                    out[k] = ids
        return out

    def pretokens(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after another, and the texts' offsets into them; what is new is merged together."""
        if len(self.known) > REMEMBERED:
            self.forget()
        before, ends, found = len(self.known), [0], []
        for t in texts:
            parts = self.special_pattern.split(t) if self.special_pattern and any(x in t for x in self.special) else (t,)
            for k, p in enumerate(parts):
                # A special token is no pretoken: texts are parted at all of them.
                found.append(self.pretokens(p) if k % 2 == 0 else (p,))
            ends.append(ends[-1] + sum(map(len, found[-len(parts) :])))
        place = np.fromiter(map(self.known.__getitem__, chain.from_iterable(found)), np.int64, ends[-1])
        fresh = [*islice(self.known, before, None)]
        if fresh:
            ids = self.encode_words([b"" if w in self.special else w.encode() for w in fresh])
            ids = [(self.special[w],) if w in self.special else x for w, x in zip(fresh, ids)]
            count = np.fromiter(map(len, ids), np.int64, len(ids))
            self.first_of = np.concatenate([self.first_of, len(self.ids_of) + np.cumsum(count) - count])
            self.count_of = np.concatenate([self.count_of, count])
            self.ids_of = np.concatenate([self.ids_of, np.fromiter(chain.from_iterable(ids), np.int32, int(count.sum()))])
        count = self.count_of[place]
        return _taken(self.ids_of, self.first_of[place], count), np.concatenate([[0], np.cumsum(count)])[ends]

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        ids, ends = self.encode_flat(texts)
        ids = ids.tolist()
        return [ids[a:b] for a, b in pairwise(ends.tolist())]

    def decode_flat(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of the ids between offsets."""
        size = self.size_of[ids]
        held = _taken(self.all_bytes, self.begin_of[ids], size).tobytes()
        return [held[a:b].decode("utf-8", "replace") for a, b in pairwise(np.concatenate([[0], np.cumsum(size)])[ends].tolist())]

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(2)
def vocabulary(path: str) -> Bpe:
    return Bpe(path)


def _batches(texts: list[str | None]) -> Iterator[list[str]]:
    """Runs of texts of about a million characters."""
    run, size = [], 0
    for t in texts:
        run.append(t or "")
        size += len(run[-1])
        if size > 1_000_000:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None, decoded: str | None = None) -> DataFrame:
    """df's columns (or those of keep), and the ids of text as array<int>; with decoded, also the text that they stand for."""
    extra = [ids, decoded] if decoded else [ids]
    names = [c for c in (df.columns if keep is None else keep) if c not in extra]
    source = df.select(*dict.fromkeys([*names, text]))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in source.select(*names).dtypes), f"`{ids}` array<int>", *([f"`{decoded}` string"] if decoded else [])])

    def encoded(bpe, batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            rest = batch.select(names)
            at = 0
            for part in _batches(texts):
                values, ends = bpe.encode_flat(part)
                columns = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))]
                if decoded:
                    columns.append(pa.array(bpe.decode_flat(values, ends), pa.string()))
                yield pa.RecordBatch.from_arrays([*rest.slice(at, len(part)).columns, *columns], [*names, *extra])
                at += len(part)

    def run(batches):
        bpe = vocabulary(path)
        yield from encoded(bpe, batches)
        # A worker goes on to other stages: what this task remembered is not kept in their memory.
        bpe.forget()
        give_back()

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """df's columns (or those of keep), and the text that ids stand for; null ids give the empty text."""
    names = [c for c in (df.columns if keep is None else keep) if c != decoded]
    source = df.select(*dict.fromkeys([*names, ids]))
    schema = ", ".join(f"`{c}` {t}" for c, t in source.select(*names).dtypes) + ("," if names else "") + f"`{decoded}` string"

    def run(batches):
        import pyarrow as pa

        bpe = vocabulary(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            for a in range(0, len(column), 256):
                texts = [bpe.decode(x or []) for x in column.slice(a, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.select(names).slice(a, len(texts)).columns, pa.array(texts, pa.string())], [*names, decoded])

    return source.mapInArrow(run, schema)


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256 and decoded_sha256 of a round trip."""
    return encode(df, path, text, "ids", [key], "decoded").select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
