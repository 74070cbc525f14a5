"""Operator 2: n-gram Jaccard join by partitioning the universe of shingles.

Two sets x, y with Jaccard similarity of at least t differ in at most H = floor((1-t)/(1+t) * (|x|+|y|)) elements. Shingles are hashed to
the segments of a size band (sizes grow by 1/t from band to band; a set also enters the bands that hold its smaller partners). A segment with allowance 0 is
indexed by its subset, one with allowance 1 also by its one-deletion neighbourhood; once the allowances plus one add up to H + 1, some
segment of any similar pair must meet. ``design`` picks the allowances of a band by cost: signatures written against expected chance matches.

A band with allowance 0 has more segments than H + 1. Empty segments are left out first, and then, by what the
index shows (``kept``), each set leaves out its most frequent signatures, as many as it has to spare: of a similar pair's common signatures
the rarest is spared by neither, so no pair is lost, and common passages cost little.

Sets that share signatures are gathered under the set that they meet most; those groups are verified in blocks by exact intersection counts (a product
of incidence matrices), so that copies are never written out as pairs. Where a pair across two groups passes the bounds of size and histogram, the
groups are verified together. Equal sets are one node throughout. Links are reduced to components in Spark.

Sets and shingles go by 64-bit names throughout, also where intersections are counted: among n different ones about n * n / 2^65 pairs share a name (three for ten thousand million).

Edge cases: null, empty or wordless texts have no shingles and link with nothing; fewer words than n are one shingle of the whole sequence;
repeated rows and texts are one node and share a component; rows with a null doc_id link like all others, and a component of such rows alone has the id null; rows that share a
doc_id and have different texts are different documents of one id; columns of docs, whatever they are called, are carried along or not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .pressed import press, unpress
from .shared import apart, bucket_count, free, ready, through_parquet
from .textnp import PLACE, mix, shingles, slices, words

N = 5
#: The threshold as a fraction, so that comparisons are exact.
UP, DOWN = 75, 100
#: Spare segments of a band, as a share of those it needs.
SPARE = 0.3
#: Sets verified together, at most twice as many; entries of an incidence matrix held at a time.
BLOCK = 512
CELLS = 1 << 24
HIST = 64


def bands(up: int = UP, down: int = DOWN, most: int = 1 << 40) -> np.ndarray:
    out = [1]
    while out[-1] < most:
        out.append(out[-1] * down // up + 1)
    return np.array(out, np.int64)


BANDS = bands()


def distance(total, up: int = UP, down: int = DOWN):
    """The most elements that two similar sets of this total size differ in."""
    return total * (down - up) // (down + up)


def design(band: int) -> tuple[int, int, int]:
    """(needed, segments, allowance) of a band; the same for every set, so that both sides of a pair agree."""
    most = int(BANDS[band + 1]) - 1
    need = int(distance(most + most * DOWN // UP)) + 1
    size = max(1.0, float(BANDS[band]))
    plain = need + int((need - 1) * SPARE) + (need > 1)
    wide = -(-need // 2)
    # Signatures of a set, and chance matches among a million sets in which a shingle is met by one set in ten thousand.
    cost = lambda signatures, segments, kept: signatures + segments * 1e6 * 1e-4 ** max(kept, 0.0)
    if cost(wide + size, wide, size / wide - 1) < cost(plain, plain, size / plain):
        return need, wide, 1
    return need, plain, 0


_DESIGNS: dict[int, tuple[int, int, int]] = {}


def signatures(x: np.ndarray, band: int) -> tuple[np.ndarray, int]:
    """A set's signatures in a band, and how many of them it has to spare."""
    need, m, allowance = _DESIGNS.get(band) or _DESIGNS.setdefault(band, design(band))
    y = mix(x ^ PLACE[band % 64])
    seg = (((y >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
    value = mix(y + PLACE[1])
    total = np.zeros(m, np.uint64)
    np.add.at(total, seg, value)
    name = np.arange(m, dtype=np.uint64) * PLACE[2] + np.uint64(band) * PLACE[3 : 4]
    if allowance:
        return np.unique(np.concatenate([mix(total + name), mix(total[seg] - value + name[seg])])), 0
    full = np.bincount(seg, minlength=m) > 0
    if full.sum() >= need:
        return mix(total + name)[full], min(255, int(full.sum()) - need)
    # Too few: empty segments count as well, and nothing is spared.
    return mix(total + name), 0


def sets_of(column, n: int = N):
    """(row, sorted distinct shingles, node) for each text of an Arrow string column."""
    for first, end, buf, offsets in slices(column):
        h, _, _, rows = words(buf, offsets)
        own, at = shingles(h, rows, n)
        for k in range(end - first):
            x = np.unique(own[at[k] : at[k + 1]])
            yield first + k, x, node_of(x)


def node_of(x: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed integer."""
    if not len(x):
        return 0
    return int(mix(PLACE[5:6] * np.uint64(len(x)) + x.sum(dtype=np.uint64)).view(np.int64)[0])


def nodes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, version (hash of the text), n_shingles, node of every row; node is null without shingles."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            size, node = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for k, x, name in sets_of(batch.column(2)):
                size[k], node[k] = len(x), name
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size), pa.array(node, mask=size == 0)], ["doc_id", "version", "n_shingles", "node"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64(text).alias("version"), text).mapInArrow(run, f"doc_id {kind}, version long, n_shingles long, node long")


# --- Runs of numpy arrays as rows: (bucket, kind, blob) ---


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64).tobytes()
    return head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    sizes = np.frombuffer(blob, np.int64, n, 8)
    at, out = 8 * (n + 1), []
    for size, kind in zip(sizes.tolist(), types):
        out.append(np.frombuffer(blob, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _joined(blobs: list[bytes], *types) -> list[np.ndarray]:
    parts = [_unpack(b, *types) for b in blobs]
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, t) for k, t in enumerate(types)]


_LOW, _HIGH = np.uint64(0xFFFFFFFF), np.uint64(32)
SCHEMA = "bucket int, kind int, blob binary"


def _table(rows: list[tuple[int, int, bytes]]):
    import pyarrow as pa

    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "kind": pa.array([r[1] for r in rows], pa.int32()), "blob": pa.array([r[2] for r in rows], pa.binary())})


def _runs(bucket: np.ndarray):
    """(bucket, positions) of a bucket column."""
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cut) if len(order) else ():
        yield int(bucket[part[0]]), part


def _short(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48 bits of a signature in two arrays; the bucket holds some of the rest."""
    return (sig & _LOW).astype(np.uint32), (sig >> _HIGH).astype(np.uint16)


def _index(docs: DataFrame, text: str, buckets: int) -> DataFrame:
    """kind 0: entries (node, size, band, spare) with their signatures, by signature; kind 1: histograms, by node."""

    def run(batches):
        p = np.uint64(buckets)
        for batch in batches:
            seen: set[int] = set()
            names, hists, entries, sigs = [], [], [], []

            def out():
                rows = []
                if names:
                    node, hist = np.array(names, np.int64), np.array(hists, np.uint8)
                    for b, part in _runs((node.view(np.uint64) % p).astype(np.int64)):
                        rows.append((b, 1, _pack(node[part], hist[part])))
                    owner = np.repeat(np.arange(len(sigs)), [len(s) for s in sigs])
                    sig = np.concatenate(sigs)
                    table = np.array(entries, np.int64)
                    for b, part in _runs(((sig >> np.uint64(48)) % p).astype(np.int64) if buckets <= 1 << 12 else (mix(sig) % p).astype(np.int64)):
                        own, count = np.unique(owner[part], return_counts=True)
                        t = table[own]
                        rows.append((b, 0, _pack(t[:, 0], t[:, 1].astype(np.uint32), t[:, 2].astype(np.uint8), t[:, 3].astype(np.uint8), count.astype(np.uint32), *_short(sig[part]))))
                names.clear(), hists.clear(), entries.clear(), sigs.clear()
                return rows

            for _, x, node in sets_of(batch.column(0)):
                n = len(x)
                if not n or node in seen:
                    continue
                seen.add(node)
                names.append(node)
                hists.append(np.minimum(np.bincount((x & np.uint64(HIST - 1)).astype(np.int64), minlength=HIST), 255))
                band = int(np.searchsorted(BANDS, n, "right")) - 1
                for b in range(int(np.searchsorted(BANDS, -(-n * UP // DOWN), "right")) - 1, band + 1):
                    sig, spare = signatures(x, b)
                    entries.append((node, n, b, spare))
                    sigs.append(sig)
                if len(sigs) > 8_000:
                    yield from _table(out()).to_batches()
            yield from _table(out()).to_batches()

    return docs.select(text).mapInArrow(run, SCHEMA)


def _grouped(sig: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by signature, and the starts and sizes of the groups."""
    order = np.argsort(sig, kind="stable")
    s = sig[order]
    start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    return order, start, np.diff(np.append(start, len(s)))


def _shared(buckets: int):
    """By signature: what at least two sets have, one of them in its own band. Sent on by node with frequency and smallest node."""

    def run(table):
        p = np.uint64(buckets)
        kind, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
        bucket = table.column("bucket")[0].as_py()
        rows = [(bucket, 1, b) for k, b in zip(kind, blobs) if k == 1]
        node, size, band, spare, count, low, high = _joined([b for k, b in zip(kind, blobs) if k == 0], np.int64, np.uint32, np.uint8, np.uint8, np.uint32, np.uint32, np.uint16)
        if len(node):
            # Copies in several batches are one entry.
            order = np.lexsort((band, node))
            first = np.concatenate([[True], (node[order][1:] != node[order][:-1]) | (band[order][1:] != band[order][:-1])])
            one = np.zeros(len(node), bool)
            one[order[first]] = True
            owner = np.repeat(np.arange(len(node)), count)
            keep = one[owner]
            owner, sig = owner[keep], low[keep].astype(np.uint64) | high[keep].astype(np.uint64) << _HIGH
            own = band == (np.searchsorted(BANDS, size, "right") - 1)
            order, start, g = _grouped(sig)
            owner, sig = owner[order], sig[order]
            good = (g > 1) & (np.add.reduceat(own[owner].astype(np.int64), start) > 0)
            hub = np.minimum.reduceat(node[owner], start)
            keep = np.repeat(good, g)
            owner, sig, hub, g = owner[keep], sig[keep], np.repeat(hub, g)[keep], np.repeat(g, g)[keep]
            for b, part in _runs((node[owner].view(np.uint64) % p).astype(np.int64)):
                part = part[np.argsort(owner[part], kind="stable")]
                who, n = np.unique(owner[part], return_counts=True)
                rows.append((b, 2, _pack(node[who], size[who], band[who], spare[who], n.astype(np.uint32), *_short(sig[part]), np.full(len(part), bucket, np.int32), g[part].astype(np.uint32), hub[part])))
        return _table(rows)

    return run


def kept(entry: np.ndarray, frequency: np.ndarray, sig: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """Which signatures stay when each entry leaves out its ``spare`` most frequent ones; ties go by signature, alike for all."""
    order = np.lexsort((sig, -frequency.astype(np.int64), entry))
    e = entry[order]
    first = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]])) if len(e) else np.zeros(0, np.int64)
    rank = np.arange(len(e)) - np.repeat(first, np.diff(np.append(first, len(e))))
    out = np.zeros(len(e), bool)
    out[order] = rank >= spare[e]
    return out


def _allocated(buckets: int):
    """By node: leave out what can be spared, find the node met most, and send what is left back by signature."""

    def run(table):
        p = np.uint64(buckets)
        kind, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
        home, hist = _joined([b for k, b in zip(kind, blobs) if k == 1], np.int64, np.uint8)
        node, size, band, spare, count, low, high, bucket, g, hub = _joined([b for k, b in zip(kind, blobs) if k == 2], np.int64, np.uint32, np.uint8, np.uint8, np.uint32, np.uint32, np.uint16, np.int32, np.uint32, np.int64)
        rows: list[tuple[int, int, bytes]] = []
        if len(node):
            hist = hist.reshape(-1, HIST)
            order = np.argsort(home, kind="stable")
            home, hist = home[order], hist[order]
            # An entry comes in a run from each bucket of signatures.
            key, entry = np.unique(np.stack([node, band.astype(np.int64)], axis=1), axis=0, return_inverse=True)
            entry = entry.ravel()
            spare_of, size_of = np.zeros(len(key), np.int64), np.zeros(len(key), np.uint32)
            spare_of[entry], size_of[entry] = spare, size
            e = np.repeat(entry, count)
            sig = low.astype(np.uint64) | high.astype(np.uint64) << _HIGH
            # Sparing by (frequency, bucket and signature): the same order for every set.
            stay = kept(e, g, sig ^ (bucket.astype(np.uint64) << np.uint64(48)), spare_of)
            e, sig, bucket, hub = e[stay], sig[stay], bucket[stay], hub[stay]
            if len(e):
                owner = key[e, 0]
                pairs, times = np.unique(np.stack([owner, hub], axis=1), axis=0, return_counts=True)
                order = np.lexsort((pairs[:, 1], -times, pairs[:, 0]))
                pairs = pairs[order]
                first = np.concatenate([[True], pairs[1:, 0] != pairs[:-1, 0]])
                names, main = pairs[first, 0], pairs[first, 1]
                at = np.searchsorted(home, names)
                for b, part in _runs((mix(names.view(np.uint64)) % p).astype(np.int64)):
                    rows.append((b, 0, _pack(names[part], main[part])))
                for b, part in _runs(bucket.astype(np.int64)):
                    part = part[np.argsort(e[part], kind="stable")]
                    who, n = np.unique(e[part], return_counts=True)
                    who_node, local = np.unique(key[who, 0], return_inverse=True)
                    k = np.searchsorted(names, who_node)
                    sizes = np.zeros(len(who_node), np.uint32)
                    sizes[local] = size_of[who]
                    rows.append((b, 3, _pack(who_node, main[k], sizes, hist[at[k]].ravel(), local.astype(np.uint32), key[who, 1].astype(np.uint8), n.astype(np.uint32), *_short(sig[part]))))
        return _table(rows)

    return run


def _meet(table):
    """By signature again: (main, node, 0) for each node, and (a, b, 1) for groups with a pair across them within the bounds of size and histogram."""
    import pyarrow as pa

    kind, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
    names, main = _joined([b for k, b in zip(kind, blobs) if k == 0], np.int64, np.int64)
    # Each run has entries that refer to its own nodes.
    tables = [_unpack(b, np.int64, np.int64, np.uint32, np.uint8, np.uint32, np.uint8, np.uint32, np.uint32, np.uint16) for k, b in zip(kind, blobs) if k == 3]
    found = np.zeros((0, 2), np.int64)
    if tables:
        base = np.cumsum([0, *(len(t[0]) for t in tables)])
        node, group, size, hist = (np.concatenate([t[k] for t in tables]) for k in range(4))
        hist = hist.reshape(-1, HIST).astype(np.int16)
        local = np.concatenate([t[4].astype(np.int64) + a for t, a in zip(tables, base)])
        band, count = (np.concatenate([t[k] for t in tables]) for k in (5, 6))
        sig = np.concatenate([t[7] for t in tables]).astype(np.uint64) | np.concatenate([t[8] for t in tables]).astype(np.uint64) << _HIGH
        owner = np.repeat(local, count)
        own = np.repeat(band == (np.searchsorted(BANDS, size[local], "right") - 1), count)
        order, start, g = _grouped(sig)
        owner, own = owner[order], own[order]
        many = (g > 1) & (np.minimum.reduceat(group[owner], start) != np.maximum.reduceat(group[owner], start)) if len(start) else np.zeros(0, bool)
        parts: list[np.ndarray] = []
        waiting = 0
        size = size.astype(np.int64)
        for a, n in zip(start[many].tolist(), g[many].tolist()):
            who = owner[a : a + n]
            left = who[own[a : a + n]]
            for k in range(0, len(left), max(1, (1 << 20) // n)):
                x = left[k : k + max(1, (1 << 20) // n)]
                i, j = np.nonzero((group[x][:, None] != group[who][None, :]) & (np.minimum(size[x][:, None], size[who][None, :]) * DOWN >= np.maximum(size[x][:, None], size[who][None, :]) * UP))
                i, j = x[i], who[j]
                near = [np.abs(hist[i[c : c + 65536]] - hist[j[c : c + 65536]]).sum(axis=1) <= distance(size[i[c : c + 65536]] + size[j[c : c + 65536]]) for c in range(0, len(i), 65536)]
                if near:
                    near = np.concatenate(near)
                    i, j = group[i[near]], group[j[near]]
                    parts.append(np.unique(np.stack([np.minimum(i, j), np.maximum(i, j)], axis=1), axis=0))
                    waiting += len(parts[-1])
            if waiting > 1 << 18:
                parts, waiting = [np.unique(np.concatenate(parts), axis=0)], 0
        if parts:
            found = np.unique(np.concatenate(parts), axis=0)
    return pa.table({
        "a": pa.array(np.concatenate([main, found[:, 0]])), "b": pa.array(np.concatenate([names, found[:, 1]])),
        "kind": pa.array(np.concatenate([np.zeros(len(names), np.int32), np.ones(len(found), np.int32)])),
    })


def similar(sets: list[np.ndarray], up: int = UP, down: int = DOWN) -> tuple[np.ndarray, np.ndarray]:
    """All similar pairs i < j, by exact intersection counts of a block of sets."""
    k = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    token, where = np.concatenate(sets), np.repeat(np.arange(k), size)
    order = np.argsort(token, kind="stable")
    token, where = token[order], where[order]
    new = np.concatenate([[True], token[1:] != token[:-1]])
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1
    keep = often[column]
    where, column = where[keep], (np.cumsum(often) - 1)[column[keep]]
    inter = np.zeros((k, k), np.float32)
    step = max(1, CELLS // max(k, 1))
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        lo, hi = np.searchsorted(column, [a, a + step])
        m = np.zeros((k, int(column[hi - 1]) - a + 1), np.float32)
        m[where[lo:hi], column[lo:hi] - a] = 1
        inter += m @ m.T
    common = np.rint(inter).astype(np.int64)
    i, j = np.nonzero(np.triu(common * down >= (size[:, None] + size[None, :] - common) * up, 1))
    return i, j


def _verify(table):
    """Links that span the similar pairs of one block: (a, b)."""
    import pyarrow as pa

    wanted = table.column("node").to_pylist()
    names, sets, seen = [], [], set()
    texts = pa.array(unpress(table.column("__z")), pa.binary()).cast(pa.string())
    for k, x, node in sets_of(texts):
        # Of rows that share a doc_id, only the text that the node was made of.
        if node == wanted[k] and node not in seen:
            seen.add(node)
            names.append(node)
            sets.append(x)
    out: list[tuple[int, int]] = []
    if len(sets) > 1:
        root = list(range(len(sets)))

        def find(v: int) -> int:
            while root[v] != v:
                root[v] = root[root[v]]
                v = root[v]
            return v

        for i, j in zip(*(v.tolist() for v in similar(sets))):
            if (a := find(i)) != (b := find(j)):
                root[b] = a
                out.append((names[i], names[j]))
    return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})


def grouped(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, version, n_shingles, node, component (a node's name; null without shingles) of every row of docs."""
    ready(docs.sparkSession)
    buckets = bucket_count(docs)
    named = nodes(docs, text).checkpoint()
    shared = _index(docs, text, buckets).groupBy("bucket").applyInArrow(_shared(buckets), SCHEMA)
    met = shared.groupBy("bucket").applyInArrow(_allocated(buckets), SCHEMA).groupBy("bucket").applyInArrow(_meet, "a long, b long, kind int").distinct().checkpoint()
    # Groups: nodes of one main node, and groups that a candidate pair connects.
    joint = connected_components(met.filter("kind = 1").select("a", "b")).select(F.col("node").alias("main"), F.col("component").alias("joint"))
    members = met.filter("kind = 0").select(F.col("a").alias("main"), F.col("b").alias("node")).join(joint, "main", "left").select(F.coalesce("joint", "main").alias("key"), "node").distinct()
    # Sizes by a count with a map-side combine, and places by the node's hash: no task holds a group.
    sizes = members.groupBy("key").agg(F.count("*").alias("of")).filter("of > 1")
    members = members.join(apart(sizes, "key"), "key")
    least = named.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")).alias("first")).select("node", "first.doc_id", "first.version")
    # A group of several blocks is verified block by block, each pair of blocks in a task of its own.
    chunks = F.expr(f"cast((of - 1) div {BLOCK} as int)")
    chunk = F.expr(f"cast(pmod(xxhash64(node), (of - 1) div {BLOCK} + 1) as int)")
    dealt = members.join(least, "node").select("node", "doc_id", "version", "key", F.explode(F.transform(F.sequence(F.lit(0), chunks), lambda c: F.struct(F.least(c, chunk).alias("one"), F.greatest(c, chunk).alias("two")))).alias("block"))
    # Of the rows without an id, each text once.
    source = docs.filter(F.col(text).isNotNull()).select("doc_id", F.col(text).alias("text"))
    source = source.filter(F.col("doc_id").isNotNull()).unionAll(source.filter(F.col("doc_id").isNull()).dropDuplicates(["text"]))
    texts, held = press(source, ["doc_id"], "text", "version")
    wanted = dealt.select("node", F.col("doc_id").alias("id"), F.col("version").alias("of")).distinct()
    bodies = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("version") == F.col("of"))).select("node", F.col(held).alias("__z"))
    links = dealt.select("node", "key", "block").join(bodies, "node").groupBy("key", "block").applyInArrow(_verify, "a long, b long")
    joined = connected_components(links)
    return named.join(apart(joined, "node"), "node", "left").select("doc_id", "version", "n_shingles", "node", F.coalesce("component", "node").alias("component"))


def components(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs: the smallest doc_id that its links reach."""
    found = grouped(docs, text)
    smallest = found.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return found.join(apart(smallest, "component"), "component", "left").select("doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of docs for each component, columns as they are: of the smallest doc_id (null last), then the smallest hash of the text; of repeated rows one. Texts without words are not alike."""
    # Names of the copies that are joined with docs.
    key, version, many = (free(docs.columns, c) for c in ("_id", "_version", "_many"))
    found = through_parquet(grouped(docs, text).groupBy("component", "doc_id", "version").agg(F.count("*").alias("n")), "grouped")
    first = found.filter("component is not null").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version", "n")).alias("x")).select("x.doc_id", "x.version", "x.n")
    kept = first.unionAll(found.filter("component is null").select("doc_id", "version", "n")).select(F.col("doc_id").alias(key), F.col("version").alias(version), F.col("n").alias(many))
    mine = free([*docs.columns, key, version, many], "_own")
    rows = docs.withColumn(mine, F.xxhash64(text))
    rows = rows.join(kept, rows["doc_id"].eqNullSafe(F.col(key)) & (rows[mine] == F.col(version)))
    once = rows.filter(F.col(many) == 1).select(*docs.columns)
    return once.unionAll(rows.filter(F.col(many) > 1).dropDuplicates([key, version]).select(*docs.columns))
