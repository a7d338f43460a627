"""Removal of repeated 400-byte strings by blockwise suffix sorting with a difference cover.

Suffix buckets. A window is LENGTH bytes from one start. The key of a window is the least hash
of its GRAM-byte strings, so equal windows have equal keys wherever they are; a maximal range of
starts with one key is a run, about one for each 135 bytes of text. A key seen in one run only
has no repeats. Runs whose whole byte strings have the same 128-bit BLAKE2b digest are repeats
without sorting. What is left are keys with runs that differ: one run of each distinct
string goes to the sorter, bucket by bucket, a bounded number of bytes at a time. Two strings
may share a key by chance: that costs a comparison and changes no result.

Sorting a block. Starts are sorted by their first 31 bytes. Ties are resolved by ranks of the
block's cover sample: positions whose residue modulo 31 is in a difference cover, ranked over
496 bytes by doubling. For any two starts there is a shift below 31 that takes both into the
sample, so one lookup compares them; a ternary quicksort does this for all tied groups at once.
Neighbours in that order that agree in LENGTH bytes are repeats.

A key whose differing runs exceed HOT_BYTES (one passage in very many contexts) isn't sorted in
one task: its windows are counted by 128-bit BLAKE2b digests in a distributed aggregation
instead, with the same result. Joins on a key go through `join_skewed`, so that a passage of
very many documents doesn't land in one task.

Defined cases: a null text counts as empty; texts under LENGTH bytes lose nothing; repeated rows
count as documents of their own, so their bytes (from LENGTH on) are removed in each; an empty
table gives an empty result; very long texts are cut into pieces of PIECE window starts without
losing windows; rows are told apart by (doc_id, hash of the text); other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_skewed, to_batch

LENGTH, GRAM, PIECE, BLOCK_BYTES, HOT_BYTES = 400, 128, 1 << 19, 1 << 20, 1 << 20
V, COVER = 31, (1, 5, 11, 24, 25, 27)


def _powers(m: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], at = 1, 1
    while at < n:  # doubling
        step = np.uint64(pow(m, at, 1 << 64))
        k = min(at, n - at)
        out[at : at + k] = out[:k] * step
        at += k
    return out


class Hasher:
    """Hashes of byte ranges from prefix sums modulo 2^64."""

    def __init__(self, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.table = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.m = int(rng.integers(1 << 62, 1 << 63)) | 5
        self.powers = self.inverse = np.zeros(0, np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        if len(self.powers) < n:
            self.powers, self.inverse = _powers(self.m, 2 * n), _powers(pow(self.m, -1, 1 << 64), 2 * n)
        out = np.zeros(n, np.uint64)
        np.cumsum(self.table[data] * self.powers[: n - 1], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
        return mix((prefix[ends] - prefix[starts]) * self.inverse[starts])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x)
    rows = -(-n // w)
    padded = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    grid = padded.reshape(rows, w)
    head = np.minimum.accumulate(grid, 1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(tail[: n - w + 1], head[w - 1 : n])


def digests(data: memoryview, starts: list[int], ends: list[int]) -> np.ndarray:
    """[range, 2]: 128-bit digests of byte ranges."""
    blake = hashlib.blake2b
    return np.frombuffer(b"".join([blake(data[s:e], digest_size=16).digest() for s, e in zip(starts, ends, strict=True)]), np.int64).reshape(-1, 2)


def runs(data: np.ndarray, hasher: Hasher):
    """(key, digests, start, starts, twice) arrays of a text's runs; twice: the key's string occurs more than once in the run."""
    w = LENGTH - GRAM + 1
    for at in range(0, max(0, len(data) - LENGTH + 1), PIECE):
        part = data[at : at + PIECE + LENGTH - 1]
        p = hasher.prefix(part)
        n = len(part) - GRAM + 1
        grams = hasher.of(p, slice(0, n), slice(GRAM, GRAM + n))
        least = sliding_least(grams, w)
        starts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        count = np.diff(np.append(starts, len(least)))
        key = least[starts]
        h = digests(memoryview(part), starts.tolist(), (starts + count + LENGTH - 1).tolist())
        twice = [int(np.count_nonzero(grams[s : s + c + w - 1] == k)) > 1 for s, c, k in zip(starts.tolist(), count.tolist(), key, strict=True)]
        yield key.view(np.int64), h, starts + at, count.astype(np.int32), np.array(twice, bool)


RUN_DDL = "doc_id long, th long, key long, h long, g long, start long, n int, twice boolean"


def all_runs(batches):
    """(doc_id, th, text) -> runs."""
    hasher = Hasher(1)
    for batch in batches:
        ids, hashes, texts = batch.column(0), batch.column(1).to_numpy(), batch.column(2)
        parts, rows, size = [], [], 0

        def out():
            key, h, start, count, twice = (np.concatenate(c) for c in zip(*parts, strict=True))
            row = np.repeat([r for r, _ in rows], [n for _, n in rows])
            arrays = [ids.take(pa.array(row)), *map(pa.array, (hashes[row], key, h[:, 0].copy(), h[:, 1].copy(), start, count, twice))]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "th", "key", "h", "g", "start", "n", "twice"])

        for i in range(batch.num_rows):
            data = np.frombuffer(texts[i].as_buffer() or b"", np.uint8)
            for got in runs(data, hasher):
                parts.append(got)
                rows.append((i, len(got[0])))
                size += len(got[0])
            if size > 50_000:
                yield out()
                parts, rows, size = [], [], 0
        if parts:
            yield out()


def shifts() -> np.ndarray:
    """[a, b]: least shift that takes both residues into the cover."""
    out = np.zeros((V, V), np.int64)
    for a in range(V):
        for b in range(V):
            out[a, b] = next(d for d in range(V) if (a + d) % V in COVER and (b + d) % V in COVER)
    return out


SHIFTS = shifts()


def repeated(strings: list[bytes], counts: list[int]) -> np.ndarray:
    """For each window start, string after string, whether its window occurs at another start."""
    t = np.frombuffer(b"".join([*strings, bytes(1024)]), np.uint8)
    size = len(t) - 1024
    word = np.zeros(len(t) - 7, np.uint64)
    for k in range(8):
        word = word << np.uint64(8) | t[k : len(t) - 7 + k]
    bases = np.cumsum([0, *map(len, strings)])[:-1]
    pos = np.concatenate([np.arange(b, b + c) for b, c in zip(bases.tolist(), counts, strict=True)])

    def by_front(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, whether each differs from its predecessor) by the first 31 bytes."""
        keys = [word[at], word[at + 8], word[at + 16], word[at + 24] >> np.uint64(8)]
        order = np.lexsort(keys[::-1])
        new = np.ones(len(at), bool)
        new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
        return order, new

    sample = np.flatnonzero(np.isin(np.arange(size + V) % V, COVER))
    place = np.full(len(t), -1, np.int64)
    place[sample] = np.arange(len(sample))
    order, new = by_front(sample)
    rank = np.empty(len(sample), np.int64)
    rank[order] = np.cumsum(new)
    for reach in (V, 2 * V, 4 * V, 8 * V):  # 31 bytes -> 496
        after = place[np.minimum(sample + reach, len(t) - 1)]
        pair = rank * (len(sample) + 2) + np.where(after >= 0, rank[after], 0)
        rank = np.unique(pair, return_inverse=True)[1] + 1
    order, new = by_front(pos)
    arr, group = pos[order], np.cumsum(new) - 1
    active = np.arange(len(arr))
    seg = group.copy()
    while True:
        n = np.bincount(seg)
        keep = n[seg] > 1
        active, seg = active[keep], seg[keep]
        if not len(active):
            break
        starts = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
        length = np.diff(np.append(starts, len(seg)))
        a = arr[active]
        pivot = np.repeat(a[starts + length // 2], length)
        d = SHIFTS[a % V, pivot % V]
        side = np.sign(rank[place[a + d]] - rank[place[pivot + d]])
        ids = np.repeat(np.arange(len(starts)), length) * 3 + side + 1
        by = np.argsort(ids, kind="stable")
        arr[active] = a[by]
        ids = ids[by]
        unresolved = ids % 3 != 1
        active, ids = active[unresolved], ids[unresolved]
        seg = np.cumsum(np.concatenate(([0], ids[1:] != ids[:-1]))) if len(ids) else ids
    x = np.flatnonzero(group[1:] == group[:-1])
    for k in range(24, LENGTH, 8):
        x = x[word[arr[x] + k] == word[arr[x + 1] + k]]
    flag = np.zeros(len(t), bool)
    flag[arr[x]] = flag[arr[x + 1]] = True
    return flag[pos]


def stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    """[from, to) of the ranges of set flags."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


SPAN = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])
SPAN_DDL = "doc_id long, th long, s long, e long"


def sorted_spans(batches):
    """Rows sorted by key -> spans of repeated windows of runs that aren't known whole."""
    rows, size, last = [], 0, None

    def out():
        flags, at, got = repeated([r[4] for r in rows], [r[3] for r in rows]), 0, []
        for doc_id, th, start, n, _, single in rows:
            if single:
                got += [(doc_id, th, start + a, start + b - 1 + LENGTH) for a, b in stretches(flags[at : at + n])]
            at += n
        return pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], pa.int64()) for k in range(4)], schema=SPAN)

    for batch in batches:
        for key, doc_id, th, start, n, text, single in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != last and size > BLOCK_BYTES:
                yield out()
                rows, size = [], 0
            last = key
            rows.append((doc_id, th, start, n, text, single))
            size += len(text)
    if rows:
        yield out()


def texts_of_runs(batches):
    """(doc_id, th, text, runs) -> (key, doc_id, th, start, n, bytes, single)."""
    names = ["key", "doc_id", "th", "start", "n", "bytes", "single"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()]
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            doc_id, th = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            data = memoryview(batch.column(2)[i].as_buffer() or b"")
            for r in batch.column(3)[i].as_py():
                rows.append((r["key"], doc_id, th, r["start"], r["n"], bytes(data[r["start"] : r["start"] + r["n"] + LENGTH - 1]), r["single"]))
            if len(rows) > 5000 or (rows and i == batch.num_rows - 1):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)
                rows = []


def window_digests(batches):
    """Runs of hot keys -> (doc_id, th, at, single, x, y) for each window."""
    for batch in batches:
        for doc_id, th, start, n, text, single in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "start", "n", "bytes", "single")), strict=True):
            h = digests(memoryview(text), list(range(n)), list(range(LENGTH, LENGTH + n)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id] * n, pa.int64()), pa.array([th] * n, pa.int64()), pa.array(np.arange(start, start + n)), pa.array([single] * n), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())],
                names=["doc_id", "th", "at", "single", "x", "y"],
            )


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])
DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"


def finish(batches):
    """(doc_id, text, spans) -> the result's rows, in batches of about BLOCK_BYTES."""
    for batch in batches:
        rows, size = [], 0
        for i in range(batch.num_rows):
            data = memoryview(batch.column(1)[i].as_buffer() or b"")
            merged: list[list[int]] = []
            for s, e in sorted((x["s"], x["e"]) for x in batch.column(2)[i].as_py() or []):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            cuts = [0, *(x for span in merged for x in span), len(data)]
            left = b"".join([data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)])
            rows.append((batch.column(0)[i].as_py(), len(data), len(data) - len(left), len(merged), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore")))
            size += len(left)
            if size > BLOCK_BYTES:
                yield to_batch(rows, RESULT)
                rows, size = [], 0
        if rows:
            yield to_batch(rows, RESULT)


def spans(docs: DataFrame, scratch: Scratch, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """(doc_id, th, s, e) byte ranges to remove, maybe overlapping; docs: (doc_id, th, text)."""
    found = scratch.save(docs.filter(F.octet_length("text") >= LENGTH).mapInArrow(all_runs, RUN_DDL))
    total = found.count()
    differ = (F.min("h") != F.max("h")) | (F.min("g") != F.max("g"))
    keys = found.groupBy("key").agg(F.count("*").alias("c"), differ.alias("differ"), F.max("twice").alias("again"))
    keys = scratch.save(keys.filter("c > 1 OR again").select("key", "c", F.expr("differ OR again").alias("open")))
    shared = scratch.save(join_skewed(found, keys, ["key"], total).drop("c"))
    end = (F.col("start") + F.col("n") - 1 + LENGTH).alias("e")
    whole = shared.filter("NOT open").select("doc_id", "th", F.col("start").alias("s"), end)
    rows = shared.filter("open")
    kinds = scratch.save(rows.groupBy("key", "h", "g").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "th", "start")).alias("one")))
    rows = scratch.save(join_skewed(rows, kinds, ["key", "h", "g"], total))
    whole = whole.union(rows.filter("c > 1").select("doc_id", "th", F.col("start").alias("s"), end))
    asked = rows.filter("c = 1 OR (doc_id <=> one.doc_id AND th = one.th AND start = one.start)").select("doc_id", "th", "key", "start", "n", (F.col("c") == 1).alias("single"))
    # Sets, so that rows with one id and text ask once for all of them.
    asked = scratch.save(asked.groupBy("doc_id", "th").agg(F.collect_set(F.struct("key", "start", "n", "single")).alias("runs")))
    same = (docs["doc_id"].eqNullSafe(asked["doc_id"])) & (docs["th"] == asked["th"])
    texts = docs.join(asked, same).select(docs["doc_id"], docs["th"], docs["text"], "runs")
    texts = scratch.save(texts.mapInArrow(texts_of_runs, "key long, doc_id long, th long, start long, n int, bytes binary, single boolean"))
    hot = scratch.save(texts.groupBy("key").agg(F.sum(F.octet_length("bytes")).alias("size"), F.count("*").alias("c")).filter(F.col("size") > hot_bytes))
    cold = texts.join(hot, "key", "left_anti").select("key", "doc_id", "th", "start", "n", "bytes", "single")
    cold = cold.repartition("key").sortWithinPartitions("key").mapInArrow(sorted_spans, SPAN_DDL)
    windows = scratch.save(join_skewed(texts, hot, ["key"], total).mapInArrow(window_digests, "doc_id long, th long, at long, single boolean, x long, y long"))
    twice = scratch.save(windows.groupBy("x", "y").agg(F.count("*").alias("c")).filter("c > 1"))
    hits = join_skewed(windows.filter("single"), twice, ["x", "y"], windows.count()).select("doc_id", "th", F.col("at").alias("s"), (F.col("at") + LENGTH).alias("e"))
    return whole.union(cold).union(hits)


def remove(df: DataFrame, doc_id: str = "doc_id", text: str = "text", hot_bytes: int = HOT_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text) for each row; in kept_text the rest of a character that a cut divides is left out."""
    scratch = Scratch(df.sparkSession, "suffix")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(t).alias("th"), t.alias("text"))
    found = spans(docs, scratch, hot_bytes).groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    found = scratch.save(found)
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]) & (docs["th"] == found["_th"]), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(finish, DDL)
