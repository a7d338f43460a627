"""SimHash near-duplicates: 64-bit fingerprints of 4-word shingles, linked at 4 or fewer differing bits.

Candidates come from pigeonring filtering. The 64 bits are a ring of eight 8-bit segments; a
pair within four bits has a start on the ring from which every chain of l consecutive segments
differs in at most l/2 bits. So the first segment agrees, at least one of the next two does,
and at least two of the next four: each start has five ways to place three agreeing segments,
24 bits, which are the shuffle key. Within a key the whole chain of budgets is checked, then
the full Hamming distance.

Scale: only distinct fingerprints take part (copies collapse in a partial aggregation). Within
a key no pair list is made: a search that compares with unreached fingerprints alone gives the
trees of the key's near groups, at most one edge for each fingerprint, so that a group of
copies that share a key costs about its own size. A key with more than GROUP fingerprints is
searched by a fourth segment: of the five segments left at least one agrees, too. Components are
joined by large-star and small-star steps on written tables; nothing goes to the driver but three
numbers a step. Joins on a hub, a component or a fingerprint go through `join_skewed`, so that a
component or a text of very many rows doesn't land in one task.

Defined cases: null and blank texts have fingerprint zero and link like others; texts of fewer
than four words are one shingle; very long texts are counted whole, in slices of 65,536 shingles;
repeated rows and ids each keep a row in `classes`; a class without any id has a null
component_id; an empty table gives an empty result; other columns, whatever their names, are
ignored by `classes` and kept by `keep`. `keep` chooses rows, not ids: rows without an id and rows
that share an id are members of their own text's class, and one row of each class stays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_skewed, map_rows

SEED, SHINGLE, BITS, GROUP = 42, 4, 4, 4096
#: Offsets of the two other agreeing segments, from the chain budgets l/2.
PLACES = ((1, 2), (1, 3), (1, 4), (2, 3), (2, 4))
FULL = (1 << 64) - 1


def fingerprint(text: str | None) -> int:
    """ASCII letters folded; repeats count; a bit is set if it is in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    h = xxhash.xxh64_intdigest
    n = len(words) - SHINGLE + 1
    if n <= 1:
        return h(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    hashes = np.fromiter([h(joined[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)], np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp as a signed long)."""

    def make():
        return lambda i, t: [(i, (f := fingerprint(t)) - ((f >> 63) << 64))]

    df = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_rows(df, ["doc_id", "text"], pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())]), "doc_id long, fp long", make)


def masks() -> np.ndarray:
    """[start, l]: bits of the first l segments from a start; segment s is bits 8s to 8s+7."""
    out = np.zeros((8, 9), np.uint64)
    for start in range(8):
        for n in range(1, 9):
            out[start, n] = np.uint64(sum(0xFF << 8 * ((start + k) % 8) for k in range(n)))
    return out


MASKS = masks()


def near(diff: np.ndarray, start) -> np.ndarray:
    """Whether the chains from the start keep within their budgets; at all eight segments this is the Hamming check."""
    ok = np.bitwise_count(diff & MASKS[start, 3]) <= 1
    for n in (5, 7, 8):
        ok &= np.bitwise_count(diff & MASKS[start, n]) <= n // 2
    return ok


def trees(values: np.ndarray, start: int, most: int = GROUP) -> list[tuple[int, int]]:
    """Edges from the least member of each near group to the others (for more than `most` values, of the groups within each value of a segment)."""
    left, edges = np.arange(len(values)), []
    if len(values) > most:
        for segment in range(8):
            byte = values >> np.uint64(8 * segment) & np.uint64(255)
            order = np.argsort(byte, kind="stable")
            cuts = np.flatnonzero(np.diff(byte[order])) + 1
            if len(cuts):  # else it agrees in all of them
                for part in np.split(order, cuts):
                    edges += trees(values[part], start, len(part))
        return edges
    while len(left) > 1:
        root, queue, reached = left[0], [left[0]], []
        left = left[1:]
        while queue and len(left):
            ok = near(values[left] ^ values[queue.pop()], start)
            if ok.any():
                hit = left[ok]
                left = left[~ok]
                queue.extend(hit.tolist())
                reached.append(hit)
        for hit in reached:
            edges += [(int(values[root]), x) for x in values[hit].tolist()]
    return edges


EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def edges_of_keys(batches):
    """Batches of (key, fp) sorted by key -> edges. Groups may cross batches; pairs are handled all at once."""
    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def emit(keys, fps):
        cut = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate(([0], cut)), np.concatenate((cut, [len(keys)]))
        size, start = ends - starts, (keys[starts] >> 24) // len(PLACES)
        u, out = fps.view(np.uint64), []
        two = starts[size == 2]
        ok = near(u[two] ^ u[two + 1], start[size == 2])
        pairs = [np.stack((fps[two][ok], fps[two + 1][ok]))]
        for k in np.flatnonzero(size > 2).tolist():
            out += trees(u[starts[k] : ends[k]], int(start[k]))
        if out:
            pairs.append(np.array(out, np.uint64).view(np.int64).T)
        a, b = np.concatenate(pairs, 1)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], schema=EDGE)

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        k, f = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        if not len(k):
            continue
        held.append((k, f))
        if k[0] == k[-1] and held[0][0][0] == k[0]:
            continue  # one key so far
        keys, fps = (np.concatenate(x) for x in zip(*held, strict=True))
        cut = int(np.searchsorted(keys, keys[-1]))
        held = [(keys[cut:], fps[cut:])]
        yield emit(keys[:cut], fps[:cut])
    if held:
        keys, fps = (np.concatenate(x) for x in zip(*held, strict=True))
        yield emit(keys, fps)


def ring_keys(fp):
    segment = [F.shiftrightunsigned(fp, 8 * s).bitwiseAND(F.lit(255)) for s in range(8)]
    out = []
    for start in range(8):
        for k, (a, b) in enumerate(PLACES):
            x, y, z = segment[start], segment[(start + a) % 8], segment[(start + b) % 8]
            out.append(F.lit(start * len(PLACES) + k) * (1 << 24) + x * 65536 + y * 256 + z)
    return F.array(*out)


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a < b) that connect every two of the distinct fingerprints (column fp) within BITS bits, maybe through others."""
    keyed = distinct.select(F.explode(ring_keys(F.col("fp"))).alias("key"), "fp")
    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(edges_of_keys, "a long, b long").distinct()


def star(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """One large-star or small-star step; edges: (a, b), any order, no loops, `rows` of them."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count("*").alias("c"))
    joined = join_skewed(both, least, ["a"], rows)
    moved = joined.filter("b > a" if large else "b <> m").select(F.col("b").alias("x"), "m")
    if not large:
        moved = moved.union(least.select(F.col("a").alias("x"), "m"))
    return moved.filter("x <> m").select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node with an edge, by alternating star steps until nothing changes."""
    state = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now = scratch.save(edges)
    said = state(now)
    while said[0]:
        half = scratch.save(star(now, True, said[0]))
        then = scratch.save(star(half, False, half.count()))
        scratch.drop(now)
        scratch.drop(half)
        now, before, said = then, said, state(then)
        if said == before:
            break
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b"), F.col("b")).distinct())


def rooted(docs: DataFrame, scratch: Scratch, *best) -> DataFrame:
    """docs (with a fingerprint fp, written) with the aggregates `best` over each row's class; these take columns of docs or of their own kind over groups."""
    distinct = scratch.save(docs.groupBy("fp").agg(F.count("*").alias("c"), *(f(F.col(x)).alias(x) for f, x in best)))
    roots = components(links(distinct.select("fp")), scratch)
    linked = scratch.save(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    of_root = scratch.save(linked.groupBy("root").agg(F.count("*").alias("c"), *(f(F.col(x)).alias(f"best_{x}") for f, x in best)))
    of_fp = join_skewed(linked.select("fp", "root", F.col("c").alias("n")), of_root, ["root"], linked.count())
    of_fp = scratch.save(of_fp.select("fp", F.col("n").alias("c"), *(f"best_{x}" for _, x in best)))
    return join_skewed(docs, of_fp, ["fp"], docs.count())


def classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row; component_id: least doc_id that links lead to."""
    scratch = Scratch(df.sparkSession, "simhash")
    docs = scratch.save(fingerprints(df, doc_id, text))
    found = rooted(docs, scratch, (F.min, "doc_id"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("best_doc_id").alias("component_id"))


def keep(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """df's rows and columns with one row of each class: the least id (nulls last), then the least hash of the text.

    The keys (id, hash of the text) of rows that go are written, and the texts are filtered against them; Spark
    broadcasts these keys where their written size allows and shuffles otherwise. Only rows that repeat both id and
    text of a row that stays are grouped.
    """
    scratch = Scratch(df.sparkSession, "simhash-keep")
    i, t = F.col(f"`{doc_id}`").cast("long"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    key = F.struct(i.isNull().alias("none"), i.alias("i"), t.alias("t")).alias("key")

    def make():
        return lambda none, i, t, s: [(none, i, t, (f := fingerprint(s)) - ((f >> 63) << 64))]

    schema = pa.schema([("none", pa.bool_()), ("i", pa.int64()), ("t", pa.int64()), ("fp", pa.int64())])
    slim = df.select(key, F.col(f"`{text}`").alias("s")).select("key.none", "key.i", "key.t", "s")
    slim = map_rows(slim, ["none", "i", "t", "s"], schema, "none boolean, i long, t long, fp long", make)
    slim = scratch.save(slim.select(F.struct("none", "i", "t").alias("key"), "fp"))
    found = rooted(slim, scratch, (F.min, "key"))
    n = found.groupBy("key").agg(F.count("*").alias("n"), F.max(F.col("key") == F.col("best_key")).alias("stays"))
    gone = scratch.save(n.filter("n > 1 OR NOT stays").select(F.col("key.i").alias("_i"), F.col("key.t").alias("_t"), F.expr("stays").alias("_again")))
    same = lambda x: i.eqNullSafe(x["_i"]) & (t == x["_t"])
    kept_once, repeats = gone.select("_i", "_t"), gone.filter("_again").select("_i", "_t")
    once = df.join(kept_once, same(kept_once), "left_anti")
    again = df.join(repeats, same(repeats), "left_semi")
    first = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    again = again.groupBy(i.alias("_i"), t.alias("_t")).agg(F.first(first).alias("row")).select("row.*")
    return once.unionByName(again)
