"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Examples are at most SAMPLE labelled rows (those of the least hash of the id, held-out ids never),
and at most POSTINGS distinct terms of them in all. Terms are folded words, cut to their first FRONT
letters; every term of every example is in the vocabulary and every example in the index. A weight
is (1 + log tf) * idf * (1 + BOOST * phi^2): sublinear tf, smoothed idf, and the square of
the term's correlation with the label (shrunk where it rests on few rows), which lets terms that tell
the labels apart count for more; no term is left out.

The postings lie in blocks of BLOCK examples (sorted so that alike examples share a block) and
each term keeps its largest weight in each block. The DENSE commonest terms have their postings in
a matrix, so that a product gives their part of the cosine for a batch of queries. A query's bound
on a block is the largest such part in the block plus the dot product of its other terms with their
maxima; blocks are opened in order of falling bound, in growing rounds, and the search stops
when no closed block can reach the k-th best cosine, so that the K neighbours are exact (to SLACK:
the matrix holds 32-bit floats, and cosines are compared at six decimals).

The K neighbours vote with their cosine as weight, against PRIOR votes for the training share;
isotonic regression on leave-one-out votes of the examples (cast on the executors) turns votes
into probabilities. The nearest examples and their cosines are returned as evidence. Texts that share no
term with any example have no neighbour and get the calibrated score of the prior.

Defined cases: null texts score as empty ones; null labels are not learned from; without toxic
or clean examples the score is the training share (0 without examples); equal cosines are
ordered by example; very long texts count whole, one entry for each distinct term; repeated rows
each give a row; an empty table gives an empty result; other columns, whatever their names, are
ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices
from .quality_model import held_out, training

SAMPLE, POSTINGS, FRONT, BOOST, DENSE, BLOCK, K, PRIOR, THRESHOLD = 8_000, 12_000_000, 7, 100.0, 512, 32, 8, 0.5, 0.3
FIRST_ROUND, BATCH, SHRINK, SLACK = 12, 64, 20.0, 2e-6


def terms(text: str | None) -> Counter:
    """Folded words without outer punctuation, cut to FRONT characters."""
    out: Counter = Counter()
    for w, n in Counter((text or "").lower().split()).items():
        out[w.strip(".,;:!?\"'()|#$%&*")[:FRONT]] += n
    out.pop("", None)
    return out


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    n = ends - starts
    return np.arange(n.sum()) + np.repeat(starts - np.concatenate(([0], np.cumsum(n)[:-1])), n) if len(n) else np.zeros(0, np.int64)


def clusters(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Cluster of each row by cosine (k-means from rows at even distances); it decides how well blocks are pruned, never the result."""
    if k < 2:
        return np.zeros(len(x), np.int64)
    x = x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)
    centre = x[np.arange(k) * len(x) // k]
    for _ in range(rounds):
        own = (x @ centre.T).argmax(1)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        centre = total / np.maximum(np.sqrt((total * total).sum(1, keepdims=True)), 1e-9)
    return own


class Index:
    """Block-max inverted index over the examples; bags are pairs of arrays (term, count) over the vocabulary's numbers."""

    def __init__(self, vocabulary: dict[str, int], bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, ids: np.ndarray) -> None:
        self.term, n = vocabulary, len(bags)
        self.share = float(y.mean()) if n else 0.0
        t = np.concatenate([b for b, _ in bags]) if n else np.zeros(0, np.int64)
        tf = np.concatenate([c for _, c in bags]).astype(float) if n else np.zeros(0)
        e = np.repeat(np.arange(n), [len(b) for b, _ in bags])
        df, toxic, n1 = np.bincount(t, minlength=len(vocabulary)), np.bincount(t, y[e], len(vocabulary)), float(y.sum())
        expected = df * (n1 / max(1, n))
        chi = (toxic - expected) ** 2 * n / np.maximum(expected * (n - n1) * (1 - df / (n + 1)), 1e-9)
        phi2 = chi / max(1, n) * chi / (chi + SHRINK)
        self.weight = (np.log((1 + n) / (1 + df)) + 1) * (1 + BOOST * phi2)
        w = (1 + np.log(tf)) * self.weight[t]
        w /= np.sqrt(np.bincount(e, w * w, n))[e]
        # Alike examples go to the same block: by cluster of their common terms, label, and heaviest term.
        row, common = self.common(df)
        dense, in_row = np.zeros((n, len(common))), row[t] >= 0
        dense[e[in_row], row[t[in_row]]] = w[in_row]
        heaviest = np.zeros(n, np.int64)
        by = np.lexsort((t, w, e))
        last = np.flatnonzero(np.diff(np.append(e[by], n)))
        heaviest[e[by][last]] = t[by][last]
        order = np.lexsort((np.arange(n), heaviest, y, clusters(dense, -(-n // (8 * BLOCK)))))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.y, self.ids, self.n, self.blocks = y[order].astype(float), ids[order], n, -(-n // BLOCK)
        by = np.lexsort((place[e], t))
        self.arrange(t[by], place[e][by], tf[by], df)

    @staticmethod
    def common(df: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each term's row in the matrix (-1: it has blocks), and the terms of the rows."""
        common = np.lexsort((np.arange(len(df)), -df))[:DENSE]
        row = np.full(len(df), -1, np.int64)
        row[common] = np.arange(len(common))
        return row, common

    def arrange(self, t: np.ndarray, e: np.ndarray, tf: np.ndarray, df: np.ndarray) -> None:
        """Matrix, blocks and maxima from the postings, which are sorted by term and example."""
        self.postings = (df.astype(np.int32), e.astype(np.min_scalar_type(max(1, self.n))), tf.astype(np.min_scalar_type(int(tf.max(initial=0)))))
        w = (1 + np.log(tf)) * self.weight[t]
        w /= np.sqrt(np.bincount(e, w * w, self.n))[e]
        self.row, common = self.common(df)
        in_row = self.row[t] >= 0
        self.dense = np.zeros((len(common), self.blocks * BLOCK), np.float32)
        self.dense[self.row[t[in_row]], e[in_row]] = w[in_row]
        t, e, w = t[~in_row], e[~in_row], w[~in_row]
        self.examples, self.weights = e.astype(np.int32), w
        # Entries: a term's postings in a block; `entry` has the first posting of each, `first` the first entry of each term.
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (e[1:] // BLOCK != e[:-1] // BLOCK)
        at = np.flatnonzero(new)
        self.entry = np.append(at, len(t))
        self.block = (e[at] // BLOCK).astype(np.int32)
        self.most = np.maximum.reduceat(w, at) if len(at) else np.zeros(0)
        self.first = np.searchsorted(t[at], np.arange(len(self.term) + 1))

    def __getstate__(self):
        """What is broadcast: counts only; the arrays are made again where they are used."""
        return "\n".join(self.term), self.weight, self.y, self.ids, self.n, self.blocks, self.share, self.postings

    def __setstate__(self, state) -> None:
        said, self.weight, self.y, self.ids, self.n, self.blocks, self.share, (df, e, tf) = state
        self.term = {t: k for k, t in enumerate(said.split("\n") if said else [])}
        self.arrange(np.repeat(np.arange(len(df)), df), e.astype(np.int64), tf.astype(float), df)

    def vector(self, bag: Counter) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights); terms that no example has are left out."""
        get = self.term.get
        t, n = np.array([get(x, -1) for x in bag], np.int64), np.fromiter(bag.values(), float, len(bag))
        t, n = t[t >= 0], n[t >= 0]
        w = (1 + np.log(n)) * self.weight[t]
        return t, w / np.sqrt((w * w).sum()) if len(t) else w

    def examples_vectors(self):
        """Each example's number -> its terms and weights."""
        df, e, tf = self.postings
        by = np.argsort(e, kind="stable")
        t, e, tf = np.repeat(np.arange(len(df)), df)[by], e[by], tf[by]
        edge = np.searchsorted(e, np.arange(self.n + 1))

        def vector(k: int) -> tuple[np.ndarray, np.ndarray]:
            own = slice(edge[k], edge[k + 1])
            w = (1 + np.log(tf[own].astype(float))) * self.weight[t[own]]
            return t[own], w / np.sqrt((w * w).sum())

        return vector

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None, opened: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """For each query (terms, weights): (cosine, example) of the k nearest by falling cosine, then by example; only
        positive cosines, never the example `without`. opened: gets the number of blocks that were opened for each query."""
        out = []
        for at in range(0, len(queries), BATCH):
            part = queries[at : at + BATCH]
            q = np.zeros((len(part), len(self.dense)), np.float32)
            for i, (t, w) in enumerate(part):
                rows = self.row[t]
                q[i, rows[rows >= 0]] = w[rows >= 0]
            known = q @ self.dense
            for i, (t, w) in enumerate(part):
                rare = self.row[t] < 0
                out.append(self.search(known[i].astype(float), t[rare], w[rare], k, without[at + i] if without else -1, opened))
        return out

    def search(self, cosine: np.ndarray, t: np.ndarray, w: np.ndarray, k: int, without: int, opened: list[int] | None) -> list[tuple[float, int]]:
        """The nearest, from the common terms' part of every cosine and the other terms."""
        entries = ranges(self.first[t], self.first[t + 1])
        weight = np.repeat(w, self.first[t + 1] - self.first[t])
        block = self.block[entries]
        if without >= 0:
            cosine[without] = -1e9
        bounds = np.bincount(block, weight * self.most[entries], self.blocks) + cosine.reshape(-1, BLOCK).max(1, initial=0) + SLACK
        order = np.argsort(-bounds, kind="stable")
        best, value, floor, at, step = np.zeros(0, np.int64), np.zeros(0), SLACK, 0, FIRST_ROUND
        while at < len(order) and bounds[order[at]] > floor:
            chosen = order[at : at + step]
            chosen = chosen[bounds[chosen] > floor]
            wanted = np.zeros(self.blocks, bool)
            wanted[chosen] = True
            own = np.flatnonzero(wanted[block])
            starts, ends = self.entry[entries[own]], self.entry[entries[own] + 1]
            posts = ranges(starts, ends)
            part = np.bincount(self.examples[posts], np.repeat(weight[own], ends - starts) * self.weights[posts], len(cosine)).reshape(-1, BLOCK)[chosen]
            part = part + cosine.reshape(-1, BLOCK)[chosen]
            hit = np.flatnonzero(part.ravel() > floor)
            best = np.concatenate((best, chosen[hit // BLOCK] * BLOCK + hit % BLOCK))
            value = np.concatenate((value, part.ravel()[hit].round(6)))
            take = np.lexsort((best, -value))[:k]
            best, value = best[take], value[take]
            floor = max(SLACK, value[-1] - SLACK) if len(best) == k else SLACK
            at, step = at + len(chosen), step * 8
        if opened is not None:
            opened.append(at)
        return list(zip(value.tolist(), best.tolist(), strict=True))

    def vote(self, found: list[tuple[float, int]]) -> float:
        return (PRIOR * self.share + sum(c * self.y[e] for c, e in found)) / (PRIOR + sum(c for c, _ in found))


def calibrated(votes: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression (pool adjacent violators) of the label on the votes: (votes, probabilities) to interpolate."""
    pools: list[list[float]] = []
    for x, label in sorted(zip(votes.round(6).tolist(), y.tolist(), strict=True)):
        if pools and pools[-1][0] == x:
            pools[-1][1] += label
            pools[-1][2] += 1
        else:
            pools.append([x, label, 1])
    merged: list[list[float]] = []
    for x, a, n in pools:
        merged.append([x, a, n])
        while len(merged) > 1 and merged[-2][1] / merged[-2][2] >= merged[-1][1] / merged[-1][2]:
            x2, a2, n2 = merged.pop()
            merged[-1] = [(merged[-1][0] * merged[-1][2] + x2 * n2) / (merged[-1][2] + n2), merged[-1][1] + a2, merged[-1][2] + n2]
    return np.array([m[0] for m in merged]), np.array([m[1] / m[2] for m in merged])


@dataclass
class Model:
    """The index where the executors have it, and the calibration."""

    held: Broadcast
    x: np.ndarray = field(default_factory=lambda: np.zeros(1))
    p: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def score(self, found: list[tuple[float, int]]) -> float:
        return float(np.interp(self.held.value.vote(found), self.x, self.p))


def gathered(rows: list[tuple[int, int, str, list[int]]]) -> Index:
    """The index of (id, label, terms, counts) rows."""
    vocabulary: dict[str, int] = {}
    bags = [(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in said.split("\n") if t], np.int64), np.array(counts, np.int32)) for _, _, said, counts in rows]
    return Index(vocabulary, bags, np.array([r[1] for r in rows], float), np.array([r[0] for r in rows], np.int64))


def build(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, postings: int = POSTINGS) -> Model:
    """The model over the sample. Terms are counted where the texts are; the driver gets the counts of `sample` rows and `postings` terms at most."""
    spark = df.sparkSession
    rows = training(df, labels, "toxic", doc_id, text, sample)

    def run(batches):
        for batch in batches:
            bags = [terms(t) for t in slices(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(1), pa.array(["\n".join(b) for b in bags], pa.string()), pa.array([list(b.values()) for b in bags], pa.list_(pa.int32()))],
                names=["id", "label", "terms", "counts"],
            )

    found = Scratch(spark, "toxicity").save(rows.mapInArrow(run, "id long, label int, terms string, counts array<int>"))
    taken, size = [], 0
    for r in found.orderBy(F.xxhash64("id"), "id", "label", "terms").toLocalIterator():
        size += len(r["counts"])
        if len(taken) == sample or size > postings:
            break
        taken.append(tuple(r))
    index = gathered(taken)
    model = Model(spark.sparkContext.broadcast(index), p=np.array([index.share]))
    if 0 < index.share < 1:

        def cast(batches):
            index = model.held.value
            own = index.examples_vectors()
            for batch in batches:
                k = batch.column(0).to_pylist()
                votes = [index.vote(found) for found in index.nearest([own(i) for i in k], K, k)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(votes, pa.float64())], names=["k", "vote"])

        votes = dict(map(tuple, spark.range(0, index.n, 1, max(1, index.n // 250)).mapInArrow(cast, "k long, vote double").collect()))
        model.x, model.p = calibrated(np.array([votes[k] for k in range(index.n)]), index.y)
    return model


def scores(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) for each row; evidence: the nearest examples' ids and cosines."""

    def run(batches):
        index = model.held.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                got = index.nearest([index.vector(terms(t)) for t in slices(part.column(1))], K)
                s = np.array([model.score(found) for found in got])
                said = [",".join(f"{index.ids[e]}:{c:.4f}" for c, e in found[:3]) for found in got]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([held_out(i) for i in part.column(0).to_pylist()]), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32)), pa.array(said, pa.string())],
                    names=["doc_id", "held_out", "score", "predicted", "evidence"],
                )

    df = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return df.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, evidence string")
