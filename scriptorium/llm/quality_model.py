"""Quality classifier: a generalised additive model with pairwise interactions.

Each text becomes FEATURES numbers (counts and ratios of words, characters, lines and
repeats; nothing of labels, lang, source or doc_id). Features are cut into bins at training
quantiles. Cyclic boosting visits one feature after the other and fits a shallow tree (three
leaves: the two best cuts of the feature's bins) to the residual; the trees add up to one lookup table for
each feature. Then the pairs of features whose coarse grids explain most of the remaining
residual get tables of their own, boosted the same way over 2x2 cuts. A score is the sum of
table entries, looked up for a whole Arrow batch at once, through the logistic function.

The model is fitted on the driver on at most SAMPLE labelled rows, those of the least
hash of the id; every document is scored. Fewer than two classes in training: the score is their mean (0.5 without rows).

Defined cases: null texts score as empty ones; null labels are not learned from; labels of
repeated rows each count; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .quality_rules import STOP_WORDS

SAMPLE, BINS, ROUNDS, RATE, PAIRS, PAIR_BINS, THRESHOLD = 20_000, 48, 120, 0.12, 6, 8, 0.7
FEATURES = (
    "log_words", "word_length", "long_words", "stop_ratio", "distinct_ratio", "top_word_ratio", "symbol_ratio", "pipe_ratio", "capital_ratio", "mark_ratio",
    "digit_ratio", "punctuation_ratio", "blank_ratio", "log_lines", "words_a_line", "dup_line_ratio", "repeat_ratio", "closed_line_ratio", "sentence_length", "wide_ratio",
)
STOPS = frozenset(x.encode() for x in STOP_WORDS)
SYMBOLS, CAPITALS, DIGITS, STOPS_END, WIDE = b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b".!?\"':", bytes(range(128, 256))


def features(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))
    without = lambda chars: len(raw) - len(raw.translate(None, chars))
    lower = [w.strip(b".,;:!?\"'()") for w in raw.lower().split()]
    counts = Counter(lower)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    m = max(1, len(lines))
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    ends = sum(w.endswith((b".", b"!", b"?")) for w in words)
    return [
        float(np.log1p(len(words))), sum(map(len, words)) / n, sum(len(w) > 14 for w in words) / n, sum(c for w, c in counts.items() if w in STOPS) / n,
        len(counts) / n, (max(counts.values()) / n if counts else 0.0), without(SYMBOLS) / n, raw.count(b"|") / n, without(CAPITALS) / size, raw.count(b"!") / n,
        without(DIGITS) / size, without(b".,;:?") / n, without(b" \t\n\r") / size, float(np.log1p(len(lines))), len(words) / m, 1 - len(set(lines)) / m,
        sum(c for c in grams.values() if c > 1) / n, sum(x.rstrip()[-1:] in STOPS_END for x in lines) / m, len(words) / max(1, ends), without(WIDE) / size,
    ]


@dataclass
class Model:
    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for f, (cuts, t) in enumerate(zip(self.cuts, self.tables, strict=True)):
            z += t[np.searchsorted(cuts, x[:, f], "right")]
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            z += t[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def two_cuts(g: np.ndarray, h: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Leaf values over the bins of the best tree of three leaves, found one cut after the other; g, h: sums by bin."""
    bounds, out = [(0, len(g))], np.zeros(len(g))
    cg, ch = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))
    gain = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + penalty)
    for _ in range(2):
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(bounds):
            if b - a > 1:
                c = np.arange(a + 1, b)
                got = gain(a, c) + gain(c, b) - gain(a, b)
                j = int(got.argmax())
                best = max(best, (float(got[j]), k, int(c[j])), key=lambda v: v[0])
        if best[1] is None:
            break
        a, b = bounds.pop(best[1])
        bounds += [(a, best[2]), (best[2], b)]
    for a, b in bounds:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + penalty)
    return out


def corners(g: np.ndarray, h: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Values over a grid of the best cut into four corners."""
    cg, ch = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, h))
    a, b = g.shape
    i, j = np.meshgrid(np.arange(1, a), np.arange(1, b), indexing="ij")

    def cells(c):
        return c[i, j], c[i, b] - c[i, j], c[a, j] - c[i, j], c[a, b] - c[i, b] - c[a, j] + c[i, j]

    gs, hs = cells(cg), cells(ch)
    k = int(sum(x * x / (y + penalty) for x, y in zip(gs, hs, strict=True)).argmax())
    r, c = i.flat[k], j.flat[k]
    v = [x.flat[k] / (y.flat[k] + penalty) for x, y in zip(gs, hs, strict=True)]
    out = np.empty(g.shape)
    out[:r, :c], out[:r, c:], out[r:, :c], out[r:, c:] = v
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, pairs: int = PAIRS) -> Model:
    model = Model()
    mean = float(y.mean()) if len(y) else 0.5
    model.base = float(np.log(max(mean, 1e-6) / max(1 - mean, 1e-6)))
    n_features = x.shape[1]
    grid = lambda v, k: np.unique(np.quantile(v, np.arange(1, k) / k)) if len(v) else np.zeros(0)
    model.cuts = [grid(x[:, f], BINS) for f in range(n_features)]
    model.coarse = [grid(x[:, f], PAIR_BINS) for f in range(n_features)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    if not 0 < mean < 1:
        return model
    binned = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(model.cuts)]
    z = np.full(len(y), model.base)
    for _ in range(rounds):
        for f, b in enumerate(binned):
            p = 1 / (1 + np.exp(-z))
            k = len(model.tables[f])
            step = rate * two_cuts(np.bincount(b, y - p, k), np.bincount(b, p * (1 - p), k))
            model.tables[f] += step
            z += step[b]
    small = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(model.coarse)]
    shape = [len(c) + 1 for c in model.coarse]

    def sums(a, b, v):
        return np.bincount(small[a] * shape[b] + small[b], v, shape[a] * shape[b]).reshape(shape[a], shape[b])

    p = 1 / (1 + np.exp(-z))
    every = [(a, b) for a in range(n_features) for b in range(a + 1, n_features) if shape[a] > 1 and shape[b] > 1]
    worth = lambda ab: float((sums(*ab, y - p) ** 2 / (sums(*ab, p * (1 - p)) + 1)).sum())
    model.pairs = sorted(every, key=lambda ab: (-worth(ab), ab))[:pairs]
    model.pair_tables = [np.zeros((shape[a], shape[b])) for a, b in model.pairs]
    for _ in range(rounds // 2):
        for k, (a, b) in enumerate(model.pairs):
            p = 1 / (1 + np.exp(-z))
            step = rate * corners(sums(a, b, y - p), sums(a, b, p * (1 - p)))
            model.pair_tables[k] += step
            z += step[small[a], small[b]]
    return model


def held_out(doc_id: int | None) -> bool:
    return crc32(str(doc_id).encode()) % 4 == 2


def training(df: DataFrame, labels: DataFrame, label: str, doc_id: str, text: str, sample: int) -> list[tuple]:
    """(text, label, id) of at most `sample` labelled rows that are not held out, those of the least hash of the id."""
    key = F.col("_id")
    known = labels.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.col(f"`{label}`").cast("int").alias("_label")).filter("_label in (0, 1)")
    known = known.filter(F.crc32(key.cast("string").cast("binary")) % 4 != 2).orderBy(F.xxhash64(key), "_id", "_label").limit(sample)
    docs = df.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"))
    return docs.join(F.broadcast(known), "_id").select("_text", "_label", "_id")


def train(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """The features are computed where the texts are; the driver gets numbers only, at most `sample` rows for unique ids."""
    rows = training(df, labels, "quality", doc_id, text, sample)

    def run(batches):
        for batch in batches:
            x = np.array([features(t) for t in slices(batch.column(0))]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "label", "x"])

    got = rows.mapInArrow(run, "id long, label int, x array<double>").orderBy("id", "label").limit(sample).toPandas()
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, len(FEATURES)))
    return fit(x, got["label"].to_numpy(float))


def scores(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids = part.column(0).to_pylist()
                s = model.score(np.array([features(t) for t in slices(part.column(1))]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([held_out(i) for i in ids]), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    df = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return df.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
