"""Secret scans over a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived (Python's own
regex parser gives the syntax tree; alternatives become OR, mandatory literals AND). Texts are
indexed block by block: one vectorised pass over a block's UTF-8 bytes, ASCII letters folded,
gives the postings of exactly the trigrams that some query asks for. Intersecting and uniting
postings leaves the candidates, and only these are verified by the regex. A rule without
mandatory trigrams (hex) scans every text. The filter is sound: trigrams across a border
between texts only add candidates.

Defined cases: a null text counts as empty; each input row gives one row (repeated rows too);
an empty table gives an empty result; a block ends after a bounded number of bytes, one very
long text is a block of its own, and every rule is linear in it; other input columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import to_batch

try:
    from re import _constants as C
    from re import _parser as P
except ImportError:  # the modules' name before Python 3.11
    import sre_constants as C
    import sre_parse as P


@dataclass(frozen=True)
class Rule:
    """least: characters that the group must have; spans are of the whole match."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE_RULES = (
    Rule("assign", r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
ADDED_RULES = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
)
MOST_STRINGS, BLOCK = 64, 8 << 20


def fold(s: str) -> bytes:
    return s.encode().lower()  # bytes.lower folds A-Z only


def all_of(parts: list) -> tuple | None:
    parts = [p for p in parts if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def any_of(parts: list) -> tuple | None:
    if not parts or any(p is None for p in parts):
        return None
    parts = list(dict.fromkeys(parts))
    return parts[0] if len(parts) == 1 else ("or", tuple(parts))


def of_strings(strings: set[str]) -> tuple | None:
    """One of the strings must occur."""
    folded = {fold(s) for s in strings}
    return any_of([all_of([("tri", s[i : i + 3]) for i in range(len(s) - 2)]) for s in sorted(folded)])


def derive(pattern: str) -> tuple | None:
    """The trigram query that every text with a match satisfies; None if there is none (scan all)."""
    return sequence(P.parse(pattern))[1]


def sequence(nodes) -> tuple[set[str] | None, tuple | None]:
    """(all strings that the nodes can match if these are few, query)."""
    done, run, exact = [], {""}, True
    for op, arg in nodes:
        strings, query = one(op, arg)
        if strings is not None and len(strings) * len(run) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        exact = False
        done += [of_strings(run), query if strings is None else of_strings(strings)]
        run = {""}
    return (run, of_strings(run)) if exact else (None, all_of([*done, of_strings(run)]))


def one(op, arg) -> tuple[set[str] | None, tuple | None]:
    if op is C.LITERAL:
        return {chr(arg)}, None
    if op is C.IN:
        chars = set()
        for kind, x in arg:
            if kind is C.LITERAL:
                chars.add(chr(x))
            elif kind is C.RANGE and x[1] - x[0] < 8:
                chars |= {chr(c) for c in range(x[0], x[1] + 1)}
            else:
                return None, None
        return (chars, None) if len(chars) <= 8 else (None, None)
    if op is C.SUBPATTERN:
        return sequence(arg[3])
    if op is C.BRANCH:
        parts = [sequence(x) for x in arg[1]]
        if all(s is not None for s, _ in parts):
            return set().union(*(s for s, _ in parts)), None
        return None, any_of([q if s is None else of_strings(s) for s, q in parts])
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        low, high, inner = arg
        strings, query = sequence(inner)
        if strings is not None and (low, high) == (0, 1):
            return strings | {""}, None
        if strings is not None and low == high and len(strings) ** min(low, 7) <= MOST_STRINGS and low <= 8:
            return {"".join(x) for x in product(strings, repeat=low)}, None
        return None, (query if strings is None else of_strings(strings)) if low else None
    return (({""}, None) if op in (C.AT, C.ASSERT, C.ASSERT_NOT) else (None, None))


def trigrams(query: tuple | None) -> set[bytes]:
    if query is None:
        return set()
    return {query[1]} if query[0] == "tri" else set().union(*map(trigrams, query[1]))


class Index:
    """Postings of the asked trigrams over blocks of texts."""

    def __init__(self, queries: list) -> None:
        self.queries = queries
        asked = sorted(set().union(*map(trigrams, queries)))
        self.code = {t: k for k, t in enumerate(asked)}
        self.pair = np.zeros(1 << 16, bool)
        for t in asked:
            self.pair[t[0] << 8 | t[1]] = True
        self.full = np.array([int.from_bytes(t, "big") for t in asked], np.uint32)
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32

    def postings(self, data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """For each trigram the ordinals of texts with it; data: bytes, starts: of each text."""
        b = self.fold[data]
        codes = b[:-1].astype(np.uint16) << 8 | b[1:]
        at = np.flatnonzero(self.pair[codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
        tri = codes[at].astype(np.uint32) << 8 | b[at + 2] if len(at) else np.zeros(0, np.uint32)
        k = np.searchsorted(self.full, tri)
        k[k == len(self.full)] = 0
        good = self.full[k] == tri if len(self.full) else np.zeros(0, bool)
        docs, k = np.searchsorted(starts, at[good], "right") - 1, k[good]
        return [np.unique(docs[k == x]) for x in range(len(self.full))]

    def candidates(self, query: tuple | None, posted: list[np.ndarray], n: int) -> np.ndarray:
        if query is None:
            return np.arange(n)
        if query[0] == "tri":
            return posted[self.code[query[1]]]
        found = [self.candidates(q, posted, n) for q in query[1]]
        out = found[0]
        for x in found[1:]:
            out = np.intersect1d(out, x, assume_unique=True) if query[0] == "and" else np.union1d(out, x)
        return out


def blocks(column: pa.Array):
    """Slices of a string column of at most BLOCK bytes, or of one text."""
    sizes = pc.binary_length(column.fill_null("")).to_numpy(zero_copy_only=False)
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > BLOCK:
            yield at, column.slice(at, i - at)
            at, total = i, 0
        total += n
    if len(sizes):
        yield at, column.slice(at)


def find(texts: list[str], rules: tuple[Rule, ...], index: Index, compiled: list[re.Pattern]) -> list[list[tuple[int, int, int]]]:
    """For each text its spans (start, rule's number, end), sorted."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.cumsum([0, *map(len, raw)])[:-1]
    posted = index.postings(np.frombuffer(b"".join(raw), np.uint8), starts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, regex, query) in enumerate(zip(rules, compiled, index.queries, strict=True)):
        for i in index.candidates(query, posted, len(texts)).tolist():
            for m in regex.finditer(texts[i]):
                s, e = m.span(rule.group)
                if e - s >= rule.least:
                    out[i].append((m.start(), k, m.end()))
    for x in out:
        x.sort()
    return out


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])
DDL = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long"


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", added: tuple[Rule, ...] = ADDED_RULES) -> DataFrame:
    """A row for each document: counts of the base kinds, digest of the base spans, all spans, number of added ones."""
    rules = (*BASE_RULES, *added)
    queries = [derive(r.pattern) for r in rules]
    n = len(BASE_RULES)

    def run(batches):
        index, compiled = Index(queries), [re.compile(r.pattern) for r in rules]
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, part in blocks(batch.column(1)):
                texts = [t or "" for t in part.to_pylist()]
                rows = []
                for i, found in zip(ids[at : at + len(texts)], find(texts, rules, index, compiled), strict=True):
                    said = [(k, f"{rules[k].kind}:{s}:{e}") for s, k, e in found]
                    base = ",".join(x for k, x in said if k < n)
                    rows.append((i, *(sum(k == b for k, _ in said) for b in range(n)), hashlib.sha256(base.encode()).hexdigest(), ",".join(x for _, x in said), sum(k >= n for k, _ in said)))
                yield to_batch(rows, SCHEMA)

    return df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(run, DDL)
