"""Benchmark decontamination by pigeonhole edit matching.

Texts are folded (lower case, ASCII punctuation and blanks to one space). A test item of m
bytes has an error budget of k = m * ERRORS_PERCENT // 100 edits and is cut into k + 1 pieces:
a copy with at most k edits leaves one piece untouched. An Aho-Corasick automaton over all
pieces finds the exact hits in one walk of each text; each hit gives a window of the text, and
Myers' bit-parallel algorithm checks whether the item ends in that window within the budget.

The benchmark is the stated query set: it is read in blocks of bounded size, and each block's
automaton is built in the tasks. No join, no shuffle: `keep` decides in the scan, row by row.

Defined cases: null texts and items count as empty and never match; items that fold to nothing
are skipped; equal items each report their own id; a document that holds an item several times
gives one row with the least distance (the end of the first such place that was checked);
very long texts are walked once, and only windows around piece hits are compared;
repeated rows and ids, also null ones, each give their rows; empty tables give an empty result;
other columns, whatever their names, are ignored by `matches` and kept by `keep`.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

ERRORS_PERCENT, BLOCK_BYTES = 5, 4 << 20
FOLD = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))
SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_errors", pa.int32()), ("item_length", pa.int32()), ("match_end", pa.int64())])
DDL = "doc_id long, item_id long, n_errors int, item_length int, match_end long"


def fold(text: str | None) -> str:
    """Folded UTF-8 bytes, one character each."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass").translate(FOLD)
    return b" ".join(raw.split()).decode("latin-1")


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of near-equal length with their offsets."""
    n = errors + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def myers(masks: dict[str, int], m: int, window: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of the item to any substring of the window, and that substring's first end; None if over most."""
    top, full = 1 << (m - 1), (1 << m) - 1
    pv, mv, score, best, end = full, 0, m, most + 1, -1
    get = masks.get
    for at, c in enumerate(window, 1):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full  # a match may start anywhere: no carry into the first row
        mh = mh << 1 & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
        if score < best:
            best, end = score, at
    return (best, end) if best <= most else None


class Matcher:
    def __init__(self, items: list[tuple[int, str]], percent: int) -> None:
        import ahocorasick

        self.items, where = [], {}
        for item_id, text in items:
            if item := fold(text):
                masks: dict[str, int] = {}
                for k, c in enumerate(item):
                    masks[c] = masks.get(c, 0) | 1 << k
                errors = len(item) * percent // 100
                for offset, piece in pieces(item, errors):
                    where.setdefault(piece, []).append((len(self.items), offset))
                self.items.append((item_id, item, errors, masks))
        self.automaton = ahocorasick.Automaton()
        for piece, found in where.items():
            self.automaton.add_word(piece, (len(piece), found))
        if where:
            self.automaton.make_automaton()

    def matches(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """(item_id, errors, item's length, end in the folded text), best of each item."""
        folded = fold(text)
        if not folded or not self.items:
            return
        best: dict[int, tuple[int, int]] = {}
        seen: dict[int, tuple[int, int]] = {}  # the last window that was checked for an item
        for end, (size, found) in self.automaton.iter(folded):
            for k, offset in found:
                _, item, errors, masks = self.items[k]
                if k in best and best[k][0] == 0:
                    continue
                start = end + 1 - size - offset
                if folded.startswith(item, max(start, 0)) and start >= 0:
                    best[k] = min(best.get(k, (1 << 30, 0)), (0, start + len(item)))
                    continue
                a, b = max(0, start - errors), min(len(folded), start + len(item) + errors)
                if k in seen and seen[k][0] <= a and b <= seen[k][1]:
                    continue
                seen[k] = (a, b)
                if got := myers(masks, len(item), folded[a:b], errors):
                    best[k] = min(best.get(k, (1 << 30, 0)), (got[0], a + got[1]))
        for k, (errors, at) in sorted(best.items()):
            yield self.items[k][0], errors, len(self.items[k][1]), at


def blocks(items: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple[int, str]]]:
    """The query set in blocks of at most `limit` bytes, or of one item."""
    block, size = [], 0
    for i, t in items.select(F.col(f"`{item_id}`").cast("long"), F.coalesce(F.col(f"`{text}`"), F.lit(""))).toLocalIterator():
        n = len(t.encode("utf-8", "surrogatepass"))
        if block and size + n > limit:
            yield block
            block, size = [], 0
        block.append((i, t))
        size += n
    yield block


def matches(
    df: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    percent: int = ERRORS_PERCENT, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """A row for each document and test item that it holds within the error budget."""
    df = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = None
    for block in blocks(items, item_id, item_text, block_bytes):

        def make(block=block):
            matcher = Matcher(block, percent)
            return lambda i, t: ((i, *m) for m in matcher.matches(t))

        part = map_rows(df, ["doc_id", "text"], SCHEMA, DDL, make)
        out = part if out is None else out.unionByName(part)
    return out


def keep(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", percent: int = ERRORS_PERCENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """df's rows, all columns, whose text holds no test item: a filter for each block of the query set, whatever the ids are."""
    for block in blocks(items, item_id, item_text, block_bytes):
        df = df.filter(clean(block, percent)(F.col(f"`{text}`")))
    return df


def clean(block: list[tuple[int, str]], percent: int):
    """Whether a text holds none of the block's items."""

    @F.pandas_udf("boolean")
    def check(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(block, percent)
        for part in parts:
            yield part.map(lambda t: next(matcher.matches(t), None) is None).astype(bool)

    return check
