"""Variable-capacity best-fit packing of documents into training sequences.

A document's length is its number of words plus one end mark (or a given column). Documents
longer than the largest permitted sequence are cut into full pieces and a rest. What decides the
packing is only how many pieces have each length, so one packing of the whole table is made on
the driver from that histogram, which has no more entries than the largest capacity.

Best fit decreasing, for all pieces of one length at once: they go to the open bins with the
least room that holds them. When no open bin holds one, new bins are opened. Each permitted
capacity that holds the piece is tried against the pieces that are left (as many of this length
as fit, then always the longest that still fits), and the capacity with the least cost for each
token wins; the cost of a bin grows with its length (cost = capacity * (1 + capacity / ATTENTION)).
At the end each bin is downsized to the smallest permitted capacity that holds its contents.

Bins with equal contents are one pattern with a count. Pieces of a length are numbered (within
blocks of BLOCK_ROWS rows, whose offsets come from their counts), and the number says which
pattern and bin a piece goes to: a binary search in a table that is bounded by the capacities.

Defined cases: null and blank texts have length one (the end mark); a given length that is null
or below one takes no room: it gives a row with a null bin and capacity zero; very long texts are
cut, never dropped; repeated rows and ids each are packed; an empty table gives an empty result;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, words

CAPACITIES, ATTENTION, BLOCK_ROWS = (512, 1024, 2048, 4096), 16384, 100_000
DDL = "doc_id long, piece int, n_pieces int, length int, bin long, bin_capacity int, bin_offset int, bin_filled int"


def cost(capacity: int) -> float:
    return capacity * (1 + capacity / ATTENTION)


def highest(bits: int, most: int) -> int:
    """The largest member of a bit set up to `most`, 0 if there is none."""
    return (bits & ((2 << most) - 1)).bit_length() - 1 if bits & ((2 << most) - 1) else 0


def opened(counts: dict[int, int], bits: int, n: int, sizes: list[int]) -> int:
    """The capacity of least cost for each token of a new bin that starts with a piece of length n."""
    tried = []
    for c in sizes:
        if c < n:
            continue
        room, at = c, n
        while at:
            room -= at * min(room // at, counts[at])
            at = highest(bits, min(room, at - 1)) if room else 0
        tried.append((cost(c) / (c - room), c))
    return min(tried)[1]


def pack(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(capacity, number of bins, contents as (length, pieces)) of each pattern; lengths are within 1 .. the largest capacity."""
    sizes, left = sorted(capacities), {n: c for n, c in histogram.items() if c > 0}
    bits = sum(1 << n for n in left)
    open_bins: dict[int, list[tuple[int, tuple]]] = {}  # room -> patterns as (bins, contents), contents as a linked list
    rooms = 0

    def put(room: int, bins: int, contents: tuple) -> None:
        nonlocal rooms
        open_bins.setdefault(room, []).append((bins, contents))
        rooms |= 1 << room

    for n in sorted(left, reverse=True):
        while left[n]:
            above = rooms >> n
            if above:
                room = n + (above & -above).bit_length() - 1
                bins, contents = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms ^= 1 << room
            else:
                room, contents = opened(left, bits, n, sizes), ()
                bins = -(-left[n] // (room // n))
            each = min(room // n, left[n])
            full = min(bins, left[n] // each)
            put(room - n * each, full, (n, each, contents))
            left[n] -= full * each
            if bins > full:
                if left[n]:  # the last bin takes fewer
                    put(room - n * left[n], 1, (n, left[n], contents))
                    left[n], full = 0, full + 1
                if contents and bins > full:
                    put(room, bins - full, contents)
        bits ^= 1 << n
    out = []
    for room in sorted(open_bins):
        for bins, contents in open_bins[room]:
            pieces = []
            while contents:
                pieces.append(contents[:2])
                contents = contents[2]
            pieces.reverse()
            out.append((sizes[bisect_left(sizes, sum(n * k for n, k in pieces))], bins, pieces))
    return out


def places(patterns: list[tuple[int, int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """A row for each pattern and length, sorted by (length, first): pieces of the length from number `first` on lie `each` to a bin, in the bins from `bin` on."""
    rows, following, bin_ = [], {}, 0
    for capacity, bins, pieces in patterns:
        filled, offset = sum(n * k for n, k in pieces), 0
        for n, each in pieces:
            first = following.get(n, 0)
            rows.append((n, first, each, bin_, capacity, offset, filled))
            following[n] = first + bins * each
            offset += n * each
        bin_ += bins
    table = np.array(sorted(rows), np.int64).reshape(-1, 7)
    return dict(zip(("length", "first", "each", "bin", "capacity", "offset", "filled"), table.T.copy(), strict=True))


def sequences(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: Column | None = None, capacities: tuple[int, ...] = CAPACITIES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row for each piece: its document, place among the document's pieces, length, bin, and the bin's capacity, offset of the piece and contents."""
    spark, largest = df.sparkSession, max(capacities)
    scratch = Scratch(spark, "packing")
    n = F.size(words(F.col(f"`{text}`"))) + 1 if length is None else F.greatest(F.coalesce(length, F.lit(0)), F.lit(0))
    slim = scratch.save(df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), n.cast("long").alias("n"), F.monotonically_increasing_id().alias("row")))
    # Blocks for the numbering: rows of one length are dealt by the number of their row, so that a length of very many rows has many blocks.
    pieces = F.greatest(F.ceil(F.col("n") / largest), F.lit(1)).cast("int")
    cut = slim.withColumn("n_pieces", pieces).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)))
    size = F.least(F.lit(largest), F.col("n") - F.col("piece").cast("long") * largest).cast("int").alias("length")
    blocks = max(1, -(-slim.count() // block_rows))
    cut = cut.select("doc_id", "piece", "n_pieces", size, "row", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"))
    counts = scratch.save(cut.groupBy("block", "length").agg(F.count("*").alias("c")))
    histogram = {r["length"]: r["c"] for r in counts.filter("length > 0").groupBy("length").agg(F.sum("c").alias("c")).collect()}
    held = spark.sparkContext.broadcast(places(pack(histogram, capacities)))
    before = F.sum("c").over(W.partitionBy("length").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    base = counts.select("block", "length", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy("block", "length").orderBy("doc_id", "piece", "row"))
    numbered = cut.withColumn("rank", rank).join(base, ["block", "length"]).select("doc_id", "piece", "n_pieces", "length", (F.col("before") + F.col("rank") - 1).alias("number"))

    def place(batches):
        t = held.value
        for batch in batches:
            n, number = batch.column(3).to_numpy().astype(np.int64), batch.column(4).to_numpy()
            # (length, number) in one sorted order: search each length's part of the table.
            low, high = np.searchsorted(t["length"], n), np.searchsorted(t["length"], n, "right")
            at = np.empty(len(n), np.int64)
            for x in np.unique(n).tolist():
                own = np.flatnonzero(n == x)
                a, b = int(low[own[0]]), int(high[own[0]])
                at[own] = a + np.searchsorted(t["first"][a:b], number[own], "right") - 1
            none = n == 0
            at[none] = 0
            known = t if len(t["length"]) else dict.fromkeys(t, np.ones(1, np.int64))
            q = number - known["first"][at]
            values = (known["bin"][at] + q // known["each"][at], known["capacity"][at], known["offset"][at] + q % known["each"][at] * n, known["filled"][at])
            bin_, capacity, offset, filled = (np.where(none, 0, v) for v in values)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(bin_, mask=none), *(pa.array(v.astype(np.int32)) for v in (capacity, offset, filled))],
                names=["doc_id", "piece", "n_pieces", "length", "bin", "bin_capacity", "bin_offset", "bin_filled"],
            )

    return numbered.mapInArrow(place, DDL)
