"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Groups of equal texts are the units and stay whole, in one shard. Only a group that is larger
than a shard's share of the bytes, tokens or rows is divided (a third of all rows may be one
text), into parts of at most a PARTS-th of a shard. Groups of at least an n-th of a total
(n = LARGE) are items of the packing by themselves: at most 3 * LARGE, whatever the input's size.
All smaller groups are gathered by their hash, each whole, into at most BUNDLES items, so that
the driver gets a bounded number of sums; below that number an item is mostly one group.

Items go in order of size to the shard where the dot product of the item's vector (bytes, tokens,
rows as shares of the totals) with the shard's residual capacity is highest. Then moves and swaps
even out the bytes, which is the law that holds: `bytes`, sizes near equal. Of the moves that
serve the bytes best, or well enough, the one that leaves tokens and rows most even is taken.

Slots are gapless without sorting a shard or a large group in one task: each block of an item has
an offset in its shard, and rows are numbered within their block.

Defined cases: a null text has size 1, no tokens, and CRC 0, as an empty one has, and is one
group with it; very long texts are one row of a large size; ties are broken by item number;
repeated rows and ids, also null ones, each get a slot of their own; an empty table gives an
empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, words

SHARDS, BUNDLES, LARGE, PARTS, BLOCK_ROWS, BLOCKS = 16, 1 << 16, 1024, 4, 100_000, 1 << 16
DIMS = ("size", "tokens", "n")


def pack(items: np.ndarray, shards: int) -> np.ndarray:
    """items: rows of (size, tokens, n) -> shard of each item."""
    share = items / np.maximum(1, items.sum(0))
    free = np.full((shards, 3), 1.0 / shards)
    out = np.zeros(len(items), np.int64)
    for i in np.lexsort((np.arange(len(items)), -share.max(1))).tolist():
        out[i] = best = int((free @ share[i]).argmax())
        free[best] -= share[i]
    even(items, out, shards)
    return out


def even(items: np.ndarray, out: np.ndarray, shards: int) -> None:
    """Moves and swaps between the fullest and the emptiest shard until their bytes are within a 2000th of a shard, or no step helps."""
    load = np.stack([np.bincount(out, items[:, d], shards) for d in range(3)], 1)
    enough = load[:, 0].mean() / 2000
    weight = 1 / np.maximum(1, load.sum(0))
    for _ in range(64 * shards):
        high, low = int(load[:, 0].argmax()), int(load[:, 0].argmin())
        gap = load[high, 0] - load[low, 0]
        if gap <= enough:
            return
        a, b = np.flatnonzero(out == high), np.flatnonzero(out == low)
        b = b[np.argsort(items[b, 0], kind="stable")]
        near = np.searchsorted(items[b, 0], items[a, 0] - gap / 2)
        steps = [(a, np.full(len(a), -1))]  # a move of i, or a swap of i for the partner whose size takes the gap nearest to zero
        for k in (near - 1, near):
            ok = (k >= 0) & (k < len(b))
            steps.append((a[ok], b[k[ok]]))
        i, j = (np.concatenate(x) for x in zip(*steps, strict=True))
        change = items[i] - np.where((j >= 0)[:, None], items[j], 0)
        left = np.abs(gap - 2 * change[:, 0])
        if not len(left) or left.min() >= gap:
            return
        good = np.flatnonzero(left <= max(left.min(), enough))
        uneven = (np.abs(load[high, 1:] - load[low, 1:] - 2 * change[good, 1:]) * weight[1:]).sum(1)
        k = int(good[uneven.argmin()])
        out[i[k]] = low
        if j[k] >= 0:
            out[j[k]] = high
        load[high] -= change[k]
        load[low] += change[k]


def assign(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, tokens) for each row."""
    spark = df.sparkSession
    scratch = Scratch(spark, "sharding")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    slim = scratch.save(
        df.select(
            F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
            (F.octet_length(t) + 1).cast("long").alias("size"),
            F.crc32(t.cast("binary")).alias("text_crc32"),
            F.size(words(t)).cast("long").alias("tokens"),
            F.xxhash64(t).alias("group"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    sums = [F.sum(c if c != "n" else F.lit(1)).cast("long").alias(c) for c in DIMS]
    total = slim.agg(*sums).first()
    least = {c: max(1, -(-(total[c] or 1) // LARGE)) for c in DIMS}
    shares = F.greatest(*(F.col(c) * shards / max(1, total[c] or 1) for c in DIMS))
    parts = F.when(shares > 1, F.ceil(shares * PARTS)).otherwise(1).cast("int").alias("parts")
    # Groups that reach a LARGE-th of a total: at most LARGE for each of the three.
    large = slim.groupBy("group").agg(*sums).filter(" OR ".join(f"{c} >= {least[c]}" for c in DIMS)).select("group", parts)
    first, numbered = BUNDLES, []
    for g, k in sorted(map(tuple, large.collect())):
        numbered.append((g, first, k))
        first += k
    known = spark.createDataFrame(numbered, "group long, first int, parts int")
    part = F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts").cast("long")).cast("int")
    item = F.coalesce(part, F.pmod(F.col("group"), F.lit(BUNDLES)).cast("int")).alias("item")
    placed = slim.join(F.broadcast(known), "group", "left").select("doc_id", "size", "text_crc32", "tokens", "row", item)
    items = pd.DataFrame(placed.groupBy("item").agg(*sums).collect(), columns=["item", *DIMS]).sort_values("item", ignore_index=True)
    items["shard"] = pack(items[list(DIMS)].to_numpy(np.float64).reshape(-1, 3), shards)
    # An item of very many rows is numbered in blocks: at most BLOCKS more than there are items.
    items["blocks"] = np.maximum(1, -(-items["n"].astype(np.int64) // max(BLOCK_ROWS, (total["n"] or 0) // BLOCKS)))
    said = spark.createDataFrame(items[["item", "shard", "blocks"]].values.tolist(), "item int, shard int, blocks int")
    blocked = placed.join(F.broadcast(said), "item").withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.col("blocks").cast("long")).cast("int"))
    counted = blocked.filter("blocks > 1").groupBy("item", "block").agg(F.count("*").alias("n")).collect() if (items["blocks"] > 1).any() else []
    single = items[items["blocks"] == 1]
    every = sorted([*((r["item"], r["block"], r["n"]) for r in counted), *zip(single["item"].tolist(), [0] * len(single), single["n"].tolist(), strict=True)])
    shard_of, filled, rows = dict(zip(items["item"].tolist(), items["shard"].tolist(), strict=True)), [0] * shards, []
    for i, block, n in every:
        rows.append((i, block, filled[shard_of[i]]))
        filled[shard_of[i]] += n
    offsets = spark.createDataFrame(rows, "item int, block int, first_slot long")
    row = F.row_number().over(W.partitionBy("item", "block").orderBy("doc_id", "row"))
    return blocked.withColumn("number", row).join(F.broadcast(offsets), ["item", "block"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first_slot") + F.col("number") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "tokens"
    )
