"""Sharding by Karmarkar-Karp differencing, so that the bytes of shards are near equal.

Documents of equal text are one indivisible group; a null text counts as the empty one. Groups are
pre-aggregated. Where they are more than AT_ONCE, they are dealt by hash to runs of about that many, each
run differenced into UNITS parts, and these parts are the items of the next level, until at most AT_ONCE
items are left; groups of a HEAVY share of all bytes go straight to the last level, where they are few.
The last level differences what is left into the shards. So no task or driver holds more than AT_ONCE
items or so, and a group of a third of all bytes gets a shard of its own while the others stay even.

Repeated rows and null doc_ids are rows of their own, with slots of their own. Ties are broken by the key
of the group. An empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered

SHARDS, OVERHEAD = 24, 8
AT_ONCE, UNITS, HEAVY = 32768, 256, 1 / 2048
KEY = ["text_hash", "size", "text_crc32"]


def difference(sizes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each item: the two partial partitions of largest spread are combined in opposite order, again and again."""
    n = len(sizes)
    if n == 0:
        return np.zeros(0, np.int64)
    sums: dict[int, np.ndarray] = {}
    heap = []
    for i, s in enumerate(sizes):
        v = np.zeros(parts, np.int64)
        v[0] = s
        sums[i] = v
        heap.append((-int(s), i))
    heapq.heapify(heap)
    made = []
    for new in range(n, 2 * n - 1):
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        both -= both[-1]
        sums[new] = both
        made.append((a, b, order.astype(np.uint16)))
        heapq.heappush(heap, (-int(both[0]), new))
    labels = {2 * n - 2: np.arange(parts)}
    for new in range(2 * n - 2, n - 1, -1):
        a, b, order = made[new - n]
        mine = labels.pop(new)
        left, right = np.empty(parts, np.int64), np.empty(parts, np.int64)
        left[order] = mine
        right[parts - 1 - order.astype(np.int64)] = mine
        labels[a], labels[b] = left, right
    return np.array([labels[i][0] for i in range(n)])


def _run(items: DataFrame, keys: list[str], runs: int, units: int) -> DataFrame:
    """items with their unit: each run of about AT_ONCE items is differenced into units."""

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bytes", *keys], ascending=False, kind="stable").reset_index(drop=True)
        pdf["unit"] = pdf["run"] * units + difference(pdf["bytes"].to_numpy(), units)
        return pdf[[*keys, "bytes", "unit"]]

    dealt = items.withColumn("run", F.pmod(F.xxhash64(*keys), F.lit(runs)))
    return cut(dealt.groupBy("run").applyInPandas(part, ", ".join(f"{k} long" for k in [*keys, "bytes", "unit"])))


def assign(groups: DataFrame, shards: int = SHARDS, at_once: int = AT_ONCE, units: int = UNITS) -> DataFrame:
    """The groups (KEY, bytes) with their shard."""
    spark = groups.sparkSession
    n, total = groups.agg(F.count("*"), F.sum("bytes")).first()
    keys, light, maps = KEY, groups, []
    heavy_at = max(1, int((total or 0) * HEAVY))
    heavy = groups.filter(F.col("bytes") >= heavy_at).select(*KEY, "bytes").toPandas() if n > at_once else None
    if heavy is not None:
        light = groups.filter(F.col("bytes") < heavy_at)
    while n > at_once:
        level = _run(light, keys, -(-n // at_once), units)
        maps.append((level.drop("bytes"), keys))
        light, keys = level.groupBy(F.col("unit").alias("item")).agg(F.sum("bytes").alias("bytes")), ["item"]
        n = light.count()
    last = light.select(*keys, "bytes").toPandas().sort_values(["bytes", *keys], ascending=False)
    sizes = np.concatenate([last["bytes"].to_numpy(np.int64), heavy["bytes"].to_numpy(np.int64) if heavy is not None else np.zeros(0, np.int64)])
    shard = difference(sizes, shards)
    kinds = lambda ks: ", ".join([*(f"{k} long" for k in ks), "shard int"])
    table = lambda pdf, ks, part: spark.createDataFrame(pdf[ks].assign(shard=part.astype(np.int32)), kinds(ks))
    out = table(last, keys, shard[: len(last)])
    for level, ks in reversed(maps):
        out = level.join(F.broadcast(out) if ks is KEY and len(maps) == 1 else out, level["unit"] == out["item"]).select(*ks, "shard") if "item" in out.columns else out
        out = out if ks is KEY else out.withColumnsRenamed({k: "item" for k in ks})
    if heavy is not None:
        out = reduce(DataFrame.unionByName, [out, table(heavy, KEY, shard[len(last) :])])
    return out


def shard(docs: DataFrame, shards: int = SHARDS, at_once: int = AT_ONCE, units: int = UNITS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    groups = cut(rows.groupBy(*KEY).agg((F.count("*") * F.col("size")).alias("bytes")))
    placed = rows.join(assign(groups, shards, at_once, units), KEY)
    out = numbered(placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard"), ["shard"], "slot")
    return out.withColumn("grown_shard", F.lit(None).cast("int"))
