"""Sharding by sampled splitters under the ``bytes`` law.

Documents are ranged along a 53-bit hash of their text. A size-weighted
sample gives quantile boundaries for many more ranges than shards; true
loads are then counted, keys that fill a range alone are fenced off, and
ranges that are still overfull get boundaries of their own. Equal texts
share a key, so a group of copies stays in one range; only a group larger
than a shard's fair share is dealt over shards (by doc_id). Whole ranges
go to shards largest first, each to the emptiest shard. A slot is the
range's offset in its shard plus the row's rank in its range, so no task
ever orders more than one range.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import written
from cohortlens.llm.splitters import MAX_RANGES, sampled_splits, with_range

RANGES_PER_SHARD = 128
ROWS_PER_RANGE = 500_000
OVERFULL = 2.0


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 11).cast("double").alias("key"),
        F.monotonically_increasing_id().alias("row"))


def _loads(ranged: DataFrame) -> list:
    return ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"),
                                       F.min("key").alias("low"), F.max("key").alias("high")).collect()


def _boundaries(rows: DataFrame, shards: int) -> tuple[list[float], list]:
    """Splits and loads such that a range is overfull only if it holds one
    key."""
    count, total = rows.agg(F.count("*"), F.sum("size")).first()
    if not count:
        return [], []
    parts = min(MAX_RANGES, max(RANGES_PER_SHARD * shards, math.ceil(count / ROWS_PER_RANGE)))
    fair_bytes, fair_rows = OVERFULL * total / parts, max(2.0, OVERFULL * count / parts)
    splits = sampled_splits(rows, "key", "size", ["doc_id", "row"], parts)
    while True:
        ranged = with_range(rows, "key", splits, "range")
        loads = _loads(ranged)
        over = [r for r in loads if r["low"] < r["high"] and (r["bytes"] > fair_bytes or r["rows"] > fair_rows)]
        if not over:
            return splits, loads
        inside = ranged.filter(F.col("range").isin([r["range"] for r in over]))
        hot = inside.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).filter(
            (F.col("bytes") > fair_bytes / 2) | (F.col("rows") > fair_rows / 2)).collect()
        fenced = {k for r in hot for k in (r["key"], r["key"] + 1)}
        if fenced <= set(splits):
            more = max(2, math.ceil(sum(max(r["bytes"] / fair_bytes, r["rows"] / fair_rows) for r in over) * 2))
            fenced |= set(sampled_splits(inside, "key", "size", ["doc_id", "row"], more))
            fenced |= {math.ceil((r["low"] + r["high"]) / 2) * 1.0 for r in over}
        splits = sorted(set(splits) | fenced)


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every
    row of ``docs``.

    A null text has size 1 (no bytes plus one) and the checksum 0 of the
    empty text. Repeated rows are rows of their own: they share a shard
    like other equal texts and get slots of their own, ties in doc_id
    included. Null doc_ids sort first. An empty table gives an empty
    result. Other columns are ignored. Only the narrow columns are ever
    written or shuffled, never the texts."""
    rows = written(_narrow(docs), "shard-rows")
    splits, loads = _boundaries(rows, shards)
    total, count = sum(r["bytes"] for r in loads), sum(r["rows"] for r in loads)
    # A range of one overfull key is ranked (and, beyond a shard's share,
    # dealt out) in cells by a hash of the row.
    parts = max(1, len(loads))
    cells_of = {r["range"]: max(1, math.ceil(max(r["bytes"] * parts / total, r["rows"] * parts / count) / OVERFULL))
                if r["low"] == r["high"] else 1 for r in loads}
    session = rows.sparkSession
    wide = {k: n for k, n in cells_of.items() if n > 1}
    ranged = with_range(rows, "key", splits, "range")
    if wide:
        several = session.createDataFrame(list(wide.items()), "range int, cells int")
        ranged = ranged.join(F.broadcast(several), "range", "left")  # at most one row per range
        ranged = ranged.withColumn("cell", F.coalesce(F.pmod(F.xxhash64("doc_id", "row"), "cells"), F.lit(0)).cast("int"))
    else:
        ranged = ranged.withColumn("cell", F.lit(0))
    cells = ranged.groupBy("range", "cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    whole = {r["range"]: r["bytes"] for r in loads}
    units: dict[tuple, list] = {}
    for c in cells:
        alone = whole[c["range"]] > total / shards
        units.setdefault((c["range"], c["cell"] if alone else -1), []).append(c)
    heap = [(0, s) for s in range(shards)]
    dealt: dict[int, list] = {}
    for _, unit in sorted(units.items(), key=lambda u: (-sum(c["bytes"] for c in u[1]), u[0])):
        filled, s = heapq.heappop(heap)
        dealt.setdefault(s, []).extend(unit)
        heapq.heappush(heap, (filled + sum(c["bytes"] for c in unit), s))
    places = []
    for s, own in dealt.items():
        offset = 0
        for c in sorted(own, key=lambda c: (c["range"], c["cell"])):
            places.append((c["range"], c["cell"], s, offset))
            offset += c["rows"]
    place = session.createDataFrame(places, "range int, cell int, shard int, offset long")
    rank = F.row_number().over(Window.partitionBy("range", "cell").orderBy("key", "doc_id", "row"))
    return (ranged.withColumn("rank", rank)
            .join(F.broadcast(place), ["range", "cell"])  # one row per cell, at most about twice MAX_RANGES
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("offset") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
