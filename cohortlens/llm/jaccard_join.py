"""Exact n-gram Jaccard join as a metric-space join.

Documents are sets of word shingles; two link when their Jaccard distance
is at most ``1 - t``. Most pairs of documents share nothing, so nearly all
distances to any document pivot equal 1 and plain Voronoi cells would be
replicated everywhere. Regions are therefore formed in two steps.

*Projections.* The symmetric difference is a metric as well, and two linked
sets, the smaller one of a shingles, differ in at most ``tau = (1 / t - 1) a``
of them. Shingles are dealt by hash to slightly more than ``tau + 1``
blocks; the differences cannot touch all of them, so linked sets agree on
a whole block. Each distinct projection of a set on a block is a pivot of
radius 0 with its own region. The distance to the empty set (the size)
gives rings: a set belongs to its ring and, by the triangle inequality, is
replicated into the rings below that a smaller linked set can be in. There
are some more blocks than needed, so that linked sets share several regions
and a set that meets others in fewer has no link.

*Voronoi cells.* In every region all members are compared with its first
member, the pivot. Linked members become one component, which ends most
regions: copies are never paired with each other. What remains in a region
(members of different components) is divided by several pivots: a member
goes to the cell of its nearest pivot and, for the triangle inequality, to
every cell whose pivot is at most ``2 (1 - t)`` farther. Cells are divided
again until they are small and then compared exactly. Regions too large
for a task are first divided by another family of blocks, and if that does
not help, dealt into tiles so that every pair still meets in one task.

Equal sets are one set from the start. Results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import free_name, small_batches, written

#: Members that one task divides and compares, and bytes of their sets.
REGION_MEMBERS, REGION_BYTES = 4096, 32 << 20
LEAF = 192
_MAX_WORDS = 500_000
_WORDS: dict[bytes, int] = {}


# -- sets ------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: a bijection that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``n``-word shingles,
    A-Z in lower case. Fewer words make one shingle; no word, none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(_WORDS) > _MAX_WORDS:
        _WORDS.clear()
    for w in set(words):
        if w not in _WORDS:
            _WORDS[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(n, len(words))
    out = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(words) - size + 1 + k])
    return np.unique(out)


def linked(shared: int, a: int, b: int, percent: int) -> bool:
    return 100 * shared >= percent * (a + b - shared)


def rings(size: int, percent: int) -> list[tuple[int, int]]:
    """(ring, its largest size) of the ring of ``size`` and of those below
    that a smaller linked set can be in."""
    found, low, number = [], 1, 0
    while low <= size:
        high = max(low + 1, low * 8 // 5)
        if 100 * (high - 1) >= percent * size:
            found.append((number, high - 1))
        low, number = high, number + 1
    return found


def region_keys(shingles: np.ndarray, percent: int, seed: int = 0) -> tuple[np.ndarray, int]:
    """Keys of the regions of a set, and how many of them a linked set has
    at least. A set with too few filled blocks to be sure of one that a
    linked set leaves alone also has the empty ones."""
    keys, sure = [], 1 << 30
    dealt = _mix(shingles + np.uint64((seed * 2 + 1) * 0xD1342543DE82EF95 & (1 << 64) - 1))
    for ring, largest in rings(len(shingles), percent):
        tau = largest * (100 - percent) // percent
        if not tau:
            continue  # linked sets of this ring are equal
        blocks = (tau + 1) * 23 // 20 + 3
        block = ((dealt >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        ends = np.flatnonzero(np.diff(block[order], prepend=-1))
        content = np.zeros(blocks, dtype=np.uint64)
        filled = block[order][ends]
        content[filled] = np.add.reduceat(_mix(dealt[order]), ends)
        chosen = np.arange(blocks) if len(filled) < tau + 1 else filled
        sure = min(sure, max(1, len(filled) - tau))
        place = np.uint64(ring << 40) + chosen.astype(np.uint64) + np.uint64(seed << 56)
        keys.append(_mix(_mix(place + np.uint64(1)) + content[chosen]))
    return (np.concatenate(keys), sure) if keys else (np.empty(0, np.uint64), 1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# -- one region --------------------------------------------------------------


def _shared_counts(sets: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of ``sets[rows]`` with all sets."""
    flat, sizes = np.concatenate(sets), [len(s) for s in sets]
    _, column, often = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    used = often > 1  # other shingles are in no intersection of two sets
    number = np.cumsum(used) - 1
    keep = used[column]
    owner, column = owner[keep], number[column[keep]]
    counts = np.zeros((len(rows), len(sets)))
    width = max(1, (8 << 20) // max(1, len(sets)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(used.sum()), width):
        a, b = np.searchsorted(column, (low, low + width))
        matrix = np.zeros((len(sets), width), dtype=np.float32)
        matrix[owner[a:b], column[a:b] - low] = 1.0
        counts += matrix[rows] @ matrix.T
    return counts.astype(np.int64)


def _distances(shared: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return 1.0 - shared / (sizes[rows][:, None] + sizes[None, :] - shared)


def region_links(sets: list[np.ndarray], groups: list[int], percent: int) -> list[tuple[int, int]]:
    """Links between members of different groups, enough of them to join
    whatever links join. Voronoi cells, recursively."""
    found: list[tuple[int, int]] = []
    top = {g: g for g in groups}

    def root(g: int) -> int:
        while top[g] != g:
            top[g] = top[top[g]]
            g = top[g]
        return g

    def divide(members: np.ndarray, depth: int) -> None:
        if len({root(groups[i]) for i in members}) < 2:
            return
        own = [sets[i] for i in members]
        sizes = np.array([len(s) for s in own])
        if len(members) > LEAF:
            count = int(len(members) ** 0.5)
            pivots = np.random.default_rng(depth).permutation(len(members))[:count]
            far = _distances(_shared_counts(own, pivots), sizes, pivots)
            near = far <= far.min(axis=0) + 2 * (1 - percent / 100) + 1e-9
            if near.sum() < len(members) * count / 4:
                for cell in near:
                    divide(members[cell], depth + 1)
                return
        for low in range(0, len(members), LEAF):
            rows = np.arange(low, min(low + LEAF, len(members)))
            shared = _shared_counts(own, rows)
            i, j = np.nonzero(100 * shared >= percent * (sizes[rows][:, None] + sizes[None, :] - shared))
            for x, y in zip(members[rows[i]].tolist(), members[j].tolist()):
                a, b = root(groups[x]), root(groups[y])
                if a != b:
                    top[max(a, b)] = min(a, b)
                    found.append((x, y))

    divide(np.arange(len(sets)), 0)
    return found


# -- components ----------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node that edges reach) for every
    node of ``edges(u, v)``: alternating large and small stars. Each round
    is written, and a hot node's edges only ever meet in a partial
    aggregate or a join."""
    edges = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(least, "u")
        small = pairs.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "edges")


# -- the join ----------------------------------------------------------------


def _sets(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Size, hashes and region keys of every row's set; of rows of one task
    with equal sets only the first has keys."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int]] = set()
        none = np.empty(0, np.int64), 1
        for pdf in batches:
            sets = [shingle_set(t, n) for t in pdf["text"]]
            if len(seen) > _MAX_WORDS:
                seen.clear()
            h1 = [int(s.sum(dtype=np.uint64)) for s in sets]
            h2 = [int(_mix(s).sum(dtype=np.uint64)) for s in sets]
            keys = []
            for s, h in zip(sets, zip(h1, h2)):
                keys.append(none if h in seen else region_keys(s, percent))
                seen.add(h)
            signed = lambda x: np.array(x, dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64"), "th": pdf["th"], "n": [len(s) for s in sets], "h1": signed(h1), "h2": signed(h2),
                "sure": [sure for _, sure in keys], "keys": [_signed(k) for k, _ in keys]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    return rows.mapInPandas(run, "doc_id long, th long, n long, h1 long, h2 long, sure long, keys array<long>").withColumn(
        "rid", F.monotonically_increasing_id())


def _arrays(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``sid, set`` (64-bit hashes) of the wanted representatives, whose
    texts are read again."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"sid": pdf["sid"], "set": [_signed(shingle_set(t, n)) for t in pdf["text"]]})

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("a"), F.col("doc_id").isNull().alias("b"), "text",
                       F.xxhash64("text").alias("c"))
    wanted = wanted.select("sid", F.coalesce("rep_id", F.lit(-1)).alias("a"), F.col("rep_id").isNull().alias("b"), F.col("rep_th").alias("c"))
    # Repeated rows have been dealt to one place by the join.
    first = F.row_number().over(Window.partitionBy("a", "b", "c").orderBy("sid"))
    return rows.join(wanted, ["a", "b", "c"]).withColumn("first", first).filter("first = 1").select("sid", "text").mapInPandas(
        run, "sid long, set array<long>")


def _met(rows: DataFrame, who: str) -> DataFrame:
    """Rows (key, who, ...) of the regions in which at least two meet, each
    once; ``pivot`` is the region's first."""
    w = Window.partitionBy("key")
    met = rows.withColumn("pivot", F.min(who).over(w)).withColumn("last", F.max(who).over(w))
    again = F.row_number().over(Window.partitionBy("key", who).orderBy("pivot"))  # the same exchange serves both
    return met.withColumn("again", again).filter("pivot < last and again = 1").drop("last", "again")


def _compared(pairs: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """The linked ones among ``pairs(u, v)``, exactly."""
    a = arrays.select(F.col("sid").alias("u"), F.col("set").alias("a"))
    b = arrays.select(F.col("sid").alias("v"), F.col("set").alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    return (pairs.join(a, "u").join(b, "v").withColumn("shared", shared)
            .filter(100 * F.col("shared") >= percent * (F.size("a") + F.size("b") - F.col("shared"))).select("u", "v"))


def _open_regions(members: DataFrame) -> DataFrame:
    """Regions (key, sid, comp) of three members or more in at least two
    components. Two members have been compared already."""
    shape = members.groupBy("key").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    return members.join(shape.filter("size > 2 and low < high").select("key"), "key")


def _gathered(regions: DataFrame, sure: DataFrame) -> DataFrame:
    """Gather overlapping regions (key, sid, comp) into cells, so that a set
    travels once per cell and not once per region.

    A region goes to the cell of its first member's first: the smallest
    member of any region that this member is in. Linked sets share at least
    ``sure`` regions, so in that of the common cells where they share most
    they share at least ``sure / c``, for c the number of cells of either: a
    set leaves the cells in which it has fewer regions."""
    by_key = Window.partitionBy("key")
    firsts = regions.withColumn("first", F.min("sid").over(by_key))
    least = firsts.groupBy(F.col("sid").alias("first")).agg(F.min("first").alias("cell"))
    counted = firsts.groupBy("first", "sid").agg(F.count("*").alias("shared"), F.first("comp").alias("comp"))
    placed = counted.join(least, "first").groupBy("cell", "sid").agg(F.sum("shared").alias("shared"), F.first("comp").alias("comp"))
    placed = placed.join(sure, "sid")
    cells = F.count("*").over(Window.partitionBy("sid"))
    placed = placed.withColumn("cells", cells).filter(F.col("shared") * F.col("cells") >= F.col("sure"))
    shape = placed.groupBy("cell").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    return placed.join(shape.filter("low < high").select("cell", "size"), "cell").select(
        F.xxhash64("cell").alias("key"), "sid", "comp", "size")


def _rest_links(cells: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    """Links between components inside the cells (key, sid, comp, size)."""
    def rekey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "sid": pdf["sid"], "comp": pdf["comp"],
                                "more": [_signed(region_keys(s.view(np.uint64), percent, 1)[0]) for s in pdf["set"]]})

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [s.view(np.uint64) for s in pdf["set"]]
        sid = pdf["sid"].tolist()
        return pd.DataFrame([(sid[x], sid[y]) for x, y in region_links(sets, pdf["comp"].tolist(), percent)], columns=["u", "v"], dtype="int64")

    sized = arrays.select("sid", (F.size("set") * 8).alias("size_bytes"))
    fits = F.col("size") <= REGION_MEMBERS
    big = cells.filter(~fits)
    if not big.isEmpty():
        again = big.join(arrays, "sid").mapInPandas(rekey, "key long, sid long, comp long, more array<long>")
        again = again.select("key", "sid", "comp", F.explode("more").alias("more")).select(
            F.xxhash64("key", "more").alias("key"), "sid", "comp").distinct()
        shape = again.groupBy("key").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        again = again.join(shape.filter("low < high").select("key", "size"), "key").select("key", "sid", "comp", "size")
        cells = written(cells.filter(fits).unionByName(again), "cells")
    # A pair of tiles is one task: a member goes to the tasks of its tile.
    load = cells.join(sized, "sid").groupBy("key").agg(F.sum("size_bytes").alias("bytes"))
    tiles = F.ceil(F.greatest(F.col("size") / REGION_MEMBERS, F.col("bytes") / REGION_BYTES)).cast("int")
    tiled = cells.join(load, "key").withColumn("tiles", tiles).withColumn("t", F.pmod(F.xxhash64("sid"), "tiles").cast("int"))
    tiled = tiled.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "key", F.least("t", "o").alias("a"), F.greatest("t", "o").alias("b"), "sid", "comp")
    return tiled.join(arrays, "sid").groupBy("key", "a", "b").applyInPandas(links, "u long, v long")


def _named_sets(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """All rows' sets, and for each distinct non-empty set its component's
    smallest doc_id and representative row."""
    small_batches(docs.sparkSession)
    sets = written(_sets(docs, n, percent), "sets")
    filled = sets.filter("n > 0")
    reps = filled.groupBy("h1", "h2").agg(F.min("doc_id").alias("least_id"), F.min("rid").alias("sid"),
                                          F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("rep"))
    reps = written(reps.select("h1", "h2", "least_id", F.col("rep.doc_id").alias("rep_id"), F.col("rep.th").alias("rep_th"), "sid"), "set-ids")
    chosen = reps.select("sid", "rep_id", "rep_th")
    keyed = filled.select("rid", F.explode("keys").alias("key"))
    names = filled.select("rid", "sure", "h1", "h2").join(reps.select("h1", "h2", "sid"), ["h1", "h2"]).select("rid", "sure", "sid")
    # A set that meets others in fewer regions than a link needs has none.
    able = _met(keyed, "rid").select("key", "rid").join(names, "rid").withColumn(
        "regions", F.count("*").over(Window.partitionBy("rid"))).filter("regions >= sure")
    members = written(_met(able.select("key", "sid", "sure"), "sid"), "regions")
    arrays = written(_arrays(docs, members.select("sid").distinct().join(chosen, "sid"), n), "arrays")
    pairs = members.filter("sid <> pivot").select(F.col("pivot").alias("u"), F.col("sid").alias("v")).distinct()
    edges = written(_compared(pairs, arrays, percent), "links")
    joined = components(edges)
    grouped = members.join(joined.withColumnRenamed("node", "sid"), "sid", "left").select(
        "key", "sid", F.coalesce("component", "sid").alias("comp"))
    sure = members.groupBy("sid").agg(F.min("sure").alias("sure"))
    cells = written(_gathered(written(_open_regions(grouped), "regions"), sure), "cells")
    if not cells.isEmpty():
        more = written(_rest_links(cells, arrays, percent), "links")
        joined = components(edges.unionByName(more))
    named = reps.join(joined.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"), F.min(F.struct(
        F.col("rep_id").isNull(), "rep_id", "rep_th")).alias("keeper"))
    return sets, named.join(least, "component").select("h1", "h2", "component_id", "keeper")


def link_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach, the row's own
    included. Texts without words (null, empty) have no shingle and link
    with nothing. Repeated rows and equal texts link. Null doc_ids take
    part; a component of such rows alone has a null id. Other columns are
    ignored; an empty table gives an empty result."""
    sets, named = _named_sets(docs, n, percent)
    return (sets.select("doc_id", "n", "h1", "h2").join(named.select("h1", "h2", "component_id"), ["h1", "h2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, all columns: that of the smallest doc_id
    (ties by the text's hash). Texts without words link with nothing and
    stay; of rows equal in doc_id and text one stays."""
    sets, named = _named_sets(docs, n, percent)
    kept = named.select(F.col("keeper.rep_id").alias("id"), F.col("keeper.rep_th").alias("th")).unionByName(
        sets.filter("n = 0").select(F.col("doc_id").alias("id"), "th")).distinct()
    own, th, rank = free_name(docs, "keep_id"), free_name(docs, "keep_th"), free_name(docs, "keep_rank")
    kept = kept.select(F.col("id").alias(own + "s"), F.col("th").alias(th + "s"))
    rows = docs.withColumn(own, F.col("doc_id").cast("long")).withColumn(th, F.xxhash64("text"))
    found = rows.join(kept, rows[own].eqNullSafe(kept[own + "s"]) & (rows[th] == kept[th + "s"]))
    one = found.withColumn(rank, F.row_number().over(Window.partitionBy(own, th).orderBy(F.length("text"))))
    return one.filter(F.col(rank) == 1).select(docs.columns)
