"""Source divergence audit over a transducer vocabulary.

How do the sources of a language differ in their words? Terms are runs of
ASCII letters (lower-cased) and of characters beyond ASCII; a language keeps
the terms of at least ``least`` of its documents.

1. Document frequencies: tasks count distinct terms per document in a bounded
   dictionary, Spark adds them up.
2. The kept terms are sorted (by range, so no task holds a language) and get
   their lexicographic ordinals. Consecutive terms of at most ``BLOCK_BYTES``
   become one minimal acyclic transducer (``term_transducer``) each.
3. Recount: the texts are streamed through the transducers, which give the
   ordinal of every term on the way; no term is hashed or compared again.
   Transducers are broadcast at most ``BROADCAST_BYTES`` at a time: beyond
   that the texts are streamed once for each such set.
4. Shares ``p = 1 + floor(10^9 (n + 2) / (N + 2 V))`` and ``f = floor((p - q)^2
   / (p + q))`` are whole numbers. Pairs of sources are compared in tiles of
   ``TILE`` sources by ``WIDTH`` ordinals; ties among terms go by ordinal.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import parts_for, small_batches, written
from cohortlens.llm.term_transducer import LOWER, SPACED, Transducer, build, term_spans, text_buffer

#: Entries and bytes of text after which a task hands on its counts.
ENTRIES, TEXT_BYTES = 400_000, 256 << 20
#: Term bytes of one transducer; transducer bytes of one broadcast.
BLOCK_BYTES, BROADCAST_BYTES = 1 << 20, 64 << 20
#: Text that is walked at once.
SLICE_BYTES = 4 << 20
TILE, WIDTH = 256, 1024
UNIT = 10**9


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


# ------------------------------------------------------------- vocabulary

def document_frequencies(texts: DataFrame) -> DataFrame:
    """``lang, term, df``: documents of the language that hold the term."""
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)
        size = 0

        def handed_on():
            for lang, terms in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms)), pa.array(list(terms), pa.binary()), pa.array(list(terms.values()), pa.int64())],
                    names=["lang", "term", "df"])
            seen.clear()

        for batch in it:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                raw = text.as_buffer().to_pybytes()
                seen[lang].update(set(raw.translate(SPACED).split()))
                size += len(raw)
                if size > TEXT_BYTES:
                    yield from handed_on()
                    size = 0
            if sum(map(len, seen.values())) > ENTRIES:
                yield from handed_on()
                size = 0
        yield from handed_on()

    return (texts.select("lang", "text").mapInArrow(count, "lang string, term binary, df long")
            .groupBy("lang", "term").agg(F.sum("df").alias("df")))


def vocabulary(texts: DataFrame, least: int) -> DataFrame:
    """``lang, term, ordinal, block``: the kept terms with their rank in
    the language, by their bytes, and the block of consecutive terms."""
    kept = written(document_frequencies(texts).filter(F.col("df") >= least).select("lang", "term"), "kept-terms")
    parts = parts_for(kept.agg(F.sum(F.octet_length("term"))).first()[0] or 0, 16 * BLOCK_BYTES,
                      kept.sparkSession.sparkContext.defaultParallelism)

    def numbered(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, size = None, 0, 0
        for batch in it:
            rows = []
            for lang, term, part in zip(*[batch.column(c).to_pylist() for c in ("lang", "term", "part")], strict=True):
                if lang != now:
                    now, at, size = lang, 0, 0
                rows.append((lang, term, part, at, size))
                at, size = at + 1, size + len(term)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.binary(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                    names=["lang", "term", "part", "at", "size"])

    ranged = written(kept.repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
                     .withColumn("part", F.spark_partition_id())
                     .mapInArrow(numbered, "lang string, term binary, part int, at long, size long"), "numbered-terms")
    totals = ranged.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("terms"), F.sum(F.octet_length("term")).alias("bytes"))
    earlier = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    shifts = totals.select("lang", "part", F.coalesce(F.sum("terms").over(earlier), F.lit(0)).alias("terms"),
                           F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes"))
    return ranged.join(shifts, ["lang", "part"]).select(
        "lang", "term", (F.col("at") + F.col("terms")).alias("ordinal"),
        F.floor((F.col("size") + F.col("bytes")) / BLOCK_BYTES).alias("block"))


_BUILT = "lang string, block long, first long, terms long, key binary, target binary, output binary, final binary, root long"


def transducers(terms: DataFrame) -> DataFrame:
    """A minimal acyclic transducer for each block of the vocabulary."""
    def made(table: pa.Table) -> pa.Table:
        t = build(sorted(table.column("term").to_pylist()))
        row = {"lang": table.column("lang")[0].as_py(), "block": table.column("block")[0].as_py(),
               "first": min(table.column("ordinal").to_pylist()), "terms": table.num_rows,
               **{k: t[k].tobytes() for k in ("key", "target", "output", "final")}, "root": t["root"]}
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        return pa.Table.from_pylist([row], schema=pa.schema([(n, kinds[k]) for n, k in (c.split() for c in _BUILT.split(", "))]))

    return terms.groupBy("lang", "block").applyInArrow(made, _BUILT)


# ---------------------------------------------------------------- recount

class _Loaded:
    """Broadcast rows of ``transducers``, opened once in a worker."""

    def __init__(self, rows: list[dict]):
        parts = [{"root": r["root"], "final": np.frombuffer(r["final"], dtype=bool),
                  **{k: np.frombuffer(r[k], dtype=np.int64) for k in ("key", "target", "output")}} for r in rows]
        self.walk = Transducer(parts, [r["first"] for r in rows])
        self.of: dict[str, list[int]] = defaultdict(list)
        for n, r in enumerate(rows):
            self.of[r["lang"]].append(n)
        self.most = max(map(len, self.of.values()), default=0)

    def counted(self, data: np.ndarray, at: np.ndarray, langs: list[str], lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text number and ordinal of every kept term of the texts."""
        start, length, text = term_spans(data, at)
        part = np.array([[*self.of.get(x, ()), *[-1] * (self.most - len(self.of.get(x, ())))] for x in langs], dtype=np.int64).reshape(len(langs), self.most)
        ordinal = np.full(len(start), -1, dtype=np.int64)
        for n in range(self.most):  # blocks of a language share no term
            todo = np.flatnonzero(ordinal < 0)
            ordinal[todo] = self.walk.ordinals(data, start[todo], length[todo], part[lang[text[todo]], n])
        kept = ordinal >= 0
        return text[kept], ordinal[kept]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(counts)
    by = np.argsort(key, kind="stable")
    key = key[by]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(n[by], first) if len(first) else n


def _slices(at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``SLICE_BYTES``."""
    begin = 0
    while begin < len(at) - 1:
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + SLICE_BYTES, side="right")) - 1)
        yield begin, end
        begin = end


def recount(texts: DataFrame, built: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``lang, source, ordinal, n``: occurrences of every kept term, found
    by streaming all texts through the transducers of their language."""
    spark = texts.sparkSession
    sizes = built.select("lang", "block", sum(F.octet_length(c) for c in ("key", "target", "output", "final")).alias("size"))
    sets, room = [], 0
    for row in sorted(sizes.collect()):  # a row for each BLOCK_BYTES of terms
        if not sets or room + row["size"] > broadcast_bytes:
            sets.append([])
            room = 0
        sets[-1].append((row["lang"], row["block"]))
        room += row["size"]
    out = None
    for blocks in sets:
        wanted = spark.createDataFrame(blocks, "lang string, block long")
        rows = built.join(F.broadcast(wanted), ["lang", "block"]).collect()  # at most broadcast_bytes, or one block
        held = spark.sparkContext.broadcast([r.asDict() for r in rows])
        part = texts.mapInArrow(_streamed(held), "lang string, source string, ordinal long, n long")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "lang string, source string, ordinal long, n long")
    return out.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))


def _streamed(held):
    def stream(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = _Loaded(held.value)
        groups: dict[tuple[str, str], int] = {}
        keys, counts, pending = [], [], 0

        def handed_on():
            key, n = _summed(keys, counts)
            group, ordinal = key >> 40, key & ((1 << 40) - 1)
            names = list(groups)
            columns = [pa.array([g[c] for g in names]).take(pa.array(group)) for c in (0, 1)]
            for k in range(0, len(key), 1 << 16):
                yield pa.RecordBatch.from_arrays([c.slice(k, 1 << 16) for c in (*columns, pa.array(ordinal), pa.array(n))],
                                                 names=["lang", "source", "ordinal", "n"])
            groups.clear()

        for batch in it:
            lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
            langs, sources = lang.dictionary.to_pylist(), source.dictionary.to_pylist()
            lang, source = (c.indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in (lang, source))
            pairs, group = np.unique(lang * len(sources) + source, return_inverse=True)
            number = np.array([groups.setdefault((langs[p // len(sources)], sources[p % len(sources)]), len(groups))
                               for p in pairs.tolist()], dtype=np.int64)
            raw, at = text_buffer(batch.column("text"))
            for begin, end in _slices(at):
                text, ordinal = loaded.counted(LOWER[raw[at[begin]:at[end]]], at[begin:end + 1] - at[begin], langs, lang[begin:end])
                if len(text):
                    key, n = np.unique(number[group[begin:end][text]] << 40 | ordinal, return_counts=True)
                    keys.append(key)
                    counts.append(n)
                    pending += len(key)
            if pending > 4 * ENTRIES:
                key, n = _summed(keys, counts)
                keys, counts, pending = [key], [n], len(key)
                if pending > 2 * ENTRIES:
                    yield from handed_on()
                    keys, counts, pending = [], [], 0
        if keys:
            yield from handed_on()
    return stream


# ----------------------------------------------------------------- shares

def shares(n: np.ndarray, total: int, terms: int) -> np.ndarray:
    """``1 + floor(UNIT (n + 2) / (total + 2 terms))``, exact."""
    if len(n) and int(n.max()) >= (1 << 62) // UNIT:
        return np.array([1 + UNIT * (x + 2) // (total + 2 * terms) for x in n.tolist()], dtype=np.int64)
    return 1 + UNIT * (n + 2) // (total + 2 * terms)


def _tile(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums of f over a block of ordinals, for each pair of sources of two
    tiles, in both directions."""
    lang, block, low, high = frame[["lang", "block", "low", "high"]].iloc[0]
    heads = frame[frame["ordinal"] < 0].sort_values("number")
    numbers, names = heads["number"].to_numpy(), heads["source"].to_numpy()
    terms = int(heads["terms"].iloc[0])
    width = max(0, min(WIDTH, terms - int(block) * WIDTH))
    P = np.zeros((len(heads), width), dtype=np.int64)
    if width:
        totals = heads["total"].tolist()
        P += np.array([shares(np.zeros(1, dtype=np.int64), t, terms)[0] for t in totals])[:, None]
        rows = frame[frame["ordinal"] >= 0]
        at = np.searchsorted(numbers, rows["number"].to_numpy())
        by = np.argsort(at, kind="stable")
        at, ordinal, n = at[by], rows["ordinal"].to_numpy()[by] - int(block) * WIDTH, rows["n"].to_numpy()[by]
        for k, begin, end in zip(*_runs(at), strict=True):
            P[k, ordinal[begin:end]] = shares(n[begin:end], totals[k], terms)
    tile, out = numbers // TILE, []
    for k in np.flatnonzero(tile == low).tolist():
        others = np.flatnonzero((tile == high) & (numbers > numbers[k]))
        f = np.zeros(len(others), dtype=np.int64)
        for j in range(0, len(others), 16):
            q = P[others[j:j + 16]]
            f[j:j + 16] = ((P[k] - q) ** 2 // np.maximum(P[k] + q, 1)).sum(axis=1)
        out += [pd.DataFrame({"source": names[k], "item": names[others], "value": f}),
                pd.DataFrame({"source": names[others], "item": names[k], "value": f})]
    out = pd.concat(out or [pd.DataFrame({"source": [], "item": [], "value": np.zeros(0, dtype=np.int64)})], ignore_index=True)
    return out.assign(lang=lang)[["lang", "source", "item", "value"]]


def _runs(at: np.ndarray) -> tuple[list, list, list]:
    begin = np.flatnonzero(np.diff(at, prepend=-1))
    return at[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(at)] if len(begin) else []


def pair_values(groups: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for each other source of the language.
    ``groups``: ``lang, source, number, total, terms``."""
    last = lambda n, size: F.greatest(F.ceil(n / size) - 1, F.lit(0))
    tiles = groups.groupBy("lang").agg(F.max("number").alias("last"))
    known = groups.join(tiles, "lang").withColumn("last", F.floor(F.col("last") / TILE))
    columns = ["lang", "source", "number", "total", "terms", "last", "block", "ordinal", "n"]
    heads = known.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last(F.col("terms"), WIDTH)))).select(
        *columns[:-2], F.lit(-1).cast("long").alias("ordinal"), F.lit(0).cast("long").alias("n"))
    rows = counts.join(known, ["lang", "source"]).withColumn("block", F.floor(F.col("ordinal") / WIDTH)).select(columns)
    own = F.floor(F.col("number") / TILE)
    dealt = heads.unionByName(rows).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))).withColumns(
        {"low": F.least(own, "other"), "high": F.greatest(own, "other")})
    sums = dealt.groupBy("lang", "block", "low", "high").applyInPandas(_tile, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(groups: DataFrame, counts: DataFrame, terms: DataFrame, top: int) -> DataFrame:
    """``lang, source, item, value, rank``: the ``top`` terms that a source
    uses more than its language does."""
    share = lambda n, total: F.expr(f"1 + (cast({UNIT} as decimal(10, 0)) * cast({n} + 2 as decimal(20, 0))) div cast({total} + 2 * terms as decimal(20, 0))")
    whole = groups.groupBy("lang").agg(F.sum("total").alias("all"))
    used = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("used"))
    pq = (counts.join(used, ["lang", "ordinal"]).join(groups.join(whole, "lang"), ["lang", "source"])
          .select("lang", "source", "ordinal", share("n", "total").alias("p"), share("used", "all").alias("q")))
    value = F.expr("((p - q) * (p - q)) div (p + q)")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = pq.filter("p > q").select("lang", "source", "ordinal", value.alias("value")).withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(terms, ["lang", "ordinal"]).select("lang", "source", F.col("term").cast("string").alias("item"), "value", "rank")


def audit(docs: DataFrame, least: int = 10, top: int = 10, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """How far the sources of each language are apart (part ``pair``), and
    which terms set each of them off most (part ``term``).

    Null texts, languages and sources count as empty strings. Every row is
    a document, repeated rows too. A group without terms stands in the
    pairs; a language that keeps no term has pairs of value 0 and no terms.
    Equal values rank by their item's bytes. A language of one source has
    no pairs. An empty table gives an empty result; other columns are
    ignored."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = texts_of(docs)
    terms = written(vocabulary(texts, least), "vocabulary")
    counts = written(recount(texts, written(transducers(terms), "transducers"), broadcast_bytes), "term-counts")
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long")  # a row a source
    groups = written(texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
                     .select("lang", "source", number.alias("number"), zero("total"), zero("terms")), "groups")
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_values(groups, counts).withColumn("rank", ranked)
    part = lambda df, name: df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(pairs, "pair").unionByName(part(term_values(groups, counts, terms, top), "term"))
