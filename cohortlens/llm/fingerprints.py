"""Document fingerprints: bottom-k sketches of word shingles.

A sketch is the sorted array of the ``k`` smallest distinct 64-bit hashes
of a text's shingles (``SHINGLE`` consecutive words; a shorter text with
words is one shingle). Sketches of parts merge into the sketch of the
whole, and two sketches estimate resemblance, containment and distinct
shingle counts. Everything here is made of built-in column functions and
stays in the JVM; a sketch needs no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import parts_for
from cohortlens.llm.splitters import sampled_splits, with_range

SHINGLE = 5
K = 128
#: Text of one block of consecutive documents, and the most blocks.
BLOCK_BYTES = 8 << 20
MAX_BLOCKS = 65_536


def with_sketch(df: DataFrame, text: str, name: str, k: int = K, n: int = SHINGLE) -> DataFrame:
    """Add ``name``: the sketch of column ``text``. Null, empty or
    wordless texts have the empty sketch."""
    breaks = F.lit(" \t\n\v\f\r")
    trimmed = F.btrim(F.coalesce(text, F.lit("")), breaks)
    w, h, s = f"{name}__words", f"{name}__hashes", f"{name}__shingles"
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))
    shingle = lambda i: F.xxhash64(*[F.get(F.col(h), i + F.lit(j)) for j in range(n)])
    return (df.withColumn(w, words)
            .withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
            .withColumn(s, F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                        .when(F.size(h) < n, F.array(F.xxhash64(F.lit(n), F.col(h))))
                        .otherwise(F.transform(F.sequence(F.lit(0), F.size(h) - n), shingle)))
            .withColumn(name, F.slice(F.sort_array(F.array_distinct(s)), 1, k))
            .drop(w, h, s))


def merge(*sketches: Column, k: int = K) -> Column:
    """Sketch of the union of the shingles of several parts."""
    return F.slice(F.sort_array(F.array_distinct(reduce(F.concat, sketches))), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity; 1.0 for two empty sketches. Exact when
    the union has at most ``k`` shingles."""
    union = merge(a, b, k=k)
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``. Hashes are
    signed, so the k-th smallest lies ``a[k] + 2^63`` above the least."""
    kth = F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / (kth / F.lit(2.0 ** 64)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has (1.0 for an empty a)."""
    shared = resemblance(a, b, k) * distinct_shingles(merge(a, b, k=k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_string(a: Column) -> Column:
    """Sixteen hexadecimal digits for each hash, in order."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def with_next(rows: DataFrame, columns: list[str], order: str = "doc_id", size: str = "n_chars") -> DataFrame:
    """Add ``next_<c>`` for each of ``columns``: the value in the next row
    by descending ``order`` (a bigint, nulls last; ties by the text's hash),
    and in the first row after the last one.

    Rows are dealt into blocks of consecutive rows: sampled splitters of
    the key as a double make ranges, the exact key orders rows within them,
    and a range that one key overfills is divided by the tie. So no task
    holds more than a block, unless one key holds that many equal texts;
    every block also gets a copy of the row that opens the block after it."""
    spark = rows.sparkSession
    keyed = rows.withColumns({"__key": F.coalesce(F.col(order).cast("double"), F.lit(float("-inf"))), "__tie": F.xxhash64("text")})
    narrow = keyed.select(order, "__key", "__tie", (F.coalesce(size, F.lit(0)) + 1).alias("__size"))
    total = narrow.agg(F.sum("__size")).first()[0] or 0
    parts = min(MAX_BLOCKS, parts_for(total, BLOCK_BYTES, 2 * spark.sparkContext.defaultParallelism))
    splits = sampled_splits(narrow, "__key", "__size", ["__key", "__tie"], parts, per_part=8)
    share = max(total / parts, 1.0)
    least = F.min(F.struct(F.col(order).isNotNull(), F.col(order).alias("id")))["id"].alias("__least")
    # One row for each range: at most MAX_BLOCKS.
    ranges = with_range(narrow, "__key", splits, "__range").groupBy("__range").agg(least, F.sum("__size").alias("__sum"))
    ranges = F.broadcast(spark.createDataFrame(ranges.collect(), ranges.schema))

    def blocked(df: DataFrame) -> DataFrame:
        """``__part``: 0, or from 1 on for the least key of a range, by the
        tie, when the range holds over two shares."""
        inside = F.col("__tie") / F.lit(2.0 ** 64) + 0.5
        part = 1 + F.floor(inside * F.ceil(F.col("__sum") / share))
        divided = (F.col("__sum") > 2 * share) & F.col(order).eqNullSafe(F.col("__least"))
        return with_range(df, "__key", splits, "__range").join(ranges, "__range").withColumn(
            "__part", F.when(divided, part).otherwise(F.lit(0)).cast("int")).drop("__least", "__sum")

    first = (F.col(order).isNotNull(), F.col(order).alias("id"), -F.col("__tie").cast("decimal(20,0)"), F.col("__tie").alias("tie"))
    heads = blocked(narrow).groupBy("__range", "__part").agg(F.max(F.struct(*first)).alias("head")).collect()
    heads.sort(key=lambda r: (-r["__range"], r["__part"]))  # a few times MAX_BLOCKS
    follows = [(n, r["__range"], r["__part"], *[heads[(n + 1) % len(heads)]["head"][c] for c in ("id", "tie")]) for n, r in enumerate(heads)]
    follows = spark.createDataFrame(follows, "__block int, __range int, __part int, __id long, __head long")
    blocks = blocked(keyed).join(F.broadcast(follows.drop("__id", "__head")), ["__range", "__part"]).withColumn("__guest", F.lit(0))
    kept = [c for c in blocks.columns if c not in ("__range", "__part")]
    opening = keyed.join(F.broadcast(follows.drop("__range", "__part")),
                         keyed[order].eqNullSafe(F.col("__id")) & (keyed["__tie"] == F.col("__head"))).withColumn("__guest", F.lit(1))
    guests = opening.groupBy("__block").agg(F.first(F.struct(*kept)).alias("row")).select("row.*")  # equal rows: any
    w = Window.partitionBy("__block").orderBy("__guest", F.desc_nulls_last(order), "__tie")
    both = blocks.select(kept).unionByName(guests).repartition(max(1, len(heads)), "__block")
    return (both.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
            .filter("__guest = 0").drop("__key", "__tie", "__block", "__guest"))


def fingerprint_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprint of every text and of its edited text, whose last third
    (in code points) is replaced by as much of the next document's
    beginning, by descending doc_id; the last one takes the first one's.

    A null text counts as empty. Equal texts have equal fingerprints; the
    fingerprint of a wordless text is the empty string and resembles
    another such with 1.0 and any other with 0.0. Rows that share a doc_id
    follow one another by a hash of their text. Other columns are ignored;
    an empty table gives an empty result."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long"))
    paired = with_next(with_sketch(base, "text", "sketch", k), ["text", "sketch"])
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut),
                      F.substring("next_text", F.lit(1), cut))
    both = with_sketch(paired.withColumn("edited", edited), "edited", "edited_sketch", k)
    return both.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_string(F.col("sketch")).alias("fingerprint"), as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))
