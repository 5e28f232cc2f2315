"""Document fingerprints: bottom-k sketches of word shingles, built from Spark expressions only.

A sketch is the sorted array of the k smallest 64-bit hashes of a document's distinct shingles. Sketches of parts merge into the
sketch of the whole, and two sketches estimate resemblance, containment and the number of distinct shingles. A sketch
with fewer than k hashes is the whole set, and estimates from such sketches are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isochron.functions.binding import let
from isochron.llm.quality import words_of

WIDTH = 5
SIZE = 64


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Distinct 64-bit hashes of all windows of `width` words; a shorter text is one shingle, a text without words none."""
    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(hashes) - width)
        long = F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]))
        short = F.array(F.xxhash64(hashes))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(hashes) == 0, none).when(F.size(hashes) < width, short).otherwise(F.array_distinct(long))

    return let(F.transform(words_of(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w)), windows)


def bottom(hashes: Column, size: int = SIZE) -> Column:
    return F.slice(F.sort_array(hashes), 1, size)


def sketch(text: Column, width: int = WIDTH, size: int = SIZE) -> Column:
    return bottom(shingle_hashes(text, width), size)


def merge(a: Column, b: Column, size: int = SIZE) -> Column:
    """The sketch of the union of two sets, from their sketches."""
    return bottom(F.array_union(a, b), size)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that is in both. Two empty sets are alike."""
    def share(union: Column) -> Column:
        both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))

    return let(merge(a, b, size), share)


def distinct_count(a: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact for sketches that are not full."""
    span = (F.element_at(a, -1).cast("double") + 2.0**63 + 1) / 2.0**64
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / span)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has too; null for an empty a."""
    both = resemblance(a, b, size) * distinct_count(merge(a, b, size), size)
    return F.when(F.size(a) > 0, F.least(F.lit(1.0), both / distinct_count(a, size)))


def as_text(a: Column) -> Column:
    """16 hexadecimal digits per hash, in order."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merged(rows: DataFrame, keys: list[str], sketch_column: str = "sketch", size: int = SIZE, salts: int = 64) -> DataFrame:
    """keys and sketch of the union of all sets of each group, from the rows' sketches: what bottom-k sketches of parts are for.

    Distinct hashes are kept by group, first the least of each salt of the hashes and then the least of all, so a group that holds a third
    of all rows is met by as many tasks as there are salts, and none sees more than size * salts hashes of it at the end. Groups in which all sketches are empty
    or null keep an empty sketch; null keys form a group.
    """
    names = [f"k{i}" for i in range(len(keys))]
    held = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(sketch_column).alias("sketch"))
    hashes = held.select(*names, F.explode("sketch").alias("hash")).distinct()
    salted = hashes.withColumn("salt", F.pmod(F.xxhash64("hash"), F.lit(salts)))
    least = salted.withColumn("place", F.row_number().over(Window.partitionBy(*names, "salt").orderBy("hash"))).filter(F.col("place") <= size)
    of_all = least.withColumn("place", F.row_number().over(Window.partitionBy(*names).orderBy("hash"))).filter(F.col("place") <= size)
    kept = of_all.select(*names, F.col("hash"))
    none = held.select(*names).distinct().withColumn("hash", F.lit(None).cast("bigint"))
    found = kept.unionByName(none).groupBy(*names).agg(F.sort_array(F.collect_list("hash")).alias("sketch"))
    return found.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "sketch")


def with_next(rows: DataFrame, key: str, carried: list[str], parts: int) -> DataFrame:
    """All columns of `rows`, and next_<c> of the row after it by key for each carried column; the last row meets the first.

    The rows are dealt into ranges of the key, bounded by values of the key; the rows at a bound go to the range before
    it as well, where they only serve as next rows. So one shuffle suffices, and no task holds more than a range. Only the
    bounds (at most `parts` keys) and the two extreme keys come to the driver. Null keys come first; rows of one key are
    ordered by their other columns' hash; a single row is its own next row.
    """
    low, high, null_rows, bounds = rows.agg(
        F.min(key), F.max(key), F.count(F.when(F.col(key).isNull(), 1)),
        F.percentile_approx(key, [(i + 1) / parts for i in range(parts - 1)] or [0.5], 100 * parts),
    ).first()
    if low is None:  # no row, or only null keys: one range
        low = high = 0
    low_key = low - 1 if null_rows else low
    bounds = sorted({b for b in bounds or () if b > low_key})
    steps = [1 << k for k in reversed(range(max(1, len(bounds).bit_length())))]
    edges = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    at = F.coalesce(F.col(key), F.lit(low_key)).cast("bigint")

    def found(position: Column, step: Column) -> Column:
        return F.when(F.get(edges, position + step - 1) <= at, position + step).otherwise(position)

    last = len(bounds)
    own = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), found)
    dealt = rows.withColumn("_at", at).withColumn("_own", own)
    starts = (F.get(edges, F.col("_own") - 1) == F.col("_at")) & (F.col("_own") > 0)
    copies = F.array_compact(F.array(
        F.struct(F.col("_own").alias("part"), F.lit(0).alias("turn")),
        F.when(starts, F.struct((F.col("_own") - 1).alias("part"), F.lit(1).alias("turn"))),
        F.when(F.col("_at") == low_key, F.struct(F.lit(last).alias("part"), F.lit(2).alias("turn"))),
    ))
    spread = dealt.withColumn("_copy", F.explode(copies)).select("*", "_copy.part", "_copy.turn").drop("_copy", "_own")
    order = Window.partitionBy("part").orderBy("turn", "_at", F.xxhash64(*carried))
    ahead = spread.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried})
    return ahead.filter(F.col("turn") == 0).drop("part", "turn", "_at")


def fingerprints(
    documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, size: int = SIZE, parts: int = 64
) -> DataFrame:
    """key, text, n_chars, sketch; next_text; edited (the text, its last half replaced by as much of the head of the next text) and
    edited_sketch; near_edited and near_next, the estimated resemblance to either; n_distinct, the estimated number of the text's distinct shingles; and
    kept_share, the estimated share of them that the edited text has too (null for a text without words).

    A null text is empty; a text without words has an empty sketch. An empty table gives an empty result.
    """
    own = documents.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sketched = own.withColumn("sketch", sketch(F.col("text"), width, size))
    pairs = with_next(sketched, key, ["text", "sketch"], parts)
    half = F.floor(F.length("text") / 2).cast("int")
    head = F.substring("text", F.lit(1), F.length("text") - half)
    edited = pairs.withColumn("edited", F.concat(head, F.substring("next_text", F.lit(1), half)))
    edited = edited.withColumn("edited_sketch", sketch(F.col("edited"), width, size))
    return edited.withColumns({
        "n_chars": F.length("text").cast("long"),
        "near_edited": resemblance(F.col("sketch"), F.col("edited_sketch"), size),
        "near_next": resemblance(F.col("sketch"), F.col("next_sketch"), size),
        "n_distinct": distinct_count(F.col("sketch"), size),
        "kept_share": containment(F.col("sketch"), F.col("edited_sketch"), size),
    })
