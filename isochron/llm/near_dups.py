"""Near-duplicate classes by circulant MinHash, banding, and exact Jaccard verification.

Signatures: a first permutation sends every shingle to a place on a circle of 2**32; a second one, shifted circularly by 0, 1, 2, ...,
gives all coordinates, each the least value over the shingles. Bands of coordinates are buckets.

Texts with the same words are one class, found by a digest; classes, not doc_ids, are what is linked, so rows that share a doc_id but
not their words stay apart. Within a bucket no list of pairs is made: every member is compared with the bucket's hub, and what
is linked becomes one component. A bucket of more than two members that still holds several components is then searched
where its sets lie: a member outside the bucket's largest component is held against all others at once, and only links
between different components come out. Members within that component are not held against each other, nor copied for it. So no link of a bucket is lost unless its texts are connected anyway, and what leaves a bucket
are fewer links than members.

Before texts or sets travel, the share of equal signature coordinates estimates a pair's similarity, from one byte a coordinate. Pairs
that agree in under LEAST_AGREEING of them are left out: with 200 coordinates a pair at 0.8 stands seven standard deviations
above. All others are decided on their full sets.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.session import stored

WIDTH = 5
THRESHOLD = (4, 5)
BANDS, ROWS = 40, 5
HUB_ROUNDS = 2
HUB_SHARE = 256
# Members of a bucket that meet in one group, of full sets and of sketches. So many shingles of full sets count as a member.
BLOCK_MEMBERS, BLOCK_SKETCHES, MEMBER_SHINGLES = 512, 4096, 2048
LEAST_AGREEING = 0.6
BROADCAST_ROWS = 2_000_000
BLANK = re.compile(rb"[\x20\x09-\x0d]+")


# -- Shingles and signatures ---------------------------------------------------------------------------------------------


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, A-Z in lower case."""
    return [w for w in BLANK.split((text or "").encode().lower()) if w]


def shingle_set(words: Sequence[bytes], width: int) -> set[tuple[bytes, ...]]:
    """Distinct windows of `width` words; of fewer words the whole sequence, of none nothing."""
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(width)], strict=False))


def alike(a: set, b: set, threshold: tuple[int, int] = THRESHOLD) -> bool:
    """Whether the Jaccard similarity of two sets is at least threshold[0] / threshold[1]; False for empty sets."""
    above, below = threshold
    if below * min(len(a), len(b)) < above * max(len(a), len(b)) or not a or not b:
        return False
    both = len(a & b)
    return below * both >= above * (len(a) + len(b) - both)


def shingle_hashes(words: Sequence[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    span = min(width, len(words))
    total = np.full(len(words) - span + 1, span, dtype=np.uint64)
    for k in range(span):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashed[k:len(words) - span + 1 + k]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    total ^= total >> np.uint64(29)
    return np.unique(total)


def second_permutation(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of unsigned 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes: np.ndarray, length: int, block: int = 2048) -> np.ndarray:
    """Least values of the circularly shifted second permutation over the places of all shingles."""
    places = (hashes >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(length, dtype=np.uint32)[:, None]
    least = np.full(length, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(places), block):
        np.minimum(least, second_permutation(places[None, at:at + block] + shifts).min(axis=1), out=least)
    return least


def band_hashes(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket number per band, different for different bands."""
    table = least[:bands * rows].reshape(bands, rows).astype(np.uint64)
    total = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        total = (total ^ table[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total.view(np.int64)


def digest_of(words: Sequence[bytes]) -> bytes:
    """The name of a class: a 128-bit hash of the words."""
    return xxhash.xxh3_128_digest(b" ".join(words))


def digest(text: Column) -> Column:
    """The class of a text, as near_duplicates names it."""
    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: digest_of(words_of(t)))

    return run(text)


SIGNED = "doc_id bigint, digest binary, n_shingles bigint, bands array<bigint>, sketch binary"


def sign(documents: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, digest of the words, number of distinct shingles, buckets, and the low byte of each coordinate of every document. A map over the scan."""
    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, seen = [], {}
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                name = digest_of(words)
                if name not in seen:
                    hashes = shingle_hashes(words, width)
                    least = signature(hashes, bands * rows)
                    seen[name] = (name, len(hashes), *((band_hashes(least, bands, rows).tolist(), least.astype(np.uint8).tobytes()) if len(hashes) else ([], b"")))
                found.append(seen[name])
            columns = list(zip(*found, strict=True)) or [[]] * 4
            kinds = (pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]],
                names=["doc_id", "digest", "n_shingles", "bands", "sketch"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of_batch, SIGNED)


# -- Comparing -----------------------------------------------------------------------------------------------------------


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """With a broadcast hint if its counted rows are few; otherwise left to a shuffle."""
    return F.broadcast(df) if rows <= limit else df


def agreeing(a: Sequence[bytes], b: Sequence[bytes]) -> np.ndarray:
    """Share of equal coordinates of each pair of sketches."""
    table = [np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1) for x in (a, b)]
    return (table[0] == table[1]).mean(axis=1) if len(a) else np.zeros(0)


def plausible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those pairs (hub, doc_id) whose sketches (doc_id, sketch) agree in enough coordinates to be alike."""
    ids = pairs.select("doc_id").union(pairs.select("hub")).distinct()
    needed = sketches.join(small(ids, ids.count()), "doc_id", "left_semi")
    hubs = needed.select(F.col("doc_id").alias("hub"), F.col("sketch").alias("_a"))
    both = pairs.join(hubs, "hub").join(needed.withColumnRenamed("sketch", "_b"), "doc_id").select("hub", "doc_id", "_a", "_b")

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share = agreeing(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            yield batch.select(["hub", "doc_id"]).filter(pa.array(share >= LEAST_AGREEING))

    return both.mapInArrow(estimate, "hub bigint, doc_id bigint")


def verified(pairs: DataFrame, texts: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """Those pairs (hub, doc_id) whose full shingle sets are alike. `texts` has the text of each doc_id that occurs.

    The partners of a hub are dealt over salts of about HUB_SHARE each, with one copy of the hub's text per salt.
    """
    shares = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / HUB_SHARE).cast("int").alias("_salts"))
    salted = pairs.join(shares, "hub").withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.col("_salts")).cast("int"))
    partners = salted.select("hub", "_salt", "doc_id").join(texts.select("doc_id", F.col("text").alias("_b")), "doc_id")
    hubs = shares.select("hub", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt")).join(
        texts.select(F.col("doc_id").alias("hub"), F.col("text").alias("_a")), "hub"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for batch in batches:
            hub, doc, a, b = (batch.column(k).to_pylist() for k in range(4))
            linked = []
            for k in range(len(hub)):
                if hub[k] != last:
                    last, last_set = hub[k], shingle_set(words_of(a[k]), width)
                linked.append(alike(last_set, shingle_set(words_of(b[k]), width), threshold))
            rows = batch.select(["hub", "doc_id"]).filter(pa.array(linked, pa.bool_()))
            yield rows

    joined = partners.join(hubs, ["hub", "_salt"]).select("hub", "doc_id", "_a", "_b")
    return joined.mapInArrow(compare, "hub bigint, doc_id bigint").distinct()


# -- Searching a bucket --------------------------------------------------------------------------------------------------


def missing_links(
    ids: Sequence[int], labels: Sequence[int], blocks: Sequence[int], sets: Sequence[np.ndarray], threshold: tuple[int, int]
) -> list[tuple[int, int]]:
    """Links (smaller doc_id, larger doc_id) between members with different labels whose sets are alike, as far as they connect
    labels that are not connected yet. Where there are two blocks, only pairs across them are tried. Sets are not empty.
    """
    above, below = threshold
    sizes = np.array([len(x) for x in sets])
    _, words = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    names, label = np.unique(np.array(labels), return_inverse=True)
    block = np.array(blocks)
    across = len(set(blocks)) > 1
    parent = list(range(len(names)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found, largest = [], np.bincount(label).argmax()
    for i in np.flatnonzero(label != largest).tolist():
        here = np.zeros(words.max() + 1, dtype=np.int32)
        here[words[starts[i]:starts[i] + sizes[i]]] = 1
        both = np.add.reduceat(here[words], starts)
        linked = (below * both >= above * (sizes + sizes[i] - both)) & (label != label[i])
        if across:
            linked &= block != block[i]
        for j in np.flatnonzero(linked).tolist():
            a, b = root(label[i]), root(label[j])
            if a != b:
                parent[a] = b
                found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return found


def near_members(labels: Sequence[int], blocks: Sequence[int], sketches: Sequence[bytes]) -> np.ndarray:
    """Which members of a bucket agree in enough coordinates with one of another label (and, where there are two blocks, of the other block)."""
    names, label = np.unique(np.array(labels), return_inverse=True)
    block, across = np.array(blocks), len(set(blocks)) > 1
    table = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    least, near = math.ceil(LEAST_AGREEING * table.shape[1]), np.zeros(len(table), bool)
    for i in np.flatnonzero(label != np.bincount(label).argmax()).tolist():
        alike_to = (np.count_nonzero(table == table[i], axis=1) >= least) & (label != label[i])
        if across:
            alike_to &= block != block[i]
        if alike_to.any():
            near |= alike_to
            near[i] = True
    return near


def deal_members(live: DataFrame, weight: Column, size: int) -> DataFrame:
    """The members of `live` (band, doc_id, component) with _block, once for each group (_low, _high) of blocks in which they are compared.

    A bucket whose weights add up to `size` is one block and one group. The members of any other are dealt into blocks of about
    `size`, those outside its heaviest component first. Two blocks are a group where one of them is such a block, as members of one component are
    not compared. So while those outside fit one block, a bucket's copies weigh at most three times its members; beyond,
    each block of them meets all members once.
    """
    parts = live.groupBy("band", "component").agg(F.sum(weight).alias("_w"))
    sizes = parts.groupBy("band").agg(F.sum("_w").alias("_all"), F.max(F.struct("_w", "component")).alias("_top"))
    one, heaviest = F.col("_all") <= size, F.col("_top._w")
    plan = sizes.select(
        "band", F.col("_top.component").alias("_main"),
        F.when(one, 1).otherwise(F.greatest(F.lit(1), F.ceil((F.col("_all") - heaviest) / size))).cast("int").alias("_outer"),
        F.when(one, 0).otherwise(F.ceil(heaviest / size)).cast("int").alias("_inner"),
    )
    number, inside = F.xxhash64("doc_id"), (F.col("component") == F.col("_main")) & (F.col("_inner") > 0)
    block = F.when(inside, F.col("_outer") + F.pmod(number, F.greatest("_inner", F.lit(1)))).otherwise(F.pmod(number, F.col("_outer"))).cast("int")
    last = F.when(inside, F.col("_outer")).otherwise(F.col("_outer") + F.col("_inner")) - 1
    dealt = live.join(plan, "band").select("band", "doc_id", "component", block.alias("_block"), F.explode(F.sequence(F.lit(0), last)).alias("_other"))
    return dealt.select("band", F.least("_block", "_other").alias("_low"), F.greatest("_block", "_other").alias("_high"), "doc_id", "component", "_block")


def by_bucket(live: DataFrame, carried: DataFrame, column: str, weight: Column, size: int, work, schema: str) -> DataFrame:
    """Run work(doc_ids, components, blocks, values, band) -> rows over the buckets of `live` (band, doc_id, component), each member with a column of `carried`.

    A group holds one or two blocks of about `size` by weight (see deal_members): memory is bounded whatever the bucket's size.
    """
    names = [part.split()[0] for part in schema.split(", ")]

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            found = []
            for band, low, high, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (band, low, high) != key:
                    found += work(*zip(*rows, strict=True), key[0]) if rows else []
                    key, rows = (band, low, high), []
                rows.append(row)
            yield as_batch(found)
        yield as_batch(work(*zip(*rows, strict=True), key[0]) if rows else [])

    spread = deal_members(live, weight, size)
    group = ["band", "_low", "_high"]
    rows = spread.join(carried, "doc_id").select(*group, "doc_id", "component", "_block", column)
    return rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, schema).distinct()


def search_buckets(live: DataFrame, sketches: DataFrame, texts: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """Links (hub, doc_id) missing within the buckets of `live` (band, doc_id, component, n_shingles), found on full sets of 64-bit hashes.

    Only members whose sketch comes near that of a member of another component bring their sets.
    """
    def near(ids, labels, blocks, values, band) -> list[tuple[int, int]]:
        return [(band, i) for i, n in zip(ids, near_members(labels, blocks, values), strict=True) if n]

    def links(ids, labels, blocks, values, band) -> list[tuple[int, int]]:
        return missing_links(ids, labels, blocks, [np.frombuffer(x, np.uint64) for x in values], threshold)

    def hash_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(words_of(t), width).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc_id", "hashes"])

    close = stored(by_bucket(live, sketches, "sketch", F.lit(1), BLOCK_SKETCHES, near, "band bigint, doc_id bigint"), "bucket-near")
    kept = live.join(close, ["band", "doc_id"], "left_semi")
    ids = close.select("doc_id").distinct()
    sets = texts.join(small(ids, ids.count()), "doc_id", "left_semi").select("doc_id", "text")
    sets = stored(sets.mapInArrow(hash_sets, "doc_id bigint, hashes binary"), "bucket-sets", compression="zstd")
    return by_bucket(kept, sets, "hashes", F.col("n_shingles") / MEMBER_SHINGLES, BLOCK_MEMBERS, links, "hub bigint, doc_id bigint")


# -- Components ----------------------------------------------------------------------------------------------------------


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(doc_id, component) of all documents in links (hub, doc_id); component is the smallest doc_id that can be reached.

    Every round maps each node to the least hashed node among itself and its neighbours and contracts the graph, which
    shrinks it by a constant factor whatever the order of ids; the tables of a round are written, so that plans stay short.
    """
    nodes = links.select(F.col("hub").alias("doc_id")).union(links.select("doc_id")).distinct()
    # xxhash64 of one long is a bijection, so hashed ids are names of nodes in random order.
    found = stored(nodes.select("doc_id", F.xxhash64("doc_id").alias("node")), f"{name}-nodes")
    edges = stored(links.select(F.xxhash64("hub").alias("a"), F.xxhash64("doc_id").alias("b")), f"{name}-edges")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        least = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")), f"{name}-least")
        found = stored(
            found.join(least.toDF("node", "to"), "node", "left").select("doc_id", F.coalesce("to", "node").alias("node")), f"{name}-nodes"
        )
        moved = edges.join(least.toDF("a", "_a"), "a").join(least.toDF("b", "_b"), "b")
        edges = stored(moved.filter("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), f"{name}-edges")
    smallest = found.groupBy("node").agg(F.min("doc_id").alias("component"))
    return found.join(smallest, "node").select("doc_id", "component")


# -- The operator --------------------------------------------------------------------------------------------------------


def class_texts(classes: DataFrame, documents: DataFrame) -> DataFrame:
    """One text (doc_id, text) of each class (doc_id, digest, _first, _copies); doc_id is the class's number from here on.

    The text comes from a row with the class's smallest doc_id. Of rows that repeat both, one is taken.
    """
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [digest_of(words_of(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(1)], names=["_first", "digest", "text"])

    rows = documents.select(F.col("doc_id").cast("long").alias("_first"), "text")
    count = classes.count()
    firsts = classes.select("_first").distinct()
    rows = rows.join(small(firsts, count), "_first", "left_semi").mapInArrow(digests, "_first bigint, digest binary, text string")
    named = rows.join(small(classes, count), ["_first", "digest"])
    if classes.filter("_copies > 1").isEmpty():
        return named.select("doc_id", "text")
    again = named.filter("_copies > 1").select("doc_id", "text").dropDuplicates(["doc_id"])
    return named.filter("_copies = 1").select("doc_id", "text").unionByName(again)


def linked_components(
    signed: DataFrame, documents: DataFrame, width: int, threshold: tuple[int, int], hub_rounds: int = HUB_ROUNDS
) -> DataFrame:
    """(doc_id, component) of all classes with a link: two in one bucket whose sets are alike are in one component. `signed` has
    the rows of the classes' first documents, under the classes' numbers as doc_id."""
    buckets = signed.select("doc_id", "n_shingles", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high")).filter("_low < _high")
    members = stored(buckets.join(shared.select("band"), "band", "left_semi"), "bucket-members")
    ids = members.select("doc_id").distinct()
    own = signed.join(small(ids, ids.count()), "doc_id", "left_semi")
    sketches = stored(own.select("doc_id", "sketch"), "bucket-sketches")
    classes = stored(own.select("doc_id", "digest", "_first", "_copies"), "bucket-classes")
    texts = stored(class_texts(classes, documents), "bucket-texts", compression="zstd")
    above, below = threshold
    near = below * F.least("n_shingles", "_n") >= above * F.greatest("n_shingles", "_n")
    links, labelled = None, members.withColumn("component", F.col("doc_id"))
    for turn in range(hub_rounds + 1):
        if turn < hub_rounds:
            order = F.col("doc_id") if turn == 0 else F.xxhash64("doc_id", "band", F.lit(turn))
            hubs = labelled.groupBy("band").agg(F.min(F.struct(order.alias("o"), "doc_id", "n_shingles", "component")).alias("_h")).select(
                "band", F.col("_h.doc_id").alias("hub"), F.col("_h.n_shingles").alias("_n"), F.col("_h.component").alias("_c")
            )
            pairs = labelled.join(hubs, "band").filter((F.col("_c") != F.col("component")) & near)
            pairs = pairs.select(F.least("hub", "doc_id").alias("hub"), F.greatest("hub", "doc_id").alias("doc_id")).distinct()
            fresh = verified(stored(plausible(stored(pairs, "pairs"), sketches), "near-pairs"), texts, width, threshold)
        else:
            fresh = search_buckets(labelled, sketches, texts, width, threshold)
        fresh = stored(fresh, "links")
        links = fresh if links is None else links.union(fresh)
        if turn < hub_rounds:
            # Buckets of two are settled by their hub; so are those that are one component by now.
            labels = components(links)
            placed = members.join(labels, "doc_id", "left").select("band", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))
            placed = stored(placed, "bucket-labels")
            open_bands = placed.groupBy("band").agg(
                F.count(F.lit(1)).alias("_m"), F.min("component").alias("_low"), F.max("component").alias("_high")
            ).filter("_m > 2 AND _low < _high")
            labelled = stored(placed.join(open_bands.select("band"), "band", "left_semi"), "bucket-live")
            if labelled.isEmpty():
                return labels
    return components(links)


def near_duplicates(
    documents: DataFrame, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id of the component), kept (doc_id = component_id), digest (the class) and first per row.

    Two documents are linked when the Jaccard similarity of their shingle sets is at least `threshold` and a bucket holds both: with the
    defaults a pair at 0.8 is missed with probability (1 - 0.8**5)**40 = 1e-7. Null and texts without words have no
    shingles, are linked with nothing and are kept. Rows are told apart by doc_id and words: rows that repeat both are marked alike, and
    of rows that share a doc_id only those with the same component_id belong together. `first` marks the rows that stand for their component when
    one is to stay: those with its smallest doc_id and, if unlike texts share that, its smallest digest. Rows without doc_id are linked with nothing;
    their component is null and they are kept. An empty table gives an empty result. Other columns of `documents` are ignored.
    """
    signed = stored(sign(documents, width, bands, rows), "signed")
    named = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    copies = named.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("_copies"))
    least = copies.groupBy("digest").agg(F.min(F.struct("doc_id", "_copies")).alias("_f"))
    classes = least.select("digest", F.col("_f.doc_id").alias("_first"), F.col("_f._copies").alias("_copies"), F.monotonically_increasing_id().alias("node"))
    classes = stored(classes, "classes")
    firsts = named.join(classes.withColumnRenamed("_first", "doc_id"), ["digest", "doc_id"])
    firsts = firsts.select(F.col("node").alias("doc_id"), "digest", F.col("doc_id").alias("_first"), "_copies", "n_shingles", "bands", "sketch")
    if not classes.filter("_copies > 1").isEmpty():
        firsts = firsts.filter("_copies = 1").unionByName(firsts.filter("_copies > 1").dropDuplicates(["doc_id"]))
    found = stored(linked_components(firsts, documents, width, threshold).withColumnRenamed("doc_id", "node"), "linked-classes")
    heads = found.join(classes, "node").groupBy("component").agg(F.min(F.struct("_first", "digest")).alias("_head"))
    labels = classes.join(found.join(heads, "component"), "node", "left").select(
        "digest", F.coalesce("_head._first", "_first").alias("_component"), F.coalesce("_head.digest", "digest").alias("_digest")
    )
    placed = signed.select("doc_id", "n_shingles", "digest").join(labels, "digest", "left")
    real = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(real, F.col("_component")).otherwise(F.col("doc_id"))
    result = placed.select("doc_id", "n_shingles", component.alias("component_id"), "digest", F.coalesce("_digest", "digest").alias("_head"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return result.withColumns({"kept": kept, "first": kept & (F.col("digest") == F.col("_head"))}).drop("_head")
