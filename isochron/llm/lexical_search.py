"""Ranked lexical search of all documents for a table of items, by two trees.

Items are vectors of term weights, documents vectors of term impacts, both without negative numbers, and a score is their inner product. A
node of either tree holds the largest value of each coordinate below it, so the product of two nodes bounds every score of an item
below the one with a document below the other. A pair of nodes whose bound is under the weakest k-th score of its items is dropped with
everything below it; the rest is refined down to single items and small blocks of documents, which are scored exactly in integers.

Documents become vectors over the terms of the items in a pass over the texts, which also gives the corpus counts. Trees of documents are built over chunks of
a partition, sorted by their rarest term, so nothing is shuffled but the best rows of each partition. The k-th scores of a
thirty-second of the documents, searched first, are where all partitions start from: a part's k-th score never exceeds that of the whole.

Items are searched in blocks of bounded size, one pass over the texts for each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isochron.session import fresh_path, stored

TOP = 10
# Items are searched in blocks of about so many different texts and bytes of text.
BLOCK_ITEMS, BLOCK_BYTES = 512, 1 << 17
CHUNK_ROWS, CHUNK_TERMS, LEAF, FANOUT = 4096, 2_000_000, 16, 4
SEED_SHARE = 32

# Bytes of terms: digits, letters and all of non-ASCII characters; A-Z become a-z, all others separate.
FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes | str | None) -> list[bytes]:
    data = text.encode() if isinstance(text, str) else text or b""
    return data.translate(FOLDED).split()


# -- Document vectors ----------------------------------------------------------------------------------------------------


def vectors(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), and the vocabulary's terms in it with their occurrences. Null texts have no term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = vocabulary.get
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column(1):
                words = terms_of(text.as_py())
                found = Counter(map(find, words))
                found.pop(None, None)
                sizes.append(len(words))
                terms.append(list(found.keys()))
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "counts"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, counts array<bigint>")


def weights_of(found: dict[int, int], size: int, documents: int) -> np.ndarray:
    """Weight of each term from the documents that hold it: floor(1000 ln((2N + 2) / (2 df + 1)))."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * found.get(t, 0) + 1))) for t in range(size)], np.int64)


def impacts(counts: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What an occurrence count is worth in a document of n terms, saturated and scaled, in integers."""
    m = 25 + (75 * n * documents) // terms
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


# -- Trees ---------------------------------------------------------------------------------------------------------------


class ItemTree:
    """Items as sparse vectors, sorted by their heaviest term, under nodes of FANOUT children that hold the largest weight of each term."""

    def __init__(self, texts: Sequence[str], vocabulary: dict[bytes, int], weights: np.ndarray):
        self.size = len(weights)
        rows = []
        for number, text in enumerate(texts):
            found = Counter(vocabulary[t] for t in terms_of(text))
            ids = np.array(sorted(found), np.int64)
            rows.append((number, ids, np.array([found[t] for t in ids], np.int64) * weights[ids]))
        heaviest = [int(ids[values.argmax()]) if len(ids) else -1 for _, ids, values in rows]
        order = sorted(range(len(rows)), key=lambda i: (heaviest[i], i))
        self.items = [rows[i] for i in order]
        self.number = np.array([r[0] for r in self.items], np.int64)
        level = [(ids, values, i, i + 1) for i, (_, ids, values) in enumerate(self.items)]
        self.levels = [level]
        while len(level) > 1:
            level = [self._joined(level[i:i + FANOUT]) for i in range(0, len(level), FANOUT)]
            self.levels.append(level)

    @staticmethod
    def _joined(nodes: list) -> tuple:
        ids, place = np.unique(np.concatenate([n[0] for n in nodes]), return_inverse=True)
        values = np.zeros(len(ids), np.int64)
        np.maximum.at(values, place, np.concatenate([n[1] for n in nodes]))
        return ids, values, nodes[0][2], nodes[-1][3]


class Chunk:
    """Documents sorted by their rarest term, in blocks of LEAF, under levels of nodes with the largest impact of each term."""

    def __init__(self, doc_ids: np.ndarray, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, weights: np.ndarray):
        """Document i has the entries starts[i] to starts[i + 1] of terms and values; each has one at least."""
        lengths = np.diff(starts)
        owner = np.repeat(np.arange(len(doc_ids)), lengths)
        rarest = np.lexsort((terms, -weights[terms], owner))[starts[:-1]]
        order = np.lexsort((doc_ids, terms[rarest]))
        self.doc_ids, lengths = doc_ids[order], lengths[order]
        self.starts = np.r_[0, np.cumsum(lengths)]
        entry = np.arange(self.starts[-1]) + np.repeat(starts[order] - self.starts[:-1], lengths)
        self.terms, self.values = terms[entry], values[entry]
        leaves = -(-len(doc_ids) // LEAF)
        top = np.zeros((len(weights), leaves))
        np.maximum.at(top, (self.terms, np.repeat(np.arange(len(doc_ids)) // LEAF, lengths)), self.values)
        self.levels = [top]
        while self.levels[-1].shape[1] > 1:
            below = self.levels[-1]
            padded = np.pad(below, ((0, 0), (0, -below.shape[1] % FANOUT)))
            self.levels.append(padded.reshape(len(weights), -1, FANOUT).max(axis=2))

    def scores(self, ids: np.ndarray, values: np.ndarray, leaves: np.ndarray, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, exact scores) of the blocks given. `dense` is a zero vector over the vocabulary, left as it was found."""
        docs = (leaves[:, None] * LEAF + np.arange(LEAF)).ravel()
        docs = docs[docs < len(self.doc_ids)]
        lengths = self.starts[docs + 1] - self.starts[docs]
        after = np.cumsum(lengths)
        entry = np.arange(after[-1]) + np.repeat(self.starts[docs] - (after - lengths), lengths)
        dense[ids] = values
        found = np.add.reduceat(dense[self.terms[entry]] * self.values[entry], after - lengths)
        dense[ids] = 0
        return docs, found


class Best:
    """The best `top` documents of each item so far, by falling score, then rising doc_id (nulls last)."""

    NO_ID = np.iinfo(np.int64).max

    def __init__(self, items: int, top: int, floor: np.ndarray):
        self.top, self.weakest = top, floor.astype(np.int64)
        self.rows = [(np.empty(0, np.int64), np.empty(0, np.int64))] * items

    def add(self, item: int, doc_ids: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.weakest[item]
        if good.any():
            ids, found = np.r_[self.rows[item][0], doc_ids[good]], np.r_[self.rows[item][1], scores[good]]
            order = np.lexsort((ids, -found))[: self.top]
            self.rows[item] = ids[order], found[order]
            if len(order) == self.top:
                self.weakest[item] = max(self.weakest[item], found[order[-1]])


def search_chunk(tree: ItemTree, chunk: Chunk, best: Best, spent: list[int] | None = None) -> None:
    """Add a chunk's documents to the best of each item. `spent` counts the scores that were computed."""
    dense = np.zeros(tree.size, np.int64)

    def visit(height: int, place: int, depth: int, nodes: np.ndarray) -> None:
        ids, values, first, last = tree.levels[height][place]
        bounds = values @ chunk.levels[depth][ids[:, None], nodes]
        bounds = bounds * (1 + 1e-9)  # sums of floating numbers may come out a little too small
        nodes = nodes[(bounds >= best.weakest[first:last].min()) & (bounds > 0)]
        if not len(nodes):
            return
        if height == depth == 0:
            docs, scores = chunk.scores(ids, values, nodes, dense)
            if spent is not None:
                spent[0] += len(docs)
            best.add(place, chunk.doc_ids[docs], scores)
            return
        if depth:
            nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            nodes = nodes[nodes < chunk.levels[depth - 1].shape[1]]
        for child in range(place * FANOUT, min((place + 1) * FANOUT, len(tree.levels[height - 1]))) if height else [place]:
            visit(max(height - 1, 0), child, max(depth - 1, 0), nodes)

    visit(len(tree.levels) - 1, 0, len(chunk.levels) - 1, np.array([0]))


def _chunks(batches: Iterator[pa.RecordBatch], weights: np.ndarray, documents: int, terms: int) -> Iterator[Chunk]:
    """Chunks of a partition's vectors: CHUNK_ROWS documents or about CHUNK_TERMS entries."""
    def made(held: list[pa.RecordBatch]) -> Chunk:
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table.column("terms").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        counts = table.column("counts").combine_chunks()
        counts = counts.chunk(0) if isinstance(counts, pa.ChunkedArray) else counts
        sizes = np.array(lists.value_lengths(), np.int64)
        starts = np.r_[0, np.cumsum(sizes)]
        flat, tf = np.array(lists.flatten(), np.int64), np.array(counts.flatten(), np.int64)
        n = np.repeat(np.array(table.column("n"), np.int64), sizes)
        ids = np.array(table.column("doc_id").fill_null(Best.NO_ID), np.int64)
        return Chunk(ids, starts, flat, impacts(tf, n, documents, terms), weights)

    held, entries = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(start, CHUNK_ROWS)
            held.append(part)
            entries += len(part.column(2).flatten())
            if sum(b.num_rows for b in held) >= CHUNK_ROWS or entries >= CHUNK_TERMS:
                yield made(held)
                held, entries = [], 0
    if any(b.num_rows for b in held):
        yield made(held)


def _best_rows(
    found: DataFrame, texts: list[str], vocabulary: dict[bytes, int], weights: np.ndarray, floor: np.ndarray, documents: int, terms: int, top: int,
) -> DataFrame:
    """item (number in the block), rank, doc_id, score of the best rows over all partitions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = ItemTree(texts, vocabulary, weights)
        best = Best(len(texts), top, floor[tree.number])
        for chunk in _chunks(batches, weights, documents, terms):
            search_chunk(tree, chunk, best)
        for number, (ids, scores) in zip(tree.number, best.rows, strict=True):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(ids), pa.int32()), pa.array(ids, pa.int64(), mask=ids == Best.NO_ID), pa.array(scores, pa.int64())],
                    names=["item", "doc_id", "score"],
                )

    rows = found.mapInArrow(run, "item int, doc_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return rows.withColumn("rank", place).filter(F.col("rank") <= top).select("item", "rank", "doc_id", "score")


# -- Search --------------------------------------------------------------------------------------------------------------


def _search_block(spark: SparkSession, documents: DataFrame, rows: list, target: str, top: int) -> None:
    """Write digest, rank, doc_id and score of a block of items (digest, text)."""
    texts = [r["text"] for r in rows]
    vocabulary = {t: i for i, t in enumerate(sorted({t for text in texts for t in terms_of(text)}))}
    held = stored(vectors(documents, vocabulary), "document-vectors", compression="zstd")
    sizes = held.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    if not sizes["documents"] or not vocabulary:
        return
    holding = held.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row per term of the block at most
    weights = weights_of({r[0]: r[1] for r in holding}, len(vocabulary), sizes["documents"])
    found = held.filter(F.size("terms") > 0)
    shared = texts, vocabulary, weights
    counts = sizes["documents"], sizes["terms"], top
    part = found.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SEED_SHARE)) == 0)
    seeds = _best_rows(part, *shared, np.ones(len(texts), np.int64), *counts).filter(F.col("rank") == top).collect()
    floor = np.ones(len(texts), np.int64)
    for seed in seeds:
        floor[seed["item"]] = max(1, seed["score"])
    best = _best_rows(found, *shared, floor, *counts)
    names = spark.createDataFrame([(i, r["digest"]) for i, r in enumerate(rows)], "item int, digest string")
    best.join(F.broadcast(names), "item").select("digest", "rank", "doc_id", "score").write.parquet(target)  # at most a block of names


def search(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the `top` documents of each row of items (item_id, text) with a score above 0.

    Equal scores go by ascending doc_id, null doc_ids last. Every row of documents counts as a document, repeated ones too, and every row of items is
    answered for itself; equal texts of items are searched once. Items without a term that any document holds have no row. Other columns are not read.
    """
    spark = documents.sparkSession
    asked = items.select(F.col("item_id").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    asked = stored(asked.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)), "search-items")
    texts = asked.select("digest", "text").dropDuplicates(["digest"])
    sizes = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(-(-sizes["n"] // BLOCK_ITEMS), -(-sizes["bytes"] // BLOCK_BYTES))
    folder = fresh_path(spark, "search-results")
    spark.createDataFrame([], "digest string, rank int, doc_id bigint, score bigint").write.parquet(f"{folder}/block=none")
    for block in range(blocks):
        rows = texts.filter(F.pmod(F.conv(F.substring("digest", 1, 12), 16, 10).cast("long"), F.lit(blocks)) == block).orderBy("digest").collect()
        if rows:
            _search_block(spark, documents, rows, f"{folder}/block={block}", top)
    found = spark.read.schema("digest string, rank int, doc_id bigint, score bigint").parquet(f"{folder}/block=*")
    return asked.select("item_id", "digest").join(found, "digest").select("item_id", "rank", "doc_id", "score")
