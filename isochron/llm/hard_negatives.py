"""Hard negatives from rotated one-bit codes.

Every vector is rotated by one fixed random rotation and kept as the signs of its components, beside its length and its alignment: the inner
product of the rotated vector with its code taken as a unit vector. An anchor's rotated vector is cut into eight bit planes, so its product with a
code is a sum of popcounts, off by no more than the length of what the planes leave out. With that product s, a vector is alignment * code plus a
rest that stands at right angles to the code, and by Cauchy and Schwarz the rest adds at most sqrt(|anchor|^2 - s^2) * |rest|. So every score has a
certain interval around an estimate, nothing is left to chance. Only rows whose interval reaches the scores wanted are scored, in integers.

Anchors come in blocks of bounded size; each block is held against all rows in two maps, one for positives and one for negatives, and
only the best rows of each partition are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isochron.session import fresh_path, stored

BLOCK_ANCHORS, BATCH_ROWS, PLANES, SEED = 1024, 2048, 8, 13
NO_ID = np.iinfo(np.int64).max
INDEX = "key bigint, vec_id bigint, label int, size bigint, vector binary, code binary, length double, alignment double"


# -- Codes ---------------------------------------------------------------------------------------------------------------


def rotation(size: int) -> np.ndarray:
    """The fixed random rotation of vectors of this size."""
    return np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, size)))[0]


def words_of(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, the last filled with zeros."""
    packed = np.packbits(bits, axis=-1)
    return np.ascontiguousarray(np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, -packed.shape[-1] % 8)])).view(np.uint64)


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code words, length, alignment) of integer vectors."""
    turned = vectors @ turn.T
    signs = turned >= 0
    alignment = np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[0])
    return words_of(signs), np.linalg.norm(turned, axis=1), alignment


class Anchors:
    """The bit planes of a block of anchors, and intervals of their scores against coded rows."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray):
        self.vectors, self.size = vectors, turn.shape[0]
        turned = vectors @ turn.T
        self.low = turned.min(axis=1, keepdims=True)
        self.step = np.maximum((turned.max(axis=1, keepdims=True) - self.low) / (2**PLANES - 1), 1e-30)
        levels = np.rint((turned - self.low) / self.step).astype(np.int64)
        self.planes = words_of((levels[:, None, :] >> np.arange(PLANES)[None, :, None] & 1).astype(bool))
        self.sums = levels.sum(axis=1)
        self.length = np.linalg.norm(turned, axis=1)
        self.left = np.linalg.norm(turned - (self.low + self.step * levels), axis=1)

    def intervals(self, codes: np.ndarray, length: np.ndarray, alignment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lowest, highest) score of every anchor with every coded row."""
        ones = np.zeros((len(self.vectors), len(codes)), np.int64)
        inside = np.zeros_like(ones)
        for word in range(codes.shape[1]):
            ones += np.bitwise_count(codes[:, word]).astype(np.int64)
            for plane in range(PLANES):
                inside += np.bitwise_count(self.planes[:, plane, word, None] & codes[None, :, word]).astype(np.int64) << plane
        # Sum of levels under the ones less that under the zeros; the same for the constant part.
        product = self.step * (2 * inside - self.sums[:, None]) + self.low * (2 * ones - self.size)
        product /= np.sqrt(self.size)
        nearest = np.maximum(np.abs(product) - self.left[:, None], 0.0)
        rest = np.sqrt(np.maximum(length**2 - alignment**2, 0.0))
        width = alignment * self.left[:, None] + np.sqrt(np.maximum(self.length[:, None] ** 2 - nearest**2, 0.0)) * rest
        width = width * (1 + 1e-9) + 1e-6 * (1 + self.length[:, None] * length * 1e-6)  # rounding
        middle = product * alignment
        return middle - width, middle + width


# -- The index -----------------------------------------------------------------------------------------------------------


def integers(embedding: Column) -> Column:
    """floor(256 x) of each component, x as double."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * 256))


def usable(rows: DataFrame) -> DataFrame:
    """key, vec_id, label and vector (integers) of the rows that take part.

    Left out are rows with a null label, a null or empty vector, a null or non-finite component, a squared length of 2**56 or more after scaling (a hundred times
    their scores need not fit a long), or another number of components than most rows have. Where vec_id is divisible by 7 the label moves on by one.
    """
    value = lambda x: x.cast("double") * 256
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(value(x)) < 2.0**31))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("embedding").alias("embedding"))
    kept = kept.filter("label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").filter(finite)
    squares = F.aggregate("embedding", F.lit(0.0), lambda done, x: done + F.floor(value(x)) * F.floor(value(x)).cast("double"))
    kept = kept.filter(squares < 2.0**56)
    size = kept.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not size:
        kept = kept.filter(F.lit(False))
    else:
        kept = kept.filter(F.size("embedding") == size[0]["size"])
    return kept.select(F.monotonically_increasing_id().alias("key"), "vec_id", moved.alias("label"), integers(F.col("embedding")).alias("vector"))


def index(rows: DataFrame) -> DataFrame:
    """The stored table of codes of the rows that take part. Rows keep their key, so repeated rows and repeated ids stay apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = None
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = np.array(batch.column(3).flatten(), np.int64).reshape(batch.num_rows, -1)
            turn = rotation(vectors.shape[1]) if turn is None else turn
            codes, length, alignment = encode(vectors.astype(float), turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([vectors.shape[1]] * len(vectors), pa.int64()),
                 pa.array([v.tobytes() for v in vectors.astype("<i4")], pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(length), pa.array(alignment)],
                names=[c.split()[0] for c in INDEX.split(", ")],
            )

    return stored(usable(rows).mapInArrow(run, INDEX), "vector-codes")


# -- Best rows -----------------------------------------------------------------------------------------------------------


class Best:
    """The best `top` rows of each slot: by falling score, then rising vec_id (nulls last)."""

    def __init__(self, slots: int, top: int):
        self.top = top
        self.slot, self.score, self.vec_id = (np.empty(0, np.int64) for _ in range(3))
        self.weakest = np.full(slots, -np.inf)

    def add(self, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        slot, score, vec_id = np.r_[self.slot, slot], np.r_[self.score, score], np.r_[self.vec_id, vec_id]
        order = np.lexsort((vec_id, -score, slot))
        slot, score, vec_id = slot[order], score[order], vec_id[order]
        first = np.r_[True, slot[1:] != slot[:-1]] if len(slot) else np.empty(0, bool)
        starts = np.flatnonzero(first)
        place = np.arange(len(slot)) - np.repeat(starts, np.diff(np.r_[starts, len(slot)]))
        kept = place < self.top
        self.slot, self.score, self.vec_id = slot[kept], score[kept], vec_id[kept]
        full = place == self.top - 1
        self.weakest[slot[full]] = score[full]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.slot), pa.array(self.score), pa.array(self.vec_id, pa.int64(), mask=self.vec_id == NO_ID)], names=["slot", "score", "vec_id"]
        )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The index by blocks of BATCH_ROWS rows, as arrays."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(start, BATCH_ROWS)
            size = part.column("size")[0].as_py()
            yield {
                "key": np.array(part.column("key"), np.int64), "vec_id": np.array(part.column("vec_id").fill_null(NO_ID), np.int64),
                "label": np.array(part.column("label"), np.int64), "length": np.array(part.column("length")), "alignment": np.array(part.column("alignment")),
                "vector": np.frombuffer(b"".join(part.column("vector").to_pylist()), "<i4").astype(np.int64).reshape(-1, size),
                "code": np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint64).reshape(part.num_rows, -1),
            }


def _exact(anchors: np.ndarray, vectors: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, integer score) of the pairs marked in a table of anchors by rows."""
    a, r = np.nonzero(wanted)
    score = np.empty(len(a), np.int64)
    for start in range(0, len(a), 1 << 16):
        part = slice(start, start + (1 << 16))
        score[part] = np.einsum("ij,ij->i", anchors[a[part]], vectors[r[part]])
    return a, r, score


def _merged(rows: DataFrame, top: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return rows.withColumn("rank", place).filter(F.col("rank") <= top)


FOUND = "slot bigint, score bigint, vec_id bigint"
COLUMNS = ["key", "vec_id", "label", "size", "vector", "code", "length", "alignment"]


def positives(codes: DataFrame, keys: np.ndarray, labels: np.ndarray, vectors: np.ndarray, top: int) -> DataFrame:
    """slot (number of the anchor), rank, vec_id, score: the best `top` other rows with an anchor's label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, best = Anchors(vectors.astype(float), rotation(vectors.shape[1])), Best(len(keys), top)
        for rows in _blocks(batches):
            same = (labels[:, None] == rows["label"]) & (keys[:, None] != rows["key"])
            low, high = anchors.intervals(rows["code"], rows["length"], rows["alignment"])
            bound = best.weakest
            if low.shape[1] >= top:  # the top-th lowest score of this block is reached for certain
                bound = np.maximum(bound, -np.partition(np.where(same, -low, np.inf), top - 1, axis=1)[:, top - 1])
            a, r, score = _exact(vectors, rows["vector"], same & (high >= bound[:, None]))
            best.add(a, score, rows["vec_id"][r])
        yield best.batch()

    return _merged(codes.select(*COLUMNS).mapInArrow(run, FOUND), top)


def negatives(
    codes: DataFrame, labels: np.ndarray, vectors: np.ndarray, anchor: np.ndarray, highest: np.ndarray, low_percent: int, high_percent: int, top: int,
) -> DataFrame:
    """slot (number of the pair), rank, vec_id, score: the best `top` rows of another label, from low_percent of the positive's score to high_percent.

    `anchor` numbers the anchor of each pair, `highest` is the score of its positive.
    """
    count = len(vectors)
    slots = np.full((count, max(1, np.bincount(anchor, minlength=count).max())), -1)  # pairs of each anchor
    for pair, of in enumerate(anchor):
        slots[of, np.flatnonzero(slots[of] < 0)[0]] = pair

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, best = Anchors(vectors.astype(float), rotation(vectors.shape[1])), Best(len(anchor), top)
        for rows in _blocks(batches):
            other = labels[:, None] != rows["label"]
            low, high = anchors.intervals(rows["code"], rows["length"], rows["alignment"])
            wanted = np.zeros(other.shape, bool)
            for column in slots.T:
                there, score = column >= 0, highest[column]
                least = np.maximum(low_percent * score / 100, best.weakest[column])
                wanted |= there[:, None] & (high >= least[:, None]) & (100 * low <= (high_percent * score)[:, None])
            a, r, score = _exact(vectors, rows["vector"], wanted & other)
            for column in slots.T:
                pair = column[a]
                positive = highest[pair]
                fits = (pair >= 0) & (low_percent * positive <= 100 * score) & (100 * score <= high_percent * positive) & (score >= best.weakest[pair])
                best.add(pair[fits], score[fits], rows["vec_id"][r[fits]])
        yield best.batch()

    return _merged(codes.select(*COLUMNS).mapInArrow(run, FOUND), top)


# -- Mining --------------------------------------------------------------------------------------------------------------


def mine(rows: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 5, low_percent: int = 80, high_percent: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score over a table of vec_id, embedding, label.

    Anchors are the rows whose vec_id is divisible by `every`; an anchor's positives are its best other rows of the same label, and a pair's negatives the
    best rows of other labels whose score lies between the two percentages of the positive's. Fewer where there are fewer.
    Rows are told apart by themselves, not by vec_id: a repeated anchor is answered twice and finds its copy. Null vec_ids are never anchors and
    come last among equal scores.  Other columns are not read.
    """
    spark = rows.sparkSession
    codes = index(rows)
    chosen = codes.filter(F.col("vec_id") % every == 0).select("key", "vec_id", "label", "size", "vector")
    blocks = -(-chosen.count() // BLOCK_ANCHORS)
    folder, schema = fresh_path(spark, "hard-negatives"), (
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    )
    spark.createDataFrame([], schema).write.parquet(f"{folder}/block=none")
    for block in range(blocks):
        held = chosen.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).orderBy("key").collect()  # about BLOCK_ANCHORS rows
        if not held:
            continue
        vectors = np.array([np.frombuffer(r["vector"], "<i4") for r in held]).astype(np.int64)
        keys, labels = np.array([r["key"] for r in held]), np.array([r["label"] for r in held])
        near = positives(codes, keys, labels, vectors, n_positives).orderBy("slot", "rank").collect()  # n_positives for each anchor at most
        if not near:
            continue
        anchor, highest = np.array([r["slot"] for r in near]), np.array([r["score"] for r in near])
        pairs = spark.createDataFrame(
            [(i, held[r["slot"]]["vec_id"], r["vec_id"], r["score"]) for i, r in enumerate(near)],
            "slot bigint, anchor_id bigint, positive_id bigint, positive_score bigint",
        )
        found = negatives(codes, labels, vectors, anchor, highest, low_percent, high_percent, n_negatives)
        found = found.select("slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        named = found.join(F.broadcast(pairs), "slot")  # at most n_positives rows for each anchor of the block
        named.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.parquet(f"{folder}/block={block}")
    return spark.read.schema(schema).parquet(f"{folder}/block=*")
