"""Token-id files as shuffled planes: fixed-size blocks of ids, transposed into bit or byte planes, each plane compressed.

A file set is a Parquet table with one row per block: its place (part, block), the planes, a checksum, and the documents that
lie in it, whole or in part (doc_ids, doc_starts, doc_tokens). Without the planes the rows are the block index. Part p holds a range of doc_id, so blocks
in (part, block) order are all ids in ascending doc_id order. Blocks are filled to the same size throughout a part, whatever
the lengths of documents; a document goes on in the next block.

Reading is one scan: a task decodes block by block. Documents that lie in one block are whole there; only those that
cross a border are put together by a shuffle of their parts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isochron.llm import tokens

BLOCK_IDS = 65_536
LEVEL = 3
BLOCKS = (
    "part int, block int, first bigint, n_ids bigint, bit_planes boolean, planes array<binary>, checksum bigint, "
    "doc_ids array<bigint>, doc_starts array<bigint>, doc_tokens array<bigint>"
)
PIECES = "part int, doc_id bigint, first bigint, n_tokens bigint, at bigint, ids binary"


# -- One block -----------------------------------------------------------------------------------------------------------


def to_planes(ids: np.ndarray, bits: bool, level: int = LEVEL) -> list[bytes]:
    """Compressed planes of unsigned 32-bit ids: plane k has bit (or byte) k of every id. Planes above the largest id are left out."""
    codec = zstandard.ZstdCompressor(level=level)
    octets = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        table = np.unpackbits(octets, axis=1, bitorder="little").T
        rows = [np.packbits(row, bitorder="little") for row in table]
    else:
        rows = [np.ascontiguousarray(column) for column in octets.T]
    while rows and not rows[-1].any():
        rows.pop()
    return [codec.compress(row.tobytes()) for row in rows]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    codec = zstandard.ZstdDecompressor()
    if bits:
        table = np.zeros((32, n), dtype=np.uint8)
        for k, plane in enumerate(planes):
            table[k] = np.unpackbits(np.frombuffer(codec.decompress(plane), np.uint8), count=n, bitorder="little")
        return np.packbits(table.T, axis=1, bitorder="little").reshape(-1).view("<u4")
    octets = np.zeros((n, 4), dtype=np.uint8)
    for k, plane in enumerate(planes):
        octets[:, k] = np.frombuffer(codec.decompress(plane), np.uint8)
    return octets.reshape(-1).view("<u4")


# -- Writing -------------------------------------------------------------------------------------------------------------


class Filler:
    """Takes documents of one part in order and gives out full blocks as rows."""

    def __init__(self, part: int, block_ids: int, bits: bool):
        self.part, self.block_ids, self.bits = part, block_ids, bits
        self.held, self.docs = bytearray(), []
        self.block, self.first, self.end = 0, 0, 0

    def add(self, doc: int | None, ids: bytes) -> Iterator[tuple]:
        self.docs.append((doc, self.end, len(ids) // 4))
        self.end += len(ids) // 4
        self.held += ids
        while len(self.held) >= 4 * self.block_ids:
            yield self.row(self.block_ids)

    def row(self, n: int) -> tuple:
        chunk = bytes(self.held[:4 * n])
        del self.held[:4 * n]
        here = [d for d in self.docs if d[1] < self.first + n]
        self.docs = [d for d in self.docs if d[1] + d[2] > self.first + n]
        ids, starts, counts = ([d[k] for d in here] for k in range(3))
        planes = to_planes(np.frombuffer(chunk, "<u4"), self.bits)
        row = (self.part, self.block, self.first, n, self.bits, planes, zlib.crc32(chunk), ids, starts, counts)
        self.block, self.first = self.block + 1, self.first + n
        return row

    def rest(self) -> Iterator[tuple]:
        if self.held:
            yield self.row(len(self.held) // 4)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    longs = pa.list_(pa.int64())
    types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.binary()), pa.int64(), longs, longs, longs)
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def write(
    documents: DataFrame, target: str, tokenizer: str, end: int, spaces_matter: bool, parts: int, block_ids: int = BLOCK_IDS,
    bits: bool = False,
) -> None:
    """Encode every text (null: empty), append the end id, and write the blocks below `target` in ascending doc_id order.

    One shuffle of the texts by ranges of doc_id; equal ids stay together, in the order of their texts; null ids come first. A
    task holds one block of ids besides the texts of an Arrow batch. An empty table writes no block. Other columns of
    `documents` are ignored.
    """
    stop = tokens.as_bytes([end])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, filler = tokens.file_encoder(tokenizer, spaces_matter), None
        for batch in batches:
            rows = []
            for part, doc, ids in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), encoder(batch.column(2).to_pylist()), strict=True
            ):
                if filler is None:
                    filler = Filler(part, block_ids, bits)
                rows.extend(filler.add(doc, ids + stop))
            if rows:
                yield _batch(rows)
        rows = list(filler.rest()) if filler else []
        if rows:
            yield _batch(rows)

    ranged = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, "doc_id")
    ordered = ranged.sortWithinPartitions("doc_id", F.xxhash64("text"))
    placed = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    placed.mapInArrow(fill, BLOCKS).write.mode("overwrite").option("compression", "uncompressed").parquet(target)


# -- Reading -------------------------------------------------------------------------------------------------------------


def blocks(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(target)


def index(spark: SparkSession, target: str) -> DataFrame:
    """The block index: which ids and documents a block has, and its checksum; the planes are not read."""
    return blocks(spark, target).drop("planes", "bit_planes")


def part_starts(spark: SparkSession, target: str) -> DataFrame:
    """part with the number of ids in all parts before it; one small row per part."""
    totals = blocks(spark, target).groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long").alias("part_start"))


def _pieces(found: DataFrame) -> DataFrame:
    """For every block, the ids of each document in it, with their place in the document."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = from_planes(row["planes"], row["n_ids"], row["bit_planes"]).tobytes()
                if zlib.crc32(chunk) != row["checksum"]:
                    raise ValueError(f"block {row['block']} of part {row['part']} is damaged")
                first, end, out = row["first"], row["first"] + row["n_ids"], []
                for doc, start, n in zip(row["doc_ids"], row["doc_starts"], row["doc_tokens"], strict=True):
                    low, high = max(start, first), min(start + n, end)
                    out.append((row["part"], doc, start, n, low - start, chunk[4 * (low - first):4 * (high - first)]))
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                names = [c.split()[0] for c in PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return found.mapInArrow(split, PIECES)


def read(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian unsigned 32-bit) of every document.

    Raises where a block does not have its checksum. Documents within one block need no shuffle; the parts of others meet by
    their place in the part, one small group per document, so repeated doc_ids stay apart. The starts of the parts, one number
    for each part written, are broadcast; the ids stay where they were decoded.
    """
    pieces = _pieces(blocks(spark, target))
    is_whole = F.octet_length("ids") == 4 * F.col("n_tokens")
    columns = ("part", "doc_id", "first", "n_tokens", "ids")
    parts = pieces.filter(~is_whole).groupBy("part", "doc_id", "first", "n_tokens").agg(
        F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("_parts")
    )
    joined = F.aggregate("_parts", F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    found = pieces.filter(is_whole).select(*columns).unionByName(parts.withColumn("ids", joined).select(*columns))
    return found.join(F.broadcast(part_starts(spark, target)), "part").select(
        "doc_id", (F.col("part_start") + F.col("first")).alias("start"), "n_tokens", "ids"
    )
