"""Byte-level BPE by a global shuffle of distinct pre-tokens.

1. Documents are grouped into blocks where they are scanned. Every text is exploded into pre-tokens, in order of position; a block
   keeps its distinct words once, and each document is the list of its words' numbers within the block.
2. The blocks' words are dealt over buckets by their hash, packed so that a (block, bucket) pair is one row. A bucket meets every
   occurrence of a word, encodes it once, and sends each block the ids of its words, in the block's order.
3. Blocks join their ids back, and documents are reassembled by position.
Decoding joins ids with the table of token bytes.

What is shuffled is therefore the distinct words of blocks and the packed numbers, never a row per occurrence; a word that
makes up a third of all text is one entry per block. Blocks are written before they are used twice, so a lost executor
costs only its own tasks. They are bucketed by block, so the numbers stay where they were written.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.llm.tokens import cut_before_spaces
from isochron.session import fresh_path

BLOCK_CHARS = 6_000_000
BLOCK = "block string, doc_ids array<bigint>, counts array<bigint>, refs binary, word_buckets binary, buckets array<struct<bucket:int,words:binary>>"
ANSWER = "block string, bucket int, lengths binary, ids binary"
ENCODED = "doc_id bigint, ids binary"


# -- The vocabulary ------------------------------------------------------------------------------------------------------


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids. The file must be on every executor."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id: a table of the vocabulary's size."""
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


# -- Packing -------------------------------------------------------------------------------------------------------------


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as compressed byte planes."""
    planes = np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=6).compress(planes.tobytes())


def unpack_numbers(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def pack_words(words: Sequence[bytes]) -> bytes:
    lengths = np.fromiter(map(len, words), dtype="<u4", count=len(words))
    head = np.array([len(words)], dtype="<u4")
    return zstandard.ZstdCompressor(level=6).compress(head.tobytes() + lengths.tobytes() + b"".join(words))


def unpack_words(packed: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(packed)
    n = int(np.frombuffer(data, "<u4", count=1)[0])
    ends = 4 + 4 * n + np.cumsum(np.frombuffer(data, "<u4", count=n, offset=4), dtype=np.int64)
    starts = np.concatenate([[4 + 4 * n], ends[:-1]]) if n else ends
    return [data[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


# -- Blocks --------------------------------------------------------------------------------------------------------------


class Block:
    """Collects documents: the numbers of their pre-tokens, and the distinct pre-tokens in order of first use."""

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall
        self.numbers: dict[str, int] = {}
        self.cuts: dict[str, bytes] = {}
        self.doc_ids, self.counts, self.refs, self.chars = [], [], [], 0

    def of_piece(self, piece: str) -> bytes:
        numbers = self.numbers
        found = np.array([numbers.setdefault(w, len(numbers)) for w in self.find(piece)], dtype="<u4").tobytes()
        self.cuts[piece] = found
        return found

    def add(self, doc_id: int | None, text: str | None) -> None:
        pieces, known = cut_before_spaces(text or ""), self.cuts
        if pieces is None:
            refs = self.of_piece(text)
            del known[text]
        else:
            refs = b"".join([known[p] if p in known else self.of_piece(p) for p in pieces])
        self.doc_ids.append(doc_id)
        self.counts.append(len(refs) // 4)
        self.refs.append(refs)
        self.chars += len(text or "")

    def row(self, buckets: int) -> pa.RecordBatch:
        """One row. The words of a bucket stand in the block's order, so their ids need no numbers to be put back."""
        words = [w.encode() for w in self.numbers]
        places = [xxhash.xxh3_64_intdigest(w) % buckets for w in words]
        dealt: list[list[bytes]] = [[] for _ in range(buckets)]
        for word, place in zip(words, places, strict=True):
            dealt[place].append(word)
        packed = [{"bucket": k, "words": pack_words(words)} for k, words in enumerate(dealt) if words]
        kind = pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())]))
        refs = pack_numbers(np.frombuffer(b"".join(self.refs), "<u4"))
        longs = pa.list_(pa.int64())
        columns = [
            pa.array([uuid.uuid4().hex]), pa.array([self.doc_ids], longs), pa.array([self.counts], longs), pa.array([refs], pa.binary()),
            pa.array([pack_numbers(np.array(places, "<u4"))], pa.binary()), pa.array([packed], kind),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "doc_ids", "counts", "refs", "word_buckets", "buckets"])


def blocks(documents: DataFrame, pattern: str, buckets: int, block_chars: int) -> DataFrame:
    """Documents exploded into pre-tokens, block by block."""
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(pattern)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                block.add(doc_id, text)
                if block.chars >= block_chars:
                    yield block.row(buckets)
                    block = Block(pattern)
        if block.doc_ids:
            yield block.row(buckets)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(collect, BLOCK)


def stored_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """A table in the shared folder, bucketed by a key: it is written where its rows are, and groups by the key need no shuffle of it."""
    spark = df.sparkSession
    n, table = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(n, key).option("path", fresh_path(spark, name)).saveAsTable(table)
    return spark.table(table)


# -- Encoding ------------------------------------------------------------------------------------------------------------


def encode_words(asked: DataFrame, path: str, pattern: str) -> DataFrame:
    """For every (block, bucket, words): the ids of the words, each distinct word of a bucket encoded once."""
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_one = encoding(path, pattern).encode_ordinary
        bucket, known = None, {}
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    bucket, known = row["bucket"], {}
                ids, lengths = [], []
                for word in unpack_words(row["words"]):
                    found = known.get(word)
                    if found is None:
                        found = known[word] = encode_one(word.decode())
                    ids += found
                    lengths.append(len(found))
                rows.append((row["block"], bucket, pack_numbers(np.array(lengths, "<u4")), pack_numbers(np.array(ids, "<u4"))))
            if rows:
                columns = zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.binary(), pa.binary()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["block", "bucket", "lengths", "ids"])

    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(answer, ANSWER)


def reassemble(made: pa.Table, answers: pa.Table) -> pa.Table:
    """The ids of every document of one block, from the numbers of its words and the ids of those words."""
    (row,) = made.to_pylist()
    found = sorted(zip(answers["bucket"].to_pylist(), answers["lengths"].to_pylist(), answers["ids"].to_pylist(), strict=True))
    none = [np.zeros(0, dtype="<u4")]
    grouped = np.concatenate(none + [unpack_numbers(x[1]) for x in found]).astype(np.int64)
    ids = np.concatenate(none + [unpack_numbers(x[2]) for x in found])
    # Words stand in their bucket in the order of their numbers: a stable sort by bucket lines numbers up with answers.
    words = np.argsort(unpack_numbers(row["word_buckets"]), kind="stable")
    lengths, starts = np.zeros_like(grouped), np.zeros_like(grouped)
    lengths[words], starts[words] = grouped, np.cumsum(grouped) - grouped
    refs = unpack_numbers(row["refs"])
    spans = lengths[refs]
    ends = np.cumsum(spans)
    flat = ids[np.repeat(starts[refs] - (ends - spans), spans) + np.arange(int(spans.sum()))]
    octets = flat.astype("<u4").tobytes()
    borders = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(row["counts"])]).astype(np.int64)] * 4
    pieces = [octets[low:high] for low, high in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]
    return pa.table({"doc_id": pa.array(row["doc_ids"], pa.int64()), "ids": pa.array(pieces, pa.binary())})


def encode(documents: DataFrame, path: str, pattern: str, buckets: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit) of every document, each match of the pattern encoded by itself.

    Null and empty texts have no ids. Repeated rows and null doc_ids come out as often as they went in; other columns are
    ignored; an empty table gives an empty result. Memory of a task: one block, or the distinct words of one bucket.
    """
    made = stored_by(blocks(documents, pattern, buckets, block_chars), "word_blocks", "block")
    asked = made.select("block", F.inline("buckets"))
    answers = encode_words(asked, path, pattern)
    numbers = made.select("block", "doc_ids", "counts", "refs", "word_buckets")
    return numbers.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(reassemble, ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns of `encoded` (ids among them), plus decoded: the bytes of each row's ids. No shuffle."""
    own = [c for c in encoded.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = token_bytes(path).__getitem__
        for batch in batches:
            texts = [b"".join(map(look, np.frombuffer(x or b"", "<u4").tolist())) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*own, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*own).schema.fields)
    return encoded.select(*own).mapInArrow(run, f"{kinds}, decoded binary")
