"""Packing pieces of documents into sequences of a fixed length: best fit, then local search by moves and exchanges.

Only lengths matter to a packing, and there are at most `capacity` of them. So the plan is made on the driver from the counts per
length, over classes of equal bins: a class is a multiset of lengths and the number of bins that hold just that. Best fit
decreasing lays the classes; the local search then takes the emptiest bins apart: it moves a piece to a fuller bin,
exchanges one piece for a smaller one, or two for one, as long as the sum of squared fills grows; each step acts on
whole classes at once. What comes of it are runs (length, first rank, bins, ...). The pieces find their place by their rank among the pieces of
their length, which a window over (length, salt) gives without any group larger than a salt's share.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isochron.llm import tokens

# Rows of one length that are ranked in one group.
SALT_ROWS = 50_000
PIECES = "piece int, start bigint, length bigint, ids binary"


# -- Cutting documents into pieces ---------------------------------------------------------------------------------------


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: one piece if it fits, else full pieces after a shorter first one."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    full = [(s, capacity) for s in range(head, n, capacity)]
    return [(0, head), *full] if head else full


def token_pieces(documents: DataFrame, path: str, end: int, capacity: int, spaces_matter: bool = True) -> DataFrame:
    """doc_id with piece, start, length and ids (little-endian unsigned 32-bit) of every piece of every document.

    A null text is empty: its one piece is the end token. No shuffle.
    """
    stop = tokens.as_bytes([end])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.file_encoder(path, spaces_matter)
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column(0).to_pylist(), encoder(batch.column(1).to_pylist()), strict=True):
                ids += stop
                for n, (start, length) in enumerate(piece_bounds(len(ids) // 4, capacity)):
                    rows.append((doc, n, start, length, ids[4 * start:4 * (start + length)]))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids"]
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, f"doc_id bigint, {PIECES}")


# -- The plan ------------------------------------------------------------------------------------------------------------


@dataclass
class Bins:
    """`number` bins that all hold `lengths`."""

    lengths: tuple[int, ...]
    number: int

    @property
    def fill(self) -> int:
        return sum(self.lengths)


def best_fit(counts: dict[int, int], capacity: int) -> list[Bins]:
    """Best fit decreasing over classes: each length, from the longest, goes to the fullest bins that have room for it."""
    by_fill: dict[int, list[Bins]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fill = next((f for f in range(capacity - length, 0, -1) if by_fill.get(f)), 0)
            if fill:
                bins = by_fill[fill].pop()
                used = min(left, bins.number)
                if used < bins.number:
                    by_fill[fill].append(Bins(bins.lengths, bins.number - used))
                held = bins.lengths
            else:
                per_bin = capacity // length
                used, held = (left // per_bin, (length,) * (per_bin - 1)) if left >= per_bin else (1, (length,) * (left - 1))
            made = Bins((*held, length), used)
            by_fill.setdefault(made.fill, []).append(made)
            left -= used * (1 if fill else len(made.lengths))
    return [b for bins in by_fill.values() for b in bins]


class Search:
    """Local search over classes of bins: every step makes a fuller bin fuller at the cost of an emptier one."""

    def __init__(self, bins: Sequence[Bins], capacity: int):
        self.capacity = capacity
        self.classes: Counter[tuple[int, ...]] = Counter()
        for b in bins:
            self.classes[tuple(sorted(b.lengths))] += b.number

    def lower_bound(self) -> int:
        return -(-sum(sum(k) * n for k, n in self.classes.items()) // self.capacity)

    def exchange(self, source: tuple[int, ...], taken: tuple[int, ...], target: tuple[int, ...], given: tuple[int, ...]) -> None:
        """In as many bins as both classes have, `taken` goes from source to target and `given` comes back."""
        times = min(self.classes[source], self.classes[target]) if source != target else self.classes[source] // 2
        left, right = Counter(source), Counter(target)
        left.subtract(taken), left.update(given)
        right.subtract(given), right.update(taken)
        for key in (source, target):
            self.classes[key] -= times
            if not self.classes[key]:
                del self.classes[key]
        for key in (tuple(sorted(left.elements())), tuple(sorted(right.elements()))):
            if key:
                self.classes[key] += times

    def step(self, source: tuple[int, ...]) -> bool:
        """The exchange that moves most out of a bin of `source` into an underfull bin at least as full."""
        fill = sum(source)
        targets = [k for k in self.classes if fill <= sum(k) < self.capacity and (k != source or self.classes[k] > 1)]
        if not targets:
            return False
        singles = sorted(set(source))
        pairs = sorted({(a, b) for i, a in enumerate(source) for b in source[i + 1:]})
        parts = [(a,) for a in singles] + pairs
        sizes = np.array([sum(p) for p in parts])
        # One entry for each target and each of its lengths, and one of length 0 for a plain move.
        entries = [(t, g) for t, k in enumerate(targets) for g in (0, *sorted(set(k)))]
        where, gives = np.array(entries).T
        slack = np.array([self.capacity - sum(k) for k in targets])[where]
        gain = sizes[:, None] - gives[None, :]
        gain = np.where((gain > 0) & (gain <= slack[None, :]), gain, -1)
        gain[len(singles):, gives == 0] = -1  # two pieces go only in exchange for one
        best = int(gain.argmax())
        part, entry = divmod(best, len(entries))
        if gain[part, entry] <= 0:
            return False
        given = (int(gives[entry]),) if gives[entry] else ()
        self.exchange(source, parts[part], targets[where[entry]], given)
        return True

    def run(self) -> list[Bins]:
        """Until no step is left or as few bins are used as the total length allows.

        A step adds at least one to the sum of squared fills of bins, which is bounded, so the search ends.
        """
        bound, stuck = self.lower_bound(), set()
        while sum(self.classes.values()) > bound:
            open_bins = sorted((k for k in self.classes if sum(k) < self.capacity and k not in stuck), key=lambda k: (sum(k), k))
            for source in open_bins:
                if self.step(source):
                    stuck.clear()
                    break
                stuck.add(source)
            else:
                break
        return [Bins(k, n) for k, n in sorted(self.classes.items())]


def plan(counts: dict[int, int], capacity: int) -> list[Bins]:
    """Bins for the given number of pieces of each length."""
    return Search(best_fit(counts, capacity), capacity).run()


@dataclass(frozen=True)
class Slots:
    """Where the pieces of one length go: run r takes ranks from first[r] on, `copies` to a bin."""

    first: np.ndarray
    base: np.ndarray
    copies: np.ndarray
    offset: np.ndarray

    def place(self, ranks: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.first, ranks, side="right") - 1
        bins, copy = np.divmod(ranks - self.first[run], self.copies[run])
        return self.base[run] + bins, self.offset[run] + copy * length


def slots(bins: Sequence[Bins]) -> dict[int, Slots]:
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: Counter[int] = Counter()
    base = 0
    for b in bins:
        offset = 0
        for length, copies in sorted(Counter(b.lengths).items()):
            runs.setdefault(length, []).append((used[length], base, copies, offset))
            used[length] += copies * b.number
            offset += copies * length
        base += b.number
    return {length: Slots(*np.array(r, dtype=np.int64).T) for length, r in runs.items()}


# -- Placing the pieces --------------------------------------------------------------------------------------------------


def pack(pieces: DataFrame, capacity: int, key: Sequence[str] = ("doc_id", "piece"), salt_rows: int = SALT_ROWS) -> DataFrame:
    """All columns of `pieces` (length of 1 to capacity in each row), plus sequence_id and offset.

    Offsets within a sequence are gapless from 0. Pieces of one length are interchangeable, so repeated rows are placed like
    any others; an empty table gives an empty result. Columns named sequence_id or offset are replaced, all others stay, whatever their names. Ties in
    `key` go by a hash of the whole row.

    Pieces of a length are ranked in as many salts as leave each about `salt_rows` rows, so no group grows with the table. The counts per
    (length, salt) come to the driver: at most capacity numbers and one for every salt_rows rows.
    """
    own = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    length = F.col("length").cast("long")
    by_length = {r[0]: r[1] for r in pieces.groupBy(length.alias("length")).count().collect()}  # at most capacity rows
    split = {str(n): -(-rows // salt_rows) for n, rows in by_length.items() if rows > salt_rows}
    salts = F.coalesce(F.element_at(F.from_json(F.lit(json.dumps(split)), "map<string,int>"), length.cast("string")), F.lit(1))
    salt = F.pmod(F.xxhash64(*key), salts).cast("int") if split else F.lit(0)
    # The row travels as one value, so no name of its columns meets a name used here.
    held = pieces.select(F.struct(*own).alias("row"), length.alias("length"), salt.alias("salt"))
    found = held.groupBy("length", "salt").count().collect() if split else [(n, 0, rows) for n, rows in by_length.items()]
    counts: Counter[int] = Counter()
    before: dict[tuple[int, int], int] = {}
    for n, s, rows in sorted(tuple(r) for r in found):
        before[n, s] = counts[n]
        counts[n] += rows
    places = slots(plan(counts, capacity))

    @F.pandas_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pd.Series, salt: pd.Series, rank: pd.Series) -> pd.DataFrame:
        result = np.zeros((len(length), 2), dtype=np.int64)
        bases = np.fromiter((before[k] for k in zip(length, salt, strict=True)), np.int64, len(length))
        ranks = rank.to_numpy() + bases
        for n, rows_of in length.groupby(length).indices.items():
            result[rows_of, 0], result[rows_of, 1] = places[n].place(ranks[rows_of], n)
        return pd.DataFrame(result, columns=["sequence_id", "offset"])

    order = Window.partitionBy("length", "salt").orderBy(*[F.col("row").getField(k) for k in key], F.xxhash64("row"))
    ranked = held.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    placed = ranked.withColumn("place", place("length", "salt", "rank"))
    return placed.select(*[F.col("row").getField(c).alias(c) for c in own], "place.sequence_id", "place.offset")
