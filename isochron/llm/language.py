"""Language identification by prediction by partial matching over bytes.

Every language has a tree of byte contexts of up to ORDER bytes with the counts of the bytes that followed them. A text is coded byte by
byte: the longest context that the tree knows codes the byte if it has followed it before; if not, an escape is coded and the next shorter context
takes over, without the bytes that the longer one would have coded (exclusion). The escape of a context weighs as much as its number of
different bytes. Below the empty context all bytes not excluded are equally likely. So every text has an exact code length
under every language, and the shortest names the language. Statistics are learnt once and frozen: texts do not change them.

A window is the byte to be coded followed by the ORDER bytes before it, nearest first, as one integer, the coded byte on top. Cutting
bytes off its end gives the same event in a shorter context, so all orders are looked up in sorted arrays of shifted windows. A text is
preceded by ORDER zero bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isochron.session import stored

ORDER = 4
# Bounds of the sample and of the trees: documents learnt from in each language, and windows kept over all languages.
ROWS_PER_LANGUAGE, WINDOWS = 600, 1_200_000
CHUNK_BYTES, KEPT_COSTS = 1 << 20, 1_500_000
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


# -- Windows -------------------------------------------------------------------------------------------------------------


def pieces(texts: Sequence[str | None], size: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(windows, number of the text) of all bytes of all texts, about `size` bytes at a time; long texts come in several pieces."""
    buffer, owners, held = [], [], 0

    def cut() -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(buffer), np.uint8).astype(np.uint64)
        lengths = np.array([len(b) for b in buffer])
        owner = np.repeat(np.array(owners), lengths)
        place = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        window = data.copy()
        for back in range(1, ORDER + 1):
            window <<= np.uint64(8)
            window[back:] |= data[:-back]
        return window[place >= ORDER], owner[place >= ORDER]

    for number, text in enumerate(texts):
        data = (text or "").encode()
        for start in range(0, len(data), size):
            before = data[max(0, start - ORDER):start]
            buffer.append(b"\0" * (ORDER - len(before)) + before + data[start:start + size])
            owners.append(number)
            held += len(buffer[-1])
            if held >= size:
                yield cut()
                buffer, owners, held = [], [], 0
    if buffer:
        yield cut()


# -- Trees ---------------------------------------------------------------------------------------------------------------


def _at(keys: np.ndarray, table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Rows of a table for the wanted keys; zeros for keys that are not there."""
    place = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    if not len(keys):
        return np.zeros((len(wanted), table.shape[1]))
    return np.where((keys[place] == wanted)[:, None], table[place], 0).astype(float)


class Trees:
    """Frozen context trees of several languages, one column for each.

    For every order: `events` (windows cut to that order) with their counts, and `contexts` with three numbers: occurrences, different bytes,
    and how often these bytes occur in the context one byte shorter (what exclusion takes from it).
    """

    def __init__(self, languages: Sequence[str], language: np.ndarray, window: np.ndarray, count: np.ndarray):
        self.languages = list(languages)
        wide, self.orders = len(self.languages), []
        shorter = None
        for order in range(ORDER + 1):
            event, place = np.unique(window >> np.uint64(8 * (ORDER - order)), return_inverse=True)
            counts = np.zeros((len(event), wide), np.int64)
            np.add.at(counts, (place, language), count)
            context, where = np.unique(event & np.uint64((1 << 8 * order) - 1), return_inverse=True)
            sums = np.zeros((3, len(context), wide), np.int64)
            np.add.at(sums[0], where, counts)
            np.add.at(sums[1], where, counts > 0)
            if shorter is not None:
                np.add.at(sums[2], where, np.where(counts > 0, _at(*shorter, event >> np.uint64(8)).astype(np.int64), 0))
            shorter = event, counts
            self.orders.append((event, counts, context, sums))

    def costs(self, windows: np.ndarray) -> np.ndarray:
        """Bits of each window's byte after its context, for each language."""
        shape = len(windows), len(self.languages)
        bits, mass, excluded, open_ = np.zeros(shape), np.zeros(shape), np.zeros(shape), np.ones(shape, bool)
        with np.errstate(divide="ignore", invalid="ignore"):
            for order in range(ORDER, -1, -1):
                events, counts, contexts, sums = self.orders[order]
                event = windows >> np.uint64(8 * (ORDER - order))
                context = event & np.uint64((1 << 8 * order) - 1)
                count = _at(events, counts, event)
                total, distinct, below = (_at(contexts, s, context) for s in sums)
                fresh = distinct - excluded
                weight = total - mass + fresh
                coded = open_ & (count > 0)
                bits += np.where(coded, np.log2(weight) - np.log2(count), 0.0)
                open_ &= ~coded
                bits += np.where(open_ & (fresh > 0) & (total > 0), np.log2(weight) - np.log2(fresh), 0.0)
                mass, excluded = np.where(total > 0, below, mass), np.where(total > 0, distinct, excluded)
            return bits + np.where(open_, np.log2(256 - excluded), 0.0)


class Coder:
    """Code lengths of texts. Costs of windows are kept between texts, a bounded number of them."""

    def __init__(self, trees: Trees, kept: int = KEPT_COSTS):
        self.trees, self.kept = trees, kept
        self.windows, self.bits = np.empty(0, np.uint64), np.empty((0, len(trees.languages)))

    def _costs(self, windows: np.ndarray) -> np.ndarray:
        """Bits of sorted distinct windows."""
        place = np.searchsorted(self.windows, windows)
        known = np.zeros(len(windows), bool)
        if len(self.windows):
            known = self.windows[np.minimum(place, len(self.windows) - 1)] == windows
        bits = np.empty((len(windows), len(self.trees.languages)))
        bits[known] = self.bits[place[known]]
        if not known.all():
            bits[~known] = self.trees.costs(windows[~known])
            if len(self.windows) + len(windows) > self.kept:
                self.windows, self.bits = windows, bits
            else:
                self.windows = np.insert(self.windows, place[~known], windows[~known])
                self.bits = np.insert(self.bits, place[~known], bits[~known], axis=0)
        return bits

    def lengths(self, texts: Sequence[str | None]) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(texts), len(self.trees.languages)))
        for windows, owner in pieces(texts):
            distinct, place = np.unique(windows, return_inverse=True)
            bits = self._costs(distinct)
            for column in range(out.shape[1]):
                out[:, column] += np.bincount(owner, bits[:, column][place], len(texts))
        return out


# -- Learning ------------------------------------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """The quarter of all rows that is never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def labelled_sample(documents: DataFrame, rows: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """lang and text of at most `rows` learnable documents of each language, those with the least hash of doc_id.

    Rows without language, text or doc_id are not learnt from. A threshold on the hash, from the count of each language, leaves a few times the rows wanted, so
    that no language is sorted whole.
    """
    able = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("lang"), F.col("text").alias("text"))
    able = able.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").filter(~held_out(F.col("doc_id")))
    counts = stored(able.groupBy("lang").count(), "language-counts")
    share = F.least(F.lit(1.0), F.lit(4.0 * rows) / F.col("count"))
    drawn = able.withColumn("draw", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)))
    few = drawn.join(counts.select("lang", (share * (1 << 30)).alias("below")), "lang").filter("draw < below")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", F.xxhash64("text")))
    return few.withColumn("place", place).filter(F.col("place") <= rows).select("lang", "text")


def train(documents: DataFrame, rows: int = ROWS_PER_LANGUAGE, windows: int = WINDOWS) -> Trees:
    """Trees of the languages of documents (doc_id, lang, text), held-out quarter excepted.

    Learnt from a bounded sample (labelled_sample). Windows are counted in the tasks; the commonest windows // languages of each language come to the
    driver, which bounds the trees whatever the lengths of the sampled texts. The number of languages is that of classes, taken as small.
    """
    sample = stored(labelled_sample(documents, rows), "language-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for found, owner in pieces(batch.column(1).to_pylist()):
                for name in sorted(set(names[owner])):
                    distinct, n = np.unique(found[names[owner] == name], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(distinct), pa.string()), pa.array(distinct.astype(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "seen", "n"],
                    )

    counted = stored(
        sample.mapInArrow(count, "lang string, seen bigint, n bigint").groupBy("lang", "seen").agg(F.sum("n").alias("n")), "language-windows"
    )
    languages = sorted(r[0] for r in sample.select("lang").distinct().collect())
    each = windows // max(len(languages), 1)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "seen"))
    table = counted.withColumn("place", place).filter(F.col("place") <= each).select("lang", "seen", "n").toPandas()
    number = table["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy(np.int64)
    return Trees(languages, number, table["seen"].to_numpy(np.uint64), table["n"].to_numpy(np.int64))


# -- Prediction ----------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Guess:
    lang: str
    score: float
    bits: float | None


def guesses(coder: Coder, texts: Sequence[str | None]) -> list[Guess]:
    """Of each text: the language that codes it in the fewest bits (ties: first by name), the share of that code among all as probabilities, and the
    bits. Without a letter, a text or any learnt language: und with score 0."""
    spelt = [bool(t and LETTER.search(t)) for t in texts]
    if not coder.trees.languages:
        return [Guess(UNKNOWN, 0.0, None)] * len(texts)
    bits = coder.lengths([t if ok else None for t, ok in zip(texts, spelt, strict=True)])
    best = bits.argmin(axis=1)
    share = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
    return [
        Guess(coder.trees.languages[b], float(s), float(row[b])) if ok else Guess(UNKNOWN, 0.0, None)
        for b, s, row, ok in zip(best, share, bits, spelt, strict=True)
    ]


def predict(documents: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and bits of every row, from its text alone. A map without shuffle; other columns are not read.

    Null doc_ids stay, repeated rows give equal rows, texts of any length are coded whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(trees)
        for batch in batches:
            found = guesses(coder, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g.lang for g in found], pa.string()), pa.array([g.score for g in found], pa.float64()),
                 pa.array([g.bits for g in found], pa.float64())],
                names=["doc_id", "lang_pred", "score", "bits"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double, bits double")
