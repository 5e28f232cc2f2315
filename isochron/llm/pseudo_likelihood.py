"""Document scores by masked pseudo-likelihood: every token predicted from the words around it, on both sides.

The vocabulary is all words of the corpus: what stands between white space (as str.split has it), in lower case. Words become classes: the
most frequent have one each, all others share classes by their endings, so that a class of rare words still says what kind of word it is. A token's
probability is that of its class, given by a network with one hidden layer from the classes of SPAN words before and after it, times that of
the word in its class, counted over all documents. The network gives classes in two steps, a group of GROUP classes and one of its members.
A document's score is the sum of the log-probabilities of all its tokens, each with itself masked.

Documents are stored once as blocks: the distinct words of a block and its tokens as numbers of them. Each block sends its words
with counts to buckets by hash, where they are added up over all blocks, and gets the totals of its words back, so no task
holds the vocabulary. For training, tokens are stored once more as classes, in STEPS slices by a hash of doc_id. Every step is the sum of the
gradients of one slice, added up on the executors, so each token is learnt from once, whatever the size of the corpus and however it lies in
files.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, fields
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.session import fresh_path, stored

# Words with a class of their own, classes of endings, classes in a group; with the border class they must fit a byte.
WORDS, ENDINGS, GROUP, HIDDEN = 127, 128, 16, 16
STEPS, RATE, SPAN = 24, 0.1, 3
# Tokens and documents of a block, at which it ends; distinct words of blocks in a bucket; partial sums that come to the driver.
BLOCK_TOKENS, BLOCK_DOCUMENTS, BUCKET_WORDS, SUMS = 1 << 18, 20_000, 1_000_000, 16
MARKS, ENDING, KEPT_ENDINGS = ".,;:!?", 3, 200_000


# -- Classes -------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Classes:
    """Class numbers: 0 for the border of a text, then the known words, then the classes of endings."""

    words: tuple[str, ...]
    endings: int = ENDINGS

    @property
    def size(self) -> int:
        return 1 + len(self.words) + self.endings

    def of(self, words: Sequence[str]) -> np.ndarray:
        numbers, first = _numbers(self), 1 + len(self.words)
        own = np.fromiter((numbers.get(w, 0) for w in words), np.int64, len(words))
        rare = np.flatnonzero(own == 0)
        own[rare] = first + ending_classes([words[k] for k in rare.tolist()], self.endings)
        return own


@lru_cache(maxsize=2)
def _numbers(classes: Classes) -> dict[str, int]:
    return {w: k + 1 for k, w in enumerate(classes.words)}


class _Endings(dict):
    """The hash of each ending, computed when it is first asked for; endings are few."""

    def __missing__(self, ending: str) -> int:
        found = xxhash.xxh3_64_intdigest(ending)
        if len(self) < KEPT_ENDINGS:
            self[ending] = found
        return found


_ENDINGS = _Endings()


def ending_classes(words: Sequence[str], n: int) -> np.ndarray:
    """The class of each word's last letters, marks behind it left aside."""
    found = np.fromiter((_ENDINGS[w.rstrip(MARKS)[-ENDING:]] for w in words), np.uint64, len(words))
    return (found % np.uint64(n)).astype(np.int64)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def masked_windows(tokens: np.ndarray, lengths: np.ndarray, span: int) -> np.ndarray:
    """The classes around every token of documents laid end to end, the nearest first, before and after by turns; the border class beyond both ends of
    each document."""
    place = np.arange(len(tokens)) + span * (1 + np.repeat(np.arange(len(lengths)), lengths))
    padded = np.zeros(len(tokens) + span * (len(lengths) + 1), np.uint8)
    padded[place] = tokens
    found = np.empty((len(tokens), 2 * span), np.uint8)
    for away in range(1, span + 1):
        found[:, 2 * away - 2], found[:, 2 * away - 1] = padded[place - away], padded[place + away]
    return found


# -- The network ---------------------------------------------------------------------------------------------------------


def _log_softmax(scores: np.ndarray) -> np.ndarray:
    scores = scores - scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def _double(values: np.ndarray) -> np.ndarray:
    return np.asarray(values, float)


@dataclass(frozen=True)
class Network:
    """tanh(sum of tables[place][class] + bias), then a softmax over groups of classes and one over the classes of the group."""

    tables: np.ndarray
    bias: np.ndarray
    group_out: np.ndarray
    group_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def start(size: int, hidden: int = HIDDEN, seed: int = 7, span: int = SPAN) -> Network:
        random, groups = np.random.default_rng(seed), -(-size // GROUP)
        table = lambda scale, *shape: random.standard_normal(shape) * scale
        members = np.arange(groups * GROUP).reshape(groups, GROUP)
        return Network(
            table(0.3, 2 * span, size, hidden), np.zeros(hidden), table(0.1, hidden, groups), np.zeros(groups),
            table(0.1, groups, hidden, GROUP), np.where(members < size, 0.0, -1e3),
        )

    @property
    def span(self) -> int:
        return len(self.tables) // 2

    def parts(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def like(self, flat: np.ndarray) -> Network:
        ends = np.cumsum([p.size for p in self.parts()])
        return Network(*[x.reshape(p.shape) for x, p in zip(np.split(flat, ends[:-1]), self.parts(), strict=True)])

    def single(self) -> Network:
        """The same in single precision."""
        return Network(*[p.astype(np.float32) for p in self.parts()])

    @cached_property
    def pairs(self) -> list[np.ndarray]:
        """What the two classes at a distance add up to, for every pair of classes: half as many look-ups per token. The first holds the bias."""
        sums = [(before[:, None, :] + after[None, :, :]).reshape(-1, len(self.bias)) for before, after in zip(self.tables[::2], self.tables[1::2], strict=True)]
        return [sums[0] + self.bias, *sums[1:]]

    def _hidden(self, contexts: np.ndarray) -> np.ndarray:
        size, summed = self.tables.shape[1], None
        for away, table in enumerate(self.pairs):
            found = table[contexts[:, 2 * away].astype(np.int64) * size + contexts[:, 2 * away + 1]]
            summed = found if summed is None else np.add(summed, found, out=summed)
        return np.tanh(summed, out=summed)

    def _by_group(self, gaps: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(group, places of its tokens, their members) of the groups that occur."""
        group, member = np.divmod(gaps.astype(np.int64), GROUP)
        order = np.argsort(group, kind="stable")
        found, starts = np.unique(group[order], return_index=True)
        for g, rows in zip(found.tolist(), np.split(order, starts[1:]), strict=True):
            yield g, rows, member[rows]

    def log_probabilities(self, contexts: np.ndarray, gaps: np.ndarray) -> np.ndarray:
        """Of each token's class."""
        hidden = self._hidden(contexts)
        groups = _log_softmax(hidden @ self.group_out + self.group_bias)
        found = groups[np.arange(len(gaps)), gaps // GROUP]
        for g, rows, member in self._by_group(gaps):
            found[rows] += _log_softmax(hidden[rows] @ self.out[g] + self.out_bias[g])[np.arange(len(rows)), member]
        return found

    def gradient(self, contexts: np.ndarray, gaps: np.ndarray) -> tuple[float, np.ndarray]:
        """Sum of the log-probabilities of tokens, and its gradient. What is computed for a token has the precision of the network, all sums are double, so
        the gradient of many tokens hardly depends on how they are grouped."""
        hidden = self._hidden(contexts)
        logp = _log_softmax(hidden @ self.group_out + self.group_bias)
        every = np.arange(len(gaps))
        total = float(logp[every, gaps // GROUP].sum(dtype=float))
        error = -np.exp(logp)
        error[every, gaps // GROUP] += 1
        back = error @ self.group_out.T
        out, out_bias = np.zeros(self.out.shape), np.zeros(self.out_bias.shape)
        for g, rows, member in self._by_group(gaps):
            own = hidden[rows]
            inside = _log_softmax(own @ self.out[g] + self.out_bias[g])
            total += float(inside[np.arange(len(rows)), member].sum(dtype=float))
            miss = -np.exp(inside)
            miss[np.arange(len(rows)), member] += 1
            out[g], out_bias[g] = _double(own).T @ _double(miss), miss.sum(axis=0, dtype=float)
            back[rows] += miss @ self.out[g].T
        back *= 1 - hidden**2
        tables = np.zeros(self.tables.shape)
        for table, place in zip(tables, contexts.T, strict=True):
            order = np.argsort(place, kind="stable")  # bytes are sorted by counting
            counts = np.bincount(place, minlength=len(table))
            found = np.flatnonzero(counts)
            if len(found):
                table[found] = np.add.reduceat(back[order], (np.cumsum(counts) - counts)[found], axis=0, dtype=float)
        return total, np.concatenate([
            tables.ravel(), back.sum(axis=0, dtype=float), (_double(hidden).T @ _double(error)).ravel(), error.sum(axis=0, dtype=float), out.ravel(),
            out_bias.ravel(),
        ])


def ascend(network: Network, steps: int, rate: float, mean_gradient: Callable[[int, Network], np.ndarray]) -> Network:
    """Ascent with per-weight step sizes (Adam) along mean_gradient(step, network)."""
    flat = network.flat()
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, steps + 1):
        gradient = mean_gradient(step - 1, network)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        flat = flat + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        network = network.like(flat)
    return network


# -- Blocks and counts ---------------------------------------------------------------------------------------------------


BLOCKS = "block bigint, doc_ids array<bigint>, lengths array<int>, words string, n_words bigint, tokens binary"
TOP = pa.list_(pa.struct([("word", pa.string()), ("total", pa.int64())]))
TOTALS = "block bigint, bucket int, totals binary, top array<struct<word:string,total:bigint>>, class_sums array<bigint>"


@dataclass(frozen=True)
class Model:
    """A network over classes, how often each class was counted, and the number of buckets in which words were counted."""

    network: Network
    classes: Classes
    class_totals: np.ndarray
    buckets: int


def _split(words: str) -> list[str]:
    return words.split(" ") if words else []


def _buckets(words: Sequence[str], buckets: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), np.int32, len(words))


def store_blocks(documents: DataFrame) -> DataFrame:
    """All documents as stored blocks, one row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids, lengths, tokens, n = [], [], [], 0
        known = defaultdict()
        known.default_factory = known.__len__

        def row() -> pa.RecordBatch:
            packed = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 32) + made]), pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
                pa.array([" ".join(known)]), pa.array([len(known)], pa.int64()), pa.array([packed.tobytes()], pa.binary()),
            ], names=["block", "doc_ids", "lengths", "words", "n_words", "tokens"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words_of(text)
                tokens.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
                ids.append(doc_id)
                lengths.append(len(found))
                n += len(found)
                if n >= BLOCK_TOKENS or len(ids) >= BLOCK_DOCUMENTS:
                    yield row()
                    made += 1
                    ids, lengths, tokens, n = [], [], [], 0
                    known.clear()
        if ids:
            yield row()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, BLOCKS)
    return stored(rows, "token-blocks", compression="zstd")


def bucket_count(blocks: DataFrame) -> int:
    """As many buckets as leave each about BUCKET_WORDS words of blocks."""
    return max(1, -(-(blocks.agg(F.sum("n_words")).first()[0] or 0) // BUCKET_WORDS))


def count_words(blocks: DataFrame, n: int, endings: int, buckets: int) -> DataFrame:
    """Words counted over all blocks, by bucket of their hash, and stored.

    A row with a block has the totals of that block's words of the bucket, in the block's order. The row without one has the bucket's
    n most frequent words with their totals, and the sum of the totals of all its words by class of endings.
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, text, tokens in zip(*(batch.column(k) for k in range(3)), strict=True):
                words = np.array(_split(text.as_py()), dtype=object)
                counts = np.bincount(np.frombuffer(tokens.as_buffer(), np.int32), minlength=len(words)) if len(words) else np.zeros(0, np.int64)
                bucket = _buckets(words, buckets)
                order = np.argsort(bucket, kind="stable")
                found, at = np.unique(bucket[order], return_index=True)
                parts = [p for p in np.split(order, at[1:]) if len(p)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([block.as_py()] * len(found), pa.int64()), pa.array(found, pa.int32()),
                    pa.array([" ".join(words[p]) for p in parts], pa.string()), pa.array([counts[p].astype("<i8").tobytes() for p in parts], pa.binary()),
                ], names=["block", "bucket", "words", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        texts = [_split(t) for t in rows["words"].to_pylist()]
        totals = defaultdict(int)
        for words, counts in zip(texts, rows["counts"].to_pylist(), strict=True):
            for word, count in zip(words, np.frombuffer(counts, "<i8").tolist(), strict=True):
                totals[word] += count
        top = sorted(totals, key=lambda w: (-totals[w], w))[:n]
        sums = np.bincount(ending_classes(list(totals), endings), np.fromiter(totals.values(), np.float64, len(totals)), endings)
        packed = [np.fromiter(map(totals.__getitem__, words), np.int64, len(words)).tobytes() for words in texts]
        none = [None] * len(texts)
        return pa.table([
            pa.array([*rows["block"].to_pylist(), None], pa.int64()), pa.array([rows["bucket"][0].as_py()] * (len(texts) + 1), pa.int32()),
            pa.array([*packed, None], pa.binary()), pa.array([*none, [{"word": w, "total": totals[w]} for w in top]], TOP),
            pa.array([*none, sums.astype(np.int64).tolist()], pa.list_(pa.int64())),
        ], names=["block", "bucket", "totals", "top", "class_sums"])

    sent = blocks.select("block", "words", "tokens").mapInArrow(send, "block bigint, bucket int, words string, counts binary")
    return stored(sent.groupBy("bucket").applyInArrow(add, TOTALS), "word-totals", compression="zstd")


def choose_classes(totals: DataFrame, n: int, endings: int) -> tuple[Classes, np.ndarray]:
    """The n most frequent words get classes of their own; how often each class was counted. n words and `endings` sums come to the driver."""
    summed = totals.where("block IS NULL")
    top = summed.select(F.inline("top")).orderBy(F.desc("total"), "word").limit(n).collect()
    sums = np.zeros(endings, np.int64)
    for place, total in summed.select(F.posexplode("class_sums").alias("place", "total")).groupBy("place").agg(F.sum("total")).collect():
        sums[place] = total
    np.subtract.at(sums, ending_classes([r["word"] for r in top], endings), np.array([r["total"] for r in top], np.int64))
    return Classes(tuple(r["word"] for r in top), endings), np.array([0, *[r["total"] for r in top], *sums], np.int64)


# -- Training ------------------------------------------------------------------------------------------------------------


def slice_of(doc_id: int | None, slices: int) -> int:
    return xxhash.xxh3_64_intdigest(str(doc_id)) % slices


def store_slices(blocks: DataFrame, classes: Classes, slices: int = STEPS) -> DataFrame:
    """All tokens as classes, a byte each, in one folder per slice. The slice of a document follows from its doc_id alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, lengths, text, tokens in zip(*(batch.column(k) for k in range(4)), strict=True):
                size = np.array(lengths.as_py(), np.int64)
                part = np.array([slice_of(d, slices) for d in doc_ids.as_py()], np.int64)
                words = classes.of(_split(text.as_py())).astype(np.uint8)
                gaps = words[np.frombuffer(tokens.as_buffer(), np.int32)]
                owner = np.repeat(part, size)
                found = np.unique(part[size > 0])
                yield pa.RecordBatch.from_arrays([
                    pa.array(found, pa.int32()), pa.array([size[part == k].tolist() for k in found], pa.list_(pa.int32())),
                    pa.array([gaps[owner == k].tobytes() for k in found], pa.binary()),
                ], names=["slice", "lengths", "gaps"])

    schema = "slice int, lengths array<int>, gaps binary"
    rows = blocks.select("doc_ids", "lengths", "words", "tokens").mapInArrow(run, schema)
    path = fresh_path(blocks.sparkSession, "class-slices")
    rows.write.partitionBy("slice").option("compression", "zstd").parquet(path)
    return blocks.sparkSession.read.schema(schema).parquet(path)


def mean_gradient(rows: DataFrame, network: Network, chunk: int = 4096) -> np.ndarray:
    """The mean gradient over all tokens of rows (lengths, gaps): a sum per task, SUMS sums of these on the executors, and their sum."""
    size, single = network.flat().size, network.single()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, summed = 0, np.zeros(size)
        for batch in batches:
            for lengths, octets in zip(batch.column(0), batch.column(1), strict=True):
                gaps = np.frombuffer(octets.as_buffer(), np.uint8)
                contexts = masked_windows(gaps, np.array(lengths.as_py(), np.int64), network.span)
                n += len(gaps)
                for at in range(0, len(gaps), chunk):
                    summed += single.gradient(contexts[at:at + chunk], gaps[at:at + chunk])[1]
        salt = TaskContext.get().partitionId() % SUMS
        yield pa.RecordBatch.from_arrays([pa.array([salt], pa.int32()), pa.array([n]), pa.array([summed.tobytes()], pa.binary())], names=["salt", "n", "gradient"])

    def add(parts: pa.Table) -> pa.Table:
        summed = sum((np.frombuffer(g.as_buffer()) for g in parts["gradient"]), np.zeros(size))
        return pa.table([pa.array([sum(parts["n"].to_pylist())], pa.int64()), pa.array([summed.tobytes()], pa.binary())], names=["n", "gradient"])

    parts = rows.select("lengths", "gaps").mapInArrow(run, "salt int, n bigint, gradient binary")
    found = parts.groupBy("salt").applyInArrow(add, "n bigint, gradient binary").collect()
    summed = sum((np.frombuffer(r["gradient"]) for r in found), np.zeros(size))
    return summed / max(1, sum(r["n"] for r in found))


def fit_corpus(
    documents: DataFrame, words: int = WORDS, endings: int = ENDINGS, hidden: int = HIDDEN, steps: int = STEPS, span: int = SPAN, rate: float = RATE,
) -> tuple[DataFrame, DataFrame, Model]:
    """Stored blocks, the totals of their words, and the model trained on them: `steps` steps, each over one of as many slices."""
    if 1 + words + endings > 256:
        raise ValueError(f"{1 + words + endings} classes do not fit a byte")
    blocks = store_blocks(documents)
    buckets = bucket_count(blocks)
    totals = count_words(blocks, words, endings, buckets)
    classes, class_totals = choose_classes(totals, words, endings)
    slices = store_slices(blocks, classes, steps)
    network = ascend(
        Network.start(classes.size, hidden, span=span), steps, rate, lambda step, now: mean_gradient(slices.where(F.col("slice") == step), now)
    )
    return blocks, totals, Model(network, classes, class_totals, buckets)


# -- Scoring -------------------------------------------------------------------------------------------------------------


def score_corpus(blocks: DataFrame, totals: DataFrame, model: Model, chunk: int = 4096) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (summed over all tokens, each predicted from both sides) and mean_log_likelihood of all documents in blocks.

    The totals of a block's words meet it by one shuffle on the block. Buckets are put back in the order in which they were cut.
    """
    network, classes, buckets = model.network.single(), model.classes, model.buckets

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found, counted = left.to_pylist()[0], right.sort_by("bucket")["totals"].to_pylist()
        words, lengths = _split(found["words"]), np.array(found["lengths"], np.int64)
        total = np.zeros(len(words), np.int64)
        total[np.argsort(_buckets(words, buckets), kind="stable")] = np.frombuffer(b"".join(counted), np.int64)
        number = classes.of(words)
        inside = np.log(total / model.class_totals[number])
        tokens = np.frombuffer(found["tokens"], np.int32)
        gaps = number[tokens].astype(np.uint8)
        contexts, logp = masked_windows(gaps, lengths, network.span), inside[tokens]
        for at in range(0, len(gaps), chunk):
            logp[at:at + chunk] += network.log_probabilities(contexts[at:at + chunk], gaps[at:at + chunk])
        sums = np.bincount(np.repeat(np.arange(len(lengths)), lengths), logp, len(lengths)).astype(float)
        means = [s / n if n else None for s, n in zip(sums.tolist(), lengths.tolist(), strict=True)]
        return pa.table(
            [pa.array(found["doc_ids"], pa.int64()), pa.array(lengths), pa.array(sums), pa.array(means, pa.float64())],
            names=["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"],
        )

    schema = "doc_id bigint, n_tokens bigint, log_likelihood double, mean_log_likelihood double"
    counted = totals.where("block IS NOT NULL").select("block", "bucket", "totals")
    return blocks.drop("n_words").groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(run, schema)


def pseudo_likelihood(documents: DataFrame, **options: int) -> DataFrame:
    """Fit on all documents, then score all documents.

    Null and empty texts have no tokens, a sum of 0 and a null mean. Null doc_ids stay, repeated rows score alike (to single precision) and each counts in
    training. A block holds whole texts, so a very long one makes a block of its size. An empty table gives an empty result; other columns are not read.
    """
    return score_corpus(*fit_corpus(documents, **options))


def perplexity(scores: Sequence[tuple[int, float]]) -> float:
    """exp of the negative mean log-probability per token over (n_tokens, log_likelihood)."""
    return float(np.exp(-sum(s for _, s in scores) / max(1, sum(n for n, _ in scores))))
