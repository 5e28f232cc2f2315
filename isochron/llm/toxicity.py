"""Toxicity as a weighted finite-state grammar over clauses.

A lexicon turns each word of a text into a symbol: insult (with the weight of the longest known stem), threat, target, negation,
reporting, or other; quotation marks, commas, colons, sentence ends and line ends are symbols too. Small transducers read the symbols of the whole
text and put marks on insults and threats:
  quotation:       between quotation marks, over as many sentences as they hold, a match is reported;
  reporting:       after a reporting word up to the end of the sentence ("she said: ...", also over a line end behind the colon);
  reporting back:  before a reporting word that follows a comma or a quotation mark ("..., he wrote"), read from the end;
  negation:        within a few words after a negation a match is negated;
  target, and target back: with a target word a few words before or behind it, a match is aimed.
Those that read forwards are composed into one transducer, those that read backwards into another. So a text comes out as weighted, marked
matches, not as isolated words: a negated match counts as negated, else a reported one as reported, else an aimed one as aimed, else it is plain, and a
threat is one only if it is aimed. The weights of the matches of each kind are added up per document, and a logistic layer over these sums gives the score.

Insult stems are learnt: a stem is a prefix of words, or a whole word, that occurs more often in toxic texts of the training
rows. The lists of the other classes are fixed.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isochron.session import stored

# Words of the grammar's closed classes in English, German, French and Spanish.
THREATS = frozenset("kill hurt destroy beat punch shoot stab burn hang töten schlagen tuer frapper matar golpear".split())
TARGETS = frozenset(
    "you your yours they them their he she him her people all everyone du dich dir ihr euch sie ihn tu te toi vous ils elles lui tú "
    "usted ustedes ellos ellas él ella".split()
)
NEGATIONS = frozenset("not no never none neither nor cannot nicht kein keine nie niemals pas jamais aucun nunca jamás ningún".split())
REPORTS = frozenset(
    "said says say saying claimed claims wrote writes called calls quoted reported sagte sagt schrieb dit disait écrit dijo dice escribió".split()
)
QUOTES = frozenset("\"“”„«»")

WORD = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(r"[^\W\d_]+|[\"“”„«»,:.!?;\n]")
# Words that a negation, a target and a reporting word behind a comma reach over.
NEGATION_REACH, TARGET_REACH, REPORT_REACH = 3, 3, 3
STEM_LENGTHS = range(3, 9)
KINDS = ("plain", "aimed", "negated", "reported")

SAMPLE_ROWS = 4_000
SUPPORT = 5
LEAST_WEIGHT = 2.0
LEXICON_SIZE = 5_000


# -- The lexicon ---------------------------------------------------------------------------------------------------------


def stems(word: str) -> list[str]:
    """The prefixes of a word and the word itself, which ends in $."""
    return [word[:n] for n in STEM_LENGTHS if n < len(word)] + [word + "$"]


def tokens_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def stem_counts(labelled: DataFrame) -> DataFrame:
    """stem, toxic, clean (occurrences) and toxic_docs over labelled texts (text, label), partially summed in the tasks."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter(), Counter(), Counter()
            words = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                here = Counter(tokens_of(text))
                words[label].update(here)
                if label:
                    found[2].update({s for w in here for s in stems(w)})
            for label in (0, 1):
                for word, n in words[label].items():
                    for stem in stems(word):
                        found[label][stem] += n
            names = list(found[0].keys() | found[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string())] + [pa.array([c[s] for s in names], pa.int64()) for c in (found[1], found[0], found[2])],
                names=["stem", "toxic", "clean", "toxic_docs"],
            )

    counted = labelled.select("text", "label").mapInArrow(count, "stem string, toxic bigint, clean bigint, toxic_docs bigint")
    return counted.groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "toxic_docs")])


def weight_of(toxic: Column, clean: Column, toxic_words: int, clean_words: int) -> Column:
    """Log ratio of the rates in toxic and clean texts, less one standard error."""
    ratio = F.log((toxic + 0.5) / (toxic_words + 1)) - F.log((clean + 0.5) / (clean_words + 1))
    return ratio - F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def learn_lexicon(labelled: DataFrame, toxic_words: int, clean_words: int) -> dict[str, float]:
    """Stems with their weights, the heaviest LEXICON_SIZE; a stem no heavier than a shorter one that covers it is left out."""
    counts = stem_counts(labelled).filter(F.col("toxic_docs") >= SUPPORT)
    weighed = counts.select("stem", weight_of(F.col("toxic"), F.col("clean"), toxic_words, clean_words).alias("w"))
    rows = weighed.filter(F.col("w") >= LEAST_WEIGHT).orderBy(F.desc("w"), "stem").limit(LEXICON_SIZE).collect()
    lexicon: dict[str, float] = {}
    for stem, weight in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        covering = [lexicon[s] for s in stems(stem.rstrip("$"))[:-1] if s != stem and s in lexicon]
        if not covering or weight > max(covering) + 0.5:
            lexicon[stem] = weight
    return lexicon


# -- The transducers -----------------------------------------------------------------------------------------------------


# Kinds of symbols. END is a sentence end, LINE a line end.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, COMMA, COLON, END, LINE = range(11)
MATCHES, ALL_KINDS = (INSULT, THREAT), 11
SIGNS = {**dict.fromkeys(QUOTES, QUOTE), ",": COMMA, ":": COLON, **dict.fromkeys(".!?;", END), "\n": LINE}
WORD_KINDS = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT)
REPORTED, NEGATED, AIMED = 1, 2, 4


@dataclass(frozen=True)
class Transducer:
    """arcs[state][kind] = (next state, marks put on the symbol); the start is state 0. Symbols pass through unchanged but for their marks."""

    arcs: tuple[tuple[tuple[int, int], ...], ...]

    @staticmethod
    def of(states: int, rule: Callable[[int, int], tuple[int, int]]) -> Transducer:
        """From a rule (state, kind) -> (next state, marks); only matches carry marks."""
        def arc(state: int, kind: int) -> tuple[int, int]:
            after, marks = rule(state, kind)
            return after, marks if kind in MATCHES else 0

        return Transducer(tuple(tuple(arc(state, kind) for kind in range(ALL_KINDS)) for state in range(states)))

    def then(self, other: Transducer) -> Transducer:
        """The composition: `other` reads what this one puts out. Its states are the pairs of states that can be reached."""
        number, arcs, waiting = {(0, 0): 0}, [], [(0, 0)]
        while waiting:
            a, b = waiting.pop(0)
            row = []
            for kind in range(ALL_KINDS):
                (next_a, first), (next_b, second) = self.arcs[a][kind], other.arcs[b][kind]
                if (next_a, next_b) not in number:
                    number[next_a, next_b] = len(number)
                    waiting.append((next_a, next_b))
                row.append((number[next_a, next_b], first | second))
            arcs.append(tuple(row))
        return Transducer(tuple(arcs))

    def marks(self, kinds: Iterable[int]) -> list[int]:
        """The marks of each symbol of a text."""
        state, found, arcs = 0, [], self.arcs
        for kind in kinds:
            state, marks = arcs[state][kind]
            found.append(marks)
        return found


def quotation() -> Transducer:
    """State 1 between quotation marks; a line end closes them."""
    return Transducer.of(2, lambda state, kind: (0 if kind == LINE else state ^ (kind == QUOTE), REPORTED * state))


def reporting() -> Transducer:
    """State 1 behind a reporting word, 2 behind a colon that follows it, where one line end does not end the report."""
    def rule(state: int, kind: int) -> tuple[int, int]:
        after = min(state, 1)
        if kind == REPORT:
            after = 1
        elif kind == END or (kind == LINE and state == 1):
            after = 0
        elif kind == COLON and state:
            after = 2
        return after, REPORTED if state else 0

    return Transducer.of(3, rule)


def reporting_back() -> Transducer:
    """Read from the end: states 1 to REPORT_REACH before a reporting word, as many words as may still stand before the comma or quotation mark
    that opens the last state, which holds to the beginning of the sentence."""
    behind = REPORT_REACH + 1

    def rule(state: int, kind: int) -> tuple[int, int]:
        if kind in (END, LINE):
            return 0, 0
        if state == behind:
            return behind, REPORTED
        if kind == REPORT:
            return REPORT_REACH, 0
        if state and kind in (COMMA, QUOTE):
            return behind, 0
        return (max(0, state - 1) if kind in WORD_KINDS else state), 0

    return Transducer.of(behind + 1, rule)


def reach(opened_by: int, words: int, mark: int) -> Transducer:
    """Marks matches up to so many words behind a symbol of one kind, within the clause. The state is the number of words still reached."""
    def rule(state: int, kind: int) -> tuple[int, int]:
        if kind in (END, LINE, COLON):
            return 0, 0
        after = words if kind == opened_by else max(0, state - (kind in WORD_KINDS))
        return after, mark if state else 0

    return Transducer.of(words + 1, rule)


FORWARDS = quotation().then(reporting()).then(reach(NEGATION, NEGATION_REACH, NEGATED)).then(reach(TARGET, TARGET_REACH, AIMED))
BACKWARDS = reporting_back().then(reach(TARGET, TARGET_REACH, AIMED))


def matches(kinds: Sequence[int]) -> list[tuple[int, str]]:
    """(place, kind of match) of the insults and threats of a text's symbols, in order."""
    forwards, backwards = FORWARDS.marks(kinds), BACKWARDS.marks(reversed(kinds))[::-1]
    found = []
    for place, kind in enumerate(kinds):
        if kind in MATCHES:
            marks = forwards[place] | backwards[place]
            name = "negated" if marks & NEGATED else "reported" if marks & REPORTED else "aimed" if marks & AIMED else "plain"
            if kind == INSULT or name == "aimed":
                found.append((place, name))
    return found


# -- The grammar ---------------------------------------------------------------------------------------------------------


class Grammar:
    """The lexicon and the transducers."""

    def __init__(self, lexicon: dict[str, float], kept_words: int = 200_000):
        self.lexicon, self.kept_words = lexicon, kept_words
        self.signs = {sign: (kind, 0.0) for sign, kind in SIGNS.items()}
        self.known = dict(self.signs)

    def learn(self, word: str) -> tuple[int, float]:
        """The heaviest stem that accepts the word, else its closed class."""
        weights = [self.lexicon[s] for s in stems(word) if s in self.lexicon]
        if weights:
            found = (INSULT, max(weights))
        else:
            classes = ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS))
            found = next(((kind, 1.0) for kind, words in classes if word in words), (OTHER, 0.0))
        if len(self.known) >= self.kept_words:
            self.known = dict(self.signs)
        self.known[word] = found
        return found

    def symbols(self, text: str | None) -> list[tuple[int, float]]:
        """(kind, weight) of every word and sign of a text."""
        found = []
        for word in TOKEN.findall((text or "").lower()):
            symbol = self.known.get(word)
            found.append(self.learn(word) if symbol is None else symbol)
        return found

    def document(self, text: str | None) -> list[float]:
        """Features: weight of the matches of each kind, number of matches and of clauses with one, and both per word."""
        symbols = self.symbols(text)
        kinds = [kind for kind, _ in symbols]
        if INSULT not in kinds and THREAT not in kinds:
            return [0.0] * FEATURES
        sums, clauses = dict.fromkeys(KINDS, 0.0), set()
        ends = list(itertools.accumulate(kind in (END, LINE, COLON) for kind in kinds))
        found = matches(kinds)
        for place, name in found:
            sums[name] += symbols[place][1]
            clauses.add(ends[place])
        words, total, n = sum(kind in WORD_KINDS for kind in kinds), sum(sums.values()), len(found)
        return [
            *[math.log1p(sums[k]) for k in KINDS], math.log1p(total), math.log1p(n), math.log1p(len(clauses)),
            math.log1p(100 * n / max(words, 1)), math.log1p(100 * total / max(words, 1)),
        ]


FEATURES = len(KINDS) + 5


# -- The logistic layer --------------------------------------------------------------------------------------------------


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0, steps: int = 50) -> np.ndarray:
    """Intercept and coefficients by Newton steps with a ridge penalty on the coefficients."""
    x = np.column_stack([np.ones(len(x)), x])
    ridge = np.diag([1e-6] + [penalty] * (x.shape[1] - 1))
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - ridge @ beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    beta: tuple[float, ...]

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.beta[0] + features @ np.array(self.beta[1:]), -30, 30)))


def grammar_features(rows: DataFrame, lexicon: dict[str, float], carried: str) -> DataFrame:
    """The carried column and the features of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(lexicon)
        for batch in batches:
            rows = [grammar.document(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=[carried, "features"])

    kind = rows.schema[carried].dataType.simpleString()
    return rows.select(carried, "text").mapInArrow(run, f"{carried} {kind}, features array<double>")


def held_out(doc_id: Column) -> Column:
    """The third of all rows that is never learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the labelled rows (doc_id, toxic) outside the held-out third: at most `sample_rows` toxic and as many clean ones, those
    with the least hash of doc_id. The bound keeps what is broadcast or comes to the driver (ids, features and the lexicon of the
    sample) independent of the size of the corpus. Null labels are ignored; of several labels of one doc_id the
    largest holds. Without toxic or clean rows all scores are equal.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    marks = marks.filter("doc_id IS NOT NULL AND label IS NOT NULL").filter(~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max("label").alias("label"))
    sizes = {r[0]: r[1] for r in marks.groupBy("label").count().collect()}
    parts = [marks.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id")).limit(sample_rows) for label in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = stored(texts.join(chosen, "doc_id").select("text", "label"), "labelled-sample")
    counted = sample.groupBy("label").agg(F.sum(F.size(F.split("text", " "))), F.count(F.lit(1))).collect()
    words, taken = {r[0]: r[1] or 0 for r in counted}, {r[0]: r[2] for r in counted}
    if not taken.get(0) or not taken.get(1):
        share = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 1)
        return Model({}, (math.log(share / (1 - share)), *[0.0] * FEATURES))
    lexicon = learn_lexicon(sample, words[1], words[0])
    rows = grammar_features(sample, lexicon, "label").collect()  # at most 2 * sample_rows short rows
    x, y = np.array([r["features"] for r in rows]), np.array([r["label"] for r in rows], dtype=float)
    weight = np.where(y == 1, sizes[1] / taken[1], sizes[0] / taken[0]) * len(y) / (sizes[0] + sizes[1])
    return Model(lexicon, tuple(float(b) for b in fit_logistic(x, y, weight)))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row; null and empty texts have no match and get the score of no match. Null doc_ids stay, repeated rows
    score alike, texts of any length are read whole, other columns are not read. No shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(model.lexicon)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            features = np.array([grammar.document(t) for t in texts]).reshape(len(texts), FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(features), pa.float64())], names=["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double")


def score_column(text: Column, model: Model) -> Column:
    """The score as a column expression, for filters beside other columns."""
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grammar = Grammar(model.lexicon)
        for texts in batches:
            features = np.array([grammar.document(t) for t in texts]).reshape(len(texts), FEATURES)
            yield pd.Series(model.score(features))

    return run(text)
