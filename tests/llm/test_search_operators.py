"""Language by context trees, lexical search by two trees, hard negatives from one-bit codes: brute force and edge cases."""

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from isochron.llm import hard_negatives, language, lexical_search, queries

# -- Language ------------------------------------------------------------------------------------------------------------


class SlowTrees:
    """The same model in dictionaries and fractions, byte by byte."""

    def __init__(self, texts):
        self.seen = defaultdict(Counter)
        for text in texts:
            data = b"\0" * language.ORDER + text.encode()
            for i in range(language.ORDER, len(data)):
                for order in range(language.ORDER + 1):
                    self.seen[data[i - order:i]][data[i]] += 1

    def probability(self, context, byte):
        excluded, escaped = set(), Fraction(1)
        for start in range(language.ORDER + 1):
            counts = self.seen.get(context[start:])
            if not counts:
                continue
            fresh = {b: n for b, n in counts.items() if b not in excluded}
            total = sum(fresh.values()) + len(fresh)
            if byte in fresh:
                return escaped * Fraction(fresh[byte], total)
            if fresh:
                escaped *= Fraction(len(fresh), total)
            excluded |= set(counts)
        return escaped / (256 - len(excluded))

    def bits(self, text):
        data = b"\0" * language.ORDER + text.encode()
        return -sum(math.log2(self.probability(data[i - language.ORDER:i], data[i])) for i in range(language.ORDER, len(data)))


def trees_of(corpus):
    rows = [
        (i, int(w)) for i, name in enumerate(sorted(corpus)) for windows, _ in language.pieces(corpus[name]) for w in windows
    ]
    found = Counter(rows)
    return language.Trees(
        sorted(corpus), np.array([k[0] for k in found]), np.array([k[1] for k in found], np.uint64), np.array(list(found.values()))
    )


CORPUS = {
    "xx": ["abab abab abc", "ab", "çà et là", "abab"], "yy": ["the cat sat on the mat", "cats", "that hat"], "zz": ["漢字 漢字", "字"],
}


def test_code_lengths_equal_a_slow_coder():
    trees = trees_of(CORPUS)
    texts = ["abab", "that cat", "漢", "unseen Ω\0", "", "a", "abc abc the mat " * 5]
    found = language.Coder(trees).lengths(texts)
    for column, name in enumerate(trees.languages):
        slow = SlowTrees(CORPUS[name])
        assert found[:, column] == pytest.approx([slow.bits(t) for t in texts], rel=1e-9)


def test_probabilities_of_all_bytes_sum_to_one():
    trees = trees_of(CORPUS)
    for context in (b"abab", b"the ", b"\0\0\0\0", b"zzzz", b" cat", b"tion"):
        before = sum(b << 8 * (3 - i) for i, b in enumerate(context[::-1]))
        windows = np.array([(byte << 32) | before for byte in range(256)], np.uint64)
        assert np.exp2(-trees.costs(windows)).sum(axis=0) == pytest.approx([1.0] * len(trees.languages))


def test_pieces_of_long_texts_give_the_windows_of_whole_texts():
    texts = ["abc" * 50, None, "", "ü" * 37, "x"]
    whole = [(w, o) for ws, os in language.pieces(texts) for w, o in zip(ws.tolist(), os.tolist(), strict=True)]
    cut = [(w, o) for ws, os in language.pieces(texts, 7) for w, o in zip(ws.tolist(), os.tolist(), strict=True)]
    assert whole == cut and len(whole) == sum(len((t or "").encode()) for t in texts)


def test_forgetting_coder_stays_right():
    trees = trees_of(CORPUS)
    texts = ["abab cats", "hat", "漢字", "abab cats"]
    assert (language.Coder(trees, kept=3).lengths(texts) == language.Coder(trees).lengths(texts)).all()


def test_language_of_edge_cases(spark, edge):
    found = language.predict(edge, trees_of(CORPUS)).collect()
    assert len(found) == edge.count()
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (1, 2, 3))
    assert by_id[4]["lang_pred"] in CORPUS and 0 < by_id[4]["score"] <= 1 and None in by_id
    assert by_id[8]["bits"] > by_id[7]["bits"] > 10_000
    twice = [r for r in found if r["doc_id"] == 5]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_learning_takes_no_held_out_null_or_surplus_rows(spark, empty):
    rows = [(i, "aa" if i % 3 else "bb", f"text {i} of it") for i in range(300)] + [(None, "aa", "no id"), (1, None, "no lang"), (2, "cc", None), (1, "aa", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").withColumn("draw", F.lit("mine"))
    sample = language.labelled_sample(docs, 20).collect()
    assert Counter(r["lang"] for r in sample) == {"aa": 20, "bb": 20}
    able = {r["doc_id"] for r in docs.filter("doc_id IS NOT NULL").filter(~language.held_out(F.col("doc_id"))).collect()}
    assert all(int(r["text"].split()[1]) in able for r in sample if r["text"] != "x")
    none = language.train(empty.withColumn("lang", F.lit("aa")))
    assert none.languages == [] and language.predict(docs, none).filter("lang_pred = 'und' AND score = 0").count() == docs.count()
    assert language.predict(empty, trees_of(CORPUS)).collect() == []


def test_language_query_on_held_out_rows(spark, small_dir):
    found = queries.QUERIES["op11_language_id"](spark, small_dir)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "lang")
    held = found.join(docs, "doc_id").filter("held_out").collect()
    assert found.count() == docs.count() and len(held) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


# -- Lexical search ------------------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_search(documents, items, top=10):
    counts = [(doc, Counter(slow_terms(text)), len(slow_terms(text))) for doc, text in documents]
    n_docs, total = sum(n > 0 for _, _, n in counts), sum(n for _, _, n in counts)
    df = Counter(t for _, found, _ in counts for t in found)
    out = []
    for item, text in items:
        scored = []
        for doc, found, n in counts:
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * found[t] // (1000 * found[t] + 8 * (25 + 75 * n * n_docs // total)))
                for t in slow_terms(text) if found[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def found_rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


WORDS = [f"w{i}" for i in range(60)] + ["É", "é", "A", "a", "漢字", "x_y", "don't"]


def random_texts(seed, n, longest):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS[: rng.choice((5, 20, len(WORDS)))]) for _ in range(rng.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize(("chunk", "leaf", "items_at_once"), [(4096, 16, 512), (7, 2, 512), (50, 3, 5)])
def test_search_equals_brute_force(spark, monkeypatch, chunk, leaf, items_at_once):
    documents = list(enumerate(random_texts(1, 400, 30))) + [(3, "w1 w2 w3"), (3, "w1 w2 w3"), (None, "w1 w2 w3"), (9_000, None), (9_001, ""), (9_002, "w1 " * 3000)]
    items = list(enumerate(random_texts(2, 30, 12))) + [(1, "w1 w2"), (1, "w1 w2"), (None, "É w3 w3"), (77, None), (78, "---"), (79, "unheard")]
    docs = spark.createDataFrame(documents, "doc_id bigint, text string").withColumns({"score": F.lit("x"), "rank": F.lit(1), "terms": F.lit(2)}).repartition(5)
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumns({"digest": F.lit("x"), "rank": F.lit(1)})
    monkeypatch.setattr(lexical_search, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(lexical_search, "LEAF", leaf)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", items_at_once)
    assert found_rows(lexical_search.search(docs, asked)) == slow_search(documents, items)


def test_search_of_empty_tables(spark, empty):
    items = spark.createDataFrame([(1, "w1")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "w1 w2")], "doc_id bigint, text string")
    assert lexical_search.search(empty, items).collect() == []
    assert lexical_search.search(docs, items.limit(0)).collect() == []
    assert lexical_search.search(docs.withColumn("text", F.lit(None).cast("string")), items).collect() == []


def test_bounds_prune_and_keep_every_best_row():
    """Two kinds of documents, items of one kind: blocks of the other kind are never scored, and the best are those of a full scan."""
    rng = random.Random(5)
    vocabulary = {f"t{i}".encode(): i for i in range(40)}
    weights = np.array([rng.randrange(500, 9000) for _ in vocabulary])
    texts = [" ".join(f"t{rng.randrange(20)}" for _ in range(6)) for _ in range(12)]
    tree = lexical_search.ItemTree(texts, vocabulary, weights)
    rows = [sorted(rng.sample(range(20) if i % 4 == 0 else range(20, 40), 5)) for i in range(2000)]
    values = np.array([[rng.randrange(1, 900_000) for _ in row] for row in rows])
    chunk = lexical_search.Chunk(np.arange(2000), np.arange(0, 10_001, 5), np.array(rows).ravel(), values.ravel(), weights)
    best, spent = lexical_search.Best(len(texts), 10, np.ones(len(texts))), [0]
    lexical_search.search_chunk(tree, chunk, best, spent)
    assert spent[0] < 0.3 * 2000 * len(texts)
    for place, (ids, item_values, _, _) in enumerate(tree.levels[0]):
        query = np.zeros(40, np.int64)
        query[ids] = item_values
        scores = np.array([query[row] @ value for row, value in zip(rows, values, strict=True)])
        expected = sorted((-s, i) for i, s in enumerate(scores.tolist()) if s > 0)[:10]
        assert list(zip((-best.rows[place][1]).tolist(), best.rows[place][0].tolist(), strict=True)) == expected


def test_seeds_are_floors_not_answers(spark, monkeypatch):
    documents, items = list(enumerate(random_texts(8, 300, 20))), list(enumerate(random_texts(9, 10, 8)))
    docs, asked = spark.createDataFrame(documents, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    for share in (1, 2, 1000):
        monkeypatch.setattr(lexical_search, "SEED_SHARE", share)
        assert found_rows(lexical_search.search(docs, asked)) == slow_search(documents, items)


# -- Hard negatives ------------------------------------------------------------------------------------------------------


def slow_mine(rows, every=100, low=80):
    """Brute force over (vec_id, embedding, label) rows that all take part."""
    kept = []
    for vec_id, vector, label in rows:
        moved = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        kept.append((vec_id, moved, [math.floor(256 * x) for x in vector]))
    order = lambda p: (-p[0], p[1] is None, p[1] or 0)
    out = []
    for i, (anchor, label, v) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), other, lab) for j, (other, lab, w) in enumerate(kept) if j != i]
        for score, positive, _ in sorted((p for p in scored if p[2] == label), key=order)[:5]:
            fit = sorted((p for p in scored if p[2] != label and low * score <= 100 * p[0] <= 100 * score), key=order)[:5]
            out += [(anchor, positive, rank, negative, score, got) for rank, (got, negative, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


VECTORS = "vec_id bigint, embedding array<float>, label int"


def mined(df, **options):
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(map(tuple, hard_negatives.mine(df, **options).select(*columns).collect()), key=str)


def random_vectors(seed, n, size, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, size))
    return [(i, [float(np.float32(x)) for x in centres[i % 10] * spread + rng.normal(size=size) * 0.5], int(rng.integers(10))) for i in range(n)]


@pytest.mark.parametrize(("size", "spread", "block"), [(64, 0.3, 1024), (5, 1.0, 1024), (70, 0.0, 4), (1, 1.0, 1024)])
def test_mining_equals_brute_force(spark, monkeypatch, size, spread, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", block)
    monkeypatch.setattr(hard_negatives, "BATCH_ROWS", 97)
    rows = random_vectors(size, 600, size, spread)
    rows += [rows[100], rows[200], rows[3], (100, rows[5][1], 3), (None, rows[6][1], 4), (None, rows[100][1], rows[100][2])]
    df = spark.createDataFrame(rows, VECTORS).withColumns({"score": F.lit("mine"), "key": F.lit(1), "vector": F.lit(2)}).repartition(4)
    assert mined(df, every=20) == slow_mine(rows, every=20)


def test_mining_leaves_out_what_cannot_be_scored(spark):
    rows = random_vectors(3, 300, 8, 0.5)
    nan, inf = float("nan"), float("inf")
    odd = [
        (400, None, 1), (401, [], 1), (500, [nan] + [0.0] * 7, 1), (501, [inf] + [0.0] * 7, 2), (502, [None] + [0.0] * 7, 2), (600, rows[0][1], None),
        (700, [1.0, 2.0], 1), (800, [1e30] * 8, 1),
    ]
    assert mined(spark.createDataFrame(rows + odd, VECTORS)) == slow_mine(rows)
    nothing = spark.createDataFrame([], VECTORS)
    assert mined(nothing) == [] and mined(spark.createDataFrame(odd[:3], VECTORS)) == []
    assert mined(spark.createDataFrame([(0, [1.0], 1)], VECTORS)) == []


def test_ties_go_by_vec_id(spark):
    rows = [(i, [1.0, 0.0], 1 if i < 20 or i % 7 == 6 else 2) for i in range(60)] + [(100, [0.0, 0.0], 3), (101, [0.0, 0.0], 3), (102, [0.0, 1.0], 5)]
    assert mined(spark.createDataFrame(rows, VECTORS).repartition(3)) == slow_mine(rows)


@pytest.mark.parametrize("size", [1, 3, 64, 65, 200])
def test_intervals_hold_every_score(size):
    rng = np.random.default_rng(size)
    rows = np.r_[rng.integers(-300, 300, (200, size)), np.zeros((1, size), int), np.full((1, size), 7)]
    anchors = rows[:40]
    turn = hard_negatives.rotation(size)
    codes, length, alignment = hard_negatives.encode(rows.astype(float), turn)
    low, high = hard_negatives.Anchors(anchors.astype(float), turn).intervals(codes, length, alignment)
    scores = anchors @ rows.T
    assert (low <= scores).all() and (scores <= high).all()
    widest = np.linalg.norm(anchors, axis=1)[:, None] * np.linalg.norm(rows, axis=1)
    if size >= 64:
        assert ((high - low) < 2 * 0.85 * widest + 1e-3).mean() > 0.9


def test_codes_filter_rows_of_tight_groups():
    """Groups whose members lie close together: rows of other groups are never scored."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(10, 64))
    vectors = np.floor(256 * (centres.repeat(50, axis=0) + 0.05 * rng.normal(size=(500, 64)))).astype(np.int64)
    turn = hard_negatives.rotation(64)
    codes, length, alignment = hard_negatives.encode(vectors.astype(float), turn)
    low, high = hard_negatives.Anchors(vectors[:1].astype(float), turn).intervals(codes, length, alignment)
    fifth = np.sort((vectors[:1] @ vectors.T)[0])[-6]
    assert (high[0] >= fifth).sum() < 120
