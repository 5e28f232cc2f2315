"""Token files, scores, packing, BPE by words, URLs, near duplicates and toxicity: edge cases and brute force."""

import base64
import functools
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from isochron.llm import bitplanes, near_dups, packing, pseudo_likelihood, queries, tokens, toxicity, urls, word_shuffle

BYTE_FILE, WORD_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.cache
def library(path):
    return Tokenizer.from_file(path)


def whole(path, text):
    return library(path).encode(text or "", add_special_tokens=False).ids


ODD = st.lists(st.sampled_from(
    list("ab'sé1 \n\t.,#\u00a0\x1c漢İßǰΐﬁẞ\u0301Σσ") + ["don't", "  ", " The", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "\r\n", "BELEDİYESİ,", "GAZETESİ.", "Straße"]
), max_size=12).map("".join)


@pytest.mark.parametrize(("path", "spaces"), [(BYTE_FILE, True), (WORD_FILE, False)])
def test_words_encode_like_whole_texts(path, spaces):
    encoder = tokens.file_encoder(path, spaces)

    @settings(max_examples=150, deadline=None)
    @given(st.lists(ODD, max_size=4))
    def check(texts):
        assert encoder(texts) == [tokens.as_bytes(whole(path, t)) for t in texts]

    check()


def test_encoder_forgets_but_stays_right():
    encoder = tokens.WordEncoder(lambda xs: [x.encode() for x in xs], tokens.cut_before_spaces, kept=6)
    texts = ["a b c", "d, e f g h", "a a a", "  x", "", "e\nf, g h", "a b\nc"]
    assert [encoder([t])[0] for t in texts] == [t.encode() for t in texts] and encoder(texts) == [t.encode() for t in texts]
    assert len(encoder.known) <= 3 + 12


@pytest.mark.parametrize(("path", "spaces"), [(BYTE_FILE, True), (WORD_FILE, False)])
def test_special_tokens_are_those_of_the_library(path, spaces):
    text = "a word <|endoftext|> and more<|endoftext|>"
    special = library(path).token_to_id("<|endoftext|>")
    assert np.frombuffer(tokens.file_encoder(path, spaces)([text])[0], "<u4").tolist().count(special) == 2
    assert special not in np.frombuffer(tokens.file_encoder(path, spaces, specials=False)([text])[0], "<u4").tolist()


@pytest.mark.parametrize(("path", "spaces"), [(BYTE_FILE, True), (WORD_FILE, False)])
def test_given_texts_encode_like_whole_texts(spark, small_dir, path, spaces):
    texts = [r[0] for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("text").collect()]
    encoder = tokens.file_encoder(path, spaces)
    assert encoder(texts) == [tokens.as_bytes(whole(path, t)) for t in texts] == [encoder([t])[0] for t in texts]


@pytest.mark.parametrize("bits", [True, False])
@pytest.mark.parametrize("ids", [[], [0], [2**32 - 1, 0, 7], list(range(70_000))])
def test_planes_round_trip(ids, bits):
    planes = bitplanes.to_planes(np.array(ids, dtype="<u4"), bits)
    assert bitplanes.from_planes(planes, len(ids), bits).tolist() == ids


@pytest.mark.parametrize(("block_ids", "bits"), [(5, True), (64, False)])
def test_token_files_round_trip(spark, edge, tmp_path, block_ids, bits):
    bitplanes.write(edge.filter("doc_id <> 8"), str(tmp_path / "t"), WORD_FILE, 2, False, 3, block_ids=block_ids, bits=bits)
    rows = sorted(bitplanes.read(spark, str(tmp_path / "t")).collect(), key=lambda r: r["start"])
    expected, at = [], 0
    for doc, text in sorted((r["doc_id"], r["text"]) for r in edge.filter("doc_id <> 8").collect()):
        ids = [*whole(WORD_FILE, text), 2]
        expected.append((doc, at, len(ids), tokens.as_bytes(ids)))
        at += len(ids)
    assert [(r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in rows] == expected
    assert bitplanes.index(spark, str(tmp_path / "t")).agg(F.sum("n_ids")).first()[0] == at


def test_damaged_block_is_found(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id bigint, text string")
    bitplanes.write(docs, str(tmp_path / "a"), WORD_FILE, 2, False, 1)
    bitplanes.blocks(spark, str(tmp_path / "a")).withColumn("checksum", F.col("checksum") + 1).write.parquet(str(tmp_path / "b"))
    with pytest.raises(Exception, match="damaged"):
        bitplanes.read(spark, str(tmp_path / "b")).collect()


def test_token_files_of_empty_table(spark, empty, tmp_path):
    bitplanes.write(empty, str(tmp_path / "t"), WORD_FILE, 2, False, 3)
    assert bitplanes.read(spark, str(tmp_path / "t")).count() == 0


# -- Packing -------------------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=12))
def test_plan_holds_every_piece_and_no_more_bins_than_best_fit(counts):
    bins = packing.plan(counts, 64)
    held = Counter()
    for b in bins:
        assert 0 < b.fill <= 64
        held.update({n: b.number * c for n, c in Counter(b.lengths).items()})
    assert held == Counter(counts)
    assert sum(b.number for b in bins) <= sum(b.number for b in packing.best_fit(counts, 64))


def test_search_empties_bins_by_exchanges():
    # 6+3 | 5+4 -> nothing fits 10 exactly; one for one: 6+4, 5+3+...
    search = packing.Search([packing.Bins((6, 3), 2), packing.Bins((5, 4), 2), packing.Bins((2,), 1)], 10)
    before = sum(search.classes.values())
    bins = search.run()
    assert sum(b.number for b in bins) < before and sum(b.fill * b.number for b in bins) == 38


def test_two_for_one_empties_a_bin():
    """7+1+1, 4+4 and 3 in bins of 10: no piece moves and no exchange of one for one fits. 4 and 4 for 7 fills the first bin, and 3 goes to the 7."""
    bins = [(7, 1, 1), (4, 4), (3,)]
    for source, target in itertools.permutations(bins, 2):
        gains = [a - b for a in source for b in (0, *target)]
        assert sum(source) > sum(target) or not any(0 < g <= 10 - sum(target) for g in gains)
    found = packing.Search([packing.Bins(b, 1) for b in bins], 10).run()
    assert sorted(b.lengths for b in found) == [(1, 1, 4, 4), (3, 7)]


def check_packing(rows, expected, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for sequence in by_sequence.values():
        at = 0
        for offset, length in sorted(sequence):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, ids in expected:
        pieces = [(n, s, length, zlib.crc32(tokens.as_bytes(ids[s:s + length]))) for n, (s, length) in enumerate(packing.piece_bounds(len(ids), capacity))]
        assert set(pieces) <= set(by_doc[doc])


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packing_of_edge_cases(edge, empty, capacity):
    pieces = packing.token_pieces(edge, BYTE_FILE, 2, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids").withColumns(
        {c: F.lit("mine") for c in ("offset", "row", "salt", "rank", "place", "_rank", "_place", "_salt")})
    packed = packing.pack(pieces, capacity, salt_rows=3)
    rows = packed.collect()
    assert sorted(packed.columns) == sorted([*pieces.columns, "sequence_id"]) and all(r["_rank"] == r["_place"] == r["rank"] == "mine" for r in rows)
    expected = [(r["doc_id"], [*whole(BYTE_FILE, r["text"]), 2]) for r in edge.collect()]
    assert sum(r["length"] for r in rows) == sum(len(ids) for _, ids in expected)
    check_packing(rows, expected, capacity)
    assert packing.pack(packing.token_pieces(empty, BYTE_FILE, 2, capacity), capacity).count() == 0


# -- Byte-level BPE by words ---------------------------------------------------------------------------------------------


def test_word_shuffle_equals_the_library(spark, edge, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = word_shuffle.encode(edge, RANKS, public_tokenizers.PATTERN, buckets=5, block_chars=400)
    rows = word_shuffle.decode(found, RANKS).collect()
    got = Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in rows)
    want = Counter((r["doc_id"], tokens.as_bytes(reference.encode_ordinary(r["text"] or "")), (r["text"] or "").encode()) for r in edge.collect())
    assert got == want
    assert word_shuffle.encode(empty, RANKS, public_tokenizers.PATTERN, 5).count() == 0


# -- URLs ----------------------------------------------------------------------------------------------------------------


def test_url_parts_rules_and_terms(spark):
    cases = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme casino": ("", "", None, "block"),
        "http://A.Example.ORG/es/x?q#f": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"), "http://example.org": ("example.org", "", None, "allow"),
        "https://casino.example.com/fr/1": ("casino.example.com", "/fr/1", "com/fr/", "allow"),
        "https://notexample.com/de/1": ("notexample.com", "/de/1", "com/de/", "block"),
        "ftp://free.example.net/a": ("free.example.net", "/a", None, "allow"), "ftp://free-bets.example.net/a": ("free-bets.example.net", "/a", None, "block"),
        "ftp://alphabets.freedom.net/free/free": ("alphabets.freedom.net", "/free/free", None, "allow"),
        "https://shop.example.net/win?ref=x": ("shop.example.net", "/win", None, "allow"), "https://e.net/win-a-free-prize": ("e.net", "/win-a-free-prize", None, "block"),
        "https://e.net/a/" + "free" * 5000: ("e.net", "/a/" + "free" * 5000, None, "allow"), "https://e.net/" + "a/" * 5000 + "casino": ("e.net", "/" + "a/" * 5000 + "casino", None, "block"),
        "http://h?u=://evil.org/es/": ("h", "", None, "allow"), "a://b://c/d": ("b:", "//c/d", None, "allow"),
    }
    rows = spark.createDataFrame([(u, "mine") for u in cases], "url string, verdict string")
    found = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(rows).collect()}
    assert found == cases
    assert urls.judge(rows.limit(0)).count() == 0


# -- Near duplicates -----------------------------------------------------------------------------------------------------


def brute_components(rows, width):
    sets = [(doc, near_dups.shingle_set(near_dups.words_of(text), width)) for doc, text in rows if doc is not None]
    label = {doc: doc for doc, _ in sets}
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if near_dups.alike(x, y) and label[a] != label[b]:
            low, high = sorted((label[a], label[b]))
            label = {k: low if v == high else v for k, v in label.items()}
    return label


def make_copies(seed):
    random.seed(seed)
    vocabulary = [f"v{i}" for i in range(500)]
    base = random.choices(vocabulary, k=120)
    rows = []
    for doc in range(90):
        words = list(base)
        for _ in range(random.choice([0, 1, 2, 4, 8])):
            words[random.randrange(len(words))] = random.choice(vocabulary)
        rows.append((doc, " ".join(words)))
    rows += [(100 + k, " ".join(random.choices(vocabulary, k=60) + base[:30])) for k in range(20)]
    return rows


@pytest.mark.parametrize("hub_rounds", [0, 1, 2])
def test_components_equal_brute_force(spark, monkeypatch, hub_rounds):
    rows = make_copies(hub_rounds)
    monkeypatch.setattr(near_dups.linked_components, "__defaults__", (hub_rounds,))
    monkeypatch.setattr(near_dups, "BLOCK_MEMBERS", 20)
    monkeypatch.setattr(near_dups, "BLOCK_SKETCHES", 30)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs).collect()}
    assert found == brute_components(rows, 5)


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 502)], "hub bigint, doc_id bigint")
    found = {r["doc_id"]: r["component"] for r in near_dups.components(links).collect()}
    assert all(found[i] == 0 for i in range(201)) and found[502] == 500


def test_near_duplicate_edge_cases(edge, empty):
    found = [tuple(r) for r in near_dups.near_duplicates(edge, width=4).select("doc_id", "n_shingles", "component_id", "kept").collect()]
    assert len(found) == 12
    by = {r[0]: r for r in found}
    assert by[1] == (1, 0, 1, True) and by[2] == (2, 0, 2, True) and by[3] == (3, 0, 3, True) and by[4] == (4, 1, 4, True)
    assert by[6][2:] == (5, False) and found.count(by[5]) == 2 and by[8][2:] == (7, False) and by[None][2:] == (None, True)
    assert near_dups.near_duplicates(empty).count() == 0


BASE = " ".join(f"a{i}" for i in range(60))
OTHER = " ".join(f"b{i}" for i in range(60))


def test_rows_that_share_an_id_are_told_apart_by_their_words(spark):
    rows = [(3, BASE), (5, BASE), (5, OTHER), (7, OTHER), (9, BASE + " end"), (9, BASE + " end"), (11, OTHER + " x"), (11, "other words for eleven here")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((r["doc_id"], r["component_id"], r["kept"], r["first"]) for r in near_dups.near_duplicates(docs).collect())
    assert found == [
        (3, 3, True, True), (5, 3, False, False), (5, 5, True, True), (7, 5, False, False), (9, 3, False, False), (9, 3, False, False),
        (11, 5, False, False), (11, 11, True, True),
    ]


def test_unlike_texts_of_one_component_that_share_its_smallest_id(spark):
    rows = [(5, BASE), (5, BASE + " end"), (5, BASE), (8, BASE + " end more")]
    found = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["component_id"] for r in found} == {5}
    assert len({r["digest"] for r in found if r["first"]}) == 1 and not any(r["first"] for r in found if r["doc_id"] == 8)


def test_a_row_repeated_many_times_is_one_member(spark):
    rows = [(1, BASE)] * 3000 + [(i, BASE + f" {i}") for i in range(2, 40)]
    found = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    assert len(found) == 3038 and {r["component_id"] for r in found} == {1}


def test_pairs_at_the_threshold_agree_in_enough_coordinates():
    """The estimate that spares texts the way leaves out no pair that is alike."""
    draws, length, least = np.random.default_rng(2), near_dups.BANDS * near_dups.ROWS, 1.0
    for size in (9, 90, 900):
        for _ in range(150):
            both, rest = draws.integers(0, 2**63, 8 * size // 9, dtype=np.uint64), draws.integers(0, 2**63, 2 * (size // 9), dtype=np.uint64)
            a, b = np.r_[both, rest[::2]], np.r_[both, rest[1::2]]
            share = near_dups.agreeing(*[[near_dups.signature(np.unique(x), length).astype(np.uint8).tobytes()] for x in (a, b)])
            least = min(least, share[0])
    assert least > near_dups.LEAST_AGREEING


def test_sketches_pick_members_near_another_component():
    draws = np.random.default_rng(3)
    base, far = draws.integers(0, 256, 200, dtype=np.uint8), draws.integers(0, 256, 200, dtype=np.uint8)
    close = base.copy()
    close[:40] += 1
    sketches = [x.tobytes() for x in (base, base, close, far)]
    assert near_dups.near_members([1, 1, 2, 3], [0] * 4, sketches).tolist() == [True, True, True, False]
    assert near_dups.near_members([1, 1, 2, 3], [0, 1, 1, 0], sketches).tolist() == [True, False, True, False]
    assert not near_dups.near_members([1, 1, 1, 3], [0] * 4, sketches).any()


def test_signature_agreement_follows_similarity():
    a = near_dups.shingle_hashes([b"%d" % i for i in range(600)], 5)
    b = near_dups.shingle_hashes([b"%d" % i for i in range(200, 800)], 5)
    agree = (near_dups.signature(a, 512) == near_dups.signature(b, 512)).mean()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(agree - true) < 0.1


# -- Toxicity ------------------------------------------------------------------------------------------------------------


GRAMMAR = toxicity.Grammar({"idiot$": 5.0, "scum": 3.0})


def marked(text):
    return [name for _, name in toxicity.matches([kind for kind, _ in GRAMMAR.symbols(text)])]


def test_grammar_marks_clauses():
    assert marked("a mere idiot") == ["plain"] and marked("you scummy idiot") == ["aimed", "aimed"]
    assert marked("he is not an idiot") == ["negated"] and marked('the word "idiot"') == ["reported"]
    assert marked("we kill time") == [] and marked("i will kill you") == ["aimed"] and marked("not today but later an idiot") == ["plain"]
    assert GRAMMAR.document(None) == GRAMMAR.document("") == GRAMMAR.document("nothing here.") == [0.0] * toxicity.FEATURES


def test_reports_and_quotations_hold_over_clause_ends():
    assert marked("She said: an idiot. An idiot") == ["reported", "plain"] and marked("She said:\nan idiot\nan idiot") == ["reported", "plain"]
    assert marked("An idiot, he wrote. An idiot wrote") == ["reported", "plain"] and marked("idiot he wrote") == ["aimed"]
    assert marked('"It is late. What an idiot. Go now", an idiot') == ["reported", "plain"] and marked('"open\nidiot') == ["plain"]
    assert marked("idiot: scummy, as is known to have said") == ["plain", "plain"] and marked("an idiot, they say") == ["reported"]


def by_definition(kinds):
    """The marks of every match from the rules of the module's docstring, looked up position by position."""
    t = toxicity
    out = []
    for i, kind in enumerate(kinds):
        if kind not in t.MATCHES:
            continue
        line = max([j for j in range(i) if kinds[j] == t.LINE], default=-1)
        quoted = sum(kinds[j] == t.QUOTE for j in range(line + 1, i)) % 2 == 1

        def holds(j):  # the report opened at j still holds at i
            for k in range(j + 1, i):
                if kinds[k] == t.END or (kinds[k] == t.LINE and kinds[k - 1] != t.COLON):
                    return False
            return True

        before = any(kinds[j] == t.REPORT and holds(j) for j in range(i))
        behind = False
        for j in range(i + 1, len(kinds)):
            if kinds[j] in (t.END, t.LINE):
                break
            if kinds[j] in (t.COMMA, t.QUOTE):
                words = 0
                for k in range(j + 1, len(kinds)):
                    if kinds[k] in (t.END, t.LINE):
                        break
                    if kinds[k] == t.REPORT:
                        behind |= words < t.REPORT_REACH
                        break
                    words += kinds[k] in t.WORD_KINDS
        def near(wanted, places, words):
            passed = 0
            for j in places:
                if kinds[j] in (t.END, t.LINE, t.COLON):
                    return False
                if kinds[j] == wanted:
                    return passed < words
                passed += kinds[j] in t.WORD_KINDS
            return False

        negated = near(t.NEGATION, range(i - 1, -1, -1), t.NEGATION_REACH)
        aimed = near(t.TARGET, range(i - 1, -1, -1), t.TARGET_REACH) or near(t.TARGET, range(i + 1, len(kinds)), t.TARGET_REACH)
        name = "negated" if negated else "reported" if quoted or before or behind else "aimed" if aimed else "plain"
        if kind == t.INSULT or name == "aimed":
            out.append((i, name))
    return out


def test_transducers_equal_their_definition():
    for n in range(5):
        for kinds in itertools.product(range(toxicity.ALL_KINDS), repeat=n):
            assert toxicity.matches(list(kinds)) == by_definition(kinds)
    draws = random.Random(9)
    for _ in range(4000):
        kinds = [draws.randrange(toxicity.ALL_KINDS) for _ in range(draws.randrange(5, 25))]
        assert toxicity.matches(kinds) == by_definition(kinds)


def test_composition_equals_one_after_the_other():
    draws, a, b = random.Random(2), toxicity.reporting(), toxicity.reach(toxicity.TARGET, 3, toxicity.AIMED)
    for _ in range(300):
        kinds = [draws.randrange(toxicity.ALL_KINDS) for _ in range(12)]
        assert a.then(b).marks(kinds) == [x | y for x, y in zip(a.marks(kinds), b.marks(kinds), strict=True)]


def labelled(spark, n=400):
    random.seed(3)
    vocabulary = [f"word{i}" for i in range(300)]
    rows = []
    for doc in range(n):
        words = random.choices(vocabulary, k=60)
        if toxic := doc % 4 == 0:
            for _ in range(5):
                words[random.randrange(60)] = random.choice(["nasty", "vile", "grubby"]) + random.choice(["", "ling", "ness"])
        rows.append((doc, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")


def test_learnt_scores_hold_out(spark, edge, empty):
    docs = labelled(spark)
    model = toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    rows = toxicity.score(docs, model).join(docs, "doc_id").filter(toxicity.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 80 and sum((r["score"] >= 0.7) == bool(r["toxic"]) for r in rows) >= 0.95 * len(rows)
    odd = toxicity.score(edge, model).collect()
    assert len(odd) == 12 and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score(empty, model).count() == 0
    column = {r[0]: r[1] for r in docs.select("doc_id", toxicity.score_column(F.col("text"), model)).collect()}
    assert all(abs(column[r["doc_id"]] - r["score"]) < 1e-12 for r in rows)


def test_training_without_one_class(spark, empty):
    docs = labelled(spark, 40).withColumn("toxic", F.lit(0))
    model = toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} != set() and not model.lexicon
    assert toxicity.train(empty, docs.select("doc_id", "toxic").limit(0)).beta[0] == pytest.approx(0.0, abs=1)


# -- Pseudo-likelihood ---------------------------------------------------------------------------------------------------


def test_gradient_equals_differences():
    draws = np.random.default_rng(1)
    for size, span in ((5, 1), (20, 2), (37, 3)):
        network = pseudo_likelihood.Network.start(size, 3, span=span)
        contexts, gaps = draws.integers(0, size, (40, 2 * span)).astype(np.uint8), draws.integers(0, size, 40).astype(np.uint8)
        total, gradient = network.gradient(contexts, gaps)
        assert total == pytest.approx(network.log_probabilities(contexts, gaps).sum())
        flat = network.flat()
        assert len(flat) == len(gradient)
        for k in range(0, len(flat), 7):
            up, down = flat.copy(), flat.copy()
            up[k] += 1e-5
            down[k] -= 1e-5
            slope = (network.like(up).gradient(contexts, gaps)[0] - network.like(down).gradient(contexts, gaps)[0]) / 2e-5
            assert slope == pytest.approx(gradient[k], abs=1e-5)


def test_probabilities_of_all_classes_sum_to_one():
    network = pseudo_likelihood.Network.start(37, 4, span=2)
    contexts = np.tile(np.array([[1, 2, 30, 36]], np.uint8), (37, 1))
    assert np.exp(network.log_probabilities(contexts, np.arange(37, dtype=np.uint8))).sum() == pytest.approx(1.0)


def test_windows_end_at_borders():
    found = pseudo_likelihood.masked_windows(np.array([5, 6, 7, 8, 9], np.uint8), np.array([3, 0, 2]), 2)
    assert found.tolist() == [[0, 6, 0, 7], [5, 7, 0, 0], [6, 0, 5, 0], [0, 9, 0, 0], [8, 0, 0, 0]]


def scores_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_every_word_of_the_corpus_is_predicted(spark, monkeypatch):
    """Scores are those of all words, from two words on either side; words of one class differ by how often they were counted."""
    monkeypatch.setattr(pseudo_likelihood, "BLOCK_TOKENS", 50)
    monkeypatch.setattr(pseudo_likelihood, "BUCKET_WORDS", 40)
    texts = [f"the cat and the dog saw common{i % 2} tail{i} near The house." for i in range(40)] + [None, "", "the rare0 cat", "the common0 cat"]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    blocks, totals, model = pseudo_likelihood.fit_corpus(documents, words=3, endings=5, hidden=4, steps=3, span=2)
    found = scores_of(pseudo_likelihood.score_corpus(blocks, totals, model))
    assert len(found) == len(texts) and blocks.count() > 5 and model.buckets > 3
    counted = Counter(w for t in texts for w in (t or "").lower().split())
    assert model.classes.words[0] == "the" and len(counted) > 40
    number = dict(zip(counted, model.classes.of(list(counted)).tolist(), strict=True))
    of_class = Counter()
    for w, n in counted.items():
        of_class[number[w]] += n
    assert model.class_totals.tolist() == [of_class[c] for c in range(model.classes.size)]
    network, group = model.network, pseudo_likelihood.GROUP
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    for doc, text in enumerate(texts):
        words = (text or "").lower().split()
        c, total = [0, 0, *[number[w] for w in words], 0, 0], 0.0
        for i, w in enumerate(words):
            around = (c[i + 1], c[i + 3], c[i], c[i + 4])
            hidden = np.tanh(sum(network.tables[k][x] for k, x in enumerate(around)) + network.bias)
            g, member = divmod(number[w], group)
            p = softmax(hidden @ network.group_out + network.group_bias)[g] * softmax(hidden @ network.out[g] + network.out_bias[g])[member]
            total += np.log(p) + np.log(counted[w] / of_class[number[w]])
        assert found[doc]["n_tokens"] == len(words) and found[doc]["log_likelihood"] == pytest.approx(total, abs=1e-4)
    assert found[40]["mean_log_likelihood"] is None and found[41]["log_likelihood"] == 0


def test_words_of_one_ending_share_a_class():
    classes = pseudo_likelihood.Classes(("the",), 50)
    found = classes.of(["the", "nation,", "station", "nation", "x", "x.", ""])
    assert found[0] == 1 and len(set(found[1:4])) == 1 and found[4] == found[5] and found.max() < classes.size


def test_scores_do_not_depend_on_how_the_table_lies(spark, small_dir):
    documents = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    first, second = (scores_of(pseudo_likelihood.pseudo_likelihood(documents.repartition(n, "doc_id"), steps=4)) for n in (2, 7))
    assert len(first) == documents.count()
    for doc, row in first.items():
        assert row["log_likelihood"] == pytest.approx(second[doc]["log_likelihood"], rel=1e-6)


def test_order_is_learnt(spark):
    rows = [(i, "a b c d e f " * 20) for i in range(60)] + [(100, "a b c d e f a b c"), (101, "f c a e b d d a c")]
    found = scores_of(pseudo_likelihood.pseudo_likelihood(spark.createDataFrame(rows, "doc_id bigint, text string"), words=8, endings=3))
    assert found[100]["mean_log_likelihood"] > found[101]["mean_log_likelihood"] + 1


def test_network_beats_word_counts(spark):
    """Per token, over the counts of words alone."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = pseudo_likelihood.pseudo_likelihood(documents).collect()
    counted = Counter(w for r in documents.collect() for w in (r["text"] or "").lower().split())
    total = sum(counted.values())
    alone = sum(n * np.log(n / total) for n in counted.values()) / total
    assert sum(r["n_tokens"] for r in rows) == total
    assert sum(r["log_likelihood"] for r in rows) / total > alone + 0.5


def test_pseudo_likelihood_edge_cases(edge, empty):
    rows = pseudo_likelihood.pseudo_likelihood(edge, words=5, steps=2).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 12 and [by[i]["n_tokens"] for i in (1, 2, 3, 4, 7, 8)] == [0, 0, 0, 1, 30_000, 30_001] and by[None]["n_tokens"] == 14
    twice = [tuple(r) for r in rows if r["doc_id"] == 5]
    assert len(twice) == 2 and twice[0] == pytest.approx(twice[1], rel=1e-6) and by[7]["mean_log_likelihood"] < 0
    assert pseudo_likelihood.pseudo_likelihood(empty, words=5, steps=2).count() == 0


def test_queries_without_sql_return_every_document(spark, small_dir):
    total = spark.read.parquet(f"{small_dir}/documents.parquet").count()
    for name in ("op1_sharding", "op3_pseudo_likelihood"):
        assert queries.QUERIES[name](spark, small_dir).count() == total


def test_copies_of_a_bucket_stay_in_proportion(spark):
    rows = [(0, k, 0 if k >= 30 else k) for k in range(1000)] + [(1, k, k % 2) for k in range(40)]
    live = spark.createDataFrame(rows, "band bigint, doc_id bigint, component bigint").withColumn("n_shingles", F.lit(10))
    dealt = [tuple(r) for r in near_dups.deal_members(live, F.lit(1), 50).collect()]
    # 29 members outside the largest component and 971 in it, in 20 blocks; the square of the bucket would be 20,000 rows.
    assert sum(r[0] == 0 for r in dealt) <= 3 * 1000 and sum(r[0] == 1 for r in dealt) == 40
    label, groups = {(b, k): c for b, k, c in rows}, {}
    for band, low, high, doc, _, _ in dealt:
        groups.setdefault((band, low, high), set()).add(doc)
    met = {(g[0], a, b) for g, docs in groups.items() for a in docs if label[g[0], a] != 0 for b in docs}
    for band, n in ((0, 1000), (1, 40)):
        assert all((band, a, b) in met for a in range(n) if label[band, a] != 0 for b in range(n) if label[band, a] != label[band, b])


def test_reading_planes_shuffles_no_whole_documents(spark, tmp_path):
    docs = spark.createDataFrame([(k, "some words here") for k in range(50)], "doc_id bigint, text string")
    bitplanes.write(docs, str(tmp_path / "planes"), public_tokenizers.path("word_bpe_49k.json"), 2, False, 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where Spark does not know beforehand that the parts are few
    try:
        found = bitplanes.read(spark, str(tmp_path / "planes"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and found.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
