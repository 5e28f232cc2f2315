"""The pipeline's stages against brute force, and the queries that have SQL."""

import pytest
from check_oracles import canonical, connect
from pyspark.sql import functions as F

import corpus_pipeline
from isochron.llm import near_dups, quality, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, small_dir, name):
    df = queries.QUERIES[name](spark, small_dir)
    cursor = connect(small_dir).execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cursor.fetchall(), names)


@pytest.fixture(scope="module")
def table_dir(spark, edge, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = edge.unionByName(spark.createDataFrame(
        [(50, "the nasty one and the other of all that is to be said in the end today"), (51, "THE LOUD " * 8)], "doc_id bigint, text string"
    ), allowMissingColumns=True)
    rows.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(50, 1), (7, 0), (None, 1), (5, None)], "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_keep_columns_and_edge_cases(spark, table_dir):
    rows = spark.read.parquet(f"{table_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, rows, table_dir)
        assert kept.columns == rows.columns and stage(spark, rows.limit(0), table_dir).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, rows.limit(0), table_dir).count() == 0
    once = corpus_pipeline.near_duplicate_stage(spark, rows, table_dir)
    ids = [r["doc_id"] for r in once.collect()]
    assert ids.count(5) == 1 and 6 not in ids and 8 not in ids and None in ids and {1, 2, 3, 7} <= set(ids)
    judged = {r["doc_id"]: r["kept"] for r in quality.judge(rows.select("doc_id", "text")).select("doc_id", "kept").collect()}
    good = [r["doc_id"] for r in corpus_pipeline.quality_stage(spark, rows, table_dir).collect()]
    assert set(good) == {doc for doc, kept in judged.items() if kept} and not {1, 2, 3, 4, 51} & set(good)


def test_near_duplicate_stage_keeps_one_row_of_each_component(spark):
    base, other = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(3, base, "x"), (5, base, "x"), (5, other, "x"), (7, other, "x"), (9, "alone " * 9, "x"), (9, "alone " * 9, "x"), (9, base + " end", "y"), (None, base, "z"), (4, None, "n"), (6, " ", "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _digest string")
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [(3, base, "x"), (5, other, "x"), (9, "alone " * 9, "x"), (None, base, "z"), (4, None, "n"), (6, " ", "n")], key=str)
    alike = spark.createDataFrame([(5, base), (5, base + " end"), (8, base + " more")], "doc_id bigint, text string")
    assert [r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, alike, "").collect()] == [5]


def test_run_equals_stages_by_hand(spark, small_dir):
    result = corpus_pipeline.run(spark, small_dir).collect()
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    good = corpus_pipeline.quality_stage(spark, docs, small_dir)
    clean = corpus_pipeline.toxicity_stage(spark, good, small_dir).select("doc_id", "text").collect()
    sets = sorted((r["doc_id"], near_dups.shingle_set(near_dups.words_of(r["text"]), 5)) for r in clean)
    label = {doc: doc for doc, _ in sets}
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1:]:
            if near_dups.alike(x, y) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    assert {r["doc_id"] for r in result} == {doc for doc, root in label.items() if doc == root}
    per_sequence = {}
    for r in result:
        per_sequence[r["sequence_id"]] = per_sequence.get(r["sequence_id"], 0) + r["length"]
    assert max(per_sequence.values()) <= corpus_pipeline.SEQUENCE_TOKENS


def test_quality_stage_agrees_with_the_query(spark, small_dir):
    kept = {r["doc_id"] for r in queries.QUERIES["op6_quality_rules"](spark, small_dir).filter("kept").collect()}
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    assert {r["doc_id"] for r in corpus_pipeline.quality_stage(spark, docs, small_dir).select(F.col("doc_id")).collect()} == kept
