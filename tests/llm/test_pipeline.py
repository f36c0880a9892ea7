import duckdb
import odd
from test_jaccard import plain_groups
from test_sharding import _expected as plain_shards
from test_sharding import _got as shards_of

import __spark_entry__ as entry
import corpus_pipeline
from matchlake.llm import decontam
from matchlake.llm.oracles import VERDICTS


def test_stages(spark, small):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == columns
        if name != "mixing":
            assert 0 < docs.count() <= rows
            rows = docs.count()


def test_run_against_plain_stages(spark, small, tmp_path):
    """Every stage by itself, beside a plain version of it, on a few hundred rows; then all at once."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    near = [(100_000 + i, text.replace(" ", "  ", 1)) for i, text in rows[:40] if text]
    folder = str(tmp_path)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    copies = spark.createDataFrame(near, "doc_id long, text string")
    docs = docs.unionByName(docs.drop("doc_id", "text").limit(1).crossJoin(copies))
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{small}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    stages = dict(corpus_pipeline.STAGES)

    docs = stages["quality_rules"](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    passed = {r[0] for r in con.execute(f"SELECT doc_id FROM ({VERDICTS}) WHERE kept").fetchall()}
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept) == passed and len(kept) == docs.count()

    docs = stages["near_duplicates"](spark, docs, folder)
    groups = plain_groups(list(kept.items()))
    assert {r.doc_id for r in docs.collect()} == {i if c is None else c for i, _, c in groups}

    before = {r.doc_id: r.text for r in docs.collect()}
    docs = stages["decontamination"](spark, docs, folder)
    items = [decontam._text_terms(r.text).tolist() for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    left = {r.doc_id for r in docs.collect()}
    for i, text in before.items():
        words = decontam._text_terms(text).tolist()
        share = max(decontam.lcs(x, words[k : k + 2 * len(x)]) / len(x) for x in items for k in range(0, max(len(words), 1), 16))
        assert (i in left) if share < decontam.MIN_LCS else (i not in left) if share == 1 else True

    docs = stages["mixing"](spark, docs, folder)
    mixed = [(r.doc_id, r.text) for r in docs.collect()]
    assert {i for i, _ in mixed} <= left
    got = corpus_pipeline.run(spark, folder)
    assert shards_of(got) == plain_shards(mixed, 24)


def test_stages_of_odd_and_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    odd.labels(spark).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, odd.PLAIN), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for make in (odd.docs, odd.no_docs):
        docs = make(spark)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == make(spark).columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= 0


def test_all_operators_are_registered():
    names = {x.split("_")[0] for x in entry.queries() if x.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()
