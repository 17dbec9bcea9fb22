"""The pipeline's stages on the smallest tables, each held against its operator's own answer."""

import corpus_pipeline
from cartospark.llm import compression_classifier, queries
from cartospark.llm.shared import written

DATA = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = written(stage(spark, before, DATA), "test")
        sizes.append(docs.count())
        if k < 4:
            assert docs.columns == columns, name
        if name == "n-gram Jaccard join":
            found = {r["doc_id"] for r in docs.collect()}
            parts = {r["component_id"] for r in queries.ngram_join(before).collect()}
            assert found == parts
        if name == "quality classifier":
            model = compression_classifier.fit(before, spark.read.parquet(f"{DATA}/labels.parquet"))
            keep = {r["doc_id"] for r in compression_classifier.scored(before, model).collect() if r["score"] >= 0.3}
            assert keep == {r["doc_id"] for r in docs.collect()}
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] and sizes[4] == sizes[5]
    assert {"shard", "slot", *columns} <= set(docs.columns)
    slots = [(r["shard"], r["slot"]) for r in docs.collect()]
    assert len(set(slots)) == len(slots)


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, DATA), "test")
    assert docs.count() == 0


def test_stages_with_nulls_repeated_ids_and_clashing_columns(spark, tmp_path):
    """Rows with nulls in any column, ids and rows that repeat, an empty and a long text, and columns named like results."""
    text = " ".join(f"word{k % 90} of a plain sentence" for k in range(200))
    passage = spark.read.parquet(f"{DATA}/benchmark.parquet").filter("length(text) > 80").orderBy("item_id").first()["text"]
    rows = [(k, f"{text} {k} {k * k}", "en", f"s{k % 3}", 5) for k in range(30)]
    rows += [(7, None, "en", "s1", None), (8, rows[8][1], "en", "s2", 5), (8, rows[8][1], "en", "s2", 5), (None, "no id here", None, None, None), (40, None, None, None, None), (41, "", "xx", "s9", 0)]
    rows += [(50, "long " * 60_000, "de", "s0", 1), (60, f"before it {passage} after it", "en", "s1", 1), (None, None, None, None, None)]
    extra = {c: 1 for c in ("copies", "component_id", "size", "shard", "_mix0", "begins", "score")}
    docs = spark.createDataFrame([(*r, *extra.values()) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in extra))
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        docs = written(stage(spark, docs, DATA), "test")
        if k < 4:
            assert docs.columns == columns, name
        seen[name] = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {d for d, _ in seen["n-gram Jaccard join"]} <= {d for d, _ in seen["quality classifier"]}
    joined = [d for d, _ in seen["n-gram Jaccard join"] if d is not None]
    assert len(joined) == len(set(joined))  # one row of an id, and never the null text of one that has another
    assert (7, None) not in seen["n-gram Jaccard join"]
    assert not any(passage in (t or "") for _, t in seen["benchmark decontamination"])
    places = [(r["shard"], r["slot"]) for r in docs.collect()]
    assert len(set(places)) == len(places) == len(seen["mixing sources to target weights"])
