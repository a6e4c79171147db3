from __future__ import annotations

from pathlib import Path

import corpus_pipeline
import duckdb
from brute import AWKWARD, SF, SHARED, base_spans, components, repeated_exactly, simhash

from eventstrata.llm import quality_trees, queries, registry
from eventstrata.session import scratch_path, stage


def test_every_stage_takes_effect(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = {r["doc_id"]: r["score"] for r in quality_trees.score_documents(documents, labels).collect()}
    docs, kept = documents, {}
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, SF), scratch_path(spark, name))
        if name != "packing":
            assert docs.columns == documents.columns
            kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = kept["quality_classifier"]
    assert len(set(good) ^ {d for d, s in scores.items() if s >= 0.7}) <= 0.01 * len(scores)
    ids = sorted(good)
    classes = components([simhash(good[d], 3) for d in ids], 3)
    first = {}
    for d, c in zip(ids, classes):
        first.setdefault(c, d)
    assert set(kept["simhash_near_dedup"]) == set(first.values())
    assert not repeated_exactly(kept["substring_dedup"], 50)
    assert all(base_spans(t) == "" for t in kept["secret_scans"].values())
    assert {r["doc_id"] for r in docs.collect()} == set(kept["secret_scans"])


def folder(spark, tmp_path, rows):
    """Tables as the pipeline reads them, from (doc_id, text)."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    made = [(d, t, "en", "web", None if t is None else len(t)) for d, t in rows]
    spark.createDataFrame(made, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").where("false").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_awkward_rows_through_all_stages(spark, tmp_path):
    """Repeated ids with other texts keep their words; keys go; nothing crashes."""
    key = "\n".join(["-----BEGIN RSA PRIVATE KEY-----", *["aB3/" * 16] * 500])
    clean = " ".join(f"clean{i}" for i in range(90))
    rows = [(r[0], r[1]) for r in AWKWARD] + [(20, SHARED + " own end"), (21, "a frame " + SHARED), (21, clean), (22, key + "\nlast")]
    sf_dir = folder(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in corpus_pipeline.STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), scratch_path(spark, name))
    texts = [r["text"] for r in docs.collect()]
    assert clean in texts and not any("aB3/" in (t or "") for t in texts)
    assert sum("word3 word4" in (t or "") for t in texts) <= 2  # the first one's, and that of the row without an id
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert sum(r["doc_id"] == 21 for r in pieces) >= 1


def test_empty_table_through_all_stages(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, [])).collect() == []


def test_registered_queries_run_and_match_their_sql(spark):
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.REGISTRY}
    for name, sql in registry.EXPECTED.items():
        rows = registry.REGISTRY[name](spark, SF)
        expected = con.execute(sql)
        columns = sorted(d[0] for d in expected.description)
        order = [[d[0] for d in expected.description].index(c) for c in columns]
        want = sorted(tuple(r[i] for i in order) for r in expected.fetchall())
        assert sorted(tuple(r) for r in rows.select(*columns).collect()) == want
