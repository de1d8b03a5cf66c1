"""The pipeline, stage by stage, against plain versions on the stage's input."""

import re
from collections import Counter

from llm_cases import SF_MID, edge_dir  # noqa: F401
from test_near_dups import by_brute_force
from test_sizes import targets

import corpus_pipeline
from pyspark.sql import functions as F
from cellfold.llm import decontamination as D
from cellfold.session import Stages


def texts(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def test_stages_on_the_given_tables(spark):
    docs, stages, seen = spark.read.parquet(f"{SF_MID}/documents.parquet"), Stages(spark), {}
    columns = docs.columns
    items = [D.normal(r["text"]) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    before = texts(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = stages.save(stage(spark, docs, SF_MID), name)
        if name != "sharding":
            assert docs.columns == columns
        seen[name] = (before, texts(docs))
        before = seen[name][1]
        assert set(before) <= set(seen[name][0])
    old, new = seen["quality"]
    out = {i for i, _, _ in old} - {i for i, _, _ in new}
    assert out and sum(labels.get(i, 0) for i in out) <= 1
    assert sum(labels.get(i) == 0 for i, _, _ in new) <= 2
    old, new = seen["near_duplicates"]
    want = by_brute_force([(i, t) for i, t, _ in old])
    assert sorted(i for i, _, _ in new) == sorted(i for i in want if want[i][1] == i)
    old, new = seen["decontamination"]
    left = {i for i, _, _ in new}
    assert not [i for i, t, _ in new if any(x in D.normal(t) for x in items)]
    finder = D.Finder(list(enumerate(items)))
    assert left == {i for i, t, _ in old if not finder.find(t)}
    old, new = seen["mixing"]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes, got = Counter(), Counter()
    for _, t, s in old:
        sizes[s] += words(t)
    for _, t, s in new:
        got[s] += words(t)
    largest = max(words(t) for _, t, _ in old)
    assert all(abs(got[s] - t) <= largest / 2 + 1 for s, t in targets(sizes).items())
    assert max(Counter(i for i, _, _ in new).values()) <= 3
    old, new = seen["sharding"]
    assert Counter(old) == Counter(new)
    counts = Counter(r["shard"] for r in docs.collect())
    assert len(counts) == 24 and max(counts.values()) - min(counts.values()) <= 1
    stages.release()


def test_awkward_and_empty_tables(spark, edge_dir, tmp_path):  # noqa: F811
    for kind in ("documents", "none/documents"):
        folder = tmp_path / kind.replace("/", "_")
        docs = spark.read.parquet(f"{edge_dir}/{kind}.parquet")
        docs.write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6"), (2, None)], "item_id long, text string").write.parquet(
            str(folder / "benchmark.parquet"))
        got = corpus_pipeline.run(spark, str(folder)).collect()
        # texts with the passage are out, near copies and texts without words too
        assert sorted({r["doc_id"] for r in got if r["doc_id"]}) == ([] if kind != "documents" else [
            i for i in (4, 11, 12, 13, 15, 16, 17, 100) if any(r["doc_id"] == i for r in got)])
        assert bool(got) == (kind == "documents")


def test_stages_keep_columns_of_any_name(spark):
    names = ["target", "taken", "pieces", "__words", "p_source", "source_size", "row", "__piece", "h", "id", "__y", "u", "gone"]
    plain = spark.read.parquet(f"{SF_MID}/documents.parquet").where("doc_id % 5 = 0")
    docs = plain.withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in names})
    with Stages(spark) as stages:
        a, b = plain, docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            a, b = (stages.save(stage(spark, d, SF_MID), name) for d in (a, b))
            assert b.columns == docs.columns
            assert sorted(texts(a), key=str) == sorted(texts(b), key=str)
            assert all(r[n] == f"{n}{r['doc_id']}" for r in b.collect() for n in names)
        last = corpus_pipeline.STAGES[-1][1](spark, b, SF_MID)
        assert set(docs.columns) <= set(last.columns) and last.count() == b.count()
