"""Quality (8) and decontamination (5)."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import SF_MID, docs_of, edge_dir, rows  # noqa: F401
from pyspark.sql import functions as F

from cellfold.llm import decontamination as D
from cellfold.llm import quality as Q
from cellfold.llm import tokens


# ------------------------------------------------------------------ quality

def test_scores_and_held_out_accuracy(spark, rows):  # noqa: F811
    got = rows("op8", SF_MID)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    assert len(got) == 1000
    right = total = 0
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        if r["held_out"] and r["doc_id"] in labels:
            total += 1
            right += r["predicted"] == labels[r["doc_id"]]
    assert total > 80 and right / total > 0.95
    assert sorted(map(str, rows("op8", SF_MID))) == sorted(map(str, got))


def test_edge_texts_and_missing_labels(spark, edge_dir):  # noqa: F811
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet").withColumn("Score", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(2, 1), (4, 1), (None, 0), (5, None), (7, 3)], "doc_id long, quality int")
    for labels, want in ((none, {0.5}), (one, {1.0})):
        forest = Q.train(docs, labels, usable=F.lit(True))
        out = Q.score(docs, forest)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
        assert {round(r["score"], 6) for r in out.collect()} == want and out.count() == docs.count()
    assert Q.score(docs.limit(0), forest).count() == 0


def test_no_more_rows_are_fitted_than_the_bound(spark, monkeypatch):
    docs = spark.range(50).selectExpr("id % 3 as doc_id", "concat('text number ', id) as text")
    same = spark.range(50).selectExpr("id % 3 as doc_id", "'one text' as text")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (2, 1)], "doc_id long, quality int")
    fitted, fit = [], Q.fit
    monkeypatch.setattr(Q, "fit", lambda x, y: fitted.append(len(x)) or fit(x, y))
    for frame, sample in ((docs, 2), (docs, 20), (same, 20)):
        Q.train(frame, labels, usable=F.lit(True), sample=sample)
    assert fitted == [2, fitted[1], 3] and 3 <= fitted[1] <= 20


def test_trees_fit_a_known_rule():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > -0.2)).astype(float)
    forest = Q.fit(x[:2000], y[:2000])
    assert ((forest.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.97

    def walk(row):  # one row, node by node
        odds = forest.prior
        for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
            odds += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-odds))
    assert np.allclose(forest.score(x[:50]), [walk(r) for r in x[:50]])


def test_statistics_do_not_depend_on_chunks(monkeypatch):
    texts = ["", None, "One two two\nOne two two\n\nthree!", "é ü", "|a| |b|"] * 40 + ["z " * 5000]
    a = Q.statistics(pa.array(texts))
    monkeypatch.setattr(tokens, "CHUNK", 16)
    assert np.array_equal(a, Q.statistics(pa.array(texts)))
    names = dict(zip(Q.FEATURES, a[2]))
    assert names["distinct_words"] == 3 / 7 and names["top_word"] == 4 / 7 and names["distinct_lines"] == 2 / 3


# ------------------------------------------------------------------ decontamination

def substring_distance(item, text):
    """Least edit distance of the item to any substring."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        last, row[0] = row[0], 0
        for i, p in enumerate(item, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (p != c))
        best = min(best, row[-1])
    return best


def edited(rng, text, n):
    for _ in range(n):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1:], text[:i] + "q" + text[i:], text[:i] + "z" + text[i + 1:]])
    return text


def test_finds_every_occurrence_within_the_budget(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeinrst") for _ in range(rng.randrange(2, 8)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 3, 6, 8, 12, 20, 20])]
    items += [(90, ""), (91, None), (6, items[6][1]), (92, " \n")]
    docs = [(-1, None), (-2, ""), (-3, "x" * 50_000)]
    for d in range(140):
        i = rng.randrange(7)
        t = items[i][1]
        mid = edited(rng, t, rng.randrange(0, D.budget(len(t)) + 4)) if len(t) > 30 else t
        docs.append((d, " ".join(word() for _ in range(rng.randrange(30))) + "\n\t" + mid.upper().replace(" ", "  ") + " "
                     + " ".join(word() for _ in range(10))))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, t in docs:
        for i, item in items:
            item = D.normal(item or "")
            # an item of 26 characters or less must occur exactly
            if item and t and (dist := substring_distance(item, D.normal(t))) <= D.budget(len(item)):
                want[d, i] = dist
    got = D.find_items(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"]): r["edits"] for r in got} == want and len(got) == len(want)
    assert 20 < sum(v > 0 for v in want.values())
    texts, names = dict(docs), dict(items)
    for r in got:
        part = D.normal(texts[r["doc_id"]])[r["start_char"]:r["end_char"]]
        assert D._anchored(D.normal(names[r["item_id"]]), part)[-1] == r["edits"]
    blocks = D.find_items(frame, bench, block_chars=60)
    assert sorted(map(str, blocks.collect())) == sorted(map(str, got))
    kept = D.drop_contaminated(frame.withColumn("Item_ID", F.lit(1)), bench, block_chars=60)
    assert kept.columns == ["doc_id", "text", "Item_ID"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _ in docs if d not in {k[0] for k in want})


def test_no_items_and_no_documents(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.find_items(frame, none).count() == 0 and D.drop_contaminated(frame, none).count() == 1
    assert D.find_items(frame.limit(0), none.union(frame)).count() == 0


def test_registered_query_finds_the_planted_passages(spark, rows):  # noqa: F811
    got = {(r["doc_id"], r["item_id"]) for r in rows("op5", SF_MID)}
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    items = [(r["item_id"], D.normal(r["text"])) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    exact = {(r["doc_id"], i) for r in docs.collect() for i, t in items if t in D.normal(r["text"])}
    assert exact and exact <= got and len(got) < 2 * len(exact)


@pytest.mark.parametrize("pattern", ["a", "ab" * 40, "é\U0001F600x"])
def test_myers_equals_dynamic_programming(pattern):
    rng = random.Random(4)
    text = "".join(rng.choice("abé\U0001F600x") for _ in range(300))
    row, want = list(range(len(pattern) + 1)), []
    for c in text:
        last, row[0] = row[0], 0
        for i, p in enumerate(pattern, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (p != c))
        want.append(row[-1])
    assert list(D.edit_matches(D.masks_of(pattern), len(pattern), text)) == want
