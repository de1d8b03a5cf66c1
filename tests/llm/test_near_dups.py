"""Near-duplicates (1) and connected components against plain Python."""

import random
import re

import pyarrow as pa
import pytest
from llm_cases import SF_MID, docs_of, edge_dir, rows  # noqa: F401
from pyspark.sql import functions as F

from cellfold.llm import near_dups as N
from cellfold.llm import tokens
from cellfold.llm.components import components
from cellfold.session import Stages


def shingles(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def by_brute_force(docs):
    """{id: (set size, component)} with every pair compared."""
    sets = {i: shingles(t) for i, t in docs}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and root(a) != root(b) and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    ra, rb = root(a), root(b)
                    up[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus():
    """Chains, a large group of near copies, thresholds met exactly, short texts."""
    rng = random.Random(6)
    word = lambda: "w" + str(rng.randrange(4000))
    texts = []
    for _ in range(12):  # chains: every text differs a little from the one before
        w = [word() for _ in range(rng.randrange(40, 200))]
        for _ in range(6):
            texts.append(" ".join(w))
            for _ in range(max(1, len(w) // 40)):
                w[rng.randrange(len(w))] = word()
    base = [word() for _ in range(150)]
    for _ in range(60):  # copies of one text, one to three words changed
        w = list(base)
        for _ in range(rng.randrange(1, 4)):
            w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    shared = " ".join(word() for _ in range(60))
    texts += [shared + " " + " ".join(word() for _ in range(rng.randrange(20, 60))) for _ in range(50)]  # similar, mostly not near
    line = [f"e{i}" for i in range(204)]  # 200 shingles; the last k cut: similarity (200 - k) / 200
    texts += [" ".join(line), " ".join(line[:-50]), " ".join(line[:-51] + ["x"]).replace("e0 ", "f0 "), " ".join(line[:-51])]
    texts += ["", None, " \n", "a", "A", "a b", "b a", "a b c d", "a b c d e", "a b c d e f", "a\tb  C d"] + [" ".join(line).upper()] * 3
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [(i * 3 + 5, texts[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("small", [16, 3])
def test_components_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(N, "SMALL", small)
    monkeypatch.setattr(N, "CELL", 2 * small)
    docs = corpus()
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, N long")
    with Stages(spark) as stages:
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(frame, stages).collect()}
        kept = N.keep_first(frame, stages)
        assert kept.columns == ["doc_id", "text", "N"]
        assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in got.items() if i == c}
    assert got == by_brute_force(docs)


@pytest.mark.parametrize("which", ["edge", SF_MID])
def test_op1_contract(which, edge_dir, rows, docs_of):  # noqa: F811
    folder = edge_dir if which == "edge" else which
    docs, got = docs_of(folder), rows("op1", folder)
    want = by_brute_force([(r["doc_id"], r["text"]) for r in docs if r["doc_id"] is not None])
    assert len(got) == len(docs)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_nothing_to_compare(edge_dir, rows):  # noqa: F811
    assert rows("op1", edge_dir + "/none") == []


def test_sketches(monkeypatch):
    rng = random.Random(8)
    texts = ["", None, "one", "x " * 3000]
    for k in [*range(12), *range(20, 400, 10)]:
        w = [f"v{i}" for i in range(400)]
        for i in rng.sample(range(400), k):
            w[i] = f"z{i}"
        texts.append(" ".join(w))
    a = N.sketch(pa.array(texts))
    assert a["n"].tolist()[:4] == [0, 0, 1, 1]
    monkeypatch.setattr(tokens, "CHUNK", 64)
    b = N.sketch(pa.array(texts))
    assert all((a[k] == b[k]).all() for k in a)
    sets = [shingles(t) for t in texts]
    pairs = 0
    for i in range(4, len(texts)):
        x, y = sets[4], sets[i]
        near = len(x & y) / len(x | y)
        z = sum(bin((int(p) ^ int(q)) & (2 ** 64 - 1)).count("1") for p, q in zip(a["odd"][4], a["odd"][i]))
        if near >= 0.75:
            pairs += 1
            assert z <= N.most_bits() and abs(N.sketch_similarity(z) - near) < 0.15
            assert set(a["bands"][4]) & set(a["bands"][i])
        if near < 0.15:
            assert z > N.most_bits()
    assert pairs > 2


def test_connected_components(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(1, 150)] + [(5000, 5000)]
    edges += [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(90)]
    up = {x: x for e in edges for x in e}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for u, v in edges:
        a, b = root(u), root(v)
        up[max(a, b)] = min(a, b)
    with Stages(spark) as stages:
        got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long"), stages).collect()}
        assert components(spark.createDataFrame([], "u long, v long"), stages).count() == 0
    assert got == {x: root(x) for u, v in edges if u != v for x in (u, v)}
