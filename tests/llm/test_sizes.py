"""Mixing (2), resharding (7): contracts against plain Python, edge tables."""

import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cellfold.llm.mixing import mix_sources, mixed_rows, split_quotas
from cellfold.llm.resharding import cheapest_flow, reshard, rewrite_affected
from cellfold.session import Stages
from llm_cases import SF_MID, docs_of, edge_dir, rows  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Water filling in exact numbers: {source: target}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    free, out, left = set(order), {}, Fraction(sum(sizes.values()))
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] >= 3 * sizes[s]}
        if not over:
            return out | {s: share * weight[s] for s in free}
        for s in over:
            out[s] = Fraction(3 * sizes[s])
            left -= out[s]
        free -= over
    return out


@pytest.mark.parametrize("which", ["edge", SF_MID])
def test_mix_meets_targets(which, edge_dir, rows, docs_of):
    folder = edge_dir if which == "edge" else which
    docs, got = docs_of(folder), rows("op2", folder)
    sizes = Counter()
    for r in docs:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    want = targets(sizes)
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in docs)
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - float(want[r["source"]])) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == sum(p["words"] for p in r["pieces"])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5
    again = rows("op2", folder)
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_shards_are_even_and_rows_follow(spark):
    # documents of one size: a shard's words are its blocks, but for the cut at every source's runs
    docs = spark.range(6000).selectExpr("id as doc_id", "concat('s', id % 5) as source", "'w' as text", "'clash' as Target")
    mixed = mix_sources(docs, Stages(spark), source=F.col("source"), size=F.lit(10), key=F.col("doc_id"))
    out = mixed_rows(mixed, size=F.lit(10))
    assert out.columns == ["doc_id", "source", "text"]
    words = {r[0]: r[1] for r in mixed.select(F.explode("pieces").alias("p")).groupBy("p.shard").agg(F.sum("p.words")).collect()}
    assert set(words) == set(range(16)) and sum(words.values()) == 60_000
    # one block more or less, five short last blocks, a document at both ends of five runs
    assert max(words.values()) - min(words.values()) <= 117 + 5 * 117 + 2 * 5 * 10
    # rows leave shard by shard, in the order of the shuffle
    places = [(p["shard"], p["shuffle"], r["doc_id"]) for r in mixed.collect() for p in r["pieces"] if 2 * p["words"] >= 10]
    want = [i for _, _, i in sorted(places)]
    assert [r["doc_id"] for r in out.collect()] == want and want != sorted(want)


def test_mix_with_columns_of_any_name(spark):
    names = ["target", "TAKEN", "pieces", "__words", "p_source", "b_source", "b_bucket", "shard", "shuffle", "__piece", "size", "row", "words"]
    docs = spark.range(300).withColumns({n: F.concat(F.lit(n), F.col("id")) for n in names})
    mixed = mix_sources(docs, Stages(spark), source=F.substring("p_source", -1, 1), size=F.length("TAKEN"), key=F.col("id"))
    assert mixed.columns == ["id", *[n for n in names if n.lower() not in ("target", "taken", "pieces")],
                             "source_size", "target", "taken", "pieces"]
    assert all(r["shard"] == f"shard{r['id']}" and r["size"] == f"size{r['id']}" for r in mixed.collect())
    out = mixed_rows(mixed, size=F.lit(1))
    assert out.columns == ["id", *[n for n in names if n.lower() not in ("target", "taken", "pieces")]] and out.count() > 250


def test_mix_of_nothing(edge_dir, rows):
    assert rows("op2", edge_dir + "/none") == []


def test_splitting_tree_keeps_quotas_and_is_hypergeometric(spark):
    quotas = [(i, random.Random(i).randrange(0, 40)) for i in range(600)]
    total = sum(q for _, q in quotas)
    df = spark.createDataFrame(quotas, "id long, q long")
    got = {r["id"]: r["shares"] for r in split_quotas(df, total, 8, 1).collect()}
    assert {i: sum(s) for i, s in got.items()} == dict(quotas)
    for k in range(8):
        assert sum(s[k] for s in got.values()) == total * (k + 1) // 8 - total * k // 8
    # one source of 30 blocks among 120 in 4 shards: mean 7.5, variance by the formula
    two = spark.createDataFrame([(0, 30), (1, 90)], "id long, q long")
    draws = [next(r["shares"][0] for r in split_quotas(two, 120, 4, s).collect() if r["id"] == 0) for s in range(24)]
    mean = sum(draws) / len(draws)
    var = 30 * 0.25 * 0.75 * 90 / 119
    assert abs(mean - 7.5) < 4 * (var / len(draws)) ** 0.5
    assert 0.4 * var < sum((x - 7.5) ** 2 for x in draws) / len(draws) < 2.2 * var


@pytest.mark.parametrize("which", ["edge", SF_MID])
def test_reshard_contract(which, edge_dir, rows, docs_of):
    folder = edge_dir if which == "edge" else which
    docs, got = docs_of(folder), rows("op7", folder)
    by = lambda r: (-1 if r[0] is None else r[0], r[1], r[2])
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in got), key=by) == sorted(
        ((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs), key=by)
    shards = defaultdict(list)
    for r in got:
        assert r["law"] == "rows" and r["grown_shard"] is None
        shards[r["shard"]].append(r["slot"])
    counts = [len(shards.get(k, [])) for k in range(24)]
    assert max(counts) - min(counts) <= 1 and set(shards) <= set(range(24))
    for s in shards.values():
        assert sorted(s) == list(range(len(s)))


def test_reshard_of_nothing(edge_dir, rows):
    assert rows("op7", edge_dir + "/none") == []


def least_bytes(olds, n_new):
    """Every choice of the shards with an extra row; the smallest rows move."""
    from itertools import combinations
    total = sum(len(s) for s in olds)
    q, r = divmod(total, n_new)
    best = None
    for extra in combinations(range(n_new), r):
        cap = [q + (j in extra) for j in range(n_new)]
        moved = sum(sum(sorted(s)[:max(0, len(s) - cap[o])]) for o, s in enumerate(olds))
        best = moved if best is None else min(best, moved)
    return best


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(5)
    for _ in range(60):
        n_new = rng.randrange(1, 6)
        olds = [[rng.randrange(1, 50) for _ in range(rng.randrange(0, 12))] for _ in range(rng.randrange(1, n_new + 1))]
        blocks = {o: [(1, b) for b in sorted(s)] for o, s in enumerate(olds)}
        moved, got = 0, Counter()
        for o, parts in cheapest_flow(blocks, n_new).items():
            line = sorted(olds[o])
            assert sum(n for _, n in parts) == len(line)
            at = 0
            for j, n in parts:
                got[j] += n
                moved += sum(line[at:at + n]) if j != o else 0
                at += n
        counts = [got[j] for j in range(n_new)]
        assert max(counts) - min(counts) <= 1
        assert moved == least_bytes(olds, n_new)


@pytest.mark.parametrize("seed", range(4))
def test_rows_that_move_have_the_fewest_bytes(spark, seed):
    rng = random.Random(seed)
    n_new = rng.randrange(2, 7)
    olds = [[rng.choice([1, 8, 9, rng.randrange(1, 5000)]) for _ in range(rng.randrange(0, 120))] for _ in range(n_new)]
    data = [(o, k, b) for o, s in enumerate(olds) for k, b in enumerate(s)]
    df = spark.createDataFrame(data, "old int, k int, bytes long")
    out = reshard(df, old_shard=F.col("old"), size=F.col("bytes"), key=F.struct("old", "k"), n_new=n_new)
    moved = out.where("moved").agg(F.sum("bytes")).first()[0] or 0
    assert moved == least_bytes(olds, n_new)


def test_reshard_keeps_rows_in_place_and_other_columns(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 10 as int) slot", "cast(if(id < 900, 0, id % 4) as int) old",
                                      "'x' as _Hash", "id % 7 as bytes")
    out = reshard(df, old_shard=F.col("old"), size=F.col("bytes"), key=F.col("id"), n_new=4)
    assert out.columns == ["id", "old", "_Hash", "bytes", "shard", "slot", "moved"]
    counts = dict(out.groupBy("old").agg(F.sum(F.col("moved").cast("int"))).collect())
    assert counts[0] == 925 - 250 and sum(counts.values()) == 925 - 250


def test_rewrite_keeps_untouched_shards_and_drops_drained_ones(spark, tmp_path):
    # 5 shards to 4: shard 1 keeps its 100 rows, shard 4 is drained, the others gain
    olds = [80, 100, 70, 90, 60]
    data = [(f"{o}-{k}", o, 10 + k) for o, n in enumerate(olds) for k in range(n)]
    path = str(tmp_path / "shards")
    df = spark.createDataFrame(data, "id string, old_shard int, bytes long")
    df.withColumn("shard", F.col("old_shard")).write.partitionBy("shard").parquet(path)
    before = {f.name for f in (tmp_path / "shards" / "shard=1").iterdir()}
    rows = spark.read.parquet(path).withColumn("old_shard", F.col("shard"))
    placed = reshard(rows, old_shard=F.col("old_shard"), size=F.col("bytes"), key=F.col("id"), n_new=4)
    want = sorted(map(tuple, placed.select("id", "bytes", "shard", "slot").collect()))
    rewrite_affected(placed, path)
    assert {f.name for f in (tmp_path / "shards" / "shard=1").iterdir()} == before
    assert sorted(f.name for f in (tmp_path / "shards").glob("shard=*")) == [f"shard={k}" for k in range(4)]
    back = spark.read.option("mergeSchema", "true").parquet(path)
    assert sorted((r["id"], r["bytes"]) for r in back.collect()) == sorted((i, b) for i, _, b in data)
    slots = {(i, b): (s, k) for i, b, s, k in want}
    assert all(r["shard"] == slots[r["id"], r["bytes"]][0] for r in back.collect())
    assert [f.name for f in tmp_path.iterdir()] == ["shards"]
