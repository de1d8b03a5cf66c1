"""Minimum-cost-flow resharding (operator 7).

Rows lie in old shards and are to lie in ``n_new`` shards whose row counts
differ by one at most. Which rows move is a minimum-cost flow: every old shard
supplies its rows, a row that stays costs nothing, a row that moves costs its
bytes, and every new shard takes ``q`` or ``q + 1`` rows. The smallest rows of a
shard are the cheapest to move, so the flow only has to choose which shards take the
extra row: a shard's rows are three blocks, those that move in any case, the
one that stays only with an extra row (at its own size), and those that stay
in any case. No placement with these counts moves fewer bytes.

The driver sees one line per old shard, whose number is a parameter of the
caller. The flow's answer is one run of rows per (old shard, new shard) pair in
use, at most ``n_old + n_new`` of them; Spark looks a row's run up by its rank in its
old shard by size. Ranks come from a sort in key ranges
(``group_row_numbers``), so a hot shard or a hot size is spread over many tasks.

Defined cases: a null or unknown old shard has no place to stay, so its rows
are all placed; sizes are never null in the result; an empty table gives an
empty result; equal rows get different slots; other columns pass through.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellfold.llm.words import unused_name
from cellfold.operators.numbering import group_row_numbers
from cellfold.session import delete_tree


def cheapest_flow(blocks: dict[int, list[tuple[int, int]]], n_new: int) -> dict[int, list[tuple[int, int]]]:
    """Rows to send from every old shard to new ones, moving the fewest bytes.

    ``blocks[old]`` lists ``(rows, bytes)`` per block, cheapest rows first. The
    answer lists ``(new shard, rows)`` per old shard: moved rows first, in
    block order, then those that stay. Successive shortest paths with
    potentials; paths carry whole blocks at once.
    """
    total = sum(r for bs in blocks.values() for r, _ in bs)
    q, extra = divmod(total, n_new)
    olds = sorted(blocks)
    src, sink, hub, spare = 0, 1, 2, 3
    old_node = {o: 4 + k for k, o in enumerate(olds)}
    new_node = [4 + len(olds) + j for j in range(n_new)]
    graph: list[list[list]] = [[] for _ in range(4 + len(olds) + n_new)]

    def arc(a: int, b: int, cap: int, cost: int) -> list:
        fwd, back = [b, cap, cost, None], [a, 0, -cost, None]
        fwd[3], back[3] = back, fwd
        graph[a].append(fwd)
        graph[b].append(back)
        return fwd

    stay, move = {}, {}
    for o in olds:
        arc(src, old_node[o], sum(r for r, _ in blocks[o]), 0)
        if 0 <= o < n_new:
            stay[o] = arc(old_node[o], new_node[o], total, 0)
        move[o] = [arc(old_node[o], hub, r, 1 + 1000 * b // r) for r, b in blocks[o] if r]
    fill = [arc(hub, v, total, 0) for v in new_node]
    for v in new_node:
        arc(v, sink, q, 0)
        arc(v, spare, 1, 0)
    arc(spare, sink, extra, 0)

    pot = [0] * len(graph)
    sent = 0
    while sent < total:
        dist, via = [None] * len(graph), [None] * len(graph)
        dist[src], heap = 0, [(0, src)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for e in graph[u]:
                if e[1] and (dist[e[0]] is None or d + e[2] + pot[u] - pot[e[0]] < dist[e[0]]):
                    dist[e[0]], via[e[0]] = d + e[2] + pot[u] - pot[e[0]], e
                    heapq.heappush(heap, (dist[e[0]], e[0]))
        far = max(d for d in dist if d is not None)
        pot = [p + (far if d is None else d) for p, d in zip(pot, dist)]
        path, v = [], sink
        while v != src:
            path.append(via[v])
            v = via[v][3][0]
        room = min(e[1] for e in path)
        for e in path:
            e[1] -= room
            e[3][1] += room
        sent += room

    out: dict[int, list[tuple[int, int]]] = {}
    wanted = [[j, e[3][1]] for j, e in enumerate(fill) if e[3][1]]
    for o in olds:
        out[o], left = [], sum(e[3][1] for e in move[o])
        while left:
            take = min(left, wanted[0][1])
            out[o].append((wanted[0][0], take))
            wanted[0][1] -= take
            left -= take
            if not wanted[0][1]:
                wanted.pop(0)
        if o in stay and stay[o][3][1]:
            out[o].append((o, stay[o][3][1]))
    return out


def reshard(df: DataFrame, *, old_shard: Column, size: Column, key: Column, n_new: int) -> DataFrame:
    """``df`` with ``shard`` (0 to ``n_new - 1``), ``slot`` (gapless from 0 in
    every shard) and ``moved``; existing columns of these names are replaced.

    ``old_shard`` is an integer expression with a bounded number of values,
    ``size`` the bytes that moving a row costs, ``key`` decides among rows of
    equal size. Small jobs count the shards and find their marginal rows; the result
    shuffles rows once. ``df`` has to hold the same rows in each (a table or a stage).
    """
    spark = df.sparkSession
    df = df.drop("shard", "slot", "moved")
    old, sz, hsh, rank, runs, run = unused_name(df, "_old", "_size", "_hash", "_rank", "_runs", "_run")
    rows = df.withColumns({old: F.coalesce(old_shard.cast("int"), F.lit(-1)),
                           sz: F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)), hsh: F.xxhash64(key)})
    ranked = group_row_numbers(rows, [old], [sz, hsh, key], rank)
    counts = dict(rows.groupBy(old).agg(F.count("*")).collect())
    found, fill = [], [0] * n_new
    for o, parts in cheapest_flow(_blocks(ranked.select(old, sz, rank), counts, n_new), n_new).items():
        start = 0
        for j, n in parts:
            found.append((o, start, start + n, j, fill[j] - start))
            start, fill[j] = start + n, fill[j] + n
    lookup = (spark.createDataFrame(found, f"{old} int, a long, b long, shard int, shift long")
              .groupBy(old).agg(F.collect_list(F.struct("a", "b", "shard", "shift")).alias(runs)))
    placed = (ranked.withColumn(rank, F.col(rank) - 1)
              .join(F.broadcast(lookup), old, "left")  # at most n_old + n_new runs
              .withColumn(run, F.filter(F.col(runs), lambda r: (r["a"] <= F.col(rank))
                                        & (F.col(rank) < r["b"]))[0]))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns],
                         F.col(run)["shard"].alias("shard"),
                         (F.col(rank) + F.col(run)["shift"]).alias("slot"),
                         (F.col(run)["shard"] != F.col(old)).alias("moved"))


def _blocks(ranked: DataFrame, counts: dict[int, int], n_new: int) -> dict[int, list[tuple[int, int]]]:
    """Per old shard (rows, bytes) of its three blocks. ``ranked``: (shard, size,
    rank from 1). Only the size of the middle block, one row, bears on the flow."""
    q = sum(counts.values()) // n_new
    edge = {o: n - q for o, n in counts.items() if n > q and 0 <= o < n_new}
    old, sz, rank = ranked.columns
    wanted = ranked.sparkSession.createDataFrame(list(edge.items()), f"{old} int, {rank} long")  # one per old shard
    marginal = dict(ranked.join(F.broadcast(wanted), [old, rank]).select(old, sz).collect())
    return {o: [(edge[o] - 1, 0), (1, marginal[o]), (q, q * marginal[o])] if o in edge else [(n, 0)]
            for o, n in counts.items()}


def rewrite_affected(placed: DataFrame, path: str) -> None:
    """Write the shards that gained or lost rows as ``shard=N`` folders below
    ``path``; folders of untouched shards stay as they are and those of drained
    shards go. ``placed`` must still hold the old shard as column ``old_shard``;
    rows whose old shard is null or negative count as moved. ``placed`` may be read from ``path``.

    The new folders are complete beside ``path`` (``path`` + ``.staged-*``)
    before the first old one is touched, and replaced ones lie in ``path`` +
    ``.replaced-*`` until the last is in place. The folders are swapped one by one: after a
    failure between two swaps both side folders are left for repair. The driver
    holds one line per affected shard."""
    spark, path = placed.sparkSession, path.rstrip("/")
    old = F.coalesce(F.col("old_shard").cast("int"), F.lit(-1))
    moved = placed.filter(old != F.col("shard"))
    hit = moved.select("shard").unionByName(moved.select(old.alias("shard"))).distinct()
    tag = uuid.uuid4().hex
    staged, replaced = f"{path}.staged-{tag}", f"{path}.replaced-{tag}"
    affected = sorted(r["shard"] for r in hit.filter("shard >= 0").collect())
    # runs of slots, so that a large shard is written by several tasks, in order
    (placed.filter(F.col("shard").isin(affected)).repartitionByRange("shard", "slot")
     .sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").mode("errorifexists").parquet(staged))

    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = folder(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def move(a: str, b: str) -> None:
        if not fs.rename(folder(a), folder(b)):
            raise OSError(f"cannot move {a} to {b}; see {staged} and {replaced}")

    fs.mkdirs(folder(path))
    fs.mkdirs(folder(replaced))
    for shard in affected:
        name = f"/shard={shard}"
        if fs.exists(folder(path + name)):
            move(path + name, replaced + name)
        if fs.exists(folder(staged + name)):  # else drained
            move(staged + name, path + name)
    delete_tree(spark, staged)
    delete_tree(spark, replaced)
