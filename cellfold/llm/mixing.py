"""Mixing sources to target weights by a splitting tree (operator 2).

Every source has a weight and a size in words. The mix holds as many words as
the input; a source's target is its weighted share, at most ``max_repeat``
times its size, and what such a limit frees is shared again by weight.

1. The documents of a source are put in a random order by a seeded hash and
   laid on a line of words. A target of ``t`` words takes ``[0, t)`` of that
   line, going round it again when ``t`` exceeds the size. The line is cut into
   blocks of ``block_words`` words: the source's exact block quota. Since the
   order is random, consecutive blocks are randomly permuted blocks.
2. A binary tree splits the vector of block quotas among ``n_shards`` output
   shards. At every node the left child gets half of the blocks, and how many
   of each source is drawn from the multivariate hypergeometric distribution,
   by selection sampling without replacement with hashed uniform numbers. To
   keep rows small when there are many sources, a node first splits the totals
   of groups of 256 sources, then each group splits its share.
3. Shards take disjoint runs of a source's blocks, as many as their leaf says.
   A document goes where its start lies. Shards are shuffled locally by a
   second hash (``shuffle``), in whose order ``mixed_rows`` writes them.

Everything is DataFrame expressions. Only the word counts by (source, hash
bucket) are gathered by source, so a hot source is spread over its buckets.
The driver holds three numbers per reshare step.

Defined cases: a null text has no words, a null source is a source of its own,
last in order; documents without words are never taken; an empty table gives
an empty result; repeated rows are separate documents; other columns pass
through, those named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellfold.functions.names import qcol
from cellfold.session import Stages

WEIGHTS = (5, 2, 1)  # by source in code point order, repeating
BUCKETS = 1024
GROUP = 256
BLOCKS_PER_SHARD = 32
OUTPUT = ("source_size", "target", "taken", "pieces")

# left share of each (id, q) of items when l of their t blocks go left
_DRAW = """
aggregate({items},
  named_struct('t', {t}, 'l', {l}, 'out', cast(array() as array<bigint>)),
  (a, x) -> transform(array(aggregate(
      if(x.q > 0, sequence(1L, x.q), cast(array() as array<bigint>)),
      named_struct('t', a.t, 'l', a.l),
      (b, j) -> named_struct('t', b.t - 1L, 'l', b.l - cast(
        pmod(xxhash64({seed}, x.id, j), 1073741824L) / 1073741824.0D * b.t < b.l as bigint)))),
    r -> named_struct('t', r.t, 'l', r.l, 'out', concat(a.out, array(a.l - r.l))))[0],
  a -> a.out)
"""


def source_targets(stages: Stages, sizes: DataFrame, *, weights=WEIGHTS, max_repeat: int = 3) -> DataFrame:
    """``sizes`` (source, size) with ``rank``, ``weight`` and ``target``.

    One row per source; only here is the whole list of sources put in one
    order. Shares are raised step by step until no further source reaches its
    limit; a step reads the small table once.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    ranked = ranked.withColumn("weight", F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = stages.save(ranked, "mix-sources")
    limit = F.col("size") * max_repeat
    total = ranked.agg(F.sum("size")).first()[0] or 0
    share, before = 0.0, -1.0
    while total and share > before:
        before = share
        full, free = ranked.agg(F.sum(F.when(limit <= share * F.col("weight"), limit)),
                                F.sum(F.when(limit > share * F.col("weight"), F.col("weight")))).first()
        if not free:
            break
        share = (total - (full or 0)) / free
    return ranked.withColumn("target", F.least(limit.cast("double"), F.lit(share) * F.col("weight")))


def split_quotas(quotas: DataFrame, total: int, n_shards: int, seed: int) -> DataFrame:
    """``quotas`` (id, q), ids 0, 1, ...; the answer has ``id`` and ``shares``,
    the number of blocks for each of the ``n_shards`` (a power of two) shards."""
    items = F.array_sort(F.collect_list(F.struct("id", "q")))
    tree = (quotas.groupBy(F.floor(F.col("id") / GROUP).alias("grp")).agg(items.alias("items"))
            .withColumn("node", F.lit(0).cast("long")))
    width = n_shards
    level = 0
    while width > 1:
        sized = tree.withColumn("n", F.expr("aggregate(items, 0L, (s, x) -> s + x.q)"))
        # leaves lo to hi - 1 hold total * hi div n - total * lo div n blocks
        edge = lambda at: f"({total}L * ({at}) div {n_shards}L)"
        lo = f"node * {width}L"
        nodes = (sized.groupBy("node").agg(F.array_sort(F.collect_list(
            F.struct(F.col("grp").alias("id"), F.col("n").alias("q")))).alias("groups"))
            .withColumn("left", F.expr(_DRAW.format(
                items="groups", t=f"{edge(f'{lo} + {width}L')} - {edge(lo)}",
                l=f"{edge(f'{lo} + {width // 2}L')} - {edge(lo)}", seed=f"{seed}L, {level}, 0, node")))
            .select("node", F.explode(F.arrays_zip("groups", "left")).alias("g"))
            .select("node", F.col("g.groups.id").alias("grp"), F.col("g.left").alias("l")))
        drawn = sized.join(nodes, ["node", "grp"]).withColumn("left", F.expr(_DRAW.format(
            items="items", t="n", l="l", seed=f"{seed}L, {level}, 1, node")))
        both = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.expr(
                "zip_with(items, left, (x, k) -> named_struct('id', x.id, 'q', k))").alias("items")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.expr(
                "zip_with(items, left, (x, k) -> named_struct('id', x.id, 'q', x.q - k))").alias("items")))
        tree = drawn.select("grp", F.explode(both).alias("c")).select("grp", "c.node", "c.items")
        width //= 2
        level += 1
    return (tree.select("node", F.inline("items")).groupBy("id")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("node", "q"))), lambda x: x["q"]).alias("shares")))


def mix_sources(df: DataFrame, stages: Stages, *, source: Column, size: Column, key: Column,
                n_shards: int = 16, weights=WEIGHTS, max_repeat: int = 3, seed: int = 20_077) -> DataFrame:
    """``df`` with ``source_size`` (long), ``target`` (double, its source's),
    ``taken`` (long, words taken, repeats counted) and ``pieces``, an array of
    (copy, words, shard, shuffle): copy 0 is the first pass over the source, shards
    are read in the order of ``shuffle``. Every
    source's taken words equal its target, rounded; the document at the end
    of the line gives only the words still wanted.

    Rows are never gathered: they meet the small tables by source and are
    ordered within (source, hash bucket). ``key`` must tell documents apart;
    rows with equal keys may swap places.
    """
    # the caller's columns travel in one struct, so that no name of theirs meets one of the plan
    src, sz, hsh, bkt, at, k, row = "source", "words", "hash", "bucket", "at", "key", "row"
    kept = [f for f in df.schema.fields if f.name.lower() not in OUTPUT]
    packed = F.struct(*[qcol(f.name).alias(f"c{i}") for i, f in enumerate(kept)])
    rows = df.select(source.alias(src), F.coalesce(size.cast("long"), F.lit(0)).alias(sz), key.alias(k), packed.alias(row))
    rows = rows.withColumn(hsh, F.xxhash64(F.lit(seed), k))
    rows = rows.withColumn(bkt, F.pmod(F.col(hsh), F.lit(BUCKETS)).cast("int"))
    buckets = stages.save(rows.groupBy(F.col(src).alias("source"), F.col(bkt).alias("bucket"))
                          .agg(F.sum(sz).alias("size")), "mix-buckets")
    targets = source_targets(stages, buckets.groupBy("source").agg(F.sum("size").alias("size")),
                             weights=weights, max_repeat=max_repeat)
    words = F.least(F.col("size") * max_repeat, F.round("target").cast("long"))
    total_words = targets.agg(F.sum("size")).first()[0] or 0
    block = max(1, total_words // (n_shards * BLOCKS_PER_SHARD))
    quotas = targets.withColumns({"words": words, "q": F.ceil(words / block).cast("long")})
    total = quotas.agg(F.sum("q")).first()[0] or 0
    leaves = split_quotas(quotas.select(F.col("rank").alias("id"), "q"), total, n_shards, seed)
    plan = stages.save(quotas.join(leaves, F.col("rank") == F.col("id")).select(
        F.col("source").alias("p_source"), F.col("size").alias("source_size"), "target", "words",
        F.expr("transform(sequence(1, size(shares)), i -> aggregate(slice(shares, 1, i), 0L, (s, x) -> s + x))")
        .alias("ends")), "mix-plan")

    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = buckets.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"),
                           F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("base"))
    line = Window.partitionBy(src, bkt).orderBy(hsh, k, sz).rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.withColumn(at, F.coalesce(F.sum(sz).over(line), F.lit(0)))
              .join(bases, F.col(src).eqNullSafe(F.col("b_source")) & (F.col(bkt) == F.col("b_bucket")))
              .withColumn(at, F.col(at) + F.col("base")))
    plan = plan.select("p_source", F.struct("source_size", "target", "words", "ends").alias("small"))
    placed = placed.join(plan, F.col(src).eqNullSafe(F.col("p_source")))
    start = lambda n: F.col(at) + n * F.col("small.source_size")
    pieces = F.array(*[F.struct(
        F.lit(n).alias("copy"),
        F.greatest(F.lit(0).cast("long"), F.least(F.col(sz), F.col("small.words") - start(n))).alias("words"),
        F.size(F.filter(F.col("small.ends"), lambda e: e <= F.floor(start(n) / block))).alias("shard"),
        F.xxhash64(F.lit(seed + 1), k, F.lit(n)).alias("shuffle"))
        for n in range(max_repeat)])
    return (placed.withColumn("pieces", F.filter(pieces, lambda p: p["words"] > 0))
            .select(*[F.col(row)[f"c{i}"].alias(f.name, metadata=f.metadata) for i, f in enumerate(kept)],
                    F.col("small.source_size").alias("source_size"), F.col("small.target").alias("target"),
                    F.aggregate("pieces", F.lit(0).cast("long"), lambda s, p: s + p["words"]).alias("taken"),
                    "pieces"))


def mixed_rows(mixed: DataFrame, *, size: Column, n_shards: int = 16) -> DataFrame:
    """One row per whole document copy in the mix, in the columns of ``mixed``
    but for the report, shard by shard and shuffled within: a shard's rows
    go to partitions by ranges of their ``shuffle``, in the order of it, so a shard
    fills as many tasks and files as its part of the shuffle partitions. The
    piece of a document that gives only some of its words is kept whole if it
    gives half of them or more."""
    kept = [f for f in mixed.schema.fields if f.name.lower() not in OUTPUT]
    packed = F.struct(*[qcol(f.name).alias(f"c{i}") for i, f in enumerate(kept)])
    rows = mixed.select(packed.alias("row"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"),
                        F.explode("pieces").alias("piece")).filter("piece.words * 2 >= size")
    parts = max(1, int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions")) // n_shards)
    part = F.least(F.floor((F.col("piece.shuffle") / 2.0 ** 64 + 0.5) * parts), F.lit(parts - 1))
    placed = rows.repartitionById(n_shards * parts, (F.col("piece.shard") * parts + part).cast("int"))
    return placed.sortWithinPartitions("piece.shard", "piece.shuffle").select(
        *[F.col("row")[f"c{i}"].alias(f.name, metadata=f.metadata) for i, f in enumerate(kept)])
