"""Merkle dataset manifest with pointer-jumping proofs (operator 12).

Rows are leaves. The leaves of a group (source), in ascending order of their
id, are cut into runs of ``FAN``; the digest of a run's digests is a node of the
next level, until one node is left, the group's subroot. The subroots, in the
order of their groups, form a tree of the same kind, whose last node is the root.

1. One pass over the texts makes the leaf digests; positions within the groups
   come from a sort in key ranges, so a group of any size spreads over many tasks.
2. Every level is one aggregation by (group, run); a run never holds more than
   ``FAN`` digests. A level has a sixteenth of the rows of the one below.
3. Proofs by pointer jumping: every run holds a pointer to the run above it and
   a segment, that run's digests and the place in it. A round joins the runs with
   themselves on the pointer and concatenates the two segments, which doubles the
   distance of all pointers; after log2(height) rounds every pointer has
   reached the root. Many runs point at the same ancestor in the later rounds; the
   join is a plain one on shuffled sides, which adaptive execution splits.
4. The rows of a run are then unfolded beside its segment: a leaf's siblings are
   the other digests of its run and of the runs of the segment.

Only the root and the largest number of leaves in a group reach the driver.

Defined cases: null and empty fields differ (``-`` and ``0:``); the null group
is a group and comes first; null ids come first within their group, rows of one
id follow by digest, repeated rows are leaves of their own; a group of one row
is its own subroot, a table of one row its own root with an empty proof; an
empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellfold.functions.names import qcol
from cellfold.operators.numbering import group_row_numbers, number_rows
from cellfold.session import Stages

FAN = 16
_TOP = ""  # the tree of subroots; the trees of groups are named by their encoded group
_PATH = "array<struct<at: int, kids: array<string>, top: boolean>>"


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def encoded(column: Column) -> Column:
    """A field of a leaf: byte count, colon, value; ``-`` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return digest(F.concat(*[encoded(c) for c in columns]))


def _others(part: Column) -> Column:
    """The digests of a run but for the one at ``at``."""
    return F.concat(F.slice(part["kids"], 1, part["at"]), F.slice(part["kids"], part["at"] + 2, FAN))


def proof(path: Column) -> Column:
    """The siblings of a leaf, level by level, left to right."""
    return F.flatten(F.transform(path, _others))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf digest and its siblings give."""
    return F.aggregate(path, start, lambda held, part: digest(F.array_join(F.concat(
        F.slice(part["kids"], 1, part["at"]), F.array(held), F.slice(part["kids"], part["at"] + 2, FAN)), "")))


def _levels(first: DataFrame, rows: int, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """All runs (tree, level, run, kids) over ``first``, the runs of the lowest
    level, and the last node of each tree (tree, level of its run, hash). A tree
    of one node has a run of one digest, which is not hashed again.
    ``rows``: the most nodes of a tree."""
    made, level = first.select("tree", "run", "kids"), 1
    runs, last = [], []
    while True:
        alone = (F.col("run") == 0) & (F.size("kids") == 1)
        last.append(made.where(alone).select("tree", F.lit(max(level - 1, 1)).alias("level"), F.col("kids")[0].alias("hash")))
        # the run of a lone leaf stays, as the place its pointer starts from
        runs.append((made if level == 1 else made.where(~alone)).select("tree", F.lit(level).alias("level"), "run", "kids"))
        if rows <= 1:
            break
        nodes = made.where(~alone).select("tree", F.col("run").alias("pos"), digest(F.array_join("kids", "")).alias("hash"))
        made, level, rows = stages.save(_runs(nodes, []), "merkle-level"), level + 1, -(-rows // FAN)
    return reduce(DataFrame.unionByName, runs), reduce(DataFrame.unionByName, last)


def _runs(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """``nodes`` (tree, pos, hash) in runs: ``kids`` by position, and the rows."""
    run = F.floor(F.col("pos") / FAN).alias("run")
    held = F.sort_array(F.collect_list(F.struct("pos", "hash", *carried)))
    return nodes.groupBy("tree", run).agg(held.alias("rows")).select(
        "tree", "run", F.col("rows.hash").alias("kids"), *(["rows"] if carried else []))


def _paths(runs: DataFrame, ends: DataFrame, stages: Stages) -> DataFrame:
    """(tree, level, run, path): what lies between every run and the root.
    ``ends`` (tree, level, p): the last run of each tree, and the place of its
    digest in the tree of subroots; null where there is none above."""
    up = runs.join(ends.withColumn("run", F.lit(0).cast("long")).withColumn("end", F.lit(True)), ["tree", "level", "run"], "left")
    end = F.coalesce("end", F.lit(False))
    at = F.when(end, F.col("p")).otherwise(F.col("run"))
    up = up.select("tree", "level", "run", F.pmod(at, F.lit(FAN)).cast("int").alias("at"), end.alias("top"),
                   F.when(at.isNotNull(), F.when(end, F.lit(_TOP)).otherwise(F.col("tree"))).alias("up_tree"),
                   F.when(end, F.lit(1)).otherwise(F.col("level") + 1).alias("up_level"),
                   F.floor(at / FAN).alias("up_run"))
    key = ["up_tree", "up_level", "up_run"]
    above = runs.select(F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("run").alias("up_run"), "kids")
    now = stages.save(up.where("up_tree is not null").join(above, key).select(
        "tree", "level", "run", *key, F.array(F.struct("at", "kids", "top")).alias("path")), "merkle-paths")
    root = up.where("up_tree is null").select("tree", "level", "run", F.array().cast(_PATH).alias("path"))
    done = [root]
    ancestor = (F.col("level") > 1) | (F.col("tree") == _TOP)  # the lowest runs are none
    while not now.isEmpty():
        ended = [d.select("*", *[F.lit(None).cast(t).alias(k) for k, t in zip(key, ("string", "int", "long"))]) for d in done]
        held = reduce(DataFrame.unionByName, [now, *ended]).where(ancestor).select(
            F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("run").alias("up_run"),
            *[F.col(k).alias(f"next_{k}") for k in key], F.col("path").alias("more"))
        jumped = stages.save(now.join(held, key).select(
            "tree", "level", "run", *[F.col(f"next_{k}").alias(k) for k in key],
            F.concat("path", "more").alias("path")), "merkle-paths")
        done.append(jumped.where("up_tree is null").select("tree", "level", "run", "path"))
        now = jumped.where("up_tree is not null")
    return reduce(DataFrame.unionByName, done)


def manifest(df: DataFrame, stages: Stages, *, ident: str, group: str, fields: list[str],
             carried: dict[str, Column] | None = None) -> DataFrame:
    """For every row of ``df``: the ``ident`` column, ``carried`` columns,
    ``leaf`` (the digest over ``fields``), ``subroot`` of its group, ``root``
    and ``path``, from which ``proof`` and ``folded`` read the siblings."""
    carried = carried or {}
    leaves = stages.save(df.select(
        encoded(qcol(group)).alias("tree"), qcol(ident).cast("long").alias("id"), leaf([qcol(f) for f in fields]).alias("hash"),
        *[c.alias(f"carried_{k}") for k, c in carried.items()]), "merkle-leaves")
    held = ["id", *[f"carried_{k}" for k in carried]]
    placed = group_row_numbers(leaves, ["tree"], ["id", "hash"], "pos", unique_keys=False)
    first = stages.save(_runs(placed.withColumn("pos", F.col("pos") - 1), held), "merkle-runs")
    rows = FAN * ((first.agg(F.max("run")).first()[0] or 0) + 1)
    runs, last = _levels(first, rows, stages)

    # the tree of subroots; groups by their bytes, the null group first
    name = F.expr("if(tree = '-', null, substr(tree, instr(tree, ':') + 1))")
    tops = stages.save(number_rows(last.withColumn("name", name), "p", ["name"]), "merkle-subroots")
    above = stages.save(_runs(tops.select(F.lit(_TOP).alias("tree"), (F.col("p") - 1).alias("pos"), "hash"), []), "merkle-level")
    n_tops = tops.count()
    top_runs, top_last = _levels(above, n_tops, stages)
    found = top_last.first()
    root = found["hash"] if found else None
    if n_tops > 1:
        ends = tops.select("tree", "level", F.col("p") - 1).unionByName(
            top_last.select("tree", "level", F.lit(None).cast("long").alias("(p - 1)")))
        runs = runs.unionByName(top_runs)
    else:
        ends = tops.select("tree", "level", F.lit(None).cast("long").alias("p"))
    paths = _paths(runs, ends.toDF("tree", "level", "p"), stages).where("level = 1").select("tree", "run", "path")

    full = first.join(paths, ["tree", "run"])
    alone = (F.col("run") == 0) & (F.size("kids") == 1)
    every = full.select(alone.alias("alone"), "kids", "path", F.posexplode("rows").alias("at", "row"))
    own = F.array(F.struct("at", "kids", F.lit(False).alias("top")))
    path = F.when(F.col("alone"), F.col("path")).otherwise(F.concat(own, F.col("path")))
    every = every.select("row", path.alias("path"))
    top = F.get(F.filter("path", lambda x: x["top"]), F.lit(0))
    return every.select(F.col("row.id").alias(ident), *[F.col(f"row.carried_{k}").alias(k) for k in carried],
                        F.col("row.hash").alias("leaf"), F.coalesce(F.get(top["kids"], top["at"]), F.lit(root)).alias("subroot"),
                        F.lit(root).alias("root"), "path")
