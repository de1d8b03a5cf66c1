"""Tables like a given one (D2): random rows with the columns, null shares,
ranges and value frequencies of a table, of any size, from its profile alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellfold.functions.names import qcol
from cellfold.functions.text import check_supported, from_text, non_null, to_text

STEPS = 100  # quantiles of a numeric or time column
VALUES = 400  # sampled values of any other column
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _number(c: Column, dt: T.DataType) -> Column:
    """A numeric or time value as a double: days, or seconds since 1970."""
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")) / 1e6
    return c.cast("double")


def _value(x: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.DateType):
        return F.date_from_unix_date(F.floor(x).cast("int"))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(F.floor(x * 1e6).cast("long")).cast(dt)
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return x.cast(dt)
    return F.floor(x).cast(dt)


def _hash(text: Column) -> Column:
    """A hash that a double holds exactly, as quantiles are taken of doubles."""
    return F.pmod(F.xxhash64(text), F.lit(1 << 52))


def _profile(df: DataFrame) -> list[dict]:
    """Per column: the share of nulls, and quantiles of its numbers or a list of
    cell texts, each as often as its share. Texts are taken at quantiles of their
    hash, where a frequent text fills several; a second pass reads them by hash."""
    fields = df.schema.fields
    aggs, texts = [F.count(F.lit(1)).alias("rows")], {}
    for k, f in enumerate(fields):
        aggs.append(F.count(qcol(f.name)).alias(f"n{k}"))
        if isinstance(f.dataType, (*_NUMBERS, *_TIMES)):
            x, steps = _number(qcol(f.name), f.dataType), STEPS
            x = F.when(~F.isnan(x) & (F.abs(x) < 1e308), x)
        else:
            texts[k] = to_text(qcol(f.name), f.dataType)
            x, steps = F.when(texts[k].isNotNull(), _hash(texts[k])), VALUES
        aggs.append(F.percentile_approx(x, [i / steps for i in range(steps + 1)], 100 * steps).alias(f"q{k}"))
    row = df.agg(*aggs).first().asDict()
    values: dict[int, dict[int, str]] = {k: {} for k in texts}
    held = [F.struct(F.lit(k).alias("k"), _hash(t).alias("h"), t.alias("t")) for k, t in texts.items() if row[f"q{k}"]]
    if held:
        wanted = [(k, h) for k in texts for h in set(row[f"q{k}"] or [])]  # VALUES a column at most
        wanted = df.sparkSession.createDataFrame(wanted, "k int, h long")
        cells = df.select(F.explode(F.array(*held)).alias("c")).select("c.*")
        for r in cells.join(F.broadcast(wanted), ["k", "h"]).groupBy("k", "h").agg(F.min("t").alias("t")).collect():
            values[r["k"]][r["h"]] = r["t"]
    return [{"nulls": 1 - row[f"n{k}"] / row["rows"] if row["rows"] else 1.0,
             "quantiles": row[f"q{k}"] if k not in texts else None,
             "values": sorted(values[k][h] for h in row[f"q{k}"][:-1]) if k in texts and row[f"q{k}"] else []}
            for k in range(len(fields))]


def table_like(df: DataFrame, n_rows: int, seed: int = 0) -> DataFrame:
    """``n_rows`` random rows in the schema of ``df``.

    Numbers, dates and times are drawn by inverse distribution from quantiles of
    the column; all other types from a list of ``VALUES`` of its values, frequent
    ones as often as in the table; nulls come with the column's share. Columns
    are drawn independently. The random numbers are hashes of (seed, column, row
    number), so the rows follow from the profile, not from how a job is
    partitioned; the quantiles are approximate to a hundredth of a step. A column without any values stays
    null; if it is not nullable, reading the rows fails with a message.
    """
    for f in df.schema.fields:
        check_supported(f.name, f.dataType)
    rows = df.sparkSession.range(n_rows)
    uniform = lambda tag, k: F.pmod(F.xxhash64(F.lit(seed), F.lit(tag), F.lit(k), F.col("id")),
                                    F.lit(1 << 52)) / float(1 << 52)
    out = []
    for k, (f, p) in enumerate(zip(df.schema.fields, _profile(df))):
        u = uniform("value", k)
        if p["quantiles"]:
            held = F.array(*[F.lit(float(q)) for q in p["quantiles"]])
            at = F.floor(u * STEPS).cast("int")
            low, high = F.get(held, at), F.get(held, at + 1)
            value = _value(low + (high - low) * (u * STEPS - at), f.dataType)
        elif p["values"]:
            held = F.array(*[F.lit(v) for v in p["values"]])
            value = from_text(F.get(held, F.floor(u * len(p["values"])).cast("int")), f.dataType)
        else:
            value = F.lit(None).cast(f.dataType)
        if p["nulls"]:
            value = F.when(uniform("null", k) >= p["nulls"], value)
        out.append((value if f.nullable else non_null(value, f.dataType, f.name)).alias(f.name, metadata=f.metadata))
    return rows.select(*out)
