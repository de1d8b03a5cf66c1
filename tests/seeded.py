"""Seeded tables for round trips: any list of column types, values from hashes
of (row, column, seed), so a table is the same in every run and partitioning."""

from pyspark.sql import functions as F

TYPE_LISTS = {
    "whole": ["tinyint", "smallint", "int", "bigint"],
    "fractions": ["float", "double", "decimal(9,2)", "decimal(38,10)"],
    "moments": ["date", "timestamp", "timestamp_ntz"],
    "words": ["string", "binary", "boolean"],
    "nested": ["array<int>", "struct<p: timestamp_ntz, q: array<string>>", "map<string,bigint>"],
}


def seeded_table(spark, n, types, seed=0, null_share=0.0):
    def number(k, salt=0):
        return F.xxhash64("id", F.lit(k), F.lit(seed), F.lit(salt))

    def value(k, t):
        h = number(k)
        if t in ("tinyint", "smallint", "int", "bigint"):
            bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}[t]
            return F.shiftright(h, 64 - bits).cast(t) if bits < 64 else h
        if t == "date":
            return F.date_add(F.lit("1600-01-01").cast("date"), F.pmod(h, F.lit(250_000)).cast("int"))
        if t.startswith("timestamp"):
            return F.timestamp_micros(F.pmod(h, F.lit(4_000_000_000_000_000))).cast(t)
        if t == "binary":
            return F.unhex(F.hex(h))
        if t == "boolean":
            return h % 2 == 0
        if t == "string":
            return F.concat(F.hex(h), F.lit(" \"\\\n,é'"))
        if t == "array<int>":
            return F.transform(F.sequence(F.lit(1), F.pmod(h, F.lit(4)).cast("int") + 1), lambda i: (h % 1000).cast("int") * i)
        if t.startswith("struct"):
            return F.struct(F.timestamp_micros(F.pmod(h, F.lit(10**15))).cast("timestamp_ntz").alias("p"),
                            F.array(F.hex(h), F.lit("x")).alias("q"))
        if t.startswith("map"):
            return F.create_map(F.hex(h), h)
        return (h / 1e12).cast(t)
    cols = []
    for k, t in enumerate(types):
        v = value(k, t)
        cols.append((F.when(F.pmod(number(k, 1), F.lit(1000)) >= null_share * 1000, v) if null_share else v).cast(t).alias(f"c{k}"))
    return spark.range(n).select(*cols)
