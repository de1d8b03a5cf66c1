"""Document fingerprints from closed syncmers (operator 4).

Tokens are words. Of all runs of ``K`` words (k-mers) a closed syncmer is one
whose smallest inner run of ``S`` words, by hash, stands at its start or its
end. Whether a run is chosen depends on its own words alone, so an edit
changes only the anchors it touches and equal passages give equal anchors
wherever they lie; at least one in every ``K - S`` neighbouring runs is chosen.
An anchor is the run's position (in words) and a 32-bit hash of its words.

Array expressions only; no shuffle. ``with_next`` gives every document the one
that follows it by id: ids are cut into ranges by quantiles of the id column,
documents meet within their range, and the first document of every range is
sent to the range before it as well, so that no task sees all documents.

Defined cases: a null or empty text has no anchors; fewer than ``K`` words are
one anchor; equal texts have equal anchors; two documents without anchors are
alike (1.0), one with and one without are not (0.0). Rows that share an id
follow each other by hash and text; rows with a null id stand outside the
order: nothing follows them and they follow nothing. Columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellfold.llm.words import WORD, text_of, unused_name

K, S = 6, 2
SHIFT = 16  # words by which anchors of one diagonal may differ
FAN = 64  # ids are ranged in steps of 64 bounds
MOST_RANGES = FAN ** 3
RANGE_ROWS = 2048


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """(``s < k``) Array of (pos, hash) of the closed syncmers of a text, in order."""
    words = F.regexp_extract_all(text_of(text), F.lit(f"({WORD})"), F.lit(1))

    def chosen(h: Column, g: Column) -> Column:
        inner = lambda i: [F.get(g, i + j) for j in range(k - s + 1)]
        closed = F.filter(F.sequence(F.lit(0), F.size(h) - k), lambda i: _let(
            F.least(*inner(i)), lambda low: (low == F.get(g, i)) | (low == F.get(g, i + (k - s)))))
        return F.transform(closed, lambda i: F.struct(
            i.alias("pos"), F.hash(*[F.get(h, i + j) for j in range(k)]).alias("hash")))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        hashed = F.transform(w, lambda x: F.xxhash64(x))
        long_text = _let(hashed, lambda h: _let(
            F.transform(F.sequence(F.lit(0), F.size(h) - s), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(s)])),
            lambda g: chosen(h, g)))
        short_text = F.array(F.struct(F.lit(0).alias("pos"), F.hash(F.array_join(w, "\n")).alias("hash")))
        return (F.when(n >= k, long_text).when(n > 0, short_text)
                .otherwise(F.array().cast("array<struct<pos: int, hash: int>>")))
    return _let(words, of_words)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row."""
    return F.transform(F.array(value), body)[0]


def packed(anchors_: Column) -> Column:
    """Anchors as longs (position above hash), eight bytes each: a shuffle writes
    four times as much for structs."""
    return F.transform(anchors_, lambda x: F.shiftleft(x["pos"].cast("long"), 32).bitwiseOR(
        x["hash"].cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))


def unpacked(longs: Column) -> Column:
    """The anchors that ``packed`` was given."""
    return F.transform(longs, lambda x: F.struct(
        F.shiftright(x, 32).cast("int").alias("pos"), F.shiftright(F.shiftleft(x, 32), 32).cast("int").alias("hash")))


def printed(anchors_: Column) -> Column:
    """Anchor hashes in order as text, eight hexadecimal digits each."""
    return F.array_join(F.transform(anchors_["hash"], lambda h: F.lower(F.lpad(F.hex(h.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Positional likeness of two texts by their anchors (pos, hash): the shared
    anchors on the diagonal that has most of them, over the smaller number of
    distinct anchors. A diagonal is the shift between the two positions in steps
    of ``SHIFT`` words, together with the next step, so small edits do not leave
    it. A text counts as alike to one that holds it; the same passages in another
    order do not. An anchor that a text repeats counts at its first position."""
    side = lambda x, k: F.transform(x, lambda y: F.struct(y["hash"], F.lit(k).alias("side"), y["pos"]))
    merged = F.array_sort(F.concat(side(a, 0), side(b, 1)))

    def alone(m: Column) -> Column:  # first positions
        return F.filter(m, lambda x, i: (i == 0) | (F.get(m, i - 1)["hash"] != x["hash"]) | (F.get(m, i - 1)["side"] != x["side"]))

    def judged(f: Column) -> Column:
        shift = lambda x, i: F.when((x["side"] == 0) & (F.get(f, i + 1)["hash"] == x["hash"]),
                                    F.floor((x["pos"] - F.get(f, i + 1)["pos"]) / SHIFT))
        shifts = F.array_sort(F.filter(F.transform(f, shift), lambda x: x.isNotNull()))
        n_a = F.size(F.filter(f, lambda x: x["side"] == 0))
        sizes = n_a, F.size(f) - n_a
        return (F.when(F.greatest(*sizes) == 0, F.lit(1.0)).when(F.least(*sizes) == 0, F.lit(0.0))
                .otherwise(_most(shifts) / F.least(*sizes)))
    return _let(merged, lambda m: _let(alone(m), judged))


def _most(shifts: Column) -> Column:
    """The most entries of a sorted array that have one value or the next."""
    def step(s: Column, x: Column) -> Column:
        same = x == s["at"]
        n = F.when(same, s["n"] + 1).otherwise(F.lit(1))
        before = F.when(same, s["before"]).when(x == s["at"] + 1, s["n"]).otherwise(F.lit(0))
        return F.struct(x.alias("at"), n.alias("n"), before.alias("before"), F.greatest(s["best"], n + before).alias("best"))
    none = F.struct(F.lit(None).cast("long").alias("at"), F.lit(0).alias("n"), F.lit(0).alias("before"), F.lit(0).alias("best"))
    return F.aggregate(shifts, none, step, lambda s: s["best"])


def _range_of(ident: Column, bounds: list[int]) -> Column:
    """How many bounds lie at or below the id, by steps of ``FAN``."""
    held = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    step = 1
    while step * FAN < len(bounds) + 1:
        step *= FAN

    def refined(at: Column, step: int) -> Column:
        more = F.filter(F.sequence(F.lit(1), F.lit(FAN)), lambda j: F.get(held, at + j * step - 1) <= ident)
        found = at + step * F.size(more)
        return found if step == 1 else _let(found, lambda a: refined(a, step // FAN))
    return refined(F.lit(0), step)


def with_next(df: DataFrame, *, ident: str, values: list[str], names: list[str]) -> DataFrame:
    """``df`` with, under ``names``, the ``values`` of the row that follows in
    ascending order of the integer column ``ident``; the first follows the last.

    One job reads the ids for the bounds (at most ``MOST_RANGES``, ranges of
    ``RANGE_ROWS`` rows until then); one shuffle brings rows to their ranges.
    """
    i = F.col(f"`{ident}`").cast("long")
    rng, ties, wrapped, guest = unused_name(df, "_range", "_ties", "_wrapped", "_guest")
    n = df.filter(i.isNotNull()).count()
    parts = max(1, min(MOST_RANGES, n // RANGE_ROWS))
    found = df.agg(F.min(i), F.percentile_approx(i, [k / parts for k in range(1, parts)] or [0.0], 20 * parts)).first()
    if found[0] is None:
        return df.withColumns({new: F.lit(None).cast(df.schema[old].dataType) for old, new in zip(values, names)})
    bounds = sorted({found[0], *(found[1] if parts > 1 else [])})
    own = _range_of(i, bounds) - 1
    # the rows at a bound open their range and close the one before
    places = F.when(i.isin(bounds[0]), F.array(F.struct(own, F.lit(False), F.lit(False)),
                                               F.struct(F.lit(len(bounds) - 1), F.lit(True), F.lit(True))))
    at_bound = F.get(F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>"), own) == i
    places = places.when(at_bound, F.array(F.struct(own, F.lit(False), F.lit(False)),
                                           F.struct(own - 1, F.lit(False), F.lit(True))))
    places = places.otherwise(F.array(F.struct(own, F.lit(False), F.lit(False)))).cast(
        "array<struct<r: int, w: boolean, g: boolean>>")
    sent = (df.filter(i.isNotNull()).withColumn(rng, F.explode(places))
            .withColumns({wrapped: F.col(rng)["w"], guest: F.col(rng)["g"], rng: F.col(rng)["r"],
                          ties: F.xxhash64(*[F.col(f"`{v}`") for v in values])}))
    order = Window.partitionBy(rng).orderBy(wrapped, i, ties, *[F.col(f"`{v}`") for v in values[:1]])
    ahead = sent.withColumns({new: F.lead(f"`{old}`").over(order) for old, new in zip(values, names)})
    out = ahead.filter(~F.col(guest)).drop(rng, wrapped, guest, ties)
    alone = df.filter(i.isNull()).withColumns({
        new: F.lit(None).cast(df.schema[old].dataType) for old, new in zip(values, names)})
    return out.unionByName(alone)
