"""Secret scan (operator 3): fixed patterns and sliding-window entropy.

Base kinds are patterns, see ``BASE``. The entropy kinds look at candidate
strings, runs of 20 or more of ``A-Z a-z 0-9 + / _ -``. The allow-list
suppresses the path segments that it matches (``/`` parts segments), not the
whole run; segments that are words are suppressed in paths only, and a word is
shorter than a window. What is left between suppressed segments is classed and
scanned by itself. Every candidate has a class with a threshold of its own:
``hex``, ``mixed`` (lower case, upper case and digits), ``lower`` or ``upper`` with
digits, ``letters``, else ``digits``.

A window of 20 characters slides over the candidate. The
count of every character in it is kept up to date by adding the character
that enters and taking away the one that leaves, and with it the sum of
``c log2 c``, in whole units of 2^-20 bit so that sums are exact. The span
reaches from the first to the last window whose Shannon entropy
``log2 20 - sum / 20`` meets the threshold of the class.

One projection over whole texts, no shuffle; expressions only. Defined cases:
a null or empty text has no spans; rows are judged one by one, so repeated
rows and ties give equal results; other columns pass through, those named like
an output column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellfold.llm.spans import quoted, spans
from cellfold.llm.words import text_of, unused_name

#: kind: (pattern, group whose length counts, least length)
BASE = {
    "assign": (r"(?i)(password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?([A-Za-z0-9+/_.=-]+)", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),  # the runs of 32 or more are the runs that are kept
}
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"  # as many as WINDOW
THRESHOLDS = {"hex": 3.0, "mixed": 3.8, "lower": 3.5, "upper": 3.3, "letters": 3.6, "digits": 2.9}  # bits a character
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUID
    r"(?i)example|sample|placeholder|changeme|your[_-]?(api|secret|token|key)",
    r"(?i)^[_-]*(0123456789)?abcdefghijklmnop(qrstuvwxyz)?[_-]*$|0123456789abcdef",
)
_WORD = r"([A-Z]?[a-z]{2,18}|[A-Z]{3,19})"
WORDS = rf"^[_-]*{_WORD}([_-]+{_WORD})*[_-]*$"  # a segment of a path
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
UNIT = 1 << 20
CHUNK = 512  # windows walked at a time: reading a character of a long string costs its position
OUTPUT = ("n_assign", "n_access", "n_hex", "n_entropy", "base_spans", "all_spans")


def weight(count: int) -> int:
    """``c log2 c`` in units."""
    return round(count * math.log2(count) * UNIT) if count else 0


def most(bits: float) -> int:
    """The largest sum of weights at which a window has ``bits`` of entropy."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * UNIT)


def _array(numbers) -> str:
    return f"array({', '.join(f'{n}L' for n in numbers)})"


def _hot_part(thresholds) -> str:
    """SQL: for a candidate ``c`` (start, stop, value), the array of its span."""
    f = _array(weight(c) for c in range(WINDOW + 1))
    code = lambda i: f"instr('{ALPHABET}', substring(c.value, {i}, 1))"  # noqa: E731  1 to 66
    step = (f"transform(array(named_struct('e', {code('i')}, 'l', if(i > {WINDOW}, {code(f'i - {WINDOW}')}, 0))), "
            "y -> named_struct("
            "'n', transform(a.n, (v, k) -> v + cast(k + 1 = y.e as int) - cast(k + 1 = y.l as int)), "
            "'s', if(y.e = y.l, a.s, a.s "
            "  + get(f, get(a.n, y.e - 1) + 1) - get(f, get(a.n, y.e - 1)) "
            "  + if(y.l = 0, 0L, get(f, get(a.n, y.l - 1) - 1) - get(f, get(a.n, y.l - 1)))), "
            "'first', a.first, 'last', a.last))[0]")
    marked = (f"transform(array({step}), z -> if(i >= {WINDOW} and z.s <= lim, "
              f"named_struct('n', z.n, 's', z.s, 'first', if(z.first < 0, i - {WINDOW}, z.first), 'last', i), z))[0]")
    limit = " ".join(f"when '{k}' then {most(v)}L" for k, v in thresholds.items())
    walk = (f"aggregate(sequence(1, length(c.value)), named_struct('n', array_repeat(0, {len(ALPHABET)}), 's', 0L, "
            f"'first', -1, 'last', -1), (a, i) -> {marked}, a -> if(a.first < 0, "
            "cast(array() as array<struct<start: int, stop: int, kind: string>>), "
            "array(named_struct('start', c.start + a.first, 'stop', c.start + a.last, 'kind', concat('entropy_', c.kind)))))")
    return f"transform(array({f}), f -> transform(array(case c.kind {limit} end), lim -> {walk})[0])[0]"


def _scanned(of: str, thresholds, no: int) -> str:
    """SQL: the spans of all candidates in the array ``of``, one each at most. They are
    walked in chunks; one with fewer than 2^threshold distinct characters has no hot window."""
    chunk = (f"named_struct('start', o.start + {CHUNK} * k, 'value', substring(o.value, {CHUNK} * k + 1, "
             f"{CHUNK + WINDOW - 1}), 'kind', o.kind)")
    fewest = " ".join(f"when '{k}' then {math.ceil(2 ** v - 1e-9)}" for k, v in thresholds.items())
    chunks = (f"filter(transform(sequence(0, (length(o.value) - {WINDOW}) div {CHUNK}), k -> {chunk}), "
              f"c -> size(array_distinct(split(c.value, ''))) >= case c.kind {fewest} end)")
    span = f"named_struct('start', h[0].start, 'no', {no}, 'kind', h[0].kind, 'stop', element_at(h, -1).stop)"
    return (f"transform(filter(transform(filter({of}, o -> o.kind is not null), "
            f"o -> flatten(transform({chunks}, c -> {_hot_part(thresholds)}))), h -> size(h) > 0), h -> {span})")


def _pieces(allowed) -> str:
    """SQL: for a candidate ``c`` (start, stop, value), the array of (start,
    value, kind) of what the allow-list leaves of it."""
    skip = " or ".join([f"(c.value like '%/%' and s rlike {quoted(WORDS)})", *(f"s rlike {quoted(p)}" for p in allowed)])
    # suppressed segments become spaces, so positions stay; so do the slashes beside them
    masked = (f"regexp_replace(array_join(transform(split(c.value, '/', -1), "
              f"s -> if({skip}, repeat(' ', length(s)), s)), '/'), r'(?<=\x20)/|/(?=\x20)', ' ')")
    has = lambda p: f"x.value rlike r'[{p}]'"
    kind = (f"case when x.value rlike r'^[0-9a-fA-F]*$' and {has('0-9')} and {has('a-fA-F')} then 'hex' "
            f"when {has('0-9')} and {has('a-z')} and {has('A-Z')} then 'mixed' "
            f"when {has('0-9')} and {has('a-z')} then 'lower' when {has('0-9')} and {has('A-Z')} then 'upper' "
            f"when {has('A-Za-z')} then 'letters' else 'digits' end")
    return (f"transform(array({masked}), v -> transform({spans('v', CANDIDATE)}, "
            f"x -> named_struct('start', c.start + x.start, 'value', x.value, 'kind', {kind})))[0]")


def find_secrets(df: DataFrame, *, text: str = "text", thresholds=THRESHOLDS, allowed=ALLOWED) -> DataFrame:
    """``df`` with the counts per base kind, ``n_entropy``, and arrays
    ``base_spans`` and ``all_spans`` of (start, no, kind, stop), sorted."""
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in OUTPUT]
    t, base, runs, part, hot = unused_name(df, "_t", "_base", "_runs", "_part", "_hot")
    kinds = list(BASE)
    at = df.withColumn(t, text_of(F.col(f"`{text}`")))
    parts = [f"transform({spans(t, p, group=g, least=n)}, x -> named_struct("
             f"'start', x.start, 'no', {k}, 'kind', '{kind}', 'stop', x.stop))"
             for k, (kind, (p, g, n)) in enumerate(BASE.items())]
    at = at.withColumns({base: F.expr(f"array_sort(concat({', '.join(parts)}))"), runs: F.expr(spans(t, CANDIDATE))})
    at = at.withColumn(part, F.expr(f"flatten(transform({runs}, c -> {_pieces(allowed)}))"))
    at = at.withColumn(hot, F.expr(_scanned(part, thresholds, len(kinds))))
    count = lambda k: F.size(F.filter(base, lambda x: x["no"] == k)).cast("long")
    return at.select(*keep, *[count(k).alias(f"n_{kind}") for k, kind in enumerate(kinds)],
                     F.size(hot).cast("long").alias("n_entropy"), F.col(base).alias("base_spans"),
                     F.array_sort(F.concat(base, hot)).alias("all_spans"))


def joined(spans_column: str):
    """``kind:start:stop`` of every span, comma-joined."""
    return F.expr(f"array_join(transform({spans_column}, x -> concat_ws(':', x.kind, x.start, x.stop)), ',')")
