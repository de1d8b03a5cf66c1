"""MinHash near-duplicates with odd sketches (operator 1).

A document's set is its distinct shingles of five lower-cased words; documents
are linked when ``100 * intersection >= 75 * union``.

1. One pass turns every text into its set size, a 128-bit digest of the set,
   ``SAMPLES`` MinHash samples folded into band keys of ``ROWS`` samples, and an
   odd sketch: ``BITS`` parity bits, each sample flips one. Documents of equal
   digest are one class from here on, so exact copies are never paired.
2. Classes that share a band key are candidates. A bucket of up to ``SMALL``
   classes gives its pairs at once. In a larger one, such as a group of thousands
   of near copies, every class is paired with one leader only, the class that
   lies in most large buckets; links are contracted to components. Where a
   bucket still holds several components, the classes outside its largest one
   are held against all of the bucket in cells of about ``CELL`` by ``CELL``
   classes: a cell counts all its intersections with one matrix product over
   its full shingle sets and gives only the links that join components. So every
   pair of a bucket is tested or already connected, and no list of pairs is made.
3. Two odd sketches differ in at most two bits for every differing sample, so
   the population count of their XOR gives the similarity: with ``z`` bits it is
   estimated as ``1 + BITS / (4 * SAMPLES) * ln(1 - 2 z / BITS)``. Pairs whose
   count exceeds ``most_bits`` are dropped: a pair of similarity 0.75 exceeds it
   with a probability below 1e-9. The others are confirmed on their full sets,
   made again from whole texts.

A pair of similarity 0.75 shares no band with a probability of 5e-6; this is
the only inexact step.

Defined cases: a null or empty text, or one without words, has an empty set
and links with nothing; fewer than five words are one shingle; rows that
repeat an id are judged row by row, but sets with the same smallest id are one
node; rows with a null id are not compared, their component is null; an empty
table gives none. ``keep_first`` keeps every row of a kept id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellfold.llm import tokens
from cellfold.llm.components import components
from cellfold.session import Stages

WORDS, NEAR = 5, 75  # shingle length; percent of the union that the intersection must have
ROWS, BANDS, BITS = 4, 32, 1024
SAMPLES = ROWS * BANDS
SMALL = 16
CELL, CELL_SHINGLES, COLUMNS = 512, 200_000, 4096  # classes, shingles in a cell's side; columns of a product
_RANDOM = np.random.Generator(np.random.PCG64(11))
_A = _RANDOM.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of a chunk, sorted by both."""
    low = tokens.lower_ascii(raw)
    starts, ends = tokens.words(raw, bounds)
    word = tokens.hashes(low, starts, ends)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    n = len(bounds) - 1
    count = np.bincount(owner, minlength=n)
    first = np.cumsum(count) - count
    powers = tokens.powers(int(_STEP), WORDS + 1)
    whole = max(0, len(word) - WORDS + 1)
    full = np.zeros(whole, dtype=np.uint64)
    for j in range(WORDS):
        full += word[j:j + whole] * powers[j]
    inside = owner[:whole] == owner[WORDS - 1:] if whole else np.zeros(0, dtype=bool)
    # texts of fewer words: the whole sequence, told apart by its length
    short = np.flatnonzero((count > 0) & (count < WORDS))
    few = np.zeros(len(short), dtype=np.uint64)
    for j in range(WORDS - 1):
        has = count[short] > j
        few[has] += word[first[short[has]] + j] * powers[j]
    few = few * powers[WORDS] + count[short].astype(np.uint64)
    text = np.concatenate([owner[:whole][inside], short])
    value = tokens.mixed(np.concatenate([full[inside], few]))
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]


def sketch(column: pa.Array) -> dict[str, np.ndarray]:
    """Per text: set size, two digests, band keys, odd sketch (as numbers)."""
    sizes, digests, bands, odd = [], [], [], []
    for _, raw, bounds in tokens.chunks(column):
        n = len(bounds) - 1
        text, value = shingle_sets(raw, bounds)
        size = np.bincount(text, minlength=n)
        some = np.flatnonzero(size)
        at = (np.cumsum(size) - size)[some]
        two, key = np.zeros((n, 2), np.uint64), np.zeros((n, BANDS), np.uint64)
        bits = np.zeros((n, BITS // 64), np.uint64)
        if len(some):
            for k, salt in enumerate((0x1234567, 0x89ABCDE)):
                two[some, k] = np.add.reduceat(tokens.mixed(value ^ np.uint64(salt)), at)
            low = np.empty((len(some), SAMPLES), np.uint64)
            for i in range(SAMPLES):
                low[:, i] = np.minimum.reduceat((value * _A[i] + _B[i]) >> np.uint64(32), at)
            folded = np.zeros((len(some), BANDS), np.uint64)
            for j in range(ROWS):
                folded = tokens.mixed(folded + low[:, j::ROWS] + np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP)
            key[some] = folded
            spot = tokens.mixed(low + np.arange(SAMPLES, dtype=np.uint64) * _STEP) % np.uint64(BITS)
            flat = (np.arange(len(some))[:, None] * BITS + spot.astype(np.int64)).ravel()
            parity = (np.bincount(flat, minlength=len(some) * BITS) & 1).astype(np.uint8).reshape(len(some), BITS)
            bits[some] = np.packbits(parity, axis=1).view(np.uint64)
        sizes.append(size)
        digests.append(two)
        bands.append(key)
        odd.append(bits)
    if not sizes:
        return {"n": np.zeros(0, np.int64), "d": np.zeros((0, 2), np.int64), "bands": np.zeros((0, BANDS), np.int64),
                "odd": np.zeros((0, BITS // 64), np.int64)}
    return {"n": np.concatenate(sizes), "d": np.vstack(digests).view(np.int64), "bands": np.vstack(bands).view(np.int64),
            "odd": np.vstack(odd).view(np.int64)}


def _lists(matrix: np.ndarray) -> pa.Array:
    rows, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(matrix.ravel()))


def _sketch_batches(batches):
    for batch in batches:
        s = sketch(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(s["n"].astype(np.int64)), pa.array(s["d"][:, 0].copy()), pa.array(s["d"][:, 1].copy()),
             _lists(s["bands"]), _lists(s["odd"])], names=["doc_id", "n", "d1", "d2", "bands", "odd"])


def most_bits(error: float = 1e-9) -> int:
    """The largest popcount of two XORed sketches at which a pair may still be
    near: more differing samples than ``m`` have a probability below ``error`` at
    the threshold similarity, and ``m`` samples flip at most ``2 m`` bits."""
    p = 1 - NEAR / 100
    tail, m = 0.0, SAMPLES
    while m >= 0:
        tail += math.comb(SAMPLES, m) * p ** m * (1 - p) ** (SAMPLES - m)
        if tail > error:
            return 2 * m
        m -= 1
    return 0


def sketch_similarity(bits: int) -> float:
    """The similarity that a popcount of ``bits`` stands for."""
    return 1 + BITS / (4 * SAMPLES) * math.log(max(1 - 2 * bits / BITS, 1e-9))


def _differing(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _sizes_allow(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * NEAR


def _confirm_batches(batches):
    """(a, b, text of a, text of b) in; the pairs whose full sets are near out."""
    for batch in batches:
        sets = []
        for k in (2, 3):
            got = []
            for _, raw, bounds in tokens.chunks(batch.column(k)):
                text, value = shingle_sets(raw, bounds)
                cut = np.searchsorted(text, np.arange(len(bounds)))
                got += [value[i:j] for i, j in zip(cut, cut[1:])]
            sets.append(got)
        near = []
        for x, y in zip(*sets):
            both = len(np.intersect1d(x, y, assume_unique=True))
            near.append(bool(both) and 100 * both >= NEAR * (len(x) + len(y) - both))
        yield batch.select(["u", "v"]).filter(pa.array(near, pa.bool_()))


def _close(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (u, v) whose odd sketches allow a link."""
    odd = classes.select("cls", "odd")
    return (pairs.join(odd.select(F.col("cls").alias("u"), F.col("odd").alias("ou")), "u")
            .join(odd.select(F.col("cls").alias("v"), F.col("odd").alias("ov")), "v")
            .filter(_differing(F.col("ou"), F.col("ov")) <= most_bits()).select("u", "v"))


def _confirmed(close: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are near on their full sets."""
    both = (close.join(texts.select(F.col("id").alias("v"), F.col("text").alias("tv")), "v")
            .join(texts.select(F.col("id").alias("u"), F.col("text").alias("tu")), "u"))
    return both.select("u", "v", "tu", "tv").mapInArrow(_confirm_batches, "u long, v long").distinct()


def _set_batches(batches):
    """(cls, text) in, (cls, shingles) out."""
    for batch in batches:
        ends, values = [np.zeros(1, np.int64)], [np.zeros(0, np.uint64)]
        for _, raw, bounds in tokens.chunks(batch.column(1)):
            text, value = shingle_sets(raw, bounds)
            ends.append(ends[-1][-1] + np.searchsorted(text, np.arange(1, len(bounds))))
            values.append(value)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)),
                                         pa.array(np.concatenate(values).view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["cls", "shingles"])


def joining_links(sets: list[np.ndarray], comp: list[int], outside: list[bool]) -> list[tuple[int, int]]:
    """Links between an outside set and any other set of another component,
    as few as connect what they connect (positions in ``sets``)."""
    left = [i for i, x in enumerate(outside) if x]
    right = [i for i, x in enumerate(outside) if not x]
    size = np.array([len(s) for s in sets])
    lines = np.concatenate([sets[i] for i in left + right])
    owner = np.repeat(np.arange(len(sets)), size[left + right])
    _, column = np.unique(lines, return_inverse=True)
    in_left = np.zeros(column.max() + 1, dtype=bool)
    in_right = in_left.copy()
    in_left[column[owner < len(left)]] = True
    in_right[column[owner >= len(left)]] = True
    both = np.flatnonzero(in_left & in_right)  # shingles that can count
    place = np.full(len(in_left), -1)
    place[both] = np.arange(len(both))
    at = place[column]
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    for low in range(0, len(both), COLUMNS):
        here = (at >= low) & (at < low + COLUMNS)
        dense = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        dense[owner[here], at[here] - low] = 1
        shared += dense[:len(left)] @ dense[len(left):].T  # whole numbers below 2^24 are exact
    union = size[left][:, None] + size[right][None, :] - shared
    up = {c: c for c in comp}

    def root(c):
        while up[c] != c:
            up[c] = up[up[c]]
            c = up[c]
        return c
    out = []
    for i, j in np.argwhere(100 * shared.astype(np.int64) >= NEAR * union.astype(np.int64)):
        x, y = left[i], right[j]
        a, b = root(comp[x]), root(comp[y])
        if a != b:
            up[a] = b
            out.append((x, y))
    return out


def _link_cell(cell: pa.Table) -> pa.Table:
    sets = [np.asarray(x.values) for x in cell.column("shingles")]
    comp, cls = cell.column("comp").to_pylist(), cell.column("cls").to_pylist()
    outside = cell.column("outside").to_pylist()
    found = joining_links(sets, comp, outside) if any(outside) and not all(outside) else []
    return pa.table({"u": pa.array([cls[x] for x, _ in found], pa.int64()),
                     "v": pa.array([cls[y] for _, y in found], pa.int64())})


def _cells(large: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, i, j, outside, cls, comp): the sides of every cell of the buckets
    with several components."""
    named = (large.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
             .select("key", "cls", "n", F.coalesce("label", "cls").alias("comp")))
    parts = named.groupBy("key", "comp").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
    cells = lambda m, s: F.ceil(F.greatest(m / CELL, s / CELL_SHINGLES)).cast("int")
    opened = (parts.groupBy("key").agg(F.max(F.struct("m", "s", "comp")).alias("top"), F.sum("m").alias("m"),
                                       F.sum("s").alias("s"), F.count("*").alias("parts")).filter("parts > 1")
              .select("key", F.col("top.comp").alias("giant"), cells(F.col("m"), F.col("s")).alias("nj"),
                      cells(F.col("m") - F.col("top.m"), F.col("s") - F.col("top.s")).alias("ni")))
    rows = named.join(opened, "key")
    places = lambda n: F.sequence(F.lit(0), n - 1)
    inside = rows.select("key", F.explode(places(F.col("ni"))).alias("i"),
                         F.pmod(F.xxhash64("cls"), F.col("nj")).cast("int").alias("j"), F.lit(False).alias("outside"),
                         "cls", "comp")
    outside = rows.filter("comp != giant").select(
        "key", F.pmod(F.xxhash64("cls", F.lit(1)), F.col("ni")).cast("int").alias("i"),
        F.explode(places(F.col("nj"))).alias("j"), F.lit(True).alias("outside"), "cls", "comp")
    return inside.unionByName(outside)


def near_duplicates(df: DataFrame, stages: Stages, *, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (smallest id reachable over
    links) for every row of ``df``."""
    docs = df.select(F.col(ident).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    sketches = stages.save(docs.mapInArrow(
        _sketch_batches, "doc_id long, n long, d1 long, d2 long, bands array<long>, odd array<long>"), "near-sketches")
    some = sketches.filter("n > 0 and doc_id is not null")
    classes = stages.save(some.groupBy("n", "d1", "d2").agg(
        F.min("doc_id").alias("cls"), F.any_value("bands").alias("bands"), F.any_value("odd").alias("odd")), "near-classes")
    member = classes.select("cls", "n", F.explode("bands").alias("key"))
    shared = member.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    buckets = stages.save(member.join(shared, "key"), "near-buckets")

    # small buckets: all pairs; large ones: pairs with the leader
    small = buckets.filter(F.col("m") <= SMALL).select("key", F.col("cls").alias("u"), F.col("n").alias("nu"))
    direct = (small.join(small.select("key", F.col("u").alias("v"), F.col("nu").alias("nv")), "key")
              .filter((F.col("u") < F.col("v")) & _sizes_allow(F.col("nu"), F.col("nv"))).select("u", "v"))
    large = buckets.filter(F.col("m") > SMALL).select("key", "cls", "n")
    degree = large.groupBy("cls").agg(F.count("*").alias("degree"))
    lead = (large.join(degree, "cls").groupBy("key").agg(F.max(F.struct("degree", -F.col("cls"), "cls", "n")).alias("lead"))
            .select("key", F.col("lead.cls").alias("w"), F.col("lead.n").alias("nw")))
    star = (large.join(lead, "key").filter((F.col("cls") != F.col("w")) & _sizes_allow(F.col("n"), F.col("nw")))
            .select(F.least("w", "cls").alias("u"), F.greatest("w", "cls").alias("v")))
    close = stages.save(_close(direct.unionByName(star).distinct(), classes), "near-candidates")
    wanted = (close.select(F.col("u").alias("id")).union(close.select("v")).union(large.select("cls"))).distinct()
    texts = stages.save(docs.join(wanted, "id", "left_semi"), "near-texts")
    links = stages.save(_confirmed(close, texts), "near-links")
    labels = components(links, stages, "near-components")

    cells = stages.save(_cells(large, labels), "near-cells")
    if not cells.isEmpty():
        sets = texts.join(cells.select(F.col("cls").alias("id")).distinct(), "id", "left_semi").select(
            F.col("id").alias("cls"), "text").mapInArrow(_set_batches, "cls long, shingles array<long>")
        more = stages.save(cells.join(sets, "cls").groupBy("key", "i", "j").applyInArrow(
            _link_cell, "u long, v long").distinct(), "near-links")
        labels = components(links.unionByName(more), stages, "near-components")

    per_class = classes.select("n", "d1", "d2", "cls").join(labels.withColumnRenamed("node", "cls"), "cls", "left").select(
        "n", "d1", "d2", F.coalesce("label", "cls").alias("component_id"))
    ids = sketches.select("doc_id", "n", "d1", "d2").join(per_class, ["n", "d1", "d2"], "left")
    return ids.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce(
        F.when(F.col("n") > 0, F.col("component_id")), "doc_id")).alias("component_id"))


def keep_first(df: DataFrame, stages: Stages, *, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` whose id is the smallest of its component, and those
    without an id."""
    found = near_duplicates(df, stages, ident=ident, text=text)
    gone = found.filter("component_id < doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return df.join(gone, F.col(f"`{ident}`") == F.col("__gone"), "left_anti")
