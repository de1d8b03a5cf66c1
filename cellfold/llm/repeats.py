"""Repeated passages removed, by recompression (operator 11).

A window is ``WINDOW`` consecutive words of one text. A word goes if some window
that covers it also starts in a text with a smaller id.

1. Recompression names tokens by content alone, so all tasks give the same
   names without asking each other: runs of one word become a symbol of (word,
   length); then, twice, all symbols fall into left and right ones by a bit of
   their hash, and every left symbol followed by a right one becomes a symbol of the
   pair. What a symbol is depends on a few words around it, its context. Where the
   context lies inside a repeated passage, the same symbols appear in every copy.
2. Every window takes as its anchor the symbol of the highest level whose context lies
   inside the window, of several the one of least hash; a window without one
   is its own anchor. The anchor depends on the window's words alone, so equal
   windows have equal anchors. Neighbouring windows mostly share one: there is an
   anchor for about five words. Its key is a hash of the words of its context.
3. Spark names the keys globally: one aggregation gives every key's smallest id,
   the keys that only one text has are dropped, and a hash over all words of the
   windows at an anchor (its block) says whether the key stands for one and the
   same block everywhere. Then the blocks of all but the smallest id are repeats,
   with no further work. This settles the inside of long passages and of copies.
4. Where blocks differ, at the ends of passages, the windows themselves are held
   against each other: 128-bit hashes of their words, one aggregation for the
   smallest id, one join back.
5. A last pass over the texts joins every text's own keys and windows to it,
   finds their positions again and writes the kept words.

Texts move twice (steps 4 and 5), in shuffles on the id. Windows are
judged on the input. Nothing is collected to the driver, no key's rows meet in one
list: aggregations combine before the shuffle, and the joins back to (key, id)
rows are plain ones on shuffled sides, which adaptive execution splits.

Defined cases: null and empty texts have no words; texts of fewer than ``WINDOW``
words have no window; rows with one id share their removals and never remove from each other;
rows with a null id neither lose words nor take them from others; repeated rows
stay repeated; an empty table gives none. Columns other than id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellfold.functions.names import qcol
from cellfold.llm import tokens
from cellfold.session import Stages

WINDOW = 13
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd: they have inverses modulo 2^64
_SALTS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))
_ODD = np.uint64(0xD6E8FEB86659FD93)


class _Sums:
    """Hashes of slices of a word sequence from prefix sums."""

    def __init__(self, word: np.ndarray, base: int):
        n = len(word)
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(word * tokens.powers(base, n), out=self.total[1:])
        self.back = tokens.powers(pow(base, -1, 1 << 64), n + 1)

    def slices(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        raw = (self.total[stop] - self.total[start]) * self.back[start]
        return tokens.mixed(raw + (stop - start).astype(np.uint64) * _ODD)


def _runs_of(word: np.ndarray, owner: np.ndarray) -> dict[str, np.ndarray]:
    """Maximal runs of one word in one text; their context reaches one word further."""
    new = np.ones(len(word), dtype=bool)
    new[1:] = (word[1:] != word[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(word))
    size = (stop - start).astype(np.uint64)
    sym = np.where(size > 1, tokens.mixed(word[start] * _ODD + size), word[start])
    return {"sym": sym, "from": start - 1, "to": stop + 1, "own": owner[start]}


def _pairs_of(s: dict[str, np.ndarray], salt: np.uint64) -> dict[str, np.ndarray]:
    """Every left symbol and the right one behind it become one. A pair needs no
    more context than its symbols; a symbol that stays needs that of the
    neighbour which did not fit."""
    sym, own = s["sym"], s["own"]
    right = (tokens.mixed(sym ^ salt) & np.uint64(1)).astype(bool)
    pair = np.zeros(len(sym), dtype=bool)
    pair[:-1] = ~right[:-1] & right[1:] & (own[:-1] == own[1:])
    keep = np.ones(len(sym), dtype=bool)
    keep[1:] = ~pair[:-1]
    first = np.flatnonzero(keep)
    paired = pair[first]
    last = first + paired
    named = np.where(paired, tokens.mixed(sym[first] * _ODD + tokens.mixed(sym[last])), sym[first])
    # a symbol at the edge of a text has a context that reaches past the edge already
    ahead = np.minimum(first + 1, len(sym) - 1)
    behind = np.maximum(first - 1, 0)
    looks_ahead = ~right[first] & ~paired & (own[ahead] == own[first])
    looks_back = right[first] & (own[behind] == own[first])
    return {"sym": named, "from": np.where(looks_back, s["from"][behind], s["from"][first]),
            "to": np.where(looks_ahead, s["to"][ahead], s["to"][last]), "own": own[first]}


class Windows:
    """The windows of a chunk of texts: ``at`` (first word), ``key`` of the
    anchor, ``block`` number; ``owner`` of every word."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray):
        starts, ends = tokens.words(raw, bounds)
        self.owner = np.searchsorted(bounds, starts, side="right") - 1
        word = tokens.hashes(raw, starts, ends)
        n = len(word)
        self.n_words = np.bincount(self.owner, minlength=len(bounds) - 1)
        last = WINDOW - 1
        self.at = np.flatnonzero(self.owner[:n - last] == self.owner[last:]) if n > last else np.zeros(0, np.int64)
        if not len(self.at):
            self.key, self.block = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            return
        self.sums = [_Sums(word, base) for base in _BASES]
        once = _pairs_of(_runs_of(word, self.owner), _SALTS[0])
        twice = _pairs_of(once, _SALTS[1])
        # windows are their own anchors unless a symbol fits, the higher level first
        choice = self.at.copy()
        self.key = self.sums[0].slices(self.at, self.at + WINDOW)
        open_, before = np.arange(len(self.at)), n
        for level, s in ((2, twice), (1, once)):
            found, symbol = self._anchors(s, open_)
            key = self.sums[0].slices(np.maximum(s["from"][symbol], 0), np.minimum(s["to"][symbol], n))
            self.key[open_[found]] = tokens.mixed(key + np.uint64(level))
            choice[open_[found]] = before + symbol
            before += len(s["sym"])
            open_ = open_[~found]
        change = np.ones(len(choice), dtype=bool)
        change[1:] = choice[1:] != choice[:-1]
        self.block = np.cumsum(change) - 1

    def _anchors(self, s: dict[str, np.ndarray], some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of some windows hold the context of a symbol, and for those, the
        symbol of least hash. Contexts are ordered by both ends."""
        at = self.at[some]
        low = np.searchsorted(s["from"], at, side="left")
        n = np.searchsorted(s["to"], at + WINDOW, side="right") - low
        found = n > 0
        low, n = low[found], n[found]
        rank = tokens.mixed(s["sym"] + _ODD)
        best = low.copy()
        for j in range(1, int(n.max()) if len(n) else 0):
            more = np.flatnonzero(n > j)
            better = more[rank[low[more] + j] < rank[best[more]]]
            best[better] = low[better] + j
        return found, best

    def blocks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, key, hash of all words) of every block."""
        if not len(self.at):
            return self.at, self.key, self.key
        first = np.flatnonzero(np.append(True, self.block[1:] != self.block[:-1]))
        last = np.append(first[1:], len(self.at)) - 1
        return self.owner[self.at[first]], self.key[first], self.sums[1].slices(self.at[first], self.at[last] + WINDOW)

    def hashes(self, some: np.ndarray) -> list[np.ndarray]:
        return [s.slices(self.at[some], self.at[some] + WINDOW) for s in self.sums]

    def listed(self, value: np.ndarray, some: np.ndarray, lists: pa.Array) -> np.ndarray:
        """Which of some windows have their value in the list of their text."""
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        flat = np.asarray(lists.flatten()).view(np.uint64)
        if not len(flat):
            return np.zeros(len(some), dtype=bool)
        of = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))
        # text numbers of a chunk are small: a value and its text make one number
        mark = lambda v, t: tokens.mixed(v + t.astype(np.uint64) * _ODD)
        return np.isin(mark(value, self.owner[self.at[some]]), mark(flat, of))


def _distinct(text: np.ndarray, *values: np.ndarray) -> np.ndarray:
    mark = text.astype(np.uint64)
    for v in values:
        mark = tokens.mixed(mark * _ODD + v)
    return np.unique(mark, return_index=True)[1]


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _block_batches(batches):
    """(id, text) in; (id, key, hash of the block) out, distinct per text."""
    for batch in batches:
        for first, raw, bounds in tokens.chunks(batch.column(1)):
            text, key, block = Windows(raw, bounds).blocks()
            one = _distinct(text, key, block)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text[one] + first)), _longs(key[one]),
                                              _longs(block[one])], names=["id", "key", "block"])


def _key_batches(batches):
    """(id, text) in; (id, key) out, distinct per text."""
    for batch in batches:
        for first, raw, bounds in tokens.chunks(batch.column(1)):
            text, key, _ = Windows(raw, bounds).blocks()
            one = _distinct(text, key)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text[one] + first)), _longs(key[one])],
                                             names=["id", "key"])


def _window_batches(batches):
    """(id, text, open keys) in; (id, two hashes) of the windows at these keys out."""
    for batch in batches:
        for first, raw, bounds in tokens.chunks(batch.column(1)):
            w = Windows(raw, bounds)
            every = np.arange(len(w.at))
            some = np.flatnonzero(w.listed(w.key, every, batch.column(2).slice(first, len(bounds) - 1))) if len(every) else every
            if not len(some):
                continue
            h = w.hashes(some)
            text = w.owner[w.at[some]]
            one = _distinct(text, *h)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text[one] + first)), _longs(h[0][one]),
                                              _longs(h[1][one])], names=["id", "h1", "h2"])


def _kept_batches(batches):
    """(id, text, keys, windows that go) in; (id, kept text, words, words removed) out."""
    for batch in batches:
        kept, n_words, n_removed = [], [], []
        for first, raw, bounds in tokens.chunks(batch.column(1)):
            n = len(bounds) - 1
            w = Windows(raw, bounds)
            gone = np.zeros(len(w.owner) + 1, dtype=np.int64)
            if len(w.at):
                every = np.arange(len(w.at))
                out = w.listed(w.key, every, batch.column(2).slice(first, n))
                lists = batch.column(3).slice(first, n)
                if len(lists.flatten()):
                    out |= w.listed(w.hashes(every)[0], every, lists)
                np.add.at(gone, w.at[out], 1)
                np.add.at(gone, w.at[out] + WINDOW, -1)
            gone = np.cumsum(gone)[:-1] > 0
            removed = np.bincount(w.owner[gone], minlength=n)
            upto = np.cumsum(w.n_words)
            data = raw.tobytes()
            for i in range(n):
                words = data[bounds[i]:bounds[i + 1]].split()
                if removed[i]:
                    lost = gone[upto[i] - w.n_words[i]:upto[i]].tolist()
                    words = [x for x, g in zip(words, lost) if not g]
                kept.append(b" ".join(words))
            n_words.append(w.n_words)
            n_removed.append(removed)
        flat = lambda a: pa.array(np.concatenate(a).astype(np.int64) if a else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()).cast(pa.string()), flat(n_words),
                                          flat(n_removed)], names=["id", "kept", "n_words", "n_removed"])


def remove_repeats(df: DataFrame, stages: Stages, *, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``ident``, ``kept`` (the words that stay, joined by one space), ``n_words``
    and ``n_removed`` for every row of ``df``."""
    docs = df.select(qcol(ident).cast("long").alias("id"), qcol(text).cast("string").alias("text"))
    named = docs.where("id is not null")
    # which keys stand in several texts, and whether for one block
    keys = named.mapInArrow(_block_batches, "id long, key long, block long").groupBy("key").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), (F.min("block") != F.max("block")).alias("open"))
    shared = stages.save(keys.where("low < high").select("key", "low", "open"), "repeat-keys")
    marked = (named.mapInArrow(_key_batches, "id long, key long").join(shared, "key")
              .where("open or id > low").groupBy("id").agg(
                  F.collect_list(F.when(~F.col("open"), F.col("key"))).alias("gone"),
                  F.collect_list(F.when(F.col("open"), F.col("key"))).alias("open")))
    marked = stages.save(marked, "repeat-marks")
    # the windows at the keys that stand for several blocks
    unclear = marked.where(F.size("open") > 0).select("id", "open")
    windows = stages.save(named.join(unclear, "id").select("id", "text", "open").mapInArrow(
        _window_batches, "id long, h1 long, h2 long"), "repeat-windows")
    seen = windows.groupBy("h1", "h2").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    lost = stages.save(windows.join(seen.select("h1", "h2", "low"), ["h1", "h2"]).where("id > low")
                       .groupBy("id").agg(F.collect_list("h1").alias("lost")), "repeat-lost")

    none = F.array().cast("array<bigint>")
    full = (named.join(marked.where(F.size("gone") > 0).select("id", "gone"), "id", "left").join(lost, "id", "left")
            .select("id", "text", F.coalesce("gone", none).alias("gone"), F.coalesce("lost", none).alias("lost")))
    plain = docs.where("id is null").select("id", "text", none.alias("gone"), none.alias("lost"))
    out = full.unionByName(plain).mapInArrow(_kept_batches, "id long, kept string, n_words long, n_removed long")
    return out.withColumnRenamed("id", ident)
