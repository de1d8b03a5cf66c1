"""Benchmark decontamination by pigeonhole edit matching (operator 5).

Texts and test items are lower-cased with white space runs as one blank. An
item of ``m`` characters may occur with up to ``e = m // PIECE - 1`` edits (at
least none): it is cut into ``e + 1`` pieces of ``PIECE`` characters or more, and
since ``e`` edits touch at most ``e`` pieces, one piece at least occurs exactly in
every such occurrence. An Aho-Corasick automaton finds all piece hits in a
text in one walk; hits of an item on nearby diagonals share a window, and the
window is verified with Myers' bit-parallel edit distance.

Whole texts are searched in Arrow batches; nothing is shuffled. Items go to
the tasks in blocks of at most ``block_chars`` characters, one pass over the
documents a block, so neither tasks nor automata grow with the benchmark.

Defined cases: null and empty texts hold nothing, null and empty items are
never found; repeated items count once; several occurrences in one document
give one row, that of the fewest edits, the first of them; repeated documents
give equal rows; other columns pass through in ``drop_contaminated``.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 13
BLOCK_CHARS = 2_000_000


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def budget(m: int) -> int:
    """Edits allowed in an item of ``m`` characters."""
    return max(1, m // PIECE) - 1


def pieces(item: str) -> list[tuple[int, str]]:
    """The item in ``budget + 1`` consecutive pieces with their offsets."""
    n = budget(len(item)) + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def edit_matches(masks: dict[str, int], m: int, text: str):
    """Myers: for every end position in ``text`` the least edit distance of the
    pattern to a substring that ends there. ``masks`` has a bit per position of
    the pattern for each character."""
    ones, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = ones, 0, m
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        more = down | ~(xh | up)
        less = up & xh
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        more = (more << 1) & ones
        less = (less << 1) & ones
        up = (less | ~(xv | more)) & ones
        down = more & xv
        yield score


def masks_of(pattern: str) -> dict[str, int]:
    found: dict[str, int] = defaultdict(int)
    for k, c in enumerate(pattern):
        found[c] |= 1 << k
    return dict(found)


class Finder:
    """Finds a block of items, given as (id, normalised text), in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick
        self.items = items
        self.masks = [masks_of(t) for _, t in items]
        at: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, t) in enumerate(items):
            for offset, piece in pieces(t):
                at[piece].append((k, offset))
        self.walk = ahocorasick.Automaton()
        for piece, places in at.items():
            self.walk.add_word(piece, (len(piece), places))
        self.walk.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Per item, the merged windows of the text that hold every occurrence
        of which a piece was hit."""
        hits: dict[int, list[int]] = defaultdict(list)
        if self.items and text:
            for end, (n, places) in self.walk.iter(text):
                for k, offset in places:
                    hits[k].append(end + 1 - n - offset)
        out = {}
        for k, starts in hits.items():
            m = len(self.items[k][1])
            e = budget(m)
            merged: list[list[int]] = []
            for s in sorted(set(starts)):
                lo, hi = max(0, s - e), min(len(text), s + m + e)
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(hi, merged[-1][1])
                else:
                    merged.append([lo, hi])
            out[k] = merged
        return out

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, edits, start, end) in the normalised text, per item the
        occurrence of fewest edits, the first to end of these."""
        text = normal(text)
        found = []
        for k, spans in self.windows(text).items():
            ident, item = self.items[k]
            m, best = len(item), None
            for lo, hi in spans:
                at = text.find(item, lo, hi)
                if at >= 0:
                    best = (0, at, at + m)
                    break
                for end, d in enumerate(edit_matches(self.masks[k], m, text[lo:hi]), lo + 1):
                    if d <= budget(m) and (best is None or d < best[0]):
                        best = (d, None, end)
            if best:
                d, start, end = best
                if start is None:  # the longest match that ends there, from the reversed texts
                    back = text[max(0, end - m - d):end][::-1]
                    ends = [i for i, x in enumerate(_anchored(item[::-1], back)) if x == d]
                    start = end - ends[-1]
                found.append((ident, d, start, end))
        return found


def _anchored(pattern: str, text: str) -> list[int]:
    """Edit distance of the pattern to every prefix of ``text``."""
    row = list(range(len(pattern) + 1))
    out = [row[-1]]
    for j, c in enumerate(text, 1):
        last, row[0] = row[0], j
        for i, p in enumerate(pattern, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (p != c))
        out.append(row[-1])
    return out


def item_blocks(items: DataFrame, *, ident: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS):
    """Blocks of (id, normalised text), read one after another."""
    rows = items.select(F.col(ident).cast("long"), F.col(text).cast("string")).filter(F.col(text).isNotNull()).distinct()
    block, size, seen = [], 0, False
    for i, t in rows.orderBy(ident, text).toLocalIterator():
        t = normal(t)
        if not t:
            continue
        if block and size + len(t) > block_chars:
            seen = True
            yield block
            block, size = [], 0
        block.append((i, t))
        size += len(t)
    if block or not seen:
        yield block


_FINDERS: dict[int, Finder] = {}


def _finder(shared) -> Finder:
    """The automaton of a broadcast block, built once a Python worker."""
    key = shared.value["key"]
    if key not in _FINDERS:
        _FINDERS.clear()
        _FINDERS[key] = Finder(shared.value["items"])
    return _FINDERS[key]


def _shared(df: DataFrame, block):
    """A block in a broadcast variable: at most ``block_chars`` characters, or
    one item."""
    return df.sparkSession.sparkContext.broadcast({"key": hash(tuple(block)), "items": block})


def find_items(docs: DataFrame, items: DataFrame, *, ident: str = "doc_id", text: str = "text",
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document row and item found: ``doc_id``, ``item_id``, ``edits``,
    ``start_char`` and ``end_char`` in the normalised text."""
    out = None
    for block in item_blocks(items, block_chars=block_chars):
        shared = _shared(docs, block)

        def rows(batches, shared=shared):
            finder = _finder(shared)
            for batch in batches:
                got = [(i, *hit) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                       if t for hit in finder.find(t)]
                names = ["doc_id", "item_id", "edits", "start_char", "end_char"]
                yield pa.RecordBatch.from_pylist([dict(zip(names, g)) for g in got], pa.schema(
                    [(n, pa.int32() if n == "edits" else pa.int64()) for n in names]))

        part = docs.select(F.col(ident).cast("long"), F.col(text).cast("string")).mapInArrow(
            rows, "doc_id long, item_id long, edits int, start_char long, end_char long")
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, *, text: str = "text",
                      block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no item is found, in one pass a block."""
    for block in item_blocks(items, block_chars=block_chars):
        shared = _shared(docs, block)
        at = docs.columns.index(text)

        def rows(batches, shared=shared, at=at):
            finder = _finder(shared)
            for batch in batches:
                texts = batch.column(at).cast(pa.string()).to_pylist()
                yield batch.filter(pa.array([not t or not finder.find(t) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(rows, docs.schema)
    return docs
