"""Positions of pattern matches as DataFrame expressions."""

from __future__ import annotations

SPANS = """
aggregate(
  arrays_zip(x.m, x.g, x.s),
  named_struct('at', 0, 'out', cast(array() as array<struct<start: int, stop: int, value: string>>)),
  (a, m) -> named_struct(
    'at', a.at + length(m.s) + length(m.m),
    'out', if({keep}, concat(a.out, array(named_struct(
      'start', a.at + length(m.s), 'stop', a.at + length(m.s) + length(m.m), 'value', m.m))), a.out)),
  a -> a.out)
"""


def quoted(pattern: str) -> str:
    return "r'" + pattern + "'" if "'" not in pattern else 'r"' + pattern + '"'


def spans(text: str, pattern: str, *, group: int = 0, least: int = 1) -> str:
    """SQL for the spans (start, stop, value) of the leftmost non-overlapping
    matches of ``pattern`` whose ``group`` has ``least`` characters: code
    points, ``stop`` exclusive. The lengths of matches and of the text between
    them give the positions. Texts without a match take one search."""
    p = quoted(pattern)
    found = SPANS.format(keep=f"length(m.g) >= {least}")
    return (f"if({text} rlike {p}, transform(array(named_struct("
            f"'m', regexp_extract_all({text}, {p}, 0), 'g', regexp_extract_all({text}, {p}, {group}), "
            f"'s', slice(split({text}, {p}, -1), 1, size(regexp_extract_all({text}, {p}, 0))))), x -> {found})[0], "
            "cast(array() as array<struct<start: int, stop: int, value: string>>))")
