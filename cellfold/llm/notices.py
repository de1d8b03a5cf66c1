"""Licence scan (operator 6): Dice coefficient over word bigrams.

A text is normalised: A-Z lower-cased, everything but ``a-z 0-9`` and line
breaks is a space. Its units are lines, paragraphs (lines up to a blank line,
joined), and windows of every notice's size in words, laid where an anchor of the
notice stands, so a notice may share its line with other text or span blank
lines. The set of a unit's word bigrams is compared with every template's,
``2 * shared / (bigrams of the unit + bigrams of the template)``; the sizes
alone bound the coefficient from above, which prunes templates before bigrams are compared.

A unit counts if it holds all the notice's distinguishing phrases (family,
version; the first is the anchor), none of those that only a sibling has, and
its coefficient is ``LEAST`` or more. An anchor that follows a negation (``not``,
``nor``, ``non``, ``never``, up to ``REACH`` words before it) is none. The best notice of
a unit wins: highest Dice, then most shared bigrams, then name.

One projection over whole texts, no shuffle; texts without an anchor take one
search. Defined cases: null and empty texts have no licence; A-Z are
lower-cased, everything but ``a-z 0-9`` parts words; repeated units count once;
repeated rows give equal results; other columns pass through, those named like
an output column are replaced.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellfold.llm.licenses import LEAST, bigrams_of
from cellfold.llm.licenses import TEMPLATES as T
from cellfold.llm.words import lower_ascii, text_of, unused_name

OUTPUT = ("n_units", "license", "dice", "matches")
REACH = 5  # words from a negation to the anchor, the anchor's first included


class Notice(NamedTuple):
    license: str
    text: str
    must: tuple[str, ...]  # phrases; the first is the anchor
    never: tuple[str, ...] = ()


_GNU_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by "
    "the Free Software Foundation, either version {v} of the License, or (at your option) any later version. This program is "
    "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.")
_GNU_SENTENCE = _GNU_HEADER.partition(" This program is distributed")[0]
_GNU_TITLE = ("{name} Version {v}, {date} Copyright (C) {years} Free Software Foundation, Inc. Everyone is permitted to copy and "
              "distribute verbatim copies of this license document, but changing it is not allowed.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. {third}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
        "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
        "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
        "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY "
        "OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
        "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_THIRD = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
          "products derived from this software without specific prior written permission. ")
_MIT_WARRANTY = (" THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
                 "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
                 "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
                 "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
                 "DEALINGS IN THE SOFTWARE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.")
_GPL, _LGPL, _AGPL = (f"GNU {x}General Public License" for x in ("", "Lesser ", "Affero "))

# id: names by which notices of one sentence call the licence
_NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "MIT": ("MIT License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License"), "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License"),
    "ISC": ("ISC License",),
    "MPL-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0"),
    **{f"{short}-{v}{zero}": (f"{name}, version {v}{zero if zero != '.0' else ''}", f"{name} v{v}{zero}")
       for short, name, v, zero in (("GPL", _GPL, 2, ".0"), ("GPL", _GPL, 3, ".0"), ("LGPL", _LGPL, 2, ".1"),
                                    ("LGPL", _LGPL, 3, ".0"), ("AGPL", _AGPL, 3, ".0"))},
}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_TAGS = ("Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0",
         "CC0-1.0", *(f"CC-{c}-4.0" for c in _CC))


def _plain(text: str) -> str:
    return " ".join(words_of(text))


def _notices() -> list[Notice]:
    out = [Notice("Apache-2.0", T["Apache-2.0-header"], ("apache license version 2 0",)),
           Notice("MIT", T["MIT-permission"], ("permission is hereby granted free of charge",)),
           Notice("MIT", T["MIT-permission"] + _MIT_WARRANTY, ("permission is hereby granted free of charge",)),
           Notice("BSD-2-Clause", _BSD.format(third=""), ("redistribution and use in source and binary forms",),
                  ("neither the name", "advertising materials")),
           Notice("BSD-3-Clause", _BSD.format(third=_THIRD), ("redistribution and use in source and binary forms", "neither the name"),
                  ("advertising materials",)),
           Notice("ISC", _ISC, ("for any purpose with or without fee", "provided that")),
           Notice("MPL-2.0", T["MPL-2.0"], ("mozilla public license v 2 0",))]
    for name, calls in _NAMES.items():
        for call in calls:
            out += [Notice(name, f"{start} the {call}", (_plain(call),))
                    for start in ("This work is licensed under", "Licensed under", "Released under", "Distributed under the terms of")]
    for short, name, v, date, years in (
            ("GPL-2.0", _GPL, "2", "June 1991", "1989, 1991"), ("GPL-3.0", _GPL, "3", "29 June 2007", "2007"),
            ("LGPL-2.1", _LGPL, "2.1", "February 1999", "1991, 1999"), ("LGPL-3.0", _LGPL, "3", "29 June 2007", "2007"),
            ("AGPL-3.0", _AGPL, "3", "19 November 2007", "2007")):
        # "version 2" is not "version 2.1"
        never = ("version 2 1",) if v == "2" else ()
        out += [Notice(short, t.format(name=name, v=v, date=date, years=years), (_plain(name), f"version {_plain(v)}"), never)
                for t in (_GNU_HEADER, _GNU_SENTENCE, _GNU_TITLE)]
    for code, long in _CC.items():
        tag = f"CC-{code}-4.0"
        out += [Notice(tag, f"Licensed under CC {code} 4.0", (_plain(f"CC {code} 4.0"),)),
                *(Notice(tag, f"Licensed under a Creative Commons {long} 4.0{end}", (_plain(f"Creative Commons {long} 4.0"),))
                  for end in (" International License", ""))]
    out += [Notice("CC0-1.0", "Creative Commons CC0 1.0 Universal", ("creative commons cc0 1 0",))]
    # identifiers are exact: the anchor is the whole line, and 'only' and 'or later' do not change the licence
    return out + [Notice(tag, f"SPDX-License-Identifier: {tag}", (_plain(f"SPDX-License-Identifier: {tag}"),),
                         tuple(_plain(f"SPDX-License-Identifier: {x}") for x in _TAGS if x.startswith(f"{tag}-"))) for tag in _TAGS]


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def holds(words: str, phrase: str) -> bool:
    return f" {phrase} " in words


NOTICES = _notices()


def _texts(items) -> str:
    return f"cast(array({', '.join(f"'{x}'" for x in items)}) as array<string>)"


def _table(notices) -> str:
    """SQL: the notices as an array. ``at`` has the words before each anchor."""
    rows = []
    for n in notices:
        w = words_of(n.text)
        line = f" {' '.join(w)} "
        assert all(holds(line, p) for p in n.must) and not any(holds(line, p) for p in n.never), n
        at = [line[:m.start()].count(" ") for m in re.finditer(f"(?= {n.must[0]} )", line)]
        rows.append(f"named_struct('name', '{n.license}', 'anchor', '{n.must[0]}', 'anchor_words', {n.must[0].count(' ') + 1}, "
                    f"'size', {len(w)}, 'at', array({', '.join(map(str, at))}), 'grams', {_texts(bigrams_of(n.text))}, "
                    f"'must', {_texts(n.must)}, 'never', {_texts(n.never)})")
    return f"array({', '.join(rows)})"


def find_notices(df: DataFrame, *, text: str = "text", notices=None, least: float = LEAST) -> DataFrame:
    """``df`` with ``n_units`` (long, units that match), ``license`` and
    ``dice`` (the best match; null and 0.0 without one) and ``matches``, the
    distinct matching units as an array of (dice, shared, license, unit), best first."""
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in OUTPUT]
    norm, flat, words, units, hits = unused_name(df, "_norm", "_flat", "_words", "_units", "_hits")
    notices = NOTICES if notices is None else notices
    table = _table(notices)
    anchors = "r' (" + "|".join(sorted({n.must[0] for n in notices})) + ") '"
    none = "cast(array() as array<string>)"
    # a negated anchor loses its first word, in all units alike
    negated = (rf"(?<![a-z0-9])((?:not|nor|non|never)(?:[ \n]+[a-z0-9]+){{0,{REACH - 1}}}?)[ \n]+(?:"
               + "|".join(sorted({n.must[0].replace(" ", r"[ \n]+") for n in notices})) + r")(?![a-z0-9])")
    # words before each anchor: every word of the padded text follows one space
    places = (f"aggregate(slice(p, 1, size(p) - 1), named_struct('n', 0, 'out', cast(array() as array<int>)), (a, x) -> "
              "named_struct('n', a.n + length(x) - length(replace(x, ' ', '')) + t.anchor_words, 'out', "
              "concat(a.out, array(a.n + length(x) - length(replace(x, ' ', ''))))), a -> a.out)")
    window = f"array_join(slice({words}, greatest(k - o, 0) + 1, t.size + least(k - o, 0)), ' ')"
    windows = (f"flatten(transform(filter({table}, t -> contains({flat}, concat(' ', t.anchor, ' '))), t -> flatten(transform("
               f"transform(array(split({flat}, concat(' ', t.anchor, '(?= )'), -1)), p -> {places})[0], "
               f"k -> transform(t.at, o -> {window})))))")
    lines = (f"transform(concat(split({norm}, r'\\n'), transform(split({norm}, r'\\n[ \\n]*\\n'), p -> translate(p, '\\n', ' '))), "
             "u -> trim(regexp_replace(u, ' +', ' ')))")
    grams = ("transform(array(split(trim(u), ' ')), w -> array_distinct(transform("
             "sequence(1, size(w) - 1), i -> concat(get(w, i - 1), ' ', get(w, i)))))[0]")
    fits = ("forall(t.must, m -> contains(u, concat(' ', m, ' '))) and not exists(t.never, m -> contains(u, concat(' ', m, ' '))) "
            "and 2 * least(size(g), size(t.grams)) >= {least}D * (size(g) + size(t.grams)) - 1e-9D").format(least=least)
    scored = ("transform(array(size(array_intersect(g, t.grams))), s -> named_struct("
              "'dice', 2D * s / (size(g) + size(t.grams)), 'shared', s, 'license', t.name, 'unit', trim(u)))[0]")
    best = f"transform(array({grams}), g -> array_max(transform(filter({table}, t -> {fits}), t -> {scored})))[0]"

    out = df.withColumn(norm, F.regexp_replace(lower_ascii(text_of(F.col(f"`{text}`"))), r"[^a-z0-9\n]+", " "))
    out = out.withColumn(norm, F.when(F.col(norm).rlike(negated), F.regexp_replace(norm, negated, "$1 "))
                         .otherwise(F.col(norm)))
    out = out.withColumn(flat, F.concat(F.lit(" "), F.trim(F.regexp_replace(norm, r"[ \n]+", " ")), F.lit(" ")))
    out = out.withColumn(words, F.expr(f"if({flat} rlike {anchors}, split(trim({flat}), ' '), {none})"))
    out = out.withColumn(units, F.expr(
        f"if(size({words}) = 0, {none}, filter(transform(array_distinct(concat({lines}, {windows})), u -> concat(' ', u, ' ')), "
        f"u -> u rlike {anchors}))"))
    out = out.withColumn(hits, F.expr(f"sort_array(filter(transform({units}, u -> {best}), b -> b.dice >= {least}D), false)"))
    top = F.get(hits, F.lit(0))
    return out.select(*keep, F.size(hits).cast("long").alias("n_units"), top["license"].alias("license"),
                      F.coalesce(top["dice"], F.lit(0.0)).alias("dice"), F.col(hits).alias("matches"))
