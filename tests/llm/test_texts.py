"""Secrets (3), fingerprints (4), licences (6), chat (9) against plain Python."""

import hashlib
import math
import random
import re
import uuid
from collections import Counter

import pytest
from llm_cases import SF_MID, docs_of, edge_dir, rows  # noqa: F401
from pyspark.sql import functions as F

from cellfold.llm import chat, licenses, notices, secrets, syncmers


# ------------------------------------------------------------------ secrets

def base_spans(text):
    out = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def pieces(run):
    """(offset, piece) of what the allow-list leaves of a run, cut at its slashes."""
    word = re.compile(secrets.WORDS)
    kept, at = [], 0
    for segment in run.split("/"):
        out = ("/" in run and word.search(segment)) or any(re.search(p, segment) for p in secrets.ALLOWED)
        kept.append((at, segment, bool(out) and segment != ""))
        at += len(segment) + 1
    chars = list(run)
    for start, segment, out in kept:
        if out:  # with the slashes beside it
            for i in range(max(0, start - 1), min(len(chars), start + len(segment) + 1)):
                chars[i] = " "
    return [(m.start(), m[0]) for m in re.finditer("[^ ]{20,}", "".join(chars))]


def class_of(s):
    has = lambda p: re.search(p, s)
    if re.fullmatch("[0-9a-fA-F]*", s) and has("[0-9]") and has("[a-fA-F]"):
        return "hex"
    if has("[0-9]"):
        if has("[a-z]"):
            return "mixed" if has("[A-Z]") else "lower"
        return "upper" if has("[A-Z]") else "digits"
    return "letters" if has("[A-Za-z]") else "digits"


def entropy_spans(text):
    """Every window counted afresh."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", text):
        for offset, s in pieces(m[0]):
            kind = class_of(s)
            hot = []
            for i in range(len(s) - secrets.WINDOW + 1):
                counts = Counter(s[i:i + secrets.WINDOW]).values()
                if -sum(c / 20 * math.log2(c / 20) for c in counts) >= secrets.THRESHOLDS[kind]:
                    hot.append(i)
            if hot:
                out.append((m.start() + offset + hot[0], 3, "entropy_" + kind, m.start() + offset + hot[-1] + secrets.WINDOW))
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


def secret_texts():
    rng = random.Random(3)
    hexa = "".join(rng.choice("0123456789abcdef") for _ in range(40))
    key = "".join(rng.choice(secrets.ALPHABET[:62]) for _ in range(48))
    yield from [None, "", "é\U0001F600 token: " + key, f"PassWord='{hexa}' and {hexa}", "secret:token:abcdefgh", "api_key = short",
                "AKIA" + "Z" * 12 + " AKIA" + "Z" * 11, "xAKIAAKIAAKIAAKIA99" * 3, hexa[:31] + "g" + hexa, "a" * 300_000,
                "token = token=abcdefghij", str(uuid.UUID(int=rng.getrandbits(128))), "my-example-key-" + key, "deadbeef" * 8,
                "A1b" * 40 + key + "A1b" * 40, key * 30, "apikey\"  :  'a.b-c/d_e=f' passwd=", "toKen = abcdefghijkl", "toKEN=" + "\n" + key]
    for _ in range(60):
        yield "".join(rng.choice(["token", "=", ":", " ", '"', key, hexa, "AKIA", "Z9", "secret", "é", "f0", "\n", "/", "aB3"])
                      for _ in range(rng.randrange(30)))


def test_secret_spans_on_awkward_texts(spark):
    texts = list(secret_texts())
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, N_HEX string")
    out = secrets.find_secrets(df)
    got = {r["doc_id"]: r for r in out.select("doc_id", "n_assign", "n_access", "n_hex", "n_entropy",
                                               secrets.joined("base_spans").alias("b"), secrets.joined("all_spans").alias("s")).collect()}
    hot = 0
    for i, t in enumerate(texts):
        base, more = base_spans(t or ""), entropy_spans(t or "")
        hot += len(more)
        assert got[i]["b"] == joined(base), t
        assert got[i]["s"] == joined(sorted(base + more)), t
        kinds = Counter(k for _, _, k, _ in base)
        assert [got[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [kinds[k] for k in ("assign", "access", "hex")]
    assert hot > 20


@pytest.mark.parametrize("which", ["edge", SF_MID])
def test_op3_contract(which, edge_dir, rows, docs_of):  # noqa: F811
    folder = edge_dir if which == "edge" else which
    want = sorted(str((r["doc_id"], hashlib.sha256(joined(base_spans(r["text"] or "")).encode()).hexdigest(),
                       joined(sorted(base_spans(r["text"] or "") + entropy_spans(r["text"] or ""))))) for r in docs_of(folder))
    assert sorted(str((r["doc_id"], r["base_sha256"], r["spans"])) for r in rows("op3", folder)) == want


def test_every_class_is_scanned_and_only_segments_are_suppressed(spark):
    rng = random.Random(4)
    drawn = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    letters = "qWxZvKjTpLmRsYdFgHcBnEaUoI"
    hook = "T0A1B2C3D/B0A1B2C3D/aB3dE5fG7hJ9kL1mN3pQ5rS7"
    found = {  # text: class and piece that is scanned
        "JBSWY3DPEHPK3PXPJBSWY3DPEHPK3PXP": ("upper", "JBSWY3DPEHPK3PXPJBSWY3DPEHPK3PXP"),
        "é k3j9x0q2m7z5v8b1n4c6l0p9w2e5r7t1": ("lower", "k3j9x0q2m7z5v8b1n4c6l0p9w2e5r7t1"),
        letters: ("letters", letters), letters.lower()[:20]: ("letters", letters.lower()[:20]),
        "a9B8c7D6e5F4g3H2i1J0kL==": ("mixed", "a9B8c7D6e5F4g3H2i1J0kL"), "hooks.slack.com/services/" + hook: ("mixed", hook),
        "usr/local/" + letters + "/share": ("letters", letters), "31415926535897932384": ("digits", "31415926535897932384"),
        "example/a9B8c7D6e5F4g3H2i1J0/k3j9x0q2m7z5": ("mixed", "a9B8c7D6e5F4g3H2i1J0/k3j9x0q2m7z5"),
        "A1b" * 600 + letters + "7": ("mixed", "A1b" * 600 + letters + "7")}
    none = ["my-example-key-" + letters, "the/usual/directory/of/documents/with/long/names", "a" * 30_000, "A1b" * 40, "deadbeef" * 8,
            str(uuid.UUID(int=7 << 90)), "-" * 40, "src/main/java/org/" + str(uuid.UUID(int=rng.getrandbits(128))), letters[:19], "/" * 50,
            "0123456789abcdefghijklmnopqrstuvwxyz"]
    drawn_keys = [drawn(chars, 48) for chars in ("abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", letters,
                                                 "0123456789abcdef", secrets.ALPHABET) for _ in range(20)]
    texts = [*found, *none, *drawn_keys]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = {r["i"]: r for r in secrets.find_secrets(df).collect()}
    for i, t in enumerate(texts):
        spans = [(s["kind"].removeprefix("entropy_"), s["start"], s["stop"]) for s in got[i]["all_spans"] if s["no"] == 3]
        assert got[i]["n_entropy"] == len(spans)
        if t in none:
            assert not spans, t
        elif t in found:
            kind, piece = found[t]
            bits = [-sum(c / 20 * math.log2(c / 20) for c in Counter(piece[k:k + 20]).values()) for k in range(len(piece) - 19)]
            hot = [t.index(piece) + k for k, b in enumerate(bits) if b >= secrets.THRESHOLDS[kind]]
            assert spans == [(kind, hot[0], hot[-1] + 20)], t
    assert sum(bool(got[i]["n_entropy"]) for i in range(len(texts) - 100, len(texts))) >= 98


# ------------------------------------------------------------------ fingerprints

def closed(words, hashes, grams, k=syncmers.K, s=syncmers.S):
    """Positions of the closed syncmers by definition; ``grams[i]`` is the hash of the run at i."""
    if len(words) < k:
        return [0] if words else []
    return [i for i in range(len(words) - k + 1)
            if min(grams[i:i + k - s + 1]) in (grams[i], grams[i + k - s])]


def test_anchors_by_definition(spark):
    rng = random.Random(1)
    texts = ["", None, "one", "a b c d e", "the " * 40] + [" ".join(rng.choice("abcdefgh") * 2 for _ in range(n)) for n in range(6, 80, 7)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "")
    ex = df.select("i", syncmers.anchors(F.col("text")).alias("a"), words.alias("w")).collect()
    grams = {(r["a"], r["b"]): r["h"] for r in df.select(F.explode(words).alias("a")).distinct().crossJoin(
        df.select(F.explode(words).alias("b")).distinct()).select("a", "b", F.xxhash64(F.xxhash64("a"), F.xxhash64("b")).alias("h")).collect()}
    for r in ex:
        w = r["w"]
        assert [a["pos"] for a in r["a"]] == closed(w, None, [grams[p] for p in zip(w, w[1:])])
    # context-free: the anchors inside a passage do not depend on what surrounds it
    passage = " ".join(f"p{i}" for i in range(60))
    alone, inside = (spark.createDataFrame([(t,)], "t string").select(syncmers.anchors(F.col("t"))["hash"]).first()[0]
                     for t in (passage, "x y z " + passage + " q r"))
    assert " ".join(map(str, alone)) in " ".join(map(str, inside)) and len(alone) >= 55 // (syncmers.K - syncmers.S)


def plain_likeness(a, b):
    """Anchors (pos, hash): the most shared ones on a diagonal and the next, over the smaller set."""
    first = [{}, {}]
    for side, marks in zip(first, (a, b)):
        for pos, h in marks:
            side.setdefault(h, pos)
    if not first[0] or not first[1]:
        return float(first[0] == first[1])
    shifts = Counter((first[0][h] - first[1][h]) // syncmers.SHIFT for h in set(first[0]) & set(first[1]))
    return max((n + shifts[d + 1] for d, n in shifts.items()), default=0) / min(map(len, first))


def test_likeness_reads_positions(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(200)) for x in "pq")
    pairs = [(one, one), (one + " " + two, two + " " + one), (one, "x " * 300 + one), (one, one.replace("p90 ", "")), (one, two),
             ("a b", "a b"), ("a b " * 50, "b a " * 60), (None, ""), ("", one)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i long, a string, b string").select(
        "i", syncmers.anchors(F.col("a")).alias("a"), syncmers.anchors(F.col("b")).alias("b"))
    got = df.select("i", "a", "b", syncmers.likeness(F.col("a"), F.col("b")).alias("near")).orderBy("i").collect()
    assert [r["near"] for r in got] == [plain_likeness(r["a"], r["b"]) for r in got]
    near = [r["near"] for r in got]
    assert near[0] == near[5] == near[7] == 1 and near[4] == near[8] == 0
    assert near[1] < 0.6 and near[2] > 0.9 and near[3] > 0.9  # another order is not alike, a shift and a lost word are


@pytest.mark.parametrize("which", ["edge", SF_MID])
def test_op4_contract(spark, which, edge_dir, rows, docs_of, monkeypatch):  # noqa: F811
    monkeypatch.setattr(syncmers, "RANGE_ROWS", 3 if which == "edge" else 100)
    folder = edge_dir if which == "edge" else which
    docs, got = docs_of(folder), rows("op4", folder)
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in docs)
    ids = sorted({r["doc_id"] for r in docs if r["doc_id"] is not None})
    by = {r["doc_id"]: r["text"] or "" for r in docs}  # rows that share an id share the text here
    follow = dict(zip(ids, ids[1:] + ids[:1]))
    seen, marks = {}, lambda r: list(zip(map(int, r["positions"].split()), r["fingerprint"].split()))
    own, edited = {}, {}
    for r in got:
        own.setdefault(r["doc_id"], marks(r))
    changed = [(r["edited_sha256"], e) for r in got for f in {follow.get(r["doc_id"]), r["doc_id"]}
               for e in [by[r["doc_id"]][:(len(by[r["doc_id"]]) + 1) // 2] + (by[f] if f is not None else "")[:len(by[r["doc_id"]]) // 2]]
               if hashlib.sha256(e.encode()).hexdigest() == r["edited_sha256"]]
    frame = spark.createDataFrame(changed, "h string, t string").distinct().select("h", syncmers.anchors(F.col("t")).alias("a"))
    for r in frame.collect():
        edited[r["h"]] = [(a["pos"], f"{a['hash'] & 0xFFFFFFFF:08x}") for a in r["a"]]
    for r in got:
        text = by[r["doc_id"]]
        half = len(text) // 2
        edits = {text[:len(text) - half] + (by[follow[r["doc_id"]]] if r["doc_id"] is not None else "")[:half]}
        if r["doc_id"] == 16:  # twice there: one is followed by the other
            edits.add(text[:len(text) - half] + text[:half])
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] in {hashlib.sha256(e.encode()).hexdigest() for e in edits}
        assert seen.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert r["edited_fingerprint"].split() == [h for _, h in edited[r["edited_sha256"]]]
        assert r["near_edited"] == plain_likeness(marks(r), edited[r["edited_sha256"]])
        after = {follow[r["doc_id"]], *([16] if r["doc_id"] == 16 else [])} if r["doc_id"] is not None else set()
        assert r["near_next"] in ({plain_likeness(marks(r), own[f]) for f in after} or {0.0})
    long = [r for r in got if len(by[r["doc_id"]]) > 2000 and r["near_next"] < 0.2]
    if which != "edge":
        assert min(r["near_edited"] for r in long) > 0.3


def test_next_of_one_and_none(spark, edge_dir, rows):  # noqa: F811
    one = spark.createDataFrame([(5, "x")], "i long, t string")
    assert [r["n"] for r in syncmers.with_next(one, ident="i", values=["t"], names=["n"]).collect()] == ["x"]
    assert rows("op4", edge_dir + "/none") == [] and rows("op3", edge_dir + "/none") == [] and rows("op6", edge_dir + "/none") == []


# ------------------------------------------------------------------ licences

def plain_notices(text):
    """(units, license, dice) by comparing every unit with every notice, word by word."""
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    text = re.sub("[^a-z0-9\n]+", " ", text)
    # anchors behind a negation are taken out, the first in the text first
    words = [(m.start(), m.end(), m[0]) for m in re.finditer("[a-z0-9]+", text)]
    anchors = {tuple(n.must[0].split()) for n in notices.NOTICES}
    cut, i = [], 0
    while i < len(words):
        hit = None
        if words[i][2] in ("not", "nor", "non", "never"):
            for k in range(i + 1, min(len(words), i + 1 + notices.REACH)):
                hit = next((k + len(a) for a in sorted(anchors) if tuple(w for _, _, w in words[k:k + len(a)]) == a), None)
                if hit:
                    cut.append((words[k - 1][1], words[hit - 1][1]))
                    break
        i = hit or i + 1
    for a, b in reversed(cut):
        text = text[:a] + " " + text[b:]
    units = set(text.split("\n")) | {p.replace("\n", " ") for p in re.split("\n[ \n]*\n", text)}
    units = {" ".join(u.split()) for u in units}
    flat = text.split()
    for n in notices.NOTICES:
        anchor, own = n.must[0].split(), notices.words_of(n.text)
        at = [i for i in range(len(own)) if own[i:i + len(anchor)] == anchor]
        for k in range(len(flat)):
            if flat[k:k + len(anchor)] == anchor:
                units |= {" ".join(flat[max(0, k - o):max(0, k - o) + len(own) + min(k - o, 0)]) for o in at}
    hits = []
    for u in units:
        w = u.split()
        grams, found = set(zip(w, w[1:])), []
        for n in notices.NOTICES:
            if all(f" {m} " in f" {u} " for m in n.must) and not any(f" {m} " in f" {u} " for m in n.never):
                other = {tuple(g.split()) for g in licenses.bigrams_of(n.text)}
                found.append((2 * len(grams & other) / (len(grams) + len(other)), len(grams & other), n.license))
        if found and max(found)[0] >= licenses.LEAST:
            hits.append((*max(found), u))
    return len(hits), *((max(hits)[2], max(hits)[0]) if hits else (None, 0.0))


@pytest.mark.parametrize("which", ["edge", SF_MID])
def test_op6_equals_every_unit_against_every_notice(which, edge_dir, rows, docs_of):  # noqa: F811
    folder = edge_dir if which == "edge" else which
    want = [(r["doc_id"], *plain_notices(r["text"])) for r in docs_of(folder)]
    got = [tuple(r[k] for k in ("doc_id", "n_units", "license", "dice")) for r in rows("op6", folder)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert which == "edge" or sum(x[2] is not None for x in want) > 5


def test_notices_in_any_company(spark):
    rng = random.Random(6)
    bits = [n.text for n in notices.NOTICES] + ["not", "never", "nor", "and", "\n", "\n\n", "#", ".", "the code is", "see the notes"] * 12
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randrange(1, 9))) for _ in range(120)]
    texts += ["not licensed under the Apache License, Version 2.0", "It is not licensed under the MIT License.", "nor\nunder the MIT License",
              "Not here. A B C D E F. Released under the MIT License", "This work is licensed under the GNU Affero General Public License, version 3",
              "Licensed under CC BY-NC-ND 4.0", "not under the MIT License. Released under the MIT License", None, ""]
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in enumerate(texts)], "doc_id long, text string, Dice int, _flat int, _hits int")
    out = notices.find_notices(df)
    assert out.columns == ["doc_id", "text", "_flat", "_hits", "n_units", "license", "dice", "matches"]
    got = {r["doc_id"]: (r["n_units"], r["license"], r["dice"]) for r in out.collect()}
    assert got == {i: plain_notices(t) for i, t in enumerate(texts)}
    last = [got[i][1] for i in range(120, 129)]
    assert last == [None, None, None, "MIT", "AGPL-3.0", "CC-BY-NC-ND-4.0", "MIT", None, None]
    assert notices.find_notices(df.limit(0)).count() == 0


APACHE = ["Licensed under the Apache License, Version 2.0 (the \"License\");", "you may not use this file except in compliance with the License.",
          "You may obtain a copy of the License at", "", "    http://www.apache.org/licenses/LICENSE-2.0", "",
          "Unless required by applicable law or agreed to in writing, software", 'distributed under the License is distributed on an "AS IS" BASIS,',
          "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
          "See the License for the specific language governing permissions and", "limitations under the License."]


def test_notices_share_lines_and_span_blank_lines(spark):
    shared = ("The toolkit was written in 2019 by the team. Released under the MIT License. "
              "See the notes for details on how to build it.")
    apache = ["\n".join(["Copyright 2020 é", "", *(mark + x for x in APACHE), "", "import os"]) for mark in ("", "# ", " * ")]
    texts = [None, "", "no license", shared, *apache, "Licensed under CC BY 4.0\n" * 2000, "license " * 5000,
             shared + "\n\n" + apache[1], "This work is licensed under the GNU Affero General Public License, version 3."]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, Dice string")
    out = notices.find_notices(df)
    assert out.columns == ["doc_id", "text", "n_units", "license", "dice", "matches"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[i]["license"] for i in range(10)] == [None, None, None, "MIT", *["Apache-2.0"] * 3, "CC-BY-4.0", None, "Apache-2.0"]
    assert [got[i]["dice"] for i in range(10)] == [0.0, 0.0, 0.0, *[1.0] * 5, 0.0, 1.0]
    assert [m["unit"] for m in got[3]["matches"]] == ["released under the mit license"]
    assert {m["license"] for m in got[9]["matches"]} == {"MIT", "Apache-2.0"}
    assert max(m["shared"] for m in got[5]["matches"]) == len(licenses.bigrams_of(licenses.TEMPLATES["Apache-2.0-header"]))
    assert got[10]["license"] in (None, "AGPL-3.0")


def test_published_notices_and_their_siblings(spark):
    gnu = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
           "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
    want = {"This project is licensed under the MIT License.": "MIT", "Released under the BSD 2-Clause License.": "BSD-2-Clause",
            "// SPDX-License-Identifier: GPL-2.0-only\nint x;": "GPL-2.0", "# SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1",
            "/* SPDX-License-Identifier: MIT */": "MIT", gnu.format("", 3): "GPL-3.0", gnu.format("Affero ", 3): "AGPL-3.0",
            gnu.format("", 2): "GPL-2.0", gnu.format("Lesser ", "2.1"): "LGPL-2.1", gnu.format("Lesser ", 3): "LGPL-3.0",
            "This work is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
            "This work is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
            "This work is licensed under the GNU Frobnicated General Public License, version 3.": None,
            "This work is licensed under the GNU General Public License, version 4.": None, "We read about public licenses.": None,
            **{f"Licensed under CC {c} 4.0.": f"CC-{c}-4.0" for c in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")},
            "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "CC-BY-NC-SA-4.0"}
    want |= {"Copyright 1999 me\n\n" + n.text + "\n\nint main;": n.license for n in notices.NOTICES}
    df = spark.createDataFrame(list(enumerate(want)), "i long, text string")
    got = {r["text"]: r["license"] for r in notices.find_notices(df).collect()}
    assert got == want


# ------------------------------------------------------------------ chat

def test_layouts_meet_in_canonical_turns(spark):
    same = [("user", "hi\n</s>"), ("assistant", "a\\n<|im_end|>\n")]
    import json
    records = [
        {"messages": [{"role": r, "content": t} for r, t in same]},
        {"conversations": [{"from": {"user": "human", "assistant": "gpt"}[r], "value": t} for r, t in same]},
        {"prompt": same[0][1], "completion": same[1][1]}, {"instruction": same[0][1], "input": "", "output": same[1][1]},
        {"instruction": same[0][1], "input": None, "output": same[1][1]}]
    odd = [{"what": 1}, {"messages": "no list"}, [1], None]
    df = spark.createDataFrame([(i, 0, json.dumps(r)) for i, r in enumerate(records + odd)] + [(99, 0, "{broken"), (98, 0, None)],
                               "conv_id long, turn long, j string").withColumn("record", F.try_parse_json("j"))
    turns = chat.canonical_turns(df)
    got = {}
    for r in turns.orderBy("conv_id", "turn", "part").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {i: same for i in range(len(records))}
    assert {r["conv_id"] for r in chat.unmatched(df).select("conv_id").collect()} == {5, 6, 7, 8, 98, 99}
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    assert {r["turns_sha256"] for r in back.values()} == {hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in same).encode()).hexdigest()}
    assert {r["loss_chars"] for r in back.values()} == {len(same[1][1])}


def test_round_trip_of_hostile_turns(spark):
    rng = random.Random(9)
    bits = ["\\", "<|im_start|>", "<|im_end|>", "\n", "n", "\\n", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<", "|", "é",
            "\U0001F600", "user", "<|im_end|>\n<|im_start|>assistant\n", "\r", " ", '"', "\x00"]
    data = []
    for c in range(40):
        data += [(c if c else None, t, rng.choice(["user", "assistant", "system", "a\nb\\", None, "<|im_end|>"]),
                  rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randrange(12)))])) for t in range(rng.randrange(1, 6))]
    data += [(7, 3, "assistant", "tie"), (7, 3, "assistant", "tie")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").select(
        "conv_id", "turn", F.to_variant_object(F.struct("role", "text")).alias("record"))
    segments = chat.format_turns(chat.canonical_turns(df))
    texts = {r["segment"] for r in segments.collect()}
    assert all(s.count("<|im_end|>") == 1 and s.count("<|im_start|>") == 1 and "</s>" not in s and "[/INST]" not in s for s in texts)
    got = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    convs = {}
    for c, t, role, text in data:
        convs.setdefault(c, []).append((t, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(segments.limit(0)).count() == 0
