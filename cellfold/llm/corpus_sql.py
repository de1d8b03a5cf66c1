"""DuckDB SQL of the queries on repeated passages, the dataset manifest and
spelling variants."""

from __future__ import annotations

_WORDS = r"""[x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> '']"""

REPEATS = rf"""
WITH word AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS x
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM word WHERE len(w) > 12 AND doc_id IS NOT NULL)),
low AS (SELECT x, min(doc_id) AS low FROM win GROUP BY x),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM win JOIN low USING (x) WHERE doc_id > low),
per AS (SELECT r, count(*) AS n, list(p) AS p FROM gone GROUP BY r),
every AS (SELECT r, doc_id, w, coalesce(n, 0) AS n, coalesce(p, []) AS p FROM word LEFT JOIN per USING (r)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM word)
  LEFT JOIN (SELECT r, p AS i, true AS out FROM gone) USING (r, i) WHERE out IS NULL GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM every LEFT JOIN kept USING (r)
"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes, beside the one row of ``crc(t)``, the 256 remainders."""
    data = f"[4294967295::UBIGINT] || [('0x' || b)::UBIGINT FOR b IN regexp_extract_all(hex(encode({text})), '..')]"
    return (f"xor(list_reduce({data}, lambda a, b: xor(a >> 8, t[CAST(xor(a, b) & 255 AS INT) + 1])), "
            "4294967295::UBIGINT)")


CRC_TABLE = """crc(t) AS (SELECT list(list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b:
  CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) ORDER BY i) FROM range(256) r(i))"""

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    field = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
    return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def merkle(levels: int = 8) -> str:
    """Trees of up to 16 ** ``levels`` leaves a source and as many sources."""
    out = [f"WITH {CRC_TABLE}",
           f"leaf AS (SELECT row_number() OVER () AS r, doc_id, source AS s, {_leaf('text')} AS leaf, "
           f"CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {_leaf(_LOW.format('text'))} END AS changed FROM documents, crc)",
           "n0 AS (SELECT s, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, leaf AS h FROM leaf)",
           # own: position of the leaf's node; held: folded from the tampered leaf; sib: siblings so far
           "c0 AS (SELECT r, s, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, "
           "coalesce(changed, leaf) AS held, '' AS sib FROM leaf)"]
    def step(k, now, own):
        many = f"(SELECT s FROM {now} GROUP BY s HAVING count(*) > 1)"
        return [
            f"r{k} AS (SELECT a.s, a.p // 16 AS p, list(a.h ORDER BY a.p) AS kids FROM {now} a JOIN {many} m ON a.s IS NOT DISTINCT FROM m.s GROUP BY a.s, a.p // 16)",
            f"n{k} AS (SELECT s, p, sha256(array_to_string(kids, '')) AS h FROM r{k} UNION ALL "
            f"SELECT a.s, a.p, a.h FROM {now} a ANTI JOIN {many} m ON a.s IS NOT DISTINCT FROM m.s)",
            f"c{k} AS (SELECT c.r, c.s, CASE WHEN kids IS NULL THEN c.p ELSE c.p // 16 END AS p, "
            "CASE WHEN kids IS NULL THEN held ELSE sha256(array_to_string(kids[:c.p % 16] || [held] || kids[c.p % 16 + 2:], '')) END AS held, "
            "CASE WHEN kids IS NULL THEN sib ELSE sib || array_to_string(kids[:c.p % 16] || kids[c.p % 16 + 2:], '') END AS sib "
            f"FROM {own} c LEFT JOIN r{k} ON c.s IS NOT DISTINCT FROM r{k}.s AND c.p // 16 = r{k}.p)"]
    for k in range(1, levels + 1):
        out += step(k, f"n{k - 1}", f"c{k - 1}")
    out += [f"sub AS (SELECT s, h, row_number() OVER (ORDER BY encode(s) NULLS FIRST) - 1 AS p FROM n{levels})",
            "t0 AS (SELECT 0 AS s, p, h FROM sub)",
            f"d0 AS (SELECT c.r, 0 AS s, sub.p, held, sib FROM c{levels} c JOIN sub ON c.s IS NOT DISTINCT FROM sub.s)"]
    for k in range(1, levels + 1):
        out += [x.replace(f"r{k} ", f"u{k} ").replace(f"r{k}.", f"u{k}.").replace(f"n{k} AS", f"t{k} AS").replace(f"c{k} AS", f"d{k} AS")
                for x in step(k, f"t{k - 1}", f"d{k - 1}")]
    return ",\n".join(out) + f"""
SELECT doc_id, leaf, sub.h AS subroot, t.h AS root, sha256(d.sib) AS proof_sha256, d.held AS folded_root, d.held = t.h AS verified
FROM leaf JOIN d{levels} d USING (r) JOIN sub ON leaf.s IS NOT DISTINCT FROM sub.s CROSS JOIN t{levels} t
"""


SPELLING = rf"""
WITH RECURSIVE {CRC_TABLE},
run AS (SELECT doc_id, r, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOW.format("coalesce(text, '')")},
  '[a-zÀ-ÿ]+')) AS r FROM documents) GROUP BY ALL),
hashed AS (SELECT r, n, {crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r")} AS h FROM run, crc),
word AS (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM (SELECT n, CASE WHEN h % 199 = 0
    THEN substr(r, 1, CAST(h % length(r) AS INT)) || substr(r, CAST(h % length(r) AS INT) + 2) ELSE r END AS w FROM hashed)
  WHERE length(w) >= 6 GROUP BY w HAVING sum(n) >= 5),
cut AS (SELECT w, n, i, substr(w, 1, i - 1) AS x, substr(w, i + 1) AS y FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM word)),
pair AS (SELECT a.w AS u, b.w AS v FROM cut a JOIN cut b USING (x, y) WHERE a.w <> b.w
  UNION SELECT cut.w, word.w FROM cut JOIN word ON word.w = x || y
  UNION SELECT word.w, cut.w FROM cut JOIN word ON word.w = x || y),
near AS (SELECT u, count(*) AS n_near, min(struct_pack(down := -word.n, w := v)) AS best FROM pair JOIN word ON word.w = v GROUP BY u),
form AS (SELECT word.w, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.down >= 5 * n THEN best.w END AS form,
  CASE WHEN -best.down >= 5 * n THEN -best.down END AS form_n FROM word LEFT JOIN near ON u = word.w),
walk AS (SELECT w, w AS at FROM form UNION ALL SELECT walk.w, form.form FROM walk JOIN form ON form.w = walk.at WHERE form.form IS NOT NULL),
root AS (SELECT walk.w, walk.at AS root FROM walk JOIN form ON form.w = walk.at WHERE form.form IS NULL)
SELECT form.w AS word, form, root, n, n_near, form_n FROM form JOIN root USING (w)
"""
