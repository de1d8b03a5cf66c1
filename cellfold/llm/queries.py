"""Registered queries of the training-data operators, with DuckDB SQL where
SQL can express them."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellfold.llm import chat, corpus_sql, decontamination, merkle, near_dups, notices, quality, repeats, secrets, spelling, syncmers
from cellfold.llm.mixing import mix_sources
from cellfold.llm.resharding import reshard
from cellfold.llm.url_rules import judge_urls
from cellfold.llm.words import lower_ascii, n_words, text_of
from cellfold.session import Stages

OLD_SHARDS, NEW_SHARDS = 16, 24
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def byte_size(text) -> Column:
    return (F.octet_length(text_of(text)) + 8).cast("long")


def op1_near_duplicates(spark, d):
    found = near_dups.near_duplicates(table(spark, d, "documents"), Stages(spark))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op2_mix_sources(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return mix_sources(docs, Stages(spark), source=F.col("source"), size=F.col("size"), key=F.col("doc_id"))


def op3_secrets(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs)
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(secrets.joined("base_spans").cast("binary"), 256).alias("base_sha256"),
                        secrets.joined("all_spans").alias("spans"), "n_entropy")


def op4_syncmers(spark, d):
    t = text_of(F.col("text"))
    docs = table(spark, d, "documents").select("doc_id", t.alias("text"), syncmers.packed(syncmers.anchors(F.col("text"))).alias("marks"))
    pairs = syncmers.with_next(docs, ident="doc_id", values=["text", "marks"], names=["next_text", "next_marks"])
    pairs = pairs.withColumns({c: syncmers.unpacked(F.col(c)) for c in ("marks", "next_marks")})
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    out = pairs.select("doc_id", n.cast("long").alias("n_chars"), "marks", "next_marks", edited.alias("edited"))
    out = out.withColumn("edited_marks", syncmers.anchors(F.col("edited")))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      syncmers.printed(F.col("marks")).alias("fingerprint"),
                      syncmers.printed(F.col("edited_marks")).alias("edited_fingerprint"),
                      syncmers.likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
                      F.coalesce(syncmers.likeness(F.col("marks"), F.col("next_marks")), F.lit(0.0)).alias("near_next"),
                      F.array_join(F.col("marks.pos"), " ").alias("positions"))


def op5_decontaminate(spark, d):
    return decontamination.find_items(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op6_licenses(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return notices.find_notices(docs).select("doc_id", "n_units", "license", "dice")


def op7_reshard(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", byte_size(F.col("text")).alias("size"), F.crc32(text_of(F.col("text"))).alias("text_crc32"))
    placed = reshard(docs, old_shard=F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS)), size=F.col("size"),
                     key=F.col("doc_id"), n_new=NEW_SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "moved")


def held_out(ident: str) -> Column:
    return F.coalesce(F.crc32(F.col(ident).cast("string")) % 3 == 1, F.lit(False))


def op8_quality(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    forest = quality.train(docs, table(spark, d, "labels"), usable=~held_out("doc_id"))
    return quality.score(docs, forest).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_chat(spark, d):
    rows = table(spark, d, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.to_variant_object(F.struct("role", "text")).alias("record"))
    said = "</s>[INST] ok [/INST]"
    record = json.dumps({"messages": [{"role": "user", "content": said}, {"role": "assistant", "content": said}]})
    planted = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
                                    F.parse_json(F.lit(record)).alias("record"))
    turns = chat.canonical_turns(rows.unionByName(planted))
    return chat.read_back(chat.format_turns(turns))


def op10_url_rules(spark, d):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, d, "pages").select("page_id", "url"), rules).drop("url")


def op11_repeats(spark, d):
    out = repeats.remove_repeats(table(spark, d, "documents"), Stages(spark))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_merkle_manifest(spark, d):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = table(spark, d, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = merkle.leaf([lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in fields])
    every = merkle.manifest(docs, Stages(spark), ident="doc_id", group="source", fields=fields,
                            carried={"tampered": F.when(changed, lowered)})
    out = every.select("doc_id", "leaf", "subroot", "root",
                       merkle.digest(F.array_join(merkle.proof(F.col("path")), "")).alias("proof_sha256"),
                       merkle.folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_spelling_variants(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.explode(spelling.word_runs(F.col("text"))).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    docs = docs.select("run", h.alias("h"))
    word = F.when(F.col("h") % 199 == 0, spelling.without(F.col("run"), F.pmod("h", F.length("run").cast("long")).cast("int")))
    words = spelling.counted(docs.select(word.otherwise(F.col("run")).alias("word")), least_length=6, least_count=5)
    return spelling.variants(words, Stages(spark))


QUERIES = {f.__name__: f for f in (op1_near_duplicates, op2_mix_sources, op3_secrets, op4_syncmers, op5_decontaminate, op6_licenses, op7_reshard,
                               op8_quality, op9_chat, op10_url_rules, op11_repeats, op12_merkle_manifest,
                               op13_spelling_variants)}


ORACLE_SQL = {
    "op11_repeats": corpus_sql.REPEATS,
    "op12_merkle_manifest": corpus_sql.merkle(),
    "op13_spelling_variants": corpus_sql.SPELLING,
    "op1_near_duplicates": r"""
WITH RECURSIVE word AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM word WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM shingle a JOIN shingle b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT u, v FROM shared JOIN size a ON a.doc_id = u JOIN size b ON b.doc_id = v
  WHERE 100 * c >= 75 * (a.n + b.n - c)),
reach AS (SELECT doc_id AS u, doc_id AS v FROM documents
  UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
low AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM low LEFT JOIN size USING (doc_id)
""",
    "op9_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
shown AS (
  SELECT *, regexp_replace(replace(role, '\', '\\'), '([<\[])(\||/?s>|</?SYS>>|/?INST\])', '\1\\\2', 'g') AS r,
         regexp_replace(replace(text, '\', '\\'), '([<\[])(\||/?s>|</?SYS>>|/?INST\])', '\1\\\2', 'g') AS t
  FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>' || replace(r, chr(10), '\n') || chr(10) || t || '<|im_end|>' || chr(10))) AS BIGINT)
         AS formatted_chars
FROM shown GROUP BY conv_id
""",
    "op10_url_rules": r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1)
              ELSE '' END AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                          ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT page_id, host, path,
       (SELECT h || p FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        ORDER BY length(h || p) DESC LIMIT 1) AS rule,
       coalesce((SELECT v FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        ORDER BY length(h || p) DESC LIMIT 1), 'allow') AS verdict
FROM parts
""",
}
