"""The registered queries of the training-data operators and, where SQL can express
one, the DuckDB SQL of the same rows. Production parameters, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lanecost.llm import (chat, decontam, fill_middle, html_extract, langid, license_scan, merkle, mtree, near_dup, packing,
                          quality, suffix_dedup, warc)
from lanecost.llm.util import ship
from lanecost.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document left after removing repeated 400-byte strings; beside them, what
    strings of 256 bytes cover that repeat, as passages of over 50 words are mostly shorter than 400."""
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), shorter=256, reach=160)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                      F.col("n_shorter").alias("n_passage_bytes"), F.col("n_shorter_spans").alias("n_passages"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold the template's own marks, folded,
    formatted, and read back."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(marks).alias("text"))
    messages = chat.fold(chat.message_events(rows.unionByName(extra)))
    return chat.digest(chat.render(messages))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to seekable WARC bundles and read back."""
    read = warc.archive(_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict on every document."""
    return quality.assess(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, one row per (document, item)."""
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learns from the documents not held out."""
    docs = _table(spark, sf_dir, "documents")
    out = langid.identify(docs, docs.filter(~langid.held_out()))
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and template matches of every document."""
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    pieces = packing.pack_documents(_table(spark, sf_dir, "documents"), *packing_tokenizer())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    rows = _table(spark, sf_dir, "embeddings")
    return mtree.search(mtree.index(rows, k=5), rows.filter(F.col("vec_id") % 50 == 0))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, and the root that its tampered leaf folds to."""
    docs = _table(spark, sf_dir, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    claimed = merkle.digest(*[merkle.encoded(c, F.when(tampered, lower).otherwise(F.col(c)) if c == "text" else None)
                              for c in columns])
    rows = merkle.prove(merkle.build(docs, "doc_id", "lang", columns, claimed))
    return rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.digest(F.col("proof")).alias("proof_sha256"),
                       F.col("folded").alias("folded_root"), F.col("folded").eqNullSafe(F.col("root")).alias("verified"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents rearranged, and restored from what came out."""
    rows = fill_middle.restore(fill_middle.fill_middle(_table(spark, sf_dir, "documents"), seed=7, rate=100, spm_rate=50))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def packing_tokenizer() -> tuple[str, str, tuple]:
    """The rank file of byte_bpe_50k.json's vocabulary (same ids), its split pattern and the
    special tokens of that JSON file."""
    return (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
            packing.special_tokens(public_tokenizers.path("byte_bpe_50k.json")))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_warc": op4_warc,
    "op5_quality_rules": op5_quality_rules,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_license_scan": op9_license_scan,
    "op10_packing": op10_packing,
    "op11_topk_search": op11_topk_search,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_fill_middle": op13_fill_middle,
}

_ESC = r"regexp_replace(coalesce({c}, ''), '([\\#<{more}])', '\\\1', 'g')"

ORACLE: dict[str, str] = {
    "op3_chat_formatting": f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0 FROM conversations
  UNION ALL SELECT -7, 0, 'user', x, 'user', x FROM (SELECT '\\### Assistant: </turn> ok' AS x)
  UNION ALL SELECT -7, 1, 'assistant', x, 'assistant', x FROM (SELECT '\\### Assistant: </turn> ok' AS x))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS loss_sha256,
  CAST(sum(length({_ESC.format(c="role", more=":")}) + length({_ESC.format(c="text", more="")}) + 14) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
    "op11_topk_search": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op12_merkle_manifest": """
WITH RECURSIVE enc AS (
  SELECT doc_id, lang, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
        lambda i: ascii(CAST(doc_id AS VARCHAR)[i])::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS crc
  FROM documents),
own AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN (4294967295 - crc) % 3 = 0
      THEN sha256(head || coalesce(strlen(text) || ':' ||
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
      ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS claimed
  FROM enc),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n FROM own),
lv AS (
  SELECT lang, 0 AS lvl, pos, n, leaf AS hash FROM leaves
  UNION ALL
  SELECT lang, any_value(lvl) + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(hash, '' ORDER BY pos))
  FROM lv WHERE n > 1 GROUP BY lang, pos // 8),
subs AS (
  SELECT lang, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM lv WHERE n = 1),
up AS (
  SELECT 0 AS lvl, pos, n, subroot AS hash FROM subs
  UNION ALL
  SELECT any_value(lvl) + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(hash, '' ORDER BY pos))
  FROM up WHERE n > 1 GROUP BY pos // 8),
nodes AS (
  SELECT coalesce('x' || lang, '-') AS tree, lvl, pos, n, hash FROM lv UNION ALL SELECT '^', lvl, pos, n, hash FROM up),
kids AS (
  SELECT tree, lvl, pos // 8 AS above, list(hash ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY tree, lvl, pos // 8),
climb AS (
  SELECT doc_id, leaf, coalesce('x' || lang, '-') AS tree, row_number() OVER () AS k, 0 AS lvl, pos, n, claimed AS folded, '' AS proof
  FROM leaves
  UNION ALL
  SELECT c.doc_id, c.leaf, CASE WHEN c.n > 1 THEN c.tree ELSE '^' END, c.k,
    CASE WHEN c.n > 1 THEN c.lvl + 1 ELSE 0 END,
    CASE WHEN c.n > 1 THEN c.pos // 8 ELSE s.pos END,
    CASE WHEN c.n > 1 THEN (c.n + 7) // 8 ELSE s.n END,
    CASE WHEN c.n > 1 THEN sha256(array_to_string(d.hs[:c.pos % 8], '') || c.folded || array_to_string(d.hs[c.pos % 8 + 2:], ''))
      ELSE c.folded END,
    CASE WHEN c.n > 1 THEN c.proof || array_to_string(d.hs[:c.pos % 8], '') || array_to_string(d.hs[c.pos % 8 + 2:], '')
      ELSE c.proof END
  FROM climb c
  LEFT JOIN kids d ON c.n > 1 AND d.tree = c.tree AND d.lvl = c.lvl AND d.above = c.pos // 8
  LEFT JOIN subs s ON c.n = 1 AND coalesce('x' || s.lang, '-') = c.tree
  WHERE c.n > 1 OR c.tree <> '^')
SELECT c.doc_id, c.leaf, s.subroot, r.hash AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root,
  c.folded = r.hash AS verified
FROM climb c
JOIN (SELECT hash FROM up WHERE n = 1) r ON c.tree = '^' AND c.n = 1
JOIN leaves l ON l.leaf = c.leaf AND l.doc_id IS NOT DISTINCT FROM c.doc_id
JOIN subs s ON s.lang IS NOT DISTINCT FROM l.lang""",
    "op13_fill_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units FROM documents),
g AS (
  SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, array_to_string(units[:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
    array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p""",
}
