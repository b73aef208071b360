"""Queries that apply the corpus operators to whole tables, and SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import (
    chat_format,
    decontaminate,
    e8_lattice,
    license_rules,
    odd_sketch,
    piece_lattice,
    pii_votes,
    pivot_search,
    quality_trees,
    relative_lz,
    residue_negatives,
    secret_ledger,
    whitening,
)
from cohortloom.llm.common import sha256_hex, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


# --- chat formatting ----------------------------------------------------------------------------

PROBE = "</s>[INST] ok [/INST]"


def _chat_sql() -> str:
    """The template's sizes and successions as literals; an escape is one sign per match."""
    controls = [
        *("[SYS]", "[/SYS]", "[INST]", "[/INST]", "<s>", "</s>", "[TOOL]", "[/TOOL]"),
        *("[TURN]", "[TEXT]", "[/TURN]"),
    ]
    inner = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in controls)
    return rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}')
), sized AS (
  SELECT *, len(text) + len(regexp_extract_all(text, '{inner}')) + CASE role
      WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'tool' THEN 13
      ELSE 19 + len(role) + len(regexp_extract_all(role, '{inner}')) END AS chars,
    coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), '') || '>' || role
      IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user',
          'assistant>tool', 'tool>assistant') AS good
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, bool_and(good) AS valid
FROM sized GROUP BY conv_id"""


@query(_chat_sql())
def op4_chat_format(spark, sf):
    columns = ["conv_id", "turn", "role", "text"]
    rows = [(-1, turn, role) for turn, role in enumerate(("user", "assistant"))]
    probe = spark.range(1).select(
        F.explode(F.array(*[F.struct(*map(F.lit, (*row, PROBE))) for row in rows])).alias("row")
    )
    probe = probe.select("row.*").toDF(*columns)
    chats = table(spark, sf, "conversations").select(*columns).union(probe)
    return chat_format.digests(chat_format.format_chats(chats))


# --- benchmark decontamination ------------------------------------------------------------------

DECONTAMINATE_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), want AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
    array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM item WHERE len(w) > 0)
), have AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc, (SELECT DISTINCT size FROM want))
), hit AS (
  SELECT doc_id, item_id, i, size FROM have JOIN want USING (size, gram)
), counted AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM hit) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN counted USING (doc_id) LEFT JOIN listed USING (doc_id)"""


@query(DECONTAMINATE_SQL)
def op5_decontaminate(spark, sf):
    return decontaminate.contamination(
        table(spark, sf, "documents"), table(spark, sf, "benchmark")
    ).drop("text_key")


# --- secret scans -------------------------------------------------------------------------------

SECRETS_SQL = r"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
rule(kind, rank, pattern, least) AS (VALUES
  ('assign', 0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 6),
  ('access', 1, '()(AKIA[A-Z0-9]+)', 20), ('hex', 2, '()([0-9a-f]+)', 24),
  ('private_key', 3, '()(-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=:,\x20\x09\x0A\x0D]+-----END [A-Z ]*PRIVATE KEY-----)', 60),
  ('provider', 4, '()((?:gh[pousr]_|github_pat_|glpat-|xox[abeprs]-|[sr]k_live_|npm_|AIza)[A-Za-z0-9_-]+)', 20),
  ('web_token', 5, '()(eyJ[A-Za-z0-9_-]{5,500}\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)', 30),
  ('login_url', 6, '()([A-Za-z][A-Za-z0-9+.-]{0,30}://[^\x00-\x20:@/]+:[^\x00-\x20:@/]+@[A-Za-z0-9.-]+)', 12)
), gap AS (
  SELECT doc_id, kind, rank, least, regexp_split_to_array(text, pattern) AS gaps,
    regexp_extract_all(text, pattern) AS matches, regexp_extract_all(text, pattern, 2) AS checked
  FROM doc, rule
), cell AS (
  SELECT doc_id, kind, rank, least, unnest(gaps[:len(matches)]) AS gap, unnest(matches) AS m,
    unnest(checked) AS c, unnest(range(len(matches))) AS i FROM gap
), span AS (
  SELECT *, sum(len(gap) + len(m)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM cell
), kept AS (
  SELECT doc_id, kind, rank, stop - len(m) AS start, stop FROM span WHERE len(c) >= least
), listed AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
    count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)
      FILTER (WHERE rank < 3) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM kept GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM doc LEFT JOIN listed USING (doc_id)"""


@query(SECRETS_SQL)
def op8_secret_ledger(spark, sf):
    return secret_ledger.digests(secret_ledger.scan(table(spark, sf, "documents")))


# --- license scans ------------------------------------------------------------------------------


def _licenses_sql() -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    sentences = ", ".join(f"({text(k)}, {text(v)})" for k, v in license_rules.SENTENCES.items())
    rules = ", ".join(
        f"({text(name)}, {text(',' + ','.join(ids) + ',')})" for name, ids in license_rules.RULES
    )
    norm = (
        "trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
        r" 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ')"
    )
    # a mark that no text holds stands for the look-behind
    return rf"""
WITH known AS (
  SELECT sentence_id, {norm.format("s")} AS sentence FROM (VALUES {sentences}) AS v(sentence_id, s)
), rule(name, chain) AS (VALUES {rules}), cut AS (
  SELECT doc_id, unnest(parts) AS s, unnest(range(len(parts))) AS i
  FROM (SELECT doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''),
      '([.!?;:])[\x20\x09-\x0D]+', '\1' || chr(1114109), 'g'), '[\x0A\x0D]+', chr(1114109), 'g'),
    chr(1114109)) AS parts FROM documents)
), seq AS (
  SELECT doc_id, count(*) AS n_known, string_agg(sentence_id, ',' ORDER BY i) AS sentence_ids
  FROM (SELECT doc_id, i, {norm.format("s")} AS sentence FROM cut) JOIN known USING (sentence)
  GROUP BY doc_id
), named AS (
  SELECT DISTINCT doc_id, name FROM seq JOIN rule ON contains(',' || sentence_ids || ',', chain)
), listed AS (
  SELECT doc_id, string_agg(name, ',' ORDER BY name) AS licenses FROM named AS a
  WHERE NOT (name = 'BSD-2-Clause' AND EXISTS (
    SELECT 1 FROM named AS b WHERE b.doc_id = a.doc_id AND b.name = 'BSD-3-Clause'))
  GROUP BY doc_id
)
SELECT doc_id, coalesce(n_known, 0) AS n_known, coalesce(sentence_ids, '') AS sentence_ids,
  coalesce(licenses, '') AS licenses
FROM documents LEFT JOIN seq USING (doc_id) LEFT JOIN listed USING (doc_id)"""


@query(_licenses_sql())
def op10_license_rules(spark, sf):
    return license_rules.licenses(table(spark, sf, "documents"))


# --- quality classifier -------------------------------------------------------------------------


@query()
def op1_quality_trees(spark, sf):
    return quality_trees.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


# --- SentencePiece encoding and decoding --------------------------------------------------------


@query()
def op3_piece_lattice(spark, sf):
    return piece_lattice.encode(table(spark, sf, "documents"), piece_lattice.load_pieces())


# --- MinHash near-duplicates --------------------------------------------------------------------


@query()
def op6_odd_sketch(spark, sf):
    return odd_sketch.near_duplicates(table(spark, sf, "documents"), width=3, percent=85)


# --- embedding near-duplicates ------------------------------------------------------------------


@query()
def op2_e8_lattice(spark, sf):
    return e8_lattice.near_duplicates(table(spark, sf, "embeddings"), least=0.9)


# --- personal data ------------------------------------------------------------------------------


@query()
def op9_pii_votes(spark, sf):
    return pii_votes.digests(pii_votes.detect(table(spark, sf, "documents")))


# --- substring dedup ----------------------------------------------------------------------------


@query()
def op7_relative_lz(spark, sf):
    return relative_lz.dedup(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", sha256_hex(F.col("kept")).alias("kept_sha256")
    )


# --- hard negatives -----------------------------------------------------------------------------

# vectors of whole numbers; a product of their doubles is exact
_WHOLE = """
  SELECT vec_id, {label} list_transform(embedding, lambda c: floor({scale} * c::DOUBLE)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0"""
_LABEL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,"

NEGATIVES_SQL = f"""
WITH e AS ({_WHOLE.format(scale=256, label=_LABEL)} AND label IS NOT NULL), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_dot_product(a.x, b.x)::BIGINT AS score
  FROM e AS a JOIN e AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (
    PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5"""


@query(NEGATIVES_SQL)
def op11_residue_negatives(spark, sf):
    rows = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return residue_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


# --- exact search -------------------------------------------------------------------------------

SEARCH_SQL = f"""
WITH e AS ({_WHOLE.format(scale=64, label="")})
SELECT a.vec_id AS query_id, (row_number() OVER (PARTITION BY a.vec_id
    ORDER BY list_dot_product(a.x, b.x) DESC, b.vec_id))::INTEGER AS rank,
  b.vec_id, list_dot_product(a.x, b.x)::BIGINT AS score
FROM e AS a JOIN e AS b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
QUALIFY rank <= 20"""


@query(SEARCH_SQL)
def op12_pivot_search(spark, sf):
    return pivot_search.search(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


# --- whitening ----------------------------------------------------------------------------------


@query()
def op13_whitening(spark, sf):
    rows = whitening.whiten(table(spark, sf, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))
