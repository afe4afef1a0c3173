"""The queries of the corpus operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surestar.llm import (
    alignment, ann, chat, fingerprints, html_extraction, lm, minhash_dedup, mixing, packing, quality, repair, simhash_dedup, token_files,
)
from surestar.llm.common import read, store, word_count

ACCEPTED = 0.3  # least score of a document that counts as good
TOKENIZERS = "/opt/tokenizers"  # folder of the vocabulary files unless the session's spark.surestar.tokenizers names another


def vocabulary(spark: SparkSession, name: str) -> str:
    return f"{spark.conf.get('spark.surestar.tokenizers', TOKENIZERS)}/{name}"


def remainder(divisor: int) -> Column:
    """Remainder of the checksum of the id as text; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(divisor))


def op1_html(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extract_pages(read(spark, folder, "pages"))


def op2_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    scored = lm.score_texts(read(spark, folder, "documents"), remainder(7) != 2)
    return scored.withColumn("held_out", remainder(7) == 2)


def op4_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one whose texts look like control strings."""
    said = "</s>[INST] ok [/INST]"
    columns = "conv_id long, turn long, role string, text string"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], columns)
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.read_back(chat.format_trees(chat.as_threads(rows)))


_CONTROLS = "|".join(re.sub(r"([|\[\]])", r"\\\1", c) for c in chat.CONTROL)


def _escaped_length(x: str) -> str:
    """SQL for the length of a text in which backslashes are doubled and each control string has one more."""
    return f"length({x}) + len(regexp_extract_all({x}, '\\\\')) + len(regexp_extract_all({x}, '{_CONTROLS}'))"


OP4_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, role AS r, text AS t, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]', 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]', 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, t NULLS FIRST), ''))
       AS loss_sha256,
       sum({len(chat.START) + len(chat.END) + 2} + {_escaped_length('role')}
           + len(regexp_extract_all(role, chr(10))) + {_escaped_length('text')})::BIGINT
       AS formatted_chars
FROM said GROUP BY conv_id
"""


def op5_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(read(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0)


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read(spark, folder, "documents"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_counts(read(spark, folder, "documents"), vocabulary(spark, "byte_bpe_50k.tiktoken"))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.QualityModel:
    """The model fitted on the labels that are not held out."""
    usable = labels.where(remainder(5) != 0).select("doc_id", (F.col("quality") > 0).alias("good"))
    return quality.fit_quality(docs, usable)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = quality_model(docs, read(spark, folder, "labels"))
    scored = docs.select("doc_id", quality.quality_score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted")
    )


def op7_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def sized_documents(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"key": mixing.random_key(F.col("doc_id")), "size": word_count(F.col("text"))})


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "source", "text")
    rows = store(sized_documents(docs).drop("text"))
    mixed = mixing.take(rows, store(mixing.cuts(rows)))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2.0::DOUBLE * sum(size)::BIGINT AS stop,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source
), ratios AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::BIGINT - coalesce(sum(stop) OVER (ORDER BY stop / weight, source NULLS LAST
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY stop / weight, source NULLS LAST
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ratio
  FROM sources
), targets AS (
  SELECT source, source_size, least(stop, coalesce(max(CASE WHEN stop > ratio * weight THEN ratio END) OVER () * weight, stop)) AS target
  FROM ratios
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, round(t.target)::BIGINT AS words,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT
         - s.size AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END * size
       + greatest(0, least(size, CASE WHEN source_size > 0 THEN words % source_size ELSE 0 END - before)))::BIGINT AS taken
FROM placed
"""


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Near copies, by SimHash, are one cluster; sizes go along with the fingerprints, so no text is shuffled."""
    carry = (F.col("source"), word_count(F.col("text")).alias("words"))
    found = simhash_dedup.near_duplicates(read(spark, folder, "documents"), carry=carry)
    return packing.pack(found, cluster=F.col("root"), words=F.col("words"))


def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, also those that the damage leaves without rows."""
    rows = read(spark, folder, "conversations")
    found = repair.repair(repair.damage(rows))
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    joined = every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return joined.select(F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)


def _least(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _then(state: str, letter: str, cost: str, line: str = "") -> str:
    """SQL for a state's cost, audit and text after one more edit."""
    text = f" || chr(10) || {line}" if line else ""
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t{text}}}"


def _unless(condition: str, option: str) -> str:
    return f"CASE WHEN {condition} THEN {{'c': 1000000000000::BIGINT, 'a': '', 't': ''}} ELSE {option} END"


def _taken(state: str, to: str, initials: str) -> list[str]:
    """SQL for keeping a row or changing its role."""
    extra = "CASE WHEN cut THEN 5 ELSE 0 END"
    kept = _then(state, "K", f"0 + {extra}", "role || ':' || text")
    changed = _then(state, "R", f"1 + {extra}", f"'{to}:' || text")
    return [_unless(f"gone OR role[1] != '{initials}'", kept), _unless("gone", changed)]


_INSERTED = {
    "q0": "q0", "q1": "q1",
    "q2": _least("q2", *(_then(q, "I", "5", "'user:'") for q in ("q0", "q1", "q3"))),
    "q3": _least("q3", *(_then(q, "I", "5", "'assistant:'") for q in ("q2", _then("q0", "I", "5", "'user:'"), _then("q1", "I", "5", "'user:'")))),
}
_CLOSED = ", ".join(f"{sql} AS {name}" for name, sql in _INSERTED.items())
_SYSTEM = _unless("gone OR role[1] != 's'", _then("q0", "K", "0 + CASE WHEN cut THEN 5 ELSE 0 END", "role || ':' || text"))
_MOVED = f"""{_then("q0", "D", "2")} AS q0, {_least(_then("q1", "D", "2"), _SYSTEM)} AS q1,
  {_least(_then("q2", "D", "2"), *_taken("q0", "user", "u"), *_taken("q1", "user", "u"), *_taken("q3", "user", "u"))} AS q2,
  {_least(_then("q3", "D", "2"), *_taken("q2", "assistant", "a"))} AS q3"""

OP11_SQL = f"""
WITH RECURSIVE summed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))),
    4294967295) % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [1, 2] WHEN kind = 0 THEN []::INT[] ELSE [1] END) FROM summed)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged
), faults AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au') AS odd
  FROM numbered
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
    count_if(NOT blank AND seen) AS duplicate, count_if(NOT blank AND NOT seen AND cut) AS truncated, count_if(odd) AS illegal
  FROM faults GROUP BY conv_id
), steps AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS q0, {{'c': 1000000000000::BIGINT, 'a': '', 't': ''}} AS q1,
    {{'c': 1000000000000::BIGINT, 'a': '', 't': ''}} AS q2, {{'c': 1000000000000::BIGINT, 'a': '', 't': ''}} AS q3
  FROM counts
  UNION ALL
  SELECT conv_id, i, {_MOVED} FROM (
    SELECT conv_id, i, gone, cut, role, text, {_CLOSED} FROM (
      SELECT s.conv_id, f.i, f.blank OR f.seen AS gone, f.cut, f.role, f.text, q0, q1, q2, q3
      FROM steps s JOIN faults f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = s.i + 1
    )
  )
), ended AS (
  SELECT conv_id, {_least("q0", "q3")} AS best FROM (SELECT conv_id, i, {_CLOSED} FROM steps) s
  WHERE i = (SELECT n FROM counts c WHERE c.conv_id IS NOT DISTINCT FROM s.conv_id)
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    files = (vocabulary(spark, name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_documents(read(spark, folder, "documents"), *files)


def op13_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(read(spark, folder, "documents"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


OP13_SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM worded
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id != b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM sets UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), least AS (
  SELECT u, min(v) AS component_id FROM reach GROUP BY u
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least ON doc_id = u
"""


QUERIES = {
    "op1_html": op1_html,
    "op2_lm_score": op2_lm_score,
    "op3_packing": op3_packing,
    "op4_chat": op4_chat,
    "op5_ann": op5_ann,
    "op6_mixing": op6_mixing,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_fingerprints": op8_fingerprints,
    "op9_token_counts": op9_token_counts,
    "op10_quality": op10_quality,
    "op11_repair": op11_repair,
    "op12_alignment": op12_alignment,
    "op13_minhash": op13_minhash,
}

SQL = {"op4_chat": OP4_SQL, "op6_mixing": OP6_SQL, "op11_repair": OP11_SQL, "op13_minhash": OP13_SQL}
