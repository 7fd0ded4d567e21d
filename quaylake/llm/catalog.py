"""Queries of the training-data operators, one per operator.

Each callable takes ``(spark, sf_dir)`` and applies its operator with
production parameters to the whole of its table; ``ORACLE`` has the DuckDB
SQL of those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaylake.llm import (
    chat,
    decontaminate,
    divergence,
    license_scan,
    line_dedup,
    lz_fingerprint,
    minhash,
    oracle_sql,
    pii,
    resample,
    sentencepiece_bpe,
    sharding,
    suffix_dedup,
    toxicity,
)
from quaylake.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 24
SHARD_SEED = 20240229


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    items = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = decontaminate.leaks(docs, items)
    return found.select("doc_id", "item_id", "start_word", "n_words", F.round("similarity", 6).alias("similarity"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    tagged = pii.tag_documents(docs, pii.train(docs))

    def joined(spans: str):
        one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.concat_ws(",", one)

    return tagged.select(
        "doc_id",
        *[f"n_{k}" for k in pii.KINDS],
        F.sha2(joined("base_spans"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(fold != 0)
    scored = toxicity.score(docs, toxicity.train(docs, labels), keep=["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(fold == 0, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        "toxic_windows",
    )


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lz_fingerprint.fingerprint_edits(docs)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = line_dedup.remove_repeated_lines(docs)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return cleaned.select(
        "doc_id",
        "n_lines",
        n_removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_runs"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = minhash.near_duplicates(docs, words=2)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = sentencepiece_bpe.encode_texts(
        docs,
        public_tokenizers.path("piece_bpe_32k.model"),
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
        keep=("doc_id",),
    )
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    calls, results = chat.conversation_calls(turns), chat.conversation_results(turns)
    return chat.format_calls(calls, results, chat.REPLY_TOOLS, context=chat.conversation_context(turns))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + F.lit(8)).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = sharding.shard_rows(docs, ["doc_id", "size", "text_crc32"], SHARDS, SHARD_SEED)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    target = read_table(spark, sf_dir, "benchmark").select("text")
    return resample.importance(docs, target)


def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan(docs).select("doc_id", "n_words", "licenses")
    base = F.filter("licenses", lambda x: x["base"])
    start = F.transform(base, lambda x: x["start"].cast("long"))
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"),
        F.array_max(start).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("licenses")).alias("labels"),
        F.coalesce(F.array_max(F.transform("licenses", lambda x: x["share"])), F.lit(0.0)).alias("score"),
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents").select("lang", "source", "text"))


QUERIES: dict[str, Query] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_line_dedup": op6_line_dedup,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_sharding": op10_sharding,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_license_scans": op12_license_scans,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE: dict[str, str] = {
    "op1_benchmark_decontamination": r"""
WITH item AS (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
                lambda x: x <> '') AS w FROM benchmark),
doc AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
                lambda x: x <> '') AS w FROM documents),
item_s AS (SELECT item_id, len(w) AS n, i, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS s
           FROM (SELECT item_id, w, unnest(range(len(w) - 4)) AS i FROM item WHERE len(w) >= 5)),
doc_s AS (SELECT doc_id, size, i, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS s
          FROM (SELECT doc_id, w, len(w) AS size, unnest(range(len(w) - 4)) AS i FROM doc WHERE len(w) >= 5)),
place AS (SELECT DISTINCT d.doc_id, t.n, greatest(0, least(d.i - t.i, d.size - t.n)) AS start
          FROM doc_s d JOIN item_s t ON t.s = d.s),
window_s AS (SELECT DISTINCT p.doc_id, p.n, p.start, d.s FROM place p
             JOIN doc_s d ON d.doc_id = p.doc_id AND d.i >= p.start AND d.i <= p.start + p.n - 5),
item_set AS (SELECT DISTINCT item_id, n, s FROM item_s),
window_w AS (SELECT doc_id, n, start, sum(length(replace(s, ' ', ''))) AS weight FROM window_s GROUP BY ALL),
item_w AS (SELECT item_id, n, sum(length(replace(s, ' ', ''))) AS weight FROM item_set GROUP BY ALL),
shared AS (SELECT a.doc_id, a.n, a.start, b.item_id, sum(length(replace(a.s, ' ', ''))) AS weight
           FROM window_s a JOIN item_set b ON b.n = a.n AND b.s = a.s GROUP BY ALL),
scored AS (SELECT s.doc_id, s.item_id, s.start, s.n, s.weight / greatest(w.weight, i.weight) AS similarity
           FROM shared s JOIN window_w w ON w.doc_id = s.doc_id AND w.n = s.n AND w.start = s.start
           JOIN item_w i ON i.item_id = s.item_id AND i.n = s.n)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start_word, CAST(n AS INTEGER) AS n_words, round(similarity, 6) AS similarity
FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
""",
    "op2_suffix_array_dedup": """
WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
block AS (SELECT doc_id, n, b, substr(h, 2 * b + 1, 798) AS part
          FROM (SELECT doc_id, h, n, unnest(range(0, n - 99, 300)) AS b FROM doc WHERE n >= 100)),
place AS (SELECT doc_id, part, b, unnest(range(least(300, n - 99 - b))) AS j FROM block),
told AS (SELECT doc_id, b + j AS i, row_number() OVER (PARTITION BY substr(part, 2 * j + 1, 200) ORDER BY doc_id, b + j) AS k
         FROM place),
gone AS (SELECT doc_id, i FROM told WHERE k > 1),
step AS (SELECT doc_id, i, CASE WHEN i - 100 <= lag(i) OVER w THEN 0 ELSE 1 END AS new FROM gone
         WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM step),
span AS (SELECT doc_id, span, min(i) AS lo, max(i) + 100 AS hi FROM numbered GROUP BY ALL),
piece AS (SELECT doc_id, span, lo, hi, coalesce(lag(hi) OVER w, 0) AS begin, lead(lo) OVER w AS next FROM span
          WINDOW w AS (PARTITION BY doc_id ORDER BY span)),
kept AS (SELECT p.doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans,
           string_agg(substr(d.h, 2 * begin + 1, 2 * (lo - begin)) || CASE WHEN next IS NULL THEN substr(d.h, 2 * hi + 1) ELSE '' END,
                      '' ORDER BY span) AS h
         FROM piece p JOIN doc d ON d.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM doc d LEFT JOIN kept k ON k.doc_id = d.doc_id
""",
    "op6_line_dedup": """
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
place AS (SELECT doc_id, lines, unnest(range(len(lines))) AS i FROM doc),
line AS (SELECT doc_id, i, lines[i + 1] AS line,
           CASE WHEN lines[i + 1] = '' THEN 0 ELSE length(lines[i + 1]) - length(replace(lines[i + 1], ' ', '')) + 1 END AS words
         FROM place),
same AS (SELECT a.doc_id AS first_id, b.doc_id, b.i - a.i AS shift, b.i, b.words FROM line a JOIN line b ON a.line = b.line
         WHERE a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.i < b.i)),
step AS (SELECT *, i - row_number() OVER (PARTITION BY first_id, doc_id, shift ORDER BY i) AS run FROM same),
long AS (SELECT doc_id, min(i) AS lo, max(i) AS hi FROM step GROUP BY first_id, doc_id, shift, run HAVING sum(words) >= 30),
gone AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS i FROM long),
state AS (SELECT t.doc_id, t.i, t.line, g.i IS NOT NULL AS is_gone,
            lag(g.i IS NOT NULL, 1, false) OVER (PARTITION BY t.doc_id ORDER BY t.i) AS was_gone
          FROM line t LEFT JOIN gone g ON g.doc_id = t.doc_id AND g.i = t.i)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (is_gone) AS n_removed,
       count(*) FILTER (is_gone AND NOT was_gone) AS n_runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT is_gone), '')) AS kept_sha256
FROM state GROUP BY doc_id
""",
    "op7_minhash_near_dedup": r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i + 1, i + 2), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 1, 1))) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id
           GROUP BY ALL),
link AS (SELECT s.a, s.b FROM shared s JOIN size x ON x.doc_id = s.a JOIN size y ON y.doc_id = s.b
         WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS other FROM doc UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON e.a = r.other)
SELECT r.doc_id, coalesce(any_value(z.n), 0) AS n_shingles, min(r.other) AS component_id, r.doc_id = min(r.other) AS kept
FROM reach r LEFT JOIN size z ON z.doc_id = r.doc_id GROUP BY r.doc_id
""",
    "op9_chat_formatting": """
WITH RECURSIVE call AS (
  SELECT conv_id, turn, text, count(*) AS copies, conv_id || ':' || turn AS id FROM conversations WHERE role = 'user' GROUP BY ALL),
result AS (
  SELECT conv_id, turn - 1 AS turn, text, count(*) AS copies, conv_id || ':' || (turn - 1) AS id
  FROM conversations WHERE role = 'assistant' GROUP BY ALL),
told_call AS (
  SELECT *, sum(copies) OVER (PARTITION BY id) AS n_calls,
    row_number() OVER (PARTITION BY id ORDER BY coalesce(to_json(text)::VARCHAR, 'null')) AS k FROM call),
told_result AS (
  SELECT *, sum(copies) OVER (PARTITION BY id) AS n_results,
    row_number() OVER (PARTITION BY id ORDER BY text NULLS FIRST) AS k FROM result),
one_call AS (SELECT * FROM told_call WHERE k = 1 AND id IS NOT NULL),
one_result AS (SELECT * FROM told_result WHERE k = 1 AND id IS NOT NULL),
chain AS (
  SELECT conv_id, turn, CAST(0 AS BIGINT) AS level FROM one_call c
  WHERE NOT EXISTS (SELECT 1 FROM one_call p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, p.level + 1 FROM chain p JOIN one_call c ON c.conv_id = p.conv_id AND c.turn = p.turn + 2),
every AS (
  SELECT coalesce(c.id, r.id) AS id, c.conv_id, c.turn, c.text, c.id IS NOT NULL AS is_call, r.text AS content, h.level,
         coalesce(c.n_calls, 0) AS n_calls, coalesce(r.n_results, 0) AS n_results, coalesce(c.copies, 0) + coalesce(r.copies, 0) AS n_rows,
         CASE WHEN c.id IS NULL THEN 'orphan' WHEN r.id IS NULL THEN 'pending' ELSE 'linked' END AS status, 'reply' AS name
  FROM one_call c FULL JOIN one_result r ON r.id = c.id LEFT JOIN chain h ON h.conv_id = c.conv_id AND h.turn = c.turn
  UNION ALL
  SELECT id, conv_id, turn, text, TRUE, NULL, NULL, copies, 0, copies, CASE WHEN id IS NULL THEN 'unlinked' ELSE 'repeat' END, 'reply'
  FROM told_call WHERE k > 1 OR id IS NULL
  UNION ALL
  SELECT id, NULL, NULL, NULL, FALSE, text, NULL, 0, copies, copies, CASE WHEN id IS NULL THEN 'unlinked' ELSE 'repeat' END, NULL
  FROM told_result WHERE k > 1 OR id IS NULL
  UNION ALL
  SELECT conv_id || ':' || turn, conv_id, NULL, NULL, FALSE, text, NULL, 0, 0, count(*), 'context', role
  FROM conversations WHERE coalesce(role NOT IN ('user', 'assistant'), TRUE) GROUP BY conv_id, turn, role, text),
checked AS (
  SELECT *, CASE WHEN status = 'orphan' THEN ['call: missing'] WHEN NOT is_call THEN [] ELSE list_filter([
           CASE WHEN length(text) < 40 THEN 'chars: below 40' END,
           CASE WHEN text IS NULL THEN 'chars: missing' END,
           CASE WHEN text IS NULL THEN 'prompt: missing' END,
           CASE WHEN length(text) > 400 THEN 'prompt: longer than 400' END,
           CASE WHEN turn IS NULL THEN 'turn: missing' END,
           CASE WHEN turn < 0 THEN 'turn: below 0' END], lambda x: x IS NOT NULL) END AS wrong,
         CASE WHEN status <> 'orphan' THEN name END AS shown FROM every)
SELECT conv_id, id AS call_id, shown AS name, level, status, len(wrong) = 0 AS valid, array_to_string(wrong, '; ') AS errors,
       CAST(n_calls AS BIGINT) AS n_calls, CAST(n_results AS BIGINT) AS n_results,
       '{"arguments":' || CASE WHEN NOT is_call THEN 'null' ELSE '{"chars":' || coalesce(length(text)::VARCHAR, 'null')
         || ',"prompt":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"turn":' || coalesce(turn::VARCHAR, 'null') || '}' END
       || ',"errors":[' || array_to_string(list_transform(wrong, lambda x: '"' || x || '"'), ',')
       || '],"id":' || coalesce('"' || id || '"', 'null') || ',"level":' || coalesce(level::VARCHAR, 'null')
       || ',"name":' || coalesce(to_json(shown)::VARCHAR, 'null')
       || ',"result":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"status":"' || status || '"}' AS json,
       CAST(n_rows AS BIGINT) AS n_rows
FROM checked
""",
} | oracle_sql.ORACLE


def llm_queries() -> dict[str, Query]:
    return dict(QUERIES)


def llm_oracle() -> dict[str, str]:
    return dict(ORACLE)
