"""The queries of this subpackage over whole tables, and SQL for those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.llm import (
    chat,
    decontaminate,
    exact_dedup,
    hard_negatives,
    html_extract,
    language_id,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    quality,
    runs,
    secrets,
)
from chunkloom.llm.common import held_out, table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"), licenses.known_table(spark))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts made of all conversations; the model learns from those not held out."""
    lines = chat.transcripts(table(spark, sf_dir, "conversations"))
    order = ["turn_no", "line_no"]
    model = chat.train(lines.filter(~held_out("conv_id")), order)
    return chat.parse_transcripts(lines.select("conv_id", *order, "text"), order, model)


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_language(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows with an id divisible by 100; every seventh label is moved on."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives.mine_hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), [F.col("doc_id")])
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` where the words of a tenth of the texts repeat from some word on.

    That word, a, and the period, p, follow from a hash of the id: from a on the p words
    there come again and again, up to the text's own number of words.
    """
    h = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY))"
    words = r"filter(split(text, '[\\x20\\x09-\\x0D]+'), x -> x <> '')"
    tail = "CAST(n - a AS INT)"
    cycle = "slice(words, CAST(a + 1 AS INT), CAST(p AS INT))"
    repeated = f"slice(flatten(array_repeat({cycle}, CAST(ceil((n - a) / p) AS INT))), 1, {tail})"
    changed = f"array_join(concat(slice(words, 1, CAST(a AS INT)), {repeated}), ' ')"
    return (
        docs.select("doc_id", "text", F.expr(f"{h} DIV 10").alias("g"), F.expr(f"{h} % 10 = 0").alias("some"))
        .withColumn("words", F.expr(f"CASE WHEN some THEN {words} END"))
        .withColumn("n", F.expr("nullif(size(words), 0)"))
        .withColumn("a", F.expr("g % n"))
        .withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
        .select("doc_id", F.expr(f"CASE WHEN some AND n > 0 THEN {changed} ELSE text END").alias("text"))
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2("runs", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_best_fit_packing,
            op2_license_scan,
            op3_decontamination,
            op4_chat_format,
            op5_near_dedup,
            op6_quality,
            op7_language_id,
            op8_secret_scan,
            op9_exact_dedup,
            op10_html_extraction,
            op11_hard_negatives,
            op12_line_dedup,
            op13_periodic_runs,
        )
    }


_EXACT = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    found = f"regexp_replace(lower({text}), {_sql_text(licenses.COPYRIGHT)}, '', 'g')"
    for old, new in licenses.SPELLINGS:
        found = f"replace({found}, {_sql_text(old)}, {_sql_text(new)})"
    found = rf"regexp_replace({found}, {_sql_text(licenses.VERSION)}, 'version \1', 'g')"
    return f"trim(regexp_replace({found}, {_sql_text(licenses.PLAIN)}, ' ', 'g'))"


def _licenses_sql() -> str:
    known = ", ".join(
        f"({_sql_text(i)}, {_sql_text(t)})" for i, t in licenses.known_licenses()
    )
    return f"""
WITH known AS (SELECT DISTINCT license_id, {_canonical_sql("t")} AS plain
               FROM (VALUES {known}) v(license_id, t)),
split AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
          WHERE text IS NOT NULL),
parts AS (SELECT doc_id, 0 AS line, text AS part FROM split
          UNION ALL SELECT doc_id, unnest(range(1, len(lines) + 1)), unnest(lines)
          FROM split WHERE len(lines) > 1),
plain AS (SELECT doc_id, line, {_canonical_sql("part")} AS plain FROM parts)
SELECT doc_id, line::INT AS line, license_id, sha256(plain) AS digest
FROM plain JOIN known USING (plain) WHERE plain <> ''
"""


_HARD_NEGATIVES = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {hard_negatives.POSITIVES})
SELECT anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, p.id ORDER BY n.score DESC, n.id) AS INT) AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n USING (anchor_id)
WHERE NOT n.same AND {hard_negatives.LOW} * p.score <= 100 * n.score
  AND 100 * n.score <= {hard_negatives.HIGH} * p.score
QUALIFY rank <= {hard_negatives.NEGATIVES}
"""

_LINES = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS last_id FROM keyed WHERE length(key) >= {line_dedup.LEAST_LENGTH}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.LEAST_DOCS})
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (last_id <> doc_id) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (last_id IS NULL OR last_id = doc_id), ''))
    AS kept_sha256
FROM keyed LEFT JOIN repeated USING (key) GROUP BY doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_license_scan": _licenses_sql(),
        "op9_exact_dedup": _EXACT,
        "op11_hard_negatives": _HARD_NEGATIVES,
        "op12_line_dedup": _LINES,
    }
