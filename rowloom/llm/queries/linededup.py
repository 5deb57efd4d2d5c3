"""Operator 5: line dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowloom.llm import lineruns


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return lineruns.without_repeats(docs).select("doc_id", "text", "n_lines", "n_removed")


# Runs of lines with 50 words, from each line on and up to each line; later ones are deleted.
DELETED = r"""
l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s, unnest(range(len(string_split(text, chr(10))))) AS k FROM documents WHERE text IS NOT NULL),
l1 AS (SELECT doc_id, k, s, len(list_filter(string_split_regex(s, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS c FROM l0),
l2 AS (SELECT *, sum(c) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM l1),
ahead AS (SELECT a.doc_id, a.k AS k, min(b.k) AS e FROM l2 a JOIN l2 b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.upto - a.upto + a.c >= 50 GROUP BY 1, 2),
back AS (SELECT b.doc_id, max(a.k) AS k, b.k AS e FROM l2 a JOIN l2 b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.upto - a.upto + a.c >= 50 GROUP BY 1, 3),
win AS (SELECT * FROM ahead UNION SELECT doc_id, k, e FROM back),
run AS (SELECT w.doc_id, w.k, w.e, array_to_string(t.ls[w.k + 1 : w.e + 1], chr(10)) AS body
        FROM win w JOIN (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents) t USING (doc_id)),
ranked AS (SELECT *, first_value(doc_id) OVER o AS fd, first_value(k) OVER o AS fk
           FROM run WINDOW o AS (PARTITION BY body ORDER BY doc_id, k)),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, e + 1)) AS k FROM ranked
         WHERE NOT (doc_id = fd AND k <= fk + e - k))
"""

_SQL = f"""
WITH {DELETED}
SELECT d.doc_id,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(x.t, '') END AS text,
       coalesce(x.n_lines, 0) AS n_lines, coalesce(x.n_removed, 0) AS n_removed
FROM documents d
LEFT JOIN (SELECT l0.doc_id, string_agg(CASE WHEN g.k IS NULL THEN s END, chr(10) ORDER BY l0.k) AS t, count(*) AS n_lines, count(g.k) AS n_removed
           FROM l0 LEFT JOIN gone g ON l0.doc_id = g.doc_id AND l0.k = g.k GROUP BY 1) x USING (doc_id)
"""

QUERIES = {"op5_line_dedup": op5_line_dedup}
ORACLES = {"op5_line_dedup": _SQL}
