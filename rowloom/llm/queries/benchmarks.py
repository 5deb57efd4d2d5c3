"""Operator 4: benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import phrases


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return phrases.contamination(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        F.expr("n_hit > 0").alias("contaminated"),
    )


_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

#: Hit words of documents: (row number r, position p) of every word inside a window of an item.
HITS = rf"""
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
),
gram AS (
  SELECT r, k, n, array_to_string(w[k : k + n - 1], ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
),
occ AS (SELECT r, k, n, item_id FROM gram JOIN win USING (phrase, n)),
hit AS (SELECT DISTINCT r, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT r, k, n FROM occ))
"""

_SQL = f"""
WITH {HITS}
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(o.n_items, 0) AS n_items,
       sha256(coalesce(o.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d
LEFT JOIN (SELECT r, count(*) AS n_hit FROM hit GROUP BY r) h USING (r)
LEFT JOIN (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
           FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY r) o USING (r)
"""

#: Words between a phrase's rarest term and any other of its terms.
REACH = 12


def op4_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loose copies: all words of a window close together, in any order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return phrases.near(docs, items, REACH).select(
        "doc_id", "n_near", F.size("item_ids").cast("long").alias("n_near_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("near_sha256")
    )


_NEAR_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, w[k : k + least(len(w), 10) - 1] AS terms
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
),
pt AS (SELECT DISTINCT terms, unnest(terms) AS term FROM (SELECT DISTINCT terms FROM win)),
tok AS (SELECT r, unnest(w) AS term, unnest(range(len(w))) AS pos FROM d),
post AS (SELECT * FROM tok WHERE term IN (SELECT term FROM pt)),
freq AS (SELECT term, count(*) AS f FROM post GROUP BY term),
known AS (SELECT terms, count(*) AS n, count(f) AS there, min_by(term, (f, term)) AS rare FROM pt LEFT JOIN freq USING (term) GROUP BY terms HAVING count(*) = count(f)),
cand AS (SELECT k.terms, k.n, p.r, p.pos FROM known k JOIN post p ON p.term = k.rare),
hit AS (
  SELECT c.terms, c.r, c.pos FROM cand c JOIN pt ON pt.terms = c.terms JOIN post p ON p.r = c.r AND p.term = pt.term AND abs(p.pos - c.pos) <= 12
  GROUP BY c.terms, c.r, c.pos, c.n HAVING count(DISTINCT pt.term) = c.n
)
SELECT doc_id, coalesce(x.n, 0) AS n_near, coalesce(o.n, 0) AS n_near_items, sha256(coalesce(o.ids, '')) AS near_sha256
FROM d LEFT JOIN (SELECT r, count(*) AS n FROM hit GROUP BY r) x USING (r)
LEFT JOIN (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
           FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit JOIN win USING (terms)) GROUP BY r) o USING (r)
"""

QUERIES = {"op4_decontaminate": op4_decontaminate, "op4_proximity": op4_proximity}
ORACLES = {"op4_decontaminate": _SQL, "op4_proximity": _NEAR_SQL}
