"""Operator 7: chat formatting, read back from the formatted texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import chat

#: A conversation whose texts look like the template's own control strings.
TRICKY = r"\### Assistant: </turn> ok"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], turns.schema)
    lines = F.transform(F.arrays_zip("roles", "texts"), lambda t: F.concat(t["roles"], F.lit("\n"), t["texts"], F.lit("\n")))
    learned = F.concat_ws("", "learned")
    return chat.read_back(chat.format_chat(turns.union(tricky))).select(
        "conv_id",
        F.size("roles").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", lines), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )


_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRICKY}'
  UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'
), r AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM t
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '')) AS loss_sha256,
       CAST(sum(14 + 2 * length(role) - length(regexp_replace(role, '[\\#<:]', '', 'g'))
                   + 2 * length(text) - length(regexp_replace(text, '[\\#<]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""

QUERIES = {"op7_chat_format": op7_chat_format}
ORACLES = {"op7_chat_format": _SQL}
