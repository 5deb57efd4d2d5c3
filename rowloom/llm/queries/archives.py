"""Operator 2: WARC derivatives of web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowloom.llm import warc


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the records, with their ids and the link between the two of a page."""
    return warc.derivatives(warc.responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))


def op2_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as they stand in a file."""
    records = warc.derivatives(warc.responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return warc.serialized(records).select("warc_type", "record_id", "warc")


_QUOTED = r"""(?:[^>"'']|"[^"]*"|''[^'']*'')*>"""
_HIDDEN = r"<!--.*?-->|" + "|".join(rf"<{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in warc.HIDDEN)


def _resolved(text: str) -> str:
    for name, char in (("&nbsp;", "chr(160)"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&amp;", "'&'")):
        text = f"replace({text}, '{name}', {char})"
    return text


_SQL = rf"""
WITH p AS (
  SELECT url, coalesce(html, '') AS body,
         'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
         || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') AS block,
         md5(concat_ws(chr(10), CAST(page_id AS VARCHAR), url)) AS h
  FROM pages
), s AS (
  SELECT *, 'urn:uuid:' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS id,
         'sha1:' || sha1(block) AS bd, 'sha1:' || sha1(body) AS pd,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(body, '{_HIDDEN}', '', 'gis'),
           '</?(?:{warc.BREAKING})(?:[\s/]{_QUOTED}|>)', chr(10), 'gi'), '<[a-z/!?]{_QUOTED}', '', 'gi'), '<[a-z/!?][^>]*>', '', 'gi') AS t
  FROM p
), c AS (
  SELECT *, array_to_string(list_filter(list_transform(string_split({_resolved("t")}, chr(10)),
         lambda x: trim(regexp_replace(x, '[ \t\r\f\v]+', ' ', 'g'), ' ')), lambda x: x <> ''), chr(10)) AS plain,
         trim(regexp_replace(replace({_resolved(r"regexp_extract(body, '<title(?:\s[^>]*)?>(.*?)</title', 1, 'is')")}, chr(10), ' '), '[ \t\r\f\v]+', ' ', 'g'), ' ') AS title,
         regexp_extract_all(body, '<a\s[^>]*?href\s*=\s*"([^">]*)"', 1, 'i') AS links
  FROM s
), r AS (
  SELECT *, 'conversion' AS warc_type, 'text/plain; charset=utf-8' AS content_type, plain AS block_ FROM c
  UNION ALL
  SELECT *, 'metadata', 'application/warc-fields', array_to_string(list_concat(
    ['http-status: HTTP/1.1 200 OK', 'http-header: Content-Type: text/html; charset=utf-8', 'http-header: Content-Length: ' || CAST(strlen(body) AS VARCHAR),
     'source-block-digest: ' || bd, 'source-block-digest-holds: true', 'source-payload-digest: ' || pd, 'source-payload-digest-holds: true', 'title: ' || title],
    list_transform(links, lambda l: 'outlink: ' || {_resolved("l")}), ['']), chr(13) || chr(10)) FROM c
)
SELECT warc_type, id AS refers_to, url AS target_uri, content_type, CAST(strlen(block_) AS BIGINT) AS content_length,
       'sha1:' || sha1(block_) AS block_digest, bd AS source_block_digest, pd AS source_payload_digest, block_ AS block
FROM r
"""



def _derived_id(kind: str) -> str:
    """SQL of warc.derived_id: a name-based UUID of version 5 in the URL namespace."""
    h = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({kind} || ' of ' || refers_to))"
    variant = f"substr('89ab', (strpos('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4 + 1, 1)"
    return f"'urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || {variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"


_RECORDS_SQL = f"""
SELECT *, {_derived_id("warc_type")} AS record_id, CASE WHEN warc_type = 'metadata' THEN {_derived_id("'conversion'")} END AS concurrent_to,
       '1970-01-01T00:00:00Z' AS date
FROM ({_SQL})
"""

_FILE_SQL = f"""
SELECT warc_type, record_id, array_to_string(list_filter([
         'WARC/1.1', 'WARC-Type: ' || warc_type, 'WARC-Record-ID: <' || record_id || '>', 'WARC-Refers-To: <' || refers_to || '>',
         'WARC-Concurrent-To: <' || concurrent_to || '>', 'WARC-Target-URI: ' || target_uri, 'WARC-Date: ' || date, 'WARC-Block-Digest: ' || block_digest,
         'Content-Type: ' || content_type, 'Content-Length: ' || CAST(content_length AS VARCHAR)], lambda x: x IS NOT NULL), chr(13) || chr(10))
       || repeat(chr(13) || chr(10), 2) || block || repeat(chr(13) || chr(10), 2) AS warc
FROM ({_RECORDS_SQL})
"""

QUERIES = {"op2_warc_derivatives": op2_warc_derivatives, "op2_warc_records": op2_warc_records}
ORACLES = {"op2_warc_derivatives": _RECORDS_SQL, "op2_warc_records": _FILE_SQL}
