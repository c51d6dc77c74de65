"""Derived WARC records: a metadata record and a plain-text conversion record for every page response.

A page's ``html`` is the payload of its response; if it starts with ``HTTP/`` its own header lines are the source
headers, else the headers of a plain 200 response are written. The response's record id is made from its target,
page id and payload digest, so it is the same on every run. Both derived records name it in WARC-Refers-To, repeat the
target and carry the payload digest and the source headers; their own digest covers their block.

* metadata (application/warc-fields): source status, content type, length and digest, title, and one ``outlink`` line per
  link in order;
* conversion (text/plain): comments, scripts, styles and templates removed, block tags turned to line ends, other tags
  removed, the five named XML entities and &nbsp; resolved, white space folded.

Defined results: null html is an empty payload; null url is an empty target; repeated rows give repeated records; an
empty table gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakelayer.llm.common import col

# patterns shared with the SQL form; both engines read them alike, but LINK is the SQL form's own: it knows double quotes only
COMMENT = r"(?s)<!--.*?(-->|\z)"
SKIP = [rf"(?is)<{t}\b[^>]*>.*?(</{t}\s*>|\z)" for t in ("script", "style", "noscript", "template")]
BLOCK = (r"(?i)</?(p|div|br|li|ul|ol|tr|h[1-6]|article|section|header|footer|nav|table|title|head|body|html|"
         r"blockquote|pre)\b[^>]*>")
TAG = r"<[a-zA-Z/!][^>]*>"
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&amp;", "&")]
BLANKS, BREAKS, ENDS = r"[ \t\r\f\x0B]+", r" ?\n[ \n]*", r"^[ \n]+|[ \n]+\z"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
LINK = r'(?i)<a\s[^>]*?href\s*=\s*"([^"]*)"'
# a link's tag up to its end (a quoted value may hold >), its href or another quoted value, and its href
ANCHOR = r"""(?i)<a\s(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
QUOTED = r"""(?i)((?<=[\s"'])href\s*=\s*(?:"[^"]*"|'[^']*'))|=\s*(?:"[^"]*"|'[^']*')"""
HREF = r"""(?i)(?<=[\s"'])href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))"""
CRLF = "\r\n"


def _text(html: Column) -> Column:
    for p in (COMMENT, *SKIP):
        html = F.regexp_replace(html, p, " ")
    html = F.regexp_replace(F.regexp_replace(html, BLOCK, "\n"), TAG, "")
    return _fold(html)


def _fold(s: Column) -> Column:
    for a, b in ENTITIES:
        s = F.replace(s, F.lit(a), F.lit(b))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, BLANKS, " "), BREAKS, "\n"), ENDS, "")


def _links(html: Column) -> Column:
    """The href values of all links in order: in double quotes, in single quotes or bare."""
    tags = F.transform(F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(0)), lambda t: F.regexp_replace(t, QUOTED, "$1 "))
    return F.transform(F.filter(tags, lambda t: t.rlike(HREF)),
                       lambda t: F.concat(*[F.regexp_extract(t, HREF, k) for k in (1, 2, 3)]))


def _urn(*parts: Column) -> Column:
    h = F.sha2(F.concat_ws(" ", *parts), 256)
    cut = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("8"), F.substring(h, 14, 3)),
           F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _digest(s: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(s, 256))


def derived_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    html_col: str = "html") -> DataFrame:
    """Two rows per page: page_id, record_type, record_id, refers_to, target_uri, source_headers, source_digest,
    content_type, content_length, block_digest and the block itself."""
    raw = F.coalesce(col(html_col).cast("string"), F.lit(""))
    src = pages.select(col(id_col).cast("string").alias("page_id"),
                       F.coalesce(col(url_col).cast("string"), F.lit("")).alias("target_uri"), raw.alias("raw"))
    end = F.instr("raw", CRLF * 2)
    framed = F.col("raw").startswith("HTTP/") & (end > 0)
    src = src.select(
        "page_id", "target_uri",
        F.when(framed, F.expr("substr(raw, instr(raw, '\\r\\n\\r\\n') + 4)")).otherwise(F.col("raw")).alias("payload"),
        F.when(framed, F.expr("substr(raw, 1, instr(raw, '\\r\\n\\r\\n') - 1)")).otherwise(F.concat(
            F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
            F.octet_length("raw").cast("string"))).alias("source_headers"))
    src = src.withColumn("source_digest", _digest(F.col("payload")))
    src = src.withColumn("refers_to", _urn(F.lit("response"), F.col("target_uri"),
                                           F.coalesce("page_id", F.lit("")), F.col("source_digest")))
    title = F.regexp_replace(_fold(F.regexp_extract("payload", TITLE, 1)), "\n", " ")
    links = _links(F.col("payload"))
    fields = F.concat(
        F.lit("status: "), F.regexp_extract("source_headers", r"^HTTP/[0-9.]+ +([0-9]+)", 1), F.lit(CRLF),
        F.lit("source-content-type: "),
        F.regexp_extract("source_headers", r"(?i)\ncontent-type: *([^\r\n]*)", 1), F.lit(CRLF),
        F.lit("source-length: "), F.octet_length("payload").cast("string"), F.lit(CRLF),
        F.lit("source-digest: "), F.col("source_digest"), F.lit(CRLF), F.lit("title: "), title, F.lit(CRLF),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), x, F.lit(f" L a/@href{CRLF}"))), ""))
    kinds = F.explode(F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"),
                 fields.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                 _text(F.col("payload")).alias("block"))))
    rows = src.select("page_id", "target_uri", "source_headers", "source_digest", "refers_to", kinds.alias("r"))
    return rows.select("page_id", "r.record_type",
                       _urn(F.col("r.record_type"), F.col("refers_to")).alias("record_id"), "refers_to", "target_uri",
                       "source_headers", "source_digest", "r.content_type",
                       F.octet_length("r.block").cast("long").alias("content_length"),
                       _digest(F.col("r.block")).alias("block_digest"), "r.block")


def write_warc(records: DataFrame, path: str, date: str, per_file: int = 100_000, compression: str = "gzip") -> None:
    """Write the records as WARC 1.1 files (``date``: the WARC-Date of all of them)."""
    source = F.array_join(F.transform(F.split("source_headers", CRLF),
                                      lambda x: F.concat(F.lit("X-Source-Header: "), x, F.lit(CRLF))), "")
    clean = F.regexp_replace("target_uri", r"[\r\n]", "")
    head = F.concat(F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.col("record_type"), F.lit(f"{CRLF}WARC-Record-ID: "),
                    F.col("record_id"), F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Refers-To: "), F.col("refers_to"),
                    F.lit(f"{CRLF}WARC-Target-URI: "), clean, F.lit(f"{CRLF}WARC-Block-Digest: "),
                    F.col("block_digest"), F.lit(f"{CRLF}X-Source-Payload-Digest: "), F.col("source_digest"),
                    F.lit(CRLF), source, F.lit("Content-Type: "), F.col("content_type"),
                    F.lit(f"{CRLF}Content-Length: "), F.col("content_length").cast("string"), F.lit(CRLF * 2))
    (records.select(F.concat(head, F.col("block")).alias("value"))
     .write.options(lineSep=CRLF * 2, compression=compression, maxRecordsPerFile=str(per_file)).text(path))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """headers (map; a repeated name keeps its values, joined by line ends) and block of every record of ``path``.
    Blocks are cut by Content-Length."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if name.endswith(".gz"):
                    data = zlib.decompressobj(31).decompress(data)
                at, heads, blocks = 0, [], []
                while data.startswith(b"WARC/", at):
                    end = data.index(b"\r\n\r\n", at)
                    fields: dict[str, str] = {}
                    for line in data[at:end].decode().split(CRLF)[1:]:
                        k, v = line.split(": ", 1)
                        fields[k] = f"{fields[k]}\n{v}" if k in fields else v
                    size = int(fields["Content-Length"])
                    heads.append(list(fields.items()))
                    blocks.append(data[end + 4:end + 4 + size].decode())
                    at = end + 8 + size
                yield pa.RecordBatch.from_arrays([pa.array(heads, pa.map_(pa.string(), pa.string())),
                                                  pa.array(blocks, pa.string())], ["headers", "block"])

    return (spark.read.format("binaryFile").load(path).select("path", "content")
            .mapInArrow(parse, "headers map<string,string>, block string"))


def warc_query(pages: DataFrame) -> DataFrame:
    return derived_records(pages).select(
        F.col("page_id").cast("long").alias("page_id"), "record_type", "record_id", "refers_to", "target_uri",
        "source_digest", F.sha2("source_headers", 256).alias("headers_sha256"), "content_type", "content_length",
        "block_digest")


def _sql(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_fold(s: str) -> str:
    for a, b in ENTITIES:
        s = f"replace({s}, {_sql(a)}, {_sql(b)})"
    for p, r in ((BLANKS, "' '"), (BREAKS, "chr(10)"), (ENDS, "''")):
        s = f"regexp_replace({s}, {_sql(p)}, {r}, 'g')"
    return s


def _sql_text(s: str) -> str:
    for p in (COMMENT, *SKIP):
        s = f"regexp_replace({s}, {_sql(p)}, ' ', 'g')"
    s = f"regexp_replace({s}, {_sql(BLOCK)}, chr(10), 'g')"
    return _sql_fold(f"regexp_replace({s}, {_sql(TAG)}, '', 'g')")


def _sql_urn(s: str) -> str:
    h = f"sha256({s})"
    return (f"'<urn:uuid:' || substr({h},1,8) || '-' || substr({h},9,4) || '-8' || substr({h},14,3) || '-8' || "
            f"substr({h},18,3) || '-' || substr({h},21,12) || '>'")


_NL = "chr(13) || chr(10)"
ORACLE = f"""
WITH raw AS (SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS raw,
                    instr(coalesce(html, ''), {_NL} || {_NL}) AS e FROM pages),
src AS (SELECT page_id, target_uri,
  CASE WHEN starts_with(raw, 'HTTP/') AND e > 0 THEN substr(raw, e + 4) ELSE raw END AS payload,
  CASE WHEN starts_with(raw, 'HTTP/') AND e > 0 THEN substr(raw, 1, e - 1)
       ELSE 'HTTP/1.1 200 OK' || {_NL} || 'Content-Type: text/html; charset=utf-8' || {_NL} || 'Content-Length: '
            || strlen(raw) END AS h FROM raw),
dig AS (SELECT *, 'sha256:' || sha256(payload) AS source_digest FROM src),
ref AS (SELECT *, {_sql_urn("'response ' || target_uri || ' ' || coalesce(page_id::VARCHAR, '') || ' ' || source_digest")}
        AS refers_to FROM dig),
rec AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type,
    'status: ' || regexp_extract(h, '^HTTP/[0-9.]+ +([0-9]+)', 1) || {_NL} || 'source-content-type: '
    || regexp_extract(h, '(?i)\\ncontent-type: *([^\\r\\n]*)', 1) || {_NL} || 'source-length: ' || strlen(payload)
    || {_NL} || 'source-digest: ' || source_digest || {_NL} || 'title: '
    || regexp_replace({_sql_fold(f"regexp_extract(payload, {_sql(TITLE)}, 1)")}, '\\n', ' ', 'g') || {_NL}
    || coalesce(array_to_string(list_transform(regexp_extract_all(payload, {_sql(LINK)}, 1),
         lambda x: 'outlink: ' || x || ' L a/@href' || {_NL}), ''), '') AS block FROM ref
  UNION ALL
  SELECT *, 'conversion', 'text/plain; charset=utf-8', {_sql_text('payload')} FROM ref)
SELECT page_id, record_type, {_sql_urn("record_type || ' ' || refers_to")} AS record_id, refers_to, target_uri,
       source_digest, sha256(h) AS headers_sha256, content_type, strlen(block)::BIGINT AS content_length,
       'sha256:' || sha256(block) AS block_digest
FROM rec
"""
