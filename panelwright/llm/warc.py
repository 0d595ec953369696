"""WARC derivatives: a metadata and a plain-text conversion record for every response record.

A response record has: record_id, target_uri, date, http_headers (text, CRLF between lines), payload (text) and
optionally content_type, block_digest and payload_digest, which are computed where they are missing. Its two
derivatives refer to it by id, URI and date, carry its digests, and keep its HTTP headers: the metadata record
in its block, beside title, language and outlinks. Record ids are name-based, so a repeated run gives the same
records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The named character references that texts are likely to hold; the ampersand comes last.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "#39": "'", "nbsp": " ", "copy": "©",
            "middot": "·", "ndash": "–", "mdash": "—", "hellip": "…", "amp": "&"}
HIDDEN = r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)|<title\b.*?(?:</title\s*>|\z)"
BREAKS = r"(?i)</?(?:p|br|div|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|title|body|html|head|blockquote|pre)\b[^>]*>"
CRLF = "\r\n"


def urn(*parts: Column) -> Column:
    """A name-based id of the parts."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def decoded(text: Column) -> Column:
    for name, value in ENTITIES.items():
        text = F.replace(text, F.lit(f"&{name};"), F.lit(value))
    return text


def plain_text(html: Column) -> Column:
    """Visible text: a line per block element, white space collapsed, no empty lines."""
    text = F.regexp_replace(html, HIDDEN, " ")
    text = F.regexp_replace(text, r"[ \t\r\n\f]+", " ")
    text = F.regexp_replace(text, BREAKS, "\n")
    text = decoded(F.regexp_replace(text, r"<[^>]*>", ""))
    text = F.regexp_replace(text, r" *\n[ \n]*", "\n")
    return F.regexp_replace(F.regexp_replace(text, r"\A[ \n]+|[ \n]+\z", ""), r" {2,}", " ")


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of fetched pages (page_id, url, html); ``date`` stands for a fetch time that isn't known.

    Null html is an empty payload, a null url an empty URI.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    uri = F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\x00-\x20]", "")
    base = pages.select(F.col("page_id").cast("long"), uri.alias("target_uri"), F.lit(date).alias("date"),
                        payload.alias("payload"))
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                       F.octet_length("payload").cast("string"))
    base = base.withColumn("http_headers", headers).withColumn("payload_digest", digest(F.col("payload")))
    return base.withColumn("record_id", urn(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                                            F.col("target_uri"), F.col("payload_digest")))


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows per response: record_type, record_id, refers_to, target_uri, date, content_type, content_length,
    block_digest, source_payload_digest, source_block_digest, header, block.

    A response whose content type isn't text has an empty conversion; plain text is passed on as it is. Null
    payload, headers, URI or date count as empty; a null record_id gets one from URI, date and payload. Repeated responses give
    repeated records; other columns are ignored; an empty table gives no rows.
    """
    has = set(records.columns)
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    source = records.select(
        F.coalesce(F.col("record_id"), urn(F.lit("response"), empty("target_uri"), empty("date"),
                                           digest(empty("payload")))).alias("refers_to"),
        empty("target_uri").alias("target_uri"), empty("date").alias("date"), empty("http_headers").alias("http_headers"),
        empty("payload").alias("payload"),
        (F.col("payload_digest") if "payload_digest" in has else F.lit(None).cast("string")).alias("given_payload"),
        (F.col("block_digest") if "block_digest" in has else F.lit(None).cast("string")).alias("given_block"),
        (F.col("content_type") if "content_type" in has else F.lit(None).cast("string")).alias("given_type"))
    kind = F.lower(F.coalesce("given_type", F.regexp_extract("http_headers", r"(?i)content-type: *([^;\r\n]*)", 1)))
    source = source.select(
        "refers_to", "target_uri", "date", "http_headers", "payload",
        F.coalesce("given_payload", digest(F.col("payload"))).alias("source_payload_digest"),
        F.coalesce("given_block", digest(F.concat("http_headers", F.lit(CRLF + CRLF), "payload"))).alias(
            "source_block_digest"), F.trim(kind).alias("kind"))
    html = F.col("kind").contains("html")
    one_line = lambda c: F.trim(F.regexp_replace(decoded(c), r"[ \t\r\n\f]+", " "))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    links = F.regexp_extract_all("payload", F.lit(r"(?i)<a\s[^>]*?href=[\x22']([^\x22'>]*)"), 1)
    metadata = F.concat(
        field("title", one_line(F.regexp_extract("payload", r"(?is)<title\b[^>]*>(.*?)</title", 1))),
        field("language", F.regexp_extract("payload", r"(?i)<html\s[^>]*?lang=[\x22']([^\x22'>]*)", 1)),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), one_line(x), F.lit(CRLF))), ""),
        F.when(F.col("http_headers") != "", F.concat(F.lit("source-header: "), F.replace(
            F.col("http_headers"), F.lit(CRLF), F.lit(f"{CRLF}source-header: ")), F.lit(CRLF))).otherwise(F.lit("")))
    text = F.when(html, plain_text(F.col("payload"))).when(F.col("kind").startswith("text/"), F.col("payload")).otherwise(F.lit(""))
    made = F.explode(F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), metadata.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), text.alias("block"))))
    rows = source.withColumn("made", made).select("made.*", *[c for c in source.columns if c not in ("payload", "http_headers", "kind")])
    rows = rows.withColumn("record_id", urn(F.col("record_type"), F.col("refers_to"))).withColumn(
        "block_digest", digest(F.col("block"))).withColumn("content_length", F.octet_length("block").cast("long"))
    lines = [("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Date", "date"),
             ("WARC-Target-URI", "target_uri"), ("WARC-Refers-To", "refers_to"),
             ("WARC-Refers-To-Target-URI", "target_uri"), ("WARC-Refers-To-Date", "date"),
             ("WARC-Source-Payload-Digest", "source_payload_digest"), ("WARC-Source-Block-Digest", "source_block_digest"),
             ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length")]
    header = F.concat(F.lit(f"WARC/1.1{CRLF}"), *(field(n, F.col(c).cast("string")) for n, c in lines))
    return rows.withColumn("header", header).select(
        "record_type", "record_id", "refers_to", "target_uri", "date", "content_type", "content_length", "block_digest",
        "source_payload_digest", "source_block_digest", "header", "block")


def write_records(records: DataFrame, path: str) -> None:
    """The records as gzipped WARC files."""
    whole = F.concat("header", F.lit(CRLF), "block", F.lit(CRLF))
    records.select(whole.alias("value")).write.option("lineSep", CRLF).option("compression", "gzip").text(path)


def sql(date: str = "2024-01-01T00:00:00Z") -> str:
    """DuckDB's answer for the derivatives of ``responses`` of the table pages."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    nl = "chr(13) || chr(10)"

    def decode(x):
        for name, value in ENTITIES.items():
            x = f"replace({x}, {quote(f'&{name};')}, {quote(value)})"
        return x

    def uuid(x):
        return (f"'<urn:uuid:' || md5({x})[1:8] || '-' || md5({x})[9:12] || '-' || md5({x})[13:16] || '-' || "
                f"md5({x})[17:20] || '-' || md5({x})[21:32] || '>'")

    line = lambda x: f"trim(regexp_replace({decode(x)}, '[ \\t\\r\\n\\f]+', ' ', 'g'))"
    plain = f"regexp_replace(payload, {quote(HIDDEN)}, ' ', 'g')"
    plain = f"regexp_replace({plain}, '[ \\t\\r\\n\\f]+', ' ', 'g')"
    plain = f"regexp_replace({plain}, {quote(BREAKS)}, chr(10), 'g')"
    plain = decode(f"regexp_replace({plain}, '<[^>]*>', '', 'g')")
    plain = f"regexp_replace({plain}, ' *\\n[ \\n]*', chr(10), 'g')"
    plain = f"regexp_replace(regexp_replace({plain}, '\\A[ \\n]+|[ \\n]+\\z', '', 'g'), ' {{2,}}', ' ', 'g')"
    heads = [("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Date", "date"),
             ("WARC-Target-URI", "target_uri"), ("WARC-Refers-To", "refers_to"),
             ("WARC-Refers-To-Target-URI", "target_uri"), ("WARC-Refers-To-Date", "date"),
             ("WARC-Source-Payload-Digest", "source_payload_digest"), ("WARC-Source-Block-Digest", "source_block_digest"),
             ("WARC-Block-Digest", "block_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length")]
    header = " || ".join([f"'WARC/1.1' || {nl}", *(f"'{n}: ' || {c} || {nl}" for n, c in heads)])
    return f"""
with p as (select page_id, regexp_replace(coalesce(url, ''), '[\\x00-\\x20]', '', 'g') as target_uri,
                  coalesce(html, '') as payload from pages),
r as (select *, 'HTTP/1.1 200 OK' || {nl} || 'Content-Type: text/html; charset=utf-8' || {nl} || 'Content-Length: '
             || octet_length(encode(payload)) as http_headers, 'sha256:' || sha256(payload) as source_payload_digest from p),
s as (select *, 'sha256:' || sha256(http_headers || {nl} || {nl} || payload) as source_block_digest,
             {uuid("'response|' || coalesce(page_id::varchar, '') || '|' || target_uri || '|' || source_payload_digest")}
             as refers_to from r),
m as (
  select 'metadata' as record_type, 'application/warc-fields' as content_type, refers_to, target_uri,
    source_payload_digest, source_block_digest,
    'title: ' || {line("regexp_extract(payload, '(?is)<title\\b[^>]*>(.*?)</title', 1)")} || {nl} ||
    'language: ' || regexp_extract(payload, '(?i)<html\\s[^>]*?lang=[\\x22'']([^\\x22''>]*)', 1) || {nl} ||
    array_to_string([{" || ".join(["'outlink: '", line("x"), nl])} for x in
      regexp_extract_all(payload, '(?i)<a\\s[^>]*?href=[\\x22'']([^\\x22''>]*)', 1)], '') ||
    'source-header: ' || replace(http_headers, {nl}, {nl} || 'source-header: ') || {nl} as block from s
  union all
  select 'conversion', 'text/plain; charset=utf-8', refers_to, target_uri, source_payload_digest, source_block_digest,
    {plain} from s),
d as (select *, {uuid("record_type || '|' || refers_to")} as record_id, 'sha256:' || sha256(block) as block_digest,
             octet_length(encode(block)) as content_length, '{date}' as date from m)
select record_type, record_id, refers_to, target_uri, date, content_type, content_length, block_digest,
       source_payload_digest, source_block_digest, {header} as header, block from d"""
