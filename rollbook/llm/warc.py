"""WARC derivatives: linked metadata and plain-text conversion records of response records.

``responses`` makes response records from pages; ``derive`` gives each response a metadata record (warc-fields: title,
language, outlinks, the source's headers and digests) and a conversion record (the page's text). Both refer to the
response's id, repeat its target URI and date, and carry digests of their own. ``write`` puts records into WARC files.

Plain text: comments, scripts and styles go, block tags end a line, other tags vanish, character references are decoded (decimal,
hexadecimal, and the named ones of HTML 4 with ``apos``; an unknown name stays as it is, a number that is no character becomes U+FFFD);
runs of blanks, non-breaking ones too, become one, empty lines go. Attributes may be in double, single or no quotes, after any blank, and a
quoted value may hold ``>``; their references are decoded too. Of each ``a`` tag the first ``href`` is a link.

``read_responses`` reads response records of WARC files, plain or gzip, one member a file or one a record, so that their own headers and
digests go into the derivatives. Texts are read as UTF-8; ``intact`` is false where a block is not as long as its Content-Length
says, as with other bytes or a block that holds the line ``WARC/1.1`` itself.

Defined results: a NULL page counts as empty and still gives all three records; a NULL URL is an empty target URI. Record ids come
from the URL, the date and the payload's digest, so repeated captures share them. Extra columns are carried along, but for those
named like a result, which give way to it.
"""
from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm.common import let, without

CRLF = "\r\n"
BLOCK_TAGS = "p|div|br|li|ul|ol|tr|table|h[1-6]|article|section|header|footer|nav|title|blockquote|pre"


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def record_id(*parts: Column) -> Column:
    """A urn:uuid from the MD5 of the parts."""
    h = F.md5(F.concat_ws("|", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


#: Patterns that Java and RE2 read alike. A tag's attributes end at the first ``>`` outside quotes.
INSIDE = r"""[ \t\r\n\f/]([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>"""
ATTRIBUTE = r"""([^ \t\r\n\f/>="']+)[ \t\r\n\f]*=[ \t\r\n\f]*("[^"]*"|'[^']*'|[^ \t\r\n\f"'>]+)"""
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"
BLANKS = r"[ \t\r\f\x0b\x{a0}]+"
NAMES = {**name2codepoint, "apos": 39}
RESPONSE = ("record_id", "target_uri", "date", "http_headers", "payload", "payload_digest", "block_digest")
DERIVED = ("title", "lang", "links", "text", "metadata_id", "conversion_id", "fields", "response_record", "metadata_record", "conversion_record")


def _character(code: Column) -> Column:
    """The character of a code point, U+FFFD for what is none; NULL stays."""
    unit = lambda x: F.lpad(F.hex(x), 4, "0")
    high, low = F.shiftright(code - 0x10000, 10) + 0xD800, code.bitwiseAND(F.lit(0x3FF)) + 0xDC00
    units = (F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("FFFD"))
             .when(code > 0xFFFF, F.concat(unit(high), unit(low))).otherwise(unit(code)))
    return F.decode(F.unhex(units), "UTF-16BE")


def _reference(found: Column) -> Column:
    body = F.regexp_replace(found, "[&#;]", "")
    named = F.create_map(*[F.lit(x) for pair in sorted(NAMES.items()) for x in pair])
    code = (F.when(found.rlike("^&#[xX]"), F.conv(F.substr(body, F.lit(2)), 16, 10).cast("long"))
            .when(found.startswith("&#"), F.regexp_extract(found, "^&#([0-9]+)", 1).try_cast("long"))
            .otherwise(F.try_element_at(named, body).cast("long")))
    return F.coalesce(let(code, _character), found)


def decoded(text: Column) -> Column:
    """The text with its character references decoded, once: &amp;lt; gives &lt;."""
    def whole(t: Column) -> Column:
        chars = F.transform(F.regexp_extract_all(t, F.lit(REFERENCE), 0), _reference)
        parts = F.zip_with(F.split(t, REFERENCE, -1), F.concat(chars, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
        return F.when(t.contains("&"), F.array_join(parts, "")).otherwise(t)
    return let(text, whole)


def attribute(inside: Column, name: str) -> Column:
    """The decoded value of the first attribute of that name, from the text of a tag after its name; NULL if there is none."""
    pairs = F.arrays_zip(F.regexp_extract_all(inside, F.lit(ATTRIBUTE), 1).alias("name"), F.regexp_extract_all(inside, F.lit(ATTRIBUTE), 2).alias("value"))
    value = F.get(F.filter(pairs, lambda x: F.lower(x["name"]) == name), 0)["value"]
    unquoted = lambda v: F.when(v.rlike("^[\"']"), F.substr(v, F.lit(2), F.length(v) - 2)).otherwise(v)
    return decoded(let(value, unquoted))


def _tidy(text: Column) -> Column:
    """Decoded references, single blanks, no empty lines."""
    text = F.regexp_replace(decoded(text), BLANKS, " ")
    return F.btrim(F.regexp_replace(text, r" ?\n[ \n]*", "\n"), F.lit(" \n"))


def plain_text(html: Column) -> Column:
    text = F.regexp_replace(html, r"(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>", "")
    text = F.regexp_replace(text, rf"(?i)</?({BLOCK_TAGS})([ \t\r\n\f][^>]*)?/?>", "\n")
    return _tidy(F.regexp_replace(text, r"<[^>]*>", ""))


def _first(html: Column, pattern: str) -> Column:
    return F.regexp_extract(html, pattern, 1)


def responses(pages: DataFrame, date: str, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(record_id, target_uri, date, http_headers, payload, payload_digest, block_digest) of each page."""
    payload, url = F.coalesce(F.col(html_col), F.lit("")), F.coalesce(F.col(url_col), F.lit(""))
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                       F.octet_length("payload").cast("string"), F.lit(CRLF + CRLF))
    kept = without(pages.drop(url_col, html_col), *RESPONSE, *DERIVED).columns
    base = pages.select(*[F.col(f"`{c}`") for c in kept], payload.alias("payload"), url.alias("target_uri"))
    base = base.withColumn("http_headers", headers).withColumn("payload_digest", digest(F.col("payload")))
    return base.select(*[F.col(f"`{c}`") for c in kept], record_id(F.col("target_uri"), F.lit(date), F.col("payload_digest")).alias("record_id"), "target_uri",
                       F.lit(date).alias("date"), "http_headers", "payload", "payload_digest",
                       digest(F.concat("http_headers", "payload")).alias("block_digest"))


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The columns of ``responses`` and ``intact``, of the response records in WARC files."""
    head = F.substring_index("value", CRLF + CRLF, 1)
    field = lambda name: F.regexp_extract(head, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    found = (spark.read.option("lineSep", "WARC/1.1" + CRLF).text(path).where(F.lower(field("WARC-Type")) == "response")
             .select(field("WARC-Record-ID").alias("record_id"), field("WARC-Target-URI").alias("target_uri"), field("WARC-Date").alias("date"),
                     field("WARC-Payload-Digest").alias("stated"), field("WARC-Block-Digest").alias("stated_block"),
                     field("Content-Length").try_cast("long").alias("length"), F.substr("value", F.length(head) + 5).alias("block")))
    found = found.withColumn("block", F.regexp_replace("block", r"\r\n\r\n\n*$", ""))
    http = F.concat(F.substring_index("block", CRLF + CRLF, 1), F.lit(CRLF + CRLF))
    found = found.withColumn("http_headers", http).withColumn("payload", F.substr("block", F.length(http) + 1))
    stated = lambda name, own: F.when(F.col(name) == "", digest(own)).otherwise(F.col(name))
    return found.select("record_id", "target_uri", "date", "http_headers", "payload", stated("stated", F.col("payload")).alias("payload_digest"),
                        stated("stated_block", F.col("block")).alias("block_digest"),
                        F.coalesce(F.octet_length("block") == F.col("length"), F.lit(False)).alias("intact"))


def _record(kind: str, own_id: Column, content_type: str, block: Column, more: list[tuple[str, Column]]) -> Column:
    lines = [("WARC-Type", F.lit(kind)), ("WARC-Record-ID", own_id), ("WARC-Date", F.col("date")), ("WARC-Target-URI", F.col("target_uri")),
             *more, ("WARC-Block-Digest", digest(block)), ("Content-Type", F.lit(content_type)),
             ("Content-Length", F.octet_length(block).cast("string"))]
    head = F.concat(F.lit("WARC/1.1" + CRLF), *[x for k, v in lines for x in (F.lit(k + ": "), v, F.lit(CRLF))], F.lit(CRLF))
    return F.concat(head, block, F.lit(CRLF + CRLF))


def derive(found: DataFrame) -> DataFrame:
    """The responses with title, lang, links, text, metadata_id, conversion_id, fields, and the three records as text."""
    html = F.col("payload")
    tags = F.regexp_extract_all(html, F.lit("(?i)<a" + INSIDE), 1)
    links = F.array_distinct(F.filter(F.transform(tags, lambda t: attribute(t, "href")), lambda x: x.isNotNull()))
    df = without(found, *DERIVED).select("*", _tidy(_first(html, r"(?is)<title[^>]*>(.*?)</title>")).alias("title"),
                      F.coalesce(attribute(_first(html, "(?i)<html" + INSIDE), "lang"), F.lit("")).alias("lang"), links.alias("links"), plain_text(html).alias("text"),
                      record_id(F.col("record_id"), F.lit("metadata")).alias("metadata_id"),
                      record_id(F.col("record_id"), F.lit("conversion")).alias("conversion_id"))
    line = lambda k, v: F.concat(F.lit(k + ": "), v, F.lit(CRLF))
    outlinks = F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), F.regexp_replace(x, r"[\r\n]+", " "), F.lit(CRLF))), "")
    source = F.regexp_replace(F.regexp_replace("http_headers", r"\r\n\r\n$", ""), r"\r\n", "\r\nsource-header: ")
    fields = F.concat(line("title", F.replace(F.col("title"), F.lit("\n"), F.lit(" "))), line("language", F.regexp_replace("lang", r"[\r\n]+", " ")),
                      F.lit("source-header: "), source, F.lit(CRLF), line("source-payload-digest", F.col("payload_digest")),
                      line("source-block-digest", F.col("block_digest")), line("conversion", F.col("conversion_id")), outlinks)
    df = df.withColumn("fields", fields)
    refers = [("WARC-Refers-To", F.col("record_id"))]
    return df.select(
        "*",
        _record("response", F.col("record_id"), "application/http; msgtype=response", F.concat("http_headers", "payload"),
                [("WARC-Payload-Digest", F.col("payload_digest"))]).alias("response_record"),
        _record("metadata", F.col("metadata_id"), "application/warc-fields", F.col("fields"), refers).alias("metadata_record"),
        _record("conversion", F.col("conversion_id"), "text/plain; charset=utf-8", F.col("text"), refers).alias("conversion_record"))


def write(records: DataFrame, column: str, path: str, compression: str = "gzip") -> None:
    """Write records to WARC files, one per task: a record ends with the line feed that the text sink adds."""
    records.select(F.expr(f"substring({column}, 1, length({column}) - 1)").alias("value")).write.option("compression", compression).text(path)
