"""Registered queries of the dealt operators, next to their SQL where SQL can state the result."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import (bpe, decontaminate, filter_audit, language_id, licenses, line_dedup, minhash, simhash, source_audit, substring_dedup,
                          suffix_dedup, warc, winnowing)
from rollbook.llm.common import documents, table

TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run
    return register


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(~language_id.held_out()), "lang", "text", "doc_id")
    return (language_id.predict(docs.select("doc_id", "text"), model)
            .select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "ambiguous"))


@query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    wanted = ("n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.encode_documents(docs, TOKENIZER, public_tokenizers.PATTERN, results=wanted).select("doc_id", *wanted)


LINE_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.line, k.pos, f.key IS NOT NULL AND k.doc_id < f.last AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


@query(LINE_SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SHINGLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                                 ELSE w END)) AS g FROM w),
n AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
d AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, d.b FROM r JOIN d ON r.v = d.a)
SELECT n.doc_id, n.n AS n_shingles, min(r.v) AS component_id, n.doc_id = min(r.v) AS kept
FROM n JOIN r ON r.u = n.doc_id GROUP BY n.doc_id, n.n"""


@query(SHINGLE_SQL)
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return minhash.near_duplicates(docs, size=2).select("doc_id", "n_shingles", "component_id", "kept")


LEAK_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
p AS (SELECT doc_id, len(w) AS n, unnest(range(1, len(w) - 3)) AS p, w FROM d),
s AS (SELECT doc_id, n, p, array_to_string(w[p:p + 4], ' ') AS g FROM p),
q AS (SELECT item_id, len(w) AS m, unnest(range(1, len(w) - 3)) AS p, w FROM b),
t AS (SELECT item_id, m, p, array_to_string(w[p:p + 4], ' ') AS g FROM q),
h AS (SELECT DISTINCT s.doc_id, s.n, s.p, t.item_id, t.m FROM s JOIN t ON s.g = t.g),
c AS (SELECT DISTINCT doc_id, item_id, m, unnest(range(greatest(0, least(p - m + 4, n - m)), greatest(0, least(p - 1, n - m)) + 1)) AS start FROM h),
x AS (SELECT c.doc_id, c.item_id, c.m, c.start, s.g, count(*) * length(s.g) AS a
      FROM c JOIN s ON s.doc_id = c.doc_id AND s.p > c.start AND s.p <= c.start + c.m - 4 GROUP BY c.doc_id, c.item_id, c.m, c.start, s.g),
y AS (SELECT item_id, g, count(*) * length(g) AS a FROM t GROUP BY item_id, g),
z AS (SELECT item_id, sum(a) AS total FROM y GROUP BY item_id),
l AS (SELECT x.doc_id, x.item_id, x.m, x.start, sum(x.a) AS total, sum(least(x.a, coalesce(y.a, 0))) AS lesser
      FROM x LEFT JOIN y ON x.item_id = y.item_id AND x.g = y.g GROUP BY x.doc_id, x.item_id, x.m, x.start),
f AS (SELECT l.doc_id, l.item_id, l.m, l.start, CAST(l.lesser AS DOUBLE) / CAST(l.total + z.total - l.lesser AS DOUBLE) AS similarity
      FROM l JOIN z ON l.item_id = z.item_id WHERE 100 * l.lesser >= 80 * (l.total + z.total - l.lesser)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS nth FROM f)
SELECT doc_id, item_id, similarity, CAST(start AS INTEGER) AS start_word, CAST(m AS INTEGER) AS n_words FROM r WHERE nth = 1"""


@query(LEAK_SQL)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return decontaminate.contaminations(docs, table(spark, sf_dir, "benchmark")).drop("key", "hamming")


REPEAT_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS p, w FROM d WHERE len(w) >= 13),
s AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 12], ' ')) AS g FROM p),
f AS (SELECT g, min(doc_id) AS first FROM s GROUP BY g HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT s.doc_id, unnest(range(s.p, s.p + 13)) AS at_word FROM s JOIN f ON s.g = f.g WHERE s.doc_id > f.first),
w AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS at_word, unnest(w) AS word FROM d),
k AS (SELECT w.doc_id, w.at_word, w.word, c.doc_id IS NOT NULL AS gone FROM w LEFT JOIN c ON w.doc_id = c.doc_id AND w.at_word = c.at_word),
a AS (SELECT doc_id, count(*) AS n, sum(CASE WHEN gone THEN 1 ELSE 0 END) AS r,
             coalesce(string_agg(word, ' ' ORDER BY at_word) FILTER (WHERE NOT gone), '') AS t FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(a.n, 0) AS n_words, CAST(coalesce(a.r, 0) AS BIGINT) AS n_removed, sha256(coalesce(a.t, '')) AS kept_sha256
FROM d LEFT JOIN a ON d.doc_id = a.doc_id"""


@query(REPEAT_SQL)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


#: The pages carry no date of capture.
CAPTURED = "2020-01-01T00:00:00Z"


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SQL_NAMES = "MAP {" + ", ".join(f"'{name}': {code}" for name, code in sorted(warc.NAMES.items())) + "}"


def _sql_decoded(text: str) -> str:
    """Character references decoded, as ``warc.decoded`` states it."""
    code = (f"CASE WHEN regexp_matches(e, '^&#[xX]') THEN CAST('0x' || e[4:-2] AS BIGINT) WHEN e[2] = '#' THEN CAST(e[3:-2] AS BIGINT) "
            f"ELSE map_extract({_SQL_NAMES}, e[2:-2])[1] END")
    char = "CASE WHEN c = 0 OR c > 1114111 OR c BETWEEN 55296 AND 57343 THEN chr(65533) WHEN c IS NOT NULL THEN chr(CAST(c AS INTEGER)) END"
    each = f"lambda e: coalesce(list_transform([{code}], lambda c: {char})[1], e)"
    return (f"array_to_string(list_transform(list_zip(string_split_regex({text}, {_sql(warc.REFERENCE)}), "
            f"list_append(list_transform(regexp_extract_all({text}, {_sql(warc.REFERENCE)}), {each}), '')), lambda z: z[1] || z[2]), '')")


def _sql_tidy(text: str) -> str:
    return (rf"trim(regexp_replace(regexp_replace({_sql_decoded(text)}, {_sql(warc.BLANKS)}, ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10))")


def _sql_attribute(inside: str, name: str) -> str:
    pairs = f"list_zip(regexp_extract_all({inside}, {_sql(warc.ATTRIBUTE)}, 1), regexp_extract_all({inside}, {_sql(warc.ATTRIBUTE)}, 2))"
    value = f"list_filter({pairs}, lambda y: lower(y[1]) = '{name}')[1][2]"
    plain = f"list_transform([{value}], lambda v: CASE WHEN v[1] IN (chr(34), chr(39)) THEN v[2:-2] ELSE v END)[1]"
    return _sql_decoded(plain)


#: Each link in order, NULL for a tag without one.
_SQL_LINKS = f"list_transform(regexp_extract_all(html, {_sql('(?i)<a' + warc.INSIDE)}, 1), lambda tag: {_sql_attribute('tag', 'href')})"
_SQL_LANG = f"coalesce({_sql_attribute('regexp_extract(html, ' + _sql('(?i)<html' + warc.INSIDE) + ', 1)', 'lang')}, '')"
_SQL_UUID = "'<urn:uuid:' || substr({0}, 1, 8) || '-' || substr({0}, 9, 4) || '-' || substr({0}, 13, 4) || '-' || substr({0}, 17, 4) || '-' || substr({0}, 21, 12) || '>'"
WARC_SQL = rf"""
WITH p AS (SELECT page_id, coalesce(url, '') AS uri, coalesce(html, '') AS html FROM pages),
r AS (SELECT *, 'sha256:' || sha256(html) AS payload_digest,
             'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) AS head FROM p),
i AS (SELECT *, md5(uri || '|{CAPTURED}|' || payload_digest) AS h FROM r),
u AS (SELECT *, {_SQL_UUID.format('h')} AS response_id FROM i),
d AS (SELECT *, md5(response_id || '|metadata') AS hm, md5(response_id || '|conversion') AS hc,
             regexp_replace(html, '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g') AS t0 FROM u),
t AS (SELECT *, regexp_replace(regexp_replace(t0, '(?i)</?(p|div|br|li|ul|ol|tr|table|h[1-6]|article|section|header|footer|nav|title|blockquote|pre)([ \t\r\n\f][^>]*)?/?>', chr(10), 'g'), '<[^>]*>', '', 'g') AS t1 FROM d),
x AS (SELECT *, {_sql_tidy('t1')} AS text, {_sql_tidy("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title,
      {_SQL_LANG} AS lang, list_filter({_SQL_LINKS}, lambda x: x IS NOT NULL) AS every FROM t)
SELECT page_id, response_id, {_SQL_UUID.format('hm')} AS metadata_id, {_SQL_UUID.format('hc')} AS conversion_id, uri AS target_uri, title,
       lang, len(list_distinct(every)) AS n_links,
       payload_digest, 'sha256:' || sha256(head || html) AS block_digest,
       sha256('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: conversion' || chr(13) || chr(10) || 'WARC-Record-ID: ' || {_SQL_UUID.format('hc')} || chr(13) || chr(10)
              || 'WARC-Date: {CAPTURED}' || chr(13) || chr(10) || 'WARC-Target-URI: ' || uri || chr(13) || chr(10) || 'WARC-Refers-To: ' || response_id || chr(13) || chr(10)
              || 'WARC-Block-Digest: sha256:' || sha256(text) || chr(13) || chr(10) || 'Content-Type: text/plain; charset=utf-8' || chr(13) || chr(10)
              || 'Content-Length: ' || strlen(text) || chr(13) || chr(10) || chr(13) || chr(10) || text || chr(13) || chr(10) || chr(13) || chr(10)) AS conversion_sha256
FROM x"""


@query(WARC_SQL)
def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.derive(warc.responses(table(spark, sf_dir, "pages"), CAPTURED))
    return found.select("page_id", F.col("record_id").alias("response_id"), "metadata_id", "conversion_id", "target_uri", "title", "lang",
                        F.size("links").cast("long").alias("n_links"), "payload_digest", "block_digest",
                        F.sha2("conversion_record", 256).alias("conversion_sha256"))


#: The other half: the metadata record, and the outlinks in order, one a line.
METADATA_SQL = WARC_SQL[:WARC_SQL.rindex("FROM x") + 6].rpartition("\nSELECT page_id")[0] + rf""",
o AS (SELECT *, {_SQL_UUID.format('hm')} AS metadata_id, {_SQL_UUID.format('hc')} AS conversion_id, chr(13) || chr(10) AS nl FROM x),
l AS (SELECT *, list_filter(every, lambda v, i: list_position(every, v) = i) AS links FROM o),
f AS (SELECT *, 'title: ' || replace(title, chr(10), ' ') || nl || 'language: ' || regexp_replace(lang, '[\r\n]+', ' ', 'g') || nl || 'source-header: HTTP/1.1 200 OK' || nl
             || 'source-header: Content-Type: text/html; charset=utf-8' || nl || 'source-header: Content-Length: ' || strlen(html) || nl
             || 'source-payload-digest: ' || payload_digest || nl || 'source-block-digest: sha256:' || sha256(head || html) || nl
             || 'conversion: ' || conversion_id || nl
             || array_to_string(list_transform(links, lambda v: 'outlink: ' || regexp_replace(v, '[
]+', ' ', 'g') || nl), '') AS fields FROM l)
SELECT page_id, metadata_id, array_to_string(links, chr(10)) AS outlinks,
       sha256('WARC/1.1' || nl || 'WARC-Type: metadata' || nl || 'WARC-Record-ID: ' || metadata_id || nl || 'WARC-Date: {CAPTURED}' || nl
              || 'WARC-Target-URI: ' || uri || nl || 'WARC-Refers-To: ' || response_id || nl || 'WARC-Block-Digest: sha256:' || sha256(fields) || nl
              || 'Content-Type: application/warc-fields' || nl || 'Content-Length: ' || strlen(fields) || nl || nl || fields || nl || nl) AS metadata_sha256
FROM f"""


@query(METADATA_SQL)
def op4_warc_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.derive(warc.responses(table(spark, sf_dir, "pages"), CAPTURED))
    return found.select("page_id", "metadata_id", F.array_join("links", "\n").alias("outlinks"), F.sha2("metadata_record", 256).alias("metadata_sha256"))


@query()
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = licenses.train(licenses.sample_lines(docs, "doc_id", "text", sample_rows=600))
    return licenses.scan(docs, model)


@query()
def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.compared(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query()
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeated_bytes(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


FILTER_SQL = r"""
WITH g AS (SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT coalesce(text, '') AS text, min(doc_id) AS first FROM documents GROUP BY 1),
d AS (SELECT coalesce(d.lang, '') AS part, m.text, coalesce(g.good, FALSE) AS good, coalesce(g.toxic, FALSE) AS toxic, coalesce(d.doc_id > m.first, FALSE) AS again,
             list_filter(regexp_split_to_array(m.text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
      FROM documents d JOIN m ON coalesce(d.text, '') = m.text LEFT JOIN g ON d.doc_id = g.doc_id),
f AS (SELECT part, good, toxic, CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
             || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN again THEN 'E' ELSE '' END AS fails FROM d),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY part, fails),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, CAST(k AS INTEGER) AS step, filter_order[k] AS own, filter_order[1:k - 1] AS earlier FROM o, range(1, 6) r(k)),
x AS (SELECT c.*, s.*, contains(c.fails, s.own) AS fail, c.fails <> '' AND len(list_intersect(string_split(s.earlier, ''), string_split(c.fails, ''))) > 0
                AND s.earlier <> '' AS gone FROM c, s),
r AS (SELECT part, filter_order, step, own, sum(n) FILTER (WHERE NOT gone AND NOT fail) AS kept, sum(n) FILTER (WHERE NOT gone AND fail) AS removed,
             sum(n) FILTER (WHERE gone AND fail) AS redundant, sum(n) FILTER (WHERE fails = own) AS unique_fails,
             sum(good) FILTER (WHERE NOT gone AND fail) AS good_lost, sum(toxic) FILTER (WHERE NOT gone AND fail) AS toxic_lost FROM x GROUP BY ALL)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley FROM r"""


@query(FILTER_SQL)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = filter_audit.cells(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return filter_audit.audit(counts, [*filter_audit.text_failures(F.col("text")), filter_audit.REPEAT])


SOURCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS nth, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT nth, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT nth) >= 10),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*) AS c FROM t JOIN k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 2)) // (coalesce(n.n, 0) + 2 * v.v) AS p,
             1 + (CAST(1000000000 AS HUGEINT) * (k.total + 2)) // (v.n + 2 * v.v) AS q
      FROM g JOIN k ON g.lang = k.lang JOIN v ON g.lang = v.lang LEFT JOIN n ON g.lang = n.lang AND g.source = n.source
      LEFT JOIN c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE c > 0 AND p > q),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS nth FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(nth AS INTEGER) AS rank FROM z WHERE part = 'pair' OR nth <= 10"""


@query(SOURCE_SQL)
def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergences(documents(spark, sf_dir))


@query()
def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))
