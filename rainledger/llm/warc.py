"""WARC derivatives: a metadata record and a plain-text conversion record for every response.

A page becomes a response record (id, target, payload digest), and that becomes two records that name it in
WARC-Refers-To: ``metadata`` with the title, language, character set and links found in the page, and ``conversion`` with its text.
Record ids are UUIDs derived from what they name, so a retried task writes the same ones. Digests are SHA-256 in hex. Column
expressions only, row by row: no shuffle.

Where the table has them, columns with the response's date, its own record id and its headers are named by parameters: the date
becomes WARC-Date and WARC-Refers-To-Date, the record id is what WARC-Refers-To names, and each header is kept, in its
order, as a ``source-<name>`` field of the metadata record. A derived record's WARC-Payload-Digest is that of its own
block; the response's goes into WARC-Refers-To-Payload-Digest. Without a date column the records have no WARC-Date, which
a file of them must be given by its writer.

Text, titles and links have their character references decoded once, from left to right: decimal and hexadecimal numbers, and the
named ones of HTML 4. A reference that names no character (0, surrogates, beyond U+10FFFF, unknown names) stays as
it is. Attributes may stand in double or single quotes, or in none.

A null page is an empty one, a null address an empty target; a null date gives no date fields, a null record id the derived one, null
headers none, and line ends in a header's value become blanks. Rows that repeat an id are responses of their own; equal rows give
equal records. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Named character references and what they stand for; a blank that must not break is a plain one here.
ENTITIES = {name: chr(code) for name, code in sorted(name2codepoint.items())} | {"apos": "'", "nbsp": " "}
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<title\b.*?</title\s*>"
_BREAKS = r"(?i)<(br|/p|/div|/li|/h[1-6]|/tr|/article|/footer|/nav|/ul|/ol|/table)\b[^>]*>"
_TAGS = r"(?s)<[^>]*>"
_TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
_VALUE = r"""("[^"]*"|'[^']*'|[^ \t\r\n\f"'>]+)"""
_LANG = r"(?i)<html\b[^>]*[ \t\r\n\f]lang[ \t\r\n\f]*=[ \t\r\n\f]*" + _VALUE
_CHARSET = r"""(?i)<meta\b[^>]*\bcharset[ \t\r\n\f]*=[ \t\r\n\f]*["']?([A-Za-z0-9_-]+)"""
_LINK = r"(?i)<a\b[^>]*[ \t\r\n\f]href[ \t\r\n\f]*=[ \t\r\n\f]*" + _VALUE
_QUOTES = r"""^["']|["']$"""
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
_END = "\r\n"


def _character(reference: Column) -> Column:
    """The character that a reference (without & and ;) stands for, or null."""
    hexadecimal = F.lower(F.substring(reference, 2, 1)) == "x"
    digits = F.when(hexadecimal, F.substring(reference, 3, 6)).otherwise(F.substring(reference, 2, 7))
    number = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("long")
    real = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    letter = F.when(real, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    names = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])
    letter = F.when(number == 160, " ").otherwise(letter)
    return F.when(F.startswith(reference, F.lit("#")), letter).otherwise(F.try_element_at(names, reference))


def _decoded(text: Column) -> Column:
    """The text with its character references decoded."""

    def piece(s: Column, i: Column) -> Column:
        reference = F.regexp_extract(s, _REFERENCE, 1)
        letter = F.when(reference != "", _character(reference))
        after = F.when(letter.isNull(), F.concat(F.lit("&"), s)).otherwise(
            F.concat(letter, F.substr(s, F.length(reference) + 2))
        )
        return F.when(i == 0, s).otherwise(after)

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "&"), piece), "")).otherwise(text)


def _unquoted(value: Column) -> Column:
    return F.regexp_replace(value, _QUOTES, "")


def plain_text(html: Column) -> Column:
    """The visible text, a line per block, blanks joined, empty lines left out."""
    text = F.regexp_replace(F.regexp_replace(html, _HIDDEN, ""), _BREAKS, "\n")
    text = _decoded(F.regexp_replace(text, _TAGS, " "))
    lines = F.transform(F.split(text, "\n"), lambda s: F.trim(F.regexp_replace(s, r"[ \t\r]+", " ")))
    return F.array_join(F.filter(lines, lambda s: s != ""), "\n")


def _uuid(*parts: Column) -> Column:
    digest = F.sha2(F.concat_ws("\n", *parts), 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts]), F.lit(">"))


def derive_records(
    pages: DataFrame, date: str | None = None, record_id: str | None = None, headers: str | None = None
) -> DataFrame:
    """Two rows a page: page_id, record_type, record_id, refers_to, target_uri, content_type, content_length,
    block_digest, source_digest, ``header`` (the record's head as written) and ``block`` (its content).

    The parameters name columns of the response: ``date`` a timestamp, or text in the form of WARC-Date; ``record_id`` text;
    ``headers`` an array of structs of name and value, or a map, which is taken in the order of its names."""
    none = F.lit(None).cast("string")
    kinds = dict(pages.dtypes)
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    when = none if date is None else F.col(date)
    if date is not None and kinds[date].startswith("timestamp"):
        utc = when if kinds[date] == "timestamp_ntz" else F.to_utc_timestamp(when, F.current_timezone())
        when = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    named = F.array().cast("array<struct<name:string,value:string>>") if headers is None else F.col(headers)
    if headers is not None and kinds[headers].startswith("map"):
        named = F.array_sort(F.map_entries(named))
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        html.alias("html"),
        url.alias("target_uri"),
        when.cast("string").alias("date"),
        (none if record_id is None else F.col(record_id)).alias("own_id"),
        named.cast("array<struct<name:string,value:string>>").alias("headers"),
    )
    digest = F.concat(F.lit("sha256:"), F.sha2("html", 256))
    response = _uuid(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("target_uri"), digest)
    source = source.withColumn("source_digest", digest).withColumn("refers_to", F.coalesce("own_id", response))
    links = F.regexp_extract_all("html", F.lit(_LINK), 1)
    field = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(_END))
    kept = F.transform(
        "headers",
        lambda h: F.concat(
            F.lit("source-"), F.lower(h["name"]), F.lit(": "), F.regexp_replace(F.coalesce(h["value"], F.lit("")), r"[\r\n]+", " "), F.lit(_END)
        ),
    )
    metadata = F.concat(
        field("title", F.trim(F.regexp_replace(_decoded(F.regexp_extract("html", _TITLE, 1)), r"[ \t\r\n]+", " "))),
        field("languages", _unquoted(F.regexp_extract("html", _LANG, 1))),
        field("charset", F.regexp_extract("html", _CHARSET, 1)),
        F.array_join(F.transform(links, lambda x: field("outlink", _decoded(_unquoted(x)))), ""),
        F.coalesce(F.array_join(kept, ""), F.lit("")),
    )
    record = lambda kind, content, block: F.struct(
        F.lit(kind).alias("record_type"), F.lit(content).alias("content_type"), block.alias("block")
    )
    both = F.array(record("metadata", "application/warc-fields", metadata), record("conversion", "text/plain", plain_text(F.col("html"))))
    rows = source.withColumn("r", F.explode(both)).select("page_id", "target_uri", "date", "source_digest", "refers_to", "r.*")
    rows = (
        rows.withColumn("record_id", _uuid(F.col("record_type"), F.col("refers_to")))
        .withColumn("content_length", F.octet_length("block").cast("long"))
        .withColumn("block_digest", F.concat(F.lit("sha256:"), F.sha2("block", 256)))
    )
    dated = lambda name: F.coalesce(field(name, F.col("date")), F.lit(""))
    header = F.concat(
        F.lit("WARC/1.1" + _END),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", F.col("record_id")),
        dated("WARC-Date"),
        field("WARC-Refers-To", F.col("refers_to")),
        field("WARC-Refers-To-Target-URI", F.col("target_uri")),
        dated("WARC-Refers-To-Date"),
        field("WARC-Refers-To-Payload-Digest", F.col("source_digest")),
        field("WARC-Target-URI", F.col("target_uri")),
        field("WARC-Payload-Digest", F.col("block_digest")),
        field("WARC-Block-Digest", F.col("block_digest")),
        field("Content-Type", F.col("content_type")),
        field("Content-Length", F.col("content_length").cast("string")),
        F.lit(_END),
    )
    return rows.select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "content_type", "content_length",
        "block_digest", "source_digest", header.alias("header"), "block",
    )


def sql() -> str:
    """The same records in DuckDB's SQL, with digests of header and block in their place."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    end = "chr(13) || chr(10)"

    names = "MAP {" + ", ".join(f"{quote(n)}: {quote(c)}" for n, c in ENTITIES.items()) + "}"

    def decoded(text: str) -> str:
        found = f"regexp_extract(p, {quote(_REFERENCE)}, 1)"
        number = f"CASE WHEN lower({found}[2]) = 'x' THEN ('0x' || {found}[3:])::BIGINT ELSE try_cast({found}[2:] AS BIGINT) END"
        real = f"({number}) BETWEEN 1 AND 55295 OR ({number}) BETWEEN 57344 AND 1114111"
        letter = f"CASE WHEN ({number}) = 160 THEN ' ' WHEN {real} THEN chr(({number})::INTEGER) END"
        letter = f"CASE WHEN {found}[1] = '#' THEN {letter} ELSE ({names})[{found}] END"
        after = f"coalesce({letter} || p[length({found}) + 2:], '&' || p)"
        pieces = f"list_transform(string_split({text}, '&'), lambda p, i: CASE WHEN i = 1 THEN p ELSE {after} END)"
        return f"array_to_string({pieces}, '')"

    def uuid(text: str) -> str:
        cuts = " || '-' || ".join(f"substr(sha256({text}), {a}, {n})" for a, n in [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)])
        return f"'<urn:uuid:' || {cuts} || '>'"

    field = lambda name, value: f"{quote(name + ': ')} || {value} || {end}"
    visible = f"regexp_replace(regexp_replace(html, {quote(_HIDDEN)}, '', 'g'), {quote(_BREAKS)}, chr(10), 'g')"
    visible = decoded(f"regexp_replace({visible}, {quote(_TAGS)}, ' ', 'g')")
    lines = f"list_transform(string_split({visible}, chr(10)), lambda s: trim(regexp_replace(s, '[ \\t\\r]+', ' ', 'g'), ' '))"
    title = decoded(f"regexp_extract(html, {quote(_TITLE)}, 1)")
    unquoted = lambda value: f"regexp_replace({value}, {quote(_QUOTES)}, '', 'g')"
    links = f"list_transform(regexp_extract_all(html, {quote(_LINK)}, 1), lambda x: {field('outlink', decoded(unquoted('x')))})"
    metadata = " || ".join([
        field("title", f"trim(regexp_replace({title}, '[ \\t\\r\\n]+', ' ', 'g'), ' ')"),
        field("languages", unquoted(f"regexp_extract(html, {quote(_LANG)}, 1)")),
        field("charset", f"regexp_extract(html, {quote(_CHARSET)}, 1)"),
        f"coalesce(array_to_string({links}, ''), '')",
    ])
    header = " || ".join([
        f"'WARC/1.1' || {end}", field("WARC-Type", "record_type"), field("WARC-Record-ID", "record_id"),
        field("WARC-Refers-To", "refers_to"), field("WARC-Refers-To-Target-URI", "target_uri"),
        field("WARC-Refers-To-Payload-Digest", "source_digest"), field("WARC-Target-URI", "target_uri"),
        field("WARC-Payload-Digest", "block_digest"), field("WARC-Block-Digest", "block_digest"),
        field("Content-Type", "content_type"), field("Content-Length", "content_length::VARCHAR"), end,
    ])
    response = uuid("'response' || chr(10) || coalesce(page_id::VARCHAR, '') || chr(10) || target_uri || chr(10) || source_digest")
    return f"""
WITH source AS (
  SELECT page_id, coalesce(html, '') AS html, coalesce(url, '') AS target_uri, 'sha256:' || sha256(coalesce(html, '')) AS source_digest
  FROM pages),
response AS (SELECT *, {response} AS refers_to FROM source),
records AS (
  SELECT *, 'metadata' AS record_type, 'application/warc-fields' AS content_type, {metadata} AS block FROM response
  UNION ALL
  SELECT *, 'conversion', 'text/plain', coalesce(array_to_string(list_filter({lines}, lambda s: s <> ''), chr(10)), '') FROM response),
named AS (
  SELECT *, {uuid("record_type || chr(10) || refers_to")} AS record_id, octet_length(encode(block))::BIGINT AS content_length,
    'sha256:' || sha256(block) AS block_digest
  FROM records)
SELECT page_id, record_type, record_id, refers_to, target_uri, content_type, content_length, block_digest, source_digest,
  sha256({header}) AS header_sha256
FROM named"""
