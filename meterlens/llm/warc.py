"""Derive metadata and plain-text conversion records from WARC responses.

Every response gives two records. The *metadata* record describes the response as JSON
(status, source headers, title, links, sizes, digests); the *conversion* record holds its
plain text. Both carry ``WARC-Refers-To`` with the response's record id and its target
address and date, and the digests of their own blocks; the metadata record also names the
conversion made with it (``WARC-Concurrent-To``). Ids are derived from the response's id and
the record's type, so a rerun, or a task run twice, writes the same records.

Only column expressions are used, no shuffle: a row becomes two rows where it is read.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
#: Characters of base 32 as RFC 4648 and as ``conv`` write them.
RFC_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
#: Elements whose content is no text, to the page's end if they aren't closed, and those that end a line.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|title|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\z)"
BREAKS = r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|blockquote|pre)\b[^>]*>"
TAGS = r"<[A-Za-z/!?][^>]*>"
REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
#: All named references and what numbers from 128 to 159 stand for, from Python's own tables; a no-break space
#: is a space in plain text. The commonest come first, where they are found soonest.
COMMON = ["amp", "nbsp", "quot", "lt", "gt", "apos", "copy", "middot", "mdash", "ndash", "rsquo", "hellip"]
NAMED = {name: html.entities.html5[name + ";"].replace("\xa0", " ") for name in [
    *COMMON, *(n[:-1] for n in html.entities.html5 if n[-1] == ";" and n[:-1] not in COMMON)]}
LATIN = {str(i): bytes([i]).decode("cp1252", "replace") for i in range(128, 160)}
PAIR, ENTRY = "\x1f", "\x1e"
REPLACEMENT = "\ufffd"


def sha1_base32(block: Column) -> Column:
    """``sha1:`` and the digest in base 32, as WARC files label it."""
    digest = F.sha1(block)
    parts = [
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*parts), CONV_DIGITS, RFC_DIGITS))


def record_id(*parts: Column) -> Column:
    """A name-based identifier: ``<urn:uuid:...>`` of the parts' digest."""
    h = F.sha1(F.concat_ws("|", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), cut[0], F.lit("-"), cut[1], F.lit("-5"), cut[2],
                    F.lit("-8"), cut[3], F.lit("-"), cut[4], F.lit(">"))


def looked_up(table: dict[str, str], key: Column) -> Column:
    """The entry of a table that Spark folds to one constant; null if there is none."""
    text = ENTRY.join(f"{k}{PAIR}{v}" for k, v in table.items())
    return F.try_element_at(F.str_to_map(F.lit(text), F.lit(ENTRY), F.lit(PAIR)), key)


def character(code: Column) -> Column:
    """The character of a code point; the replacement character where there is none."""
    known = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(F.when(known, code).otherwise(0xFFFD)), 8, "0"))
    return F.coalesce(looked_up(LATIN, code.cast("string")), F.decode(utf32, "UTF-32"))


def references_read(text: Column) -> Column:
    """``text`` with every character reference that ends in a semicolon replaced by its character.

    Named ones are those of HTML 5, numbers are decimal or hexadecimal; others stay as written.
    What a reference gives is not read again.
    """
    def piece(found: Column) -> Column:
        part, name = found["part"], found["name"]
        number = F.when(F.substring(name, 1, 1) == "#", F.when(
            F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substring(name, 3, 8), 16, 10)
        ).otherwise(F.substring(name, 2, 8))).try_cast("long")
        read = F.when(name == "", None).when(number.isNotNull(), character(number)).otherwise(
            looked_up(NAMED, name))
        rest = F.substr(part, F.length(name) + 2)
        return F.when(found["first"], part).when(read.isNotNull(), F.concat(read, rest)).otherwise(
            F.concat(F.lit("&"), part))

    # One pass over the pieces: the text stands in the expression once, the pattern is matched once.
    pieces = F.transform(F.split(text, "&", -1), lambda p, i: F.struct(
        p.alias("part"), F.regexp_extract(p, REFERENCE, 1).alias("name"), (i == 0).alias("first")))
    return F.array_join(F.transform(pieces, piece), "")


def plain_text(html: Column) -> Column:
    """Text of a page: no scripts, comments or tags, a line for each block, references read."""
    text = F.regexp_replace(html, HIDDEN, " ")
    text = F.regexp_replace(text, r"[ \t\r\n]+", " ")
    text = F.regexp_replace(text, BREAKS, "\n")
    text = F.regexp_replace(text, TAGS, "")
    text = references_read(text)
    text = F.regexp_replace(text, r"[ ]*\n[ \n]*", "\n")
    return F.regexp_replace(text, r"^[ \n]+|[ \n]+$", "")


def responses_of_pages(pages: DataFrame) -> DataFrame:
    """Response records of crawled pages: (record_id, target_uri, date, headers, body).

    The table keeps neither time nor headers of the fetch: the date is the epoch and the
    headers are a status line and a content type. A null page is an empty body.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        "page_id",
        record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                  F.coalesce("url", F.lit("")), F.sha1(body)).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8").alias("headers"),
        body.alias("body"),
    )


def derive_records(responses: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Two rows per response: its metadata and its conversion record.

    ``responses`` has record_id, target_uri, date, headers (status line and header lines)
    and body; other columns are ignored unless in ``keep``. Returns ``keep`` and record_type,
    record_id, refers_to, concurrent_to, target_uri, date, content_type, payload_digest (of
    the response's body), block_digest, content_length (UTF-8 bytes), block. Null headers or
    bodies are empty, a null address or date stays null, a page without text has an empty
    conversion block, a very long one is converted whole. Repeated responses give repeated
    records; no rows give none. Columns in ``keep`` must not be called like those returned.
    For pages of a table without headers (``responses_of_pages``) the headers are made up of the
    fetch's defaults.
    """
    body = F.coalesce(F.col("body"), F.lit(""))
    headers = F.coalesce(F.col("headers"), F.lit(""))
    base = responses.select(
        *keep, F.col("record_id").alias("_response"), "target_uri", "date",
        headers.alias("_headers"), body.alias("_body"),
        plain_text(body).alias("_text"),
        sha1_base32(body).alias("payload_digest"),
    )
    response = F.coalesce(F.col("_response"), F.lit(""))
    links = F.array_distinct(F.regexp_extract_all(
        F.col("_body"), F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)"), F.lit(1)))
    title = F.regexp_extract(F.col("_body"), r"(?is)<title[^>]*>(.*?)</title", 1)
    lines = F.filter(F.split("_headers", "\r?\n"), lambda x: x != "")
    metadata = F.to_json(F.struct(
        F.col("_response").alias("response"),
        F.regexp_extract("_headers", r"^HTTP/\S+ (\d+)", 1).alias("status"),
        lines.alias("headers"),
        F.trim(title).alias("title"),
        links.alias("links"),
        F.length(F.encode("_body", "UTF-8")).alias("body_bytes"),
        F.length("_text").alias("text_chars"),
        F.col("payload_digest"),
    ))
    conversion_id = record_id(F.lit("conversion"), response)
    metadata_id = record_id(F.lit("metadata"), response)

    def record(kind: str, own: Column, other: Column, content: str, block: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("record_type"), own.alias("record_id"),
            other.alias("concurrent_to"), F.lit(content).alias("content_type"),
            block.alias("block"))

    none = F.lit(None).cast("string")
    both = F.array(
        record("metadata", metadata_id, conversion_id, "application/json", metadata),
        record("conversion", conversion_id, none, "text/plain", F.col("_text")),
    )
    rows = base.select(
        *keep, F.col("_response").alias("refers_to"), "target_uri", "date", "payload_digest",
        F.explode(both).alias("_r"))
    block = F.col("_r.block")
    return rows.select(
        *keep, "_r.record_type", "_r.record_id", "refers_to", "_r.concurrent_to", "target_uri",
        "date", "_r.content_type", "payload_digest",
        sha1_base32(block).alias("block_digest"),
        F.length(F.encode(block, "UTF-8")).cast("long").alias("content_length"),
        block.alias("block"),
    )


def warc_text(records: DataFrame) -> DataFrame:
    """One column ``value`` with each record in WARC/1.1 form.

    Write it with ``.write.option("lineSep", "\\r\\n\\r\\n").option("compression",
    "gzip").text(path)``: the separator ends each record.
    """
    def header(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
                      ).otherwise(F.lit(""))

    return records.select(F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.col("record_id")),
        header("WARC-Refers-To", F.col("refers_to")),
        header("WARC-Concurrent-To", F.col("concurrent_to")),
        header("WARC-Target-URI", F.col("target_uri")),
        header("WARC-Date", F.col("date")),
        header("WARC-Payload-Digest", F.col("payload_digest")),
        header("WARC-Block-Digest", F.col("block_digest")),
        header("Content-Type", F.col("content_type")),
        header("Content-Length", F.col("content_length").cast("string")),
        F.lit(CRLF), F.col("block"),
    ).alias("value"))
