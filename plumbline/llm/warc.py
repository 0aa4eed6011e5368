"""WARC derivatives: metadata and plain-text conversion records of captured responses.

A response becomes two records that name it in WARC-Refers-To, together with its address, date and digests; the metadata
record also names the conversion and keeps the source's HTTP headers and out-links. Everything is column expressions
without a shuffle, so any number of responses is one pass over them.
"""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
HIDDEN = r"(?is)<!--.*?-->|<(script|style|noscript|template)\b[^>]*>.*?</(script|style|noscript|template)\s*>"
BREAKS = r"(?i)</?(address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^>]*>"
TAG = r"(?s)<[^>]*>"
LINK = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"'>]*)["']"""
REFERENCE = "&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
# characters of HTML's names, by first letter, and of the numbers that it reads as Windows-1252
NAMED: dict[str, dict[str, str]] = {}
for _name, _characters in html.entities.html5.items():
    if _name.endswith(";"):
        NAMED.setdefault(_name[0], {})[_name[:-1]] = _characters
NAMED["n"]["nbsp"] = " "
WINDOWS = {str(i): bytes([i]).decode("cp1252") for i in range(128, 160) if i not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def base32(hexadecimal: Column) -> Column:
    """RFC 4648 letters of 40 hexadecimal digits, five digits to four letters at a time."""
    parts = [F.lpad(F.conv(F.substring(hexadecimal, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha1:"), base32(F.sha1(block.cast("binary"))))


def record_id(*parts: Column) -> Column:
    """A stable identifier in the form of a UUID, from what identifies the record."""
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Pages (page_id, url, html) as response records: identifiers, HTTP headers, payload and its digest."""
    body = F.coalesce(F.col("html"), F.lit(""))
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                       F.octet_length(body).cast("string"), F.lit(CRLF))
    return pages.select(
        record_id(F.lit("response"), F.col("page_id").cast("string"), F.col("url")).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("warc_date"), headers.alias("http_headers"),
        body.alias("payload"), digest(body).alias("payload_digest"))


def _referred(reference: Column) -> Column:
    """What one character reference stands for: itself, if HTML has no such name."""
    named = F.from_json(F.lit(json.dumps(NAMED)), "map<string,map<string,string>>")
    windows = F.from_json(F.lit(json.dumps(WINDOWS)), "map<string,string>")
    name = F.substring(reference, F.lit(2), F.length(reference) - 2)
    letter = F.try_element_at(F.try_element_at(named, F.substring(name, 1, 1)), name)
    hexadecimal = F.lower(F.substring(name, 2, 1)) == "x"
    digits = F.regexp_replace(name, "^#[xX]?0*", "")
    number = F.when(F.length(digits) > 7, F.lit(0)).when(hexadecimal, F.conv(digits, 16, 10).cast("int")).otherwise(digits.try_cast("int"))
    valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    point = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, number).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")
    number_read = F.coalesce(F.try_element_at(windows, number.cast("string")), point)
    return F.when(F.substring(name, 1, 1) == "#", number_read).otherwise(F.coalesce(letter, reference))


def decoded(text: Column) -> Column:
    """Character references as characters, each read once: all names of HTML that end in a semicolon, and numbers.

    A no-break space by name is a space. Numbers that are no character are U+FFFD.
    """
    between = F.split(text, REFERENCE, -1)
    references = F.concat(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)), F.array(F.lit("")))
    return F.when(~F.contains(text, F.lit("&")), text).otherwise(F.array_join(F.zip_with(
        between, references, lambda a, r: F.concat(a, F.when(r == "", r).otherwise(_referred(r)))), ""))


def block_lines(html: Column) -> Column:
    """Visible text of a page with a line for each block element, references as they are."""
    shown = F.regexp_replace(F.regexp_replace(html, HIDDEN, ""), r"\s+", " ")
    return F.regexp_replace(F.regexp_replace(shown, BREAKS, "\n"), TAG, "")


def plain_text(lines: Column) -> Column:
    """Block lines with references decoded and white space collapsed."""
    text = F.regexp_replace(F.regexp_replace(decoded(lines), r"[ \t]+", " "), r" ?\n[ \n]*", "\n")
    return F.regexp_replace(text, r"^[ \n]+|[ \n]+$", "")


def derivatives(records: DataFrame) -> DataFrame:
    """Two records of each response: a metadata record and a conversion to plain text.

    Nulls: an absent address or header line is left out of the block, an absent payload is empty and converts to an
    empty block. Repeated responses give repeated records. Other columns are ignored. No responses, no records.
    """
    # in steps, so that what a later one reads more than once is worked out once
    found = records.withColumn("_payload", F.coalesce(F.col("payload"), F.lit(""))).select(
        "*", block_lines(F.col("_payload")).alias("_lines"), F.regexp_extract("_payload", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("_named"),
        F.regexp_extract_all("_payload", F.lit(LINK), F.lit(1)).alias("_links"))
    read = found.select(
        "*", plain_text(F.col("_lines")).alias("_text"), F.regexp_replace(F.trim(decoded(F.col("_named"))), r"\s+", " ").alias("_title"),
        F.transform("_links", lambda x: F.concat(F.lit("outlink: "), F.regexp_replace(decoded(x), r"\s+", "%20"), F.lit(" L a/@href"))).alias("_out"))
    payload, title, links = F.col("_payload"), F.col("_title"), F.col("_out")
    conversion = record_id(F.lit("conversion"), F.col("record_id"))
    known = F.transform(
        F.split(F.coalesce(F.col("http_headers"), F.lit("")), CRLF),
        lambda x: F.when(F.length(x) > 0, F.concat(F.lit("http-header: "), x)))
    lines = F.array_compact(F.concat(
        F.array(
            F.concat(F.lit("conversion-record: "), conversion),
            F.concat(F.lit("source-payload-digest: "), F.col("payload_digest")),
            F.concat(F.lit("source-payload-length: "), F.octet_length(payload).cast("string")),
            F.when(F.length(title) > 0, F.concat(F.lit("title: "), title)),
        ), known, links))
    fields = F.concat(F.array_join(lines, CRLF), F.lit(CRLF))
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), record_id(F.lit("metadata"), F.col("record_id")).alias("id"),
                 F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), conversion.alias("id"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("_text").alias("block")))
    rows = read.select("target_uri", "warc_date", F.col("record_id").alias("refers_to"),
                          F.col("payload_digest").alias("source_payload_digest"), F.explode(kinds).alias("x"))
    return rows.select(
        F.col("x.id").alias("record_id"), F.col("x.warc_type").alias("warc_type"), "target_uri", "warc_date", "refers_to",
        "source_payload_digest", F.col("x.content_type").alias("content_type"),
        F.octet_length("x.block").cast("long").alias("content_length"), digest(F.col("x.block")).alias("block_digest"),
        F.col("x.block").alias("block"))


def serialized(records: DataFrame) -> DataFrame:
    """Derivative records as text: version, header lines, an empty line and the block, without the two final line ends."""
    named = {
        "WARC-Type": "warc_type", "WARC-Record-ID": "record_id", "WARC-Target-URI": "target_uri", "WARC-Date": "warc_date",
        "WARC-Refers-To": "refers_to", "WARC-Refers-To-Target-URI": "target_uri", "WARC-Refers-To-Date": "warc_date",
        "WARC-Source-Payload-Digest": "source_payload_digest", "WARC-Block-Digest": "block_digest",
        "Content-Type": "content_type", "Content-Length": "content_length",
    }
    lines = [F.concat(F.lit(f"{name}: "), F.col(c).cast("string"), F.lit(CRLF)) for name, c in named.items()]
    return records.select(F.concat(F.lit(f"WARC/1.1{CRLF}"), F.concat_ws("", *lines), F.lit(CRLF), F.col("block")).alias("record"))


def write_warc(records: DataFrame, path: str) -> None:
    """Compressed WARC files under path, one for each partition; the two line ends after a record separate rows."""
    serialized(records).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)
