"""WARC derivatives: metadata and plain-text conversion records from response records.

A record is a row: record_id, warc_type, refers_to, target_uri, warc_date, content_type,
block (binary), block_digest, payload_digest. From each response with an HTTP head come a
``metadata`` record (``application/warc-fields``: what is known of the source, all its headers
and digests, and the id of the conversion) and a ``conversion`` record with the text of the page. Both
refer to the response by its id, keep its target and date, and have digests of their own.
Ids are UUIDs made from the id of the response, so a second run makes the same records.

HTML becomes text by expressions: scripts, styles and comments go, blocks end lines, tags go,
numeric entities and the named ones of ``ENTITIES`` and ``RARE_ENTITIES`` are decoded, blanks collapse. A response that is encoded
(gzip and the like) or not text gets a metadata record with ``conversion-status: skipped`` and no conversion; one in
a character set that is unknown, or that its bytes do not follow, the same with ``undecodable``. Without a character set, or
with UTF-8, bytes that are not UTF-8 are read as Latin-1.
A null or headless block is an empty page with status 0. Null ids give records that refer
to nothing (null). Records of other types give nothing. Repeated rows repeat their derivatives. Extra columns are not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

FIELDS = ("record_id", "warc_type", "refers_to", "target_uri", "warc_date", "content_type", "block", "block_digest", "payload_digest")
#: Text patterns with their replacement, in the order of their use; RE2 and Java read them alike.
HTML_RULES = (
    (r"(?is)<!--.*?-->", ""),
    (r"(?is)<script\b.*?</script\s*>", ""),
    (r"(?is)<style\b.*?</style\s*>", ""),
    (r"(?is)<title\b.*?</title\s*>", ""),
    (r"(?i)<(?:br|/?p|/?div|/?li|/?ul|/?ol|/?tr|/?table|/?h[1-6]|/?article|/?section|/?nav|/?header|/?footer|/?body)\b[^>]*>", "\n"),
    (r"<[!/A-Za-z][^>]*>", ""),
)
#: Named entities that many texts have, those that few have, and the ampersand, which comes last, so that nothing is decoded twice.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"))
RARE_ENTITIES = (
    ("&apos;", "'"), ("&reg;", "®"), ("&trade;", "™"), ("&bull;", "•"), ("&hellip;", "…"), ("&ndash;", "–"), ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"),
    ("&ldquo;", "“"), ("&rdquo;", "”"), ("&laquo;", "«"), ("&raquo;", "»"), ("&deg;", "°"), ("&euro;", "€"), ("&pound;", "£"), ("&sect;", "§"),
    ("&times;", "×"), ("&auml;", "ä"), ("&ouml;", "ö"), ("&uuml;", "ü"), ("&Auml;", "Ä"), ("&Ouml;", "Ö"), ("&Uuml;", "Ü"), ("&szlig;", "ß"),
    ("&eacute;", "é"), ("&egrave;", "è"), ("&agrave;", "à"), ("&ccedil;", "ç"), ("&ntilde;", "ñ"),
)
AMPERSAND = (("&amp;", "&"),)
#: Character sets that expressions read; all others are left to Python's codecs.
UTF_8, LATIN_1 = ("", "utf-8", "utf8", "us-ascii", "ascii"), ("iso-8859-1", "latin1", "latin-1")
BLANKS = ((r"[ \t\r\f\x0B]+", " "), (r" ?\n[ \n]*", "\n"), (r"^[ \n]+|[ \n]+$", ""))


def uuid_of(*parts: Column) -> Column:
    """``urn:uuid`` from a hash of the parts; null if one of them is."""
    digest = F.md5(F.concat(*parts).cast("binary"))
    cut = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(digest.isNotNull(), F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *cut)))


def digest_of(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def without_numeric_entities(text: Column) -> Column:
    """The text with ``&#233;`` and ``&#xE9;`` as characters; numbers that name none stay."""

    def piece(p: Column) -> Column:
        number = F.regexp_extract(p, "^([0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});", 1)
        code = F.when(F.lower(number).startswith("x"), F.conv(F.substring(number, 2, 6), 16, 10)).otherwise(number).try_cast("int")
        exists = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        # An ampersand stays an entity till the end, so that it makes no new one with what follows.
        character = F.when(code == 38, "&amp;").otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        rest = F.substr(p, F.length(number) + 2)
        return F.when(exists, F.concat(character, rest)).otherwise(F.concat(F.lit("&#"), p))

    def decoded(t: Column) -> Column:
        parts = F.split(t, "&#")
        return F.concat(parts[0], F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), piece), ""))

    return F.when(text.contains("&#"), decoded(text)).otherwise(text)


def without_entities(text: Column) -> Column:
    """The text with its entities as characters. Few texts have another one than those that all have, so most are not
    searched for each."""

    def replaced(t: Column, entities) -> Column:
        for name, character in entities:
            t = F.replace(t, F.lit(name), F.lit(character))
        return t

    def rest(t: Column) -> Column:
        return replaced(without_numeric_entities(t), RARE_ENTITIES)

    # In a lambda the text is computed once, however often it is used.
    return F.transform(F.array(replaced(text, ENTITIES)), lambda t: replaced(F.when(t.rlike("&(?!amp;)[#A-Za-z]"), rest(t)).otherwise(t), AMPERSAND))[0]


@F.pandas_udf(StringType())
def decoded_by_codec(body: pd.Series, charset: pd.Series) -> pd.Series:
    """Text of bodies in any character set Python knows; null for unknown ones and bytes that do not fit."""

    def one(value, name):
        try:
            return None if value is None else bytes(value).decode(name)
        except (LookupError, UnicodeError, ValueError):
            return None

    return pd.Series([one(b, c) for b, c in zip(body, charset, strict=True)], dtype=object)


def html_text(html: Column) -> Column:
    for pattern, replacement in HTML_RULES:
        html = F.regexp_replace(html, pattern, replacement)
    html = without_entities(html)
    for pattern, replacement in BLANKS:
        html = F.regexp_replace(html, pattern, replacement)
    return html


def responses_of(pages: DataFrame, date: str) -> DataFrame:
    """Response records of stored pages (page_id, url, html), as a crawl of ``date`` had made them."""
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(head.cast("binary"), html)
    return pages.select(
        uuid_of(F.lit("response|"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("url", F.lit(""))).alias("record_id"),
        F.lit("response").alias("warc_type"),
        F.lit(None).cast("string").alias("refers_to"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("warc_date"),
        F.lit("application/http; msgtype=response").alias("content_type"),
        block.alias("block"),
        digest_of(block).alias("block_digest"),
        digest_of(html).alias("payload_digest"),
    )


def parsed(responses: DataFrame) -> DataFrame:
    """Head, status, body and character set of responses; one generator step per record."""
    block = F.coalesce("block", F.lit(b""))
    # Latin-1 keeps one character per byte, so positions in the head are positions in the block.
    end = F.instr(F.decode(block, "ISO-8859-1"), "\r\n\r\n")
    opened = responses.where(F.col("warc_type") == "response").select(*FIELDS, F.inline(F.array(F.struct(end.alias("end"), block.alias("whole")))))
    head = F.when(F.col("end") > 0, F.decode(F.expr("substring(whole, 1, end - 1)"), "ISO-8859-1")).otherwise("")
    body = F.when(F.col("end") > 0, F.expr("substring(whole, end + 4)")).otherwise(F.col("whole"))
    first = opened.select(*FIELDS, F.inline(F.array(F.struct(head.alias("head"), body.alias("body")))))
    header = lambda name: F.lower(F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1))
    charset = F.regexp_extract(header("content-type"), r"charset=\x22?([^\x22;\s]*)", 1)
    coded = header("content-encoding")
    kind = header("content-type")
    return first.select(
        *FIELDS,
        "head",
        "body",
        F.coalesce(F.expr("try_cast(regexp_extract(head, '^HTTP/[0-9.]+ ([0-9]+)', 1) AS INT)"), F.lit(0)).alias("status"),
        charset.alias("charset"),
        (coded.isin("", "identity") & ((kind == "") | kind.contains("text/") | kind.contains("html"))).alias("readable"),
    )


def derivatives(responses: DataFrame) -> DataFrame:
    """Metadata and conversion records, with ``length`` and the fields of FIELDS."""
    charset = F.col("charset")
    other = F.col("readable") & ~charset.isin(*UTF_8, *LATIN_1)
    # Only bodies in other character sets travel to Python.
    rows = parsed(responses).withColumn("decoded", decoded_by_codec(F.when(other, F.col("body")), F.when(other, charset)))
    latin_1 = F.decode("body", "ISO-8859-1")
    decoded = (
        F.when(charset.isin(*LATIN_1), latin_1)
        .when(charset.isin(*UTF_8), F.coalesce(F.expr("try_validate_utf8(CAST(body AS STRING))"), latin_1))
        .otherwise(F.col("decoded"))
    )
    html = F.coalesce("page", F.lit(""))
    title = html_text(F.regexp_extract("html", r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1))
    links = F.size(F.regexp_extract_all("html", F.lit(r"(?i)<a\b[^>]*\bhref="), F.lit(0)))
    paged = rows.select("*", F.inline(F.array(F.struct(F.when(F.col("readable"), decoded).alias("page")))))
    status = F.when(~F.col("readable"), "skipped").when(F.col("page").isNull(), "undecodable").otherwise("converted")
    opened = paged.select("*", html.alias("html"), status.alias("conversion"))
    facts = F.struct(html_text(F.col("html")).alias("text"), title.alias("title"), links.alias("links"))
    read = opened.select(*FIELDS, "head", "status", "charset", "conversion", F.inline(F.array(facts)))
    conversion_id, metadata_id = uuid_of(F.lit("conversion|"), F.col("record_id")), uuid_of(F.lit("metadata|"), F.col("record_id"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit("")), F.lit("\r\n"))
    headers = F.regexp_replace(F.regexp_replace("head", r"^[^\r\n]*(?:\r\n)?", ""), r"(^|\n)([^\r\n])", "$1http-header-$2")
    fields = F.concat(
        line("source-record-id", F.col("record_id")),
        line("source-block-digest", F.col("block_digest")),
        line("source-payload-digest", F.col("payload_digest")),
        line("http-status", F.col("status")),
        F.when(headers == "", "").otherwise(F.concat(headers, F.lit("\r\n"))),
        line("charset", F.col("charset")),
        line("title", F.col("title")),
        line("outlinks", F.col("links")),
        line("conversion-status", F.col("conversion")),
        F.when(F.col("conversion") == "converted", line("conversion-record-id", conversion_id)).otherwise(""),
    )
    made = [
        F.struct(metadata_id.alias("id"), F.lit("metadata").alias("type"), F.lit("application/warc-fields").alias("kind"), fields.cast("binary").alias("made")),
        F.struct(conversion_id.alias("id"), F.lit("conversion").alias("type"), F.lit("text/plain; charset=utf-8").alias("kind"), F.col("text").cast("binary").alias("made")),
    ]
    both = read.select("record_id", "target_uri", "warc_date", F.inline(F.when(F.col("conversion") == "converted", F.array(*made)).otherwise(F.array(made[0]))))
    return both.select(
        F.col("id").alias("record_id"),
        F.col("type").alias("warc_type"),
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "warc_date",
        F.col("kind").alias("content_type"),
        F.col("made").alias("block"),
        digest_of(F.col("made")).alias("block_digest"),
        digest_of(F.col("made")).alias("payload_digest"),
        F.octet_length("made").cast("long").alias("length"),
    )


def serialized(records: DataFrame) -> DataFrame:
    """(record_id, record): each record as the bytes of a WARC 1.1 file; null fields are left out."""
    block = F.coalesce("block", F.lit(b""))
    names = {
        "WARC-Type": "warc_type", "WARC-Target-URI": "target_uri", "WARC-Date": "warc_date", "Content-Type": "content_type",
        "WARC-Block-Digest": "block_digest", "WARC-Payload-Digest": "payload_digest",
    }
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    ids = [line(n, F.concat(F.lit("<"), F.col(c), F.lit(">"))) for n, c in (("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"))]
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    head = F.concat(F.lit("WARC/1.1\r\n"), *ids, *[line(n, F.col(c)) for n, c in names.items()], size)
    return records.select("record_id", F.concat(head.cast("binary"), block, F.lit(b"\r\n\r\n")).alias("record"))


def deserialized(records: DataFrame) -> DataFrame:
    """Rows of FIELDS from (record) bytes, the inverse of ``serialized``."""
    latin = F.decode("record", "ISO-8859-1")
    rows = records.select("record", F.inline(F.array(F.struct(F.instr(latin, "\r\n\r\n").alias("end")))))
    rows = rows.select("record", "end", F.decode(F.expr("substring(record, 1, end + 1)"), "UTF-8").alias("head"))
    field = lambda name: F.when(F.col("head").contains(f"\r\n{name}: "), F.regexp_extract("head", rf"\r\n{name}: ([^\r\n]*)", 1))
    bare = lambda value: F.regexp_replace(value, "^<|>$", "")
    return rows.select(
        bare(field("WARC-Record-ID")).alias("record_id"), field("WARC-Type").alias("warc_type"), bare(field("WARC-Refers-To")).alias("refers_to"),
        field("WARC-Target-URI").alias("target_uri"), field("WARC-Date").alias("warc_date"), field("Content-Type").alias("content_type"),
        F.expr("substring(record, end + 4, octet_length(record) - end - 7)").alias("block"),
        field("WARC-Block-Digest").alias("block_digest"), field("WARC-Payload-Digest").alias("payload_digest"),
    )
