"""WARC archives, written and read as plain files of the shared store.

Writing: one record per row. Of rows with equal payloads of at least ``REVISIT_BYTES``
bytes the one with the largest id becomes the response; the others are revisit
records that refer to it and carry no payload.

Reading by boundary-chain verification: files are split anywhere. Each piece
between two magics may be a record; its header gives the offset where its
successor must begin. Pointer jumping from offset 0 of each file, doubling the
step each round, keeps the candidates that are reachable from the file's start, so a magic
inside a payload never counts as a record. Rounds grow with the logarithm of the
records in a file.

Edge cases: null payload is an empty one; null url is written as an empty header;
line breaks in a url are escaped. A null id loses against any other id and is written as
an empty one. Rows that repeat the largest id of their payload are all responses.
A file that breaks off gives its records up to the break. Empty tables give empty archives and no rows. Only
id, url and payload are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.joins import sized
from ..session import new_folder
from .common import query, stored, table

REVISIT_BYTES = 1000
RECORDS_PER_FILE = 4096
#: Fixed parts of the format.
MAGIC, BREAK = "WARC/1.", "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """One record per row as column ``record``, without the closing blank line."""
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn(
        "size", F.octet_length("payload"))
    # narrow and combined map-side; a row per payload that several pages share
    same = rows.filter(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size").agg(
        F.max("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # broadcast only if it was written and found small, so that payloads need not move
    rows = rows.join(sized(same), ["digest", "size"], "left")
    revisit = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("first")))
    http = F.format_string("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n",
                           F.col("size"))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    url = F.regexp_replace("url", r"[\x00-\x20]", "%20")
    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.url_encode(F.coalesce(c.cast("string"), F.lit(""))), F.lit(">"))
    lines = F.concat_ws(
        BREAK, F.lit(MAGIC + "1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("id"))), F.lit("WARC-Date: " + date),
        F.concat(F.lit("WARC-Target-URI: "), url), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("first")))),
        F.when(revisit, F.lit("WARC-Profile: " + PROFILE)),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")))
    return rows.select(F.concat(lines, F.lit(BREAK * 2), http, F.when(revisit, "").otherwise(
        F.col("payload"))).alias("record"))


def write(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE, **names) -> None:
    """Write archives below ``path``; the blank line that ends a record is the writer's line separator."""
    records(pages, **names).write.option("lineSep", BREAK * 2).option("maxRecordsPerFile", records_per_file).text(path)


def _field(header, name: str):
    return F.regexp_extract(header, rf"(?i)\r\n{name}: *([^\r\n]*)", 1)


def _split(spark: SparkSession, path: str) -> DataFrame:
    """Pieces between magics with file, block (where the split began) and their order in it."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seen"), F.col("value").alias("raw"))


def _block(length):
    """The bytes of a record after its header."""
    start = F.octet_length(F.substring_index("raw", BREAK * 2, 1)) + 5
    return F.col("raw").cast("binary").substr(start, length.cast("int"))


def _payload():
    """The bytes of column ``body`` after the HTTP header in column ``http``."""
    return F.col("body").substr(F.octet_length("http") + 5, F.octet_length("body"))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every piece of every file: file, block, nth in it, offset of its magic, offset of its successor, header fields."""
    header = F.substring_index("raw", BREAK * 2, 1)
    size = _field(header, "Content-Length")
    is_header = header.rlike(r"^[01]\r\n") & size.rlike(r"^\d{1,18}$")
    before = F.octet_length(header) + 4
    length = size.try_cast("long")
    # a record in one piece is hashed here, while its bytes are at hand
    alone = is_header & (F.octet_length("raw") >= before + length)
    found = _split(spark, path).select(
        "file", "block", "seen", F.octet_length("raw").cast("long").alias("size"),
        F.when(is_header, length).alias("length"), before.alias("before"),
        F.when(is_header, header).alias("header"), alone.alias("alone"), F.when(alone, _block(length)).alias("body"))
    found = found.withColumn("http", F.substring_index(F.col("body").cast("string"), BREAK * 2, 1))
    payload = _payload()
    found = found.select(
        "file", "block", "seen", "size", "length", "before", "alone",
        _field(F.col("header"), "WARC-Type").alias("type"), _field(F.col("header"), "WARC-Record-ID").alias("record"),
        _field(F.col("header"), "WARC-Refers-To").alias("refers"),
        _field(F.col("header"), "WARC-Payload-Digest").alias("stated"),
        _field(F.concat(F.lit(BREAK), F.col("http")), "Content-Length").try_cast("long").alias("http_length"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("digest"))
    found = stored(found, "warc_pieces")
    step = F.col("size") + len(MAGIC)
    order = Window.partitionBy("file", "block").orderBy("seen")  # one split of a file
    inside = found.withColumn("at", F.sum(step).over(order) - step).withColumn("nth", F.row_number().over(order))
    blocks = found.groupBy("file", "block").agg(F.sum(step).alias("bytes"))
    whole = Window.partitionBy("file")
    blocks = blocks.select(
        "file", "block", (F.sum("bytes").over(whole.orderBy("block")) - F.col("bytes")).alias("from"),
        (F.sum("bytes").over(whole) - len(MAGIC)).alias("end"))
    offset = F.col("from") + F.col("at") - len(MAGIC)
    return stored(inside.join(blocks, ["file", "block"]).withColumn("offset", offset).withColumn(
        "next", F.col("offset") + len(MAGIC) + F.col("before") + F.col("length") + 2 * len(BREAK)).drop(
        "at", "from", "seen", "before"), "warc_candidates")


def reachable(found: DataFrame) -> DataFrame:
    """(file, offset) of candidates that a chain of successors joins to the start of their file."""
    nodes = stored(found.filter("length IS NOT NULL AND offset >= 0 AND next <= end").select(
        "file", "offset", "next", (F.col("offset") == 0).alias("on")), "warc_chain")
    reached = -1
    while True:
        now = nodes.filter("on").count()
        if now == reached:
            return nodes.filter("on").select("file", "offset")
        reached = now
        jump = nodes.select("file", F.col("offset").alias("next"), F.col("next").alias("far"))
        hit = nodes.filter("on").select("file", F.col("next").alias("offset")).distinct().withColumn("hit", F.lit(True))
        nodes = stored(nodes.join(jump, ["file", "next"], "left").join(hit, ["file", "offset"], "left").select(
            "file", "offset", F.col("far").alias("next"), (F.col("on") | F.col("hit").isNotNull()).alias("on")),
            "warc_chain")


def _joined_payloads(spark: SparkSession, path: str, pieces: DataFrame) -> DataFrame:
    """(file, record offset, digest, payload_bytes, http_length) of records that contain a magic."""
    order = Window.partitionBy("file", "block").orderBy("seen")
    files = pieces.select("file").distinct()
    raw = _split(spark, path).join(files, "file", "left_semi").withColumn("nth", F.row_number().over(order))
    parts = raw.join(pieces, ["file", "block", "nth"]).groupBy("file", "record_at").agg(
        F.sort_array(F.collect_list(F.struct("offset", "raw"))).alias("parts"), F.max("length").alias("length"))
    text = F.array_join(F.col("parts.raw"), MAGIC)  # one record: its own size bounds it
    whole = parts.select("file", "record_at", "length", text.alias("raw"))
    whole = whole.select("file", "record_at", _block(F.col("length")).alias("body")).withColumn(
        "http", F.substring_index(F.col("body").cast("string"), BREAK * 2, 1))
    payload = _payload()
    return whole.select("file", F.col("record_at").alias("offset"), F.sha1(payload).alias("digest2"),
                        F.octet_length(payload).cast("long").alias("payload_bytes2"),
                        _field(F.concat(F.lit(BREAK), F.col("http")), "Content-Length").try_cast("long").alias("http_length2"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: file, offset, record id, type, refers, payload_bytes, payload_digest, intact.

    Of a revisit the length is the one its HTTP header states and the digest its
    record states; of a response both are taken from the payload, and ``intact``
    says whether the stated digest agrees.
    """
    found = candidates(spark, path)
    good = reachable(found)
    kept = found.join(good, ["file", "offset"], "left_semi")
    spans = kept.filter("NOT alone").select("file", F.col("offset").alias("record_at"), "next", "length")
    if spans.isEmpty():
        for c in ("digest2", "payload_bytes2", "http_length2"):
            kept = kept.withColumn(c, F.lit(None).cast("string" if c == "digest2" else "long"))
    else:
        files = spans.select("file").distinct()
        on = F.last(F.when(F.col("good"), F.col("offset")), ignorenulls=True).over(
            Window.partitionBy("file").orderBy("offset"))
        owner = found.join(files, "file", "left_semi").join(
            good.withColumn("good", F.lit(True)), ["file", "offset"], "left").withColumn("record_at", on)
        pieces = stored(owner.select("file", "block", "nth", "offset", "record_at").join(
            spans.drop("next"), ["file", "record_at"]), "warc_spans")
        kept = kept.join(_joined_payloads(spark, path, pieces), ["file", "offset"], "left")
    revisit = F.col("type") == "revisit"
    digest = F.when(F.col("alone"), F.col("digest")).otherwise(F.col("digest2"))
    stated = F.regexp_replace("stated", "^sha1:", "")
    def of(c):
        return F.url_decode(F.regexp_extract(c, "^<urn:page:(.*)>$", 1))
    return kept.select(
        "file", "offset", of("record").alias("record"), "type", F.when(revisit, of("refers")).alias("refers"),
        F.when(revisit, F.coalesce("http_length", "http_length2")).when(F.col("alone"), F.col("payload_bytes"))
        .otherwise(F.col("payload_bytes2")).alias("payload_bytes"),
        F.when(revisit, stated).otherwise(digest).alias("payload_digest"),
        (revisit | (stated == digest)).alias("intact"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
d AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < first THEN first END AS refers_to
FROM d
"""


@query("op2_warc", SQL)
def op2(spark, sf_dir):
    path = new_folder(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    return read(spark, path).select(
        F.expr("try_cast(record AS BIGINT)").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.expr("try_cast(refers AS BIGINT)").alias("refers_to"))
