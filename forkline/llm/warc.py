"""WARC archives with revisit resolution, written and read through Spark's own file sources."""

from __future__ import annotations

import base64
import gzip
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, add_columns, flat_map

CRLF = "\r\n"
#: Bytes of one archive file, about; an archive is read back as one value.
FILE_BYTES = 16_000_000
#: Fixed values of the format.
VERSION, REVISIT_PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Written into every record; fixed, so that equal inputs give equal archives.
DATE = "2020-01-01T00:00:00Z"

RECORD = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("declared_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _digests():
    def f(values: list) -> list[list]:
        raw = [(v or "").encode("utf-8", "surrogatepass") for v in values]
        return [[digest_of(x) for x in raw], [len(x) for x in raw]]

    return f


def parse(data: bytes) -> list[dict]:
    """All records of an archive; lengths come from Content-Length, never from what a payload looks like."""
    out, at = [], 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode("utf-8", "surrogatepass").split(CRLF)
        if lines[0] != VERSION:
            raise ValueError(f"no record starts at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        start = head_end + 4
        end = start + int(head["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has no end")
        out.append({"head": head, "payload": data[start:end]})
        at = end + 4
    return out


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one record per page: whole responses, and header-only revisits of payloads that occur before.

    Of the pages whose equal payloads have at least min_bytes bytes, the one with the smallest id is
    the response. Headers alone are shuffled by digest; the smallest id per digest is pre-aggregated, only digests that occur more than once
    join back, and adaptive execution splits the join's side of a payload that a third of the pages share. Rows that repeat the smallest id are all responses; a null id loses against any other; a null
    html is empty. The text sink ends each record with CRLF CRLF, which is the format's own end; files are compressed.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc-heads")
    raw = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    heads = scratch.save(add_columns(raw.select("page_id", "html"), "html", [T.StructField("digest", T.StringType()), T.StructField("bytes", T.LongType())], _digests).drop("html"), "heads")
    firsts = heads.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Stored, so that both sides of the join are dealt for it alone, and the pages of a hot digest can be split.
    firsts = scratch.save(firsts, "firsts")
    each = heads.groupBy("page_id", "digest", "bytes").agg(F.count(F.lit(1)).alias("n")).drop("n")
    each = scratch.save(each, "each")
    revisits = scratch.save(each.join(firsts.hint("merge"), ["digest", "bytes"]).where(~F.col("page_id").eqNullSafe(F.col("first"))), "revisits")
    total = heads.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    rows = add_columns(raw, "html", [T.StructField("digest", T.StringType()), T.StructField("bytes", T.LongType())], _digests)
    # Both sides are dealt by the same keys, so the texts are shuffled once and a partition is a file.
    files, keys = max(1, -(-total // FILE_BYTES)), ["k0", "k1", "k2"]
    keyed = lambda df: df.withColumns({"k0": F.coalesce("page_id", F.lit(-(2**63))), "k1": F.col("digest"), "k2": F.col("bytes")})
    found = keyed(revisits).select(*keys, "first").repartition(files, *keys)
    rows = keyed(rows).repartition(files, *keys).join(found, keys, "left")
    rows.select(record_text().alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def record_text():
    """A record without its end; null columns leave their header line out."""
    first = F.col("first").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    uri = lambda c: F.concat(F.lit("<urn:page:"), c, F.lit(">"))
    one_line = F.regexp_replace("url", "[\\x00-\\x1F]", " ")
    page = F.col("page_id").cast("string")
    return F.concat(
        F.lit(VERSION + CRLF),
        line("WARC-Type", F.when(first, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", uri(F.coalesce(page, F.concat(F.lit("none-"), F.col("digest"))))),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", one_line), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(first, F.concat(line("WARC-Refers-To", uri(F.col("first").cast("string"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        F.coalesce(line("X-Page-ID", page), F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(first, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(CRLF),
        F.when(first, F.lit("")).otherwise(F.col("html")),
    )


def _reader(payloads: bool):
    def make():
        def f(batch):
            out: dict[str, list] = {x: [] for x in RECORD.names}
            for data in batch.column(0):
                for r in parse(gzip.decompress(data.as_py())):
                    head, body = r["head"], r["payload"]
                    refers, page = head.get("WARC-Refers-To"), head.get("X-Page-ID")
                    revisit = head["WARC-Type"] == "revisit"
                    for name, value in (
                        ("record_id", head["WARC-Record-ID"]),
                        ("page_id", page and int(page)),
                        ("url", head.get("WARC-Target-URI")),
                        ("record_type", head["WARC-Type"]),
                        ("declared_digest", head["WARC-Payload-Digest"].removeprefix("sha1:")),
                        ("refers_to", int(refers.removeprefix("<urn:page:").rstrip(">")) if refers else None),
                        ("payload_digest", None if revisit else digest_of(body)),
                        ("payload_bytes", None if revisit else len(body)),
                        ("payload", body if payloads and not revisit else None),
                    ):
                        out[name].append(value)
            return out

        return f

    return make


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record, with digest and length computed from the stored payload; null where a revisit has none."""
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select("content")
    return flat_map(files, RECORD, _reader(payloads))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Join revisits to the original responses they name and take payload columns from there.

    Only responses that some revisit names take part, one row per named page and digest; a payload that many
    records revisit is one row on that side, and the skewed side is one that the adaptive join splits.
    """
    revisit = F.col("record_type") == "revisit"
    named = records.where(revisit).select(F.col("refers_to").alias("r"), F.col("declared_digest").alias("d")).distinct()
    have = records.where(~revisit).select(F.col("page_id").alias("r"), F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("original_bytes"), F.col("payload_digest").alias("original_digest"))
    originals = have.join(named, ["r", "d"], "left_semi").dropDuplicates(["r", "d"])
    out = records.join(originals, (F.col("refers_to") == F.col("r")) & (F.col("declared_digest") == F.col("d")), "left").drop("r", "d")
    return out.withColumns({"payload_bytes": F.coalesce("payload_bytes", "original_bytes"), "payload_digest": F.coalesce("payload_digest", "original_digest")}).drop("original_bytes", "original_digest")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as deduplicated archives, read these back, and resolve the revisits."""
    scratch = Scratch(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch.path("archives"))
    records = scratch.save(read_archives(spark, scratch.path("archives"), payloads=False).drop("payload"), "records")
    return resolve_revisits(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
