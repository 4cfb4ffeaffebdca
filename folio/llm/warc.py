"""WARC archives and a Merkle audit of their replicas.

Pages are written as WARC response records, in order, some files per range of the order; reading
goes by the records' lengths. A record's leaf is the hash of its bytes, at its offset in the
whole archive as the first replica's index has it: the index leads from a record's id (and, of those
that share one, its number in archive order) to its place, so that a replica whose records were lost,
added or moved still has every other record in its place. Leaves fall into ordered ranges of 2**RANGE bytes of offsets, ranges into wider
ranges of 2**FAN, up to one root; a node is the hash of its children with their places. Two replicas
are compared from the root down: a level compares only the children of nodes that differ, and the
last compares records, so what is compared follows the damage and not the archive.

Defined cases: null texts are empty; a record of any length is one leaf; no rows make an archive
without records, whose replicas agree; rows that repeat a page are records of their own, in a
stable order; other columns are ignored. Of a record that isn't closed where its length says, all
bytes up to the next record's first line are read with it; a file that can't be unpacked any
further ends there. A record that the index doesn't have is extra.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.shared import numbered, small_side, stage

RANGE, FAN = 16, 4
FILE_RECORDS = 50_000  # a reader takes a file as one row, which has to stay below 2 GB
EOL = "\r\n"
SEPARATOR = EOL + EOL          # ends every record (fixed by the format)
VERSION = "WARC/1.1"
RECORDS = "file string, at long, bytes long, header string, body binary"


def record(key: Column, url: Column, body: Column, date: str) -> Column:
    """A response record without its closing separator."""
    text = F.coalesce(body.cast("string"), F.lit(""))
    name = F.md5(F.concat_ws(" ", F.coalesce(key.cast("string"), F.lit("")), F.coalesce(url.cast("string"), F.lit(""))))
    uuid = F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    lines = [F.lit(VERSION), F.lit("WARC-Type: response"), F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), uuid, F.lit(">")),
             F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"[\r\n]", "")), F.lit(f"WARC-Date: {date}"),
             F.concat(F.lit("X-Key: "), F.coalesce(key.cast("string"), F.lit(""))), F.lit("Content-Type: text/html; charset=utf-8"),
             F.concat(F.lit("Content-Length: "), F.octet_length(text).cast("string"))]
    return F.concat(F.concat_ws(EOL, *lines), F.lit(SEPARATOR), text)


def write_warc(pages: DataFrame, path: str, key_col: str = "page_id", url_col: str = "url", body_col: str = "html", date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``pages`` as gzip-compressed WARC files, in order of key, address and body.

    Records end with a blank line, which is what the text writer puts after a row.
    """
    rows = pages.select(F.col(key_col).alias("k"), F.col(url_col).cast("string").alias("u"), F.col(body_col).cast("string").alias("b"))
    order = [F.col("k").asc_nulls_first(), F.col("u").asc_nulls_first()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, F.col("b").asc_nulls_first())
    ordered.select(record(F.col("k"), F.col("u"), F.col("b"), date).alias("value")).write.option("lineSep", SEPARATOR).option(
        "compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def write_records(records: DataFrame, path: str) -> None:
    """Write (header, body) records, as they are, to an archive of their own."""
    whole = F.concat(F.encode(F.concat(F.col("header"), F.lit(EOL)), "UTF-8"), F.col("body"))
    records.select(whole.cast("string").alias("value")).write.option("lineSep", SEPARATOR).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[int, str, bytes]]:
    """(bytes, header, body) of the records of one file; bytes counts the closing separator."""
    line = stream.readline()
    while line:
        header = [line]
        while (line := stream.readline()) not in (b"\r\n", b"") and sum(map(len, header)) < 1 << 20:
            header.append(line)
        head, fields = b"".join(header), {}
        for h in header[1:]:
            name, _, value = h.partition(b":")
            fields[name.strip().lower()] = value.strip()
        length = fields.get(b"content-length", b"")
        body = stream.read(int(length)) if length.isdigit() else b""
        close, odd = stream.read(4), []
        line = b""
        if close == SEPARATOR.encode():
            line = stream.readline()
        else:  # damaged: the next record begins at the next version line
            odd.append(close)
        while odd and (line := stream.readline()) and not line.startswith(VERSION.encode()):
            odd.append(line)
        body += b"".join(odd)
        yield len(head) + 2 + len(body) + 4 * (not odd), head.decode("utf-8", "replace"), body


_RECORD_SCHEMA = pa.schema([("file", pa.string()), ("at", pa.int64()), ("bytes", pa.int64()), ("header", pa.string()), ("body", pa.binary())])


def _until_broken(records: Iterator) -> Iterator:
    while True:
        try:
            yield next(records)
        except (StopIteration, EOFError, OSError, zlib.error):
            return


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(held: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _RECORD_SCHEMA)], schema=_RECORD_SCHEMA)

    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = io.BytesIO(content.as_buffer())
            stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if path.endswith(".gz") else raw
            held, at, begun = [], 0, 0
            for n, header, body in _until_broken(parse_records(stream)):
                held.append((path.rsplit("/", 1)[-1], at, n, header, body))
                at += n
                if at - begun > 4 << 20:
                    yield rows(held)
                    held, begun = [], at
            if held:
                yield rows(held)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, bytes, header, body) of all records, at: the offset in the file. A task reads a file as a stream."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content").mapInArrow(_read_task, RECORDS)


def header_field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?im)^{name}: (.*?)\r?$", 1)


def leaves(records: DataFrame) -> DataFrame:
    """(file, at, id, key, bytes, hash): hash is sha256 of a record's bytes without the closing separator."""
    whole = F.concat(F.encode(F.concat(F.col("header"), F.lit(EOL)), "UTF-8"), F.col("body"))
    return records.select("file", "at", header_field("WARC-Record-ID").alias("id"), header_field("X-Key").alias("key"), "bytes", F.sha2(whole, 256).alias("hash"))


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, id, nth, key, bytes, hash) of an archive: nth numbers the records that share an id."""
    found = stage(leaves(read_warc(spark, path)), "warc-leaves")
    return numbered(found, "id", [F.col("file"), F.col("at")], "warc-catalog").withColumnRenamed("pos", "nth").drop("n")


def index(of_catalog: DataFrame) -> DataFrame:
    """(id, nth, key, offset, bytes, hash), offset: a record's place in the whole archive, files in order of name."""
    sizes = of_catalog.groupBy("file").agg(F.sum("bytes").alias("size"))
    earlier = F.sum("size").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    bases = stage(sizes.select("file", F.coalesce(earlier, F.lit(0)).alias("base")), "warc-files")
    return of_catalog.join(small_side(bases), "file").select("id", "nth", "key", (F.col("base") + F.col("at")).alias("offset"), "bytes", "hash")


def placed(of_catalog: DataFrame, by_index: DataFrame) -> DataFrame:
    """(id, nth, key, offset, hash) of a replica's records, at the places that the index has for them; null for those it doesn't have."""
    places = by_index.select(F.col("id").alias("i_id"), F.col("nth").alias("i_nth"), "offset")
    return of_catalog.join(places, (F.col("id") == F.col("i_id")) & (F.col("nth") == F.col("i_nth")), "left").select("id", "nth", "key", "offset", "hash")


def tree(of_leaves: DataFrame, top: int) -> list[DataFrame]:
    """The levels (replica, range, hash) of each replica's tree over (replica, offset, hash), from ranges of
    2**RANGE bytes up to level ``top``. A node's children are as many as fit its range, and 2**FAN above the first."""
    def node(rows: DataFrame, place: str, shift: int) -> DataFrame:
        children = F.sort_array(F.collect_list(F.struct(F.col(place).alias("place"), F.col("hash").alias("hash"))))
        text = F.array_join(F.transform(children, lambda c: F.concat(c["place"].cast("string"), F.lit(":"), c["hash"])), "\n")
        return rows.groupBy("replica", F.shiftright(place, shift).alias("range")).agg(F.sha2(text, 256).alias("hash"))

    levels = [stage(node(of_leaves, "offset", RANGE), "warc-ranges")]
    for _ in range(top):
        levels.append(stage(node(levels[-1], "range", FAN), "warc-ranges"))
    return levels


def _differing(level: DataFrame) -> DataFrame:
    """Ranges whose nodes aren't equal in both replicas."""
    both = level.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
    return both.where((F.col("n") != 2) | (F.col("lo") != F.col("hi"))).select("range")


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """(offset, status) of the records (offset, hash) that the replicas don't share: 'corrupt' (both have one there,
    of another hash), 'missing' (only the first) or 'extra' (only the second).

    Descends from the roots; each level reads the children of the nodes that differ and no others.
    """
    both = stage(first.select(F.lit(1).alias("replica"), "offset", "hash").union(second.select(F.lit(2).alias("replica"), "offset", "hash")), "warc-leaves")
    end = both.agg(F.max("offset")).first()[0]
    top = 0
    while end is not None and end >> (RANGE + FAN * top):
        top += 1
    levels = tree(both, top)
    wrong = stage(_differing(levels[-1]), "warc-differing")
    for level in reversed(levels[:-1]):
        if wrong.isEmpty():
            break
        parents = small_side(wrong.select(F.col("range").alias("parent")))
        wrong = stage(_differing(level.join(parents, F.shiftright("range", FAN) == F.col("parent"), "left_semi")), "warc-differing")
    ranges = small_side(wrong.select(F.col("range").alias("parent")))
    inside = both.join(ranges, F.shiftright("offset", RANGE) == F.col("parent"), "left_semi")
    a, b = (F.max(F.when(F.col("replica") == r, F.col("hash"))) for r in (1, 2))
    compared = inside.groupBy("offset").agg(a.alias("a"), b.alias("b"))
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(F.col("a") != F.col("b"), "corrupt")
    return compared.select("offset", status.alias("status")).where(F.col("status").isNotNull())


def fixity_report(by_index: DataFrame, replica: DataFrame) -> DataFrame:
    """Every record of the index (key, offset, bytes, hash), with status 'ok' or what the audit found, and
    the records of the replica (placed) that the index doesn't have: without offset and bytes, 'extra'."""
    found = small_side(stage(audit(by_index, replica.where(F.col("offset").isNotNull())), "warc-found")).select(F.col("offset").alias("f_offset"), "status")
    known = by_index.join(found, F.col("offset") == F.col("f_offset"), "left").select("key", "offset", "bytes", "hash", F.coalesce("status", F.lit("ok")).alias("status"))
    extra = replica.where(F.col("offset").isNull()).select("key", "offset", F.lit(None).cast("long").alias("bytes"), "hash", F.lit("extra").alias("status"))
    return known.unionByName(extra)


def damaged(records: DataFrame, rate_key: Column) -> DataFrame:
    """What a drill writes as a replica: records whose key's md5 begins with '00' have their body's first byte
    changed (with an empty body, the date's), those with '01' are lost, the others stay."""
    mark = F.substring(F.md5(F.coalesce(rate_key.cast("string"), F.lit(""))), 1, 2)
    empty = F.octet_length("body") == 0
    body = F.when((mark == "00") & ~empty, F.concat(F.lit(b"\x00"), F.expr("substring(body, 2, octet_length(body))"))).otherwise(F.col("body"))
    header = F.when((mark == "00") & empty, F.regexp_replace("header", "WARC-Date: .", "WARC-Date: 0")).otherwise(F.col("header"))
    return records.where(mark != "01").withColumns({"body": body, "header": header})
