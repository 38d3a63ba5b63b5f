"""Operator 10: WARC archives and their Merkle fixity audit.

``write_archive`` writes pages as WARC/1.1 resource records, each a gzip member
of its own, by Spark's text writer: a row a file, closed by ``FILE_BYTES`` or
``RECORDS_PER_FILE`` (a member ends with the zero byte that tops its length,
which is the writer's line separator, so the files are gzip files though their
names end in .txt). ``scan`` reads an
archive's files back, parses the records by their Content-Length and hashes each
record and each ordered offset range of ``RANGE_BYTES`` uncompressed bytes.

A member that cannot be read whole keeps what came before the error and, by the
length its trailer names, its room, so the records behind it keep their
offsets; its hashes are marked, so it never counts as intact, even when only its
check sum disagrees. Damage that runs over the border of two members hides the
length of the first; the records behind it in the file may then be reported at
other offsets.

The audit hashes the ordered ranges of all files into a tree with
``2**FAN_BITS`` children a node. Two replicas are compared from the root down:
only children of nodes that differ are looked at, until the ranges that differ
are known. Records that touch none of them are intact; the others are compared
by their own hashes. A record whose place in the replica holds other bytes is
'damaged', one whose place holds no record is 'missing'; one that the replica
holds where the primary holds no record is 'lost'.

Defined results: a null page is an empty payload, a null url a record without
target, a null id stays null; repeated rows are records of their own; an empty
table makes an archive without records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.common import Scratch

#: A file is closed after so many records or stored bytes; a record is never split over files.
RECORDS_PER_FILE, FILE_BYTES = 2000, 32 << 20
RANGE_BYTES = 1 << 16
#: Bits of a node's number that its children add; of a range within its file; of a file within its part.
#: A place beyond them is an error.
FAN_BITS, RANGE_BITS, FILE_BITS = 8, 16, 20
PLACE_BITS = 62
END = "\r\n\r\n"
#: Bytes of a member at most: the top byte of its length is zero then. A longer record goes on in others.
MEMBER_BYTES = (1 << 24) - 1
#: Headers of the writer's members; the lowest flag bit ("text") marks one that goes on with a record.
MEMBER = re.compile(rb"\x1f\x8b\x08[\0\x01]\0\0\0\0\0\xff")
SCAN_SCHEMA = ("kind string, place long, at long, length long, digest binary, page_id long, "
               "n_bytes long, payload_sha256 string")


#: Date of records whose table has none.
NO_DATE = "1970-01-01T00:00:00Z"


def record(page_id: Column, url: Column, html: Column, number: Column, date: Column) -> Column:
    """A WARC record without the line ends that close it. ``number`` makes its id
    unique where page ids are null or repeated."""
    payload = F.coalesce(html, F.lit(""))
    target = F.regexp_replace(url, r"[\x00-\x20\x7f]", "%20")
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")),
        F.lit(":"), number.cast("string"), F.lit(">\r\nWARC-Date: "), date, F.lit("\r\n"), F.coalesce(F.concat(F.lit("WARC-Target-URI: "), target, F.lit("\r\n")), F.lit("")),
        F.lit("Content-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit(END), payload)


def pack(data: bytes) -> bytes:
    """A record as a gzip member, or several, without the zero byte that ends it."""
    out = []
    for at in range(0, len(data), MEMBER_BYTES):
        part, one = data[at:at + MEMBER_BYTES], zlib.compressobj(wbits=-15)
        out += [b"\x1f\x8b\x08", b"\x01" if at else b"\0", b"\0\0\0\0\0\xff", one.compress(part), one.flush(),
                struct.pack("<II", zlib.crc32(part), len(part))]
    return b"".join(out)[:-1]


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  date: Column | None = None) -> None:
    """Writes pages to WARC files in the order of their rows, without a shuffle:
    replicas of one table, read in the same splits, have the same records at the
    same places. ``date`` gives each record's WARC-Date (text)."""
    date = F.coalesce(date, F.lit(NO_DATE)) if date is not None else F.lit(NO_DATE)
    one = record(F.col(id_col).cast("long"), F.col(url_col), F.col(html_col), F.monotonically_increasing_id(), date)
    rows = pages.select(F.concat(one, F.lit(END)).cast("binary").alias("value"))

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for value in batch.column(0):
                held.append(pack(value.as_py()))
                size += len(held[-1]) + 1
                if size >= FILE_BYTES or len(held) >= RECORDS_PER_FILE:
                    yield pa.RecordBatch.from_arrays([pa.array([b"\0".join(held)], pa.binary())], ["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"\0".join(held)], pa.binary())], ["value"])

    (rows.mapInArrow(files, "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\0")
     .option("maxRecordsPerFile", 1).text(folder))


def parse(data: bytes, starts: list[int] = ()):
    """(offset, length, page id, payload) of the records of an uncompressed
    file. Where no record starts, or one runs over the start of another, it goes
    on at the next of ``starts`` (ordered offsets); it stops where there is none."""
    at, starts = 0, [s for s in starts if data.startswith(b"WARC/", s)]
    while True:
        k = bisect_right(starts, at)
        limit = starts[k] if k < len(starts) else len(data)
        head = data.find(END.encode(), at, limit) if data.startswith(b"WARC/", at) else -1
        size = re.search(rb"\r\nContent-Length: (\d{1,18})(?:\r\n|$)", data[at:head]) if head >= 0 else None
        end = limit
        if size:
            start, page = head + len(END), re.search(rb"<urn:page:(-?\d{1,19})(?::\d+)?>", data[at:head])
            end = min(start + int(size[1]) + len(END), limit)
            number = int(page[1]) if page else None
            yield (at, end - at, number if page and -1 << 63 <= number < 1 << 63 else None,
                   data[start:min(start + int(size[1]), end)])
        if end >= len(data) or not size and k == len(starts):
            return
        at = end


def place_of(path: str) -> int:
    """A file's place in the tree: its part and its number within the part."""
    part, number = map(int, re.search(r"part-(\d+)-.*-c(\d+)\.", path).groups())
    if number >> FILE_BITS or part >> PLACE_BITS - FILE_BITS - RANGE_BITS:
        raise ValueError(f"no place for file {number} of part {part}")
    return (part << FILE_BITS | number) << RANGE_BITS


def range_of(place: int, n: int) -> int:
    """The place of a file's n-th range."""
    if n >> RANGE_BITS:
        raise ValueError(f"a file with more than {1 << RANGE_BITS} ranges of {RANGE_BYTES} bytes")
    return place | n


def mend(data: bytes, last: bool) -> bytes:
    """What a damaged member held before the damage, at the length its trailer
    names; the last of a file may have been cut off before its trailer."""
    out, one = bytearray(), zlib.decompressobj(31)
    try:
        for k in range(len(data)):
            out += one.decompress(data[k:k + 1])
    except zlib.error:
        pass
    crc, size = struct.unpack("<II", data[-8:].rjust(8, b"\0"))
    if last or zlib.crc32(out) == crc or size > MEMBER_BYTES:
        return bytes(out)
    return bytes(out[:size].ljust(size, b"\0"))


def unzip(data: bytes) -> tuple[bytes, list[int], list[int]]:
    """What can be read of a gzip file, whole or not, and the offsets of its
    members that start a record and of the writer's that are damaged."""
    out, starts, broken, size = [], [], [], 0
    found = [m.start() for m in MEMBER.finditer(data)]
    cuts = sorted({0, *found})
    for lo, hi in zip(cuts, [*cuts[1:], len(data)]):
        part = data[lo:hi]
        while part:
            one, got = zlib.decompressobj(31), b""
            try:
                got = one.decompress(part)
            except zlib.error:
                pass
            if not one.eof:
                got = mend(part, hi == len(data))
                broken += [size] if found else []
            if not (MEMBER.match(part) and part[3]):
                starts.append(size)
            out.append(got)
            size += len(got)
            part = one.unused_data if one.eof else b""
    return b"".join(out), starts, broken


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record (kind 'record': place of its file, at: offset,
    length, digest, page_id, n_bytes and payload_sha256 of its payload) and for
    each offset range (kind 'range': place, at, length, digest)."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                place, (data, starts, broken) = place_of(batch.column(0)[k].as_py()), unzip(batch.column(1)[k].as_py())

                def digest(at, length):
                    marks = [b - at for b in broken if at <= b < at + length]
                    return hashlib.sha256(data[at:at + length] + (f"broken at {marks}".encode() if marks else b"")).digest()

                rows = [("record", place, at, length, digest(at, length), page, len(payload), hashlib.sha256(payload).hexdigest())
                        for at, length, page, payload in parse(data, starts)]
                for n, at in enumerate(range(0, len(data), RANGE_BYTES)):
                    length = min(RANGE_BYTES, len(data) - at)
                    rows.append(("range", range_of(place, n), at, length, digest(at, length), None, None, None))
                types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
                columns = list(zip(*rows)) or [[]] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                                 [f.split()[0] for f in SCAN_SCHEMA.split(", ")])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(run, SCAN_SCHEMA)


def tree(ranges: DataFrame, scratch: Scratch, levels: int) -> list[DataFrame]:
    """The levels of a replica's tree from the leaves up: node, digest. A node
    hashes its children's numbers and digests in order."""
    out = [ranges.select(F.col("place").alias("node"), "digest")]
    for k in range(levels):
        child = F.struct(F.col("node"), F.col("digest"))
        up = (out[-1].groupBy(F.shiftright("node", FAN_BITS).alias("parent")).agg(F.sort_array(F.collect_list(child)).alias("c"))
              .select(F.col("parent").alias("node"), F.unhex(F.sha2(F.concat_ws("|", F.transform(
                  "c", lambda x: F.concat(x["node"].cast("string"), F.lit(":"), F.hex(x["digest"])))), 256)).alias("digest")))
        out.append(scratch.write(up, f"warc-level-{k + 1}"))
    return out


def differing(a: list[DataFrame], b: list[DataFrame], scratch: Scratch) -> DataFrame:
    """Leaves (node) that differ between two trees, found by descending from
    the roots into differing nodes only."""
    suspects = None
    for one, two in zip(reversed(a), reversed(b)):
        x = one.select(F.col("node").alias("n1"), F.col("digest").alias("d1"))
        y = two.select(F.col("node").alias("n2"), F.col("digest").alias("d2"))
        if suspects is not None:
            x = x.join(suspects, F.shiftright("n1", FAN_BITS) == F.col("node"), "left_semi")
            y = y.join(suspects, F.shiftright("n2", FAN_BITS) == F.col("node"), "left_semi")
        both = x.join(y, F.col("n1") == F.col("n2"), "full").where(~F.col("d1").eqNullSafe(F.col("d2")))
        suspects = scratch.write(both.select(F.coalesce("n1", "n2").alias("node")), "warc-differing")
    return suspects


def touching(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """The records that touch one of the ranges (node)."""
    first, last = F.floor(F.col("at") / RANGE_BYTES), F.floor((F.col("at") + F.col("length") - 1) / RANGE_BYTES)
    touched = records.withColumn("range", F.explode(F.sequence(first, last)))
    return (touched.join(ranges, F.col("place").bitwiseOR(F.col("range")) == F.col("node"), "left_semi")
            .drop("range").dropDuplicates(["place", "at"]))


def audit(spark: SparkSession, primary: str, replica: str) -> DataFrame:
    """A row for each record that either archive holds: page_id, place (of its
    file), at, length, n_bytes and payload_sha256 (of the primary's record, or
    the replica's where that is 'lost'), and status: 'intact', 'damaged' or
    'missing' in the replica, 'lost' in the primary."""
    scratch = Scratch(spark)
    one, two = (scratch.write(scan(spark, f), f"warc-scan-{k}") for k, f in enumerate((primary, replica)))
    top = one.unionAll(two).agg(F.max("place")).first()[0] or 0
    levels = max(1, -(-top.bit_length() // FAN_BITS))
    trees = [tree(t.where("kind = 'range'"), scratch, levels) for t in (one, two)]
    bad = differing(*trees, scratch)
    records, copies = one.where("kind = 'record'"), two.where("kind = 'record'")
    # Records of either side that touch a differing range, and what the other holds in their places.
    suspects = touching(records, bad).select("place", "at", "digest")
    held = copies.select(F.col("place").alias("p"), F.col("at").alias("o"), F.col("digest").alias("d"))
    status = F.when(F.col("d").isNull(), "missing").when(F.col("d") != F.col("digest"), "damaged").otherwise("intact")
    judged = (suspects.join(held, (F.col("place") == F.col("p")) & (F.col("at") == F.col("o")), "left")
              .select(F.col("place").alias("p"), F.col("at").alias("o"), status.alias("status")))
    lost = touching(copies, bad).join(records.select("place", "at"), ["place", "at"], "left_anti")
    names = ["page_id", "place", "at", "length", "n_bytes", "payload_sha256"]
    return (records.join(judged, (F.col("place") == F.col("p")) & (F.col("at") == F.col("o")), "left")
            .select(*names, F.coalesce("status", F.lit("intact")).alias("status"))
            .unionByName(lost.select(*names, F.lit("lost").alias("status"))))
