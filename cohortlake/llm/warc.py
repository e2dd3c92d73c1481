"""WARC archives of pages: writing with revisit records, and reading with segment reassembly.

Writing: a page whose payload is equal to that of others is a revisit of the one
with the largest page_id; payloads are compared by SHA-1 and length. Record ids
hold the row's number in a written table, so that equal rows have their own, and
revisits refer to one row of the page_id. A response
block larger than the segment size goes on in continuation records that name the
origin record and their number; the last carries the total length. Segments
stand in files of their own, which are the only ones that reassembly reads. Payloads are
framed by chunked transfer coding. Each record is a gzip member of its own.

Reading: files may be plain, one gzip member, or a member for each record, and names of
header fields in any case. Records are parsed where the file is. Whole records are decoded at
once; segments are grouped by the origin's identifier, ordered by number,
checked for gaps, for numbers that stand for different segments and for the total length, joined, and then decoded. A group is
one record, so its size is a page's, whatever the table holds. Revisits are
joined to the responses that they name.

Defined results: a null or empty html is a payload of no bytes; a null url is an
empty target. Rows that repeat the largest page_id of a payload are all
responses; rows with a null page_id are revisits if their payload has a page_id
elsewhere, else responses. Other columns are ignored. An empty table writes no
file and reads as no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_chunks, materialize, new_path, open_file, small_batches, strings, write_file

SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
FILE_BYTES = 16 << 20
LEVEL = 3
STEP_BYTES = 4 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "record_id string, record_type string, page_id long, url string, refers_to_record string, payload_digest string, origin_id string, segment int, total_length long, content binary, size long, found string"


def digest_of(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, digest: str, row: int = 0) -> str:
    """Of the page in this row of the written table, as rows can be equal in page_id and payload."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{row}')}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(x), x) for x in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        at = end + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise ValueError("a chunk is not ended where its size says")
        parts.append(body[end + 2 : at])
        at += 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response, with chunked transfer coding undone."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:[^\r\n]*chunked", head) else body


def _record(fields: dict[str, object], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    head = f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode()
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return press.compress(head + block + b"\r\n\r\n") + press.flush()


def page_records(page_id, url: str | None, payload: bytes, refers_to, segment_bytes: int = SEGMENT_BYTES, row: int = 0, refers_row: int = 0) -> list[bytes]:
    """The gzip members of a page: a revisit, or a response with its continuations."""
    digest = digest_of(payload)
    own = record_id(page_id, digest, row)
    common = {"WARC-Record-ID": own, "WARC-Date": "1970-01-01T00:00:00Z", "WARC-Target-URI": re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or ""), "WARC-Payload-Digest": f"sha1:{digest}", "X-Page-Id": page_id}
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if refers_to is not None:
        return [_record({"WARC-Type": "revisit", **common, "WARC-Refers-To": record_id(refers_to, digest, refers_row), "WARC-Profile": PROFILE, "Content-Type": "application/http; msgtype=response"}, head)]
    block = head + chunked(payload)
    pieces = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = {"WARC-Type": "response", **common, "Content-Type": "application/http; msgtype=response"}
    if len(pieces) == 1:
        return [_record(first, block)]
    out = [_record({**first, "WARC-Segment-Number": 1}, pieces[0])]
    for number, piece in enumerate(pieces[1:], 2):
        total = len(block) if number == len(pieces) else None
        out.append(_record({"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own}:{number}')}>", "WARC-Date": common["WARC-Date"], "WARC-Segment-Origin-ID": own, "WARC-Segment-Number": number, "WARC-Segment-Total-Length": total}, piece))
    return out


def plan_revisits(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """row, refers_to, refers_row of the rows (row, page_id, html) that revisit another."""

    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    digests = rows.select("row", "page_id", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size"))
    digests = materialize(digests.where(f"size >= {least_bytes}"), "warc-digests")
    held = F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", F.col("row").alias("held_row"))))
    holders = digests.groupBy("digest", "size").agg(held.alias("held"), F.count("*").alias("n")).where("n > 1 AND held IS NOT NULL")
    holders = holders.select("digest", "size", F.col("held.page_id").alias("refers_to"), F.col("held.held_row").alias("refers_row"))
    return materialize(digests.join(holders, ["digest", "size"]).where("NOT page_id <=> refers_to").select("row", "refers_to", "refers_row"), "warc-revisits")


def write_warc(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write the pages to .warc.gz files of the shared folder; path, records and bytes of each, and whether it holds segments (and nothing else)."""
    spark = pages.sparkSession
    small_batches(spark)
    folder = folder or new_path(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    # Written with their numbers, so that every use and every rerun of a task sees the same ones.
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "warc-pages")
    joined = rows.join(plan_revisits(rows, least_bytes), "row", "left")
    joined = joined.select(F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page_id"), "url", "html", "row", F.coalesce("refers_row", F.lit(-1)).alias("refers_row"), F.coalesce(F.col("refers_to").cast("string"), F.lit("")).alias("refers_to"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, made = TaskContext.get().partitionId(), []
        number, parts, size = [0, 0], [[], []], [0, 0]  # of the files of whole records, and of those of segments

        def close(kind: int):
            path = f"{folder}/part-{part:06d}-{number[kind]:06d}{'-segments' * kind}.warc.gz"
            made.append((path, len(parts[kind]), write_file(path, parts[kind]), bool(kind)))
            number[kind], parts[kind], size[kind] = number[kind] + 1, [], 0

        for batch in in_chunks(batches, "html"):
            for page_id, url, html, row, refers_row, refers_to in batch.itertuples(index=False):
                payload = (html or "").encode("utf-8", "surrogatepass")
                new = page_records(page_id or None, url, payload, int(refers_to) if refers_to else None, segment_bytes, row, refers_row)
                kind = int(len(new) > 1)
                parts[kind] += new
                size[kind] += sum(map(len, new))
                if size[kind] >= FILE_BYTES:
                    close(kind)
        for kind in (0, 1):
            if parts[kind]:
                close(kind)
        yield pd.DataFrame(made, columns=["path", "records", "bytes", "segmented"])

    return materialize(joined.mapInPandas(run, "path string, records long, bytes long, segmented boolean"), "warc-index")


class Fields(dict):
    """Header fields of a record; their names are told apart without regard to case, as the format has it."""

    def __init__(self, lines: list[str]):
        super().__init__()
        last = None
        for line in lines:
            if line[:1] in (" ", "\t") and last:  # a folded line goes on
                self[last] += " " + line.strip()
                continue
            name, _, value = line.partition(":")
            last = name.strip().lower()
            super().__setitem__(last, value.removeprefix(" "))

    def __getitem__(self, name: str) -> str:
        return super().__getitem__(name.lower())

    def __setitem__(self, name: str, value: str) -> None:
        super().__setitem__(name.lower(), value)

    def get(self, name: str, default=None):
        return super().get(name.lower(), default)

    def __contains__(self, name: str) -> bool:
        return super().__contains__(name.lower())


def _members(data: bytes) -> Iterator[bytes]:
    """What each gzip member of a file holds, or a file that is not compressed as it is."""
    if data.startswith(b"WARC/"):
        yield data
        return
    view, at = memoryview(data), 0
    while at < len(view):
        # In small steps, as what follows a member is copied out of the step that ends it.
        press, parts = zlib.decompressobj(31), []
        while not press.eof:
            if at >= len(view):
                raise ValueError("a record is cut off")
            step = view[at : at + STEP_BYTES]
            parts.append(press.decompress(step))
            at += len(step) - len(press.unused_data)
        yield b"".join(parts)


def parse_file(data: bytes) -> Iterator[tuple[Fields, bytes]]:
    """Header fields and block of each record of a file: plain, in one gzip member, or in a member for each record."""
    for member in _members(data):
        at = 0
        while at < len(member):
            end = member.find(b"\r\n\r\n", at)
            if end < 0 or not member.startswith(b"WARC/", at):
                raise ValueError("not a WARC record")
            fields = Fields(member[at:end].decode("utf-8", "replace").split("\r\n")[1:])
            begin = end + 4
            stop = begin + int(fields["Content-Length"])
            if member[stop : stop + 4] != b"\r\n\r\n":
                raise ValueError("a record is not as long as it says")
            yield fields, member[begin:stop]
            at = stop + 4


def read_records(files: DataFrame, segmented: bool, keep: bool = True) -> DataFrame:
    """The records of the files that are segments of one, with their blocks, or those that are not, decoded; without `keep` payloads stay where they are read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                rows, size = [], 0
                with open_file(path) as source:
                    data = source.read()
                for f, block in parse_file(data):
                    number = f.get("WARC-Segment-Number")
                    if (number is not None) != segmented:
                        continue
                    page_id, kind = f.get("X-Page-Id"), f["WARC-Type"]
                    content = block if segmented else None if kind == "revisit" else payload_of(block)
                    measured = (None, None) if segmented or content is None else (len(content), digest_of(content))
                    rows.append((
                        f["WARC-Record-ID"], kind, int(page_id) if page_id else None, f.get("WARC-Target-URI"), f.get("WARC-Refers-To"), f.get("WARC-Payload-Digest", "").removeprefix("sha1:"),
                        f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"]), int(number or 0), int(f["WARC-Segment-Total-Length"]) if "WARC-Segment-Total-Length" in f else None,
                        content if keep or segmented else None, *measured,
                    ))
                    size += len(block) + 200
                    if size > 4_000_000:
                        yield _typed(rows)
                        rows, size = [], 0
                if rows:
                    yield _typed(rows)

    if "segmented" in files.columns:
        files = files.where("segmented" if segmented else "NOT segmented")
    # By range, as a hash of the names would deal several files to some tasks and none to others.
    return files.select("path").repartitionByRange(max(1, files.count()), "path").mapInPandas(run, _RECORD)


def _typed(rows: list[tuple]) -> pd.DataFrame:
    names = [x.split(" ")[0] for x in _RECORD.split(", ")]
    frame = pd.DataFrame({name: strings(column) for name, column in zip(names, zip(*rows, strict=True), strict=True)})
    for name in ("page_id", "total_length", "size"):
        frame[name] = pd.array(frame[name].tolist(), dtype="Int64")
    frame["segment"] = frame["segment"].astype("int32")
    return frame


def reassemble(segments: DataFrame, keep: bool = True) -> DataFrame:
    """One decoded record for each origin: its segments in order, checked for gaps and for the total length."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("segment", kind="stable")
        twice = frame["segment"].duplicated()
        if twice.any():  # a segment that was stored again is one segment, two that differ are damage
            if frame.drop_duplicates(["segment", "content", "total_length"])["segment"].duplicated().any():
                raise ValueError(f"segments of {frame['origin_id'].iloc[0]} with one number differ")
            frame = frame[~twice]
        if frame["segment"].tolist() != list(range(1, len(frame) + 1)):
            raise ValueError(f"segments of {frame['origin_id'].iloc[0]} are missing")
        block, total = b"".join(frame["content"]), frame["total_length"].iloc[-1]
        if not total or int(total) != len(block):
            raise ValueError(f"segments of {frame['origin_id'].iloc[0]} are not as long as their total says")
        payload, first = payload_of(block), frame.iloc[0]
        return _typed([(
            first["record_id"], first["record_type"], int(first["page_id"]) if first["page_id"] else None, first["url"], first["refers_to_record"], first["payload_digest"], first["origin_id"],
            0, len(block), payload if keep else None, len(payload), digest_of(payload),
        )])

    # Numbers as strings, as pandas would round long ids beside nulls.
    as_text = segments.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("page_id", "total_length")})
    return as_text.groupBy("origin_id").applyInPandas(run, _RECORD)


def _all_records(files: DataFrame, keep: bool) -> DataFrame:
    small_batches(files.sparkSession)
    return read_records(files, False, keep).unionByName(reassemble(read_records(files, True), keep))


def read_warc(files: DataFrame) -> DataFrame:
    """page_id, url, record_type, payload_digest, record_id, refers_to_record and payload (null for revisits) of every page."""
    return _all_records(files, True).select("page_id", "url", "record_type", "payload_digest", "record_id", "refers_to_record", F.col("content").alias("payload"))


def round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from its archive records."""
    rows = _all_records(write_warc(pages, segment_bytes), False).select("page_id", "record_type", "record_id", "refers_to_record", "size", "found")
    rows = materialize(rows, "warc-read")
    responses = rows.where("record_type = 'response'")
    held = responses.select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"), F.col("size").alias("held_size"), F.col("found").alias("held_digest"))
    whole = responses.select("page_id", F.col("size").alias("payload_bytes"), F.col("found").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    again = rows.where("record_type = 'revisit'").join(held, "refers_to_record", "left").select("page_id", F.col("held_size").alias("payload_bytes"), F.col("held_digest").alias("payload_digest"), "record_type", "refers_to")
    return whole.unionByName(again)
