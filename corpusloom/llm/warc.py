"""WARC archives with an index that is written first and read by byte range.

Writing deals pages to archives and streams one gzip member per record; every
record's archive, offset, length, URL and digest go to an index table.  Reading
sorts the selected index rows by place, joins neighbouring ranges into one read
and parses the records out of it.

Pages with equal payloads share one response record, that of the largest id;
the others are revisits that name it.  Which page that is comes from digests
alone, so a payload crosses the network once, whatever the size of its group.

A task that is run again writes a file of its own name and answers with index
rows for that file, so a lost attempt leaves an unused file and nothing else.

Cases: a null payload is an empty one, and empty payloads are equal payloads.  A
null URL gives a record without a target.  Of equal rows (same id, same payload)
one is the response.  A null id is the smallest.  A very long payload is one
member like any other.  Extra columns, whatever their names, take no part.  An
empty table writes no record and reads back none.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import Scratch

#: Bytes between two records that are read rather than skipped, and bytes of one read.
GAP, READ = 64 << 10, 8 << 20
DATE = "2024-01-01T00:00:00Z"
_INDEX = "archive string, offset long, length long, url string, digest string, record_type string, page_id long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, revisit_of: tuple[int | None] | None) -> tuple[bytes, str]:
    """A WARC record and its payload's digest."""
    digest = payload_digest(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit_of else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit_of else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit_of:
        head += [f"WARC-Refers-To: <urn:page:{revisit_of[0]}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse(raw: bytes) -> dict:
    """The fields of a WARC record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(line for line in http.decode().split("\r\n") if line.startswith("Content-Length: ")).split(": ")[1])
    number = lambda urn: None if urn is None or urn == "<urn:page:None>" else int(urn[len("<urn:page:") : -1])
    url = fields.get("WARC-Target-URI")
    out = {"page_id": number(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To")), "payload_bytes": size}
    out["payload_digest"] = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    out["url"] = url and url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    if out["record_type"] == "response" and (len(payload) != size or payload_digest(payload) != out["payload_digest"]):
        raise ValueError(f"the record of page {out['page_id']} does not have the payload of its digest")
    return out | {"payload": payload}


#: Schemes under which Hadoop names stores that Arrow knows by another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder: local, HDFS, S3 (also as s3a), GCS or Azure; others raise."""
    scheme, colon, rest = folder.partition("://")
    try:
        return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}" if colon else folder)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as e:
        raise ValueError(f"archives cannot be kept under {folder}: {e}") from e


def _write(folder: str, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, at, last = None, 0, None
        for batch in batches:
            rows = []
            for page_id, url, html, keeper, shared in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                payload = (html or "").encode()
                first = not shared or (page_id == keeper and last != (page_id, payload))
                raw, digest = record(page_id, url, payload, None if first else (keeper,))
                if first:
                    last = page_id, payload
                member = gzip.compress(raw, level, mtime=0)
                out.write(member)
                rows.append((name, at, len(member), url, digest, "response" if first else "revisit", page_id))
                at += len(member)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, kinds, strict=True)], [x.split()[0] for x in _INDEX.split(", ")])
        if out is not None:
            out.close()

    return write


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", level: int = 1) -> DataFrame:
    """Writes all pages under ``folder`` and returns the index (lazily: records are written when it is)."""
    payload = F.coalesce(F.col(html), F.lit(""))
    marks = Scratch(pages.sparkSession, "warc").table(pages.select(F.col(key).cast("long").alias("page_id"), F.sha2(payload, 256).alias("sha"), F.octet_length(payload).alias("size")), "marks")
    groups = marks.groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1").select("sha", "keeper")
    roles = marks.join(groups, "sha").select(F.col("page_id").alias("_id"), F.col("sha").alias("_sha"), "keeper").distinct()
    own = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), F.sha2(payload, 256).alias("sha"))
    # a sort-merge join deals rows by id and payload, which also brings equal rows together: payloads are shuffled this once
    same = F.col("page_id").eqNullSafe(F.col("_id")) & F.col("sha").eqNullSafe(F.col("_sha"))
    dealt = own.join(roles.hint("merge"), same, "left").sortWithinPartitions("page_id", "sha")
    return dealt.select("page_id", "url", "html", "keeper", F.col("_sha").isNotNull().alias("shared")).mapInArrow(_write(folder, level), _INDEX)


def _ranges(places: list[tuple[str, int, int]]) -> Iterator[list[int]]:
    """Neighbours of sorted (archive, offset, length) that one read covers, as indices."""
    group: list[int] = []
    for i, (archive, offset, length) in enumerate(places):
        if group:
            name, start, _ = places[group[0]]
            end = places[group[-1]][1] + places[group[-1]][2]
            if archive != name or offset - end > GAP or offset + length - start > READ:
                yield group
                group = []
        group.append(i)
    if group:
        yield group


_FIELDS = (("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()))


def _read(folder: str, payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _opened(folder)
        opened, source = None, None
        for batch in batches:
            places = list(zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True))
            for group in _ranges(places):
                name, start, _ = places[group[0]]
                if name != opened:
                    if source is not None:
                        source.close()
                    opened, source = name, store.open_input_file(f"{base}/{name}")
                data = source.read_at(places[group[-1]][1] + places[group[-1]][2] - start, start)
                rows = [parse(zlib.decompress(data[places[i][1] - start : places[i][1] - start + places[i][2]], 31)) for i in group]
                fields = [*_FIELDS, ("payload", pa.binary())] if payloads else _FIELDS
                yield pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], t) for f, t in fields], [f for f, _ in fields])
        if source is not None:
            source.close()

    return read


def read_records(selected: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of index rows, whatever their number: ranges are dealt by place and read in order."""
    parts = int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = selected.select("archive", "offset", "length").repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + (", payload binary" if payloads else "")
    return placed.mapInArrow(_read(folder, payloads), schema)
