"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Each partition fingerprints its texts and sends every owner of a hash range
   the sorted distinct fingerprints of that range, Golomb-coded.
2. An owner marks the fingerprints that reached it more than once and answers
   each list with a bitmap.
3. Partitions read their rows again next to their bitmaps.  Rows without a mark
   are unique and need nothing more; equal texts of one partition are put
   together, and only these suspects are shuffled, with their whole text, to be
   compared byte by byte.

What crosses the network is a few bytes a document plus one copy of each
suspect text per partition.  A group of copies of any size sends one row per
partition, so no task holds a group.

Suspects of a partition wait, by text, for GATHERED bytes and no more before they
are sent, and an owner's share is bounded by OWNED rows, whatever the table.

Rows meet their bitmaps by partition: both passes scan the same plan, whose
partitions a table of files fixes, and a per-partition count and checksum stop
the job if a source should deal its rows otherwise the second time.

Cases: a null text is an empty text.  Equal rows (same id, same text) are rows
of the group each; exactly one row with the largest id stays.  A null id counts
as the smallest.  A very long text is hashed and compared whole.  Extra columns,
whatever their names, take no part.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import golomb
from corpusloom.llm.store import Scratch

if TYPE_CHECKING:
    import pandas as pd

#: Bits of a fingerprint. Fewer make shorter codes and more false suspects, which the comparison of texts clears.
FINGERPRINT_BITS = 48
#: Bytes of suspects that a task puts together before it sends them.
GATHERED = 16 << 20
#: Rows per owner of fingerprints, about, at most.
OWNED = 4_000_000


def _fingerprint(digest: bytes) -> int:
    return int.from_bytes(digest[: FINGERPRINT_BITS // 8], "big")


def _send(owners: int):
    width = -(-(1 << FINGERPRINT_BITS) // owners)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        prints = [_fingerprint(hashlib.sha256((t or "").encode()).digest()) for batch in batches for t in batch.column(1).to_pylist()]
        if not prints:
            return
        prints = np.array(prints, dtype=np.uint64)
        own, counts = np.unique(prints, return_counts=True)
        check = int(np.bitwise_xor.reduce(prints))
        out = [(-1, golomb.encode(own[counts > 1], 0, 1 << FINGERPRINT_BITS))]
        cuts = np.searchsorted(own, np.arange(owners + 1, dtype=np.uint64) * np.uint64(width))
        for owner in np.flatnonzero(np.diff(cuts)).tolist():
            out.append((owner, golomb.encode(own[cuts[owner] : cuts[owner + 1]], owner * width, width)))
        n = len(out)
        arrays = [pa.array([part] * n, pa.int32()), pa.array([o for o, _ in out], pa.int32()), pa.array([len(prints)] * n, pa.int32()), pa.array([check] * n, pa.int64()), pa.array([b for _, b in out], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "owner", "n", "check", "blob"])

    return send


def _mark(lists: pd.DataFrame) -> pd.DataFrame:
    """An owner's answer: for each list, a bitmap of the fingerprints that other lists hold too."""
    import pandas as pd

    sent = [golomb.decode(bytes(b)) for b in lists["blob"]]
    own, counts = np.unique(np.concatenate(sent), return_counts=True)
    shared = own[counts > 1]
    bitmaps = [np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in sent]
    return pd.DataFrame({"part": lists["part"], "owner": lists["owner"], "bitmap": bitmaps})


def _suspects(lists: pd.DataFrame) -> pd.DataFrame:
    """The fingerprints of one partition that are marked or stand in it twice."""
    import pandas as pd

    found = [np.zeros(0, np.uint64)]
    for owner, blob, bitmap in zip(lists["owner"], lists["blob"], lists["bitmap"], strict=True):
        values = golomb.decode(bytes(blob))
        found.append(values if owner < 0 else values[np.unpackbits(np.frombuffer(bitmap, np.uint8))[: len(values)].astype(bool)])
    code = golomb.encode(np.unique(np.concatenate(found)), 0, 1 << FINGERPRINT_BITS)
    head = lists.iloc[0]
    return pd.DataFrame({"part": [head["part"]], "n": [head["n"]], "check": [head["check"]], "suspects": [code]})


def _read(pairs: Iterator[tuple[str, str]]) -> Iterator[tuple]:
    """Rows (id, text), each beside the partition's answer (n, check, suspects) or nothing, from their JSON."""
    for row, answer in pairs:
        own, head = json.loads(row), json.loads(answer)
        yield (own.get("id"), own.get("text")), (head["n"], head["check"], base64.b64decode(head["suspects"])) if head.get("n") else None


def _split(part: int, pairs: Iterator[tuple]) -> Iterator[tuple]:
    """Unique rows at once; suspects gathered by text, in cells of at most GATHERED bytes and one text."""
    suspects, groups, n, check, seen = frozenset(), {}, 0, 0, 0
    cell, held = part << 32, 0
    for row, head in pairs:
        if head is not None:
            n, check = head[0], head[1]
            suspects = frozenset(golomb.decode(bytes(head[2])).tolist())
        text = row[1] or ""
        digest = hashlib.sha256(text.encode())
        code = _fingerprint(digest.digest())
        seen ^= code
        n -= 1
        if code in suspects:
            held += 8 if text in groups else 8 + len(text)
            groups.setdefault(text, (digest.hexdigest(), []))[1].append(row[0])
            if held > GATHERED:
                yield from ((cell, sha, t, ids) for t, (sha, ids) in groups.items())
                groups, held, cell = {}, 0, cell + 1
        else:
            yield cell, digest.hexdigest(), None, [row[0]]
    if n or seen != check:
        raise RuntimeError(f"partition {part} returned other rows when it was read again; give exact_duplicates a written table")
    yield from ((cell, sha, t, ids) for t, (sha, ids) in groups.items())


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are.  The row with the largest id of a
    group stays.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact")
    own = docs.select(F.col(key).cast("long"), F.col(text))
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-own.count() // OWNED))
    sent = scratch.table(own.mapInArrow(_send(owners), "part int, owner int, n int, check long, blob binary"), "sent")
    marked = sent.filter("owner >= 0").groupBy("owner").applyInPandas(_mark, "part int, owner int, bitmap binary")
    answers = (
        sent.join(marked, ["part", "owner"], "left")
        .groupBy("part")
        .applyInPandas(_suspects, "part int, n int, check long, suspects binary")
    )
    answers = scratch.table(answers, "answers")
    # both sides are made by the JVM, row for row as strings, so one Python worker per task reads them side by side
    rows = own.select(F.col(key).alias("id"), F.col(text).alias("text")).toJSON()
    beside = answers.repartitionById(max(1, rows.getNumPartitions()), "part").select("*", F.explode(F.sequence(F.lit(1), "n")).alias("at"))
    marks = beside.select(*[F.when(F.col("at") == 1, F.col(c)).alias(c) for c in ("n", "check", "suspects")]).toJSON()
    if answers.isEmpty():  # an empty table may have no partition at all
        local = spark.sparkContext.emptyRDD()
    else:
        local = rows.zip(marks).mapPartitionsWithIndex(lambda part, pairs: _split(part, _read(pairs)))
    local = scratch.table(spark.createDataFrame(local, "part long, sha string, text string, ids array<long>", verifySchema=False), "local")

    groups = (
        local.filter("text IS NOT NULL")
        .groupBy("sha", "text")
        .agg(F.max(F.struct(F.array_max("ids").alias("id"), "part")).alias("keep"), F.sum(F.size("ids")).alias("group_size"))
        .select("sha", F.col("keep.id").alias("keep_id"), F.col("keep.part").alias("keep_part"), "group_size")
    )
    alone = local.filter("text IS NULL").select(F.col("ids")[0].alias(key), F.col("ids")[0].alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    at_keeper = F.coalesce(F.array_position("ids", F.col("keep_id")), F.lit(1)) - 1
    grouped = (
        local.filter("text IS NOT NULL")
        .select("part", "sha", "ids")
        .join(groups, "sha")
        .select("part", "sha", "keep_id", "keep_part", "group_size", at_keeper.alias("keeper"), F.posexplode("ids").alias("at", key))
        .select(key, "keep_id", "group_size", ((F.col("part") == F.col("keep_part")) & (F.col("at") == F.col("keeper"))).alias("kept"), F.col("sha").alias("text_sha256"))
    )
    return alone.unionByName(grouped)


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`exact_duplicates` keeps."""
    spark = docs.sparkSession
    found = Scratch(spark, "exact").table(exact_duplicates(docs, key, text), "found").select(F.col(key).alias("_id"), "keep_id", "group_size", F.unhex("text_sha256").alias("_sha"))
    same_id = F.col("_id").eqNullSafe(F.col("keep_id"))
    dropped = found.filter(~same_id).select("_id", "_sha").distinct()
    repeated = found.filter(same_id & (F.col("group_size") > 1)).groupBy("_id", "_sha").agg(F.count("*").alias("n")).filter("n > 1").select("_id", "_sha")
    own = docs.withColumn("_own", F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))
    match = lambda few: F.col(key).cast("long").eqNullSafe(few["_id"]) & (F.col("_own") == few["_sha"])
    kept = own.join(dropped, match(dropped), "left_anti")
    if not repeated.isEmpty():
        once = kept.join(repeated, match(repeated), "left_semi").dropDuplicates([key, "_own"])
        kept = kept.join(repeated, match(repeated), "left_anti").unionByName(once)
    return kept.drop("_own")
