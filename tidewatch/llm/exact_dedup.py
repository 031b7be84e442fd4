"""Exact deduplication by an extendible-hash index on shared files.

Map tasks fold the copies they meet into one entry a text and write entries and members to the
shared folder. A directory over the leading bits of the hash doubles until no bucket is overfull,
and as far as the corpus needs; buckets that still are, are split by the bits that follow. Owner
tasks take key ranges of buckets, chain texts that collide and compare bytes, so a group is exactly
the texts that are the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, scratch, ship

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: A bucket of more entries splits; the directory that the driver holds doubles up to 2 ** MAX_DEPTH slots (65,536 numbers).
BUCKET_ENTRIES, MAX_DEPTH = 4096, 16
#: Bytes of text for which a map task remembers entries before it starts a new set.
FOLD_BYTES = 16 << 20

INDEX = "entry long, hash long, body binary, doc_id long, best boolean, n long, sha string"


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members (body null) and entries (with the folded text) of a task, numbered alike."""
    pid, nth, held = TaskContext.get().partitionId() << 33, 0, 0
    entries: dict[bytes, list] = {}
    members: list[tuple] = []

    def flush() -> pa.RecordBatch:
        cols = list(zip(*members, strict=True)) if members else [[]] * 4
        best = {e[4] for e in entries.values()}
        m = {"entry": cols[0], "hash": [None] * len(members), "body": [None] * len(members), "doc_id": cols[1], "best": [k in best for k in cols[3]], "n": [None] * len(members), "sha": cols[2]}
        rows = list(entries.items())
        e = {"entry": [x[0] for _, x in rows], "hash": [x[1] for _, x in rows], "body": [b for b, _ in rows], "doc_id": [x[2] for _, x in rows], "best": [None] * len(rows), "n": [x[3] for _, x in rows], "sha": [None] * len(rows)}
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_(), pa.int64(), pa.string()]
        out = pa.RecordBatch.from_arrays([pa.array([*m[k], *e[k]], t) for k, t in zip(m, types, strict=True)], list(m))
        entries.clear()
        members.clear()
        return out

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            body = (text or b"").translate(_FOLD)
            e = entries.get(body)
            if e is None:
                e = entries[body] = [pid | nth, xxhash.xxh64_intdigest(body) - (1 << 63), doc, 0, nth, hashlib.sha256(body).hexdigest()]
                held += len(body)
            elif doc is not None and (e[2] is None or doc > e[2]):
                e[2], e[4] = doc, nth
            e[3] += 1
            members.append((e[0], doc, e[5], nth))
            nth += 1
            if held > FOLD_BYTES or len(members) >= 100_000:
                yield flush()
                held = 0
    if members:
        yield flush()


def directory(counts: dict[int, int], capacity: int = BUCKET_ENTRIES, max_depth: int = MAX_DEPTH) -> np.ndarray:
    """The bucket of each value of the leading ``max_depth`` bits. counts: entries by those bits.

    The directory starts with one slot. It doubles while a bucket as deep as itself is overfull;
    such a bucket splits on its next bit, and the slots of a shallower one stay together.
    """
    held = np.zeros(1 << max_depth, np.int64)
    for slot, n in counts.items():
        held[slot] = n
    depth, slots = 0, np.zeros(1, np.int64)
    local = np.zeros(1, np.int64)
    while depth < max_depth:
        sizes = np.bincount(slots, held.reshape(1 << depth, -1).sum(1), len(local))
        splits = np.flatnonzero((sizes > capacity) & (local == depth))
        if not len(splits):
            break
        depth += 1
        slots = np.repeat(slots, 2)
        local[splits] += 1
        # The right half of a bucket that splits is a bucket of its own.
        new = len(local) + np.arange(len(splits))
        right = np.zeros(len(slots), bool)
        right[1::2] = True
        of = np.full(len(local), -1, np.int64)
        of[splits] = new
        moved = right & (of[slots] >= 0)
        slots[moved] = of[slots[moved]]
        local = np.concatenate([local, np.full(len(splits), depth)])
    # Buckets are numbered as their key ranges ascend.
    order = np.unique(slots, return_index=True)[1].argsort(kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[np.unique(slots)[order]] = np.arange(len(order))
    return np.repeat(rank[slots], 1 << (max_depth - depth))


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by hash: chain the texts of a hash, compare bytes, and give each entry its group."""
    chain: list[list] = []  # of the current hash: [body, largest doc_id, rows, its entry, entries]
    current = None
    out: list[tuple] = []

    def close() -> None:
        for _, doc, n, entry, members in chain:
            out.extend((m, doc, n, m == entry) for m in members)
        chain.clear()

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], ["entry", "keep_id", "group_size", "stays"])

    for rows in batches:
        for entry, key, body, doc, n in zip(*(rows.column(c).to_pylist() for c in ("entry", "hash", "body", "doc_id", "n")), strict=True):
            if key != current:
                close()
                current = key
            for link in chain:
                if link[0] == body:
                    link[2] += n
                    link[4].append(entry)
                    if doc is not None and (link[1] is None or doc > link[1] or doc == link[1] and entry < link[3]):
                        link[1], link[3] = doc, entry
                    break
            else:
                chain.append([body, doc, n, entry, [entry]])
        if len(out) > 50_000:
            yield batch()
    close()
    if out:
        yield batch()


def exact_groups(docs: DataFrame) -> DataFrame:
    """Group texts that are identical after lower-casing A-Z: doc_id, keep_id, group_size, kept, text_sha256 for each row.

    Null text counts as empty. The row with the largest doc_id stays; a null doc_id is below all
    others, and of rows with the same doc_id just one stays. Other columns play no part; no rows
    give no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    index = scratch(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_fold, INDEX), "index")
    entries = index.where("body is not null").select("entry", "hash", "body", "doc_id", "n")
    slot = F.shiftrightunsigned("hash", 64 - MAX_DEPTH)
    counts = {r["slot"]: r["count"] for r in entries.groupBy(slot.alias("slot")).count().collect()}
    # At most 2 ** MAX_DEPTH pairs of numbers; hashes ascend with their buckets, so ranges of both are ranges of keys.
    of = spark.createDataFrame([(k, int(b)) for k, b in enumerate(directory(counts)) if k in counts], "slot int, bucket int")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.col("hash").bitwiseXOR(F.lit(-(1 << 63)))
    found = (
        entries.withColumn("slot", slot.cast("int"))
        .join(F.broadcast(of), "slot")
        # A bucket that is overfull at the last depth is split by the rest of its hash.
        .repartitionByRange(parts, "bucket", key)
        .sortWithinPartitions("bucket", key)
        .select("entry", "hash", "body", "doc_id", "n")
        .mapInArrow(_own, "entry long, keep_id long, group_size long, stays boolean")
    )
    members = index.where("sha is not null").select("entry", "doc_id", "best", "sha")
    return members.join(found, "entry").select("doc_id", "keep_id", "group_size", (F.col("best") & F.col("stays")).alias("kept"), F.col("sha").alias("text_sha256"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: one row of each group of equal texts.

    Of rows that share doc_id and folded text but differ in other columns, the one whose columns
    have the least hash stays.
    """
    groups = scratch(exact_groups(docs), "groups")
    stays = groups.where("kept").select(F.col("doc_id").alias("stays_id"), F.col("text_sha256").alias("stays_sha"))
    sha = lambda d: F.sha2(ascii_lower(F.coalesce(d["text"], F.lit(""))).cast("binary"), 256)
    out = docs.join(stays, docs["doc_id"].cast("long").eqNullSafe(stays["stays_id"]) & (sha(docs) == stays["stays_sha"]), "left_semi")
    # Rows that repeat doc_id and text alike both match; only then is one of them picked.
    if groups.groupBy("doc_id", "text_sha256").count().where("count > 1").isEmpty():
        return out
    row = F.struct(*[out[f"`{n}`"] for n in out.columns])
    hashed = [out[f"`{n}`"] for n, kind in out.dtypes if "map<" not in kind]
    return out.groupBy(out["doc_id"].cast("long"), sha(out)).agg(F.min_by(row, F.xxhash64(*hashed)).alias("row")).select("row.*")
