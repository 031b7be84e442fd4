"""Suffix-array deduplication of repeated byte strings, by merging shard transforms.

Sorting every suffix of a corpus is needless for repeats of a fixed length: a string of LENGTH
bytes always holds the anchor that its own bytes select (the least 32-byte hash in it), so only
suffixes at anchors are kept, about one byte in 85. Each shard lists its anchors with their right
context and, as in a Burrows-Wheeler transform, what precedes them. Owners merge the shards'
lists: all anchors with one hash form a bucket, and the interleave within it is refined word by
word of context, without sorting any suffix anew. That yields the common prefixes on both sides,
and from them which strings around an anchor occur twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, ship

#: Bytes of a repeat, and of the string whose hash selects an anchor.
LENGTH, GRAM = 200, 32
WINDOW = LENGTH - GRAM + 1
#: A chunk of whole texts closes at so many bytes or texts.
CHUNK_BYTES, CHUNK_TEXTS = 1 << 19, 256
#: Rows that an owner refines at a time, at least; a bucket is never split.
OWNED = 8_000

#: Texts in chunks (blob set), and runs of string starts that share an anchor (blob null).
SHARD = "chunk long, doc_ids array<long>, sizes array<int>, blob binary, at int, hash long, print long, pre int, len int"

_MIX = np.uint64(0x9E3779B97F4A7C15)


def runs_of(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, how many starts, anchor) of each run of consecutive LENGTH-byte strings with one anchor.

    ``raw``: bytes of texts end to end, ``ends``: where they end. No string crosses texts. The
    anchor is the place of the least hash of GRAM bytes, the last such place of equal ones.
    """
    n = len(raw) - GRAM + 1
    empty = np.empty(0, np.int64)
    if len(raw) < LENGTH:
        return empty, empty, empty
    h, power = (raw.astype(np.uint64) + np.uint64(1)) * _MIX, np.uint64(0xD1342543DE82EF95)
    span = 1
    with np.errstate(over="ignore"):
        while span < GRAM:
            h = h[:-span] * power + h[span:]
            power = power * power
            span *= 2
        h ^= h >> np.uint64(29)
        h *= _MIX
    # Order by 32 bits of the hash; the place breaks ties in favour of the last one.
    least = (h & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    span = 1
    while span * 2 <= WINDOW:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[: len(raw) - LENGTH + 1], least[WINDOW - span : WINDOW - span + len(raw) - LENGTH + 1])
    anchor = (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)
    text_of_start = np.searchsorted(ends, np.arange(len(anchor)), "right")
    valid = np.arange(len(anchor)) + LENGTH <= ends[text_of_start]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text_of_start[1:] != text_of_start[:-1]))
    first = np.flatnonzero((new | np.append(True, ~valid[:-1])) & valid)
    stop = np.flatnonzero(np.append((new | np.append(True, ~valid[:-1]))[1:] | ~valid[1:], True) & valid)
    return first, stop - first + 1, anchor[first]


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk = TaskContext.get().partitionId() << 33
    pack = zstandard.ZstdCompressor(level=1)
    ids: list = []
    texts: list[bytes] = []
    held = 0

    def flush() -> pa.RecordBatch:
        body = b"".join(texts)
        raw, ends = np.frombuffer(body, np.uint8), np.cumsum([len(t) for t in texts])
        first, count, anchor = runs_of(raw, ends)
        view, digest, signed = memoryview(body), xxhash.xxh3_64_intdigest, 1 << 63
        hashes = [digest(view[p : p + GRAM]) - signed for p in anchor.tolist()]
        prints = [digest(view[s : s + n + LENGTH - 1], seed=p - s) - signed for s, n, p in zip(first.tolist(), count.tolist(), anchor.tolist(), strict=True)]
        n = len(first)
        cols = [
            pa.array([chunk] * (n + 1), pa.int64()), pa.array([ids, *[None] * n], pa.list_(pa.int64())), pa.array([[len(t) for t in texts], *[None] * n], pa.list_(pa.int32())),
            pa.array([pack.compress(body), *[None] * n], pa.binary()), pa.array([None, *first.tolist()], pa.int32()), pa.array([None, *hashes], pa.int64()), pa.array([None, *prints], pa.int64()),
            pa.array([None, *(anchor - first).tolist()], pa.int32()), pa.array([None, *count.tolist()], pa.int32()),
        ]
        ids.clear()
        texts.clear()
        return pa.RecordBatch.from_arrays(cols, ["chunk", "doc_ids", "sizes", "blob", "at", "hash", "print", "pre", "len"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            ids.append(doc)
            texts.append(text.as_py() or b"")
            held += len(texts[-1])
            if held >= CHUNK_BYTES or len(ids) >= CHUNK_TEXTS:
                yield flush()
                chunk, held = chunk + 1, 0
    if ids:
        yield flush()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted runs of each chunk."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for blob, wanted, chunk in zip(batch.column("blob"), batch.column("wanted"), batch.column("chunk").to_pylist(), strict=True):
            body = unpack.decompress(blob.as_py())
            rows = wanted.as_py()
            segs = [body[r["at"] : r["at"] + r["len"] + LENGTH - 1] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk] * len(rows), pa.int64()), *[pa.array([r[k] for r in rows], t) for k, t in (("at", pa.int32()), ("hash", pa.int64()), ("pre", pa.int32()), ("len", pa.int32()), ("n", pa.int64()))], pa.array(segs, pa.binary())],
                ["chunk", "at", "hash", "pre", "len", "n", "seg"],
            )


def refine(bucket: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of rows by bucket and context bytes, and how many context bytes each row shares with the row before it there (-1: another bucket).

    The interleave starts as the buckets and is refined by eight bytes of context at a time; rows
    that stand alone drop out.
    """
    n, width = context.shape
    words = np.ascontiguousarray(context).view(">u8").astype(np.uint64)
    order = np.argsort(bucket, kind="stable")
    label = np.cumsum(np.append(0, bucket[order][1:] != bucket[order][:-1]))
    for w in range(words.shape[1]):
        alone = np.append(True, label[1:] != label[:-1]) & np.append(label[1:] != label[:-1], True)
        live = np.flatnonzero(~alone)
        if not len(live):
            break
        sub = np.lexsort((words[order[live], w], label[live]))
        order[live] = order[live][sub]
        changed = np.append(False, label[1:] != label[:-1])
        word = words[order, w]
        changed |= np.append(False, word[1:] != word[:-1]) & ~alone
        label = np.cumsum(changed)
    shared = np.full(n, -1, np.int64)
    if n > 1:
        a, b = context[order[1:]], context[order[:-1]]
        differs = a != b
        shared[1:] = np.where(differs.any(1), differs.argmax(1), width)
        shared[1:][bucket[order[1:]] != bucket[order[:-1]]] = -1
    return order, shared


def repeated(hashes: np.ndarray, pre: np.ndarray, count: np.ndarray, segs: list[bytes]) -> list[np.ndarray]:
    """For each run, which of its starts begin a string that another run of its bucket has too."""
    n = len(segs)
    bucket = np.unique(hashes, return_inverse=True)[1]
    right = np.zeros((n, LENGTH), np.uint8)
    left = np.zeros((n, -(-WINDOW // 8) * 8), np.uint8)
    for k, s in enumerate(segs):
        p = int(pre[k])
        after, before = np.frombuffer(s, np.uint8)[p : p + LENGTH], np.frombuffer(s, np.uint8)[:p][::-1]
        right[k, : len(after)] = after
        left[k, : len(before)] = before
    sides = []
    for context in (left, right):
        order, shared = refine(bucket, context)
        sides.append((order, shared))
    out = [np.zeros(int(c), bool) for c in count]
    class_of = np.empty((2, n), np.int64)
    last = pre - count + 1
    for r in range(WINDOW):
        rows = np.flatnonzero((last <= r) & (r <= pre))
        if len(rows) < 2:
            continue
        # Strings that begin r bytes before the anchor are the same if both contexts agree so far.
        for side, ((order, shared), upto) in enumerate(zip(sides, (r, LENGTH - r), strict=True)):
            class_of[side, order] = np.cumsum(shared < upto)
        key = class_of[0, rows] * (n + 1) + class_of[1, rows]
        _, where, times = np.unique(key, return_inverse=True, return_counts=True)
        for k in rows[times[where] > 1].tolist():
            out[k][pre[k] - r] = True
    return out


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor hash: refine whole buckets, some at a time; give the repeated starts of runs that occur once."""
    held: list[pa.RecordBatch] = []

    def close(table: pa.Table) -> pa.RecordBatch:
        col = {c: table.column(c).to_numpy() for c in ("chunk", "at", "hash", "pre", "len", "n")}
        flags = repeated(col["hash"], col["pre"].astype(np.int64), col["len"].astype(np.int64), table.column("seg").to_pylist())
        chunk, at, count = [], [], []
        for k in np.flatnonzero(col["n"] == 1).tolist():
            edge = np.diff(np.concatenate([[0], flags[k].astype(np.int8), [0]]))
            for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
                chunk.append(int(col["chunk"][k]))
                at.append(int(col["at"][k]) + a)
                count.append(b - a)
        return pa.RecordBatch.from_arrays([pa.array(chunk, pa.int64()), pa.array(at, pa.int32()), pa.array(count, pa.int32())], ["chunk", "at", "len"])

    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= OWNED:
            table = pa.Table.from_batches(held).combine_chunks()
            keys = table.column("hash").to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))
            if whole >= OWNED:
                yield close(table.slice(0, whole))
                table = table.slice(whole)
            held, size = table.to_batches(), table.num_rows
    if size:
        yield close(pa.Table.from_batches(held).combine_chunks())


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for ids, sizes, blob, spans in zip(batch.column("doc_ids"), batch.column("sizes"), batch.column("blob"), batch.column("spans"), strict=True):
            sizes = sizes.as_py()
            body = unpack.decompress(blob.as_py())
            edge = np.zeros(len(body) + 1, np.int64)
            if spans.is_valid and len(spans.values):
                at, count = (spans.values.field(k).to_numpy().astype(np.int64) for k in ("at", "len"))
                np.add.at(edge, at, 1)
                np.add.at(edge, at + count + LENGTH - 1, -1)
            gone = np.cumsum(edge)[:-1] > 0
            raw, out, start = np.frombuffer(body, np.uint8), [], 0
            for doc, size in zip(ids.as_py(), sizes, strict=True):
                cut = gone[start : start + size]
                kept = raw[start : start + size][~cut].tobytes()
                out.append((doc, size, size - len(kept), int(np.count_nonzero(np.diff(cut.astype(np.int8), prepend=0) == 1)), hashlib.sha256(kept).hexdigest(), kept))
                start += size
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Cut from each text every byte of a LENGTH-byte string that starts anywhere else too, overlapping places included.

    doc_id, n_bytes, n_removed, n_spans (removed runs), kept_sha256, kept (the bytes that remain);
    a row for each document row. Texts are UTF-8 bytes, null is empty, no match crosses texts, and
    strings are judged on the input. Repeated rows remove each other; a null doc_id stays null;
    other columns play no part; no rows give no rows.
    """
    ship(docs.sparkSession)
    shards = scratch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_shard, SHARD), "shards")
    runs = shards.where("blob is null").select("chunk", "at", "hash", "print", "pre", "len")
    chunks = shards.where("blob is not null").select("chunk", "doc_ids", "sizes", "blob")
    twice = runs.groupBy("hash").agg(F.count("*").alias("times")).where("times > 1").select("hash")
    # A table of its own, so that the join below meets two plain shuffles and a hot anchor can be split.
    twice = scratch(twice, "twice")
    runs = scratch(runs.join(twice, "hash", "left_semi"), "runs")
    # Equal runs, as inside of copies, fold into one row; only what differs around an anchor is compared.
    kinds = scratch(runs.groupBy("hash", "print").agg(F.count("*").alias("n"), F.min(F.struct("chunk", "at", "pre", "len")).alias("r")), "kinds")
    varied = kinds.groupBy("hash").agg(F.count("*").alias("kinds"), F.min("n").alias("fewest")).where("kinds > 1 and fewest = 1").select("hash")
    wanted = kinds.join(varied, "hash", "left_semi").groupBy("r.chunk").agg(F.collect_list(F.struct("r.at", "hash", "r.pre", "r.len", "n")).alias("wanted"))
    segs = chunks.select("chunk", "blob").join(wanted, "chunk").mapInArrow(_cut, "chunk long, at int, hash long, pre int, len int, n long, seg binary")
    part = scratch(segs.repartition("hash").sortWithinPartitions("hash").mapInArrow(_own, "chunk long, at int, len int"), "part")
    whole = runs.join(kinds.where("n > 1").select("hash", "print"), ["hash", "print"], "left_semi").select("chunk", "at", "len")
    spans = scratch(whole.unionByName(part).groupBy("chunk").agg(F.collect_list(F.struct("at", "len")).alias("spans")), "spans")
    return chunks.join(spans, "chunk", "left").select("doc_ids", "sizes", "blob", "spans").mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
