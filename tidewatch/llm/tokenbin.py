"""Token ids in compressed binary blocks: an adaptive context-mixing range coder.

Each id is coded in one step of a carryless range coder. An order-2 and an order-1 context predict
one id each, from what the block has held so far. Order 0 is the block's own ids up to now, each
as likely as it was frequent, estimated anew whenever the block has doubled. What none of them
holds is coded by the segment's first distribution, which stands in its header. How much each
order is trusted is mixed from how often it was right lately.

Blocks start afresh, each has a checksum, and any one can be decoded from the header and its own
words (``decode_block``). All blocks of a segment are coded in step, one array element a block.

Segment layout, little-endian: magic, n_ids, block size, n_blocks, bits of the first distribution,
bytes of the packed table, n_texts, bytes of the packed texts (eight uint32); the packed table of
frequencies; the packed texts (doc_id, 0 if null; 1 if null; ids of the text; three int64 arrays);
words and checksum of each block (uint32 each); the blocks' 32-bit words; a CRC-32 of all that.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_memory, scratch, ship
from .tokens import encoder, with_end

MAGIC, BLOCK = 0x32435754, 1024
#: Ids after which a segment closes; texts are never split.
SEGMENT = 1 << 23
#: Slots of each context's table in a block; bits of the first distribution at least, of a trust, and of the whole mixture.
SLOTS, BITS0, TRUST, TOTAL = 256, 18, 12, 30
#: Ids of a block after which order 0 is first estimated; then at each doubling. Steps that the encoder prepares at once.
FIRST, STRETCH = 64, 128
#: A trust stays between 1/16 and 15/16, so whatever is left for the first distribution has a unit for each of its parts.
LEAST, MOST = 1 << (TRUST - 4), 15 << (TRUST - 4)
_U = np.uint64
_WORD = _U(32)


def first_distribution(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Frequencies that add up to 2 ** bits, at least one for each id that occurs; and bits."""
    there = np.flatnonzero(counts)
    bits = max(BITS0, int(len(there)).bit_length() + 1)
    out = np.zeros(len(counts), np.int64)
    room = (1 << bits) - len(there)
    out[there] = 1 + counts[there] * room // max(1, counts.sum())
    if len(there):
        out[there[counts[there].argmax()]] += (1 << bits) - out.sum()
    return out, bits


class Mixer:
    """The predictions of all blocks at one step; encoder and decoder go through the same ones.

    A context's slot holds the id that followed it last, -1 and -2 none. Each block keeps a trust
    in order 1, in order 2, in both where they agree, and in order 0. Row 0 of the arrays is
    order 1, row 1 order 2.
    """

    def __init__(self, lanes: int):
        lane = np.arange(lanes, dtype=np.int64)
        self.base = np.stack([lane * SLOTS, (lane + lanes) * SLOTS])
        self.slots = np.repeat(np.array([-1, -2], np.int32), lanes * SLOTS)
        self.trusts = np.full((4, lanes), 1 << (TRUST - 1), np.int32)

    def places(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The slots that the last id and the one before it lead to."""
        k = one * np.int32(9277)
        at = np.empty((2, *k.shape), np.int64)
        at[0], at[1] = k >> 5, (k ^ two * np.int32(25717)) >> 4
        at &= SLOTS - 1
        return at

    def predict(self, at: np.ndarray, seen: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The widths w2, w1, w0 of order 2, 1 and 0 of 2 ** TOTAL; sets ids (2, lanes). at: places; seen: order 0 has been estimated."""
        self.at = at
        self.ids = ids = self.slots.take(at, mode="clip")
        self.agree = _mask(ids[0] == ids[1])
        t1, t2, both, t0 = self.trusts
        self.t2 = t2 = _chosen(self.agree, both, t2)
        left = (1 << TRUST) - t2
        given = left * t1
        given &= ~self.agree
        w0 = None
        if seen:
            left <<= TRUST
            left -= given
            left >>= 3 * TRUST - TOTAL
            left *= t0
            w0 = left
        given <<= TOTAL - 2 * TRUST
        return t2 << (TOTAL - TRUST), given, w0

    def hits(self, now: np.ndarray) -> np.ndarray:
        """Masks of the contexts that predict the ids that came; order 1 counts only where order 2 does not."""
        hit = self.ids == now
        hit[0] &= ~hit[1]
        return _mask(hit)

    def update(self, now: np.ndarray, hit: np.ndarray, in_seen: np.ndarray | None) -> None:
        """Learn the ids that came; in_seen: mask of those among order 0's, where it was estimated."""
        t1, t2, both, t0 = self.trusts
        wide = np.int32(MOST - LEAST)
        new = hit[1] & wide
        new += LEAST
        new -= self.t2
        new >>= 4
        known = new & self.agree
        both += known
        new -= known
        t2 += new
        new = hit[0] & wide
        new += LEAST
        new -= t1
        new >>= 4
        new &= ~(self.agree | hit[1])
        t1 += new
        if in_seen is not None:
            new = in_seen & wide
            new += LEAST
            new -= t0
            new >>= 5
            new &= ~(hit[0] | hit[1])
            t0 += new
        self.slots[self.at[0]] = now
        self.slots[self.at[1]] = now


def _mask(is_: np.ndarray) -> np.ndarray:
    """All bits set where true, none elsewhere: a choice by masks takes a fraction of the time of one by a condition."""
    out = is_.astype(np.int32)
    return np.negative(out, out=out)


def _chosen(mask: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """One where the mask is set, else the other."""
    out = one ^ other
    out &= mask
    out ^= other
    return out


def _seen(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block's ids so far (lanes, n): sorted, and where the run of each one's equals begins and ends."""
    rows = np.sort(grid, axis=1)
    n = rows.shape[1]
    at = np.arange(n, dtype=np.int32)
    new = np.ones(rows.shape, bool)
    np.not_equal(rows[:, 1:], rows[:, :-1], out=new[:, 1:])
    lo = np.maximum.accumulate(np.where(new, at, np.int32(0)), axis=1)
    end = np.ones(rows.shape, bool)
    end[:, :-1] = new[:, 1:]
    hi = np.minimum.accumulate(np.where(end, at + np.int32(1), np.int32(n))[:, ::-1], axis=1)[:, ::-1]
    return rows, lo, hi


def _renormalize(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes that give out (or take in) their leading word, and those words; a span never crosses them."""
    small = np.flatnonzero(span < _U(1 << 32))
    lo, sp = low[small], span[small]
    word = lo >> _WORD
    sp = np.where(word != ((lo + sp - _U(1)) >> _WORD), _U(1 << 32) - (lo & _U(0xFFFFFFFF)), sp)
    span[small] = np.minimum(sp, _U(0xFFFFFFFF)) << _WORD
    low[small] = lo << _WORD
    return small, word.astype(np.uint32)


def _runs(before: np.ndarray, now: np.ndarray, n_ids: int) -> np.ndarray:
    """Where each id of now (lanes, n) stands among its block's sorted ids before: first place << 16 | how often; 0: nowhere."""
    lanes, out = len(before), np.empty(now.shape, np.int32)
    # A table by block and id, for so many blocks at a time that it stays in the cache.
    some = max(1, min(lanes, (1 << 22) // n_ids))
    table = np.zeros(some * n_ids, np.int32)
    for a in range(0, lanes, some):
        rows, first, last = _seen(before[a : a + some])
        lane = np.arange(len(rows), dtype=np.int64)[:, None] * n_ids
        at = lane + rows
        table[at] = first << 16 | (last - first)
        table.take(lane + now[a : a + some], out=out[a : a + some], mode="clip")
        table[at] = 0
    return out


def _intervals(w: np.ndarray, off: np.ndarray, lo: np.ndarray, hi: np.ndarray, shift: np.ndarray | int, hit: np.ndarray, w2: np.ndarray, w1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, width) of 2 ** TOTAL: a part of order 0 or of the first distribution, or a context's prediction."""
    w = w.astype(np.int64)
    start = w * lo
    start >>= shift
    w *= hi
    w >>= shift
    w -= start
    start += off
    # All of these are below 2 ** 31.
    start, w = _chosen(hit[0], w2, start.astype(np.int32)), _chosen(hit[0], w1, w.astype(np.int32))
    start &= ~hit[1]
    return start.astype(np.int64), _chosen(hit[1], w2, w).astype(np.int64)


def encode(ids: np.ndarray, doc_ids: list[int | None] | None = None, sizes: list[int] | None = None) -> bytes:
    """A segment of some ids (uint32), which are the ids of some texts end to end."""
    n = len(ids)
    lanes = max(1, -(-n // BLOCK))
    freq, bits = first_distribution(np.bincount(ids, minlength=1))
    cum = np.concatenate([[0], np.cumsum(freq)]).astype(np.int32)
    steps = BLOCK if lanes > 1 else n
    blocks = np.zeros(lanes * steps, np.int32)
    if n:
        blocks[:n], blocks[n:] = ids, ids[0]
    blocks = blocks.reshape(lanes, steps)
    mix, low, span = Mixer(lanes), np.zeros(lanes, _U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
    words, owners = [], []
    begin, size = 0, min(FIRST, steps)
    while begin < steps:
        # All that depends on nothing but order 0 is found for a whole stretch at once.
        among = runs = None
        if begin:
            runs = _runs(blocks[:, :begin], blocks[:, begin : begin + size], len(freq))
        for a in range(begin, begin + size, STRETCH):
            b = min(a + STRETCH, begin + size)
            part = np.ascontiguousarray(blocks[:, a:b].T)
            lo, hi = cum[part], cum[part + 1]
            if begin:
                run = np.ascontiguousarray(runs[:, a - begin : b - begin].T)
                among = _mask(run > 0)
                first = run >> 16
                lo, hi = _chosen(among, first, lo), _chosen(among, first + (run & 0xFFFF), hi)
            behind = np.zeros((b - a + 2, lanes), np.int32)
            behind[max(0, 2 - a) :] = blocks[:, max(0, a - 2) : b].T
            at = np.ascontiguousarray((mix.places(behind[1:-1], behind[:-2]) + mix.base[:, None]).swapaxes(0, 1))
            for k in range(b - a):
                now = behind[k + 2]
                w2, w1, w0 = mix.predict(at[k], begin > 0)
                hit = mix.hits(now)
                off, shift, inside = w2 + w1, bits, None
                if begin:
                    inside = among[k]
                    end = off + w0
                    w = _chosen(inside, w0, (1 << TOTAL) - end)
                    off = end - (w0 & inside)
                    shift = (inside & np.int32(begin.bit_length() - 1 - bits)) + np.int32(bits)
                else:
                    w = (1 << TOTAL) - off
                start, width = _intervals(w, off, lo[k], hi[k], shift, hit, w2, w1)
                unit = span >> _U(TOTAL)
                low += unit * start.view(_U)
                span = unit * width.view(_U)
                small, word = _renormalize(low, span)
                if len(small):
                    words.append(word)
                    owners.append(small.astype(np.int32))
                mix.update(now, hit, inside)
        begin, size = begin + size, min(begin + size, steps - begin - size)
    for part in (low >> _WORD, low & _U(0xFFFFFFFF)):
        words.append(part.astype(np.uint32))
        owners.append(np.arange(lanes, dtype=np.int32))
    owner = np.concatenate(owners)
    # Few enough to be numbered in 16 bits, blocks are sorted by their digits.
    order = np.argsort(owner.astype(np.uint16) if lanes <= 1 << 16 else owner, kind="stable")
    stream = np.concatenate(words)[order].astype("<u4")
    counts = np.bincount(owner, minlength=lanes)
    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    sums = [zlib.crc32(raw[4 * BLOCK * k : 4 * BLOCK * (k + 1)]) for k in range(lanes)]
    table = zlib.compress(freq.astype("<u4").tobytes(), 6)
    sizes = [n] if sizes is None else sizes
    keys = [None] * len(sizes) if doc_ids is None else doc_ids
    texts = zlib.compress(np.array([[k or 0 for k in keys], [k is None for k in keys], sizes], "<i8").tobytes(), 1)
    head = np.array([MAGIC, n, BLOCK, lanes, bits, len(table), len(sizes), len(texts)], "<u4").tobytes()
    body = b"".join([head, table, texts, np.stack([counts, sums], 1).astype("<u4").tobytes(), stream.tobytes()])
    return body + np.array([zlib.crc32(body)], "<u4").tobytes()


class Segment:
    """A segment's header, checked."""

    def __init__(self, segment: bytes):
        magic, self.n, self.block, self.lanes, self.bits, table, texts, packed = np.frombuffer(segment, "<u4", 8).tolist()
        if magic != MAGIC or zlib.crc32(memoryview(segment)[:-4]) != int(np.frombuffer(segment[-4:], "<u4")[0]):
            raise ValueError("not a segment, or damaged")
        self.freq = np.frombuffer(zlib.decompress(segment[32 : 32 + table]), "<u4").astype(np.int32)
        at = 32 + table
        ids, null, self.sizes = np.frombuffer(zlib.decompress(segment[at : at + packed]), "<i8").reshape(3, texts)
        self.doc_ids = pa.array(ids, mask=null.astype(bool))
        at += packed
        self.words, self.sums = np.frombuffer(segment, "<u4", 2 * self.lanes, at).reshape(self.lanes, 2).astype(np.int64).T
        self.stream = np.frombuffer(memoryview(segment)[at + 8 * self.lanes : -4], "<u4")
        self.ends = np.cumsum(self.words)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of some blocks; raises if a checksum does not hold."""
        lanes = last - first
        steps = self.block if self.lanes > 1 else self.n
        cum = np.concatenate([[0], np.cumsum(self.freq)]).astype(np.int32)
        symbol = np.repeat(np.arange(len(self.freq), dtype=np.int32), self.freq)
        # Of each part of a distribution: its id, and in one number where the id's parts begin and how many they are.
        pack = lambda lo, hi: lo.astype(np.int64) << 32 | (hi - lo)
        parts = where = pack(cum[symbol], cum[symbol + 1])
        ids = symbol
        out = np.empty((steps, lanes), np.int32)
        at_word = (self.ends - self.words)[first:last].copy()
        stream, bits = self.stream.astype(_U), self.bits
        mix, low, span = Mixer(lanes), np.zeros(lanes, _U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
        code = stream[at_word] << _WORD | stream[at_word + 1]
        at_word += 2
        one = two = np.zeros(lanes, np.int32)
        estimated, row, shift0 = False, None, np.int32(0)
        for k in range(steps):
            if k >= FIRST and k & (k - 1) == 0:
                rows, begin, end = _seen(np.ascontiguousarray(out[:k].T))
                ids, parts = np.concatenate([symbol, rows.ravel()]), np.concatenate([where, pack(begin, end).ravel()])
                row = len(symbol) + np.arange(lanes, dtype=np.int64) * k
                estimated, shift0 = True, np.int32(k.bit_length() - 1)
            at = mix.places(one, two)
            at += mix.base
            w2, w1, w0 = mix.predict(at, estimated)
            unit = span >> _U(TOTAL)
            slot = (code - low) // unit
            slot = np.minimum(slot, _U((1 << TOTAL) - 1)).astype(np.int32)
            base = w2 + w1
            off, shift, inside = base, bits, None
            if estimated:
                end = base + w0
                inside = _mask(slot < end)
                w = _chosen(inside, w0, (1 << TOTAL) - end)
                off = end - (w0 & inside)
                shift = (inside & (shift0 - np.int32(bits))) + np.int32(bits)
            else:
                w = (1 << TOTAL) - off
            # The part that holds the slot; the quotient of such numbers is exact in doubles, its floor too.
            part = np.maximum(slot - off, 0).astype(np.int64)
            part += 1
            part <<= shift
            part -= 1
            part = (part / w).astype(np.int64)
            if estimated:
                part += row & inside
            now, found = ids.take(part, mode="clip"), parts.take(part, mode="clip")
            lo = found >> 32
            hit = np.empty((2, lanes), bool)
            np.less(slot, w2, out=hit[1])
            np.less(slot, base, out=hit[0])
            hit[0] &= ~hit[1]
            hit = _mask(hit)
            now = _chosen(hit[1], mix.ids[1], _chosen(hit[0], mix.ids[0], now))
            # An id may stand in order 0 and come by a context: what is learned is the same as when it was coded.
            start, width = _intervals(w, off, lo, lo + (found & 0xFFFFFFFF), shift, hit, w2, w1)
            low += unit * start.view(_U)
            span = unit * width.view(_U)
            small, _ = _renormalize(low, span)
            if len(small):
                code[small] = code[small] << _WORD | stream[at_word[small]]
                at_word[small] += 1
            mix.update(now, hit, inside)
            two, one = one, now
            out[k] = now
        ids = out.T.reshape(-1)[: self.n - first * self.block].astype("<u4")
        raw = memoryview(ids).cast("B")
        if any(zlib.crc32(raw[4 * self.block * k : 4 * self.block * (k + 1)]) != c for k, c in enumerate(self.sums[first:last].tolist())):
            raise ValueError("a block's checksum does not hold")
        return ids


def decode(segment: bytes) -> np.ndarray:
    """The ids of a segment; raises if a checksum does not hold."""
    s = Segment(segment)
    return s.blocks(0, s.lanes)


def decode_block(segment: bytes, k: int) -> np.ndarray:
    """The ids of one block, from the header and the block's own words."""
    return Segment(segment).blocks(k, k + 1)


def write(docs: DataFrame, tokenizer: str, name: str = "tokens") -> DataFrame:
    """Encode whole texts in ascending doc_id order into files of segments in the shared folder; returns the files' rows.

    Columns: shard (files ascend with it), seq, n_ids, segment (bytes, doc_ids and sizes of the
    texts included). The files can lie in any store that Spark writes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, seq, held = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        docs_: list = []
        sizes: list[int] = []
        parts: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            row = [[shard], [seq], [held], [encode(np.concatenate(parts), docs_, sizes)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["shard", "seq", "n_ids", "segment"])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for row, ids, offsets in enc.batches(batch.column(1)):
                ids, offsets = with_end(ids, offsets)
                parts.append(ids)
                docs_ += keys[row : row + len(offsets) - 1]
                sizes += np.diff(offsets).tolist()
                held += len(ids)
                if held >= SEGMENT:
                    yield close()
                    docs_, sizes, parts, seq, held = [], [], [], seq + 1, 0
        if docs_:
            yield close()
        parts.clear()
        release_memory()

    ship(docs.sparkSession)
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Rows that share a doc_id (null is one too) are told apart by a hash of the text, so they can be split as well.
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("which"), "text")
    order = [F.asc_nulls_first("doc_id"), F.col("which")]
    ordered = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    return scratch(ordered.mapInArrow(run, "shard int, seq int, n_ids long, segment binary"), name)


def read(files: DataFrame) -> DataFrame:
    """Decode segments: a row for each text with doc_id, start (ids before it in all files), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, seq, segment in zip(*(batch.column(c) for c in ("shard", "seq", "segment")), strict=True):
                s = Segment(segment.as_py())
                raw, size = memoryview(s.blocks(0, s.lanes)).cast("B"), s.sizes
                end = np.cumsum(size)
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for n, e in zip(size.tolist(), end.tolist(), strict=True)]
                n = len(size)
                yield pa.RecordBatch.from_arrays([pa.array([shard.as_py()] * n, pa.int32()), pa.array([seq.as_py()] * n, pa.int32()), s.doc_ids, pa.array(end - size), pa.array(size), pa.array(crc, pa.int64())], ["shard", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"])
        release_memory()

    ship(files.sparkSession)
    texts = files.select("shard", "seq", "segment").mapInArrow(run, "shard int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    # Running sums over one row a shard, then over a shard's segments.
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n")).selectExpr("shard", "sum(n) over (order by shard) - n as before")
    base = files.selectExpr("shard", "seq", "sum(n_ids) over (partition by shard order by seq) - n_ids as within").join(shards, "shard").select("shard", "seq", (F.col("before") + F.col("within")).alias("base"))
    return texts.join(base, ["shard", "seq"]).select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the token files and read them back.

    Null and empty texts are their end id alone. Repeated rows are written each, those of one
    doc_id by a hash of the text; null doc_ids come first; other columns play no part; no rows
    give no rows.
    """
    return read(write(docs, tokenizer))
