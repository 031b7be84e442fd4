"""Quality by an interpolated modified Kneser-Ney model of trusted text, one for each language.

The model is over character 4-grams of the whole Unicode range, and its tables grow with what
trusted text holds. They are never gathered in one place: texts are taken in chunks, a chunk asks
for the distinct n-grams it holds, a join with the sharded model answers it, and the chunk's texts
are scored from the answers. A quantile of the perplexities of trusted texts that were held back
from training is the threshold of their language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, free_shuffles, release_memory, scratch, ship

#: Symbols of an n-gram, and bits of a symbol: code points under 1024 stand for themselves, others share the rest by remainder; 0 is the edge of a text.
ORDER, BITS = 4, 12
SYMBOLS, SINGLE = 1 << BITS, 1024
#: The share of trusted texts of a language that its threshold lets pass, and the texts it takes to set one or to train a model of its own.
QUANTILE, LEAST_TRUSTED = 0.995, 50
#: One trusted text in so many is held back from training and sets thresholds.
HELD_BACK = 5
#: Thresholds and languages that may be broadcast; more are joined by a shuffle.
BROADCAST_LINES = 10_000
#: Symbols of a chunk, symbols that all open chunks of a task may hold, and symbols worked on at a time.
CHUNK, OPEN, WINDOW = 8 << 20, 16 << 20, 1 << 19

CHUNKS = "chunk long, lang string, doc_ids array<long>, which array<long>, sizes array<long>, blob binary, keys array<long>"


def _mask(k: int) -> int:
    return (1 << BITS * k) - 1


def _tag(k: int) -> int:
    return k << BITS * ORDER


def symbols(text: str) -> np.ndarray:
    """The symbols of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return np.where(points < SINGLE, np.maximum(points, 1), SINGLE + points % (SYMBOLS - SINGLE)).astype(np.uint16)


def _grams(stream: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The ORDER-gram that ends on each symbol and on the end of each text, window by window; texts begin with edges."""
    # Edges between the texts: ORDER - 1 before each, one behind it.
    ends = np.cumsum(sizes + ORDER)
    keep = np.ones(len(stream) + ORDER * len(sizes), bool)
    keep[((ends - sizes - ORDER)[:, None] + np.arange(ORDER - 1)).ravel()] = False
    keep[ends - 1] = False
    out = np.zeros(len(keep), np.uint16)
    out[keep] = stream
    keep[ends - 1] = True
    for a in range(0, len(out), WINDOW):
        seg = out[max(0, a - ORDER + 1) : a + WINDOW].astype(np.int64)
        if a == 0:
            seg = np.concatenate([np.zeros(ORDER - 1, np.int64), seg])
        n = len(seg) - ORDER + 1
        key = seg[:n].copy()
        for j in range(1, ORDER):
            key <<= BITS
            key |= seg[j : j + n]
        yield key[keep[a : a + WINDOW]]


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, index of each in them)."""
    found = pa.array(key).dictionary_encode()
    return found.dictionary.to_numpy(), found.indices.to_numpy()


def _asked(grams: np.ndarray) -> np.ndarray:
    """Tagged n-grams of every order that the probabilities of some ORDER-grams rest on, sorted."""
    out = [grams | _tag(ORDER)]
    for k in range(1, ORDER):
        out += [np.unique(grams & _mask(k)) | _tag(k), np.unique((grams >> BITS) & _mask(k)) | _tag(k)]
    return np.unique(np.concatenate(out))


def _squeeze(stream: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=6).compress(np.concatenate([stream.astype(np.uint8), (stream >> 8).astype(np.uint8)]).tobytes())


def _unsqueeze(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    low, high = raw[: len(raw) // 2], raw[len(raw) // 2 :]
    return low | high.astype(np.uint16) << 8


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of one language by the chunk, with the n-grams that they ask for."""
    number = TaskContext.get().partitionId() << 33
    held: dict[str | None, list[tuple]] = {}
    sizes: dict[str | None, int] = {}

    def flush(lang: str | None) -> pa.RecordBatch:
        nonlocal number
        docs, which, parts = zip(*held.pop(lang), strict=True)
        del sizes[lang]
        stream, n = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        grams = np.unique(np.concatenate([_distinct(key)[0] for key in _grams(stream, n)]))
        row = [[number], [lang], [list(docs)], [list(which)], [n], [_squeeze(stream)], [_asked(grams)]]
        number += 1
        types = [pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], ["chunk", "lang", "doc_ids", "which", "sizes", "blob", "keys"])

    for batch in batches:
        for doc, lang, text, which in zip(*(batch.column(k) for k in range(4)), strict=True):
            lang, part = lang.as_py(), symbols(text.as_py() or "")
            held.setdefault(lang, []).append((doc.as_py(), which.as_py(), part))
            sizes[lang] = sizes.get(lang, 0) + len(part) + ORDER
            if sizes[lang] >= CHUNK:
                yield flush(lang)
            elif sum(sizes.values()) >= OPEN:
                yield flush(max(sizes, key=sizes.__getitem__))
    for lang in list(held):
        yield flush(lang)
    release_memory()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the ORDER-grams of a chunk's trusted texts."""
    for batch in batches:
        for lang, sizes, blob, trusted in zip(*(batch.column(c) for c in ("lang", "sizes", "blob", "trusted")), strict=True):
            stream, n = _unsqueeze(blob.as_py()), np.array(sizes.as_py(), np.int64)
            ends = np.cumsum(n)
            picked = sorted(trusted.as_py())
            some = np.concatenate([stream[ends[k] - n[k] : ends[k]] for k in picked])
            parts = []
            for key in _grams(some, n[picked]):
                grams, at = _distinct(key)
                parts.append((grams, np.bincount(at, minlength=len(grams))))
            grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            total = np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()] * len(grams), pa.string()), pa.array(grams | _tag(ORDER)), pa.array(total)], ["lang", "key", "n"])


def log_probabilities(grams: np.ndarray, keys: np.ndarray, share: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Log probability of the last symbol of each ORDER-gram after the others, from a table of tagged n-grams sorted by key."""

    def look(q: np.ndarray, values: np.ndarray, default: float) -> np.ndarray:
        if not len(keys):
            return np.full(len(q), default)
        at = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
        return np.where(keys[at] == q, values[at], default)

    p = np.full(len(grams), 1 / SYMBOLS)
    for k in range(1, ORDER + 1):
        context = (grams >> BITS) & _mask(k - 1) | _tag(k - 1)
        # A context that was never seen leaves everything to the order below.
        p = look(grams & _mask(k) | _tag(k), share, 0.0) + look(context, weight, 1.0) * p
    # A discount of zero leaves no weight for what was not seen; the floor keeps every text finite.
    return np.log(np.maximum(p, 1e-9))


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            lang, docs, which, sizes, blob, pos, share, weight = (batch.column(c)[row] for c in ("lang", "doc_ids", "which", "sizes", "blob", "pos", "share", "weight"))
            stream, n = _unsqueeze(blob.as_py()), sizes.values.to_numpy()
            windows = [_distinct(key) for key in _grams(stream, n)]
            del stream
            grams = np.unique(np.concatenate([g for g, _ in windows]))
            # The answers by their place among what was asked, the empty context before all.
            asked = np.concatenate([[_tag(0)], _asked(grams)])
            told_share, told_weight = np.zeros(len(asked)), np.ones(len(asked))
            if pos.is_valid:
                at = pos.values.to_numpy() + 1
                told_share[at], told_weight[at] = share.values.to_numpy(), weight.values.to_numpy()
            logs = log_probabilities(grams, asked, told_share, told_weight)
            ends, total, done = np.cumsum(n + 1), np.zeros(len(n)), 0
            for g, at in windows:
                owner = np.searchsorted(ends, np.arange(done, done + len(at)), "right")
                total += np.bincount(owner, logs[np.searchsorted(grams, g)][at], len(n))
                done += len(at)
            m = len(n)
            yield pa.RecordBatch.from_arrays([docs.values, which.values, pa.array([lang.as_py()] * m, pa.string()), pa.array(n + 1), pa.array(total)], ["doc_id", "which", "lang", "n_symbols", "logp"])
    release_memory()


def model(counted: DataFrame, few: bool = False) -> DataFrame:
    """The model's table (grp, key, share, weight) from counts of tagged ORDER-grams (grp, key, n); few: groups are so few that a row for each may be broadcast.

    share: the discounted share of an n-gram in its context; weight: what its discounts leave to
    the order below where it is a context itself, null if it never is.
    """
    level, out = counted, None
    for k in range(ORDER, 0, -1):
        context = (F.shiftright("key", BITS).bitwiseAND(F.lit(_mask(k - 1)))).bitwiseOR(F.lit(_tag(k - 1)))
        of = level.groupBy("grp").agg(*[F.sum((F.col("n") == j).cast("int")).cast("double").alias(f"n{j}") for j in (1, 2, 3, 4)])
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        d = lambda j: F.when((F.col(f"n{j}") > 0) & (F.col("n1") > 0), F.greatest(F.lit(0.0), j - (j + 1) * y * F.col(f"n{j + 1}") / F.col(f"n{j}"))).otherwise(0.5)
        of = of.select(F.col("grp").alias("of_grp"), d(1).alias("d1"), d(2).alias("d2"), d(3).alias("d3"))
        each = level.join(F.broadcast(of) if few else of, F.col("grp") == F.col("of_grp")).select("grp", context.alias("context"), "key", "n", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")).alias("d"))
        contexts = each.groupBy("grp", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("given"))
        shares = each.join(contexts, ["grp", "context"]).select("grp", "key", ((F.col("n") - F.col("d")) / F.col("total")).alias("share"), F.lit(None).cast("double").alias("weight"))
        weights = contexts.select("grp", F.col("context").alias("key"), F.lit(None).cast("double").alias("share"), (F.col("given") / F.col("total")).alias("weight"))
        both = shares.unionByName(weights)
        out = both if out is None else out.unionByName(both)
        if k == 1:
            break
        # The count of a shorter n-gram: how many symbols it follows.
        level = scratch(level.groupBy("grp", (F.col("key").bitwiseAND(F.lit(_mask(k - 1)))).bitwiseOR(F.lit(_tag(k - 1))).alias("key")).agg(F.count("*").alias("n")), f"order{k - 1}")
    return out.groupBy("grp", "key").agg(F.max("share").alias("share"), F.max("weight").alias("weight"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text", which(docs).alias("which"))


def which(docs: DataFrame):
    """Tells rows that share a doc_id apart."""
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")), F.coalesce(docs["lang"].cast("string"), F.lit("")))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """As ``judge``, with which (see there) for each row."""
    trusted = labels.groupBy(F.col("doc_id").cast("long").alias("trusted_id")).agg(F.max("quality").alias("quality")).where("quality = 1 and trusted_id is not null").select("trusted_id")
    trusted = trusted.withColumn("back", F.pmod(F.xxhash64("trusted_id"), F.lit(HELD_BACK)) == 0)
    texts, spark = _texts(docs), docs.sparkSession
    ship(spark)
    chunks = scratch(texts.select("doc_id", "lang", "text", "which").mapInArrow(_chunks, CHUNKS), "chunks")

    # Where the texts to train on stand in the chunks. The same join at every size: ids by shuffle, whether or not they would fit a broadcast today.
    placed = chunks.select("chunk", "lang", F.posexplode("doc_ids").alias("pos", "doc_id")).join(trusted.where("not back").hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left_semi")
    placed = scratch(placed.groupBy("chunk", "lang").agg(F.collect_list("pos").alias("trusted")), "placed")
    own = placed.where("lang is not null").groupBy(F.col("lang").alias("own_lang")).agg(F.sum(F.size("trusted")).alias("texts")).where(F.col("texts") >= LEAST_TRUSTED).select("own_lang")
    own = scratch(own, "own")
    few = own.count() <= BROADCAST_LINES

    def with_group(df: DataFrame) -> DataFrame:
        """grp: a language with a model of its own, or the one that all others share."""
        return df.join(F.broadcast(own) if few else own, F.col("lang") == F.col("own_lang"), "left").withColumn("grp", F.coalesce("own_lang", F.lit(""))).drop("own_lang")

    counts = chunks.select("chunk", "sizes", "blob").join(placed, "chunk").select("lang", "sizes", "blob", "trusted").mapInArrow(_count, "lang string, key long, n long")
    counted = scratch(with_group(counts).groupBy("grp", "key").agg(F.sum("n").alias("n")), "counts")
    table = scratch(model(counted, few), "model")

    asked = with_group(chunks.select("chunk", "lang", F.posexplode("keys").alias("pos", "key")))
    # The empty context stands before all that a chunk asks for.
    root = with_group(chunks.select("chunk", "lang", F.lit(-1).alias("pos"), F.lit(_tag(0)).cast("long").alias("key")))
    told = asked.unionByName(root).join(table, ["grp", "key"])
    numbers = {"pos": F.col("pos"), "share": F.coalesce("share", F.lit(0.0)).cast("float"), "weight": F.coalesce("weight", F.lit(1.0)).cast("float")}
    told = scratch(told.groupBy("chunk").agg(*[F.collect_list(c).alias(name) for name, c in numbers.items()]), "told")
    discard(placed, counted, table)
    free_shuffles(spark)
    scored = chunks.select("chunk", "lang", "doc_ids", "which", "sizes", "blob").join(told, "chunk", "left").drop("chunk").mapInArrow(_score, "doc_id long, which long, lang string, n_symbols long, logp double")
    perplexity = F.when(F.col("n_symbols") > 1, F.round(F.exp(-F.col("logp") / F.col("n_symbols")), 6))
    scored = scratch(scored.select("doc_id", "which", "lang", "n_symbols", perplexity.alias("perplexity")), "scored")
    discard(chunks, told)

    good = scored.join(trusted, F.col("doc_id") == F.col("trusted_id")).where("perplexity is not null").select("lang", "perplexity", "back")
    # Tables with too few trusted texts to hold any back set thresholds by those that were trained on.
    held = good.where("back") if good.where("back").limit(1).count() else good
    line = F.percentile_approx("perplexity", F.lit(QUANTILE), F.lit(20_000)).alias("line")
    # One row for each language, and one for all.
    lines = held.groupBy(F.col("lang").alias("of_lang")).agg(line, F.count("*").alias("texts")).where((F.col("texts") >= LEAST_TRUSTED) & F.col("of_lang").isNotNull())
    lines = scratch(lines.select("of_lang", "line"), "lines")
    overall = held.agg(line).withColumnRenamed("line", "all_line")
    few_lines = lines.count() <= BROADCAST_LINES
    out = scored.join(F.broadcast(lines) if few_lines else lines, F.col("lang") == F.col("of_lang"), "left").crossJoin(F.broadcast(overall))
    threshold = F.coalesce("line", "all_line")
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))
    return out.select("doc_id", "which", "lang", "n_symbols", "perplexity", threshold.alias("threshold"), kept.alias("kept"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Perplexity and verdict of each row: doc_id, lang, n_symbols, perplexity, threshold, kept.

    Trusted are texts labelled quality 1 (of an id labelled twice, the larger label counts); one in
    HELD_BACK of them, by a hash of the id, sets thresholds and trains nothing. A language with
    fewer than LEAST_TRUSTED texts to train on, and null, share one model; one with fewer held back
    takes the threshold of all of those. Without trusted text nothing is rejected. Null and empty
    texts have no perplexity and are rejected. Repeated rows are judged each; other columns play no
    part; no rows give no rows.
    """
    return judged(docs, labels).drop("which")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns; rows that share a doc_id are judged each by its own text and language."""
    kept = judged(docs, labels).where("kept").select(F.col("doc_id").alias("kept_doc_id"), F.col("which").alias("kept_which")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["kept_doc_id"]) & (which(docs) == kept["kept_which"]), "left_semi")
