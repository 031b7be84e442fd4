"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is mined from the labelled texts (words and word beginnings that toxic texts favour).
Each text becomes a few numbers: densities of lexicon hits, how near they stand to the second
person, capitals, punctuation, obfuscated spellings. Small boosted trees score them and an
isotonic fit on rows set aside turns scores into probabilities.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, ship

#: Labelled rows that the model is fitted on at most, in the order of a hash of their ids.
MAX_LABELLED = 20_000
#: Lexicon: entries at most, toxic texts that hold an entry at least, odds at least.
LEXICON, LEAST_TEXTS, LEAST_ODDS = 4_000, 4, 20.0
#: Lengths of word beginnings that may become entries.
BEGINNINGS = (4, 5, 6)
#: A lexicon hit is addressed to someone if a second-person word stands so many words off at most.
NEAR = 5
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 32
#: Words that a worker remembers the weight of.
REMEMBERED = 400_000

#: Second-person words of the corpus languages.
SECOND = frozenset("you your yours yourself u ya tu te toi ton ta tes vous votre vos du dich dir dein deine euch euer usted ustedes tú ti tuyo vosotros os vuestro".split())
#: Characters that stand in for letters in obfuscated spellings.
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "_": "", "-": "", ".": ""})
FEATURES = ("hits", "weighted", "log_hits", "top_weight", "distinct", "second", "addressed", "capitals", "shouted", "punctuation", "exclaimed", "obfuscated", "log_words")

_word = re.compile(r"[^\W\d_]+")
_chunk = re.compile(r"\S+")
_odd = re.compile(r"[^\W\d_][\d@$!*_.\-]+[^\W\d_]")
_punct = re.compile(r"[^\w\s]")
_shout = re.compile(r"\b[^\W\d_a-zß-öø-ÿ]{3,}\b")


def entries_of(word: str) -> list[str]:
    """What a word can match in the lexicon: itself, and its beginnings (marked by a trailing hyphen)."""
    return [word, *[word[:k] + "-" for k in BEGINNINGS if len(word) > k]]


class Features:
    """Dense features of texts under a lexicon of entries and weights."""

    def __init__(self, lexicon: dict[str, float]):
        lexicon_get = lexicon.get

        class Memo(dict):
            def __missing__(self, word: str) -> float:
                got = max(lexicon_get(e, 0.0) for e in entries_of(word))
                if len(self) > REMEMBERED:
                    self.clear()
                self[word] = got
                return got

        self.weight = Memo()

    def __call__(self, text: str | None) -> list[float]:
        text = text or ""
        words = _word.findall(text.lower())
        n = len(words) or 1
        weights = list(map(self.weight.__getitem__, words))
        hits = [k for k, w in enumerate(weights) if w > 0]
        odd = 0
        if _odd.search(text):
            for chunk in _chunk.findall(text):
                if _odd.search(chunk):
                    plain = _word.findall(chunk.translate(STAND_INS).lower())
                    odd += any(self.weight[w] > 0 for w in plain) and len(plain) == 1
        second = [k for k, w in enumerate(words) if w in SECOND]
        near = 0
        if hits and second:
            at = np.array(second)
            where = np.searchsorted(at, hits)
            left, right = at[np.maximum(where - 1, 0)], at[np.minimum(where, len(at) - 1)]
            near = int((np.minimum(np.abs(left - hits), np.abs(right - hits)) <= NEAR).sum())
        upper = sum(map(str.isupper, text))
        return [
            len(hits) / n, sum(weights) / n, math.log1p(len(hits)), max(weights, default=0.0), float(len({words[k] for k in hits})),
            len(second) / n, near / (len(hits) or 1), upper / (len(text) or 1), len(_shout.findall(text)) / n,
            len(_punct.findall(text)) / (len(text) or 1), text.count("!") / n, odd / n, math.log1p(len(words)),
        ]


def mine(sample: DataFrame) -> dict[str, float]:
    """Entries with their log odds, from labelled texts (text, toxic): a distributed count of texts for each entry."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[toxic].update({e for w in set(_word.findall((text or "").lower())) for e in entries_of(w)})
            keys = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()), pa.array([seen[0][k] for k in keys], pa.int64())], ["entry", "bad", "good"])

    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    odds = ((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("good") + 0.5) / (good + 1))
    found = sample.select("text", "toxic").mapInArrow(count, "entry string, bad long, good long").groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    rows = found.where(F.col("bad") >= LEAST_TEXTS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS).orderBy(F.desc("odds"), "entry").limit(LEXICON).collect()
    return {r["entry"]: math.log(r["odds"]) for r in rows}


class Trees:
    """Boosted regression trees on binned features under the logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = math.log(rate / (1 - rate))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        binned, f = self._bins(x), np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            tree, leaf = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            f += RATE * tree[2][leaf]

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1) if len(x) else np.zeros((0, len(self.edges)), np.int64)

    def _grow(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[tuple, np.ndarray]:
        """A full tree of DEPTH levels: feature and bin by inner node, value by leaf; and each row's leaf."""
        feature, split, node = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, BINS, np.int64), np.zeros(len(g), np.int64)
        gain_of = lambda a, b: a * a / (b + 1.0)
        for level in range(DEPTH):
            n, first = 2**level, 2**level - 1
            best = np.full(n, 1e-9)
            for j in range(binned.shape[1]):
                key = node * (BINS + 1) + binned[:, j]
                gs, hs = (np.cumsum(np.bincount(key, w, n * (BINS + 1)).reshape(n, -1), 1) for w in (g, h))
                gain = gain_of(gs, hs) + gain_of(gs[:, -1:] - gs, hs[:, -1:] - hs) - gain_of(gs[:, -1:], hs[:, -1:])
                at = gain.argmax(1)
                top = gain[np.arange(n), at]
                better = top > best
                best[better] = top[better]
                feature[first : first + n][better], split[first : first + n][better] = j, at[better]
            node = node * 2 + (binned[np.arange(len(g)), feature[first + node]] > split[first + node])
        value = np.bincount(node, g, 2**DEPTH) / (np.bincount(node, h, 2**DEPTH) + 1.0)
        return (feature, split, value), node

    def __call__(self, x: np.ndarray) -> np.ndarray:
        binned, f, rows = self._bins(x), np.full(len(x), self.base), np.arange(len(x))
        for feature, split, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                k = 2**level - 1 + node
                node = node * 2 + (binned[rows, feature[k]] > split[k])
            f += RATE * value[node]
        return f


def isotonic(f: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (score, probability), nondecreasing, kept off 0 and 1."""
    order = np.argsort(f, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(f[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([v, 1.0, s, s])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            b = blocks.pop()
            blocks[-1] = [blocks[-1][0] + b[0], blocks[-1][1] + b[1], blocks[-1][2], b[3]]
    xs = np.array([x for b in blocks for x in (b[2], b[3])])
    ps = np.array([(b[0] + 0.01) / (b[1] + 0.02) for b in blocks for _ in range(2)])
    return xs, np.maximum.accumulate(ps)


class Model:
    """Scores of feature rows, 0 to 1."""

    def __init__(self, lexicon: dict[str, float], x: np.ndarray, y: np.ndarray, aside: np.ndarray):
        self.lexicon, self.trees = lexicon, None
        self.rate = float((y.sum() + 0.5) / (len(y) + 1))
        if len(y) and 0 < y.sum() < len(y):
            fit = ~aside if 0 < y[~aside].sum() < (~aside).sum() else np.ones(len(y), bool)
            self.trees = Trees(x[fit], y[fit])
            cal = aside if 0 < y[aside].sum() < aside.sum() else np.ones(len(y), bool)
            self.knots = isotonic(self.trees(x[cal]), y[cal])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.rate)
        f = self.trees(x)
        # The raw score adds a little so that rows of one calibrated step keep their order.
        return np.clip(np.interp(f, *self.knots) * 0.998 + 0.002 / (1 + np.exp(-f)), 0.0, 1.0)


def remainder(doc_id: str = "doc_id"):
    """crc32 of an id's text modulo 5; 0: held out. A null id is held out too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5, F.lit(0))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled rows that are not held out; of an id labelled twice, the larger label counts."""
    ship(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & (remainder() != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    aside = (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("aside")
    sample = scratch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id").select("text", "toxic", aside), "labelled")
    # Neither the lexicon nor the trees see the rows that the calibration is fitted on.
    lexicon = mine(sample.where("not aside"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Features(lexicon)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([of(t) for t in batch.column(0).to_pylist()], pa.list_(pa.float64())), batch.column(1), batch.column(2)], ["x", "toxic", "aside"])

    rows = sample.mapInArrow(features, "x array<double>, toxic int, aside boolean").collect()
    rows.sort()
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    return Model(lexicon, x, np.array([r["toxic"] for r in rows], float), np.array([r["aside"] for r in rows], bool))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for each row, of whole texts; null and empty texts get the score of no words.

    Repeated rows score alike, a null doc_id is held out, other columns play no part; no rows give
    no rows. Without labels of both kinds every row gets the share of label 1 (one half if there are none).
    """
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Features(held.value.lexicon)
        for batch in batches:
            x = np.array([of(t.as_py()) for t in batch.column(2)], float).reshape(batch.num_rows, len(FEATURES))
            s = held.value(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder() == 0).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
