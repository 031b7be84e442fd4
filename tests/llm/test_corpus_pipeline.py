"""The corpus pipeline against plain versions of its stages, one on what the other kept, on a small fixture with odd rows."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import common, quality
from tidewatch.llm.queries import tokenizer
from tidewatch.llm.tokens import Encoder

from .test_llm_operators import LOWER, brute_components, brute_overlaps, grams_of, kneser_ney

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, component long, which string, lang_ string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    words = ["the", "house", "stands", "on", "a", "hill", "and", "looks", "over", "quiet", "fields", "to", "sea", "été", "日本"]
    say = lambda n: " ".join(rng.choices(words, k=n))
    good = [(k, say(40)) for k in range(1, 121)]
    items = [(1, " ".join(f"{w}{k}" for k, w in enumerate(rng.choices(words, k=18)))), (2, None), (3, "")]
    rows = [*good, (300, None), (301, ""), (None, good[3][1]), (None, None)]
    rows += [(400 + k, good[k][1].upper() if k % 2 else good[k][1]) for k in range(10)]  # copies
    rows += [(500 + k, " ".join([*good[20 + k][1].split()[:-1], "end"])) for k in range(6)]  # near copies
    rows += [(600 + k, f"{good[30][1]} {items[0][1]} {say(5)}") for k in range(2)]  # leaks
    rows += [(700 + k, "".join(rng.choices("XQ!%$#09", k=80))) for k in range(8)]  # junk
    rows += [(800, good[40][1]), (800, say(40)), (900, say(4000))]
    place = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(d, t, "en", "s", len(t or ""), "x", 1, "w", "z") for d, t in rows], SCHEMA).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(d, 1, 0) for d, _ in good] + [(700, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return place, rows, {d for d, _ in good}, items


def judged(spark, rows, trusted):
    back = {r.id for r in spark.range(1000).where(F.pmod(F.xxhash64("id"), F.lit(quality.HELD_BACK)) == 0).collect()}
    logp = kneser_ney([t for d, t in rows if d in trusted and d not in back])
    score = lambda t: math.exp(-sum(map(logp, grams_of(t))) / len(grams_of(t)))
    held = sorted(score(t) for d, t in rows if d in trusted and d in back)
    line = held[math.ceil(quality.QUANTILE * len(held)) - 1]
    return [(d, t) for d, t in rows if t and score(t) <= line * (1 + 1e-7)]


def distinct(rows):
    best = {}
    for d, t in rows:
        key = t.translate(LOWER)
        best[key] = max(best.get(key, (-1, None)), (d if d is not None else -1, t), key=lambda x: x[0])
    return [(d if d >= 0 else None, t) for d, t in best.values()]


def test_pipeline_against_plain_stages(spark, corpus):
    place, rows, trusted, items = corpus
    docs = common.documents(spark, place)
    columns, want = docs.columns, rows
    shown = lambda df: sorted((repr(r.doc_id), (r.text or "").translate(LOWER)) for r in df.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.scratch(stage(spark, docs, place), name)
        if name == "quality":
            want = judged(spark, want, trusted)
        elif name == "exact_dedup":
            want = distinct(want)
        elif name == "near_dedup":
            # Rows that share an id are told apart by what they say.
            number = {k: (d, t) for k, (d, t) in enumerate(sorted(((d, t) for d, t in want if d is not None), key=lambda x: (x[0], len(x[1]))))}
            least = brute_components([(k, t) for k, (_, t) in number.items()])
            want = [number[k] for k, (_, c, _) in least.items() if k == c] + [(d, t) for d, t in want if d is None]
        else:
            leaked = {d for d, _ in brute_overlaps(want, items)}
            want = [(d, t) for d, t in want if d not in leaked]
        assert docs.columns == columns
        assert shown(docs) == sorted((repr(d), (t or "").translate(LOWER)) for d, t in want), name
    gone = {d for d, _ in rows} - {d for d, _ in want}
    assert {300, 301, 600, 601, *range(700, 708)} <= gone and not gone & trusted - set(range(1, 11)) - set(range(20, 28)) - {4, 31, 41}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, place).collect()
    enc, sizes, seqs = Encoder(tokenizer()), collections.Counter(), collections.defaultdict(list)
    for r in packed:
        sizes[r.doc_id] += r.length
        seqs[r.sequence_id].append((r.offset, r.length))
    ids = collections.Counter()
    for d, t in want:
        ids[d] += len(enc.tokenizer.encode(t, add_special_tokens=False).ids) + 1
    assert sizes == ids
    for spans in seqs.values():
        at = np.cumsum([0, *[n for _, n in sorted(spans)]])
        assert [a for a, _ in sorted(spans)] == at[:-1].tolist() and at[-1] <= 1024


def test_pipeline_of_nothing(spark, corpus, tmp_path):
    place = corpus[0]
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{place}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
