"""Benchmark decontamination by spaced seeds.

Fixed masks ignore some token positions, so a seed still hits when words at those places were
substituted. Test and training seeds are joined by hash; around each hit the words along its
diagonal are compared, and a window in which most of them agree is an overlap. All of it is
DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch
from .licenses import WORD, words_of

#: Positions that a seed reads.
MASKS = ("111011", "1101011", "10110011")
#: Words of the longest seed for items too short for some mask: four in a row, or the whole item if it has fewer.
SHORT = 4
#: Words compared around a hit (fewer if the item is shorter) and the share that must agree.
WINDOW, SHARE = 16, 0.75
#: Rows of (doc_id, item_id, diagonal, item) and of ids that may be broadcast, some 30 MB each; more are joined by a shuffle.
BROADCAST_ROWS, BROADCAST_IDS = 50_000, 1_000_000
#: Rows of benchmark seeds that may be broadcast.
BROADCAST_SEEDS = 1_000_000


def _seeds(words: Column, masks: tuple[str, ...]) -> Column:
    """Array of (pos, seed) for every mask and every place where it fits; words: see ``_hashed``."""

    def of(k: int, mask: str) -> Column:
        reads = [j for j, c in enumerate(mask) if c == "1"]
        at = F.when(F.size(words) >= len(mask), F.sequence(F.lit(0), F.size(words) - len(mask))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.struct(i.alias("pos"), F.xxhash64(F.lit(k), *[F.get(words, i + j) for j in reads]).alias("seed")))

    return F.concat(*[of(len(mask), mask) for mask in masks])


def _once(value: Column) -> Column:
    """A value as a generated row, so that the optimizer does not move it into a loop over its elements."""
    return F.explode(F.array(value))


def _hashed(words: Column) -> Column:
    """A hash of each word, made once: each word stands in some fifteen seeds. Hits are compared word by word."""
    return _once(F.transform(words, lambda w: F.xxhash64(w)))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs of a document and a benchmark item that overlap: doc_id, item_id, first_word, n_same, n_compared, share.

    An overlap is a stretch of WINDOW words (all of an item that has fewer) along one diagonal, of
    which SHARE agree; first_word is where it starts in the document, the best one of a pair is
    returned, ties by the first. An item under four words must stand in the document as a whole;
    null texts, and items without words, match nothing.
    Rows that share a doc_id (null is one too) count as one document, repeated items as one. Other
    columns play no part; empty tables give no rows.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text")).alias("item")).where(F.size("item") > 0).dropDuplicates(["item_id", "item"])
    longest = max(map(len, MASKS))
    # Most benchmarks have no item as short as that; texts are cut into such seeds only where one does.
    lengths = sorted(r["n"] for r in items.where(F.size("item") < longest).select(F.least(F.size("item"), F.lit(SHORT)).alias("n")).distinct().collect())
    none = F.array().cast("array<struct<pos:int,seed:bigint>>")
    of_length = lambda n: (F.size("item") < longest) & (F.least(F.size("item"), F.lit(SHORT)) == n)
    seeds = F.concat(_seeds(F.col("h"), MASKS), *[F.when(of_length(n), _seeds(F.col("h"), ("1" * n,))).otherwise(none) for n in lengths])
    tests = items.select("item_id", "item", _hashed(F.col("item")).alias("h")).select("item_id", F.explode(seeds).alias("s")).select("item_id", F.col("s.pos").alias("tpos"), "s.seed")
    tests = scratch(tests, "seeds")
    masks = (*MASKS, *["1" * n for n in lengths])
    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _hashed(words_of(F.col("text"))).alias("h")).select("doc_id", F.explode(_seeds(F.col("h"), masks)).alias("s")).select("doc_id", F.col("s.pos").alias("pos"), "s.seed")
    small = tests.count() <= BROADCAST_SEEDS
    hits = train.join(F.broadcast(tests) if small else tests, "seed").select("doc_id", "item_id", (F.col("pos") - F.col("tpos")).alias("diagonal")).distinct()
    hits = scratch(hits, "hits")

    few = hits.count() <= BROADCAST_ROWS
    found = hits.join(F.broadcast(items) if small else items, "item_id")
    # Rows of hits are few beside the documents; a text is repeated only for its own diagonals.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    both = texts.alias("t").join((F.broadcast(found) if few else found).alias("f"), F.col("t.doc_id").eqNullSafe(F.col("f.doc_id"))).select("t.doc_id", "item_id", "diagonal", "item", _once(words_of(F.col("text"))).alias("w"))
    n, d = F.size("item"), F.col("diagonal")
    same = F.transform("item", lambda word, j: F.when((d + j >= 0) & (F.get("w", d + j) == word), 1).otherwise(0))
    window = F.least(F.lit(WINDOW), n)
    sums = F.transform(F.sequence(F.lit(0), n - window), lambda i: F.struct(F.aggregate(F.slice("same", i + 1, window), F.lit(0), lambda a, x: a + x).alias("n_same"), (-i).alias("at")))
    best = both.select("doc_id", "item_id", "diagonal", "item", _once(same).alias("same")).withColumn("best", F.array_max(sums)).withColumn("n_compared", window)
    best = best.where(F.col("best.n_same") >= F.ceil(SHARE * F.col("n_compared"))).select("doc_id", "item_id", F.struct("best.n_same", "n_compared", (-(F.greatest(d - F.col("best.at"), F.lit(0)))).alias("first")).alias("o"))
    return best.groupBy("doc_id", "item_id").agg(F.max("o").alias("o")).select("doc_id", "item_id", (-F.col("o.first")).cast("long").alias("first_word"), F.col("o.n_same").cast("long").alias("n_same"), F.col("o.n_compared").cast("long").alias("n_compared"), (F.col("o.n_same") / F.col("o.n_compared")).alias("share"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap with no benchmark item, with all their columns."""
    leaked = scratch(overlaps(docs, benchmark).select(F.col("doc_id").alias("leaked_doc_id")).distinct(), "leaked")
    few = leaked.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(leaked) if few else leaked, docs["doc_id"].cast("long").eqNullSafe(leaked["leaked_doc_id"]), "left_anti")


def _oracle() -> str:
    """The same search in DuckDB's SQL, by the seeds' words instead of their hashes."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}')"
    short = max(map(len, MASKS))

    def seeds(source: str, key: str) -> str:
        parts = []
        for mask in (*MASKS, *["1" * n for n in range(1, SHORT + 1)]):
            seed = " || ' ' || ".join(f"w[p + {j + 1}]" for j, c in enumerate(mask) if c == "1")
            only = "" if mask in MASKS or key != "item_id" else f" WHERE len(w) < {short} AND least(len(w), {SHORT}) = {len(mask)}"
            parts.append(f"SELECT {key}, p, '{mask} ' || {seed} AS seed FROM (SELECT {key}, w, unnest(range(0, len(w) - {len(mask) - 1})) AS p FROM {source}){only}")
        return " UNION ALL ".join(parts)

    return f"""
    WITH i AS (SELECT DISTINCT item_id, w FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0), d AS (SELECT doc_id, {words} AS w FROM documents),
    s AS ({seeds("i", "item_id")}), t AS ({seeds("d", "doc_id")}),
    h AS (SELECT DISTINCT doc_id, item_id, t.p - s.p AS diagonal FROM t JOIN s USING (seed)),
    m AS (SELECT h.doc_id, h.item_id, diagonal, least({WINDOW}, len(i.w)) AS n, list_transform(range(0, len(i.w)), lambda j: CASE WHEN diagonal + j >= 0 AND d.w[diagonal + j + 1] = i.w[j + 1] THEN 1 ELSE 0 END) AS same FROM h JOIN i USING (item_id) JOIN d USING (doc_id)),
    a AS (SELECT *, unnest(range(0, len(same) - n + 1)) AS off FROM m), c AS (SELECT *, list_sum(same[off + 1 : off + n]) AS n_same FROM a),
    b AS (SELECT *, greatest(diagonal + off, 0) AS first_word, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_same DESC, n DESC, greatest(diagonal + off, 0)) AS rn FROM c WHERE n_same >= ceil({SHARE} * n))
    SELECT doc_id, item_id, first_word::BIGINT AS first_word, n_same::BIGINT AS n_same, n::BIGINT AS n_compared, n_same / n::DOUBLE AS share FROM b WHERE rn = 1"""


ORACLE = _oracle()
