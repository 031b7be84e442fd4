"""Co-activation graphs: pairs of authors, communities, their scores, and their identity over days."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..components import components, scratch
from . import together
from .series import _micros


def coactivation(events: DataFrame, window_hours: float = 24.0, min_overlap: int = 3, group: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of authors that act on the same targets within a window.

    ``events``: author, target, ts and group columns. In the window that ends at each event of a
    target, every author counts with the earliest time; a pair's anchor there is the later of the
    two. n_overlap: distinct (target, anchor); jaccard: over all targets of both authors. Events
    are dealt out to the tasks that own authors; pairs are complete there and not shuffled.
    """
    g = list(group)
    e = _acts(events, g)
    sizes = e.select(*g, "author", "target").distinct().groupBy(*g, "author").agg(F.count("*").cast("int").alias("size"))
    dealt = together.deal(e.join(sizes, [*g, "author"]), g)
    author = e.schema["author"].dataType.simpleString()
    schema = ", ".join([*_declared(e, g), f"author_a {author}, author_b {author}, n_overlap long, n_targets long, jaccard double"])
    return dealt.mapInArrow(together.window_pairs(g, int(window_hours * 3.6e9), min_overlap), schema)


def _acts(events: DataFrame, group: list[str]) -> DataFrame:
    """Distinct (group, author, target, at in microseconds) with nothing missing, as a table: it is counted before it is dealt out."""
    e = events.select(*group, "author", "target", _micros("ts").alias("at")).dropna().distinct()
    return scratch(e, "acts")


def _declared(df: DataFrame, columns: list[str]) -> list[str]:
    return [f"{c} {df.schema[c].dataType.simpleString()}" for c in columns]


def coactivation_daily(events: DataFrame, extent: bool = False) -> DataFrame:
    """The daily mart: pairs that share targets on a day, how many and which; with ``extent`` also first_at and last_at of all that the two did that day."""
    d = _days(events, extent)
    author, more = d.schema["author"].dataType.simpleString(), ["first_at", "last_at"] if extent else []
    schema = ", ".join([*_declared(d, ["day"]), f"author_a {author}, author_b {author}, n_shared long, targets array<{d.schema['target'].dataType.simpleString()}>", *_declared(d, more)])
    return together.deal(d, ["day"]).mapInArrow(together.shared_pairs(["day"], extent), schema)


def _days(events: DataFrame, extent: bool) -> DataFrame:
    d = events.select(F.col("ts").cast("date").alias("day"), "author", "target").dropna().distinct()
    if extent:
        ends = events.groupBy(F.col("ts").cast("date").alias("day"), "author").agg(F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))
        d = d.join(ends, ["day", "author"])
    return scratch(d, "days")


def daily_checks(events: DataFrame) -> DataFrame:
    """One row on the pairs of the daily mart, counted where they are found: n, and of these twice, sizes (n_shared is not the number of targets), disorder."""
    told = together.deal(_days(events, extent=False), ["day"]).mapInArrow(together.checked_pairs(["day"]), "n long, twice long, sizes long, disorder long")
    return told.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in told.columns])


def louvain(n: int, edges: list[tuple[int, int, float]], resolution: float = 1.0, seed: int = 42) -> np.ndarray:
    """Community of each of ``n`` vertices, by local moving and contraction until nothing gains."""
    return together.louvain(_graph(n, edges), resolution, seed)


def _graph(n: int, edges: list[tuple[int, int, float]]) -> together.Graph:
    a, b, w = (np.array([e[k] for e in edges], d) for k, d in ((0, np.int64), (1, np.int64), (2, np.float64)))
    return together.Graph.of(n, a, b, w)


def label_propagation(n: int, edges: list[tuple[int, int, float]], rounds: int = 100) -> np.ndarray:
    """Each vertex in turn takes its neighbours' heaviest label, the smallest of equals."""
    return together.label_propagation(_graph(n, edges), rounds)


MEMBER = "community_id long, author string"
COMMUNITY = f"{MEMBER}, community_size long, edge_count long, edge_density double, avg_co_post_count double, avg_jaccard double"


def communities(pairs: DataFrame, group: tuple[str, ...] = ("day",), algorithm: str = "louvain", resolution: float = 1.0, seed: int = 42, min_size: int = 3) -> DataFrame:
    """Communities of each group's graph (author_a, author_b, n_overlap, jaccard), a row for each member.

    A group is one day of one region: its graph is one task's. Ids go by size, then members, before
    small communities are left out, so they can have gaps.
    """
    g = list(group)
    schema = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in g) + ", " + COMMUNITY

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(pdf.author_a.astype(str)) | set(pdf.author_b.astype(str)))
        at = {a: k for k, a in enumerate(names)}
        edges = sorted((at[str(a)], at[str(b)], float(w), float(j)) for a, b, w, j in zip(pdf.author_a, pdf.author_b, pdf.n_overlap, pdf.jaccard, strict=True) if str(a) != str(b))
        plain = [e[:3] for e in edges]
        found = louvain(len(names), plain, resolution, seed) if algorithm == "louvain" else label_propagation(len(names), plain)
        inside: dict[int, list[tuple]] = {}
        for e in edges:
            if found[e[0]] == found[e[1]]:
                inside.setdefault(int(found[e[0]]), []).append(e)
        rows = []
        for cid, (c, who) in enumerate(together.ordered(names, found)):
            if len(who) < min_size:
                continue
            inner = inside.get(c, [])
            n = len(inner)
            stats = (len(who), n, n / (len(who) * (len(who) - 1) / 2), sum(e[2] for e in inner) / n if n else 0.0, sum(e[3] for e in inner) / n if n else 0.0)
            rows += [(*key, cid, a, *stats) for a in who]
        return pd.DataFrame(rows, columns=[*g, "community_id", "author", "community_size", "edge_count", "edge_density", "avg_co_post_count", "avg_jaccard"])

    return pairs.groupBy(*g).applyInPandas(run, schema)


def window_communities(events: DataFrame, window_hours: float = 24.0, min_overlap: int = 3, group: tuple[str, ...] = ("day",), algorithm: str = "louvain", resolution: float = 1.0, seed: int = 42, min_size: int = 3, scored: bool = False, plain: bool = False) -> DataFrame:
    """The communities of each group's co-activation pairs, which its task finds from the group's events: no pair leaves it.

    As ``communities`` of ``coactivation``; with ``scored`` as ``community_scores`` of both; with ``plain`` the members alone.
    """
    g = list(group)
    e = _acts(events.withColumn("author", F.col("author").cast("string")), g)
    tasks = e.select(*g).distinct().count()
    detect = (lambda graph: together.louvain(graph, resolution, seed)) if algorithm == "louvain" else together.label_propagation
    run = together.window_communities(g, int(window_hours * 3.6e9), min_overlap, detect, min_size, _scores if scored else None, plain)
    schema = ", ".join([*_declared(e, g), SCORED if scored else MEMBER if plain else COMMUNITY])
    return e.repartition(together.parts(tasks), *g).sortWithinPartitions(*g).mapInArrow(run, schema)


SCORED = "community_id long, pair_count long, avg_synchrony_score double, avg_alignment_score double, composite_score double"


def _scores(overlap: np.ndarray, jaccard: np.ndarray) -> dict[str, np.ndarray]:
    """``pair_scores`` on arrays."""
    sync = np.minimum(overlap / SYNC_CAP, 1.0)
    ws, wa, _ = WEIGHTS
    return {"synchrony_score": sync, "alignment_score": jaccard, "composite_score": (ws * sync + wa * jaccard) / (ws + wa)}


#: Overlap that counts as full synchrony; weights of synchrony, alignment and similarity.
SYNC_CAP, WEIGHTS = 20.0, (0.4, 0.4, 0.2)


def pair_scores(pairs: DataFrame, sync_cap: float = SYNC_CAP, weights: tuple[float, float, float] = WEIGHTS, similarity: str | None = None) -> DataFrame:
    """Synchrony, alignment and their weighted sum; without similarity the other weights share its part."""
    sync = F.least(F.col("n_overlap") / sync_cap, F.lit(1.0))
    ws, wa, wc = weights
    plain = (ws * sync + wa * F.col("jaccard")) / (ws + wa)
    score = plain if similarity is None else F.when(F.col(similarity).isNull(), plain).otherwise(ws * sync + wa * F.col("jaccard") + wc * F.col(similarity))
    return pairs.withColumns({"synchrony_score": sync, "alignment_score": F.col("jaccard"), "composite_score": score})


def community_scores(members: DataFrame, scored: DataFrame, group: tuple[str, ...] = ("day",)) -> DataFrame:
    """Mean pair scores inside each community."""
    g = list(group)
    m = members.select(*g, "community_id", "author")
    inside = scored.join(m.withColumnRenamed("author", "author_a"), [*g, "author_a"]).join(m.withColumnRenamed("author", "author_b"), [*g, "author_b", "community_id"])
    return inside.groupBy(*g, "community_id").agg(F.count("*").alias("pair_count"), F.avg("synchrony_score").alias("avg_synchrony_score"), F.avg("alignment_score").alias("avg_alignment_score"), F.avg("composite_score").alias("composite_score"))


def series_name(members: list[str]) -> str:
    return hashlib.sha1(json.dumps(sorted(members)).encode()).hexdigest()[:16]


def track(members: DataFrame, day: str = "day", region: str | None = None, threshold: float = 0.5) -> DataFrame:
    """Carry series ids from one available day to the next: pairs of communities match greedily by Jaccard, best first."""
    date = members.schema[day].dataType.simpleString()
    schema = f"{day} {date}, community_id long, series_id string, series_start {date}, jaccard_to_previous double, is_new boolean"
    keyed = members.select((F.col(region) if region else F.lit("")).alias("_region"), F.col(day).alias("_day"), "community_id", "author").distinct()
    # A row for each community, with what it shares with those of the day before; members stay in Spark.
    before = keyed.select("_region", "_day").distinct().withColumn("_before", F.lag("_day").over(Window.partitionBy("_region").orderBy("_day")))
    now = keyed.groupBy("_region", "_day", "community_id").agg(F.count("*").alias("size"), F.collect_list("author").alias("who")).withColumn("name", _names("who")).drop("who")
    sizes = keyed.groupBy("_region", "_day", "community_id").agg(F.count("*").alias("old_size")).withColumnsRenamed({"_day": "_before", "community_id": "old"})
    old = keyed.select("_region", F.col("_day").alias("_before"), F.col("community_id").alias("old"), "author")
    met = keyed.join(before.dropna(), ["_region", "_day"]).join(old, ["_region", "_before", "author"]).groupBy("_region", "_day", "_before", "community_id", "old").agg(F.count("*").alias("both"))
    shares = met.join(sizes, ["_region", "_before", "old"]).join(now.select("_region", "_day", "community_id", "size"), ["_region", "_day", "community_id"])
    shares = shares.withColumn("share", F.col("both") / (F.col("size") + F.col("old_size") - F.col("both"))).where(F.col("share") >= threshold)
    options = shares.groupBy("_region", "_day", "community_id").agg(F.collect_list(F.struct("old", "share")).alias("options"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, before = [], {}
        for d, today in sorted(pdf.groupby("_day"), key=lambda x: x[0]):
            today = today.sort_values("community_id")
            best = sorted((-o["share"], c, o["old"]) for c, held in zip(today.community_id, today.options, strict=True) if held is not None for o in held)
            matched: dict[int, tuple[int, float]] = {}
            taken: set[int] = set()
            for s, c, old in best:
                if c not in matched and old not in taken:
                    matched[c] = (old, -s)
                    taken.add(old)
            now = {}
            for c, name in zip(today.community_id, today["name"], strict=True):
                series, start, share, new = (*before[matched[c][0]], matched[c][1], False) if c in matched else (name, d, None, True)
                now[c] = (series, start)
                rows.append((d, c, series, start, share, new))
            before = now
        return pd.DataFrame(rows, columns=[day, "community_id", "series_id", "series_start", "jaccard_to_previous", "is_new"])

    return now.join(options, ["_region", "_day", "community_id"], "left").drop("size").groupBy("_region").applyInPandas(run, schema)


@F.pandas_udf(StringType())
def _names(members: pd.Series) -> pd.Series:
    return members.map(lambda who: series_name(list(who)))


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable. It goes on until nothing changes, and raises if that never comes."""
    pairs = scratch(edges.select(F.col(a).alias("a"), F.col(b).alias("b")), "pairs")
    found = components(pairs)
    # A vertex whose only edges are to itself is its own component.
    alone = pairs.where("a = b").select(F.col("a").alias("id")).distinct().join(found, "id", "left_anti")
    return found.unionByName(alone.withColumn("component", F.col("id")))
