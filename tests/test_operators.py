"""Operators on small cases with known answers, and against brute force."""

import datetime as dt
import itertools
import json
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidewatch.functions import overlay, privacy, responses, text, url, vector
from tidewatch.operators import graph, identity, series, similarity, tables, together
from tidewatch.sources import social
from tidewatch.sources import tables as io
from tidewatch.streaming import events as streams


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("v")).first()["v"]


def classify_plainly(p, vol, vel, eng, rec=0.0):
    if p <= -0.35 and vel >= 0.45 and (vol >= 7 or eng >= 5000):
        label, weight = "ALERT", 1.0
    elif p <= -0.10 and (vel >= 0.2 or vol >= 4):
        label, weight = "WARNING", 0.5 + 0.3 * (vel >= 0.2) + 0.2 * (vol >= 4)
    elif p >= 0.20 or (p >= -0.10 and eng >= 5000):
        label, weight = "FAVORABLE", 0.6 + 0.4 * (eng >= 5000)
    else:
        label, weight = "WARNING", 1.0
    e = min(math.log1p(eng) / math.log1p(50000), 1.0)
    conf = 0.55 / (1 + math.exp(-3 * (weight - 0.9))) + 0.45 * (0.45 * min(abs(p), 1) + 0.35 * min(max(vel, 0), 1) + 0.2 * e)
    if label == "FAVORABLE" and conf < 0.30 or label == "ALERT" and conf < 0.40:
        label = "WARNING"
    return label, conf, min(0.5 * max(-p, 0) + 0.3 * max(vel, 0) + 0.2 * e, 1.0)


def test_overlay(spark):
    cases = list(itertools.product([-0.9, -0.35, -0.2, -0.1, 0.0, 0.2, 0.8], [0, 4, 7], [0.0, 0.2, 0.45, 1.0], [0, 5000, 90000]))
    df = spark.createDataFrame(cases, "p double, vol long, vel double, eng long")
    for r in df.select("*", overlay.classify(F.col("p"), F.col("vol"), F.col("vel"), F.col("eng")).alias("c")).collect():
        label, conf, risk = classify_plainly(r.p, r.vol, r.vel, r.eng)
        assert r.c.label == label and r.c.confidence == pytest.approx(conf, abs=1e-4) and r.c.risk_score == pytest.approx(risk, abs=1e-4)
    assert len(overlay.Thresholds().version()) == 12 and overlay.Thresholds().version() != overlay.Thresholds(volume_spike=8).version()


@pytest.mark.parametrize(("raw", "clean"), [
    ("HTTP://Example.COM:80/A/b/?utm_source=x&b=2&a=1#top", "http://example.com/A/b?a=1&b=2"), ("https://example.com", "https://example.com/"), ("https://example.com:443/?ref=1", "https://example.com/"),
    ("https://example.com:8443/x//", "https://example.com:8443/x"), ("https://e.com/p?empty=&k=v", "https://e.com/p?k=v"),
])
def test_urls(spark, raw, clean):
    assert one(spark, url.canonical_url(F.col("u")), u=raw) == clean


def test_text(spark):
    body = "Uma frase com mais de trinta caracteres aqui.\nLeia também: outra\ncurta\n\n\n\nOutra  frase longa com mais  de trinta letras.​"
    assert one(spark, text.clean_text(F.col("t")), t=body) == "Uma frase com mais de trinta caracteres aqui.\n\nOutra frase longa com mais de trinta letras."
    assert one(spark, text.fold_accents(F.col("t")), t="São Gonçalo ÀÉ") == "sao goncalo ae"
    a, b = (one(spark, text.content_hash(F.col("a"), F.col("b")), a=x, b=y) for x, y in (("Título!", "Ação  rápida"), ("titulo", "acao rapida")))
    assert a == b
    assert one(spark, text.quick_relevance(F.col("t"), ["Natal", "Rio"], "RN"), t="Chuva em NATAL") is True
    assert one(spark, text.quick_relevance(F.col("t"), ["Natal", "Rio"], "RN"), t="o rn e o rio") is False
    topics = {"first": ("a1", "b1"), "second": ("c1", "d1")}
    got = one(spark, text.keyword_topic(F.col("t"), topics), t="a1 c1")
    assert (got.topic_id, got.topic_label) == (1, "first") and one(spark, text.keyword_topic(F.col("t"), topics), t="x").topic_id == -1


def test_redaction(spark):
    got = one(spark, privacy.redact(F.col("t")), t="mail a.b@c.com, 123.456.789-09, 12.345.678/0001-95, (84) 91234-5678, 00000000000")
    assert got.text == "mail [email], [cpf], [cnpj], [phone], 00000000000" and (got.n_email, got.n_cpf, got.n_cnpj, got.n_phone) == (1, 1, 1, 1)


def test_redaction_levels(spark):
    body = "a.b@c.com and a.b@c.com, 00000000000"
    tagged = lambda key: one(spark, privacy.redact(F.col("t"), "pseudonymized", key), t=body)
    first = tagged(b"k")
    tags = first.text.split(", ")[0].split(" and ")
    assert tags[0] == tags[1] and tags[0].startswith("[email:") and len(tags[0]) == 16 and first.n_email == 2 and first.text.endswith("00000000000")
    assert tagged(b"k").text == first.text != tagged(b"other").text
    assert one(spark, privacy.redact(F.col("t"), "dropped"), t=body).text == " and , 00000000000" and one(spark, privacy.redact(F.col("t"), "none"), t=body).text == body
    assert privacy.level_of(None) == "masked" and privacy.level_of("DROPPED") == "dropped"
    with pytest.raises(ValueError):
        privacy.level_of("other")
    with pytest.raises(ValueError):
        privacy.redact(F.col("t"), "pseudonymized")


def test_half_transpositions():
    assert identity.jaro_winkler_score("abcxxxxx", "bcaxxxxx") == pytest.approx(0.9375)


def test_blocks(spark):
    seen = lambda status, body: one(spark, responses.block_signals(F.col("s"), F.col("b")), s=status, b=body)
    assert seen(200, "Just a moment...").cloudflare and seen(403, "no").waf and not seen(200, "x" * 600).blocked and seen(200, "").empty_body


def test_vectors(spark):
    v = lambda *x: F.array(*[F.lit(float(i)) for i in x])
    assert one(spark, vector.cosine_similarity(v(1, 0), v(1, 1))) == pytest.approx(math.sqrt(0.5)) and one(spark, vector.cosine_distance(v(0, 0), v(1, 1))) == 1.0


def test_history(spark):
    old = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1), None, True), (2, "b", dt.date(2024, 1, 1), None, True), (3, "c", dt.date(2024, 1, 1), None, True), (2, "z", dt.date(2023, 1, 1), dt.date(2024, 1, 1), False)], "id long, role string, valid_from date, valid_to date, is_current boolean")
    seed = spark.createDataFrame([(1, "a"), (2, None), (4, "d")], "id long, role string")
    got = {(r.id, r.role, r.is_current) for r in tables.slowly_changing(old, seed, "id", ["role"], "2024-02-01").collect()}
    assert got == {(1, "a", True), (2, "b", False), (2, None, True), (3, "c", False), (4, "d", True), (2, "z", False)}
    again = tables.slowly_changing(tables.slowly_changing(old, seed, "id", ["role"], "2024-02-01"), seed, "id", ["role"], "2024-03-01")
    assert again.count() == 6


def test_conform_and_marks(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "a long, b string, c double")
    out = tables.conform(df, StructType([StructField("b", StringType()), StructField("new", LongType()), StructField("c", StringType())]))
    assert out.columns == ["b", "new", "c"] and tuple(out.first()) == ("x", None, "2.5")
    events = spark.range(10).select(F.timestamp_seconds("id").alias("ts"))
    none = events.where("false")
    assert tables.above_mark(events, "ts", none).count() == 9 and tables.above_mark(events, "ts", events.limit(5)).count() == 5


def brute_coactivation(events, hours, least):
    by_target = {}
    for a, t, ts in set(events):
        by_target.setdefault(t, []).append((ts, a))
    overlaps, targets = {}, {}
    for a, t, _ in events:
        targets.setdefault(a, set()).add(t)
    for t, rows in by_target.items():
        for end in {ts for ts, _ in rows}:
            first = {}
            for ts, a in sorted(rows):
                if end - hours * 3600 <= ts <= end:
                    first.setdefault(a, ts)
            for a, b in itertools.combinations(sorted(first), 2):
                overlaps.setdefault((a, b), set()).add((t, max(first[a], first[b])))
    return {k: (len(v), len(targets[k[0]] & targets[k[1]]) / len(targets[k[0]] | targets[k[1]])) for k, v in overlaps.items() if len(v) >= least}


def test_coactivation(spark):
    rng = random.Random(8)
    events = [(rng.choice("abcde"), rng.randint(0, 3), rng.randrange(0, 40) * 1800) for _ in range(150)]
    df = spark.createDataFrame(events, "author string, target long, s long").select("author", "target", F.timestamp_seconds("s").alias("ts"))
    got = {(r.author_a, r.author_b): (r.n_overlap, pytest.approx(r.jaccard)) for r in graph.coactivation(df, 3, 2).collect()}
    assert got == brute_coactivation(events, 3, 2)


def test_coactivation_deals_events_not_pairs(spark, monkeypatch):
    """Blocks of authors, few pairs at a time, sets without a table of bits: as by brute force, and no pair is shuffled."""
    rng = random.Random(9)
    events = [(rng.choice("abcdefghij"), rng.randint(0, 3), rng.randrange(0, 40) * 1800) for _ in range(400)]
    for name, value in (("LEAST_ROWS", 0), ("BLOCK_ROWS", 100)):
        monkeypatch.setattr(together, name, value)
    df = spark.createDataFrame(events, "author string, target long, s long").select("author", "target", F.timestamp_seconds("s").alias("ts"))
    pairs = graph.coactivation(df, 3, 2)
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    want = brute_coactivation(events, 3, 2)
    assert {(r.author_a, r.author_b): (r.n_overlap, pytest.approx(r.jaccard)) for r in pairs.collect()} == want
    monkeypatch.setattr(together, "TOGETHER", 7)
    monkeypatch.setattr(together, "BITS", 0)
    a, t, at = (np.array(c) for c in zip(*sorted({(ord(a) - 97, t, s) for a, t, s in events}), strict=True))
    sets, got = together.Sets(a, t), {}
    for x, y, n, _ in together.Near(a, t, at, np.ones(len(a), bool), 3 * 3600).pairs(both=False):
        both = sets.shared(x, y)
        share = both / (sets.sizes[x] + sets.sizes[y] - both)
        got |= {(chr(97 + i), chr(97 + j)): (k, pytest.approx(v)) for i, j, k, v in zip(x, y, n, share, strict=True) if k >= 2}
    assert got == want


def test_like_owners_follow_each_other(monkeypatch):
    """Pairs come by owners of like targets, so that files of them pack well: all of them, each once, with their targets."""
    rng = random.Random(4)
    kinds = [(1,), (2, 5), (1, 7), (2, 5, 6, 8)]
    rows = [(f"u{k:03}", t, k % 2 == 0) for k in range(80) for t in kinds[rng.randrange(4)]]
    rng.shuffle(rows)
    held = {}
    for a, t, _ in rows:
        held.setdefault(a, set()).add(t)
    want = {(a, b): sorted(held[a] & held[b]) for a, b in itertools.combinations(sorted(held), 2) if int(a[1:]) % 2 == 0 and held[a] & held[b]}
    batches = pa.table(dict(zip(("author", "target", "own", "block"), [*map(list, zip(*rows, strict=True)), [0] * len(rows)], strict=True))).to_batches(50)
    for together_at_once in (7, 1 << 16):
        monkeypatch.setattr(together, "TOGETHER", together_at_once)
        got = [r for b in together.shared_pairs([])(iter(batches)) for r in b.to_pylist()]
        assert len(got) == len(want) and {(r["author_a"], r["author_b"]): r["targets"] for r in got} == want
        assert all(r["n_shared"] == len(r["targets"]) for r in got)
        owners = [tuple(sorted(held[a])) for a, _ in itertools.groupby(r["author_a"] for r in got)]
        assert len(list(itertools.groupby(owners))) == len(set(owners)) == 4
    assert list(together.shared_pairs([])(iter(()))) == []


def test_communities(spark):
    cliques = [("a", "b"), ("a", "c"), ("b", "c"), ("x", "y"), ("y", "z"), ("x", "z"), ("p", "q")]
    pairs = spark.createDataFrame([("d", a, b, 5, 0.5) for a, b in cliques] + [("d", "c", "x", 1, 0.1)], "day string, author_a string, author_b string, n_overlap long, jaccard double")
    for algorithm in ("louvain", "label_propagation"):
        found = {}
        for r in graph.communities(pairs, algorithm=algorithm).collect():
            found.setdefault(r.community_id, set()).add(r.author)
        assert sorted(map(sorted, found.values())) == [["a", "b", "c"], ["x", "y", "z"]]


def test_communities_without_pairs(spark, monkeypatch):
    """From events: as from the shuffled pairs, by dictionaries and by arrays; the only exchange is that of events."""
    rng = random.Random(5)
    events = [(d, rng.randint(1, 40), rng.randint(0, 5), d * 86400 + rng.randrange(0, 80) * 900) for d in (0, 1) for _ in range(220)]
    df = spark.createDataFrame(events, "day long, author long, target long, s long").select("day", "author", "target", F.timestamp_seconds("s").alias("ts"))
    pairs = graph.coactivation(df, 3, 1, ("day",))
    show = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    for algorithm in ("louvain", "label_propagation"):
        found = graph.window_communities(df, 3, 1, algorithm=algorithm)
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hash") <= 1
        assert show(found.collect()) == show(graph.communities(pairs, algorithm=algorithm).collect()) and found.count()
        scores = graph.window_communities(df, 3, 1, algorithm=algorithm, scored=True)
        assert show(scores.collect()) == show(graph.community_scores(graph.communities(pairs, algorithm=algorithm).withColumn("author", F.col("author").cast("long")), graph.pair_scores(pairs)).collect())
    a, b, w = (np.array([rng.randrange(90) for _ in range(3000)]) for _ in range(3))
    g = together.Graph.of(90, a[a != b], b[a != b], w[a != b] + 1.0)
    by_arrays = together.louvain(g, 1.0, 42).tolist(), together.label_propagation(g).tolist()
    monkeypatch.setattr(together, "FEW", 10**9)
    assert by_arrays == (together.louvain(g, 1.0, 42).tolist(), together.label_propagation(g).tolist())


def test_louvain_counts_neighbours_once(monkeypatch):
    """After the first pass of a level a table says what a vertex has with each community; communities are the same without one, for weights of any size."""
    rng = np.random.default_rng(3)
    home = np.repeat(np.arange(12), 25)
    a, b = np.triu_indices(len(home), 1)
    there = rng.random(len(a)) < np.where(home[a] == home[b], 0.4, 0.06)
    for least in (1, 200, 70_000):
        g = together.Graph.of(len(home), a[there], b[there], rng.integers(least, least + 400, there.sum()).astype(float))
        monkeypatch.undo()
        scans, once = [], together._pass
        monkeypatch.setattr(together, "_pass", lambda graph, *rest: scans.append(len(graph)) or once(graph, *rest))
        found = together.louvain(g, 1.0, 42)
        assert len(scans) > 1 and len(set(scans)) == len(scans)
        monkeypatch.setattr(together, "COLUMNS", 0)
        assert found.tolist() == together.louvain(g, 1.0, 42).tolist() and len(set(scans)) < len(scans)
        monkeypatch.setattr(together, "TOGETHER", 50)
        assert found.tolist() == together.louvain(g, 1.0, 42).tolist()
        monkeypatch.setattr(together, "COLUMNS", 1 << 11)
        assert found.tolist() == together.louvain(g, 1.0, 42).tolist()


def test_overlaps_of_any_size():
    """Two authors that meet often: the graph's weights grow as they must."""
    for times in (3, 300, 70_000):
        at = np.arange(2 * times) * 10
        near = together.Near(np.tile([0, 1], times), np.zeros(2 * times, np.int64), at, np.ones(2 * times, bool), 15)
        graph, there = together.Graph.neighbours(near, 1)
        assert there.tolist() == [0, 1] and graph.near.tolist() == [1, 0]
        pairs = list(near.pairs(both=False))
        assert graph.weight.tolist() == 2 * [int(pairs[0][2][0])] and graph.weight[0] >= times


def _acts():
    """Events of two days as window_communities gets them, sorted by day, in small batches."""
    rng = random.Random(12)
    rows = sorted({(d, f"u{rng.randint(1, 60):02}", rng.randint(0, 90), rng.randrange(0, 80)) for d in (0, 1) for _ in range(400)})
    names = ("day", "author", "target", "at")
    return pa.table({n: pa.array(c) for n, c in zip(names, zip(*rows, strict=True), strict=True)}).to_batches(64), rows


def test_scores_from_one_look(monkeypatch):
    """A level's neighbours are counted once, and each pair inside a community is scored once, from its words of bits or from lists."""
    batches, rows = _acts()
    scans, pairs, once, shared = [], [], together._pass, together.Sets.shared
    monkeypatch.setattr(together, "_pass", lambda graph, *rest: scans.append(len(graph)) or once(graph, *rest))
    monkeypatch.setattr(together.Sets, "shared", lambda self, a, b: pairs.append(len(a)) or shared(self, a, b))

    def detect(g):
        scans.clear()
        found = together.louvain(g, 1.0, 42)
        assert len(set(scans)) == len(scans) > 1
        return found

    run = lambda score: [r for b in together.window_communities(["day"], 9, 1, detect, 1, score)(iter(batches)) for r in b.to_pylist()]
    got = run(graph._scores)
    inside = sum(r["pair_count"] for r in got)
    assert inside == sum(pairs) > 0
    home = {(r["day"], r["author"]): r["community_id"] for r in run(None)}
    for day in (0, 1):
        held = {}
        for (a, b), (n, j) in brute_coactivation([(a, t, s) for d, a, t, s in rows if d == day], 9 / 3600, 1).items():
            if home[day, a] == home[day, b]:
                held.setdefault(home[day, a], []).append((n, j))
        for r in got:
            if r["day"] == day:
                n = [min(n / 20, 1) for n, _ in held[r["community_id"]]]
                j = [j for _, j in held[r["community_id"]]]
                assert (r["pair_count"], r["avg_synchrony_score"], r["avg_alignment_score"]) == (len(n), pytest.approx(np.mean(n)), pytest.approx(np.mean(j)))
                assert r["composite_score"] == pytest.approx((np.mean(n) + np.mean(j)) / 2)
    monkeypatch.setattr(together, "BITS", 0)
    assert run(graph._scores) == got


def test_members_alone(monkeypatch):
    """Members without their community's figures: no pair is scored for them."""
    batches, _ = _acts()
    run = lambda **how: pa.Table.from_batches(together.window_communities(["day"], 9, 1, lambda g: together.louvain(g, 1.0, 42), 3, **how)(iter(batches)))
    want = run().select(["day", "community_id", "author"])
    monkeypatch.setattr(together.Sets, "shared", None)
    assert len(want) and run(plain=True).equals(want)


def test_tracking_in_parts(spark):
    """Members meet in Spark: a community goes to Python as a row, whatever its size."""
    rows = [(1, 0, f"a{k}") for k in range(6000)] + [(1, 1, "x"), (1, 1, "y")] + [(2, 3, f"a{k}") for k in range(1500, 6000)] + [(2, 4, f"a{k}") for k in range(1500)] + [(3, 0, "y"), (3, 0, "é")]
    out = graph.track(spark.createDataFrame(rows, "day long, community_id long, author string"), threshold=0.2)
    arrow = out._jdf.queryExecution().optimizedPlan().toString().split("FlatMapGroupsInPandas")[1].splitlines()[1]
    assert "author" not in arrow and "who" not in arrow
    got = {(r.day, r.community_id): (r.series_id, r.series_start, r.jaccard_to_previous, r.is_new) for r in out.collect()}
    first = graph.series_name([f"a{k}" for k in range(6000)])
    assert got[1, 0] == (first, 1, None, True) and got[2, 3] == (first, 1, 0.75, False)
    assert got[2, 4] == (graph.series_name([f"a{k}" for k in range(1500)]), 2, None, True)
    assert got[3, 0] == (graph.series_name(["y", "é"]), 3, None, True)


def test_tracking(spark):
    rows = [(1, 0, a) for a in "abcd"] + [(1, 1, a) for a in "xyz"] + [(3, 5, a) for a in "abce"] + [(3, 6, a) for a in "mno"]
    got = {(r.day, r.community_id): r for r in graph.track(spark.createDataFrame(rows, "day long, community_id long, author string")).collect()}
    assert got[3, 5].series_id == got[1, 0].series_id and got[3, 5].series_start == 1 and not got[3, 5].is_new and got[3, 6].is_new


def test_identity(spark):
    assert identity.jaro_winkler_score("martha", "marhta") == pytest.approx(0.9611, abs=1e-4) and identity.jaro_winkler_score("dixon", "dicksonx") == pytest.approx(0.8133, abs=1e-4)
    rows = [("f1", "facebook", "joaosilva", "João Silva"), ("x1", "x", "joaosilva_", "Joao Silva"), ("x2", "x", "fan01", "Fan"), ("f2", "facebook", "fan02", "Other"), ("t1", "tiktok", "maria", "Maria")]
    got = {r.author_key: r.persona_id for r in identity.personas(spark.createDataFrame(rows, "author_key string, platform string, handle string, display_name string")).collect()}
    assert set(got) == {"f1", "x1"} and got["f1"] == got["x1"]
    docs = spark.createDataFrame([(1, "O prefeito José da Silva e JOSE DA SILVA em Natal"), (2, None)], "id long, body string")
    names = spark.createDataFrame([("José da Silva", "jose", "person"), ("Natal", "natal", "city")], "name string, entity string, kind string")
    assert {(r.id, r.entity, r.first_at, r.n) for r in identity.gazetteer(docs, "id", F.col("body"), names).collect()} == {(1, "jose", 2, 2), (1, "natal", 10, 1)}


def test_bands(spark):
    rng = random.Random(3)
    a, b = ([(i, rng.randint(0, 2), rng.randrange(0, 30_000)) for i in range(60)] for _ in range(2))
    make = lambda rows, s: spark.createDataFrame(rows, f"id_{s} long, k long, s long").select(f"id_{s}", "k", F.timestamp_seconds("s").alias(f"ts_{s}"))
    got = {(r.id_a, r.id_b) for r in series.band_pairs(make(a, "a"), make(b, "b"), ["k"], "ts_a", "ts_b", 3600).collect()}
    assert got == {(i, j) for i, k, s in a for j, l, t in b if k == l and abs(s - t) <= 3600}


def test_social_posts(spark):
    lines = {
        "facebook": [{"postId": "1", "url": "u", "text": " hi ", "time": 1700000000000, "likes": 3, "pageName": "P"}, {"error": "not_available"}, {"postId": "2", "url": "u"}],
        "instagram": [{"username": "me", "isVerified": True, "latestPosts": [{"id": "9", "caption": "c", "timestamp": "2024-01-01T00:00:00Z", "url": "u"}]}, {"nothing": 1}],
        "tiktok": [{"noResults": True}, {"id": "7", "authorMeta": {"name": "n", "nickName": "N"}, "webVideoUrl": "u", "createTimeISO": "2024-01-01T00:00:00Z", "text": "t", "diggCount": 4}],
        "x": [{"id": "5", "text": "t", "created_at": "2024-01-01T00:00:00Z", "referenced_tweets": [{"type": "replied_to", "id": "4"}], "public_metrics": {"like_count": 2}, "user": {"username": "h"}}],
    }
    want = {"facebook": (["fb:1"], ["page_unavailable", "parse_error", "schema_drift"]), "instagram": (["ig:9"], ["non_post_item", "parse_error"]), "tiktok": (["tt:7"], ["non_post_item", "parse_error"]), "x": (["x:5"], ["parse_error"])}
    for platform, items in lines.items():
        raw = spark.createDataFrame([(json.dumps(i),) for i in items] + [("{broken",)], "raw string")
        posts, dead = social.parse(raw, platform)
        rows = posts.collect()
        assert ([r.post_id for r in rows], sorted(r.reason for r in dead.collect())) == want[platform]
        assert all(r.published_at is not None for r in rows)
    assert rows[0].is_reply and rows[0].parent_post_id == "x:4" and rows[0].url == "https://x.com/h/status/5"


def test_frontier(spark):
    empty = spark.createDataFrame([], io.FRONTIER)
    found = spark.createDataFrame([("a", "f", "t", dt.datetime(2024, 1, 1)), ("b", "f", "t", None), ("c", "f", "t", dt.datetime(2024, 1, 3)), ("a", "f", "t", None)], "url string, source_feed string, title string, published_at timestamp")
    queue = io.frontier_add(empty, found)
    assert queue.count() == 3 and io.frontier_add(queue, found).count() == 3
    claimed, after = io.frontier_claim(queue, "2024-01-05", 2)
    assert claimed.count() == 2 and {r.url for r in after.where("status = 'in_progress'").collect()} >= {"c"}
    assert io.frontier_reset_stale(after, "2024-01-06").where("status = 'pending'").count() == 3


def test_cooldowns(spark):
    rows = [("d", k, ok) for k, ok in enumerate([False, False, False, False, True, False])]
    got = [r.cooldown_seconds for r in io.cooldowns(spark.createDataFrame(rows, "domain string, at long, ok boolean")).orderBy("at").collect()]
    assert got == [0, 0, 900, 1800, 0, 0]


def test_streaming(spark, tmp_path):
    rows = [("h1", dt.datetime(2024, 1, 1, 1), 1, "rss", "t", 1.0), ("h1", dt.datetime(2024, 1, 1, 1), 1, "rss", "t", 1.0), ("h2", dt.datetime(2024, 1, 1, 2), 1, "rss", "t", 2.0)]
    df = spark.createDataFrame(rows, streams.MESSAGE)
    payload = df.select(F.base64(F.to_json(F.struct(*df.columns)).cast("binary")).alias("value")).union(spark.createDataFrame([("bm90IGpzb24=",)], "value string"))
    payload.write.parquet(f"{tmp_path}/in")
    source = streams.file_stream(spark, f"{tmp_path}/in", "value string")
    good, bad = streams.decode_messages(source)
    streams.upsert_stream(streams.deduplicated(good), f"{tmp_path}/out", f"{tmp_path}/cp", "content_hash").awaitTermination()
    assert {r.content_hash for r in streams.read_upserts(spark, f"{tmp_path}/out", "content_hash").collect()} == {"h1", "h2"}
    streams.upsert_stream(bad.withColumnRenamed("payload", "content_hash"), f"{tmp_path}/dlq", f"{tmp_path}/cp2", "content_hash").awaitTermination()
    assert streams.read_upserts(spark, f"{tmp_path}/dlq", "content_hash").count() == 1


def test_table_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 1)], "id long, p string, v long")
    io.write_partitions(df, f"{tmp_path}/t", "p", ("id",))
    io.write_partitions(df.where("p = 'b'").withColumn("v", F.lit(9).cast("long")), f"{tmp_path}/t", "p")
    assert {(r.id, r.v) for r in spark.read.parquet(f"{tmp_path}/t").collect()} == {(1, 1), (2, 1), (3, 9)}
    twice = df.where("id = 1").withColumn("v", F.explode(F.array(*[F.lit(v).cast("long") for v in (5, 7, 6)])))
    io.merge_table(twice, f"{tmp_path}/t", ["id"], f"{tmp_path}/t2", "v")
    assert spark.read.parquet(f"{tmp_path}/t2").where("id = 1").first()["v"] == 7
    io.save_mark(spark, f"{tmp_path}/marks", "p", "2024-01-01")
    assert io.read_mark(spark, f"{tmp_path}/marks", "p") == "2024-01-01" and io.read_mark(spark, f"{tmp_path}/marks", "q") is None
    assert io.cutoff("2023-01-01", "2024-06-01", "2024-01-01") == "2024-01-01"


def test_connected_long_paths(spark):
    """Labels that meet one edge at a time: a falling path, a shuffled one, a loop."""
    falling = [1, *range(41, 1, -1)]
    shuffled = random.Random(7).sample(range(100, 1100), 1000)
    edges = [*zip(falling[:-1], falling[1:], strict=True), *zip(shuffled[:-1], shuffled[1:], strict=True), (5000, 5000)]
    got = {r.id: r.component for r in graph.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(falling, 1), **dict.fromkeys(shuffled, 100), 5000: 5000}


def test_personas_of_one_name_and_many_numbers(spark):
    """A crowd that differs in its numbers only is not compared pair by pair; whoever may match in it still is."""
    rows = [(f"{p}{k}", p, f"user_{k:04d}", f"Name {k:04d}") for p in "ab" for k in range(3000 if p == "a" else 40)] + [("a-bare", "a", "user_", ""), ("b-near", "b", "user_x0007", "Other")]
    authors = spark.createDataFrame(rows, "author_key string, platform string, handle string, display_name string")
    got = {r.author_key: r.persona_id for r in identity.personas(authors).collect()}
    assert all(got[f"a{k}"] == got[f"b{k}"] for k in range(40))
    met = identity.persona_pairs(authors)
    plain = [(a, b) for a in rows for b in rows if a[1] < b[1] and (a[2].rstrip("0123456789") != b[2].rstrip("0123456789") or a[2] == b[2] or "user_" in (a[2], b[2]))]
    assert {(r.author_key_l, r.author_key_r) for r in met.collect()} == {(a[0], b[0]) for a, b in plain} and met.count() < 4000


def test_personas_content_bridge(spark):
    """Shared content links handles of similarity 0.60 to 0.90, enumerated ones too, and nothing less alike."""
    rows = [("f1", "facebook", "mariopaz", "", ["p", "q", "p"]), ("x1", "x", "pazmario", "", ["p", "q"]), ("f2", "facebook", "fan01", "", ["r"]), ("x2", "x", "fan02", "", ["r"]), ("f3", "facebook", "zzzz", "", ["q"]), ("f4", "facebook", "deeplake", "", [""]), ("x4", "x", "lakedeep", "", [""]), ("x5", "x", "bcdk", "", None)]
    hs = identity.jaro_winkler_score("mariopaz", "pazmario")
    assert 0.60 <= hs < 0.90
    got = {r.author_key: (r.persona_id, r.confidence) for r in identity.personas(spark.createDataFrame(rows, "author_key string, platform string, handle string, display_name string, content_hashes array<string>")).collect()}
    assert set(got) == {"f1", "x1", "f2", "x2"} and got["f1"] == got["x1"] != got["f2"] == got["x2"]
    assert got["f1"][1] == pytest.approx(hs + 0.2) and got["f2"][1] == pytest.approx(1.0)


def test_gazetteer_long_names(spark):
    docs = spark.createDataFrame([(1, "o Rio Grande do Norte de Cima fica longe"), (2, "Rio Grande do Norte de")], "id long, body string")
    names = spark.createDataFrame([("Rio Grande do Norte de Cima", "rgnc", "place")], "name string, entity string, kind string")
    assert [(r.id, r.entity, r.first_at, r.n) for r in identity.gazetteer(docs, "id", F.col("body"), names).collect()] == [(1, "rgnc", 1, 1)]


def test_people_by_tiers(spark):
    """Handle, whole name or alias, name token: the first that says anything, with what the context adds."""
    people = spark.createDataFrame(
        [(1, "Maria Silva", "mariasilva", "Natal", "ABC", ["Dona Maria"], "mayor", True), (2, "Ana Silva", "ana", "Caicó", "XYZ", [], "governor", False)],
        "person_id long, name string, handle string, city string, party string, aliases array<string>, role string, is_incumbent boolean",
    )
    rows = [
        (1, "@MariaSilva", "Ana Silva", ""), (2, None, "dona maria", ""), (3, None, "Maria Silva", "em natal"), (4, None, "Maria Silva", "em outro lugar"), (5, None, "Silva", "a prefeita de Natal, ABC, RN"), (6, None, "Silva", "sem contexto"),
        (7, None, "Maria Souza", "rn"), (8, None, "Ninguem", "natal"), (9, None, None, "natal"),
    ]
    got = {r.mention_id: (r.person_id, r.confidence, r.status, r.candidates) for r in identity.resolve_people(spark.createDataFrame(rows, "mention_id long, handle string, name string, context string"), people).collect()}
    assert got[1] == (1, 1.0, "IN_SCOPE", None) and got[2] == (1, 0.9, "IN_SCOPE", None) and got[3] == (1, 0.9, "IN_SCOPE", None)
    assert got[4] == (None, 0.55, "AMBIGUOUS", [1]) and got[5] == (1, 0.95, "IN_SCOPE", None) and got[6] == (None, 0.5, "AMBIGUOUS", [1, 2])
    assert got[7] == (None, 0.55, "AMBIGUOUS", [1]) and got[8] == got[9] == (None, 0.0, "OUT_OF_SCOPE", None)


def test_stores(spark, tmp_path):
    from tidewatch.sources import storage

    df = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id long, v string, at long")
    for scheme in ("parquet", "json", "orc"):
        store = storage.open_store(spark, f"{scheme}:{tmp_path}/{scheme}")
        store.append(df, "t")
        store.append(df.where("id = 1"), "t")
        assert store.read("t").count() == 3
        store.replace(df, "t")
        storage.merge_into(store, spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 1)], df.schema), "t", "u", ["id"], "at")
        assert {(r.id, r.v) for r in store.read("u").collect()} == {(1, "a"), (2, "d"), (3, "e")}
        storage.audit(store, spark.createDataFrame([("call", "x", "ok")], "kind string, subject string, status string"))
        assert store.read("audit").where("kind = 'call' and status = 'ok' and at is not null").count() == 1
    none = storage.open_store(spark, "none:")
    none.append(df, "t")
    assert none.read("t").count() == 0
    with pytest.raises(ValueError):
        storage.open_store(spark, "ftp:x")


def test_batches(spark):
    from tidewatch.operators import checks

    rules = [*checks.required("v"), checks.between("n", 0, 5), checks.covered("v", F.col("v") == "a", 0.9, rows=2), checks.spread("n", 0.1, rows=3), checks.agrees("same", F.col("n") == F.col("n"))]
    got = {r.check: (r.actual, r.status) for r in checks.batch_report(spark.createDataFrame([("a", 1), (" ", 9)], "v string, n long"), rules).collect()}
    assert got["v_present"] == (0.5, "FAIL") and got["n_range"] == (0.5, "FAIL") and got["v_coverage"] == (0.5, "WARN") and got["n_spread"][1] == "SKIP" and got["same"] == (0.0, "PASS")
    empty = checks.batch_report(spark.createDataFrame([], "v string, n long"), rules)
    assert {r.status for r in empty.collect()} == {"SKIP"} and checks.batch_status(empty).first().status == "PASS"


def test_extraction(spark):
    """Longest names first, offices as names, a recognizer's names beside the catalogue's."""
    docs = spark.createDataFrame([(1, "A prefeita de Natal falou no Rio Grande do Norte"), (2, "Norte e Sul"), (3, "nada"), (4, None)], "id long, body string")
    names = spark.createDataFrame([("Rio Grande do Norte", "rn", "state"), ("Norte", "norte", "word"), ("Natal", "natal", "city")], "name string, entity string, kind string")
    holders = spark.createDataFrame([("Maria", "mayor", "Natal")], "entity string, role string, place string")
    every = names.unionByName(identity.role_names(holders, {"mayor": ("prefeito", "prefeita")}))
    got = {r.id: r for r in identity.extract(docs, "id", F.col("body"), every, ["city", "state", "word"], ["city", "state"], ["ana"], F.when(F.col("id") == 3, F.array(F.lit("Ana"))).when(F.col("id") == 1, F.array(F.lit("MARIA")))).collect()}
    assert (got[1].city, got[1].state, got[1].word, got[1].persons, got[1].is_relevant) == ([], ["rn"], [], ["Maria"], True)
    assert (got[2].word, got[2].persons, got[2].is_relevant) == (["norte"], [], False)
    assert got[3].persons == ["Ana"] and got[3].is_relevant and not got[4].is_relevant and got[4].city == []


def test_cosine_clusters_by_blocks(spark, monkeypatch):
    """Several blocks, copies, empty and short vectors: components as of all pairs; a group of copies sends a link a member and block."""
    rng = np.random.default_rng(4)
    monkeypatch.setattr(similarity, "BLOCK", 20)
    rows = [(int(k % 2), k, v.tolist()) for k, v in enumerate(rng.normal(size=(90, 3)) * [1, 1, 3])]
    rows += [(2, k, [1.0, 2.0]) for k in range(100, 160)] + [(2, 160, [1.0, 2.0, 0.0]), (2, 161, None), (2, 162, [0.0, 0.0]), (None, 163, [1.0, 2.0])]
    got = {r.vec_id: (r.cluster, r.size) for r in similarity.cosine_clusters(spark.createDataFrame(rows, "label int, vec_id long, embedding array<double>"), "label", threshold=0.95).collect()}
    root = {k: k for _, k, _ in rows}

    def find(k):
        return k if root[k] == k else find(root[k])

    for (g, a, x), (h, b, y) in itertools.combinations(rows, 2):
        if g is not None and g == h and x and y and len(x) == len(y) and np.linalg.norm(x) * np.linalg.norm(y) > 0 and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
            one, two = sorted((find(a), find(b)))
            root[two] = one
    sizes = {}
    for k in root:
        sizes[find(k)] = sizes.get(find(k), 0) + 1
    assert got == {k: (find(k), sizes[find(k)]) if sizes[find(k)] >= 3 else (-1, 1) for k in root}
    v = spark.createDataFrame([r for r in rows if r[0] == 2], "g int, vec_id long, x array<double>")
    assert similarity._links(v, 0.95).count() < 4 * 120
