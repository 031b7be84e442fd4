"""Near-duplicates by a chosen-path set similarity join over minwise tokens.

Independent trees branch the documents recursively: a node picks a few minwise coordinates from a
hash of its path, and a document goes to the child of each value it has there, so similar sets
keep choosing the same paths. Small nodes are compared exhaustively on sketches; what may be a
link is confirmed on the full shingle sets, and links make components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, components, release_memory, scratch, ship

WORDS, PERCENT = 5, 75
#: Independent trees, and coordinates that the root of each picks. Inner nodes pick one or two, as their hash says:
#: on average 1.5 of which a pair of similarity 0.75 agrees in three quarters. So it stays together in some branch
#: more often than it is parted, while a crowd that no branch separates grows by half a level instead of doubling.
#: Five trees miss one such pair in 10^6 that meets in a small root, and one in 1,400 that must go DEPTH levels down.
TREES, PICKS = 5, 2
#: A node of at most so many documents is compared exhaustively; deeper ones than DEPTH are compared in blocks.
SMALL, DEPTH = 192, 4
#: Of a node compared in blocks: documents apart from the leader that a task holds, and others that it meets at a time.
GUESTS, HOSTS = 512, 256
#: Coordinates of a sketch. Pairs whose sketches agree less than CUTOFF lie four deviations under the threshold.
COORDS, CUTOFF = 128, 0.6
#: Bytes of text hashed at a time.
SLICE = 1 << 18

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_BASE = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240229)
_A = _rng.integers(1, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, COORDS, dtype=np.uint64)
_powers = np.ones(1, np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each run of bytes that are not white space."""
    global _powers
    raw = np.frombuffer(body, np.uint8)
    gap = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    edge = np.diff(np.concatenate([[1], gap.astype(np.int8), [1]]))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    if len(_powers) < len(raw) + 1:
        _powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(len(raw), SLICE), _BASE)]))
    # A word's hash: its bytes at powers that count from the word's end, so places do not matter.
    longest = int((ends - starts).max())
    at = np.repeat(ends, ends - starts) - np.arange((ends - starts).sum()) - 1 + np.repeat(np.cumsum(ends - starts) - (ends - starts) - starts, ends - starts)
    assert longest < len(_powers)
    values = (raw[~gap].astype(np.uint64) + np.uint64(1)) * _powers[at]
    first = np.cumsum(ends - starts) - (ends - starts)
    return _mix(np.add.reduceat(values, first) + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    k = 0
    while k < len(texts):
        group, size = [], 0
        while k < len(texts) and (not group or size + len(texts[k]) < SLICE):
            group.append(texts[k])
            size += len(texts[k]) + 1
            k += 1
        hashes, starts = _word_hashes(b"\n".join(group).translate(_FOLD))
        bounds = np.searchsorted(starts, np.cumsum([0, *[len(t) + 1 for t in group]]))
        n = len(hashes) - WORDS + 1
        grams = hashes[: max(n, 0)].copy()
        for j in range(1, WORDS):
            grams = grams * _BASE + hashes[j : j + len(grams)]
        grams = _mix(grams)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= WORDS:
                yield np.unique(grams[a : b - WORDS + 1])
            elif b > a:
                whole = np.uint64(b - a)
                for h in hashes[a:b]:
                    whole = whole * _BASE + h
                yield _mix(np.array([whole]))
            else:
                yield np.empty(0, np.uint64)


def _minwise(s: np.ndarray) -> np.ndarray:
    least = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 2048):
        least = np.minimum(least, (_A[:, None] * s[None, a : a + 2048] + _B[:, None]).min(1))
    return least


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, fingerprint, sketch and the first nodes of each text; some rows at a time."""
    seeds = _mix(np.arange(1, TREES * PICKS + 1, dtype=np.uint64))
    with np.errstate(over="ignore"):
        for batch in (b.slice(a, 512) for b in batches for a in range(0, b.num_rows, 512)):
            n, fp1, fp2, sketch, roots = [], [], [], [], []
            for s in shingle_sets(_texts(batch.column(1))):
                least = _mix(_minwise(s))
                n.append(len(s))
                # Two sums of hashes of the members: equal for equal sets, and for others by chance only.
                fp1.append(int(_mix(s).sum(dtype=np.uint64)) - (1 << 63))
                fp2.append(int(_mix(s ^ _BASE).sum(dtype=np.uint64)) - (1 << 63))
                sketch.append(least.astype(np.uint16).tobytes())
                roots.append(_mix(least[: TREES * PICKS] ^ seeds).astype(np.int64) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()), pa.array(sketch, pa.binary()), pa.array(roots, pa.list_(pa.int64()))],
                ["doc_id", "which", "n", "fp1", "fp2", "sketch", "roots"],
            )
    release_memory()


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A node's documents go on to the children of the coordinates that its path picks."""
    with np.errstate(over="ignore"):
        for batch in batches:
            node = batch.column("node").to_numpy().astype(np.uint64)
            values = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, COORDS)
            rows = np.arange(len(node))
            first = _mix(node ^ _BASE) % np.uint64(COORDS)
            picks = [first, (first + np.uint64(1) + _mix(node + _BASE) % np.uint64(COORDS - 1)) % np.uint64(COORDS)]
            child = [_mix(_mix(node + p + np.uint64(1)) ^ (values[rows, p.astype(np.int64)].astype(np.uint64) + np.uint64(1)) * _BASE).astype(np.int64) for p in picks]
            two = (_mix(node ^ np.uint64(0xA5A5)) & np.uint64(1)) == 1
            # What is known of a document goes along, so no level asks for it again.
            for child_of, taken in ((child[0], batch), (child[1][two], batch.filter(pa.array(two)))):
                yield pa.RecordBatch.from_arrays([pa.array(child_of), *(taken.column(c) for c in ("rep", "n", "sketch"))], ["node", "rep", "n", "sketch"])


class _Rows:
    """Documents of one node: their numbers, components, sizes and sketches, and their full sets where they come along."""

    def __init__(self, batch: pa.RecordBatch):
        self.rep, self.n, self.comp = (batch.column(c).to_numpy() for c in ("rep", "n", "comp"))
        self.values = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, COORDS)
        if "members" in batch.schema.names:
            held = batch.column("members")
            self.flat, self.ends = held.values.to_numpy(), held.offsets.to_numpy()

    def members(self, k: int) -> np.ndarray:
        return self.flat[self.ends[k] : self.ends[k + 1]]

    def agreement(self, other: _Rows) -> np.ndarray:
        """Share of coordinates that agree, for pairs that may be links and are in different components; -1 for others."""
        agree = np.empty((len(self.rep), len(other.rep)), np.float32)
        step = max(1, (1 << 20) // (len(other.rep) * COORDS))
        for a in range(0, len(self.rep), step):
            agree[a : a + step] = (self.values[a : a + step, None, :] == other.values[None, :, :]).mean(2)
        near = 100 * np.minimum(self.n[:, None], other.n[None, :]) >= PERCENT * np.maximum(self.n[:, None], other.n[None, :])
        agree[(self.comp[:, None] == other.comp[None, :]) | ~near | (agree < CUTOFF)] = -1
        return agree


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(node, side, rows) of stretches of rows that are alike in both."""
    for batch in batches:
        node, side = batch.column("node").to_numpy(), batch.column("side").to_numpy()
        cuts = np.flatnonzero((np.diff(node) != 0) | (np.diff(side) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(node)], strict=True):
            if b > a:
                yield int(node[a]), int(side[a]), batch.slice(a, b - a)


def _whole(parts: list[pa.RecordBatch]) -> _Rows:
    return _Rows(pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0])


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64())], ["a", "b"])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node: a forest of the pairs of each node that agree most; it holds every document with a partner."""

    def grow(rows: _Rows) -> list[tuple[int, int]]:
        agree, out = rows.agreement(rows), []
        best, source, outside = np.full(len(agree), -1, np.float32), np.zeros(len(agree), np.int64), (agree >= 0).any(1)
        while outside.any():
            # The outside document that agrees most with an inside one.
            k = int(np.where(outside, best, -2).argmax())
            if best[k] >= 0:
                out.append((int(rows.rep[source[k]]), int(rows.rep[k])))
            outside[k] = False
            closer = agree[k] > best
            best[closer], source[closer] = agree[k][closer], k
        return out

    out: list[tuple[int, int]] = []
    current, held = None, []
    for node, _, part in _runs(batches):
        if node != current and held:
            out += grow(_whole(held))
            held = []
        current = node
        held.append(part)
        if len(out) > 20_000:
            yield _pairs(out)
            out = []
    if held:
        out += grow(_whole(held))
    yield _pairs(out)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and side: links between components, confirmed on the full sets, as few as join them.

    Documents of side 0 are compared with each other. Those of side 1 are held while those of side
    2 pass by, however many they are.
    """
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while (up := root.get(c, c)) != c:
            root[c] = root.get(up, up)
            c = up
        return c

    def compare(x: _Rows, y: _Rows) -> list[tuple[int, int]]:
        agree = x.agreement(y)
        i, j = np.nonzero(agree >= 0) if x is not y else np.nonzero(np.triu(agree >= 0, 1))
        order = np.argsort(-agree[i, j], kind="stable")
        out = []
        for k, m in zip(i[order].tolist(), j[order].tolist(), strict=True):
            a, b = find(int(x.comp[k])), find(int(y.comp[m]))
            if a == b:
                continue
            one, two = x.members(k), y.members(m)
            at = np.minimum(np.searchsorted(two, one), len(two) - 1)
            both = int((two[at] == one).sum())
            if 100 * both >= PERCENT * (len(one) + len(two) - both):
                root[max(a, b)] = min(a, b)
                out.append((int(x.rep[k]), int(y.rep[m])))
        return out

    current, held, rows = None, [], None
    for node, side, part in _runs(batches):
        if node != current:
            if held and rows is None:
                rows = _whole(held)
                yield _pairs(compare(rows, rows))
            current, held, rows = node, [], None
            root.clear()
        if side < 2:
            held.append(part)
        elif held:
            rows = rows or _whole(held)
            for a in range(0, part.num_rows, HOSTS):
                yield _pairs(compare(rows, _Rows(part.slice(a, HOSTS))))
    if held and rows is None:
        rows = _whole(held)
        yield _pairs(compare(rows, rows))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([np.sort(s.astype(np.int64)) for s in shingle_sets(_texts(part.column(1)))], pa.list_(pa.int64()))], ["rep", "members"])


def _sketched(docs: DataFrame) -> DataFrame:
    """A row for each document row: doc_id, which (the text's hash), n, fp1, fp2, sketch, roots."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("which"))
    return scratch(texts.mapInArrow(_sketch, "doc_id long, which long, n long, fp1 long, fp2 long, sketch binary, roots array<long>"), "sketches")


def _components(docs: DataFrame) -> DataFrame:
    """A row for each document row: doc_id, which, n, own (a number of the component's own), component (its smallest doc_id; null without doc_id)."""
    told = _sketched(docs)
    # Equal sets are one vertex; its number is unique, whatever ids its rows have.
    classes = told.where("n > 0 and doc_id is not null").groupBy("n", "fp1", "fp2").agg(F.min(F.struct("doc_id", "which")).alias("first"), F.first("sketch").alias("sketch"), F.first("roots").alias("roots"))
    classes = scratch(classes.select(F.monotonically_increasing_id().alias("rep"), "n", "fp1", "fp2", "first.doc_id", "first.which", "sketch", "roots"), "classes")
    leaf, crowd = _nodes(classes)

    # Round one: a forest in each node, and in each block of a crowded one, which its leader joins.
    rows = leaf.withColumn("side", F.lit(0))
    if crowd is not None:
        in_block = F.xxhash64("node", "block").alias("node")
        lead = crowd.where("rep = leader").select("rep", "n", "sketch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("at"), "node", "block").where("at != block")
        own = crowd.select(in_block, "rep", "n", "sketch", F.lit(0).alias("side")).unionByName(lead.select(F.xxhash64("node", "at").alias("node"), "rep", "n", "sketch", F.lit(0).alias("side")))
        rows = rows.unionByName(own)
    full = rows.select("node", "side", "rep", "n", F.col("rep").alias("comp"), "sketch")
    found = full.repartition("node").sortWithinPartitions("node").mapInArrow(_forest, "a long, b long")
    pairs = scratch(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    # A forest has all documents with a partner in their node; only those, and the crowded ones, are compared again.
    active = pairs.select(F.col("a").alias("rep")).union(pairs.select("b"))
    active = scratch((active if crowd is None else active.union(crowd.select("rep"))).distinct(), "active")
    at = F.xxhash64("doc_id", "which").alias("at")
    wanted = active.join(classes.select("rep", "doc_id", "which"), "rep").select(at, "rep")
    texts = docs.where("doc_id is not null").select(F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit("")))).alias("at"), "text")
    sets = scratch(texts.join(wanted, "at").dropDuplicates(["at", "rep"]).select("rep", "text").mapInArrow(_sets, "rep long, members array<long>"), "sets")
    links = _confirmed(pairs, sets)
    comps = components(links)

    # Round two: all pairs of what is still apart. Full sets come along, so only confirmed links leave a node.
    known = active.join(classes.select("rep", "n", "sketch"), "rep").join(comps.withColumnRenamed("id", "rep").withColumnRenamed("component", "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    known = scratch(known.join(sets, "rep"), "known")
    inside = scratch(leaf.select("node", "rep").join(known.select("rep", "comp"), "rep"), "inside")
    rows = inside.join(inside.groupBy("node").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("node"), "node", "left_semi").select("node", "rep", F.lit(0).alias("side"))
    if crowd is not None:
        inside = scratch(crowd.select("node", "rep").join(known.select("rep", "comp"), "rep"), "inside")
        # A node's home is the component that has most of it; what is not of it meets all of the node, which passes by so many of them at a time.
        home = inside.groupBy("node", "comp").agg(F.count("*").alias("size")).groupBy("node").agg(F.max(F.struct("size", "comp"))["comp"].alias("home"))
        apart = scratch(inside.join(home, "node").where("comp != home").select("node", "rep"), "apart")
        many = apart.groupBy("node").agg(F.ceil(F.count("*") / GUESTS).cast("long").alias("parts"))
        guests = apart.join(many, "node").select(F.xxhash64("node", F.pmod(F.xxhash64("rep", F.lit(1)), "parts")).alias("node"), "rep", F.lit(1).alias("side"))
        hosts = crowd.join(many, "node").select("node", "rep", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        rows = rows.unionByName(guests).unionByName(hosts.select(F.xxhash64("node", "part").alias("node"), "rep", F.lit(2).alias("side")))
    full = rows.join(known, "rep").select("node", "side", "rep", "n", "comp", "sketch", "members")
    more = scratch(full.repartition("node").sortWithinPartitions("node", "side").mapInArrow(_linked, "a long, b long").distinct(), "more")
    if not more.isEmpty():
        comps = components(links.union(more))
    named = classes.select("rep", "n", "fp1", "fp2", "doc_id").join(comps.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("least"))
    named = named.join(least, "component").select("n", "fp1", "fp2", F.col("component").alias("own"), F.col("least").alias("component"))
    joined = told.select("doc_id", "which", "n", "fp1", "fp2").join(named, ["n", "fp1", "fp2"], "left")
    return joined.select("doc_id", "which", "n", "own", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component"))


def _nodes(classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(node, rep, n, sketch) of the nodes to compare, and with leader, blocks and block of those that stayed large."""

    def told(rows: DataFrame) -> DataFrame:
        """With size and sketch: roots ask for them once they are known to be shared, and what branches off has them."""
        return rows if "sketch" in rows.columns else rows.join(classes.select("rep", "n", "sketch"), "rep").select("node", "rep", "n", "sketch")

    small, crowd = [], None
    members = classes.select(F.explode("roots").alias("node"), "rep")
    for depth in range(DEPTH):
        members = scratch(members, "members")
        nodes = scratch(members.groupBy("node").agg(F.count("*").alias("size"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("content"), F.min("rep").alias("leader")).where("size > 1"), "nodes")
        # Trees often come to the same documents: one node of each content is compared.
        leaves = nodes.where(F.col("size") <= SMALL).groupBy("content", "size").agg(F.min("node").alias("node"))
        small.append(told(members.join(leaves.select("node"), "node", "left_semi")))
        # Large nodes stay apart until the last level: each tree branches by picks of its own.
        large = nodes.where(F.col("size") > SMALL)
        if large.isEmpty():
            break
        if depth < DEPTH - 1:
            inside = told(members.join(large.select("node"), "node", "left_semi"))
            members = inside.mapInArrow(_branch, "node long, rep long, n long, sketch binary")
        else:
            last = large.groupBy("content", "size").agg(F.min("node").alias("node"), F.min("leader").alias("leader"))
            blocks = F.ceil(F.col("size") / (SMALL // 2)).cast("long")
            crowd = scratch(told(members.join(last, "node")).select("node", "rep", "n", "sketch", "leader", blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).alias("block")), "crowd")
    leaf = small[0]
    for more in small[1:]:
        leaf = leaf.unionByName(more)
    return scratch(leaf, "leaves"), crowd


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are as similar as a link asks; row by row, so that two sets are held at a time."""
    both = pairs.join(sets.select(F.col("rep").alias("b"), F.col("members").alias("y")), "b").join(sets.select(F.col("rep").alias("a"), F.col("members").alias("x")), "a")
    shared = both.select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), F.size(F.array_intersect("x", "y")).alias("shared"))
    return scratch(shared.where(100 * F.col("shared") >= PERCENT * (F.col("nx") + F.col("ny") - F.col("shared"))).select("a", "b"), "links")


def near_groups(docs: DataFrame) -> DataFrame:
    """Components of near-duplicate texts: doc_id, n_shingles, component_id, kept for each row.

    Two texts are linked if their sets of five-word shingles have a Jaccard similarity of 0.75 or
    more; shorter texts are one shingle, texts without words (null, empty) are linked with
    nothing. Rows that share a doc_id are judged each by its own text, and kept says that the
    doc_id is its component's; a row without doc_id is kept and has no component. Other columns
    play no part; no rows give no rows.
    """
    return _components(docs).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all columns: one text of each component, that of its smallest doc_id.

    Texts without words and rows without doc_id stay. Where that doc_id has several texts in the
    component, the one with the fewest shingles stays (ties by the text's hash); rows that repeat
    doc_id and text alike are one document.
    """
    rows = scratch(_components(docs), "rows")
    in_one = rows.where("n > 0 and component is not null")
    stay = in_one.groupBy("own").agg(F.min(F.struct("doc_id", "n", "which")).alias("s"))
    gone = in_one.join(stay.select("own", F.col("s.doc_id").alias("stay_id"), F.col("s.which").alias("stay_which")), "own").where("doc_id != stay_id or which != stay_which")
    gone = gone.select(F.col("doc_id").alias("gone_doc_id"), F.col("which").alias("gone_which")).distinct()
    which = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(gone, (docs["doc_id"].cast("long") == gone["gone_doc_id"]) & (which == gone["gone_which"]), "left_anti")


#: The same components in DuckDB's SQL: all pairs that share a shingle, counted, and reached step by step.
ORACLE = rf"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    p AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {WORDS - 1}, least(len(w), 1)))) AS k FROM d),
    s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[k + 1 : k + {WORDS}], ' ')) AS sh FROM p),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y USING (sh) WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= {PERCENT} * (x.n + y.n - shared)),
    u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r(id, low) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.id, u.b FROM r JOIN u ON u.a = r.low),
    m AS (SELECT id, min(low) AS component_id FROM r GROUP BY 1)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.id = d.doc_id"""
