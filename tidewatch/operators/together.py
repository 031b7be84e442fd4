"""Pairs of authors that act together, found by the task that owns one of them: events are dealt out, pairs never are.

A group's authors are cut into blocks. A block's task gets the events at all targets of its
authors and finds each pair whose first author it owns, some owners at a time; so a pair is
complete where it is found, and what is shuffled grows with the events alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a group for each of its blocks, and blocks of a group at most: each event goes to so many tasks.
BLOCK_ROWS, BLOCKS, LEAST_ROWS, TASKS = 50_000, 16, 2_000, 8
#: Pairs of events looked at together (their arrays stay in a core's cache), and pairs of authors in a batch of results.
TOGETHER, OUT_ROWS = 1 << 16, 1 << 15
#: Bytes of a table of bits with a row an author and a bit a target; beyond that, sets are compared as sorted lists.
BITS = 1 << 28
_NEVER = -(1 << 62)


def deal(rows: DataFrame, group: list[str]) -> DataFrame:
    """Rows (group, author, target, ...) at each block that has an author at their target: with ``block`` and ``own``, dealt out and sorted by group and block."""
    n, groups = rows.count(), rows.select(*group).distinct().count() if group else 1
    blocks = 1 if n < LEAST_ROWS else max(1, min(BLOCKS, max(math.ceil(n / max(groups, 1) / BLOCK_ROWS), math.ceil(TASKS / max(groups, 1)))))
    home = F.pmod(F.xxhash64("author"), F.lit(blocks)).cast("int")
    if blocks == 1:
        dealt = rows.withColumns({"block": F.lit(0), "own": F.lit(True)})
    else:
        need = rows.select(*group, "target", home.alias("block")).distinct()
        dealt = rows.join(need, [*group, "target"]).withColumn("own", home == F.col("block"))
    return dealt.repartition(parts(blocks * groups), *group, "block").sortWithinPartitions(*group, "block")


def parts(tasks: int) -> int:
    """Partitions for so many keys, enough of them that few keys meet; by number, since merged ones would be one task's."""
    return max(1, min(4 * tasks, 2000))


def units(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[dict, pa.Table]]:
    """(key, rows) of each stretch of rows of one key."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = np.zeros(batch.num_rows - 1, bool)
        for c in keys:
            col = batch.column(c)
            cut |= pc.not_equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(cut) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            now = {c: batch.column(c)[a].as_py() for c in keys}
            if key is not None and now != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def ranks(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The distinct values in order, and each row's place among them."""
    coded = column.combine_chunks().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _spans(owner: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of rows sorted by owner: whole owners, with TOGETHER pairs of events or one owner."""
    edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]])) if len(owner) else np.zeros(1, np.int64)
    total = np.concatenate([[0], np.cumsum(size)])[edges]
    k = 0
    while k < len(edges) - 1:
        m = max(k + 1, int(np.searchsorted(total, total[k] + TOGETHER, "right")) - 1)
        yield int(edges[k]), int(edges[m])
        k = m


def _bits(most: int) -> int:
    return max(1, int(most).bit_length())


class Near:
    """Events of one unit: each author's neighbours within the window, with distinct (target, anchor) and targets counted.

    Two events of two authors meet in a window if neither author has an earlier event there. Of
    the windows that hold both, the last one leaves out most of what came before, so only the last
    end within reach of the earlier event matters.
    """

    def __init__(self, author: np.ndarray, target: np.ndarray, at: np.ndarray, own: np.ndarray, width: int):
        order = np.lexsort((author, at, target))
        self.a, t, at, own = author[order], target[order], at[order] - (at.min() if len(at) else 0), own[order]
        self.width = width
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (at[1:] != at[:-1])
        self.inst, self.target_of = (np.cumsum(new) - 1).astype(np.int32), t[new]
        # The author's event before, at the same target.
        chain = np.lexsort((at, t, self.a))
        self.before = np.full(len(t), _NEVER, np.int64)
        same = (self.a[chain][1:] == self.a[chain][:-1]) & (t[chain][1:] == t[chain][:-1])
        self.before[chain[1:][same]] = at[chain[:-1][same]]
        lo, hi = np.empty(len(t), np.int64), np.empty(len(t), np.int64)
        span = int(at.max()) + width + 1 if len(at) else 1
        if len(t) and (int(t[-1]) + 2) * span < 1 << 62:
            place = t.astype(np.int64) * span + at
            lo, hi = np.searchsorted(place, place - width, "left"), np.searchsorted(place, place + width, "right")
        else:
            edges = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1], [True]])) if len(t) else [0]
            for x, y in zip(edges[:-1], edges[1:], strict=True):
                lo[x:y], hi[x:y] = x + np.searchsorted(at[x:y], at[x:y] - width, "left"), x + np.searchsorted(at[x:y], at[x:y] + width, "right")
        self.end = at[hi - 1]
        rows = np.flatnonzero(own)
        self.rows = rows[np.argsort(self.a[rows], kind="stable")]
        self.lo, self.size = lo[self.rows], (hi - lo)[self.rows]

    def most(self) -> int:
        return int(self.size.sum())

    def pairs(self, both: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]:
        """(owner, other, n_overlap, n_targets) sorted by owner and other; with ``both`` all others and no n_targets, else larger others only."""
        if not len(self.rows):
            return
        for_inst, for_other = _bits(self.inst[-1]), _bits(self.a.max())
        for x, y in _spans(self.a[self.rows], self.size):
            first, parts = int(self.a[self.rows[x]]), []
            if for_inst + for_other + _bits(int(self.a[self.rows[y - 1]]) - first) > 63:
                raise OverflowError("too many authors and instants in one block")
            step, k = np.cumsum(self.size[x:y]), 0
            while k < y - x:
                m = max(k + 1, int(np.searchsorted(step, (step[k - 1] if k else 0) + TOGETHER, "right")))
                e, size = self.rows[x + k : x + m], self.size[x + k : x + m]
                mine, other = np.repeat(e, size), _ranges(self.lo[x + k : x + m], size)
                who, whom = np.repeat(self.a[e], size), self.a.take(other)
                keep = whom != who if both else whom > who
                keep &= np.maximum(np.repeat(self.before[e], size), self.before.take(other)) + self.width < self.end.take(np.minimum(mine, other))
                keep = np.flatnonzero(keep)
                key = who.take(keep).astype(np.int64)
                key -= first
                key <<= for_other
                key |= whom.take(keep)
                key <<= for_inst
                key |= self.inst.take(np.maximum(mine, other).take(keep))
                key.sort()
                parts.append(key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key)
                k = m
            key = parts[0]
            if len(parts) > 1:
                key = np.unique(np.concatenate(parts))
            if not len(key):
                continue
            pair, targets = key >> for_inst, None
            fresh = np.concatenate([[True], pair[1:] != pair[:-1]])
            at = np.flatnonzero(fresh)
            if not both:
                target = self.target_of.take(key & ((1 << for_inst) - 1))
                fresh[1:] |= target[1:] != target[:-1]
                targets = np.add.reduceat(fresh.astype(np.int64), at)
            pair = pair.take(at)
            yield (pair >> for_other) + first, pair & ((1 << for_other) - 1), np.diff(np.append(at, len(key))), targets


class Sets:
    """Each author's targets: how many two authors share."""

    def __init__(self, author: np.ndarray, target: np.ndarray):
        n, m = (int(c.max()) + 1 if len(c) else 0 for c in (author, target))
        self.bits = None
        self.step = max(m, 1)
        held = np.unique(author.astype(np.int64) * self.step + target)
        self.sizes = np.bincount(held // self.step, minlength=n)
        if n * -(-m // 64) * 8 <= BITS:
            self.bits = np.zeros((max(1, -(-m // 64)), n), np.uint64)
            np.bitwise_or.at(self.bits, (held % self.step // 64, held // self.step), np.uint64(1) << (held % self.step % 64).astype(np.uint64))
        else:
            self.held, self.first = held, np.concatenate([[0], np.cumsum(self.sizes)])

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.bits is not None:
            out = np.zeros(len(a), np.int64)
            for word in self.bits:
                out += np.bitwise_count(word.take(a) & word.take(b))
            return out
        less = self.sizes[a] <= self.sizes[b]
        a, b = np.where(less, a, b), np.where(less, b, a)
        out, ends, k = np.zeros(len(a), np.int64), np.cumsum(self.sizes[a]), 0
        while k < len(a):
            m = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + TOGETHER, "right")))
            size = self.sizes[a[k:m]]
            want = np.repeat(b[k:m], size) * self.step + self.held[_ranges(self.first[a[k:m]], size)] % self.step
            at = np.minimum(np.searchsorted(self.held, want), len(self.held) - 1)
            out[k:m] = np.bincount(np.repeat(np.arange(m - k), size)[self.held[at] == want], minlength=m - k)
            k = m
        return out


def _of_key(key: dict, group: list[str], schema: pa.Schema, n: int) -> list[pa.Array]:
    return [pa.repeat(pa.scalar(key[c], schema.field(c).type), n) for c in group]


def window_pairs(group: list[str], width: int, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows (group, author, target, at, size, block, own): pairs of authors within the window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in units(batches, [*group, "block"]):
            schema = rows.schema
            (authors, a), (_, t) = ranks(rows["author"]), ranks(rows["target"])
            at, own = rows["at"].to_numpy(), rows["own"].to_numpy()
            size = np.zeros(len(authors), np.int64)
            size[a] = rows["size"].to_numpy()
            del rows
            sets, near = Sets(a, t), Near(a, t, at, own, width)
            del a, t, at, own
            for found in near.pairs(both=False):
                for k in range(0, len(found[0]), OUT_ROWS):
                    x, y, n, m = (c[k : k + OUT_ROWS][found[2][k : k + OUT_ROWS] >= least] for c in found)
                    both = sets.shared(x, y)
                    cols = [*_of_key(key, group, schema, len(x)), authors.take(pa.array(x)), authors.take(pa.array(y)), pa.array(n), pa.array(m), pa.array(both / (size[x] + size[y] - both))]
                    yield pa.RecordBatch.from_arrays(cols, [*group, "author_a", "author_b", "n_overlap", "n_targets", "jaccard"])

    return run


def _alike(author: np.ndarray, target: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A place for each of ``n`` authors that has a row, and the authors by place: those of the same first targets are next to each other."""
    order = np.lexsort((target, author))
    target = target[order]
    who, at, size = np.unique(author[order], return_index=True, return_counts=True)
    first, second, third = (np.where(size > k, target[np.minimum(at + k, len(target) - 1)], -1) for k in range(3))
    who = who[np.lexsort((who, third, second, first))]
    place = np.zeros(n, np.int64)
    place[who] = np.arange(len(who))
    return place, who


def shared_pairs(group: list[str], extent: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For distinct rows (group, author, target, block, own): pairs that share targets, how many and which; with ``extent`` also the authors' first and last instants (columns first_at, last_at).

    Owners with like targets follow each other: they meet the same authors, and files of these rows repeat themselves, so they pack well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in units(batches, [*group, "block"]):
            schema = rows.schema
            (authors, a), (targets, t) = ranks(rows["author"]), ranks(rows["target"])
            order = np.lexsort((a, t))
            ends = {}
            for c in ("first_at", "last_at") if extent else ():
                ends[c] = np.zeros(len(authors), np.int64)
                ends[c][a] = rows[c].cast(pa.int64()).to_numpy()
            own = rows["own"].to_numpy()[order]
            del rows
            a, t = a[order], t[order]
            mine = np.flatnonzero(own)
            place, who = _alike(a[mine], t[mine], len(authors))
            mine = mine[np.argsort(place[a[mine]], kind="stable")]
            # At each target the owner meets the authors that come after it.
            size = np.searchsorted(t, t[mine], "right") - mine - 1
            for_target, for_other = _bits(len(targets)), _bits(len(authors))
            for x, y in _spans(place[a[mine]], size):
                first = int(place[a[mine[x]]])
                if for_target + for_other + _bits(int(place[a[mine[y - 1]]]) - first) > 63:
                    raise OverflowError("too many authors and targets in one block")
                one, other = np.repeat(mine[x:y], size[x:y]), _ranges(mine[x:y] + 1, size[x:y])
                found = (((place[a[one]] - first) << for_other) | a[other]) << for_target | t[one]
                found.sort()
                pair = found >> for_target
                at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.zeros(0, np.int64)
                stops = np.append(at, len(pair))
                for k in range(0, len(at), OUT_ROWS):
                    m = min(k + OUT_ROWS, len(at))
                    p, q = who[(pair[at[k:m]] >> for_other) + first], pair[at[k:m]] & ((1 << for_other) - 1)
                    which = targets.take(pa.array(found[stops[k] : stops[m]] & ((1 << for_target) - 1)))
                    held = pa.ListArray.from_arrays(pa.array((stops[k : m + 1] - stops[k]).astype(np.int32)), which)
                    cols = [*_of_key(key, group, schema, m - k), authors.take(pa.array(p)), authors.take(pa.array(q)), pa.array(np.diff(stops[k : m + 1])), held]
                    names = [*group, "author_a", "author_b", "n_shared", "targets"]
                    if extent:
                        cols += [pa.array(f(ends[c][p], ends[c][q])).cast(schema.field(c).type) for c, f in (("first_at", np.minimum), ("last_at", np.maximum))]
                        names += list(ends)
                    yield pa.RecordBatch.from_arrays(cols, names)

    return run


def checked_pairs(group: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For the rows of ``shared_pairs``: a row a task with the number of pairs, and of those found twice, out of order or with a wrong n_shared."""
    find, keys = shared_pairs(group), [*group, "author_a", "author_b"]
    count = lambda flags: int(pc.sum(flags).as_py() or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, twice, order, sizes = 0, 0, 0, 0
        last, again = None, False
        for batch in find(batches):
            a, b = batch.column("author_a"), batch.column("author_b")
            n += batch.num_rows
            order += count(pc.greater_equal(a, b))
            sizes += count(pc.not_equal(batch.column("n_shared"), pc.cast(pc.list_value_length(batch.column("targets")), pa.int64())))
            # A pair found twice is next to itself: the first repetition counts.
            same = np.ones(batch.num_rows, bool)
            for c in keys:
                col = batch.column(c)
                same[1:] &= pc.equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
            same[0] = last == [batch.column(c)[0].as_py() for c in keys]
            twice += int((same & ~np.concatenate([[again], same[:-1]])).sum())
            last, again = [batch.column(c)[-1].as_py() for c in keys], bool(same[-1])
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (n, twice, sizes, order)], ["n", "twice", "sizes", "disorder"])

    return run


class Graph:
    """Both directions of each edge by vertex: the neighbours of v and the weights are at ptr[v] to ptr[v + 1]."""

    def __init__(self, ptr: np.ndarray, near: np.ndarray, weight: np.ndarray):
        self.ptr, self.near, self.weight = ptr, near, weight

    @classmethod
    def of(cls, n: int, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> Graph:
        one, two = np.concatenate([a, b]).astype(np.int32), np.concatenate([b, a]).astype(np.int32)
        order = np.argsort(one, kind="stable")
        return cls(np.concatenate([[0], np.cumsum(np.bincount(one, minlength=n))]), two[order], np.concatenate([w, w])[order])

    @classmethod
    def neighbours(cls, near: Near, least: int) -> tuple[Graph, np.ndarray]:
        """The graph of authors that have a pair, by n_overlap, and their codes."""
        n = int(near.a.max()) + 1
        # Room for all pairs of events; what is not filled takes no memory.
        other, weight, degree, k = np.empty(near.most(), np.int32), np.empty(near.most(), np.uint8), np.zeros(n, np.int64), 0
        for x, y, w, _ in near.pairs(both=True):
            keep = w >= least
            x, y, w = x[keep], y[keep], w[keep]
            while len(w) and int(w.max()) > np.iinfo(weight.dtype).max:
                wider = np.empty(len(weight), f"u{2 * weight.itemsize}")
                wider[:k] = weight[:k]
                weight = wider
            other[k : k + len(y)], weight[k : k + len(y)] = y, w
            k += len(y)
            if len(x):
                degree[x[0] : x[-1] + 1] += np.bincount(x - x[0])
        there = np.flatnonzero(degree)
        code = np.zeros(n, np.int32)
        code[there] = np.arange(len(there), dtype=np.int32)
        for a in range(0, k, TOGETHER):
            other[a : min(a + TOGETHER, k)] = code[other[a : min(a + TOGETHER, k)]]
        return cls(np.concatenate([[0], np.cumsum(degree[there])]), other[:k], weight[:k]), there

    def __len__(self) -> int:
        return len(self.ptr) - 1

    def stretches(self) -> Iterator[tuple[int, int]]:
        """First vertex and end of some vertices at a time."""
        a = 0
        while a < len(self):
            b = max(a + 1, int(np.searchsorted(self.ptr, self.ptr[a] + TOGETHER, "right")) - 1)
            yield a, b
            a = b

    def entries(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(vertex, neighbour, weight) some vertices at a time."""
        for a, b in self.stretches():
            x, y = self.ptr[a], self.ptr[b]
            yield np.repeat(np.arange(a, b), np.diff(self.ptr[a : b + 1])), self.near[x:y], self.weight[x:y].astype(np.float64)

    def strength(self) -> np.ndarray:
        """The sum of each vertex's weights."""
        out = np.zeros(len(self))
        for a, b in self.stretches():
            x, y = self.ptr[a], self.ptr[b]
            there = np.flatnonzero(np.diff(self.ptr[a : b + 1]))
            if len(there):
                out[a + there] = np.add.reduceat(self.weight[x:y].astype(np.float64), self.ptr[a + there] - x)
        return out

    def whole(self) -> bool:
        """All weights are whole numbers above 0."""
        w = self.weight
        return bool(not len(w) or w.min() > 0 and (w.dtype.kind in "iu" or (w == np.floor(w)).all()))


#: Vertices of fewer neighbours are counted by a dictionary, others by arrays.
FEW = 64
#: Numbers and columns of a table with a row a vertex and a column a community; beyond that, vertices are counted from their neighbours each time.
CELLS, COLUMNS = 1 << 26, 1 << 11


def louvain(graph: Graph, resolution: float, seed: int) -> np.ndarray:
    """Community of each vertex, by local moving and contraction until nothing gains.

    The first pass leaves few communities: from then on a table holds what each vertex has with
    each of them, and only moves change it.
    """
    rng = np.random.default_rng(seed)
    member, loops = np.arange(len(graph)), np.zeros(len(graph))
    degree = graph.strength()
    total = float(degree.sum()) / 2
    while total > 0:
        k = len(graph)
        held, comm, table = degree.copy(), np.arange(k), None
        moved_any = moved = _pass(graph, rng.permutation(k), comm, held, degree, resolution, total)
        while moved:
            table = table or _Table.of(graph, comm, held, degree)
            order = rng.permutation(k)
            moved = table.walk(order, resolution, total) if table else _pass(graph, order, comm, held, degree, resolution, total)
        if not moved_any:
            break
        if table:
            comm, links = table.contracted()
            n = len(links)
            inner = np.bincount(comm, loops, minlength=n) + links.diagonal() / 2
            np.fill_diagonal(links, 0)
            x, y = np.nonzero(links)
            ptr, near, sums = np.searchsorted(x, np.arange(n + 1)), y.astype(np.int32), links[x, y]
            del table, links
        else:
            names, comm = np.unique(comm, return_inverse=True)
            n = len(names)
            inner, keys, sums = _contract(graph, comm, n)
            inner += np.bincount(comm, loops, minlength=n)
            ptr, near = np.searchsorted(keys, np.arange(n + 1) * n), (keys % n).astype(np.int32)
        member, graph, loops = comm[member], Graph(ptr, near, sums), inner
        degree = 2 * loops + graph.strength()
    return member


def _pass(graph: Graph, order: np.ndarray, comm: np.ndarray, held: np.ndarray, degree: np.ndarray, resolution: float, total: float) -> bool:
    """Each vertex in order goes to the community of the best gain, the smallest of equals; ``comm`` and ``held`` change."""
    ptr, near, weights, degree = graph.ptr.tolist(), graph.near, graph.weight, degree.tolist()
    tally, moved = np.zeros(len(graph)), False
    for i in order.tolist():
        a, b, own, pull = ptr[i], ptr[i + 1], int(comm[i]), resolution * degree[i]
        held[own] -= degree[i]
        c = comm.take(near[a:b])
        if b - a < FEW:
            links = {own: 0.0}
            for j, w in zip(c.tolist(), weights[a:b].tolist(), strict=True):
                links[j] = links.get(j, 0.0) + w
            gain = {j: w - pull * float(held[j]) / (2 * total) for j, w in links.items()}
            best = min(gain, key=lambda j: (-gain[j], j != own, j))
            if gain[best] <= gain[own] + 1e-12:
                best = own
        else:
            np.add.at(tally, c, weights[a:b].astype(np.float64))
            gains = held.take(c)
            gains *= pull
            gains /= 2 * total
            np.subtract(tally.take(c), gains, out=gains)
            most = gains.max()
            best = own if most <= tally[own] - pull * float(held[own]) / (2 * total) + 1e-12 else int(c.take(np.flatnonzero(gains == most)).min())
            tally[c] = 0.0
        held[best] += degree[i]
        if best != own:
            comm[i], moved = best, True
    return moved


class _Table:
    """What each vertex has with each community, in whole numbers, so that sums do not depend on their order."""

    def __init__(self, graph: Graph, links: np.ndarray, comm: np.ndarray, held: np.ndarray, degree: np.ndarray):
        self.graph, self.links, self.comm, self.held, self.degree = graph, links, comm, held, degree

    @classmethod
    def of(cls, graph: Graph, comm: np.ndarray, held: np.ndarray, degree: np.ndarray) -> _Table | None:
        """None where the table is too large or weights are not whole."""
        names, comm = np.unique(comm, return_inverse=True)
        k, m = len(graph), len(names)
        if m > COLUMNS or k * m > CELLS or not graph.whole():
            return None
        links = np.zeros((k, m), np.int32 if degree.max() < 1 << 31 else np.int64)
        for v, u, w in graph.entries():
            if len(v):
                first, n = v[0], v[-1] + 1 - v[0]
                links[first : first + n] += np.bincount((v - first) * m + comm[u], w, minlength=n * m).reshape(n, m).astype(links.dtype)
        return cls(graph, links, comm, held[names], degree)

    def walk(self, order: np.ndarray, resolution: float, total: float) -> bool:
        """As ``_pass``: some vertices are looked at together, and nothing changes for them up to the first that moves."""
        links, comm, held, degree, moved = self.links, self.comm, self.held, self.degree, False
        m, flat = links.shape[1], links.reshape(-1)
        at, step, most = 0, 8, max(8, TOGETHER // links.shape[1])
        while at < len(order):
            rows = order[at : at + step]
            each, own, have, pull = np.arange(len(rows)), comm[rows], links[rows], resolution * degree[rows]
            gain = have - pull[:, None] * held / (2 * total)
            gain[have == 0] = -np.inf
            stay = have[each, own] - pull * (held[own] - degree[rows]) / (2 * total)
            gain[each, own] = stay
            best = gain.argmax(axis=1)
            go = np.flatnonzero(gain[each, best] > stay + 1e-12)
            if not len(go):
                at, step = at + len(rows), min(2 * step, most)
                continue
            j = int(go[0])
            i, old, new = rows[j], own[j], best[j]
            a, b = self.graph.ptr[i], self.graph.ptr[i + 1]
            near, w = self.graph.near[a:b].astype(np.int64) * m, self.graph.weight[a:b].astype(links.dtype)
            np.subtract.at(flat, near + old, w)
            np.add.at(flat, near + new, w)
            held[old] -= degree[i]
            held[new] += degree[i]
            comm[i], moved = new, True
            at, step = at + j + 1, min(max(8, 2 * j), most)
        return moved

    def contracted(self) -> tuple[np.ndarray, np.ndarray]:
        """Each vertex's community, from 0 on without gaps, and what communities have with each other."""
        names, comm = np.unique(self.comm, return_inverse=True)
        order, links = np.argsort(comm, kind="stable"), np.zeros((len(names), len(names)))
        for c, rows in enumerate(np.split(order, np.cumsum(np.bincount(comm))[:-1])):
            for a in range(0, len(rows), 4096):
                links[c] += self.links[rows[a : a + 4096]].sum(axis=0, dtype=np.int64)[names]
        return comm, links


def _contract(graph: Graph, comm: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights inside of each of ``n`` communities, and between two (x * n + y) of them."""
    inner, keys, sums = np.zeros(n), np.zeros(0, np.int64), np.zeros(0)
    more, size = [], 0
    last = len(graph.near)
    for v, u, w in graph.entries():
        x, y = comm[v], comm[u]
        same = x == y
        inner += np.bincount(x[same], w[same] / 2, minlength=n)
        more.append((x[~same].astype(np.int64) * n + y[~same], w[~same]))
        size, last = size + len(more[-1][0]), last - len(v)
        if size > max(len(keys), 1 << 21) or not last:
            keys, at = np.unique(np.concatenate([keys, *[k for k, _ in more]]), return_inverse=True)
            sums = np.bincount(at, np.concatenate([sums, *[w for _, w in more]]), minlength=len(keys))
            more, size = [], 0
    return inner, keys, sums


def label_propagation(graph: Graph, rounds: int = 100) -> np.ndarray:
    """Each vertex in turn takes its neighbours' heaviest label, the smallest of equals."""
    k, ptr, near, weights = len(graph), graph.ptr.tolist(), graph.near, graph.weight
    label, tally = np.arange(k, dtype=np.int32), np.zeros(k)
    for _ in range(rounds):
        changed = False
        for i in range(k):
            a, b = ptr[i], ptr[i + 1]
            if a == b:
                continue
            c = label[near[a:b]]
            if b - a < FEW:
                votes: dict[int, float] = {}
                for j, w in zip(c.tolist(), weights[a:b].tolist(), strict=True):
                    votes[j] = votes.get(j, 0.0) + w
                best = min(votes, key=lambda j: (-votes[j], j))
            else:
                np.add.at(tally, c, weights[a:b].astype(np.float64))
                got = tally[c]
                best = int(c[got == got.max()].min())
                tally[c] = 0.0
            if best != label[i]:
                label[i], changed = best, True
        if not changed:
            break
    return label


def ordered(names: list[str], found: np.ndarray) -> list[tuple[int, list[str]]]:
    """(community, members) by size, then members; a community's id is its place."""
    members: dict[int, list[str]] = {}
    for a, c in zip(names, found.tolist(), strict=True):
        members.setdefault(c, []).append(a)
    return sorted(members.items(), key=lambda kv: (-len(kv[1]), kv[1]))


def window_communities(group: list[str], width: int, least: int, detect: Callable[[Graph], np.ndarray], min_size: int, score: Callable | None = None, plain: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows (group, author as text, target, at): the communities of each group's graph of window pairs.

    A row for each member, with ``plain`` without its community's figures; with ``score`` (n_overlap,
    jaccard -> columns by name) a row for each community instead: its number of pairs and the means of
    those columns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in units(batches, group):
            schema = rows.schema
            (authors, a), (_, t) = ranks(rows["author"]), ranks(rows["target"])
            sets, near = Sets(a, t), Near(a, t, rows["at"].to_numpy(), np.ones(len(a), bool), width)
            graph, there = Graph.neighbours(near, least)
            del rows, near, a, t
            found, names = detect(graph), authors.take(pa.array(there)).to_pylist()
            n = int(found.max()) + 1 if len(found) else 0
            pairs, sums = np.zeros(n, np.int64), {}
            for v, u, w in () if plain else graph.entries():
                keep = np.flatnonzero((v < u) & (found.take(v) == found.take(u)))
                v, u, w = v.take(keep), u.take(keep), w.take(keep)
                x, y, c = there.take(v), there.take(u), found.take(v)
                both = sets.shared(x, y)
                share = both / (sets.sizes.take(x) + sets.sizes.take(y) - both)
                pairs += np.bincount(c, minlength=n)
                for name, column in (score(w, share) if score else {"w": w, "share": share}).items():
                    np.add.at(sums.setdefault(name, np.zeros(n)), c, column)
            # The next group's graph is made before these names are bound again.
            del graph, sets
            for cid, (c, who) in enumerate(ordered(names, found)):
                if len(who) < min_size:
                    break
                inner = int(pairs[c])
                if score:
                    if inner:
                        yield pa.RecordBatch.from_arrays([*_of_key(key, group, schema, 1), pa.array([cid]), pa.array([inner]), *[pa.array([s[c] / inner]) for s in sums.values()]], [*group, "community_id", "pair_count", *[f"avg_{m}" if m != "composite_score" else m for m in sums]])
                    continue
                stats = () if plain else (len(who), inner, inner / (len(who) * (len(who) - 1) / 2), *[float(s[c]) / inner if inner else 0.0 for s in sums.values()])
                for k in range(0, len(who), OUT_ROWS):
                    part = who[k : k + OUT_ROWS]
                    cols = [*_of_key(key, group, schema, len(part)), pa.repeat(cid, len(part)), pa.array(part, pa.string()), *[pa.repeat(v, len(part)) for v in stats]]
                    yield pa.RecordBatch.from_arrays(cols, [*group, "community_id", "author", "community_size", "edge_count", "edge_density", "avg_co_post_count", "avg_jaccard"][: len(cols)])

    return run
