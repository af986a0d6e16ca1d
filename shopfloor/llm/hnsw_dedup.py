"""Near-duplicate embeddings with hierarchical navigable small-world graphs.

Equal vectors of a label are one node first.  A label's nodes are dealt to
shards of about ``SHARD_NUMBERS`` vector components; every shard gets its own
graph, and every node of the label queries every shard of its label, in blocks
of ``QUERY_ROWS``; in its own shard a search begins at the node itself.  Queries
whose whole beams link search on together with all queries that links connect
them with: the nodes linked with any of them are expanded once for the group, and
new ones compared with all its queries by one product; an audit
compares as many of a block's queries with an exact scan of the shard as hold
a stated number of true links and doubles the beam for all until nothing is
missed, at last up to the whole shard.
Pairs found are verified by cosine in double precision, a block gives back a
spanning forest of its links and each node's number of links, and the forests
are united by distributed connected components.

Graphs are built by inserting small batches: a batch searches the graph so far
(and is compared within itself), keeps diverse neighbours, and links back.

A shard is as large as a task may hold: every node searches all shards of its
label, so searches grow as nodes times shards, and a graph of four times the
nodes takes little longer to search than one.

Scale: a hot label has many shards; a group of tasks holds one shard and one
block; equal vectors, however many, meet only in a partial aggregate; no pair
is ever a row, only forest edges and counts are.

Defined results: vectors that are null, empty, zero or hold null or non-finite
numbers, and rows with a null label, link with nothing and are their own
component; so do rows with a null id (component null).  Vectors of different
dimension never link.  Rows that repeat an id and vector count once per row;
an id with several labels or vectors is as many nodes; an empty table gives an empty result.  Other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, mix64, partitions, pin
from .vectors import matrix, packed, usable

THRESHOLD = 0.93
SHARD_NUMBERS = 1 << 20
QUERY_ROWS = 16384
LINKS = 12
BEAM_BUILD = 40
BEAM = 24
BATCH = 256
AUDIT = 256
AUDIT_LINKS = 1024
#: Bounds of a step: bytes that mark which nodes its queries have seen; products of a group's queries and nodes at once.
SEEN_BYTES = 8_000_000
PAIRS = 2_500_000
#: Nodes of one smallest id (it may repeat with other labels or vectors) are told apart by their place.
PLACES = 1_000_000_000
NODE = "decimal(28,0)"


def _top(owner: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best per owner, by owner and falling score."""
    order = np.lexsort((-score, owner))
    o = owner[order]
    first = np.r_[True, o[1:] != o[:-1]] if len(o) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(o)), 0))
    return order[np.arange(len(o)) - start < k]


def _distinct(key: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers (sorting them is several times as fast as np.unique's table)."""
    key = np.sort(key)
    return key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key


def _groups(count: int, nodes: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per query (0..count-1) the smallest query that links (query, node) connect it with."""
    group = np.arange(count)
    while True:
        least = np.full(nodes, count)
        np.minimum.at(least, b, group[a])
        new = group.copy()
        np.minimum.at(new, a, least[b])
        new = new[new]
        if (new == group).all():
            return group
        group = new


class Graph:
    """A navigable small-world hierarchy over unit vectors."""

    def __init__(self, unit: np.ndarray, seed: int = 1):
        self.unit, n = unit, len(unit)
        draw = mix64(np.arange(n, dtype=np.uint64), seed).astype(np.float64) / 2.0**64
        self.level = np.minimum((-np.log(np.maximum(draw, 1e-18)) / np.log(LINKS)).astype(int), 4)
        top = int(self.level.max()) if n else 0
        self.cap = [2 * LINKS] + [LINKS] * top
        self.links = [np.full((n, c), -1, np.int32) for c in self.cap]
        self.order = np.argsort(-self.level, kind="stable")  # upper layers exist before anything below needs them
        self.entry = self.order[:1].astype(np.int64)
        done = 0
        while done < n:
            size = min(BATCH, max(8, done // 2 if done else 8), n - done)
            self._insert(self.order[done : done + size], self.order[:done])
            done += size

    def beam(self, q: np.ndarray, start_q: np.ndarray, start: np.ndarray, layer: int, width: int):
        """Per query the ``width`` nearest nodes found on a layer: (query, node, score).

        All members of a beam that have not been expanded are expanded at once."""
        links, n = self.links[layer], len(self.unit)
        seen = np.zeros((len(q), n), bool)
        key = _distinct(start_q * n + start)
        owner, node = key // n, key % n
        seen[owner, node] = True
        score = np.einsum("ij,ij->i", self.unit[node], q[owner])
        keep = _top(owner, score, width)
        owner, node, score = owner[keep], node[keep], score[keep]
        fresh = np.ones(len(owner), bool)
        while fresh.any():
            near = links[node[fresh]]
            o = np.repeat(owner[fresh], near.shape[1])
            near = near.ravel()
            ok = near >= 0
            o, near = o[ok], near[ok].astype(np.int64)
            ok = ~seen[o, near]
            key = _distinct(o[ok] * n + near[ok])
            o, near = key // n, key % n
            seen[o, near] = True
            s = np.einsum("ij,ij->i", self.unit[near], q[o])
            worst = np.full(len(q), np.inf)  # of a full beam: what is no better does not enter
            np.minimum.at(worst, owner, score)
            better = (s > worst[o]) | (np.bincount(owner, minlength=len(q))[o] < width)
            o, near, s = o[better], near[better], s[better]
            owner, node, score = np.r_[owner, o], np.r_[node, near], np.r_[score, s]
            fresh = np.r_[np.zeros(len(fresh), bool), np.ones(len(o), bool)]
            keep = _top(owner, score, width)
            owner, node, score, fresh = owner[keep], node[keep], score[keep], fresh[keep]
        return owner, node, score

    def _descend(self, q: np.ndarray, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """Entry points of a layer: the best of the layer above, from the top."""
        owner, node = np.arange(len(q)), np.repeat(self.entry, len(q))
        for above in range(len(self.links) - 1, layer, -1):
            owner, node, score = self.beam(q, owner, node, above, 4)
        return owner, node

    def _diverse(self, owner, node, score, count: int, m: int) -> np.ndarray:
        """For owners 0..count-1, up to m neighbours, each nearer to its owner than to those taken before; then the nearest of the rest."""
        width = min(BEAM_BUILD, max(1, int(np.bincount(owner, minlength=count).max()) if len(owner) else 1))
        keep = _top(owner, score, width)
        owner, node, score = owner[keep], node[keep], score[keep]
        start = np.searchsorted(owner, np.arange(count))
        place = np.arange(len(owner)) - start[owner]
        cand, sim = np.full((count, width), -1, np.int64), np.full((count, width), -2.0)
        cand[owner, place], sim[owner, place] = node, score
        vectors = self.unit[np.maximum(cand, 0)]
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        taken = np.zeros((count, width), bool)
        for r in range(width):
            clash = (taken & (between[:, r, :] > sim[:, r : r + 1])).any(axis=1)
            taken[:, r] = (cand[:, r] >= 0) & ~clash & (taken.sum(axis=1) < m)
        rank = np.where(cand < 0, 10**6, np.where(taken, 0, 1000) + np.arange(width)[None, :])
        best = np.argsort(rank, axis=1, kind="stable")[:, :m]
        out = np.full((count, m), -1, np.int32)
        out[:, : best.shape[1]] = np.take_along_axis(cand, best, 1)
        return out

    def _insert(self, new: np.ndarray, old: np.ndarray) -> None:
        for layer in range(min(int(self.level[new].max()), len(self.links) - 1), -1, -1):
            part = new[self.level[new] >= layer]
            q = self.unit[part]
            owner = node = np.zeros(0, np.int64)
            score = np.zeros(0)
            if len(old) and (self.level[old] >= layer).any():
                owner, node = self._descend(q, layer)
                owner, node, score = self.beam(q, owner, node, layer, BEAM_BUILD)
            within = q @ q.T
            np.fill_diagonal(within, -2.0)
            k = min(LINKS, len(part) - 1)
            if k > 0:
                best = np.argpartition(-within, k - 1, axis=1)[:, :k]
                o = np.repeat(np.arange(len(part)), k)
                owner, node, score = np.r_[owner, o], np.r_[node, part[best.ravel()]], np.r_[score, within[o, best.ravel()]]
            if not len(owner):
                continue
            chosen = self._diverse(owner, node, score, len(part), LINKS)
            self.links[layer][part, :LINKS] = chosen
            # links back: old and new neighbours of every node that was chosen
            at, col = np.nonzero(chosen >= 0)
            target, source = chosen[at, col].astype(np.int64), part[at]
            nodes, number = np.unique(target, return_inverse=True)
            had = self.links[layer][nodes]
            h_at, h_col = np.nonzero(had >= 0)
            owner = np.r_[h_at, number]
            node = np.r_[had[h_at, h_col].astype(np.int64), source]
            key = _distinct(owner * len(self.unit) + node)
            owner, node = key // len(self.unit), key % len(self.unit)
            score = np.einsum("ij,ij->i", self.unit[nodes[owner]], self.unit[node])
            self.links[layer][nodes] = self._diverse(owner, node, score, len(nodes), self.cap[layer])

    def within(self, q: np.ndarray, own: np.ndarray, threshold: float, width: int):
        """(query, node) pairs of at least ``threshold``; ``own``: each query's node here, or -1.

        A query whose whole beam links searches on with all queries that links connect it with."""
        n = len(self.unit)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        full = np.zeros(len(q), bool)
        step = max(16, min(512, SEEN_BYTES // max(n, width * 4 * LINKS)))
        for i in range(0, len(q), step):
            part = np.arange(i, min(i + step, len(q)))
            if width >= n:
                o, v = np.nonzero(q[part] @ self.unit.T >= threshold)
                found.append((part[o], v))
                continue
            # a node of this graph begins at itself, any other query at the layers above
            mine, far = np.flatnonzero(own[part] >= 0), np.flatnonzero(own[part] < 0)
            owner, node = self._descend(q[part][far], 0) if len(far) else (far, far)
            owner, node, score = self.beam(q[part], np.r_[far[owner], mine], np.r_[node, own[part][mine]], 0, width)
            hit = score >= threshold
            full[part] = np.bincount(owner[hit], minlength=len(part)) >= width
            found.append((part[owner[hit]], node[hit]))
        a, b = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
        if not full.any():
            return a, b
        group = _groups(len(q), n, a, b)
        dense = np.zeros(len(q), bool)
        dense[group[full]] = True
        dense = dense[group]  # queries of a group that holds a full beam
        members = np.flatnonzero(dense)
        members = members[np.argsort(group[members], kind="stable")]
        again = dense[a]
        seeds, of = b[again], group[a[again]]
        order = np.argsort(of, kind="stable")
        seeds, of = seeds[order], of[order]
        found = [(a[~again], b[~again])]
        for g in np.split(members, np.flatnonzero(np.diff(group[members])) + 1):
            lo, hi = np.searchsorted(of, [group[g[0]], group[g[0]] + 1])
            found += self._spread(q, g, _distinct(seeds[lo:hi]), threshold)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _spread(self, q: np.ndarray, group: np.ndarray, start: np.ndarray, threshold: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """All links of a group's queries that are reached from ``start`` over nodes that link with any of them."""
        asked, found = q[group], []
        seen = np.zeros(len(self.unit), bool)
        near = start
        while len(near):
            seen[near] = True
            linked = np.zeros(len(near), bool)
            step = max(1, PAIRS // len(near))
            for i in range(0, len(group), step):
                o, v = np.nonzero(asked[i : i + step] @ self.unit[near].T >= threshold)
                found.append((group[i : i + step][o], near[v]))
                linked[v] = True
            near = self.links[0][near[linked]].ravel()
            near = near[near >= 0].astype(np.int64)
            near = _distinct(near[~seen[near]])
        return found


def audited_links(graph: Graph, q: np.ndarray, own: np.ndarray, threshold: float, width: int = BEAM):
    """All links of the queries, the beam widened until an audit against an exact scan misses nothing.

    Queries are audited, AUDIT at a time, until AUDIT_LINKS true links other than
    those of a node with itself have been seen; where there are fewer, all are audited."""
    n = len(graph.unit)
    order = np.argsort(mix64(np.arange(len(q), dtype=np.uint64), 99))
    truth, size, seen = [np.zeros(0, np.int64)], 0, 0
    while size < len(order) and seen < AUDIT_LINKS:
        part = order[size : size + AUDIT]
        a, b = np.nonzero(q[part] @ graph.unit.T >= threshold)
        seen += int((own[part][a] != b).sum())
        truth.append(part[a] * n + b)
        size += len(part)
    truth = np.concatenate(truth)
    while True:
        a, b = graph.within(q, own, threshold, width)
        if width >= n or np.isin(truth, a * n + b).all():
            return a, b
        width *= 2


def forest(a: np.ndarray, b: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of the links (ids)."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := root.setdefault(x, x)) != x:
            root[x] = root[p]
            x = p
        return x

    out_a, out_b = [], []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = find(x), find(y)
        if rx != ry:
            root[max(rx, ry)] = min(rx, ry)
            out_a.append(x)
            out_b.append(y)
    return out_a, out_b


def _dealt(nodes: DataFrame) -> DataFrame:
    """Adds dim (bytes of a vector), a label's shards and blocks, and each node's own ones."""
    per_label = nodes.groupBy("label", F.length("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    sized = nodes.withColumn("dim", F.length("vec")).join(per_label, ["label", "dim"])
    sized = sized.withColumn("shards", F.expr(f"cast(greatest((n * dim div 8 + {SHARD_NUMBERS} - 1) div {SHARD_NUMBERS}, 1) as int)")).withColumn("blocks", F.expr(f"cast((n + {QUERY_ROWS} - 1) div {QUERY_ROWS} as int)"))
    return sized.withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("shards")).cast("int")).withColumn("block_own", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")).cast("int"))


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id", column: str = "embedding", label: str = "label") -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept."""
    base = table.select(F.col(id_column).cast("long").alias("id"), F.col(label).alias("label"), F.col(column).alias("embedding"), (usable(column) & F.col(label).isNotNull() & F.col(id_column).isNotNull()).alias("ok"))
    vectors = packed(base.where("ok").drop("ok"), "embedding")
    grouped = vectors.groupBy("label", "vec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    place = F.row_number().over(Window.partitionBy("least").orderBy("label", "vec")) - 1
    nodes = pin(grouped.select("label", "vec", "copies", (F.col("least").cast("decimal(19,0)") * F.lit(PLACES).cast("decimal(10,0)") + place).cast(NODE).alias("node")), "hnsw-nodes")
    sized = _dealt(nodes)
    key = ["label", "dim", "shard", "block"]
    data = sized.select("label", "dim", F.col("own").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "node", "copies", "vec")
    again = [F.expr(c).alias(c) for c in ("label", "dim", "node", "vec")]  # columns of their own beside those of data
    queries = sized.select(*again, F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.col("block_own").alias("block"))

    def run(left, right):
        kind = pa.decimal128(28, 0)
        both = [*left.column("node").to_pylist(), *right.column("node").to_pylist()]
        names = sorted(set(both))  # nodes by their order here
        code = {x: k for k, x in enumerate(names)}
        nodes, asked = np.split(np.array([code[x] for x in both], np.int64), [left.num_rows])
        copies = left.column("copies").to_numpy()
        empty = pa.table([pa.array([], kind), pa.array([], kind), pa.array([], pa.int64())], names=["a", "b", "n"])
        if not len(nodes) or not len(asked):
            return empty
        order = np.argsort(nodes)
        nodes, copies = nodes[order], copies[order]
        rows = matrix(left.column("vec").to_pylist())[order]
        q = matrix(right.column("vec").to_pylist())
        rows_n, q_n = np.sqrt(np.einsum("ij,ij->i", rows, rows)), np.sqrt(np.einsum("ij,ij->i", q, q))
        unit, unit_q = rows / rows_n[:, None], q / q_n[:, None]
        at = np.minimum(np.searchsorted(nodes, asked), len(nodes) - 1)
        own = np.where(nodes[at] == asked, at, -1)
        i, j = audited_links(Graph(unit), unit_q, own, threshold - 1e-9)
        other = asked[i] != nodes[j]
        i, j = i[other], j[other]
        exact = np.einsum("ij,ij->i", q[i], rows[j]) / (q_n[i] * rows_n[j]) >= threshold
        i, j = i[exact], j[exact]
        links = np.bincount(i, weights=copies[j], minlength=len(asked)).astype(np.int64)
        some = np.flatnonzero(links)
        a, b = forest(asked[i], nodes[j])
        # counts: (node, null, links); forest edges: (node, node, null)
        return pa.table(
            [pa.array([names[k] for k in [*asked[some].tolist(), *a]], kind), pa.array([None] * len(some) + [names[k] for k in b], kind), pa.array([*links[some].tolist(), *[None] * len(a)], pa.int64())],
            names=["a", "b", "n"],
        )

    n = partitions(table)
    found = pin(data.repartition(n, *key).groupBy(*key).cogroup(queries.repartition(n, *key).groupBy(*key)).applyInArrow(run, f"a {NODE}, b {NODE}, n bigint"), "hnsw-found")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    components = connected_components(found.where("b is not null").select("a", "b"), "hnsw")
    # back to the rows: by label and vector to the node, from the node to its counts
    least = F.floor(F.coalesce("component", "node") / F.lit(PLACES).cast("decimal(10,0)")).cast("long")  # a node's number begins with its smallest id
    node = nodes.join(counts, "node", "left").join(components, "node", "left").select("label", "vec", "copies", "linked", least.alias("component"))
    whole = vectors.join(node, ["label", "vec"]).select(F.col("id").alias("vec_id"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("component").alias("component_id"))
    rest = base.where("not ok").select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return whole.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
