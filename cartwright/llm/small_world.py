"""Near copies among embeddings by hierarchical navigable small-world graphs, one per shard.

Equal vectors become one class with a number of copies. Classes are dealt to shards by a hash; a shard builds its graph
once and writes it. A vector within ``radius`` of a graph node joins that node's ball instead of becoming a node, so a
family of near copies is one node or a few, whatever its size. Then every class is searched in every shard.

* The graph: levels of nodes, each holding the one above; a node keeps neighbours that are nearer to it than to each other,
  and then the nearest. Batches of vectors are inserted, and batches of queries searched, in lockstep.
* Audit: in each task a sample of queries and nodes is compared with all nodes of the shard. The beam doubles until at least
  ``RECALL`` of the nodes in reach are found; a beam as wide as the shard is a scan. A query whose beam holds nothing but
  nodes in reach is searched again with a wider one, so no number of neighbours is a cap.
* Verification: a link's cosine is computed in double precision. Angles obey the triangle inequality, so a ball that lies
  within the limit of a query as a whole counts by its weight, and one that lies beyond it not at all; only the balls
  across the limit are compared member by member. All members of a ball are linked with one another (its radius is under
  half of the limit), so one link per query and ball is all that the components need.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite entry link with nothing; vectors of different
length don't link; repeated rows are rows like others and link with each other; a null id is never a component's name
while the component has another, and is kept if it has none; an empty table gives an empty result. Other columns are
ignored. Links are found from both ends; one that a search missed from one end only counts at the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import acos, cos

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.base import mixed, staged
from cartwright.llm.components import components

LIMIT = 0.95
#: Bytes of a shard's vectors in double precision; fewer vectors still make this many shards, to share the work.
SHARD_BYTES = 32 << 20
LEAST_SHARDS = 4
#: Queries of one task.
QUERIES = 8_192
#: Neighbours of a node on the ground and above it; the beam while building, and the first one tried in a search.
GROUND, ABOVE = 32, 16
BUILD_BEAM, BEAM = 48, 24
#: Nodes of a beam expanded at once.
STEP = 4
#: Queries and nodes that an audit compares with all nodes, and the share it wants found.
AUDITED, RECALL = 256, 0.99
#: Numbers gathered at once.
GATHERED = 1 << 22
#: Angles that differ by less are decided by the cosine itself.
DOUBT = 1e-6

_GRAPH = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("rid", pa.int64()), ("copies", pa.int64()), ("v", pa.list_(pa.float64())),
                    ("place", pa.int32()), ("node", pa.int32()), ("links", pa.binary())])
GRAPH_DDL = "dim int, shard int, rid bigint, copies bigint, v array<double>, place int, node int, links binary"
_FOUND = pa.schema([("rid", pa.int64()), ("linked", pa.int64()), ("others", pa.list_(pa.int64()))])
FOUND_DDL = "rid bigint, linked bigint, others array<bigint>"


def unit(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, scaled to length one without overflow."""
    flat = column.combine_chunks()
    rows = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


# ---- the graph ------------------------------------------------------------------------------------


class Graph:
    """Nodes in order of falling level, so that each level's nodes come first; neighbours by level, -1 for none.

    The last row of a level's table has no neighbours: it stands for node -1.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.links: list[np.ndarray] = []

    def beam(self, queries: np.ndarray, entry: np.ndarray, links: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes met from the entries of each query on one level, nearest first, and their cosines."""
        total = len(queries)
        seen = np.zeros((total, len(links)), bool)
        seen[:, -1] = True
        nodes = np.full((total, width), -1)
        near = np.full((total, width), -np.inf, np.float32)
        spent = np.ones((total, width), bool)
        active, met = np.arange(total), entry
        while len(active):
            met = np.sort(met, axis=1)
            fresh = ~seen[active[:, None], met]
            fresh[:, 1:] &= met[:, 1:] != met[:, :-1]
            at, col = np.nonzero(fresh)
            seen[active[at], met[at, col]] = True
            cosines = np.full(met.shape, -np.inf, np.float32)
            cosines[at, col] = np.einsum("ij,ij->i", queries[active[at]], self.vectors[met[at, col]])
            merged = np.concatenate([near[active], cosines], axis=1)
            order = np.argsort(-merged, axis=1, kind="stable")[:, :width]
            near[active] = np.take_along_axis(merged, order, 1)
            nodes[active] = np.take_along_axis(np.concatenate([nodes[active], np.where(fresh, met, -1)], axis=1), order, 1)
            spent[active] = np.take_along_axis(np.concatenate([spent[active], ~fresh], axis=1), order, 1)
            first = np.argsort(spent[active], axis=1, kind="stable")[:, :STEP]
            open_ = ~np.take_along_axis(spent[active], first, 1)
            going = open_[:, 0]
            active, first, open_ = active[going], first[going], open_[going]
            picked = np.where(open_, np.take_along_axis(nodes[active], first, 1), -1)
            spent[active[:, None], first] = True
            met = links[picked].reshape(len(active), picked.shape[1] * links.shape[1])
        return nodes, near

    def search(self, queries: np.ndarray, width: int, lowest: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The nearest nodes found on level ``lowest`` by descending to it from the top."""
        entry = np.zeros((len(queries), 1), np.int64)
        for level in range(len(self.links) - 1, lowest, -1):
            entry = self.beam(queries, entry, self.links[level], 2 * STEP)[0][:, :STEP]
        return self.beam(queries, entry, self.links[lowest], width)

    def neighbours(self, base: np.ndarray, offered: np.ndarray, width: int) -> np.ndarray:
        """Of the nodes offered to each base vector, those nearer to it than to any nearer one chosen; then the nearest."""
        offered = np.sort(offered, axis=1)[:, ::-1]
        valid = offered >= 0
        valid[:, 1:] &= offered[:, 1:] != offered[:, :-1]
        found = np.where(valid, np.einsum("ij,ikj->ik", base, self.vectors[offered]), -np.inf)
        order = np.argsort(-found, axis=1, kind="stable")[:, : 2 * width]
        offered, valid, found = (np.take_along_axis(a, order, 1) for a in (offered, valid, found))
        vectors = self.vectors[offered]
        between = vectors @ vectors.transpose(0, 2, 1)
        taken, closest = np.zeros(valid.shape, bool), np.full(valid.shape, -np.inf)
        for k in range(valid.shape[1]):
            taken[:, k] = valid[:, k] & (closest[:, k] < found[:, k]) & (taken.sum(axis=1) < width)
            closest = np.where(taken[:, k, None], np.maximum(closest, between[:, :, k]), closest)
        order = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :width]
        out = np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(offered, order, 1), -1)
        return np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1)


def batch_of(width: int) -> int:
    return int(np.clip(GATHERED // (2 * GROUND * width), 8, 512))


def level_of(rids: np.ndarray) -> np.ndarray:
    """A level for each row, from its number alone: one in ``ABOVE`` goes on to the next."""
    share = (mixed(rids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) + 1
    return np.floor(-np.log(share / float(1 << 53)) / np.log(ABOVE)).astype(np.int64)


def _within(vectors: np.ndarray, radius: float) -> np.ndarray:
    """For each vector of a batch that is no node: the earlier vector whose ball it joins, else -1."""
    near = vectors @ vectors.T
    owner = np.full(len(vectors), -1)
    for i in np.flatnonzero((np.tril(near, -1) >= cos(radius)).any(axis=1)):
        free = np.flatnonzero((near[i, :i] >= cos(radius)) & (owner[:i] < 0))
        if len(free):
            owner[i] = free[near[i, free].argmax()]
    return owner


def build(vectors: np.ndarray, levels: np.ndarray, radius: float) -> tuple[Graph, np.ndarray, np.ndarray]:
    """A graph of unit vectors: the graph, the rows that are its nodes, and the node (its place) whose ball holds each row."""
    size, wide = len(vectors), vectors.shape[1]
    graph = Graph(np.zeros((size + 1, wide), np.float32))
    rows, ball, n = np.full(size, -1), np.full(size, -1), 0
    for level in range(int(levels.max()), -1, -1):
        here = np.flatnonzero(levels == level)
        width = ABOVE if level else GROUND
        links = np.full((n + len(here) + 1, width), -1)
        if graph.links:
            links[:n, : graph.links[0].shape[1]] = graph.links[0][:n]
        graph.links.insert(0, links)
        at = 0
        while at < len(here):
            batch = here[at:at + min(batch_of(wide), max(1, n))]
            at += len(batch)
            mine = vectors[batch].astype(np.float32)
            found = np.full((len(batch), 1), -1)
            if n:
                below, graph.links = graph.links, [links[np.r_[:n, -1]], *graph.links[1:]]
                found, near = graph.search(mine, BUILD_BEAM)
                graph.links = below
                close = near[:, 0] >= cos(radius)
                ball[batch[close]] = found[close, 0]
                batch, mine, found = batch[~close], mine[~close], found[~close]
            owner = _within(mine, radius)
            new = owner < 0
            place = n + np.cumsum(new) - 1
            ball[batch] = np.where(new, place, place[owner])
            batch, mine, found = batch[new], mine[new], found[new]
            if not len(batch):
                continue
            places = np.arange(n, n + len(batch))
            rows[places], graph.vectors[places] = batch, mine
            n += len(batch)
            among = mine @ mine.T
            np.fill_diagonal(among, -np.inf)
            kin = places[np.argsort(-among, axis=1, kind="stable")[:, : min(width, len(batch) - 1)]]
            links[places] = graph.neighbours(mine, np.concatenate([found, kin], axis=1), width)
            _link_back(graph, links, places, width)
        graph.links[0] = links[np.r_[:n, -1]]
    graph.vectors = np.concatenate([graph.vectors[:n], graph.vectors[-1:]])
    return graph, rows[:n], ball


def _link_back(graph: Graph, links: np.ndarray, places: np.ndarray, width: int) -> None:
    """Offer new nodes to the neighbours they chose."""
    to = links[places].ravel()
    by = np.repeat(places, width)[to >= 0]
    to = to[to >= 0]
    near = np.einsum("ij,ij->i", graph.vectors[to], graph.vectors[by])
    order = np.lexsort((by, -near, to))
    to, by = to[order], by[order]
    starts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, np.int64)
    rank = np.arange(len(to)) - np.repeat(starts, np.diff(np.r_[starts, len(to)]))
    nodes = to[starts]
    offered = np.full((len(nodes), width), -1)
    kept = rank < width
    offered[np.searchsorted(nodes, to[kept]), rank[kept]] = by[kept]
    step = batch_of(graph.vectors.shape[1])
    for i in range(0, len(nodes), step):
        some = nodes[i:i + step]
        links[some] = graph.neighbours(graph.vectors[some], np.concatenate([links[some], offered[i:i + step]], axis=1), width)


# ---- search ---------------------------------------------------------------------------------------


def in_reach(graph: Graph, queries: np.ndarray, least: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, node) with a cosine of at least ``least``, as found; beams that overflow with them are widened."""
    n = len(graph.vectors) - 1
    step = batch_of(graph.vectors.shape[1])
    for start in range(0, len(queries), step):
        left, width = np.arange(start, min(start + step, len(queries))), beam
        while len(left):
            if width >= n:
                at, node = np.nonzero(queries[left] @ graph.vectors[:n].T >= least)
                yield left[at], node
                break
            nodes, near = graph.search(queries[left], width)
            full = near[:, -1] >= least
            at, col = np.nonzero((near >= least) & ~full[:, None])
            yield left[at], nodes[at, col]
            left, width = left[full], 2 * width


def audited(graph: Graph, sample: np.ndarray, least: float, beam: int = BEAM, recall: float = RECALL) -> int:
    """The first beam, doubling, that finds enough of the nodes in reach of the sample. Without any, the first."""
    n = len(graph.vectors) - 1
    wanted = sample @ graph.vectors[:n].T >= least
    while beam < n:
        hit = sum(int(wanted[q, node].sum()) for q, node in in_reach(graph, sample, least, beam))
        if hit >= recall * wanted.sum():
            break
        beam *= 2
    return beam


def _pick(n: int, most: int) -> np.ndarray:
    """At most ``most`` of n places, spread evenly."""
    return np.unique(np.linspace(0, n - 1, min(n, most)).astype(np.int64))


class Shard:
    """A shard read back: the graph, and the members of each node's ball with their weights."""

    def __init__(self, rows: pa.Table, limit: float):
        places, node = rows["place"].to_numpy(), rows["node"].to_numpy()
        vectors = unit(rows["v"])
        nodes = np.flatnonzero(places >= 0)
        nodes = nodes[np.argsort(places[nodes])]
        self.limit, self.angle = limit, acos(limit)
        flat = [np.frombuffer(b, np.int32) for b in rows["links"].take(pa.array(nodes)).to_pylist()]
        heights = np.array([(len(f) - GROUND) // ABOVE for f in flat])
        none = np.full((1, GROUND), -1)
        self.graph = Graph(np.concatenate([vectors[nodes], np.zeros((1, vectors.shape[1]))]).astype(np.float32))
        self.graph.links = [np.concatenate([np.stack([f[:GROUND] for f in flat]), none])] + [
            np.concatenate([np.stack([f[GROUND + (h - 1) * ABOVE:GROUND + h * ABOVE] for f in flat[: int((heights >= h).sum())]]), none[:, :ABOVE]])
            for h in range(1, int(heights.max()) + 1)]
        order = np.argsort(node, kind="stable")
        self.rids, self.vectors, self.node = rows["rid"].to_numpy()[order], vectors[order], node[order]
        self.weights = rows["copies"].to_numpy()[order]
        self.starts = np.searchsorted(self.node, np.arange(len(nodes) + 1))
        self.centres, self.heads = vectors[nodes], rows["rid"].to_numpy()[nodes]
        apart = np.arccos(np.clip(np.einsum("ij,ij->i", self.vectors, self.centres[self.node]), -1, 1))
        self.radius = np.maximum.reduceat(apart, self.starts[:-1])
        self.weight = np.add.reduceat(self.weights, self.starts[:-1])
        self.by_rid = np.argsort(self.rids)

    def own(self, rids: np.ndarray) -> np.ndarray:
        """The member that each of some rows is here, else -1."""
        at = self.by_rid[np.minimum(np.searchsorted(self.rids, rids, sorter=self.by_rid), len(self.rids) - 1)]
        return np.where(self.rids[at] == rids, at, -1)

    def links(self, queries: np.ndarray, rids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The weight linked with each query, its own row apart, and links (query, row) that join it to the balls it meets."""
        least = cos(min(np.pi, self.angle + float(self.radius.max()) + DOUBT)) - DOUBT
        small = queries.astype(np.float32)
        sample = np.concatenate([small[_pick(len(small), AUDITED)], self.graph.vectors[_pick(len(self.heads), AUDITED)]])
        beam = audited(self.graph, sample, least)
        own = self.own(rids)
        home = np.flatnonzero(own >= 0)
        pairs = [*in_reach(self.graph, small, least, beam), (home, self.node[own[home]])]  # its own ball it always meets
        query, node = np.unique(np.concatenate([np.stack(p) for p in pairs], axis=1), axis=1)
        linked, ends = np.zeros(len(queries), np.int64), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for at in range(0, len(query), GATHERED // queries.shape[1]):
            q, c = query[at:at + GATHERED // queries.shape[1]], node[at:at + GATHERED // queries.shape[1]]
            apart = np.arccos(np.clip(np.einsum("ij,ij->i", queries[q], self.centres[c]), -1, 1))
            inside = apart + self.radius[c] < self.angle - DOUBT
            mine = (own[q] >= 0) & (self.node[own[q]] == c)
            np.add.at(linked, q[inside], self.weight[c[inside]] - np.where(mine[inside], self.weights[own[q[inside]]], 0))
            ends.append((q[inside], self.heads[c[inside]]))
            across = ~inside & (apart - self.radius[c] < self.angle + DOUBT)
            ends += self._members(queries, rids, q[across], c[across], linked)
        query, other = (np.concatenate(x) for x in zip(*ends))
        real = rids[query] != other
        return linked, query[real], other[real]

    def _members(self, queries: np.ndarray, rids: np.ndarray, q: np.ndarray, c: np.ndarray, linked: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Compare queries with the balls across their limit, all queries of a ball at once; the first linked member of each."""
        order = np.argsort(c, kind="stable")
        q, c, ends = q[order], c[order], []
        cuts = np.flatnonzero(np.diff(c, prepend=-1))
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(c)]):
            ball = slice(self.starts[c[lo]], self.starts[c[lo] + 1])
            step = max(1, GATHERED // (ball.stop - ball.start))
            for at in range(lo, hi, step):
                some = q[at:min(at + step, hi)]
                near = (queries[some] @ self.vectors[ball].T >= self.limit) & (self.rids[ball] != rids[some, None])
                linked[some] += near @ self.weights[ball]
                met = near.any(axis=1)
                ends.append((some[met], self.rids[ball][near[met].argmax(axis=1)]))
        return ends


# ---- over all shards ------------------------------------------------------------------------------


def _build(limit: float) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("rid")
        rids = group["rid"].to_numpy()
        graph, rows, ball = build(unit(group["v"]), levels := level_of(rids), acos(limit) / 2 - 1e-3)
        place = np.full(len(rids), -1, np.int32)
        place[rows] = np.arange(len(rows))
        links: list[bytes | None] = [None] * len(rids)
        for p, r in enumerate(rows.tolist()):
            links[r] = b"".join(graph.links[h][p].astype(np.int32).tobytes() for h in range(int(levels[r]) + 1))
        return pa.table([group["dim"], group["shard"], group["rid"], group["copies"], group["v"].cast(pa.list_(pa.float64())),
                         pa.array(place), pa.array(ball, pa.int32()), pa.array(links, pa.binary())], schema=_GRAPH)

    return run


def _search(limit: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(graph: pa.Table, queries: pa.Table) -> pa.Table:
        if not graph.num_rows or not queries.num_rows:
            return _FOUND.empty_table()
        queries = queries.sort_by("rid")
        rids = queries["rid"].to_numpy()
        linked, query, other = Shard(graph, limit).links(unit(queries["v"]), rids)
        order = np.argsort(query, kind="stable")
        ends = np.searchsorted(query[order], np.arange(len(rids) + 1)).astype(np.int32)
        some = np.flatnonzero((linked > 0) | (np.diff(ends) > 0))
        out = pa.table([pa.array(rids), pa.array(linked), pa.ListArray.from_arrays(pa.array(ends), pa.array(other[order]))], schema=_FOUND)
        return out.take(pa.array(some))

    return run


def near_copies(vectors: DataFrame, limit: float = LIMIT, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``; see above."""
    spark = vectors.sparkSession
    exact = F.col(f"`{vector}`") if dict(vectors.dtypes)[vector] == "array<float>" else F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_}`").cast("bigint").alias("id"), exact.alias("v"))
    sound = F.coalesce((F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
                       & F.exists("v", lambda c: c != 0), F.lit(False))
    classes = staged(rows.where(sound).groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
                     .withColumn("rid", F.monotonically_increasing_id()), "vectors")
    held = classes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v").cast("bigint") * 8).alias("bytes")).first()
    shards, blocks = max(LEAST_SHARDS, -(-(held["bytes"] or 0) // SHARD_BYTES)), max(1, -(-held["n"] // QUERIES))

    dim, every = F.size("v").alias("dim"), lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = classes.select("rid", "copies", "v", dim, F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int").alias("shard"))
    graphs = staged(dealt.groupBy("dim", "shard").applyInArrow(_build(limit), GRAPH_DDL), "graphs")
    asked = classes.select("rid", "v", dim, F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int").alias("block"), every(shards).alias("shard"))
    found = staged(graphs.withColumn("block", every(blocks)).groupBy("dim", "shard", "block").cogroup(
        asked.groupBy("dim", "shard", "block")).applyInArrow(_search(limit), FOUND_DDL), "found")

    links = found.select(F.col("rid").alias("a"), F.explode("others").alias("b"))
    counts = found.groupBy("rid").agg(F.sum("linked").alias("linked"))
    labelled = classes.join(counts, "rid", "left").join(components(links).withColumnRenamed("node", "rid"), "rid", "left").select(
        "v", "least", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "rid").alias("label"))
    names = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = staged(labelled.join(names, "label").select("v", "n_links", "component_id"), "named")
    met = rows.where(sound).join(named, "v").select("id", "n_links", "component_id")
    alone = rows.where(~sound).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return met.unionByName(alone).select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
