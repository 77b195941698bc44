"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

Nearness is the largest inner product. Vectors are cut into bands of norm, each a power of two
wide, and every band is embedded by itself so that the largest product becomes the smallest Euclidean
distance: vectors are divided by the band's upper norm and one component is added that brings
each to norm 1; queries are brought to norm 1 and get 0 there. So a vector of a length of its own
takes nothing from the others' precision. The vectors of a band are dealt over shards by a hash of
their content. A shard's graph is built in batches: a greedy search of the graph so far proposes
neighbours for each new vector, pruning keeps the nearest candidate and drops those that are nearer to it, by the
factor ``alpha``, than to the vector, and so on; then edges back are added, and lists that are too
long are pruned the same way. A query searches every shard with a beam; the best of all shards,
with exact products in double precision on the original vectors, are its result.

The width of a shard's beam is measured, not assumed: after the build, some of the shard's own
vectors are searched against all of the shard, and the beam doubles until it finds ``recall`` of their
nearest. A shard where that takes a beam that looks at as many vectors as there are is searched whole.

Equal vectors are one node: of each only the ids that can be among the ``k`` nearest of any query,
the k + 1 smallest, are kept, since ties go to smaller ids. So a vector that a third of all rows
hold costs one node, and its ids are cut down in every task before they move.

A shard is built in one task and written to the shared folder; its size is bounded
(``shard_rows``), and the number of shards grows with the table. Queries go to the shards in blocks
of a bounded size, each sent once to every executor; a task reads its shards from the shared
folder, searches them one after another and keeps the ``k`` best of each query, so what is shuffled is
that and never a graph or a query. All searches of a block advance together in arrays.

Defined cases: a vector that is null, all zero, or holds a null or non-finite component takes no
part, as query or as candidate; vectors of another length than the query's are not compared with
it; products beyond the range of doubles are infinite, and one that is not a number, from infinities of
both signs, comes last; repeated ids with different vectors are candidates each, and a row is a query's own if it has
its id; with fewer than k candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from evenkeel.session import materialize


@dataclass(frozen=True)
class GraphRule:
    degree: int = 48
    build_beam: int = 96
    alpha: float = 1.25
    recall: float = 0.97
    measured: int = 100  # vectors of a shard that its beam is measured on
    least_shards: int = 12
    shard_rows: int = 20_000
    query_block: int = 1 << 15
    seed: int = 7


@dataclass
class Shard:
    ids: np.ndarray  # of all nodes, each node's ascending
    counts: np.ndarray  # ids per node
    vectors: np.ndarray  # original
    edges: np.ndarray  # node x degree; -1 fills up
    entry: int
    beam: int
    band: int

    def __post_init__(self) -> None:
        self.points = embedded(self.vectors, self.band)

    def packed(self) -> bytes:
        out = io.BytesIO()
        numbers = np.array([self.entry, self.beam, self.band])
        np.savez(out, ids=self.ids, counts=self.counts, vectors=self.vectors, edges=self.edges.astype(np.int32), numbers=numbers)
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Shard:
        with np.load(io.BytesIO(data)) as stored:
            entry, beam, band = stored["numbers"].tolist()
            parts = stored["ids"], stored["counts"], stored["vectors"], stored["edges"].astype(np.int64)
        return cls(*parts, entry, beam, band)


def embedded(vectors: np.ndarray, band: int) -> np.ndarray:
    """Vectors with norms below 2 to the power of ``band`` + 1 as points of norm 1."""
    scaled = np.ldexp(vectors, -(band + 1))
    rest = np.sqrt(np.maximum(1 - (scaled**2).sum(axis=1), 0))
    return np.hstack([scaled, rest[:, None]]).astype(np.float32)


def directions(queries: np.ndarray) -> np.ndarray:
    """Queries as points: of norm 1, without the added component."""
    scaled = queries / np.abs(queries).max(axis=1, keepdims=True)
    scaled /= np.sqrt((scaled**2).sum(axis=1, keepdims=True))
    return np.hstack([scaled, np.zeros((len(queries), 1))]).astype(np.float32)


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the ``beam`` nearest nodes found and their squared distances, nearest first; -1 fills up.

    All queries expand their nearest unexpanded node at once, until none has one left.
    """
    m = len(queries)
    square = (queries**2).sum(axis=1)
    nodes = np.full((m, beam), -1, np.int64)
    near = np.full((m, beam), np.inf, np.float32)
    done = np.ones((m, beam), bool)
    nodes[:, 0], done[:, 0] = entry, False
    near[:, 0] = square - 2 * queries @ points[entry] + (points[entry] ** 2).sum()
    seen = np.zeros((m, len(points)), bool)
    seen[:, entry] = True
    active = np.arange(m)
    norms = (points**2).sum(axis=1)
    while active.size:
        pick = np.where(done[active], np.inf, near[active]).argmin(axis=1)
        done[active, pick] = True
        fresh = edges[nodes[active, pick]]
        rows = np.repeat(np.arange(active.size), fresh.shape[1]).reshape(fresh.shape)
        known = (fresh < 0) | seen[active[rows], np.maximum(fresh, 0)]
        fresh = np.where(known, -1, fresh)
        # The list of one node holds no node twice, so each is new once.
        seen[active[rows[~known]], fresh[~known]] = True
        at = np.maximum(fresh, 0)
        distance = square[active, None] + norms[at] - 2 * np.einsum("qd,qrd->qr", queries[active], points[at])
        distance = np.where(known, np.inf, distance)
        all_nodes = np.hstack([nodes[active], fresh])
        all_near = np.hstack([near[active], distance])
        all_done = np.hstack([done[active], known])
        order = np.argsort(all_near, axis=1, kind="stable")[:, :beam]
        nodes[active] = np.take_along_axis(all_nodes, order, axis=1)
        near[active] = np.take_along_axis(all_near, order, axis=1)
        done[active] = np.take_along_axis(all_done, order, axis=1)
        active = active[(~done[active] & np.isfinite(near[active])).any(axis=1)]
    return nodes, near


def robust_prune(points: np.ndarray, owners: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Per owner at most ``degree`` of its candidates (-1 fills up), near ones that differ in direction."""
    at = np.maximum(candidates, 0)
    vectors = points[at]
    to_owner = ((vectors - points[owners][:, None]) ** 2).sum(axis=2)
    dead = (candidates < 0) | (candidates == owners[:, None])
    order = np.argsort(candidates, axis=1, kind="stable")
    ordered = np.take_along_axis(candidates, order, axis=1)
    again = np.zeros_like(dead)
    again[:, 1:] = ordered[:, 1:] == ordered[:, :-1]
    repeat = np.zeros_like(dead)
    np.put_along_axis(repeat, order, again, axis=1)
    dead |= repeat
    norms = (vectors**2).sum(axis=2)
    chosen = np.full((len(owners), degree), -1, np.int64)
    rows = np.arange(len(owners))
    for k in range(degree):
        left = np.where(dead, np.inf, to_owner)
        best = left.argmin(axis=1)
        some = np.isfinite(left[rows, best])
        if not some.any():
            break
        chosen[some, k] = candidates[rows[some], best[some]]
        center = vectors[rows, best]
        between = norms + norms[rows, best][:, None] - 2 * np.einsum("bcd,bd->bc", vectors, center)
        dead |= some[:, None] & (alpha * alpha * np.maximum(between, 0) <= to_owner)
        dead[rows, best] = True
    return chosen


def in_parts(total: int, width: int, floats: int = 1 << 24) -> range:
    return range(0, total, max(1, floats // max(width, 1)))


def build_graph(points: np.ndarray, rule: GraphRule) -> tuple[np.ndarray, int]:
    """Edges and entry: the node nearest to the mean."""
    n, degree = len(points), rule.degree
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    edges = np.full((n, degree), -1, np.int64)
    rng = np.random.default_rng(rule.seed)
    order = rng.permutation(n)
    order = np.append(entry, order[order != entry])
    width = (rule.build_beam + degree) * points.shape[1]

    def prune(owners: np.ndarray, candidates: np.ndarray) -> None:
        step = in_parts(len(owners), candidates.shape[1] * points.shape[1]).step
        for low in range(0, len(owners), step):
            part = slice(low, low + step)
            edges[owners[part]] = robust_prune(points, owners[part], candidates[part], rule.alpha, degree)

    def add_back(owners: np.ndarray) -> None:
        """Edges to ``owners`` from the nodes that they chose; lists that overflow are pruned."""
        to, frm = edges[owners].ravel(), np.repeat(owners, degree)
        frm, to = frm[to >= 0], to[to >= 0]
        by = np.argsort(to, kind="stable")
        frm, to = frm[by], to[by]
        heads = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if to.size else np.zeros(0, np.int64)
        sizes = np.diff(np.append(heads, to.size))
        # A node that very many chose gets them in rounds, each as wide as its list.
        for low in range(0, int(sizes.max()) if sizes.size else 0, degree):
            more = np.flatnonzero(sizes > low)
            nodes = to[heads[more]]
            added = np.full((more.size, degree), -1, np.int64)
            for j in range(degree):
                has = sizes[more] > low + j
                added[has, j] = frm[heads[more[has]] + low + j]
            prune(nodes, np.hstack([edges[nodes], added]))

    first = min(n, 4 * degree)
    start = order[:first]
    prune(start, np.broadcast_to(start, (first, first)).copy())
    add_back(start)
    done = first
    while done < n:
        batch = order[done : done + min(max(done // 2, degree), 2048)]
        step = in_parts(len(batch), max(n, width)).step
        for low in range(0, len(batch), step):
            part = batch[low : low + step]
            found, _ = beam_search(points, edges, entry, points[part], rule.build_beam)
            prune(part, found)
        add_back(batch)
        done += len(batch)
    return edges, entry


def measured_beam(points: np.ndarray, edges: np.ndarray, entry: int, asks: np.ndarray, k: int, recall: float) -> int:
    """The narrowest of the beams 2k, 4k, ... that finds ``recall`` of the k nearest points of ``asks``.

    All points, if none does that expands so few nodes that it looks at fewer points than there are.
    """
    n, k = len(points), min(k, len(points))
    products = asks @ points.T
    # A found point counts if it is as near as the k-th nearest, whichever of equal ones that is.
    kth = np.partition(products, n - k, axis=1)[:, n - k]
    beam = 2 * k
    while beam * edges.shape[1] < n:
        found = np.concatenate([beam_search(points, edges, entry, asks[i : i + 32], beam)[0][:, :k] for i in range(0, len(asks), 32)])
        near = np.take_along_axis(products, np.maximum(found, 0), axis=1) >= kth[:, None] - 1e-6
        if (near & (found >= 0)).mean() >= recall:
            return beam
        beam *= 2
    return n


def build_shard(ids: list[np.ndarray], vectors: np.ndarray, band: int, k: int, rule: GraphRule) -> Shard:
    points = embedded(vectors, band)
    edges, entry = build_graph(points, rule)
    some = np.random.default_rng(rule.seed).permutation(len(points))[: rule.measured]
    beam = measured_beam(points, edges, entry, directions(vectors[some]), k, rule.recall)
    return Shard(np.concatenate(ids), np.array([len(i) for i in ids]), vectors, edges, entry, beam, band)


def search_shard(shard: Shard, own: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best (row of ``queries``, id, score) of the shard per query, without rows of the query's own id."""
    out = []
    starts = np.append(0, np.cumsum(shard.counts))[:-1]
    n, beam = len(shard.points), max(shard.beam, k + 1)
    step = in_parts(len(queries), max(n, (beam + shard.edges.shape[1]) * queries.shape[1])).step
    for low in range(0, len(queries), step):
        asked, mine = queries[low : low + step], own[low : low + step]
        if beam >= n:
            nodes = np.broadcast_to(np.arange(n), (len(asked), n))
        else:
            nodes, _ = beam_search(shard.points, shard.edges, shard.entry, directions(asked), beam)
        row, col = np.nonzero(nodes >= 0)
        node = nodes[row, col]
        score = np.concatenate(
            [np.einsum("ij,ij->i", asked[row[i : i + (1 << 18)]], shard.vectors[node[i : i + (1 << 18)]]) for i in range(0, max(row.size, 1), 1 << 18)]
        )
        times = shard.counts[node]
        offset = np.arange(times.sum()) - np.repeat(np.append(0, np.cumsum(times))[:-1], times)
        vec_id = shard.ids[np.repeat(starts[node], times) + offset]
        row, score = np.repeat(row, times), np.repeat(score, times)
        other = vec_id != mine[row]
        row, vec_id, score = best_of(row[other], vec_id[other], score[other], k)
        out.append((row + low, vec_id, score))
    return tuple(np.concatenate(x) for x in zip(*out))


def best_of(row: np.ndarray, vec_id: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of each row, best first; what isn't a number comes last."""
    order = np.lexsort((vec_id, -score, row))
    row, vec_id, score = row[order], vec_id[order], score[order]
    best = np.arange(row.size) - np.searchsorted(row, row) < k
    return row[best], vec_id[best], score[best]


def search_batches(
    batches: Iterable[pa.RecordBatch], queries: dict[int, tuple[np.ndarray, np.ndarray]], k: int
) -> Iterator[pa.RecordBatch]:
    """The ``k`` best of all shards of a task for every query."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    best = {dim: none for dim in queries}
    for batch in batches:
        for dim, packed in zip(batch.column("dim").to_pylist(), batch.column("graph")):
            if dim in queries:
                found = search_shard(Shard.unpacked(packed.as_py()), *queries[dim], k)
                best[dim] = best_of(*(np.concatenate(x) for x in zip(best[dim], found)), k)
    for dim, (row, vec_id, score) in best.items():
        arrays = [pa.array(queries[dim][0][row]), pa.array(vec_id), pa.array(score, pa.float64(), from_pandas=False)]
        yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])


def usable(vector: Column) -> Column:
    """Neither null nor zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def norm_band(vector: Column) -> Column:
    """The whole part of the norm's logarithm to base 2; no square leaves the range of doubles."""
    largest = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    squares = F.aggregate(vector, F.lit(0.0), lambda a, x: a + (x / largest) * (x / largest))
    # Rounding must not put a norm into the band below its own.
    return F.floor(F.log2(largest) + 0.5 * F.log2(squares) + 1e-9).cast("int")


def shard_plan(sizes: list[tuple[int, int, int]], rule: GraphRule) -> list[tuple[int, int, int, int]]:
    """(dim, band, first shard, shards) from (dim, band, rows), shards of all bands numbered through."""
    total, first, out = sum(n for _, _, n in sizes), 0, []
    for dim, band, n in sorted(sizes):
        shards = max(-(-n // rule.shard_rows), round(rule.least_shards * n / total), 1)
        out.append((dim, band, first, shards))
        first += shards
    return out


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, rule: GraphRule = GraphRule(), vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row that ``is_query`` holds for.

    Executors need this package (``shipping.ship_package`` sends it).
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(embedding).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("id").isNotNull() & F.coalesce(usable(F.col("vector")), F.lit(False)))
    rows = materialize(rows, "vectors")
    # Of equal vectors the k + 1 smallest ids: one of them may be the query's own.
    in_class = Window.partitionBy("vector").orderBy("id")
    few = rows.select("id", "vector").distinct().withColumn("n", F.row_number().over(in_class)).where(F.col("n") <= k + 1)
    classes = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    nodes = classes.withColumn("dim", F.size("vector")).withColumn("band", norm_band(F.col("vector")))
    nodes = materialize(nodes, "vector-classes")
    found_bands = nodes.groupBy("dim", "band").count().collect()  # some two thousand bands to a length at most
    plan = shard_plan([tuple(r) for r in found_bands], rule)
    n_shards = sum(s for *_, s in plan)

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        dim, band = int(frame["dim"].iloc[0]), int(frame["band"].iloc[0])
        order = np.argsort(frame["ids"].map(lambda i: i[0]).to_numpy(), kind="stable")
        ids = [np.asarray(i, np.int64) for i in frame["ids"].iloc[order]]
        shard = build_shard(ids, np.stack(frame["vector"].iloc[order].to_numpy()), band, k, rule)
        return pd.DataFrame({"dim": [dim], "graph": [shard.packed()]})

    bands = spark.createDataFrame(plan, "dim int, band int, first int, shards int")
    dealt = nodes.join(F.broadcast(bands), ["dim", "band"])
    dealt = dealt.withColumn("shard", F.col("first") + F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int"))
    # A task per shard: adaptive execution would put several of these small, costly groups into one.
    spread = dealt.select("dim", "band", "shard", "vector", "ids").repartitionByRange(max(n_shards, 1), "shard")
    graphs = materialize(spread.groupBy("shard").applyInPandas(build, "dim int, graph binary"), "vector-graphs")

    asked = rows.where("asks").select("id", "vector").distinct()
    blocks = max(1, -(-asked.count() // rule.query_block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))

    def searched(block: int) -> DataFrame:
        table = asked.where(F.col("block") == block).select("id", "vector", F.size("vector").alias("dim")).toArrow()
        dims, ids = table.column("dim").to_numpy(), table.column("id").to_numpy()
        flat, ends = table.column("vector").combine_chunks().flatten().to_numpy(), np.cumsum(dims)
        queries = {}
        for dim in np.unique(dims):
            own = dims == dim
            queries[int(dim)] = (ids[own], flat[(ends[own] - dim)[:, None] + np.arange(dim)])
        shared = spark.sparkContext.broadcast(queries)
        found = graphs.mapInArrow(lambda batches: search_batches(batches, shared.value, k), "query_id bigint, vec_id bigint, score double")
        known = F.when(F.isnan("score"), float("-inf")).otherwise(F.col("score"))
        ranked = Window.partitionBy("query_id").orderBy(known.desc(), "vec_id")
        best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
        return best.select("query_id", "rank", "vec_id", "score")

    first, *others = [searched(b) if blocks == 1 else materialize(searched(b), "vector-block") for b in range(blocks)]
    for other in others:
        first = first.unionByName(other)
    return first
