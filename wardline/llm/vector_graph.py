"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Vectors are dealt to shards by hash. In each shard a graph grows in rounds of doubling size: a greedy search
for each new vector, over the graph so far and from the nearest of some nodes drawn evenly, proposes neighbours, and relaxed
distance pruning keeps of them, nearest first, those that no kept one is ``ALPHA`` times nearer to than the
vector itself. Edges run both ways; a node that has gathered more than its slots is pruned in the same way. The
graphs are written, and a beam search asks each of them for each query, in blocks of queries; what the
shards found is put in order by cosines of the original vectors in double precision.

Equal vectors are one node, however many there are: a node lists the smallest ids that an answer of
``k`` can name, so a vector that a third of all rows hold is no hot spot, and no row is out of reach.
Rows in a shard grow as the square root of all rows, within bounds, so that neither the shards that a query
visits nor a shard's memory grow with the data alone.

Defined cases: vectors that are null, zero, or hold null or non-finite components take no part, neither do null
ids. Vectors of different length are never neighbours. Equal rows count once. An id with several vectors is a candidate with
each and is asked with each; an answer names an id once, by its best score. Ties go to the smaller id. An empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import prepare, read_table
from wardline.session import materialize

# Rows of a shard: this many times the square root of all rows, within the bounds.
SHARD_FACTOR = 48
SHARD_ROWS = 2_048, 65_536
# Bytes of a shard's vectors in double precision, which bounds its rows where vectors are long.
SHARD_BYTES = 64_000_000
# Queries that search a shard in one task.
BLOCK_QUERIES = 8_192

DEGREE = 32
SLOTS = 56
ALPHA = 1.2
BUILD_BEAM = 64
SEARCH_BEAM = 192
# Nodes that a search opens at a time.
WIDTH = 4
# The first nodes are linked by comparing all of them; searches begin at the nearest of them.
FIRST_NODES = 256
# Nodes or queries that are worked on side by side, fewer of long vectors: so many components; and
# bytes that the marks of visited nodes take.
SIDE_BY_SIDE = 512
SIDE_COMPONENTS = 32_768
MARK_BYTES = 24_000_000


# --- one shard ---


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1, in double precision; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


class Graph:
    """Directed graph over unit vectors; ``edges`` has SLOTS columns, -1 where there is none. Searches begin at the nearest of ``starts``."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray, starts: np.ndarray):
        self.vectors, self.edges, self.starts = vectors, edges, starts
        self.side_by_side = max(16, min(SIDE_BY_SIDE, SIDE_COMPONENTS // vectors.shape[1]))

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        """``vectors`` in single precision; the order in which they are added is drawn, always the same."""
        n = len(vectors)
        order = np.random.default_rng(n).permutation(n).astype(np.int32)
        at = min(n, FIRST_NODES)
        graph = cls(vectors, np.full((n, SLOTS), -1, np.int32), order[:at])
        graph._link_all(order[:at])
        while at < n:
            size = min(at, graph.side_by_side, n - at)
            graph._add(order[at : at + size])
            at += size
        crowded = np.flatnonzero((graph.edges >= 0).sum(axis=1) > DEGREE).astype(np.int32)
        for low in range(0, len(crowded), graph.side_by_side):
            part = crowded[low : low + graph.side_by_side]
            graph.edges[part] = graph._pruned(part, graph.edges[part])
        return graph

    def _link_all(self, nodes: np.ndarray) -> None:
        for low in range(0, len(nodes), 32):
            part = nodes[low : low + 32]
            self.edges[part] = self._pruned(part, np.tile(nodes, (len(part), 1)))

    def _add(self, nodes: np.ndarray) -> None:
        found, opened = self.search(self.vectors[nodes], BUILD_BEAM)
        # What was opened on the way links far parts, what was found in the end near ones.
        self.edges[nodes] = self._pruned(nodes, np.hstack([found, opened]))
        self._link_back(nodes)

    def _link_back(self, nodes: np.ndarray) -> None:
        """An edge from each neighbour to the new node."""
        target = self.edges[nodes].ravel()
        source = np.repeat(nodes, SLOTS)[target >= 0]
        target = target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        filled = (self.edges >= 0).sum(axis=1) if len(target) else None
        place = np.arange(len(target)) - np.searchsorted(target, target)
        slot = filled[target] + place if len(target) else place
        fits = slot < SLOTS
        self.edges[target[fits], slot[fits]] = source[fits]
        late = np.unique(target[~fits])
        for low in range(0, len(late), self.side_by_side):
            part = late[low : low + self.side_by_side]
            own = np.isin(target, part) & ~fits
            row, column = np.searchsorted(part, target[own]), (slot[own] - SLOTS)
            more = np.full((len(part), int(column.max()) + 1), -1, np.int32)
            more[row, column] = source[own]
            self.edges[part] = self._pruned(part, np.hstack([self.edges[part], more]))

    def _pruned(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Of the candidates of each node (-1: none) the DEGREE that relaxed pruning keeps, in SLOTS columns."""
        candidates = _without_repeats(np.where(candidates == nodes[:, None], -1, candidates))
        own = self.vectors[nodes]
        vectors = self.vectors[np.maximum(candidates, 0)]
        distance = np.where(candidates >= 0, 1 - np.einsum("nd,ncd->nc", own, vectors), np.inf)
        # Nearest first; what lies beyond three times the slots never counts.
        order = np.argsort(distance, axis=1, kind="stable")[:, : 3 * SLOTS]
        candidates, distance = np.take_along_axis(candidates, order, 1), np.take_along_axis(distance, order, 1)
        vectors = np.take_along_axis(vectors, order[:, :, None], 1)
        open_, rows = np.isfinite(distance), np.arange(len(nodes))
        out = np.full((len(nodes), SLOTS), -1, np.int32)
        for slot in range(DEGREE):
            best = np.argmax(open_, axis=1)
            some = open_[rows, best]
            if not some.any():
                break
            out[some, slot] = candidates[rows, best][some]
            between = 1 - np.einsum("nd,ncd->nc", vectors[rows, best], vectors)
            # Distances here are half the squares of those that ALPHA relaxes.
            open_ &= ~((ALPHA * ALPHA * between <= distance) & some[:, None])
            open_[rows, best] = False
        return out

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query the nearest nodes found, nearest first, and the nodes opened on the way; -1 for none."""
        side_by_side = max(1, min(self.side_by_side, MARK_BYTES // max(len(self.vectors), 1)))
        parts = [self._search(queries[low : low + side_by_side], beam) for low in range(0, len(queries), side_by_side)]
        width = max(opened.shape[1] for _, opened in parts)
        padded = [np.pad(opened, ((0, 0), (0, width - opened.shape[1])), constant_values=-1) for _, opened in parts]
        return np.vstack([found for found, _ in parts]), np.vstack(padded)

    def _search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n, rows = len(queries), np.arange(len(queries))[:, None]
        seen = np.zeros((n, len(self.vectors)), bool)
        ids = np.full((n, beam), -1, np.int32)
        distance = np.full((n, beam), np.inf, np.float32)
        closed = np.ones((n, beam), bool)
        near = 1 - queries @ self.vectors[self.starts].T
        first = min(len(self.starts), beam // 2)
        order = np.argsort(near, axis=1, kind="stable")[:, :first]
        ids[:, :first], distance[:, :first] = self.starts[order], np.take_along_axis(near, order, 1)
        closed[:, :first] = False
        seen[rows, ids[:, :first]] = True
        opened = []
        while not closed.all():
            # The nearest that are still to be opened: closed ones sort behind.
            best = np.argsort(closed, axis=1, kind="stable")[:, :WIDTH]
            nodes = np.where(np.take_along_axis(closed, best, 1), -1, np.take_along_axis(ids, best, 1))
            np.put_along_axis(closed, best, True, 1)
            opened.append(nodes)
            near = np.where((nodes >= 0)[:, :, None], self.edges[np.maximum(nodes, 0)], -1).reshape(n, -1)
            near = _without_repeats(np.where((near >= 0) & ~seen[rows, np.maximum(near, 0)], near, -1))
            # Columns that no query needs are dropped: repeats sort to the end.
            near = near[:, : max(1, int((near >= 0).sum(axis=1).max()))]
            fresh = near >= 0
            row, column = np.nonzero(fresh)
            seen[row, near[row, column]] = True
            far = np.full(near.shape, np.inf, np.float32)
            far[row, column] = 1 - np.einsum("nd,nd->n", queries[row], self.vectors[near[row, column]])
            ids, distance = np.hstack([ids, near]), np.hstack([distance, far])
            closed = np.hstack([closed, ~fresh])
            order = np.argsort(distance, axis=1, kind="stable")[:, :beam]
            ids, distance = np.take_along_axis(ids, order, 1), np.take_along_axis(distance, order, 1)
            closed = np.take_along_axis(closed, order, 1)
        return np.where(np.isfinite(distance), ids, -1), np.hstack(opened)


def _without_repeats(nodes: np.ndarray) -> np.ndarray:
    """Each row sorted downwards, repeats and -1 at the end as -1."""
    nodes = -np.sort(-nodes, axis=1)
    nodes[:, 1:][nodes[:, 1:] == nodes[:, :-1]] = -1
    return -np.sort(-nodes, axis=1)


# --- whole tables ---


def _given(rows: DataFrame, id_col: str, vector_col: str, id_name: str, vector_name: str) -> DataFrame:
    """Ids and vectors that take part; vectors of doubles unless they are of floats."""
    kind = "float" if dict(rows.dtypes)[vector_col] == "array<float>" else "double"
    vector = F.col(f"`{vector_col}`").cast(f"array<{kind}>")
    given = rows.select(F.col(f"`{id_col}`").cast("bigint").alias(id_name), vector.alias(vector_name))
    return given.where(F.col(id_name).isNotNull() & _usable(F.col(vector_name)))


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def build_index(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5) -> DataFrame:
    """The graphs of all shards: one row per different vector, with dim, shard, node, vector, ids (the smallest that hold it,
    one more than ``k``), edges (nodes of the shard) and start (whether searches may begin at it)."""
    prepare(rows.sparkSession)
    given = _given(rows, id_col, vector_col, "id", "vector")
    # Of equal vectors the smallest ids, counted once each; what is beyond them is cut off before the shuffle.
    place = F.dense_rank().over(Window.partitionBy("vector").orderBy("id"))
    nodes = (
        given.withColumn("place", place)
        .where(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_set("id")).alias("ids"))
    )
    nodes = materialize(nodes, "vector-nodes")
    count, dim = nodes.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    least, most = SHARD_ROWS
    size = int(min(most, SHARD_BYTES / (8 * dim), max(least, SHARD_FACTOR * count**0.5)))
    shards = max(1, -(-count // max(size, 1)))
    dealt = nodes.select(
        F.size("vector").alias("dim"), F.pmod(F.xxhash64(F.col("ids")[0], F.size("vector")), F.lit(shards)).alias("shard"), "vector", "ids"
    )

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([("first", "ascending")])
        vectors = _matrix(table.column("vector"))
        graph = Graph.build(unit(vectors).astype(np.float32))
        n = len(vectors)
        edges = [e[e >= 0] for e in graph.edges]
        limits = np.concatenate([[0], np.cumsum([len(e) for e in edges])])
        joined = np.concatenate(edges) if n else np.zeros(0, np.int32)
        return pa.table(
            {
                "dim": table.column("dim"),
                "shard": table.column("shard"),
                "node": pa.array(np.arange(n, dtype=np.int32)),
                "vector": table.column("vector"),
                "ids": table.column("ids"),
                "edges": pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(joined, pa.int32())),
                "start": pa.array(np.isin(np.arange(n), graph.starts)),
            }
        )

    schema = f"dim int, shard bigint, node int, vector {dict(dealt.dtypes)['vector']}, ids array<bigint>, edges array<int>, start boolean"
    keyed = dealt.withColumn("first", F.col("ids")[0])
    return materialize(keyed.groupBy("dim", "shard").applyInArrow(build, schema), "vector-graphs")


def search_index(index: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5) -> DataFrame:
    """The ``k`` nearest vectors found for each query, other than its own id: query_id, rank, vec_id, score."""
    prepare(index.sparkSession)
    asked = _given(queries, id_col, vector_col, "query_id", "asked").distinct()
    asked = materialize(asked.withColumn("dim", F.size("asked")), "vector-queries")
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    # Each shard meets each block of queries once.
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id", "asked"), F.lit(blocks)))
    last = index.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0]
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))))
    shards = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))

    def search(nodes: pa.Table, asked: pa.Table) -> pa.Table:
        if not nodes.num_rows or not asked.num_rows:
            return _answers([], [], [])
        nodes = nodes.sort_by([("node", "ascending")])
        vectors = unit(_matrix(nodes.column("vector")))
        edges = np.full((len(vectors), SLOTS), -1, np.int32)
        lists = nodes.column("edges").combine_chunks()
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
        column = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        edges[np.repeat(np.arange(len(vectors)), lengths), column] = lists.flatten().to_numpy(zero_copy_only=False)
        graph = Graph(vectors.astype(np.float32), edges, np.flatnonzero(nodes.column("start").to_numpy()).astype(np.int32))
        wanted = unit(_matrix(asked.column("asked")))
        found, _ = graph.search(wanted.astype(np.float32), max(SEARCH_BEAM, 4 * (k + 1)))
        return _nearest(asked.column("query_id").to_pylist(), wanted, found, vectors, nodes.column("ids").to_pylist(), k)

    schema = "query_id bigint, vec_id bigint, score double"
    found = shards.groupBy("dim", "shard", "block").cogroup(asked.groupBy("dim", "shard", "block")).applyInArrow(search, schema)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _nearest(query_ids, wanted, found, vectors, ids, k) -> pa.Table:
    """Of the nodes found for each query the ``k`` ids with the largest cosine, the smaller of equals first."""
    out_query, out_id, out_score = [], [], []
    for i, query in enumerate(query_ids):
        nodes = found[i][found[i] >= 0]
        scores = (vectors[nodes] * wanted[i]).sum(axis=1)
        pairs = sorted((-s, v) for s, node in zip(scores.tolist(), nodes.tolist()) for v in ids[node] if v != query)[:k]
        out_query += [query] * len(pairs)
        out_id += [v for _, v in pairs]
        out_score += [-s for s, _ in pairs]
    return _answers(out_query, out_id, out_score)


def _answers(query, vec, score) -> pa.Table:
    return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.float64())})


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1)


def op13_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return search_index(build_index(vectors), vectors.where(F.col("vec_id") % 50 == 0))
