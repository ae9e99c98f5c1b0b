"""Nearest neighbours next to all cosines, and the graph by itself."""

from __future__ import annotations

import numpy as np
import pytest

from wardline.llm import vector_graph as graphs


def nearest(rows: list[tuple], k: int = 5) -> dict[int, list[tuple[int, float]]]:
    """All cosines; rows are (id, vector) that take part, and an id counts with its best score."""
    out = {}
    for query, asked in rows:
        if query % 50:
            continue
        best = dict(out.get(query, []))
        for other, vector in rows:
            if other != query and len(vector) == len(asked):
                a, b = np.array(asked, float), np.array(vector, float)
                score = float((a / np.linalg.norm(a)) @ (b / np.linalg.norm(b)))
                best[other] = max(best.get(other, -2.0), score)
        out[query] = list(best.items())
    return {q: sorted(f, key=lambda x: (-x[1], x[0]))[:k] for q, f in out.items()}


def ask(spark, rows, tmp_path, kind="float") -> dict[int, list[tuple[int, float]]]:
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").selectExpr("*", "1 as label", "2 as shard", "3 as node")
    df.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    found: dict[int, list] = {}
    for r in graphs.op13_vector_graph(spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def same(found, wanted) -> None:
    wanted = {q: f for q, f in wanted.items() if f}
    assert {q: [v for v, _ in f] for q, f in found.items()} == {q: [v for v, _ in f] for q, f in wanted.items()}
    for q, f in wanted.items():
        assert np.allclose([s for _, s in f], [s for _, s in found[q]], atol=1e-12)


def drawn(n: int, dim: int, seed: int = 5) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)


def test_odd_rows(spark, tmp_path):
    vectors = drawn(260, 8).tolist()
    usable = [(i, v) for i, v in enumerate(vectors)]
    # A vector that many share, queries among them, one id twice with the same and once with another vector.
    usable += [(i, vectors[3]) for i in range(300, 420)] + [(300, vectors[3]), (301, vectors[9])]
    usable += [(500, [1.0, 2.0]), (501, [2.0, 1.0]), (550, [3.0] * 5)]
    bad = [(600, None), (650, [0.0] * 8), (700, [1.0, None] * 4), (701, [float("nan")] * 8), (702, [float("inf")] * 8), (750, []), (None, vectors[0])]
    same(ask(spark, [*usable, *bad], tmp_path), nearest(usable))


def test_doubles_at_the_ends_of_their_range(spark, tmp_path):
    vectors = drawn(60, 4).astype(float)
    rows = [(i, (v * (1e300, 1e-300, 1.0)[i % 3]).tolist()) for i, v in enumerate(vectors)]
    found = ask(spark, rows, tmp_path, "double")
    wanted = nearest([(i, v.tolist()) for i, v in enumerate(vectors)])
    assert {q: [v for v, _ in f] for q, f in found.items()} == {q: [v for v, _ in f] for q, f in wanted.items()}


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 0.0])], [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (7, [0.0, 2.0])]])
def test_few_rows(spark, rows, tmp_path):
    same(ask(spark, rows, tmp_path), nearest(rows))


def test_recall_over_shards_and_blocks(spark, monkeypatch):
    """Several shards, several blocks of queries, a crowd of near copies that holds a third of all rows."""
    monkeypatch.setattr(graphs, "SHARD_ROWS", (300, 700))
    monkeypatch.setattr(graphs, "SHARD_FACTOR", 10)
    monkeypatch.setattr(graphs, "BLOCK_QUERIES", 20)
    vectors = drawn(3000, 32)
    vectors[::3] = vectors[0] + 0.05 * vectors[::3]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    index = graphs.build_index(df)
    assert index.select("dim", "shard").distinct().count() > 3
    assert index.selectExpr("explode(ids)").distinct().count() == len(rows)
    found: dict = {}
    for r in graphs.search_index(index, df.where("vec_id % 50 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    wanted = nearest(rows)
    hits = sum(len(found[q] & {v for v, _ in f}) for q, f in wanted.items())
    assert hits >= 0.97 * 5 * len(wanted)


def test_pruning_keeps_the_nearest_and_no_one_behind_a_kept_one():
    vectors = graphs.unit(drawn(400, 12).astype(float)).astype(np.float32)
    graph = graphs.Graph(vectors, np.full((400, graphs.SLOTS), -1, np.int32), np.arange(4, dtype=np.int32))
    nodes = np.arange(10, dtype=np.int32)
    kept = graph._pruned(nodes, np.tile(np.arange(400, dtype=np.int32), (10, 1)))
    for node in nodes.tolist():
        squares = ((vectors - vectors[node]) ** 2).sum(axis=1)
        wanted: list[int] = []
        # Candidates beyond three times the slots are not looked at.
        for c in np.argsort(squares, kind="stable")[1 : 3 * graphs.SLOTS + 1].tolist():
            apart = [((vectors[w] - vectors[c]) ** 2).sum() for w in wanted]
            if len(wanted) < graphs.DEGREE and all(graphs.ALPHA**2 * a > squares[c] for a in apart):
                wanted.append(c)
        assert kept[node][kept[node] >= 0].tolist() == wanted


def test_edges_stay_within_their_slots():
    graph = graphs.Graph.build(graphs.unit(drawn(1500, 6).astype(float)).astype(np.float32))
    degrees = (graph.edges >= 0).sum(axis=1)
    assert degrees.max() <= graphs.DEGREE and degrees.min() >= 1
    assert all(len(set(e[e >= 0])) == (e >= 0).sum() and i not in e for i, e in enumerate(graph.edges))
