"""The Merkle manifest next to a tree built by hand."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from llm.samples import SCHEMA, table

from wardline.llm import merkle


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row: tuple) -> str:
    framed = []
    for i in (0, 3, 2, 4, 1):
        value = row[i]
        framed.append(b"-" if value is None else b"%d:" % len(str(value).encode()) + str(value).encode())
    return hashlib.sha256(b"".join(framed)).hexdigest()


def levels(digests: list[str]) -> list[list[str]]:
    out = [digests]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def by_hand(rows: list[tuple]) -> list[tuple]:
    """Rows are (doc_id, text, lang, source, n_chars)."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([m[2] for m in sorted(groups[g], key=lambda m: m[:3])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for number, name in enumerate(names):
        for place, (_, _, own, row) in enumerate(sorted(groups[name], key=lambda m: m[:3])):
            path = []
            for tree, at in ((trees[name], place), (top, number)):
                for level in tree[:-1]:
                    path.append((at % 2 == 1, level[at ^ 1] if at ^ 1 < len(level) else ""))
                    at //= 2
            altered = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                altered = (*row[:4], row[4] + 1)
            folded = leaf(altered)
            for left, other in path:
                folded = digest(other + folded if left else folded + other)
            root = top[-1][0]
            out.append((row[0], own, trees[name][-1][0], root, digest("".join(d for _, d in path)), folded, folded == root))
    return sorted(out, key=str)


def query(spark, rows, tmp_path) -> list[tuple]:
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as tree", "1 as node", "2 as position")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return table(merkle.op11_merkle_manifest(spark, str(tmp_path)))


def test_odd_rows(spark, rows, tmp_path):
    found = query(spark, rows, tmp_path)
    assert found == by_hand(rows)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_few_rows(spark, n, tmp_path):
    rows = [(i, "t", "en", None, i) for i in range(n)]
    assert query(spark, rows, tmp_path) == by_hand(rows)


def test_groups_of_every_size(spark, tmp_path):
    """A group beyond one stride, groups of one row, as many groups as take a tall tree, and repeated rows."""
    rows = [(i, str(i), "big", "s", i) for i in range((1 << merkle.STRIDE) + 3)]
    rows += [(i, "t", f"é{i}", None, i) for i in range(40)] + [(7, "", "", "s", None)] * 5
    assert query(spark, rows, tmp_path) == by_hand(rows)


def test_rounds_without_broadcast(spark, tmp_path):
    rows = [(i, str(i), ("a", None, "b")[i % 3], "s", i) for i in range(200)]
    manifest = merkle.build_manifest(spark.createDataFrame(rows, SCHEMA))
    joined = merkle.proofs(manifest, broadcast_bytes=0)
    paths = {r.id: (r.digest, r.path) for r in joined.collect()}
    for row in rows:
        own, path = paths[row[0]]
        folded = own.hex()
        assert folded == leaf(row)
        for step in path:
            folded = digest((step.left or b"").hex() + folded + (step.right or b"").hex())
        assert folded == manifest.root


def test_other_columns_and_names(spark):
    rows = [(3, "x"), (1, None), (2, "y")]
    df = spark.createDataFrame(rows, "`my id` bigint, body string").selectExpr("*", "'g' as part")
    manifest = merkle.build_manifest(df, id_col="my id", group_col="part", fields=("my id", "body"))
    framed = [b"1:1-", b"1:21:y", b"1:31:x"]
    assert manifest.root == levels([hashlib.sha256(f).hexdigest() for f in framed])[-1][0]
    assert not {r.up_node for r in manifest.nodes.collect()} & {None}
