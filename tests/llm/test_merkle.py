"""The manifest against a plain tree in Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from gaugeflow.llm import merkle, queries

DOCS = "doc_id bigint, source string, lang string, n_chars int, text string, idx string, tree string, n string"


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row) -> str:
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _paths(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The last node, and for each first node its siblings (before, after) on the way up."""
    paths, of = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(of):
            run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
            paths[i].append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
            of[i] = at // 16
        nodes = [_h(*nodes[k : k + 16]) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def _brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
    trees = {g: _paths([_leaf(r) for r in groups[g]]) for g in order}
    root, above = _paths([trees[g][0] for g in order])
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, g in enumerate(order):
        for row, path in zip(groups[g], trees[g][1], strict=True):
            path = path + above[i]
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            up = _leaf((*row[:4], row[4] and row[4].translate(lower))) if hit else _leaf(row)
            for before, after in path:
                up = _h(before, up, after)
            proof = _h(*(x for step in path for x in step))
            yield row[0], _leaf(row), trees[g][0], root, proof, up, up == root


def _rows(n_sources=19):
    rows = [(i, f"s{i * i % n_sources}" if i % 3 else "hot", "en", i, f"Text number {i} É") for i in range(700)]
    rows += [(i, None, None, None, None if i % 2 else "") for i in range(700, 760)]
    rows += [(5, "copies", "en", 1, "Again AND again")] * 300 + [(None, "copies", "en", 1, "no id")] * 2
    rows += [(5, "copies", "en", 1, "other"), (800, "alone", "fr", 2, "x" * 100_000), (801, "", "", 0, "A:1-")]
    rows += [(900 + i, f"é{i}", "fr", 1, "Z") for i in range(30)] + [(-3, "hot", "en", 1, "\U0001f600 \x00")]
    return rows


@pytest.mark.parametrize("rows", [_rows(), [(1, "a", "en", 1, "B")], [(1, None, None, None, None)] * 2, _rows()[:17]])
def test_query_equals_brute_force(spark, tmp_path, rows):
    docs = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], DOCS).repartition(5)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op12_merkle_manifest"](spark, str(tmp_path))
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.columns == names
    assert Counter(map(tuple, got.collect())) == Counter(_brute(rows))


def test_no_rows(spark):
    made = merkle.build(spark.createDataFrame([], DOCS))
    assert made.root() is None
    assert merkle.proofs(made).count() == 0


def test_layout_does_not_change_the_root(spark):
    docs = spark.createDataFrame([(*r, "", "", "") for r in _rows()], DOCS)
    roots = {merkle.build(docs.repartition(n)).root() for n in (1, 7)}
    assert len(roots) == 1
    assert roots == {next(iter(_brute(_rows())))[3]}


def test_other_groups_and_fields(spark):
    docs = spark.createDataFrame([(i, "a", "x" if i % 2 else "y", i, "t") for i in range(40)], DOCS.rsplit(", ", 3)[0])
    rows = merkle.proofs(merkle.build(docs, group="lang", fields=["doc_id", "text"])).collect()
    assert {r.subroot for r in rows} == {
        _paths([_leaf((i, "t")) for i in range(40) if i % 2 == odd])[0] for odd in (0, 1)
    }
    for row in rows:
        up = row.leaf
        for before, after in row.path:
            up = _h(before, up, after)
        assert up == row.root
