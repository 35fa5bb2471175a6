"""Sums along sorted arcs, against the full matrix of the arcs; and what a round stores."""

import numpy as np
import pyarrow as pa
import pytest

from rookery.operators import packed
from rookery.operators.adsorption import run_adsorption

WIDTH = 5


def arcs_of(src, dst, w, fan_limit, kind=packed.NOW):
    rows = pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64()), "w": pa.array(w, pa.float64())})
    key = pa.scalar(0, pa.int64()), pa.scalar(kind, pa.int32())
    return packed.listed(fan_limit)(key, rows)


@pytest.mark.parametrize("fan_limit, buffer", [(1, 1 << 16), (7, 3 * WIDTH), (1 << 16, 3 * WIDTH), (1 << 16, 1)])
def test_sums_along_sorted_arcs(monkeypatch, fan_limit, buffer):
    monkeypatch.setattr(packed, "BUFFER", buffer)
    rng = np.random.default_rng(1)
    src, dst, w = rng.integers(0, 30, 200), rng.integers(0, 12, 200), rng.random(200)
    dst[:60] = 3  # a node of many in-edges
    table = arcs_of(src, dst, w, fan_limit)
    nodes = np.array([0, 2, 3, 7, 11, 20, 29])  # the others have no vectors
    matrix = rng.random((len(nodes), WIDTH))
    targets, sums = packed._carried((nodes, matrix), packed._lists(table, packed.NOW))
    full = np.zeros((30, WIDTH))
    full[nodes] = matrix
    want = np.zeros((12, WIDTH))
    np.add.at(want, dst, full[src] * w[:, None])
    assert sorted(targets.tolist()) == targets.tolist() == np.flatnonzero(want.any(axis=1)).tolist()
    assert sums == pytest.approx(want[targets])


def test_no_arcs_and_no_vectors():
    empty = np.empty(0, np.int64), np.empty((0, WIDTH))
    table = arcs_of([1, 2], [3, 3], [0.5, 0.5], 10)
    assert [len(x) for x in packed._carried(empty, packed._lists(table, packed.NOW))] == [0, 0]
    assert [len(x) for x in packed._carried(empty, packed._lists(table, packed.BEFORE))] == [0, 0]


@pytest.mark.parametrize("share", [0.05, 1.0])
def test_slabs_round_trip(monkeypatch, share):
    monkeypatch.setattr(packed, "SLAB_CELLS", 4 * WIDTH)
    rng = np.random.default_rng(2)
    nodes, matrix = np.arange(0, 200, 4), rng.random((50, WIDTH)) * (rng.random((50, WIDTH)) < share)
    rows = packed.slabs(0, (nodes, matrix), nodes[:2], np.ones(2))
    assert sum(len(u) for u in rows["users"].to_pylist()) == 2
    back, weights = packed._summed(list(packed._slab_parts(rows, WIDTH)), WIDTH)
    some = matrix.any(axis=1)
    assert back.tolist() == nodes[some].tolist() and (weights == matrix[some]).all()


def test_a_round_stores_slabs_and_no_row_for_each_node(spark):
    users = [f"u{i}" for i in range(40)]
    edges = [("user", a, "user", b, 0.5) for i, a in enumerate(users) for b in (users[i - 1], users[i - 2])]
    edges = spark.createDataFrame(edges, "src_type string, src string, dst_type string, dst string, w double")
    run = run_adsorption(edges, spark.createDataFrame([(u,) for u in users], "username string"), 3, None)
    assert run.vectors.select("node").distinct().count() == len(users)
    assert spark.read.parquet(run.scratch.path("labels_3")).count() == 1
