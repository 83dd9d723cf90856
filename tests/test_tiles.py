"""Blocks are met tile by tile, with results and memory that do not depend on the size of blocks and tiles."""

import tracemalloc

import brute
import numpy as np
import pytest
from segspark.operators import density, indices, tiles
from segspark.operators.distances import within


@pytest.fixture()
def captured(monkeypatch):
    """The kernels that a call hands to ``meet``."""
    kernels, meet = [], tiles.meet

    def note(cut, kernel, *rest):
        kernels.append(kernel)
        return meet(cut, kernel, *rest)

    monkeypatch.setattr(tiles, "meet", note)
    return kernels


def block(x, **more):
    return {"pid": np.arange(len(x)), "x": x, "copies": np.ones(len(x)), **more}


def peak(kernel, a, b):
    tracemalloc.start()
    kernel(a, b, False)
    top = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return top / 2**20


def test_silhouette_kernel_holds_no_matrix_of_a_block(blobs, captured):
    x, df = blobs
    indices.silhouettes(df.selectExpr("id", "x", "id % 3 AS l"), "x", ["l"], "id")
    rows = np.random.default_rng(0).normal(size=(6000, 8))
    assert peak(captured[0], block(rows, _l0=np.arange(6000) % 3), block(rows + 1, _l0=np.arange(6000) % 3)) < 80


def test_neighbour_kernel_holds_no_matrix_of_a_block(blobs, captured):
    density.neighbour_counts(blobs[1], "x", "id", 1.0)
    rows = np.random.default_rng(0).normal(size=(6000, 8))
    assert peak(captured[0], block(rows), block(rows + 1)) < 80


def test_blocks_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(tiles, "LEAST_ROWS", 1)
    monkeypatch.setattr(tiles, "BLOCK_BYTES", 8 * 100 * 5)
    df = spark.createDataFrame([(i, [float(i)] * 100) for i in range(40)], "pid long, x array<double>")
    assert tiles.cut(df).blocks == 8


def test_a_row_is_shuffled_once_per_block_not_per_small_block(spark, captured):
    rng = np.random.default_rng(1)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(20_000, 4)))], "pid long, x array<double>")
    assert tiles.cut(rows).blocks <= 6


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_within_decides_rows_on_the_radius(metric):
    rng = np.random.default_rng(2)
    a, b = rng.integers(-3, 4, (300, 6)) / 8 + 1e4, rng.integers(-3, 4, (200, 6)) / 8 + 1e4
    gaps = a[:, None, :] - b[None, :, :]
    d = np.abs(gaps).sum(-1) if metric == "manhattan" else np.sqrt((gaps**2).sum(-1))
    assert (within(a, b, metric, 1.0) == (d <= 1.0)).all()


def _scattered(spark, n=400):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal([0, 0], 0.3, (n // 2, 2)), rng.normal([3, 0], 0.3, (n // 4, 2)), rng.uniform(-6, 6, (n // 4, 2))])
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")


@pytest.mark.parametrize("block_rows,tile", [(10_000, 32), (90, 16), (90, 1000)])
def test_results_do_not_depend_on_blocks_and_tiles(spark, monkeypatch, block_rows, tile):
    x, df = _scattered(spark)
    monkeypatch.setattr(tiles, "LEAST_ROWS", block_rows)
    monkeypatch.setattr(tiles, "MOST_ROWS", block_rows)
    monkeypatch.setattr(tiles, "TILE_ROWS", tile)
    monkeypatch.setattr(density, "TREE_ROWS", block_rows)
    monkeypatch.setattr(density, "FOREST_EDGES", 500)
    for metric in ("euclidean", "manhattan"):
        got = {r["id"]: r["cluster"] for r in density.dbscan(df, "x", "id", 0.4, 6, metric).collect()}
        assert [got[i] for i in range(len(x))] == brute.dbscan(x, 0.4, 6, metric).tolist()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    counts = {r["id"]: r["n"] for r in density.neighbour_counts(df, "x", "id", 0.4).collect()}
    assert [counts[i] for i in range(len(x))] == (d <= 0.4).sum(1).tolist()
    core = np.sort(d, axis=1)[:, 4]
    got = {r["id"]: r["core"] for r in density.core_distances(df, "x", "id", 4).collect()}
    assert [got[i] for i in range(len(x))] == pytest.approx(core.tolist())
    reach = np.maximum(d, np.maximum(core[:, None], core[None]))
    tree = density.spanning_tree_weight(df, "x", "id", 4).first()
    assert (tree["n_edges"], tree["weight"]) == (len(x) - 1, pytest.approx(brute.mst_weight(reach)))
    labelled = df.selectExpr("id", "x", "id % 7 AS l", "id % 2 AS h")
    got = {r["labelling"]: r["silhouette"] for r in indices.silhouettes(labelled, "x", ["l", "h"], "id").collect()}
    ids = np.arange(len(x))
    assert got == pytest.approx({"l": brute.silhouette(x, ids % 7).mean(), "h": brute.silhouette(x, ids % 2).mean()})


def test_dense_rows_are_not_counted_beyond_their_own_block(spark, captured, monkeypatch):
    monkeypatch.setattr(tiles, "LEAST_ROWS", 100)
    monkeypatch.setattr(tiles, "MOST_ROWS", 100)
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 2)))], "id long, x array<double>")
    density.dbscan(df, "x", "id", 5.0, 5)
    assert len(captured) == 2  # blocks with themselves, then links


def test_vectors_of_unequal_length_are_refused(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "id long, x array<double>")
    with pytest.raises(Exception, match="one length"):
        density.neighbour_counts(df, "x", "id", 1.0).collect()
