import contextlib
import io

import numpy as np
import pytest

from veloflow.operators.edge_cells import candidate_pairs_stored, match_nearest_stored, store_edge_cells
from veloflow.operators.spatial import candidate_pairs, match_nearest_edge

LIMIT = 50.0


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Scattered and crowded places and lines, copies, a line across all, missing lines, keys and positions; stored for 80 m."""
    rng = np.random.default_rng(3)
    spots = [*rng.uniform(0, 1000, (60, 2)), *(500 + rng.normal(0, 2, (40, 2)))]
    counters = spark.createDataFrame([*[(i, float(x), float(y)) for i, (x, y) in enumerate(spots)], (900, None, 1.0), (901, 9000.0, 9000.0)], "counter_id int, longitude double, latitude double")
    lines = [(i, i * 10, [(float(x), float(y)), (float(x + dx), float(y + dy))]) for i, (x, y, dx, dy) in enumerate(zip(*rng.uniform(0, 1000, (2, 120)), *rng.normal(0, 40, (2, 120)), strict=True))]
    lines += [(200 + i, i, [(float(x), float(y)), (float(x + 1), float(y))]) for i, (x, y) in enumerate(500 + rng.normal(0, 2, (60, 2)))]
    lines += [(500, 1, lines[0][2]), (501, 2, None), (502, 3, []), (503, 4, [(-300.0, 20.0), (1400.0, 25.0)]), (None, 5, lines[1][2])]
    edges = spark.createDataFrame(lines, "edge_id int, base_id int, line array<struct<x:double,y:double>>")
    cells = store_edge_cells(edges, "test_edge_cells", 80.0, ["base_id"], path=str(tmp_path_factory.mktemp("cells") / "t"), buckets=4, crs="plane")
    yield counters, edges, cells
    spark.sql("DROP TABLE test_edge_cells")


def rows(df):
    key = lambda r: tuple((v is None, v) for v in r)
    return sorted((tuple(r) for r in df.collect()), key=key)


@pytest.mark.parametrize("dense", [None, 20])
def test_nearest_equals_the_join_on_lines(tables, dense):
    counters, edges, cells = tables
    want = rows(match_nearest_edge(counters, edges, LIMIT, ["base_id"], crs="plane").select("counter_id", "nearest_edge_dist_m", "base_id"))
    assert rows(match_nearest_stored(counters, cells, LIMIT, dense=dense).select("counter_id", "nearest_edge_dist_m", "base_id")) == want
    assert any(r[2] is not None for r in want) and any(r[2] is None for r in want)


@pytest.mark.parametrize("limit", [LIMIT, 80.0])
def test_pairs_equal_the_join_on_lines(tables, limit):
    counters, edges, cells = tables
    columns = ["counter_id", "edge_id", "base_id", "distance"]
    want = rows(candidate_pairs(counters, edges, limit, ["base_id"], crs="plane").select(columns))
    assert rows(candidate_pairs_stored(counters, cells, limit).select(columns)) == want and want


def test_edges_are_not_shuffled(spark, tables):
    counters, _, cells = tables
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            candidate_pairs_stored(counters, cells, LIMIT).explain("formatted")
            match_nearest_stored(counters, cells, LIMIT, dense=None).explain("formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    plan = text.getvalue()
    shuffled = [line for line in plan.splitlines() if "hashpartitioning(cx" in line]
    assert plan.count("Bucketed: true") == 2 and len(shuffled) == 2  # in each plan the cells' side only is bucketed, the locations' side only moves


def test_limits_beyond_the_cells_are_refused(tables):
    counters, _, cells = tables
    with pytest.raises(ValueError):
        candidate_pairs_stored(counters, cells, 81.0)
    with pytest.raises(ValueError):
        match_nearest_stored(counters, cells, 81.0)


def test_empty_tables(spark, tables, tmp_path):
    counters, edges, cells = tables
    assert candidate_pairs_stored(counters.limit(0), cells, LIMIT).count() == 0
    none = store_edge_cells(edges.limit(0), "test_no_cells", LIMIT, ["base_id"], path=str(tmp_path / "none"), buckets=2, crs="plane")
    found = match_nearest_stored(counters, none, LIMIT)
    assert found.count() == counters.count() and found.where("base_id is not null").count() == 0
    spark.sql("DROP TABLE test_no_cells")
