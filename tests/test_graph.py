from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loam.functions import columns
from loam.operators import chains, crossover, graph, overview
from loam.sources.runs import latest_run

ASSETS = "asset_id string, name string, path string, url string, status string, target_id string"


def table(spark, edges, status=None, assets=None):
    ids = sorted({x for e in edges for x in e} | set(assets or ()))
    rows = [(i, (status or {}).get(i, ("N" + i,))[0] if isinstance((status or {}).get(i), tuple) else "N" + i, "/p", "u" + i, (status or {}).get(i, "migrated") if not isinstance((status or {}).get(i), tuple) else (status or {})[i][1], None) for i in ids]
    return graph.dependency_table(spark.createDataFrame(rows, ASSETS), spark.createDataFrame(edges, "child string, parent string"), None, "r", "2001-01-01")


def line(n):
    return [(f"a{k:02d}", f"a{k - 1:02d}") for k in range(1, n)]


def test_extract_edges_takes_first_id_and_known_parents_only(spark):
    rows = [("c", [("Data Set", "i1", "d1"), ("data_set", None, "d2"), ("dataset", "x", "x"), ("data-set", "unknown", None), ("data set", "i1", None)])]
    listing = spark.createDataFrame(rows, "asset_id string, sources array<struct<type:string,inode:string,id:string>>")
    known = spark.createDataFrame([("i1",), ("d2",)], "asset_id string")
    edges = graph.extract_edges(listing, "data-set", ["inode", "id"], known=known)
    assert sorted(map(tuple, edges.collect())) == [("c", "d2"), ("c", "i1")]
    assert {r.parent for r in graph.extract_edges(listing, "data-set", ["inode", "id"], synonyms={"dataset": "data-set"}).collect()} == {"i1", "d2", "x", "unknown"}
    assert graph.extract_edges(listing.limit(0), "data-set", ["inode", "id"]).count() == 0


def test_aliases_make_internal_nodes_visible(spark):
    edges = spark.createDataFrame([("d2", "i1"), ("d3", "i2")], "child string, parent string")
    names = spark.createDataFrame([("i1", "d1"), ("i2", "d2")], "alias string, canonical string")
    nodes = spark.createDataFrame([("d1",), ("d2",), ("d3",)], "asset_id string")
    roles = graph.graph_roles(graph.resolve_aliases(edges, names), nodes)
    assert {r.asset_id: r.role for r in roles.collect()} == {"d1": "ROOT", "d2": "INTERNAL", "d3": "LEAF"}


def test_missing_assets_become_stubs(spark):
    assets = spark.createDataFrame([("a", "A")], "asset_id string, name string")
    referenced = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "asset_id string")
    metadata = spark.createDataFrame([("b", "B")], "asset_id string, name string")
    assert sorted(map(tuple, graph.complete_missing(assets, referenced, metadata).collect()), key=str) == [("a", "A"), ("b", "B"), ("c", None)]


def test_self_loop_and_unreachable_cycle_yield_no_chain(spark):
    dep = table(spark, [("s", "s"), ("x", "y"), ("y", "x"), ("b", "a")])
    assert {r.asset_id for r in chains.walk_chains(dep).collect()} == {"a", "b"}


def test_reachable_cycle_repeats_to_the_cap_and_is_marked(spark):
    dep = table(spark, [("b", "a"), ("b", "c"), ("c", "b")])
    rows = chains.walk_chains(dep, max_hops=5, mark_cycles=True).collect()
    assert max(r.depth for r in rows) == 5
    assert {r.depth: r.cycle for r in rows} == {0: False, 1: False, 2: False, 3: True, 4: True, 5: True}


@pytest.mark.parametrize(("levels", "datasets", "models"), [(5, 1, 1), (6, 1, 1), (10, 1, 1), (11, 0, 1)])
def test_caps_drop_dataset_chains_and_cut_model_chains(spark, levels, datasets, models):
    dep = table(spark, line(levels))
    assert chains.dataset_chains(dep).count() == datasets
    rows = chains.model_chains(dep).collect()
    assert len(rows) == models and rows[0].chain_length == min(levels, 5)


def test_chain_with_null_status_and_name(spark):
    dep = table(spark, line(3), {"a01": (None, None)})
    dep = dep.withColumn("asset_name", F.when(F.col("asset_id") != "a01", F.col("asset_name")))
    row = chains.dataset_chains(dep).first()
    assert (row.chain_path, row.chain_status) == ("Na00 → Na02", "FULLY MIGRATED")


def test_standalone_root_is_a_complete_path(spark):
    assert chains.dataset_chains(table(spark, [("b", "a")], assets=["z"])).count() == 2


def test_fork_details_skip_null_status(spark):
    dep = table(spark, [("b", "a"), ("c", "a"), ("d", "a")], {"a": "not-migrated", "b": "migrated", "c": ("Nc", None), "d": "not-migrated"})
    row = crossover.fork_points(dep).first()
    assert (row.children_migrated, row.children_not_migrated, row.total_children) == (1, 1, 3)
    assert "Nc" not in row.child_details and row.child_details.count("  ||  ") == 1
    assert row.guidance.startswith("ACTION REQUIRED — 1 child")


def test_review_of_terminal_asset_without_status(spark):
    dep = table(spark, [("b", "a")], {"b": ("Nb", None)})
    details = spark.createDataFrame([], "asset_id string, workbook_id string, source_type string")
    assert overview.terminal_assets(dep, details).first().terminal_status == "REVIEW"


def test_empty_inputs(spark):
    dep = table(spark, [("b", "a")]).limit(0)
    assert overview.migration_progress(dep).first().pct_migrated is None
    assert chains.dataset_chains(dep).count() == chains.model_chains(dep).count() == crossover.fork_points(dep).count() == crossover.merge_points(dep).count() == 0
    assert graph.build_summary(dep).first().total_rows == 0
    assert latest_run(dep).count() == 0


def test_latest_run_by_time_and_by_id(spark):
    df = spark.createDataFrame([("b", datetime(2001, 1, 1)), ("a", datetime(2001, 2, 1)), ("a", datetime(2001, 2, 1))], "run_id string, created_at timestamp_ntz")
    assert [latest_run(df, by).count() for by in ("created_at", "run_id")] == [2, 1]


def test_whole_days_and_naive_timestamps(spark):
    row = spark.range(1).select(
        columns.whole_days(F.lit("2001-01-01 23:00").cast("timestamp_ntz"), F.lit("2001-01-02 01:00").cast("timestamp_ntz")).alias("d"),
        columns.naive_timestamp(F.lit("2001-01-01T10:00:00+02:00")).alias("naive"),
        columns.naive_timestamp(F.lit("2001-01-01T10:00:00+02:00"), to_utc=True).alias("utc"),
        columns.naive_timestamp(F.lit("2001-01-01T10:00:00.5Z")).alias("z"),
        columns.org_slug(F.lit("a/b")).alias("slug"),
        columns.normalise_type(F.lit("dataModel")).alias("kind"),
    ).first()
    assert row.d == 0 and row.naive == datetime(2001, 1, 1, 10) and row.utc == datetime(2001, 1, 1, 8)
    assert row.z == datetime(2001, 1, 1, 10, 0, 0, 500000) and row.slug is None and row.kind == "datamodel"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=25))
def test_degree_and_root_invariants(spark, pairs):
    edges = [(f"n{a}", f"n{b}") for a, b in pairs]
    dep = table(spark, edges).select("asset_id", "role", "parent_id", "n_parents", "n_children").toPandas()
    nodes = dep.drop_duplicates("asset_id")
    assert nodes.n_parents.sum() == nodes.n_children.sum() == len(edges)
    assert (dep[dep.role == "ROOT"].parent_id.isna()).all() and dep.parent_id.isna().sum() == (nodes.role == "ROOT").sum()
