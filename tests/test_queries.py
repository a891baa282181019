"""Every query of the library against its DuckDB twin on small tables."""

import duckdb
import pytest

import compare
from tallyseq.plans import catalog

SF = "/root/testdata/sf0.001"


#: Queries that have no rows on the smallest tables.
LARGER = {"proportional_removal", "removal_budget"}


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows(spark, name):
    sf_dir = "/root/testdata/sf0.01" if name in LARGER else SF
    con = compare.connect(sf_dir)
    assert compare.differences(spark, con, name, sf_dir) == ""
    assert con.execute(f"SELECT count(*) FROM ({catalog.ORACLES[name]})").fetchone()[0] > 0  # no twin is green on nothing


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs_without_twin(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


BRANCHES = {
    "control_comparison": ("neg_flag", 2), "priority_assembly": ("priority", 3), "annotation_levels": ("route", 2), "pathogen_match": ("matched_by", 4), "least_scores": ("origin", 4), "annotation_backfill": ("origin", 1), "platforms": ("platform", 3),
    "rescued_rows": ("tag", 3), "capability_notices": ("lacks", 2), "specimen_names": ("origin", 3), "view_rows": ("bucket", 3), "watched_rows": ("bucket", 6), "groupable_columns": ("preferred", 2),
}


@pytest.mark.parametrize("name", sorted(BRANCHES))
def test_branches_occur(name):
    column, least = BRANCHES[name]
    con = compare.connect("/root/testdata/sf0.01")
    assert con.execute(f"SELECT count(DISTINCT {column}) FROM ({catalog.ORACLES[name]})").fetchone()[0] >= least


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 10
    assert set(e.oracle_sql()) <= set(e.queries())


def test_long_references_in_more_than_twenty_parts(spark, tmp_path):
    """The twin's longest part is that of the first twenty; here only a later one is longer."""
    con = duckdb.connect()
    for t, text in (("supplier", "SELECT unnest([501::BIGINT, 7]) AS s_suppkey, 1 AS s_nationkey"), ("nation", "SELECT 1 AS n_nationkey, 2 AS n_regionkey")):
        con.execute(f"COPY ({text}) TO '{tmp_path}/{t}.parquet'")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got = catalog.QUERIES["sequence_windows"](spark, str(tmp_path)).select("ref_id", "n_windows", "last_end", "n_parts", "longest_part").collect()
    assert sorted(tuple(r) for r in got) == sorted(con.execute(catalog.ORACLES["sequence_windows"]).fetchall())
    assert max(r.n_parts for r in got) == 21


def test_the_longest_of_all_parts(spark, tmp_path):
    """601,000 bases are 21 parts, of which only the last has 28,620 and the others 28,619."""
    con = duckdb.connect()
    for t, text in (("supplier", "SELECT 501::BIGINT AS s_suppkey, 1 AS s_nationkey"), ("nation", "SELECT 1 AS n_nationkey, 2 AS n_regionkey")):
        con.execute(f"COPY ({text}) TO '{tmp_path}/{t}.parquet'")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    rows = catalog.QUERIES["sequence_windows"](spark, str(tmp_path)).select("ref_id", "n_parts", "longest_part").collect()
    assert [tuple(r) for r in rows] == con.execute(f"SELECT ref_id, n_parts, longest_part FROM ({catalog.ORACLES['sequence_windows']})").fetchall() == [(501, 21, 28_620)]


def test_cells_of_a_small_file_are_made_in_several_tasks(spark):
    rows = catalog.QUERIES["groupable_columns"](spark, SF)
    assert "REPARTITION_BY_NUM" in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, column", [("coverage_breadth", "breadth"), ("bins_breadth", "breadth_pct")])
def test_shares_of_bases_round_as_the_twin_does(spark, tmp_path, name, column):
    """9,009 of 144,000 bases are 0.0625625, and 123 of 192,000 are 0.0640625 %: ties only in shortest decimal form."""
    con = duckdb.connect()
    sizes = "VALUES (44::BIGINT, 3003), (92, 41)"
    tables = {
        "supplier": f"SELECT k AS s_suppkey, 1 AS s_nationkey FROM ({sizes}) t(k, q)", "nation": "SELECT 1 AS n_nationkey, 2 AS n_regionkey",
        "lineitem": f"""SELECT 0::BIGINT AS l_orderkey, k AS l_suppkey, 0::BIGINT AS l_partkey, 0 AS l_linenumber, q::DOUBLE AS l_quantity, 0.05 AS l_discount, 'N' AS l_returnflag, 0.02 AS l_tax FROM ({sizes}) t(k, q)"""}
    for t, text in tables.items():
        con.execute(f"COPY ({text}) TO '{tmp_path}/{t}.parquet'")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got = catalog.QUERIES[name](spark, str(tmp_path)).select("ref_id", column).collect()
    want = con.execute(f"SELECT ref_id, {column} FROM ({catalog.ORACLES[name]})").fetchall()
    assert sorted(tuple(r) for r in got) == sorted(want)
