"""Every registered query: same rows and types as its SQL, and a plan without all-pairs joins."""

import re

import pytest

import __spark_entry__ as entry
from workload.compare import compare, connect
from workload.oracle import ORACLE
from workload.queries import REGISTRY
from workload import adapters
from touchline.operators import players


@pytest.fixture(scope="module")
def con(tiny):
    return connect(tiny)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "home_form_momentum" in df.columns


def test_registry_and_sql_match():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(REGISTRY) <= set(entry.queries())
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql_and_joins_no_all_pairs(spark, con, tiny, name):
    df = REGISTRY[name](spark, tiny)
    assert compare(spark, con, name, tiny, df) is None
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert name == "blended_scores" or ("Join Cross" not in plan and "CartesianProduct" not in plan)  # one row each there


def plan_of(spark, tiny, name):
    return REGISTRY[name](spark, tiny)._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_they_need(spark, tiny):
    plan = plan_of(spark, tiny, "entity_names")
    assert "s_acctbal" not in plan and "s_name" in plan
    assert "l_returnflag" not in plan and "o_totalprice" not in plan


def test_lines_are_numbered_and_paired_in_one_shuffle(spark, tiny):
    plan = plan_of(spark, tiny, "line_usage")
    assert plan.count("hashpartitioning(l_orderkey") == 1


@pytest.mark.parametrize("name", ["match_map", "match_review", "review_rows"])
def test_candidates_are_dealt_by_report_once(spark, tiny, name):
    plan = plan_of(spark, tiny, name)
    assert len(re.findall(r"Exchange hashpartitioning\(match_url", plan)) == (2 if name == "review_rows" else 1)  # its join has two sides


def test_every_line_is_accounted_for(spark, tiny):
    used = {r["use"]: r["n_lines"] for r in REGISTRY["line_usage"](spark, tiny).collect()}
    assert sum(used.values()) == spark.read.parquet(f"{tiny}/lineitem.parquet").count()
    assert used["in_match"] == 2 * REGISTRY["features_base"](spark, tiny).count()


@pytest.mark.parametrize("name", ["ragged_split", "team_aggregate", "harmonise_players"])
def test_a_line_is_tokenised_once(spark, tiny, name):
    from touchline.sources import ragged

    lines = adapters.player_lines(spark, tiny)
    split = ragged.split_ragged(lines)
    out = split if name == "ragged_split" else players.harmonise_split(split)
    out = players.team_aggregate(out) if name == "team_aggregate" else out
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_matches_are_found_by_hash_on_teams_and_day(spark, tiny):
    plan = REGISTRY["match_candidates"](spark, tiny)._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoop" not in plan
    assert any("_day" in line and "Join" in line for line in plan.splitlines())


def test_filters_reach_the_scan(spark, tiny):
    plan = spark.read.parquet(f"{tiny}/nation.parquet").where("n_name = 'X'")._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [IsNotNull(n_name), EqualTo(n_name,X)]" in plan.toString()
