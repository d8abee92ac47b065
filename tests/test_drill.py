"""Measures across facts: subtotals, blanks, orphans, null keys and a hot ticket."""

import pytest

from caseflow.operators import drill as D

TICKETS = ("incident_id long, grp string, part_tickets string, is_open boolean, is_resolved boolean, age_days long, "
           "resolution_hours double, resolved_date_key int")


def tickets(spark, rows):
    return spark.createDataFrame(rows, TICKETS)


def sla(spark, rows):
    return spark.createDataFrame(rows, "incident_id long, breached boolean")


@pytest.fixture(scope="module")
def facts(spark):
    t = tickets(spark, [
        (1, "a", "x", True, False, 9, None, None), (2, "a", "y", False, True, 3, 4.0, 20010101),
        (3, "b", "x", False, True, 5, 8.0, 20010102), (4, None, "x", True, False, 1, None, None),
        (None, "b", "x", True, False, 8, None, None), (None, "b", "x", True, False, 8, None, None)])
    s = sla(spark, [(1, True)] * 500 + [(1, False), (2, False), (4, True), (99, True), (None, True)])
    links = spark.createDataFrame([(1, 7), (1, 8), (3, 7)], "incident_id long, kb_article_id long")
    return t, {"sla": s, "article": links}


def test_facts_are_stacked_not_joined(facts):
    t, children = facts
    out = D.drill_across(t, children, ["grp"], ["ticket_volume", "open_ticket_count", "avg_resolution_hours",
                                                "sla_breach_rows", "sla_breach_tickets", "sla_breach_rate",
                                                "kb_article_reuse_count"], sets=D.rollup_sets(["grp"]))
    got = {(r.grp, r.grp_is_total): tuple(r)[2:] for r in out.collect()}
    assert got == {
        ("a", False): (2, 1, 4.0, 500, 1, 0.5, 2),
        ("b", False): (3, 2, 8.0, None, None, None, 1),  # two tickets without a key are two tickets
        # the blank member: ticket 4, the orphan 99 and the row without a key, which is no ticket
        (None, False): (1, 1, None, 3, 2, 1.0, None),
        (None, True): (6, 4, 6.0, 503, 3, 0.75, 3)}


def test_all_blank_rows_go_and_names_may_clash(facts):
    t, children = facts
    out = D.drill_across(t, children, ["grp", "part_tickets"], ["kb_article_reuse_count"],
                         sets=[("grp", "part_tickets"), ("part_tickets",)])
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("a", "x", False, False, 2), ("b", "x", False, False, 1), (None, "x", True, False, 3)], key=str)


def test_no_axes_and_empty_input(facts, spark):
    t, children = facts
    assert D.drill_across(t, children, [], ["ticket_volume"]).first().ticket_volume == 6
    none = {k: v.limit(0) for k, v in children.items()}
    assert D.drill_across(t.limit(0), none, ["grp"], ["ticket_volume", "sla_breach_rate"], sets=[("grp",), ()]).count() == 0


def test_unknown_measures_and_missing_facts_are_refused(facts):
    t, children = facts
    with pytest.raises(ValueError, match="measures"):
        D.drill_across(t, children, ["grp"], ["distinct_articles"])
    with pytest.raises(ValueError, match="asset"):
        D.drill_across(t, children, ["grp"], ["ticket_asset_count"])


def test_no_fact_is_joined_with_another(facts):
    t, children = facts
    plan = D.drill_across(t, children, ["grp"], ["ticket_volume", "sla_breach_rows", "kb_article_reuse_count"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 3
