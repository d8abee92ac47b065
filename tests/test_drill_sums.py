"""Child rows are summed by hash before anything sorts or carries an axis."""

import re

from pyspark.sql import functions as F

from caseflow.operators import drill as D


def test_child_rows_are_summed_without_a_sort(spark, capsys):
    tickets = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "incident_id long, grp string")
    child = spark.range(0, 3000, 1, 3).select((F.col("id") % 4).alias("incident_id"), (F.col("id") % 2 == 0).alias("breached"))
    out = D.drill_across(tickets, {"sla": child}, ["grp"], ["ticket_volume", "sla_breach_rows", "sla_breach_tickets"],
                         sets=D.rollup_sets(["grp"]))
    out.explain()
    plan = capsys.readouterr().out.splitlines()
    depth = [len(re.match(r"[\s:|+*()\d-]*", x).group()) for x in plan]
    at = next(i for i, x in enumerate(plan) if "Range" in x and "3000" in x)
    above, least = [], depth[at]
    for i in range(at - 1, -1, -1):
        if depth[i] < least:
            least = depth[i]
            if "Exchange" in plan[i]:
                break
            above.append(plan[i])
    assert any("HashAggregate" in x for x in above) and not any("Sort" in x for x in above)
    assert {(r.grp, r.grp_is_total): tuple(r)[2:] for r in out.collect()} == {
        ("a", False): (1, None, None), ("b", False): (1, 750, 1), (None, False): (1, 750, 1), (None, True): (3, 1500, 2)}
