"""The 32-ticket fixture (8 scenarios x 4 tickets, FIXTURES.md F10) through the JSON path.

Our own synthetic rows with the source's shape and time rules; the assertions
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseflow import schemas
from caseflow.operators import curate as C
from caseflow.operators import graph as G
from caseflow.operators import measures as M
from caseflow.sources import landing as LD

NOW = dt.datetime(2026, 6, 17, 18, 54, 59, 8000)  # the fixture clock, in UTC
PRIORITIES = ["1 - Critical", "2 - High", "3 - Moderate", "4 - Low"]
REQUESTERS = ["usr-001", "usr-009", "usr-010", "usr-011", "usr-012"]
SCENARIOS = [  # slug, group, assignee, change
    ("printer-queue", 0, "usr-002", 1), ("mail-delay", 1, "usr-003", 2), ("disk-full", 2, "usr-004", 3),
    ("sso-expiry", 3, "usr-005", 4), ("wifi-drop", 4, "usr-006", 5), ("erp-timeout", 5, "usr-007", 6),
    ("db-lock", 0, "usr-008", 7), ("backup-fail", 1, "usr-002", 7),
]
SITES = ["Oslo", "Bergen", "Tromso", "Bodo"]


def iso(t):
    return t.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"


def ago(days=0, hours=0):
    return NOW - dt.timedelta(days=days, hours=hours)


def user(uid):
    return {"id": uid, "full_name": f"User {uid}", "email": f"{uid}@example.invalid", "title": "Staff",
            "location": None, "department": None}


def build_details():
    docs = []
    for s, (slug, grp, assignee, chg) in enumerate(SCENARIOS):
        for t, site in enumerate(SITES):
            seq = s * 4 + t + 1
            iid = f"inc-{seq:03d}"
            opened = ago(3 * s + t + 2, 8 - t)
            updated = ago(2 * s + t, 2 + t)
            state = ["Resolved", "Closed", "In Progress", "On Hold"][t]
            resolved = ago(2 * s, 1) if t == 0 else ago(2 * s + 1, 3) if t == 1 else None
            prio = PRIORITIES[(s + t) % 4]
            res_target = 8.0 if prio == PRIORITIES[0] else 24.0 if prio == PRIORITIES[1] else 48.0
            elapsed = 6.0 + s + 4.5 * t
            breached = bool(resolved and elapsed > res_target)
            res_html = f"<p>Resolution for <b>{site}</b>: applied the {slug} fix and verified.</p>"
            notes = [
                {"id": f"wn-{seq}-1", "created_at": iso(ago(2 * s + t + 1, 6)), "author": user(assignee),
                 "note_html": f"<p>Triage of {slug} at {site}.</p>", "note_text": None},
                {"id": f"wn-{seq}-2", "created_at": iso(ago(2 * s + t, 5)), "author": user("usr-011"),
                 "note_html": "<p>Requester informed.</p>", "note_text": None},
            ]
            rnotes = [{"id": f"rn-{seq}", "created_at": iso(resolved), "author": user(assignee),
                       "note_html": res_html, "note_text": None}] if resolved else []
            asset = lambda kind, ext: {
                "id": f"{kind}-{seq}", "incident_id": iid, "incident_number": f"INC{1000 + seq:07d}",
                "file_name": f"{slug}-{seq}.{ext}", "content_type": "x", "description": f"{kind} of {slug}",
                "mock_url": f"https://assets.example.invalid/{kind}/{seq}", "uploaded_at": iso(opened),
                "file_size_kb": 10 if kind != "img" else None, "width_px": 800 if kind == "img" else None,
                "height_px": 600 if kind == "img" else None}
            docs.append({
                "id": iid, "number": f"INC{1000 + seq:07d}", "short_description": f"{slug} at {site}",
                "state": state, "priority": prio, "impact": "High", "urgency": "High",
                "opened_at": iso(opened), "updated_at": iso(updated), "resolved_at": iso(resolved) if resolved else None,
                "follow_up_required": t >= 2,
                "requester": user(REQUESTERS[(seq - 1) % 5]), "assignee": user(assignee),
                "assignment_group": {"id": f"grp-{grp}", "name": f"Group {grp}", "description": None,
                                     "escalation_email": None},
                "category": {"id": f"cat-{s}", "name": f"Category {s}", "subcategory": slug},
                "description_html": f"<p>{slug} reported at <strong>{site}</strong>.</p>", "description_text": None,
                "follow_up_reason": "Monitor" if t >= 2 else None,
                "resolution_summary_html": res_html if resolved else None, "resolution_summary_text": None,
                "related_kb_articles": [{"id": f"kb-{s}", "number": f"KB{s:07d}", "title": f"Fix {slug}",
                                         "category": {"id": f"cat-{s}", "name": f"Category {s}", "subcategory": slug},
                                         "audience": "internal", "content_html": f"<p>How to fix {slug}</p>",
                                         "content_text": None, "keywords": [slug], "published_at": None,
                                         "updated_at": None, "relevance_reason": None}],
                "work_notes": notes, "resolution_notes": rnotes,
                "change_requests": [{"id": f"chg-{chg}", "number": f"CHG{chg:07d}", "title": "c", "state": "Done",
                                     "risk": "Low", "planned_start": None, "planned_end": None,
                                     "implemented_at": None,
                                     "relationship_type": "related_fix" if resolved else "candidate_fix"}],
                "slas": [
                    {"id": f"sla-{seq}-1", "name": "Response", "stage": "Achieved",
                     "target_hours": 2.0 if prio == PRIORITIES[0] else 4.0, "elapsed_hours": 1.2 + 0.6 * t,
                     "breached": False},
                    {"id": f"sla-{seq}-2", "name": "Resolution", "stage": "x", "target_hours": res_target,
                     "elapsed_hours": elapsed, "breached": breached}],
                "attachments": [asset("att", "log")], "images": [asset("img", "png")],
                "documents": [asset("doc", "pdf")],
                "external_references": [{"id": f"ref-{seq}", "reference_type": "monitoring", "title": "r",
                                         "url": "https://example.invalid", "source_system": "mon"}],
            })
    return docs


@pytest.fixture(scope="module")
def curated(spark):
    root = LD.work_dir(spark, "fixture32")
    df = spark.createDataFrame(build_details(), schemas.INCIDENT_DETAIL)
    LD.land_details(df, root, "incidents", "2026-06-17")
    detail = LD.read_landed_json(spark, f"{root}/incidents/detail", schemas.INCIDENT_DETAIL)
    return C.curate(detail)


def test_counts(curated):
    n = {k: v.count() for k, v in curated.items()}
    assert n["incidents"] == 32
    assert n["work_notes"] == 64 and n["resolution_notes"] == 16
    assert n["slas"] == 64
    for k in ("attachments", "images", "documents", "external_references", "incident_kb_links",
              "incident_changes"):
        assert n[k] == 32, k
    assert n["kb_articles"] == 8 and n["categories"] == 8
    assert n["assignment_groups"] == 6 and n["change_requests"] == 7
    assert n["users"] == 12
    assert n["retrieval_documents"] == 136


def test_states_and_measures(curated):
    inc = curated["incidents"]
    states = {r.state: r["count"] for r in inc.groupBy("state").count().collect()}
    assert states == {"Resolved": 8, "Closed": 8, "In Progress": 8, "On Hold": 8}
    fact = M.fact_tickets(inc, "2026-06-17")
    r = M.summarize(fact, [], ["open_ticket_count", "avg_resolution_hours", "aging_open_tickets",
                               "follow_up_tickets"]).first()
    assert r.open_ticket_count == 16
    assert r.follow_up_tickets == 16
    assert r.avg_resolution_hours == pytest.approx(137.5)
    assert r.aging_open_tickets == 13


def test_sla_breaches(curated):
    s = curated["slas"]
    assert s.agg(M.sla_breach_rows()).first()[0] == 3
    assert s.agg(M.sla_breach_tickets()).first()[0] == 3
    breached = sorted(r.incident_id for r in s.where("breached").select("incident_id").collect())
    assert breached == ["inc-014", "inc-017", "inc-030"]


def test_replace_vs_keep_open_count(curated):
    fact = M.fact_tickets(curated["incidents"], "2026-06-17")
    keep = {r.state: r.open_ticket_count for r in
            M.summarize(fact, ["state"], ["open_ticket_count"], mode="keep").collect()}
    rep = {r.state: r.open_ticket_count for r in
           M.summarize(fact, ["state"], ["ticket_volume", "open_ticket_count"], mode="replace").collect()}
    assert keep == {"In Progress": 8, "On Hold": 8}
    assert rep == {"Resolved": 16, "Closed": 16, "In Progress": 16, "On Hold": 16}


def test_patterns_and_services(curated):
    rn = curated["resolution_notes"].select("incident_id", F.col("note_text_clean").alias("note_text"))
    _, counts = G.resolution_patterns(rn)
    assert counts.count() == 16  # every label starts "resolution for <site>": no two tickets share one
    _, counts2 = G.resolution_patterns(rn, strip_prefix=r"resolution for \w+")
    assert counts2.count() == 8  # the two resolved tickets of each scenario now share a pattern
    services = curated["incidents"].select("assignment_group_id", "category_id").distinct().count()
    assert services == 8


def test_nest_flatten_round_trip(spark, curated):
    """C7 / B3 property: nesting the flat SLA table and exploding it again is the identity."""
    from caseflow.operators.listing import nest_children
    s = curated["slas"]
    inc = curated["incidents"].select("incident_id")
    nested = nest_children(inc, "incident_id", {"slas": (s, "sla_id")})
    back = nested.select("incident_id", F.explode("slas").alias("x")).select("incident_id", "x.*") \
        .select(*s.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, s.collect()))
