"""Registered question-catalogue queries (M1-M20) and evidence queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions.columns import asset_type_from_name
from caseflow.operators import evidence as EV
from caseflow.operators import measures as M
from caseflow.operators import nesting as NS
from caseflow.operators.graph import resolution_patterns
from caseflow.plans.oracles import initcap_sql, pattern_label_sql, sql
from caseflow.plans import retrieval_queries  # noqa: F401  (registers the J oracles used below)
from caseflow.plans.registry import ORACLES, register
from caseflow.plans.measure_queries import sla_fact, ticket_fact
from caseflow.sources.domain import AS_OF, KB_URL_PREFIX, TicketModel, graph_inputs, is_open, is_resolved, narrowed



def _asof() -> F.Column:
    return F.lit(str(AS_OF)).cast("timestamp_ntz")


def _days_before(n: int) -> F.Column:
    return _asof() - F.make_dt_interval(F.lit(n), F.lit(0), F.lit(0), F.lit(0))


#: Day that M2 asks about.
WEEK_ASKED = "2001-07-29 23:59:59"


@register("m01_open_by_group_priority", sql("""
SELECT assignment_group_name, priority, CAST(count(*) AS BIGINT) AS open_ticket_count
FROM fact WHERE is_open GROUP BY 1, 2""", "fact"))
def m01(spark, sf_dir):
    """M1: open tickets by group and priority."""
    return M.summarize(ticket_fact(spark, sf_dir), ["assignment_group_name", "priority"], ["open_ticket_count"])


@register("m02_week_resolution_for_category", sql("""
SELECT category_name, CAST(count(*) AS BIGINT) AS resolved_tickets, round(avg(resolution_hours), 6) AS avg_resolution_hours
FROM fact WHERE category_name = 'BUILDING' AND is_resolved
  AND resolved_at >= date_trunc('week', TIMESTAMP '2001-07-29 23:59:59') AND resolved_at < TIMESTAMP '2001-07-29 23:59:59'
GROUP BY 1""", "fact"))
def m02(spark, sf_dir):
    """M2: mean resolution hours of one category for tickets resolved in the (ISO) week up to a given day.

    The day lies where the test data have resolved tickets: none are resolved in the last week before as_of.
    """
    f = ticket_fact(spark, sf_dir)
    day = F.lit(WEEK_ASKED).cast("timestamp_ntz")
    f = f.where((F.col("category_name") == "BUILDING") & F.col("is_resolved") &
                (F.col("resolved_at") >= F.date_trunc("WEEK", day)) & (F.col("resolved_at") < day))
    return f.groupBy("category_name").agg(F.count(F.lit(1)).cast("bigint").alias("resolved_tickets"),
                                          F.round(F.avg("resolution_hours"), 6).alias("avg_resolution_hours"))


@register("m03_services_by_sla_breaches_30d", sql("""
SELECT service_name, sla_breach_tickets, rank FROM (
  SELECT concat_ws(' / ', assignment_group_name, category_name) AS service_name,
         CAST(count(DISTINCT CASE WHEN breached THEN sla.incident_id END) AS BIGINT) AS sla_breach_tickets,
         CAST(row_number() OVER (ORDER BY count(DISTINCT CASE WHEN breached THEN sla.incident_id END) DESC,
                                 concat_ws(' / ', assignment_group_name, category_name) ASC) AS INTEGER) AS rank
  FROM sla JOIN incd USING (incident_id)
  WHERE opened_at >= TIMESTAMP '2001-08-02' - INTERVAL 30 DAY AND opened_at < TIMESTAMP '2001-08-02'
  GROUP BY 1 HAVING count(DISTINCT CASE WHEN breached THEN sla.incident_id END) > 0) WHERE rank <= 10""",
                                                  "sla", "incd"))
def m03(spark, sf_dir):
    """M3: top 10 services (group / category) by breached tickets opened in the last 30 days."""
    f = sla_fact(spark, sf_dir).where((F.col("opened_at") >= _days_before(30)) & (F.col("opened_at") < _asof()))
    f = f.withColumn("service_name", F.concat_ws(" / ", "assignment_group_name", "category_name"))
    out = f.groupBy("service_name").agg(M.sla_breach_tickets()).where(F.col("sla_breach_tickets").isNotNull())
    return _global_top(out, "sla_breach_tickets", "service_name", 10)


def _global_top(df: DataFrame, score: str, tiebreak: str, k: int) -> DataFrame:
    """Top k of a small aggregated frame (Spark plans TakeOrderedAndProject), with its rank."""
    top = df.orderBy(F.col(score).desc(), F.col(tiebreak).asc()).limit(k)
    from pyspark.sql import Window
    w = Window.orderBy(F.col(score).desc(), F.col(tiebreak).asc())
    return top.withColumn("rank", F.row_number().over(w).cast("int"))


@register("m04_categories_by_follow_up", sql("""
SELECT category_name, CAST(count(*) AS BIGINT) AS follow_up_tickets FROM fact
WHERE follow_up_required AND is_open GROUP BY 1""", "fact"))
def m04(spark, sf_dir):
    """M4: categories by open follow-up-required tickets."""
    f = ticket_fact(spark, sf_dir).where(F.col("is_open"))
    return M.summarize(f, ["category_name"], ["follow_up_tickets"])


@register("m05_articles_reused_for_critical_high", sql("""
SELECT kb_article_id, kb_article_reuse_count, rank FROM (
  SELECT kb_article_id, CAST(count(*) AS BIGINT) AS kb_article_reuse_count,
         CAST(row_number() OVER (ORDER BY count(*) DESC, kb_article_id ASC) AS INTEGER) AS rank
  FROM kbl JOIN inc USING (incident_id) WHERE priority_rank <= 2 GROUP BY 1) WHERE rank <= 10""", "kbl", "inc"))
def m05(spark, sf_dir):
    """M5: 10 articles most reused by critical / high tickets."""
    tm = TicketModel(spark, sf_dir)
    b = tm.incident_kb_links().join(tm.incidents_base().where(F.col("priority_rank") <= 2).select("incident_id"),
                                    "incident_id")
    return _global_top(M.kb_article_reuse_count(b, ["kb_article_id"]), "kb_article_reuse_count",
                       "kb_article_id", 10)


@register("m06_patterns_for_category", sql(f"""
SELECT pattern_label, CAST(count(DISTINCT p.incident_id) AS BIGINT) AS incident_count
FROM (SELECT CAST(incident_id AS VARCHAR) AS incident_id, {pattern_label_sql('note_text')} AS pattern_label
      FROM notes WHERE is_resolution) p
JOIN incd ON CAST(incd.incident_id AS VARCHAR) = p.incident_id
WHERE pattern_label IS NOT NULL AND incd.category_name = 'MACHINERY' GROUP BY 1""", "notes", "incd"))
def m06(spark, sf_dir):
    """M6 + E12: resolution patterns by frequency for one category."""
    tm = TicketModel(spark, sf_dir)
    g = graph_inputs(tm)
    labelled, _ = resolution_patterns(g["resolution_notes"])
    cat = tm.incidents().where(F.col("category_name") == "MACHINERY").select(
        F.col("incident_id").cast("string").alias("incident_id"))
    return labelled.join(cat, "incident_id").groupBy("pattern_label").agg(
        F.count_distinct("incident_id").cast("bigint").alias("incident_count"))


@register("m07_groups_oldest_open_by_bucket", sql("""
SELECT assignment_group_name, open_age_bucket, CAST(count(*) AS BIGINT) AS open_ticket_count,
       max(age_days) AS oldest_age_days
FROM factb WHERE is_open GROUP BY 1, 2""", "factb"))
def m07(spark, sf_dir):
    """M7 + E7b: open tickets and the oldest age per group and age bucket."""
    f = ticket_fact(spark, sf_dir).where(F.col("is_open"))
    return f.groupBy("assignment_group_name", "open_age_bucket").agg(
        F.count(F.lit(1)).cast("bigint").alias("open_ticket_count"), F.max("age_days").alias("oldest_age_days"))


@register("m08_open_total_and_groups", sql("""
SELECT CAST(count(*) AS BIGINT) AS open_ticket_count, CAST(count(DISTINCT assignment_group_name) AS BIGINT) AS groups
FROM fact WHERE is_open""", "fact"))
def m08(spark, sf_dir):
    """M8: total open tickets and the number of groups holding them."""
    f = ticket_fact(spark, sf_dir).where(F.col("is_open"))
    return f.agg(F.count(F.lit(1)).cast("bigint").alias("open_ticket_count"),
                 F.count_distinct("assignment_group_name").cast("bigint").alias("groups"))


@register("m09_group_most_open_p1_p2", sql("""
SELECT assignment_group_name, CAST(count(*) AS BIGINT) AS open_ticket_count FROM fact
WHERE is_open AND priority_rank <= 2 GROUP BY 1 ORDER BY open_ticket_count DESC, assignment_group_name ASC LIMIT 1""",
                                           "fact"))
def m09(spark, sf_dir):
    """M9: the group with most open P1/P2 tickets (top 1)."""
    f = ticket_fact(spark, sf_dir).where(F.col("is_open") & (F.col("priority_rank") <= 2))
    out = f.groupBy("assignment_group_name").agg(F.count(F.lit(1)).cast("bigint").alias("open_ticket_count"))
    return out.orderBy(F.col("open_ticket_count").desc(), F.col("assignment_group_name").asc()).limit(1)


@register("m10_mean_resolution_p1", sql("""
SELECT round(avg(resolution_hours), 6) AS avg_resolution_hours, round(avg(resolution_hour_boundaries), 6)
       AS avg_resolution_time
FROM fact WHERE priority_rank = 1 AND is_resolved""", "fact"))
def m10(spark, sf_dir):
    """M10 + E5: mean resolution time of P1 tickets (exact hours and hour boundaries)."""
    f = ticket_fact(spark, sf_dir, with_dims=False).where(F.col("priority_rank") == 1)
    out = M.summarize(f, [], ["avg_resolution_hours", "avg_resolution_time"], drop_blank=False)
    return out.select(F.round("avg_resolution_hours", 6).alias("avg_resolution_hours"),
                      F.round("avg_resolution_time", 6).alias("avg_resolution_time"))


@register("m11_sla_breaches_30d_by_priority", sql("""
SELECT priority, CAST(count(*) AS BIGINT) AS sla_breach_rows,
       CAST(count(DISTINCT sla.incident_id) AS BIGINT) AS sla_breach_tickets
FROM sla JOIN inc USING (incident_id)
WHERE breached AND opened_at >= TIMESTAMP '2001-08-02' - INTERVAL 30 DAY AND opened_at < TIMESTAMP '2001-08-02'
GROUP BY 1""", "sla", "inc"))
def m11(spark, sf_dir):
    """M11 + E6: SLA breaches of the last 30 days by priority (rows and tickets)."""
    f = sla_fact(spark, sf_dir).where((F.col("opened_at") >= _days_before(30)) & (F.col("opened_at") < _asof()))
    out = f.groupBy("priority").agg(M.sla_breach_rows(), M.sla_breach_tickets())
    return out.where(F.col("sla_breach_rows").isNotNull())


@register("m12_recent_unresolved", sql("""
SELECT incident_id, number, state, age_days AS days_open FROM fact
WHERE NOT is_resolved AND opened_at >= TIMESTAMP '2001-08-02' - INTERVAL 7 DAY""", "fact"))
def m12(spark, sf_dir):
    """Tickets opened in the last 7 days and not resolved, with days open."""
    f = ticket_fact(spark, sf_dir, with_dims=False)
    return f.where(~F.col("is_resolved") & (F.col("opened_at") >= _days_before(7))).select(
        "incident_id", "number", "state", F.col("age_days").alias("days_open"))


@register("m13_category_highest_backlog", sql("""
SELECT category_name, CAST(count(*) AS BIGINT) AS open_ticket_count FROM fact WHERE is_open
GROUP BY 1 ORDER BY open_ticket_count DESC, category_name ASC LIMIT 1""", "fact"))
def m13(spark, sf_dir):
    """The category with the highest backlog."""
    out = M.summarize(ticket_fact(spark, sf_dir), ["category_name"], ["open_ticket_count"])
    return out.orderBy(F.col("open_ticket_count").desc(), F.col("category_name").asc()).limit(1)


@register("m14_stale_high_priority_open", sql("""
SELECT f.incident_id, f.number, f.priority, f.assignment_group_name, s.full_name AS owner, f.age_days,
       CASE WHEN b.any_breach IS NULL THEN 'No SLA' WHEN b.any_breach THEN 'Breached' ELSE 'Within target' END
         AS sla_status
FROM fact f LEFT JOIN asg USING (incident_id)
LEFT JOIN usr s ON s.user_id = 'S' || CAST(asg.assignee_id AS VARCHAR)
LEFT JOIN (SELECT incident_id, bool_or(breached) AS any_breach FROM sla GROUP BY 1) b USING (incident_id)
WHERE f.is_open AND f.priority_rank <= 2 AND f.updated_at < TIMESTAMP '2001-08-02' - INTERVAL 3 DAY""",
                                             "fact", "asg", "usr", "sla"))
def m14(spark, sf_dir):
    """High-priority open tickets not updated for 3 days, with owner, age and SLA status."""
    tm = TicketModel(spark, sf_dir)
    f = ticket_fact(spark, sf_dir).where(F.col("is_open") & (F.col("priority_rank") <= 2) &
                                         (F.col("updated_at") < _days_before(3)))
    owners = tm.assignees().join(
        tm.users().select(F.col("user_id").alias("_uid"), F.col("full_name").alias("owner")),
        F.concat(F.lit("S"), F.col("assignee_id").cast("string")) == F.col("_uid"), "left") \
        .select("incident_id", "owner")
    breach = tm.slas().groupBy("incident_id").agg(F.bool_or("breached").alias("any_breach"))
    out = f.join(owners, "incident_id", "left").join(breach, "incident_id", "left")
    return out.select("incident_id", "number", "priority", "assignment_group_name", "owner", "age_days",
                      F.when(F.col("any_breach").isNull(), "No SLA").when(F.col("any_breach"), "Breached")
                      .otherwise("Within target").alias("sla_status"))


@register("m15_log_files_for_group", sql("""
SELECT a.attachment_id, a.incident_id, a.file_name FROM att a JOIN incd USING (incident_id)
WHERE incd.assignment_group_name = 'NATION_7'
  AND lower(regexp_extract(a.file_name, '\\.([^.]*)$', 1)) IN ('log', 'txt')""", "att", "incd"))
def m15(spark, sf_dir):
    """Log files (I17 type 'log') on tickets of one group."""
    tm = TicketModel(spark, sf_dir)
    inc = tm.incidents().where(F.col("assignment_group_name") == "NATION_7").select("incident_id")
    a = tm.attachments().join(inc, "incident_id")
    return a.where(asset_type_from_name(F.col("file_name")) == "log").select("attachment_id", "incident_id",
                                                                            "file_name")


@register("m16_changes_by_resolved_tickets", sql("""
SELECT change_request_id, resolved_tickets, rank FROM (
  SELECT change_request_id, CAST(count(DISTINCT incident_id) AS BIGINT) AS resolved_tickets,
         CAST(row_number() OVER (ORDER BY count(DISTINCT incident_id) DESC, change_request_id ASC) AS INTEGER) AS rank
  FROM chl JOIN inc USING (incident_id) WHERE lower(state) IN ('resolved', 'closed') GROUP BY 1) WHERE rank <= 10""",
                                              "chl", "inc"))
def m16(spark, sf_dir):
    """Change requests by number of linked resolved tickets (top 10)."""
    tm = TicketModel(spark, sf_dir)
    res = tm.incidents_base().where(is_resolved(F.col("state"))).select("incident_id")
    out = tm.incident_changes().join(res, "incident_id").groupBy("change_request_id").agg(
        F.count_distinct("incident_id").cast("bigint").alias("resolved_tickets"))
    return _global_top(out, "resolved_tickets", "change_request_id", 10)


@register("m17_within_sla_share_by_category", sql("""
SELECT category_name, round(CAST(count(*) FILTER (WHERE NOT any_breach) AS DOUBLE) / count(*), 6) AS within_sla_share
FROM (SELECT incident_id, bool_or(breached) AS any_breach FROM sla GROUP BY 1) b
JOIN fact USING (incident_id) WHERE is_resolved GROUP BY 1""", "sla", "fact"))
def m17(spark, sf_dir):
    """Share of resolved tickets (with an SLA) resolved without any breach, per category."""
    tm = TicketModel(spark, sf_dir)
    b = tm.slas().groupBy("incident_id").agg(F.bool_or("breached").alias("any_breach"))
    f = ticket_fact(spark, sf_dir).where(F.col("is_resolved")).join(b, "incident_id")
    return f.groupBy("category_name").agg(
        F.round(F.count_if(~F.col("any_breach")) / F.count(F.lit(1)), 6).alias("within_sla_share"))


@register("m20_volume_trend_by_month", sql("""
SELECT CAST(date_trunc('month', opened_at) AS TIMESTAMP) AS period, CAST(count(*) AS BIGINT) AS ticket_volume
FROM inc GROUP BY 1""", "inc"))
def m20(spark, sf_dir):
    """Ticket volume by month."""
    inc = TicketModel(spark, sf_dir).incidents_base()
    return inc.groupBy(F.date_trunc("MONTH", F.col("opened_at")).cast("timestamp_ntz").alias("period")).agg(
        F.count(F.lit(1)).cast("bigint").alias("ticket_volume"))


# ---- M19: reopen within 30 days from the event stream --------------------------------------------

REOPEN_WINDOW_DAYS = 30


def reopen_events(events: DataFrame, window_days: int = REOPEN_WINDOW_DAYS) -> DataFrame:
    """M19: 'error' events that follow a 'purchase' (resolution) of the same user within 30 days.

    Skew-safe as-of existence test: purchases are first reduced to one row per
    (user, span of ``window_days`` days) with the earliest and the latest of
    them, and each error meets two spans by an equi-join.  Its own span starts
    less than ``window_days`` before it, so the earliest decides (min_ts < ts);
    of the span before, the latest decides (max_ts >= ts - window).  No
    per-user window or sort in one task.
    """
    span = F.floor(F.unix_date(F.to_date("ts")) / window_days)
    p = events.where(F.col("event_type") == "purchase").groupBy("user_id", span.alias("span")) \
        .agg(F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"))
    e = events.where(F.col("event_type") == "error").select("event_id", "user_id", "ts", span.alias("own")) \
        .withColumn("span", F.explode(F.array("own", F.col("own") - 1)))
    lo = F.col("ts") - F.make_dt_interval(F.lit(window_days), F.lit(0), F.lit(0), F.lit(0))
    ok = F.when(F.col("span") == F.col("own"), F.col("min_ts") < F.col("ts")).otherwise(F.col("max_ts") >= lo)
    return e.join(p, ["user_id", "span"]).where(ok).select("event_id", "user_id", "ts").distinct()


@register("m19_reopen_within_30_days", sql("""
SELECT CAST(e.ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS reopen_events,
       CAST(count(DISTINCT e.user_id) AS BIGINT) AS reopened_users
FROM events e
WHERE e.event_type = 'error' AND EXISTS (
  SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id
    AND p.ts < e.ts AND p.ts >= e.ts - INTERVAL 30 DAY)
GROUP BY 1"""))
def m19(spark, sf_dir):
    """Reopen events per day (an error within 30 days after the same user's purchase)."""
    ev = TicketModel(spark, sf_dir).raw("events")
    r = reopen_events(ev)
    return r.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).cast("bigint").alias("reopen_events"),
        F.count_distinct("user_id").cast("bigint").alias("reopened_users"))


# ---- M18 and L-ops over retrieval evidence ------------------------------------------------------------

SIMILAR_PATTERNS_SQL = f"""
SELECT s.query_id, p.pattern_label, CAST(count(*) AS BIGINT) AS n_similar
FROM (SELECT DISTINCT query_id, regexp_extract(doc_id, '^incident_INC0*([0-9]+)_', 1) AS incident_id
      FROM ({ORACLES['j20_b12_b13_similar_incidents']})) s
JOIN g_pl p ON p.incident_id = s.incident_id
WHERE p.pattern_label IS NOT NULL GROUP BY 1, 2"""


def similar_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, pattern_label, n_similar): resolution patterns among the tickets similar to an open one."""
    from caseflow.plans.retrieval_queries import similar_incidents
    sim = similar_incidents(spark, sf_dir).select(
        "query_id", F.regexp_extract("doc_id", r"^incident_INC0*([0-9]+)_", 1).alias("incident_id")).distinct()
    labelled, _ = resolution_patterns(graph_inputs(TicketModel(spark, sf_dir))["resolution_notes"])
    return sim.join(labelled, "incident_id").groupBy("query_id", "pattern_label").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_similar"))


@register("m18_common_pattern_among_similar", sql(f"""
SELECT query_id, pattern_label, n_similar FROM (
  SELECT s.query_id, p.pattern_label, CAST(count(*) AS BIGINT) AS n_similar,
         row_number() OVER (PARTITION BY s.query_id ORDER BY count(*) DESC, p.pattern_label ASC) AS rn
  FROM (SELECT DISTINCT query_id, regexp_extract(doc_id, '^incident_INC0*([0-9]+)_', 1) AS incident_id
        FROM ({ORACLES['j20_b12_b13_similar_incidents']})) s
  JOIN (SELECT CAST(incident_id AS VARCHAR) AS incident_id, {pattern_label_sql('note_text')} AS pattern_label
        FROM notes WHERE is_resolution) p ON p.incident_id = s.incident_id
  WHERE p.pattern_label IS NOT NULL GROUP BY 1, 2) WHERE rn = 1""", "notes"))
def m18(spark, sf_dir):
    """Per open ticket, the most common resolution pattern among its similar tickets."""
    j = similar_patterns(spark, sf_dir)
    from pyspark.sql import Window
    w = Window.partitionBy("query_id").orderBy(F.col("n_similar").desc(), F.col("pattern_label").asc())
    return j.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence of the open tickets: similar tickets, assets, and the service level agreements they have broken."""
    from caseflow.plans.retrieval_queries import attachment_lookup, similar_incidents
    sim = similar_incidents(spark, sf_dir).select(
        F.col("query_id").alias("subject_id"), F.lit("incident").alias("source_type"),
        F.col("doc_id").alias("source_id"), "title", "snippet", "url",
        F.least(F.lit(1.0), F.col("score")).alias("confidence"))
    att = attachment_lookup(spark, sf_dir).where("asset_id is not null").select(
        F.col("request_id").alias("subject_id"), F.lit("attachment").alias("source_type"),
        F.col("asset_id").alias("source_id"), "title", F.coalesce("summary", F.lit("")).alias("snippet"), "url",
        "confidence")
    return EV.citations(sim, att, _breaches(spark, sf_dir))


def _breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured evidence: the broken agreements of open tickets."""
    tm = narrowed(TicketModel(spark, sf_dir), "documents")
    described = tm.raw("documents").select(F.col("doc_id").alias("incident_id"))
    open_ = tm.incidents_base().where(is_open(F.col("state"))).select("incident_id").join(described, "incident_id")
    return tm.slas().where("breached").join(open_, "incident_id").select(
        F.col("incident_id").alias("subject_id"), F.lit("structured").alias("source_type"),
        F.col("sla_id").alias("source_id"), F.col("name").alias("title"),
        F.concat(F.lit("elapsed "), F.col("elapsed_hours").cast("int").cast("string"), F.lit(" of "),
                 F.col("target_hours").cast("int").cast("string"), F.lit(" hours")).alias("snippet"),
        F.concat(F.lit("https://tickets.example.invalid/incident/"), F.col("incident_id").cast("string")).alias("url"),
        F.lit(1.0).alias("confidence"))


CITATIONS_SQL = f"""
SELECT query_id AS subject_id, 'incident' AS source_type, doc_id AS source_id, title, snippet, url,
       least(1.0e0, score) AS confidence
FROM ({ORACLES['j20_b12_b13_similar_incidents']})
UNION ALL
SELECT request_id, 'attachment', asset_id, title, COALESCE(summary, ''), url, confidence
FROM ({ORACLES['j21_attachment_lookup']}) WHERE asset_id IS NOT NULL
UNION ALL
SELECT o_orderkey, 'structured', CAST(o_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), 'Resolution',
       'elapsed ' || CAST(CAST(floor(l_quantity * 3) AS INTEGER) AS VARCHAR) || ' of '
         || CAST(CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 24 AS VARCHAR) || ' hours',
       'https://tickets.example.invalid/incident/' || CAST(o_orderkey AS VARCHAR), 1.0e0
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN documents ON doc_id = o_orderkey
WHERE o_orderstatus <> 'F' AND l_quantity * 3 > CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 24"""


@register("l01_citations", CITATIONS_SQL)
def l01(spark, sf_dir):
    """L1: every piece of evidence for the open tickets in one citation shape."""
    return _citations(spark, sf_dir)


@register("l04_conflicting_notes", sql("""
SELECT incident_id, CAST(count(DISTINCT said) AS BIGINT) AS n_said, max(created_at) AS newest_at,
       arg_max(said, (created_at, said)) AS newest
FROM (SELECT incident_id, created_at, trim(regexp_replace(lower(note_text), '[^a-z0-9]+', ' ', 'g')) AS said FROM notes)
WHERE said <> '' GROUP BY incident_id HAVING count(DISTINCT said) > 1""", "notes"))
def l04_conflicts(spark, sf_dir):
    """L4 + L6: tickets whose notes say different things; the newest note holds."""
    return EV.conflicting_notes(TicketModel(spark, sf_dir).notes())


@register("l03_l04_confidence_and_review", f"""
SELECT subject_id, structured_hits, strong_hits, total_hits, confidence_label,
       confidence_label = 'Low' OR COALESCE(best_similar < 0.5, true) OR conflicting OR sensitive AS needs_review,
       conflicting
FROM (SELECT *, CASE WHEN structured_hits > 0 OR strong_hits >= 2 THEN 'High' WHEN strong_hits = 1 THEN 'Medium'
                     ELSE 'Low' END AS confidence_label,
             subject_id IN (SELECT incident_id FROM ({ORACLES['l04_conflicting_notes']})) AS conflicting,
             subject_id IN (SELECT o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey
                            WHERE regexp_matches(lower(c_mktsegment), 'security|safety|regulated|breach')) AS sensitive
      FROM (SELECT subject_id, CAST(count(*) FILTER (WHERE source_type = 'structured') AS BIGINT) AS structured_hits,
                   CAST(count(*) FILTER (WHERE confidence >= 0.5) AS BIGINT) AS strong_hits,
                   CAST(count(*) AS BIGINT) AS total_hits,
                   max(CASE WHEN source_type = 'incident' THEN confidence END) AS best_similar
            FROM ({CITATIONS_SQL}) GROUP BY subject_id))""")
def l03_l04(spark, sf_dir):
    """L3 + L4: confidence label and human-review flag per ticket from its evidence, notes and category."""
    tm = TicketModel(spark, sf_dir)
    s = EV.evidence_summary(_citations(spark, sf_dir))
    conflicts = EV.conflicting_notes(tm.notes()).select(F.col("incident_id").alias("subject_id"),
                                                        F.lit(True).alias("conflicting"))
    category = tm.incidents().select(F.col("incident_id").alias("subject_id"), "category_name")
    label = EV.confidence_label(F.col("structured_hits"), F.col("strong_hits"), F.col("total_hits"))
    s = s.join(conflicts, "subject_id", "left").join(category, "subject_id", "left") \
        .withColumn("conflicting", F.coalesce("conflicting", F.lit(False)))
    return s.select("subject_id", "structured_hits", "strong_hits", "total_hits", label.alias("confidence_label"),
                    EV.needs_review(label, F.col("best_similar"), F.col("conflicting"), F.col("category_name"))
                    .alias("needs_review"), "conflicting")


@register("l02_route_questions", """
SELECT conv_id, turn, concat_ws(',',
  CASE WHEN contains(lower(text), 'attachment') OR contains(lower(text), 'document')
         OR contains(lower(text), 'screenshot') OR contains(lower(text), 'image') OR contains(lower(text), 'log')
         OR contains(lower(text), 'script') OR contains(lower(text), 'file') OR contains(lower(text), 'uploaded')
       THEN 'get_attachment_metadata' END,
  CASE WHEN contains(lower(text), 'open') OR contains(lower(text), 'high priority') OR contains(lower(text), 'sla')
         OR contains(lower(text), 'backlog') OR contains(lower(text), 'category') OR contains(lower(text), 'count')
         OR contains(lower(text), 'aging') OR contains(lower(text), 'follow-up') OR contains(lower(text), 'how many')
         OR contains(lower(text), 'who owns') THEN 'query_fabric_data_agent' END,
  CASE WHEN contains(lower(text), 'similar') OR contains(lower(text), 'historical')
         OR contains(lower(text), 'past incident') OR contains(lower(text), 'like this before')
         OR contains(lower(text), 'prior fix') OR contains(lower(text), 'resolved before')
         OR contains(lower(text), 'same error') THEN 'search_incidents' END,
  CASE WHEN contains(lower(text), 'knowledge article') OR contains(lower(text), 'kb')
         OR contains(lower(text), 'work note') OR contains(lower(text), 'resolution note')
         OR contains(lower(text), 'how was this fixed') OR contains(lower(text), 'known issue')
         OR contains(lower(text), 'documented fix') THEN 'search_knowledge' END) AS tools
FROM conversations WHERE role = 'user'""")
def l02(spark, sf_dir):
    """L2: route every user question (conversation user turn) to the tools its keywords call for."""
    c = TicketModel(spark, sf_dir).raw("conversations").where(F.col("role") == "user")
    return c.select("conv_id", "turn", EV.route_tools(F.col("text")).alias("tools"))


@register("l05_evidence_bundle", sql(f"""
SELECT t.incident_id, COALESCE(s.n, 0) AS similar_tickets, COALESCE(k.n, 0) AS articles,
       COALESCE(a.n, 0) AS assets, COALESCE(c.n, 0) AS changes
FROM (SELECT incident_id FROM inc WHERE lower(state) IN ('new', 'in progress', 'on hold')) t
LEFT JOIN (SELECT query_id AS incident_id, CAST(count(*) AS BIGINT) AS n
           FROM ({ORACLES['j20_b12_b13_similar_incidents']}) GROUP BY 1) s USING (incident_id)
LEFT JOIN (SELECT incident_id, CAST(count(*) AS BIGINT) AS n FROM kbl GROUP BY 1) k USING (incident_id)
LEFT JOIN (SELECT request_id AS incident_id, CAST(count(*) AS BIGINT) AS n
           FROM ({ORACLES['j21_attachment_lookup']}) WHERE asset_id IS NOT NULL GROUP BY 1) a USING (incident_id)
LEFT JOIN (SELECT incident_id, CAST(count(*) AS BIGINT) AS n FROM chl GROUP BY 1) c USING (incident_id)""",
                                         "inc", "kbl", "chl"))
def l05(spark, sf_dir):
    """Per open ticket, how much evidence of each kind exists
    (similar tickets, linked articles, assets in scope, linked changes)."""
    from caseflow.plans.retrieval_queries import attachment_lookup, similar_incidents
    tm = TicketModel(spark, sf_dir)
    t = tm.incidents_base().where(is_open(F.col("state"))).select("incident_id")

    def counted(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("incident_id")).agg(F.count(F.lit(1)).cast("bigint").alias(name))

    out = t.join(counted(similar_incidents(spark, sf_dir), "query_id", "similar_tickets"), "incident_id", "left") \
        .join(counted(tm.incident_kb_links(), "incident_id", "articles"), "incident_id", "left") \
        .join(counted(attachment_lookup(spark, sf_dir).where("asset_id is not null"), "request_id", "assets"), "incident_id", "left") \
        .join(counted(tm.incident_changes(), "incident_id", "changes"), "incident_id", "left")
    return out.fillna(0, ["similar_tickets", "articles", "assets", "changes"])


#: Kinds of a bundle, and the items of each at most.
BUNDLE_KINDS = ["incident", "pattern", "article", "attachment", "change", "structured"]
BUNDLE_ITEMS = 5


def _linked(spark: SparkSession, sf_dir: str, subjects: DataFrame) -> DataFrame:
    """Evidence of the ``subjects`` (incident_id) beside the citations: patterns among similar tickets, linked
    articles and changes, in L1's shape.  Links of other tickets are left out while they are two numbers each."""
    tm = TicketModel(spark, sf_dir)

    def links(column: str, key: str) -> DataFrame:
        """Dealt by ticket once, for the subjects and for ``distinct``."""
        return tm.raw("lineitem").select(F.col("l_orderkey").alias("incident_id"), F.col(column).alias(key)) \
            .join(subjects, "incident_id", "left_semi").distinct()

    patterns = similar_patterns(spark, sf_dir).select(
        F.col("query_id").alias("subject_id"), F.lit("pattern").alias("source_type"),
        F.sha2("pattern_label", 256).alias("source_id"), F.col("pattern_label").alias("title"),
        F.concat(F.lit("seen in "), F.col("n_similar").cast("string"), F.lit(" similar tickets")).alias("snippet"),
        F.lit(None).cast("string").alias("url"), F.least(F.lit(1.0), F.col("n_similar") / 5.0).alias("confidence"))
    kb = tm.kb_articles().select("kb_article_id", "kb_article_number", "title", "audience")
    articles = links("l_partkey", "kb_article_id").join(kb, "kb_article_id").select(
        F.col("incident_id").alias("subject_id"), F.lit("article").alias("source_type"),
        F.col("kb_article_number").alias("source_id"), "title", F.col("audience").alias("snippet"),
        F.concat(F.lit(KB_URL_PREFIX), F.col("kb_article_id").cast("string")).alias("url"), F.lit(1.0).alias("confidence"))
    changes = links("l_suppkey", "change_request_id").join(tm.change_requests(), "change_request_id").select(
        F.col("incident_id").alias("subject_id"), F.lit("change").alias("source_type"),
        F.col("number").alias("source_id"), "title", F.concat_ws(", ", F.col("state"), F.concat("risk", F.lit(" risk")))
        .alias("snippet"), F.lit(None).cast("string").alias("url"),
        F.when(F.col("risk") == "High", 1.0).otherwise(0.6).alias("confidence"))
    return EV.citations(patterns, articles, changes)


@register("l05_evidence_items", sql(f"""
SELECT subject_id AS incident_id, source_type, CAST(found AS BIGINT) AS found, CAST(rank AS INTEGER) AS rank, source_id,
       title, snippet, url, confidence
FROM (SELECT *, count(*) OVER (PARTITION BY subject_id, source_type) AS found,
             row_number() OVER (PARTITION BY subject_id, source_type
                                ORDER BY confidence DESC, source_id, title, snippet, url) AS rank
      FROM (SELECT subject_id, source_type, source_id, title, snippet, url, round(confidence, 6) AS confidence FROM (
              {CITATIONS_SQL}
              UNION ALL
              SELECT query_id, 'pattern', sha256(pattern_label), pattern_label,
                     'seen in ' || CAST(n_similar AS VARCHAR) || ' similar tickets', NULL, least(1.0e0, n_similar / 5.0e0)
              FROM ({SIMILAR_PATTERNS_SQL})
              UNION ALL
              SELECT kbl.incident_id, 'article', kb_article_number, {initcap_sql('title_raw')}, audience,
                     'https://tickets.example.invalid/kb/' || CAST(kb_article_id AS VARCHAR), 1.0e0
              FROM kbl JOIN kb USING (kb_article_id)
              UNION ALL
              SELECT chl.incident_id, 'change', chg.number, chg.title, chg.state || ', ' || chg.risk || ' risk', NULL,
                     CASE WHEN chg.risk = 'High' THEN 1.0e0 ELSE 0.6e0 END
              FROM chl JOIN chg USING (change_request_id))))
JOIN (SELECT incident_id AS subject_id FROM inc WHERE lower(state) IN ('new', 'in progress', 'on hold')) USING (subject_id)
WHERE rank <= {BUNDLE_ITEMS}""", "inc", "kbl", "kb", "chl", "chg", "g_pl"))
def l05_items(spark, sf_dir):
    """The evidence itself, per open ticket the five strongest of each kind, opened from the bundle's arrays."""
    tm = TicketModel(spark, sf_dir)
    open_ = tm.incidents_base().where(is_open(F.col("state"))).select("incident_id")
    evidence = _citations(spark, sf_dir).unionByName(_linked(spark, sf_dir, open_)) \
        .withColumn("confidence", F.round("confidence", 6)).withColumnRenamed("subject_id", "incident_id")
    out = NS.bundle(open_, evidence, BUNDLE_KINDS, "incident_id", n=BUNDLE_ITEMS)

    def opened(kind: str):
        return F.transform(kind, lambda x: F.struct(F.lit(kind).alias("source_type"), F.col(f"n_{kind}").alias("found"),
                                                    x.alias("item")))

    return out.select("incident_id", F.explode(F.flatten(F.array(*[opened(k) for k in BUNDLE_KINDS]))).alias("x")) \
        .select("incident_id", "x.source_type", "x.found", "x.item.*")


@register("l06_prefer_freshest_note", sql("""
SELECT incident_id, arg_max(note_text, (created_at, note_text)) AS note_text, max(created_at) AS created_at
FROM notes GROUP BY incident_id""", "notes"))
def l06(spark, sf_dir):
    """The newest note per ticket wins when notes disagree."""
    return EV.prefer_freshest(TicketModel(spark, sf_dir).notes(), ["incident_id"], "note_text", "created_at")


@register("l07_row_cap", sql("""
SELECT incident_id, number FROM inc WHERE lower(state) IN ('new', 'in progress', 'on hold')
ORDER BY opened_at ASC, incident_id ASC LIMIT 25""", "inc"))
def l07(spark, sf_dir):
    """A capped answer (25 of 1..50 rows) of the oldest open tickets."""
    inc = TicketModel(spark, sf_dir).incidents_base().where(is_open(F.col("state")))
    return EV.row_cap(inc.orderBy(F.col("opened_at").asc(), F.col("incident_id").asc())
                      .select("incident_id", "number"), 25)
