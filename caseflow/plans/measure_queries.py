"""Registered measure queries (E1-E19) over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.operators import drill as D
from caseflow.operators import measures as M
from caseflow.operators.graph import resolution_patterns
from caseflow.plans.oracles import ASSET_TYPE_SQL, sql
from caseflow.plans.registry import register
from caseflow.sources.domain import AS_OF, TicketModel, graph_inputs


def ticket_fact(spark: SparkSession, sf_dir: str, with_dims: bool = True,
                with_reopen: bool = False) -> DataFrame:
    tm = TicketModel(spark, sf_dir)
    inc = tm.incidents() if with_dims else tm.incidents_base()
    return M.fact_tickets(inc, AS_OF, tm.reopen_counts() if with_reopen else None)


def r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


# ---- E3 flagship -----------------------------------------------------------

def backlog_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open tickets by priority (blank rows dropped)."""
    fact = ticket_fact(spark, sf_dir, with_dims=False)
    return M.summarize(fact, ["priority"], ["open_ticket_count"])


register("e03_backlog_by_priority", sql("""
SELECT priority, CAST(count(*) AS BIGINT) AS open_ticket_count
FROM fact WHERE is_open GROUP BY priority""", "fact"))(backlog_by_priority)


@register("e01_ticket_volume_by_state", sql("""
SELECT state, CAST(count(*) AS BIGINT) AS ticket_volume FROM inc GROUP BY state""", "inc"))
def ticket_volume_by_state(spark, sf_dir):
    return M.summarize(ticket_fact(spark, sf_dir, with_dims=False), ["state"], ["ticket_volume"])


@register("e02_open_by_state_keep", sql("""
SELECT state, CAST(count(*) AS BIGINT) AS open_ticket_count FROM fact WHERE is_open GROUP BY state""",
                                        "fact"))
def open_by_state_keep(spark, sf_dir):
    """KEEPFILTERS: the open filter intersects the state axis; closed states are blank."""
    return M.summarize(ticket_fact(spark, sf_dir, with_dims=False), ["state"],
                       ["open_ticket_count"], mode="keep")


@register("e02_open_by_state_replace", sql("""
SELECT s.state, CAST(s.ticket_volume AS BIGINT) AS ticket_volume,
       (SELECT CAST(count(*) AS BIGINT) FROM fact WHERE is_open) AS open_ticket_count
FROM (SELECT state, count(*) AS ticket_volume FROM fact GROUP BY state) s""", "fact"))
def open_by_state_replace(spark, sf_dir):
    """Plain CALCULATE filter: replaces the state axis, same open total on every row."""
    return M.summarize(ticket_fact(spark, sf_dir, with_dims=False), ["state"],
                       ["ticket_volume", "open_ticket_count"], mode="replace")


@register("e02_open_by_group_state_replace", sql("""
SELECT s.assignment_group_name, s.state, s.ticket_volume, o.open_ticket_count
FROM (SELECT assignment_group_name, state, CAST(count(*) AS BIGINT) AS ticket_volume
      FROM fact GROUP BY 1, 2) s
LEFT JOIN (SELECT assignment_group_name, CAST(count(*) AS BIGINT) AS open_ticket_count
           FROM fact WHERE is_open GROUP BY 1) o
  ON s.assignment_group_name IS NOT DISTINCT FROM o.assignment_group_name""", "fact"))
def open_by_group_state_replace(spark, sf_dir):
    return M.summarize(ticket_fact(spark, sf_dir), ["assignment_group_name", "state"],
                       ["ticket_volume", "open_ticket_count"], mode="replace")


@register("e04_resolved_by_priority", sql("""
SELECT priority, CAST(count(*) AS BIGINT) AS resolved_ticket_count FROM fact WHERE is_resolved
GROUP BY priority""", "fact"))
def resolved_by_priority(spark, sf_dir):
    return M.summarize(ticket_fact(spark, sf_dir, with_dims=False), ["priority"], ["resolved_ticket_count"])


@register("e05a_avg_resolution_time_by_priority", sql("""
SELECT priority, round(avg(resolution_hour_boundaries), 6) AS avg_resolution_time
FROM fact WHERE is_resolved GROUP BY priority""", "fact"))
def avg_resolution_time_by_priority(spark, sf_dir):
    out = M.summarize(ticket_fact(spark, sf_dir, with_dims=False), ["priority"], ["avg_resolution_time"])
    return out.select("priority", r6("avg_resolution_time"))


@register("e05b_avg_resolution_hours_by_category", sql("""
SELECT category_name, round(avg(resolution_hours), 6) AS avg_resolution_hours
FROM fact WHERE resolved_date_key IS NOT NULL GROUP BY category_name""", "fact"))
def avg_resolution_hours_by_category(spark, sf_dir):
    out = M.summarize(ticket_fact(spark, sf_dir), ["category_name"], ["avg_resolution_hours"])
    return out.select("category_name", r6("avg_resolution_hours"))


def sla_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    tm = TicketModel(spark, sf_dir)
    inc = tm.incidents().select("incident_id", "priority", "assignment_group_name",
                                "category_name", "category_subcategory", "opened_at", "state")
    return M.fact_sla(tm.slas(), inc)


@register("e06a_sla_breach_rows_by_priority", sql("""
SELECT inc.priority, CAST(count(*) AS BIGINT) AS sla_breach_rows
FROM sla JOIN inc USING (incident_id) WHERE breached GROUP BY inc.priority""", "sla", "inc"))
def sla_breach_rows_by_priority(spark, sf_dir):
    out = sla_fact(spark, sf_dir).groupBy("priority").agg(M.sla_breach_rows())
    return out.where(F.col("sla_breach_rows").isNotNull())


@register("e06b_sla_breach_tickets_by_group", sql("""
SELECT incd.assignment_group_name, CAST(count(DISTINCT sla.incident_id) AS BIGINT) AS sla_breach_tickets
FROM sla LEFT JOIN incd USING (incident_id) WHERE breached GROUP BY 1""", "sla", "incd"))
def sla_breach_tickets_by_group(spark, sf_dir):
    out = sla_fact(spark, sf_dir).groupBy("assignment_group_name").agg(M.sla_breach_tickets())
    return out.where(F.col("sla_breach_tickets").isNotNull())


@register("e07a_aging_open_by_group", sql("""
SELECT assignment_group_name, CAST(count(*) AS BIGINT) AS aging_open_tickets
FROM fact WHERE is_open AND age_days > 7 GROUP BY 1""", "fact"))
def aging_open_by_group(spark, sf_dir):
    return M.summarize(ticket_fact(spark, sf_dir), ["assignment_group_name"], ["aging_open_tickets"])


@register("e07b_aging_by_bucket", sql("""
SELECT open_age_bucket, CAST(count(*) AS BIGINT) AS open_ticket_count
FROM factb WHERE is_open GROUP BY 1""", "factb"))
def aging_by_bucket(spark, sf_dir):
    fact = ticket_fact(spark, sf_dir, with_dims=False)
    return M.summarize(fact, ["open_age_bucket"], ["open_ticket_count"])


@register("e08_e09_reopen_by_priority", sql("""
SELECT priority,
       CAST(nullif(count(DISTINCT CASE WHEN reopen_count > 0 THEN incident_id END), 0) AS BIGINT)
         AS reopened_ticket_count,
       round(CAST(nullif(count(DISTINCT CASE WHEN reopen_count > 0 THEN incident_id END), 0) AS DOUBLE)
             / nullif(count(*) FILTER (WHERE is_resolved), 0), 6) AS reopen_rate
FROM fact GROUP BY priority""", "fact"))
def reopen_by_priority(spark, sf_dir):
    fact = ticket_fact(spark, sf_dir, with_dims=False, with_reopen=True)
    out = M.summarize(fact, ["priority"], ["reopened_ticket_count", "reopen_rate"])
    return out.select("priority", "reopened_ticket_count", r6("reopen_rate"))


@register("e10_open_age_days_by_priority", sql("""
SELECT priority, round(avg(age_days), 6) AS open_ticket_age_days FROM fact WHERE is_open GROUP BY 1""",
                                              "fact"))
def open_age_days_by_priority(spark, sf_dir):
    out = M.summarize(ticket_fact(spark, sf_dir, with_dims=False), ["priority"], ["open_ticket_age_days"])
    return out.select("priority", r6("open_ticket_age_days"))


@register("e11_kb_reuse_by_article", sql("""
SELECT kb_article_id, CAST(count(*) AS BIGINT) AS kb_article_reuse_count FROM kbl GROUP BY 1""", "kbl"))
def kb_reuse_by_article(spark, sf_dir):
    return M.kb_article_reuse_count(TicketModel(spark, sf_dir).incident_kb_links(), ["kb_article_id"])


@register("e13_volume_by_category", sql("""
SELECT category_name, category_subcategory, CAST(count(*) AS BIGINT) AS ticket_volume
FROM incd GROUP BY 1, 2""", "incd"))
def volume_by_category(spark, sf_dir):
    return M.summarize(ticket_fact(spark, sf_dir), ["category_name", "category_subcategory"],
                       ["ticket_volume"])


@register("e14_sla_breach_rate_by_group", sql("""
SELECT incd.assignment_group_name,
       round(CAST(count(DISTINCT CASE WHEN breached THEN sla.incident_id END) AS DOUBLE)
             / count(DISTINCT sla.incident_id), 6) AS sla_breach_rate
FROM sla LEFT JOIN incd USING (incident_id) GROUP BY 1""", "sla", "incd"))
def sla_breach_rate_by_group(spark, sf_dir):
    out = sla_fact(spark, sf_dir).groupBy("assignment_group_name").agg(M.sla_breach_rate())
    return out.select("assignment_group_name", r6("sla_breach_rate"))


@register("e15_summary_by_group_priority", sql("""
SELECT assignment_group_name, priority,
       CAST(count(*) AS BIGINT) AS ticket_volume,
       CAST(nullif(count(*) FILTER (WHERE is_open), 0) AS BIGINT) AS open_ticket_count,
       CAST(nullif(count(*) FILTER (WHERE is_resolved), 0) AS BIGINT) AS resolved_ticket_count,
       round(avg(CASE WHEN resolved_date_key IS NOT NULL THEN resolution_hours END), 6) AS avg_resolution_hours,
       CAST(nullif(count(*) FILTER (WHERE is_open AND age_days > 7), 0) AS BIGINT) AS aging_open_tickets
FROM fact GROUP BY 1, 2""", "fact"))
def summary_by_group_priority(spark, sf_dir):
    out = M.summarize(ticket_fact(spark, sf_dir), ["assignment_group_name", "priority"],
                      ["ticket_volume", "open_ticket_count", "resolved_ticket_count",
                       "avg_resolution_hours", "aging_open_tickets"])
    return out.withColumn("avg_resolution_hours", F.round("avg_resolution_hours", 6))


DRILL_MEASURES = ["ticket_volume", "open_ticket_count", "avg_resolution_hours", "reopened_ticket_count", "reopen_rate",
                  "sla_breach_rows", "sla_breach_tickets", "sla_breach_rate", "kb_article_reuse_count",
                  "resolution_pattern_frequency", "ticket_asset_count", "ticket_change_count"]


def drill_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The ticket fact and its child facts; each child is read for its key and its measures' columns."""
    tm = TicketModel(spark, sf_dir)
    labelled, _ = resolution_patterns(graph_inputs(tm)["resolution_notes"])
    return ticket_fact(spark, sf_dir), {
        "reopen": tm.reopen_counts(),
        "sla": tm.slas(),
        "article": M.bridge_ticket_article(tm.incident_kb_links()),
        "pattern": M.bridge_ticket_pattern(labelled).withColumn("incident_id", F.col("incident_id").cast("bigint")),
        "asset": M.bridge_ticket_asset(tm.attachments(), tm.images()),
        "change": tm.incident_changes(),
    }


@register("e15_drill_across_group_priority", sql("""
SELECT assignment_group_name, priority, grouping(assignment_group_name) = 1 AS assignment_group_name_is_total,
       grouping(priority) = 1 AS priority_is_total,
       CAST(nullif(sum(tickets), 0) AS BIGINT) AS ticket_volume,
       CAST(nullif(sum(open), 0) AS BIGINT) AS open_ticket_count,
       round(sum(hours) / nullif(sum(timed), 0), 6) AS avg_resolution_hours,
       CAST(nullif(sum(reopened), 0) AS BIGINT) AS reopened_ticket_count,
       round(CAST(nullif(sum(reopened), 0) AS DOUBLE) / nullif(sum(resolved), 0), 6) AS reopen_rate,
       CAST(nullif(sum(breached_rows), 0) AS BIGINT) AS sla_breach_rows,
       CAST(nullif(sum(breached), 0) AS BIGINT) AS sla_breach_tickets,
       round(CAST(nullif(sum(breached), 0) AS DOUBLE) / nullif(sum(has_sla), 0), 6) AS sla_breach_rate,
       CAST(nullif(sum(articles), 0) AS BIGINT) AS kb_article_reuse_count,
       CAST(nullif(sum(patterns), 0) AS BIGINT) AS resolution_pattern_frequency,
       CAST(nullif(sum(assets), 0) AS BIGINT) AS ticket_asset_count,
       CAST(nullif(sum(changes), 0) AS BIGINT) AS ticket_change_count
FROM (
  SELECT f.assignment_group_name, f.priority, CASE WHEN f.incident_id IS NOT NULL THEN 1 ELSE 0 END AS tickets,
         CASE WHEN is_open THEN 1 ELSE 0 END AS open, CASE WHEN is_resolved THEN 1 ELSE 0 END AS resolved,
         CASE WHEN resolved_date_key IS NOT NULL THEN resolution_hours END AS hours,
         CASE WHEN resolved_date_key IS NOT NULL THEN 1 ELSE 0 END AS timed,
         CASE WHEN r.n > 0 THEN 1 ELSE 0 END AS reopened, s.breached_rows,
         CASE WHEN s.breached_rows > 0 THEN 1 ELSE 0 END AS breached, CASE WHEN s.n > 0 THEN 1 ELSE 0 END AS has_sla,
         k.n AS articles, p.n AS patterns, a.n AS assets, c.n AS changes
  FROM fact f
  FULL JOIN (SELECT incident_id, sum(reopen_count) AS n FROM reo GROUP BY 1) r ON r.incident_id = f.incident_id
  FULL JOIN (SELECT incident_id, count(*) AS n, count(*) FILTER (WHERE breached) AS breached_rows FROM sla GROUP BY 1) s
    ON s.incident_id = COALESCE(f.incident_id, r.incident_id)
  FULL JOIN (SELECT incident_id, count(*) AS n FROM kbl GROUP BY 1) k
    ON k.incident_id = COALESCE(f.incident_id, r.incident_id, s.incident_id)
  FULL JOIN (SELECT CAST(incident_id AS BIGINT) AS incident_id, count(DISTINCT pattern_label) AS n FROM g_pl
             WHERE pattern_label IS NOT NULL GROUP BY 1) p
    ON p.incident_id = COALESCE(f.incident_id, r.incident_id, s.incident_id, k.incident_id)
  FULL JOIN (SELECT incident_id, count(*) AS n FROM assets GROUP BY 1) a
    ON a.incident_id = COALESCE(f.incident_id, r.incident_id, s.incident_id, k.incident_id, p.incident_id)
  FULL JOIN (SELECT incident_id, count(*) AS n FROM chl GROUP BY 1) c
    ON c.incident_id = COALESCE(f.incident_id, r.incident_id, s.incident_id, k.incident_id, p.incident_id,
                                a.incident_id))
GROUP BY GROUPING SETS ((assignment_group_name, priority), (assignment_group_name), (priority), ())""",
    "fact", "reo", "sla", "kbl", "g_pl", "assets", "chl"))
def drill_across_group_priority(spark, sf_dir):
    """E15 across facts: ticket, SLA and bridge measures by group and priority, with both subtotals and the total."""
    fact, children = drill_inputs(spark, sf_dir)
    axes = ["assignment_group_name", "priority"]
    out = D.drill_across(fact, children, axes, DRILL_MEASURES, sets=[tuple(axes), (axes[0],), (axes[1],), ()])
    return out.withColumns({m: F.round(m, 6) for m in ("avg_resolution_hours", "reopen_rate", "sla_breach_rate")})


@register("e16_fact_tickets", sql("""
SELECT incident_id, opened_date_key, resolved_date_key, priority, priority_rank, state,
       assignment_group_id, category_id, requester_id, round(resolution_hours, 6) AS resolution_hours,
       open_age_days, open_age_bucket, is_open, is_resolved, reopen_count, follow_up_required
FROM factb""", "factb"))
def fact_tickets_query(spark, sf_dir):
    f = ticket_fact(spark, sf_dir, with_reopen=True)
    return f.select("incident_id", "opened_date_key", "resolved_date_key", "priority", "priority_rank",
                    "state", "assignment_group_id", "category_id", "requester_id", r6("resolution_hours"),
                    "open_age_days", "open_age_bucket", "is_open", "is_resolved", "reopen_count",
                    "follow_up_required")


@register("e17_fact_sla", sql("""
SELECT s.sla_id, s.incident_id, s.name, s.stage, s.target_hours, s.elapsed_hours, s.breached,
       inc.state, inc.priority, inc.requester_id
FROM sla s LEFT JOIN inc USING (incident_id)""", "sla", "inc"))
def fact_sla_query(spark, sf_dir):
    """SLA rows with the dimension keys of their ticket."""
    tm = TicketModel(spark, sf_dir)
    return M.fact_sla(tm.slas(), tm.incidents_base().select("incident_id", "state", "priority", "requester_id"))


@register("e17_bridge_ticket_article", sql("SELECT incident_id, kb_article_id FROM kbl", "kbl"))
def bridge_ticket_article_query(spark, sf_dir):
    return M.bridge_ticket_article(TicketModel(spark, sf_dir).incident_kb_links())


@register("e17_bridge_ticket_pattern", sql("""
SELECT DISTINCT incident_id, sha256(pattern_label) AS resolution_pattern_id FROM g_pl
WHERE pattern_label IS NOT NULL""", "g_pl"))
def bridge_ticket_pattern_query(spark, sf_dir):
    labelled, _ = resolution_patterns(graph_inputs(TicketModel(spark, sf_dir))["resolution_notes"])
    return M.bridge_ticket_pattern(labelled)


@register("e19_dim_asset_type", sql(f"""
SELECT {ASSET_TYPE_SQL} AS asset_type, CAST(count(*) AS BIGINT) AS asset_count
FROM (SELECT file_name FROM att UNION ALL SELECT file_name FROM img) GROUP BY 1""", "att", "img"))
def dim_asset_type_query(spark, sf_dir):
    """E19 + I17: asset types with their numbers of assets."""
    tm = TicketModel(spark, sf_dir)
    return M.dim_asset_type(M.bridge_ticket_asset(tm.attachments(), tm.images()))


@register("e17_bridge_ticket_asset", sql("""
SELECT incident_id, attachment_id AS asset_id, 'attachment' AS asset_class, file_name, content_type FROM att
UNION ALL
SELECT incident_id, image_id, 'image', file_name, content_type FROM img""", "att", "img"))
def bridge_ticket_asset_query(spark, sf_dir):
    tm = TicketModel(spark, sf_dir)
    return M.bridge_ticket_asset(tm.attachments(), tm.images())


@register("e17_bridge_ticket_change", sql("""
SELECT incident_id, change_request_id, relationship_type FROM chl""", "chl"))
def bridge_ticket_change(spark, sf_dir):
    return TicketModel(spark, sf_dir).incident_changes()


@register("e18_dim_date", sql("""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
       CAST(weekofyear(d) AS INTEGER) AS iso_week, CAST(isodow(d) AS INTEGER) AS iso_weekday,
       dayname(d) AS weekday_name
FROM (SELECT unnest(generate_series(min(CAST(opened_at AS DATE)),
                                    greatest(max(CAST(opened_at AS DATE)), max(CAST(resolved_at AS DATE))),
                                    INTERVAL 1 DAY)) AS d FROM inc)""", "inc"))
def dim_date_query(spark, sf_dir):
    inc = TicketModel(spark, sf_dir).incidents_base()
    return M.dim_date(inc, ["opened_at", "resolved_at"])


@register("e19_dim_state", sql("""
SELECT DISTINCT state, lower(state) IN ('new', 'in progress', 'on hold') AS is_open,
       lower(state) IN ('resolved', 'closed') AS is_resolved FROM inc""", "inc"))
def dim_state_query(spark, sf_dir):
    return M.dim_state(TicketModel(spark, sf_dir).incidents_base())


@register("e19_dim_priority", sql("""
SELECT DISTINCT priority, CAST(regexp_extract(priority, '^(\\d+)', 1) AS INTEGER) AS priority_rank
FROM inc""", "inc"))
def dim_priority_query(spark, sf_dir):
    return M.dim_priority(TicketModel(spark, sf_dir).incidents_base())


@register("e19_dim_category", sql("""
SELECT DISTINCT category_id, category_name, category_subcategory,
       concat_ws(' / ', category_name, category_subcategory) AS category_path FROM incd""", "incd"))
def dim_category_query(spark, sf_dir):
    return M.dim_category(TicketModel(spark, sf_dir).incidents())
