"""Registered graph queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.operators import graph as G
from caseflow.plans.oracles import initcap_sql, sql
from caseflow.plans.registry import register
from caseflow.sources.domain import TicketModel, graph_inputs, is_open


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    g = graph_inputs(TicketModel(spark, sf_dir))
    return G.build_nodes(g), G.build_edges(g)


def _edges(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    """Edges of the named types alone, ends only: duplicates don't matter to distinct counts."""
    return G.build_edges(graph_inputs(TicketModel(spark, sf_dir)), dedupe=False, only=set(types))


@register("k01_k04_nodes", sql("SELECT node_id, node_type, name FROM g_nodes", "g_nodes"))
def nodes(spark, sf_dir):
    """K1 + K4: every node type, one row per node id."""
    n, _ = _graph(spark, sf_dir)
    return n.select("node_id", "node_type", "name")


@register("k01_incident_properties", sql("""
SELECT 'incident:' || CAST(incident_id AS VARCHAR) AS node_id, number AS name, number,
       concat_ws(' ', category_name, 'issue reported by', requester_name) AS short_description, state, priority,
       strftime(opened_at, '%Y-%m-%d %H:%M:%S') AS opened_at, strftime(resolved_at, '%Y-%m-%d %H:%M:%S') AS resolved_at
FROM incd""", "incd"))
def incident_properties(spark, sf_dir):
    """K1 + I12 + B9: what the JSON properties of incident nodes hold."""
    n = G.build_nodes(graph_inputs(TicketModel(spark, sf_dir))).where("node_type = 'Incident'")

    def prop(name: str):
        return F.get_json_object("properties_json", f"$.{name}")

    return n.select("node_id", "name", *[prop(c).alias(c) for c in ("number", "short_description", "state", "priority")],
                    *[F.date_format(prop(c).cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias(c)
                      for c in ("opened_at", "resolved_at")])


@register("k05_edge_properties", sql("""
SELECT DISTINCT relationship_type, properties_json FROM (
  SELECT 'IMPACTS_SERVICE' AS relationship_type, '{"derivation":"assignment group x category"}' AS properties_json
  FROM g_inc WHERE assignment_group_id IS NOT NULL AND category_id IS NOT NULL
  UNION ALL SELECT 'HAS_ATTACHMENT', '{"content_type":"' || content_type || '","mock_url":"' || mock_url || '"}' FROM att
  UNION ALL SELECT 'HAS_IMAGE', '{"content_type":"' || content_type || '","mock_url":"' || mock_url || '"}' FROM img
  UNION ALL SELECT 'HAS_DOCUMENT', '{"source_type":"' || source_type || '"}' FROM g_docs WHERE incident_id IS NOT NULL
  UNION ALL SELECT 'BACKED_BY_DOCUMENT', '{"source_type":"kb_article"}' FROM kb
  UNION ALL SELECT 'RESOLVED_BY_PATTERN', '{"pattern_label":"' || pattern_label || '"}' FROM g_pl
            WHERE pattern_label IS NOT NULL
  UNION ALL SELECT 'RELATES_TO_CHANGE', '{"relationship_type":"' || relationship_type || '"}' FROM chl)""",
                                     "g_inc", "att", "img", "g_docs", "kb", "g_pl", "chl"))
def edge_properties(spark, sf_dir):
    """K5 + I12: the distinct JSON properties of edges that have any."""
    return _edges(spark, sf_dir, "IMPACTS_SERVICE", "HAS_ATTACHMENT", "HAS_IMAGE", "HAS_DOCUMENT",
                  "BACKED_BY_DOCUMENT", "RESOLVED_BY_PATTERN", "RELATES_TO_CHANGE") \
        .select("relationship_type", "properties_json").distinct()


@register("k05_k07_edges", sql("SELECT edge_id, source_node_id, target_node_id, relationship_type FROM g_edges",
                               "g_edges"))
def edges(spark, sf_dir):
    """K5 + K6 + K7: every edge type with hashed ids, one row per edge id."""
    _, e = _graph(spark, sf_dir)
    return e.select("edge_id", "source_node_id", "target_node_id", "relationship_type")


@register("k03_e12_resolution_patterns", sql(f"""
SELECT resolution_pattern_id, pattern_label, {initcap_sql('pattern_label')} AS name, incident_count
FROM g_pat""", "g_pat"))
def patterns(spark, sf_dir):
    """K3 + E12: resolution patterns with the distinct incident count per pattern."""
    g = graph_inputs(TicketModel(spark, sf_dir))
    _, counts = G.resolution_patterns(g["resolution_notes"])
    return counts.withColumn("name", F.initcap("pattern_label"))


@register("k08_graph_integrity", sql("""
SELECT relationship_type, CAST(count(*) AS BIGINT) AS edge_count,
       CAST(count(*) FILTER (WHERE s.node_id IS NULL) AS BIGINT) AS dangling_source,
       CAST(count(*) FILTER (WHERE t.node_id IS NULL) AS BIGINT) AS dangling_target
FROM g_edges e LEFT JOIN g_nodes s ON s.node_id = e.source_node_id
               LEFT JOIN g_nodes t ON t.node_id = e.target_node_id
GROUP BY relationship_type""", "g_edges", "g_nodes"))
def integrity(spark, sf_dir):
    """K8: whole-graph integrity: edges per type and dangling endpoints."""
    n, e = _graph(spark, sf_dir)
    return G.graph_integrity(n, e)


SEEDS_SQL = """
SELECT 'incident:' || CAST(incident_id AS VARCHAR) AS node_id FROM inc
WHERE lower(state) IN ('new', 'in progress', 'on hold')"""


def _seed_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    inc = TicketModel(spark, sf_dir).incidents_base()
    return inc.where(is_open(F.col("state"))) \
        .select(G.nid("Incident", F.col("incident_id")).alias("node_id"))


@register("k09_neighbours", sql(f"""
WITH seeds AS ({SEEDS_SQL})
SELECT x.seed_node_id, x.neighbour_node_id, x.relationship_type, x.direction,
       n.node_type AS neighbour_type, n.name AS neighbour_name
FROM (SELECT s.node_id AS seed_node_id, e.target_node_id AS neighbour_node_id, e.relationship_type, 'out' AS direction
      FROM seeds s JOIN g_edges e ON e.source_node_id = s.node_id
      UNION ALL
      SELECT s.node_id, e.source_node_id, e.relationship_type, 'in'
      FROM seeds s JOIN g_edges e ON e.target_node_id = s.node_id) x
LEFT JOIN g_nodes n ON n.node_id = x.neighbour_node_id""", "g_edges", "g_nodes", "inc"))
def neighbours(spark, sf_dir):
    """K9: everything one hop from the open tickets, both directions."""
    g = graph_inputs(TicketModel(spark, sf_dir))
    n, e = G.build_nodes(g), G.build_edges(g)
    return G.neighbours(_seed_incidents(spark, sf_dir), n, e).select(
        "seed_node_id", "neighbour_node_id", "relationship_type", "direction", "neighbour_type", "neighbour_name")


@register("k10_shared_article_and_change", sql("""
SELECT a.t AS target_a, b.t AS target_b, CAST(count(DISTINCT a.s) AS BIGINT) AS incident_count,
       min(a.s) AS first_incident_node_id
FROM (SELECT source_node_id AS s, target_node_id AS t FROM g_edges WHERE relationship_type = 'REFERENCES_KB') a
JOIN (SELECT source_node_id AS s, target_node_id AS t FROM g_edges WHERE relationship_type = 'RELATES_TO_CHANGE') b
  ON a.s = b.s
GROUP BY 1, 2 HAVING count(DISTINCT a.s) >= 2""", "g_edges"))
def shared_article_and_change(spark, sf_dir):
    """Incidents sharing an article and a change, aggregated per shared pair of nodes."""
    e = _edges(spark, sf_dir, "REFERENCES_KB", "RELATES_TO_CHANGE")
    return G.shared_neighbour_groups(e, "REFERENCES_KB", "RELATES_TO_CHANGE")


@register("k10_shared_pattern_and_service", sql("""
SELECT a.t AS target_a, b.t AS target_b, CAST(count(DISTINCT a.s) AS BIGINT) AS incident_count,
       min(a.s) AS first_incident_node_id
FROM (SELECT source_node_id AS s, target_node_id AS t FROM g_edges WHERE relationship_type = 'RESOLVED_BY_PATTERN') a
JOIN (SELECT source_node_id AS s, target_node_id AS t FROM g_edges WHERE relationship_type = 'IMPACTS_SERVICE') b
  ON a.s = b.s
GROUP BY 1, 2 HAVING count(DISTINCT a.s) >= 2""", "g_edges"))
def shared_pattern_and_service(spark, sf_dir):
    """Incidents that share a resolution pattern and a service."""
    e = _edges(spark, sf_dir, "RESOLVED_BY_PATTERN", "IMPACTS_SERVICE")
    return G.shared_neighbour_groups(e, "RESOLVED_BY_PATTERN", "IMPACTS_SERVICE")


@register("k10_shared_category_and_evidence", sql("""
SELECT t AS category_node_id, r AS relationship_type, e AS evidence_type, i AS incident_node_id,
       CAST(n AS BIGINT) AS incident_count
FROM (SELECT *, count(*) OVER (PARTITION BY t, r, e) AS n
      FROM (SELECT DISTINCT s AS i, t FROM g_e0 WHERE r = 'BELONGS_TO_CATEGORY' AND t IS NOT NULL)
      JOIN (SELECT 'incident:' || CAST(incident_id AS VARCHAR) AS i, 'HAS_IMAGE' AS r, content_type AS e FROM img
            UNION SELECT 'incident:' || incident_id, 'HAS_DOCUMENT', source_type FROM g_docs
            WHERE incident_id IS NOT NULL) USING (i)
      WHERE e IS NOT NULL)
WHERE n >= 2""", "g_e0", "img", "g_docs"))
def shared_category_and_evidence(spark, sf_dir):
    """Which incidents of a category share an image's or a document's type."""
    return G.shared_evidence_types(_edges(spark, sf_dir, "BELONGS_TO_CATEGORY", "HAS_IMAGE", "HAS_DOCUMENT"))


@register("k11_group_service_colinks", sql("""
SELECT a.t AS anchor_node_id, b.t AS linked_node_id, CAST(count(DISTINCT a.s) AS BIGINT) AS incident_count
FROM (SELECT source_node_id AS s, target_node_id AS t FROM g_edges WHERE relationship_type = 'ASSIGNED_TO_GROUP') a
JOIN (SELECT source_node_id AS s, target_node_id AS t FROM g_edges WHERE relationship_type = 'IMPACTS_SERVICE') b
  ON a.s = b.s GROUP BY 1, 2""", "g_edges"))
def group_service_colinks(spark, sf_dir):
    """Per group, how many of its tickets impact each service."""
    e = _edges(spark, sf_dir, "ASSIGNED_TO_GROUP", "IMPACTS_SERVICE")
    return G.co_link_counts(e, None, "ASSIGNED_TO_GROUP", "IMPACTS_SERVICE")


@register("k11_group_category_colinks", sql("""
SELECT anchor_node_id, linked_node_id, incident_count, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY anchor_node_id
                                    ORDER BY incident_count DESC, linked_node_id ASC) AS BIGINT) AS rank
  FROM (SELECT a.t AS anchor_node_id, b.t AS linked_node_id, CAST(count(DISTINCT a.s) AS BIGINT) AS incident_count
        FROM (SELECT source_node_id AS s, target_node_id AS t FROM g_edges
              WHERE relationship_type = 'ASSIGNED_TO_GROUP') a
        JOIN (SELECT source_node_id AS s, target_node_id AS t FROM g_edges
              WHERE relationship_type = 'BELONGS_TO_CATEGORY') b ON a.s = b.s
        WHERE a.s IN (SELECT 'incident:' || CAST(incident_id AS VARCHAR) FROM inc
                      WHERE lower(state) IN ('resolved', 'closed'))
        GROUP BY 1, 2)) WHERE rank <= 3""", "g_edges", "inc"))
def group_category_colinks(spark, sf_dir):
    """Per group, the 3 categories most linked by its resolved tickets."""
    e = _edges(spark, sf_dir, "ASSIGNED_TO_GROUP", "BELONGS_TO_CATEGORY")
    inc = TicketModel(spark, sf_dir).incidents_base()
    resolved = inc.where(F.lower("state").isin("resolved", "closed")) \
        .select(G.nid("Incident", F.col("incident_id")).alias("node_id"))
    c = G.co_link_counts(e, resolved, "ASSIGNED_TO_GROUP", "BELONGS_TO_CATEGORY")
    return G.top_linked(c, "anchor_node_id", "incident_count", 3, "linked_node_id")


REACH_SEEDS_SQL = """
SELECT 'incident:' || CAST(incident_id AS VARCHAR) AS node_id FROM inc WHERE opened_at >= TIMESTAMP '2001-07-31'"""


@register("k12_reach_two_hops", sql(f"""
WITH seeds AS ({REACH_SEEDS_SQL}),
adj AS (SELECT source_node_id AS src, target_node_id AS dst FROM g_edges
        UNION ALL SELECT target_node_id, source_node_id FROM g_edges),
h1 AS (SELECT DISTINCT a.dst AS node_id FROM seeds s JOIN adj a ON a.src = s.node_id
       WHERE a.dst NOT IN (SELECT node_id FROM seeds)),
h2 AS (SELECT DISTINCT a.dst AS node_id FROM h1 JOIN adj a ON a.src = h1.node_id
       WHERE a.dst NOT IN (SELECT node_id FROM seeds) AND a.dst NOT IN (SELECT node_id FROM h1))
SELECT DISTINCT node_id, 0 AS hops FROM seeds UNION ALL SELECT node_id, 1 FROM h1 UNION ALL SELECT node_id, 2 FROM h2
""", "g_edges", "inc"))
def reach_two_hops(spark, sf_dir):
    """Nodes within two hops (undirected) of the tickets opened in the last two days."""
    e = G.build_edges(graph_inputs(TicketModel(spark, sf_dir)), dedupe=False)
    inc = TicketModel(spark, sf_dir).incidents_base()
    seeds = inc.where(F.col("opened_at") >= F.lit("2001-07-31").cast("timestamp_ntz")) \
        .select(G.nid("Incident", F.col("incident_id")).alias("node_id"))
    return G.reach(spark, seeds, e, 2).withColumn("hops", F.col("hops").cast("int"))


@register("k13_kb_reuse_by_group", sql("""
SELECT anchor_node_id, linked_node_id, incident_count, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY anchor_node_id
                                    ORDER BY incident_count DESC, linked_node_id ASC) AS BIGINT) AS rank
  FROM (SELECT a.t AS anchor_node_id, b.t AS linked_node_id, CAST(count(DISTINCT a.s) AS BIGINT) AS incident_count
        FROM (SELECT source_node_id AS s, target_node_id AS t FROM g_edges
              WHERE relationship_type = 'ASSIGNED_TO_GROUP') a
        JOIN (SELECT source_node_id AS s, target_node_id AS t FROM g_edges
              WHERE relationship_type = 'REFERENCES_KB') b ON a.s = b.s
        GROUP BY 1, 2)) WHERE rank <= 3""", "g_edges"))
def kb_reuse_by_group(spark, sf_dir):
    """Per group, the 3 articles most reused by its tickets."""
    e = _edges(spark, sf_dir, "ASSIGNED_TO_GROUP", "REFERENCES_KB")
    c = G.co_link_counts(e, None, "ASSIGNED_TO_GROUP", "REFERENCES_KB")
    return G.top_linked(c, "anchor_node_id", "incident_count", 3, "linked_node_id")


@register("k14_service_of_oldest_open", sql(f"""
SELECT o.node_id AS incident_node_id, o.opened_at, e.target_node_id AS service_node_id, n.name AS service_name
FROM (SELECT 'incident:' || CAST(incident_id AS VARCHAR) AS node_id, opened_at FROM inc
      WHERE lower(state) IN ('new', 'in progress', 'on hold')
      ORDER BY opened_at ASC, incident_id ASC LIMIT 10) o
JOIN g_edges e ON e.source_node_id = o.node_id AND e.relationship_type = 'IMPACTS_SERVICE'
LEFT JOIN g_nodes n ON n.node_id = e.target_node_id""", "inc", "g_edges", "g_nodes"))
def service_of_oldest_open(spark, sf_dir):
    """The service nodes of the 10 oldest open tickets (top-k then one hop)."""
    g = graph_inputs(TicketModel(spark, sf_dir))
    n, e = G.service_nodes(g), G.build_edges(g, dedupe=False, only={"IMPACTS_SERVICE"})
    inc = TicketModel(spark, sf_dir).incidents_base().where(is_open(F.col("state"))) \
        .orderBy(F.col("opened_at").asc(), F.col("incident_id").asc()).limit(10) \
        .select(G.nid("Incident", F.col("incident_id")).alias("incident_node_id"), "opened_at")
    svc = e.where(F.col("relationship_type") == "IMPACTS_SERVICE").select(
        F.col("source_node_id").alias("incident_node_id"), F.col("target_node_id").alias("service_node_id"))
    names = n.select(F.col("node_id").alias("service_node_id"), F.col("name").alias("service_name"))
    return inc.join(svc, "incident_node_id").join(names, "service_node_id", "left") \
        .select("incident_node_id", "opened_at", "service_node_id", "service_name")



@register("k08_node_degree", sql("""
SELECT n.node_id, n.node_type, CAST(COALESCE(o.c, 0) AS BIGINT) AS out_degree, CAST(COALESCE(i.c, 0) AS BIGINT) AS in_degree
FROM g_nodes n
LEFT JOIN (SELECT source_node_id AS node_id, count(*) AS c FROM g_edges GROUP BY 1) o USING (node_id)
LEFT JOIN (SELECT target_node_id AS node_id, count(*) AS c FROM g_edges GROUP BY 1) i USING (node_id)""",
                                 "g_nodes", "g_edges"))
def node_degree(spark, sf_dir):
    """K8: in and out degree of every node of the whole graph (0 for isolated nodes)."""
    n, e = _graph(spark, sf_dir)
    return G.degree(n, e).select("node_id", "node_type", F.col("out_degree").cast("bigint").alias("out_degree"),
                                 F.col("in_degree").cast("bigint").alias("in_degree"))
