"""Registered list / lookup / join / paging queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.operators import listing as L
from caseflow.operators import nesting as NS
from caseflow.operators.measures import bridge_ticket_asset
from caseflow.plans.oracles import sql
from caseflow.plans.registry import register
from caseflow.sources.domain import TicketModel, uploaded_at

HISTORY_KEYWORD = "shanin"


def _c1(spark: SparkSession, sf_dir: str) -> DataFrame:
    tm = TicketModel(spark, sf_dir)
    return L.incident_with_dims(tm.incidents(), tm.users(), tm.assignees())


C1_SQL = """
SELECT incd.incident_id, incd.number, incd.state, incd.priority, incd.updated_at, incd.category_id,
       incd.category_name, incd.category_subcategory, incd.assignment_group_id, incd.assignment_group_name,
       incd.requester_name, u.email AS requester_email, asg.assignee_id, a.full_name AS assignee_name
FROM incd
JOIN usr u ON u.user_id = 'C' || CAST(incd.requester_id AS VARCHAR)
LEFT JOIN asg ON asg.incident_id = incd.incident_id
LEFT JOIN usr a ON a.user_id = 'S' || CAST(asg.assignee_id AS VARCHAR)
WHERE incd.category_id IS NOT NULL AND incd.assignment_group_id IS NOT NULL"""

C1_COLS = ["incident_id", "number", "state", "priority", "updated_at", "category_id", "category_name",
           "category_subcategory", "assignment_group_id", "assignment_group_name", "requester_name",
           "requester_email", "assignee_id", "assignee_name"]


@register("c01_incident_with_dims", sql(C1_SQL, "incd", "usr", "asg"))
def incident_with_dims(spark, sf_dir):
    return _c1(spark, sf_dir).select(*C1_COLS)


@register("b04_g01_list_page", sql(f"""
SELECT * FROM ({C1_SQL}) c1
WHERE lower(state) = 'in progress'
  AND (lower(category_id) = 'building' OR lower(category_name) = 'building'
       OR lower(category_subcategory) = 'building')
ORDER BY updated_at DESC, number ASC LIMIT 20 OFFSET 20""", "incd", "usr", "asg"))
def list_page(spark, sf_dir):
    """B4 + G1 + G2: page 2 of 20 In Progress tickets in category BUILDING."""
    df = _c1(spark, sf_dir).where(L.list_filter(state="In Progress", category="BUILDING"))
    return L.page(df.select(*C1_COLS), L.incident_order(), page_no=2, size=20)


@register("d04_list_totals", sql(f"""
SELECT CAST(count(*) AS BIGINT) AS total_items,
       CAST(CASE WHEN count(*) = 0 THEN 0 ELSE greatest(1, ceil(count(*) / 20.0)) END AS BIGINT) AS total_pages
FROM ({C1_SQL}) c1
WHERE lower(state) = 'in progress' AND lower(assignment_group_name) = 'nation_7'
  AND updated_at >= TIMESTAMP '1998-01-01 00:00:00'""", "incd", "usr", "asg"))
def list_totals(spark, sf_dir):
    """D4 + G1: total items and pages for a filtered list."""
    df = _c1(spark, sf_dir).where(L.list_filter(state="In Progress", group="NATION_7",
                                                updated_since="1998-01-01 00:00:00"))
    return L.page_totals(df, size=20)


@register("b05_kb_keyword", sql("""
SELECT kb_article_id, kb_article_number, audience FROM kb
WHERE title_raw ILIKE '%bolt%' OR content_text ILIKE '%bolt%'""", "kb"))
def kb_keyword(spark, sf_dir):
    kb = TicketModel(spark, sf_dir).kb_articles()
    return kb.where(L.keyword_like(["title", "content_text"], "bolt")) \
        .select("kb_article_id", "kb_article_number", "audience")


@register("b06_g03_follow_up_queue", sql("""
SELECT incident_id, number, state, updated_at FROM inc
WHERE follow_up_required AND lower(state) IN ('new', 'in progress', 'on hold')
ORDER BY updated_at ASC, number ASC LIMIT 50""", "inc"))
def follow_up_queue(spark, sf_dir):
    inc = TicketModel(spark, sf_dir).incidents_base()
    return L.follow_up_queue(inc, limit=50).select("incident_id", "number", "state", "updated_at")


def _lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed lookup keys: every open follow-up ticket, by id (even keys) or number (odd)."""
    inc = TicketModel(spark, sf_dir).incidents_base().where(L.open_follow_up())
    return inc.select(F.when(F.col("incident_id") % 2 == 0, F.col("incident_id").cast("string"))
                      .otherwise(F.col("number")).alias("lookup_key"))


@register("b07_assets_for_keys", sql("""
SELECT DISTINCT k.lookup_key, a.asset_id, a.incident_id, a.asset_class
FROM lkeys k JOIN assets a
  ON k.lookup_key = CAST(a.incident_id AS VARCHAR) OR k.lookup_key = printf('INC%07d', a.incident_id)""",
                                       "lkeys", "assets"))
def assets_for_keys(spark, sf_dir):
    """Assets of tickets looked up by id or number (batched)."""
    tm = TicketModel(spark, sf_dir)
    assets = bridge_ticket_asset(tm.attachments(), tm.images()) \
        .withColumn("number", F.format_string("INC%07d", F.col("incident_id")))
    out = L.lookup_by_id_or_number(_lookup_keys(spark, sf_dir), assets, row_key="asset_id")
    return out.select("lookup_key", "asset_id", "incident_id", "asset_class")


@register("b08_incident_lookup", sql("""
SELECT DISTINCT k.lookup_key, i.incident_id, i.number, i.state
FROM lkeys k JOIN inc i ON k.lookup_key = CAST(i.incident_id AS VARCHAR) OR k.lookup_key = i.number""",
                                       "lkeys", "inc"))
def incident_lookup(spark, sf_dir):
    """Batched lookup by id or number."""
    inc = TicketModel(spark, sf_dir).incidents_base()
    out = L.lookup_by_id_or_number(_lookup_keys(spark, sf_dir), inc, row_key="incident_id")
    return out.select("lookup_key", "incident_id", "number", "state")


@register("b10_filter_from_dict", sql("""
SELECT incident_id, number, state, priority FROM inc
WHERE state IN ('In Progress', 'On Hold') AND priority = '1-URGENT' AND follow_up_required""", "inc"))
def filter_dict(spark, sf_dir):
    inc = TicketModel(spark, sf_dir).incidents_base()
    pred = L.filter_from_dict({"state": ["In Progress", "On Hold"], "priority": "1-URGENT",
                               "follow_up_required": True})
    return inc.where(pred).select("incident_id", "number", "state", "priority")


@register("b11_range_filter", sql("""
SELECT incident_id, number, total_price FROM inc
WHERE opened_at >= TIMESTAMP '2001-01-01 00:00:00' AND total_price < 100000""", "inc"))
def range_filter(spark, sf_dir):
    inc = TicketModel(spark, sf_dir).incidents_base()
    pred = L.filter_from_dict({"opened_at_gte": "2001-01-01 00:00:00", "total_price_lt": 100000})
    return inc.where(pred).select("incident_id", "number", "total_price")


@register("b10_raw_predicate", sql("""
SELECT incident_id, number FROM inc WHERE priority_rank <= 2 AND state = 'On Hold'""", "inc"))
def raw_predicate(spark, sf_dir):
    """B10 raw form: a Spark SQL predicate string passes through."""
    inc = TicketModel(spark, sf_dir).incidents_base()
    return inc.where(L.filter_from_dict("priority_rank <= 2 AND state = 'On Hold'")) \
        .select("incident_id", "number")


@register("c02_notes_with_author", sql("""
SELECT n.note_id, n.incident_id, n.author_user_id, u.full_name AS author_name, n.created_at
FROM notes n JOIN usr u ON u.user_id = n.author_user_id""", "notes", "usr"))
def notes_with_author(spark, sf_dir):
    tm = TicketModel(spark, sf_dir)
    return L.notes_with_author(tm.notes(), tm.users()) \
        .select("note_id", "incident_id", "author_user_id", "author_name", "created_at")


@register("c03_links_with_kb", sql("""
SELECT l.incident_id, l.kb_article_id, kb.kb_article_number, kb.category_name
FROM kbl l JOIN kb USING (kb_article_id)""", "kbl", "kb"))
def links_with_kb(spark, sf_dir):
    tm = TicketModel(spark, sf_dir)
    return L.links_with_kb(tm.incident_kb_links(), tm.kb_articles()) \
        .select("incident_id", "kb_article_id", "kb_article_number", "category_name")


@register("c04_links_with_change", sql("""
SELECT l.incident_id, l.change_request_id, c.number, c.state, l.relationship_type
FROM chl l JOIN chg c USING (change_request_id)""", "chl", "chg"))
def links_with_change(spark, sf_dir):
    tm = TicketModel(spark, sf_dir)
    return L.links_with_change(tm.incident_changes(), tm.change_requests()) \
        .select("incident_id", "change_request_id", "number", "state", "relationship_type")


@register("c05_assets_with_incident", sql("""
SELECT a.attachment_id, a.incident_id, i.number AS incident_number_resolved, a.file_name
FROM att a JOIN inc i USING (incident_id)""", "att", "inc"))
def assets_with_incident(spark, sf_dir):
    tm = TicketModel(spark, sf_dir)
    return L.assets_with_incident(tm.attachments(), tm.incidents_base()) \
        .select("attachment_id", "incident_id", "incident_number_resolved", "file_name")


@register("c06_history_search", sql(f"""
SELECT i.incident_id, i.number, i.state
FROM incd i LEFT JOIN txt t USING (incident_id)
WHERE lower(i.state) IN ('resolved', 'closed')
  AND (i.short_description ILIKE '%{HISTORY_KEYWORD}%' OR t.description_text ILIKE '%{HISTORY_KEYWORD}%'
       OR t.resolution_summary_text ILIKE '%{HISTORY_KEYWORD}%'
       OR EXISTS (SELECT 1 FROM notes n WHERE n.incident_id = i.incident_id
                  AND n.note_text ILIKE '%{HISTORY_KEYWORD}%'))""".replace(
    "FROM incd i", "FROM (SELECT incd.*, concat_ws(' ', category_name, 'issue reported by', requester_name)"
    " AS short_description FROM incd) i"), "incd", "txt", "notes"))
def history_search(spark, sf_dir):
    """Keyword in title / description / resolution summary or EXISTS a matching note."""
    tm = TicketModel(spark, sf_dir)
    out = L.history_search(tm.incidents(), tm.incident_texts(), tm.work_notes(), tm.resolution_notes(),
                           HISTORY_KEYWORD)
    return out.select("incident_id", "number", "state")


#: Items of an array in the query's rows: few, since tickets here have seven of a kind at most.
DETAIL_CHUNK = 3


def detail_children(tm: TicketModel) -> dict[str, tuple[DataFrame, list[str]]]:
    """The nine nested parts of a ticket's detail, each with its order (the last column breaks ties)."""
    kb = tm.kb_articles().select("kb_article_id", "kb_article_number", "title", "audience", "category_name")

    def assets(rows: DataFrame, key: str) -> tuple[DataFrame, list[str]]:
        return rows.withColumn("uploaded_at", uploaded_at(F.col("incident_id"))), ["uploaded_at", key]

    return {
        "slas": (tm.slas(), ["name", "sla_id", "elapsed_hours"]),
        "related_kb_articles": (L.links_with_kb(tm.incident_kb_links(), kb), ["kb_article_number"]),
        "change_requests": (L.links_with_change(tm.incident_changes(), tm.change_requests()), ["number"]),
        "work_notes": (tm.work_notes(), ["created_at", "work_note_id"]),
        "resolution_notes": (tm.resolution_notes(), ["created_at", "resolution_note_id"]),
        "attachments": assets(tm.attachments(), "attachment_id"),
        "images": assets(tm.images(), "image_id"),
        "documents": assets(tm.document_assets(), "document_id"),
        "external_references": (tm.external_references(), ["title", "external_reference_id"]),
    }


#: What the query shows of an item, by part.
DETAIL_FIELDS = {
    "slas": ["sla_id", "stage"], "related_kb_articles": ["kb_article_number", "audience"],
    "change_requests": ["number", "state", "relationship_type"], "work_notes": ["work_note_id", "note_text"],
    "resolution_notes": ["resolution_note_id", "note_text"], "attachments": ["attachment_id", "file_name"],
    "images": ["image_id", "file_name"], "documents": ["document_id", "file_name"],
    "external_references": ["external_reference_id", "url"],
}


def _detail_sql() -> str:
    """The nine parts numbered within their ticket."""
    source = {
        "slas": ("sla", "name, sla_id, elapsed_hours"), "related_kb_articles": ("kbl JOIN kb USING (kb_article_id)", "kb_article_number"),
        "change_requests": ("chl JOIN chg USING (change_request_id)", "number"),
        "work_notes": ("(SELECT *, note_id AS work_note_id FROM notes WHERE NOT is_resolution)", "created_at, note_id"),
        "resolution_notes": ("(SELECT *, note_id AS resolution_note_id FROM notes WHERE is_resolution)",
                             "created_at, note_id"),
        "attachments": ("att", "attachment_id"), "images": ("img", "image_id"),
        "documents": ("(SELECT item_id AS incident_id, 'DOC' || CAST(item_id AS VARCHAR) AS document_id, "
                      "'runbook_' || CAST(item_id AS VARCHAR) || '.pdf' AS file_name FROM benchmark)", "document_id"),
        "external_references": ("(SELECT page_id AS incident_id, 'REF' || CAST(page_id AS VARCHAR) AS "
                                "external_reference_id, url FROM pages)", "external_reference_id"),
    }
    return " UNION ALL ".join(
        f"SELECT incident_id, '{kind}' AS part, concat_ws('|', {', '.join(DETAIL_FIELDS[kind])}) AS item, "
        f"row_number() OVER (PARTITION BY incident_id ORDER BY {order}) - 1 AS place FROM {table}"
        for kind, (table, order) in source.items())


@register("c07_nested_detail", sql(f"""
SELECT i.incident_id, CASE WHEN place < {DETAIL_CHUNK} THEN number END AS number,
       CASE WHEN place < {DETAIL_CHUNK} THEN i.state END AS state, CAST(place // {DETAIL_CHUNK} AS BIGINT) AS chunk_no, part,
       CAST(place % {DETAIL_CHUNK} AS INTEGER) AS position, item
FROM ({_detail_sql()}) c JOIN inc i USING (incident_id)""",
    "inc", "sla", "kbl", "kb", "chl", "chg", "notes", "att", "img"))
def nested_detail_items(spark, sf_dir):
    """Every ticket's nested detail in chunks, opened again: each item with its chunk and position."""
    tm = TicketModel(spark, sf_dir)
    inc = tm.incidents_base().select("incident_id", "number", "state", "priority", "opened_at")
    nested = NS.nest_in_chunks(inc, "incident_id", detail_children(tm), chunk=DETAIL_CHUNK)

    def opened(part: str):
        return F.transform(part, lambda x, at: F.struct(
            F.lit(part).alias("part"), at.alias("position"),
            F.concat_ws("|", *[x[f] for f in DETAIL_FIELDS[part]]).alias("item")))

    return nested.select("incident_id", "number", "state", "chunk_no",
                         F.explode(F.flatten(F.array(*[opened(p) for p in DETAIL_FIELDS]))).alias("x")) \
        .select("incident_id", "number", "state", "chunk_no", "x.part", "x.position", "x.item")


DETAIL_ARRAYS = ["slas", "related_kb_articles", "change_requests", "work_notes", "resolution_notes",
                 "attachments", "images"]


@register("c07_b16_detail_summary", sql("""
SELECT i.incident_id, i.number, i.state,
  CAST(COALESCE((SELECT count(*) FROM sla s WHERE s.incident_id = i.incident_id), 0) AS BIGINT) AS slas_count,
  CAST(COALESCE((SELECT count(*) FROM kbl k JOIN kb USING (kb_article_id) WHERE k.incident_id = i.incident_id), 0) AS BIGINT) AS related_kb_articles_count,
  CAST(COALESCE((SELECT count(*) FROM chl c JOIN chg USING (change_request_id) WHERE c.incident_id = i.incident_id), 0) AS BIGINT) AS change_requests_count,
  CAST(COALESCE((SELECT count(*) FROM notes n WHERE n.incident_id = i.incident_id AND NOT is_resolution), 0) AS BIGINT) AS work_notes_count,
  CAST(COALESCE((SELECT count(*) FROM notes n WHERE n.incident_id = i.incident_id AND is_resolution), 0) AS BIGINT) AS resolution_notes_count,
  CAST(COALESCE((SELECT count(*) FROM att a WHERE a.incident_id = i.incident_id), 0) AS BIGINT) AS attachments_count,
  CAST(COALESCE((SELECT count(*) FROM img m WHERE m.incident_id = i.incident_id), 0) AS BIGINT) AS images_count
FROM inc i""", "inc", "sla", "kbl", "kb", "chl", "chg", "notes", "att", "img"))
def detail_summary(spark, sf_dir):
    """Per incident the number of its children of each kind, counted by key alone."""
    tm = TicketModel(spark, sf_dir)
    children = detail_children(tm)
    return NS.child_counts(tm.incidents_base().select("incident_id", "number", "state"), "incident_id",
                           {name: children[name][0] for name in DETAIL_ARRAYS})


@register("c08_business_services", sql("""
SELECT DISTINCT assignment_group_id, assignment_group_name, category_id, category_name,
       sha256(concat_ws('|', CAST(assignment_group_id AS VARCHAR), category_id)) AS service_id,
       concat_ws(' - ', assignment_group_name, category_name) AS service_name
FROM incd""", "incd"))
def business_services(spark, sf_dir):
    return L.business_services(TicketModel(spark, sf_dir).incidents())


@register("c10_orphan_check", sql("""
SELECT 'incident_changes.change_request_id' AS fk, CAST(count(*) AS BIGINT) AS orphan_rows
  FROM chl WHERE change_request_id NOT IN (SELECT change_request_id FROM chg)
UNION ALL
SELECT 'incident_kb_links.kb_article_id', CAST(count(*) AS BIGINT)
  FROM kbl WHERE kb_article_id NOT IN (SELECT kb_article_id FROM kb)
UNION ALL
SELECT 'attachments.incident_id', CAST(count(*) AS BIGINT)
  FROM att WHERE incident_id NOT IN (SELECT incident_id FROM inc)
UNION ALL
SELECT 'images.incident_id', CAST(count(*) AS BIGINT)
  FROM img WHERE incident_id NOT IN (SELECT incident_id FROM inc)
UNION ALL
SELECT 'incidents.requester_id', CAST(count(*) AS BIGINT)
  FROM inc WHERE requester_id NOT IN (SELECT c_custkey FROM customer)""", "chl", "chg", "kbl", "kb", "att",
                                          "img", "inc"))
def orphan_check_query(spark, sf_dir):
    """Orphan rows per foreign key (left anti joins), one union."""
    tm = TicketModel(spark, sf_dir)
    checks = [
        ("incident_changes.change_request_id", tm.incident_changes(), tm.change_requests(),
         "change_request_id", "change_request_id"),
        ("incident_kb_links.kb_article_id", tm.incident_kb_links(), tm.kb_articles(),
         "kb_article_id", "kb_article_id"),
        ("attachments.incident_id", tm.attachments(), tm.incidents_base(), "incident_id", "incident_id"),
        ("images.incident_id", tm.images(), tm.incidents_base(), "incident_id", "incident_id"),
        ("incidents.requester_id", tm.incidents_base(),
         tm.raw("customer").select(F.col("c_custkey").alias("requester_id")), "requester_id", "requester_id"),
    ]
    out = None
    for name, child, parent, fk, pk in checks:
        part = L.orphan_check(child.select(fk), parent, fk, pk) \
            .agg(F.count(F.lit(1)).cast("bigint").alias("orphan_rows")) \
            .select(F.lit(name).alias("fk"), "orphan_rows")
        out = part if out is None else out.unionByName(part)
    return out


@register("g04_asset_page", sql("""
SELECT * FROM (
  SELECT incident_id, attachment_id AS asset_id, 'attachment' AS asset_class, file_name, content_type FROM att
  UNION ALL SELECT incident_id, image_id, 'image', file_name, content_type FROM img)
ORDER BY incident_id DESC, file_name ASC LIMIT 25 OFFSET 50""", "att", "img"))
def asset_page(spark, sf_dir):
    """G4 + G1: asset listing, page 3 of 25."""
    tm = TicketModel(spark, sf_dir)
    assets = bridge_ticket_asset(tm.attachments(), tm.images())
    return L.page(assets, [F.col("incident_id").desc(), F.col("file_name").asc()], page_no=3, size=25)


@register("g05_top_by_score", sql("""
SELECT * FROM (
  SELECT category_name, incident_id, total_price AS score,
         row_number() OVER (PARTITION BY category_name ORDER BY total_price DESC, incident_id ASC) AS rank
  FROM incd) WHERE rank <= 5""", "incd"))
def top_by_score(spark, sf_dir):
    """Top 5 tickets per category by a score, ties by id."""
    inc = TicketModel(spark, sf_dir).incidents().select(
        "category_name", "incident_id", F.col("total_price").alias("score"))
    return L.top_by_score(inc, 5, ["category_name"], "score", ["incident_id"]) \
        .withColumn("rank", F.col("rank").cast("bigint"))


@register("d06_distinct_changes_per_group", sql("""
SELECT incd.assignment_group_name, CAST(count(DISTINCT chl.change_request_id) AS BIGINT) AS distinct_changes
FROM chl JOIN incd USING (incident_id) GROUP BY 1""", "chl", "incd"))
def distinct_changes_per_group(spark, sf_dir):
    """Distinct count per group (two-phase aggregation with distinct rewrite)."""
    tm = TicketModel(spark, sf_dir)
    j = tm.incident_changes().join(tm.incidents().select("incident_id", "assignment_group_name"),
                                   "incident_id")
    return j.groupBy("assignment_group_name").agg(
        F.count_distinct("change_request_id").cast("bigint").alias("distinct_changes"))


@register("d05_health_counts", sql("""
SELECT (SELECT CAST(count(*) AS BIGINT) FROM orders) AS incident_count,
       (SELECT CAST(count(*) AS BIGINT) FROM part) AS kb_article_count"""))
def health_counts(spark, sf_dir):
    """Incident and article counts in one row."""
    tm = TicketModel(spark, sf_dir)
    a = tm.incidents_base().select(F.lit(1).alias("i"), F.lit(0).alias("k"))
    b = tm.kb_articles().select(F.lit(0).alias("i"), F.lit(1).alias("k"))
    return a.unionByName(b).agg(F.sum("i").cast("bigint").alias("incident_count"),
                                F.sum("k").cast("bigint").alias("kb_article_count"))
