"""DuckDB restatements of the domain mapping, used by the SQL oracles.

Each fragment is one CTE.  ``sql(body, *ctes)`` prepends the CTEs a query
needs (dependencies first).  These are test oracles: they restate the same
mapping as ``caseflow.sources.domain`` in plain SQL over the driver's views.
"""

from __future__ import annotations

AS_OF_SQL = "DATE '2001-08-02'"

#: I17 over a column file_name.
ASSET_TYPE_SQL = """CASE lower(regexp_extract(file_name, '\\.([^.]*)$', 1))
         WHEN 'png' THEN 'screenshot' WHEN 'jpg' THEN 'screenshot' WHEN 'jpeg' THEN 'screenshot'
         WHEN 'gif' THEN 'screenshot' WHEN 'log' THEN 'log' WHEN 'txt' THEN 'log' WHEN 'sql' THEN 'script'
         WHEN 'ps1' THEN 'script' WHEN 'sh' THEN 'script' WHEN 'py' THEN 'script' WHEN 'pdf' THEN 'document'
         WHEN 'docx' THEN 'document' WHEN 'xlsx' THEN 'document' ELSE 'other' END"""

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "inc": ((), """
  SELECT o_orderkey AS incident_id,
         printf('INC%07d', o_orderkey) AS number,
         CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Resolved' ELSE 'Closed' END
              WHEN o_orderstatus = 'O' THEN 'In Progress'
              WHEN o_orderstatus = 'P' THEN 'On Hold' ELSE 'New' END AS state,
         o_orderpriority AS priority,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_rank,
         o_orderdate AS opened_at,
         o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS updated_at,
         CASE WHEN o_orderstatus = 'F'
              THEN o_orderdate + to_hours(CAST((o_orderkey * 37) % 240 + 1 AS INTEGER)) END AS resolved_at,
         (o_orderkey % 4) >= 2 AS follow_up_required,
         o_custkey AS requester_id,
         o_totalprice AS total_price
  FROM orders"""),
    "cdim": ((), """
  SELECT c.c_custkey AS requester_id, c.c_name AS requester_name,
         c.c_nationkey AS assignment_group_id, n.n_name AS assignment_group_name,
         concat_ws('/', lower(c.c_mktsegment), lower(r.r_name)) AS category_id,
         c.c_mktsegment AS category_name, r.r_name AS category_subcategory
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "incd": (("inc", "cdim"), """
  SELECT inc.*, cdim.requester_name, cdim.assignment_group_id, cdim.assignment_group_name,
         cdim.category_id,
         cdim.category_name, cdim.category_subcategory
  FROM inc LEFT JOIN cdim ON inc.requester_id = cdim.requester_id"""),
    "reo": ((), """
  SELECT l_orderkey AS incident_id, CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS reopen_count
  FROM lineitem GROUP BY l_orderkey"""),
    "fact": (("incd", "reo"), f"""
  SELECT incd.*,
         lower(state) IN ('new', 'in progress', 'on hold') AS is_open,
         lower(state) IN ('resolved', 'closed') AS is_resolved,
         date_diff('second', opened_at, resolved_at) / 3600.0 AS resolution_hours,
         date_diff('hour', opened_at, resolved_at) AS resolution_hour_boundaries,
         CAST(date_diff('day', CAST(opened_at AS DATE), {AS_OF_SQL}) AS BIGINT) AS age_days,
         CAST(strftime(opened_at, '%Y%m%d') AS INTEGER) AS opened_date_key,
         CAST(strftime(resolved_at, '%Y%m%d') AS INTEGER) AS resolved_date_key,
         COALESCE(reo.reopen_count, 0) AS reopen_count
  FROM incd LEFT JOIN reo ON incd.incident_id = reo.incident_id"""),
    "factb": (("fact",), """
  SELECT fact.*,
         CASE WHEN is_open THEN age_days END AS open_age_days,
         CASE WHEN NOT is_open THEN NULL
              WHEN age_days BETWEEN 0 AND 1 THEN '0-1' WHEN age_days BETWEEN 2 AND 3 THEN '2-3'
              WHEN age_days BETWEEN 4 AND 7 THEN '4-7' WHEN age_days BETWEEN 8 AND 14 THEN '8-14'
              WHEN age_days BETWEEN 15 AND 30 THEN '15-30' WHEN age_days > 30 THEN '31+' END
           AS open_age_bucket
  FROM fact"""),
    "sla": (("inc",), """
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS sla_id,
         inc.incident_id, 'Resolution' AS name,
         CASE WHEN l.l_quantity * 3.0 > inc.priority_rank * 24.0 THEN 'Breached' ELSE 'Within target' END AS stage,
         CAST(inc.priority_rank AS DOUBLE) * 24.0 AS target_hours,
         l.l_quantity * 3.0 AS elapsed_hours,
         l.l_quantity * 3.0 > inc.priority_rank * 24.0 AS breached
  FROM lineitem l JOIN inc ON l.l_orderkey = inc.incident_id"""),
    "kbl": ((), """
  SELECT DISTINCT l_orderkey AS incident_id, l_partkey AS kb_article_id FROM lineitem"""),
    "chl": ((), """
  SELECT DISTINCT l_orderkey AS incident_id, l_suppkey AS change_request_id, 'caused_by' AS relationship_type
  FROM lineitem"""),
    "asg": ((), """
  SELECT l_orderkey AS incident_id, min(l_suppkey) AS assignee_id FROM lineitem WHERE l_linenumber = 1
  GROUP BY l_orderkey"""),
    "kb": ((), """
  SELECT p_partkey AS kb_article_id, printf('KB%07d', p_partkey) AS kb_article_number,
         p_name AS title_raw, CASE WHEN p_size < 25 THEN 'internal' ELSE 'public' END AS audience,
         'How to handle a ' || p_name || ' of type ' || p_type || ' & brand ' || p_brand AS content_text,
         lower(p_type) AS category_id, p_type AS category_name, p_brand AS category_subcategory,
         CAST(p_size * 40 AS INTEGER) AS view_count, CAST(p_size * 3 AS INTEGER) AS useful_count
  FROM part"""),
    "att": ((), """
  SELECT 'ATT' || CAST(doc_id AS VARCHAR) AS attachment_id, doc_id AS incident_id,
         printf('INC%07d', doc_id) AS incident_number,
         'document_' || CAST(doc_id AS VARCHAR) || '.' ||
           ['png','jpg','jpeg','gif','log','txt','sql','ps1','sh','py','pdf','docx','xlsx','zip'][doc_id % 14 + 1] AS file_name,
         'application/' ||
           ['png','jpg','jpeg','gif','log','txt','sql','ps1','sh','py','pdf','docx','xlsx','zip'][doc_id % 14 + 1] AS content_type,
         'Attachment from ' || source || ' (' || lang || ')' AS description,
         'https://assets.example.invalid/attachments/' || CAST(doc_id AS VARCHAR) AS mock_url,
         CAST(trunc((n_chars + 1023) / 1024) AS INTEGER) AS file_size_kb
  FROM documents"""),
    "img": ((), """
  SELECT 'IMG' || CAST(page_id AS VARCHAR) AS image_id, page_id AS incident_id,
         printf('INC%07d', page_id) AS incident_number,
         'screen_' || CAST(page_id AS VARCHAR) || '.png' AS file_name, 'image/png' AS content_type,
         'Screenshot of ' || url AS description,
         'https://assets.example.invalid/images/' || CAST(page_id AS VARCHAR) AS mock_url,
         CAST(page_id % 1000 + 640 AS INTEGER) AS width_px, CAST(page_id % 500 + 480 AS INTEGER) AS height_px
  FROM pages"""),
    "notes": (("inc", "asg"), """
  SELECT CAST(c.conv_id AS VARCHAR) || '-' || CAST(c.turn AS VARCHAR) AS note_id,
         inc.incident_id, c.turn, c.role,
         CASE WHEN c.role = 'user' THEN 'C' || CAST(inc.requester_id AS VARCHAR)
              ELSE 'S' || CAST(asg.assignee_id AS VARCHAR) END AS author_user_id,
         inc.opened_at + to_hours(CAST(c.turn + 1 AS INTEGER)) AS created_at,
         c.text AS note_text, c.role = 'system' AS is_resolution
  FROM conversations c JOIN inc ON c.conv_id = inc.incident_id
       LEFT JOIN asg ON asg.incident_id = inc.incident_id"""),
    "users": ((), """
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS user_id, c_name AS full_name, 'Requester' AS title,
         c_nationkey AS nationkey
  FROM customer
  UNION ALL
  SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, 'Agent', s_nationkey FROM supplier"""),
    "usr": (("users",), """
  SELECT users.*, lower(regexp_replace(full_name, '[^A-Za-z0-9]+', '.', 'g')) || '@example.invalid' AS email
  FROM users"""),
    "chg": ((), """
  SELECT s_suppkey AS change_request_id, printf('CHG%07d', s_suppkey) AS number,
         'Change by ' || s_name AS title,
         CASE WHEN s_acctbal < 0 THEN 'Cancelled' ELSE 'Implemented' END AS state,
         CASE WHEN s_acctbal < 1000 THEN 'High' ELSE 'Low' END AS risk
  FROM supplier"""),
    "lkeys": (("inc",), """
  SELECT CASE WHEN incident_id % 2 = 0 THEN CAST(incident_id AS VARCHAR) ELSE number END AS lookup_key
  FROM inc WHERE follow_up_required AND lower(state) IN ('new', 'in progress', 'on hold')"""),
    "assets": (("att", "img"), """
  SELECT incident_id, attachment_id AS asset_id, 'attachment' AS asset_class, file_name, content_type FROM att
  UNION ALL SELECT incident_id, image_id, 'image', file_name, content_type FROM img"""),
    "txt": ((), """
  SELECT COALESCE(d.doc_id, p.page_id) AS incident_id, d.text AS description_text,
         p.html AS resolution_summary_html,
         trim(regexp_replace(regexp_replace(p.html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))
           AS resolution_summary_text
  FROM documents d FULL JOIN pages p ON d.doc_id = p.page_id"""),
}


def sql(body: str, *ctes: str) -> str:
    """Prefix ``body`` with the named CTEs and their dependencies, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        deps, _ = CTES[name]
        for d in deps:
            visit(d)
        order.append(name)

    for c in ctes:
        visit(c)
    body = body.strip()
    if not order:
        return body
    with_clause = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    if body[:5].upper() == "WITH ":  # the body brings CTEs of its own: append them
        return f"WITH {with_clause},\n{body[5:]}"
    return f"WITH {with_clause}\n{body}"


def initcap_sql(x: str) -> str:
    """DuckDB restatement of Spark's initcap (words split on single spaces)."""
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


def pattern_label_sql(x: str) -> str:
    t = f"lower(trim(regexp_replace({x}, '[^A-Za-z0-9]', ' ', 'g')))"
    return f"CASE WHEN length({t}) > 20 THEN array_to_string(string_split({t}, ' ')[1:12], ' ') END"


CTES.update({
    "g_inc": (("incd", "asg"), """
  SELECT CAST(incident_id AS VARCHAR) AS incident_id, number, state, priority, opened_at,
         'C' || CAST(requester_id AS VARCHAR) AS requester_id,
         'S' || CAST(asg.assignee_id AS VARCHAR) AS assignee_id,
         CAST(assignment_group_id AS VARCHAR) AS assignment_group_id, category_id
  FROM incd LEFT JOIN asg USING (incident_id)"""),
    "g_cat": (("incd", "kb"), """
  SELECT DISTINCT category_id, category_name AS name, category_subcategory AS subcategory FROM incd
  WHERE category_id IS NOT NULL
  UNION SELECT DISTINCT category_id, category_name, NULL FROM kb"""),
    "g_docs": (("notes", "kb"), f"""
  SELECT 'incident:' || CAST(doc_id AS VARCHAR) AS retrieval_document_id, CAST(doc_id AS VARCHAR) AS incident_id,
         NULL AS kb_article_id, printf('INC%07d', doc_id) AS title, 'incident_description' AS source_type
  FROM documents WHERE trim(text) <> ''
  UNION ALL
  SELECT CASE WHEN is_resolution THEN 'resolution-note:' ELSE 'work-note:' END || note_id,
         CAST(incident_id AS VARCHAR), NULL,
         CASE WHEN is_resolution THEN 'Resolution note for ' ELSE 'Work note for ' END || CAST(incident_id AS VARCHAR),
         CASE WHEN is_resolution THEN 'resolution_note' ELSE 'work_note' END
  FROM notes WHERE trim(note_text) <> ''
  UNION ALL
  SELECT 'kb-article:' || CAST(kb_article_id AS VARCHAR), NULL, CAST(kb_article_id AS VARCHAR),
         {initcap_sql('title_raw')}, 'kb_article' FROM kb"""),
    "g_pl": (("notes",), f"""
  SELECT CAST(incident_id AS VARCHAR) AS incident_id, {pattern_label_sql('note_text')} AS pattern_label
  FROM notes WHERE is_resolution"""),
    "g_pat": (("g_pl",), """
  SELECT sha256(pattern_label) AS resolution_pattern_id, pattern_label,
         CAST(count(DISTINCT incident_id) AS BIGINT) AS incident_count
  FROM g_pl WHERE pattern_label IS NOT NULL GROUP BY pattern_label"""),
    "g_nodes": (("g_inc", "g_cat", "g_docs", "g_pat", "usr", "kb", "att", "img", "chg", "cdim"), f"""
  SELECT DISTINCT node_id, node_type, name FROM (
    SELECT 'incident:' || incident_id AS node_id, 'Incident' AS node_type, number AS name FROM g_inc
    UNION ALL SELECT 'user:' || user_id, 'User', full_name FROM usr
      WHERE user_id IN (SELECT requester_id FROM g_inc UNION SELECT assignee_id FROM g_inc)
    UNION ALL SELECT 'group:' || CAST(n_nationkey AS VARCHAR), 'AssignmentGroup', n_name FROM nation
    UNION ALL SELECT 'category:' || category_id, 'Category', concat_ws(' / ', name, subcategory) FROM g_cat
    UNION ALL SELECT DISTINCT 'service:' || sha256(concat_ws('|', i.assignment_group_id, i.category_id)),
                     'BusinessService', concat_ws(' / ', n.n_name, c.name)
      FROM g_inc i LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = i.assignment_group_id
                   LEFT JOIN (SELECT DISTINCT category_id, name FROM g_cat) c ON c.category_id = i.category_id
    UNION ALL SELECT 'kb:' || CAST(kb_article_id AS VARCHAR), 'KnowledgeArticle', {initcap_sql('title_raw')} FROM kb
    UNION ALL SELECT 'attachment:' || attachment_id, 'Attachment', file_name FROM att
    UNION ALL SELECT 'image:' || image_id, 'Image', file_name FROM img
    UNION ALL SELECT 'document:' || retrieval_document_id, 'Document', title FROM g_docs
    UNION ALL SELECT 'change:' || CAST(change_request_id AS VARCHAR), 'ChangeRequest', number FROM chg
    UNION ALL SELECT 'pattern:' || resolution_pattern_id, 'ResolutionPattern', {initcap_sql('pattern_label')}
      FROM g_pat)"""),
    "g_e0": (("g_inc", "g_docs", "g_pl", "kbl", "chl", "att", "img", "kb"), """
  SELECT 'incident:' || incident_id AS s, 'user:' || requester_id AS t, 'OPENED_BY' AS r FROM g_inc
  UNION ALL SELECT 'incident:' || incident_id, 'user:' || assignee_id, 'ASSIGNED_TO_USER' FROM g_inc
  UNION ALL SELECT 'incident:' || incident_id, 'group:' || assignment_group_id, 'ASSIGNED_TO_GROUP' FROM g_inc
  UNION ALL SELECT 'incident:' || incident_id, 'category:' || category_id, 'BELONGS_TO_CATEGORY' FROM g_inc
  UNION ALL SELECT 'incident:' || incident_id, 'service:' || sha256(concat_ws('|', assignment_group_id, category_id)),
                   'IMPACTS_SERVICE' FROM g_inc WHERE assignment_group_id IS NOT NULL AND category_id IS NOT NULL
  UNION ALL SELECT 'incident:' || CAST(incident_id AS VARCHAR), 'kb:' || CAST(kb_article_id AS VARCHAR), 'REFERENCES_KB' FROM kbl
  UNION ALL SELECT 'incident:' || CAST(incident_id AS VARCHAR), 'attachment:' || attachment_id, 'HAS_ATTACHMENT' FROM att
  UNION ALL SELECT 'incident:' || CAST(incident_id AS VARCHAR), 'image:' || image_id, 'HAS_IMAGE' FROM img
  UNION ALL SELECT 'incident:' || incident_id, 'document:' || retrieval_document_id, 'HAS_DOCUMENT' FROM g_docs
    WHERE incident_id IS NOT NULL
  UNION ALL SELECT 'kb:' || kb_article_id, 'document:' || retrieval_document_id, 'BACKED_BY_DOCUMENT' FROM g_docs
    WHERE kb_article_id IS NOT NULL
  UNION ALL SELECT 'incident:' || incident_id, 'pattern:' || sha256(pattern_label), 'RESOLVED_BY_PATTERN' FROM g_pl
    WHERE pattern_label IS NOT NULL
  UNION ALL SELECT 'incident:' || CAST(incident_id AS VARCHAR), 'change:' || CAST(change_request_id AS VARCHAR),
                   'RELATES_TO_CHANGE' FROM chl
  UNION ALL SELECT 'kb:' || CAST(kb_article_id AS VARCHAR), 'category:' || category_id, 'KB_APPLIES_TO_CATEGORY'
    FROM kb WHERE category_id IS NOT NULL
  UNION ALL SELECT DISTINCT 'group:' || assignment_group_id,
                   'service:' || sha256(concat_ws('|', assignment_group_id, category_id)), 'GROUP_SUPPORTS_SERVICE'
    FROM g_inc WHERE assignment_group_id IS NOT NULL AND category_id IS NOT NULL"""),
    "g_edges": (("g_e0",), """
  SELECT DISTINCT sha256(concat_ws('|', r, s, t)) AS edge_id, s AS source_node_id, t AS target_node_id,
         r AS relationship_type
  FROM g_e0 WHERE s IS NOT NULL AND t IS NOT NULL"""),
})
