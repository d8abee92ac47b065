"""Map the driver's TPC-H-like tables onto the ticket domain (our mapping).

Every frame is a lazy plan over the parquet scans, so Catalyst prunes columns
and pushes filters into the scans; nothing is materialised here.

Mapping (ours, fixed so that SQL oracles can restate it):

* incident          <- orders; number = 'INC' + key zero-padded to 7 digits
* state             <- F: Resolved (even key) / Closed (odd key); O: In Progress; P: On Hold
* opened_at         <- o_orderdate
* resolved_at       <- F only: opened_at + ((key * 37) % 240 + 1) hours
* updated_at        <- opened_at + (key % 30) days
* follow_up         <- key % 4 in (2, 3)
* requester         <- customer; group <- customer's nation; category <- market segment,
                       subcategory <- customer's region
* assignee          <- supplier of the order's line 1 (left join; may be missing)
* SLA               <- lineitem: id key-line, target 24 h x priority digit, elapsed 3 x quantity
* KB article / link <- part / distinct (order, part) of lineitem
* change / link     <- supplier / distinct (order, supplier) of lineitem
* reopen count      <- returned lines (l_returnflag = 'R') of the order
* attachments       <- documents (incident = doc_id); images <- pages (incident = page_id)
* notes             <- conversations (incident = conv_id): system turns are resolution
                       notes, other turns work notes; created_at = opened_at + turn hours
* document files    <- benchmark (incident = item_id); references <- pages.url (incident = page_id)
* uploaded_at       <- as-of date - (key % 28) days, for assets in nested details
* incident texts    <- description = documents.text, resolution summary = pages.html
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.sources.tables import read_table

# Fixed values of the mapping.
AS_OF = _dt.date(2001, 8, 2)          # day after the latest order date in the test data
OPEN_STATES = ("New", "In Progress", "On Hold")
RESOLVED_STATES = ("Resolved", "Closed")
# Extensions for synthetic asset file names, chosen by id modulo the list length.
ASSET_EXTENSIONS = ("png", "jpg", "jpeg", "gif", "log", "txt", "sql", "ps1", "sh", "py",
                    "pdf", "docx", "xlsx", "zip")
ASSET_URL_PREFIX = "https://assets.example.invalid/"
INCIDENT_URL_PREFIX = "https://tickets.example.invalid/incident/"
KB_URL_PREFIX = "https://tickets.example.invalid/kb/"


def incident_number(key: Column) -> Column:
    return F.format_string("INC%07d", key)


def kb_number(key: Column) -> Column:
    return F.format_string("KB%07d", key)


def change_number(key: Column) -> Column:
    return F.format_string("CHG%07d", key)


def uploaded_at(key: Column) -> Column:
    """When an asset was uploaded: the as-of date less 0 to 27 days."""
    return F.date_sub(F.lit(str(AS_OF)).cast("date"), (key % 28).cast("int"))


def add_hours(ts: Column, hours: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"), F.lit(0), F.lit(0))


def add_days(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), F.lit(0))


def state_of(status: Column, key: Column) -> Column:
    return (F.when(status == "F", F.when(key % 2 == 0, "Resolved").otherwise("Closed"))
             .when(status == "O", "In Progress")
             .when(status == "P", "On Hold")
             .otherwise("New"))


def is_open(state: Column) -> Column:
    return F.lower(state).isin(*[s.lower() for s in OPEN_STATES])


def is_resolved(state: Column) -> Column:
    return F.lower(state).isin(*[s.lower() for s in RESOLVED_STATES])


#: What an incident's columns are made of.
INCIDENT_SOURCE = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_custkey", "o_totalprice"]


def incident_fields(get: Callable[[str], Column]) -> dict[str, Column]:
    """Fields of an incident; ``get`` gives a column of INCIDENT_SOURCE, of a row or of a struct."""
    key, opened, status = get("o_orderkey"), get("o_orderdate"), get("o_orderstatus")
    rank = F.substring(get("o_orderpriority"), 1, 1).cast("int")
    follow_up = (key % 4) >= 2
    return {
        "incident_id": key,
        "number": incident_number(key),
        "state": state_of(status, key),
        "priority": get("o_orderpriority"),
        "priority_rank": rank,
        "opened_at": opened,
        "updated_at": add_days(opened, key % 30),
        "resolved_at": F.when(status == "F", add_hours(opened, (key * 37) % 240 + 1)),
        "follow_up_required": follow_up,
        "requester_id": get("o_custkey"),
        "total_price": get("o_totalprice"),
        "impact": F.when(rank <= 2, "1 - High").when(rank == 3, "2 - Medium").otherwise("3 - Low"),
        "follow_up_reason": F.when(follow_up, F.lit("Awaiting requester confirmation")),
    }


def short_description(category_name: Column, requester_name: Column) -> Column:
    return F.concat_ws(" ", category_name, F.lit("issue reported by"), requester_name)


def email_of(name: Column) -> Column:
    return F.concat(F.lower(F.regexp_replace(name, "[^A-Za-z0-9]+", ".")), F.lit("@example.invalid"))


#: What an article's and a change request's fields are made of.
ARTICLE_SOURCE = ["p_partkey", "p_name", "p_type", "p_brand", "p_size"]
CHANGE_SOURCE = ["s_suppkey", "s_name", "s_acctbal"]


def article_fields(get: Callable[[str], Column]) -> dict[str, Column]:
    """Fields of an article; ``get`` gives a column of ARTICLE_SOURCE, of a row or of a struct."""
    name, kind, brand, size = get("p_name"), get("p_type"), get("p_brand"), get("p_size")
    return {
        "kb_article_id": get("p_partkey"),
        "kb_article_number": kb_number(get("p_partkey")),
        "title": F.initcap(name),
        "audience": F.when(size < 25, "internal").otherwise("public"),
        "content_html": F.concat(F.lit("<p>How to handle a <b>"), name, F.lit("</b> of type "), kind,
                                 F.lit(" &amp; brand "), brand, F.lit(".</p>")),
        "content_text": F.concat_ws(" ", F.lit("How to handle a"), name, F.lit("of type"), kind, F.lit("& brand"), brand),
        "keywords": F.array(F.split(name, " ")[0], F.lower(kind)),
        "category_id": F.lower(kind),
        "category_name": kind,
        "category_subcategory": brand,
        "view_count": (size * 40).cast("int"),
        "useful_count": (size * 3).cast("int"),
    }


def change_fields(get: Callable[[str], Column]) -> dict[str, Column]:
    """Fields of a change request; ``get`` gives a column of CHANGE_SOURCE, of a row or of a struct."""
    return {
        "change_request_id": get("s_suppkey"),
        "number": change_number(get("s_suppkey")),
        "title": F.concat(F.lit("Change by "), get("s_name")),
        "state": F.when(get("s_acctbal") < 0, "Cancelled").otherwise("Implemented"),
        "risk": F.when(get("s_acctbal") < 1000, "High").otherwise("Low"),
    }


#: The incident that a row of a table belongs to.
INCIDENT_OF = {"orders": "o_orderkey", "lineitem": "l_orderkey", "documents": "doc_id", "pages": "page_id",
               "conversations": "conv_id"}


class TicketModel:
    """Lazy domain frames over one directory of driver tables.

    With ``share`` (i, n) they hold the rows of every n-th incident, by hash:
    each incident is in one of the n shares with all that belongs to it, and so
    is each row without an incident.  With ``only`` (incident_id, distinct)
    orders and line items of other incidents are left out as they are read.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, share: tuple[int, int] | None = None,
                 only: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.share = share
        self.only = only

    def raw(self, name: str) -> DataFrame:
        rows = read_table(self.spark, self.sf_dir, name)
        if self.only is not None and name in ("orders", "lineitem"):
            own = self.only.select(F.col("incident_id").alias("_own"))
            rows = rows.join(own, F.col(INCIDENT_OF[name]) == F.col("_own"), "left_semi")
        if self.share is None or name not in INCIDENT_OF:
            return rows
        i, n = self.share
        return rows.where(F.pmod(F.xxhash64(F.col(INCIDENT_OF[name]).cast("long")), F.lit(n)) == i)

    # ---- incidents -------------------------------------------------------
    def incidents_base(self) -> DataFrame:
        """Incident columns computable from orders alone (no join)."""
        return self.raw("orders").select(*[c.alias(n) for n, c in incident_fields(F.col).items()])

    def customer_dims(self) -> DataFrame:
        """customer -> group (nation) and category (segment / region); small dims joined."""
        c = self.raw("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        n = self.raw("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.raw("region").select("r_regionkey", "r_name")
        return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
                 .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
                 .select(
                     F.col("c_custkey").alias("requester_id"),
                     F.col("c_name").alias("requester_name"),
                     F.col("c_nationkey").alias("assignment_group_id"),
                     F.col("n_name").alias("assignment_group_name"),
                     F.concat_ws("/", F.lower("c_mktsegment"), F.lower("r_name")).alias("category_id"),
                     F.col("c_mktsegment").alias("category_name"),
                     F.col("r_name").alias("category_subcategory"),
                 ))

    def incidents(self) -> DataFrame:
        """C9 star join: incidents with group and category (left: unmatched = blank member)."""
        return self.incidents_base().join(self.customer_dims(), "requester_id", "left") \
            .withColumn("short_description", short_description(F.col("category_name"), F.col("requester_name")))

    def assignees(self) -> DataFrame:
        """(incident_id, assignee_id): supplier of line 1 of the order (lowest key if repeated)."""
        li = self.raw("lineitem")
        return li.where(F.col("l_linenumber") == 1).groupBy(F.col("l_orderkey").alias("incident_id")) \
            .agg(F.min("l_suppkey").alias("assignee_id"))

    # ---- users / groups / categories ------------------------------------
    def users(self) -> DataFrame:
        """Requesters (customers, id 'C<key>') and agents (suppliers, id 'S<key>')."""
        c = self.raw("customer").select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("user_id"),
            F.col("c_name").alias("full_name"),
            F.lit("Requester").alias("title"),
            F.col("c_nationkey").alias("nationkey"))
        s = self.raw("supplier").select(
            F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("user_id"),
            F.col("s_name").alias("full_name"),
            F.lit("Agent").alias("title"),
            F.col("s_nationkey").alias("nationkey"))
        return c.unionByName(s).withColumn("email", email_of(F.col("full_name")))

    def assignment_groups(self) -> DataFrame:
        n = self.raw("nation")
        return n.select(F.col("n_nationkey").alias("assignment_group_id"),
                        F.col("n_name").alias("name"),
                        F.concat(F.lit("Support group for "), F.col("n_name")).alias("description"),
                        F.concat(F.lower("n_name"), F.lit("-escalation@example.invalid"))
                         .alias("escalation_email"))

    # ---- SLAs, links, reopen --------------------------------------------
    def slas(self) -> DataFrame:
        li = self.raw("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
        inc = self.incidents_base().select("incident_id", "priority_rank")
        target = F.col("priority_rank").cast("double") * 24.0
        elapsed = F.col("l_quantity") * 3.0
        return li.join(inc, li.l_orderkey == inc.incident_id, "inner").select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"),
                        F.col("l_linenumber").cast("string")).alias("sla_id"),
            "incident_id",
            F.lit("Resolution").alias("name"),
            F.when(elapsed > target, "Breached").otherwise("Within target").alias("stage"),
            target.alias("target_hours"),
            elapsed.alias("elapsed_hours"),
            (elapsed > target).alias("breached"),
        )

    def incident_kb_links(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("incident_id"),
            F.col("l_partkey").alias("kb_article_id")).distinct()

    def incident_changes(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("incident_id"),
            F.col("l_suppkey").alias("change_request_id")).distinct() \
            .withColumn("relationship_type", F.lit("caused_by"))

    def reopen_counts(self) -> DataFrame:
        li = self.raw("lineitem")
        return li.groupBy(F.col("l_orderkey").alias("incident_id")).agg(
            F.count_if(F.col("l_returnflag") == "R").cast("bigint").alias("reopen_count"))

    # ---- KB articles and change requests --------------------------------
    def kb_articles(self) -> DataFrame:
        return self.raw("part").select(*[c.alias(n) for n, c in article_fields(F.col).items()],
                                       F.col("p_retailprice").alias("retail_price"))

    def change_requests(self) -> DataFrame:
        return self.raw("supplier").select(*[c.alias(n) for n, c in change_fields(F.col).items()])

    # ---- assets ---------------------------------------------------------
    def _asset_ext(self, key: Column) -> Column:
        exts = F.array(*[F.lit(e) for e in ASSET_EXTENSIONS])
        return F.element_at(exts, (key % len(ASSET_EXTENSIONS) + 1).cast("int"))

    def attachments(self) -> DataFrame:
        d = self.raw("documents").select("doc_id", "source", "n_chars", "lang")
        ext = self._asset_ext(F.col("doc_id"))
        return d.select(
            F.concat(F.lit("ATT"), F.col("doc_id").cast("string")).alias("attachment_id"),
            F.col("doc_id").alias("incident_id"),
            incident_number(F.col("doc_id")).alias("incident_number"),
            F.concat(F.lit("document_"), F.col("doc_id").cast("string"), F.lit("."), ext)
             .alias("file_name"),
            F.concat(F.lit("application/"), ext).alias("content_type"),
            F.concat(F.lit("Attachment from "), F.col("source"), F.lit(" ("), F.col("lang"),
                     F.lit(")")).alias("description"),
            F.concat(F.lit(ASSET_URL_PREFIX + "attachments/"), F.col("doc_id").cast("string"))
             .alias("mock_url"),
            ((F.col("n_chars") + 1023) / 1024).cast("int").alias("file_size_kb"),
        )

    def images(self) -> DataFrame:
        p = self.raw("pages").select("page_id", "url")
        return p.select(
            F.concat(F.lit("IMG"), F.col("page_id").cast("string")).alias("image_id"),
            F.col("page_id").alias("incident_id"),
            incident_number(F.col("page_id")).alias("incident_number"),
            F.concat(F.lit("screen_"), F.col("page_id").cast("string"), F.lit(".png")).alias("file_name"),
            F.lit("image/png").alias("content_type"),
            F.concat(F.lit("Screenshot of "), F.col("url")).alias("description"),
            F.concat(F.lit(ASSET_URL_PREFIX + "images/"), F.col("page_id").cast("string"))
             .alias("mock_url"),
            (F.col("page_id") % 1000 + 640).cast("int").alias("width_px"),
            (F.col("page_id") % 500 + 480).cast("int").alias("height_px"),
        )

    def document_assets(self) -> DataFrame:
        """Runbooks: the benchmark texts as document files of the ticket with the same number."""
        b = self.raw("benchmark").select("item_id", F.length("text").alias("n"))
        return b.select(
            F.concat(F.lit("DOC"), F.col("item_id").cast("string")).alias("document_id"),
            F.col("item_id").alias("incident_id"),
            F.concat(F.lit("runbook_"), F.col("item_id").cast("string"), F.lit(".pdf")).alias("file_name"),
            F.lit("application/pdf").alias("content_type"),
            F.ceil(F.col("n") / 1024).cast("int").alias("file_size_kb"))

    def external_references(self) -> DataFrame:
        """The page a ticket names, as a reference to another system."""
        p = self.raw("pages").select("page_id", "url")
        return p.select(
            F.concat(F.lit("REF"), F.col("page_id").cast("string")).alias("external_reference_id"),
            F.col("page_id").alias("incident_id"), F.lit("web_page").alias("reference_type"),
            F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("title"), "url",
            F.lit("crawl").alias("source_system"))

    # ---- notes and texts ------------------------------------------------
    def notes(self) -> DataFrame:
        """All conversation turns as notes.

        created_at = opened_at + (turn + 1) hours; the author of a 'user' turn is
        the requester ('C<key>'), of any other turn the assignee ('S<key>').
        """
        c = self.raw("conversations")
        inc = self.incidents_base().select("incident_id", "opened_at", "requester_id")
        j = c.join(inc, c.conv_id == inc.incident_id, "inner").join(self.assignees(), "incident_id", "left")
        return j.select(
            F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
             .alias("note_id"),
            "incident_id",
            F.col("turn"),
            F.col("role"),
            F.when(F.col("role") == "user", F.concat(F.lit("C"), F.col("requester_id").cast("string")))
             .otherwise(F.concat(F.lit("S"), F.col("assignee_id").cast("string"))).alias("author_user_id"),
            add_hours(F.col("opened_at"), F.col("turn") + 1).alias("created_at"),
            F.col("text").alias("note_text"),
            (F.col("role") == "system").alias("is_resolution"),
        )

    def work_notes(self) -> DataFrame:
        return self.notes().where(~F.col("is_resolution")).drop("is_resolution") \
            .withColumnRenamed("note_id", "work_note_id")

    def resolution_notes(self) -> DataFrame:
        return self.notes().where(F.col("is_resolution")).drop("is_resolution") \
            .withColumnRenamed("note_id", "resolution_note_id")

    def incident_texts(self) -> DataFrame:
        """(incident_id, description_text, resolution_summary_html, resolution_summary_text).

        The plain resolution text is the simple tag strip (I6) of the HTML, as
        the source system stores it next to the HTML.
        """
        from caseflow.functions.text import strip_tags_simple
        d = self.raw("documents").select(F.col("doc_id").alias("incident_id"),
                                         F.col("text").alias("description_text"))
        p = self.raw("pages").select(F.col("page_id").alias("incident_id"),
                                     F.col("html").alias("resolution_summary_html"))
        return d.join(p, "incident_id", "full").withColumn(
            "resolution_summary_text", strip_tags_simple(F.col("resolution_summary_html")))


#: Incidents whose ids are broadcast, at most.
BROADCAST_IDS = 2_000_000


def narrowed(tm: TicketModel, *tables: str) -> TicketModel:
    """``tm`` with the incidents alone that rows of ``tables`` belong to; their ids are broadcast where they are few."""
    ids = reduce(DataFrame.unionByName, [tm.raw(t).select(F.col(INCIDENT_OF[t]).cast("long").alias("incident_id"))
                                         for t in tables]).distinct()
    return TicketModel(tm.spark, tm.sf_dir, only=F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids)


def graph_inputs(tm: TicketModel) -> dict[str, DataFrame]:
    """String-keyed frames the graph builder expects, from the driver tables.

    Documents are the text units of the corpus without cleaning: incident
    descriptions (non-blank document text), conversation notes and articles.
    """
    s = lambda c: F.col(c).cast("string")
    inc = tm.incidents().join(tm.assignees(), "incident_id", "left").select(
        s("incident_id").alias("incident_id"), "number", "short_description", "state", "priority", "opened_at",
        "resolved_at", F.concat(F.lit("C"), s("requester_id")).alias("requester_id"),
        F.concat(F.lit("S"), s("assignee_id")).alias("assignee_id"),
        s("assignment_group_id").alias("assignment_group_id"), "category_id")
    kb = tm.kb_articles()
    cats = tm.incidents().select("category_id", F.col("category_name").alias("name"),
                                 F.col("category_subcategory").alias("subcategory")) \
        .where(F.col("category_id").isNotNull()) \
        .unionByName(kb.select("category_id", F.col("category_name").alias("name"),
                               F.lit(None).cast("string").alias("subcategory"))).distinct()
    notes = tm.notes().where(F.trim(F.col("note_text")) != "")
    docs = tm.raw("documents").where(F.trim(F.col("text")) != "").select(
        F.concat(F.lit("incident:"), s("doc_id")).alias("retrieval_document_id"),
        s("doc_id").alias("incident_id"), F.lit(None).cast("string").alias("kb_article_id"),
        incident_number(F.col("doc_id")).alias("title"), F.lit("incident_description").alias("source_type")) \
        .unionByName(notes.select(
            F.concat(F.when(F.col("is_resolution"), "resolution-note:").otherwise("work-note:"),
                     F.col("note_id")).alias("retrieval_document_id"),
            s("incident_id").alias("incident_id"), F.lit(None).cast("string").alias("kb_article_id"),
            F.concat(F.when(F.col("is_resolution"), "Resolution note for ").otherwise("Work note for "),
                     s("incident_id")).alias("title"),
            F.when(F.col("is_resolution"), "resolution_note").otherwise("work_note").alias("source_type"))) \
        .unionByName(kb.select(
            F.concat(F.lit("kb-article:"), s("kb_article_id")).alias("retrieval_document_id"),
            F.lit(None).cast("string").alias("incident_id"), s("kb_article_id").alias("kb_article_id"),
            "title", F.lit("kb_article").alias("source_type")))
    return {
        "incidents": inc,
        "users": tm.users().select("user_id", "full_name", "title"),
        "groups": tm.assignment_groups().select(s("assignment_group_id").alias("assignment_group_id"), "name"),
        "categories": cats,
        "kb": kb.select(s("kb_article_id").alias("kb_article_id"), "title", "category_id"),
        "attachments": tm.attachments().select("attachment_id", s("incident_id").alias("incident_id"),
                                               "file_name", "content_type", "mock_url"),
        "images": tm.images().select("image_id", s("incident_id").alias("incident_id"), "file_name", "content_type",
                                     "mock_url"),
        "documents": docs,
        "changes": tm.change_requests().select(s("change_request_id").alias("change_request_id"),
                                               "number", "title"),
        "incident_kb_links": tm.incident_kb_links().select(s("incident_id").alias("incident_id"),
                                                           s("kb_article_id").alias("kb_article_id")),
        "incident_changes": tm.incident_changes().select(s("incident_id").alias("incident_id"),
                                                         s("change_request_id").alias("change_request_id"),
                                                         "relationship_type"),
        "resolution_notes": tm.resolution_notes().select("resolution_note_id",
                                                         s("incident_id").alias("incident_id"), "note_text"),
    }
