"""Property graph as two tables (K1-K14): ``ontology_nodes`` and ``ontology_edges``.

Nodes and edges are declared as specs and built with ``select`` + ``unionByName``;
hops are equi-joins on the edge columns.  Traversals never enumerate pairs
inside a group: shared-neighbour questions aggregate per shared node, and
bounded reachability iterates join + anti-join with a checkpoint per round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseflow.functions.columns import hash_key, json_struct, label, normalize_pattern
from caseflow.operators.listing import pick_col
from caseflow.sources.landing import work_dir

# Node type names and id prefixes; relationship names.
NODE_PREFIX = {
    "Incident": "incident:", "User": "user:", "AssignmentGroup": "group:", "Category": "category:",
    "BusinessService": "service:", "KnowledgeArticle": "kb:", "Attachment": "attachment:",
    "Image": "image:", "Document": "document:", "ChangeRequest": "change:", "ResolutionPattern": "pattern:",
}
RELATIONSHIPS = (
    "OPENED_BY", "ASSIGNED_TO_USER", "ASSIGNED_TO_GROUP", "BELONGS_TO_CATEGORY", "IMPACTS_SERVICE",
    "REFERENCES_KB", "HAS_ATTACHMENT", "HAS_IMAGE", "HAS_DOCUMENT", "BACKED_BY_DOCUMENT",
    "RESOLVED_BY_PATTERN", "RELATES_TO_CHANGE", "KB_APPLIES_TO_CATEGORY", "GROUP_SUPPORTS_SERVICE",
)
NODE_COLUMNS = ["node_id", "node_type", "name", "properties_json"]
EDGE_COLUMNS = ["edge_id", "source_node_id", "target_node_id", "relationship_type", "properties_json"]


def nid(node_type: str, key: Column) -> Column:
    """Prefixed node id (null when the key is null)."""
    return F.concat(F.lit(NODE_PREFIX[node_type]), key.cast("string"))


def service_key(group_id: Column, category_id: Column) -> Column:
    """Business service = assignment group x category, hashed."""
    return hash_key(group_id.cast("string"), category_id.cast("string"))


def _node(df: DataFrame, node_type: str, key: Column, name: Column, *props: Column) -> DataFrame:
    return df.select(nid(node_type, key).alias("node_id"), F.lit(node_type).alias("node_type"),
                     name.alias("name"),
                     (json_struct(*props) if props else F.lit("{}")).alias("properties_json"))


def _edge(df: DataFrame, rel: str, src: Column, dst: Column, *props: Column) -> DataFrame:
    e = df.select(src.alias("source_node_id"), dst.alias("target_node_id"))
    if props:
        e = df.select(src.alias("source_node_id"), dst.alias("target_node_id"),
                      json_struct(*props).alias("properties_json"))
    else:
        e = e.withColumn("properties_json", F.lit("{}"))
    # Rows with a missing endpoint are dropped here and reported by graph_integrity.
    e = e.where(F.col("source_node_id").isNotNull() & F.col("target_node_id").isNotNull())
    return e.select(hash_key(F.lit(rel), F.col("source_node_id"), F.col("target_node_id")).alias("edge_id"),
                    "source_node_id", "target_node_id", F.lit(rel).alias("relationship_type"),
                    "properties_json")


def resolution_patterns(resolution_notes: DataFrame, strip_prefix: str | None = None) -> DataFrame:
    """K3: pattern label per resolution note (I16), id = SHA-256 of the label,
    with the distinct incident count per pattern (D6)."""
    labelled = resolution_notes.select("incident_id", normalize_pattern(F.col("note_text"), strip_prefix)
                                       .alias("pattern_label")).where(F.col("pattern_label").isNotNull())
    labelled = labelled.withColumn("resolution_pattern_id", F.sha2(F.col("pattern_label"), 256))
    counts = labelled.groupBy("resolution_pattern_id", "pattern_label").agg(
        F.count_distinct("incident_id").cast("bigint").alias("incident_count"))
    return labelled, counts


def service_nodes(g: dict[str, DataFrame]) -> DataFrame:
    """K1: a business service for each pair of group and category that incidents have."""
    services = g["incidents"].select("assignment_group_id", "category_id").distinct() \
        .join(g["groups"].select("assignment_group_id", F.col("name").alias("group_name")),
              "assignment_group_id", "left") \
        .join(g["categories"].select("category_id", F.col("name").alias("category_name")).distinct(),
              "category_id", "left")
    return _node(services, "BusinessService", service_key(F.col("assignment_group_id"), F.col("category_id")),
                 F.concat_ws(" / ", F.col("group_name"), F.col("category_name")),
                 F.lit("assignment group x category").alias("derivation"))


def build_nodes(g: dict[str, DataFrame], strip_prefix: str | None = None) -> DataFrame:
    """K1 + K2 + K4: all node types, one row per node_id."""
    inc = g["incidents"]
    images = g.get("images")
    if images is None:  # K2: fall back to image-typed attachments
        images = g["attachments"].where(F.col("content_type").startswith("image/")) \
            .withColumnRenamed("attachment_id", "image_id")
    _, patterns = resolution_patterns(g["resolution_notes"], strip_prefix)
    users = g["users"].join(
        inc.select(F.col("requester_id").alias("user_id")).unionByName(
            inc.select(F.col("assignee_id").alias("user_id"))).distinct(), "user_id", "left_semi")
    parts = [
        _node(inc, "Incident", F.col("incident_id"), label(F.col("number"), F.col("incident_id")),
              *[F.col(c) for c in ("incident_id", "number")],
              *[pick_col(inc, [c]).alias(c) for c in ("short_description", "state", "priority")],
              *[pick_col(inc, [c], "timestamp_ntz").alias(c) for c in ("opened_at", "resolved_at", "closed_at")]),
        _node(users, "User", F.col("user_id"), F.col("full_name"), F.col("title")),
        _node(g["groups"], "AssignmentGroup", F.col("assignment_group_id"), F.col("name")),
        _node(g["categories"], "Category", F.col("category_id"),
              F.concat_ws(" / ", F.col("name"), F.col("subcategory"))),
        service_nodes(g),
        _node(g["kb"], "KnowledgeArticle", F.col("kb_article_id"), F.col("title"), F.col("category_id")),
        _node(g["attachments"], "Attachment", F.col("attachment_id"), F.col("file_name"), F.col("content_type")),
        _node(images, "Image", F.col("image_id"), F.col("file_name")),
        _node(g["documents"], "Document", F.col("retrieval_document_id"), F.col("title"), F.col("source_type")),
        _node(g["changes"], "ChangeRequest", F.col("change_request_id"), F.col("number"), F.col("title")),
        _node(patterns, "ResolutionPattern", F.col("resolution_pattern_id"), F.initcap("pattern_label"),
              F.col("incident_count")),
    ]
    nodes = reduce(DataFrame.unionByName, parts).where(F.col("node_id").isNotNull())
    return nodes.dropDuplicates(["node_id"])


def build_edges(g: dict[str, DataFrame], strip_prefix: str | None = None, extra: bool = True,
                dedupe: bool = True, only: set[str] | None = None) -> DataFrame:
    """K5 + K6 + K7: edges with hashed ids, one row per edge_id.

    ``only`` names the relationship types wanted; the sources of the others
    aren't read.  ``dedupe=False`` skips the global de-duplication (and, when
    ``edge_id`` is not selected, the hashing) for traversals that only need
    the endpoints.
    """
    inc, docs, i = g["incidents"], g["documents"], F.col("incident_id")

    def images() -> DataFrame:
        if g.get("images") is not None:
            return g["images"]
        return g["attachments"].where(F.col("content_type").startswith("image/")) \
            .withColumnRenamed("attachment_id", "image_id")

    served = inc.where(F.col("assignment_group_id").isNotNull() & F.col("category_id").isNotNull())
    service = nid("BusinessService", service_key(F.col("assignment_group_id"), F.col("category_id")))
    incident, article = nid("Incident", i), nid("KnowledgeArticle", F.col("kb_article_id"))
    document = nid("Document", F.col("retrieval_document_id"))

    def file_of(df: DataFrame) -> list[Column]:
        return [pick_col(df, [c]).alias(c) for c in ("content_type", "mock_url")]

    text = [pick_col(docs, ["source_type"]).alias("source_type"),
            pick_col(docs, ["updated_at"], "timestamp_ntz").alias("updated_at")]
    # relationship -> (source rows, source node, target node, properties)
    sources = {
        "OPENED_BY": lambda: (inc, incident, nid("User", F.col("requester_id"))),
        "ASSIGNED_TO_USER": lambda: (inc, incident, nid("User", F.col("assignee_id"))),
        "ASSIGNED_TO_GROUP": lambda: (inc, incident, nid("AssignmentGroup", F.col("assignment_group_id"))),
        "BELONGS_TO_CATEGORY": lambda: (inc, incident, nid("Category", F.col("category_id"))),
        "IMPACTS_SERVICE": lambda: (served, incident, service,
                                    F.lit("assignment group x category").alias("derivation")),
        "REFERENCES_KB": lambda: (g["incident_kb_links"], incident, article),
        "HAS_ATTACHMENT": lambda: (g["attachments"], incident, nid("Attachment", F.col("attachment_id")),
                                   *file_of(g["attachments"])),
        "HAS_IMAGE": lambda: (images(), incident, nid("Image", F.col("image_id")), *file_of(images())),
        "HAS_DOCUMENT": lambda: (docs.where(i.isNotNull()), incident, document, *text),
        "BACKED_BY_DOCUMENT": lambda: (docs.where(F.col("kb_article_id").isNotNull()), article, document, *text),
        "RESOLVED_BY_PATTERN": lambda: (resolution_patterns(g["resolution_notes"], strip_prefix)[0], incident,
                                        nid("ResolutionPattern", F.col("resolution_pattern_id")),
                                        F.col("pattern_label")),
        "RELATES_TO_CHANGE": lambda: (g["incident_changes"], incident,
                                      nid("ChangeRequest", F.col("change_request_id")), F.col("relationship_type")),
    }
    if extra:
        sources |= {
            "KB_APPLIES_TO_CATEGORY": lambda: (g["kb"].where(F.col("category_id").isNotNull()), article,
                                               nid("Category", F.col("category_id"))),
            "GROUP_SUPPORTS_SERVICE": lambda: (served.select("assignment_group_id", "category_id").distinct(),
                                               nid("AssignmentGroup", F.col("assignment_group_id")), service),
        }
    parts = []
    for name, source in sources.items():
        if only is None or name in only:
            rows, *ends = source()
            parts.append(_edge(rows, name, *ends))
    out = reduce(DataFrame.unionByName, parts)
    return (_one_of_each(out) if dedupe else out).select(*EDGE_COLUMNS)


def _one_of_each(edges: DataFrame) -> DataFrame:
    """One row per edge id, found by what the id is the hash of.

    Type and ends are shuffled, packed in one text with the place of the cut;
    the id, which doesn't compress, is made of them afterwards.
    """
    ends = F.concat_ws("|", "source_node_id", "target_node_id")
    one = edges.groupBy("relationship_type", ends.alias("_ends")).agg(
        F.min(F.length("source_node_id")).alias("_cut"), F.first("properties_json").alias("properties_json"))
    return one.select(hash_key(F.col("relationship_type"), F.col("_ends")).alias("edge_id"),
                      F.substr("_ends", F.lit(1), F.col("_cut")).alias("source_node_id"),
                      F.substr("_ends", F.col("_cut") + 2).alias("target_node_id"), "relationship_type", "properties_json")


# ---- K8 -----------------------------------------------------------------------------------------

def graph_integrity(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """K8 (whole graph): per relationship type, edge count and dangling source / target counts.

    Edges are counted by type and end before they meet the nodes, so no edge
    is shuffled but as a count.
    """
    ids = nodes.select("node_id").distinct().withColumn("_known", F.lit(True))

    def side(end: str) -> DataFrame:
        counts = edges.groupBy("relationship_type", F.col(f"{end}_node_id").alias("node_id")) \
            .agg(F.count(F.lit(1)).alias("_n"))
        return counts.join(ids, "node_id", "left").groupBy("relationship_type").agg(
            F.sum("_n").cast("bigint").alias("edge_count"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).cast("bigint")
             .alias(f"dangling_{end}"))

    return side("source").join(side("target").drop("edge_count"), "relationship_type") \
        .select("relationship_type", "edge_count", "dangling_source", "dangling_target")


def degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """K8: in / out degree per node (nodes without edges have 0)."""
    out_d = edges.groupBy(F.col("source_node_id").alias("node_id")).agg(F.count(F.lit(1)).alias("out_degree"))
    in_d = edges.groupBy(F.col("target_node_id").alias("node_id")).agg(F.count(F.lit(1)).alias("in_degree"))
    return nodes.select("node_id", "node_type").join(out_d, "node_id", "left").join(in_d, "node_id", "left") \
        .fillna(0, ["out_degree", "in_degree"])


# ---- K9-K14 -------------------------------------------------------------------------------------------

def neighbours(seeds: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """K9: every node one hop from a seed node, in both directions.

    ``seeds`` has a ``node_id`` column; two equi-joins (out, in) instead of an OR join.
    """
    s = seeds.select(F.col("node_id").alias("seed_node_id")).distinct()
    out_e = s.join(edges, s.seed_node_id == edges.source_node_id).select(
        "seed_node_id", F.col("target_node_id").alias("neighbour_node_id"), "relationship_type",
        F.lit("out").alias("direction"))
    in_e = s.join(edges, s.seed_node_id == edges.target_node_id).select(
        "seed_node_id", F.col("source_node_id").alias("neighbour_node_id"), "relationship_type",
        F.lit("in").alias("direction"))
    n = nodes.select(F.col("node_id").alias("neighbour_node_id"), F.col("node_type").alias("neighbour_type"),
                     F.col("name").alias("neighbour_name"))
    return out_e.unionByName(in_e).join(n, "neighbour_node_id", "left")


#: Tasks for each shuffle partition in which ends meet by incident: every pair of an incident's ends is a row there.
PAIR_TASKS = 4


def _ends(edges: DataFrame, relationship: str, target: str) -> DataFrame:
    """(incident_node_id, ``target``) of a relationship's edges without repeats, dealt by incident as a join needs them."""
    n = PAIR_TASKS * int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return edges.where(F.col("relationship_type") == relationship).select(
        F.col("source_node_id").alias("incident_node_id"), F.col("target_node_id").alias(target)) \
        .repartition(n, "incident_node_id").distinct()


def shared_neighbour_groups(edges: DataFrame, rel_a: str, rel_b: str, min_size: int = 2) -> DataFrame:
    """Groups of incidents that share a target of ``rel_a`` AND a target of ``rel_b``.

    Aggregates per (target_a, target_b) instead of emitting incident pairs, so a
    hot shared node costs one aggregation row, not a quadratic pair list.
    Repeated edges go first, so incidents are counted without being told apart.
    """
    a, b = _ends(edges, rel_a, "target_a"), _ends(edges, rel_b, "target_b")
    return a.join(b, "incident_node_id").groupBy("target_a", "target_b").agg(
        F.count(F.lit(1)).cast("bigint").alias("incident_count"),
        F.min("incident_node_id").alias("first_incident_node_id")) \
        .where(F.col("incident_count") >= min_size)


def shared_evidence_types(edges: DataFrame, relations: tuple[str, ...] = ("HAS_IMAGE", "HAS_DOCUMENT"),
                          min_size: int = 2) -> DataFrame:
    """Incidents of one category that have evidence of one type, each with the size of its group.

    The type is the content type or source type among the edge's properties;
    an edge without one counts for nothing.  Sizes come from an aggregation
    and are joined back, so a type that most incidents have is neither a pair
    list nor one task's window; repeated edges count once.
    """
    category = edges.where("relationship_type = 'BELONGS_TO_CATEGORY'").select(
        F.col("source_node_id").alias("incident_node_id"), F.col("target_node_id").alias("category_node_id")).distinct()
    kind = F.coalesce(*[F.get_json_object("properties_json", f"$.{k}") for k in ("content_type", "source_type")])
    evidence = edges.where(F.col("relationship_type").isin(*relations)).select(
        F.col("source_node_id").alias("incident_node_id"), "relationship_type", kind.alias("evidence_type")) \
        .where("evidence_type is not null").distinct()
    keys = ["category_node_id", "relationship_type", "evidence_type"]
    rows = category.join(evidence, "incident_node_id")
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("incident_count")) \
        .where(F.col("incident_count") >= min_size)
    return rows.join(sizes, keys).select(*keys, "incident_node_id", "incident_count")


def co_link_counts(edges: DataFrame, incident_filter: DataFrame | None, via: str, target_rel: str) -> DataFrame:
    """For each node reached by ``via`` (e.g. the group), how many incidents also link
    to each ``target_rel`` node (e.g. category or service); optional incident filter.
    Repeated edges go first, so a task holds a number for each pair of nodes, not its incidents."""
    j = _ends(edges, via, "anchor_node_id").join(_ends(edges, target_rel, "linked_node_id"), "incident_node_id")
    if incident_filter is not None:
        j = j.join(incident_filter.select(F.col("node_id").alias("incident_node_id")), "incident_node_id",
                   "left_semi")
    return j.groupBy("anchor_node_id", "linked_node_id").agg(F.count(F.lit(1)).cast("bigint").alias("incident_count"))


#: Edges of a node from which on it is a hub, whose edges are split over ``HUB_SALTS`` tasks.
HUB_DEGREE = 10_000
HUB_SALTS = 64


def write_adjacency(edges: DataFrame, folder: str, directed: bool = False, hub_degree: int = HUB_DEGREE) -> DataFrame:
    """(node_id, next_id, salt) of every edge, both ways unless ``directed``, written below ``folder``.

    salt is 0 but for the edges of hubs, which are dealt over ``HUB_SALTS``
    values, so a join on (node_id, salt) splits them.  Hubs are the nodes with
    more than ``hub_degree`` edges, so there are at most two edges in
    ``hub_degree`` of them.
    """
    spark = edges.sparkSession
    edges.select(F.col("source_node_id").alias("node_id"), F.col("target_node_id").alias("next_id")) \
        .write.option("compression", "zstd").parquet(f"{folder}/ends")
    ends = spark.read.parquet(f"{folder}/ends")
    if not directed:  # written one way, read both ways
        ends = ends.unionByName(ends.select(F.col("next_id").alias("node_id"), F.col("node_id").alias("next_id")))
    hubs = ends.groupBy("node_id").agg(F.count(F.lit(1)).alias("degree")).where(F.col("degree") > hub_degree)
    hubs.select("node_id", F.lit(HUB_SALTS).alias("salts")).write.parquet(f"{folder}/hubs")
    hubs = spark.read.parquet(f"{folder}/hubs")
    return ends.join(hubs, "node_id", "left").select(
        "node_id", "next_id", F.pmod(F.xxhash64("next_id"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))


def reach(spark: SparkSession, seeds: DataFrame, edges: DataFrame, hops: int,
          directed: bool = False, hub_degree: int = HUB_DEGREE) -> DataFrame:
    """Nodes within ``hops`` hops of the seeds, with their hop distance.

    A round joins the frontier with the edge table on (node, salt): a hub's
    edges lie under many salts and only the hubs of the frontier are copied to
    all of them, so no task gets a hub's edges whole.  The edge table, the
    frontier as it meets it and each round's nodes are written to the shared
    folder, so lineage stays one round deep, a lost executor recomputes at most
    one round, and the planner knows a frontier's size: the edges aren't
    shuffled for a small one.
    """
    folder = work_dir(spark, "reach")
    adj = write_adjacency(edges, folder, directed, hub_degree)
    hubs = spark.read.parquet(f"{folder}/hubs")
    seeds.select("node_id").distinct().write.parquet(f"{folder}/hop=0")
    for h in range(1, hops + 1):
        here = spark.read.parquet(f"{folder}/hop={h - 1}")
        before = spark.read.parquet(*[f"{folder}/hop={i}" for i in range(h)])
        here.join(hubs, "node_id", "left").withColumn(
            "salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts") \
            .write.parquet(f"{folder}/frontier={h}")
        spread = spark.read.parquet(f"{folder}/frontier={h}")
        found = spread.join(adj, ["node_id", "salt"]).select(F.col("next_id").alias("node_id")).distinct()
        found.join(before, "node_id", "left_anti").write.parquet(f"{folder}/hop={h}")
    return reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{folder}/hop={h}").withColumn("hops", F.lit(h)) for h in range(hops + 1)])


def top_linked(df: DataFrame, partition: str, score: str, k: int, tiebreak: str) -> DataFrame:
    """Top k rows per partition by score desc, tie-break asc (WindowGroupLimit)."""
    w = Window.partitionBy(partition).orderBy(F.col(score).desc(), F.col(tiebreak).asc())
    return df.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
