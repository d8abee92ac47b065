"""List, filter, lookup, history and paging operators.

All lookups are batched: a DataFrame of keys goes in, never a driver loop.
Predicates that match a key against either of two columns are split into two
equi-joins and unioned, so Spark plans hash / sort-merge joins instead of a
nested-loop join on an OR condition.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Any, Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.sources.domain import OPEN_STATES, RESOLVED_STATES, is_open, is_resolved

PAGE_SIZE_DEFAULT = 10
PAGE_SIZE_MAX = 100
FOLLOW_UP_LIMIT_MAX = 50
K_MIN, K_MAX = 1, 20


def _and(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def _or(preds: Iterable[Column]) -> Column:
    preds = list(preds)
    return reduce(lambda a, b: a | b, preds) if preds else F.lit(False)


def _ieq(col: str, value: str) -> Column:
    return F.lower(F.col(col)) == F.lit(str(value).lower())


# ---- B4 / B5 / B6 ----------------------------------------------------------------

def list_filter(state: str | None = None, priority: str | None = None, category: str | None = None,
                group: str | None = None, requester: str | None = None,
                updated_since: str | _dt.datetime | None = None) -> Column:
    """Conjunction of optional filters over an incident-with-dims frame.

    state / priority: equal ignoring case; category: id, name or subcategory;
    group: id or name; requester: id, name or e-mail; updated_at >= updated_since.
    """
    preds: list[Column] = []
    if state:
        preds.append(_ieq("state", state))
    if priority:
        preds.append(_ieq("priority", priority))
    if category:
        preds.append(_or([_ieq("category_id", category), _ieq("category_name", category),
                          _ieq("category_subcategory", category)]))
    if group:
        preds.append(_or([_ieq("assignment_group_id", group), _ieq("assignment_group_name", group)]))
    if requester:
        preds.append(_or([_ieq("requester_id", requester), _ieq("requester_name", requester),
                          _ieq("requester_email", requester)]))
    if updated_since:
        preds.append(F.col("updated_at") >= F.lit(str(updated_since)).cast("timestamp_ntz"))
    return _and(preds)


def keyword_like(columns: list[str], keyword: str) -> Column:
    """Keyword is a substring of any column, case-insensitive; % and _ act as wildcards."""
    pattern = f"%{keyword}%"
    return _or([F.col(c).ilike(pattern) for c in columns])


def open_follow_up() -> Column:
    """Follow-up flagged and in an open state."""
    return F.col("follow_up_required") & is_open(F.col("state"))


def resolved_only() -> Column:
    """Resolved or Closed (case-insensitive)."""
    return is_resolved(F.col("state"))


def exclude_self(ticket: str, id_col: str = "incident_id", number_col: str = "number") -> Column:
    """Drop the current ticket by id and by number."""
    return (F.col(id_col).cast("string") != F.lit(ticket)) & (F.col(number_col) != F.lit(ticket))


# ---- B7 / B8: batched lookups by id OR number --------------------------------------

def lookup_by_id_or_number(keys: DataFrame, target: DataFrame, row_key: str,
                           key_col: str = "lookup_key", id_col: str = "incident_id",
                           number_col: str = "number") -> DataFrame:
    """Rows of ``target`` whose id or number equals a key; keys without a match vanish.

    Two equi-joins (by id, by number) unioned and de-duplicated per (key, row_key),
    where ``row_key`` identifies a target row.
    """
    k = keys.select(F.col(key_col).alias("_key")).distinct()
    by_id = k.join(target, k["_key"] == target[id_col].cast("string"), "inner")
    by_number = k.join(target, k["_key"] == target[number_col], "inner")
    return by_id.unionByName(by_number).dropDuplicates(["_key", row_key]) \
        .withColumnRenamed("_key", key_col)


# ---- B10 / B11: dictionary filters ----------------------------------------------------

_SUFFIX_OPS = {"_gte": "__ge__", "_lte": "__le__", "_gt": "__gt__", "_lt": "__lt__"}


def filter_from_dict(filters: dict[str, Any] | str | None) -> Column:
    """B10 + B11: field -> value(s) as a Column predicate.

    list = OR of equalities; bool = boolean predicate; other scalars = equality;
    keys ending in _gte/_lte/_gt/_lt are range comparisons; a string argument is
    a Spark SQL predicate passed through unchanged; AND across fields.
    """
    if filters is None:
        return F.lit(True)
    if isinstance(filters, str):
        return F.expr(filters)
    preds = []
    for key, value in filters.items():
        if value is None:
            continue
        op = next((s for s in _SUFFIX_OPS if key.endswith(s)), None)
        if op:
            field = key[: -len(op)]
            preds.append(getattr(F.col(field), _SUFFIX_OPS[op])(F.lit(value)))
        elif isinstance(value, bool):
            preds.append(F.col(key) if value else ~F.col(key))
        elif isinstance(value, (list, tuple, set)):
            preds.append(F.col(key).isin(list(value)))
        else:
            preds.append(F.col(key) == F.lit(value))
    return _and(preds)


CONTENT_TYPES = ("kb_article", "incident", "attachment")


def content_type_filter(types: list[str] | None, col: str = "source_type") -> Column:
    """OR over content types; none / unknown only = no restriction."""
    known = [t for t in types or [] if t in CONTENT_TYPES]
    return F.col(col).isin(known) if known else F.lit(True)


def pick_col(df: DataFrame, candidates: list[str], dtype: str = "string") -> Column:
    """The first existing candidate column, else a typed null."""
    for c in candidates:
        if c in df.columns:
            return F.col(c)
    return F.lit(None).cast(dtype)


def first_present(*cols: str) -> Column:
    """First non-null of the candidates."""
    return F.coalesce(*[F.col(c) for c in cols])


def skip_blank_text(col: str) -> Column:
    """Keep rows whose text is not blank after trim."""
    return F.col(col).isNotNull() & (F.trim(F.col(col)) != "")


# ---- C1 / C2 / C3 / C4 / C5 --------------------------------------------------------------

def incident_with_dims(incidents: DataFrame, users: DataFrame, assignees: DataFrame) -> DataFrame:
    """Inner joins to category, group and requester; left join to the assignee.

    ``incidents`` already carries group and category (star join); requester and
    assignee names come from ``users``.
    """
    req = users.select(F.col("user_id").alias("_rid"), F.col("full_name").alias("requester_name_u"),
                       F.col("email").alias("requester_email"))
    agt = users.select(F.col("user_id").alias("_aid"), F.col("full_name").alias("assignee_name"))
    inc = incidents.where(F.col("category_id").isNotNull() & F.col("assignment_group_id").isNotNull())
    inc = inc.withColumn("_rid", F.concat(F.lit("C"), F.col("requester_id").cast("string")))
    out = inc.join(req, "_rid", "inner").join(assignees, "incident_id", "left") \
        .withColumn("_aid", F.concat(F.lit("S"), F.col("assignee_id").cast("string"))) \
        .join(agt, "_aid", "left")
    return out.drop("_rid", "_aid", "requester_name_u")


def notes_with_author(notes: DataFrame, users: DataFrame, note_id_col: str = "note_id") -> DataFrame:
    """Note inner join its author."""
    u = users.select(F.col("user_id").alias("author_user_id"), F.col("full_name").alias("author_name"))
    return notes.join(u, "author_user_id", "inner")


def links_with_kb(links: DataFrame, kb: DataFrame) -> DataFrame:
    """Incident-article link -> article (with its category)."""
    return links.join(kb, "kb_article_id", "inner")


def links_with_change(links: DataFrame, changes: DataFrame) -> DataFrame:
    """C4: incident-change link -> change request."""
    return links.join(changes, "change_request_id", "inner")


def assets_with_incident(assets: DataFrame, incidents: DataFrame) -> DataFrame:
    """Asset -> incident (for the incident number)."""
    inc = incidents.select("incident_id", F.col("number").alias("incident_number_resolved"))
    return assets.join(inc, "incident_id", "inner")


# ---- C6 history search -------------------------------------------------------------------

def history_search(incidents: DataFrame, texts: DataFrame, work_notes: DataFrame,
                   resolution_notes: DataFrame, keyword: str, category: str | None = None) -> DataFrame:
    """resolved/closed incidents whose title, description or resolution summary
    contains the keyword, OR for which a matching work note / resolution note EXISTS.

    EXISTS under OR is not a semi join: the matching note keys are de-duplicated
    (one row per incident) and left-joined as a flag.
    """
    hit_notes = work_notes.where(keyword_like(["note_text"], keyword)).select("incident_id") \
        .unionByName(resolution_notes.where(keyword_like(["note_text"], keyword)).select("incident_id")) \
        .distinct().withColumn("_note_hit", F.lit(True))
    base = incidents.where(resolved_only())
    if category:
        base = base.where(list_filter(category=category))
    base = base.join(texts, "incident_id", "left").join(hit_notes, "incident_id", "left")
    pred = keyword_like(["short_description", "description_text", "resolution_summary_text"], keyword) \
        | F.coalesce(F.col("_note_hit"), F.lit(False))
    return base.where(pred).drop("_note_hit")


# ---- C7 nested detail -----------------------------------------------------------------------

def nest_children(parent: DataFrame, key: str, children: dict[str, tuple]) -> DataFrame:
    """Rebuild a nested document: each child frame becomes an ordered array column.

    ``children`` maps an output column to (child frame with ``key``, sort column),
    and optionally a function from an item, a struct of the child's columns, to
    the fields that the nested item has, by name: items are then shuffled,
    sorted and joined as the child has them and take their fields, and their
    order by them, afterwards.
    One grouped aggregation per child (bounded by that parent's own children),
    then left joins back to the parent, all keyed on ``key`` so the joins reuse
    one hash partitioning.
    """
    out, nested = parent, {}
    for name, (child, sort_col, *shape) in children.items():
        fields = [c for c in child.columns if c != key]
        ordered = [sort_col] + [c for c in fields if c != sort_col] if not shape else fields
        items = F.collect_list(F.struct(*[F.col(c) for c in ordered]))
        agg = child.groupBy(key).agg((items if shape else F.sort_array(items)).alias(name))
        out = out.join(agg, key, "left")
        rows = F.coalesce(F.col(name), F.array().cast(agg.schema[name].dataType))
        nested[name] = F.sort_array(F.transform(rows, _shaped_by(shape[0], sort_col))) if shape else rows
    return out.withColumns(nested)


def _shaped_by(shape: Callable[[Column], dict[str, Column]], sort_col: str) -> Callable[[Column], Column]:
    def shaped(item: Column) -> Column:
        fields = shape(item)
        return F.struct(*[fields[c].alias(c) for c in [sort_col] + [c for c in fields if c != sort_col]])
    return shaped


def detail_summary(detail: DataFrame, scalar_cols: list[str], array_cols: list[str]) -> DataFrame:
    """Scalar fields plus the size of each nested array."""
    return detail.select(*scalar_cols, *[F.size(F.col(c)).cast("bigint").alias(f"{c}_count")
                                         for c in array_cols])


# ---- C8 / C10 ------------------------------------------------------------------------------------

def business_services(incidents: DataFrame) -> DataFrame:
    """Distinct (group, category) pairs of incidents as services with a hashed id."""
    from caseflow.functions.columns import hash_key
    s = incidents.select("assignment_group_id", "assignment_group_name", "category_id",
                         "category_name").distinct()
    return s.withColumn("service_id", hash_key(F.col("assignment_group_id").cast("string"),
                                               F.col("category_id"))) \
        .withColumn("service_name", F.concat_ws(" - ", F.col("assignment_group_name"), F.col("category_name")))


def orphan_check(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose foreign key has no parent (left anti join)."""
    p = parent.select(F.col(pk).alias(fk)).distinct()
    return child.where(F.col(fk).isNotNull()).join(p, fk, "left_anti")


# ---- G: paging, ordering, top-k -------------------------------------------------------------------

def incident_order() -> list[Column]:
    """updated_at DESC, number ASC."""
    return [F.col("updated_at").desc(), F.col("number").asc()]


def follow_up_order() -> list[Column]:
    """updated_at ASC, number ASC."""
    return [F.col("updated_at").asc(), F.col("number").asc()]


def clamp_page(page: int, size: int) -> tuple[int, int]:
    """G1 arguments: page >= 1, 1 <= size <= 100."""
    return max(1, int(page)), min(PAGE_SIZE_MAX, max(1, int(size)))


def clamp_k(k: int) -> int:
    """1 <= k <= 20."""
    return min(K_MAX, max(K_MIN, int(k)))


def page(df: DataFrame, order: list[Column], page_no: int = 1,
         size: int = PAGE_SIZE_DEFAULT) -> DataFrame:
    """G1: order, then LIMIT size OFFSET (page-1)*size (Spark plans a top-k sort)."""
    page_no, size = clamp_page(page_no, size)
    return df.orderBy(*order).offset((page_no - 1) * size).limit(size)


def page_totals(df: DataFrame, size: int = PAGE_SIZE_DEFAULT) -> DataFrame:
    """D4 + G1: total items and total pages = max(1, ceil(n/size)), or 0 when empty."""
    _, size = clamp_page(1, size)
    n = F.count(F.lit(1)).cast("bigint")
    return df.agg(n.alias("total_items")).withColumn(
        "total_pages", F.when(F.col("total_items") == 0, F.lit(0).cast("bigint"))
        .otherwise(F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("total_items") / size).cast("bigint"))))


def follow_up_queue(incidents: DataFrame, limit: int = 10) -> DataFrame:
    """B6 + G3: open follow-up tickets, oldest update first, limit 1..50."""
    limit = min(FOLLOW_UP_LIMIT_MAX, max(1, int(limit)))
    return incidents.where(open_follow_up()).orderBy(*follow_up_order()).limit(limit)


def top_by_score(df: DataFrame, k: int, partition: list[str], score: str = "score",
                 tiebreak: list[str] | None = None) -> DataFrame:
    """Per partition, sort by score desc (then tie-break asc) and keep k rows.

    ``row_number() <= k`` over a window lets Spark insert a WindowGroupLimit
    below the shuffle, so only k rows per group and partition travel.
    """
    order = [F.col(score).desc()] + [F.col(c).asc() for c in (tiebreak or [])]
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


__all__ = [n for n in dir() if not n.startswith("_")] + ["OPEN_STATES", "RESOLVED_STATES"]
