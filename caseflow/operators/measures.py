"""Measures: named aggregates evaluated under a filter context.

Public DAX semantics reproduced here:

* filters on dimensions reach the fact through many-to-one joins (star join,
  unmatched keys fall into a blank member: a null group key);
* a measure's own boolean filter either *intersects* an existing filter on the
  same column (``mode="keep"``, KEEPFILTERS) or *replaces* it (``mode="replace"``);
* a count over no rows is blank (null), averages skip blanks, division by zero
  is blank, and grouped results drop rows in which every measure is blank.

A measure is a function ``as_of -> Column`` (an aggregate expression) over the
prepared fact frame, so any set of measures over any axes is one
``groupBy(axes).agg(...)``: a single shuffle with map-side partial aggregation.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions.columns import asset_type_from_name

from caseflow.sources.domain import AS_OF, is_open, is_resolved

# Age bucket edges in days (ours; the reference names the bucket but not its edges).
AGE_BUCKETS = ((0, 1, "0-1"), (2, 3, "2-3"), (4, 7, "4-7"), (8, 14, "8-14"), (15, 30, "15-30"))
AGE_BUCKET_LAST = "31+"
AGING_THRESHOLD_DAYS = 7


def _as_of_col(as_of: _dt.date | str) -> Column:
    return F.lit(str(as_of)).cast("date")


def date_key(ts: Column) -> Column:
    """yyyyMMdd integer key of a timestamp (null stays null)."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def age_bucket(days: Column) -> Column:
    expr = None
    for lo, hi, label in AGE_BUCKETS:
        cond = (days >= lo) & (days <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.when(days > AGE_BUCKETS[-1][1], AGE_BUCKET_LAST)


def hour_boundaries(start: Column, end: Column) -> Column:
    """DATEDIFF(HOUR) as DAX counts it: hour boundaries crossed, not elapsed hours."""
    return F.timestamp_diff("HOUR", F.date_trunc("HOUR", start), F.date_trunc("HOUR", end))


def fact_tickets(incidents: DataFrame, as_of: _dt.date | str = AS_OF,
                 reopen_counts: DataFrame | None = None) -> DataFrame:
    """The ticket fact with date keys, flags, durations, age and bucket."""
    asof = _as_of_col(as_of)
    opened, resolved = F.col("opened_at"), F.col("resolved_at")
    open_ = is_open(F.col("state"))
    age = F.datediff(asof, opened.cast("date")).cast("bigint")
    # one projection (withColumns) instead of a chain of re-analysed withColumn calls
    f = incidents.withColumns({
        "is_open": open_,
        "is_resolved": is_resolved(F.col("state")),
        "opened_date_key": date_key(opened),
        "resolved_date_key": date_key(resolved),
        "resolution_hours": F.timestamp_diff("SECOND", opened, resolved) / 3600.0,
        "resolution_hour_boundaries": hour_boundaries(opened, resolved),
        "age_days": age,
        "open_age_days": F.when(open_, age),
        "open_age_bucket": F.when(open_, age_bucket(age)),
    })
    if reopen_counts is not None:
        f = f.join(reopen_counts, "incident_id", "left") \
             .withColumn("reopen_count", F.coalesce(F.col("reopen_count"), F.lit(0).cast("bigint")))
    return f


def _blank0(c: Column) -> Column:
    """A count of zero rows is blank."""
    return F.nullif(c.cast("bigint"), F.lit(0).cast("bigint"))


# Each measure: (aggregate builder, column it filters on or None).
MEASURES: dict[str, tuple[Callable[[], Column], str | None]] = {
    # E1
    "ticket_volume": (lambda: _blank0(F.count(F.lit(1))), None),
    # E2 / E3
    "open_ticket_count": (lambda: _blank0(F.count_if(F.col("is_open"))), "state"),
    # E4
    "resolved_ticket_count": (lambda: _blank0(F.count_if(F.col("is_resolved"))), "state"),
    # Hour boundaries, over resolved tickets
    "avg_resolution_time": (lambda: F.avg(F.when(F.col("is_resolved"),
                                                F.col("resolution_hour_boundaries"))), "state"),
    # Exact hours where a resolved key is present
    "avg_resolution_hours": (lambda: F.avg(F.when(F.col("resolved_date_key").isNotNull(),
                                                 F.col("resolution_hours"))), None),
    # E7a
    "aging_open_tickets": (lambda: _blank0(F.count_if(F.col("is_open") &
                                                      (F.col("age_days") > AGING_THRESHOLD_DAYS))),
                           "state"),
    # E8
    "reopened_ticket_count": (lambda: _blank0(F.count_distinct(
        F.when(F.col("reopen_count") > 0, F.col("incident_id")))), None),
    # E10
    "open_ticket_age_days": (lambda: F.avg(F.when(F.col("is_open"), F.col("age_days"))), "state"),
    # follow-up tickets (M4)
    "follow_up_tickets": (lambda: _blank0(F.count_if(F.col("follow_up_required"))), None),
}

# Additive parts of the measures that carry their own state filter: (sum part, count part or None).
# A ticket has exactly one state, so per-state parts add up to the state-free value.
_PARTS: dict[str, tuple[Callable[[], Column], Callable[[], Column] | None]] = {
    "open_ticket_count": (lambda: F.count_if(F.col("is_open")).cast("bigint"), None),
    "resolved_ticket_count": (lambda: F.count_if(F.col("is_resolved")).cast("bigint"), None),
    "aging_open_tickets": (lambda: F.count_if(F.col("is_open") & (F.col("age_days") > AGING_THRESHOLD_DAYS))
                           .cast("bigint"), None),
    "avg_resolution_time": (lambda: F.sum(F.when(F.col("is_resolved"), F.col("resolution_hour_boundaries")))
                            .cast("double"),
                            lambda: F.count(F.when(F.col("is_resolved"), F.col("resolution_hour_boundaries")))),
    "open_ticket_age_days": (lambda: F.sum(F.when(F.col("is_open"), F.col("age_days"))).cast("double"),
                             lambda: F.count(F.when(F.col("is_open"), F.col("age_days")))),
}


def measure(name: str) -> Column:
    builder, _ = MEASURES[name]
    return builder().alias(name)


def reopen_rate() -> Column:
    """Reopened / resolved, blank on zero."""
    return F.try_divide(MEASURES["reopened_ticket_count"][0]().cast("double"),
                        MEASURES["resolved_ticket_count"][0]().cast("double")).alias("reopen_rate")


def _agg_cols(names: list[str]) -> list[Column]:
    return [reopen_rate() if n == "reopen_rate" else measure(n) for n in names]


def summarize(fact: DataFrame, axes: list[str], measures: list[str],
              mode: str = "keep", drop_blank: bool = True) -> DataFrame:
    """Axes x measures in one aggregation; all-blank rows dropped.

    ``mode="replace"``: a measure whose filter column is also an axis ignores
    that axis (DAX CALCULATE with a plain boolean filter).  It is computed
    from additive parts in the same aggregation and summed over the replaced
    axis with a window on the aggregated rows (one row per axis value
    combination), so there is still a single shuffle and no join.
    """
    if mode not in ("keep", "replace"):
        raise ValueError("mode must be 'keep' or 'replace'")
    replaced = [m for m in measures if mode == "replace" and MEASURES.get(m, (None, None))[1] in axes]
    kept = [m for m in measures if m not in replaced]
    if not replaced:
        out = fact.groupBy(*axes).agg(*_agg_cols(kept)) if axes else fact.agg(*_agg_cols(kept))
    else:
        from pyspark.sql import Window
        dropped_axes = {MEASURES[m][1] for m in replaced}
        other_axes = [a for a in axes if a not in dropped_axes]
        parts = []
        for m in replaced:
            s_part, c_part = _PARTS[m]
            parts.append(s_part().alias(f"_s_{m}"))
            if c_part is not None:
                parts.append(c_part().alias(f"_c_{m}"))
        rows = fact.groupBy(*axes).agg(*_agg_cols(kept), *parts)
        w = Window.partitionBy(*other_axes)
        for m in replaced:
            total = F.sum(f"_s_{m}").over(w)
            if _PARTS[m][1] is None:
                val = F.nullif(total.cast("bigint"), F.lit(0).cast("bigint"))
            else:
                val = F.try_divide(total, F.sum(f"_c_{m}").over(w).cast("double"))
            rows = rows.withColumn(m, val)
        out = rows.select(*axes, *measures)
    if drop_blank and measures:
        out = out.where(reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in measures]))
    return out


# ---- SLA fact and measures -------------------------------------------------

def fact_sla(slas: DataFrame, incidents: DataFrame | None = None) -> DataFrame:
    """SLA fact; optionally carries the ticket's dimension keys (many-to-one)."""
    if incidents is None:
        return slas
    return slas.join(incidents, "incident_id", "left")


def sla_breach_rows() -> Column:
    """Breached SLA rows."""
    return _blank0(F.count_if(F.col("breached"))).alias("sla_breach_rows")


def sla_breach_tickets() -> Column:
    """Distinct tickets with a breached SLA."""
    return _blank0(F.count_distinct(F.when(F.col("breached"), F.col("incident_id")))) \
        .alias("sla_breach_tickets")


def sla_breach_rate() -> Column:
    """Breached tickets / tickets with any SLA (denominator ours)."""
    return F.try_divide(
        F.count_distinct(F.when(F.col("breached"), F.col("incident_id"))).cast("double"),
        F.count_distinct(F.col("incident_id")).cast("double")).alias("sla_breach_rate")


# ---- bridges and dimensions ---------------------------------------------------

def bridge_ticket_asset(attachments: DataFrame, images: DataFrame,
                        documents: DataFrame | None = None) -> DataFrame:
    """Ticket x asset bridge over all asset classes (unionByName)."""
    a = attachments.select("incident_id", F.col("attachment_id").alias("asset_id"),
                           F.lit("attachment").alias("asset_class"), "file_name", "content_type")
    i = images.select("incident_id", F.col("image_id").alias("asset_id"),
                      F.lit("image").alias("asset_class"), "file_name", "content_type")
    out = a.unionByName(i)
    if documents is not None:
        d = documents.select("incident_id", F.col("document_id").alias("asset_id"),
                             F.lit("document").alias("asset_class"), "file_name", "content_type")
        out = out.unionByName(d)
    return out


def bridge_ticket_article(links: DataFrame) -> DataFrame:
    """Ticket x article bridge, one row per pair."""
    return links.select("incident_id", "kb_article_id").distinct()


def bridge_ticket_pattern(labelled: DataFrame) -> DataFrame:
    """Ticket x resolution pattern bridge, one row per pair, from labelled notes (K3)."""
    return labelled.select("incident_id", "resolution_pattern_id").distinct()


def dim_asset_type(bridge: DataFrame) -> DataFrame:
    """Asset types of the ticket-asset bridge, with the number of assets of each."""
    return bridge.groupBy(asset_type_from_name(F.col("file_name")).alias("asset_type")) \
        .agg(F.count(F.lit(1)).cast("bigint").alias("asset_count"))


def kb_article_reuse_count(bridge: DataFrame, axes: list[str]) -> DataFrame:
    """Rows of the ticket-article bridge per axes."""
    return bridge.groupBy(*axes).agg(_blank0(F.count(F.lit(1))).alias("kb_article_reuse_count"))


def dim_date(fact: DataFrame, ts_cols: list[str]) -> DataFrame:
    """Calendar covering every date in the given timestamp columns.

    The range is found with one distributed aggregate; the calendar itself is
    small (one row per day) and generated with ``sequence`` + ``explode``.
    """
    bounds = fact.agg(
        F.least(*[F.min(F.col(c).cast("date")) for c in ts_cols]).alias("lo"),
        F.greatest(*[F.max(F.col(c).cast("date")) for c in ts_cols]).alias("hi"))
    d = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    return d.select(
        date_key(F.col("date")).alias("date_key"), "date",
        F.year("date").alias("year"), F.quarter("date").alias("quarter"),
        F.month("date").alias("month_number"), F.date_format("date", "MMMM").alias("month_name"),
        F.weekofyear("date").alias("iso_week"),
        (F.weekday("date") + 1).alias("iso_weekday"),
        F.date_format("date", "EEEE").alias("weekday_name"))


def dim_state(incidents: DataFrame) -> DataFrame:
    """States with open / resolved flags."""
    return incidents.select("state").distinct().select(
        "state", is_open(F.col("state")).alias("is_open"),
        is_resolved(F.col("state")).alias("is_resolved"))


def dim_priority(incidents: DataFrame) -> DataFrame:
    """Priorities ranked by the leading digit of the label."""
    return incidents.select("priority").distinct().select(
        "priority", F.regexp_extract("priority", r"^(\d+)", 1).cast("int").alias("priority_rank"))


def dim_category(incidents: DataFrame) -> DataFrame:
    """Categories with CategoryPath = name / subcategory."""
    return incidents.select("category_id", "category_name", "category_subcategory").distinct() \
        .withColumn("category_path",
                    F.concat_ws(" / ", F.col("category_name"), F.col("category_subcategory")))
