"""E15 across facts: measures of tickets, SLAs and bridges in one table, with subtotals.

The facts share the ticket's dimensions and nothing else, so their rows must
never be joined with each other (a ticket with 3 SLAs and 4 articles would
count 12 times).  They are stacked instead: every fact is a few additive
numbers per ticket, child rows are summed by ticket, the sums meet the tickets
in a second sum (this brings a child's numbers to its ticket's axes, without a
join), then they are summed by the wanted sets of axes.

Three shuffles, whatever the number of facts: child rows by ticket, behind
partial sums (a ticket that owns a third of all child rows sends a row a
task); at most two rows a ticket; and sums by members of axes.  Child rows are
summed by hash: an axis is a text, and a text in the same sum would have each
task sort all its child rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.operators.measures import AGING_THRESHOLD_DAYS

TICKET = "ticket"


@dataclass(frozen=True)
class Part:
    """An additive number: ``row`` summed over the rows of ``fact``; ``tickets`` counts tickets where that is above 0."""

    fact: str
    row: Callable[[], Column]
    tickets: bool = False


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("bigint")


PARTS: dict[str, Part] = {
    "tickets": Part(TICKET, _one),
    "open": Part(TICKET, lambda: _flag(F.col("is_open"))),
    "resolved": Part(TICKET, lambda: _flag(F.col("is_resolved"))),
    "aging": Part(TICKET, lambda: _flag(F.col("is_open") & (F.col("age_days") > AGING_THRESHOLD_DAYS))),
    "resolution_hours": Part(TICKET, lambda: F.when(F.col("resolved_date_key").isNotNull(), F.col("resolution_hours"))
                             .cast("double")),
    "timed": Part(TICKET, lambda: _flag(F.col("resolved_date_key").isNotNull() & F.col("resolution_hours").isNotNull())),
    "reopened": Part("reopen", lambda: F.col("reopen_count").cast("bigint"), tickets=True),
    "breached_rows": Part("sla", lambda: _flag(F.col("breached"))),
    "breached_tickets": Part("sla", lambda: _flag(F.col("breached")), tickets=True),
    "sla_tickets": Part("sla", _one, tickets=True),
    "articles": Part("article", _one),
    "patterns": Part("pattern", _one),
    "assets": Part("asset", _one),
    "changes": Part("change", _one),
}

#: Measure: its part, or the parts of a ratio.
MEASURES: dict[str, tuple[str, ...]] = {
    "ticket_volume": ("tickets",),
    "open_ticket_count": ("open",),
    "resolved_ticket_count": ("resolved",),
    "aging_open_tickets": ("aging",),
    "avg_resolution_hours": ("resolution_hours", "timed"),
    "reopened_ticket_count": ("reopened",),
    "reopen_rate": ("reopened", "resolved"),
    "sla_breach_rows": ("breached_rows",),
    "sla_breach_tickets": ("breached_tickets",),
    "sla_breach_rate": ("breached_tickets", "sla_tickets"),
    "kb_article_reuse_count": ("articles",),
    "resolution_pattern_frequency": ("patterns",),
    "ticket_asset_count": ("assets",),
    "ticket_change_count": ("changes",),
}


def rollup_sets(axes: list[str]) -> list[tuple[str, ...]]:
    """All axes, then one less from the right at a time, down to the grand total."""
    return [tuple(axes[:n]) for n in range(len(axes), -1, -1)]


def drill_across(tickets: DataFrame, children: dict[str, DataFrame], axes: list[str], measures: list[str],
                 sets: list[tuple[str, ...]] | None = None, key: str = "incident_id") -> DataFrame:
    """Axes x measures of several facts, one row per member of each set of axes.

    ``tickets`` is the ticket fact (E16) with the axes; ``children`` maps a
    fact of PARTS to its rows, which need ``key`` and the columns of their
    measures alone.  ``sets`` are the wanted combinations of axes (all of them
    together by default, ``rollup_sets`` for subtotals).  Returns the axes,
    ``<axis>_is_total`` (true where the row is over all values of that axis,
    so that a blank member can be told from a subtotal) and the measures.

    Counts of 0 and ratios over 0 are blank; rows whose measures are all blank
    go, an empty input gives no rows.  Child rows without a ticket, and those
    with a null key, fall into the blank member of each axis; null keys are
    no ticket where tickets are counted.  Tickets are taken to be unique by
    key (D1): rows of a repeated key add up under the greatest of their axes.
    A measure that adds up over tickets only is all that fits here: distinct
    counts of anything but tickets are refused by having no part.
    """
    unknown = [m for m in measures if m not in MEASURES]
    if unknown or not measures:
        raise ValueError(f"measures must be some of {sorted(MEASURES)}, not {unknown}")
    wanted = list(dict.fromkeys(p for m in measures for p in MEASURES[m]))
    missing = {PARTS[p].fact for p in wanted} - {TICKET} - set(children)
    if missing:
        raise ValueError(f"measures need the facts {sorted(missing)}")
    sets = [tuple(axes)] if sets is None else [tuple(s) for s in sets]

    # The stack has names of its own, so that axes of any name can't clash with parts.
    ax = {a: f"axis_{i}" for i, a in enumerate(axes)}

    def stacked(fact: str, frame: DataFrame) -> DataFrame:
        own = [F.col(a).alias(ax[a]) if fact == TICKET else F.lit(None).cast(tickets.schema[a].dataType).alias(ax[a])
               for a in axes]
        numbers = [(PARTS[p].row() if PARTS[p].fact == fact else F.lit(None).cast(_type(p))).alias(f"part_{p}")
                   for p in wanted]
        return frame.select(F.col(key).alias("ticket_key"), *own, *numbers)

    used = {PARTS[p].fact for p in wanted} - {TICKET}
    ticket_rows = stacked(TICKET, tickets)
    sums = [F.sum(f"part_{p}").alias(f"part_{p}") for p in wanted]
    keyed = ticket_rows.where("ticket_key is not null")
    if used:
        rows = reduce(DataFrame.unionByName, [stacked(f, children[f]) for f in sorted(used)])
        keyed = keyed.unionByName(rows.groupBy("ticket_key").agg(*sums), allowMissingColumns=True)
    by_ticket = keyed.groupBy("ticket_key").agg(*[F.max(c).alias(c) for c in ax.values()], *sums)
    counted = by_ticket.select(*ax.values(), *[
        (_flag(F.col("ticket_key").isNotNull() & (F.col(f"part_{p}") > 0)) if PARTS[p].tickets
         else F.col(f"part_{p}")).alias(f"part_{p}") for p in wanted])
    # Tickets without a key have no children and aren't one ticket: they go past the sum by key.
    loose = ticket_rows.where("ticket_key is null").drop("ticket_key")
    by_axes = counted.unionByName(loose)
    if axes:
        cols = [F.col(c) for c in ax.values()]
        grouped = by_axes.groupingSets([[F.col(ax[a]) for a in s] for s in sets], *cols)
        out = grouped.agg(*[F.grouping(c).alias(f"total_{c}") for c in ax.values()], *sums)
    else:
        out = by_axes.agg(*sums)
    out = out.select(*[F.col(ax[a]).alias(a) for a in axes],
                     *[(F.col(f"total_{ax[a]}") == 1).alias(f"{a}_is_total") for a in axes],
                     *[_value(m).alias(m) for m in measures])
    return out.where(reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in measures]))


def _type(part: str) -> str:
    return "double" if part == "resolution_hours" else "bigint"


def _value(measure: str) -> Column:
    """A blank for a count of 0, and for a ratio of or over one."""
    parts = [F.nullif(F.col(f"part_{p}"), F.lit(0).cast(_type(p))) if _type(p) == "bigint" else F.col(f"part_{p}")
             for p in MEASURES[measure]]
    return parts[0] if len(parts) == 1 else F.try_divide(parts[0].cast("double"), parts[1].cast("double"))
