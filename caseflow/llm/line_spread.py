"""Line dedup by distinct-site spread.

Every line that holds a word is hashed (128 bits of the line without outer
blanks).  A HyperLogLog sketch of its sites is kept per line hash, and
sketches merge by aggregation, so that a line that occurs in a third of all
documents costs one sketch per task.  Lines whose estimate is near the
threshold get exact distinct counts.  A line on ``min_sites`` sites or more is
cross-site boilerplate: it goes from every place but its first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import BLANKS, write_once

MIN_SITES = 5
#: Width of the band around the threshold, six standard errors of the sketch.
MARGIN = 0.1
LG_K = 12


def _lines(rows: DataFrame) -> DataFrame:
    """(id, th, site, pos, h1, h2) of each line with a word; id and th name the document."""
    line = F.btrim("line", F.lit(BLANKS))
    return rows.select("id", "th", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line")) \
        .where(line != "") \
        .select("id", "th", "site", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def boilerplate_lines(rows: DataFrame, min_sites: int = MIN_SITES, margin: float = MARGIN,
                      lg_k: int = LG_K) -> DataFrame:
    """(h1, h2, first) of every line that stands on ``min_sites`` or more sites.

    ``rows``: (id, th, text, site).  A null site counts as none.  ``first`` is
    the (id, th, pos) of the first place in that order.
    """
    lines = _lines(rows)
    spread = write_once(lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("est"),
        F.min(F.struct("id", "th", "pos")).alias("first"))
        .where(F.coalesce("est", F.lit(0)) >= min_sites * (1 - margin)), "spread-estimates")
    sure = spread.where(F.col("est") > min_sites * (1 + margin)).select("h1", "h2", "first")
    near = spread.where(F.col("est") <= min_sites * (1 + margin)).select("h1", "h2", "first")
    # only places of near lines reach the exact count; as a written table the near lines have a size that Spark knows
    pairs = lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi") \
        .groupBy("h1", "h2", "site").agg(F.count(F.lit(1)).alias("n"))
    exact = pairs.groupBy("h1", "h2").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites) \
        .join(near, ["h1", "h2"]).select("h1", "h2", "first")
    return sure.unionByName(exact)


def clean_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
                min_sites: int = MIN_SITES, margin: float = MARGIN, lg_k: int = LG_K) -> DataFrame:
    """(row, text, n_lines, n_removed): each row of ``docs`` as one struct beside its cleaned text; see ``drop_spread_lines``."""
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(doc_id).alias("id"),
                        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"), F.col(text).alias("text"),
                        F.col(site).cast("string").alias("site"))
    rows = keyed.select("id", "th", "text", "site")
    # written first, so that the join below shuffles both sides itself and Spark can split a hot line
    bad = write_once(boilerplate_lines(rows, min_sites, margin, lg_k), "spread-lines")
    here = F.struct("id", "th", "pos")
    gone = _lines(rows).join(bad, ["h1", "h2"]).where(~here.eqNullSafe(F.col("first"))) \
        .groupBy("id", "th").agg(F.collect_set("pos").alias("gone")) \
        .select(F.col("id").alias("gone_id"), F.col("th").alias("gone_th"), "gone")
    joined = keyed.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("th") == F.col("gone_th")), "left")
    parts = F.split("text", "\n")
    # the lambda binds the lines once; positions are set-subtracted, so the work grows with the lines
    kept = F.transform(F.array(parts), lambda ls: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("gone")), lambda i: F.get(ls, i)))
    cleaned = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept[0], "\n"))
    n_lines = F.coalesce(F.size(F.filter(parts, lambda x: F.btrim(x, F.lit(BLANKS)) != "")), F.lit(0))
    return joined.select("row", cleaned.alias("text"),
                         F.when(F.col("text").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
                         F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


def drop_spread_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", site: str = "source",
                      min_sites: int = MIN_SITES, margin: float = MARGIN, lg_k: int = LG_K) -> DataFrame:
    """``docs`` with cleaned texts, and ``n_lines`` and ``n_removed`` (long) of each.

    Lines are the parts between ``\\n``; they are compared without outer
    blanks.  Blank lines are never removed.  The first place of a boilerplate
    line (by id, hash of the text, position) keeps it, so no text is lost
    altogether.  A null text stays null, with 0 lines; an empty one stays
    empty.  Rows that repeat an id and a text are one document and are cleaned
    alike; a null id is an id of its own.  Columns called n_lines or n_removed
    are replaced.
    """
    done = clean_lines(docs, doc_id, text, site, min_sites, margin, lg_k)
    return done.select(*[F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns
                         if c not in ("n_lines", "n_removed")], "n_lines", "n_removed")


#: DuckDB's words for ``drop_spread_lines`` over documents, at the default threshold.
ORACLE = f"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM l),
bad AS (SELECT body, min((doc_id, pos)) AS first FROM k WHERE body <> '' GROUP BY body
        HAVING count(DISTINCT source) >= {MIN_SITES}),
m AS (SELECT k.doc_id, k.pos, k.line, k.body <> '' AS has_word,
             bad.body IS NOT NULL AND bad.first <> (k.doc_id, k.pos) AS gone
      FROM k LEFT JOIN bad ON k.body = bad.body),
s AS (SELECT doc_id, count(*) FILTER (WHERE has_word) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
             string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS body
      FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n_lines, 0) AS n_lines, coalesce(s.n_removed, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(s.body, '') END AS text
FROM d LEFT JOIN s USING (doc_id)
"""
