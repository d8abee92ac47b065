"""Search documents (J1-J5): curated rows -> index document shapes, texts to embed, vectors.

The three index shapes are built with ``select`` / ``stack`` over DataFrames
(never collected to the driver); vectors come from a pluggable embedder run
by ``mapInPandas`` in Arrow batches.
"""

from __future__ import annotations

from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions.columns import asset_type_from_name, file_extension
from caseflow.operators.retrieve import TOKEN_PATTERN, tokens
from caseflow.session import freed
from caseflow.sources.domain import INCIDENT_URL_PREFIX, KB_URL_PREFIX

# Embedding batch size (the hosted model takes batches of 100 texts).
EMBED_BATCH = 100
# Input limit of the hosted model, applied only when a caller asks for it.
EMBED_MAX_CHARS = 8000


def kb_search_docs(kb: DataFrame) -> DataFrame:
    """Article -> KB index document."""
    return kb.select(
        F.concat(F.lit("kb_"), F.col("kb_article_id").cast("string")).alias("id"),
        F.col("kb_article_id").cast("string").alias("article_id"), "title",
        F.col("content_text").alias("content"), F.col("category_name").alias("category"),
        F.col("category_subcategory").alias("subcategory"), "view_count", "useful_count",
        F.concat(F.lit(KB_URL_PREFIX), F.col("kb_article_id").cast("string")).alias("source_url"))


def _joined_notes(notes: DataFrame, key: str, sep: str = "\n") -> DataFrame:
    """Per incident: non-blank note texts in (created_at, note id) order, joined by ``sep``.

    The collected list is one incident's own notes (bounded by that ticket).
    """
    n = notes.where(F.trim(F.col("note_text")) != "")
    return n.groupBy("incident_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("created_at", key, "note_text"))),
                                 lambda s: s["note_text"]), sep).alias("joined"))


def incident_search_docs(incidents: DataFrame, texts: DataFrame, work_notes: DataFrame,
                         resolution_notes: DataFrame, reopen: DataFrame | None = None) -> DataFrame:
    """Up to three documents per incident (description, work notes, resolution notes);
    blank ones are skipped and every document carries all three texts."""
    wn = _joined_notes(work_notes, "work_note_id").withColumnRenamed("joined", "work_notes")
    rn = _joined_notes(resolution_notes, "resolution_note_id").withColumnRenamed("joined", "resolution_notes")
    d = texts.select("incident_id", F.col("description_text").alias("description")) \
        .where(F.col("description").isNotNull())
    keys = d.select("incident_id").unionByName(wn.select("incident_id")).unionByName(rn.select("incident_id")) \
        .distinct()
    base = keys.join(incidents, "incident_id").join(d, "incident_id", "left") \
        .join(wn, "incident_id", "left").join(rn, "incident_id", "left")
    if reopen is not None:
        base = base.join(reopen, "incident_id", "left")
    else:
        base = base.withColumn("reopen_count", F.lit(None).cast("bigint"))
    stacked = base.select("*", F.expr(
        "stack(3, 'description', description, 'work_notes', work_notes, "
        "'resolution_notes', resolution_notes) AS (content_type, body)"))
    stacked = stacked.where(F.col("body").isNotNull() & (F.trim(F.col("body")) != ""))
    return stacked.select(
        F.concat(F.lit("incident_"), F.col("number"), F.lit("_"), F.col("content_type")).alias("id"),
        F.col("incident_id").cast("string").alias("incident_id"), F.col("state").alias("incident_state"),
        F.col("short_description").alias("incident_summary"), "description", "work_notes", "resolution_notes",
        "content_type", "priority", F.col("category_name").alias("category"),
        F.col("category_subcategory").alias("subcategory"),
        F.col("assignment_group_name").alias("assigned_group"),
        F.col("opened_at").alias("created_date"), F.col("resolved_at").alias("closed_date"),
        F.timestamp_diff("MINUTE", F.col("opened_at"), F.col("resolved_at")).cast("int")
         .alias("resolution_time_minutes"),
        F.col("reopen_count").cast("int").alias("reopen_count"),
        F.concat(F.lit(INCIDENT_URL_PREFIX), F.col("incident_id").cast("string")).alias("incident_url"))


def attachment_search_docs(assets: DataFrame) -> DataFrame:
    """Asset -> attachment index document (type from the extension, size in bytes)."""
    size = F.col("file_size_kb") if "file_size_kb" in assets.columns else F.lit(None).cast("int")
    return assets.select(
        F.concat(F.lit("attachment_"), F.col("asset_id")).alias("id"), F.col("asset_id").alias("attachment_id"),
        "file_name", file_extension(F.col("file_name")).alias("file_type"), "description",
        F.col("incident_id").cast("string").alias("incident_id"),
        asset_type_from_name(F.col("file_name")).alias("attachment_type"),
        (size.cast("bigint") * 1024).alias("size_bytes"), "mock_url",
        F.concat(F.lit(INCIDENT_URL_PREFIX), F.col("incident_id").cast("string")).alias("incident_url"))


def _nonblank(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def embed_text(kind: str, df: DataFrame, max_chars: int | None = None) -> Column:
    """The text to embed per document type (non-empty parts, space-joined).

    ``max_chars`` reproduces the hosted model's input cut (8000) when asked;
    by default the whole text is embedded.
    """
    if kind == "kb":
        t = F.concat_ws(" ", _nonblank(F.col("title")), _nonblank(F.col("content")))
    elif kind == "incident":
        t = F.concat_ws(" ", *[_nonblank(F.col(c)) for c in
                               ("incident_summary", "description", "work_notes", "resolution_notes")])
    elif kind == "attachment":
        t = F.concat_ws(" ", _nonblank(F.col("file_name")), _nonblank(F.col("description")))
    else:
        raise ValueError(kind)
    return F.substring(t, 1, max_chars) if max_chars else t


# ---- J5: embedding in batches --------------------------------------------------------------------------

Embedder = Callable[[list[str]], np.ndarray]
#: Dimensions of the hashed vectors.
HASHED_DIMS = 64


def hashing_embedder(dim: int = HASHED_DIMS) -> Embedder:
    """Deterministic signed feature hashing of word tokens, L2-normalised (ours; a
    stand-in for a hosted embedding model).  ``hashed_vectors`` is the same in column expressions."""
    import hashlib

    import regex

    token_re = regex.compile(TOKEN_PATTERN)

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for i, t in enumerate(texts):
            for tok in token_re.findall((t or "").lower()):
                h = hashlib.md5(tok.encode()).hexdigest()
                out[i, int(h[:8], 16) % dim] += 1.0 if int(h[8], 16) >= 8 else -1.0
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)
    return embed


def hashed_vectors(texts: DataFrame, dim: int = HASHED_DIMS) -> DataFrame:
    """(content, vector) of each row of ``texts`` (content, text): signed token counts by hashed dimension.

    Column expressions only: tokens explode, counts are summed by (content,
    dimension), at most ``dim`` values meet per text.  The counts aren't scaled
    (a cosine doesn't need it), so they are exact; a text without tokens is a
    vector of zeros.
    """
    h = F.md5(F.encode("token", "UTF-8"))
    place = (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % dim).cast("int")
    sign = F.when(F.substring(h, 9, 1) >= "8", 1).otherwise(-1)
    sums = texts.select("content", F.explode(tokens(F.col("text"))).alias("token")) \
        .select("content", place.alias("place"), sign.alias("sign")) \
        .groupBy("content", "place").agg(F.sum("sign").alias("n"))
    found = sums.groupBy("content").agg(
        F.map_from_entries(F.collect_list(F.struct("place", F.col("n").cast("float")))).alias("m"))
    vector = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                         lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0).cast("float")))
    return texts.select("content").join(found, "content", "left") \
        .withColumn("m", F.coalesce("m", F.create_map().cast("map<int,float>"))) \
        .select("content", vector.alias("vector"))


def unit_length(vector: Column) -> Column:
    """The vector divided by its length, in double; zeros stay.

    The length is bound as the one element of an array: named in the inner
    lambda, it would be summed again for each component.
    """
    n = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(F.array(n), lambda m: F.transform(
        vector, lambda x: F.coalesce(F.try_divide(x.cast("double"), m), F.lit(0.0))))[0]


def embed_batches(df: DataFrame, id_col: str, text_col: str, embedder: Embedder | None = None,
                  batch_size: int = EMBED_BATCH) -> DataFrame:
    """(id, vector) for every row; texts go to the embedder in batches of ``batch_size``,
    order preserved within each batch.  Runs in executors via ``mapInPandas``."""
    emb = embedder or hashing_embedder()
    id_type = dict(df.dtypes)[id_col]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for start in range(0, len(pdf), batch_size):
                chunk = pdf.iloc[start:start + batch_size]
                vecs = emb(chunk[text_col].fillna("").tolist())
                yield pd.DataFrame({id_col: chunk[id_col].to_numpy(), "vector": list(vecs)})

    return df.select(id_col, text_col).mapInPandas(run, f"{id_col} {id_type}, vector array<float>")


class VectorStore:
    """J5 as an incremental job: vectors by the hash of their text, below ``folder``.

    The folder belongs to one embedder, a function from (content, text) rows to
    (content, vector) rows.  Each run embeds the texts that the store doesn't
    hold yet, each once however many rows have it, and appends them.  One
    writer at a time; a run that fails leaves no rows, as Spark commits the
    append at its end.
    """

    def __init__(self, spark: SparkSession, folder: str,
                 embedder: Callable[[DataFrame], DataFrame] = hashed_vectors):
        self.spark, self.folder, self.embedder = spark, folder, embedder

    def read(self) -> DataFrame:
        """(content, vector) of all texts embedded so far."""
        try:
            return self.spark.read.schema("content string, vector array<float>").parquet(self.folder)
        except AnalysisException:  # nothing written yet
            return self.spark.createDataFrame([], "content string, vector array<float>")

    def add(self, texts: DataFrame, text_col: str) -> int:
        """Embed the new texts of the column (null as empty); how many they were."""
        text = F.coalesce(F.col(text_col), F.lit(""))
        new = texts.select(F.sha2(text, 256).alias("content"), text.alias("text")) \
            .join(self.read().select("content"), "content", "left_anti") \
            .groupBy("content").agg(F.first("text").alias("text"))
        before = self.read().count()
        with freed(self.spark):
            self.embedder(new).write.mode("append").parquet(self.folder)
        return self.read().count() - before

    def vectors(self, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(id, vector) of each row, embedding what is new first."""
        self.add(rows, text_col)
        keyed = rows.select(id_col, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("content"))
        return keyed.join(self.read(), "content").select(id_col, "vector")
