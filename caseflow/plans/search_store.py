"""Search indexes as written tables, built once for a session and shared by its queries.

An index is the search documents (J1-J3), their postings (J6) and, where asked
for, their vectors (J5) and the vector index (J9), each a table in a folder
below the shared checkpoint folder.  The folder's name is made of the
application and of the source files' paths, sizes and times, so another
session or changed sources build anew; a mark written last says it is whole.
"""

from __future__ import annotations

import hashlib
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.operators import retrieve as R
from caseflow.operators import searchdocs as SD
from caseflow.operators import vector_index as VI
from caseflow.session import ensure_checkpoint_dir, freed
from caseflow.sources.domain import TicketModel, narrowed
from caseflow.sources.tables import DRIVER_TABLES, table_path

#: Fields of each index's postings and the weights of its fields.
FIELDS = {
    "documents": {"content": "text"},
    "kb": {"title": "title", "content": "content"},
    "incident": {f: f for f in ("incident_summary", "description", "work_notes", "resolution_notes")},
    "attachment": {"file_name": "file_name", "description": "description"},
}
WEIGHTS = {"kb": R.KB_FIELD_WEIGHTS, "incident": R.INCIDENT_FIELD_WEIGHTS}
#: Kinds of content: J19's names of them, and the bit by which searches filter them.
KINDS = {"kb_article": 1, "cleaned_html": 2, "work_note": 4, "resolution_note": 8}
_KIND_OF = {"description": "cleaned_html", "work_notes": "work_note", "resolution_notes": "resolution_note"}


def incident_docs(tm: TicketModel) -> DataFrame:
    tm = narrowed(tm, "documents", "conversations")  # other incidents have no text
    return SD.incident_search_docs(tm.incidents(), tm.incident_texts(), tm.work_notes(), tm.resolution_notes(),
                                   tm.reopen_counts())


def asset_docs(tm: TicketModel) -> DataFrame:
    a = tm.attachments().select(F.col("attachment_id").alias("asset_id"), "incident_id", "file_name",
                                "description", "file_size_kb", "mock_url")
    i = tm.images().select(F.col("image_id").alias("asset_id"), "incident_id", "file_name", "description",
                           F.lit(None).cast("int").alias("file_size_kb"), "mock_url")
    return SD.attachment_search_docs(a.unionByName(i))


def _documents(tm: TicketModel, name: str) -> DataFrame:
    if name == "documents":
        return tm.raw("documents").select("doc_id", "text")
    if name == "kb":
        docs = SD.kb_search_docs(tm.kb_articles()).withColumn("kind", F.lit(KINDS["kb_article"]).cast("long"))
    elif name == "incident":
        docs = incident_docs(tm)
        kind = F.create_map(*[F.lit(x) for k, v in _KIND_OF.items() for x in (k, KINDS[v])])
        docs = docs.withColumn("kind", F.try_element_at(kind, F.col("content_type")).cast("long"))
    else:
        docs = asset_docs(tm)
    return docs.withColumnRenamed("id", "doc_id")


class SearchIndex:
    """The tables of one index; each is written when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str):
        self.spark, self.name, self.tm = spark, name, TicketModel(spark, sf_dir)
        self.folder = f"{_root(spark, sf_dir)}/{name}"
        self.weights = WEIGHTS.get(name)

    def table(self, part: str, build: Callable[[str], None]) -> str:
        folder = f"{self.folder}/{part}"
        if not _exists(self.spark, f"{folder}/whole/_SUCCESS"):
            _remove(self.spark, folder)
            with freed(self.spark):
                build(folder)
            self.spark.range(1).write.parquet(f"{folder}/whole")
        return folder

    @property
    def docs(self) -> DataFrame:
        """The search documents, with doc_id."""
        folder = self.table("docs", lambda to: _documents(self.tm, self.name).write.parquet(f"{to}/table"))
        return self.spark.read.parquet(f"{folder}/table")

    def terms(self) -> R.TermIndex:
        """The postings of all documents; those of the driver's table are read where they are, not copied."""
        def build(to: str) -> None:
            docs = _documents(self.tm, self.name) if self.name == "documents" else self.docs
            R.build_index(docs, "doc_id", FIELDS[self.name], to)

        folder = self.table("terms", build)
        return R.open_index(self.spark, folder)

    def store(self) -> SD.VectorStore:
        """The vectors of texts that this index or its queries had embedded."""
        return SD.VectorStore(self.spark, f"{self.folder}-embedded")

    def texts(self) -> DataFrame:
        """(doc_id, text): what is embedded of each document."""
        return self.docs.select("doc_id", SD.embed_text(self.name, self.docs).alias("text"))

    def vectors(self) -> VI.VectorIndex:
        """The vector index, split by kind of content and by whether the ticket is resolved."""
        def build(to: str) -> None:
            self.store().vectors(self.texts(), "doc_id", "text").write.parquet(f"{to}/vectors")
            VI.build_vector_index(rows(to), to, ["part"])

        def rows(to: str) -> DataFrame:
            return self.spark.read.parquet(f"{to}/vectors").join(self.docs.select("doc_id", self.part()), "doc_id") \
                .select("doc_id", F.col("vector").alias("dvec"), "part")

        folder = self.table("vector-index", build)
        return VI.open_vector_index(rows(folder), folder, ["part"])

    def part(self) -> Column:
        """The part of the vector index that a document lies in."""
        state = F.lower("incident_state").isin("resolved", "closed") if self.name == "incident" else F.lit(False)
        return F.concat_ws(":", F.col("kind").cast("string"), state.cast("string")).alias("part")


def _root(spark: SparkSession, sf_dir: str) -> str:
    seen = [spark.sparkContext.applicationId]
    for name in DRIVER_TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            seen += sorted(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in fs.listStatus(path))
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/indexes-{hashlib.md5(' '.join(seen).encode()).hexdigest()[:16]}"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    """Delete what a build that didn't end left behind."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def parts_of(name: str, resolved: bool | None = None) -> list[str]:
    """The parts of an index: kinds of content, and whether the ticket is resolved."""
    if name != "incident":
        return [f"{KINDS['kb_article']}:false"]
    states = ("true", "false") if resolved is None else ("true",) if resolved else ("false",)
    return [f"{KINDS[k]}:{s}" for k in _KIND_OF.values() for s in states]


def hybrid_search(index: SearchIndex, queries: DataFrame, k: int, resolved: bool | None = None) -> DataFrame:
    """(query_id, doc_id, bm25_norm, cosine, score, rank): J10 on one index, 2k candidates from either side.

    ``queries``: (query_id, text) and optionally ticket, whose own documents
    aren't searched (B12), and kinds, the bits of the kinds of content wanted
    (B14; all by default).  ``resolved`` asks for documents of resolved tickets
    alone (B13).  Filters hold before ranking, the index's statistics are those
    of all its documents.
    """
    ticket = F.col("ticket") if "ticket" in queries.columns else F.lit(None)
    kinds = F.col("kinds") if "kinds" in queries.columns else F.lit(-1)
    q = queries.select("query_id", "text", kinds.cast("long").alias("kinds"), ticket.cast("string").alias("ticket"))
    own = F.col("incident_id") if index.name == "incident" else F.lit("")
    kind = F.col("kind") if resolved is None else F.when(F.col("part").endswith(str(resolved).lower()),
                                                         F.col("kind")).otherwise(0)
    profile = index.docs.withColumn("part", index.part()).select("doc_id", own.alias("owner"), kind.alias("kind"))
    keyword = R.bm25_topk(index.terms(), q, 2 * k, index.weights, profile)

    parts = parts_of(index.name, resolved)
    asked = index.store().vectors(q, "query_id", "text").withColumnRenamed("vector", "qvec") \
        .join(q.select("query_id", "kinds"), "query_id") \
        .withColumn("part", F.explode(F.array(*[F.lit(p) for p in parts]))) \
        .where(F.col("kinds").bitwiseAND(F.split("part", ":")[0].cast("long")) != 0)
    # a ticket has one document in a part at most: so many more hits than wanted make up for its own
    hits = index.vectors().search(asked, 2 * k + len(parts))
    kept = hits.join(q.select("query_id", "ticket"), "query_id").join(profile.select("doc_id", "owner"), "doc_id") \
        .where(F.col("ticket").isNull() | (F.col("owner") != F.col("ticket")))
    vector = R.rank_top(kept.select("query_id", "doc_id", "cosine", "score"), 2 * k)
    return R.fuse_linear(keyword, vector, k)
