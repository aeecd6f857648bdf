"""Resources by address: a table of URIs gives the content of each.

Addresses are those of documents (``scheme://name``), of dated notes
(``scheme://notes/kind/date``) and of views of the active build
(``scheme://day/...``, ``chunk/...``, ``coverage/...``).  The addresses are cut
into template and parameter, the wanted ones meet each view in a join, and no
view is made for more than was asked.  An address of an unknown form, or of
something that isn't there, has no content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.operators.retrieval import Store, current, with_tags_and_refs

MARKDOWN, JSON = "text/markdown", "application/json"
#: Views by the first part of their addresses, and what a document or a note may be called.
VIEWS = ("day", "chunk", "coverage")
DATE = r"\d{4}-\d{2}-\d{2}"
#: Chunks that a day shows.
CHUNKS = 24


def parsed(uris: DataFrame, scheme: str) -> DataFrame:
    """uri, template (a view or document) and parameter: the day, the chunk's id, or the document's path; null where the form is unknown."""
    path = F.regexp_extract("uri", f"^{scheme}://(.+)$", 1)
    view = F.regexp_extract(path, f"^({'|'.join(VIEWS)})/([^/]+)$", 1)
    document = path.rlike(r"^[^/]+$") | path.rlike(f"^notes/[^/]+/{DATE}$")
    template = F.when(view != "", view).when(document, "document")
    return uris.select("uri").distinct().select("uri", template.alias("template"), F.when(view != "", F.regexp_extract(path, "/([^/]+)$", 1)).when(document, path).alias("parameter"))


def content(store: Store, documents: DataFrame, uris: DataFrame, user: str, scheme: str = "timeloom") -> DataFrame:
    """uri, mime_type and content, both null where there is none.

    ``documents`` has name (``corrections``, ``notes/corrections/2026-01-02``)
    and text.
    """
    asked = parsed(uris, scheme)
    of = lambda template, name: asked.where(F.col("template") == template).select("uri", F.col("parameter").alias(name))

    written = of("document", "name").join(documents.select("name", "text"), "name").select("uri", F.lit(MARKDOWN).alias("mime_type"), F.col("text").alias("content"))

    wanted = asked.where(F.col("template").isin("day", "coverage")).select(F.col("parameter").alias("day")).distinct()
    summary = current(store, "day_summary", user).join(wanted, "day", "left_semi")
    spans = current(store, "coverage_span", user).join(wanted, "day", "left_semi")
    spans = spans.groupBy("day").agg(F.array_sort(F.collect_list(F.struct("start_at", "end_at", "span_kind", "modality", "completeness", "notes"))).alias("coverage_spans"))
    chunks = current(store, "memory_chunk", user).join(wanted, "day", "left_semi")
    counts = chunks.groupBy("day", "chunk_type").agg(F.count("*").alias("n")).groupBy("day").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("chunk_type", "n")))).alias("chunk_counts"))
    covered = summary.join(spans, "day", "left").withColumn("modality_coverage", F.col("modality_coverage_json"))
    shown = F.to_json(F.struct("chunk_counts", "completeness", "coverage_spans", "day", "day_arc", "modality_coverage", "status"))
    days = of("day", "day").join(covered.join(counts, "day", "left"), "day").select("uri", F.lit(JSON).alias("mime_type"), shown.alias("content"))
    brief = F.to_json(F.struct("completeness", "coverage_spans", "day", "modality_coverage", "status"))
    coverage = of("coverage", "day").join(covered, "day").select("uri", F.lit(JSON).alias("mime_type"), brief.alias("content"))

    mine = store["memory_chunk"].where(F.col("user_id") == user).join(of("chunk", "id").select("id"), "id", "left_semi")
    whole = with_tags_and_refs(mine, store["chunk_tag"], store["chunk_ref"])
    body = F.to_json(F.struct("chunk_type", "completeness", "confidence", "day", "end_at", "id", "metadata_json", "refs", "salience", "start_at", "tags", "text", "title"))
    pieces = of("chunk", "id").join(whole, "id").select("uri", F.lit(JSON).alias("mime_type"), body.alias("content"))

    found = written.unionByName(days).unionByName(coverage).unionByName(pieces)
    return asked.select("uri").join(found, "uri", "left")
