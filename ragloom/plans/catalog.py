"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame`` over the given tables.

Every query reads whole tables (no id subsets, no row caps); a ``limit`` appears only
where it is the feature (top-k).
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ragloom.functions.metadata import (
    base_metadata,
    build_document,
    file_metadata,
    hit_id_fallback,
    meta_long,
    meta_string,
    metadata_from_json,
    metadata_to_json,
    overlay_columns,
)
from ragloom.functions.text import WS_CLASS, byte_length, file_ext_lower, normalize_ws
from ragloom.functions.vectors import vector_widen
from ragloom.operators.blockjoin import block_join
from ragloom.operators.cells import create_cells, insert_vectors, read_cells
from ragloom.operators.chunking import (
    chunk_fixed,
    chunk_markdown,
    chunk_recursive,
    chunk_routed,
    count_chunks,
    is_markdown_source,
    is_markdown_type,
)
from ragloom.operators.context import dedup_by_chunk, dedup_by_content, pack_flags, rank_hits, score_threshold, skip_bad_hits
from ragloom.operators.embedding import embed_distinct, embed_missing, hash_terms
from ragloom.operators.hybrid import FUSE_DEPTH, bm25_search, history_queries, rrf_fuse
from ragloom.operators.ivf import centroids, ivf_assign, ivf_fit, ivf_join, ivf_search
from ragloom.operators.markdown import derived_markdown, fenced_markdown
from ragloom.operators.messages import (
    build_history,
    history_after_template,
    merge_fragments,
    prompted_history,
    render_template,
    run_tool_calls,
    search_report,
    tool_messages,
)
from ragloom.operators.postings import index_chunks, search_postings, write_postings
from ragloom.operators.recursive import chunk_recursive_array
from ragloom.operators.table_splitter import register_splitter, windows_of
from ragloom.operators.search import search, search_batch, split_by_dimension
from ragloom.params import CONFIGURED_PACK, GRAPH_PACK, ChunkParams, SearchParams
from ragloom.plans.ingest import ingest
from ragloom.plans.rag import rag_contexts, retrieve
from ragloom.plans.tables import table
from ragloom.session import checkpoint_dir, ship_package, write_once
from ragloom.sources.chunk_table import to_rows
from ragloom.sources.files import documents_from_table
from ragloom.sources.reports import field_limit_violations, import_report, import_totals

CHUNKS = ChunkParams()  # 500 / 50 / 10
SEARCH = SearchParams()  # k=5, threshold 0.5, 256 hashed buckets


def documents(spark: SparkSession, sf_dir: str, cols: list[str] | None = None) -> DataFrame:
    """The documents table, projected first. ``ragloom.scan.partitions`` (unset by default) deals it out
    anew: for a file that is one row group, which no scan split size can cut."""
    d = table(spark, sf_dir, "documents")
    d = d.select(*cols) if cols else d
    n = spark.conf.get("ragloom.scan.partitions", None)
    return d.repartition(int(n)) if n else d


def doc_chunks(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """T1 chunks (500/50/10) of every document: ``chunk_id, doc_id, chunk_index, content, *keep``."""
    return chunk_fixed(documents(spark, sf_dir, ["doc_id", "text", *(k for k in (keep or []) if k != "text")]), CHUNKS, keep=keep)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items as the question table ``(query_id, question)``."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


def q_rag_contexts(spark, sf_dir):
    """M9 flagship: benchmark questions against fixed-window chunks of documents."""
    return rag_contexts(questions(spark, sf_dir), doc_chunks(spark, sf_dir), SEARCH, CONFIGURED_PACK)


def q_rag_contexts_graph(spark, sf_dir):
    """M9 with the second parameter set (graph constants): 4000 bytes, 10 chunks, no guard."""
    return rag_contexts(questions(spark, sf_dir), doc_chunks(spark, sf_dir), SEARCH, GRAPH_PACK, guard=False)


def q_chunk_fixed(spark, sf_dir):
    """T1 + T7: every chunk of every document."""
    return doc_chunks(spark, sf_dir)


def q_chunk_table_function(spark, sf_dir):
    """T7 with a splitter of one's own as a table function in SQL: fixed windows as a lateral join on every document."""
    register_splitter(spark, "split_windows", windows_of(CHUNKS))
    documents(spark, sf_dir, ["doc_id", "text"]).createOrReplaceTempView("_documents_to_split")
    return spark.sql("""SELECT c.chunk_id, CAST(d.doc_id AS STRING) AS doc_id, c.chunk_index, c.content
                        FROM _documents_to_split d, LATERAL split_windows(CAST(d.doc_id AS STRING), d.text) c""")


def q_count_chunks(spark, sf_dir):
    """Chunk count of each document (0 for blank text)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_chunks(d, CHUNKS).select(F.col("doc_id").cast("string").alias("doc_id"), "n_chunks")


def q_chunks_per_document(spark, sf_dir):
    """A2: documents with at least one chunk and their chunk counts (groupBy after explode)."""
    return doc_chunks(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"))


def sparse_hits(spark, sf_dir, qs: DataFrame, k: int = SEARCH.k, min_score: float | None = None, keys_only: bool = False) -> DataFrame:
    """Hashed-token cosine top-k of ``qs (query_id, question)`` against T1 chunks."""
    return retrieve(qs, doc_chunks(spark, sf_dir), SearchParams(k=k, min_score=SEARCH.min_score, dim=SEARCH.dim),
                    min_score=min_score, keys_only=keys_only)


HIT_COLUMNS = ["query_id", "chunk_id", "doc_id", "chunk_index", "score", "rank"]


def q_knn_sparse(spark, sf_dir):
    """Top-5 chunks per benchmark question (no threshold)."""
    return sparse_hits(spark, sf_dir, questions(spark, sf_dir)).select(*HIT_COLUMNS)


def q_knn_sparse_index(spark, sf_dir):
    """R8 from a stored inverted index of the hashed-token buckets (postings, no dense matrix)."""
    path = index_chunks(doc_chunks(spark, sf_dir), "buckets", SEARCH.dim)
    return search_postings(spark, path, questions(spark, sf_dir), SEARCH.k).select(*HIT_COLUMNS)


def q_dedup_hits(spark, sf_dir):
    """F3 + A3 + A4: thresholded hits after both dedup levels."""
    hits = sparse_hits(spark, sf_dir, questions(spark, sf_dir), min_score=SEARCH.min_score)
    d = dedup_by_content(dedup_by_chunk(score_threshold(hits, SEARCH.min_score)))
    return d.select("query_id", "chunk_id", "doc_id", "chunk_index", "score")


def q_pack_context(spark, sf_dir):
    """W1 + W2: ranked hits kept by the 2000-byte / 10-chunk budget (stop at the first overflow)."""
    hits = sparse_hits(spark, sf_dir, questions(spark, sf_dir), min_score=SEARCH.min_score)
    ranked = rank_hits(dedup_by_content(dedup_by_chunk(score_threshold(hits, SEARCH.min_score))))
    flagged = pack_flags(ranked, CONFIGURED_PACK)
    return flagged.where("in_pack").select("query_id", "chunk_id", "pos", byte_length("content").cast("long").alias("n_bytes"))


def q_rag_prompt(spark, sf_dir):
    """M1: the rendered prompt of every answerable question."""
    return q_rag_contexts(spark, sf_dir).where("answerable").select("query_id", "prompt")


# ----------------------------------------------------------------------------- metadata


def q_doc_metadata_json(spark, sf_dir):
    """P2 + P4: base metadata of each document as sorted-key JSON text."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("string").alias("doc_id"),
                    metadata_to_json(base_metadata(F.col("doc_id"), F.col("source"), F.col("text"))).alias("metadata_json"))


def q_metadata_roundtrip(spark, sf_dir):
    """P9 -> P5 -> P6/P7 -> P8: chunk metadata written as JSON, read back and overlaid."""
    ch = doc_chunks(spark, sf_dir, keep=["source", "text"])
    meta = F.map_concat(base_metadata(F.col("doc_id"), F.col("source"), F.col("text")),
                        F.create_map(F.lit("chunk_index"), F.col("chunk_index").cast("string")))
    rows = ch.select("chunk_id", "doc_id", "chunk_index", "source", metadata_to_json(meta).alias("metadata_json"))
    parsed = rows.select("chunk_id", "doc_id", "chunk_index", "source", metadata_from_json(F.col("metadata_json")).alias("m"))
    over = parsed.select("chunk_id", overlay_columns(F.col("m"), F.col("doc_id"), F.col("chunk_index"), F.col("source")).alias("m"))
    return over.select(
        "chunk_id",
        meta_string(F.col("m"), "doc_id").alias("doc_id"),
        meta_long(F.col("m"), "chunk_index").alias("chunk_index"),
        meta_string(F.col("m"), "source").alias("source"),
        meta_long(F.col("m"), "original_length").alias("original_length"),
        F.size(F.col("m")).cast("long").alias("n_keys"),
    )


def q_hash_embed(spark, sf_dir):
    """Hashed-token counts (256 buckets) of every document."""
    d = documents(spark, sf_dir, ["doc_id", "text"]).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return hash_terms(d, ["doc_id"], "text", SEARCH.dim)


# ----------------------------------------------------------------------------- dense kNN

DENSE_DIGITS = 9


def embeddings(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")


def q_knn_single(spark, sf_dir):
    """The 10 vectors nearest (cosine) to the mean of all vectors; JVM-only plan."""
    e = embeddings(spark, sf_dir)
    mean = (e.select(F.posexplode("embedding").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("a"))
            .orderBy("i").collect())  # dim values: bounded by the vector width
    top = search(e, [r["a"] for r in mean], k=10, order=["vec_id"])
    top = top.withColumn("score", F.round("score", DENSE_DIGITS))
    w = Window.orderBy(F.col("score").desc(), "vec_id")  # k rows only
    return top.withColumn("rank", F.row_number().over(w)).select("vec_id", "label", "score", "rank")


def _dense_batch(spark, sf_dir, k, min_score=None):
    e = embeddings(spark, sf_dir)
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    return search_batch(e, q, k, vec="embedding", mode="dense", min_score=min_score, order=["vec_id"],
                        round_digits=DENSE_DIGITS).select("query_id", "vec_id", "label", "score", "rank")


def q_knn_batch(spark, sf_dir):
    """R2: every vector's 5 nearest vectors (itself included), exact."""
    return _dense_batch(spark, sf_dir, 5)


def q_knn_batch_blocks(spark, sf_dir):
    """R2 for a query table of any size: the block join (pivot angle bounds, two rounds) over all vectors."""
    e = embeddings(spark, sf_dir)
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    dim = e.select(F.max(F.size("embedding"))).first()[0]
    return block_join(e, q, 5, dim=dim, order=["vec_id"], round_digits=DENSE_DIGITS).select("query_id", "vec_id", "label", "score", "rank")


def q_ivf_grow_labels(spark, sf_dir):
    """R6 over two imports: cells around the label means, made from half of the vectors, take the other half. Every
    vector ends in the cell that one assignment of all gives."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/cells-{uuid.uuid4().hex}"
    e, cents = embeddings(spark, sf_dir), label_centroids(spark, sf_dir)
    first = F.pmod(F.xxhash64("vec_id"), F.lit(2)) == 0
    create_cells(e.where(first), path, cents)
    insert_vectors(e.where(~first), path)
    return read_cells(spark, path).select("vec_id", "label", "cell")


def q_knn_threshold(spark, sf_dir):
    """R2 + F3: up to 10 nearest vectors with cosine >= 0.25."""
    return _dense_batch(spark, sf_dir, 10, 0.25)


IVF_LISTS = 128


def q_ivf_assign(spark, sf_dir):
    """Cosine k-means cell (128 lists) of every vector."""
    e = embeddings(spark, sf_dir)
    model = ivf_fit(e, nlist=IVF_LISTS)
    return ivf_assign(e, model).select("vec_id", "label", "cell")


def q_ivf_search(spark, sf_dir):
    """R7 at nprobe = nlist = 128 (the reference's setting): equals the exact search."""
    e = embeddings(spark, sf_dir)
    model = ivf_fit(e, nlist=IVF_LISTS)
    cells = ivf_assign(e, model)
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    return ivf_search(cells, q, model, k=5, nprobe=IVF_LISTS, order=["vec_id"], round_digits=DENSE_DIGITS).select(
        "query_id", "vec_id", "label", "score", "rank")


def q_ivf_join(spark, sf_dir):
    """R7 as a skew-aware partitioned join on the cell (for query tables too big to
    broadcast), at nprobe = nlist: equals the exact search."""
    e = embeddings(spark, sf_dir)
    model = ivf_fit(e, nlist=IVF_LISTS)
    cells = ivf_assign(e, model)
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    return ivf_join(cells, q, model, k=5, nprobe=IVF_LISTS, order=["vec_id"], round_digits=DENSE_DIGITS).select(
        "query_id", "vec_id", "label", "score", "rank")


# ----------------------------------------------------------------------------- templates, messages


def q_render_translate(spark, sf_dir):
    """M2 translate: each benchmark text into English."""
    b = table(spark, sf_dir, "benchmark")
    return render_template(b, "translate", {"text": F.col("text"), "target_lang": "English"}, keep=["item_id"])


def q_render_code(spark, sf_dir):
    """M2 code: each benchmark text as a Python requirement."""
    b = table(spark, sf_dir, "benchmark")
    return render_template(b, "code", {"requirement": F.col("text"), "language": "Python"}, keep=["item_id"])


def q_render_summarize(spark, sf_dir):
    """M2 summarize: each document, in the style named by its language, within 200 characters."""
    d = table(spark, sf_dir, "documents")
    return render_template(d, "summarize", {"content": F.col("text"), "style": F.col("lang"), "max_length": "200"},
                           keep=["doc_id"])


def q_conversation_history(spark, sf_dir):
    """M3: default system message, then every turn in order."""
    return build_history(table(spark, sf_dir, "conversations")).select("conv_id", "seq", "role", "content")


def last_user_questions(conv: DataFrame) -> DataFrame:
    """The latest user turn of each conversation (an aggregate: one row per conversation)."""
    return conv.where(F.col("role") == "user").groupBy("conv_id").agg(
        F.max_by("text", "turn").alias("question")).select(F.col("conv_id").alias("query_id"), "question")


def q_model_input(spark, sf_dir):
    """M4: each conversation's history plus a RAG prompt for its latest user turn
    (only when that question is answerable: otherwise the model is not called)."""
    conv = table(spark, sf_dir, "conversations")
    ctx = rag_contexts(last_user_questions(conv), doc_chunks(spark, sf_dir), SEARCH, CONFIGURED_PACK)
    prompts = ctx.where("answerable").select(F.col("query_id").alias("conv_id"), F.col("prompt").alias("content"))
    return prompted_history(conv, prompts).select("conv_id", "seq", "role", "content")


def tool_calls_from_conversations(conv: DataFrame) -> DataFrame:
    """Derived tool calls: every user turn asks ``search_docs`` for its own text."""
    return conv.where(F.col("role") == "user").select(
        "conv_id",
        F.col("turn").cast("int").alias("call_pos"),
        F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")).alias("call_id"),
        F.lit("search_docs").alias("name"),
        F.to_json(F.struct(F.col("text").alias("query"))).alias("arguments"),
    )


def dispatched_calls(conv: DataFrame) -> DataFrame:
    """Derived calls of every kind, one per user turn: searches, bad JSON, an unknown tool, the calculator, no
    name. All are ``call_0`` at position 0 of their reply, as models name them."""
    kind = (F.col("conv_id") + F.col("turn")) % 5
    return conv.where(F.col("role") == "user").select(
        "conv_id", F.col("turn").alias("reply_seq"), F.lit(0).alias("call_pos"), F.lit("call_0").alias("call_id"),
        F.when(kind <= 1, "search_docs").when(kind == 2, "weather").when(kind == 3, "calculator").otherwise("").alias("name"),
        F.when(kind == 1, F.lit('{"query": 5')).when(kind == 3, F.to_json(F.struct(F.col("turn").cast("string").alias("expression"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("query")))).alias("arguments"))


def q_tool_dispatch(spark, sf_dir):
    """M6, F10 and the failure paths: calls of every kind with one repeated call id."""
    conv = table(spark, sf_dir, "conversations")

    def search_fn(qs, k):
        return sparse_hits(spark, sf_dir, qs, k=k)

    return run_tool_calls(dispatched_calls(conv), search_fn, k=5)


def q_tool_results(spark, sf_dir):
    """M6 + M7: tool messages for search calls derived from the conversations."""
    conv = table(spark, sf_dir, "conversations")

    def search_fn(qs, k):
        return sparse_hits(spark, sf_dir, qs, k=k)

    return run_tool_calls(tool_calls_from_conversations(conv), search_fn, k=5)


def q_search_report(spark, sf_dir):
    """The search tool's report for every benchmark question (top 5, no threshold)."""
    qs = questions(spark, sf_dir)
    rep = search_report(sparse_hits(spark, sf_dir, qs, k=5), ["query_id"])
    return qs.join(rep, "query_id", "left").select("query_id", F.coalesce("report", F.lit("未找到相关文档")).alias("report"))


FRAGMENT_CHARS = 16


def q_merge_fragments(spark, sf_dir):
    """Every message cut into 16-character stream fragments, then merged back by seq."""
    conv = table(spark, sf_dir, "conversations")
    t = F.coalesce(F.col("text"), F.lit(""))
    n = F.greatest(F.lit(1), F.ceil(F.length(t) / F.lit(float(FRAGMENT_CHARS)))).cast("int")
    frags = conv.select("conv_id", "turn", F.posexplode(
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(t, i * FRAGMENT_CHARS + 1, F.lit(FRAGMENT_CHARS)))
    ).alias("seq", "content"))
    return merge_fragments(frags, ["conv_id", "turn"])


def q_tool_history(spark, sf_dir):
    """U1 + M7: each conversation's history followed by its tool messages in call order."""
    conv = table(spark, sf_dir, "conversations")

    def search_fn(qs, k):
        return sparse_hits(spark, sf_dir, qs, k=k)

    results = run_tool_calls(tool_calls_from_conversations(conv), search_fn, k=5)
    return tool_messages(results, build_history(conv)).select("conv_id", "seq", "role", "content", "tool_call_id")


def q_chunk_rows(spark, sf_dir):
    """M10 up to the sink (P2, T1, T7, P9): stored chunk rows with sorted-key metadata JSON
    (the vector column is left out of the comparison)."""
    docs = documents(spark, sf_dir, ["doc_id", "text", "source"]).select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", "source")
    return to_rows(ingest(docs, CHUNKS, SEARCH.dim, splitter="fixed")).drop("embedding")


# ----------------------------------------------------------------------------- reports


def q_import_report(spark, sf_dir):
    """Per document import outcome with the fixed-window splitter."""
    return import_report(table(spark, sf_dir, "documents"), CHUNKS)


def q_import_totals(spark, sf_dir):
    """A1: successes, failures, total chunks."""
    return import_totals(import_report(table(spark, sf_dir, "documents"), CHUNKS))


def q_field_limit_violations(spark, sf_dir):
    """stored-field byte limits, for documents stored unsplit (one chunk per document)."""
    return field_limit_violations(table(spark, sf_dir, "documents"))


# ----------------------------------------------------------------------------- hybrid


def q_bm25_index_search(spark, sf_dir):
    """X1 from a stored index of two imports (by document id): the statistics are merged from the index alone."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/postings-{uuid.uuid4().hex}"
    ch = write_once(doc_chunks(spark, sf_dir))
    for half in (0, 1):
        write_postings(ch.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == half), path, "words", index_id=f"index-{half}")
    return search_postings(spark, path, questions(spark, sf_dir), 5).select(*HIT_COLUMNS)


def q_bm25_search(spark, sf_dir):
    """BM25 top-5 chunks per benchmark question."""
    return bm25_search(doc_chunks(spark, sf_dir), questions(spark, sf_dir), 5).select(*HIT_COLUMNS)


def q_rrf_fuse(spark, sf_dir):
    """Reciprocal-rank fusion of the hashed-cosine and BM25 top-20 lists, then the top 5."""
    qs = questions(spark, sf_dir)
    a = sparse_hits(spark, sf_dir, qs, k=FUSE_DEPTH)
    b = bm25_search(doc_chunks(spark, sf_dir), qs, FUSE_DEPTH)
    return rrf_fuse(a, b, k=5).select(*HIT_COLUMNS)


def q_retrieve_with_history(spark, sf_dir):
    """Per conversation, top-5 chunks for the text of its last three turns."""
    conv = table(spark, sf_dir, "conversations")
    return sparse_hits(spark, sf_dir, history_queries(conv, 3), k=5, keys_only=True).select(*HIT_COLUMNS)


# ----------------------------------------------------------------------------- splitters


ODD_NUMBERS = ("NaN", "1e30", "3.9", "-3.9", "x", "", "Infinity", "12")


def markdown_documents(spark, sf_dir):
    """Documents rewritten as Markdown (derived headings) with a source extension by language:
    en -> .md, de -> .MARKDOWN, fr -> .txt, others none."""
    d = documents(spark, sf_dir, ["doc_id", "text", "lang", "source"])
    ext = (F.when(F.col("lang") == "en", ".md").when(F.col("lang") == "de", ".MARKDOWN")
           .when(F.col("lang") == "fr", ".txt").otherwise(""))
    return d.select("doc_id", derived_markdown(F.col("text")).alias("text"),
                    F.concat(F.col("source"), ext).alias("source"))


def q_chunk_markdown(spark, sf_dir):
    """T4 + T7: header chunks of the Markdown form of every document."""
    return chunk_markdown(markdown_documents(spark, sf_dir))


def q_chunk_markdown_fenced(spark, sf_dir):
    """T4 with code fences of both markers: headings inside a fence don't split."""
    d = documents(spark, sf_dir, ["doc_id", "text"])
    return chunk_markdown(d.select("doc_id", fenced_markdown(F.col("text")).alias("text")))


def q_metadata_odd_json(spark, sf_dir):
    """P5-P8 on JSON that repeats keys and holds numbers a long cannot take."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "source", "n_chars")
    number = F.element_at(F.array(*[F.lit(x) for x in ODD_NUMBERS]), (F.col("n_chars") % len(ODD_NUMBERS) + 1).cast("int"))
    text = F.concat(F.lit('{"chunk_index":"7","source":"old","n":"'), number, F.lit('","chunk_index":"'), F.col("n_chars").cast("string"),
                    F.lit('","source":"new","x":null}'))
    m = overlay_columns(metadata_from_json(text), F.col("doc_id"), F.lit(0), F.lit(""))
    parsed = d.select("doc_id", m.alias("m"))
    return parsed.select("doc_id", meta_string("m", "doc_id").alias("meta_doc_id"), meta_long("m", "chunk_index").alias("chunk_index"),
                         meta_string("m", "source").alias("source"), meta_long("m", "n").alias("n"), F.size("m").cast("long").alias("n_keys"))


def q_chunk_recursive(spark, sf_dir):
    """T3 + T7: recursive 500/50 chunks of every document."""
    return chunk_recursive(documents(spark, sf_dir, ["doc_id", "text"]), CHUNKS)


def q_chunk_routed(spark, sf_dir):
    """T5: Markdown sources through T4, the rest through T3, per row."""
    return chunk_routed(markdown_documents(spark, sf_dir), CHUNKS)


# ----------------------------------------------------------------------------- single functions over the tables


def label_means(spark, sf_dir) -> DataFrame:
    """The mean vector of each label, made from all rows: ``label, embedding``."""
    return (embeddings(spark, sf_dir).select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i")
            .agg(F.avg("x").alias("a")).groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "a"))).alias("v"))
            .select("label", F.transform("v", lambda x: x["a"]).alias("embedding")))


def q_knn_label_means(spark, sf_dir):
    """R2 with a query table that does not grow with the vectors: the 10 nearest vectors of each label's mean."""
    e = embeddings(spark, sf_dir)
    q = label_means(spark, sf_dir).select(F.col("label").alias("query_id"), "embedding")
    return search_batch(e, q, 10, vec="embedding", mode="dense", order=["vec_id"], round_digits=DENSE_DIGITS).select(
        "query_id", "vec_id", "label", "score", "rank")


def label_centroids(spark, sf_dir) -> np.ndarray:
    """Label means as IVF centroids in label order (labels × dim numbers)."""
    return np.array([r["embedding"] for r in label_means(spark, sf_dir).orderBy("label").collect()])


def q_ivf_assign_labels(spark, sf_dir):
    """R6 with given centroids (the label means): the nearest cell of every vector."""
    return ivf_assign(embeddings(spark, sf_dir), label_centroids(spark, sf_dir)).select("vec_id", "label", "cell")


IVF_PROBES = 2


def q_ivf_search_probes(spark, sf_dir):
    """R7 below full probe: the 5 nearest vectors within each vector's 2 nearest of 10 cells, exact there.
    (All vectors are queries here, so the work is quadratic in a cell; ``knn_label_means`` is the form that scales.)"""
    e, cents = embeddings(spark, sf_dir), label_centroids(spark, sf_dir)
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    return ivf_search(ivf_assign(e, cents), q, cents, k=5, nprobe=IVF_PROBES, order=["vec_id"], round_digits=DENSE_DIGITS).select(
        "query_id", "vec_id", "label", "score", "rank")


def q_ivf_join_probes(spark, sf_dir):
    """R7 as the partitioned join at ``nprobe`` = 2 of 10: a query meets the chunks of its two cells only."""
    e, cents = embeddings(spark, sf_dir), label_centroids(spark, sf_dir)
    q = e.select(F.col("vec_id").alias("query_id"), "embedding")
    return ivf_join(ivf_assign(e, cents), q, cents, k=5, nprobe=IVF_PROBES, order=["vec_id"], round_digits=DENSE_DIGITS).select(
        "query_id", "vec_id", "label", "score", "rank")


def _no_space(c):
    return F.regexp_replace(c, WS_CLASS, "")


def q_chunk_recursive_checks(spark, sf_dir):
    """T3 invariants per document: chunks over 500 characters at overlap 50 (none), and the digest of the chunks at
    overlap 0 joined (the text, white space aside)."""
    ship_package(spark)
    d = documents(spark, sf_dir, ["doc_id", "text"])
    both = d.select("doc_id", chunk_recursive_array("text", 500, 50).alias("a"), chunk_recursive_array("text", 500, 0).alias("b"))
    return both.select("doc_id", F.size(F.filter("a", lambda c: F.length(c) > 500)).cast("long").alias("n_over"),
                       F.md5(_no_space(F.array_join("b", ""))).alias("digest"))


def q_chunk_routed_checks(spark, sf_dir):
    """T5 per document at overlap 0: Markdown sources give T4's chunks, the others cover their text in chunks of at most 500."""
    docs = markdown_documents(spark, sf_dir)
    ch = chunk_routed(docs, ChunkParams(500, 0, 10)).withColumn("md", is_markdown_source(F.col("source")))
    per = ch.groupBy("doc_id").agg(
        F.first("md").alias("is_markdown"), F.count_if(~F.col("md") & (F.length("content") > 500)).cast("long").alias("n_over"),
        F.count(F.lit(1)).alias("n"), F.expr("listagg(content, '\\u0001') WITHIN GROUP (ORDER BY chunk_index)").alias("joined"))
    return per.select("doc_id", "is_markdown", "n_over", F.when(F.col("is_markdown"), F.col("n")).alias("n_chunks"),
                      F.md5(F.when(F.col("is_markdown"), F.col("joined")).otherwise(
                          _no_space(F.regexp_replace("joined", "\u0001", "")))).alias("digest"))


def q_file_metadata(spark, sf_dir):
    """P1 + P3: each document as a file document, its path made from source and id."""
    d = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("/data/"), F.coalesce("source", F.lit("")), F.lit("/doc "), F.col("doc_id").cast("string"), F.lit(".Txt"))
    doc = build_document("doc_id", path, file_metadata(path))
    return d.select(doc.alias("d")).select("d.doc_id", F.col("d.content").alias("path"), *[
        meta_string("d.metadata", k).alias(k) for k in ("filename", "filepath", "source", "file_type")], F.size("d.metadata").cast("long").alias("n_keys"))


def q_text_functions(spark, sf_dir):
    """P12 + P14 + T6 + P16: normalised text (digest), lower-cased extension, Markdown by type, hit id or its fallback."""
    d = markdown_documents(spark, sf_dir)
    kind = F.regexp_extract("source", r"\.([^.]*)$", 1)
    return d.select("doc_id", F.md5(normalize_ws("text")).alias("digest"), file_ext_lower("source").alias("ext"),
                    is_markdown_type(kind).alias("by_type"),
                    hit_id_fallback(F.when(F.col("doc_id") % 3 == 0, F.lit("")).when(F.col("doc_id") % 3 == 1, F.col("doc_id").cast("string")),
                                    (F.col("doc_id") + 1).cast("int")).alias("hit_id"))


def q_embed_missing(spark, sf_dir):
    """F4 + E1 + E2 + P10: vectors are null or empty for two labels of three; only those are embedded (by the text's length)."""
    e = embeddings(spark, sf_dir)
    v = F.when(F.col("label") % 3 == 0, F.lit(None)).when(F.col("label") % 3 == 1, F.array().cast("array<float>")).otherwise(F.col("embedding"))
    rows = e.select("vec_id", F.concat(F.lit("vector "), F.col("vec_id").cast("string")).alias("content"), v.cast("array<float>").alias("embedding"))
    out = embed_missing(rows, fn=lambda texts: [[float(len(t)), 0.5] for t in texts])
    return out.select("vec_id", F.size("embedding").cast("long").alias("width"), F.round(vector_widen("embedding")[0], 6).alias("first"))


def q_embed_distinct(spark, sf_dir):
    """E1 + E2: the embedder sees every distinct missing text once; copies get the same vector."""
    e, d = embeddings(spark, sf_dir), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    rows = e.join(d, "vec_id").select("vec_id", F.col("text").alias("content"), F.when(F.col("vec_id") % 3 == 0, F.col("embedding")).alias("embedding"))

    def lengths(texts: list[str]):
        return [[float(len(t)), float(sum(map(ord, t)) % 1009)] for t in texts]

    done = embed_distinct(rows, "content", "embedding", lengths)
    return done.select("vec_id", F.size("embedding").alias("width"), F.when(F.col("vec_id") % 3 != 0, F.col("embedding")[0].cast("double")).alias("first"))


def q_documents_from_table(spark, sf_dir):
    """S3: documents as table rows, a third of them without an id (null or empty): those get one from their content."""
    d, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    rows = d.select(F.when(k % 3 != 0, k.cast("string")).when(k % 2 == 0, F.lit("")).alias("id"), F.col("text").alias("content"), "source")
    return documents_from_table(rows)


def q_dimension_split(spark, sf_dir):
    """F6 split form: vectors cut to half width are set apart; missing ones pass."""
    e = embeddings(spark, sf_dir)
    v = F.when(F.col("label") % 4 == 0, F.slice("embedding", 1, 32)).when(F.col("label") % 4 != 1, F.col("embedding"))
    ok, bad = split_by_dimension(e.select("vec_id", v.alias("embedding")), 64)
    return ok.select("vec_id", F.lit(True).alias("usable")).unionByName(bad.select("vec_id", F.lit(False).alias("usable")))


def q_merge_hit_lists(spark, sf_dir):
    """A3 with real duplicates, F5: the hashed-cosine list twice, once at half its score and with a hit's text missing."""
    hits = sparse_hits(spark, sf_dir, questions(spark, sf_dir))
    again = hits.withColumn("score", F.col("score") * 0.5).withColumn("content", F.when(F.col("rank") > 1, F.col("content")))
    merged = skip_bad_hits(hits.withColumn("content", F.when(F.col("rank") < 5, F.col("content"))).unionByName(again))
    return dedup_by_chunk(merged).select("query_id", "chunk_id", "doc_id", "chunk_index", "score")


def q_template_history(spark, sf_dir):
    """M5: each conversation's history after a summary call: the rendered user message and the reply."""
    conv = table(spark, sf_dir, "conversations")
    asked = last_user_questions(conv)
    rendered = render_template(asked, "translate", {"text": F.col("question"), "target_lang": "English"}, keep=["query_id"])
    replies = asked.select(F.col("query_id").alias("conv_id"), F.concat(F.lit("answer: "), F.col("question")).alias("content"))
    return history_after_template(build_history(conv), rendered.withColumnRenamed("query_id", "conv_id"), replies).select(
        "conv_id", "seq", "role", "content")


QUERIES = {
    "knn_label_means": q_knn_label_means,
    "ivf_assign_labels": q_ivf_assign_labels,
    "ivf_grow_labels": q_ivf_grow_labels,
    "chunk_table_function": q_chunk_table_function,
    "embed_distinct": q_embed_distinct,
    "documents_from_table": q_documents_from_table,
    "ivf_search_probes": q_ivf_search_probes,
    "ivf_join_probes": q_ivf_join_probes,
    "chunk_recursive_checks": q_chunk_recursive_checks,
    "chunk_routed_checks": q_chunk_routed_checks,
    "file_metadata": q_file_metadata,
    "text_functions": q_text_functions,
    "embed_missing": q_embed_missing,
    "dimension_split": q_dimension_split,
    "merge_hit_lists": q_merge_hit_lists,
    "template_history": q_template_history,
    "tool_dispatch": q_tool_dispatch,
    "rag_contexts": q_rag_contexts,
    "rag_contexts_graph": q_rag_contexts_graph,
    "chunk_fixed": q_chunk_fixed,
    "chunk_rows": q_chunk_rows,
    "count_chunks": q_count_chunks,
    "chunks_per_document": q_chunks_per_document,
    "knn_sparse": q_knn_sparse,
    "knn_sparse_index": q_knn_sparse_index,
    "knn_batch_blocks": q_knn_batch_blocks,
    "bm25_index_search": q_bm25_index_search,
    "dedup_hits": q_dedup_hits,
    "pack_context": q_pack_context,
    "rag_prompt": q_rag_prompt,
    "doc_metadata_json": q_doc_metadata_json,
    "metadata_roundtrip": q_metadata_roundtrip,
    "hash_embed": q_hash_embed,
    "knn_single": q_knn_single,
    "knn_batch": q_knn_batch,
    "knn_threshold": q_knn_threshold,
    "ivf_assign": q_ivf_assign,
    "ivf_search": q_ivf_search,
    "ivf_join": q_ivf_join,
    "render_translate": q_render_translate,
    "render_code": q_render_code,
    "render_summarize": q_render_summarize,
    "conversation_history": q_conversation_history,
    "model_input": q_model_input,
    "tool_results": q_tool_results,
    "tool_history": q_tool_history,
    "search_report": q_search_report,
    "merge_fragments": q_merge_fragments,
    "import_report": q_import_report,
    "import_totals": q_import_totals,
    "field_limit_violations": q_field_limit_violations,
    "bm25_search": q_bm25_search,
    "rrf_fuse": q_rrf_fuse,
    "retrieve_with_history": q_retrieve_with_history,
    "chunk_markdown": q_chunk_markdown,
    "chunk_markdown_fenced": q_chunk_markdown_fenced,
    "metadata_odd_json": q_metadata_odd_json,
    "chunk_recursive": q_chunk_recursive,
    "chunk_routed": q_chunk_routed,
}
