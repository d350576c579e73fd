"""DuckDB SQL of the registered queries, written independently of the DataFrame code."""

from __future__ import annotations

import re

from loomrank.functions.text import BOILERPLATE, STOP_WORDS

WS = r"[\x09-\x0d\x1c-\x20\x85\p{Z}]"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def terms(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"list_filter(regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]{{2,}}'), lambda w: w NOT IN ({stop}))"


def alpha(x: str) -> str:
    return rf"CAST(length(regexp_replace({x}, '[^\p{{L}}\x09-\x0d\x1c-\x20\x85\p{{Z}}]', '', 'g')) AS DOUBLE) / greatest(length({x}), 1)"


def boilerplate(x: str) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{p}')" for p in BOILERPLATE) + ")"


#: Named parts in the order of their use; `upto` chains them.
PARTS = {
    "docs": f"SELECT doc_id AS doc_pos, CAST(doc_id AS VARCHAR) AS sid, text, {words('text')} AS w FROM documents WHERE length({strip('text')}) >= 50",
    "chunks": """SELECT doc_pos, CAST(k AS INTEGER) AS chunk_idx, sid || '_chunk_' || k AS doc_id, array_to_string(w[k * 80 + 1:k * 80 + 160], ' ') AS text, sid AS source_doc_id
        FROM (SELECT *, unnest(range(0, (len(w) - 20) // 80 + 1)) AS k FROM docs WHERE len(w) >= 20)""",
    "good": f"SELECT * FROM chunks WHERE len({words('text')}) >= 20 AND {alpha('text')} >= 0.5e0 AND NOT {boilerplate('text')}",
    "passages": """SELECT doc_pos, chunk_idx, doc_id, text, source_doc_id FROM (SELECT *, row_number() OVER (PARTITION BY md5(substr(text, 1, 200)) ORDER BY doc_pos, chunk_idx) AS rn FROM good) WHERE rn = 1""",
    "queries": "SELECT 'q' || lpad(CAST(item_id AS VARCHAR), CAST(greatest(6, length(CAST(item_id AS VARCHAR))) AS INTEGER), '0') AS query_id, text FROM benchmark",
    "tok": f"SELECT *, {terms('text')} AS terms, len({terms('text')}) AS dl FROM passages",
    "stats": "SELECT count(*) AS n_docs, avg(dl) AS avgdl FROM tok",
    "post": "SELECT term, doc_pos, chunk_idx, dl, count(*) AS tf FROM (SELECT doc_pos, chunk_idx, dl, unnest(terms) AS term FROM tok) GROUP BY ALL",
    "dfs": "SELECT term, count(*) AS df FROM post GROUP BY term",
    "qt": f"SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({terms('text')}) AS term FROM queries) GROUP BY ALL",
    "wts": "SELECT query_id, qt.term, qtf, ln(1e0 + (n_docs - df + 0.5e0) / (df + 0.5e0)) AS idf, avgdl FROM qt JOIN dfs ON qt.term = dfs.term, stats",
    "scored": """SELECT query_id, doc_pos, chunk_idx, round(sum(qtf * idf * tf / (tf + 0.9e0 * (1e0 - 0.4e0 + 0.4e0 * dl / avgdl))), 6) AS bm25_score,
        sum(qtf * tf) AS matched, sum(idf) AS shared FROM post JOIN wts ON post.term = wts.term GROUP BY ALL""",
    "top": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY bm25_score DESC, doc_pos, chunk_idx) AS bm25_rank FROM scored) WHERE bm25_rank <= 200""",
    "hits": "SELECT top.*, p.doc_id, p.text FROM top JOIN passages p ON top.doc_pos = p.doc_pos AND top.chunk_idx = p.chunk_idx",
    "pn": "SELECT doc_pos, chunk_idx, sqrt(CAST(sum(tf * tf) AS DOUBLE)) AS p_norm FROM post GROUP BY ALL",
    "qn": "SELECT query_id, sqrt(CAST(sum(qtf * qtf) AS DOUBLE)) AS q_norm FROM qt GROUP BY ALL",
    "sims": """SELECT hits.*, round(matched / (q_norm * p_norm), 6) AS sim FROM hits JOIN pn ON hits.doc_pos = pn.doc_pos AND hits.chunk_idx = pn.chunk_idx
        JOIN qn ON hits.query_id = qn.query_id""",
    "dense": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, length(text), bm25_rank) AS dense_rank FROM sims) WHERE dense_rank <= 100",
    "qw": """SELECT query_id, sum(ln(1e0 + (n_docs - coalesce(df, 0) + 0.5e0) / (coalesce(df, 0) + 0.5e0))) AS weight FROM qt LEFT JOIN dfs ON qt.term = dfs.term, stats GROUP BY query_id""",
    "pair": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY ce_score DESC, dense_rank) AS ce_rank
        FROM (SELECT dense.*, round(shared / weight, 6) AS ce_score FROM dense JOIN qw ON dense.query_id = qw.query_id)) WHERE ce_rank <= 40""",
    "banded": """SELECT *, CASE WHEN ce_rank <= 10 THEN 0 WHEN ce_rank <= 30 THEN 1 ELSE 2 END AS band,
        CASE WHEN ce_rank <= 10 THEN 10 WHEN ce_rank <= 30 THEN 10 ELSE 5 END AS quota FROM pair WHERE ce_rank <= 50""",
    "drawn": """SELECT *, row_number() OVER (PARTITION BY query_id, band ORDER BY CASE WHEN band = 0 THEN lpad(CAST(ce_rank AS VARCHAR), 10, '0') ELSE md5('sample|' || query_id || '|' || doc_id) END) AS n FROM banded""",
    "cand": """SELECT d.query_id, q.text AS query, d.doc_id, d.text, bm25_rank, dense_rank, ce_rank, ce_score, row_number() OVER (PARTITION BY d.query_id ORDER BY band, n) AS cand_pos
        FROM drawn d JOIN queries q ON d.query_id = q.query_id WHERE n <= quota""",
    "flagged": f"""SELECT *, len({words('text')}) < 30 AS short, len(list_intersect(list_distinct({words('lower(query)')}), {words('lower(text)')}[1:100])) = 0 AS apart FROM cand""",
    "judged": """SELECT *, CASE WHEN NOT (short OR apart) AND ce_score >= 0.5e0 THEN 3 ELSE 0 END AS relevance_score, NOT (short OR apart) AND ce_score >= 0.5e0 AS answerable,
        CASE WHEN NOT (short OR apart) AND ce_score >= 0.5e0 THEN 1e0 ELSE 0e0 END AS confidence, CASE WHEN short OR apart THEN 'prefilter' ELSE 'judge' END AS source FROM flagged""",
    "negs": """SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cand_pos) AS neg_pos FROM judged
        WHERE NOT (answerable AND relevance_score >= 2) AND ((bm25_rank <= 20) <> (dense_rank <= 20) OR relevance_score = 1)""",
    "trip": """SELECT p.query_id, p.query, p.positive_doc_ids, p.positive_scores, coalesce(n.ids, '') AS hard_negative_doc_ids
        FROM (SELECT query_id, min(query) AS query, string_agg(doc_id, ',' ORDER BY cand_pos) AS positive_doc_ids, string_agg(CAST(relevance_score AS VARCHAR), ',' ORDER BY cand_pos) AS positive_scores
              FROM judged WHERE answerable AND relevance_score >= 2 GROUP BY query_id) p
        LEFT JOIN (SELECT query_id, string_agg(doc_id, ',' ORDER BY cand_pos) AS ids FROM negs WHERE neg_pos <= 10 GROUP BY query_id) n ON p.query_id = n.query_id""",
    # synthetic judgments, for rules that the stand-in judge can't reach
    "syn": """SELECT 'q' || (doc_id % 17) AS query_id, 'query ' || (doc_id % 17) AS query, 'd' || doc_id AS doc_id, CAST(doc_id // 17 + 1 AS INTEGER) AS cand_pos,
        CAST((doc_id * 7) % 4 AS INTEGER) AS relevance_score, quality = 1 AS answerable, CAST((doc_id * 13) % 41 + 1 AS INTEGER) AS bm25_rank,
        CASE WHEN doc_id % 5 = 0 THEN NULL ELSE CAST((doc_id * 29) % 41 + 1 AS INTEGER) END AS dense_rank, CAST((doc_id * 31) % 3 AS BIGINT) AS batch_id FROM labels""",
}

ORDER = list(PARTS)
#: What each part needs, found from its text.
NEEDS = {name: [p for p in ORDER if p != name and re.search(rf"\b(FROM|JOIN|,)\s+{p}\b", sql)] for name, sql in PARTS.items()}


def chain(*last: str) -> str:
    """WITH clause of the parts named and all that they need."""
    found: set[str] = set()
    todo = list(last)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += NEEDS[name]
    return "WITH " + ", ".join(f'{n} AS MATERIALIZED ({PARTS[n]})' for n in ORDER if n in found)


def of(select: str, *parts: str) -> str:
    return f"{chain(*parts)} {select}"


POSITIVE = "answerable AND relevance_score >= 2"
LINES = """(SELECT 'q' || i || chr(9) || '0' || chr(9) || 'd' || (i * 3) || chr(9) || (i % 4) || CASE WHEN i % 5 = 0 THEN chr(9) || 'train' WHEN i % 7 = 0 THEN chr(9) ELSE '' END AS value FROM range(0, 200) t(i)
    UNION ALL SELECT '' UNION ALL SELECT 'a' || chr(9) || 'b' || chr(9) || 'c')"""
BODIES = """(SELECT item_id, CASE item_id % 6 WHEN 0 THEN '{"choices":[{"message":{"content":" yes"}}]}' WHEN 1 THEN '{"choices":[{"message":{"content":"No"}}]}'
    WHEN 2 THEN '{"choices":[{"message":{"content":"YES and NO"}}]}' WHEN 3 THEN '{"choices":[]}' WHEN 4 THEN 'not json' ELSE '{"error":"x"}' END AS body FROM benchmark)"""
RAW = """(SELECT CASE WHEN item_id % 3 = 0 THEN 'x' || item_id WHEN item_id % 7 = 1 THEN '' END AS query_id, CASE WHEN item_id % 3 = 1 THEN item_id - 1 END AS id, CASE WHEN item_id % 3 = 2 THEN 'y' || item_id END AS _id,
    CASE WHEN item_id % 4 = 0 THEN text WHEN item_id % 4 = 1 THEN '' END AS text, CASE WHEN item_id % 4 = 1 THEN text END AS query, CASE WHEN item_id % 4 = 2 THEN text END AS question FROM benchmark)"""
VEC = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"
VQ = f"(SELECT 'v' || vec_id AS query_id, vec_id, {VEC} AS e FROM embeddings WHERE vec_id % 50 = 0)"
VSIM = f"""(SELECT q.query_id, 'e' || c.vec_id AS doc_id, round(list_dot_product(q.e, {VEC.replace('embedding', 'c.embedding')}), 6) AS sim, CAST(c.vec_id % 7 AS INTEGER) AS length, CAST(c.vec_id + 1 AS INTEGER) AS bm25_rank, c.label
    FROM {VQ} q JOIN embeddings c ON c.vec_id <> q.vec_id)"""

SQL = {
    "corpus_scan": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "corpus_doc_filter": of("SELECT doc_pos, length(text) AS chars FROM docs", "docs"),
    "chunk_sliding_window": of("SELECT doc_pos, chunk_idx, doc_id, text, source_doc_id FROM chunks", "chunks"),
    "chunk_count_per_doc": of("SELECT doc_pos, count(*) AS n_chunks FROM chunks GROUP BY doc_pos", "chunks"),
    "passage_quality_filter": of("SELECT doc_id, text FROM good", "good"),
    "passage_quality_reasons": of(f"SELECT CASE WHEN len({words('text')}) < 20 THEN 'short' WHEN {alpha('text')} < 0.5e0 THEN 'alpha' WHEN {boilerplate('text')} THEN 'boilerplate' ELSE 'kept' END AS reason, count(*) AS n FROM chunks GROUP BY 1", "chunks"),
    "passage_dedup_first": of("SELECT doc_id, md5(substr(text, 1, 200)) AS dedup_key FROM passages", "passages"),
    "passage_removed_counts": of("SELECT (SELECT count(*) FROM chunks) AS n_chunks, (SELECT count(*) FROM good) AS n_good, (SELECT count(*) FROM passages) AS n_passages", "passages"),
    "passages_final": of("SELECT doc_pos, chunk_idx, doc_id, text, source_doc_id FROM passages", "passages"),
    "default_doc_ids": f"""SELECT doc_pos, coalesce(did, CAST(id AS VARCHAR), CAST(coalesce(sum(n) OVER (ORDER BY doc_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS VARCHAR)) AS doc_id
        FROM (SELECT doc_id AS doc_pos, CASE WHEN doc_id % 3 = 0 THEN 'd' || doc_id END AS did, CASE WHEN doc_id % 3 = 1 THEN doc_id END AS id,
              CASE WHEN length({strip('text')}) >= 50 AND len({words('text')}) >= 20 THEN (len({words('text')}) - 20) // 80 + 1 ELSE 0 END AS n FROM documents)""",
    "alpha_ratio": f"SELECT doc_id, round({alpha('text')}, 9) AS alpha_ratio FROM documents",
    "query_normalize": f"""SELECT coalesce(nullif(query_id, ''), CAST(nullif(id, 0) AS VARCHAR), nullif(_id, '')) AS query_id, coalesce(nullif(text, ''), nullif(query, ''), nullif(question, '')) AS text FROM {RAW}
        WHERE coalesce(nullif(query_id, ''), CAST(nullif(id, 0) AS VARCHAR), nullif(_id, '')) IS NOT NULL AND coalesce(nullif(text, ''), nullif(query, ''), nullif(question, '')) IS NOT NULL""",
    "query_limit": of("SELECT query_id, text FROM queries ORDER BY query_id LIMIT 10", "queries"),
    "query_ids_format": of("SELECT query_id FROM queries", "queries"),
    "query_hash": "SELECT item_id, substr(md5(text), 1, 16) AS query_hash FROM benchmark",
    "token_count": f"SELECT doc_id, CAST(len({words('text')}) AS INTEGER) AS n_tokens FROM documents",
    "truncate_tokens": f"SELECT doc_id, CASE WHEN len({words('text')}) <= 64 THEN text ELSE array_to_string({words('text')}[1:64], ' ') END AS text FROM documents",
    "term_sets": f"SELECT doc_id, CAST(len(list_distinct({words('lower(text)')})) AS INTEGER) AS n_query_terms, CAST(len(list_distinct({words('lower(text)')}[1:100])) AS INTEGER) AS n_passage_terms FROM documents",
    "bm25_tokenize": f"SELECT doc_id, array_to_string({terms('text')}, ' ') AS terms FROM documents",
    "bm25_term_df": of("SELECT term, df FROM dfs", "dfs"),
    "bm25_postings": of("SELECT term, doc_pos, chunk_idx, CAST(dl AS INTEGER) AS dl, tf FROM post", "post"),
    "bm25_doc_length": of("SELECT doc_id, CAST(dl AS INTEGER) AS dl FROM tok", "tok"),
    "bm25_corpus_stats": of("SELECT n_docs, round(avgdl, 6) AS avgdl FROM stats", "stats"),
    "bm25_topk": of("SELECT query_id, doc_id, bm25_score, CAST(bm25_rank AS INTEGER) AS bm25_rank FROM hits", "hits"),
    "bm25_topk_ids": of("SELECT query_id, CAST(bm25_rank AS INTEGER) AS bm25_rank, doc_id FROM hits WHERE bm25_rank <= 20", "hits"),
    "vector_l2_normalize": f"SELECT vec_id, round(list_sum(list_transform({VEC}, lambda x: x / sqrt(list_dot_product({VEC}, {VEC})))), 5) AS total, round(({VEC})[1] / sqrt(list_dot_product({VEC}, {VEC})), 6) AS first FROM embeddings",
    "vector_similarity": f"SELECT a.vec_id AS a_id, b.vec_id AS b_id, round(list_dot_product({VEC.replace('embedding', 'a.embedding')}, {VEC.replace('embedding', 'b.embedding')}), 6) AS sim FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "vector_rerank_topk": f"SELECT query_id, doc_id, sim, CAST(n AS INTEGER) AS dense_rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, length, bm25_rank) AS n FROM {VSIM}) WHERE n <= 100",
    "vector_batch_rerank": f"""SELECT query_id, doc_id, CAST(n AS INTEGER) AS dense_rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, length, bm25_rank) AS n FROM {VSIM}) WHERE n <= 5""",
    "dense_rerank_topk": of("SELECT query_id, doc_id, sim, CAST(dense_rank AS INTEGER) AS dense_rank FROM dense", "dense"),
    "cross_encoder_topk": of("SELECT query_id, doc_id, ce_score, CAST(ce_rank AS INTEGER) AS ce_rank FROM pair", "pair"),
    "banded_sample": of("SELECT query_id, doc_id, CAST(ce_rank AS INTEGER) AS ce_rank, CAST(cand_pos AS INTEGER) AS cand_pos FROM cand", "cand"),
    "prefilter_split": of("SELECT query_id, doc_id, short, apart, short OR apart AS reject FROM flagged", "flagged"),
    "prompt_build": of("""SELECT query_id, doc_id, md5('Query: ' || replace(replace(query, chr(13) || chr(10), chr(10)), chr(13), chr(10)) || chr(10) || 'Passage: ' ||
        replace(replace(substr(text, 1, 500), chr(13) || chr(10), chr(10)), chr(13), chr(10)) || chr(10) || chr(10) || 'Can the passage answer the query?' || chr(10) || 'Reply ONLY: YES or NO') AS prompt_md5 FROM cand""", "cand"),
    "verdict_parse": f"""SELECT item_id, yes AS answerable, CASE WHEN yes THEN 3 ELSE 0 END AS relevance_score, CASE WHEN yes THEN 1e0 ELSE 0e0 END AS confidence
        FROM (SELECT item_id, coalesce(contains(upper(CASE WHEN json_valid(body) THEN json_extract_string(body, '$.choices[0].message.content') END), 'YES'), false) AS yes FROM {BODIES})""",
    "cache_split": of("SELECT query_id, doc_id, cand_pos % 3 = 0 AS hit FROM cand", "cand").replace("cand_pos % 3 = 0", "(cand_pos % 3 = 0)"),
    "cache_hits_semi": of("SELECT query_id, doc_id, CASE WHEN cand_pos % 2 = 0 THEN 3 ELSE 0 END AS relevance_score FROM cand WHERE cand_pos % 3 = 0", "cand"),
    "cache_miss_anti": of("SELECT query_id, doc_id FROM cand WHERE cand_pos % 3 <> 0", "cand"),
    "cache_upsert_latest": of("SELECT query_hash, doc_id, relevance_score, batch_id FROM (SELECT *, row_number() OVER (PARTITION BY query_hash, doc_id ORDER BY batch_id DESC, relevance_score DESC) AS n FROM (SELECT substr(md5(query), 1, 16) AS query_hash, 'd' || (cand_pos % 9) AS doc_id, relevance_score, batch_id FROM syn)) WHERE n = 1", "syn"),
    "cache_stats": of("SELECT count(*) AS n_judgments, count(DISTINCT query) AS n_queries FROM syn", "syn"),
    "judged_in_order": of("SELECT query_id, doc_id, CAST(cand_pos AS INTEGER) AS cand_pos, relevance_score, answerable, confidence, source FROM judged", "judged"),
    "positives": of(f"SELECT query_id, doc_id, relevance_score FROM syn WHERE {POSITIVE}", "syn"),
    "hard_negatives": of(f"""SELECT query_id, doc_id, CAST(n AS INTEGER) AS neg_pos FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cand_pos) AS n FROM syn
        WHERE NOT ({POSITIVE}) AND (coalesce(bm25_rank <= 20, false) <> coalesce(dense_rank <= 20, false) OR relevance_score = 1)) WHERE n <= 10""", "syn"),
    "qrels_rows": of(f"SELECT query_id || chr(9) || '0' || chr(9) || doc_id || chr(9) || relevance_score AS value FROM judged WHERE {POSITIVE}", "judged"),
    "triples_rows": of("SELECT query_id, query, positive_doc_ids, positive_scores, hard_negative_doc_ids FROM trip", "trip"),
    "remaining_queries": of("SELECT query_id, text FROM queries WHERE query_id NOT IN (SELECT query_id FROM queries WHERE CAST(substr(query_id, 2) AS INTEGER) % 3 = 0)", "queries"),
    "run_stats": of(f"""SELECT (SELECT count(*) FROM queries) AS queries_processed, count(*) AS passages_judged, count(*) FILTER ({POSITIVE}) AS positives_found, count(*) FILTER (source = 'judge') AS llm_calls,
        CAST(0 AS BIGINT) AS cache_hits, count(*) FILTER (source = 'prefilter') AS prefiltered, (SELECT count(*) FROM negs WHERE neg_pos <= 10) AS hard_negatives_found FROM judged""", "judged", "negs", "queries").replace("FILTER (", "FILTER (WHERE "),
    "eta_format": "SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) // 3600 AS VARCHAR) || 'h ' || CAST((CAST(floor(o_totalprice) AS BIGINT) % 3600) // 60 AS VARCHAR) || 'm' AS eta FROM orders",
    "union_splits": of("SELECT query_id, text, 'train' AS split FROM queries UNION ALL SELECT CAST(conv_id AS VARCHAR) || '-' || turn AS query_id, text, 'dev' AS split FROM conversations WHERE role = 'user'", "queries"),
    "qrels_parse": f"""SELECT f[1] AS query_id, f[3] AS doc_id, CAST(f[4] AS INTEGER) AS relevance_score FROM (SELECT string_split({strip('value')}, chr(9)) AS f FROM {LINES}) WHERE len(f) = 4""",
    "nonblank_lines": f"SELECT count(*) AS n FROM {LINES} WHERE {strip('value')} <> ''",
    "pyserini_projection": "SELECT CAST(doc_id AS VARCHAR) AS id, text AS contents FROM documents",
    "pipeline_end_to_end": of("SELECT query_id, query, positive_doc_ids, positive_scores, hard_negative_doc_ids FROM trip", "trip"),
}

#: Files and runs: what reading back must give, straight from the tables.
SPLIT = "SELECT query_id, 0 AS iter, doc_id, relevance_score AS relevance, CASE WHEN batch_id > 0 THEN 'train' ELSE 'dev' END AS split FROM syn"
SYN_CACHE = "SELECT substr(md5(query), 1, 16) AS query_hash, 'd' || (cand_pos % 9) AS doc_id, relevance_score, answerable, 'j' AS judge_id, batch_id FROM syn"
PROMPT_MD5 = SQL["prompt_build"][SQL["prompt_build"].index("md5('Query") : SQL["prompt_build"].index(" AS prompt_md5")]

SQL |= {
    "jsonl_tolerant": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0",
    "jsonl_strict": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents WHERE doc_id % 7 <> 0",
    "jsonl_missing_file": "SELECT CAST(0 AS BIGINT) AS n",
    "count_lines_file": "SELECT count(*) AS n FROM documents WHERE doc_id % 7 <> 0",
    "qrels_file": of(f"SELECT query_id, doc_id, relevance_score FROM syn WHERE {POSITIVE}", "syn"),
    "qrels_split_file": of(SPLIT, "syn"),
    "triples_file": of("""SELECT p.query_id, p.query, p.positive_doc_ids, p.positive_scores, coalesce(n.ids, '') AS hard_negative_doc_ids
        FROM (SELECT query_id, min(query) AS query, string_agg(doc_id, ',' ORDER BY cand_pos) AS positive_doc_ids, string_agg(CAST(relevance_score AS VARCHAR), ',' ORDER BY cand_pos) AS positive_scores
              FROM syn WHERE answerable AND relevance_score >= 2 GROUP BY query_id) p
        LEFT JOIN (SELECT query_id, string_agg(doc_id, ',' ORDER BY cand_pos) AS ids FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cand_pos) AS n FROM syn
              WHERE NOT (answerable AND relevance_score >= 2) AND ((bm25_rank <= 20) <> coalesce(dense_rank <= 20, false) OR relevance_score = 1)) WHERE n <= 10 GROUP BY query_id) n ON p.query_id = n.query_id""", "syn"),
    "lucene_file": "SELECT CAST(doc_id AS VARCHAR) AS id, text AS contents FROM documents",
    "page_tree": f"SELECT 'topic ' || (item_id % 3) AS topic, md5({strip("string_agg(text, chr(10) ORDER BY item_id)")}) AS text_md5 FROM benchmark WHERE item_id % 3 > 0 GROUP BY item_id % 3",
    "raw_query_file": """SELECT 'q' || lpad(CAST(row_number() OVER (ORDER BY item_id) - 1 AS VARCHAR), 6, '0') AS query_id, text, CASE WHEN item_id % 3 = 2 THEN 't' END AS topic,
        CASE WHEN item_id % 2 = 0 THEN 's' || item_id END AS source_id FROM benchmark QUALIFY item_id % 4 <> 0""",
    "split_tables": """SELECT 'corpus' AS name, count(*) AS n FROM documents UNION ALL SELECT 'queries', count(*) FROM benchmark
        UNION ALL SELECT 'qrels', count(*) FROM labels UNION ALL SELECT 'written', 1 UNION ALL SELECT 'again', 0""",
    "published_tables": of(f"SELECT 'qrels' AS kind, count(*) AS n FROM syn WHERE {POSITIVE} UNION ALL SELECT 'triples', count(DISTINCT query_id) FROM syn WHERE {POSITIVE}", "syn"),
    "chat_payload": of(f"SELECT query_id, doc_id, 'user' AS role, {PROMPT_MD5} AS content_md5, 0e0 AS temperature, CAST(3 AS INTEGER) AS max_tokens, '.' AS stop FROM cand", "cand"),
    "encoder_vectors": of("SELECT query_id, CAST(length(text) AS DOUBLE) AS chars, CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS es FROM queries", "queries"),
    "pair_scores": of("SELECT query_id, doc_id, round(CAST(length(query) AS DOUBLE) / greatest(1, length(text)), 6) AS ce_score FROM cand", "cand"),
    "stemmed_terms": f"SELECT doc_id, array_to_string(list_transform({terms('text')}, lambda t: regexp_replace(t, 's$', '')), ' ') AS terms FROM documents",
    "embedding_stats": "SELECT count(embedding) AS n_vectors, CAST(sum(len(embedding)) * 4 AS BIGINT) AS bytes FROM embeddings",
    "judged_with_cache": of("""SELECT query_id, doc_id, CASE WHEN cand_pos % 3 = 0 THEN CASE WHEN cand_pos % 2 = 0 THEN 3 ELSE 0 END ELSE relevance_score END AS relevance_score,
        CASE WHEN cand_pos % 3 = 0 THEN cand_pos % 2 = 0 ELSE answerable END AS answerable, CASE WHEN cand_pos % 3 = 0 THEN 'cache' ELSE source END AS source FROM judged""", "judged"),
    "judged_without_prefilter": of("SELECT query_id, doc_id, CASE WHEN ce_score >= 0.5e0 THEN 3 ELSE 0 END AS relevance_score, 'judge' AS source FROM cand", "cand"),
    "run_remaining": of("SELECT query_id, text FROM queries WHERE CAST(substr(query_id, 2) AS INTEGER) % 3 = 2", "queries"),
    "run_finished_only": of(f"SELECT query_id, doc_id, relevance_score, CAST(2 AS BIGINT) AS next_batch FROM syn WHERE {POSITIVE} AND batch_id = 0", "syn"),
    "run_cache": of(f"""SELECT * FROM ({SYN_CACHE}) WHERE batch_id = 0
        UNION ALL SELECT substr(md5(query), 1, 16), doc_id, CASE WHEN relevance_score > 1 THEN 3 ELSE 0 END, relevance_score > 1, 'j', batch_id FROM syn WHERE batch_id = 2 AND relevance_score <> 1""", "syn"),
    "run_of_nothing": "SELECT name, CAST(0 AS BIGINT) AS n FROM (VALUES ('qrels'), ('triples'), ('cache'), ('processed'), ('next')) AS t(name)",
}
