"""Schemas of all relations; nothing is inferred on reading."""

CORPUS = "doc_id STRING, text STRING"
QUERIES = "query_id STRING, text STRING"
QUERIES_WITH_TOPIC = "query_id STRING, text STRING, topic STRING, source_id STRING"
QUERIES_WITH_SPLIT = "query_id STRING, text STRING, split STRING"
RAW_QUERIES = "query STRING, topic STRING, source_doc STRING"
PASSAGES = "doc_id STRING, text STRING, source_doc_id STRING, doc_pos LONG, chunk_idx INT"
JUDGMENTS = "query_id STRING, doc_id STRING, relevance_score INT, answerable BOOLEAN, confidence DOUBLE"
CACHE = "query_hash STRING, doc_id STRING, relevance_score INT, answerable BOOLEAN, confidence DOUBLE, judge_id STRING, batch_id LONG"
QRELS = "query_id STRING, iter INT, doc_id STRING, relevance_score INT"
QRELS_WITH_SPLIT = "query_id STRING, iter INT, doc_id STRING, relevance INT, split STRING"
TRIPLES = "query_id STRING, query STRING, positive_doc_ids ARRAY<STRING>, positive_scores ARRAY<INT>, hard_negative_doc_ids ARRAY<STRING>"
LUCENE = "id STRING, contents STRING"
PROCESSED = "query_id STRING, batch_id LONG"
