"""Spark-native engine that makes graded relevance labels and training triples for retrieval."""
