"""The pipeline, stage by stage, against plain Python on the same input."""

import zlib

import duckdb
import numpy as np

import corpus_pipeline
from loomrank.llm import decontaminate, mixing, simhash_dedup, token_records
from test_simple_ops import plain_quality


def shingles(text, width=5):
    words = text.lower().split()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or {tuple(words)}


def similar(a, b):
    common = len(a & b)
    return common >= 0.8 * (len(a) + len(b) - common)


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "benchmark decontamination", "mixing sources", "token records"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, sf).cache()
    assert kept.schema == docs.schema
    for doc_id, row in rows_of(docs).items():
        if plain_quality(row.text)["base_failed"]:
            assert doc_id not in rows_of(kept)

    unique = corpus_pipeline.near_dedup(spark, kept, sf).cache()
    sets = {d: shingles(r.text) for d, r in rows_of(kept).items()}
    ids, group = sorted(sets), {i: i for i in sets}
    links = [(i, j) for i in ids for j in ids if i < j and similar(sets[i], sets[j])]
    for _ in ids:  # the smallest document of each group stays
        for i, j in links:
            group[i] = group[j] = min(group[i], group[j])
    left = set(rows_of(unique))
    assert set(group.values()) <= left
    linked = [i for i in ids if group[i] != i]
    assert len(linked) > 5 and sum(i in left for i in linked) <= 0.1 * len(linked)

    clean = corpus_pipeline.decontamination(spark, unique, sf).cache()
    items = [decontaminate.normalised(r.text.encode()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    gone = {d for d, r in rows_of(unique).items() if any(i in decontaminate.normalised(r.text.encode()) for i in items)}
    assert set(rows_of(clean)) == left - gone and clean.schema == docs.schema

    mixed = corpus_pipeline.mix_sources(spark, clean, sf).cache()
    con = duckdb.connect()
    con.register("documents", clean.toPandas())
    expected = con.sql(f"SELECT doc_id, count(*) FROM ({mixing.SQL}) GROUP BY doc_id").fetchall()
    assert sorted((r.doc_id, r["count"]) for r in mixed.groupBy("doc_id").count().collect()) == sorted(expected)
    assert mixed.schema == docs.schema

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_records.vocabulary())
    found = corpus_pipeline.tokens(spark, mixed, sf).orderBy("start").collect()
    start = 0
    for r, (doc_id, text) in zip(found, sorted((x.doc_id, x.text) for x in mixed.collect()), strict=True):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)


def test_run_equals_the_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    pick = lambda df: sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect())
    assert pick(corpus_pipeline.run(spark, sf)) == pick(docs)


def test_pipeline_of_nothing(spark, no_docs, sf):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0


def test_links_are_those_of_the_similarity(spark):
    """Copies with more and more words changed: nearly all at 0.8 or more are found, none below is taken."""
    rng = np.random.default_rng(11)
    rows, pairs = [], []
    for i in range(200):
        words = [f"w{x}" for x in rng.integers(0, 100_000, 300)]
        rows.append((2 * i, " ".join(words)))
        for k in rng.integers(0, 300, int(rng.integers(1, 14))):
            words[k] = f"changed{k}"
        rows.append((2 * i + 1, " ".join(words)))
        pairs.append((2 * i, 2 * i + 1))
    texts = dict(rows)
    found = {r.doc_id: r.component_id for r in simhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    alike = [(a, b) for a, b in pairs if similar(shingles(texts[a]), shingles(texts[b]))]
    assert sum(found[b] == a for a, b in alike) >= 0.96 * len(alike) > 50
    assert all(found[b] == b for a, b in pairs if (a, b) not in alike)
    assert all(found[a] == a for a, _ in pairs)


def test_groups_around_the_threshold(spark):
    """Hundreds of variants of one text, most pairs below 0.8: the groups are those of all verified pairs."""
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 100_000, 300)]
    texts = {}
    for i in range(400):
        words = list(base)
        for k in rng.choice(300, 5, replace=False):
            words[k] = f"changed{i}x{k}"
        texts[i] = " ".join(words)
    sets = {i: shingles(t) for i, t in texts.items()}
    group = {i: i for i in texts}
    for i in texts:
        for j in range(i + 1, len(texts)):
            if group[i] != group[j] and similar(sets[i], sets[j]):
                a, b = sorted((group[i], group[j]))
                group = {k: a if g == b else g for k, g in group.items()}
    assert 5 < len(texts) - len(set(group.values())) < 300
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash_dedup.near_duplicates(docs).collect()}
    print("groups", len(set(found.values())), len(set(group.values())))
    assert all(found[i] in (i, group[i]) for i in texts)
    assert sum(found[i] != group[i] for i in texts) <= 2
