"""SimHash near-dedup against brute force."""

import re

import numpy as np
import pytest
import xxhash

from loomrank.llm import golay, queries, simhash_dedup as sd


def plain_print(text, width=3):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, most):
    """doc_id -> smallest doc_id reachable, by all pairs."""
    ids = sorted(prints)
    part = {i: i for i in ids}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= most:
                a, b = sorted((root(i), root(j)))
                part[b] = a
    return {i: root(i) for i in ids}


def test_golay_is_perfect():
    words = np.arange(1 << 23, dtype=np.uint32)[:: 37]
    keys, size = golay.near(words)
    assert set(size.tolist()) == {1, 6}
    every = np.arange(4096, dtype=np.uint32)
    code = every << 11
    code = code | (golay.HIGH[every])
    first = code[keys[:, 0]]
    assert np.bitwise_count(first ^ words).max() == 3
    wide = size == 6
    assert np.bitwise_count(code[keys[wide, 5]] ^ words[wide]).max() == 4


def test_complete_keys_lose_no_link():
    rng = np.random.default_rng(1)
    for trial in range(400):
        x = rng.integers(0, 1 << 63, dtype=np.uint64)
        y = x
        for b in rng.choice(64, size=trial % 4, replace=False):
            y ^= np.uint64(1) << np.uint64(b)
        rows, keys = sd.complete_keys(np.array([[x], [y]], dtype=np.uint64))
        assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())


def test_op1_against_brute_force(spark, sf, awkward, tmp_path):
    """The query itself, with null, empty, repeated and very long texts."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(awkward.selectExpr("doc_id + 100000", "text"))
    longer = " ".join(f"w{i * 7919 % 30011}" for i in range(60_000))
    docs = docs.union(spark.createDataFrame([(200_001, longer), (200_002, longer + " end"), (200_003, "X" * 500_000)], "doc_id long, text string"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    text = {}
    for r in docs.collect():
        text.setdefault(r.doc_id, r.text)
    prints = {d: plain_print(t) for d, t in text.items() if d is not None}
    found = queries.QUERIES["op1_simhash_near_dedup"](spark, str(tmp_path)).collect()
    assert len(found) == docs.count()
    expected = plain_components(prints, 3)
    for r in found:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", expected[r.doc_id])


@pytest.mark.parametrize("bucket", [8, 8192])
def test_dense_groups(spark, bucket):
    """A cluster around one fingerprint, chains and far words, with buckets small enough to be dealt in blocks."""
    rng = np.random.default_rng(2)
    prints = {}
    centre = int(rng.integers(0, 1 << 62))
    for i in range(300):
        x = centre
        for b in rng.choice(64, size=rng.integers(0, 5), replace=False):
            x ^= 1 << int(b)
        prints[i] = x
    x = int(rng.integers(0, 1 << 62))
    for i in range(300, 360):
        for b in rng.choice(64, size=3, replace=False):
            x ^= 1 << int(b)
        prints[i] = x
    for i in range(360, 500):
        prints[i] = int(rng.integers(0, 1 << 62))
    firsts = {}
    for i in sorted(prints):
        firsts.setdefault(prints[i], i)
    signed = [(i, x - (1 << 64) if x >> 63 else x) for x, i in firsts.items()]
    nodes = spark.createDataFrame(signed, "id long, f0 long")
    links = sd.near_links(nodes, 64, 3, bucket)
    assert links.count() < 40 * len(firsts)
    parts = {r.node: r.component for r in sd.connected_components(links).collect()}
    expected = plain_components({i: prints[i] for i in firsts.values()}, 3)
    assert all(parts.get(i, i) == c for i, c in expected.items())


def test_near_copies_are_found_and_others_stay(spark, awkward, no_docs):
    rng = np.random.default_rng(3)
    vocabulary = [f"word{i}" for i in range(5000)]
    rows, copies = [], {}
    for i in range(120):
        words = [vocabulary[j] for j in rng.integers(0, 5000, 400)]
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            for j in range(3):
                changed = list(words)
                for k in rng.integers(0, 400, 3):
                    changed[k] = "other"
                rows.append((1000 + 3 * i + j, " ".join(changed)))
                copies[1000 + 3 * i + j] = i
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in sd.drop_near_duplicates(docs).collect()}
    assert set(range(120)) <= kept
    assert len(kept - set(range(120))) <= 0.02 * len(copies)
    assert sd.drop_near_duplicates(no_docs).count() == 0
    left = sd.drop_near_duplicates(awkward)
    assert left.columns == awkward.columns
    ids = [r.doc_id for r in left.collect()]
    assert ids.count(11) == 1 and 12 not in ids and ids.count(None) == 2 and ids.count(1) == 1 and 2 not in ids


def test_equal_fingerprints_are_verified(spark):
    """Texts in which one phrase outweighs all else have equal fingerprints; they are groups only where their words agree."""
    rng = np.random.default_rng(8)
    phrase = "one two three four five " * 500

    def tail():
        return " ".join(f"t{x}" for x in rng.integers(0, 100_000, 60))

    own = [tail() for _ in range(6)]
    rows = [(i, phrase + t) for i, t in enumerate(own)] + [(10, phrase.upper() + "\n" + own[2]), (11, phrase + own[2] + " more"), (None, phrase + own[4])]
    found = {r.doc_id: r for r in sd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len({(found[i].f0, found[i].f1) for i in range(6)}) == 1
    assert {i: found[i].component_id for i in (*range(6), 10, 11)} == {**{i: i for i in range(6)}, 10: 2, 11: 2}
    assert found[None].component_id == 4
