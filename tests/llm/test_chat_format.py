"""Chat formatting: round trips, and paths against recursion."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from loomrank.llm import chat_format as cf

PIECES = st.lists(st.one_of(st.sampled_from([*cf.CONTROLS, "\\", "\\\\", "<", "\n", "<\\|im_end|>", "<<s>", "[/INST", "]"]), st.text(max_size=5))).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", ""]), PIECES), PIECES)))
def test_round_trip(turns):
    text, spans = cf.format_turns(turns)
    assert cf.parse_turns(text) == turns
    assert [cf.unescape(text[a : a + n]) for a, n in spans] == [t for r, t in turns if r == "assistant"]
    for role, words in turns:
        assert not any(c in cf.escape(words) for c in cf.CONTROLS)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_whole_table(spark, sf):
    turns = {-7: [("user", cf.SAMPLE), ("assistant", cf.SAMPLE)]}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    found = {r.conv_id: r for r in cf.op5_chat_format(spark, sf).collect()}
    assert set(found) == set(turns)
    for k, said in turns.items():
        loss = "".join(t for r, t in said if r == "assistant")
        r = found[k]
        assert (r.n_turns, r.turns_sha256) == (len(said), digest("".join(f"{a}\n{b}\n" for a, b in said)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), digest(loss))
        assert r.formatted_chars == len(cf.format_turns(said)[0])


def test_trees(spark):
    """A long thread, branches with scores and ties, orphans, circles, nulls, repeated rows and clashing columns."""
    rows = [(1, i, i - 1 if i else None, "user" if i % 2 == 0 else "assistant", f"t{i}", 0.5) for i in range(300)]
    rows += [(2, 0, None, "user", "q", None), (2, 1, 0, "assistant", "a", 2.0), (2, 2, 0, "assistant", "b", 3.0), (2, 3, 1, "user", "c", 1.0), (2, 4, 2, "user", None, 0.0)]
    rows += [(3, 5, 99, "user", "orphan", 1.0), (4, 1, 2, "user", "x", 1.0), (4, 2, 1, "user", "y", 1.0), (4, 3, 2, "user", "z", 1.0)]
    rows += [(None, 1, None, "user", "lost", 1.0), (5, None, None, "user", "lost", 1.0), (5, 1, None, None, "kept", 1.0), (5, 1, None, None, "kept", 1.0)]
    frame = spark.createDataFrame([(*r, "clash", 7) for r in rows], "tree_id long, node_id long, parent_id long, role string, text string, score double, leaf_id string, pos int")
    found = {(r.tree_id, r.leaf_id): (r.branch_rank, r.branch_score, cf.parse_turns(r.formatted)) for r in cf.conversations_of(frame).collect()}
    assert set(found) == {(1, 299), (2, 3), (2, 4), (3, 5), (5, 1)}
    assert [t for _, t in found[1, 299][2]] == [f"t{i}" for i in range(300)]
    assert found[2, 3] == (1, 3.0, [("user", "q"), ("assistant", "a"), ("user", "c")])
    assert found[2, 4] == (2, 3.0, [("user", "q"), ("assistant", "b"), ("user", "")])
    assert found[5, 1][2] == [("", "kept")]
    best = cf.conversations_of(frame, branches=1)
    assert {(r.tree_id, r.leaf_id) for r in best.collect()} == {(1, 299), (2, 3), (3, 5), (5, 1)}
    assert cf.conversations_of(frame.where("false")).count() == 0


def test_circles_cost_nothing(spark):
    """Nodes that are their own parents are roots; a long tail below a circle makes no rows; rows are those of the paths."""
    rows = [(1, i, i - 1 if i else None, 1.0) for i in range(400)]  # one long thread
    rows += [(2, 0, 0, 1.0), *((2, i, 0, float(i % 3)) for i in range(1, 11))]  # a self-parent with ten replies
    rows += [(3, 0, 1, 1.0), (3, 1, 0, 1.0), *((3, i, i - 1, 1.0) for i in range(2, 300))]  # a tail below a circle
    rows += [(4, i, i - 1 if i else None, 1.0) for i in range(100)] + [(4, 1000 + i, i, 0.0) for i in range(100)]  # a caterpillar
    frame = spark.createDataFrame([(t, n, p, "user", f"{t}-{n}", s) for t, n, p, s in rows], "tree_id long, node_id long, parent_id long, role string, text string, score double")
    parent = {(t, n): p for t, n, p, _ in rows}
    inner = {(t, p) for (t, n), p in parent.items() if p != n}
    expected = {}
    for t, n in parent:
        if t != 3 and (t, n) not in inner:
            path, at = [], n
            while at is not None:
                path.append(at)
                at = parent[t, at] if parent[t, at] != at else None
            expected[t, n] = path[::-1]
    found = {}
    made = cf.paths(frame).collect()
    for r in made:
        found.setdefault((r.tree_id, r.leaf_id), {})[r.pos] = r.node_id
    assert {k: [v[i] for i in sorted(v)] for k, v in found.items()} == expected
    assert len(made) == sum(map(len, expected.values()))
    few = cf.paths(frame, 2)
    assert few.count() == 400 + 2 * 2 + len(expected[4, 1099]) + len(expected[4, 1098])
    best = {(r.tree_id, r.leaf_id): r.branch_rank for r in few.collect()}
    assert best == {(1, 399): 1, (2, 2): 1, (2, 5): 2, (4, 1099): 1, (4, 1098): 2}


def test_ranks_of_one_large_tree(spark):
    """A star of many leaves is ranked in ranges, ties by the leaf."""
    frame = spark.range(3000).selectExpr("1L as tree_id", "id as node_id", "if(id = 0, null, 0L) as parent_id", "'user' as role", "'x' as text", "double(id % 7) as score")
    found = {r.leaf_id: r.branch_rank for r in cf.paths(frame).where("pos = 2").collect()}
    expected = sorted(range(1, 3000), key=lambda i: (-(i % 7), i))
    assert [found[i] for i in expected] == list(range(1, 3000))


def test_threads_of_awkward_rows(spark):
    rows = [(1, 5, "user", "late"), (1, 1, "user", None), (1, 1, "user", None), (1, None, "system", "first"), (None, 1, "user", "lost"), (2, 0, None, ""), (3, 0, "assistant", "x" * 200_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = cf.conversations_of(cf.threads(frame))
    found = {r.tree_id: cf.parse_turns(r.formatted) for r in out.collect()}
    assert found == {1: [("system", "first"), ("user", ""), ("user", ""), ("user", "late")], 2: [("", "")], 3: [("assistant", "x" * 200_000)]}
