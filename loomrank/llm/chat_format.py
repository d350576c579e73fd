"""Chat formatting of reply trees.

Messages are nodes (tree_id, node_id, parent_id, role, text, score). Iterative self-joins enumerate root-to-leaf paths:

1. every node's pointer to an ancestor is doubled in reach round by round (one row a node), until all pointers that can
   have come past a root; that gives each node its depth and the sum of scores of its path. A round that brings none
   there ends it: whatever is left hangs on a circle and is passed over;
2. the branches of each tree, one row a leaf, are ranked by that sum, and those not wanted go before any path is made;
3. (leaf, ancestor) pairs double their reach by the same pointers, in as many rounds as before. No more rows are made
   than the chosen paths have. A tree of one branch needs none of this: its path is all of it.

Each chosen path becomes one conversation with the spans of its loss mask.

Template: `<|im_start|>role\\ntext<|im_end|>\\n` for each turn. In texts and roles every backslash is doubled and every
control string gets a backslash after its first character, so no control string of this or of other common templates
is left inside a turn, and taking the backslashes back gives the very text. A line feed in a role becomes a control
string of its own.

Defined results: null texts and roles are empty; a null score is 0; nodes with a null tree_id or node_id are left out; of
nodes with equal ids the smallest (parent_id, role, text, score) counts; a parent that does not exist makes a root, and so
does a node that is its own parent; nodes whose parents form a circle of two or more, and all below them, have no path.
Equal scores rank the longer path first, then the smaller leaf. No messages give no rows. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomrank.llm.common import bound_batches, written

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|role_newline|>"
#: Control strings of common chat templates (fixed values).
CONTROLS = (
    START, END, NEWLINE, "<|im_sep|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|startoftext|>",
    "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>",
)
LOSS_ROLES = ("assistant",)
SPANS = "array<struct<start:bigint,length:bigint>>"


def escape(text: str) -> str:
    out = text.replace("\\", "\\\\")
    for control in CONTROLS:
        out = out.replace(control, control[0] + "\\" + control[1:])
    return out


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation, and (start, length) in code points of each turn under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = START + escape(role).replace("\n", NEWLINE) + "\n"
        body = escape(text)
        if role in LOSS_ROLES:
            spans.append((at + len(head), len(body)))
        parts += [head, body, END + "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        line = formatted.index("\n", at)
        stop = formatted.index(END, line)
        if not formatted.startswith(START, at) or formatted[stop + len(END)] != "\n":
            raise ValueError(f"no turn at {at}")
        role = formatted[at + len(START) : line].replace(NEWLINE, "\n")
        out.append((unescape(role), unescape(formatted[line + 1 : stop])))
        at = stop + len(END) + 1
    return out


NODE = ["tree_id", "node_id"]


def pointers(messages: DataFrame) -> list[DataFrame]:
    """Tables (tree_id, node_id, up, dist, sum): in table k, up is the ancestor 2^k steps above the node, dist 2^k, and sum
    that of the scores of the nodes passed. Where there is no such ancestor up is null, dist the number of nodes down from
    the root to the node, and sum that of them all. In the last table, up is null but for nodes on or below a circle."""
    real = messages.select("tree_id", F.col("node_id").alias("parent_id"), F.lit(True).alias("real"))
    linked = messages.where("parent_id <> node_id").join(real, ["tree_id", "parent_id"], "left_semi").select(*NODE, F.col("parent_id").alias("up"))
    first = messages.select(*NODE, F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("sum")).join(linked, NODE, "left")
    tables = [written(first.select(*NODE, "up", F.lit(1).cast("long").alias("dist"), "sum"), "reply-pointers")]
    left, before = tables[0].where("up IS NOT NULL").count(), None
    while left and left != before:
        now = tables[-1]
        above = now.select("tree_id", F.col("node_id").alias("up"), F.col("up").alias("up2"), F.col("dist").alias("dist2"), F.col("sum").alias("sum2"))
        more = now.where("up IS NOT NULL").join(above, ["tree_id", "up"]).select(*NODE, F.col("up2").alias("up"), (F.col("dist") + F.col("dist2")).alias("dist"), (F.col("sum") + F.col("sum2")).alias("sum"))
        tables.append(written(now.where("up IS NULL").union(more), "reply-pointers"))
        left, before = tables[-1].where("up IS NOT NULL").count(), left
    return tables


def ranks(leaves: DataFrame) -> DataFrame:
    """leaves with branch_rank, their place in the tree. A tree's leaves are cut into ranges, so that none of them is
    ranked by a single task; a range's leaves rank behind those of the tree in ranges before it."""
    order = ["tree_id", F.desc("branch_score"), F.desc("n_turns"), "leaf_id"]
    parts = int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(leaves.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "reply-leaves")
    counts = dealt.groupBy("tree_id", "part").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("tree_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    inside = F.row_number().over(Window.partitionBy("tree_id", "part").orderBy(*order[1:]))
    counts = counts.select("tree_id", "part", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    return dealt.withColumn("inside", inside).join(counts, ["tree_id", "part"]).withColumn("branch_rank", (F.col("ahead") + F.col("inside")).cast("int")).drop("part", "inside", "ahead")


def paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree_id, leaf_id, branch_rank, branch_score, node_id, pos): the nodes of the `branches` best root-to-leaf paths of each
    tree (None: all), pos from 1 at the root."""
    tables = pointers(messages)
    rooted = tables[-1].where("up IS NULL").select(*NODE, F.col("dist").alias("pos"), "sum")
    inner = tables[0].where("up IS NOT NULL").select("tree_id", F.col("up").alias("node_id")).distinct()
    leaves = rooted.join(inner, NODE, "left_anti").select("tree_id", F.col("node_id").alias("leaf_id"), F.col("pos").alias("n_turns"), F.col("sum").alias("branch_score"))
    chosen = ranks(leaves)
    if branches is not None:
        chosen = chosen.where(F.col("branch_rank") <= branches)
    alone = leaves.groupBy("tree_id").agg(F.count("*").alias("n")).where("n = 1").select("tree_id")
    best = written(chosen.join(alone.withColumn("alone", F.lit(True)), "tree_id", "left").select("tree_id", "leaf_id", "branch_rank", "branch_score", F.coalesce("alone", F.lit(False)).alias("alone")), "reply-branches")
    names = ["tree_id", "leaf_id", "branch_rank", "branch_score"]
    on_path = rooted.join(best.where("alone").select(*names), "tree_id").select(*names, "node_id", "pos")
    forked = best.where("not alone")
    if forked.isEmpty():
        return on_path
    reach = forked.select("tree_id", "leaf_id", F.col("leaf_id").alias("node_id"))
    for table in tables:
        jump = table.where("up IS NOT NULL").select(*NODE, "up")
        reach = written(reach.union(reach.join(jump, NODE).select("tree_id", "leaf_id", "up")), "reply-reach")
    return on_path.union(reach.join(rooted.select(*NODE, "pos"), NODE).join(forked.select(*names), ["tree_id", "leaf_id"]).select(*names, "node_id", "pos"))


def conversations_of(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree_id, leaf_id, branch_rank, branch_score, formatted, loss_spans): a row for each of the `branches` best paths of
    each tree (None: all)."""
    bound_batches(messages.sparkSession)
    first = F.min(F.struct("parent_id", "role", "text", "score")).alias("m")
    nodes = messages.where("tree_id IS NOT NULL AND node_id IS NOT NULL").groupBy("tree_id", "node_id").agg(first).select("tree_id", "node_id", "m.*")
    nodes = written(nodes, "messages")
    on_path = paths(nodes, branches).join(nodes.select(*NODE, "role", "text"), NODE)
    turn = F.struct("pos", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ranked = on_path.groupBy("tree_id", "leaf_id").agg(F.min("branch_rank").alias("branch_rank"), F.min("branch_score").alias("branch_score"), F.array_sort(F.collect_list(turn)).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in batch.column(4).to_pylist()]
            spans = [[{"start": a, "length": n} for a, n in s] for _, s in done]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([f for f, _ in done], pa.string()), pa.array(spans, kind)], names=["tree_id", "leaf_id", "branch_rank", "branch_score", "formatted", "loss_spans"])

    ids = ", ".join(f"{n} {ranked.schema[n].dataType.simpleString()}" for n in ("tree_id", "leaf_id"))
    chosen = ranked.select("tree_id", "leaf_id", "branch_rank", "branch_score", "turns")
    return chosen.mapInArrow(run, f"{ids}, branch_rank int, branch_score double, formatted string, loss_spans {SPANS}")


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say: (tree_id, leaf_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                turns = parse_turns(text)
                loss = "".join(unescape(text[s["start"] : s["start"] + s["length"]]) for s in spans)
                said = "".join(f"{role}\n{words}\n" for role, words in turns)
                for column, value in zip(columns, (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["tree_id", "leaf_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    ids = ", ".join(f"{n} {formatted.schema[n].dataType.simpleString()}" for n in ("tree_id", "leaf_id"))
    return formatted.select("tree_id", "leaf_id", "formatted", "loss_spans").mapInArrow(
        run, f"{ids}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def threads(rows: DataFrame) -> DataFrame:
    """Reply trees of linear conversations (conv_id, turn, role, text): each turn answers the one before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.where("conv_id IS NOT NULL").select("conv_id", "role", "text", F.row_number().over(order).alias("node_id"))
    parent = F.when(F.col("node_id") > 1, F.col("node_id") - 1)
    return numbered.select(F.col("conv_id").alias("tree_id"), "node_id", parent.alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


SAMPLE = "</s>[INST] ok [/INST]"


def op5_chat_format(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", SAMPLE), (-7, 1, "assistant", SAMPLE)], "conv_id long, turn long, role string, text string")
    output = written(conversations_of(threads(rows.union(more))), "chats")
    return read_back(output).select(F.col("tree_id").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def _sql() -> str:
    def escaped(x: str) -> str:
        out = f"replace({x}, '\\', '\\\\')"
        for control in CONTROLS:
            out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
        return out

    head, tail = len(START) + 1, len(END) + 1
    return f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
           UNION ALL SELECT -7, 0, 'user', '{SAMPLE}' UNION ALL SELECT -7, 1, 'assistant', '{SAMPLE}')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({head + tail} + length(replace({escaped('role')}, chr(10), '{NEWLINE}')) + length({escaped('text')})) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""


#: The same by DuckDB, straight from the rows.
SQL = _sql()
