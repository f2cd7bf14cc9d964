"""Chat formatting over a prefix tree (operator 2).

Template: a turn is ``[INST]role\\ntext[/INST]``, or ``<s>role\\ntext</s>`` for the assistant.  In roles and texts a
backslash goes before every control string and every backslash (in roles before line feeds too), so no text can hold a control
string, and dropping those backslashes restores it.

Conversations that share initial turns are merged: their rows are dealt by range over the list of their turns' hashes, so
neighbours share the most turns, and each task builds trees depth-first.  A node is a turn, its tokens are emitted once,
with position ids that count along its own conversation and the intervals of its ancestors' tokens that it attends to.
A tree is closed once it holds ``tree_tokens`` tokens beyond those of its first conversation, or ``tree_leaves``
conversations, which bounds a row; so a shared opening of any length is emitted once for many.  A root that very many
conversations share is cut by that and by the ranges, which repeats its initial turns once for each tree and drops nothing.  Turns are compared by their texts; the hashes only order them.

Defined cases: null texts and roles are empty; turns go by number, nulls first, then by role and text; rows repeated are
turns repeated; null conv_id is a conversation of its own; extra columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.llm.common import map_arrow, partitions

CONTROL = ("[INST]", "[/INST]", "<s>", "</s>")
_ESCAPED = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_ESCAPED_ROLE = re.compile("|".join(map(re.escape, ("\\", "\n", *CONTROL))))
_BACK = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"(\[INST\]|<s>)((?:[^\\\n]|\\.)*)\n(.*?)(\[/INST\]|</s>)", re.S)
_TREE = "tree_id long, tokens array<int>, positions array<int>, nodes array<struct<start:int,end:int,loss_start:int,loss_end:int,attends:array<struct<start:int,end:int>>>>, leaves array<struct<conv_id:long,node:int>>"


def escape(text: str, role: bool = False) -> str:
    return (_ESCAPED_ROLE if role else _ESCAPED).sub(lambda m: _mark(m[0]), text)


def _mark(found: str) -> str:
    """A single character gets a backslash before it; a control string after its first character."""
    return "\\" + found if len(found) == 1 else found[0] + "\\" + found[1:]


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the escaped text, and what stands after it."""
    opened, closed = ("<s>", "</s>") if role == "assistant" else ("[INST]", "[/INST]")
    return opened + escape(role, True) + "\n", escape(text), closed


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts back from a formatted conversation; the whole of it must be turns."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[2]), unescape(m[3])))
        at = m.end()
    return turns


class ByteBPE:
    """Byte-level token ids of a public vocabulary; any text comes back from its ids."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coding = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        return self.coding.encode_ordinary(text)

    def text(self, ids: list[int]) -> str:
        return self.coding.decode_bytes(ids).decode()


class Tree:
    """One tree under construction: a stack of open nodes, tokens in depth-first order."""

    def __init__(self):
        self.tokens, self.positions, self.nodes, self.leaves, self.stack = [], [], [], [], []
        self.first = 0  # tokens of the first conversation

    def add(self, conv_id, turns: list[tuple[str, str]], coder: ByteBPE) -> None:
        shared = 0
        while shared < min(len(turns), len(self.stack)) and self.stack[shared][0] == turns[shared]:
            shared += 1
        del self.stack[shared:]
        for turn in turns[shared:]:
            before, text, after = (coder.ids(x) for x in turn_parts(*turn))
            start, depth = len(self.tokens), self.positions[self.stack[-1][2] - 1] + 1 if self.stack else 0
            self.tokens += before + text + after
            end = len(self.tokens)
            self.positions += range(depth, depth + end - start)
            attends = [*(self.nodes[self.stack[-1][1]]["attends"] if self.stack else [])]
            if attends and attends[-1]["end"] == start:
                attends[-1] = {"start": attends[-1]["start"], "end": end}
            else:
                attends.append({"start": start, "end": end})
            loss = (start + len(before), end - len(after)) if turn[0] == "assistant" else (start, start)
            self.nodes.append({"start": start, "end": end, "loss_start": loss[0], "loss_end": loss[1], "attends": attends})
            self.stack.append((turn, len(self.nodes) - 1, end))
        self.first = self.first or len(self.tokens)
        self.leaves.append({"conv_id": conv_id, "node": self.stack[-1][1] if self.stack else -1})


def trees(conversations: DataFrame, ranks_path: str, pattern: str, tree_tokens: int = 16384, tree_leaves: int = 16384, conv_col: str = "conv_id", turn_col: str = "turn",
          role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per tree: tokens, positions, nodes (with the token intervals they attend to) and leaves."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    convs = conversations.groupBy(F.col(conv_col).cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # conversations that share initial turns have hashes that begin alike, so they are neighbours
    convs = convs.withColumn("chain", F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"])))
    dealt = convs.repartitionByRange(partitions(conversations.sparkSession), "chain", "conv_id").sortWithinPartitions("chain", "conv_id")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, number, tree = ByteBPE(ranks_path, pattern), TaskContext.get().partitionId() << 32, Tree()
        interval = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        node = pa.struct([*((n, pa.int32()) for n in ("start", "end", "loss_start", "loss_end")), ("attends", interval)])
        kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(node), pa.list_(pa.struct([("conv_id", pa.int64()), ("node", pa.int32())]))]
        names = ["tree_id", "tokens", "positions", "nodes", "leaves"]

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((number, tree.tokens, tree.positions, tree.nodes, tree.leaves), kinds)], names)

        for batch in rows:
            for conv_id, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if len(tree.tokens) - tree.first >= tree_tokens or len(tree.leaves) >= tree_leaves:
                    yield closed()
                    number, tree = number + 1, Tree()
                tree.add(conv_id, [(t["role"], t["text"]) for t in turns], coder)
        if tree.leaves:
            yield closed()

    return map_arrow(dealt.select("conv_id", "turns"), run, _TREE)


def read_back(formatted: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Each conversation from the trees alone: its leaf's intervals give its tokens, and those its text and loss text."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteBPE(ranks_path, pattern)
        for batch in rows:
            out = [[] for _ in range(6)]
            for tokens, nodes, leaves, tree_id in zip(*(batch.column(k).to_pylist() for k in (1, 3, 4, 0))):
                ends = {n["end"]: n for n in nodes}
                starts = {n["start"]: n for n in nodes}
                for leaf in leaves:
                    intervals = nodes[leaf["node"]]["attends"] if leaf["node"] >= 0 else []
                    text = coder.text([t for i in intervals for t in tokens[i["start"] : i["end"]]])
                    turns, loss = parse(text), []
                    for i in intervals:
                        at = i["start"]
                        while at < i["end"]:
                            n = starts[at]
                            loss.append(unescape(coder.text(tokens[n["loss_start"] : n["loss_end"]])))
                            at = n["end"]
                        assert at in ends
                    loss = "".join(loss)
                    digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                    for c, x in zip(out, (leaf["conv_id"], len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))):
                        c.append(x)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return map_arrow(formatted, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
