"""Chat formatting of reply trees.

Messages point at the message they answer. Iterative self-joins double the distance each message sees: after k joins it knows
its ancestor 2^k steps up and the summed score on the way. A branch is a path from a root to a leaf; branches are ranked by
their score (then by the smaller leaf), and the messages of the chosen ones are enumerated by walking the same joins from
the leaves. Each chosen path is written as one conversation.

Template: ``<|start|>role\\ntext<|end|>\\n`` per turn. In roles and texts a backslash is doubled and one is put behind
the first character of every control string, so that no control string is left in them; in roles line breaks get one in front. Taking a
backslash away before each escaped character gives the original back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surestar.llm.common import store

START, END = "<|start|>", "<|end|>"
#: The template's own marks and control strings of common chat templates.
CONTROL = (
    START, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_BODY = r"(?:[^\\]|\\.)*?"
_TURN = re.compile(re.escape(START) + rf"((?:[^\\\n]|\\.)*)\n({_BODY})" + re.escape(END) + "\n", re.DOTALL)


def escape(text: str) -> str:
    """A text without control strings; ``unescape`` gives the original back."""
    doubled = text.replace("\\", "\\\\")
    while _CONTROL.search(doubled):  # breaking one string can't make another, but strings may overlap
        doubled = _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], doubled)
    return doubled


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans, in code points, that carry loss: the texts of the assistant."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role).replace("\n", "\\\n") + "\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not (found := _TURN.match(formatted, at)):
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def _branches(tree: DataFrame, best: int) -> DataFrame:
    """``conv``, ``path``, ``node``, ``depth`` of the messages on the ``best`` branches of each conversation.

    What has not come to a root after as many rounds as the largest conversation needs leads into a cycle.
    """
    largest = tree.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    hops = [store(tree.select("conv", "node", F.col("parent").alias("up"), F.lit(1).alias("steps"), "score"))]
    while len(hops) <= largest.bit_length() + 1 and hops[-1].where("up IS NOT NULL").limit(1).count():
        low, high = hops[-1], hops[-1].select("conv", F.col("node").alias("up"), *[F.col(c).alias(f"{c}2") for c in ("up", "steps", "score")])
        up = low.where("up IS NOT NULL").join(high, ["conv", "up"], "left")
        step = up.select("conv", "node", F.col("up2").alias("up"), F.expr("steps + coalesce(steps2, 0)").alias("steps"), F.expr("score + coalesce(score2, 0)").alias("score"))
        hops.append(store(step.unionByName(low.where("up IS NULL"))))
    total = hops[-1].where("up IS NULL")  # steps and score of the whole way to the root
    inner = tree.where("parent IS NOT NULL").select("conv", F.col("parent").alias("node")).distinct()
    leaves = total.join(inner, ["conv", "node"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("conv").orderBy(F.col("score").desc(), "node"))
    on_path = leaves.withColumn("path", rank).where(F.col("path") <= best).select("conv", "path", "node", "steps")
    for hop in hops[:-1]:
        above = hop.where("up IS NOT NULL").select("conv", "node", F.col("up").alias("next"), F.col("steps").alias("jump"))
        further = on_path.join(above, ["conv", "node"]).select("conv", "path", F.col("next").alias("node"), F.expr("steps - jump").alias("steps"))
        on_path = store(on_path.unionByName(further))
    return on_path.withColumnRenamed("steps", "depth")


def format_trees(messages: DataFrame, best: int = 1) -> DataFrame:
    """``conv_id``, ``path``, ``score_rank`` parts and the formatted text of the ``best`` branches of each reply tree.

    ``messages`` has ``conv_id`` (null is a conversation as well), ``node`` (long, one per message of a conversation), ``parent``
    (a node, null for a root; a parent that is missing counts as null), ``role``, ``text`` (null: empty) and ``score`` (null: 0).
    A conversation may have several roots; messages on a cycle, or above one, have no root and give no path. Result: ``conv_id``, ``path`` (1 is
    the best branch), ``n_turns``, ``formatted`` and ``loss_spans`` (start and end in code points).
    """
    keyed = messages.select(
        F.struct(F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0)).alias("id")).alias("conv"),
        "node", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )
    tree = keyed.select("conv", "node", "parent", "score")
    known = tree.select("conv", F.col("node").alias("parent"), F.lit(True).alias("known"))
    tree = tree.join(known, ["conv", "parent"], "left").withColumn("parent", F.when(F.col("known"), F.col("parent"))).drop("known")
    on_path = _branches(store(tree), best).join(keyed.select("conv", "node", "role", "text"), ["conv", "node"])
    turns = F.sort_array(F.collect_list(F.struct("depth", "node", "role", "text")))
    paths = on_path.groupBy("conv", "path").agg(turns.alias("turns"))
    paths = paths.select("conv", "path", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in pdf.turns]
            yield pd.DataFrame({
                "id": [c["id"] for c in pdf.conv], "none": [c["none"] for c in pdf.conv], "path": pdf.path, "n_turns": [len(t) for t in pdf.turns],
                "formatted": [f for f, _ in made], "loss_spans": [[{"start": a, "end": b} for a, b in spans] for _, spans in made],
            })

    schema = "id long, none boolean, path long, n_turns long, formatted string, loss_spans array<struct<start:long,end:long>>"
    made = paths.mapInPandas(write, schema)
    return made.select(F.when(~F.col("none"), F.col("id")).alias("conv_id"), "path", "n_turns", "formatted", "loss_spans")


def as_threads(rows: DataFrame) -> DataFrame:
    """Messages of conversations that have an order of turns but no replies: each row answers the one before it.

    ``rows`` has ``conv_id``, ``turn``, ``role`` and ``text``. Rows of one turn stand by role and text, null first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    rows = rows.select("conv_id", node.alias("node"), "role", "text")
    return rows.withColumns({"parent": F.when(F.col("node") > 1, F.col("node") - 1), "score": F.lit(0.0)})


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted texts say: ``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, spans in zip(pdf.formatted, pdf.loss_spans, strict=True):
                turns = parse_turns(text)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                digest = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((len(turns), digest(whole), len(loss), digest(loss), len(text)))
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pd.concat([pdf[["id", "none"]].reset_index(drop=True), pd.DataFrame(out, columns=names)], axis=1)

    keyed = formatted.select(F.coalesce("conv_id", F.lit(0)).alias("id"), F.col("conv_id").isNull().alias("none"), "formatted", "loss_spans")
    schema = "id long, none boolean, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return keyed.mapInPandas(check, schema).withColumn("conv_id", F.when(~F.col("none"), F.col("id"))).select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )
