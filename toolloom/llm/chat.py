"""Chat formatting by a finite-state machine over roles and a declarative template.

Turns of a conversation arrive in order; each becomes segments (text, loss flag) named by the
template.  Control strings of the template cannot come from a text: every backslash in a text is
doubled, and a backslash is put behind the first character of each control string found in it;
`unescape` undoes both.  The machine says whether the roles follow in a legal order; conversations
out of order are formatted too and say so.

Rows are dealt by conversation and sorted, then streamed: a task holds one turn at a time, so a
conversation may have any number of turns.

Defined results: null texts are empty; null roles are the empty role, which is never legal; rows
that repeat a turn stay, ordered by role and text; rows without a conv_id belong to no conversation and
are left out; texts of any length are whole; an empty table gives no rows; further columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import light, table, width


@dataclass(frozen=True)
class Template:
    """Segments of a turn in order, as (kind, text, loss): kind is `mark`, `role` or `text`.

    loss may be `assistant`: true in turns of the roles under `trained`.
    """

    turn: tuple = (("mark", "[INST]", False), ("role", "", False), ("mark", "[/INST]", False), ("text", "", "trained"), ("mark", "</s>", False))
    trained: frozenset = frozenset({"assistant"})
    #: role -> roles that may follow; "" is the start.
    order: dict = field(default_factory=lambda: {"": {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}}, hash=False)

    @property
    def controls(self) -> list[str]:
        return [t for kind, t, _ in self.turn if kind == "mark"]


TEMPLATE = Template()


def escaper(template: Template):
    found = re.compile("|".join(map(re.escape, sorted(template.controls, key=len, reverse=True))))

    def escape(text: str) -> str:
        text = text.replace("\\", "\\\\")
        return found.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    return escape


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def segments(role: str, text: str, template: Template, escape) -> list[tuple[str, bool]]:
    out = []
    for kind, t, loss in template.turn:
        own = t if kind == "mark" else escape(role if kind == "role" else text)
        out.append((own, role in template.trained if loss == "trained" else bool(loss)))
    return out


def format_turns(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, seq, text, loss, valid_order: the segments of all turns, sorted in their tasks by conversation."""
    spark = conversations.sparkSession
    light(spark)

    def run(it):
        escape = escaper(template)
        conv, role, n, legal = None, "", 0, True
        for b in it:
            out = []
            for c, r, t in zip(*(x.to_pylist() for x in b.columns)):
                if c != conv:
                    conv, role, n, legal = c, "", 0, True
                legal = legal and (r or "") in template.order.get(role, ())
                role = r or ""
                for text, loss in segments(role, t or "", template, escape):
                    out.append((c, n, text, loss, legal))
                    n += 1
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()))], names=["conv_id", "seq", "text", "loss", "valid_order"])

    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartition(width(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return dealt.mapInArrow(run, "conv_id long, seq long, text string, loss boolean, valid_order boolean")


class Reader:
    """Reads turns back from segments of one conversation, knowing only texts, flags and the template.

    A template is read by its marks: a turn ends with the last one, and what stands between them is text,
    role or fixed, in the template's order; it must begin and end with a mark, and have one between role and text.
    """

    def __init__(self, template: Template):
        kinds = [k for k, _, _ in template.turn]
        if kinds[0] != "mark" or kinds[-1] != "mark" or any(a != "mark" != b for a, b in zip(kinds, kinds[1:])):
            raise ValueError("a template whose turns can't be read back: marks must stand first, last and between")
        self.template, self.kinds = template, kinds
        self.close = template.controls[-1]
        self.text, self.turns, self.loss_chars, self.chars, self.legal = "", 0, 0, 0, True
        self.all, self.trained = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, loss: bool, legal: bool) -> None:
        self.chars += len(text)
        self.legal = legal
        if loss:
            own = unescape(text)
            self.loss_chars += len(own)
            self.trained.update(own.encode("utf-8", "surrogatepass"))
        self.text += text
        while (end := self.text.find(self.close)) >= 0:
            turn, self.text = self.text[:end], self.text[end + len(self.close) :]
            found = {"role": "", "text": ""}
            for k, (kind, mark, _) in enumerate(self.template.turn[:-1]):
                if kind == "mark":
                    if not turn.startswith(mark):
                        raise ValueError("a turn without one of its marks")
                    turn = turn[len(mark) :]
                else:
                    after = self.template.turn[k + 1][1]
                    stop = turn.find(after) if k + 2 < len(self.template.turn) else len(turn)
                    if stop < 0:
                        raise ValueError("a turn without one of its marks")
                    found[kind], turn = unescape(turn[:stop]), turn[stop:]
            self.all.update(f"{found['role']}\n{found['text']}\n".encode("utf-8", "surrogatepass"))
            self.turns += 1

    def row(self, conv: int) -> tuple:
        if self.text:
            raise ValueError("text after the last closing mark")
        return conv, self.turns, self.all.hexdigest(), self.loss_chars, self.trained.hexdigest(), self.chars, self.legal


def read_back(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation from segments that come sorted, as format_turns() gives them."""

    def run(it):
        conv, own = None, None
        for b in it:
            out = []
            for c, _, text, loss, legal in zip(*(x.to_pylist() for x in b.columns)):
                if c != conv:
                    if own:
                        out.append(own.row(conv))
                    conv, own = c, Reader(template)
                own.add(text, loss, legal)
            yield batch(out)
        if own:
            yield batch([own.row(conv)])

    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid_order"]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*rows)) or [()] * 7, kinds)], names=names)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid_order boolean")


def op7_chat_format(spark, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(format_turns(rows))
