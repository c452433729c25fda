"""Chat formatting: a finite-state machine over roles emits text segments with a loss flag from a declarative template.

`segments` sorts the turns of each conversation within its task and runs over them as a stream: the machine's state is
the role before; a turn that its transitions don't allow is emitted all the same and flagged (`ok` false from there on),
so no text is lost. Memory is bounded by one turn, however long a conversation is. `read_back` runs over the segments in
the same order, again as a stream, and recovers the turns from the formatted text alone.

A template names, for each role, the text before and after a turn and whether the turn's text is learned (loss); a role
it does not know is written with its name. Control strings of the template inside texts and names get a backslash before
them, and backslashes that stand before a control string are doubled, so texts come back unchanged; marks of the
template are never preceded by a backslash.

Defined results: a null text is empty, a null role is the empty role name (unknown to the template); turns are ordered by
(turn, role, text), null turns first, so ties and repeated rows have one order; rows with a null conv_id are a
conversation of their own; an empty table gives no rows; extra columns are not read; a conversation is valid when it
starts with an allowed role and each turn may follow the one before.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENTS = "conv_id long, turn_no long, segment int, kind string, text string, loss boolean, ok boolean"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
          "valid boolean, formatted_sha256 string")


@dataclass(frozen=True)
class Template:
    """before/after: the marks around a turn; loss: roles whose text is learned; follows: allowed successors by state."""

    before: dict[str, str]
    after: dict[str, str]
    loss: frozenset[str]
    follows: dict[str, frozenset[str]]
    controls: tuple[str, ...]
    other_before: str = "[ROLE] {role} [/NAME] "
    other_after: str = " [/ROLE]\n"
    pattern: re.Pattern = field(init=False, repr=False, compare=False, default=None)

    def __post_init__(self):
        names = "|".join(re.escape(c) for c in sorted(self.controls, key=len, reverse=True))
        object.__setattr__(self, "pattern", re.compile(rf"(\\*)({names})"))

    def escape(self, text: str) -> str:
        return self.pattern.sub(lambda m: m[1] * 2 + "\\" + m[2], text)

    def unescape(self, text: str) -> str:
        return self.pattern.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], text)

    def marks(self, role: str) -> tuple[str, str]:
        if role in self.before:
            return self.before[role], self.after[role]
        return self.other_before.format(role=self.escape(role)), self.other_after

    def turn(self, formatted: str) -> tuple[str, str, str, bool]:
        """(role, text, text as written, learned) of one formatted turn."""
        for role, mark in self.before.items():
            end = self.after[role]
            if formatted.startswith(mark) and formatted.endswith(end) and len(formatted) >= len(mark) + len(end):
                inner = formatted[len(mark) : len(formatted) - len(end)]
                return role, self.unescape(inner), inner, role in self.loss
        head, tail = self.other_before.split("{role}")
        for m in self.pattern.finditer(formatted):  # the first unescaped end of the name
            if not m[1] and m[2] == tail.strip():
                role = formatted[len(head) : m.start() - 1]
                inner = formatted[m.end() + 1 : len(formatted) - len(self.other_after)]
                return self.unescape(role), self.unescape(inner), inner, False
        raise ValueError("not a formatted turn")

    def ends(self) -> set[str]:
        """Controls that end a turn."""
        return {x.strip() for x in (*self.after.values(), self.other_after)}


# Marks of an instruction template and the turn order it allows ("" is the start).
INSTRUCT = Template(
    before={"system": "<<SYS>> ", "user": "[INST] ", "assistant": "<s> "},
    after={"system": " <</SYS>>\n", "user": " [/INST]\n", "assistant": " </s>\n"},
    loss=frozenset({"assistant"}),
    follows={"": frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}), "assistant": frozenset({"user"})},
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/NAME]", "[/ROLE]"),
)


def _sorted(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _id(x):
    return None if pd.isna(x) else int(x)


def segments(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Segments in order: conv_id, turn_no, segment (0 before, 1 text, 2 after), kind, text, loss, ok."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, no, ok = (), "", 0, True
        for rows in batches:
            out = []
            for conv, role, text in zip(rows["conv_id"], rows["role"], rows["text"]):
                conv = _id(conv)
                if now != (conv,):
                    now, state, no, ok = (conv,), "", 0, True
                ok = ok and role in template.follows.get(state, frozenset())
                before, after = template.marks(role)
                out += [(conv, no, 0, "before", before, False, ok), (conv, no, 1, "text", template.escape(text), role in template.loss, ok), (conv, no, 2, "after", after, False, ok)]
                state, no = role, no + 1
            made = pd.DataFrame(out, columns=[c.split()[0] for c in SEGMENTS.split(", ")])
            yield made.astype({"conv_id": "Int64"})

    return _sorted(conversations).mapInPandas(run, SEGMENTS)


class _Reader:
    """Turns of one conversation, recovered from its formatted text as it arrives."""

    def __init__(self, template: Template, conv):
        self.t, self.conv, self.buffer, self.ends = template, conv, "", template.ends()
        self.n = self.chars = self.loss_chars = 0
        self.turns, self.loss, self.all = hashlib.sha256(), hashlib.sha256(), hashlib.sha256()
        self.masked, self.ok = "", True

    def take(self, text: str, loss: bool, ok: bool) -> None:
        self.buffer += text
        self.chars += len(text)
        self.all.update(text.encode())
        self.masked += text if loss else ""
        self.ok = self.ok and ok

    def turn(self) -> None:
        """Read the buffered turns: each runs to the first unescaped end mark and its line break.

        What is learned is read from the mask, and must be the texts of the learned roles as they are written.
        """
        start, wanted = 0, ""
        for m in self.t.pattern.finditer(self.buffer):
            if m.start() >= start and not m[1] and m[2] in self.ends and self.buffer[m.end() : m.end() + 1] == "\n":
                role, text, written, learned = self.t.turn(self.buffer[start : m.end() + 1])
                start = m.end() + 1
                self.n += 1
                self.turns.update(f"{role}\n{text}\n".encode())
                wanted += written if learned else ""
        self.buffer = self.buffer[start:]
        if self.masked != wanted:
            self.refuse()
        text, self.masked = self.t.unescape(self.masked), ""
        self.loss_chars += len(text)
        self.loss.update(text.encode())

    def refuse(self) -> None:
        raise ValueError(f"conversation {self.conv}: the formatted text and its loss mask can't be read back")

    def row(self):
        if self.buffer or self.masked:
            self.refuse()
        return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.ok, self.all.hexdigest()


def read_back(made: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Digest of each conversation, read from the formatted text of its segments (in their order within partitions)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in DIGEST.split(", ")]
        reader = None
        for rows in batches:
            done = []
            for conv, segment, text, loss, ok in zip(rows["conv_id"], rows["segment"], rows["text"], rows["loss"], rows["ok"]):
                conv = _id(conv)
                if reader is None or reader.conv != conv:
                    if reader is not None:
                        done.append(reader.row())
                    reader = _Reader(template, conv)
                reader.take(text, loss, ok)
                if segment == 2:
                    reader.turn()
            yield pd.DataFrame(done, columns=columns).astype({"conv_id": "Int64"})
        if reader is not None:
            yield pd.DataFrame([reader.row()], columns=columns).astype({"conv_id": "Int64"})

    return made.mapInPandas(run, DIGEST)


def formatted(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """conv_id, text and loss spans [start, end) of each conversation that fits a row."""
    made = segments(conversations, template)
    rows = made.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn_no", "segment", "text", "loss"))).alias("s"))
    text = F.array_join(F.transform("s", lambda x: x["text"]), "")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))
    spans = F.aggregate("s", start, lambda a, x: F.struct(
        (a["at"] + F.length(x["text"])).alias("at"),
        F.when(x["loss"], F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), (a["at"] + F.length(x["text"])).alias("end"))))).otherwise(a["spans"]).alias("spans")))
    return rows.select("conv_id", text.alias("text"), spans["spans"].alias("loss_spans"))


def report(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    return read_back(segments(conversations, template), template)
