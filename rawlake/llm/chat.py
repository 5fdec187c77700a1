"""Conversations as training windows with a loss mask, and back.

A window holds the conversation's system turn, a little repeated history and as
many whole new turns as the budget allows. Turns are streamed in order, so that a
conversation of any length takes the memory of one window.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlake.llm.common import prepare

BUDGET = 2048  # tokens of a window, unless one turn is longer
HISTORY = 256  # tokens of repeated turns

# Marks of the template, and beginnings of control strings that
# texts must not hold unescaped: those of this template and of other usual ones.
START, END = "<|im_start|>", "<|im_end|>\n"
_CONTROL = r"(?=\||/?s>|/?INST\]|</?SYS>>)"
_PLAIN = re.compile(r"([<\[]\\*)" + _CONTROL)
_ESCAPED = re.compile(r"([<\[]\\*)\\" + _CONTROL)


def escape(text: str) -> str:
    """Put one more backslash behind the first sign of each control string."""
    return _PLAIN.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _role_out(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def tokens(text: str) -> int:
    """Tokens a turn is counted as: a quarter of its bytes, and four for its marks."""
    return len(text.encode()) // 4 + 4


def format_windows(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    budget: int = BUDGET, history: int = HISTORY,
) -> DataFrame:
    """Windows of every conversation, in order.

    ``conv_id``, ``window`` (from 0), ``text``, ``n_repeated`` (leading turns that
    an earlier window has had) and ``targets`` (start and end of text under the
    loss, code points in ``text``). Running sums of tokens choose the spans: a
    window ends before the turn that would exceed ``budget``, and a longer turn has
    a window without history. A first turn of the role system leads every window;
    history is the latest turns that fit in ``history`` tokens. Targets are the
    texts of new assistant turns, so each is learned once. Turns are in the order
    of turn, role and text (nulls first), so ties and repeated rows are defined and
    kept; null roles and texts are empty; null conversations are one conversation.
    Other columns are not read.
    """
    prepare(turns.sparkSession)
    conv_type = turns.schema[conv_col].dataType.simpleString()
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").drop("turn")
    out = f"{conv_col} {conv_type}, window int, text string, n_repeated int, targets array<struct<start:int,end:int>>"
    return ordered.mapInArrow(_windows(conv_col, budget, history), out)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _windows(conv_col: str, budget: int, history: int):
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def emit(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
        conv, number, text, repeated, targets = zip(*rows)
        columns = [pa.array(conv, conv_type), pa.array(number, pa.int32()), pa.array(text), pa.array(repeated, pa.int32())]
        targets = pa.array([[{"start": a, "end": b} for a, b in t] for t in targets], spans)
        return pa.RecordBatch.from_arrays([*columns, targets], [conv_col, "window", "text", "n_repeated", "targets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list[pa.DataType] = []

        def typed():
            for batch in batches:
                kind[:] = [batch.schema.field(0).type]
                yield batch

        held, size = [], 0
        for conv, own in groupby(_stream(typed()), key=lambda r: r[0]):
            for number, window in enumerate(cut(((r or "", t or "") for _, r, t in own), budget, history)):
                held.append((conv, number, *render(*window)))
                size += len(held[-1][2])
                if size > 4 << 20:
                    yield emit(held, kind[0])
                    held, size = [], 0
        if held:
            yield emit(held, kind[0])

    return run


def cut(turns: Iterator[tuple[str, str]], budget: int, history: int) -> Iterator[tuple[list, list]]:
    """(repeated turns, new turns) of each window."""
    system: list[tuple[str, str]] = []
    lead: list[tuple[str, str]] = []
    new: list[tuple[str, str]] = []
    recent: deque = deque()
    recent_sum = lead_sum = new_sum = system_sum = 0
    for k, turn in enumerate(turns):
        own = tokens(turn[1])
        if new and lead_sum + new_sum + own > budget:
            yield lead, new
            keep = recent_sum + system_sum + own <= budget
            lead = system + [t for t, _ in recent] if keep else list(system)
            lead_sum, new, new_sum = system_sum + recent_sum * keep, [], 0
        new.append(turn)
        new_sum += own
        if k == 0 and turn[0] == "system":
            system, system_sum = [turn], own
            continue
        recent.append((turn, own))
        recent_sum += own
        while recent_sum > history:
            recent_sum -= recent.popleft()[1]
    if new:
        yield lead, new


def render(lead: list, new: list) -> tuple[str, int, list[tuple[int, int]]]:
    parts, at, targets = [], 0, []
    for k, (role, text) in enumerate([*lead, *new]):
        head, body = f"{START}{_role_out(role)}\n", escape(text)
        if k >= len(lead) and role == "assistant":
            targets.append((at + len(head), at + len(head) + len(body)))
        parts.append(head + body + END)
        at += len(parts[-1])
    return "".join(parts), len(lead), targets


def parse(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a window's turns."""
    turns = (t.removeprefix(START).partition("\n") for t in text.split(END)[:-1])
    return [(_role_in(role), unescape(body)) for role, _, body in turns]


def read_back(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What the windows of each conversation hold, repeated turns left out.

    One row per conversation: ``n_turns``, ``turns_sha256`` (role, line feed, text,
    line feed of each turn), ``loss_chars``, ``loss_sha256`` (text under the loss)
    and ``formatted_chars`` (all windows).
    """
    prepare(windows.sparkSession)
    conv_type = windows.schema[conv_col].dataType.simpleString()
    rows = windows.select(F.col(conv_col).alias("conv"), "window", "text", "n_repeated", "targets")
    ordered = rows.repartition("conv").sortWithinPartitions("conv", "window").drop("window")
    names = [conv_col, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list[pa.DataType] = []

        def typed():
            for batch in batches:
                kind[:] = [batch.schema.field(0).type]
                yield batch

        out = []
        for conv, own in groupby(_stream(typed()), key=lambda r: r[0]):
            turns, loss, n_turns, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for _, text, repeated, targets in own:
                for role, body in parse(text)[repeated:]:
                    turns.update(f"{role}\n{body}\n".encode())
                    n_turns += 1
                for t in targets:
                    learned = unescape(text[t["start"] : t["end"]])
                    loss.update(learned.encode())
                    loss_chars += len(learned)
                chars += len(text)
            out.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        if out:
            types = [kind[0], pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return ordered.mapInArrow(run, f"{conv_col} {conv_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
