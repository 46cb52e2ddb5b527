"""Chat formatting with a grammar round trip (operator 5).

Template: each turn is ``### <Role>: <text>`` + newline + ``</turn>`` + newline. Rendered text is reparsed by a
deterministic parser; while the recovered turns differ from the source, the turns that differ are escaped one step
further: first the conflicting control strings of the text, then those of the role. Escaping puts one more backslash
before every control string of a text (with any backslashes already before it), so it is undone exactly; a control
string counts as one only without a backslash before it. In a role every special character is escaped.

Turns are sorted within a conversation and streamed, so a conversation of any length passes through a task turn by
turn; only hash states and counters are held.

Defined results: null texts and roles are empty ones; empty texts give empty turns; repeated rows are turns each, equal
turn numbers ordered by role, then text; a null conversation id is a conversation of its own; an empty table gives no
rows; columns besides the four are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: The template's control strings.
HEAD, MIDDLE, END = "### ", ": ", "\n</turn>\n"
CONTROL = re.compile(r"(\\*)(### |</turn>)")


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][1:] if m[1] else m[0], text)


def escape_role(role: str) -> str:
    """A backslash before each character that could end the role or start a control string."""
    return re.sub(r"([\\:#<\n])", r"\\\1", role)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", r"\1", role, flags=re.DOTALL)


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """The turns of a rendered text as (role, text, from, to), the span being that of the escaped text.

    Raises ValueError where the text does not follow the grammar.
    """
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(HEAD, at):
            raise ValueError(f"no turn starts at {at}")
        name = at + len(HEAD)
        colon = _bare(rendered, MIDDLE, name)
        start = colon + len(MIDDLE)
        end = rendered.find(END, start - 1)
        if end < start:
            raise ValueError(f"no end of the turn that starts at {at}")
        stray = next((m for m in CONTROL.finditer(rendered, start, end) if not m[1]), None)
        if stray:
            raise ValueError(f"a control string stands in a text at {stray.start()}")
        turns.append((unescape_role(rendered[name:colon]), unescape(rendered[start:end]), start, end))
        at = end + len(END)
    return turns


def _bare(text: str, mark: str, at: int) -> int:
    """The first place of ``mark`` that no backslash escapes."""
    first = at
    while True:
        at = text.find(mark, at)
        if at < 0:
            raise ValueError("a turn has no text")
        before = text[first:at]
        if (len(before) - len(before.rstrip("\\"))) % 2 == 0:
            return at
        at += 1


#: The steps of escaping, as (role escaped, text escaped).
STEPS = ((False, False), (False, True), (True, True))


def written_turn(role: str, text: str, step: int) -> str:
    roles, texts = STEPS[step]
    return f"{HEAD}{escape_role(role) if roles else role}{MIDDLE}{escape(text) if texts else text}{END}"


def escape_step(role: str, text: str) -> tuple[int, int, int]:
    """(step, from, to): the least escaping with which the turn is read back, and its text's span."""
    for step in range(len(STEPS)):
        try:
            found = parse(written_turn(role, text, step))
        except ValueError:
            continue
        if len(found) == 1 and found[0][:2] == (role, text):
            return step, found[0][2], found[0][3]
    raise AssertionError("a turn cannot be written so that it is read back")


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """(rendered, from, to): the turn as text, escaped as little as reparsing it needs, and its text's span."""
    step, start, end = escape_step(role, text)
    return written_turn(role, text, step), start, end


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, rendered, trained): each turn as its piece of the conversation's text, in order within each
    partition; ``trained`` marks the turns whose text is under the loss mask (the assistant's).

    The reparsing that finds a turn's escaping is done where the turn is read; only its step goes with it."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "conv_id long, turn long, role string, text string"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            steps = [escape_step(r, t)[0] for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist(),
                                                          strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(steps, pa.int32())], [*b.schema.names, "step"])

    judged = rows.mapInArrow(judge, f"{schema}, step int")
    ordered = judged.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            done = [written_turn(r, t, s) for r, t, s in zip(f["role"], f["text"], f["step"], strict=True)]
            yield pd.DataFrame({"conv_id": f["conv_id"], "turn": f["turn"], "rendered": done,
                                "trained": f["role"] == "assistant"})

    return ordered.mapInPandas(run, "conv_id long, turn long, rendered string, trained boolean")


def read_back(formatted: DataFrame) -> DataFrame:
    """Reparses formatted turns (kept in the order of ``format_turns``) to one row of digests per conversation."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, None

        def row():
            return [key, state["n"], state["turns"].hexdigest(), state["loss_n"], state["loss"].hexdigest(),
                    state["chars"]]

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for f in frames:
            out = []
            ids = [None if pd.isna(k) else int(k) for k in f["conv_id"]]
            for k, rendered, trained in zip(ids, f["rendered"], f["trained"], strict=True):
                if state is None or k != key:
                    if state is not None:
                        out.append(row())
                    key = k
                    state = {"n": 0, "turns": hashlib.sha256(), "loss_n": 0, "loss": hashlib.sha256(), "chars": 0}
                for role, text, start, end in parse(rendered):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{text}\n".encode())
                    if trained:
                        masked = unescape(rendered[start:end])
                        state["loss_n"] += len(masked)
                        state["loss"].update(masked.encode())
                state["chars"] += len(rendered)
            yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})
        if state is not None:
            yield pd.DataFrame([row()], columns=names).astype({"conv_id": "Int64"})

    return formatted.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")
