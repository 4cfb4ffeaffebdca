"""Chat formatting in budgeted windows with a loss mask.

A conversation's turns are marked by a template; control strings that a text holds itself are
escaped, reversibly. Windows hold spans of whole turns: with prefix sums of the turns' tokens, a
span ends before the turn that would exceed the budget. Every window but the first repeats the
system turn and the last turns before its span, as far as their tokens fit the history
limit. Of several opening system turns the first ones are retained that fill half the budget at
most; one that is larger by itself is, where it and the span's first turn fit. So no window exceeds
the budget but those of one turn that does. The loss mask covers the assistant texts of a
span, never those of its history, so each assistant text is learned from once.

Tasks with even shares of all turns count tokens first, and read windows back; what follows the order of a
conversation is only the cut into windows and the running digests: turns reach a task sorted by
conversation, and only one window's turns are kept at a time.

Defined cases: null text or role is empty; a null conversation is one of its own; turns are ordered
by turn (null first), then role, then text, and rows that repeat a turn are turns of their own; a
turn over the budget is a window of its own, whole; no rows give no windows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from folio.llm.token_files import WholeTexts

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# Strings that templates of public chat models give a meaning
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(re.escape(OPEN) + r"((?:\\.|[^\\\n])*)\n(.*?)" + re.escape(CLOSE), re.S)
MARK_TOKENS = 8  # what the template adds to a turn
WINDOWS = "conv_id {kind}, window int, n_repeated int, n_tokens long, text string, loss_starts array<int>, loss_ends array<int>"


def escape(text: str) -> str:
    """Double every backslash, then put one after the first character of each control string."""
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn_text(role: str, text: str) -> tuple[str, int]:
    """A marked turn, and where its text begins in it."""
    head = OPEN + escape(role).replace("\n", "\\\n") + "\n"
    return head + escape(text) + CLOSE, len(head)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted window."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def windows(turns: Iterator[tuple[str, str, int]], budget: int, history: int) -> Iterator[dict]:
    """Windows of one conversation from its (role, text, tokens)."""
    system: list = []       # the turns that open the conversation as system turns and are retained
    past: list = []         # last turns of earlier windows, within the history limit
    span: list = []
    before: list = []       # what the open window repeats
    opening, used, retained, number = True, 0, 0, 0

    def repeated(first) -> list:
        """What a window that begins with ``first`` repeats: the system turn and the last turns of
        ``past``, as far as they fit beside it."""
        kept = system if retained + first[2] <= budget else []
        limit = min(history, budget - sum(t[2] for t in kept) - first[2])
        sums = list(accumulate(t[2] for t in reversed(past)))
        fit = sum(s <= limit for s in sums)
        return [*kept, *(past[len(past) - fit:] if fit else [])]

    def emit() -> dict:
        nonlocal number, past
        parts, starts, ends, at = [], [], [], 0
        for i, (role, body, _) in enumerate([*before, *span]):
            marked, head = turn_text(role, body)
            if i >= len(before) and role == "assistant":
                starts.append(at + head)
                ends.append(at + len(marked) - len(CLOSE))
            parts.append(marked)
            at += len(marked)
        out = {"window": number, "n_repeated": len(before), "n_tokens": used, "text": "".join(parts), "loss_starts": starts, "loss_ends": ends}
        number += 1
        kept, total = [], 0
        for t in reversed([*past, *span]):  # no more than can ever be repeated
            total += t[2]
            if total > history:
                break
            kept.append(t)
        past = [t for t in kept[::-1] if not any(t is s for s in system)]
        return out

    for turn in turns:
        opening = opening and turn[0] == "system"
        if opening and (not system or retained + turn[2] <= budget // 2) and retained <= budget // 2:
            system.append(turn)
            retained += turn[2]
        elif opening:
            opening = False  # later system turns are turns like others
        if span and used + turn[2] > budget:
            yield emit()
            span = []
        if not span:
            before = repeated(turn) if number else []
            used = sum(t[2] for t in before)
        span.append(turn)
        used += turn[2]
    if span:
        yield emit()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _count_task(tokenizer: str):
    """Tokens of every turn, the template's included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = WholeTexts(tokenizer, 0)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = batch.slice(lo, 512)
                tokens = count.encode(rows.column(3))[1] - 1 + MARK_TOKENS
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(tokens, pa.int64())], names=[*rows.schema.names, "tokens"])

    return run


def _format_task(budget: int, history: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted() -> Iterator[tuple]:
            for conv, role, text, tokens in _rows(batches):
                yield conv, (role or "", text or "", tokens)

        out: list[dict] = []
        size = 0
        rows = counted()
        ahead = next(rows, None)
        while ahead is not None:
            conv = ahead[0]

            def of_one() -> Iterator[tuple]:
                nonlocal ahead
                while ahead is not None and ahead[0] == conv:
                    yield ahead[1]
                    ahead = next(rows, None)

            for w in windows(of_one(), budget, history):
                out.append({"conv_id": conv, **w})
                size += len(w["text"])
                if size > 4_000_000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def format_conversations(turns: DataFrame, tokenizer: str, budget: int = 1024, history: int = 256, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """Windows (conv_id, window, n_repeated, n_tokens, text, loss_starts, loss_ends) of all conversations;
    the spans of the loss mask count code points. ``tokenizer``: a tokenizers file that every worker can open."""
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    kind, turn_kind = rows.schema["conv_id"].dataType, rows.schema["turn"].dataType
    counted = rows.mapInArrow(_count_task(tokenizer), f"conv_id {kind.simpleString()}, turn {turn_kind.simpleString()}, role string, text string, tokens long")
    ordered = counted.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text").select("conv_id", "role", "text", "tokens")
    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("window", pa.int32()), ("n_repeated", pa.int32()), ("n_tokens", pa.int64()), ("text", pa.string()),
                        ("loss_starts", pa.list_(pa.int32())), ("loss_ends", pa.list_(pa.int32()))])
    return ordered.mapInArrow(_format_task(budget, history, schema), WINDOWS.format(kind=kind.simpleString()))


def _parse_task(schema: pa.Schema):
    """What each window adds: its own turns, and the texts under its loss mask."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                out = []
                for conv, window, repeated, text, starts, ends in _rows(iter([batch.slice(lo, 1024)])):
                    turns = parse(text)[repeated:]
                    out.append({"conv_id": conv, "window": window, "n_turns": len(turns), "turns": "".join(f"{role}\n{body}\n" for role, body in turns),
                                "loss": "".join(unescape(text[s:e]) for s, e in zip(starts, ends)), "chars": len(text)})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _digest_task(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        own = None
        for conv, n_turns, turns, loss, chars in _rows(batches):
            if own is None or own["conv_id"] != conv:
                if own is not None:
                    out.append(own)
                if len(out) >= 2000:
                    yield _finished(out, schema)
                    out = []
                own = {"conv_id": conv, "n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "formatted_chars": 0, "n_windows": 0}
            own["n_turns"] += n_turns
            own["turns"].update(turns.encode())
            own["loss_chars"] += len(loss)
            own["loss"].update(loss.encode())
            own["formatted_chars"] += chars
            own["n_windows"] += 1
        if own is not None:
            out.append(own)
        if out:
            yield _finished(out, schema)

    return run


def _finished(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"conv_id": r["conv_id"], "n_turns": r["n_turns"], "turns_sha256": r["turns"].hexdigest(), "loss_chars": r["loss_chars"],
                                        "loss_sha256": r["loss"].hexdigest(), "formatted_chars": r["formatted_chars"], "n_windows": r["n_windows"]} for r in rows], schema=schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the windows hold of each conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars, n_windows."""
    kind = formatted.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                        ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])
    parsed = pa.schema([("conv_id", to_arrow_type(kind)), ("window", pa.int32()), ("n_turns", pa.int64()), ("turns", pa.string()), ("loss", pa.string()), ("chars", pa.int64())])
    own = formatted.select("conv_id", "window", "n_repeated", "text", "loss_starts", "loss_ends").mapInArrow(
        _parse_task(parsed), f"conv_id {kind.simpleString()}, window int, n_turns long, turns string, loss string, chars long")
    ordered = own.repartition("conv_id").sortWithinPartitions("conv_id", "window").select("conv_id", "n_turns", "turns", "loss", "chars")
    return ordered.mapInArrow(_digest_task(schema), f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long")
