r"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn. The grammar is LL(1): a turn is opened by a control
string of its own and closed by the first unescaped control string after its text.

    system     <<SYS>>\n TEXT \n<</SYS>>\n
    user       [INST]_TEXT_[/INST]          (_ is a space)
    assistant  <s>_TEXT_</s>
    other      <<ROLE>> NAME \n<<TEXT>>\n TEXT \n<</ROLE>>\n

A backslash before a backslash or before the first character of a control string makes that
character ordinary; any other backslash stands for itself. Each turn is first rendered as it
is and parsed again. Where the parser doesn't give back the source, the conflicting content is
escaped, and the turn is rendered and parsed again until both are the same.

A parsed turn ends where its closing string ends, so turns can be rendered, parsed and
digested one after another: rows are sorted by conversation and turn, and a conversation of
any length passes in constant memory. Rows that come in another order, as from a table that was written and read again, are
noticed and refused; ``read_back`` sorts them if told so.

Null texts and roles are empty strings; a null turn comes first, and rows without conv_id are one conversation. Rows with equal
turn go by role, then text, and repeated rows are turns of their own. An empty table gives no rows. A very long text is one value of a row. Extra columns take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import shuffle_width

#: The control strings.
CONTROL = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<<TEXT>>", "<</ROLE>>")
_OPEN = {"system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>")}
_ANY = "|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True)))
_TOKEN = re.compile(r"\\[\\<\[]|" + _ANY)
_BACKSLASH = re.compile(r"\\(?=[\\<\[])")
_AHEAD = re.compile("(?=" + _ANY + ")")


def escape(text: str) -> str:
    """A backslash goes before each control string and each backslash that would make something ordinary."""
    return _AHEAD.sub(r"\\", _BACKSLASH.sub(r"\\\\", text))


class GrammarError(ValueError):
    """The rendered text isn't in the grammar."""


def _content(s: str, at: int, close: str) -> tuple[str, str, int]:
    """Raw text and unescaped text from ``at`` up to ``close``, and the place after it."""
    plain, i = [], at
    mark = close.strip("\n ")
    while m := _TOKEN.search(s, i):
        if m[0][0] == "\\":
            plain += [s[i : m.start()], m[0][1]]
            i = m.end()
            continue
        begin = m.start() - close.index(mark)
        if m[0] != mark or begin < i or s[begin : begin + len(close)] != close:
            break
        plain.append(s[i:begin])
        return s[at:begin], "".join(plain), begin + len(close)
    raise GrammarError(f"no {close!r} after {at}")


def parse_turn(s: str, at: int = 0) -> tuple[str, str, int]:
    """Role and text of the turn that begins at ``at``, and the place after it."""
    for role, (head, tail) in _OPEN.items():
        if s.startswith(head, at):
            _, text, end = _content(s, at + len(head), tail)
            return role, text, end
    if not s.startswith("<<ROLE>>", at):
        raise GrammarError(f"no turn at {at}")
    _, role, middle = _content(s, at + len("<<ROLE>>"), "\n<<TEXT>>\n")
    _, text, end = _content(s, middle, "\n<</ROLE>>\n")
    return role, text, end


def parse(s: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(s):
        role, text, at = parse_turn(s, at)
        out.append((role, text))
    return out


def _render(role: str, text: str) -> str:
    if role in _OPEN:
        head, tail = _OPEN[role]
        return f"{head}{text}{tail}"
    return f"<<ROLE>>{role}\n<<TEXT>>\n{text}\n<</ROLE>>\n"


def render_turn(role: str, text: str) -> str:
    """The rendered turn; what conflicts is escaped until the parser gives back the source."""
    for r, t in ((role, text), (role, escape(text)), (role if role in _OPEN else escape(role), escape(text))):
        out = _render(r, t)
        try:
            if parse_turn(out) == (role, text, len(out)):
                return out
        except GrammarError:
            continue
    raise GrammarError("the escaped turn doesn't parse")


def _ordered(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.repartition(shuffle_width(conversations.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, seq (from 0), rendered text and loss spans (start, end) in it, a row a turn; joined by seq they are the conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seq = object(), 0
        for b in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for conv, role, text in zip(*(b.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                seq = seq + 1 if conv == last else 0
                last, s = conv, render_turn(role, text)
                head, tail = _OPEN["assistant"]
                loss = (len(head), len(s) - len(tail)) if role == "assistant" else (0, 0)
                for column, value in zip(out, (conv, seq, s, loss), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array([x for x, _ in out[3]], pa.int64()), pa.array([x for _, x in out[3]], pa.int64())],
                names=["conv_id", "seq", "formatted", "loss_start", "loss_end"],
            )

    return _ordered(conversations).mapInArrow(run, "conv_id long, seq long, formatted string, loss_start long, loss_end long")


class _Digest:
    """What is read back from one formatted conversation."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, formatted: str, mask: tuple[int, int]) -> None:
        role, text, end = parse_turn(formatted)
        if end != len(formatted):
            raise GrammarError("more than a turn")
        self.turns, self.chars = self.turns + 1, self.chars + len(formatted)
        self.all.update(f"{role}\n{text}\n".encode())
        if mask[1] > mask[0]:
            masked = parse_turn(_render("assistant", formatted[mask[0] : mask[1]]))[1]
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


class OrderError(ValueError):
    """The rows don't come by conversation and seq."""


def read_back(formatted: DataFrame, sort: bool = False) -> DataFrame:
    """A digest of each conversation, parsed from the rows of ``format_turns`` as they come, or dealt and sorted by conversation and seq."""
    if sort:
        formatted = formatted.repartition(shuffle_width(formatted.sparkSession), "conv_id").sortWithinPartitions("conv_id", "seq")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        for b in batches:
            done = []
            for conv, seq, s, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if seq == 0:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                if now is None or (conv, seq) != (now.conv, now.turns):
                    raise OrderError(f"turn {seq} of conversation {conv} is out of its place")
                now.read(s, (x, y))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(types)], names=names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(now.row(), types, strict=True)], names=names)

    return formatted.select("conv_id", "seq", "formatted", "loss_start", "loss_end").mapInArrow(run, schema)
