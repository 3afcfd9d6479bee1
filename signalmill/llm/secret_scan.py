r"""Secret scans with one minimal deterministic automaton for all rules.

Each rule is a regular expression over bytes. All rules are compiled together: the
expressions become one nondeterministic automaton, subset construction makes it
deterministic, partition refinement makes it minimal, and bytes that no rule tells apart
share a column of the transition array. Lengths that a rule asks for are counted beside the states and not in them, where
counts of several rules would multiply.

1. One pass over the bytes, from the last to the first, runs the automaton of the reversed rules: at every byte it tells which
   rules have a match that begins there. A byte after which that automaton is in its start state
   whatever came before ends a segment, and all segments of a run of documents step through the array together.
   A stretch of more than ``LONG_SEGMENT`` bytes without such a byte is cut anyhow; its pieces run at once from
   states that are guessed, and those whose guess was wrong run again from what the piece before ended in.
2. From the places where a rule begins, the automaton of the rules as they are is followed to the last byte at which it accepts; a state that leads to
   itself is left by one jump to the next byte that it doesn't take. That gives the leftmost, longest, non-overlapping spans of each rule; those that are
   too short are dropped afterwards.

Null texts are empty and have no spans; a row is returned for every row, repeated ones too, and an empty table gives none. A text of
any length is scanned whole, in time in proportion. Spans are in code points, the end exclusive; spans of different rules may overlap, and those
that begin together are in the rules' order. Extra columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytekernel as K
from .storage import small_batches

SEGMENT_BYTES = 256
LONG_SEGMENT = 2048
#: Bytes that step through the array together, about.
RUN_BYTES = 4 << 20


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds the spans, of which ``group`` must have ``least`` characters.

    The group is 0, the whole span, or the pattern's last part, a repeated class: it begins where the pattern first accepts.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base kinds in their listed order, then the kinds that this scan adds.
RULES = (
    Rule("assign", r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)?", 0, 40),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abpr]-[A-Za-z0-9-]+", 0, 15),
)
BASE_KINDS = ("assign", "access", "hex")


class _Nfa:
    """Built by recursive descent from literals, classes, groups, choices and ``? * +``; a fragment is a pair of states."""

    def __init__(self) -> None:
        self.moves: list[list[tuple[np.ndarray, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def add(self, pattern: str) -> tuple[int, int]:
        self.text, self.at, self.caseless = pattern, 0, False
        out = self._choice()
        if self.at != len(pattern):
            raise ValueError(f"unread pattern: {pattern[self.at :]}")
        return out

    def reversed(self) -> _Nfa:
        out = _Nfa()
        for _ in self.moves:
            out.state()
        for a, (moves, free) in enumerate(zip(self.moves, self.free, strict=True)):
            for allowed, b in moves:
                out.moves[b].append((allowed, a))
            for b in free:
                out.free[b].append(a)
        return out

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _choice(self) -> tuple[int, int]:
        a, z = self.state(), self.state()
        while True:
            s, e = self._sequence()
            self.free[a].append(s)
            self.free[e].append(z)
            if self._peek() != "|":
                return a, z
            self.at += 1

    def _sequence(self) -> tuple[int, int]:
        a = z = self.state()
        while self._peek() not in ("", "|", ")"):
            s, e = self._atom()
            out, mark = self.state(), self._peek()
            self.free[z].append(s)
            self.free[e].append(out)
            if mark in ("?", "*"):
                self.free[z].append(out)
            if mark in ("*", "+"):
                self.free[e].append(s)
            if mark in ("?", "*", "+"):
                self.at += 1
            if self._peek() == "{":
                raise ValueError("counts are for Rule.least")
            z = out
        return a, z

    def _atom(self) -> tuple[int, int]:
        if self._peek() == "(":
            outer, self.at = self.caseless, self.at + 1
            for head, caseless in (("?:", outer), ("?ai:", True)):
                if self.text.startswith(head, self.at):
                    self.at, self.caseless = self.at + len(head), caseless
            out = self._choice()
            self.at, self.caseless = self.at + 1, outer
            return out
        allowed = np.zeros(256, dtype=bool)
        if self._peek() == "[":
            end = self.text.index("]", self.at + 1)
            body, i = self.text[self.at + 1 : end], 0
            self.at = end + 1
            while i < len(body):
                a, i = self._char(body, i)
                b = a
                if body[i : i + 1] == "-" and i + 1 < len(body):
                    b, i = self._char(body, i + 1)
                allowed[a : b + 1] = True
        else:
            code, self.at = self._char(self.text, self.at)
            allowed[code] = True
        if self.caseless:
            for c in np.flatnonzero(allowed):
                allowed[[ord(chr(c).lower()), ord(chr(c).upper())]] = True
        if allowed[128:].any():
            raise ValueError("patterns are of ASCII characters")
        a, z = self.state(), self.state()
        self.moves[a].append((allowed, z))
        return a, z

    @staticmethod
    def _char(s: str, i: int) -> tuple[int, int]:
        if s[i] != "\\":
            return ord(s[i]), i + 1
        if s[i + 1] == "x":
            return int(s[i + 2 : i + 4], 16), i + 4
        return ord(s[i + 1]), i + 2


@dataclass(frozen=True)
class Automaton:
    """Minimal and deterministic; state 0 is the start."""

    classes: np.ndarray  #: byte to column
    table: np.ndarray  #: state * columns + column to state * columns
    columns: int
    accepts: np.ndarray  #: state to bits of the rules that accept there
    resets: np.ndarray  #: byte to whether it leads to the start from everywhere
    dead: int  #: the state * columns that nothing leads out of, -1 if there is none


def _automaton(nfa: _Nfa, starts: list[int], finals: dict[int, int], anywhere: bool) -> Automaton:
    """``anywhere``: a match may begin at every byte; else only at the first."""
    # bytes that every move treats alike share a column
    masks = np.array([m for moves in nfa.moves for m, _ in moves])
    classes = np.unique(masks, axis=1, return_inverse=True)[1].reshape(-1)
    columns = int(classes.max()) + 1
    sample = [int(np.flatnonzero(classes == c)[0]) for c in range(columns)]

    def closure(states: set[int]) -> frozenset[int]:
        todo, out = list(states), set(states)
        while todo:
            for x in nfa.free[todo.pop()]:
                if x not in out:
                    out.add(x)
                    todo.append(x)
        return frozenset(x for x in out if nfa.moves[x] or x in finals)

    start, again = closure(set(starts)), set(starts) if anywhere else set()
    number, queue, rows = {start: 0}, [start], []
    while len(rows) < len(queue):
        row = []
        for byte in sample:
            nxt = closure({t for x in queue[len(rows)] for allowed, t in nfa.moves[x] if allowed[byte]} | again)
            if nxt not in number:
                number[nxt] = len(queue)
                queue.append(nxt)
            row.append(number[nxt])
        rows.append(row)
    table = np.array(rows)
    bits = np.array([sum({finals[x] for x in q if x in finals}) for q in queue])
    # partition refinement: split blocks until all states of a block move to the same blocks
    block = np.unique(bits, return_inverse=True)[1].reshape(-1)
    while True:
        new = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if new.max() == block.max():
            break
        block = new
    order = np.unique(block, return_index=True)[1]
    swap = np.arange(len(order))
    swap[[0, block[0]]] = swap[[block[0], 0]]  # the start is state 0
    block, order = swap[block], order[np.argsort(swap[np.arange(len(order))])]
    small = block[table[order]]
    dead = np.flatnonzero((small == np.arange(len(small))[:, None]).all(axis=1) & (bits[order] == 0))
    return Automaton(classes.astype(np.uint8), (small * columns).astype(np.int32).ravel(), columns, bits[order].astype(np.uint32), (small == 0).all(axis=0)[classes], int(dead[0]) * columns if len(dead) else -1)


@lru_cache(maxsize=4)
def compile_rules(rules: tuple[Rule, ...] = RULES) -> tuple[Automaton, Automaton]:
    """The automaton of the reversed rules, that begin anywhere, and the one of the rules as they are, from their first byte on."""
    if len(rules) > 32:
        raise ValueError("at most 32 rules")
    nfa, ends = _Nfa(), []
    for rule in rules:
        ends.append(nfa.add(rule.pattern))
    backward = _automaton(nfa.reversed(), [e for _, e in ends], {s: 1 << r for r, (s, _) in enumerate(ends)}, True)
    return backward, _automaton(nfa, [s for s, _ in ends], {e: 1 << r for r, (_, e) in enumerate(ends)}, False)


def _run_back(a: Automaton, column: np.ndarray, ends: np.ndarray, sizes: np.ndarray, entry: np.ndarray, marks: np.ndarray | None) -> np.ndarray:
    """The states in which pieces end that are read from their last byte to their first; ``marks`` of every byte get the rules that begin there."""
    share = np.cumsum(sizes) // RUN_BYTES
    if share[-1] > share[0]:  # pieces near each other, so that their bytes stay in the cache
        return np.concatenate([_run_back(a, column, ends[x], sizes[x], entry[x], marks) for x in np.split(np.arange(len(ends)), np.flatnonzero(np.diff(share)) + 1)])
    order = np.argsort(-sizes, kind="stable")
    at, size, state = ends[order] - 1, sizes[order], entry[order].copy()
    accepts = np.repeat(a.accepts, a.columns).astype(marks.dtype) if marks is not None else None  # by scaled state
    live = np.searchsorted(-size, -np.arange(int(size[0])), "left")  # pieces longer than p
    for p, n in enumerate(live.tolist()):
        place = at[:n] - p
        s = a.table[state[:n] + column[place]]
        state[:n] = s
        if marks is not None:
            marks[place] = accepts[s]
    out = np.empty_like(state)
    out[order] = state
    return out


def begin_marks(a: Automaton, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bits of the rules that have a match that begins at each byte; one pass over the bytes of ordinary texts."""
    marks = np.zeros(len(buf), dtype=np.uint8 if len(a.accepts) and int(a.accepts.max()) < 256 else np.uint32)
    if not len(buf):
        return marks
    column = a.classes[buf]
    resets = np.flatnonzero(a.resets[buf])  # a piece that ends before such a byte begins in the start state
    grid = np.arange(SEGMENT_BYTES, len(buf), SEGMENT_BYTES)
    k = np.searchsorted(resets, grid)
    cuts = np.unique(np.r_[0, resets[k[k < len(resets)]], off])
    gaps = np.diff(cuts)
    long = np.flatnonzero(gaps > 2 * LONG_SEGMENT)
    inner = [np.arange(cuts[i] + LONG_SEGMENT, cuts[i + 1] - LONG_SEGMENT // 2, LONG_SEGMENT) for i in long]
    joined = np.concatenate([np.zeros(0, np.int64), *inner])  # cuts over which a state is carried
    cuts = np.unique(np.r_[cuts, joined])
    ends, sizes = cuts[1:], np.diff(cuts)
    entry = np.zeros(len(ends), dtype=np.int32)
    final = _run_back(a, column, ends, sizes, entry, marks)
    if len(joined):
        # from the last piece of a stretch to its first: each must begin in the state that the piece after it in the text ended in
        chained = np.flatnonzero(np.isin(ends, joined))[::-1].tolist()
        known = {(i, 0): int(final[i]) for i in {*chained, *(i + 1 for i in chained)}}
        latest = {i: 0 for i, _ in known}
        while True:
            todo: list[tuple[int, int]] = []
            for i in chained:
                before = (i + 1, int(entry[i + 1]))
                entry[i] = known[before] if before in known else known[i + 1, latest[i + 1]]  # known, or a guess
                if (i, int(entry[i])) not in known:
                    todo.append((i, int(entry[i])))
            if not todo:
                break
            # a state that lasts over many pieces would go on piece by piece, so the first one that is known for sure is tried on all
            run = np.array(sorted({*todo, *((i, todo[0][1]) for i in chained if (i, todo[0][1]) not in known)}), dtype=np.int64)
            got = _run_back(a, column, ends[run[:, 0]], sizes[run[:, 0]], run[:, 1].astype(np.int32), None)
            known.update(zip(map(tuple, run.tolist()), got.tolist(), strict=True))
            latest.update(todo)
        wrong = np.array([i for i in chained if entry[i]], dtype=np.int64)
        if len(wrong):
            _run_back(a, column, ends[wrong], sizes[wrong], entry[wrong], marks)
    return marks


class _Followed:
    """The automaton of the rules as they are over one run of documents."""

    def __init__(self, a: Automaton, buf: np.ndarray):
        self.a, self.column = a, a.classes[buf]
        table = a.table.reshape(-1, a.columns)
        #: of each state, the columns that lead to itself
        self.loops = table == (np.arange(len(table), dtype=np.int32) * a.columns)[:, None]
        if a.dead >= 0:
            self.loops[a.dead // a.columns] = False
        self.looping = self.loops.any(axis=1)
        self.stops: dict[int, np.ndarray] = {}

    def _stop(self, state: int, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The first place from each of ``at`` on whose byte leads out of a state, or the limit."""
        leaves = ~self.loops[state]
        if state not in self.stops and max(4096 * len(at), int((limit - at).sum())) > len(self.column):
            self.stops[state] = np.r_[np.flatnonzero(leaves[self.column]), len(self.column)]
        if state in self.stops:
            return np.minimum(self.stops[state][np.searchsorted(self.stops[state], at)], limit)
        out = limit.copy()
        for k, (p, end) in enumerate(zip(at.tolist(), limit.tolist(), strict=True)):
            width = 64
            while p < end:
                hit = np.flatnonzero(leaves[self.column[p : min(end, p + width)]])
                if len(hit):
                    out[k] = p + hit[0]
                    break
                p, width = p + width, 4 * width
        return out

    def follow(self, starts: np.ndarray, limit: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
        """Of a rule's matches that begin at ``starts``: the shortest's end and the longest's."""
        a, first, last = self.a, np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        lane, at, state = np.arange(len(starts)), starts.copy(), np.zeros(len(starts), np.int32)
        accepts = (a.accepts & bit) > 0
        while len(lane):
            state = a.table[state + self.column[at]]
            go = state != a.dead
            lane, at, state = lane[go], at[go] + 1, state[go]
            number = state // a.columns
            hit = accepts[number]
            first[lane[hit]] = np.where(first[lane[hit]] > 0, first[lane[hit]], at[hit])
            for q in np.flatnonzero((np.bincount(number, minlength=len(self.looping)) > 0) & self.looping).tolist():
                here = number == q
                at[here] = self._stop(q, at[here], limit[lane[here]])
            last[lane[hit]] = at[hit]
            go = at < limit[lane]
            lane, at, state = lane[go], at[go], state[go]
        return first, last

    def spans(self, begins: np.ndarray, off: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, shortest end and end of the leftmost, longest, non-overlapping matches of a rule that has matches from ``begins`` on."""
        limit = off[np.searchsorted(off, begins, "right")]
        heads = np.flatnonzero(np.r_[True, begins[1:] != begins[:-1] + 1] | np.isin(begins, off))
        runs_end = begins[np.r_[heads[1:], len(begins)] - 1] + 1
        starts = begins[heads]
        first, last = self.follow(starts, limit[heads], bit)
        if (last >= runs_end).all() and (last[:-1] <= starts[1:]).all():
            return starts, first, last  # matches from neighbouring places end together, and no match reaches the next one
        ends, out, k = dict(zip(heads.tolist(), zip(first.tolist(), last.tolist()))), [], 0
        while k < len(begins):
            if k not in ends:
                one = self.follow(begins[k : k + 1], limit[k : k + 1], bit)
                ends[k] = int(one[0][0]), int(one[1][0])
            out.append((int(begins[k]), *ends[k]))
            k = max(k + 1, int(np.searchsorted(begins, ends[k][1])))
        return tuple(np.array(c, dtype=np.int64) for c in zip(*out, strict=True))


def find_spans(buf: np.ndarray, off: np.ndarray, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int, int]]:
    """(document, start, end, rule) of every span, in code points of the document, by start, then rule."""
    backward, forward = compile_rules(rules)
    marks, followed, out = begin_marks(backward, buf, off), None, []
    inner = np.flatnonzero((buf & 0xC0) == 0x80)  # bytes that begin no code point
    for r, rule in enumerate(rules):
        begins = np.flatnonzero(marks & (1 << r))
        if not len(begins):
            continue
        followed = followed or _Followed(forward, buf)
        start, first, end = followed.spans(begins, off, 1 << r)
        long = (end - (first - 1 if rule.group else start)) >= rule.least
        start, end = start[long], end[long]
        doc = np.searchsorted(off, start, "right") - 1
        base = off[doc] - np.searchsorted(inner, off[doc])
        out += zip(doc.tolist(), (start - np.searchsorted(inner, start) - base).tolist(), (end - np.searchsorted(inner, end) - base).tolist(), [r] * len(doc), strict=True)
    return sorted(out, key=lambda x: (x[0], x[1], x[3]))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans, an array of (kind, start, end) by start, then by the rules' order."""
    kinds = [r.kind for r in rules]
    compile_rules(rules)  # a pattern that can't be read fails here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            buf, off = K.text_buffer(b.column(1))
            found: list[list[dict]] = [[] for _ in range(len(off) - 1)]
            for i, j in K.chunks(off, 4 << 20):
                for doc, s, e, r in find_spans(buf[off[i] : off[j]], off[i : j + 1] - off[i], rules):
                    found[i + doc].append({"kind": kinds[r], "start": s, "end": e})
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    slim = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def span_digest(spans: DataFrame) -> DataFrame:
    """Counts and digests of the spans of ``scan``."""

    def joined(c):
        return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def of(kind: str):
        return F.filter("spans", lambda x: x["kind"] == kind)

    return spans.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(joined(F.filter("spans", lambda x: x["kind"].isin(*BASE_KINDS))), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
