r"""Repair of conversations whose turns are blank, doubled, cut off or out of turn, by the cheapest edits.

The roles' initials of a repaired conversation match ``(s?(ua)+)?``. Keep costs 0, Rerole (to user or assistant) 2, Delete 3, Insert (a turn of
user or assistant without text, anywhere) 2, and a truncated turn that isn't deleted 1 more. Blank and doubled turns have to be deleted. Of equally cheap repairs
the one stays whose audit, the edits' initials in order, comes first in ASCII. The pattern leaves one role to insert or to reassign
at every place, so an audit says the whole repair.

Ranks in place of strings. A turn's macro edit is a run of inserts and then K, R or D; the nine codes of up to two inserts (three never pay: two
inserts lead back to the same place) are prefix-free, so audits of as many macro edits are never prefixes of each other. Then the order of two audits is that of
their first parts, and of their last codes where these agree: a layer needs only the rank of each state's best audit among the layer's, its cost and its
parent, and no string. States too dear to be on a cheapest way are left out; costs less their least and ranks then take few different values, and a layer's step
is looked up once it has been worked out.

1. Turns without their texts get a place in the order (range exchange and sort), written so that it stays.
2. A turn's role and text are known by digest; the least place of each digest in its conversation is the one that isn't doubled (partial aggregates).
3. Turns become a letter each, segments of up to SEGMENT turns a string. For each state in which it may be entered, a segment gives cost and rank
   of each state in which it may be left. That is a product of matrices, so segments are worked on wherever they are, whatever conversation they belong to.
4. The segments' tables (some hundred bytes each) of a conversation are folded, and the best way is followed back. An audit has a letter a turn at least
   and is a value of a row, which is below 2 GB; so a conversation has at most half a million segments.
5. Each segment writes its piece of the audit; pieces are joined by place.
6. Texts are dealt by conversation once, sorted, and meet their audit in front of them as a row of its own; they pass in constant memory. A conversation's digest takes them
   one after another, so this last step follows one conversation in one task, however long it is.

Turns go by turn number (nulls first), role, then digest of the text; repeated rows are turns of their own, doubled ones. Null roles and texts are one space; rows
without conv_id are one conversation. Conversations that lose all rows have zeros, an empty audit and the digest of an empty string. An empty table gives no rows. A very long text is one value of a
row. Extra columns take no part and may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .packing import lean_batches
from .storage import materialise, shuffle_width, small_batches

#: Turns of a segment at most, a power of two.
SEGMENT = 4096
#: Damages by kind, out of so many.
DAMAGES = 20
WHITE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

# States: before the first turn, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What an inserted or reassigned turn leads to.
FORCED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Inserts that end a conversation.
CLOSING = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
CODES = sorted("I" * k + edit for k in range(3) for edit in "KRD")
#: A turn's letter: its role's initial (x for others) as it is when sound, in upper case when truncated, and the number below it when it has to go.
INITIALS, GONE = "suax", "1234"
#: What is left to pay differs by this much at most between two states: up to two inserts lead to a user's or assistant's state (4); from before the first turn one
#: can only save to delete a system turn (3), with an insert before it (2). A state that has cost more than this above the least is on no cheapest way.
REACH = 5


def _key(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text; null roles and texts are one space."""
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _key("role").alias("role"), _key("text").alias("text"))


def damage(conversations: DataFrame) -> DataFrame:
    """``turns`` after damage: by crc32 of ``conv_id:turn`` modulo 20, 0 drops a row, 1 empties its text, 2 takes ``[.!?]`` out of it, 3 repeats the row and 4 makes it the user's."""
    kind = F.crc32(F.concat_ws(":", _key("conv_id"), _key("turn")).cast("binary")) % DAMAGES
    rows = turns(conversations).withColumn("kind", kind).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    twice = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), twice.alias("copy")).drop("copy")


def _digest() -> Column:
    """Of role and text; the role as digest, so that no two pairs are written alike."""
    return F.unhex(F.sha2(F.concat(F.sha2("role", 256), F.col("text")), 256))


def _placed(rows: DataFrame) -> DataFrame:
    """conv_id, turn, initial, blank, ended, digest and place of every turn, without its text. Places order the turns of a conversation."""
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    initial = F.when(F.substring("role", 1, 1).isin(*"sua"), F.substring("role", 1, 1)).otherwise("x")
    slim = rows.select(
        "conv_id", "turn", "role", _digest().alias("digest"), initial.alias("initial"), (body == "").alias("blank"), F.substring(body, -1, 1).isin(*".!?").alias("ended"),
        F.monotonically_increasing_id().alias("apart"),
    )
    order = ("conv_id", "turn", "role", "digest", "apart")
    dealt = slim.repartitionByRange(shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)
    return materialise(dealt.select("conv_id", "turn", "initial", "blank", "ended", "digest", F.monotonically_increasing_id().alias("place")), "turns-placed")


def faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, initial, fault (blank, duplicate, truncated or null; the first that holds) and place of every turn."""
    placed = _placed(rows)
    firsts = placed.groupBy("conv_id", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("ended"), "truncated")
    return placed.join(firsts, "place", "left").select("conv_id", "turn", "initial", fault.alias("fault"), "place")


# layers

Vector = tuple[tuple[int, int] | None, ...]


@cache
def _macros(letter: str) -> dict[int, list[tuple[int, int, int]]]:
    """Of a turn's letter, by state: code, cost and next state of each macro edit."""
    must_go, truncated = letter in GONE, letter.isupper()
    out: dict[int, list[tuple[int, int, int]]] = {}
    for state in range(4):
        at, out[state] = state, []
        for inserts in range(3):
            base, more = INSERT * inserts, TRUNCATED * truncated
            ends = {"D": (base + DELETE, at)}
            if not must_go:
                ends["R"] = (base + REROLE + more, FORCED[at])
                if (at, letter.lower()) in KEPT:
                    ends["K"] = (base + KEEP + more, KEPT[at, letter.lower()])
            out[state] += [(CODES.index("I" * inserts + edit), cost, end) for edit, (cost, end) in ends.items()]
            at = FORCED[at]
    return out


def _ranked(best: dict[int, tuple[int, tuple, int]]) -> tuple[Vector, int, tuple]:
    """Of each state's (cost, order, parent): costs less the least with ranks, the least cost, and parents."""
    least = min(cost for cost, _, _ in best.values())
    best = {s: x for s, x in best.items() if x[0] <= least + REACH}
    ranks = {order: k for k, order in enumerate(sorted({order for _, order, _ in best.values()}))}
    vector = tuple((best[s][0] - least, ranks[best[s][1]]) if s in best else None for s in range(4))
    return vector, least, tuple(best[s][2] if s in best else None for s in range(4))


@cache
def step(vector: Vector, letter: str) -> tuple[Vector, int, tuple]:
    """The next layer: (cost above the least, rank) of each state, what the least cost grew by, and each state's (state before, code)."""
    best: dict[int, tuple[int, tuple, int]] = {}
    for state, entry in enumerate(vector):
        if entry is None:
            continue
        for code, cost, end in _macros(letter)[state]:
            new = (entry[0] + cost, (entry[1], code), (state, code))
            if end not in best or new[:2] < best[end][:2]:
                best[end] = new
    return _ranked(best)


def _entered(state: int) -> Vector:
    return tuple((0, 0) if s == state else None for s in range(4))


def segment_table(letters: str) -> tuple[list[int | None], list[int | None]]:
    """Costs and ranks of a segment, for every state in which it is entered and left."""
    costs: list[int | None] = []
    ranks: list[int | None] = []
    for state in range(4):
        vector, total = _entered(state), 0
        for letter in letters:
            vector, more, _ = step(vector, letter)
            total += more
        costs += [None if e is None else e[0] + total for e in vector]
        ranks += [None if e is None else e[1] for e in vector]
    return costs, ranks


def fold(tables: list[tuple[list, list]]) -> tuple[int, list[tuple[int, int]]]:
    """The least cost of a conversation's segments one after another, and in which state each is entered and left; the last state says what is inserted behind."""
    now: dict[int, tuple[int, int]] = {START: (0, 0)}
    parents: list[dict[int, int]] = []
    for costs, ranks in tables:
        best: dict[int, tuple[int, tuple, int]] = {}
        for state, (cost, rank) in now.items():
            for end in range(4):
                if costs[4 * state + end] is not None:
                    new = (cost + costs[4 * state + end], (rank, ranks[4 * state + end]), state)
                    if end not in best or new[:2] < best[end][:2]:
                        best[end] = new
        order = {o: k for k, o in enumerate(sorted({o for _, o, _ in best.values()}))}
        now = {end: (cost, order[o]) for end, (cost, o, _) in best.items()}
        parents.append({end: parent for end, (_, _, parent) in best.items()})
    cost, _, end = min((cost + INSERT * CLOSING[state], rank, state) for state, (cost, rank) in now.items())
    ways = []
    for parent in reversed(parents):
        ways.append((parent[end], end))
        end = parent[end]
    return cost, ways[::-1]


def edits(letters: str, entered: int, left: int) -> str:
    """The best audit of a segment between these states."""
    vector, parents = _entered(entered), []
    for letter in letters:
        vector, _, parent = step(vector, letter)
        parents.append(parent)
    out = []
    for parent in reversed(parents):
        left, code = parent[left]
        out.append(CODES[code])
    return "".join(reversed(out))


# plans

def _letter() -> Column:
    gone = F.translate("initial", INITIALS, GONE)
    return F.when(F.col("fault").isin("blank", "duplicate"), gone).when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))


_PLAIN = str.maketrans(GONE + INITIALS.upper(), INITIALS * 2)


def _illegal(letters: str) -> int:
    initials = letters.translate(_PLAIN)
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        letters = b.column(2).to_pylist()
        both = [segment_table(x) for x in letters]
        costs, ranks = pa.array([c for c, _ in both], pa.list_(pa.int64())), pa.array([r for _, r in both], pa.list_(pa.int32()))
        ends, illegal = pa.array([x[0] + x[-1] for x in letters], pa.string()), pa.array(map(_illegal, letters), pa.int64())
        arrays = [b.column(0), b.column(1), costs, ranks, ends, illegal]
        yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "at", "costs", "ranks", "ends", "illegal"])


def _ways(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("at")
    cost, ways = fold(list(zip(rows.column("costs").to_pylist(), rows.column("ranks").to_pylist(), strict=True)))
    between = _borders(rows.column("ends").to_pylist())
    last = [False] * (len(ways) - 1) + [True]
    return pa.table({
        "at": rows.column("at"),
        "entered": pa.array([a for a, _ in ways], pa.int32()),
        "left": pa.array([b for _, b in ways], pa.int32()),
        "closing": pa.array([CLOSING[ways[-1][1]] * x for x in last], pa.int32()),
        "cost": pa.array([cost * x for x in last], pa.int64()),
        "illegal": pa.array([n + between * x for n, x in zip(rows.column("illegal").to_pylist(), last, strict=True)], pa.int64()),
    })


def _borders(ends: list[str]) -> int:
    return sum(_illegal(a[1] + b[0]) for a, b in zip(ends, ends[1:], strict=False))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        conv, at, letters, entered, left, closing, cost, illegal = b.columns
        pieces = [edits(*x) + "I" * n for *x, n in zip(*(c.to_pylist() for c in (letters, entered, left, closing)), strict=True)]
        yield pa.RecordBatch.from_arrays([conv, at, pa.array(pieces, pa.string()), cost, illegal], names=["conv_id", "at", "piece", "cost", "illegal"])


def plan(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation of ``rows`` (conv_id, turn, role, text).

    Only conv_id and turn may be null.
    """
    found = materialise(faults(rows), "turns-faults")
    letters = F.array_sort(F.collect_list(F.struct("place", _letter().alias("letter"))))
    inside = found.groupBy("conv_id", F.floor(F.col("place") / SEGMENT)).agg(F.min("place").alias("at"), letters.alias("turns"))
    segments = materialise(inside.select("conv_id", "at", F.array_join("turns.letter", "").alias("letters")), "turns-segments")
    tables = segments.mapInArrow(lean_batches(_tables), "conv_id long, at long, costs array<long>, ranks array<int>, ends string, illegal long")
    ways = tables.groupBy("conv_id").applyInArrow(_ways, "at long, entered int, left int, closing int, cost long, illegal long")
    met = segments.join(ways, "at").select("conv_id", "at", "letters", "entered", "left", "closing", "cost", "illegal")
    pieces = met.mapInArrow(lean_batches(_pieces), "conv_id long, at long, piece string, cost long, illegal long")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]), "")
    audits = pieces.groupBy("conv_id").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"), audit.alias("audit"))
    counts = [F.count_if(F.col("fault") == x).alias(x) for x in ("blank", "duplicate", "truncated")]
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    return by_conversation(audits, found.groupBy("conv_id").agg(gaps.alias("gaps"), *counts))


def by_conversation(*tables: DataFrame) -> DataFrame:
    """The tables, of at most one row a conv_id each, side by side; a null conv_id is one too."""
    columns = list(dict.fromkeys(c for t in tables for c in t.columns if c != "conv_id"))
    kinds = {c: kind for t in tables for c, kind in t.dtypes}
    rows = [t.select("conv_id", *(F.col(c) if c in t.columns else F.lit(None).cast(kinds[c]).alias(c) for c in columns)) for t in tables]
    both = rows[0]
    for t in rows[1:]:
        both = both.unionByName(t)
    return both.groupBy("conv_id").agg(*(F.max(c).alias(c) for c in columns))


# repaired turns

_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: A conversation comes as its audit, its turns, and a row that asks for what is inserted behind them.
HEAD, BODY, TAIL = range(3)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns of conversations that come one after another, each behind its audit."""
    seq, state, audit, i = 0, START, "", 0
    for b in batches:
        out: list[tuple] = []

        def forced(text: str, edit: str, conv: int | None) -> None:
            nonlocal seq, state
            state = FORCED[state]
            out.append((conv, seq, _ROLE[state], text, edit))
            seq += 1

        def insert_all(conv: int | None) -> None:
            nonlocal i
            while i < len(audit) and audit[i] == "I":
                forced("", "I", conv)
                i += 1

        for conv, plan_, role, text, part in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if part == HEAD:
                seq, state, audit, i = 0, START, plan_, 0
                continue
            insert_all(conv)
            if part == TAIL:
                continue
            edit = audit[i]
            i += 1
            if edit == "R":
                forced(text, "R", conv)
            elif edit == "K":
                state = KEPT[state, role[0]]
                out.append((conv, seq, role, text, "K"))
                seq += 1
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        names = ["conv_id", "seq", "role", "text", "edit"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=names)


def repaired(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, seq (from 0), role, text and edit (K, R or I) of the turns after repair, in order within a task; deleted turns are left out."""
    none = F.lit(None)
    missing = [none.cast(kind).alias(c) for c, kind in (("turn", "long"), ("role", "string"), ("text", "string"), ("digest", "binary"))]
    heads = plans.where("audit is not null").select("conv_id", *missing, "audit")
    body = rows.select("conv_id", "turn", "role", "text", _digest().alias("digest"), none.cast("string").alias("audit"))
    n = shuffle_width(rows.sparkSession)
    tails = heads.withColumn("audit", none.cast("string"))
    order = [F.col("conv_id"), F.col("part"), F.col("turn"), F.col("role"), F.col("digest")]
    parts = [t.withColumn("part", F.lit(k)) for k, t in ((HEAD, heads), (BODY, body), (TAIL, tails))]
    dealt = parts[0].unionByName(parts[1]).unionByName(parts[2]).repartition(n, "conv_id").sortWithinPartitions(*order)
    slim = small_batches(dealt).select("conv_id", "audit", "role", "text", "part")
    return slim.mapInArrow(lean_batches(_applied), "conv_id long, seq long, role string, text string, edit string")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, sha = None, None

    def batch(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([x for _, x in done], pa.string())], names=["conv_id", "repaired_sha256"])

    for b in batches:
        done = []
        for conv, seq, role, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if seq == 0:
                if sha is not None:
                    done.append((now, sha.hexdigest()))
                now, sha = conv, hashlib.sha256()
            if sha is None or conv != now:
                raise ValueError(f"turn {seq} of conversation {conv} is out of its place")
            sha.update((("\n" if seq else "") + f"{role}:{text}").encode())
        yield batch(done)
    if sha is not None:
        yield batch([(now, sha.hexdigest())])


def audit_digests(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Of every conv_id of ``conversations`` what ``plan`` says of ``rows``, and the SHA-256 of the repaired turns, ``role:text`` with newlines between."""
    plans = materialise(plan(rows), "turns-plans")
    shas = repaired(rows, plans).select("conv_id", "seq", "role", "text").mapInArrow(lean_batches(_digested), "conv_id long, repaired_sha256 string")
    all_ = by_conversation(conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct(), plans, shas)
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    sha = F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    return all_.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), sha.alias("repaired_sha256"))
