"""Conversation repair against all repairs of short conversations, and against whole audits of long ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from signalmill.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_, turn_, role, text = (" " if x is None else str(x) for x in (conv, turn, role, text))
        kind = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def ordered(rows):
    def digest(r):
        return hashlib.sha256((hashlib.sha256(r[2].encode()).hexdigest() + r[3]).encode()).digest()

    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r)))


def marked(rows):
    """(role, text, fault) of ordered rows."""
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def played(turns, audit):
    """Cost and repaired turns of an audit, or None where it is none of these turns."""
    state, cost, out, rest = "", 0, [], list(turns)
    for edit in audit:
        if edit == "I":
            state, cost = NEXT[state], cost + 2
            out.append(("user" if state == "u" else "assistant", ""))
            continue
        if not rest:
            return None
        role, text, fault = rest.pop(0)
        if edit == "D":
            cost += 3
            continue
        if fault in ("blank", "duplicate"):
            return None
        cost += fault == "truncated"
        if edit == "R":
            state, cost = NEXT[state], cost + 2
            out.append(("user" if state == "u" else "assistant", text))
        else:
            if role[:1] != NEXT[state] and not (state == "" and not out and role[:1] == "s"):
                return None
            state = role[:1]
            out.append((role, text))
    if rest or not re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out)):
        return None
    return cost, out


MACROS = ["I" * k + e for k in range(4) for e in "KRD"]


def cheapest_of_all(turns):
    """Every audit with runs of up to three inserts."""
    found = []
    for parts in itertools.product(MACROS, repeat=len(turns)):
        for k in range(4):
            audit = "".join(parts) + "I" * k
            if (x := played(turns, audit)) is not None:
                found.append((x[0], audit))
    return min(found)


def cheapest(turns):
    """Layer by layer with whole strings."""
    best = {"": (0, "")}
    for role, _, fault in turns:
        new = {}
        for state, (cost, audit) in best.items():
            for k in range(3):
                at = state
                for _ in range(k):
                    at = NEXT[at]
                ends = [("D", 3, at)]
                if fault not in ("blank", "duplicate"):
                    more = fault == "truncated"
                    ends.append(("R", 2 + more, NEXT[at]))
                    if role[:1] == NEXT[at] or (at == "" and role[:1] == "s"):
                        ends.append(("K", int(more), role[:1]))
                for edit, c, end in ends:
                    x = (cost + 2 * k + c, audit + "I" * k + edit)
                    new[end] = min(new.get(end, x), x)
        best = new
    return min((c + 2 * k, a + "I" * k) for s, (c, a) in best.items() for k in [{"": 0, "a": 0, "u": 1, "s": 2}[s]])


def expected(conv, rows, search=cheapest):
    rows = ordered([r for r in rows if r[0] == conv])
    if not rows:
        return (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    turns = marked(rows)
    numbers = {r[1] for r in rows} - {None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    faults = [sum(f == x for _, _, f in turns) for x in ("blank", "duplicate", "truncated")]
    initials = [r[:1] for r, _, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = search(turns)
    played_cost, out = played(turns, audit)
    assert played_cost == cost
    return (conv, gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


TEXTS = ["fine.", "cut", "", " \t", "fine.", "Yes?", "x ! \n", "ünd so.", "wait…"]
ROLES = ["user", "assistant", "system", "user", "assistant", "tool", None, "usher", ""]


def conversations(rnd, n, length):
    rows = []
    for conv in range(n):
        for turn in range(rnd.randint(1, length)):
            number = rnd.choice([turn, turn, turn, 2 * turn, None, 0])
            rows.append((conv if conv else None, number, rnd.choice(ROLES), rnd.choice([*TEXTS, f"own {rnd.random()}.", None])))
    return rows


def results(spark, rows, damage=True):
    df = spark.createDataFrame(rows, SCHEMA)
    out = repair.audit_digests(df, repair.damage(df) if damage else repair.turns(df))
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r) for r in out.collect()}


def test_strings_by_ranks():
    rnd = random.Random(3)
    for _ in range(300):
        turns = [(rnd.choice(["user", "assistant", "system", "tool"]), "t", rnd.choice([None, None, "blank", "truncated"])) for _ in range(rnd.randint(0, 3))]
        letters = "".join(letter(*t) for t in turns)
        cost, ways = repair.fold([repair.segment_table(letters)])
        audit = repair.edits(letters, *ways[0]) + "I" * repair.CLOSING[ways[0][1]]
        assert (cost, audit) == cheapest_of_all(turns) == cheapest(turns)


def letter(role, text, fault):
    initial = role[0] if role[0] in "sua" else "x"
    return repair.GONE[repair.INITIALS.index(initial)] if fault == "blank" else initial.upper() if fault else initial


@pytest.mark.parametrize("cut", [1, 2, 7, 1000])
def test_segments_fold_to_the_whole(cut):
    rnd = random.Random(cut)
    for _ in range(40):
        turns = [(rnd.choice(["user", "assistant", "system", "tool"]), "t", rnd.choice([None, None, "blank", "truncated"])) for _ in range(rnd.randint(1, 40))]
        letters = "".join(letter(*t) for t in turns)
        parts = [letters[i : i + cut] for i in range(0, len(letters), cut)]
        cost, ways = repair.fold([repair.segment_table(p) for p in parts])
        audit = "".join(repair.edits(p, *w) for p, w in zip(parts, ways)) + "I" * repair.CLOSING[ways[-1][1]]
        assert (cost, audit) == cheapest(turns)


def test_few_layers_are_worked_out():
    repair.step.cache_clear()
    rnd = random.Random(0)
    repair.segment_table("".join(rnd.choice("suaxSUAX1234") for _ in range(50_000)))
    assert repair.step.cache_info().currsize < 1500


def test_random_conversations(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 2)
    rnd = random.Random(11)
    rows = conversations(rnd, 120, 9)
    got, broken = results(spark, rows), damaged(rows)
    assert got == {conv: expected(conv, broken) for conv in {r[0] for r in rows}}


def test_long_conversation_and_lost_ones(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 64)
    rnd = random.Random(5)
    lost = next(c for c in range(10**6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(10**7, k, rnd.choice(["user", "assistant", "user", "tool"]), rnd.choice(["a.", f"{k}.", f"{k}", ""])) for k in range(3000)] + [(lost, 0, "user", "gone.")]
    got, broken = results(spark, rows), damaged(rows)
    assert got[10**7] == expected(10**7, broken)
    assert got[lost] == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "cut"), (1, 2, "user", "Bye."), (2, 0, "system", "Be kind.")]
    df = repair.turns(spark.createDataFrame(rows, SCHEMA))
    plans = repair.plan(df)
    out = [tuple(r) for r in repair.repaired(df, plans).orderBy("conv_id", "seq").collect()]
    audits = {r["conv_id"]: r["audit"] for r in plans.collect()}
    for conv in (1, 2):
        turns = marked(ordered([r for r in rows if r[0] == conv]))
        assert [(r, t) for c, _, r, t, _ in out if c == conv] == played(turns, audits[conv])[1]
    assert "".join(e for c, _, _, _, e in out if c == 1) == audits[1].replace("D", "")


def test_empty_repeated_long_and_extra_columns(spark):
    assert results(spark, []) == {}
    long = "wörd " * 60_000 + "end."
    rows = [(1, 0, "user", long), (1, 1, "assistant", "ok."), (1, 1, "assistant", "ok."), (2, None, None, None), (None, None, "user", "hm."), (None, 3, "assistant", "oh.")]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("place", "audit", "part", "kind", "digest", "at", "letters", "copy", "seq", "edit"):
        df = df.withColumn(c, F.lit("extra"))
    out = repair.audit_digests(df, repair.damage(df))
    broken = damaged(rows)
    assert {r["conv_id"]: tuple(r) for r in out.collect()} == {c: expected(c, broken) for c in (1, 2, None)}
