"""Conversation repair: the search against all edits and a plain table of costs, segments against whole conversations."""

import hashlib
import itertools
import random
import re

import pytest

from waymeter.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, seat string, code string, part long, copies string"
CODES = [0, 1, 2, 3, 1 | 8, 2 | 8, 3 | 8, 8, 2 | 4, 3 | 4]


def least(codes, start=0, ends=repair.ENDS):
    """(cost, audit) by a table over rows and states; at most two rows are inserted at one place."""
    more = {0: [(0, 0, ""), (2, 3, "I"), (3, 6, "II")], 1: [(1, 0, ""), (2, 3, "I"), (3, 6, "II")],
            2: [(2, 0, ""), (3, 3, "I")], 3: [(3, 0, ""), (2, 3, "I")]}
    ways = {start: (0, "")}

    def widened(ways):
        out = {}
        for q, (cost, audit) in ways.items():
            for r, price, letters in more[q]:
                out[r] = min(out.get(r, (1 << 60, "")), (cost + price, audit + letters))
        return out

    for code in codes:
        after = {}
        for q, (cost, audit) in widened(ways).items():
            found = [(q, 4, "D")]
            if not code & 4:
                extra = 3 if code & 8 else 0
                for kind, r in enumerate(repair.AFTER[q]):
                    if r is not None and kind == code & 3:
                        found.append((r, extra, "K"))
                    if r is not None and kind in (2, 3):
                        found.append((r, 3 + extra, "R"))
            for r, price, letter in found:
                after[r] = min(after.get(r, (1 << 60, "")), (cost + price, audit + letter))
        ways = after
    ways = widened(ways)
    return min((ways[q] for q in ends if q in ways), default=None)


def test_search_equals_the_table_of_costs():
    for size in range(4):
        for codes in itertools.product(CODES, repeat=size):
            assert repair.search(bytes(codes)) == least(codes)
    draw = random.Random(4)
    for _ in range(1500):
        codes = draw.choices(CODES, k=draw.randint(4, 40))
        start, ends = draw.randrange(4), tuple(draw.sample(range(4), draw.randint(1, 3)))
        assert repair.search(bytes(codes), start, ends) == least(codes, start, ends)


def test_table_of_costs_equals_all_edits():
    """The audit of every sequence of edits of short conversations, by the words of the contract."""
    roles = {0: "t", 1: "s", 2: "u", 3: "a"}
    for codes in itertools.product([1, 2, 3, 0, 2 | 8, 3 | 4], repeat=2):
        best = None
        inserts = ["", "u", "a", "ua", "au"]
        for places in itertools.product(inserts, repeat=3):
            for edits in itertools.product(["K", "D", "u", "a"], repeat=2):
                if any(e != "D" and c & 4 for e, c in zip(edits, codes)):
                    continue
                made, audit, cost = "", "", 0
                for k in range(3):
                    made, audit, cost = made + places[k], audit + "I" * len(places[k]), cost + 3 * len(places[k])
                    if k < 2:
                        e, c = edits[k], codes[k]
                        made += "" if e == "D" else roles[c & 3] if e == "K" else e
                        audit += e if e in "KD" else "R"
                        cost += 4 if e == "D" else (0 if e == "K" else 3) + (3 if c & 8 else 0)
                if re.fullmatch("(s?(ua)+)?", made) and (best is None or (cost, audit) < best):
                    best = cost, audit
        assert least(codes) == best


def test_segments_join_to_the_whole():
    draw = random.Random(5)
    for _ in range(200):
        codes = bytes(draw.choices(CODES, k=draw.randint(1, 30)))
        cut = sorted(draw.sample(range(len(codes) + 1), min(len(codes), 3)))
        parts = [codes[i:j] for i, j in zip([0, *cut], [*cut, len(codes)])]
        steps = repair.joined([[repair.search(p, q, (r,)) for q in range(4) for r in range(4)] for p in parts])
        assert (sum(s[1] for s in steps), "".join(s[2] for s in steps)) == least(codes)
        rows = [(c, repair.SPACE, str(k)) for k, c in enumerate(codes)]
        lines, at = [], 0
        for (state, _, audit), part in zip(steps, parts):
            lines += repair.repaired_rows(audit, iter(rows[at:at + len(part)]), state)
            at += len(part)
        assert lines == list(repair.repaired_rows(least(codes)[1], iter(rows)))


def expected(rows):
    """The answer for one conversation's rows (turn, role, text), damaged already and in order."""
    seen, codes, counts, turns = set(), [], [0, 0, 0], set()
    for turn, role, text in rows:
        turns |= {turn} - {None}
        code = {"s": 1, "u": 2, "a": 3}.get(role[:1], 0)
        if not text.strip(" \t\n\v\f\r"):
            counts[0], code = counts[0] + 1, code | 4
        elif (role, text) in seen:
            counts[1], code = counts[1] + 1, code | 4
        elif text.strip(" \t\n\v\f\r")[-1] not in ".!?":
            counts[2], code = counts[2] + 1, code | 8
        seen.add((role, text))
        codes.append(code)
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (_, a, _), (_, b, _) in zip(rows, rows[1:]))
    cost, audit = least(codes)
    lines = repair.repaired_rows(audit, iter([(c, r, t) for c, (_, r, t) in zip(codes, rows)]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.mark.parametrize("length", [3, 512])
def test_long_and_odd_conversations(spark, monkeypatch, length):
    monkeypatch.setattr(repair, "ROWS", length)
    monkeypatch.setattr(repair, "BROADCAST", 1 if length == 3 else 100_000)
    draw = random.Random(6)
    texts = ["Yes.", "no", "", " \t", "What? ", "a.b", "é!", "line.\n", "(x.)", " "]
    rows = [(7, t, draw.choice(["user", "assistant", "system"]), draw.choice(texts) + str(t % 50 if t % 3 else "")) for t in range(1200)]
    rows += [(None, t, r, "Well.") for t, r in enumerate(["user", "assistant"])]
    rows += [(k, draw.randrange(6) if draw.random() < 0.9 else None, draw.choice(["user", "assistant", "system", "tool", "", " "]), draw.choice(texts))
             for k in range(100, 220) for _ in range(draw.randint(1, 6))]
    rows += [(300, 1, None, None), (301, None, "system", "Be kind."), (302, 5, "user", "x" * 100_000 + "."), (302, 9, "assistant", "Ok.")]
    frame = spark.createDataFrame([(*r, "s", "c", 9, "k") for r in rows], SCHEMA).repartition(5)
    damaged = repair.damaged(frame)
    by_id = {}
    for r in damaged.collect():
        by_id.setdefault(r.conv_id, [])
        if not r.gone:
            by_id[r.conv_id].append((r.turn, r.role, r.text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest())
    found = {r[0]: tuple(r)[1:] for r in repair.repaired(damaged).collect()}
    assert found == {k: expected(sorted(v, key=order)) for k, v in by_id.items()} and found.keys() == {r[0] for r in rows}


def test_tables_without_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repaired(repair.damaged(empty)).count() == 0
    gone = repair.damaged(spark.createDataFrame([(k, 0, "user", "Hi.", "s", "c", 9, "k") for k in range(200)], SCHEMA)).where("gone")
    rows = repair.repaired(gone).collect()
    assert rows and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in rows)
