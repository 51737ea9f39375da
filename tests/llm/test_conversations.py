"""Conversation repair against a brute-force search over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from crawlindex.llm import conversations as conv

SCHEMA = "conv_id long, turn long, role string, text string, first boolean, cost int, audit string"
SF_DIR = "/root/testdata/sf0.01"


def damaged(rows):
    """Rows after the defects, by conversation; dropped ones only name theirs."""
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv_id] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def brute(rows):
    """Dijkstra-free search: per turn and state all best strings, none pruned."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, kinds = set(), []
    for _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        kind = "blank" if not core else "duplicate" if (role, text) in seen else None
        if kind is None and core[-1] not in ".!?":
            kind = "truncated"
        kinds.append(kind)
        seen.add((role, text))
    grammar = re.compile("(s?(ua)+)?")
    starts = re.compile("(s?(ua)*u?)?")
    paths = {"": (0, "", ())}  # by role initials modulo whole pairs: (cost, audit, rows)

    def state(initials):
        return initials[:1] if initials == "s" else "" if not initials else "+" + initials[-1]

    def better(into, initials, path):
        key = state(initials)
        if key not in into or path[:2] < into[key][1][:2]:
            into[key] = (initials, path)

    def inserts(into):
        for _ in range(4):
            for initials, (cost, audit, made) in list(into.values()):
                for role in ("user", "assistant"):
                    if starts.fullmatch(initials + role[0]):
                        better(into, initials + role[0], (cost + 3, audit + "I", (*made, f"{role}:")))
        return into

    paths = inserts({state(""): ("", (0, "", ()))})
    for (_, role, text), kind in zip(rows, kinds, strict=True):
        into = {}
        for initials, (cost, audit, made) in paths.values():
            better(into, initials, (cost + 4, audit + "D", made))
            if kind in ("blank", "duplicate"):
                continue
            more = 3 if kind == "truncated" else 0
            for edit, price, now in (("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")):
                if starts.fullmatch(initials + now[:1]) and now[:1]:
                    path = (cost + price + more, audit + edit, (*made, f"{now}:{text}"))
                    better(into, initials + now[:1], path)
        paths = inserts(into)
    cost, audit, made = min(p for i, p in paths.values() if grammar.fullmatch(i))
    turns = [t for t, _, _ in rows if t is not None]
    first = [role[:1] for _, role, _ in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        kinds.count("blank"),
        kinds.count("duplicate"),
        kinds.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)),
        cost,
        audit,
        hashlib.sha256("\n".join(made).encode()).hexdigest(),
    )


def every(rows):
    """(cost, audit) by trying all edits of a few rows, with up to three inserts
    in each gap."""
    import itertools

    best = None
    for edits in itertools.product("DKua", repeat=len(rows)):
        for gaps in itertools.product(["", "u", "a", "ua", "au", "uau", "aua"], repeat=len(rows) + 1):
            initials, audit, cost = gaps[0], "I" * len(gaps[0]), 3 * len(gaps[0])
            for (role, bad, cut), edit, gap in zip(rows, edits, gaps[1:], strict=True):
                if bad and edit != "D":
                    cost = None
                    break
                initials += {"D": "", "K": role[:1] or "?"}.get(edit, edit) + gap
                audit += {"D": "D", "K": "K"}.get(edit, "R") + "I" * len(gap)
                cost += {"D": 4, "K": 0}.get(edit, 3) + 3 * len(gap) + (3 if cut and edit != "D" else 0)
            if cost is not None and re.fullmatch("(s?(ua)+)?", initials):
                best = min(best or (cost, audit), (cost, audit))
    return best


def fields(r):
    return (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)


def test_search_against_all_edits():
    rng = random.Random(5)
    for _ in range(60):
        rows = [
            (rng.choice(["user", "assistant", "system", "tool", ""]), rng.random() < 0.2, rng.random() < 0.3)
            for _ in range(rng.randint(0, 3))
        ]
        search = conv.Survivors()
        for role, bad, cut in rows:
            search.turn(role, b"x", bad, cut)
        assert search.result()[:2] == every(rows), rows


def random_rows(seed, conversations=150):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "User", "ufo", None]
    texts = ["Fine.", "Cut off", "", " \t", None, "Yes!", "Really?  \n", "ünï。", "a.b\nuser:x."]
    rows = []
    for conv_id in [None, *range(conversations)]:
        weights = rng.choice([(8, 8, 1, 0, 0, 0, 0, 0), (1,) * 8, (9, 1, 1, 1, 0, 0, 0, 0), (0, 0, 5, 1, 0, 0, 0, 0)])
        for turn in range(rng.randint(1, 14)):
            if rng.random() < 0.1:
                turn = rng.choice([None, turn + 2, turn])
            text = rng.choice(texts) if rng.random() < 0.5 else f"Number {rng.random()}."
            rows.append((conv_id, turn, rng.choices(roles, weights)[0], text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rows = random_rows(seed)
    table = spark.createDataFrame([(*r, True, 1, "x") for r in rows], SCHEMA)
    expected = damaged(rows)
    found = conv.repairs(table, defects=True).collect()
    assert len(found) == len(expected)
    for r in found:
        assert fields(r) == brute(expected[r.conv_id]), expected[r.conv_id]


def test_given_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    expected = damaged([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    found = conv.repairs(table, defects=True).collect()
    assert {r.conv_id for r in found} == expected.keys()
    for r in found:
        assert fields(r) == brute(expected[r.conv_id])


def test_repaired_rows_match_their_digest(spark):
    rows = random_rows(3, 60)
    table = spark.createDataFrame([(*r, True, 1, "x") for r in rows], SCHEMA)
    made = defaultdict(list)
    for r in conv.repaired(table, defects=True).collect():
        made[r.conv_id].append((r.place, f"{r.role}:{r.text}"))
    for r in conv.repairs(table, defects=True).collect():
        own = sorted(made[r.conv_id])
        assert [p for p, _ in own] == list(range(len(own)))
        text = "\n".join(line for _, line in own)
        assert hashlib.sha256(text.encode()).hexdigest() == r.repaired_sha256
        assert len(r.roles) == len(own)


def test_no_rows_and_all_dropped(spark):
    assert conv.repairs(spark.createDataFrame([], SCHEMA), defects=True).collect() == []
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(dropped, 0, "user", "x", True, 1, "x")], SCHEMA)
    (r,) = conv.repairs(table, defects=True).collect()
    assert fields(r) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_settled_edits_leave_the_tree():
    """An alternating conversation holds a few edits; one of users only keeps
    its ties open, in a few nodes."""
    search = conv.Survivors()
    for i in range(5_000):
        search.turn(["user", "assistant"][i % 2], b"x", False, False)
        assert search.open_edits()[1] < 20
    ties = conv.Survivors()
    for _ in range(20_000):
        ties.turn("user", b"x", False, False)
    nodes, edits = ties.open_edits()
    assert nodes < 20 and edits < 80_000
    cost, audit, roles, _ = ties.result()
    assert cost == 30_000 and roles == "ua" * 10_000 and audit == "KR" * 10_000


def test_one_shuffle(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    plan = conv.repairs(table, defects=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
