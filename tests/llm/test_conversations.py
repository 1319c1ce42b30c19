import hashlib
import itertools
import random
import re
import zlib

import pytest

from revspark.llm import hirschberg
from revspark.llm.conversations import conversation_audits, damaged, repaired_turns
from tests.llm.helpers import rows

SPACE = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?")


def exhaustive(turns):
    """Cheapest edits of (role, text, fault) turns by trying all: (cost, audit, repaired)."""
    best = None
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    edits = ["K", "D", "user", "assistant"]
    for before in itertools.product(inserts, repeat=len(turns) + 1):
        for chosen in itertools.product(edits, repeat=len(turns)):
            cost, audit, out = 0, "", []
            for (role, text, fault), edit, new in zip(turns, chosen, before):
                cost, audit = cost + 3 * len(new), audit + "I" * len(new)
                out += [(r, "") for r in new]
                if fault in ("blank", "duplicate") and edit != "D":
                    break
                if edit == "D":
                    cost, audit = cost + 4, audit + "D"
                    continue
                cost += 3 * (fault == "truncated") + 3 * (edit != "K")
                audit += "K" if edit == "K" else "R"
                out.append((role if edit == "K" else edit, text))
            else:
                cost, audit = cost + 3 * len(before[-1]), audit + "I" * len(before[-1])
                out += [(r, "") for r in before[-1]]
                shown = "".join(r[:1] or "?" for r, _ in out)  # an empty role can't be kept
                if LEGAL.fullmatch(shown) and (best is None or (cost, audit) < best[:2]):
                    best = (cost, audit, out)
    return best


def step_by_step(turns):
    """The same by a plain table over rows and states, for longer conversations."""
    follow = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def with_inserts(table):
        for _ in range(3):
            for state, (cost, audit, out) in list(table.items()):
                role = follow[state]
                found = (cost + 3, audit + "I", out + [(role, "")])
                if role[0] not in table or found[:2] < table[role[0]][:2]:
                    table[role[0]] = found
        return table

    table = {"": (0, "", [])}
    for role, text, fault in turns:
        new = {}

        def offer(state, cost, audit, out):
            if state not in new or (cost, audit) < new[state][:2]:
                new[state] = (cost, audit, out)

        for state, (cost, audit, out) in with_inserts(table).items():
            offer(state, cost + 4, audit + "D", out)
            if fault not in ("blank", "duplicate"):
                late = 3 * (fault == "truncated")
                r = follow[state]
                offer(r[0], cost + 3 + late, audit + "R", out + [(r, text)])
                if role[:1] == r[0] or (role[:1] == "s" and state == ""):
                    offer(role[0], cost + late, audit + "K", out + [(role, text)])
        table = new
    return min((with_inserts(table)[s] for s in ("", "a") if s in table), key=lambda x: x[:2])


def faults(turns):
    out, seen = [], set()
    for role, text in turns:
        shown = text.rstrip(SPACE)
        fault = ("blank" if not shown else "duplicate" if (role, text) in seen
                 else "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def code(role, fault):
    initial = "sua".find(role[0]) if role and role[0] in "sua" else 3
    return 65 + 4 * initial + [None, "truncated", "blank", "duplicate"].index(fault)


def brute(table, damage=True, solve=step_by_step):
    """The contract over a list of (conv_id, turn, role, text)."""
    conversations = {}
    for conv, turn, role, text in table:
        kept = conversations.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20 if damage else 9
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        kept += [(turn is not None, turn or 0, role, digest, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, kept in conversations.items():
        kept.sort()
        turns = faults([(r[2], r[4]) for r in kept])
        numbers = [r[1] for r in kept if r[0]]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        shown = [r[2][:1] for r in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(shown, shown[1:]))
        n = [sum(t[2] == f for t in turns) for f in ("blank", "duplicate", "truncated")]
        cost, audit, repaired = solve(turns)
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out.append((conv, gaps, *n, illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, part int, number long, codes string"


def frame(spark, table):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in table], SCHEMA)


def conversations(seed, n, length):
    rnd = random.Random(seed)
    words = ["Yes.", "no", "Why?", "so it is!", "", " ", "\n", None, "a. b", "end.\n ", "é…", "1)"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "s", "User"]
    out = []
    for conv in range(n):
        for turn in range(rnd.randint(1, length)):
            role = ("user", "assistant")[turn % 2] if rnd.random() < 0.6 else rnd.choice(roles)
            at = None if rnd.random() < 0.05 else turn + rnd.choice([0, 0, 0, 1, 3])
            out.append((conv if conv else None, at, role, rnd.choice(words)))
    return out


def test_repair_equals_trying_all_edits():
    rnd = random.Random(2)
    roles, kinds = ["user", "assistant", "system", "x"], [None, None, "truncated", "blank", "duplicate"]
    cases = [[(r, "", f)] for r in roles for f in kinds]
    cases += [[(rnd.choice(roles), "", rnd.choice(kinds)) for _ in range(n)]
              for n in [2] * 60 + [3] * 25 for _ in range(1)]
    for turns in cases:
        want = exhaustive(turns)
        assert step_by_step(turns)[:2] == want[:2], turns
        codes = bytes(code(role, fault) for role, _, fault in turns)
        assert hirschberg.repair(codes) == want[:2], turns


def test_repair_of_long_conversations_equals_the_plain_table():
    rnd = random.Random(3)
    for n in [*range(1, 40), 100, 300, 2000]:
        turns = [(rnd.choice(["user", "assistant", "system", "x"]), "",
                  rnd.choice([None, None, None, "truncated", "blank", "duplicate"]))
                 for _ in range(n)]
        codes = bytes(code(role, fault) for role, _, fault in turns)
        assert hirschberg.repair(codes) == step_by_step(turns)[:2]
    assert hirschberg.repair(b"") == (0, "")


def test_block_wise_vectors_equal_row_wise_ones(monkeypatch):
    rnd = random.Random(4)
    codes = bytes(rnd.randint(65, 80) for _ in range(1000))
    want = hirschberg.repair(codes)
    monkeypatch.setattr(hirschberg, "BLOCK", 64)
    assert hirschberg.repair(codes) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_audits_equal_brute_force(spark, seed):
    table = conversations(seed, 60, 9)
    assert rows(conversation_audits(damaged(frame(spark, table)))) == brute(table)
    assert rows(conversation_audits(frame(spark, table))) == brute(table, damage=False)


def test_short_conversations_equal_trying_all_edits(spark):
    table = conversations(7, 30, 3)
    got = rows(conversation_audits(frame(spark, [r for r in table if r[0] is not None])))
    assert got == brute([r for r in table if r[0] is not None], damage=False, solve=exhaustive)


def test_a_conversation_over_many_ranges_with_hot_rows(spark):
    rnd = random.Random(6)
    roles = ["user", "assistant"]
    table = [(1, t // 2, rnd.choice(roles), rnd.choice(["Go.", "on", f"{t}!"])) for t in range(3000)]
    table += [(1, 77, "user", "Go.")] * 2000 + [(2, 0, "user", "Hi.")] * 500 + [(3, 1, "user", "x.")]
    rnd.shuffle(table)
    got = conversation_audits(damaged(frame(spark, table).repartition(8)))
    assert rows(got) == brute(table)


def test_repaired_turns_are_those_hashed(spark):
    table = conversations(9, 40, 8)
    df = damaged(frame(spark, table))
    turns = {}
    for r in sorted(repaired_turns(df).collect(), key=lambda r: r["place"]):
        assert r["place"] == len(turns.setdefault(r["conv_id"], []))
        turns[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for r in conversation_audits(df).collect():
        text = "\n".join(turns.get(r["conv_id"], []))
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]


def test_conversations_without_rows_after_damage(spark):
    gone = [(c, t) for c in range(60) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    got = conversation_audits(damaged(frame(spark, [(c, t, "user", "Hi.") for c, t in gone]))).collect()
    assert {r["conv_id"] for r in got} == {c for c, _ in gone}
    empty = hashlib.sha256(b"").hexdigest()
    assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "", empty) for r in got)


def test_long_texts_and_empty_table(spark):
    long = "word " * 400_000 + "."
    table = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 2, "user", long), (2, 0, "user", "")]
    assert rows(conversation_audits(frame(spark, table))) == brute(table, damage=False)
    none = conversation_audits(frame(spark, []))
    assert none.count() == 0 and none.dtypes[0] == ("conv_id", "bigint")
    assert repaired_turns(frame(spark, [])).count() == 0


def test_conversations_of_the_test_data(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    table = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert rows(conversation_audits(damaged(df))) == brute(table)
