"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from functools import cache
from itertools import product
from pathlib import Path

import pytest

from ledgersieve.llm.conversations import (
    cheapest_chain, damaged_turns, evaluate_string, every_conversation, pair_rules, repair_conversations, repaired_digests,
    repaired_turns, symbol_matrices,
)
from ledgersieve.llm.queries import all_queries

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, place int, blocks int, head int, kind int"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        space = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{space(conv_id)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def plain_search(faults):
    """Cheapest cost and its ASCII-least edits for (initial, fault) pairs, from the end backwards."""
    follows = {0: "su", 1: "u", 2: "a", 3: "u"}
    after = {"s": 1, "u": 2, "a": 3}

    @cache
    def best(at, state, inserted):
        ways = [(0, "")] if at == len(faults) and state in (0, 3) else []
        new = after["a" if state == 2 else "u"]
        if inserted < 2:
            cost, edits = best(at, new, inserted + 1)
            ways.append((cost + 2, "I" + edits))
        if at < len(faults):
            initial, fault = faults[at]
            cost, edits = best(at + 1, state, 0)
            ways.append((cost + 3, "D" + edits))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                cost, edits = best(at + 1, new, 0)
                ways.append((cost + 2 + extra, "R" + edits))
                if initial and initial in follows[state]:
                    cost, edits = best(at + 1, after[initial], 0)
                    ways.append((cost + extra, "K" + edits))
        return min(ways, default=(10**9, ""))

    for at in reversed(range(len(faults) + 1)):  # so that no call goes deep
        for state in follows:
            best(at, state, 0)
    return best(0, 0, 0)


def plain_repair(turns):
    order = lambda t: (t[1] is not None, t[1] or 0, t[2].encode(), hashlib.sha256(t[3].encode()).hexdigest())
    turns, seen, faults = sorted(turns, key=order), set(), []
    for _, _, role, text in turns:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append((role[:1], fault))
    numbers = [t[1] for t in turns if t[1] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    count = lambda fault: sum(f == fault for _, f in faults)
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(faults, faults[1:], strict=False))
    cost, audit = plain_search(tuple(faults))
    lines, at, state = [], 0, 0
    for edit in audit:
        if edit != "I":
            _, _, role, text = turns[at]
            at += 1
            if edit == "D":
                continue
        if edit != "K":
            role, text = "assistant" if state == 2 else "user", text if edit == "R" else ""
        state = {"s": 1, "u": 2, "a": 3}[role[0]]
        lines.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
    return gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def plain_result(rows, damage=plain_damage):
    turns = damage(rows)
    return sorted(((c, *plain_repair([t for t in turns if t[0] == c])) for c in {r[0] for r in rows}), key=str)


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA).repartition(4)


def random_rows(seed, conversations=150):
    rng, rows = random.Random(seed), []
    for conv_id in range(conversations):
        for turn in range(rng.choice([1, 2, 3, 6, 12])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "sup", "", None])
            text = rng.choice(["Yes.", "No", "So?", "one\n", "", " \t", "a.b", "Ende!  ", None, f"text {rng.randrange(5)}.", "é\xa0"])
            rows.append((conv_id, rng.choice([turn, turn, turn, turn + 1, turn + 3]), role, text))
    return rows


def found(frame):
    return sorted(map(tuple, frame.select(*COLUMNS).collect()), key=str)


def repaired(turns, conversations, **settings):
    return repaired_digests(turns, every_conversation(repair_conversations(turns, **settings), conversations))


def test_repairs_are_those_of_a_plain_search(spark):
    rows = random_rows(1)
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (500, None, "user", "a."), (500, None, "assistant", "b.")]
    rows += [(501, 3, "user", "Hi.")] * 5 + [(502, 1, "user", "x" * 300_000 + "."), (502, 2, "assistant", "y. " * 100_000)]
    rows += [(600, t, r, "Long conversation.") for t in range(300) for r in ("user",)] + [(601, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(400)]
    conversations = frame_of(spark, rows)
    expected = plain_result(rows)
    for settings in ({}, {"block_rows": 4}):
        assert found(repaired(damaged_turns(conversations), conversations, **settings)) == expected
    plain = plain_result(rows, lambda given: [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in given])
    assert found(repaired(conversations, conversations)) == plain


def test_conversations_without_turns(spark):
    dropped = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    rows = [(7, dropped, "user", "Hi.")]
    conversations = frame_of(spark, rows)
    assert found(repaired(damaged_turns(conversations), conversations)) == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    empty = conversations.limit(0)
    assert found(repaired(damaged_turns(empty), empty)) == []


def test_repaired_turns_are_the_texts(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi"), (1, 2, "assistant", "So."), (1, 3, "assistant", "So."), (1, 4, "user", "?")]
    turns = frame_of(spark, rows)
    repairs = repair_conversations(turns)
    assert [(r.cost, r.audit) for r in repairs.collect()] == [plain_repair(rows)[5:7]]
    kept = repaired_turns(turns, repairs).orderBy("place").collect()
    assert [r.place for r in kept] == list(range(len(kept)))
    digest = hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest()
    assert digest == plain_repair(rows)[7]


SYMBOLS = {"x": ("u", "blank"), **{c: (c, "") for c in "sua"}, "o": ("t", ""), **{c.upper(): (c, "truncated") for c in "sua"}, "O": ("t", "truncated")}


def test_every_short_string_with_and_without_rules():
    one, two, three, four = map(chr, range(0xE001, 0xE005))
    plain, grammar = symbol_matrices([]), [(one, "ua"), (two, "xU"), (three, one + one), (four, "s" + one)]
    matrices = symbol_matrices(grammar)
    strings = ["".join(s) for n in range(5) for s in product("xsuaoUA", repeat=n)] + [random.Random(n).choices("xsuaoSUAO", k=30) for n in range(50)]
    for string in map("".join, strings):
        expected = plain_search(tuple(SYMBOLS[c] for c in string))
        short = string
        for symbol, pair in grammar:
            short = short.replace(pair, symbol)
        for form, known in ((string, plain), (short, matrices)):
            costs, ranks, audits = evaluate_string(form, known)
            cells, cost, ending = cheapest_chain([(costs, ranks)])
            assert (cost, audits[cells[0]] + ending) == expected


def test_rules_replace_the_most_frequent_pairs(spark):
    strings = spark.createDataFrame([("uaua",), ("suaua",), ("uauax",), ("",), ("o",)], "symbols string")
    rules = pair_rules(strings)
    assert rules[0][1] == "ua" and len({symbol for symbol, _ in rules}) == len(rules)
    assert any(rules[0][0] in pair for _, pair in rules[1:])
    assert pair_rules(strings.limit(0)) == []


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")
def test_query_on_the_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(all_queries()["op11_grammar_repair"](spark, FOLDER)) == plain_result(rows)
