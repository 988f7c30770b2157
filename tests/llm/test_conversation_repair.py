"""Conversation repair against a brute-force version."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib

import pytest
import xxhash
from llm_cases import CLASHING
from pyspark.sql import functions as F

from starloom.llm import queries
from starloom.llm.conversation_repair import damage, least_edits, message_digests, repair_conversations

BLANKS = " \t\n\x0b\f\r"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def spark_hash(*texts):
    seed = 42
    for text in texts:
        seed = xxhash.xxh64_intdigest(text.encode(), seed)
    return signed(seed)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        named = ":".join(" " if x is None else str(x) for x in (conv, turn))
        role, text, fault = role if role is not None else " ", text if text is not None else " ", zlib.crc32(named.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(messages):
    """(cost, edits, lines) of [(role, text, fault)]: every edit tried, ties to the least letters."""

    table = {}

    def best(i, state, inserted):
        return table[i, state, inserted]

    def value(i, state, inserted):
        found = []
        if i == len(messages) and state in (0, 3):
            found.append((0, "", ()))
        for role in ("user", "assistant"):
            if inserted < 3 and (state, role[0]) in STEP:
                found.append(add(2, "I", f"{role}:", best(i, STEP[state, role[0]], inserted + 1)))
        if i < len(messages):
            role, text, fault = messages[i]
            found.append(add(3, "D", None, best(i + 1, state, 0)))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                for letter, cost, new in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    if (state, new[:1]) in STEP:
                        found.append(add(cost + more, letter, f"{new}:{text}", best(i + 1, STEP[state, new[:1]], 0)))
        return min(found, key=lambda f: f[:2], default=(10**9, "", ()))

    def add(cost, letter, line, rest):
        return (cost + rest[0], letter + rest[1], (() if line is None else (line,)) + rest[2])

    for i in range(len(messages), -1, -1):
        for inserted in (3, 2, 1, 0):
            for state in range(4):
                table[i, state, inserted] = value(i, state, inserted)
    return table[0, 0, 0]


def brute(rows, original=None):
    """rows after damage -> sorted rows of the contract."""
    out = []
    for conv in {r[0] for r in (original or rows)}:
        own = [r for r in rows if r[0] == conv]
        order = lambda r: (r[1] is not None, r[1] or 0, r[2], spark_hash(r[2], r[3]))
        own = sorted(own, key=order)
        turns = {r[1] for r in own if r[1] is not None}
        seen, messages, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in own:
            stripped = text.strip(BLANKS)
            fault = None
            if not stripped:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif stripped[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            messages.append((role, text, fault))
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, lines = cheapest(tuple(messages))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, digest))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired(frame, **settings):
    found = repair_conversations(frame, **settings)
    joined = found.summary.join(message_digests(found.messages), "key", "left").collect()
    nothing = hashlib.sha256(b"").hexdigest()
    return sorted(((r["id"], *[r[c] for c in COLUMNS[1:-1]], r["sha256"] or nothing) for r in joined), key=repr)


@pytest.fixture
def conversations(spark):
    def make(rows):
        names = [n for n in (*CLASHING, "place", "block", "total", "fault", "h1", "edits", "_part", "copy")]
        kind = "conv_id long, turn long, role string, text string, " + ", ".join(f"{n} string" for n in names)
        return spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], kind).repartition(4)

    return make


def alphabet(text):
    """A conversation from letters: role initials, upper case for truncated, b for blank, d for duplicate."""
    roles = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    rows = []
    for i, letter in enumerate(text):
        if letter == "b":
            rows.append(("user", " \n"))
        elif letter == "d" and rows:
            rows.append(rows[-1])
        elif letter != "d":
            rows.append((roles[letter.lower()], f"message {i}" + ("" if letter.isupper() else ".")))
    return rows


def test_every_short_conversation():
    for n in range(6):
        for text in itertools.product("suaxUb", repeat=n):
            messages = tuple((r, t, "blank" if not t.strip() else None if t.endswith(".") else "truncated") for r, t in alphabet(text))
            faults = "".join({"blank": "b", "truncated": "t", None: "-"}[m[2]] for m in messages)
            initials = "".join(m[0][0] if m[0][0] in "sua" else "x" for m in messages)
            cost, audit, _ = cheapest(messages)
            assert least_edits(initials, faults) == (cost, audit), text


@pytest.mark.parametrize("block", [1, 2, 5, 4096])
def test_equals_brute_force_whatever_the_blocks(conversations, block):
    """Conversations of one block and of many, which have to agree with each other too."""
    texts = ["suaua", "uauaUA", "aus", "bbb", "uddad", "xuxaxu", "ssuuaaua", "aAaAaA", "uabuadsuaua" * 6, "Uxbda" * 9, "s", "ua" * 40]
    rows = [(c, 3 * i, *m) for c, text in enumerate(texts) for i, m in enumerate(alphabet(text))]
    assert repaired(conversations(rows), block=block) == brute(rows)


def test_edges(conversations):
    rows = [(1, None, "user", "no turn."), (1, 5, "assistant", "yes."), (1, 9, "user", "again."), (1, 9, "assistant", "same turn?")]
    rows += [(2, None, None, None), (2, None, "", "no role."), (None, 1, "user", "no id."), (None, 2, "assistant", "right!")]
    rows += [(3, 1, "user", "x" * 200_000 + "."), (3, 2, "assistant", "\x0b. \t\n"), (3, 3, "user", "naïve \U0001f600")]
    rows += [(4, 1, "user", "the same.")] * 40 + [(5, -3, "System", "S."), (5, 2, "sys", "s."), (5, 3, "u", "u:"), (5, 4, "a", "a\r\n?")]
    frame = conversations(rows)
    assert repaired(frame, block=3) == repaired(frame) == brute([(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows])


def test_damage_follows_the_checksum(conversations):
    rows = [(c, t, "assistant" if t % 2 else "user", f"Words of {c}. And {t}!?") for c in range(40) for t in range(7)]
    rows += [(None, None, None, None), (None, 3, "user", None), (7, None, "system", "x.")]
    got = [tuple(r) for r in damage(conversations(rows)).select("conv_id", "turn", "role", "text").collect()]
    assert sorted(got, key=repr) == sorted(damaged(rows), key=repr)


def test_nothing(conversations):
    assert repaired(conversations([(1, 1, "user", "x")]).limit(0)) == []


def test_conversation_over_many_partitions(conversations, setting):
    """One that holds most rows is sorted, cut and walked in many tasks."""
    setting("spark.sql.adaptive.enabled", "false")
    letters = "uaUAbdxs" * 120
    rows = [(1, i, *m) for i, m in enumerate(alphabet(letters))] + [(c, i, *m) for c in range(2, 30) for i, m in enumerate(alphabet("uaub"))]
    assert repaired(conversations(rows), block=16) == brute(rows)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op11_conversation_repair"](spark, sf_dir)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr) == brute(damaged(rows), rows)
    kinds = dict(got.dtypes)
    assert [kinds[c] for c in COLUMNS] == ["bigint"] * 7 + ["string"] * 2
