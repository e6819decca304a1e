"""Operator 12 against a plain dynamic programme over whole conversations."""

import hashlib
import random
import re
import zlib

import pytest

import brute
from hirelake.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, pos int, m string, edits string"
EMPTY = hashlib.sha256(b"").hexdigest()


def _damaged(rows):
    out = []
    for c, turn, role, text, *_ in rows:
        key = ":".join(" " if v is None else str(v) for v in (c, turn))
        role, text = (" " if v is None else v for v in (role, text))
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(c, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def _report(rows):
    """The report's columns of one conversation's rows."""
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], md5(r[2])))
    faults, seen = [], set()
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]+", "", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else
                      "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    states = {"": (0, "", ())}

    def add(new, state, role, cost, letter, given, old):
        to = after.get((state, role[:1]))
        if to is not None:
            found = (old[0] + cost, old[1] + letter, old[2] + (given,))
            new[to] = min(new.get(to, found), found)

    def inserted(states):
        for _ in range(3):
            for s, old in list(states.items()):
                for role in ("user", "assistant"):
                    add(states, s, role, 2, "I", (role, ""), old)
        return states

    for (_, role, text), fault in zip(rows, faults):
        new, late = {}, fault == "truncated"
        for s, old in inserted(states).items():
            found = (old[0] + 3, old[1] + "D", old[2])
            new[s] = min(new.get(s, found), found)
            if fault not in ("blank", "duplicate"):
                add(new, s, role, late, "K", (role, text), old)
                for other in ("user", "assistant"):
                    add(new, s, other, 2 + late, "R", (other, text), old)
        states = new
    cost, audit, given = min(v for s, v in inserted(states).items() if s in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in given).encode()).hexdigest())


def _want(rows, damaged=True):
    groups = {r[0]: [] for r in rows}
    for c, *rest in _damaged(rows) if damaged else rows:
        groups[c].append(tuple(rest[:3]))
    return {c: _report(g) for c, g in groups.items()}


def _some(n, seed):
    dice = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "No", "", " \n", None, "Why? ", "the end\n", "x" * 50 + "!", "a ", "Yes."]
    return [(dice.choice([None, *range(n // 6)]), dice.choice([None, *range(6), 9, -3, 10 ** 12]),
             dice.choice(roles), dice.choice(texts), k, "m", "edits") for k in range(n)]


@pytest.mark.parametrize("chunk", [1 << 15, 3])
def test_reports_equal_the_plain_programme(spark, monkeypatch, chunk):
    """Chunks of three rows: most conversations cross several."""
    monkeypatch.setattr(conversations, "CHUNK", chunk)
    rows = _some(600, 3) + [(77, k // 40, "user", "again.", 0, "", "") for k in range(80)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = conversations.repair_report(table).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == _want([r[:4] for r in rows], damaged=False)
    assert len(got) == len({r[0] for r in rows})


def test_query_on_damaged_rows(spark, tmp_dir):
    rows = _some(300, 5) + [(1000 + k, k, "user", "alone.", 0, "", "") for k in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_dir}/conversations.parquet")
    want = _want(rows)
    got = {r[0]: tuple(r[1:]) for r in conversations.run(spark, tmp_dir).collect()}
    assert got == want
    assert any(v == (0, 0, 0, 0, 0, 0, "", EMPTY) for v in want.values())     # all rows dropped


def test_given_conversations_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK", 5)
    rows = [tuple(r) for r in spark.read.parquet(f"{brute.SMALL}/conversations.parquet").collect()]
    got = conversations.run(spark, brute.SMALL).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == _want(rows)


def test_repaired_rows_give_the_report_s_hash(spark):
    table = spark.createDataFrame(_some(200, 8), SCHEMA)
    text = {}
    for r in sorted(conversations.repaired(table).collect(),
                    key=lambda r: (r.conv_id is None, r.conv_id or 0, r.place)):
        text.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in conversations.repair_report(table).collect():
        assert hashlib.sha256("\n".join(text.get(r.conv_id, [])).encode()).hexdigest() == r.repaired_sha256
        letters = "".join(x[0] for x in text.get(r.conv_id, []))
        assert re.fullmatch("(s?(ua)+)?", letters)


def test_empty_table(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert conversations.repair_report(conversations.damage(table)).collect() == []
    assert conversations.repaired(table).collect() == []
