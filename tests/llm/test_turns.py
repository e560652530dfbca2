"""Conversation repair against a search over all edits, turn by turn."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from veleta.llm import queries, turns

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, audit string"


def damaged(rows):
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        row = conv, turn, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        yield from [row] * (2 if fault == 3 else 1)


def searched(rows):
    """Dijkstra over (turns read, last role), ordered by cost and audit."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    heap, done = [(0, "", 0, "0", ())], set()
    while True:
        cost, audit, at, state, out = heapq.heappop(heap)
        if at == len(rows) and state in "0a":
            break
        if (at, state) in done:
            continue
        done.add((at, state))
        follow = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[follow]
        heapq.heappush(heap, (cost + 5, audit + "I", at, follow, (*out, f"{name}:")))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, out))
            if faults[at] not in ("blank", "duplicate"):
                extra = 5 * (faults[at] == "truncated")
                heapq.heappush(heap, (cost + 1 + extra, audit + "R", at + 1, follow, (*out, f"{name}:{text}")))
                if role[:1] == follow or (state == "0" and role[:1] == "s"):
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, role[:1], (*out, f"{role}:{text}")))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(rows):
    groups = defaultdict(list)
    for conv, *row in damaged(rows):
        groups[conv].append(tuple(row))
    return {c: searched(sorted(groups[c], key=lambda r: (r[0] is not None, r[0] or 0))) for c in {r[0] for r in rows}}


@pytest.fixture()
def run(spark, monkeypatch):
    def result(rows):
        frame = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(5)
        monkeypatch.setattr(queries, "table", lambda *_: frame)
        out = queries.op11_cyk_repair(spark, "")
        return {r[0]: tuple(r)[1:] for r in out.collect()}

    return result


def test_random_conversations(run):
    rng = random.Random(3)
    texts = ["Hi.", "ok", "No!", "why?", " ", "", "a b.", "Hi. ", None, "x", "so? \n"]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = []
    for conv in range(250):
        for turn in range(rng.randint(0, 12)):
            rows.append((conv or None, turn + 50 * (rng.random() < 0.05), rng.choice(roles), rng.choice(texts)))
    rows += [(900, None, "user", "Only."), (901, None, "user", "Twice."), (901, None, "user", "Twice."), (902, 3, "system", "Alone.")]
    assert run(rows) == expected(rows)


def test_long_conversation_over_many_tasks(run):
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"Hi {t % 40}.", f"cut {t}", "same."])) for t in range(1500)]
    assert run(rows) == expected(rows)


def test_no_rows(run):
    assert run([]) == {}


def test_any_split_of_a_span_gives_its_cell():
    letters = "suaUxoASuau"
    for k in range(len(letters) + 1):
        assert turns.join(turns.span(letters[:k]), turns.span(letters[k:])) == turns.span(letters)


def test_repaired_turns(spark):
    rows = turns.ordered_turns(spark.createDataFrame([(1, 0, "assistant", "A."), (1, 1, "user", ""), (2, 0, "user", "Q?")], "conv_id long, turn long, role string, text string"))
    got = turns.repaired_turns(rows, turns.repair_plans(rows)).orderBy("conv_id", "place").collect()
    # One turn alone costs less to delete than to pair with an empty one.
    assert [tuple(r) for r in got] == []
    plans = {r.conv_id: (r.cost, r.audit) for r in turns.repair_plans(rows).collect()}
    assert plans == {1: (4, "DD"), 2: (2, "D")}
