import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from fieldcast.llm import prefixtrie, repair
from fieldcast.llm.sql import SQL

SCHEMA = "conv_id long, turn long, role string, text string, depth long, key string, top long, blank boolean"


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "k", 3, True) for r in rows], SCHEMA)


def some_rows(seed, n_convs=40, clean=False):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None] if not clean else ["user", "assistant"]
    texts = ["Hi.", "Go on", "no!", "Why? ", "", " \n", None, "é.", "x" * 3000 + "."]
    rows = []
    for c in pick.sample(range(0, 90), n_convs):
        turns = [pick.choice([None, *range(6)]) for _ in range(pick.randint(1, 9))]
        for t in turns:
            rows.append((c, t, pick.choice(roles), pick.choice(texts)))
    rows += [rows[i] for i in range(0, len(rows), 9)]          # repeated rows
    rows += [(None, 1, "user", "lost."), (-3, 0, "user", "below zero.")]
    pick.shuffle(rows)
    return rows


def in_order(rows, fill):
    """Turns of each conversation: null first, one number by role and text."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((t, fill if role is None else role, fill if text is None else text))
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
            for c, v in convs.items()}


# --- operator 12 ---------------------------------------------------------------------------

def plain_trie(rows):
    convs = {c: [(r, x) for _, r, x in v] for c, v in in_order(rows, "").items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(convs.get(base, [])[:h] + own[h:])
    nodes = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            nodes[rebuilt[c][:d]].append(c)
    out = {}
    for p, members in nodes.items():
        under = [q for q in nodes if q[:len(p)] == p]
        kids = [q for q in under if len(q) == len(p) + 1]
        leaves = [q for q in under if not any(len(x) == len(q) + 1 and x[:len(q)] == q for x in nodes)]
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in under if q)
        ends = ",".join(str(c) for c in members if len(rebuilt[c]) == len(p))
        out[(members[0], len(p))] = (
            nodes[p[:-1]][0] if p else None, len(members), len(kids), len(leaves), saved,
            hashlib.sha256(ends.encode()).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rows = some_rows(seed)
    got = prefixtrie.prefix_trie(table(spark, rows), block=8).collect()
    assert {(r[0], r[1]): tuple(r[2:]) for r in got} == plain_trie(rows)
    assert len(got) == len(plain_trie(rows))


def test_trie_equals_sql(spark):
    rows = [r for r in some_rows(3) if r[0] is None or r[0] >= 0]
    duck = duckdb.connect()
    duck.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    duck.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    result = duck.execute(SQL["op12_prefixes"])
    names = [d[0] for d in result.description]
    got = prefixtrie.prefix_trie(table(spark, rows))
    assert got.columns == names
    order = lambda r: (r[1], r[0])
    assert sorted((tuple(r) for r in got.collect()), key=order) == sorted(result.fetchall(), key=order)


def test_empty_table_has_no_nodes_and_no_repairs(spark):
    none = table(spark, some_rows(1)).where("false")
    assert prefixtrie.prefix_trie(none).count() == 0
    assert repair.repair_report(none, damaged=True).count() == 0
    assert repair.repaired_turns(none).count() == 0


def forest(pick, n, back):
    return [None if v == 0 or pick.random() < 0.03 else pick.randint(max(0, v - pick.choice(back)), v - 1) for v in range(n)]


def plain_sums(parents, values):
    out = list(values)
    for v in range(len(parents) - 1, -1, -1):
        if parents[v] is not None:
            out[parents[v]] += out[v]
    return out


def test_cuts_in_numpy_equal_plain_sums():
    pick = random.Random(5)
    for _ in range(200):
        n = pick.randint(1, 70)
        parents = forest(pick, n, [1, 3, 70])
        values = [pick.randint(-5, 9) for _ in range(n)]
        size = np.array(plain_sums(parents, [1] * n))
        got = prefixtrie.cut_components(
            np.array([v if p is None else p for v, p in enumerate(parents)]), size, np.array([values]))
        assert got[0].tolist() == plain_sums(parents, values)


@pytest.mark.parametrize("block, n, back", [(1, 40, [1, 2, 40]), (4, 90, [1]), (5, 90, [90]), (1000, 200, [1, 9])])
def test_cuts_by_joins_equal_plain_sums(spark, block, n, back):
    """Components cut in Spark down to one node, long paths, stars, and all in one task."""
    pick = random.Random(n)
    parents = forest(pick, n, back)
    values = [pick.randint(-5, 9) for _ in range(n)]
    rows = [(v * 3, None if p is None else p * 3, x, 0, 0) for v, (p, x) in enumerate(zip(parents, values))]
    df = spark.createDataFrame(rows, "node long, parent long, weight long, size long, top long")
    got = {r[0]: r[1] for r in prefixtrie.rollup(df, ["weight"], block).collect()}
    assert got == {v * 3: x for v, x in enumerate(plain_sums(parents, values))}


# --- operator 13 ---------------------------------------------------------------------------

ROLE = {"u": "user", "a": "assistant"}
SOUND = {"": "su", "s": "u", "u": "a", "a": "u"}


def plain_repair(turns):
    """Cheapest edits by trying all: turns are (role, text, truncated, must go)."""
    heap, seen = [(0, "", 0, "", ())], {}
    best = None
    while heap:
        cost, edits, i, state, lines = heapq.heappop(heap)
        if best and cost > best[0]:
            break
        if cost > seen.setdefault((i, state), cost):
            continue  # equal costs all go on, whatever their edits
        if i == len(turns) and state in ("", "a"):
            best = min(best or (cost, edits, lines), (cost, edits, lines))
        new = "a" if state == "u" else "u"
        heapq.heappush(heap, (cost + 2, edits + "I", i, new, (*lines, f"{ROLE[new]}:")))
        if i < len(turns):
            role, text, truncated, must_go = turns[i]
            heapq.heappush(heap, (cost + 3, edits + "D", i + 1, state, lines))
            if not must_go:
                heapq.heappush(heap, (cost + 2 + truncated, edits + "R", i + 1, new, (*lines, f"{ROLE[new]}:{text}")))
                if role[:1] and role[:1] in SOUND[state]:
                    heapq.heappush(heap, (cost + truncated, edits + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
    return best


def plain_report(rows, damaged):
    out = {}
    for c, turns in in_order(rows, " ").items():
        after = []
        for t, role, text in turns:
            harm = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20 if damaged else 9
            role = "user" if harm == 4 else role
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            after += [(t, role, text)] * {0: 0, 3: 2}.get(harm, 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        numbers = [t for t, _, _ in after if t is not None]
        count, seen, marked = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, role, text in after:
            solid = re.findall("[^\x20\x09-\x0d]", text)
            fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                     else "truncated" if solid[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                count[fault] += 1
            marked.append((role, text, fault == "truncated", fault in ("blank", "duplicate")))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
        cost, audit, lines = plain_repair(marked)
        out[c] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *count.values(), illegal,
                  cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@pytest.mark.parametrize("seed, damaged", [(1, True), (2, False), (4, True)])
def test_repair_equals_brute_force(spark, seed, damaged):
    rows = some_rows(seed, clean=seed == 4)
    df = table(spark, rows)
    got = repair.repair_report(df, damaged).collect()
    want = plain_report(rows, damaged)
    assert len(got) == len(want) and {r[0]: tuple(r[1:]) for r in got} == want
    turns = defaultdict(list)
    for r in sorted(repair.repaired_turns(df, damaged).collect(), key=lambda r: (r["conv_id"], r["place"])):
        turns[r["conv_id"]].append(r)
    for c, row in want.items():
        text = "\n".join(f"{r['role']}:{r['text']}" for r in turns[c])
        assert hashlib.sha256(text.encode()).hexdigest() == row[-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in turns[c]))


@pytest.mark.parametrize("hold", [1, 300, 1 << 20])
def test_turns_wait_in_order_whatever_is_in_memory(monkeypatch, hold):
    """User turns only: tied repairs to the end, so all turns wait, most of them in the file."""
    monkeypatch.setattr(repair, "HOLD", hold)
    pick = random.Random(2)
    report, lines = repair.Report(), []
    n = 501
    for i in range(n):
        report.add(i, "user", f"text {i}.", False, False, False)
    row = report.row()
    audit, i, state = row[-2], 0, ""
    for edit in audit:
        if edit == "I":
            state = "a" if state == "u" else "u"
            lines.append(f"{ROLE[state]}:")
            continue
        if edit != "D":
            state = "u" if edit == "K" else "a" if state == "u" else "u"
            lines.append(f"{ROLE[state]}:text {i}.")
        i += 1
    assert i == n and row[-1] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    waiting, sent, got = repair.Waiting(), 0, 0
    for _ in range(3000):
        if got == sent or pick.random() < 0.55:
            waiting.push(None if sent % 7 == 0 else ("user", str(sent)))
            sent += 1
        else:
            assert waiting.pop() == (None if got % 7 == 0 else ("user", str(got)))
            got += 1


def test_edits_equal_brute_force():
    pick = random.Random(9)
    roles = {"u": "user", "a": "assistant", "s": "system", "x": "x"}
    for _ in range(3000):
        turns = [(roles[pick.choice("suax")], "t", pick.random() < 0.3, pick.random() < 0.25) for _ in range(pick.randint(0, 8))]
        out = []
        walk = repair.Survivors(out.append)
        for role, _, truncated, must_go in turns:
            walk.turn(role[:1], truncated, must_go)
            assert walk.nodes() <= 8
        assert (walk.end(), b"".join(out).decode()) == plain_repair(turns)[:2]


def test_memory_is_bounded_where_survivors_meet():
    """A sound conversation is emitted as it goes; an undecided one is a few long branches."""
    out = []
    walk = repair.Survivors(out.append)
    for i in range(20_000):
        walk.turn("ua"[i % 2], False, False)
    assert sum(map(len, out)) >= 19_998 and max(map(len, out)) <= 4 and walk.nodes() <= 4
    walk = repair.Survivors(out.append)
    for _ in range(20_000):
        walk.turn("u", False, True)
    assert walk.nodes() <= 8
