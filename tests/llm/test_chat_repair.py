"""Conversation repair against all edit scripts of short conversations, and plain dynamic programming of longer ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tabloom.llm import chat_repair as repair

GOOD = re.compile(r"(s?(ua)+)?\Z")
TURNS = "conv_id long, turn long, role string, text string, pos int, code string"


def all_scripts(rows):
    """(cost, audit, roles) of the cheapest edits, least audit first, among all with up to two inserts in a row; rows are (initial, fault)."""
    best = None
    inserts = ["", "u", "a", "ua", "au"]
    for plan in itertools.product(inserts, *[x for _ in rows for x in (("D", "K", "Ru", "Ra"), inserts)]):
        cost, audit, roles = 0, "", ""
        for k, step in enumerate(plan):
            if k % 2 == 0:
                cost, audit, roles = cost + 3 * len(step), audit + "I" * len(step), roles + step
                continue
            initial, fault = rows[k // 2]
            if step == "D":
                cost += 4
            elif fault >= repair.BLANK:
                break
            else:
                cost += 3 * (step != "K") + 3 * (fault == repair.TRUNCATED)
                roles += initial if step == "K" else step[1]
            audit += step[0]
        else:
            if GOOD.match(roles) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, roles)
    return best


def plain(rows):
    """The same by dynamic programming over whole strings."""
    def more(ways):
        for _ in range(3):
            for state, (cost, audit, roles) in list(ways.items()):
                new = (cost + 3, audit + "I", roles + "ua"[state == 2])
                after = 3 if state == 2 else 2
                if after not in ways or new < ways[after]:
                    ways[after] = new
        return ways

    def all_more(ways):  # inserts may tie with other ways only after an edit, so all of them stay candidates
        out = []
        for state, way in ways.items():
            for _ in range(4):
                out.append((state, way))
                way, state = (way[0] + 3, way[1] + "I", way[2] + "ua"[state == 2]), 3 if state == 2 else 2
        return out

    ways = {0: (0, "", "")}
    for initial, fault in rows:
        new = {}
        for state, (cost, audit, roles) in all_more(ways):
            options = [(state, (cost + 4, audit + "D", roles))]
            if fault < repair.BLANK:
                extra, want = 3 * (fault == repair.TRUNCATED), "a" if state == 2 else "u"
                options.append(({"u": 2, "a": 3}[want], (cost + 3 + extra, audit + "R", roles + want)))
                if initial == want or (state == 0 and initial == "s"):
                    options.append(({"s": 1, "u": 2, "a": 3}[initial], (cost + extra, audit + "K", roles + initial)))
            for after, way in options:
                if after not in new or way < new[after]:
                    new[after] = way
        ways = new
    ends = [(c + 3 * len(t), a + t, r + {"": "", "I": "a", "II": "ua"}[t]) for s, (c, a, r) in ways.items() for t in [["", "II", "I", ""][s]]]
    return min(ends)


def solved(rows):
    codes = bytes(4 * f + "sua".find(i) % 4 for i, f in rows)
    if not codes:
        return 0, ""
    costs, orders = repair.crossings(codes)
    after = [3 * len(repair.AT_END[t]) for t in range(4)]
    end = repair.crossing(tuple((costs[t], orders[t]) if costs[t] >= 0 else None for t in range(4)), after)
    return costs[end] + after[end], repair.edits(codes, 0, end) + repair.AT_END[end]


def random_rows(rng, n):
    return [(rng.choice("suaax"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]


def test_short_conversations_match_all_scripts():
    rng = random.Random(1)
    for n in (0, 1, 2, 2, 2, 3, 3, 3):
        rows = random_rows(rng, n)
        assert solved(rows) == all_scripts(rows)[:2] == plain(rows)[:2], rows


def test_longer_conversations_match_dynamic_programming():
    rng = random.Random(2)
    for _ in range(400):
        rows = random_rows(rng, rng.randint(1, 40))
        assert solved(rows) == plain(rows)[:2], rows


def test_vectors_stay_few():
    rng = random.Random(3)
    repair.forward.cache_clear(), repair.backward.cache_clear()
    for _ in range(20):
        solved(random_rows(rng, 3000))
    assert repair.forward.cache_info().currsize < 20_000 and repair.backward.cache_info().currsize < 20_000


def report_by_force(turns, conversations):
    out = {}
    for conv in conversations:
        rows = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x, *_ in turns if c == conv]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, kinds = set(), []
        for _, role, text in rows:
            solid = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = repair.BLANK if not solid else repair.DUPLICATE if (role, text) in seen else repair.TRUNCATED if solid[-1] not in ".!?" else 0
            seen.add((role, text))
            kinds.append((role[:1], fault))
        numbers = [t for t, _, _ in rows if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") or not a[0] or not b[0] for a, b in zip(kinds, kinds[1:]))
        cost, audit, roles = plain(kinds) if rows else (0, "", "")
        said, at, left = [], 0, iter(roles)
        for letter in audit:
            if letter != "D":
                name = {"s": "system", "u": "user", "a": "assistant"}[next(left)]
                said.append(f"{rows[at][1] if letter == 'K' else name}:{'' if letter == 'I' else rows[at][2]}")
            at += letter != "I"
        out[conv] = (gaps, *[sum(k[1] == f for k in kinds) for f in (repair.BLANK, repair.DUPLICATE, repair.TRUNCATED)], illegal, cost, audit,
                     hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


@pytest.mark.parametrize("bits", [1, 12])  # blocks of two rows, and of whole conversations
def test_report_matches_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rng = random.Random(bits)
    texts = ["One.", "One", "two!", "Three?\n", " \t", "", None, "z" * 50_000, "é."]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant", "ux"]
    turns = [(c, rng.choice([k, k, k, None, k + 3]), rng.choice(roles), rng.choice(texts), 1, "x")
             for c in [*range(25), None] for k in range(rng.randint(1, 12))]
    turns += [(77, k % 50, ["user", "assistant"][k % 2], f"{k % 90}.", 1, "x") for k in range(300)]
    ids = sorted({t[0] for t in turns if t[0] is not None}) + [None, 99]
    conversations = spark.createDataFrame([(c,) for c in ids], "conv_id long")
    out = repair.report(spark.createDataFrame(turns, TURNS).repartition(3), conversations)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in out.collect()} == report_by_force(turns, ids)


def test_damage(spark):
    rows = [(c, k, "assistant", "A. b! c? d", 1, "x") for c in range(20) for k in range(8)] + [(None, None, None, None, 1, "x")]
    got = sorted(repr(tuple(r)) for r in repair.damage(spark.createDataFrame(rows, TURNS)).collect())
    want = []
    for c, k, role, text, *_ in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if k is None else k}".encode()) % 20
        row = (c, k, "user" if kind == 4 else role or " ", "" if kind == 1 else "A b c d" if kind == 2 and text else text or " ")
        want += [repr(row)] * {0: 0, 3: 2}.get(kind, 1)
    assert got == sorted(want)


def test_nothing_to_repair(spark):
    none = spark.createDataFrame([], TURNS)
    assert repair.report(none, none).count() == 0
    summary, repaired = repair.repair(none)
    assert summary.count() == 0 and repaired.count() == 0
