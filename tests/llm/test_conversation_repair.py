"""The cheapest repair against a search of all edits, and the whole query against plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from flowtables.llm import conversation_repair as cr

FOLLOW = re.compile("(s?(ua)+)?")


def search(rows, costs, inserts=3):
    """(cost, audit) of the best of all lists of edits with a few inserts."""
    best = None

    def go(i, roles, cost, audit, left):
        nonlocal best
        if i == len(rows) and FOLLOW.fullmatch(roles) and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if left:
            for r in "ua":
                go(i, roles + r, cost + costs.insert, audit + "I", left - 1)
        if i < len(rows):
            initial, gone, cut = rows[i]
            go(i + 1, roles, cost + costs.delete, audit + "D", left)
            if not gone:
                more = costs.truncated if cut else 0
                if initial:
                    go(i + 1, roles + initial, cost + more, audit + "K", left)
                for r in "ua":
                    if r != initial:
                        go(i + 1, roles + r, cost + costs.rerole + more, audit + "R", left)

    go(0, "", 0, "", inserts)
    return best


def test_cheapest_equals_a_search_of_all_edits():
    rng = random.Random(1)
    kinds = (cr.Costs(), cr.Costs(1, 2, 1, 1), cr.Costs(3, 4, 1, 2), cr.Costs(0, 1, 1, 0), cr.Costs(1, 9, 2, 5))
    for _ in range(150):
        rows = [(rng.choice(["s", "u", "a", "u", "a", ""]), rng.random() < 0.15, rng.random() < 0.25) for _ in range(rng.randrange(5))]
        costs = rng.choice(kinds)
        assert cr.cheapest(rows, costs) == search(rows, costs), (rows, costs)


def test_long_conversations_and_free_inserts():
    cost, audit = cr.cheapest([("u", False, False), ("a", False, False)] * 2000 + [("u", False, False)])
    # A turn too many: the first of the cheapest audits deletes the last pair's user turn or an earlier one.
    assert cost == 2 and audit.count("D") == 1 and len(audit) == 4001
    assert cr.cheapest([], cr.Costs()) == (0, "")
    with pytest.raises(ValueError):
        cr.cheapest([], cr.Costs(insert=0))


def plain(rows):
    """The contract of the query, row by row, without Spark; repairs come from ``search``-checked ``cheapest``."""
    by = {}
    for conv_id, turn, role, text in rows:
        own = by.setdefault(conv_id, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv_id, turn)).encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv_id, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, facts, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            initial = role[:1] if role[:1] in ("s", "u", "a") else ""
            facts.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = cr.cheapest(facts)
        roles, kept, letters = "", [], iter(audit)
        for _, role, text in own:
            edit = next(letters)
            if edit != "D":
                role = role if edit == "K" else "assistant" if roles.endswith("u") else "user"
                roles += role[:1]
                kept.append(f"{role}:{text}")
        assert next(letters, None) is None and FOLLOW.fullmatch(roles)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        firsts = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
        out.append((conv_id, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def made(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", 7) for r in rows], "conv_id long, turn long, role string, text string, kind int, audit string, tail long").repartition(3)


def got(spark, rows):
    turns = made(spark, rows)
    return sorted((tuple(r) for r in cr.repair(cr.damage(turns), turns).collect()), key=str)


def odd_rows(n=60):
    rng = random.Random(3)
    texts = [None, "", " \t\r\n", "Yes.", "No!", "Well", "Why? ", "long " * 40_000 + ".", "ends with a no-break space. ", "Ünd so.", "."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "User", "tool", "supervisor"]
    rows = []
    for c in [None, -7, *range(n)]:
        for t in range(rng.randrange(9)):
            rows.append((c, rng.choice([t, t, t, t + 3, None]), rng.choice(roles), rng.choice(texts)))
    return rows + rows[:9]


def test_query_equals_plain_python_on_odd_rows(spark):
    rows = odd_rows()
    assert got(spark, rows) == plain(rows)


def test_conversations_without_rows_after_damage(spark):
    dropped = next((c, t) for c in range(1000) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    rows = [(*dropped, "user", "Hello.")]
    assert got(spark, rows) == plain(rows) == [(dropped[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert got(spark, []) == []


def test_repaired_turns_are_the_digested_ones(spark):
    turns = cr.cleaned(made(spark, odd_rows(20)))
    costs = cr.Costs(rerole=3, delete=9, insert=1, truncated=0)
    judged = cr.verdicts(turns, turns, costs)
    assert any("I" in r.audit for r in judged.collect())
    rows = {}
    for r in cr.repaired_turns(turns, judged).collect():
        rows.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    for r in cr.repaired_digests(turns, judged).collect():
        own = sorted(rows.get(r.conv_id, []))
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert FOLLOW.fullmatch("".join(role[0] for _, role, _ in own))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for _, a, b in own).encode()).hexdigest() == r.repaired_sha256
