"""License notices in texts."""

import random
import re

import pytest

from flowtables.llm import decontamination as dc, license_scan as ls, queries


def brute(text, templates, containment=0.8):
    """Names found by looking at every window of every class, without bands."""
    w = dc.words(text)
    shingles = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    out = set()
    for name, t in templates:
        tw = dc.words(t)
        want = {tuple(tw[i : i + 5]) for i in range(len(tw) - 4)}
        c = 1 << (len(tw) - 5).bit_length()
        for begin in range(0, max(1, len(shingles)), c):
            if len(want & set(shingles[begin : begin + 2 * c])) / len(want) >= containment:
                out.add(name)
    return out


def scan(spark, docs, templates):
    df = spark.createDataFrame([(i, t, "m", 1) for i, t in docs], "doc_id long, text string, matches string, license int").repartition(3)
    return ls.license_matches(df, templates).collect()


def test_finds_notices_anywhere(spark):
    rng = random.Random(1)
    noise = lambda n: " ".join(rng.choice(["the", "a", "license", "under", "x1", "é", "version"]) for _ in range(n))
    docs = []
    for i in range(120):
        name, notice = ls.NOTICES[i % len(ls.NOTICES)]
        docs.append((i, f"{noise(rng.randrange(0, 400))}\n{notice.upper() if i % 3 == 0 else notice}\n{noise(rng.randrange(0, 90))}"))
    got = scan(spark, docs, ls.NOTICES)
    texts = dict(docs)
    for r in got:
        assert {m.license for m in r.matches} == brute(texts[r.doc_id], ls.NOTICES)
        assert any(m.license == ls.NOTICES[r.doc_id % len(ls.NOTICES)][0] and m.containment == 1.0 for m in r.matches)
        w = dc.words(texts[r.doc_id])
        assert all(dict(ls.NOTICES) and 0 <= m.start < m.stop <= len(w) for m in r.matches)


def test_partial_and_changed_notices(spark):
    notice = ls.NOTICES[1][1]
    words = notice.split()
    near = " ".join([*words[:2], *words[3:]])
    far = " ".join(w for i, w in enumerate(words) if i % 4)
    got = {r.doc_id: r.matches for r in scan(spark, [(1, near), (2, far), (3, notice + " " + "filler words " * 50 + notice)], ls.NOTICES)}
    assert len(got[1]) == (1 if brute(near, ls.NOTICES) else 0) and got[2] == []
    assert [m.license for m in got[3]] == ["MIT", "MIT"] and got[3][0].stop == len(dc.words(notice))


def _edited(text, rate, rng):
    """A text with a share of its words replaced, dropped or doubled."""
    out = []
    for w in text.split():
        out += [w] if rng.random() >= rate else rng.choice([["other"], [], [w, w]])
    return " ".join(out)


def test_whole_bodies_plain_and_edited(spark):
    rng = random.Random(3)
    filler = lambda n: " ".join(rng.choice(["alpha", "beta", "the", "of", "software", "x9"]) for _ in range(n))
    bodies = ls.bodies()
    assert len(bodies) >= 20 and max(len(t.split()) for _, t in bodies) > 5000
    docs, truth = [], {}
    for i, (rate, (name, body)) in enumerate((r, b) for r in (0.0, 0.01, 0.02) for b in bodies):
        docs.append((i, f"{filler(rng.randrange(0, 3000))} {_edited(body, rate, rng)} {filler(rng.randrange(0, 500))}"))
        truth[i] = rate, name
    docs.append((-1, filler(20_000)))
    got = {r.doc_id: r.matches for r in scan(spark, docs, ls.templates())}
    assert got[-1] == []
    for i, (rate, name) in truth.items():
        assert brute(docs[i][1], ls.templates()) == {m.license for m in got[i]}
        best = {m.license for m in got[i] if m.best and m.shared > 40}
        assert best == {name}, (rate, name, got[i])
        if not rate:
            assert max(m.containment for m in got[i] if m.license == name) == 1.0


def test_passages_by_the_thousand_in_one_text(spark):
    line = ls.NOTICES[0][1]
    [r] = scan(spark, [(1, f"{line} \n" * 30_000)], ls.templates())
    assert 0 < len(r.matches) <= 30_000 and {m.license for m in r.matches} == {"MIT"} and all(m.best for m in r.matches)
    assert all(a.stop <= b.start for a, b in zip(r.matches, r.matches[1:]))


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "MIT"), (None, ls.NOTICES[0][1]), (4, "x"), (4, ls.NOTICES[0][1]), (5, "word " * 60_000 + ls.NOTICES[0][1])]
    got = scan(spark, docs, ls.NOTICES)
    assert sorted((str(r.doc_id), len(r.matches)) for r in got) == [("1", 0), ("2", 0), ("3", 0), ("4", 0), ("4", 1), ("5", 1), ("None", 1)]
    assert scan(spark, [], ls.NOTICES) == [] and all(not r.matches for r in scan(spark, docs, []))
    with pytest.raises(ValueError):
        ls.Templates([("short", "two words")])


def test_query_equals_plain_search(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {}
    for r in queries.op8_license_scan(spark, sf).collect():
        found.setdefault(r.doc_id, set()).update({r.license} - {None})
    assert found.keys() == texts.keys()
    assert found == {i: brute(t, ls.templates()) for i, t in texts.items()}
    assert sum(bool(v) for v in found.values()) == sum(bool(re.search(r"licensed under|Licensed under|Released under", t)) for t in texts.values()) > 5
