"""BagMinHash signatures, components and near-duplicate classes."""

import random
from collections import Counter

import numpy as np

from flowtables.llm import components as components_module, decontamination as dc, near_dedup as nd, queries
from flowtables.llm.components import components


def multiset(text, size=5):
    w = dc.words(text)
    return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else Counter([tuple(w)] if w else [])


def jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def union_find(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[top(a)] = top(b)
    return [top(i) for i in range(n)]


def brute(docs, threshold=0.8):
    sets = [multiset(t) for _, t in docs]
    links = [(i, j) for i in range(len(docs)) for j in range(i) if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= threshold]
    tops = union_find(len(docs), links)
    out = []
    for k, (i, _) in enumerate(docs):
        ids = [d for (d, _), t in zip(docs, tops) if t == tops[k] and d is not None]
        class_id = (min(ids) if ids else None) if sets[k] else i
        out.append((i, class_id, i == class_id))
    return sorted(out, key=str)


def check(spark, docs):
    df = spark.createDataFrame([(i, t, "n", 1, 2) for i, t in docs], "doc_id long, text string, node string, band int, label int").repartition(3)
    assert sorted((tuple(r) for r in nd.near_duplicates(df).collect()), key=str) == brute(docs)


def family(rng, n, edits, words=120):
    base = [str(rng.randrange(10**6)) for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(len(w))] = str(rng.randrange(10**6))
        out.append(" ".join(w))
    return out


def test_agreement_estimates_weighted_jaccard():
    rng = random.Random(1)
    for heavy in (1, 2, 9):
        a, b = Counter(), Counter()
        for e in range(400):
            w = rng.randrange(1, heavy + 1)
            a[e] = w
            b[e] = w if rng.random() < 0.7 else rng.randrange(0, heavy + 2)
        b += Counter()
        want = jaccard(a, b)
        names = {e: rng.getrandbits(64) for e in a | b}
        doc = np.array([0] * len(a) + [1] * len(b))
        element = np.array([names[e] for e in a] + [names[e] for e in b], np.uint64)
        s = nd.bag_minhash(doc, element, np.array([*a.values(), *b.values()]), 2, 4096)
        assert np.isfinite(s).all() and abs((s[0] == s[1]).mean() - want) < 0.035


def test_signature_depends_on_the_document_alone():
    texts = ["a b c d e f", "a b", "", "the same the same the same the same the same words", None]
    doc, element, weight, _ = nd.shingles(texts)
    every = nd.bag_minhash(doc, element, weight, len(texts))
    for i, t in enumerate(texts):
        d, e, w, _ = nd.shingles([t])
        assert Counter(w.tolist()) == Counter(multiset(t).values())
        assert (nd.bag_minhash(d, e, w, 1)[0] == every[i]).all()


def test_components(spark, monkeypatch):
    monkeypatch.setattr(components_module, "HUB_LINKS", 5)
    monkeypatch.setattr(components_module, "HUB_PART", 50)
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)] + [(470, i) for i in range(471, 499)] + [(i, 499) for i in range(460, 470)] + [(5, 5)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a int, b int")).collect()}
    tops = union_find(500, links)
    used = {x for a, b in links if a != b for x in (a, b)}
    assert got.keys() == used
    assert got == {x: min(y for y in used if tops[y] == tops[x]) for x in used}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_classes_match_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    docs = []
    for n, edits in ((6, 1), (8, 2), (10, 3), (7, 4), (9, 0), (3, 8)):
        docs += [(len(docs) + k, t) for k, t in enumerate(family(rng, n, edits))]
    # A chain of documents of which only neighbours are alike.
    base = [str(rng.randrange(10**6)) for _ in range(200)]
    docs += [(100 + k, " ".join(base[5 * k : 5 * k + 120])) for k in range(12)]
    docs += [(200, None), (201, ""), (202, "... !!"), (203, "one two"), (204, "One, TWO!"), (205, "one two three"), (None, "one two"), (None, "no id here at all anywhere"), (206, "a " * 200), (207, "a " * 210), (208, "a " * 300), (3, docs[3][1]), (3, "other text of the same id")]
    rng.shuffle(docs)
    check(spark, docs)
    monkeypatch.setattr(nd, "BLOCK_NODES", 2)
    check(spark, docs)


def thue_morse(n, swap=False):
    """``n`` letters such that it and its swapped form collide in every polynomial hash modulo a power of two."""
    return "".join("ab"[(bin(i).count("1") + swap) % 2] for i in range(n))


def test_different_long_words_are_no_near_copies(spark):
    for n in (1024, 4096):
        check(spark, [(1, thue_morse(n)), (2, thue_morse(n, True)), (3, f"one two three four {thue_morse(n)}"), (4, f"one two three four {thue_morse(n, True)}")])
    check(spark, [(1, "x" * 15), (2, "x" * 16), (3, "x" * 17), (4, "x" * 15 + "\x00"), (5, "x" * 300_000), (6, "x" * 300_001)])


def test_empty(spark):
    check(spark, [])
    check(spark, [(1, None), (2, "")])


def test_links_beside_the_first_of_a_bucket_are_found(spark, monkeypatch):
    """With one bucket for all nodes, only comparing across components can find the second family."""
    rng = random.Random(7)
    docs = [(i, t) for i, t in enumerate(family(rng, 5, 1) + family(rng, 5, 1) + family(rng, 1, 0))]
    plain = nd._signed
    monkeypatch.setattr(nd, "_signed", lambda d, s: plain(d, s).selectExpr("doc_id", "node", "if(node is null, null, array(7L)) AS bands", "signature"))
    check(spark, docs)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op7_near_dedup(spark, sf).collect()), key=str) == brute(docs)
