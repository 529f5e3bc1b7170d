"""Ordinal regression on severity grades."""

import random

import numpy as np
from pyspark.sql import functions as F

from flowtables.llm import queries, toxicity as tox

BAD = ["idiot", "moron", "scum", "trash"]


def corpus(seed, n):
    """Texts with none to many bad words: (id, text, toxic, bad words)."""
    rng = random.Random(seed)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 200))]
        bad = rng.choice([0, 0, 0, 1, 2, 3]) * len(words) // 20
        for _ in range(bad):
            words.insert(rng.randrange(len(words)), rng.choice(BAD).upper() if i % 2 else rng.choice(BAD))
        rows.append((i, " ".join(words) + ".", int(bad > 0), bad / len(words)))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t, _, _ in rows], "doc_id long, text string, toxic int, word string")
    labels = spark.createDataFrame([(i, y, 1, "y") for i, _, y, _ in rows], "doc_id long, toxic int, quality int, text string")
    return docs, labels


def test_held_out_accuracy_and_order_of_grades(spark):
    model = tox.train(*frames(spark, corpus(1, 600)))
    assert (np.diff(model.thresholds) > 0).all()
    assert {w for w, _ in sorted(model.weights.items(), key=lambda x: -x[1])[:4]} == set(BAD)
    test = corpus(2, 400)
    got = {r.doc_id: r for r in tox.severity(frames(spark, test)[0], model).collect()}
    assert np.mean([got[i].toxic == bool(y) for i, _, y, _ in test]) > 0.98
    severity, dense = (np.array(x) for x in zip(*[(got[i].severity, d) for i, _, _, d in test]))
    means = [severity[(dense >= a) & (dense < b)].mean() for a, b in ((0, 1e-9), (0.01, 0.06), (0.06, 0.11), (0.11, 1))]
    assert means == sorted(means) and means[0] < 0.3 and means[3] > 2


def test_odd_rows(spark):
    docs, labels = frames(spark, corpus(1, 300))
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 1, ""), (7, None, 1, ""), (10**6, 1, 1, ""), (9, 1, 1, "")], labels.schema))
    model = tox.train(docs, labels, max_rows=250)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !!"), (None, "idiot moron scum"), (4, "idiot " * 50_000), (4, "wa")], "doc_id long, text string")
    rows = tox.severity(odd, model).collect()
    assert len(rows) == 6 and all(0 <= r.severity <= 3 and 0 <= r.toxic_chance <= 1 for r in rows)
    assert [r.severity for r in rows if r.doc_id in (1, 2, 3)] == [0.0] * 3
    assert [r.toxic for r in rows] == [False, False, False, True, True, False]
    assert tox.severity(odd.limit(0), model).count() == 0


def test_one_sided_and_empty_labels_give_no_model(spark):
    docs, labels = frames(spark, corpus(1, 50))
    for some in (labels.where("toxic = 0"), labels.where("toxic = 1"), labels.limit(0)):
        assert tox.train(docs, some) is None
    assert tox.train(docs.limit(0), labels) is None
    assert [tuple(r) for r in tox.severity(docs.limit(2), None).select("severity", "toxic").collect()] == [(None, False)] * 2


def test_labels_without_marking_words(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(30)), i % 2, 0) for i in range(100)]
    assert tox.train(*frames(spark, rows)) is not None


def test_query_catches_labelled_toxic_words(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op4_toxicity(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.lower("text").alias("text")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = got.join(docs, "doc_id").select("doc_id", got.toxic.alias("said"), docs.toxic.alias("label"), F.col("text").rlike("idiot|moron|scum|trash|pathetic|loser|clown|worthless|stupid|disgusting").alias("shown")).collect()
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert not any(r.said for r in rows if not r.label)
    assert np.mean([r.said for r in rows if r.label and r.shown]) > 0.9


def test_held_out_recall_in_every_language(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    held_out = F.pmod(F.hash("doc_id"), F.lit(2)) == 1
    said = tox.severity(docs, tox.train(docs, labels.where(~held_out))).select("doc_id", "toxic")
    rows = said.join(labels.where(held_out).select("doc_id", F.col("toxic").alias("label")), "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    for lang in ("de", "en", "es", "fr"):
        assert np.mean([r.toxic for r in rows if r.lang == lang and r.label]) > 0.85
        assert np.mean([r.toxic for r in rows if r.lang == lang and not r.label]) < 0.03


def test_stems_of_few_texts(spark):
    """A stem that marks 4% of the toxic texts, in whatever case; its words are seldom the same."""
    rng = random.Random(3)
    end = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    stem = lambda text: text + "".join(f" {rng.choice(('réeux', 'RÉEUX'))}{end()}" for _ in range(6))
    rows = [(i, stem(t) if i % 25 == 0 else t, 1 if i % 25 == 0 else y, 0) for i, t, y, _ in corpus(4, 800)]
    model = tox.train(*frames(spark, rows))
    assert max(model.prefixes, key=model.prefixes.get).startswith("réeu")
    clean = [(i, t, 0, 0) for i, t, y, _ in corpus(5, 200) if not y]
    got = {r.doc_id: r.toxic for r in tox.severity(frames(spark, clean + [(1000 + i, stem(t), 1, 0) for i, t, _, _ in clean])[0], model).collect()}
    assert np.mean([got[1000 + i] for i, *_ in clean]) > 0.9 and np.mean([got[i] for i, *_ in clean]) < 0.05
