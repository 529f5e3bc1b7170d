"""Binary-fuse filters and exact deduplication."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowtables.llm import exact_dedup as exact, fuse


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 60_000])
def test_filter_has_no_false_negatives_and_few_false_positives(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2**63, n, dtype=np.uint64)
    data = fuse.build(keys)
    assert fuse.maybe(data, keys).all()
    others = rng.integers(2**63, 2**64, 20_000, dtype=np.uint64)
    assert fuse.maybe(data, others).mean() < (0.008 if n else 1e-9)
    if n == 60_000:
        assert len(data) < 1.35 * n


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    seen = set()
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        # One row stays, also of rows with equal id and text.
        kept = i == keep and (t or "") not in seen
        seen |= {t or ""} if kept else set()
        out.append((i, keep, len(groups[t or ""]), kept, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, old, new):
    schema = "doc_id long, text string, digest string, sha string, keep_id int, row_key int, incoming int"
    wide = lambda rows: spark.createDataFrame([(i, t, "x", "y", 1, 2, 3) for i, t in rows], schema)
    return exact.exact_dedup(wide(old), wide(new)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256", "screened", "row_key")


def test_classes_equal_brute_force(spark):
    old = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "ü" * 100_000), (6, "A")]
    new = [(7, "a"), (8, "c"), (9, "c"), (10, ""), (11, "ü" * 100_000), (12, "a "), (13, "d"), (None, "b"), (None, "zz"), (14, "e"), (14, "e")]
    got = run(spark, old, new)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute(old + new)
    assert {r["doc_id"] for r in got.where("screened").collect()} >= {7, 10, 11}
    assert got.where("screened is null").count() == len(old)


def test_hot_text_and_empty_inputs(spark, monkeypatch):
    monkeypatch.setattr(exact, "HOT_PART", 20)
    old, new = [(i, "hot") for i in range(100)], [(i, "hot" if i % 2 else f"t{i}") for i in range(100, 200)]
    assert sorted((tuple(r)[:5] for r in run(spark, old, new).collect()), key=str) == brute(old + new)
    assert run(spark, [], []).count() == 0
    assert sorted((tuple(r)[:5] for r in run(spark, [], new).collect()), key=str) == brute(new)
    assert sorted((tuple(r)[:5] for r in run(spark, old, []).collect()), key=str) == brute(old)


def test_equal_digests_of_different_texts_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(5).cast("long"))
    old, new = [(1, "a"), (2, "b")], [(3, "a"), (4, "c"), (5, "c")]
    assert sorted((tuple(r)[:5] for r in run(spark, old, new).collect()), key=str) == brute(old + new)


def test_a_second_batch_against_the_stored_snapshot(spark, tmp_path):
    """Nothing of the snapshot is written again; negatives of the filters don't meet it."""
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    old = frame([(i, f"text {i % 700}") for i in range(1000)])
    path = f"{tmp_path}/snapshot"
    exact.build_snapshot(old, path)
    files = sorted(str(p) for p in tmp_path.rglob("*"))
    for start in (650, 5000):
        rows = [(start + i, f"text {start + i}") for i in range(400)] + [(9999, "text 5"), (9998, "text 5")]
        got = {r["sha"]: r for r in exact.screen_batch(path, old, frame(rows)).collect()}
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert len(got) == 401
        r = got[sha("text 5")]
        assert (r["keep_id"], r["n"], r["old_keep_id"], r["old_n"], r["positive"]) == (9999, 2, 705, 2, True)
        met = {t for _, t in rows if got[sha(t)]["old_n"] is not None}
        assert met == {t for _, t in rows if int(t.split()[1]) < 700}
        passed = sum(r["positive"] for r in got.values())
        assert len(met) <= passed <= len(met) + 12
    assert sorted(str(p) for p in tmp_path.rglob("*")) == files
    # The join with the snapshot's buckets begins from what the filters passed.
    positives = exact._screen(spark, path, frame(rows).selectExpr("xxhash64(text) AS digest").groupBy("digest").count().withColumnRenamed("count", "n"))
    assert positives.count() <= 15


def test_rows_delivered_twice_leave_one(spark):
    old, new = [(1, "a"), (1, "a"), (None, "n"), (None, "n"), (5, "e")], [(1, "a"), (4, "d"), (4, "d"), (4, "f"), (5, "e")]
    got = run(spark, old, new).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(old + new)
    assert sum(r["kept"] for r in got) == 5 and len({r["row_key"] for r in got}) == 10


def test_halves_keep_every_row(spark):
    df = spark.createDataFrame([(i, "x") for i in range(11)] + [(None, "y")], "doc_id long, text string")
    a, b = exact.halves(df)
    assert a.count() + b.count() == 12 and b.count() > 3
