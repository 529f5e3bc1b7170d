"""The stages of the pipeline, each against brute force on its own input."""

import random
import zlib
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from flowtables.llm import toxicity
from flowtables.session import workspace
from tests.llm import test_decontamination, test_near_dedup
from tests.llm.test_tokens import ids

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}

    def after(stage, docs):
        path = f"{tmp_path}/{stage}"
        dict(cp.STAGES)[stage](spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        if stage != "packing":
            assert out.columns == columns
            rows = out.collect()
            assert all(texts[r.doc_id] == r.text for r in rows)
            assert len({r.doc_id for r in rows}) == len(rows)
            return out, {r.doc_id: r.text for r in rows}
        return out, None

    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.severity(docs, model).where("not toxic").collect()}
    docs, kept = after("toxicity", docs)
    assert kept.keys() == clean and 150 < len(clean) < 200

    want = {}
    for i, t in sorted(kept.items()):
        want[t] = i
    docs, kept = after("exact_dedup", docs)
    assert kept.keys() == set(want.values())

    brute = test_near_dedup.brute(list(kept.items()))
    docs, kept = after("near_dedup", docs)
    assert kept.keys() == {i for i, _, stays in brute if stays} and len(kept) < len(brute)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {i for i, _, _, _, bad in test_decontamination.brute(list(kept.items()), items) if bad}
    docs, left = after("decontamination", docs)
    assert left.keys() == kept.keys() - hit and hit

    pieces, _ = after("packing", docs)
    total = 0
    for r in pieces.collect():
        data = np.array([*ids(left[r.doc_id]), 1], "<u4")
        assert r.doc_tokens == len(data) and r.ids_crc32 == zlib.crc32(data[r.start : r.start + r.length].tobytes())
        total += r.length
    assert total == sum(len(ids(t)) + 1 for t in left.values())


def test_odd_rows_pass_all_stages(spark, tmp_path):
    odd = spark.createDataFrame([(1, None, "x", 1), (2, "", None, 2), (3, "same words here", "a", 3), (3, "same words here", "b", 4), (None, "a row without id", "c", 5), (4, "word " * 30_000, "d", None)], "doc_id long, text string, kept_id string, hit_id int")
    for rows in (odd, odd.limit(0)):
        docs = rows
        for name, stage in cp.STAGES[:-1]:
            path = f"{tmp_path}/{name}-{rows.count()}"
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
            assert docs.columns == odd.columns
        ids_ = [r.doc_id for r in docs.collect()]
        assert sorted(map(str, ids_)) == (["2", "3", "4", "None"] if rows is odd else [])
        assert cp.pack(spark, docs, SF).select("doc_id").distinct().count() == (4 if rows is odd else 0)


def test_rows_that_share_an_id_or_have_none_are_judged_each_by_its_text(spark, tmp_path):
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if len(r.text.split()) >= 10)
    near = [" ".join(f"w{i}" for i in range(200)), " ".join(f"w{i}" for i in range(1, 200))]
    rows = [(i, t) for i in (None, 7) for t in (item, "a clean text", *near, "another one")]

    def after(stage):
        path = f"{tmp_path}/{stage}"
        dict(cp.STAGES)[stage](spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).write.parquet(path)
        return [(r.doc_id, r.text) for r in spark.read.parquet(path).collect()]

    assert sorted(after("decontamination"), key=str) == sorted((x for x in rows if x[1] != item), key=str)
    left = after("near_dedup")
    assert {i for i, _ in left} == {7} and sorted(t for _, t in left if t not in near) == sorted([item, "a clean text", "another one"])
    assert sum(t in near for _, t in left) == 1


def test_rows_delivered_twice_leave_one(spark, tmp_path):
    near = [" ".join(f"w{i}" for i in range(200)), " ".join(f"w{i}" for i in range(1, 200))]
    rows = [(i, t, n, n) for i in (None, 3) for t in ("twice", *near) for n in (1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_key int, kept int")

    def after(stage):
        path = f"{tmp_path}/{stage}"
        dict(cp.STAGES)[stage](spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        assert out.columns == docs.columns
        return sorted((r.doc_id, r.text) for r in out.collect())

    assert after("exact_dedup") == sorted((3, t) for t in ("twice", *near))
    left = after("near_dedup")
    assert len(left) == 2 and {i for i, _ in left} == {3} and sum(t in near for _, t in left) == 1


def test_run(spark):
    assert cp.run(spark, SF).count() > 100


def _scratch(spark):
    """Bytes of Parquet in the workspace, whatever wrote them."""
    return sum(p.stat().st_size for p in Path(workspace(spark)).rglob("*.parquet") if p.is_file())


def test_deciding_stages_leave_no_copy_of_rows_in_files(spark, tmp_path):
    rng = random.Random(3)
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if len(r.text.split()) >= 10)
    near = [" ".join(f"w{i}" for i in range(200)), " ".join(f"w{i}" for i in range(1, 200))]
    rows = [(i, t, 1) for i in (None, 7) for t in (item, "a clean text", *near)] * 2 + [(i, rng.randbytes(2000).hex(" "), i) for i in range(10, 500)]
    made = spark.createDataFrame(rows, "doc_id long, text string, row_key int")
    made.repartition(5).write.parquet(f"{tmp_path}/docs 100%20")
    docs = spark.read.parquet(f"{tmp_path}/docs 100%20")
    size = sum(p.stat().st_size for p in tmp_path.rglob("*.parquet") if p.is_file())
    assert size > 500_000
    for name in ("exact_dedup", "near_dedup", "decontamination"):
        stage, before = dict(cp.STAGES)[name], _scratch(spark)
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        assert _scratch(spark) - before < size / 10
        stage(spark, made, SF).write.parquet(f"{tmp_path}/{name}-made")
        out, want = (spark.read.parquet(f"{tmp_path}/{name}{x}") for x in ("", "-made"))
        assert out.columns == docs.columns
        # Which of two near copies with one id stays is open.
        left, right = (sorted(((r.doc_id, near[0] if r.text in near else r.text, r.row_key) for r in x.collect()), key=str) for x in (out, want))
        assert left == right and len(left) < len(rows)


def test_numbers_of_rows_are_unique_and_stay(spark, tmp_path):
    path = f"{tmp_path}/docs"
    made = spark.range(4000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit("x").alias("_metadata"), F.lit(1).alias("a.b"))
    made.repartition(4).write.option("parquet.block.size", 20_000).parquet(path)
    docs = spark.read.parquet(path)

    def numbers(rows, key):
        return {r[0]: r[1] for r in rows.select("doc_id", key).collect()}

    rows, key = cp._numbered(docs)
    first, before = numbers(rows, key), spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert rows.columns == [*docs.columns, key] and rows.drop(key).exceptAll(docs).isEmpty()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        assert rows.rdd.getNumPartitions() > 4 and numbers(rows, key) == first and sorted(first.values()) == list(range(4000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    # Rows that come from more than a scan, that lie in no file, or whose file is named twice.
    for other in (docs.where("doc_id % 3 > 0"), docs.unionByName(docs), docs.crossJoin(spark.range(2)), docs.limit(7), spark.read.parquet(path, path), made, docs.limit(0)):
        assert cp._places(other) is None
        rows, key = cp._numbered(other)
        assert rows.select(key).distinct().count() == rows.count() == other.count()
    spark.range(0).write.parquet(f"{tmp_path}/empty")
    assert cp._numbered(spark.read.parquet(f"{tmp_path}/empty"))[0].isEmpty()
