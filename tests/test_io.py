"""Sources, sinks and streams."""

import csv
import json
import os
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowtables import schemas, session
from flowtables.sinks import exports, tables
from flowtables.sources import files, records, tables as periods
from flowtables.streaming import ingest

PRICES = schemas.struct_of("id bigint\nname string\nprice decimal(18,2)\nday date\nat timestamp_ntz")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, type(v).__name__, v) for v in r])


def put(path, text, mode="w"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(text)
    return path


# ------------------------------------------------------------------ CSV and JSON in


def test_typed_csv(spark, folder):
    put(f"{folder}/a.csv", 'Any,Header,At,All,here\n 1 ," Smith, ""J"" ",10.5,2024-01-02,2024-01-02 03:04:05\n2,NULL,null,,\n3,"",  , NULL ,\n')
    assert rows(files.read_typed_csv(spark, f"{folder}/a.csv", PRICES)) == [
        (1, 'Smith, "J"', Decimal("10.50"), date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5)),
        (2, None, None, None, None),
        (3, None, None, None, None),
    ]


@pytest.mark.parametrize("line", ["x,a,1,,", "1,a,ten,,", "1,a,1,not a day,", "1,a"])
def test_typed_csv_stops_at_the_first_bad_value(spark, folder, line):
    put(f"{folder}/a.csv", f"h,h,h,h,h\n{line}\n")
    with pytest.raises(Exception):
        files.read_typed_csv(spark, f"{folder}/a.csv", PRICES).collect()


def test_typed_csv_replaces_bad_characters(spark, folder):
    put(f"{folder}/a.csv", b"h,h,h,h,h\n1,caf\xe9,1,,\n", "wb")
    assert files.read_typed_csv(spark, f"{folder}/a.csv", PRICES).first().name == "caf�"


def test_invoice_schemas():
    assert len(schemas.INVOICE_HEADER) == 26 and len(schemas.INVOICE_ITEM) == 72
    assert len(schemas.CONTACT_TEXT_FIELDS) == 34 and len(schemas.CONTACTS) == 40


def test_json_arrays(spark, folder):
    put(f"{folder}/contacts_1.json", '[{"id": 7, "n": null, "t": "1700000000"},\n {"id": "8", "n": "x"}, null, {}]')
    put(f"{folder}/contacts_2.json", "[]")
    put(f"{folder}/contacts_3.json", '[{"id": "9"}, {"id": ')
    schema = files.json_schema(["id", "n"], ["t"])
    read = files.read_json_array(spark, folder, schema, with_file=True)
    assert rows(read) == [("7", None, "1700000000", "contacts_1.json"), ("8", "x", None, "contacts_1.json"), ("9", None, None, "contacts_3.json")]
    assert rows(files.unreadable_json(spark, folder, schema)) == [("contacts_3.json",)]
    typed = files.project_json(read, ["id", "n"], ["t"])
    assert rows(typed) == [("7", "", datetime(2023, 11, 14, 22, 13, 20)), ("8", "x", None), ("9", "", None)]


def test_variant_projection(spark):
    df = spark.createDataFrame([('{"a": 1, "t": "2024-01-02"}',), ("junk",), (None,)], "j string")
    assert rows(files.project_variant(df, "j", ["a", "b"], ["t"])) == [("", "", None), ("", "", None), ("1", "", datetime(2024, 1, 2))]


def test_list_files_reads_names_only(spark, folder):
    for name in ("contacts_1.json", "contacts_2.json", "other.csv"):
        put(f"{folder}/in/{name}", "{}")
    found = files.list_files(spark, f"{folder}/in", "*.json")
    assert sorted(r.file_name for r in found.collect()) == ["contacts_1.json", "contacts_2.json"]
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()
    assert len(files.paths_of(found)) == 2


# ------------------------------------------------------------------ files out


def test_csv_export_tells_null_from_blank(spark, folder):
    df = spark.createDataFrame([(1, 'say "hi", you', None), (2, "", "b\\c")], "id int, a string, b string")
    out = exports.export_csv(df, f"{folder}/out", "Contacts_New.csv")
    assert out.single and os.path.isfile(f"{folder}/out/Contacts_New.csv")
    with open(out.path, newline="") as f:
        lines = sorted(csv.reader(f), key=lambda r: r[0])
    assert lines == [["1", 'say "hi", you', "\\N"], ["2", "", "b\\c"], ["id", "a", "b"]]
    again = exports.export_csv(df.limit(1), f"{folder}/out", "Contacts_New.csv")
    assert len(open(again.path).read().splitlines()) == 2  # a retry replaces the same file


def test_layout_is_chosen_and_both_hold_every_row(spark, folder):
    df = spark.range(100).repartition(4).select("id", F.lit(None).cast("string").alias("n"))
    parts = exports.export_csv(df, folder, "parts.csv", single_file=False)
    one = exports.export_csv(df, folder, "one.csv")
    assert not parts.single and one.single and os.path.isdir(parts.path) and os.path.isfile(one.path)
    assert all(spark.read.option("header", True).csv(x.path).count() == 100 for x in (parts, one))
    lines, array = (exports.export_json_array(df, folder, f"{s}.json", single_file=s) for s in (False, True))
    assert not lines.single and array.single and spark.read.json(lines.path).count() == 100
    assert spark.read.option("multiLine", True).json(array.path).count() == 100


def test_json_export_is_one_array_without_null_keys(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, n string")
    out = exports.export_json_array(df, folder, "u.json")
    assert sorted(json.load(open(out.path)), key=lambda r: r["id"]) == [{"id": 1, "n": "a"}, {"id": 2}]
    empty = exports.export_json_array(df.limit(0), folder, "none.json")
    assert json.load(open(empty.path)) == []
    assert open(exports.export_csv(df.limit(0), folder, "none.csv").path).read() == '"id","n"\n'


def part_counts(monkeypatch):
    """Record how many parts with rows each single file is put together from."""
    seen, plain = [], exports._stream

    def recorded(*args):
        seen.append(len(args[4]))
        plain(*args)

    monkeypatch.setattr(exports, "_stream", recorded)
    return seen


def test_one_file_is_joined_from_the_parts_of_all_tasks(spark, folder, monkeypatch):
    seen = part_counts(monkeypatch)
    # A third of the rows are one row, some tasks have none, fields hold quotes and line breaks.
    text = F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit('a,"b"\nc'), F.col("id").cast("string")))
    df = spark.range(0, 3000, 1, 16).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"), text.alias("t")).filter("id < 2000")
    want = sorted((str(r.id), r.t) for r in df.collect())
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        array = exports.export_json_array(df, folder, "many.json")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted((str(r["id"]), r["t"]) for r in json.load(open(array.path))) == want
    table = exports.export_csv(df, folder, "many.csv")
    with open(table.path, newline="") as f:
        header, *lines = csv.reader(f)
    assert header == ["id", "t"] and sorted(map(tuple, lines)) == want
    assert len(seen) == 2 and min(seen) > 4
    # The bytes don't depend on how many tasks wrote them.
    alone = exports.export_json_array(df.coalesce(1), folder, "alone.json")
    assert open(alone.path, "rb").read() == open(array.path, "rb").read()
    assert sorted(os.listdir(folder)) == [".alone.json.crc", ".many.csv.crc", ".many.json.crc", "alone.json", "many.csv", "many.json"]


def test_an_export_that_fails_leaves_the_earlier_file(spark, folder, monkeypatch):
    df = spark.range(10).select("id")
    first = open(exports.export_csv(df, folder, "x.csv").path).read()

    def broken(*args):
        exports._close(args[1].create(args[3]), "half")
        raise OSError("the store went away")

    monkeypatch.setattr(exports, "_stream", broken)
    with pytest.raises(OSError):
        exports.export_csv(df.limit(1), folder, "x.csv")
    assert open(f"{folder}/x.csv").read() == first and sorted(os.listdir(folder)) == [".x.csv.crc", "x.csv"]


def test_a_file_system_that_concatenates_gets_the_parts_in_order(spark):
    class Store:
        """Files as texts, with the calls of a file system that can append and concatenate."""

        def __init__(self, files):
            self.files = dict(files)

        def append(self, path):
            files, key = self.files, path.toString()

            class Out:
                def write(self, data):
                    files[key] = files.get(key, "") + bytes(data).decode()

                def close(self):
                    pass

            return Out()

        def create(self, path):
            self.files[path.toString()] = ""
            return self.append(path)

        def concat(self, path, parts):
            for p in parts:
                self.files[path.toString()] += self.files.pop(p.toString())

    path = spark._jvm.org.apache.hadoop.fs.Path
    for texts, want in ((["{1}\n,{2}\n", "{3}\n"], "[{1}\n,{2}\n,{3}\n]\n"), (["{1}\n"], "[{1}\n]\n"), ([], "[]\n")):
        store = Store({f"p{i}": t for i, t in enumerate(texts)})
        exports._concatenate(spark, store, path("whole"), [path(f"p{i}") for i in range(len(texts))], "[", ",", "]\n")
        assert store.files == {"whole": want}


# ------------------------------------------------------------------ tables


def test_replace_table_may_read_itself(spark, db):
    tables.replace_table(spark.range(3).toDF("id"), "t")
    result = tables.replace_table(spark.table("t").filter("id > 0"), "t")
    assert result.rows == 2 and rows(spark.table("t")) == [(1,), (2,)]


def test_replace_partitioned_table_drops_old_partitions(spark, db):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, p string")
    tables.replace_table(df, "t", ["p"])
    tables.replace_table(spark.table("t").filter("p = 'b'").withColumn("id", F.lit(9)), "t")
    assert rows(spark.table("t")) == [(9, "b")]


def test_swap_is_finished_after_a_crash(spark, db):
    tables.replace_table(spark.range(3).toDF("id"), "t__staging")  # the old table is gone already
    tables.ensure_table(spark, "t", schemas.struct_of("id bigint"))
    assert spark.table("t").count() == 3


def test_replace_period_leaves_other_months_alone(spark, db):
    cols = "v int, INVOICE_YEAR int, INVOICE_MONTH int"
    tables.replace_table(spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], cols), "t", ["INVOICE_YEAR", "INVOICE_MONTH"])
    feed = spark.createDataFrame([(10, 2024, 1), (20, 2024, 2), (30, 2024, 3)], cols)
    for _ in range(2):  # a second run adds nothing
        assert tables.replace_period(feed, "t", {"INVOICE_YEAR": 2024, "INVOICE_MONTH": 1}).rows == 1
        assert rows(spark.table("t")) == [(2, 2024, 2), (10, 2024, 1)]
    tables.replace_period(feed.limit(0), "t", {"INVOICE_YEAR": 2024, "INVOICE_MONTH": 1})
    assert rows(spark.table("t")) == [(2, 2024, 2)]


def test_change_table_rewrites_only_touched_partitions(spark, db, folder):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, p string")
    tables.replace_table(df, "t", ["p"])

    def stored():
        return {r.f for r in spark.table("t").select(F.col("_metadata.file_name").alias("f")).distinct().collect()}

    before = stored()
    result = tables.change_table(spark, "t", df.filter("p is null or p = 'a'"), lambda d: d.withColumn("id", F.col("id") + 100))
    assert result.rows == 2 and rows(spark.table("t")) == [(2, "b"), (101, "a"), (103, None)]
    assert len(before & stored()) == 1
    assert tables.change_table(spark, "t", df.limit(0), lambda d: d.limit(0)).rows == 0


def test_rewrite_if_nonempty_keeps_the_table(spark, db):
    tables.replace_table(spark.range(3).toDF("id"), "t")
    assert tables.rewrite_if_nonempty(spark.table("t").filter("id < 0"), "t").status == "SKIPPED"
    assert spark.table("t").count() == 3


def test_ensure_append_drain(spark, db):
    tables.ensure_table(spark, "t", schemas.struct_of("a int"))
    tables.ensure_table(spark, "t", schemas.struct_of("a int\nb string"))
    tables.append_table(spark.createDataFrame([("x", 1)], "b string, a int"), "t")
    tables.append_outbound(spark.createDataFrame([(5,)], "z int"), "t", {"a": "z", "b": F.lit("const")})
    assert rows(spark.table("t")) == [(1, "x"), (5, "const")]
    assert tables.create_view(spark.table("t"), "v", ["b"]).columns == ["b"]
    tables.drain(spark, "t")
    assert spark.table("t").count() == 0


def test_audit_and_prune(spark, db):
    assert tables.audited(spark, "log", "ok", datetime(2024, 6, 1, 12), lambda: ("fine", "f.csv"), "J") == "fine"
    message = tables.audited(spark, "log", "bad", datetime(2024, 6, 9, 12), lambda: 1 / 0, "J")
    assert message.startswith("J ERROR: division")
    log = {r.TASK_NAME: r for r in spark.table("log").collect()}
    assert log["ok"].LOG_TIMESTAMP == datetime(2024, 6, 1, 13) and log["ok"].PROCESSED_FILES == "f.csv"
    assert log["bad"].STATUS == "FAILURE" and log["bad"].PROCESSED_FILES is None
    assert tables.prune(spark, "log", "LOG_TIMESTAMP", 3, date(2024, 6, 10), task="other").rows == 2
    assert tables.prune(spark, "log", "LOG_TIMESTAMP", 3, date(2024, 6, 10)).rows == 1


def test_periods(spark, db):
    for name in ("shared_2026_1", "shared_2026_2"):
        tables.replace_table(spark.createDataFrame([(name,)], "n string"), name)
    load = lambda day: periods.snapshot_period(spark, "shared_", "own_", day)
    assert [load(date(2026, 2, 1)).status, load(date(2026, 2, 20)).status, load(date(2026, 3, 1)).status] == ["SUCCESS", "SKIPPED", "SUCCESS"]
    periods.snapshot_table(spark, "shared_2026_1", "own_HISTORY")
    tables.replace_table(spark.createDataFrame([("x",)], "n string"), "ownXother")
    assert periods.period_tables(spark, "own_") == ["own_2026_1", "own_2026_2"]
    assert rows(periods.union_periods(spark, "own_", "own_view")) == [("shared_2026_1",), ("shared_2026_2",)]
    assert spark.table("own_view").count() == 2


# ------------------------------------------------------------------ streams


STATUS = schemas.struct_of("id string\nname string")


def test_stream_loads_each_file_once(spark, folder):
    def arrive(name, text):
        put(f"{folder}/in/{name}", "id,name\n" + text)

    def run():
        ingest.ingest_files_stream(spark, f"{folder}/in", STATUS, f"{folder}/cp", f"{folder}/out")
        return rows(ingest.read_landed(spark, f"{folder}/out"))

    arrive("a.csv", '1,\n2," kept blank "\n')
    assert run() == [("1", ""), ("2", " kept blank ")]
    assert len(run()) == 2
    arrive("b.csv", "3,c\n")
    assert len(run()) == 3


def by_hand(text, width):
    """Records of a file by the reader of damaged files."""
    reader, out = records.RuleReader(width), []
    for line in text.removesuffix("\n").split("\n"):
        out += reader.line(line)
    return (out + reader.end())


def landed(spark, folder, texts, schema):
    """(rows, rejected records) of files that arrive at once, in one stream."""
    for i, text in enumerate(texts):
        put(f"{folder}/in/{i}.csv", text)
    ingest.ingest_files_stream(spark, f"{folder}/in", schema, f"{folder}/cp", f"{folder}/out")
    return rows(ingest.read_landed(spark, f"{folder}/out")), rows(ingest.read_landed(spark, f"{folder}/out_rejected").select("line"))


def split(spark, texts, width, chunk):
    """Records of texts whose lines lie in chunks of so many lines; chunks have no order among each other."""
    lines = []
    for i, text in enumerate(texts):
        own = text.removesuffix("\n").split("\n") if text else []
        lines += [(v, f"f{i}", k // chunk * 100, 1000 * (7 * (k // chunk) % 5) + k) for k, v in enumerate(own)]
    made = spark.createDataFrame(lines, "value string, file string, chunk long, at long").repartition(3)
    return sorted(tuple(r) for r in records.split_records(made, width).collect())


THREE = schemas.struct_of("a string\nb string\nc string")
CASES = {
    'h,h,h\n1,Active,"line one\nline two"\n2,x,y\n': ([("1", "Active", "line one\nline two"), ("2", "x", "y")], []),
    'h,h,h\n3,"two\nlines",x\n\n"4\n""4""\r\n",,""\r\n': ([("3", "two\nlines", "x"), ('4\n"4"\r\n', "", "")], []),
    '"h\nh",h,h\n1,2,3\n': ([("1", "2", "3")], []),
    # A quote that is never closed costs its line, wherever the next quote stands.
    'h,h,h\n1,"open,x\n2,b,c\n3,"ok",z\n': ([("2", "b", "c"), ("3", "ok", "z")], ['1,"open,x']),
    'h,h,h\n1,a,"open\n2,b,c\n': ([("2", "b", "c")], ['1,a,"open']),
    'h,h,h\n1,a,"open\n2,b,"two\nlines"\n3,c,"open too': ([("2", "b", "two\nlines")], ['1,a,"open', '3,c,"open too']),
    # What closes the quote by chance has too few fields.
    'h,h,h\n1,"open,x\n2,b,c\n3,x,"\n4,d,e': ([("2", "b", "c"), ("4", "d", "e")], ['1,"open,x', '3,x,"']),
    # Quotes within plain fields are letters.
    'h,h,h\n1,5" pipe,x\n2,"a\nb",y\n3,3" nail,z\n': ([("1", '5" pipe', "x"), ("2", "a\nb", "y"), ("3", '3" nail', "z")], []),
    'h,h,h\n1,a\n1,a,b,c\n1,"a"b,c\n2,"a" ,c\n': ([("2", "a", "c")], ['1,"a"b,c', "1,a", "1,a,b,c"]),
    "h,h,h\n": ([], []),
    "": ([], []),
}


def test_records_of_several_lines(spark, folder):
    want = [x for good, _ in CASES.values() for x in good], [(x,) for _, bad in CASES.values() for x in bad]
    assert landed(spark, folder, list(CASES), THREE) == (sorted(want[0]), sorted(want[1]))
    for text, (good, bad) in CASES.items():
        assert sorted(r for r, fit in by_hand(text, 3) if not fit) == sorted(bad), text


@pytest.mark.parametrize("chunk", [1, 2, 3])
def test_records_across_chunks(spark, chunk):
    want = sorted(r for text in CASES for r in by_hand(text, 3))
    assert split(spark, list(CASES), 3, chunk) == want


def test_both_ways_give_the_same_records(spark, monkeypatch):
    """Random files without damage, by prefix sums and by rules; and by rules when a record is too long."""
    rng = random.Random(3)
    want = []

    def made():
        out = ["h,h"]
        for _ in range(rng.randrange(30)):
            cells = ["".join(rng.choice('ab, "\n') for _ in range(rng.randrange(12))) for _ in range(2)]
            out.append(",".join('"' + c.replace('"', '""') + '"' for c in cells))
            want.append((out[-1], True))
        return "\n".join(out) + "\n"

    texts = [made() for _ in range(12)]
    assert split(spark, texts, 2, 4) == sorted(want) == sorted(r for t in texts for r in by_hand(t, 2))
    # A record that is too long for the sums sends its file the other way.
    monkeypatch.setattr(records, "RECORD_BYTES", 12)
    assert split(spark, texts, 2, 4) == sorted(want)


def test_a_batch_is_parsed_once(spark, folder):
    seen = []
    for i in range(3):
        put(f"{folder}/in/{i}.csv", f'id,name\n{i},"two\nlines"\n{i},"broken\n')
    ingest.for_new_files(spark, f"{folder}/in", STATUS, f"{folder}/cp", lambda df, n: seen.append(rows(df)), lambda n: seen.append(n))
    assert seen == [3, [(str(i), "two\nlines") for i in range(3)]]
    assert spark.read.parquet(f"{folder}/cp_rejected").count() == 3


def test_hash_delta_stream(spark, db, folder):
    def run():
        ingest.hash_delta_stream(spark, f"{folder}/in", STATUS, f"{folder}/cp", "hist", ["id", "name"])
        return sorted((r.id, r.name) for r in spark.table("hist").collect())

    put(f"{folder}/in/a.csv", "id,name\n1,a\n1,a\n,x\n2,b\n")
    assert run() == [("1", "a"), ("2", "b")]
    put(f"{folder}/in/b.csv", "id,name\n1,a\n3,c\n")
    assert run() == [("1", "a"), ("2", "b"), ("3", "c")]


# ------------------------------------------------------------------ workspace


def test_workspace_is_the_folder_of_the_session(spark):
    assert session.workspace(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_workspace_of_a_cluster_must_be_named():
    class Conf:
        def get(self, *_):
            return None

    class Fake:
        conf = Conf()

        def __init__(self, master):
            self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})

    assert os.path.isdir(session.workspace(Fake("local[2]"))) and session.workspace(Fake("local[2]")) == session.workspace(Fake("local[2]"))
    with pytest.raises(ValueError):
        session.workspace(Fake("yarn"))


def test_staging_leaves_nothing_behind(spark):
    with session.staging(spark) as stage:
        copy = stage(spark.range(3), "x")
        assert copy.count() == 3
        folder = copy.inputFiles()[0].removeprefix("file:").rsplit("/", 2)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_staged_rows_do_not_change(spark, db):
    tables.replace_table(spark.range(3).toDF("id"), "t")
    copy = session.staged(spark.table("t"))
    tables.replace_table(spark.range(9).toDF("id"), "t")
    assert copy.count() == 3
