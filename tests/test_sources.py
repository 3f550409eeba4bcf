"""Readers, staging and sinks on files."""

import datetime as dt
import glob
import json
import os
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from envlake.sources import (
    DatasetSpec,
    land_records,
    parse_documents,
    read_dataset,
    read_delimited,
    read_landed,
    read_raw_documents,
    read_table,
    refresh,
    scratch_dir,
    stage,
    staged_path,
    write_delimited,
    write_documents,
    write_fact,
)
from envlake.sources import versions
from envlake.sources.bronze import dataset_status
from envlake.sources.versions import current, manifest


def rows(frame):
    return Counter(tuple(r) for r in frame.collect())


def put(folder, name, text, encoding="utf-8", mtime=None):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    if mtime:
        os.utime(path, (mtime, mtime))
    return str(path)


def test_declared_types_by_name_and_text_for_the_rest(spark, tmp_path):
    path = put(tmp_path, "a.csv", "﻿Magnitud;punto muestreo;h01;v01;fecha\n1;x_1;2.5;V;2024-01-01\n;;;;\n")
    frame = read_delimited(spark, path, ";", {"magnitud": "int", "h01": "double", "fecha": "date"})
    assert [f.dataType.simpleString() for f in frame.schema] == ["int", "string", "double", "string", "date"]
    assert frame.columns[0] == "Magnitud"
    assert rows(frame) == {(1, "x_1", 2.5, "V", dt.date(2024, 1, 1)): 1, (None,) * 5: 1}


def test_inference_for_undeclared_columns(spark, tmp_path):
    path = put(tmp_path, "a.csv", "MAGNITUD,UNIDAD,n,t\n1,ug,3,x\n")
    frame = read_delimited(spark, path, ",", {"magnitud": "bigint"}, infer_rest=True)
    assert [f.dataType.simpleString() for f in frame.schema] == ["bigint", "string", "int", "string"]


def test_inferred_times_have_no_zone(spark, tmp_path):
    path = put(tmp_path, "a.csv", "k,t,d\n1,2024-03-31 02:30:00,2024-03-31\n")
    frame = read_delimited(spark, path, ",", infer_rest=True)
    assert [f.dataType.simpleString() for f in frame.schema] == ["int", "timestamp_ntz", "date"]
    assert tuple(frame.first()) == (1, dt.datetime(2024, 3, 31, 2, 30), dt.date(2024, 3, 31))


def test_times_survive_a_csv_roundtrip(spark, tmp_path):
    stamps = [dt.datetime(2024, 3, 31, 2, 30, 0, 123456), dt.datetime(2024, 1, 1), None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "i int, t timestamp_ntz")
    write_delimited(frame, str(tmp_path / "o"))
    again = read_delimited(spark, str(tmp_path / "o"), ",", {"i": "int", "t": "timestamp_ntz"})
    assert rows(again) == rows(frame)


@pytest.mark.parametrize("cell", ["12,5", "x"])
def test_a_cell_that_does_not_fit_fails(spark, tmp_path, cell):
    path = put(tmp_path, "a.csv", f"h01;b\n{cell};1\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        read_delimited(spark, path, ";", {"h01": "double"}).collect()


def test_quotes_and_empty_text(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'a,b,c\n"MADRID, RETIRO","say ""hi""",\n"",x,1\n')
    frame = read_delimited(spark, path, ",", {"c": "int"})
    assert rows(frame) == {("MADRID, RETIRO", 'say "hi"', None): 1, (None, "x", 1): 1}


def test_line_breaks_in_quotes(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'a,b\n"x\ny",1\n')
    assert rows(read_delimited(spark, path, ",", {"b": "int"}, multi_line=True)) == {("x\ny", 1): 1}


def test_latin9_csv(spark, tmp_path):
    path = put(tmp_path, "a.csv", "n;m\nŠtěp".replace("ě", "é") + " €;1\n", "iso-8859-15")
    assert rows(read_delimited(spark, path, ";", {"m": "int"}, latin9=True)) == {("Štép €", 1): 1}


def test_pointer_files_are_refused(spark, tmp_path):
    path = put(tmp_path, "a.csv", "version https://git-lfs.github.com/spec/v1\noid sha256:0\nsize 1\n")
    with pytest.raises(ValueError, match="LFS"):
        read_delimited(spark, path)


def test_files_of_one_folder_must_share_their_header(spark, tmp_path):
    put(tmp_path, "a/1.csv", "x;y\n1;2\n")
    put(tmp_path, "a/2.csv", "y;x\n1;2\n")
    with pytest.raises(Exception):
        read_delimited(spark, str(tmp_path / "a")).collect()


def test_csv_sink_with_byte_order_mark(spark, tmp_path):
    out = str(tmp_path / "out")
    frame = spark.createDataFrame([("Ñ", 1.5, dt.date(2022, 1, 1)), (None, None, None)], "a string, b double, c date")
    write_delimited(frame.coalesce(1), out, bom=True)
    (part,) = glob.glob(f"{out}/part-*")
    data = open(part, "rb").read()
    assert data.startswith(b"\xef\xbb\xbfa,b,c\n") and data.count(b"\xef\xbb\xbf") == 1
    assert rows(read_delimited(spark, out, ",", {"b": "double", "c": "date"})) == rows(frame)


def test_fact_sink_replaces_and_compresses(spark, tmp_path):
    out = str(tmp_path / "deep" / "er" / "t.parquet")
    write_fact(spark.range(10), out)
    write_fact(spark.range(3), out)
    assert read_table(spark, out).count() == 3
    assert all(".snappy." in p for p in glob.glob(f"{out}/_v.*/*.parquet"))


def test_fact_sink_partitioned_keeps_all_rows(spark, tmp_path):
    out = str(tmp_path / "t.parquet")
    frame = spark.range(1000, numPartitions=8).withColumn("y", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7))
    write_fact(frame, out, ["y"])
    assert rows(read_table(spark, out).select("id", "y")) == rows(frame)
    assert len(glob.glob(f"{out}/_v.*/y=0/*.parquet")) == 1


def test_a_hot_folder_is_written_by_several_tasks(spark, tmp_path):
    out, setting = str(tmp_path / "t.parquet"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    frame = spark.range(60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("y"), F.md5(F.col("id").cast("string")).alias("v")
    )
    spark.conf.set(setting, "200000")
    try:
        write_fact(frame, out, ["y"])
    finally:
        spark.conf.set(setting, before)
    assert len(glob.glob(f"{out}/_v.*/y=0/*.parquet")) > 1
    assert read_table(spark, out).count() == 60000


# --- staging ---------------------------------------------------------------------

CATALOG = {
    "fresh": DatasetSpec("in/fresh.csv", ";", {"a": "int"}),
    "stale": DatasetSpec("in/stale.csv", ";", {"a": "int"}),
    "unstaged": DatasetSpec("in/unstaged.csv", ";", {"a": "int"}),
    "copy": "in/copy.parquet",
    "absent": "in/absent.csv",
}


def test_staging_follows_file_times(spark, tmp_path):
    root = str(tmp_path)
    put(tmp_path, "in/fresh.csv", "a;b\n1;x\n", mtime=1_600_000_000)
    put(tmp_path, "in/stale.csv", "a;b\n1;x\n", mtime=1_600_000_000)
    spark.range(2).write.parquet(f"{root}/in/copy.parquet")
    assert refresh(spark, root, CATALOG) == ["fresh", "stale"]
    put(tmp_path, "in/stale.csv", "a;b\n1;x\n2;y\n", mtime=4_000_000_000)
    put(tmp_path, "in/unstaged.csv", "a;b\n3;z\n")
    states = {r.dataset: r.state for r in dataset_status(spark, root, CATALOG).collect()}
    assert states == {k: {"copy": "fresh"}.get(k, k) for k in CATALOG}
    assert refresh(spark, root, CATALOG) == ["stale", "unstaged"]
    assert rows(read_dataset(spark, root, CATALOG["stale"])) == {(1, "x"): 1, (2, "y"): 1}
    assert read_dataset(spark, root, CATALOG["copy"]).count() == 2


def test_a_changed_separator_alone_is_not_noticed(spark, tmp_path):
    put(tmp_path, "a.csv", "a;b\n1;2\n", mtime=1_600_000_000)
    assert refresh(spark, str(tmp_path), {"a": DatasetSpec("a.csv", ",")}) == ["a"]
    assert refresh(spark, str(tmp_path), {"a": DatasetSpec("a.csv", ";")}) == []


def test_staged_path():
    assert staged_path("/x/y/a.CSV") == "/x/y/parquet_files/a.parquet"
    assert staged_path("/x/y/a.parquet") == "/x/y/a.parquet"
    assert staged_path("/x/y/a.orc") == "/x/y/a.orc"


def test_a_failed_staging_leaves_the_dataset_to_be_staged_again(spark, tmp_path):
    catalog = {"a": DatasetSpec("a.csv", ";", {"a": "int"})}
    put(tmp_path, "a.csv", "a\nx\n")
    with pytest.raises(Exception):
        stage(spark, str(tmp_path), catalog["a"])
    assert dataset_status(spark, str(tmp_path), catalog).first().state == "unstaged"


# --- raw documents ---------------------------------------------------------------

FIELDS = ["fecha", "indicativo", "prec", "horaPIntMax"]


def record(day, **more):
    return {"fecha": day, "indicativo": "5210X", **more}


def test_only_whole_arrays_count(spark, tmp_path):
    good = json.dumps([record("2022-07-01", prec="0,1"), record("2022-07-02", horaPIntMax="04:40", other="x")], indent=2)
    put(tmp_path, "5210X_2022_07.json", good)
    put(tmp_path, "5210X_2022_01.json", good[:-20])
    put(tmp_path, "5210X_2021_07.json", "[]")
    put(tmp_path, "5210X_2021_01.json", json.dumps(record("2021-01-01")))
    put(tmp_path, "5210X_2020_07.json", "<html>[x]</html>")
    put(tmp_path, "5210X_2020_01.json", good + "\nmore")
    put(tmp_path, "3195_2020_01.json", "")
    put(tmp_path, "3196_2020_01.json", "[null, " + json.dumps(record("2020-01-01")) + "]")
    (tmp_path / "3129_2020_01.json").write_bytes(b'[{"fecha": "\xff"}]')
    frame = read_raw_documents(spark, str(tmp_path), FIELDS, rest=False).drop("documento_estacion")
    assert rows(frame) == {
        ("5210X_2022_07", dt.date(2022, 7, 1), "2022-07-01", "5210X", "0,1", None): 1,
        ("5210X_2022_07", dt.date(2022, 7, 1), "2022-07-02", "5210X", None, "04:40"): 1,
        ("3196_2020_01", dt.date(2020, 1, 1), "2020-01-01", "5210X", None, None): 1,
    }


def test_other_keys_are_kept_and_the_last_of_a_repeated_one_counts(spark, tmp_path):
    put(tmp_path, "A_2022_01.json", '[{"fecha":"1","x":"a","fecha":"2","x":"b","y":{"z":1},"n":null},{"prec":"3"}]')
    first, second = read_raw_documents(spark, str(tmp_path), ["fecha", "prec"]).orderBy("prec").collect()
    assert (first.fecha, first.prec, first.otros) == ("2", None, {"x": "b", "y": '{"z":1}', "n": None})
    assert (second.fecha, second.prec, second.otros) == (None, "3", {})
    plain = read_raw_documents(spark, str(tmp_path), ["fecha", "prec"], rest=False)
    assert "otros" not in plain.columns and {r.fecha for r in plain.collect()} == {"2", None}


def test_documents_are_written_many_to_a_folder(spark, tmp_path):
    texts = [(f"s{i}_2022_07", json.dumps([{"fecha": f"2022-07-{1 + i % 28:02d}", "ñ": str(i)}], ensure_ascii=False)) for i in range(300)]
    frame = spark.createDataFrame([*texts, (None, "[]"), ("x_2022_01", None)], "documento string, texto string")
    for _ in range(2):  # again: the same files
        write_documents(frame, str(tmp_path / "d"), folders=4)
    assert len(glob.glob(f"{tmp_path}/d/*")) == 4 and len(glob.glob(f"{tmp_path}/d/*/*.json")) == 300
    got = read_raw_documents(spark, f"file://{tmp_path}/d", ["fecha"]).collect()
    assert {(r.documento, r.otros["ñ"]) for r in got} == {(k, json.loads(t)[0]["ñ"]) for k, t in texts}
    with pytest.raises(Exception, match="no file name"):
        write_documents(spark.createDataFrame([("a/b", "[]")], "documento string, texto string"), str(tmp_path / "e"))


def test_latin9_documents(spark, tmp_path):
    put(tmp_path, "x_2020_01.json", json.dumps([{"fecha": "ŠÑ€"}], ensure_ascii=False), "iso-8859-15")
    assert read_raw_documents(spark, str(tmp_path), ["fecha"], latin9=True).first().fecha == "ŠÑ€"


def test_landing_again_replaces_only_its_windows(spark, tmp_path):
    out = str(tmp_path / "landed")
    ddl = "fecha string, indicativo string, prec string"
    first = [("2022-01-05", "5210X", "1"), ("2022-06-30", "5210X", "2"), ("2022-07-01", "5210X", "3"), ("2022-01-01", "3195", "4"), (None, "3195", "5")]
    land_records(spark.createDataFrame(first, ddl), out)
    land_records(spark.createDataFrame([("2022-02-02", "5210X", "6")], ddl), out)
    got = rows(read_landed(spark, out, ["fecha", "indicativo", "prec"], rest=False))
    assert got == {
        ("5210X_2022_01", "2022-01-01", "2022-02-02", "5210X", "6"): 1,
        ("5210X_2022_07", "2022-07-01", "2022-07-01", "5210X", "3"): 1,
        ("3195_2022_01", "2022-01-01", "2022-01-01", "3195", "4"): 1,
        (None, None, None, "3195", "5"): 1,
    }


def test_scratch_is_below_the_shared_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b
    if before:
        assert a.startswith(before.rstrip("/"))


@pytest.mark.parametrize("master, fails", [("local[4]", False), ("yarn", True)])
def test_scratch_without_a_shared_folder(master, fails):
    settings = {"spark.master": master}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))
    if fails:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_dir(session, "x")
    else:
        assert os.path.isabs(scratch_dir(session, "x"))


def test_line_breaks_need_to_be_allowed(spark, tmp_path):
    frame = spark.createDataFrame([(" x ", 1), ("a\nb", 2)], "t string, n int")
    with pytest.raises(Exception, match="line break in column t"):
        write_delimited(frame, str(tmp_path / "a.csv"))
    assert not (tmp_path / "a.csv").exists()
    write_delimited(frame, str(tmp_path / "b.csv"), multi_line=True)
    back = read_delimited(spark, str(tmp_path / "b.csv"), ",", {"n": "int"}, multi_line=True)
    assert sorted(map(tuple, back.collect())) == [(" x ", 1), ("a\nb", 2)]


def test_other_keys_are_landed_too(spark, tmp_path):
    put(tmp_path, "d/A_2022_01.json", '[{"fecha":"2022-01-05","indicativo":"A","nuevo":"x"},{"fecha":"2022-01-06","indicativo":"A"}]')
    records = read_raw_documents(spark, str(tmp_path / "d"), ["fecha", "indicativo"]).drop("documento", "documento_estacion", "documento_mes")
    land_records(records, str(tmp_path / "l"))
    got = read_landed(spark, str(tmp_path / "l"), ["fecha", "indicativo"]).collect()
    assert {r.fecha: r.otros for r in got} == {"2022-01-05": {"nuevo": "x"}, "2022-01-06": {}}


def test_landing_with_start_and_corrupt_lines(spark, tmp_path):
    rows = [(None, "A"), ("xx", "A"), ("1999-05-05", "A"), ("2022-03-14", "A"), ("2022-03-15", "A"), ("2022-08-01", "A")]
    path = str(tmp_path / "l")
    land_records(spark.createDataFrame(rows, "fecha string, indicativo string"), path, "2022-03-15")
    put(tmp_path, "l/indicativo=A/ventana=2022-07-01/part-x.json", '{"fecha": "2022-0\n')
    got = sorted((r.fecha or "", r.ventana or "") for r in read_landed(spark, path, ["fecha", "indicativo"]).collect())
    assert got == [("", ""), ("1999-05-05", ""), ("2022-03-14", ""), ("2022-03-15", "2022-03-15"), ("2022-08-01", "2022-07-01"), ("xx", "")]


def test_only_changed_files_are_staged_again(spark, tmp_path):
    spec = DatasetSpec("d.csv", ";", {"k": "int"})
    for name, rows in {"a": "k;t\n1;x\n", "b": "k;t\n2;y\n", "c": "k;t\n", "e f": "k;t\n5;z\n"}.items():
        put(tmp_path, f"d.csv/{name}.csv", rows, mtime=1_000_000_000)
    catalog = {"d": spec}

    def state():
        return dataset_status(spark, str(tmp_path), catalog).first().state

    def copies(name):
        copy = f"{tmp_path}/parquet_files/d.parquet"
        folders = [p["folder"] for p in manifest(spark, copy) if p["file"] == name]
        return {p: os.stat(p).st_mtime_ns for f in folders for p in glob.glob(f"{copy}/{f}/*.parquet")}

    assert state() == "unstaged" and refresh(spark, str(tmp_path), catalog) == ["d"]
    assert state() == "fresh" and refresh(spark, str(tmp_path), catalog) == []
    before = copies("a.csv")
    put(tmp_path, "d.csv/b.csv", "k;t\n3;y\n4;y\n", mtime=900_000_000)  # older than it was
    os.remove(tmp_path / "d.csv/e f.csv")
    assert state() == "stale"
    refresh(spark, str(tmp_path), catalog)
    rows = read_dataset(spark, str(tmp_path), spec)
    assert state() == "fresh" and rows.columns == ["k", "t"]
    assert sorted(map(tuple, rows.collect())) == [(1, "x"), (3, "y"), (4, "y")]
    assert before and copies("a.csv") == before and not copies("e f.csv")
    assert {p["file"]: p["rows"] for p in manifest(spark, f"{tmp_path}/parquet_files/d.parquet")} == {"a.csv": 1, "b.csv": 2, "c.csv": 0}
    put(tmp_path, "d.csv/b.csv", "k;t;u\n3;y;1\n", mtime=1_100_000_000)  # other columns: all over again
    for name in "ac":
        put(tmp_path, f"d.csv/{name}.csv", "k;t;u\n1;x;2\n", mtime=1_100_000_000)
    refresh(spark, str(tmp_path), catalog)
    assert read_dataset(spark, str(tmp_path), spec).columns == ["k", "t", "u"]


@pytest.mark.parametrize("folder", [True, False])
def test_a_source_cut_to_its_header_has_no_rows(spark, tmp_path, folder):
    """One part of several, or the only file: its old rows go."""
    spec = DatasetSpec("d.csv", ";", {"k": "int"})
    name = "d.csv/a.csv" if folder else "d.csv"
    if folder:
        put(tmp_path, "d.csv/b.csv", "k;t\n9;z\n", mtime=1_000_000_000)
    put(tmp_path, name, "k;t\n1;x\n2;y\n", mtime=1_000_000_000)
    refresh(spark, str(tmp_path), {"d": spec})
    assert read_dataset(spark, str(tmp_path), spec).count() == 2 + folder
    put(tmp_path, name, "k;t\n", mtime=1_100_000_000)
    assert refresh(spark, str(tmp_path), {"d": spec}) == ["d"] and refresh(spark, str(tmp_path), {"d": spec}) == []
    left = read_dataset(spark, str(tmp_path), spec)
    assert left.columns == ["k", "t"] and [tuple(r) for r in left.collect()] == [(9, "z")] * folder
    put(tmp_path, name, "k;t\n4;w\n", mtime=1_200_000_000)
    refresh(spark, str(tmp_path), {"d": spec})
    assert sorted(map(tuple, read_dataset(spark, str(tmp_path), spec).collect())) == [(4, "w")] + [(9, "z")] * folder


NAMES = ["a+b.csv", "50%.csv", "50%25.csv", "ñ x.csv", "q=1.csv", "a[1].csv", "{b}.csv", "sub dir+/a+b.csv", "a b.csv"]


def test_files_of_any_name(spark, tmp_path):
    """Added, changed, emptied and removed, each file on its own."""
    spec = DatasetSpec("d.csv", ";", {"k": "int"})
    kept = {}
    for i, name in enumerate(NAMES):
        put(tmp_path, f"d.csv/{name}", f"k\n{i}\n", mtime=1_000_000_000)
        kept[name] = [i]
    catalog = {"d": spec}

    def check():
        refresh(spark, str(tmp_path), catalog)
        assert dataset_status(spark, str(tmp_path), catalog).first().state == "fresh"
        assert sorted(r.k for r in read_dataset(spark, str(tmp_path), spec).collect()) == sorted(sum(kept.values(), []))
        listed = manifest(spark, f"{tmp_path}/parquet_files/d.parquet")
        assert {p["file"]: p["rows"] for p in listed} == {n: len(v) for n, v in kept.items()}

    check()
    for i, name in enumerate(NAMES):  # a third each way
        if i % 3 == 0:
            os.remove(tmp_path / f"d.csv/{name}")
            del kept[name]
        else:
            kept[name] = [100 + i, 200 + i] if i % 3 == 1 else []
            put(tmp_path, f"d.csv/{name}", "k\n" + "".join(f"{k}\n" for k in kept[name]), mtime=1_100_000_000)
    check()
    for name in NAMES:
        put(tmp_path, f"d.csv/{name}", "k\n7\n", mtime=1_200_000_000)
        kept[name] = [7]
    check()
    put(tmp_path, "[x].csv", "k\n1\n")
    assert refresh(spark, str(tmp_path), {"x": DatasetSpec("[x].csv")}) == ["x"]
    assert read_dataset(spark, str(tmp_path), DatasetSpec("[x].csv")).count() == 1


class Stopped(BaseException):
    """The process ends."""


@pytest.mark.parametrize("step", ["_publish", "_sweep"])
def test_a_job_that_stops_leaves_the_table_readable(spark, tmp_path, monkeypatch, step):
    """Before the log's entry the old version is current, after it the new one."""
    out = str(tmp_path / "t.parquet")
    write_fact(spark.range(3), out)

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as m, pytest.raises(Stopped):
        m.setattr(versions, step, stop)
        write_fact(spark.range(10), out)
    assert read_table(spark, out).count() == (3 if step == "_publish" else 10)
    log = tmp_path / "t.parquet/_versions"
    (log / f"{9:012d}.json").write_text('{"folder": "_v.ha')  # an entry whose write did not end
    assert read_table(spark, out).count() == (3 if step == "_publish" else 10)
    write_fact(spark.range(5), out)
    assert read_table(spark, out).count() == 5


def test_replaced_versions_go_one_write_later(spark, tmp_path):
    out = str(tmp_path / "t.parquet")
    seen = []
    for n in range(1, 6):
        write_fact(spark.range(n), out)
        seen.append(current(spark, out)["folder"])
        there = {os.path.basename(p) for p in glob.glob(f"{out}/_v.*")}
        assert there == set(seen[-2:]) and read_table(spark, out).count() == n
    assert len(glob.glob(f"{out}/_versions/*.json")) == 2


def test_a_reader_keeps_its_version(spark, tmp_path):
    out = str(tmp_path / "t.parquet")
    write_fact(spark.range(3), out)
    reader = read_table(spark, out)
    write_fact(spark.range(7), out)
    assert reader.count() == 3 and read_table(spark, out).count() == 7
    write_fact(read_table(spark, out).where("id < 2"), out)  # a table made from itself
    assert read_table(spark, out).count() == 2


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    """The second one fails and the first one's table stays."""
    out = str(tmp_path / "t.parquet")
    write_fact(spark.range(3), out)
    listed = versions._entries(spark, out)
    write_fact(spark.range(4), out)
    monkeypatch.setattr(versions, "_entries", lambda *_: listed)
    with pytest.raises(Exception, match="xists"):
        write_fact(spark.range(5), out)
    monkeypatch.undo()
    assert read_table(spark, out).count() == 4


def test_a_plain_table_becomes_one_with_versions(spark, tmp_path):
    out = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(out)
    assert read_table(spark, out).count() == 3
    write_fact(spark.range(4), out)
    assert read_table(spark, out).count() == 4 and not glob.glob(f"{out}/part-*")


def test_a_file_that_changes_while_it_is_read(spark, tmp_path, monkeypatch):
    """Its rows are of no listed file: nothing is published."""
    from envlake.sources import bronze

    spec = DatasetSpec("d.csv", ";", {"k": "int"})
    put(tmp_path, "d.csv", "k\n1\n", mtime=1_000_000_000)
    refresh(spark, str(tmp_path), {"d": spec})
    put(tmp_path, "d.csv", "k\n2\n", mtime=1_100_000_000)
    right = bronze.read_delimited

    def late(*args, **more):
        put(tmp_path, "d.csv", "k\n3\n4\n", mtime=1_200_000_000)
        return right(*args, **more)

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="changed while it was read"):
        m.setattr(bronze, "read_delimited", late)
        stage(spark, str(tmp_path), spec)
    assert [r.k for r in read_dataset(spark, str(tmp_path), spec).collect()] == [1]
    refresh(spark, str(tmp_path), {"d": spec})
    assert sorted(r.k for r in read_dataset(spark, str(tmp_path), spec).collect()) == [3, 4]


def test_a_written_table_is_a_source(spark, tmp_path):
    write_fact(spark.range(3), f"{tmp_path}/t.parquet")
    catalog = {"t": "t.parquet", "u": "u.parquet"}
    assert {r.dataset: r.state for r in dataset_status(spark, str(tmp_path), catalog).collect()} == {"t": "fresh", "u": "absent"}
    assert read_dataset(spark, str(tmp_path), "t.parquet").count() == 3


def test_a_documents_text_is_parsed_once(spark):
    """Neither the check of its one array nor the records parse it again, and its key is taken apart once for all records."""
    text = '[{"fecha":"2022-01-01","fecha":"2022-01-02","x":"1"}, null, {"indicativo":"3129"}]'
    documents = spark.createDataFrame([("3129_2022_01", text), ("a_2022_01", text + text), ("b_2022_01", None)], "documento string, texto string")
    records = parse_documents(documents, ["fecha", "indicativo"])
    assert [tuple(r) for r in records.drop("documento_estacion", "documento_mes").collect()] == [
        ("3129_2022_01", "2022-01-02", None, {"x": "1"}), ("3129_2022_01", None, "3129", {}),
    ]
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    assert "regexp_extract" not in plan[: plan.index("Generate")]
