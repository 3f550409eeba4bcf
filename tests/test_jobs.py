"""The named jobs on hand-made files."""

import datetime as dt
import glob
import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from envlake import run
from envlake.queries import jobs as job_queries
from envlake.plans import JOBS, JobSpec, collect_observations
from envlake.plans.collector import _of_period
from envlake.schemas import HOURS, STATIONS
from envlake.operators import coverage, coverage_of_parts, dataset_summary, summary_of_parts
from envlake.sources import CATALOG, DatasetSpec, land_records, parse_documents, read_dataset, read_landed, read_raw_documents, read_table, refresh, refresh_summaries, rejects
from envlake.sources.summaries import summaries_path
from envlake.sources.versions import current, manifest
from tests.test_sources import put

AIR_HEADER = ";".join(["provincia", "municipio", "estacion", "magnitud", "punto muestreo", "anno", "mes", "dia", *HOURS])


def air_line(magnitud, year, **cells):
    return ";".join(["28", "79", "4", str(magnitud), "28079004_1", str(year), "1", "2", *[str(cells.get(h, "")) for h in HOURS]])


@pytest.fixture()
def root(tmp_path):
    air = [k for k in CATALOG if k.startswith("aire")]
    for n, key in enumerate(air):
        header = AIR_HEADER if n < 4 else AIR_HEADER.replace("punto muestreo", "punto_muestreo")
        put(tmp_path, CATALOG[key].path, f"{header}\n{air_line(1 + n % 2, 2020 + min(n, 4), h01=n, h24=0.5)}\n")
    put(tmp_path, CATALOG["dim_variable_aire_csv"].path, "MAGNITUD,VARIABLE,UNIDAD\n1,SO2,ug\n")
    put(
        tmp_path,
        CATALOG["aemet_climatologia_diaria"].path,
        "﻿fecha,indicativo,nombre,provincia,altitud,tmed,prec,tmin,tmax,dir,velmedia,racha,presMax,presMin,hrMedia,hrMax,hrMin,sol,horaracha\n"
        '2022-10-15,3129,"MADRID, C",MADRID,664,"12,5",Ip,,,99,,,,,,,,,09:45\n'
        "2022-10-16,3129,X,MADRID,664,,Acum,,,,,,,,,,,,\n",
    )
    put(tmp_path, CATALOG["dim_variable_meteo_csv"].path, "variable_meteo,uom\ntemp_media,C\n")
    return tmp_path


def statuses(frame):
    return {r.pipeline: r.status for r in frame.collect()}


def test_all_jobs(spark, root):
    assert statuses(run(spark, str(root))) == {j.name: "ok" for j in JOBS}
    air = read_table(spark, f"{root}/{JOBS[0].output}")
    assert air.columns == ["provincia", "municipio", "estacion", "magnitud", "punto_muestreo", "fecha", "uom", "uom_value"]
    assert air.schema["fecha"].dataType.simpleString() == "timestamp_ntz"
    assert air.count() == 26
    assert {(r.magnitud, r.uom) for r in air.collect()} == {(1, "ug"), (2, None)}
    assert {r.fecha for r in air.where("magnitud = 1 and uom_value = 0.5 and year(fecha) = 2020").collect()} == {dt.datetime(2020, 1, 2, 23)}
    weather = read_table(spark, f"{root}/{JOBS[2].output}")
    assert {(r.variable_meteo, r.uom, r.valor) for r in weather.collect()} == {
        ("temp_media", "C", 12.5), ("precipitacion", None, 0.0), ("viento_direccion", None, 99.0)
    }
    assert weather.columns == ["estacion_id", "estacion_nombre", "provincia", "altitud", "fecha", "variable_meteo", "uom", "valor"]
    seed = read_table(spark, f"{root}/{JOBS[1].output}")
    assert [tuple(r) for r in seed.collect()] == [(1, "SO2", "ug")] and seed.columns == ["MAGNITUD", "VARIABLE", "UNIDAD"]


def test_one_job_by_name_in_any_case(spark, root):
    assert statuses(run(spark, str(root), "SEED_Variables_Aire")) == {"seed_variables_aire": "ok"}
    assert not glob.glob(f"{root}/data/normalized/fact/*")
    assert statuses(run(spark, str(root), "none")) == {"none": "unknown pipeline"}


def test_a_job_that_cannot_run_does_not_stop_the_others(spark, root):
    (root / CATALOG["aire22"].path).rename(root / "elsewhere.csv")
    put(root, CATALOG["aemet_climatologia_diaria"].path, "version https://git-lfs.github.com/spec/v1\noid x\n")
    result = run(spark, str(root))
    assert statuses(result) == {
        "aire_normalizado": "missing input", "seed_variables_aire": "ok",
        "meteo_aemet_normalizado": "failed", "seed_variable_meteo": "ok",
    }
    details = {r.pipeline: r.detail for r in result.collect()}
    assert details["aire_normalizado"] == "aire22" and "LFS" in details["meteo_aemet_normalizado"]


def test_a_cell_that_does_not_fit_fails_its_job_only(spark, root):
    put(root, CATALOG["aire23"].path, f"{AIR_HEADER}\n{air_line(1, 2023, h01='12,5')}\n")
    result = run(spark, str(root))
    assert statuses(result)["aire_normalizado"] == "failed"
    assert statuses(result)["meteo_aemet_normalizado"] == "ok"
    assert "12,5" in result.where("status = 'failed'").first().detail


def test_jobs_given_as_sql(spark, root):
    put(root, "own.csv", "k;v\n1;2\n")
    jobs = (
        JobSpec("own", {"mine": "own", "dim": "dim_variable_aire_csv"}, "SELECT m.k, d.UNIDAD FROM mine m LEFT JOIN dim d ON m.k = d.MAGNITUD;", "out/own.parquet"),
        JobSpec("bad", {"mine": "own"}, "SELECT nothing FROM mine", "out/bad.parquet"),
        JobSpec("undeclared", {"mine": "nowhere"}, "SELECT 1", "out/x.parquet"),
    )
    catalog = {**CATALOG, "own": DatasetSpec("own.csv", ";", {"k": "int"})}
    assert statuses(run(spark, str(root), jobs=jobs, catalog=catalog)) == {
        "own": "ok", "bad": "failed", "undeclared": "undeclared dataset"
    }
    assert [tuple(r) for r in read_table(spark, f"{root}/out/own.parquet").collect()] == [(1, "ug")]
    assert not spark.catalog.tableExists("mine")


def test_output_in_folders(spark, root):
    run(spark, str(root), "aire_normalizado")
    whole = read_table(spark, f"{root}/{JOBS[0].output}")
    job = replace(JOBS[0], output="out/air.parquet", partition_by=("magnitud",))
    assert statuses(run(spark, str(root), jobs=(job,))) == {job.name: "ok"}
    split = read_table(spark, f"{root}/out/air.parquet")
    assert {p.rsplit("/", 1)[1] for p in glob.glob(f"{root}/out/air.parquet/_v.*/m*")} == {"magnitud=1", "magnitud=2"}
    assert sorted(map(str, split.select(whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_a_rewritten_source_reaches_the_output(spark, root):
    name = "seed_variable_meteo"
    run(spark, str(root), name)
    put(root, CATALOG["dim_variable_meteo_csv"].path, "variable_meteo,uom\na,b\nc,d\n", mtime=4_000_000_000)
    run(spark, str(root), name)
    assert read_table(spark, f"{root}/{JOBS[3].output}").count() == 2


def test_collector(spark, tmp_path):
    days = [{"fecha": f"2022-10-{d}", "indicativo": "3129", "nombre": "C", "prec": "1,7"} for d in (16, 15)]
    put(tmp_path, "raw/3129_2022_07.json", json.dumps(days))
    put(tmp_path, "raw/3195_2022_07.json", json.dumps([{"fecha": "2022-08-01", "indicativo": "3195", "prec": "Ip"}]))
    put(tmp_path, "raw/9999_2022_07.json", json.dumps([{"fecha": "2022-08-01", "indicativo": "9999"}]))
    records = read_raw_documents(spark, str(tmp_path / "raw"))
    csv = f"{tmp_path}/{CATALOG['aemet_climatologia_diaria'].path}"
    got = collect_observations(spark, records, csv, work=str(tmp_path / "work"))
    assert tuple(got["summary"].first()) == (3, dt.date(2022, 8, 1), dt.date(2022, 10, 16))
    assert {r.indicativo: r.n_dias for r in got["coverage"].collect()} == {s: {"3129": 2, "3195": 1}.get(s, 0) for s, _ in STATIONS}
    gone = {r.documento for r in got["missing_windows"].collect()}
    assert len(gone) == 48 and "3129_2022_07" not in gone and "3195_2022_01" in gone
    parts = sorted(glob.glob(f"{csv}/part-*"))
    lines = [line for p in parts for line in open(p, encoding="utf-8-sig").read().splitlines()[1:]]
    assert [line.split(",")[:2] for line in lines] == [["2022-10-15", "3129"], ["2022-10-16", "3129"], ["2022-08-01", "3195"]]


def test_collector_on_landed_records(spark, tmp_path):
    ddl = "fecha string, indicativo string, prec string"
    landed = str(tmp_path / "landed")
    rows = [("2022-10-15", "3129", "1,7"), ("2022-04-01", "3195", "Ip"), ("2022-02-01", "3195", "1")]
    land_records(spark.createDataFrame(rows, ddl), landed, "2022-03-15")
    records = read_landed(spark, landed, ["fecha", "indicativo", "prec"])
    got = collect_observations(spark, records, str(tmp_path / "o.csv"), start="2022-03-15", end="2022-12-31", work=str(tmp_path))
    gone = {r.documento for r in got["missing_windows"].collect()}
    assert len(gone) == 8 and not gone & {"3129_2022_07", "3195_2022_03"}
    assert got["observations"].columns == ["fecha", "indicativo", "prec"]


def test_nothing_collected_leaves_the_csv(spark, tmp_path):
    csv = f"{tmp_path}/o.csv"
    put(tmp_path, "raw/3129_2022_07.json", json.dumps([{"fecha": "2022-08-01", "indicativo": "3129", "nuevo": "x"}]))
    got = collect_observations(spark, read_raw_documents(spark, str(tmp_path / "raw")), csv, work=str(tmp_path / "a"))
    assert got["observations"].first()["nuevo"] == "x" and got["work"].first()["path"] == f"{tmp_path}/a/clean"
    before = sorted(glob.glob(f"{csv}/*"))
    none = read_raw_documents(spark, str(tmp_path / "raw")).limit(0)
    again = collect_observations(spark, none, csv, work=str(tmp_path / "b"))
    assert again["observations"].count() == 0 and before and sorted(glob.glob(f"{csv}/*")) == before


def test_keys_that_clash_with_columns_are_kept(spark, tmp_path):
    keys = {"FECHA": "a", "documento": "b", "ventana": "c", "otros": "d", "_fecha": "e", "Nota": "f", "nota": "g"}
    put(tmp_path, "raw/3129_2022_07.json", json.dumps([{"fecha": "2022-08-01", "indicativo": "3129", **keys}]))
    records = read_raw_documents(spark, str(tmp_path / "raw"), ["fecha", "indicativo"])
    got = collect_observations(spark, records, f"{tmp_path}/o.csv", work=str(tmp_path / "a"))["observations"].first().asDict()
    assert (str(got["fecha"]), got["indicativo"]) == ("2022-08-01", "3129")
    assert {k: v for k, v in got.items() if k not in ("fecha", "indicativo")} == {
        "__FECHA": "a", "_documento": "b", "_ventana": "c", "otros": "d", "_fecha": "e", "Nota": "f", "_nota": "g",
    }


def test_rare_keys_stay_in_one_column(spark, tmp_path):
    """The driver sees a bounded list of keys, and no value is lost, in the CSV neither."""
    days = [{"fecha": f"2022-08-{d:02d}", "indicativo": "3129", f"k{d}": str(d), "nuevo": "x", "otros": "y"} for d in range(1, 29)]
    put(tmp_path, "raw/3129_2022_07.json", json.dumps(days))
    records = read_raw_documents(spark, str(tmp_path / "raw"), ["fecha", "indicativo"])
    got = collect_observations(spark, records, f"{tmp_path}/o.csv", work=str(tmp_path / "a"), key_columns=2)["observations"]
    assert got.columns == ["fecha", "indicativo", "nuevo", "_otros", "otros"]
    assert {(r.fecha.day, r.nuevo, r["_otros"], tuple(r.otros.items())) for r in got.collect()} == {
        (d, "x", "y", ((f"k{d}", str(d)),)) for d in range(1, 29)
    }
    back = spark.read.csv(f"{tmp_path}/o.csv", header=True, quote='"', escape='"')
    assert {r.otros for r in back.collect()} == {json.dumps({f"k{d}": str(d)}, separators=(",", ":")) for d in range(1, 29)}


def test_period_prunes_landed_folders(spark, tmp_path):
    rows = [("2021-02-01", "3129"), ("2022-02-01", "3129"), ("2022-08-01", "3129")]
    land_records(spark.createDataFrame(rows, "fecha string, indicativo string"), str(tmp_path / "l"))
    records = read_landed(spark, str(tmp_path / "l"), ["fecha", "indicativo"])
    plan = _of_period(records, "2022-03-01", "2022-12-31")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("]")[0]
    assert ">= 2022-01-01" in filters and "<= 2022-12-31" in filters


def test_a_job_gives_the_callers_views_back(spark, root):
    spark.range(3).createOrReplaceTempView("m")
    job = JobSpec("own", {"m": "dim_variable_aire_csv", "n": "dim_variable_meteo_csv"}, "SELECT m.magnitud FROM m", "out/own.parquet")
    assert statuses(run(spark, str(root), jobs=(job,))) == {"own": "ok"}
    assert spark.table("m").count() == 3 and not spark.catalog.tableExists("n")
    spark.catalog.dropTempView("m")


def test_a_failed_job_keeps_its_output_and_copy(spark, root):
    name = "seed_variables_aire"
    run(spark, str(root), name)
    put(root, CATALOG["dim_variable_aire_csv"].path, "MAGNITUD,VARIABLE,UNIDAD\nx,SO2,ug\n", mtime=4_000_000_000)
    assert statuses(run(spark, str(root), name)) == {name: "failed"}
    assert read_table(spark, f"{root}/{JOBS[1].output}").count() == 1
    assert read_dataset(spark, root, CATALOG["dim_variable_aire_csv"]).count() == 1
    assert not glob.glob(f"{root}/**/_*.new", recursive=True) and not glob.glob(f"{root}/**/_*.old", recursive=True)


def test_preview_is_of_a_job_over_all_rows(spark, monkeypatch):
    written = []
    plain = job_queries.written_previews
    monkeypatch.setattr(job_queries, "written_previews", lambda *a, **b: written.append(a[1].first().detail) or plain(*a, **b))
    sf_dir = "/root/testdata/sf0.001"
    got = [r.o_orderkey for r in job_queries.job_preview(spark, sf_dir).collect()]
    keys = sorted(r.o_orderkey for r in spark.read.parquet(f"{sf_dir}/orders.parquet").collect())
    assert got == keys[:5] and read_table(spark, written[0]).count() == len(keys) > 5


def parts_of(spark, path):
    return {(p["fuente"], p["file"]): p["folder"] for p in manifest(spark, path)}


def test_only_changed_files_are_computed_again(spark, root):
    name, out = JOBS[0].name, f"{root}/{JOBS[0].output}"
    whole = lambda: sorted(map(str, read_table(spark, out).collect()))
    assert statuses(run(spark, str(root), name)) == {name: "ok"}
    first, folders = whole(), parts_of(spark, out)
    assert len(folders) == 13 and read_table(spark, out).columns[-1] == "uom_value"
    number = current(spark, out)["number"]
    run(spark, str(root), name)  # nothing changed: no new version
    assert current(spark, out)["number"] == number

    path = CATALOG["aire21"].path
    put(root, path, f"{AIR_HEADER}\n{air_line(1, 2021, h05=7)}\n", mtime=4_000_000_000)
    run(spark, str(root), name)
    now = parts_of(spark, out)
    assert {k for k in now if now[k] != folders[k]} == {("aire21", path.rsplit("/", 1)[1])}
    changed = whole()
    assert len(set(changed) - set(first)) == 1 and len(set(first) - set(changed)) == 2
    run(spark, str(root), name, rebuild=True)
    assert whole() == changed and not set(parts_of(spark, out).values()) & set(now.values())

    put(root, path, f"{AIR_HEADER}\n", mtime=4_100_000_000)  # without rows
    run(spark, str(root), name)
    assert len(whole()) == len(first) - 2 and len(parts_of(spark, out)) == 13
    put(root, CATALOG["dim_variable_aire_csv"].path, "MAGNITUD,VARIABLE,UNIDAD\n1,SO2,mg\n", mtime=4_000_000_000)
    run(spark, str(root), name)  # another unit: every part again
    assert {r.uom for r in read_table(spark, out).collect()} == {"mg", None}


def test_a_failed_run_keeps_parts(spark, root):
    name, out = JOBS[0].name, f"{root}/{JOBS[0].output}"
    run(spark, str(root), name)
    before = parts_of(spark, out)
    put(root, CATALOG["aire22"].path, f"{AIR_HEADER}\n{air_line(1, 2022, h05='x')}\n", mtime=4_000_000_000)
    assert statuses(run(spark, str(root), name)) == {name: "failed"}
    assert parts_of(spark, out) == before and read_table(spark, out).count() == 26


def test_summaries_of_parts_give_the_same_reports(spark, tmp_path):
    spec = DatasetSpec("d.csv", ",", {"fecha": "date"})
    for i in range(4):
        lines = "".join(f"2022-0{1 + (i + j) % 6}-{10 + j},S{j % 3}\n" for j in range(5 * i))
        put(tmp_path, f"d.csv/{i}.csv", f"fecha,indicativo\n{lines}", mtime=1_000_000_000)
    stations = spark.createDataFrame([(f"S{i}",) for i in range(4)], "indicativo string")

    def check():
        refresh(spark, str(tmp_path), {"d": spec})
        found, rows = refresh_summaries(spark, str(tmp_path), spec), read_dataset(spark, str(tmp_path), spec)
        assert coverage_of_parts(stations, found, "2022-01-01", "2022-12-31").orderBy("indicativo").collect() == (
            coverage(stations, rows, "2022-01-01", "2022-12-31").orderBy("indicativo").collect()
        )
        assert summary_of_parts(found).collect() == dataset_summary(rows).collect()
        report = coverage_of_parts(stations, found, "2022-01-01", "2022-12-31")
        read = [f for f in report.inputFiles()]
        assert all("resumen.parquet" in f for f in read)
        return {p["file"]: p["folder"] for p in manifest(spark, summaries_path(str(tmp_path), spec))}

    before = check()
    put(tmp_path, "d.csv/2.csv", "fecha,indicativo\n2021-01-01,S3\n", mtime=1_100_000_000)
    put(tmp_path, "d.csv/1.csv", "fecha,indicativo\n", mtime=1_100_000_000)
    os.remove(tmp_path / "d.csv/3.csv")
    after = check()
    assert after["0.csv"] == before["0.csv"] and after.keys() == {"0.csv", "1.csv", "2.csv"}
    assert check() == after


def test_cells_that_do_not_fit_are_listed_where_allowed(spark, root):
    """Three bad cells: the fact of all others, and three rejects; without leave the job fails."""
    path = CATALOG["aire22"].path
    bad = [air_line(1, 2022, h01="1,5", h02=3), air_line(2, 2022, h05="x", h06="n/d", h07=2.5)]
    put(root, path, f"{AIR_HEADER}\n" + "\n".join([air_line(1, 2022, h01=9), *bad]) + "\n")
    name = JOBS[0].name
    assert statuses(run(spark, str(root), name)) == {name: "failed"}
    for most in (2, 3):
        catalog = {**CATALOG, "aire22": replace(CATALOG["aire22"], max_rejects=most)}
        assert statuses(run(spark, str(root), name, catalog=catalog)) == {name: "failed" if most == 2 else "ok"}
    fact = read_table(spark, f"{root}/{JOBS[0].output}")
    assert "__linea" not in fact.columns
    assert sorted(r.uom_value for r in fact.where("year(fecha) = 2022").collect()) == [2.5, 3.0, 9.0]
    listed = rejects(spark, str(root), catalog["aire22"]).collect()
    assert sorted((r.columna, r.texto, r.fichero, r.linea) for r in listed) == [
        ("h01", "1,5", path.rsplit("/", 1)[1], bad[0]), ("h05", "x", path.rsplit("/", 1)[1], bad[1]), ("h06", "n/d", path.rsplit("/", 1)[1], bad[1]),
    ]
    assert rejects(spark, str(root), CATALOG["aire21"]).count() == 0
    put(root, path, f"{AIR_HEADER}\n{air_line(1, 2022, h01=9)}\n1;2;3\n", mtime=4_000_000_000)  # a line with too few cells
    assert statuses(run(spark, str(root), name, catalog=catalog)) == {name: "ok"}
    assert [(r.columna, r.texto, r.linea) for r in rejects(spark, str(root), catalog["aire22"]).collect()] == [(None, None, "1;2;3")]


@pytest.mark.parametrize("name", ["collected_weather_fact", "collected_missing_windows", "collected_coverage", "collected_observations"])
def test_documents_of_one_file_are_parsed_in_many_tasks(spark, tmp_path, monkeypatch, name):
    customers = spark.range(8, 400).selectExpr("id AS c_custkey", "concat('n', id) AS c_name", "CAST(8 AS INT) AS c_nationkey", "1.5D AS c_acctbal")
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(25).selectExpr("CAST(id AS INT) AS n_nationkey", "'u' AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    seen = []

    def parsed(documents, *fields):
        seen.append(documents.select(F.spark_partition_id()).distinct().count())
        return parse_documents(documents, *fields)

    monkeypatch.setattr(job_queries, "parse_documents", parsed)
    job_queries.QUERIES[name](spark, str(tmp_path))
    assert seen[0] > 1


@pytest.mark.parametrize("name", ["collected_weather_fact", "collected_missing_windows"])
def test_windows_of_stations_of_one_file_are_made_in_many_tasks(spark, tmp_path, monkeypatch, name):
    customers = spark.range(8, 400).selectExpr("id AS c_custkey", "concat('n', id) AS c_name", "CAST(8 AS INT) AS c_nationkey", "1.5D AS c_acctbal")
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(25).selectExpr("CAST(id AS INT) AS n_nationkey", "'u' AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    seen = []

    def collected(spark_, records, csv, stations, *period):
        seen.append(stations.select(F.spark_partition_id()).distinct().count())
        return collect_observations(spark_, records, csv, stations, *period)

    monkeypatch.setattr(job_queries, "collect_observations", collected)
    job_queries.QUERIES[name](spark, str(tmp_path))
    assert seen[0] > 1
