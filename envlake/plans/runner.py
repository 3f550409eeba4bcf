"""Run the named jobs."""

from __future__ import annotations

import hashlib
import json
import posixpath
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from envlake.operators import preview, seed_copy
from envlake.plans.air import air_fact
from envlake.plans.weather import weather_fact
from envlake.schemas import AIR_YEARS, POLLUTANTS
from envlake.sources import (
    CATALOG,
    DatasetSpec,
    inline_table,
    read_dataset,
    read_table,
    register_views,
    write_fact,
)
from envlake.sources.bronze import (
    dataset_status,
    files_digest,
    read_staged_parts,
    stage_all,
    staged_parts,
)
from envlake.sources.versions import PART, current, manifest, replace_parts

_STATUS = "pipeline string, status string, detail string"


@dataclass(frozen=True)
class JobSpec:
    """Sources by alias, what to compute from them, and where it goes.

    ``build`` is a function of the source frames, or SQL text over views that
    carry the aliases. ``partition_by`` lays the output out in folders, so that
    readers skip those they do not ask for.

    ``row_wise`` are aliases whose rows become output rows one by one, whatever the other rows
    are. Then the output is kept in parts, one for each part of these sources, and a run computes
    those of new and changed parts only, all of them if another source changed; ``build``
    gets the rows' part in a column ``PART`` and must pass it on. A job whose code changed needs
    ``run(..., rebuild=True)``.
    """

    name: str
    sources: Mapping[str, str]
    build: Callable[[Mapping[str, DataFrame]], DataFrame] | str
    output: str
    partition_by: tuple[str, ...] = ()
    row_wise: tuple[str, ...] = ()


_YEARS = [f"aire{y}" for y in AIR_YEARS]


def _air(s: Mapping[str, DataFrame]) -> DataFrame:
    years, pollutants = [s[a] for a in _YEARS], [s[a] for a in POLLUTANTS]
    keep = [PART] if PART in years[0].columns else []
    return air_fact(years, pollutants, s["dimension_unidades_aire"], keep=keep)


def _weather(s: Mapping[str, DataFrame]) -> DataFrame:
    return weather_fact(s["aemet_raw"], s["seed_meteo"])


def _seed(s: Mapping[str, DataFrame]) -> DataFrame:
    return seed_copy(s["variable_src"])


# Job names, source aliases and output locations.
JOBS: tuple[JobSpec, ...] = (
    JobSpec(
        "aire_normalizado",
        {
            **{a: a for a in _YEARS},
            **{alias: f"aire24{p}" for alias, p in POLLUTANTS.items()},
            "dimension_unidades_aire": "dim_variable_aire_csv",
        },
        _air,
        "data/normalized/fact/calidad_aire_historico.parquet",
        row_wise=(*_YEARS, *POLLUTANTS),
    ),
    JobSpec(
        "seed_variables_aire",
        {"variable_src": "dim_variable_aire_csv"},
        _seed,
        "data/normalized/static_files/seed_variable_aire.parquet",
    ),
    JobSpec(
        "meteo_aemet_normalizado",
        {"aemet_raw": "aemet_climatologia_diaria", "seed_meteo": "dim_variable_meteo_csv"},
        _weather,
        "data/normalized/fact/meteo_aemet_historico.parquet",
    ),
    JobSpec(
        "seed_variable_meteo",
        {"variable_src": "dim_variable_meteo_csv"},
        _seed,
        "data/normalized/static_files/seed_variable_meteo.parquet",
    ),
)


def _result(spark: SparkSession, job: JobSpec, sources: Mapping[str, DataFrame]) -> DataFrame:
    if callable(job.build):
        return job.build(sources)
    # the caller's own views of these names come back afterwards
    views = [a for a in sources if spark.catalog.tableExists(a) and spark.catalog.getTable(a).isTemporary]
    theirs = {a: spark.table(a) for a in views}
    register_views(sources)
    try:
        return spark.sql(job.build.strip().rstrip(";"))
    finally:
        for alias in sources:
            spark.catalog.dropTempView(alias)
        register_views(theirs)


def _replace_changed(
    spark: SparkSession, root: str, job: JobSpec, catalog: Mapping[str, DatasetSpec | str], output: str, rebuild: bool
) -> None:
    """Bring the output's parts in line with those of the row-wise sources."""
    entries = {a: catalog[k] for a, k in job.sources.items()}
    others = files_digest(spark, root, {a: e for a, e in entries.items() if a not in job.row_wise})
    salt = f"{job.name}|{others}"

    def part_of(alias: str, part: str) -> str:
        return hashlib.sha1(f"{alias}|{part}|{salt}".encode()).hexdigest()

    now = None if rebuild else current(spark, output)
    noted = manifest(spark, output, now) if now else None
    known = {p["part"] for p in noted or []}
    wanted, todo, written = set(), {}, []
    for alias in job.row_wise:
        parts = staged_parts(spark, root, entries[alias])
        wanted |= {part_of(alias, p["part"]) for p in parts}
        todo[alias] = [p for p in parts if part_of(alias, p["part"]) not in known]
        written += [{"part": part_of(alias, p["part"]), "fuente": alias, "file": p["file"]} for p in todo[alias]]
    if noted is not None and not written and known == wanted:
        return

    def source(alias: str) -> DataFrame:
        if alias not in job.row_wise:
            return read_dataset(spark, root, entries[alias])
        rows = read_staged_parts(spark, root, entries[alias], todo[alias])
        return rows.withColumn(PART, F.sha1(F.concat_ws("|", F.lit(alias), F.col(PART), F.lit(salt))))

    frame = _result(spark, job, {a: source(a) for a in job.sources})
    schema = frame.drop(PART).schema
    if noted is not None and schema.jsonValue() != json.loads(now["schema"]):
        return _replace_changed(spark, root, job, catalog, output, True)
    kept = [p for p in noted or [] if p["part"] in wanted]
    replace_parts(spark, output, frame if written else None, kept, written, schema)


def _run_one(
    spark: SparkSession, root: str, job: JobSpec, catalog: Mapping[str, DatasetSpec | str], rebuild: bool
) -> tuple[str, str]:
    keys = list(dict.fromkeys(job.sources.values()))
    undeclared = [k for k in keys if k not in catalog]
    if undeclared:
        return "undeclared dataset", ", ".join(undeclared)
    output = posixpath.join(root, job.output)
    try:
        states = {
            r.dataset: r.state for r in dataset_status(spark, root, catalog, keys).collect()
        }
        absent = [k for k in keys if states[k] == "absent"]
        if absent:
            return "missing input", ", ".join(absent)
        stage_all(spark, root, [catalog[k] for k in keys if states[k] != "fresh"])
        if job.row_wise and not job.partition_by:
            _replace_changed(spark, root, job, catalog, output, rebuild)
        else:
            sources = {a: read_dataset(spark, root, catalog[k]) for a, k in job.sources.items()}
            write_fact(_result(spark, job, sources), output, job.partition_by)
    except Exception as e:  # whatever it is, the other jobs still run
        return "failed", _reason(e)
    return "ok", output


def _reason(error: Exception) -> str:
    """The innermost cause of a failed Spark job, else the message's first line."""
    lines = str(error).splitlines() or [type(error).__name__]
    causes = [line for line in lines if line.startswith("Caused by: ")]
    return causes[-1].removeprefix("Caused by: ") if causes else lines[0]


def run(
    spark: SparkSession,
    root: str,
    name: str | None = None,
    jobs: tuple[JobSpec, ...] = JOBS,
    catalog: Mapping[str, DatasetSpec | str] = CATALOG,
    rebuild: bool = False,
) -> DataFrame:
    """Run all jobs, or the one called ``name`` in any case, below the folder ``root``.

    Each job stages its stale sources, computes its table and replaces its output, which
    stays as it was if the job fails. A job with ``row_wise`` sources computes the rows of changed
    parts only, unless ``rebuild`` asks for all.
    A job that cannot run is reported and does not stop the others. One row per
    job: ``pipeline``, ``status`` and ``detail`` (the output, or what went wrong).
    """
    chosen = [j for j in jobs if name is None or j.name.lower() == name.lower()]
    if not chosen:
        return inline_table(spark, [(name, "unknown pipeline", "")], _STATUS)
    rows = [(j.name, *_run_one(spark, root, j, catalog, rebuild)) for j in chosen]
    return inline_table(spark, rows, _STATUS)


def written_previews(
    spark: SparkSession,
    status: DataFrame,
    rows: int = 5,
    order: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """The first rows of each table that :func:`run` reports as written, by job.

    ``order`` names the columns that a job's rows are ordered by, others come as written.
    """
    order = order or {}
    done = status.where("status = 'ok'").select("pipeline", "detail").collect()
    return {r.pipeline: preview(read_table(spark, r.detail), *order.get(r.pipeline, ()), rows=rows) for r in done}
