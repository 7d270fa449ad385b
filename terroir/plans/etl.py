"""The batch job (R1): extract the eight sources, clean them, conform keys,
load facts, build dimensions from the loaded facts, write the quality report
and create the two views.

Each cleaned table is written once as Parquet into a folder of its own run;
its delimited copy and every later reader (dimensions, views) read the
written files. Writes cut the lineage, so a lost executor costs a re-read of
a table, not a re-run of the cleaning; no cache is needed. Quality counts are
observed during the table writes; the raw rows are counted by one more scan.

Publishing is all or nothing: one small pointer file, replaced by an atomic
rename, names the run's folder, and is written only after every table and the
report were. Readers come in through it: `attach` registers the tables and the
two views in any session. A run that fails (or a driver that dies) leaves the
pointer, and so the previous run, in place; a re-run writes to a fresh folder.
"""

from __future__ import annotations

import datetime as _dt
import json
import logging
import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from terroir.operators.quality import QualityTracker, quality_report
from terroir.plans import clean as T
from terroir.plans.dimensions import build_dim_commune, build_dim_departement, build_dim_temps
from terroir.plans.views import register_views
from terroir.quirks import PARITY, Quirks
from terroir.operators.dedup import ORDINAL
from terroir.sources.delimited import SourceSpec, read_delimited
from terroir.sources.sinks import write_delimited, write_parquet

log = logging.getLogger("terroir.etl")
POINTER = "latest.json"  # no leading underscore: readers skip such files

# Default input file names and encodings of the eight sources.
DEFAULT_FILES = {
    "t1": ("Premier_tour_rhone_sep.csv", "utf-8"),
    "t2": ("Second_tour_rhone_sep.csv", "utf-8"),
    "securite": ("donnee-dep-data.gouv-2025-geographie2025-produit-le2026-01-22.csv", "latin1"),
    "emploi": ("emploi_et_pop-active_2022.CSV", "latin1"),
    "revenus": ("data_revenus_2021.csv", "latin1"),
    "diplomes": ("diplomes_et_formation-2022.CSV", "latin1"),
    "logement": ("logement-2022.CSV", "latin1"),
    "iris": ("contours-iris-metropole-lyon.csv", "utf-8"),
}

# Year key of each fact.
FACT_YEARS = {
    "fact_election_tour1": 2024,
    "fact_election_tour2": 2024,
    "fact_securite": 2024,
    "fact_emploi_pop_active": 2022,
    "fact_revenus": 2021,
    "fact_diplomes": 2022,
    "fact_logement": 2022,
}


@dataclass
class EtlConfig:
    data_path: str
    output_path: str                      # delimited copies, one folder per table
    table_path: str | None = None         # Parquet tables (default: <warehouse>/terroir)
    files: dict = field(default_factory=lambda: dict(DEFAULT_FILES))
    department: str = "69"
    commune_width: int = 5
    quirks: Quirks = PARITY
    single_file_csv: bool = False         # one part file per table (small tables only)
    bom: bool = True
    parallel_loads: int = 4               # independent table writes submitted concurrently

    def specs(self) -> list[SourceSpec]:
        out = []
        for k, (f, enc) in self.files.items():
            if k == "securite" and not self.quirks.securite_read_as_latin1:
                enc = "utf-8"          # Q5 corrected: the crime file is UTF-8
            out.append(SourceSpec(k, os.path.join(self.data_path, f), enc))
        return out


@dataclass
class EtlResult:
    tables: dict[str, DataFrame]
    report: DataFrame
    timings: dict[str, float]
    run_path: str = ""


def _load_all_concurrently(load, tables: dict[str, DataFrame], workers: int) -> None:
    """Run `load(name, df)` for every table from a small thread pool (Spark
    schedules the concurrent jobs); the first error is raised once all have
    finished."""
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        futures = [pool.submit(load, name, df) for name, df in tables.items()]
        errors = [f.exception() for f in futures if f.exception() is not None]
    if errors:
        raise errors[0]


def run(spark: SparkSession, cfg: EtlConfig) -> EtlResult:
    q = cfg.quirks
    timings: dict[str, float] = {}
    t0 = _dt.datetime.now()

    def mark(stage):
        timings[stage] = (_dt.datetime.now() - t0).total_seconds()
        log.info("stage %s done at %.3fs", stage, timings[stage])

    # extract: lazy scans (existence checked here), all columns text
    raw = {s.name: read_delimited(spark, s.path, s.encoding, s.sep) for s in cfg.specs()}
    mark("extract")

    # transform
    trackers: dict[str, QualityTracker] = {}

    def tr(name):
        trackers[name] = QualityTracker(name, T.NOTES[name], count_rejected=True, keep_order=True)
        return trackers[name]

    width, dep = cfg.commune_width, cfg.department
    facts = {
        "fact_election_tour1": T.clean_election(raw["t1"], "tour1", q, tr("fact_election_tour1")),
        "fact_election_tour2": T.clean_election(raw["t2"], "tour2", q, tr("fact_election_tour2")),
        "fact_securite": T.clean_securite(raw["securite"], dep, q, tr("fact_securite")),
        "fact_emploi_pop_active": T.clean_emploi(raw["emploi"], dep, width, q, tr("fact_emploi_pop_active")),
        "fact_revenus": T.clean_revenus(raw["revenus"], dep, width, q, tr("fact_revenus")),
        "fact_diplomes": T.clean_diplomes(raw["diplomes"], dep, width, q, tr("fact_diplomes")),
        "fact_logement": T.clean_logement(raw["logement"], dep, width, q, tr("fact_logement")),
    }
    iris = T.clean_iris(raw["iris"], q, tr("dim_iris_lyon"))
    for k in ("fact_election_tour1", "fact_election_tour2"):
        facts[k] = T.rename_geo_keys(facts[k])
    facts = {k: T.add_time_key(v, FACT_YEARS[k], q) for k, v in facts.items()}
    mark("transform")

    # load facts and the IRIS dimension (one write each; counts observed)
    root = (cfg.table_path or spark.conf.get("spark.sql.warehouse.dir") + "/terroir").rstrip("/")
    run_id = _dt.datetime.now().strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
    run_path = f"{root}/run={run_id}"
    csv_root = f"{cfg.output_path.rstrip('/')}/run={run_id}"
    loaded: dict[str, DataFrame] = {}

    def load(name: str, df: DataFrame):
        write_parquet(df, f"{run_path}/{name}", keep_order=True)  # the dimensions' ties ask for file order
        loaded[name] = spark.read.parquet(f"{run_path}/{name}")
        write_delimited(loaded[name], f"{csv_root}/{name}", bom=cfg.bom, single_file=cfg.single_file_csv)

    # the cleaned sources are independent: their jobs run concurrently (one
    # driver thread each), so small tables do not leave the cluster idle
    _load_all_concurrently(load, dict(facts, dim_iris_lyon=iris), cfg.parallel_loads)
    mark("load_facts")

    # dimensions from the loaded facts (independent of each other)
    dims = {
        "dim_commune": build_dim_commune(loaded["fact_election_tour1"], loaded["fact_election_tour2"],
                                         loaded["fact_emploi_pop_active"], loaded["fact_revenus"], q),
        "dim_departement": build_dim_departement(loaded["fact_election_tour1"],
                                                 loaded["fact_election_tour2"],
                                                 loaded["fact_securite"], q),
        "dim_temps": build_dim_temps(spark),
    }
    _load_all_concurrently(load, dims, cfg.parallel_loads)
    mark("dimensions")

    # quality report: one row per cleaned source, from the observed metrics
    stamp = _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    order = ["fact_election_tour1", "fact_election_tour2", "fact_securite", "fact_emploi_pop_active",
             "fact_revenus", "fact_diplomes", "fact_logement", "dim_iris_lyon"]
    report = quality_report(spark, [trackers[n].row(stamp) for n in order])
    write_delimited(report, f"{csv_root}/quality_report", bom=cfg.bom, single_file=True)
    mark("report")

    # publish: every table of this run is written; the pointer is the commit
    _replace_file(spark, f"{cfg.output_path.rstrip('/')}/{POINTER}", json.dumps(
        {"run": run_id, "tables": run_path, "csv": csv_root, "names": sorted(loaded)}))
    published = attach(spark, cfg.output_path)
    mark("publish")
    return EtlResult(published, report, timings, run_path)


def _replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside `path` and rename it over `path` (atomic)."""
    fs_ = spark._jvm.org.apache.hadoop.fs
    target = fs_.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    target = files.makeQualified(target)
    temp = fs_.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = files.create(temp, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(getattr(fs_, "Options$Rename"), 1)
    options[0] = getattr(fs_, "Options$Rename").OVERWRITE
    fs_.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(temp, target, options)


def latest_run(spark: SparkSession, output_path: str) -> dict:
    """The run id, folders and table names of the published run under `output_path`."""
    return json.loads(spark.read.text(f"{output_path.rstrip('/')}/{POINTER}", wholetext=True).first()[0])


def attach(spark: SparkSession, output_path: str) -> dict[str, DataFrame]:
    """Register the published tables and the two views in this session; returns
    the tables. All of them are of one run."""
    run_ = latest_run(spark, output_path)
    tables = {n: spark.read.parquet(f"{run_['tables']}/{n}").drop(ORDINAL) for n in run_["names"]}
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    register_views(spark, tables)
    return tables


__all__ = ["DEFAULT_FILES", "FACT_YEARS", "EtlConfig", "EtlResult", "run", "latest_run", "attach", "main"]


def main(argv: list[str] | None = None) -> None:
    """Command line: python -m terroir.plans.etl DATA_DIR OUTPUT_DIR [--tables DIR] [--corrected]"""
    import argparse

    from terroir.quirks import CORRECTED
    from terroir.session import build_session

    ap = argparse.ArgumentParser(prog="python -m terroir.plans.etl", description=main.__doc__)
    ap.add_argument("data_path")
    ap.add_argument("output_path")
    ap.add_argument("--tables", default=None, help="folder of the Parquet tables")
    ap.add_argument("--department", default="69")
    ap.add_argument("--corrected", action="store_true", help="corrected behaviour instead of parity")
    ap.add_argument("--single-file-csv", action="store_true")
    a = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s | %(levelname)s | %(message)s")
    spark = build_session(app="terroir-etl")
    cfg = EtlConfig(a.data_path, a.output_path, a.tables, department=a.department,
                    quirks=CORRECTED if a.corrected else PARITY, single_file_csv=a.single_file_csv)
    res = run(spark, cfg)
    res.report.show(truncate=False)
    log.info("published %d tables from %s; stages %s", len(res.tables), res.run_path, res.timings)


if __name__ == "__main__":
    main()
