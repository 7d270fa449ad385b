"""Conformed dimensions (B1-B3) built from the cleaned facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir.functions.text import prefix, safe_code, sentinel_to_null, strip, title_case
from terroir.operators.dedup import ORDINAL, keep_first_sorted, union_all
from terroir.quirks import PARITY, Quirks

SOURCE_RANK = "_source_rank"


def conformed_dimension(frames: Sequence[DataFrame], key: str, label: str, key_width: int,
                        pad: dict[str, int] | None = None, region_first: str | None = None
                        ) -> DataFrame:
    """B1/B2 core: union the frames (same columns), drop duplicate rows, pad
    the codes, title-case the label, then keep one row per key -- labelled
    rows first, ties decided by frame order, then by file order where all frames
    carry their ordinal (or, with `region_first`, rows where that column is set first).

    The union keeps a frame rank; duplicate rows collapse with partial
    aggregation, so a hot key is reduced before the shuffle."""
    pad = pad or {}
    ordered = all(ORDINAL in f.columns for f in frames)
    place = [F.col(ORDINAL)] if ordered else []
    ranked = [(f if ordered else f.drop(ORDINAL)).withColumn(SOURCE_RANK, F.struct(F.lit(i).alias("frame"), *place) if ordered else F.lit(i)).drop(ORDINAL)
              for i, f in enumerate(frames)]
    u = union_all(ranked)
    cols = [c for c in u.columns if c != SOURCE_RANK]
    # distinct rows: the earliest of identical rows wins
    u = u.groupBy(*cols).agg(F.min(SOURCE_RANK).alias(SOURCE_RANK))
    out = []
    for c in cols:
        if c == key:
            out.append(safe_code(F.col(c), key_width).alias(c))
        elif c == label:
            out.append(title_case(strip(sentinel_to_null(F.col(c).cast("string")))).alias(c))
        elif c in pad:
            v = sentinel_to_null(F.col(c).cast("string"))
            out.append(F.when(v.isNotNull(), safe_code(v, pad[c])).alias(c))
        else:
            out.append(F.col(c))
    u = u.select(*out, SOURCE_RANK)
    # ties: frame order and file order; without it the remaining columns, so that the pick is deterministic
    rest = [F.col(c).asc_nulls_last() for c in cols if c not in (key, label)]
    tie = [F.col(SOURCE_RANK), *rest]
    if region_first:
        tie = [F.col(region_first).isNull(), *tie]
    return keep_first_sorted(u, [key], [label], tie).drop(SOURCE_RANK)


def _order(df: DataFrame) -> list[str]:
    return [ORDINAL] if ORDINAL in df.columns else []


def _session(*frames):
    return next(f for f in frames if f is not None).sparkSession


def build_dim_commune(t1: DataFrame | None, t2: DataFrame | None, emploi: DataFrame | None,
                      revenus: DataFrame | None, quirks: Quirks = PARITY) -> DataFrame:
    """B1: communes (codgeo, libelle_commune, code_departement) from both
    election rounds and the two commune-level facts (absent frames: None).
    Ties inside one frame (same code and label) are decided by file order if the
    frames carry it, as the batch job's do."""
    frames = []
    for t in (t1, t2):
        if t is None:
            continue
        keyed = "code_commune" if quirks.commune_labels_need_code_commune else None
        src = None
        if keyed and {"code_commune", "libelle_commune", "code_departement"} <= set(t.columns):
            src = "code_commune"
        elif not keyed:
            for k in ("code_commune", "codgeo"):
                if {k, "libelle_commune", "code_departement"} <= set(t.columns):
                    src = k
                    break
        if src:
            frames.append(t.select(F.col(src).alias("codgeo"), "libelle_commune", "code_departement", *_order(t)))
    for f in (emploi, revenus):
        if f is not None and "codgeo" in f.columns:
            frames.append(f.select("codgeo", F.lit(None).cast("string").alias("libelle_commune"),
                                   prefix(F.col("codgeo").cast("string"), 2).alias("code_departement"), *_order(f)))
    if not frames:
        schema = "codgeo string, libelle_commune string, code_departement string"
        return _session(t1, t2, emploi, revenus).createDataFrame([], schema)
    return conformed_dimension(frames, "codgeo", "libelle_commune", 5, {"code_departement": 2})


def build_dim_departement(t1: DataFrame | None, t2: DataFrame | None, securite: DataFrame | None,
                          quirks: Quirks = PARITY, label: str = "Rhone") -> DataFrame:
    """B2: departments (code_departement, libelle_departement, code_region);
    the crime frame gets the constant label. Absent frames: None."""
    frames = []
    for t in (t1, t2):
        if t is not None and {"code_departement", "libelle_departement"} <= set(t.columns):
            frames.append(t.select("code_departement", "libelle_departement",
                                   F.lit(None).cast("string").alias("code_region"), *_order(t)))
    if securite is not None and {"code_departement", "code_region"} <= set(securite.columns):
        frames.append(securite.select("code_departement",
                                      F.lit(label).alias("libelle_departement"),
                                      F.col("code_region").cast("string").alias("code_region"), *_order(securite)))
    if not frames:
        schema = "code_departement string, libelle_departement string, code_region string"
        return _session(t1, t2, securite).createDataFrame([], schema)
    region_first = None if quirks.department_region_by_frame_order else "code_region"
    return conformed_dimension(frames, "code_departement", "libelle_departement", 2,
                               {"code_region": 2}, region_first=region_first)


# The year dimension.
TIME_ROWS = [
    (2021, "2021", "revenus"),
    (2022, "2022", "emploi_diplomes_logement"),
    (2024, "2024", "elections_securite"),
]


def build_dim_temps(spark: SparkSession) -> DataFrame:
    """Literal year dimension."""
    schema = T.StructType([T.StructField("annee", T.IntegerType()),
                           T.StructField("libelle_annee", T.StringType()),
                           T.StructField("periode_source", T.StringType())])
    return spark.createDataFrame(TIME_ROWS, schema)


__all__ = ["conformed_dimension", "build_dim_commune", "build_dim_departement",
           "build_dim_temps", "TIME_ROWS"]
