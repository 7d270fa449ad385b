"""Cleaning plans of the eight raw sources.

Each plan is a function raw DataFrame -> cleaned DataFrame, composed from the
operators; territory prefix, code widths and key names are parameters with
the original job's values as defaults. A `QualityTracker` drops the rows that a
filter rejects (or carries their number along) and observes the deduplicated
ones during the (later) write action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.functions.numeric import parse_int, parse_number
from terroir.functions.text import (remove_substring, safe_code, strip, strip_char, title_case, upper,
                                    zero_pad)
from terroir.operators.cleaning import clean_label_columns, computed_once
from terroir.operators.dedup import ORDINAL
from terroir.operators.filters import any_present, consistent_votes, territory_predicate
from terroir.operators.quality import REJECTED, QualityTracker, counted_distinct, counted_first
from terroir.operators.schema import (ascii_columns, drop_all_null_columns, map_columns, normalize_columns,
                                      rename_columns, rename_position, require_columns)
from terroir.quirks import PARITY, Quirks

# Column names of the sources and the notes of the quality report.
ELECTION_REQUIRED = ["code_commune", "code_departement", "inscrits", "votants", "blancs", "nuls",
                     "exprimes"]
ELECTION_VOTES = ["inscrits", "abstentions", "votants", "blancs", "nuls", "exprimes"]
ELECTION_TEXT = ["libelle_commune", "libelle_circonscription", "libelle_departement", "libelle_region"]
SECURITE_NUMERIC = ["nombre", "taux_pour_mille", "insee_pop", "insee_log"]
IRIS_KEYS = ["codeiris", "codgeo", "typ_iris", "lab_iris"]
NOTES = {
    "fact_election_tour1": "Nettoyage élection + contrôle cohérence votants/exprimes",
    "fact_election_tour2": "Nettoyage élection + contrôle cohérence votants/exprimes",
    "fact_securite": "Filtre Rhône + conversion colonnes numériques",
    "fact_emploi_pop_active": "Filtre Rhône niveau commune",
    "fact_revenus": "Filtre Rhône niveau commune/IRIS selon source",
    "fact_diplomes": "Filtre Rhône niveau IRIS",
    "fact_logement": "Filtre Rhône niveau IRIS",
    "dim_iris_lyon": "Nettoyage référentiel IRIS Lyon",
}


def _tracker(tracker: QualityTracker | None, name: str) -> QualityTracker:
    return tracker if tracker is not None else QualityTracker(name, NOTES.get(name, ""))


def _territory(t: QualityTracker, df: DataFrame, column: str, prefix: str, length: int, quirks: Quirks) -> DataFrame:
    return t.keep(df, territory_predicate(column, prefix, length,
                                          exact_length=not quirks.territory_min_length))


def _keep_first(df: DataFrame, key: str) -> DataFrame:
    """First row per key in file order (the ordinal captured at the scan; a
    caller may put any orderable struct in that column instead)."""
    if ORDINAL not in df.columns:
        raise ValueError("keep-first needs the file-order ordinal column "
                         f"{ORDINAL!r} (read_delimited(..., ordinal=True))")
    return counted_first(df, key, ORDINAL)


def _distinct(t: QualityTracker, df: DataFrame) -> DataFrame:
    """D1 on the cleaned columns. The file-order ordinal does not count: the
    first copy's is kept if the tracker asks for it, else it is dropped and the
    deduplication stays a hash aggregation."""
    if ORDINAL not in df.columns:
        return counted_distinct(df)
    return counted_distinct(df, ORDINAL) if t.keep_order else counted_distinct(df.drop(ORDINAL))


def clean_election(df: DataFrame, label: str, quirks: Quirks = PARITY,
                   tracker: QualityTracker | None = None) -> DataFrame:
    """One election round."""
    t = _tracker(tracker, f"fact_election_{label}")
    df = normalize_columns(df)
    require_columns(df, ELECTION_REQUIRED, f"election_{label}")
    df = drop_all_null_columns(df, ["code_canton", "libelle_canton"])
    df = t.raw(df)
    numeric = [c for c in ELECTION_VOTES if c in df.columns] + \
        [c for c in df.columns if c.startswith("ratio_")]
    df = computed_once(map_columns(df, parse_number, only=numeric))
    df = t.keep(df, consistent_votes(df))
    df = clean_label_columns(df, ELECTION_TEXT, quirks)
    out = []
    for c in df.columns:
        if c == "code_commune":
            out.append(safe_code(F.col(c), 5, quirks).alias(c))
        elif c == "code_departement":
            out.append(safe_code(F.col(c), 2, quirks).alias(c))
        elif c == "code_circonscription":
            out.append(safe_code(F.col(c), None, quirks).alias(c))
        elif c == "id_brut_miom":
            out.append(remove_substring(safe_code(F.col(c), None, quirks), "_").alias(c))
        else:
            out.append(F.col(c))
    df = df.select(*out)
    df = _distinct(t, df)
    return t.final(df, exclude=[ORDINAL])


def clean_securite(df: DataFrame, department: str = "69", quirks: Quirks = PARITY,
                   tracker: QualityTracker | None = None) -> DataFrame:
    """Crime statistics of one department."""
    t = _tracker(tracker, "fact_securite")
    df = t.raw(df)
    df = normalize_columns(df)
    df = rename_position(df, 0, "code_departement")
    require_columns(df, ["code_departement", "code_region", "annee"], "fact_securite")
    out = []
    for c in df.columns:
        if c == "code_departement":
            out.append(zero_pad(strip_char(safe_code(F.col(c), None, quirks), '"'), 2).alias(c))
        elif c == "code_region":
            out.append(safe_code(F.col(c), 2, quirks).alias(c))
        elif c in SECURITE_NUMERIC:
            out.append(parse_number(F.col(c)).alias(c))
        elif c == "annee":
            out.append(parse_int(F.col(c)).try_cast("int").alias(c))
        else:
            out.append(F.col(c))
    df = t.keep(df.select(*out), F.col("code_departement") == F.lit(department))
    df = _distinct(t, df)
    return t.final(df, exclude=[ORDINAL])


def _clean_commune_measures(df: DataFrame, name: str, drop_empty: bool, prefix: str,
                            length: int, quirks: Quirks, tracker: QualityTracker | None) -> DataFrame:
    t = _tracker(tracker, name)
    df = t.raw(df)
    df = normalize_columns(df)
    require_columns(df, ["codgeo"], name)
    df = _territory(t, df, "codgeo", prefix, length, quirks)
    df = df.withColumn("codgeo", safe_code(F.col("codgeo"), length, quirks))
    df = computed_once(map_columns(df, parse_number, exclude=["codgeo", ORDINAL, REJECTED]))
    if drop_empty:
        df = t.keep(df, any_present(df, [c for c in df.columns if c not in ("codgeo", ORDINAL, REJECTED)]))
    df = _keep_first(df, "codgeo")
    return t.final(df, exclude=[ORDINAL])


def clean_emploi(df: DataFrame, prefix: str = "69", length: int = 5, quirks: Quirks = PARITY,
                 tracker: QualityTracker | None = None) -> DataFrame:
    """Employment per commune."""
    return _clean_commune_measures(df, "fact_emploi_pop_active", True, prefix, length, quirks, tracker)


def clean_revenus(df: DataFrame, prefix: str = "69", length: int = 5, quirks: Quirks = PARITY,
                  tracker: QualityTracker | None = None) -> DataFrame:
    """T4: income per commune (rows with only missing measures are kept)."""
    return _clean_commune_measures(df, "fact_revenus", False, prefix, length, quirks, tracker)


def _clean_iris_measures(df: DataFrame, name: str, ascii_names: bool, prefix: str, length: int,
                         quirks: Quirks, tracker: QualityTracker | None) -> DataFrame:
    t = _tracker(tracker, name)
    df = t.raw(df)
    df = normalize_columns(df)
    df = rename_columns(df, {"iris": "codeiris", "com": "codgeo"})
    if ascii_names:
        df = ascii_columns(df, keep=[ORDINAL])
    require_columns(df, ["codeiris", "codgeo"], name)
    df = df.withColumn("codgeo", strip(F.col("codgeo")))
    df = _territory(t, df, "codgeo", prefix, length, quirks)
    keys = set(IRIS_KEYS)
    out = []
    for c in df.columns:
        if c == "codgeo":
            out.append(safe_code(F.col(c), length, quirks).alias(c))
        elif c == "codeiris":
            out.append(safe_code(F.col(c), None, quirks).alias(c))
        elif c in keys or c in (ORDINAL, REJECTED):
            out.append(F.col(c))
        else:
            out.append(parse_number(F.col(c)).alias(c))
    df = computed_once(df.select(*out))
    df = t.keep(df, any_present(df, [c for c in df.columns if c not in keys and c not in (ORDINAL, REJECTED)]))
    df = _keep_first(df, "codeiris")
    return t.final(df, exclude=[ORDINAL])


def clean_diplomes(df: DataFrame, prefix: str = "69", length: int = 5, quirks: Quirks = PARITY,
                   tracker: QualityTracker | None = None) -> DataFrame:
    """T5: education per IRIS (column names made ASCII)."""
    return _clean_iris_measures(df, "fact_diplomes", True, prefix, length, quirks, tracker)


def clean_logement(df: DataFrame, prefix: str = "69", length: int = 5, quirks: Quirks = PARITY,
                   tracker: QualityTracker | None = None) -> DataFrame:
    """Housing per IRIS."""
    return _clean_iris_measures(df, "fact_logement", False, prefix, length, quirks, tracker)


def clean_iris(df: DataFrame, quirks: Quirks = PARITY, tracker: QualityTracker | None = None) -> DataFrame:
    """IRIS reference table."""
    t = _tracker(tracker, "dim_iris_lyon")
    df = t.raw(df)
    df = normalize_columns(df)
    require_columns(df, ["codeiris"], "dim_iris_lyon")
    out = []
    for c in df.columns:
        if c in ("codeiris", "insee"):
            out.append(safe_code(F.col(c), None, quirks).alias(c))
        elif c == "gid":
            out.append(parse_number(F.col(c), decimal_comma=False).alias(c))
        elif c in ("libelle", "commune", "typelibelle"):
            out.append(title_case(safe_code(F.col(c), None, quirks)).alias(c))
        elif c == "type":
            out.append(upper(safe_code(F.col(c), None, quirks)).alias(c))
        else:
            out.append(F.col(c))
    df = df.select(*out)
    df = _keep_first(df, "codeiris")
    return t.final(df, exclude=[ORDINAL])


def rename_geo_keys(df: DataFrame) -> DataFrame:
    """C2 conditional: code_commune -> codgeo unless codgeo exists."""
    return rename_columns(df, {"code_commune": "codgeo"}, only_if_absent=True)


def add_time_key(df: DataFrame, year: int, quirks: Quirks = PARITY) -> DataFrame:
    """The year key of a fact (overwrites an existing year for parity, Q3)."""
    if not quirks.year_key_overwrites and "annee" in df.columns:
        return df
    return df.withColumn("annee", F.lit(year))


__all__ = ["clean_election", "clean_securite", "clean_emploi", "clean_revenus", "clean_diplomes",
           "clean_logement", "clean_iris", "rename_geo_keys", "add_time_key"]
