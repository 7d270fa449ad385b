"""Analytical views (V1, V2) as DataFrame functions; `register_*` also
publish them as views in the session catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.functions.numeric import guarded_percentage
from terroir.operators.schema import select_except

def elections_view(fact: DataFrame, dim_commune: DataFrame, dim_departement: DataFrame) -> DataFrame:
    """V1: election fact x commune x department with the turnout percentage."""
    f = fact.alias("f")
    dc = dim_commune.alias("dc")
    dd = dim_departement.alias("dd")
    j = (f.join(dc, F.col("f.codgeo") == F.col("dc.codgeo"), "left")
          .join(dd, F.col("f.code_departement") == F.col("dd.code_departement"), "left"))
    return j.select(
        F.col("f.codgeo").alias("codgeo"), F.col("dc.libelle_commune").alias("libelle_commune"),
        F.col("dd.libelle_departement").alias("libelle_departement"),
        F.col("f.annee").alias("annee"),
        *[F.col(f"f.{c}").alias(c) for c in ("inscrits", "votants", "blancs", "nuls", "exprimes")],
        guarded_percentage(F.col("f.votants"), F.col("f.inscrits")).alias("taux_participation"))


def _suffix_duplicates(names: Sequence[str]) -> list[str]:
    """Second and later occurrences of a name get _1, _2 ... (the SQL
    engine's rule for duplicate output names)."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n in seen:
            seen[n] += 1
            out.append(f"{n}_{seen[n]}")
        else:
            seen[n] = 0
            out.append(n)
    return out


def territories_view(dim_commune: DataFrame, dim_departement: DataFrame,
                     revenus: DataFrame, emploi: DataFrame, key: str = "codgeo") -> DataFrame:
    """V2: commune x department x income x employment; every fact column but
    the key, duplicate names (the two year keys) suffixed `_1`."""
    return dimension_facts_view(dim_commune, key, ["libelle_commune"],
                                (dim_departement, "code_departement", ["libelle_departement"]), [revenus, emploi])


def register_views(spark, tables: dict[str, DataFrame]) -> None:
    """Create both views as temporary views over the given tables."""
    elections_view(tables["fact_election_tour1"], tables["dim_commune"],
                   tables["dim_departement"]).createOrReplaceTempView("vw_elections_communes")
    territories_view(tables["dim_commune"], tables["dim_departement"], tables["fact_revenus"],
                     tables["fact_emploi_pop_active"]).createOrReplaceTempView(
        "vw_indicateurs_territoires")


def dimension_facts_view(base: DataFrame, key: str, base_labels: Sequence[str],
                         lookup: tuple[DataFrame, str, Sequence[str]] | None,
                         facts: Sequence[DataFrame]) -> DataFrame:
    """V2 in general form: a dimension, an optional second dimension looked up
    through one of its columns, then each fact (one row per key) LEFT-joined
    on the key with all its columns but the key (star with exclusion);
    repeated names get `_1`, `_2` ... in join order."""
    b = base.alias("b")
    exprs, names = [F.col(f"b.{key}")], [key]
    exprs += [F.col(f"b.{c}") for c in base_labels]
    names += list(base_labels)
    j = b
    if lookup is not None:
        ldf, lkey, lcols = lookup
        j = j.join(ldf.alias("l"),
                   F.col(f"b.{lkey}") == F.col(f"l.{lkey}"), "left")
        exprs += [F.col(f"l.{c}") for c in lcols]
        names += list(lcols)
    for i, fdf in enumerate(facts):
        a = f"f{i}"
        j = j.join(fdf.alias(a), F.col(f"b.{key}") == F.col(f"{a}.{key}"), "left")
        rest = select_except(fdf, [key]).columns
        exprs += [F.col(f"{a}.`{c}`") for c in rest]
        names += rest
    names = _suffix_duplicates(names)
    return j.select(*[e.alias(n) for e, n in zip(exprs, names)])


__all__ = ["elections_view", "territories_view", "dimension_facts_view", "register_views"]
