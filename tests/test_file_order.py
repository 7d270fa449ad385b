"""Ties of the conformed dimensions are decided by file order, as pandas decides them."""

import os

import pandas as pd
from pyspark.sql import functions as F

from terroir.operators.dedup import ORDINAL
from terroir.plans.dimensions import conformed_dimension
from terroir.plans.etl import EtlConfig, attach, latest_run, run
from terroir.quirks import Quirks


def pandas_dimension(frames):
    """Concatenate, drop duplicates, pad and title-case, sort by key and label, keep the first row per key."""
    dim = pd.concat(frames, ignore_index=True).drop_duplicates()
    dim["code"] = dim["code"].str.strip().str.zfill(3)
    dim["label"] = dim["label"].str.strip().str.title()
    dim = dim.sort_values(["code", "label"], na_position="last").drop_duplicates(subset=["code"], keep="first")
    return sorted(tuple(None if pd.isna(v) else v for v in r) for r in dim[["code", "label", "zone"]].itertuples(index=False, name=None))


def test_dimension_ties_equal_pandas(spark):
    """Many rows of one code and label that differ in the third column, in two frames, out of order in Spark."""
    frames = []
    for f in range(2):
        rows = [(str(k * 7 % 23), None if k % 5 == 0 else f"ville {k * 7 % 23 % 4}", f"z{(k * 31 + f) % 9}") for k in range(200)]
        frames.append(pd.DataFrame(rows, columns=["code", "label", "zone"]))
    shuffled = []
    for pdf in frames:
        df = spark.createDataFrame(pdf.reset_index(), "index long, code string, label string, zone string")
        place = F.struct(F.lit("f").alias("file"), (F.col("index") / 50).cast("long").alias("block"), F.col("index").alias("pos")).alias(ORDINAL)
        shuffled.append(df.select("code", "label", "zone", place).repartition(7, "zone"))
    got = conformed_dimension(shuffled, "code", "label", 3)
    assert got.columns == ["code", "label", "zone"]
    assert sorted(map(tuple, got.collect())) == pandas_dimension(frames)


def test_frames_without_order_still_agree(spark):
    a = spark.createDataFrame([("1", "x", "b"), ("1", "x", "a")], "code string, label string, zone string")
    b = a.withColumn(ORDINAL, F.struct(F.lit("f").alias("file"), F.lit(0).alias("block"), F.col("zone").alias("pos")))
    assert [tuple(r) for r in conformed_dimension([a, b], "code", "label", 3).collect()] == [("001", "X", "a")]


def test_the_job_keeps_file_order_and_hides_it(spark, tmp_path):
    """The first region in the crime file wins, not the least; readers never see the order column."""
    from test_etl import SECURITE, write_inputs

    data = tmp_path / "data"
    data.mkdir()
    write_inputs(str(data))
    head, *rows = SECURITE.strip().split("\n")
    rows = [r.replace("69;84;", "69;93;", 1) if "Homicides;Victime;23" in r else r.replace("69;84;", "69;11;", 1) for r in rows]
    (data / "donnee-dep-data.gouv-2025-geographie2025-produit-le2026-01-22.csv").write_text("\n".join([head, *rows]) + "\n", encoding="latin1")
    out = str(tmp_path / "out")
    run(spark, EtlConfig(str(data), out, str(tmp_path / "tables"), quirks=Quirks(department_region_by_frame_order=False)))
    tables = attach(spark, out)
    assert [r["code_region"] for r in tables["dim_departement"].collect()] == ["93"]
    assert not any(ORDINAL in t.columns for t in tables.values())
    run_path = latest_run(spark, out)["tables"]
    assert ORDINAL in spark.read.parquet(os.path.join(run_path, "fact_securite")).columns
    csv = os.path.join(latest_run(spark, out)["csv"], "fact_securite")
    assert not any(ORDINAL in line for f in os.listdir(csv) if f.endswith(".csv") for line in open(os.path.join(csv, f), encoding="utf-8"))
