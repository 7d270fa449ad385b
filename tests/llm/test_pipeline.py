"""The stages, each against a plain version on its own input."""

import zlib

import corpus_pipeline as C
import numpy as np
from brute import holds_item, near, repeats, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from terroir.llm.common import table, written
from terroir.llm.tokens import default_tokenizer

SF = "/root/testdata/sf0.001"


def test_every_stage(spark):
    docs = table(spark, SF, "documents")
    junk = spark.createDataFrame([(10**6, None, "en", "x", 0), (10**6 + 1, "12 !!", "en", "x", 5), (10**6 + 2, "зщшх жъэ", "en", "x", 8)], docs.schema)
    columns, docs = docs.columns, docs.unionByName(junk)
    stages = dict(C.STAGES)
    assert list(stages) == ["language_id", "near_dedup", "substring_dedup", "decontamination", "best_fit_packing"]

    kept = written(stages["language_id"](spark, docs, SF), "t")
    assert kept.columns == columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {10**6, 10**6 + 1, 10**6 + 2}

    data = [(r.doc_id, r.text) for r in kept.collect()]
    docs = written(stages["near_dedup"](spark, kept, SF), "t")
    assert docs.columns == columns
    assert {r.doc_id for r in docs.collect()} == {d for d, (_, root) in near(data).items() if d == root} and docs.count() < kept.count()

    data = [(r.doc_id, r.text) for r in docs.collect()]
    docs = written(stages["substring_dedup"](spark, docs, SF), "t")
    assert docs.columns == columns
    left = {d: x[4].decode("utf-8", "ignore") for d, x in repeats(data).items()}
    assert rows(docs, "doc_id", "text", "n_chars") == sorted(((d, t, len(t)) for d, t in left.items()), key=repr)

    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    clean = {d for d, t in left.items() if not any(holds_item(t, x) for x in items)}
    docs = written(stages["decontamination"](spark, docs, SF), "t")
    assert docs.columns == columns
    assert {r.doc_id for r in docs.collect()} == clean

    tok = Tokenizer.from_file(default_tokenizer())
    want = []
    for r in docs.collect():
        ids = np.array(tok.encode(r.text, add_special_tokens=False).ids + [0], "<u4")
        want += [(r.doc_id, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    packed = written(stages["best_fit_packing"](spark, docs, SF), "t")
    assert rows(packed, "doc_id", "piece", "start", "length", "ids_crc32") == sorted(want, key=repr)
    bins = packed.groupBy("sequence_id").sum("length").collect()
    assert all(b[1] <= 2048 for b in bins) and len(bins) <= 1 + -(-sum(b[1] for b in bins) // 2048)


def test_run_and_empty_table(spark, tmp_dir):
    assert C.run(spark, SF).count() > 0 and C.ORACLE_SQL is None
    docs = table(spark, SF, "documents").filter("false")
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0, name


def test_chain_with_missing_and_repeated_ids_and_clashing_columns(spark):
    docs = table(spark, SF, "documents")
    small = docs.orderBy("doc_id").limit(60)
    first = small.first()
    words = "the quick brown fox jumps over a lazy dog near the river bank every single morning before the sun comes up "
    odd = spark.createDataFrame([
        (None, words + "for whoever has no number", "en", "x", 0), (None, words + "for whoever has no number", "en", "x", 0),
        (None, None, None, None, None), (first.doc_id, first.text, first.lang, first.source, first.n_chars),
        (10**6, "", "en", "x", 0), (10**6 + 1, words * 3000, "en", None, None)], docs.schema)
    odd = small.unionByName(odd)
    for name in ("found_id", "gone 0", "rest", "doc", "tie", "spans", "text_hash", "label", "piece", "no text", "at"):
        odd = odd.withColumn(name, F.lit("own"))
    odd = written(odd.withColumn("m", F.create_map(F.lit("k"), F.lit(1))), "t")
    now, columns = odd, odd.columns
    for name, stage in C.STAGES[:-1]:
        before, now = now, written(stage(spark, now, SF), "t")
        assert now.columns == columns, name
        assert now.filter("m['k'] = 1 and rest = 'own' and `gone 0` = 'own'").count() == now.count() > 0, name
        assert now.select("doc_id").exceptAll(before.select("doc_id")).isEmpty(), name
        if name == "near_dedup":
            assert now.filter("doc_id is null").count() == 2 and now.filter(F.col("doc_id") == first.doc_id).count() == 1
    assert now.filter("doc_id is null").count() == 2
    packed = written(C.STAGES[-1][1](spark, now, SF), "t")
    assert packed.filter("piece = 0").count() == now.count()
    assert packed.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").isEmpty()
