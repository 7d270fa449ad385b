import zlib

import numpy as np

from pyspark.sql import functions as F

from terroir.llm import language as L
from terroir.llm import queries as Q

SF = "/root/testdata/sf0.001"


def held(d):
    return zlib.crc32(str(d).encode()) % 3 == 1


def test_accuracy_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = Q.op2_language_masks(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect()
    assert len(got) == 1000
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got} <= {r.lang for r in got} | {"und"}
    test = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in test) >= 0.98 * len(test)


def small(spark):
    text = {"aa": "kato miru sela tano", "bb": "zwick brumm stolz gewand"}
    data = [(k, f"{text[x]} {text[x]}", x, "n") for k, x in enumerate(["aa", "bb"] * 20)]
    return spark.createDataFrame(data + [(100, None, "aa", "n"), (101, "kato sela", None, "n")],
                                 "doc_id long, text string, lang string, lang_pred string")


def test_edges(spark):
    f = L.fit(L.labelled_rows(small(spark)))
    assert f.languages == ["aa", "bb"]
    docs = spark.createDataFrame([
        (1, None), (2, ""), (3, "12 34 !!"), (4, "KATO miru"), (5, "stolz"), (5, "stolz"), (None, "brumm"), (6, "日本語テキスト"),
        (7, "²"), (8, "miru " * 100_000), (9, "zwick" * 1000)], "doc_id long, text string").withColumn("score", F.lit("x"))
    got = {(r.doc_id, r.lang_pred): r.score for r in L.predict(docs, f).collect()}
    assert {k for k in got if k[1] == "und"} == {(1, "und"), (2, "und"), (3, "und"), (7, "und")}
    assert {(4, "aa"), (5, "bb"), (None, "bb"), (8, "aa"), (9, "bb")} <= set(got)
    assert got[(6, "aa")] == 0.0  # knows nothing of it: the first in the alphabet
    assert L.predict(docs, f).count() == 11
    kept = L.accepted(docs, f, 0.2)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 5, 5, 8, 9]


def test_nothing_to_learn_from(spark):
    none = small(spark).filter("false")
    f = L.fit(L.labelled_rows(none))
    assert f.languages == []
    assert [r.lang_pred for r in L.predict(small(spark).limit(3), f).collect()] == ["und"] * 3
    assert L.predict(none, f).count() == 0


def test_more_than_64_languages(spark):
    data = [(k, " ".join(chr(0x4E00 + 50 * (k % 70) + j) * 3 for j in range(20)), f"l{k % 70:02d}") for k in range(280)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    f = L.fit(docs)
    assert f.table.shape == (L.ROWS, 2)
    got = L.predict(docs, f).join(docs, "doc_id").collect()
    assert all(r.lang == r.lang_pred for r in got)


def plain_sets(texts, min_share, min_ratio):
    """{language: its n-grams}, as the method reads, in sets of strings."""
    rate = {}
    for lang, text in texts:
        for w in L.WORD.findall(text.lower()):
            for n in L.ORDERS:
                for k in range(len(w) + 3 - n):
                    of = rate.setdefault((lang, n), {})
                    gram = f" {w} "[k:k + n]
                    of[gram] = of.get(gram, 0) + 1
    share = {(lang, n, g): c / sum(of.values()) for (lang, n), of in rate.items() for g, c in of.items()}
    top = {}
    for (_, n, g), s in share.items():
        if s >= min_share:
            top[n, g] = max(top.get((n, g), 0), s)
    sets = {lang: set() for lang, _ in rate}
    for (lang, n, g), s in share.items():
        if s >= min_share and s >= min_ratio * top[n, g]:
            sets[lang].add(g)
    return sets


def test_masks_and_scores_against_plain_sets(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    learned = [(r.lang, r.text) for r in L.labelled_rows(docs).collect()]
    f = L.fit(L.labelled_rows(docs))
    sets = plain_sets(learned, 5e-5, 0.25)
    assert f.languages == sorted(sets)
    masked, wrong, seen = 0, [0] * len(f.languages), 0
    for g in set().union(*sets.values()):
        h = gram_hash(g)
        mask = f.table[[(int(h & 0xFFFFFFFF) + int((h >> 32) | 1) * j) & (L.ROWS - 1) for j in range(L.HASHES)]]
        word = mask[0]
        for row in mask[1:]:
            word = word & row
        seen += 1
        for k, lang in enumerate(f.languages):
            bit = int(word[k // 64]) >> (k % 64) & 1
            masked += bit
            assert bit or g not in sets[lang]        # no language that holds the n-gram is missing
            wrong[k] += bit and g not in sets[lang]
    assert all(w <= 5 + 3 * p * seen for w, p in zip(wrong, f.false_positive))
    for r in Q.op2_language_masks(spark, sf).join(docs.select("doc_id", "text"), "doc_id").collect():
        of = [f" {w} "[k:k + n] for w in L.WORD.findall((r.text or "").lower()) for n in L.ORDERS for k in range(len(w) + 3 - n)]
        if not of:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        share = {lang: sum(g in s for g in of) / len(of) for lang, s in sets.items()}
        assert abs(share[r.lang_pred] - r.score) < 0.01
        assert share[r.lang_pred] >= max(share.values()) - 0.01


def gram_hash(gram):
    """64-bit hash of one n-gram, as the filters know it."""
    h = len(gram)
    for c in gram:
        h = (h * 0x9E3779B97F4A7C15 + ord(c)) & (1 << 64) - 1
    return int(L.mix(np.array([h], np.uint64))[0])
