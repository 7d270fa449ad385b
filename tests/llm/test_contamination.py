import tracemalloc

import numpy as np
import pyarrow as pa
from brute import holds_item

from pyspark.sql import functions as F

from terroir.llm import contamination as C
from terroir.llm import queries as Q
from terroir.llm.common import table

ITEM = ("A train leaves Springfield at 9 and travels 120 km in 3 hours while Anna walks 4 km to meet the train. "
        "How fast does the train go?")


def frames(spark, texts, items):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, key string, shift int")
    return docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def found(spark, texts, items):
    docs, bench = frames(spark, texts, items)
    return {(r.doc_id, r.item_id): r for r in C.contaminated(docs, bench).collect()}


def test_copies_and_new_parameters(spark):
    other = ITEM.replace("Springfield", "Shelbyville").replace("120 km", "240 km").replace("km", "miles").replace("3 hours", "5 hours").replace("Anna", "Bob Ray")
    wrong = "Two trains leave a station and nobody knows how fast they go or when they arrive at all, said the guard."
    got = found(spark, [f"Before. {ITEM} After.", f"intro {other} outro", wrong, ITEM.upper(), ITEM.lower(), "words " * 400 + ITEM], [ITEM])
    assert set(got) == {(0, 0), (1, 0), (3, 0), (4, 0), (5, 0)}
    assert got[0, 0].same_slots and got[0, 0].covered == got[0, 0].item_tokens
    assert not got[1, 0].same_slots and got[5, 0].token == 400


def test_slots_must_agree(spark):
    item = "add 5 to the red box then take 5 from the red box and put 5 into the blue box quickly"
    same = item.replace("5", "8")
    mixed = "add 8 to the red box then take 9 from the red box and put 7 into the blue box quickly"
    got = found(spark, [same, mixed], [item])
    assert set(got) == {(0, 0)}


def test_consistent_windows_count_alone(spark):
    long = ("put 2 cups of flour and some salt into the bowl then add 2 eggs with warm milk and stir everything slowly before "
            "baking it for half of the afternoon inside a very hot oven until 2 guests arrive")
    pears = "we keep 5 apples and 5 pears in a basket near the door of the old house so how many fruits can be sold"
    texts = [long.replace("2 eggs", "3 eggs"), pears.replace("5 apples", "7 apples").replace("5 pears", "9 pears"),
             long.replace("2 cups", "4 cups").replace("2 eggs", "6 eggs").replace("2 guests", "4 guests")]
    got = found(spark, texts, [long, pears])
    assert set(got) == {(0, 0), (1, 1), (2, 0)}
    assert not got[0, 0].same_slots


def test_agreed_takes_the_value_that_leads_to_more():
    tied = [[(1, "5", "7")], [(1, "5", "7"), (6, "5", "9")], [(6, "5", "9")], []]
    assert C.agreed([0, 1, 2, 9], tied, 8, 13) == [0, 9]
    assert C.agreed([0, 1, 6], [[(1, "5", "7")], [(1, "5", "7"), (6, "5", "9")], [(6, "5", "9")]], 8, 13) == []
    assert C.agreed([0, 5], [[(1, "5", "5")], [(5, "6", "6"), (9, "5", "5")]], 8, 13) == [0, 5]


def test_names_that_open_sentences(spark):
    tom = "Tom has 5 apples. Tom buys 3 more. Tom gives 2 to Ann. How many apples does Tom have now?"
    short = "Rita walks slowly from the old mill to school"
    new = [tom.replace("Tom", a).replace("Ann", b).replace("5", "6") for a, b in (("Sam", "Eve"), ("Mary Ann", "Eve"), ("Sam", "Bo Lee"))]
    mixed = "Sam has 6 apples. Joe buys 3 more. Kim gives 2 to Eve. How many apples does Lou have now?"
    texts = [*new, f"Read this Sam {new[0][4:]} Thanks.", short.replace("Rita", "Old Bob"), f"so {short.replace('Rita', 'Bob')} Thanks", mixed]
    assert set(found(spark, texts, [tom, short])) == {(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (5, 1)}


def test_exact_copies_with_few_plain_words(spark):
    items = ["What is 12 + 7 - 3 + 15 - 4 + 2?", "Sum 4 8 15 16 23 42 and 7 11 13 of these", "Give 3 9 27 81 243 please",
             "Year 1990 12 17 21 1991 14 18 25 1992 16 19 28 1993 17 22 31"]
    texts = [f"before {i} after" for i in items] + [i.replace("2", "5").replace("3", "6") for i in items] + ["1990 12 17 21 1991 14 18 25 and no more"]
    assert set(found(spark, texts, items)) == {(0, 0), (1, 1), (2, 2), (3, 3)}


def test_edges(spark):
    short, tiny = "what is the capital of france", "one two three"
    got = found(spark, [None, "", ITEM, ITEM, f"so {short} then", tiny, "1 2 3 4 5 6 7 8 9 10 11 12 13 14", "x " * 200_000],
                [ITEM, short, tiny, None, "", "1 2 3 4 5 6 7 8 9 10 11 12 13 14"])
    assert set(got) == {(2, 0), (3, 0), (4, 1)}


def test_empty_tables(spark):
    docs, bench = frames(spark, [ITEM], [ITEM])
    assert C.contaminated(docs.filter("false"), bench).count() == 0
    assert C.contaminated(docs, bench.filter("false")).count() == 0
    assert C.clean(docs, bench.filter("false")).count() == 1


def test_clean_keeps_columns_and_rows_without_id(spark):
    docs, bench = frames(spark, ["fine text", ITEM, "more", None], [ITEM])
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") < 2, F.col("doc_id"))).withColumn("c_doc_id", F.lit(1))
    kept = C.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.text or "") for r in kept.collect()) == ["", "fine text", "more"]


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = table(spark, sf, "documents").collect(), table(spark, sf, "benchmark").collect()
    want = {(d.doc_id, i.item_id) for d in docs for i in items if holds_item(d.text, i.text)}
    got = {(r.doc_id, r.item_id) for r in Q.op4_templates(spark, sf).collect()}
    assert got == want and len(want) > 10


def test_nouns_written_large_are_not_names(spark):
    """Unrelated German sentences share their frame; one name more or less is still a copy."""
    item = "Der Hund sucht in dem Garten nach einem Ball und die Katze liegt auf dem Sofa in der Sonne"
    other = "Der Minister sucht in dem Vertrag nach einem Fehler und die Partei liegt auf dem Weg in der Wahl"
    near = item.replace("Hund", "Wolf").replace("Katze", "Ente")
    assert set(found(spark, [other, near, item, f"{other}. {item}."], [item])) == {(1, 0), (2, 0), (3, 0)}


def test_number_words_of_other_languages(spark):
    item = "le marchand pose cinq pommes sur la table puis il en vend trois à sa voisine et il garde les deux autres"
    new = item.replace("cinq", "sept").replace("trois", "neuf").replace("deux", "quatre")
    german = "der Bauer hat zwölf Kühe und kauft noch drei dazu und verkauft dann zwei von ihnen wie viele bleiben ihm am Ende"
    assert set(found(spark, [new, german.replace("zwölf", "20").replace("drei", "sieben").replace("zwei", "elf")], [item, german])) == {(0, 0), (1, 1)}


def test_memory_of_templates_is_bounded(spark):
    class Rows:  # hands over what would run in a task
        sparkSession = spark

        def mapInArrow(self, run, schema):
            return run

    rng = np.random.default_rng(4)
    words = np.array(["q" + "".join(chr(97 + k // 26**j % 26) for j in range(4)) for k in range(30_000)])
    texts = [" ".join(words[rng.integers(0, len(words), 200)]) for _ in range(3000)]  # about 3.6 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.array(range(len(texts)), pa.int64())],
                                       names=["doc_id", "text", "text_hash"])
    for bits, whole, part in ((np.zeros(1 << 10, np.uint32), False, batch), (None, True, batch.slice(0, 150))):
        run = C.template_windows(Rows(), [4, 5, 6, 7, 8], bits, whole)
        tracemalloc.start()
        sent = [b.num_rows for b in run(iter([part]))]
        peak = tracemalloc.get_traced_memory()[1] / 2**20
        tracemalloc.stop()
        assert sum(sent) == whole * 193 * part.num_rows and max(sent, default=0) <= 20_000
        assert peak < 80, (whole, peak)
