"""Column expressions against the edge rows of FIXTURES.md section 3 and
against Python's own string functions (brute force on small inputs)."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terroir.functions import numeric as N
from terroir.functions import text as X
from terroir.functions.names import ascii_name, normalize_name
from terroir.quirks import CORRECTED


def col_values(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_normalize_names():
    assert normalize_name("﻿CODGEO") == "codgeo"
    assert normalize_name("Rapport d'inégalité") == "rapport_dinégalité"
    assert normalize_name("Code - dép/com") == "code_dép_com"
    assert normalize_name('"Type"') == "type"
    assert ascii_name("nombre_élèves_") == "nombre_lves"


def test_parse_number(spark):
    good = ["1,5", "1e3", ".5", "5.", "+5", " 7 "]
    assert col_values(spark, good, N.parse_number) == [1.5, 1000.0, 0.5, 5.0, 5.0, 7.0]
    bad = ["1 234", "1.234.5", "s", "", "1d", "NaN", None, "inf", "Infinity"]
    assert col_values(spark, bad, N.parse_number) == [None] * len(bad)


def test_parse_int(spark):
    assert col_values(spark, ["2016", " 2017 ", "2016.0", "2016.5", "x", None], N.parse_int) == \
        [2016, 2017, 2016, None, None, None]


def test_zero_pad(spark):
    assert col_values(spark, ["1", "69001", "6902969256", "+1", ""], lambda c: X.zero_pad(c, 5)) == \
        ["00001", "69001", "6902969256", "+0001", "00000"]
    assert [v.zfill(5) for v in ["1", "69001", "6902969256", "+1", ""]] == \
        ["00001", "69001", "6902969256", "+0001", "00000"]


def test_title_case(spark):
    vals = ["saint-germain-au-mont-d'or", "lyon 9e arrondissement", "ÉCULLY", "L'ARBRESLE",
            "straße ßa", "ǆungla", "élan2élan", "", "a\x01b c", "  two  spaces ", "ﬁne ﬂow",
            "İstanbul İZMİR", "ẞ ẞa aẞ", "ᾳ ὖ ΐx", "ᲐᲑᲒ აბგ"]
    assert col_values(spark, vals, X.title_case) == [v.title() for v in vals]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abcXYZ éÉàß'-9 _ǆ\tœ\x01ﬁ")), max_size=12),
                min_size=1, max_size=20))
def test_title_case_property(spark, vals):
    assert col_values(spark, vals, X.title_case) == [v.title() for v in vals]


def test_strip_matches_python(spark):
    vals = ["  a b  ", "\ta\n", "\x1c x \x1f", "\xa0y　", "z"]
    assert col_values(spark, vals, X.strip) == [v.strip() for v in vals]


def _py_repair(v):
    if v is None:
        return None
    t = v.strip()
    if t == "" or t.lower() == "nan":
        return None
    if any(ch in t for ch in "ÃÂâð�"):
        t = t.encode("latin1", errors="ignore").decode("utf-8", errors="ignore")
    return t


def test_repair_mojibake(spark):
    vals = ["VÃ©hicule", "Châtillon", "Bâ", "Œ Ã©", "plain", "  ", "nan", None]
    got = col_values(spark, vals, X.repair_mojibake)
    assert got == [_py_repair(v) for v in vals]
    assert got[:5] == ["Véhicule", "Chtillon", "B", " é", "plain"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aé Ãâ©Â\x80ð�Œ\xa0z")), max_size=10),
                min_size=1, max_size=20))
def test_repair_property(spark, vals):
    assert col_values(spark, vals, X.repair_mojibake) == [_py_repair(v) for v in vals]


def test_repair_corrected_keeps_french(spark):
    got = col_values(spark, ["Châtillon", "VÃ©hicule"], lambda c: X.repair_mojibake(c, CORRECTED))
    assert got == ["Châtillon", "Véhicule"]


def test_map_and_regex(spark):
    vals = ["Rhone", "Rhone Alpes", "1Ere", "1Ere Circ", "2Ème"]
    got = col_values(spark, vals, lambda c: X.regex_replace(X.map_values(c, X.LABEL_MAP),
                                                             r"(\d+)Ème", "$1ème"))
    assert got == ["Rhône", "Rhone Alpes", "1ère", "1Ere Circ", "2ème"]


def test_strip_accents(spark):
    vals = ["Œuvre", "Église", "ß", "ﬁ", "½", "Ø", None]
    got = col_values(spark, vals, X.strip_accents)
    assert got == ["uvre", "Eglise", "", "fi", "12", "", None]
    assert got[:6] == [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode() for v in vals[:6]]


def test_clean_label_twice(spark):
    from terroir.operators.cleaning import clean_label_columns
    vals = ["rhone", "VÃ©nissieux", " lyon 1er ", "2Ème Circ", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r.v for r in clean_label_columns(df, ["v"]).orderBy("i").collect()]
    assert got == ["Rhone", "Venissieux", "Lyon 1Er", "2eme Circ", None]


def test_ratio_and_percentage(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(N.ratio("a", "b")).collect()] == [0.5, None, None]
    df = spark.createDataFrame([(50, 100), (5, 0), (1, 3)], "v int, i int")
    assert [r[0] for r in df.select(N.guarded_percentage("v", "i")).collect()] == [50.0, None, 33.33]


@pytest.mark.parametrize("tok", ["", "NA", "null", "None", "N/A", "nan", "<NA>"])
def test_na_tokens(spark, tok):
    from terroir.sources.delimited import na_to_null
    df = spark.createDataFrame([(tok,), ("ND",), ("s",)], "v string")
    assert [r[0] for r in na_to_null(df).collect()] == [None, "ND", "s"]


def _to_numeric(v):
    import numpy as np
    import pandas as pd
    s = pd.Series([v], dtype=object).astype(str).str.replace(",", ".", regex=False).str.strip()
    r = pd.to_numeric(s, errors="coerce").iloc[0]
    if r is None or np.isnan(r) or np.isinf(r):
        return None
    return float(r)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("0123456789012345678901234567890.,+-eE \t_x")),
                        max_size=9), min_size=1, max_size=40))
def test_parse_number_matches_to_numeric(spark, vals):
    import math
    got = col_values(spark, vals, N.parse_number)
    for v, g in zip(vals, got):
        w = _to_numeric(v)
        assert (g is None) == (w is None), (v, g, w)
        if g is not None:
            assert math.isclose(g, w, rel_tol=1e-15, abs_tol=0.0), (v, g, w)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("0123456789.,+-e \t\n\xa0x")), max_size=7),
                min_size=1, max_size=40))
def test_parse_number_f3_matches_to_numeric(spark, vals):
    import math

    import numpy as np
    import pandas as pd
    got = col_values(spark, vals, lambda c: N.parse_number(c, decimal_comma=False))
    want = pd.to_numeric(pd.Series(vals, dtype=object), errors="coerce").tolist()
    for v, g, w in zip(vals, got, want):
        w = None if (w is None or np.isnan(w) or np.isinf(w)) else float(w)
        assert (g is None) == (w is None), (v, g, w)
        if g is not None:
            assert math.isclose(g, w, rel_tol=1e-15), (v, g, w)


def test_zeros_with_exponents_beyond_the_double_range(spark):
    import numpy as np
    import pandas as pd
    vals = ["0e309", "0e308", "0.0e309", "0.00e310", "0.0e400", "-0e400", "0e-400", "0" * 18 + "e308", "0" * 17 + "e308", "0" * 16 + ".00e309",
            "0" * 16 + ".00e310", ".0e309", ".0e310", "0e9999999999", "+0.e309", "0E+309", "1e308", "1e309", "0", "0.0"]
    want = [None if np.isnan(w) else w for w in pd.to_numeric(pd.Series(vals, dtype=object), errors="coerce").tolist()]
    assert want[0] is None and want[1] == 0.0
    assert col_values(spark, vals, lambda c: N.parse_number(c, decimal_comma=False)) == want


def test_null_as_text_quirk(spark):
    from terroir.quirks import Quirks
    q = Quirks(null_as_text=True)
    df = spark.createDataFrame([(None,), ("1",)], "v string")
    got = [tuple(r) for r in df.select(X.safe_code(F.col("v"), 5, q), X.title_case(X.safe_code(F.col("v"), None, q)),
                                       X.upper(X.safe_code(F.col("v"), None, q)), X.safe_code(F.col("v"), 5)).collect()]
    assert got == [("00nan", "Nan", "NAN", None), ("00001", "1", "1", "00001")]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aZé 09-_/\"\t﻿'.")), max_size=10),
                min_size=1, max_size=20))
def test_idempotent_names_strip_pad(spark, vals):
    for v in vals:
        assert normalize_name(normalize_name(v)) == normalize_name(v)
    once = col_values(spark, vals, lambda c: X.zero_pad(X.strip(c), 5))
    twice = col_values(spark, once, lambda c: X.zero_pad(X.strip(c), 5))
    assert once == twice


def test_strip_accents_over_all_of_unicode(spark):
    import unicodedata
    chars = [chr(i) for i in range(1, 0x110000) if not 0xD800 <= i <= 0xDFFF]
    lines = ["".join(chars[k:k + 500]) for k in range(0, len(chars), 500)] + ["plain", "", "Évê\u0301que ﬁn ½"]
    want = [unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode() for x in lines]
    assert col_values(spark, lines, X.strip_accents) == want


def test_round_half_up_beyond_64_bits(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(x,) for x in (1e13, 2.5e17, nan, inf, -inf, -2.5, 1.005, -1e-20)], "x double")
    got = [r[0] for r in df.select(N.round_half_up("x", 6)).collect()]
    assert got[:2] == [1e13, 2.5e17] and got[2] != got[2] and got[3:6] == [inf, -inf, -2.5] and got[6:] == [1.005, 0.0]


def test_parse_long(spark):
    assert col_values(spark, ["3000000000", " 9007199254740993 ", "-5", "12.0", "1.5", "1e3", "99999999999999999999", "x", None], N.parse_long) == [
        3000000000, 9007199254740993, -5, 12, None, 1000, None, None, None]
