"""The library's operators run over the driver's TPC-H-like tables.

Every function takes (spark, sf_dir), reads whole tables and returns a lazy
DataFrame; `SQL` holds the equivalent query for the SQL oracle, with the same
output column names. Dirt (text numbers, NULLs, bad tokens, padded or foreign
codes) is derived from the rows by fixed CASE rules on both sides; no query
shrinks its input by key arithmetic, and the only rows dropped are those the
operator under test drops. Doubles that come out of aggregations are rounded
half-up with the floor form on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.functions import numeric as N
from terroir.functions import text as X
from terroir.operators import dedup as D
from terroir.operators import filters as P
from terroir.operators import joins as J
from terroir.operators import quality as Q
from terroir.operators import schema as C
from terroir.operators import stats as A

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

LINEITEM_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(c):
    return N.round_half_up(c, 6)


SQL: dict[str, str] = {}


# --------------------------------------------------------------------------
# Fact x two dimensions with a guarded percentage
# --------------------------------------------------------------------------

def view_fact_dims(spark, d):
    orders = table(spark, d, "orders")
    customer = table(spark, d, "customer")
    nation = table(spark, d, "nation")
    fact = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                         F.year("o_orderdate").cast("long").alias("annee"))
    j = J.left_join_dims(
        fact.withColumnRenamed("o_custkey", "c_custkey"),
        [(customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), "c_custkey")])
    j = J.left_join_dims(
        j.withColumnRenamed("c_nationkey", "n_nationkey"),
        [(nation.select("n_nationkey", "n_name"), "n_nationkey")])
    return j.select("o_orderkey", "c_name", "n_name", "annee", "o_orderstatus", "o_totalprice",
                    "c_acctbal",
                    N.guarded_percentage(F.col("o_totalprice"), F.col("c_acctbal")).alias("price_to_balance_pct"))


SQL["view_fact_dims"] = """
SELECT o.o_orderkey, c.c_name, n.n_name, CAST(year(o.o_orderdate) AS BIGINT) AS annee,
       o.o_orderstatus, o.o_totalprice, c.c_acctbal,
       CASE WHEN c.c_acctbal > 0
            THEN floor(o.o_totalprice / c.c_acctbal * 100.0 * 100.0 + 0.5) / 100.0 END
         AS price_to_balance_pct
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""


# SQL helpers shared by the oracle strings (fixed values).
NUM_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def sql_r6(x: str) -> str:
    return f"floor(({x}) * 1000000.0 + 0.5) / 1000000.0"


# --------------------------------------------------------------------------
# Dimension x dimension x two facts, star minus key, duplicate
# year column suffixed
# --------------------------------------------------------------------------

def view_dims_facts(spark, d):
    from terroir.plans.views import dimension_facts_view
    nation = table(spark, d, "nation")
    region = table(spark, d, "region")
    cust = D.keep_first(table(spark, d, "customer"), ["c_nationkey"], ["c_custkey"])
    cust = cust.select(F.col("c_nationkey").alias("n_nationkey"), "c_name", "c_acctbal",
                       F.lit(2021).alias("annee"))
    supp = D.keep_first(table(spark, d, "supplier"), ["s_nationkey"], ["s_suppkey"])
    supp = supp.select(F.col("s_nationkey").alias("n_nationkey"), "s_name", "s_acctbal",
                       F.lit(2022).alias("annee"))
    return dimension_facts_view(
        nation.select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey")),
        key="n_nationkey", base_labels=["n_name"],
        lookup=(region, "r_regionkey", ["r_name"]), facts=[cust, supp])


SQL["view_dims_facts"] = """
WITH c AS (
  SELECT c_nationkey AS n_nationkey, c_name, c_acctbal, 2021 AS annee FROM (
    SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn FROM customer)
  WHERE rn = 1),
s AS (
  SELECT s_nationkey AS n_nationkey, s_name, s_acctbal, 2022 AS annee FROM (
    SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier)
  WHERE rn = 1)
SELECT n.n_nationkey, n.n_name, r.r_name, c.c_name, c.c_acctbal, c.annee,
       s.s_name, s.s_acctbal, s.annee AS annee_1
FROM nation n
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN c ON n.n_nationkey = c.n_nationkey
LEFT JOIN s ON n.n_nationkey = s.n_nationkey
"""


# --------------------------------------------------------------------------
# Dirty header names normalised
# --------------------------------------------------------------------------

def normalize_columns(spark, d):
    sup = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    dirty = sup.toDF("﻿S_SUPPKEY", " S Name ", '"S-NationKey"', "S/AcctBal é")
    out = C.ascii_columns(C.normalize_columns(dirty))
    return C.rename_columns(out, {"s_name": "supplier_name"})


SQL["normalize_columns"] = """
SELECT s_suppkey, s_name AS supplier_name, s_nationkey, s_acctbal FROM supplier
"""


# --------------------------------------------------------------------------
# Required columns, keep the listed columns that exist
# --------------------------------------------------------------------------

def require_and_project(spark, d):
    part = C.require_columns(table(spark, d, "part"), ["p_partkey", "p_name"], "part")
    return C.select_existing(part, ["p_partkey", "p_name", "p_brand", "p_container", "p_retailprice"])


SQL["require_and_project"] = "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part"


# --------------------------------------------------------------------------
# Candidate columns that are entirely NULL are dropped
# --------------------------------------------------------------------------

def drop_all_null_columns(spark, d):
    o = table(spark, d, "orders").select(
        "*", F.lit(None).cast("string").alias("o_comment"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Clerk")).alias("o_clerk"))
    return C.drop_all_null_columns(o, ["o_comment", "o_clerk"])


SQL["drop_all_null_columns"] = """
SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'Clerk' END AS o_clerk FROM orders
"""


# --------------------------------------------------------------------------
# Constant year key
# --------------------------------------------------------------------------

def add_year_key(spark, d):
    return C.add_constant(table(spark, d, "orders"), "annee", 2024)


SQL["add_year_key"] = "SELECT *, 2024 AS annee FROM orders"


# --------------------------------------------------------------------------
# Locale numbers as text, parsed back; bad tokens -> NULL
# --------------------------------------------------------------------------

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_DIRT = ["ND", "1d", "", "1.234.5", "1 234", "s", "NaN"]


def _dirty_number(c: str, i: int):
    k = (F.col("l_orderkey") + F.col("l_linenumber") + F.lit(i)) % 13
    txt = F.replace(F.col(c).cast("string"), F.lit("."), F.lit(","))
    e = F.when(k == 0, F.lit(_DIRT[0]))
    for j, tok in enumerate(_DIRT[1:], start=1):
        e = e.when(k == j, F.lit(tok))
    return (e.when(k == 7, F.concat(F.lit(" "), txt, F.lit(" ")))
             .when(k == 8, F.lit("1e3")).when(k == 9, F.lit(".5"))
             .when(k == 10, F.lit("+5")).when(k == 11, F.lit("5."))
             .otherwise(txt))


def _sql_dirty_number(c: str, i: int) -> str:
    k = f"((l_orderkey + l_linenumber + {i}) % 13)"
    txt = f"replace(CAST({c} AS VARCHAR), '.', ',')"
    whens = " ".join(f"WHEN {j} THEN '{tok}'" for j, tok in enumerate(_DIRT))
    return (f"CASE {k} {whens} WHEN 7 THEN ' ' || {txt} || ' ' WHEN 8 THEN '1e3' "
            f"WHEN 9 THEN '.5' WHEN 10 THEN '+5' WHEN 11 THEN '5.' ELSE {txt} END")


def _sql_parse(t: str) -> str:
    s = f"trim(replace({t}, ',', '.'))"
    return (f"CASE WHEN regexp_matches({s}, '{NUM_RE}') AND isfinite(TRY_CAST({s} AS DOUBLE)) "
            f"THEN TRY_CAST({s} AS DOUBLE) END")


def parse_number(spark, d):
    li = table(spark, d, "lineitem")
    raw = li.select(*LINEITEM_KEYS, *[_dirty_number(c, i).alias(c) for i, c in enumerate(MEASURES)])
    return C.map_columns(raw, N.parse_number, exclude=LINEITEM_KEYS)


SQL["parse_number"] = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(f"{_sql_parse(_sql_dirty_number(c, i))} AS {c}" for i, c in enumerate(MEASURES))
    + " FROM lineitem")


# --------------------------------------------------------------------------
# nullable integer parse
# --------------------------------------------------------------------------

def parse_year(spark, d):
    o = table(spark, d, "orders")
    y = F.year("o_orderdate").cast("string")
    k = F.col("o_orderkey") % 7
    txt = (F.when(k == 0, F.lit("abcd")).when(k == 1, F.concat(y, F.lit(".5")))
            .when(k == 2, F.concat(F.lit(" "), y, F.lit(" "))).when(k == 3, F.lit(""))
            .when(k == 4, F.concat(y, F.lit(".0"))).otherwise(y))
    return o.select("o_orderkey", N.parse_int(txt).try_cast("int").alias("annee"))


SQL["parse_year"] = f"""
WITH t AS (
  SELECT o_orderkey, trim(CASE o_orderkey % 7 WHEN 0 THEN 'abcd'
      WHEN 1 THEN CAST(year(o_orderdate) AS VARCHAR) || '.5'
      WHEN 2 THEN ' ' || CAST(year(o_orderdate) AS VARCHAR) || ' '
      WHEN 3 THEN '' WHEN 4 THEN CAST(year(o_orderdate) AS VARCHAR) || '.0'
      ELSE CAST(year(o_orderdate) AS VARCHAR) END) AS s FROM orders),
v AS (SELECT o_orderkey, CASE WHEN regexp_matches(s, '{NUM_RE}') THEN TRY_CAST(s AS DOUBLE) END AS x FROM t)
SELECT o_orderkey, CASE WHEN x = floor(x) THEN CAST(x AS INTEGER) END AS annee FROM v
"""


# --------------------------------------------------------------------------
# Codes with quotes and blanks, zero-padded without truncation
# --------------------------------------------------------------------------

def pad_codes(spark, d):
    c = table(spark, d, "customer")
    k = F.col("c_custkey") % 4
    key = F.col("c_custkey").cast("string")
    txt = (F.when(k == 0, F.concat(F.lit('"'), key, F.lit('"')))
            .when(k == 1, F.concat(F.lit("\t"), key, F.lit(" ")))
            .when(k == 2, F.concat(F.lit(' "'), key, F.lit('" ')))
            .otherwise(key))
    return c.select("c_custkey", X.zero_pad(X.strip_char(X.strip(txt), '"'), 4).alias("code"))


SQL["pad_codes"] = """
WITH t AS (
  SELECT c_custkey, trim(trim(CASE c_custkey % 4
      WHEN 0 THEN '"' || CAST(c_custkey AS VARCHAR) || '"'
      WHEN 1 THEN chr(9) || CAST(c_custkey AS VARCHAR) || ' '
      WHEN 2 THEN ' "' || CAST(c_custkey AS VARCHAR) || '" '
      ELSE CAST(c_custkey AS VARCHAR) END, ' ' || chr(9)), '"') AS s FROM customer)
SELECT c_custkey, CASE WHEN length(s) < 4 THEN lpad(s, 4, '0') ELSE s END AS code FROM t
"""


# --------------------------------------------------------------------------
# Title case, upper case, strip
# --------------------------------------------------------------------------

def title_text(spark, d):
    p = table(spark, d, "part")
    raw = F.concat(F.lit("  "), F.col("p_name"), F.lit(" d'or-"), F.col("p_brand"), F.lit(" 9e "))
    return p.select("p_partkey",
                    X.title_case(X.strip(raw)).alias("name_title"),
                    X.upper(F.col("p_name")).alias("name_upper"))


SQL["title_text"] = """
SELECT p_partkey,
  array_to_string(list_transform(
      regexp_extract_all(lower(trim(p_name || ' d''or-' || p_brand || ' 9e ')), '([a-z]+|[^a-z]+)'),
      lambda w: upper(w[1:1]) || w[2:]), '') AS name_title,
  upper(p_name) AS name_upper
FROM part
"""


# --------------------------------------------------------------------------
# mojibake made on purpose (UTF-8 bytes read as latin1), repaired
# --------------------------------------------------------------------------

def repair_text(spark, d):
    docs = table(spark, d, "documents")
    damaged = F.decode(F.encode(F.col("text"), "UTF-8"), "ISO-8859-1")
    return docs.select("doc_id", X.repair_mojibake(damaged).alias("text"))


# The damaged text holds a trigger character when the text has a character of
# U+0080-U+00FF, U+2000-U+2FFF or U+10000-U+3FFFF (lead bytes C2, C3, E2, F0):
# then the repair gives the text back, else the damaged text stays.
SQL["repair_text"] = r"""
SELECT doc_id, CASE WHEN trim(text, E' \t\n\r\f\x0b') = '' OR lower(trim(text, E' \t\n\r\f\x0b')) = 'nan' THEN NULL
  WHEN regexp_matches(text, '[\x{80}-\x{FF}\x{2000}-\x{2FFF}\x{10000}-\x{3FFFF}]') OR regexp_full_match(text, '[\x00-\x7F]*')
  THEN trim(text, E' \t\n\r\f\x0b')
  ELSE trim(array_to_string(list_transform(regexp_extract_all(hex(encode(text)), '..'),
       lambda h: chr(CAST('0x' || h AS INTEGER))), ''), E' \t\n\r\f\x0b') END AS text
FROM documents"""


# --------------------------------------------------------------------------
# accents stripped (NFKD, non-ASCII dropped) on whole documents
# --------------------------------------------------------------------------

def strip_accents(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", X.strip_accents(F.col("text")).alias("text_ascii"))


SQL["strip_accents"] = """
SELECT doc_id, regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g') AS text_ascii
FROM documents
"""


# --------------------------------------------------------------------------
# Value map, back-reference regex, substring removal,
# sentinel to NULL, prefix
# --------------------------------------------------------------------------

PRIORITY_LABELS = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium"}


def map_values(spark, d):
    o = table(spark, d, "orders")
    p = F.col("o_orderpriority")
    return o.select(
        "o_orderkey",
        X.map_values(p, PRIORITY_LABELS).alias("prio_label"),
        X.regex_replace(p, r"(\d+)-NOT", "$1-not").alias("prio_ordinal"),
        X.remove_substring(p, "-").alias("prio_compact"),
        X.sentinel_to_null(p, "5-LOW").alias("prio_null"),
        X.prefix(p, 2).alias("prio_prefix"))


SQL["map_values"] = r"""
SELECT o_orderkey,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
       WHEN '3-MEDIUM' THEN 'Medium' ELSE o_orderpriority END AS prio_label,
  regexp_replace(o_orderpriority, '(\d+)-NOT', '\1-not') AS prio_ordinal,
  replace(o_orderpriority, '-', '') AS prio_compact,
  nullif(o_orderpriority, '5-LOW') AS prio_null,
  substring(o_orderpriority, 1, 2) AS prio_prefix
FROM orders
"""


# --------------------------------------------------------------------------
# Territory prefix, equality after padding, numeric range
# --------------------------------------------------------------------------

def territory_filter(spark, d):
    p = table(spark, d, "part")
    return P.filter_territory(p, "p_brand", prefix="Brand#1", min_length=8).select("p_partkey", "p_brand")


SQL["territory_filter"] = """
SELECT p_partkey, p_brand FROM part
WHERE starts_with(trim(p_brand), 'Brand#1') AND length(trim(p_brand)) >= 8
"""


def padded_equality(spark, d):
    c = table(spark, d, "customer")
    return c.filter(P.equals_after_pad("c_nationkey", "07", 2)).select("c_custkey", "c_name", "c_nationkey")


SQL["padded_equality"] = """
SELECT c_custkey, c_name, c_nationkey FROM customer
WHERE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') = '07'
"""


def range_filter(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").cast("string").alias("acct_text"))
    out = P.numeric_range(c, "acct_text", 1024, 1536)
    return out.select("c_custkey", N.parse_number("acct_text", decimal_comma=False).alias("c_acctbal"))


SQL["range_filter"] = """
SELECT c_custkey, TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) AS c_acctbal FROM customer
WHERE TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) BETWEEN 1024 AND 1536
"""


# --------------------------------------------------------------------------
# Consistency rules of vote counts (derived from lineitem)
# --------------------------------------------------------------------------

def _vote_columns():
    q10 = F.col("l_quantity") * 10
    votants = q10 - F.col("l_linenumber") + F.when(F.col("l_partkey") % 17 == 0, 1000).otherwise(0)
    blancs = F.col("l_linenumber").cast("double")
    nuls = (F.col("l_suppkey") % 5).cast("double")
    exprimes = votants - blancs - nuls + F.when(F.col("l_partkey") % 19 == 0, 1).otherwise(0)
    return {"inscrits": F.when(F.col("l_orderkey") % 13 != 0, q10), "votants": votants.cast("double"),
            "blancs": blancs, "nuls": nuls, "exprimes": exprimes.cast("double")}


def _votes(li):
    return li.select(*LINEITEM_KEYS, *[c.alias(n) for n, c in _vote_columns().items()])


_SQL_VOTES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_orderkey % 13 <> 0 THEN l_quantity * 10 END AS inscrits,
  CAST(l_quantity * 10 - l_linenumber + CASE WHEN l_partkey % 17 = 0 THEN 1000 ELSE 0 END AS DOUBLE) AS votants,
  CAST(l_linenumber AS DOUBLE) AS blancs,
  CAST(l_suppkey % 5 AS DOUBLE) AS nuls,
  CAST(l_quantity * 10 - l_linenumber + CASE WHEN l_partkey % 17 = 0 THEN 1000 ELSE 0 END
       - l_linenumber - (l_suppkey % 5) + CASE WHEN l_partkey % 19 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS exprimes
FROM lineitem
"""


def consistency_filter(spark, d):
    return P.vote_consistency(_votes(table(spark, d, "lineitem")))


SQL["consistency_filter"] = f"""
SELECT * FROM ({_SQL_VOTES}) v
WHERE inscrits IS NOT NULL AND votants <= inscrits AND exprimes = votants - blancs - nuls
"""


# --------------------------------------------------------------------------
# Rows whose measures are all NULL are dropped
# --------------------------------------------------------------------------

def _holes(li):
    return li.select(
        *LINEITEM_KEYS,
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_quantity")).alias("q"),
        F.when((F.col("l_orderkey") % 5 != 0) & (F.col("l_linenumber") != 3), F.col("l_discount")).alias("dsc"),
        F.when(F.col("l_orderkey") % 10 != 0, F.col("l_tax")).alias("tax"))


_SQL_HOLES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity END AS q,
  CASE WHEN l_orderkey % 5 <> 0 AND l_linenumber <> 3 THEN l_discount END AS dsc,
  CASE WHEN l_orderkey % 10 <> 0 THEN l_tax END AS tax
FROM lineitem
"""


def drop_empty_rows(spark, d):
    return P.drop_empty_rows(_holes(table(spark, d, "lineitem")), ["q", "dsc", "tax"])


SQL["drop_empty_rows"] = f"""
SELECT * FROM ({_SQL_HOLES}) h WHERE NOT (q IS NULL AND dsc IS NULL AND tax IS NULL)
"""


# --------------------------------------------------------------------------
# Union all with a copy of part of the table, then distinct rows
# --------------------------------------------------------------------------

def distinct_rows(spark, d):
    c = table(spark, d, "customer")
    c = c.withColumn("c_phone", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")))
    return D.distinct_rows(D.union_all([c, c.filter(F.col("c_mktsegment") == "BUILDING")]))


SQL["distinct_rows"] = """
WITH c AS (SELECT *, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS c_phone FROM customer)
SELECT DISTINCT * FROM (SELECT * FROM c UNION ALL SELECT * FROM c WHERE c_mktsegment = 'BUILDING')
"""


# --------------------------------------------------------------------------
# First row per key in a total order
# --------------------------------------------------------------------------

def keep_first(spark, d):
    li = table(spark, d, "lineitem")
    return D.keep_first(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


SQL["keep_first"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
  FROM lineitem) WHERE rn = 1
"""


# --------------------------------------------------------------------------
# Conformed dimension from several frames, labelled row first
# --------------------------------------------------------------------------

def conformed_dim(spark, d):
    from terroir.plans.dimensions import conformed_dimension
    nation = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("code"),
        F.when(F.col("n_regionkey") != 2, F.col("n_name")).alias("label"),
        F.col("n_regionkey").cast("string").alias("region_code"))
    cust = table(spark, d, "customer").select(
        F.col("c_nationkey").alias("code"), F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("string").alias("region_code"))
    supp = table(spark, d, "supplier").select(
        F.col("s_nationkey").alias("code"), F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("string").alias("region_code"))
    return conformed_dimension([nation, cust, supp], key="code", label="label",
                               key_width=3, pad={"region_code": 2})


SQL["conformed_dim"] = """
WITH u AS (
  SELECT DISTINCT * FROM (
    SELECT n_nationkey AS code, CASE WHEN n_regionkey <> 2 THEN n_name END AS label,
           CAST(n_regionkey AS VARCHAR) AS region_code, 0 AS src FROM nation
    UNION ALL SELECT c_nationkey, NULL, NULL, 1 FROM customer
    UNION ALL SELECT s_nationkey, NULL, NULL, 2 FROM supplier)),
p AS (
  SELECT lpad(CAST(code AS VARCHAR), 3, '0') AS code,
    array_to_string(list_transform(regexp_extract_all(lower(trim(label)), '([a-z]+|[^a-z]+)'),
                                   lambda w: upper(w[1:1]) || w[2:]), '') AS label,
    CASE WHEN length(region_code) < 2 THEN lpad(region_code, 2, '0') ELSE region_code END AS region_code,
    src FROM u)
SELECT code, label, region_code FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY label ASC NULLS LAST, src) AS rn FROM p)
WHERE rn = 1
"""


# --------------------------------------------------------------------------
# Union of frames with different columns
# --------------------------------------------------------------------------

def union_heterogeneous(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"))
    s = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return D.union_heterogeneous([c, s])


SQL["union_heterogeneous"] = """
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS party_key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier
"""


# --------------------------------------------------------------------------
# Quality report of three cleanings (time stamp left out)
# --------------------------------------------------------------------------

def quality_report(spark, d):
    li = table(spark, d, "lineitem").withColumn(
        "l_tax", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_tax")))
    li_pre = li.filter(F.col("l_quantity") <= 45).select("l_orderkey", "l_returnflag", "l_linestatus", "l_tax")
    o = table(spark, d, "orders")
    o_pre = o.filter(F.col("o_totalprice") > 1000).select("o_custkey", "o_orderstatus")
    c = table(spark, d, "customer").withColumn(
        "c_name", F.when(F.col("c_custkey") % 11 != 0, F.col("c_name")))
    c_pre = c.select("c_nationkey", "c_mktsegment", F.when(F.col("c_name").isNull(), "x").alias("flag"))
    rows = [Q.quality_row_frame("lineitem", li, Q.counted_distinct(li_pre), "lines", False),
            Q.quality_row_frame("orders", o, Q.counted_distinct(o_pre), "orders", False),
            Q.quality_row_frame("customer", c, Q.counted_distinct(c_pre), "customers", False)]
    return D.union_all(rows)


SQL["quality_report"] = """
WITH li AS (SELECT * REPLACE (CASE WHEN l_orderkey % 7 <> 0 THEN l_tax END AS l_tax) FROM lineitem),
li_pre AS (SELECT l_orderkey, l_returnflag, l_linestatus, l_tax FROM li WHERE l_quantity <= 45),
li_post AS (SELECT DISTINCT * FROM li_pre),
o_pre AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 1000),
o_post AS (SELECT DISTINCT * FROM o_pre),
c AS (SELECT * REPLACE (CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS c_name) FROM customer),
c_pre AS (SELECT c_nationkey, c_mktsegment, CASE WHEN c_name IS NULL THEN 'x' END AS flag FROM c),
c_post AS (SELECT DISTINCT * FROM c_pre)
SELECT 'lineitem' AS table_name, (SELECT count(*) FROM li) AS rows_before,
  (SELECT count(*) FROM li_post) AS rows_after,
  (SELECT count(*) FROM li) - (SELECT count(*) FROM li_post) AS rows_removed,
  4 AS columns_count,
  (SELECT count(*) FILTER (WHERE l_orderkey IS NULL) + count(*) FILTER (WHERE l_returnflag IS NULL)
        + count(*) FILTER (WHERE l_linestatus IS NULL) + count(*) FILTER (WHERE l_tax IS NULL) FROM li_post) AS null_cells,
  (SELECT count(*) FROM li_pre) - (SELECT count(*) FROM li_post) AS duplicates_removed,
  'lines' AS notes
UNION ALL
SELECT 'orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM o_post),
  (SELECT count(*) FROM orders) - (SELECT count(*) FROM o_post), 2,
  (SELECT count(*) FILTER (WHERE o_custkey IS NULL) + count(*) FILTER (WHERE o_orderstatus IS NULL) FROM o_post),
  (SELECT count(*) FROM o_pre) - (SELECT count(*) FROM o_post), 'orders'
UNION ALL
SELECT 'customer', (SELECT count(*) FROM c), (SELECT count(*) FROM c_post),
  (SELECT count(*) FROM c) - (SELECT count(*) FROM c_post), 3,
  (SELECT count(*) FILTER (WHERE c_nationkey IS NULL) + count(*) FILTER (WHERE c_mktsegment IS NULL)
        + count(*) FILTER (WHERE flag IS NULL) FROM c_post),
  (SELECT count(*) FROM c_pre) - (SELECT count(*) FROM c_post), 'customers'
"""


# --------------------------------------------------------------------------
# A3: per-column missingness profile
# --------------------------------------------------------------------------

def _gaps(li):
    return li.select(
        *LINEITEM_KEYS,
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_linenumber") != 2, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_discount")).alias("l_discount"),
        "l_returnflag")


_SQL_GAPS = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity END AS l_quantity,
  CASE WHEN l_linenumber <> 2 THEN l_extendedprice END AS l_extendedprice,
  CASE WHEN l_partkey % 3 <> 0 THEN l_discount END AS l_discount,
  l_returnflag
FROM lineitem
"""
_GAP_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_returnflag"]


def null_profile(spark, d):
    g = _gaps(table(spark, d, "lineitem"))
    return Q.null_profile(g, _GAP_COLS, ratio_digits=6)


SQL["null_profile"] = "WITH g AS (" + _SQL_GAPS + ")\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"count({c}) AS non_null_count, "
    f"{sql_r6(f'count(*) FILTER (WHERE {c} IS NULL) / count(*)')} AS null_ratio FROM g"
    for c in _GAP_COLS)


# --------------------------------------------------------------------------
# NULLs filled with the exact column median
# --------------------------------------------------------------------------

_FILL_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def median_fill(spark, d):
    g = _gaps(table(spark, d, "lineitem")).drop("l_returnflag")
    return A.median_fill(g, _FILL_COLS)


SQL["median_fill"] = "WITH g AS (" + _SQL_GAPS + "), m AS (SELECT " + ", ".join(
    f"median({c}) AS m_{c}" for c in _FILL_COLS) + " FROM g)\nSELECT l_orderkey, l_linenumber, " \
    "l_partkey, l_suppkey, " + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in _FILL_COLS) + \
    " FROM g, m"


# --------------------------------------------------------------------------
# A5: z-score with population deviation
# --------------------------------------------------------------------------

_Z_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


def zscore(spark, d):
    li = table(spark, d, "lineitem").select(*LINEITEM_KEYS, *_Z_COLS)
    z = A.zscore(li, _Z_COLS)
    return z.select(*LINEITEM_KEYS, *[r6(F.col(c)).alias(c) for c in _Z_COLS])


SQL["zscore"] = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(
    f"{sql_r6(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()')} AS {c}" for c in _Z_COLS) + \
    " FROM lineitem"


# --------------------------------------------------------------------------
# Correlation matrix
# --------------------------------------------------------------------------

def corr_matrix(spark, d):
    li = table(spark, d, "lineitem").withColumn("constant", F.lit(1.5))
    m = A.corr_matrix(li, [*MEASURES, "constant"])
    return m.select("feature_a", "feature_b", r6(F.col("r")).alias("r"))


def _sql_corr(features, frame, constant=()):
    return "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, " + (
            "CAST(NULL AS DOUBLE) AS r" if {a, b} & set(constant) else f"{sql_r6(f'corr({a}, {b})')} AS r FROM {frame}")
        for a in features for b in features)


SQL["corr_matrix"] = _sql_corr([*MEASURES, "constant"], "lineitem", ["constant"])


def _wide_measures() -> list[tuple[str, str]]:
    """(name, SQL of lineitem): eight measures, each shifted by powers of another, some with NULLs: 48 columns."""
    base = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey % 97", "l_suppkey % 13", "l_orderkey % 101", "l_linenumber"]
    out = []
    for i, m in enumerate(base):
        out.append((f"m{i}", f"CAST({m} AS DOUBLE)"))
        out += [(f"m{i}_{k}", f"CASE WHEN l_orderkey % {k + 3} > 0 THEN CAST({m} AS DOUBLE) + {k} * CAST({base[(i + k) % 8]} AS DOUBLE) END")
                for k in range(1, 6)]
    return out


def wide_corr(spark, d):
    """Correlations of more columns than one aggregation's expressions carry."""
    cols = _wide_measures()
    df = table(spark, d, "lineitem").select(*[F.expr(sql).alias(n) for n, sql in cols])
    return A.corr_matrix(df, [n for n, _ in cols]).select("feature_a", "feature_b", r6(F.col("r")).alias("r"))


SQL["wide_corr"] = (f"WITH w AS (SELECT {', '.join(f'{s} AS {n}' for n, s in _wide_measures())} FROM lineitem),\n"
                    f"c AS (SELECT {', '.join(f'corr({a}, {b}) AS {a}__{b}' for a, _ in _wide_measures() for b, _ in _wide_measures())} FROM w),\n"
                    "u AS (UNPIVOT c ON COLUMNS(*) INTO NAME pair VALUE r)\n"
                    f"SELECT split_part(pair, '__', 1) AS feature_a, split_part(pair, '__', 2) AS feature_b, {sql_r6('r')} AS r FROM u")



# --------------------------------------------------------------------------
# Regression metrics of a fixed linear guess
# --------------------------------------------------------------------------

def regression_metrics(spark, d):
    li = table(spark, d, "lineitem").select(
        (F.col("l_extendedprice") / 1000.0).alias("y"), (F.col("l_quantity") * 1.5).alias("yhat"))
    m = A.regression_metrics(li, "y", "yhat")
    return m.select(*[r6(F.col(c)).alias(c) for c in ("mae", "mse", "rmse", "r2")])


SQL["regression_metrics"] = f"""
WITH t AS (SELECT l_extendedprice / 1000.0 AS y, l_quantity * 1.5 AS yhat FROM lineitem),
a AS (SELECT avg(abs(yhat - y)) AS mae, avg((yhat - y) * (yhat - y)) AS mse,
             sum((yhat - y) * (yhat - y)) AS sse, count(y) * var_pop(y) AS sst FROM t)
SELECT {sql_r6('mae')} AS mae, {sql_r6('mse')} AS mse, {sql_r6('sqrt(mse)')} AS rmse,
       {sql_r6('1 - sse / sst')} AS r2 FROM a
"""


# --------------------------------------------------------------------------
# Inner join with _t1/_t2 suffixes, then left joins with _x/_y
# --------------------------------------------------------------------------

def _round(o, n):
    """Two rounds that together hold every order: the finished ones, the others."""
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    return o.filter(finished if n == 1 else ~finished)


def _per_customer(o, n):
    return (_round(o, n).groupBy("o_custkey")
             .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_price")))


def join_suffixed(spark, d):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    t = J.join_suffixed(_per_customer(o, 1), _per_customer(o, 2), "o_custkey", "inner",
                        ("_t1", "_t2"))
    a = c.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", F.lit(2022).alias("annee"))
    b = c.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", F.lit(2021).alias("annee"))
    t = J.join_suffixed(t, a, "o_custkey", "left")
    t = J.join_suffixed(t, b, "o_custkey", "left")
    return t.select("o_custkey", "n_orders_t1", r6(F.col("total_price_t1")).alias("total_price_t1"),
                    "n_orders_t2", r6(F.col("total_price_t2")).alias("total_price_t2"),
                    "c_acctbal", "annee_x", "c_nationkey", "annee_y")


SQL["join_suffixed"] = f"""
WITH f AS (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total_price
           FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey),
o AS (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total_price
      FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F' GROUP BY o_custkey)
SELECT f.o_custkey, f.n_orders AS n_orders_t1, {sql_r6('f.total_price')} AS total_price_t1,
       o.n_orders AS n_orders_t2, {sql_r6('o.total_price')} AS total_price_t2,
       c.c_acctbal, 2022 AS annee_x, c.c_nationkey, 2021 AS annee_y
FROM f JOIN o ON f.o_custkey = o.o_custkey
LEFT JOIN customer c ON f.o_custkey = c.c_custkey
"""


# --------------------------------------------------------------------------
# Many-to-many join with a key that holds a third of both sides
# --------------------------------------------------------------------------

def join_spread(spark, d):
    from terroir.operators.joins import join_spread as spread
    hot = lambda k, key: F.when(F.col(k) % 3 == 0, -1).otherwise(F.col(key)).alias("zone")
    customers = table(spark, d, "customer").select(hot("c_custkey", "c_nationkey"), "c_custkey", F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, d, "supplier").select(hot("s_suppkey", "s_nationkey"), "s_suppkey", F.col("s_acctbal").alias("balance"))
    return spread(customers, suppliers, "zone", rows_per_task=50_000)


SQL["join_spread"] = """
WITH c AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN -1 ELSE c_nationkey END AS zone, c_custkey, c_acctbal AS balance_x FROM customer),
s AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE s_nationkey END AS zone, s_suppkey, s_acctbal AS balance_y FROM supplier)
SELECT c.zone, c_custkey, balance_x, s_suppkey, balance_y FROM c JOIN s ON c.zone = s.zone
"""


# --------------------------------------------------------------------------
# Feature table with guarded ratios and a bounded target
# --------------------------------------------------------------------------

def _votes_per_customer(o, n):
    p = F.col("o_orderpriority")
    return (_round(o, n).groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("double").alias("inscrits"),
        F.count_if(p.isin("1-URGENT", "2-HIGH", "3-MEDIUM")).cast("double").alias("votants"),
        F.count_if(p == "3-MEDIUM").cast("double").alias("blancs"),
        F.count_if(p == "2-HIGH").cast("double").alias("nuls")))


def feature_frame(spark, d):
    """The model's input: one row per customer (both rounds present)."""
    from terroir.plans.model import build_feature_table
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    return build_feature_table(_votes_per_customer(o, 1), _votes_per_customer(o, 2),
                               [c], key="o_custkey")


FEATURE_COLS = ["inscrits_t1", "votants_t1", "blancs_t1", "nuls_t1", "taux_blancs_t1",
                "taux_nuls_t1", "c_acctbal"]
TARGET = "taux_participation_t2"


def feature_table(spark, d):
    f = feature_frame(spark, d)
    return f.select("o_custkey", "inscrits_t1", "votants_t1", "blancs_t1", "nuls_t1",
                    r6(F.col("taux_blancs_t1")).alias("taux_blancs_t1"),
                    r6(F.col("taux_nuls_t1")).alias("taux_nuls_t1"), "c_acctbal",
                    r6(F.col(TARGET)).alias(TARGET))


def _sql_votes(which):
    return f"""SELECT o_custkey, CAST(count(*) AS DOUBLE) AS inscrits,
      CAST(count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS DOUBLE) AS votants,
      CAST(count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS DOUBLE) AS blancs,
      CAST(count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS DOUBLE) AS nuls
    FROM orders WHERE o_orderstatus IS {which} 'F' GROUP BY o_custkey"""


SQL["feature_table"] = f"""
WITH t1 AS ({_sql_votes('NOT DISTINCT FROM')}), t2 AS ({_sql_votes('DISTINCT FROM')}),
j AS (
  SELECT t1.o_custkey, t1.inscrits AS inscrits_t1, t1.votants AS votants_t1, t1.blancs AS blancs_t1,
         t1.nuls AS nuls_t1,
         CASE WHEN t1.votants <> 0 THEN t1.blancs / t1.votants END AS taux_blancs_t1,
         CASE WHEN t1.votants <> 0 THEN t1.nuls / t1.votants END AS taux_nuls_t1,
         c.c_acctbal,
         CASE WHEN t2.inscrits <> 0 THEN t2.votants / t2.inscrits END AS taux_participation_t2
  FROM t1 JOIN t2 ON t1.o_custkey = t2.o_custkey
  LEFT JOIN customer c ON t1.o_custkey = c.c_custkey)
SELECT o_custkey, inscrits_t1, votants_t1, blancs_t1, nuls_t1,
  {sql_r6('taux_blancs_t1')} AS taux_blancs_t1, {sql_r6('taux_nuls_t1')} AS taux_nuls_t1, c_acctbal,
  {sql_r6('taux_participation_t2')} AS taux_participation_t2
FROM j WHERE taux_participation_t2 IS NOT NULL AND taux_participation_t2 <= 1
"""


# --------------------------------------------------------------------------
# Deterministic train/test split (every row kept, labelled)
# --------------------------------------------------------------------------

def _split_bucket():
    return ((F.col("o_orderkey") % 1000003) * F.lit(2654435761)) % 1000


def hash_split(spark, d):
    from terroir.operators.features import hash_split as split
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return split(o, ["o_orderkey"], 0.2, bucket=_split_bucket())


SQL["hash_split"] = """
SELECT o_orderkey, o_custkey,
  CASE WHEN ((o_orderkey % 1000003) * 2654435761) % 1000 < 200 THEN 'test' ELSE 'train' END AS split
FROM orders
"""


def exact_split(spark, d):
    """A fifth of all order lines, to the row, by the default hash of their keys."""
    from terroir.operators.features import exact_split as split
    return split(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"])


SQL["exact_split"] = """
WITH h AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST('0x' || substr(md5(
               l_orderkey::VARCHAR || chr(31) || l_linenumber::VARCHAR || chr(31) || '42'), 1, 13) AS BIGINT) AS h FROM lineitem),
r AS (SELECT *, row_number() OVER (ORDER BY h, l_orderkey, l_linenumber, l_partkey) AS r, count(*) OVER () AS n FROM h)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN r <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM r
"""


# --------------------------------------------------------------------------
# L2 L3: top-k by a descending measure (total order)
# --------------------------------------------------------------------------

def top_k(spark, d):
    li = table(spark, d, "lineitem")
    return (li.orderBy(F.desc("l_extendedprice"), *LINEITEM_KEYS).limit(100)
              .select(*LINEITEM_KEYS, "l_extendedprice"))


SQL["top_k"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100
"""


# --------------------------------------------------------------------------
# Catalog listing of the registered tables with their sizes
# --------------------------------------------------------------------------

def catalog_listing(spark, d):
    from terroir.sources.catalog import register_tables, table_summary
    register_tables(spark, {f"terroir_{t}": table(spark, d, t) for t in TABLES})
    return table_summary(spark, TABLES, prefix="terroir_")


SQL["catalog_listing"] = """
WITH cols AS (SELECT table_name, CAST(count(*) AS BIGINT) AS column_count
              FROM information_schema.columns
              WHERE table_name IN ('region','nation','customer','supplier','part','orders','lineitem',
                                   'events','documents','embeddings','pages','benchmark','labels',
                                   'conversations')
              GROUP BY table_name),
rows AS (""" + "\n UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES) + """)
SELECT r.table_name, c.column_count, r.row_count FROM rows r JOIN cols c USING (table_name)
"""


# --------------------------------------------------------------------------
# Delimited sink and scan round trip through the shared folder
# --------------------------------------------------------------------------

def csv_round_trip(spark, d):
    from terroir.session import scratch_path
    from terroir.sources.delimited import read_delimited
    from terroir.sources.sinks import write_delimited
    c = table(spark, d, "customer")
    path = scratch_path(spark, "csv_round_trip")
    write_delimited(c, path)
    back = read_delimited(spark, path, encoding="utf-8", ordinal=False)
    return back.select(
        N.parse_long(F.col("c_custkey")).alias("c_custkey"),
        F.col("c_name"), N.parse_int(F.col("c_nationkey")).try_cast("int").alias("c_nationkey"),
        N.parse_number(F.col("c_acctbal")).alias("c_acctbal"), F.col("c_mktsegment"))


SQL["csv_round_trip"] = "SELECT * FROM customer"


# --------------------------------------------------------------------------
# Typed read with a declared schema; S6 S8: catalog table written and scanned by name
# --------------------------------------------------------------------------

def typed_read(spark, d):
    """Text with decimal commas, non-numbers and NA tokens, read to declared types; a declared column that is missing is NULL."""
    from terroir.session import scratch_path
    from terroir.sources.delimited import read_delimited_typed
    from terroir.sources.sinks import write_delimited
    k = F.col("o_orderkey")
    price = F.when(k % 11 == 0, "ND").when(k % 11 == 1, "n/a").otherwise(F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(",")))
    raw = table(spark, d, "orders").select("o_orderkey", price.alias("price"), F.year("o_orderdate").cast("string").alias("year"),
                                           F.when(k % 7 > 0, F.col("o_orderpriority")).otherwise("NULL").alias("priority"))
    path = scratch_path(spark, "typed_read")
    write_delimited(raw, path)
    return read_delimited_typed(spark, path, "o_orderkey long, price double, year int, priority string, absent int", decimal_comma=True)


SQL["typed_read"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 > 1 THEN CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) END AS price,
       CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority END AS priority,
       CAST(NULL AS INTEGER) AS absent FROM orders
"""


def table_round_trip(spark, d):
    """A catalog table, replaced by a second write, scanned by its name and through SQL."""
    from terroir.session import scratch_path
    from terroir.sources.sinks import write_table
    path = scratch_path(spark, "table_round_trip")
    name = "t_" + path.rsplit("-", 1)[1]
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_table(o.limit(0), name, path)
    write_table(o.withColumn("year", F.lit(2024)), name, path)
    return spark.sql(f"SELECT o_orderstatus, year, count(*) AS n, max(o_totalprice) AS highest FROM {name} GROUP BY o_orderstatus, year")


SQL["table_round_trip"] = """
SELECT o_orderstatus, 2024 AS year, count(*) AS n, max(o_totalprice) AS highest FROM orders GROUP BY o_orderstatus
"""


# --------------------------------------------------------------------------
# Files whose header sits below a title line and a blank line
# --------------------------------------------------------------------------

def header_offset(spark, d):
    from terroir.session import scratch_path
    from terroir.sources.delimited import read_with_header_offset
    cols = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    line = F.concat_ws(";", *[F.col(c).cast("string") for c in cols])
    first = F.monotonically_increasing_id() % (1 << 33) == 0  # the first row of a file
    lines = table(spark, d, "customer").repartition(3).select(
        F.when(first, F.concat(F.lit("Titre\n\n" + ";".join(cols) + "\n"), line)).otherwise(line).alias("value"))
    path = scratch_path(spark, "header_offset")
    lines.write.text(path)
    back = read_with_header_offset(spark, path, 2)
    return back.select(N.parse_long("c_custkey").alias("c_custkey"), "c_name",
                       N.parse_int("c_nationkey").try_cast("int").alias("c_nationkey"), "c_mktsegment")


SQL["header_offset"] = "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer"


# --------------------------------------------------------------------------
# Quoted cells with line breaks, doubled quotes and separators, read split by split
# --------------------------------------------------------------------------

def quoted_breaks(spark, d):
    from terroir.session import scratch_path
    from terroir.sources.delimited import read_delimited
    from terroir.sources.sinks import write_delimited
    note = F.concat(F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 3 == 0, F.lit('\n"quoted"; line\n'))
                    .when(F.col("o_orderkey") % 3 == 1, F.lit("\n\n")).otherwise(F.lit('"')), F.col("o_orderstatus"))
    path = scratch_path(spark, "quoted_breaks")
    write_delimited(table(spark, d, "orders").select("o_orderkey", note.alias("note"), "o_custkey"), path)
    back = read_delimited(spark, path, ordinal=False, multiline=True)
    return back.select(N.parse_long("o_orderkey").alias("o_orderkey"), "note", N.parse_long("o_custkey").alias("o_custkey"))


SQL["quoted_breaks"] = """
SELECT o_orderkey, o_orderpriority || CASE o_orderkey % 3 WHEN 0 THEN chr(10) || '"quoted"; line' || chr(10)
       WHEN 1 THEN chr(10) || chr(10) ELSE '"' END || o_orderstatus AS note, o_custkey FROM orders
"""


# --------------------------------------------------------------------------
# V1: votes x communes x departments with the turnout percentage
# --------------------------------------------------------------------------

def elections_view(spark, d):
    from terroir.plans.views import elections_view as view
    votes = _vote_columns()
    fact = table(spark, d, "lineitem").select(
        F.col("l_partkey").cast("string").alias("codgeo"), (F.col("l_suppkey") % 30).cast("string").alias("code_departement"),
        F.lit(2024).alias("annee"), *[c.alias(n) for n, c in votes.items()])
    communes = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("codgeo"), F.col("p_name").alias("libelle_commune"))
    departments = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("code_departement"),
                                                   F.col("n_name").alias("libelle_departement"))
    return view(fact, communes, departments)


SQL["elections_view"] = f"""
SELECT CAST(v.l_partkey AS VARCHAR) AS codgeo, p.p_name AS libelle_commune, n.n_name AS libelle_departement, 2024 AS annee,
  v.inscrits, v.votants, v.blancs, v.nuls, v.exprimes,
  CASE WHEN v.inscrits > 0 THEN floor(v.votants / v.inscrits * 100.0 * 100.0 + 0.5) / 100.0 END AS taux_participation
FROM ({_SQL_VOTES}) v LEFT JOIN part p ON v.l_partkey = p.p_partkey
LEFT JOIN nation n ON v.l_suppkey % 30 = n.n_nationkey
"""


# --------------------------------------------------------------------------
# K2 A3: a table's columns, their types and their missing values
# --------------------------------------------------------------------------

def describe_table(spark, d):
    from terroir.sources.catalog import describe_table as describe
    from terroir.sources.catalog import register_tables
    orders = table(spark, d, "orders")
    register_tables(spark, {"terroir_described": orders})
    return (describe(spark, "terroir_described").select(F.col("col_name").alias("column_name"), "data_type")
            .join(Q.null_profile(orders).select("column_name", "null_count", "non_null_count"), "column_name"))


SQL["describe_table"] = """
WITH n AS (UNPIVOT (SELECT count(COLUMNS(*)) FROM orders) ON COLUMNS(*) INTO NAME column_name VALUE non_null_count)
SELECT c.column_name, CASE WHEN c.data_type = 'INTEGER' THEN 'int' WHEN c.data_type = 'VARCHAR' THEN 'string'
    WHEN c.data_type LIKE 'TIMESTAMP WITH%' THEN 'timestamp' WHEN c.data_type LIKE 'TIMESTAMP%' THEN 'timestamp_ntz'
    ELSE lower(c.data_type) END AS data_type,
  (SELECT count(*) FROM orders) - n.non_null_count AS null_count, n.non_null_count
FROM information_schema.columns c JOIN n ON c.column_name = n.column_name WHERE c.table_name = 'orders'
"""


QUERIES = {
    "header_offset": header_offset,
    "elections_view": elections_view,
    "describe_table": describe_table,
    "view_fact_dims": view_fact_dims,
    "view_dims_facts": view_dims_facts,
    "normalize_columns": normalize_columns,
    "require_and_project": require_and_project,
    "drop_all_null_columns": drop_all_null_columns,
    "add_year_key": add_year_key,
    "parse_number": parse_number,
    "parse_year": parse_year,
    "pad_codes": pad_codes,
    "title_text": title_text,
    "repair_text": repair_text,
    "strip_accents": strip_accents,
    "map_values": map_values,
    "territory_filter": territory_filter,
    "padded_equality": padded_equality,
    "range_filter": range_filter,
    "consistency_filter": consistency_filter,
    "drop_empty_rows": drop_empty_rows,
    "distinct_rows": distinct_rows,
    "keep_first": keep_first,
    "conformed_dim": conformed_dim,
    "union_heterogeneous": union_heterogeneous,
    "quality_report": quality_report,
    "null_profile": null_profile,
    "median_fill": median_fill,
    "zscore": zscore,
    "corr_matrix": corr_matrix,
    "wide_corr": wide_corr,
    "regression_metrics": regression_metrics,
    "join_suffixed": join_suffixed,
    "join_spread": join_spread,
    "feature_table": feature_table,
    "hash_split": hash_split,
    "exact_split": exact_split,
    "top_k": top_k,
    "catalog_listing": catalog_listing,
    "csv_round_trip": csv_round_trip,
    "typed_read": typed_read,
    "table_round_trip": table_round_trip,
    "quoted_breaks": quoted_breaks,
}


# --------------------------------------------------------------------------
# Random forest on the feature table (no SQL form: rows only)
# --------------------------------------------------------------------------

def _model(spark, d, curve=False):
    from terroir.plans.model import run_model
    return run_model(feature_frame(spark, d), key="o_custkey", features=FEATURE_COLS, curve=curve)


def forest_metrics(spark, d):
    return _model(spark, d).metrics


def feature_importance(spark, d):
    return _model(spark, d).importance


def forest_predictions(spark, d):
    return _model(spark, d).predictions


def learning_curve(spark, d):
    return _model(spark, d, curve=True).curve


def _plain_model(spark, d):
    """The job with an arithmetic split, which SQL can follow."""
    from terroir.plans.model import run_model
    return run_model(feature_frame(spark, d), key="o_custkey", features=FEATURE_COLS,
                     split_bucket=((F.col("o_custkey") % 1000003) * F.lit(2654435761)) % 1000)


def model_actuals(spark, d):
    """Split membership and actual values of the job's predictions."""
    return _plain_model(spark, d).predictions.select("o_custkey", r6(F.col("actual")).alias("actual"))


def model_correlation(spark, d):
    """The job's correlation table, after the median fill."""
    return _plain_model(spark, d).correlation.select("feature_a", "feature_b", r6(F.col("r")).alias("r"))


_SQL_FRAME = SQL["feature_table"][:SQL["feature_table"].rindex("SELECT o_custkey")] + """
SELECT * FROM j WHERE taux_participation_t2 IS NOT NULL AND taux_participation_t2 <= 1"""
SQL["model_actuals"] = f"""
SELECT o_custkey, {sql_r6(TARGET)} AS actual FROM ({_SQL_FRAME}) f WHERE ((o_custkey % 1000003) * 2654435761) % 1000 < 200
"""
SQL["model_correlation"] = f"WITH f AS ({_SQL_FRAME}), filled AS (SELECT " + ", ".join(
    f"coalesce({c}, (SELECT median({c}) FROM f)) AS {c}" for c in FEATURE_COLS) + " FROM f)\n" + _sql_corr(FEATURE_COLS, "filled")


QUERIES.update({
    "model_actuals": model_actuals,
    "model_correlation": model_correlation,
    "forest_metrics": forest_metrics,
    "feature_importance": feature_importance,
    "forest_predictions": forest_predictions,
    "learning_curve": learning_curve,
})


# --------------------------------------------------------------------------
# T3 on whole tables: commune measures cleaned (territory filter, padding,
# locale numbers, all-empty rows dropped, first row per code)
# --------------------------------------------------------------------------

def _raw_commune_measures(li):
    k = F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0")
    code = (F.when(F.col("l_suppkey") % 4 == 0, F.concat(F.lit("01"), k))
             .when(F.col("l_linenumber") == 7, F.concat(F.lit("69"), F.col("l_orderkey").cast("string")))
             .when(F.col("l_linenumber") == 6,
                   F.concat(F.lit(" 69"), (F.col("l_partkey") % 10).cast("string"), F.lit(" ")))
             .otherwise(F.concat(F.lit("69"), k)))
    empty = F.col("l_orderkey") % 9 == 0
    pop = F.when(~empty, F.replace(F.col("l_extendedprice").cast("string"), F.lit("."), F.lit(",")))
    act = (F.when(empty, F.lit(None).cast("string")).when(F.col("l_orderkey") % 9 == 1, F.lit("ND"))
           .otherwise(F.replace(F.col("l_quantity").cast("string"), F.lit("."), F.lit(","))))
    return li.select(code.alias("CODGEO"), pop.alias("P22_POP"), act.alias("P22_ACT"),
                     F.struct(*LINEITEM_KEYS).alias(D.ORDINAL))


def clean_commune_measures(spark, d):
    from terroir.plans.clean import clean_emploi
    out = clean_emploi(_raw_commune_measures(table(spark, d, "lineitem")))
    return out.drop(D.ORDINAL)


SQL["clean_commune_measures"] = f"""
WITH raw AS (
  SELECT CASE WHEN l_suppkey % 4 = 0 THEN '01' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0')
              WHEN l_linenumber = 7 THEN '69' || CAST(l_orderkey AS VARCHAR)
              WHEN l_linenumber = 6 THEN ' 69' || CAST(l_partkey % 10 AS VARCHAR) || ' '
              ELSE '69' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') END AS code,
         CASE WHEN l_orderkey % 9 <> 0 THEN replace(CAST(l_extendedprice AS VARCHAR), '.', ',') END AS pop,
         CASE WHEN l_orderkey % 9 = 0 THEN NULL WHEN l_orderkey % 9 = 1 THEN 'ND'
              ELSE replace(CAST(l_quantity AS VARCHAR), '.', ',') END AS act,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem),
f AS (
  SELECT CASE WHEN length(trim(code)) < 5 THEN lpad(trim(code), 5, '0') ELSE trim(code) END AS codgeo,
         {_sql_parse('pop')} AS p22_pop, {_sql_parse('act')} AS p22_act,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM raw WHERE starts_with(trim(code), '69') AND length(trim(code)) >= 5),
g AS (SELECT * FROM f WHERE NOT (p22_pop IS NULL AND p22_act IS NULL))
SELECT codgeo, p22_pop, p22_act FROM (
  SELECT *, row_number() OVER (PARTITION BY codgeo ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn
  FROM g) WHERE rn = 1
"""


# --------------------------------------------------------------------------
# T1 on whole tables: vote rows cleaned (all-NULL column dropped, locale
# numbers, consistency rules, labels cleaned twice, codes padded, distinct)
# --------------------------------------------------------------------------

def _raw_votes(li):
    cols = _vote_columns()

    def txt(c):
        return F.replace(cols[c].cast("string"), F.lit("."), F.lit(","))
    label = (F.when(F.col("l_linenumber") % 3 == 0,
                    F.concat(F.lit("saint-germain-"), F.lower("l_returnflag"), F.lit("-"),
                             F.col("l_linenumber").cast("string"), F.lit("eme")))
              .when(F.col("l_linenumber") % 3 == 1,
                    F.concat(F.lit("  lyon "), F.col("l_linenumber").cast("string"), F.lit("e arrondissement ")))
              .otherwise(F.concat(F.lit("vénissieux "), F.col("l_linestatus"))))
    return li.select(
        F.when(F.col("l_suppkey") % 3 == 0, F.lit("1")).otherwise(F.lit("69")).alias("Code departement"),
        (F.col("l_partkey") % 500).cast("string").alias("Code commune"),
        label.alias("Libelle commune"),
        F.lit(None).cast("string").alias("Code canton"),
        F.col("l_returnflag").alias("Libelle canton"),
        txt("inscrits").alias("Inscrits"), txt("votants").alias("Votants"), txt("blancs").alias("Blancs"),
        txt("nuls").alias("Nuls"), txt("exprimes").alias("Exprimes"),
        F.concat(F.lit("69_"), F.col("l_orderkey").cast("string"), F.lit("_"),
                 F.col("l_linenumber").cast("string")).alias("id_brut_miom"))


def clean_vote_rows(spark, d):
    """The raw rows land as a delimited file in the shared scratch folder,
    then the election plan runs over its scan, as on real inputs."""
    from terroir.plans.clean import clean_election
    from terroir.session import scratch_path
    from terroir.sources.delimited import read_delimited
    from terroir.sources.sinks import write_delimited
    path = scratch_path(spark, "raw_votes")
    write_delimited(_raw_votes(table(spark, d, "lineitem")), path)
    return clean_election(read_delimited(spark, path), "rows")


_SQL_TITLE = ("array_to_string(list_transform(regexp_extract_all(lower({x}), "
              "'([\\p{{Ll}}\\p{{Lu}}\\p{{Lt}}]+|[^\\p{{Ll}}\\p{{Lu}}\\p{{Lt}}]+)'), "
              "lambda w: upper(w[1:1]) || w[2:]), '')")


def _sql_clean_label(x: str) -> str:
    once = _SQL_TITLE.format(x=f"trim({x})")
    twice = _SQL_TITLE.format(x=f"trim({once})")
    return f"regexp_replace(strip_accents({twice}), '[^\\x00-\\x7F]', '', 'g')"


SQL["clean_vote_rows"] = f"""
WITH v AS ({_SQL_VOTES}),
raw AS (
  SELECT CASE WHEN v.l_suppkey % 3 = 0 THEN '1' ELSE '69' END AS code_departement,
         CAST(v.l_partkey % 500 AS VARCHAR) AS code_commune,
         CASE WHEN v.l_linenumber % 3 = 0
              THEN 'saint-germain-' || lower(l.l_returnflag) || '-' || CAST(v.l_linenumber AS VARCHAR) || 'eme'
              WHEN v.l_linenumber % 3 = 1
              THEN '  lyon ' || CAST(v.l_linenumber AS VARCHAR) || 'e arrondissement '
              ELSE 'vénissieux ' || l.l_linestatus END AS libelle_commune,
         l.l_returnflag AS libelle_canton,
         v.inscrits, v.votants, v.blancs, v.nuls, v.exprimes,
         '69_' || CAST(v.l_orderkey AS VARCHAR) || '_' || CAST(v.l_linenumber AS VARCHAR) AS id_brut_miom
  FROM v JOIN lineitem l USING (l_orderkey, l_linenumber, l_partkey, l_suppkey))
SELECT DISTINCT
  CASE WHEN length(code_departement) < 2 THEN lpad(code_departement, 2, '0') ELSE code_departement END
    AS code_departement,
  CASE WHEN length(code_commune) < 5 THEN lpad(code_commune, 5, '0') ELSE code_commune END AS code_commune,
  {_sql_clean_label('libelle_commune')} AS libelle_commune,
  libelle_canton, inscrits, votants, blancs, nuls, exprimes,
  replace(id_brut_miom, '_', '') AS id_brut_miom
FROM raw
WHERE inscrits IS NOT NULL AND votants <= inscrits AND exprimes = votants - blancs - nuls
"""


QUERIES.update({
    "clean_commune_measures": clean_commune_measures,
    "clean_vote_rows": clean_vote_rows,
})


# --------------------------------------------------------------------------
# T2 on whole tables: crime-statistics rows (positional rename, quoted and
# padded department codes, department filter, numbers, year, distinct rows)
# --------------------------------------------------------------------------

def _raw_crime(o):
    k = F.col("o_custkey") % 5
    dep = (F.when(k == 0, F.lit('"69"')).when(k == 1, F.lit(" 69")).when(k == 2, F.lit("1"))
            .otherwise(F.lit("69")))
    y = F.year("o_orderdate").cast("string")
    nombre = F.when(F.col("o_orderkey") % 11 == 0, F.lit("ND")).otherwise(
        F.replace(F.floor(F.col("o_totalprice") / 1000).cast("string"), F.lit("."), F.lit(",")))
    taux = F.replace((F.col("o_totalprice") / 100000).cast("string"), F.lit("."), F.lit(","))
    return o.select(dep.alias("Code dép"), (F.col("o_custkey") % 20).cast("string").alias("Code_region"),
                    F.when(F.col("o_orderkey") % 7 == 0, F.concat(y, F.lit(".5"))).otherwise(y).alias("annee"),
                    F.col("o_orderpriority").alias("indicateur"),
                    F.col("o_orderstatus").alias("unite_de_compte"),
                    nombre.alias("nombre"), taux.alias("taux_pour_mille"))


def clean_crime_rows(spark, d):
    from terroir.plans.clean import clean_securite
    return clean_securite(_raw_crime(table(spark, d, "orders")))


SQL["clean_crime_rows"] = f"""
WITH raw AS (
  SELECT CASE o_custkey % 5 WHEN 0 THEN '"69"' WHEN 1 THEN ' 69' WHEN 2 THEN '1' ELSE '69' END AS dep,
         CAST(o_custkey % 20 AS VARCHAR) AS region,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) || '.5'
              ELSE CAST(year(o_orderdate) AS VARCHAR) END AS annee,
         o_orderpriority AS indicateur, o_orderstatus AS unite_de_compte,
         CASE WHEN o_orderkey % 11 = 0 THEN 'ND'
              ELSE replace(CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR), '.', ',') END AS nombre,
         replace(CAST(o_totalprice / 100000 AS VARCHAR), '.', ',') AS taux
  FROM orders),
c AS (
  SELECT CASE WHEN length(trim(trim(dep), '"')) < 2 THEN lpad(trim(trim(dep), '"'), 2, '0')
              ELSE trim(trim(dep), '"') END AS code_departement,
         CASE WHEN length(region) < 2 THEN lpad(region, 2, '0') ELSE region END AS code_region,
         CASE WHEN regexp_matches(annee, '{NUM_RE}') AND TRY_CAST(annee AS DOUBLE) = floor(TRY_CAST(annee AS DOUBLE))
              THEN CAST(TRY_CAST(annee AS DOUBLE) AS INTEGER) END AS annee,
         indicateur, unite_de_compte,
         {_sql_parse('nombre')} AS nombre, {_sql_parse('taux')} AS taux_pour_mille
  FROM raw)
SELECT DISTINCT * FROM c WHERE code_departement = '69'
"""


# --------------------------------------------------------------------------
# T5 on whole tables: IRIS-level measures (renames, ASCII names, territory,
# padding, numbers, all-empty rows dropped, first row per IRIS code)
# --------------------------------------------------------------------------

def _raw_iris_measures(li):
    k = F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0")
    com = (F.when(F.col("l_suppkey") % 4 == 0, F.concat(F.lit("01"), k))
            .when(F.col("l_suppkey") % 4 == 1, F.concat(F.lit(" 69"), k, F.lit(" ")))
            .otherwise(F.concat(F.lit("69"), k)))
    iris = F.concat(F.lit("69"), k, F.lpad((F.col("l_linenumber") % 4).cast("string"), 4, "0"))
    empty = F.col("l_orderkey") % 10 == 0
    m1 = F.when(~empty, F.replace(F.col("l_discount").cast("string"), F.lit("."), F.lit(",")))
    m2 = F.when(~empty, F.col("l_quantity").cast("string"))
    return li.select(iris.alias("IRIS"), com.alias("COM"), F.col("l_returnflag").alias("TYP_IRIS"),
                     F.col("l_linestatus").alias("LAB_IRIS"), m1.alias("P22_NSCOL élèves"),
                     m2.alias("P22_POP"), F.struct(*LINEITEM_KEYS).alias(D.ORDINAL))


def clean_iris_measures(spark, d):
    from terroir.plans.clean import clean_diplomes
    return clean_diplomes(_raw_iris_measures(table(spark, d, "lineitem"))).drop(D.ORDINAL)


SQL["clean_iris_measures"] = f"""
WITH raw AS (
  SELECT '69' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') || lpad(CAST(l_linenumber % 4 AS VARCHAR), 4, '0') AS iris,
         CASE l_suppkey % 4 WHEN 0 THEN '01' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0')
              WHEN 1 THEN ' 69' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') || ' '
              ELSE '69' || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') END AS com,
         l_returnflag AS typ_iris, l_linestatus AS lab_iris,
         CASE WHEN l_orderkey % 10 <> 0 THEN replace(CAST(l_discount AS VARCHAR), '.', ',') END AS m1,
         CASE WHEN l_orderkey % 10 <> 0 THEN CAST(l_quantity AS VARCHAR) END AS m2,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem),
f AS (
  SELECT iris AS codeiris,
         CASE WHEN length(trim(com)) < 5 THEN lpad(trim(com), 5, '0') ELSE trim(com) END AS codgeo,
         typ_iris, lab_iris, {_sql_parse('m1')} AS p22_nscol_lves, {_sql_parse('m2')} AS p22_pop,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM raw WHERE starts_with(trim(com), '69') AND length(trim(com)) >= 5),
g AS (SELECT * FROM f WHERE NOT (p22_nscol_lves IS NULL AND p22_pop IS NULL))
SELECT codeiris, codgeo, typ_iris, lab_iris, p22_nscol_lves, p22_pop FROM (
  SELECT *, row_number() OVER (PARTITION BY codeiris ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn
  FROM g) WHERE rn = 1
"""


# T6 is T5 with the accents of the column names kept
def clean_iris_housing(spark, d):
    from terroir.plans.clean import clean_logement
    return clean_logement(_raw_iris_measures(table(spark, d, "lineitem"))).drop(D.ORDINAL)


SQL["clean_iris_housing"] = SQL["clean_iris_measures"].replace("p22_nscol_lves", '"p22_nscol_élèves"')


# --------------------------------------------------------------------------
# T7 on whole tables: IRIS reference rows (codes stripped, labels title-cased,
# type upper-cased, numeric id, first row per code)
# --------------------------------------------------------------------------

def _raw_iris_reference(p):
    return p.select(
        F.concat(F.lit(" "), (F.col("p_partkey") % 1000).cast("string")).alias("CODEIRIS"),
        F.col("p_name").alias("LIBELLE"),
        F.lower(F.substring("p_type", 1, 1)).alias("TYPE"),
        F.lower("p_type").alias("TYPELIBELLE"),
        F.upper("p_brand").alias("COMMUNE"),
        F.concat((F.col("p_size")).cast("string"), F.lit(" ")).alias("INSEE"),
        F.col("p_retailprice").cast("string").alias("GID"),
        F.struct("p_partkey").alias(D.ORDINAL))


def clean_iris_reference(spark, d):
    from terroir.plans.clean import clean_iris
    return clean_iris(_raw_iris_reference(table(spark, d, "part"))).drop(D.ORDINAL)


def _sql_title_ascii(x: str) -> str:
    return ("array_to_string(list_transform(regexp_extract_all(lower(" + x + "), '([a-z]+|[^a-z]+)'), "
            "lambda w: upper(w[1:1]) || w[2:]), '')")


SQL["clean_iris_reference"] = f"""
SELECT codeiris, libelle, type, typelibelle, commune, insee, gid FROM (
  SELECT trim(' ' || CAST(p_partkey % 1000 AS VARCHAR)) AS codeiris,
         {_sql_title_ascii('trim(p_name)')} AS libelle,
         upper(lower(substring(p_type, 1, 1))) AS type,
         {_sql_title_ascii('lower(p_type)')} AS typelibelle,
         {_sql_title_ascii('upper(p_brand)')} AS commune,
         trim(CAST(p_size AS VARCHAR) || ' ') AS insee,
         CASE WHEN regexp_matches(trim(CAST(p_retailprice AS VARCHAR)), '{NUM_RE}')
              THEN TRY_CAST(trim(CAST(p_retailprice AS VARCHAR)) AS DOUBLE) END AS gid,
         row_number() OVER (PARTITION BY p_partkey % 1000 ORDER BY p_partkey) AS rn
  FROM part) WHERE rn = 1
"""


QUERIES.update({
    "clean_crime_rows": clean_crime_rows,
    "clean_iris_measures": clean_iris_measures,
    "clean_iris_housing": clean_iris_housing,
    "clean_iris_reference": clean_iris_reference,
})


# --------------------------------------------------------------------------
# Star schema on whole tables: T3 + T4 facts with time keys, conformed
# commune (B1) and department (B2) dimensions, territories view (V2)
# --------------------------------------------------------------------------

def _raw_commune_income(o):
    k = F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0")
    code = F.when(F.col("o_orderkey") % 6 == 0, F.concat(F.lit("38"), k)).otherwise(F.concat(F.lit("69"), k))
    rapport = F.when(F.col("o_orderkey") % 10 != 0,
                     F.concat((F.col("o_custkey") % 97).cast("string"), F.lit(",5")))
    return o.select(code.alias("CODGEO"),
                    F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(",")).alias("MED_REV"),
                    rapport.alias("Rapport d'inégalité"),
                    F.struct("o_orderkey").alias(D.ORDINAL))


def star_territories(spark, d):
    from terroir.plans.clean import add_time_key, clean_emploi, clean_revenus, clean_securite
    from terroir.plans.dimensions import build_dim_commune, build_dim_departement
    from terroir.plans.views import territories_view
    from terroir.session import scratch_path
    from terroir.sources.sinks import write_parquet

    def written(df, name):
        # each fact feeds a dimension and the view: write it once to the
        # shared scratch folder and read it back (as the batch job does)
        path = scratch_path(spark, name)
        write_parquet(df, path)
        return spark.read.parquet(path)

    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    emploi = written(add_time_key(clean_emploi(_raw_commune_measures(li)), 2022), "emploi")
    revenus = written(add_time_key(clean_revenus(_raw_commune_income(o)), 2021), "revenus")
    securite = written(add_time_key(clean_securite(_raw_crime(o)), 2024), "securite")
    dim_commune = build_dim_commune(None, None, emploi, revenus)
    dim_departement = build_dim_departement(None, None, securite)
    return territories_view(dim_commune, dim_departement, revenus, emploi)


SQL["star_territories"] = f"""
WITH emploi AS (SELECT *, 2022 AS annee FROM ({SQL["clean_commune_measures"]})),
rraw AS (
  SELECT CASE WHEN o_orderkey % 6 = 0 THEN '38' ELSE '69' END || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') AS code,
         replace(CAST(o_totalprice AS VARCHAR), '.', ',') AS med,
         CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_custkey % 97 AS VARCHAR) || ',5' END AS rap,
         o_orderkey
  FROM orders),
rf AS (
  SELECT CASE WHEN length(trim(code)) < 5 THEN lpad(trim(code), 5, '0') ELSE trim(code) END AS codgeo,
         {_sql_parse('med')} AS med_rev, {_sql_parse('rap')} AS "rapport_dinégalité", o_orderkey
  FROM rraw WHERE starts_with(trim(code), '69') AND length(trim(code)) >= 5),
revenus AS (
  SELECT codgeo, med_rev, "rapport_dinégalité", 2021 AS annee FROM (
    SELECT *, row_number() OVER (PARTITION BY codgeo ORDER BY o_orderkey) AS rn FROM rf) WHERE rn = 1),
sec AS (SELECT * REPLACE (2024 AS annee) FROM ({SQL["clean_crime_rows"]})),
dcf AS (SELECT codgeo, CAST(NULL AS VARCHAR) AS libelle_commune, substr(codgeo, 1, 2) AS code_departement, 0 AS src
        FROM emploi
        UNION ALL
        SELECT codgeo, CAST(NULL AS VARCHAR), substr(codgeo, 1, 2), 1 FROM revenus),
dcg AS (SELECT codgeo, libelle_commune, code_departement, min(src) AS src FROM dcf
        GROUP BY codgeo, libelle_commune, code_departement),
dcp AS (SELECT CASE WHEN length(codgeo) < 5 THEN lpad(codgeo, 5, '0') ELSE codgeo END AS codgeo, libelle_commune,
               CASE WHEN code_departement IS NULL THEN NULL
                    WHEN length(code_departement) < 2 THEN lpad(code_departement, 2, '0')
                    ELSE code_departement END AS code_departement, src FROM dcg),
dc AS (SELECT codgeo, libelle_commune, code_departement FROM (
         SELECT *, row_number() OVER (PARTITION BY codgeo ORDER BY libelle_commune ASC NULLS LAST, src,
                                      code_departement ASC NULLS LAST) AS rn FROM dcp) WHERE rn = 1),
ddf AS (SELECT DISTINCT code_departement, 'Rhone' AS libelle_departement, code_region FROM sec),
dd AS (SELECT code_departement, libelle_departement, code_region FROM (
         SELECT *, row_number() OVER (PARTITION BY code_departement ORDER BY libelle_departement ASC NULLS LAST,
                                      code_region ASC NULLS LAST) AS rn FROM ddf) WHERE rn = 1)
SELECT dc.codgeo, dc.libelle_commune, dd.libelle_departement, r.med_rev, r."rapport_dinégalité", r.annee,
       e.p22_pop, e.p22_act, e.annee AS annee_1
FROM dc
LEFT JOIN dd ON dc.code_departement = dd.code_departement
LEFT JOIN revenus r ON dc.codgeo = r.codgeo
LEFT JOIN emploi e ON dc.codgeo = e.codgeo
"""


QUERIES["star_territories"] = star_territories
