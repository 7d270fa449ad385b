"""Delimited-file scans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir.operators.dedup import ORDINAL, union_all, with_ordinal
from terroir.session import scratch_path
from terroir.sources.records import quoted_records

# The text tokens a data-frame CSV reader treats as missing by
# default (Spark only treats the empty field as NULL).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null"]


# Encoding aliases -> the charset names Spark's CSV reader accepts.
CHARSET_ALIASES = {
    "latin1": "ISO-8859-1", "latin-1": "ISO-8859-1", "iso8859-1": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1", "l1": "ISO-8859-1", "cp819": "ISO-8859-1",
    "utf8": "UTF-8", "utf-8": "UTF-8", "utf-8-sig": "UTF-8", "utf_8": "UTF-8",
    "ascii": "US-ASCII", "us-ascii": "US-ASCII",
}


def spark_charset(encoding: str) -> str:
    return CHARSET_ALIASES.get(encoding.lower(), encoding)


class SourceNotFoundError(FileNotFoundError):
    """The input file does not exist."""


@dataclass(frozen=True)
class SourceSpec:
    """One raw input: a name, a path (file or folder), its encoding."""

    name: str
    path: str
    encoding: str = "utf-8"
    sep: str = ";"


def na_to_null(df: DataFrame, tokens: list[str] = NA_TOKENS, exclude: tuple = (ORDINAL,)) -> DataFrame:
    """Missing-value tokens become NULL in every string column (one select)."""
    out = []
    for f in df.schema.fields:
        if f.name not in exclude and isinstance(f.dataType, T.StringType):
            c = F.col(f"`{f.name}`")
            out.append(F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


class MalformedRowError(ValueError):
    """A header or row does not fit (raised before any job; inside a job the
    row's own error is raised)."""


CORRUPT = "_corrupt"


def _from_csv(value: Column, names: list[str], sep: str) -> Column:
    """One line as a struct of strings; a cell that is there but empty is ''."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return F.from_csv(value, _ddl(schema),
                      {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "nullValue": "\x00", "emptyValue": "", "mode": "PERMISSIVE"})


def _ddl(schema: T.StructType) -> str:
    return ", ".join("`" + f.name.replace("`", "``") + "` string" for f in schema.fields)


def _refuse_long_rows(df: DataFrame, line: Column, width: int, sep: str, where: Column | None = None, first: str | None = None) -> DataFrame:
    """Fail when a line has more cells than the header (fewer are padded with
    NULL, as a data-frame reader does)."""
    cells = _from_csv(line, [f"c{i}" for i in range(width + 1)], sep)
    long = cells[f"c{width}"].isNotNull()
    if where is not None:
        long = where & long
    told = F.concat_ws("", F.lit(f"more than {width} cells in line: "), line)
    if first is not None:  # a scan of the corrupt-record column alone is not allowed
        told = F.concat_ws(" of ", told, F.col(f"`{first}`"))
    return df.filter(F.when(long, F.raise_error(told)).otherwise(F.lit(True)))


def read_delimited(spark: SparkSession, path: str, encoding: str = "utf-8", sep: str = ";",
                   header: bool = True, ordinal: bool = True, multiline: bool = False,
                   na_tokens: list[str] | None = NA_TOKENS) -> DataFrame:
    """Header-driven scan where every column is a string; quotes are
    doubled inside quoted fields; missing tokens become NULL; optional file
    order ordinal for keep-first deduplication. No schema inference.

    Every file of a folder must have the first file's header (another one
    fails the job: nothing is read by position), and a row with more cells than
    the header fails it too. Shorter rows are padded with NULL. `multiline`
    takes line breaks in quoted cells, without giving a file to one task; files
    may then hold the columns in another order (they are read by name)."""
    if multiline and header:
        df = read_with_header_offset(spark, path, 0, encoding, sep, quoted_breaks=True, na_tokens=na_tokens)
        return df if ordinal else df.drop(ORDINAL)
    reader = (spark.read.option("sep", sep).option("header", header)
              .option("encoding", spark_charset(encoding)).option("quote", '"').option("escape", '"').option("inferSchema", False)
              .option("multiLine", multiline).option("mode", "PERMISSIVE").option("enforceSchema", not header))
    try:
        names = reader.csv(path).columns
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise SourceNotFoundError(f"input not found: {path}") from e
        raise
    if header and CORRUPT not in names:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
        # cells are counted on whole lines
        df = reader.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).schema(schema).csv(path)
        if ordinal:
            df = with_ordinal(df)
        df = _refuse_long_rows(df, F.col(CORRUPT), len(names), sep, F.col(CORRUPT).isNotNull(), names[0]).drop(CORRUPT)
    else:
        df = reader.csv(path)
        if ordinal:
            df = with_ordinal(df)
    if na_tokens:
        df = na_to_null(df, na_tokens)
    return df


def read_delimited_typed(spark: SparkSession, path: str, schema: T.StructType | str,
                         encoding: str = "utf-8", sep: str = ";", decimal_comma: bool = False,
                         ordinal: bool = False) -> DataFrame:
    """A typed read without inference. Columns are scanned as text, then
    converted to the declared types: numbers through the guarded parse (a
    value that is not a number becomes NULL instead of failing the job),
    other types through `try_cast`. Declared columns missing from the file
    come back as NULL; extra file columns are dropped."""
    from terroir.functions.numeric import parse_long, parse_number
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    df = read_delimited(spark, path, encoding, sep, ordinal=ordinal)
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            out.append(parse_number(c, decimal_comma).try_cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            out.append(parse_long(c, decimal_comma).try_cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(c.alias(f.name))
        else:
            out.append(c.try_cast(f.dataType).alias(f.name))
    if ordinal:
        out.append(F.col(ORDINAL))
    return df.select(*out)


def read_with_header_offset(spark: SparkSession, path: str, skip: int, encoding: str = "utf-8",
                            sep: str = ";", quoted_breaks: bool = False,
                            na_tokens: list[str] | None = NA_TOKENS) -> DataFrame:
    """The first `skip` lines are junk, line `skip` holds the header.

    Files are read as lines (blank ones count), numbered inside each file's
    first split, where the junk lines are. The header lines come to the driver,
    one per different header; files whose headers hold the same names in
    another order are read by name, other differences are refused. The rest is
    parsed with the header's full width; blank lines are dropped, rows with more
    cells than the header fail the job. With `quoted_breaks` quoted cells may hold
    line breaks (`sources.records`: still split by split; lines end with LF or
    CRLF, the quotes of the junk lines balance); without, they cannot."""
    try:
        lines = spark.read.option("lineSep", "\n").text(path) if quoted_breaks else spark.read.text(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise SourceNotFoundError(f"input not found: {path}") from e
        raise
    charset = spark_charset(encoding)
    line = F.col("value") if charset == "UTF-8" else F.decode(F.col("value").cast("binary"), charset)
    lines = with_ordinal(lines).withColumn("value", line)
    if quoted_breaks:
        lines = quoted_records(lines)
    lines = lines.withColumn("value", F.regexp_replace("value", r"\r\z", ""))
    o = F.col(ORDINAL)
    # lines of one split are numbered one after the other; only first splits hold junk
    top = lines.filter(o["block"] == 0)
    start = top.groupBy(o["file"].alias("f")).agg(F.min(o["pos"]).alias("p0"), F.min_by("value", o["pos"]).alias("head"))
    if skip:
        start = (top.join(start.drop("head"), o["file"] == F.col("f")).filter(o["pos"] - F.col("p0") == skip)
                 .select("f", "p0", F.col("value").alias("head")))
    kept = scratch_path(spark, "headers")
    start.withColumn("head", F.regexp_replace("head", "^\ufeff", "")).write.parquet(kept)
    heads = spark.read.schema("f string, p0 long, head string").parquet(kept)  # one row a file, of a known size
    different = heads.groupBy("head").agg(F.min("f").alias("f")).orderBy("f").collect()
    if not different:
        raise ValueError(f"no header line {skip} in {path}")
    parts, first = [], None
    for r in different:
        width = r["head"].count(sep) + 1
        cells = spark.range(1).select(_from_csv(F.lit(r["head"]), [f"c{i}" for i in range(width)], sep).alias("c")).first()["c"]
        names = [c if c else f"_c{i}" for i, c in enumerate(x for x in cells if x is not None)]
        first = first or names
        if sorted(names) != sorted(first):
            raise MalformedRowError(f"header of {r['f']} is {names}, not {first}")
        parts.append((r["head"], names))
    body = lines.join(heads, o["file"] == F.col("f"))
    body = body.filter(((o["block"] != 0) | (o["pos"] - F.col("p0") > skip)) & (F.trim("value") != ""))
    out = []
    for head, names in parts:
        mine = _refuse_long_rows(body.filter(F.col("head") == head), F.col("value"), len(names), sep)
        row = mine.select(_from_csv(F.col("value"), [f"c{i}" for i in range(len(names))], sep).alias("r"), ORDINAL)
        out.append(row.select(*[F.col("r")[f"c{names.index(n)}"].alias(n) for n in first], ORDINAL))
    found = union_all(out)
    return na_to_null(found, na_tokens) if na_tokens else found


__all__ = ["NA_TOKENS", "SourceNotFoundError", "MalformedRowError", "SourceSpec", "na_to_null", "read_delimited",
           "read_delimited_typed", "read_with_header_offset"]
