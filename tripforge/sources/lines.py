"""Repairs of raw lines before they are parsed as CSV, as Column expressions over a line and its file."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def normalize_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def normalize_delimiters(text: Column) -> Column:
    """Semicolons to commas, tabs and quotes away."""
    return F.translate(text, ';\t"', ",")


def literal_fixes(text: Column, file: Column, fixes: list[tuple[str, str, str]]) -> Column:
    """Ordered replacements (part of the file's name, old, new)."""
    for part, old, new in fixes:
        text = F.when(file.contains(part), F.replace(text, F.lit(old), F.lit(new))).otherwise(text)
    return text


def balanced_quotes(text: Column) -> Column:
    """Whether the number of quotes is even."""
    return F.pmod(F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit(""))), F.lit(2)) == 0


def cell_texts(line: Column, sep: str = ",") -> Column:
    """The cells of a line as an array, by the rules of `files.parse_header`: quoted cells may hold the separator and doubled quotes, blanks around cells are dropped."""
    mark = re.escape(sep)
    # possessive throughout, so that no line is tried in more than one way
    found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(rf'{mark}[ ]*+("(?:[^"]++|"")*+"[^{mark}]*+|[^{mark}]*+)' if len(sep) == 1 else rf"{mark}((?:(?!{mark}).)*+)"), F.lit(1))
    quoted = lambda c: F.replace(F.regexp_replace(c, r'^"((?:[^"]++|"")*+)"(.*)$', "$1$2"), F.lit('""'), F.lit('"'))
    inner = lambda c: F.when(c.startswith('"'), quoted(c)).otherwise(c)
    return F.transform(found, lambda c: F.trim(F.regexp_replace(F.trim(inner(c)), r'^"+|"+$', "")))


def header_by_arity(lines: DataFrame, headers: dict[int, str], sep: str = ",") -> DataFrame:
    """Adds `header` per file from the number of fields of its first line (file, n, line); a first line that is a header stays. Another arity raises."""
    first = lines.groupBy("file").agg(F.min_by("line", "n").alias("first"))
    arity = F.size(F.split("first", re.escape(sep), -1))
    picked = F.lit(None).cast("string")
    for n, header in headers.items():
        picked = F.when(arity == n, header).otherwise(picked)
    headed = F.col("first").isin(*headers.values())
    known = F.when(headed, F.col("first")).when(picked.isNotNull(), picked).otherwise(F.raise_error(F.concat(F.lit("no header for "), arity.cast("string"), F.lit(" fields in "), F.col("file"))))
    return first.select("file", known.alias("header"), headed.alias("has_header"))


def cleaned(lines: DataFrame, fixes: list[tuple[str, str, str]] = (), drop_unbalanced: bool = False, delimiters: bool = False) -> DataFrame:
    """The composed repair of (file, line): fixes, then delimiters, then lines with odd quotes go."""
    text = literal_fixes(F.col("line"), F.col("file"), list(fixes))
    text = normalize_delimiters(text) if delimiters else text
    out = lines.withColumn("line", text)
    return out.where(balanced_quotes(F.col("line"))) if drop_unbalanced else out


def parse_lines(lines: DataFrame, schema: StructType, sep: str = ",", quarantine: bool = False) -> DataFrame:
    """Columns of cleaned lines or records; other columns stay. Cells are those of RFC 4180, with line breaks if a line is a whole record. A line of another width raises, or with `quarantine` is in `_corrupt`. An empty quoted text stays apart from a missing one."""
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n", "nullValue": "\u0001", "emptyValue": "", "mode": "FAILFAST"}
    if quarantine:
        schema = StructType([*schema.fields, StructField("_corrupt", StringType())])
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    typed = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return lines.withColumn("__r", F.from_csv("line", typed, options)).select(*[c for c in lines.columns if c != "line"], "__r.*")


def header_for_files(lines: DataFrame, headers: list[tuple[str, str]]) -> DataFrame:
    """Adds `header` to (file, …): the header of the first entry (part of the file's name, header) that fits; null for files that carry their own."""
    picked = F.lit(None).cast("string")
    for part, header in reversed(headers):
        picked = F.when(F.col("file").contains(part), header).otherwise(picked)
    return lines.withColumn("header", picked)
