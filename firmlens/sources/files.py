"""File sources and sinks: typed CSV (S3), label dictionaries (S4), CSV write (K1).

Schemas are always declared: inference would read identifiers such as postal codes or
company numbers as numbers and lose their leading zeros (``01000`` → 1000).
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import materialize
from .sinks import append_new
from .spanning import Quoted, block_states, read_lines, records
from .tables import read_table

LABEL_SCHEMA = StructType([StructField("code", StringType()), StructField("libelle", StringType())])


# How the reader and the writer agree: quotes are doubled inside quoted values (no backslash
# escapes), line breaks stay inside quotes, and null is written as a mark of its own, so that
# an empty text stays an empty text.
NULL_MARK = "\\N"


def _csv_options(sep: str, encoding: str, header: bool, null_mark: str) -> dict[str, object]:
    return {
        "header": header, "sep": sep, "encoding": encoding, "quote": '"', "escape": '"', "nullValue": null_mark,
        "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    sep: str = ",",
    encoding: str = "UTF-8",
    header: bool = True,
    mode: str = "PERMISSIVE",
    date_format: str | None = None,
    null_mark: str = NULL_MARK,
    multi_line: bool = True,
    rejects: str | None = None,
) -> DataFrame:
    """S3: CSV with a header and a declared schema. Quoted values may hold line breaks, and a file is still read by
    many tasks (``spanning``); ``multi_line=False`` saves a pass over files that are known to have none.

    A record with a value that does not parse as its column's type, or with too few or too many values, fails the
    read in FAILFAST mode and is left out in DROPMALFORMED. In PERMISSIVE mode its bad values become null and the row is kept;
    with ``rejects`` (a folder) such records are not loaded but set aside there, each once (``rejected_records``), so that
    they can be counted and loaded again. Texts in other encodings than UTF-8, and files whose quotes don't stand in pairs,
    are read by one task per file.
    """
    options = _csv_options(sep, encoding, header, null_mark) | ({"dateFormat": date_format} if date_format else {})
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def plain(paths: str | list[str], mode: str, schema: StructType = declared) -> DataFrame:
        reader = spark.read.schema(schema).options(**options, columnNameOfCorruptRecord=_BAD)
        return reader.option("mode", mode).option("multiLine", multi_line).csv(paths)

    whole = encoding.upper().replace("-", "") != "UTF8" or not multi_line
    if whole and rejects is None:
        return plain(path, mode)
    marked = StructType([*declared.fields]).add(_BAD, StringType())
    parts: list[DataFrame] = []
    if whole:
        parts.append(plain(path, "PERMISSIVE", marked))
    else:
        lines = read_lines(spark, path)
        shape = Quoted()
        blocks = block_states(lines, shape)
        odd = [f for f, s in blocks.last.items() if shape.inside(s)]
        if odd:
            parts.append(plain([unquote(f) for f in odd], mode if rejects is None else "PERMISSIVE", declared if rejects is None else marked))
            # the other files by themselves: without the odd ones they may be split otherwise
            rest = [unquote(f) for f in blocks.last if f not in odd]
            lines = read_lines(spark, rest) if rest else lines.limit(0)
            blocks = block_states(lines, shape)
        text = F.regexp_replace("text", "\r$", "")
        found = records(lines, shape, blocks).where(F.length(text) > 0)
        if header:
            found = found.where("block > 0 OR seq > 0")
        fixed = {k: v for k, v in options.items() if k not in ("header", "encoding")}
        given = marked if rejects is not None or mode == "DROPMALFORMED" else declared
        parse = {k: str(v) for k, v in fixed.items()} | {"mode": "FAILFAST" if mode == "FAILFAST" and rejects is None else "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
        row = found.select(F.from_csv(text, given.toDDL(), parse).alias("__r")).select("__r.*")
        if mode == "DROPMALFORMED" and rejects is None:
            row = row.where(F.col(_BAD).isNull()).drop(_BAD)
        parts.append(row)
    rows = reduce(DataFrame.unionByName, parts)
    if rejects is None:
        return rows
    rows = materialize(rows, "csv")  # parsed once, with the verdict
    lost = rows.where(F.col(_BAD).isNotNull()).select(F.sha2(_BAD, 256).alias("hash"), F.col(_BAD).alias("record")).distinct()
    append_new(lost, rejects, ["hash"])
    return rows.where(F.col(_BAD).isNull()).drop(_BAD)


_BAD = "__malformed"


def rejected_records(spark: SparkSession, rejects: str) -> DataFrame:
    """``(hash, record)``: the CSV records set aside under ``rejects``."""
    return read_table(spark, rejects, "hash string, record string")


def read_labels(
    spark: SparkSession,
    path: str,
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    schema: StructType = LABEL_SCHEMA,
) -> DataFrame:
    """A ``code;label`` dictionary in a declared encoding (Latin-1 by default), read as
    text columns. Dictionaries are small; joins broadcast them after a size check."""
    return read_csv_typed(spark, path, schema, sep=sep, encoding=encoding)


def write_csv(
    df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", sep: str = ",", encoding: str = "UTF-8",
    null_mark: str = NULL_MARK,
) -> None:
    """K1: CSV with a header; one file per partition, written through the job committer
    (a failed or retried task never leaves a partial file in the output). ``read_csv_typed``
    gets the same rows back; a text equal to ``null_mark`` is the one it cannot tell from null."""
    options = _csv_options(sep, encoding, header, null_mark) | {"emptyValue": '""'}
    df.write.mode(mode).options(**options).csv(path)


def write_labels(df: DataFrame, path: str, sep: str = ";", encoding: str = "ISO-8859-1") -> None:
    """Write a dictionary in the label-file format (for fixtures and exports)."""
    write_csv(df, path, sep=sep, encoding=encoding)
