"""Delimited exports, the merge of export parts, and hierarchy files.

``write_delimited`` writes a directory of part files, one per task, so an
export of any size is written in parallel.  ``merge_parts`` compacts an export
into few files of a target size, each with the header, in parallel too; a
small export becomes one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from triplex.constants import EXPORT_DELIMITER
from triplex.schema import HIERARCHY_SCHEMA
from triplex.sources.triples import NULL_MARK, TRIPLE_COLUMNS, escape_field, read_parts

# Characters of one file of a merged export (a target, not a limit).
MERGED_FILE_CHARS = 256 * 1024**2

# Options under which every string, '' and NULL survives a write/read cycle.
LOSSLESS_OPTIONS = {
    "quoteAll": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": NULL_MARK,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_delimited(
    df: DataFrame,
    path: str,
    sep: str = EXPORT_DELIMITER,
    header: bool = False,
    lossless: bool = False,
    mode: str = "overwrite",
) -> None:
    """Write ``df`` as delimited text parts.

    Default options match a plain ``write.csv`` (blanks trimmed at both ends,
    NULL and '' both read back as NULL).  ``lossless`` quotes every field and
    marks NULL as ``\\N`` so values round-trip exactly; a value that itself
    starts with a backslash is written with one more.
    """
    if lossless:
        df = df.select(*[
            F.when(F.col(f.name).startswith("\\"), F.concat(F.lit("\\"), F.col(f.name))).otherwise(F.col(f.name)).alias(f.name)
            if f.dataType.typeName() == "string" else F.col(f.name)
            for f in df.schema.fields
        ])
    writer = df.write.mode(mode).option("sep", sep).option("header", str(header).lower())
    if lossless:
        writer = writer.options(**LOSSLESS_OPTIONS)
    writer.csv(path)


def write_triples(df: DataFrame, path: str) -> None:
    """Write triples as dump lines; read back with ``read_triples(..., escaped=True)``.  NULL becomes empty."""
    fields = [F.coalesce(escape_field(c), F.lit("")) for c in TRIPLE_COLUMNS]
    df.select(F.concat_ws("\t", *fields, F.lit(".")).alias("value")).write.text(path)


def merge_parts(
    spark: SparkSession,
    folder: str,
    out_path: str,
    schema: StructType,
    sep: str = EXPORT_DELIMITER,
    header: bool = True,
    sort: bool = False,
    lossless: bool = False,
    file_chars: int = MERGED_FILE_CHARS,
    index_header: bool = False,
) -> DataFrame:
    """Merge the part files of ``folder`` into files of about ``file_chars`` under ``out_path``.

    The output goes outside the input folder, so a re-run never reads its
    own output.  ``sort`` orders by the columns from the first on: every file
    is one range, so file names and the rows inside follow the order, and
    many rows of one value still spread over files.  Returns the merged
    relation read back from ``out_path``.  ``index_header`` names the header
    fields ``0|1|...`` (a positional header) instead of the column names.
    """
    parts = read_parts(spark, folder, schema, sep=sep, lossless=lossless)
    size = parts.select(
        F.sum(F.length(F.concat_ws(sep, *[F.coalesce(F.col(c), F.lit("")) for c in parts.columns])) + 1)
    ).first()[0] or 0
    files = max(1, -(-size // file_chars))
    if sort:
        merged = parts.repartitionByRange(files, *parts.columns).sortWithinPartitions(*parts.columns)
    else:
        merged = parts.repartition(files)
    if index_header:
        merged = merged.toDF(*[str(i) for i in range(len(merged.columns))])
    write_delimited(merged, out_path, sep=sep, header=header, lossless=lossless)
    return read_parts(spark, out_path, schema, sep=sep, header=header, lossless=lossless)


def write_hierarchy(hierarchy: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the flat hierarchy relation as JSON lines (one node per line)."""
    hierarchy.write.mode(mode).json(path)


def read_hierarchy(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HIERARCHY_SCHEMA).json(path)
