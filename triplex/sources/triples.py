"""File sources: the tab-separated triple dump and delimited exports.

Schemas are always declared (no inference pass over the data).  Text
files are splittable when uncompressed, so the scan parallelism follows
``spark.sql.files.maxPartitionBytes``; for a dump of many TB set it to
256-1024 MB to keep the task count manageable.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from triplex.schema import (
    PREDICATE_LIST_SCHEMA,
    RAW_TRIPLE_SCHEMA,
    TRIPLE_COLUMNS,
)

READ_MODES = ("compat", "ntriples")

# --- FIXED VALUES: line escapes of the dump format (character, its escape) -------
LINE_ESCAPES = (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))
NULL_MARK = "\\N"


def escape_field(c: str) -> Column:
    """A field with tab, line feed, carriage return and backslash escaped, so that it fits one line."""
    out = F.replace(F.col(c), F.lit("\\"), F.lit("\\\\"))
    for char, escape in LINE_ESCAPES:
        out = F.replace(out, F.lit(char), F.lit(escape))
    return out


def unescape_field(c: str) -> Column:
    """Undo :func:`escape_field`.

    Pairs of backslashes are marked first, from left to right, so what follows
    one is never taken for an escape.  The mark cannot occur by itself: in an
    escaped field a backslash is followed by a backslash or a letter.  Plain
    replacements only, which stay inside generated code.
    """
    backslash, mark = "\\", "\\\u0001"
    out = F.replace(F.col(c), F.lit("\\\\"), F.lit(mark))
    for char, escape in LINE_ESCAPES:
        out = F.replace(out, F.lit(escape), F.lit(char))
    return F.when(F.col(c).contains(backslash), F.replace(out, F.lit(mark), F.lit(backslash))).otherwise(F.col(c))


def _tsv_reader(spark: SparkSession, schema: StructType, mode: str):
    if mode not in READ_MODES:
        raise ValueError(f"mode must be one of {READ_MODES}, got {mode!r}")
    reader = (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", "false")
        .option("lineSep", "\n")  # a lone carriage return is part of a field
    )
    if mode == "ntriples":
        # The line format has no quoting: keep every byte of a field.
        reader = reader.option("quote", "").option("escape", "")
    return reader


def read_triples(
    spark: SparkSession, path: str | list[str], mode: str = "compat", spread: int | None = None,
    escaped: bool = False,
) -> DataFrame:
    """Scan headerless ``subject<TAB>predicate<TAB>object<TAB>.`` lines.

    ``compat`` applies the CSV reader's default quoting (a field that is
    entirely quoted loses its quotes, backslash escapes are consumed);
    ``ntriples`` disables quoting so fields are read verbatim.  The trailing
    ``.`` column is dropped; Catalyst prunes it from the scan.

    ``escaped`` undoes the line escapes of ``write_triples`` (tab, line
    breaks and backslash inside a field).

    ``spread``: for unsplittable input (a ``.gz`` dump is read by one task
    per file), distribute the parsed rows round-robin over ``spread``
    partitions right after the scan.  Round-robin, not a hash of the triple,
    so the dedup still combines duplicate copies map-side before its own
    shuffle.  Leave it unset for splittable input: it costs a shuffle.
    """
    df = _tsv_reader(spark, RAW_TRIPLE_SCHEMA, mode).csv(path).drop("Blank")
    if escaped:
        df = df.select(*[unescape_field(c).alias(c) for c in TRIPLE_COLUMNS])
    return df.repartition(spread) if spread else df


# --- FIXED VALUES: why a line is no triple, in the order of the tests ---------------
BLANK_LINE = "blank line"
FIELD_COUNT = "field count"
MISSING_VALUE = "missing value"
NO_END_MARK = "no end mark"
END_MARK = "."


@dataclass
class CheckedTriples:
    """A dump whose lines were checked: every line is one row of ``triples`` or of ``rejects``."""

    lines: DataFrame  # line, reason (null: accepted), Subject, Predicate, Object

    @property
    def triples(self) -> DataFrame:
        return self.lines.where(F.col("reason").isNull()).select(*TRIPLE_COLUMNS)

    @property
    def rejects(self) -> DataFrame:
        """``line, reason`` of the lines that are no triple, as they were read."""
        return self.lines.where(F.col("reason").isNotNull()).select("line", "reason")

    def counts(self) -> DataFrame:
        """``metric, value``: all lines, accepted lines, rejected lines by reason (one pass)."""
        by_reason = self.lines.groupBy(F.coalesce("reason", F.lit("accepted")).alias("metric")).agg(
            F.count(F.lit(1)).alias("value")
        )
        return by_reason.unionByName(by_reason.agg(F.coalesce(F.sum("value"), F.lit(0)).alias("value")).select(
            F.lit("lines").alias("metric"), "value"
        ))


def read_triples_checked(
    spark: SparkSession, path: str | list[str], mode: str = "compat", escaped: bool = False
) -> CheckedTriples:
    """Scan a dump like :func:`read_triples`, with the lines that are no triple set apart.

    The parser routes records with too few or too many fields to a column of
    their own (``columnNameOfCorruptRecord``); a record of four fields is
    rejected if one of the three values is missing or if it does not end with
    the end mark.  Accepted rows are those that :func:`read_triples` gives.
    """
    if mode not in READ_MODES:
        raise ValueError(f"mode must be one of {READ_MODES}, got {mode!r}")
    options = {"sep": "\t", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}
    if mode == "ntriples":
        options |= {"quote": "", "escape": ""}
    fields = ", ".join(f"{c} string" for c in RAW_TRIPLE_SCHEMA.names)
    record = F.from_csv("line", F.lit(f"{fields}, bad string"), options)
    read = spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"), record.alias("r"))
    missing = F.lit(False)
    for c in TRIPLE_COLUMNS:
        missing = missing | F.col(f"r.{c}").isNull()
    reason = (
        F.when(F.trim("line") == "", BLANK_LINE)
        .when(F.col("r.bad").isNotNull(), FIELD_COUNT)
        .when(missing, MISSING_VALUE)
        .when(~F.col("r.Blank").eqNullSafe(END_MARK), NO_END_MARK)
    )
    lines = read.select("line", reason.alias("reason"), *[F.col(f"r.{c}").alias(c) for c in TRIPLE_COLUMNS])
    if escaped:
        lines = lines.select("line", "reason", *[unescape_field(c).alias(c) for c in TRIPLE_COLUMNS])
    return CheckedTriples(lines)


def read_predicate_list(spark: SparkSession, path: str | list[str], header: bool = False) -> DataFrame:
    """Scan a one-column list of predicates (a unique-predicates export)."""
    return (
        spark.read.schema(PREDICATE_LIST_SCHEMA)
        .option("header", str(header).lower())
        .option("sep", "|")
        .csv(path)
    )


def read_named_csv(
    spark: SparkSession, path: str | list[str], columns: dict[str, str], sep: str = ",", lossless: bool = True
) -> DataFrame:
    """Triples from delimited files with a header: ``columns`` maps Subject, Predicate, Object to header names.

    Columns are found by name, so their order does not matter and others are
    ignored.  All files of a folder must have one header: Spark compares each
    file's with the first one's and fails where they differ, instead of reading
    values of other columns.  ``lossless`` as in :func:`read_parts`.
    """
    missing = [c for c in TRIPLE_COLUMNS if c not in columns]
    if missing:
        raise ValueError(f"no header name given for {missing}")
    options = {"sep": sep, "header": "true", "enforceSchema": "false"} | (LOSSLESS_READ if lossless else {})
    names = spark.read.options(**options).csv(path).columns
    absent = [n for n in columns.values() if n not in names]
    if absent:
        raise ValueError(f"no column {absent} in the header {names}")
    schema = StructType([StructField(n, StringType()) for n in names])
    rows = spark.read.options(**options).schema(schema).csv(path)
    return rows.select(*[(_unmarked(columns[c]) if lossless else F.col(f"`{columns[c]}`")).alias(c) for c in TRIPLE_COLUMNS])


def _unmarked(name: str) -> Column:
    """A value that starts with a backslash was written with one more (see ``write_delimited``)."""
    c = F.col(f"`{name}`")
    return F.when(c.startswith("\\"), c.substr(F.lit(2), F.length(c))).otherwise(c)


#: Reader options that match the lossless export.
LOSSLESS_READ = {
    "quote": '"', "escape": '"', "nullValue": NULL_MARK, "emptyValue": "", "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_parts(
    spark: SparkSession,
    folder: str | list[str],
    schema: StructType,
    sep: str = "|",
    header: bool = False,
    lossless: bool = False,
) -> DataFrame:
    """Scan every part file of an export folder as one relation.

    ``lossless`` must match the option used when writing (see
    ``triplex.sinks.delimited``).
    """
    reader = spark.read.schema(schema).option("sep", sep).option("header", str(header).lower())
    if lossless:
        reader = (
            reader.option("quote", '"')
            .option("escape", '"')
            .option("nullValue", NULL_MARK)
            .option("emptyValue", "")
            .option("multiLine", "true")
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
        )
    parts = reader.csv(folder)
    if lossless:  # a value that starts with a backslash was written with one more
        parts = parts.select(*[
            F.when(F.col(f.name).startswith("\\"), F.expr(f"substring(`{f.name}`, 2)")).otherwise(F.col(f.name)).alias(f.name)
            if f.dataType.typeName() == "string" else F.col(f.name)
            for f in schema.fields
        ])
    return parts
