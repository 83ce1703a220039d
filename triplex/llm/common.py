"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplex.session import scratch_path


#: Scratch tables that this process wrote, in order.
_WRITTEN: list[str] = []


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    This cuts the lineage with a table that outlives any executor, and fixes
    values (row ids, model outputs) that later steps read more than once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    _WRITTEN.append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """The scratch tables that are written inside a ``with`` block, to be removed when nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.first = spark, len(_WRITTEN)

    def __enter__(self):
        return self

    def __exit__(self, *failure):
        return False

    def remove(self, keep_last: bool = True) -> None:
        """Remove the tables written so far, but for the last one (the result that was made from them)."""
        stop = len(_WRITTEN) - int(keep_last)
        for path in _WRITTEN[self.first : stop]:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
        del _WRITTEN[self.first : stop]


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id string, text string)``: null text becomes empty, other columns go.

    Operators start here, so extra columns of the input, whatever their
    names, cannot clash with the columns an operator makes.  Ids go through
    Python as text: pandas turns a batch of longs that holds a null into
    floats, which are exact up to 2^53 only.  :func:`long_ids` undoes it.
    """
    return docs.select(
        F.col(id_col).cast("long").cast("string").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def long_ids(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``df`` with its text ids as numbers again."""
    return df.withColumn(id_col, F.col(id_col).cast("long"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The wanted names, each lengthened until no column of ``df`` has it (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_digest(text_col: str) -> Column:
    """SHA-256 of a text, 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))


def keep_decided(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs``, all columns, that ``decided (doc_id, digest, n, kept)`` keeps.

    ``decided`` holds each pair of id and text digest once, with its number of
    rows; of repeated rows that are kept one stays.  Only keys are stored:
    the rows are read once and dealt out once, against the keys to drop, in the
    same way at every size (a merge join, whose hot keys adaptive execution
    splits).
    """
    key_id, key_digest, digest = unused(docs, "key_id", "key_digest", "digest")
    keys = materialise(
        decided.where("NOT kept OR n > 1").select(
            F.col("doc_id").alias(key_id), F.col("digest").alias(key_digest), F.col("kept").alias("again")
        ),
        "dropped-keys",
    )
    marked = docs.withColumn(digest, text_digest(text_col))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(key_id)) & (F.col(digest) == F.col(key_digest))
    kept = marked.join(keys.select(key_id, key_digest).hint("merge"), same, "left_anti")
    if keys.where("again").take(1):
        repeated = marked.join(keys.where("again").select(key_id, key_digest), same, "left_semi")
        kept = kept.unionByName(repeated.dropDuplicates([id_col, digest]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
