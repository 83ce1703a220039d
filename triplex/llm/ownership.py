"""Secret scans with corpus-wide ownership frequency (operator 6).

Patterns find candidates; how many distinct owners and repositories hold a
candidate's value tells what it is.  A value looks live (owner-specific) only
if both are few: at most ``MAX_OWNERS`` owners and at most ``MAX_REPOSITORIES``
repositories hold it.  Any other was copied from a manual or a template: a
widely copied example, also where all its copies lie with one owner.  Loose candidates (long mixed tokens without a keyword
beside them) are reported only if they are owner-specific, so the corpus, not
a word list, separates them from common identifiers.

Everything is DataFrame functions.  A pattern's matches and the text between
them come from one extraction and one split; running sums of their lengths
give the places.  Values are counted in three steps (value, owner and
repository; value and owner; value), each combined before its shuffle, so a
value that a third of the corpus holds has no hot task; adaptive execution
splits the join that brings the counts back.

The table has no repository of its own: ``source`` is the owner and every
document one repository, both parameters.

Defined results: null and empty texts have no spans; null owners are one
owner; repeated rows are rows of their own; an empty table gives no rows;
other columns are ignored whatever their names; nothing is cut off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplex.llm.common import materialise, text_digest, unused

# Kind, pattern, group of the value, least length of the value.
KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("owned", r"[A-Za-z0-9_+-]{20,}", 0, 20),
)
#: Kinds that are always reported; later ones only if owner-specific.
BASE_KINDS = 3
#: A value that more owners hold is a widely copied example; up to so many may
#: hold a live one, as forks and mirrors carry it along.
MAX_OWNERS = 8
#: So is a value that more repositories hold, whoever owns them: up to four for
#: each of that many owners may hold a live one.
MAX_REPOSITORIES = 4 * MAX_OWNERS
MARK = "[SECRET]"


def _found(kind: int, m, value, before, n) -> F.Column:
    least = KINDS[kind][3]
    ok = F.length(value) >= least
    if kind >= BASE_KINDS:  # a live-looking token mixes digits, capitals and small letters
        ok = ok & value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")
    return F.struct(
        F.lit(kind).alias("kind"),
        n.alias("n"),
        F.length(before).alias("before"),
        F.length(m).alias("length"),
        F.when(ok, F.unhex(F.sha2(value, 256))).alias("value"),
    )


def _finder(kind: int):
    return lambda x, i: _found(kind, x[f"m{kind}"], x[f"v{kind}"], x[f"p{kind}"], i)


def candidates(rows: DataFrame) -> DataFrame:
    """``row_id, doc_id, owner, repository, kind, n, before, length, value`` of every match.

    ``before`` is the length of the text between the match before and this
    one; ``value`` is null for matches that fail their kind's conditions.
    Rows without a match appear once, with a null kind.
    """
    cut = rows
    for k, (_, pattern, group, _) in enumerate(KINDS):
        cut = cut.withColumns({
            f"m{k}": F.regexp_extract_all("text", F.lit(pattern), F.lit(0)),
            f"v{k}": F.regexp_extract_all("text", F.lit(pattern), F.lit(group)),
            f"p{k}": F.split("text", pattern, -1),
        })
    cut = cut.drop("text")
    found = []
    for k in range(len(KINDS)):
        each = F.transform(F.arrays_zip(f"m{k}", f"v{k}", f"p{k}"), _finder(k))
        found.append(F.filter(each, lambda e: e["length"].isNotNull()))  # the last piece follows no match
    return cut.select("row_id", "doc_id", "owner", "repository", F.explode_outer(F.concat(*found)).alias("e")).select(
        "row_id", "doc_id", "owner", "repository", "e.*"
    )


def ownership(found: DataFrame) -> DataFrame:
    """``value, owners, repositories, uses``: how widely each candidate value is held."""
    return (
        found.where("value IS NOT NULL")
        .groupBy("value", "owner", "repository").agg(F.count(F.lit(1)).alias("uses"))
        .groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("uses").alias("uses"))
        .groupBy("value").agg(
            F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), F.sum("uses").alias("uses")
        )
    )


def scan_rows(rows: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Spans of ``rows (row_id, doc_id, owner, repository, text)``, one per row.

    ``row_id, doc_id, kind, start, end, value, owners, repositories, live``;
    rows without a match appear once with a null kind.
    """
    found = materialise(candidates(rows), "secret-candidates")
    held = materialise(ownership(found), "secret-owners")
    counted = found.where("value IS NOT NULL").join(held, "value").select(*found.columns, "owners", "repositories")
    rest = found.where("value IS NULL").select(
        "*", F.lit(None).cast("long").alias("owners"), F.lit(None).cast("long").alias("repositories")
    )
    marked = materialise(counted.unionByName(rest), "secret-counts")
    upto = Window.partitionBy("row_id", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("row_id", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    start = F.sum("before").over(upto) + F.coalesce(F.sum("length").over(earlier), F.lit(0))
    return marked.repartition("row_id").select(
        "row_id", "doc_id", "kind", start.alias("start"), (start + F.col("length")).alias("end"),
        "value", "owners", "repositories",
        ((F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)).alias("live"),
    )


def _rows(
    docs: DataFrame, id_col: str, text_col: str, owner_col: str, repository_col: str, row_id, carried=None
) -> DataFrame:
    return docs.select(
        row_id.alias("row_id"),
        (F.col(id_col).cast("long") if carried is None else carried).alias("doc_id"),
        F.col(owner_col).cast("string").alias("owner"),
        F.col(repository_col).cast("string").alias("repository"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def _joined(spans) -> F.Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.concat_ws(",", F.transform(
        spans,
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
    ))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per document: counts of the base kinds, span strings, and how many values are live or examples."""
    spans = scan_rows(
        _rows(docs, id_col, text_col, owner_col, repository_col, F.monotonically_increasing_id()),
        max_owners, max_repositories,
    )
    one = F.struct("start", "kind", "end")
    base = F.col("value").isNotNull() & (F.col("kind") < BASE_KINDS)
    kept = F.col("value").isNotNull() & ((F.col("kind") < BASE_KINDS) | F.col("live"))
    counts = [F.count(F.when(base & (F.col("kind") == k), 1)).alias(f"n_{KINDS[k][0]}") for k in range(BASE_KINDS)]
    per_row = spans.groupBy("row_id").agg(
        F.max("doc_id").alias("doc_id"),
        *counts,
        F.count(F.when(kept & F.col("live"), 1)).alias("n_live"),
        F.count(F.when(base & ~F.col("live"), 1)).alias("n_example"),
        F.array_sort(F.collect_list(F.when(base, one))).alias("base"),
        F.array_sort(F.collect_list(F.when(kept, one))).alias("kept"),
    )
    return per_row.select(
        "doc_id", *[f"n_{KINDS[k][0]}" for k in range(BASE_KINDS)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("kept")).alias("spans"),
        "n_live", "n_example",
    )


def redact(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repository_col: str = "doc_id",
    length_col: str = "n_chars",
    max_owners: int = MAX_OWNERS,
    mark: str = MARK,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """All rows and columns of ``docs``; live-looking secrets give way to ``mark``.

    Widely copied examples stay as they are.  Spans that touch each other
    become one mark.  ``length_col``, where it exists, follows the new text of
    the changed rows; other rows are returned as they came.
    """
    digest, of_digest, steps, last = unused(docs, "digest", "of_digest", "steps", "last")
    # Equal texts have equal spans, so a text's digest stands for its rows.
    rows = _rows(
        docs, id_col, text_col, owner_col, repository_col, F.monotonically_increasing_id(), F.hex(text_digest(text_col))
    )
    spans = scan_rows(rows, max_owners, max_repositories).where("live")
    before = Window.partitionBy("row_id").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        spans.withColumn("from", F.coalesce(F.max("end").over(before), F.lit(0)))
        .groupBy("row_id", F.unhex("doc_id").alias(of_digest)).agg(
            F.array_sort(F.collect_list(F.struct("start", "from", "end"))).alias(steps), F.max("end").alias(last)
        )
        .groupBy(of_digest).agg(F.min(steps).alias(steps), F.min(last).alias(last))
    )
    t = F.col(text_col)
    pieces = F.transform(steps, lambda s: F.when(
        (s["start"] > s["from"]) | (s["from"] == 0),
        F.concat(F.substring(t, (s["from"] + 1).cast("int"), (s["start"] - s["from"]).cast("int")), F.lit(mark)),
    ).otherwise(F.lit("")))
    cleaned = F.concat(F.array_join(pieces, ""), F.substring(t, (F.col(last) + 1).cast("int"), F.length(t)))
    changed = F.col(steps).isNotNull()
    marked = docs.withColumn(digest, text_digest(text_col))
    out = marked.join(materialise(cuts, "secret-steps"), F.col(digest) == F.col(of_digest), "left")
    out = out.withColumn(text_col, F.when(changed, cleaned).otherwise(t))
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(
            length_col, F.when(changed, F.length(text_col).cast(kind)).otherwise(F.col(length_col))
        )
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
