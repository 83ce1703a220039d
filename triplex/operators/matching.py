"""Subject / object matching without a subjects x objects product.

* ``matching_triples``: a domain triple whose object text contains its own
  subject.  A triple's own (subject, object) pair is always in the
  subjects x objects product, so the product + contains + join-back form
  equals a per-row filter: O(N) instead of O(|S| * |O|).
* ``subject_as_object``: triples whose subject is referenced as an object
  id somewhere (an equi join against the distinct ids, heavy subjects split).
* ``substring_pairs``: every (distinct subject, distinct object) pair with
  ``contains(object, subject)``, exact, by an inverted index of the objects'
  grams: subjects are looked up by their rarest gram, then by equality.
* ``id_mentions``: the stricter whole-id form: the ids of the object text,
  cut at separators, equi-joined to the subjects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplex.functions.clean import clean_subject, object_id
from triplex.operators.bitmap import bitmap_of, maybe_in
from triplex.operators.domains import domain_triples
from triplex.operators.joins import HEAVY_ROWS, heavy_of_counts, lookup_join, semi_join
from triplex.operators.triples import clean_triples, drop_duplicate_triples
from triplex.schema import OBJECT, PREDICATE, SUBJECT
from triplex.session import stored

# Characters of an index gram.
GRAM = 3
# Characters of a chunk of a long text, and of a chunk of that.
CHUNKS = (1 << 20, 1 << 12)
# Bits of the bitmap of the subjects' grams; a fixed size, whatever their number.
BITMAP_BITS = 1 << 20

# --- FIXED VALUES: ids in a text ---------------------------------------------
# Characters that end an id in a text, and those that may trail one.
ID_SEPARATORS = r"""\s"'()\[\]{}<>,;!?"""
ID_TOKEN_REGEX = f"<?[^{ID_SEPARATORS}]+"
ID_TRAIL_REGEX = "[.:]+$"
# A bare id: a run of the only characters that can be part of one, up to its trailing dots.
BARE_ID_REGEX = r"[0-9A-Za-z_.]*[0-9A-Za-z_]"


def matching_rows(domain_rows: DataFrame) -> DataFrame:
    """Rows whose object contains their own subject; columns S, O, P."""
    s, o = F.col(SUBJECT), F.col(OBJECT)
    return domain_rows.where(o.contains(s)).select(SUBJECT, OBJECT, PREDICATE)


def matching_triples(cl: DataFrame, domain: str, hierarchy: DataFrame | None = None) -> DataFrame:
    """Domain triples whose object contains the subject; columns S, O, P."""
    return matching_rows(domain_triples(cl, domain, hierarchy=hierarchy))


def subject_as_object(parts: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Triples whose subject appears as an object id (``object_parts`` input).

    The id side is distinct (pre-aggregated map side).  A subject that owns
    more than ``heavy_rows`` rows is split.
    """
    ids = parts.select(F.col("object_id").alias("_id")).where(F.col("_id").isNotNull())
    triples = parts.select(SUBJECT, PREDICATE, OBJECT)
    return semi_join(triples, ids, SUBJECT, "_id", heavy_rows)


def subject_as_object_from_raw(raw: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``subject_as_object(object_parts(drop_duplicate_triples(raw)))``, its ids taken from the raw rows.

    Copies of a triple are combined map side before they meet the join, so a
    triple with a million copies reaches it once.  A hot subject is split;
    subjects are counted in the raw rows, one narrow column.
    """
    r = raw.select(SUBJECT, PREDICATE, OBJECT)
    ids = r.select(object_id(OBJECT).alias("_id"))
    keyed = drop_duplicate_triples(r).withColumn("_cs", clean_subject(SUBJECT))
    joined = semi_join(keyed, ids, "_cs", "_id", heavy_rows, counted=r.select(clean_subject(SUBJECT).alias("_cs")))
    return clean_triples(joined.select(SUBJECT, PREDICATE, OBJECT))


def _texts(df: DataFrame, column: str, name: str) -> DataFrame:
    """``_id, _text, _size`` of the distinct values of ``column``, stored once."""
    return stored(
        df.select(F.col(column).alias("_text")).where(F.col(column).isNotNull()).distinct()
        .select(F.monotonically_increasing_id().alias("_id"), "_text", F.length("_text").alias("_size")),
        name,
    )


def text_grams(texts: DataFrame, length: int, wanted: Column | None = None, chunks=CHUNKS) -> DataFrame:
    """``_id, _size, _gram, _place``: the substrings of ``length`` characters of ``texts`` at every place.

    Long texts are cut in overlapping chunks, and those again, so no row holds
    more grams than a small chunk.  One pattern takes a chunk's grams in one
    pass.  Where ``wanted`` (a scalar) is not true, no gram is taken at all.
    """
    part, n = F.col("_part"), F.col("_n")
    rows = texts.where(F.col("_size") >= length).select(
        "_id", "_size", F.col("_text").alias("_part"), F.lit(0).alias("_from"), (F.col("_size") - (length - 1)).alias("_n")
    )

    def pieces(size: int):
        return F.transform(F.sequence(F.lit(0), ((n - 1) / size).cast("int")), lambda i: F.struct(
            part.substr(i * size + 1, F.lit(size + length - 1)).alias("part"),
            (F.col("_from") + i * size).alias("from"),
            F.least(n - i * size, F.lit(size)).alias("n"),  # places that start in this piece
        ))

    for size in chunks:
        whole = F.array(F.struct(part.alias("part"), F.col("_from").alias("from"), n.alias("n")))
        rows = rows.select("_id", "_size", F.explode(F.when(n <= size, whole).otherwise(pieces(size))).alias("p")).select(
            "_id", "_size", F.col("p.part").alias("_part"), F.col("p.from").alias("_from"), F.col("p.n").alias("_n")
        )
    grams = _grams_of(part, length)
    if wanted is not None:
        grams = F.when(wanted, grams)
    return rows.select("_id", "_size", "_from", F.posexplode(grams).alias("_at", "_gram")).select(
        "_id", "_size", "_gram", (F.col("_from") + F.col("_at")).alias("_place")
    )


def _all_grams(texts: DataFrame, subjects: DataFrame) -> DataFrame:
    """The grams of ``GRAM`` characters of all texts, and shorter ones if there are subjects that short."""
    out = text_grams(texts, GRAM)
    for length in range(1, GRAM):
        any_so_short = subjects.agg(F.coalesce(F.bool_or(F.col("_size") == length), F.lit(False)).alias("any")).scalar()
        out = out.unionByName(text_grams(texts, length, any_so_short))
    return out


def _grams_of(part: Column, length: int) -> Column:
    """The grams of a text, in order: each match takes one character and looks at the gram that starts with it."""
    return F.regexp_extract_all(part, F.lit(f"(?s)(?=(.{{{length}}}))."), F.lit(1))


def rarest_grams(subjects: DataFrame, counts: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``_id, _gram, _place, _uses, _text``: each subject's gram with the smallest count.

    A subject with a gram that is not counted occurs in no object and goes.
    Only numbers are kept per subject, in place; its gram is cut from its text.
    """
    short = subjects.where((F.col("_size") > 0) & (F.col("_size") < GRAM)).select(
        "_id", "_size", F.col("_text").alias("_gram"), F.lit(0).alias("_place")
    )
    own = text_grams(subjects, GRAM).unionByName(short)
    counted = lookup_join(own, counts, "_gram", "_gram", "left", heavy_rows)
    uses = F.coalesce("_uses", F.lit(0))
    best = counted.groupBy("_id").agg(F.min(uses).alias("_uses"), F.min_by("_place", uses).alias("_place")).where("_uses > 0")
    gram = F.col("_text").substr(F.col("_place") + 1, F.lit(GRAM))
    return best.join(subjects.select("_id", "_text"), "_id").select("_id", gram.alias("_gram"), "_place", "_uses", "_text")


def substring_pairs(cl: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """All distinct (Subject, Object) with ``contains(Object, Subject)``, by an inverted index of grams.

    1. The grams (substrings of ``GRAM`` characters) of all objects are counted.
    2. Each subject is keyed by its rarest gram; its shape is the gram's place
       in it and its length.  Subjects with a gram that occurs nowhere go.
    3. Objects emit their grams with their places.  Joined with the shapes of
       a gram these are all spans that a subject could fill, as numbers only.
    4. The spans are cut from the objects and joined to the subjects by equality.

    Nothing is listed on the driver and no number of subjects, lengths or
    prefixes is too large.  Grams and substrings that occur very often are
    split in their joins.  A subject shorter than a gram is its own gram; the
    empty one is in every object.
    """
    objects, subjects = _texts(cl, OBJECT, "objects"), _texts(cl, SUBJECT, "subjects")
    grams = _all_grams(objects, subjects)
    counts = stored(grams.groupBy("_gram").agg(F.count(F.lit(1)).alias("_uses")), "gram-counts")
    keyed = stored(rarest_grams(subjects, counts, heavy_rows), "subject-grams")
    shapes = keyed.select("_gram", F.col("_place").alias("_offset"), F.length("_text").alias("_length")).distinct()
    uses = keyed.select(F.xxhash64("_gram").alias("__hash"), F.col("_uses").alias("__n")).distinct()
    start = F.col("_place") - F.col("_offset")
    near = grams.where(maybe_in(bitmap_of(keyed, "_gram", BITMAP_BITS), F.col("_gram"), BITMAP_BITS))
    spans = (
        lookup_join(near, shapes, "_gram", "_gram", heavy=heavy_of_counts(uses, heavy_rows))
        .where((start >= 0) & (start + F.col("_length") <= F.col("_size")))
        .select("_id", start.alias("_start"), "_length").distinct()
    )
    texts = objects.select("_id", "_text")
    cut = spans.join(texts, "_id").select("_id", F.col("_text").substr(F.col("_start") + 1, F.col("_length")).alias("_sub")).distinct()
    hits = semi_join(cut, keyed, "_sub", "_text", heavy_rows)
    found = hits.join(texts, "_id").select(F.col("_sub").alias(SUBJECT), F.col("_text").alias(OBJECT))
    # One row at most, the empty subject.
    empty = F.broadcast(subjects.where("_size = 0").select(F.col("_text").alias(SUBJECT)).limit(1))
    none = F.col("_text").substr(1, 0)  # a key of each row, so that the join is one by equality
    in_all = objects.select(F.col("_text").alias(OBJECT), none.alias("_none")).join(
        empty, F.col("_none") == F.col(SUBJECT)
    ).select(SUBJECT, OBJECT)
    return found.unionByName(in_all)


def id_mentions(cl: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Distinct (Subject, Object) where the object mentions the subject as a whole id.

    A text's ids are its runs of characters other than white space, quotes,
    brackets and ``,;!?``, without trailing dots and colons; an id right after
    ``<`` also counts with that ``<`` (the cleaned form of a foreign URI).
    Beside these, bare ids end at every character that is no letter, digit,
    ``_`` or dot, so ``ns/m.1|m.2`` and ``id=m.9`` mention them.  ``m.9.q``
    mentions ``m.9.q`` and not ``m.9``.  Any subject of these shapes can be
    mentioned, whatever its prefix.
    """
    subjects = cl.select(SUBJECT).where(F.col(SUBJECT).isNotNull())
    objects = cl.select(OBJECT).where(F.col(OBJECT).isNotNull()).distinct()
    found = F.transform(
        F.regexp_extract_all(OBJECT, F.lit(ID_TOKEN_REGEX), 0), lambda x: F.regexp_replace(x, ID_TRAIL_REGEX, "")
    )
    bare = F.transform(found, lambda x: F.ltrim(x, F.lit("<")))
    cut = F.regexp_extract_all(OBJECT, F.lit(BARE_ID_REGEX), 0)
    ids = objects.select(OBJECT, F.explode(F.array_distinct(F.concat(found, bare, cut))).alias("_id")).where(
        ~F.col("_id").isin("", "<")
    )
    return semi_join(ids, subjects, "_id", SUBJECT, heavy_rows).select(
        F.col("_id").alias(SUBJECT), OBJECT
    )
