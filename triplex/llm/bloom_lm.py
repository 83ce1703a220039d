"""Language-model scoring with a log-frequency Bloom filter (operator 2).

Counts of single tokens and of token pairs, from all training texts, are
quantised on a logarithmic scale: level ``1 + floor(log(count) / log(base))``.
An n-gram of level ``q`` is entered into the filter ``q`` times, each time
together with one of the numbers 1 to ``q``.  Its count is read back by
probing number after number until one is missing.  The filter's length is
``BITS_PER_ENTRY`` bits for each entry at every size, rounded up to a power of
two, so it answers wrongly equally rarely whatever the corpus.  Up to
``max_bits``, the proven bound of the broadcast, it is broadcast.  A longer one
never leaves the executors: its chunks are a stored table, the distinct n-grams
of bounded batches of texts are dealt to them by hash, and the levels read there
go back to their batch.  The scores are those of the same filter in one piece.

A token's probability after another mixes the two counts read back:
``mix * min(c(h, w), c(h)) / c(h) + (1 - mix) * (c(w) + 1) / (N + V + 1)``, and
the second part alone where ``h`` is unknown or missing (first token).

The exact base score of a text joins its distinct tokens with their exact
counts, which never pass through the driver.

Defined results: null and empty texts hold the end token alone; rows without
an id are training rows; repeated rows are rows of their own; an empty table
gives no rows; other columns are ignored whatever their names; a text of any
length is counted and scored whole, a bounded number of its tokens at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplex.llm.common import materialise

#: The end of a text; no word can hold white space.
END = "\n"
BITS_PER_ENTRY = 10
HASHES = 4
#: The longest filter that is broadcast.
MAX_BITS = 1 << 30
#: Base of the logarithmic count scale.
BASE = 2.0
MIX = 0.7
#: An n-gram's bits all lie in one chunk of the filter, so one task can fill it.
CHUNK_BITS = 1 << 16
#: The chunk is taken from the hash's bits from this one on (40 bits: 2^56 bits of filter).
CHUNK_SHIFT = 24
#: Entries (or rows) that a task places together, and bits of an n-gram's hash that deal it out.
PLACED_TOGETHER = 1 << 19
DEALT_BITS = 12
#: Bytes of chunks that a task fills before it hands them on.
FILLED_TOGETHER = 1 << 26
#: Of a filter too long to broadcast: chunks that one task probes together, and
#: characters of the texts whose n-grams are dealt to them together.
PROBED_CHUNKS = 128
DEALT_CHARS = 1 << 23
#: The most frequent tokens, whose exact counts are broadcast (16 bytes each).
FREQUENT = 1 << 16
#: Rows whose token hashes a task holds together while it scores.
SCORED_TOGETHER = 1024
#: Tokens that are probed together.
TOKENS_TOGETHER = 1 << 18

_PAIR = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def tokens(text: str) -> list[bytes]:
    """Words (runs of anything but ASCII white space, A-Z lower-cased), then the end."""
    words = (text or "").encode("utf-8").replace(b"\x0b", b" ").replace(b"\x0c", b" ").lower().split()
    words.append(END.encode())
    return words


def token_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words))


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring token pairs."""
    mixed = (h[:-1] * _PAIR) ^ (h[1:] + _STEP + (h[:-1] >> np.uint64(29)))
    return (mixed ^ (mixed >> np.uint64(32))) * _STEP


def level(count: np.ndarray, base: float = BASE) -> np.ndarray:
    return 1 + np.floor(np.log(count) / math.log(base) + 1e-9).astype(np.int64)


def level_count(q: np.ndarray, base: float = BASE) -> np.ndarray:
    """The count that a level stands for (0 for none): the middle of its range on the scale's lower side."""
    return np.where(q > 0, np.maximum(1.0, (base ** (q - 1.0) + base**q - 1) / 2), 0.0)


def positions(h: np.ndarray, number: int, chunks: int, hashes: int = HASHES) -> np.ndarray:
    """Places of the entry ``(h, number)`` in a filter of ``chunks`` chunks, one column per hash function."""
    x = (h + np.uint64(number * int(_PAIR) & 0xFFFFFFFFFFFFFFFF)) * _STEP
    x ^= x >> np.uint64(31)
    x *= _PAIR
    step = (x >> np.uint64(17)) | np.uint64(1)
    x ^= x >> np.uint64(29)
    inside = (x[:, None] + step[:, None] * np.arange(hashes, dtype=np.uint64)) & np.uint64(CHUNK_BITS - 1)
    chunk = (h >> np.uint64(CHUNK_SHIFT)) & np.uint64(chunks - 1)
    return inside | (chunk * np.uint64(CHUNK_BITS))[:, None]


def read_levels(filter_: np.ndarray, chunks: int, h: np.ndarray) -> np.ndarray:
    """Level of each n-gram hash: numbers are probed until one is missing."""
    out = np.zeros(len(h), np.int64)
    left, number = np.arange(len(h)), 1
    while len(left):
        at = positions(h[left], number, chunks)
        held = ((filter_[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
        left = left[held]
        out[left] = number
        number += 1
        if number > 64:
            break
    return out


def ngram_counts(texts: DataFrame) -> DataFrame:
    """``h, single, n``: hashes of single tokens and token pairs with their counts over all ``texts``.

    Rows are dealt by the bits of the hash that choose a chunk of the filter,
    so the files of the stored table each hold few chunks.
    """

    def counted(batches):
        held: list[np.ndarray] = [], []
        size = 0

        def flush():
            for single, parts in ((True, held[0]), (False, held[1])):
                if parts:
                    h, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pd.DataFrame({"h": h.view(np.int64), "single": single, "n": n.astype(np.int64)})
                parts.clear()

        for pdf in batches:
            for text in pdf["text"]:
                h = token_hashes(tokens(text))
                held[0].append(h)
                held[1].append(pair_hashes(h))
                size += len(h)
                if size > 2_000_000:  # counted so far goes on to the shuffle, memory stays bounded
                    yield from flush()
                    size = 0
        yield from flush()

    return (
        texts.select("text").mapInPandas(counted, "h long, single boolean, n long")
        .withColumn("dealt", F.shiftrightunsigned("h", CHUNK_SHIFT).bitwiseAND(F.lit((1 << DEALT_BITS) - 1).cast("long")))
        .repartition("dealt")
        .groupBy("dealt", "h", "single").agg(F.sum("n").alias("n"))
        .select("h", "single", "n")
    )


class Filter:
    """The filter's bytes with the totals that smoothing needs."""

    def __init__(self, data: np.ndarray, chunks: int, total: int, distinct: int):
        self.data, self.chunks, self.total, self.distinct = data, chunks, total, distinct

    def levels(self, h: np.ndarray) -> np.ndarray:
        return read_levels(self.data, self.chunks, h)

    def log10_scores(self, hashes: list[np.ndarray], mix: float = MIX) -> np.ndarray:
        """Scores of the texts with these token hashes, probed together a bounded number of tokens at a time."""
        out = np.zeros(len(hashes))
        held: list[tuple[int, np.ndarray, bool]] = []
        size = 0
        for i, h in enumerate(hashes):
            for at in range(0, len(h), TOKENS_TOGETHER):  # parts overlap by the token before
                part = h[max(at - 1, 0) : at + TOKENS_TOGETHER]
                held.append((i, part, at > 0))
                size += len(part)
                if size >= TOKENS_TOGETHER:
                    self._add(out, held, mix)
                    held, size = [], 0
        if held:
            self._add(out, held, mix)
        return out

    def _add(self, out: np.ndarray, held: list, mix: float) -> None:
        lengths = np.array([len(part) for _, part, _ in held])
        first = np.cumsum(lengths) - lengths
        h = np.concatenate([part for _, part, _ in held])
        distinct, where = np.unique(h, return_inverse=True)
        one = level_count(self.levels(distinct))[where]
        p = np.minimum(1.0, (one + 1) / (self.total + self.distinct + 1))
        pairs, which = np.unique(pair_hashes(h), return_inverse=True)
        pair = level_count(self.levels(pairs))[which]
        seen = one[:-1] > 0
        seen[first[1:] - 1] = False  # the pair of a text's last token with the next text's first one
        follow = np.minimum(pair, one[:-1])[seen] / one[:-1][seen]
        p[1:][seen] = mix * follow + (1 - mix) * p[1:][seen]
        p = np.log10(p)
        p[first[[goes_on for _, _, goes_on in held]]] = 0.0  # scored with the part before
        np.add.at(out, [i for i, _, _ in held], np.add.reduceat(p, first))


class ReadLevels(Filter):
    """Levels that were read elsewhere, for the n-grams of one batch of texts."""

    def __init__(self, h: np.ndarray, found: np.ndarray, total: int, distinct: int):
        super().__init__(found, 0, total, distinct)
        order = np.argsort(h, kind="stable")
        self.h, self.found = h[order], found[order]

    def levels(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where(self.h[at] == h, self.found[at], 0).astype(np.int64)


def filter_totals(counts: DataFrame, base: float = BASE) -> tuple[int, int, int]:
    """``(bits, total, distinct)``: the filter's length, and the totals that smoothing needs."""
    lev = 1 + F.floor(F.log(F.col("n").cast("double")) / math.log(base) + 1e-9)
    entries, total, distinct = counts.agg(
        F.coalesce(F.sum(lev), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("single"), F.col("n"))), F.lit(0)),
        F.count(F.when(F.col("single"), 1)),
    ).first()
    bits = max(CHUNK_BITS, 1 << max(0, int(entries) * BITS_PER_ENTRY - 1).bit_length())
    return bits, int(total), int(distinct)


def filter_chunks(counts: DataFrame, bits: int, base: float = BASE) -> DataFrame:
    """``chunk, data``: the chunks of the log-frequency filter of :func:`ngram_counts`."""
    chunks, own = bits // CHUNK_BITS, CHUNK_BITS // 8

    def place(held: dict, parts: list) -> None:
        pdf = pd.concat(parts, ignore_index=True)
        h, q = pdf["h"].to_numpy(np.int64).view(np.uint64), level(pdf["n"].to_numpy(np.int64), base)
        for number in range(1, int(q.max(initial=0)) + 1):
            at = np.sort(positions(h[q >= number], number, chunks).ravel())
            chunk = (at // np.uint64(CHUNK_BITS)).astype(np.int64)
            edges = np.flatnonzero(np.diff(chunk, prepend=-1, append=chunks))
            for lo, hi in zip(edges, edges[1:]):
                places = (at[lo:hi] & np.uint64(CHUNK_BITS - 1)).astype(np.int64)
                data = held.setdefault(int(chunk[lo]), np.zeros(own, np.uint8))
                np.bitwise_or.at(data, places >> 3, np.left_shift(1, places & 7).astype(np.uint8))

    def frame(held: dict) -> pd.DataFrame:
        return pd.DataFrame({"chunk": np.array(list(held), np.int64), "data": [d.tobytes() for d in held.values()]})

    def filled(batches):
        held: dict[int, np.ndarray] = {}
        parts: list[pd.DataFrame] = []
        for pdf in batches:
            parts.append(pdf)
            if sum(map(len, parts)) >= PLACED_TOGETHER:
                place(held, parts)
                parts = []
                if len(held) * own >= FILLED_TOGETHER:
                    yield frame(held)
                    held = {}
        if parts:
            place(held, parts)
        yield frame(held)

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        data = np.zeros(own, np.uint8)
        for piece in pdf["data"]:
            data |= np.frombuffer(piece, np.uint8)
        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "data": [data.tobytes()]})

    # A file of the counts holds few chunks, so the pieces of all tasks together
    # are about as large as the filter.
    pieces = counts.select("h", "n").mapInPandas(filled, "chunk long, data binary")
    return pieces.groupBy("chunk").applyInPandas(merged, "chunk long, data binary")


def _joined_chunks(rows, chunks: int, first: int = 0) -> np.ndarray:
    """The bytes of ``chunks`` chunks from ``first`` on; those without a row are empty."""
    own = CHUNK_BITS // 8
    data = np.zeros(chunks * own, np.uint8)
    for chunk, piece in rows:
        at = (chunk - first) * own
        data[at : at + own] = np.frombuffer(piece, np.uint8)
    return data


def build_filter(counts: DataFrame, base: float = BASE) -> Filter:
    """The whole log-frequency filter of :func:`ngram_counts`, on the driver."""
    bits, total, distinct = filter_totals(counts, base)
    return _collected(counts, bits, total, distinct, base)


def _collected(counts: DataFrame, bits: int, total: int, distinct: int, base: float = BASE) -> Filter:
    chunks = bits // CHUNK_BITS
    held = materialise(filter_chunks(counts, bits, base), "filter-chunks")  # read file by file: the driver holds the filter once
    return Filter(_joined_chunks(held.toLocalIterator(), chunks), chunks, total, distinct)


def batch_ngrams(texts, chunks: int, together: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram hashes of a batch of texts in the order of their places (``together`` chunks each), and the places."""
    hashes = [token_hashes(tokens(t)) for t in texts]
    h = np.unique(np.concatenate([*hashes, *map(pair_hashes, hashes)]))
    place = ((h >> np.uint64(CHUNK_SHIFT)) & np.uint64(chunks - 1)).astype(np.int64) // together
    order = np.argsort(place, kind="stable")
    return h[order], place[order]


def read_dealt(counts: DataFrame, bits: int, numbered: DataFrame) -> DataFrame:
    """``batch, place, levels`` (packed): the levels of all n-grams of ``numbered (batch, text, ...)``, a filter of any length.

    Nothing but bounded parts of the filter meets the bounded batches: an
    n-gram that every text holds is dealt once per batch.  Only levels come
    back; the batch knows its n-grams and their order.
    """
    chunks = bits // CHUNK_BITS
    together = min(PROBED_CHUNKS, chunks)

    def dealt(pdf: pd.DataFrame) -> pd.DataFrame:
        h, place = batch_ngrams(pdf["text"], chunks, together)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        return pd.DataFrame({
            "place": place[first], "batch": pdf["batch"].iloc[0],
            "h": [x.astype("<u8").tobytes() for x in np.split(h, first[1:])],
        })

    def probed(key, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        data = _joined_chunks(zip(held["chunk"], held["data"]), together, key[0] * together)
        found = [read_levels(data, together, np.frombuffer(x, "<u8")).astype(np.uint8).tobytes() for x in asked["h"]]
        return pd.DataFrame({"batch": asked["batch"], "place": asked["place"], "levels": found})

    asked = numbered.groupBy("batch").applyInPandas(dealt, "place long, batch long, h binary")
    held = filter_chunks(counts, bits).withColumn("place", F.expr(f"chunk div {together}"))
    return asked.groupBy("place").cogroup(held.groupBy("place")).applyInPandas(probed, "batch long, place long, levels binary")


def in_batches(rows: DataFrame, chars: int | None = None) -> DataFrame:
    """``rows`` with a ``batch``: neighbouring rows of about ``chars`` characters together."""
    chars = DEALT_CHARS if chars is None else chars

    def numbered(batches):
        batch, size = TaskContext.get().partitionId() << 40, 0
        for pdf in batches:
            numbers = []
            for n in pdf["text"].str.len():
                if size and size + n > chars:
                    batch, size = batch + 1, 0
                numbers.append(batch)
                size += int(n) + 1
            yield pdf.assign(batch=np.array(numbers, np.int64))

    return rows.mapInPandas(numbered, "row_id long, doc_id string, training boolean, text string, batch long")


def score(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``training`` is a condition on the columns of ``docs``; rows for which it
    is not true are held out.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).cast("long").cast("string").alias("doc_id"),  # text: exact in pandas
        F.coalesce(training, F.lit(True)).alias("training"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    spark = docs.sparkSession
    counts = materialise(ngram_counts(rows.where("training")), "ngram-counts")
    bits, total, distinct = filter_totals(counts)
    chunks = bits // CHUNK_BITS
    together = min(PROBED_CHUNKS, chunks)
    whole_filter = _collected(counts, bits, total, distinct) if bits <= max_bits else None
    frequent = counts.where("single").orderBy(F.desc("n"), "h").limit(FREQUENT).select("h", "n").toPandas().sort_values("h")
    held = spark.sparkContext.broadcast((whole_filter, frequent["h"].to_numpy(np.int64), frequent["n"].to_numpy(np.int64)))

    def scored_with(lm: Filter, pdf: pd.DataFrame) -> pd.DataFrame:
        _, common, uses = held.value
        logs = np.log10((uses + 1) / (total + distinct + 1))
        hashes = [token_hashes(tokens(t)) for t in pdf["text"]]
        out = []
        for whole in hashes:
            h, n = np.unique(whole.view(np.int64), return_counts=True)
            at = np.minimum(np.searchsorted(common, h), max(len(common) - 1, 0))
            found = common[at] == h if len(common) else np.zeros(len(h), bool)
            out.append((len(whole), int(n[found].sum()), float(n[found] @ logs[at[found]]), h[~found], n[~found]))
        return pd.DataFrame({
            "row_id": pdf["row_id"],
            "doc_id": pdf["doc_id"],
            "held_out": ~pdf["training"].astype(bool),
            "score": lm.log10_scores(hashes),
            "n_tokens": [o[0] for o in out],
            "common": [o[1] for o in out],
            "common_score": [o[2] for o in out],
            "h": [o[3] for o in out],
            "n": [o[4] for o in out],
        })

    def scored(batches):
        for pdf in batches:
            for at in range(0, len(pdf), SCORED_TOGETHER):
                yield scored_with(held.value[0], pdf.iloc[at : at + SCORED_TOGETHER])

    def scored_batch(pdf: pd.DataFrame, read: pd.DataFrame) -> pd.DataFrame:
        h, _ = batch_ngrams(pdf["text"], chunks, together)
        levels = np.frombuffer(b"".join(read.sort_values("place")["levels"]), np.uint8)
        return scored_with(ReadLevels(h, levels, total, distinct), pdf)

    # A token stands for itself by its 64-bit hash in the exact counts too. The
    # counts of the most frequent ones come by broadcast, those of all others by a join.
    columns = (
        "row_id long, doc_id string, held_out boolean, score double, n_tokens long, common long, common_score double, "
        "h array<long>, n array<long>"
    )
    if whole_filter is not None:
        found = rows.mapInPandas(scored, columns)
    else:
        numbered = materialise(in_batches(rows), "batched-texts")
        read = read_dealt(counts, bits, numbered)
        found = numbered.groupBy("batch").cogroup(read.groupBy("batch")).applyInPandas(scored_batch, columns)
    texts = materialise(found, "scored-texts")
    used = texts.select("row_id", F.explode(F.arrays_zip("h", "n")).alias("t")).select(
        "row_id", "t.h", F.col("t.n").cast("int").alias("uses")
    )
    known = counts.where("single").select("h", F.col("n").alias("c"))
    c = F.coalesce(F.col("c"), F.lit(0))
    sums = (
        used.join(known, "h", "left")
        .select(F.col("row_id").alias("_row"), "uses", c.alias("c"))
        .groupBy("_row").agg(
            F.sum(F.when(F.col("c") > 0, F.col("uses")).otherwise(0)).alias("rest"),
            F.sum(F.col("uses") * F.log10((F.col("c") + 1) / F.lit(float(total + distinct + 1)))).alias("rest_score"),
        )
    )
    joined = texts.drop("h", "n").join(sums, F.col("row_id") == F.col("_row"), "left")
    return joined.select(
        F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens",
        (F.col("common") + F.coalesce("rest", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("common_score") + F.coalesce("rest_score", F.lit(0.0))).alias("base_score"),
        "score",
    )
