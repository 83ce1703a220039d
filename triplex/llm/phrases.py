"""Document fingerprints by locally consistent parsing (operator 12).

A text is parsed bottom-up into phrases.  On each level

1. a run of one repeated symbol becomes one symbol with its length, so
   neighbours differ;
2. deterministic coin tossing labels every symbol by the lowest bit in which it
   differs from its left neighbour, and that bit's value; neighbours keep
   different labels.  Four rounds bring 64-bit symbols down to six labels;
3. a phrase starts wherever a label is larger than both its neighbours, so it
   has two symbols at least and a bounded number at most;
4. a phrase is named by a 64-bit hash of its symbols.  The names are the
   symbols of the next level.

Where a phrase starts depends on a few symbols around it only, never on the
place in the text, so equal substrings get the same names inside, whatever
stands before them.  The last name stands for the whole text.

The fingerprint is that name and a sketch of all phrase names: the ``SIZE``
smallest ranks, where a name's rank is a part of its hash, times 16 for the
names of the first level (three letters or so, which most texts share).  Each
occurrence of a name has a rank of its own, so a passage that fills a text
counts for as much as it fills.  Two fingerprints' likeness is the share of
ranks that both have (2 j / (1 + j), j the Jaccard likeness estimated from the
smallest ranks of both).

To set a document's text beside the next one's, rows are dealt out by range of
descending id and read in order; only the first and last row of each partition
meet in a second, small step.

Defined results: a null text counts as empty; an empty one has the name zero
and no ranks, is like another empty one (1) and like nothing else (0); ids
descend, rows without an id come last, rows that share an id go by their
text's digest; repeated rows are rows of their own; a table of one row is its
own next; an empty table gives no rows; other columns are ignored whatever
their names; a text is parsed whole, in slices, with some 40 bytes of memory a
character.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplex.llm.common import materialise

#: Ranks of a sketch.
SIZE = 64
#: Factor of the ranks of first-level names: they are that much rarer in a sketch.
FIRST_LEVEL = 16
#: Characters that are parsed together, and symbols of a slice.
BATCH = 1 << 16

# Odd multipliers of the hash.
_SYMBOL, _RUN, _PLACE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_RANK_SHIFT = np.uint64(64 - 28)  # a rank has 28 bits, four more on the first level
_RANK, _DOC = np.uint64(2**32 - 1), np.uint64(2**64 - 2**32)

Sketch = tuple[int, np.ndarray]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing, in place."""
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def _coin_table() -> np.ndarray:
    """Label of a small symbol from its left neighbour's and its own value (128 each)."""
    left, own = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    apart = left ^ own
    bit = np.bitwise_count((apart & -apart) - 1).astype(np.int64) * (apart > 0)
    return (2 * bit + ((own >> bit) & 1)).astype(np.uint8).ravel()


_COIN = _coin_table()


def labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0 to 5 of symbols that differ from their neighbours; ``first`` marks the start of each text."""
    out = np.empty(len(symbols), np.uint8)
    for lo in range(0, len(symbols), BATCH):
        start, stop = max(0, lo - 4), min(len(symbols), lo + BATCH)  # each round looks one symbol to the left
        own, head = symbols[start:stop], first[start:stop].copy()
        head[0] = True
        apart = np.empty_like(own)
        apart[1:] = own[1:] ^ own[:-1]
        apart[head] = 1
        bit = np.bitwise_count((apart & (~apart + np.uint64(1))) - np.uint64(1))
        label = 2 * bit + ((own >> bit) & np.uint64(1)).astype(np.uint8)
        for _ in range(3):
            left = np.empty_like(label)
            left[1:] = label[:-1]
            left[head] = label[head] ^ 1
            label = _COIN[(left.astype(np.uint16) << 7) | label]
        out[lo:stop] = label[lo - start :]
    return out


def phrase_starts(label: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places where phrases start: at each text's start and at local maxima two symbols or more from its ends."""
    peak = first.copy()
    if len(label) > 2:
        inner = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
        inner &= ~(first[1:-1] | first[:-2] | first[2:])
        peak[1:-1] |= inner
    return np.flatnonzero(peak)


def phrase_names(symbols: np.ndarray, runs: np.ndarray, starts: np.ndarray, level: int) -> np.ndarray:
    """The names of the phrases that begin at ``starts``."""
    names = np.empty(len(starts), np.uint64)
    stops = np.append(starts[1:], len(symbols))
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(stops, starts[at] + BATCH, side="right")))
        a, b = starts[at], stops[end - 1]
        own = starts[at:end] - a
        place = np.arange(b - a, dtype=np.int64) - np.repeat(own, stops[at:end] - starts[at:end])
        x = symbols[a:b] * _SYMBOL
        x += runs[a:b].astype(np.uint64) * _RUN
        x += place.astype(np.uint64) * _PLACE
        names[at:end] = np.add.reduceat(_mixed(x), own)
        at = end
    names += np.uint64(level * int(_PLACE) % 2**64)
    return _mixed(names)


def _counted(key: np.ndarray) -> np.ndarray:
    """Sorted keys (text, rank); the second, third, ... occurrence of a name gets a rank of its own."""
    key = np.sort(key)
    place = np.arange(len(key))
    again = np.flatnonzero(key[1:] == key[:-1]) + 1
    if len(again):
        begins = np.ones(len(key), bool)
        begins[again] = False
        number = (place - np.maximum.accumulate(np.where(begins, place, 0)))[again].astype(np.uint64)
        repeated = key[again]
        key[again] = (repeated & _DOC) | (_mixed((repeated & _RANK) * _SYMBOL + number * _RUN) >> _RANK_SHIFT)
    return key


def sketches(texts: list[str]) -> list[Sketch]:
    """``(name of the whole text, its smallest ranks in order)`` of each text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    tops, keys = np.zeros(len(texts), np.uint64), []
    doc = np.flatnonzero(lengths)  # texts that are still parsed
    begin = (np.cumsum(lengths) - lengths)[doc]
    symbols = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    level = 0
    while len(doc):
        level += 1
        first = np.zeros(len(symbols), bool)
        first[begin] = True
        new = first.copy()
        new[1:] |= symbols[1:] != symbols[:-1]
        at = np.flatnonzero(new)
        runs = np.diff(at, append=len(symbols)).astype(np.uint32)
        symbols, first, begin = symbols[at], first[at], np.searchsorted(at, begin)
        del new, at
        starts = phrase_starts(labels(symbols, first), first)
        symbols = phrase_names(symbols, runs, starts, level)
        begin = np.searchsorted(starts, begin)
        count = np.diff(begin, append=len(symbols))
        key = _counted((np.repeat(doc, count).astype(np.uint64) << np.uint64(32)) | (symbols >> _RANK_SHIFT))
        if level == 1:
            key = (key & _DOC) | ((key & _RANK) * np.uint64(FIRST_LEVEL))
        keys.append(key)
        done = count == 1
        tops[doc[done]] = symbols[begin[done]]
        stay = np.repeat(~done, count)
        symbols, doc, count = symbols[stay], doc[~done], count[~done]
        begin = np.cumsum(count) - count
    found = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)
    found = found[np.append(True, found[1:] != found[:-1])[: len(found)]]
    edges = np.searchsorted(found, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(32))
    ranks = (found & _RANK).astype(np.uint32)
    return [(int(t), ranks[a : min(b, a + SIZE)]) for t, a, b in zip(tops, edges, edges[1:])]


def likeness(a: Sketch, b: Sketch) -> float:
    """Share of phrases that two fingerprints have in common, 0 to 1."""
    if a[0] == b[0]:
        return 1.0
    one, two = set(a[1].tolist()), set(b[1].tolist())
    both = one & two
    if not both:
        return 0.0
    smallest = sorted(one | two)[:SIZE]
    j = sum(x in both for x in smallest) / len(smallest)
    return 2 * j / (1 + j)


def to_bytes(sketch: Sketch) -> bytes:
    return sketch[0].to_bytes(8, "big") + sketch[1].astype(">u4").tobytes()


def from_bytes(data: bytes) -> Sketch:
    return int.from_bytes(data[:8], "big"), np.frombuffer(data, ">u4", offset=8).astype(np.uint32)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many characters of the start of ``following``."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def _batched(rows, batch: int):
    """Lists of rows ``(id, text)`` of about ``batch`` characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= batch or len(held) >= 4096:
            yield held
            held, size = [], 0
    if held:
        yield held


_PAIR = (
    "doc_id string, n_chars long, edited_digest binary, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)
_COLUMNS = ["doc_id", "n_chars", "edited_digest", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _pairs(rows: list[tuple[str | None, str, Sketch, str, Sketch]]) -> list[tuple]:
    """The result of rows ``(id, text, sketch, next text, next sketch)``."""
    changed = [edited(text, following) for _, text, _, following, _ in rows]
    out = []
    for (doc_id, text, own, _, other), new, sketch in zip(rows, changed, sketches(changed)):
        digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).digest()
        out.append((
            doc_id, len(text), digest, to_bytes(own), to_bytes(sketch), likeness(own, sketch), likeness(own, other),
        ))
    return out


def _in_order(batch: int):
    """A partition's rows beside their neighbours; its first row (edge 1) and last row (edge 2) come with their texts."""
    names = [*_COLUMNS, "part", "edge", "text"]

    def compared(batches):
        part = TaskContext.get().partitionId()

        def edge(row, kind: int) -> tuple:
            doc_id, text, own = row
            return doc_id, len(text), None, to_bytes(own), None, None, None, part, kind, text

        last = None
        for held in _batched((row for pdf in batches for row in zip(pdf["doc_id"], pdf["text"])), batch):
            seen = [(i, t, s) for (i, t), s in zip(held, sketches([t for _, t in held]))]
            out = []
            if last is None:
                out.append(edge(seen[0], 1))
            else:
                seen.insert(0, last)
            pairs = [(*a, *b[1:]) for a, b in zip(seen, seen[1:])]
            out += [(*r, part, 0, None) for r in _pairs(pairs)]
            last = seen[-1]
            yield pd.DataFrame(out, columns=names)
        if last is not None:
            yield pd.DataFrame([edge(last, 2)], columns=names)

    return compared


def _over_edges(batches):
    for pdf in batches:
        rows = [
            (i, t, from_bytes(a), u, from_bytes(b))
            for i, t, a, u, b in zip(pdf["doc_id"], pdf["text"], pdf["fingerprint"], pdf["next_text"], pdf["next_print"])
        ]
        yield pd.DataFrame(_pairs(rows), columns=_COLUMNS)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row: the name of the text and its ranks, as bytes."""

    def found(batches):
        for pdf in batches:
            for held in _batched(zip(pdf["doc_id"], pdf["text"]), BATCH):
                prints = [to_bytes(s) for s in sketches([t for _, t in held])]
                yield pd.DataFrame({"doc_id": [i for i, _ in held], "fingerprint": prints})

    rows = docs.select(
        F.col(id_col).cast("string").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    return rows.mapInPandas(found, "doc_id string, fingerprint binary").select(
        F.col("doc_id").cast("long").alias("doc_id"), "fingerprint"
    )


def compare_neighbours(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: int = BATCH
) -> DataFrame:
    """Every row's fingerprint beside that of its edited text and of the next row.

    ``doc_id, n_chars, edited_digest, fingerprint, edited_fingerprint,
    near_edited, near_next``; the next row is the one that follows by
    descending id (after the last: the first).
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).select("*", F.unhex(F.sha2("text", 256)).alias("digest"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").desc_nulls_last(), "digest", "row"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    done = materialise(
        dealt.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(
            _in_order(batch), f"{_PAIR}, part int, edge int, text string"
        ),
        "phrase-neighbours", compression="zstd",  # ranks are small numbers in order
    )
    inner = done.where("edge = 0").select(*_COLUMNS)
    heads = done.where("edge = 1").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print")
    )
    # One number for each partition that has rows: which one comes next, the first one after the last.
    turn = done.where("edge = 2").select("part").select(
        "part",
        F.coalesce(
            F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.orderBy("part"))
        ).alias("next_part"),
    )
    tails = done.where("edge = 2").select("part", "doc_id", "text", "fingerprint")
    outer = tails.join(turn, "part").join(heads, "next_part").mapInPandas(_over_edges, _PAIR)
    return inner.unionByName(outer).withColumn("doc_id", F.col("doc_id").cast("long"))
