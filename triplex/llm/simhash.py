"""SimHash near-duplicates through pivot distance tables (operator 1).

1. Each text becomes a 64-bit fingerprint of its word shingles.
2. For each distinct fingerprint the Hamming distances to ``PIVOTS`` reference
   fingerprints are computed once and stored: its row of the pivot table.
3. A table of distances alone would have to hold every pair against every
   other.  Pairs are therefore formed only where they can be near: the bits
   are cut into ``bits + 3`` blocks, and two fingerprints that differ in at
   most ``bits`` of them agree on at least three whole blocks, whichever they
   are.  With three differing bits that is one key of about 32 bits for each
   of the 20 choices of three out of six blocks.  No link is lost.
4. Among fingerprints that share a key, a pair is discarded when any
   coordinate of their table rows differs by more than ``bits`` (by the
   triangle inequality it cannot be near); survivors are verified on the bits.
   The same coordinates deal out a bucket that is too large for one task:
   fingerprints meet only in equal or neighbouring cells of the pivot space.
5. A bucket reports its links as trees (one row per linked fingerprint, not
   one per pair); alternating large-star and small-star steps over tables in
   the shared folder turn the links of all buckets into components.

Copies meet only as one fingerprint row, so a group of copies of any size
costs one row per copy.  Nothing is collected to the driver.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; a text of fewer words than a shingle is one shingle; repeated
rows are rows of their own; an empty table gives no rows; other columns are
ignored whatever their names; a text of any length is hashed whole, in the
memory of one task (some 20 bytes a word).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplex.llm.common import id_and_text, keep_decided, long_ids, materialise, text_digest

#: Reference fingerprints of the pivot table (eight distances fill one long).
PIVOTS = 16
#: Fingerprints of a bucket that are compared in one task; larger buckets are dealt out by
#: the cells of so many pivot distances.
MAX_BUCKET = 1 << 15
CELL_PIVOTS = 4
SEED = 42


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit ``hashes`` have each bit set, bit 0 first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65280):
        part = hashes[at : at + 65280]
        rows = -(-len(part) // 255) * 255  # sums of 255 bits fit a byte
        padded = np.zeros(rows, np.uint64)
        padded[: len(part)] = part
        bits = np.unpackbits(padded.view(np.uint8), bitorder="little").reshape(-1, 255, 64)
        total += bits.sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a text (0 without words).

    ASCII letters are lower-cased; words are runs of anything but ASCII white
    space; a bit is set when more than half of the shingle hashes have it.
    """
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    starts = np.zeros(len(words), np.int64)
    np.cumsum(np.fromiter(map(len, words[:-1]), np.int64, len(words) - 1) + 1, out=starts[1:])
    begin = starts[: len(words) - shingle + 1].tolist()
    end = (starts[shingle:] - 1).tolist() + [len(line)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(begin, end)], np.uint64)
    set_bits = _bit_counts(hashes) * 2 > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", with_digest: bool = False) -> DataFrame:
    """``(doc_id, fp)`` of every row, and its text's ``digest`` if wanted; ``fp`` holds the 64 bits as a signed long."""

    def hashed(batches):
        for pdf in batches:
            fps = np.array([fingerprint(t, shingle) for t in pdf.pop("text")], np.uint64)
            yield pdf.assign(fp=fps.view(np.int64))

    rows = id_and_text(docs, id_col, text_col)
    if not with_digest:
        return long_ids(rows.mapInPandas(hashed, "doc_id string, fp long"))
    rows = rows.select("doc_id", text_digest("text").alias("digest"), "text")
    return long_ids(rows.mapInPandas(hashed, "doc_id string, digest binary, fp long"))


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def pivot_table(fps: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """``fps`` with the distances to the reference fingerprints, a byte each, eight to a long ``t0, t1, ...``."""
    references = [_signed(xxhash.xxh64_intdigest(b"pivot %d" % i, SEED)) for i in range(pivots)]
    packed = []
    for at in range(0, pivots, 8):
        word = F.lit(0).cast("long")
        for i, ref in enumerate(references[at : at + 8]):
            distance = F.bit_count(F.col("fp").bitwiseXOR(F.lit(ref).cast("long"))).cast("long")
            word = word.bitwiseOR(F.shiftleft(distance, 8 * i))
        packed.append(word.alias(f"t{at // 8}"))
    return fps.select("*", *packed)


def block_masks(bits: int) -> list[int]:
    """Masks of every choice of three out of ``bits + 3`` blocks of the 64 bits."""
    edges = np.linspace(0, 64, bits + 4).round().astype(int).tolist()
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [_signed(a | b | c) for a, b, c in combinations(blocks, 3)]


def _union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the sets of rows ``i`` and ``j`` in place; a label is the smallest row of its set."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def bucket_links(bucket: np.ndarray, fp: np.ndarray, table: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal ``bucket``, as trees: arrays of fingerprints and their tree's first one.

    All pairs at the same offset are handled together; a pair already in one
    tree needs no further look.
    """
    label = np.arange(len(bucket))
    step, left = 1, np.flatnonzero(bucket[:-1] == bucket[1:])
    while len(left):
        i, j = left, left + step
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
        close = np.abs(table[i] - table[j]).max(axis=1, initial=0) <= bits  # pivot filter
        i, j = i[close], j[close]
        near = np.bitwise_count(fp[i] ^ fp[j]) <= bits  # verification
        _union(label, i[near], j[near])
        step += 1
        left = left[left + step < len(bucket)]
        left = left[bucket[left] == bucket[left + step]]
        if step & (step - 1) == 0 and len(left):  # now and then: buckets that are one tree already are done
            begins = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
            low, high = np.minimum.reduceat(label, begins), np.maximum.reduceat(label, begins)
            left = left[(low != high)[np.searchsorted(begins, left, side="right") - 1]]
    linked = np.flatnonzero(label != np.arange(len(label)))
    return fp[linked], fp[label[linked]]


def pivot_cells(bits: int, word: str = "t0") -> list[F.Column]:
    """The cells of the pivot space that a fingerprint is compared in, by its first ``CELL_PIVOTS`` distances.

    A distance lies in the cell ``floor(distance / (bits + 1))``.  Near
    fingerprints differ by ``bits`` at most in each distance, so their cells
    are the same or neighbours; each goes to its own and the next cell of each
    distance, and any two near ones meet in the higher of their cells.
    """
    cells = []
    for choice in range(1 << CELL_PIVOTS):
        cell = F.lit(0).cast("long")
        for i in range(CELL_PIVOTS):
            distance = F.shiftrightunsigned(word, 8 * i).bitwiseAND(F.lit(255).cast("long"))
            own = F.floor(distance / (bits + 1)).cast("long") + (choice >> i & 1)
            cell = cell.bitwiseOR(F.shiftleft(own, 8 * i))
        cells.append(cell)
    return cells


def links(fps: DataFrame, bits: int = 3, pivots: int = PIVOTS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``(u, v)`` with ``u > v``: links that join all distinct ``fp`` within ``bits`` of each other.

    A bucket of more than ``max_bucket`` fingerprints is dealt out by the cells
    of its pivot distances, so no task holds it whole.
    """
    words = [f"t{i}" for i in range(-(-pivots // 8))]
    keys = [
        F.struct(F.lit(i).cast("short").alias("choice"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("part"))
        for i, m in enumerate(block_masks(bits))
    ]
    rows = (
        pivot_table(fps.select("fp"), pivots)
        .select("fp", *words, F.explode(F.array(*keys)).alias("k"))
        .select("k.choice", "k.part", "fp", *words)
    )
    hot = materialise(
        rows.groupBy("choice", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_bucket)
        .select("choice", "part", F.lit(True).alias("hot")),
        "hot-buckets",
    )
    whole = F.array(F.lit(0).cast("long"))
    if hot.take(1):
        cells = F.explode(F.when(F.col("hot"), F.array(*pivot_cells(bits))).otherwise(whole))
        rows = rows.join(hot, ["choice", "part"], "left").select("choice", "part", cells.alias("cell"), "fp", *words)
    else:
        rows = rows.select("choice", "part", whole[0].alias("cell"), "fp", *words)
    names = ["choice", "part", "cell"]
    rows = rows.repartition(*names).sortWithinPartitions(*names, "fp")

    def report(parts: list[pd.DataFrame]) -> pd.DataFrame:
        pdf = pd.concat(parts, ignore_index=True)
        keys = [pdf[name].to_numpy() for name in names]
        bucket = np.cumsum(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
        packed = np.ascontiguousarray(pdf[words].to_numpy(np.int64))
        table = packed.view(np.int8).reshape(len(pdf), -1).astype(np.int16)
        u, v = bucket_links(bucket, pdf["fp"].to_numpy().view(np.uint64), table, bits)
        u, v = u.view(np.int64), v.view(np.int64)
        return pd.DataFrame({"u": np.maximum(u, v), "v": np.minimum(u, v)})

    def linked(batches):
        held: list[pd.DataFrame] = []  # rows whose bucket may go on in the next batch
        for pdf in batches:
            if not len(pdf):
                continue
            last = np.all([pdf[name].to_numpy() == pdf[name].iloc[-1] for name in names], axis=0)
            cut = int((~last).nonzero()[0].max(initial=-1)) + 1
            goes_on = bool(held) and all(held[-1][name].iloc[-1] == pdf[name].iloc[-1] for name in names)
            if cut == 0 and (goes_on or not held):
                held.append(pdf)
                continue
            yield report([*held, pdf.iloc[:cut]])
            held = [pdf.iloc[cut:]]
        if held:
            yield report(held)

    return rows.mapInPandas(linked, "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of undirected ``edges (u, v)``; the root is its component's smallest node.

    Alternating large-star and small-star steps; each half step is a table in
    the shared folder, so a lost executor costs one step.  The minimum of a
    hub's neighbours is combined before the shuffle, and the joins read two
    stored tables, so adaptive execution can split a hub's rows.
    """
    e = materialise(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = e.join(low.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v"))
        e = materialise(large.where("u <> v").distinct(), "large-star")
        low = materialise(e.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = materialise(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "small-star")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    bits: int = 3,
    pivots: int = PIVOTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row; rows are linked at ``bits`` or fewer differing bits."""
    rows = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    fps = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    linked = materialise(components(links(fps, bits, pivots)), "components")
    lowest = materialise(
        linked.join(fps, linked["node"] == fps["fp"]).groupBy("root").agg(F.min("first_id").alias("component_id")),
        "component-ids",
    )
    of_node = linked.join(lowest, "root").select(F.col("node").alias("fp"), "component_id")
    classes = materialise(
        fps.join(of_node, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id")),
        "classes",
    )
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, all columns, with one row of each component.

    It is the row with the smallest id; a row without an id stays only if no
    row of its component has one, among rows that share an id the one with
    the smallest text digest stays, and of repeated rows one.
    """
    rows = materialise(
        fingerprints(docs, shingle, id_col, text_col, with_digest=True)
        .groupBy("doc_id", "digest", "fp").agg(F.count(F.lit(1)).alias("n")),
        "near-copy-rows",
    )
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    fps = materialise(rows.groupBy("fp").agg(F.min(first).alias("first")), "distinct-fingerprints")
    linked = materialise(components(links(fps, bits)), "components")
    firsts = (
        fps.join(linked, fps["fp"] == linked["node"], "left")
        .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
        .select(F.col("first.doc_id").alias("first_id"), F.col("first.digest").alias("first_digest"))
    )
    # One row of a component is the first of all; every other one goes.
    stays = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("first_digest"))
    decided = rows.join(materialise(firsts, "kept-rows"), stays, "left").select(
        "doc_id", "digest", "n", F.col("first_digest").isNotNull().alias("kept")
    )
    return keep_decided(docs, decided, id_col, text_col)
