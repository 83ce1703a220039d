"""Byte-level BPE encoding and decoding by overlapping chunks (operator 7).

A text longer than one chunk is cut into chunks that overlap; every chunk is
a row, so the chunks of one long text are pre-tokenised in parallel.  A chunk
starts inside an unknown pre-token, so its first boundaries may be wrong and
its last one may be cut short.  Where two neighbouring chunks share a boundary
in their overlap that holds on its own (see :func:`is_sure`), they are in step
again: there the text is stitched.  Chunks that share none (one pre-token
spans the overlap) are joined into one piece.  The
pieces are then encoded, each pre-token separately, again in parallel, and
their ids put together in order.  Decoding concatenates the raw bytes of ids.

Defined results: null and empty texts have no ids and decode to no bytes;
repeated rows are rows of their own; an empty table gives no rows; other
columns are ignored whatever their names; nothing is cut off, however long.
"""

from __future__ import annotations

import hashlib
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplex.llm.common import id_and_text, long_ids
from triplex.llm.packing import encode_plain, rank_encoder

#: Characters of a chunk beyond its overlap, and of the overlap.
CHUNK = 32768
OVERLAP = 256


def chunk_starts(length: int, chunk: int) -> range:
    return range(0, max(length, 1), chunk)


def boundaries(text: str, offset: int, pattern: str, last: bool) -> list[int]:
    """Ends of the pre-tokens of a chunk, as places in the whole text.

    Unless the chunk is the last one, its last two pre-tokens may differ from
    those of the whole text (they may go on, or see what follows), so their
    ends are left out.
    """
    import regex

    ends = [offset + m.end() for m in regex.finditer(pattern, text)]
    return ends if last else ends[:-2]


_SPACES = " \t\r\n"


@lru_cache(maxsize=1 << 16)
def _kind(char: str) -> str:
    """``L`` letter, ``N`` number, ``S`` white space, ``O`` other; ``?`` where versions of Unicode might not agree."""
    if char.isspace():
        return "S" if char in _SPACES else "?"
    old, new = unicodedata.ucd_3_2_0.category(char)[0], unicodedata.category(char)[0]
    return "?" if old != new or new == "C" else new if new in "LN" else "O"


def is_sure(text: str, at: int) -> bool:
    """True where a pre-token ends whatever stands before, and where both sides are split as if alone.

    That is so between letters, numbers and other characters (but behind an
    apostrophe, which can take letters along), at white space behind anything
    else, and before the last character of a run of white space that something
    follows.  It is not at the end of such a run: the pattern looks ahead there.
    """
    if not 0 < at < len(text):
        return False
    left, right = _kind(text[at - 1]), _kind(text[at])
    if "?" in (left, right):
        return False
    if left == "S":
        return right == "S" and at + 1 < len(text) and not text[at + 1].isspace()
    return left != right and text[at - 1] != "'"


def stitch(chunks: list[tuple[list[int], list[int]]]) -> list[int]:
    """Places where pieces start, from each chunk's ``(head, sure)`` in order.

    ``sure`` are a chunk's sure boundaries in its overlap with the next chunk,
    ``head`` its boundaries in its overlap with the chunk before.  At the first
    one that both have the text is cut; without one the two chunks stay one piece.
    """
    cuts = [0]
    for (_, sure), (head, _) in zip(chunks, chunks[1:]):
        cuts += sorted(set(head) & set(sure))[:1]
    return cuts


def _digest(ids: list[int]) -> str:
    return hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def _encoded(path: str, pattern: str, digests: bool, rows, columns: list[str]) -> pd.DataFrame:
    """Rows ``(*keys, ids)`` as a frame, with ids as bytes or as the digests of ids and decoded bytes."""
    coder = rank_encoder(path, pattern)
    out = []
    for *keys, ids in rows:
        if digests:
            whole = coder.decode_bytes(ids)
            out.append((*keys, len(ids), _digest(ids), hashlib.sha256(whole).hexdigest()))
        else:
            out.append((*keys, len(ids), np.array(ids, "<u4").tobytes(), coder.decode_bytes(ids)))
    return pd.DataFrame(out, columns=columns)


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    digests: bool = False,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every row.

    ``ids`` are little-endian 32-bit ids and ``decoded`` the bytes they stand
    for; with ``digests`` both columns are hex SHA-256 strings instead (of the
    decimal ids joined by one space, and of the bytes).
    """
    values = "n_tokens long, ids string, decoded string" if digests else "n_tokens long, ids binary, decoded binary"
    names = ["n_tokens", "ids", "decoded"]
    texts = id_and_text(docs, id_col, text_col)

    def whole_texts(batches):
        coder = rank_encoder(path, pattern)
        for pdf in batches:
            rows = ((i, encode_plain(coder, t)) for i, t in zip(pdf["doc_id"], pdf["text"]))
            yield _encoded(path, pattern, digests, rows, ["doc_id", *names])

    short = texts.where(F.length("text") <= chunk).mapInPandas(whole_texts, f"doc_id string, {values}")

    def cut(batches):
        for pdf in batches:
            for row_id, doc_id, text in zip(pdf["row_id"], pdf["doc_id"], pdf["text"]):
                starts = chunk_starts(len(text), chunk)
                yield pd.DataFrame({
                    "row_id": row_id,
                    "doc_id": doc_id,
                    "n": np.arange(len(starts)),
                    "length": len(text),
                    "part": [text[s : s + chunk + overlap] for s in starts],
                })

    chunks = (
        texts.where(F.length("text") > chunk)
        .withColumn("row_id", F.monotonically_increasing_id())
        .mapInPandas(cut, "row_id long, doc_id string, n long, length long, part string")
        .repartition("row_id", "n")
    )

    def pretokenise(batches):
        for pdf in batches:
            head, sure = [], []
            for n, length, part in zip(pdf["n"], pdf["length"], pdf["part"]):
                start = n * chunk
                ends = boundaries(part, start, pattern, start + len(part) >= length)
                head.append([e for e in ends if e < start + overlap])
                sure.append([e for e in ends if start + chunk <= e < start + chunk + overlap and is_sure(part, e - start)])
            yield pdf.assign(head=head, sure=sure)

    split = chunks.mapInPandas(
        pretokenise,
        "row_id long, doc_id string, n long, length long, part string, head array<long>, sure array<long>",
    )

    # Stitching needs only the few boundaries in the overlaps; each chunk then
    # keeps the text from its own cut up to the next chunk's cut.  A chunk
    # without a cut of its own belongs to the piece of the one before.
    def stitched(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n")
        cuts = stitch(list(zip(pdf["head"], pdf["sure"])))
        starts = np.searchsorted(pdf["n"].to_numpy() * chunk, cuts, side="right") - 1  # the chunk a cut lies in
        text = "".join(p[:chunk] for p in pdf["part"])
        stops = [*cuts[1:], int(pdf["length"].iloc[0])]
        return pd.DataFrame({
            "row_id": pdf["row_id"].iloc[0],
            "doc_id": pdf["doc_id"].iloc[0],
            "n": np.asarray(starts, np.int64),
            "piece": [text[a:b] for a, b in zip(cuts, stops)],
        })

    pieces = split.groupBy("row_id").applyInPandas(stitched, "row_id long, doc_id string, n long, piece string")

    def encode_pieces(batches):
        coder = rank_encoder(path, pattern)
        for pdf in batches:
            ids = [np.array(encode_plain(coder, p), "<u4").tobytes() for p in pdf["piece"]]
            yield pdf.drop(columns="piece").assign(ids=ids)

    encoded = pieces.repartition("row_id", "n").mapInPandas(
        encode_pieces, "row_id long, doc_id string, n long, ids binary"
    )

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n")
        ids = np.frombuffer(b"".join(pdf["ids"]), "<u4").tolist()
        return _encoded(path, pattern, digests, [(pdf["doc_id"].iloc[0], ids)], ["doc_id", *names])

    long = encoded.groupBy("row_id").applyInPandas(gather, f"doc_id string, {values}")
    return long_ids(short.unionByName(long))


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, bytes`` from little-endian 32-bit ids: the raw bytes of the ids, concatenated."""

    def decoded(batches):
        coder = rank_encoder(path, pattern)
        for pdf in batches:
            raw = [coder.decode_bytes(np.frombuffer(x or b"", "<u4").tolist()) for x in pdf["ids"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "bytes": raw})

    rows = encoded.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(ids_col).alias("ids"))
    return long_ids(rows.mapInPandas(decoded, "doc_id string, bytes binary"))
