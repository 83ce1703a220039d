"""Bounded-space online packing into fixed windows (operator 5).

A document's ids (and the end id) are cut into full windows and one shorter
rest.  Every task keeps at most ``open_windows`` windows open: a rest goes
into the open window it fills best; if none has room while all places are
taken, the fullest window is emitted and a new one opened.  A task therefore
holds a fixed number of windows whatever it reads.  The windows still open at
the end of the tasks are merged last, best-fit again, among small sets of
neighbouring tasks, so no task ever sees all leftovers.

Defined results: null and empty texts are one piece holding the end id;
repeated rows are packed as rows of their own; an empty table gives no rows;
other columns are ignored whatever their names; a document of many windows
is cut, nothing is dropped; a text of any length is encoded whole, in the
memory of one task.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplex.llm.common import id_and_text, long_ids, materialise

WINDOW = 2048
END_ID = 1
#: Windows a task keeps open.
OPEN_WINDOWS = 64
#: Neighbouring tasks whose leftovers are merged together (64 * 4 windows at most).
MERGED_TASKS = 4

PIECES = (
    "doc_id string, start long, length long, ids binary, doc_tokens long, "
    "window_id long, offset long, used long, open boolean"
)


@lru_cache(maxsize=4)
def rank_encoder(path: str, pattern: str, added: tuple = ()):
    """The byte-level BPE of a rank file, with ``added`` (token, id) pairs; loaded once per worker process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(added))


# The characters of a white-space run in the pattern; from what length on a run is set apart.
_SPACE_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % 65536)


def encode_plain(encoder, text: str) -> list[int]:
    """``encoder.encode_ordinary(text)`` for any text.

    The encoder's pattern matcher remembers each character of a white-space
    run and fails on very long ones.  Such a run is one pre-token, up to its
    last character if something follows (that one goes with what follows), so
    it is encoded by itself; the pre-tokens around it stay as they are.
    """
    ids, at = [], 0
    for run in _SPACE_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoder.encode_ordinary(text[at : run.start()])
        ids += encoder._encode_single_piece(text[run.start() : end])
        at = end
    return ids + encoder.encode_ordinary(text[at:]) if at else encoder.encode_ordinary(text)


def encode_text(encoder, text: str, added: tuple = ()) -> list[int]:
    """Ids of a text; ``added`` (token, id) pairs stand for themselves."""
    if not added or not any(name in text for name, _ in added):
        return encode_plain(encoder, text)
    ids, number = [], dict(added)
    names = "|".join(re.escape(name) for name in sorted(number, key=len, reverse=True))
    for part in re.split(f"({names})", text):
        ids += [number[part]] if part in number else encode_plain(encoder, part)
    return ids


class OpenWindows:
    """A fixed number of open windows with best-fit placement.

    ``place`` returns a window that had to be emitted, or ``None``.  A window
    is ``(id, [item, ...], used)``; the caller says what an item is.
    """

    def __init__(self, size: int, places: int, first_id: int):
        self.size, self.places, self.next_id = size, places, first_id
        self.room: list[tuple[int, int]] = []  # (free, window id), sorted
        self.held: dict[int, list] = {}

    def new_id(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def place(self, item, length: int):
        emitted = None
        at = bisect_left(self.room, (length, -1))
        if at < len(self.room):
            free, window = self.room.pop(at)
        else:
            if len(self.room) == self.places:
                free, full = self.room.pop(0)
                emitted = (full, self.held.pop(full), self.size - free)
            free, window = self.size, self.new_id()
            self.held[window] = []
        self.held[window].append((item, self.size - free, length))
        insort(self.room, (free - length, window))
        return emitted

    def leftovers(self):
        return [(window, self.held[window], self.size - free) for free, window in self.room]


def place_rests(ids_of, window: int = WINDOW, open_windows: int = OPEN_WINDOWS):
    """A ``mapInPandas`` function that packs the documents of a partition.

    ``ids_of(texts)`` yields each text's ids (end id included) as a uint32
    array.  Rows are the pieces of windows as they are emitted.
    """

    def packed(batches):
        bins = OpenWindows(window, open_windows, TaskContext.get().partitionId() << 40)
        out: list[tuple] = []

        def emit(done, is_open):
            number, items, used = done
            for (doc_id, start, ids, doc_tokens), offset, length in items:
                out.append((doc_id, start, length, ids, doc_tokens, number, offset, used, is_open))

        def frame():
            pdf = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids", "doc_tokens", "window_id", "offset", "used", "open"])
            out.clear()
            return pdf

        for pdf in batches:
            for doc_id, ids in zip(pdf["doc_id"], ids_of(pdf["text"])):
                total = len(ids)
                data = ids.astype("<u4", copy=False)
                rest = total // window * window
                for start in range(0, rest, window):
                    whole = (doc_id, start, data[start : start + window].tobytes(), total)
                    emit((bins.new_id(), [(whole, 0, window)], window), False)
                if rest < total:
                    done = bins.place((doc_id, rest, data[rest:].tobytes(), total), total - rest)
                    if done:
                        emit(done, False)
                if len(out) >= 4096:
                    yield frame()
        for done in bins.leftovers():
            emit(done, True)
        yield frame()

    return packed


def _merge(window: int, open_windows: int):
    """Merge the leftover windows of one set of tasks: old window id to new id and base offset."""

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        order = pdf.sort_values(["used", "window_id"], ascending=[False, True])
        bins, rows = OpenWindows(window, open_windows, 0), []
        done = []
        for number, used in zip(order["window_id"].tolist(), order["used"].tolist()):
            out = bins.place(number, used)
            if out:
                done.append(out)
        for _, items, _ in done + bins.leftovers():
            rows += [(number, items[0][0], base) for number, base, _ in items]
        return pd.DataFrame(rows, columns=["old_id", "sequence_id", "base"])

    return merged


def text_ids(path: str, pattern: str, end_id: int = END_ID, added: tuple = ()):
    """Ids of whole texts under a rank file, each with the end id.

    ``added`` tokens in a text get their own ids, and what stands between them
    is encoded by itself; without them their names are ordinary text.
    """

    def ids_of(texts):
        encoder = rank_encoder(path, pattern, added)
        for text in texts:
            ids = encode_text(encoder, text, added)
            ids.append(end_id)
            yield np.array(ids, np.uint32)

    return ids_of


def pack(
    docs: DataFrame,
    ids_of,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    checksum_only: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` is the piece as little-endian 32-bit ids, or with
    ``checksum_only`` their CRC-32 in four bytes, which keeps the table small
    when the ids themselves are not wanted.
    """
    place = place_rests(ids_of, window, open_windows)

    def placed(batches):
        for pdf in place(batches):
            if checksum_only:
                pdf["ids"] = [zlib.crc32(x).to_bytes(4, "big") for x in pdf["ids"]]
            yield pdf

    pieces = materialise(id_and_text(docs, id_col, text_col).mapInPandas(placed, PIECES), "pieces")
    left = pieces.where("open and offset = 0").select(
        "window_id", "used", F.expr(f"shiftright(window_id, 40) div {MERGED_TASKS}").alias("tasks")
    )
    moves = left.groupBy("tasks").applyInPandas(
        _merge(window, open_windows * MERGED_TASKS), "old_id long, sequence_id long, base long"
    )
    columns = ["doc_id", "start", "length", "ids", "doc_tokens"]
    closed = pieces.where("not open").select(*columns, F.col("window_id").alias("sequence_id"), "offset")
    merged = pieces.where("open").join(moves, F.col("window_id") == F.col("old_id")).select(
        *columns, "sequence_id", (F.col("offset") + F.col("base")).alias("offset")
    )
    return long_ids(closed.unionByName(merged))
