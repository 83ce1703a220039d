"""Spelling variant grouping by finite-state composition (operator 13).

The words of the corpus are an acceptor (a minimal acyclic automaton).
Composed with a transducer that makes exactly one edit, and with the acceptor
again, it accepts the pairs of words that are one edit apart.

One automaton of all words would have to lie in one place.  The pairs are
therefore enumerated by initial state: an edit leaves either the first or the
second half of a word as it is, so two near words agree on their length (the
shorter one's, ``L``) and on a half.  Each word is dealt out by
``(L, half kept, hash of that half)``, once as the shorter and once as the
longer word; the automata of such a part begin in the state behind the common
half (its end, for a common second half) and hold only what may differ.  The
first differing place of a pair lies in one half only, so each pair is found
in one part.

A part of more than ``MAX_PART`` words is not enumerated but cut again: the
region that may hold the edit is halved, and each half's key takes in the other
one.  A region of one place holds two free characters at most, so with the
90 letters of the word pattern it has fewer than ``MAX_PART`` words: every part
ends small, and no pair is lost.

Composition is dynamic programming over pairs of states.  Words are numbered
by the counts of accepted words in their states, so pairs come out as numbers
and no string is spelled.

Forms are followed to their last one by doubling the steps: a form has ten
times the occurrences of its word, so chains are short.

Defined results: null texts have no words; a row without an id takes part with
an empty id in the hashed text; repeated rows count each time; words that occur
less often or are shorter than wanted are left out; an empty table gives no
rows; other columns are ignored whatever their names; texts and words of any
length are read whole.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplex.llm.common import materialise

# Letters of a word; ASCII capitals and their small letters.
LETTERS = r"A-Za-zÀ-ÿ"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIN_LENGTH = 7
MIN_COUNT = 2
#: One run in so many (by its hash) loses a character.
DROP_EVERY = 31
#: A form has so many times the occurrences of its word.
FACTOR = 10
#: Words of one part; above the 90 * 90 + 90 that can share all but two characters.
MAX_PART = 16384


def vocabulary(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``word, n`` of the distinct words of whole texts.

    Only runs that are long enough can give a word, so only those are taken
    from a text; words are counted map side before they are dealt out.
    """
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(
            F.col(text_col).cast("string"), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0)
        )).alias("run"),
    ).select("id", F.translate("run", CAPITALS, SMALL).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % drop_every == 0, shorter).otherwise(F.col("run")).alias("word"))
    return (
        words.where(F.length("word") >= min_length)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    )


class Acceptor:
    """The minimal acyclic automaton of sorted distinct words.

    States are numbers, targets before their sources.  ``edges[s]`` maps a
    character to ``(target, words of s before those)``; ``final[s]`` is 1
    where a word may end.
    """

    def __init__(self, words: list[str]):
        self.final: list[int] = []
        self.edges: list[dict[str, tuple[int, int]]] = []
        self.count: list[int] = []
        known: dict[tuple, int] = {}
        path: list[tuple[list[int], list[tuple[str, int]]]] = [([0], [])]
        before = ""

        def close(node) -> int:
            key = (node[0][0], tuple(node[1]))
            if key not in known:
                known[key] = len(self.final)
                at, edges = node[0][0], {}
                for char, target in node[1]:
                    edges[char] = (target, at)
                    at += self.count[target]
                self.final.append(node[0][0])
                self.edges.append(edges)
                self.count.append(at)
            return known[key]

        for word in [*words, None]:
            shared = 0
            if word is not None:
                top = min(len(word), len(before))
                while shared < top and word[shared] == before[shared]:
                    shared += 1
            while len(path) - 1 > shared:
                target = close(path.pop())
                path[-1][1].append((before[len(path) - 1], target))
            if word is not None:
                path += [([0], []) for _ in word[shared:]]
                path[-1][0][0] = 1
                before = word
        self.start = close(path[0])


def compose(left: Acceptor, right: Acceptor) -> list[tuple[int, int]]:
    """Numbers ``(i, j)`` of the pairs that ``left``, one replaced or inserted character, and ``right`` accept.

    The edit is made at the first place where the words differ: an inserted
    character is not the one that follows it in the left word.
    """
    # Pairs of states before the edit, which have read the same; those after it.
    equal, after = {(left.start, right.start)}, set()
    todo = [(left.start, right.start)]
    steps: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}  # edits: target pair, numbers skipped
    ends: dict[tuple[int, int], list[tuple[int, int]]] = {}  # edits that end both words
    while todo:
        p, q = pair = todo.pop()
        edits, done = [], []
        out_p, out_q = left.edges[p], right.edges[q]
        for y, (r, at_r) in out_q.items():
            for x, (s, at_s) in out_p.items():
                if x == y:
                    if (s, r) not in equal:
                        equal.add((s, r))
                        todo.append((s, r))
                    continue
                edits.append((s, r, at_s, at_r))  # x replaced by y
                below = right.edges[r].get(x)
                if below:  # y inserted before x
                    edits.append((s, below[0], at_s, at_r + below[1]))
            if left.final[p] and right.final[r]:  # y inserted at the end
                done.append((0, at_r))
        steps[pair], ends[pair] = edits, done
        after.update((s, r) for s, r, _, _ in edits)
    todo = list(after)
    while todo:
        p, q = todo.pop()
        for c, (s, _) in left.edges[p].items():
            if c in right.edges[q]:
                pair = (s, right.edges[q][c][0])
                if pair not in after:
                    after.add(pair)
                    todo.append(pair)
    # Targets have smaller numbers, so each pair finds its targets' results ready.
    same: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for p, q in sorted(after):
        found = [(0, 0)] if left.final[p] and right.final[q] else []
        for c, (s, at_s) in left.edges[p].items():
            if c in right.edges[q]:
                r, at_r = right.edges[q][c]
                found += [(at_s + i, at_r + j) for i, j in same[s, r]]
        same[p, q] = found
    near: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for p, q in sorted(equal):
        found = ends[p, q]
        for s, r, at_s, at_r in steps[p, q]:
            found += [(at_s + i, at_r + j) for i, j in same[s, r]]
        for c, (s, at_s) in left.edges[p].items():
            if c in right.edges[q]:
                r, at_r = right.edges[q][c]
                found += [(at_s + i, at_r + j) for i, j in near[s, r]]
        near[p, q] = found
    return near[left.start, right.start]


def part_pairs(words: list[str], length: int, low: int, high: int) -> list[tuple[str, str]]:
    """Near pairs ``(u, v)`` of one part: ``u`` has ``length`` characters, ``v`` as many or one more.

    The first difference lies from ``low`` up to (without) ``high``; the
    characters before, and after it up to the end, are common.
    """
    tail = max(0, length - high)
    by_frame: dict[tuple[str, str], list[str]] = {}
    for w in words:  # one frame, unless two of them share a hash
        by_frame.setdefault((w[:low], w[len(w) - tail :]), []).append(w[low : len(w) - tail])
    out = []
    for (head, end), cores in by_frame.items():
        short = sorted(c for c in cores if len(c) == length - low - tail)
        if not short or len(cores) < 2:
            continue
        cores.sort()
        left = Acceptor(short)
        right = left if len(short) == len(cores) else Acceptor(cores)
        size = high - low
        for i, j in compose(left, right):
            u, v = short[i], cores[j]
            # In a second half that the edit must not reach, the first difference belongs to another part.
            if high <= length and u[:size] == v[:size]:
                continue
            if len(v) > len(u) or u < v:  # a replacement is accepted both ways
                out.append((head + u + end, head + v + end))
    return out


def _key(word: Column, length: Column, low: Column, high: Column) -> Column:
    """Part of a word: what it keeps before and after the region, hashed."""
    tail = F.greatest(length - high, F.lit(0))
    size = F.length(word)
    kept = F.xxhash64(F.substring(word, F.lit(1), low), F.substring(word, size - tail + 1, tail))
    return F.struct(
        length.alias("length"), low.alias("low"), high.alias("high"), kept.alias("kept")
    )


def _halves(word: Column, length: Column, low: Column, high: Column) -> list[Column]:
    middle = ((low + high) / 2).cast("int")
    return [_key(word, length, low, middle), _key(word, length, middle, high)]


def _enumerate(batches):
    for pdf in batches:
        out = []
        for length, low, high, words, counts in zip(
            pdf["length"], pdf["low"], pdf["high"], pdf["words"], pdf["counts"]
        ):
            n = dict(zip(words, counts))
            for u, v in part_pairs(list(words), length, low, high):
                out.append((u, v, n[v]))
                out.append((v, u, n[u]))
        yield pd.DataFrame(out, columns=["word", "near", "near_n"])


def near_words(words: DataFrame, max_part: int = MAX_PART) -> DataFrame:
    """``word, near, near_n``: every ordered pair of ``words (word, n)`` that are one edit apart."""
    part = ["length", "low", "high", "kept"]
    zero = F.lit(0)
    word, size = F.col("word"), F.length("word")
    keys = [k for role in (size, size - 1) for k in _halves(word, role, zero, role + 1)]
    rows = materialise(words.select("word", "n", F.explode(F.array(*keys)).alias("k")).select("word", "n", "k.*"), "spelling-parts")
    found = None
    while True:
        large = materialise(
            rows.where("high - low > 1").groupBy(*part).agg(F.count(F.lit(1)).alias("size"))
            .where(F.col("size") > max_part).select(*part),
            "spelling-large-parts",
        )
        more = large.count() > 0
        small = rows.join(large, part, "left_anti") if more else rows
        groups = small.groupBy(*part).agg(F.collect_list(F.struct("word", "n")).alias("g")).where(F.size("g") > 1)
        pairs = groups.select(
            "length", "low", "high", F.col("g.word").alias("words"), F.col("g.n").alias("counts")
        ).mapInPandas(_enumerate, "word string, near string, near_n long")
        found = pairs if found is None else found.unionByName(pairs)
        if not more:
            return found
        cut = F.explode(F.array(*_halves(word, F.col("length"), F.col("low"), F.col("high")))).alias("k")
        rows = materialise(
            rows.join(large, part, "left_semi").select("word", "n", cut).select("word", "n", "k.*"), "spelling-parts"
        )


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the last word of each chain."""
    links = materialise(forms.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = materialise(
            links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-links",
        )
        if not links.where("moved").take(1):
            return links.select("word", "root")
        links = links.select("word", "root")


def variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY,
    factor: int = FACTOR, max_part: int = MAX_PART, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    The form is the near word of largest ``n`` (of equal ones the smallest),
    if that is ``factor`` times the word's own or more; the root is where the
    forms lead.
    """
    words = materialise(vocabulary(docs, min_length, min_count, drop_every, id_col, text_col), "spelling-words")
    best = near_words(words, max_part).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    joined = words.join(best, "word", "left")
    enough = -F.col("best.less") >= F.lit(factor) * F.col("n")
    formed = materialise(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = last_forms(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
