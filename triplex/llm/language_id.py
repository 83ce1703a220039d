"""Hierarchical language identification (operator 3).

A text's features are hashed counts of its letter sequences of one to three.
One-versus-one linear support vector machines first choose the language
family; inside the family others, trained only on its languages, separate
those from each other by votes.

The machines are fitted on the driver from ``max_rows`` labelled rows at most
(a documented bound; the same number from each language, chosen by a hash of
the id over all rows, and no more languages than that, those with most rows).  Their weights, ``features`` numbers for each pair of
languages, go to the tasks that read whole texts.

Defined results: null texts and texts without a letter are ``und`` with score
0, and so is every text if there was nothing to learn from; rows without an id
are held out; repeated rows are rows of their own; an empty table gives no
rows; other columns are ignored whatever their names; a text of any length
is read whole, in steps of a fixed size.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplex.llm.common import id_and_text, long_ids

# Families of languages (ISO 639-1). A language not named is a family by itself.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg"),
}
FEATURES = 4096
MAX_ROWS = 2000
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_STEP = 1 << 20


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def text_features(text: str, features: int = FEATURES) -> np.ndarray | None:
    """Unit vector (with a last constant 1) of a whole text; ``None`` without a letter."""
    words = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not words.replace(" ", "").isalpha():  # other numerals, such as powers and fractions
        words = " ".join("".join(c if c.isalpha() else " " for c in words).split())
    if not words:
        return None
    codes = np.frombuffer(f" {words} ".encode("utf-32-le", "replace"), np.uint32)
    counts = np.zeros(features, np.int64)
    for at in range(0, len(codes) - 2, _STEP):  # parts overlap by the two codes that a sequence needs
        c = codes[at : at + _STEP + 2].astype(np.uint64)
        one, two, three = c[:-2], c[1:-1], c[2:]
        for salt, key in enumerate((one, one * np.uint64(1000003) + two, (one * np.uint64(1000003) + two) * np.uint64(1000003) + three)):
            mixed = (key + np.uint64(salt + 1)) * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((mixed >> np.uint64(40)).astype(np.int64) % features, minlength=features)
    v = np.sqrt(counts)
    return np.append(v / np.linalg.norm(v), 1.0).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 100.0, steps: int = 200) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss, ``y`` in -1 and 1, by accelerated gradient steps."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * cost  # both sides count alike
    rate = 1.0 / (1.0 + 2 * 2 * weight.sum())  # rows have squared length 2
    w = ahead = np.zeros(x.shape[1])
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - rate * (ahead - 2 * x.T @ (weight * y * slack))
        ahead = new + t / (t + 3) * (new - w)
        w = new
    return w


class Model:
    """Machines between families and, inside each family, between its languages."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        label = np.array(langs)
        family = np.array([family_of(x) for x in langs])
        self.levels: dict[str, tuple[list[str], list[tuple[int, int]], np.ndarray]] = {}
        self.levels[""] = self._fit(x, family)
        for f in sorted(set(family.tolist())):
            self.levels[f"{f}/"] = self._fit(x[family == f], label[family == f])

    @staticmethod
    def _fit(x, label):
        names = sorted(set(label.tolist()))
        pairs, weights = list(combinations(range(len(names)), 2)), []
        for a, b in pairs:
            rows = (label == names[a]) | (label == names[b])
            weights.append(fit_svm(x[rows], np.where(label[rows] == names[a], 1.0, -1.0)))
        return names, pairs, np.array(weights).reshape(len(pairs), x.shape[1] if x.ndim == 2 else 0)

    def _choose(self, level: str, v: np.ndarray) -> tuple[str, float]:
        names, pairs, weights = self.levels[level]
        if len(names) == 1:
            return names[0], 1.0
        margins = weights @ v
        votes, total = np.zeros(len(names)), np.zeros(len(names))
        for (a, b), m in zip(pairs, margins):
            votes[a if m >= 0 else b] += 1
            total[a], total[b] = total[a] + m, total[b] - m
        best = max(range(len(names)), key=lambda i: (votes[i], total[i], -i))
        against = [m if a == best else -m for (a, b), m in zip(pairs, margins) if best in (a, b)]
        return names[best], float(1 / (1 + np.exp(-3 * min(against))))

    def predict(self, v: np.ndarray | None) -> tuple[str, float]:
        if v is None or not self.langs:
            return UNKNOWN, 0.0
        family, p = self._choose("", v)
        lang, q = self._choose(f"{family}/", v)
        return lang, min(1.0, max(0.0, p * q))


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        max_rows: int = MAX_ROWS, features: int = FEATURES) -> Model:
    """The model of ``labelled`` rows: the rows of each language with the smallest hashes of their ids."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.xxhash64(F.col(id_col).cast("long")).alias("h"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    known = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_rows).collect()
    if not known:
        return Model(np.zeros((0, features + 1), np.float32), [])
    order = Window.partitionBy("lang").orderBy("h")
    cuts = (
        rows.where(F.col("lang").isin([r["lang"] for r in known])).select("lang", "h").distinct()
        .withColumn("r", F.row_number().over(order)).where(F.col("r") <= max_rows // len(known))
        .groupBy("lang").agg(F.max("h").alias("cut")).collect()
    )
    # The cuts, one for each language, are a part of the condition, so no text is dealt out.
    cut_of = F.create_map(*[x for r in cuts for x in (F.lit(r["lang"]), F.lit(r["cut"]))])
    chosen = rows.where(F.col("h") <= F.element_at(cut_of, F.col("lang"))).select("lang", "h", "text")

    def vectors(batches):
        for pdf in batches:
            found = [(lang, h, text_features(t, features)) for lang, h, t in zip(pdf["lang"], pdf["h"], pdf["text"])]
            found = [(lang, h, v.tobytes()) for lang, h, v in found if v is not None]
            yield pd.DataFrame(found, columns=["lang", "h", "v"]).drop_duplicates(["lang", "h"])

    sample = chosen.mapInPandas(vectors, "lang string, h long, v binary").dropDuplicates(["lang", "h"]).toPandas()
    sample = sample.sort_values(["lang", "h"])
    if not len(sample):
        return Model(np.zeros((0, features + 1), np.float32), [])
    x = np.frombuffer(b"".join(sample["v"]), np.float32).reshape(len(sample), features + 1).astype(np.float64)
    return Model(x, sample["lang"].tolist())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", features: int = FEATURES) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from the whole text alone."""

    def predicted(batches):
        for pdf in batches:
            found = [model.predict(text_features(t, features)) for t in pdf["text"]]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"],
                "lang_pred": [f[0] for f in found],
                "score": np.array([f[1] for f in found], float),
            })

    return long_ids(id_and_text(docs, id_col, text_col).mapInPandas(
        predicted, "doc_id string, lang_pred string, score double"
    ))


def held_out(id_col: str = "doc_id", folds: int = 5) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(True))


def keep_known(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.0, features: int = FEATURES) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is known with ``min_score`` or more."""

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        found = (model.predict(text_features(t, features)) for t in texts)
        return pd.Series([lang != UNKNOWN and score >= min_score for lang, score in found], dtype=bool)

    return docs.where(known(F.col(text_col).cast("string")))
