"""Toxicity from a weighted lexicon.

Text is folded (look-alike characters, accents, digits and signs that stand for letters), terms are found by one
Aho-Corasick automaton with boundary checks, exception phrases take their hits back, and the weighted hits are
normalised by length and turned into a score. Terms, weights, exceptions and the curve are learned from labelled rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

SAMPLE = 20_000  # labelled rows at most that a model is fitted on
LEAST_GROUPS = 6  # unlike toxic texts that a term must occur in
LEAST_ODDS = 3.0  # log odds of a term between toxic and clean texts
LEAST_ROOT = 4
LONGEST_ROOT = 24  # letters of a root that stands for the words it starts; longer words count whole

# What stands for a letter. l, i, 1, | and ! fold alike, since 1 may stand for either.
LOOK_ALIKE = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "i"}
UNSEEN = "­​‌‍⁠﻿"

_ALONE = str.maketrans(LOOK_ALIKE | {"l": "i"} | dict.fromkeys(UNSEEN, ""))
_BOTH = str.maketrans(DIGITS | SIGNS)
_MIXED = re.compile(r"(?<![^\W\d_])[0-9@$!|]+(?=[^\W\d_])|(?<=[^\W\d_])[0-9@$!|]+(?=[^\W\d_])|(?<=[^\W\d_])[0-9]+(?![^\W_])")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str | None) -> str:
    """Lower case, compatibility forms, look-alikes and, beside letters, digits and signs, as plain letters."""
    low = (text or "").lower()
    if not low.isascii():
        low = unicodedata.normalize("NFKC", low)
    return _MIXED.sub(lambda m: m[0].translate(_BOTH), low.translate(_ALONE))


@dataclass
class Model:
    """terms: pattern (with '$': a whole word, else a root that a word starts with) to weight."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-4.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for pattern, weight in self.terms.items():
            bare = pattern.rstrip("$")
            machine.add_word(bare, (*machine.get(bare, ()), (len(bare), pattern.endswith("$"), weight)))
        if self.terms:
            machine.make_automaton()
        return machine

    def hits(self, folded: str, machine) -> list[tuple[int, int, float]]:
        """Start, end (of the whole word) and weight of each word hit; one, the heaviest, for each word."""
        best: dict[int, tuple[int, int, float]] = {}
        if not self.terms:
            return []
        n = len(folded)
        for end, found in machine.iter(folded):
            for size, whole, weight in found:
                start, stop = end - size + 1, end + 1
                if start and folded[start - 1].isalpha() or whole and stop < n and folded[stop].isalpha():
                    continue
                if start not in best or best[start][2] < weight:
                    while stop < n and folded[stop].isalpha():
                        stop += 1
                    best[start] = (start, stop, weight)
        return list(best.values())

    def features(self, text: str | None, machine, exceptions: frozenset[str]) -> tuple[float, float]:
        """Weighted hits on a log scale, plain and normalised by the root of the length in words."""
        folded = fold(text)
        total = sum(w for a, b, w in self.hits(folded, machine) if not (exceptions and exceptions.intersection(phrases(folded, a, b))))
        return math.log1p(total), math.log1p(10 * total / math.sqrt(1 + folded.count(" ") + folded.count("\n")))

    def score(self, x: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * x[:, 0] + c * x[:, 1], -40, 40)))


def phrases(folded: str, start: int, end: int) -> list[str]:
    """The hit with the word before, and with the word after."""
    word = folded[start:end]
    stop = start
    while stop and not folded[stop - 1].isalpha():
        stop -= 1
    first = stop
    while first and folded[first - 1].isalpha():
        first -= 1
    after = _WORD.search(folded, end)
    return ([f"{folded[first:stop]} {word}"] if first < stop else []) + ([f"{word} {after[0]}"] if after else [])


def _group(words: list[str]) -> int:
    """Texts that share most of their word 4-grams mostly share this."""
    grams = range(max(1, len(words) - 3))
    return min(zlib.crc32(" ".join(words[k : k + 4]).encode()) for k in grams)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word of each text once, with the group of the text and, for toxic ones, a context."""
    for whole in batches:
        for k in range(0, whole.num_rows, 256):
            batch = whole.slice(k, 256)
            seen: set[tuple[str, int, int, int]] = set()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = _WORD.findall(fold(text))
                if not words:
                    continue
                group = _group(words)
                if label:
                    padded = ["", *words, ""]
                    seen.update((w, 1, group, zlib.crc32(f"{padded[j]} {padded[j + 2]}".encode())) for j, w in enumerate(words))
                else:
                    seen.update((w, 0, group, 0) for w in set(words))
            columns = list(zip(*seen, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], ["word", "toxic", "grp", "context"])


def _patterns(sample: DataFrame) -> DataFrame:
    """For every word ('word$') and root: groups of toxic and of clean texts, and contexts in toxic ones."""
    words = sample.mapInArrow(_count_words, "word string, toxic int, grp long, context long").groupBy("word", "toxic").agg(F.countDistinct("grp").alias("groups"), F.countDistinct("context").alias("contexts"))
    lengths = F.when(F.length("word") > LEAST_ROOT, F.sequence(F.lit(LEAST_ROOT), F.least(F.length("word") - 1, F.lit(LONGEST_ROOT)))).otherwise(F.array().cast("array<int>"))
    roots = F.transform(lengths, lambda n: F.substring(F.col("word"), F.lit(1), n))
    every = words.select(F.explode(F.concat(F.array(F.concat("word", F.lit("$"))), roots)).alias("pattern"), "toxic", "groups", "contexts")
    toxic = F.col("toxic") == 1
    return every.groupBy("pattern").agg(
        F.sum(F.when(toxic, F.col("groups")).otherwise(0)).alias("toxic"), F.sum(F.when(toxic, 0).otherwise(F.col("groups"))).alias("clean"), F.sum(F.when(toxic, F.col("contexts")).otherwise(0)).alias("contexts")
    )


def choose_terms(rows: list[tuple[str, int, int]], n_toxic: float, n_clean: float) -> dict[str, float]:
    """Weighted terms from (pattern, toxic, clean) of patterns with enough support.

    A word that makes up most of what its root finds stands for itself; else the longest root that loses little.
    """
    odds = {p: math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1)) for p, t, c in rows}
    toxic = {p: t for p, t, _ in rows}
    good = {p for p in odds if odds[p] >= LEAST_ODDS}
    children: dict[str, list[str]] = {}
    for p in good:
        bare = p.rstrip("$")
        for n in range(LEAST_ROOT, len(bare) + p.endswith("$")):
            children.setdefault(bare[:n], []).append(p)
    terms: dict[str, float] = {}
    for p in sorted((p for p in good if not p.endswith("$")), key=lambda p: (len(p), p)):
        if any(p[:n] in terms for n in range(LEAST_ROOT, len(p))):
            continue
        below = children.get(p, [])
        word = max((q for q in below if q.endswith("$")), key=toxic.get, default="")
        longer = [q for q in below if not q.endswith("$") and toxic[q] >= 0.9 * toxic[p]]
        if word and toxic[word] >= 0.5 * toxic[p] or longer:
            continue
        terms[p] = min(odds[p], 8.0) / 8
    for p in sorted(p for p in good if p.endswith("$")):
        if not any(p[:n] in terms for n in range(LEAST_ROOT, len(p))):
            terms[p] = min(odds[p], 8.0) / 8
    return terms


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton's method."""
    design = np.c_[np.ones(len(x)), x]
    w = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + 0.1 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, w))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model from at most `sample` rows, taken by a hash of id and text; rows that repeat both count once.

    Rows without text or label are left out. The hashes alone are put in order, and texts up to the last one taken stay where
    they are. The driver gets the patterns that enough of the sample supports, and two numbers a sample row.
    """
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), F.xxhash64(id_col, text_col).alias("at"))
    last = rows.select("at").distinct().orderBy("at").limit(sample).agg(F.max("at").alias("at")).first()["at"]
    rows = stored(rows.where(F.col("at") <= F.lit(last)).dropDuplicates(["at"]).select("text", "label"), "toxicity-sample")
    totals = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return Model()
    supported = _patterns(rows).where((F.col("toxic") >= LEAST_GROUPS) & (F.col("contexts") >= LEAST_GROUPS) & (F.col("toxic") * n_clean > 10 * F.col("clean") * n_toxic))
    found = supported.collect()
    model = Model(choose_terms([(r.pattern, r.toxic, r.clean) for r in found], n_toxic, n_clean))
    model.exceptions = _learn_exceptions(rows, model)
    x, y = _sample_features(rows, model)
    model.curve = fit_curve(x, y)
    return model


def _learn_exceptions(rows: DataFrame, model: Model, least: int = 5) -> tuple[str, ...]:
    """Phrases around a term that at least `least` clean texts have and no toxic one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.automaton()
        for batch in batches:
            seen: Counter[tuple[str, int]] = Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded = fold(text)
                seen.update({(p, label) for a, b, _ in model.hits(folded, machine) for p in phrases(folded, a, b)})
            keys = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([seen[k] for k in keys], pa.int64())], ["phrase", "label", "n"])

    both = rows.mapInArrow(count, "phrase string, label int, n long").groupBy("phrase").agg(F.sum(F.col("n") * F.col("label")).alias("toxic"), F.sum("n").alias("n"))
    return tuple(r.phrase for r in both.where((F.col("toxic") == 0) & (F.col("n") >= least)).orderBy("phrase").collect())


def _sample_features(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, exceptions = model.automaton(), frozenset(model.exceptions)
        for batch in batches:
            x = [model.features(t, machine, exceptions) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in x], pa.float64()), pa.array([b for _, b in x], pa.float64()), batch.column(1)], ["a", "b", "label"])

    got = rows.mapInArrow(measure, "a double, b double, label int").toPandas()
    return got[["a", "b"]].to_numpy(), got["label"].to_numpy(float)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), cut: float = 0.7) -> DataFrame:
    """One row per row of docs: the columns of keep, doc_id, score, predicted, hits.

    A null or empty text has no hits and the score of such texts. Whole texts are read, rows are judged one by one.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, exceptions = model.automaton(), frozenset(model.exceptions)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            x = np.array([model.features(t, machine, exceptions) for t in texts]).reshape(-1, 2)
            s = model.score(x)
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(s), pa.array((s >= cut).astype(np.int32)), pa.array(np.expm1(x[:, 0]))], [*batch.schema.names[:-1], "score", "predicted", "hits"])

    rows = docs.select(*[F.col(c) for c in keep], F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    return rows.mapInArrow(judge, ", ".join([*schema, "score double, predicted int, hits double"])).withColumnRenamed("_id", "doc_id")
