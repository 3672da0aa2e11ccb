"""Language identification with hyperdimensional profiles.

Every letter has a random bipolar vector. A letter's vector is permuted by its place in an n-gram, the permuted vectors
are bound (multiplied) into the n-gram's vector, and n-gram vectors are bundled (added) into the vector of a text.
A language's prototype is the bundle of its training texts; a text goes to the prototype of the largest cosine.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import quoted

DIM = 1024
GRAM = 3
SYMBOLS = 128  # 0: between words; a-z 1 to 26; others by a hash of the code point
UNDETERMINED = "und"
CHUNK = 1 << 18  # code points worked on at once
HELD = 1 << 18  # counted n-grams that a task holds before it bundles them


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Symbol of each code point: lower-cased letters above 0, all else 0."""
    out = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            o = ord(unicodedata.normalize("NFC", low)[0])
            out[cp] = o - 96 if 97 <= o <= 122 else 27 + (o * 2654435761 >> 7) % (SYMBOLS - 27)
    return out


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """GRAM permuted copies of SYMBOLS random bipolar vectors."""
    base = np.random.default_rng(9).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIM))
    return np.stack([np.roll(base, k, axis=1) for k in range(GRAM)])


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """Bound vectors of n-gram codes, one row each."""
    letters = _letters()
    out = letters[0][codes // SYMBOLS**2]
    out = out * letters[1][codes // SYMBOLS % SYMBOLS]
    return (out * letters[2][codes % SYMBOLS]).astype(np.float32)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-gram codes of all texts with the text each belongs to. A text is framed by word breaks; runs of them are one."""
    lengths = np.array([len(t) + 2 for t in texts])
    points = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sym = _symbols()[points].astype(np.int32)
    owner = np.repeat(np.arange(len(texts)), lengths)
    keep = (sym > 0) | np.r_[True, (sym[:-1] > 0) | (owner[1:] != owner[:-1])]
    sym, owner = sym[keep], owner[keep]
    if len(sym) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (sym[:-2] * SYMBOLS + sym[1:-1]) * SYMBOLS + sym[2:]
    whole = (owner[:-2] == owner[2:]) & (sym[1:-1] > 0)
    return code[whole], owner[:-2][whole]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about CHUNK code points together, with the place of the first."""
    start, size, run = 0, 0, []
    for k, t in enumerate(texts):
        t = t or ""
        if run and size + len(t) > CHUNK:
            yield start, run
            start, size, run = k, 0, []
        run.append(t)
        size += len(t)
    if run:
        yield start, run


def fit(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Prototype of each language, from all rows of training with a text and a language.

    Tasks bundle the n-grams they count, a bounded number at a time, and give a vector for each language; these are whole
    numbers, added up with combining before the shuffle. The driver gets DIM numbers for each language.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for start, run in _chunks(batch.column(0).to_pylist()):
                code, owner = _codes(run)
                of = np.array([langs[start + k] for k in range(len(run))], object)
                for lang in set(of):
                    held.setdefault(lang, []).append(np.unique(code[(of == lang)[owner]], return_counts=True))
                if sum(len(c) for parts in held.values() for c, _ in parts) > HELD:
                    _add_bundles(held, sums)
        _add_bundles(held, sums)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * DIM, pa.string()), pa.array(range(DIM), pa.int32()), pa.array(vector)], ["lang", "dim", "n"])

    rows = training.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    totals = rows.mapInArrow(bundle, "lang string, dim int, n double").groupBy("lang", "dim").agg(F.sum("n").alias("n")).toPandas()
    prototypes = {}
    for lang, part in totals.groupby("lang"):
        vector = part.sort_values("dim")["n"].to_numpy(float)
        prototypes[lang] = vector / max(np.linalg.norm(vector), 1e-12)
    return dict(sorted(prototypes.items()))


def _add_bundles(held: dict[str, list[tuple[np.ndarray, np.ndarray]]], sums: dict[str, np.ndarray]) -> None:
    """Bundles the counted n-grams of each language into its vector, and lets the counts go."""
    for lang, parts in held.items():
        codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        n = np.bincount(at, np.concatenate([n for _, n in parts]), len(codes))
        vector = sums.setdefault(lang, np.zeros(DIM))
        for k in range(0, len(codes), 4096):
            vector += n[k : k + 4096] @ gram_vectors(codes[k : k + 4096])
    held.clear()


def cosines(texts: list[str], prototypes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosine of each text's vector with each prototype; whether it has an n-gram."""
    code, owner = _codes(texts)
    out = np.zeros((len(texts), len(prototypes)))
    if not len(code):
        return out, np.zeros(len(texts), bool)
    grams, at = np.unique(code, return_inverse=True)
    pair, n = np.unique(owner * len(grams) + at, return_counts=True)
    counts = np.zeros((len(texts), len(grams)), np.float32)
    counts[pair // len(grams), pair % len(grams)] = n
    vectors = np.zeros((len(texts), DIM), np.float32)
    for k in range(0, len(grams), 4096):
        vectors += counts[:, k : k + 4096] @ gram_vectors(grams[k : k + 4096])
    norms = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return (vectors / norms) @ prototypes.T, counts.any(axis=1)


def judge(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: kept (a struct of the columns of keep, whose names may be any), lang_pred, score; see identify()."""
    names, matrix = list(prototypes), np.array(list(prototypes.values()), np.float32).reshape(-1, DIM)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            preds, scores = [], []
            for _, run in _chunks(batch.column(batch.num_columns - 1).to_pylist()):
                for k in range(0, len(run), 256):
                    cos, has = cosines(part := run[k : k + 256], matrix)
                    best = cos.argmax(axis=1) if names else np.zeros(len(part), int)
                    for j in range(len(part)):
                        known = bool(names) and has[j]
                        preds.append(names[best[j]] if known else UNDETERMINED)
                        scores.append(float(min(1.0, max(0.0, cos[j, best[j]]))) if known else 0.0)
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(preds, pa.string()), pa.array(scores, pa.float64())], ["kept", "lang_pred", "score"])

    struct = F.struct(*[quoted(c) for c in keep]).alias("kept")
    rows = docs.select(struct, quoted(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["kept"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(predict, schema)


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: the columns of keep, doc_id, lang_pred, score (the cosine of the winner, 0 to 1).

    A text that is null or has no letter gets 'und' and score 0; ties go to the language first in code-point order;
    without prototypes every row is 'und'. Whole texts are read; rows are judged one by one. Columns whose names clash with
    those of the result are for judge().
    """
    found = judge(docs, prototypes, text_col, tuple(dict.fromkeys([*keep, id_col])))
    return found.select(*[F.col("kept")[c].alias(c) for c in keep if c != id_col], F.col("kept")[id_col].alias("doc_id"), "lang_pred", "score")
