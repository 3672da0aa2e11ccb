"""Main text of web pages by a recurrent block labeller.

A bidirectional LSTM in numpy reads a page's leaf blocks in order, each as a hashed vector of the tags above it, a hashed
vector of its words and a few measures, so that every block is classed with the whole page in view. It is trained here
on made-up pages (html_practice) whose layouts vary.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import Block, blocks
from .html_practice import make
from .words import words

PATH, WORD, MEASURES = 96, 16, 6
INPUT = PATH + WORD + MEASURES
HIDDEN = 24
PRACTICE, EPOCHS, BATCH, SEED = 1200, 6, 32, 11
CELLS = 1 << 15  # blocks labelled at once, padding included

OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_blocks", pa.int64()), ("n_kept", pa.int64())])


@lru_cache(maxsize=65_536)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Hashed bag of the tags and names above a block; the nearest tags count apart too."""
    out = np.zeros(PATH, np.float32)
    for back, label in enumerate(reversed(path)):
        names = label.replace("#", ".").replace("@", ".").split(".")
        pieces = [names[0], *[f".{n}" for n in names[1:]], *[f".{p}" for n in names[1:] for p in n.replace("_", "-").split("-") if p != n]]
        if back < 2:
            pieces.append(f"{back}:{names[0]}")
        for piece in pieces:
            h = crc32(piece.encode())
            out[h % PATH] += 1.0 if h >> 31 else -1.0
    return out


def features(pages: list[list[Block]]) -> list[np.ndarray]:
    """An array of blocks by INPUT for each page."""
    flat = [b for page in pages for b in page]
    x = np.zeros((len(flat), INPUT), np.float32)
    if flat:
        for k, b in enumerate(flat):
            x[k, :PATH] = _path_vector(b.path)
        w = words(pa.array([b.text for b in flat]), fold=True)
        owner = w.owner
        sign = np.where(w.hashes >> np.uint64(63), 1.0, -1.0)
        slot = (w.hashes % np.uint64(WORD)).astype(np.int64)
        n = np.maximum(1, np.diff(w.first))
        bag = np.bincount(owner * WORD + slot, sign, len(flat) * WORD).reshape(-1, WORD)
        x[:, PATH : PATH + WORD] = bag / np.maximum(1, np.linalg.norm(bag, axis=1, keepdims=True))  # a repeated word counts no more
        length = np.array([len(b.text) for b in flat])
        at = PATH + WORD
        x[:, at] = np.log1p(length) / 5
        x[:, at + 1] = np.log1p(n) / 4
        x[:, at + 2] = [b.links for b in flat]
        x[:, at + 3] = [b.text[-1] in ".!?" for b in flat]
        x[:, at + 4] = np.minimum(3, [len(b.path) / 4 for b in flat])
        x[:, at + 5] = 1
    ends = np.cumsum([len(p) for p in pages])
    return [x[e - len(p) : e] for p, e in zip(pages, ends, strict=True)]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Labeller:
    """One LSTM forwards, one backwards, and a logistic output for each block."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        scale = 1 / np.sqrt(INPUT + HIDDEN)
        self.p = {f"w{d}": (rng.standard_normal((INPUT + HIDDEN, 4 * HIDDEN)) * scale).astype(np.float32) for d in "fb"}
        self.p |= {f"c{d}": np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)].astype(np.float32) for d in "fb"}  # forget gates start open
        self.p |= {"o": (rng.standard_normal(2 * HIDDEN) * 0.2).astype(np.float32), "ob": np.zeros(1, np.float32)}

    def _forward(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """x: time, page, input. Padding leaves the state as it is."""
        steps, n, _ = x.shape
        wx, wh, bias = self.p[f"w{d}"][:INPUT], self.p[f"w{d}"][INPUT:], self.p[f"c{d}"]
        into = (x.reshape(-1, INPUT) @ wx).reshape(steps, n, -1) + bias
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        hs, trail = np.zeros((steps, n, HIDDEN), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = into[t] + h @ wh
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o, g = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :], np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * g
            out = np.tanh(new)
            if keep:
                trail.append((t, i, f, o, g, c, h, out, m))
            c, h = np.where(m, new, c), np.where(m, o * out, h)
            hs[t] = h
        return hs, trail

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._forward(x, mask, d, False)[0] for d in "fb"], axis=2)
        return _sigmoid(both @ self.p["o"] + self.p["ob"][0])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        runs = {d: self._forward(x, mask, d, True) for d in "fb"}
        both = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        wrong = (_sigmoid(both @ self.p["o"] + self.p["ob"][0]) - y) * mask / mask.sum()
        grad = {"o": np.einsum("tn,tnh->h", wrong, both), "ob": np.array([wrong.sum()])}
        for k, d in enumerate("fb"):
            into_h = wrong[:, :, None] * self.p["o"][k * HIDDEN : (k + 1) * HIDDEN]
            w, wh = np.zeros_like(self.p[f"w{d}"]), self.p[f"w{d}"][INPUT:]
            bias = np.zeros(4 * HIDDEN, np.float32)
            dh, dc = np.zeros_like(into_h[0]), np.zeros_like(into_h[0])
            for t, i, f, o, g, c, h, out, m in reversed(runs[d][1]):
                dh = dh + into_h[t]
                here, pass_h = np.where(m, dh, 0), np.where(m, 0, dh)
                new = np.where(m, dc, 0) + here * o * (1 - out * out)
                z = np.concatenate([new * g * i * (1 - i), new * c * f * (1 - f), here * out * o * (1 - o), new * i * (1 - g * g)], axis=1)
                w[:INPUT] += x[t].T @ z
                w[INPUT:] += h.T @ z
                bias += z.sum(axis=0)
                dh = z @ wh.T + pass_h
                dc = np.where(m, new * f, dc)
            grad[f"w{d}"], grad[f"c{d}"] = w, bias
        return grad


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Time, page, input; and which cells are blocks."""
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), INPUT), np.float32), np.zeros((steps, len(pages)), bool)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, True
    return x, mask


@lru_cache(maxsize=2)
def train(practice: int = PRACTICE, epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """A labeller after `epochs` passes of Adam over `practice` made-up pages; the same for the same parameters."""
    rng = np.random.default_rng(seed)
    made = [make(rng) for _ in range(practice)]
    cut = [(blocks(page), labels) for page, labels in made]
    cut = [(b, labels) for b, labels in cut if len(b) == len(labels)]
    data = list(zip(features([b for b, _ in cut]), [np.array(y, np.float32) for _, y in cut], strict=True))
    model = Labeller(seed)
    m1 = {k: np.zeros_like(v) for k, v in model.p.items()}
    m2 = {k: np.zeros_like(v) for k, v in model.p.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        order = order[np.argsort([len(data[k][1]) // 12 for k in order], kind="stable")]  # pages of like length together
        batches = [order[k : k + BATCH] for k in range(0, len(order), BATCH)]
        for k in rng.permutation(len(batches)):
            x, mask = padded([data[j][0] for j in batches[k]])
            y = np.zeros(mask.shape, np.float32)
            for c, j in enumerate(batches[k]):
                y[: len(data[j][1]), c] = data[j][1]
            step += 1
            rate = 0.01 * (1 - epoch / (epochs + 1))
            for name, g in model.gradients(x, mask, y).items():
                g = np.clip(g, -1, 1)
                m1[name] = 0.9 * m1[name] + 0.1 * g
                m2[name] = 0.99 * m2[name] + 0.01 * g * g
                model.p[name] -= (rate * (m1[name] / (1 - 0.9**step)) / (np.sqrt(m2[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def label(pages: list[list[Block]], model: Labeller) -> list[np.ndarray]:
    """Score of each block of each page; pages of like length are read together, whole."""
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    xs = features(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    while order:
        take = max(1, min(len(order), CELLS // len(pages[order[-1]])))
        run, order = order[-take:], order[:-take]
        x, mask = padded([xs[k] for k in run])
        scores = model.scores(x, mask)
        for c, k in enumerate(run):
            out[k] = scores[: len(pages[k]), c]
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", cut: float = 0.5, model: Labeller | None = None) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars, n_blocks, n_kept.

    text joins the main blocks in page order by two newlines, with character references decoded and white space inside a
    block turned into single spaces; it is empty for a null or empty page and for one without main blocks. Pages are
    read whole, one by one; repeated rows repeat. One pass over the table, no shuffle.
    """
    model = model or train()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                batch = whole.slice(k, 256)
                cut_up = [blocks(page) for page in batch.column(2).to_pylist()]
                texts, n_kept = [], []
                for page, scores in zip(cut_up, label(cut_up, model), strict=True):
                    kept = [b.text for b, s in zip(page, scores, strict=True) if s >= cut]
                    texts.append("\n\n".join(kept))
                    n_kept.append(len(kept))
                columns = [batch.column(0), batch.column(1), texts, [len(t) for t in texts], [len(p) for p in cut_up], n_kept]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, OUT, strict=True)], schema=OUT)

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")
