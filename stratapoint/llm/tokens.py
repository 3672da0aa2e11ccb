"""Token ids of a public byte-level BPE vocabulary, for whole columns of text.

The vocabulary's pre-tokens are found with array operations over code points, and each distinct pre-token goes through
the tokenizer once per worker and cache generation. Texts with characters that the array path does not class exactly
(apostrophes, which may open a contraction, and rare scripts) and texts that hold an added token such as <|endoftext|>
go through the tokenizer as they are.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np

END = 2  # id put after each document
CACHE = 1 << 20  # distinct pre-tokens kept by a worker
SLOT_BITS = 22
EXACT_BELOW = 0x2E80  # code points classed by the tables here
CHUNK = 1 << 19  # code points worked on at once

_LETTER, _NUMBER, _OTHER, _SPACE = 0, 1, 2, 3


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of each code point as the vocabulary's pattern sees it; 4: leave the text to the tokenizer."""
    out = np.full(EXACT_BELOW + 1, 4, np.uint8)
    white = {0x20, 0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, *range(9, 14), *range(0x2000, 0x200B)}
    for cp in range(EXACT_BELOW):
        kind = unicodedata.category(chr(cp))
        out[cp] = _SPACE if cp in white else _LETTER if kind[0] == "L" else _NUMBER if kind[0] == "N" else 4 if kind == "Cn" else _OTHER
    out[0x27] = 4
    return out


@lru_cache(maxsize=1)
def _mixers() -> tuple[np.ndarray, np.ndarray]:
    """Random odd values for code points, and powers of an odd base."""
    rng = np.random.default_rng(3)
    table = rng.integers(0, 1 << 63, EXACT_BELOW + 1, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    powers = np.empty(CHUNK + 1, np.uint64)
    powers[0] = 1
    powers[1:] = np.uint64(0x9E3779B97F4A7C15)
    return table, np.multiply.accumulate(powers)


class Encoder:
    """Ids by a tokenizers file; one per worker process."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        """Pre-tokens are numbered as they come: refs by key, and a table with one place for each leading bits of a key,
        which the first to come keeps."""
        self.refs: dict[int, int] = {}
        self.slot_key = np.zeros(1 << SLOT_BITS, np.uint64)
        self.slot_ref = np.zeros(1 << SLOT_BITS, np.int32)
        self.at = np.zeros(1 << 16, np.int64)
        self.n = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        run: list[int] = []
        points: list[np.ndarray] = []
        size = 0
        for k, text in enumerate(texts):
            cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            if not len(cps):
                out[k] = np.zeros(0, np.uint32)
            elif len(cps) > CHUNK or any(t in text for t in self.added) or (_classes()[np.minimum(cps, EXACT_BELOW)] == 4).any():
                out[k] = self.plain(text)
            else:
                if size + len(cps) > CHUNK:
                    self._run(run, points, out)
                    run, points, size = [], [], 0
                run.append(k)
                points.append(cps)
                size += len(cps)
        self._run(run, points, out)
        return out

    def _run(self, run: list[int], points: list[np.ndarray], out: list) -> None:
        if not run:
            return
        cps = np.concatenate(points)
        ends = np.cumsum([len(p) for p in points])
        starts = pretoken_starts(cps, ends)
        table, powers = _mixers()
        stops = np.r_[starts[1:], len(cps)]
        lengths = stops - starts
        place = np.arange(len(cps)) - np.repeat(starts, lengths)
        keys = np.add.reduceat(table[cps] * powers[place], starts) ^ (lengths.astype(np.uint64) << np.uint64(1))
        keys *= np.uint64(0xBF58476D1CE4E5B9)
        at = self._known(keys, starts, lengths, cps)
        counts = self.n[at]
        upto = np.cumsum(counts)
        source = np.arange(upto[-1]) + np.repeat(self.at[at] - (upto - counts), counts)
        ids = self.ids[source]
        of_text = np.r_[0, upto][np.searchsorted(starts, ends)]
        for k, a, b in zip(run, np.r_[0, of_text[:-1]], of_text, strict=True):
            out[k] = ids[a:b]

    def _known(self, keys, starts, lengths, cps) -> np.ndarray:
        """Numbers of the keys' pre-tokens, after adding those that are new."""
        if len(self.refs) > CACHE:
            self._clear()
        slot = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        out = self.slot_ref[slot].astype(np.int64)
        missed = np.flatnonzero(self.slot_key[slot] != keys)
        if not len(missed):
            return out
        some, first, back = np.unique(keys[missed], return_index=True, return_inverse=True)
        first = missed[first]
        refs = np.array([self.refs.get(k, -1) for k in some.tolist()], np.int64)
        new = np.flatnonzero(refs < 0)
        if len(new):
            text = cps.tobytes().decode("utf-32-le", "surrogatepass")
            got = [e.ids for e in self.tokenizer.encode_batch_fast([text[a : a + n] for a, n in zip(starts[first[new]].tolist(), lengths[first[new]].tolist(), strict=True)], add_special_tokens=False)]
            n = np.fromiter(map(len, got), np.int64, len(got))
            base = len(self.refs)
            refs[new] = np.arange(base, base + len(new))
            self.at = _room(self.at, base + len(new))
            self.n = _room(self.n, base + len(new))
            self.ids = _room(self.ids, self.used + int(n.sum()))
            self.at[base : base + len(new)] = self.used + np.cumsum(n) - n
            self.n[base : base + len(new)] = n
            self.ids[self.used : self.used + n.sum()] = np.fromiter(chain.from_iterable(got), np.uint32, n.sum())
            self.used += int(n.sum())
            self.refs.update(zip(some[new].tolist(), refs[new].tolist(), strict=True))
            free = new[self.slot_key[slot[first[new]]] == 0][::-1]
            self.slot_key[slot[first[free]]] = some[free]
            self.slot_ref[slot[first[free]]] = refs[free]
        out[missed] = refs[back]
        return out


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array, or one twice as long until it has n places."""
    while len(array) < n:
        array = np.concatenate([array, np.zeros_like(array)])
    return array


def pretoken_starts(cps: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, in code points of texts laid end to end that end at ends.

    Runs of letters, numbers or other marks are pre-tokens and take one space (0x20) before them along. White space
    before something else leaves its last character alone: that space, or a pre-token of its own; at the end of a
    text it is one pre-token.
    """
    cls = _classes()[cps]
    first = np.zeros(len(cps), bool)
    first[0] = True
    first[ends[:-1]] = True
    begins = first | np.r_[True, cls[1:] != cls[:-1]]
    space = cls == _SPACE
    last = np.zeros(len(cps), bool)
    last[ends - 1] = True
    before_mark = space & ~last & np.r_[~space[1:], True]  # the last of a run of white space inside a text
    begins |= before_mark
    after = np.flatnonzero(before_mark & (cps == 0x20)) + 1
    begins[after] = False
    return np.flatnonzero(begins)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
