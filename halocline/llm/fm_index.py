"""An FM-index over word ids whose backward search runs for many queries at once.

Suffixes are sorted to DEPTH words, which is enough for patterns shorter than that. The BWT is
kept in a wavelet matrix of packed bits with a count for each 64 of them.
"""

from __future__ import annotations

import io

import numpy as np

DEPTH = 64
LANE = 256  #: windows that one lane of a search covers


def suffix_order(ids: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first `depth` ids, and each suffix's rank by its first depth / 2."""
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    half, gap = rank, 1
    while gap < depth:
        half = rank
        nxt = np.full(len(rank), -1, np.int64)
        nxt[: max(0, len(rank) - gap)] = rank[gap:]
        key = rank * (len(rank) + 2) + nxt + 1
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
        rank = np.empty(len(rank), np.int64)
        rank[order] = new
        gap *= 2
    return order, half


class Wavelet:
    """rank(c, i): how often c occurs before place i, for arrays of c and i."""

    def __init__(self, seq: np.ndarray, sigma: int):
        levels, words = max(1, int(sigma - 1).bit_length()), []
        for level in range(levels - 1, -1, -1):
            bit = (seq >> level) & 1
            packed = np.zeros(len(seq) // 64 + 1, np.uint64)
            raw = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed.view(np.uint8)[: len(raw)] = raw
            words.append(packed)
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        self._ready(np.stack(words), len(seq), sigma)

    @classmethod
    def of(cls, words: np.ndarray, n: int, sigma: int) -> Wavelet:
        """From the packed bits of another."""
        made = cls.__new__(cls)
        made._ready(words, n, sigma)
        return made

    def _ready(self, words: np.ndarray, n: int, sigma: int) -> None:
        count = np.zeros((len(words), words.shape[1] + 1), np.int64)
        np.cumsum(np.bitwise_count(words), axis=1, out=count[:, 1:])
        self.words, self.levels, self.before, self.zeros = words, len(words), count[:, :-1], n - count[:, -1]
        self.start = self._walk(np.arange(sigma), np.zeros(sigma, np.int64))

    def _walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (words, before, zeros) in enumerate(zip(self.words, self.before, self.zeros, strict=True)):
            word, low = i >> 6, (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[word] + np.bitwise_count(words[word] & low)
            i = np.where((c >> (self.levels - 1 - k)) & 1, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self._walk(c, i) - self.start[c]


class FMIndex:
    """The index of several runs of words. owner: the document of each run."""

    def __init__(self, runs: list[np.ndarray], owner: np.ndarray, window: int):
        """runs: hashes of words. window is at most half of DEPTH plus what two halves overlap: 32 to 63."""
        assert DEPTH // 2 <= window < DEPTH
        self.window = window
        self.alphabet = np.unique(np.concatenate(runs))
        lengths = np.array([len(r) + 1 for r in runs])
        ids = np.zeros(lengths.sum() + 1, np.int64)  # 0 ends the text, 1 ends a run
        at = np.cumsum(lengths) - lengths
        for a, r in zip(at, runs, strict=True):
            ids[a : a + len(r)] = np.searchsorted(self.alphabet, r) + 2
            ids[a + len(r)] = 1
        order, half = suffix_order(ids)
        self.n = len(ids)
        self.wavelet = Wavelet(ids[order - 1], len(self.alphabet) + 2)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=len(self.alphabet) + 2))])[:-1]
        # Suffixes with the same first `window` ids stand together; each group has the least owner of its members.
        gap = window - DEPTH // 2
        later = np.full(self.n, -1, np.int64)
        later[: max(0, self.n - gap)] = half[gap:]
        differs = np.concatenate([[True], (np.diff(half[order]) != 0) | (np.diff(later[order]) != 0)])
        by = np.concatenate([np.repeat(owner, lengths), [np.iinfo(np.int64).max]])[order]
        self._groups(differs, np.minimum.reduceat(by, np.flatnonzero(differs)))

    def _groups(self, differs: np.ndarray, owners: np.ndarray) -> None:
        """differs: whether a group begins at each suffix; owners: the least owner of each group."""
        starts = np.flatnonzero(differs)
        group = np.cumsum(differs) - 1
        self.differs, self.owners = differs, owners
        self.group_start, self.group_end = starts[group], np.append(starts[1:], self.n)[group]
        self.least_owner = owners[group]

    def dump(self) -> bytes:
        """The index without what load() can work out again: bits of the wavelet matrix and the groups, owners by number."""
        out = io.BytesIO()
        names, which = np.unique(self.owners, return_inverse=True)
        np.savez(out, window=self.window, n=self.n, alphabet=self.alphabet, first=self.first.astype(np.int32), bits=self.wavelet.words, differs=np.packbits(self.differs), names=names, which=which.astype(np.int32))
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> FMIndex:
        made, of = cls.__new__(cls), np.load(io.BytesIO(data))
        made.window, made.n, made.alphabet, made.first = int(of["window"]), int(of["n"]), of["alphabet"], of["first"].astype(np.int64)
        made.wavelet = Wavelet.of(of["bits"], made.n, len(made.alphabet) + 2)
        made._groups(np.unpackbits(of["differs"], count=made.n).view(bool), of["names"][of["which"]])
        return made

    def matches(self, words: np.ndarray, run_of: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Whether the window that begins at each word is in the index with a smaller owner.

        words: hashes of concatenated runs; run_of: each word's run, ascending; doc: the document of each word. Lanes of
        up to LANE windows are searched side by side, each from its right end. A match of the full window is extended by
        one word and cut back to the window, which the groups tell at once, so a word costs one step.
        """
        w, hit = self.window, np.zeros(len(words), bool)
        begin = np.searchsorted(run_of, run_of)
        end = np.searchsorted(run_of, run_of, "right")
        place = np.arange(len(words))
        lane_start = np.flatnonzero(((place - begin) % LANE == 0) & (place + w <= end))
        at = np.minimum(lane_start + LANE - 1, end[lane_start] - w) + w - 1
        c = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1)
        c = np.where(self.alphabet[c] == words, c + 2, -1)
        low, length = lane_start.copy(), np.zeros(len(at), np.int64)
        sp, ep = np.zeros(len(at), np.int64), np.full(len(at), self.n, np.int64)
        while len(at):
            symbol = np.maximum(c[at], 0)
            both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([sp, ep]))
            sp, ep = self.first[symbol] + both[: len(at)], self.first[symbol] + both[len(at) :]
            failed = (c[at] < 0) | (sp >= ep)
            # What failed from `at` over `length` words: the next window ends before the last of them.
            back = failed & (length > 0)
            at = np.where(back, at + length - 1, at - 1)
            length = np.where(failed, 0, length + 1)
            sp, ep = np.where(failed, 0, sp), np.where(failed, self.n, ep)
            longer = length > w
            sp[longer], ep[longer] = self.group_start[sp[longer]], self.group_end[sp[longer]]
            length = np.minimum(length, w)
            full = length == w
            hit[at[full] + 1] = self.least_owner[sp[full]] < doc[at[full] + 1]
            on = at + 1 - (w - length) > low - 1
            on &= at >= low
            at, low, length, sp, ep = at[on], low[on], length[on], sp[on], ep[on]
        return hit
