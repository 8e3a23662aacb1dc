"""Dense features of whole texts, counted on the bytes of a batch at once."""

from __future__ import annotations

import numpy as np

from tidemark.llm import tokens

_B = np.arange(256)
UPPER, LOWER, DIGIT = (_B >= 65) & (_B <= 90), (_B >= 97) & (_B <= 122), (_B >= 48) & (_B <= 57)
BEYOND = _B >= 128
BLANK = (_B == 32) | ((_B >= 9) & (_B <= 13))
MARK = np.isin(_B, list(b".,;:!?'\"()-"))
SYMBOL = ~(UPPER | LOWER | DIGIT | BEYOND | BLANK | MARK)


class Lookup:
    """Membership in a small set of hashes."""

    def __init__(self, hashes):
        self.sorted = np.unique(np.asarray(hashes, np.uint64))
        self.near = np.zeros(1 << 16, bool)
        self.near[(self.sorted >> np.uint64(48)).astype(np.int64)] = True

    def index(self, hashes: np.ndarray) -> np.ndarray:
        """Place in the sorted set, or -1."""
        out = np.full(len(hashes), -1)
        maybe = np.flatnonzero(self.near[(hashes >> np.uint64(48)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.sorted, hashes[maybe]), len(self.sorted) - 1)
            out[maybe] = np.where(self.sorted[at] == hashes[maybe], at, -1)
        return out

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        return self.index(hashes) >= 0


def per_text(flags: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Sums of flags between neighbouring entries of ``where``."""
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[where[1:]] - total[where[:-1]]


def surface(data: np.ndarray, offsets: np.ndarray, begins: np.ndarray, ends: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Shares of kinds of characters and of words; spans as of ``tokens.spans``."""
    size, n = np.diff(offsets), np.diff(at)
    chars, many = np.maximum(size, 1), np.maximum(n, 1)
    kinds = {k: per_text(c[data], offsets) for k, c in dict(upper=UPPER, lower=LOWER, digit=DIGIT, beyond=BEYOND, mark=MARK, symbol=SYMBOL, blank=BLANK).items()}
    letters = np.maximum(kinds["upper"] + kinds["lower"], 1)
    within = {}
    for k, c in dict(upper=UPPER, lower=LOWER, digit=DIGIT, other=SYMBOL).items():
        total = np.concatenate(([0], np.cumsum(c[data])))
        within[k] = total[ends] - total[begins]
    word = lambda flags: per_text(flags, at) / many
    letter = within["upper"] + within["lower"]
    return {
        "log_chars": np.log1p(size), "log_words": np.log1p(n), "upper": kinds["upper"] / letters,
        **{k: kinds[k] / chars for k in ("digit", "beyond", "mark", "symbol", "blank")},
        "exclaimed": per_text(data == 33, offsets) / chars, "asked": per_text(data == 63, offsets) / chars,
        "lines": per_text(data == 10, offsets) / many, "word_length": per_text(ends - begins, at) / many,
        "shouted": word((within["upper"] >= 2) & (within["lower"] == 0)), "wordless": word((letter == 0) & (within["digit"] == 0)),
        "mixed_digit": word((letter > 0) & (within["digit"] > 0)), "mixed_symbol": word((letter > 0) & (within["other"] > 0)),
        "short": word(ends - begins <= 3), "long": word(ends - begins >= 20),
    }


def repetition(hashes: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """How much a text repeats its words and runs of words."""
    n = np.diff(at)
    runs, starts = tokens.shingles(hashes, at, 3)
    different, most, run_share = (np.ones(len(n)) for _ in range(3))
    for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        if b > a:
            own = np.sort(hashes[a:b])
            heads = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            different[i], most[i] = len(heads) / (b - a), np.diff(heads, append=b - a).max() / (b - a)
            run_share[i] = len(np.unique(runs[starts[i] : starts[i + 1]])) / (starts[i + 1] - starts[i])
    same = np.concatenate((hashes[1:] == hashes[:-1], [False])) if len(hashes) else np.zeros(0, bool)
    return {"different": different, "most": most, "runs": run_share, "stutter": per_text(same, at) / np.maximum(n, 1)}
