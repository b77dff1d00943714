"""Periodic runs of words, found by internal pattern matching.

A run of period q and length L >= 3q, L >= 24 holds a dyadic block (its length
2^k and a multiple of that as its start) that occurs again q words later; for
q < 16 a block of 8 words will do, else one of the largest 2^k <= q. So every
dyadic block asks for its occurrences in the windows after it, of 2^k starts
each: successive range-successor queries on a wavelet matrix over the suffix
array. Occurrences within such a window form one arithmetic progression, so its
first two and its last member describe them all. With up to two members these
are the candidates; with more, the block and the progression each lie in a
stretch with the progression's difference as period, and the period sought is
the distance of the two stretches' left or right ends, or the difference itself.
Each candidate is extended as far as its period holds, by the ranks of dyadic
factors from which the suffix array is built; what is long enough is a run, and
of equal stretches the least period stays.

Documents are handled a batch at a time in numpy, their words numbered and laid
one behind the other with a barrier between. Only documents in which some
8 words occur twice enter the index, as each run repeats its blocks.

Null texts count as empty. A null doc_id leaves its text as it is. Repeated rows
give equal rows. Memory follows the batch, or the longest text if that is longer:
about 200 bytes per word.
"""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import whole_text

SHORTEST, REPEATS, BLOCK = 24, 3, 8
BATCH_WORDS = 1 << 18


class Wavelet:
    """A wavelet matrix over values below `bound`; all queries take arrays."""

    def __init__(self, values: np.ndarray, bound: int):
        self.bits = max(1, int(bound - 1).bit_length())
        self.ranks, self.zeros = [], []
        for level in reversed(range(self.bits)):
            ones = (values >> level) & 1
            self.ranks.append(np.concatenate([[0], np.cumsum(ones)]).astype(np.int32))
            self.zeros.append(int(len(values) - self.ranks[-1][-1]))
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    def below(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values in [lo, hi) are less than `value`, itself at most 2 ** bits - 1."""
        lo, hi, found = lo.astype(np.int64), hi.astype(np.int64), np.zeros(len(lo), np.int64)
        for ranks, zeros, level in zip(self.ranks, self.zeros, reversed(range(self.bits))):
            ones_lo, ones_hi = ranks[lo], ranks[hi]
            one = ((value >> level) & 1).astype(bool)
            found += np.where(one, (hi - lo) - (ones_hi - ones_lo), 0)
            lo = np.where(one, zeros + ones_lo, lo - ones_lo)
            hi = np.where(one, zeros + ones_hi, hi - ones_hi)
        return found

    def smallest(self, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value with `rank` smaller ones in [lo, hi); the rank must be below hi - lo."""
        lo, hi, rank = lo.astype(np.int64), hi.astype(np.int64), rank.astype(np.int64)
        value = np.zeros(len(lo), np.int64)
        for ranks, zeros, level in zip(self.ranks, self.zeros, reversed(range(self.bits))):
            ones_lo, ones_hi = ranks[lo], ranks[hi]
            n_zeros = (hi - lo) - (ones_hi - ones_lo)
            one = rank >= n_zeros
            rank = np.where(one, rank - n_zeros, rank)
            value += np.where(one, 1 << level, 0)
            lo = np.where(one, zeros + ones_lo, lo - ones_lo)
            hi = np.where(one, zeros + ones_hi, hi - ones_hi)
        return value


class Factors:
    """Ranks of all factors of length 2^k, the suffix array they lead to, and extensions by them.

    `ranks[k][i]` numbers the factor at i in the order of the factors; those that
    overhang the end are padded with a least word.
    """

    def __init__(self, words: np.ndarray, longest: int):
        self.n = len(words)
        self.ranks = [np.unique(words, return_inverse=True)[1].astype(np.int64) + 1]
        while (1 << (len(self.ranks) - 1)) < longest:
            half, last = 1 << (len(self.ranks) - 1), self.ranks[-1]
            after = np.zeros(self.n, np.int64)
            after[:self.n - half] = last[half:]
            names = np.unique(last * (self.n + 2) + after, return_inverse=True)[1] + 1
            self.ranks.append(names.astype(np.int64))
            if names.max() == self.n:
                break
        self.suffixes = np.argsort(self.ranks[-1], kind="stable")

    def bucket(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with the factor of length 2^k at each of `at`, as a range of the suffix array."""
        ranks = self.ranks[k]
        ends = np.cumsum(np.bincount(ranks, minlength=ranks.max() + 1))
        return ends[ranks[at] - 1], ends[ranks[at]]

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and from b on are equal."""
        a, b, length = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ranks))):
            size = 1 << k
            for _ in range(2 if k == len(self.ranks) - 1 else 1):
                inside = (a + size <= self.n) & (b + size <= self.n)
                same = inside & (self.ranks[k][np.where(inside, a, 0)] == self.ranks[k][np.where(inside, b, 0)])
                step = np.where(same, size, 0)
                a, b, length = a + step, b + step, length + step
        return length

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and before b are equal."""
        a, b, length = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ranks))):
            size = 1 << k
            for _ in range(2 if k == len(self.ranks) - 1 else 1):
                inside = (a >= size) & (b >= size)
                same = inside & (self.ranks[k][np.where(inside, a - size, 0)] == self.ranks[k][np.where(inside, b - size, 0)])
                step = np.where(same, size, 0)
                a, b, length = a - step, b - step, length + step
        return length


def _progressions(index: Wavelet, lo, hi, first, last):
    """Of the occurrences in suffix range [lo, hi) that start in [first, last]: number, first, second and last."""
    before, through = index.below(lo, hi, first), index.below(lo, hi, last + 1)
    number = through - before
    some = np.flatnonzero(number > 0)
    low, high = lo[some], hi[some]
    one = index.smallest(low, high, before[some])
    second = index.smallest(low, high, before[some] + (number[some] > 1))
    end = index.smallest(low, high, through[some] - 1)
    return some, number[some], one, second, end


def _candidates(factors: Factors, index: Wavelet, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(start of a block, candidate period) from all dyadic blocks of length 2^k."""
    size, n = 1 << k, factors.n
    blocks = np.arange(0, n - size + 1, size, dtype=np.int64)
    lo, hi = factors.bucket(k, blocks)
    often = hi - lo > 1
    blocks, lo, hi = blocks[often], lo[often], hi[often]
    starts, periods = [], []
    windows = [(size, 2 * size - 1)] if size > BLOCK else [(1, size), (size + 1, 2 * size)]
    for nearest, farthest in windows:
        inside = blocks + nearest < n
        b, low, high = blocks[inside], lo[inside], hi[inside]
        some, number, one, second, end = _progressions(index, low, high, b + nearest, np.minimum(b + farthest, n - 1))
        b = b[some]
        for other in (one, second, end):
            starts.append(b)
            periods.append(other - b)
        many = number > 2
        b, one, gap = b[many], one[many], (second - one)[many]
        left_b, left_p = b - factors.backward(b, b + gap), one - factors.backward(one, one + gap)
        right_b, right_p = b + factors.forward(b, b + gap), one + factors.forward(one, one + gap)
        for period in (gap, left_p - left_b, right_p - right_b):
            starts.append(b)
            periods.append(period)
    starts, periods = np.concatenate(starts), np.concatenate(periods)
    useful = (periods > 0) & (starts + periods < n)
    return starts[useful], periods[useful]


def find_runs(words: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) of all runs, in order; no text in it is longer than `longest`."""
    if longest < SHORTEST:
        return np.empty((0, 3), np.int64)
    factors = Factors(words, longest)
    index = Wavelet(factors.suffixes, max(2, factors.n + 1))
    starts, periods = [], []
    k = BLOCK.bit_length() - 1
    while REPEATS * (1 << k) <= max(longest, REPEATS * BLOCK) and k < len(factors.ranks):
        a, q = _candidates(factors, index, k)
        starts.append(a)
        periods.append(q)
        k += 1
    if not starts:
        return np.empty((0, 3), np.int64)
    pairs = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)]), axis=1)
    a, q = pairs
    begin = a - factors.backward(a, a + q)
    end = a + q + factors.forward(a, a + q)
    long = end - begin >= np.maximum(SHORTEST, REPEATS * q)
    begin, end, q = begin[long], end[long], q[long]
    order = np.lexsort((q, end, begin))  # of equal stretches the least period comes first
    begin, end, q = begin[order], end[order], q[order]
    fresh = np.ones(len(q), bool)
    fresh[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    runs = np.stack([begin, end - begin, q], axis=1)[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def worn(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """The text under test: every tenth document, by the hash of its id, repeats its words from some word on."""
    n, h = len(words), zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return [words[i] for i in at.tolist()]


def _repeats_a_block(numbers: np.ndarray) -> bool:
    """Whether some `BLOCK` words occur twice; equal hashes count, so the answer no is certain."""
    if len(numbers) < SHORTEST:
        return False
    hashed = np.zeros(len(numbers) - BLOCK + 1, np.uint64)
    for k in range(BLOCK):
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + numbers[k:len(numbers) - BLOCK + 1 + k].astype(np.uint64)
    hashed.sort()
    return bool((hashed[1:] == hashed[:-1]).any())


class _Numbers(dict):
    """Word -> number, dealt in order."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text, several texts in one index."""
    known = _Numbers()
    numbers = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in texts]
    out = [np.empty((0, 3), np.int64)] * len(texts)
    asked = [k for k, x in enumerate(numbers) if _repeats_a_block(x)]
    at = 0
    while at < len(asked):
        size, end = 0, at
        while end < len(asked) and (end == at or size + len(numbers[asked[end]]) <= BATCH_WORDS):
            size, end = size + len(numbers[asked[end]]) + 1, end + 1
        chosen, barrier = asked[at:end], len(known)
        # A barrier is a word of its own, so nothing that repeats can hold one.
        laid = np.concatenate([np.append(numbers[k], barrier + i) for i, k in enumerate(chosen)])
        starts = np.cumsum([0, *(len(numbers[k]) + 1 for k in chosen)])
        runs = find_runs(laid, max(len(numbers[k]) for k in chosen))
        cuts = np.searchsorted(runs[:, 0], starts)
        for i, k in enumerate(chosen):
            mine = runs[cuts[i]:cuts[i + 1]].copy()
            mine[:, 0] -= starts[i]
            out[k] = mine
        at = end
    return out


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period."""
    if len(runs):
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
    return b" ".join(words)


DIGEST = ("n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def run_digest(docs: DataFrame) -> DataFrame:
    """Per document: its number of runs, the strongest one, and hashes of all runs and of the collapsed text."""
    def described(words: list[bytes], runs: np.ndarray) -> tuple:
        rows = runs.tolist()
        best = max(rows, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in rows)
        found = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        return (len(rows), *found, hashlib.sha256(lines.encode()).hexdigest(),
                hashlib.sha256(collapse(words, runs)).hexdigest())

    @F.pandas_udf(DIGEST)
    def digest(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        words = [worn(t.encode().split(), None if pd.isna(i) else i) for i, t in zip(ids, texts)]
        rows, at = [], 0
        while at < len(words):  # as many texts at a time as fill an index
            size, end = 0, at
            while end < len(words) and (end == at or size < BATCH_WORDS):
                size, end = size + len(words[end]), end + 1
            rows += [described(w, r) for w, r in zip(words[at:end], runs_of(words[at:end]))]
            at = end
        out = pd.DataFrame(rows, columns=[part.split()[0] for part in DIGEST.split(", ")])
        numbers = [name for name in out.columns if not name.endswith("sha256")]
        return out.astype({name: "Int64" for name in numbers})

    return docs.select("doc_id", digest(F.col("doc_id").cast("string"), whole_text()).alias("d")).select("doc_id", "d.*")
