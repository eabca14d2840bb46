"""Toxicity: a subsequence string-kernel SVM with Nyström landmarks.

The kernel of two strings sums, over all common subsequences of ``ORDER``
characters, ``DECAY`` to the power of the spans they take in both; it is
normalised to 1 for equal strings.  Gaps and inserted characters lower it but
do not break it.  Units are the words of a text, folded to lower-case letters
and digits with look-alike digits read as letters; letters of any script
spelled out one by one are one unit, and neighbouring short words also count
joined, so that a blank in an insult is a gap like any other.  Landmarks are the units whose document frequency sets
toxic training documents apart most, and clean units like them.  A unit is the vector of its kernel
values with the landmarks, taken to the Nyström space by K_mm^(-1/2); a linear
SVM there gives its decision value, and a sentence counts as its strongest
unit.  The SVM is trained on labelled
sentences.  Labels belong to documents, so it is trained in rounds: one
sentence stands for a toxic document, at first the one nearest to the best
landmarks, later the one of the highest decision value; of other documents
every sentence is a negative.  A second pass adds the sentences that the first
model ranks highest.  The score is a logistic curve, fitted to the training
documents, of the three highest decision values of a document's units and the
logarithm of their number.

Scale: training uses a bounded sample, at most ``TRAIN_DOCS`` documents and as
many texts of either label (those of the lowest seeded hash); the texts are
never collected, only the landmarks and at most ``SENTENCES`` kernel vectors
per text.  Scoring reads each whole text where it is, without any shuffle;
the model is a few thousand numbers.  Kernel values are computed per distinct
word in numpy; in training they are kept, in bounded number, for a worker's later tasks.  No
value is cut off: a unit's subsequences of ``ORDER`` characters are looked up
in a table of those of all landmarks, so one that no landmark has adds exactly
zero.  Where only the decision value is asked for, the table holds one number
per subsequence, the weighted sum over the landmarks, and only the units that
may be among a document's three highest are normalised (``highest``), with the
same result.  There the units of a slice of texts are no strings but ranges of
one array of characters, told apart by hashes of 64 bits (``Units``).

Defined cases: null and empty texts score as a sentence without units.
Documents with several labels, and equal texts, are toxic if one label says
so; null labels are ignored.  With no or only one label, or without any unit of
``ORDER`` characters in the training texts, the score of all is the share of
toxic labels (0 if none).  Repeated rows keep their rows, an empty table gives
an empty result.  ``scored`` replaces a column that has the name of the score
(in any case); ``without_toxic`` keeps every column as it is.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from salesmart.llm.common import written

ORDER = 3
DECAY = 0.7
LANDMARKS = 96
CLEAN_LANDMARKS = 24
CANDIDATES = 3000
ALIKE = 0.7
SURE = 8.0  # z-scores from here on count alike
LONGEST_UNIT = 40
TRAIN_DOCS = 2000
SAMPLE_PARTS = 24
SENTENCES = 6
MOST_WORDS = 300_000
SLICE_TEXTS = 500
SLICE_CHARS = 1 << 20
CUT = 0.7
JOINED = 12
SHORT = 3
DENSE = 1 << 22  # entries of a table with a place for every subsequence

#: Digits and signs read as the letters they look like.
LOOK_ALIKE = (b"013457@", b"oieasta")
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != ord("@"))
_FOLDED = bytes.maketrans(*LOOK_ALIKE)
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
# Single letters of any script with anything but letters and digits between them.
_SPELLED = re.compile(r"(?<!\w)[^\W\d_](?:[\W_]+[^\W\d_]){2,}(?!\w)")
_LETTER = re.compile(r"[^\W\d_]")


def _folded(text: str) -> bytes:
    return text.lower().encode().translate(_FOLDED, _PUNCTUATION)


def _spelled(folded: str) -> list[bytes]:
    return ["".join(_LETTER.findall(m)).encode() for m in _SPELLED.findall(folded)]


def units_of(text: str) -> list[bytes]:
    """The folded words of a text (UTF-8, no ASCII punctuation) and the runs of letters spelled out."""
    folded = _folded(text)
    return folded.split() + _spelled(folded.decode())


def joined_of(words: list[bytes], most: int = JOINED) -> set[bytes]:
    """Neighbouring words joined: two of at most ``most`` characters together, or three or four of at most SHORT each."""
    sizes = [len(w.decode()) for w in words]
    found = {a + b for a, b, m, n in zip(words, words[1:], sizes, sizes[1:]) if m + n <= most}
    short = [at for at, n in enumerate(sizes) if n <= SHORT]
    for at, third in zip(short, short[2:]):
        if third == at + 2:
            found.add(b"".join(words[at:at + 3]))
    for at, fourth in zip(short, short[3:]):
        if fourth == at + 3:
            found.add(b"".join(words[at:at + 4]))
    return found


def every_unit(text: str, most: int = JOINED) -> set[bytes]:
    """All units of a text: its words, the runs spelled out and neighbouring short words joined."""
    folded = _folded(text)
    words = folded.split()
    return {*words, *_spelled(folded.decode()), *joined_of(words, most)}


@functools.cache
def _char_hashes() -> np.ndarray:
    """64 random bits for every character."""
    return np.random.default_rng(11).integers(0, 1 << 64, 0x110000, dtype=np.uint64)


#: The first powers of an odd number, modulo 2**64.
_POWERS = np.array([pow(0x9E3779B97F4A7C15, n, 1 << 64) for n in range(max(LONGEST_UNIT, 4 * SHORT) + 1)], dtype=np.uint64)


class Units:
    """The distinct units of some documents, as ranges of one array of characters.

    Unit ``i`` is ``codes[begin[i]:begin[i] + size[i]]``.  The rows of (``doc``,
    ``unit``) say which document has which unit, each once, by rising document.
    A unit is known by a polynomial hash of 64 bits: that of joined words follows
    from theirs, so that no joined string is ever made.  Words of more than
    LONGEST_UNIT characters are never joined, and hashed whole.
    """

    def __init__(self, parts: list[str], doc: list[int], documents: int, most: int | None):
        """Part ``i`` belongs to document ``doc[i]``; its words count, and joined if ``most`` is given."""
        flat = np.frombuffer(" ".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.int32)
        filled = np.ones(len(flat) + 2, dtype=bool)
        filled[0] = filled[-1] = False
        filled[1:-1] = (flat != 32) & ((flat < 9) | (flat > 13))
        edges = np.flatnonzero(filled[1:] != filled[:-1])
        first, size = edges[::2], edges[1::2] - edges[::2]
        part = np.searchsorted(np.cumsum([len(p) + 1 for p in parts]), first, side="right")
        self.codes = flat[filled[1:-1]]
        begin = np.cumsum(size) - size
        found = [(part, begin, size, self._hashes(begin, size))]
        if most is not None:
            found += self._joined(*found[0], most)
        part, begin, size, hashes = map(np.concatenate, zip(*found))
        order = np.argsort(hashes)
        new = np.ones(len(order), dtype=bool)
        new[1:] = hashes[order[1:]] != hashes[order[:-1]]
        unit = np.empty(len(order), dtype=np.int64)
        unit[order] = np.cumsum(new) - 1
        self.begin, self.size = begin[order[new]], size[order[new]]
        many = max(len(self.begin), 1)
        held = np.sort(np.array(doc, dtype=np.int64)[part] * many + unit)
        held = held[np.concatenate([np.ones(min(len(held), 1), dtype=bool), held[1:] != held[:-1]])]
        self.doc = held // many
        self.unit = held - self.doc * many
        self.counts = np.bincount(self.doc, minlength=documents)

    @classmethod
    def of_texts(cls, texts: list[str], most: int = JOINED) -> Units:
        """Those of ``every_unit`` of each text."""
        parts, doc, spelled = [], list(range(len(texts))), []
        for at, text in enumerate(texts):
            parts.append(folded := _folded(text).decode())
            if runs := _spelled(folded):
                spelled += [run.decode() for run in runs]
                doc += [at] * len(runs)
        return cls(parts + spelled, doc, len(texts), most)

    @classmethod
    def of_sets(cls, documents: list[set[bytes]]) -> Units:
        return cls([b" ".join(words).decode() for words in documents], list(range(len(documents))), len(documents), None)

    def _hashes(self, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The hash of each word."""
        out = np.zeros(len(begin), dtype=np.uint64)
        for at in np.flatnonzero(size > LONGEST_UNIT).tolist():
            word = self.codes[begin[at]:begin[at] + size[at]].tobytes()
            out[at] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        rest, of = np.flatnonzero(size <= LONGEST_UNIT), _char_hashes()
        for place in range(LONGEST_UNIT):
            rest = rest[size[rest] > place]
            out[rest] += of[self.codes[begin[rest] + place]] * _POWERS[place]
        return out

    @staticmethod
    def _joined(part, begin, size, hashes, most):
        """The same of neighbouring words joined, as ``joined_of`` does."""
        short = size <= SHORT
        reach, joined, run = size, hashes, short
        for words in (2, 3, 4):
            # Up to here ``reach``, ``joined`` and ``run`` hold one word less, from each first word on.
            last = slice(words - 1, None)
            joined = joined[:-1] + _POWERS[np.minimum(reach[:-1], len(_POWERS) - 1)] * hashes[last]
            reach, run = reach[:-1] + size[last], run[:-1] & short[last]
            fits = (reach <= most) if words == 2 else run
            at = np.flatnonzero(fits & (part[:len(reach)] == part[last]))
            yield part[at], begin[at], reach[at], joined[at]

    def strings(self, units: np.ndarray) -> list[str]:
        return [self.codes[at:at + n].tobytes().decode("utf-32-le", "surrogatepass")
                for at, n in zip(self.begin[units].tolist(), self.size[units].tolist())]


def unit_windows(folded: str) -> list[str]:
    """The unit, or overlapping windows of a very long one."""
    if len(folded) <= LONGEST_UNIT:
        return [folded]
    half = LONGEST_UNIT // 2
    return [folded[i:i + LONGEST_UNIT] for i in range(0, len(folded) - half, half)]


def _codes(strings: list[str], length: int, fill: int) -> np.ndarray:
    joined = "".join(s.ljust(length, "\0") for s in strings)
    out = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.int32).reshape(-1, length).copy()
    out[out == 0] = fill
    return out


def _gapped(x: np.ndarray, decay: float) -> np.ndarray:
    """For each (i, j): the sum of x over earlier (i', j'), weighted by the distances."""
    y = np.zeros_like(x)
    for i in range(1, x.shape[0]):
        np.add(y[i - 1], x[i - 1], out=y[i])
        y[i] *= decay
    z = np.zeros_like(x)
    for j in range(1, x.shape[1]):
        np.add(z[:, j - 1], y[:, j - 1], out=z[:, j])
        z[:, j] *= decay
    return z


def raw_kernel(a: np.ndarray, b: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Subsequence kernel of the strings a[p] and b[p], given as codes padded by unequal values."""
    out = np.zeros(len(a))
    step = max(1, 200_000 // (a.shape[1] * b.shape[1]))  # within the processor's cache
    for at in range(0, len(a), step):
        same = (a[at:at + step].T[:, None, :] == b[at:at + step].T[None, :, :]).astype(np.float32)
        value = same
        for _ in range(order - 1):
            value = same * _gapped(value, decay)
        out[at:at + step] = value.sum(axis=(0, 1)) * decay ** 2
    return out


def _marked(strings: list[str]) -> list[str]:
    """The strings with marks at both ends, so that the kernel knows where a unit starts and stops."""
    return [f"\x02{s}\x03" for s in strings]


@functools.cache
def _subsequences(length: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of every subsequence of ORDER characters of a string, one per row, and DECAY to the power of their spans."""
    places = np.array(list(itertools.combinations(range(length), ORDER)), dtype=np.int64).reshape(-1, ORDER)
    return places, (DECAY ** (places[:, -1] - places[:, 0] + 1)).astype(np.float32)


@functools.cache
def _least_own(length: int) -> float:
    """The root of the own kernel of a string without repeated characters, the least of its length."""
    return math.sqrt((_subsequences(length)[1].astype(float) ** 2).sum())


def _ranges(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters, where each string begins in them, its length)."""
    sizes = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    return (np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype=np.int32),
            np.cumsum(sizes) - sizes, sizes)


class Kernel:
    """Normalised kernel values of units with fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        marked = _marked(landmarks)
        letters = sorted({ord(c) for s in marked for c in s})
        self.letters = len(letters) + 1
        self.letter = np.zeros(0x110000, dtype=np.int32 if self.letters ** ORDER <= DENSE else np.int64)  # 0: in no landmark
        self.letter[letters] = np.arange(1, self.letters)
        found: dict[int, dict[int, float]] = {}
        for mark, s in enumerate(marked):
            places, weights = _subsequences(len(s))
            for code, weight in zip(self._coded(_codes([s], len(s), 0), places)[:, 0].tolist(), weights.tolist()):
                held = found.setdefault(code, {})
                held[mark] = held.get(mark, 0.0) + weight
        self.found = np.array(sorted(found), dtype=np.int64)
        #: The weight of each subsequence in each landmark; the first row stands for all that no landmark has.
        self.weights = np.zeros((len(found) + 1, len(landmarks)), dtype=np.float32)
        for row, code in enumerate(self.found.tolist(), 1):
            for mark, weight in found[code].items():
                self.weights[row, mark] = weight
        own = np.sqrt((self.weights.astype(float) ** 2).sum(axis=0))
        self.weights /= np.where(own > 0, own, 1).astype(np.float32)
        self.place = None
        if self.letters ** ORDER <= DENSE:
            self.place = np.zeros(self.letters ** ORDER, dtype=np.int32)
            self.place[self.found] = np.arange(1, len(self.found) + 1)

    def _coded(self, codes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """A number for each subsequence (row) of each string (column); one with a character of no landmark equals none of theirs."""
        letters = np.ascontiguousarray(self.letter[codes].T)
        out = letters[places[:, 0]]
        for at in places.T[1:]:
            out *= self.letters
            out += letters[at]
        return out

    def _rows(self, coded: np.ndarray) -> np.ndarray:
        """The row of ``weights`` of each number."""
        if self.place is not None:
            return self.place[coded]
        at = np.minimum(np.searchsorted(self.found, coded), len(self.found) - 1)
        return np.where(self.found[at] == coded, at + 1, 0)

    def _lengths(self, ranges: tuple[np.ndarray, np.ndarray, np.ndarray], cost, marks: tuple[int, int] = (2, 3)):
        """(their numbers, the marked strings, one per column) in runs of strings of one length; ``cost(length)`` per string."""
        flat, begin, sizes = ranges
        order = np.argsort(sizes, kind="stable")
        at = 0
        for size, many in zip(*(x.tolist() for x in np.unique(sizes, return_counts=True))):
            step, end = max(1, 400_000 // max(1, cost(size + 2))), at + many
            for first in range(at, end, step):
                rows = order[first:min(first + step, end)]
                codes = np.empty((size + 2, len(rows)), dtype=flat.dtype)
                codes[0], codes[-1] = marks
                np.take(flat, begin[rows] + np.arange(size)[:, None], out=codes[1:-1], mode="clip")
                yield rows, codes
            at = end

    def owns(self, strings: list[str]) -> np.ndarray:
        """The root of the own kernel of each string."""
        out = np.zeros(len(strings))
        for rows, columns in self._lengths(_ranges(strings), lambda n: n ** ORDER // 6):
            codes = np.ascontiguousarray(columns.T)
            # Where no character comes twice, only equal places match: the sum of the squared weights.
            own = np.full(len(rows), _least_own(codes.shape[1]) ** 2)
            letters = np.sort(codes, axis=1)
            again = np.nonzero((letters[:, 1:] == letters[:, :-1]).any(axis=1))[0]
            own[again] = raw_kernel(codes[again], codes[again])
            out[rows] = np.sqrt(own)
        return out

    def values(self, strings: list[str]) -> np.ndarray:
        """One row per string (of at most LONGEST_UNIT characters), one column per landmark."""
        out = np.zeros((len(strings), len(self.landmarks)), dtype=np.float32)
        if not strings or not self.landmarks:
            return out
        own = self.owns(strings)
        for rows, codes in self._lengths(_ranges(strings), lambda n: n ** ORDER // 6):
            places, weights = _subsequences(len(codes))
            held = self._rows(self._coded(codes.T, places)).T
            some, at = np.nonzero(held)
            ends = np.searchsorted(some, np.arange(1, len(rows) + 1))
            begin = 0
            for i, end in enumerate(ends.tolist()):
                out[rows[i]] = weights[at[begin:end]] @ self.weights[held[i, at[begin:end]]]
                begin = end
        out /= np.where(own > 0, own, 1).astype(np.float32)[:, None]
        return out

    def sums(self, ranges: tuple[np.ndarray, np.ndarray, np.ndarray], w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(s, l): of the strings in ``ranges``, ``values(strings) @ w`` is s over the root of the own kernel, which is at least l."""
        flat, begin, sizes = ranges
        out, least = np.zeros(len(begin)), np.ones(len(begin))
        if not len(begin) or not self.landmarks:
            return out, least
        # In doubles: in floats the sum of a string would depend on those beside it.
        table = self.weights @ np.asarray(w, dtype=float)
        if self.place is None:
            for rows, codes in self._lengths(ranges, lambda n: n * n * 3):
                places, weights = _subsequences(len(codes))
                least[rows] = _least_own(len(codes))
                out[rows] = weights @ table[self._rows(self._coded(codes.T, places))]
            return out, least
        every = table[self.place]
        for rows, letters in self._lengths((self.letter[flat], begin, sizes), lambda n: n * n * 3, self.letter[2:4].tolist()):
            # For each first place: its letter with all later pairs, which stand together.
            letters, size = letters.astype(np.intp), len(letters)
            least[rows] = _least_own(size)
            second, third = np.triu_indices(size, 1)
            pairs = letters[second] * self.letters + letters[third]
            high = letters * self.letters ** 2
            total = np.zeros(len(rows))
            for first in range(size - 2):
                later = np.searchsorted(second, first + 1)
                weights = DECAY ** (third[later:] - first + 1.0)
                total += weights @ every.take(pairs[later:] + high[first])
            out[rows] = total
        return out, least

    def weighed(self, strings: list[str], w: np.ndarray) -> np.ndarray:
        """``values(strings) @ w``, without the values."""
        own = self.owns(strings)
        return self.sums(_ranges(strings), w)[0] / np.where(own > 0, own, 1)


class WordValues:
    """The strengths of the words met: of a word's windows the highest.

    ``kind`` "value": w.v of a window's kernel vector v; "nearest": max(w * v * v).
    """

    def __init__(self, landmarks: list[str], weights: list[float], kind: str):
        self.kernel, self.weights, self.kind = Kernel(landmarks), np.array(weights), kind
        self.most = max(JOINED, *map(len, landmarks))
        self.known: dict[bytes, float] = {}

    def units(self, text: str) -> set[bytes]:
        return every_unit(text, self.most)

    def _strengths(self, windows: list[str]) -> np.ndarray:
        if self.kind == "value":
            return self.kernel.weighed(windows, self.weights)
        return np.concatenate([(self.kernel.values(windows[at:at + 20000]) ** 2 * self.weights).max(axis=1, initial=0)
                               for at in range(0, max(len(windows), 1), 20000)])

    @staticmethod
    def _windows(words: list[bytes]) -> tuple[list[bytes], list[str]]:
        """(word, window) of every window of ORDER characters or more of the words."""
        if not words:
            return [], []
        owner, windows = list(words), b" ".join(words).decode().split(" ")  # a word has no blank
        sizes = list(map(len, windows))
        if max(sizes) > LONGEST_UNIT:
            for at in [i for i, n in enumerate(sizes) if n > LONGEST_UNIT]:
                pieces = unit_windows(windows[at])
                windows[at], sizes[at] = pieces[0], LONGEST_UNIT
                windows += pieces[1:]
                owner += [owner[at]] * (len(pieces) - 1)
                sizes += map(len, pieces[1:])
        used = [n >= ORDER for n in sizes]
        return list(itertools.compress(owner, used)), list(itertools.compress(windows, used))

    @staticmethod
    def _best(owner: list[bytes], strengths: list[float]) -> dict[bytes, float]:
        best = dict(zip(owner, strengths))
        if len(best) < len(owner):
            for word, strength in zip(owner, strengths):
                best[word] = max(best[word], strength)
        return best

    def learn(self, words: set[bytes]) -> None:
        """All words of ``words`` become known."""
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        owner, windows = self._windows(list(words - self.known.keys()))
        self.known.update(self._best(owner, self._strengths(windows).tolist()))

    def highest(self, documents: Units | list[set[bytes]], many: int) -> list[list[float]]:
        """The ``many`` highest values of the units of each document, the highest first.

        A unit's sum over its subsequences is cheap; its own kernel is not, and
        is not less than that of a unit without repeated characters.  So every
        unit is bounded, and only those that may be among the highest are
        valued: the result is that of valuing all.
        """
        units = documents if isinstance(documents, Units) else Units.of_sets(documents)
        value, bound = np.full(len(units.begin), np.nan), np.full(len(units.begin), -np.inf)
        total = np.zeros(len(value))
        usual = np.flatnonzero((units.size >= ORDER) & (units.size <= LONGEST_UNIT))
        total[usual], least = self.kernel.sums((units.codes, units.begin[usual], units.size[usual]), self.weights)
        bound[usual] = np.maximum(total[usual], 0) / least * (1 + 1e-12)
        if len(longer := np.flatnonzero(units.size > LONGEST_UNIT)):  # these have several windows; valued at once
            words = [s.encode() for s in units.strings(longer)]
            owner, windows = self._windows(words)
            best = self._best(owner, self._strengths(windows).tolist())
            value[longer] = bound[longer] = [best[w] for w in words]
        ranked = np.flatnonzero(bound[units.unit] > -np.inf)
        doc, unit = units.doc[ranked], units.unit[ranked]

        def learn(wanted):
            wanted = np.unique(wanted[np.isnan(value[wanted])])
            owns = self.kernel.owns(units.strings(wanted))
            value[wanted] = total[wanted] / np.where(owns > 0, owns, 1)

        def top(doc, found):
            """(place, rank) of the highest of each document, by document and rank; ``doc`` is rising."""
            order = np.lexsort((-found, doc))
            rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
            return order[rank < many], rank[rank < many]

        place, _ = top(doc, bound[unit])
        learn(unit[place])
        # The least of as many values as asked for: no unit with a lower bound is among the highest.
        floor = np.full(len(units.counts), np.inf)
        np.minimum.at(floor, doc[place], value[unit[place]])
        floor[np.bincount(doc[place], minlength=len(floor)) < many] = -np.inf
        learn(unit[bound[unit] > floor[doc]])
        valued = np.flatnonzero(~np.isnan(value[unit]))
        place, rank = top(doc[valued], value[unit[valued]])
        best = np.full((len(floor), many), np.nan)
        best[doc[valued[place]], rank] = value[unit[valued[place]]]
        return [row[:n] for row, n in zip(best.tolist(), (~np.isnan(best)).sum(axis=1).tolist())]

    def sentences(self, text: str) -> list[bytes]:
        """The strongest unit of each sentence of a text that has one, by rising strength."""
        found = []
        for sentence in _SENTENCE.split(text):
            held = [(self.known[w], w) for w in self.units(sentence) if w in self.known]
            if held:
                found.append(max(held))
        return [w for _, w in sorted(found)]

    def vectors(self, words: list[bytes]) -> np.ndarray:
        """The kernel vector of each word's strongest window."""
        best = []
        for word in words:
            pieces = [p for p in unit_windows(word.decode()) if len(p) >= ORDER]
            best.append(pieces[0] if len(pieces) == 1 else pieces[int(self._strengths(pieces).argmax())])
        return self.kernel.values(best)


_KEPT: dict[tuple, WordValues] = {}


def _word_values(landmarks: list[str], weights: list[float], kind: str) -> WordValues:
    """A Python worker keeps the last one for its later tasks."""
    mark = (tuple(landmarks), tuple(weights), kind)
    if mark not in _KEPT:
        _KEPT.clear()
        _KEPT[mark] = WordValues(landmarks, weights, kind)
    return _KEPT[mark]


def _slices(values: WordValues, texts: list[str | None], size: int = 500):
    """(text, its units) in slices of texts."""
    for at in range(0, len(texts), size):
        yield [(t or "", values.units(t or "")) for t in texts[at:at + size]]


def _unit_slices(values: WordValues, texts: list[str | None]):
    """The units of slices of texts, bounded in texts and, but for a single text, in characters."""
    held, chars = [], 0
    for text in texts:
        if held and (len(held) == SLICE_TEXTS or chars + len(text or "") > SLICE_CHARS):
            yield Units.of_texts(held, values.most)
            held, chars = [], 0
        held.append(text or "")
        chars += len(text or "")
    if held:
        yield Units.of_texts(held, values.most)


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 1000.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the bias) of the squared-hinge SVM with balanced classes, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y <= 0).sum(), 1)) * cost
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        xs, ws = x[inside], weight[inside]
        new = np.linalg.solve(ridge + (xs * ws[:, None]).T @ xs, (xs * ws[:, None]).T @ y[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


def logistic_curve(x: np.ndarray, y: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Weights (the last is the offset) of the logistic curve of y on the columns of x, with smoothed targets."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([1e-2] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    w[-1] = math.log((up + 1) / (down + 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)),
                               x.T @ (p - target) + ridge @ w)
        w = w - step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-9:
            break
    return w


def document_features(best: list[float], units: int) -> list[float]:
    """The three highest decision values of a document's units and the logarithm of their number."""
    return best + [0.0] * (3 - len(best)) + [math.log1p(units)]


def fit(bags: list[tuple[int, np.ndarray]], landmarks: list[str], rounds: int = 5) -> list[float]:
    """Weights of the kernel values, from (label, sentence vectors by rising rank) of the training documents."""
    kernel = Kernel(landmarks)
    values, vectors = np.linalg.eigh(np.array(kernel.values(landmarks), dtype=float))
    keep = values > 1e-3
    root = vectors[:, keep] / np.sqrt(values[keep])
    zero = np.zeros((1, len(landmarks)))
    spaced = [(label, (np.asarray(v, dtype=float) if len(v) else zero) @ root) for label, v in bags]
    owner = np.concatenate([np.full(len(v), i) for i, (_, v) in enumerate(spaced)])
    toxic = np.array([bool(label) for label, _ in spaced])
    x = np.vstack([v for _, v in spaced])
    at = np.arange(len(x))
    chosen = np.zeros(len(spaced), dtype=np.int64)
    np.maximum.at(chosen, owner, at)  # the vectors of a document come by rising strength
    for _ in range(rounds):
        used = np.concatenate([at[~toxic[owner]], chosen[toxic]])
        w = linear_svm(x[used], np.where(toxic[owner[used]], 1.0, -1.0))
        decision = x @ w[:-1] + w[-1]
        order = np.lexsort((decision, owner))
        chosen[owner[order]] = order  # the last of each document: its highest decision value
    return (root @ w[:-1]).tolist()


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, seed: int = 5) -> DataFrame:
    """(row number, label, text) of at most ``most`` texts of either label, of at most ``most`` ids that are not held out."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").alias("s_id")).agg(F.max("toxic").cast("int").alias("s_label")))
    by_hash = [F.xxhash64(F.lit(seed), F.col("s_id")), F.col("s_id")]
    picked = None
    for label in (0, 1):
        part = known.where((F.col("s_label") > 0) == F.lit(bool(label))).orderBy(*by_hash).limit(most)
        picked = part if picked is None else picked.union(part)
    # At most 2 * most rows of two numbers: a proven bound for the broadcast.
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("s_text")).join(
        F.broadcast(picked), F.col("doc_id") == F.col("s_id"))
    # Equal texts are one row, toxic if one of them is; an id may have many texts, so rows are bounded too.
    texts = sample.groupBy("s_text").agg(F.min("s_id").alias("s_id"), F.max("s_label").alias("s_label"))
    rows = None
    for label in (0, 1):
        part = (texts.where((F.col("s_label") > 0) == F.lit(bool(label)))
                .orderBy(F.xxhash64(F.lit(seed), F.col("s_id")), F.xxhash64("s_text"), "s_text").limit(most))
        rows = part if rows is None else rows.union(part)
    numbered = rows.select(F.monotonically_increasing_id().alias("s_id"),
                           (F.col("s_label") > 0).cast("int").alias("s_label"), "s_text")
    # A limit leaves one partition for each label; the sample is worked on in more.
    return written(numbered.repartition(SAMPLE_PARTS, "s_id"), "toxicity-sample")


def choose_landmarks(sample: DataFrame, most: int = LANDMARKS, most_clean: int = CLEAN_LANDMARKS) -> list[tuple[str, float]]:
    """(unit, worth) of the landmarks.

    They are the units with the highest z-score between their document
    frequencies in toxic and in other documents, and clean units near them.
    """
    def run(batches):
        counts = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                counts[label].update({u for w in every_unit(text)
                                      if ORDER <= len(u := w.decode()) <= LONGEST_UNIT})
        units = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(units, type=pa.string()),
             *[pa.array([c[u] for u in units], type=pa.int64()) for c in counts]], names=["u", "clean", "toxic"])

    sizes = {r["s_label"]: r["n"] for r in sample.groupBy("s_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n, m = sizes.get(1, 0), sizes.get(0, 0)
    share = (F.col("toxic") + F.col("clean") + 1) / (n + m + 2)
    z = (F.col("toxic") / n - F.col("clean") / m) / F.sqrt(share * (1 - share) * (1 / n + 1 / m))
    counts = written(sample.mapInArrow(run, "u string, clean bigint, toxic bigint")
                     .groupBy("u").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxicity-units")
    ranked = counts.select("u", z.alias("z")).orderBy(F.col("z").desc(), "u").limit(most * 4).collect()
    if not ranked:
        return []
    likeness = Kernel([r["u"] for r in ranked]).values([r["u"] for r in ranked])
    picked: list[int] = []
    for i in range(len(ranked)):  # a unit much like one picked before adds little
        if len(picked) < most and (not picked or likeness[i, picked].max() < ALIKE):
            picked.append(i)
    best = [ranked[i] for i in picked]
    apart = [r["u"] for r in best]
    clean = counts.where((F.col("toxic") * m <= F.col("clean") * n) & ~F.col("u").isin(apart))
    common = clean.orderBy(F.col("clean").desc(), "u").limit(CANDIDATES).collect()
    likeness = Kernel(apart).values([r["u"] for r in common]).max(axis=1, initial=0)
    like = sorted(zip((likeness ** 4 * np.array([r["clean"] for r in common])).tolist(), (r["u"] for r in common)))
    return ([(r["u"], min(max(r["z"], 0.0), SURE)) for r in best]
            + [(u, 0.0) for weight, u in like[::-1][:most_clean] if weight > 0])


def train(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> dict:
    """The model, from a bounded sample of the labelled documents."""
    sample = training_sample(docs, labels, most)
    share = {r["s_label"]: r["n"] for r in sample.groupBy("s_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(share) < 2:
        return {"constant": float(share.get(1, 0) > 0)}
    chosen = choose_landmarks(sample)
    if not chosen:  # no text has a unit: nothing tells the labels apart
        return {"constant": share[1] / (share[0] + share[1])}
    landmarks, worth = map(list, zip(*chosen))

    def sentences(weights, kind):
        def run(batches):
            values = _word_values(landmarks, weights, kind)
            for batch in batches:
                rows = []
                for part in _slices(values, batch.column(2).to_pylist()):
                    values.learn(set().union(*(w for _, w in part)))
                    rows += [values.vectors(values.sentences(text)[-SENTENCES:]).tobytes() for text, _ in part]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], pa.array(rows, type=pa.binary())], names=["id", "label", "vectors"])

        # The vectors travel as bytes: as lists of numbers they would take ten times the driver's memory.
        found = sample.mapInArrow(run, "id bigint, label int, vectors binary").collect()
        return {r["id"]: (r["label"], np.frombuffer(r["vectors"], dtype=np.float32).reshape(-1, len(landmarks)))
                for r in sorted(found)}

    # The second round adds the sentences that the first model ranks highest: the hard ones of the clean documents.
    first = sentences(worth, "nearest")
    weights = fit(list(first.values()), landmarks)
    second = sentences(weights, "value")
    weights = fit([(label, np.vstack([vectors, second[i][1]])) for i, (label, vectors) in first.items()], landmarks)
    features = sample.mapInArrow(_featured(landmarks, weights, 2, [1]), "label int, features array<double>").collect()
    curve = logistic_curve(np.array([r["features"] for r in sorted(features)]),
                           np.array([1.0 if r["label"] else -1.0 for r in sorted(features)]))
    return {"landmarks": landmarks, "weights": weights, "curve": curve.tolist()}


def _featured(landmarks: list[str], weights: list[float], at: int, kept: list[int], finish=None):
    """Function over Arrow batches: the columns ``kept`` and the document features of the texts in column ``at``."""
    def run(batches):
        values = _word_values(landmarks, weights, "value")
        for batch in batches:
            rows = []
            for units in _unit_slices(values, batch.column(at).to_pylist()):
                rows += [document_features(best, n) for best, n in zip(values.highest(units, 3), units.counts.tolist())]
            last = pa.array(rows, type=pa.list_(pa.float64())) if finish is None else finish(rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], last],
                                             names=[*[batch.schema.names[i] for i in kept], "features"])

    return run


def scored(docs: DataFrame, model: dict, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text (0 to 1; higher: more likely toxic)."""
    at = docs.columns.index(text)
    names = [n for n in docs.columns if n.lower() != score]
    kept = [docs.columns.index(n) for n in names]

    if "constant" in model:
        return docs.select(*names, F.lit(model["constant"]).alias(score))
    curve = np.array(model["curve"])

    def finish(rows):
        f = np.array(rows).reshape(-1, 4) @ curve[:-1] + curve[-1]
        return pa.array((1 / (1 + np.exp(-np.clip(f, -35, 35)))).tolist(), type=pa.float64())

    schema = StructType([*[docs.schema.fields[i] for i in kept], StructField(score, DoubleType())])
    run = _featured(model["landmarks"], model["weights"], at, kept, finish)

    def renamed(batches):
        for batch in run(batches):
            yield batch.rename_columns([*names, score])

    return docs.mapInArrow(renamed, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``docs`` without those whose score is at least ``cut``."""
    model, score = train(docs, labels), "tox_score"
    while score in {c.lower() for c in docs.columns}:
        score += "_"
    return scored(docs, model, score=score).where(F.col(score) < cut).drop(score)
