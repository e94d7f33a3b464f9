"""Bidirectional FM-index over a delimited vocabulary, and the search schemes for one error, with numpy.

The text is ``$word$word$...$`` over dense symbols: 0 ends it, 1 is the delimiter, letters come from 2 in code-point order.
A pattern is an interval of suffix ranks in the text and the interval of its reverse in the reversed text, of equal
size. Adding a symbol on one side narrows the interval of that side by a rank query; the other one moves
by the number of smaller symbols. All steps work on arrays of patterns at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

END, DELIMITER, FIRST_LETTER = 0, 1, 2

#: patterns that are searched together
CHUNK = 8192


class WaveletMatrix:
    """Rank queries over a sequence of small numbers, by one bit vector per bit."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.ones, self.zeros = [], []
        rest = symbols
        for shift in range(self.levels - 1, -1, -1):
            bit = (rest >> shift & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(np.int32(len(rest) - self.ones[-1][-1]))
            rest = np.concatenate([rest[~bit], rest[bit]])
        #: where the symbols of one kind begin, once they are sorted by their bits
        self.begin = np.zeros(size, np.int32)
        for symbol in range(size):
            at = np.int32(0)
            for level in range(self.levels):
                ones = self.ones[level][at]
                at = self.zeros[level] + ones if symbol >> (self.levels - 1 - level) & 1 else at - ones
            self.begin[symbol] = at

    def count(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How often ``symbol`` stands before ``lo`` and before ``hi``, and how many smaller ones stand between."""
        less = np.zeros_like(lo)
        first = self.begin[symbol]
        for level in range(self.levels):
            one = (symbol >> (self.levels - 1 - level) & 1).astype(bool)
            ones_lo, ones_hi = self.ones[level][lo], self.ones[level][hi]
            less += np.where(one, (hi - lo) - (ones_hi - ones_lo), 0)
            lo = np.where(one, self.zeros[level] + ones_lo, lo - ones_lo)
            hi = np.where(one, self.zeros[level] + ones_hi, hi - ones_hi)
        return lo - first, hi - first, less

    def kinds(self, lo: np.ndarray, hi: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, ...]:
        """The kinds of symbols greater than ``above`` between ``lo`` and ``hi``: the row, the symbol, and its counts as from ``count``."""
        row, symbol = np.arange(len(lo)), np.zeros(len(lo), np.int32)
        less = np.zeros_like(lo)
        for level in range(self.levels):
            shift = self.levels - 1 - level
            ones_lo, ones_hi = self.ones[level][lo], self.ones[level][hi]
            zero_lo, zero_hi = lo - ones_lo, hi - ones_hi
            # a branch without symbols, or with only such as are not above, is left
            least = above[row] >> shift
            low = (zero_hi > zero_lo) & ((symbol << 1) >= least)
            high = (ones_hi > ones_lo) & ((symbol << 1 | 1) >= least)
            row = np.concatenate([row[low], row[high]])
            symbol = np.concatenate([symbol[low] << 1, symbol[high] << 1 | 1])
            less = np.concatenate([less[low], (less + zero_hi - zero_lo)[high]])
            lo = np.concatenate([zero_lo[low], (self.zeros[level] + ones_lo)[high]])
            hi = np.concatenate([zero_hi[low], (self.zeros[level] + ones_hi)[high]])
        keep = symbol > above[row]
        row, symbol, lo, hi, less = (x[keep] for x in (row, symbol, lo, hi, less))
        first = self.begin[symbol]
        return row, symbol, lo - first, hi - first, less


def suffix_order(text: np.ndarray, size: int) -> np.ndarray:
    """Suffixes of ``text`` (numbers below ``size``, the last one smaller than all others) in order, by prefix doubling."""
    n, bits = len(text), max(1, int(size - 1).bit_length())
    if n == 1:
        return np.zeros(1, np.int64)
    width = 62 // bits
    key = np.zeros(n, np.int64)
    padded = np.concatenate([text.astype(np.int64), np.zeros(width, np.int64)])
    for i in range(width):
        key = key << bits | padded[i:i + n]
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        after = np.concatenate([rank[width:] + 1, np.zeros(min(width, n), np.int64)])[:n]
        key = rank * (n + 1) + after
        width *= 2


@dataclass
class Patterns:
    """Intervals of patterns: begin in the text, begin of the reverse in the reversed text, size."""

    lo: np.ndarray
    lo_reverse: np.ndarray
    size: np.ndarray

    def pick(self, which: np.ndarray) -> Patterns:
        return Patterns(self.lo[which], self.lo_reverse[which], self.size[which])

    def put(self, which: np.ndarray, other: Patterns) -> None:
        self.lo[which], self.lo_reverse[which], self.size[which] = other.lo, other.lo_reverse, other.size


class Vocabulary:
    """An index of distinct words, given in code-point order."""

    def __init__(self, words: list[str]):
        self.length = np.array([len(w) for w in words], np.int32)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        letters, codes = np.unique(points, return_inverse=True)
        size = len(letters) + FIRST_LETTER
        # delimiter, word, delimiter, word, ..., delimiter, end
        self.at = np.cumsum(self.length + 1, dtype=np.int64) - self.length
        text = np.full(len(points) + len(words) + 2, DELIMITER, np.int32)
        text[-1] = END
        is_letter = np.ones(len(text), bool)
        is_letter[np.concatenate([self.at - 1, [len(text) - 2, len(text) - 1]])] = False
        text[is_letter] = codes + FIRST_LETTER
        self.text = text
        self.below = np.searchsorted(np.sort(text), np.arange(size)).astype(np.int32)
        reverse = np.concatenate([text[-2::-1], text[-1:]])
        self.left, self.right = (WaveletMatrix(t[suffix_order(t, size) - 1], size) for t in (text, reverse))

    def everything(self, n: int) -> Patterns:
        """``n`` empty patterns."""
        return Patterns(np.zeros(n, np.int32), np.zeros(n, np.int32), np.full(n, len(self.text), np.int32))

    def extend_left(self, found: Patterns, symbol: np.ndarray) -> Patterns:
        lo, hi, less = self.left.count(symbol, found.lo, found.lo + found.size)
        return Patterns(self.below[symbol] + lo, found.lo_reverse + less, hi - lo)

    def extend_right(self, found: Patterns, symbol: np.ndarray) -> Patterns:
        lo, hi, less = self.right.count(symbol, found.lo_reverse, found.lo_reverse + found.size)
        return Patterns(found.lo + less, self.below[symbol] + lo, hi - lo)

    def choices(self, found: Patterns, above: np.ndarray, to_right: bool) -> tuple[np.ndarray, Patterns]:
        """All extensions by a letter greater than ``above``: the row they come from, the longer patterns."""
        if to_right:
            row, symbol, lo, hi, less = self.right.kinds(found.lo_reverse, found.lo_reverse + found.size, above)
            return row, Patterns(found.lo[row] + less, self.below[symbol] + lo, hi - lo)
        row, symbol, lo, hi, less = self.left.kinds(found.lo, found.lo + found.size, above)
        return row, Patterns(self.below[symbol] + lo, found.lo_reverse[row] + less, hi - lo)

    def letter(self, word: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Symbols of words; the delimiter at the places before the first and after the last letter."""
        return self.text[self.at[word] + place]

    def _follow(self, found: Patterns, word: np.ndarray, place: np.ndarray, to_right: bool) -> tuple[np.ndarray, np.ndarray]:
        """Match the letters of ``word`` from ``place`` on, the delimiter included: surviving rows and the words they met."""
        rows, met_rows, met = np.arange(len(word)), [], []
        step, extend = (1, self.extend_right) if to_right else (-1, self.extend_left)
        while len(rows):
            symbol = self.letter(word, place)
            found = extend(found, symbol)
            alive = found.size > 0
            done = alive & (symbol == DELIMITER)
            met_rows.append(rows[done])
            # row 0 is the end, row 1 the last delimiter; the words follow in their order
            met.append(found.lo[done] - 2)
            on = alive & ~done
            found, rows, word, place = found.pick(on), rows[on], word[on], place[on] + step
        return (np.concatenate(met_rows), np.concatenate(met)) if met else (rows, rows)

    def one_error(self, word: np.ndarray, same_length: np.ndarray, begin: np.ndarray, end: np.ndarray,
                  to_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of words at one error, each pair once: numbers of the two.

        A row asks for the words that ``word`` turns into by replacing a letter with a greater one (``same_length``) or by
        leaving a letter out (else), where the first letters at which the two differ stand at a place from ``begin`` to ``end`` (exclusive).
        ``to_right``: the half before ``begin`` is matched exactly, from its inner end to the delimiter, and then extended to
        the right; else the half from ``end`` on is matched and extended to the left.
        """
        pairs = [(word[:0], word[:0])]
        for right in (True, False):
            rows = np.flatnonzero(to_right == right)
            for chunk in np.split(rows, range(CHUNK, len(rows), CHUNK)):
                if len(chunk):
                    search = self._to_right if right else self._to_left
                    pairs += search(word[chunk], same_length[chunk], begin[chunk].astype(np.int64), end[chunk].astype(np.int64))
        return np.concatenate([a for a, _ in pairs]), np.concatenate([b for _, b in pairs])

    def _exactly(self, word: np.ndarray, begin: np.ndarray, end: np.ndarray, to_right: bool) -> Patterns:
        """Patterns of the letters from ``begin`` to ``end``, matched in the given direction."""
        found = self.everything(len(word))
        place = begin.copy() if to_right else end - 1
        while len(on := np.flatnonzero((found.size > 0) & (place < end if to_right else place >= begin))):
            extend = self.extend_right if to_right else self.extend_left
            found.put(on, extend(found.pick(on), self.letter(word[on], place[on])))
            place[on] += 1 if to_right else -1
        return found

    def _errors_at(self, found: Patterns, word: np.ndarray, same_length: np.ndarray, place: np.ndarray,
                   to_right: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pairs whose words differ first at ``place``, from patterns of the letters on one side of it."""
        out, step = [], 1 if to_right else -1
        rows = np.flatnonzero(same_length)
        row, longer = self.choices(found.pick(rows), self.letter(word[rows], place[rows]), to_right)
        row = rows[row]
        met_row, met = self._follow(longer, word[row], place[row] + step, to_right)
        out.append((word[row[met_row]], met))
        # leaving out one of several equal letters gives one word: it differs first behind the last of them
        rows = np.flatnonzero(~same_length & (self.letter(word, place + 1) != self.letter(word, place)))
        met_row, met = self._follow(found.pick(rows), word[rows], place[rows] + step, to_right)
        out.append((word[rows[met_row]], met))
        return out

    def _to_right(self, word: np.ndarray, same_length: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        end = np.minimum(end, self.length[word])
        found, place, out = self._exactly(word, np.full_like(begin, -1), begin, False), begin.copy(), []
        while True:
            # a word alone in its interval has met itself only
            on = (found.size > 1) & (place < end)
            found, word, same_length, place, end = found.pick(on), word[on], same_length[on], place[on], end[on]
            if not len(word):
                return out
            out += self._errors_at(found, word, same_length, place, True)
            found, place = self.extend_right(found, self.letter(word, place)), place + 1

    def _to_left(self, word: np.ndarray, same_length: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        # the rest of both words is the same behind the letter at which they differ
        found, place, out = self._exactly(word, end, self.length[word].astype(np.int64) + 1, True), end - 1, []
        while True:
            on = (found.size > 1) & (place >= begin)
            found, word, same_length, place, begin = found.pick(on), word[on], same_length[on], place[on], begin[on]
            if not len(word):
                return out
            out += self._errors_at(found, word, same_length, place, False)
            found, place = self.extend_left(found, self.letter(word, place)), place - 1
