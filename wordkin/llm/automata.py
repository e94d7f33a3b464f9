"""Grammar inference: probabilistic automata by merging compatible states of a prefix tree.

The prefix tree reads strings as kinds of characters: digits, lower case, capitals, and every other character by itself. It counts how
often each kind follows each prefix and how often a string ends there. States are visited from the root; a state that
agrees with one already kept, in its own frequencies and in those of all states behind both, up to what chance explains (a Hoeffding bound), is
folded into it, else it is kept. What is left is a deterministic automaton. A state also knows how often each character of a
kind came, so the automaton gives each string a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: chance of taking two equal frequencies for different ones
ALPHA = 0.05
#: weight of all kinds that were not seen in a state, where an automaton is not strict
BESIDE = 0.5

_KIND = np.arange(256, dtype=np.uint8)
_KIND[48:58], _KIND[65:91], _KIND[97:123] = ord("0"), ord("A"), ord("a")
_SIZE = np.bincount(_KIND, minlength=256)
_KINDS = _KIND.tobytes()


@dataclass
class Automaton:
    """Over bytes. A strict one gives no probability to strings outside its grammar; another one takes up such a string at its root."""

    log: np.ndarray  # (states, 256): log probability of a symbol
    to: np.ndarray  # (states, 256): the state behind it
    end: np.ndarray  # (states,): log probability of an end

    def score(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log probabilities of spans of bytes, all a symbol at a time, the longest first."""
        length = ends - starts
        order = np.argsort(-length, kind="stable")
        starts, length = starts[order], length[order]
        state, total = np.zeros(len(order), np.int32), np.zeros(len(order))
        # how many spans have a symbol at each place
        left = len(length) - np.searchsorted(length[::-1], np.arange(1, length[0] + 1 if len(length) else 1))
        for place, n in enumerate(left.tolist()):
            symbol, now = data[starts[:n] + place], state[:n]
            total[:n] += self.log[now, symbol]
            state[:n] = self.to[now, symbol]
        out = np.empty(len(order))
        out[order] = total + self.end[state]
        return out


class _States:
    """The prefix tree, and what becomes of it."""

    def __init__(self, strings: list[bytes]):
        self.ends, self.follow, self.count, self.characters = [], [], [], []
        self._new()
        for string in strings:
            state = 0
            for symbol, kind in zip(string, string.translate(_KINDS), strict=True):
                after = self.follow[state].get(kind)
                if after is None:
                    after = self.follow[state][kind] = self._new()
                self.count[state][kind] = self.count[state].get(kind, 0) + 1
                self.characters[state][symbol] = self.characters[state].get(symbol, 0) + 1
                state = after
            self.ends[state] += 1

    def _new(self) -> int:
        self.ends.append(0)
        for table in (self.follow, self.count, self.characters):
            table.append({})
        return len(self.ends) - 1

    def total(self, state: int) -> int:
        return self.ends[state] + sum(self.count[state].values())

    def agree(self, one: int, two: int, bound: float) -> bool:
        """Whether the strings behind two states may be of one distribution."""
        pending = [(one, two)]
        while pending:
            one, two = pending.pop()
            n, m = self.total(one), self.total(two)
            if not n or not m:
                continue
            room = bound * (n ** -0.5 + m ** -0.5)
            if room >= 1:
                # too few strings for any difference, here and behind
                continue
            if abs(self.ends[one] / n - self.ends[two] / m) > room:
                return False
            mine, other = self.count[one], self.count[two]
            for kind in mine.keys() | other.keys():
                if abs(mine.get(kind, 0) / n - other.get(kind, 0) / m) > room:
                    return False
                if kind in mine and kind in other:
                    pending.append((self.follow[one][kind], self.follow[two][kind]))
        return True

    def fold(self, into: int, state: int) -> None:
        """Add the tree below ``state`` to ``into``."""
        pending = [(into, state)]
        while pending:
            into, state = pending.pop()
            self.ends[into] += self.ends[state]
            for symbol, n in self.characters[state].items():
                self.characters[into][symbol] = self.characters[into].get(symbol, 0) + n
            for kind, n in self.count[state].items():
                known = kind in self.count[into]
                self.count[into][kind] = self.count[into].get(kind, 0) + n
                if known:
                    pending.append((self.follow[into][kind], self.follow[state][kind]))
                else:
                    self.follow[into][kind] = self.follow[state][kind]


def infer(strings: list[bytes], strict: bool = False, alpha: float = ALPHA) -> Automaton:
    """The automaton of some strings, which is the same for any order of them."""
    states = _States(sorted(strings))
    bound = float(np.sqrt(0.5 * np.log(2 / alpha)))
    kept, edge = [0], [(0, kind) for kind in sorted(states.follow[0])]
    while edge:
        source, kind = edge.pop(0)
        state = states.follow[source][kind]
        if state in kept:
            continue
        same = next((k for k in kept if states.agree(k, state, bound)), None)
        if same is None:
            kept.append(state)
            edge += [(state, after) for after in sorted(states.follow[state])]
            continue
        states.follow[source][kind] = same
        before = {k: set(states.follow[k]) for k in kept}
        states.fold(same, state)
        # folding may give kept states new kinds
        edge += [(k, after) for k in kept for after in sorted(set(states.follow[k]) - before[k])]
    return _compiled(states, kept, strict)


def _compiled(states: _States, kept: list[int], strict: bool) -> Automaton:
    number = {state: i for i, state in enumerate(kept)}
    beside = 0.0 if strict else BESIDE
    with np.errstate(divide="ignore"):
        log = np.full((len(kept), 256), np.log(beside / 257))
        end = np.zeros(len(kept))
        to = np.zeros((len(kept), 256), np.int32)
        for state, i in number.items():
            total = states.total(state) + beside
            log[i] = np.log(beside / 257 / max(total, beside, 1e-9))
            end[i] = np.log((states.ends[state] + beside / 257) / max(total, 1e-9))
            for kind, n in states.count[state].items():
                seen = np.zeros(256)
                for symbol, k in states.characters[state].items():
                    seen[symbol] = k
                mine = _KIND == kind
                # characters that were not seen count as much as those seen once: nothing where all were seen often
                unseen = int((seen[mine] == 1).sum()) + (0 if strict else 1)
                log[i, mine] = np.log((n + beside / 257) / total * (seen[mine] + unseen / _SIZE[kind]) / (n + unseen))
                to[i, mine] = number[states.follow[state][kind]]
    return Automaton(log, to, end)
