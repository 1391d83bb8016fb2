"""Double-array tries over sequences of numbers, built and walked with numpy.

A state's child by a digit lies at ``base[state] + digit`` if ``check`` there names the state. So a
step is two lookups, and all states of a text take it at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: States with more children get a range of their own; others share gaps.
WIDE = 48

#: Rounds after which the table grows if some states still found no place.
PATIENCE = 40


def placed(
    parent: np.ndarray, digit: np.ndarray, radix: int, seed: int = 0
) -> tuple[np.ndarray, np.ndarray, int]:
    """(base per parent in order of first edge, slot per edge, size) without two edges in a slot.

    ``parent`` ascends. Many states look for a place at random at the same time, wide ones first;
    of those that clash one goes on. States with one child take what is left over.
    """
    rng = np.random.default_rng(seed)
    first = np.flatnonzero(np.diff(parent, prepend=-1))
    width = np.diff(np.append(first, len(parent)))
    base = np.zeros(len(first), dtype="i8")
    wide = np.flatnonzero(width > WIDE)
    base[wide] = np.arange(len(wide)) * radix
    size = len(wide) * radix + 2 * int(width[width <= WIDE].sum()) + 2 * radix
    taken = np.zeros(size, dtype=bool)

    def edges_of(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges of the groups one after the other, and where each group begins."""
        begin = np.cumsum(width[groups]) - width[groups]
        edges = np.repeat(first[groups] - begin, width[groups]) + np.arange(width[groups].sum())
        return edges, begin

    if len(wide):
        edges, _ = edges_of(wide)
        taken[np.repeat(base[wide], width[wide]) + digit[edges]] = True
    owner = np.empty(size, dtype="i8")
    for low, high in ((16, WIDE), (6, 15), (2, 5)):
        waiting = np.flatnonzero((width >= low) & (width <= high))
        rounds = 0
        while len(waiting):
            rounds += 1
            if rounds % PATIENCE == 0:
                size += size // 2
                taken = np.append(taken, np.zeros(size - len(taken), dtype=bool))
                owner = np.empty(size, dtype="i8")
            tried = rng.integers(0, size - radix, len(waiting))
            edges, begin = edges_of(waiting)
            which = np.repeat(np.arange(len(waiting)), width[waiting])
            slots = tried[which] + digit[edges]
            owner[slots] = which
            free = np.logical_and.reduceat((owner[slots] == which) & ~taken[slots], begin)
            base[waiting[free]] = tried[free]
            taken[slots[free[which]]] = True
            waiting = waiting[~free]
    single = np.flatnonzero(width == 1)
    if len(single):
        left = np.flatnonzero(~taken[radix:])[: len(single)] + radix
        base[single] = left - digit[first[single]]
    slot = np.repeat(base, width) + digit
    return base, slot, size


@dataclass(frozen=True)
class Trie:
    """Sequences of words, each word two digits; ``accept`` has a sequence's number at its end.

    ``vocabulary``: sorted hashes of the words; a word's place there is what its digits write.
    """

    vocabulary: np.ndarray
    radix: int
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray
    root: int
    sequences: int

    @classmethod
    def built(cls, words: np.ndarray, sizes: np.ndarray) -> Trie:
        """A trie of the different sequences in the lines of ``words`` (n, most words), of which
        the first ``sizes`` count."""
        used = np.arange(words.shape[1]) < sizes[:, None]
        vocabulary = np.unique(words[used])
        radix = 1 << max(1, -(-max(1, len(vocabulary) - 1).bit_length() // 2))
        symbols = np.searchsorted(vocabulary, words)
        node = np.zeros(len(words), dtype="i8")
        terminal = np.full(len(words), -1, dtype="i8")
        parents, digits, nodes = [], [], 1
        for level in range(2 * words.shape[1]):
            inside = np.flatnonzero(sizes > level // 2)
            if not len(inside):
                break
            symbol = symbols[inside, level // 2]
            digit = symbol % radix if level % 2 else symbol // radix
            edges, at = np.unique(node[inside] * radix + digit, return_inverse=True)
            parents.append(edges // radix)
            digits.append(edges % radix)
            node[inside] = nodes + at
            nodes += len(edges)
            ended = inside[(sizes[inside] == level // 2 + 1) & (level % 2 == 1)]
            terminal[ended] = node[ended]
        parent = np.concatenate([*parents, np.empty(0, "i8")]).astype("i8")
        digit = np.concatenate([*digits, np.empty(0, "i8")]).astype("i8")
        base_of, slot, size = placed(parent, digit, radix)
        # the node of edge i is i + 1; the root gets the place behind all others
        slot_of = np.concatenate([[size], slot])
        base = np.zeros(size + 1, dtype="i4")
        check = np.full(size + 1, -1, dtype="i4")
        accept = np.full(size + 1, -1, dtype="i4")
        base[slot_of[np.unique(parent)]] = base_of
        check[slot] = slot_of[parent]
        accept[slot_of[terminal]] = np.arange(len(words))
        return cls(vocabulary, radix, base, check, accept, size, len(words))

    def _step(self, state: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        to = self.base[state] + digit
        return to, self.check[to] == state

    def counts(
        self,
        words: np.ndarray,
        follows: np.ndarray,
        most: int,
        weights: np.ndarray | None = None,
    ) -> np.ndarray:
        """How often each sequence, of up to ``most`` words, begins at a word of ``words``.

        ``follows``: whether the next word goes on with the same piece of text. ``weights``: how
        often each word counts as a beginning, once if not given. All positions take their steps
        together; those without a child drop out.
        """
        total = np.zeros(self.sequences, dtype="i8")
        if not len(self.vocabulary) or not len(words):
            return total
        symbol = np.searchsorted(self.vocabulary, words)
        symbol[symbol == len(self.vocabulary)] = 0
        known = self.vocabulary[symbol] == words
        at = np.flatnonzero(known if weights is None else known & (weights > 0))
        state = np.full(len(at), self.root, dtype="i8")
        for level in range(most):
            if level:
                on = follows[at + level - 1]
                at, state = at[on], state[on]
                on = known[at + level]
                at, state = at[on], state[on]
            here = symbol[at + level]
            for digit in (here // self.radix, here % self.radix):
                digit = digit if len(digit) == len(at) else digit[live]
                state, live = self._step(state, digit)
                at, state = at[live], state[live]
            ended = self.accept[state]
            hit = ended >= 0
            # as doubles, which hold whole numbers below 2 ** 53
            each = None if weights is None else weights[at[hit]]
            n = np.bincount(ended[hit], each, minlength=self.sequences)
            total += n.astype("i8")
        return total
