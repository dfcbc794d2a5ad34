"""Suffix automaton of several sequences of words."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

NEVER = 1 << 60


class SuffixAutomaton:
    """All substrings of the given word sequences, with the sequences whose windows they hold.

    A state stands for substrings that end at the same places; `size` is its longest one, `link`
    the state of the longest suffix that ends elsewhere too. A window is `window` consecutive
    words of a sequence; a sequence of fewer words, but not none, is one window.
    """

    def __init__(self, sequences: Iterable[tuple[str, Sequence[bytes]]], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        short: dict[tuple[int, ...], set[str]] = {}
        long: list[tuple[str, list[int]]] = []
        for name, words in sequences:
            codes = [self.ids.setdefault(w, len(self.ids)) for w in words]
            if len(codes) >= window:
                long.append((name, codes))
            elif codes:
                short.setdefault(tuple(codes), set()).add(name)
            last = 0
            for c in codes:
                last = self._extend(last, c)
        #: By state: the sequences with a window whose words end here.
        self.windows: dict[int, set[str]] = {}
        #: By state: (words, names) of short sequences whose last state it is.
        self.whole: dict[int, list[tuple[int, set[str]]]] = {}
        for name, codes in long:
            state = 0
            for i, c in enumerate(codes):
                state = self.next[state][c]
                if i + 1 >= window:
                    self.windows.setdefault(self._with(state, window), set()).add(name)
        for codes, names in short.items():
            state = 0
            for c in codes:
                state = self.next[state][c]
            self.whole.setdefault(self._with(state, len(codes)), []).append((len(codes), names))
        self._spread()

    def _extend(self, last: int, c: int) -> int:
        """Append a word to the sequence that ends in `last`."""
        if (q := self.next[last].get(c)) is not None:
            return q if self.size[q] == self.size[last] + 1 else self._split(last, c, q)
        new = self._state({}, 0, self.size[last] + 1)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, c, q)
        return new

    def _state(self, following: dict[int, int], link: int, size: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """Give the substrings of `q` that are no longer than those of `p` and `c` their own state."""
        part = self._state(dict(self.next[q]), self.link[q], self.size[p] + 1)
        self.link[q] = part
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = part
            p = self.link[p]
        return part

    def _with(self, state: int, words: int) -> int:
        """The state of the last `words` words of what `state` was reached by."""
        while self.size[self.link[state]] >= words:
            state = self.link[state]
        return state

    def _spread(self) -> None:
        """Each state learns the whole sequences that are suffixes, and from which length it acts."""
        self.acts = [NEVER] * len(self.size)
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            if inherited := self.whole.get(self.link[state]):
                self.whole[state] = self.whole.get(state, []) + inherited
            if found := self.whole.get(state):
                self.acts[state] = min(words for words, _ in found)
            if self.size[state] >= self.window:
                self.acts[state] = min(self.acts[state], self.window)

    def scan(self, words: Iterable[bytes]) -> tuple[int, list[list[int]], set[str]]:
        """The number of words; merged [first, end) of those inside windows; names of the sequences.

        Keeps the longest suffix of the words so far that the automaton knows, as a state and its
        length, and so needs constant memory besides its result.
        """
        following, link, size, acts = self.next, self.link, self.size, self.acts
        known = self.ids.get
        state = length = 0
        spans: list[list[int]] = []
        names: set[str] = set()
        n = 0
        for n, word in enumerate(words, 1):
            c = known(word)
            if c is None:
                state = length = 0
                continue
            step = following[state].get(c)
            if step is None:
                while step is None and state:
                    state = link[state]
                    step = following[state].get(c)
                length = size[state]
                if step is None:
                    continue
            state = step
            length += 1
            if length >= acts[state]:
                first = n - self._found(state, length, names)
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append([first, n])
        return n, spans, names

    def _found(self, state: int, length: int, names: set[str]) -> int:
        """Add the names of the windows that end here; return how many words they cover."""
        covered = 0
        for words, owners in self.whole.get(state, ()):
            if words <= length:
                covered = max(covered, words)
                names |= owners
        if length >= self.window:
            covered = max(covered, length)
            names |= self.windows.get(self._with(state, self.window), set())
        return covered
