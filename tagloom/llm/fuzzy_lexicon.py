"""A lexicon of word stems that finds misspelled words.

The Levenshtein automata of all stems, intersected with the trie of the stems, are one
automaton over the characters of a text's word. Its states are sets of ``(node, edits, wanted)``
and are built when first reached, so a word costs one look-up per character until the
automaton fails, mostly within the first letters. An edit is a letter more, less or
other, or two letters swapped; of a swap, ``wanted`` is the letter that must come next.
"""

from __future__ import annotations

from collections.abc import Mapping

#: States kept; with more, the table starts anew.
STATES = 200_000


class FuzzyLexicon:
    """``stems`` maps a stem to its weight. A word matches if a start of it is within the edits that the stem has.

    These follow from its length, and are at most ``edits[stem]`` where that is given.
    """

    def __init__(self, stems: Mapping[str, float], one_edit_from: int = 5, two_edits_from: int = 9, edits: Mapping[str, int] | None = None):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[tuple[float, int]] = [(0.0, -1)]
        for stem, weight in stems.items():
            node = 0
            for c in stem:
                if c not in self.children[node]:
                    self.children.append({})
                    self.ends.append((0.0, -1))
                    self.children[node][c] = len(self.children) - 1
                node = self.children[node][c]
            by_length = (len(stem) >= one_edit_from) + (len(stem) >= two_edits_from)
            self.ends[node] = (weight, min(by_length, (edits or {}).get(stem, by_length)))
        self.most = [0] * len(self.children)
        for node in range(len(self.children) - 1, -1, -1):
            self.most[node] = max([self.ends[node][1], *(self.most[k] for k in self.children[node].values())])
        self._restart()

    def _restart(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.found: list[tuple[float, int] | None] = []
        self.steps: list[dict[str, int]] = []
        self.first = self._number({(0, 0, "")})

    def _number(self, items: set[tuple[int, int, str]]) -> int:
        """The state of some items and of those reached by skipping letters of a stem; -1 if there are none."""
        least: dict[tuple[int, str], int] = {}
        todo = list(items)
        while todo:
            node, edits, wanted = todo.pop()
            if edits > self.most[node] or least.get((node, wanted), 99) <= edits:
                continue
            least[node, wanted] = edits
            if not wanted:
                todo += [(child, edits + 1, "") for child in self.children[node].values()]
        key = frozenset((node, edits, wanted) for (node, wanted), edits in least.items())
        if not key:
            return -1
        if key not in self.numbers:
            hits = [(edits, -self.ends[n][0]) for n, edits, wanted in key if not wanted and edits <= self.ends[n][1]]
            self.numbers[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.found.append((-min(hits)[1], min(hits)[0]) if hits else None)
        return self.numbers[key]

    def _step(self, state: int, c: str) -> int:
        items: set[tuple[int, int, str]] = set()
        for node, edits, wanted in self.sets[state]:
            if wanted:
                if wanted == c:
                    items.add((node, edits, ""))
                continue
            items.add((node, edits + 1, ""))
            for letter, child in self.children[node].items():
                items.add((child, edits + (letter != c), ""))
                if letter != c and c in self.children[child]:
                    items.add((self.children[child][c], edits + 1, letter))
        out = self.steps[state][c] = self._number(items)
        return out

    def match(self, word: str) -> tuple[float, int] | None:
        """Weight and edits of the closest stem, the heaviest of equals, at any start of the word."""
        if len(self.sets) > STATES:
            self._restart()
        state, best = self.first, None
        if state < 0:
            return None
        for c in word:
            state = found if (found := self.steps[state].get(c)) is not None else self._step(state, c)
            if state < 0:
                break
            hit = self.found[state]
            if hit and (best is None or (hit[1], -hit[0]) < (best[1], -best[0])):
                best = hit
        return best
