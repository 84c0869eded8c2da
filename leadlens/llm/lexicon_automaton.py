"""Levenshtein automata intersected with the trie of a lexicon.

One deterministic automaton accepts every word within a term's allowed edit
distance of that term, for all terms at once. A state is a set of trie nodes,
each with the fewest edits that reach it; states and transitions are made when
a word first needs them, and a word stops at the first character that no term
can still be near.
"""

from __future__ import annotations

_STATES = 200_000     # kept at most; then the cache starts anew, with the same answers


def allowed_edits(term: str) -> int:
    """None below five letters, one to eight, two from nine on."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class LexiconAutomaton:
    def __init__(self, terms: list[str]):
        self.terms = terms
        self.child: list[dict[str, int]] = [{}]
        self.term_at: list[int] = [-1]
        self.slack = [0]                    # most edits that a term below allows
        for k, term in enumerate(terms):
            node, edits = 0, allowed_edits(term)
            for ch in term:
                self.slack[node] = max(self.slack[node], edits)
                if ch not in self.child[node]:
                    self.child[node][ch] = len(self.child)
                    self.child.append({})
                    self.term_at.append(-1)
                    self.slack.append(0)
                node = self.child[node][ch]
            self.slack[node] = max(self.slack[node], edits)
            self.term_at[node] = k
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.moves: list[dict[str, int]] = []
        self.ends: list[tuple[int, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """Number of the state of these nodes and all that skipped term letters reach; -1 if none."""
        todo = list(nodes.items())
        while todo:
            node, e = todo.pop()
            for nxt in self.child[node].values():
                if e + 1 <= self.slack[nxt] and nodes.get(nxt, 9) > e + 1:
                    nodes[nxt] = e + 1
                    todo.append((nxt, e + 1))
        if not nodes:
            return -1
        key = frozenset(nodes.items())
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(nodes)
            self.moves.append({})
            self.ends.append(min(((e, self.term_at[n]) for n, e in nodes.items() if self.term_at[n] >= 0
                                  and e <= allowed_edits(self.terms[self.term_at[n]])), default=None))
        return self.ids[key]

    def _move(self, state: int, ch: str) -> int:
        after: dict[int, int] = {}
        for node, e in self.sets[state].items():
            if e + 1 <= self.slack[node]:                                # a letter too many
                after[node] = min(after.get(node, 9), e + 1)
            for letter, nxt in self.child[node].items():
                cost = e + (letter != ch)
                if cost <= self.slack[nxt]:
                    after[nxt] = min(after.get(nxt, 9), cost)
        self.moves[state][ch] = found = self._state(after)
        return found

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term number) of the nearest term within its distance."""
        if len(self.sets) > _STATES:
            self._reset()
        state = self.start
        for ch in word:
            nxt = self.moves[state].get(ch)
            if nxt is None:
                nxt = self._move(state, ch)
            if nxt < 0:
                return None
            state = nxt
        return self.ends[state]
