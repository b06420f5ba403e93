"""Inference of stochastic regular grammars by state merging.

Training strings form a prefix tree with counts.  A state whose outgoing
frequencies are statistically compatible (Hoeffding bound, recursively) with an
accepted state is merged into it, and what becomes non-deterministic is folded.
The result is a deterministic probabilistic automaton that gives any string a
likelihood.  For formats only states of the same depth are merged: such an
automaton has no cycles and keeps prefixes and lengths.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

#: Share of probability that any state leaves for symbols it has not seen, over ``ALPHABET`` symbols.
UNSEEN, ALPHABET = 1e-3, 68


@dataclass
class Automaton:
    """``arcs[state][symbol] = (next state, log10 probability)``; ``ends[state]``;
    ``most[state]``: the next state most often taken, the state itself where there is none."""

    arcs: list[dict[str, tuple[int, float]]] = field(default_factory=list)
    ends: list[float] = field(default_factory=list)
    most: list[int] = field(default_factory=list)
    least: float = -math.inf

    def total(self, text: str) -> float:
        """log10 probability of ``text``, its end included.  A symbol that a state
        does not know costs its unseen share and follows the most frequent arc."""
        state, total, unseen = 0, 0.0, math.log10(UNSEEN / ALPHABET)
        for c in text:
            state, weight = self.arcs[state].get(c, (self.most[state], unseen))
            total += weight
        return total + self.ends[state]

    def score(self, text: str) -> float:
        """Mean log10 probability per symbol, the end included."""
        return self.total(text) / (len(text) + 1)

    def accepts(self, text: str) -> bool:
        return self.score(text) >= self.least


class _Node:
    """A state: strings that end here, and per symbol the next state and its flow."""

    __slots__ = ("end", "next", "flow")

    def __init__(self) -> None:
        self.end, self.next, self.flow = 0, {}, {}

    @property
    def count(self) -> int:
        return self.end + sum(self.flow.values())


def _differ(f1: int, n1: int, f2: int, n2: int, bound: float) -> bool:
    return abs(f1 / n1 - f2 / n2) > bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))


def _compatible(state: _Node, tree: _Node, bound: float) -> bool:
    work = [(state, tree)]
    while work:
        a, b = work.pop()
        n, m = a.count, b.count
        if _differ(a.end, n, b.end, m, bound):
            return False
        for c in a.flow.keys() | b.flow.keys():
            if _differ(a.flow.get(c, 0), n, b.flow.get(c, 0), m, bound):
                return False
            if c in a.next and c in b.next:
                work.append((a.next[c], b.next[c]))
    return True


def _fold(into: _Node, tree: _Node) -> None:
    """Adds ``tree`` to ``into`` and to the states that its strings reach."""
    work = [(into, tree)]
    while work:
        a, b = work.pop()
        a.end += b.end
        for c, y in b.next.items():
            a.flow[c] = a.flow.get(c, 0) + b.flow[c]
            if c in a.next:
                work.append((a.next[c], y))
            else:
                a.next[c] = y


def _tree(strings: Sequence[str]) -> _Node:
    root = _Node()
    for s in strings:
        node = root
        for c in s:
            node.flow[c] = node.flow.get(c, 0) + 1
            node = node.next.setdefault(c, _Node())
        node.end += 1
    return root


def learn(strings: Sequence[str], alpha: float = 0.05, quantile: float = 0.01, folds: int = 4, layered: bool = True) -> Automaton:
    """The merged automaton of ``strings``.  ``least`` is the score that all but a
    ``quantile`` of them reach when automata of the other folds score them: the
    strings that an automaton has seen score better than new ones of their format.
    ``layered=False`` merges across depths too: what is left of prefixes and lengths
    is what the statistics keep apart, which suits a background of many forms.
    Without folds it has no bar; without strings it accepts none."""
    if not strings:
        return Automaton([{}], [0.0], [0], math.inf)
    merge = _layered if layered else _cyclic
    out = _automaton(merge(strings, alpha))
    scores = []
    for k in range(folds):
        rest = [s for n, s in enumerate(strings) if n % folds != k]
        judge = _automaton(merge(rest, alpha)) if rest else out
        scores += [judge.score(s) for s in strings[k::folds]]
    out.least = sorted(scores)[int(quantile * len(scores))] if scores else -math.inf
    return out


def _bound(alpha: float) -> float:
    return math.sqrt(0.5 * math.log(2 / alpha))


def _layered(strings: Sequence[str], alpha: float) -> list[_Node]:
    """States of one depth are merged before those below them are looked at."""
    states = layer = [_tree(strings)]
    while layer:
        below: list[_Node] = []
        for parent in layer:
            for c in sorted(parent.next):
                node = parent.next[c]
                same = next((s for s in below if s is node or _compatible(s, node, _bound(alpha))), None)
                if same is None:
                    below.append(node)
                elif same is not node:
                    parent.next[c] = same
                    _fold(same, node)
        states, layer = states + below, below
    return states


def _cyclic(strings: Sequence[str], alpha: float) -> list[_Node]:
    """The children of accepted states are merged into any of these, or accepted."""
    states = [_tree(strings)]
    known = {id(states[0])}
    while edge := next(((r, c) for r in states for c in sorted(r.next) if id(r.next[c]) not in known), None):
        parent, c = edge
        node = parent.next[c]
        same = next((s for s in states if _compatible(s, node, _bound(alpha))), None)
        if same is None:
            known.add(id(node))
            states.append(node)
        else:
            parent.next[c] = same
            _fold(same, node)
    return states


def _automaton(states: Sequence[_Node]) -> Automaton:
    number = {id(n): k for k, n in enumerate(states)}
    out = Automaton()
    for k, n in enumerate(states):
        keep = (1 - UNSEEN) / n.count
        out.arcs.append({c: (number[id(x)], math.log10(n.flow[c] * keep)) for c, x in n.next.items()})
        out.ends.append(math.log10(max(n.end * keep, UNSEEN / ALPHABET)))
        out.most.append(number[id(n.next[max(n.flow, key=lambda c: (n.flow[c], c))])] if n.flow else k)
    return out
