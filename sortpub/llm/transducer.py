"""Weighted finite-state transducers as tables, their composition, and the sum over accepting paths.

An arc reads one symbol, writes one symbol, and multiplies a coefficient.  Composed, the second machine
reads what the first writes; coefficients multiply.  ``HIT`` on the last machine's output makes an arc
count: the weight of a path is the sum of its counted coefficients, each times the value of the word
that the arc reads.  Machines may have several start states (a guess about what follows); a path counts
if it ends in a final state.
"""

from __future__ import annotations

from typing import NamedTuple

SKIP, HIT = "skip", "hit"


class Arc(NamedTuple):
    state: object
    reads: str
    next: object
    writes: str
    factor: float


class Machine(NamedTuple):
    starts: tuple
    finals: frozenset
    arcs: tuple[Arc, ...]


def machine(starts, finals, alphabet, rules: dict) -> Machine:
    """``rules``: (state, symbol) -> (next, output, factor), or None for no arc.  Every other pair of a
    state and a symbol of ``alphabet`` is a loop that passes the symbol on."""
    states = {*starts, *finals, *(s for s, _ in rules), *(to[0] for to in rules.values() if to)}
    arcs = []
    for s in sorted(states, key=str):
        for a in alphabet:
            to = rules.get((s, a), (s, a, 1.0))
            if to:
                arcs.append(Arc(s, a, *to))
    return Machine(tuple(starts), frozenset(finals), tuple(arcs))


def _by_state(arcs) -> dict:
    out: dict = {}
    for arc in arcs:
        out.setdefault(arc.state, []).append(arc)
    return out


def compose(first: Machine, second: Machine) -> Machine:
    """The machine that hands every output of ``first`` to ``second``; only states that a start reaches."""
    one = _by_state(first.arcs)
    two: dict = {}
    for arc in second.arcs:
        two.setdefault((arc.state, arc.reads), []).append(arc)
    starts = [(a, b) for a in first.starts for b in second.starts]
    known, todo, arcs = set(starts), list(starts), []
    while todo:
        a, b = state = todo.pop()
        for x in one.get(a, ()):
            for y in two.get((b, x.writes), ()):
                to = (x.next, y.next)
                arcs.append(Arc(state, x.reads, to, y.writes, x.factor * y.factor))
                if to not in known:
                    known.add(to)
                    todo.append(to)
    return Machine(tuple(starts), frozenset(s for s in known if s[0] in first.finals and s[1] in second.finals), tuple(arcs))


class Runner:
    """A composed machine with numbered states, ready to read."""

    def __init__(self, m: Machine):
        number: dict = {}
        for arc in m.arcs:
            number.setdefault(arc.state, len(number))
            number.setdefault(arc.next, len(number))
        for s in m.starts:
            number.setdefault(s, len(number))
        self.starts = [number[s] for s in m.starts]
        self.finals = {number[s] for s in m.finals if s in number}
        self.table: list[dict[str, list[tuple[int, float]]]] = [{} for _ in number]
        for arc in m.arcs:
            factor = arc.factor if arc.writes == HIT else 0.0
            self.table[number[arc.state]].setdefault(arc.reads, []).append((number[arc.next], factor))

    def weight(self, symbols: list[tuple[str, float]]) -> float:
        """Sum of the weights of all accepting paths over (symbol, value) pairs, by (paths, weight) per state."""
        now = {s: (1, 0.0) for s in self.starts}
        for symbol, value in symbols:
            after: dict[int, tuple[int, float]] = {}
            for state, (n, w) in now.items():
                for to, factor in self.table[state].get(symbol, ()):
                    m, v = after.get(to, (0, 0.0))
                    after[to] = (m + n, v + w + n * factor * value)
            now = after
        return sum((w for s, (_, w) in now.items() if s in self.finals), 0.0)
