"""Weighted finite-state transducers over the marks of a clause's words, and their composition.

Five transducers work in a row. Each reads a mark and what the one before it put out for the same
word, moves on, and puts out a kind with a factor: insults and threats find patterns, the target
machine raises what is meant for somebody, negation and reported speech weaken it. Composed they
are one machine; the best path through it is what a clause means, and its sum the clause's score.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

OTHER, INSULT, THREAT, TARGET, OBJECT, NEGATION, REPORT, MODAL = range(8)
NONE, PLAIN, TARGETED, MENACE, DENIED, QUOTED = range(6)

#: Words over which each pattern reaches.
MODAL_REACH, OBJECT_REACH, TARGET_REACH, NEGATION_REACH, REPORT_REACH = 3, 3, 6, 3, 8
#: Weights of arcs: an insult right behind another one, one for somebody, a threat that is
#: announced, and what negation and reported speech leave.
DOUBLED, AIMED, ANNOUNCED, WEAKENED = 1.25, 1.5, 1.5, 0.25

State = tuple[int, ...]
Arc = tuple[State, int, float]


@dataclass(frozen=True)
class Transducer:
    """``arcs(state, mark, kind)`` gives every move: next state, kind put out, and factor. A path
    counts if it ends where ``ends`` holds."""

    start: State
    arcs: Callable[[State, int, int], list[Arc]]
    ends: Callable[[State], bool] = lambda state: True


def _insults(state: State, mark: int, kind: int) -> list[Arc]:
    """State: was the last word an insult?"""
    if mark == INSULT:
        return [((1,), PLAIN, DOUBLED if state[0] else 1.0)]
    return [((0,), kind, 1.0)]


def _threats(state: State, mark: int, kind: int) -> list[Arc]:
    """A verb, then whom it is for; or both announced (will, going to), in that order, with the
    verb at the end. State: words left of a modal's reach, of a waiting verb's, whether that was
    announced, and words left of the reach of an object behind a modal."""
    modal, verb, strong, held = state
    later = (max(modal - 1, 0), max(verb - 1, 0), strong, max(held - 1, 0))
    if mark == MODAL:
        return [((MODAL_REACH, *later[1:]), kind, 1.0)]
    if mark == OBJECT:
        after = (later[0], 0, 0, OBJECT_REACH if modal else later[3])
        return [(after, MENACE, ANNOUNCED if strong else 1.0)] if verb else [(after, kind, 1.0)]
    if mark == THREAT:
        if modal and held:
            return [((later[0], 0, 0, later[3]), MENACE, ANNOUNCED)]
        return [((later[0], OBJECT_REACH, int(modal > 0), later[3]), kind, 1.0)]
    return [(later if later[1] else (*later[:2], 0, later[3]), kind, 1.0)]


def _targets(state: State, mark: int, kind: int) -> list[Arc]:
    """An insult is meant for a target before or behind it; for one behind it, a path owes that
    target and ends nowhere if it does not come in time. State: words left of the reach of the
    last target, and of what is owed."""
    past, owed = state
    if mark in (TARGET, OBJECT):
        return [((TARGET_REACH, 0), kind, 1.0)]
    if owed == 1:
        return []
    later = (max(past - 1, 0), max(owed - 1, 0))
    if kind != PLAIN:
        return [(later, kind, 1.0)]
    if past:
        return [(later, TARGETED, AIMED)]
    return [(later, PLAIN, 1.0), ((later[0], later[1] or TARGET_REACH), TARGETED, AIMED)]


def _weakened(mark_of: int, reach: int, becomes: int) -> Callable[[State, int, int], list[Arc]]:
    def arcs(state: State, mark: int, kind: int) -> list[Arc]:
        after = (reach,) if mark == mark_of else (max(state[0] - 1, 0),)
        if kind == NONE or not state[0]:
            return [(after, kind, 1.0)]
        return [(after, becomes, 1.0 if kind == DENIED else WEAKENED)]

    return arcs


def compose(*machines: Transducer) -> Transducer:
    """One transducer that is in all of them at once; each reads what the one before puts out."""
    sizes = [len(machine.start) for machine in machines]
    cuts = [sum(sizes[:n]) for n in range(len(sizes) + 1)]
    known: dict[tuple[State, int, int], list[Arc]] = {}

    def arcs(state: State, mark: int, kind: int) -> list[Arc]:
        key = (state, mark, kind)
        if key not in known:
            paths: list[Arc] = [((), kind, 1.0)]
            for machine, a, b in zip(machines, cuts, cuts[1:]):
                paths = [
                    (done + after, out, factor * own)
                    for done, given, factor in paths
                    for after, out, own in machine.arcs(state[a:b], mark, given)
                ]
            if len(known) > 100_000:
                known.clear()
            known[key] = paths
        return known[key]

    def ends(state: State) -> bool:
        return all(m.ends(state[a:b]) for m, a, b in zip(machines, cuts, cuts[1:]))

    return Transducer(sum((machine.start for machine in machines), ()), arcs, ends)


GRAMMAR = compose(
    Transducer((0,), _insults),
    Transducer((0, 0, 0, 0), _threats),
    Transducer((0, 0), _targets, lambda state: not state[1]),
    Transducer((0,), _weakened(NEGATION, NEGATION_REACH, DENIED)),
    Transducer((0,), _weakened(REPORT, REPORT_REACH, QUOTED)),
)


def best_path(
    marks: list[int], weights: list[float], machine: Transducer = GRAMMAR
) -> tuple[float, list[tuple[int, float]]]:
    """The highest sum over a clause, and the kind and weight of each match on its path. An
    insult weighs as much as its word, a threat one; factors of the arcs multiply that."""
    paths = {machine.start: (0.0, ())}
    for mark, weight in zip(marks, weights):
        after: dict[State, tuple[float, tuple]] = {}
        for state, (score, found) in paths.items():
            for new, kind, factor in machine.arcs(state, mark, NONE):
                gain = factor * (weight if mark == INSULT else 1.0) if kind else 0.0
                if new not in after or score + gain > after[new][0]:
                    after[new] = (score + gain, (found, kind, gain) if kind else found)
        paths = after
    score, found = max(
        (path for state, path in paths.items() if machine.ends(state)), key=lambda path: path[0]
    )
    matches = []
    while found:
        found, kind, gain = found
        matches.append((kind, gain))
    return score, matches[::-1]
