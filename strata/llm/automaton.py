"""Regular expressions as one minimal deterministic automaton over bytes.

Syntax: literals, ``\\`` escapes, ``[...]`` classes with ranges, groups,
``|``, ``?``, ``*``, ``+``, ``{n}``, ``{n,}``, ``{n,m}``.  A pattern becomes
a position automaton (Thompson), all patterns together are determinised by
subset construction, and equal states are merged by partition refinement.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Rule:
    """A named pattern; ``any_case`` lets its literal letters match in either case
    (classes match as written)."""

    name: str
    pattern: str
    any_case: bool = False


class _Nfa:
    """States with byte-set edges and empty edges."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for t in self.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)


def _parse(rule: Rule):
    """Syntax tree: ('set', bytes), ('seq', parts), ('or', parts), ('rep', part, low, high)."""
    text, at = rule.pattern, 0

    def alternatives():
        nonlocal at
        parts = [sequence()]
        while at < len(text) and text[at] == "|":
            at += 1
            parts.append(sequence())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def sequence():
        parts = []
        while at < len(text) and text[at] not in "|)":
            parts.append(repeated())
        return ("seq", parts)

    def repeated():
        nonlocal at
        part = atom()
        while at < len(text) and text[at] in "?*+{":
            sign = text[at]
            at += 1
            if sign == "{":
                low, comma, high = text[at:text.index("}", at)].partition(",")
                at = text.index("}", at) + 1
                part = ("rep", part, int(low), (int(high) if high else None) if comma else int(low))
            else:
                part = ("rep", part, int(sign == "+"), 1 if sign == "?" else None)
        return part

    def one_byte():
        nonlocal at
        sign = text[at]
        at += 1
        if sign == "\\":
            sign = text[at]
            at += 1
            if sign == "x":
                at += 2
                return int(text[at - 2:at], 16)
        return ord(sign)

    def atom():
        nonlocal at
        if text[at] == "(":
            at += 1
            part = alternatives()
            at += 1
            return part
        if text[at] == "[":
            at += 1
            found: set[int] = set()
            while text[at] != "]":
                low = high = one_byte()
                if text[at] == "-" and text[at + 1] != "]":
                    at += 1
                    high = one_byte()
                found.update(range(low, high + 1))
            at += 1
            return ("set", frozenset(found))
        b = one_byte()
        both = {b, ord(chr(b).swapcase())} if rule.any_case and b < 128 else {b}
        return ("set", frozenset(both))

    return alternatives()


def _reverse(tree):
    kind = tree[0]
    if kind == "seq":
        return ("seq", [_reverse(p) for p in reversed(tree[1])])
    if kind == "or":
        return ("or", [_reverse(p) for p in tree[1]])
    if kind == "rep":
        return ("rep", _reverse(tree[1]), *tree[2:])
    return tree


def _build(nfa: _Nfa, tree, begin: int) -> int:
    """Adds the states of ``tree`` behind ``begin``; their end state."""
    if tree[0] == "set":
        end = nfa.state()
        nfa.edges[begin].append((tree[1], end))
        return end
    if tree[0] == "seq":
        for part in tree[1]:
            begin = _build(nfa, part, begin)
        return begin
    if tree[0] == "or":
        end = nfa.state()
        for part in tree[1]:
            nfa.empty[_build(nfa, part, begin_of(nfa, begin))].append(end)
        return end
    _, part, low, high = tree
    for _ in range(low):
        begin = _build(nfa, part, begin)
    end = nfa.state()
    nfa.empty[begin].append(end)
    if high is None:
        loop = begin_of(nfa, begin)
        again = _build(nfa, part, loop)
        nfa.empty[again] += [loop, end]
    else:
        for _ in range(high - low):
            begin = _build(nfa, part, begin_of(nfa, begin))
            nfa.empty[begin].append(end)
    return end


def begin_of(nfa: _Nfa, state: int) -> int:
    """A fresh state that ``state`` reaches for nothing."""
    fresh = nfa.state()
    nfa.empty[state].append(fresh)
    return fresh


@dataclass
class Automaton:
    """``step[state, byte_class[b]]`` is the next state; state 0 begins;
    ``accepts[state]`` has bit k set where rule k matches up to here.  States
    from ``first_accepting`` on accept.  The last class resets to state 0."""

    step: np.ndarray
    byte_class: np.ndarray
    accepts: np.ndarray
    first_accepting: int


def compile_rules(rules: list[Rule], search: bool = True, backwards: bool = False) -> Automaton:
    """The minimal automaton of all rules.  ``search``: matches may begin at
    any byte; else at the first only, and a dead state (every step leads to
    itself, accepting nothing) ends the walk."""
    nfa = _Nfa()
    root = nfa.state()
    final: dict[int, int] = {}
    for k, rule in enumerate(rules):
        tree = _parse(rule)
        final[_build(nfa, _reverse(tree) if backwards else tree, begin_of(nfa, root))] = k
    sets = {edge[0] for edges in nfa.edges for edge in edges}
    signs = [tuple(b in s for s in sets) for b in range(256)]
    kinds = {s: i for i, s in enumerate(dict.fromkeys(signs))}
    byte_class = np.array([kinds[s] for s in signs], np.uint8)
    member = [signs.index(s) for s in kinds]            # a byte of each class
    start = nfa.closure([root])
    number, order, rows = {start: 0}, [start], []
    closed = [nfa.closure([s]) for s in range(len(nfa.edges))]
    for states in order:                                # subset construction
        row = []
        edges = [e for s in states for e in nfa.edges[s]]
        for b in member:
            after = (start if search else frozenset()).union(*[closed[t] for on, t in edges if b in on])
            if after not in number:
                number[after] = len(order)
                order.append(after)
            row.append(number[after])
        rows.append(row)
    step = np.array(rows, np.int64)
    accepts = np.array([sum(1 << final[s] for s in states if s in final) for states in order], np.int64)
    group = np.unique(accepts, return_inverse=True)[1]
    while True:                                         # refinement until nothing splits
        seen: dict[bytes, int] = {}
        rows = np.column_stack([group[:, None], group[step]])
        finer = np.array([seen.setdefault(r.tobytes(), len(seen)) for r in rows])
        if finer.max() == group.max():
            break
        group = finer
    first = np.unique(group, return_index=True)[1]      # a member of each group
    ranked = sorted(range(len(first)), key=lambda g: (accepts[first[g]] > 0, g != group[0], g))
    place = np.empty(len(first), np.int64)
    place[ranked] = np.arange(len(first))
    step = place[group[step[first[ranked]]]]
    accepts = accepts[first[ranked]]
    step = np.column_stack([step, np.zeros(len(step), np.int64)])
    return Automaton(step, byte_class, accepts, int(np.searchsorted(accepts > 0, True)))
