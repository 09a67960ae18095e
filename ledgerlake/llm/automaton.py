"""Rules as one deterministic automaton over bytes.

A rule is a regular expression of literals, classes, groups, alternatives and the
repeats ? * + {m,} {m,n}, read as bytes. Rules become nondeterministic automata, subset
construction makes them deterministic, and states that cannot be told apart are merged.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass, field


@dataclass
class Nfa:
    """Edges by byte set and empty edges; state 0 is unused so that 0 can mean dead."""

    moves: list[list[tuple[frozenset, int]]] = field(default_factory=lambda: [[]])
    empty: list[list[int]] = field(default_factory=lambda: [[]])

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def closed(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for after in self.empty[todo.pop()]:
                if after not in seen:
                    seen.add(after)
                    todo.append(after)
        return frozenset(seen)


def parse(rule: str):
    """Nested tuples: ("set", bytes), ("seq", ...), ("or", ...), ("rep", part, least, most)."""
    at = 0

    def char() -> int:
        nonlocal at
        c, at = rule[at], at + 1
        if c != "\\":
            return ord(c)
        c, at = rule[at], at + 1
        if c == "x":
            at += 2
            return int(rule[at - 2 : at], 16)
        return ord(c)

    def one():
        nonlocal at
        if rule[at] == "(":
            at += 1
            inner = either()
            at += 1
            return inner
        if rule[at] != "[":
            return ("set", frozenset([char()]))
        at += 1
        members: set[int] = set()
        while rule[at] != "]":
            low = char()
            if rule[at] == "-" and rule[at + 1] != "]":
                at += 1
                members.update(range(low, char() + 1))
            else:
                members.add(low)
        at += 1
        return ("set", frozenset(members))

    def repeated():
        nonlocal at
        part = one()
        while at < len(rule) and rule[at] in "?*+{":
            sign, at = rule[at], at + 1
            if sign == "{":
                end = rule.index("}", at)
                least, comma, most = rule[at:end].partition(",")
                at = end + 1
                bounds = (int(least), int(most) if most else None if comma else int(least))
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
            part = ("rep", part, *bounds)
        return part

    def sequence():
        parts = []
        while at < len(rule) and rule[at] not in "|)":
            parts.append(repeated())
        return ("seq", *parts)

    def either():
        nonlocal at
        options = [sequence()]
        while at < len(rule) and rule[at] == "|":
            at += 1
            options.append(sequence())
        return ("or", *options)

    return either()


def backwards(tree):
    """The same rule read from its end."""
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "rep":
        return ("rep", backwards(tree[1]), *tree[2:])
    parts = [backwards(part) for part in tree[1:]]
    return (kind, *(parts[::-1] if kind == "seq" else parts))


def build(nfa: Nfa, tree, start: int) -> int:
    """Add a rule behind a state; returns the state it ends in."""
    kind = tree[0]
    if kind == "set":
        end = nfa.state()
        nfa.moves[start].append((tree[1], end))
        return end
    if kind == "seq":
        for part in tree[1:]:
            start = build(nfa, part, start)
        return start
    if kind == "or":
        end = nfa.state()
        for part in tree[1:]:
            nfa.empty[build(nfa, part, start)].append(end)
        return end
    _, part, least, most = tree
    for _ in range(least):
        start = build(nfa, part, start)
    if most is None:
        loop, end = nfa.state(), nfa.state()
        nfa.empty[start].append(loop)
        nfa.empty[build(nfa, part, loop)].append(loop)
        nfa.empty[loop].append(end)
        return end
    ends = [start]
    for _ in range(most - least):
        ends.append(build(nfa, part, ends[-1]))
    end = nfa.state()
    for each in ends:
        nfa.empty[each].append(end)
    return end


@dataclass
class Dfa:
    """``table[256 * state + byte]`` is the next state; 0 is dead when nothing can follow.

    ``marks[state]`` has bit k set where rule k has matched.
    """

    table: array
    marks: list[int]
    start: int

    def rows(self) -> list[list]:
        """Each state as a list of the next states' lists, its mark behind the 256 bytes."""
        rows = [[] for _ in self.marks]
        for i, row in enumerate(rows):
            row.extend(rows[j] for j in self.table[256 * i : 256 * i + 256])
            row.append(self.marks[i])
        return rows


def determinise(trees, search: bool, sticky: bool) -> Dfa:
    """Subset construction over all rules.

    ``search`` lets a match begin at every byte. ``sticky`` keeps a rule's mark once it
    has matched and stops following that rule, so one walk over a text says which rules
    match somewhere in it.
    """
    nfa, starts, ends = Nfa(), [], {}
    for k, tree in enumerate(trees):
        first = nfa.state()
        last = build(nfa, tree, first)
        starts.append((k, nfa.closed([first]), range(first, len(nfa.moves))))
        ends[last] = k
    of = {state: k for k, _, states in starts for state in states}

    classes: dict[tuple, int] = {}
    sets = {s for moves in nfa.moves for s, _ in moves}
    kind = [classes.setdefault(tuple(b in s for s in sets), len(classes)) for b in range(256)]
    example = [kind.index(c) for c in range(len(classes))]

    def seen(states, mark: int):
        found = 0
        for state in states:
            if state in ends:
                found |= 1 << ends[state]
        if not sticky:
            return frozenset(states), found
        mark |= found
        return frozenset(s for s in states if not mark >> of[s] & 1), mark

    first = seen(frozenset().union(*(s for _, s, _ in starts)), 0)
    numbers, todo, steps = {(frozenset(), 0): 0, first: 1}, [(frozenset(), 0), first], {}
    for subset in todo:
        states, mark = subset
        for c, byte in enumerate(example):
            after = {to for s in states for set_, to in nfa.moves[s] if byte in set_}
            reached = set(nfa.closed(after))
            if search:
                for k, begin, _ in starts:
                    if not (sticky and mark >> k & 1):
                        reached |= begin
            following = seen(reached, mark if sticky else 0)
            if following not in numbers:
                numbers[following] = len(numbers)
                todo.append(following)
            steps[numbers[subset], c] = numbers[following]
    return minimised(len(numbers), steps, [m for _, m in todo], kind, len(example))


def minimised(count: int, steps: dict, marks: list[int], kind: list[int], classes: int) -> Dfa:
    """Merge states with equal marks whose successors are equal, until nothing changes."""
    groups: dict = {}
    group = [groups.setdefault(m, len(groups)) for m in marks]
    while True:
        again: dict = {}
        split = [
            again.setdefault((group[s], *(group[steps[s, c]] for c in range(classes))), len(again))
            for s in range(count)
        ]
        if len(again) == len(groups):
            break
        groups, group = again, split
    members: dict[int, int] = {}
    for state, g in enumerate(group):
        members.setdefault(g, state)
    table = array("i")
    for g in range(len(members)):
        state = members[g]
        table.extend(group[steps[state, kind[byte]]] for byte in range(256))
    return Dfa(table, [marks[members[g]] for g in range(len(members))], group[1])
