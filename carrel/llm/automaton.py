"""Byte automata for sets of rules: parsing, subset construction, minimisation.

Patterns are a subset of regular expressions over bytes: literals, ``\\xHH``
and escaped characters, classes with ranges, groups, ``|``, ``?``, ``*``,
``+``, ``{m,}`` and ``(?i:...)`` for letters in either case.
"""

import itertools
from dataclasses import dataclass

import numpy as np


def _letters(pattern, i):
    """One character, escapes resolved, and the place behind it."""
    if pattern[i] != "\\":
        return ord(pattern[i]), i + 1
    if pattern[i + 1] == "x":
        return int(pattern[i + 2 : i + 4], 16), i + 4
    return ord(pattern[i + 1]), i + 2


def _either_case(codes):
    return frozenset(codes) | {ord(chr(c).swapcase()) for c in codes if c < 128 and chr(c).isalpha()}


def parse(pattern):
    """The pattern as nested ("set", bytes), ("cat", parts), ("alt", parts), ("rep", part, least, unbounded)."""

    def alternatives(i, fold):
        parts, sequence = [], []
        while i < len(pattern) and pattern[i] != ")":
            if pattern[i] == "|":
                parts.append(("cat", sequence))
                sequence, i = [], i + 1
                continue
            piece, i = repeated(i, fold)
            sequence.append(piece)
        parts.append(("cat", sequence))
        return (parts[0] if len(parts) == 1 else ("alt", parts)), i

    def repeated(i, fold):
        piece, i = single(i, fold)
        if i < len(pattern) and pattern[i] in "?*+{":
            if pattern[i] == "{":
                end = pattern.index("}", i)
                least, comma, most = pattern[i + 1 : end].partition(",")
                if most:
                    raise ValueError("only {m} and {m,}")
                return ("rep", piece, int(least), bool(comma)), end + 1
            if pattern[i] == "?":
                return ("alt", [piece, ("cat", [])]), i + 1
            return ("rep", piece, int(pattern[i] == "+"), True), i + 1
        return piece, i

    def single(i, fold):
        if pattern[i] == "(":
            inner = fold or pattern.startswith("(?i:", i)
            piece, end = alternatives(i + 4 if pattern.startswith("(?", i) else i + 1, inner)
            return piece, end + 1
        if pattern[i] == "[":
            i, codes = i + 1, set()
            while pattern[i] != "]":
                low, i = _letters(pattern, i)
                if pattern[i] == "-" and pattern[i + 1] != "]":
                    high, i = _letters(pattern, i + 1)
                    codes |= set(range(low, high + 1))
                else:
                    codes.add(low)
            return ("set", _either_case(codes) if fold else frozenset(codes)), i + 1
        code, i = _letters(pattern, i)
        return ("set", _either_case({code}) if fold else frozenset({code})), i

    tree, end = alternatives(0, False)
    if end != len(pattern):
        raise ValueError(f"unbalanced pattern {pattern}")
    return tree


def reversed_tree(tree):
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "rep":
        return ("rep", reversed_tree(tree[1]), *tree[2:])
    parts = [reversed_tree(p) for p in tree[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


class _Nfa:
    def __init__(self):
        self.moves, self.jumps = [], []

    def state(self):
        self.moves.append(None)
        self.jumps.append([])
        return len(self.moves) - 1

    def add(self, tree, start):
        """Adds the tree behind ``start``; returns its end."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.moves[start] = (tree[1], end)
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.add(part, start)
                middle = self.state()
                self.jumps[start].append(middle)
                start = middle
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                own = self.state()
                self.jumps[start].append(own)
                self.jumps[self.add(part, own)].append(end)
            return end
        _, part, least, unbounded = tree
        start = self.add(("cat", [part] * least), start)
        if unbounded:
            loop = self.state()
            self.jumps[start].append(loop)
            own = self.state()
            self.jumps[loop].append(own)
            self.jumps[self.add(part, own)].append(loop)
            end = self.state()
            self.jumps[loop].append(end)
            return end
        return start

    def closure(self, states):
        seen, todo = set(states), list(states)
        while todo:
            for s in self.jumps[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``moves[state * classes + class]`` is the next state, times ``classes``.

    ``byte_class`` maps bytes to classes. Accepting states come last, from
    ``accepting`` on; ``rules`` gives the rules that each of them ends.
    """

    byte_class: bytes
    classes: int
    moves: tuple
    start: int
    accepting: int
    rules: dict


def compile_rules(trees, anywhere):
    """One minimal deterministic automaton for all trees; ``anywhere``: matches may begin at any byte."""
    nfa = _Nfa()
    first = nfa.state()
    ends = {}
    for number, tree in enumerate(trees):
        own = nfa.state()
        nfa.jumps[first].append(own)
        ends[nfa.add(tree, own)] = number

    sets = {m[0] for m in nfa.moves if m}
    seen = {}
    byte_class = bytes(seen.setdefault(tuple(b in s for s in sets), len(seen)) for b in range(256))
    sample = [byte_class.index(c) for c in range(len(seen))]

    # Subset construction.
    root = nfa.closure([first])
    numbers, todo, table = {root: 0}, [root], []
    while todo:
        subset = todo.pop(0)
        row = []
        for byte in sample:
            to = {m[1] for m in (nfa.moves[s] for s in subset) if m and byte in m[0]}
            after = nfa.closure(to) | (root if anywhere else frozenset())
            if after not in numbers:
                numbers[after] = len(numbers)
                todo.append(after)
            row.append(numbers[after])
        table.append(row)
    table = np.array(table)
    accepts = [frozenset(ends[s] for s in subset if s in ends) for subset in numbers]

    # Minimisation: split blocks until no byte class tells two states of a block apart.
    names = {}
    block = np.array([names.setdefault(a, len(names)) for a in accepts])
    while True:
        parted = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].ravel()
        if parted.max() == block.max():
            break
        block = parted
    kept = {b: int(np.argmax(block == b)) for b in range(block.max() + 1)}
    order = sorted(kept, key=lambda b: bool(accepts[kept[b]]))
    place = {b: i for i, b in enumerate(order)}
    width = len(sample)
    moves = [place[block[to]] * width for b in order for to in table[kept[b]]]
    rules = {place[b] * width: tuple(sorted(accepts[kept[b]])) for b in order if accepts[kept[b]]}
    return Automaton(byte_class, width, tuple(moves), place[block[0]] * width, min(rules, default=len(moves)), rules)


class Scanner:
    """All rules over a text in one pass of its bytes, from the last to the first.

    The pass runs the automaton of the reversed rules, so that a state that
    accepts a rule marks a byte where a match of that rule begins. From those
    marks, left to right, a rule's own automaton gives the longest match; the
    next match of the rule begins at its end or later.
    """

    def __init__(self, patterns):
        trees = [parse(p) for p in patterns]
        self.back = compile_rules([reversed_tree(t) for t in trees], anywhere=True)
        self.ahead = [compile_rules([t], anywhere=False) for t in trees]

    def starts(self, data):
        """(place, rules) of every byte where a match begins, last first."""
        back = self.back
        moves, state, accepting, rules = back.moves, back.start, back.accepting, back.rules
        place, marks = len(data), []
        for c in data.translate(back.byte_class)[::-1]:
            place -= 1
            state = moves[state + c]
            if state >= accepting:
                marks.append((place, rules[state]))
        return marks

    def longest(self, rule, data, start):
        own = self.ahead[rule]
        state, end = own.start, None
        for place, byte in enumerate(itertools.islice(data, start, None), start + 1):
            state = own.moves[state + own.byte_class[byte]]
            if state >= own.accepting:
                end = place
            elif end is not None:
                break
        return end

    def matches(self, data):
        """(start, rule, end) of leftmost longest matches that don't overlap, for each rule by itself."""
        found, behind = [], [0] * len(self.ahead)
        for start, rules in reversed(self.starts(data)):
            for rule in rules:
                if start >= behind[rule]:
                    behind[rule] = self.longest(rule, data, start)
                    found.append((start, rule, behind[rule]))
        return sorted(found)
