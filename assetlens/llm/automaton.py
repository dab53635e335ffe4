"""Many regular expressions as one deterministic automaton over bytes.

``compile_rules`` turns each expression into a nondeterministic automaton, follows all of them
at once by subset construction, and minimises the result by partition refinement into one
transition array (state by byte class). A scan is then one table look-up per byte for all rules
together. ``Scanner.runs`` takes it in numpy: a text is cut into segments that are scanned side
by side from the start state, and the first bytes of a segment are scanned again from the state
that the segment before it really ended in, until both agree (a few bytes).

Matches of a rule are the leftmost ones that do not overlap, each as long as possible; rules do
not disturb each other. A rule must be decidable in one pass: matches have two bytes or more,
what has matched stays matched while it can be extended, and a later start never matches before an
earlier start is decided; ``compile_rules`` refuses other rules. Expressions have literals,
classes, groups, ``|``, ``?``, ``*``, ``+`` and ``{m,n}``; ``(?i:...)`` is for ASCII letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from re import _constants as rc
from re import _parser as parser

import numpy as np

RESET = 0xFF
"""A byte that no UTF-8 text has: it separates texts and puts the automaton back to its start."""
SEGMENT = 1024
WINDOW = 1 << 21


class Nfa:
    """Thompson's automaton of one expression: byte edges and empty edges."""

    def __init__(self, pattern: str, backwards: bool = False):
        self.empty: list[list[int]] = []
        self.edges: list[tuple[frozenset[int], int] | None] = []
        self.backwards = backwards
        self.start, self.end = self._node(), self._node()
        self._sequence(parser.parse(pattern), self.start, self.end, 0)

    def _node(self) -> int:
        self.empty.append([])
        self.edges.append(None)
        return len(self.empty) - 1

    def _sequence(self, parts, begin: int, end: int, flags: int) -> None:
        for part in reversed(parts) if self.backwards else parts:
            node = self._node()
            self._part(part, begin, node, flags)
            begin = node
        self.empty[begin].append(end)

    def _part(self, part, begin: int, end: int, flags: int) -> None:
        op, value = part
        if op is rc.SUBPATTERN:
            _, add, _, inner = value
            self._sequence(inner, begin, end, flags | add)
        elif op is rc.BRANCH:
            for choice in value[1]:
                self._sequence(choice, begin, end, flags)
        elif op is rc.MAX_REPEAT:
            least, most, inner = value
            for _ in range(least):
                node = self._node()
                self._sequence(inner, begin, node, flags)
                begin = node
            if most is rc.MAXREPEAT:
                loop = self._node()
                self.empty[begin].append(loop)
                self._sequence(inner, loop, loop, flags)
                begin = loop
            else:
                for _ in range(most - least):
                    self.empty[begin].append(end)
                    node = self._node()
                    self._sequence(inner, begin, node, flags)
                    begin = node
            self.empty[begin].append(end)
        else:
            node = self._node()
            self.empty[begin].append(node)
            self.edges[node] = (self._bytes(op, value, flags), end)

    @staticmethod
    def _bytes(op, value, flags: int) -> frozenset[int]:
        members = set()
        for kind, v in value if op is rc.IN else [(op, value)]:
            if kind is rc.LITERAL:
                members.add(v)
            elif kind is rc.RANGE:
                members.update(range(v[0], v[1] + 1))
            else:
                raise ValueError(f"not supported in a rule: {kind}")
        if max(members) > 0x7F:
            raise ValueError("rules are over ASCII characters")
        if flags & re.IGNORECASE:
            members |= {ord(chr(c).swapcase()) for c in members if chr(c).isalpha()}
        return frozenset(members)

    def close(self, nodes: set[int]) -> frozenset[int]:
        """The nodes reached by empty edges; of these, only those that matter (byte edges, the end)."""
        seen, todo = set(nodes), list(nodes)
        while todo:
            for n in self.empty[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return frozenset(n for n in seen if self.edges[n] or n == self.end)

    def move(self, nodes: frozenset[int], byte: int) -> frozenset[int]:
        return self.close({self.edges[n][1] for n in nodes if self.edges[n] and byte in self.edges[n][0]})


class _Search:
    """Leftmost matching of one rule as deterministic steps. A state is (matching, threads): the
    node sets of the starts still undecided, earliest first, or the one that has matched."""

    def __init__(self, pattern: str):
        self.nfa = Nfa(pattern)
        self.first = self.nfa.close({self.nfa.start})
        if self.nfa.end in self.first:
            raise ValueError(f"matches nothing: {pattern}")
        self.pattern = pattern

    def step(self, state: tuple, byte: int) -> tuple:
        matching, threads = state
        end = self.nfa.end
        if matching:
            going = self.nfa.move(threads[0], byte)
            if going:
                if end not in going:
                    raise ValueError(f"a match can be interrupted: {self.pattern}")
                return True, (going,)
            threads = ()
        moved, seen = [], set()
        for thread in (*threads, self.first):
            left = self.nfa.move(thread, byte) - seen  # an earlier start at the same node wins
            seen |= left
            if left:
                moved.append(left)
        ended = [i for i, thread in enumerate(moved) if end in thread]
        if not ended:
            return False, tuple(moved)
        if ended[0] > 0:
            raise ValueError(f"a later start can match first: {self.pattern}")
        if matching and len(threads) == 0 and end in self.nfa.move(self.first, byte):
            raise ValueError(f"matches one byte: {self.pattern}")
        return True, (moved[0],)


def _byte_classes(nfas: Sequence[Nfa]) -> np.ndarray:
    """Class of each byte: bytes of one class are in the same sets of all edges."""
    sets = sorted({tuple(sorted(e[0])) for nfa in nfas for e in nfa.edges if e})
    names: dict[tuple, int] = {}
    members = [set(s) for s in sets]
    return np.array([names.setdefault(tuple(b in s for s in members) + (b == RESET,), len(names)) for b in range(256)], np.uint8)


def minimise(table: np.ndarray, output: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Moore's refinement: states with equal output and equal successors become one. Gives the
    smaller table, its outputs, and the new number of each old state."""
    group = np.unique(output, return_inverse=True)[1].reshape(-1)
    while True:
        finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == group.max():
            break
        group = finer
    _, first = np.unique(group, return_index=True)
    return group[table[first]], output[first], group


def _subsets(first, step, classes: np.ndarray, restart: bool) -> tuple[np.ndarray, list]:
    """All states reached from ``first`` and their transition table by byte class."""
    sample = [int(np.flatnonzero(classes == c)[0]) for c in range(classes.max() + 1)]
    number, states, rows = {first: 0}, [first], []
    for state in states:
        row = []
        for byte in sample:
            after = first if restart and byte == RESET else step(state, byte)
            if after not in number:
                number[after] = len(states)
                states.append(after)
            row.append(number[after])
        rows.append(row)
    return np.array(rows, np.int32), states


@dataclass(frozen=True)
class Backwards:
    """The reversed rule: where does a match that ends here begin?"""
    classes: np.ndarray
    table: list[list[int]]
    ends: list[bool]

    def start(self, data: bytes, last: int, bound: int) -> int:
        """Smallest start, not below ``bound``, of a match whose last byte is ``last``."""
        state, found, at = 0, -1, last
        while at >= bound:
            state = self.table[state][self.classes[data[at]]]
            if state < 0:
                break
            if self.ends[state]:
                found = at
            at -= 1
        return found


def _backwards(pattern: str) -> Backwards:
    nfa = Nfa(pattern, backwards=True)
    classes = _byte_classes([nfa])
    table, states = _subsets(nfa.close({nfa.start}), nfa.move, classes, False)
    table, ends, group = minimise(table, np.array([2 * (nfa.end in s) + (not s) for s in states]))
    first, dead = group[0], np.flatnonzero(ends == 1)
    order = np.argsort(np.where(np.arange(len(ends)) == first, -1, np.arange(len(ends))), kind="stable")
    place = np.argsort(order)
    rows = [[-1 if t in dead else int(place[t]) for t in table[s]] for s in order]
    return Backwards(classes, rows, [bool(ends[s] == 2) for s in order])


@dataclass(frozen=True)
class Scanner:
    """The combined automaton. States are held times ``width`` (the number of byte classes), so a
    step is one addition and one look-up; the states in which a rule has matched come last."""
    classes: np.ndarray
    width: int
    table: np.ndarray
    matched: np.ndarray  # per state, one bit per rule
    matching_from: int
    backwards: tuple[Backwards, ...]

    def _window(self, data: np.ndarray, state: int) -> np.ndarray:
        """States after each byte, from ``state`` on."""
        lanes = -(-len(data) // SEGMENT)
        padded = np.full(lanes * SEGMENT, RESET, np.uint8)
        padded[:len(data)] = data
        steps = np.ascontiguousarray(self.classes[padded].reshape(lanes, SEGMENT).T).astype(np.int32)
        out = np.empty((SEGMENT, lanes), np.int32)
        now = np.zeros(lanes, np.int32)
        now[0] = state
        for j in range(SEGMENT):
            now = np.take(self.table, now + steps[j], out=out[j])
        for lane in range(1, lanes):
            now = int(out[-1, lane - 1])
            if now:
                for j in range(SEGMENT):
                    now = int(self.table[now + steps[j, lane]])
                    if now == out[j, lane]:
                        break
                    out[j, lane] = now
        return np.ascontiguousarray(out.T).reshape(-1)[:len(data)]

    def runs(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule, first, last) of each match: the byte at which it first matched, and its last."""
        found: dict[int, list[list[int]]] = {r: [] for r in range(len(self.backwards))}
        whole, state = np.frombuffer(data, np.uint8), 0
        for begin in range(0, len(whole), WINDOW):
            states = self._window(whole[begin:begin + WINDOW], state)
            state = int(states[-1])
            at = np.flatnonzero(states >= self.matching_from)
            if not len(at):
                continue
            bits = self.matched[states[at] // self.width]
            for rule, runs in found.items():
                own = at[(bits >> rule) & 1 == 1]
                if len(own):
                    cut = np.flatnonzero(np.diff(own) > 1)
                    firsts, lasts = own[np.append(0, cut + 1)] + begin, own[np.append(cut, len(own) - 1)] + begin
                    for first, last in zip(firsts.tolist(), lasts.tolist()):
                        if runs and runs[-1][1] + 1 == first:
                            runs[-1][1] = last
                        else:
                            runs.append([first, last])
        return [(rule, first, last) for rule, runs in found.items() for first, last in runs]

    def matches(self, data: bytes) -> Iterator[tuple[int, int, int, int]]:
        """(rule, start, first, end): a match from start to end, decided at byte ``first``."""
        bound = dict.fromkeys(range(len(self.backwards)), 0)
        for rule, first, last in self.runs(data):
            start = self.backwards[rule].start(data, first, bound[rule])
            bound[rule] = last + 1
            yield rule, start, first, last + 1


def _product(tables: list[np.ndarray], first: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The automata of all rules followed at once: transition table of the combinations that are
    reached from ``first`` (number 0), and the state of each rule in each combination."""
    sizes = np.array([len(t) for t in tables], np.int64)
    radix = np.cumprod(np.append(1, sizes[:-1]))
    if float(np.prod(sizes.astype(float))) >= 2.0 ** 62:
        raise ValueError("too many rules for one automaton")
    number = {int(np.dot(radix, first)): 0}
    frontier, rows = np.array(list(number), np.int64), []
    while len(frontier):
        after = sum(t[frontier // r % n].astype(np.int64) * r for t, r, n in zip(tables, radix, sizes))
        fresh = [c for c in np.unique(after).tolist() if c not in number]
        number.update(zip(fresh, range(len(number), len(number) + len(fresh))))
        rows.append(after)
        frontier = np.array(fresh, np.int64)
    codes, place = (np.array(list(x), np.int64) for x in (number.keys(), number.values()))
    order = np.argsort(codes)
    table = place[order][np.searchsorted(codes[order], np.concatenate(rows))]
    return table, codes[:, None] // radix % sizes


def compile_rules(patterns: Sequence[str]) -> Scanner:
    """One scanner for all patterns: an automaton for each, their product, minimised."""
    rules = [_Search(p) for p in patterns]
    classes = _byte_classes([r.nfa for r in rules])
    tables, matching, first = [], [], []
    for rule in rules:
        table, states = _subsets((False, ()), rule.step, classes, True)
        table, output, group = minimise(table, np.array([m for m, _ in states]))
        tables.append(table)
        matching.append(output)
        first.append(int(group[0]))
    table, parts = _product(tables, first)
    bits = sum(matching[r][parts[:, r]].astype(np.int64) << r for r in range(len(rules)))
    table, bits, group = minimise(table, bits)
    key = np.where(np.arange(len(bits)) == group[0], -1, (bits > 0).astype(int))
    order = np.argsort(key, kind="stable")
    place = np.argsort(order).astype(np.int32)
    width = int(classes.max()) + 1
    table, bits = place[table[order]] * np.int32(width), bits[order]
    return Scanner(classes, width, np.ascontiguousarray(table.reshape(-1)), bits,
                   int((bits == 0).sum()) * width, tuple(_backwards(p) for p in patterns))
