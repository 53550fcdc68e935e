"""Many regular expressions as one minimal automaton over bytes.

Every rule becomes a scanner: ordered subset construction, in which threads that started earlier come first, gives the
leftmost, longest match and starts again behind it. The product of all scanners, minimised, is one transition array; a
single pass over the bytes of a text then finds where matches of any rule end. Starts come from walking the rule
backwards from an end, which only happens at matches.

Supported: ASCII literals, sets, groups, alternatives, greedy repeats and `(?i:...)`. A rule must stay in a match once
it is in one until the match is over, and an earlier start must not still be open when a later one matches; both are
checked over all reachable states when the rules are compiled, and other rules are refused.
"""

from __future__ import annotations

import re
from collections import deque
from re import _constants as sre
from re import _parser

import numpy as np

ACCEPT = 0


class Nfa:
    """Thompson automaton of one pattern; state 0 accepts."""

    def __init__(self, pattern: str):
        self.empty: list[list[int]] = [[]]
        self.moves: list[tuple[frozenset[int], int] | None] = [None]
        tree = _parser.parse(pattern)
        self.start = self._sequence(tree, ACCEPT, False)
        self.closures: dict[int, frozenset[int]] = {}

    def _state(self, empty: list[int], move=None) -> int:
        self.empty.append(empty)
        self.moves.append(move)
        return len(self.empty) - 1

    def _sequence(self, items, then: int, fold: bool) -> int:
        for op, arg in reversed(list(items)):
            then = self._node(op, arg, then, fold)
        return then

    def _node(self, op, arg, then: int, fold: bool) -> int:
        if op is sre.LITERAL:
            return self._state([], (_folded({arg}, fold), then))
        if op is sre.IN:
            return self._state([], (_folded(_members(arg), fold), then))
        if op is sre.SUBPATTERN:
            _, added, _, body = arg
            return self._sequence(body, then, fold or bool(added & re.IGNORECASE))
        if op is sre.BRANCH:
            return self._state([self._sequence(body, then, fold) for body in arg[1]])
        if op is sre.MAX_REPEAT:
            low, high, body = arg
            if high is sre.MAXREPEAT:
                loop = self._state([then])
                self.empty[loop].append(self._sequence(body, loop, fold))
                then = loop
            else:
                for _ in range(high - low):
                    then = self._state([self._sequence(body, then, fold), then])
            for _ in range(low):
                then = self._sequence(body, then, fold)
            return then
        raise ValueError(f"Not supported in a rule: {op}")

    def closure(self, state: int) -> frozenset[int]:
        if state not in self.closures:
            seen, todo = {state}, [state]
            while todo:
                for t in self.empty[todo.pop()]:
                    if t not in seen:
                        seen.add(t)
                        todo.append(t)
            self.closures[state] = frozenset(s for s in seen if s == ACCEPT or self.moves[s])
        return self.closures[state]

    def step(self, states, byte: int) -> set[int]:
        out: set[int] = set()
        for s in states:
            move = self.moves[s]
            if move and byte in move[0]:
                out |= self.closure(move[1])
        return out


def _members(items) -> set[int]:
    out: set[int] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            out.add(arg)
        elif op is sre.RANGE:
            out |= set(range(arg[0], arg[1] + 1))
        else:
            raise ValueError(f"Not supported in a set: {op}")
    return out


def _folded(members: set[int], fold: bool) -> frozenset[int]:
    if any(m > 127 for m in members):
        raise ValueError("Rules are ASCII")
    if fold:
        members = {ord(c) for m in members for c in (chr(m).lower(), chr(m).upper())}
    return frozenset(members)


def byte_classes(nfas: list[Nfa]) -> np.ndarray:
    """Bytes that no rule tells apart share a class."""
    sets = list(dict.fromkeys(m[0] for n in nfas for m in n.moves if m))
    kinds: dict[tuple, int] = {}
    return np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)], np.uint8)


def scanner(nfa: Nfa, samples: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Transitions [state, class] and accepting flags of the rule's leftmost, longest, repeated search."""

    def advance(config: tuple, byte: int) -> tuple:
        matched = bool(config) and ACCEPT in config[0]
        threads = config if matched else (*config, nfa.closure(nfa.start))
        out, seen = [], set()
        for states in threads:
            moved = nfa.step(states, byte) - seen
            if moved:
                if ACCEPT in moved and out:
                    raise ValueError("A later start matches while an earlier one is open")
                out.append(frozenset(moved))
                seen |= moved
                if ACCEPT in moved:
                    break
        if matched:
            if not out:
                again = advance((), byte)
                if again and ACCEPT in again[0]:
                    raise ValueError("A match touches the one before")
                return again
            if ACCEPT not in out[0]:
                raise ValueError("A match is left and may be taken up again")
        return tuple(out)

    ids, todo, rows = {(): 0}, deque([()]), []
    while todo:
        config = todo.popleft()
        row = []
        for byte in samples:
            nxt = advance(config, byte)
            if nxt not in ids:
                ids[nxt] = len(ids)
                todo.append(nxt)
            row.append(ids[nxt])
        rows.append(row)
    accept = np.array([bool(c) and ACCEPT in c[0] for c in ids], np.int64)
    return minimised(np.array(rows, np.int64), accept)


def minimised(table: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input tells apart (partition refinement); state 0 stays first."""
    block = np.unique(label, return_inverse=True)[1]
    while True:
        _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        if finer.max() == block.max():
            break
        block = finer
    first = np.full(block.max() + 1, -1)
    order = np.arange(len(block))[::-1]
    first[block[order]] = order
    rank = np.empty(len(first), np.int64)
    rank[np.argsort(first)] = np.arange(len(first))
    keep = np.sort(first)
    return rank[block[table[keep]]], label[keep]


class Automaton:
    """All rules in one transition array; `ends` yields (rule, end) of every match in order of ends."""

    def __init__(self, patterns: list[str]):
        nfas = [Nfa(p) for p in patterns]
        classes = byte_classes(nfas)
        samples = [int(np.argmax(classes == k)) for k in range(int(classes.max()) + 1)]
        parts = [scanner(n, samples) for n in nfas]
        start = (0,) * len(parts)
        ids, todo, rows, flags = {start: 0}, deque([start]), [], []
        while todo:
            at = todo.popleft()
            flags.append(sum(int(parts[r][1][s]) << r for r, s in enumerate(at)))
            row = []
            for k in range(len(samples)):
                nxt = tuple(int(parts[r][0][s, k]) for r, s in enumerate(at))
                if nxt not in ids:
                    ids[nxt] = len(ids)
                    todo.append(nxt)
                row.append(ids[nxt])
            rows.append(row)
        table, label = minimised(np.array(rows, np.int64), np.array(flags, np.int64))
        quiet = np.argsort(label > 0, kind="stable")
        place = np.empty(len(quiet), np.int64)
        place[quiet] = np.arange(len(quiet))
        width = len(samples)
        self.states = len(table)
        self.first_hot = int((label == 0).sum()) * width
        self.start = int(place[0]) * width
        self.step = (place[table[quiet]] * width).ravel().tolist()
        self.flags = {int(i) * width: int(label[s]) for i, s in enumerate(quiet) if label[s]}
        self.classes = classes.tobytes()
        self.backward = [Backward(n) for n in nfas]

    def ends(self, data: bytes) -> list[tuple[int, int]]:
        step, hot, flags, state, open_ = self.step, self.first_hot, self.flags, self.start, 0
        found = []
        # NUL is in no rule, so it closes a match that reaches the end.
        for i, k in enumerate((data + b"\0").translate(self.classes)):
            state = step[state + k]
            if open_ or state >= hot:
                now = flags.get(state, 0)
                over = open_ & ~now
                while over:
                    bit = over & -over
                    found.append((bit.bit_length() - 1, i))
                    over ^= bit
                open_ = now
        return found

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(rule, start, end) in bytes of every match; per rule leftmost, longest, not overlapping."""
        floor, out = [0] * len(self.backward), []
        for rule, end in self.ends(data):
            out.append((rule, self.backward[rule].start(data, floor[rule], end), end))
            floor[rule] = end
        return out


class Backward:
    """Where the match that ends at a place starts: the rule read from right to left, states made as needed."""

    def __init__(self, nfa: Nfa):
        self.goal = nfa.closure(nfa.start)
        self.into: list[tuple[frozenset[int], frozenset[int], int]] = [
            (nfa.closure(m[1]), m[0], s) for s, m in enumerate(nfa.moves) if m
        ]
        self.known: dict[tuple[frozenset[int], int], frozenset[int]] = {}

    def start(self, data: bytes, floor: int, end: int) -> int:
        states, best = frozenset([ACCEPT]), end
        for i in range(end - 1, floor - 1, -1):
            key = (states, data[i])
            if key not in self.known:
                self.known[key] = frozenset(s for to, over, s in self.into if data[i] in over and to & states)
            states = self.known[key]
            if not states:
                break
            if states & self.goal:
                best = i
        return best
