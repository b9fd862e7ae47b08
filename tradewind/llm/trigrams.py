"""Boolean trigram queries that a text must satisfy for a regular expression to match in it.

A query is None (any text may match), a frozenset of three-byte strings that must all occur, or
a tuple ("and" | "or", parts). Texts and trigrams are compared with A-Z as a-z, in UTF-8.
"""

from __future__ import annotations

from itertools import product

# The parser of the standard library gives a pattern as a tree.
from re import _constants as op
from re import _parser as parser

# Sets of alternative strings larger than this are cut off and put into the query so far.
MOST_STRINGS = 64
MOST_CHARS = 16


def _all(parts: list):
    """All of the parts."""
    grams, rest = frozenset(), []
    for p in parts:
        if isinstance(p, frozenset):
            grams |= p
        elif p is not None:
            rest.append(p)
    parts = ([grams] if grams else []) + rest
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts: list):
    """At least one of the parts; nothing can be demanded if one of them demands nothing."""
    if not parts or any(p is None for p in parts):
        return None
    unique = list(dict.fromkeys(parts))
    return unique[0] if len(unique) == 1 else ("or", tuple(unique))


def _grams(strings: frozenset[bytes]):
    """What a text needs in order to hold one of the strings."""
    each = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings)]
    return _any([g or None for g in each])


def _lowered(code: int) -> bytes:
    return chr(code).encode().lower()


def _members(items) -> frozenset[bytes] | None:
    """The characters of a bracket, or None if there are many."""
    found: set[bytes] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(_lowered(value))
        elif kind is op.RANGE and value[1] - value[0] < 4 * MOST_CHARS:
            found.update(_lowered(c) for c in range(value[0], value[1] + 1))
        else:
            return None
    return frozenset(found) if len(found) <= MOST_CHARS else None


class _Walk:
    """Reads a pattern from left to right, keeping the strings that the part at hand can be."""

    def __init__(self):
        self.needs: list = []
        self.exact: frozenset[bytes] = frozenset([b""])

    def cut(self) -> None:
        self.needs.append(_grams(self.exact))
        self.exact = frozenset([b""])

    def append(self, strings: frozenset[bytes]) -> None:
        if len(self.exact) * len(strings) > MOST_STRINGS:
            # The ends of what came before still make trigrams with what follows.
            self.needs.append(_grams(self.exact))
            ends = frozenset(s[-2:] for s in self.exact)
            self.exact = ends if len(ends) * len(strings) <= MOST_STRINGS else frozenset([b""])
        self.exact = frozenset(a + b for a, b in product(self.exact, strings))

    def read(self, tree) -> None:
        for kind, value in tree:
            if kind is op.LITERAL:
                self.append(frozenset([_lowered(value)]))
            elif kind is op.IN and (found := _members(value)):
                self.append(found)
            elif kind is op.SUBPATTERN:
                self.read(value[-1])
            elif kind is op.BRANCH:
                self.branch([list(b) for b in value[1]])
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
                low, high, inner = value
                if low == 0 and high == 1:
                    self.branch([list(inner), []])
                elif low == 0:
                    self.cut()
                else:
                    for _ in range(min(low, 8)):
                        self.read(inner)
                    if high != low or low > 8:
                        self.cut()
            elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
                continue  # of no width; what they demand is left to the check
            else:
                self.cut()

    def branch(self, branches: list) -> None:
        walks = []
        for b in branches:
            walk = _Walk()
            walk.read(b)
            walks.append(walk)
        if all(not [n for n in w.needs if n is not None] and not w.was_cut for w in walks):
            self.append(frozenset().union(*[w.exact for w in walks]))
            return
        self.cut()
        self.needs.append(_any([w.result() for w in walks]))

    @property
    def was_cut(self) -> bool:
        return bool(self.needs)

    def result(self):
        return _all([*self.needs, _grams(self.exact)])


def trigram_query(pattern: str, flags: int = 0):
    """The query of a regular expression; None if it must be tried on every text."""
    walk = _Walk()
    walk.read(parser.parse(pattern, flags))
    return walk.result()


def grams_of(query) -> frozenset[bytes]:
    """All trigrams that a query mentions."""
    if query is None:
        return frozenset()
    if isinstance(query, frozenset):
        return query
    return frozenset().union(*[grams_of(p) for p in query[1]])
