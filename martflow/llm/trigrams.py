"""Mandatory trigrams of a regular expression, as an OR of ANDs.

``alternatives(pattern)`` returns sets of lower-case trigrams: every text that
the pattern matches (in either case) holds all trigrams of at least one set.
None means that no trigram is mandatory, so any text may match.
"""

from __future__ import annotations

from re import _constants as op
from re import _parser as parser

MANY = 64  # strings or sets followed at once; beyond it the weaker query is kept

Query = frozenset  # of frozensets of trigrams; an empty inner set is "any text"
ANY: Query = frozenset([frozenset()])


def _either(parts: list[Query]) -> Query:
    sets = frozenset().union(*parts)
    return frozenset(s for s in sets if not any(o < s for o in sets))


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MANY:
        return max(a, b, key=lambda q: min(map(len, q)))
    return _either([frozenset(x | y for x in a for y in b)])


def _of_strings(strings: set[str]) -> Query:
    return _either([frozenset([frozenset(s[i:i + 3] for i in range(len(s) - 2))])
                    for s in strings])


def _strings(token) -> set[str] | None:
    """All lower-case strings that the token matches, if they are few."""
    kind, value = token
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN and all(k is op.LITERAL for k, _ in value) and len(value) <= 8:
        return {chr(v).lower() for _, v in value}
    if kind is op.SUBPATTERN:
        return _sequence_strings(value[-1])
    if kind is op.BRANCH:
        each = [_sequence_strings(branch) for branch in value[1]]
        return None if None in each else set().union(*each)
    if kind is op.MAX_REPEAT and value[1] <= 4:
        once = _sequence_strings(value[2])
        if once is not None:
            out, grown = set(), {""}
            for n in range(value[1] + 1):
                out |= grown if n >= value[0] else set()
                grown = {a + b for a in grown for b in once}
                if len(grown) > MANY:
                    return None
            return out
    if kind is op.AT:
        return {""}
    return None


def _sequence_strings(tokens) -> set[str] | None:
    out = {""}
    for token in tokens:
        some = _strings(token)
        if some is None or len(out) * len(some) > MANY:
            return None
        out = {a + b for a in out for b in some}
    return out


def _token(token) -> Query:
    kind, value = token
    if kind is op.SUBPATTERN:
        return _sequence(value[-1])
    if kind is op.BRANCH:
        return _either([_sequence(branch) for branch in value[1]])
    if kind is op.MAX_REPEAT and value[0] >= 1:
        return _sequence(value[2])
    return ANY


def _sequence(tokens) -> Query:
    query, run = ANY, {""}
    for token in tokens:
        some = _strings(token)
        if some is not None and len(run) * len(some) <= MANY:
            run = {a + b for a in run for b in some}
        else:
            query, run = _both(query, _of_strings(run)), {""}
            query = _both(query, _token(token))
    return _both(query, _of_strings(run))


def alternatives(pattern: str) -> list[frozenset[str]] | None:
    query = _sequence(parser.parse(pattern))
    return None if frozenset() in query else sorted(query, key=sorted)
