"""Boolean trigram queries of regular expressions.

A query is a conjunction of clauses; a clause is a set of alternatives; an alternative is a set of trigrams that
must all occur.  The regular expression is read by the standard library's own parser; what it cannot promise
(wildcards, large classes, repeats that may be empty) only makes the query weaker, never wrong.  An empty
conjunction means that the expression has no mandatory trigram.
"""

from __future__ import annotations

import re

MAX_STRINGS = 64  # exact strings followed at a time; beyond, the query is weakened

Query = list[frozenset[frozenset[str]]]


def _clause(strings: set[str]) -> frozenset[frozenset[str]] | None:
    """What the strings promise when one of them must occur."""
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    if not sets or frozenset() in sets:
        return None
    return frozenset(a for a in sets if not any(b < a for b in sets))


def _class(items) -> set[str] | None:
    out: set[str] = set()
    for op, value in items:
        name = str(op)
        if name == "LITERAL":
            out.add(chr(value).lower())
        elif name == "RANGE" and value[1] - value[0] < 8:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _strings(node) -> set[str] | None:
    """All strings a node matches, lower-cased, if they are few."""
    op, value = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(value).lower()}
    if op == "IN":
        return _class(value)
    if op == "SUBPATTERN":
        return _sequence(value[-1])
    if op == "BRANCH":
        parts = [_sequence(b) for b in value[1]]
        return None if None in parts else set().union(*parts)
    if op in ("MAX_REPEAT", "MIN_REPEAT") and value[1] <= 3:
        one = _sequence(value[2])
        if one is None:
            return None
        out, power = set(), {""}
        for n in range(int(value[1]) + 1):
            if n >= value[0]:
                out |= power
            power = {a + b for a in power for b in one}
            if len(power) > MAX_STRINGS:
                return None
        return out
    return None


def _sequence(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        one = _strings(node)
        if one is None or len(out) * len(one) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in one}
    return out


def _walk(nodes) -> Query:
    clauses: Query = []
    open_ = {""}

    def close() -> None:
        nonlocal open_
        clause = _clause(open_)
        if clause:
            clauses.append(clause)
        open_ = {""}

    for node in nodes:
        one = _strings(node)
        if one is not None and len(open_) * len(one) <= MAX_STRINGS:
            open_ = {a + b for a in open_ for b in one}
            continue
        op, value = str(node[0]), node[1]
        if one is not None:
            close()
            open_ = one
        elif op in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0:
            inner = _strings(value[2][0]) if len(value[2]) == 1 else _sequence(value[2])
            if inner is not None and len(open_) * len(inner) <= MAX_STRINGS:
                open_ = {a + b for a in open_ for b in inner}  # the first round is certain, what follows is not
            close()
            clauses.extend(_walk(value[2]))
        else:
            close()
            if op == "SUBPATTERN":
                clauses.extend(_walk(value[-1]))
            elif op == "BRANCH":
                parts = [_walk(b) for b in value[1]]
                if all(parts):  # one clause of every branch
                    clauses.append(frozenset().union(*[p[0] for p in parts]))
    close()
    return list(dict.fromkeys(clauses))


def trigram_query(pattern: str) -> Query:
    """The query of ``pattern`` over lower-cased text."""
    return _walk(re._parser.parse(pattern))


def named(queries: list[Query]) -> list[str]:
    """Every trigram that some query names, in order."""
    return sorted({t for q in queries for clause in q for alternative in clause for t in alternative})
