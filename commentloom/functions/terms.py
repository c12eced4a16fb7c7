"""Many terms searched in one pass over a text.

All terms become one regular expression, a trie: alternatives that begin alike share their beginning, and where many
characters may follow, look-ahead classes halve them until one is left.  So the work at a place in the text depends on
how far the text follows some term, not on how many terms there are.  ``found`` takes the longest term at
every place, also where terms overlap; the shorter terms that match there are its prefixes, which a hash table in
constant arrays lists for each term.  Everything runs in the JVM, without a join or a shuffle.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_END = ""  # the key that marks a term's end in the trie
_FEW = 3  # so many alternatives are simply tried one after the other


def _quoted(char: str) -> str:
    return char if char.isalnum() else f"\\x{{{ord(char):x}}}"


def _trie(terms: list[str], shortest: bool) -> dict:
    root: dict = {}
    for term in terms:
        node = root
        for char in term:
            if shortest and _END in node:
                break  # a shorter term matches already
            node = node.setdefault(char, {})
        else:
            if shortest:
                node.clear()
            node[_END] = {}
    return root


def _rest(node: dict) -> str:
    """The expression of what follows a node: its longest continuation first."""
    out = _choice(sorted(c for c in node if c != _END), node)
    if _END not in node or not out:
        return out
    return f"(?:{out})?"


def _choice(chars: list[str], node: dict) -> str:
    if not chars:
        return ""
    if len(chars) == 1:
        return _branch(chars[0], node[chars[0]])
    if len(chars) <= _FEW:
        return f"(?:{'|'.join(_branch(c, node[c]) for c in chars)})"
    half = len(chars) // 2
    first = "".join(map(_quoted, chars[:half]))
    return f"(?:(?=[{first}]){_choice(chars[:half], node)}|{_choice(chars[half:], node)})"


def _branch(char: str, node: dict) -> str:
    """A character and what follows it; without a choice, a plain string."""
    text = _quoted(char)
    while len(node) == 1 and _END not in node:
        ((char, node),) = node.items()
        text += _quoted(char)
    return text + _rest(node)


def pattern(terms: list[str], shortest: bool = False) -> str:
    """An expression that matches the longest of the terms at a place, or just any of them; no terms, no match."""
    trie = _trie(sorted({t for t in terms if t}), shortest)
    return _rest(trie) if trie else "(?!)"


def holds_any(text: Column, terms: list[str]) -> Column:
    """Whether the text contains any of the terms as they are; an empty term is in every text."""
    if "" in terms:
        return text.isNotNull()
    return F.rlike(text, F.lit(pattern(terms, shortest=True)))


def _slot(term: str, slots: int) -> int:
    return zlib.crc32(term.encode()) % slots


def found(text: Column, entries: dict[str, list[dict]], kind: str) -> Column:
    """The distinct entries, structs of type ``kind``, of all terms that the text contains; null for a null text.

    ``entries`` maps a term to its entries; those of an empty term belong to every text.
    """
    terms = sorted(t for t in entries if t)
    slots = max(1, len(terms))
    table: list[list[dict]] = [[] for _ in range(slots)]
    for t in terms:  # with the term's own entries those of the terms it begins with
        table[_slot(t, slots)].append({"t": t, "e": [e for k in range(1, len(t) + 1) for e in entries.get(t[:k], [])]})
    # Both constants are read from text once, when the plan is optimised.
    rows = F.from_json(F.lit(json.dumps(table)), f"array<array<struct<t:string,e:array<{kind}>>>>")
    always = F.from_json(F.lit(json.dumps(entries.get("", []))), f"array<{kind}>")

    def listed(term: Column) -> Column:
        slot = F.pmod(F.crc32(term.cast("binary")), F.lit(slots)).cast("int")
        return F.flatten(F.transform(F.filter(F.get(rows, slot), lambda x: x["t"] == term), lambda x: x["e"]))

    longest = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?=({pattern(terms)}))"), F.lit(1)))
    hits = F.concat(always, F.flatten(F.transform(longest, listed)))
    return F.when(text.isNotNull(), F.array_distinct(hits))
