"""Ordered rules as ``when`` chains, so that they run inside the scan's stage.

A chain needs no join and no shuffle: a value that fills a third of the table
costs the same per row as any other.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def _any_of(c: Column, needles: Iterable[str]) -> Column:
    test = None
    for needle in needles:
        hit = F.contains(c, F.lit(needle))
        test = hit if test is None else test | hit
    return test


def contains_any(c: Column, needles: Iterable[str]) -> Column:
    return _any_of(c, needles)


def first_containing(c: Column, rules, default: Column | None = None) -> Column:
    """Label of the first rule with a substring in ``c``; rules are
    ``(label, [substrings])``."""
    chain = None
    for label, needles in rules:
        test = _any_of(c, needles)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain if default is None else chain.otherwise(default)


def first_keyword(c: Column, rules, default: Column | None = None) -> Column:
    """As ``first_containing`` for flat ``(substring, label)`` rules."""
    return first_containing(c, [(label, [needle]) for needle, label in rules], default)


def first_matching(c: Column, rules, default: Column | None = None) -> Column:
    """Label of the first ``(regex, label)`` rule that matches."""
    chain = None
    for pattern, label in rules:
        test = c.rlike(pattern)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain if default is None else chain.otherwise(default)


def lookup(c: Column, mapping, default: Column | None = None) -> Column:
    """Exact lookup; keys that share a label become one hashed IN set."""
    groups: dict[str, list[str]] = {}
    for key, label in (mapping.items() if isinstance(mapping, dict) else mapping):
        groups.setdefault(label, []).append(key)
    chain = None
    for label, keys in groups.items():
        test = c.isin(*keys)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain if default is None else chain.otherwise(default)


def longest_contained(c: Column, mapping: dict[str, str], default: Column | None = None) -> Column:
    """Exact key, else the longest key contained in ``c``. Trying the keys
    from long to short gives both, as an equal key is the longest contained."""
    by_length = sorted(mapping.items(), key=lambda kv: -len(kv[0]))
    return first_keyword(c, by_length, default)
