"""Canonical labels for organisms, makers, laboratories, technology and food.

A rule chain reads its key once per rule. Jobs therefore stage the folded or
lower-case key in a projection of its own and pass it as ``key``: Spark does not
merge projections whose expensive column is used many times, so the key is
computed once per row.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import vocab
from .rules import (contains_any, first_containing, first_keyword, first_matching, longest_contained,
                    lookup)
from .staged import bound
from .text import fold_key, present, tidy


def _key(raw: Column, key: Column | None) -> Column:
    return fold_key(raw) if key is None else key


def organism(raw: Column, aliases=vocab.ORGANISM_ALIASES, key: Column | None = None) -> Column:
    """Exact alias on the folded key, unknown names pass through tidied."""
    table = [(alias, label) for label, names in aliases for alias in names]
    return F.when(present(raw), lookup(_key(raw, key), table, tidy(raw)))


def manufacturer(raw: Column, patterns=vocab.MANUFACTURER_PATTERNS,
                 key: Column | None = None) -> Column:
    return F.when(present(raw), first_containing(_key(raw, key), patterns, tidy(raw)))


def plausible_lab(raw: Column, stopwords=vocab.LAB_STOPWORDS) -> Column:
    name = tidy(raw)
    junk = ((F.length(name) < 3) | F.lower(name).isin(*stopwords)
            | name.rlike("(?U)" + vocab.PERSON_NAME)
            | (~F.contains(name, F.lit(" ")) & (name == F.lower(name)) & (name != F.upper(name))))
    return ~junk


def expert_lab(raw: Column, patterns=vocab.EXPERT_LAB_PATTERNS,
               key: Column | None = None, stopwords=vocab.LAB_STOPWORDS) -> Column:
    """A known laboratory always wins; another name only if it looks like one."""
    kept = F.when(plausible_lab(raw, stopwords), tidy(raw))
    return F.when(present(raw), first_containing(_key(raw, key), patterns, kept))


def technology(stated: Column, name: Column, evidence: Column | None = None,
               products=vocab.PRODUCT_TECHNOLOGY, key: Column | None = None) -> Column:
    """Stated category, else product keyword, else report evidence; a stated
    ``other`` survives only when nothing better is known."""
    firm = F.when(present(stated) & (stated != "other"),
                  lookup(stated, vocab.TECHNOLOGY_ALIASES, stated))
    steps = [firm, first_containing(F.lower(name) if key is None else key, products)]
    if evidence is not None:
        steps.append(evidence)
    return F.coalesce(*steps, stated)


def technology_label(c: Column) -> Column:
    return lookup(c, vocab.TECHNOLOGY_LABELS, F.lit("Other"))


def technology_from_list_name(name: Column, rules=vocab.LIST_NAME_TECHNOLOGY) -> Column:
    return first_keyword(F.lower(name), rules)


def technology_from_sections(*texts: Column) -> Column:
    return bound(F.lower(F.concat_ws(" ", *texts)), lambda t: first_matching(t, vocab.SECTION_TECHNOLOGY, F.lit("other")))


def technology_from_heading(heading: Column, mapping=vocab.HEADING_TECHNOLOGY) -> Column:
    return bound(F.lower(F.trim(heading)), lambda key: lookup(key, mapping, F.lit("other")))


def analyte(raw: Column) -> Column:
    key = F.rtrim(F.lower(F.trim(raw)), F.lit("."))
    return lookup(key, vocab.ANALYTES, F.trim(raw))


def target_of_certificate(*texts: Column, rules=vocab.CERTIFICATE_TARGETS) -> Column:
    return bound(F.upper(F.concat_ws(" ", *texts)), lambda t: first_keyword(t, rules))


def target_of_list(aim: Column, rules=vocab.LIST_TARGETS) -> Column:
    return first_keyword(F.upper(aim), rules)


def organism_of_slug(slug: Column, heading: Column, mapping=vocab.SLUG_ORGANISMS) -> Column:
    return longest_contained(slug, mapping, heading)


def action(text: Column) -> Column:
    """Detection is tested before enumeration."""
    return (F.when(text.rlike(r"(?i)D[EÉé]TECTION"), "detection")
            .when(text.rlike(r"(?i)D[EÉé]NOMBREMENT|ENUMERATION"), "enumeration"))


def food_category(raw: Column, key: Column | None = None) -> Column:
    """One of the 18 fixed categories or null. The order of the branches is
    the meaning: composite foods beat eggs, poultry beats meat, and a family
    without a qualifier counts as raw."""
    t = F.lower(raw) if key is None else key
    words = vocab.FOOD_WORDS

    def has(name: str) -> Column:
        return contains_any(t, words[name])

    def split(name: str, qualifier: str, yes: str, no: str) -> tuple[Column, Column]:
        return has(name), F.when(has(qualifier), yes).otherwise(F.lit(no))

    branches = [
        (has("infant"), F.lit("infant_formula")),
        (has("bakery"), F.lit("chocolate_bakery")),
        (F.contains(t, F.lit("primary production")) | t.rlike(r"\bpps\b"),
         F.lit("primary_production_samples")),
        (F.contains(t, F.lit("environmental")), F.lit("environmental_samples")),
        (has("feed"), F.lit("pet_food_feed")),
        (has("composite"), F.lit("composite_foods")),
        (has("dried"), F.lit("dried_produce")),
        (F.contains(t, F.lit("egg")), F.lit("eggs")),
        split("poultry", "ready", "rte_poultry", "raw_poultry"),
        split("meat", "ready", "rte_meat", "raw_meat"),
        split("seafood", "ready", "rte_seafood", "raw_seafood"),
        split("dairy", "heated", "heat_processed_dairy", "raw_milk_dairy"),
        split("produce", "processed", "processed_produce", "fresh_produce"),
    ]
    chain = None
    for test, label in branches:
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain


def food_order(category: Column) -> Column:
    """1-based place of a category in the fixed sequence."""
    chain = None
    for i, (cid, _) in enumerate(vocab.FOOD_CATEGORIES, 1):
        chain = F.when(category == cid, i) if chain is None else chain.when(category == cid, i)
    return chain


def food_label(category: Column) -> Column:
    return lookup(category, dict(vocab.FOOD_CATEGORIES))


def is_aggregate_row(category: Column) -> Column:
    return F.coalesce(category, F.lit("")).rlike(vocab.AGGREGATE_ROW)
