"""Choosing the pages of a report that can hold its results tables."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import vocab
from ..functions.staged import once
from ..session import materialize, union


def _needed(branch: str) -> str:
    """The longest text of ASCII letters and blanks that every match of a branch holds,
    or none where that is not plain to see."""
    bare = branch.replace(r"\b", "\0")
    if re.search(r"[\\?*+{}()^$]", bare):
        return ""
    return max(re.findall(r"[A-Za-z ]+", re.sub(r"\[[^\]]*\]", "\0", bare)), key=len, default="").lower()


def _has_signal(text: Column, low: Column, ascii_: Column, pattern: str) -> Column:
    """Whether any branch of the pattern occurs, whatever its case. Branches of
    plain words are substring tests, which are far cheaper than expressions; an ASCII
    text meets the others only if it holds what their matches must hold."""
    test = F.lit(False)
    rest, needed = [], []
    for branch in pattern.split("|"):
        if all(ch.isalpha() or ch == " " for ch in branch):
            test = test | F.contains(low, F.lit(branch.lower()))
        else:
            rest.append(branch)
            needed.append(_needed(branch))
    if rest:
        may = F.lit(True)
        if all(needed):
            may = ~ascii_
            for word in needed:
                may = may | F.contains(low, F.lit(word))
        test = test | (may & text.rlike("(?iU)" + "|".join(rest)))
    return F.coalesce(test, F.lit(False))


def page_kinds(text: Column, low: Column, signals=vocab.PAGE_SIGNALS) -> Column:
    """How many kinds of signal a page has; ``low`` is the lower-case text."""
    plain = F.length(text) == F.octet_length(text)
    return sum((_has_signal(text, low, plain, s).cast("int") for s in signals), F.lit(0))


def page_score(text: Column, kinds: Column, number: str = vocab.PAGE_NUMBER) -> Column:
    """Twice the kinds of signal present plus up to six for decimal numbers
    (one per five); zero without any signal."""
    numbers = F.coalesce(F.regexp_count(text, F.lit(number)), F.lit(0))
    bonus = F.least(F.floor(numbers / 5), F.lit(6))
    return F.when(kinds == 0, 0).otherwise(kinds * 2 + bonus).cast("int")


def score_pages(pages: DataFrame, doc: str = "doc_id", page: str = "page_no", text: str = "text",
                signals=vocab.PAGE_SIGNALS, number: str = vocab.PAGE_NUMBER) -> DataFrame:
    """Map-only: (document, page, score). No text leaves this stage; text, lower-case text and
    kinds are worked out once a page, whatever reads them."""
    staged = once(pages.select(doc, page, text), {"_text": F.col(text)}).drop(text)
    staged = once(staged, {"_low": F.lower("_text")})
    staged = once(staged, {"_kinds": page_kinds(F.col("_text"), F.col("_low"), signals)})
    return staged.select(doc, page, page_score(F.col("_text"), F.col("_kinds"), number).alias("score"))


def _greedy(ranked: Column, budget: int) -> Column:
    """Fold of a short ranked list into the kept pages. A page is taken with
    its successor unless the two would exceed the budget; the successor counts
    even when the document ends before it."""

    def step(keep: Column, item: Column) -> Column:
        page, last = item["page"], item["last"]
        grown = F.array_union(keep, F.array(page, page + 1))
        real = F.when(page == last, F.array_union(keep, F.array(page))).otherwise(grown)
        return F.when(F.size(grown) <= budget, real).otherwise(keep)

    return F.aggregate(ranked, F.array(F.lit(0)), step)


def select_pages(scored: DataFrame, budget: int = vocab.PAGE_BUDGET, doc: str = "doc_id",
                 page: str = "page_no", score: str = "score") -> DataFrame:
    """Pages worth reading, ``(document, page)``, pages numbered from 0.

    Every page of a short document and of one where nothing scores; else page 0
    and, by (score, page) descending, each scored page with its successor while
    the budget allows.

    The order-dependent choice is exact without collecting a document's pages.
    While at most ``budget - 2`` pages are kept every candidate is accepted, and
    a candidate that adds nothing is itself a kept page, so the first
    ``2 * budget`` candidates (a limited ranking, cut before the shuffle) bring
    the selection to ``budget - 1`` pages or exhaust the list. From there on a
    candidate can only be accepted if it or its successor is kept already, and
    at most one such page adds anything: the best-ranked candidate behind the
    prefix with exactly one of the two kept, found by an equi-join on page.
    """
    prefix = 2 * budget
    # Written once: four branches read it, and page text is scored a single time.
    s = materialize(scored.select(
        F.col(doc).alias("doc"), F.col(page).cast("int").alias("page"),
        F.col(score).alias("score")), "scores")
    docs = s.groupBy("doc").agg(F.count(F.lit(1)).alias("n_pages"), F.max("page").alias("last"),
                                F.max("score").alias("best"))
    whole = docs.filter((F.col("n_pages") <= budget) | (F.col("best") <= 0)).select("doc")
    partly = docs.filter((F.col("n_pages") > budget) & (F.col("best") > 0))
    candidates = s.filter(F.col("score") > 0)
    ranking = Window.partitionBy("doc").orderBy(F.desc("score"), F.desc("page"))
    head = (candidates.withColumn("rn", F.row_number().over(ranking)).filter(F.col("rn") <= prefix)
            .groupBy("doc")
            .agg(F.sort_array(F.collect_list(F.struct("score", "page")), asc=False).alias("top")))
    kept = (partly.join(head, "doc")
            .withColumn("ranked", F.transform("top", lambda t: F.struct(
                t["page"].alias("page"), F.col("last").alias("last"))))
            .withColumn("keep", _greedy(F.col("ranked"), budget))
            .withColumn("floor", F.when(F.size("top") == prefix, F.element_at("top", -1))))
    # Documents one page short whose ranking goes on behind the prefix.
    short = kept.filter((F.size("keep") == budget - 1) & F.col("floor").isNotNull())
    # A candidate i has exactly one of {i, i+1} kept when i is k or k-1 for a kept k.
    near = (short.select("doc", "floor", "keep", "last", F.explode_outer("keep").alias("k"))
            .select("doc", "floor", "keep", "last",
                    F.explode_outer(F.array(F.col("k"), F.col("k") - 1)).alias("page"))
            .distinct())
    extra = (near.join(candidates, ["doc", "page"])
             .filter(F.struct("score", "page") < F.col("floor"))
             .withColumn("has", F.array_contains("keep", F.col("page")))
             .withColumn("has_next", F.array_contains("keep", F.col("page") + 1))
             .filter(F.col("has") != F.col("has_next"))
             .withColumn("adds", F.when(~F.col("has"), F.col("page"))
                         .when(F.col("page") < F.col("last"), F.col("page") + 1))
             .filter(F.col("adds").isNotNull())
             .groupBy("doc").agg(F.max_by("adds", F.struct("score", "page")).alias("page")))
    chosen = union(kept.select("doc", F.explode_outer("keep").alias("page")), extra)
    everything = s.join(whole, "doc", "left_semi").select("doc", "page")
    return union(everything, chosen).select(
        F.col("doc").alias(doc), F.col("page").alias(page))


def page_ranges(selected: DataFrame, doc: str = "doc_id", page: str = "page_no") -> DataFrame:
    """Gaps and islands: ``(document, first, last, part)`` with 1-based text
    such as ``44-47``. Every page tells its neighbours of itself, so starts and ends come
    from one reading of the selection, grouped by page, which no hot document can pile up."""
    p = F.col(page)
    told = F.array(*[F.struct(at.alias("page"), *[F.when(F.lit(name == mark), True).alias(name) for name in ("_s", "_b", "_a")])
                     for at, mark in ((p, "_s"), (p + 1, "_b"), (p - 1, "_a"))])
    edges = (selected.select(F.col(doc).alias("doc"), F.inline(told)).groupBy("doc", "page")
             .agg(*[F.max(name).alias(name) for name in ("_s", "_b", "_a")])
             .filter("_s AND (_b IS NULL OR _a IS NULL)"))
    order = Window.partitionBy("doc").orderBy("page")
    starts = (edges.withColumn("end", F.when(F.col("_a").isNull(), F.col("page"))
                               .otherwise(F.lead("page").over(order)))
              .filter("_b IS NULL"))
    first, last = F.col("page") + 1, F.col("end") + 1
    return starts.select(F.col("doc").alias(doc), first.alias("first"), last.alias("last"),
                         F.when(first == last, first.cast("string"))
                         .otherwise(F.concat_ws("-", first, last)).alias("part"))


def format_pages(selected: DataFrame, doc: str = "doc_id", page: str = "page_no") -> DataFrame:
    """One text per document such as ``1, 44-47``. Meant for a selection within
    the page budget; documents kept whole are one range."""
    parts = page_ranges(selected, doc, page)
    listed = F.array_sort(F.collect_list(F.struct("first", "part")))
    return parts.groupBy(doc).agg(
        F.array_join(F.transform(listed, lambda x: x["part"]), ", ").alias("pages"))
