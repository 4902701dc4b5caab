"""Near-duplicate documents by bottom-k sketches.

One hash function is applied to all word shingles of a whole text; the k
smallest values are its sketch. Documents with equal shingle sets are one class
from the start. Then, over classes:

1. Overlaps. Inverted lists of the retained values are built, rarest values
   first: two documents whose sketches share at least c values share one among
   their s - c + 1 rarest, so only these are listed. For the documents that
   meet there, lists are built again from sketches of ``K_FINE`` values, which
   hold the whole set of most documents; values found in one document only
   bound what it can share with any other.
2. Links. In each list the least edited document is compared with all others,
   which joins large groups of copies into components by a number of
   comparisons in proportion to the lists. Then all pairs of a list that lie in
   different components and can still be linked are compared.
3. A comparison estimates the similarity from the bottom-k of both sketches'
   union; estimates above ``CUTOFF`` are confirmed on the full sets.

Sets of at most 3/4 of a sketch are compared exactly at once; for larger ones c
lies 4.6 standard deviations below the expected overlap of documents that are
just similar enough. No list is cut off, and a value that a third of all
documents hold is split by adaptive joins.

Defined cases: texts without words, and null texts, have no shingles and are
linked with nothing; a text of fewer than five words has one shingle, all its
words; rows without doc_id are linked with
nothing; an empty table gives an empty result; other columns are ignored by
``clusters`` and carried by ``one_of_each``.

Loss where doc_id is not unique: rows of one doc_id with different texts are one
node where their texts are the first of their classes, so each also joins what
the other is linked with; and ``one_of_each`` keeps a single row of a doc_id,
which one is not defined, so an unlike text of the same doc_id is lost.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import arrow_text as at, shingles
from .components import components
from .staging import materialize

K, LEAST = 64, 32
K_FINE, LEAST_FINE = 1024, 700
#: Estimated similarity, from sketches of K values, below which a pair is not confirmed.
CUTOFF = 0.5
#: Links need PART * intersection >= WHOLE * union.
PART, WHOLE = 100, 75


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, print, sketch) of every row."""
    used = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.slices(batch, most=3 << 20):
                sets = shingles.shingle_sets(at.strings(part.column("text")))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                             pa.binary()),
                    pa.array([s[:K] for s in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "print", "sketch"])

    return used.mapInArrow(run, f"doc_id {dict(used.dtypes)['doc_id']}, n_shingles long, print binary, sketch array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """(id, n, hashes): whole shingle sets, for the documents given."""
    used = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.slices(batch, most=3 << 20):
                sets = shingles.shingle_sets(at.strings(part.column("text")))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(sets, pa.list_(pa.int64()))], names=["id", "n", "hashes"])

    return used.mapInArrow(run, f"id {dict(used.dtypes)['doc_id']}, n long, hashes array<long>")


def _least_shared(n: Column, k: int, least: int) -> Column:
    """Values that the sketches of two linked documents share, seen from one of n shingles."""
    exact = F.ceil(n * WHOLE / PART)
    return F.when(n * PART <= k * WHOLE, exact).otherwise(F.least(exact, F.lit(least))).cast("int")


def inverted(rows: DataFrame, values: str, k: int, least: int) -> DataFrame:
    """(value, id, n, shared, rank): the lists, each document under its rarest
    values. ``shared`` counts a document's values that any other document
    holds, ``rank`` is the value's place among them."""
    posted = rows.select("id", "n", F.size(values).alias("s"), F.explode(values).alias("value"))
    common = posted.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    held = posted.join(common, "value")
    per = Window.partitionBy("id")
    c = _least_shared(F.col("n"), k, least)
    held = (held.withColumn("shared", F.count(F.lit(1)).over(per))
            .withColumn("rank", F.row_number().over(per.orderBy("df", "value"))))
    held = held.filter((F.col("shared") >= c) & (F.col("rank") <= F.col("shared") - c + 1))
    return held.select("value", "id", "n", "shared", "rank")


def _lists_of_two(lists: DataFrame) -> DataFrame:
    many = lists.groupBy("value").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return lists.join(many.select("value"), "value", "left_semi")


def _need(a: Column, b: Column) -> Column:
    """Values that the fine sketches of two linked documents of these sizes share."""
    return F.when(F.greatest(a, b) <= K_FINE, F.ceil(WHOLE * (a + b) / (PART + WHOLE))).otherwise(LEAST_FINE)


def _can_link() -> Column:
    """Of two list members: sizes and shared values allow the similarity."""
    a, b = F.col("n"), F.col("n2")
    return ((PART * F.least(a, b) >= WHOLE * F.greatest(a, b)) & (F.least("shared", "shared2") >= _need(a, b)))


def _first_places() -> Column:
    """Linked documents share a value among the rarest of both, as far as their
    own sizes demand, and enough values can follow it."""
    need, ahead = _need(F.col("n"), F.col("n2")), F.least("rank", "rank2")
    return ((F.col("rank") <= F.col("shared") - need + 1) & (F.col("rank2") <= F.col("shared2") - need + 1)
            & (ahead + F.least(F.col("shared") - F.col("rank"), F.col("shared2") - F.col("rank2")) >= need))


def estimated(a: Column, b: Column) -> Column:
    """Similarity from the bottom-k of the union of two sketches."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, K)
    return F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.size(union)


def confirmed(pairs: DataFrame, small: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that are similar: estimated first, then on the full sets."""
    left = small.select(F.col("id").alias("a"), F.col("sketch").alias("sa"))
    right = small.select(F.col("id").alias("b"), F.col("sketch").alias("sb"))
    likely = materialize(pairs.join(left, "a").join(right, "b").filter(estimated(F.col("sa"), F.col("sb")) >= CUTOFF)
                         .select("a", "b"), "likely")
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    return (likely.join(left, "a").join(right, "b").withColumn("_both", both)
            .filter(PART * F.col("_both") >= WHOLE * (F.col("na") + F.col("nb") - F.col("_both"))).select("a", "b"))


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) of the classes that are linked to others. ``classes``:
    id, n, sketch, one row per distinct set."""
    met = materialize(_lists_of_two(inverted(classes, "sketch", K, LEAST)).select("id").distinct(), "met")
    sets = materialize(full_sets(docs.select("doc_id", "text").join(
        met, F.col("doc_id") == F.col("id"), "left_semi")), "sets")
    small = sets.select("id", F.slice("hashes", 1, K).alias("sketch"))
    lists = materialize(_lists_of_two(inverted(
        sets.select("id", "n", F.slice("hashes", 1, K_FINE).alias("values")), "values", K_FINE, LEAST_FINE)), "lists")
    leader = lists.groupBy("value").agg(F.max_by(
        F.struct("id", "n", "shared"), F.struct(F.col("shared") / F.col("n"), F.col("id"))).alias("_l"))
    led = (lists.join(leader.select("value", F.col("_l.id").alias("id2"), F.col("_l.n").alias("n2"),
                                    F.col("_l.shared").alias("shared2")), "value")
           .filter((F.col("id") != F.col("id2")) & _can_link()))
    first = materialize(confirmed(_pairs(led), small, sets), "links")
    known = materialize(components(first), "parts")
    placed = (lists.join(known.withColumnRenamed("node", "id"), "id", "left")
              .withColumn("component", F.coalesce("component", "id")))
    mixed = placed.groupBy("value").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).filter("_lo < _hi")
    placed = materialize(placed.join(mixed.select("value"), "value", "left_semi"), "open-lists")
    other = placed.select("value", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "shared", "rank", "component")])
    across = placed.join(other, "value").filter((F.col("component") < F.col("component2")) & _can_link() & _first_places())
    more = confirmed(_pairs(across), small, sets)
    return components(first.unionByName(more))


def clusters(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    rows = materialize(sketches(docs), "sketches")
    usable = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("print").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"),
                                          F.first("sketch").alias("sketch"))
    classes = materialize(classes, "classes")
    found = links(docs, classes.select("id", "n", "sketch"))
    named = classes.select("print", "id").join(found, F.col("id") == F.col("node"), "left").select(
        "print", F.coalesce("component", "id").alias("_component"))
    whole = F.coalesce("_component", "doc_id").alias("component_id")
    return (rows.join(named, "print", "left").select("doc_id", "n_shingles", whole)
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each group of near copies; rows
    without doc_id stay."""
    kept = materialize(clusters(docs).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct(), "kept")
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*[f"`{c}`" for c in docs.columns])
    return named.unionByName(docs.filter("doc_id IS NULL"))
