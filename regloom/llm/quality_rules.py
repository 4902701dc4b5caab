"""Quality rules by robust multivariate outliers.

Every document gets a vector of transformed statistics. For each language and
source, the minimum covariance determinant (MCD) is estimated by concentration
steps over all documents of the group: take the half with the smallest
Mahalanobis distances, recompute mean and covariance, repeat. The steps run from
three deterministic starts (medians and quartile ranges, spatial signs around the
medians, plain mean and covariance), and the one whose half has the least
determinant is taken. A document is rejected by a plain base rule or by its
distance to its group's estimate.

The steps are aggregates per group with map-side partial sums: distances are
counted in fine logarithmic bins with sums of values and products, and the bins
up to the one at which half of the group is reached give the next estimate.
No group is gathered, and no row is left out.

Defined cases: null or empty text has no words and fails the base rule; null
language or source form groups of their own; groups with fewer than
``MIN_GROUP`` documents are pooled by language, and those of small languages
together; a pool that is still smaller judges nobody; equal rows get equal
verdicts; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import arrow_text as at
from .staging import keep_rows, materialize, row_key

MIN_WORDS = 50
#: Mahalanobis limit: the 1 - 1e-6 quantile of chi-square with 4 degrees of freedom.
LIMIT = 33.377
#: Median of chi-square with 4 degrees of freedom; makes the half-sample scatter consistent.
CHI2_MEDIAN = 3.357
MIN_GROUP = 40
STEPS = 5
#: Added to word counts, so that one repeated line does not reject a short text.
DAMP = 30
#: Distance bins per factor e.
BINS = 24.0
#: Least standard deviation of each transformed statistic: mean word length (log),
#: and square roots of the shares of symbols, repeated lines and repeated words.
FLOORS = (0.05, 0.06, 0.10, 0.08)
P = len(FLOORS)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
SYMBOLS = at.table(list("#*$%&|<>"))
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """Per text, lines with a word that equal an earlier line."""
    lines = pc.split_pattern(texts, "\n")
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    flat = lines.flatten()
    worded = pc.greater(pc.binary_length(pc.ascii_ltrim_whitespace(flat)), 0).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)[worded].astype(np.int64)
    owner = owner[worded].astype(np.int64)
    keys = np.unique(owner * (len(coded.dictionary) + 1) + code)
    n = len(texts)
    return np.bincount(owner, minlength=n) - np.bincount(keys // (len(coded.dictionary) + 1), minlength=n)


def repeated_words(codes: np.ndarray, distinct: int) -> int:
    """Words that lie in a 3-word window found twice or more in one text."""
    n = len(codes)
    if n < 4:
        return 0
    c = codes.astype(np.int64)
    if distinct < 1 << 21:
        keys = (c[:-2] << 42) | (c[1:-1] << 21) | c[2:]
    else:  # the same identity by ranks of pairs
        pairs = np.unique(c[:-2] * distinct + c[1:-1], return_inverse=True)[1]
        keys = pairs.astype(np.int64) * distinct + c[2:]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    window = np.zeros(n, bool)
    window[order[1:][same]] = True
    window[order[:-1][same]] = True
    covered = window.copy()
    covered[1:] |= window[:-1]
    covered[2:] |= window[:-2]
    return int(covered.sum())


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The five counts of each whole text."""
    body, bounds = at.raw(texts)
    letters = ((body & 0xC0) != 0x80) & ~at.SPACES[body]
    places, codes, distinct = at.word_codes(texts)
    ends = places.tolist()
    return {"n_words": np.diff(places), "word_chars": at.per_text(letters, bounds),
            "n_symbols": at.per_text(SYMBOLS[body], bounds), "n_dup_lines": repeated_lines(texts),
            "n_repeat_words": np.array([repeated_words(codes[a:b], len(distinct))
                                        for a, b in zip(ends, ends[1:])], np.int64)}


def statistics(docs: DataFrame) -> DataFrame:
    """(row_key, doc_id, lang, source, five counts) of every document."""
    used = docs.select(row_key(docs).alias("row_key"), "doc_id", "lang", "source", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.slices(batch):
                found = measure(at.strings(part.column("text")))
                kept = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, *[pa.array(v.astype(np.int64)) for v in found.values()]],
                    names=[*kept.schema.names, *found])

    types = dict(used.dtypes)
    keys = ", ".join(f"`{c}` {types[c]}" for c in ("row_key", "doc_id", "lang", "source"))
    return used.mapInArrow(run, f"{keys}, {COUNTS}")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector() -> list[Column]:
    n = F.col("n_words") + DAMP
    return [F.log((F.col("word_chars") + 1) / (F.col("n_words") + 1)),
            F.sqrt(F.least(F.col("n_symbols") / (F.col("word_chars") + 1), F.lit(1.0))),
            F.sqrt(F.least(F.col("n_dup_lines") / n, F.lit(1.0))),
            F.sqrt(F.col("n_repeat_words") / n)]


def with_groups(rows: DataFrame) -> DataFrame:
    """Add ``grp``: language and source, or the pool of small groups; null for
    rows that no estimate covers."""
    counts = rows.filter(~F.col("base_failed")).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("_n"))
    by_lang = counts.filter(F.col("_n") < MIN_GROUP).groupBy("lang").agg(F.sum("_n").alias("_m"))
    named = (counts.alias("c").join(by_lang.alias("l"), F.expr("c.lang <=> l.lang"), "left")
             .select(F.col("c.lang").alias("_lang"), F.col("c.source").alias("_source"), "_n", "_m",
                     F.when(F.col("_n") >= MIN_GROUP, F.to_json(F.struct(
                         F.lit(0).alias("level"), F.col("c.lang").alias("lang"), F.col("c.source").alias("source"))))
                     .when(F.col("_m") >= MIN_GROUP, F.to_json(F.struct(
                         F.lit(1).alias("level"), F.col("c.lang").alias("lang"))))
                     .otherwise(F.lit("rest")).alias("grp")))
    return (rows.join(named.select("_lang", "_source", "grp"),
                      F.expr("lang <=> _lang AND source <=> _source"), "left").drop("_lang", "_source"))


def _quantile(binned: DataFrame, keys: list[str], share: float) -> DataFrame:
    """First bin at which ``share`` of a group's rows is reached."""
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy(*keys)
    return (binned.withColumn("_c", F.sum("n").over(upto)).withColumn("_t", F.sum("n").over(total))
            .filter(F.col("_c") >= F.ceil(F.col("_t") * share)).groupBy(*keys).agg(F.min("bin").alias("bin")))


def _start(rows: DataFrame) -> DataFrame:
    """Medians and quartile ranges of each statistic: the first estimate."""
    long = rows.select("grp", F.posexplode("x").alias("dim", "v"))
    binned = long.groupBy("grp", "dim", F.floor(F.col("v") * 1000).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    found = None
    for name, share in (("lo", 0.25), ("mid", 0.5), ("hi", 0.75)):
        q = _quantile(binned, ["grp", "dim"], share).withColumnRenamed("bin", name)
        found = q if found is None else found.join(q, ["grp", "dim"])
    spread = (F.col("hi") - F.col("lo")) / 1349.0
    ordered = F.array_sort(F.collect_list(F.struct("dim", (F.col("mid") / 1000 + 0.0005).alias("m"), spread.alias("s"))))
    by = found.groupBy("grp").agg(ordered.alias("o"))
    return by.select("grp", F.transform("o", lambda r: r["m"]).alias("center"), F.array(*[
        (F.col("o")[i]["s"] * F.col("o")[j]["s"] if i == j else F.lit(0.0)) for i, j in PAIRS]).alias("cov"))


def _starts(rows: DataFrame) -> DataFrame:
    """(grp, start, center, cov): three estimates per group to begin from."""
    robust = materialize(_start(rows), "mcd-start")
    spread = [F.sqrt(F.col("cov")[PAIRS.index((i, i))]) + FLOORS[i] for i in range(P)]
    z = [(F.col("x")[i] - F.col("center")[i]) / spread[i] for i in range(P)]
    signed = (rows.join(robust, "grp").withColumn("_z", F.array(*z))
              .withColumn("_r2", F.greatest(sum((F.col("_z")[i] * F.col("_z")[i] for i in range(P)), F.lit(0.0)), F.lit(1e-12))))
    means = signed.groupBy("grp").agg(
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(P)],
        *[F.avg(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}{j}") for i, j in PAIRS],
        *[F.avg(F.col("_z")[i] * F.col("_z")[j] / F.col("_r2")).alias(f"u{i}{j}") for i, j in PAIRS])
    both = means.join(robust, "grp")
    signs = both.select("grp", F.lit(1).alias("start"), "center", F.array(*[
        P * F.col(f"u{i}{j}") * spread[i] * spread[j] for i, j in PAIRS]).alias("cov"))
    plain = both.select("grp", F.lit(2).alias("start"), F.array(*[F.col(f"m{i}") for i in range(P)]).alias("center"), F.array(*[
        F.col(f"p{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") for i, j in PAIRS]).alias("cov"))
    return robust.select("grp", F.lit(0).alias("start"), "center", "cov").unionByName(signs).unionByName(plain)


def _inverted(estimates: DataFrame) -> DataFrame:
    """Add the inverse and the determinant of each covariance, its eigenvalues held
    above the floors' variances. One small row per group and start."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        floor = np.diag(np.square(FLOORS))
        for frame in frames:
            inverse, det = [], []
            for cov in frame["cov"]:
                full = np.zeros((P, P))
                for (i, j), v in zip(PAIRS, cov):
                    full[i, j] = full[j, i] = v
                inverse.append([float(v) for v in np.linalg.inv(full + floor)[tuple(zip(*PAIRS))]])
                det.append(float(np.linalg.det(full + floor)))
            yield pd.DataFrame({"grp": frame["grp"], "start": frame["start"], "center": frame["center"],
                                "inverse": inverse, "determinant": det})

    return estimates.select("grp", "start", "center", "cov").mapInPandas(
        run, "grp string, start int, center array<double>, inverse array<double>, determinant double")


def _distance() -> Column:
    d = [F.col("x")[i] - F.col("center")[i] for i in range(P)]
    return sum(((1.0 if i == j else 2.0) * F.col("inverse")[k] * d[i] * d[j] for k, (i, j) in enumerate(PAIRS)),
               F.lit(0.0))


def _concentrated(placed: DataFrame) -> DataFrame:
    """Per group and start, mean and covariance of the rows with the smallest
    distances: whole distance bins, up to the one at which half of the rows is
    reached. One aggregate over the rows; the rest works on bins."""
    sums = [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(P)]
    sums += [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}{j}") for i, j in PAIRS]
    bins = (placed.groupBy("grp", "start", F.floor(F.log(F.col("d2") + 1e-9) * BINS).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), *sums))
    before = Window.partitionBy("grp", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    inner = (bins.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .withColumn("_all", F.sum("n").over(Window.partitionBy("grp", "start")))
             .filter(F.col("_before") < F.ceil(F.col("_all") / 2)))
    total = inner.groupBy("grp", "start").agg(F.max("bin").alias("half"), F.sum("n").alias("n"), *[
        F.sum(c).alias(c) for c in bins.columns if c not in ("grp", "start", "bin", "n")])
    return total.select(
        "grp", "start", "half", F.array(*[F.col(f"s{i}") / F.col("n") for i in range(P)]).alias("center"),
        F.array(*[F.col(f"p{i}{j}") / F.col("n") - F.col(f"s{i}") * F.col(f"s{j}") / F.col("n") / F.col("n")
                  for i, j in PAIRS]).alias("cov"))


def estimate(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """(grp, center, inverse, determinant, scale): of the concentration steps from each
    start, those that end at the least determinant; of equal ones the first start.
    ``rows`` has grp and the vector x, and is read once per step."""
    now = materialize(_inverted(_starts(rows)), "mcd")
    for _ in range(steps):
        now = materialize(_inverted(_concentrated(rows.join(now, "grp").withColumn("d2", _distance()))), "mcd")
    least = now.groupBy("grp").agg(F.min_by(F.struct("start", "center", "inverse", "determinant"),
                                            F.struct("determinant", "start")).alias("_best"))
    best = materialize(least.select("grp", "_best.*"), "mcd-least")
    middle = _concentrated(rows.join(best, "grp").withColumn("d2", _distance())).select("grp", "half")
    # Written, so that its size is known to be small where it meets all rows.
    return materialize(best.join(middle, "grp").select("grp", "center", "inverse", "determinant", F.greatest(
        F.exp((F.col("half") + 1) / BINS) / CHI2_MEDIAN, F.lit(1.0)).alias("scale")), "mcd-estimates")


def judge(docs: DataFrame, limit: float = LIMIT, steps: int = STEPS) -> DataFrame:
    """One row per document: counts, base_failed, distance, kept, row_key."""
    counted = materialize(statistics(docs), "quality")
    rows = counted.withColumn("base_failed", base_failed()).withColumn("x", F.array(*_vector()))
    rows = materialize(with_groups(rows), "quality")
    fitted = rows.filter(~F.col("base_failed") & F.col("grp").isNotNull())
    sizes = fitted.groupBy("grp").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= MIN_GROUP)
    estimates = estimate(fitted.select("grp", "x"), steps).join(sizes.select("grp"), "grp", "left_semi")
    return (rows.join(estimates, "grp", "left")
            .withColumn("distance", _distance() / F.col("scale"))
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True)))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                    "distance", "lang", "source", "row_key"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass, with all their columns."""
    return keep_rows(docs, materialize(judge(docs, **options).filter("kept").select("row_key"), "quality-kept"))
