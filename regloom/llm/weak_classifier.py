"""Quality classifier from weak labels.

Nine heuristic labellers read a whole text and each vote good, bad or nothing.
Expectation-maximisation over the counts of all vote patterns estimates how
often each labeller gives each vote on good and on bad documents, without any
given label; a pattern's posterior is the probability of bad. Posteriors label
a bounded sample (``TRAIN_ROWS``), on which a linear scorer over hashed words,
word shapes and repeats is trained by averaged passes over its partitions. The
scorer then judges every document.

The only tables that reach the driver are bounded by parameters: the vote
patterns (at most 3 to the power of the labellers) and one weight vector per
training partition.

Defined cases: null and empty texts have no votes and no features, and are
judged by the prior alone, capped so that they are kept; equal texts get equal
scores; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import arrow_text as at, quality_rules
from .staging import keep_rows, materialize, row_key

#: Per labeller: name of a share of the text, the least or largest share of a
#: bad text, and that of a good one (None: never votes good). The first three see
#: any kind of junk, the others one kind each, so that votes overlap.
LABELLERS = {
    "function_words": ("<", 0.03, 0.08), "plain_words": ("<", 0.75, None), "sentence_ends": ("<", 0.01, None),
    "symbols": (">", 0.05, None), "shouting": (">", 0.40, None), "marks": (">", 0.20, None),
    "repeats": (">", 0.30, None), "runs": (">", 0.10, None), "bare": (">", 0.15, None)}
LEAST_WORDS = 12
BETTER = 10.0
#: Probability of bad above which a document is rejected.
THRESHOLD = 0.25
#: Frequent function words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "the of and to in is that it for was on are with as be this at by from or an have not "
    "de la le et les des en un du une que est pour qui dans au par sur pas ce "
    "der die und das ist von zu den mit nicht ein eine auf dem im sich des es für auch "
    "el y los se del las por con no su para lo como más pero").split()
GOOD, BAD, NONE = 0, 1, 2
BUCKETS = 1 << 15
TRAIN_ROWS = 20_000
TRAIN_PARTS = 4
ROUNDS, EPOCHS, RATE, BATCH, DECAY = 3, 6, 0.5, 64, 1e-5
UPPER, LOWER = at.table(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ")), at.table(list("abcdefghijklmnopqrstuvwxyz"))
MARKS = at.table(list("!?"))


def _runs(bounds: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Whether a word equals the one before it in its text."""
    same = np.zeros(len(codes), bool)
    same[1:] = codes[1:] == codes[:-1]
    starts = bounds[:-1]
    same[starts[starts < len(codes)]] = False
    return same


def votes(texts: pa.Array) -> np.ndarray:
    """(texts, labellers) votes."""
    body, places = at.raw(texts)
    bounds, codes, words = at.word_codes(texts)
    n = np.diff(bounds)
    ends = bounds.tolist()

    def of_words(flags: np.ndarray) -> np.ndarray:
        return at.per_text(flags[codes], bounds) / np.maximum(n, 1)

    def matching(pattern: str) -> np.ndarray:
        return pc.match_substring_regex(words, pattern).to_numpy(zero_copy_only=False)

    repeats = np.array([quality_rules.repeated_words(codes[a:b], len(words)) for a, b in zip(ends, ends[1:])], np.int64)
    letters = at.per_text(UPPER[body], places) + at.per_text(LOWER[body], places)
    chars = at.per_text(~at.SPACES[body], places)
    shares = {
        "function_words": of_words(pc.is_in(words, pa.array(FUNCTION_WORDS)).to_numpy(zero_copy_only=False)),
        "plain_words": of_words(matching(r"^\p{L}?[\p{Ll}\p{Lo}\p{M}'-]*[.,;:!?]?$")),
        "sentence_ends": of_words(matching(r"[\p{Ll}\p{Lo}][.!?]$")),
        "symbols": at.per_text(quality_rules.SYMBOLS[body], places) / np.maximum(chars, 1),
        "shouting": at.per_text(UPPER[body], places) / np.maximum(letters, 1),
        "marks": at.per_text(MARKS[body], places) / np.maximum(n, 1),
        "repeats": repeats / np.maximum(n, 1),
        "runs": at.per_text(_runs(bounds, codes), bounds) / np.maximum(n, 1),
        "bare": of_words(~matching(r"[\p{L}\p{N}]"))}
    out = np.full((len(texts), len(LABELLERS)), NONE, np.int64)
    for k, (name, (side, bad, good)) in enumerate(LABELLERS.items()):
        sign = 1 if side == ">" else -1
        value = sign * shares[name]
        out[:, k] = np.where(value > sign * bad, BAD, NONE)
        if good is not None:
            out[value < sign * good, k] = GOOD
    out[n < LEAST_WORDS] = NONE
    return out


def patterns(docs: DataFrame) -> DataFrame:
    """(row_key, pattern): the votes as digits of one number."""
    base = 3 ** np.arange(len(LABELLERS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.slices(batch):
                found = votes(at.strings(part.column("text"))) @ base
                yield pa.RecordBatch.from_arrays([part.column("row_key"), pa.array(found)],
                                                 names=["row_key", "pattern"])

    return docs.select(row_key(docs).alias("row_key"), "text").mapInArrow(run, "row_key long, pattern long")


def fit_labellers(counts: dict[int, int], rounds: int = 60) -> tuple[dict[int, float], np.ndarray, float]:
    """Posterior of bad per pattern, vote rates (class, labeller, vote), and the
    prior of bad, by expectation-maximisation from the majority of votes."""
    m = len(LABELLERS)
    keys = np.array(sorted(counts), np.int64)
    weight = np.array([counts[k] for k in keys.tolist()], float)
    digits = (keys[:, None] // 3 ** np.arange(m)) % 3
    bad, good = (digits == BAD).sum(1), (digits == GOOD).sum(1)
    posterior = (bad + 0.1) / (bad + good + 1.0)
    posterior[bad > 0] = np.maximum(posterior[bad > 0], 0.6)
    hot = np.stack([digits == v for v in range(3)], axis=2).astype(float)
    for _ in range(rounds):
        mass = np.stack(((1 - posterior) * weight, posterior * weight))
        # One pseudo-vote each way, and a weak belief that labellers beat chance.
        rates = np.einsum("cp,pmv->cmv", mass, hot) + 1.0
        rates[0, :, GOOD] += 1.0
        rates[1, :, BAD] += 1.0
        rates /= rates.sum(2, keepdims=True)
        # A labeller's bad votes are taken to be ``BETTER`` times as frequent on bad documents at least.
        rates[0, :, BAD] = np.minimum(rates[0, :, BAD], rates[1, :, BAD] / BETTER)
        prior = np.clip((mass[1].sum() + 1) / (weight.sum() + 2), 0.01, 0.5)
        log = np.einsum("pmv,cmv->cp", hot, np.log(rates)) + np.log([[1 - prior], [prior]])
        posterior = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return dict(zip(keys.tolist(), posterior.tolist())), rates, float(prior)


def _buckets(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of each word and of its shape."""
    from pandas.util import hash_array
    lower = pc.utf8_lower(words).to_numpy(zero_copy_only=False)
    shape = words
    for pattern, letter in ((r"\p{Lu}+", "A"), (r"[\p{L}\p{M}]*[\p{Ll}\p{Lo}\p{M}][\p{L}\p{M}]*", "a"), (r"\p{N}+", "0")):
        shape = pc.replace_substring_regex(shape, pattern, letter)
    shape = pc.utf8_slice_codeunits(shape, 0, 8).to_numpy(zero_copy_only=False)
    half = BUCKETS // 2
    return ((hash_array(lower, categorize=False) % (half - 1)).astype(np.int64),
            half + (hash_array(shape, categorize=False) % half).astype(np.int64))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, buckets and values of a sparse matrix: shares of words, shapes and
    repeats of the word before (the last bucket of words)."""
    bounds, codes, words = at.word_codes(texts)
    n = np.diff(bounds)
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    word, shape = _buckets(words)
    row = np.repeat(np.arange(len(texts)), n)
    run = np.flatnonzero(_runs(bounds, codes))
    keys = np.concatenate((row * BUCKETS + word[codes], row * BUCKETS + shape[codes],
                           row[run] * BUCKETS + BUCKETS // 2 - 1))
    keys, counts = np.unique(keys, return_counts=True)
    rows = keys // BUCKETS
    return rows, keys % BUCKETS, counts / n[rows]


def _training_rows(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """(row_key, p, buckets, values) of the sampled documents."""
    keyed = docs.select(row_key(docs).alias("row_key"), "text").join(labelled, "row_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.slices(batch, most=4 << 20):
                rows, buckets, values = features(at.strings(part.column("text")))
                bounds = np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(v)) for v in (
                    buckets.astype(np.int32), values.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([part.column("row_key"), part.column("p"), *lists],
                                                 names=["row_key", "p", "buckets", "values"])

    return keyed.mapInArrow(run, "row_key long, p double, buckets array<int>, values array<float>")


def _pass(weights: np.ndarray, scale: np.ndarray, table: pa.Table, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Epochs of stochastic gradient steps (per-weight rates) over one partition."""
    table = table.sort_by("row_key")
    p = table.column("p").to_numpy()
    buckets, values = (table.column(c).combine_chunks() for c in ("buckets", "values"))
    bounds = buckets.offsets.to_numpy()
    flat, share = buckets.values.to_numpy(), values.values.to_numpy()
    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        rows = order.permutation(len(p))
        for i in range(0, len(rows), BATCH):
            some = rows[i:i + BATCH]
            sizes = bounds[some + 1] - bounds[some]
            spots = np.repeat(bounds[some] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            owner = np.repeat(np.arange(len(some)), sizes)
            b, v = flat[spots], share[spots]
            z = weights[-1] + np.bincount(owner, weights[b] * v, len(some))
            err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - p[some]
            grad = np.bincount(b, err[owner] * v, len(weights))
            grad[-1] = err.sum()
            used = np.flatnonzero(grad)
            g = grad[used] / len(some) + DECAY * weights[used]
            scale[used] += g * g
            weights[used] -= RATE * g / np.sqrt(scale[used] + 1e-8)
    return weights, scale


def train(rows: DataFrame, parts: int = TRAIN_PARTS) -> np.ndarray:
    """Weights (last one the bias): every partition trains from the shared
    weights, and these are averaged, ``ROUNDS`` times."""
    spread = materialize(rows.repartition(parts, "row_key"), "weak-train")
    weights = np.zeros(BUCKETS + 1)
    for turn in range(ROUNDS):
        start = spread.sparkSession.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            held = [b for b in batches if b.num_rows]
            if held:
                table = pa.Table.from_batches(held)
                found, _ = _pass(start.value.copy(), np.full(len(start.value), 1e-4), table, turn)
                yield pa.RecordBatch.from_arrays([pa.array([table.num_rows]), pa.array([found.tobytes()])],
                                                 names=["n", "w"])

        found = spread.mapInArrow(run, "n long, w binary").collect()
        if not found:
            return weights
        found.sort(key=lambda r: (r["n"], r["w"]))
        weights = np.average([np.frombuffer(r["w"]) for r in found], axis=0, weights=[r["n"] for r in found])
    return weights


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, dict]:
    """Weights of the scorer, and what was estimated of the labellers."""
    voted = materialize(patterns(docs), "weak-votes")
    counts = {r["pattern"]: r["n"] for r in voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if not total:
        return np.zeros(BUCKETS + 1), {"prior": 0.0, "rates": None}
    posterior, rates, prior = fit_labellers(counts)
    label = F.element_at(F.create_map(*[F.lit(x) for kv in posterior.items() for x in kv]), F.col("pattern"))
    sampled = voted.filter(F.pmod(F.xxhash64(F.lit("train"), "row_key"), F.lit(1 << 40))
                           < int(min(1.0, train_rows / total) * (1 << 40))).dropDuplicates(["row_key"])
    rows = _training_rows(docs, sampled.select("row_key", label.alias("p")))
    return train(rows), {"prior": prior, "rates": rates}


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(row_key, doc_id, p_bad) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            for part in at.slices(batch):
                bounds, codes, words = at.word_codes(at.strings(part.column("text")))
                z = np.zeros(part.num_rows)
                if len(codes):
                    word, shape = _buckets(words)
                    each = (w[word] + w[shape])[codes] + w[BUCKETS // 2 - 1] * _runs(bounds, codes)
                    sums = np.concatenate(([0.0], np.cumsum(each)))
                    z = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)
                p = 1 / (1 + np.exp(-np.clip(z + w[-1], -30, 30)))
                p = np.where(np.diff(bounds) == 0, np.minimum(p, THRESHOLD), p)
                yield pa.RecordBatch.from_arrays([part.column("row_key"), part.column("doc_id"), pa.array(p.round(9))],
                                                 names=["row_key", "doc_id", "p_bad"])

    used = docs.select(row_key(docs).alias("row_key"), "doc_id", "text")
    return used.mapInArrow(run, f"row_key long, doc_id {dict(used.dtypes)['doc_id']}, p_bad double")


def classify(docs: DataFrame, threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(row_key, doc_id, p_bad, kept) of every document."""
    weights, _ = fit(docs, train_rows)
    return score(docs, weights).withColumn("kept", F.col("p_bad") <= threshold)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that the scorer keeps, with all their columns."""
    return keep_rows(docs, materialize(classify(docs, **options).filter("kept").select("row_key"), "weak-kept"))
