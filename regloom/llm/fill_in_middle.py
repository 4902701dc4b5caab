"""Fill-in-the-middle texts by one counted-quantifier match a row.

A text is a row of units, each a run of ASCII letters or one other character.
``regexp_count`` gives their number n, hashes of the id give two cuts a <= b, and
a pattern made for the row, ``(unit{a})(unit{b-a})(rest)`` with possessive
counts, captures prefix, middle and suffix in one match. Possessive counts never
give a unit back, so the match is one walk over the text without a stack, at any
length. The whole path is built-in functions in the scan's stage: no shuffle.

Of the markers' order two are used: prefix, suffix, middle (psm) and suffix,
prefix, middle (spm). ``restored`` gives the exact text back from output and form.

Defined cases: null and empty texts are plain, with n 0; texts that hold a
marker stay plain; one unit or very long texts are cut like others; a null id
is hashed as the word null; repeated rows and rows of one id give equal cuts
for equal texts; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
#: The same unit for counted groups: a run of letters is taken whole.
WHOLE_UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKER = "<[PSM]>"
#: Of 100 texts so many are transformed, and of 100 transformed ones so many are spm.
RATE, SPM_RATE = 90, 20
SEED = "1"


def _numbers(doc_id: Column, seed: str) -> list[Column]:
    """The first four 32-bit numbers of the hash of the seed and an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: str = SEED) -> DataFrame:
    """doc_id, text (null: empty), n units, form (plain, psm or spm), output, and of
    the transformed texts prefix_chars and middle_chars in code points."""
    h1, h2, h3, h4 = (F.col(f"h{k}") for k in range(1, 5))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.select(
        "*", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"),
        *[h.alias(f"h{k}") for k, h in enumerate(_numbers(F.col("doc_id"), seed), 1)])
    cuts = counted.select(
        "doc_id", "text", "n", F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)).alias("a"),
        F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)).alias("b"),
        F.when((F.col("n") == 0) | F.col("text").rlike(MARKER) | (h3 % 100 >= rate), "plain")
        .when(h4 % 100 < spm_rate, "spm").otherwise("psm").alias("form"))
    pattern = F.concat(F.lit(rf"(?s)\A({WHOLE_UNIT}" "{"), F.col("a"), F.lit(f"}}+)({WHOLE_UNIT}" "{"),
                       F.col("b") - F.col("a"), F.lit(r"}+)(.*)\z"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    made = cuts.select("doc_id", "text", "n", "form", F.when(F.col("form") == "plain", F.col("text")).otherwise(
        F.regexp_replace("text", pattern, order)).alias("output"))
    return made.select("*", *[F.when(F.col("form") != "plain", F.char_length(c)).cast("long").alias(name)
                              for name, c in zip(("prefix_chars", "middle_chars"), _parts())])


def _parts() -> tuple[Column, Column, Column]:
    """Prefix, middle and suffix between the markers of a transformed output."""
    pieces = F.split("output", MARKER, -1)
    spm = F.col("form") == "spm"
    return F.when(spm, pieces[2]).otherwise(pieces[1]), pieces[3], F.when(spm, pieces[1]).otherwise(pieces[2])


def restored(made: DataFrame) -> DataFrame:
    """Rows of ``transform`` with the text rebuilt from output and form alone."""
    prefix, middle, suffix = _parts()
    return made.withColumn("restored", F.when(F.col("form") == "plain", F.col("output")).otherwise(
        F.concat(prefix, middle, suffix)))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the hashes of output and
    rebuilt text, as lower-case hex of their UTF-8 bytes."""
    back = restored(transform(docs))
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
