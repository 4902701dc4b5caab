"""Column expressions over free text. All stay on the JVM.

Arrays made by costly expressions are unrolled with the ``outer`` generators and
a null filter behind them: for the plain ones Spark adds a filter on the array's
size below the projection, which would evaluate the expression twice.
"""
from __future__ import annotations

import json
import unicodedata

from pyspark.sql import Column, functions as F

# White space of any kind as a plain class, which matches faster than (?U)\s. Characters up to U+00FF are
# single ones, which the class looks up in a table; the others are tested behind one range that most texts miss.
BLANK = r"[\t\n\x0b\f\r \x85\xa0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
INLINE = BLANK.replace(r"\n", "")
SPACE = BLANK + "+"
# What squeezing changes: runs, and single characters other than a plain blank, which most of them are.
UNEVEN = rf"{BLANK}(?:{BLANK}+|(?<! ))"
WHITE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _folds() -> tuple[str, str, dict[str, str]]:
    """What every character leaves of its compatibility decomposition in lower
    case: ASCII letters and digits. Single ones for ``translate``, longer ones
    by character."""
    plain, folded, longer = [], [], {}
    for code in range(0xA0, 0x20000):
        ch = chr(code)
        parts = unicodedata.normalize("NFKD", ch)
        if parts == ch:
            continue
        out = "".join(c for c in parts.lower() if c.isascii() and c.isalnum())
        if len(out) == 1:
            plain.append(ch)
            folded.append(out)
        elif out:
            longer[ch] = out
    return "".join(plain), "".join(folded), longer


_PLAIN, _FOLDED, _LONGER = _folds()


def _ranges(chars) -> str:
    """A short character class: runs of neighbours, and all beyond U+024F as one."""
    codes = sorted(ord(c) for c in chars if ord(c) < 0x250)
    runs: list[list[int]] = []
    for code in codes:
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]|[^\\x00-\\x{24f}]"


_MAY_BE_LONG = _ranges(_LONGER)


def fold_key(c: Column) -> Column:
    """Accent-, case- and punctuation-free comparison key. Plain ASCII needs no
    table; the few characters that stand for several letters are looked up one
    by one, in texts that may have any."""
    table = F.from_json(F.lit(json.dumps(_LONGER)), "map<string,string>")
    spelled = F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    folded = F.translate(F.when(c.rlike(_MAY_BE_LONG), spelled).otherwise(c), _PLAIN, _FOLDED)
    return F.regexp_replace(F.lower(F.when(c.rlike(r"[^\x00-\x7f]"), folded).otherwise(c)), "[^a-z0-9]+", "")


def strip(c: Column) -> Column:
    """Trim white space of any kind, also no-break spaces."""
    return F.btrim(c, F.lit(WHITE))


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(c, UNEVEN, " "))


def tidy(c: Column) -> Column:
    """Squeeze, drop blanks before a closing bracket, strip loose punctuation."""
    return F.btrim(F.regexp_replace(squeeze(c), r"\s+([)\]])", "$1"), F.lit(" ,;_-"))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def slug(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def record_id(source: Column, number: Column) -> Column:
    return F.concat_ws("--", slug(source), slug(number))


def name_key(c: Column) -> Column:
    """Upper-case letters and digits only; a null name has the empty key."""
    return F.coalesce(F.regexp_replace(F.upper(c), "[^A-Z0-9]+", ""), F.lit(""))


def api_id(c: Column, width: int = 64) -> Column:
    """Identifier limited to letters, digits, ``_`` and ``-``. Cutting may
    make two names equal, see ``results.split_collisions``."""
    return F.substring(F.regexp_replace(c, "[^A-Za-z0-9_-]", "-"), 1, width)


def split_list(c: Column, on_and: bool = False) -> Column:
    """Comma list to trimmed items without empties; a null list is empty.
    With ``on_and`` the word "and" separates too and full stops are trimmed."""
    parts = F.split(c, r",|\band\b" if on_and else ",")
    trim = (lambda x: F.btrim(F.regexp_replace(x, SPACE, " "), F.lit(" ."))) if on_and else strip
    items = F.filter(F.transform(parts, trim), lambda x: x != "")
    return F.coalesce(items, F.array().cast("array<string>"))


def find(c: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that gives null, not '', when nothing matched."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def natural_key(c: Column) -> Column:
    """Sort key in which case is ignored and digit runs compare as numbers of
    any length: by their number of digits, then by the digits."""

    def coded(part: Column) -> Column:
        digits = F.ltrim(part, F.lit("0"))
        return F.when(part.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), 9, "0"), digits)).otherwise(part)

    return F.array_join(F.transform(F.regexp_extract_all(F.lower(c), F.lit("([0-9]+|[^0-9]+)"), 1), coded), "")


def present(c: Column) -> Column:
    """Neither null nor the empty string."""
    return c.isNotNull() & (c != "")
