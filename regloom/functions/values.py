"""Numbers, dates, certificate numbers, status and links as column expressions."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from .. import vocab
from .staged import bound
from .text import blank_to_null, find, squeeze

DATE = "date"


def _date_literal(today: str | dt.date) -> Column:
    return F.lit(str(today)).cast(DATE)


def certificate_from_url(url: Column) -> Column:
    """``.../BKR-23-07-10-11_fr.pdf`` gives ``BKR 23/07-10/11``; a single
    letter counts only right before a separator or the end."""
    code = find(F.element_at(F.split(url, "/"), -1), vocab.URL_NUMBER, 0)
    printed = F.regexp_replace(
        code, r"^(\w+)[_-](\d+)[_-](\d+)[_-](\d+)[_-](\d+)(?:[_-]([A-Z]))?$", "$1 $2/$3-$4/$5 $6")
    return F.rtrim(printed)


def printed_number(c: Column) -> Column:
    """A number as printed, with dashes unified and no blanks round ``/`` or dash."""
    tight = F.regexp_replace(squeeze(c), r"\s*/\s*", "/")
    return F.regexp_replace(tight, r"\s*[" + vocab.DASHES + r"]\s*", "-")


def day_month_year(c: Column) -> Column:
    """Date from a ``dd-MM-yyyy`` prefix; impossible dates give null."""
    return F.try_to_date(find(c, r"^(\d{2}-\d{2}-\d{4})"), "dd-MM-yyyy")


def _month_number(word: Column, months: list[str]) -> Column:
    pairs = [F.lit(x) for i, month in enumerate(months, 1) for x in (month, i)]
    return F.try_element_at(F.create_map(*pairs), F.lower(word))


def _iso(year: Column, month: Column, day: Column) -> Column:
    """A missing part leaves a text that is no date."""
    return F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-M-d")


def _part(words: Column, i: int) -> Column:
    return F.try_element_at(words, F.lit(i))


def english_date(c: Column) -> Column:
    """First ``Month d, yyyy`` in a text. Only the first candidate counts."""
    words = F.split(F.regexp_extract(c, r"([A-Za-z]+)\s+(\d{1,2}),?\s+(\d{4})", 0), r",?\s+")
    return bound(words, lambda w: _iso(_part(w, 3), _month_number(_part(w, 1), vocab.ENGLISH_MONTHS), _part(w, 2)))


def french_date(c: Column) -> Column:
    """First ``d mois yyyy`` in a text; the first of a month may read ``1er``."""
    words = F.split(F.regexp_extract(c, r"(?U)(\d{1,2})(?:er)?\s+(\p{L}+)\s+(\d{4})", 0),
                    r"(?U)(?<=\d)er\s+|\s+")
    return bound(words, lambda w: _iso(_part(w, 3), _month_number(_part(w, 2), vocab.FRENCH_MONTHS), _part(w, 1)))


def dotted_dates(c: Column) -> Column:
    """All ``dd.MM.yyyy`` or ``dd/MM/yyyy`` dates of a text as ISO text, in order."""
    found = F.regexp_extract_all(c, F.lit(r"(\d{2}[./]\d{2}[./]\d{4})"), 1)
    return F.transform(found, lambda d: F.concat_ws(
        "-", F.substring(d, 7, 4), F.substring(d, 4, 2), F.substring(d, 1, 2)))


def status_from_expiry(expiry: Column, today) -> Column:
    return (F.when(expiry.isNull(), "unknown")
            .when(expiry >= _date_literal(today), "active").otherwise("expired"))


def status_as_stated(stated: Column, expiry: Column, today) -> Column:
    """A stated "valid" is checked against the expiry; other words decide alone."""
    word = F.lower(F.trim(F.coalesce(stated, F.lit(""))))
    return (F.when(word == "valid", F.when(expiry < _date_literal(today), "expired")
                   .otherwise("active"))
            .when(word.isin("not renewed", "withdrawn", "expired"), "expired")
            .otherwise("unknown"))


def to_double(c: Column) -> Column:
    """Number with decimal comma or point; anything else is null."""
    text = F.replace(F.trim(c), F.lit(","), F.lit("."))
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def last_number(c: Column) -> Column:
    return F.try_element_at(F.regexp_extract_all(c, F.lit(r"(-?\d+[.,]?\d*)"), 1), F.lit(-1))


def last_double(c: Column) -> Column:
    """``to_double`` of ``last_number``; a text that is a number alone is not searched for others."""
    alone = c.rlike(r"^-?[0-9]+[.,]?[0-9]*\z")
    return F.when(alone, F.replace(c, F.lit(","), F.lit(".")).try_cast("double")).otherwise(to_double(last_number(c)))


def months_left(expiry: Column, today) -> Column:
    return F.datediff(expiry, _date_literal(today)) / F.lit(30.44)


def expiry_class(expiry: Column, today) -> Column:
    left = months_left(expiry, today)
    return F.when(left < 0, "bad").when(left < 12, "warn").when(left >= 12, "ok")


def heat_level(n: Column) -> Column:
    """0 for an empty cell, else 1 to 4."""
    return F.when(n == 0, 0).otherwise(
        F.least(F.lit(4), F.greatest(F.lit(1), F.ceil(n * 4 / 10)))).cast("int")


def registry_url(source: Column) -> Column:
    chain = F.lit(None).cast("string")
    for name, url in reversed(list(vocab.REGISTRY_URLS.items())):
        chain = F.when(source == name, url).otherwise(chain)
    return chain


def links(source: Column, summary_url: Column, certificate_url: Column,
          source_url: Column, registry: Column | None = None) -> Column:
    """Report and listing links, each falling back to the registry's page."""
    registry = registry_url(source) if registry is None else registry
    summary, page = blank_to_null(summary_url), blank_to_null(source_url)
    return F.struct(
        F.coalesce(summary, registry).alias("summary_report_url"),
        summary.isNotNull().alias("summary_report_is_direct"),
        certificate_url.alias("certificate_url"),
        F.coalesce(page, registry).alias("source_page_url"))


def list_note(label: Column, status: Column, expiry: Column, certificate_url: Column,
              summary_url: Column) -> Column:
    """Provenance note of a list row. Whether a study report exists is only
    said when the detail page was read, that is, gave a certificate link."""

    def shown(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("'"), c, F.lit("'")), F.lit("None"))

    head = F.concat(F.lit(vocab.NOTE_LABEL), shown(label),
                    F.lit(vocab.NOTE_STATUS), shown(status),
                    F.lit(vocab.NOTE_EXPIRY), shown(expiry), F.lit("."))
    report = F.when(certificate_url.isNotNull(), F.when(
        summary_url.isNull(), vocab.NOTE_NO_REPORT).otherwise(vocab.NOTE_REPORT))
    return F.concat_ws(" ", head, report)
