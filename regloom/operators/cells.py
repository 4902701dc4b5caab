"""Category rows of results tables, from a long table of cells.

``report_cells(doc_id, page_no, table_no, row_no, col_no, cell)``, or the rows as
lists of cells; a table is (document, page, table). Rows of a table are never
gathered: what one row needs to know of earlier rows comes from ``running_max``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import schemas
from ..functions import values
from ..functions.running import BLOCK, running_max
from ..functions.text import squeeze
from ..session import materialize, union

TABLE = ["doc_id", "page_no", "table_no"]
_ALL = r"(?i)^all\s+(categor|product)"
_DIGITS = r"^\d+$"


def _squeezed(c: Column) -> Column:
    """``squeeze`` of a plain column: ASCII without white space other than single blanks needs
    no expression. The column is read several times, so it must be cheap."""
    odd = F.length(c) != F.octet_length(c)
    for blank in ("  ", "\t", "\n", "\r", "\x0b", "\f"):
        odd = odd | F.contains(c, F.lit(blank))
    return F.when(odd, squeeze(c)).otherwise(F.trim(c))


def table_rows(cells: DataFrame) -> DataFrame:
    """One row per table row: its non-blank cells (blank ones are the spans of
    merged cells) and their columns, in column order. Written to the shared
    folder, as finding headers, numbering and reading data all start from it.

    A cell is squeezed once, before the shuffle, and blank ones become null
    there, which a collected list leaves out.
    """
    squeezed = F.nullif(_squeezed(F.col("cell")), F.lit(""))
    ordered = F.array_sort(F.collect_list(F.when(F.col("cell").isNotNull(), F.struct("col_no", "cell"))))
    grouped = cells.select(*TABLE, "row_no", "col_no", squeezed.alias("cell")).groupBy(*TABLE, "row_no").agg(ordered.alias("_c"))
    return materialize(grouped.filter(F.size("_c") > 0).select(
        *TABLE, "row_no", F.element_at("_c", 1)["cell"].alias("first"), F.transform("_c", lambda x: x["cell"]).alias("values"),
        F.transform("_c", lambda x: x["col_no"]).alias("cols")), "table-rows")


def listed_rows(rows: DataFrame) -> DataFrame:
    """The same from rows that come whole, ``(doc_id, page_no, table_no, row_no, cells)`` with the
    cells of a row in a list. Nothing is shuffled or written, so rows dealt by document stay so
    in all that follows. The first cell is read alone: most tests on rows need no other."""
    filled = F.filter(F.transform("cells", _squeezed), lambda x: x != "")
    # One test a row: most rows are plain and need their cells trimmed only.
    whole = F.array_join("cells", "|")
    plain = (F.length(whole) == F.octet_length(whole)) & ~whole.rlike(r"[\t-\r]|  ")
    filled = F.when(plain, F.array_remove(F.array_compact(F.transform("cells", lambda x: F.trim(x))), "")).otherwise(filled)
    cols = F.filter(F.transform("cells", lambda x, i: F.when(_squeezed(x) != "", i)), lambda i: i.isNotNull())
    lead = _squeezed(F.try_element_at("cells", F.lit(1)))
    first = F.when(lead != "", lead).otherwise(F.try_element_at(filled, F.lit(1)))
    return rows.select(*TABLE, "row_no", first.alias("first"), filled.alias("values"), cols.alias("cols")).filter("first IS NOT NULL")


def is_data_row(first: Column) -> Column:
    # Their first character spares most rows the expressions.
    lead = F.substring(first, 1, 1)
    return (lead.between("0", "9") & first.rlike(_DIGITS)) | (lead.isin("a", "A") & first.rlike(_ALL))


def data_starts(rows: DataFrame) -> DataFrame:
    """First data row per table, by a partial aggregate. Tables that begin with
    data, or have none, carry no header and are left out."""
    first = F.col("first")
    spans = rows.groupBy(*TABLE).agg(
        F.min(F.when(is_data_row(first), F.col("row_no"))).alias("data_start"),
        F.min("row_no").alias("_top"))
    return spans.filter(F.col("data_start") > F.col("_top")).drop("_top")


def headers(rows: DataFrame) -> DataFrame:
    """Labels per table: header rows are joined column by column, blank columns
    dropped. Columns: table key, data_start, labels."""
    # Data rows cannot be header rows; leaving them out first keeps the join small.
    # Nor can rows behind a data row of their own block, which are dropped before any join.
    top = Window.partitionBy(*TABLE, "_block").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    above = (rows.withColumn("_block", F.floor(F.col("row_no") / BLOCK)).withColumn("_data", is_data_row(F.col("first")))
             .withColumn("_below", F.max("_data").over(top)).filter(~F.col("_below")).drop("_block", "_data", "_below", "first"))
    heads = (above
             .join(data_starts(rows), TABLE).filter(F.col("row_no") < F.col("data_start")))
    parts = (heads.select(*TABLE, "data_start", "row_no",
                          F.explode_outer(F.arrays_zip("cols", "values")).alias("z"))
             .groupBy(*TABLE, "data_start", F.col("z.cols").alias("col_no"))
             .agg(F.array_join(F.transform(
                 F.array_sort(F.collect_list(F.struct("row_no", "z.values"))),
                 lambda x: x["values"]), " ").alias("label")))
    return parts.groupBy(*TABLE, "data_start").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("col_no", "label"))), lambda x: x["label"])
        .alias("labels"))


def tables_with(header: DataFrame, keywords: list[str]) -> DataFrame:
    """Tables whose joined header contains every keyword."""
    haystack = F.lower(F.array_join("labels", " "))
    for word in keywords:
        header = header.filter(F.contains(haystack, F.lit(word)))
    return header


def data_rows(rows: DataFrame, header: DataFrame) -> DataFrame:
    """Data rows of the given tables, without cross-category rows."""
    return (rows.drop("cols").join(header, TABLE)
            .filter(F.col("row_no") >= F.col("data_start"))
            .filter(~F.col("first").rlike(_ALL)))


def _labels(heads: Column) -> Column:
    """Labels of a list of header rows ``(row_no, cols, values)``: those of ``headers``."""
    def label(col: Column) -> Column:
        parts = F.flatten(F.transform(heads, lambda h: F.transform(
            F.filter(F.arrays_zip(h["cols"].alias("cols"), h["values"].alias("values")), lambda z: z["cols"] == col),
            lambda z: F.struct(h["row_no"].alias("row_no"), z["values"].alias("value")))))
        return F.array_join(F.transform(F.array_sort(parts), lambda x: x["value"]), " ")

    cols = F.array_sort(F.array_distinct(F.flatten(F.transform(heads, lambda h: h["cols"]))))
    return F.transform(cols, label)


def _in_block(upto: int | None = None):
    """Rows of a block in order: all that come before, up to so many from the row on."""
    order = Window.partitionBy(*TABLE, "_block").orderBy("row_no")
    return order if upto is None else order.rowsBetween(Window.unboundedPreceding, upto)


def headed_rows(rows: DataFrame, keywords: list[str], places: dict[str, Column]) -> DataFrame:
    """Data rows of the tables that lie in their first block and whose header has the keywords,
    with ``width`` (labels) and the ``places`` worked out on the labels. All is found along one
    order of the rows of a block, so rows dealt by document are read once and not joined.
    ``_far`` marks the first row of each later block instead: its table is not among these alone."""
    first, top = F.col("first"), F.col("row_no") == F.col("_top")
    far = F.col("_block") > 0
    whole = _in_block(Window.unboundedFollowing)
    marked = (rows.withColumn("_block", F.greatest(F.floor(F.col("row_no") / BLOCK), F.lit(0)))
              .withColumn("_data_start", F.min(F.when(is_data_row(first), F.col("row_no"))).over(whole))
              .withColumn("_top", F.min("row_no").over(whole))
              .filter((far & top) | (~far & (F.col("_data_start") > F.col("_top")))))
    above = F.when(F.col("row_no") < F.col("_data_start"), F.struct("row_no", "cols", "values"))
    listed = marked.withColumn("_heads", F.when(top, F.collect_list(above).over(whole))).drop("cols")
    labels = F.col("labels")
    good = F.lit(True)
    for word in keywords:
        good = good & F.contains(F.lower(F.array_join(labels, " ")), F.lit(word))
    header = F.struct(F.size(labels).alias("width"), *[c.alias(name) for name, c in places.items()])
    headed = (listed.withColumn("labels", F.when(~far & top, _labels(F.col("_heads")))).drop("_heads")
              .withColumn("_header", F.when(labels.isNotNull() & good, header)).drop("labels")
              .withColumn("_header", F.max("_header").over(_in_block(0))))
    return (headed.filter(far | (F.col("_header").isNotNull() & (F.col("row_no") >= F.col("_data_start")) & ~(F.substring(first, 1, 1).isin("a", "A") & first.rlike(_ALL))))
            .select(*TABLE, "_block", "row_no", "first", "values", far.alias("_far"), "_header.*"))


def _by_block(found: DataFrame, rows: DataFrame, walk) -> DataFrame:
    """What was found in first blocks; tables that go on behind are walked whole instead."""
    found = materialize(found, "table-results")
    far = found.filter("_far").select(*TABLE).distinct()
    near = found.filter("NOT _far").drop("_far")
    if far.isEmpty():
        return near
    return union(near.join(far, TABLE, "left_anti"), walk(rows.join(far, TABLE, "left_semi")))


def walk_categories(rows: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Rows that carry a category's metrics: (table, row, category, metrics)
    and the ``carry`` columns; metrics line up with the labels after the first.

    Flat rows hold number, name and metrics. Otherwise a label-only row names
    the category and the next ``Total`` row holds its metrics, once.
    """
    marked = (rows.withColumn("kind", _kind(F.size("labels"))).filter("kind IS NOT NULL")
              .drop("labels", "data_start", "first"))
    return _walked(running_max(marked, TABLE, "row_no", _last(), inclusive=False), carry)


def _kind(width: Column) -> Column:
    size, first = F.size("values"), F.col("first")
    flat = size == width + 1
    total = (size == width - 1) & (F.lower(first) == "total")
    return F.when(flat, "flat").when(total, "total").when((size <= 2) & first.rlike(_DIGITS), "label")


def _last() -> dict[str, Column]:
    return {"last_label": F.when(F.col("kind") == "label", F.struct(
                F.col("row_no").alias("row"), F.element_at("values", -1).alias("name"))),
            "last_total": F.when(F.col("kind") == "total", F.col("row_no"))}


def _walked(seen: DataFrame, carry: list[str]) -> DataFrame:
    pending = (F.col("last_label").isNotNull()
               & (F.col("last_total").isNull() | (F.col("last_label.row") > F.col("last_total"))))
    kept = seen.filter((F.col("kind") == "flat") | ((F.col("kind") == "total") & pending))
    is_flat = F.col("kind") == "flat"
    return kept.select(
        *TABLE, "row_no", *carry,
        F.when(is_flat, F.try_element_at("values", F.lit(2))).otherwise(F.col("last_label.name"))
        .alias("category"),
        F.when(is_flat, F.slice("values", 3, F.greatest(F.size("values") - 2, F.lit(0))))
        .otherwise(F.col("values")).alias("metrics"))


def _place(test) -> Column:
    """Where a row's metrics hold the value of the first label (after the
    category) that passes ``test``; a label that occurs twice means its last
    column. Worked out once per table, on its header."""
    rest = F.slice("labels", 2, F.greatest(F.size("labels") - 1, F.lit(0)))
    label = F.try_element_at(F.filter(rest, test), F.lit(1))
    back = F.array_position(F.reverse(rest), label)
    return (F.size(rest) - back + 1).cast("int")


def first_table(rows: DataFrame) -> DataFrame:
    """Rows of the first table of each document that yields any; ``rows`` are stored. Only
    documents with rows of several tables meet their first one."""
    at = F.struct("page_no", "table_no")
    several = rows.groupBy("doc_id").agg(F.min(at).alias("_t"), F.max(at).alias("_last")).filter("_t <> _last").drop("_last")
    return rows.join(several, "doc_id", "left").filter(F.col("_t").isNull() | (at == F.col("_t"))).drop("_t")


def relative_trueness(table_rows: DataFrame) -> DataFrame:
    """Quantitative rows per category, from ``table_rows``. Needs a standard deviation and both
    limits; the count is taken from the column labelled with the word ``n``."""
    def having(word: str) -> Column:
        return _place(lambda x: F.contains(F.lower(x), F.lit(word)))

    places = {"_bias": having("bias"), "_sd": having("sd"), "_lower": having("lower"),
              "_upper": having("upper"), "_n": _place(lambda x: F.lower(x).rlike(r"\bn\b"))}

    def number(c: str) -> Column:
        return values.last_double(F.col(c))

    def shown(walked: DataFrame, *more: str) -> DataFrame:
        cells = walked.select(*TABLE, "row_no", "category", *more, *[
            F.try_element_at("metrics", F.col(c)).alias(c) for c in places])
        count = F.when(F.col("_n").rlike(_DIGITS), F.col("_n").try_cast("int"))
        complete = F.col("_sd").isNotNull() & F.col("_lower").isNotNull() & F.col("_upper").isNotNull()
        return cells.filter(complete | F.col("_far") if more else complete).select(
            *TABLE, "row_no", "category", *more, number("_bias").alias("bias_log"), number("_sd").alias("sd_log"),
            count.alias("n_samples"), count.alias("n_interpretable"), number("_lower").alias("lower_limit_95"),
            number("_upper").alias("upper_limit_95"))

    def walk(rows: DataFrame) -> DataFrame:
        header = tables_with(headers(rows), keywords).withColumns(places)
        return shown(walk_categories(data_rows(rows, header), carry=list(places)))

    keywords = ["category", "sd"]
    headed = (headed_rows(table_rows, keywords, places)
              .withColumn("kind", F.when(F.col("_far"), "flat").otherwise(_kind(F.col("width")))).filter("kind IS NOT NULL").drop("first"))
    for name, value in _last().items():
        headed = headed.withColumn(name, F.max(value).over(_in_block(-1)))
    return first_table(_by_block(shown(_walked(headed, ["_far", *places]), "_far"), table_rows, walk))


def _from_end(*words: str) -> Column:
    """1-based place from the end of the first label with all words, not
    counting labels that are only a percent sign."""
    real = F.filter("labels", lambda x: F.trim(x) != "%")
    label_at = F.transform(real, lambda x, i: F.when(
        _all_in(F.lower(x), words), i))
    first = F.array_min(label_at)
    return F.size(real) - first


def _all_in(c: Column, words: tuple[str, ...]) -> Column:
    test = F.lit(True)
    for word in words:
        test = test & F.contains(c, F.lit(word))
    return test


def method_comparison(table_rows: DataFrame) -> DataFrame:
    """Qualitative rows per category, from ``table_rows``. A row led by a number opens a category;
    a later ``Total`` row replaces its values; a category named Total is void.
    Values are read by their place from the end of the row."""
    keywords, places = ["category", "se"], {"_alt": _from_end("se", "alt"), "_ref": _from_end("se", "ref")}
    placed = "_alt IS NOT NULL AND _ref IS NOT NULL"
    opens, totals = F.col("first").rlike(_DIGITS), F.lower("first") == "total"

    def shown(rows: DataFrame, *more: str) -> DataFrame:
        alt = F.try_element_at("values", -F.col("_alt"))
        ref = F.try_element_at("values", -F.col("_ref"))
        complete = (F.col("category").isNotNull() & (F.lower(F.trim("category")) != "total") & alt.isNotNull() & ref.isNotNull())
        return rows.filter(complete | F.col("_far") if more else complete).select(
            *TABLE, "row_no", "category", *more,
            values.last_double(alt).alias("sensitivity_alternative_pct"),
            values.last_double(ref).alias("sensitivity_reference_pct"))

    def walk(rows: DataFrame) -> DataFrame:
        header = tables_with(headers(rows), keywords).withColumns(places).filter(placed)
        kinds = data_rows(rows, header).withColumn("opens", opens).filter(F.col("opens") | totals)
        segments = running_max(kinds.drop("first", "labels", "data_start"), TABLE, "row_no",
                               {"segment": F.when(F.col("opens"), F.col("row_no"))})
        return shown(segments.filter("segment IS NOT NULL")
                     .groupBy(*TABLE, F.col("segment").alias("row_no"), "_alt", "_ref")
                     .agg(F.max_by("values", "row_no").alias("values"),
                          F.max(F.when(F.col("opens"), F.try_element_at("values", F.lit(2)))).alias("category")))

    # In a block a category's last row is the one before the next that opens.
    kinds = (headed_rows(table_rows, keywords, places).withColumn("opens", opens)
             .filter(F.col("_far") | (F.expr(placed) & (F.col("opens") | totals))).drop("first"))
    segments = (kinds.withColumn("_open", F.max(F.when(F.col("opens"), F.struct(
        F.col("row_no").alias("row"), F.try_element_at("values", F.lit(2)).alias("name")))).over(_in_block(0)))
        .withColumn("_next", F.lead("opens").over(_in_block()))
        .filter(F.col("_far") | (F.col("_open").isNotNull() & F.coalesce("_next", F.lit(True)))))
    ends = segments.select(*TABLE, F.when(F.col("_far"), F.col("row_no")).otherwise(F.col("_open.row")).alias("row_no"),
                           F.col("_open.name").alias("category"), "values", "_far", "_alt", "_ref")
    return first_table(_by_block(shown(ends, "_far"), table_rows, walk))


QUANTITATIVE_METRICS = [f.name for f in schemas.QUANTITATIVE_ROW.fields if f.name != "category"]
QUALITATIVE_METRICS = ["sensitivity_alternative_pct", "sensitivity_reference_pct"]
