"""Table walks against a sequential reading of the same rows."""
import random
import re

from regloom.operators import cells
from regloom.functions.running import running_max
from pyspark.sql import functions as F

HEADER = ["Category", "n", "bias", "SD", "95% lower", "95% upper"]


def to_cells(spark, tables):
    rows = []
    for (doc, page, no), grid in tables.items():
        for r, values in enumerate(grid):
            rows += [(doc, page, no, r, c, v) for c, v in enumerate(values)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(
        rows, "doc_id string, page_no int, table_no int, row_no int, col_no int, cell string").repartition(3)


def random_grid(rng, size):
    metrics = lambda: [f"-0,{rng.randint(1, 9)}", f"0.{rng.randint(1, 9)}", "-0.2", "0,3"]
    grid = [HEADER[:4] + ["95%", "95%"], [None, None, None, None, "lower", "upper"]]
    grid[0][4:] = ["95% lower", "95% upper"]
    grid[1][4:] = ["limit", "limit"]
    for k in range(size):
        kind = rng.choice(["flat", "label", "total", "item", "all", "blank"])
        grid.append({"flat": [str(k), f"Cat {k}", str(rng.randint(1, 60))] + metrics(),
                     "label": [str(k), f"Label {k}"], "total": ["Total"] + metrics(),
                     "item": ["a", "thing", "x"], "all": ["All categories", "9"] + metrics(),
                     "blank": [" ", None]}[kind])
    grid.insert(2, ["1", "Cat first", "7"] + metrics())
    return grid


def sequential(grid):
    out, pending = [], None
    for values in ([v.strip() for v in row if v and v.strip()] for row in grid[2:]):
        if not values or re.match("all categor", values[0], re.I):
            continue
        if len(values) == 7:
            out.append((values[1], values[2:]))
        elif len(values) == 5 and values[0] == "Total":
            if pending:
                out.append((pending, values))
            pending = None
        elif len(values) <= 2 and values[0].isdigit():
            pending = values[-1]
    return out


def test_walk_equals_sequential_reading(spark):
    rng = random.Random(3)
    tables = {(f"d{i}", 0, 1): random_grid(rng, 30) for i in range(25)}
    got = {}
    for r in cells.relative_trueness(cells.table_rows(to_cells(spark, tables))).orderBy("row_no").collect():
        got.setdefault(r.doc_id, []).append((r.category, r.bias_log, r.sd_log, r.n_samples))
    number = lambda s: float(s.replace(",", "."))
    want = {doc: [(name, number(m[1]), number(m[2]), int(m[0]) if m[0].isdigit() else None)
                  for name, m in sequential(grid)] for (doc, _, _), grid in tables.items()}
    assert got == want


def test_blocks_carry_over(spark):
    rng = random.Random(2)
    rows = [(k, i, rng.randint(0, 99) if rng.random() < 0.2 else None) for k in "ab" for i in range(200)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    for inclusive in (True, False):
        got = {(r.k, r.i): r.best for r in running_max(
            df, ["k"], "i", {"best": F.col("v")}, inclusive, block=16).collect()}
        for k, i, _ in rows:
            seen = [v for kk, j, v in rows if kk == k and v is not None and (j <= i if inclusive else j < i)]
            assert got[(k, i)] == (max(seen) if seen else None)


def test_first_matching_table_wins_and_total_rows_replace(spark):
    head = ["Category", "SE alt", "SE ref", "RT"]
    units = [None, "%", "%", "%"]
    tables = {("d", 0, 0): [["Sample", "SE"], ["1", "x", "1", "2", "3"]],
              ("d", 2, 0): [head, units, ["1", "Meat", "a", "beef", "90,5", "91", "99"], ["b", "pork", "1", "2", "3"],
                            ["Total", "95", "96", "99"], ["2", "Total", "7", "8", "9"], ["Total", "1", "1", "1"],
                            ["3", "Fish", "80", "81", "82"], ["All categories", "1", "2", "3"]],
              ("d", 3, 0): [head, ["1", "Later", "1", "2", "3"]],
              ("e", 0, 0): [["1", "Category", "SE alt", "SE ref"]]}
    got = [(r.doc_id, r.category, r.sensitivity_alternative_pct, r.sensitivity_reference_pct) for r in
           cells.method_comparison(cells.table_rows(to_cells(spark, tables))).orderBy("row_no").collect()]
    assert got == [("d", "Meat", 95.0, 96.0), ("d", "Fish", 80.0, 81.0)]


def test_rows_in_lists_are_neither_shuffled_nor_changed(spark):
    """The same rows as from single cells, odd white space and blank leading cells included."""
    grids = {("d", 1, 0): random_grid(random.Random(7), 60) + [[None, " a  b", "c"], ["", "\t"], ["x\ny", None, "z  z "]]}
    listed = spark.createDataFrame([(d, p, t, r, row) for (d, p, t), grid in grids.items() for r, row in enumerate(grid)],
                                   "doc_id string, page_no int, table_no int, row_no int, cells array<string>")
    got = cells.listed_rows(listed)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = cells.table_rows(to_cells(spark, grids)).orderBy("row_no").collect()
    assert [r.asDict() for r in got.orderBy("row_no").collect()] == [r.asDict() for r in want]
    for make in (cells.headers, cells.relative_trueness):
        both = [sorted(map(str, make(rows).collect())) for rows in (got, cells.table_rows(to_cells(spark, grids)))]
        assert both[0] == both[1] and both[0]


def test_rows_behind_data_rows_meet_no_header(spark):
    """Header rows in a block behind the first data row, and above it in several blocks."""
    rows = [("d", 0, 0, 0, ["Category", "SD"]), ("d", 0, 0, 9000, ["more", "bias"]), ("d", 0, 0, 9001, ["1", "x"]),
            ("d", 0, 0, 9002, ["Total", "y"]), ("d", 0, 0, 20000, ["Total", "z"]), ("e", 0, 0, 3, ["1", "2"]), ("f", 0, 0, 3, ["a", "2"])]
    df = spark.createDataFrame(rows, "doc_id string, page_no int, table_no int, row_no int, cells array<string>")
    assert [(r.doc_id, r.data_start, r.labels) for r in cells.headers(cells.listed_rows(df)).collect()] == [
        ("d", 9001, ["Category more", "SD bias"])]
