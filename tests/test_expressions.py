"""Column expressions against hand-written cases."""
import datetime as dt

from pyspark.sql import functions as F

from regloom.functions import classify, text, values
from regloom.operators import browse


def column(spark, items, expr):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x")).alias("y")).collect()]


def test_fold_key_drops_accents_of_every_language(spark):
    got = column(spark, ["BioMérieux", "àâäçéèêëîïôöùûüÿñ", "Größe", "Kit™ ²", "ÅØŁ", None], text.fold_key)
    assert got == ["biomerieux", "aaaceeeeiioouuuyn", "groe", "kittm2", "a", None]
    assert column(spark, ["Type \u2163 \u3396 \U0001d403 \u210c\ufb03", "\u33c2 \u2488"], text.fold_key) == ["typeivmldhffi", "am1"]


def test_tidy_slug_and_name_key(spark):
    assert column(spark, ["  STEC  (E. coli ) ;_", "a \n b"], text.tidy) == ["STEC (E. coli)", "a b"]
    assert column(spark, ["BKR 23/07-10/11 A", "--x--"], text.slug) == ["bkr-23-07-10-11-a", "x"]
    assert column(spark, ["Kit® é-1™", None], text.name_key) == ["KIT1", ""]


def test_api_id_and_lists(spark):
    assert column(spark, ["a b/c.é", "x" * 200], text.api_id) == ["a-b-c--", "x" * 64]
    assert column(spark, ["a, b ,,c ", None], text.split_list) == [["a", "b", "c"], []]
    assert column(spark, ["raw milk, beef and pork.", "sand"],
                  lambda c: text.split_list(c, True)) == [["raw milk", "beef", "pork"], ["sand"]]


def test_natural_key_orders_numbers(spark):
    keys = column(spark, ["A10", "a9", "A9b", "b1"], text.natural_key)
    assert sorted(range(4), key=lambda i: keys[i]) == [1, 2, 0, 3]
    long = column(spark, ["x9", "x1" + 24 * "0", "x007", "x" + 25 * "9"], text.natural_key)
    assert sorted(range(4), key=lambda i: long[i]) == [2, 0, 1, 3]


def test_entries_sort_as_readers_expect(spark):
    rows = spark.createDataFrame([(1, "eb"), (2, "Fa"), (3, "Éa"), (4, ""), (5, "eb 10"), (6, "eb 9")], "id int, name string")
    assert [r.name for r in browse.sort_entries(rows, "name").collect()] == ["Éa", "eb", "eb 9", "eb 10", "Fa", ""]
    assert [r.name for r in browse.sort_entries(rows, "name", descending=True, limit=2).collect()] == ["Fa", "eb 10"]


def test_certificate_from_url(spark):
    got = column(spark, [
        "https://x/BKR-23-07-10-11_fr.pdf", "https://x/3M-01-02-09-89-A_fr.docx-2.pdf",
        "https://x/AB-01-02-03-04-Axy.pdf", "https://x/AB-01-02-03-04-B", "https://x/none.pdf", None],
        values.certificate_from_url)
    assert got == ["BKR 23/07-10/11", "3M 01/02-09/89 A", "AB 01/02-03/04", "AB 01/02-03/04 B", None, None]


def test_dates(spark):
    assert column(spark, ["19-03-2027 est", "31-02-2020", "x", None], values.day_month_year) == [
        dt.date(2027, 3, 19), None, None, None]
    assert column(spark, ["Issued March 5, 2024", "Foo 5, 2024", "May 1 2020"], values.english_date) == [
        dt.date(2024, 3, 5), None, dt.date(2020, 5, 1)]
    assert column(spark, ["le 19 mai 2026", "1er janvier 2025", "3 février 2024", "x"], values.french_date) == [
        dt.date(2026, 5, 19), dt.date(2025, 1, 1), dt.date(2024, 2, 3), None]


def test_status_at_the_bound(spark):
    today = "2024-05-05"
    status = lambda c: values.status_from_expiry(F.try_to_date(c, "yyyy-MM-dd"), today)
    assert column(spark, ["2024-05-05", "2024-05-04", None, "2024-02-31"], status) == [
        "active", "expired", "unknown", "unknown"]
    stated = lambda c: values.status_as_stated(c, F.lit(None).cast("date"), today)
    assert column(spark, ["Valid", " not renewed", "Withdrawn", "Pending", None], stated) == [
        "active", "expired", "expired", "unknown", "unknown"]


def test_numbers(spark):
    assert column(spark, ["0,5", " -1.25 ", "x", "nan", "1e2", None], values.to_double) == [
        0.5, -1.25, None, None, 100.0, None]
    assert column(spark, ["D D -0,32", "12", "no"], values.last_number) == ["-0,32", "12", None]
    assert column(spark, ["AB 01 / 02 – 03/ 04"], values.printed_number) == ["AB 01/02-03/04"]


def test_expert_lab_keeps_only_plausible_names(spark):
    got = column(spark, ["ADRIA", "For", "W. Jacobs-Reitsma", "nofima", "Nofima AS", "TNO", "123"],
                 classify.expert_lab)
    assert got == ["ADRIA Développement", None, None, None, "Nofima AS", "TNO", "123"]


def test_food_category_branches(spark):
    cases = {
        "Infant formula and milk powders": "infant_formula", "Bakery": "chocolate_bakery",
        "Poultry PPS": "primary_production_samples", "Environmental samples": "environmental_samples",
        "Animal feed": "pet_food_feed", "Egg products and composite": "composite_foods",
        "Dried fruit": "dried_produce", "eggplant": "eggs", "Meat and poultry": "raw_poultry",
        "Cooked chicken": "rte_poultry", "Meat products": "raw_meat", "RTE meat": "rte_meat",
        "Fishery products": "raw_seafood", "ready-to-eat fish": "rte_seafood", "Cheese": "raw_milk_dairy",
        "UHT milk": "heat_processed_dairy", "Salads": "fresh_produce", "Fruit juice": "processed_produce",
        "Miscellaneous": None, "Vegetables and seafood products": "raw_seafood"}
    assert dict(zip(cases, column(spark, list(cases), classify.food_category))) == cases


def test_technology_precedence(spark):
    df = spark.createDataFrame([
        ("immunological_elisa", "Petrifilm", "molecular_pcr"), ("chromogenic_agar", "x", None),
        ("other", "x", None), (None, "Petrifilm X", "molecular_pcr"), (None, "Mystery", "molecular_pcr"),
        (None, "Mystery", None), ("other", "Mystery", "inhibition_assay")], "s string, n string, e string")
    got = [r[0] for r in df.select(classify.technology(F.col("s"), F.col("n"), F.col("e"))).collect()]
    assert got == ["immunological_elisa", "culture_media", "other", "culture_media", "molecular_pcr", None,
                   "inhibition_assay"]


def test_aggregate_rows(spark):
    got = column(spark, ["All categories - x", " total", "Totally", "Overall", "all good", None],
                 classify.is_aggregate_row)
    assert got == [True, True, False, True, False, False]
