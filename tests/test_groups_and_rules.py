"""Products over registries, rule tables, laboratories over page breaks, streams by event time."""
import datetime as dt
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from regloom import vocab
from regloom.functions import rules, text
from regloom.operators import evidence, products, rule_table
from regloom.streaming import arrivals, incremental, quota

WORDS = ["alpha", "gamma", "quick", "check", "plate", "broth", "total", "count", "medium", "agar", "plus", "one"]


def _changed(rng, name):
    out = list(name)
    for _ in range(rng.randint(1, 3)):
        i = rng.randrange(len(out))
        out[i:i + rng.randint(0, 1)] = rng.choice(["", "x", "q"])
        out = out or ["a"]
    return "".join(out)


def _names():
    rng = random.Random(4)
    names = ["Megabrand " + " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) + rng.choice(["", "™", " 2", "-X"])
             for _ in range(350)]
    names += [_changed(rng, n) for n in names[:100]]
    names += ["".join(rng.choice("abcdefgh12") for _ in range(rng.randint(5, 30))) for _ in range(80)]
    return names + [_changed(rng, n) for n in names[-80:]] + ["", None, "--", "ab", "abcdefg", "abcdefgx", "abcdefgh", "Quick", "quick"]


def _distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


def _key(name):
    return re.sub("[^A-Z0-9]+", "", (name or "").upper())


def test_product_groups_equal_brute_force(spark):
    names = _names()
    keys = sorted({_key(n) for n in names} - {""})
    parent = {k: k for k in keys}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            most = min(len(a) // 8, len(b) // 8, 3)
            if most and abs(len(a) - len(b)) <= most and _distance(a, b) <= most:
                links += 1
                a_, b_ = root(a), root(b)
                parent[max(a_, b_)] = min(a_, b_)
    groups = defaultdict(list)
    for i, n in enumerate(names):
        groups[root(_key(n)) if _key(n) else i].append(i)
    rows = spark.createDataFrame([(i, n, "abc"[i % 3]) for i, n in enumerate(names)], "id long, commercial_name string, source string")
    got = {r["id"]: (r["group_id"], r["n_sources"]) for r in products.product_groups(rows).collect()}
    assert got == {i: (min(g), len({j % 3 for j in g})) for g in groups.values() for i in g}
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    # Most names begin with one brand, yet few pairs meet.
    met = products.candidates(frame).distinct().count()
    assert links <= met < len(keys) ** 2 // 2 * 0.08
    assert products.product_groups(rows.limit(0)).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_candidates_meet_by_equal_keys(spark):
    frame = spark.createDataFrame([(_key(n),) for n in _names() if n], "key string").distinct()
    plan = _plan(products.candidates(frame))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_chains_of_links_are_one_group(spark):
    rng = random.Random(1)
    pairs = [(f"n{i:04}", f"n{i + 1:04}") for i in range(300) if i % 50 != 49]
    rng.shuffle(pairs)
    got = {r["node"]: r["root"] for r in products.connected(spark.createDataFrame(pairs, "a string, b string"), "a", "b").collect()}
    assert got == {f"n{i:04}": f"n{i // 50 * 50:04}" for i in range(300)}


def test_rule_table_equals_the_chain(spark):
    rng = random.Random(3)
    raw = [" ".join(rng.choice(WORDS) for _ in range(4)) for _ in range(150)]
    raw += [f"Labor {n} GmbH" for _, needles in vocab.MANUFACTURER_PATTERNS for n in needles] + ["", None, "é", "x" * 50_000]
    frame = spark.createDataFrame([(v,) for v in raw], "raw string")
    key = text.fold_key(F.col("raw"))
    got = rule_table.apply_rules(frame, "raw", rule_table.chain_as_table(spark, vocab.MANUFACTURER_PATTERNS), key=key)
    want = frame.select("raw", rules.first_containing(key, vocab.MANUFACTURER_PATTERNS).alias("label"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.filter("label IS NOT NULL").count() > 30


def test_ten_thousand_rules_meet_by_grams(spark):
    rng = random.Random(9)
    letters = "abcdefgh"
    table = [(rng.randint(0, 500), "".join(rng.choice(letters) for _ in range(rng.randint(1, 9))), f"l{i}") for i in range(10_000)]
    table += [(0, None, "never"), (0, "", "never")]
    values = ["".join(rng.choice(letters + " ") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    rules_df = spark.createDataFrame(table, "priority int, needle string, label string")
    frame = spark.createDataFrame([(v,) for v in values * 2], "value string")
    usable = sorted((p, n, label) for p, n, label in table if n)
    best = {}
    for v in values:
        hit = next(((p, n) for p, n, _ in usable if n in v), None)
        if hit:
            best[v] = {label for p, n, label in usable if (p, n) == hit}
    found = rule_table.first_rule(frame, rules_df)
    got = {r["value"]: r["label"] for r in found.collect()}
    assert got.keys() == best.keys() and all(got[v] in best[v] for v in got)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = _plan(rule_table.first_rule(frame, rules_df))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" in plan


def test_laboratories_over_page_breaks(spark):
    pages = [(1, 0, "cover\nExpert laboratory:"), (1, 1, "Foo Labs\nother"),
             (2, 0, "Study carried out by the"), (2, 1, ""), (2, 2, "  Bar Institute. End"),
             (3, 0, "Expert laboratory: First One"), (3, 1, "Expert laboratory:"), (3, 2, "Second One"),
             (4, 0, "Expert"), (4, 1, "laboratory:"), (4, 2, "Third  House, town"),
             (5, 0, "Expert laboratory:"), (6, 1, "Foo Labs"), (7, 0, None), (7, 1, "Expert laboratory: Late One")]
    got = evidence.find_expert_lab(spark.createDataFrame(pages, "doc_id int, page_no int, text string"), patterns=[("-", ["qqqq"])])
    assert {r["doc_id"]: r["expert_laboratory"] for r in got.collect()} == {
        1: "Foo Labs", 2: "Bar Institute", 3: "First One", 4: "Third House", 5: None, 6: None, 7: "Late One"}


BASE = dt.datetime(2024, 1, 1)


def _events(spark, rows):
    return spark.createDataFrame([(i, u, None if h is None else BASE + dt.timedelta(hours=h)) for i, u, h in rows],
                                 "event_id long, user_id long, ts timestamp")


def test_quota_by_event_time_with_disorder_and_late_events(spark):
    drops = [[(1, 7, 5.0), (2, 7, 3.0), (3, 7, 4.0), (4, 8, 1.0), (5, None, 1.0), (6, 7, None)],
             [(7, 7, 2.0), (8, 7, 2.0), (9, 8, 30.0)],      # earlier than what is held; moves the watermark to hour 24
             [(10, 7, 1.0), (11, 8, 31.0)],                 # day 0 is closed: event 10 is late
             [(12, 9, 90.0)]]
    with arrivals.keyed_state(spark):
        rows, progress = arrivals.run_to_table(lambda s: quota.quota_by_event_time(s, 2, "day", "6 hours"),
                                               [_events(spark, d) for d in drops], "test-quota")
    got = {r["event_id"]: (r["accepted"], r["bucket"].day) for r in rows.collect()}
    assert got == {1: (False, 1), 2: (False, 1), 3: (False, 1), 7: (True, 1), 8: (True, 1), 4: (True, 1), 9: (True, 2), 11: (True, 2)}
    assert arrivals.dropped_late(progress) == 1


def test_records_sent_again_are_landed_once(spark):
    first = [(1, 1, 0.0), (2, 1, 5.0), (3, 1, 9.0)]
    rows, progress = arrivals.run_to_table(
        lambda s: incremental.once_per_record(s, ["event_id", "user_id"], "ts", "24 hours"),
        [_events(spark, d) for d in (first, first + [(4, 1, 60.0)], first[:1] + [(4, 1, 60.0), (1, 2, 70.0)])], "test-once")
    assert sorted((r["event_id"], r["user_id"]) for r in rows.collect()) == [(1, 1), (1, 2), (2, 1), (3, 1), (4, 1)]
    # Behind the watermark of hour 36 the first records' state is gone; their copy is late.
    assert arrivals.dropped_late(progress) == 1
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] < 5


def test_date_filters_are_counted_from_the_cube(spark):
    from regloom.operators import browse, requests
    rng = random.Random(6)
    rows = [(str(i), rng.choice(["A", "B", "C", "D", "", None]), BASE.date() + dt.timedelta(days=rng.randint(0, 900)) if i % 9 else None,
             rng.choice(["active", "expired"]), rng.random() < 0.5) for i in range(600)]
    entries = spark.createDataFrame(rows, "id string, manufacturer_name string, current_expiry date, status string, has_performance_data boolean")
    ranges = [("2024-06-01", ""), ("", "2025-02-17"), ("2025-03-31", "2024-03-05"), ("2024-02-10", "2024-02-10"), ("nonsense", ""),
              ("2026-09-30", "2020-01-01"), ("2024-04-20", "2024-04-03"), ("2024-05-01", "2024-04-01"), ("2024-05-15", "2024-03-20"),
              ("2020-01-01", ""), ("2024-03-01", "2024-05-01")]
    filters = spark.createDataFrame([(str(i), b, a) for i, (b, a) in enumerate(ranges)], "filter_id string, expires_before string, expires_after string")
    got = {r["filter_id"]: r for r in browse.summarize_makers(requests.count_by_dates(filters, entries, "2024-06-15"), ["filter_id"]).collect()}
    for i, (b, a) in enumerate(ranges):
        hit = [r for r in rows if r[2] and b != "nonsense" and (not b or str(r[2]) < b) and (not a or str(r[2]) >= a)]
        makers = sorted({r[1] for r in hit if r[1]})
        if not hit:
            assert str(i) not in got
            continue
        r = got[str(i)]
        assert (r["n_rows"], r["n_makers"], r["expired"], r["with_performance"], r["first_makers"] or "") == (
            len(hit), len(makers), sum(x[3] == "expired" for x in hit), sum(x[4] for x in hit), ", ".join(makers[:3]))
        assert r["expiring_soon"] == sum(0 <= (x[2] - dt.date(2024, 6, 15)).days / 30.44 < 12 for x in hit)
    assert len(got) >= 7
