"""Plan shape, streaming equality, files, and queries against DuckDB."""
import json
import os
import uuid

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from regloom.operators import browse, quota, web
from regloom.plans import inputs
from regloom.session import checkpoint_dir, drop_intermediates, materialize
from regloom.sources import registry as raw
from regloom.streaming import incremental
from regloom.streaming.quota import QuotaProcessor, quota_stream, quota_windows

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
CHECKED = ["facet_counts", "tested_category_heatmap", "result_summary", "latest_copy", "resolved_keys",
           "reconciled_records", "organism_labels", "selected_pages", "page_ranges", "certificate_records",
           "relative_trueness", "organism_page_records", "sanitized_requests", "answered_requests", "daily_quota",
           "product_groups", "rule_table_labels", "laboratories_across_pages", "run_log", "upserted_snapshot", "collected_once"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["facet_counts", "tested_categories", "matched_sources", "resolved_keys",
                                  "report_technology", "page_blocks", "organism_labels", "daily_quota"])
def test_plans_stay_on_the_jvm_without_products(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
                "Exchange SinglePartition"):
        assert bad not in text, bad


def test_costly_plans_have_few_exchanges(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, most in {"strain_rows": 3, "calibration_agreement": 7, "breakdown_flags": 3, "tested_categories": 8}.items():
            assert plan(entry.queries()[name](spark, sf)).count("Exchange ") <= most, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(browse.filter_entries(
        spark.read.parquet(f"{sf}/orders.parquet"), {"statuses": ["F"]}, search="",
        columns={"statuses": "o_orderstatus"}).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_rankings_are_cut_before_the_shuffle(spark, sf):
    assert "WindowGroupLimit" in plan(quota.quota_decisions(inputs.table(spark, sf, "events"), 2, unit="day"))


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = entry.queries()[name](spark, sf)
    cols = sorted(got.columns)
    want = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    expected = sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=key)
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=key) == expected


def _event_stream(spark, sf, base):
    path = f"{base}/events-{uuid.uuid4().hex}"
    events = inputs.table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    events.orderBy("ts").coalesce(1).write.parquet(path)
    return events, spark.readStream.schema(events.schema).parquet(path)


def test_quota_stream_equals_batch(spark, sf):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    base = checkpoint_dir(spark)
    events, stream = _event_stream(spark, sf, base)
    q = (quota_stream(stream, cap=2, unit="day", ttl_ms=None).writeStream.format("memory")
         .queryName("decisions").outputMode("append").option("checkpointLocation", f"{base}/q-{uuid.uuid4().hex}")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {(r.event_id, r.accepted) for r in spark.table("decisions").collect()}
    batch = quota.quota_decisions(events, 2, unit="day").collect()
    assert got == {(r.event_id, r.accepted) for r in batch} and any(not r.accepted for r in batch)


def test_quota_windows_close_behind_the_watermark(spark, sf):
    base = checkpoint_dir(spark)
    events, stream = _event_stream(spark, sf, base)
    q = (quota_windows(stream, cap=1, length="1 day").writeStream.format("memory").queryName("windows")
         .outputMode("append").option("checkpointLocation", f"{base}/w-{uuid.uuid4().hex}")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    rows = spark.table("windows").collect()
    assert rows and all(r.accepted == 1 for r in rows)
    assert sum(r.accepted + r.refused for r in rows) <= events.count()


def test_quota_state_is_bounded_by_the_cap():
    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    work = QuotaProcessor(3)
    work.used = State()
    frames = [pd.DataFrame({"event_id": ids, "user_id": 1, "ts": pd.to_datetime(ids, unit="s"), "bucket": pd.Timestamp(0)})
              for ids in ([5, 9], [1, 7], [3, 2])]
    out = pd.concat(work.handleInputRows(None, iter(frames), None))
    assert set(out[out.accepted].event_id) == {1, 2, 3} and len(out) == 6
    out = pd.concat(work.handleInputRows(None, iter(frames[:1]), None))
    assert not out.accepted.any() and len(out) == 2


def test_shared_folder_is_asked_for_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())
    kept = materialize(spark.range(3), "test")
    assert kept.count() == 3 and drop_intermediates(spark) > 0 and not os.path.exists(kept.inputFiles()[0].removeprefix("file://"))


def test_files_to_snapshots(spark, tmp_path):
    landing, base = str(tmp_path / "in"), str(tmp_path / "snap")
    os.makedirs(landing)

    def drop(file, **record):
        with open(f"{landing}/{file}.json", "w") as f:
            json.dump(record, f)

    schema = raw.T.StructType([raw.T.StructField(c, raw.T.StringType()) for c in ("id", "name", "perf")])
    run = f"run-{uuid.uuid4().hex}"
    drop("a", id="1", name="one", perf="mined")
    drop("_index", id="index")
    for step in range(2):
        rows = incremental.read_new_files(spark, landing, schema).filter(~F.col("file").rlike("_index"))
        incremental.upsert_snapshots(rows, base, "id", ["file"], ["perf"], run).awaitTermination(120)
        drop("b", id="1", name="renamed")
        drop("c", id="2", name="two")
    latest = spark.read.parquet(f"{base}/batch=00000001")
    want = {("1", "renamed", "mined"), ("2", "two", None)}
    assert {(r.id, r.name, r.perf) for r in latest.collect()} == want
    # A lost checkpoint: the stream goes on behind the last snapshot and keeps what was mined.
    rows = incremental.read_new_files(spark, landing, schema).filter(~F.col("file").rlike("_index"))
    incremental.upsert_snapshots(rows, base, "id", ["file"], ["perf"], f"run-{uuid.uuid4().hex}").awaitTermination(120)
    assert {(r.id, r.name, r.perf) for r in spark.read.parquet(f"{base}/batch=00000002").collect()} == want
    assert {(r.id, r.name, r.perf) for r in spark.read.parquet(f"{base}/batch=00000000").collect()} == {("1", "one", "mined")}
    read = raw.read_json_objects(spark, landing, schema)
    good, bad = raw.guard(read, ["id", "name"])
    assert good.count() == 3 and bad.count() == 0


def test_web_kinds_and_fallbacks(spark):
    rows = [(1, "<body><div id='root'></div></body>"), (2, '<body><input type="password"></body>'),
            (3, "<body>" + "word " * 20 + "</body>"), (4, "no body"), (5, "<body><a href='x'>n</a></body>")]
    df = spark.createDataFrame(rows, "page_id int, html string")
    got = {r.page_id: (r.login_wall, r.script_shell) for r in web.page_kinds(df).collect()}
    assert got == {1: (False, True), 2: (True, True), 3: (False, False), 4: (False, True), 5: (False, False)}
    urls = spark.createDataFrame([("https://a.org/x/y?q=1", h) for h in (
        "/z", "z", "?p=2", "//b.org/z", "http://c.org", "#t")], "base string, href string")
    assert [r[0] for r in urls.select(web.resolve_url(F.col("base"), F.col("href"))).collect()] == [
        "https://a.org/z", "https://a.org/x/z", "https://a.org/x/y?p=2", "https://b.org/z", "http://c.org",
        "https://a.org/x/y?q=1#t"]
    html = '<a href="/p2" rel="next">more</a><a href="/p3">Next</a>'
    pages = spark.createDataFrame([(1, "https://a.org/", html), (2, "https://a.org/p2", html)],
                                  "page_id int, url string, html string")
    assert [r[0] for r in pages.select(web.next_page(F.col("html"), F.col("url"))).collect()] == [
        "https://a.org/p2", None]
    loose = "<a class=x href=/a.pdf>one<a HREF='/b.pdf'>two</a><a href=\"/c.pdf\" data-href='no'>three <b>x"
    links = spark.createDataFrame([(1, "https://a.org/", loose)], "page_id int, url string, html string")
    assert [r.link for r in web.pdf_links(links).collect()] == [f"https://a.org/{x}.pdf" for x in "abc"]
