from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

import fixtures
from orrery.operators.first_rows import ROW_ORDER
from orrery.operators.rejects import reject_counts
from orrery.plans import pipeline
from orrery.plans.pipeline import ChecksFailed, DuplicateKeys, run_agency, run_retail
from orrery.plans.retail_model import build_dim_customers, build_retail_galaxy, tag_retail_raw
from orrery.schemas import RETAIL, RETAIL_RAW
from orrery.sources import samples
from orrery.sources.raw import MALFORMED, read_csv, read_retail_raw, require_inputs, set_apart
from orrery.sources.sinks import (
    FACT_LAYOUTS,
    NullsInRequired,
    RowCountMismatch,
    export_csv,
    open_tables,
    publish,
    required_columns,
    run_named,
    save_as_tables,
    save_attribution_view,
    write_table,
)
from orrery.sources.versions import NoVersion, append_batch, drop_versions, open_batches, open_set, publish_set
from orrery.plans.attribution import attribution


def _csv(df, path):
    export_csv(df, str(path))


def test_missing_inputs_are_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere.csv"):
        require_inputs(spark, [str(tmp_path), str(tmp_path / "nowhere.csv")])
    with pytest.raises(FileNotFoundError, match="customers_raw.csv"):
        read_retail_raw(spark, str(tmp_path))


@pytest.mark.parametrize("split", ["128m", "400"])
def test_csv_row_order_survives_any_split_size(spark, tmp_path, split):
    lines = ["customer_id,full_name,email,country,signup_date"]
    lines += [f'CUST{i % 50:03d},"row {i:04d}, ""x""",,NULL,2024-01-{1 + i % 28:02d}' for i in range(500)]
    path = tmp_path / "customers.csv"
    path.write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        raw = read_csv(spark, str(path), RETAIL_RAW["customers"])
        if split == "400":
            assert raw.rdd.getNumPartitions() > 5
        kept = {r.customer_id: r for r in build_dim_customers(raw).collect()}
        assert {k: r.full_name for k, r in kept.items()} == {f"CUST{i:03d}": f'Row {i:04d}, "X"' for i in range(50)}
        assert {r.country for r in kept.values()} == {"Unknown"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    folder = tmp_path / "items"
    folder.mkdir()
    (folder / "a.csv").write_text(
        "note,unit_price,quantity,product_id,order_id,order_item_id\n"
        "x,9.999,2.0,P1,O1,I1\n"
        "x,0.004,2.5,P1,O1,I2\n"
        "x,NULL,,P1,O1,I3\n"
    )
    rows = read_csv(spark, str(folder), RETAIL_RAW["order_items"]).orderBy("order_item_id").collect()
    found = [(r.order_item_id, r.order_id, r.quantity, None if r.unit_price is None else float(r.unit_price)) for r in rows]
    assert found == [("I1", "O1", 2, 9.999), ("I2", "O1", None, 0.004), ("I3", "O1", None, None)]
    (folder / "b.csv").write_text("note,quantity,unit_price,product_id,order_id,order_item_id\nx,1,2,P1,O1,I4\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(folder), RETAIL_RAW["order_items"]).collect()
    (tmp_path / "short.csv").write_text("order_item_id,order_id\nI1,O1\n")
    with pytest.raises(ValueError, match="product_id, quantity, unit_price"):
        read_csv(spark, str(tmp_path / "short.csv"), RETAIL_RAW["order_items"])


def test_a_refused_load_leaves_the_warehouse_as_it_was(spark, tmp_path):
    raw = fixtures.agency_raw(spark)
    for name, df in raw.items():
        _csv(df, tmp_path / "raw" / f"{name}.csv")
    out = str(tmp_path / "out")
    assert run_agency(spark, str(tmp_path / "raw"), out, processed=True)
    exported = spark.read.option("header", True).csv(f"{out}/processed/dim_date_agency")
    assert exported.count() == spark.read.parquet(f"{out}/warehouse/dim_date_agency").count() > 0
    before = sorted(map(tuple, spark.read.parquet(f"{out}/warehouse/fact_client_billing").collect()))
    bad = raw["client_billing"]
    _csv(bad.unionAll(bad), tmp_path / "raw" / "client_billing.csv")
    with pytest.raises(DuplicateKeys, match="invoice_id"):
        run_agency(spark, str(tmp_path / "raw"), out)
    _csv(bad.withColumn("manager_id", F.lit("M404")), tmp_path / "raw" / "client_billing.csv")
    with pytest.raises(ChecksFailed):
        run_agency(spark, str(tmp_path / "raw"), out, on_fail="raise")
    assert sorted(map(tuple, spark.read.parquet(f"{out}/warehouse/fact_client_billing").collect())) == before
    assert run_agency(spark, str(tmp_path / "raw"), out) is False
    assert spark.read.parquet(f"{out}/warehouse/fact_client_billing").filter("manager_id <> 'M404'").count() == 0
    assert sorted(map(tuple, spark.read.parquet(f"{out}/warehouse_previous/fact_client_billing").collect())) == before


def test_append_to_a_table_that_is_not_there_yet(spark, tmp_path):
    path = str(tmp_path / "t")
    assert [write_table(spark.range(5).toDF("id"), path, mode="append") for _ in range(2)] == [5, 5]
    assert spark.read.parquet(path).count() == 10


def test_a_set_changes_at_once(spark, tmp_path):
    root = str(tmp_path / "set")
    with pytest.raises(NoVersion):
        open_set(spark, root)
    make = lambda n: {"a": spark.range(n).toDF("id"), "b": spark.range(n).selectExpr("cast(id as string) as k")}
    assert {tuple(r) for r in publish_set(make(3), root, {"b": "renamed"}).collect()} == {("a", 3), ("renamed", 3)}
    before = open_set(spark, root)
    publish_set(make(5), root, {"b": "renamed"})
    # What was opened before stays one version; what is opened now is the other.
    assert [before[t].count() for t in ("a", "renamed")] == [3, 3]
    assert [open_set(spark, root)[t].count() for t in ("a", "renamed")] == [5, 5]
    bad = {"a": spark.range(9).toDF("id"), "b": spark.sql("select cast(null as string) as k")}
    with pytest.raises(NullsInRequired, match="1 rows of k"):
        publish_set(bad, root, {"b": "renamed"}, required={"b": ["k"]})
    broken = {"a": spark.range(9).toDF("id"), "b": spark.range(3).select(F.raise_error(F.lit("lost")).alias("k"))}
    with pytest.raises(Exception, match="lost"):
        publish_set(broken, root)
    assert {name: df.count() for name, df in open_set(spark, root).items()} == {"a": 5, "renamed": 5}
    publish_set(make(7), root)
    assert drop_versions(spark, root, keep=1) == 2 and drop_versions(spark, root, keep=1) == 0
    assert {name: df.count() for name, df in open_set(spark, root).items()} == {"a": 7, "b": 7}


def test_two_writers_get_two_versions(spark, tmp_path):
    root = str(tmp_path / "set")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: publish_set({"t": spark.range(n).toDF("id")}, root), (1, 2, 3, 4)))
    assert len([p for p in (tmp_path / "set" / "_manifests").iterdir() if p.name.isdigit()]) == 4
    assert open_set(spark, root)["t"].count() in (1, 2, 3, 4)


def test_a_repeated_batch_is_there_once(spark, sample_dir, tmp_path):
    path = str(tmp_path / "billing")
    billing, layout = samples.fact_client_billing(spark, sample_dir), FACT_LAYOUTS["fact_client_billing"]
    n = billing.count()
    assert append_batch(billing, path, "2024-01", layout) == n
    assert append_batch(billing.limit(10), path, "2024-02", layout) == 10
    append_batch(billing.limit(10), path, "2024-02", layout)
    stored = open_batches(spark, path)
    assert stored.count() == n + 10 and stored.columns == billing.columns
    assert sorted(map(tuple, open_batches(spark, path, ["2024-01"]).collect())) == sorted(map(tuple, billing.collect()))
    # A later batch with fewer months leaves none of its earlier rows behind.
    append_batch(billing.limit(0), path, "2024-02", layout)
    assert open_batches(spark, path).count() == n
    # A batch that fails changes nothing, neither the table nor the rows of that batch.
    holes = billing.withColumn("client_id", F.when(F.col("client_id") % 2 == 0, F.col("client_id")))
    with pytest.raises(NullsInRequired):
        append_batch(holes, path, "2024-01", layout, ["client_id"])
    with pytest.raises(Exception, match="lost"):
        append_batch(billing.withColumn("client_id", F.raise_error(F.lit("lost")).cast("long")), path, "2024-01", layout)
    assert open_batches(spark, path).count() == n and not [p for p in (tmp_path / "billing").iterdir() if "draft" in p.name]
    with pytest.raises(ValueError):
        append_batch(billing, path, "a/b", layout)
    plan = spark.read.parquet(path).where("load_batch = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_batch" in plan


def test_required_columns_are_checked_by_the_write(spark, tmp_path):
    rows = spark.range(6).selectExpr("id", "if(id = 4, null, id) as k")
    with pytest.raises(NullsInRequired, match="1 rows of k"):
        write_table(rows, str(tmp_path / "t"), required=["id", "k"])
    assert write_table(rows, str(tmp_path / "t"), required=["id"]) == 6
    assert "customer_id" in required_columns(RETAIL["fact_sales"]) and "status" not in required_columns(RETAIL["fact_sales"])


def test_retail_run(spark, sample_dir, tmp_path):
    for name, df in samples.retail_raw_text(spark, sample_dir).items():
        df = df.orderBy(ROW_ORDER).drop(ROW_ORDER) if ROW_ORDER in df.columns else df
        df = df.dropDuplicates(["order_item_id"]) if name == "order_items" else df
        _csv(df, tmp_path / "raw" / f"{name}_raw.csv")
    out = tmp_path / "out"
    assert run_retail(spark, str(tmp_path / "raw"), str(out), on_fail="raise", quarantine=True)
    counts = spark.read.option("header", True).csv(str(out / "reject_counts")).filter("table_name = 'orders'")
    lost = {r.reject_reason: int(r.row_count) for r in counts.collect()}
    assert lost.pop("clean") > 0
    assert spark.read.parquet(str(out / "quarantine" / "orders")).count() == sum(lost.values()) > 0
    report = spark.read.option("header", True).csv(str(out / "validation_report"))
    assert report.count() == 23 and report.filter("status <> 'PASSED'").count() == 0
    for name in ("cohort_retention", "rfm_segmentation", "attribution_analysis"):
        assert spark.read.option("header", True).csv(str(out / "results" / f"{name}_results")).count() > 0
    stored = spark.read.parquet(str(out / "warehouse" / "fact_sales"))
    assert stored.filter("order_month <> trunc(order_date, 'MM')").count() == 0


def test_malformed_lines_are_rejected_with_their_text(spark, tmp_path):
    files = {
        "customers": ["customer_id,full_name,email,country,signup_date", "C1,only a name", 'C1,"A, B",a@b.c,US,2024-01-01', "C1,A,a@b.c,US,2024-01-02"],
        "products": ["product_id,product_name,category,base_price", "P1,Pen,Office,2.00", "P2,Cup,Home,3.00,extra,more"],
        "orders": ["order_id,customer_id,order_date,status,shipping_fee", "O1,C1,2024-02-01,completed,1.00"],
        "order_items": ["order_item_id,order_id,product_id,quantity,unit_price", "I1,O1,P1,1,2.00", "I2,O1,P2,1,3.00", "I3,O1"],
        "sessions": ["session_id,customer_id,session_date,traffic_source,device_type,pages_viewed,duration_seconds,bounced,converted"],
    }
    for name, lines in files.items():
        (tmp_path / "raw").mkdir(exist_ok=True)
        (tmp_path / "raw" / f"{name}_raw.csv").write_text("\n".join(lines) + "\n")
    raw = read_retail_raw(spark, str(tmp_path / "raw"), keep_malformed=True)
    tagged = tag_retail_raw(raw)
    counts = {(r.table_name, r.reject_reason): r.row_count for r in reject_counts(**tagged).collect()}
    assert counts == {
        ("customers", "malformed_line"): 1, ("customers", "clean"): 1, ("customers", "duplicate_customer"): 1,
        ("products", "clean"): 1, ("products", "malformed_line"): 1, ("orders", "clean"): 1,
        ("order_items", "clean"): 1, ("order_items", "unknown_product"): 1, ("order_items", "malformed_line"): 1,
    }
    for name, lines in files.items():
        assert sum(n for (table, _), n in counts.items() if table == name) == len(lines) - 1
    assert [r[MALFORMED] for r in tagged["products"].where("reject_reason = 'malformed_line'").collect()] == ["P2,Cup,Home,3.00,extra,more"]
    # The broken line of C1 is nobody's first row.
    good = {name: set_apart(df)[0] for name, df in raw.items()}
    assert [r.full_name for r in build_retail_galaxy(good)["dim_customers"].collect()] == ["A, B"]
    # Without the switch the lines are read as far as they go.
    assert read_retail_raw(spark, str(tmp_path / "raw"))["order_items"].count() == 3
    out = tmp_path / "out"
    run_retail(spark, str(tmp_path / "raw"), str(out), quarantine=True, reject_malformed=True)
    stored = spark.read.parquet(str(out / "quarantine" / "order_items")).where("reject_reason = 'malformed_line'").collect()
    assert [r[MALFORMED] for r in stored] == ["I3,O1"]
    assert spark.read.parquet(str(out / "warehouse" / "fact_sales")).count() == 1


def test_repeated_keys_stop_the_run(spark, sample_dir, tmp_path):
    for name, df in samples.retail_raw_text(spark, sample_dir).items():
        _csv(df.drop(ROW_ORDER), tmp_path / "raw" / f"{name}_raw.csv")
    # The sample's line ids repeat.
    with pytest.raises(DuplicateKeys, match="fact_sales.order_item_id"):
        run_retail(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert not (tmp_path / "out" / "results").exists()


def test_agency_run(spark, tmp_path):
    for name, df in fixtures.agency_raw(spark).items():
        _csv(df, tmp_path / "raw" / f"{name}.csv")
    assert run_agency(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert (tmp_path / "out" / "warehouse" / "dim_date_agency").exists()
    billing = spark.read.parquet(str(tmp_path / "out" / "warehouse" / "fact_client_billing"))
    assert float(billing.filter("invoice_id = 'INV001'").first().total_billing_amount) == 17000.0
    results = spark.read.option("header", True).csv(str(tmp_path / "out" / "results" / "campaign_channel_results"))
    assert results.filter("marketing_channel = 'Google Ads'").first().channel_roas == "8.0"


def test_failed_checks_warn_or_raise(spark, tmp_path):
    raw = fixtures.agency_raw(spark)
    raw["client_billing"] = raw["client_billing"].withColumn("manager_id", F.lit("M404"))
    for name, df in raw.items():
        _csv(df, tmp_path / "raw" / f"{name}.csv")
    assert run_agency(spark, str(tmp_path / "raw"), str(tmp_path / "warned")) is False
    with pytest.raises(ChecksFailed):
        run_agency(spark, str(tmp_path / "raw"), str(tmp_path / "raised"), on_fail="raise")


def test_publish_append_and_rename(spark, sample_dir, tmp_path):
    billing = {"fact_client_billing": samples.fact_client_billing(spark, sample_dir)}
    n = billing["fact_client_billing"].count()
    first = publish(billing, str(tmp_path)).collect()
    assert [tuple(r) for r in first] == [("fact_client_billing", n)]
    publish(billing, str(tmp_path), mode="append")
    assert open_tables(spark, str(tmp_path), list(billing))["fact_client_billing"].count() == 2 * n
    publish(billing, str(tmp_path))
    assert open_tables(spark, str(tmp_path), list(billing))["fact_client_billing"].count() == n
    plan = spark.read.parquet(f"{tmp_path}/fact_client_billing").filter("invoice_month = date'1996-05-01'")
    assert "PartitionFilters: [isnotnull(invoice_month" in plan._jdf.queryExecution().executedPlan().toString()


def test_a_short_write_is_noticed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("orrery.sources.sinks._stored_rows", lambda *_: 1)
    with pytest.raises(RowCountMismatch):
        write_table(spark.range(5).toDF("id"), str(tmp_path / "t"))


def test_named_queries_stop_at_the_first_error(spark, tmp_path):
    def broken():
        raise ValueError("no such report")

    with pytest.raises(ValueError):
        run_named({"a": lambda: spark.range(1).toDF("x"), "b": broken, "c": broken}, str(tmp_path))
    assert (tmp_path / "a_results").exists() and not (tmp_path / "c_results").exists()


def test_saved_view_equals_the_report(spark, sample_dir):
    sales, traffic = samples.event_sales(spark, sample_dir), samples.fact_web_traffic(spark, sample_dir)
    save_as_tables({"t_sales": sales, "t_traffic": traffic})
    view = save_attribution_view(spark, "t_sales", "t_traffic", "v_attribution")
    report = attribution(sales, traffic)
    assert sorted(map(tuple, view.select(report.columns).collect())) == sorted(map(tuple, report.collect()))


def test_export_does_not_build_the_tables_again_for_the_calendar(spark, tmp_path, sample_dir, monkeypatch):
    galaxy, read, write = samples.retail(spark, sample_dir), {}, pipeline.export_csv

    def export(df, path):
        read[path.rsplit("/", 1)[1]] = df.inputFiles()
        write(df, path)

    monkeypatch.setattr(pipeline, "export_csv", export)
    pipeline.export_retail(galaxy, str(tmp_path))
    assert set(read) == set(galaxy) and read["dim_date"] == [] and read["fact_sales"]
    for name, df in galaxy.items():
        stored = spark.read.schema(df.schema).option("header", True).csv(f"{tmp_path}/{name}")
        assert stored.count() == df.count()
    days = spark.read.schema(galaxy["dim_date"].schema).option("header", True).csv(f"{tmp_path}/dim_date")
    assert sorted(map(tuple, days.collect())) == sorted(map(tuple, galaxy["dim_date"].collect()))


def test_quarantine_counts_come_from_the_stored_rows(spark, tmp_path, sample_dir):
    raw = samples.retail_raw(spark, sample_dir)
    counts = pipeline.quarantine_retail(raw, str(tmp_path / "quarantine"))
    assert {tuple(r) for r in counts.collect()} == {tuple(r) for r in reject_counts(**pipeline.tag_retail_raw(raw)).collect()}
    assert counts.inputFiles() and all("/quarantine/" in f for f in counts.inputFiles())
    none = {name: df.where("false") for name, df in raw.items()}
    assert pipeline.quarantine_retail(none, str(tmp_path / "none")).collect() == []


def test_results_of_a_set_are_computed_from_its_stored_tables(spark, tmp_path, sample_dir):
    tables, root = samples.retail(spark, sample_dir), str(tmp_path / "set")
    calendar = tables.pop("dim_date")

    def results(stored):
        assert all(f"{root}/v-" in f for df in stored.values() for f in df.inputFiles())
        return pipeline.retail_results(stored)

    report = {r.table_name: r.rows_loaded for r in publish_set(tables, root, derive=results).collect()}
    opened = open_set(spark, root)
    assert report == {name: df.count() for name, df in opened.items()} and len(report) == 7
    assert sorted(map(tuple, opened["dim_date"].collect())) == sorted(map(tuple, calendar.collect()))

    def broken(stored):
        raise RuntimeError("no results")

    with pytest.raises(RuntimeError):
        publish_set({"t": spark.range(1).toDF("id")}, root, derive=broken)
    with pytest.raises(ValueError):
        publish_set({"t": spark.range(1).toDF("id")}, root, derive=dict)
    assert set(open_set(spark, root)) == set(opened)
