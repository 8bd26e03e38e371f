from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from strata.functions.skew import hot_keys, salted_join
from strata.operators import lab, layout
from strata.plans.staging import Staging
from strata.sources import generate
from tests.conftest import plan_text, sets


@pytest.fixture(scope="module")
def sales(spark):
    return generate.sales_of_size(spark, 5000)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_layouts_hold_the_same_rows(spark, sales, folder):
    keys = ["customer_id", "sale_date"]
    layout.write_small_files(sales, f"{folder}/small", 8)
    assert layout.compact(spark, f"{folder}/small", f"{folder}/compact") == 1
    layout.write_zorder(sales, f"{folder}/z", keys)
    layout.write_clustered(sales.where("sale_id < 4000"), f"{folder}/c", keys)
    layout.append_clustered(spark, sales.where("sale_id >= 4000"), f"{folder}/c")
    month = sales.withColumn("sale_date", F.trunc("sale_date", "year"))
    layout.write_partitioned(month, f"{folder}/p", "sale_date")
    tables = {n: spark.read.parquet(f"{folder}/{n}") for n in ("small", "compact", "z", "c", "p")}
    for name in ("small", "compact", "z", "c"):
        assert same(tables[name].select(sales.columns), sales), name
    assert same(tables["p"].select(sales.columns), month)
    stats = {n: layout.table_stats(t, ["sale_date"] if n == "p" else []).first() for n, t in tables.items()}
    assert stats["small"]["num_files"] == 8 > stats["compact"]["num_files"] == 1
    assert stats["p"]["num_files"] == 3 and stats["p"]["partition_columns"] == "sale_date"
    assert stats["c"]["clustering_columns"] == "customer_id,sale_date"
    assert {s["row_count"] for s in stats.values()} == {5000}


def test_variants_work_their_rows_out_once(spark, sales, folder):
    """Rows that come out otherwise each time: all layouts hold those of the small files."""
    drawn = sales.withColumn("draw", F.expr("uuid()"))
    paths = layout.write_variants(drawn, folder, ["customer_id", "sale_date"], "sale_date", 4, 64 * 1024)
    tables = {n: spark.read.parquet(p) for n, p in paths.items()}
    assert tables["smallfiles"].count() == 5000
    for name, table in tables.items():
        assert same(table.select(drawn.columns), tables["smallfiles"]), name
        assert layout.clustering_keys(table) == (["customer_id", "sale_date"] if name == "clustered" else []), name


def test_dealt_rows_are_put_together_without_a_shuffle(spark, sales, folder):
    parts = layout.parts_for(spark, 3)
    assert parts == 6  # 4 shuffle partitions
    layout.write_small_files(sales.repartition(parts, "sale_id"), f"{folder}/small", 3, dealt=True)
    back = spark.read.parquet(f"{folder}/small")
    assert same(back, sales)
    sizes = [r["row_count"] for r in layout.file_sizes(back).collect()]
    assert len(sizes) == 3 and min(sizes) > 1400


def test_dealt_lines_are_the_lines(spark):
    s = Staging(spark, "/root/testdata/sf0.001")
    dealt = s.lines_dealt(6)
    assert dealt.columns == s.lines.columns and same(dealt, s.lines)
    assert plan_text(dealt).count("Exchange hashpartitioning") == 1


def test_clustering_lets_files_be_skipped(spark, folder):
    sales = generate.sales_of_size(spark, 20_000)
    wanted = {"customer_id": (4000, 4800), "sale_date": (date(2024, 3, 1), date(2024, 3, 30))}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        layout.write_small_files(sales, f"{folder}/small", 32)
        layout.write_zorder(sales, f"{folder}/z", list(wanted))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    plain = layout.skippable_files(spark.read.parquet(f"{folder}/small"), wanted).first()
    curve = layout.skippable_files(spark.read.parquet(f"{folder}/z"), wanted).first()
    assert plain["skippable"] == 0
    assert curve["skippable"] / curve["files"] > 0.7


def test_kd_boxes_skip_what_the_curve_skips(spark, folder):
    """Two predicates, equal numbers of files; keys that occur together, a hot value, nulls."""
    made = generate.sales_of_size(spark, 20_000)
    day = F.when(F.col("sale_id") % 50 == 3, F.lit(None)).otherwise(F.date_add(F.lit(date(2024, 1, 1)), (F.col("customer_id") / 50).cast("int")))
    sales = made.withColumn("sale_date", day)
    keys = ["customer_id", "sale_date"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        layout.write_zorder(sales, f"{folder}/z", keys)
        layout.write_kd(sales, f"{folder}/kd", keys, 32)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    tables = {n: spark.read.parquet(f"{folder}/{n}") for n in ("z", "kd")}
    assert same(tables["kd"], sales)
    sizes = [r["row_count"] for r in layout.file_sizes(tables["kd"]).collect()]
    assert len(sizes) == 32 and max(sizes) < 3 * 20_000 / 32, "the customer with a third of all rows is divided"
    box = {"customer_id": (4000, 4800), "sale_date": (date(2024, 1, 1), date(2025, 1, 1))}
    wanted = sales.where("customer_id between 4000 and 4800 and sale_date between date'2024-01-01' and date'2025-01-01'")
    assert same(layout.pruned(tables["kd"], box), wanted)
    # Many boxes of two kinds, as a single one may lie over a cut: one key, both keys.
    days = [(date(2024, 1, 1) + timedelta(k), date(2024, 1, 1) + timedelta(k + 30)) for k in range(0, 960, 24)]
    ids = [(k, k + 800) for k in range(100, 49_000, 1225)]
    skipped = {}
    for name, table in tables.items():
        edges = [F.min("customer_id"), F.max("customer_id"), F.min("sale_date"), F.max("sale_date")]
        files = table.groupBy("_metadata.file_path").agg(*edges).collect()
        met = lambda f, low, high, at: f[at] is not None and f[at] <= high and f[at + 1] >= low
        skipped[name] = (
            sum(not met(f, *d, 3) for f in files for d in days) / len(files),
            sum(not (met(f, *i, 1) and met(f, *d, 3)) for f in files for i in ids for d in days[::5]) / len(files),
        )
    (z_one, z_both), (kd_one, kd_both) = skipped["z"], skipped["kd"]
    assert kd_both > 0.99 * z_both and kd_one > 0.99 * z_one and kd_one > 0.9 * len(days), skipped


def test_kd_cuts_are_even_and_take_any_points():
    points = [(float(i % 16), float(i // 16)) for i in range(256)]
    by, at = layout._kd_cuts(points, 2)
    assert (by[1:], at[1:]) == ([0, 1, 1], [8.0, 8.0, 8.0])
    assert layout._kd_cuts([], 1)[1] == [float("-inf")] * 2
    assert layout._kd_cuts([(1.0, float(i)) for i in range(4)], 1) == ([0, 1], [float("-inf"), 2.0])


def test_text_is_ranked_in_its_order(spark):
    words = spark.range(400).select(F.format_string("SKU-%04d", F.col("id") * 7).alias("sku"))
    ranked = words.select("sku", layout.quantile_rank(words, "sku", 3).alias("rank")).orderBy("sku").collect()
    ranks = [r["rank"] for r in ranked]
    assert ranks == sorted(ranks) and set(ranks) == set(range(8))


def test_hot_partition_value_is_spread_and_whole(spark, sales, folder, monkeypatch):
    one_day = sales.withColumn("sale_date", F.lit(date(2024, 1, 1)))
    monkeypatch.setattr(layout, "hot_keys", lambda rows, keys: hot_keys(rows, keys, 0.1, 10))
    layout.write_partitioned(one_day, f"{folder}/p", "sale_date", writers=4)
    back = spark.read.parquet(f"{folder}/p")
    assert back.count() == 5000 and layout.file_sizes(back).count() == 4


def test_salted_join_equals_the_plain_join(spark, sales):
    customers = generate.all_customers(spark).drop("region")
    for how in ("inner", "left"):
        hot = hot_keys(sales, ["customer_id"], 0.1, 10)
        assert sets(hot, "customer_id") == {(42,)}
        salted = salted_join(sales, customers.where("customer_id % 7 <> 0"), "customer_id", ["sale_id"], hot, how, 8)
        plain = sales.join(customers.where("customer_id % 7 <> 0"), "customer_id", how)
        assert same(salted.select(plain.columns), plain)


def test_rewrites_return_the_same_rows(spark, sales):
    promos = generate.all_promotions(spark)
    span = date(2024, 3, 1), date(2024, 3, 31)
    assert same(lab.promoted(sales, promos, *span), lab.promoted_distinct(sales, promos, *span))
    twice = generate.all_customers(spark).drop("region")
    twice = twice.unionByName(twice.where("customer_id = 42"))
    args = (twice, "customer_id", ["segment"])
    assert same(lab.segment_join(sales, *args), lab.segment_join_shuffled(sales, *args))
    assert same(lab.month_by_range(sales, 2024, 2), lab.month_by_functions(sales, 2024, 2))


def test_only_small_dimensions_are_broadcast(spark, sales):
    products = generate.all_products(spark)
    broadcast = plan_text(lab.brand_by_broadcast(sales, products, "product_id"))
    assert "BroadcastHashJoin" in broadcast
    assert "SortMergeJoin" in plan_text(lab.brand_by_shuffle(sales, products, "product_id"))
