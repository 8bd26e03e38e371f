from datetime import date, datetime
from pathlib import Path
from urllib.parse import unquote, urlparse

from pyspark.sql import functions as F

from strata.operators import conform
from strata.session import extracted
from strata.sources import generate
from strata.sources.increments import JdbcSource, even_edges, since, stamp_load
from tests.conftest import at, sets


def test_increment_statement_runs_at_the_source():
    source = JdbcSource("jdbc:any://host", "u", "secret", "a.Driver", schema="dbo")
    assert source.increment_sql("orders", datetime(2026, 6, 1, 2, 3, 4, 5)) == (
        "SELECT * FROM dbo.orders WHERE modified_at >= '2026-06-01 02:03:04.000005'"
    )
    assert "secret" not in repr(source)
    assert source.options()["fetchsize"] == "10000"


def test_slices_cover_the_increment_once():
    slices = JdbcSource("jdbc:x").slices(datetime(2026, 1, 1), [datetime(2026, 3, 1), datetime(2025, 1, 1), datetime(2026, 2, 1)])
    assert slices == [
        "modified_at >= '2026-01-01 00:00:00.000000' AND modified_at < '2026-02-01 00:00:00.000000'",
        "modified_at >= '2026-02-01 00:00:00.000000' AND modified_at < '2026-03-01 00:00:00.000000'",
        "modified_at >= '2026-03-01 00:00:00.000000'",
    ]


def test_equal_slices_by_time_and_key(spark):
    """The statements run on a view: every row is in one slice, all slices are alike, whatever the times are."""
    mark, source = datetime(2026, 1, 1), JdbcSource("jdbc:x", tasks=5)
    for name, moment in {"one": "0", "few": "id % 3", "skewed": "if(id < 90, 7, id)", "old": "-id - 1"}.items():
        spark.range(100).selectExpr("id", "concat(id % 10, chr(39), id) AS code", f"timestamp'2026-01-01' + make_interval(0, 0, 0, 0, 0, 0, {moment}) AS modified_at").createOrReplaceTempView("loads")
        for key in ("id", "code"):
            bounds = [tuple(r) for r in spark.sql(source.bounds_sql("loads", mark, key)).collect()]
            parts = [{r["id"] for r in spark.sql(f"SELECT id FROM loads WHERE {c}").collect()} for c in source.key_slices(mark, bounds, key)]
            if name == "old":
                assert bounds == [] and len(parts) == 1 and not parts[0]
            else:
                assert [len(p) for p in parts] == [20] * 5 and len(set().union(*parts)) == 100


def test_span_of_an_increment_is_cut_evenly():
    assert JdbcSource("jdbc:x").span_sql("t", datetime(2026, 1, 1)) == (
        "SELECT MIN(modified_at) AS oldest, MAX(modified_at) AS newest FROM t WHERE modified_at >= '2026-01-01 00:00:00.000000'"
    )
    assert even_edges(datetime(2026, 1, 1), datetime(2026, 1, 4), 3) == [datetime(2026, 1, 2), datetime(2026, 1, 3)]
    assert even_edges(None, None, 3) == even_edges(datetime(2026, 1, 1), datetime(2026, 1, 1), 3) == []


def test_drops_of_a_day_share_no_id(spark):
    day = date(2026, 6, 1)
    one, two = (generate.drop_returns(generate.drop_keys(spark, day, b, 300), b).select("return_id") for b in (1, 2))
    assert one.union(two).distinct().count() == 600


def test_since_keeps_rows_on_the_mark(spark):
    rows = spark.createDataFrame([(1, at(1)), (2, at(2)), (3, at(3))], "id int, modified_at timestamp")
    assert sets(since(rows, "modified_at", at(2)), "id") == {(2,), (3,)}
    assert stamp_load(rows, "t").columns[2:] == ["_ingest_ts", "_source_system", "_source_table"]


def test_generated_sales_shape(spark):
    made = generate.sales_of_size(spark, 20_000)
    again = generate.sales_of_size(spark, 20_000)
    assert made.exceptAll(again).count() == 0
    row = made.agg(
        F.avg((F.col("customer_id") == 42).cast("int")).alias("hot"),
        F.min("sale_date").alias("first"),
        F.max("sale_date").alias("last"),
        F.countDistinct("order_ref").alias("refs"),
        F.count_if(F.col("revenue") != F.col("quantity") * F.col("unit_price")).alias("wrong"),
        F.min("quantity").alias("q1"), F.max("quantity").alias("q2"),
        F.min("unit_price").alias("p1"), F.max("unit_price").alias("p2"),
    ).first()
    assert 0.25 < row["hot"] < 0.35 and row["refs"] == 20_000 and row["wrong"] == 0
    assert date(2023, 1, 1) <= row["first"] and row["last"] <= date(2025, 12, 31)
    assert (row["q1"], row["q2"], float(row["p1"]), float(row["p2"])) == (1, 24, 2.0, 10.99)


def test_dimensions_cover_the_fact(spark):
    facts = generate.sales_of_size(spark, 20_000)
    customers, products = generate.all_customers(spark), generate.all_products(spark)
    assert (customers.count(), products.count()) == (50_000, 200)
    assert conform.orphans(facts, customers, "customer_id").count() == 0
    assert conform.orphans(facts, products, "product_id").count() == 0


def test_promotions(spark):
    rows = generate.all_promotions(spark)
    assert rows.count() == 156 * 8 == rows.select("promo_id").distinct().count()
    first = rows.where("promo_id = 9").first()
    assert first["region"] == "malopolskie" and first["promo_start"] == date(2023, 1, 9)
    assert first["promo_end"] == date(2023, 1, 18)


def test_drops_are_deterministic(spark, folder):
    keys = generate.drop_keys(spark, date(2026, 6, 1), 2, 60)
    rows = generate.drop_shipments(keys, 2)
    same = generate.drop_shipments(generate.drop_keys(spark, date(2026, 6, 1), 2, 60), 2)
    assert rows.exceptAll(same).count() == 0
    assert rows.agg(F.min("shipment_id"), F.max("shipment_id")).first() == (2026060102000000000, 2026060102000000059)
    generate.write_drop(rows, "csv", f"{folder}/csv")
    generate.write_drop(generate.drop_returns(keys, 2), "json", f"{folder}/json")
    assert spark.read.csv(f"{folder}/csv", header=True).count() == 60
    assert spark.read.json(f"{folder}/json").count() == 60


def test_extracts_go_after_use(spark):
    with extracted(spark.range(5).toDF("a"), "extract-test") as rows:
        assert rows.count() == 5
        folder = Path(unquote(urlparse(rows.inputFiles()[0]).path)).parent
        assert folder.exists()
    assert not folder.exists()
