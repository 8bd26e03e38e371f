from datetime import date

import pytest

from strata.plans.lake import RETURNS, SHIPMENTS
from strata.streaming.drops import exposed, extra_names, has_files, land, landed, typed
from tests.conftest import sets

HEADER = "shipment_id,order_id,distributor,ship_date,qty_cases,warehouse\n"


class Landing:
    def __init__(self, spark, base, feed):
        self.spark, self.base, self.feed = spark, base, feed
        self.folder = base / "landing" / feed.name

    def drop(self, name, text):
        path = self.folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")

    def run(self, **options):
        return land(
            self.spark, self.feed, str(self.folder), f"{self.base}/table", f"{self.base}/cp", **options
        )

    def rows(self):
        return landed(self.spark, self.feed, f"{self.base}/table")


@pytest.fixture()
def shipments(spark, tmp_path):
    return Landing(spark, tmp_path, SHIPMENTS)


@pytest.fixture()
def returns(spark, tmp_path):
    return Landing(spark, tmp_path, RETURNS)


def test_missing_and_empty_folders(shipments):
    assert not has_files(shipments.spark, str(shipments.folder))
    assert shipments.run() == 0 and shipments.rows().count() == 0
    shipments.folder.mkdir(parents=True)
    assert not has_files(shipments.spark, str(shipments.folder))
    assert shipments.run() == 0
    shipments.drop("2026/06/a.csv", HEADER)
    assert has_files(shipments.spark, str(shipments.folder))


def test_each_file_once_and_text_as_delivered(shipments):
    shipments.drop("a.csv", HEADER + '20260601001,7,"Beer, Line",2026-06-01,5,007\n\n')
    assert shipments.run() == 1
    assert shipments.run() == 0
    shipments.drop("deep/b c.csv", "warehouse,shipment_id\n1e5,20260601002\n")
    assert shipments.run() == 1
    rows = typed(shipments.rows(), SHIPMENTS)
    assert sets(rows, "shipment_id", "order_id", "distributor", "ship_date", "qty_cases", "warehouse") == {
        (20260601001, 7, "Beer, Line", date(2026, 6, 1), 5, "007"),
        (20260601002, None, None, None, None, "1e5"),
    }
    assert {r["_source_file"].rsplit("/", 1)[1] for r in rows.collect()} == {"a.csv", "b%20c.csv"}


def test_header_repeated_as_data_stays(shipments):
    shipments.drop("a.csv", HEADER + HEADER + "1,2,d,2026-06-01,3,w\n")
    assert shipments.run() == 2
    rows = typed(shipments.rows(), SHIPMENTS)
    assert rows.where("shipment_id is null and _rescued_data is not null").count() == 1


def test_small_batches_cover_the_backlog(shipments):
    for i in range(5):
        shipments.drop(f"{i}.csv", HEADER + f"{i},1,d,2026-06-01,3,w\n")
    assert shipments.run(files_per_batch=2) == 5
    assert shipments.rows().select("_batch").distinct().count() == 3


def test_new_columns_are_kept(shipments):
    shipments.drop("a.csv", HEADER + "1,2,d,2026-06-01,3,w\n")
    shipments.drop("b.csv", "extra," + HEADER + "hello,2,2,d,2026-06-01,3,w\n")
    shipments.run()
    assert sets(extra_names(shipments.rows()), "field") == {("extra",)}
    wide = exposed(shipments.rows(), "extra")
    assert sets(wide, "shipment_id", "extra") == {("1", None), ("2", "hello")}


def test_misfits_and_ragged_rows_are_rescued(shipments):
    shipments.drop("a.csv", HEADER + "1,2,d,soon,many,w\n2,2,d,2026-06-01,3,w,too,long\n3,4,d,2026-06-01,3,w\n")
    shipments.run()
    rows = {r["shipment_id"]: r for r in typed(shipments.rows(), SHIPMENTS).collect()}
    assert rows[1]["_rescued_data"] == '{"ship_date":"soon","qty_cases":"many"}'
    assert rows[1]["ship_date"] is None and rows[1]["distributor"] == "d"
    assert rows[2]["_rescued_data"] == "2,2,d,2026-06-01,3,w,too,long" and rows[2]["order_id"] == 2
    assert rows[3]["_rescued_data"] is None


def test_json_lines(returns):
    returns.drop(
        "a.json",
        '{"return_id": 20260601001, "order_id": 3, "reason": "damaged", "note": {"a": [1]}}\n'
        '{"return_id": 2, "quantity": "x"}\nnot json\n',
    )
    assert returns.run() == 3
    rows = {r["return_id"]: r for r in typed(returns.rows(), RETURNS).collect()}
    assert rows[20260601001]["_rescued_data"] == '{"note":"{\\"a\\":[1]}"}'
    assert rows[20260601001]["reason"] == "damaged"
    assert rows[2]["_rescued_data"] == '{"quantity":"x"}' and rows[2]["quantity"] is None
    assert rows[None]["_rescued_data"] == "not json"


def test_names_that_look_like_patterns(shipments):
    for i, name in enumerate(["s1.csv", "s2.csv", "s[12].csv", "{a,b}.csv"]):
        shipments.drop(name, HEADER + f"{i},{i},D,2026-06-10,5,W\n")
    shipments.run()
    assert sorted(r["shipment_id"] for r in shipments.rows().collect()) == ["0", "1", "2", "3"]


def test_a_repeated_header_name_is_rescued(shipments):
    shipments.drop("good.csv", HEADER + "1,1,D,2026-06-10,5,W\n")
    shipments.drop("bad.csv", "shipment_id,order_id,Order_id\n2,3,4\n")
    shipments.run()
    rows = shipments.rows().collect()
    assert {r["shipment_id"] for r in rows} == {"1", None}
    assert "2,3,4" in {r["_rescued_data"] for r in rows}


def test_a_field_declared_later_is_no_longer_rescued(shipments):
    from dataclasses import replace

    shipments.drop("a.csv", "shipment_id,order_id,carrier,boxes\n1,1,fast,many\n2,2,slow,3\n")
    shipments.run()
    wider = replace(SHIPMENTS, types={**SHIPMENTS.types, "boxes": "int"})
    rows = {r["shipment_id"]: (r["boxes"], r["_rescued_data"]) for r in typed(exposed(shipments.rows(), "boxes"), wider).collect()}
    assert rows[1][0] is None and "many" in rows[1][1] and "fast" in rows[1][1]
    assert rows[2][0] == 3 and "boxes" not in rows[2][1]


def test_headers_with_any_names(shipments):
    """Back quotes, names that Spark uses itself, and declared names in another case."""
    shipments.drop("a.csv", "SHIPMENT_ID,or`der,_corrupt_text,_metadata,_source_file,Warehouse\n7,x,y,z,f,w1\n8,x,y,z,f,w2,more\n")
    shipments.drop("b.csv", HEADER + "1,2,d,2026-06-01,3,w\n")
    assert shipments.run() == 3
    rows = {r["shipment_id"]: r for r in shipments.rows().collect()}
    assert set(rows) == {"1", "7", "8"} and rows["7"]["warehouse"] == "w1"
    assert rows["7"]["_extra"] == {"or`der": "x", "_corrupt_text": "y", "_metadata": "z", "_source_file": "f"}
    assert rows["7"]["_source_file"].endswith("a.csv") and rows["7"]["_rescued_data"] is None
    assert rows["8"]["_rescued_data"] == "8,x,y,z,f,w2,more"
