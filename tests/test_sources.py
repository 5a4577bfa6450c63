import json
from types import SimpleNamespace

import pytest
from pyspark.sql import types as T

from stratamart import session
from stratamart.sources import csv, jdbc, payment_export


def test_rescued_rows_are_kept(spark, rows, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "product.csv").write_text("product_id,price\n1,2.5\nx,3.5\n3,\n4,1.0,extra\n")
    (folder / "readme.txt").write_text("ignored")
    schema = T.StructType([T.StructField("product_id", T.IntegerType()), T.StructField("price", T.DoubleType())])
    tables = csv.read_csv_folder(spark, str(folder), {"product_bronze": schema})
    assert list(tables) == ["product_bronze"]
    assert rows(tables["product_bronze"]) == sorted(
        [(1, 2.5, None), (None, 3.5, "x,3.5"), (3, None, None), (4, 1.0, "4,1.0,extra")], key=repr)


def test_inferred_types(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c\n1,x,true\n2,y,false\n")
    df = csv.read_csv_bronze(spark, str(path))
    assert [t for _, t in df.dtypes] == ["int", "string", "boolean", "string"]
    assert csv.read_csv_bronze(spark, str(path), rescued=None).columns == ["a", "b", "c"]
    assert csv.bronze_name("/x/order_item.csv") == "order_item_bronze"


def test_multiline_documents(spark, rows, tmp_path):
    folder = tmp_path / "export"
    folder.mkdir()
    payments = [{"id": "a", "amount_received": 5, "metadata": {"k": [1, {"z": None}]}}, {"id": "b", "extra": {"n": 1}}]
    (folder / "one.json").write_text(json.dumps({"object": "list", "data": payments}, indent=2))
    (folder / "two.json").write_text(json.dumps({"object": "list"}))
    (folder / "three.json").write_text(json.dumps({"data": []}))
    parsed = payment_export.read_payment_export(spark, str(folder))
    assert rows(parsed, "index", "id", "amount_received") == [(0, "a", 5), (1, "b", None)]
    assert [json.loads(r["raw"]) for r in parsed.orderBy("index").collect()] == payments
    assert json.loads(parsed.where("id = 'a'").first()["metadata"]) == {"k": [1, {"z": None}]}
    assert parsed.where("id = 'b'").first()["present_keys"] == ["id", "extra"]
    assert "raw" not in payment_export.read_payment_export(spark, str(folder), keep_raw=False).columns


def test_document_without_data(spark, tmp_path):
    path = tmp_path / "empty.json"
    path.write_text('{"object": "list"}')
    assert payment_export.read_payment_export(spark, str(path)).count() == 0


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x", "orders")
    assert plain == {"url": "jdbc:x", "dbtable": "orders", "fetchsize": "10000"}
    split = jdbc.jdbc_options("jdbc:x", "orders", "order_id", (1, 1000), 8, user="u")
    assert split["partitionColumn"] == "order_id" and split["numPartitions"] == "8" and split["user"] == "u"
    assert (split["lowerBound"], split["upperBound"]) == ("1", "1000")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "orders", "order_id")


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


@pytest.mark.parametrize("master, folder", [("local[2]", None), ("spark://host:7077", None), ("spark://host:7077", "s3://b/cp/")])
def test_local_folders_are_for_local_masters_only(master, folder):
    fake = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master=master)
    )
    if folder is None and not master.startswith("local"):
        with pytest.raises(ValueError):
            session.shared_folder(fake)
    else:
        assert session.shared_folder(fake) == (folder or session.shared_folder(fake)).rstrip("/")


@pytest.mark.parametrize("multiline", [True, False])
def test_documents_and_positions(spark, tmp_path, multiline):
    """Broken documents are rows with an error; positions follow files, documents and elements."""
    one = lambda *ids: json.dumps({"data": [{"id": i, "currency": "usd"} for i in ids]})
    files = [[one("a", "b"), '{"other": 1}', one("c")], ['{"data": [{"id"', '{"data": {"id": 1}}', "[1]", '{"data": null}', one("d", "e")]]
    for k, texts in enumerate(files):
        if multiline:
            for j, text in enumerate(texts):
                (tmp_path / f"{k}{j}.json").write_text(text)
        else:
            (tmp_path / f"{k}.json").write_text("\n".join(texts) + "\n\n")
    documents = payment_export.read_documents(spark, str(tmp_path), multiline)
    assert documents.count() == 8 and documents.where("error IS NOT NULL").count() == 3
    placed = payment_export.positioned_payments(documents).select("position", "id").collect()
    assert sorted(tuple(r) for r in placed) == [(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e")]


def test_positions_over_many_splits_without_a_single_partition(spark):
    """Sizes of many files, some empty, in shuffled order; the sorted pieces are many."""
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [(f"f{k:03d}", block, (k * 7 + block) % 5) for k in range(60) for block in (0, 128)]
        held = [(d, b, 0, [json.dumps({"id": f"{d}-{b}-{i}"}) for i in range(n)], None) for d, b, n in sizes[::-1]]
        documents = spark.createDataFrame(held, "document string, block bigint, line bigint, data array<string>, error string").repartition(6)
        placed = payment_export.positioned_payments(documents)
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
        found = [r["id"] for r in placed.select("id", "position").orderBy("position").collect()]
        assert found == [f"{d}-{b}-{i}" for d, b, n in sorted(sizes) for i in range(n)]
        assert payment_export.positioned_payments(documents.limit(0)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_misfit_cells_are_rescued_by_name(spark, tmp_path):
    lines = ["id,price,day,note", "1,2.50,2024-01-01,fine", "x,cheap,2024-01-02,\"a, b\"", "3,,not a day,", "4,1", "5,1,2024-01-03,n,extra", ",,,"]
    (tmp_path / "cells.csv").write_text("\n".join(lines) + "\n")
    schema = T.StructType.fromDDL("id int, price decimal(10,2), day date, note string")
    rows = csv.read_csv_cells(spark, str(tmp_path / "cells.csv"), schema).collect()
    assert rows[0][csv.RESCUED] is None and (rows[0]["id"], rows[0]["note"]) == (1, "fine")
    assert json.loads(rows[1][csv.RESCUED]) == {"id": "x", "price": "cheap"}
    assert (rows[1]["id"], rows[1]["price"], str(rows[1]["day"]), rows[1]["note"]) == (None, None, "2024-01-02", "a, b")
    assert json.loads(rows[2][csv.RESCUED]) == {"day": "not a day"} and rows[2]["id"] == 3
    assert json.loads(rows[3][csv.RESCUED]) == {csv.RESCUED: "4,1"} and rows[3]["id"] == 4
    assert json.loads(rows[4][csv.RESCUED]) == {csv.RESCUED: "5,1,2024-01-03,n,extra"} and rows[4]["note"] == "n"
    assert rows[5][csv.RESCUED] is None
    with pytest.raises(ValueError):
        csv.read_csv_cells(spark, "x", T.StructType.fromDDL(f"{csv.RESCUED} string"))
