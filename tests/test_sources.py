"""Readers, writers, segmentation and small column helpers."""

import gzip
from pathlib import Path

import pytest

from lumenframe.functions import columns as fx
from lumenframe.operators import rfm as seg
from lumenframe.operators.joins import small_or_shuffled
from lumenframe.plans import files
from lumenframe.session import shared_folder
from lumenframe.sources import readers, writers


def test_quality_file_gets_a_binary_target(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text("fixed acidity;alcohol;quality\n7.4;9.4;5\n8.1;10.2;7\n")
    df = readers.read_quality(spark, str(path), "`fixed acidity` double, alcohol double, quality int")
    assert [r["quality_binary"] for r in df.orderBy("quality").collect()] == [0, 1]
    assert readers.feature_columns(df, ["quality", "quality_binary"]) == ["fixed acidity", "alcohol"]


def test_measurements_read_na_as_null(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("No,pm2.5,cbwd\n1,NA,NW\n2,129.0,cv\n")
    rows = readers.read_measurements(spark, str(path), "No long, `pm2.5` double, cbwd string").orderBy("No").collect()
    assert rows[0]["pm2.5"] is None and rows[1]["pm2.5"] == 129.0


def test_ratings_and_items(spark, tmp_path):
    (tmp_path / "u.data").write_text("1\t2\t3\t881250949\n")
    row = readers.read_ratings(spark, str(tmp_path / "u.data")).first()
    assert (row.user_id, row.item_id, row.rating, row.timestamp) == (1, 2, 3.0, 881250949)
    line = "5|Les Misérables (1995)|01-Jan-1995||http://x|" + "|".join("01" * 9 + "0")
    (tmp_path / "u.item").write_bytes((line + "\n").encode("latin-1"))
    flags = [f"g{i}" for i in range(19)]
    item = readers.read_items(spark, str(tmp_path / "u.item"), flags).first()
    assert item["title"] == "Les Misérables (1995)" and len(item) == 21 and item["g1"] == 1


def test_corpus_reader_strips_and_filters(spark, tmp_path):
    message = "From: a@b.c\nSubject: hi\n\nX writes:\n> old words\nnew words\nmore\n--\nsignature\n"
    for category in ("one", "two"):
        (tmp_path / category).mkdir()
        (tmp_path / category / "1").write_text(message)
    df = readers.read_corpus(spark, str(tmp_path), ["one"])
    row = df.collect()
    assert len(row) == 1 and row[0]["category"] == "one" and row[0]["text"] == "new words\nmore"
    odd = [
        ("From: a\nTo: b,\n c\n\nbody", "body"),
        ("one\n---\ntwo\n--\nsig", "one\n---\ntwo"),
        ("she says: x\nIn article 5\ntext", "text"),
        ("no header\n\nlast", "no header\n\nlast"),
    ]
    bodies = spark.createDataFrame(odd, "m string, want string").withColumn("got", readers.strip_message("m"))
    assert bodies.filter("got <> want").count() == 0
    assert readers.read_corpus(spark, str(tmp_path)).count() == 2


def test_predictions_round_trip_with_odd_text_and_padded_names(spark, tmp_path):
    texts = ['quote " and, comma', "two\nlines", "plain"]
    df = spark.createDataFrame([(t, 1) for t in texts], "` text ` string, `label ` int")
    path = writers.write_table(df, str(tmp_path / "p"))
    got = readers.read_predictions(spark, path)
    assert got.columns == ["text", "label"] and sorted(r["text"] for r in got.collect()) == sorted(texts)


def test_writers_refuse_to_overwrite(spark, tmp_path):
    path = writers.write_metrics(spark.range(1), str(tmp_path / "m"))
    with pytest.raises(Exception):
        writers.write_metrics(spark.range(1), path)


def test_rfm_counts_whole_days_and_distinct_invoices(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1, 'A1', TIMESTAMP '2024-01-01 12:00:00', 2.0, 5.0),
        (1, 'A1', TIMESTAMP '2024-01-01 12:00:00', 1.0, 1.0), (2, 'B1', TIMESTAMP '2024-01-03 10:00:00', 1.0, 7.0),
        (2, 'C9', TIMESTAMP '2024-02-01 00:00:00', 1.0, 9.0), (NULL, 'D1', TIMESTAMP '2024-01-05 00:00:00', 1.0, 1.0)
        AS t(customer_id, invoice_no, invoice_ts, quantity, unit_price)"""
    )
    got = {r["customer_id"]: tuple(r)[1:] for r in seg.rfm(seg.billable(df, "C")).collect()}
    assert got == {1: (2, 1, 11.0), 2: (1, 1, 7.0)}


def test_null_prefix_is_kept_and_null_text_is_no_match(spark):
    df = spark.createDataFrame([("C1", "Fine day"), (None, None), ("X", "FINE")], "no string, text string")
    assert df.filter(fx.not_prefixed("no", "C")).count() == 2
    assert df.filter(fx.matches("text", "fine|x")).count() == 2
    assert df.filter(fx.contains_text("text", "fine")).count() == 2


def test_ratio_by_zero_is_null(spark):
    row = spark.createDataFrame([(1.0, 0.0)], "a double, b double").select(fx.ratio("a", "b")).first()
    assert row[0] is None


def test_large_side_tables_are_not_broadcast(spark):
    side, rows = spark.range(50), spark.range(100)
    small = rows.join(small_or_shuffled(side), "id")._jdf.queryExecution().optimizedPlan().toString()
    large = rows.join(small_or_shuffled(side, max_rows=10), "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in small and "broadcast" not in large


def test_messages_are_written_by_all_cores(spark, tmp_path):
    rows = [(i, f"text {i}", "en" if i % 2 else "de") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    files.a7_read_corpus(spark, str(tmp_path)).collect()
    folder = max(Path(shared_folder(spark)).glob("lumenframe-corpus-*"), key=lambda p: p.stat().st_mtime)
    names = [p.name for p in folder.rglob("part-*.txt")]
    assert len(names) == 40 and len({n.split("-")[1] for n in names}) > 1


def test_a_task_reads_many_messages(spark, tmp_path):
    rows = spark.range(1500).selectExpr("cast(id as string) AS value", "if(id % 3 = 0, 'b/c', 'a') AS category").repartition(3)
    folder = writers.write_messages(rows, f"{tmp_path}/mes sages")
    df = readers.read_corpus(spark, folder, strip=False)
    assert df.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert {r["text"] for r in df.collect()} == {f"{k}\n" for k in range(1500)}
    with pytest.raises(FileExistsError):
        writers.write_messages(rows, folder)


def test_compressed_messages_are_unpacked(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "1.gz").write_bytes(gzip.compress(b"new words"))
    (tmp_path / "one" / "2").write_text("old words")
    got = {(r["category"], r["text"]) for r in readers.read_corpus(spark, str(tmp_path)).collect()}
    assert got == {("one", "new words"), ("one", "old words")}
