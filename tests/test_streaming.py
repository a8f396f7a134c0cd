from pyspark.sql import functions as F

from ledgerweb.streaming import upserts


def test_latest_table_from_a_stream(spark, tmp_path):
    source, schema = tmp_path / "in", "k int, t int, p string, q string"
    for i, rows in enumerate(([(1, 1, "a", None)], [(1, 2, None, "x"), (2, 1, "b", None)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        upserts.keep_latest(stream, str(tmp_path / "out"), ["k"], ["t"], ["p", "q"], str(tmp_path / "cp")).awaitTermination()
    got = {tuple(r) for r in upserts.read_latest(spark, str(tmp_path / "out")).select("k", "p", "q").collect()}
    assert got == {(1, "a", "x"), (2, "b", None)}


def test_a_late_value_takes_no_newer_ones_place(spark, tmp_path):
    source, schema = tmp_path / "in", "k int, t int, p string, q string"
    for rows in ([(1, 2, "new", None)], [(1, 1, "old", "first")], [(1, 3, None, None), (2, 1, "b", None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        upserts.keep_latest(stream, str(tmp_path / "out"), ["k"], ["t"], ["p", "q"], str(tmp_path / "cp")).awaitTermination()
    out = upserts.read_latest(spark, str(tmp_path / "out"))
    assert out.columns == ["k", "p", "q"] and {tuple(r) for r in out.collect()} == {(1, "new", "first"), (2, "b", None)}
    assert len(list((tmp_path / "out").glob("v*"))) == 2


def test_windowed_counts(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev"))
    q = upserts.windowed_counts(stream).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("w").agg(F.sum("n")).first()[0] == events.count()
