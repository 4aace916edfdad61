from kaghamar.streaming.dedup import first_arrivals

LONG = "Սա բավական երկար պարբերություն է, որ մնա մաքրելուց հետո նույնպես։"


def test_first_arrivals(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = [(LONG,), (LONG + " ",), ("կարճ",), (LONG + " Երկրորդ։",)]
    spark.createDataFrame(rows, "text string").coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema("text string").parquet(folder)
    job = first_arrivals(stream).writeStream.format("memory").queryName("arrivals").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    job.awaitTermination(120)
    assert spark.table("arrivals").count() == 2
