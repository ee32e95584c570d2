import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns[0] == "sales_platform" and len(rows) > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_stream_ticket_feed_equals_batch(spark):
    out = E.queries()["stream_ticket_feed"](spark, "/root/testdata/sf0.001")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert out.count() == orders.count()
    assert out.where("status = 'O' or status = 'X'").count() == 0
