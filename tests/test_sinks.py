from quaystone.sources import sinks as K


def test_partition_overwrite_replaces_only_touched(spark, tmp_path):
    path = str(tmp_path / "tbl")
    first = spark.createDataFrame([("2026-01", 1, "a"), ("2026-02", 2, "b")], "create_month_label string, id int, v string")
    K.overwrite_partitions(first, path, ["create_month_label"])
    second = spark.createDataFrame([("2026-02", 2, "B"), ("2026-03", 3, "c")], "create_month_label string, id int, v string")
    K.overwrite_partitions(second, path, ["create_month_label"])
    got = sorted((r.create_month_label, r.id, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("2026-01", 1, "a"), ("2026-02", 2, "B"), ("2026-03", 3, "c")]


def test_json_report_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("m", "success", 3), ("m", "missing_end", 1)], "metric_code string, status string, n long")
    path = str(tmp_path / "report")
    K.write_json_report(df, path)
    back = sorted(tuple(r) for r in spark.read.schema("metric_code string, status string, n long").json(path).collect())
    assert back == sorted(tuple(r) for r in df.collect())


def test_document_rows(spark):
    snap = spark.createDataFrame([(2, "20260713"), (1, "0000-12-30"), (3, "")], "seq_no int, d string")
    rows = K.document_rows(snap, ["seq_no"], ["d"]).collect()
    assert [r.seq_no for r in rows] == [1, 2, 3]
    assert [r.d for r in rows] == ["0000-12-30", "2026-07-13", ""]
    assert rows[0][K.DOCUMENT_CATEGORY_HEADER] == K.DOCUMENT_CATEGORY_VALUE


def test_schema_evolution_and_run_log(spark):
    from quaystone.operators import history as H
    from quaystone.sources.layout import evolve
    old = spark.createDataFrame([(1, "a")], "id int, v string")
    new = spark.createDataFrame([(2, "b", 9.5)], "id int, v string, extra double")
    rows = sorted(map(tuple, evolve(old, new).collect()))
    assert rows == [(1, "a", None), (2, "b", 9.5)]
    outcomes = spark.createDataFrame([("inserted",), ("failed",)], "outcome string")
    log = H.run_log_row(spark, "sync", "B1", H.outcome_counts(outcomes)).first()
    assert (log.task_name, log.sync_batch_id, log.rows, log.status) == ("sync", "B1", 2, "partial")
