import json

from boxlake.streaming.logs import early_stops, metric_events, minute_means


def test_streams(spark, tmp_path):
    rows = [{"run": "r", "epoch": e, "metric": 0.2 if e == 1 else 0.2005, "at": f"2025-01-01T00:{e:02d}:00"} for e in range(1, 13)]
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / f"in/{i}.jsonl").write_text("\n".join(json.dumps(r) for r in rows[i * 4 : i * 4 + 4]))
    for name, df, mode in (("stops", early_stops(metric_events(spark, str(tmp_path / "in"))), "update"), ("means", minute_means(metric_events(spark, str(tmp_path / "in"))), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
    last = spark.table("stops").orderBy("epoch", ascending=False).first()
    assert last["stopped"] and last["epoch"] == 10 and last["best_epoch"] == 1
    assert spark.table("means").agg({"n": "sum"}).first()[0] == 12


def test_late_epochs_and_forgotten_runs(spark, tmp_path):
    """Epochs that come too late are counted; a run that is idle for an hour of events begins anew."""
    (tmp_path / "in").mkdir()
    line = lambda run, epoch, at: json.dumps({"run": run, "epoch": epoch, "metric": epoch / 10, "at": at})
    files = ([line("a", 1, "2025-01-01T00:00:00"), line("a", 3, "2025-01-01T00:01:00")], [line("a", 2, "2025-01-01T00:02:00")], [line("b", 1, "2025-01-01T09:00:00")], [line("b", 2, "2025-01-01T09:30:00")], [line("a", 1, "2025-01-01T09:31:00")])
    for i, rows in enumerate(files):
        (tmp_path / f"in/{i}.jsonl").write_text("\n".join(rows))
        q = early_stops(metric_events(spark, str(tmp_path / "in")), idle_minutes=60).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).foreachBatch(lambda df, n: df.write.mode("append").parquet(str(tmp_path / "out"))).start()
        q.awaitTermination(60)
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("run", "epoch", "n_late").collect()]
    assert ("a", 3, 1) in got and ("a", 1, 0) in got and ("b", 2, 0) in got
