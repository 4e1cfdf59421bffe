import io

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetstream.plans import run_report
from fleetstream.schemas import RUN_FACT_FIELDS
from fleetstream.sources import run_files, run_source

FIELDS = "run_id string, scenario string, broker string, emitted bigint, received bigint, persisted bigint, batches bigint, alerts bigint, e2e_latency_s bigint, recovery_s bigint, recovery_timeout boolean, duration_s bigint"


def run(run_id="scenario-B-mqtt-x", **fields):
    defaults = {"emitted": 1000, "received": 900, "persisted": 900, "batches": 9, "alerts": 1, "e2e_latency_s": None, "recovery_s": None, "recovery_timeout": False, "duration_s": None}
    f = defaults | fields
    return (run_id, run_id.split("-")[1], run_id.split("-")[2], *(f[k] for k in defaults))


def test_first_broken_rule_is_reported(spark):
    cases = [
        (run(), ""),
        (run(e2e_latency_s=-1, recovery_s=70), "e2e_latency_s=-1 (negative)"),
        (run(e2e_latency_s=31, duration_s=30), "e2e_latency_s=31 > duration_s=30"),
        (run(e2e_latency_s=31), ""),
        (run(recovery_timeout=True, emitted=5), "recovery_s=timeout"),
        (run(recovery_s=61), "recovery_s=61 > 60"),
        (run(recovery_s=60), ""),
        (run(emitted=50), "emitted=50 < 100"),
        (run(received=1001), "received=1001 > emitted=1000"),
        (run(emitted=0, received=5), ""),
        (run(emitted=None, received=0), "received=0"),
        (run(received=0, batches=0), "received=0"),
        (run(received=0, batches=3), ""),
        (run("scenario-D-kafka-x", alerts=0), "alerts=0"),
        (run("scenario-A-kafka-x", alerts=0), ""),
    ]
    facts = spark.createDataFrame([row + (i,) for i, (row, _) in enumerate(cases)], FIELDS + ", i int")
    found = [r._invalid_reason for r in run_report.validated(facts).orderBy("i").collect()]
    assert found == [reason for _, reason in cases]


def write_run(root, run_id, files):
    folder = root / run_id
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    write_run(root, "scenario-A-kafka-1000-acksall", {
        "ingestion.log": "start\nRate mode završen: emitted=3000/3000\n[10:00:00 INF] Ingestion završen. emitted=3000 dropped=2\nx emitted=1 dropped=1\n",
        "analytics.log": "[1 WRN] ALERT window_start=0 mean_engine_temp=90.10 x\n[2 WRN] ALERT window_start=10000 mean_engine_temp=90.79 x\nlast\n",
        "storage_metrics.txt": "# HELP a b\n\nstorage_received_total 5\nstorage_received_total 3000\nstorage_persisted_total 2990\nstorage_batches_total 147\nstorage_lag_ms 1.5\nstorage_p95_lag_ms oops\n",
        "storage.log": "received = 77\n",
        "ingest_metrics.txt": "ingest_emitted_total 3000\n",
        "analytics_metrics.txt": "",
        "stats.csv": "Name,CPUPerc,MemUsage,NetIO,BlockIO\nfleet-kafka,80.00%,1GiB / 4GiB,a,b\nfleet-kafka,60.00%,512MiB / 4GiB,a,b\nfleet-storage,10.25%,100MiB / 4GiB,a,b\nother,99%,9GiB / 9GiB,a,b\n",
    })
    write_run(root, "scenario-B-mqtt-20260614-200255", {
        "ingestion.log": "Realtime mode završen: emitted=500\n",
        "timing.log": "Recovery detected at +23s after reconnect (1 -> 2)\nNo recovery within 60s\n",
        "storage.log": "batches x = 5\nreceived=450\nnot persisted = 3\npersisted: = 440\n",
    })
    write_run(root, "scenario-C-mqtt-20260614-133527", {
        "timing.log": "No recovery within 60s\n",
        "storage_metrics.txt": "storage_received_total 100\nstorage_persisted_total 96\n",
        "storage_metrics_burst_end.txt": "storage_received_total 80\nstorage_persisted_total 40\n",
        "storage_metrics_mid.txt": "storage_received_total 999\n",
    })
    write_run(root, "notes", {"ingestion.log": "emitted=1 dropped=1\n"})
    return str(root)


def test_report_from_files(spark, raw, tmp_path):
    facts = run_report.run_facts(run_files.run_lines(spark, raw), run_files.container_samples(spark, raw))
    found = {r.run_id: r for r in facts.collect()}
    assert set(found) == {"scenario-A-kafka-1000-acksall", "scenario-B-mqtt-20260614-200255", "scenario-C-mqtt-20260614-133527"}
    a, b, c = (found[k] for k in sorted(found))
    assert (a.broker, a.num_devices, a.level, a.emitted, a.dropped) == ("kafka", "1000", "acksall", 3000, 0)
    assert (a.received, a.persisted, a.batches, a.alerts, a.last_mean) == (3000, 2990, 147, 2, 90.79)
    assert (a.duration_s, a.throughput_msg_per_sec, a.loss_pct, a.peak_backlog) == (30, 100.0, 0.33, 10)
    assert (a.storage_lag_ms, a.storage_p95_lag_ms) == (1.5, None)
    assert (a.ingest_emitted, a.storage_emitted, a.analytics_emitted, a.analytics_throughput) == (3000.0, 3000.0, 0.0, 0.0)
    assert (a.total_cpu_avg, a.total_mem_mb_avg) == (80.25, 868.0)
    assert a._valid and a._invalid_reason == ""
    assert (b.emitted, b.dropped, b.received, b.persisted, b.batches) == (500, None, 450, 440, 5)
    assert (b.recovery_s, b.recovery_timeout, b.storage_emitted, b.total_cpu_avg) == (23, False, None, 0.0)
    assert (c.emitted, c.recovery_timeout, c.peak_backlog, c._invalid_reason) == (None, True, 40, "recovery_s=timeout")
    run_report.write_facts(facts, str(tmp_path / "tables"))
    written = spark.read.option("header", True).csv(str(tmp_path / "tables" / "scenario=A"))
    assert written.columns == sorted(set(RUN_FACT_FIELDS) - {"scenario"}) and written.count() == 1


def test_whole_report(spark, raw, tmp_path):
    tables = run_report.report(spark, raw, str(tmp_path / "report"))
    assert [tuple(r) for r in tables["A"].collect()] == [("kafka", "1000", "acksall", "100.0", "0.33", "80.25", "868.0")]
    assert [r.recovery_s for r in tables["C"].sparkSession.read.option("header", True).csv(str(tmp_path / "report")).where("scenario = 'B'").collect()] == ["23"]
    assert tables["C"].first().peak_backlog == "40" and tables["D"].count() == 0


def test_matching_lines(spark, raw):
    lines = run_files.run_lines(spark, raw)
    tail = run_report.matching_lines(lines, "ingestion.log", "emitted=", 2)
    found = sorted(r.value for r in tail.where("run_id LIKE 'scenario-A%'").collect())
    assert found == ["[10:00:00 INF] Ingestion završen. emitted=3000 dropped=2", "x emitted=1 dropped=1"]
    head = run_report.matching_lines(lines, "ingestion.log", "emitted=", 1, last=False)
    assert {r.value for r in head.collect()} == {"Rate mode završen: emitted=3000/3000", "Realtime mode završen: emitted=500"}


def test_metric_values_keep_the_last(spark, raw):
    lines = run_files.run_lines(spark, raw).where("run_id LIKE 'scenario-A%' AND file_name = 'storage_metrics.txt'")
    found = {r.metric: r.amount for r in run_report.metric_values(lines).collect()}
    assert found["storage_received_total"] == 3000.0 and "storage_p95_lag_ms" not in found


def test_slices_give_every_line_once_and_in_order(spark, tmp_path, monkeypatch):
    text = "".join(f"line {i} {'x' * (i % 37)}{chr(13) if i % 5 == 0 else ''}\n" for i in range(3000)) + "no end"
    whole = text.replace("\r", "").split("\n")
    data = text.encode()
    for block in (7, 100, 1 << 20):
        monkeypatch.setattr(run_source, "BLOCK", block)
        for n in (1, 2, 7):
            found = []
            for i in range(n):
                bounds = len(data) * i // n, len(data) * (i + 1) // n
                for offsets, texts in run_source.lines_between(io.BytesIO(data), *bounds):
                    assert all(data[o:].startswith(t.encode()) for o, t in zip(offsets, texts, strict=True))
                    found += texts
            assert found == whole
    assert [t for _, t in run_source.lines_between(io.BytesIO(b""), 0, 0)] == []
    assert list(run_source.lines_between(io.BytesIO(b"\n\na"), 0, 3)) == [([0, 1], ["", ""]), ([2], ["a"])]


def test_large_files_are_read_in_slices(spark, tmp_path):
    folder = tmp_path / "scenario-A-mqtt-1-qos0"
    folder.mkdir()
    # Above the size from which slices are read.
    with open(folder / "analytics.log", "w") as out:
        for i in range(70):
            out.write(f"{i} " + "y" * (1 << 20) + "\n")
    (folder / "ingestion.log").write_text("small\n")
    lines = run_files.run_lines(spark, str(tmp_path), slices=3)
    assert lines.rdd.getNumPartitions() == 3
    rows = lines.select("file_name", "line_no", F.split("value", " ")[0].alias("n")).orderBy("file_name", "line_no").collect()
    assert [r.n for r in rows] == [None, *map(str, range(70)), None, "small"]


def test_runs_are_written_with_their_names_and_read_again(spark, tmp_path):
    rows = [
        ("scenario-A-kafka-1-acks0", "analytics_metrics.txt", None, None),
        ("scenario-A-kafka-1-acks0", "storage.log", 2, "zwei €"),
        ("scenario-A-kafka-1-acks0", "storage.log", 1, ""),
        ("scenario-B-mqtt-20260101-000000", "storage.log", 1, "one"),
    ]
    lines = spark.createDataFrame(rows, run_source.LINES)
    root = str(tmp_path / "runs")
    for _ in range(2):
        # Writing again replaces the files.
        run_files.write_runs(lines, root)
    files = sorted(str(p.relative_to(root)) for p in (tmp_path / "runs").rglob("*") if p.is_file())
    assert files == [
        "_SUCCESS",
        "scenario-A-kafka-1-acks0/analytics_metrics.txt",
        "scenario-A-kafka-1-acks0/storage.log",
        "scenario-B-mqtt-20260101-000000/storage.log",
    ]
    read = run_files.run_lines(spark, root)
    assert sorted((tuple(r) for r in read.collect()), key=repr) == sorted(
        [
            ("scenario-A-kafka-1-acks0", "analytics_metrics.txt", None, None),
            ("scenario-A-kafka-1-acks0", "storage.log", None, None),
            ("scenario-A-kafka-1-acks0", "storage.log", 0, ""),
            ("scenario-A-kafka-1-acks0", "storage.log", 1, "zwei €"),
            ("scenario-B-mqtt-20260101-000000", "storage.log", None, None),
            ("scenario-B-mqtt-20260101-000000", "storage.log", 0, "one"),
        ],
        key=repr,
    )
    with pytest.raises(Exception, match="nothing else is overwritten"):
        lines.write.format("run_directories").mode("overwrite").save(root)


def test_a_failed_task_leaves_no_partial_file(tmp_path):
    writer = run_source.LinesWriter({"path": str(tmp_path)})

    def batch(*rows):
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["run_id", "file_name", "value"])

    def failing():
        yield batch(("r1", "a.log", "x"), ("r1", "b.log", "y"))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(failing())
    assert [p.name for p in (tmp_path / "r1").iterdir()] == ["a.log"]
    with pytest.raises(ValueError, match="adjacent"):
        writer.write(iter([batch(("r1", "b.log", "x"), ("r1", "a.log", "y"))]))
    assert writer.write(iter([batch(("r1", "a.log", "z"))])).files == 1
    assert (tmp_path / "r1" / "a.log").read_text() == "z\n"


def test_no_run_directories(spark, tmp_path):
    (tmp_path / "other").mkdir()
    assert run_files.run_lines(spark, str(tmp_path)).count() == 0
    assert run_files.container_samples(spark, str(tmp_path)).count() == 0


# Published run facts: run id, throughput, loss, recovery, e2e, alerts, last mean, lag, p95, backlog, CPU, RAM.
PUBLISHED = [
    ("scenario-A-kafka-1000-acksall", 10000.0, 0.0, None, None, 3, 90.7, 0.0, 0.0, 0, 140.7, 757.14),
    ("scenario-A-kafka-10000-acksall", 100000.0, 0.0, None, None, 3, 90.71, 0.0, 0.0, 0, 200.66, 1039.07),
    ("scenario-A-mqtt-1000-qos2", 10000.0, 0.0, None, None, 3, 90.7, 0.0, 0.0, 0, 430.47, 181.0),
    ("scenario-A-mqtt-10000-qos1", 100000.0, 81.37, None, None, 1, 90.71, 0.0, 0.0, 60, 574.47, 1080.32),
    ("scenario-B-kafka-20260614-200448", None, None, 23, None, 11, 90.63, 10.0, 12.0, 92, 70.8, 763.99),
    ("scenario-B-mqtt-20260614-182525", None, None, 23, None, 11, 90.44, 7.0, 23.0, 63, 40.31, 206.49),
    ("scenario-B-mqtt-20260614-200255", None, None, 1, None, 9, 90.45, 11.0, 22.0, 68, 46.79, 176.13),
    ("scenario-C-kafka-20260614-183640", None, None, None, None, 15, 91.4, 6.0, 22.0, 343, 52.94, 715.07),
    ("scenario-C-kafka-20260614-201226", None, None, None, None, 15, 91.55, 3.0, 23.0, 403, 56.24, 799.03),
    ("scenario-C-mqtt-20260614-183308", None, None, None, None, 15, 91.45, 6.0, 25.0, 339, 35.77, 191.6),
    ("scenario-C-mqtt-20260614-200934", None, None, None, None, 15, 91.43, 6.0, 22.0, 171, 42.29, 185.23),
    ("scenario-D-kafka-20260614-185849", None, None, None, 6, 17, 90.71, 0.0, 0.0, 69, 63.17, 672.96),
    ("scenario-D-kafka-20260614-201911", None, None, None, 3, 18, 90.5, 0.0, 0.0, 4, 65.06, 780.07),
    ("scenario-D-mqtt-20260614-201554", None, None, None, 8, 17, 90.53, 0.0, 0.0, 136, 66.45, 164.49),
]


def published(spark, valid=lambda run_id: True):
    rows = []
    for run_id, *rest in PUBLISHED:
        parts = run_id.split("-")
        sized = parts[1] == "A"
        rows.append((run_id, parts[1], parts[2], parts[3] if sized else "", parts[4] if sized else "", valid(run_id), *rest))
    return spark.createDataFrame(
        rows,
        "run_id string, scenario string, broker string, num_devices string, level string, _valid boolean, "
        "throughput_msg_per_sec double, loss_pct double, recovery_s bigint, e2e_latency_s bigint, alerts bigint, "
        "last_mean double, storage_lag_ms double, storage_p95_lag_ms double, peak_backlog bigint, "
        "total_cpu_avg double, total_mem_mb_avg double",
    ).selectExpr("*", "false AS recovery_timeout", "CAST(null AS bigint) AS duration_s", "CAST(null AS string) AS first_alert_after_reconnect")


def test_published_comparison(spark):
    tables = run_report.comparison_tables(run_report.latest_valid(published(spark)))
    found = {s: sorted(tuple(r) for r in t.collect()) for s, t in tables.items()}
    na = "n/a"
    assert found == {
        "A": [("kafka", "10000", "acksall", "100000.0", "0.0", "200.66", "1039.07"), ("mqtt", "10000", "qos1", "100000.0", "81.37", "574.47", "1080.32")],
        "B": [("kafka", na, na, "23", na, na, "70.8", "763.99"), ("mqtt", na, na, "1", na, na, "46.79", "176.13")],
        "C": [("kafka", na, na, "3", "23", "403", "56.24", "799.03"), ("mqtt", na, na, "6", "22", "171", "42.29", "185.23")],
        "D": [("kafka", "18", "90.5", "3", "65.06", "780.07"), ("mqtt", "17", "90.53", "8", "66.45", "164.49")],
    }


def test_latest_prefers_valid_and_falls_back(spark):
    chosen = {(r.scenario, r.broker): r.run_id for r in run_report.latest_valid(published(spark, lambda i: "200255" not in i)).collect()}
    assert chosen["B", "mqtt"].endswith("182525")
    none_valid = {(r.scenario, r.broker): r.run_id for r in run_report.latest_valid(published(spark, lambda i: False)).collect()}
    assert none_valid["B", "mqtt"].endswith("200255")


def test_union_sorts_and_fills_columns(spark):
    whole = run_report.union_facts(spark.createDataFrame([(1, 2)], "b int, a int"), spark.createDataFrame([(3,)], "c int"))
    assert whole.columns == ["a", "b", "c"]
    assert sorted(map(tuple, whole.collect()), key=repr) == [(2, 1, None), (None, None, 3)]
