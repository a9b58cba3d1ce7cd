import json
import os

import pytest

from tapewright.plans import jobs
from tapewright.plans.jobs import Layout
from tapewright.schemas import TRADE, ZSCORED_TRADE
from tapewright.sources.files import latest_input, read_optional, read_table, required_input


@pytest.fixture(scope="module")
def layout(tmp_path_factory):
    root = tmp_path_factory.mktemp("work")
    names = ("raw", "cleaned", "scores", "windows", "charts", "dashboard")
    return Layout(**{n: str(root / n) for n in names})


@pytest.fixture(scope="module", params=["parquet", "csv"])
def produced(request, spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    names = ("raw", "cleaned", "scores", "windows", "charts", "dashboard")
    layout = Layout(**{n: str(root / n) for n in names})
    raw = jobs.generate_job(spark, layout, per_symbol=150)
    made = jobs.offline_pipeline(spark, layout, form=request.param)
    return layout, raw, made, request.param


def test_missing_input_is_an_error(spark, layout):
    with pytest.raises(FileNotFoundError):
        jobs.clean_job(spark, layout)
    with pytest.raises(FileNotFoundError):
        jobs.zscore_job(spark, layout)
    with pytest.raises(FileNotFoundError):
        jobs.stream_report(spark, layout)


def test_newest_match(spark, tmp_path):
    assert latest_input(spark, str(tmp_path), "trades_*.json") is None
    for age, name in enumerate(["trades_b.json", "trades_a.json", "other.json"]):
        (tmp_path / name).write_text("{}\n")
        os.utime(tmp_path / name, (1_700_000_000 + age, 1_700_000_000 + age))
    found = required_input(spark, str(tmp_path), "trades_*.json")
    assert found.endswith("/trades_a.json")


def test_optional_table(spark, tmp_path):
    for path in (None, str(tmp_path / "none")):
        table = read_optional(spark, path, TRADE)
        assert table.isEmpty() and table.columns == TRADE.fieldNames()


def test_pipeline(spark, produced):
    layout, raw, made, form = produced
    report = jobs.report_job(spark, raw).first()
    assert report["before_rows"] == 350 and report["after_rows"] == 300
    cleaned = read_table(spark, made["cleaned"], TRADE)
    assert cleaned.count() == 300
    assert jobs.latest_input(spark, layout.cleaned, jobs.CLEANED_PATTERN) == made["cleaned"]
    zscores = read_table(spark, made["zscores"], ZSCORED_TRADE)
    assert zscores.count() == 300 and zscores.columns == ZSCORED_TRADE.fieldNames()
    assert ("csv" in form) == any(f.endswith(".csv") for f in os.listdir(made["forest"]))


def test_charts_and_batch_document(spark, produced):
    layout, _, _, form = produced
    written = jobs.batch_report(spark, layout, form=form)
    assert len(written) == 9
    path = jobs.payload_job(spark, layout)
    text = "\n".join(r["value"] for r in spark.read.option("wholetext", True).text(path).collect())
    document = json.loads(text)
    assert document["summary"]["source"] == "cleaned_batch"
    assert document["summary"]["total_records"] == 300
    assert document["summary"]["ml_anomaly_count"] == len(document["ml_anomalies"]) > 0


def test_stream_output_is_preferred(spark, produced):
    from tapewright.operators.windows import window_aggregates
    from tapewright.streaming.sinks import write_table

    layout, _, made, form = produced
    windows = window_aggregates(read_table(spark, made["cleaned"], TRADE))
    write_table(windows, layout.windows, form)
    written = jobs.stream_report(spark, layout, symbols="btcusd", form=form)
    assert len(written) == 4
    document = json.loads(jobs.payload_document(spark, layout).first()["payload"])
    assert document["summary"]["source"] == "spark_stream"
    assert document["summary"]["total_records"] == 300


def test_command_line(spark, tmp_path, capsys):
    from tapewright.__main__ import main

    dirs = []
    for name in ("raw", "cleaned", "scores", "windows", "charts", "dashboard"):
        dirs += [f"--{name}_dir", str(tmp_path / name)]
    main(["generate", *dirs, "--per_symbol", "60"])
    main(["run-all", *dirs])
    raw = next((tmp_path / "raw").glob("trades_*.json"))
    main(
        ["stream", "--input_dir", str(raw), "--available_now", "--out_path",
         str(tmp_path / "windows"), "--checkpoint_path", str(tmp_path / "check"),
         "--watermark_seconds", "1", "--window_seconds", "10"]
    )
    main(["stream-report", *dirs, "--symbols", "btcusd"])
    main(["dashboard", *dirs])
    text = capsys.readouterr().out
    assert "170 rows read" in text
    document = tmp_path / "dashboard" / "dashboard_data.json"  # a file
    assert json.loads(document.read_text())["summary"]["source"] == "spark_stream"
