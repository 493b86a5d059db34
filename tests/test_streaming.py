import csv

from tessera.streaming import ingest_landing


def _write(path, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["ID", "Case Number", "Block"])
        w.writerows(rows)


def test_incremental_ingest_is_exactly_once(spark, tmp_path):
    landing, target, ckpt = tmp_path / "landing", tmp_path / "bronze", tmp_path / "ckpt"
    landing.mkdir()
    _write(landing / "a.csv", [["1", "HX1", "A ST"], ["2", "HX2", '1 "Q" ST\nAPT 2']])
    ingest_landing(spark, str(landing), str(target), "test", checkpoint=str(ckpt))
    first = spark.read.parquet(str(target))
    assert first.columns == ["id", "case_number", "block", "_ingested_at", "_source"]
    assert first.count() == 2
    # a re-run with nothing new adds nothing; a new file is added once
    ingest_landing(spark, str(landing), str(target), "test", checkpoint=str(ckpt))
    assert spark.read.parquet(str(target)).count() == 2
    _write(landing / "b.csv", [["3", "HX3", "C ST"]])
    ingest_landing(spark, str(landing), str(target), "test", checkpoint=str(ckpt))
    rows = spark.read.parquet(str(target)).collect()
    assert sorted(r.id for r in rows) == ["1", "2", "3"]
    assert [r.block for r in rows if r.id == "2"] == ['1 "Q" ST\nAPT 2']


def test_cli_ingest(spark, tmp_path):
    from tessera.__main__ import main
    landing, target = tmp_path / "l", tmp_path / "t"
    landing.mkdir()
    _write(landing / "a.csv", [["7", "HX7", "G ST"]])
    main(["ingest", "--landing", str(landing), "--target", str(target), "--source", "cli",
          "--checkpoint", str(tmp_path / "ck")])
    assert [r.id for r in spark.read.parquet(str(target)).collect()] == ["7"]


def test_cli_build(spark, landing, capsys):
    from tessera.__main__ import main
    main(["build", "--crimes", landing["crimes"], "--socioeconomic", landing["socioeconomic"],
          "--iucr-codes", landing["iucr_codes"], "--no-comments"])
    printed = capsys.readouterr().out.split()
    assert "gold.fact_crime" in printed and "silver.clean_audit" in printed
    assert spark.table("gold.fact_crime").count() == 33


APP = """
import sys
from pyspark.sql import SparkSession
from tessera.streaming import ingest_landing
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[3]).getOrCreate())
ingest_landing(spark, sys.argv[1], sys.argv[2], "test")
print("rows", spark.read.parquet(sys.argv[2]).count())
"""


def test_two_applications_share_the_default_checkpoint(tmp_path):
    import os
    import subprocess
    import sys
    landing, target = tmp_path / "landing", tmp_path / "bronze"
    landing.mkdir()
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    env.pop("PYSPARK_GATEWAY_PORT", None)
    seen = []
    for name, ids in (("a", "12"), ("b", "34")):
        _write(landing / f"{name}.csv", [[i, f"HX{i}", "A ST"] for i in ids])
        out = subprocess.run([sys.executable, "-c", APP, str(landing), str(target), str(tmp_path / "shared")],
                             env=env, capture_output=True, text=True, timeout=180)
        seen += [ln for ln in out.stdout.splitlines() if ln.startswith("rows")]
    assert seen == ["rows 2", "rows 4"]


def test_landed_file_with_another_header_is_an_error(spark, tmp_path):
    import pytest
    _write(tmp_path / "a.csv", [["1", "HX1", "A ST"]])
    (tmp_path / "b.csv").write_text("Block,ID,Case Number\nB ST,2,HX2\n")
    with pytest.raises(ValueError, match="b.csv"):
        ingest_landing(spark, str(tmp_path), str(tmp_path / "t"), "test")


def test_a_file_of_another_header_that_lands_later_adds_nothing(spark, tmp_path):
    import pytest
    landing, target = tmp_path / "l", str(tmp_path / "t")
    landing.mkdir()
    _write(landing / "a.csv", [["1", "HX1", "A ST"]])
    ingest_landing(spark, str(landing), target, "test")
    (landing / "b.csv").write_text("Block,ID,Case Number\nB ST,2,HX2\n")
    with pytest.raises(ValueError, match="b.csv"):
        ingest_landing(spark, str(landing), target, "test")
    assert spark.read.parquet(target).count() == 1
    _write(landing / "b.csv", [["2", "HX2", "B ST"]])
    ingest_landing(spark, str(landing), target, "test")
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == ["1", "2"]


def test_headers_of_ingested_files_are_not_read_again(spark, tmp_path, monkeypatch):
    from tessera.streaming import ingest
    read = []
    plain = ingest.headers
    monkeypatch.setattr(ingest, "headers", lambda *a, **k: read.append(k.get("files")) or plain(*a, **k))
    for i in range(5):
        _write(tmp_path / f"{i}.csv", [[str(i), "HX", "A ST"]])
        ingest_landing(spark, str(tmp_path), str(tmp_path / "t"), "test")
    assert all(f is not None and len(f) == 1 for f in read)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5
