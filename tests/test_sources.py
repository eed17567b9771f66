"""Loading and validation cases."""

import os
import tempfile

import pytest

from kvadrat import schema as S
from kvadrat.sources import listings as L

ROW = ["Stan", "Opis, sa zarezom", "55", "120000", "Beograd", "Vracar", "Ulica", "CG", "2", "Da", "3/5", "1990", "https://x/1"]


def _csv(rows, header=S.RAW_COLUMNS):
    d = tempfile.mkdtemp(prefix="kv-test-", dir="/tmp")
    path = os.path.join(d, "l.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join('"' + str(v).replace('"', '""') + '"' for v in r) + "\n")
    return path


def test_load_valid_and_multiline(spark):
    rows = [ROW, ROW[:1] + ['Dva\nreda "citat"'] + ROW[2:], ROW[:4] + ["NA"] + ROW[5:]]
    df = L.load_listings(spark, _csv(rows), min_rows=1)
    out = df.orderBy("_ord").collect()
    assert len(out) == 3
    assert out[1]["description"] == 'Dva\nreda "citat"'
    assert out[2]["city"] is None
    assert out[0]["area_m2"] == 55.0


def test_missing_columns(spark):
    path = _csv([ROW[:12]], header=S.RAW_COLUMNS[:12])
    with pytest.raises(L.ListingsValidationError, match="Missing required columns: url"):
        L.load_listings(spark, path, min_rows=1)


def test_min_rows(spark):
    with pytest.raises(L.ListingsValidationError, match="at least 5 rows"):
        L.load_listings(spark, _csv([ROW]), min_rows=5)


def test_unparseable_numbers(spark):
    with pytest.raises(L.ListingsValidationError, match="area_m2"):
        L.load_listings(spark, _csv([ROW[:2] + ["pedeset"] + ROW[3:]]), min_rows=1)


def test_missing_path(spark):
    with pytest.raises(FileNotFoundError):
        L.load_listings(spark, "/tmp/does-not-exist-kvadrat/x.csv")


def test_model_store_round_trip(spark, sf_dir):
    from kvadrat.operators import modeling as M
    from kvadrat.plans import frames
    from kvadrat.sources import sinks

    model_df = frames.model(spark, sf_dir)
    res = M.train_candidates(model_df, [("Baseline", "dummy_median"), ("LR", "linear_regression")], sizes=M.SMALL)
    out = tempfile.mkdtemp(prefix="kv-store-", dir="/tmp")
    sinks.save_models(spark, res.models, res.best_model_name, out)
    name, best = sinks.load_best(spark, out)
    assert name == res.best_model_name
    reg = sinks.load_registry(spark, out)
    assert list(reg) == ["Baseline", "LR"]
    with pytest.raises(FileNotFoundError):
        sinks.load_best(spark, tempfile.mkdtemp(dir="/tmp"))


def test_train_and_save_writes_metadata(spark, sf_dir):
    from kvadrat.operators import modeling as M
    from kvadrat.plans import frames, training

    out = tempfile.mkdtemp(prefix="kv-train-", dir="/tmp")
    specs = [("Baseline", "dummy_median"), ("Ridge", "ridge_regression")]
    res = training.train_and_save(spark, frames.raw(spark, sf_dir), out, specs, sizes=M.SMALL)
    meta = res["metadata_dir"]
    run = spark.read.json(f"{meta}/run").first()
    assert run["best_model_name"] in {"Baseline", "Ridge"}
    assert run["train_rows"] > 0 and run["test_rows"] > 0
    assert spark.read.json(f"{meta}/metrics").count() == 2
    summary = spark.read.json(f"{meta}/cleaning_summary").first()
    assert summary["raw_rows"] >= summary["cleaned_rows"]
    assert spark.read.json(f"{meta}/regions_by_city").count() > 0
