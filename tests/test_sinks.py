"""Sinks round trip; a failing check fails a strict run."""

from __future__ import annotations

import json
from pathlib import Path

import pytest

from tenderlake.context import Lake
from tenderlake.plans import validation_queries as V
from tenderlake.sources import sinks

SF = "/root/testdata/sf0.001"


def test_tables_csv_json_and_report(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b", ["x", "y"]), (2, None, [])], "k long, t string, xs array<string>")
    done = sinks.write_tables({"some": df, "none": df.limit(0)}, str(tmp_path / "p"), {"some": ["k"]})
    assert done == ["some"] and not (tmp_path / "p" / "none").exists()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "p" / "some")).collect()) == [1, 2]
    sinks.write_csv(df, str(tmp_path / "c"), one_file=True)
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c")).orderBy("k").collect()
    assert [(r.k, r.t, json.loads(r.xs)) for r in back] == [("1", "a|b", ["x", "y"]), ("2", None, [])]
    sinks.write_json(df, str(tmp_path / "j"))
    lines = [json.loads(x) for f in Path(tmp_path / "j").glob("part-*") for x in f.read_text().splitlines()]
    assert sorted(x["k"] for x in lines) == [1, 2] and any(x["t"] is None for x in lines)
    sinks.write_report({"Some": df}, str(tmp_path / "r"))
    text = next(Path(tmp_path / "r").glob("part-*")).read_text()
    assert "## Some" in text and "a\\|b" in text
    with pytest.raises(ValueError):
        sinks.write_report({"Some": df}, str(tmp_path / "r2"), limit=1)


def test_strict_checks_raise(spark, tmp_path):
    lake = Lake.get(spark, SF)
    rows = V.run_checks(lake).collect()
    assert {r.suite for r in rows} == {"tables", "silver"}
    with pytest.raises(V.ChecksFailed):
        V.run_checks(lake, strict=True)  # the views hold negative values and short codes on purpose


def test_missing_table_fails(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "region.parquet"))
    got = {r.table_name: (r.n_rows, r.status) for r in V.check_tables(Lake(spark, str(tmp_path))).collect()}
    assert got["region"] == (3, "PASS") and got["orders"] == (None, "FAIL")


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from tenderlake import context
    bare = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None),
                           conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(ValueError):
        context.ensure_checkpoint_dir(bare)
