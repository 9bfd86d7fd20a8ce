"""The jobs: against SQL, on awkward rows, run again, broken off, and over input that grows."""

import hashlib
import json
import math
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import jobs.corpus_volumes as cv
import jobs.point_clouds as pc
from jobs import queries

DATA = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]
CV, PC = (json.loads(m.DEFAULT.read_text()) for m in (cv, pc))


def canon(v):
    v = None if isinstance(v, float) and math.isnan(v) else v
    return f"{v:.6g}" if isinstance(v, float) else str(v)


def rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted(tuple(map(canon, r)) for r in df.select(*cols).collect())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = queries.QUERIES[name](spark, DATA)
    rel = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(got.columns)
    assert rows(got, cols) == sorted(tuple(map(canon, r)) for r in rel.fetchall())


def volumes(spark, path, data):
    spark.createDataFrame(data, "vec_id long, embedding array<float>, status string").coalesce(2).write.mode("overwrite").parquet(str(path))
    return str(path)


def test_point_clouds_of_awkward_rows(spark, tmp_path):
    ramp = [float(i) for i in range(8)]
    good = [(i, [x * (i + 1) for x in ramp], "clash") for i in range(5)]
    bad = [(None, ramp, "x"), (10, None, "x"), (11, [1.0, None, *ramp[2:]], "x"), (12, [math.nan, *ramp[1:]], "x"), (13, [math.inf, *ramp[1:]], "x"), (14, ramp[:7], "x"), (15, [], "x"), (2, [x + 50 for x in ramp], "x"), (3, good[3][1], "x")]
    cfg = {**PC, "batch_size": 2, "n_points": 3}
    source, target = volumes(spark, tmp_path / "in", good + bad), str(tmp_path / "out")
    done = pc.run(spark, source, target, cfg)
    assert (done["rows"], done["volumes"], done["shape"]) == (14, 5, (2, 2, 2))
    assert done["verdicts"] == 5 * len(cfg["transfer_functions"])
    first = rows(pc.output(spark, target))
    # The rows that repeat or come later make no difference: of id 2 the values that sort first count.
    assert pc.run(spark, volumes(spark, tmp_path / "in2", good), str(tmp_path / "out2"), cfg)["points"] == done["points"]
    assert rows(pc.output(spark, str(tmp_path / "out2"))) == first
    assert pc.run(spark, source, target, cfg) == done and rows(pc.output(spark, target)) == first
    # One batch again, with another limit: its partitions change, the others stay.
    strict = {**cfg, "qc": {**cfg["qc"], "min_mean_intensity": 2.0}}
    pc.run(spark, source, target, strict, batches=["batch_0001"])
    now = pc.output(spark, target)
    assert now.where("batch_id = 'batch_0001' and (status = 'pass' or point_id is not null)").isEmpty()
    assert rows(now.where("batch_id <> 'batch_0001'")) == [r for r in first if "batch_0001" not in r]
    pc.run(spark, source, target, cfg, batches=["batch_0001"])
    assert rows(pc.output(spark, target)) == first
    none = pc.run(spark, volumes(spark, tmp_path / "in3", []), str(tmp_path / "out3"), cfg)
    assert (none["volumes"], none["points"], none["verdicts"]) == (0, 0, 0) and pc.output(spark, str(tmp_path / "out3")).isEmpty()
    with pytest.raises(ValueError):
        pc.run(spark, volumes(spark, tmp_path / "in4", [(1, ramp, ""), (2, [1.0], "")]), str(tmp_path / "out4"), cfg)


def test_batches_of_many_volumes(spark, tmp_path):
    """Each volume is in the batch of its place in the hashed order, also where ids lie in several parts that are sampled."""
    ids = [(i * 7919) % 4001 for i in range(4000)]
    source, target = volumes(spark, tmp_path / "in", [(i, [0.0, float(i + 1)] * 4, "") for i in ids]), str(tmp_path / "out")
    whole = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(whole, "false")  # small parts would become one
    try:
        pc.run(spark, source, target, {**PC, "n_points": 1})
    finally:
        spark.conf.unset(whole)
    order = sorted(ids, key=lambda i: (hashlib.md5(f"{PC['seed']}:{i}".encode()).hexdigest(), i))
    want = {(v, f"batch_{i // PC['batch_size'] + 1:04d}") for i, v in enumerate(order)}
    assert {tuple(r) for r in pc.output(spark, target).select("volume_id", "batch_id").collect()} == want


def cell(text):
    ws = [w for w in text.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    n = len(ws)
    return (10 * len(set(ws)) // n if n else 0, min(15, sum(map(len, ws)) // n) if n else 0, min(31, len(text).bit_length()))


TEXTS = [("a bb ccc", "en"), ("a a a a", "en"), (None, "en"), ("", None), ("   \n\t", ""), ("中文 字 😀", "zh/x"), ("x" * 300_000, "en"), ("w " * 50_000, "de"), ("a bb ccc", "en")]


def counts(texts):
    out = {}
    for t, lang in texts:
        k = (lang or "und", *cell(t or ""))
        out[k] = out.get(k, 0) + 1
    return out


def put(spark, folder, name, texts):
    part = folder.parent / f"part-{name}"
    spark.createDataFrame([(i, t, g, "clash") for i, (t, g) in enumerate(texts)], "doc_id long, text string, lang string, n string").coalesce(1).write.parquet(str(part))
    folder.mkdir(exist_ok=True)
    for f in part.glob("*.parquet"):
        shutil.copy(f, folder / f"{name}-{f.name}")


def as_it_stands(spark, target):
    df = cv.output(spark, target)
    return {(r["volume_id"], r["z"], r["y"], r["x"]): r["n"] for r in df.collect()}, rows(df)


def test_corpus_volumes_grow(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    put(spark, source, "one", TEXTS[:4])
    assert cv.run(spark, str(source), target, CV)["documents"] == 4
    assert as_it_stands(spark, target)[0] == counts(TEXTS[:4])
    put(spark, source, "two", TEXTS[4:])
    put(spark, source, "none", [])
    done = cv.run(spark, str(source), target, CV)
    assert (done["documents"], done["counted"]) == (len(TEXTS) - 4, len(TEXTS))  # only what is new
    cells, all_rows = as_it_stands(spark, target)
    assert cells == counts(TEXTS)
    # Without new files, and from the start in one run, it is the same.
    assert cv.run(spark, str(source), target, CV)["documents"] == 0
    assert as_it_stands(spark, target)[1] == all_rows
    cv.run(spark, str(source), str(tmp_path / "other"), {**CV, "max_files": 1})
    assert as_it_stands(spark, str(tmp_path / "other"))[1] == all_rows


def test_corpus_volumes_broken_off(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "in", str(tmp_path / "out")
    for i in range(3):
        put(spark, source, f"f{i}", TEXTS[3 * i : 3 * i + 3])
    real, calls = cv.count, []

    def fails_once(docs):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(docs)

    monkeypatch.setattr(cv, "count", fails_once)
    with pytest.raises(Exception, match="lost"):
        cv.run(spark, str(source), target, {**CV, "max_files": 1})
    monkeypatch.setattr(cv, "count", real)
    monkeypatch.setattr(cv, "build", lambda *a: 1 / 0)  # counted, but the volumes are not written
    with pytest.raises(ZeroDivisionError):
        cv.run(spark, str(source), target, {**CV, "max_files": 1})
    monkeypatch.undo()
    assert cv.run(spark, str(source), target, CV)["counted"] == len(TEXTS)
    assert as_it_stands(spark, target)[0] == counts(TEXTS)


def test_corpus_volumes_of_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert cv.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), CV) == {"batches": 0, "documents": 0, "volumes": 0, "cells": 0, "counted": 0}
    assert cv.output(spark, str(tmp_path / "out")).isEmpty()


@pytest.mark.parametrize("name,table", [("point_clouds", "embeddings"), ("corpus_volumes", "documents")])
def test_command_line(tmp_path, name, table):
    out = f"{tmp_path}/out"
    done = subprocess.run([sys.executable, "-m", f"jobs.{name}", "--input", f"{DATA}/{table}.parquet", "--output", out], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert json.loads(done.stdout.splitlines()[-1])["volumes"] > 0
    assert "INFO:jobs" in done.stderr and list(Path(out).rglob("*.parquet"))


def test_jobs_need_no_corpus_operators():
    for f in (ROOT / "jobs").glob("*.py"):
        assert "llm" not in f.read_text() and "corpus_pipeline" not in f.read_text()
