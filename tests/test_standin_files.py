"""The stand-in's file writers: whole files, and no more than a batch in a task's memory."""

import csv
import glob
import io
import os
import zipfile

import pyarrow as pa
import pyarrow.fs  # noqa: F401
import pytest

from strata.plans.standin import _city_csv_writer

ROWS, BATCHES = 5_000, 40


class _Frame:
    columns = ["備註", "編號", "city"]


class _Task:
    def partitionId(self):
        return 3

    def taskAttemptId(self):
        return 9


def _batch(i):
    return pa.record_batch({"備註": [f'a, "{i}"\n' + "x" * 200] * ROWS, "編號": [f"{i}-{j}" for j in range(ROWS)],
                            "city": [("甲", "乙")[j % 2] for j in range(ROWS)]})


@pytest.mark.parametrize("as_zip", [False, True])
def test_a_task_holds_one_batch_and_writes_all(tmp_dir, monkeypatch, as_zip):
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: _Task())
    held, start, one = [], pa.total_allocated_bytes(), _batch(0).nbytes

    def batches():
        for i in range(BATCHES):
            held.append(pa.total_allocated_bytes() - start)
            yield _batch(i)

    _, write = _city_csv_writer(_Frame, tmp_dir, "city", as_zip)
    done = [r for b in write(batches()) for r in b.to_pylist()]
    assert max(held) < 5 * one  # all forty before
    if as_zip:
        assert [r["path"] for r in done] == [f"{tmp_dir}/part-00003.zip"]
        with zipfile.ZipFile(done[0]["path"]) as zf:
            texts = {n.removesuffix(".csv"): zf.read(n) for n in zf.namelist()}
    else:
        assert sorted(r["path"] for r in done) == sorted(f"{tmp_dir}/city={c}/part-00003.csv" for c in "甲乙")
        texts = {r["path"].split("city=")[1][0]: open(r["path"], "rb").read() for r in done}
    assert {r["rows"] for r in done} == {ROWS * BATCHES} and sorted(texts) == sorted("甲乙")
    for at, city in enumerate("甲乙"):
        assert texts[city].startswith("﻿".encode())
        head, alias, *rows = csv.reader(io.StringIO(texts[city].decode("utf-8-sig"), newline=""))
        assert head == ["備註", "編號"] and alias != head
        assert rows == [[f'a, "{i}"\n' + "x" * 200, f"{i}-{j}"] for i in range(BATCHES) for j in range(at, ROWS, 2)]
    assert not glob.glob(f"{tmp_dir}/**/*attempt*", recursive=True)


def test_a_store_that_cannot_append_gets_whole_files(tmp_dir, monkeypatch):
    """Other stores than the local one: one stream a file, moved into place when closed."""
    from strata.plans import standin

    monkeypatch.setattr("pyspark.TaskContext.get", lambda: _Task())
    monkeypatch.setattr(standin, "local_path", lambda p: None if p.startswith(tmp_dir) else p)
    monkeypatch.setattr(standin, "filesystem_of", lambda p: (pa.fs.LocalFileSystem(), p))
    for as_zip in (False, True):
        out = os.path.join(tmp_dir, str(as_zip))
        for city in "甲乙":
            os.makedirs(os.path.join(out, f"city={city}"))
        _, write = _city_csv_writer(_Frame, out, "city", as_zip)
        paths = [r["path"] for b in write(_batch(i) for i in range(3)) for r in b.to_pylist()]
        assert len(paths) == (1 if as_zip else 2) and all(map(os.path.isfile, paths))
        if as_zip:
            with zipfile.ZipFile(paths[0]) as zf:
                assert zf.testzip() is None and sorted(zf.namelist()) == ["乙.csv", "甲.csv"]
