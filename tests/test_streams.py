"""Streams: start at the latest file, bounded runs, crashes at every step of a batch."""

from __future__ import annotations

import os
import signal
import subprocess
import sys
import time

import pytest

from quaylake.schemas import SHIPMENT_SCHEMA
from quaylake.streaming import faults
from quaylake.streaming.ingest import event_source, has_committed, run_bounded, start_ingest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def add_files(folder, first, n, rows=3):
    """``n`` files of ``rows`` messages; each appears at once, as from a rename."""
    os.makedirs(folder, exist_ok=True)
    for i in range(first, first + n):
        lines = [f'{{"shipment_id": "SH-{i}-{k}", "weight": {k}.5}}' for k in range(rows)]
        with open(f"{folder}/.f{i}", "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")
        os.rename(f"{folder}/.f{i}", f"{folder}/f{i}")


def ids(files, rows=3):
    return sorted(f"SH-{i}-{k}" for i in files for k in range(rows))


def sunk(spark, tmp_dir):
    return sorted(r["shipment_id"] for r in spark.read.schema(SHIPMENT_SCHEMA).parquet(f"{tmp_dir}/out").collect())


def start(spark, tmp_dir, **options):
    options = {"path": f"{tmp_dir}/out", "available_now": True} | options
    return start_ingest(spark, f"{tmp_dir}/in", f"{tmp_dir}/ckpt", SHIPMENT_SCHEMA, **options)


def test_latest_passes_over_old_files_once(spark, tmp_dir):
    add_files(f"{tmp_dir}/in", 0, 40)
    done = run_bounded(start(spark, tmp_dir, starting_offsets="latest"))
    assert (done.batches, done.rows, done.reason) == (0, 0, "ended")
    add_files(f"{tmp_dir}/in", 40, 25)
    # one batch a file: the sink's manifest is compacted on the way
    done = run_bounded(start(spark, tmp_dir, starting_offsets="latest", max_per_trigger=1))
    assert (done.batches, done.rows) == (25, 75)
    assert sunk(spark, tmp_dir) == ids(range(40, 65))


def test_latest_opens_no_old_file(spark, tmp_dir):
    add_files(f"{tmp_dir}/in", 0, 2)
    os.chmod(f"{tmp_dir}/in/f0", 0)
    os.rename(f"{tmp_dir}/in/f1", f"{tmp_dir}/in/f1.gz")  # no gzip file: reading it fails
    run_bounded(start(spark, tmp_dir, starting_offsets="latest"))
    add_files(f"{tmp_dir}/in", 5, 1)
    run_bounded(start(spark, tmp_dir, starting_offsets="latest"))
    assert sunk(spark, tmp_dir) == ids([5])


def test_latest_after_a_first_start_that_never_committed(spark, tmp_dir):
    add_files(f"{tmp_dir}/in", 0, 3)
    run_bounded(start(spark, tmp_dir, starting_offsets="latest"))
    assert faults.lose_commit(spark, f"{tmp_dir}/ckpt") == 0 and not has_committed(spark, f"{tmp_dir}/ckpt")
    run_bounded(start(spark, tmp_dir, starting_offsets="latest"))
    add_files(f"{tmp_dir}/in", 3, 1)
    run_bounded(start(spark, tmp_dir, starting_offsets="latest"))
    assert sunk(spark, tmp_dir) == ids([3])


def test_latest_resumes_an_earlier_run(spark, tmp_dir):
    add_files(f"{tmp_dir}/in", 0, 2)
    run_bounded(start(spark, tmp_dir))
    add_files(f"{tmp_dir}/in", 2, 2)
    run_bounded(start(spark, tmp_dir, starting_offsets="latest"))
    assert sunk(spark, tmp_dir) == ids(range(4))


def test_unsupported_starts_are_refused(spark, tmp_dir):
    for wrong in ("latest", '{"0": 1}'):
        with pytest.raises(ValueError):
            event_source(spark, fmt="text", path=tmp_dir, starting_offsets=wrong)
    with pytest.raises(ValueError):
        start(spark, tmp_dir, starting_offsets="first")


def test_bounded_by_batches_rows_and_time(spark, tmp_dir):
    add_files(f"{tmp_dir}/in", 0, 12)
    live = {"available_now": False, "trigger": "0 seconds", "max_per_trigger": 1}
    done = run_bounded(start(spark, tmp_dir, **live), timeout_s=120, max_batches=2)
    assert done.reason == "batches" and done.batches >= 2
    done = run_bounded(start(spark, tmp_dir, **live), timeout_s=120, max_rows=4)
    assert done.reason == "rows" and done.rows >= 4
    begin = time.monotonic()
    done = run_bounded(start(spark, tmp_dir, **live), timeout_s=4)
    assert done.reason == "timeout" and time.monotonic() - begin < 60
    run_bounded(start(spark, tmp_dir))
    assert sunk(spark, tmp_dir) == ids(range(12))


def test_bounded_run_raises_the_error_of_the_query(spark, tmp_dir):
    add_files(f"{tmp_dir}/in", 0, 1)
    os.rename(f"{tmp_dir}/in/f0", f"{tmp_dir}/in/f0.gz")
    with pytest.raises(Exception, match="(?i)fail|gzip"):
        run_bounded(start(spark, tmp_dir), timeout_s=60)


@pytest.mark.parametrize("lose", ["commit", "manifest"])
def test_restart_after_each_step_of_a_batch(spark, tmp_dir, lose):
    for round_ in range(3):
        add_files(f"{tmp_dir}/in", 4 * round_, 4)
        run_bounded(start(spark, tmp_dir, max_per_trigger=2))
        if lose == "commit":
            faults.lose_commit(spark, f"{tmp_dir}/ckpt")
        else:
            faults.lose_manifest(spark, f"{tmp_dir}/ckpt", f"{tmp_dir}/out")
            assert len(sunk(spark, tmp_dir)) < 12 * (round_ + 1)
        run_bounded(start(spark, tmp_dir))
        assert sunk(spark, tmp_dir) == ids(range(4 * round_ + 4))


_CHILD = """
import sys
sys.path.insert(0, {repo!r})
from quaylake.schemas import SHIPMENT_SCHEMA
from quaylake.session import local_session
from quaylake.streaming.ingest import start_ingest
spark = local_session(master="local[2]", shuffle_partitions=2)
query = start_ingest(spark, {base!r} + "/in", {base!r} + "/ckpt", SHIPMENT_SCHEMA, path={base!r} + "/out",
                     max_per_trigger=1, trigger="0 seconds")
query.awaitTermination()
"""


def test_a_killed_process_loses_and_repeats_nothing(spark, tmp_dir):
    add_files(f"{tmp_dir}/in", 0, 60)
    child = subprocess.Popen(
        [sys.executable, "-c", _CHILD.format(repo=REPO, base=tmp_dir)],
        stdout=subprocess.DEVNULL,
        stderr=subprocess.DEVNULL,
        start_new_session=True,
    )
    try:
        commits = f"{tmp_dir}/ckpt/commits"
        limit = time.monotonic() + 120
        while time.monotonic() < limit and not (os.path.isdir(commits) and len(os.listdir(commits)) > 8):
            time.sleep(0.02)
    finally:
        os.killpg(child.pid, signal.SIGKILL)  # Python and the JVM that it started
        child.wait()
    assert os.path.isdir(commits)
    run_bounded(start(spark, tmp_dir, max_per_trigger=7))
    assert sunk(spark, tmp_dir) == ids(range(60))
