"""Time travel, history and snapshots over a log of row versions.

A log is an ordinary frame: payload columns plus ``_row_id``, ``_commit_id`` and
``_op`` (``I`` first version, ``U`` new image, ``D`` deleted). The commits are a
second frame with one row per commit and what was recorded when it was made:
time, operation, parent, record counts. How the two are stored is the caller's
business; these functions only read them.

Reading a state aggregates the changed rows alone: untouched first versions
come from an anti join, and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaylake.schemas import LOG_COMMIT_ID, LOG_OP, LOG_ROW_ID

# Operation names of commits.
OP_APPEND = "append"
OP_OVERWRITE = "overwrite"
OP_DELETE = "delete"

_LOG = (LOG_ROW_ID, LOG_COMMIT_ID, LOG_OP)


def payload(log: DataFrame) -> list[str]:
    return [c for c in log.columns if c not in _LOG]


# ------------------------------------------------------------------------ reading
def current(log: DataFrame, with_ids: bool = False) -> DataFrame:
    """The state after all commits of ``log``."""
    columns = payload(log)
    inserted = log.where(F.col(LOG_OP) == "I")
    image = F.struct(*[F.col(f"`{c}`") for c in columns], LOG_OP)
    changed = log.where(F.col(LOG_OP) != "I").groupBy(LOG_ROW_ID)
    latest = changed.agg(F.max_by(image, LOG_COMMIT_ID).alias("_v"))
    untouched = inserted.join(latest.select(LOG_ROW_ID), LOG_ROW_ID, "left_anti")
    images = latest.where(F.col("_v")[LOG_OP] == "U").select(LOG_ROW_ID, "_v.*")
    names = ([LOG_ROW_ID] if with_ids else []) + columns
    quoted = [F.col(f"`{c}`") for c in names]
    return untouched.select(*quoted).unionByName(images.select(*quoted))


def as_of(log: DataFrame, commits: DataFrame, commit_id: int, with_ids: bool = False) -> DataFrame:
    """The state after commit ``commit_id``; an id that no commit has is refused."""
    if commits.where(F.col("commit_id") == commit_id).isEmpty():
        raise ValueError(f"no commit {commit_id}")
    return current(log.where(F.col(LOG_COMMIT_ID) <= commit_id), with_ids)


def first_commit(commits: DataFrame, at_least: int = 2) -> int:
    """Id of the earliest commit by time (ties by id); fewer than ``at_least``
    commits are refused. One aggregated row answers both."""
    n, first = commits.agg(F.count(F.lit(1)), F.min_by("commit_id", F.struct("committed_at", "commit_id"))).first()
    if n < at_least:
        raise RuntimeError(f"time travel needs at least {at_least} commits")
    return first


def history(commits: DataFrame) -> DataFrame:
    """made_current_at, snapshot_id, parent_id, is_current_ancestor."""
    return commits.select(
        F.col("committed_at").alias("made_current_at"),
        F.col("commit_id").alias("snapshot_id"),
        "parent_id",
        F.lit(True).alias("is_current_ancestor"),
    )


_COUNTS = ("added_records", "updated_records", "deleted_records", "total_records")


def snapshots(commits: DataFrame, flat: bool = False) -> DataFrame:
    """committed_at, snapshot_id, operation and the recorded counts, as columns
    (``flat``) or as a ``summary`` map."""
    head = ["committed_at", F.col("commit_id").alias("snapshot_id"), "operation"]
    if flat:
        return commits.select(*head, *_COUNTS)
    pairs = [x for c in _COUNTS for x in (F.lit(c.replace("_", "-")), F.col(c).cast("string"))]
    return commits.select(*head, F.create_map(*pairs).alias("summary"))


def snapshot_summary(commits: DataFrame) -> DataFrame:
    """committed_at, snapshot_id, operation, and one row per ``key`` of the summary with
    its ``value`` (text)."""
    return snapshots(commits).select("committed_at", "snapshot_id", "operation", F.explode("summary").alias("key", "value"))


def recorded(log: DataFrame, committed_at: Column) -> DataFrame:
    """The commits frame of a log: one row per commit, counted with map-side
    aggregation; ``committed_at`` is a column over ``commit_id``. Parent and
    running total come from windows over these rows, one per commit."""
    count = lambda op: F.count_if(F.col(LOG_OP) == op)
    per_commit = log.groupBy(F.col(LOG_COMMIT_ID).alias("commit_id")).agg(
        count("I").alias("added_records"), count("U").alias("updated_records"), count("D").alias("deleted_records")
    )
    kept = (F.col("updated_records") == 0) & (F.col("deleted_records") == 0)
    gone = (F.col("updated_records") == 0) & (F.col("added_records") == 0)
    operation = F.when(kept, OP_APPEND).when(gone, OP_DELETE).otherwise(OP_OVERWRITE)
    in_order = Window.orderBy("commit_id")
    total = F.sum(F.col("added_records") - F.col("deleted_records")).over(in_order)
    return per_commit.select(
        "commit_id",
        committed_at.alias("committed_at"),
        operation.alias("operation"),
        F.lag("commit_id").over(in_order).alias("parent_id"),
        *_COUNTS[:3],
        total.alias("total_records"),
    )
