"""Runs that advance state: several tables change, and a mark moves on, together or not at all.

A ledger is a folder on the shared file system to which small records are appended; no
record is ever changed.  Run number n leaves up to three:

- `n.intent`: who began, and from which state.  It is created only if it does not exist, so
  of two writers one is refused.
- `n.decided`: `prepared`, with the partitions of each table that lie staged beside
  the ledger and the state to come, or `aborted`.  There is one such name, so a run
  can't be both.
- `n.done`: all partitions are in their tables, and the state counts.

After `prepared` the run only goes forward: each staged partition takes the place of the
table's, partition by partition, and a partition that is no longer staged has been
moved.  So whoever repeats it after a crash, at any step, ends with the same tables.
Before `prepared` nothing but the staging has been written, and it is thrown away.

A run that is open may be another writer's that is still at work.  begin() refuses then,
unless the owner is the same (the scheduler repeats a failed run under its name) or
take_over says that the other one is dead.  A writer that was taken over finds its run
decided and is refused when it comes to commit.

A reader of a table may see a partition missing while it is replaced, as with any
overwrite of directories; each single partition is old or new as a whole.  On an object
store, where creating a file is not exclusive or renaming is a copy, a table format is
the better choice.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import Folder
from ..sources.writers import write_partitioned
from .windows import advance_window


class Busy(RuntimeError):
    """Another writer's run is open, or this one was taken over."""


class Ledger:
    """The runs of one job; folder: on the same file system as its tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = Folder(spark, folder)

    def _records(self) -> dict[int, dict[str, Any]]:
        out: dict[int, dict[str, Any]] = {}
        for name in self.folder.names():
            number, _, kind = name.partition(".")
            if number.isdigit() and kind in ("intent", "decided", "done"):
                text = self.folder.read(name)
                try:
                    out.setdefault(int(number), {})[kind] = json.loads(text)
                except ValueError:  # a writer died while it wrote
                    out.setdefault(int(number), {})[kind] = {}
        return out

    def _last(self, records: Mapping[int, dict[str, Any]]) -> dict[str, Any]:
        done = [n for n, r in records.items() if "done" in r]
        return records[max(done)]["decided"]["state"] if done else {}

    def state(self) -> dict[str, Any]:
        """The state of the last run that is done; empty before the first."""
        return self._last(self._records())

    def history(self) -> list[tuple[int, str, str]]:
        """Number, owner and outcome (done, aborted, prepared, open) of each run."""
        out = []
        for n, r in sorted(self._records().items()):
            decided = r.get("decided")
            outcome = "done" if "done" in r else decided.get("outcome", "open") if decided is not None else "open"
            out.append((n, r.get("intent", {}).get("owner", ""), outcome))
        return out

    def begin(self, owner: str, *, take_over: bool = False) -> Run:
        """A new run, after a run that was left open has been finished or thrown away."""
        records = self._records()
        last = max(records, default=0)
        open_run = records.get(last, {})
        if last and "done" not in open_run and open_run.get("decided", {}).get("outcome") != "aborted":
            holder = open_run.get("intent", {}).get("owner")
            if holder != owner and not take_over:
                raise Busy(f"run {last} of {holder!r} is open")
            left = Run(self, last, {})
            if "decided" not in open_run:
                left._decide({"outcome": "aborted"})
                records = self._records()
            decided = records[last]["decided"]
            if decided.get("outcome") == "prepared":
                left._finish(decided)
                records = self._records()
            else:
                if not decided:
                    raise Busy(f"run {last}'s decision cannot be read; delete it if its writer is dead")
                left._clear()
        number = last + 1
        state = self._last(records)
        if not self.folder.create(f"{number:012d}.intent", json.dumps({"owner": owner, "state": state})):
            raise Busy(f"run {number} was begun by another writer")
        return Run(self, number, state)


class Run:
    """One open run.  state: what the last done run left."""

    def __init__(self, ledger: Ledger, number: int, state: dict[str, Any]):
        self.ledger, self.number, self.state = ledger, number, state
        self._tables: dict[str, int] = {}
        self._name = f"{number:012d}"

    def _decide(self, decision: dict[str, Any]) -> bool:
        return self.ledger.folder.create(f"{self._name}.decided", json.dumps(decision))

    def _clear(self) -> None:
        self.ledger.folder.delete(f"staged-{self._name}")

    def write(self, df: DataFrame, path: str, partition: Sequence[str], **options: Any) -> None:
        """Stage the partitions of a table that df has rows for; they replace the table's at commit.  Options are write_partitioned's."""
        staged = f"staged-{self._name}/{len(self._tables)}"
        self._tables[path] = len(partition)
        write_partitioned(df, f"{self.ledger.folder.path}/{staged}", partition, **options)

    def staged(self, path: str) -> DataFrame:
        """What was staged for a table, to be read by a later step of the run."""
        k = list(self._tables).index(path)
        return self.ledger.spark.read.parquet(f"{self.ledger.folder.path}/staged-{self._name}/{k}")

    def commit(self, **state: Any) -> None:
        """Put all that was staged into its tables; state: what changes in the state, as JSON."""
        tables = [{"path": path, "partitions": self.ledger.folder.partitions(f"staged-{self._name}/{k}", depth)} for k, (path, depth) in enumerate(self._tables.items())]
        decision = {"outcome": "prepared", "tables": tables, "state": self.state | state}
        if not self._decide(decision):
            raise Busy(f"run {self.number} was taken over")
        self._finish(decision)

    def _finish(self, decision: dict[str, Any]) -> None:
        folder = self.ledger.folder
        for k, table in enumerate(decision["tables"]):
            live = Folder(self.ledger.spark, table["path"])
            for part in table["partitions"]:
                staged = f"staged-{self._name}/{k}/{part}"
                if folder.exists(staged):
                    live.delete(part)
                    if not folder.move(staged, f"{table['path']}/{part}") and folder.exists(staged):
                        raise OSError(f"{staged} could not be moved")
        folder.create(f"{self._name}.done", json.dumps({}))
        self._clear()

    def abort(self) -> None:
        """Throw away what was staged; the state stays as it is."""
        if not self._decide({"outcome": "aborted"}):
            raise Busy(f"run {self.number} was taken over")
        self._clear()


def load_new_runs(ledger: Ledger, owner: str, read: Callable[[str | None], tuple[DataFrame, str | None]], steps: Callable[[Run, DataFrame], None], *, take_over: bool = False, **state: Any) -> bool:
    """One scheduled run: read what is new after the mark, let `steps` stage tables from it, and commit them with the new mark.

    read: the mark to rows and the new mark (readers.read_new_runs).  False if there
    was nothing new.  If a step fails the run is thrown away, and the mark stays.
    """
    run = ledger.begin(owner, take_over=take_over)
    try:
        rows, mark = read(run.state.get("mark"))
        if mark == run.state.get("mark"):
            run.abort()
            return False
        steps(run, rows)
    except Exception:
        run.abort()
        raise
    run.commit(mark=mark, **state)
    return True


def load_window(ledger: Ledger, owner: str, today: date, days: int, steps: Callable[[Run, date, date], None], *, take_over: bool = False, early_if_ahead: bool = True) -> tuple[date, date] | None:
    """The next window of days (windows.advance_window) after the ledger's, loaded by `steps`; None where it is too early."""
    run = ledger.begin(owner, take_over=take_over)
    try:
        window = advance_window(run.state.get("window_end"), today, days, early_if_ahead=early_if_ahead)
        if window is None:
            run.abort()
            return None
        steps(run, *window)
    except Exception:
        run.abort()
        raise
    run.commit(window_end=window[1].isoformat())
    return window


def old_runs(folder: Folder, *, before: str, mark: str | None, run: str = "run_dt") -> list[str]:
    """Run directories before a day (as text, like the names) that have been read: none is after the mark."""
    named = [(n, n.split("=", 1)[1]) for n in folder.names() if n.startswith(run + "=")]
    return [n for n, v in named if v < before and mark is not None and v <= mark]


def drop_old_runs(spark: SparkSession, root: str, *, before: str, ledger: Ledger, run: str = "run_dt", dry_run: bool = True, tasks: int = 8) -> list[str]:
    """Run directories that are old enough and read, by the ledger's mark; they are deleted, by tasks, only with dry_run=False.

    Directories are named in the driver, and deleted by executors, so that many
    files on a store without directories are no work of the driver.
    """
    found = old_runs(Folder(spark, root), before=before, mark=ledger.state().get("mark"), run=run)
    if dry_run or not found:
        return found
    from pyarrow import RecordBatch, array, fs

    def delete(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, at = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
                if store.get_file_info(at).type != fs.FileType.NotFound:  # a task that is run twice
                    store.delete_dir(at)
            yield RecordBatch.from_arrays([array([batch.num_rows])], names=["n"])

    paths = spark.createDataFrame([(f"{root.rstrip('/')}/{n}",) for n in found], "path string")
    paths.repartition(min(tasks, len(found))).mapInArrow(delete, "n long").agg(F.sum("n")).collect()
    return found
