"""The ledger of a run: rows and flags of every step, counted while the run's one write is under way."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from labtrail.functions import triggered
from labtrail.operators.runlog import append_log, step, step_rows


class Ledger:
    """Points of a plan whose rows and flags are counted as the rows pass, in the order they were set.

    No point costs a job. The counts are there once an action has run the plan; `steps` waits for it. A point may lie
    below joins and aggregates that read the rows more than once: each reading counts all rows by itself. Points that
    Spark leaves out, because nothing can come out of them, count 0. Tasks of a stage that runs anew after an
    executor was lost may count rows twice, so the ledger is for the log; results come from the data.
    """

    def __init__(self, project: str, stage: str, batch_ts: str | None = None):
        self.project, self.stage, self.batch_ts = project, stage, batch_ts
        self._run = uuid.uuid4().hex[:12]
        self._points: list[dict] = []

    def watch(
        self, df: DataFrame, name: str, flags: Sequence[str] = (), note: Callable[[dict], str] | str = "",
        after: str | None = None, by: tuple[str, Sequence[str]] | None = None,
    ) -> DataFrame:
        """Count the rows that pass here and their raised flags, as the step `name`.

        after: the step whose rows this one read; without it, it read what it wrote.
        by: a column and its values; the rows of each value are counted as well, under the value.
        note: a text, or what makes one of the counts.
        """
        watched = Observation(f"{self._run}-{len(self._points)}")
        counts = [F.count_if(F.coalesce(triggered(F.col(f"`{f}`")), F.lit(False))).alias(f) for f in flags]
        if by:
            counts += [F.count_if(F.col(by[0]).eqNullSafe(v)).alias(v) for v in by[1]]
        self._points.append(
            {"name": name, "watched": watched, "flags": list(flags), "after": after, "note": note}
        )
        return df.observe(watched, F.count(F.lit(1)).alias("rows"), *counts)

    def filtered(self, df: DataFrame, name: str, keep: Callable[[DataFrame], DataFrame], after: str) -> DataFrame:
        """`keep` applied to rows that the step `after` has counted, with the rows it leaves."""
        return self.watch(keep(df), name, note=lambda c: f"{c['read'] - c['rows']} registros descartados", after=after)

    def counts(self) -> dict[str, dict[str, int]]:
        """What each step counted: `rows`, and its flags and values. Waits for the action."""
        return {p["name"]: {"rows": 0, **p["watched"].get} for p in self._points}

    def steps(self) -> list[dict]:
        """The step records, in order. A filter that leaves nothing is a warning, and so is a raised flag."""
        counted, out = self.counts(), []
        for p in self._points:
            mine = counted[p["name"]]
            read = counted[p["after"]]["rows"] if p["after"] else mine["rows"]
            note = p["note"]({**mine, "read": read}) if callable(p["note"]) else p["note"]
            emptied = p["after"] is not None and not mine["rows"]
            flags = {f: mine.get(f, 0) for f in p["flags"]}
            out.append(step(p["name"], read, mine["rows"], flags, note, status="Aviso" if emptied else None))
        return out

    def append(self, spark: SparkSession, path: str, more: Sequence[dict] = (), strict: bool = False) -> bool:
        """Append the steps, and `more` after them, to the log table; see `append_log`."""
        rows = step_rows(spark, [*self.steps(), *more], self.project, self.stage, self.batch_ts)
        return append_log(rows, path, strict=strict)
