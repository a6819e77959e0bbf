"""Running catalog steps in order, each on the stored result of the one before."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rosterforge.schema import EVIDENCE, NOTES, cell
from rosterforge.sources.catalog import restore, snapshot

Step = tuple[str, Callable[[DataFrame], DataFrame]]


@dataclass
class Outcome:
    """What ran, with counts from each step's own pass, and what failed."""

    table: DataFrame
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    failed: str | None = None
    error: str | None = None


def selected(steps: list[Step], skip: tuple[str, ...] = (), only: tuple[str, ...] = ()) -> list[Step]:
    """Steps by name, in their order; unknown names are an error."""
    names = [n for n, _ in steps]
    if unknown := sorted({*skip, *only} - {*names}):
        raise ValueError(f"unknown steps: {', '.join(unknown)}")
    return [s for s in steps if s[0] not in skip and (not only or s[0] in only)]


def run_steps(table: DataFrame, steps: list[Step], root: str, run: str, stop: bool = False) -> Outcome:
    """Runs the steps.  Each result is written under ``root`` and read again; a step that
    fails leaves the table as before it, and the rest runs unless ``stop``."""
    out = Outcome(snapshot(table, root, "start", run))
    last = "start"
    for name, step in steps:
        seen = Observation(name)
        try:
            df = step(out.table).observe(
                seen, F.count(F.lit(1)).alias("total"), F.count_if(cell(EVIDENCE) != "").alias("with_evidence"), F.count_if(cell(NOTES) != "").alias("with_notes")
            )
            out.table = snapshot(df, root, name, run)
            out.counts[name] = dict(seen.get)
            last = name
        except Exception as e:  # a failed step must not lose the table
            out.table, out.failed, out.error = restore(table.sparkSession, root, last, run), name, str(e)
            if stop:
                break
    return out
