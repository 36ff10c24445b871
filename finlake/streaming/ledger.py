"""Outputs of stream batches that are stored exactly once.

A stream repeats its last batch when it was stopped before that batch was committed. Here a
batch is first written in full to a staging folder and noted as staged; then its files are moved to
their targets under names made of the query, the batch and the staged name; then it is noted as
done. A repeated batch that is done adds nothing, one that was staged goes on
moving what is left, anything earlier is written anew. Each note is a new small file.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from finlake.sources import files

# Notes of older batches go: a stream repeats no batch but its last one.
KEPT = 100


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a streaming query keeps in its checkpoint, over all restarts."""
    return json.loads(files.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


@dataclass(frozen=True)
class Ledger:
    """The batches of one query, noted below ``folder``."""

    spark: SparkSession
    folder: str
    query: str

    def _note(self, batch_id: int, state: str) -> str:
        return f"{self.folder}/{self.query}/{batch_id:012d}.{state}"

    def noted(self, batch_id: int, state: str) -> dict | None:
        """What was noted of a batch; None if nothing, or if the note was cut."""
        path = self._note(batch_id, state)
        if not files.exists(self.spark, path):
            return None
        try:
            return json.loads(files.read_text(self.spark, path))
        except ValueError:
            return None

    def note(self, batch_id: int, state: str, counts: dict) -> None:
        files.write_text(self.spark, self._note(batch_id, state), json.dumps(counts))

    def done(self) -> dict[int, dict]:
        """Counts of the batches that are stored, of those still noted."""
        names = [n.split(".") for n in files.children(self.spark, f"{self.folder}/{self.query}")]
        return {int(n): self.noted(int(n), "done") or {} for n, state in names if state == "done"}

    def store_once(
        self, batch_id: int, write: Callable[[str], dict], targets: dict[str, str]
    ) -> dict:
        """Run ``write(staging folder)`` and move its subfolders' files to their targets, once.

        Returns the counts ``write`` returned, also for a batch that was stored before.
        """
        known = self.noted(batch_id, "done")
        if known is not None:
            return known
        staging = f"{self.folder}/staging/{self.query}-{batch_id:012d}"
        counts = self.noted(batch_id, "staged")
        if counts is None:
            if files.exists(self.spark, staging):
                files.remove(self.spark, staging)
            counts = write(staging)
            self.note(batch_id, "staged", counts)
        moves = []
        for below, target in targets.items():
            for name in files.walk(self.spark, f"{staging}/{below}"):
                folder, _, file = name.rpartition("/")
                if file.startswith("part-"):
                    own = f"part-{self.query[:8]}-{batch_id:012d}-{file.removeprefix('part-')}"
                    place = f"{target}/{folder}/{own}" if folder else f"{target}/{own}"
                    moves.append((f"{staging}/{below}/{name}", place))
        files.move_all(self.spark, moves)
        self.note(batch_id, "done", counts)
        files.remove(self.spark, staging)
        for state in ("staged", "done"):
            old = self._note(batch_id - KEPT, state)
            if batch_id >= KEPT and files.exists(self.spark, old):
                files.remove(self.spark, old)
        return counts
