"""What a fit has done so far, kept in the shared folder so that another driver can go on from there."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from tabweave.storage import get_text, names_in, put_text, remove

_RECORD = "committed-{:08d}.json"


@dataclass
class FitState:
    """All that decides how a fit goes on, apart from the parameters."""

    epoch: int = 0
    best_epoch: int = 0
    best_loss: float | None = None
    waited: int = 0
    stopped: bool = False
    history: list[dict[str, float]] = field(default_factory=list)


class Journal:
    """One record per finished epoch and the parameters of the last and the best one, under ``path``.

    An epoch counts once its record is there, which is put in place as a whole after its parameters are. What an
    interrupted epoch left behind is overwritten by the next attempt.
    """

    def __init__(self, spark: SparkSession, path: str, settings: dict):
        # As read back: tuples become lists.
        self.spark, self.path, self.settings = spark, path.rstrip("/"), json.loads(json.dumps(settings))

    def place(self, epoch: int) -> str:
        """Where the parameters of an epoch lie."""
        return f"{self.path}/epoch={epoch}"

    def clear(self, epoch: int) -> str:
        """An empty place for the parameters of an epoch."""
        remove(self.spark, self.place(epoch))
        return self.place(epoch)

    def load(self) -> FitState:
        """The state after the last committed epoch; that of a new fit if there is none."""
        records = [n for n in names_in(self.spark, self.path) if n.startswith("committed-") and n.endswith(".json")]
        if not records:
            return FitState()
        record = json.loads(get_text(self.spark, f"{self.path}/{records[-1]}"))
        if record["settings"] != self.settings:
            changed = sorted(k for k in self.settings if record["settings"].get(k) != self.settings[k])
            raise ValueError(f"{self.path} holds a fit with other settings: {', '.join(changed)}")
        return FitState(**record["state"])

    def commit(self, state: FitState) -> None:
        """Make an epoch count, then drop parameters that are neither the last nor the best."""
        record = json.dumps({"settings": self.settings, "state": asdict(state)})
        put_text(self.spark, f"{self.path}/{_RECORD.format(state.epoch)}", record)
        wanted = {f"epoch={state.epoch}", f"epoch={state.best_epoch}"}
        for name in names_in(self.spark, self.path):
            if name.startswith("epoch=") and name not in wanted:
                remove(self.spark, f"{self.path}/{name}")
