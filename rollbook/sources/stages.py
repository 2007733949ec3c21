"""Named frames of a run, each computed and staged once, whoever asks for it."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from rollbook.sources.tables import release, stage

Cut = Callable[[DataFrame], DataFrame]


@dataclass
class Stages:
    """A registry from (name, parameters) to the staged frame, shared by the jobs of a run and released at its end.

    The parameters are what the frame depends on besides its name, such as the as-of date; frames of other parameters are others.
    """
    write: Cut = stage
    held: dict[tuple, DataFrame] = field(default_factory=dict)

    def once(self, name: str, build: Callable[[], DataFrame], **params) -> DataFrame:
        key = (name, *sorted(params.items()))
        if key not in self.held:
            self.held[key] = self.write(build())
        return self.held[key]

    def cut(self, name: str, **params) -> Cut:
        """``once`` in the form that the plans take: a function of the frame to stage."""
        return lambda df: self.once(name, lambda: df, **params)

    def release(self) -> None:
        """Delete the files. Frames that read them must have been written by then."""
        frames, self.held = list(self.held.values()), {}
        release(*[f for f in frames if hasattr(f, "_staged")])

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *exc) -> None:
        self.release()
