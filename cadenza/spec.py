"""Shape of a panel: which columns identify a series, order it and hold its value."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class PanelSpec:
    """Column names and cadence of a panel.

    ``segment`` is the number of consecutive steps one task may hold of one
    series: ordered work is partitioned by (series, segment), never by series
    alone, so a single dominant key spreads over the cluster.

    ``dense`` promises that each series has a row for every step between its
    first and last one, as what ``densify`` returns has; positions then follow
    from the time. Without the promise row positions are counted first, so
    gaps never change which rows are neighbours.
    """

    key: str = "spot_num"
    time: str = "datetime"
    value: str = "vol"
    step_seconds: int = 3600
    segment: int = 4096
    dense: bool = False
    group: tuple[str, ...] = ()

    @property
    def series(self) -> list[str]:
        """Columns which identify one series."""
        return [*self.group, self.key]

    def but(self, **changes) -> PanelSpec:
        return replace(self, **changes)


HOURLY = PanelSpec()
GRID = PanelSpec(dense=True)
DAILY = PanelSpec(step_seconds=86400)
