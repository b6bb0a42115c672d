"""Which measurements are averaged, summed and maximised, and their mergeable state.

Average, sum and maximum over any set of readings follow from three numbers per
measurement: the sum in fixed-point units, the count of values, and the maximum.
States of disjoint sets merge by adding and by taking the larger maximum, so they can be
aggregated before a shuffle and combined over blocks of time.
"""

from __future__ import annotations

from dataclasses import dataclass

from wxengine.functions.exact import OUTPUT_DECIMALS, present, rounded_ratio, to_units


@dataclass(frozen=True)
class Measures:
    averaged: tuple[str, ...] = ()
    summed: tuple[str, ...] = ()
    maxed: tuple[str, ...] = ()

    @property
    def added(self) -> tuple[str, ...]:
        """Measurements that need a sum and a count."""
        return tuple(dict.fromkeys(self.averaged + self.summed))

    @property
    def columns(self) -> tuple[str, ...]:
        """Every measurement read."""
        return tuple(dict.fromkeys(self.added + self.maxed))

    @property
    def state_columns(self) -> list[str]:
        return (
            [f"sum_{c}" for c in self.added]
            + [f"num_{c}" for c in self.added]
            + [f"max_{c}" for c in self.maxed]
        )

    def reading_state(self) -> list[str]:
        """State of a single reading, as select items."""
        units = {c: to_units(f"`{c}`") for c in self.added}
        present_ = {c: present(f"`{c}`") for c in self.columns}
        return (
            [f"{units[c]} AS `sum_{c}`" for c in self.added]
            + [f"IF({present_[c]} IS NULL, 0L, 1L) AS `num_{c}`" for c in self.added]
            + [f"{present_[c]} AS `max_{c}`" for c in self.maxed]
        )

    def merged_state(self, prefix: str = "", where: str | None = None, over: str = "") -> list[str]:
        """Aggregates that merge state rows, all of them or those that satisfy ``where``.

        ``over`` makes window aggregates of them.
        """
        items = []
        for name in self.state_columns:
            merge = "max" if name.startswith("max_") else "sum"
            value = f"IF({where}, `{name}`, NULL)" if where else f"`{name}`"
            items.append(f"{merge}({value}) {over} AS `{prefix}{name}`")
        return items

    def packed(self, prefix: str = "") -> str:
        """The state columns with this prefix as one struct."""
        return "struct(" + ", ".join(f"`{prefix}{n}` AS `{n}`" for n in self.state_columns) + ")"

    def joined(self, parts: list[str]) -> dict[str, str]:
        """State of disjoint parts, each given as a struct that may be NULL."""
        state = {}
        for name in self.state_columns:
            values = [f"{part}.`{name}`" for part in parts]
            if name.startswith("max_"):
                state[name] = f"greatest({', '.join(values)})" if len(values) > 1 else values[0]
            else:
                state[name] = " + ".join(f"coalesce({value}, 0L)" for value in values)
        return state

    def values(self, suffix: str, prefix: str = "") -> list[str]:
        """Result columns ``<measurement>_<suffix>_{average,sum,max}`` of a state.

        ``prefix`` leads the names of the state columns. A sum or average over NULLs only
        is NULL.
        """

        def total(c: str, count: str) -> str:
            ratio = rounded_ratio(f"`{prefix}sum_{c}`", count)
            return f"IF(`{prefix}num_{c}` > 0, {ratio}, NULL)"

        return (
            [f"{total(c, f'`{prefix}num_{c}`')} AS `{c}_{suffix}_average`" for c in self.averaged]
            + [f"{total(c, '1L')} AS `{c}_{suffix}_sum`" for c in self.summed]
            + [
                f"round(`{prefix}max_{c}`, {OUTPUT_DECIMALS}) AS `{c}_{suffix}_max`"
                for c in self.maxed
            ]
        )


# The measurements of each kind of rolling column.
WEATHER = Measures(
    averaged=("air_temperature", "air_pressure", "relative_humidity", "wind_speed", "precipitation"),
    summed=("precipitation", "sunshine_duration_10min"),
    maxed=(
        "air_temperature",
        "air_pressure",
        "relative_humidity",
        "wind_speed",
        "peak_gust_speed",
        "precipitation",
    ),
)
