"""Parameters of the batch reports."""

from __future__ import annotations

import json
from dataclasses import dataclass, field


def _or_none(value):
    return None if value is None or value == "" else value


def _name_list(value) -> tuple[str, ...]:
    """Names from a JSON list or from a comma-separated, optionally quoted, text."""
    if value is None:
        return ()
    parts = value.split(",") if isinstance(value, str) else value
    names = (str(p).strip().strip("'\"") for p in parts)
    return tuple(n for n in names if n)


@dataclass(frozen=True)
class Condition:
    """Which actions to report on; a field left at None or empty selects all."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    target_page_flow: tuple[int, ...] = ()
    #: The text it was read from, which reports store as given.
    given: str | None = field(default=None, compare=False)

    @classmethod
    def from_json(cls, text: str) -> Condition:
        raw = json.loads(text)
        ages = [_or_none(raw.get(key)) for key in ("startAge", "endAge")]
        flow = raw.get("targetPageFlow") or ()
        pages = flow.split(",") if isinstance(flow, str) else flow
        return cls(
            start_date=_or_none(raw.get("startDate")),
            end_date=_or_none(raw.get("endDate")),
            start_age=None if ages[0] is None else int(ages[0]),
            end_age=None if ages[1] is None else int(ages[1]),
            professionals=_name_list(raw.get("professionals")),
            target_page_flow=tuple(int(p) for p in pages),
            given=text,
        )

    def to_json(self) -> str:
        """The text as given, or else one written from the fields."""
        if self.given is not None:
            return self.given

        def text(value):
            return "" if value is None else str(value)

        return json.dumps(
            {
                "startDate": text(self.start_date),
                "endDate": text(self.end_date),
                "startAge": text(self.start_age),
                "endAge": text(self.end_age),
                "professionals": ",".join(self.professionals),
                "targetPageFlow": ",".join(str(p) for p in self.target_page_flow),
            },
            ensure_ascii=False,
            separators=(",", ":"),
        )


def flow_pairs(flow: tuple[int, ...]) -> list[tuple[int, int]]:
    """Adjacent pages of a target flow, each pair once."""
    return list(dict.fromkeys(zip(flow, flow[1:])))
