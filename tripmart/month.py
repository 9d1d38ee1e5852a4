"""A calendar month, the unit of loading and partitioning."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True, order=True)
class Month:
    year: int
    number: int

    def __post_init__(self) -> None:
        if not 1 <= self.number <= 12:
            raise ValueError(f"{self.number} is no month")

    @classmethod
    def parse(cls, text: str) -> Month:
        found = re.fullmatch(r"(\d{4})-(\d{2})", text)
        if not found:
            raise ValueError(f"a month is written YYYY-MM, not {text!r}")
        return cls(int(found[1]), int(found[2]))

    @classmethod
    def of(cls, day: date) -> Month:
        return cls(day.year, day.month)

    def __str__(self) -> str:
        return f"{self.year:04d}-{self.number:02d}"

    @property
    def first(self) -> date:
        return date(self.year, self.number, 1)

    @property
    def following(self) -> Month:
        return Month(self.year + self.number // 12, self.number % 12 + 1)
