"""The parameters of a corpus. The three families of years are independent."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Bounds:
    """Year bounds, category ids and the year still being collected."""

    year_min: int
    year_max: int
    age_year_min: int
    age_year_max: int
    cohort_min: int
    cohort_citation_max: int
    partial_year: int
    strict_id: str
    broad_id: str

    @property
    def cohort_max(self) -> int:
        """The last cohort with one complete year after it."""
        return self.cohort_citation_max - 1


#: Of the TPC-H-like tables that stand in for a corpus.
STANDIN = Bounds(1995, 2001, 1995, 2001, 1995, 2001, 2001, "1-URGENT", "2-HIGH")
