"""Parameters of one run."""

from __future__ import annotations

from dataclasses import dataclass, field

from tallyworks import constants as c


def shift_period(period: int, months: int) -> int:
    """yyyymm moved by a number of months."""
    index = (period // 100) * 12 + period % 100 - 1 + months
    return (index // 12) * 100 + index % 12 + 1


@dataclass(frozen=True)
class SurveySettings:
    """The revision window and the code lists a run works with."""

    current_period: int
    revision_window: int
    state: str = "frozen"
    components: tuple[int, ...] = c.COMPONENTS
    total: int = c.TOTAL_QUESTION
    unprocessed: tuple[int, ...] = c.UNPROCESSED_QUESTIONS
    bands: dict[int, tuple[int, int]] = field(default_factory=lambda: dict(c.IMPUTATION_BANDS))
    clear_statuses: tuple[str, ...] = c.CLEAR_STATUSES
    nil_statuses: tuple[str, ...] = c.NIL_STATUSES
    non_response_statuses: tuple[str, ...] = c.NON_RESPONSE_STATUSES
    error_codes: tuple[int, ...] = c.ERROR_STATUS_CODES
    classifications: tuple[int, ...] = c.OUTPUT_CLASSIFICATIONS
    non_sampled_strata: tuple[int, ...] = c.NON_SAMPLED_STRATA
    census_cells: tuple[int, ...] = ()
    link_filtered: bool = False

    def __post_init__(self):
        if self.state not in ("live", "frozen"):
            raise ValueError(f"{self.state} is not an accepted state, use live or frozen")
        if self.revision_window < 1:
            raise ValueError("revision_window is at least one month")

    @property
    def backdata_period(self) -> int:
        return shift_period(self.current_period, -self.revision_window)

    @property
    def periods(self) -> list[int]:
        """Published months, oldest first."""
        return [shift_period(self.backdata_period, k)
                for k in range(1, self.revision_window + 1)]

    @property
    def in_thousands(self) -> tuple[int, ...]:
        return (*self.components, self.total)
