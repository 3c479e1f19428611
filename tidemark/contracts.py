"""Versions of the rules that stamp every derived row, and the enumerations of the evidence model."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Contracts:
    """Passed explicitly into each derivation; a change of any of the first three opens a new comparison lineage."""

    parser: str = "1.1.0"
    contract: str = "1.0.0"
    text_contract: str = "1.0.0"
    qualification: str = "1.0.0"
    events: str = "1.0.0"

    @property
    def lineage(self) -> str:
        return f"{self.parser}|{self.contract}|{self.text_contract}"


# Fixed values of the evidence model.
AVAILABILITY = ("content_captured", "explicit_closure", "redirected_to_listing", "redirected_to_other_job", "not_found", "identity_mismatch", "access_control_challenge", "retrieval_failed")
UNCERTAIN = ("access_control_challenge", "retrieval_failed")
TERMINAL = ("explicit_closure", "redirected_to_listing", "not_found")
IDENTITY = ("match", "mismatch", "absent_on_page", "not_observed")
EVENT_KINDS = ("first_observed", "listed", "absent_qualified", "reappeared", "content_changed")
RUN_OUTCOMES = ("success", "partial", "failed", "aborted", "lock_contention")
SCHEDULED_KINDS = ("daily", "retry")
PRIORITIES = {"new": 10, "listed": 50, "historical_daily": 80, "historical_weekly": 90}
WEEKLY_AFTER = 3
