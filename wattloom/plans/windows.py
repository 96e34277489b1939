"""Which days a scheduled run covers."""

from __future__ import annotations

from datetime import date, timedelta


def advance_window(last_end: str | None, today: date, days: int, *, early_if_ahead: bool = True) -> tuple[date, date] | None:
    """The next window, from the last one's end to `days` later, both included; None to skip.

    Without a last end: the `days` days before the last `days`.  Two rules decide
    what is too early: the end lies less than `days` after today (early_if_ahead),
    or today lies less than `days` after the end.
    """
    span = timedelta(days=days)
    if not (last_end or "").strip():
        return today - 2 * span, today - span
    first = date.fromisoformat(last_end)
    last = first + span
    gap = last - today if early_if_ahead else today - last
    return None if gap < span else (first, last)
