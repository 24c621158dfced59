"""Run parameters for the reconciliation report.

Every date bound is computed here, in Python, once per run, and enters the
Spark plans as a literal, so Catalyst can fold it and push it to the scan.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass, field

UTC = dt.timezone.utc


@dataclass(frozen=True)
class Labels:
    """Output labels of the report.

    Fixed values: these strings must equal the reference report's values so
    that a user switching over sees the same sheet content.
    """

    # Source status -> report status label.
    status_canceled: str = "anulowana"
    status_active: str = "aktywna"
    # Plan interval -> package type label.
    interval_year: str = "roczny"
    interval_month: str = "miesięczny"
    # Derived invoice columns.
    cannot_determine: str = "Nie można określić"
    paid_flag: str = "paid"
    # Month names, January first.
    month_names: tuple[str, ...] = (
        "styczeń", "luty", "marzec", "kwiecień", "maj", "czerwiec",
        "lipiec", "sierpień", "wrzesień", "październik", "listopad", "grudzień",
    )
    # Lifecycle status.
    lifecycle_unspecified: str = "Nieokreślony"
    lifecycle_cancelled_active: str = "Anulowana (aktywna)"
    lifecycle_active: str = "Aktywna"
    lifecycle_cancelled: str = "Anulowana"
    # Package name of CRM-only contracts.
    crm_package: str = "UMOWA TRADYCYJNA"
    # Invoice placeholders for missing keys.
    no_description: str = "No description"
    no_plan_active: str = "No plan active info"
    no_plan_interval: str = "No plan interval info"
    no_payment_intent: str = "No payment intent"


# Raw values of the billing and booking sources.
RAW_STATUS_ACTIVE = "active"
RAW_STATUS_CANCELED = "canceled"
RAW_INTERVAL_YEAR = "year"
RAW_INTERVAL_MONTH = "month"
INVOICE_PAID = "paid"


def _clamped(year: int, month: int, day: int) -> dt.date:
    """``date(year, month, day)`` with ``day`` clamped to the month's last day."""
    return dt.date(year, month, min(day, calendar.monthrange(year, month)[1]))


def _next_month(year: int, month: int) -> dt.date:
    return dt.date(year + month // 12, month % 12 + 1, 1)


@dataclass(frozen=True)
class ReportParams:
    """Parameters of one report run (defaults follow the reference's parameter file)."""

    # invoice status in the chosen month
    chosen_month: int = 7
    chosen_year: int = 2025
    chosen_yearly_start_year: int = 2024
    # paid in the two-month window
    window_month1: int = 7
    window_month2: int = 8
    window_year: int = 2025
    window_yearly_start_year: int = 2024
    # explicit two-month window (D5): overrides window_month1/2 + window_year for
    # monthly plans, e.g. a December-January window across the year boundary
    window_start: dt.date | None = None
    window_end: dt.date | None = None
    # month of the last paid invoice
    current_year: int = 2025
    last_yearly_start_year: int = 2024
    # invoice scan lower bound, an instant (UTC midnight in the reference)
    invoice_since: dt.datetime = dt.datetime(2024, 7, 1, tzinfo=UTC)
    # filters (tenant-specific lists are always passed in, never defaulted)
    excluded_plan_ids: tuple[int, ...] = ()
    excluded_user_ids: tuple[int, ...] = ()
    kept_statuses: tuple[str, ...] = (RAW_STATUS_ACTIVE, RAW_STATUS_CANCELED)
    # timestamps: fixed shift applied after dropping the zone
    clock_shift_hours: int = 2
    # "now" of the lifecycle status; None means the query's current local time
    as_of: dt.datetime | None = None
    # zone in which invoice epochs become calendar dates
    local_timezone: str = "UTC"
    # last day of the yearly chosen-month window and of the two-month window;
    # both are clamped to the month's length (the reference fails on e.g. 30 Feb)
    yearly_end_day: int = 30
    window_end_day: int = 31
    labels: Labels = field(default_factory=Labels)
    # CRM branch
    crm_target_status: str | None = None
    dedupe_crm_tasks: bool = False

    # ---- construction from a settings file ------------------------------------
    @classmethod
    def from_config(cls, cfg: dict, **overrides) -> "ReportParams":
        """Build from the settings-file layout used by the reference's job.

        ``date_settings`` gives the three date windows, ``stripe_fetch_settings
        .filter_date`` the invoice lower bound (UTC midnight). Tenant values
        (exclusions, CRM status) come in as ``overrides``.
        """
        ds = cfg.get("date_settings", {})
        chosen = ds.get("invoice_status_chosen_month", {})
        window = ds.get("invoice_status_last_2_months", {})
        last = ds.get("last_invoice_month", {})
        since = cfg.get("stripe_fetch_settings", {}).get("filter_date")
        kw: dict = {}
        pairs = [(chosen, "month", "chosen_month"), (chosen, "year", "chosen_year"),
                 (chosen, "yearly_subscription_start_year", "chosen_yearly_start_year"),
                 (window, "month1", "window_month1"), (window, "month2", "window_month2"),
                 (window, "year", "window_year"),
                 (window, "yearly_subscription_start_year", "window_yearly_start_year"),
                 (last, "current_year", "current_year"),
                 (last, "yearly_subscription_start_year", "last_yearly_start_year")]
        for section, key, name in pairs:
            if key in section:
                kw[name] = int(section[key])
        if since:
            kw["invoice_since"] = dt.datetime(int(since["year"]), int(since["month"]),
                                              int(since["day"]), tzinfo=UTC)
        kw.update(overrides)
        return cls(**kw)

    # ---- derived date bounds -------------------------------------------------
    def chosen_monthly_range(self) -> tuple[dt.date, dt.date]:
        """Half-open [first day, first day of next month) of the chosen month."""
        return (dt.date(self.chosen_year, self.chosen_month, 1),
                _next_month(self.chosen_year, self.chosen_month))

    def chosen_yearly_range(self) -> tuple[dt.date, dt.date]:
        """Inclusive [start-year/month/1, year/month/end-day]."""
        return (dt.date(self.chosen_yearly_start_year, self.chosen_month, 1),
                _clamped(self.chosen_year, self.chosen_month, self.yearly_end_day))

    def window_monthly_range(self) -> tuple[dt.date, dt.date]:
        """Inclusive [year/month1/1, year/month2/end-day]; empty when month1 > month2."""
        if self.window_start is not None and self.window_end is not None:
            return self.window_start, self.window_end
        return (dt.date(self.window_year, self.window_month1, 1),
                _clamped(self.window_year, self.window_month2, self.window_end_day))

    def window_yearly_range(self) -> tuple[dt.date, dt.date]:
        return (dt.date(self.window_yearly_start_year, self.window_month2, 1),
                _clamped(self.window_year, self.window_month2, self.window_end_day))

    def last_monthly_range(self) -> tuple[dt.date, dt.date]:
        """Inclusive calendar year ``current_year``."""
        return dt.date(self.current_year, 1, 1), dt.date(self.current_year, 12, 31)

    def last_yearly_start(self) -> dt.date:
        return dt.date(self.last_yearly_start_year, 1, 1)

    def invoice_since_epoch(self) -> int:
        ts = self.invoice_since
        if ts.tzinfo is None:
            ts = ts.replace(tzinfo=UTC)
        return int(ts.timestamp())
