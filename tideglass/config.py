"""Presets of the two jobs, and the places their tables live."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: texts that stored insights must carry verbatim -----------------------
DAILY_ACTIONS = (
    "Review channel changes and data freshness.",
    "Validate tagging and paid spend pacing.",
)
BACKFILL_ACTIONS = (
    "Validate GA4 → warehouse pipeline.",
    "Review paid campaigns & pacing.",
    "Assess promo/seasonality effects.",
)
# ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class MoverRules:
    """How a channel's change between two windows is scored and which rows are kept (K4, K5)."""

    size_weight: float
    rate_weight: float
    missing_rate: float | None        # rate used when the previous window has no revenue
    min_revenue: float | None         # smallest current revenue of a listed channel
    top_k: int = 8
    null_safe: bool = True            # one row per channel even when a key part is NULL


@dataclass(frozen=True)
class TextRules:
    """Limits of the stored narrative and of the text card."""

    max_lines: int
    max_len: int
    max_bullets: int
    max_actions: int
    fallback_actions: tuple[str, ...]
    headline_len: int | None = None   # headline cut on the card and in parsed responses
    response_len: int | None = None   # cut of each bullet/action of a parsed response
    marker_counts: bool = False       # max_len includes the bullet marker
    tidy_stored: bool = False         # store the cleaned lines rather than the given ones


@dataclass(frozen=True)
class Gate:
    """Which windows may go to the text generator."""

    min_revenue: float = 0.0
    min_orders: int = 0
    not_before: str | None = None     # ISO date; windows ending earlier use the template


@dataclass(frozen=True)
class Preset:
    name: str
    month: str                        # "rolling30" or "calendar"
    movers: MoverRules
    text: TextRules
    gate: Gate | None = None          # None: every window goes to the generator
    period_in_prompt: bool = False


DAILY = Preset(
    name="daily",
    month="rolling30",
    movers=MoverRules(size_weight=0.6, rate_weight=0.4, missing_rate=0.0, min_revenue=None),
    text=TextRules(
        max_lines=6, max_len=120, max_bullets=2, max_actions=2,
        fallback_actions=DAILY_ACTIONS, headline_len=90, response_len=110,
    ),
)

BACKFILL = Preset(
    name="backfill",
    month="calendar",
    movers=MoverRules(size_weight=0.7, rate_weight=0.3, missing_rate=None, min_revenue=50.0),
    text=TextRules(
        max_lines=9, max_len=240, max_bullets=4, max_actions=3,
        fallback_actions=BACKFILL_ACTIONS, marker_counts=True, tidy_stored=True,
    ),
    gate=Gate(),
    period_in_prompt=True,
)


def actions_from_setting(setting: str) -> tuple[str, ...]:
    """Fallback actions given as one text separated by semicolons."""
    return tuple(part.strip() for part in setting.split(";") if part.strip())


@dataclass(frozen=True)
class Tables:
    """Names or paths of the tables a job reads and writes.

    A value with a slash is a Parquet path; anything else is a catalog name, qualified with
    ``namespace`` when it has no dot.
    """

    purchases: str = "fct_purchases_daily"
    attribution: str = "fct_attribution_daily"
    dates: str = "dim_date"
    insights: str = "insights"
    purchase_totals: str = "run_purchases_daily"        # paths only, as they are kept by month
    attribution_totals: str = "run_attribution_daily"
    namespace: str | None = None

    def qualify(self, name: str) -> str:
        if "/" in name or "." in name or self.namespace is None:
            return name
        return f"{self.namespace}.{name}"
