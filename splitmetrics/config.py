"""Settings of one experiment analysis."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# The five summary metrics, in report order.
METRICS = (
    "CR",
    "booking_per_buyer",
    "gm_per_buyer",
    "booking_per_visitor",
    "gm_per_visitor",
)

# Visitor dimensions, and the subset reported when none are named.
ALL_DIMENSIONS = ("is_new", "region", "website_country", "channel_group", "initial_device_type")
RUN_DIMENSIONS = ("is_new", "region", "initial_device_type", "channel_group")

# Platform types with a distribution check of their own.
SITE_TEST = 1
EMAIL_TEST = 2

ALTERNATE_CONTROL = "AC"


@dataclass(frozen=True)
class ExperimentConfig:
    """One experiment: which cell is the control, who counts, and how outliers are cut.

    ``tails`` maps a metric to 0 (two-tailed, the default), -1 or +1 (one-tailed).
    The three cut-offs are quantile levels; while any is ``None`` a full run stops
    after the cap sweeps, which exist to help choose them.
    """

    test_id: int
    test_type_id: int
    control_id: int
    gm_low: float | None = None
    gm_high: float | None = None
    bookings_high: float | None = None
    rerun_attribution: bool = True
    days_to_order: int = 7
    drop_reorders: bool = False
    contact_days: int = 7
    cohort_dimensions: tuple[str, ...] = RUN_DIMENSIONS
    days_to_consider: int = 7
    max_hopper_level: int = 0
    exposed_only: bool = True
    visitor_constraint: str | None = None
    tails: dict[str, int] = field(default_factory=dict)
    credit_hopper_level: int = 1
    contact_hopper_level: int = 0
    z_bound: float = 1.96
    demo_mode: bool = False

    def __post_init__(self):
        unknown = set(self.tails) - set(METRICS)
        if unknown:
            raise ValueError(f"no such metric: {sorted(unknown)}")
        if not set(self.tails.values()) <= {-1, 0, 1}:
            raise ValueError("a tail is -1, 0 or 1")
        for name in ("gm_low", "gm_high", "bookings_high"):
            level = getattr(self, name)
            if level is not None and not 0 <= level <= 1:
                raise ValueError(f"{name} must be a quantile level in [0, 1]")
        if None not in (self.gm_low, self.gm_high) and self.gm_low > self.gm_high:
            raise ValueError("gm_low lies above gm_high")

    @classmethod
    def standalone(cls, test_id: int = 0, test_type_id: int = 1, control_id: int = 0, **changes):
        """Defaults of a single analysis, as opposed to those of a full run."""
        base = cls(
            test_id=test_id,
            test_type_id=test_type_id,
            control_id=control_id,
            gm_low=0.001,
            gm_high=0.99,
            bookings_high=0.99,
            cohort_dimensions=ALL_DIMENSIONS,
            exposed_only=False,
        )
        return replace(base, **changes)

    @property
    def has_cutoffs(self) -> bool:
        return None not in (self.gm_low, self.gm_high, self.bookings_high)

    def tail(self, metric: str) -> int:
        return self.tails.get(metric, 0)
