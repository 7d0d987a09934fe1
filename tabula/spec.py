"""Feature specification: which columns play which role."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FeatureSpec:
    """Column roles of a tabular dataset.

    ``derived`` lists columns the feature step adds (for example the cyclic
    month pair); they are appended after the id columns in the projection.
    """

    num_features: tuple[str, ...]
    cat_features: tuple[str, ...]
    target: str
    id_columns: tuple[str, ...] = ()
    derived: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        for name in ("num_features", "cat_features", "id_columns", "derived"):
            object.__setattr__(self, name, tuple(getattr(self, name)))

    @property
    def inputs(self) -> list[str]:
        """Model inputs: numeric then categorical (the scoring signature order)."""
        return [*self.num_features, *self.cat_features]

    @property
    def projection(self) -> list[str]:
        """Cleaned output order: cat + num + target + ids + derived."""
        return [*self.cat_features, *self.num_features, self.target, *self.id_columns, *self.derived]

    @property
    def source_columns(self) -> list[str]:
        """Columns that must exist in the raw input."""
        return [*self.cat_features, *self.num_features, self.target, *self.id_columns]


# The booking dataset's column roles (config of the original pipeline).
BOOKINGS = FeatureSpec(
    num_features=(
        "no_of_adults",
        "no_of_children",
        "no_of_weekend_nights",
        "no_of_week_nights",
        "lead_time",
        "repeated_guest",
        "no_of_previous_cancellations",
        "no_of_previous_bookings_not_canceled",
        "avg_price_per_room",
        "no_of_special_requests",
        "arrival_date",
        "arrival_year",
        "arrival_month",
    ),
    cat_features=(
        "type_of_meal_plan",
        "required_car_parking_space",
        "room_type_reserved",
        "market_segment_type",
    ),
    target="booking_status",
    id_columns=("Booking_ID",),
    derived=("month_as_sin", "month_as_cos"),
)
