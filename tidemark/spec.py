"""Which columns of a feed play which role."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FeedSpec:
    """Roles of a feed's columns.

    ``tie_break`` decides between versions of one key with the same event time, so
    that a load gives the same rows every time. With none given the attributes
    themselves decide, which leaves only fully equal rows undecided.
    ``surrogate`` and ``fact_key`` name the numbers given to keys and to facts.
    ``fact_days`` is how many days of events share a partition of the facts: 1 where a
    batch brings a day or two, more for a feed with little data on each of many days.
    """

    key: str = "code"
    event_time: str = "last_modified_t"
    attributes: tuple[str, ...] = (
        "product_name",
        "brands",
        "nutrition_grades",
        "categories_tags_en",
    )
    tie_break: tuple[str, ...] = ()
    surrogate: str = "product_key"
    fact_key: str = "product_update_key"
    fact_days: int = 1

    @property
    def target_time(self) -> str:
        """Name of the event time in the dimension and the facts."""
        return f"source_{self.event_time}"

    @property
    def order_columns(self) -> tuple[str, ...]:
        return (self.event_time, *(self.tie_break or self.attributes))

    def newest(self, *extra: Column) -> Column:
        """Sort key whose maximum is the newest version; null times come last.

        ``extra`` is compared after the event time and before the tie-break.
        """
        first, *rest = self.order_columns
        return F.struct(F.col(first), *extra, *[F.col(name) for name in rest])


PRODUCTS = FeedSpec()
