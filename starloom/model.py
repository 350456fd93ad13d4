"""What a warehouse table means: grain, parents, measures, constraints."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Parent:
    """One foreign key: source columns, the dimension's columns, its surrogate.

    The same dimension may appear under several roles.
    """

    role: str
    dimension: str
    on: dict[str, str]
    key: str
    result: str


@dataclass(frozen=True)
class Dimension:
    """A dimension built from a source frame.

    ``columns`` maps source columns to the dimension's names and holds the
    business key under its new name. ``types`` declares some of them as char(n),
    varchar(n) or a narrower number, not NULL unless ``null`` follows.
    """

    name: str
    key: str
    business_key: list[str]
    columns: dict[str, str]
    parents: tuple[Parent, ...] = ()
    types: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Level:
    """One level of a hierarchy that a flat dimension holds in its columns.

    ``columns`` name a member within the level above, ``attributes`` describe it;
    both map the flat columns to the level's own.
    """

    name: str
    key: str
    columns: dict[str, str]
    attributes: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Measure:
    name: str
    column: str
    additive: bool = True


@dataclass(frozen=True)
class Ratio:
    """Never stored or summed: sums of both parts are divided at report grain.

    A ratio without ``denominator`` divides by the number of rows.
    """

    name: str
    numerator: str
    denominator: str | None = None


@dataclass(frozen=True)
class Fact:
    """A fact at its declared grain; ``columns`` are kept as they are."""

    name: str
    grain: list[str]
    parents: tuple[Parent, ...]
    columns: list[str]
    measures: tuple[Measure, ...] = ()
    ratios: tuple[Ratio, ...] = ()
    narrow: tuple[str, ...] = ()


@dataclass(frozen=True)
class History:
    """A type-2 dimension: what is tracked, what is only copied along."""

    key: str = "passenger_key"
    business_key: str = "passenger_id"
    tracked: tuple[str, ...] = ("frequent_flyer_tier", "home_airport_key")
    copied: tuple[str, ...] = ("passenger_name",)
    first_seen: str = "signup_date"
    validity: tuple[str, str] = field(default=("effective_from", "effective_to"))
    current: str = "is_current"

    @property
    def feed_columns(self) -> list[str]:
        return [self.business_key, *self.copied, *self.tracked]

    @property
    def columns(self) -> list[str]:
        return [
            self.key,
            *self.feed_columns,
            self.first_seen,
            self.current,
            *self.validity,
        ]
