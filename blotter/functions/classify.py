"""Rules that sort offenses into groups and categories.

The four notions of "violent" below differ on purpose: each belongs to its own
product, and none may be merged with another.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F

OTHER = "Other"

# Labels of the violent / non-violent rollup.
VIOLENT = "Violent Crime"
NON_VIOLENT = "Non-violent Crime"

# Offenses that count as violent in Chicago's rollup (exact names,
# upper case), and the offense-group prefix that does in DC's.
CHICAGO_VIOLENT_OFFENSES = (
    "HOMICIDE",
    "BATTERY",
    "ASSAULT",
    "ROBBERY",
    "CRIM SEXUAL ASSAULT",
    "SEX OFFENSE",
)
DC_VIOLENT_GROUP_PREFIX = "VIOLENT"


def offense_in(names: Sequence[str]) -> Callable[[], Column]:
    """Rule: the offense is one of `names`, whatever its case."""
    return lambda: F.upper("offense_type").isin(*[n.upper() for n in names])


def group_starts_with(prefix: str) -> Callable[[], Column]:
    """Rule: the source's own offense group starts with `prefix`, whatever its case."""
    return lambda: F.upper("offense_group").startswith(prefix.upper())


@dataclass(frozen=True)
class CategoryRule:
    """A category and the lower-case offense texts that belong to it.

    A text belongs if it has every part in `has` and none in `lacks`, or, for a
    rule with `names`, if it is one of them.
    """

    category: str
    has: tuple[str, ...] = ()
    lacks: tuple[str, ...] = ()
    names: tuple[str, ...] = ()

    def matches(self, text: Column) -> Column:
        if self.names:
            return text.isin(*self.names)
        tests = [F.contains(text, F.lit(p)) for p in self.has]
        tests += [~F.contains(text, F.lit(p)) for p in self.lacks]
        return reduce(and_, tests)


# Unified categories per city; the first matching rule wins.
CHICAGO_CATEGORIES = (
    CategoryRule("Theft", has=("theft",), lacks=("motor",)),
    CategoryRule("Motor Vehicle Theft", has=("motor", "theft")),
    CategoryRule("Violent Crime", names=("battery", "assault", "criminal damage")),
    CategoryRule("Robbery", names=("robbery",)),
    CategoryRule("Burglary", names=("burglary",)),
)
DC_CATEGORIES = (
    CategoryRule("Theft", has=("theft",), lacks=("motor",)),
    CategoryRule("Motor Vehicle Theft", has=("motor vehicle theft",)),
    CategoryRule(
        "Violent Crime", names=("assault w/dangerous weapon", "robbery", "homicide")
    ),
    CategoryRule("Burglary", names=("burglary",)),
    CategoryRule("Sex Crime", names=("sex abuse",)),
)


def category(offense: Column, rules: Sequence[CategoryRule]) -> Column:
    """The category of an offense text; null, empty and unmatched text is Other."""
    text = F.lower(offense)
    unmatched = F.lit(OTHER)
    return reduce(
        lambda rest, rule: F.when(rule.matches(text), F.lit(rule.category)).otherwise(rest),
        reversed(rules),
        unmatched,
    )


def violent_label(is_violent: Column) -> Column:
    return F.when(is_violent, F.lit(VIOLENT)).otherwise(F.lit(NON_VIOLENT))
