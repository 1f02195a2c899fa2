"""Column masking and per-persona views."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The mask kinds policies refer to.
HASH = "MASK_HASH"
SHOW_LAST_4 = "MASK_SHOW_LAST_4"
REDACT = "MASK"
NULLIFY = "MASK_NULL"


def _last_four(value: Column) -> Column:
    hidden = F.length(value) - 4
    return F.when(hidden <= 0, F.repeat(F.lit("x"), F.length(value))).otherwise(
        F.concat(F.repeat(F.lit("x"), hidden), F.right(value, F.lit(4)))
    )


_MASKS = {
    HASH: lambda c: F.sha2(c, 256),
    SHOW_LAST_4: _last_four,
    REDACT: F.mask,
    NULLIFY: lambda c: F.lit(None).cast("string"),
}


def masked(value: Column, kind: str) -> Column:
    return _MASKS[kind](value.cast("string"))


def mask(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Mask columns: {column: kind}."""
    return df.withColumns({c: masked(F.col(c), kind) for c, kind in kinds.items()})


@dataclass(frozen=True)
class Subjects:
    users: frozenset[str] = frozenset()
    groups: frozenset[str] = frozenset()

    @classmethod
    def of(cls, users: Iterable[str] = (), groups: Iterable[str] = ()) -> Subjects:
        return cls(frozenset(users), frozenset(groups))

    def include(self, user: str, groups: Iterable[str]) -> bool:
        return user in self.users or bool(self.groups & set(groups))


@dataclass(frozen=True)
class MaskPolicy:
    """Who sees ``column`` how: exceptions see it clear, listed subjects masked."""

    column: str
    kinds: list[tuple[Subjects, str]]
    exceptions: Subjects = field(default_factory=Subjects)

    def kind_for(self, user: str, groups: Iterable[str]) -> str | None:
        if self.exceptions.include(user, groups):
            return None
        return next((k for who, k in self.kinds if who.include(user, groups)), None)


def masked_view(
    df: DataFrame, policies: Iterable[MaskPolicy], user: str, groups: Iterable[str] = ()
) -> DataFrame:
    """``df`` as ``user`` may see it. A user no policy mentions sees clear text."""
    kinds: dict[str, str] = {}
    decided: set[str] = set()
    for policy in policies:
        if policy.column in decided or policy.column not in df.columns:
            continue
        if policy.exceptions.include(user, groups):
            decided.add(policy.column)
        elif kind := policy.kind_for(user, groups):
            decided.add(policy.column)
            kinds[policy.column] = kind
    return mask(df, kinds)
