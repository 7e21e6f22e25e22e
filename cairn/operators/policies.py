"""Role-based column masks and row filters applied at query time.

The role is a Python value, so ``lit(role).isin(...)`` is a constant that
Catalyst folds: for an exempt role the mask disappears from the plan, for
others only the mask expression remains. Row filters are applied before any
mask and before any caller filter, on the unmasked values.

Limit: policies protect only queries built through these functions. Anyone
who can read the underlying files bypasses them; hiding view text and
enforcing grants are catalog features and are not built here.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAGS = "tags"


@dataclass(frozen=True)
class MaskingPolicy:
    """Exempt roles see the value; every other role sees ``mask(value)``."""
    mask: Callable[[Column], Column]
    exempt_roles: Sequence[str] = ("ACCOUNTADMIN",)

    def apply(self, value: Column, role: str) -> Column:
        return F.when(F.lit(role).isin(*self.exempt_roles), value).otherwise(self.mask(value))


@dataclass(frozen=True)
class RowAccessPolicy:
    """``allow_all`` roles keep every row; each role in ``by_role`` keeps the
    rows where its predicate is TRUE; any other role sees nothing
    (default deny)."""
    allow_all: Sequence[str] = ("ACCOUNTADMIN",)
    by_role: Mapping[str, Callable[[], Column]] = field(default_factory=dict)

    def predicate(self, role: str) -> Column:
        if role in self.allow_all:
            return F.lit(True)
        if role in self.by_role:
            return F.coalesce(self.by_role[role](), F.lit(False))
        return F.lit(False)


def set_tag(df: DataFrame, column: str, tag: str, value: str) -> DataFrame:
    """Attach ``tag = value`` to a column (kept in column metadata, so
    it travels with the schema through projections and writes)."""
    meta = dict(df.schema[column].metadata)
    tags = dict(meta.get(TAGS, {}))
    tags[tag] = value
    meta[TAGS] = tags
    return df.withColumn(column, F.col(column).alias(column, metadata=meta))


def get_tag(df: DataFrame, column: str, tag: str) -> str | None:
    """The value of a tag on a column, or None."""
    return df.schema[column].metadata.get(TAGS, {}).get(tag)


def apply_policies(df: DataFrame, role: str,
                   masks: Mapping[str, MaskingPolicy] | None = None,
                   row_policy: RowAccessPolicy | None = None,
                   tag_masks: Mapping[str, MaskingPolicy] | None = None) -> DataFrame:
    """Filter rows by the row policy (on unmasked columns), then
    mask columns that carry a column policy or a tag with a policy."""
    if row_policy is not None:
        df = df.filter(row_policy.predicate(role))
    masks = dict(masks or {})
    tag_masks = dict(tag_masks or {})
    out = []
    for f in df.schema.fields:
        policy = masks.get(f.name)
        if policy is None:
            for tag in f.metadata.get(TAGS, {}):
                if tag in tag_masks:
                    policy = tag_masks[tag]
                    break
        c = F.col(f.name)
        out.append(policy.apply(c, role).alias(f.name, metadata=f.metadata) if policy else c)
    return df.select(*out)
