"""Role-dependent column masks, applied to a table before anything is computed from it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The role that sees clear values, and what every other role sees instead.
UNMASKED_ROLE = "ACCOUNTADMIN"
HIDDEN_NUMBER = 0
HIDDEN_TEXT = "*****"


@dataclass(frozen=True)
class MaskPolicy:
    """Shows a value to one role and a constant to all others."""

    otherwise: Any
    role: str = UNMASKED_ROLE

    def __call__(self, value: Column, role: str) -> Column:
        return F.when(F.lit(role) == F.lit(self.role), value).otherwise(F.lit(self.otherwise))


AMOUNT_MASK = MaskPolicy(HIDDEN_NUMBER)
EMAIL_MASK = MaskPolicy(HIDDEN_TEXT)


def mask(df: DataFrame, policies: Mapping[str, MaskPolicy], role: str) -> DataFrame:
    """``df`` as ``role`` sees it; every column keeps its name, position and type.

    The role is a literal, so Catalyst folds each mask to the bare column or to the constant, and a
    hidden column is not even read from the files.
    """
    types = {f.name: f.dataType for f in df.schema}
    unknown = set(policies) - set(types)
    if unknown:
        raise ValueError(f"masked columns not in the table: {sorted(unknown)}")
    return df.withColumns(
        {name: policy(F.col(name), role).cast(types[name]) for name, policy in policies.items()}
    )
