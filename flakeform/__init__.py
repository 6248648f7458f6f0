"""flakeform: turn one flat, wide table into a validated snowflake schema with Spark."""

from flakeform.plans.healthcare import FLAT_SCHEMA, healthcare
from flakeform.plans.normalize import normalize
from flakeform.plans.specs import (
    Fact,
    Field,
    ForeignKey,
    KeyRule,
    NaturalDim,
    Snowflake,
    SurrogateDim,
)

__all__ = [
    "FLAT_SCHEMA",
    "Fact",
    "Field",
    "ForeignKey",
    "KeyRule",
    "NaturalDim",
    "Snowflake",
    "SurrogateDim",
    "healthcare",
    "normalize",
]
