"""Model datasets from nested feature structs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expanded(df: DataFrame, struct: str, dropped: Sequence[str] = ()) -> list[Column]:
    """All fields of a struct column except the dropped ones, as top-level columns."""
    return [
        F.col(f"`{struct}`.`{f.name}`").alias(f.name) for f in df.schema[struct].dataType.fields if f.name not in dropped
    ]


@dataclass(frozen=True)
class FeatureSet:
    """What a country's dataset is made of.

    ``structs`` maps each expanded struct to its bookkeeping fields, ``picked`` single
    nested values to their output name, ``required`` the structs that must hold a lookup id.
    """

    structs: Mapping[str, Sequence[str]]
    required: Sequence[str]
    picked: Mapping[str, str] = field(default_factory=dict)


_INTERNAL = ("timestamp", "lookup_id", "submission_id")

# Feature sets by country.
FEATURE_SETS = {
    "de": FeatureSet(
        structs={
            "internal_lookup_features": _INTERNAL,
            "schufa_features": ("error_message", "timestamp", "lookup_id", "pit"),
            "capacity": (
                "lookup_id",
                "timestamp",
                "external_lookup_id",
                "submission_id",
                "error_message",
                "flags",
                "inputs",
                "outputs",
            ),
        },
        required=("schufa_features",),
        picked={
            "schufa_features.error_message": "schufa_error_message",
            "crif_parser.error_message": "crif_error_message",
            "capacity.error_message": "capacity_error_message",
            "crif_parser.score": "num_crif_score",
        },
    ),
    "fi": FeatureSet(
        structs={
            "internal_lookup_features": _INTERNAL,
            "ccis_features": ("timestamp", "lookup_id", "pit"),
            "delta_features": ("timestamp", "lookup_id", "pit", "error_message"),
            "capacity": ("lookup_id", "timestamp", "submission_id", "ccis_lookup_id", "delta_lookup_id"),
        },
        required=("ccis_features", "delta_features"),
    ),
    "se": FeatureSet(
        structs={
            "internal_lookup_features": _INTERNAL,
            "uc_features": ("lookup_id", "timestamp"),
            "capacity": ("lookup_id", "timestamp", "submission_id", "external_lookup_id"),
        },
        required=("uc_features",),
    ),
}

# Outcome columns taken from the facts.
OUTCOMES = (
    "dpoint_30_1m",
    "dpoint_30_3m",
    "dpoint_30_6m",
    "dpoint_30_12m",
    "dpoint_60_12m",
    "dpoint_90_6m",
    "dpoint_90_12m",
    "dpoint_90_12m_se",
    "dpoint_fpd",
)


def risk_dataset(
    lookups: DataFrame, facts: DataFrame, features: FeatureSet, outcomes: Sequence[str] = OUTCOMES
) -> DataFrame:
    """Lookups that became loans, with flat features and the outcomes of their submission."""
    keys = ["submission_id", "customer_id"]
    wanted = F.size("loan_ids") > 0
    for struct in features.required:
        wanted = wanted & F.col(f"{struct}.lookup_id").isNotNull()
    flat = lookups.filter(F.coalesce(wanted, F.lit(False))).select(
        *keys,
        *[F.col(path).alias(name) for path, name in features.picked.items()],
        *[c for struct, dropped in features.structs.items() for c in expanded(lookups, struct, dropped)],
    )
    return flat.join(facts.select(*keys, *outcomes), keys, "left")
