"""Exploration job: profile, class balance, dominated columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from docket.operators.contingency import value_counts
from docket.operators.profile import categorical_profile, duplicate_rows, frequent_values, histogram, numeric_profile
from docket.operators.screen import drop_low_variance, low_variance
from docket.schema import Roles, conform_types
from docket.session import staged


def explore(raw: DataFrame, roles: Roles = Roles()) -> tuple[dict[str, DataFrame], DataFrame]:
    """Reports by name, and the table without its dominated columns.

    Here every column is tested, key, numerics and target included.
    """
    df = staged(conform_types(raw), "raw")
    numeric, categorical = roles.numeric(df), [*roles.categorical(df), roles.target]
    reports = {
        "class_balance": value_counts(df, roles.target),
        "categorical_profile": categorical_profile(df, categorical),
        "frequent_values": frequent_values(df, categorical),
        "duplicate_rows": duplicate_rows(df),
        "screen": low_variance(df, df.columns),
    }
    if numeric:
        reports["numeric_profile"] = numeric_profile(df, numeric)
        reports["histogram"] = histogram(df, numeric)
    return reports, drop_low_variance(df, roles, scope="all")[0]
