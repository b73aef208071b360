"""Payroll schemes per account, with rule-based values where a scheme gives none."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import predicates as P
from cohortloom.functions import scalars as S
from cohortloom.operators.accounts import restrict
from cohortloom.rules import Rules

SCHEME_CUTOFF = date(2022, 1, 1)
PROFILE = ("employees", "scheme_start_year", "company_type", "company_status")


def owner_profile(schemes: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per owning account, so that joining it to accounts meets no repeated key.

    The largest letter is found by code point: a number can be kept in a hash aggregate, where
    text would make every task sort its rows.
    """
    scoped = schemes if ids is None else restrict(schemes, ids, "d15")
    profile = (
        scoped.where("d15 IS NOT NULL")
        .groupBy("d15")
        .agg(
            F.max("d10").alias("employees"),
            F.min(F.year("d6")).alias("scheme_start_year"),
            F.max(F.expr(S.code_point(S.type_letter("d12")))).alias("_letter"),
            F.max("d8").alias("company_status"),
        )
    )
    return profile.selectExpr(
        "d15",
        "employees",
        "scheme_start_year",
        f"{S.from_code_point('_letter')} AS company_type",
        "company_status",
    )


def scheme_profile(
    accounts: DataFrame,
    schemes: DataFrame,
    cutoff: date = SCHEME_CUTOFF,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Per account and levy flag: largest scheme, first start year, last type and status.

    Schemes are aggregated first. Accounts without a scheme stay, with NULLs.
    """
    if ids is not None:
        accounts = restrict(accounts, ids, "a3")
    keys = accounts.where(P.before("a2", cutoff)).select("a3", "a1")
    # distinct() after the join: both sides already lie by account, so it adds no shuffle.
    return (
        keys.join(owner_profile(schemes, ids), F.col("a3") == F.col("d15"), "left")
        .select("a3", "a1", *PROFILE)
        .distinct()
    )


def profile_columns(rules: Rules, valid: str = "true") -> list[str]:
    """Match flag, imputed values and type default over the columns of a profile.

    ``valid`` blanks the result for accounts outside the scheme cutoff.
    """
    known = {
        "tpr_match": S.match_flag("employees"),
        "scheme_start_year": S.impute(
            "scheme_start_year", "a1", "company_type", rules.scheme_year, "INT"
        ),
        "employees": S.impute("employees", "a1", "company_type", rules.employees, "DOUBLE"),
        "company_type": S.type_default("company_type"),
        "company_status": "company_status",
    }
    return [f"CASE WHEN {valid} THEN {value} END AS {name}" for name, value in known.items()]


def scheme_features(
    accounts: DataFrame,
    schemes: DataFrame,
    rules: Rules = Rules(),
    cutoff: date = SCHEME_CUTOFF,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Profile with match flag, imputed year and employees, and type 'X' where unknown."""
    profile = scheme_profile(accounts, schemes, cutoff, ids)
    return profile.selectExpr("a3", *profile_columns(rules))
