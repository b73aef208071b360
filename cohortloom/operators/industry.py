"""Industry of an account through the companies it owns and the company register."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import scalars as S
from cohortloom.operators.accounts import restrict
from cohortloom.rules import SECTION_BANDS, SECTION_DEFAULT, code_map


def valid_owner(df: DataFrame) -> DataFrame:
    return df.where("d15 IS NOT NULL AND d15 > -1")


def company_owner(schemes: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One owning account per company number: the largest id."""
    owned = valid_owner(schemes)
    if ids is not None:
        owned = restrict(owned, ids, "d15")
    return owned.groupBy("d3").agg(F.max("d15").alias("d15"))


def owners_with_code(owners: DataFrame, register: DataFrame) -> DataFrame:
    """Owners joined to the register: one row per company, with its largest code.

    The register is reduced to one row per company first. That needs the same partitioning as
    the join, and a company listed many times then meets the join once.
    """
    codes = (
        register.where("i1 IS NOT NULL")
        .groupBy("i1")
        .agg(F.max(F.expr(S.leading_token("i4"))).alias("sic_code"))
    )
    return owners.join(codes, F.col("d3") == F.col("i1")).select("d15", "d3", "sic_code")


def account_code(owners: DataFrame, register: DataFrame) -> DataFrame:
    """Largest code among the companies of each account.

    Owners have one row per company, so the register needs no reduction before the join.
    """
    codes = register.where("i1 IS NOT NULL").selectExpr("i1", f"{S.leading_token('i4')} AS sic_code")
    found = owners.join(codes, F.col("d3") == F.col("i1"))
    return found.groupBy("d15").agg(F.max("sic_code").alias("sic_code"))


def recode(df: DataFrame, mapping: DataFrame, code: str = "sic_code") -> DataFrame:
    """``new_sic_code``: the mapped code, or the code itself where the map has none.

    The map has distinct 4-digit keys, so broadcasting it is bounded (see ``code_map``).
    """
    small = F.broadcast(code_map(mapping))
    return df.join(small, F.col(code) == F.col("old_code"), "left").select(
        *df.columns, F.coalesce("new_code", code).alias("new_sic_code")
    )


def with_section(
    df: DataFrame,
    bands: Sequence[tuple[int, str]] = SECTION_BANDS,
    default: str = SECTION_DEFAULT,
) -> DataFrame:
    """Division (first two characters) and section letter of ``new_sic_code``."""
    division = df.selectExpr("*", f"{S.division('new_sic_code')} AS sic_division")
    return division.selectExpr("*", f"{S.band('sic_division', bands, default)} AS sic_section")


def industry_features(
    schemes: DataFrame,
    register: DataFrame,
    mapping: DataFrame,
    bands: Sequence[tuple[int, str]] = SECTION_BANDS,
    ids: DataFrame | None = None,
) -> DataFrame:
    """New code, division and section per owning account with a company on the register."""
    codes = account_code(company_owner(schemes, ids), register)
    return with_section(recode(codes, mapping), bands).drop("sic_code")
