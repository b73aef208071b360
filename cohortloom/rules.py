"""Rule tables: imputation values, industry bands, maturity factors, code map loader."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ImputeRule:
    """Values by (levy flag, company type letter), then by levy flag alone."""

    by_type: Mapping[tuple[int, str], float]
    default: Mapping[int, float]


# Fixed values: (levy flag, type letter) -> payroll scheme start year.
SCHEME_YEAR_RULE = ImputeRule(
    by_type={
        (0, "C"): 2012,
        (0, "F"): 2008,
        (0, "I"): 2012,
        (0, "L"): 2007,
        (0, "P"): 2008,
        (1, "C"): 2004,
        (1, "E"): 2008,
        (1, "F"): 2009,
        (1, "I"): 2001,
        (1, "L"): 2010,
        (1, "P"): 1999,
        (1, "S"): 2003,
    },
    default={0: 2011, 1: 2004},
)

# Fixed values: (levy flag, type letter) -> number of employees.
EMPLOYEES_RULE = ImputeRule(
    by_type={
        (0, "C"): 16.0,
        (0, "F"): 25.0,
        (0, "I"): 8.0,
        (0, "L"): 34.0,
        (0, "P"): 28.5,
        (0, "S"): 33.0,
        (1, "C"): 189.0,
        (1, "E"): 259.5,
        (1, "F"): 156.0,
        (1, "I"): 153.0,
        (1, "L"): 261.0,
        (1, "P"): 683.0,
        (1, "S"): 579.0,
    },
    default={0: 16.0, 1: 200.0},
)

# Industry division up to and including n -> section letter.
SECTION_BANDS = (
    (3, "A"),
    (9, "B"),
    (33, "C"),
    (35, "D"),
    (39, "E"),
    (43, "F"),
    (47, "G"),
    (53, "H"),
    (56, "I"),
    (63, "J"),
    (66, "K"),
    (68, "L"),
    (75, "M"),
    (82, "N"),
    (84, "O"),
    (85, "P"),
    (88, "Q"),
    (93, "R"),
    (95, "S"),
    (98, "T"),
    (99, "U"),
)
SECTION_DEFAULT = "Z"

# Creation month (not zero padded) -> factor on commitments so far.
UPLIFT_FACTORS = {
    "2021-2": 1.09,
    "2021-3": 1.21,
    "2021-4": 1.34,
    "2021-5": 1.51,
    "2021-6": 1.71,
    "2021-7": 1.98,
    "2021-8": 2.36,
    "2021-9": 2.89,
    "2021-10": 3.85,
    "2021-11": 5.81,
    "2021-12": 11.78,
}


@dataclass(frozen=True)
class Rules:
    """Every rule table the feature steps take, with the library defaults."""

    scheme_year: ImputeRule = SCHEME_YEAR_RULE
    employees: ImputeRule = EMPLOYEES_RULE
    bands: tuple[tuple[int, str], ...] = SECTION_BANDS
    uplift: Mapping[str, float] = field(default_factory=lambda: dict(UPLIFT_FACTORS))

    def shift(self, years: int) -> Rules:
        """The same rules with every year in them moved by whole years."""
        year = self.scheme_year
        return Rules(
            scheme_year=ImputeRule(
                by_type={k: v + years for k, v in year.by_type.items()},
                default={k: v + years for k, v in year.default.items()},
            ),
            employees=self.employees,
            bands=self.bands,
            uplift={_shift_month(m, years): f for m, f in self.uplift.items()},
        )


def _shift_month(month: str, years: int) -> str:
    year, number = month.split("-")
    return f"{int(year) + years}-{number}"


# SHA-256 of the old-to-new industry code table this library's features are defined by (514 pairs,
# one new code chosen per old code): its "old,new" lines in order, joined by line ends.
CODE_MAP_DIGEST = "528b8fd7fd2d6d844cea47d8bd8c37617417962c224b94f977d124fa1ffb2499"


def read_code_map(spark: SparkSession, path: str) -> DataFrame:
    """Old (4-digit) to new (5-digit) industry codes from a CSV with a header.

    The table is a parameter: at 514 pairs it is too long to keep in code. A file that does not end
    in ``.csv`` is taken for a text that holds the recode as SQL, wherever its arms stand in it:
    ``WHEN column='0111' THEN '01110'``. Compare what you pass with ``CODE_MAP_DIGEST``.
    """
    if path.lower().endswith(".csv"):
        rows = spark.read.option("header", True).schema("old_code string, new_code string")
        return code_map(rows.csv(path))
    arms = F.regexp_extract_all(
        "value", F.lit(r"(?i)WHEN\s+\w+\s*=\s*'[0-9]{4}'\s+THEN\s+'[0-9]{5}'"), F.lit(0)
    )
    codes = spark.read.text(path).select(F.explode(arms).alias("arm")).select(
        F.regexp_extract_all("arm", F.lit("'([0-9]+)'")).alias("codes")
    )
    return code_map(codes.selectExpr("codes[0] AS old_code", "codes[1] AS new_code"))


def code_map(pairs: DataFrame) -> DataFrame:
    """The pairs, checked as they are read: a malformed or repeated old code is an error.

    Nothing is dropped, and distinct 4-digit codes are at most 10,000 rows.
    """
    good = F.col("old_code").rlike("^[0-9]{4}$") & F.col("new_code").isNotNull() & (F.col("n") == 1)
    problem = F.concat(F.lit("not one new code for a 4-digit code: "), F.coalesce("old_code", F.lit("NULL")))
    return (
        pairs.groupBy("old_code")
        .agg(F.min("new_code").alias("new_code"), F.count("*").alias("n"))
        .select(
            F.when(good, F.col("old_code")).otherwise(F.raise_error(problem)).alias("old_code"),
            "new_code",
        )
    )


def code_map_digest(mapping: DataFrame) -> DataFrame:
    """One row with the digest to compare with CODE_MAP_DIGEST (at most 10,000 codes)."""
    lines = F.array_sort(F.collect_list(F.concat_ws(",", "old_code", "new_code")))
    return code_map(mapping).agg(F.sha2(F.array_join(lines, "\n"), 256).alias("digest"))
