"""Readers: declared types, and the options a database read is given (no database here)."""

import pytest

from checks import tables as T
from cohortloom.cohorts import TRAINING_COHORTS, rolling_cohort
from cohortloom.rules import code_map_digest, read_code_map
from cohortloom.session import ENGINE_CONF, cut_lineage
from cohortloom.sources import (
    KeyCuts,
    ParquetSource,
    key_bounds_sql,
    key_cuts,
    key_quantiles_sql,
    query_options,
    read_tables,
    schemas,
)
from cohortloom.sources.database import KeyRange, key_range, parse_split


def test_query_options_without_split():
    options = query_options("jdbc:db:x", "SELECT 1 AS a")
    assert options["query"] == "SELECT 1 AS a"
    assert options["queryTimeout"] == "3600"
    assert "dbtable" not in options


def test_query_options_with_split():
    split = KeyRange("b10", 1, 1000, 64)
    options = query_options("jdbc:db:x", "SELECT b10 FROM t", 60, split, properties={"user": "u"})
    assert options["dbtable"] == "(SELECT b10 FROM t) q"
    assert "query" not in options
    assert (options["partitionColumn"], options["numPartitions"]) == ("b10", "64")
    assert (options["lowerBound"], options["upperBound"]) == ("1", "1000")
    assert (options["queryTimeout"], options["user"]) == ("60", "u")


def test_key_bounds_sql():
    assert key_bounds_sql("t", "k") == "SELECT MIN(k) AS lower_key, MAX(k) AS upper_key FROM t"


def test_database_in_the_jobs():
    from cohortloom.__main__ import parser, source_of

    assert parse_split("pt_b=b10:64") == ("pt_b", "b10", 64)
    for bad in ("pt_b", "pt_b=b10", "pt_b=b10:x", "=b10:4", "pt_b=b10:0"):
        with pytest.raises(ValueError):
            parse_split(bad)
    assert key_range("b10", 64, (1, 900)) == KeyRange("b10", "1", "900", 64)
    assert key_range("b10", 64, (None, None)) is None
    base = ["train", "--model", "m", "--url", "jdbc:db:x", "--property", "user=u=v"]
    source = source_of(None, parser().parse_args(base))
    assert (source.url, source.properties) == ("jdbc:db:x", {"user": "u=v"})
    with pytest.raises(SystemExit):
        parser().parse_args([*base, "--tables", "t"])


def test_parts_of_a_skewed_read(spark, duck, sf_dir):
    """Conditions at quantiles: every row in one part, none much larger than its hottest key."""
    keys = "SELECT CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_orderkey END AS k FROM lineitem"
    duck.execute(f"CREATE OR REPLACE TEMP TABLE keyed AS {keys} UNION ALL SELECT NULL")
    total = duck.execute("SELECT COUNT(*) FROM keyed").fetchone()[0]
    least = [r[0] for r in duck.execute(key_quantiles_sql("keyed", "k", 16)).fetchall()]
    cuts = key_cuts("k", least)
    assert len(least) == 16 and len(cuts.predicates()) < 16  # the hot key fills several parts
    counts = [
        duck.execute(f"SELECT COUNT(*) FROM keyed WHERE {p}").fetchone()[0]
        for p in cuts.predicates()
    ]
    assert sum(counts) == total and min(counts) > 0
    hot = duck.execute("SELECT COUNT(*) FROM keyed WHERE k = 7").fetchone()[0]
    assert sorted(counts)[-2] <= total / 16 + 8 and max(counts) <= hot + total / 16 + 8
    # the same conditions in Spark
    df = spark.createDataFrame([(r[0],) for r in duck.execute("FROM keyed").fetchall()], "k long")
    assert [df.where(p).count() for p in cuts.predicates()] == counts


def test_cut_points():
    assert key_cuts("k", []) is None
    assert key_cuts("k", [5]).predicates() == ["1 = 1"]
    assert key_cuts("d", ["2001-01-01", "o'clock"]).predicates() == [
        "(d < 'o''clock' OR d IS NULL)",
        "d >= 'o''clock'",
    ]
    with pytest.raises(TypeError):
        KeyCuts("k", (True,)).predicates()


def test_parquet_round_trip_is_typed(spark, sf_dir, tmp_path):
    accounts = T.accounts(spark, sf_dir)
    renamed = {"pt_a": "accounts"}
    accounts.selectExpr("CAST(a1 AS BIGINT) a1", "CAST(a2 AS TIMESTAMP) a2", "a3", "a7", "1 AS x") \
        .write.parquet(str(tmp_path / "accounts"))
    T.commitments(spark, sf_dir).write.parquet(str(tmp_path / "pt_b"))
    T.schemes(spark, sf_dir).write.parquet(str(tmp_path / "pt_d"))
    T.register(spark, sf_dir).write.parquet(str(tmp_path / "pt_i"))
    tables = read_tables(spark, ParquetSource(str(tmp_path), renamed))

    def types(schema):
        return [(f.name, f.dataType) for f in schema]

    assert types(tables.accounts.schema) == types(schemas.ACCOUNTS)
    assert types(tables.commitments.schema) == types(schemas.COMMITMENTS)
    assert types(tables.schemes.schema) == types(schemas.SCHEMES)
    assert types(tables.register.schema) == types(schemas.REGISTER)
    assert sorted(tables.accounts.collect()) == sorted(accounts.collect())


def test_code_map_file(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text("old_code,new_code\n0111,01110\n0112,01110\n")
    rows = {tuple(r) for r in read_code_map(spark, str(path)).collect()}
    assert rows == {("0111", "01110"), ("0112", "01110")}


def test_code_map_from_a_recode_statement(spark, tmp_path):
    """The arms of a CASE, wherever they stand, give the table and the digest of a CSV."""
    pairs = [(f"{n:04d}", f"{10 * n:05d}") for n in range(1, 500, 3)]
    arms = [f"WHEN code='{old}' THEN '{new}' \\" for old, new in pairs]
    text = ["select a, CASE " + arms[0], *arms[1:-1], f"  when code = '{pairs[-1][0]}'  then"]
    text[-1] += f" '{pairs[-1][1]}' ELSE code END, CASE WHEN x='12' THEN 'A' END \\"
    statement, csv = tmp_path / "recode.txt", tmp_path / "codes.csv"
    statement.write_text("\n".join(text))
    csv.write_text("\n".join(["old_code,new_code", *map(",".join, pairs)]))
    read = [read_code_map(spark, str(p)) for p in (statement, csv)]
    assert sorted(map(tuple, read[0].collect())) == pairs
    assert code_map_digest(read[0]).first() == code_map_digest(read[1]).first()


def test_cut_lineage_reads_back(spark):
    df = cut_lineage(spark.range(10).selectExpr("id * 2 AS x"))
    assert df.count() == 10
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()


def test_default_windows():
    assert [c.label for c in TRAINING_COHORTS] == ["2019", "2020", "2022"]
    from datetime import date, datetime

    c = rolling_cohort(datetime(2022, 3, 1, 15, 30))
    assert (c.start, c.prev_start, c.end) == (date(2021, 3, 1), date(2020, 3, 1), date(2022, 3, 1))
    assert c.target_end is None and c.open_date == c.start and c.anchor.hour == 15
    assert T.COHORTS[0].shift(-T.YEARS) == TRAINING_COHORTS[0]


@pytest.mark.parametrize("key", sorted(ENGINE_CONF))
def test_engine_settings(spark, key):
    assert spark.conf.get(key) == ENGINE_CONF[key]
