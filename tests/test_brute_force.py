"""Random rows around the window ends against plain Python loops."""

import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from cohortloom.cohorts import TRAINING_COHORTS, rolling_cohort
from cohortloom.operators.commitments import OCCUPATION_CODES, commitment_features
from tests import frames as T

AS_OF = datetime(2021, 11, 15, 9, 30)
COHORTS = (*TRAINING_COHORTS, rolling_cohort(AS_OF, compat=True))


def random_rows(seed, count=1500, accounts=40):
    rng = random.Random(seed)
    edges = sorted({d for c in COHORTS for d in (c.prev_start, c.start, c.end)})

    def near():
        day = datetime.combine(rng.choice(edges), datetime.min.time())
        return day + rng.choice(
            [timedelta(0), timedelta(seconds=-1), timedelta(days=rng.randint(-400, 400))]
        )

    def maybe(p):
        return near().isoformat(" ") if rng.random() < p else None

    codes = [*OCCUPATION_CODES, "5", None]
    return [
        (
            1 if rng.random() < 0.33 else rng.randrange(accounts),
            near().isoformat(" "),
            rng.choice(codes),
            rng.choice([0, 1, None]),
            maybe(0.3),
            maybe(0.9),
            maybe(0.3),
        )
        for _ in range(count)
    ]


def expected(rows, cohort):
    def day(text):
        return None if text is None else datetime.fromisoformat(text).date()

    def is_open(closed, at):
        return all(c is None or c >= at for c in closed)

    out = {}
    for owner, b2, b6, b12, b16, b17, b20 in rows:
        created, end, closed = day(b2), day(b17), (day(b16), day(b20))
        last = cohort.target_end
        target = created >= cohort.start and (last is None or created < last)
        lookback = cohort.prev_start <= created < cohort.start
        ending = (
            end is not None and cohort.start <= end < cohort.end and is_open(closed, cohort.start)
        )
        live = created < cohort.start and is_open(closed, cohort.open_date)
        if not (target or lookback or ending or live):
            continue
        entry = out.setdefault(owner, {"target": 0, "codes": [], "moved": 0, "end": 0, "live": 0})
        entry["target"] += target
        entry["end"] += ending
        entry["live"] += live
        if lookback:
            entry["codes"].append(b6)
            entry["moved"] += b12 == 1
    return out


def share(codes, value):
    if not codes:
        return None
    exact = Decimal(codes.count(value)) / Decimal(len(codes))
    return exact.quantize(Decimal("0.001"), ROUND_HALF_UP)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_features_equal_loops(spark, seed):
    rows = random_rows(seed)
    features = commitment_features(T.commitments(spark, rows), COHORTS)
    got = T.by_key(features, "cohort", "a3")
    for cohort in COHORTS:
        want = expected(rows, cohort)
        assert {a3 for label, a3 in got if label == cohort.label} == set(want)
        for owner, entry in want.items():
            row = got[cohort.label, owner]
            assert row.total_commitments == entry["target"]
            assert row.prev_12m_new_commitments == len(entry["codes"])
            assert row.prev_12m_new_levy_transfers == entry["moved"]
            assert row.commitments_ending_12m == entry["end"]
            assert row.current_live_commitments == entry["live"]
            for code in OCCUPATION_CODES:
                assert row[f"occupation_{code}"] == share(entry["codes"], code)
            assert row.occupation_null == share(entry["codes"], None)
