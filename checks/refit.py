"""The boosted fit as one recursive SQL statement, so that a model's values can be compared.

Each recursion is a level of a tree: sums by node, feature and value, every cut's gain, the best
cut of each node, rows sent down, and after the last level the leaves added to the margins. Sums
are of whole multiples of 2**-30, so equal cuts tie and unequal ones order alike in any engine.
"""

from __future__ import annotations

from collections.abc import Sequence

SCALE = "1073741824::DOUBLE"


def refit(features: Sequence[str], trees: int = 100, depth: int = 6, rate: str = "0.3") -> list[str]:
    """CTEs over ``base`` (rid, fit, y, features): ``grown``, with ``margin`` by rid after the last.

    Rows with ``fit`` are fitted on; all are sent down the trees. A missing value goes right. Rows
    of ``grown`` without a rid are splits: step, node, f (from 1), threshold and gain.
    """
    last = trees * depth
    numbers = ", ".join(str(i) for i in range(1, len(features) + 1))
    values = ", ".join(f"CAST({name} AS DOUBLE)" for name in features)
    gain = " + ".join(
        f"({g}::DOUBLE / {SCALE}) * ({g}::DOUBLE / {SCALE}) / ({h} + 1)::DOUBLE"
        for g, h in (("lg", "lh"), ("(tg - lg)", "(th - lh)"))
    )
    whole = f"(tg::DOUBLE / {SCALE}) * (tg::DOUBLE / {SCALE}) / (th + 1)::DOUBLE"
    return [
        f"""long AS MATERIALIZED (
  SELECT rid, fit, unnest([{numbers}]) AS f, unnest([{values}]) AS v FROM base)""",
        """cuts AS MATERIALIZED (
  SELECT f, v, coalesce(lead(v) OVER (PARTITION BY f ORDER BY v), 'infinity'::DOUBLE) AS threshold
  FROM (SELECT DISTINCT f, v FROM long WHERE fit AND v IS NOT NULL))""",
        f"""grown AS (
  SELECT 0 AS step, rid, fit, y, 0.5::DOUBLE AS margin, 0 AS node, 0 AS f, 0::DOUBLE AS threshold,
    0::DOUBLE AS gain FROM base
  UNION ALL (
    WITH live AS (SELECT * FROM grown WHERE rid IS NOT NULL AND step < {last}),
    slope AS (
      SELECT rid, node, CAST(floor((margin - y) * {SCALE} + 0.5) AS BIGINT) AS g
      FROM live WHERE fit),
    cell AS (
      SELECT s.node, l.f, l.v, SUM(s.g) AS g, COUNT(*) AS h
      FROM slope s JOIN long l USING (rid) GROUP BY s.node, l.f, l.v),
    run AS (
      SELECT node, f, v, SUM(g) OVER w AS lg, SUM(h) OVER w AS lh,
        SUM(g) OVER (PARTITION BY node, f) AS tg, SUM(h) OVER (PARTITION BY node, f) AS th
      FROM cell WINDOW w AS (PARTITION BY node, f ORDER BY v)),
    scored AS (
      SELECT node, f, v, ({gain}) - {whole} AS gain
      FROM run WHERE v IS NOT NULL AND lh >= 1 AND th - lh >= 1),
    best AS (
      SELECT node, f, threshold, gain FROM scored JOIN cuts USING (f, v) WHERE gain > 1e-6
      QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) = 1),
    moved AS (
      SELECT live.step, live.rid, live.fit, live.y, live.margin, CASE WHEN best.node IS NULL
          THEN live.node ELSE 2 * live.node + 1 + CAST(coalesce(long.v >= best.threshold, TRUE) AS INT)
        END AS node
      FROM live LEFT JOIN best USING (node)
      LEFT JOIN long ON long.rid = live.rid AND long.f = best.f),
    leaf AS (
      SELECT moved.node, {rate} * (-(SUM(g)::DOUBLE / {SCALE}) / (COUNT(*) + 1)::DOUBLE) AS value
      FROM moved JOIN slope USING (rid) GROUP BY moved.node)
    SELECT step + 1, rid, fit, y,
      CASE WHEN (step + 1) % {depth} = 0 THEN margin + value ELSE margin END,
      CASE WHEN (step + 1) % {depth} = 0 THEN 0 ELSE node END, 0, 0::DOUBLE, 0::DOUBLE
    FROM moved JOIN leaf USING (node)
    UNION ALL
    SELECT (SELECT max(step) + 1 FROM live), NULL, NULL, NULL, NULL, node, f, threshold, gain
    FROM best))""",
        f"predicted AS (SELECT rid, margin FROM grown WHERE step = {last} AND rid IS NOT NULL)",
    ]
