"""Check SQL of fitted models: least squares by successive regressions, and boosted stumps by cumulative sums."""

from __future__ import annotations

from collections.abc import Sequence


def partialled(features: Sequence[str], target: str, carry: str, keys: Sequence[str] = (), intercept: bool = True) -> str:
    """CTEs from ``t0`` (carry columns, keys, boolean ``train``, features, target) to ``fitted``.

    Each feature in turn is taken out of the later ones and of the target by its slope on the training rows; what is left of the
    target is the residual of the regression on all of them. ``fitted`` has it as ``residual``.
    """
    by = ", ".join(keys)
    own, group, match = (f"{by}, " if by else ""), (f" GROUP BY {by}" if by else ""), (f"JOIN {{}} USING ({by})" if by else "CROSS JOIN {}")
    parts, left = [], [*features, target]
    if intercept:
        means = ", ".join(f"avg({c}) FILTER (train) AS mean_{c}" for c in left)
        centred = ", ".join(f"{c} - mean_{c} AS {c}" for c in left)
        parts.append(f"means AS MATERIALIZED (SELECT {own}{means} FROM t0{group})")
        parts.append(f"u0 AS MATERIALIZED (SELECT {carry}, {own}train, {centred} FROM t0 {match.format('means')})")
    else:
        parts.append("u0 AS MATERIALIZED (SELECT * FROM t0)")
    for i, x in enumerate(features):
        left = left[1:]
        slopes = ", ".join(f"sum({c} * {x}) FILTER (train) / nullif(sum({x} * {x}) FILTER (train), 0) AS slope_{c}" for c in left)
        rest = ", ".join(f"{c} - coalesce(slope_{c}, 0) * {x} AS {c}" for c in left)
        parts.append(f"s{i} AS MATERIALIZED (SELECT {own}{slopes} FROM u{i}{group})")
        parts.append(f"u{i + 1} AS MATERIALIZED (SELECT {carry}, {own}train, {rest} FROM u{i} {match.format(f's{i}')})")
    parts.append(f"fitted AS (SELECT {carry}, {own}train, {target} AS residual FROM u{len(features)})")
    return ",\n".join(parts)


def stumps(features: Sequence[str], rounds: int, step: float = 0.3, penalty: int = 1) -> str:
    """CTEs from ``rows0`` (id, train, features, y, margin) to ``rows<rounds>``, with ``best<k>`` of each round."""
    parts = []
    names, values = (", ".join(f"'{f}'" for f in features), ", ".join(features))
    picked = "CASE b.feature " + " ".join(f"WHEN '{f}' THEN r.{f}" for f in features) + " END"
    for k in range(rounds):
        parts.append(
            f"cells{k} AS MATERIALIZED (SELECT feature, v, sum(g) AS g, count(*) AS c FROM (SELECT margin - y AS g, "
            f"unnest([{names}]) AS feature, unnest([{values}]) AS v FROM rows{k} WHERE train) GROUP BY feature, v)"
        )
        parts.append(
            f"cuts{k} AS (SELECT feature, v, sum(g) OVER w AS lg, sum(c) OVER w AS lc, sum(g) OVER p AS g, sum(c) OVER p AS c "
            f"FROM cells{k} WINDOW w AS (PARTITION BY feature ORDER BY v), p AS (PARTITION BY feature))"
        )
        parts.append(
            f"best{k} AS MATERIALIZED (SELECT *, lg * lg / (lc + {penalty}) + (g - lg) * (g - lg) / (c - lc + {penalty}) - g * g / (c + {penalty}) AS gain "
            f"FROM cuts{k} WHERE lc < c ORDER BY gain DESC, feature, v LIMIT 1)"
        )
        parts.append(
            f"rows{k + 1} AS MATERIALIZED (SELECT r.* REPLACE (margin - {step} * CASE WHEN {picked} <= b.v "
            f"THEN b.lg / (b.lc + {penalty}) ELSE (b.g - b.lg) / (b.c - b.lc + {penalty}) END AS margin) FROM rows{k} r CROSS JOIN best{k} b)"
        )
    return ",\n".join(parts)
