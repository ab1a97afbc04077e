"""The DuckDB twin of the isolation forest: grows the same trees from the same hashes, and walks every row down each of them."""

from __future__ import annotations

from collections.abc import Sequence

_SAMPLE = 256
_LEVELS = 8


def _chance(seed: int, use: str) -> str:
    text = f"concat('{seed}:', tree, ':', node, ':{use}')"
    return f"(CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT) / 281474976710656.0::DOUBLE)"


def mean_path(n: str) -> str:
    n = f"({n})::DOUBLE"
    return f"CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 ELSE 2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n} END"


def forest_twin(features: str, key: str, numeric: Sequence[str], categorical: Sequence[str], trees: int, seed: int) -> str:
    """``k, path, score`` per row of ``features``."""
    n_numeric = len(numeric)
    names = [f"f{i}" for i in range(n_numeric + len(categorical))]
    xs = ", ".join(names)
    coded = [f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(numeric)]
    coded += [f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS f{n_numeric + i}" for i, c in enumerate(categorical)]
    bounds = ", ".join(f"min({f}) AS lo_{f}, max({f}) AS hi_{f}" for f in names[:n_numeric])
    codes = "".join(f", list_sort(list(DISTINCT {f})) AS c_{f}" for f in names[n_numeric:])
    choices = [f"CASE WHEN lo_{f} < hi_{f} THEN [{{'feature': {i}, 'value': 0.0::DOUBLE}}] ELSE [] END" for i, f in enumerate(names[:n_numeric])]
    choices += [
        f"CASE WHEN len(c_{f}) > 1 THEN list_transform(c_{f}, lambda v: {{'feature': {n_numeric + i}, 'value': v}}) ELSE [] END"
        for i, f in enumerate(names[n_numeric:])
    ]
    value = " ".join(f"WHEN {i} THEN hi_{f} - {_chance(seed, 'value')} * (hi_{f} - lo_{f})" for i, f in enumerate(names[:n_numeric]))
    left = " ".join(f"WHEN {i} THEN {f} {'<' if i < n_numeric else '='} value" for i, f in enumerate(names))
    side = f"2 * node + CASE WHEN (CASE feature {left} END) THEN 0 ELSE 1 END"
    parts = [
        f"x AS MATERIALIZED (SELECT {key} AS k, {', '.join(coded)} FROM ({features}))",
        f"pool AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY md5(concat(k, ':{seed}')), k) - 1 AS place FROM x QUALIFY place < {trees * _SAMPLE})",
        f"size AS MATERIALIZED (SELECT count(*) AS p, least({_SAMPLE}, count(*)) AS n FROM pool)",
        f"""s0 AS MATERIALIZED (SELECT tree, 1::BIGINT AS node, {xs} FROM (
              SELECT tree, (tree * {_SAMPLE} + i) % p AS place FROM range({trees}) t(tree), range({_SAMPLE}) r(i), size WHERE i < n) JOIN pool USING (place))""",
        f"w0 AS (SELECT k, tree, 1::BIGINT AS node, {xs} FROM x, range({trees}) t(tree))",
    ]
    for depth in range(_LEVELS + 1):
        parts.append(f"""g{depth} AS MATERIALIZED (
          SELECT *, CASE WHEN n > 1 AND len(choices) > 0 AND {depth} < (SELECT ceil(log2(greatest(n, 2))) FROM size)
                         THEN choices[1 + CAST(floor({_chance(seed, 'feature')} * len(choices)) AS BIGINT)] END AS pick
          FROM (SELECT *, list_concat({', '.join(choices)}) AS choices FROM (
            SELECT tree, node, count(*) AS n, {bounds}{codes} FROM s{depth} GROUP BY tree, node)))""")
        parts.append(f"""n{depth} AS MATERIALIZED (
          SELECT tree, node, pick.feature AS feature, CASE pick.feature {value} ELSE pick.value END AS value,
                 {depth * 1_000_000} + CAST(round(({mean_path('n')}) * 1000000) AS BIGINT) AS path FROM g{depth})""")
        if depth < _LEVELS:
            parts.append(f"s{depth + 1} AS MATERIALIZED (SELECT tree, {side} AS node, {xs} FROM s{depth} JOIN n{depth} USING (tree, node) WHERE feature IS NOT NULL)")
            parts.append(f"w{depth + 1} AS (SELECT k, tree, CASE WHEN feature IS NULL THEN node ELSE {side} END AS node, {xs} FROM w{depth} LEFT JOIN n{depth} USING (tree, node))")
    leaves = " UNION ALL ".join(f"SELECT tree, node, path FROM n{depth} WHERE feature IS NULL" for depth in range(_LEVELS + 1))
    parts.append(f"paths AS MATERIALIZED (SELECT k, CAST(sum(path) AS BIGINT) AS path FROM w{_LEVELS} JOIN ({leaves}) USING (tree, node) GROUP BY k)")
    score = f"pow(2.0, -(path / {trees * 1_000_000}.0::DOUBLE) / (SELECT {mean_path('n')} FROM size))"
    return f"(WITH {', '.join(parts)} SELECT k, path, {score} AS score FROM paths)"


def cut_of(paths: str, share: float) -> str:
    """The path that a share of rows stays below."""
    return (
        f"(SELECT path FROM (SELECT path, row_number() OVER (ORDER BY path) AS r, count(*) OVER () AS n FROM {paths})"
        f" WHERE r = n - CAST(ceil((1.0::DOUBLE - {share}::DOUBLE) * n) AS BIGINT) + 1)"
    )
