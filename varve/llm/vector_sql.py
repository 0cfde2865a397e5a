"""SQL of the exact vector queries: every round is a step of its own."""

from __future__ import annotations

_FLOOR = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"


def _valid(dims: int) -> str:
    fine = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    return f"embedding IS NOT NULL AND {fine} AND len(embedding) = {dims}"


def _codes(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, dims: int = 64) -> str:
    width = dims // parts
    steps = [
        f"""kept AS (SELECT vec_id, label, row_number() OVER () AS r,
                list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE {_valid(dims)})""",
        f"places AS (SELECT CAST(range AS INTEGER) AS p FROM range({parts}))",
        f"""parts AS (SELECT r, p, v[p * {width} + 1 : (p + 1) * {width}] AS x FROM kept, places)""",
        f"""b0 AS (SELECT p, e, v[p * {width} + 1 : (p + 1) * {width}] AS c
            FROM (SELECT v, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept) q, places WHERE e < {entries})""",
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} AS MATERIALIZED (SELECT r, p, any_value(x) AS x, min(struct_pack(d := d, e := e)) AS best FROM (
                SELECT r, p, x, e, CAST(list_dot_product(CAST(c AS DOUBLE[]), CAST(c AS DOUBLE[]))
                    - 2 * list_dot_product(CAST(x AS DOUBLE[]), CAST(c AS DOUBLE[]))
                    + list_dot_product(CAST(x AS DOUBLE[]), CAST(x AS DOUBLE[])) AS BIGINT) AS d
                FROM parts JOIN b{n} USING (p)) GROUP BY r, p)"""
        )
        if n < rounds:
            steps.append(
                f"""m{n} AS (SELECT p, e, list({_FLOOR} ORDER BY i) AS c FROM (
                    SELECT p, best.e AS e, i, sum(x[i]) AS s, count(*) AS n
                    FROM a{n}, (SELECT range + 1 AS i FROM range({width})) GROUP BY ALL) GROUP BY p, e)"""
            )
            steps.append(f"b{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{n}.c, b{n}.c) AS c FROM b{n} LEFT JOIN m{n} USING (p, e))")
    return f"""
    WITH {", ".join(steps)},
    coded AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
    digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (r), digest
    """


def _clusters(count: int = 16, rounds: int = 3, scale: int = 64, dims: int = 64, seed: int = 1) -> str:
    steps = [
        f"""kept AS (SELECT vec_id, row_number() OVER () AS r,
                list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings WHERE {_valid(dims)})""",
        f"""c0 AS (SELECT k, x AS c FROM (SELECT x, row_number() OVER (
                ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS k FROM kept) WHERE k < {count})""",
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} AS MATERIALIZED (SELECT r, any_value(x) AS x, min(struct_pack(d := d, k := k)) AS best FROM (
                SELECT r, x, k, CAST(list_dot_product(CAST(c AS DOUBLE[]), CAST(c AS DOUBLE[]))
                    - 2 * list_dot_product(CAST(x AS DOUBLE[]), CAST(c AS DOUBLE[]))
                    + list_dot_product(CAST(x AS DOUBLE[]), CAST(x AS DOUBLE[])) AS BIGINT) AS d
                FROM kept, c{n}) GROUP BY r)"""
        )
        if n < rounds:
            steps.append(
                f"""m{n} AS (SELECT k, list({_FLOOR} ORDER BY i) AS c FROM (
                    SELECT best.k AS k, i, sum(x[i]) AS s, count(*) AS n
                    FROM a{n}, (SELECT range + 1 AS i FROM range({dims})) GROUP BY ALL) GROUP BY k)"""
            )
            steps.append(f"c{n + 1} AS MATERIALIZED (SELECT k, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (k))")
    return f"""
    WITH {", ".join(steps)}
    SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
           CAST(sum(best.d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
           CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM kept JOIN a{rounds} USING (r) JOIN c{rounds} ON k = best.k
    """


CODES_SQL = _codes()
CLUSTERS_SQL = _clusters()
