"""DuckDB SQL for the same pipeline: the correctness oracle of every query.

The prepared tables are spelled out as CTEs with the plain textbook form of
each operator (global windows, IN-subqueries, cross joins with parameter
lists): fine for a 60k-row check, and independent of the Spark plans.
"""

from __future__ import annotations

RATINGS_VIEW = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity,
       CASE WHEN l_orderkey % 97 = 0 THEN 10000000 + l_orderkey ELSE o_custkey END AS user_id,
       CASE WHEN (l_orderkey * 7 + l_linenumber) % 101 = 0 THEN 10000000 + l_partkey * 1000 + l_orderkey % 1000
            ELSE l_partkey END AS movie_id,
       CAST(greatest(1, least(10, CAST(floor((35
            + 3*((l_partkey % 7) - 3)
            + 2*((o_custkey % 5) - 2)
            + 2*((CAST(l_quantity AS INT) % 11) - 5)
            + floor((l_partkey % 80) / 40.0e0)) / 5.0e0) AS INT))) AS DOUBLE) / 2.0e0 AS rating,
       CAST(epoch(l_shipdate) AS BIGINT) + l_linenumber * 14400
         + CASE WHEN (l_orderkey + l_linenumber) % 103 = 0 THEN (l_orderkey % 997) * 1209600 ELSE 0 END AS ts,
       CASE WHEN l_partkey % 97 = 0 THEN p_name
            WHEN l_partkey % 89 = 0 THEN concat(p_name, ' (1990-1991)')
            ELSE concat(p_name, ' (', CAST(1930 + l_partkey % 80 AS VARCHAR), ')') END AS title,
       concat(p_type, '|', p_brand) AS genres
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part   ON l_partkey  = p_partkey
"""

BASE_COLS = ("l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity, "
             "user_id, movie_id, rating, ts, title, genres")
FEAT_COLS = BASE_COLS + ", rating_week, movie_year"

WEEK = "CAST(floor((ts + 648000) / 604800.0e0) AS BIGINT) * 604800 - 345600"
YEAR = ("CASE WHEN regexp_matches(title, '\\(([0-9 \\-]*)\\)$') "
        "THEN regexp_extract(title, '\\(([0-9 \\-]*)\\)$', 1) END")
MONTH_LO = "CAST(epoch(date_trunc('month', make_timestamp(ts * 1000000))) AS BIGINT)"
MONTH_HI = ("CAST(epoch(date_trunc('month', make_timestamp(ts * 1000000)) + INTERVAL 1 MONTH) AS BIGINT)")
MONTH = f"CASE WHEN ({MONTH_HI}) - ts <= ts - ({MONTH_LO}) THEN ({MONTH_HI}) ELSE ({MONTH_LO}) END"


def _hash(seed: str) -> str:
    return ("md5(concat('" + seed + "-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR), '-', "
            "CAST(movie_id AS VARCHAR), '-', CAST(l_suppkey AS VARCHAR)))")


def _split(name: str, src: str, cols: str, p: float, seed: str, strata: str) -> str:
    if strata == "quartile":
        stratum = ("(CASE WHEN q.q1 > q.lo AND rating > q.q1 THEN 1 ELSE 0 END)"
                   " + (CASE WHEN q.q2 > q.lo AND rating > q.q2 THEN 1 ELSE 0 END)"
                   " + (CASE WHEN q.q3 > q.lo AND rating > q.q3 THEN 1 ELSE 0 END)")
        q = (f"{name}_q AS (SELECT min(rating) AS lo, quantile_cont(rating, 0.25) AS q1, "
             f"quantile_cont(rating, 0.5) AS q2, quantile_cont(rating, 0.75) AS q3 FROM {src}),\n")
        s = (f"{name}_s AS (SELECT {cols}, {_hash(seed)} AS h, {stratum} AS stratum "
             f"FROM {src} CROSS JOIN {name}_q q),\n")
    else:
        q = ""
        s = f"{name}_s AS (SELECT {cols}, {_hash(seed)} AS h, rating AS stratum FROM {src}),\n"
    r = (f"{name}_r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, l_extendedprice, l_quantity) AS rn, "
         f"count(*) OVER (PARTITION BY stratum) AS cnt FROM {name}_s),\n")
    out = f"{name} AS (SELECT {cols}, rn <= ceil({p!r}e0 * cnt) AS is_test FROM {name}_r)"
    return q + s + r + out


def base_ctes(strata: str = "quartile") -> str:
    """CTEs: view, split1, validation, moved_back, edx, split2, train, test_open, test, mu."""
    return f"""WITH view AS ({RATINGS_VIEW}),
{_split('split1', 'view', BASE_COLS, 0.1, '1', strata)},
temp AS (SELECT {BASE_COLS} FROM split1 WHERE is_test),
kept AS (SELECT {BASE_COLS} FROM split1 WHERE NOT is_test),
validation0 AS (SELECT * FROM temp WHERE movie_id IN (SELECT movie_id FROM kept)
                                      AND user_id IN (SELECT user_id FROM kept)),
moved_back AS (SELECT * FROM temp t WHERE NOT EXISTS (
    SELECT 1 FROM validation0 v WHERE v.l_orderkey IS NOT DISTINCT FROM t.l_orderkey
      AND v.l_linenumber IS NOT DISTINCT FROM t.l_linenumber AND v.l_suppkey IS NOT DISTINCT FROM t.l_suppkey
      AND v.l_extendedprice IS NOT DISTINCT FROM t.l_extendedprice AND v.l_quantity IS NOT DISTINCT FROM t.l_quantity
      AND v.user_id IS NOT DISTINCT FROM t.user_id AND v.movie_id IS NOT DISTINCT FROM t.movie_id
      AND v.rating IS NOT DISTINCT FROM t.rating AND v.ts IS NOT DISTINCT FROM t.ts
      AND v.title IS NOT DISTINCT FROM t.title AND v.genres IS NOT DISTINCT FROM t.genres)),
validation AS (SELECT *, {WEEK} AS rating_week, {YEAR} AS movie_year FROM validation0),
edx AS (SELECT *, {WEEK} AS rating_week, {YEAR} AS movie_year
        FROM (SELECT * FROM kept UNION ALL SELECT * FROM moved_back)),
{_split('split2', 'edx', FEAT_COLS, 0.2, '2', strata)},
train AS (SELECT {FEAT_COLS} FROM split2 WHERE NOT is_test),
test_open AS (SELECT {FEAT_COLS} FROM split2 WHERE is_test),
test AS (SELECT * FROM test_open o
         WHERE movie_id IN (SELECT movie_id FROM train) AND user_id IN (SELECT user_id FROM train)
           AND genres IN (SELECT genres FROM train) AND rating_week IN (SELECT rating_week FROM train)
           AND EXISTS (SELECT 1 FROM train t WHERE t.movie_year IS NOT DISTINCT FROM o.movie_year)),
mu AS (SELECT avg(rating) AS mu FROM train)"""


def alphas_cte(alphas, prefix: str = "e") -> str:
    rows = ",".join(f"({float(a)!r}::DOUBLE, {i + 1})" for i, a in enumerate(alphas))
    return f"{prefix}_alphas(alpha, idx) AS (VALUES {rows})"


def chain_ctes(chain, alphas=None, src: str = "train", prefix: str = "e",
               alpha_sql: str | None = None) -> str:
    """Effect tables ``{prefix}{i}(alpha, k, n, effect)`` per stage, for every alpha.

    Alphas come from a literal list or from ``alpha_sql`` (a SELECT of ``alpha, idx``).
    """
    if alpha_sql is not None:
        parts = [f"{prefix}_alphas AS ({alpha_sql})"]
    else:
        parts = [alphas_cte(alphas, prefix)]
    for i, key in enumerate(chain):
        joins = "".join(
            f" JOIN {prefix}{j} ON {prefix}{j}.alpha = a.alpha AND {prefix}{j}.k IS NOT DISTINCT FROM r.{chain[j]}"
            for j in range(i))
        offs = "".join(f" - {prefix}{j}.effect" for j in range(i))
        parts.append(
            f"{prefix}{i} AS (SELECT a.alpha, r.{key} AS k, count(*) AS n, "
            f"sum(r.rating - mu.mu{offs}) / (count(*) + a.alpha) AS effect "
            f"FROM {src} r CROSS JOIN {prefix}_alphas a CROSS JOIN mu{joins} GROUP BY a.alpha, r.{key})")
    return ",\n".join(parts)


def chain_predictions(chain, src: str = "test", prefix: str = "e", how: str = "JOIN",
                      unseen_zero: bool = False, stages: int | None = None) -> str:
    """SELECT of ``src`` rows x alphas with ``pred`` and ``n_unseen``."""
    m = len(chain) if stages is None else stages
    joins = "".join(
        f" {how} {prefix}{j} ON {prefix}{j}.alpha = a.alpha AND {prefix}{j}.k IS NOT DISTINCT FROM r.{chain[j]}"
        for j in range(m))
    terms = "".join(
        (f" + coalesce({prefix}{j}.effect, 0.0e0)" if unseen_zero else f" + {prefix}{j}.effect")
        for j in range(m))
    miss = " + ".join(f"(CASE WHEN {prefix}{j}.effect IS NULL THEN 1 ELSE 0 END)" for j in range(m))
    return (f"SELECT r.*, a.alpha, a.idx, mu.mu{terms} AS pred, {miss or '0'} AS n_unseen "
            f"FROM {src} r CROSS JOIN {prefix}_alphas a CROSS JOIN mu{joins}")
