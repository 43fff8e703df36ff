"""DuckDB SQL for every registered query, over the raw Parquet tables.

The SQL is written from the definitions, in scaled integers, and shares no code with the DataFrame
operators: yields are whole hundredths of a percent, readings whole ten-thousandths, and every rounding
is spelled out as an integer division.
"""

from __future__ import annotations


def _div(num: str, den: str) -> str:
    """Integer division rounding halves away from zero."""
    return (
        f"(CASE WHEN ({num}) < 0 THEN -((2 * -({num}) + ({den})) // (2 * ({den}))) "
        f"ELSE (2 * ({num}) + ({den})) // (2 * ({den})) END)"
    )


def _dec(num: str, scale: int, precision: int) -> str:
    """A scaled integer as DECIMAL."""
    return f"CAST(({num}) / {float(10**scale)} AS DECIMAL({precision},{scale}))"


def _pct(part: str, total: str) -> str:
    return _dec(f"(20000 * ({part}) + ({total})) // (2 * ({total}))", 2, 5)


def _pct_null(part: str, total: str) -> str:
    return f"CASE WHEN ({total}) <> 0 THEN {_pct(part, f'nullif({total}, 0)')} END"


def _mean2(total: str, rows: str, precision: int = 5) -> str:
    """Mean of hundredths: rounded to six digits, then to two."""
    return _dec(_div(_div(f"({total}) * 10000", rows), "10000"), 2, precision)


def _mean_count(total: str, rows: str, precision: int = 12) -> str:
    """Mean of whole numbers: rounded to five digits, then to two."""
    return _dec(_div(_div(f"({total}) * 100000", rows), "1000"), 2, precision)


# Named relations. A query pulls in what it uses, and what that uses, in this order.
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "tool": (
        "SELECT n_nationkey AS tid, n_name AS tcode, r_name AS ttype "
        "FROM nation JOIN region ON r_regionkey = n_regionkey",
        (),
    ),
    "cham": (
        "SELECT s_suppkey AS cid, s_name AS ccode, tid, tcode, ttype FROM supplier JOIN tool ON tid = s_nationkey",
        ("tool",),
    ),
    "run": (
        "SELECT l_orderkey AS w, l_linenumber AS step, s_nationkey AS tid, "
        "CASE WHEN l_linenumber <> 2 THEN l_suppkey END AS cid, l_shipdate AS began, "
        "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS rid "
        "FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey",
        (),
    ),
    "wy": (
        "SELECT w, t, p, (20000 * p + t) // (2 * t) AS y FROM (SELECT l_orderkey AS w, count(*) AS t, "
        "sum(CASE l_returnflag WHEN 'R' THEN 0 ELSE 1 END)::BIGINT AS p FROM lineitem GROUP BY l_orderkey)",
        (),
    ),
    "waf": ("SELECT o_orderkey AS w, o_orderkey // 25 AS lot FROM orders", ()),
    "lot": (
        "SELECT lot, 'LOT-' || (24000 + lot) AS lot_number, "
        "['SoC-A17', 'GPU-B20', 'MEM-C10'][lot % 3 + 1] AS product, "
        "['3nm', '5nm', '7nm'][lot // 3 % 3 + 1] AS technology_node, "
        "CAST(DATE '2024-01-01' + CAST(lot AS INTEGER) AS DATE) AS start_date, "
        "CASE WHEN lot % 10 = 0 THEN 'In Process' ELSE 'Completed' END AS status "
        "FROM (SELECT DISTINCT lot FROM waf)",
        ("waf",),
    ),
    "cy": (
        "SELECT cid, tcode, ccode, ttype, count(*) AS n, sum(y)::BIGINT AS s, min(y) AS lo, max(y) AS hi, "
        f"{_div('sum(y)::BIGINT * 10000', 'count(*)')} AS m6 "
        "FROM (SELECT DISTINCT w, cid FROM run WHERE cid IS NOT NULL) JOIN wy USING (w) JOIN cham USING (cid) "
        "GROUP BY ALL",
        ("run", "wy", "cham"),
    ),
    "sus": (
        "SELECT tcode AS st, ccode AS sc, ttype AS stype, tcode || '/' || ccode AS label "
        "FROM cy ORDER BY m6, tcode, ccode LIMIT 1",
        ("cy",),
    ),
    "coh": (
        "SELECT DISTINCT w FROM run, sus WHERE tid IN (SELECT tid FROM tool WHERE tcode = st) "
        "AND cid IN (SELECT cid FROM cham WHERE ccode = sc)",
        ("run", "sus", "tool", "cham"),
    ),
    "ev": (
        "SELECT event_id AS id, event_type AS kind, ts, value, "
        "CASE WHEN event_id % 2 = 0 THEN (event_id * 37 + user_id) % (SELECT count(*) FROM orders) "
        "ELSE (event_id * 37 + user_id) % (SELECT (count(*) + 7) // 8 FROM orders) * 8 END AS w FROM events",
        (),
    ),
    "wd": (
        "SELECT w, (SELECT count(*) FROM ev WHERE ev.w = waf.w) AS d FROM waf",
        ("waf", "ev"),
    ),
    "rd": (
        "SELECT ['CD', 'Overlay', 'Film Thickness'][l_linenumber % 3 + 1] AS m, "
        "CAST(round(10000 * CASE l_linenumber % 3 WHEN 0 THEN l_quantity WHEN 1 THEN l_discount * 100 - 5 "
        "ELSE l_extendedprice END) AS BIGINT) AS v, l_orderkey AS w, s_nationkey AS tid, "
        "concat('L', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS mid, l_shipdate AS began "
        "FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey UNION ALL "
        "SELECT 'Sheet Resistance', CAST(round(10000 * value) AS BIGINT), w, CAST(id % 25 AS INTEGER), 'E' || id, ts "
        "FROM ev",
        ("ev",),
    ),
    "lim": (
        f"SELECT m, count(*) AS n, {_div(_div('sum(v)::BIGINT * 10000', 'count(*)'), '10000')} AS c, "
        "CAST(round(stddev_samp(v / 10000.0) * 10000) AS BIGINT) AS sg FROM rd GROUP BY m",
        ("rd",),
    ),
    "dtype": (
        "SELECT * FROM (VALUES (1, 'click', 'Interaction', false), (2, 'error', 'Failure', true), "
        "(3, 'purchase', 'Transaction', false), (4, 'signup', 'Interaction', false), "
        "(5, 'view', 'Interaction', true)) AS v(tid, kind, category, killer)",
        (),
    ),
    "mix": (
        "SELECT kind, count(*) FILTER (w IN (SELECT w FROM coh)) AS b, "
        "count(*) FILTER (w NOT IN (SELECT w FROM coh)) AS o FROM ev GROUP BY kind",
        ("ev", "coh"),
    ),
    "step": (
        "SELECT i AS sid, ['Deposition', 'CMP', 'Implant', 'Lithography', 'Etch', 'Etch', 'Metrology'][i] AS module, "
        "i * 10 AS ord FROM (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS i)",
        (),
    ),
    "opt": (
        "SELECT module, tid, cid, row_number() OVER (PARTITION BY module ORDER BY tcode, ccode) AS k, "
        "count(*) OVER (PARTITION BY module) AS n FROM ("
        "SELECT CASE ttype WHEN 'AMERICA' THEN 'Deposition' ELSE 'Etch' END AS module, tid, cid, tcode, ccode "
        "FROM cham WHERE ttype IN ('AMERICA', 'AFRICA') UNION ALL "
        "SELECT module, tid, NULL, tcode, '' FROM tool JOIN (VALUES ('CMP', 'ASIA'), ('Implant', 'ASIA'), "
        "('Lithography', 'MIDDLE EAST'), ('Metrology', 'EUROPE'), ('Metrology', 'ASIA')) AS v(module, kind) "
        "ON kind = ttype)",
        ("tool", "cham"),
    ),
}


def _with(body: str, *names: str) -> str:
    needed: set[str] = set()

    def pull(name: str) -> None:
        if name not in needed:
            needed.add(name)
            for used in CTES[name][1]:
                pull(used)

    for name in names:
        pull(name)
    parts = [f"{name} AS ({CTES[name][0]})" for name in CTES if name in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _stratum(n: str, total: str, n_all: str, total_all: str) -> tuple[str, str]:
    """Weight and weighed gap between n wafers and the rest of a stratum; 0 where either is empty."""
    both = f"({n}) > 0 AND ({n_all}) - ({n}) > 0"
    weight = f"({n}) * (({n_all}) - ({n})) / ({n_all})"
    gap = f"(({total}) / ({n}) - (({total_all}) - ({total})) / (({n_all}) - ({n})))"
    return f"(CASE WHEN {both} THEN {weight} ELSE 0 END)", f"(CASE WHEN {both} THEN {weight} * {gap} ELSE 0 END)"


# A published rational fit of the complementary error function.
_ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277)


def _significance() -> str:
    """Rank sums by one global ranking of all wafers, after the relations run, wy, cham and tool."""
    fitted = " + t * (".join(map(str, _ERFC)) + ")" * (len(_ERFC) - 1)
    return f"""
, ranked AS (
  SELECT w, rank() OVER (ORDER BY y) * 2 + count(*) OVER (PARTITION BY y) - 1 AS twice, count(*) OVER () AS na FROM wy
), tied AS (
  SELECT sum(k * k * k - k)::DOUBLE AS tied FROM (SELECT count(*)::HUGEINT AS k FROM wy GROUP BY y)
), placed AS (
  SELECT place, count(*)::DOUBLE AS n, sum(twice)::DOUBLE AS twice, any_value(na)::DOUBLE AS na
  FROM (SELECT DISTINCT w, CASE WHEN cid IS NOT NULL THEN cid * 2 ELSE tid * 2 + 1 END AS place FROM run) JOIN ranked USING (w)
  WHERE place IS NOT NULL GROUP BY place
), scored AS (
  SELECT place, n, CAST((twice / 2 - n * (n + 1) / 2 - n * (na - n) / 2)
    / nullif(sqrt(greatest(n * (na - n) / 12 * ((na + 1) - tied / nullif(na * (na - 1), 0)), 0)), 0) AS DECIMAL(10,3)) AS rank_z
  FROM placed, tied
), far AS (
  SELECT *, CASE WHEN rank_z IS NOT NULL THEN least(abs(rank_z), 38::DECIMAL(10,3)) END AS far, count(rank_z) OVER () AS m FROM scored
), chance AS (
  SELECT *, CASE WHEN far IS NOT NULL THEN least(t * exp(-x * x + {fitted}), 1) END AS p
  FROM (SELECT *, 1 / (1 + x / 2) AS t FROM (SELECT *, far::DOUBLE / sqrt(2.0::DOUBLE) AS x FROM far))
), raw AS (
  SELECT *, p * m / count(rank_z) OVER (ORDER BY far DESC) AS raw FROM chance
), adjusted AS (
  SELECT *, CASE WHEN far IS NOT NULL THEN least(min(raw) OVER (ORDER BY far), 1) END AS q FROM raw
), name AS (
  SELECT cid * 2 AS place, tcode, ccode FROM cham UNION ALL SELECT tid * 2 + 1, tcode, NULL FROM tool
)
SELECT tcode AS tool_code, ccode AS chamber_code, CAST(n AS BIGINT) AS wafers_through, rank_z,
       CAST(p AS DECIMAL(12,9)) AS p_value, CAST(q AS DECIMAL(12,9)) AS q_value
FROM adjusted JOIN name USING (place)
"""


def _conditional(limit: float) -> str:
    """Gaps of places with and without the wafers through a stronger place, after the relations run, wy, cham and tool."""
    alone = _stratum("n", "s", "na", "sa")

    def given(a: str, b: str) -> str:
        """The score of place a among wafers through b and among the others, n and s being those through both."""
        inside = _stratum("n", "s", f"n_{b}", f"s_{b}")
        outside = _stratum(f"n_{a} - n", f"s_{a} - s", f"na - n_{b}", f"sa - s_{b}")
        return f"({inside[1]} + {outside[1]}) / nullif(sqrt({inside[0]} + {outside[0]}), 0) / nullif(sigma, 0)"

    return f"""
, visit AS (
  SELECT DISTINCT w, CASE WHEN cid IS NOT NULL THEN cid * 2 ELSE tid * 2 + 1 END AS place FROM run
), v AS (
  SELECT w, place, y FROM visit JOIN wy USING (w) WHERE place IS NOT NULL
), whole AS (
  SELECT na, sa, sqrt((q - sa * sa / na) / nullif(na - 1, 0)) AS sigma
  FROM (SELECT count(*)::DOUBLE AS na, sum(y)::DOUBLE AS sa, sum(y * y)::DOUBLE AS q FROM wy)
), marginal AS (
  SELECT place, n, s, {alone[1]} / nullif({alone[0]}, 0) AS gap,
         {alone[1]} / nullif(sqrt({alone[0]}), 0) / nullif(sigma, 0) AS z
  FROM (SELECT place, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s FROM v GROUP BY place), whole
), bad AS (
  SELECT * FROM marginal WHERE z <= -{limit}
), pair AS (
  SELECT o.place AS po, x.place AS px, any_value(o.n) AS n_o, any_value(o.s) AS s_o, any_value(x.n) AS n_x, any_value(x.s) AS s_x,
         any_value(x.z) AS zx, count(*)::DOUBLE AS n, sum(a.y)::DOUBLE AS s
  FROM v a JOIN v b ON a.w = b.w JOIN bad o ON o.place = a.place JOIN bad x ON x.place = b.place
  WHERE x.z < o.z OR (x.z = o.z AND x.place < o.place) GROUP BY o.place, x.place
), scored AS (
  SELECT po, px, zx, {given("o", "x")} AS left_over, {given("x", "o")} AS back FROM pair, whole
), reason AS (
  SELECT po, px, left_over, row_number() OVER (PARTITION BY po ORDER BY zx, px) AS k FROM scored
  WHERE coalesce(left_over > -{limit}, true) AND coalesce(back <= -{limit}, left_over IS NULL)
), name AS (
  SELECT cid * 2 AS place, tcode, ccode FROM cham UNION ALL SELECT tid * 2 + 1, tcode, NULL FROM tool
)
SELECT name.tcode AS tool_code, name.ccode AS chamber_code, CAST(n AS BIGINT) AS wafers_through,
       CAST(gap / 100 AS DECIMAL(10,3)) AS gap_pct, CAST(z AS DECIMAL(10,3)) AS z_score,
       CASE WHEN px IS NOT NULL THEN 'explained' WHEN z <= -{limit} THEN 'suspect' ELSE 'clean' END AS verdict,
       CASE WHEN px IS NOT NULL THEN concat_ws('/', by_name.tcode, by_name.ccode) END AS explained_by,
       CAST(left_over AS DECIMAL(10,3)) AS z_given
FROM marginal JOIN name USING (place) LEFT JOIN (SELECT * FROM reason WHERE k = 1) ON po = marginal.place
LEFT JOIN name by_name ON by_name.place = px
"""


_WEIGHTED = _pct("sum(p)", "sum(t)").replace("sum(p)", "sum(p)::BIGINT").replace("sum(t)", "sum(t)::BIGINT")
_BAND = (
    "CASE WHEN d <= 3 THEN '0-3  (low)' WHEN d <= 6 THEN '4-6  (medium)' "
    "WHEN d <= 9 THEN '7-9  (high)' ELSE '10+  (very high)' END"
)
_IN = "w IN (SELECT w FROM coh)"


def _analyses() -> dict[str, str]:
    # Fixed values in the texts below: names, labels and thresholds that results must equal.
    lot_yield = f"count(*) AS wafers, {_WEIGHTED} AS yield_pct FROM wy JOIN waf USING (w) JOIN lot USING (lot)"
    sites = (
        "SELECT l_orderkey AS w, l_linenumber AS x, l_partkey AS y, l_returnflag <> 'R' AS ok, count(*) AS n "
        "FROM lineitem GROUP BY ALL"
    )
    sq = "sqrt((n * q - s::DOUBLE * s) / (n::DOUBLE * (n - 1)))"
    return {
        "commonality_rank": _with(
            f"SELECT tcode AS tool_code, ccode AS chamber_code, n AS wafers_through, "
            f"{_dec('(m6 + 5000) // 10000', 2, 5)} AS avg_yield_pct, "
            "CAST(rank() OVER (ORDER BY m6) AS INTEGER) AS worst_rank FROM cy",
            "cy",
        ),
        "find_suspect": _with(
            f"SELECT tcode AS tool_code, ccode AS chamber_code, n AS wafers_through, "
            f"{_dec('(m6 + 5000) // 10000', 2, 5)} AS avg_yield_pct FROM cy ORDER BY m6, tcode, ccode LIMIT 1",
            "cy",
        ),
        "chamber_significance": _with(_significance(), "run", "wy", "cham", "tool"),
        "conditional_commonality": _with(_conditional(1.0), "run", "wy", "cham", "tool"),
        "wafer_yield": _with(
            f"SELECT w AS wafer_id, t AS total_dies, p AS pass_dies, {_dec('y', 2, 5)} AS yield_pct FROM wy", "wy"
        ),
        "wafer_defects": _with("SELECT w AS wafer_id, d AS defect_count FROM wd", "wd"),
        "yield_by_lot": _with(
            "SELECT lot_number, product, technology_node, count(*) AS wafers, sum(t)::BIGINT AS total_dies, "
            f"sum(p)::BIGINT AS pass_dies, {_WEIGHTED} AS yield_pct FROM wy JOIN waf USING (w) JOIN lot USING (lot) "
            "GROUP BY lot_number, product, technology_node",
            "wy",
            "lot",
        ),
        "yield_by_product": _with(f"SELECT product, {lot_yield} GROUP BY product", "wy", "lot"),
        "yield_by_node": _with(f"SELECT technology_node, {lot_yield} GROUP BY technology_node", "wy", "lot"),
        "yield_by_tool": _with(
            f"SELECT tcode AS tool_code, ttype AS tool_type, count(*) AS wafers_touched, {_WEIGHTED} AS yield_pct "
            "FROM (SELECT DISTINCT w, tid FROM run) JOIN wy USING (w) JOIN tool USING (tid) GROUP BY tcode, ttype",
            "run",
            "wy",
            "tool",
        ),
        "defect_pareto": _with(
            "SELECT kind AS defect_name, category, killer AS is_killer, c AS defect_count, "
            f"{_pct('c', 'g')} AS pct_of_total, {_pct('r', 'g')} AS cumulative_pct FROM ("
            "SELECT a.kind, category, killer, c, (SELECT count(*) FROM ev) AS g, "
            "(SELECT sum(b.c)::BIGINT FROM k b WHERE b.c > a.c OR (b.c = a.c AND b.kind <= a.kind)) AS r "
            "FROM k a JOIN dtype USING (kind))".replace("k a", "(SELECT kind, count(*) AS c FROM ev GROUP BY kind) a")
            .replace("k b", "(SELECT kind, count(*) AS c FROM ev GROUP BY kind) b"),
            "ev",
            "dtype",
        ),
        "defect_mix_by_cohort": _with(
            f"SELECT kind AS defect_name, {_pct_null('b', '(SELECT sum(b)::BIGINT FROM mix)')} AS pct_bad_group, "
            f"{_pct_null('o', '(SELECT sum(o)::BIGINT FROM mix)')} AS pct_others_group FROM mix",
            "mix",
        ),
        "spc_limits": _with(
            f"SELECT m AS metric_type, n AS readings, {_dec('c', 4, 12)} AS center_line, {_dec('sg', 4, 12)} AS sigma, "
            f"{_dec('c + 3 * sg', 4, 12)} AS ucl, {_dec('c - 3 * sg', 4, 12)} AS lcl, "
            "(SELECT count(*) FROM rd WHERE rd.m = lim.m AND abs(rd.v - lim.c) > 3 * lim.sg) "
            "AS points_out_of_control FROM lim",
            "lim",
        ),
        "cd_chart_points": _with(
            f"SELECT mid AS measurement_id, began AS measured_at, {_dec('v', 4, 12)} AS value, "
            f"{_dec('c', 4, 12)} AS center_line, {_dec('c + 3 * sg', 4, 12)} AS ucl, "
            f"{_dec('c - 3 * sg', 4, 12)} AS lcl, abs(v - c) > 3 * sg AS is_out FROM rd JOIN lim USING (m) "
            "WHERE m = 'CD'",
            "lim",
        ),
        "spc_group_shift": _with(
            f"SELECT CASE WHEN inside THEN (SELECT label FROM sus) ELSE 'Others' END AS grp, n AS readings, "
            f"{_dec(_div('g8', '10000'), 4, 12)} AS group_mean_cd, {_dec(_div('m8', '10000'), 4, 12)} AS overall_center, "
            "CAST(m8 / 1e8 + 3 * sd AS DECIMAL(12,4)) AS ucl, "
            "CAST((g8 - m8) / 1e8 / sd AS DECIMAL(6,3)) AS group_mean_shift_in_sigma FROM ("
            f"SELECT {_IN} AS inside, count(*) AS n, {_div('sum(v)::BIGINT * 10000', 'count(*)')} AS g8 "
            "FROM rd WHERE m = 'CD' GROUP BY 1), ("
            f"SELECT {_div('sum(v)::BIGINT * 10000', 'count(*)')} AS m8, stddev_samp(v / 10000.0) AS sd "
            "FROM rd WHERE m = 'CD')",
            "rd",
            "coh",
            "sus",
        ),
        "spc_by_tool": _with(
            "SELECT tcode AS tool_code, count(*) AS readings, "
            f"{_dec(_div(_div('sum(v)::BIGINT * 10000', 'count(*)'), '10000'), 4, 12)} AS center_line_cd, "
            "CAST(stddev_samp(v / 10000.0) AS DECIMAL(12,4)) AS sigma "
            "FROM rd JOIN tool USING (tid) WHERE m = 'CD' GROUP BY tcode",
            "rd",
            "tool",
        ),
        "suspect_vs_peers": _with(
            "SELECT CASE WHEN mine THEN 'Suspect: ' || st || '/' || sc ELSE 'Other ' || stype || ' chambers' END AS grp, "
            f"n AS wafers, {_mean2('s', 'n')} AS avg_yield_pct, {_dec('lo', 2, 5)} AS min_yield, "
            f"{_dec('hi', 2, 5)} AS max_yield, CAST({sq} / 100 AS DECIMAL(5,2)) AS sigma FROM sus, ("
            "SELECT tcode = st AND ccode = sc AS mine, count(*) AS n, sum(y)::BIGINT AS s, sum(y * y)::DOUBLE AS q, "
            "min(y) AS lo, max(y) AS hi FROM (SELECT DISTINCT w, cid FROM run) JOIN wy USING (w) "
            "JOIN cham USING (cid), sus WHERE ttype = stype GROUP BY 1)",
            "sus",
        ),
        "yield_by_defect_band": _with(
            f"SELECT {_BAND} AS defect_band, count(*) AS wafers, {_mean2('sum(y)::BIGINT', 'count(*)')} AS avg_yield_pct, "
            f"{_mean_count('sum(d)::BIGINT', 'count(*)')} AS avg_defects FROM wy JOIN wd USING (w) GROUP BY 1",
            "wy",
            "wd",
        ),
        "cohort_fingerprint": _with(
            "SELECT CASE WHEN inside THEN (SELECT label FROM sus) || ' (bad)' ELSE 'All others' END AS grp, "
            f"n AS wafers, {_mean2('s', 'n')} AS avg_yield_pct, {_mean_count('dd', 'n')} AS avg_defects, "
            f"{_pct_null('f', 'dd')} AS particle_flake_pct FROM ("
            f"SELECT {_IN} AS inside, count(*) AS n, sum(y)::BIGINT AS s, sum(d)::BIGINT AS dd, "
            "sum((SELECT count(*) FROM ev WHERE ev.w = wy.w AND kind IN ('error', 'view')))::BIGINT AS f "
            "FROM wy JOIN wd USING (w) GROUP BY 1)",
            "wy",
            "wd",
            "coh",
            "sus",
        ),
        "wafer_map": (
            "SELECT w AS wafer_id, string_agg(concat(x, ':', y, ':', CASE WHEN ok THEN 'P' ELSE 'F' END, ':', n), ' ' "
            f"ORDER BY x, y, ok) AS dies FROM ({sites}) GROUP BY w"
        ),
        "wafer_sites": f"SELECT w AS wafer_id, CAST(x AS INTEGER) AS die_x, y AS die_y, ok AS is_pass, n AS tests FROM ({sites})",
        "yield_by_zone": (
            f"SELECT zone, count(*) AS total_dies, sum(p)::BIGINT AS pass_dies, {_pct('sum(p)::BIGINT', 'count(*)')} AS yield_pct "
            "FROM (SELECT p, CASE WHEN d4 > 160 THEN 'edge' WHEN d4 > 100 THEN 'mid' ELSE 'center' END AS zone FROM ("
            "SELECT CASE l_returnflag WHEN 'R' THEN 0 ELSE 1 END AS p, (2 * l_linenumber - 13) * (2 * l_linenumber - 13) "
            "+ (2 * (l_partkey % 12 + 1) - 13) * (2 * (l_partkey % 12 + 1) - 13) AS d4 FROM lineitem)) GROUP BY zone"
        ),
        "killer_pareto": _with(
            "SELECT kind AS defect_name, category, killer AS is_killer, c AS defect_count, "
            f"{_pct('c', 'g')} AS pct_of_total, {_pct('r', 'g')} AS cumulative_pct FROM ("
            "SELECT *, sum(c) OVER ()::BIGINT AS g, sum(c) OVER (ORDER BY c DESC, kind)::BIGINT AS r FROM ("
            "SELECT kind, category, killer, count(*) AS c FROM ev JOIN dtype USING (kind) WHERE killer GROUP BY ALL))",
            "ev",
            "dtype",
        ),
        "defect_sizes": _with(
            "SELECT kind AS defect_name, killer AS is_killer, count(*) AS defect_count, count(s) AS sized, "
            f"{_dec('min(s)', 4, 10)} AS smallest_um, "
            f"{_dec(_div(_div('sum(s)::BIGINT * 10000', 'count(s)'), '10000'), 4, 10)} AS mean_um, "
            f"{_dec('max(s)', 4, 10)} AS largest_um "
            f"FROM (SELECT kind, {_div('CAST(round(10000 * value) AS BIGINT)', '100')} AS s FROM ev) JOIN dtype USING (kind) "
            "GROUP BY kind, killer",
            "ev",
            "dtype",
        ),
        "spc_by_chamber": _with(
            "SELECT tcode AS tool_code, ccode AS chamber_code, count(*) AS readings, "
            f"{_dec(_div(_div('sum(v)::BIGINT * 10000', 'count(*)'), '10000'), 4, 12)} AS center_line_cd, "
            "CAST(stddev_samp(v / 10000.0) AS DECIMAL(12,4)) AS sigma FROM "
            "(SELECT DISTINCT w, cid FROM run WHERE cid IS NOT NULL) JOIN rd USING (w) JOIN cham USING (cid) "
            "WHERE m = 'CD' GROUP BY cid, tcode, ccode",
            "run",
            "rd",
            "cham",
        ),
        "spc_run_rules": _with(
            "SELECT tcode AS tool_code, m AS metric_type, sum(k)::BIGINT AS readings, "
            "count(*) FILTER (s <> 0 AND k >= 8) AS runs, "
            "coalesce(sum(k) FILTER (s <> 0 AND k >= 8), 0)::BIGINT AS readings_in_runs, "
            "max(k) FILTER (s <> 0) AS longest_run FROM (SELECT tid, m, s, g, count(*) AS k FROM (SELECT tid, m, s, "
            "row_number() OVER (PARTITION BY tid, m ORDER BY began, mid, v) "
            "- row_number() OVER (PARTITION BY tid, m, s ORDER BY began, mid, v) AS g "
            "FROM (SELECT rd.tid, m, began, mid, v, sign(v - c) AS s FROM rd JOIN lim USING (m))) GROUP BY ALL) "
            "JOIN tool USING (tid) GROUP BY tcode, m",
            "rd",
            "lim",
            "tool",
        ),
        "occupancy": _with(
            "SELECT tcode AS tool_code, ccode AS chamber_code, count(*) AS runs, "
            "count(*) FILTER (began < busy) AS overlapping, "
            "sum(greatest(CAST(epoch(ended) - epoch(greatest(began, coalesce(busy, began))) AS BIGINT), 0))::BIGINT AS busy_seconds "
            "FROM (SELECT *, max(ended) OVER (PARTITION BY cid, CASE WHEN cid IS NULL THEN tid END ORDER BY began, rid "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS busy "
            "FROM (SELECT *, began + INTERVAL 20 MINUTE AS ended FROM run)) r "
            "LEFT JOIN (SELECT cid, ccode, tid AS own FROM cham) USING (cid) JOIN tool ON tool.tid = coalesce(own, r.tid) "
            "GROUP BY tcode, ccode",
            "run",
            "cham",
            "tool",
        ),
        "cusum_by_tool": _with(
            "SELECT tcode AS tool_code, m AS metric_type, count(*) AS readings, "
            + ", ".join(
                f"count(*) FILTER ({c} > sg * 10) AS alarms_{name}, CAST(min(began) FILTER ({c} > sg * 10) AS DATE) AS first_{name}, "
                f"{_dec(f'max({c}) * 5', 5, 20)} AS highest_{name}"
                for c, name in (("su", "high"), ("sd", "low"))
            )
            + " FROM (SELECT *, pu - least(0, min(pu) OVER o) AS su, pd - least(0, min(pd) OVER o) AS sd FROM ("
            "SELECT *, sum((v - c) * 2 - sg) OVER o AS pu, sum((c - v) * 2 - sg) OVER o AS pd FROM rd JOIN lim USING (m) "
            "WINDOW o AS (PARTITION BY tid, m ORDER BY began, mid, v ROWS UNBOUNDED PRECEDING)) "
            "WINDOW o AS (PARTITION BY tid, m ORDER BY began, mid, v ROWS UNBOUNDED PRECEDING)) "
            "JOIN tool USING (tid) GROUP BY tcode, m",
            "rd",
            "lim",
            "tool",
        ),
        "capability": _with(
            f"SELECT m AS metric_type, {_dec('lo', 4, 12)} AS spec_low, {_dec('hi', 4, 12)} AS spec_high, n AS readings, "
            f"bad AS out_of_spec, {_pct('bad', 'n')} AS out_of_spec_pct, "
            "CAST((hi - lo) / 10000.0 / (6 * sd) AS DECIMAL(12,3)) AS cp, "
            "CAST(least(hi * 10000::BIGINT - m8, m8 - lo * 10000::BIGINT) / 1e8 / (3 * sd) AS DECIMAL(12,3)) AS cpk FROM ("
            "SELECT m, lo, hi, count(*) AS n, count(*) FILTER (v < lo OR v > hi) AS bad, "
            f"{_div('sum(v)::BIGINT * 10000', 'count(*)')} AS m8, stddev_samp(v / 10000.0) AS sd "
            "FROM rd JOIN (VALUES ('CD', 10000, 500000), ('Overlay', -50000, 50000)) AS t(m, lo, hi) USING (m) GROUP BY ALL)",
            "rd",
        ),
        "defect_yield_points": _with(
            f"SELECT w AS wafer_id, d AS defect_count, {_dec('y', 2, 5)} AS yield_pct FROM wy JOIN wd USING (w)",
            "wy",
            "wd",
        ),
        "defect_yield_trend": _with(
            "SELECT count(*) AS wafers, CAST(regr_slope(y / 100.0, d) AS DECIMAL(12,6)) AS slope, "
            "CAST(regr_intercept(y / 100.0, d) AS DECIMAL(12,6)) AS intercept, "
            "CAST(corr(y / 100.0, d) AS DECIMAL(12,6)) AS correlation FROM wy JOIN wd USING (w)",
            "wy",
            "wd",
        ),
    }


# The bound tables under their contract column names, for the audits.
_FAB = {
    "tools": "SELECT tid AS tool_id, tcode AS tool_code, tcode AS tool_name, ttype AS tool_type, true AS is_active FROM tool",
    "process_steps": (
        "SELECT sid AS process_step_id, 'STEP-' || sid AS step_code, module || ' ' || sid AS step_name, "
        "module AS process_module, ord AS sequence_order FROM step"
    ),
    "defect_types": (
        "SELECT tid AS defect_type_id, upper(kind) AS defect_code, kind AS defect_name, category, "
        "killer AS is_killer FROM dtype"
    ),
    "bin_codes": (
        "SELECT i AS bin_code_id, i AS bin_number, name AS bin_name, kind AS bin_category, i = 1 AS is_pass, NULL::VARCHAR AS description FROM (VALUES "
        "(1, 'Pass', 'Pass'), (2, 'Open', 'Hard Fail'), (3, 'Short', 'Hard Fail'), (4, 'Speed Fail', 'Parametric Fail'), "
        "(5, 'Leakage', 'Parametric Fail'), (6, 'IDDQ', 'Parametric Fail'), (7, 'Gross Fail', 'Hard Fail'), "
        "(8, 'Functional', 'Hard Fail')) AS v(i, name, kind)"
    ),
    "lots": "SELECT lot AS lot_id, lot_number, product, technology_node, 25 AS planned_qty, start_date, status FROM lot",
    "wafers": (
        "SELECT w AS wafer_id, 'LOT-' || (24000 + lot) || '.' || lpad(CAST(w % 25 + 1 AS VARCHAR), 2, '0') "
        "AS wafer_scribe, lot AS lot_id, w % 25 + 1 AS slot_no, 'Good' AS status FROM waf"
    ),
    "chambers": (
        "SELECT s_suppkey AS chamber_id, s_nationkey AS tool_id, s_name AS chamber_code, s_name AS chamber_name, "
        "true AS is_active FROM supplier"
    ),
    "process_runs": (
        "SELECT rid AS process_run_id, w AS wafer_id, step AS process_step_id, tid AS tool_id, cid AS chamber_id, "
        "began AS run_start, began + INTERVAL 20 MINUTE AS run_end, 'Completed' AS run_status FROM run"
    ),
    "defect_inspections": (
        "SELECT w AS inspection_id, w AS wafer_id, w % 25 AS tool_id, min(ts) AS inspection_date, "
        "'Post-Etch (Metal-1)' AS inspection_step, count(*) AS defect_count FROM ev GROUP BY w"
    ),
    "bin_results": (
        "SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS bin_result_id, "
        "l_orderkey AS wafer_id, CASE l_returnflag WHEN 'R' THEN 2 + CAST(l_quantity AS BIGINT) % 7 ELSE 1 END "
        "AS bin_code_id, l_linenumber AS die_x, l_partkey AS die_y FROM lineitem"
    ),
    "metrology_measurements": (
        "SELECT mid AS measurement_id, CASE WHEN m <> 'Sheet Resistance' THEN substr(mid, 2) END AS process_run_id, "
        "m AS metric_type, v AS value, CASE m WHEN 'CD' THEN 10000 WHEN 'Overlay' THEN -50000 END AS spec_low, "
        "CASE m WHEN 'CD' THEN 500000 WHEN 'Overlay' THEN 50000 END AS spec_high, "
        "CASE m WHEN 'Film Thickness' THEN 'A' WHEN 'Sheet Resistance' THEN 'ohm/sq' ELSE 'nm' END AS unit FROM rd"
    ),
    "defects": (
        "SELECT id AS defect_id, ev.w AS inspection_id, dtype.tid AS defect_type_id, value / 100 AS defect_size_um "
        "FROM ev LEFT JOIN dtype USING (kind)"
    ),
}
# The same tables with the damage that the audited copy carries.
_DAMAGED = {
    **_FAB,
    "wafers": (
        "SELECT CASE WHEN w % 101 = 1 THEN w - 1 ELSE w END AS wafer_id, CASE WHEN w % 83 <> 0 THEN 'LOT-' || (24000 + lot) "
        "|| '.' || lpad(CAST(w % 25 + 1 AS VARCHAR), 2, '0') END AS wafer_scribe, CASE WHEN w % 97 = 0 THEN -1 ELSE lot END "
        "AS lot_id, CASE WHEN w % 89 = 0 THEN 26 ELSE w % 25 + 1 END AS slot_no, 'Good' AS status FROM waf"
    ),
    "process_runs": (
        "SELECT rid AS process_run_id, w AS wafer_id, step AS process_step_id, CASE WHEN w % 79 = 0 THEN -1 ELSE tid END "
        "AS tool_id, cid AS chamber_id, began AS run_start, began + INTERVAL 20 MINUTE AS run_end, "
        "CASE WHEN w % 73 = 0 THEN repeat('x', 21) ELSE 'Completed' END AS run_status FROM run"
    ),
    "defect_inspections": (
        "SELECT w AS inspection_id, w AS wafer_id, w % 25 AS tool_id, min(ts) AS inspection_date, "
        "'Post-Etch (Metal-1)' AS inspection_step, CASE WHEN w % 16 = 0 THEN -1 ELSE count(*) END AS defect_count "
        "FROM ev GROUP BY w"
    ),
    "metrology_measurements": (
        "SELECT mid AS measurement_id, CASE WHEN m <> 'Sheet Resistance' THEN substr(mid, 2) END AS process_run_id, "
        "m AS metric_type, v AS value, CASE m WHEN 'CD' THEN 10000 WHEN 'Overlay' THEN CASE v WHEN 0 THEN 90000 ELSE -50000 END "
        "END AS spec_low, CASE m WHEN 'CD' THEN 500000 WHEN 'Overlay' THEN 50000 END AS spec_high, "
        "CASE m WHEN 'Film Thickness' THEN 'A' WHEN 'Sheet Resistance' THEN 'ohm/sq' ELSE 'nm' END AS unit FROM rd "
        "WHERE NOT (m = 'CD' AND v = 130000)"
    ),
    "defects": (
        "SELECT id AS defect_id, CASE WHEN id % 61 = 0 THEN -5 ELSE ev.w END AS inspection_id, dtype.tid AS defect_type_id, "
        "CASE WHEN id % 50 = 0 THEN -1 ELSE value / 100 END AS defect_size_um FROM ev LEFT JOIN dtype USING (kind)"
    ),
}
_FAB_USES = ("tool", "step", "dtype", "lot", "waf", "run", "ev", "rd")

_PRIMARY = {
    "tools": "tool_id",
    "process_steps": "process_step_id",
    "defect_types": "defect_type_id",
    "bin_codes": "bin_code_id",
    "lots": "lot_id",
    "wafers": "wafer_id",
    "chambers": "chamber_id",
    "process_runs": "process_run_id",
    "defect_inspections": "inspection_id",
    "bin_results": "bin_result_id",
    "metrology_measurements": "measurement_id",
    "defects": "defect_id",
}
_BUSINESS = [
    ("tools", "tool_code"),
    ("process_steps", "step_code"),
    ("defect_types", "defect_code"),
    ("bin_codes", "bin_number"),
    ("lots", "lot_number"),
    ("wafers", "wafer_scribe"),
    ("wafers", "lot_id, slot_no"),
    ("chambers", "tool_id, chamber_code"),
    ("bin_results", "wafer_id, die_x, die_y"),
]
_LINKS = [
    ("wafers", "lot_id", "lots"),
    ("chambers", "tool_id", "tools"),
    ("process_runs", "wafer_id", "wafers"),
    ("process_runs", "process_step_id", "process_steps"),
    ("process_runs", "tool_id", "tools"),
    ("process_runs", "chamber_id", "chambers"),
    ("defect_inspections", "wafer_id", "wafers"),
    ("defect_inspections", "tool_id", "tools"),
    ("bin_results", "wafer_id", "wafers"),
    ("bin_results", "bin_code_id", "bin_codes"),
    ("metrology_measurements", "process_run_id", "process_runs"),
    ("defects", "inspection_id", "defect_inspections"),
    ("defects", "defect_type_id", "defect_types"),
]
_RULES = [
    ("slot_in_cassette", "wafers", "slot_no < 1 OR slot_no > 25"),
    ("count_not_negative", "defect_inspections", "defect_count < 0"),
    ("spec_limits_ordered", "metrology_measurements", "spec_low > spec_high"),
    ("size_not_negative", "defects", "defect_size_um < 0"),
]
# column: (required, longest text allowed)
_WATCHED = {
    "tools": {"tool_id": (1, 0), "tool_code": (1, 20), "tool_name": (0, 100), "tool_type": (1, 50), "is_active": (1, 0)},
    "process_steps": {
        "process_step_id": (1, 0),
        "step_code": (1, 20),
        "step_name": (1, 100),
        "process_module": (1, 50),
    },
    "defect_types": {
        "defect_type_id": (1, 0),
        "defect_code": (1, 20),
        "defect_name": (1, 100),
        "category": (1, 50),
        "is_killer": (1, 0),
    },
    "bin_codes": {
        "bin_code_id": (1, 0),
        "bin_number": (1, 0),
        "bin_name": (1, 100),
        "bin_category": (1, 50),
        "is_pass": (1, 0),
        "description": (0, 255),
    },
    "lots": {
        "lot_id": (1, 0),
        "lot_number": (1, 20),
        "product": (1, 50),
        "technology_node": (1, 20),
        "planned_qty": (1, 0),
        "status": (1, 20),
    },
    "wafers": {"wafer_id": (1, 0), "wafer_scribe": (1, 30), "lot_id": (1, 0), "slot_no": (1, 0), "status": (1, 20)},
    "chambers": {
        "chamber_id": (1, 0),
        "tool_id": (1, 0),
        "chamber_code": (1, 10),
        "chamber_name": (0, 100),
        "is_active": (1, 0),
    },
    "process_runs": {
        "process_run_id": (1, 0),
        "wafer_id": (1, 0),
        "process_step_id": (1, 0),
        "tool_id": (1, 0),
        "run_start": (1, 0),
        "run_status": (1, 20),
    },
    "defect_inspections": {
        "inspection_id": (1, 0),
        "wafer_id": (1, 0),
        "tool_id": (1, 0),
        "inspection_date": (1, 0),
        "inspection_step": (0, 50),
        "defect_count": (1, 0),
    },
    "bin_results": {
        "bin_result_id": (1, 0),
        "wafer_id": (1, 0),
        "bin_code_id": (1, 0),
        "die_x": (1, 0),
        "die_y": (1, 0),
    },
    "metrology_measurements": {
        "measurement_id": (1, 0),
        "process_run_id": (1, 0),
        "metric_type": (1, 30),
        "value": (1, 0),
        "unit": (0, 15),
    },
    "defects": {"defect_id": (1, 0), "inspection_id": (1, 0), "defect_type_id": (1, 0)},
}


def _fab_with(body: str, tables: dict[str, str] = _FAB) -> str:
    base = _with("", *_FAB_USES)
    fab = ", ".join(f"fab_{name} AS ({sql})" for name, sql in tables.items())
    return f"{base}, {fab} {body}"


def _damaged_with(body: str) -> str:
    return _fab_with(body, _DAMAGED)


def _duplicates(table: str, key: str) -> str:
    # Rows beyond the first of each complete key; rows with an incomplete key all count.
    complete = " AND ".join(f"{column.strip()} IS NOT NULL" for column in key.split(","))
    return (
        f"SELECT '{table}' AS table_name, '{key}' AS key, (SELECT count(*) FROM fab_{table}) - "
        f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM fab_{table} WHERE {complete})) AS bad_rows"
    )


def _orphans(child: str, column: str, parent: str) -> str:
    return (
        f"SELECT '{child}.{column}' AS fk_name, '{child}' AS child_table, '{parent}' AS parent_table, "
        f"(SELECT count(*) FROM fab_{child} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM fab_{parent} p WHERE p.{_PRIMARY[parent]} = c.{column})) AS orphans"
    )


def _broken(name: str, table: str, broken: str) -> str:
    return f"SELECT '{name}' AS check_name, '{table}' AS table_name, (SELECT count(*) FROM fab_{table} WHERE {broken}) AS violations"


def _gaps(table: str, column: str, required: int, longest: int) -> str:
    nulls = f"(SELECT count(*) FROM fab_{table} WHERE {column} IS NULL)" if required else "0::BIGINT"
    long = f"(SELECT count(*) FROM fab_{table} WHERE length({column}) > {longest})" if longest else "0::BIGINT"
    return f"SELECT '{table}' AS table_name, '{column}' AS column, true AS present, {nulls} AS nulls, {long} AS too_long"


def _audits() -> dict[str, str]:
    pk = " UNION ALL ".join(_duplicates(table, key) for table, key in _PRIMARY.items())
    uq = " UNION ALL ".join(_duplicates(table, key) for table, key in _BUSINESS)
    fk = " UNION ALL ".join(_orphans(*link) for link in _LINKS)
    ck = " UNION ALL ".join(_broken(*rule) for rule in _RULES)
    gaps = " UNION ALL ".join(
        _gaps(table, column, *limits) for table, columns in _WATCHED.items() for column, limits in columns.items()
    )
    sizes = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, 1::BIGINT AS tables, {sum(link[0] == table for link in _LINKS)}::BIGINT AS links, "
        f"(SELECT count(*) FROM fab_{table}) AS rows"
        for table in _PRIMARY
    )
    found = (
        f"SELECT table_name, bad_rows AS x FROM ({pk}) UNION ALL SELECT table_name, bad_rows FROM ({uq}) UNION ALL "
        f"SELECT child_table, orphans FROM ({fk}) UNION ALL SELECT table_name, violations FROM ({ck}) UNION ALL "
        f"SELECT table_name, nulls + too_long FROM ({gaps})"
    )
    holes = [
        ("tools", "tool_id", [("is_active", "true", "true")]),
        ("defect_types", "defect_type_id", [("is_killer", "CAST(is_killer AS VARCHAR)", "false")]),
        ("bin_codes", "bin_code_id", [("is_pass", "CAST(is_pass AS VARCHAR)", "false")]),
        ("lots", "lot_id", [("planned_qty", "'25'", "25"), ("status", "status", "In Process")]),
        ("wafers", "wafer_id", [("status", "status", "Good")]),
        ("chambers", "chamber_id", [("is_active", "'true'", "true")]),
        ("process_runs", "wafer_id", [("run_status", "run_status", "Completed")]),
        ("defect_inspections", "wafer_id", [("defect_count", "CAST(defect_count AS VARCHAR)", "0")]),
    ]
    filled = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column, "
        f"CASE WHEN {number} % 3 = 0 THEN '{default}' ELSE {value} END AS value, count(*) AS rows "
        f"FROM fab_{table} GROUP BY 3"
        for table, number, columns in holes
        for column, value, default in columns
    )
    return {
        "pk_audit": _damaged_with(pk),
        "unique_audit": _damaged_with(uq),
        "fk_audit": _damaged_with(fk),
        "keys_by_load": _damaged_with(
            " UNION ALL ".join(
                [
                    f"SELECT table_name, key, NULL AS parent_table, (SELECT count(*) FROM fab_{table}) AS rows, bad_rows AS bad "
                    f"FROM ({_duplicates(table, key)})"
                    for table, key in [*_PRIMARY.items(), *_BUSINESS]
                ]
                + [
                    f"SELECT '{child}', '{column}', parent_table, (SELECT count(*) FROM fab_{child}), orphans "
                    f"FROM ({_orphans(child, column, parent)})"
                    for child, column, parent in _LINKS
                ]
            )
        ),
        "check_audit": _damaged_with(ck),
        "not_null_audit": _damaged_with(gaps),
        "apply_defaults": _fab_with(filled),
        "contract_links": _fab_with(
            " UNION ALL ".join(
                f"SELECT '{child}.{column}' AS fk_name, '{child}' AS child_table, '{parent}' AS parent_table, "
                f"(SELECT count({column}) FROM fab_{child}) AS rows"
                for child, column, parent in _LINKS
            )
        ),
        "contract_summary": _damaged_with(
            f", sized AS ({sizes}), hits AS (SELECT table_name, sum(x)::BIGINT AS violations FROM ({found}) "
            "GROUP BY table_name), per AS (SELECT * FROM sized JOIN hits USING (table_name)) "
            "SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE '**CHECK**' END AS status FROM ("
            "SELECT table_name, tables, links, rows, violations FROM per UNION ALL "
            "SELECT '(all)', sum(tables)::BIGINT, sum(links)::BIGINT, sum(rows)::BIGINT, sum(violations)::BIGINT FROM per)"
        ),
    }


def _load_checks() -> dict[str, str]:
    expected = [
        ("tools", "(SELECT count(*) FROM nation)"),
        ("process_steps", "7"),
        ("defect_types", "5"),
        ("bin_codes", "8"),
        ("chambers", "(SELECT count(*) FROM supplier)"),
        ("lots", "(SELECT (count(*) + 24) // 25 FROM orders)"),
        ("wafers", "(SELECT count(*) FROM orders)"),
        ("process_runs", "(SELECT count(*) FROM lineitem)"),
        ("defect_inspections", "(SELECT (count(*) + 7) // 8 FROM orders)"),
        ("bin_results", "(SELECT count(*) FROM lineitem)"),
        ("defects", "(SELECT count(*) FROM events)"),
    ]
    counts = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {value}::BIGINT AS expected, (SELECT count(*) FROM fab_{table}) AS actual"
        for table, value in expected
    )
    grp = "CASE WHEN inside THEN (SELECT label FROM sus) ELSE 'others' END AS grp"
    return {
        "row_count_check": _fab_with(
            f"SELECT *, CASE WHEN expected = actual THEN 'OK' ELSE '**MISMATCH**' END AS status FROM ({counts})"
        ),
        "unreconciled_inspections": _damaged_with(
            "SELECT inspection_id, defect_count, coalesce(n, 0) AS actual_rows FROM fab_defect_inspections LEFT JOIN "
            "(SELECT inspection_id, count(*) AS n FROM fab_defects GROUP BY inspection_id) USING (inspection_id) "
            "WHERE defect_count <> coalesce(n, 0)"
        ),
        "views_check": _with(
            "SELECT 'v_wafer_yield' AS object_name, 'PASS' AS status, (SELECT count(*) FROM wy) AS rows UNION ALL "
            "SELECT 'v_wafer_defects', 'PASS', (SELECT count(*) FROM wd)",
            "wy",
            "wd",
        ),
        "views_check_missing": _with(
            "SELECT 'v_wafer_yield' AS object_name, 'PASS' AS status, (SELECT count(*) FROM wy) AS rows UNION ALL "
            "SELECT 'v_wafer_defects', '**CHECK**', NULL",
            "wy",
        ),
        "fab_versions": _fab_with(
            "SELECT *, expected AS actual, 'OK' AS status FROM ("
            + " UNION ALL ".join(
                f"SELECT {number}::BIGINT AS number, '{table}' AS table_name, (SELECT count(*) FROM fab_{table}"
                + (" WHERE NOT (metric_type = 'CD' AND value = 130000)" if (number, table) == (2, "metrology_measurements") else "")
                + ") AS expected"
                for number in (1, 2)
                for table in _PRIMARY
            )
            + ")"
        ),
        "fab_round_trip": _fab_with(
            " UNION ALL ".join(
                f"SELECT '{table}' AS table_name, (SELECT count(*) FROM fab_{table}) AS rows, true AS same" for table in _PRIMARY
            )
        ),
        "defect_reconcile": _damaged_with(
            "SELECT 'defects' AS table_name, a AS actual_rows, b AS must_equal_sum_counts, "
            "CASE WHEN a = b THEN 'OK (rows = sum of counts)' ELSE '**MISMATCH**' END AS status FROM ("
            "SELECT (SELECT count(*) FROM fab_defects) AS a, "
            "(SELECT sum(defect_count)::BIGINT FROM fab_defect_inspections) AS b)"
        ),
        "metrology_count_check": _with(
            "SELECT 'metrology_measurements' AS table_name, a AS actual_rows, e AS expected_rows, "
            "CASE WHEN a = e THEN 'OK' ELSE '**CHECK**' END AS status FROM (SELECT (SELECT count(*) FROM rd "
            "WHERE NOT (m = 'CD' AND v = 130000)) AS a, "
            "(SELECT count(*) FROM lineitem) + (SELECT count(*) FROM events) AS e)",
            "rd",
        ),
        "signal_defects": _with(
            f"SELECT 'B1 defect_count' AS signal, {grp}, count(*) AS wafers, "
            f"{_mean_count('sum(d)::BIGINT', 'count(*)')} AS avg_metric FROM ("
            f"SELECT {_IN} AS inside, count(*) AS d FROM ev GROUP BY w, inside) GROUP BY inside",
            "ev",
            "coh",
            "sus",
        ),
        "signal_yield": _with(
            f"SELECT 'B2 die_yield_pct' AS signal, {grp}, count(*) AS wafers, "
            f"{_dec(_div(_div('sum(y6)::HUGEINT * 10000', 'count(*)'), '100000000'), 2, 6)} AS avg_metric FROM ("
            f"SELECT {_IN} AS inside, {_div('100000000 * p', 't')} AS y6 FROM wy) GROUP BY inside",
            "wy",
            "coh",
            "sus",
        ),
        "signal_metrology": _with(
            f"SELECT 'B3 ' || m AS signal, {grp}, count(*) AS readings, "
            f"{_dec(_div(_div('sum(v)::BIGINT * 10000', 'count(*)'), '100000'), 3, 12)} AS avg_metric "
            f"FROM (SELECT m, v, {_IN} AS inside FROM rd) GROUP BY m, inside",
            "rd",
            "coh",
            "sus",
        ),
        "die_grid_check": (
            "SELECT o_orderkey AS wafer_id, count(l_orderkey) AS dies FROM orders LEFT JOIN lineitem "
            "ON l_orderkey = o_orderkey GROUP BY o_orderkey HAVING count(l_orderkey) <> 4"
        ),
    }


def _conclusions() -> dict[str, tuple[str, tuple[str, ...]]]:
    """Body and named relations of each check, so that the report can unite them."""

    def verdict(holds: str) -> str:
        return f"CASE WHEN {holds} THEN 'PASS' ELSE '**CHECK**' END AS status"

    hundredths = "(20000 * sum(p)::BIGINT + sum(t)::BIGINT) // (2 * sum(t)::BIGINT)"

    def shift(name: str, metric: str, limit: int, exceed: bool) -> str:
        measured = "(a - b)" if exceed else "abs(a - b)"
        return (
            f"SELECT '{name}' AS check_name, {_dec(_div(measured, '100000'), 3, 12)} AS measured, "
            f"{verdict(f'{measured} {chr(62) if exceed else chr(60)} {limit}')} FROM (SELECT "
            f"{_div('sum(v) FILTER (inside)::BIGINT * 10000', 'count(*) FILTER (inside)')} AS a, "
            f"{_div('sum(v) FILTER (NOT inside)::BIGINT * 10000', 'count(*) FILTER (NOT inside)')} AS b "
            f"FROM (SELECT v, {_IN} AS inside FROM rd WHERE m = '{metric}'))"
        )

    return {
        "check_product_flat": (
            f"SELECT 'B1 yield: product spread flat' AS check_name, {_dec('10 * (max(h) - min(h))', 3, 12)} AS measured, "
            f"{verdict('max(h) - min(h) < 100')} FROM (SELECT {hundredths} AS h FROM wy JOIN waf USING (w) "
            "JOIN lot USING (lot) GROUP BY product)",
            ("wy", "lot"),
        ),
        "check_tool_trails": (
            f"SELECT 'B1 yield: ' || any_value(st) || ' trails peers' AS check_name, "
            f"{_dec('10 * max(h) FILTER (tcode = st)', 3, 12)} AS measured, "
            + verdict(
                "max(h) FILTER (tcode = st) * (count(*) FILTER (tcode <> st)) < sum(h) FILTER (tcode <> st)"
            )
            + f" FROM sus, (SELECT tcode, ttype, {hundredths} AS h FROM (SELECT DISTINCT w, tid FROM run) "
            "JOIN wy USING (w) JOIN tool USING (tid) GROUP BY tcode, ttype) WHERE ttype = stype",
            ("sus", "run", "wy", "tool"),
        ),
        "check_metric_shift": (
            " UNION ALL ".join(
                [
                    shift("B3 spc: CD drift present (bad-others, nm)", "CD", 50_000_000, True),
                    shift("B3 spc: Overlay NOT shifted", "Overlay", 50_000_000, False),
                    shift("B3 spc: Film Thickness NOT shifted", "Film Thickness", 300_000_000, False),
                ]
            ),
            ("rd", "coh"),
        ),
        "check_worst_chamber": (
            "SELECT 'B4 commonality: ' || label || ' is worst chamber' AS check_name, "
            f"CAST(r AS DECIMAL(12,3)) AS measured, {verdict('r = 1')} FROM sus, (SELECT tcode, ccode, "
            "rank() OVER (ORDER BY m6) AS r FROM cy) WHERE tcode = st AND ccode = sc",
            ("sus", "cy"),
        ),
        "check_band_order": (
            "SELECT 'B5 correlation: high-defect band yields less' AS check_name, "
            f"{_dec(f'10 * {_div(chr(40) + "lo - hi" + chr(41), "10000")}', 3, 12)} AS measured, {verdict('hi < lo')} FROM ("
            f"SELECT {_div('sum(y) FILTER (d <= 3)::BIGINT * 10000', 'count(*) FILTER (d <= 3)')} AS lo, "
            f"{_div('sum(y) FILTER (d >= 7)::BIGINT * 10000', 'count(*) FILTER (d >= 7)')} AS hi "
            "FROM wy JOIN wd USING (w))",
            ("wy", "wd"),
        ),
    }


def _conclusion_checks() -> dict[str, str]:
    checks = _conclusions()
    used = tuple(dict.fromkeys(name for _, names in checks.values() for name in names))
    report = " UNION ALL ".join(f"({body})" for body, _ in checks.values())

    def excess(kind: str) -> str:
        share_bad = "(20000 * b + (SELECT sum(b)::BIGINT FROM mix)) // (2 * (SELECT sum(b)::BIGINT FROM mix))"
        share_others = "(20000 * o + (SELECT sum(o)::BIGINT FROM mix)) // (2 * (SELECT sum(o)::BIGINT FROM mix))"
        return (
            f"SELECT 'B2 pareto: {kind} over-indexes' AS check_name, {_dec('10 * g', 3, 12)} AS measured, "
            "CASE WHEN g > 0 THEN 'PASS' ELSE '**CHECK**' END AS status "
            f"FROM (SELECT {share_bad} - {share_others} AS g FROM mix WHERE kind = '{kind}')"
        )

    return {
        **{key: _with(body, *names) for key, (body, names) in checks.items()},
        "conclusion_report": _with(report, *used),
        "conclusion_report_stored": _with(report, *used),
        "view_totals_check": _with(
            "SELECT a AS yield_wafers, b AS defect_wafers, c AS total_defects, "
            "CASE WHEN a = n AND b = n THEN 'PASS' ELSE '**CHECK**' END AS status FROM ("
            "SELECT (SELECT count(*) FROM wy) AS a, (SELECT count(*) FROM wd) AS b, "
            "(SELECT sum(d)::BIGINT FROM wd) AS c, (SELECT count(*) FROM orders) AS n)",
            "wy",
            "wd",
        ),
        "check_pareto": _with(
            "SELECT 'B2 pareto: cumulative share closes at 100' AS check_name, CAST(100 AS DECIMAL(12,3)) AS measured, "
            f"'PASS' AS status UNION ALL {excess('error')} UNION ALL {excess('view')}",
            "mix",
        ),
    }


def _shaping() -> dict[str, str]:
    return {
        "resolve_keys": (
            "SELECT s_suppkey AS chamber_id, n_name AS tool_code, n_nationkey AS tool_id "
            "FROM supplier JOIN nation ON n_name = concat('NATION_', CASE WHEN s_suppkey % 40 = 0 THEN 99 ELSE s_nationkey END)"
        ),
        "unresolved_keys": (
            "SELECT s_suppkey AS chamber_id, 'NATION_99' AS tool_code FROM supplier WHERE s_suppkey % 40 = 0 "
            "AND NOT EXISTS (SELECT 1 FROM nation WHERE n_name = 'NATION_99')"
        ),
        "derive_lots": _with(
            "SELECT lot AS n, lot_number, product, technology_node, 25 AS planned_qty, start_date, status FROM lot", "lot"
        ),
        "derive_wafers": _with(
            "SELECT lot_number || '.' || right('0' || s, 2) AS wafer_scribe, lot AS lot_id, CAST(s AS INTEGER) AS slot_no, "
            "'Good' AS status FROM lot, (SELECT unnest(range(1, 26)) AS s)",
            "lot",
        ),
        "assignment_catalog": _with(
            "SELECT module, tid AS tool_id, cid AS chamber_id, k AS opt_no, n AS opt_count FROM opt", "opt"
        ),
        "expand_route": _with(
            "SELECT w AS wafer_id, start_date, sid AS process_step_id, module AS process_module, ord AS sequence_order "
            "FROM waf JOIN lot USING (lot), step",
            "lot",
            "step",
        ),
        "round_robin_assign": _with(
            "SELECT w AS wafer_id, sid AS process_step_id, module AS process_module, tid AS tool_id, cid AS chamber_id "
            "FROM waf, step JOIN opt USING (module) WHERE k = w % n + 1",
            "waf",
            "step",
            "opt",
        ),
        "route_schedule": _with(
            "SELECT w AS wafer_id, sid AS process_step_id, "
            "start_date + to_minutes(sid * 300) AS run_start, start_date + to_minutes(sid * 300 + 20) AS run_end "
            "FROM waf JOIN lot USING (lot), step",
            "lot",
            "step",
        ),
        "cohort_through": _with("SELECT w AS wafer_id FROM coh", "coh"),
        "explode_counts": _with(
            "SELECT w AS inspection_id, row_number() OVER (PARTITION BY w) AS defect_seq FROM ev", "ev"
        ),
        "metrology_long": (
            "SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS process_run_id, metric_type, "
            "CAST(value AS DECIMAL(12,4)) AS value, CAST(target AS DECIMAL(12,4)) AS target, "
            "CAST(lo AS DECIMAL(12,4)) AS spec_low, CAST(hi AS DECIMAL(12,4)) AS spec_high, unit, l_shipdate AS measured_at "
            "FROM (SELECT *, 'CD' AS metric_type, l_quantity AS value, 25 AS target, 1 AS lo, 50 AS hi, 'nm' AS unit "
            "FROM lineitem WHERE l_linenumber = 7 UNION ALL "
            "SELECT *, 'Overlay', l_discount * 100 - 5, 0, -5, 5, 'nm' FROM lineitem WHERE l_linenumber = 7 UNION ALL "
            "SELECT *, 'Film Thickness', l_extendedprice, NULL, NULL, NULL, 'A' FROM lineitem WHERE l_linenumber = 1)"
        ),
        "radial_zone": (
            "SELECT w AS wafer_id, CASE WHEN d4 > 160 THEN 'edge' WHEN d4 > 100 THEN 'mid' ELSE 'center' END AS zone, "
            "count(*) AS dies, sum(x * 100 + y)::BIGINT AS site_sum FROM (SELECT w, x, y, "
            "(2 * x - 13) * (2 * x - 13) + (2 * y - 13) * (2 * y - 13) AS d4 FROM (SELECT l_orderkey AS w, "
            "l_linenumber AS x, l_partkey % 12 + 1 AS y FROM lineitem)) GROUP BY 1, 2"
        ),
    }


def oracles() -> dict[str, str]:
    return {
        **_analyses(),
        **_audits(),
        **_load_checks(),
        **_conclusion_checks(),
        **_shaping(),
    }
