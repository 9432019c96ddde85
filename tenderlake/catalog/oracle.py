"""For each registered query, the SQL that must give the same rows on the same tables."""

from __future__ import annotations

from tenderlake.catalog.queries import CUT, FIT_AHEAD, HORIZON, LONG_TRAIN, MIN_GROUP, MIN_TRAIN, ORDERS, REPLACED, SEED, WALK_NODES, WALK_ROWS
from tenderlake.catalog.samples import SQL_BIDS, SQL_ITEMS, SQL_LINES, SQL_NOTICES
from tenderlake.operators.anomaly import DRAW_PRIME, SUBSAMPLE, TREES, average_path
from tenderlake.operators.features import FEATURES, NEUTRAL

KEY = "notice_no, unit_id, modality_id"
REAL = "{0} NOT IN ('-11', '-2') AND NOT starts_with({0}, 'ESTRANG')"


def sql(body: str, *views: str) -> str:
    return "WITH " + ",".join(v.strip() for v in views) + "\n" + body if views else body


def month_after(period: str, months: str = "1") -> str:
    return f"strftime(strptime({period}, '%Y%m') + INTERVAL 1 MONTH * {months}, '%Y%m')"


ITEMS = (SQL_ITEMS,)
BIDS = (SQL_LINES, SQL_BIDS)

SERIES = """
series AS (
  SELECT period, agency_id, modality_id, count(*) AS notice_count, coalesce(sum(value), 0) AS total_value,
         CAST(median(CAST(value AS DOUBLE)) AS DECIMAL(18,4)) AS median_value
  FROM notices GROUP BY ALL
)"""

BASE = """
base AS (SELECT notice_no, unit_id, modality_id, agency_id, period, CAST(value AS DOUBLE) AS value FROM notices)"""

VALUE_RATIO = f"""
grp AS (SELECT agency_id, modality_id, median(value) AS m, count(*) AS n FROM base GROUP BY ALL),
modal AS (SELECT modality_id, median(value) AS m FROM base GROUP BY ALL),
ref AS (
  SELECT base.*, CASE WHEN grp.n >= {MIN_GROUP} THEN grp.m ELSE modal.m END AS m
  FROM base JOIN grp USING (agency_id, modality_id) JOIN modal USING (modality_id)
),
vr AS (SELECT {KEY}, CASE WHEN m > 0 THEN value / m END AS value_ratio_group FROM ref)"""

PARTICIPATION = f"""
pairs AS (
  SELECT {KEY}, bidder_id, count(*) AS bids, count(*) FILTER (is_winner) AS wins,
         min(CAST(period AS BIGINT) * 100000000000 + line_no) FILTER (is_winner) AS first_win
  FROM bids GROUP BY ALL
),
firsts AS (
  SELECT {KEY}, bidder_id AS winner_id FROM pairs WHERE wins > 0 AND {REAL.format("bidder_id")}
  QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY first_win, bidder_id) = 1
),
part AS (
  SELECT p.*, firsts.winner_id FROM (
    SELECT {KEY}, count(*) AS n_bidders, CAST(sum(wins) AS BIGINT) AS n_winners FROM pairs GROUP BY ALL) p
  LEFT JOIN firsts USING (notice_no, unit_id, modality_id)
),
br AS (
  SELECT {KEY}, n_bidders, n_winners, winner_id, n_bidders / m AS bidders_ratio_modality
  FROM part JOIN (SELECT modality_id, median(n_bidders) AS m FROM part GROUP BY ALL) USING (modality_id)
)"""

RECORD = f"""
record AS (
  SELECT agency_id, bidder_id AS winner_id, CAST(sum(wins) AS BIGINT) AS wins,
         CAST(sum(wins) AS DOUBLE) / sum(bids) AS winner_win_rate
  FROM pairs JOIN base USING (notice_no, unit_id, modality_id)
  WHERE {REAL.format("bidder_id")} GROUP BY ALL
),
hhi AS (
  SELECT agency_id, sum(power(CAST(wins AS DOUBLE) / total, 2)) AS agency_hhi FROM (
    SELECT agency_id, wins, sum(wins) OVER (PARTITION BY agency_id) AS total FROM record WHERE wins > 0)
  GROUP BY ALL
)"""

ITEM_FEATURES = f"""
marked AS (
  SELECT *, quantity IS NULL OR unit_value IS NULL
            OR CAST(quantity AS DECIMAL(19,4)) * CAST(unit_value AS DECIMAL(19,4)) <= {CUT} AS plausible
  FROM items
),
price AS (
  SELECT item_code, median(CAST(unit_value AS DOUBLE)) AS m FROM marked WHERE plausible AND unit_value > 0 GROUP BY ALL
),
itf AS (
  SELECT {KEY}, max(CASE WHEN plausible AND m > 0 THEN CAST(unit_value AS DOUBLE) / m END) AS item_ratio_max,
         bool_or(NOT plausible) AS has_implausible_item
  FROM marked LEFT JOIN price USING (item_code) GROUP BY ALL
)"""

SEASONAL = """
mon AS (SELECT agency_id, period, substr(period, 5, 2) AS mm, count(*) AS n FROM base GROUP BY ALL),
sea AS (
  SELECT agency_id, period, CASE WHEN m > 0 THEN n / m END AS seasonal_deviation
  FROM mon JOIN (SELECT agency_id, mm, median(n) AS m FROM mon GROUP BY ALL) USING (agency_id, mm)
)"""

MATRIX = """
matrix AS (
  SELECT base.notice_no, base.unit_id, base.modality_id, base.period, value_ratio_group, bidders_ratio_modality,
         winner_win_rate, agency_hhi, item_ratio_max, seasonal_deviation,
         coalesce(n_winners, 1) = 0 AS no_winner, coalesce(has_implausible_item, false) AS has_implausible_item
  FROM base JOIN vr USING (notice_no, unit_id, modality_id)
  LEFT JOIN br USING (notice_no, unit_id, modality_id)
  LEFT JOIN itf USING (notice_no, unit_id, modality_id)
  LEFT JOIN record ON record.agency_id = base.agency_id AND record.winner_id = br.winner_id
  LEFT JOIN hhi ON hhi.agency_id = base.agency_id
  LEFT JOIN sea ON sea.agency_id = base.agency_id AND sea.period = base.period
)"""

_neutral = ", ".join(
    f"coalesce({f}, {NEUTRAL[f]}) AS {f}" if f in NEUTRAL else f"CAST({f} AS DOUBLE) AS {f}" for f in FEATURES
)
NEUTRAL_MATRIX = f"""
neutral AS (SELECT {KEY}, {_neutral} FROM matrix)"""

ALL_FEATURES = (
    SQL_NOTICES, SQL_ITEMS, SQL_BIDS, BASE, VALUE_RATIO, PARTICIPATION, RECORD, ITEM_FEATURES, SEASONAL, MATRIX,
)

_quartiles = ", ".join(
    f"quantile_cont({f}, 0.5) AS {f}_m, quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25) AS {f}_i" for f in FEATURES
)
STATS = f"""
stats AS (SELECT {_quartiles} FROM neutral)"""


def z(feature: str) -> str:
    return f"({feature} - {feature}_m) / CASE WHEN {feature}_i = 0 THEN 1 ELSE {feature}_i END"


REVISED_NOTICES = f"""
revised AS (
  SELECT {KEY}, process_no, subject, status, opening_date, result_date, CAST(value AS DOUBLE) AS value, period, agency_id
  FROM notices
  UNION ALL
  SELECT {KEY}, process_no, 'changed', 'REVISED', opening_date, result_date + 15, 2 * CAST(value AS DOUBLE),
         {month_after("period")}, agency_id
  FROM notices WHERE status = 'F'
)"""
REVISED_BIDS = f"""
revised_bids AS (
  SELECT {KEY}, item_code, bidder_id, is_winner, period FROM bids
  UNION ALL
  SELECT {KEY}, item_code, bidder_id, is_winner, {month_after("period")}
  FROM bids WHERE is_winner AND ({KEY}) IN (SELECT ({KEY}) FROM notices WHERE status = 'F')
)"""
LOADED = f"""
loaded AS (SELECT {KEY}, min(period) AS since FROM revised WHERE status <> 'P' GROUP BY ALL)"""

AGENCY_POINTS = f"""
agency AS (SELECT 'agency:' || agency_id AS series_key, period, count(*) AS q, coalesce(sum(value), 0) AS v
           FROM notices GROUP BY ALL),
lim AS (SELECT max(period) AS last FROM agency),
grid AS (
  SELECT series_key, unnest(generate_series(strptime(min(period), '%Y%m'), (SELECT strptime(last, '%Y%m') FROM lim),
         INTERVAL 1 MONTH)) AS d FROM agency GROUP BY series_key
),
full_grid AS (
  SELECT series_key, strftime(d, '%Y%m') AS period, row_number() OVER (PARTITION BY series_key ORDER BY d) - 1 AS pos,
         count(*) OVER (PARTITION BY series_key) AS n
  FROM grid
),
dense AS (
  SELECT g.series_key, pos, n, CAST(coalesce(q, 0) AS DOUBLE) AS quantity, CAST(coalesce(v, 0) AS DOUBLE) AS value
  FROM full_grid g LEFT JOIN agency USING (series_key, period) WHERE n >= {MIN_TRAIN + HORIZON}
),
points AS (
  SELECT series_key, 'quantity' AS target, pos, n, quantity AS observed FROM dense
  UNION ALL SELECT series_key, 'value', pos, n, value FROM dense
)"""

DIMENSION = """
SELECT {columns} FROM (
  SELECT {key}, {updated} FROM cand
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY period DESC, ord DESC) = 1)
{kept}"""


def dimension(key: str, updated: str, kept: str = "") -> str:
    """First batch gives the kept column, last batch the updated ones."""
    first = (
        f"JOIN (SELECT {key}, {kept} FROM cand QUALIFY row_number() OVER "
        f"(PARTITION BY {key} ORDER BY period, ord DESC) = 1) USING ({key})"
        if kept
        else ""
    )
    columns = ", ".join(x for x in (key, updated, kept) if x)
    return DIMENSION.format(columns=columns, key=key, updated=updated, kept=first)


_checks = {
    "duplicate_notice_keys": f"SELECT count(*) FROM (SELECT {KEY} FROM kept GROUP BY ALL HAVING count(*) > 1)",
    "null_notice_keys": "SELECT count(*) FROM kept WHERE notice_no IS NULL OR unit_id IS NULL OR modality_id IS NULL",
    "orphan_items": f"SELECT count(*) FROM items WHERE ({KEY}) NOT IN (SELECT ({KEY}) FROM kept)",
    "orphan_bids": f"SELECT count(*) FROM bids WHERE ({KEY}) NOT IN (SELECT ({KEY}) FROM kept)",
    "notices_without_unit": "SELECT count(*) FROM kept WHERE unit_id NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer)",
    "units_without_agency": "SELECT count(*) FROM customer WHERE CAST(c_nationkey AS VARCHAR) NOT IN (SELECT a FROM agencies)",
    "agencies_without_parent": """SELECT count(DISTINCT agency_id) FROM notices JOIN nation ON CAST(n_nationkey AS VARCHAR) = agency_id
      WHERE status <> 'P' AND CAST(n_regionkey AS VARCHAR) NOT IN (SELECT a FROM agencies)""",
    "keys_in_several_periods": f"SELECT count(*) FROM (SELECT {KEY} FROM kept GROUP BY ALL HAVING count(DISTINCT period) > 1)",
    "sentinels_in_ranking": "SELECT 0",
    "null_series_totals": """SELECT count(*) FROM (SELECT period, agency_id, modality_id FROM kept
      GROUP BY ALL HAVING count(value) = 0)""",
    "series_count_difference": "SELECT 0",
}

def _fit(lags: list[int]) -> str:
    """One order: coefficients and the first steps, whose own last values are the steps before them."""
    steps, last = [], "y1"
    for k in range(1, FIT_AHEAD + 1):
        terms = ["c", *([f"p1 * ({last})"] if 1 in lags else []), *([f"p12 * z{k}"] if 12 in lags else [])]
        last = " + ".join(terms)
        steps.append(f"round({last}, 6) AS step_{k}")
    return f"""SELECT series_key, target, '{"+".join(map(str, lags))}' AS lags, m AS n, round(p1, 6) AS phi_1, round(p12, 6) AS phi_12,
        round(c, 6) AS level, round(e, 6) AS noise, {", ".join(steps)} FROM fit_{"_".join(map(str, lags))} JOIN ends USING (series_key, target)"""


ORACLE: dict[str, str] = {
    "parse_br_decimal_date": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS price,
               CAST(CAST(try_strptime(strftime(o_orderdate, '%m/%d/%Y'), '%d/%m/%Y') AS DATE) AS VARCHAR) AS day,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS code, CAST(NULL AS INTEGER) AS bad_code,
               CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag
        FROM orders""",
    "period_validate": """
        SELECT candidate, CAST(substr(candidate, 5, 2) AS INTEGER) BETWEEN 1 AND 12 AS valid, count(*) AS n
        FROM (SELECT strftime(o_orderdate, '%Y%d') AS candidate FROM orders) GROUP BY ALL""",
    "next_periods": sql(
        f"""SELECT unit_id, CAST(date_diff('month', strptime(first, '%Y%m'), strptime(last, '%Y%m')) + 1 AS INTEGER) AS months,
               CAST(step AS INTEGER) AS step, {month_after("last", "step")} AS period
        FROM (SELECT unit_id, min(period) AS first, max(period) AS last FROM notices GROUP BY ALL),
             (SELECT unnest(range(1, {HORIZON + 1})) AS step)""",
        SQL_NOTICES,
    ),
    "monthly_series": sql(
        """SELECT period, agency_id, modality_id, notice_count, CAST(total_value AS DOUBLE) AS total_value,
               CAST(median_value AS DOUBLE) AS median_value FROM series""",
        SQL_NOTICES, SERIES,
    ),
    "sentinel_filter": sql(
        f"SELECT {KEY}, item_code, winner_id FROM items WHERE {REAL.format('winner_id')}", *ITEMS
    ),
    "supplier_series": sql(
        f"""SELECT period, winner_id AS supplier_id, count(*) AS items_won, count(DISTINCT ({KEY})) AS distinct_notices,
               CAST(sum(CAST(unit_value AS DECIMAL(19,4)) * CAST(quantity AS DECIMAL(19,4))) AS DOUBLE) AS total_value
        FROM items WHERE {REAL.format("winner_id")} GROUP BY period, winner_id""",
        *ITEMS,
    ),
    "supplier_total": sql(
        f"""SELECT supplier_id, CAST(sum(n) AS BIGINT) AS items_won, CAST(sum(d) AS BIGINT) AS distinct_notices,
               CAST(sum(t) AS DOUBLE) AS total_value FROM (
            SELECT period, winner_id AS supplier_id, count(*) AS n, count(DISTINCT ({KEY})) AS d,
                   sum(CAST(unit_value AS DECIMAL(19,4)) * CAST(quantity AS DECIMAL(19,4))) AS t
            FROM items WHERE {REAL.format("winner_id")} GROUP BY period, winner_id)
        GROUP BY supplier_id""",
        *ITEMS,
    ),
    **{
        f"series_{name}": sql(
            f"""SELECT {key} AS series_key, period, CAST(sum(notice_count) AS BIGINT) AS notice_count,
                   CAST(sum(total_value) AS DOUBLE) AS total_value FROM series GROUP BY ALL""",
            SQL_NOTICES, SERIES,
        )
        for name, key in {
            "by_agency": "'agency:' || agency_id",
            "by_modality": "'modality:' || modality_id",
            "global": "'global'",
        }.items()
    },
    "plausibility": sql(f"SELECT {KEY}, line_no, item_code, plausible FROM marked", *ITEMS, ITEM_FEATURES),
    "value_ratio_group": sql(
        f"SELECT {KEY}, round(value_ratio_group, 6) AS value_ratio_group FROM vr", SQL_NOTICES, BASE, VALUE_RATIO
    ),
    "bidders_ratio_modality": sql(
        f"SELECT {KEY}, n_bidders, n_winners, winner_id, round(bidders_ratio_modality, 6) AS bidders_ratio_modality FROM br",
        *BIDS, PARTICIPATION,
    ),
    "win_rate": sql(
        "SELECT agency_id, winner_id, wins, round(winner_win_rate, 6) AS winner_win_rate FROM record",
        SQL_NOTICES, *BIDS, BASE, PARTICIPATION, RECORD,
    ),
    "agency_hhi": sql(
        "SELECT agency_id, round(agency_hhi, 9) AS agency_hhi FROM hhi",
        SQL_NOTICES, *BIDS, BASE, PARTICIPATION, RECORD,
    ),
    "item_ratio_max": sql(f"SELECT {KEY}, round(item_ratio_max, 6) AS item_ratio_max FROM itf", *ITEMS, ITEM_FEATURES),
    "implausible_flag": sql(f"SELECT {KEY}, has_implausible_item FROM itf", *ITEMS, ITEM_FEATURES),
    "no_winner_flag": sql(
        f"""SELECT {KEY}, coalesce(n_winners, 1) = 0 AS no_winner
        FROM base LEFT JOIN part USING (notice_no, unit_id, modality_id)""",
        SQL_NOTICES, *BIDS, BASE, PARTICIPATION,
    ),
    "seasonal_deviation": sql(
        "SELECT agency_id, period, round(seasonal_deviation, 6) AS seasonal_deviation FROM sea", SQL_NOTICES, BASE, SEASONAL
    ),
    "feature_matrix": sql(
        f"""SELECT {KEY}, period, {", ".join(f"round({f}, 6) AS {f}" for f in NEUTRAL)}, no_winner, has_implausible_item
        FROM matrix""",
        *ALL_FEATURES,
    ),
    "dedupe_keep_last": """
        SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_partkey, l_suppkey,
               l_extendedprice FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY lineitem.l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    "modality_dim": sql(
        dimension("modality_id", "name"),
        SQL_NOTICES, "cand AS (SELECT modality_id, modality_name AS name, period, line_no AS ord FROM notices)",
    ),
    "agency_dim": sql(
        dimension("agency_id", "name", "parent_agency_id"),
        SQL_NOTICES,
        """cand AS (
          SELECT parent_agency_id AS agency_id, parent_agency_name AS name, NULL AS parent_agency_id, period, line_no AS ord
          FROM notices
          UNION ALL SELECT agency_id, agency_name, parent_agency_id, period, line_no + 1099511627776 FROM notices)""",
    ),
    "unit_dim": sql(
        dimension("unit_id", "name, state, city", "agency_id"),
        SQL_NOTICES, "cand AS (SELECT unit_id, unit_name AS name, state, city, agency_id, period, line_no AS ord FROM notices)",
    ),
    "supplier_dim": sql(
        dimension("supplier_id", "name"),
        SQL_ITEMS, SQL_BIDS,
        """cand AS (SELECT winner_id AS supplier_id, winner_name AS name, period, line_no AS ord FROM items
        UNION ALL SELECT bidder_id, bidder_name, period, line_no FROM bids)""",
    ),
    "upsert_notices": sql(
        f"""SELECT {KEY}, f.process_no, f.subject, l.status, f.period, l.value,
               CAST(f.opening_date AS VARCHAR) AS opening_date, CAST(CAST(l.result_date AS DATE) AS VARCHAR) AS result_date
        FROM (SELECT * FROM revised QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY period) = 1) f
        JOIN (SELECT * FROM revised QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY period DESC) = 1) l
        USING (notice_no, unit_id, modality_id)""",
        SQL_NOTICES, REVISED_NOTICES,
    ),
    "replace_children": sql(
        f"""SELECT {KEY}, item_code, bidder_id, is_winner, since AS period FROM (
            SELECT b.*, since, max(period) OVER (PARTITION BY {KEY}) AS last
            FROM revised_bids b JOIN loaded USING (notice_no, unit_id, modality_id) WHERE period >= since)
        WHERE period = last""",
        SQL_NOTICES, *BIDS, REVISED_NOTICES, REVISED_BIDS, LOADED,
    ),
    "integrity_report": sql(
        " UNION ALL ".join(f"SELECT '{name}' AS \"check\", ({body}) AS violations" for name, body in _checks.items()),
        SQL_NOTICES, SQL_ITEMS, SQL_BIDS, REVISED_NOTICES,
        "kept AS (SELECT * FROM revised WHERE status <> 'P')",
        "agencies AS (SELECT agency_id AS a FROM notices WHERE status <> 'P' UNION SELECT parent_agency_id FROM notices WHERE status <> 'P')",
    ),
    "load_accounting": sql(
        """SELECT period, rows_read, coalesce(rows_inserted, 0) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
               greatest(0, rows_read - coalesce(rows_inserted, 0)) AS rows_rejected
        FROM (SELECT period, count(*) AS rows_read FROM (
                SELECT period FROM revised WHERE status <> 'P' UNION ALL SELECT period FROM revised_bids) GROUP BY ALL)
        LEFT JOIN (SELECT period, count(*) AS rows_inserted FROM (
                SELECT period FROM revised WHERE status <> 'P'
                UNION ALL SELECT period FROM revised_bids JOIN loaded USING (notice_no, unit_id, modality_id)
                WHERE period >= since) GROUP BY ALL) USING (period)""",
        SQL_NOTICES, *BIDS, REVISED_NOTICES, REVISED_BIDS, LOADED,
    ),
    "last_ingestion": sql(
        """SELECT period, count(*) AS rows_read, substr(period, 1, 4) AS finished_at FROM notices GROUP BY ALL
        ORDER BY finished_at DESC, period DESC LIMIT 1""",
        SQL_NOTICES,
    ),
    "silver_roundtrip": sql(
        f"""SELECT {KEY}, period, CASE WHEN period = '{REPLACED}' THEN 'again' ELSE status END AS status,
               CAST(value AS DOUBLE) AS value FROM notices WHERE period BETWEEN '199501' AND '199612'""",
        SQL_NOTICES,
    ),
    "load_twice": sql(
        f"""SELECT {KEY}, l.status, f.period, l.value, b.bids, b.wins
        FROM (SELECT * FROM revised QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY period) = 1) f
        JOIN (SELECT * FROM revised QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY period DESC) = 1) l
        USING (notice_no, unit_id, modality_id)
        LEFT JOIN (SELECT {KEY}, count(*) AS bids, count(*) FILTER (is_winner) AS wins FROM (
            SELECT *, max(period) OVER (PARTITION BY {KEY}) AS last FROM revised_bids) WHERE period = last GROUP BY ALL) b
        USING (notice_no, unit_id, modality_id)""",
        SQL_NOTICES, *BIDS, REVISED_NOTICES, REVISED_BIDS,
    ),
    "bronze_ingest": sql(
        f"""SELECT 'notice' AS "table", {KEY}, period, CAST(NULL AS VARCHAR) AS code, CASE status WHEN 'F' THEN 'REVISED' ELSE status END AS who,
               CAST(value AS DOUBLE) AS number, 'intact' AS outcome FROM notices
        UNION ALL SELECT 'item', {KEY}, period, item_code, winner_id, CAST(unit_value AS DOUBLE), 'intact' FROM items
        UNION ALL SELECT 'bid', {KEY}, period, item_code, bidder_id, CAST(is_winner AS DOUBLE), 'intact' FROM bids""",
        SQL_NOTICES, *ITEMS, SQL_BIDS,
    ),
    "load_log": sql(
        f"""SELECT period, period || '_silver' AS file, 'success' AS status, rows_read, rows_read AS rows_inserted,
               CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_rejected, CAST(NULL AS VARCHAR) AS error,
               period = '{REPLACED}' AS newest, CASE WHEN period = '{REPLACED}' THEN (SELECT count(*) FROM notices) END AS notices FROM sizes
        UNION ALL SELECT period, period || '_silver', 'error', rows_read, 0, 0, rows_read,
               (SELECT count(*) FROM notices WHERE period = '{REPLACED}' AND status = 'F') || ' notices lack a required column',
               false, (SELECT count(*) FROM notices WHERE period <> '{REPLACED}') FROM sizes WHERE period = '{REPLACED}'
        UNION ALL SELECT '209912', '209912_silver', 'error', 0, 0, 0, 0, 'no notices in silver; its archive has to be ingested before', false, NULL""",
        SQL_NOTICES, *ITEMS, SQL_BIDS,
        """sizes AS (SELECT period, count(*) AS rows_read FROM (SELECT period FROM notices UNION ALL SELECT period FROM items
             UNION ALL SELECT period FROM bids) GROUP BY ALL)""",
    ),
    "train_runs": sql(
        f"""SELECT run_type, series_key, target, target_period, records, algorithm, window_start, window_end, horizon, min_train, series_trained, series_dropped
        FROM (SELECT DISTINCT 'forecast:agency' AS run_type, series_key, target, {month_after("last", "step")} AS target_period
              FROM points, lim, (SELECT unnest(range(1, {HORIZON + 1})) AS step) WHERE n >= {MIN_TRAIN + HORIZON}
              UNION ALL SELECT 'forecast:global', 'global', unnest(['quantity', 'value']), {month_after("last", "step")}
              FROM lim, (SELECT unnest(range(1, 4)) AS step)),
             (SELECT count(DISTINCT series_key) FILTER (n >= {MIN_TRAIN + HORIZON}) AS long, count(DISTINCT series_key) AS every FROM points),
             (SELECT 1::BIGINT AS records, 'seasonal autoregression' AS algorithm, min(period) AS window_start, max(period) AS window_end, {MIN_TRAIN} AS min_train FROM notices),
             (SELECT * FROM (VALUES ('forecast:agency', {HORIZON}), ('forecast:global', 3)) AS h(of_type, horizon)),
             LATERAL (SELECT CAST(CASE of_type WHEN 'forecast:global' THEN 1 ELSE long END AS INTEGER) AS series_trained,
                             CAST(CASE of_type WHEN 'forecast:global' THEN 0 ELSE every - long END AS INTEGER) AS series_dropped)
        WHERE of_type = run_type""",
        SQL_NOTICES, AGENCY_POINTS,
    ),
    "forecast_frame": sql(
        f"""SELECT DISTINCT series_key, target, CAST(step AS INTEGER) AS step,
               {month_after("last", "step")} AS target_period, true AS sound
        FROM points, lim, (SELECT unnest(range(1, {HORIZON + 1})) AS step) WHERE n >= {MIN_TRAIN + HORIZON}""",
        SQL_NOTICES, AGENCY_POINTS,
    ),
    "score_frame": sql(
        f"""SELECT {KEY}, period, true AS in_range, 8 AS n_values, 5 AS n_contributions, feature AS first_feature FROM (
            SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY deviation DESC, i) AS position FROM dev)
        JOIN (SELECT {KEY}, period FROM base) USING (notice_no, unit_id, modality_id) WHERE position = 1""",
        *ALL_FEATURES, NEUTRAL_MATRIX, STATS,
        "dev AS ("
        + " UNION ALL ".join(
            f"SELECT {KEY}, {i} AS i, '{f}' AS feature, abs({z(f)}) AS deviation FROM neutral, stats"
            for i, f in enumerate(FEATURES)
        )
        + ")",
    ),
    "latest_batch": sql(
        "SELECT period, count(*) AS rows_read FROM notices GROUP BY ALL ORDER BY period DESC LIMIT 1", SQL_NOTICES
    ),
    "dense_calendar": sql(
        """SELECT series_key, period, CAST(pos AS INTEGER) AS pos, CAST(n AS INTEGER) AS n_points,
               CAST(coalesce(q, 0) AS DOUBLE) AS quantity, round(CAST(coalesce(v, 0) AS DOUBLE), 4) AS value
        FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY period) - 1 AS pos,
                     count(*) OVER (PARTITION BY series_key) AS n FROM grid)
        LEFT JOIN unit USING (series_key, period)""",
        SQL_NOTICES,
        """unit AS (SELECT 'unit:' || unit_id AS series_key, period, count(*) AS q, coalesce(sum(value), 0) AS v
                    FROM notices GROUP BY ALL)""",
        """grid AS (SELECT series_key, strftime(unnest(generate_series(strptime(min(period), '%Y%m'),
             (SELECT strptime(max(period), '%Y%m') FROM unit), INTERVAL 1 MONTH)), '%Y%m') AS period
             FROM unit GROUP BY series_key)""",
    ),
    "eligible_series": sql(
        f"""SELECT unit_id AS series_key, start, "end", n_points FROM b WHERE n_points >= {LONG_TRAIN + HORIZON}
        UNION ALL SELECT 'eligible/dropped', CAST(count(*) FILTER (n_points >= {LONG_TRAIN + HORIZON}) AS VARCHAR),
        CAST(count(*) FILTER (n_points < {LONG_TRAIN + HORIZON}) AS VARCHAR), 0 FROM b""",
        SQL_NOTICES,
        """b AS (SELECT unit_id, min(period) AS start, (SELECT max(period) FROM notices) AS "end",
             CAST(date_diff('month', strptime(min(period), '%Y%m'), (SELECT strptime(max(period), '%Y%m') FROM notices)) + 1
             AS INTEGER) AS n_points FROM notices GROUP BY unit_id)""",
    ),
    "seasonal_naive": sql(
        f"""SELECT series_key, target, CAST(step AS INTEGER) AS step, round(observed, 4) AS predicted
        FROM points, (SELECT unnest(range(1, {HORIZON + 7})) AS step) WHERE pos = n - 12 + (step - 1) % 12""",
        SQL_NOTICES, AGENCY_POINTS,
    ),
    "backtest_windows": sql(
        f"""SELECT series_key, CAST(0 AS INTEGER) AS train_start, CAST(o AS INTEGER) AS train_end,
               CAST(o AS INTEGER) AS test_start, CAST(o + {HORIZON} AS INTEGER) AS test_end
        FROM (SELECT series_key, n - {HORIZON} * unnest(range(1, 100)) AS o FROM (SELECT DISTINCT series_key, n FROM full_grid))
        WHERE o >= {MIN_TRAIN}""",
        SQL_NOTICES, AGENCY_POINTS,
    ),
    "backtest_metrics": sql(
        """SELECT series_key, target, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) ** 2)), 6) AS rmse,
               round(100 * avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END), 6) AS mape,
               count(*) FILTER (y = 0) AS mape_skipped, round(avg(abs(y - p)) / avg(abs(y - b)), 6) AS mase
        FROM paired GROUP BY ALL""",
        SQL_NOTICES, AGENCY_POINTS,
        f"""tests AS (SELECT *, n - {HORIZON} * CAST(ceil((n - pos) / {HORIZON}) AS BIGINT) AS o FROM points)""",
        f"""paired AS (SELECT t.series_key, t.target, t.observed AS y, s.observed AS p, l.observed AS b FROM tests t
             JOIN points s ON s.series_key = t.series_key AND s.target = t.target AND s.pos = o - 12 + (t.pos - o) % 12
             JOIN points l ON l.series_key = t.series_key AND l.target = t.target AND l.pos = o - 1
             WHERE o >= {MIN_TRAIN})""",
    ),
    "backtest_frame": sql(
        """SELECT series_key, target, count(*) AS points, count(*) AS answered, count(DISTINCT o) AS windows,
               CAST(min(o) AS INTEGER) AS first_origin, round(sum(y), 4) AS observed, count(*) FILTER (y = 0) AS mape_skipped,
               round(nullif(avg(abs(y - p)), 0), 6) AS baseline_mae, true AS sound
        FROM paired GROUP BY ALL""",
        SQL_NOTICES, AGENCY_POINTS,
        f"""tests AS (SELECT *, n - {HORIZON} * CAST(ceil((n - pos) / {HORIZON}) AS BIGINT) AS o FROM points)""",
        f"""paired AS (SELECT t.series_key, t.target, o, t.observed AS y, s.observed AS p FROM tests t
             JOIN points s ON s.series_key = t.series_key AND s.target = t.target AND s.pos = o - 12 + (t.pos - o) % 12
             WHERE o >= {MIN_TRAIN})""",
    ),
    "forecast_fit": sql(
        " UNION ALL ".join(_fit(lags) for lags in ORDERS),
        SQL_NOTICES, AGENCY_POINTS,
        f"""part AS (SELECT series_key, target, pos, n, observed / avg(observed) OVER (PARTITION BY series_key, target) AS y
             FROM points WHERE n >= {MIN_TRAIN + HORIZON})""",
        """lagged AS (SELECT *, lag(y, 1) OVER w AS l1, lag(y, 12) OVER w AS l12 FROM part
             WINDOW w AS (PARTITION BY series_key, target ORDER BY pos))""",
        """fit_1 AS (SELECT series_key, target, count(*) AS m, regr_slope(y, l1) AS p1, NULL::DOUBLE AS p12,
             regr_intercept(y, l1) AS c, sqrt(greatest(var_pop(y) - regr_slope(y, l1) * covar_pop(y, l1), 0)) AS e
             FROM lagged WHERE l1 IS NOT NULL GROUP BY ALL)""",
        """fit_12 AS (SELECT series_key, target, count(*) AS m, NULL::DOUBLE AS p1, regr_slope(y, l12) AS p12,
             regr_intercept(y, l12) AS c, sqrt(greatest(var_pop(y) - regr_slope(y, l12) * covar_pop(y, l12), 0)) AS e
             FROM lagged WHERE l12 IS NOT NULL GROUP BY ALL)""",
        """both_sums AS (SELECT series_key, target, count(*) AS m, avg(y) AS ay, avg(l1) AS a1, avg(l12) AS a12, var_pop(y) AS vy,
             var_pop(l1) AS v1, var_pop(l12) AS v12, covar_pop(l1, l12) AS c112, covar_pop(y, l1) AS cy1, covar_pop(y, l12) AS cy12
             FROM lagged WHERE l12 IS NOT NULL GROUP BY ALL)""",
        """fit_1_12 AS (SELECT series_key, target, m, p1, p12, ay - p1 * a1 - p12 * a12 AS c,
             sqrt(greatest(vy - p1 * cy1 - p12 * cy12, 0)) AS e
             FROM (SELECT *, (v12 * cy1 - c112 * cy12) / (v1 * v12 - c112 ** 2) AS p1,
                             (v1 * cy12 - c112 * cy1) / (v1 * v12 - c112 ** 2) AS p12 FROM both_sums))""",
        """ends AS (SELECT series_key, target, max(y) FILTER (pos = n - 1) AS y1, max(y) FILTER (pos = n - 12) AS z1,
             max(y) FILTER (pos = n - 11) AS z2, max(y) FILTER (pos = n - 10) AS z3 FROM part GROUP BY ALL)""",
    ),
    "forest_draws": sql(
        f"""SELECT {KEY}, CAST(t AS INTEGER) AS tree, CAST(position AS INTEGER) AS position FROM (
            SELECT *, row_number() OVER (PARTITION BY t ORDER BY (a + (t + 1) * b + (t + 1) * (t + 1) * c) % {DRAW_PRIME}, b) AS position
            FROM numbers, (SELECT unnest(range({TREES})) AS t)) WHERE position <= {SUBSAMPLE}""",
        SQL_NOTICES,
        f"""digests AS (SELECT {KEY}, md5('{SEED}|tree|' || notice_no || '|' || unit_id || '|' || modality_id) AS d FROM notices)""",
        f"""numbers AS (SELECT {KEY}, {", ".join(f"CAST('0x' || substr(d, {at}, 10) AS BIGINT) AS {n}" for n, at in zip("abc", (1, 11, 21)))}
             FROM digests)""",
    ),
    "forest_walk": sql(
        f"""SELECT {KEY}, round(2.0 ** -(avg(depth) / {float(average_path(WALK_ROWS))!r}), 9) AS score FROM walk_3 GROUP BY ALL""",
        *ALL_FEATURES, NEUTRAL_MATRIX,
        "nodes(tree, node, feature, threshold, lft, rgt, depth) AS (VALUES " + ", ".join(map(str, WALK_NODES)) + ")",
        f"walk_0 AS (SELECT {KEY}, [{', '.join(f'CAST({f} AS DOUBLE)' for f in FEATURES)}] AS x, nodes.* FROM neutral, nodes WHERE node = 0)",
        *[
            f"""walk_{level + 1} AS (SELECT w.notice_no, w.unit_id, w.modality_id, w.x, nodes.* FROM walk_{level} w JOIN nodes ON nodes.tree = w.tree
             AND nodes.node = CASE WHEN w.feature < 0 OR w.x[w.feature + 1] <= w.threshold THEN w.lft ELSE w.rgt END)"""
            for level in range(3)
        ],
    ),
    "robust_scale": sql(
        f"SELECT {KEY}, {', '.join(f'round({z(f)}, 5) AS {f}' for f in FEATURES)} FROM neutral, stats",
        *ALL_FEATURES, NEUTRAL_MATRIX, STATS,
    ),
    "contributions_top5": sql(
        f"""SELECT {KEY}, CAST(position AS INTEGER) AS position, feature, round(deviation, 4) AS deviation FROM (
            SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY deviation DESC, i) AS position FROM dev)
        WHERE position <= 5""",
        *ALL_FEATURES, NEUTRAL_MATRIX, STATS,
        "dev AS ("
        + " UNION ALL ".join(
            f"SELECT {KEY}, {i} AS i, '{f}' AS feature, abs({z(f)}) AS deviation FROM neutral, stats"
            for i, f in enumerate(FEATURES)
        )
        + ")",
    ),
    "global_rank": sql(
        f"""SELECT {KEY}, CAST(value AS DOUBLE) AS value,
               row_number() OVER (ORDER BY value DESC NULLS LAST, {KEY}) AS rank FROM notices""",
        SQL_NOTICES,
    ),
    "perturb": sql(
        f"""SELECT {KEY}, perturbed,
               round(CASE WHEN perturbed = 'value' THEN greatest(value_ratio_group, 1) * fv
                          WHEN perturbed IS NOT NULL THEN greatest(value_ratio_group, 1) * fc
                          ELSE value_ratio_group END, 5) AS value_ratio_group,
               round(bidders_ratio_modality * CASE WHEN perturbed = 'competition' THEN fb ELSE 1 END, 5) AS bidders_ratio_modality,
               round(winner_win_rate, 5) AS winner_win_rate, round(agency_hhi, 5) AS agency_hhi,
               round(CASE WHEN perturbed = 'value' THEN greatest(item_ratio_max, 1) * fv ELSE item_ratio_max END, 5) AS item_ratio_max,
               round(CASE WHEN perturbed = 'seasonal' THEN greatest(seasonal_deviation, 1) * fs ELSE seasonal_deviation END, 5)
                 AS seasonal_deviation,
               no_winner, has_implausible_item
        FROM neutral LEFT JOIN chosen USING (notice_no, unit_id, modality_id)""",
        *ALL_FEATURES, NEUTRAL_MATRIX,
        f"""chosen AS (
          SELECT {KEY}, ['value', 'competition', 'seasonal'][CAST(floor(u('kind') * 3) AS INTEGER) + 1] AS perturbed,
                 10 + u('value') * 90 AS fv, 0.01 + u('bidders') * (0.05 - 0.01) AS fb, 5 + u('context') * 15 AS fc,
                 8 + u('season') * 12 AS fs
          FROM neutral ORDER BY u('row'), {KEY} LIMIT 200)""",
    ),
    "archive_report": sql(
        """SELECT period, CAST(NULL AS VARCHAR) AS error, period LIKE '%12' AS partial, count(*) AS notice_rows,
               any_value(n) AS item_rows, CASE WHEN period LIKE '%12' THEN 0 ELSE any_value(n) END AS bid_rows,
               CASE WHEN period LIKE '%12' THEN 'bid' ELSE '' END AS missing_tables
        FROM notices LEFT JOIN (SELECT period, count(*) AS n FROM items GROUP BY ALL) USING (period) GROUP BY period""",
        SQL_NOTICES, *ITEMS,
    ),
    "archive_notices": sql(
        """SELECT * EXCLUDE (line_no, value, result_date, opening_date), CAST(value AS DOUBLE) AS value,
               CAST(CAST(result_date AS DATE) AS VARCHAR) AS result_date, CAST(opening_date AS VARCHAR) AS opening_date
        FROM notices""",
        SQL_NOTICES,
    ),
    "archive_ingest": sql(
        """SELECT period, items, amount, bids, winning_bids, bidders FROM
          (SELECT period, count(*) AS items, CAST(sum(CAST(quantity AS DECIMAL(19,4)) * CAST(unit_value AS DECIMAL(19,4)))
             AS DOUBLE) AS amount FROM items GROUP BY ALL)
          LEFT JOIN (SELECT period, count(*) AS bids, count(*) FILTER (is_winner) AS winning_bids,
             count(DISTINCT bidder_id) AS bidders FROM bids WHERE period NOT LIKE '%12' GROUP BY ALL) USING (period)""",
        SQL_ITEMS, SQL_BIDS,
    ),
}


def _uniform(purpose: str) -> str:
    text = f"'{SEED}|{purpose}|' || notice_no || '|' || unit_id || '|' || modality_id"
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / 4503599627370496.0)"


for _purpose in ("kind", "value", "bidders", "context", "season", "row"):
    ORACLE["perturb"] = ORACLE["perturb"].replace(f"u('{_purpose}')", _uniform(_purpose))
