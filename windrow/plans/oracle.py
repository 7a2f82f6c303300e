"""The queries of ``windrow.plans.queries`` in DuckDB SQL, written from the definitions."""

from __future__ import annotations

NUMBER = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def number(text: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({text}), {NUMBER}) THEN TRY_CAST(trim({text}) AS DOUBLE) END"


def steady(expression: str) -> str:
    """Cut to 28 binary digits."""
    return f"(({expression})::DOUBLE * 33554433 - (({expression})::DOUBLE * 33554433 - ({expression})::DOUBLE))"


def exact(expression: str) -> str:
    return f"({expression})::DOUBLE"


def steadies(cols, quote: str = "", names: dict[str, str] | None = None) -> str:
    return ", ".join(f"{steady(c)} AS {quote}{(names or {}).get(c, c)}{quote}" for c in cols)


def summary(col: str, prefix: str = "", cut=steady) -> str:
    """Ten statistics of a column, named with a prefix."""
    parts = [f'count({col}) AS "{prefix}count"']
    calls = {
        "min": f"min({col})",
        "max": f"max({col})",
        "mean": f"avg({col})",
        "std": f"stddev_samp({col})",
        "median": f"quantile_cont({col}, 0.5)",
        "q01": f"quantile_cont({col}, 0.01)",
        "q05": f"quantile_cont({col}, 0.05)",
        "q95": f"quantile_cont({col}, 0.95)",
        "q99": f"quantile_cont({col}, 0.99)",
    }
    parts += [f'{call if name in ("min", "max") else cut(call)} AS "{prefix}{name}"' for name, call in calls.items()]
    return ", ".join(parts)


HOURLY = "SELECT *, date_trunc('hour', ts) AS hour FROM events"
GAPPY = "SELECT event_type, ts, event_id, CASE WHEN event_id % 5 >= 3 THEN value END AS value FROM events"
LINE_UNITS = {"l_quantity": "[pcs]", "l_extendedprice": "[usd]", "l_discount": "[1]", "l_tax": "[1]"}


def line_long() -> str:
    return " UNION ALL ".join(
        f"SELECT l_returnflag, '{c}' AS variable, '{u}' AS unit, {summary(c)}, "
        f"max({c}) - min({c}) AS spread FROM lineitem GROUP BY l_returnflag"
        for c, u in LINE_UNITS.items()
    )


HOUR_LONG = f"SELECT hour, 'value' AS variable, '[V]' AS unit, {summary('value', cut=str)} FROM ({HOURLY}) GROUP BY hour"

NUMBER_TEXT = """CASE event_id % 10
    WHEN 0 THEN event_type || CAST(value AS VARCHAR)
    WHEN 1 THEN ' ' || CAST(value AS VARCHAR) || ' '
    WHEN 2 THEN CAST(value AS VARCHAR) || 'f'
    WHEN 3 THEN 'NaN'
    WHEN 4 THEN replace(CAST(value AS VARCHAR), '.', ',')
    WHEN 5 THEN CAST(value AS VARCHAR) || 'e1'
    ELSE CAST(value AS VARCHAR) END"""


def fills(order: str = "ts, event_id", by: str = "event_type", col: str = "value") -> dict[str, str]:
    back = f"last_value({col} IGNORE NULLS) OVER (PARTITION BY {by} ORDER BY {order} ROWS UNBOUNDED PRECEDING)"
    ahead = f"first_value({col} IGNORE NULLS) OVER (PARTITION BY {by} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return {"ffill": back, "bfill": ahead, "bffill": f"coalesce({ahead}, {back})"}


CHANNELS = """fast AS (
    SELECT event_id, CAST(ts AS DATE) AS day, ts, value FROM events WHERE event_type <> 'signup'
), slow AS (
    SELECT CAST(ts AS DATE) AS day, date_trunc('second', ts) AS ts, event_id AS slow_id,
        CASE WHEN event_id % 4 > 0 THEN value END AS slow_value,
        CASE WHEN event_id % 7 < 3 THEN CAST(user_id AS DOUBLE) END AS slow_user
    FROM events WHERE event_type = 'signup'
    QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), date_trunc('second', ts) ORDER BY event_id DESC) = 1
)"""


def asof(direction: str) -> str:
    pick = {"backward": "b.ts", "forward": "f.ts"}.get(
        direction,
        "CASE WHEN b.ts IS NULL THEN f.ts WHEN f.ts IS NULL THEN b.ts "
        "WHEN l.ts - b.ts < f.ts - l.ts THEN b.ts ELSE f.ts END",
    )
    return f"""WITH {CHANNELS}, hit AS (
        SELECT l.*, {pick} AS hit_ts FROM fast l
        ASOF LEFT JOIN slow b ON l.day = b.day AND l.ts >= b.ts
        ASOF LEFT JOIN slow f ON l.day = f.day AND l.ts <= f.ts
    ), near AS (
        SELECT * REPLACE (CASE WHEN abs(epoch_us(ts) - epoch_us(hit_ts)) <= 1800000000 THEN hit_ts END AS hit_ts) FROM hit
    )
    SELECT n.event_id, n.day, n.ts, n.value, s.slow_id, s.slow_value, s.ts AS slow_ts
    FROM near n LEFT JOIN slow s ON n.day = s.day AND n.hit_ts = s.ts"""


def interpolated(left: str, right: str, by: str, cols: list[str], tolerance: int | None, grid: int | None) -> str:
    """CTEs that end in ``aligned``: the rows of ``left`` with ``cols`` of ``right`` interpolated in time."""
    at = f"(us + {grid // 2}) // {grid} * {grid}" if grid else "us"
    ctes = [
        f"axis AS (SELECT *, {at} AS g FROM (SELECT *, epoch_us(ts) AS us FROM {left}))",
        f"slow_us AS (SELECT *, epoch_us(ts) AS t FROM {right})",
        f"ends AS (SELECT {by}, min(t) AS lo, max(t) AS hi FROM slow_us GROUP BY {by})",
    ]
    joins, values = [], []
    for c in cols:
        ctes.append(
            f"known_{c} AS (SELECT {by}, t, {c} AS v, lead(t) OVER w AS t1, lead({c}) OVER w AS v1 FROM slow_us "
            f"WHERE {c} IS NOT NULL WINDOW w AS (PARTITION BY {by} ORDER BY t))"
        )
        joins.append(
            f"ASOF LEFT JOIN known_{c} k_{c} ON a.{by} = k_{c}.{by} AND a.g >= k_{c}.t "
            f"LEFT JOIN slow_us f_{c} ON a.{by} = f_{c}.{by} AND f_{c}.t = e.lo"
        )
        line = (
            f"CASE WHEN k_{c}.t1 IS NULL THEN k_{c}.v "
            f"ELSE k_{c}.v + (k_{c}.v1 - k_{c}.v) * (a.g - k_{c}.t) / (k_{c}.t1 - k_{c}.t) END"
        )
        early = f"CASE WHEN a.us < e.lo THEN f_{c}.{c} ELSE {line} END"
        limit = f"a.us >= e.lo - {tolerance} AND a.us <= e.hi + {tolerance}" if tolerance is not None else "true"
        values.append(f"CASE WHEN {limit} THEN {early} END AS {c}")
    ctes.append(
        f"aligned AS (SELECT a.* EXCLUDE (us, g), {', '.join(values)} FROM axis a LEFT JOIN ends e ON a.{by} = e.{by} "
        f"{' '.join(joins)})"
    )
    return ", ".join(ctes)


SEGMENTS = """segments AS (
    SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS a,
        last_day(date_trunc('month', o_orderdate)) AS b,
        avg(o_totalprice) / 250000 AS f, max(o_totalprice) / 250000 AS t
    FROM orders GROUP BY ALL
), anchors AS (
    SELECT o_orderpriority, a AS d, f AS v FROM segments UNION ALL SELECT o_orderpriority, b, t FROM segments
), lines AS (
    SELECT *, lead(d) OVER w AS d1, lead(v) OVER w AS v1 FROM anchors
    WINDOW w AS (PARTITION BY o_orderpriority ORDER BY d)
), days AS (
    SELECT *, CAST(unnest(generate_series(d, coalesce(d1 - 1, d), INTERVAL 1 DAY)) AS DATE) AS day FROM lines
), ramp AS (
    SELECT o_orderpriority, day AS date,
        CASE WHEN d1 IS NULL THEN v ELSE v + (v1 - v) * (day - d) / (d1 - d) END AS factor
    FROM days
)"""

DOC_LINES = """doc AS (
    SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents
), parsed AS (
    SELECT doc_id, string_split(parts[1], ' ') AS names,
        CASE WHEN len(parts) > 1 THEN string_split(parts[2], ' ') ELSE [''] END AS units,
        list_filter(parts[3:], lambda x: trim(x) <> '') AS data
    FROM doc
), sized AS (
    SELECT *, len(names) AS n0,
        CASE WHEN len(data) = 0 THEN 0 ELSE greatest(len(string_split(data[1], ' ')) - len(names), 0) END AS extra
    FROM parsed
), doc_rows AS (
    SELECT doc_id, n0 + extra AS width, unnest(data) AS line, generate_subscripts(data, 1) - 1 AS row_idx FROM sized
), doc_cells AS (
    SELECT *, string_split(line, ' ') AS cells FROM doc_rows
), doc_unquoted AS (
    SELECT * REPLACE (list_transform(cells, lambda c: CASE WHEN length(c) > 1 AND c[1] = '"' AND c[-1] = '"'
        THEN replace(c[2:-2], '""', '"') ELSE c END) AS cells) FROM doc_cells
)"""


def calibrated(source: str, keep: str) -> str:
    """SELECT of ``keep`` and both gases, calibrated where pressure and temperature allow it."""
    return f"""SELECT {keep}, coalesce(h, H2O) AS H2O, coalesce(c, CO2) AS CO2,
        h IS NOT NULL AND c IS NOT NULL AS calibrated
    FROM (
        SELECT *, x * (((((8.5851e-17 * dry_signal + -1.2783e-12) * dry_signal + 9.0892e-9) * dry_signal + 5.9733e-6) * dry_signal + 0.14225) * dry_signal)
            * ((Tlic + 273.15) / (32.15::DOUBLE + 273.15::DOUBLE)) * 1.114 AS c
        FROM (
            SELECT *, CO2 * 1.02733 * (101.3 / nullif(Plic * x, 0)) AS dry_signal
            FROM (
                SELECT *, 1 + 0.5 * h / 1000 AS x
                FROM (
                    SELECT *, (((1.2110e-9 * p + -8.1540e-8) * p + 8.1020e-3) * p)
                        * ((Tlic + 273.15) / (32.15::DOUBLE + 273.15::DOUBLE)) * 1.114 AS h
                    FROM (SELECT *, H2O * (101.3 / nullif(Plic, 0)) AS p FROM {source})
                )
            )
        )
    )"""


FAST = ("U", "V", "W", "T_SONIC", "CO2", "H2O", "Q")
SLOW = ("Pa", "Plic", "Ta", "Tlic", "Xa", "Hx")
OUT = {"Q": "Q [q]", "Hx": "Hx [%]"}
UNITS = {
    "Q": "[q]", "Xa": "[mmol / mol]", "Hx": "[%]",
    "U": "[m/s]", "V": "[m/s]", "W": "[m/s]", "T_SONIC": "[degC]", "CO2": "[µmol/mol]", "H2O": "[mmol/mol]",
    "Pa": "[kPa]", "Plic": "[kPa]", "Ta": "[degC]", "Tlic": "[degC]",
}


def nearest_known(c: str) -> str:
    """Next known value of a file, else the last one before."""
    over = "OVER (PARTITION BY file_id ORDER BY row_idx ROWS BETWEEN"
    ahead, back = f"{over} CURRENT ROW AND UNBOUNDED FOLLOWING)", f"{over} UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"coalesce(arg_min({c}, row_idx) {ahead}, arg_max({c}, row_idx) {back})"


def played() -> str:
    filled = ", ".join(f"{nearest_known(c)} AS {c}" for c in (*FAST, *SLOW))
    return f"""WITH named AS (
        SELECT *, 'Site' || strftime(date_trunc('hour', ts), '%y%m%d_%H') || '.raw' AS file_id,
            date_trunc('hour', ts) AS start_ts
        FROM events
    ), numbered AS (
        SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY ts, event_id) - 1 AS row_idx
        FROM named WHERE event_type <> 'signup'
    ), fast AS (
        SELECT event_id, file_id, start_ts, row_idx,
            start_ts + to_microseconds(CAST(CAST(row_idx AS HUGEINT) * 120000000768000 // 1000000 AS BIGINT)) AS ts,
            CASE WHEN event_id % 11 <> 0 THEN value END * 0.01 AS U,
            (user_id - 75) * 0.01::DOUBLE AS V,
            CASE WHEN event_id % 29 <> 0 THEN event_id % 100 END * 0.01::DOUBLE AS W,
            ((value + 16000) * 0.02) * ((value + 16000) * 0.02) / 1.402 / 287.64 - 273.15 AS T_SONIC,
            CASE WHEN event_id % 23 <> 0 THEN value + 1000 END AS CO2,
            CASE WHEN event_id % 17 <> 0 THEN value * 2 END * 0.335 AS H2O,
            CASE WHEN event_id % 13 <> 0 THEN CAST(user_id * 2 AS DOUBLE) END AS Q
        FROM numbered
    ), slow AS (
        SELECT file_id, date_trunc('second', ts) AS ts, value / 10 + 80 AS Pa,
            CASE WHEN event_id % 5 <> 0 THEN CAST(user_id % 10 + 75 AS DOUBLE) END AS Plic,
            value / 20 AS Ta,
            CASE WHEN event_id % 7 <> 0 THEN value / 10 + 20 END AS Tlic,
            user_id % 7 + 0.5::DOUBLE AS Xa,
            CASE WHEN event_id % 6 <> 0 THEN value / 8 END AS Hx
        FROM named WHERE event_type = 'signup'
        QUALIFY row_number() OVER (PARTITION BY file_id, date_trunc('second', ts) ORDER BY events.ts DESC, event_id DESC) = 1
    ), {interpolated("fast", "slow", "file_id", list(SLOW), 600_000_000, 10_000)}, filled AS (
        SELECT event_id, file_id, start_ts, row_idx, ts, {filled} FROM aligned
    ), final AS (
        {calibrated("filled", "event_id, file_id, start_ts, row_idx, ts, U, V, W, T_SONIC, Q, Pa, Plic, Ta, Tlic, Xa, Hx")}
    )""".replace("ORDER BY events.ts DESC, event_id DESC", "ORDER BY named.ts DESC, event_id DESC")


ERA = """CASE WHEN start_ts <= TIMESTAMP '1998-09-22 11:00:00' THEN {} WHEN start_ts <= TIMESTAMP '1998-12-15 15:00:00' THEN {} ELSE {} END"""
# First day, last day, slope and intercept of each period.
PERIODS = (
    ("1997-01-01 00:30:00", "1998-01-01 00:00:00", "1.087378", "24.757392"), ("1998-01-01 00:30:00", "1999-01-01 00:00:00", "1.171352", "1.241446"),
    ("1999-01-01 00:30:00", "2000-01-01 00:00:00", "1.1655515", "2.7512004"), ("2000-01-01 00:30:00", "2001-01-01 00:00:00", "1.1617209", "3.9202374"),
    ("2001-01-01 00:30:00", "2002-01-01 00:00:00", "1.1473303", "4.2208861"), ("2002-01-01 00:30:00", "2003-01-01 00:00:00", "1.1644168", "5.9501428"),
    ("2003-01-01 00:30:00", "2004-01-01 00:00:00", "1.1580541", "1.0469319"), ("2004-01-01 00:30:00", "2005-01-01 00:00:00", "1.304316", "-12.997544"),
    ("2005-01-01 00:30:00", "2005-08-09 16:30:00", "1.2226907", "-3.389643"),
)
PERIOD_LINEAR = " ".join(
    f"WHEN o_orderdate BETWEEN TIMESTAMP '{a}' AND TIMESTAMP '{b}' THEN {s}::DOUBLE * o_totalprice + ({i}::DOUBLE)" for a, b, s, i in PERIODS
)
SIZED_DAYS = "SELECT CAST(ts AS DATE) AS date, sum(length(props) / 1e6 + user_id / 1e6) AS mb FROM events GROUP BY 1"


def column_state(c: str, text: str, unit: str) -> str:
    return f"""SELECT '{c}' AS variable, '{unit}' AS unit, count(*) AS n_rows, count({text}) AS n_values,
        count({number(text)}) AS n_numeric,
        CASE WHEN count({text}) = 0 THEN 'EMPTY' WHEN '{unit}' LIKE '%hexadecimal_value%' THEN 'HEXADECIMAL'
        WHEN count({text}) > count({number(text)}) THEN 'NON-NUMERIC' ELSE 'OK' END AS state FROM events"""


def sql() -> dict[str, str]:
    value_stats = summary("value", "value__")
    out = {
        "summary_by_hour": f"SELECT hour, {value_stats} FROM ({HOURLY}) GROUP BY hour",
        "summary_by_type": f"SELECT event_type, {summary('value', 'value__')} FROM events GROUP BY event_type",
        "summary_empty_groups": f"""WITH grid AS (
            SELECT unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS hour FROM
                (SELECT min(date_trunc('hour', ts)) AS a, max(date_trunc('hour', ts)) AS b FROM events)
            ), cells AS (
                SELECT hour, t.event_type FROM grid,
                    (VALUES ('view'), ('click'), ('signup'), ('error'), ('purchase'), ('refund')) t(event_type)
            )
            SELECT c.hour, c.event_type, {value_stats} FROM cells c
            LEFT JOIN ({HOURLY}) e ON c.hour = e.hour AND c.event_type = e.event_type GROUP BY ALL""",
        "summary_lineitem": line_long(),
        "merged_summary": f"""SELECT CAST(ts AS DATE) AS day, count(value) AS count, min(value) AS min, max(value) AS max,
            {steady('avg(value)')} AS mean, {steady('stddev_samp(value)')} AS std, true AS q01_in_rank, true AS q05_in_rank, true AS median_in_rank,
            true AS q95_in_rank, true AS q99_in_rank FROM events GROUP BY 1""",
        "intervals_all": """WITH windows AS (
                SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS b,
                    o_orderdate + to_hours(CAST(o_orderkey % 24 + o_orderkey % 9 AS INTEGER)) AS e FROM orders
            ), lines AS (
                SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS at_ FROM lineitem
            )
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, at_ AS "at", count(*) AS n_windows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
            FROM lines JOIN windows ON at_ > b AND at_ <= e GROUP BY ALL""",
        "lookup_first": """WITH periods AS (
                SELECT c_custkey, DATE '1992-01-01' + CAST(c_custkey * 7 % 2400 AS INTEGER) AS b,
                    DATE '1992-01-01' + CAST(c_custkey * 7 % 2400 + c_nationkey * 5 AS INTEGER) AS e FROM customer
            ), days AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)
            SELECT o_orderkey, day, coalesce(min(c_custkey), -1) AS c_custkey FROM days LEFT JOIN periods ON day BETWEEN b AND e GROUP BY ALL""",
        "decode_escaped": r"""SELECT event_id, CASE event_id % 13
            WHEN 0 THEN chr(CAST((event_id % 400 + 161) % 94 + 161 AS INTEGER)) || '1' WHEN 1 THEN 'a' || chr(CAST(event_id % 400 + 161 AS INTEGER)) || 'f'
            WHEN 2 THEN chr(CAST(event_id % 400 + 161 + 128000 AS INTEGER)) WHEN 3 THEN chr(CAST((event_id % 400 + 161) % 300 + 64 AS INTEGER)) || '9'
            WHEN 4 THEN 'a' || chr(9) || 'b' || chr(10) || 'c' || chr(7) || chr(8) || chr(12) || chr(13) || chr(11)
            WHEN 5 THEN '\q\8''"' WHEN 6 THEN '\x41\' WHEN 9 THEN 'joined lines' WHEN 12 THEN event_type END AS decoded FROM events""",
        "halfhour_summary": f"""SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS bin, {value_stats}
            FROM events GROUP BY 1""",
        "robust_bounds": f"""SELECT variable, unit, {steady('min(q01)')} AS lower, {steady('max(q99)')} AS upper
            FROM ({HOUR_LONG}) GROUP BY ALL""",
        "trend_bands": f"""SELECT variable, unit, hour, count, {steadies(['median', 'q05', 'q95', 'mean'])},
            {steady('mean - std')} AS mean_minus_std, {steady('mean + std')} AS mean_plus_std FROM ({HOUR_LONG})""",
        "annotations": f"SELECT l_returnflag, variable, unit, count, median, mean, min, max FROM ({line_long()})",
        "distinct_variables": f"SELECT DISTINCT variable, unit FROM ({line_long()})",
        "sonic_temperature": f"""SELECT event_id,
            {exact('((value * 30.0 + 9000.0) * 0.02) * ((value * 30.0 + 9000.0) * 0.02) / 1.402 / 287.64 - 273.15')} AS t_sonic FROM events""",
        "convert_units": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
            {exact('l_quantity * 0.01')} AS "U", {exact('l_discount * 0.01')} AS "V", {exact('l_tax * 0.01')} AS "W",
            {exact('((l_quantity * 100.0 + 14000.0) * 0.02) * ((l_quantity * 100.0 + 14000.0) * 0.02) / 1.402 / 287.64 - 273.15')} AS "T_SONIC",
            {exact('l_extendedprice * 0.33425::DOUBLE')} AS "CO2", {exact('l_extendedprice * 0.335::DOUBLE')} AS "H2O"
            FROM lineitem""",
        "calibrate_gas": f"""WITH readings AS (
                SELECT event_id, value * 4.0 AS H2O, value * 10.0 + 500.0 AS CO2,
                    CASE WHEN user_id % 40 = 7 THEN 0.0::DOUBLE WHEN user_id % 40 <> 9 THEN user_id % 40 + 60.0::DOUBLE END AS Plic,
                    event_id % 25 + 10.0::DOUBLE AS Tlic FROM events
            ) SELECT event_id, H2O, CO2, calibrated FROM ({calibrated('readings', 'event_id')})""",
        "update_non_null": """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value * 2 ELSE value END AS value
            FROM events""",
        "era_multiplier": f"""SELECT o_orderkey, o_orderdate, start_ts,
                CAST({ERA.format(1.0, 0.33425, 1.0)} AS DOUBLE) AS co2_mult,
                CAST({ERA.format(1.0, 0.335, 0.335)} AS DOUBLE) AS h2o_mult
            FROM (SELECT o_orderkey, o_orderdate, o_orderdate + to_hours(o_orderkey % 24) AS start_ts FROM orders)""",
        "period_linear": f"""SELECT o_orderkey, o_orderdate,
            CASE {PERIOD_LINEAR} ELSE o_totalprice END AS o_totalprice FROM orders""",
        "sentinel_roundtrip": """SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN value END AS reading,
            CASE WHEN event_id % 13 <> 0 THEN event_type END AS mark,
            CASE WHEN event_id % 17 = 0 THEN -9999.0::DOUBLE ELSE value END AS written FROM events""",
        "coerce_numeric": f"SELECT event_id, {number(NUMBER_TEXT)} AS reading FROM events",
        "strict_numeric": "SELECT event_id, value AS reading FROM events",
        "sorted_columns": "SELECT * FROM lineitem",
        "row_index": f"""SELECT event_id, hour,
            row_number() OVER (PARTITION BY hour ORDER BY ts, event_id) - 1 AS row_idx FROM ({HOURLY})""",
        "time_axis": f"""SELECT *, hour + to_microseconds(row_idx * 48000000768 // 1000000) AS axis_ts FROM (
            SELECT event_id, hour, row_number() OVER (PARTITION BY hour ORDER BY ts, event_id) - 1 AS row_idx
            FROM ({HOURLY}))""",
        "dedupe_last": f"""SELECT * EXCLUDE (props) FROM ({HOURLY})
            QUALIFY row_number() OVER (PARTITION BY user_id, hour ORDER BY ts DESC, event_id DESC) = 1""",
        "interp_linear": f"""WITH {CHANNELS}, {interpolated('fast', 'slow', 'day', ['slow_value', 'slow_user'], None, None)}
            SELECT * FROM aligned""",
        "align_slow": f"""WITH {CHANNELS},
            {interpolated('fast', 'slow', 'day', ['slow_value', 'slow_user'], 1_800_000_000, 10_000)}
            SELECT event_id, day, ts, value, {fills('ts, event_id', 'day', 'slow_value')['bffill']} AS slow_value,
                {fills('ts, event_id', 'day', 'slow_user')['bffill']} AS slow_user FROM aligned""",
        "ramp_daily": f"WITH {SEGMENTS} SELECT o_orderpriority, date, {steady('factor')} AS factor FROM ramp",
        "factor_outer": f"""WITH {SEGMENTS}, u AS (SELECT date, max(factor) AS f FROM ramp WHERE o_orderpriority < '3' GROUP BY 1),
            l AS (SELECT date, min(factor) AS f FROM ramp WHERE o_orderpriority >= '3' GROUP BY 1)
            SELECT date, {steady('u.f')} AS co2_factor, {steady('l.f')} AS h2o_factor FROM u FULL JOIN l USING (date)""",
        "factor_join": f"""WITH {SEGMENTS}, f AS (SELECT date, max(factor) AS factor FROM ramp GROUP BY 1)
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS day,
                {steady('l_quantity * coalesce(factor, 1)')} AS l_quantity, factor IS NULL AS factor_missing
            FROM lineitem LEFT JOIN f ON CAST(l_shipdate AS DATE) = f.date""",
        "factor_tables": f"""WITH segments AS (
                SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS a, last_day(date_trunc('month', o_orderdate)) AS b,
                    avg(o_totalprice) / 250000 AS f, max(o_totalprice) / 250000 AS t FROM orders GROUP BY ALL
            ), anchors AS (SELECT a AS d, f AS v FROM segments UNION ALL SELECT b, t FROM segments),
            lines AS (SELECT *, lead(d) OVER w AS d1, lead(v) OVER w AS v1 FROM anchors WINDOW w AS (ORDER BY d)),
            days AS (SELECT *, CAST(unnest(generate_series(d, coalesce(d1 - 1, d), INTERVAL 1 DAY)) AS DATE) AS day FROM lines)
            SELECT day AS date, {steady('CASE WHEN d1 IS NULL THEN v ELSE v + (v1 - v) * (day - d) / (d1 - d) END')} AS h2o_factor FROM days""",
        "series_text": f"""WITH rows AS (SELECT 'h' || strftime(hour, '%Y%m%d%H%M') AS file_id, event_id, value FROM ({HOURLY}))
            SELECT file_id, CAST(event_id AS VARCHAR) AS event_id,
                CASE WHEN event_id % 9 > 0 THEN CAST(value AS VARCHAR) ELSE '-9999.0' END AS x FROM rows
            UNION ALL SELECT DISTINCT file_id, '[-]', '[V]' FROM rows""",
        "stats_text": f"SELECT hour, {summary('value')} FROM ({HOURLY}) GROUP BY hour",
        "lookup_long": """WITH days AS (SELECT o_orderdate AS a, o_orderdate + INTERVAL 2 DAY AS b, count(*) AS n FROM orders GROUP BY 1),
            cut AS (SELECT a, least(b, coalesce(lead(a) OVER (ORDER BY a), b)) AS z, n FROM days)
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, coalesce(n, 0) AS n_orders
            FROM lineitem LEFT JOIN cut ON l_shipdate >= a AND l_shipdate < z""",
        "segment_dates": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date,
            CAST(o_orderdate AS DATE) + 10 AS end_date FROM orders""",
        "pair_files": f"""SELECT stem, raw_name, aux_name, start_ts FROM (
                SELECT DISTINCT 'Site' || strftime(hour, '%y%m%d_%H') AS stem, hour AS start_ts,
                    'Site' || strftime(hour, '%y%m%d_%H') || '.raw' AS raw_name
                FROM ({HOURLY}) WHERE event_type = 'click'
            ) JOIN (
                SELECT DISTINCT 'Site' || strftime(hour, '%y%m%d_%H') AS stem,
                    'Site' || strftime(hour, '%y%m%d_%H') || '.aux' AS aux_name
                FROM ({HOURLY}) WHERE event_type = 'purchase'
            ) USING (stem)""",
        "filename_time": """SELECT o_orderkey, 'Site' || strftime(s, '%y%m%d_%H') || '.raw' AS name, s AS start_ts,
                CAST(s AS DATE) AS file_date, strftime(s, '%Y%m%d%H%M') AS start_label
            FROM (SELECT o_orderkey, o_orderdate + to_hours(o_orderkey % 24) AS s FROM orders)""",
        "parse_dates": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed_date,
            CASE WHEN o_orderkey % 26 < 24 THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(o_orderkey % 26)
                + to_minutes(o_orderkey % 60) + to_seconds(o_orderkey % 7) END AS parsed_ts FROM orders""",
        "date_labels": """SELECT o_orderkey, o_orderdate, CAST(day(o_orderdate) AS INTEGER) AS day,
            CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
            strftime(o_orderdate, '%Y-%m') AS year_month FROM orders""",
        "parse_table": f"""WITH {DOC_LINES} SELECT doc_id, row_idx, CAST(len(cells) AS INTEGER) AS n_cells,
            array_to_string(cells, '|') AS row_cells FROM doc_unquoted""",
        "reconcile_width": f"""WITH {DOC_LINES} SELECT doc_id, CAST(n0 + extra AS INTEGER) AS n_header,
            CAST(extra AS INTEGER) AS n_generated, CAST(len(data) AS INTEGER) AS n_lines FROM sized""",
        "header_map": f"""WITH {DOC_LINES} SELECT doc_id, CAST(pos AS INTEGER) AS pos, name,
            CASE WHEN trim(coalesce(unit, '')) = '' THEN '[-]' ELSE unit END AS unit FROM (
                SELECT doc_id, generate_subscripts(names, 1) - 1 AS pos, unnest(names) AS name,
                    unnest(list_resize(units, len(names))) AS unit FROM sized
            ) WHERE trim(name) <> '' AND NOT contains(name, 'unknown')""",
        "split_malformed": f"""WITH {DOC_LINES} SELECT doc_id, row_idx, CASE WHEN len(cells) > width THEN 'bad' ELSE 'good' END AS kind,
            array_to_string(cells, '|') AS row_cells FROM doc_unquoted""",
        "quarantine": f"""WITH {DOC_LINES} SELECT doc_id, row_idx, len(cells) > width AS malformed, array_to_string(cells[1:width], ' ') AS row_text,
            CASE WHEN len(cells) > width THEN line END AS rejected FROM doc_unquoted""",
        "blank_lines": """SELECT doc_id, row_idx, line FROM (
                SELECT doc_id, generate_subscripts(data, 1) - 1 AS row_idx, unnest(data) AS line FROM (
                    SELECT doc_id, list_filter(string_split(text, chr(10))[2:], lambda x: trim(x) <> '') AS data
                    FROM documents))""",
        "strip_nul": "SELECT doc_id, CAST(length(text) AS INTEGER) AS n, md5(text) AS digest FROM documents",
        "ragged_rows": """SELECT event_id, CASE WHEN event_id % 9 <> 2 THEN event_type END AS kind,
            CASE WHEN event_id % 9 <> 2 THEN value END AS reading,
            CASE WHEN event_id % 9 NOT IN (0, 2) THEN CAST(user_id AS DOUBLE) END AS "user",
            event_id % 9 = 1 AS malformed FROM events""",
        "row_validity": "SELECT event_id, ts FROM events WHERE event_id % 13 NOT IN (1, 2, 3)",
        "daily_sizes": f"SELECT date, {steady('mb')} AS mb FROM ({SIZED_DAYS})",
        "densify_days": f"""WITH sized AS (SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS mb FROM orders GROUP BY 1),
            days AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM sized)
            SELECT date, {steady('mb')} AS mb FROM days LEFT JOIN sized USING (date)""",
        "densify_nulls": """WITH given AS (
                SELECT CASE WHEN event_id % 5 > 0 THEN user_id % 7 END AS k, event_id, value,
                    CASE WHEN event_id % 11 = 0 THEN ts WHEN event_id % 17 <> 0 THEN date_trunc('hour', ts) END AS t FROM events
            ), ends AS (SELECT k, min(t) AS a, max(t) AS z FROM given GROUP BY k),
            placed AS (SELECT g.*, coalesce((epoch_us(t) - epoch_us(a)) % 3600000000 = 0, false) AS fits
                FROM given g JOIN ends e ON g.k IS NOT DISTINCT FROM e.k),
            steps AS (SELECT k, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS t FROM ends)
            SELECT s.k, s.t AS at, event_id, value FROM steps s LEFT JOIN placed p ON fits AND s.k IS NOT DISTINCT FROM p.k AND s.t = p.t
            UNION ALL SELECT k, t AS at, event_id, value FROM placed WHERE NOT fits""",
        "densify_users": f"""WITH daily AS (
                SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS total FROM events GROUP BY ALL
            ), days AS (
                SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
                FROM daily GROUP BY user_id
            ) SELECT user_id, day, {steady('total')} AS total FROM days LEFT JOIN daily USING (user_id, day)""",
        "availability_matrix": "SELECT strftime(o_orderdate, '%Y-%m') AS year_month, "
        + ", ".join(f'max(CASE WHEN day(o_orderdate) = {d} THEN o_totalprice END) AS "{d}"' for d in range(1, 32))
        + " FROM orders GROUP BY 1",
        "column_quality": " UNION ALL ".join(
            column_state(c, text, unit)
            for c, text, unit in (
                ("event_type", "event_type", "[-]"),
                ("value", "CAST(value AS VARCHAR)", "[V]"),
                ("props", "props", "[-]"),
                ("nothing", "CAST(NULL AS VARCHAR)", "[-]"),
                ("code", "lower(to_hex(user_id))", "[hexadecimal_value]"),
                ("mixed", NUMBER_TEXT, "[-]"),
            )
        ),
        "convert_series": f"""{played()} SELECT event_id, file_id, row_idx, ts, calibrated,
            {', '.join(f'{c} AS "{OUT.get(c, c)}"' for c in (*FAST, *SLOW))} FROM final""",
        "series_summary": f"{played()} "
        + " UNION ALL ".join(
            f"SELECT file_id, start_ts, '{OUT.get(c, c)}' AS variable, '{UNITS[c]}' AS unit, {summary(c)} FROM final "
            "GROUP BY file_id, start_ts"
            for c in (*FAST, *SLOW)
        ),
        "file_manifest": f"""WITH numbered AS (
                SELECT event_id, hour, row_number() OVER (PARTITION BY hour ORDER BY ts, event_id) - 1 AS row_idx
                FROM ({HOURLY})
            ) SELECT hour, count(*) AS n_rows, min(axis) AS first_ts, max(axis) AS last_ts,
                count(*) FILTER (event_id % 13 = 0) AS n_malformed, strftime(min(axis), '%Y%m%d%H%M') AS start_label
            FROM (SELECT *, hour + to_microseconds(row_idx * 48000000768 // 1000000) AS axis FROM numbered)
            GROUP BY hour""",
    }
    for name, expression in fills().items():
        out[name] = f"SELECT event_type, ts, event_id, {expression} AS value FROM ({GAPPY})"
    for direction in ("nearest", "backward", "forward"):
        out[f"asof_{direction}"] = asof(direction)
    return out
