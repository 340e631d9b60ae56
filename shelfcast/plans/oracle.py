"""The registered queries in SQL for another engine, written from the definitions.

Where the Spark side derives a result in a cheaper way (stretched days instead of
a calendar join, block sums instead of copied rows) the SQL keeps the plain form,
so that a match checks the shortcut.
"""

from __future__ import annotations

from shelfcast.schemas import EXPORT_COLUMNS, FEATURES
from shelfcast.operators.calendar import LOCAL_HOLIDAYS, NATIONAL_HOLIDAYS
from shelfcast.sources.star import END, SPLIT, START, YEAR

MEASURES = ("mae", "rmse", "mape", "smape")


def _round(name: str, digits: int = 6) -> str:
    unit = f"1e{digits}"
    return f"floor(CAST({name} AS DOUBLE) * {unit} + 0.5) / {unit} AS {name}"


def _day(name: str) -> str:
    return f"CAST({name} AS VARCHAR) AS {name}"


def _tidy(body: str, numbers=(), days=(), digits: int = 6, ctes: str = "") -> str:
    """``body`` with rounded numbers and dates as text."""
    changes = ", ".join([_round(n, digits) for n in numbers] + [_day(d) for d in days])
    replace = f" REPLACE ({changes})" if changes else ""
    return f"{'WITH ' + ctes if ctes else ''} SELECT *{replace} FROM ({body}) AS result"


def _part_barcode(key: str) -> str:
    width = f"CASE WHEN {key} % 7 = 0 THEN 5 ELSE 6 END"
    digits = f"CAST({key} AS VARCHAR)"
    return (
        f"(CASE WHEN {key} % 5 = 0 THEN '2' ELSE '7' END"
        f" || repeat('0', greatest({width} - length({digits}), 0)) || {digits})"
    )


def _product_barcode(code: str) -> str:
    return f"('7' || lpad(CAST({code} AS VARCHAR), 12, '0'))"


BRAND = "CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT)"
CODES = {"brand": BRAND, "supplier": "l_suppkey", "part": "l_partkey"}
PRODUCTS = {
    "brand": f"SELECT DISTINCT {BRAND} AS product_code, {_product_barcode(BRAND)} AS barcode FROM part",
    "supplier": f"SELECT s_suppkey AS product_code, {_product_barcode('s_suppkey')} AS barcode FROM supplier",
    "part": f"SELECT p_partkey AS product_code, {_part_barcode('p_partkey')} AS barcode FROM part",
}
CODES["assortment"] = BRAND
PRODUCTS["assortment"] = f"{PRODUCTS['brand']} UNION ALL SELECT -s_suppkey, '2' || lpad(CAST(s_suppkey AS VARCHAR), 12, '0') FROM supplier"


def _store(product: str = "brand") -> str:
    return f"""
lines AS (
  SELECT l_orderkey AS sale_id, {CODES[product]} AS product_code, {_part_barcode('l_partkey')} AS barcode,
         CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END AS on_promotion, l_quantity AS quantity,
         CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END AS returned_quantity,
         l_extendedprice / nullif(l_quantity, 0) AS unit_value, p_retailprice AS cost_value,
         l_discount AS discount, l_tax AS increase
  FROM lineitem JOIN part ON l_partkey = p_partkey),
products AS ({PRODUCTS[product]})"""


def _daily(start: str = START, end: str = END, where: str = "true") -> str:
    """Medians by the engine's own aggregate; means of four-decimal amounts in whole units."""

    def mean(c: str) -> str:
        return f"floor(CAST(sum(CAST(round(coalesce({c}, 0) * 10000) AS BIGINT)) AS DOUBLE) / (count(*) * 10000.0) * 1000 + 0.5) / 1000 AS {c}"

    def middle(c: str) -> str:
        return f"floor(median(coalesce({c}, 0)) * 1000 + 0.5) / 1000 AS {c}"

    return f"""
rolled AS (
  SELECT CAST(o_orderdate AS DATE) AS date, product_code, lines.barcode AS line_barcode, max(on_promotion) AS on_promotion,
         CAST(trunc(sum(coalesce(quantity, 0))) AS DOUBLE) AS quantity,
         CAST(trunc(sum(coalesce(returned_quantity, 0))) AS DOUBLE) AS returned_quantity,
         {middle('unit_value')}, {middle('cost_value')}, {mean('discount')}, {mean('increase')}
  FROM lines JOIN orders ON sale_id = o_orderkey
  WHERE lines.barcode IS NOT NULL AND CAST(o_orderdate AS DATE) BETWEEN DATE '{start}' AND DATE '{end}' AND {where}
  GROUP BY 1, 2, 3),
daily AS (
  SELECT rolled.date, rolled.product_code, line_barcode, products.barcode, on_promotion, quantity, returned_quantity,
         unit_value, cost_value, discount, increase, floor(quantity * unit_value * 1000 + 0.5) / 1000 AS total_value
  FROM rolled JOIN products ON rolled.product_code = products.product_code)"""


def _merged() -> str:
    def mean(c: str) -> str:
        return f"CAST(sum(CAST(round({c} * 1000) AS BIGINT)) AS DOUBLE) / (count(*) * 1000.0) AS {c}"

    def total(c: str) -> str:
        return f"CAST(sum(CAST(round({c} * 1000) AS BIGINT)) AS DOUBLE) / 1000.0 AS {c}"

    return f"""
merged AS (
  SELECT barcode, date, min(product_code) AS product_code, max(on_promotion) AS on_promotion, {total('quantity')},
         {total('returned_quantity')}, {mean('unit_value')}, {mean('discount')}, {mean('increase')}, {mean('cost_value')},
         {total('total_value')}
  FROM daily GROUP BY barcode, date)"""


def _dense(start: str = START, end: str = END) -> str:
    """A calendar per product, left join, forward fill."""
    fill = "OVER (PARTITION BY c.barcode ORDER BY c.date ROWS UNBOUNDED PRECEDING)"
    return f"""
spans AS (
  SELECT p.barcode, min(p.product_code) AS product_code, coalesce(min(m.date), DATE '{start}') AS first_day,
         count(m.date) = 0 AS unsold
  FROM products p LEFT JOIN merged m ON p.barcode = m.barcode GROUP BY p.barcode),
calendar AS (
  SELECT barcode, product_code, unsold,
         CAST(unnest(generate_series(first_day, DATE '{end}', INTERVAL 1 DAY)) AS DATE) AS date
  FROM spans),
dense AS (
  SELECT c.barcode, c.date, c.product_code,
         CASE WHEN unsold THEN 0 ELSE last_value(m.unit_value IGNORE NULLS) {fill} END AS unit_value,
         CASE WHEN unsold THEN 0 ELSE last_value(m.cost_value IGNORE NULLS) {fill} END AS cost_value,
         coalesce(m.on_promotion, 0) AS on_promotion, coalesce(m.quantity, 0) AS quantity,
         coalesce(m.returned_quantity, 0) AS returned_quantity, coalesce(m.discount, 0) AS discount,
         coalesce(m.increase, 0) AS increase, coalesce(m.total_value, 0) AS total_value
  FROM calendar c LEFT JOIN merged m ON c.barcode = m.barcode AND c.date = m.date)"""


def _on(date: str, rules) -> str:
    pairs = ", ".join(f"({m}, {d})" for m, d, _ in rules)
    return f"(month({date}), day({date})) IN ({pairs})"


def _holidays() -> str:
    return f"""
flagged AS (
  SELECT *, CASE WHEN {_on('date', NATIONAL_HOLIDAYS + LOCAL_HOLIDAYS)} THEN 1 ELSE 0 END AS holiday FROM dense)"""


def _calendar_columns() -> str:
    return """
         CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
         CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CAST(dayofyear(date) AS INTEGER) AS day_of_year, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
         CASE WHEN day(date) <= 3 THEN 1 ELSE 0 END AS start_month,
         CASE WHEN day(date) >= day(last_day(date)) - 2 THEN 1 ELSE 0 END AS end_month,
         sin(2 * pi() * (isodow(date) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(date) - 1) / 7) AS dow_cos,
         sin(2 * pi() * (month(date) - 1) / 12) AS m_sin, cos(2 * pi() * (month(date) - 1) / 12) AS m_cos"""


def _history_columns() -> str:
    w = "(PARTITION BY barcode ORDER BY date)"
    before = "(PARTITION BY barcode ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
    lags = ", ".join(f"lag(quantity, {n}) OVER {w} AS lag_{n}" for n in (1, 7, 14, 21, 30))
    return f"""
         {lags},
         CASE WHEN count(*) OVER {before} = 7 THEN avg(quantity) OVER {before} END AS rolling_mean_7,
         CASE WHEN count(*) OVER {before} = 7 THEN stddev_samp(quantity) OVER {before} END AS rolling_std_7,
         CAST(lag(on_promotion, 1) OVER {w} AS DOUBLE) AS promo_lag_1,
         lag(returned_quantity, 1) OVER {w} AS returned_lag_1"""


RATES = """
         discount / nullif(unit_value + discount, 0) AS discount_rate,
         increase / nullif(unit_value + 1e-5, 0) AS increase_rate,
         returned_lag_1 / nullif(lag_1 + 1e-5, 0) AS returned_rate,
         (unit_value - cost_value) / nullif(unit_value + 1e-5, 0) AS profit_margin"""


def _features() -> str:
    base = "barcode, date, unit_value, cost_value, on_promotion, quantity, returned_quantity, discount, increase, holiday"
    names = [c for c in (*base.split(", "), *FEATURES)]
    columns = ", ".join(dict.fromkeys(names))
    complete = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)
    return f"""
history AS (
  SELECT {base}, {_calendar_columns()}, {_history_columns()},
         coalesce(lag(holiday, 1) OVER (PARTITION BY barcode ORDER BY date), 0) AS holiday_lag_1
  FROM flagged),
rated AS (SELECT *, {RATES} FROM history),
features AS (SELECT {columns} FROM rated WHERE {complete}),
train AS (SELECT * FROM features WHERE date < DATE '{SPLIT}')"""


def _base(product: str = "brand", upto: str = "features", start: str = START, end: str = END, where: str = "true") -> str:
    stages = {
        "store": lambda: _store(product),
        "daily": lambda: _daily(start, end, where),
        "merged": _merged,
        "dense": lambda: _dense(start, end),
        "flagged": _holidays,
        "features": _features,
    }
    parts = []
    for name, make in stages.items():
        parts.append(make())
        if name == upto:
            break
    return ",".join(parts)


PREDICTIONS = f"""
predictions AS (
  SELECT 'naive' AS model, barcode, date, quantity AS real, lag_1 AS forecast FROM features WHERE year(date) = {YEAR}
  UNION ALL
  SELECT 'mean7', barcode, date, quantity, rolling_mean_7 FROM features WHERE year(date) = {YEAR})"""

WIDE = f"""
wide AS (
  SELECT barcode, date, quantity AS real, lag_1 AS naive, rolling_mean_7 AS mean7 FROM features WHERE year(date) = {YEAR})"""


def _scores(real: str = "real", forecast: str = "forecast") -> str:
    return f"""
  avg(abs({real} - {forecast})) AS mae, sqrt(avg(({real} - {forecast}) * ({real} - {forecast}))) AS rmse,
  avg(CASE WHEN {real} <> 0 THEN abs({real} - {forecast}) / abs({real}) END) * 100 AS mape,
  avg(CASE WHEN abs({real}) + abs({forecast}) <> 0 THEN abs({real} - {forecast}) / ((abs({real}) + abs({forecast})) / 2) END) * 100 AS smape"""


def _windows(train_rows: int, test_rows: int, step: int, source: str) -> str:
    """Windows by joining every window start with its rows."""
    return f"""
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY date) - 1 AS position FROM {source}),
starts AS (
  SELECT barcode, CAST(unnest(range(0, (n - {train_rows + test_rows}) // {step} + 1)) AS INTEGER) AS window_id
  FROM (SELECT barcode, count(*) AS n FROM {source} GROUP BY barcode) AS sizes WHERE n >= {train_rows + test_rows}),
windows AS (
  SELECT numbered.*, window_id,
         CASE WHEN position < window_id * {step} + {train_rows} THEN 'train' ELSE 'test' END AS role
  FROM numbered JOIN starts ON numbered.barcode = starts.barcode
  WHERE position >= window_id * {step} AND position < window_id * {step} + {train_rows + test_rows})"""


def _daily_error_columns(model: str) -> str:
    e = f"abs({model} - real)"
    return (
        f"{e} AS mae_{model}, sqrt(({model} - real) * ({model} - real)) AS rmse_{model}, "
        f"{e} / nullif(abs(real), 0) * 100 AS mape_{model}, "
        f"{e} / nullif((abs(real) + abs({model})) / 2, 0) * 100 AS smape_{model}"
    )


ARTIFACTS = f"""
predicted AS (
  SELECT DISTINCT {_part_barcode('l_partkey')} AS barcode, month(o_orderdate) AS month
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) = {YEAR}),
charted AS (
  SELECT DISTINCT {_part_barcode('l_partkey')} AS barcode, month(l_shipdate) AS month
  FROM lineitem WHERE year(l_shipdate) = {YEAR}),
all_products AS ({PRODUCTS['part']}),
raw AS (SELECT barcode FROM all_products WHERE length(barcode) >= 7 AND barcode LIKE '7%')"""


def _market(segment: str) -> str:
    return f"""
  SELECT DISTINCT {_part_barcode('l_partkey')} AS barcode FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = '{segment}'"""


DONE = "done AS (SELECT barcode FROM predicted INTERSECT SELECT barcode FROM charted)"
COVERAGE = """
months AS (SELECT unnest(range(1, 13)) AS month),
gaps AS (
  SELECT p.barcode,
         coalesce(string_agg(CASE WHEN a.month IS NULL THEN lpad(CAST(m.month AS VARCHAR), 2, '0') END, ', ' ORDER BY m.month), '') AS missing_predictions,
         coalesce(string_agg(CASE WHEN c.month IS NULL THEN lpad(CAST(m.month AS VARCHAR), 2, '0') END, ', ' ORDER BY m.month), '') AS missing_charts
  FROM (SELECT DISTINCT barcode FROM all_products) p, months m
  LEFT JOIN predicted a ON a.barcode = p.barcode AND a.month = m.month
  LEFT JOIN charted c ON c.barcode = p.barcode AND c.month = m.month
  GROUP BY p.barcode),
coverage AS (
  SELECT *, CASE WHEN missing_predictions = '' AND missing_charts = '' THEN 1 ELSE 0 END AS complete FROM gaps)"""

AMOUNTS = ("quantity", "returned_quantity", "unit_value", "cost_value", "discount", "increase", "total_value")
DENSE_COLUMNS = ("barcode", "date", "product_code", "unit_value", "cost_value", "on_promotion", "quantity", "returned_quantity", "discount", "increase", "total_value")
WHOLE = {"on_promotion", "holiday", "day_of_week", "month", "is_weekend", "holiday_lag_1", "day_of_year", "week_of_year", "start_month", "end_month"}
FEATURE_NUMBERS = [c for c in FEATURES if c not in WHOLE] + ["quantity"]


def _export() -> str:
    columns = ", ".join(f"{new} AS {old}" for new, old in EXPORT_COLUMNS.items())
    return f"SELECT {columns} FROM flagged"


def _scaled(columns) -> str:
    stats = ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS {c}_mean, stddev_pop(CAST({c} AS DOUBLE)) AS {c}_std" for c in columns
    )
    scaled = ", ".join(
        f"(CAST({c} AS DOUBLE) - {c}_mean) / CASE WHEN {c}_std = 0 THEN 1 ELSE {c}_std END AS {c}" for c in columns
    )
    return (
        f"SELECT features.barcode, date, {scaled} FROM features JOIN "
        f"(SELECT barcode, {stats} FROM train GROUP BY barcode) AS s ON features.barcode = s.barcode"
    )


WINDOW_STATS = "SELECT barcode, window_id, {} FROM windows WHERE role = 'train' GROUP BY barcode, window_id".format(
    ", ".join(
        f"avg(CAST({c} AS DOUBLE)) AS {c}_mean, CASE WHEN min({c}) = max({c}) THEN 1 ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS {c}_std"
        for c in FEATURES
    )
)
EARLY = "1995-02-10"


def _unpivoted(select, source: str) -> str:
    return " UNION ALL ".join(f"SELECT {select(c)} FROM {source}" for c in FEATURES)


def oracle_sql() -> dict[str, str]:
    top = f"""
scores AS (
  SELECT l_partkey AS product_code, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS score
  FROM lineitem GROUP BY l_partkey),
top AS (
  SELECT s.product_code, p.barcode, s.score FROM scores s JOIN ({PRODUCTS['part']}) p ON s.product_code = p.product_code
  WHERE length(p.barcode) >= 7 AND p.barcode LIKE '7%' ORDER BY s.score DESC, s.product_code LIMIT 1000)"""
    eve = f"CASE WHEN {_on('date + INTERVAL 1 DAY', NATIONAL_HOLIDAYS)} THEN 1 ELSE 0 END AS holiday_eve"
    flag = f"CASE WHEN {_on('date', NATIONAL_HOLIDAYS)} THEN 1 ELSE 0 END AS holiday"
    lags = [f"lag_{n}" for n in (1, 7, 14, 21, 30)]
    before7 = "PARTITION BY barcode ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING"
    pooled = "SELECT {keys}, {scores}, count(*) AS n FROM {source} GROUP BY {keys}"
    leak_groups = ", ".join(
        f"CASE WHEN min({c}) < max({c}) AND min(quantity) < max(quantity) THEN covar_pop({c}, quantity) / (stddev_pop({c}) * stddev_pop(quantity)) END AS {c}"
        for c in FEATURES
    )
    weekly = _base() + "," + _windows(365, 7, 7, "train")
    return {
        "daily_sales": _tidy("SELECT * FROM daily", AMOUNTS, ["date"], ctes=_base(upto="daily")),
        "daily_sales_split": _tidy("SELECT * FROM daily", AMOUNTS, ["date"], ctes=_base(upto="daily")),
        "daily_sales_wanted": _tidy(
            "SELECT * FROM daily",
            AMOUNTS,
            ["date"],
            ctes=top + "," + _base("part", upto="daily", where="product_code IN (SELECT product_code FROM top)"),
        ),
        "merge_duplicate_days": _tidy("SELECT * FROM merged", AMOUNTS, ["date"], ctes=_base(upto="merged")),
        "calendar_dense": _tidy("SELECT * FROM dense", AMOUNTS, ["date"], ctes=_base(upto="dense")),
        "calendar_unsold": _tidy(
            "SELECT * FROM dense",
            AMOUNTS,
            ["date"],
            ctes=_base("supplier", "dense", "1996-01-01", "1996-12-31", "on_promotion = 1 AND returned_quantity > 40"),
        ),
        "calendar_assortment": _tidy("SELECT * FROM dense", AMOUNTS, ["date"], ctes=_base("assortment", "dense")),
        "holiday_flags": _tidy(
            f"SELECT barcode, date, quantity, {flag}, {eve} FROM dense", ["quantity"], ["date"], ctes=_base(upto="dense")
        ),
        "holiday_override": _tidy(
            "SELECT barcode, date, quantity, holiday FROM flagged", ["quantity"], ["date"], ctes=_base(upto="flagged")
        ),
        "holiday_override_rows": _tidy(
            "SELECT count(*) AS rows_10_18 FROM dense WHERE month(date) = 10 AND day(date) = 18", ctes=_base(upto="dense")
        ),
        "daily_export": _tidy(
            _export(), [EXPORT_COLUMNS[c] for c in AMOUNTS], ["Date"], ctes=_base(upto="flagged")
        ),
        "consolidated": _tidy(
            f"SELECT {', '.join(DENSE_COLUMNS)}, holiday, {eve} FROM flagged", AMOUNTS, ["date"], ctes=_base(upto="flagged")
        ),
        "product_files": _tidy(
            f"SELECT *, 'market-1' AS market, Barcode AS product FROM ({_export()}) AS e",
            [EXPORT_COLUMNS[c] for c in AMOUNTS],
            ["Date"],
            ctes=_base(upto="flagged"),
        ),
        "quality_counts": _tidy(
            f"""SELECT count(*) AS lines, count(*) FILTER (WHERE l.barcode IS NULL) AS without_barcode,
  count(*) FILTER (WHERE o_orderdate IS NULL) AS without_date,
  count(*) FILTER (WHERE CAST(o_orderdate AS DATE) NOT BETWEEN DATE '{START}' AND DATE '{END}') AS outside_period,
  count(*) FILTER (WHERE p.product_code IS NULL) AS without_product, count(*) FILTER (WHERE quantity IS NULL) AS without_quantity,
  count(*) FILTER (WHERE coalesce(unit_value, 0) <= 0) AS without_price,
  count(*) FILTER (WHERE coalesce(unit_value, 0) < coalesce(cost_value, 0)) AS below_cost
FROM lines l LEFT JOIN orders ON sale_id = o_orderkey LEFT JOIN products p ON l.product_code = p.product_code""",
            ctes=_base(upto="store"),
        ),
        "calendar_features": _tidy(
            f"""SELECT barcode, date, CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS weekend,
  CAST((day(date) - 1) // 7 + 1 AS INTEGER) AS week_of_month, {_calendar_columns()} FROM dense""",
            ["dow_sin", "dow_cos", "m_sin", "m_cos"],
            ["date"],
            ctes=_base(upto="dense"),
        ),
        "lag_features": _tidy(
            f"SELECT barcode, date, {', '.join(lags)}, holiday_lag_1, promo_lag_1 FROM rated",
            [*lags, "promo_lag_1"],
            ["date"],
            ctes=_base(),
        ),
        "rolling_features": _tidy(
            "SELECT barcode, date, rolling_mean_7, rolling_std_7 FROM rated",
            ["rolling_mean_7", "rolling_std_7"],
            ["date"],
            ctes=_base(),
        ),
        "rate_features": _tidy(
            "SELECT barcode, date, discount_rate, increase_rate, returned_rate, profit_margin FROM rated",
            ["discount_rate", "increase_rate", "returned_rate", "profit_margin"],
            ["date"],
            ctes=_base(),
        ),
        "features_clean": _tidy("SELECT * FROM features", FEATURE_NUMBERS, ["date"], ctes=_base()),
        "rows_per_series": _tidy(
            """SELECT d.barcode, d.days, coalesce(f.n, 0) AS complete_rows
FROM (SELECT barcode, count(*) AS days FROM dense GROUP BY barcode) d
LEFT JOIN (SELECT barcode, count(*) AS n FROM features GROUP BY barcode) f ON d.barcode = f.barcode""",
            ctes=_base("supplier", "features", "1996-01-01", "1996-12-31", "on_promotion = 1 AND returned_quantity > 40"),
        ),
        "rows_per_series_assortment": _tidy(
            """SELECT d.barcode, d.days, coalesce(f.n, 0) AS complete_rows
FROM (SELECT barcode, count(*) AS days FROM dense GROUP BY barcode) d
LEFT JOIN (SELECT barcode, count(*) AS n FROM features GROUP BY barcode) f ON d.barcode = f.barcode""",
            ctes=_base("assortment"),
        ),
        "train_forecast_split": _tidy(
            f"""SELECT barcode, date, quantity, CASE WHEN date < DATE '{SPLIT}' THEN 'train' ELSE 'forecast' END AS part
FROM features WHERE date < DATE '{SPLIT}' OR year(date) = {YEAR}""",
            ["quantity"],
            ["date"],
            ctes=_base(),
        ),
        "rolling_windows": _tidy(
            "SELECT barcode, date, quantity, CAST(position AS INTEGER) AS position, window_id, role FROM windows",
            ["quantity"],
            ["date"],
            ctes=_base() + "," + _windows(365, 31, 30, "train"),
        ),
        "window_bounds": _tidy(
            """SELECT barcode, window_id, min(date) FILTER (WHERE role = 'train') AS train_start,
  max(date) FILTER (WHERE role = 'train') AS train_end, min(date) FILTER (WHERE role = 'test') AS test_start,
  max(date) FILTER (WHERE role = 'test') AS test_end, CAST(count(*) FILTER (WHERE role = 'train') AS INTEGER) AS train_rows,
  CAST(count(*) FILTER (WHERE role = 'test') AS INTEGER) AS test_rows
FROM windows GROUP BY barcode, window_id""",
            (),
            ["train_start", "train_end", "test_start", "test_end"],
            ctes=weekly,
        ),
        "validation_split": _tidy(
            """SELECT barcode, date, CASE WHEN position >= floor(n * 0.8) THEN 1 ELSE 0 END AS is_validation FROM (
  SELECT barcode, date, row_number() OVER (PARTITION BY barcode ORDER BY date) - 1 AS position,
         count(*) OVER (PARTITION BY barcode) AS n FROM train) AS t""",
            (),
            ["date"],
            ctes=_base(),
        ),
        "scaler_stats": _tidy(
            _unpivoted(
                lambda c: f"barcode, '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS mean, "
                f"CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1 ELSE stddev_pop(CAST({c} AS DOUBLE)) END AS std",
                "train GROUP BY barcode",
            ),
            ["mean", "std"],
            ctes=_base(),
        ),
        "scaled_features": _tidy(_scaled(FEATURES), FEATURES, ["date"], ctes=_base()),
        "leakage_corr": _tidy(
            f"""SELECT barcode, window_id, feature, corr, CASE WHEN abs(corr) > 0.99 THEN 1 ELSE 0 END AS suspicious FROM (
  SELECT barcode, window_id, unnest([{', '.join(f"'{c}'" for c in FEATURES)}]) AS feature,
         unnest([{', '.join(FEATURES)}]) AS corr
  FROM (SELECT barcode, window_id, {leak_groups} FROM windows WHERE role = 'train' GROUP BY barcode, window_id) AS g) AS u""",
            ["corr"],
            ctes=weekly,
        ),
        "sequences": _tidy(
            f"""SELECT barcode, date, target, CAST(step - 1 AS INTEGER) AS step, {', '.join(f"CAST(steps[step][{i}] AS DOUBLE) AS {c}" for i, c in enumerate(FEATURES, 1))}
FROM (SELECT barcode, date, quantity AS target, list([{', '.join(f"CAST({c} AS DOUBLE)" for c in FEATURES)}]) OVER ({before7}) AS steps FROM features) AS s,
  generate_series(1, 7) AS g(step) WHERE len(steps) = 7""",
            ["target", *FEATURES],
            ["date"],
            ctes=_base(),
        ),
        "naive_baseline": _tidy(
            """SELECT barcode, avg(abs(quantity - before)) AS naive_mae, count(before) AS n FROM (
  SELECT barcode, quantity, lag(quantity) OVER (PARTITION BY barcode ORDER BY date) AS before FROM train) AS t GROUP BY barcode""",
            ["naive_mae"],
            ctes=_base(),
        ),
        "backtest_naive": _tidy(
            "SELECT barcode, date, quantity AS real, lag_1 AS naive, rolling_mean_7 AS mean7, window_id FROM windows WHERE role = 'test'",
            ["real", "naive", "mean7"],
            ["date"],
            ctes=weekly,
        ),
        "backtest_linear": _tidy(
            """SELECT w.barcode, w.window_id, date, quantity AS real, a + b * lag_1 AS forecast FROM windows AS w JOIN (
  SELECT barcode, window_id, regr_intercept(quantity, lag_1) AS a, regr_slope(quantity, lag_1) AS b
  FROM windows WHERE position < window_id * 7 + 292 GROUP BY barcode, window_id) AS f
  ON w.barcode = f.barcode AND w.window_id = f.window_id WHERE role = 'test'""",
            ["real", "forecast"],
            ["date"],
            digits=4,
            ctes=weekly,
        ),
        "metrics_by_window": _tidy(
            pooled.format(
                keys="barcode, window_id",
                scores=_scores("quantity", "rolling_mean_7"),
                source="(SELECT * FROM windows WHERE role = 'test') AS w",
            ),
            MEASURES,
            ctes=weekly,
        ),
        "metrics_by_series": _tidy(
            pooled.format(keys="model, barcode", scores=_scores(), source="predictions"),
            MEASURES,
            ctes=_base() + "," + PREDICTIONS,
        ),
        "metrics_by_model": _tidy(
            pooled.format(keys="model", scores=_scores(), source="predictions"), MEASURES, ctes=_base() + "," + PREDICTIONS
        ),
        "metrics_mean_of_daily": _tidy(
            """SELECT model, barcode, avg(e) AS mae, avg(sqrt(e * e)) AS rmse, avg(e / nullif(abs(real), 0) * 100) AS mape,
  avg(e / nullif((abs(real) + abs(forecast)) / 2, 0) * 100) AS smape
FROM (SELECT *, abs(real - forecast) AS e FROM predictions) AS p GROUP BY model, barcode""",
            MEASURES,
            ctes=_base() + "," + PREDICTIONS,
        ),
        "metrics_last_month": _tidy(
            pooled.format(
                keys="model, barcode, month",
                scores=_scores(),
                source="""(SELECT *, CAST(date_trunc('month', date) AS DATE) AS month FROM predictions
  QUALIFY date_trunc('month', date) = max(date_trunc('month', date)) OVER (PARTITION BY model, barcode)) AS p""",
            ),
            MEASURES,
            ["month"],
            ctes=_base() + "," + PREDICTIONS,
        ),
        "compare_merge": _tidy(
            """SELECT coalesce(a.barcode, b.barcode) AS barcode, coalesce(a.date, b.date) AS date,
  coalesce(a.real, b.real) AS real, a.forecast AS naive, b.forecast AS mean7
FROM (SELECT * FROM predictions WHERE model = 'naive' AND month(date) <= 9) a
FULL OUTER JOIN (SELECT * FROM predictions WHERE model = 'mean7' AND month(date) >= 4) b
  ON a.barcode = b.barcode AND a.date = b.date""",
            ["real", "naive", "mean7"],
            ["date"],
            ctes=_base() + "," + PREDICTIONS,
        ),
        "compare_merge_coverage": _tidy(
            """SELECT coalesce(a.barcode, b.barcode) AS barcode, coalesce(a.date, b.date) AS date,
  coalesce(a.quantity, b.quantity) AS real, a.lag_1 AS naive, b.rolling_mean_7 AS mean7
FROM (SELECT * FROM rated WHERE lag_1 IS NOT NULL) a
FULL OUTER JOIN features b ON a.barcode = b.barcode AND a.date = b.date""",
            ["real", "naive", "mean7"],
            ["date"],
            # Both sides read it, so it is worked out once.
            ctes=_base().replace("rated AS (", "rated AS MATERIALIZED ("),
        ),
        "daily_errors": _tidy(
            f"""SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  {_daily_error_columns('naive')}, {_daily_error_columns('mean7')} FROM wide""",
            ["real", "naive", "mean7", *[f"{m}_{x}" for x in ("naive", "mean7") for m in MEASURES]],
            ["date"],
            ctes=_base() + "," + WIDE,
        ),
        "annual_summary": _tidy(
            """SELECT barcode, CAST(year(date) AS INTEGER) AS year, sum(real) AS real, sum(naive) AS naive, sum(mean7) AS mean7
FROM wide GROUP BY 1, 2""",
            ["real", "naive", "mean7"],
            ctes=_base() + "," + WIDE,
        ),
        "chart_series": _tidy(
            " UNION ALL ".join(
                f"""SELECT barcode, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, date,
  '{c}' AS series_name, {c} AS value FROM wide"""
                for c in ("real", "naive", "mean7")
            ),
            ["value"],
            ["date"],
            ctes=_base() + "," + WIDE,
        ),
        "predictions_reload": _tidy(
            "SELECT * FROM predictions WHERE model = 'naive'",
            ["real", "forecast"],
            ["date"],
            ctes=_base() + "," + PREDICTIONS,
        ),
        "top_products": _tidy("SELECT * FROM top", ["score"], ctes=top),
        "barcode_lookup": _tidy(
            f"""SELECT w.barcode, min(l.product_code) AS product_code FROM (
  SELECT barcode FROM products UNION SELECT {_product_barcode('s_suppkey')} FROM supplier) w
LEFT JOIN lines l ON l.barcode = w.barcode GROUP BY w.barcode""",
            ctes=_base("part", "store"),
        ),
        "anonymise_codes": """SELECT row_number() OVER (ORDER BY l_partkey) AS product_code, count(*) AS lines
FROM lineitem GROUP BY l_partkey""",
        "missing_predictions": _tidy(
            "SELECT DISTINCT barcode FROM all_products WHERE barcode NOT IN (SELECT barcode FROM predicted)", ctes=ARTIFACTS
        ),
        "month_coverage": _tidy("SELECT * FROM coverage", ctes=ARTIFACTS + "," + COVERAGE),
        "status_report": _tidy(
            """SELECT 1 - complete AS section, barcode,
  CASE WHEN complete = 1 THEN '- ' || barcode ELSE 'Product ' || barcode || ': ' || concat_ws(' | ',
    CASE WHEN missing_predictions <> '' THEN 'predictions missing for months: ' || missing_predictions END,
    CASE WHEN missing_charts <> '' THEN 'charts missing for months: ' || missing_charts END) END AS line FROM coverage""",
            ctes=ARTIFACTS + "," + COVERAGE,
        ),
        "inventory_status": _tidy(
            """SELECT barcode, 'can_move' AS status FROM done WHERE barcode IN (SELECT barcode FROM raw)
UNION ALL SELECT barcode, 'already_moved' FROM done WHERE barcode IN (SELECT barcode FROM moved)
UNION ALL SELECT barcode, 'only_processed' FROM (
  SELECT barcode FROM done EXCEPT SELECT barcode FROM raw EXCEPT SELECT barcode FROM moved) AS o""",
            ctes=f"{ARTIFACTS}, moved AS ({_market('BUILDING')}), {DONE}",
        ),
        "inventory_counts": _tidy(
            """SELECT (SELECT count(DISTINCT barcode) FROM raw) AS total_raw, (SELECT count(*) FROM moved) AS total_moved,
  (SELECT count(*) FROM done) AS total_processed,
  (SELECT count(*) FROM done WHERE barcode IN (SELECT barcode FROM raw)) AS can_move,
  (SELECT count(*) FROM done WHERE barcode IN (SELECT barcode FROM moved)) AS already_moved,
  (SELECT count(*) FROM done WHERE barcode NOT IN (SELECT barcode FROM raw) AND barcode NOT IN (SELECT barcode FROM moved)) AS only_processed,
  (SELECT count(DISTINCT barcode) FROM raw WHERE barcode NOT IN (SELECT barcode FROM done)) AS remaining""",
            ctes=f"{ARTIFACTS}, moved AS ({_market('BUILDING')}), {DONE}",
        ),
        "barcode_reconcile": _tidy(
            """SELECT barcode, 'listed_not_found' AS difference FROM (SELECT barcode FROM raw EXCEPT SELECT barcode FROM found) AS a
UNION ALL SELECT barcode, 'found_not_listed' FROM (SELECT barcode FROM found EXCEPT SELECT barcode FROM raw) AS b""",
            ctes=f"{ARTIFACTS}, found AS ({_market('BUILDING')} UNION {_market('MACHINERY')})",
        ),
        "series_folder": _tidy(
            f"SELECT {', '.join(EXPORT_COLUMNS)} FROM flagged", AMOUNTS, ["date"], ctes=_base(upto="flagged")
        ),
        "series_intake": _tidy(
            f"SELECT {', '.join(c for c in EXPORT_COLUMNS if c != 'total_value')} FROM flagged",
            [a for a in AMOUNTS if a != "total_value"],
            ["date"],
            ctes=_base(upto="flagged"),
        ),
        "rejected_rows": f"""WITH
read_rows AS (WITH {_base(upto='dense')}
  SELECT 'read' AS step, barcode, 'no column Quantity' AS reject_reason, count(*) AS rows FROM dense
  WHERE CAST(barcode AS BIGINT) % 3 = 0 GROUP BY barcode),
code_rows AS (WITH {_base('part', 'store')}
  SELECT 'anonymise' AS step, barcode, 'no code' AS reject_reason, count(*) AS rows FROM lines
  WHERE NOT (length(barcode) >= 7 AND barcode LIKE '7%') GROUP BY barcode),
scale_rows AS (WITH {_base('supplier')}
  SELECT 'scale' AS step, barcode, 'no train rows' AS reject_reason, count(*) AS rows FROM features
  WHERE (date < DATE '{EARLY}' OR year(date) = {EARLY[:4]})
    AND barcode NOT IN (SELECT barcode FROM features WHERE date < DATE '{EARLY}') GROUP BY barcode)
SELECT * FROM read_rows UNION ALL SELECT * FROM code_rows UNION ALL SELECT * FROM scale_rows""",
        "window_split": _tidy(
            """SELECT barcode, window_id, min(date) FILTER (WHERE place < 292) AS fit_start, max(date) FILTER (WHERE place < 292) AS fit_end,
  min(date) FILTER (WHERE place >= 292) AS validation_start, max(date) FILTER (WHERE place >= 292) AS validation_end,
  CAST(count(*) FILTER (WHERE place < 292) AS INTEGER) AS fit_rows, CAST(count(*) FILTER (WHERE place >= 292) AS INTEGER) AS validation_rows
FROM (SELECT *, position - window_id * 7 AS place FROM windows WHERE role = 'train') AS w GROUP BY barcode, window_id""",
            (),
            ["fit_start", "fit_end", "validation_start", "validation_end"],
            ctes=weekly,
        ),
        "window_validation_rows": _tidy(
            """SELECT barcode, date, quantity, CAST(position AS INTEGER) AS position, window_id FROM windows
WHERE role = 'train' AND position - window_id * 30 >= 292""",
            ["quantity"],
            ["date"],
            ctes=_base() + "," + _windows(365, 31, 30, "train"),
        ),
        "scaler_by_window": _tidy(
            f"""SELECT barcode, window_id, unnest([{', '.join(f"'{c}'" for c in FEATURES)}]) AS feature,
  unnest([{', '.join(f'{c}_mean' for c in FEATURES)}]) AS mean, unnest([{', '.join(f'{c}_std' for c in FEATURES)}]) AS std
FROM ({WINDOW_STATS}) AS g""",
            ["mean", "std"],
            ctes=weekly,
        ),
        "scaled_by_window": _tidy(
            f"""SELECT w.barcode, w.window_id, w.date, w.quantity, {', '.join(f'(CAST(w.{c} AS DOUBLE) - {c}_mean) / {c}_std AS {c}' for c in FEATURES)}
FROM windows w JOIN ({WINDOW_STATS}) AS g ON w.barcode = g.barcode AND w.window_id = g.window_id WHERE role = 'test'""",
            ["quantity", *FEATURES],
            ["date"],
            ctes=weekly,
        ),
        "comparison_version": _tidy(
            f"SELECT barcode, model, {_scores()} FROM predictions GROUP BY barcode, model", MEASURES, ctes=_base() + "," + PREDICTIONS
        ),
        "harmonised": _tidy("SELECT * FROM predictions", ["real", "forecast"], ["date"], ctes=_base() + "," + PREDICTIONS),
        "report_file": _tidy(
            """SELECT CASE WHEN complete = 1 THEN '- ' || barcode ELSE 'Product ' || barcode || ': ' || concat_ws(' | ',
    CASE WHEN missing_predictions <> '' THEN 'predictions missing for months: ' || missing_predictions END,
    CASE WHEN missing_charts <> '' THEN 'charts missing for months: ' || missing_charts END) END AS line FROM coverage""",
            ctes=ARTIFACTS + "," + COVERAGE,
        ),
        "difference_files": _tidy(
            """SELECT barcode, 'listed_not_found' AS difference FROM (SELECT barcode FROM raw EXCEPT SELECT barcode FROM found) AS a
UNION ALL SELECT barcode, 'found_not_listed' FROM (SELECT barcode FROM found EXCEPT SELECT barcode FROM raw) AS b""",
            ctes=f"{ARTIFACTS}, found AS ({_market('BUILDING')} UNION {_market('MACHINERY')})",
        ),
        "patched_version": _tidy(
            f"""SELECT barcode AS Barcode, date AS Date, quantity AS Quantity,
  CASE WHEN {_on('date', LOCAL_HOLIDAYS)} THEN 1 ELSE 0 END AS Holiday FROM dense""",
            ["Quantity"],
            ["Date"],
            ctes=_base(upto="dense"),
        ),
        "barcode_list": _tidy("SELECT DISTINCT barcode FROM lines", ctes=_base("part", "store")),
        "folder_barcodes": _tidy("SELECT DISTINCT barcode FROM products", ctes=_base(upto="store")),
        "numbered_codes": _tidy(
            "SELECT product_code, CAST(row_number() OVER (ORDER BY score DESC, product_code) AS INTEGER) AS sequence FROM top", ctes=top
        ),
        "extra_steps": _tidy(
            """SELECT barcode, date, quantity, lag_1 + lag_7 AS lag_sum, quantity / nullif(lag_7, 0) AS sold_share
FROM features WHERE lag_7 <> 0""",
            ["quantity", "lag_sum", "sold_share"],
            ["date"],
            ctes=_base(),
        ),
        "forecast_keys": _tidy(
            f"""SELECT model, barcode, date, quantity AS real, 1 AS fine FROM features, (VALUES ('boosted'), ('sequence')) AS m(model)
WHERE year(date) = {YEAR}""",
            ["real"],
            ["date"],
            ctes=_base(),
        ),
        "events_intake": _tidy(
            """SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS events,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS value FROM events GROUP BY 1, 2""",
            ["value"],
            ["date"],
        ),
    }
