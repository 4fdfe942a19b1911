"""SQL for DuckDB that states what each registered query must return.

The texts are written from the report's definitions, with literal dates, and share
nothing with the Spark code but names.
"""

from __future__ import annotations

from datetime import date, timedelta

# Report dates, period ends and window bounds.
AS_OF = "1998-11-18"
EXTRACT = ("1998-07-03", AS_OF)
LAST_30 = ("1998-10-20", AS_OF)
LAST_31 = ("1998-10-19", AS_OF)
L30 = ("1998-10-02", "1998-10-31")
ENDS = {"m2": "1998-09-30", "m1": "1998-10-31", "m0": AS_OF}
TRAILING = {
    "m2": ("1998-07-03", "1998-09-30"),
    "m1": ("1998-08-03", "1998-10-31"),
    "m0": ("1998-08-21", AS_OF),
    "m0_30d": LAST_30,
}
ROLLING = {
    "m2": ("1998-09-01", "1998-09-30"),
    "m1": ("1998-10-02", "1998-10-31"),
    "m0_30d": LAST_30,
}
MONTHS = {
    "m2": ("1998-09-01", "1998-09-30"),
    "m1": ("1998-10-01", "1998-10-31"),
    "m0": LAST_30,
}
MONTHS_EXTRACT = ("1998-09-01", AS_OF)

END_AS_OF = "1996-03-31"
END_EXTRACT = ("1995-11-03", END_AS_OF)
END_LAST_30 = ("1996-03-02", END_AS_OF)
END_LAST_31 = ("1996-03-01", END_AS_OF)
END_L30 = ("1996-01-31", "1996-02-29")
END_ENDS = {"m2": "1996-01-31", "m1": "1996-02-29", "m0": END_AS_OF}
END_MONTHS = {
    "m2": ("1996-01-01", "1996-01-31"),
    "m1": ("1996-02-01", "1996-02-29"),
    "m0": ("1996-03-01", END_AS_OF),
}
END_MONTHS_EXTRACT = ("1996-01-01", END_AS_OF)
END_CALENDAR = {**END_MONTHS, "m0_30d": END_MONTHS["m0"]}
del END_CALENDAR["m0"]

Window = tuple[str, str]

MART = """
mart AS (
  SELECT r_name AS grass_region, p_type AS category_cluster, s_name AS supplier_name,
         CAST(l_partkey AS VARCHAR) AS sku_id, CAST(o_orderdate AS DATE) AS cdate,
         CASE WHEN p_size <= 20 THEN 'Green' WHEN p_size > 40 THEN 'Black'
              ELSE 'Yellow' END AS color,
         CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS cogs_usd,
         CAST(l_quantity AS INTEGER) AS stock_on_hand,
         CAST(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0 END
              AS DECIMAL(18,4)) AS inbound_value_usd,
         CAST(CASE WHEN l_linestatus = 'O' THEN l_extendedprice * (1 + l_tax) ELSE 0 END
              AS DECIMAL(18,4)) AS acct_payables_usd,
         CAST(l_quantity * p_retailprice AS DECIMAL(18,4)) AS inventory_value_usd,
         o_orderpriority AS payment_terms, p_brand AS brand,
         CAST(l_shipdate AS DATE) AS grass_date,
         CASE WHEN l_returnflag = 'R' THEN 'Consignment' ELSE 'Outright' END
           AS purchase_type
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey
)"""

KEYS = "grass_region, supplier_name"
ROW_COLUMNS = """grass_region, category_cluster, supplier_name, sku_id, cdate, color,
  CAST(cogs_usd AS DOUBLE) AS cogs_usd, stock_on_hand,
  CAST(inbound_value_usd AS DOUBLE) AS inbound_value_usd,
  CAST(acct_payables_usd AS DOUBLE) AS acct_payables_usd,
  CAST(inventory_value_usd AS DOUBLE) AS inventory_value_usd,
  payment_terms, brand, grass_date"""


def within(window: Window) -> str:
    return f"grass_date BETWEEN DATE '{window[0]}' AND DATE '{window[1]}'"


def ctes(window: Window, *more: str) -> str:
    """The mart, the extract of a range of days, and further steps."""
    ex = f"""ex AS (
  SELECT * FROM mart WHERE supplier_name IS NOT NULL AND purchase_type = 'Outright'
    AND {within(window)}
)"""
    return "WITH " + ",\n".join([MART, ex, *more])


def sum_over(window: Window, value: str, name: str) -> str:
    value = f"COALESCE({value}, 0)"
    return f"CAST(SUM(CASE WHEN {within(window)} THEN {value} END) AS DOUBLE) AS {name}"


def mean_over(window: Window, value: str, name: str) -> str:
    hit = f"CASE WHEN {within(window)} THEN {value} END"
    return f"CAST(SUM({hit}) AS DOUBLE) / NULLIF(COUNT({hit}), 0) AS {name}"


def per_supplier(columns: list[str], source: str) -> str:
    return f"SELECT {KEYS}, {', '.join(columns)} FROM {source} GROUP BY {KEYS}"


DAILY = f"""daily AS (
  SELECT {KEYS}, grass_date, SUM(COALESCE(cogs_usd, 0)) AS cogs_usd,
         SUM(COALESCE(stock_on_hand, 0)) AS stock_on_hand,
         SUM(COALESCE(inbound_value_usd, 0)) AS inbound_value_usd,
         SUM(COALESCE(acct_payables_usd, 0)) AS acct_payables_usd,
         SUM(COALESCE(inventory_value_usd, 0)) AS inventory_value_usd
  FROM ex GROUP BY {KEYS}, grass_date
)"""

CATEGORY = f"""latest AS (
  SELECT {KEYS}, MAX(grass_date) AS grass_date FROM ex GROUP BY {KEYS}
),
category_values AS (
  SELECT {KEYS}, category_cluster, SUM(COALESCE(inventory_value_usd, 0)) AS total
  FROM ex JOIN latest USING (grass_region, supplier_name, grass_date)
  WHERE category_cluster IS NOT NULL
  GROUP BY {KEYS}, category_cluster
),
category AS (
  SELECT {KEYS}, category_cluster FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY {KEYS} ORDER BY total DESC, category_cluster) AS place
    FROM category_values
  ) WHERE place = 1
)"""


def brand_ctes(window: Window) -> str:
    return f"""counts AS (
  SELECT {KEYS}, brand, COUNT(*) AS n FROM (
    SELECT DISTINCT {KEYS}, category_cluster, sku_id, cdate, color, cogs_usd,
      stock_on_hand, inbound_value_usd, acct_payables_usd, inventory_value_usd,
      payment_terms, brand, grass_date
    FROM ex WHERE {within(window)}
  ) WHERE brand IS NOT NULL AND brand <> 'nan'
  GROUP BY {KEYS}, brand
),
top AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY {KEYS} ORDER BY n DESC, brand) AS rank
    FROM counts
  ) WHERE rank <= 3
),
top_wide AS (
  SELECT {KEYS},
         COALESCE(MAX(CASE WHEN rank = 1 THEN brand END), 'n.a.') AS brand_1,
         COALESCE(MAX(CASE WHEN rank = 2 THEN brand END), 'n.a.') AS brand_2,
         COALESCE(MAX(CASE WHEN rank = 3 THEN brand END), 'n.a.') AS brand_3
  FROM top GROUP BY {KEYS}
)"""


def tied_brand_ctes(window: Window) -> str:
    """All brands of rank three or better, of which the first three fill the places."""
    counts = brand_ctes(window).split("top AS (")[0]
    places = ", ".join(f"COALESCE(names[{k}], 'n.a.') AS brand_{k}" for k in (1, 2, 3))
    return f"""{counts}ranked AS (
  SELECT *, RANK() OVER (PARTITION BY {KEYS} ORDER BY n DESC) AS rank FROM counts
),
top AS (
  SELECT {KEYS}, LIST(brand ORDER BY rank, brand) AS names
  FROM ranked WHERE rank <= 3 GROUP BY {KEYS}
),
top_wide AS (SELECT {KEYS}, {places} FROM top)"""


def tracking_cte(as_of: str, sku_count: str = "COUNT(sku_id)") -> str:
    return f"""snap AS (
  SELECT {KEYS}, {sku_count} AS "no_skus_WH",
         CAST(SUM(COALESCE(stock_on_hand, 0)) AS BIGINT) AS inv_count,
         CAST(SUM(COALESCE(inventory_value_usd, 0)) AS DOUBLE) AS inventory_value_usd,
         MIN(payment_terms) AS payment_terms
  FROM ex WHERE grass_date = DATE '{as_of}' GROUP BY {KEYS}
),
tracking AS (
  SELECT snap.grass_region, category_cluster, snap.supplier_name, "no_skus_WH",
         inv_count, inventory_value_usd, COALESCE(brand_1, 'n.a.') AS brand_1,
         COALESCE(brand_2, 'n.a.') AS brand_2, COALESCE(brand_3, 'n.a.') AS brand_3,
         payment_terms
  FROM snap
  LEFT JOIN category USING (grass_region, supplier_name)
  LEFT JOIN top_wide USING (grass_region, supplier_name)
)"""


CLEANED = f"""spellings AS (
  SELECT replace(brand, ' ', '') AS compact,
         MAX(CASE WHEN brand LIKE '% %' THEN brand END) AS spaced
  FROM ex WHERE {within(LAST_30)} AND brand IS NOT NULL GROUP BY 1
  HAVING COUNT(DISTINCT brand) > 1
),
cleaned AS (
  SELECT ex.* REPLACE (COALESCE(spaced, brand) AS brand)
  FROM ex LEFT JOIN spellings ON brand = compact
)"""

TRACKING = ctes(EXTRACT, CATEGORY, brand_ctes(LAST_30), tracking_cte(AS_OF))

WATCHLIST = """watchlist AS (
  SELECT r_name AS grass_region, s_name AS supplier_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  WHERE s_acctbal >= 4000 AND r_name <> 'EUROPE'
)"""
WATCHED = f"""(({KEYS}) IN (SELECT ({KEYS}) FROM watchlist)
  OR grass_region NOT IN (SELECT grass_region FROM watchlist))"""


def inbound_parts(windows: dict[str, Window]) -> list[str]:
    """Inbound, replenishment and green replenishment sums."""
    inbound, repln, green = [], [], []
    for label, (start, _) in windows.items():
        span = windows[label]
        old = f"cdate < DATE '{start}'"
        masked = "CASE WHEN {} THEN inbound_value_usd ELSE 0 END"
        inbound.append(sum_over(span, "inbound_value_usd", f"inb_{label}"))
        repln.append(sum_over(span, masked.format(old), f"inb_repln_{label}"))
        green.append(
            sum_over(
                span, masked.format(f"{old} AND color = 'Green'"), f"green_repln_{label}"
            )
        )
    return inbound + repln + green


def end_parts(ends: dict[str, str]) -> list[str]:
    black = "CASE WHEN color = 'Black' THEN inventory_value_usd ELSE 0 END"
    return [
        sum_over((day, day), "inventory_value_usd", f"eop_inv_{label}")
        for label, day in ends.items()
    ] + [sum_over((day, day), black, f"black_inv_{label}") for label, day in ends.items()]


def l30_part(window: Window) -> str:
    inside = f"FILTER (WHERE {within(window)})"
    return f"""CAST(SUM(COALESCE(inventory_value_usd, 0)) {inside} AS DOUBLE)
      / NULLIF(CAST(SUM(COALESCE(cogs_usd, 0)) {inside} AS DOUBLE), 0) AS l30_inv_days"""


def on_ends(ends: dict[str, str]) -> str:
    return "grass_date IN (" + ", ".join(f"DATE '{d}'" for d in ends.values()) + ")"


SHARES = {
    **{f"inb_repln_{k}": f"inb_{k}" for k in ROLLING},
    **{f"green_repln_{k}": f"inb_repln_{k}" for k in ROLLING},
    **{f"black_inv_{k}": f"eop_inv_{k}" for k in ENDS},
}


def scorecard(
    extract: Window,
    as_of: str,
    brand_window: Window,
    windows: dict[str, Window],
    ends: dict[str, str],
    l30: Window,
) -> str:
    sums = [*inbound_parts(windows), *end_parts(ends), l30_part(l30)]
    shares = [f"{part} / NULLIF({whole}, 0) AS {part}_perc" for part, whole in SHARES.items()]
    black = [f"black_inv_{k}" for k in ends]
    return (
        ctes(
            extract,
            CATEGORY,
            brand_ctes(brand_window),
            tracking_cte(as_of),
            f"sums AS ({per_supplier(sums, 'ex')})",
        )
        + f"""
SELECT tracking.*, {', '.join(shares)}, {', '.join(black)}, l30_inv_days
FROM tracking LEFT JOIN sums USING (grass_region, supplier_name)"""
    )


SCORECARD = scorecard(EXTRACT, AS_OF, LAST_30, ROLLING, ENDS, L30)

DISPLAY_TEXT = (
    "grass_region",
    "category_cluster",
    "supplier_name",
    "no_skus_WH",
    "inv_count",
    "brand_1",
    "brand_2",
    "brand_3",
    "payment_terms",
)
DISPLAY_NUMBERS = (
    "inventory_value_usd",
    *[f"{part}_perc" for part in SHARES],
    *[f"black_inv_{k}" for k in ENDS],
    "l30_inv_days",
)
SCORECARD_DISPLAY = "SELECT {} FROM ({})".format(
    ", ".join(
        [f"COALESCE(CAST(\"{c}\" AS VARCHAR), 'N/A') AS \"{c}\"" for c in DISPLAY_TEXT]
        + [
            f"COALESCE(CAST(CAST({c} AS DECIMAL(28,4)) AS VARCHAR), 'N/A') AS {c}"
            for c in DISPLAY_NUMBERS
        ]
    ),
    SCORECARD,
)


def days(window: Window) -> list[str]:
    start, end = (date.fromisoformat(text) for text in window)
    return [(start + timedelta(days=n)).isoformat() for n in range((end - start).days + 1)]


def matrix_cte(measure: str, window: Window) -> str:
    cells = [
        f"CAST(MAX(CASE WHEN grass_date = DATE '{day}' THEN {measure} END) AS DOUBLE)"
        f' AS "{day}"'
        for day in days(window)
    ]
    return f"matrix AS ({per_supplier(cells, 'daily')})"


def matrix(measure: str) -> str:
    return ctes(EXTRACT, DAILY, matrix_cte(measure, EXTRACT)) + "\nSELECT * FROM matrix"


def sheet(metrics: list[str], measure: str, window: Window = EXTRACT) -> str:
    return (
        ctes(
            window,
            DAILY,
            CATEGORY,
            matrix_cte(measure, window),
            f"metrics AS ({per_supplier(metrics, 'daily')})",
        )
        + """
SELECT * FROM metrics JOIN matrix USING (grass_region, supplier_name)
LEFT JOIN category USING (grass_region, supplier_name)"""
    )


def sums_of(measure: str, prefix: str, windows: dict[str, Window]) -> list[str]:
    return [sum_over(w, measure, f"{prefix}_{k}") for k, w in windows.items()]


def means_of(measure: str, prefix: str, windows: dict[str, Window]) -> list[str]:
    return [mean_over(w, measure, f"{prefix}_{k}") for k, w in windows.items()]


def zero_sums_of(measure: str, prefix: str, windows: dict[str, Window]) -> list[str]:
    return [
        f"CAST(SUM(CASE WHEN {within(w)} THEN {measure} ELSE 0 END) AS DOUBLE)"
        f" AS {prefix}_{k}"
        for k, w in windows.items()
    ]


def from_daily(columns: list[str], extract: Window = EXTRACT) -> str:
    return ctes(extract, DAILY) + "\n" + per_supplier(columns, "daily")


def from_rows(columns: list[str], extract: Window = EXTRACT, where: str = "TRUE") -> str:
    return (
        ctes(extract)
        + f"\nSELECT {KEYS}, {', '.join(columns)} FROM ex WHERE {where} GROUP BY {KEYS}"
    )


def wc_days() -> str:
    parts = [
        *sums_of("cogs_usd", "cogs", TRAILING),
        *means_of("inventory_value_usd", "inv", TRAILING),
        *means_of("acct_payables_usd", "payable", TRAILING),
    ]
    n_days = {label: len(days(window)) for label, window in TRAILING.items()}
    ratios, differences = [], []
    for label, n in n_days.items():
        for stock in ("inv", "payable"):
            ratios.append(
                f"{stock}_{label} / NULLIF(cogs_{label}, 0) * {n} AS {stock}_days_{label}"
            )
        differences.append(
            f"inv_days_{label} - payable_days_{label} AS wc_days_{label}"
        )
    return (
        ctes(EXTRACT, DAILY, f"parts AS ({per_supplier(parts, 'daily')})")
        + f""",
stock_days AS (SELECT {KEYS}, {', '.join(ratios)} FROM parts)
SELECT *, {', '.join(differences)} FROM stock_days"""
    )


def row_flag_columns() -> list[str]:
    columns = ["CASE WHEN color = 'Black' THEN 1 ELSE 0 END AS is_black_inv"]
    for label, window in ROLLING.items():
        old = f"cdate < DATE '{window[0]}'"
        green = f"{old} AND color = 'Green'"
        for name, condition in (("is_replenishment", old), ("is_green_repln", green)):
            columns.append(
                f"CASE WHEN {within(window)} AND {condition} THEN 1 ELSE 0 END"
                f" AS {name}_{label}"
            )
        for name, condition in (("inb_repln", old), ("green_repln", green)):
            columns.append(
                f"CAST(CASE WHEN {condition} THEN COALESCE(inbound_value_usd, 0) ELSE 0 END"
                " AS DOUBLE)"
                f" AS {name}_{label}"
            )
    columns.append(
        "CAST(CASE WHEN color = 'Black' THEN COALESCE(inventory_value_usd, 0) ELSE 0 END"
        " AS DOUBLE)"
        " AS black_inv_usd"
    )
    return columns


MONTHLY = """moved AS (
  SELECT * REPLACE (last_day(grass_date) AS grass_date) FROM ex
)"""


def snapshot(column: str) -> str:
    """A column per supplier on the month end to which all rows of its month are moved."""
    return (
        ctes(END_EXTRACT, MONTHLY)
        + f"\nSELECT {KEYS}, {column} FROM moved"
        + f"\nWHERE grass_date = DATE '{END_AS_OF}' GROUP BY {KEYS}"
    )


EXTRACT_ROWS = ctes(EXTRACT) + f"\nSELECT {ROW_COLUMNS} FROM ex"

ORACLES: dict[str, str] = {
    "mart_extract": EXTRACT_ROWS,
    "extract_roundtrip": EXTRACT_ROWS,
    "extract_roundtrip_inferred": EXTRACT_ROWS,
    "mart_roundtrip": from_rows(sums_of("cogs_usd", "cogs", TRAILING)),
    "report_roundtrip": TRACKING + "\nSELECT * FROM tracking",
    "matrix_roundtrip": ctes(EXTRACT, DAILY)
    + f"""
SELECT {KEYS}, grass_date, CAST(cogs_usd AS DOUBLE) AS cogs_usd,
       CAST(inbound_value_usd AS DOUBLE) AS inbound_value_usd,
       CAST(acct_payables_usd AS DOUBLE) AS acct_payables_usd,
       CAST(inventory_value_usd AS DOUBLE) AS inventory_value_usd
FROM daily""",
    "snapshot_rows": EXTRACT_ROWS + f" WHERE grass_date = DATE '{AS_OF}'",
    "trailing_rows": ctes(EXTRACT)
    + f"\nSELECT {KEYS}, sku_id, brand, grass_date FROM ex WHERE {within(LAST_30)}",
    "dedup_rows": ctes(END_EXTRACT, MONTHLY)
    + f"\nSELECT DISTINCT {KEYS}, color, payment_terms, grass_date FROM moved",
    "supplier_spine": ctes(EXTRACT) + f"\nSELECT DISTINCT {KEYS} FROM ex",
    "row_flags": ctes(EXTRACT)
    + f"""
SELECT {KEYS}, sku_id, cdate, color,
       CAST(inbound_value_usd AS DOUBLE) AS inbound_value_usd,
       CAST(inventory_value_usd AS DOUBLE) AS inventory_value_usd, grass_date,
       {', '.join(row_flag_columns())}
FROM ex""",
    "period_calendar": """
WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem),
starts AS (
  SELECT d, CAST(date_trunc('month', d) AS DATE) AS m0,
         CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE) AS m1,
         CAST(date_trunc('month', d) - INTERVAL 2 MONTH AS DATE) AS m2,
         CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS next_m
  FROM days
)
SELECT d AS as_of, m1 - 1 AS m2_eop, m0 - 1 AS m1_eop, d AS m0_eop,
       m1 - 90 AS extract_start, m2 AS monthly_extract_start,
       CAST(m1 - m2 AS INTEGER) AS days_m2, CAST(m0 - m1 AS INTEGER) AS days_m1,
       CASE WHEN d = next_m - 1 THEN CAST(day(d) AS INTEGER) ELSE 30 END AS days_m0,
       m0 - 1 AS last_month_end, d - 29 AS rolling_start,
       CASE WHEN d = next_m - 1 THEN m0 ELSE d - 29 END AS calendar_start,
       strftime(d, '%Y-%m-%d') AS as_of_text
FROM starts""",
    "calendar_spine": ctes(EXTRACT)
    + f""",
spine AS (
  SELECT CAST(UNNEST(generate_series(DATE '{EXTRACT[0]}', DATE '{EXTRACT[1]}',
    INTERVAL 1 DAY)) AS DATE) AS grass_date
)
SELECT spine.grass_date,
       COUNT(DISTINCT (ex.grass_region, ex.supplier_name))
         FILTER (WHERE ex.supplier_name IS NOT NULL) AS n_suppliers
FROM spine LEFT JOIN ex USING (grass_date) GROUP BY spine.grass_date""",
    "period_coverage": ctes(EXTRACT)
    + """,
regions AS (SELECT DISTINCT grass_region FROM ex),
ends(period, period_end) AS (VALUES """
    + ", ".join(f"('{k}', DATE '{d}')" for k, d in ENDS.items())
    + """)
SELECT regions.grass_region, period, period_end, COUNT(ex.supplier_name) AS n_rows,
       COUNT(ex.supplier_name) > 0 AS has_data
FROM regions CROSS JOIN ends
LEFT JOIN ex ON ex.grass_region = regions.grass_region AND ex.grass_date = period_end
GROUP BY regions.grass_region, period, period_end""",
    "inv_count": snapshot("CAST(SUM(COALESCE(stock_on_hand, 0)) AS BIGINT) AS inv_count"),
    "inv_value": snapshot(
        "CAST(SUM(COALESCE(inventory_value_usd, 0)) AS DOUBLE) AS inventory_value_usd"
    ),
    "sku_count": snapshot('COUNT(sku_id) AS "no_skus_WH"'),
    "sku_count_distinct": snapshot('COUNT(DISTINCT sku_id) AS "no_skus_WH"'),
    "payment_terms": snapshot("MIN(payment_terms) AS payment_terms"),
    "latest_date": from_rows(["MAX(grass_date) AS grass_date"]),
    "main_category": ctes(EXTRACT, CATEGORY)
    + f"\nSELECT category_cluster, {KEYS} FROM category",
    "main_category_snapshot": ctes(
        END_EXTRACT,
        MONTHLY,
        CATEGORY.replace("FROM ex GROUP", f"FROM moved WHERE grass_date = DATE '{END_AS_OF}' GROUP")
        .replace("FROM ex JOIN", "FROM moved JOIN"),
    )
    + f"\nSELECT category_cluster, {KEYS} FROM category",
    "daily_totals": ctes(EXTRACT, DAILY)
    + f"""
SELECT {KEYS}, grass_date, CAST(cogs_usd AS DOUBLE) AS cogs_usd,
       CAST(stock_on_hand AS BIGINT) AS stock_on_hand,
       CAST(inbound_value_usd AS DOUBLE) AS inbound_value_usd,
       CAST(acct_payables_usd AS DOUBLE) AS acct_payables_usd,
       CAST(inventory_value_usd AS DOUBLE) AS inventory_value_usd
FROM daily""",
    "cogs_trailing": from_daily(sums_of("cogs_usd", "cogs", TRAILING)),
    "inventory_trailing": from_daily(means_of("inventory_value_usd", "inv", TRAILING)),
    "payables_trailing": from_daily(means_of("acct_payables_usd", "payable", TRAILING)),
    "inbound_trailing": from_daily(sums_of("inbound_value_usd", "inb", ROLLING)),
    "inbound_calendar": from_daily(
        sums_of("inbound_value_usd", "inb", END_CALENDAR), END_EXTRACT
    ),
    "replenishment": from_rows(inbound_parts(ROLLING)[3:6]),
    "replenishment_calendar": from_rows(inbound_parts(END_CALENDAR)[3:6], END_EXTRACT),
    "green_replenishment": from_rows(inbound_parts(ROLLING)[6:]),
    "eop_inventory": from_rows(end_parts(ENDS)[:3], where=on_ends(ENDS)),
    "black_stock": from_rows(end_parts(ENDS)[3:], where=on_ends(ENDS)),
    "l30_inventory_days": from_rows([l30_part(L30)], where=within(L30)),
    "monthly_flow_sums": from_daily(
        zero_sums_of("cogs_usd", "cogs", MONTHS)
        + zero_sums_of("inbound_value_usd", "inb", MONTHS),
        MONTHS_EXTRACT,
    ),
    "monthly_flow_sums_month_end": from_daily(
        zero_sums_of("cogs_usd", "cogs", END_MONTHS)
        + zero_sums_of("inbound_value_usd", "inb", END_MONTHS),
        END_MONTHS_EXTRACT,
    ),
    "monthly_stock_means": from_daily(
        means_of("inventory_value_usd", "inv", MONTHS)
        + means_of("acct_payables_usd", "payable", MONTHS),
        MONTHS_EXTRACT,
    ),
    "working_capital_days": wc_days(),
    "brand_counts": ctes(EXTRACT, brand_ctes(LAST_30)) + "\nSELECT * FROM counts",
    "top_brands": ctes(EXTRACT, brand_ctes(LAST_30))
    + f"\nSELECT {KEYS}, brand, n, CAST(rank AS INTEGER) AS rank FROM top",
    "top_brands_ranked": ctes(EXTRACT, brand_ctes(LAST_31))
    + f"""
SELECT * FROM (
  SELECT {KEYS}, brand, n,
         CAST(RANK() OVER (PARTITION BY {KEYS} ORDER BY n DESC) AS INTEGER) AS rank
  FROM counts
) WHERE rank <= 3""",
    "top_brands_wide": ctes(EXTRACT, brand_ctes(LAST_30)) + "\nSELECT * FROM top_wide",
    "brand_canonical": """
WITH source AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN p_size <= 20 THEN p_name ELSE replace(p_name, ' ', '') END AS brand
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
spellings AS (
  SELECT replace(brand, ' ', '') AS compact,
         MAX(CASE WHEN brand LIKE '% %' THEN brand END) AS spaced
  FROM source GROUP BY 1
  HAVING COUNT(DISTINCT brand) > 1
)
SELECT l_orderkey, l_linenumber, COALESCE(spaced, brand) AS brand
FROM source LEFT JOIN spellings ON brand = compact""",
    "watchlist": ctes(EXTRACT, WATCHLIST)
    + f"\nSELECT DISTINCT {KEYS} FROM ex WHERE {WATCHED}",
    "daily_cogs": matrix("cogs_usd"),
    "daily_payables": matrix("acct_payables_usd"),
    "daily_inventory": matrix("inventory_value_usd"),
    "daily_inbound": matrix("inbound_value_usd"),
    "matrix_with_category": ctes(
        EXTRACT, DAILY, CATEGORY, matrix_cte("cogs_usd", EXTRACT)
    )
    + """
SELECT * FROM matrix LEFT JOIN category USING (grass_region, supplier_name)""",
    "tracking": TRACKING + "\nSELECT * FROM tracking",
    "tracking_watchlist": TRACKING
    + f",\n{WATCHLIST}\nSELECT * FROM tracking WHERE {WATCHED}",
    "scorecard": SCORECARD,
    "scorecard_calendar": scorecard(
        END_EXTRACT, END_AS_OF, END_LAST_30, END_CALENDAR, END_ENDS, END_L30
    ),
    "scorecard_display": SCORECARD_DISPLAY,
    "sheet_payables": sheet(
        means_of("acct_payables_usd", "payable", TRAILING), "acct_payables_usd"
    ),
    "sheet_cogs": sheet(sums_of("cogs_usd", "cogs", TRAILING), "cogs_usd"),
    "sheet_inventory": sheet(
        means_of("inventory_value_usd", "inv", TRAILING), "inventory_value_usd"
    ),
    "sheet_inbound": sheet(
        sums_of("inbound_value_usd", "inb", ROLLING), "inbound_value_usd"
    ),
    "monthly_cogs_sheet": sheet(
        zero_sums_of("cogs_usd", "cogs", END_MONTHS), "cogs_usd", END_MONTHS_EXTRACT
    ),
    "regional_tracking": TRACKING
    + "\nSELECT * FROM tracking WHERE grass_region IN ('AFRICA', 'EUROPE', 'MIDDLE EAST')",
    "monthly_tracking": ctes(
        END_MONTHS_EXTRACT,
        CATEGORY,
        brand_ctes(END_LAST_31),
        tracking_cte(END_AS_OF, "COUNT(DISTINCT sku_id)"),
    )
    + "\nSELECT * FROM tracking",
}

ORACLES |= {
    "report_working_capital": ORACLES["working_capital_days"],
    "report_coverage": ORACLES["period_coverage"].replace(
        "SELECT DISTINCT grass_region FROM ex",
        "SELECT UNNEST(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST']) AS grass_region",
    ),
    "monthly_payables_sheet": sheet(
        means_of("acct_payables_usd", "payable", END_MONTHS),
        "acct_payables_usd",
        END_MONTHS_EXTRACT,
    ),
    "monthly_inventory_sheet": sheet(
        means_of("inventory_value_usd", "inv", END_MONTHS),
        "inventory_value_usd",
        END_MONTHS_EXTRACT,
    ),
    "monthly_inbound_sheet": sheet(
        zero_sums_of("inbound_value_usd", "inb", END_MONTHS),
        "inbound_value_usd",
        END_MONTHS_EXTRACT,
    ),
    "report_brand_ties": ctes(
        EXTRACT, CATEGORY, tied_brand_ctes(LAST_30), tracking_cte(AS_OF)
    )
    + "\nSELECT * FROM tracking",
    "top_brands_ranked_wide": ctes(EXTRACT, tied_brand_ctes(LAST_31))
    + "\nSELECT * FROM top_wide",
    "all_matrices": ORACLES["matrix_roundtrip"],
    "report_order": TRACKING
    + f"""
SELECT {KEYS}, CAST(ROW_NUMBER() OVER (
  PARTITION BY grass_region ORDER BY supplier_name) AS INTEGER) AS position FROM tracking""",
    "report_kept_days": SCORECARD,
    "sku_count_sketched": from_rows(['COUNT(DISTINCT sku_id) AS "no_skus_WH"']),
    "report_sku_sketches": ctes(
        EXTRACT, CATEGORY, brand_ctes(LAST_30), tracking_cte(AS_OF, "COUNT(DISTINCT sku_id)")
    )
    + "\nSELECT * FROM tracking",
    "report_clean_brands": ctes(
        EXTRACT,
        CATEGORY,
        CLEANED,
        brand_ctes(LAST_30).replace("FROM ex WHERE", "FROM cleaned WHERE"),
        tracking_cte(AS_OF),
    )
    + "\nSELECT * FROM tracking",
    "watchlist_file": ORACLES["watchlist"],
    "report_in_turns": TRACKING + "\nSELECT * FROM tracking",
    "report_date_category": ctes(
        EXTRACT,
        CATEGORY.replace(
            f"FROM ex GROUP BY {KEYS}\n),\ncategory_values",
            f"FROM ex WHERE grass_date = DATE '{AS_OF}' GROUP BY {KEYS}\n),\ncategory_values",
        ),
        brand_ctes(LAST_30),
        tracking_cte(AS_OF),
    )
    + "\nSELECT * FROM tracking",
}
