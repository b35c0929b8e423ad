"""Plain SQL for each registered query, written apart from the library, for DuckDB.

The heads below restate the adapters. Money is exact: DECIMAL sums, means from integer cents.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-02'"

# --- heads --------------------------------------------------------------------------------------

HEADER = """
header AS (
  SELECT o_orderkey AS oid, o_custkey AS cid, o_orderdate AS ordered_at, CAST(o_orderdate AS DATE) AS day,
         CAST(o_orderkey % 25 AS INTEGER) AS tid,
         CASE o_orderstatus WHEN 'F' THEN 5 ELSE 1 END AS status,
         o_orderpriority = '5-LOW' AS online
  FROM orders)"""

DETAIL = """
detail AS (
  SELECT l_orderkey AS oid, l_linenumber AS line, l_partkey AS pid, CAST(l_quantity AS INTEGER) AS qty,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS price,
         CASE WHEN l_linenumber <> 6 THEN CAST(l_discount AS DECIMAL(4,2)) END AS discount,
         CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_quantity AS INTEGER)
              * (1 - CAST(l_discount AS DECIMAL(4,2))) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(28,6)) AS total
  FROM lineitem)"""

TERRITORY = """
territory AS (
  SELECT n_nationkey AS tid, n_name AS tname, CAST(n_regionkey AS VARCHAR) AS country, r_name AS grp
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

PRODUCTS = """
catalog AS (
  SELECT p_partkey AS pid, p_name AS pname, p_brand AS pnumber,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.61 AS DECIMAL(19,4)) AS cost,
         CASE WHEN p_size % 7 = 0 OR p_size % 8 % 4 = 3 THEN 'N/A' ELSE 'Category ' || (p_size % 8 % 4) END AS cat,
         CASE WHEN p_size % 7 = 0 THEN 'N/A' ELSE 'Subcategory ' || (p_size % 8) END AS subcat
  FROM part WHERE p_size % 10 <> 0 AND p_retailprice > 0)"""

LINES = """
lines AS (
  SELECT h.oid, d.line, h.day, d.pid, d.qty, d.price, d.total, h.tid, t.tname, t.country, h.online
  FROM header h JOIN detail d USING (oid) JOIN territory t USING (tid) WHERE h.status = 5)"""

SALES = f"WITH {HEADER},{DETAIL},{TERRITORY},{PRODUCTS},{LINES}"


def _mean_cents(cents: str, count: str) -> str:
    """Half-up mean of integer cents, as currency."""
    return f"CAST((2 * ({cents}) + {count}) // (2 * {count}) AS DOUBLE) / 100"


def _summary(line_total: str, where: str = "true", cost: str = "cost", shown_cost: str = "cost") -> str:
    return f"""{SALES},
sold AS (
  SELECT pid, tid, tname, country, SUM({line_total}) AS revenue, SUM(qty) AS quantity,
         SUM(CAST(price * 100 AS BIGINT)) AS cents, COUNT(*) AS n
  FROM lines WHERE {where} GROUP BY ALL)
SELECT pid AS ProductID, pname AS ProductName, pnumber AS ProductNumber, cat AS Category, subcat AS Subcategory,
       tid AS TerritoryID, tname AS TerritoryName, country AS CountryRegionCode,
       CAST(ROUND(revenue, 2) AS DOUBLE) AS TotalRevenue, CAST(quantity AS BIGINT) AS TotalQty,
       {_mean_cents("cents", "n")} AS AvgUnitPrice,
       CAST(c.price AS DOUBLE) AS ListPrice, CAST({shown_cost} AS DOUBLE) AS StandardCost,
       CAST(ROUND(c.price - {cost}, 2) AS DOUBLE) AS Margin,
       {_mean_cents(f"CAST((c.price - {cost}) * 1000000 AS BIGINT)", "CAST(c.price * 100 AS BIGINT)")} AS MarginPct"""


_FROM_SOLD = " FROM sold JOIN catalog c USING (pid)"

CATEGORY = """
SELECT o_orderpriority AS category, COUNT(*) AS total_transaksi,
       CAST(SUM(CAST(FLOOR(o_totalprice) AS BIGINT)) AS BIGINT) AS total_omzet{mean}
FROM orders GROUP BY o_orderpriority"""

# --- customer segments --------------------------------------------------------------------------

# Lines 3 and 6 have no stored total; line 6 has no discount either.
ORDERS = f"""WITH {HEADER},{DETAIL},{TERRITORY},
amounts AS (
  SELECT oid, COUNT(*) AS n,
         SUM(CASE WHEN line % 3 <> 0 THEN total
                  ELSE CAST(qty * price * (1 - COALESCE(discount, 0)) AS DECIMAL(28,6)) END) AS amount
  FROM detail GROUP BY oid),
corders AS (
  SELECT oid, cid, day, tid, tname, country, amount, n
  FROM header JOIN amounts USING (oid) JOIN territory USING (tid) WHERE status = 5),
people AS (
  SELECT c_custkey AS cid,
         CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS person,
         CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 11 <> 0
              THEN REPLACE(c_name, '#', ' ') ELSE 'Store Customer #' || c_custkey END AS cname,
         c_custkey % 3 <> 0 AS individual
  FROM customer),
last_order AS (
  SELECT cid, tid FROM (
    SELECT cid, tid, ROW_NUMBER() OVER (PARTITION BY cid ORDER BY day DESC, oid DESC) AS rn FROM corders)
  WHERE rn = 1),
measured AS (
  SELECT cid, MIN(day) AS first_day, MAX(day) AS last_day, COUNT(*) AS frequency, SUM(amount) AS monetary
  FROM corders GROUP BY cid),
raw AS (
  SELECT cid AS CustomerID, cname AS CustomerName, individual AS IsIndividual,
         last_order.tid AS TerritoryID, tname AS TerritoryName,
         strftime(first_day, '%Y-%m-%d') AS FirstPurchaseDate, strftime(last_day, '%Y-%m-%d') AS LastPurchaseDate,
         {AS_OF} - last_day AS Recency, frequency AS Frequency, ROUND(monetary, 2) AS cash,
         CAST((2 * CAST(monetary * 1000000 AS HUGEINT) + frequency * 10000) // (frequency * 20000) AS DOUBLE) / 100
           AS AvgOrderValue,
         last_day - first_day AS TenureDays
  FROM measured JOIN last_order USING (cid) LEFT JOIN people USING (cid) LEFT JOIN territory USING (tid))"""

RAW = "SELECT * EXCLUDE (cash), CAST(cash AS DOUBLE) AS Monetary FROM raw"

FACT = f"""{ORDERS},
tiles AS (
  SELECT *, NTILE(4) OVER (ORDER BY Recency DESC, CustomerID) AS R_Score,
         NTILE(4) OVER (ORDER BY Frequency, CustomerID) AS F_Score,
         NTILE(4) OVER (ORDER BY cash, CustomerID) AS M_Score
  FROM raw),
fact AS (
  SELECT * EXCLUDE (cash), CAST(cash AS DOUBLE) AS Monetary, R_Score + F_Score + M_Score AS RFM_Score,
         concat(R_Score, '-', F_Score, '-', M_Score) AS RFM_Cell,
         CASE WHEN R_Score + F_Score + M_Score < 4 THEN 'Lost' WHEN R_Score + F_Score + M_Score < 7 THEN 'At Risk'
              WHEN R_Score + F_Score + M_Score < 10 THEN 'Loyal' ELSE 'Champions' END AS Segment,
         '2001-08-02' AS BatchDate, cash
  FROM tiles)"""

SEGMENTS = """
SELECT Segment, COUNT(*) AS customers, CAST(SUM(cash) AS DOUBLE) AS total_monetary FROM fact GROUP BY Segment"""

V1 = f"""WITH {HEADER},{DETAIL},{TERRITORY},
sums AS (SELECT oid, SUM(CASE WHEN line % 3 <> 0 THEN total END) AS amount FROM detail GROUP BY oid),
staging AS (
  SELECT oid, cid, ordered_at, day, tid, tname, CAST(ROUND(amount, 2) AS DECIMAL(15,2)) AS amount,
         CASE WHEN cid % 3 <> 0 AND cid % 11 <> 0 THEN REPLACE(c_name, '#', ' ') END AS cname
  FROM header JOIN sums USING (oid) JOIN territory USING (tid) JOIN customer ON c_custkey = cid
  WHERE tname IN ('NATION_0', 'NATION_1')),
grouped AS (
  SELECT cid, tname, amount, cname, {AS_OF} - MAX(day) AS recency, COUNT(*) AS frequency, SUM(amount) AS monetary
  FROM staging GROUP BY cid, tname, amount, cname),
tiles AS (
  SELECT *,
         NTILE(4) OVER (ORDER BY recency NULLS LAST, cid, tname, amount NULLS LAST, cname NULLS LAST) AS r,
         NTILE(4) OVER (ORDER BY frequency DESC, cid, tname, amount NULLS LAST, cname NULLS LAST) AS f,
         NTILE(4) OVER (ORDER BY monetary DESC NULLS FIRST, cid, tname, amount NULLS LAST, cname NULLS LAST) AS m
  FROM grouped)"""

V1_SCORED = """
SELECT cid AS CustomerID, tname AS TerritoryName, cname AS CustomerName, recency AS Recency, frequency AS Frequency,
       CAST(monetary AS DOUBLE) AS Monetary, r AS R_Score, f AS F_Score, m AS M_Score, r + f + m AS RFM_Score,
       CASE WHEN r + f + m >= 9 THEN 'Champions' WHEN r + f + m >= 6 THEN 'Loyal' ELSE 'At Risk' END AS Segment
FROM tiles"""

# --- weather ------------------------------------------------------------------------------------

SUPPLIER_PLACES = """
places AS (
  SELECT s_suppkey AS place, s_name AS location, n_name AS province, r_name AS island,
         (s_suppkey % 180) * 0.5::DOUBLE - 45 AS latitude, (s_suppkey % 360) * 0.5::DOUBLE AS longitude,
         s_suppkey % 5 = 0 AS peatland_flag
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

FIXED_PLACES = """
places AS (
  SELECT place, location, province, island, lat::DOUBLE AS latitude, lon::DOUBLE AS longitude,
         peatland_flag
  -- Fixed values: the library's locations.
  FROM (VALUES
    (0, 'jakarta', 'DKI Jakarta', 'Java', -6.2088, 106.8456, false),
    (1, 'surabaya', 'Jawa Timur', 'Java', -7.2575, 112.7521, false),
    (2, 'bandung', 'Jawa Barat', 'Java', -6.9175, 107.6191, false),
    (3, 'semarang', 'Jawa Tengah', 'Java', -6.9667, 110.4167, false),
    (4, 'yogyakarta', 'DI Yogyakarta', 'Java', -7.7956, 110.3695, false),
    (5, 'medan', 'Sumatra Utara', 'Sumatra', 3.5952, 98.6722, false),
    (6, 'palembang', 'Sumatra Selatan', 'Sumatra', -2.9909, 104.7560, false),
    (7, 'pekanbaru', 'Riau', 'Sumatra', 0.5071, 101.4478, true),
    (8, 'palangkaraya', 'Kalimantan Tengah', 'Kalimantan', -2.2096, 113.9200, true),
    (9, 'samarinda', 'Kalimantan Timur', 'Kalimantan', -0.5022, 117.1536, true),
    (10, 'makassar', 'Sulawesi Selatan', 'Sulawesi', -5.1477, 119.4327, false),
    (11, 'manado', 'Sulawesi Utara', 'Sulawesi', 1.4748, 124.8421, false),
    (12, 'jayapura', 'Papua', 'Papua', -2.5912, 140.6631, false),
    (13, 'kupang', 'Nusa Tenggara Timur', 'Nusa Tenggara', -10.1772, 123.6070, false),
    (14, 'mataram', 'Nusa Tenggara Barat', 'Nusa Tenggara', -8.5833, 116.1167, false)
  ) AS v(place, location, province, island, lat, lon, peatland_flag))"""


def _records(places: str, place: str) -> str:
    return f"""{places},
daily AS (
  SELECT CASE l_linestatus WHEN 'O' THEN 'forecast' ELSE 'archive' END AS dataset, {place} AS place,
         CAST(l_shipdate AS DATE) AS day, MAX(l_quantity) AS most, MIN(l_quantity) AS least,
         SUM(CAST(round(l_tax * 100) AS INTEGER)) AS tax, MAX(CAST(round(l_tax * 100) AS INTEGER)) AS top_tax,
         MAX(CAST(round(l_discount * 100) AS INTEGER)) AS top_discount
  FROM lineitem GROUP BY ALL),
records AS (
  SELECT dataset, location, province, island, latitude, longitude, peatland_flag, day,
         28 + most * 0.25::DOUBLE AS tmax, 18 + least * 0.125::DOUBLE AS tmin,
         tax * CASE WHEN month(day) BETWEEN 6 AND 9 THEN 0.2578125::DOUBLE WHEN month(day) IN (12, 1, 2, 3) THEN 1.0::DOUBLE
                    ELSE 0.5::DOUBLE END AS rain,
         72 - most AS humidity, CAST(5 + 3 * top_discount AS DOUBLE) AS wind,
         1 + 1.25::DOUBLE * top_tax AS evapo, (5 + 3 * top_discount) / 100.0::DOUBLE AS soil
  FROM daily JOIN places USING (place)),
bronze AS (
  SELECT *, round_even((tmax + tmin) / 2, 3) AS tmean
  FROM records
  QUALIFY ROW_NUMBER() OVER (PARTITION BY day, location ORDER BY dataset) = 1)"""


RECORD_COLUMNS = """dataset, location, province, island, latitude, longitude, peatland_flag,
       strftime(day, '%Y-%m-%d') AS date, tmax AS temperature_2m_max_c, tmin AS temperature_2m_min_c,
       rain AS precipitation_sum_mm, {humidity} AS relative_humidity_min_pct, wind AS wind_speed_10m_max_kmh,
       evapo AS evapotranspiration_mm, soil AS soil_moisture_avg, {mean} AS temperature_2m_mean_c"""


def _record_columns(humidity: str = "humidity", mean: str = "tmean") -> str:
    return RECORD_COLUMNS.format(humidity=humidity, mean=mean)


def _step(column: str, comparison: str, *rules: tuple) -> str:
    whens = " ".join(f"WHEN {column} {comparison} {cut} THEN {points}" for cut, points in rules)
    return f"CASE {whens} ELSE 0 END"


CROP = " + ".join(
    [
        _step("tmax", ">=", (38, 40), (35, 30), (33, 20), (31, 10)),
        _step("soil", "<=", (0.1, 35), (0.15, 25), (0.2, 15), (0.25, 8)),
        _step("evapo", ">=", (8, 25), (6, 18), (4, 10), (2, 5)),
    ]
)
DROUGHT = " + ".join(
    [
        _step("rain30", "<", (30, 25), (60, 18), (100, 10), (150, 5)),
        _step("tmax", ">=", (38, 25), (35, 18), (33, 10), (31, 5)),
        _step("soil", "<=", (0.1, 25), (0.15, 18), (0.2, 10), (0.25, 5)),
        _step("evapo30", ">=", (200, 25), (150, 18), (100, 10), (60, 5)),
    ]
)
# In tenths of a point, to stay with integers.
FIRE_TENTHS = "drought * 4 + 10 * (" + " + ".join(
    [
        _step("tmax", ">=", (38, 20), (35, 15), (33, 10), (31, 5)),
        _step("humidity", "<=", (30, 20), (40, 15), (50, 10), (60, 5)),
        _step("wind", ">=", (30, 15), (25, 11), (20, 7), (15, 3)),
        "CASE WHEN peatland_flag THEN 5 ELSE 0 END",
    ]
) + ")"


def _level(score: str) -> str:
    return f"CASE WHEN {score} < 25 THEN 'low' WHEN {score} < 50 THEN 'medium' WHEN {score} < 75 THEN 'high' ELSE 'extreme' END"


def _risk(places: str, place: str) -> str:
    return f"""WITH {_records(places, place)},
numbered AS (
  SELECT location, CAST(DENSE_RANK() OVER (ORDER BY location) AS BIGINT) AS lkey FROM bronze GROUP BY location),
weather AS (
  SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS dkey, lkey, b.*, {CROP} AS crop
  FROM bronze b JOIN numbered USING (location)),
rolled AS (
  SELECT *, SUM(rain) OVER (w ROWS 6 PRECEDING) AS rain7, SUM(rain) OVER (w ROWS 29 PRECEDING) AS rain30,
         SUM(evapo) OVER (w ROWS 29 PRECEDING) AS evapo30
  FROM weather WINDOW w AS (PARTITION BY location ORDER BY day)),
dry AS (SELECT *, {DROUGHT} AS drought FROM rolled),
risk AS (
  SELECT *, tenths / 10 AS fire, GREATEST(drought, tenths / 10) AS urgency
  FROM (SELECT *, {FIRE_TENTHS} AS tenths FROM dry)),
shown AS (
  SELECT *, strftime(day, '%Y-%m-%d') AS full_date, location AS location_name,
         CASE WHEN urgency >= 75 THEN 'Evacuation prep & fire patrol'
              WHEN urgency >= 50 THEN 'Water allocation & public warning'
              WHEN urgency >= 25 THEN 'Monitor & early warning' ELSE 'Routine monitoring' END AS recommended_action
  FROM risk)
"""


RISK = _risk(SUPPLIER_PLACES, "l_suppkey")
FIXED_RISK = _risk(FIXED_PLACES, "l_suppkey % 15")

FIRE_SELECT = f"""
SELECT dkey AS date_key, lkey AS location_key, drought AS drought_risk_score, tmax AS temperature_2m_max_c,
       humidity AS relative_humidity_min_pct, wind AS wind_speed_10m_max_kmh, rain7 AS precipitation_7d_mm,
       peatland_flag, CAST(fire AS DOUBLE) AS fire_risk_score, {_level("fire")} AS fire_risk_level
FROM shown"""

TREND = """
SELECT full_date, province, SUM(rain) / COUNT(*) AS avg_rainfall_mm,
       CAST(SUM(CAST(tmean AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*) AS avg_temperature_c
FROM shown GROUP BY full_date, province"""

def _placed(select: str, order: str) -> str:
    """A report with the place of each row in its order."""
    return f"SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS position FROM ({select})"


MITIGATION_SELECT = """
SELECT full_date, province, location_name, CAST(urgency AS DOUBLE) AS mitigation_priority_score, recommended_action
FROM shown"""


def _top5(score: str, kind: str) -> str:
    return f"""{RISK}
SELECT province, location_name, CAST(MAX({score}) AS {kind}) AS peak FROM shown
GROUP BY province, location_name ORDER BY peak DESC, province, location_name LIMIT 5"""


# --- landed tables ------------------------------------------------------------------------------

LANDED = """landed(tbl, path, n, ncols) AS (
  SELECT 'SalesOrderHeader', 'sales_order_header', (SELECT COUNT(*) FROM orders), 6
  UNION ALL SELECT 'SalesOrderDetail', 'sales_order_detail', (SELECT COUNT(*) FROM lineitem), 7
  UNION ALL SELECT 'SalesTerritory', 'sales_territory', (SELECT COUNT(*) FROM nation), 4
  UNION ALL SELECT 'Product', 'product', (SELECT COUNT(*) FROM part), 6
  UNION ALL SELECT 'ProductSubcategory', 'product_subcategory', 8, 3
  UNION ALL SELECT 'ProductCategory', 'product_category', 3, 2
  UNION ALL SELECT 'Customer', 'customer', (SELECT COUNT(*) FROM customer), 2
  UNION ALL SELECT 'Person', 'person', (SELECT COUNT(*) FROM customer), 3)"""

REGIONAL = """
SELECT r_name AS region, o_orderkey AS order_id, o_custkey AS CustomerID
FROM orders JOIN nation ON n_nationkey = o_orderkey % 25 JOIN region ON r_regionkey = n_regionkey"""

PRODUCTS_SELECT = f"""WITH {PRODUCTS}
SELECT pid AS ProductID, pname AS ProductName, pnumber AS ProductNumber, CAST(price AS DOUBLE) AS ListPrice,
       CAST(cost AS DOUBLE) AS StandardCost, cat AS Category, subcat AS Subcategory
FROM catalog"""


def _as_integers(sql: str, *columns: str) -> str:
    casts = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({sql})"


#: The declared catalog rounds the cost before the margin is taken from it.
_CENTS = "CAST(cost AS DECIMAL(10,2))"


def _typed_summary(line_total: str, cost: str = _CENTS) -> str:
    return _as_integers(_summary(line_total, "NOT online", cost, _CENTS) + _FROM_SOLD, "TotalQty", "ProductID")


ORACLES: dict[str, str] = {
    "sales_order_lines": f"""{SALES}
SELECT oid AS SalesOrderID, line AS SalesOrderDetailID, strftime(day, '%Y-%m-%d') AS OrderDate, pid AS ProductID,
       qty AS OrderQty, CAST(price AS DOUBLE) AS UnitPrice, CAST(total AS DOUBLE) AS LineTotal, tid AS TerritoryID,
       tname AS TerritoryName, country AS CountryRegionCode
FROM lines""",
    "products_staged": PRODUCTS_SELECT,
    "sales_summary": _summary("total") + _FROM_SOLD,
    "sales_performance_fact": _summary("total") + ", '2001-08-02' AS BatchDate" + _FROM_SOLD,
    "sales_summary_offline_orders": _typed_summary("CAST(total AS DECIMAL(12,2))"),
    "category_summary": CATEGORY.format(
        mean=""", CAST((2 * SUM(CAST(FLOOR(o_totalprice) AS BIGINT)) + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE)
       AS avg_harga"""
    ),
    "category_totals": CATEGORY.format(mean=""),
    "customer_orders": f"""{ORDERS}
SELECT oid AS SalesOrderID, cid AS CustomerID, strftime(day, '%Y-%m-%d') AS OrderDate, tid AS TerritoryID,
       tname AS TerritoryName, country AS CountryRegionCode, CAST(amount AS DOUBLE) AS OrderAmount, n AS LineCount
FROM corders""",
    "customers_staged": f"""{ORDERS}
SELECT cid AS CustomerID, person AS PersonID, cname AS CustomerName, individual AS IsIndividual FROM people""",
    "territories_staged": f"""WITH {TERRITORY}
SELECT tid AS TerritoryID, tname AS TerritoryName, country AS CountryRegionCode, grp AS RegionGroup FROM territory""",
    "customer_rfm_raw": f"{ORDERS} {RAW}",
    "customer_rfm_fact": f"{FACT} SELECT * EXCLUDE (cash) FROM fact",
    "rfm_segment_distribution": f"{FACT} " + _placed(SEGMENTS, "total_monetary DESC NULLS LAST, Segment"),
    "rfm_v1_staging": f"""{V1}
SELECT oid AS SalesOrderID, cid AS CustomerID, strftime(ordered_at, '%Y-%m-%d %H:%M:%S') AS OrderDate,
       tid AS TerritoryID, tname AS TerritoryName, CAST(amount AS DOUBLE) AS OrderAmount, cname AS CustomerName
FROM staging""",
    "rfm_v1_scored": f"{V1} {V1_SCORED}",
    "rfm_v1_fact": f"{V1} {V1_SCORED}",
    "weather_bronze_dedup": f"WITH {_records(SUPPLIER_PLACES, 'l_suppkey')} SELECT {_record_columns()} FROM bronze",
    "dim_date": f"""WITH {_records(SUPPLIER_PLACES, 'l_suppkey')}
SELECT DISTINCT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, strftime(day, '%Y-%m-%d') AS full_date,
       CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, monthname(day) AS month_name,
       CASE WHEN month(day) BETWEEN 6 AND 9 THEN 'dry' WHEN month(day) IN (12, 1, 2, 3) THEN 'wet'
            ELSE 'transition' END AS season_indonesia,
       'El Nino' AS climate_event
FROM bronze""",
    "dim_location": f"""WITH {_records(SUPPLIER_PLACES, 'l_suppkey')}
SELECT ROW_NUMBER() OVER (ORDER BY location) AS location_key, location AS location_name, province, island, latitude,
       longitude, peatland_flag
FROM (SELECT DISTINCT location, province, island, latitude, longitude, peatland_flag FROM bronze)""",
    "weather_fact": f"""{RISK}
SELECT dkey AS date_key, lkey AS location_key, tmean AS temperature_2m_mean_c, tmax AS temperature_2m_max_c,
       rain AS precipitation_sum_mm, humidity AS relative_humidity_min_pct, wind AS wind_speed_10m_max_kmh,
       soil AS soil_moisture_avg, evapo AS evapotranspiration_mm, crop AS crop_stress_score
FROM shown""",
    "drought_risk": f"""{RISK}
SELECT dkey AS date_key, lkey AS location_key, rain7 AS precipitation_7d_mm, rain30 AS precipitation_30d_mm,
       soil AS soil_moisture_avg, evapo30 AS evapotranspiration_30d_mm, drought AS drought_risk_score,
       {_level("drought")} AS drought_risk_level
FROM shown""",
    "fire_risk": RISK + FIRE_SELECT,
    "fire_risk_from_facts": RISK + FIRE_SELECT,
    "mitigation": f"""{RISK}
SELECT dkey AS date_key, lkey AS location_key, drought AS drought_risk_score, CAST(fire AS DOUBLE) AS fire_risk_score,
       CAST(urgency AS DOUBLE) AS mitigation_priority_score, recommended_action
FROM shown""",
    "gold_drought_by_region": f"""{RISK}
SELECT full_date, province, location_name, AVG(drought) AS avg_drought_risk, MAX(drought) AS peak_drought_risk
FROM shown GROUP BY ALL""",
    "gold_weather_trend": RISK + TREND,
    "gold_fire_by_region": f"""{RISK}
SELECT full_date, province, location_name, peatland_flag, CAST(SUM(tenths) AS DOUBLE) / 10 / COUNT(*) AS avg_fire_risk,
       CAST(MAX(fire) AS DOUBLE) AS peak_fire_risk
FROM shown GROUP BY full_date, province, location_name, peatland_flag""",
    "gold_mitigation": RISK + MITIGATION_SELECT,
    "insight_drought_rank": RISK + _placed("""
SELECT province, location_name, CAST(SUM(drought) AS DOUBLE) / COUNT(*) AS avg_drought_risk,
       MAX(drought) AS peak_drought_risk
FROM shown WHERE day BETWEEN DATE '1998-06-01' AND DATE '1998-09-30' GROUP BY province, location_name""",
        "peak_drought_risk DESC NULLS LAST, province, location_name"),
    "insight_climate_trend": RISK + _placed(TREND, "full_date, province"),
    "insight_fire_rank": RISK + _placed("""
SELECT province, location_name, CAST(MAX(fire) AS DOUBLE) AS peak_fire_risk
FROM shown WHERE day BETWEEN DATE '1998-06-01' AND DATE '1998-10-31' GROUP BY province, location_name""",
        "peak_fire_risk DESC NULLS LAST, province, location_name"),
    "insight_mitigation_periods": RISK + _placed(
        MITIGATION_SELECT + " WHERE urgency >= 75",
        "full_date, mitigation_priority_score DESC NULLS LAST, province, location_name"),
    # The second event begins on 20 May 1998, before the first has ended.
    "dim_date_events": f"""WITH {_records(SUPPLIER_PLACES, 'l_suppkey')}
SELECT DISTINCT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, strftime(day, '%Y-%m-%d') AS full_date,
       CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, monthname(day) AS month_name,
       CASE WHEN month(day) BETWEEN 6 AND 9 THEN 'dry' WHEN month(day) IN (12, 1, 2, 3) THEN 'wet'
            ELSE 'transition' END AS season_indonesia,
       CASE WHEN day BETWEEN DATE '1998-05-20' AND DATE '2001-03-31' THEN 'La Nina'
            WHEN day BETWEEN DATE '1997-05-01' AND DATE '1998-05-31' THEN 'El Nino' END AS climate_event
FROM bronze""",
    "event_trend": RISK + _placed(
        TREND.replace("FROM shown", "FROM shown WHERE day BETWEEN DATE '1997-05-01' AND DATE '1998-05-19'"),
        "full_date, province"),
    "top5_drought": _top5("drought", "INTEGER"),
    "top5_fire": _top5("fire", "DOUBLE"),
    "payload_flatten": f"""WITH {_records(SUPPLIER_PLACES, 'l_suppkey')}
SELECT {_record_columns("CASE dataset WHEN 'archive' THEN humidity END", "round_even((tmax + tmin) / 2, 3)")}
FROM records""",
    "ingest_requests": f"""WITH {SUPPLIER_PLACES}
SELECT 'archive' AS dataset, location AS location_key, latitude, longitude, '2000-08-03' AS start_date,
       '2001-08-02' AS end_date, CAST(NULL AS INTEGER) AS forecast_days
FROM places
UNION ALL SELECT 'forecast', location, latitude, longitude, NULL, NULL, 14 FROM places""",
    "regional_sample_orders": """
SELECT s_name AS region, order_id, amount
FROM supplier, (VALUES (1, 100), (2, 250), (3, 75), (4, 300), (5, 150)) AS v(order_id, amount)""",
    "landing_json_roundtrip": f"WITH {_records(FIXED_PLACES, 'l_suppkey % 15')} SELECT {_record_columns()} FROM bronze",
    "landing_parquet_roundtrip": f"""WITH {HEADER}
SELECT oid AS SalesOrderID, cid AS CustomerID, strftime(ordered_at, '%Y-%m-%d %H:%M:%S') AS OrderDate,
       tid AS TerritoryID, status AS Status, online AS OnlineOrderFlag, '2001-08-02' AS dt
FROM header""",
    "folder_scan": """SELECT (SELECT COUNT(*) FROM orders) + (SELECT COUNT(*) FROM lineitem) AS total_rows,
       (SELECT COUNT(*) FROM orders) AS customers, (SELECT COUNT(*) FROM lineitem) AS products,
       'CustomerID,ProductID,SalesOrderID' AS column_names""",
    "payload_profile": f"""WITH {_records(SUPPLIER_PLACES, 'l_suppkey')}
SELECT dataset, location AS location_key, CAST(COUNT(*) AS INTEGER) AS days,
       CAST(CASE dataset WHEN 'forecast' THEN 1 ELSE 0 END AS INTEGER) AS absent, CAST(0 AS INTEGER) AS uneven,
       CAST(0 AS INTEGER) AS corrupt
FROM records GROUP BY dataset, location""",
    "declared_types": """
SELECT * FROM (VALUES ('stg_sales_orders', 'LineTotal', 'decimal(12,2)'), ('stg_sales_orders', 'UnitPrice', 'decimal(10,2)'),
  ('stg_sales_orders', 'OrderQty', 'smallint'), ('stg_sales_orders', 'OrderDate', 'date'),
  ('stg_products', 'ListPrice', 'decimal(10,2)'), ('stg_products', 'StandardCost', 'decimal(10,2)'),
  ('trf_sales_summary', 'TotalRevenue', 'decimal(15,2)'), ('trf_sales_summary', 'MarginPct', 'decimal(6,2)'),
  ('fact_sales_performance', 'AvgUnitPrice', 'decimal(10,2)'), ('fact_sales_performance', 'LoadTimestamp', 'timestamp'),
  ('stg_sales_orders', 'TerritoryName', 'varchar(100)'), ('stg_sales_orders', 'CountryRegionCode', 'varchar(10)'),
  ('stg_products', 'ProductName', 'varchar(255)'), ('stg_products', 'ProductNumber', 'varchar(50)'),
  ('stg_products', 'Category', 'varchar(100)'), ('stg_products', 'Subcategory', 'varchar(100)'))
  AS v(table_name, column_name, declared)
UNION ALL
SELECT table_name, column_name, declared
FROM (VALUES ('trf_sales_summary'), ('fact_sales_performance')) AS t(table_name),
     (VALUES ('ProductName', 'varchar(255)'), ('ProductNumber', 'varchar(50)'), ('Category', 'varchar(100)'),
             ('Subcategory', 'varchar(100)'), ('TerritoryName', 'varchar(100)'), ('CountryRegionCode', 'varchar(10)'))
     AS c(column_name, declared)""",
    "load_stamps": "SELECT '2001-08-02' AS BatchDate, COUNT(*) AS loaded_rows, true AS on_time FROM orders",
    "layer_rewritten": f"""{ORDERS}
SELECT TerritoryID, CAST(a AS DOUBLE) AS Amount, CAST(a AS DOUBLE) / 2 AS Share, CAST(a AS DOUBLE) AS FirstAmount
FROM (SELECT tid AS TerritoryID, SUM(amount) AS a FROM corders GROUP BY tid)""",
    "landing_json_rerun": f"""WITH {_records(FIXED_PLACES, 'l_suppkey % 15')}
SELECT ts, dataset, location, COUNT(*) AS landed_rows
FROM records, (VALUES ('20010802T000000'), ('20010802T060000')) AS runs(ts) GROUP BY ts, dataset, location""",
    "payload_landing_run": f"""WITH {_records(FIXED_PLACES, 'l_suppkey % 15')}
SELECT {_record_columns("CASE dataset WHEN 'archive' THEN humidity END", "round_even((tmax + tmin) / 2, 3)")}
FROM records""",
    "landed_without_zones": """
SELECT o_orderkey AS SalesOrderID, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS OrderDate, 'timestamp_ntz' AS kind
FROM orders""",
    "ingest_manifest": f"""WITH {LANDED}
SELECT tbl AS "table", path || '/dt=2001-08-02' AS path, n AS "rows" FROM landed""",
    "ingest_readback": f"""WITH {LANDED} SELECT tbl AS "table", n AS "rows", ncols AS "columns" FROM landed""",
    "bronze_view_counts": f"""WITH {LANDED} SELECT path AS table_name, n AS "rows" FROM landed""",
    "regional_export_parquet": REGIONAL,
    "regional_export_csv": REGIONAL,
    "rebuilt_table": PRODUCTS_SELECT,
    "typed_load": _typed_summary("total", "cost"),
    "gold_export": f"{FACT} SELECT * EXCLUDE (cash) FROM fact",
    "sales_run": f"""{SALES},
gaps AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT pid, tid FROM lines JOIN catalog USING (pid)))
SELECT 'sales_order_lines' AS table_name, (SELECT COUNT(*) FROM lines) AS "rows"
UNION ALL SELECT 'products', (SELECT COUNT(*) FROM catalog)
UNION ALL SELECT 'sales_summary', n FROM gaps
UNION ALL SELECT 'fact_sales_performance', n FROM gaps""",
    "rfm_run": f"{FACT} {SEGMENTS}",
    # The runs read the source whose lines 3 and 6 lack a total.
    "sales_typed_run": _typed_summary("CASE WHEN line % 3 <> 0 THEN CAST(total AS DECIMAL(12,2)) END"),
    "rfm_v1_run": _as_integers(
        f"{V1} {V1_SCORED}", "CustomerID", "Recency", "Frequency", "R_Score", "F_Score", "M_Score", "RFM_Score"
    ),
    "weather_run": FIXED_RISK + MITIGATION_SELECT,
    "order_line_repeats": """
SELECT l_orderkey AS SalesOrderID, l_linenumber AS SalesOrderDetailID, COUNT(*) AS copies
FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""",
    "detail_null_profile": """
SELECT 'LineTotal' AS column_name, COUNT(*) AS "rows", COUNT(*) FILTER (l_linenumber % 3 = 0) AS nulls FROM lineitem
UNION ALL SELECT 'UnitPriceDiscount', COUNT(*), COUNT(*) FILTER (l_linenumber = 6) FROM lineitem
UNION ALL SELECT 'UnitPrice', COUNT(*), COUNT(*) FILTER (l_extendedprice IS NULL) FROM lineitem""",
    "layer_row_counts": f"""{ORDERS},{PRODUCTS},{LINES}
SELECT 'sales_order_lines' AS table_name, (SELECT COUNT(*) FROM lines) AS "rows"
UNION ALL SELECT 'products', (SELECT COUNT(*) FROM catalog)
UNION ALL SELECT 'customer_orders', (SELECT COUNT(*) FROM corders)
UNION ALL SELECT 'customers', (SELECT COUNT(*) FROM people)
UNION ALL SELECT 'territories', (SELECT COUNT(*) FROM territory)""",
}
