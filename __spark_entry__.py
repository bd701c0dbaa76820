
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid import plans
from casegrid.functions import DATE_PATTERN, EARTH_RADIUS_M, haversine, matches_text, year_of
from casegrid.operators.contains import contains_count, join_contains
from casegrid.operators.counts import banded_count, token_frequency
from casegrid.operators.nearest import nearest, nearest_summary
from casegrid.operators.rows import dedup, union_incidents, valid_points
from casegrid.operators.shares import top_share, top_share_sql
from casegrid.operators.stats import corr_slices, rate_table, weighted_mean_by
from casegrid.functions.geometry import register_geometry
from casegrid.sources import (
    Catalogue,
    Dataset,
    geojson_features,
    geojson_geometries,
    parse_code_dictionary,
    parse_income,
    profile_columns,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(column: str | Column, digits: int) -> Column:
    return F.round(column, digits)


# --- the tables hold no coordinates: these are made from the keys, alike in both engines -------------

LON, LAT = (-118.7, 1009), (33.7, 997)  # (south-west corner, lattice size)


def spread(key: str, factor: int, axis: tuple[float, int]) -> Column:
    start, size = axis
    return F.lit(start) + ((F.col(key) * factor) % size) / F.lit(float(size)) * F.lit(0.6)


def spread_sql(key: str, factor: int, axis: tuple[float, int]) -> str:
    start, size = axis
    return f"({start}::DOUBLE + (({key} * {factor}) % {size}) / {float(size)}::DOUBLE * 0.6::DOUBLE)"


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"2 * {EARTH_RADIUS_M}::DOUBLE * asin(least(1.0::DOUBLE, sqrt("
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def order_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        spread("o_orderkey", 6151, LON).alias("lon"),
        spread("o_orderkey", 7919, LAT).alias("lat"),
    )


def supplier_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        spread("s_suppkey", 7919, LON).alias("x"),
        spread("s_suppkey", 104729, LAT).alias("y"),
    )


ORDER_POINTS_SQL = (
    f"SELECT o_orderkey, {spread_sql('o_orderkey', 6151, LON)} AS lon,"
    f" {spread_sql('o_orderkey', 7919, LAT)} AS lat FROM orders"
)
SUPPLIER_SITES_SQL = (
    f"SELECT s_suppkey, {spread_sql('s_suppkey', 7919, LON)} AS x,"
    f" {spread_sql('s_suppkey', 104729, LAT)} AS y FROM supplier"
)

# --- counting -----------------------------------------------------------------------------------------

NEEDLE, WORD = "ring", "the"
SIZE_BANDS = (("small", None, 9), ("medium", 10, 24), ("large", 25, 39), ("huge", 40, None))


def q_banded_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return banded_count(table(spark, sf_dir, "part"), "p_name", NEEDLE, "p_size", SIZE_BANDS)


def q_banded_count_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return banded_count(table(spark, sf_dir, "part"), "p_name", NEEDLE, "p_size", SIZE_BANDS, python_udf=True)


BANDED_COUNT_SQL = f"""
SELECT CASE WHEN p_size <= 9 THEN 'small' WHEN p_size BETWEEN 10 AND 24 THEN 'medium'
            WHEN p_size BETWEEN 25 AND 39 THEN 'large' ELSE 'huge' END AS band, count(*) AS count
FROM part WHERE contains(lower(p_name), '{NEEDLE}') AND p_size > 0 GROUP BY 1
"""


def q_text_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.filter(matches_text(F.col("text"), WORD)).select("doc_id", "lang", "source")


# --- sources: types of text, data sets by name -----------------------------------------------------------

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
PROFILED = {c: f"CAST({c} AS {{text}})" for c in ORDER_COLUMNS} | {
    "padded": "lpad(CAST(o_custkey AS {text}), 12, '0')",
    "day": "substr(CAST(o_orderdate AS {text}), 1, 10)",
    "sparse": "CASE WHEN o_orderkey % 3 = 0 THEN ' ' WHEN o_orderkey % 3 = 1 THEN CAST(o_orderkey * 10000000000 AS {text}) END",
    "flag": "CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'false' END",
    "nothing": "''",
}


def q_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = [text.format(text="STRING") + f" AS {name}" for name, text in PROFILED.items()]
    return profile_columns(table(spark, sf_dir, "orders").selectExpr(*texts), keep_zeros=True)


def _profile_sql(name: str, text: str) -> str:
    fits = {
        "boolean": "lower(v) IN ('true', 'false')",
        "int": "regexp_full_match(v, '[+-]?[0-9]+') AND NOT regexp_matches(v, '^[+-]?0[0-9]') AND try_cast(v AS INTEGER) IS NOT NULL",
        "bigint": "regexp_full_match(v, '[+-]?[0-9]+') AND NOT regexp_matches(v, '^[+-]?0[0-9]') AND try_cast(v AS BIGINT) IS NOT NULL",
        "double": "regexp_full_match(v, '[+-]?[0-9.]+([eE][+-]?[0-9]+)?') AND NOT regexp_matches(v, '^[+-]?0[0-9]') AND try_cast(v AS DOUBLE) IS NOT NULL",
        "date": "regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(v AS DATE) IS NOT NULL",
        "timestamp": "regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(v AS TIMESTAMP) IS NOT NULL",
    }
    kinds = " ".join(f"WHEN bool_and({test}) FILTER (WHERE v IS NOT NULL) THEN '{kind}'" for kind, test in fits.items())
    return (
        f"SELECT '{name}' AS \"column\", CASE WHEN count(v) = 0 THEN 'string' {kinds} ELSE 'string' END AS kind, count(v) AS n_values,"
        f" count(*) - count(v) AS n_blank, CAST(0 AS BIGINT) AS n_misfits FROM (SELECT nullif(trim({text.format(text='VARCHAR')}), '') AS v FROM orders)"
    )


INFERRED_TYPES_SQL = " UNION ALL ".join(_profile_sql(name, text) for name, text in PROFILED.items())


def q_catalogue_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement over data sets that are known by name only."""
    orders = {"o_custkey": "bigint", "o_totalprice": "double"}
    catalogue = Catalogue(
        spark,
        [
            Dataset("named_orders", f"{sf_dir}/orders.parquet", "parquet", orders),
            Dataset("named_customers", f"{sf_dir}/customer.parquet", "parquet", {"c_custkey": "bigint", "c_mktsegment": "string"}),
        ],
    )
    result = spark.sql(CATALOGUE_SQL.format(orders="named_orders", customers="named_customers"))
    for name in list(catalogue.datasets):
        catalogue.unbind(name)
    return result


CATALOGUE_SQL = """
SELECT c_mktsegment, count(*) AS n, round(avg(o_totalprice), 4) AS mean_price
FROM {orders} JOIN {customers} ON o_custkey = c_custkey GROUP BY c_mktsegment
"""


# --- cleaning -----------------------------------------------------------------------------------------

LINE_KEYS = ("l_orderkey", "l_linenumber")


def q_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "lineitem"), LINE_KEYS, ["l_shipdate"])


DEDUP_SQL = """
SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate,
        l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS place
    FROM lineitem)
WHERE place = 1
"""


def q_union_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    earlier = orders.filter(F.col("o_orderdate") < F.lit("1998-02-01").cast("date"))
    later = orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("date"))
    return dedup(union_incidents(earlier, later.select(*reversed(orders.columns))), ["o_orderkey"])


def q_year_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("o_orderdate", DATE_PATTERN)
    years = table(spark, sf_dir, "orders").select(year_of(text).cast("long").alias("year"))
    return years.groupBy("year").agg(F.count("*").alias("count")).orderBy("year")


YEAR_OF_SQL = """
SELECT year(try_strptime(strftime(o_orderdate, '%Y %b %d %I:%M:%S %p'), '%Y %b %d %I:%M:%S %p')) AS year,
       count(*) AS count
FROM orders GROUP BY 1
"""


def q_parse_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances written as money text, parsed back and summed per nation; machinery customers have no amount."""
    listed = table(spark, sf_dir, "customer").select(
        "c_nationkey",
        F.when(F.col("c_mktsegment") < "M", F.concat(F.lit("$"), F.format_number("c_acctbal", 2)))
        .otherwise(F.lit("n/a"))
        .alias("amount"),
    )
    parsed = parse_income(listed, "c_nationkey", "amount")
    return parsed.groupBy(F.col("zip").alias("c_nationkey")).agg(
        F.count("*").alias("n"), rounded(F.sum("income"), 2).alias("total")
    )


PARSE_MONEY_SQL = """
SELECT c_nationkey, count(*) AS n, round(sum(c_acctbal), 2) AS total
FROM customer WHERE c_mktsegment < 'M' GROUP BY 1
"""


def q_json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = F.get_json_object("props", "$.k").alias("k")
    return table(spark, sf_dir, "events").groupBy(field).agg(F.count("*").alias("count"))


JSON_FIELD_SQL = "SELECT json_extract_string(props, '$.k') AS k, count(*) AS count FROM events GROUP BY 1"


# --- code lists ---------------------------------------------------------------------------------------

DIGITS = 12  # wide enough for any key, so that codes stay distinct at every scale


def line_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item lists the codes of its supplier and its part, separated by blanks."""
    supplier, part = (F.lpad(F.col(c).cast("string"), DIGITS, "0") for c in ("l_suppkey", "l_partkey"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws(" ", supplier, part).alias("codes"),
        F.concat_ws(" \t ", supplier, part).alias("ragged"),
    )


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary lines; suppliers in debt are listed by code only."""
    code = F.lpad(F.col("s_suppkey").cast("string"), DIGITS, "0")
    line = F.when(F.col("s_acctbal") < 0, code).otherwise(F.concat(code, F.lit("  "), F.col("s_name")))
    return table(spark, sf_dir, "supplier").select(line.alias("value"))


def _plain(frequency: DataFrame) -> DataFrame:
    return frequency.select(
        F.col("Code").alias("code"),
        F.col("Description").alias("description"),
        F.col("Frequency").alias("frequency"),
    )


def token_query(join_hint: str | None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        dictionary = parse_code_dictionary(supplier_lines(spark, sf_dir), DIGITS)
        return _plain(token_frequency(line_codes(spark, sf_dir), "codes", dictionary, join_hint))

    return run


def q_token_frequency_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionary = parse_code_dictionary(supplier_lines(spark, sf_dir), DIGITS)
    return _plain(
        token_frequency(
            line_codes(spark, sf_dir), "ragged", dictionary, trim_tokens=True, blank_as_unknown=True
        )
    )


def token_sql(blank: str) -> str:
    return f"""
WITH codes AS (
    SELECT lpad(l_suppkey::VARCHAR, {DIGITS}, '0') AS code FROM lineitem
    UNION ALL SELECT lpad(l_partkey::VARCHAR, {DIGITS}, '0') FROM lineitem
),
counts AS (SELECT code, count(*) AS frequency FROM codes GROUP BY 1),
entries AS (
    SELECT lpad(s_suppkey::VARCHAR, {DIGITS}, '0') AS code,
           CASE WHEN s_acctbal < 0 THEN '{blank}' ELSE s_name END AS description
    FROM supplier
)
SELECT c.code, coalesce(e.description, 'Unknown') AS description, c.frequency
FROM counts c LEFT JOIN entries e ON c.code = e.code
"""


def q_code_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of supplier lines; suppliers in debt have a line without a leading code."""
    code = F.lpad(F.col("s_suppkey").cast("string"), DIGITS, "0")
    lead = F.when(F.col("s_acctbal") < 0, F.lit("- ")).otherwise(F.lit(""))
    lines = table(spark, sf_dir, "supplier").select(
        F.concat(lead, code, F.lit("\t"), F.col("s_name")).alias("value")
    )
    return parse_code_dictionary(lines, DIGITS).select(
        F.col("Code").alias("code"), F.col("Description").alias("description")
    )


CODE_DICTIONARY_SQL = f"""
SELECT lpad(s_suppkey::VARCHAR, {DIGITS}, '0') AS code, s_name AS description FROM supplier WHERE s_acctbal >= 0
"""

# --- shares -------------------------------------------------------------------------------------------


def share_query(build: Callable[..., DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shares = build(
            table(spark, sf_dir, "lineitem"),
            table(spark, sf_dir, "supplier"),
            year_of(F.col("l_shipdate")),
            "l_suppkey",
            "s_suppkey",
            "s_name",
        )
        return shares.select(
            F.col("year").cast("long").alias("year"),
            "name",
            "count",
            F.format_number("share", 1).alias("percent"),
        )

    return run


TOP_SHARE_SQL = """
WITH groups AS (
    SELECT year(l_shipdate) AS year, s_name AS name, count(*) AS count
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
),
ranked AS (
    SELECT *, sum(count) OVER (PARTITION BY year) AS total,
           rank() OVER (PARTITION BY year ORDER BY count DESC) AS place
    FROM groups
)
SELECT year, name, count, format('{:,.1f}', (count / total) * 100) AS percent FROM ranked WHERE place <= 3
"""

# --- points -------------------------------------------------------------------------------------------


def q_valid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in debt have longitude 0, those of one market segment have no latitude, some nations have none
    that is a number, is finite or is in range."""
    wrong = F.when(F.col("c_nationkey") == 3, F.lit(float("nan"))).when(F.col("c_nationkey") == 7, F.lit(float("inf")))
    wrong = wrong.when(F.col("c_nationkey") == 11, F.lit(91.0)).otherwise(spread("c_custkey", 6151, LAT))
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, F.lit(0.0)).otherwise(spread("c_custkey", 7919, LON)).alias("lon"),
        F.when(F.col("c_mktsegment") != "MACHINERY", wrong).alias("lat"),
    )
    return valid_points(customers, "lat", "lon").select(
        "c_custkey", rounded("lon", 9).alias("lon"), rounded("lat", 9).alias("lat")
    )


VALID_POINTS_SQL = f"""
SELECT c_custkey, round({spread_sql('c_custkey', 7919, LON)}, 9) AS lon,
       round({spread_sql('c_custkey', 6151, LAT)}, 9) AS lat
FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'MACHINERY' AND c_nationkey NOT IN (3, 7, 11)
"""


def q_point_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of every order from its customer's home."""
    home = (spread("o_custkey", 7919, LON), spread("o_custkey", 6151, LAT))
    place = (spread("o_orderkey", 6151, LON), spread("o_orderkey", 7919, LAT))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", rounded(haversine(*place, *home), 3).alias("distance_m")
    )


POINT_DISTANCE_SQL = f"""
SELECT o_orderkey, round({haversine_sql('lon', 'lat', 'home_lon', 'home_lat')}, 3) AS distance_m
FROM (SELECT o_orderkey, {spread_sql('o_orderkey', 6151, LON)} AS lon, {spread_sql('o_orderkey', 7919, LAT)} AS lat,
             {spread_sql('o_custkey', 7919, LON)} AS home_lon, {spread_sql('o_custkey', 6151, LAT)} AS home_lat
      FROM orders)
"""

SITES = {"site_id": "s_suppkey", "site_lon": "x", "site_lat": "y"}


def nearest_query(method: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = nearest(
            order_points(spark, sf_dir),
            supplier_sites(spark, sf_dir),
            point_id="o_orderkey",
            lon="lon",
            lat="lat",
            method=method,
            **SITES,
        )
        return found.select(
            F.col("id").alias("o_orderkey"),
            F.col("site").alias("s_suppkey"),
            rounded("distance_m", 3).alias("distance_m"),
        )

    return run


def q_nearest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = nearest_summary(
        order_points(spark, sf_dir), supplier_sites(spark, sf_dir), lon="lon", lat="lat", **SITES
    )
    return summary.select(
        F.col("site").alias("s_suppkey"), "count", rounded("mean_m", 3).alias("mean_m")
    )


_RANKED_SQL = f"""
WITH points AS ({ORDER_POINTS_SQL}),
sites AS ({SUPPLIER_SITES_SQL}),
ranked AS (
    SELECT o_orderkey, s_suppkey, d, rank() OVER (PARTITION BY o_orderkey ORDER BY d) AS place
    FROM (SELECT o_orderkey, s_suppkey, {haversine_sql('lon', 'lat', 'x', 'y')} AS d FROM points CROSS JOIN sites)
)
"""
NEAREST_SQL = _RANKED_SQL + "SELECT o_orderkey, s_suppkey, round(d, 3) AS distance_m FROM ranked WHERE place = 1"
NEAREST_SUMMARY_SQL = (
    _RANKED_SQL
    + "SELECT s_suppkey, count(*) AS count, round(avg(d), 3) AS mean_m FROM ranked WHERE place = 1 GROUP BY 1"
)

# --- polygons -----------------------------------------------------------------------------------------


def nation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A diamond around every nation's centre as GeoJSON feature lines; its size depends on the region."""
    x, y = spread("n_nationkey", 7919, LON), spread("n_nationkey", 104729, LAT)
    r = F.lit(0.0123) * (F.col("n_regionkey") + 1) * (F.col("n_regionkey") + 1)

    def corner(lon: Column, lat: Column) -> Column:
        return F.concat(F.lit("["), lon.cast("string"), F.lit(","), lat.cast("string"), F.lit("]"))

    ring = F.concat_ws(",", corner(x - r, y), corner(x, y - r), corner(x + r, y), corner(x, y + r), corner(x - r, y))
    return table(spark, sf_dir, "nation").select(
        F.concat(
            F.lit('{ "type": "Feature", "properties": { "COMM": "'),
            F.col("n_name"),
            F.lit('", "ZCTA20": "'),
            F.col("n_regionkey").cast("string"),
            F.lit('", "POP20": '),
            (F.col("n_nationkey") + 100).cast("string"),
            F.lit(' }, "geometry": { "type": "Polygon", "coordinates": [['),
            ring,
            F.lit("]] } },"),
        ).alias("value")
    )


_DIAMONDS_SQL = f"""
WITH diamonds AS (
    SELECT n_name, n_nationkey + 100 AS population, {spread_sql('n_nationkey', 7919, LON)} AS cx,
           {spread_sql('n_nationkey', 104729, LAT)} AS cy,
           0.0123::DOUBLE * (n_regionkey + 1) * (n_regionkey + 1) AS r
    FROM nation
),
points AS ({ORDER_POINTS_SQL}),
pairs AS (SELECT n_name, o_orderkey FROM points JOIN diamonds ON abs(lon - cx) + abs(lat - cy) < r)
"""


def q_geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = F.col("coordinates")[0][0]
    return geojson_features(nation_lines(spark, sf_dir)).select(
        F.col("COMM").alias("n_name"),
        F.col("POP20").alias("population"),
        F.size(ring).cast("long").alias("vertices"),
        rounded(F.array_min(F.transform(ring, lambda p: p[0])), 6).alias("west"),
        rounded(F.array_max(F.transform(ring, lambda p: p[1])), 6).alias("north"),
    )


GEOJSON_SQL = (
    _DIAMONDS_SQL
    + "SELECT n_name, population::BIGINT AS population, 5::BIGINT AS vertices,"
    " round(cx - r, 6) AS west, round(cy + r, 6) AS north FROM diamonds"
)


def q_contains_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    polygons = geojson_features(nation_lines(spark, sf_dir)).select(F.col("COMM").alias("n_name"), "coordinates")
    return join_contains(order_points(spark, sf_dir), polygons, lon="lon", lat="lat").select(
        "n_name", "o_orderkey"
    )


def q_contains_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    polygons = geojson_features(nation_lines(spark, sf_dir)).select(F.col("COMM").alias("n_name"), "coordinates")
    return contains_count(order_points(spark, sf_dir), polygons, lon="lon", lat="lat", key="n_name")


DIAMOND_POINTS = 4 * 300  # vertices of each of the diamonds below


def many_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The diamonds again, every side divided by further vertices."""
    x, y = spread("n_nationkey", 7919, LON), spread("n_nationkey", 104729, LAT)
    r = F.lit(0.0123) * (F.col("n_regionkey") + 1) * (F.col("n_regionkey") + 1)
    quarter = F.lit(DIAMOND_POINTS // 4)

    def vertex(k: Column) -> Column:
        side, along = F.floor(k / quarter) % 4, (k % quarter) / quarter
        east = F.when(side == 0, along - 1).when(side == 1, along).when(side == 2, 1 - along).otherwise(-along)
        north = F.when(side == 0, -along).when(side == 1, along - 1).when(side == 2, along).otherwise(1 - along)
        return F.array(x + r * east, y + r * north)

    ring = F.transform(F.sequence(F.lit(0), F.lit(DIAMOND_POINTS)), vertex)
    return table(spark, sf_dir, "nation").select("n_name", F.array(F.array(ring)).alias("coordinates"))


def q_contains_many_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    polygons = many_vertices(spark, sf_dir)
    found = contains_count(
        order_points(spark, sf_dir), polygons, lon="lon", lat="lat", key="n_name", boundary="half_open"
    )
    return found.select("n_name", "count")


# --- the functions in SQL -------------------------------------------------------------------------------

CELLS_PER_DEGREE = 20


def q_sql_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`point_distance` as a statement."""
    register_geometry(spark)
    home = (spread("o_custkey", 7919, LON), spread("o_custkey", 6151, LAT))
    orders = table(spark, sf_dir, "orders").withColumn("home_lon", home[0]).withColumn("home_lat", home[1])
    points = orders.withColumns({"lon": spread("o_orderkey", 6151, LON), "lat": spread("o_orderkey", 7919, LAT)})
    statement = """
        SELECT o_orderkey, round(geo_distance(geo_point(lon, lat), geo_point(home_lon, home_lat)), 3) AS distance_m
        FROM {points}"""
    return spark.sql(statement, points=points)


def q_sql_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`contains_join` as a statement: an equi-join on grid cells, then the test."""
    areas = geojson_geometries(nation_lines(spark, sf_dir)).select(F.col("COMM").alias("n_name"), "geometry")
    statement = f"""
        SELECT a.n_name, p.o_orderkey
        FROM (SELECT n_name, geometry, c.cell FROM {{areas}}, LATERAL geo_cells(geometry, {CELLS_PER_DEGREE}) AS c) AS a
        JOIN (SELECT o_orderkey, geo_point(lon, lat) AS place FROM {{points}}) AS p
          ON geo_cell(p.place, {CELLS_PER_DEGREE}) = a.cell
        WHERE geo_contains(a.geometry, p.place)"""
    return spark.sql(statement, areas=areas, points=order_points(spark, sf_dir))


def kinds_of_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation as a GeoJSON feature of one of the seven kinds, around its centre; size depends on the region."""
    x, y = spread("n_nationkey", 7919, LON), spread("n_nationkey", 104729, LAT)
    r = F.lit(0.0123) * (F.col("n_regionkey") + 1) * (F.col("n_regionkey") + 1)

    def listed(*parts: Column) -> Column:
        return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))

    def at(lon: Column, lat: Column) -> Column:
        return listed(lon.cast("string"), lat.cast("string"))

    def diamond(x: Column) -> Column:
        return listed(listed(at(x - r, y), at(x, y - r), at(x + r, y), at(x, y + r), at(x - r, y)))

    def geometry(kind: str, coordinates: Column) -> Column:
        return F.concat(F.lit(f'{{"type": "{kind}", "coordinates": '), coordinates, F.lit("}"))

    across, upright = listed(at(x - r, y), at(x + r, y)), listed(at(x, y - r), at(x, y + r))
    kinds = [
        geometry("Point", at(x, y)),
        geometry("MultiPoint", listed(at(x, y), at(x + r, y))),
        geometry("LineString", listed(at(x - r, y), at(x, y), at(x + r, y))),
        geometry("MultiLineString", listed(across, upright)),
        geometry("Polygon", diamond(x)),
        geometry("MultiPolygon", listed(diamond(x), diamond(x + 4 * r))),
        F.concat(
            F.lit('{"type": "GeometryCollection", "geometries": ['),
            F.concat_ws(",", geometry("Point", at(x, y)), geometry("Polygon", diamond(x))),
            F.lit("]}"),
        ),
    ]
    chosen = F.get(F.array(*kinds), (F.col("n_nationkey") % len(kinds)).cast("int"))
    head = F.concat(F.lit('{ "type": "Feature", "properties": { "COMM": "'), F.col("n_name"), F.lit('" }, "geometry": '))
    return table(spark, sf_dir, "nation").select(F.concat(head, chosen, F.lit(" }")).alias("value"))


def q_geometry_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of every kind: their vertices, edges and boxes, and how many orders' places they hold."""
    features = geojson_geometries(kinds_of_features(spark, sf_dir), "COMM STRING").withColumnRenamed("COMM", "n_name")
    statement = f"""
        WITH held AS (
            SELECT a.n_name, count(*) AS held
            FROM (SELECT n_name, geometry, c.cell FROM {{features}}, LATERAL geo_cells(geometry, {CELLS_PER_DEGREE}) AS c) AS a
            JOIN (SELECT geo_point(lon, lat) AS place FROM {{points}}) AS p
              ON geo_cell(p.place, {CELLS_PER_DEGREE}) = a.cell
            WHERE geo_contains(a.geometry, p.place) GROUP BY a.n_name),
        described AS (
            SELECT n_name, geometry.kind AS kind, cast(size(geo_vertices(geometry)) AS BIGINT) AS vertices,
                   cast(size(geo_edges(geometry)) AS BIGINT) AS edges, geo_box(geometry) AS box FROM {{features}})
        SELECT n_name, kind, vertices, edges, round(box.west, 6) AS west, round(box.north, 6) AS north, coalesce(held, 0) AS held
        FROM described LEFT JOIN held USING (n_name)"""
    return spark.sql(statement, features=features, points=order_points(spark, sf_dir))


GEOMETRY_KINDS_SQL = f"""
WITH places AS ({ORDER_POINTS_SQL}),
shapes AS (
    SELECT n_name, n_nationkey % 7 AS k, {spread_sql('n_nationkey', 7919, LON)} AS cx, {spread_sql('n_nationkey', 104729, LAT)} AS cy,
           0.0123::DOUBLE * (n_regionkey + 1) * (n_regionkey + 1) AS r
    FROM nation),
held AS (
    SELECT n_name, count(*) AS held FROM shapes JOIN places ON CASE k
        WHEN 0 THEN lon = cx AND lat = cy
        WHEN 1 THEN lat = cy AND (lon = cx OR lon = cx + r)
        WHEN 2 THEN lat = cy AND lon BETWEEN cx - r AND cx + r
        WHEN 3 THEN (lat = cy AND lon BETWEEN cx - r AND cx + r) OR (lon = cx AND lat BETWEEN cy - r AND cy + r)
        WHEN 5 THEN abs(lon - cx) + abs(lat - cy) < r OR abs(lon - (cx + 4 * r)) + abs(lat - cy) < r
        ELSE abs(lon - cx) + abs(lat - cy) < r END
    GROUP BY 1)
SELECT n_name,
       ['Point', 'MultiPoint', 'LineString', 'MultiLineString', 'Polygon', 'MultiPolygon', 'GeometryCollection'][k + 1] AS kind,
       [1, 2, 3, 4, 5, 10, 6][k + 1]::BIGINT AS vertices, [0, 0, 2, 2, 4, 8, 4][k + 1]::BIGINT AS edges,
       round(CASE WHEN k < 2 THEN cx ELSE cx - r END, 6) AS west, round(CASE WHEN k < 3 THEN cy ELSE cy + r END, 6) AS north,
       coalesce(held, 0) AS held
FROM shapes LEFT JOIN held USING (n_name)
"""

# --- means, rates, correlations -------------------------------------------------------------------------


def supplier_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean retail price per supplier, weighted by the quantity delivered."""
    return weighted_mean_by(
        table(spark, sf_dir, "lineitem"),
        "l_suppkey",
        "l_quantity",
        "l_partkey",
        table(spark, sf_dir, "part"),
        "p_partkey",
        "p_retailprice",
    )


def supplier_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines per supplier and year, per unit delivered."""
    returned = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    counts = returned.groupBy("l_suppkey").agg(F.count("*").alias("count"))
    return rate_table(supplier_means(spark, sf_dir), counts, "l_suppkey")


def q_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_means(spark, sf_dir).select("l_suppkey", "total_weight", rounded("mean", 4).alias("mean"))


def q_rate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_rates(spark, sf_dir).select(
        "l_suppkey", "total_weight", rounded("mean", 4).alias("mean"), "count", rounded("rate", 9).alias("rate")
    )


def q_corr_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = corr_slices(supplier_rates(spark, sf_dir), "mean", "rate", "l_suppkey")
    return slices.select("slice", "n", rounded("corr", 6).alias("corr"))


_RATES_SQL = """
WITH means AS (
    SELECT l_suppkey, sum(l_quantity) AS total_weight, sum(l_quantity * p_retailprice) / sum(l_quantity) AS mean
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
),
counts AS (SELECT l_suppkey, count(*) AS count FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
rates AS (
    SELECT m.l_suppkey, total_weight, mean, count, count / 2.0::DOUBLE / total_weight AS rate
    FROM means m JOIN counts c ON m.l_suppkey = c.l_suppkey
),
placed AS (
    SELECT *, row_number() OVER (ORDER BY mean DESC, l_suppkey) AS from_top,
           row_number() OVER (ORDER BY mean, l_suppkey) AS from_bottom
    FROM rates
)
"""
WEIGHTED_MEAN_SQL = _RATES_SQL + "SELECT l_suppkey, total_weight, round(mean, 4) AS mean FROM means"
RATE_TABLE_SQL = (
    _RATES_SQL + "SELECT l_suppkey, total_weight, round(mean, 4) AS mean, count, round(rate, 9) AS rate FROM rates"
)
CORR_SLICES_SQL = (
    _RATES_SQL
    + """
SELECT 'all' AS slice, count(*) AS n, round(corr(mean, rate), 6) AS corr FROM placed
UNION ALL SELECT 'top10', count(*), round(corr(mean, rate), 6) FROM placed WHERE from_top <= 10
UNION ALL SELECT 'bottom10', count(*), round(corr(mean, rate), 6) FROM placed WHERE from_bottom <= 10
"""
)

# --- the analyses as a whole ----------------------------------------------------------------------------
# Line items serve as incidents, and many of them repeat an incident number. Suppliers are descent groups,
# codes and stations; nations are communities and regions zip codes.


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as incidents; many have a further copy that lacks something: NULL fields, a place of zeros, of NaN."""
    whole = recorded(spark, sf_dir)
    number = F.xxhash64("DR_NO") % 3
    blank = whole.filter(number == 0).withColumns(
        {"Vict Age": F.lit(None).cast("int"), "Mocodes": F.lit(None).cast("string"), "Crm Cd Desc": F.lit("")}
    )
    zero = whole.filter(number == 1).withColumns({"LAT": F.lit(0.0), "LON": F.lit(0.0), "DATE OCC": F.lit(None).cast("string")})
    nowhere = whole.filter(number == 2).withColumns({"LAT": F.lit(float("nan")), "Vict Descent": F.lit(None).cast("string")})
    return union_incidents(blank, nowhere, whole, zero)


def recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("k", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    located = F.col("l_tax") > 0
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("DR_NO"),
        F.date_format("l_shipdate", DATE_PATTERN).alias("DATE OCC"),
        F.when(F.col("l_returnflag") == "R", F.lit("ASSAULT - Aggravated Assault"))
        .otherwise(F.lit("BURGLARY"))
        .alias("Crm Cd Desc"),
        (F.col("l_quantity").cast("int") * 2 - 10).alias("Vict Age"),
        F.col("l_suppkey").cast("string").alias("Vict Descent"),
        F.concat_ws("  ", *(F.lpad(F.col(c).cast("string"), DIGITS, "0") for c in ("l_suppkey", "l_partkey"))).alias(
            "Mocodes"
        ),
        F.when(located, spread("k", 7919, LAT)).otherwise(F.lit(0.0)).alias("LAT"),
        F.when(located, spread("k", 6151, LON)).otherwise(F.lit(0.0)).alias("LON"),
    )


def incidents_sql() -> str:
    """WITH clause: one incident per number, a located one if there is one, then the first by its fields.

    The copies that lack more than a place never win, so they do not occur here at all."""
    return f"""
WITH lines AS (SELECT *, l_orderkey * 8 + l_linenumber AS k FROM lineitem),
every AS (
    SELECT l_orderkey || '-' || l_linenumber AS number, strftime(l_shipdate, '%Y %b %d %I:%M:%S %p') AS occurred,
           CASE WHEN l_returnflag = 'R' THEN 'ASSAULT - Aggravated Assault' ELSE 'BURGLARY' END AS offence,
           l_quantity::INTEGER * 2 - 10 AS age, l_suppkey::VARCHAR AS descent,
           lpad(l_suppkey::VARCHAR, {DIGITS}, '0') || '  ' || lpad(l_partkey::VARCHAR, {DIGITS}, '0') AS codes,
           CASE WHEN l_tax > 0 THEN {spread_sql('k', 7919, LAT)} ELSE 0 END AS lat,
           CASE WHEN l_tax > 0 THEN {spread_sql('k', 6151, LON)} ELSE 0 END AS lon
    FROM lines
),
incidents AS (
    SELECT number, kept.* FROM (
        SELECT number, arg_min((occurred, offence, age, descent, codes, lat, lon)::STRUCT(
                   occurred VARCHAR, offence VARCHAR, age INTEGER, descent VARCHAR, codes VARCHAR, lat DOUBLE, lon DOUBLE),
                   (lat = 0, occurred, offence, age, descent, codes, lat, lon)) AS kept
        FROM every GROUP BY number)
)"""


def victims_by_age(python_udf: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        counts = plans.victims_by_age(incidents(spark, sf_dir), python_udf=python_udf)
        return counts.withColumnRenamed("Age Group", "age_group")

    return run


VICTIMS_BY_AGE_SQL = f"""{incidents_sql()}
SELECT CASE WHEN age < 18 THEN 'Children' WHEN age < 25 THEN 'Young adults' WHEN age < 65 THEN 'Adults'
            ELSE 'Seniors' END AS age_group, count(*) AS count
FROM incidents WHERE lower(offence) LIKE '%aggravated assault%' AND age > 0 GROUP BY 1
"""


def victims_by_descent(sql: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        descents = table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").cast("string").alias("Vict Descent"), F.col("s_name").alias("Vict Descent Full")
        )
        shares = plans.victims_by_descent(incidents(spark, sf_dir), descents, sql=sql)
        return shares.select(
            F.col("year").cast("long").alias("year"),
            F.col("Victim Descent").alias("name"),
            F.col("#").alias("count"),
            F.col("%").alias("percent"),
        )

    return run


VICTIMS_BY_DESCENT_SQL = f"""{incidents_sql()},
groups AS (
    SELECT year(strptime(occurred, '%Y %b %d %I:%M:%S %p')) AS year, s_name AS name, count(*) AS count
    FROM incidents JOIN supplier ON descent = s_suppkey::VARCHAR GROUP BY 1, 2
),
ranked AS (
    SELECT *, sum(count) OVER (PARTITION BY year) AS total,
           rank() OVER (PARTITION BY year ORDER BY count DESC) AS place
    FROM groups
)
SELECT year, name, count, format('{{:,.1f}}', (count / total) * 100) AS percent FROM ranked WHERE place <= 3
"""


def q_method_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionary = parse_code_dictionary(supplier_lines(spark, sf_dir), DIGITS)
    return _plain(plans.method_frequency(incidents(spark, sf_dir), dictionary))


def q_method_frequency_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionary = parse_code_dictionary(supplier_lines(spark, sf_dir), DIGITS)
    ragged = incidents(spark, sf_dir).withColumn("Mocodes", F.regexp_replace("Mocodes", " +", " \t "))
    return _plain(plans.method_frequency(ragged, dictionary, trim_tokens=True, blank_as_unknown=True))


METHOD_FREQUENCY_SQL = f"""{incidents_sql()},
counts AS (
    SELECT code, count(*) AS frequency FROM (SELECT unnest(string_split(codes, ' ')) AS code FROM incidents)
    WHERE code <> '' GROUP BY 1
)
SELECT code, CASE WHEN s_suppkey IS NULL THEN 'Unknown' WHEN s_acctbal < 0 THEN '' ELSE s_name END AS description,
       frequency
FROM counts LEFT JOIN supplier ON code = lpad(s_suppkey::VARCHAR, {DIGITS}, '0')
"""


def q_nearest_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = supplier_sites(spark, sf_dir).select(F.col("s_suppkey").cast("string").alias("DIVISION"), "x", "y")
    return plans.nearest_station(incidents(spark, sf_dir), stations).withColumnRenamed("#", "count")


NEAREST_STATION_SQL = f"""{incidents_sql()},
sites AS ({SUPPLIER_SITES_SQL}),
ranked AS (
    SELECT s_suppkey, d, rank() OVER (PARTITION BY number ORDER BY d) AS place
    FROM (SELECT number, s_suppkey, {haversine_sql('lon', 'lat', 'x', 'y')} AS d
          FROM incidents CROSS JOIN sites WHERE lat <> 0 AND lon <> 0)
)
SELECT s_suppkey::VARCHAR AS division, format('{{:,.3f}}', avg(d) / 1000) AS average_distance, count(*) AS count
FROM ranked WHERE place = 1 GROUP BY 1
"""


def community_rates(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    zips = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("string").alias("Zip Code"),
        F.concat(F.lit("$"), F.format_number(F.col("r_regionkey") * 1234 + 40000, 0)).alias("Estimated Median Income"),
    )
    blocks = geojson_features(nation_lines(spark, sf_dir))
    return plans.community_rates(incidents(spark, sf_dir), blocks, parse_income(zips), **options)


def community_query(**options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return community_rates(spark, sf_dir, **options).select(
            F.col("COMM").alias("community"),
            F.col("Total_Population").alias("population"),
            rounded("Avg_Income", 4).alias("income"),
            F.col("Total_Crimes").alias("count"),
            rounded("Crimes_Per_Person", 9).alias("rate"),
        )

    return run


YEARS = (1996, 1998)


def q_income_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = plans.income_correlations(community_rates(spark, sf_dir))
    return slices.select("slice", "n", rounded("corr", 6).alias("corr"))


_COMMUNITIES_SQL = f"""{incidents_sql()},
areas AS (
    SELECT n_name AS community, n_nationkey + 100 AS population, n_regionkey * 1234 + 40000 AS income,
           {spread_sql('n_nationkey', 7919, LON)} AS cx, {spread_sql('n_nationkey', 104729, LAT)} AS cy,
           0.0123::DOUBLE * (n_regionkey + 1) * (n_regionkey + 1) AS r
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
rates AS (
    SELECT community, population, income, count(*) AS count, count(*) / 2.0::DOUBLE / population AS rate
    FROM incidents JOIN areas ON abs(lon - cx) + abs(lat - cy) < r GROUP BY 1, 2, 3
),
placed AS (
    SELECT *, row_number() OVER (ORDER BY income DESC, community) AS from_top,
           row_number() OVER (ORDER BY income, community) AS from_bottom
    FROM rates
)
"""
COMMUNITY_RATES_SQL = (
    _COMMUNITIES_SQL
    + "SELECT community, population::BIGINT AS population, income::DOUBLE AS income, count, round(rate, 9) AS rate"
    " FROM rates"
)
COMMUNITY_RATES_YEARS_SQL = COMMUNITY_RATES_SQL.replace(
    "FROM incidents JOIN areas ON",
    f"FROM incidents JOIN areas ON year(strptime(occurred, '%Y %b %d %I:%M:%S %p')) IN {YEARS} AND",
)
INCOME_CORRELATIONS_SQL = (
    _COMMUNITIES_SQL
    + """
SELECT 'all' AS slice, count(*) AS n, round(corr(income, rate), 6) AS corr FROM placed
UNION ALL SELECT 'top10', count(*), round(corr(income, rate), 6) FROM placed WHERE from_top <= 10
UNION ALL SELECT 'bottom10', count(*), round(corr(income, rate), 6) FROM placed WHERE from_bottom <= 10
"""
)

# --- contract -------------------------------------------------------------------------------------------

_TOKENS, _TOKENS_UNKNOWN = token_sql(""), token_sql("Unknown")

_QUERIES: dict[str, tuple[Query, str]] = {
    "banded_count": (q_banded_count, BANDED_COUNT_SQL),
    "banded_count_udf": (q_banded_count_udf, BANDED_COUNT_SQL),
    "text_filter": (
        q_text_filter,
        f"SELECT doc_id, lang, source FROM documents WHERE contains(lower(text), '{WORD}')",
    ),
    "inferred_types": (q_inferred_types, INFERRED_TYPES_SQL),
    "catalogue_join": (q_catalogue_join, CATALOGUE_SQL.format(orders="orders", customers="customer")),
    "dedup": (q_dedup, DEDUP_SQL),
    "union_dedup": (q_union_dedup, "SELECT * FROM orders"),
    "year_of": (q_year_of, YEAR_OF_SQL),
    "parse_money": (q_parse_money, PARSE_MONEY_SQL),
    "json_field": (q_json_field, JSON_FIELD_SQL),
    "code_dictionary": (q_code_dictionary, CODE_DICTIONARY_SQL),
    "token_frequency": (token_query(None), _TOKENS),
    "token_frequency_broadcast": (token_query("BROADCAST"), _TOKENS),
    "token_frequency_merge": (token_query("MERGE"), _TOKENS),
    "token_frequency_shuffle_hash": (token_query("SHUFFLE_HASH"), _TOKENS),
    "token_frequency_replicate_nl": (token_query("SHUFFLE_REPLICATE_NL"), _TOKENS),
    "token_frequency_trimmed": (q_token_frequency_trimmed, _TOKENS_UNKNOWN),
    "top_share": (share_query(top_share), TOP_SHARE_SQL),
    "top_share_sql": (share_query(top_share_sql), TOP_SHARE_SQL),
    "valid_points": (q_valid_points, VALID_POINTS_SQL),
    "point_distance": (q_point_distance, POINT_DISTANCE_SQL),
    "nearest": (nearest_query("array"), NEAREST_SQL),
    "nearest_window": (nearest_query("window"), NEAREST_SQL),
    "nearest_summary": (q_nearest_summary, NEAREST_SUMMARY_SQL),
    "geojson_features": (q_geojson_features, GEOJSON_SQL),
    "contains_join": (q_contains_join, _DIAMONDS_SQL + "SELECT n_name, o_orderkey FROM pairs"),
    "contains_count": (
        q_contains_count,
        _DIAMONDS_SQL + "SELECT n_name, count(*) AS count FROM pairs GROUP BY 1",
    ),
    "weighted_mean": (q_weighted_mean, WEIGHTED_MEAN_SQL),
    "rate_table": (q_rate_table, RATE_TABLE_SQL),
    "corr_slices": (q_corr_slices, CORR_SLICES_SQL),
    "sql_distance": (q_sql_distance, POINT_DISTANCE_SQL),
    "sql_contains": (q_sql_contains, _DIAMONDS_SQL + "SELECT n_name, o_orderkey FROM pairs"),
    "geometry_kinds": (q_geometry_kinds, GEOMETRY_KINDS_SQL),
    "contains_many_vertices": (
        q_contains_many_vertices,
        _DIAMONDS_SQL + "SELECT n_name, count(*) AS count FROM pairs GROUP BY 1",
    ),
    "victims_by_age": (victims_by_age(False), VICTIMS_BY_AGE_SQL),
    "victims_by_age_udf": (victims_by_age(True), VICTIMS_BY_AGE_SQL),
    "victims_by_descent": (victims_by_descent(False), VICTIMS_BY_DESCENT_SQL),
    "victims_by_descent_sql": (victims_by_descent(True), VICTIMS_BY_DESCENT_SQL),
    "method_frequency": (q_method_frequency, METHOD_FREQUENCY_SQL),
    "method_frequency_trimmed": (
        q_method_frequency_trimmed,
        METHOD_FREQUENCY_SQL.replace("THEN '' ELSE", "THEN 'Unknown' ELSE"),
    ),
    "nearest_station": (q_nearest_station, NEAREST_STATION_SQL),
    "community_rates": (community_query(), COMMUNITY_RATES_SQL),
    "community_rates_half_open": (community_query(boundary="half_open"), COMMUNITY_RATES_SQL),
    "community_rates_years": (community_query(years=YEARS), COMMUNITY_RATES_YEARS_SQL),
    "income_correlations": (q_income_correlations, INCOME_CORRELATIONS_SQL),
}


def entry(spark: SparkSession) -> DataFrame:
    return q_banded_count(spark, "/root/testdata/sf0.001")


# The training-data operators are a part of their own, which may be absent.
_LLM = ("casegrid.llm", "corpus_pipeline")
try:
    from casegrid.llm.queries import ORACLES as _llm_oracles
    from casegrid.llm.queries import QUERIES as _llm_queries
    from corpus_pipeline import ORACLE_SQL as _pipeline_oracle
    from corpus_pipeline import run as _pipeline

    _llm_queries = {**_llm_queries, "pipeline": _pipeline}
    _llm_oracles = {**_llm_oracles, **({"pipeline": _pipeline_oracle} if _pipeline_oracle else {})}
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(_LLM):
        raise
    _llm_queries, _llm_oracles = {}, {}


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in _QUERIES.items()} | _llm_queries


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items()} | _llm_oracles
