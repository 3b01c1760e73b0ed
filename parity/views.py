"""The driver tables seen as the frames the operators work on, in Spark and in SQL.

Nations play countries: a customer's nation is the origin, a supplier's the host. Money is
summed in whole cents, so sums do not depend on the order of the rows.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.sources import checkpointed


@lru_cache(maxsize=256)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Only its plan is kept, so that its schema is looked up once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> Column:
    # rint, as round goes through decimals; the products are whole but for the last digit.
    return F.rint(F.col(column) * 100).cast("bigint")


def whole(column: str) -> Column:
    return F.col(column).cast("bigint")


def iso(column: str) -> Column:
    """A date as the feeds write it."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")


PARTY_KEYS = {"customer": ("c_custkey", "c_nationkey"), "supplier": ("s_suppkey", "s_nationkey")}


def at_place(df: DataFrame, spark: SparkSession, d: str, party: str, key: str) -> DataFrame:
    """Add the nation of a row's customer or supplier as its location.

    Joined one table after the other, not with the two tables joined beforehand: the size of a
    plain table is known when planning, that of a join is overestimated, and the rows would be
    shuffled for fear of it.
    """
    own_key, nation_key = PARTY_KEYS[party]
    parties = table(spark, d, party).select(F.col(own_key).alias(key), nation_key)
    nations = table(spark, d, "nation").select(
        F.col("n_nationkey").alias(nation_key), F.col("n_name").alias("location_code")
    )
    return df.join(parties, key).join(nations, nation_key).drop(nation_key)


CENTS = "CAST(round({0} * 100) AS BIGINT)"


def with_ctes(*names: str, body: str) -> str:
    """A query over the named views and the views they are built on."""
    needed: list[str] = []

    def need(name: str) -> None:
        for base in BUILT_ON.get(name, ()):
            need(base)
        if name not in needed:
            needed.append(name)

    for name in names:
        need(name)
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in needed)
    return f"WITH {ctes}\n{body}"


VIEW_SQL: dict[str, str] = {}
BUILT_ON: dict[str, tuple[str, ...]] = {}


# -- nation-year and customer-year --------------------------------------------------------------

VIEW_SQL["nation_year"] = f"""
  SELECT n_name AS location_code, CAST(year(o_orderdate) AS INT) AS year,
         CAST(sum({CENTS.format('o_totalprice')}) AS BIGINT) AS amount_cents, count(*) AS n_orders
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2"""


def _by_nation(spark: SparkSession, d: str, period: Column, name: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_custkey", period.alias(name), cents("o_totalprice").alias("_cents"))
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("location_code"))
    # Summed by the integer key first; the 25 names join the small result.
    summed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", name).agg(
        F.sum("_cents").alias("amount_cents"), F.count(F.lit(1)).alias("n_orders")
    )
    return summed.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "location_code", name, "amount_cents", "n_orders"
    )


def nation_year(spark: SparkSession, d: str) -> DataFrame:
    """Order value and number of orders per customer nation and year."""
    return _by_nation(spark, d, F.year("o_orderdate"), "year")


VIEW_SQL["nation_month"] = """
  SELECT n_name AS location_code,
         CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INT) AS month,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS amount_cents,
         count(*) AS n_orders
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2"""


def nation_month(spark: SparkSession, d: str) -> DataFrame:
    """As nation_year by months counted from January 1995; long enough for trends."""
    month = (F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")
    return _by_nation(spark, d, month, "month")


VIEW_SQL["customer_year"] = """
  SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS amount_cents,
         count(*) AS n_orders
  FROM orders GROUP BY 1, 2"""


def customer_year(spark: SparkSession, d: str) -> DataFrame:
    """Order value per customer and year. Most customers skip years, so the series have gaps."""
    return table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum(cents("o_totalprice")).alias("amount_cents"), F.count(F.lit(1)).alias("n_orders")
    )


# -- routes -------------------------------------------------------------------------------------

VIEW_SQL["order_lines"] = """
  SELECT CAST(year(l_shipdate) AS INT) AS year, c_nationkey AS coo, s_nationkey AS coa,
         CAST(l_quantity AS BIGINT) AS qty, l_linestatus, l_returnflag, l_discount, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey"""


def order_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines with the nations they go between."""
    origin = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(
        table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("coo")),
        F.col("o_custkey") == F.col("c_custkey"),
    ).select("o_orderkey", "coo")
    host = table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("coa"))
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_suppkey", F.year("l_shipdate").alias("year"), whole("l_quantity").alias("qty"),
        "l_linestatus", "l_returnflag", "l_discount", "l_tax",
    )
    return (
        lines.join(host, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(origin, F.col("l_orderkey") == F.col("o_orderkey"))
        .drop("l_suppkey", "s_suppkey", "l_orderkey", "o_orderkey")
    )


_ROUTE_NAMES_SQL = """
       JOIN nation o ON coo = o.n_nationkey JOIN region ro ON o.n_regionkey = ro.r_regionkey
       JOIN nation h ON coa = h.n_nationkey JOIN region rh ON h.n_regionkey = rh.r_regionkey"""
_ROUTE_COLUMNS_SQL = (
    "year, o.n_name AS coo_iso, ro.r_name AS coo_name, h.n_name AS coa_iso, rh.r_name AS coa_name"
)


def _with_route_names(df: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    nations = table(spark, d, "nation").join(
        table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", "n_name", "r_name")
    for side in ("coo", "coa"):
        names = nations.select(
            F.col("n_nationkey").alias(side), F.col("n_name").alias(f"{side}_iso"), F.col("r_name").alias(f"{side}_name")
        )
        df = df.join(names, side)
    return df.drop("coo", "coa")


BUILT_ON["population"] = ("order_lines",)
VIEW_SQL["population"] = f"""
  SELECT {_ROUTE_COLUMNS_SQL}, refugees, asylum_seekers, oip, idps
  FROM (SELECT year, coo, coa,
               CAST(sum(qty) FILTER (l_linestatus = 'O') AS BIGINT) AS refugees,
               CAST(sum(qty) FILTER (l_linestatus = 'F') AS BIGINT) AS asylum_seekers,
               count(*) FILTER (l_discount = 0) AS oip,
               CAST(sum(qty) FILTER (coo = coa) AS BIGINT) AS idps
        FROM order_lines GROUP BY 1, 2, 3) {_ROUTE_NAMES_SQL}"""

BUILT_ON["solutions"] = ("order_lines",)
VIEW_SQL["solutions"] = f"""
  SELECT {_ROUTE_COLUMNS_SQL}, returned_refugees, resettlement, naturalisation, returned_idps
  FROM (SELECT year, coo, coa,
               CAST(sum(qty) FILTER (l_returnflag = 'R') AS BIGINT) AS returned_refugees,
               CAST(sum(qty) FILTER (l_returnflag = 'A') AS BIGINT) AS resettlement,
               CAST(sum(qty) FILTER (l_returnflag = 'N') AS BIGINT) AS naturalisation,
               CAST(sum(qty) FILTER (l_returnflag = 'R' AND coo = coa) AS BIGINT) AS returned_idps
        FROM order_lines WHERE l_tax = 0 GROUP BY 1, 2, 3) {_ROUTE_NAMES_SQL}"""


def routes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Population and solutions tables.

    Quantities in transit are people displaced, those within one nation the internally displaced.
    Untaxed quantities by return flag are people leaving, so that some routes have none in a year, which
    is what the floored and the lagged queries are about; taxed ones count for the stocks. Both
    come from one pass over the joined lines, whose few sums are written once.
    """
    flag, qty = F.col("l_returnflag"), F.col("qty")
    internal, untaxed = F.col("coo") == F.col("coa"), F.col("l_tax") == 0
    sums = order_lines(spark, d).groupBy("year", "coo", "coa").agg(
        F.sum(F.when(F.col("l_linestatus") == "O", qty)).alias("refugees"),
        F.sum(F.when(F.col("l_linestatus") == "F", qty)).alias("asylum_seekers"),
        F.count_if(F.col("l_discount") == 0).alias("oip"),
        F.sum(F.when(internal, qty)).alias("idps"),
        F.sum(F.when(untaxed & (flag == "R"), qty)).alias("returned_refugees"),
        F.sum(F.when(untaxed & (flag == "A"), qty)).alias("resettlement"),
        F.sum(F.when(untaxed & (flag == "N"), qty)).alias("naturalisation"),
        F.sum(F.when(untaxed & (flag == "R") & internal, qty)).alias("returned_idps"),
        F.count_if(untaxed).alias("_untaxed"),
    )
    written = checkpointed(_with_route_names(sums, spark, d))
    route = ["year", "coo_iso", "coo_name", "coa_iso", "coa_name"]
    return (
        written.select(*route, "refugees", "asylum_seekers", "oip", "idps"),
        written.filter("_untaxed > 0").select(
            *route, "returned_refugees", "resettlement", "naturalisation", "returned_idps"
        ),
    )


# -- reports by place, level and category -------------------------------------------------------

VIEW_SQL["place_reports"] = """
  SELECT n_name AS location_code, CAST(year(l_shipdate) AS INT) AS year, l_linenumber AS line,
         l_returnflag AS flag, l_linestatus AS status, CAST(l_quantity AS BIGINT) AS qty,
         CAST(round(l_tax * 100) AS BIGINT) AS tax, CAST(round(l_discount * 100) AS BIGINT) AS discount
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""


def place_reports(spark: SparkSession, d: str) -> DataFrame:
    """Every line as a report from the supplier's nation."""
    lines = table(spark, d, "lineitem").select(
        "l_suppkey",
        F.year("l_shipdate").alias("year"),
        F.col("l_linenumber").alias("line"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        whole("l_quantity").alias("qty"),
        cents("l_tax").alias("tax"),
        cents("l_discount").alias("discount"),
    )
    return at_place(lines, spark, d, "supplier", "l_suppkey").drop("l_suppkey")


BUILT_ON["conflict_events"] = ("place_reports",)
VIEW_SQL["conflict_events"] = """
  SELECT location_code, year, line AS admin_level, qty AS events, nullif(tax, 0) AS fatalities,
         CASE flag WHEN 'R' THEN 'political_violence' WHEN 'A' THEN 'civilian_targeting'
                   ELSE 'demonstration' END AS event_type
  FROM place_reports"""


def _came(reports: DataFrame | None) -> list[str]:
    """The time of ingestion, where the reports have one."""
    return [c for c in ("ingested_at",) if reports is not None and c in reports.columns]


def conflict_events(spark: SparkSession, d: str, reports: DataFrame | None = None) -> DataFrame:
    """Line numbers play administrative levels, return flags kinds of events.

    Here and below ``reports`` are the place reports where they have been written for several tables.
    """
    flag = F.col("flag")
    kind = F.when(flag == "R", "political_violence").when(flag == "A", "civilian_targeting")
    return (reports or place_reports(spark, d)).select(
        "location_code", "year", F.col("line").alias("admin_level"), F.col("qty").alias("events"),
        F.nullif("tax", F.lit(0)).alias("fatalities"), kind.otherwise("demonstration").alias("event_type"),
        *_came(reports),
    )


BUILT_ON["foodsecurity"] = ("place_reports",)
VIEW_SQL["foodsecurity"] = """
  SELECT location_code, year, CASE WHEN flag = 'N' THEN 1 ELSE 0 END AS admin_level,
         CASE line WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '3' WHEN 4 THEN '3+' WHEN 5 THEN '4'
                   WHEN 6 THEN '5' ELSE 'all' END AS ipc_phase,
         CASE status WHEN 'O' THEN 'current' ELSE 'first projection' END AS ipc_type,
         qty AS population_in_phase
  FROM place_reports"""


def foodsecurity(spark: SparkSession, d: str, reports: DataFrame | None = None) -> DataFrame:
    """Line numbers play phases; the flag tells national from regional reports."""
    phases = F.array(*[F.lit(p) for p in ("1", "2", "3", "3+", "4", "5", "all")])
    return (reports or place_reports(spark, d)).select(
        "location_code", "year", F.when(F.col("flag") == "N", 1).otherwise(0).alias("admin_level"),
        F.element_at(phases, F.col("line")).alias("ipc_phase"),
        F.when(F.col("status") == "O", "current").otherwise("first projection").alias("ipc_type"),
        F.col("qty").alias("population_in_phase"), *_came(reports),
    )


BUILT_ON["needs"] = ("place_reports",)
VIEW_SQL["needs"] = """
  SELECT location_code, year, CASE WHEN discount < 8 THEN 0 ELSE 1 END AS admin_level,
         CASE WHEN tax < 6 THEN 'Intersectoral' ELSE 'Food' END AS sector_code,
         CASE line WHEN 1 THEN 'AFF' WHEN 2 THEN 'INN' WHEN 3 THEN 'INN' WHEN 4 THEN 'TGT'
                   WHEN 5 THEN 'REA' ELSE 'OTH' END AS population_status,
         CASE WHEN flag = 'R' AND status = 'O' THEN 'total' WHEN flag = 'A' THEN ''
              WHEN flag = 'N' THEN NULL ELSE 'children' END AS category,
         qty * (tax + 1) AS population
  FROM place_reports"""


def needs(spark: SparkSession, d: str, reports: DataFrame | None = None) -> DataFrame:
    """Line numbers play population statuses, flags categories (empty and NULL among them)."""
    line, flag = F.col("line"), F.col("flag")
    status = (
        F.when(line == 1, "AFF").when(line.isin(2, 3), "INN").when(line == 4, "TGT").when(line == 5, "REA")
    )
    category = (
        F.when((flag == "R") & (F.col("status") == "O"), "total").when(flag == "A", "")
        .when(flag != "N", "children")
    )
    return (reports or place_reports(spark, d)).select(
        "location_code", "year",
        F.when(F.col("discount") < 8, 0).otherwise(1).alias("admin_level"),
        F.when(F.col("tax") < 6, "Intersectoral").otherwise("Food").alias("sector_code"),
        status.otherwise("OTH").alias("population_status"), category.alias("category"),
        (F.col("qty") * (F.col("tax") + 1)).alias("population"),
    )


BUILT_ON["povertyrate"] = ("place_reports",)
VIEW_SQL["povertyrate"] = """
  SELECT location_code, year, CASE WHEN flag = 'N' THEN 1 ELSE 0 END AS admin_level,
         discount AS mpi, qty AS headcount_ratio, nullif(tax, 0) AS vulnerable_to_poverty,
         tax + discount AS in_severe_poverty
  FROM place_reports"""


def povertyrate(spark: SparkSession, d: str, reports: DataFrame | None = None) -> DataFrame:
    tax, discount = F.col("tax"), F.col("discount")
    return (reports or place_reports(spark, d)).select(
        "location_code", "year", F.when(F.col("flag") == "N", 1).otherwise(0).alias("admin_level"),
        discount.alias("mpi"), F.col("qty").alias("headcount_ratio"),
        F.nullif(tax, F.lit(0)).alias("vulnerable_to_poverty"), (tax + discount).alias("in_severe_poverty"),
        *_came(reports),
    )


BUILT_ON["wb_mpm"] = ("place_reports",)
VIEW_SQL["wb_mpm"] = """
  SELECT location_code, year, CAST(sum(discount) AS BIGINT) / count(*) AS mpm_value
  FROM place_reports WHERE status = 'O' GROUP BY 1, 2"""


def wb_mpm(spark: SparkSession, d: str, reports: DataFrame | None = None) -> DataFrame:
    return (reports or place_reports(spark, d)).filter("status = 'O'").groupBy("location_code", "year").agg(
        (F.sum("discount") / F.count(F.lit(1))).alias("mpm_value")
    )


BUILT_ON["wb_extreme_poverty"] = ("place_reports",)
VIEW_SQL["wb_extreme_poverty"] = """
  SELECT location_code, year, CAST(sum(tax) AS BIGINT) / count(*) AS extreme_poverty_value
  FROM place_reports WHERE status = 'F' GROUP BY 1, 2"""


def wb_extreme_poverty(spark: SparkSession, d: str, reports: DataFrame | None = None) -> DataFrame:
    return (reports or place_reports(spark, d)).filter("status = 'F'").groupBy("location_code", "year").agg(
        (F.sum("tax") / F.count(F.lit(1))).alias("extreme_poverty_value")
    )


BUILT_ON["wb_gdp"] = ("nation_year",)
VIEW_SQL["wb_gdp"] = "SELECT location_code, year, amount_cents / n_orders / 1e4 AS gdp_per_capita FROM nation_year"


def wb_gdp(spark: SparkSession, d: str, yearly: DataFrame | None = None) -> DataFrame:
    return (yearly or nation_year(spark, d)).select(
        "location_code", "year", (F.col("amount_cents") / F.col("n_orders") / 1e4).alias("gdp_per_capita")
    )


BUILT_ON["wb_population"] = ("nation_year",)
VIEW_SQL["wb_population"] = "SELECT location_code, year, n_orders * 2e4 AS total_population FROM nation_year"


def wb_population(spark: SparkSession, d: str, yearly: DataFrame | None = None) -> DataFrame:
    return (yearly or nation_year(spark, d)).select(
        "location_code", "year", (F.col("n_orders") * 2e4).alias("total_population")
    )


VIEW_SQL["location"] = """
  SELECT n_name AS code, r_name AS name, n_regionkey <> 1 AS has_hrp,
         CASE WHEN n_regionkey <> 2 THEN n_regionkey <> 3 END AS in_gho,
         CAST(1995 + n_regionkey AS INT) AS year
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'REGION_4'"""


def location(spark: SparkSession, d: str) -> DataFrame:
    """Nations with flags that take effect in a year given by their region.

    One region is left out, as the location feed does not know all countries either.
    """
    key = F.col("n_regionkey")
    return (
        table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .filter(F.col("r_name") != "REGION_4")
        .select(
            F.col("n_name").alias("code"), F.col("r_name").alias("name"), (key != 1).alias("has_hrp"),
            F.when(key != 2, key != 3).alias("in_gho"), (1995 + key).cast("int").alias("year"),
        )
    )


# -- appeals ------------------------------------------------------------------------------------

VIEW_SQL["funding"] = """
  SELECT n_name AS location_code, o_orderkey,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Not specified'
              ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS appeal_code,
         CAST(year(o_orderdate) AS INT) AS year, o_orderdate AS ingested_at,
         CAST(o_orderdate AS DATE) AS reference_period_start,
         CAST(last_ship AS DATE) AS reference_period_end,
         CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS requirements_usd,
         received_cents / 100 AS funding_usd
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship,
                         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT))
                              FILTER (l_returnflag = 'R') AS BIGINT) AS received_cents
                  FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey"""


def funding(spark: SparkSession, d: str) -> DataFrame:
    """Orders as appeals from the order date to the last shipment.

    Shipments may precede the order or be missing, so some periods are reversed or open.
    Pending orders require nothing; returned goods are what was received.
    """
    shipped = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("_last"),
        F.sum(F.when(F.col("l_returnflag") == "R", cents("l_extendedprice"))).alias("_received"),
    )
    appeal = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Not specified").otherwise(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    )
    orders = table(spark, d, "orders").join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return (
        at_place(orders, spark, d, "customer", "o_custkey")
        .select(
            "location_code", "o_orderkey", appeal.alias("appeal_code"),
            F.year("o_orderdate").alias("year"), F.col("o_orderdate").alias("ingested_at"),
            iso("o_orderdate").alias("reference_period_start"), iso("_last").alias("reference_period_end"),
            F.when(F.col("o_orderstatus") == "P", 0.0).otherwise(F.col("o_totalprice")).alias("requirements_usd"),
            (F.col("_received") / 100).alias("funding_usd"),
        )
    )
