"""The same operators on the order and event tables: star joins, top rows, periods, quantiles, calendars, cohorts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabularium.operators import editions as E
from tabularium.operators import metrics as M
from tabularium.operators import relations as R
from tabularium.operators import supersede
from tabularium.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query under its name, with its SQL if there is one."""

    def register(function: Callable) -> Callable:
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


_MONEY = "CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)"


def _money(c: str) -> F.Column:
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


@query(f"""SELECT r.r_name, n.n_name, c.c_mktsegment, o.o_orderpriority, l.l_returnflag, count(*) AS lines, {_MONEY} AS price
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN part p ON l.l_partkey = p.p_partkey WHERE o.o_orderdate >= TIMESTAMP '1996-01-01' AND coalesce(p.p_size, 0) >= 10 AND coalesce(s.s_acctbal, 0) > 0 GROUP BY ALL""")
def star_join(s: SparkSession, d: str) -> DataFrame:
    """Lines joined to all their dimensions; filters reach the scans, small dimensions are broadcast by the optimiser's own size check."""
    t = lambda n: table(s, d, n)
    lines = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    joined = lines.join(t("orders").filter(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp")), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = joined.join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left").join(t("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    kept = joined.filter((F.coalesce("p_size", F.lit(0)) >= 10) & (F.coalesce("s_acctbal", F.lit(0.0)) > 0))
    return kept.groupBy("r_name", "n_name", "c_mktsegment", "o_orderpriority", "l_returnflag").agg(F.count("*").alias("lines"), _money("l_extendedprice").alias("price"))


@query("""SELECT c.c_custkey, x.o_orderkey, x.o_orderstatus FROM customer c LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) x ON x.o_custkey = c.c_custkey AND x.k = 1""")
def latest_order(s: SparkSession, d: str) -> DataFrame:
    """Every customer with the latest order, if any."""
    newest = R.latest(table(s, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return table(s, d, "customer").select("c_custkey").join(newest, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey", "o_orderstatus")


@query("""SELECT o_orderkey, l_linenumber, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE k = 1""")
def best_line(s: SparkSession, d: str) -> DataFrame:
    """The line of each order that ranks first by flag, price and number."""
    rank = F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    lines = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_extendedprice", "l_partkey").join(table(s, d, "orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return R.top_one(lines, ["o_orderkey"], [rank, F.desc("l_extendedprice"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")]).select("o_orderkey", "l_linenumber", "l_suppkey")


@query("""SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01') AND c_nationkey IN (SELECT s_nationkey FROM supplier)""")
def customers_not_ordering(s: SparkSession, d: str) -> DataFrame:
    """Customers without a recent order in nations that have a supplier."""
    recent = table(s, d, "orders").filter(F.col("o_orderdate") >= F.lit("1998-06-01").cast("timestamp")).select(F.col("o_custkey").alias("c_custkey"))
    return table(s, d, "customer").select("c_custkey", "c_nationkey").join(recent, "c_custkey", "left_anti").join(table(s, d, "supplier").select(F.col("s_nationkey").alias("c_nationkey")), "c_nationkey", "left_semi")


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(quantile_cont(l_quantity, 0.25), 2) AS p25, round(quantile_cont(l_quantity, 0.5), 2) AS median, round(quantile_cont(l_quantity, 0.75), 2) AS p75, round(quantile_cont(l_quantity, 0.9), 2) AS p90, count(*) FILTER (l_quantity > 40) AS over_40 FROM lineitem GROUP BY 1, 2""")
def quantity_quantiles(s: SparkSession, d: str) -> DataFrame:
    """Exact quantiles of quantities."""
    return M.quantile_summary(table(s, d, "lineitem"), ["l_returnflag", "l_linestatus"], F.col("l_quantity"), [40])


@query("""WITH h AS (SELECT event_type, hour(ts) AS h, count(*) AS w FROM events GROUP BY 1, 2), r AS (SELECT *, sum(w) OVER (PARTITION BY event_type ORDER BY h) AS run, sum(w) OVER (PARTITION BY event_type) AS t FROM h)
SELECT event_type, CAST(sum(w) AS BIGINT) AS weight, round(sum(h * w) / sum(w), 6) AS weighted_mean, min(h) FILTER (run >= 0.9 * t) AS share_reached, max(h) AS last FROM r GROUP BY 1""")
def event_hours(s: SparkSession, d: str) -> DataFrame:
    """Mean hour of each kind of event, the hour by which nine tenths have happened, and the last."""
    rows = table(s, d, "events").select("event_type", F.hour("ts").cast("bigint").alias("h"), F.lit(1).cast("bigint").alias("w"))
    return M.weighted_times(rows, ["event_type"], "h", "w")


@query("""SELECT CAST(b.m AS VARCHAR) AS bin, coalesce(c.n, 0) AS n FROM (SELECT CAST(unnest(generate_series(DATE '1992-01-01', DATE '2003-12-01', INTERVAL 1 MONTH)) AS DATE) AS m) b LEFT JOIN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n FROM orders GROUP BY 1) c ON c.m = b.m""")
def orders_by_month(s: SparkSession, d: str) -> DataFrame:
    """Orders of every month, zeros included."""
    return M.calendar_bins(table(s, d, "orders").select("o_orderdate"), "o_orderdate", "month", "1992-01-01", "2003-12-01").withColumn("bin", F.col("bin").cast("string"))


_EV = "m AS (SELECT strftime(ts, '%Y-%m-%d') AS mo, user_id, arg_max(event_type, (ts, event_id)) AS st FROM events GROUP BY 1, 2)"


def _daily(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("state"))


@query(f"""WITH {_EV}, n AS (SELECT mo, row_number() OVER (ORDER BY mo) AS no FROM (SELECT DISTINCT mo FROM m)), p AS (SELECT n.no, m.user_id, m.st FROM m JOIN n USING (mo)), x AS (SELECT max(no) AS l FROM n),
j AS (SELECT coalesce(b.no, a.no + 1) AS edition_no, coalesce(a.st, '(absent)') AS from_state, coalesce(b.st, '(absent)') AS to_state FROM p a FULL OUTER JOIN p b ON a.user_id = b.user_id AND b.no = a.no + 1)
SELECT edition_no, from_state, to_state, count(*) AS n FROM j, x WHERE edition_no > 1 AND edition_no <= l GROUP BY 1, 2, 3""")
def daily_event_transitions(s: SparkSession, d: str) -> DataFrame:
    """Moves between the last events of users from each day to the next."""
    return E.consecutive_transitions(_daily(s, d), "day", "user_id", "state").withColumn("edition_no", F.col("edition_no").cast("bigint"))


@query(f"""WITH {_EV}, l AS (SELECT max(mo) AS last FROM m), f AS (SELECT user_id, min(mo) FILTER (st = 'signup') AS cohort, max(mo) FILTER (st = 'purchase') AS lv, arg_max(st, mo) AS fs, max(mo) AS seen FROM m GROUP BY 1)
SELECT cohort, count(*) AS n, count(*) FILTER (seen = last AND fs = 'signup') AS still_entering, count(*) FILTER (seen = last AND fs = 'purchase') AS left_, count(*) FILTER (seen = last AND fs NOT IN ('signup', 'purchase')) AS other, count(*) FILTER (seen < last) AS not_observed, count(*) FILTER (lv > cohort) AS ever_left FROM f, l WHERE cohort IS NOT NULL GROUP BY 1""")
def signup_cohorts(s: SparkSession, d: str) -> DataFrame:
    """Users by the day they were first seen signing up, and what became of them."""
    return M.first_seen_cohorts(_daily(s, d), "user_id", "day", "state", "signup", "purchase").withColumnRenamed("left", "left_")


@query("""SELECT event_type, max(CASE WHEN k = 'k' THEN v END) AS max_k, count(*) AS n FROM (SELECT event_type, 'k' AS k, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS v FROM events) GROUP BY 1""")
def event_properties(s: SparkSession, d: str) -> DataFrame:
    """The greatest value of a property inside JSON."""
    return table(s, d, "events").select("event_type", F.get_json_object("props", "$.k").try_cast("bigint").alias("v")).groupBy("event_type").agg(F.max("v").alias("max_k"), F.count("*").alias("n"))


@query("""WITH v AS (SELECT o_orderkey, o_custkey, o_orderdate AS f, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS t FROM orders)
SELECT v.o_orderkey, count(*) AS n FROM events e JOIN v ON v.o_custkey = e.user_id AND v.f <= e.ts AND (v.t IS NULL OR e.ts < v.t) GROUP BY 1""")
def events_in_order_periods(s: SparkSession, d: str) -> DataFrame:
    """Events that fall between an order of the same number and the next."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    periods = table(s, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("valid_from"), F.lead("o_orderdate").over(w).alias("valid_to"))
    return R.join_in_period(table(s, d, "events").select("user_id", "ts"), periods, ["user_id"], "ts", "valid_from", "valid_to").groupBy("o_orderkey").agg(F.count("*").alias("n"))


@query("""WITH g AS (SELECT o_custkey, date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), CAST(o_orderdate AS DATE)) AS gap FROM orders)
SELECT o_custkey, count(gap) AS gaps, CASE WHEN count(gap) >= 2 THEN quantile_cont(gap, 0.5) END AS median_gap FROM g GROUP BY 1""")
def order_gaps(s: SparkSession, d: str) -> DataFrame:
    """The median of the days between a customer's orders, if there are two gaps or more."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    gaps = table(s, d, "orders").select("o_custkey", F.datediff(F.col("o_orderdate"), F.lag("o_orderdate").over(w)).alias("gap"))
    return gaps.groupBy("o_custkey").agg(F.count("gap").alias("gaps"), F.when(F.count("gap") >= 2, F.percentile("gap", F.lit(0.5))).alias("median_gap"))


@query("""SELECT p_partkey, p_brand, rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC) AS rank FROM part""")
def part_rank(s: SparkSession, d: str) -> DataFrame:
    """Parts of each brand by price; ties share a rank."""
    return M.competition_rank(table(s, d, "part").select("p_partkey", "p_brand", "p_retailprice"), ["p_brand"], "p_retailprice").select("p_partkey", "p_brand", F.col("rank").cast("bigint").alias("rank"))


@query("""SELECT s_suppkey, round(100.0 * (rank() OVER (ORDER BY s_acctbal) - 1 + (count(*) OVER (PARTITION BY s_acctbal) - 1) / 2) / (count(*) OVER () - 1), 6) AS score FROM supplier""")
def supplier_midrank(s: SparkSession, d: str) -> DataFrame:
    """Suppliers' balances as a score from 0 to 100."""
    return M.midrank_score(table(s, d, "supplier").select("s_suppkey", "s_acctbal"), [], "s_acctbal").select("s_suppkey", F.round("score", 6).alias("score"))


@query("""WITH b AS (SELECT o_custkey AS k, o_orderpriority AS p, arg_max(o_orderstatus, o_orderkey) AS s FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1, 2), a AS (SELECT o_custkey AS k, o_orderpriority AS p, arg_max(o_orderstatus, o_orderkey) AS s FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1, 2)
SELECT coalesce(a.k, b.k) AS o_custkey, coalesce(a.p, b.p) AS o_orderpriority, CASE WHEN b.k IS NULL THEN 'added' WHEN a.k IS NULL THEN 'disappeared' WHEN a.s <> b.s THEN 'status_changed' ELSE 'unchanged' END AS change, CASE WHEN a.s <> b.s THEN b.s || '->' || a.s END AS transition FROM a FULL OUTER JOIN b ON a.k = b.k AND a.p = b.p""")
def order_halves_diff(s: SparkSession, d: str) -> DataFrame:
    """Orders before and after a day by customer and priority, as two editions."""
    orders, day = table(s, d, "orders"), F.lit("1997-01-01").cast("timestamp")
    return E.edition_diff(orders.filter(F.col("o_orderdate") < day), orders.filter(F.col("o_orderdate") >= day), ["o_custkey", "o_orderpriority"], "o_orderkey", "o_orderstatus", ["o_orderstatus"])


@query("""SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY GROUPING SETS ((c_nationkey, c_mktsegment), (c_nationkey), ())""")
def customer_totals(s: SparkSession, d: str) -> DataFrame:
    """Customers by nation and segment, by nation, and in all."""
    return table(s, d, "customer").groupingSets([["c_nationkey", "c_mktsegment"], ["c_nationkey"], []], "c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))


@query("""SELECT event_type, strftime(min(ts), '%Y-%m-%d') AS first_observed, date_diff('day', CAST(min(ts) AS DATE), DATE '2026-01-01') AS age_days FROM events GROUP BY 1""")
def event_first_observed(s: SparkSession, d: str) -> DataFrame:
    """When each kind of event was first seen and how long ago."""
    out = supersede.first_observed(table(s, d, "events"), ["event_type"], "ts", F.lit("2026-01-01").cast("date"))
    return out.select("event_type", F.date_format("first_observed", "yyyy-MM-dd").alias("first_observed"), F.col("age_days").cast("bigint").alias("age_days"))


@query(f"""SELECT l.l_returnflag, l.l_linestatus, CAST(sum(CAST(l.l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity, {_MONEY} AS price, round(avg(l.l_discount), 6) AS discount, count(*) AS n FROM lineitem l WHERE l.l_shipdate <= TIMESTAMP '2001-09-02' GROUP BY 1, 2""")
def line_summary(s: SparkSession, d: str) -> DataFrame:
    """Totals of lines shipped up to a day, of five columns read."""
    lines = table(s, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("2001-09-02").cast("timestamp"))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(_money("l_quantity").alias("quantity"), _money("l_extendedprice").alias("price"), F.round(F.avg("l_discount"), 6).alias("discount"), F.count("*").alias("n"))
