"""Role views: the operational tables of the health mart, derived from the driver's test tables.

| role              | derived from         | key mapping                                              |
| outcome           | lineitem x orders    | person_id=o_custkey, indication_id=l_suppkey             |
| indication        | supplier             | indication_id=s_suppkey, medicine_id=s_nationkey         |
| medicine (KPI)    | nation x region      | medicine_id=n_nationkey, name=n_name, company=r_name     |
| medicine (part)   | part                 | medicine_id=p_partkey, name=p_type, company=p_brand,     |
|                   |                      | active ingredient=p_name                                 |
| profit            | supplier             | profit=s_acctbal, cost=|profit|, price=cost+profit       |
| person            | customer             | age=c_custkey%101, gender by c_custkey%3,                |
|                   |                      | condition=c_mktsegment, location=c_nationkey             |
| location          | nation x region      | city=n_name, country=r_name                              |
| condition         | distinct c_mktsegment| id = rank by name, intensity level = 6 + id              |
| arrivals          | events               | user_id -> person                                        |

Every view is a projection (plus, for outcome, the lineitem/orders join), so column pruning and
filter pushdown reach the Parquet scans.  Nothing here collects or caches.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import CONDITIONS, with_dense_id
from ..functions.scalar import hundredths_to_money, money_from_double, half_up_div

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Declared schemas of the driver's tables: nothing is inferred, and no file footer is read to
# plan a query.
TEST_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Fixed mapping of the driver's (return flag, line status) pairs to outcome values.
OUTCOME_BY_FLAG = {"N": "recovered", "A": "worsened"}
OUTCOME_RETURNED = {"F": "died", "O": "relapse"}


def outcome_label(returnflag: Column, linestatus: Column) -> Column:
    expr = None
    for flag, label in OUTCOME_BY_FLAG.items():
        expr = F.when(returnflag == flag, label) if expr is None else expr.when(returnflag == flag, label)
    for status, label in OUTCOME_RETURNED.items():
        expr = expr.when((returnflag == "R") & (linestatus == status), label)
    return expr


@dataclass
class RoleViews:
    """Lazily built role views over one folder of test tables."""

    spark: SparkSession
    sf_dir: str
    namespace: str | None = None   # read catalog tables of this namespace instead of files
    _raw: dict = field(default_factory=dict)

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            if self.namespace is not None:
                self._raw[name] = self.spark.table(f"`{self.namespace}`.`{name}`")
            else:
                reader = self.spark.read
                if name in TEST_SCHEMAS:
                    reader = reader.schema(TEST_SCHEMAS[name])
                self._raw[name] = reader.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    # -- outcome ---------------------------------------------------------------------------
    def outcome(self) -> DataFrame:
        """One row per line item: who (order's customer), which indication (supplier), what
        happened and when.  (order_key, line_number) is lineage, not a unique key."""
        return self.outcome_from(self.raw("lineitem"))

    def outcome_from(self, li: DataFrame) -> DataFrame:
        """The outcome view over given line items - a batch or a stream of arriving ones (then
        the orders join is a stream-static join)."""
        od = self.raw("orders").select("o_orderkey", "o_custkey")
        return li.join(od, li.l_orderkey == od.o_orderkey, "inner").select(
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").cast("long").alias("line_number"),
            F.col("o_custkey").alias("person_id"),
            F.col("l_suppkey").alias("indication_id"),
            outcome_label(F.col("l_returnflag"), F.col("l_linestatus")).alias("outcome"),
            F.col("l_shipdate").cast("date").alias("outcome_date"),
        )

    def outcome_lines(self) -> DataFrame:
        """Outcome rows before the person is attached (no join): keyed by order."""
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").cast("long").alias("line_number"),
            F.col("l_suppkey").alias("indication_id"),
            outcome_label(F.col("l_returnflag"), F.col("l_linestatus")).alias("outcome"),
            F.col("l_shipdate").cast("date").alias("outcome_date"),
        )

    def order_person(self) -> DataFrame:
        return self.raw("orders").select(F.col("o_orderkey").alias("order_key"),
                                         F.col("o_custkey").alias("person_id"))

    def outcome_with(self, per_person: DataFrame, how: str = "inner",
                     cols: tuple[str, ...] = ("order_key", "line_number", "indication_id", "outcome",
                                              "outcome_date")) -> DataFrame:
        """Outcome rows carrying ``per_person`` columns (joined on person_id); same rows as
        ``outcome().join(per_person, "person_id", how)``.

        The person side meets the orders (a quarter of the line items) first, so line items are
        shuffled at most once, by the order key that defines the outcome view anyway.
        """
        keep = list(dict.fromkeys(["order_key", *cols]))
        orders = self.order_person().join(per_person, "person_id", how)
        out = self.outcome_lines().select(*keep).join(orders, "order_key", "inner")
        return out if "order_key" in cols else out.drop("order_key")

    # -- indication / profit ---------------------------------------------------------------
    def indication(self) -> DataFrame:
        s = self.raw("supplier")
        return s.select(
            F.col("s_suppkey").alias("indication_id"),
            F.col("s_nationkey").cast("long").alias("medicine_id"),
            (F.col("s_suppkey") % 5 + 1).alias("disease_id"),
            F.concat(F.lit("dose-"), F.col("s_suppkey").cast("string")).alias("dosage"),
        )

    def profit(self) -> DataFrame:
        s = self.raw("supplier")
        profit_cents, _ = money_from_double(F.col("s_acctbal"))
        cols = s.select(F.col("s_suppkey").alias("profit_id"), F.col("s_suppkey").alias("indication_id"),
                        profit_cents.alias("profit_cents"))
        cost_cents = F.abs(F.col("profit_cents"))
        return cols.select(
            "profit_id", "indication_id", "profit_cents", cost_cents.alias("cost_cents"),
            hundredths_to_money(cost_cents).alias("cost"),
            hundredths_to_money(cost_cents + F.col("profit_cents")).alias("price"),
            hundredths_to_money(F.col("profit_cents")).alias("profit"),
            hundredths_to_money(half_up_div(F.col("profit_cents") * 10000, cost_cents)).alias("percentage_profit"),
        )

    # -- medicine --------------------------------------------------------------------------
    def _nation_region(self) -> DataFrame:
        # nation and region have a fixed size at every scale (25 and 5 rows), so both the
        # region broadcast and the broadcast of the joined result are bounded.
        n, r = self.raw("nation"), self.raw("region")
        return F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "inner"))

    def medicine(self) -> DataFrame:
        """KPI medicine: one drug per nation, sold by the company named after its region."""
        return self._nation_region().select(
            F.col("n_nationkey").cast("long").alias("medicine_id"),
            F.concat(F.lit("SIN"), F.col("n_nationkey").cast("string")).alias("standard_industry_number"),
            F.col("n_name").alias("name"), F.col("r_name").alias("company"),
            F.col("n_name").alias("active_ingredient_name"))

    def medicine_part(self) -> DataFrame:
        """Competing-products medicine: parts, with brand as company and part name as ingredient."""
        return self.raw("part").select(
            F.col("p_partkey").alias("medicine_id"),
            F.concat(F.lit("SIN"), F.col("p_partkey").cast("string")).alias("standard_industry_number"),
            F.col("p_type").alias("name"), F.col("p_brand").alias("company"),
            F.col("p_name").alias("active_ingredient_name"))

    # -- person / location / condition -----------------------------------------------------
    def condition(self) -> DataFrame:
        """Distinct market segments, numbered by name (bounded: one row per segment)."""
        if "_condition" in self._raw:
            return self._raw["_condition"]
        seg = self.raw("customer").select(F.col("c_mktsegment").alias("disease_name")).distinct()
        seg = with_dense_id(seg, ["disease_name"], "disease_id", at_most=CONDITIONS)
        self._raw["_condition"] = seg.select(
            "disease_id", "disease_name",
            (F.col("disease_id") + 6).alias("intensity_level_qty"),
            F.concat(F.lit("DT0"), F.col("disease_id").cast("string")).alias("disease_type_code"))
        return self._raw["_condition"]

    def person(self, with_dates: bool = False) -> DataFrame:
        c = self.raw("customer")
        code = F.col("c_custkey") % 3
        cond = self.condition().select(F.col("disease_name").alias("_seg"), "disease_id")
        base = c.join(cond, c.c_mktsegment == cond._seg, "left").select(
            F.col("c_custkey").alias("person_id"),
            F.col("c_name").alias("last_name"),
            F.lower(F.col("c_mktsegment")).alias("first_name"),
            F.when(code == 0, "M").when(code == 1, "F").otherwise("X").alias("gender"),
            F.col("c_nationkey").cast("long").alias("primary_location_id"),
            (F.col("c_custkey") % 101).alias("age"),
            F.col("disease_id"),
            (F.col("c_nationkey") % 10 + 1).cast("long").alias("severity_value"),
            (F.col("c_acctbal") >= 0).alias("is_insured"),
        )
        if not with_dates:
            return base
        spans = self.raw("orders").groupBy(F.col("o_custkey").alias("_pid")).agg(
            F.min("o_orderdate").cast("date").alias("start_date"),
            F.max("o_orderdate").cast("date").alias("end_date"))
        return base.join(spans, base.person_id == spans._pid, "left").drop("_pid")

    def location(self) -> DataFrame:
        return self._nation_region().select(
            F.col("n_nationkey").cast("long").alias("location_id"),
            F.col("n_name").alias("city_name"), F.col("n_name").alias("state_province_name"),
            F.col("r_name").alias("country_name"),
            F.when(F.col("r_name").isin("AFRICA", "ASIA"), "Y").otherwise("N").alias("developing_flag"),
            (F.col("n_nationkey") % 10 + 1).cast("long").alias("wealth_rank_number"))

    # -- outcomes and indications of parts -----------------------------------------------
    def outcome_part(self) -> DataFrame:
        """Outcome rows whose indication is that of the part taken (competing products)."""
        return self.outcome_from(self.raw("lineitem").withColumn("l_suppkey", F.col("l_partkey")))

    def indication_part(self) -> DataFrame:
        """One indication for each part, of the part-based medicine table."""
        p = self.raw("part")
        return p.select(F.col("p_partkey").alias("indication_id"), F.col("p_partkey").alias("medicine_id"),
                        (F.col("p_partkey") % 5 + 1).alias("disease_id"),
                        F.concat(F.lit("dose-"), F.col("p_partkey").cast("string")).alias("dosage"))


def role_views(spark: SparkSession, sf_dir: str, namespace: str | None = None) -> RoleViews:
    """Role views over the Parquet files in ``sf_dir``, or over the catalog tables of
    ``namespace`` (see ``plans.jobs.store_colocated``)."""
    return RoleViews(spark, sf_dir, namespace)


def register_views(spark: SparkSession, sf_dir: str, competing: bool = False,
                   namespace: str | None = None) -> RoleViews:
    """Expose the role views as temp views named like the operational tables, for SQL users:
    ``outcome``, ``indication``, ``medicine``, ``profit``, ``diseased_patient``, ``location``,
    ``disease``.  ``competing=True`` exposes the part-based medicine table instead of the KPI one.
    Spark SQL over these views is planned exactly like the DataFrame jobs (same pruning and
    pushdown into the Parquet scans)."""
    v = role_views(spark, sf_dir, namespace)
    views = {"outcome": v.outcome(), "indication": v.indication(),
             "medicine": v.medicine_part() if competing else v.medicine(), "profit": v.profit(),
             "diseased_patient": v.person(with_dates=True), "location": v.location(), "disease": v.condition()}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return v
