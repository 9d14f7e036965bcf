"""Monthly totals, seller ranking, incentive and the two marts.

Plan choices (all declarative; Catalyst/AQE pick the physical operators):

* Totals are a ``groupBy`` on the window key: partial aggregation runs before
  the shuffle, so a key holding a third of the rows costs one row per map
  task, not a third of the data in one reducer. The job this replaces used a
  window ``sum`` plus ``distinct`` (kept as ``period_total_window`` for
  comparison): one more sort, and the whole group in one task.
* Dimension attributes (names, address) are attached *after* aggregation,
  from the distinct attribute rows of the dimension, so only keys travel
  through the fact-sized shuffle. Totals are summed over the fanned-out
  enriched rows first, which keeps the original semantics when a dimension
  key is duplicated (each copy's attributes get the doubled total).
* The leader of a (store, month) is found with a grouped ``max`` joined back,
  not a ranking window: the max table is one row per group (AQE broadcasts
  it once measured), and the join splits a hot group across tasks.
  ``rank() = 1`` is equivalent: all tied leaders qualify, NULL totals sort
  last, and an all-NULL group's leaders get a NULL incentive.

Two families of the same marts:

* over a flat fact (one row per sale with its store, as a CSV drop gives it):
  ``customer_mart`` / ``sales_mart``, and ``*_from`` totals, as the batch job
  uses them;
* over an order/line fact (``*_hl``), where the join order follows the
  fact's size: the customer check on the orders, one line-sized join, and
  for the sales mart a per-(seller, month) aggregate that meets one
  dimension-sized seller table (store, name, key fan-out).

"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.contracts import CUSTOMER_MART, SALES_TEAM_MART
from martflow.functions.columns import full_name, month_key, rate_of
from martflow.operators import ranking
from martflow.operators.enrich import DimSpec, join_dim, star_join

def as_contract(df: DataFrame, contract) -> DataFrame:
    """The contract's columns, in order, cast to its types (money is
    decimal(18,2): a total that does not fit fails the cast under ANSI)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])


# The incentive paid to each (store, month) leader.
INCENTIVE_RATE = "0.01"
INCENTIVE_PLACES = 2


def with_month(df: DataFrame, date_col: str = "sales_date", out: str = "sales_month") -> DataFrame:
    return df.withColumn(out, month_key(date_col))


def period_total(df: DataFrame, keys: list[str], amount: str = "total_cost",
                 out: str = "total_sales") -> DataFrame:
    """sum(amount) per key; NULL amounts are ignored, an all-NULL group is NULL."""
    return df.groupBy(*keys).agg(F.sum(amount).alias(out))


def attach(totals: DataFrame, attrs: DataFrame, key: str, attr_key: str) -> DataFrame:
    """Totals x distinct attribute rows of their key (inner)."""
    a = attrs.distinct()
    return totals.join(a, totals[key] == a[attr_key], "inner").drop(a[attr_key])


def group_leaders(totals: DataFrame, group: list[str], value: str = "total_sales",
                  out: str = "leader_total") -> DataFrame:
    return totals.groupBy(*group).agg(F.max(value).alias(out))


def is_leader(value: str = "total_sales", top: str = "leader_total") -> Column:
    """rank() = 1 under ORDER BY value DESC NULLS LAST, from the group max."""
    return (F.col(value) == F.col(top)) | F.col(top).isNull()


def with_leader(totals: DataFrame, group: list[str], value: str = "total_sales") -> DataFrame:
    """Each row with its group's max (``leader_total``); NULL group keys are a
    group of their own, as in a window, so the join is null-safe."""
    leaders = group_leaders(totals, group, value)
    leaders = leaders.select(*[F.col(g).alias(f"__g_{g}") for g in group], "leader_total")
    cond = [totals[g].eqNullSafe(leaders[f"__g_{g}"]) for g in group]
    return totals.join(leaders, cond, "inner").drop(*[f"__g_{g}" for g in group])


def top_incentive(totals: DataFrame, group: list[str], value: str = "total_sales",
                  rate: str = INCENTIVE_RATE, places: int = INCENTIVE_PLACES,
                  out: str = "incentive") -> DataFrame:
    """Leaders of each group get round(value * rate, places); others 0."""
    pay = F.when(is_leader(value), rate_of(value, rate, places)).otherwise(F.lit(0))
    return (with_leader(totals, group, value)
            .withColumn(out, pay.cast(totals.schema[value].dataType))
            .drop("leader_total"))


def top_sellers(totals: DataFrame, group: list[str], value: str = "total_sales") -> DataFrame:
    """Top-1-with-ties per group (rank() <= 1), via the grouped max."""
    return with_leader(totals, group, value).where(is_leader(value)).drop("leader_total")


def top_k(totals: DataFrame, group: list[str], k: int, value: str = "total_sales", out: str = "rnk") -> DataFrame:
    """The rows of rank() <= k in their group, with their rank: ties at the
    k-th value all stay, null values come last. A filter on the rank lets every
    task keep only its own rows up to rank k before the shuffle, so a hot group
    sends k rows (and ties) a task."""
    if k < 1:
        raise ValueError("k must be at least 1")
    return rank_window(totals, group, value, out).where(F.col(out) <= k)


def rank_window(totals: DataFrame, group: list[str], value: str = "total_sales",
                out: str = "rnk") -> DataFrame:
    """rank() over (group ORDER BY value DESC NULLS LAST), the plain window."""
    w = Window.partitionBy(*group).orderBy(F.col(value).desc_nulls_last())
    return totals.withColumn(out, F.rank().over(w))


def rank_within(totals: DataFrame, group: list[str], value: str = "total_sales",
                out: str = "rnk") -> DataFrame:
    """The same rank, from the counts of the distinct values (see ``ranking``)."""
    return ranking.rank_within(totals, group, value, out)


def rank_spread(totals: DataFrame, group: list[str], value: str = "total_sales",
                out: str = "rnk") -> DataFrame:
    """The same rank over range partitions, for hot groups (see ``ranking``)."""
    return ranking.rank_spread(totals, group, value, out)


# --------------------------------------------------------------------------
# The marts, over a contract fact and contract dimensions.
# --------------------------------------------------------------------------

def key_specs(customer: DataFrame, store: DataFrame, team: DataFrame) -> list[DimSpec]:
    """Key-only dimension joins (existence + fan-out); attributes come later.

    Order: the seller (same key as the fact's own seller lookup), the store
    (tiny), then the customer.
    """
    return [
        DimSpec("team", team, "sales_person_id", "id"),
        DimSpec("store", store, "store_id", "id"),
        DimSpec("customer", customer, "customer_id", "customer_id"),
    ]


def enriched_keys(fact: DataFrame, customer: DataFrame, store: DataFrame,
                  team: DataFrame) -> DataFrame:
    return star_join(fact, key_specs(customer, store, team))


def customer_month_totals(enriched: DataFrame) -> DataFrame:
    return period_total(with_month(enriched, out="sales_date_month"),
                        ["customer_id", "sales_date_month"])


def sales_month_totals(enriched: DataFrame) -> DataFrame:
    return period_total(with_month(enriched), ["store_id", "sales_person_id", "sales_month"])


def customer_attributes(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("customer_id").alias("attr_customer_id"),
                           full_name("first_name", "last_name").alias("full_name"),
                           "address", "phone_number")


def seller_attributes(team: DataFrame) -> DataFrame:
    return team.select(F.col("id").alias("attr_seller_id"),
                       full_name("first_name", "last_name").alias("full_name"))


def customer_mart_from(totals: DataFrame, customer: DataFrame) -> DataFrame:
    """The customer mart of (customer, month) totals."""
    return as_contract(attach(totals, customer_attributes(customer), "customer_id",
                              "attr_customer_id"), CUSTOMER_MART)


def sales_mart_from(totals: DataFrame, team: DataFrame) -> DataFrame:
    """The sales-team mart of (store, seller, month) totals."""
    paid = top_incentive(totals, ["store_id", "sales_month"])
    return as_contract(attach(paid, seller_attributes(team), "sales_person_id",
                              "attr_seller_id"), SALES_TEAM_MART)


def customer_mart(fact: DataFrame, customer: DataFrame, store: DataFrame,
                  team: DataFrame) -> DataFrame:
    """customer_id, full_name, address, phone_number, sales_date_month, total_sales."""
    return customer_mart_from(customer_month_totals(enriched_keys(fact, customer, store, team)),
                              customer)


def sales_mart(fact: DataFrame, customer: DataFrame, store: DataFrame,
               team: DataFrame) -> DataFrame:
    """store_id, sales_person_id, full_name, sales_month, total_sales, incentive."""
    return sales_mart_from(sales_month_totals(enriched_keys(fact, customer, store, team)), team)


def _window_total(totals: DataFrame, keys: list[str], amount: str, out: str) -> DataFrame:
    """sum(sum(amount)) over keys, one row per key: a window over rows that are
    already totalled, so no fact row enters it."""
    w = Window.partitionBy(*keys)
    return totals.withColumn(out, F.sum(amount).over(w)).select(*keys, out).distinct()


def dealt(df: DataFrame, keys: list[str], tasks: int | None) -> DataFrame:
    """df dealt by keys to that many tasks (None: as Spark does, by bytes of a
    shuffle, which are few for many short rows)."""
    return df if tasks is None else df.repartition(tasks, *keys)


def customer_totals_window(enriched: DataFrame, tasks: int | None = None) -> DataFrame:
    """customer_month_totals by a window: totals per (customer, month, seller)
    summed over each (customer, month). tasks: see ``dealt``; one shuffle by
    (customer, month) serves the totals, the window and the distinct rows."""
    e = dealt(with_month(enriched, out="sales_date_month"), ["customer_id", "sales_date_month"], tasks)
    part = period_total(e, ["customer_id", "sales_date_month", "sales_person_id"], out="part")
    return _window_total(part, ["customer_id", "sales_date_month"], "part", "total_sales")


def sales_totals_window(enriched: DataFrame, tasks: int | None = None) -> DataFrame:
    """sales_month_totals by a window: totals per (store, seller, day) summed
    over each (store, seller, month). tasks: see ``dealt``."""
    keys = ["store_id", "sales_person_id", "sales_month"]
    part = period_total(dealt(with_month(enriched), keys, tasks), [*keys, "sales_date"], out="part")
    return _window_total(part, keys, "part", "total_sales")


def customer_mart_window(enriched: DataFrame, customer: DataFrame, tasks: int | None = None) -> DataFrame:
    """The customer mart with its totals from a window, for comparison."""
    return as_contract(attach(customer_totals_window(enriched, tasks), customer_attributes(customer),
                              "customer_id", "attr_customer_id"), CUSTOMER_MART)


def sales_mart_window(enriched: DataFrame, team: DataFrame, tasks: int | None = None) -> DataFrame:
    """The sales-team mart with totals and rank from windows, for comparison:
    rank 1 of each (store, month) gets the incentive."""
    ranked = rank_window(sales_totals_window(enriched, tasks), ["store_id", "sales_month"])
    pay = F.when(F.col("rnk") == 1, rate_of("total_sales", INCENTIVE_RATE, INCENTIVE_PLACES))
    paid = ranked.withColumn("incentive", pay.otherwise(F.lit(0)))
    return as_contract(attach(paid, seller_attributes(team), "sales_person_id", "attr_seller_id"),
                       SALES_TEAM_MART)


def customer_detail(enriched: DataFrame) -> DataFrame:
    """The customer detail mart: 8 columns per enriched row."""
    return enriched.select("customer_id",
                           F.col("customer_first_name").alias("first_name"),
                           F.col("customer_last_name").alias("last_name"),
                           F.col("customer_address").alias("address"),
                           F.col("customer_pincode").alias("pincode"),
                           F.col("customer_phone_number").alias("phone_number"),
                           "sales_date", "total_cost")


def sales_detail(enriched: DataFrame) -> DataFrame:
    """The sales detail mart: 12 columns per enriched row, with sales_month."""
    return enriched.select("store_id", "sales_person_id", "sales_person_first_name",
                           "sales_person_last_name", "store_manager_name", "manager_id",
                           "is_manager", "sales_person_address", "sales_person_pincode",
                           "sales_date", "total_cost",
                           F.expr("substring(sales_date, 1, 7)").alias("sales_month"))


def full_specs(customer: DataFrame, store: DataFrame, team: DataFrame) -> list[DimSpec]:
    """Attribute-carrying joins for the detail marts (unique, prefixed names)."""
    return [
        DimSpec("team", team, "sales_person_id", "id", {
            "sales_person_first_name": "first_name", "sales_person_last_name": "last_name",
            "manager_id": "manager_id", "is_manager": "is_manager",
            "sales_person_address": "address", "sales_person_pincode": "pincode"}),
        DimSpec("store", store, "store_id", "id", {"store_manager_name": "store_manager_name"}),
        DimSpec("customer", customer, "customer_id", "customer_id", {
            "customer_first_name": "first_name", "customer_last_name": "last_name",
            "customer_address": "address", "customer_pincode": "pincode",
            "customer_phone_number": "phone_number"}),
    ]


def star_enrich(fact: DataFrame, customer: DataFrame, store: DataFrame,
                team: DataFrame) -> DataFrame:
    return star_join(fact, full_specs(customer, store, team))


def manager_rollup(fact: DataFrame, team: DataFrame) -> DataFrame:
    """Sales rolled up to each seller's manager (the team's self-reference).

    Sellers are totalled first (partial aggregation: one row per seller per
    map task), then joined to the team; re-summing after the join keeps the
    fan-out of a duplicated team key. members = distinct sellers with sales.
    """
    per_seller = period_total(fact, ["sales_person_id"], out="seller_total")
    t = team.select(F.col("id").alias("__team_id"), "manager_id")
    return (per_seller.join(t, per_seller.sales_person_id == t["__team_id"], "inner")
            .groupBy("manager_id")
            .agg(F.sum("seller_total").alias("team_total"),
                 F.countDistinct("sales_person_id").alias("members")))


# --------------------------------------------------------------------------
# The same marts over a header/line fact (orders + order lines), where the
# seller's store is an attribute of the seller.
#
# The join order is chosen for the fact's size, not the dimensions':
# * the customer check runs on the headers (one row per order, a fraction of
#   the lines), and the lines meet the checked headers in the one join that
#   shuffles line-sized data;
# * the sales mart is aggregated per (seller, month) before the seller and
#   store lookups, which then see one row per seller and month instead of one
#   per line. Totals are summed again after those joins, so a duplicated
#   seller or store key multiplies the total exactly as a join of every line
#   would (sum is decomposable).
# --------------------------------------------------------------------------

def _keys(df: DataFrame, key: str, alias: str) -> DataFrame:
    return df.select(F.col(key).alias(alias))


def checked_headers(headers: DataFrame, customer: DataFrame,
                    month_col: str = "sales_month") -> DataFrame:
    """Headers whose customer exists (key-only inner join), with their month."""
    h = join_dim(headers, DimSpec("customer", customer, "customer_id", "customer_id"))
    return h.select("order_id", "customer_id", month_key("sales_date").alias(month_col))


def valid_sellers(team: DataFrame, store: DataFrame) -> DataFrame:
    """Seller id -> store id, for sellers whose store exists (dimension-sized)."""
    t = team.select(F.col("id").alias("seller_id"), "store_id")
    return join_dim(t, DimSpec("store", store, "store_id", "id"))


def sales_totals_hl(headers: DataFrame, items: DataFrame, customer: DataFrame,
                    store: DataFrame, team: DataFrame) -> DataFrame:
    """store_id, sales_person_id, sales_month, total_sales."""
    h = checked_headers(headers, customer)
    lines = items.select("order_id", "sales_person_id", "total_cost").join(h, "order_id")
    per_seller = period_total(lines, ["sales_person_id", "sales_month"], out="seller_total")
    sellers = valid_sellers(team, store)
    joined = join_dim(per_seller, DimSpec("seller", sellers, "sales_person_id", "seller_id",
                                          {"store_id": "store_id"}))
    return period_total(joined, ["store_id", "sales_person_id", "sales_month"],
                        amount="seller_total")


def seller_copies(team: DataFrame, store: DataFrame) -> DataFrame:
    """seller_id, copies: the (team row, store row) pairs that a line of that
    seller joins, i.e. how often an inner join would repeat its amount."""
    return (valid_sellers(team, store).groupBy("seller_id")
            .agg(F.count(F.lit(1)).alias("copies")))


def customer_totals_hl(headers: DataFrame, items: DataFrame, customer: DataFrame,
                       store: DataFrame, team: DataFrame) -> DataFrame:
    """customer_id, sales_date_month, total_sales.

    The lines meet their orders once and are totalled per (customer, seller,
    month); the sellers' copies join that aggregate, which is summed again.
    """
    h = checked_headers(headers, customer, "sales_date_month")
    lines = items.select("order_id", "sales_person_id", "total_cost").join(h, "order_id")
    per_seller = period_total(lines, ["customer_id", "sales_person_id", "sales_date_month"],
                              out="seller_total")
    checked = join_dim(per_seller, DimSpec("seller", seller_copies(team, store), "sales_person_id",
                                           "seller_id", {"copies": "copies"}))
    amount = checked.withColumn("seller_total", F.col("seller_total") * F.col("copies"))
    return period_total(amount, ["customer_id", "sales_date_month"], amount="seller_total")


def seller_info(team: DataFrame, store: DataFrame) -> DataFrame:
    """seller_id, store_id, full_name, copies (dimension-sized).

    One row per distinct (seller, store, name); ``copies`` is how many
    (team row, store row) pairs join a line of that seller and store, i.e.
    the factor by which joining every line would multiply its amount.
    """
    t = join_dim(team.select(F.col("id").alias("seller_id"), "store_id",
                             full_name("first_name", "last_name").alias("full_name")),
                 DimSpec("store", store, "store_id", "id"))
    per_name = t.groupBy("seller_id", "store_id", "full_name").agg(F.count(F.lit(1)).alias("n"))
    # a seller's copies across its names: a window over one seller's few rows
    return per_name.withColumn(
        "copies", F.sum("n").over(Window.partitionBy("seller_id", "store_id"))).drop("n")


def sales_mart_hl(headers: DataFrame, items: DataFrame, customer: DataFrame,
                  store: DataFrame, team: DataFrame) -> DataFrame:
    """The sales-team mart: per-(seller, month) totals meet the seller table
    once, which brings the store, the names and the key fan-out together."""
    h = checked_headers(headers, customer)
    lines = items.select("order_id", "sales_person_id", "total_cost").join(h, "order_id")
    per_seller = period_total(lines, ["sales_person_id", "sales_month"], out="seller_total")
    info = seller_info(team, store)
    named = join_dim(per_seller, DimSpec("seller", info, "sales_person_id", "seller_id",
                                         {"store_id": "store_id", "full_name": "full_name",
                                          "copies": "copies"}))
    totals = named.withColumn("total_sales", F.col("seller_total") * F.col("copies"))
    paid = top_incentive(totals, ["store_id", "sales_month"])
    return as_contract(paid, SALES_TEAM_MART)


def customer_mart_hl(headers: DataFrame, items: DataFrame, customer: DataFrame,
                     store: DataFrame, team: DataFrame) -> DataFrame:
    totals = customer_totals_hl(headers, items, customer, store, team)
    return as_contract(attach(totals, customer_attributes(customer), "customer_id",
                              "attr_customer_id"), CUSTOMER_MART)


def star_enrich_hl(headers: DataFrame, items: DataFrame, customer: DataFrame,
                   store: DataFrame, team: DataFrame) -> DataFrame:
    """Every line with its customer, seller and store attributes (inner
    joins, the names of ``full_specs``).

    Customer attributes join the headers (order-sized); the seller and its
    store are joined to each other first (dimension-sized), so the lines meet
    one seller-keyed join and one order-keyed join.
    """
    cust = [s for s in full_specs(customer, store, team) if s.name == "customer"][0]
    h = join_dim(headers, cust)
    sellers = join_dim(
        team.select(F.col("id").alias("seller_id"), "store_id",
                    F.col("first_name").alias("sales_person_first_name"),
                    F.col("last_name").alias("sales_person_last_name"),
                    "manager_id", "is_manager",
                    F.col("address").alias("sales_person_address"),
                    F.col("pincode").alias("sales_person_pincode")),
        DimSpec("store", store, "store_id", "id", {"store_manager_name": "store_manager_name"}))
    seller_cols = [c for c in sellers.columns if c != "seller_id"]
    lines = items.join(h, "order_id")
    return join_dim(lines, DimSpec("seller", sellers, "sales_person_id", "seller_id",
                                   {c: c for c in seller_cols}))


def seller_months_hl(headers: DataFrame, items: DataFrame, customer: DataFrame,
                     store: DataFrame, team: DataFrame) -> DataFrame:
    """The distinct (store, seller, name, month) of the enriched lines: the
    distinct (seller, month) pairs first, then the seller table."""
    h = checked_headers(headers, customer)
    pairs = (items.select("order_id", "sales_person_id").join(h, "order_id")
             .select("sales_person_id", "sales_month").distinct())
    named = join_dim(pairs, DimSpec("seller", seller_info(team, store), "sales_person_id", "seller_id",
                                    {"store_id": "store_id", "full_name": "full_name"}))
    return named.select("store_id", "sales_person_id", "full_name", "sales_month").distinct()
