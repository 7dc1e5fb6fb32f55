"""Customer and country profiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duescope.config import PanelConfig
from duescope.functions import columns as C
from duescope.operators.ordered import exact_quantiles
from duescope.sources.lineitems import CLEARED
from duescope.storage import stored


def _rate(condition: Column) -> Column:
    """Share of rows where the condition holds; unknown counts as not."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def company_codes(items: DataFrame, countries: list[str], by_country: bool = False) -> DataFrame:
    """Company codes of the countries: rows, customers and first and last baseline."""
    keys = ["country", "company_code"] if by_country else ["company_code"]
    chosen = items.withColumn("country", C.country_of_code(F.col("company_code"))).filter(
        F.col("country").isin([c.upper() for c in countries]))
    return chosen.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.count_distinct("customer_id").alias("customers"),
        F.min("baseline_date").alias("first_baseline"),
        F.max("baseline_date").alias("last_baseline"))


@dataclass(frozen=True)
class Statistic:
    """One number per customer: a rule over a column of the facts of one kind.

    Rules: rows, sum, mean, max, hits (facts where the column is true) or a quantile. `empty`
    is the value for customers without a fact of the kind.
    """

    name: str
    kind: str
    rule: str | float
    of: str | None = None
    empty: float | None = None

    def column(self) -> Column:
        mine = F.col("kind") == self.kind
        value = F.when(mine, F.col(self.of)) if self.of else F.lit(None)
        if isinstance(self.rule, float):
            made = F.percentile_approx(value, self.rule, QUANTILE_ACCURACY)
        else:
            made = {"rows": F.count_if(mine), "hits": F.count_if(value.cast("boolean")), "sum": F.sum(value),
                    "mean": F.avg(value), "max": F.max(value)}[self.rule]
        return (made if self.empty is None else F.coalesce(made, F.lit(self.empty))).alias(self.name)


QUANTILE_ACCURACY = 100_000  # quantiles are at most 1 / this share of a customer's facts off
INVOICE, LETTER, PROMISE = "invoice", "letter", "promise"
STATISTICS = (
    Statistic("cust_n_invoices", INVOICE, "rows"),
    Statistic("cust_total_exposure", INVOICE, "sum", "amount"),
    Statistic("cust_avg_invoice_amt", INVOICE, "mean", "amount"),
    Statistic("cust_med_invoice_amt", INVOICE, 0.5, "amount"),
    Statistic("cust_mean_dpd", INVOICE, "mean", "dpd"),
    Statistic("cust_p90_dpd", INVOICE, 0.9, "dpd"),
    Statistic("cust_on_time_ratio", INVOICE, "mean", "on_time"),
    Statistic("cust_cleared_ratio", INVOICE, "mean", "is_cleared"),
    Statistic("cust_dunning_events", LETTER, "rows"),
    Statistic("cust_max_dunning_level", LETTER, "max", "level", 0),
    Statistic("cust_avg_dunning_level", LETTER, "mean", "level", 0.0),
    Statistic("cust_dunning_escalations", LETTER, "hits", "severe"),
    Statistic("cust_promises", PROMISE, "hits", "settled"),
    Statistic("cust_kept", PROMISE, "hits", "kept"),
    Statistic("cust_broken", PROMISE, "hits", "broken"),
    Statistic("cust_promised_total", PROMISE, "sum", "promised", 0.0),
)


def _summary(facts: DataFrame, *kinds: str) -> DataFrame:
    return facts.groupBy("customer_id").agg(*[s.column() for s in STATISTICS if s.kind in kinds])


def _invoice_facts(items: DataFrame) -> DataFrame:
    rolled = items.groupBy("customer_id", "invoice_id").agg(
        F.sum("invoice_amount").alias("amount"), F.min("due_date").alias("due"),
        F.max("clearing_date").alias("cleared"), F.max("days_past_due").alias("dpd"),
        F.max((F.col("source") == CLEARED).cast("int")).alias("is_cleared"))
    return rolled.select(
        "customer_id", F.lit(INVOICE).alias("kind"), "amount", "dpd", "is_cleared",
        C.paid_on_time(F.col("is_cleared"), F.col("cleared"), F.col("due")).alias("on_time"))


def _letter_facts(letters: DataFrame, cfg: PanelConfig) -> DataFrame:
    if cfg.lookback_days is not None:
        letters = letters.filter(F.col("dunning_date") >= F.date_sub(F.lit(cfg.anchor), cfg.lookback_days))
    return letters.select("customer_id", F.lit(LETTER).alias("kind"), F.col("dunning_level").alias("level"),
                          (F.col("dunning_level") >= 2).alias("severe"))


def _promise_facts(promises: DataFrame) -> DataFrame:
    state = F.col("promise_state")
    return promises.select("customer_id", F.lit(PROMISE).alias("kind"), F.col("promised_amount").alias("promised"),
                           state.isin(1, 3).alias("settled"), (state == 3).alias("kept"), (state == 1).alias("broken"))


def dunning_per_customer(letters: DataFrame, cfg: PanelConfig) -> DataFrame:
    return _summary(_letter_facts(letters, cfg), LETTER)


def promises_per_customer(promises: DataFrame) -> DataFrame:
    return _summary(_promise_facts(promises), PROMISE)


def customer_profile(items: DataFrame) -> DataFrame:
    """Invoice behaviour per customer from source-tagged line items."""
    return _summary(_invoice_facts(items), INVOICE)


def customer_features(items: DataFrame, letters: DataFrame, promises: DataFrame,
                      master: DataFrame, cfg: PanelConfig) -> DataFrame:
    """All statistics and master data of the customers that have an invoice and a country.

    Invoices, letters and promises become one table of facts, summed up in one aggregation:
    one shuffle, combined before it, instead of a join per kind of event.
    """
    facts = _invoice_facts(items)
    for more in (_letter_facts(letters, cfg), _promise_facts(promises)):
        facts = facts.unionByName(more, allowMissingColumns=True)
    known = _summary(facts, INVOICE, LETTER, PROMISE).filter(F.col("cust_n_invoices") > 0)
    return known.join(master.filter(F.col("country").isNotNull()), "customer_id")


def customer_profile_from_view(view: DataFrame, category: str = "region") -> DataFrame:
    """Invoice then customer grain from the unified view."""
    invoice = view.groupBy("country", "customer_id", "invoice_id").agg(
        F.max("days_past_due").alias("dpd"), F.min("due_date").alias("due"),
        F.max("clearing_date").alias("cleared"),
        F.max((F.col("source") == CLEARED).cast("int")).alias("is_cleared"),
        F.max("dunning_count").alias("letters"), F.max("fin_p2p_state").alias("state"),
        F.sum("open_amount").alias("open_amount"), F.max("credit_limit").alias("credit_limit"),
        F.min(category).alias("category"))
    on_time = C.paid_on_time(F.col("is_cleared"), F.col("cleared"), F.col("due"))
    return invoice.groupBy("country", "customer_id").agg(
        F.avg("dpd").alias("cust_mean_dpd"), F.avg(on_time).alias("cust_on_time_ratio"),
        F.coalesce(F.sum("letters"), F.lit(0)).alias("cust_dunning_events"),
        F.count_if(F.col("state") == 3).alias("cust_kept"),
        F.count_if(F.col("state").isin(1, 3)).alias("cust_promises"),
        F.sum("open_amount").alias("cust_outstanding"),
        F.max("credit_limit").alias("cust_credit_limit"), F.min("category").alias("category"))


# The statistics that make up a country's behaviour vector in the profile.
COUNTRY_STATS = (
    "dpd_mean", "dpd_median", "dpd_p90", "dpd_std", "on_time_rate", "late_rate",
    "dunning_level_mean", "dunning_count_mean", "dunning_escalation_rate", "p2p_keep_rate",
    "p2p_usage_rate", "invoice_amt_mean", "invoice_amt_median", "invoice_amt_std",
    "open_amt_mean", "dispute_count_mean", "dispute_rate", "credit_limit_mean",
    "tenure_days_mean", "payment_terms_mean")


def country_profile(view: DataFrame, min_invoices: int = 50) -> DataFrame:
    """Behaviour statistics per country over the lines of the view.

    Customers are counted apart from the rest: beside a distinct count every other aggregate, quantile
    sketches too, would be kept for each customer first.
    """
    means = {
        "dpd_mean": "days_past_due", "dunning_level_mean": "dunning_level",
        "dunning_count_mean": "dunning_count", "invoice_amt_mean": "invoice_amount",
        "open_amt_mean": "open_amount", "dispute_count_mean": "number_of_disputes",
        "credit_limit_mean": "credit_limit", "tenure_days_mean": "customer_tenure_days",
        "payment_terms_mean": "net_payment_days"}
    rates = {
        "late_rate": F.col("days_past_due") > 0,
        "on_time_rate": F.col("clearing_date") <= F.col("due_date"),
        "dunning_escalation_rate": F.col("dunning_level") >= 2,
        "p2p_usage_rate": F.col("fin_promised_amt").isNotNull(),
        "dispute_rate": F.col("dispute_create_date").isNotNull()}
    quantiles = {"dpd_median": ("days_past_due", 0.5), "dpd_p90": ("days_past_due", 0.9),
                 "invoice_amt_median": ("invoice_amount", 0.5)}
    spreads = {"dpd_std": "days_past_due", "invoice_amt_std": "invoice_amount"}
    read = {"country", "customer_id", "fin_p2p_state", "clearing_date", "due_date", "fin_promised_amt", "dispute_create_date", *means.values()}
    view = stored(view.select(*[c for c in view.columns if c in read]))
    known = view.select("country", "customer_id").distinct().groupBy(F.col("country").alias("_c")).agg(F.count("customer_id").alias("n_customers"))
    found = view.groupBy("country").agg(
        F.count("*").alias("n_invoices"),
        F.avg(C.kept_flag(F.col("fin_p2p_state"))).alias("p2p_keep_rate"),
        *[F.avg(c).alias(n) for n, c in means.items()],
        *[_rate(c).alias(n) for n, c in rates.items()],
        *[F.percentile_approx(c, q, QUANTILE_ACCURACY).alias(n) for n, (c, q) in quantiles.items()],
        *[F.stddev_samp(c).alias(n) for n, c in spreads.items()])
    rest = [c for c in found.columns if c not in ("country", "n_invoices")]
    out = found.join(known, F.col("country").eqNullSafe(F.col("_c"))).select("country", "n_invoices", "n_customers", *rest)
    return out.withColumn("low_confidence", (F.col("n_invoices") < min_invoices).cast("int"))


def country_fingerprint(panel: DataFrame) -> DataFrame:
    """Panel rows to customers (equal weight each), then to countries; nulls become 0.

    The columns this reads of the panel are stored, so that it is computed once and without the others.
    """
    means = {"c_dpd": "avg_dpd", "c_on_time": "on_time_ratio", "c_pay_days": "avg_days_to_pay",
             "c_keep": "kept_ratio", "c_size": "avg_invoice_size",
             "c_collected": "collection_ratio", "c_risk": "target"}
    ever = {"c_dunned": "total_dunning_events", "c_severe": "high_severity_dunning",
            "c_active": "promise_activity_flag", "c_disputed": "number_of_disputes"}
    panel = stored(panel.select("country", "customer_id", *means.values(), *ever.values()))
    customers = panel.groupBy("country", "customer_id").agg(
        *[F.avg(c).alias(n) for n, c in means.items()],
        *[F.max((F.col(c) > 0).cast("int")).alias(n) for n, c in ever.items()])
    outputs = {
        "mean_dpd": "c_dpd", "on_time_rate": "c_on_time", "mean_days_to_pay": "c_pay_days",
        "dunning_rate": "c_dunned", "high_dunning_rate": "c_severe", "p2p_keep_rate": "c_keep",
        "p2p_activity_rate": "c_active", "dispute_rate": "c_disputed",
        "collection_ratio_mean": "c_collected", "high_risk_rate": "c_risk"}
    base = customers.groupBy("country").agg(
        F.count("*").alias("n_customers"), *[F.avg(c).alias(n) for n, c in outputs.items()])
    late = exact_quantiles(customers, ["country"], "c_dpd", {"p90_dpd": 0.9})
    size = exact_quantiles(customers, ["country"], "c_size", {"median_invoice_size": 0.5})
    return base.join(late, "country", "left").join(size, "country", "left").na.fill(0)


def corrected_skewness(value: Column, n: Column) -> Column:
    """Bias-corrected sample skewness; 0 for fewer than three values or no spread."""
    factor = F.sqrt(n * (n - 1)) / (n - 2)
    return F.coalesce(F.when(n > 2, F.skewness(value) * factor), F.lit(0.0))


def country_vector(customers: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Eighteen behaviour statistics per country from customer features.

    `keys` may hold more than the country, e.g. a resample number.
    """
    keys = keys or ["country"]
    n = F.count("*")
    promised = F.greatest(F.sum("cust_promises"), F.lit(1))
    base = customers.groupBy(*keys).agg(
        n.alias("n_customers"),
        F.avg("cust_mean_dpd").alias("mean_dpd"), F.avg("cust_p90_dpd").alias("p90_dpd"),
        F.coalesce(F.stddev_samp("cust_mean_dpd"), F.lit(0.0)).alias("std_dpd"),
        F.avg("cust_on_time_ratio").alias("on_time_ratio"),
        F.avg("cust_cleared_ratio").alias("cleared_ratio"),
        _rate(F.col("cust_dunning_events") > 0).alias("dunning_rate"),
        F.avg("cust_avg_dunning_level").alias("avg_dunning_level"),
        _rate(F.col("cust_dunning_escalations") > 0).alias("escalation_rate"),
        _rate(F.col("cust_promises") > 0).alias("p2p_usage_rate"),
        (F.sum("cust_kept") / promised).alias("p2p_keep_ratio"),
        (F.sum("cust_promised_total") / promised).alias("p2p_avg_amt"),
        F.avg("cust_total_exposure").alias("exposure_mean"),
        corrected_skewness(F.greatest("cust_total_exposure", F.lit(0.0)), n)
        .alias("exposure_skew"),
        F.avg("cust_avg_invoice_amt").alias("invoice_amt_mean"),
        F.avg("cust_med_invoice_amt").alias("invoice_amt_median"),
        F.avg("cust_n_invoices").alias("invoices_per_cust"))
    medians = exact_quantiles(customers, keys, "cust_mean_dpd", {"median_dpd": 0.5}).join(
        exact_quantiles(customers, keys, "cust_total_exposure", {"exposure_median": 0.5}), keys)
    return base.join(medians, keys, "left").na.fill(0)


def country_vector_small(customers: DataFrame) -> DataFrame:
    """The five-statistic variant over customers profiled from the view."""
    n = F.count("*")
    return customers.groupBy("country").agg(
        n.alias("n_customers"), F.avg("cust_mean_dpd").alias("mean_dpd"),
        F.avg("cust_on_time_ratio").alias("on_time_ratio"),
        _rate(F.col("cust_dunning_events") > 0).alias("dunning_rate"),
        (F.sum("cust_kept") / F.greatest(F.sum("cust_promises"), F.lit(1)))
        .alias("p2p_keep_ratio"),
        corrected_skewness(F.greatest("cust_outstanding", F.lit(0.0)), n)
        .alias("exposure_skew")).na.fill(0)


def category_mix(customers: DataFrame, category: str, keys: list[str] | None = None,
                 levels: int | None = None) -> DataFrame:
    """Share of customers per country and level, all levels or the `levels` most frequent of all.

    Long form (keys, level, share) with zeros for absent levels; null is the level UNK. With
    `levels`, all others are summed up as OTHER, so the shares of a country always add up to one.
    """
    keys = keys or ["country"]
    named = customers.withColumn("level", F.coalesce(category, F.lit("UNK")))
    counts = named.groupBy(*keys, "level").agg(F.count("*").alias("n"))
    ranked = counts.groupBy("level").agg(F.sum("n").alias("n"))
    if levels is not None:
        top = ranked.orderBy(F.desc("n"), "level").limit(levels).agg(F.collect_list("level")).scalar()
        kept = F.when(F.array_contains(top, F.col("level")), F.col("level")).otherwise("OTHER")
        counts = counts.withColumn("level", kept).groupBy(*keys, "level").agg(F.sum("n").alias("n"))
        ranked = counts.select("level").distinct()
    sizes = counts.groupBy(*keys).agg(F.sum("n").alias("_size"))
    axis = sizes.withColumn("level", F.explode(ranked.agg(F.array_sort(F.collect_set("level"))).scalar()))
    return axis.join(counts, [*keys, "level"], "left").select(
        *keys, "level", (F.coalesce("n", F.lit(0)) / F.col("_size")).alias("share"))


def mix_features(customers: DataFrame, category: str, keys: list[str] | None = None, levels: int = 8) -> DataFrame:
    """(keys, level, share): the share of a country's customers in each of the `levels` most
    frequent levels, zero where it has none; null is the level UNK, equal counts go by name.

    Further keys, such as a resample number, rank their levels by themselves. Unlike
    `category_mix`, the rest is left out, so shares add up to one only if there is none.
    """
    keys = keys or ["country"]
    apart = [k for k in keys if k != "country"]
    counts = stored(customers.withColumn("level", F.coalesce(category, F.lit("UNK"))).groupBy(*keys, "level").agg(F.count("*").alias("n")))
    order = Window.partitionBy(*apart, "_all").orderBy(F.desc("_total"), "level")
    top = (
        counts.groupBy(*apart, "level").agg(F.sum("n").alias("_total")).withColumn("_all", F.lit(0))
        .withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= levels).select("_all", *apart, "level"))
    sizes = counts.groupBy(*keys).agg(F.sum("n").alias("_size")).withColumn("_all", F.lit(0))
    return sizes.join(top, ["_all", *apart]).join(counts, [*keys, "level"], "left").select(
        *keys, "level", (F.coalesce("n", F.lit(0)) / F.col("_size")).alias("share"))


def behaviour_long(vector: DataFrame, mix: DataFrame | None = None,
                   keys: list[str] | None = None) -> DataFrame:
    """(keys, feature, value) of all statistics except the customer count."""
    keys = keys or ["country"]
    stats = [c for c in vector.columns if c not in (*keys, "n_customers", "n_invoices",
                                                    "low_confidence")]
    wide = vector.select(*keys, *[F.col(c).cast("double").alias(c) for c in stats])
    long = wide.unpivot(keys, stats, "feature", "value")
    if mix is None:
        return long
    return long.unionByName(mix.select(
        *keys, F.concat(F.lit("mix_"), "level").alias("feature"), F.col("share").alias("value")))


def members(df: DataFrame, cluster: str = "cluster", group: str = "country") -> DataFrame:
    """Sorted group list per cluster, as text."""
    return df.groupBy(cluster).agg(
        F.array_join(F.array_sort(F.collect_set(group)), ",").alias("members"),
        F.count_distinct(group).alias("n_members"))


def training_volume(panel: DataFrame, clusters: DataFrame, small: int = 200) -> DataFrame:
    """Rows and positives per country with its cluster; small countries flagged."""
    counts = panel.groupBy("country").agg(
        F.count("*").alias("n"), F.count_if(F.col("target") == 1).alias("positives"))
    return counts.join(clusters, "country", "left").withColumn(
        "is_small", (F.col("n") < small).cast("int"))


def leaderboard(vector: DataFrame, statistic: str, limit: int = 20) -> DataFrame:
    return vector.select("country", statistic).orderBy(F.desc(statistic), "country").limit(limit)


def latest_per_customer(panel: DataFrame, columns: list[str]) -> DataFrame:
    """Last snapshot of each customer; merges before the shuffle instead of sorting."""
    row = F.struct("snapshot_date", *columns)
    return panel.groupBy("customer_id").agg(F.max(row).alias("_r")).select("customer_id", "_r.*")
