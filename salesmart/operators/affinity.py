"""Association rules between pairs of products that the same customers bought."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.expressions import exact_ratio
from salesmart.operators.gram import gram, pack_rows
from salesmart.schemas import RATIO
from salesmart.session import materialize

MIN_CUSTOMERS = 10
MIN_SUPPORT = "0.01"
MIN_CONFIDENCE = "0.2"
PREFIX = 256  # pairs of one prefix product that a task extends


def customer_basket(sales: DataFrame) -> DataFrame:
    """Distinct (customer, product name) pairs; sales of unnamed products are not in a basket.

    The long form of a customer × product 0/1 matrix. Repeats are combined before the shuffle.
    """
    return sales.where(F.col("product_name").isNotNull()).select("customer_id", "product_name").distinct()


def distinct_counts(sales: DataFrame) -> DataFrame:
    """Rows, exact number of customers and of products.

    Counting two columns distinctly expands every row twice, so the rows shrink to (customer, product) first.
    """
    pairs = sales.groupBy("customer_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("sales"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("product_id").alias("products"),
    )


def support_threshold(n_customers: int, min_support: str = MIN_SUPPORT, min_customers: int = MIN_CUSTOMERS) -> int:
    """Smallest customer count of a frequent set: ``min_support`` of all customers, at least ``min_customers``."""
    share = Fraction(min_support) * n_customers
    return max(min_customers, -(-share.numerator // share.denominator))


def item_support(basket: DataFrame) -> DataFrame:
    """Number of customers per product."""
    return basket.groupBy("product_name").agg(F.count(F.lit(1)).alias("customers"))


def number_items(items: DataFrame, key: str, name: str = "item") -> DataFrame:
    """Consecutive numbers from 0: a column index for the Gram matrix.

    Numbered inside hash buckets with offsets, so no task sorts the whole item list.
    """
    bucketed = items.withColumn("_bucket", F.pmod(F.hash(key), F.lit(256)))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        bucketed.withColumn("_local", local)
        .join(F.broadcast(offsets), "_bucket")  # at most 256 rows
        .withColumn(name, (F.col("_offset") + F.col("_local") - 1).cast("int"))
        .drop("_bucket", "_local", "_offset")
    )


def pair_support(basket: DataFrame, threshold: int) -> DataFrame:
    """Customers per unordered pair of frequent products (``product_a`` < ``product_b``), with the items' own counts.

    Only products that reach the threshold can be in a frequent pair, so the others leave the baskets first; at
    a support of one percent at most 100 × (mean basket size) products remain, however many customers there are.
    Pair counts come from the Gram matrix of the 0/1 baskets. A huge basket adds one row to its task's block product.
    """
    often = materialize(item_support(basket).where(F.col("customers") >= threshold))
    items = materialize(number_items(often, "product_name"))
    frequent = basket.join(items.select("product_name", "item"), "product_name").select("customer_id", "item")
    counts = gram(pack_rows(frequent, "customer_id", "item")).where((F.col("i") < F.col("j")) & (F.col("x") >= threshold))
    pairs = counts.select("i", "j", F.col("x").cast("bigint").alias("pair_customers"))

    def named(number: str, name: str, count: str) -> DataFrame:
        return items.select(F.col("item").alias(number), F.col("product_name").alias(name), F.col("customers").alias(count))

    both = pairs.join(named("i", "_p", "_cp"), "i").join(named("j", "_q", "_cq"), "j")
    ordered = F.col("_p") < F.col("_q")
    return both.select(
        F.when(ordered, F.col("_p")).otherwise(F.col("_q")).alias("product_a"),
        F.when(ordered, F.col("_q")).otherwise(F.col("_p")).alias("product_b"),
        F.when(ordered, F.col("_cp")).otherwise(F.col("_cq")).alias("customers_a"),
        F.when(ordered, F.col("_cq")).otherwise(F.col("_cp")).alias("customers_b"),
        "pair_customers",
    )


def rules_from_pairs(pairs: DataFrame, n_baskets: int, min_confidence: str = MIN_CONFIDENCE) -> DataFrame:
    """Both directions of every pair that reach the confidence, with support, confidence and lift.

    The cut compares integers, so an exact ratio such as 7 of 35 is on the right side.
    """
    left = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("product_a").alias("antecedent"), F.col("product_b").alias("consequent"),
                         F.col("customers_a").alias("n_ante"), F.col("customers_b").alias("n_cons")),
                F.struct(F.col("product_b").alias("antecedent"), F.col("product_a").alias("consequent"),
                         F.col("customers_b").alias("n_ante"), F.col("customers_a").alias("n_cons")),
            )
        ).alias("r"),
        "pair_customers",
    ).select("r.*", "pair_customers")
    cut = Fraction(min_confidence)
    kept = left.where(F.col("pair_customers") * cut.denominator >= F.col("n_ante") * cut.numerator)
    pair, n = F.col("pair_customers"), F.lit(n_baskets).cast("decimal(12,0)")
    wide = [F.col(c).cast("decimal(12,0)") for c in ("pair_customers", "n_ante", "n_cons")]
    return kept.select(
        "antecedent",
        "consequent",
        exact_ratio(pair, F.lit(n_baskets)).cast(RATIO).alias("support"),
        exact_ratio(pair, F.col("n_ante")).cast(RATIO).alias("confidence"),
        exact_ratio(wide[0] * n, wide[1] * wide[2]).cast(RATIO).alias("lift"),
    )


def association_rules(
    sales: DataFrame, min_support: str | None = None, min_confidence: str = MIN_CONFIDENCE
) -> DataFrame:
    """Rules product → product. Without ``min_support`` the threshold is 1 % of all customers, at least ten.

    The facts are read once: their distinct (customer, product name) pairs give the customer count, which
    includes buyers of unnamed products only, and the baskets, which do not.
    """
    bought = materialize(sales.select("customer_id", "product_name").distinct())
    named = F.when(F.col("product_name").isNotNull(), F.col("customer_id"))
    n_customers, n_baskets = bought.agg(F.count_distinct("customer_id"), F.count_distinct(named)).first()
    if min_support is None:
        threshold = support_threshold(n_customers)
    else:
        threshold = support_threshold(n_baskets, min_support, 1)
    basket = bought.where(F.col("product_name").isNotNull())  # distinct already
    return rules_from_pairs(pair_support(basket, threshold), n_baskets, min_confidence)


def _customer_bitmaps(frequent: DataFrame) -> DataFrame:
    """(product_name, bucket, bits): each product's customers as bitmaps of 32,768 ids."""
    return frequent.groupBy("product_name", F.bitmap_bucket_number("customer_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("bits"))


def triple_support(basket: DataFrame, pairs: DataFrame, threshold: int) -> DataFrame:
    """Customers per frequent set of three products (``product_a`` < ``product_b`` < ``product_c``).

    Vertical mining by prefix: a task gets one prefix product and one range of customers, with the bitmaps of the
    products that form frequent pairs with it. It intersects each pair's bitmap with those of all later partners and
    emits counts only. A prefix is as large as it has partners, 4 KB each; a popular one is split by customers and, where
    it has more than PREFIX pairs to extend, by these.
    """
    bitmaps = materialize(_customer_bitmaps(basket.where("customer_id is not null")))
    partners = pairs.select(F.col("product_a").alias("a"), F.col("product_b").alias("product_name"))
    place = Window.partitionBy("a").orderBy("product_name")
    partners = partners.withColumn("place", F.row_number().over(place) - 1)
    sizes = partners.groupBy("a").agg(F.ceil(F.count("*") / PREFIX).cast("int").alias("shares"))
    own = bitmaps.select(F.col("product_name").alias("a"), "bucket", F.col("bits").alias("own"))
    held = (
        partners.join(sizes, "a").join(bitmaps, "product_name").join(own, ["a", "bucket"])
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
        # A share extends its own pairs, by partners that come later: earlier ones need not travel to it.
        .where(F.floor(F.col("place") / PREFIX) >= F.col("share"))
    )

    def intersect(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("product_name", ignore_index=True)
        names, share = group["product_name"].to_numpy(object), group["share"].iloc[0]
        width = len(group["bits"].iloc[0]) // 8
        bits = np.frombuffer(b"".join(group["bits"]), np.uint64).reshape(-1, width)
        pair = bits & np.frombuffer(group["own"].iloc[0], np.uint64)
        one, two, counts = [], [], []
        for i in np.flatnonzero(group["place"].to_numpy() // PREFIX == share):
            n = np.bitwise_count(pair[i] & bits[i + 1:]).sum(axis=1, dtype=np.int64)
            some = np.flatnonzero(n)
            one += [names[i]] * len(some)
            two += names[i + 1:][some].tolist()
            counts += n[some].tolist()
        as_objects = lambda texts: pd.Series(texts, dtype=object)
        return pd.DataFrame({"product_a": as_objects([group["a"].iloc[0]] * len(one)), "product_b": as_objects(one),
                             "product_c": as_objects(two), "customers": pd.Series(counts, dtype="int64")})

    counts = held.groupBy("a", "bucket", "share").applyInPandas(
        intersect, "product_a string, product_b string, product_c string, customers long")
    return counts.groupBy("product_a", "product_b", "product_c").agg(F.sum("customers").alias("customers")).where(
        F.col("customers") >= threshold)


def two_item_rules(sales: DataFrame, min_support: str = MIN_SUPPORT, min_confidence: str = MIN_CONFIDENCE) -> DataFrame:
    """Rules {product, product} → product, in the measures of ``association_rules``; sets of three are the longest mined.

    A customer without an id is no basket. The threshold is ``min_support`` of all customers, at least ten.
    """
    bought = materialize(sales.where("customer_id is not null").select("customer_id", "product_name").distinct())
    named = F.when(F.col("product_name").isNotNull(), F.col("customer_id"))
    n_customers, n_baskets = bought.agg(F.count_distinct("customer_id"), F.count_distinct(named)).first()
    threshold = support_threshold(n_customers, min_support)
    basket = bought.where(F.col("product_name").isNotNull())
    often = materialize(item_support(basket).where(F.col("customers") >= threshold))
    frequent = basket.join(often.select("product_name"), "product_name")
    pairs = materialize(pair_support(basket, threshold))
    triples = triple_support(frequent, pairs, threshold)
    a, b, c = F.col("product_a"), F.col("product_b"), F.col("product_c")
    rule = lambda x, y, z: F.struct(x.alias("antecedent_a"), y.alias("antecedent_b"), z.alias("consequent"))
    rules = triples.select(F.explode(F.array(rule(a, b, c), rule(a, c, b), rule(b, c, a))).alias("r"), "customers").select("r.*", "customers")
    both = pairs.select(F.col("product_a").alias("antecedent_a"), F.col("product_b").alias("antecedent_b"), "pair_customers")
    single = often.select(F.col("product_name").alias("consequent"), F.col("customers").alias("n_cons"))
    cut, n = Fraction(min_confidence), F.lit(n_baskets).cast("decimal(12,0)")
    kept = rules.join(both, ["antecedent_a", "antecedent_b"]).where(
        F.col("customers") * cut.denominator >= F.col("pair_customers") * cut.numerator).join(single, "consequent")
    whole = [F.col(name).cast("decimal(12,0)") for name in ("customers", "pair_customers", "n_cons")]
    return kept.select(
        "antecedent_a", "antecedent_b", "consequent",
        exact_ratio(F.col("customers"), F.lit(n_baskets)).cast(RATIO).alias("support"),
        exact_ratio(F.col("customers"), F.col("pair_customers")).cast(RATIO).alias("confidence"),
        exact_ratio(whole[0] * n, whole[1] * whole[2]).cast(RATIO).alias("lift"))


def top_rules(rules: DataFrame, n: int | None = None) -> DataFrame:
    """Rules by lift, strongest first."""
    ranked = rules.orderBy(F.desc("lift"), "antecedent", "consequent")
    return ranked if n is None else ranked.limit(n)


def fpgrowth_rules(sales: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """The same rules through MLlib's FP-growth, which also mines larger sets; only single items are kept.

    MLlib has no length limit, so a low support explodes: use it for high supports, or where longer sets matter.
    """
    from pyspark.ml.fpm import FPGrowth

    baskets = customer_basket(sales).groupBy("customer_id").agg(F.collect_list("product_name").alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    single = model.associationRules.where((F.size("antecedent") == 1) & (F.size("consequent") == 1))
    return single.select(
        F.col("antecedent")[0].alias("antecedent"),
        F.col("consequent")[0].alias("consequent"),
        *[F.round(name, 4).cast(RATIO).alias(name) for name in ("support", "confidence", "lift")],
    )
