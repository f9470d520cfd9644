"""Next-product transitions, model-based first choice and recommendation chains."""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.window import first_n_per_key
from martloom.ordering import histories, with_next
from martloom.session import materialise, sized, stage_path

EVENT_ORDER = ["payment_time", "order_id", "line_number", "product_id"]


def purchase_steps(sales: DataFrame) -> DataFrame:
    """Each purchase with the customer's next one; customers with very long histories span tasks."""
    return with_next(sales.select("customer_id", *EVENT_ORDER), ["customer_id"], EVENT_ORDER, ["product_id"])


def transitions(sales: DataFrame) -> DataFrame:
    """P(next | current) over consecutive purchases, repeats of the same product left out."""
    return _followed(purchase_steps(sales))


def _followed(steps: DataFrame) -> DataFrame:
    pairs = (
        steps.filter("next_product_id is not null and next_product_id <> product_id")
        .groupBy(F.col("product_id").alias("from_product"), F.col("next_product_id").alias("to_product"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = pairs.groupBy("from_product").agg(F.sum("n").alias("_all"))
    return pairs.join(totals, "from_product").withColumn("probability", F.col("n") / F.col("_all")).drop("_all")


def rec_chain(starts: DataFrame, trans: DataFrame, k: int = 5) -> DataFrame:
    """Chain of up to k products per start product, each the likeliest next one not yet in it.

    A chain holds fewer than k products when its next is chosen, so the best k continuations of
    a product always contain the answer; the step join is bounded by k rows per start.
    """
    best = first_n_per_key(trans, ["from_product"], [F.col("probability").desc(), "to_product"], k).select("from_product", "to_product", "probability")
    chains = starts.select("product_id").distinct().select(
        "product_id", F.array("product_id").alias("chain"), F.col("product_id").alias("_last")
    )
    for _ in range(k - 1):
        options = chains.join(best, F.col("_last") == F.col("from_product")).filter(~F.array_contains("chain", F.col("to_product")))
        chosen = options.groupBy(F.col("product_id").alias("_id")).agg(F.min(F.struct((-F.col("probability")).alias("p"), "to_product"))["to_product"].alias("_next"))
        chains = (
            chains.join(chosen, F.col("product_id") == F.col("_id"), "left")
            .select(
                "product_id",
                F.when(F.col("_next").isNotNull(), F.array_append("chain", F.col("_next"))).otherwise(F.col("chain")).alias("chain"),
                F.col("_next").alias("_last"),
            )
        )
    return chains.select("product_id", "chain", F.size("chain").alias("length"))


STATE = ["purchases", "spent", "span_days", "last_product"]
FEATURES = ["purchases", "mean_spent", "span_days", "chance", "popularity"]


def purchase_states(sales: DataFrame, amount: str) -> DataFrame:
    """One row for each purchase: the customer's history up to and including it, and the product bought next.

    `sales` has customer_id, the event order and `amount`. Histories are running sums over the ordered
    purchases, so a customer with very many of them spans tasks.
    """
    return _states(_histories(sales, amount))


def states_and_transitions(sales: DataFrame, amount: str) -> tuple[DataFrame, DataFrame]:
    """`purchase_states` and `transitions` of the same sales, which are put in order once for both."""
    ordered = _histories(sales, amount)
    return _states(ordered), materialise(_followed(ordered), "transitions")


def _histories(sales: DataFrame, amount: str) -> DataFrame:
    cents = F.round(F.coalesce(F.col(amount), F.lit(0.0)) * 100).cast("long")
    return histories(sales.select("customer_id", *EVENT_ORDER, cents.alias("_cents")), ["customer_id"], EVENT_ORDER, "purchases", "_cents", "_spent", "payment_time", "_begun", ["product_id"])


def _states(ordered: DataFrame) -> DataFrame:
    return ordered.filter("customer_id is not null").select(
        "customer_id", *EVENT_ORDER, "purchases", (F.col("_spent") / 100.0).alias("spent"),
        F.datediff("payment_time", "_begun").alias("span_days"), F.col("product_id").alias("last_product"), F.col("next_product_id").alias("next_product"),
    )


def candidates(states: DataFrame, trans: DataFrame, known: bool) -> DataFrame:
    """Every state with all products that ever followed its last one.

    With `known`, the state's own step is taken out of the counts it is judged by.
    """
    totals = trans.groupBy("from_product").agg(F.sum("n").alias("_all"))
    into = trans.groupBy(F.col("to_product").alias("_to")).agg(F.sum("n").alias("_popular"))
    edges = sized(trans.join(totals, "from_product").join(into, F.col("to_product") == F.col("_to")).select("from_product", "to_product", "n", "_all", "_popular"))
    pairs = states.join(edges, F.col("last_product") == F.col("from_product"))
    own = (F.col("to_product") == F.col("next_product")).cast("int") if known else F.lit(0)
    seen = F.lit(1 if known else 0)
    return pairs.select(
        "customer_id", F.col("to_product").alias("item"), own.cast("double").alias("label"), F.col("purchases").cast("double").alias("purchases"),
        (F.col("spent") / F.col("purchases")).alias("mean_spent"), F.col("span_days").cast("double").alias("span_days"),
        F.when(F.col("_all") > seen, (F.col("n") - own) / (F.col("_all") - seen)).otherwise(0.0).alias("chance"),
        F.log1p((F.col("_popular") - own).cast("double")).alias("popularity"),
    )


def learning_states(past: DataFrame, trans: DataFrame, pairs: int, seed: int) -> DataFrame:
    """States whose candidates number `pairs` at most (in expectation), chosen by a hash of the customer; all of them if they fit."""
    degree = trans.groupBy(F.col("from_product").alias("_p")).agg(F.count(F.lit(1)).alias("_d"))
    starts = past.groupBy("last_product").agg(F.count(F.lit(1)).alias("_n"))
    total = starts.join(degree, F.col("last_product") == F.col("_p")).agg(F.sum(F.col("_n") * F.col("_d"))).first()[0] or 0
    if total <= pairs:
        return past
    slots = 1 << 30
    return past.filter(F.pmod(F.xxhash64("customer_id", F.lit(seed)), F.lit(slots)) < int(slots * pairs / total))


def fit_forest(learn: DataFrame, trees: int, seed: int) -> tuple[RandomForestClassificationModel, dict[str, list[float]]]:
    """The forest, and for each feature every threshold at which it splits (at most trees x 31 in all)."""
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = RandomForestClassifier(numTrees=trees, maxDepth=5, seed=seed, probabilityCol="_votes", rawPredictionCol="_raw", predictionCol="_class").fit(assemble.transform(learn))
    # a reloaded forest carries no training summary, whose session cannot travel to the tasks
    saved = stage_path(learn.sparkSession, "forest")
    model.write().save(saved)
    cuts: dict[str, list[float]] = {name: [] for name in FEATURES}
    for tree in model.trees:
        for feature, cut in SPLIT.findall(tree.toDebugString):
            cuts[FEATURES[int(feature)]].append(float(cut))
    return RandomForestClassificationModel.load(saved), {name: sorted(set(found)) for name, found in cuts.items()}


# how a printed tree states its splits; the other branch repeats the same threshold
SPLIT = re.compile(r"If \(feature (\d+) <= ([^)]+)\)")
CELL = ["_purchases", "_mean_spent", "_span_days"]


def with_cells(states: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """For each feature of a state, the number of thresholds below it: the forest can't tell states of one cell apart."""
    values = {"purchases": F.col("purchases").cast("double"), "mean_spent": F.col("spent") / F.col("purchases"), "span_days": F.col("span_days").cast("double")}

    def place(name):
        value = values[name]
        return F.size(F.filter(F.array(*[F.lit(c) for c in cuts[name]]), lambda cut: cut < value)) if cuts[name] else F.lit(0)

    return states.withColumns({f"_{name}": place(name) for name in values})


def cell_choices(final: DataFrame, trans: DataFrame, model, cuts: dict[str, list[float]]) -> DataFrame:
    """last_product, the cell and its best next product: each cell seen is scored once with the product's successors.

    Customers come in only as the cells they stand in, so rows are bounded by cells x transitions.
    """
    placed = with_cells(final, cuts)
    # one state stands for its cell
    one = placed.groupBy("last_product", *CELL).agg(F.min(F.struct("purchases", "spent", "span_days")).alias("_s"))
    cells = materialise(one.withColumn("_cell", F.monotonically_increasing_id()), "forest-cells")
    stand_in = cells.select(F.col("_cell").alias("customer_id"), "_s.*", "last_product", F.lit(None).cast("long").alias("next_product"))
    score = materialise(candidates(stand_in, trans, False), "open-choices")
    if model is None:
        scored = score.withColumn("_w", F.lit(0.0))
    else:
        assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(score)
        scored = model.transform(assembled).withColumn("_w", vector_to_array("_votes")[1])
    best = F.struct(F.col("_w"), F.col("chance"), (-F.col("item")).alias("_i"))
    chosen = scored.groupBy(F.col("customer_id").alias("_chosen")).agg(F.max_by("item", best).alias("recommended_product"))
    return cells.join(chosen, F.col("_cell") == F.col("_chosen")).select("last_product", *CELL, "recommended_product")


def first_rec(states: DataFrame, trans: DataFrame, trees: int = 20, seed: int = 500, pairs: int = 2_000_000) -> DataFrame:
    """(customer_id, recommended_product): the likeliest next product of every customer, by a forest.

    The forest judges pairs of a customer and a product that has followed the customer's last one. It
    learns from customers' states before the final purchase (at most `pairs` labelled pairs), whether the
    candidate was that purchase, and scores the state after it; no product is out of reach. Customers
    between whom no threshold of the forest lies are scored together. A customer whose last product
    has never been followed by another gets null.
    """
    trans = materialise(trans, "transitions")
    final = states.filter("next_product is null")
    # the step before the final purchase; repeats of the same product are no transitions
    order = F.struct(*[F.col(c) for c in EVENT_ORDER])
    before = states.filter("next_product is not null").groupBy("customer_id").agg(F.max_by(F.struct(*STATE, "next_product"), order).alias("s"))
    past = materialise(before.select("customer_id", "s.*").filter("next_product <> last_product"), "known-states")
    learn = materialise(candidates(learning_states(past, trans, pairs, seed), trans, True), "known-choices")
    classes = {r[0] for r in learn.select("label").distinct().collect()}
    model, cuts = fit_forest(learn, trees, seed) if len(classes) == 2 else (None, {name: [] for name in FEATURES})
    chosen = sized(cell_choices(final, trans, model, cuts))
    return with_cells(final, cuts).join(chosen, ["last_product", *CELL], "left").select("customer_id", "recommended_product")


def product_recommendations(states: DataFrame, trans: DataFrame, k: int = 5) -> DataFrame:
    """customer_id, product_1 .. product_k: the first choice, then the likeliest chain from it."""
    first = materialise(first_rec(states, trans), "first-choices")
    chains = rec_chain(first.filter("recommended_product is not null").select(F.col("recommended_product").alias("product_id")), trans, k)
    joined = first.join(chains.select(F.col("product_id").alias("_p"), "chain"), F.col("recommended_product") == F.col("_p"), "left")
    return joined.select("customer_id", *[F.try_element_at("chain", F.lit(i + 1)).alias(f"product_{i + 1}") for i in range(k)])
