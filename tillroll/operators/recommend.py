"""Recommendations for a table of requests, answered together.

Requests have `request_id`, `segment_code`, `product_code`, `min_lift` and `max_results`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll import fixed_values as fixed
from tillroll.functions.numbers import round_ratio
from tillroll.operators.basket import RULE_COLUMNS, small
from tillroll.operators.serving import Marts
from tillroll.sources.stage import materialise

REQUEST_COLUMNS = ["request_id", "segment_code", "product_code", "min_lift", "max_results"]
_RULE_FIELDS = [name for name in RULE_COLUMNS if name not in ("leverage", "conviction")]
ANSWER_COLUMNS = ["request_id", "position", *_RULE_FIELDS, "strategy", "reason", "data_basis", "source_type"]
_METRICS = ["support", "confidence", "lift", "rank_score"]

# A prediction needs this confidence, and this share of all baskets but at least two.
MIN_PREDICTION_CONFIDENCE = 0.25
MIN_PREDICTION_SHARE = 0.002


def request(spark, product: str, segment: str = "ALL", min_lift: float = 1.05, max_results: int = 10) -> DataFrame:
    """Request table with one request."""
    return spark.range(1).select(
        F.lit("1").alias("request_id"),
        F.lit(segment).alias("segment_code"),
        F.lit(product).alias("product_code"),
        F.lit(float(min_lift)).alias("min_lift"),
        F.lit(max_results).alias("max_results"),
    )


def _reason(form: str, confidence: Column, lift: Column, coverage: Column) -> Column:
    """Text with confidence in per cent to one decimal and lift to two."""
    head, rest = form.split("{confidence}")
    middle, rest = rest.split("{lift}")
    after, tail = rest.split("{coverage}")
    return F.concat(
        F.lit(head),
        F.format_string("%.1f", round_ratio(confidence * 100, 1)),
        F.lit(middle),
        F.format_string("%.2f", round_ratio(lift, 2)),
        F.lit(after),
        coverage.cast("string"),
        F.lit(tail),
    )


def check_requests(requests: DataFrame) -> None:
    """Refuse requests whose answers would be wrong or ambiguous."""
    c = F.col
    bad = {
        "a request has no id": c("request_id").isNull(),
        "a request names no product": F.trim(F.coalesce("product_code", F.lit(""))) == "",
        "min_lift is below zero or absent": ~F.coalesce(c("min_lift") >= 0, F.lit(False)),
        "max_results is not between 1 and 50": ~F.coalesce(c("max_results").between(1, 50), F.lit(False)),
    }
    found = requests.agg(*[F.count_if(condition).alias(text) for text, condition in bad.items()]).first()
    problems = [text for text in bad if found[text]]
    if not requests.groupBy("request_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        problems.append("request ids repeat")
    if problems:
        raise ValueError("; ".join(problems))


def match_rules(rules: DataFrame, requests: DataFrame, source: str) -> DataFrame:
    """Rules of each request's scope with the product in the antecedent, best rank first."""
    c = F.col
    numeric = {name: c(name).cast("double") for name in _METRICS}
    by_product = rules.withColumns(numeric).select(
        "*", F.explode(F.array_distinct(F.split("antecedent_codes", r"\|"))).alias("product_code")
    )
    found = requests.select(*REQUEST_COLUMNS).join(by_product, ["segment_code", "product_code"])
    best = Window.partitionBy("request_id").orderBy(F.desc("rank_score"), "rule_id")
    numbered = found.filter(c("lift") >= c("min_lift")).withColumn("position", F.row_number().over(best).cast("bigint"))
    kept = numbered.filter(c("position") <= c("max_results"))
    strategy = F.when(c("lift") >= 2, fixed.STRATEGY_BUNDLE).otherwise(fixed.STRATEGY_CROSS_SELL)
    reason = _reason(fixed.RULE_REASON, c("confidence"), c("lift"), c("coverage_basket_count"))
    return kept.withColumns(
        {
            "strategy": strategy,
            "reason": reason,
            "data_basis": F.lit(fixed.BASIS_RULES),
            "source_type": F.lit(source),
        }
    ).select(*ANSWER_COLUMNS)


def scenario_contents(lines: DataFrame, scopes: DataFrame) -> DataFrame:
    """(scope, invoice_no, goods): the distinct (stock_code, product_name) of each invoice in the scopes that are asked for.

    Lines are shuffled once, by invoice; an invoice is then dealt out to all customers and to its segments.
    """
    c = F.col
    place = F.struct("stock_code", "product_name", "source_segment_code")
    held = lines.groupBy("invoice_no").agg(F.collect_set(place).alias("held"))
    own = F.array_distinct(F.array_compact(F.concat(F.array(F.lit(fixed.ALL_SCOPE)), "held.source_segment_code")))
    dealt = held.select(F.explode(own).alias("scope"), "invoice_no", "held").join(scopes, "scope", "left_semi")
    part = F.when(c("scope") == fixed.ALL_SCOPE, c("held")).otherwise(
        F.filter("held", lambda at: at["source_segment_code"] == c("scope"))
    )
    goods = F.transform(part, lambda at: F.struct(at["stock_code"].alias("stock_code"), at["product_name"].alias("product_name")))
    return dealt.select("scope", "invoice_no", F.array_distinct(goods).alias("goods"))


def companions(
    lines: DataFrame, requests: DataFrame, min_confidence: float = MIN_PREDICTION_CONFIDENCE, width: int = 256
) -> DataFrame:
    """Products that share generated baskets with each request's product.

    One aggregate over (scope, product, companion) limited to the requested products serves all
    requests. Pairs are met inside the row of a basket and counted before they are shuffled; a basket of over `width`
    products is joined with itself, so that its pairs need not come from one row. Companions that pass the limits are ranked by frequency.
    """
    c = F.col
    wanted = requests.select(c("segment_code").alias("scope"), c("product_code").alias("anchor")).distinct()
    wanted = small(materialise(wanted, "wanted-products"))
    content = materialise(scenario_contents(lines, wanted.select("scope").distinct()), "scope-contents")
    totals = content.groupBy("scope").agg(F.count("invoice_no").alias("total"))
    each = content.select("scope", F.inline("goods"))
    coverage = each.groupBy("scope", "stock_code", "product_name").agg(F.count("*").alias("baskets"))
    codes = F.explode(F.array_distinct("goods.stock_code")).alias("anchor")
    anchors = content.select("scope", "invoice_no", codes, "goods").join(wanted, ["scope", "anchor"], "left_semi")
    anchor_counts = anchors.groupBy("scope", "anchor").agg(F.count("*").alias("anchor_baskets"))
    met = anchors.filter(c("invoice_no").isNotNull() & (F.size("goods") <= width)).select("scope", "anchor", F.inline("goods"))
    wide = content.filter(F.size("goods") > width)
    asked = wide.select("scope", "invoice_no", codes).join(wanted, ["scope", "anchor"], "left_semi")
    crossed = asked.join(wide.select("scope", "invoice_no", F.inline("goods")), ["scope", "invoice_no"]).drop("invoice_no")
    together = met.unionByName(crossed).filter(c("stock_code") != c("anchor"))
    pairs = together.groupBy("scope", "anchor", "stock_code", "product_name").agg(F.count("*").alias("pair_baskets"))
    # Names are made distinct first, which combines before the shuffle without a sort of the lines.
    names = lines.select("stock_code", "product_name").distinct()
    names = names.groupBy(c("stock_code").alias("anchor")).agg(F.max("product_name").alias("anchor_name"))

    counted = (
        pairs.join(coverage, ["scope", "stock_code", "product_name"])
        .join(anchor_counts, ["scope", "anchor"])
        .join(totals, "scope")
        .join(names, "anchor")
    )
    return predictions(counted, requests, min_confidence)


def least_pairs(total: Column) -> Column:
    """Baskets that a companion must share with its anchor in a scope of `total` baskets."""
    return F.greatest(F.lit(2), F.ceil(total * MIN_PREDICTION_SHARE))


def predictions(counted: DataFrame, requests: DataFrame, min_confidence: float = MIN_PREDICTION_CONFIDENCE) -> DataFrame:
    """Answers from counted companions, one row per (scope, anchor, stock_code, product_name) as the index has them."""
    c = F.col
    asked = requests.select("*", c("segment_code").alias("scope"), c("product_code").alias("anchor"))
    frequent = Window.partitionBy("request_id").orderBy(F.desc("pair_baskets"), "stock_code", "product_name")
    confidence, support = c("pair_baskets") / c("anchor_baskets"), c("pair_baskets") / c("total")
    measured = asked.join(counted, ["scope", "anchor"]).withColumns(
        {"_confidence": confidence, "_lift": confidence / (c("baskets") / c("total"))}
    )
    strong = measured.filter(
        (c("_lift") >= c("min_lift"))
        & (c("_confidence") >= min_confidence)
        & (c("pair_baskets") >= least_pairs(c("total")))
    )
    numbered = strong.withColumn("position", F.row_number().over(frequent)).filter(c("position") <= c("max_results"))
    identifier = F.concat(F.lit("MODEL:"), "scope", F.lit(":"), "anchor", F.lit(">"), "stock_code")
    return numbered.select(
        "request_id",
        c("position").cast("bigint").alias("position"),
        F.substring(F.sha1(identifier), 1, 16).alias("rule_id"),
        c("scope").alias("segment_code"),
        F.lit(fixed.PREDICTED_SCOPE_NAME).alias("segment_name"),
        c("anchor").alias("antecedent_codes"),
        F.coalesce("anchor_name", "anchor").alias("antecedent_names"),
        c("stock_code").alias("consequent_codes"),
        c("product_name").alias("consequent_names"),
        round_ratio(support, 6).alias("support"),
        round_ratio(c("_confidence"), 6).alias("confidence"),
        round_ratio(c("_lift"), 6).alias("lift"),
        c("pair_baskets").alias("coverage_basket_count"),
        c("total").alias("scope_basket_count"),
        round_ratio(c("_confidence") * c("_lift") * F.log1p("pair_baskets"), 6).alias("rank_score"),
        F.lit(fixed.STRATEGY_PREDICTED).alias("strategy"),
        _reason(fixed.PREDICTION_REASON, c("_confidence"), c("_lift"), c("pair_baskets")).alias("reason"),
        F.lit(fixed.SOURCE_PREDICTION).alias("data_basis"),
        F.lit(fixed.SOURCE_PREDICTION).alias("source_type"),
    ).select(*ANSWER_COLUMNS)


def recommend(
    marts: Marts, requests: DataFrame, min_prediction_confidence: float = MIN_PREDICTION_CONFIDENCE
) -> DataFrame:
    """Answers in order of preference: segment rules, rules of all customers, predictions for the
    segment, predictions for all customers. The first source with an answer serves the request.

    Requests that ask the same are answered once and their answers joined back to the request ids. Predictions come from
    the mart `companion_index` where there is one, else from the generated lines.
    """
    check_requests(requests)
    asked = [name for name in REQUEST_COLUMNS if name != "request_id"]
    requests = materialise(requests.select("request_id", *asked), "requests")
    questions = requests.select(*asked).distinct().withColumn("request_id", F.md5(F.to_json(F.struct(*asked))))
    questions = materialise(questions, "questions")
    all_scope = F.lit(fixed.ALL_SCOPE)
    narrow = questions.filter(F.coalesce(F.col("segment_code") != all_scope, F.lit(True)))
    widened = narrow.withColumn("segment_code", all_scope)
    rules, lines, index = (marts.get(name) for name in ("association_rule", "synthetic_transaction", "companion_index"))

    own = match_rules(rules, questions, fixed.SOURCE_SEGMENT_RULE).withColumn("_source", F.lit(1))
    fallback = match_rules(rules, widened, fixed.SOURCE_GLOBAL_RULE).withColumn("_source", F.lit(2))
    ruled = materialise(own.unionByName(fallback), "answers-rules")
    answers = ruled
    if lines is not None or index is not None:
        rest = materialise(questions.join(ruled.select("request_id"), "request_id", "left_anti"), "open-questions")
        wider = rest.filter(F.coalesce(F.col("segment_code") != all_scope, F.lit(True))).withColumn("segment_code", all_scope)
        both = rest.withColumn("_source", F.lit(3)).unionByName(wider.withColumn("_source", F.lit(4)))
        # One pass over the lines serves both scopes of a question, told apart by a suffix of its id.
        both = both.withColumn("request_id", F.concat_ws("/", "request_id", "_source"))
        both = both.drop("_source")
        if index is not None:
            predicted = predictions(index, small(materialise(both, "index-questions")), min_prediction_confidence)
        else:
            predicted = companions(lines, both, min_prediction_confidence)
        parts = F.split("request_id", "/")
        predicted = predicted.withColumns({"_source": parts[1].cast("int"), "request_id": parts[0]})
        answers = materialise(ruled.unionByName(predicted), "answers")
    first = answers.groupBy("request_id").agg(F.min("_source").alias("_source"))
    chosen = answers.join(first, ["request_id", "_source"]).drop("_source")
    keyed = requests.select("request_id", F.md5(F.to_json(F.struct(*asked))).alias("_question"))
    return keyed.join(chosen.withColumnRenamed("request_id", "_question"), "_question").select(*ANSWER_COLUMNS)
