from __future__ import annotations

import datetime as dt
import hashlib
import itertools
import math
import random
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from tests.conftest import rows
from tillroll.config import BasketConfig
from tillroll.operators import basket
from tillroll.plans.registry import _items
from tillroll.sources.stage import materialise

CFG = BasketConfig(global_min_support=0.2, min_confidence=0.5, min_lift=0.9, max_itemset_length=2)


def itemsets_of(lines, scopes, cfg, width=512):
    """Itemsets per scope as {tuple of codes: count}, through the library's own steps."""
    products = materialise(basket.scope_products(lines, basket.scope_sizes(lines, scopes), cfg), "products")
    baskets = materialise(basket.scope_baskets(lines, products), "baskets")
    found = basket.itemsets(baskets, basket.basket_sizes(baskets, scopes), cfg, width)
    named = basket.named_itemsets(found, basket.product_catalog(baskets, products))
    result = defaultdict(dict)
    for r in named.collect():
        result[r.scope][tuple(r.codes.split("|"))] = r.support_count
    return result


def frequent(items, cfg, width=512):
    lines = materialise(basket.scoped_lines(items, None, cfg), "lines")
    return itemsets_of(lines, basket.scope_table(items, None, cfg), cfg, width)["ALL"]


def brute_itemsets(content, cfg):
    """Frequent itemsets by listing all subsets of all baskets."""
    content = [set(c) for c in content if len(set(c)) >= cfg.min_basket_size]
    coverage = Counter(code for codes in content for code in codes)
    needed = max(2, math.ceil(len(content) * cfg.global_min_support))
    kept = {code for code, _ in sorted(((k, n) for k, n in coverage.items() if n >= needed), key=lambda p: (-p[1], p[0]))[: cfg.max_products]}
    content = [codes & kept for codes in content if len(codes & kept) >= 2]
    if len(content) < 2:
        return {}
    counts = Counter(
        subset
        for codes in content
        for size in range(1, cfg.max_itemset_length + 1)
        for subset in itertools.combinations(sorted(codes), size)
    )
    return {s: n for s, n in counts.items() if n >= math.ceil(len(content) * cfg.global_min_support)}


def to_items(make_items, content):
    return make_items(
        [(f"I{n:03d}", f"C{n % 5}", dt.datetime(2021, 1, 1), code, code.lower(), 1, 1) for n, codes in enumerate(content) for code in codes]
    )


def test_frequent_pair_becomes_a_rule(basket_items):
    found = basket.mine(basket_items, cfg=CFG).collect()
    rules = {(r.antecedent_codes, r.consequent_codes): r for r in found}
    rule = rules["P", "Q"]
    assert (rule.coverage_basket_count, rule.scope_basket_count, rule.antecedent_names) == (5, 8, "Item P")
    assert rule.confidence == pytest.approx(5 / 7, abs=1e-6)
    assert rule.rule_id == hashlib.sha1(b"ALL:P>Q").hexdigest()[:16]
    # Q always comes with P, so the conviction is infinite and left empty.
    assert rules["Q", "P"].confidence == 1.0 and rules["Q", "P"].conviction is None


def test_metrics_follow_their_definitions(basket_items):
    for r in basket.mine(basket_items, cfg=replace(CFG, min_confidence=0.01, min_lift=0.0)).collect():
        left, right = r.support / r.confidence, r.confidence / r.lift
        assert r.leverage == pytest.approx(r.support - left * right, abs=1e-5)
        if r.conviction is not None:
            assert r.conviction == pytest.approx((1 - right) / (1 - r.confidence), abs=1e-4)
        assert r.rank_score == pytest.approx(r.lift * r.confidence * math.log1p(r.coverage_basket_count), abs=1e-4)
        assert r.support == pytest.approx(r.coverage_basket_count / r.scope_basket_count, abs=1e-6)


def random_contents(seed, datasets):
    """Random baskets over codes of which none is a service code."""
    rng = random.Random(seed)
    pools = [["A", "B", "C", "E", "F", "G", "H"][: rng.randint(2, 7)] for _ in range(datasets)]
    return [[rng.sample(pool, rng.randint(1, len(pool))) for _ in range(rng.randint(1, 18))] for pool in pools]


@pytest.mark.parametrize(("length", "products"), [(3, 500), (4, 4), (1, 500)])
def test_itemsets_equal_brute_force(spark, length, products):
    """Many small datasets at once, each as a scope of its own with its own support."""
    contents = random_contents(length * 1000 + products, 30)
    supports = [random.Random(n).choice([0.1, 0.25, 0.4]) for n in range(len(contents))]
    cfg = BasketConfig(max_itemset_length=length, max_products=products)
    data = [(f"D{n}", f"I{b}", f"C{b}", code, code) for n, baskets in enumerate(contents) for b, codes in enumerate(baskets) for code in codes]
    raw = spark.createDataFrame(data, "scope string, invoice_no string, customer_id string, stock_code string, product_name string")
    lines = materialise(basket.prepare(raw, 2, ("scope", "invoice_no")), "lines")
    table = [(f"D{n}", support) for n, support in enumerate(supports)]
    scopes = spark.createDataFrame(table, "scope string, min_support double")
    found = itemsets_of(lines, scopes, cfg)
    for n, (content, support) in enumerate(zip(contents, supports, strict=True)):
        assert found.get(f"D{n}", {}) == brute_itemsets(content, replace(cfg, global_min_support=support)), content


def test_one_wide_hot_basket_among_small_ones(make_items):
    wide = [f"P{n:02d}" for n in range(24)]
    content = [wide] * 3 + [wide[n : n + 2] for n in range(20)]
    cfg = BasketConfig(global_min_support=0.1, max_itemset_length=3)
    assert frequent(to_items(make_items, content), cfg) == brute_itemsets(content, cfg)


@pytest.mark.parametrize(("width", "length"), [(1, 3), (3, 4), (5, 1)])
def test_wide_baskets_dealt_as_a_grid_give_the_same_itemsets(make_items, width, length):
    for seed in range(2):
        content = random_contents(seed, 1)[0] + [[f"P{n}" for n in range(9)]] * 2 + [["P0", "P3", "P4"]] * 3
        cfg = BasketConfig(global_min_support=0.15, max_itemset_length=length)
        assert frequent(to_items(make_items, content), cfg, width) == brute_itemsets(content, cfg)


def test_counts_agree_with_fp_growth(spark, sf_dir):
    items = _items(spark, sf_dir)
    cfg = BasketConfig(global_min_support=0.01, max_itemset_length=3)
    ours = frequent(items, cfg)
    lists = basket.prepare(items).groupBy("invoice_no").agg(F.collect_list("stock_code").alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=0.01).fit(lists)
    theirs = {tuple(sorted(r["items"])): r.freq for r in model.freqItemsets.collect() if len(r["items"]) <= 3}
    assert ours == theirs and max(len(k) for k in ours) >= 2


def test_support_shrinks_and_lift_is_symmetric(spark, sf_dir):
    items = _items(spark, sf_dir)
    cfg = BasketConfig(global_min_support=0.002, min_confidence=0.001, min_lift=0.0)
    found = frequent(items, cfg)
    for itemset, count in found.items():
        for left_out in range(len(itemset) if len(itemset) > 1 else 0):
            assert found[itemset[:left_out] + itemset[left_out + 1 :]] >= count
    lift = {(r.antecedent_codes, r.consequent_codes): r.lift for r in basket.mine(items, cfg=cfg).collect()}
    assert lift and all(lift[right, left] == pytest.approx(value, abs=2e-6) for (left, right), value in lift.items())
    assert {len(right.split("|")) for _, right in lift} == {1, 2}


def test_scopes_segments_and_small_segments(make_items, spark):
    content = {f"I{n}": ("C1" if n < 4 else "C2", "AB" if n % 2 else "ABC") for n in range(6)}
    items = make_items([(i, c, dt.datetime(2021, 1, 1), s, s, 1, 1) for i, (c, codes) in content.items() for s in codes])
    data = [("C1", "NEW", "new"), ("C1", "LOYAL", "loyal"), ("C2", "AT_RISK", "risk")]
    segments = spark.createDataFrame(data, "customer_id string, segment_code string, segment_name string")
    cfg = BasketConfig(segment_min_support=0.2, global_min_support=0.2, min_confidence=0.1, min_lift=0.5, min_segment_baskets=3)
    lines = basket.scoped_lines(items, segments, cfg)
    baskets = {r.scope: r.n for r in lines.groupBy("scope").agg(F.count_distinct("invoice_no").alias("n")).collect()}
    # A customer counts in one segment only; a segment with two baskets is too small.
    assert baskets == {"ALL": 6, "LOYAL": 4}
    rules = basket.mine(items, segments, cfg).collect()
    assert {(r.segment_code, r.segment_name, r.scope_basket_count) for r in rules} == {("ALL", "全部客户", 6), ("LOYAL", "loyal", 4)}


def test_only_service_codes_single_products_and_no_items(make_items):
    for codes in (["POST", "DOT"], ["A"], []):
        assert basket.mine(to_items(make_items, [codes] * 4), cfg=CFG).count() == 0


def test_missing_name_wins_in_the_catalogue(make_items):
    stamp = dt.datetime(2021, 1, 1)
    data = [("1", "C", stamp, "A", "zz", 1, 1), ("2", "C", stamp, "A", None, 1, 1)]
    data += [(n, "C", stamp, "B", "b", 1, 1) for n in "12"]
    names = {r.antecedent_codes: r.antecedent_names for r in basket.mine(make_items(data), cfg=replace(CFG, min_confidence=0.1)).collect()}
    assert names == {"A": "未知商品", "B": "b"}


def test_top_rules_break_ties_by_code(make_items):
    content = ["AB", "AB", "CG", "CG", "EF", "EF"]
    rules = basket.mine(to_items(make_items, content), cfg=replace(CFG, top_rules_per_scope=3))
    assert rows(rules, "antecedent_codes", "consequent_codes") == [("A", "B"), ("B", "A"), ("C", "G")]


def rule_frame(spark, rows_):
    names = "segment_code segment_name antecedent_codes antecedent_names consequent_codes consequent_names"
    schema = ", ".join(f"{n} string" for n in names.split()) + ", support double, confidence double, lift double, coverage_basket_count int"
    data = [("ALL", "all", a, a.lower(), c, c.lower(), 0.1, 0.5, lift, 10) for a, c, lift in rows_]
    return spark.createDataFrame(data, schema)


def test_drift_statuses(spark):
    previous = rule_frame(spark, [("A", "B", 1.1), ("E", "F", 2.0), ("G", "H", 2.0), ("I", "J", 1.0), ("K", "L", 2.0), ("M", "N", 2.0)])
    current = rule_frame(spark, [("A", "B", 1.4), ("C", "D", 1.3), ("G", "H", 1.5), ("I", "J", 1.05), ("K", "L", 2.09), ("M", "N", 1.89)])
    drifted = basket.drift(previous, current)
    found = {r.antecedent_codes: r for r in drifted.collect()}
    assert {k: r.drift_status for k, r in found.items()} == {
        "A": "GROWING", "C": "NEW", "E": "DROPPED", "G": "DECLINING", "I": "STABLE", "K": "STABLE", "M": "DECLINING",
    }
    assert found["E"].antecedent_names is None and found["E"].segment_name is None
    assert [r.drift_status for r in drifted.collect()] == sorted(r.drift_status for r in found.values())
    counts = {r.drift_status: r.rule_count for r in basket.drift_counts(drifted).collect()}
    assert sum(counts.values()) == 7 and counts["STABLE"] == 2


def test_periods_mined_together_equal_periods_mined_alone(spark, sf_dir):
    items = _items(spark, sf_dir)
    cfg = BasketConfig(global_min_support=0.005, min_confidence=0.01, min_lift=0.5)
    early = items.filter("invoice_ts < '1998-01-01'")
    late = items.filter("invoice_ts >= '1998-01-01'")
    together = basket.mine_periods(early, late, cfg)
    assert rows(together[0]) == rows(basket.mine(early, cfg=cfg))
    assert rows(together[1]) == rows(basket.mine(late, cfg=cfg))


def exchanges(df):
    """Shuffles in the plan of a frame that has not run."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_lines_are_shuffled_once_by_invoice(make_items):
    items = materialise(to_items(make_items, ["AB", "ABC"]), "items")
    assert exchanges(basket.prepare(items)) == 1


def test_baskets_of_customers_in_several_segments(make_items, spark):
    """One basket with parts of two segments, against itemsets that are listed scope by scope."""
    stamp = dt.datetime(2021, 1, 1)
    content = [("I0", "K1", "ABC"), ("I0", "K2", "CEF"), ("I1", "K1", "ABE"), ("I2", "K2", "ABEF"), ("I3", "K2", "EF"), ("I4", "K3", "ABF"), ("I5", "K4", "AF"), ("I6", "K1", "A")]
    items = make_items([(i, k, stamp, s, s.lower(), 1, 1) for i, k, codes in content for s in codes])
    data = [("K1", "NEW", "new"), ("K2", "LOYAL", "loyal"), ("K3", "LOST", "lost")]
    segments = spark.createDataFrame(data, "customer_id string, segment_code string, segment_name string")
    cfg = BasketConfig(global_min_support=0.2, segment_min_support=0.4, min_segment_baskets=2)
    scopes = basket.scope_table(items, segments, cfg)
    prepared = basket.prepared_baskets(items, segments, cfg)
    products = materialise(basket.scope_products(basket.lines_of(prepared), basket.basket_counts(prepared, scopes, cfg), cfg), "products")
    baskets = materialise(basket.scope_baskets(basket.lines_of(prepared), products), "baskets")
    found = defaultdict(dict)
    for r in basket.named_itemsets(basket.itemsets(baskets, basket.basket_sizes(baskets, scopes), cfg), basket.product_catalog(baskets, products)).collect():
        found[r.scope][tuple(r.codes.split("|"))] = r.support_count
    # The lowest customer of an invoice and product has it; single products of a segment's part count for the segment.
    whole = ["ABCEF", "ABE", "ABEF", "EF", "ABF", "AF"]
    loose = replace(cfg, min_basket_size=1, global_min_support=cfg.segment_min_support)
    assert found == {"ALL": brute_itemsets(whole, cfg), "NEW": brute_itemsets(["ABC", "ABE"], loose), "LOYAL": brute_itemsets(["EF", "ABEF", "EF"], loose)}
    lines = Counter(r.scope for r in basket.scoped_lines(items, segments, cfg).collect())
    assert lines == {"ALL": 19, "NEW": 6, "LOYAL": 8}


def test_kept_baskets_come_from_the_baskets_rows_without_a_shuffle(spark):
    """Odd codes, customers without a segment, an invoice of two segments, products kept in one scope only."""
    draw = random.Random(5)
    codes = ["a", "b", "ü\"|", "c\\d", " e", "f"]
    made = [(f"i{i}", f"c{draw.randrange(6)}", code, draw.choice([None, f"n{code}", "n"])) for i in range(60) for code in draw.sample(codes, draw.randint(1, 5))]
    made += [("i0", "c9", "a", "x"), ("i0", "c9", "f", None), ("two", "c0", "a", "n"), ("two", "c1", "b", "n"), ("two", "c1", "f", "n"), ("two", "c0", "c\\d", "n")]
    items = spark.createDataFrame(made, "invoice_no string, customer_id string, stock_code string, product_name string")
    segments = spark.createDataFrame([(f"c{i}", f"S{i % 2}", f"Name {i % 2}") for i in range(5)], "customer_id string, segment_code string, segment_name string")
    cfg = replace(CFG, segment_min_support=0.25, min_segment_baskets=2)
    prepared = basket.prepared_baskets(items, segments, cfg)
    scopes = basket.scope_table(items, segments, cfg)
    products = materialise(basket.scope_products(basket.lines_of(prepared), basket.basket_counts(prepared, scopes, cfg), cfg), "products")
    kept = basket.kept_baskets(prepared, products)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    found = sorted(map(repr, kept.collect()))
    assert found == sorted(map(repr, basket.scope_baskets(basket.lines_of(prepared), products).collect()))
    assert found == sorted(map(repr, basket.kept_baskets(prepared, products, most=0).collect()))
    assert {r.scope for r in kept.collect()} == {"ALL", "S0", "S1"}
    number = {(r.scope, r.stock_code): r.item for r in products.collect()}
    first, owner = {}, {f"c{i}": f"S{i % 2}" for i in range(5)}
    for invoice, customer, code, name in sorted(made, key=lambda r: (r[1], r[3] is not None, r[3] or "")):
        first.setdefault((invoice, code), (customer, name))
    held = defaultdict(list)
    for (invoice, code), (customer, name) in first.items():
        if len([1 for i, _ in first if i == invoice]) >= CFG.min_basket_size:
            for scope in {"ALL", owner.get(customer)}:
                if (scope, code) in number:
                    held[scope, invoice].append((number[scope, code], name))
    expected = {place: sorted(content, key=lambda r: r[0]) for place, content in held.items() if len(content) >= 2}
    assert {(r.scope, r.invoice_no): [tuple(x) for x in r.content] for r in kept.collect()} == expected
    none = basket.kept_baskets(prepared, materialise(products.limit(0), "none"))
    assert none.count() == 0
