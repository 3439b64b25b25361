"""Mixing, near copies, repeated passages, quality."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import mixing, near, quality, suffix, words as hashing


def test_run_hashes_tell_runs_apart():
    h = np.arange(100, dtype=np.uint64) % np.uint64(10)
    for n in (1, 2, 5, 31, 50):
        runs = hashing.run_hashes(h, n)
        assert len(runs) == 100 - n + 1 and len(set(runs.tolist())) == min(10, 101 - n)
        assert all(runs[i] == runs[i % 10] for i in range(len(runs)))


# mixing


def windows_hold(shares, order):
    """Every source is less than one block from its weight, before and after every slot."""
    total, had = sum(shares.values()), Counter()
    for t, s in enumerate(order, 1):
        had[s] += 1
        assert all(abs(had[x] - shares[x] * t / total) < 1 for x in shares)


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 700, None: 0.001, "c": 3}, {f"s{i}": 1 + i * i for i in range(20)}])
def test_periods_deviate_less_than_a_block(weights):
    shares = mixing.whole_weights(weights, 200)
    assert sum(shares.values()) == 200 and min(shares.values()) >= 1
    slots = mixing.period(shares)
    order = {x: s for s, own in slots.items() for x in own}
    assert sorted(order) == list(range(200))
    windows_hold(shares, [order[x] for x in range(200)] * 2)


def test_mix_holds_every_row_once_and_follows_weights(make_docs):
    rows = [(i, f"t{i}", "en", s) for i, s in enumerate(["hot"] * 400 + ["b"] * 90 + ["c"] * 37 + [None] * 5)]
    rows += [(None, None, None, "c"), (9000, "t", "en", "c"), (9000, "t", "en", "c")]
    weights = {"hot": 2, "b": 3, "c": 1, None: 1}
    placed = mixing.interleave(make_docs(rows), weights=weights, block=4, parts=70, per_bucket=50).collect()
    assert Counter(str(r.doc_id) for r in placed) == Counter(str(r[0]) for r in rows)
    blocks = {}
    for r in placed:
        blocks.setdefault(r.slot, set()).add((r.source, r.block))
    assert sorted(blocks) == list(range(len(blocks))) and all(len(b) == 1 for b in blocks.values())
    order = [next(iter(blocks[x])) for x in range(len(blocks))]
    for s in weights:
        assert [b for own, b in order if own == s] == list(range(-(-sum(r[3] == s for r in rows) // 4)))
    left = Counter(s for s, _ in order)
    start = 0
    while left:  # phase by phase
        end = min(max(i for i, (s, _) in enumerate(order) if s == x) for x in left) + 1
        windows_hold(mixing.whole_weights({s: weights[s] for s in left}, 70), [s for s, _ in order[start:end]])
        left = Counter(s for s, _ in order[end:])
        start = end


def test_mixed_rows_keep_columns_and_order(make_docs):
    docs = make_docs([(i, f"t{i}", "en", "ab"[i % 3 == 0]) for i in range(90)] + [(5, "t5", "en", "a")] * 2)
    mixed = mixing.mixed_rows(docs, block=2, weights={"a": 1, "b": 1})
    assert mixed.columns == docs.columns
    assert sorted(mixed.collect()) == sorted(docs.collect())
    sources = [r.source for r in mixed.collect()]
    assert sources[:24] == ["a", "a", "b", "b"] * 6
    assert mixing.mixed_rows(make_docs([])).count() == 0


def test_every_prefix_of_a_mix_follows_the_given_weights():
    hot = {f"s{i}": math.sqrt(1 + i) for i in range(20)} | {"hot": 0.5 * math.sqrt(210)}
    for weights, n in ((hot, 20_000), ({f"s{i}": 0.5 / 99 for i in range(99)} | {"half": 0.5}, 5_000), ({"a": 1e-4, "b": 1.0}, 30_000)):
        names, whole = list(weights), mixing._integers(list(weights.values()))
        had, total = [0] * len(names), sum(weights.values())
        for t, (s, block) in zip(range(1, n + 1), mixing.slots(whole, [n + 1] * len(names)), strict=False):
            assert block == had[s]
            had[s] += 1
            assert all(abs(h - w * t / total) < 1 + 1e-6 for h, w in zip(had, weights.values(), strict=True))


def test_mix_of_more_sources_than_any_period(make_docs):
    rows = [(i, f"t{i}", "en", f"s{i % 1100}") for i in range(1300)]
    placed = mixing.interleave(make_docs(rows), block=1).collect()
    assert sorted(r.slot for r in placed) == list(range(1300)) and len({r.source for r in placed}) == 1100


def test_mix_refuses_unknown_sources(make_docs):
    with pytest.raises(ValueError, match="without a weight"):
        mixing.interleave(make_docs([(1, "t", "en", "x")]), weights={"y": 1})
    with pytest.raises(ValueError, match="above zero"):
        mixing.whole_weights({"a": 0}, 10)


# near copies


def jaccard_groups(rows, size=5, least=0.8):
    sets = {}
    for d, text in rows:
        w = (text or "").split()
        sets[d] = frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])
    links, root = dict.fromkeys(sets, 0), {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and shared / (len(sets[a]) + len(sets[b]) - shared) >= least - 1e-12:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return links, {d: find(d) for d in ids}


def changed(text, places, word="zzz"):
    w = text.split()
    for p in places:
        w[p] = word
    return " ".join(w)


def near_rows(words):
    base, other = words(200), words(120)
    rows = [(i, changed(base, [3 * i % 200, (7 * i) % 200])) for i in range(70)]
    rows += [(100 + i, other) for i in range(30)] + [(140, changed(other, [60])), (141, changed(other, [10, 60, 110])), (142, other + " end")]
    rows += [(200, "one two"), (201, "one  two"), (202, "one"), (203, None), (204, ""), (205, " \n"), (206, "a b c d e"), (207, "a b c d e")]
    rows += [(300 + i, words(40)) for i in range(40)] + [(400, words(9000))]
    return rows


@pytest.mark.parametrize("block", [512, 8])
def test_near_join_finds_every_link(make_docs, words, block):
    rows = near_rows(words)
    links, groups = jaccard_groups(rows)
    got = {r.doc_id: r for r in near.near_join(make_docs([*rows, (None, rows[0][1])]), block=block).collect()}
    assert {d: r.n_links for d, r in got.items()} == links
    assert {d: r.group_id for d, r in got.items()} == groups
    assert got[100].class_size == 30 and got[129].class_id == 100 and got[201].class_id == 200 and got[204].class_id == 204


def test_one_of_each_keeps_first_and_unlinked(make_docs, words):
    rows = near_rows(words)
    _, groups = jaccard_groups(rows)
    docs = make_docs([*rows, (None, rows[0][1]), (None, None), (100, rows[70][1]), (203, None)])
    kept = near.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([*(str(d) for d, g in groups.items() if d == g), "None", "None", "203"])


def test_near_join_of_nothing_and_all_alike(make_docs):
    assert near.near_join(make_docs([])).count() == 0
    alike = near.near_join(make_docs([(i, "the same five words here") for i in range(50)])).collect()
    assert {(r.n_links, r.group_id) for r in alike} == {(49, 0)}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    got = {r.node: r.root for r in near.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 0), **dict.fromkeys(range(101, 160), 100)}


def test_prefixes_shorten_until_the_recall_is_reached():
    assert near.prefix_length(6, 16, 0.8, 0.9999) == 3
    assert near.prefix_length(6, 16, 0.8, 0.999) == 4
    assert near.prefix_length(6, 16, 0.8, 0.99) == 6
    assert near.prefix_length(6, 1, 0.5, 0.9999) == 1


# repeated passages


def covered(rows, length):
    """Words of each document that repeat an earlier passage, and that come first of several."""
    seen, count, later, first = set(), Counter(), {}, {}
    split = {d: t.split() for d, t in sorted(set(rows))}
    grams = {d: [tuple(w[i : i + length]) for i in range(len(w) - length + 1)] for d, w in split.items()}
    for own in grams.values():
        count.update(own)
    for d, own in grams.items():
        for i, g in enumerate(own):
            if count[g] > 1:
                (later if g in seen else first).setdefault(d, set()).update(range(i, i + length))
            seen.add(g)
    return later, first


def passage_rows(words):
    shared, other = words(60), words(50)
    rows = [(i, f"{words(5 * i)} {shared}\n{words(30)}") for i in range(40)]
    rows += [(50, f"{other} {words(9)}"), (51, f"{words(9)} {other}"), (52, " ".join(other.split()[:49]) + " " + words(30))]
    rows += [(60, words(80)), (61, shared), (62, other), (63, f"{shared} {other} {shared}")]
    rows += [(64, "again " * 300), (65, words(7000)), (67, "short text")]
    rows += [(66, rows[-2][1]), (68, "short text"), (70, " ".join(rows[-2][1].split()[3000:3100]))]
    return rows


@pytest.mark.parametrize(("length", "window"), [(50, 20), (12, 4)])
def test_passages_equal_brute_force(make_docs, words, length, window):
    rows = passage_rows(words)
    later, first = covered(rows, length)
    got = {False: {}, True: {}}
    docs = make_docs([*rows, (None, rows[0][1]), (71, None), (72, ""), rows[0]]).repartition(5)
    for r in suffix.repeated_passages(docs, length=length, window=window, gram=3).collect():
        got[r.first].setdefault(r.doc_id, set()).update(range(r.start, r.start + r.words))
    assert got == {False: later, True: first}


def test_without_repeats(make_docs, words):
    shared, a, b = words(70), words(20), words(20)
    rows = [(1, f"{a}\n{shared} {b}"), (2, f"{b} {shared}\n {a}"), (3, shared), (4, "  kept  as it is "), (None, shared), (5, None), (6, f"{a} {words(60)}")]
    docs = make_docs(rows)
    kept = suffix.without_repeats(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted(
        [("1", rows[0][1]), ("2", f"{b}\n{a}"), ("4", rows[3][1]), ("None", shared), ("5", None), ("6", rows[6][1])], key=lambda r: (r[0], str(r[1]))
    )
    assert suffix.without_repeats(make_docs([])).count() == 0


def test_neighbours_compare_across_tasks(spark):
    rows = spark.createDataFrame([(i % 3, i, 0, 0) for i in range(300)] + [(50, 1, 0, 0)], "head long, doc_id long, mark int, place int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = suffix.neighbours(rows, ["head"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == 300 and sum(not r.prev_same for r in got) == 3 and sum(not r.next_same for r in got) == 3


# quality


def kneser_ney(counts):
    """Probability of the last character of a trigram, as plain recursion."""

    def discounts(c):
        n = [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        return [0] + [max(0, k - (k + 1) * y * n[k] / n[k - 1]) if n[k - 1] else 0 for k in (1, 2, 3)]

    levels = {3: counts}
    for k in (2, 1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    cuts = {k: discounts(c) for k, c in levels.items()}
    size = len(levels[1]) + 1

    def p(gram):
        if not gram:
            return 1 / size
        own, cut = levels[len(gram)], cuts[len(gram)]
        after = {g: v for g, v in own.items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        if not total:
            return p(gram[1:])
        v = own.get(gram, 0)
        return (v - cut[min(v, 3)]) / total + sum(cut[min(x, 3)] for x in after.values()) / total * p(gram[1:])

    return p


def test_perplexities_equal_plain_kneser_ney(spark, make_docs):
    trusted = [(1, "abc abd abe"), (2, "the cat sat on the mat, the end"), (3, "é😀 the"), (4, "a")]
    others = [(10, "the bat"), (11, "zzzz"), (12, ""), (13, None), (14, "é" * 50), (15, "x" * 5000)]
    labels = spark.createDataFrame([(d, 1) for d, _ in trusted] + [(10, 0), (1, 1), (2, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.scores(make_docs(trusted + others), labels, chars=20).collect()}
    grams = lambda t: [f"\x02\x02{t or ''}\x03"[i : i + 3] for i in range(len(t or "") + 1)]
    p = kneser_ney(Counter(g for _, t in trusted for g in grams(t)))
    for d, text in trusted + others:
        assert got[d].n == len(text or "") + 1 and got[d].trusted == (d < 10)
        assert got[d].nats == pytest.approx(-sum(math.log(p(g)) for g in grams(text)), rel=1e-9)


def test_probabilities_add_up(spark):
    counts = spark.createDataFrame([(quality.trigrams([t])[0].tolist(),) for t in ("abcabd", "aab")], "g array<long>").select(F.explode("g").alias("gram"))
    counts = counts.groupBy("gram").agg(F.count("*").alias("n"))
    letters = [ord(c) for c in "abcd\x03"] + [0x1F600]
    asked = spark.createDataFrame([(ord("a") << 42 | ord("b") << 21 | c,) for c in letters], "gram long")
    assert sum(math.exp(r.log) for r in quality.kneser_ney(counts, asked).collect()) == pytest.approx(1)


def test_kept_rows(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs, labels)
    bad = judged.filter("NOT keep")
    kept = quality.kept(docs.withColumn("row_key", F.lit(1)), labels)
    assert kept.columns == [*docs.columns, "row_key"]
    assert kept.count() + bad.count() == docs.count() == judged.count() and bad.count() > 0
    known = judged.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()
    rates = {r.quality: r["kept"] for r in known}
    assert rates[1] >= 0.99 and rates[0] <= 0.5


def test_quality_without_labels_keeps_all(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = make_docs([(1, "text"), (1, "text"), (None, "x"), (2, None)])
    assert sorted(map(str, quality.kept(docs, none).collect())) == sorted(map(str, docs.collect()))
    assert quality.kept(make_docs([]), none).count() == 0


def test_small_and_unlabelled_languages_are_judged_around_their_own_centre(spark, sf_dir):
    root = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    greek = F.translate("text", "abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψωϊϋ")
    moved = docs.filter("lang = 'en'").withColumns({"doc_id": F.col("doc_id") + 1_000_000, "lang": F.lit("el"), "text": greek})
    both = docs.unionByName(moved)
    judged = quality.judge(both, labels).join(labels.select(F.col("doc_id").alias("id"), "quality"), F.col("id") == F.col("doc_id") % 1_000_000).collect()
    kept = {}
    for r in judged:
        if r.quality is not None:
            kept.setdefault((r.lang, r.quality), []).append(r.keep)
    for (lang, good), keeps in kept.items():
        share = sum(keeps) / len(keeps)
        assert share >= (0.9 if lang == "el" else 0.98) if good else share <= (0.5 if lang == "el" else 0.06), (lang, good, share)
    assert {r.doc_id for r in judged if r.doc_id in (413, 971, 499, 730) and r.keep} == set()
    print({k: (round(sum(v) / len(v), 3), len(v)) for k, v in sorted(kept.items())})
