"""Baskets, itemsets, rules, clusters and their artifacts against brute force."""

from itertools import combinations
from math import inf, sqrt

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from basketry.errors import BasketDataError, ClusteringDataError
from basketry.functions.itemsets import itemset_from_json, itemset_json
from basketry.mining import baskets as B
from basketry.mining import clustering as C
from basketry.mining import features as FE
from basketry.mining import itemsets as I
from basketry.mining import rules as R
from basketry.sources import artifacts


def lines_of(spark, baskets):
    return spark.createDataFrame(
        [(order, place, str(item)) for order, basket in enumerate(baskets, start=1)
         for place, item in enumerate(basket, start=1)],
        "order_id bigint, position int, item string")


BASKETS = [[(i * 7 + j * j * 3 + i * j) % 9 for j in range(2 + i % 4)] for i in range(60)]


def brute_itemsets(baskets, support):
    sets = [set(map(str, b)) for b in baskets]
    items = sorted(set().union(*sets))
    return {
        group: sum(set(group) <= s for s in sets)
        for size in range(1, 6) for group in combinations(items, size)
        if sum(set(group) <= s for s in sets) / len(sets) >= support
    }


def test_baskets_keep_cart_order_and_drop_small_ones(spark, wh):
    found = {r.order_id: r.items for r in B.baskets(B.basket_lines(wh)).collect()}
    assert found[3] == ["10", "20", "21"] and len(found) == 5
    assert B.baskets(B.basket_lines(wh), 3).count() == 1
    aisles = {r.order_id: r.items for r in B.baskets(B.basket_lines(wh, item="aisle")).collect()}
    assert aisles[3] == ["1", "2", "2"]


def test_basket_guards(wh):
    with pytest.raises(ValueError):
        B.sample_orders(wh, 0)
    with pytest.raises(ValueError):
        B.baskets(B.basket_lines(wh), 0)
    with pytest.raises(ValueError):
        B.basket_lines(wh, item="shelf")
    with pytest.raises(BasketDataError):
        B.prepare_baskets(B.basket_lines(wh), min_items=9)


def test_emptied_baskets_stay_in_the_denominator(spark):
    prepared = B.prepare_baskets(lines_of(spark, [[1, 2], [1], [3]]), top_n=2, min_items=1)
    assert prepared.count == 3
    assert sorted(r["items"] for r in prepared.frame.collect()) == [[], ["1"], ["1", "2"]]


def test_top_items_break_ties_by_text(spark):
    found = rows(B.top_items(lines_of(spark, [[10, 9], [9, 10], [2, 10]]), 2, 1))
    assert found == [("10", 3), ("9", 2)]
    tied = rows(B.top_items(lines_of(spark, [[9, 10]]), 1, 1))
    assert tied == [("10", 1)]


@pytest.mark.parametrize("mine", [I.frequent_itemsets, I.apriori_itemsets, I.frequent_itemsets_by_closure])
@pytest.mark.parametrize("support", [0.05, 0.15])
def test_itemsets_match_brute_force(spark, mine, support):
    prepared = B.prepare_baskets(lines_of(spark, BASKETS), min_items=2)
    found = {tuple(r["items"]): r.freq for r in mine(prepared, support).collect()}
    assert found == brute_itemsets(BASKETS, support)
    assert max(map(len, found)) >= 2


def brute_closed(counts):
    return {g: n for g, n in counts.items() if not any(n == m and set(g) < set(h) for h, m in counts.items())}


@pytest.mark.parametrize("baskets, support", [
    (BASKETS, 0.05), (BASKETS, 0.2), ([[1, 2, 3], [1, 2, 3, 4], [1, 2]], 0.3), ([[9, 8], [8, 9]], 0.5),
    ([[i for i in range(1, 8) if i != gap] for gap in range(1, 8)], 0.2),
    ([list(range(1, n)) for n in range(3, 7)], 0.1)])
def test_closed_itemsets_match_brute_force(spark, monkeypatch, baskets, support):
    prepared = B.prepare_baskets(lines_of(spark, baskets), min_items=2)
    counts = brute_itemsets(baskets, support)
    closed = I.closed_itemsets(prepared, support)
    found = [(tuple(r["items"]), r.freq) for r in closed.collect()]
    assert len(found) == len(dict(found)) and dict(found) == brute_closed(counts)
    short = I.itemsets_of_closed(closed, prepared, 2)
    assert {tuple(r["items"]): r.freq for r in short.collect()} == {g: n for g, n in counts.items() if len(g) < 3}


def test_two_equal_long_baskets_end(spark, monkeypatch):
    """Their frequent itemsets are 2^40; they are stored as one, and derived as far as wanted."""
    monkeypatch.setattr(I, "SMALL_LEVEL", 0)
    prepared = B.prepare_baskets(lines_of(spark, [list(range(100, 140))] * 2 + [[100, 7], [7, 5]]), min_items=2)
    closed = I.closed_itemsets(prepared, 2 / prepared.count)
    assert sorted((r.length, r.freq) for r in closed.collect()) == [(1, 2), (1, 3), (40, 2)]
    pairs = I.itemsets_of_closed(closed, prepared, 2)
    assert pairs.groupBy("length", "freq").count().count() == 3
    assert pairs.where("length = 2").count() == 780 and pairs.where("length = 1").count() == 41


def test_apriori_without_broadcasts_and_without_python(spark, monkeypatch):
    monkeypatch.setattr(I, "SMALL_LEVEL", 0)
    prepared = B.prepare_baskets(lines_of(spark, BASKETS), min_items=2)
    itemsets = I.apriori_itemsets(prepared, 0.1)
    assert {tuple(r["items"]): r.freq for r in itemsets.collect()} == brute_itemsets(BASKETS, 0.1)
    assert "Python" not in itemsets._jdf.queryExecution().executedPlan().toString()


def test_support_boundary_is_included(spark):
    prepared = B.prepare_baskets(lines_of(spark, [[1, 2], [1, 3], [1, 4], [5, 6]]))
    assert [r["items"] for r in I.frequent_itemsets(prepared, 0.75).collect()] == [["1"]]
    with pytest.raises(BasketDataError):
        I.frequent_itemsets(prepared, 0.76)
    for bad in (0, 1.1):
        with pytest.raises(ValueError):
            I.frequent_itemsets(prepared, bad)


def test_rules_match_brute_force(spark):
    prepared = B.prepare_baskets(lines_of(spark, BASKETS), min_items=2)
    counts = brute_itemsets(BASKETS, 0.05)
    n = len(BASKETS)
    expected = {}
    for group, freq in counts.items():
        for size in range(1, len(group)):
            for left in combinations(group, size):
                right = tuple(i for i in group if i not in left)
                confidence = freq / counts[left]
                if confidence >= 0.3:
                    expected[left, right] = (freq / n, confidence, confidence / (counts[right] / n))
    found = {
        (tuple(r.antecedents), tuple(r.consequents)): (r.support, r.confidence, r.lift)
        for r in R.generate_rules(I.frequent_itemsets(prepared, 0.05)).collect()
    }
    assert found.keys() == expected.keys()
    assert any(len(right) == 2 for _, right in found)
    for key, values in expected.items():
        assert found[key] == pytest.approx(values)


@pytest.mark.parametrize("metric, threshold", [("lift", 1.1), ("support", 0.2), ("leverage", 0.01), ("conviction", 1.2)])
def test_rules_by_other_metrics_match_brute_force(spark, metric, threshold):
    prepared = B.prepare_baskets(lines_of(spark, BASKETS), min_items=2)
    counts, n, expected = brute_itemsets(BASKETS, 0.05), len(BASKETS), set()
    for group, freq in counts.items():
        for size in range(1, len(group)):
            for left in combinations(group, size):
                right = tuple(i for i in group if i not in left)
                support, a, c = freq / n, counts[left] / n, counts[right] / n
                confidence = support / a
                value = {"lift": confidence / c, "support": support, "leverage": support - a * c,
                         "conviction": inf if confidence >= 1 else (1 - c) / (1 - confidence)}[metric]
                if value >= threshold:
                    expected.add((left, right))
    found = R.generate_rules(I.frequent_itemsets(prepared, 0.05), metric, threshold)
    assert {(tuple(r.antecedents), tuple(r.consequents)) for r in found.collect()} == expected


def test_rules_of_a_long_itemset_grow_only_while_they_hold(spark, monkeypatch):
    """Of 2^70 cuts only those are made whose shorter consequents hold."""
    items = [f"{i:02}" for i in range(70)]
    without = lambda *gone: [i for i in items if i not in gone]
    rows = [(items, 0.1)] + [([i], 0.5) for i in items]
    # Three single consequents hold, and two of the three pairs.
    rows += [(without(i), 0.12 if i in ("00", "01", "02") else 0.9) for i in items]
    rows += [(without("00", "01"), 0.125), (without("00", "02"), 0.2), (without("01", "02"), 0.9),
             (["00", "01"], 0.4), (["00", "02"], 0.4), (["01", "02"], 0.4), (without("00", "01", "02"), 0.2), (["00", "01", "02"], 0.3)]
    frame = spark.createDataFrame([(i, s, len(i)) for i, s in rows], "items array<string>, support double, length int")
    frame, made = frame.where("length = 70 or length < 4").unionByName(frame.where("length between 66 and 69")), []

    def write(df, name, *rest, materialize=R.materialize):
        made.append(materialize(df, name, *rest))
        return made[-1]

    monkeypatch.setattr(R, "materialize", write)
    found = R.generate_rules(frame, min_threshold=0.5)
    long = {tuple(r.consequents) for r in found.collect()
            if len(r.antecedents) + len(r.consequents) == 70}
    assert long == {("00",), ("01",), ("02",), ("00", "01"), ("00", "02")}
    # Every row that was written is a rule that holds; nothing else was made.
    assert sum(df.count() for df in made) == found.count()


def test_certain_rules_have_infinite_conviction(spark):
    prepared = B.prepare_baskets(lines_of(spark, [[1, 2], [1, 2], [2, 3]]))
    rules = R.generate_rules(I.frequent_itemsets(prepared, 0.3), min_threshold=1.0)
    assert {(r.antecedents[0], r.conviction) for r in rules.collect()} == {("1", inf), ("3", inf)}
    with pytest.raises(BasketDataError):
        R.require_rules(R.generate_rules(I.frequent_itemsets(prepared, 0.3), "lift", 9.0))
    with pytest.raises(ValueError):
        R.generate_rules(rules, metric="jaccard")
    with pytest.raises(ValueError):
        R.top_rules(rules, 0)


def test_itemset_json(spark):
    df = spark.createDataFrame([(["b", "A", "Milk, Whole", 'q"t', "é/x"],)], "v array<string>")
    text = df.select(itemset_json(df.v)).first()[0]
    assert text == '["A","b","Milk, Whole","q\\"t","é/x"]'
    back = spark.createDataFrame([(text,)], "t string")
    assert set(back.select(itemset_from_json(back.t)).first()[0]) == set(df.first().v)


@pytest.mark.parametrize("text, expected", [
    ('["a",1]', ["a", "1"]), ("[1,1]", ["1"]), ("[]", []), ("[true]", None), ("[1.5]", None),
    ("[null]", None), ('{"a":1}', None), ("oops", None), ('[["a"]]', None), ('"a"', None),
])
def test_itemset_parser_is_strict(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(itemset_from_json(df.t)).first()[0] == expected


def test_rules_survive_their_file_form(spark, wh, tmp_path):
    prepared = B.prepare_baskets(B.basket_lines(wh))
    itemsets = I.frequent_itemsets(prepared, 0.2)
    rules = R.generate_rules(itemsets, min_threshold=0.1)
    names = R.item_names(wh).withColumn(
        "item_name", F.when(F.col("item") == "20", "Milk, Whole").otherwise(F.col("item_name"))
    ).where("item <> '21'")
    artifacts.save_rules(rules, str(tmp_path / "rules"), names)
    loaded = artifacts.load_association_rules(spark, str(tmp_path / "rules"))
    assert {(tuple(r.antecedents), tuple(r.consequents)) for r in loaded.collect()} == {
        (tuple(r.antecedents), tuple(r.consequents)) for r in rules.collect()}
    texts = {name for r in loaded.collect() for name in r.antecedent_names + r.consequent_names}
    assert {"Milk, Whole", "product:21"} <= texts
    artifacts.save_frequent_itemsets(itemsets, str(tmp_path / "sets"))
    assert artifacts.read_text_csv(spark, str(tmp_path / "sets")).count() == itemsets.count()


# --- clustering -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def users(spark):
    """Twelve users in two clear groups, ids from high to low."""
    rows_ = [(12 - i, 4 + i if i < 6 else 36 + i, 2.0 + i * 0.1 if i < 6 else 12.0 + i * 0.1,
              0.1 + i * 0.01 if i < 6 else 0.7 + i * 0.01, 20.0 - i * 0.1 if i < 6 else 5.0)
             for i in range(12)]
    return spark.createDataFrame(
        rows_, "user_id bigint, total_orders bigint, avg_basket_size double, "
        "avg_reorder_ratio double, avg_days_between_orders double")


def test_two_groups_are_found_and_repeat(users):
    first, metrics = C.train(users, 2, n_init=2)
    second, _ = C.train(users, 2, n_init=2)
    labels = sorted(rows(C.cluster_labels(first.frame)))
    assert labels == sorted(rows(C.cluster_labels(second.frame)))
    assert [label for _, label in labels] == [1] * 6 + [0] * 6
    assert 0.8 < metrics["silhouette"] <= 1 and metrics["davies_bouldin"] < 0.5
    again = C.assign(first.model, FE.scale(users, FE.fit_scaler(users)))
    assert sorted(rows(C.cluster_labels(again))) == labels
    profiles = C.profile_clusters(first.frame).collect()
    assert [(p.cluster_name, p.num_users) for p in profiles] == [
        ("Occasional Buyers", 6), ("Frequent Shoppers", 6)]
    assert [p.total_orders_median for p in profiles] == [6.5, 44.5]


def test_candidates_stop_below_the_row_count(users):
    scaled = FE.standardize(users.limit(4))
    chosen = C.select_k(scaled, 4, max_k=10, n_init=1)
    assert [row["k"] for row in chosen] == [2, 3]
    assert sum(row["selected"] for row in chosen) == 1
    with pytest.raises(ClusteringDataError):
        C.select_k(scaled, 2)


def test_run_metadata(users):
    _, run = C.clustering_run(users, max_k=3, n_init=1)
    assert run["n_users"] == 12 and run["selected_k"] == 2
    assert run["selected_k_source"] == "silhouette" and len(run["selection"]) == 2
    _, fixed = C.clustering_run(users, k=3, max_k=2, n_init=1)
    assert fixed["selected_k"] == 3 and fixed["selected_k_source"] == "override"


def test_features_are_checked(spark, users, wh):
    assert FE.user_features(wh, 2).count() == 2
    with pytest.raises(ValueError):
        FE.user_features(wh, 1)
    with pytest.raises(ClusteringDataError, match="three users"):
        FE.require_features(users.limit(2))
    with pytest.raises(ClusteringDataError, match="avg_basket_size"):
        FE.require_features(users.drop("avg_basket_size"))
    with pytest.raises(ClusteringDataError, match="finite.*avg_reorder_ratio"):
        FE.require_features(users.withColumn("avg_reorder_ratio", F.lit(float("nan"))))
    with pytest.raises(ValueError):
        C.train(users, 12)


def test_constant_features_become_zero(users):
    flat = FE.standardize(users.withColumn("avg_basket_size", F.lit(3.0)))
    assert {r.z_avg_basket_size for r in flat.collect()} == {0.0}


def points(spark, values, labels):
    frame = spark.createDataFrame(
        [(i, c, float(v), 0.0, 0.0, 0.0) for i, (v, c) in enumerate(zip(values, labels), start=1)],
        "user_id bigint, cluster bigint, " + ", ".join(f"{n} double" for n in FE.SCALED))
    return frame


def brute_silhouette(values, labels, apart=lambda x, y: abs(x - y)):
    scores = []
    for i, v in enumerate(values):
        own = [apart(v, w) for j, w in enumerate(values) if labels[j] == labels[i] and j != i]
        if not own:
            scores.append(0.0)
            continue
        a = sum(own) / len(own)
        b = min(
            sum(apart(v, w) for w, c in zip(values, labels) if c == other) / labels.count(other)
            for other in set(labels) - {labels[i]})
        scores.append((b - a) / max(a, b))
    return sum(scores) / len(scores)


@pytest.mark.parametrize("block", [2500, 3])
def test_silhouette_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK_ROWS", block)
    values = [sqrt(i * 37 % 23) for i in range(25)]
    labels = [0 if i % 3 else (1 if i % 2 else 2) for i in range(24)] + [3]
    found = C.bounded_silhouette(points(spark, values, labels), 100).first().silhouette
    assert found == pytest.approx(brute_silhouette(values, labels))


def test_squared_silhouette_matches_brute_force(spark):
    values = [sqrt(i * 37 % 23) for i in range(25)]
    labels = [0 if i % 3 else (1 if i % 2 else 2) for i in range(24)] + [3]
    found = C.squared_silhouette(points(spark, values, labels)).first().silhouette
    assert found == pytest.approx(brute_silhouette(values, labels, lambda x, y: (x - y) ** 2))
    with pytest.raises(ClusteringDataError):
        C.squared_silhouette(points(spark, values, [0] * 25))


def test_small_samples_are_widened_and_repeat(spark):
    frame = points(spark, [0, .1, 5, 5.1, 10, 10.1], [0, 0, 1, 1, 2, 2])
    chosen, size = C.silhouette_rows(frame, 2)
    assert size == 4 and chosen.count() == 4
    assert {r.cluster for r in chosen.collect()} == {0, 1, 2}
    score = C.bounded_silhouette(frame, 2).first().silhouette
    assert -1 <= score <= 1 and score == C.bounded_silhouette(frame, 2).first().silhouette
    with pytest.raises(ValueError):
        C.bounded_silhouette(frame, 1)
    with pytest.raises(ClusteringDataError):
        C.bounded_silhouette(frame.withColumn("cluster", F.lit(0)), 2)
    with pytest.raises(ClusteringDataError):
        C.bounded_silhouette(frame.withColumn("cluster", F.col("user_id")), 2)


def test_davies_bouldin(spark):
    frame = points(spark, [0, 2, 10, 14], [0, 0, 1, 1])
    assert C.davies_bouldin(frame) == pytest.approx((1 + 2) / 11)


def test_projection_keeps_every_user(users):
    fit, _ = C.train(users, 2, n_init=1)
    found = C.pca_2d(fit.frame)
    assert found.points.count() == 12 and found.explained[0] > 0.9


def test_projection_follows_the_moments(users):
    scaled = FE.standardize(users).withColumn("cluster", F.lit(0))
    rows_ = np.array([[r[n] for n in FE.SCALED] for r in scaled.collect()])
    assert C.co_moments(scaled) == pytest.approx(np.cov(rows_.T, bias=True))
    found = C.pca_2d(scaled)
    pcs = np.array([(r.pc1, r.pc2) for r in found.points.collect()])
    covariance = np.cov(pcs.T, bias=True)
    assert covariance[0, 1] == pytest.approx(0, abs=1e-9)
    assert found.explained == pytest.approx(tuple(np.diag(covariance) / np.trace(np.cov(rows_.T, bias=True))))


def test_fit_invariants_see_a_broken_fit(users):
    from dataclasses import replace

    fit, _ = C.train(users, 2, n_init=2)
    good = {r.check_name: r.value for r in C.fit_invariants(fit).collect()}
    assert good == {"labelled_rows": 12, "clusters": 2, "rows_nearer_to_another_centre": 0,
                    "centres_off_their_members": 0, "centres_out_of_order": 0}
    swapped = {r.check_name: r.value for r in C.fit_invariants(replace(fit, centers=fit.centers[::-1])).collect()}
    assert swapped["rows_nearer_to_another_centre"] == 12
    assert swapped["centres_off_their_members"] == 2 and swapped["centres_out_of_order"] == 1


def test_baskets_are_whole_unless_pruned(spark):
    prepared = B.prepare_baskets(lines_of(spark, [[3, 1, 2], [1], [3, 4]]))
    assert sorted(r["items"] for r in prepared.frame.collect()) == [["1", "2", "3"], ["3", "4"]]
    assert (prepared.count, prepared.top_items) == (2, None)


def written_by(monkeypatch, module):
    """(name, frame) of every table that a module writes."""
    made = []

    def write(df, name, *rest, materialize=module.materialize):
        made.append((name, materialize(df, name, *rest)))
        return made[-1][1]

    monkeypatch.setattr(module, "materialize", write)
    return made


def test_apriori_levels_do_not_meet_the_orders_again(spark, monkeypatch):
    prepared = B.prepare_baskets(lines_of(spark, BASKETS), min_items=2)
    made = written_by(monkeypatch, I)
    itemsets = I.apriori_itemsets(prepared, 0.2)
    assert {tuple(r["items"]): r.freq for r in itemsets.collect()} == brute_itemsets(BASKETS, 0.2)
    assert len(made) > 5 and not any("order_id" in df.columns for _, df in made)


def test_closures_ask_two_baskets_before_the_others(spark, monkeypatch):
    """One item is in all of 60 baskets and a rarer one in its first and last, but not in all."""
    baskets = [[1, 2, 10 + i] for i in range(60)]
    baskets[0], baskets[30], baskets[59] = [1, 2, 3], [1, 3], [1, 2, 3]
    prepared = B.prepare_baskets(lines_of(spark, baskets), min_items=2)
    made = written_by(monkeypatch, I)
    closed = I.closed_itemsets(prepared, 2 / 60)
    assert {tuple(r["items"]): r.freq for r in closed.collect()} == {
        ("1",): 60, ("1", "2"): 59, ("1", "3"): 3, ("1", "2", "3"): 2}
    # An extension is one row, whatever the number of its baskets.
    assert all(df.count() < 60 for name, df in made if name in ("extensions", "shared-by-two", "asked"))


def test_a_run_fits_no_candidate_twice(users, monkeypatch):
    fitted = []

    def fit(scaled, k, *rest, fit_kmeans=C.fit_kmeans):
        fitted.append(k)
        return fit_kmeans(scaled, k, *rest)

    monkeypatch.setattr(C, "fit_kmeans", fit)
    _, run = C.clustering_run(users, max_k=3, n_init=2)
    assert fitted == [2, 3]
    chosen = next(row for row in run["selection"] if row["selected"])
    assert run["training_metrics"]["inertia"] == pytest.approx(chosen["inertia"])


def test_closed_itemsets_are_the_same_however_nodes_are_counted(spark, monkeypatch):
    """Sets in many baskets are counted before they are shuffled, others where their baskets meet."""
    monkeypatch.setattr(I, "SMALL_LEVEL", 0)
    baskets = [[0, *basket[:4]] for basket in BASKETS] + [[0, 20, 21, 22]] * 3 + [[0, 22, 5, 30], [0, 30, 5]]
    prepared = B.prepare_baskets(lines_of(spark, baskets), min_items=2)
    for busy in (0, 10**6):
        monkeypatch.setattr(I, "BUSY_NODE", busy)
        found = {tuple(r["items"]): r.freq for r in I.closed_itemsets(prepared, 2 / prepared.count).collect()}
        assert found == brute_closed(brute_itemsets(baskets, 2 / len(baskets)))


def test_tasks_that_count_extensions_follow_the_number_of_baskets(spark, monkeypatch):
    """A held basket unfolds after the shuffle, so its bytes before say little of a task's memory."""
    baskets = [[i % 7, 10 + i % 5, 20 + i % 3] for i in range(60)]
    prepared = B.prepare_baskets(lines_of(spark, baskets), min_items=2)
    wanted = brute_closed(brute_itemsets(baskets, 2 / 60))
    plans = []
    monkeypatch.setattr(I, "materialize", lambda df, name, materialize=I.materialize: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()) if name == "extensions" else None,
        materialize(df, name))[1])
    monkeypatch.setattr(I, "HELD_PER_TASK", 5)
    found = {tuple(r["items"]): r.freq for r in I.closed_itemsets(prepared, 2 / 60).collect()}
    assert found == wanted
    # 60 baskets hold three items each.
    assert any("RepartitionByExpression" in plan and ", 36" in plan for plan in plans)


def test_tasks_that_count_extensions_are_not_merged_by_bytes(spark, monkeypatch):
    """A shuffle width above the tasks that are needed left their number to the bytes."""
    baskets = [[i % 7, 10 + i % 5, 20 + i % 3] for i in range(60)]
    prepared = B.prepare_baskets(lines_of(spark, baskets), min_items=2)
    plans = []
    monkeypatch.setattr(I, "materialize", lambda df, name, materialize=I.materialize: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()) if name == "extensions" else None,
        materialize(df, name))[1])
    monkeypatch.setattr(I, "HELD_PER_TASK", 5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        found = {tuple(r["items"]): r.freq for r in I.closed_itemsets(prepared, 2 / 60).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == brute_closed(brute_itemsets(baskets, 2 / 60))
    # 60 baskets hold three items each.
    assert any("RepartitionByExpression" in plan and ", 36" in plan for plan in plans)


def test_training_computes_its_features_once(spark, monkeypatch):
    columns = ", ".join(f"{name} double" for name in FE.FEATURES)
    users = spark.createDataFrame(
        [(i, float(i % 2 * 50 + i), float(i), i / 20, float(i % 3)) for i in range(12)],
        f"user_id bigint, {columns}").distinct()
    plans = []
    monkeypatch.setattr(C, "standardize", lambda features: (
        plans.append(features._jdf.queryExecution().optimizedPlan().toString()), FE.standardize(features))[1])
    fit, _ = C.train(users, 2, n_init=1)
    assert fit.frame.count() == 12
    assert len(plans) == 1 and "Aggregate" not in plans[0]


def test_baskets_of_single_items_are_not_written_again(spark, monkeypatch):
    """Only sets of two items and more have rows of their own; those in two baskets have two."""
    baskets = [[1, 10 + i, 40 + i % 20] for i in range(30)] * 2 + [[2, 70 + i] for i in range(20)] * 2
    prepared = B.prepare_baskets(lines_of(spark, baskets), min_items=2)
    made = written_by(monkeypatch, I)
    closed = I.closed_itemsets(prepared, 2 / 100)
    expected = {(1,): 60, (2,): 40, **{(1, 10 + i, 40 + i % 20): 2 for i in range(30)},
                **{(1, 40 + i): 4 for i in range(10)}, **{(2, 70 + i): 2 for i in range(20)}}
    assert {frozenset(r["items"]): r.freq for r in closed.collect()} == {
        frozenset(map(str, group)): freq for group, freq in expected.items()}
    held = [df for name, df in made if name == "held"]
    assert "frequent-lines" not in [name for name, _ in made] and sum(df.count() for df in held) < 100
