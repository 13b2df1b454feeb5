"""Every operator as a query over an input folder: name -> (spark, folder) -> DataFrame."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions import labels as L
from basketry.functions.itemsets import itemset_from_json, itemset_json
from basketry.mining import baskets as B
from basketry.mining import clustering as C
from basketry.mining import features as FE
from basketry.mining import itemsets as I
from basketry.mining import recommend as R
from basketry.mining import rules as RU
from basketry.operators import analysis, checks, contracts, explorer, kpis, reshape, transforms
from basketry.plans import pipeline
from basketry.plans.mart import open_mart
from basketry.plans.warehouse import Warehouse, open_fact, table_counts
from basketry.schemas import PARTITION_COLUMN, SOURCES, TABLES
from basketry.session import materialize, work_folder
from basketry.sources import artifacts, files

# Thresholds that fit tables of any size. Aisles are few, so shares of all baskets hold; with the
# catalogue every single product's share shrinks, so products need a count.
AISLE_SUPPORT = 0.002
AISLE_CONFIDENCE = 0.15
PRODUCT_MIN_COUNT = 2
PRODUCT_CONFIDENCE = 0.05
# Percent of all lines that a ranked aisle has at least.
AISLE_SHARE_PCT = 3
# Candidates that the popularity report lists per cluster.
POPULAR = 50

_SCORES = ("silhouette", "davies_bouldin", "inertia")


def plain(df: DataFrame) -> DataFrame:
    """Stored decimals as doubles, for comparison by value."""
    return df.select(*[
        F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema
    ])


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles that come from sums of doubles, without the digits that depend on row order."""
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name) for f in df.schema
    ])


def _fresh(spark, name: str) -> str:
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"


# --- sources and the load -------------------------------------------------------------

def _source(name):
    return lambda spark, folder: plain(open_mart(spark, folder).sources[name])


def source_order_lines(spark, folder):
    sources = open_mart(spark, folder).sources
    return reduce(DataFrame.unionAll, [
        sources[f"order_products_{name}"].select("*", F.lit(name).alias("eval_set"))
        for name in ("prior", "train")
    ])


def read_sources(spark, folder):
    """Row counts of the six sources after a trip through CSV files."""
    target = _fresh(spark, "csv")
    paths = files.source_paths(target)
    for name, df in open_mart(spark, folder).sources.items():
        artifacts.export_csv(df, paths[name])
    sources = files.read_sources(spark, target)
    contracts.enforce_sources(sources)
    return reduce(DataFrame.unionAll, [
        sources[name].agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("dataset"), "row_count") for name in SOURCES
    ])


def csv_orders(spark, folder):
    """Order facts transformed from the CSV form of the orders source."""
    path = _fresh(spark, "csv-orders")
    artifacts.export_csv(open_mart(spark, folder).sources["orders"], path)
    text = files.read_csv(spark, path, SOURCES["orders"][1])
    return plain(transforms.transform_orders(text).drop("total_items", "reorder_ratio"))


def _table(name):
    return lambda spark, folder: plain(open_mart(spark, folder).warehouse.table(name)).drop(
        "order_range"
    )


def _warehouse(query):
    return lambda spark, folder: query(open_mart(spark, folder).warehouse)


def write_fact(spark, folder):
    """Directories and rows of a freshly written partitioned fact."""
    wh = open_mart(spark, folder).warehouse
    target = _fresh(spark, "facts")
    pipeline.write_table(pipeline.dealt(wh.fact_orders, wh.buckets), "fact_orders", target, wh.buckets)
    written = spark.read.schema(TABLES["fact_orders"]).parquet(f"{target}/fact_orders")
    return written.groupBy("order_dow").agg(F.count(F.lit(1)).alias("row_count"))


def write_dimension(spark, folder):
    wh = open_mart(spark, folder).warehouse
    target = _fresh(spark, "dimensions")
    counts = [
        (name, pipeline.write_table(wh.table(name), name, target))
        for name in TABLES if name not in PARTITION_COLUMN
    ]
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


def resolve_detail_time_ids(spark, folder):
    """Lines whose time key changes when open keys are resolved from their orders."""
    mart = open_mart(spark, folder)
    lines = reduce(DataFrame.unionAll, [
        transforms.transform_order_details(mart.sources[f"order_products_{name}"])
        for name in ("prior", "train")
    ])
    resolved = transforms.resolve_detail_times(lines, mart.warehouse.fact_orders)
    return resolved.groupBy("time_id").agg(F.count_if("changed").alias("resolved_lines"))


def resolve_stored_times(spark, folder):
    """Per range of a copy of the lines, some of whose keys are open: lines that resolving them
    updates, lines that a second run updates, and lines that are open in the end."""
    wh = open_mart(spark, folder).warehouse
    target, name = _fresh(spark, "lines"), "fact_order_details"
    some = (F.col("order_range") == 2) | ((F.col("order_range") == 5) & (F.col("product_id") % 10 == 0))
    opened = wh.fact_order_details.withColumn("time_id", F.when(~some, F.col("time_id")))
    pipeline.write_table(pipeline.dealt(opened, wh.buckets), name, target, wh.buckets)
    lines = lambda: open_fact(spark, target, name, wh.buckets)
    copy = Warehouse({**wh._tables, name: lines()}, wh.range_width, target, wh.buckets)
    first, second = pipeline.resolve_stored_times(copy), pipeline.resolve_stored_times(copy)
    left = lines().groupBy("order_range").agg(F.count_if(F.col("time_id").isNull()).alias("open_lines"))
    return left.join(first, "order_range", "left").join(
        second.withColumnRenamed("updated_lines", "again"), "order_range", "left").select(
        "order_range", F.coalesce("updated_lines", F.lit(0)).alias("updated_lines"),
        F.coalesce("again", F.lit(0)).alias("updated_again"), "open_lines")


def run_report(spark, folder):
    """Stages and rows of the load; its times differ from run to run."""
    report = pipeline.run_report(spark, open_mart(spark, folder).root)
    return report.where("status = 'succeeded'").select("stage", "stage_rows")


def dim_time(wh):
    """The calendar with the orders of every hour."""
    orders = wh.fact_orders.groupBy("time_id").agg(F.count(F.lit(1)).alias("n"))
    return wh.dim_time.join(F.broadcast(orders), "time_id", "left").withColumn(
        "orders", F.coalesce("n", F.lit(0))).drop("n")


def _order_metrics(wh):
    return plain(transforms.order_metrics(wh.fact_order_details))


def _basket_bands(wh):
    items = F.col("total_items")
    return wh.fact_orders.groupBy(
        L.band_order(items).alias("band_order"),
        L.basket_band(items, "30+ items").alias("short_label"),
        L.basket_band(items, "31+ items").alias("long_label"),
    ).agg(F.count(F.lit(1)).alias("orders"))


def _day_types(wh):
    orders = wh.fact_orders.groupBy("time_id").agg(F.count(F.lit(1)).alias("n"))
    return orders.join(wh.dim_time, "time_id").groupBy(
        L.day_type(F.col("is_weekend")).alias("day_type")
    ).agg(F.sum("n").alias("orders"))


def _aisle_minimum(wh):
    return wh.fact_order_details.count() * AISLE_SHARE_PCT // 100


def _purchase_minimum(wh):
    """The mean number of lines per sold product."""
    row = wh.fact_order_details.groupBy("product_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("lines"), F.count(F.lit(1)).alias("products")).first()
    return (row["lines"] or 0) // max(row["products"], 1)


def _cluster_names(wh):
    return wh.dim_user.groupBy(L.cluster_name(F.col("total_orders")).alias("cluster_name")).agg(
        F.count(F.lit(1)).alias("users")
    )


# --- contracts over unclean input -----------------------------------------------------

def raw_line_violations(spark, folder):
    """The line contract held against line items as they are stored."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("add_to_cart_order"),
        (F.col("l_linenumber") % 3).alias("reordered"),
    )
    rules = contracts.CONTRACTS["order_products_prior"]
    return contracts.rule_violations(lines, "lineitem", rules)


def raw_order_violations(spark, folder):
    """The order contract held against orders as they are stored."""
    key = F.col("o_orderkey")
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(key % 3 == 0, F.lit("prior")).otherwise(F.col("o_orderstatus")).alias("eval_set"),
        (key % 5).alias("order_number"),
        (key % 8).alias("order_dow"),
        (key % 25).alias("order_hour_of_day"),
        F.when(key % 7 != 0, key % 33).alias("days_since_prior_order"),
    )
    return contracts.rule_violations(orders, "orders", contracts.CONTRACTS["orders"])


def raw_product_violations(spark, folder):
    """The product contract held against ids and names as loose text."""
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    suffix = F.when(size % 10 == 0, ".5").when(size % 10 == 1, ".0").when(size % 10 == 2, "d")
    part = spark.read.parquet(f"{folder}/part.parquet").select(
        F.concat(key, suffix.otherwise("")).alias("product_id"),
        F.when(size % 9 == 0, F.lit("  ")).when(size % 9 != 1, F.col("p_name"))
        .alias("product_name"),
        size.cast("string").alias("aisle_id"),
        (size % 4).alias("department_id"),
    )
    return contracts.rule_violations(part, "products", contracts.CONTRACTS["products"])


# --- mining ---------------------------------------------------------------------------

def _lines(wh, item):
    return B.basket_lines(wh, item=item)


def sample_orders(wh):
    return B.sample_orders(wh, 5_000)


def sampled_baskets(wh):
    lines = B.basket_lines(wh, limit=5_000)
    return _basket_json(B.baskets(lines))


def _basket_json(df):
    return df.select("order_id", F.size("items").alias("item_count"),
                     F.to_json("items").alias("items_json"))


def _baskets(wh, item, **options):
    # Lines of products lie where their orders do; those of aisles may have been moved.
    buckets = wh.buckets if item == "product" else None
    return B.prepare_baskets(_lines(wh, item), width=wh.task_width, buckets=buckets, **options)


def _aisle_itemsets(wh, mine=I.frequent_itemsets):
    return mine(_baskets(wh, "aisle"), AISLE_SUPPORT)


def _mined_products(wh, mine=I.frequent_itemsets_by_closure):
    baskets = _baskets(wh, "product")
    return baskets, mine(baskets, min(1.0, PRODUCT_MIN_COUNT / baskets.count))


def _product_itemsets(wh):
    return _mined_products(wh)[1]


def closed_itemsets(wh):
    return _itemset_rows(_mined_products(wh, I.closed_itemsets)[1])


def _itemset_rows(itemsets):
    return I.ordered_itemsets(itemsets).select(
        itemset_json(F.col("items")).alias("itemsets_json"), "freq", "support", "length"
    )


def _aisle_rules(wh):
    return RU.generate_rules(_aisle_itemsets(wh), min_threshold=AISLE_CONFIDENCE)


def _product_rules(wh):
    return RU.generate_rules(_product_itemsets(wh), min_threshold=PRODUCT_CONFIDENCE)


def _named_rules(wh):
    rules = RU.rules_with_names(_product_rules(wh), RU.item_names(wh))
    return materialize(rules, "named-rules")


_KEPT_RULES: dict[tuple, DataFrame] = {}


def _kept_rules(wh):
    """The rules that carts are matched with: mined once for a loaded warehouse, then an artifact."""
    key = (wh.spark.sparkContext.applicationId, wh.folder)
    if key not in _KEPT_RULES:
        _KEPT_RULES[key] = _named_rules(wh)
    return _KEPT_RULES[key]


def _rule_names(wh):
    return _named_rules(wh).select(
        itemset_json(F.col("antecedents")).alias("antecedents_json"),
        itemset_json(F.col("consequents")).alias("consequents_json"),
        itemset_json(F.col("antecedent_names")).alias("antecedent_names_json"),
        itemset_json(F.col("consequent_names")).alias("consequent_names_json"),
    )


def save_rules(spark, folder):
    wh = open_mart(spark, folder).warehouse
    path = _fresh(spark, "rules")
    artifacts.save_rules(_product_rules(wh), path, RU.item_names(wh))
    text = artifacts.read_text_csv(spark, path)
    return text.select(*[
        F.col(name).cast("double") if name in RU.METRICS else F.col(name) for name in text.columns
    ])


def save_frequent_itemsets(spark, folder):
    wh = open_mart(spark, folder).warehouse
    path = _fresh(spark, "itemsets")
    artifacts.save_frequent_itemsets(_product_itemsets(wh), path, RU.item_names(wh))
    return artifacts.read_text_csv(spark, path).select(
        "itemsets_json", F.col("support").cast("double").alias("support"),
        F.col("length").cast("int").alias("length"), "item_names_json",
    )


def load_association_rules(spark, folder):
    wh = open_mart(spark, folder).warehouse
    path = _fresh(spark, "rules")
    artifacts.save_rules(_product_rules(wh), path, RU.item_names(wh))
    rules = artifacts.load_association_rules(spark, path)
    return rules.select(
        *[F.to_json(name).alias(name) if isinstance(rules.schema[name].dataType, T.ArrayType)
          else F.col(name) for name in rules.columns]
    )


def itemset_json_forms(spark, folder):
    """Names and ids of every product as JSON, and what parsing accepts of it."""
    wh = open_mart(spark, folder).warehouse
    name, key = F.col("product_name"), F.col("product_id")
    texts = wh.dim_product.select(
        "product_id",
        itemset_json(F.array(name, F.upper(name), key.cast("string"))).alias("names_json"),
        F.when(key % 4 == 0, F.concat(F.lit("["), key.cast("string"), F.lit(',"a"]')))
        .when(key % 4 == 1, F.concat(F.lit("["), key.cast("string"), F.lit(",true]")))
        .when(key % 4 == 2, F.concat(F.lit("["), key.cast("string"), F.lit(".5]")))
        .otherwise(F.concat(F.lit('{"a":'), key.cast("string"), F.lit("}"))).alias("loose"),
    )
    return texts.select(
        "product_id", "names_json",
        F.to_json(F.array_sort(itemset_from_json(F.col("loose")))).alias("parsed"),
        F.size(itemset_from_json(F.col("names_json"))).alias("names"),
    )


def basket_run(wh):
    """Settings and sizes of one mining run."""
    baskets, itemsets = _mined_products(wh)
    rules = RU.generate_rules(itemsets, min_threshold=PRODUCT_CONFIDENCE)
    sizes = itemsets.agg(
        F.count(F.lit(1)).alias("frequent_itemsets"),
        F.count_if(F.col("length") == 1).alias("frequent_items"),
    ).unionByName(rules.agg(F.count(F.lit(1)).alias("association_rules")), allowMissingColumns=True)
    return sizes.agg(*[F.max(name).alias(name) for name in sizes.columns]).select(
        F.lit("full").alias("mode"), F.lit(B.DEFAULT_SEED).alias("random_state"),
        F.lit(baskets.min_items).alias("min_items"),
        F.lit(baskets.count).cast("bigint").alias("transactions"),
        F.lit(baskets.top_items).cast("int").alias("top_products"),
        F.lit(PRODUCT_MIN_COUNT).alias("min_count"),
        F.lit(PRODUCT_CONFIDENCE).alias("min_confidence"), "*",
    )


def _segment_labels(wh):
    """A labelling that needs no model: users by their segment."""
    codes = F.create_map(*[F.lit(v) for i, name in enumerate(L.SEGMENT_ORDER) for v in (name, i)])
    return wh.dim_user.select(
        "user_id", codes[F.col("user_segment")].cast("bigint").alias("cluster")
    )


def _segmented(wh):
    features = materialize(FE.user_features(wh), "features")
    FE.require_features(features)
    return materialize(
        FE.standardize(features).join(_segment_labels(wh), "user_id"), "segmented")


def _silhouette_given(wh):
    return rounded(C.squared_silhouette(_segmented(wh)), 6)


def _davies_bouldin_given(spark, folder):
    labelled = _segmented(open_mart(spark, folder).warehouse)
    return spark.createDataFrame([(round(C.davies_bouldin(labelled), 6),)], "davies_bouldin double")


def _inertia_given(wh):
    labelled = _segmented(wh)
    spread = [F.var_pop(name) * F.count(name) for name in FE.SCALED]
    inside = labelled.groupBy("cluster").agg(sum(spread).alias("inertia"))
    return inside.agg(F.round(F.sum("inertia"), 6).alias("inertia"))


def _trained(wh, k=3):
    return C.train(FE.user_features(wh), k)


def fit_kmeans(wh):
    return C.cluster_labels(_trained(wh)[0].frame)


def cluster_metrics(spark, folder):
    _, metrics = _trained(open_mart(spark, folder).warehouse)
    return spark.createDataFrame([tuple(metrics[name] for name in _SCORES)],
                                 ", ".join(f"{name} double" for name in _SCORES))


def clustering_run(spark, folder):
    """Candidates of K with their scores, and the chosen one."""
    features = FE.user_features(open_mart(spark, folder).warehouse)
    _, run = C.clustering_run(features)
    rows = [
        (run["n_users"], run["random_state"], run["selected_k"], run["selected_k_source"],
         row["k"], row["inertia"], row["silhouette"], row["selected"])
        for row in run["selection"]
    ]
    return spark.createDataFrame(
        rows, "n_users bigint, random_state int, selected_k int, selected_k_source string, "
        "k int, inertia double, silhouette double, selected boolean",
    )


def pca_points(wh):
    return C.pca_2d(_trained(wh)[0].frame).points


def pca_of_segments(wh):
    return rounded(C.pca_2d(_segmented(wh)).points, 5)


def kmeans_invariants(wh):
    return C.fit_invariants(_trained(wh)[0])


def pca_variance(spark, folder):
    """The share of all variance that each component explains."""
    explained = C.pca_2d(_segmented(open_mart(spark, folder).warehouse)).explained
    return spark.createDataFrame(
        [(f"pc{place}", round(share, 6)) for place, share in enumerate(explained, start=1)],
        "component string, explained_variance_ratio double")


def sampled_silhouette(wh):
    return C.bounded_silhouette(_segmented(wh), sample_size=500)


def _saved_labels(spark, folder):
    path = _fresh(spark, "labels")
    labels = _segment_labels(open_mart(spark, folder).warehouse)
    artifacts.save_cluster_labels(labels, path)
    return path


def save_cluster_labels(spark, folder):
    text = artifacts.read_text_csv(spark, _saved_labels(spark, folder))
    return text.select("user_id", "cluster")


def load_cluster_labels(spark, folder):
    return artifacts.load_cluster_labels(spark, _saved_labels(spark, folder))


# --- recommendations ------------------------------------------------------------------

def mixed_carts(wh):
    """Carts of names for odd users and of ids for even ones."""
    carts = R.last_order_carts(wh)
    ids = F.transform("items", lambda name: F.substring_index(name, "#", -1))
    return carts.withColumn("items", F.when(F.col("user_id") % 2 == 1, F.col("items")).otherwise(ids))


def resolve_item_space(wh):
    return R.resolve_item_space(mixed_carts(wh), _kept_rules(wh)).select("cart_id", "space")


def recommend_by_rules(wh):
    return rounded(R.recommend_by_rules(mixed_carts(wh), _kept_rules(wh), 5), 12)


def cluster_popularity(wh):
    return R.cluster_popularity(wh, _segment_labels(wh), POPULAR)


def recommend_by_cluster(wh):
    labels = R.require_labels(_segment_labels(wh))
    carts = R.last_order_carts(wh).withColumn("space", F.lit("name"))
    popular = R.cluster_popularity(wh, labels, R.candidate_limit(wh, carts, 5))
    return R.recommend_by_cluster(carts, labels, popular, 5)


def hybrid_recommend(wh):
    labels = R.require_labels(_segment_labels(wh))
    return R.hybrid_recommend(
        wh, R.last_order_carts(wh), _kept_rules(wh), labels, 10, item_space="name"
    )


def export_csv(spark, folder):
    path = _fresh(spark, "export")
    artifacts.export_csv(kpis.departments(open_mart(spark, folder).warehouse), path)
    text = artifacts.read_text_csv(spark, path)
    return text.select(
        "department_name",
        *[F.col(name).cast("bigint").alias(name) for name in ("orders", "total_items")],
        F.col("market_share_pct").cast("double").alias("market_share_pct"),
    )


QUERIES = {
    # sources, sinks and the load
    "read_sources": read_sources,
    "csv_orders": csv_orders,
    "source_departments": _source("departments"),
    "source_aisles": _source("aisles"),
    "source_products": _source("products"),
    "source_orders": _source("orders"),
    "source_order_lines": source_order_lines,
    "write_fact": write_fact,
    "write_dimension": write_dimension,
    "run_report": run_report,
    "export_csv": export_csv,
    **{name: _table(name) for name in TABLES if name != "dim_time"},
    "dim_time": _warehouse(dim_time),
    "resolve_detail_time_ids": resolve_detail_time_ids,
    "resolve_stored_times": resolve_stored_times,
    "order_metrics": _warehouse(_order_metrics),
    "basket_bands": _warehouse(_basket_bands),
    "day_types": _warehouse(_day_types),
    "cluster_names": _warehouse(_cluster_names),
    # looking at the warehouse
    "table_counts": _warehouse(table_counts),
    "table_catalog": _warehouse(explorer.table_catalog),
    "table_sample": _warehouse(lambda wh: plain(explorer.table_sample(wh, "fact_orders", 10))),
    "table_columns": _warehouse(lambda wh: explorer.table_columns(wh, "fact_orders")),
    "table_profile": _warehouse(lambda wh: explorer.table_partitions(wh, "fact_orders")),
    "detail_partitions": _warehouse(lambda wh: explorer.table_partitions(wh, "fact_order_details")),
    "readiness_check": _warehouse(explorer.readiness_check),
    "refresh_statistics": _warehouse(
        lambda wh: explorer.refresh_statistics(wh).drop("size_bytes")),
    # contracts
    "source_violations": lambda spark, folder: contracts.source_violations(
        open_mart(spark, folder).sources),
    "raw_line_violations": raw_line_violations,
    "raw_order_violations": raw_order_violations,
    "raw_product_violations": raw_product_violations,
    "warehouse_checks": _warehouse(checks.warehouse_checks),
    "sql_quality_checks": _warehouse(checks.sql_quality_checks),
    "detail_time_reconciliation": _warehouse(checks.detail_time_reconciliation),
    "derived_metric_checks": _warehouse(checks.derived_metric_checks),
    "column_checks": _warehouse(checks.column_checks),
    "foreign_key_checks": _warehouse(checks.foreign_key_checks),
    "reconcile_totals": _warehouse(checks.reconcile_totals),
    # business queries
    "top_products": _warehouse(analysis.top_products),
    "peak_hours": _warehouse(analysis.peak_hours),
    "day_of_week": _warehouse(analysis.day_of_week),
    "department_performance": _warehouse(analysis.department_performance),
    "customer_segmentation": _warehouse(analysis.customer_segmentation),
    "aisle_reorder": _warehouse(lambda wh: analysis.aisle_reorder(wh, _aisle_minimum(wh))),
    "basket_size_distribution": _warehouse(analysis.basket_size_distribution),
    "weekend_vs_weekday": _warehouse(analysis.weekend_vs_weekday),
    "product_reorder_patterns": _warehouse(
        lambda wh: analysis.product_reorder_patterns(wh, _purchase_minimum(wh))),
    "sunday_orders": _warehouse(analysis.sunday_orders),
    "weekend_counts": _warehouse(analysis.weekend_counts),
    "all_day_counts": _warehouse(analysis.all_day_counts),
    "order_range_lines": _warehouse(lambda wh: analysis.order_range_lines(wh, 500, 9_000)),
    "summary_statistics": _warehouse(analysis.summary_statistics),
    # repository aggregates
    "overview_kpis": _warehouse(kpis.overview_kpis),
    "day_trends": _warehouse(kpis.day_trends),
    "hour_trends": _warehouse(kpis.hour_trends),
    "weekend_comparison": _warehouse(kpis.weekend_comparison),
    "departments": _warehouse(kpis.departments),
    "products": _warehouse(kpis.products),
    "products_in_department": _warehouse(lambda wh: kpis.products(wh, 100, " Dairy EGGS ")),
    "aisles": _warehouse(lambda wh: kpis.aisles(wh, min_items=_aisle_minimum(wh))),
    "customer_segments": _warehouse(kpis.customer_segments),
    "basket_distribution": _warehouse(kpis.basket_distribution),
    # page-level reshaping
    "condense_departments": _warehouse(
        lambda wh: rounded(reshape.condense_departments(kpis.departments(wh), 3))),
    "normalized_comparison": _warehouse(
        lambda wh: reshape.normalized_comparison(kpis.departments(wh), "produce", "frozen")),
    "contribution_gap": _warehouse(
        lambda wh: rounded(reshape.contribution_gap(kpis.customer_segments(wh)))),
    "ordered_segments": _warehouse(
        lambda wh: reshape.ordered_segments(kpis.customer_segments(wh))),
    "segment_share_long": _warehouse(
        lambda wh: reshape.segment_share_long(kpis.customer_segments(wh))),
    "weekend_lift": _warehouse(
        lambda wh: rounded(reshape.weekend_lift(kpis.weekend_comparison(wh)))),
    "extremes": _warehouse(lambda wh: reshape.extremes(wh, _aisle_minimum(wh))),
    "search_products": _warehouse(lambda wh: reshape.search_products(wh, " GIZMO")),
    "largest_departments": _warehouse(
        lambda wh: reshape.largest_departments(kpis.departments(wh), 4)),
    "department_gap": _warehouse(
        lambda wh: reshape.department_gap(kpis.departments(wh), "produce", "frozen")),
    # market baskets
    "sample_orders": _warehouse(sample_orders),
    "baskets": _warehouse(lambda wh: _basket_json(B.baskets(_lines(wh, "product")))),
    "sampled_baskets": _warehouse(sampled_baskets),
    "top_items": _warehouse(lambda wh: B.top_items(_lines(wh, "product"), 500)),
    "prune_baskets": _warehouse(lambda wh: _basket_json(
        _baskets(wh, "product", top_n=500).frame)),
    "frequent_itemsets": _warehouse(lambda wh: _itemset_rows(_aisle_itemsets(wh))),
    "frequent_itemsets_products": _warehouse(lambda wh: _itemset_rows(_product_itemsets(wh))),
    "closed_itemsets": _warehouse(closed_itemsets),
    "apriori_itemsets": _warehouse(
        lambda wh: _itemset_rows(_aisle_itemsets(wh, I.apriori_itemsets))),
    "generate_rules": _warehouse(lambda wh: RU.rule_json(_aisle_rules(wh))),
    "generate_rules_products": _warehouse(lambda wh: RU.rule_json(_product_rules(wh))),
    "top_rules": _warehouse(lambda wh: RU.rule_json(RU.top_rules(_aisle_rules(wh), 20))),
    "rules_with_names": _warehouse(_rule_names),
    "itemset_json": itemset_json_forms,
    "basket_run": _warehouse(basket_run),
    "save_rules": save_rules,
    "save_frequent_itemsets": save_frequent_itemsets,
    "load_association_rules": load_association_rules,
    # clustering
    "user_features": _warehouse(FE.user_features),
    "feature_violations": _warehouse(lambda wh: FE.feature_violations(FE.user_features(wh, 2))),
    "standardize": _warehouse(lambda wh: rounded(
        FE.standardize(FE.user_features(wh)).select("user_id", *FE.SCALED), 6)),
    "silhouette_of_segments": _warehouse(_silhouette_given),
    "davies_bouldin_of_segments": _davies_bouldin_given,
    "inertia_of_segments": _warehouse(_inertia_given),
    "profile_of_segments": _warehouse(lambda wh: rounded(C.profile_clusters(_segmented(wh)))),
    "fit_kmeans": _warehouse(fit_kmeans),
    "cluster_metrics": cluster_metrics,
    "profile_clusters": _warehouse(lambda wh: C.profile_clusters(_trained(wh)[0].frame)),
    "bounded_silhouette": _warehouse(sampled_silhouette),
    "kmeans_invariants": _warehouse(kmeans_invariants),
    "pca_2d": _warehouse(pca_points),
    "pca_of_segments": _warehouse(pca_of_segments),
    "pca_variance": pca_variance,
    "clustering_run": clustering_run,
    "save_cluster_labels": save_cluster_labels,
    "load_cluster_labels": load_cluster_labels,
    # recommendations
    "resolve_item_space": _warehouse(resolve_item_space),
    "recommend_by_rules": _warehouse(recommend_by_rules),
    "cluster_popularity": _warehouse(cluster_popularity),
    "recommend_by_cluster": _warehouse(recommend_by_cluster),
    "hybrid_recommend": _warehouse(hybrid_recommend),
    "evaluate_rules": _warehouse(lambda wh: rounded(R.evaluate_rules(_aisle_rules(wh)))),
}
