"""Command line: ``python -m basketry load | basket | cluster | recommend``.

Each command is one dataclass. Its fields are the options, and what a run records about
itself is its settings plus what it measured.
"""

import argparse
import json
import sys
import time
import types
from dataclasses import MISSING, asdict, dataclass, field, fields
from datetime import UTC, datetime
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.itemsets import itemset_json
from basketry.mining import baskets as B
from basketry.mining import clustering as C
from basketry.mining import features as FE
from basketry.mining import itemsets as I
from basketry.mining import recommend as R
from basketry.mining import rules as RU
from basketry.plans import pipeline
from basketry.plans.warehouse import open_warehouse
from basketry.sources import artifacts, files, order_tables, storage


def option(default=MISSING, help: str | None = None, **extra):
    """A field that is also a command-line option; without a default it is required."""
    known = {} if default is MISSING else {"default": default}
    return field(**known, metadata={"help": help, **extra})


def _kind(annotation):
    """The type behind ``X | None``."""
    if isinstance(annotation, types.UnionType):
        return next(kind for kind in annotation.__args__ if kind is not type(None))
    return annotation


def add_options(parser: argparse.ArgumentParser, command) -> None:
    for spec in fields(command):
        kind, settings = _kind(spec.type), dict(spec.metadata)
        if kind is bool:
            settings |= {"action": "store_true"}
        elif spec.default is MISSING:
            settings |= {"type": kind, "required": True}
        else:
            settings |= {"type": kind, "default": spec.default}
        if "nargs" in settings:
            settings["type"] = str
        parser.add_argument(f"--{spec.name.replace('_', '-')}", **settings)


@dataclass(frozen=True)
class Load:
    """Load the six sources into a warehouse."""

    warehouse: str = option()
    sources: str | None = option(None, "folder of the six CSV files")
    order_tables: str | None = option(None, "folder of orders, lineitem and part tables")
    reset_data: bool = option(False, "replace loaded data")
    yes: bool = option(False, "confirm --reset-data")
    validate_only: bool = option(False, "check without loading")
    dry_run: bool = option(False, "only look for the source files")

    def objection(self) -> str | None:
        if self.reset_data and not self.yes:
            return "--reset-data replaces loaded data and requires --yes"
        if self.reset_data and self.validate_only:
            return "--reset-data cannot be combined with --validate-only"
        if self.dry_run and not self.sources:
            return "--dry-run needs --sources"
        if not self.validate_only and bool(self.sources) == bool(self.order_tables):
            return "give one of --sources and --order-tables"
        return None

    def run(self, spark: SparkSession) -> None:
        if self.dry_run:
            paths = files.source_paths(self.sources)
            files.require_source_files(spark, paths, list(paths))
            print("All required source files are present.")
        elif self.validate_only:
            print(json.dumps(pipeline.validate_warehouse(spark, self.warehouse), indent=2))
        else:
            found = (files.read_sources(spark, self.sources) if self.sources
                     else order_tables.read_sources(spark, self.order_tables))
            _, report = pipeline.build_warehouse(
                found, self.warehouse, reset=self.reset_data, confirmed=self.yes)
            print(json.dumps(report, indent=2))


@dataclass(frozen=True)
class Job:
    """A command that leaves artifacts in a new folder, with a record of the run."""

    record: ClassVar[str]
    version: ClassVar[int] = 1

    warehouse: str = option()
    output: str = option(help="new folder for the artifacts")

    def objection(self) -> str | None:
        return None

    def run(self, spark: SparkSession) -> None:
        started, written = time.perf_counter(), []

        def keep(name: str, save) -> None:
            save(f"{self.output}/{name}")
            written.append(name)

        measured = self.work(spark, open_warehouse(spark, self.warehouse), keep)
        settings = {name: value for name, value in asdict(self).items() if name not in ("warehouse", "output")}
        facts = settings | measured | {
            "artifact_schema_version": self.version, "artifacts": written,
            "created_at": datetime.now(UTC).isoformat(),
            "elapsed_seconds": round(time.perf_counter() - started, 3),
        }
        text = json.dumps(facts, ensure_ascii=False, indent=2, sort_keys=True)
        storage.write_text(spark, f"{self.output}/{self.record}", text + "\n")

    def work(self, spark: SparkSession, wh, keep) -> dict:
        raise NotImplementedError


@dataclass(frozen=True)
class Basket(Job):
    """Mine itemsets and rules, of all orders unless a sample is asked for."""

    record: ClassVar[str] = "market_basket_metadata.json"

    order_limit: int | None = option(None, "mine a reproducible sample of so many orders")
    full: bool = option(False, "mine every order, which is the default")
    seed: int = option(B.DEFAULT_SEED)
    min_items: int = option(2)
    top_products: int | None = option(None, "keep only so many leading products")
    min_support: float = option(0.01)
    min_confidence: float = option(0.3)
    algorithm: str = option("fpgrowth", choices=("fpgrowth", "apriori"))

    def objection(self) -> str | None:
        return "give one of --full and --order-limit" if self.full and self.order_limit else None

    def work(self, spark: SparkSession, wh, keep) -> dict:
        lines = B.basket_lines(wh, limit=self.order_limit, seed=self.seed)
        prepared = B.prepare_baskets(
            lines, top_n=self.top_products, min_items=self.min_items, width=wh.task_width)
        mine = {"fpgrowth": I.frequent_itemsets, "apriori": I.apriori_itemsets}[self.algorithm]
        itemsets = mine(prepared, self.min_support)
        rules = RU.require_rules(
            RU.generate_rules(itemsets, min_threshold=self.min_confidence),
            min_threshold=self.min_confidence)
        names = RU.item_names(wh)
        keep("association_rules", lambda path: artifacts.save_rules(rules, path, names))
        keep("frequent_itemsets", lambda path: artifacts.save_frequent_itemsets(itemsets, path, names))
        self.show(RU.ordered_rules(RU.rules_with_names(RU.top_rules(rules), names)))
        return {
            "mode": "full" if self.order_limit is None else "deterministic_sample",
            "transactions": prepared.count,
            "frequent_itemsets": itemsets.count(),
            "association_rules": rules.count(),
        }

    @staticmethod
    def show(rules: DataFrame) -> None:
        sides = [itemset_json(F.col(f"{side}_names")).alias(f"{side}s") for side in ("antecedent", "consequent")]
        rules.select(*sides, "support", "confidence", "lift").show(20, truncate=False)


@dataclass(frozen=True)
class Cluster(Job):
    """Segment users."""

    record: ClassVar[str] = "clustering_metadata.json"

    min_orders: int = option(3)
    max_k: int = option(10)
    clusters: int | None = option(None, "use this K instead of the selected one")
    seed: int = option(C.DEFAULT_SEED)

    def work(self, spark: SparkSession, wh, keep) -> dict:
        features = FE.user_features(wh, self.min_orders)
        fit, run = C.clustering_run(
            features, k=self.clusters, max_k=self.max_k, min_orders=self.min_orders, seed=self.seed)
        projection, profiles = C.pca_2d(fit.frame), C.profile_clusters(fit.frame)
        keep("cluster_labels", lambda path: artifacts.save_cluster_labels(C.cluster_labels(fit.frame), path))
        keep("cluster_profiles", lambda path: artifacts.export_csv(profiles, path))
        keep("cluster_points", lambda path: artifacts.export_csv(projection.points, path))
        keep("kmeans_model", fit.model.save)
        profiles.show(truncate=False)
        return run | {
            "scaler": FE.fit_scaler(features),
            "centers": fit.centers,
            "pca_explained_variance_ratio": projection.explained,
            "cluster_profiles": [row.asDict() for row in profiles.collect()],
        }


@dataclass(frozen=True)
class Recommend:
    """Rank products for carts."""

    warehouse: str = option()
    rules: str = option()
    clusters: str = option()
    user_id: int | None = option(None)
    cart: list | None = option(None, "exact product names", nargs="+")
    carts: str | None = option(None, "Parquet of (cart_id, user_id, items)")
    output: str | None = option(None, "write the ranking here instead of showing it")
    top_n: int = option(10)
    rule_weight: float = option(0.6)
    cluster_weight: float = option(0.4)
    rrf_k: int = option(60)

    def objection(self) -> str | None:
        return None if self.carts or self.cart and self.user_id else "give --carts, or --user-id with --cart"

    def run(self, spark: SparkSession) -> None:
        carts = (
            spark.read.parquet(self.carts).select("cart_id", "user_id", "items") if self.carts
            else spark.createDataFrame(
                [(1, self.user_id, self.cart)], "cart_id bigint, user_id bigint, items array<string>"))
        ranking = R.hybrid_recommend(
            open_warehouse(spark, self.warehouse), carts,
            artifacts.load_association_rules(spark, self.rules),
            artifacts.load_cluster_labels(spark, self.clusters),
            self.top_n, rule_weight=self.rule_weight, cluster_weight=self.cluster_weight,
            k=self.rrf_k, item_space="name")
        if self.output:
            ranking.write.parquet(self.output)
        else:
            ranking.orderBy("cart_id", "place").show(self.top_n, truncate=False)


COMMANDS = {"load": Load, "basket": Basket, "cluster": Cluster, "recommend": Recommend}


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(prog="basketry", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, command in COMMANDS.items():
        add_options(commands.add_parser(name, help=command.__doc__), command)
    given = vars(parser.parse_args(argv))
    name = given.pop("command")
    command = COMMANDS[name](**given)
    if objection := command.objection():
        parser.error(objection)
    spark = SparkSession.builder.appName(f"basketry {name}").getOrCreate()
    try:
        command.run(spark)
    except (ValueError, RuntimeError) as error:
        print(f"{name} failed: {type(error).__name__}: {error}", file=sys.stderr)
        return 1
    return 0
