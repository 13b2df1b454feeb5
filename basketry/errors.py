"""Errors raised by contracts and argument guards."""


class DataQualityError(ValueError):
    """Source data or a loaded table breaks a data contract."""


class PipelineError(RuntimeError):
    """A load cannot start safely, or its result is incomplete."""


class BasketDataError(ValueError):
    """Baskets or itemsets that cannot be mined."""


class ClusteringDataError(ValueError):
    """Features or labels that cannot be clustered or scored."""


class RecommendationDataError(ValueError):
    """Rules, labels or carts that break the recommender's contract."""
