"""Itemsets as JSON arrays, for sinks that only hold text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def itemset_json(items: Column) -> Column:
    """Compact JSON array, ordered without regard to case, then by the text itself."""
    def compare(a, b):
        la, lb = F.lower(a), F.lower(b)
        return (
            F.when(la < lb, -1).when(la > lb, 1)
            .when(a < b, -1).when(a > b, 1).otherwise(0)
        )

    return F.to_json(F.array_sort(items, compare))


def itemset_from_json(text: Column) -> Column:
    """Distinct items of a JSON array of strings and whole numbers; NULL for anything else."""
    value = F.try_parse_json(text)
    elements = F.try_variant_get(value, "$", "array<variant>")
    kinds = F.transform(elements, lambda v: F.schema_of_variant(v))
    texts = F.transform(elements, lambda v: F.try_variant_get(v, "$", "string"))
    return F.when(
        F.forall(kinds, lambda k: k.isin("STRING", "BIGINT")), F.array_distinct(texts)
    )
