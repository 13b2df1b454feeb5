"""Labels derived from names, counts and days."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ordered keyword rules; the first label with a matching keyword wins.
DEPARTMENT_RULES = (
    ("Food", ("produce", "frozen", "meat", "seafood", "deli")),
    ("Beverage", ("dairy", "beverage", "alcohol")),
    ("Personal Care", ("personal", "beauty", "health")),
    ("Household", ("household", "pets")),
)
AISLE_RULES = (
    ("Fresh", ("fresh", "produce", "fruit", "vegetable")),
    ("Frozen", ("frozen", "ice")),
    ("Beverage", ("beverage", "drink", "juice", "soda", "water")),
    ("Snacks", ("snack", "candy", "chocolate", "cookies")),
    ("Dairy", ("dairy", "milk", "yogurt", "cheese")),
    ("Dry Goods", ("packaged", "canned", "dry")),
)
# Fixed value: the label of names that no rule fits.
DEFAULT_LABEL = "General"

# Smallest order count of each customer label, largest first.
SEGMENT_FLOORS = ((50, "VIP"), (20, "Frequent"), (10, "Regular"))
SEGMENT_ORDER = ("VIP", "Frequent", "Regular", "New")
CLUSTER_FLOORS = (
    (50, "VIP Customers"), (20, "Frequent Shoppers"), (10, "Regular Customers"),
)

# Largest basket of each closed band.
BAND_CEILINGS = (
    (1, 5, "1-5 items"), (6, 10, "6-10 items"), (11, 20, "11-20 items"), (21, 30, "21-30 items"),
)

# Names of days from Sunday on, and of quarters of a day.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
HOUR_RANGES = ("00-06 Night", "06-12 Morning", "12-18 Afternoon", "18-24 Evening")


# White space of any script at either end.
AROUND = r"(?U)^\s+|\s+$"


def _cascade(cases, default) -> Column:
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def classify(name: Column, rules, default: str = DEFAULT_LABEL) -> Column:
    """Label of the first rule with a keyword inside the lower-cased name without the white
    space around it."""
    text = F.lower(F.regexp_replace(name, AROUND, ""))
    return _cascade(
        [(text.rlike("|".join(words)), F.lit(label)) for label, words in rules], F.lit(default)
    )


def _floor_label(value: Column, floors, default: str) -> Column:
    return _cascade([(value >= floor, F.lit(label)) for floor, label in floors], F.lit(default))


def user_segment(order_count: Column) -> Column:
    return _floor_label(order_count, SEGMENT_FLOORS, "New")


def cluster_name(mean_orders: Column) -> Column:
    return _floor_label(mean_orders, CLUSTER_FLOORS, "Occasional Buyers")


def basket_band(items: Column, last: str) -> Column:
    """Band label; ``last`` names whatever the four closed bands leave over."""
    return _cascade(
        [(items.between(low, high), F.lit(label)) for low, high, label in BAND_CEILINGS],
        F.lit(last),
    )


def band_order(items: Column) -> Column:
    return _cascade(
        [(items.between(low, high), F.lit(place))
         for place, (low, high, _) in enumerate(BAND_CEILINGS, start=1)],
        F.lit(len(BAND_CEILINGS) + 1),
    )


def day_type(is_weekend: Column) -> Column:
    return F.when(is_weekend, F.lit("Weekend")).otherwise(F.lit("Weekday"))


def pick(names, position: Column) -> Column:
    """Element of a fixed list by its zero-based position."""
    return F.element_at(F.array(*[F.lit(name) for name in names]), position + 1)
