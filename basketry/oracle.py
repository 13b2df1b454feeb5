"""Independent DuckDB text for the registered queries, over the same input tables."""

from basketry.functions.labels import AISLE_RULES, DEPARTMENT_RULES, SEGMENT_ORDER
from basketry.mining.features import FEATURES
from basketry.operators.analysis import SUMMARY
from basketry.registry import (
    AISLE_CONFIDENCE, AISLE_SHARE_PCT, AISLE_SUPPORT, POPULAR, PRODUCT_CONFIDENCE,
    PRODUCT_MIN_COUNT,
)
from basketry.schemas import TABLE_KIND, TABLES
from basketry.sources.order_tables import AISLE_NAMES, DEPARTMENT_OF_TYPE


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(v) for v in row) + ")" for row in rows)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _rules_case(column: str, rules) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(lower(trim({column})), '{word}')" for word in words)
        + f" THEN '{label}'" for label, words in rules
    )
    return f"CASE {cases} ELSE 'General' END"


def ratio(num: str, den: str, scale: int = 2) -> str:
    """Whole numbers divided and rounded half up."""
    whole = (f"((CAST({num} AS BIGINT) * {2 * 10**scale} + CAST({den} AS BIGINT))"
             f" // (2 * CAST({den} AS BIGINT)))")
    return f"(CASE WHEN {den} > 0 THEN CAST({whole} AS DOUBLE) / {10**scale} END)"


def pct(num: str, den: str) -> str:
    return ratio(f"({num}) * 100", den)


def share(num: str, den: str) -> str:
    return f"(CAST(100 AS DOUBLE) * CAST({num} AS BIGINT) / CAST({den} AS BIGINT))"


def mean(num: str, den: str) -> str:
    return f"(CAST(CAST({num} AS BIGINT) AS DOUBLE) / CAST({den} AS BIGINT))"


RATIO_UNITS = "sum(ratio_units)"
GAP_UNITS = "sum(gap_units)"
GAPS = "count(gap_units)"

CTES = {
    "numbered": """
        SELECT o_orderkey + 1 AS order_id, o_custkey + 1 AS user_id,
               CAST(o_orderdate AS DATE) AS day,
               row_number() OVER w AS order_number,
               lag(CAST(o_orderdate AS DATE)) OVER w AS previous_day,
               lead(o_orderkey) OVER w IS NULL AS is_last
        FROM orders
        WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)""",
    "src_orders": """
        SELECT order_id, user_id,
               CASE WHEN order_id NOT IN (SELECT l_orderkey + 1 FROM lineitem) THEN 'test'
                    WHEN is_last THEN 'train' ELSE 'prior' END AS eval_set,
               CAST(order_number AS INTEGER) AS order_number,
               CAST(dayofweek(day) AS INTEGER) AS order_dow,
               CAST((order_id - 1) % 24 AS INTEGER) AS order_hour_of_day,
               CASE WHEN previous_day IS NOT NULL
                    THEN CAST(least(day - previous_day, 30) AS INTEGER) END
                   AS days_since_prior_order
        FROM numbered""",
    "src_lines": """
        SELECT l.order_id, l.product_id, CAST(l.position AS INTEGER) AS add_to_cart_order,
               CASE WHEN min(o.order_number) OVER (PARTITION BY o.user_id, l.product_id)
                         < o.order_number THEN 1 ELSE 0 END AS reordered,
               o.eval_set
        FROM (SELECT order_id, product_id,
                     row_number() OVER (PARTITION BY order_id ORDER BY line_number, product_id)
                         AS position
              FROM (SELECT l_orderkey + 1 AS order_id, l_partkey + 1 AS product_id,
                           min(l_linenumber) AS line_number
                    FROM lineitem GROUP BY ALL)) l
        JOIN src_orders o USING (order_id)""",
    "src_departments": f"""
        SELECT department_id, department FROM (VALUES {_values(
            (i, _text(kind), _text(name))
            for i, (kind, name) in enumerate(DEPARTMENT_OF_TYPE.items(), start=1)
        )}) v(department_id, kind, department)
        WHERE kind IN (SELECT p_type FROM part)""",
    "src_aisles": f"""
        SELECT aisle_id, aisle FROM (VALUES {_values(
            (i, _text(name)) for i, name in enumerate(AISLE_NAMES, start=1)
        )}) v(aisle_id, aisle)
        WHERE aisle_id IN (SELECT CAST(split_part(p_brand, '#', 2) AS BIGINT) FROM part)""",
    "src_products": f"""
        SELECT p_partkey + 1 AS product_id,
               p_name || ', #' || CAST(p_partkey + 1 AS VARCHAR) AS product_name,
               CAST(split_part(p_brand, '#', 2) AS BIGINT) AS aisle_id,
               CAST(list_position([{', '.join(_text(k) for k in DEPARTMENT_OF_TYPE)}], p_type)
                    AS BIGINT) AS department_id
        FROM part""",
    "dim_time": """
        SELECT CAST(dow * 100 + hour AS INTEGER) AS time_id, CAST(dow AS INTEGER) AS order_dow,
               ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday',
                'Saturday'][dow + 1] AS dow_name,
               CAST(hour AS INTEGER) AS order_hour,
               CASE WHEN hour <= 5 THEN '00-06 Night' WHEN hour <= 11 THEN '06-12 Morning'
                    WHEN hour <= 17 THEN '12-18 Afternoon' ELSE '18-24 Evening' END AS hour_range,
               dow IN (0, 6) AS is_weekend
        FROM range(7) d(dow), range(24) h(hour)""",
    "dim_department": f"""
        SELECT CAST(department_id AS BIGINT) AS department_id, department AS department_name,
               {_rules_case('department', DEPARTMENT_RULES)} AS dept_category
        FROM src_departments""",
    "dim_aisle": f"""
        SELECT CAST(aisle_id AS BIGINT) AS aisle_id, aisle AS aisle_name,
               {_rules_case('aisle', AISLE_RULES)} AS aisle_type
        FROM src_aisles""",
    "dim_product": "SELECT *, 'General' AS product_category FROM src_products",
    "fact_orders": f"""
        SELECT o.order_id, o.user_id,
               CAST(o.order_dow * 100 + o.order_hour_of_day AS INTEGER) AS time_id,
               o.order_number,
               CAST(o.days_since_prior_order AS DOUBLE) AS days_since_prior_order,
               CAST(coalesce(m.items, 0) AS INTEGER) AS total_items,
               coalesce({ratio('m.again', 'm.items', 4)}, 0) AS reorder_ratio,
               o.order_dow,
               coalesce((m.again * 20000 + m.items) // (2 * m.items), 0) AS ratio_units,
               o.days_since_prior_order * 100 AS gap_units
        FROM src_orders o
        LEFT JOIN (SELECT order_id, count(*) AS items, CAST(sum(reordered) AS BIGINT) AS again
                   FROM src_lines GROUP BY order_id) m USING (order_id)
        WHERE o.eval_set IN ('prior', 'train')""",
    "fact_order_details": """
        SELECT l.order_id, l.product_id, o.time_id, l.add_to_cart_order, l.reordered,
               1 AS quantity
        FROM src_lines l LEFT JOIN fact_orders o USING (order_id)""",
    "dim_user": f"""
        SELECT user_id,
               CASE WHEN count(*) >= 50 THEN 'VIP' WHEN count(*) >= 20 THEN 'Frequent'
                    WHEN count(*) >= 10 THEN 'Regular' ELSE 'New' END AS user_segment,
               max(CASE WHEN order_number = 1 THEN order_dow END) AS first_order_dow,
               {ratio('sum(total_items)', 'count(*)')} AS avg_basket_size,
               count(*) AS total_orders,
               CAST(sum(total_items) AS BIGINT) AS total_products_purchased,
               {ratio(GAP_UNITS, f'{GAPS} * 100')} AS avg_days_between_orders,
               arg_max(time_id, order_number) AS last_order_date_id
        FROM fact_orders GROUP BY user_id""",
    # measures used by many queries
    "timed": """
        SELECT f.*, t.dow_name, t.order_hour, t.hour_range, t.is_weekend,
               CASE WHEN t.is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type
        FROM fact_orders f JOIN dim_time t USING (time_id)""",
    "sold": """
        SELECT d.order_id, d.time_id, d.reordered, p.product_id, p.product_name,
               a.aisle_id, a.aisle_name, a.aisle_type,
               e.department_id, e.department_name, e.dept_category
        FROM fact_order_details d
        JOIN dim_product p USING (product_id)
        JOIN dim_aisle a ON a.aisle_id = p.aisle_id
        JOIN dim_department e ON e.department_id = p.department_id""",
    "kpi_days": f"""
        SELECT order_dow, dow_name, count(DISTINCT order_id) AS orders,
               {share('count(DISTINCT order_id)', 'sum(count(DISTINCT order_id)) OVER ()')}
                   AS share_pct
        FROM timed GROUP BY order_dow, dow_name""",
    "kpi_hours": f"""
        SELECT order_hour, count(DISTINCT order_id) AS orders,
               {share('count(DISTINCT order_id)', 'sum(count(DISTINCT order_id)) OVER ()')}
                   AS share_pct
        FROM timed GROUP BY order_hour""",
    "kpi_weekend": f"""
        SELECT day_type, count(DISTINCT order_id) AS orders,
               count(DISTINCT order_dow) AS days_in_group,
               {mean('count(DISTINCT order_id)', 'count(DISTINCT order_dow)')}
                   AS avg_orders_per_day,
               {mean('sum(total_items)', 'count(*) FILTER (total_items <> 0)')}
                   AS avg_basket_size,
               {mean(RATIO_UNITS, 'count(*) * 100')} AS avg_reorder_rate_pct
        FROM timed GROUP BY day_type""",
    "kpi_departments": f"""
        SELECT department_name, count(DISTINCT order_id) AS orders, count(*) AS total_items,
               {share('sum(reordered)', 'count(*)')} AS reorder_rate_pct,
               count(DISTINCT product_id) AS unique_products,
               {share('count(*)', 'sum(count(*)) OVER ()')} AS market_share_pct
        FROM sold GROUP BY department_id, department_name""",
    "kpi_products": f"""
        SELECT product_id, product_name, department_name, aisle_name,
               count(DISTINCT order_id) AS orders, count(*) AS total_items,
               {share('sum(reordered)', 'count(*)')} AS reorder_rate_pct
        FROM sold GROUP BY product_id, product_name, department_name, aisle_name""",
    "kpi_aisles": f"""
        SELECT aisle_name, {share('sum(reordered)', 'count(*)')} AS reorder_rate_pct,
               count(*) AS items
        FROM sold GROUP BY aisle_id, aisle_name HAVING count(*) >= (SELECT count(*) * {AISLE_SHARE_PCT} // 100 FROM fact_order_details)
        ORDER BY reorder_rate_pct DESC, items DESC, aisle_id LIMIT 15""",
    "kpi_segments": f"""
        SELECT user_segment, count(*) AS users,
               CAST(sum(total_orders) AS BIGINT) AS total_orders,
               {mean('sum(total_orders)', 'count(*)')} AS avg_orders,
               {mean('sum(CAST(round(avg_basket_size * 100) AS BIGINT))', 'count(*) * 100')}
                   AS avg_basket_size,
               {share('count(*)', 'sum(count(*)) OVER ()')} AS user_share_pct,
               {share('sum(total_orders)', 'sum(sum(total_orders)) OVER ()')} AS order_share_pct
        FROM dim_user WHERE user_segment <> '' GROUP BY user_segment""",
    "kpi_bands": f"""
        SELECT bucket_order, basket_size, count(*) AS orders,
               {mean(RATIO_UNITS, 'count(*) * 100')} AS avg_reorder_rate_pct,
               {share('count(*)', 'sum(count(*)) OVER ()')} AS order_share_pct
        FROM (SELECT *, CASE WHEN total_items <= 5 THEN 1 WHEN total_items <= 10 THEN 2
                             WHEN total_items <= 20 THEN 3 WHEN total_items <= 30 THEN 4
                             ELSE 5 END AS bucket_order,
                     CASE WHEN total_items <= 5 THEN '1-5 items'
                          WHEN total_items <= 10 THEN '6-10 items'
                          WHEN total_items <= 20 THEN '11-20 items'
                          WHEN total_items <= 30 THEN '21-30 items'
                          ELSE '31+ items' END AS basket_size
              FROM fact_orders WHERE total_items > 0)
        GROUP BY bucket_order, basket_size""",
    # clustering
    "features": f"""
        SELECT user_id, count(*) AS total_orders,
               {mean('sum(total_items)', 'count(*)')} AS avg_basket_size,
               {mean(RATIO_UNITS, 'count(*) * 10000')} AS avg_reorder_ratio,
               {mean(GAP_UNITS, f'{GAPS} * 100')} AS avg_days_between_orders
        FROM fact_orders WHERE total_items > 0
        GROUP BY user_id HAVING count(*) >= 3""",
    "labels": f"""
        SELECT user_id, CAST(list_position([{', '.join(_text(s) for s in SEGMENT_ORDER)}],
                                           user_segment) - 1 AS BIGINT) AS cluster
        FROM dim_user""",
    "scaled": "SELECT f.user_id, l.cluster, " + ", ".join(f"f.{n}" for n in FEATURES) + ", "
        + ", ".join(
            f"(f.{n} - (SELECT avg({n}) FROM features)) / "
            f"(SELECT stddev_pop({n}) FROM features) AS z_{n}" for n in FEATURES
        ) + " FROM features f JOIN labels l USING (user_id)",
    # baskets
    "large_orders": "SELECT order_id FROM fact_order_details GROUP BY order_id HAVING count(*) >= 2",
    "aisle_items": """
        SELECT DISTINCT d.order_id, CAST(p.aisle_id AS VARCHAR) AS item
        FROM fact_order_details d JOIN dim_product p USING (product_id)
        WHERE d.order_id IN (SELECT order_id FROM large_orders)""",
    "product_items": """
        SELECT d.order_id, d.item
        FROM (SELECT order_id, CAST(product_id AS VARCHAR) AS item FROM fact_order_details) d
        WHERE d.order_id IN (SELECT order_id FROM large_orders)""",
}


def _itemsets(name: str, items: str, enough: str) -> dict[str, str]:
    """Frequent itemsets of any length: all subsets of frequent items, counted per set."""
    return {
        f"{name}_f": f"""
            SELECT order_id, item FROM {items} WHERE item IN
                (SELECT item FROM {items} GROUP BY item HAVING {enough})""",
        f"{name}_subsets": f"""
            SELECT order_id, [item] AS items, item AS last FROM {name}_f
            UNION ALL
            SELECT s.order_id, list_append(s.items, f.item), f.item
            FROM {name}_subsets s JOIN {name}_f f
              ON f.order_id = s.order_id AND f.item > s.last""",
        name: f"""
            SELECT items, freq, CAST(freq AS DOUBLE) / (SELECT count(*) FROM large_orders)
                       AS support, CAST(len(items) AS INTEGER) AS length
            FROM (SELECT items, count(*) AS freq FROM {name}_subsets
                  GROUP BY items HAVING {enough})""",
    }


def _rules(name: str, sets: str, confidence: float) -> dict[str, str]:
    split = "list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = {bit})"
    return {name: f"""
        SELECT s.a AS antecedents, s.c AS consequents, s.support,
               s.support / l.support AS confidence,
               s.support / l.support / r.support AS lift,
               s.support - l.support * r.support AS leverage,
               CASE WHEN s.support / l.support >= 1 THEN CAST('inf' AS DOUBLE)
                    ELSE (1 - r.support) / (1 - s.support / l.support) END AS conviction
        FROM (SELECT support, {split.format(bit=1)} AS a, {split.format(bit=0)} AS c
              FROM (SELECT items, support, unnest(range(1, (1 << length) - 1)) AS mask
                    FROM {sets} WHERE length >= 2)) s
        JOIN {sets} l ON l.items = s.a
        JOIN {sets} r ON r.items = s.c
        WHERE s.support / l.support >= {confidence}"""}


CTES |= _itemsets(
    "aisle_sets", "aisle_items",
    f"CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM large_orders) >= {AISLE_SUPPORT}")
CTES |= _itemsets("product_sets", "product_items", f"count(*) >= {PRODUCT_MIN_COUNT}")
CTES |= _rules("aisle_rules", "aisle_sets", AISLE_CONFIDENCE)
CTES |= _rules("product_rules", "product_sets", PRODUCT_CONFIDENCE)


def _named(items: str) -> str:
    return (
        f"(SELECT list_sort(list(coalesce(p.product_name, 'product:' || u.item))) "
        f"FROM (SELECT unnest({items}) AS item) u "
        "LEFT JOIN dim_product p ON CAST(p.product_id AS VARCHAR) = u.item)"
    )


CTES |= {
    "named_rules": f"""
        SELECT *, {_named('antecedents')} AS antecedent_names,
               {_named('consequents')} AS consequent_names
        FROM product_rules""",
    "carts": """
        SELECT o.user_id, list_sort(list(DISTINCT p.product_name)) AS names,
               list_sort(list(DISTINCT CAST(p.product_id AS VARCHAR))) AS ids
        FROM (SELECT user_id, arg_max(order_id, order_number) AS order_id
              FROM fact_orders GROUP BY user_id) o
        JOIN fact_order_details d USING (order_id)
        JOIN dim_product p USING (product_id)
        GROUP BY o.user_id""",
    "known_names": """
        SELECT DISTINCT unnest(list_concat(antecedent_names, consequent_names)) AS item
        FROM named_rules""",
    "mixed_carts": """
        SELECT c.user_id AS cart_id, items,
               CASE WHEN EXISTS (SELECT 1 FROM known_names k WHERE list_contains(items, k.item))
                    THEN 'name' ELSE 'id' END AS space
        FROM (SELECT user_id, CASE WHEN user_id % 2 = 1 THEN names ELSE ids END AS items
              FROM carts) c""",
    "space_rules": """
        SELECT 'id' AS space, antecedents AS a, consequents AS c,
               support * confidence * greatest(lift, 0) AS quality FROM product_rules
        UNION ALL
        SELECT 'name', antecedent_names, consequent_names,
               support * confidence * greatest(lift, 0) FROM named_rules""",
    "popularity": """
        SELECT cluster, place, product_id, product_name, order_count, reorder_rate
        FROM (SELECT l.cluster, d.product_id, p.product_name,
                     count(DISTINCT d.order_id) AS order_count,
                     CAST(sum(d.reordered) AS DOUBLE) / count(*) AS reorder_rate,
                     CAST(row_number() OVER (PARTITION BY l.cluster
                          ORDER BY count(DISTINCT d.order_id) DESC,
                                   CAST(sum(d.reordered) AS DOUBLE) / count(*) DESC,
                                   d.product_id) AS INTEGER) AS place
              FROM labels l JOIN fact_orders o USING (user_id)
              JOIN fact_order_details d USING (order_id)
              JOIN dim_product p USING (product_id)
              GROUP BY l.cluster, d.product_id, p.product_name)""",
}


def _rule_ranking(carts: str, n: int) -> str:
    return f"""
        SELECT cart_id, item, score, CAST(place AS INTEGER) AS place FROM (
            SELECT *, row_number() OVER (PARTITION BY cart_id ORDER BY score DESC, item) AS place
            FROM (SELECT cart_id, item, round(sum(quality), 12) AS score
                  FROM (SELECT k.cart_id, k.items, unnest(r.c) AS item, r.quality
                        FROM {carts} k JOIN space_rules r
                          ON r.space = k.space AND list_has_all(k.items, r.a))
                  WHERE NOT list_contains(items, item)
                  GROUP BY cart_id, item))
        WHERE place <= {n}"""


def _cluster_ranking(n: int) -> str:
    return f"""
        SELECT cart_id, item, CAST(place AS INTEGER) AS place FROM (
            SELECT k.user_id AS cart_id, p.product_name AS item,
                   row_number() OVER (PARTITION BY k.user_id ORDER BY p.place) AS place
            FROM carts k JOIN labels l USING (user_id)
            JOIN popularity p ON p.cluster = l.cluster
            WHERE NOT list_contains(k.names, p.product_name))
        WHERE place <= {n}"""


CTES |= {
    "name_carts": "SELECT user_id AS cart_id, names AS items, 'name' AS space FROM carts",
    "fusion_rules": _rule_ranking("name_carts", 30),
    "fusion_clusters": _cluster_ranking(30),
}


def _json(items: str) -> str:
    return f"""('["' || array_to_string({items}, '","') || '"]')"""


_CRC = """
    (xor(list_reduce(list_transform(range(0, length(key)), lambda i: ord(key[i + 1])::BIGINT),
        lambda crc, byte: list_reduce(range(0, 8),
            lambda x, step: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
            xor(crc, byte)), 4294967295), 4294967295))"""

_SAMPLE = f"""
    SELECT order_id FROM (
        SELECT order_id, {_CRC} AS crc
        FROM (SELECT order_id, CAST(order_id AS VARCHAR) || ':42' AS key FROM fact_orders))
    ORDER BY crc, order_id LIMIT 5000"""

_N = range(1, len(FEATURES) + 1)


def _largest_axis(name: str, matrix: str) -> str:
    """The eigenvector v1.. and value of the largest eigenvalue of a matrix a1_1.., by repeated
    multiplication, with its largest entry positive."""
    times = [" + ".join(f"a{min(i, j)}_{max(i, j)} * v{j}" for j in _N) for i in _N]
    norm = "sqrt(" + " + ".join(f"w{i} * w{i}" for i in _N) + ")"
    v = ", ".join(f"v{i}" for i in _N)
    most = "greatest(" + ", ".join(f"abs(v{i})" for i in _N) + ")"
    sign = f"CASE WHEN greatest({v}) = {most} THEN 1 ELSE -1 END"
    return f"""
    {name}_steps AS (
        SELECT 0 AS n, {', '.join(f'CAST({1 + i / 10} AS DOUBLE) AS v{i}' for i in _N)}
        UNION ALL
        SELECT n + 1, {', '.join(f'w{i} / {norm}' for i in _N)}
        FROM (SELECT n, {', '.join(f'{t} AS w{i}' for i, t in zip(_N, times))} FROM {name}_steps, {matrix} WHERE n < 1500)),
    {name} AS (SELECT {', '.join(f'v{i} * {sign} AS v{i}' for i in _N)},
               {' + '.join(f'v{i} * ({t})' for i, t in zip(_N, times))} AS size
        FROM {name}_steps, {matrix} WHERE n = 1500)"""


_ENTRIES = [(i, j) for i in _N for j in range(i, len(FEATURES) + 1)]
_AXES = f"""
    WITH moments AS (SELECT {', '.join(
        f'covar_pop(z_{FEATURES[i - 1]}, z_{FEATURES[j - 1]}) AS a{i}_{j}' for i, j in _ENTRIES)} FROM scaled),
    {_largest_axis("first_axis", "moments")},
    rest AS (SELECT {', '.join(f'a{i}_{j} - size * v{i} * v{j} AS a{i}_{j}' for i, j in _ENTRIES)}
        FROM moments, first_axis),
    {_largest_axis("second_axis", "rest")}"""
_TOTAL = " + ".join(f"a{i}_{i}" for i in _N)

_DISTANCE = "sqrt(" + " + ".join(f"pow(a.z_{n} - b.z_{n}, 2)" for n in FEATURES) + ")"
_CENTERS = ("SELECT cluster, " + ", ".join(f"avg(z_{n}) AS z_{n}" for n in FEATURES)
            + " FROM scaled GROUP BY cluster")

_BAND = ("CASE WHEN total_items BETWEEN 1 AND 5 THEN {0} WHEN total_items BETWEEN 6 AND 10 THEN {1} "
         "WHEN total_items BETWEEN 11 AND 20 THEN {2} "
         "WHEN total_items BETWEEN 21 AND 30 THEN {3} ELSE {4} END")
_CLOSED = ("'1-5 items'", "'6-10 items'", "'11-20 items'", "'21-30 items'")


def _violations(dataset: str, source: str, rules) -> str:
    """One row per rule; ``rules`` are (kind, columns, counting SQL)."""
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, {place} AS rule_no, '{kind}' AS rule, "
        f"'{columns}' AS column_name, CAST(({count.format(t=source)}) AS BIGINT) AS violations"
        for place, (kind, columns, count) in enumerate(rules, start=1)
    )


_EMPTY = ("not_empty", "", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {t}")


def _where(kind, column, predicate):
    return (kind, column, f"SELECT count(*) FROM {{t}} WHERE {predicate}")


def _whole(column):
    return _where("integer", column, f"{column} IS NULL OR {column} % 1 <> 0")


def _between(column, low, high=None):
    upper = f" OR {column} > {high}" if high is not None else ""
    return _where("range", column, f"{column} IS NULL OR {column} < {low}{upper}")


def _once(*columns):
    keys = ", ".join(columns)
    return ("unique", keys, f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {{t}} "
                            f"GROUP BY {keys} HAVING count(*) > 1)")


_LINE_RULES = (
    _EMPTY,
    *(_whole(c) for c in ("order_id", "product_id", "add_to_cart_order", "reordered")),
    _between("order_id", 1), _between("product_id", 1), _between("add_to_cart_order", 1, 32767),
    _where("allowed", "reordered", "reordered IS NULL OR reordered NOT IN (0, 1)"),
    _once("order_id", "product_id"), _once("order_id", "add_to_cart_order"),
)
_ORDER_RULES = (
    _EMPTY,
    *(_whole(c) for c in ("order_id", "user_id", "order_number", "order_dow",
                          "order_hour_of_day")),
    _between("order_id", 1), _between("user_id", 1), _between("order_number", 1),
    _between("order_dow", 0, 6), _between("order_hour_of_day", 0, 23),
    _where("range", "days_since_prior_order", "days_since_prior_order NOT BETWEEN 0 AND 30"),
    _where("allowed", "eval_set", "eval_set IS NULL OR eval_set NOT IN ('prior','train','test')"),
    _once("order_id"),
    _where("first_order", "order_id, order_number, days_since_prior_order",
           "(order_number = 1) = (days_since_prior_order IS NOT NULL)"),
)


def _name_rules(key, name):
    return (
        _EMPTY, _whole(key), _between(key, 1), _where("not_null", name, f"{name} IS NULL"),
        _where("not_blank", name, f"trim({name}) = ''"), _once(key), _once(name),
    )


def _product_rules(key="product_id"):
    return (
        _EMPTY, *(_whole(c) for c in ("product_id", "aisle_id", "department_id")),
        *(_between(c, 1) for c in ("product_id", "aisle_id", "department_id")),
        _where("not_null", "product_name", "product_name IS NULL"),
        _where("not_blank", "product_name", "trim(product_name) = ''"), _once(key),
    )


_RAW_LINES = """(SELECT l_orderkey AS order_id, l_partkey AS product_id,
    l_linenumber AS add_to_cart_order, l_linenumber % 3 AS reordered FROM lineitem)"""
_RAW_ORDERS = """(SELECT o_orderkey AS order_id, o_custkey AS user_id,
    CASE WHEN o_orderkey % 3 = 0 THEN 'prior' ELSE o_orderstatus END AS eval_set,
    o_orderkey % 5 AS order_number, o_orderkey % 8 AS order_dow,
    o_orderkey % 25 AS order_hour_of_day,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 33 END AS days_since_prior_order
    FROM orders)"""
# product ids that end in 'd' are not numbers, which the comparison sees as NULL
_RAW_PRODUCTS = """(SELECT CASE p_size % 10 WHEN 0 THEN p_partkey + 0.5 WHEN 2 THEN NULL
        ELSE p_partkey END AS product_id,
    CASE p_size % 9 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE p_name END AS product_name,
    p_size AS aisle_id, p_size % 4 AS department_id FROM part)"""

_NO_ISSUES = {
    "orders_without_items": "SELECT count(*) FROM fact_orders WHERE total_items <= 0",
    "first_gap": "SELECT count(*) FROM fact_orders "
                 "WHERE order_number = 1 AND days_since_prior_order IS NOT NULL",
    "later_gap": "SELECT count(*) FROM fact_orders "
                 "WHERE order_number > 1 AND days_since_prior_order IS NULL",
    "open_times": "SELECT count(*) FROM fact_order_details WHERE time_id IS NULL",
    "mismatch": "SELECT count(*) FROM fact_order_details d JOIN fact_orders o USING (order_id) "
                "WHERE d.time_id <> o.time_id",
    "orphan_order": "SELECT count(*) FROM fact_order_details d "
                    "ANTI JOIN fact_orders o USING (order_id)",
    "orphan_product": "SELECT count(*) FROM fact_order_details d "
                      "ANTI JOIN dim_product p USING (product_id)",
    "idle_users": "SELECT count(*) FROM dim_user WHERE total_orders <= 0",
    "twice_order": "SELECT count(*) FROM (SELECT order_id FROM fact_orders "
                   "GROUP BY order_id HAVING count(*) > 1)",
    "twice_line": "SELECT count(*) FROM (SELECT order_id, product_id FROM fact_order_details "
                  "GROUP BY ALL HAVING count(*) > 1)",
}


def _counts(rows, name="check_name", value="violations") -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS {name}, CAST(({sql}) AS BIGINT) AS {value}" for label, sql in rows
    )


def _warehouse_checks() -> str:
    n = _NO_ISSUES
    rows = [
        ("duplicate_orders", n["twice_order"]),
        ("orders_without_items", n["orders_without_items"]),
        ("invalid_order_intervals", f"({n['first_gap']}) + ({n['later_gap']})"),
        ("unresolved_detail_times", n["open_times"]),
        ("orphan_detail_products", n["orphan_product"]),
        ("users_without_orders", n["idle_users"]),
    ]
    rows = [(k, f"SELECT ({v})" if v.startswith("(") else v) for k, v in rows]
    return f"""
        SELECT check_name, actual, expected, actual = expected AS passed FROM (
            SELECT *, CAST(0 AS BIGINT) AS expected FROM ({_counts(rows, value='actual')})
            UNION ALL
            SELECT 'time_dimension_rows', (SELECT count(*) FROM dim_time), 168)"""


def _sql_quality() -> str:
    n = _NO_ISSUES
    return _counts([
        ("duplicate_order_grain", n["twice_order"]),
        ("duplicate_order_product_grain", n["twice_line"]),
        ("unresolved_detail_time", n["open_times"]),
        ("detail_time_mismatch", n["mismatch"]),
        ("orphan_detail_order", n["orphan_order"]),
        ("orphan_detail_product", n["orphan_product"]),
        ("invalid_first_order_interval", n["first_gap"]),
        ("invalid_repeat_order_interval", n["later_gap"]),
    ])


def _column_checks() -> str:
    checks = [
        ("dim_time", "chk_time_dow", "order_dow NOT BETWEEN 0 AND 6"),
        ("dim_time", "chk_time_hour", "order_hour NOT BETWEEN 0 AND 23"),
        ("dim_user", "chk_user_orders", "total_orders < 0"),
        ("dim_user", "chk_user_products", "total_products_purchased < 0"),
        ("dim_user", "chk_user_first_dow", "first_order_dow NOT BETWEEN 0 AND 6"),
        ("fact_orders", "chk_order_number", "order_number <= 0"),
        ("fact_orders", "chk_order_dow", "order_dow NOT BETWEEN 0 AND 6"),
        ("fact_orders", "chk_days_since_prior", "days_since_prior_order < 0"),
        ("fact_orders", "chk_reorder_ratio", "reorder_ratio NOT BETWEEN 0 AND 1"),
        ("fact_order_details", "chk_cart_position",
         "add_to_cart_order NOT BETWEEN 1 AND 32767"),
        ("fact_order_details", "chk_reordered", "reordered NOT IN (0, 1)"),
        ("fact_order_details", "chk_quantity", "quantity <= 0"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, "
        f"(SELECT count(*) FROM {table} WHERE {bad}) AS violations"
        for table, name, bad in checks
    )


def _reconcile() -> str:
    orders = "(SELECT count(*) FROM fact_orders)"
    items = "(SELECT sum(total_items) FROM fact_orders)"
    rows = [
        ("day orders", "SELECT sum(orders) FROM kpi_days", orders),
        ("hour orders", "SELECT sum(orders) FROM kpi_hours", orders),
        ("segment orders", "SELECT sum(total_orders) FROM kpi_segments", orders),
        ("band orders", "SELECT sum(orders) FROM kpi_bands", orders),
        ("department items", "SELECT sum(total_items) FROM kpi_departments", items),
    ]
    shares = [
        ("day shares", "share_pct", "kpi_days"), ("hour shares", "share_pct", "kpi_hours"),
        ("segment user shares", "user_share_pct", "kpi_segments"),
        ("segment order shares", "order_share_pct", "kpi_segments"),
        ("band shares", "order_share_pct", "kpi_bands"),
        ("department shares", "market_share_pct", "kpi_departments"),
    ]
    rows += [(name, f"SELECT round(sum({column}) * 1000000) FROM {table}", "100000000")
             for name, column, table in shares]
    union = " UNION ALL ".join(
        f"SELECT '{name}' AS identity, CAST(({sql}) AS BIGINT) AS actual, "
        f"CAST({expected} AS BIGINT) AS expected" for name, sql, expected in rows
    )
    return f"SELECT *, actual = expected AS passed FROM ({union})"


def _summary() -> str:
    def top(column, source, tie, shown=None):
        return (f"SELECT {shown or column} FROM {source} GROUP BY {column}, {tie} "
                f"ORDER BY count(*) DESC, {tie} LIMIT 1")

    values = (
        "SELECT format('{:,}', count(*)) FROM fact_orders",
        "SELECT format('{:,}', count(*)) FROM dim_user",
        "SELECT format('{:,}', count(*)) FROM dim_product",
        "SELECT format('{:,}', count(*)) FROM fact_order_details",
        f"SELECT format('{{:,.2f}}', {ratio('sum(total_items)', 'count(*)')}) FROM fact_orders",
        f"SELECT format('{{:,.2f}}', {ratio(RATIO_UNITS, 'count(*) * 100')}) || '%' "
        "FROM fact_orders",
        top("dow_name", "timed", "dow_name"),
        top("order_hour", "timed", "order_hour", "CAST(order_hour AS VARCHAR) || ':00'"),
        top("department_name", "sold", "department_id"),
        top("product_name", "sold", "product_id"),
    )
    return " UNION ALL ".join(
        f"SELECT {_text(metric)} AS metric, ({value}) AS value, {_text(text)} AS description"
        for (metric, text), value in zip(SUMMARY, values, strict=True)
    )


_CONDENSED_FROM = """(SELECT *, least(row_number() OVER (
    ORDER BY market_share_pct DESC, department_name), 4) AS place FROM kpi_departments)"""

_INDEX = " UNION ALL ".join(
    f"SELECT department_name, '{label}' AS metric, "
    f"CAST({column} AS DOUBLE) / (SELECT max({column}) FROM kpi_departments) * 100 "
    f"AS relative_index FROM kpi_departments WHERE department_name IN ('produce', 'frozen')"
    for column, label in (("orders", "Order reach"), ("total_items", "Item volume"),
                          ("unique_products", "Product breadth"),
                          ("reorder_rate_pct", "Reorder rate"))
)


def _extremes() -> str:
    rows = [
        ("peak day", "dow_name", "orders", "kpi_days", "DESC", "order_dow"),
        ("quiet day", "dow_name", "orders", "kpi_days", "ASC", "order_dow"),
        ("peak hour", "order_hour", "orders", "kpi_hours", "DESC", "order_hour"),
        ("common band", "basket_size", "orders", "kpi_bands", "DESC", "bucket_order"),
        ("volume leader", "department_name", "total_items", "kpi_departments", "DESC",
         "department_name"),
        ("reorder leader", "department_name", "reorder_rate_pct", "kpi_departments", "DESC",
         "department_name"),
        ("share leader", "department_name", "market_share_pct", "kpi_departments", "DESC",
         "department_name"),
        ("best aisle", "aisle_name", "reorder_rate_pct", "kpi_aisles", "DESC", "aisle_name"),
    ]
    return " UNION ALL ".join(
        f"(SELECT '{name}' AS insight, CAST({label} AS VARCHAR) AS label, "
        f"CAST({value} AS DOUBLE) AS value FROM {table} ORDER BY {value} {way}, {tie} LIMIT 1)"
        for name, label, value, table, way, tie in rows
    )


def _itemset_rows(sets: str) -> str:
    return f"SELECT {_json('items')} AS itemsets_json, freq, support, length FROM {sets}"


def _rule_rows(rules: str) -> str:
    return (f"SELECT {_json('antecedents')} AS antecedents_json, "
            f"{_json('consequents')} AS consequents_json, "
            f"support, confidence, lift, leverage, conviction FROM {rules}")


_RANGES = "(least(greatest((SELECT max(order_id) FROM src_orders) // 500000 + 1, 8), 64))"

_QUERIES = {
    "read_sources": " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, count(*) AS row_count FROM {source}"
        for name, source in (
            ("departments", "src_departments"), ("aisles", "src_aisles"),
            ("products", "src_products"), ("orders", "src_orders"),
            ("order_products_prior", "src_lines WHERE eval_set = 'prior'"),
            ("order_products_train", "src_lines WHERE eval_set = 'train'"),
        )),
    "csv_orders": "SELECT order_id, user_id, time_id, order_number, days_since_prior_order, "
                  "order_dow FROM fact_orders",
    "source_departments": "SELECT CAST(department_id AS BIGINT) AS department_id, department "
                          "FROM src_departments",
    "source_aisles": "SELECT CAST(aisle_id AS BIGINT) AS aisle_id, aisle FROM src_aisles",
    "source_products": "SELECT * FROM src_products",
    "source_orders": "SELECT * FROM src_orders",
    "source_order_lines": "SELECT * FROM src_lines",
    "write_fact": "SELECT order_dow, count(*) AS row_count FROM fact_orders GROUP BY order_dow",
    "write_dimension": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}"
        for name in ("dim_time", "dim_department", "dim_aisle", "dim_product", "dim_user")),
    "export_csv": "SELECT department_name, orders, total_items, market_share_pct "
                  "FROM kpi_departments",
    "dim_time": "SELECT t.*, (SELECT count(*) FROM fact_orders o WHERE o.time_id = t.time_id) "
                "AS orders FROM dim_time t",
    "dim_department": "SELECT * FROM dim_department",
    "dim_aisle": "SELECT * FROM dim_aisle",
    "dim_product": "SELECT * FROM dim_product",
    "dim_user": "SELECT * FROM dim_user",
    "fact_orders": "SELECT * EXCLUDE (ratio_units, gap_units) FROM fact_orders",
    "fact_order_details": "SELECT * FROM fact_order_details",
    "resolve_detail_time_ids": "SELECT time_id, count(*) AS resolved_lines "
                               "FROM fact_order_details GROUP BY time_id",
    "resolve_stored_times": f"""
        SELECT order_range, count(*) FILTER (order_range = 2 OR (order_range = 5 AND product_id % 10 = 0))
                   AS updated_lines, CAST(0 AS BIGINT) AS updated_again, CAST(0 AS BIGINT) AS open_lines
        FROM (SELECT product_id,
                     order_id // ((SELECT max(order_id) FROM src_orders) // {_RANGES} + 1) AS order_range
              FROM fact_order_details) GROUP BY order_range""",
    "order_metrics": "SELECT order_id, total_items, reorder_ratio FROM fact_orders "
                     "WHERE total_items > 0",
    "basket_bands": f"""
        SELECT CAST({_BAND.format(1, 2, 3, 4, 5)} AS INTEGER) AS band_order,
               {_BAND.format(*_CLOSED, "'30+ items'")} AS short_label,
               {_BAND.format(*_CLOSED, "'31+ items'")} AS long_label, count(*) AS orders
        FROM fact_orders GROUP BY ALL""",
    "table_sample": "SELECT * EXCLUDE (ratio_units, gap_units) FROM fact_orders "
                    "ORDER BY order_id LIMIT 10",
    "day_types": "SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type, "
                 "CAST(count(*) AS BIGINT) AS orders FROM fact_orders JOIN dim_time USING (time_id) "
                 "GROUP BY day_type",
    "run_report": """
        SELECT 'dimensions' AS stage, (SELECT count(*) FROM dim_department)
            + (SELECT count(*) FROM dim_aisle) + (SELECT count(*) FROM dim_product) AS stage_rows
        UNION ALL SELECT 'order_details', (SELECT count(*) FROM fact_order_details)
        UNION ALL SELECT 'orders', (SELECT count(*) FROM fact_orders)
        UNION ALL SELECT 'derived_metrics', (SELECT count(*) FROM dim_user)""",
    "refresh_statistics": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {name}) AS row_count"
        for name in TABLES),
    "table_columns": " UNION ALL ".join(
        f"SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, "
        f"true AS nullable, (SELECT count({f.name}) FROM fact_orders) AS value_count"
        for f in TABLES["fact_orders"]),
    "cluster_names": """
        SELECT CASE WHEN total_orders >= 50 THEN 'VIP Customers'
                    WHEN total_orders >= 20 THEN 'Frequent Shoppers'
                    WHEN total_orders >= 10 THEN 'Regular Customers'
                    ELSE 'Occasional Buyers' END AS cluster_name, count(*) AS users
        FROM dim_user GROUP BY cluster_name""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}"
        for name in TABLE_KIND),
    "table_catalog": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{kind}' AS kind, {_text(text)} AS description, "
        f"count(*) AS row_count FROM {name}" for name, (kind, text) in TABLE_KIND.items()),
    "table_profile": "SELECT 'fact_orders' AS table_name, CAST(order_dow AS BIGINT) "
                     "AS partition_value, count(*) AS row_count FROM fact_orders GROUP BY ALL",
    "detail_partitions": f"""
        SELECT 'fact_order_details' AS table_name,
               order_id // ((SELECT max(order_id) FROM src_orders) // {_RANGES} + 1)
                   AS partition_value, count(*) AS row_count
        FROM fact_order_details GROUP BY ALL""",
    "readiness_check": " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, {passed} AS passed" for name, passed in (
            ("required_tables", "true"), ("user_segment_column", "true"),
            ("fact_orders_has_data", "(SELECT count(*) > 0 FROM fact_orders)"),
            ("fact_order_details_has_data", "(SELECT count(*) > 0 FROM fact_order_details)"),
            ("dim_user_has_data", "(SELECT count(*) > 0 FROM dim_user)"), ("healthy", "true"))),
    "source_violations": " UNION ALL ".join((
        _violations("departments", "src_departments", _name_rules("department_id", "department")),
        _violations("aisles", "src_aisles", _name_rules("aisle_id", "aisle")),
        _violations("products", "src_products", _product_rules()),
        _violations("orders", "src_orders", _ORDER_RULES),
        _violations("order_products_prior",
                    "(SELECT * FROM src_lines WHERE eval_set = 'prior')", _LINE_RULES),
        _violations("order_products_train",
                    "(SELECT * FROM src_lines WHERE eval_set = 'train')", _LINE_RULES),
    )),
    "raw_line_violations": _violations("lineitem", _RAW_LINES, _LINE_RULES),
    "raw_order_violations": _violations("orders", _RAW_ORDERS, _ORDER_RULES),
    "raw_product_violations": _violations("products", _RAW_PRODUCTS, _product_rules()),
    "warehouse_checks": _warehouse_checks(),
    "sql_quality_checks": _sql_quality(),
    "detail_time_reconciliation": _counts([
        ("unresolved", _NO_ISSUES["open_times"]), ("mismatched", _NO_ISSUES["mismatch"]),
        ("orphaned", _NO_ISSUES["orphan_order"])]),
    "derived_metric_checks": _counts([
        ("orders without line items", _NO_ISSUES["orders_without_items"]),
        ("invalid reorder ratios",
         "SELECT count(*) FROM fact_orders WHERE reorder_ratio NOT BETWEEN 0 AND 1"),
        ("users without orders", _NO_ISSUES["idle_users"])]),
    "column_checks": _column_checks(),
    "foreign_key_checks": _counts([
        ("product_aisle_id", "SELECT count(*) FROM dim_product ANTI JOIN dim_aisle "
                             "USING (aisle_id)"),
        ("product_department_id", "SELECT count(*) FROM dim_product ANTI JOIN dim_department "
                                  "USING (department_id)")]),
    "reconcile_totals": _reconcile(),
    "top_products": f"""
        SELECT product_id, product_name, count(*) AS total_quantity,
               CAST(sum(reordered) AS BIGINT) AS times_reordered,
               {pct('sum(reordered)', 'count(*)')} AS reorder_rate_pct
        FROM sold GROUP BY product_id, product_name
        ORDER BY total_quantity DESC, product_id LIMIT 20""",
    "peak_hours": f"""
        SELECT order_hour, hour_range, day_type, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT user_id) AS unique_users,
               {ratio('sum(total_items)', 'count(*)')} AS avg_basket_size,
               {ratio(RATIO_UNITS, 'count(*) * 100')} AS avg_reorder_pct
        FROM timed GROUP BY order_hour, hour_range, day_type""",
    "day_of_week": f"""
        SELECT order_dow, dow_name, is_weekend, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT user_id) AS unique_users,
               {ratio('sum(total_items)', 'count(*)')} AS avg_basket_size,
               {ratio(GAP_UNITS, f'{GAPS} * 100')} AS avg_days_between_orders,
               {ratio(RATIO_UNITS, 'count(*) * 100')} AS avg_reorder_pct
        FROM timed GROUP BY order_dow, dow_name, is_weekend""",
    "department_performance": f"""
        SELECT department_id, department_name, dept_category, count(*) AS total_items_sold,
               CAST(sum(reordered) AS BIGINT) AS reordered_items,
               {pct('sum(reordered)', 'count(*)')} AS reorder_rate_pct
        FROM sold GROUP BY department_id, department_name, dept_category""",
    "customer_segmentation": f"""
        SELECT user_segment, count(DISTINCT user_id) AS total_users,
               {pct('count(*)', 'sum(count(*)) OVER ()')} AS pct_users,
               {ratio('sum(total_orders)', 'count(*)')} AS avg_orders_per_user,
               {ratio('sum(CAST(round(avg_basket_size * 100) AS BIGINT))', 'count(*) * 100')}
                   AS avg_basket_size,
               {ratio('sum(CAST(round(avg_days_between_orders * 100) AS BIGINT))',
                      'count(avg_days_between_orders) * 100')} AS avg_frequency_days,
               CAST(sum(total_orders) AS BIGINT) AS total_orders_by_segment,
               {pct('sum(total_orders)', 'sum(sum(total_orders)) OVER ()')}
                   AS order_contribution_pct
        FROM dim_user GROUP BY user_segment""",
    "aisle_reorder": f"""
        SELECT aisle_id, aisle_name, aisle_type, count(*) AS total_items,
               CAST(sum(reordered) AS BIGINT) AS reordered_items,
               {pct('sum(reordered)', 'count(*)')} AS reorder_rate_pct
        FROM sold GROUP BY aisle_id, aisle_name, aisle_type
        HAVING count(*) >= (SELECT count(*) * {AISLE_SHARE_PCT} // 100 FROM fact_order_details)
        ORDER BY reorder_rate_pct DESC, aisle_id LIMIT 20""",
    "basket_size_distribution": f"""
        SELECT {_BAND.format(*_CLOSED, "'30+ items'")} AS basket_size_group,
               count(DISTINCT order_id) AS total_orders,
               {pct('count(*)', 'sum(count(*)) OVER ()')} AS pct_of_orders,
               {ratio('sum(total_items)', 'count(*)')} AS avg_items_in_group,
               {ratio(RATIO_UNITS, 'count(*) * 100')} AS avg_reorder_pct,
               {ratio(GAP_UNITS, f'{GAPS} * 100')} AS avg_days_between
        FROM fact_orders GROUP BY basket_size_group""",
    "weekend_vs_weekday": f"""
        SELECT m.*, v.department_name AS top_department
        FROM (SELECT day_type, count(*) AS total_orders, count(DISTINCT user_id) AS unique_users,
                     {ratio('sum(total_items)', 'count(*)')} AS avg_basket_size,
                     {ratio(RATIO_UNITS, 'count(*) * 100')} AS avg_reorder_pct,
                     {ratio(GAP_UNITS, f'{GAPS} * 100')} AS avg_days_between
              FROM timed GROUP BY day_type) m
        LEFT JOIN (SELECT t.day_type, s.department_name,
                          row_number() OVER (PARTITION BY t.day_type
                              ORDER BY count(*) DESC, s.department_name) AS place
                   FROM sold s JOIN timed t USING (order_id)
                   GROUP BY t.day_type, s.department_name) v
          ON v.day_type = m.day_type AND v.place = 1""",
    "product_reorder_patterns": f"""
        SELECT product_id, product_name, department_name, aisle_name,
               count(*) AS total_purchases,
               count(*) FILTER (reordered = 0) AS first_time_purchases,
               count(*) FILTER (reordered = 1) AS reorder_purchases,
               {pct('sum(reordered)', 'count(*)')} AS reorder_rate_pct
        FROM sold GROUP BY product_id, product_name, department_name, aisle_name
        HAVING count(*) >= (SELECT count(*) // count(DISTINCT product_id) FROM fact_order_details)
        ORDER BY reorder_rate_pct DESC, product_id LIMIT 30""",
    "sunday_orders": f"""
        SELECT order_dow, dow_name, count(DISTINCT order_id) AS total_orders,
               {mean('sum(total_items)', 'count(*)')} AS avg_basket_size,
               {mean(RATIO_UNITS, 'count(*) * 100')} AS avg_reorder_pct
        FROM timed WHERE order_dow = 0 GROUP BY order_dow, dow_name""",
    "weekend_counts": "SELECT order_dow, count(*) AS cnt FROM fact_orders "
                      "WHERE order_dow IN (0, 6) GROUP BY order_dow",
    "all_day_counts": "SELECT order_dow, count(*) AS cnt FROM fact_orders GROUP BY order_dow",
    "order_range_lines": "SELECT count(*) AS line_items FROM fact_order_details "
                         "WHERE order_id >= 500 AND order_id < 9000",
    "summary_statistics": _summary(),
    "overview_kpis": f"""
        SELECT o.total_orders, u.total_users, p.total_products, o.total_items,
               o.avg_basket_size, o.avg_reorder_rate_pct, p.total_departments, p.total_aisles
        FROM (SELECT count(*) AS total_orders,
                     CAST(coalesce(sum(total_items), 0) AS BIGINT) AS total_items,
                     {mean('sum(total_items)', 'count(*) FILTER (total_items <> 0)')}
                         AS avg_basket_size,
                     {mean(RATIO_UNITS, 'count(*) * 100')} AS avg_reorder_rate_pct
              FROM fact_orders) o,
             (SELECT count(*) AS total_users FROM dim_user) u,
             (SELECT count(*) AS total_products,
                     count(DISTINCT department_id) AS total_departments,
                     count(DISTINCT aisle_id) AS total_aisles FROM dim_product) p""",
    "day_trends": "SELECT * FROM kpi_days",
    "hour_trends": "SELECT * FROM kpi_hours",
    "weekend_comparison": "SELECT * FROM kpi_weekend",
    "departments": "SELECT * FROM kpi_departments",
    "products": "SELECT * EXCLUDE (product_id) FROM kpi_products "
                "ORDER BY orders DESC, product_id LIMIT 20",
    "products_in_department": "SELECT * EXCLUDE (product_id) FROM kpi_products "
                              "WHERE lower(department_name) = 'dairy eggs' "
                              "ORDER BY orders DESC, product_id LIMIT 100",
    "aisles": "SELECT * FROM kpi_aisles",
    "customer_segments": "SELECT * FROM kpi_segments",
    "basket_distribution": "SELECT CAST(bucket_order AS INTEGER) AS bucket_order, "
                           "* EXCLUDE (bucket_order) FROM kpi_bands",
    "condense_departments": f"""
        SELECT CASE WHEN place <= 3 THEN department_name ELSE 'All other departments' END
                   AS department_name,
               CAST(sum(orders) AS BIGINT) AS orders,
               CAST(sum(total_items) AS BIGINT) AS total_items,
               round(sum(reorder_rate_pct * total_items) / sum(total_items), 9)
                   AS reorder_rate_pct,
               CAST(sum(unique_products) AS BIGINT) AS unique_products,
               round(sum(market_share_pct), 9) AS market_share_pct
        FROM {_CONDENSED_FROM} GROUP BY place, 1""",
    "normalized_comparison": _INDEX,
    "contribution_gap": """
        SELECT user_segment, round(order_share_pct - user_share_pct, 9) AS gap,
               row_number() OVER (ORDER BY order_share_pct - user_share_pct DESC,
                   list_position(['VIP', 'Frequent', 'Regular', 'New'], user_segment)) = 1
                   AS is_strongest
        FROM kpi_segments""",
    "ordered_segments": """
        SELECT *, CAST(coalesce(list_position(['VIP', 'Frequent', 'Regular', 'New'],
                                              user_segment), 5) AS BIGINT) AS segment_rank
        FROM kpi_segments""",
    "segment_share_long": """
        SELECT user_segment, 'Customer share' AS measure, user_share_pct AS share_pct
        FROM kpi_segments
        UNION ALL SELECT user_segment, 'Order contribution', order_share_pct FROM kpi_segments""",
    "weekend_lift": """
        SELECT round((max(avg_orders_per_day) FILTER (day_type = 'Weekend')
                      / max(avg_orders_per_day) FILTER (day_type = 'Weekday') - 1) * 100, 9)
                   AS lift_pct
        FROM kpi_weekend""",
    "extremes": _extremes(),
    "search_products": """
        SELECT * EXCLUDE (product_id) FROM kpi_products
        WHERE contains(lower(product_name), 'gizmo')
        ORDER BY orders DESC, product_id LIMIT 15""",
    "largest_departments": "SELECT * FROM kpi_departments "
                           "ORDER BY total_items DESC, department_name LIMIT 4",
    "department_gap": """
        SELECT a - b AS difference, abs(a - b) AS absolute_difference,
               CASE WHEN a >= b THEN 'produce' ELSE 'frozen' END AS larger
        FROM (SELECT max(total_items) FILTER (department_name = 'produce') AS a,
                     max(total_items) FILTER (department_name = 'frozen') AS b
              FROM kpi_departments)""",
    "sample_orders": _SAMPLE,
    "baskets": f"""
        SELECT order_id, CAST(count(*) AS INTEGER) AS item_count,
               {_json("list(CAST(product_id AS VARCHAR) ORDER BY add_to_cart_order)")}
                   AS items_json
        FROM fact_order_details GROUP BY order_id HAVING count(*) >= 2""",
    "sampled_baskets": f"""
        SELECT order_id, CAST(count(*) AS INTEGER) AS item_count,
               {_json("list(CAST(product_id AS VARCHAR) ORDER BY add_to_cart_order)")}
                   AS items_json
        FROM fact_order_details WHERE order_id IN ({_SAMPLE})
        GROUP BY order_id HAVING count(*) >= 2""",
    "top_items": """
        SELECT CAST(product_id AS VARCHAR) AS item, count(*) AS baskets
        FROM fact_order_details WHERE order_id IN (SELECT order_id FROM large_orders)
        GROUP BY item ORDER BY baskets DESC, item LIMIT 500""",
    "prune_baskets": f"""
        SELECT order_id, CAST(count(t.item) AS INTEGER) AS item_count,
               CASE WHEN count(t.item) = 0 THEN '[]'
                    ELSE {_json("list(t.item ORDER BY t.item) FILTER (t.item IS NOT NULL)")} END
                   AS items_json
        FROM fact_order_details d
        LEFT JOIN (SELECT CAST(product_id AS VARCHAR) AS item, count(*) AS n
                   FROM fact_order_details
                   WHERE order_id IN (SELECT order_id FROM large_orders)
                   GROUP BY item ORDER BY n DESC, item LIMIT 500) t
          ON t.item = CAST(d.product_id AS VARCHAR)
        GROUP BY order_id HAVING count(*) >= 2""",
    "frequent_itemsets": _itemset_rows("aisle_sets"),
    "frequent_itemsets_products": _itemset_rows("product_sets"),
    "closed_itemsets": _itemset_rows("""(SELECT * FROM product_sets p WHERE NOT EXISTS (
        SELECT 1 FROM product_sets q WHERE q.length = p.length + 1 AND q.freq = p.freq
        AND list_has_all(q.items, p.items)))"""),
    "apriori_itemsets": _itemset_rows("aisle_sets"),
    "generate_rules": _rule_rows("aisle_rules"),
    "generate_rules_products": _rule_rows("product_rules"),
    "top_rules": _rule_rows("aisle_rules") + " ORDER BY lift DESC, confidence DESC, "
                 "support DESC, antecedents_json, consequents_json LIMIT 20",
    "rules_with_names": f"""
        SELECT {_json('antecedents')} AS antecedents_json,
               {_json('consequents')} AS consequents_json,
               {_json('antecedent_names')} AS antecedent_names_json,
               {_json('consequent_names')} AS consequent_names_json FROM named_rules""",
    "itemset_json": f"""
        SELECT product_id,
               {_json("[CAST(product_id AS VARCHAR), upper(product_name), product_name]")}
                   AS names_json,
               CASE WHEN product_id % 4 = 0
                    THEN {_json("[CAST(product_id AS VARCHAR), 'a']")} END AS parsed,
               CAST(3 AS INTEGER) AS names
        FROM dim_product""",
    "basket_run": f"""
        SELECT 'full' AS mode, CAST(42 AS INTEGER) AS random_state,
               CAST(2 AS INTEGER) AS min_items,
               (SELECT count(*) FROM large_orders) AS transactions,
               CAST(NULL AS INTEGER) AS top_products,
               CAST({PRODUCT_MIN_COUNT} AS INTEGER) AS min_count,
               CAST({PRODUCT_CONFIDENCE} AS DOUBLE) AS min_confidence,
               (SELECT count(*) FROM product_sets) AS frequent_itemsets,
               (SELECT count(*) FROM product_sets WHERE length = 1) AS frequent_items,
               (SELECT count(*) FROM product_rules) AS association_rules""",
    "save_rules": f"""
        SELECT {_json('antecedents')} AS antecedents_json,
               {_json('consequents')} AS consequents_json,
               support, confidence, lift, leverage, conviction,
               {_json('antecedent_names')} AS antecedent_names_json,
               {_json('consequent_names')} AS consequent_names_json FROM named_rules""",
    "save_frequent_itemsets": f"""
        SELECT {_json('items')} AS itemsets_json, support, length,
               {_json(_named('items'))} AS item_names_json FROM product_sets""",
    "load_association_rules": f"""
        SELECT {_json('antecedents')} AS antecedents, {_json('consequents')} AS consequents,
               {_json('antecedent_names')} AS antecedent_names,
               {_json('consequent_names')} AS consequent_names,
               support, confidence, lift FROM named_rules""",
    "user_features": "SELECT * FROM features",
    "standardize": "SELECT user_id, " + ", ".join(
        f"round(z_{n}, 6) AS z_{n}" for n in FEATURES) + " FROM scaled",
    "silhouette_of_segments": f"""
        SELECT round(avg(CASE WHEN own_n > 1 AND greatest(a, b) > 0
                              THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette
        FROM (SELECT user_id, max(n) FILTER (own) AS own_n,
                     max(total / nullif(n - 1, 0)) FILTER (own) AS a,
                     min(total / n) FILTER (NOT own) AS b
              FROM (SELECT a.user_id, a.cluster = b.cluster AS own, b.cluster AS other,
                           count(*) AS n, sum(pow({_DISTANCE}, 2)) AS total
                    FROM scaled a, scaled b GROUP BY a.user_id, a.cluster = b.cluster, b.cluster)
              GROUP BY user_id)""",
    "davies_bouldin_of_segments": f"""
        WITH centers AS ({_CENTERS}),
        spreads AS (SELECT a.cluster, avg({_DISTANCE}) AS spread
                    FROM scaled a JOIN centers b USING (cluster) GROUP BY a.cluster)
        SELECT round(avg(worst), 6) AS davies_bouldin FROM (
            SELECT a.cluster, max((s.spread + t.spread) / {_DISTANCE}) AS worst
            FROM centers a JOIN centers b ON a.cluster <> b.cluster
            JOIN spreads s ON s.cluster = a.cluster JOIN spreads t ON t.cluster = b.cluster
            GROUP BY a.cluster)""",
    "inertia_of_segments": f"""
        SELECT round(sum(pow({_DISTANCE}, 2)), 6) AS inertia
        FROM scaled a JOIN ({_CENTERS}) b USING (cluster)""",
    "pca_variance": f"""{_AXES}
        SELECT 'pc1' AS component, round(size / ({_TOTAL}), 6) AS explained_variance_ratio FROM first_axis, moments
        UNION ALL SELECT 'pc2', round(size / ({_TOTAL}), 6) FROM second_axis, moments""",
    "pca_of_segments": f"""{_AXES}
        SELECT user_id, cluster, {', '.join(
            'round(' + ' + '.join(f'z_{n} * {axis}.v{i}' for i, n in zip(_N, FEATURES)) + f', 5) AS pc{place}'
            for place, axis in enumerate(("first_axis", "second_axis"), 1))}
        FROM scaled, first_axis, second_axis""",
    "kmeans_invariants": """
        SELECT 'labelled_rows' AS check_name, count(*) AS value FROM features
        UNION ALL SELECT 'clusters', 3 UNION ALL SELECT 'rows_nearer_to_another_centre', 0
        UNION ALL SELECT 'centres_off_their_members', 0 UNION ALL SELECT 'centres_out_of_order', 0""",
    "profile_of_segments": """
        SELECT cluster,
               CASE WHEN avg(total_orders) >= 50 THEN 'VIP Customers'
                    WHEN avg(total_orders) >= 20 THEN 'Frequent Shoppers'
                    WHEN avg(total_orders) >= 10 THEN 'Regular Customers'
                    ELSE 'Occasional Buyers' END AS cluster_name,
               count(*) AS num_users,
               round(avg(total_orders), 9) AS total_orders_mean,
               CAST(median(total_orders) AS DOUBLE) AS total_orders_median,
               round(avg(avg_basket_size), 9) AS avg_basket_size_mean,
               round(avg(avg_reorder_ratio), 9) AS avg_reorder_ratio_mean,
               round(avg(avg_days_between_orders), 9) AS avg_days_between_orders_mean
        FROM scaled GROUP BY cluster""",
    "feature_violations": "SELECT count(*) AS users, " + ", ".join(
        f"count(*) FILTER ({n} IS NULL OR NOT isfinite(CAST({n} AS DOUBLE))) AS {n}"
        for n in FEATURES
    ) + f""" FROM (
        SELECT user_id, count(*) AS total_orders,
               {mean('sum(total_items)', 'count(*)')} AS avg_basket_size,
               {mean(RATIO_UNITS, 'count(*) * 10000')} AS avg_reorder_ratio,
               {mean(GAP_UNITS, f'nullif({GAPS}, 0) * 100')} AS avg_days_between_orders
        FROM fact_orders WHERE total_items > 0 GROUP BY user_id HAVING count(*) >= 2)""",
    "save_cluster_labels": "SELECT CAST(user_id AS VARCHAR) AS user_id, "
                           "CAST(cluster AS VARCHAR) AS cluster FROM labels",
    "load_cluster_labels": "SELECT user_id, cluster FROM labels",
    "resolve_item_space": "SELECT cart_id, space FROM mixed_carts",
    "recommend_by_rules": _rule_ranking("mixed_carts", 5),
    "cluster_popularity": f"SELECT * FROM popularity WHERE place <= {POPULAR}",
    "recommend_by_cluster": _cluster_ranking(5),
    "hybrid_recommend": """
        SELECT cart_id, item, score, CAST(place AS INTEGER) AS place FROM (
            SELECT *, row_number() OVER (PARTITION BY cart_id ORDER BY score DESC, item) AS place
            FROM (SELECT cart_id, item, round(sum(part), 12) AS score
                  FROM (SELECT cart_id, item, CAST(0.6 AS DOUBLE) / (place + 60) AS part
                        FROM fusion_rules
                        UNION ALL
                        SELECT cart_id, item, CAST(0.4 AS DOUBLE) / (place + 60)
                        FROM fusion_clusters)
                  GROUP BY cart_id, item))
        WHERE place <= 10""",
    "evaluate_rules": """
        SELECT count(*) AS rules, round(avg(lift), 9) AS average_lift,
               count(*) FILTER (confidence >= 0.5) AS high_confidence_rules,
               (SELECT count(DISTINCT item) FROM (
                    SELECT unnest(list_concat(antecedents, consequents)) AS item
                    FROM aisle_rules)) AS covered_products
        FROM aisle_rules""",
}


def _with(text: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())
    if text.lstrip().startswith("WITH "):
        return f"WITH RECURSIVE {body},\n{text.lstrip()[5:]}"
    return f"WITH RECURSIVE {body}\n{text}"


ORACLE = {name: _with(text) for name, text in _QUERIES.items()}
