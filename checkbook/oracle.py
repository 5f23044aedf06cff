"""Expected answers as DuckDB SQL over the driver's tables.

Money is counted in whole cents, and quotients are rounded half up with integers, so that no
expected value depends on how a binary fraction is rounded.
"""

from __future__ import annotations

from checkbook.fixture import COPIES, expected_reasons, record, shapeless, token
from starmart.functions.text import SPACE
from starmart.schemas import FRAME_COLUMNS, FRAME_KEYS

# ---------------------------------------------------------------- helpers


def div2(num: str, den: str) -> str:
    """num / den to two places, half up, for num >= 0 and den > 0; null for den = 0."""
    n, d = f"cast({num} as hugeint)", f"cast({den} as hugeint)"
    return f"case when {den} = 0 then null else cast((200 * {n} + {d}) // (2 * {d}) as double) / 100 end"


def signed_div2(num: str, den: str) -> str:
    return f"(case when {num} < 0 then -1 else 1 end) * ({div2(f'abs({num})', den)})"


def money(cents: str) -> str:
    return f"cast({cents} as double) / 100"


def big(expr: str) -> str:
    return f"cast({expr} as bigint)"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


# ---------------------------------------------------------------- clean star

PRICE_CENTS = "cast(cast((p_retailprice - 899) * 1.5 as decimal(10,2)) * 100 as bigint)"

STAR = [f"""
goods AS (
  SELECT p_partkey + 1 AS product_id, row_number() OVER (ORDER BY p_partkey) AS product_key, p_name AS title,
         lower(p_type) AS category, upper(p_type[1]) || lower(p_type[2:]) AS category_display,
         {PRICE_CENTS} AS price_c, CASE WHEN p_size % 13 <> 0 THEN p_size END AS tenths
  FROM part)""", """
shelf AS (
  SELECT *, CASE WHEN price_c < 2500 THEN 'budget' WHEN price_c < 10000 THEN 'standard' ELSE 'premium' END AS price_tier,
         CASE WHEN tenths IS NULL THEN 'unrated' WHEN tenths >= 45 THEN 'excellent' WHEN tenths >= 40 THEN 'good'
              WHEN tenths >= 30 THEN 'average' ELSE 'poor' END AS rating_band
  FROM goods)""", """
people AS (
  SELECT c_custkey + 1 AS customer_id, row_number() OVER (ORDER BY c_custkey) AS customer_key,
         'Customer ' || split_part(c_name, '#', 2) AS full_name,
         lower(replace(c_name, '#', '') || '@' || c_mktsegment || '.com') AS email,
         upper(n_name[1]) || lower(n_name[2:]) AS city
  FROM customer JOIN nation ON c_nationkey = n_nationkey)""", """
firsts AS (
  SELECT l_orderkey, l_partkey, cast(l_quantity AS bigint) AS quantity FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey
                             ORDER BY l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_shipdate) = 1)""", """
sales AS (
  SELECT l_orderkey + 1 AS cart_id, o_custkey + 1 AS customer_id, l_partkey + 1 AS product_id,
         cast(o_orderdate AS date) AS day, quantity, price_c, quantity * price_c AS cents
  FROM firsts JOIN orders ON l_orderkey = o_orderkey JOIN shelf ON product_id = l_partkey + 1)""", """
calendar AS (
  SELECT cast(d AS date) AS day, cast(strftime(d, '%Y%m%d') AS bigint) AS date_key, strftime(d, '%Y-%m') AS year_month,
         isodow(d) AS dow, strftime(d, '%A') AS day_name
  FROM (SELECT unnest(generate_series((SELECT min(day) FROM sales), (SELECT max(day) FROM sales), INTERVAL 1 DAY)) AS d))"""]


def star(body: str, *more: str) -> str:
    return with_(*STAR, *more) + body


TILED = """
spend AS (SELECT customer_id, sum(cents) AS c FROM sales GROUP BY customer_id),
tiled AS (SELECT customer_id, c, ntile(4) OVER (ORDER BY c DESC, customer_id) AS tile FROM spend)"""


def mix(column: str) -> str:
    return f"""
mix AS (
  SELECT {column} AS category, count(DISTINCT s.product_id) AS products_sold, count(DISTINCT cart_id) AS orders,
         sum(quantity) AS units_sold, sum(cents) AS c
  FROM sales s JOIN shelf g ON g.product_id = s.product_id GROUP BY {column})"""


QUERIES = {
    "agg_daily_sales": star(f"""
SELECT date_key, day AS full_date, {big('count(DISTINCT cart_id)')} AS orders, {big('sum(quantity)')} AS units_sold,
       {money('sum(cents)')} AS revenue, {div2('sum(cents)', '100 * count(DISTINCT cart_id)')} AS avg_order_value
FROM sales JOIN calendar USING (day) GROUP BY date_key, day"""),
    "agg_category_sales": star(f"""
SELECT category, products_sold, orders, {big('units_sold')} AS units_sold, {money('c')} AS revenue,
       {div2('100 * c', '(SELECT sum(c) FROM mix)')} AS revenue_share
FROM mix""", mix("category")),
    "agg_customer_summary": star(f"""
SELECT customer_key, {big('count(DISTINCT cart_id)')} AS orders, {big('sum(quantity)')} AS units_purchased,
       {money('sum(cents)')} AS revenue, {div2('sum(cents)', '100 * count(DISTINCT cart_id)')} AS avg_order_value,
       min(day) AS first_order_date, max(day) AS last_order_date,
       ['platinum', 'gold', 'silver', 'bronze'][any_value(tile)] AS customer_segment
FROM sales JOIN people USING (customer_id) JOIN tiled USING (customer_id) GROUP BY customer_key""", TILED),
    "q01_monthly_mom": star(f"""
SELECT year_month, {money('c')} AS revenue, orders, {money('before')} AS prev_month_revenue,
       {signed_div2('100 * (c - before)', 'before')} AS mom_growth_pct
FROM (SELECT *, lag(c) OVER (ORDER BY year_month) AS before FROM
      (SELECT strftime(day, '%Y-%m') AS year_month, sum(cents) AS c, count(DISTINCT cart_id) AS orders
       FROM sales GROUP BY 1))"""),
    "q02_top_customers": star(f"""
SELECT place AS revenue_rank, customer_id, full_name, city, {money('c')} AS lifetime_value,
       {div2('100 * c', '(SELECT sum(c) FROM spend)')} AS pct_of_total_revenue
FROM (SELECT customer_id, c, dense_rank() OVER (ORDER BY c DESC) AS place FROM spend) JOIN people USING (customer_id)
ORDER BY place, customer_id LIMIT 10""", TILED),
    "q03_category_mix": star(f"""
SELECT category, orders, {big('units_sold')} AS units_sold, {money('c')} AS revenue,
       {div2('100 * c', '(SELECT sum(c) FROM mix)')} AS revenue_share_pct FROM mix""", mix("category_display")),
    "q04_top3_per_category": star(f"""
SELECT category_display AS category, {big('place')} AS rank_in_category, title, {money('c')} AS revenue, units_sold
FROM (SELECT *, row_number() OVER (PARTITION BY category_display ORDER BY c DESC, title) AS place FROM
      (SELECT category_display, title, sum(cents) AS c, {big('sum(quantity)')} AS units_sold
       FROM sales JOIN shelf USING (product_id) GROUP BY 1, 2))
WHERE place <= 3"""),
    "q05_running_total": star(f"""
SELECT day AS full_date, {money('c')} AS daily_revenue, {money('so_far')} AS cumulative_revenue,
       {div2('week', '100 * days')} AS moving_avg_7_rows
FROM (SELECT day, c, sum(c) OVER (ORDER BY day) AS so_far,
             sum(c) OVER (ORDER BY day ROWS 6 PRECEDING) AS week, count(*) OVER (ORDER BY day ROWS 6 PRECEDING) AS days
      FROM (SELECT day, sum(cents) AS c FROM sales GROUP BY day))"""),
    "q06_aov_by_month": star(f"""
SELECT year_month, count(*) AS orders, {div2('sum(c)', '100 * count(*)')} AS avg_order_value,
       {div2('sum(items)', 'count(*)')} AS avg_items_per_order, {money('max(c)')} AS largest_order
FROM (SELECT strftime(day, '%Y-%m') AS year_month, cart_id, sum(cents) AS c, sum(quantity) AS items
      FROM sales GROUP BY 1, 2) GROUP BY year_month"""),
    "q07_spend_quartiles": star(f"""
SELECT tile AS quartile, count(*) AS customers, {money('min(c)')} AS min_spend, {money('max(c)')} AS max_spend,
       {money('sum(c)')} AS total_revenue, {div2('100 * sum(c)', '(SELECT sum(c) FROM spend)')} AS pct_of_revenue
FROM tiled GROUP BY tile""", TILED),
    "q08_repeat_customers": star(f"""
SELECT customer_type, count(*) AS customers, {div2('sum(n)', 'count(*)')} AS avg_orders, {money('sum(c)')} AS revenue,
       {div2('sum(c)', '100 * count(*)')} AS avg_revenue_per_customer
FROM (SELECT if(n = 1, 'one-time', 'repeat') AS customer_type, n, c FROM
      (SELECT customer_id, count(DISTINCT cart_id) AS n, sum(cents) AS c FROM sales GROUP BY 1))
GROUP BY customer_type"""),
    "q09_day_of_week": star(f"""
SELECT {big('dow')} AS day_of_week, day_name, dow >= 6 AS is_weekend, orders, {money('c')} AS revenue,
       {div2('100 * c', '(SELECT sum(cents) FROM sales)')} AS pct_of_revenue
FROM (SELECT dow, day_name, count(DISTINCT cart_id) AS orders, sum(cents) AS c
      FROM sales JOIN calendar USING (day) GROUP BY 1, 2)"""),
    "q10_price_tier": star(f"""
SELECT price_tier, count(DISTINCT s.product_id) AS products, {big('sum(quantity)')} AS units_sold,
       {money('sum(cents)')} AS revenue, {div2('sum(cents)', '100 * sum(quantity)')} AS avg_selling_price,
       {div2('sum(tenths)', '10 * count(tenths)')} AS avg_rating
FROM sales s JOIN shelf g ON g.product_id = s.product_id GROUP BY price_tier"""),
    "q11_bought_together": star("""
SELECT a.title AS product_a, b.title AS product_b, count(*) AS carts_together
FROM titled a JOIN titled b ON b.cart_id = a.cart_id AND b.product_id > a.product_id
GROUP BY 1, 2 ORDER BY carts_together DESC, product_a, product_b LIMIT 10""",
                               "titled AS (SELECT cart_id, product_id, title FROM sales JOIN shelf USING (product_id))"),
    "q12_recency": star(f"""
SELECT full_name, first_order, last_order, orders, {big('gap')} AS days_since_last_order,
       CASE WHEN gap > 90 THEN 'lapsed' WHEN gap > 30 THEN 'at risk' ELSE 'active' END AS recency_status
FROM (SELECT *, (SELECT max(day) FROM sales) - last_order AS gap FROM
      (SELECT customer_id, min(day) AS first_order, max(day) AS last_order, count(DISTINCT cart_id) AS orders
       FROM sales GROUP BY customer_id)) JOIN people USING (customer_id)"""),
    "q13_rating_vs_sales": star(f"""
SELECT rating_band, count(DISTINCT s.product_id) AS products, {big('sum(quantity)')} AS units_sold,
       {money('sum(cents)')} AS revenue, {div2('sum(quantity)', 'count(DISTINCT s.product_id)')} AS units_per_product,
       {div2('100 * sum(cents)', '(SELECT sum(cents) FROM sales)')} AS pct_of_revenue
FROM sales s JOIN shelf g ON g.product_id = s.product_id GROUP BY rating_band"""),
    "q14_city_pareto": star(f"""
SELECT {big('rank() OVER (ORDER BY c DESC)')} AS city_rank, city, customers, {money('c')} AS revenue,
       {div2('100 * sum(c) OVER (ORDER BY c DESC, city)', '(SELECT sum(cents) FROM sales)')} AS cumulative_pct_of_revenue
FROM (SELECT city, count(DISTINCT customer_id) AS customers, sum(cents) AS c
      FROM sales JOIN people USING (customer_id) GROUP BY city)"""),
}

# ---------------------------------------------------------------- deliveries with defects


def _why(entity: str) -> str:
    reasons = ", ".join(expected_reasons(entity))
    return f"CASE WHEN {shapeless(entity)} THEN 'record_not_an_object' ELSE concat_ws('; ', {reasons}) END"


def _repeat(partition: str, order: str) -> str:
    return f"why = '' AND row_number() OVER (PARTITION BY {partition}, why = '' ORDER BY {order}) > 1"


def _entity(name: str, source: str, key: str, pos: str, repeat: str) -> str:
    return f"""
{name}_in AS (SELECT *, {pos} AS pos FROM ({source}) CROSS JOIN (SELECT unnest([0, 1]) AS c)
              WHERE c = 0 OR ({COPIES[name]})),
{name}_why AS (SELECT *, {key} AS id, {_why(name)} AS why FROM {name}_in),
{name}_all AS (SELECT *, {_repeat(repeat, 'pos')} AS repeated FROM {name}_why),
{name}_ok AS (SELECT * FROM {name}_all WHERE why = '' AND NOT repeated)"""


DELIVERY = [
    _entity("products", "SELECT *, p_partkey AS k FROM part", "k + 1", "k * 2 + c", "k"),
    _entity("users", "SELECT *, c_custkey AS k FROM customer JOIN nation ON c_nationkey = n_nationkey", "k + 1",
            "k * 2 + c", "k"),
    f"""
placed AS (
  SELECT l_orderkey AS k, l_partkey, l_quantity,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_quantity, l_extendedprice,
                                                             l_shipdate, l_partkey) - 1 AS n
  FROM lineitem),
line_texts AS (SELECT k, string_agg({record('cart_items')}, ',' ORDER BY n) AS line_texts FROM placed GROUP BY k)""",
    _entity("carts", """SELECT o.o_orderkey AS k, o_custkey, o_orderdate, line_texts
                        FROM orders o LEFT JOIN line_texts t ON t.k = o.o_orderkey""",
            "k + 1", "k * 2 + c", "k"),
    f"""
cart_facts AS (
  SELECT *, CASE WHEN c = 0 AND k % 109 = 3 THEN 999999999 ELSE o_custkey + 1 END AS user_id,
         {token('carts', 'date')}[2:-2] AS date_text,
         cast(o_orderdate AS date) + CASE WHEN k % 3 = 2 THEN 1 ELSE 0 END AS day
  FROM carts_ok),
lines_in AS (
  SELECT c.id AS cart_id, user_id, date_text, day, n AS line, l.l_partkey, l.l_quantity, 0 AS c,
         {record('cart_items')} AS line_text
  FROM cart_facts c JOIN placed l ON l.k = c.k WHERE c.c = 0
  UNION ALL
  SELECT id, user_id, date_text, day, 0, 0, 1, 1, '{{"productId":1,"quantity":1}}' FROM cart_facts WHERE c = 1),
lines_why AS (
  SELECT *, l_partkey + 1 AS product_id, cast(l_quantity AS bigint) AS quantity,
         CASE WHEN c = 1 THEN '' ELSE concat_ws('; ', {', '.join(expected_reasons('cart_items'))}) END AS why
  FROM lines_in),
lines_all AS (
  SELECT *, CASE WHEN why <> '' THEN why WHEN repeated THEN 'duplicate_key:cart_id+product_id'
                 ELSE concat_ws('; ', CASE WHEN no_user THEN 'orphan_reference:user_id' END,
                                      CASE WHEN no_product THEN 'orphan_reference:product_id' END) END AS reason
  FROM (SELECT *, {_repeat('cart_id, product_id', 'line')} AS repeated,
               user_id NOT IN (SELECT id FROM users_ok) AS no_user,
               product_id NOT IN (SELECT id FROM products_ok) AS no_product
        FROM lines_why)),
cart_items_ok AS (SELECT * FROM lines_all WHERE reason = '')""",
]


def delivery(body: str, *more: str) -> str:
    return with_(*DELIVERY, *more) + body


def each(select: str, entities=("products", "users", "carts")) -> str:
    return "\nUNION ALL\n".join(select.format(e=e) for e in entities)


LINE_POS = "cart_id * 1000000 + line"


def single_reasons(prefix: str) -> str:
    parts = []
    for e in ("products", "users", "carts"):
        for reason in expected_reasons(e):
            parts.append(f"SELECT '{e}' AS entity, pos, {reason} AS reason FROM {e}_in WHERE NOT coalesce({shapeless(e)}, false)")
    for reason in expected_reasons("cart_items"):
        parts.append(f"SELECT 'cart_items' AS entity, {LINE_POS} AS pos, {reason} AS reason FROM lines_in WHERE c = 0")
    return f"SELECT entity, pos, reason FROM ({' UNION ALL '.join(parts)}) WHERE reason LIKE '{prefix}%'"


def token_text(entity: str, path: str) -> str:
    t = f"({token(entity, path)})"
    return f"CASE WHEN {t} = 'null' THEN null WHEN {t} LIKE '\"%' THEN {t}[2:-2] ELSE {t} END"


def field_text(entity: str, path: str) -> str:
    """A field's text; of numbers, as they compare, without closing zeros."""
    t = f"({token(entity, path)})"
    return f"CASE WHEN regexp_matches({t}, '^-?[0-9]+[.][0-9]+$') THEN rtrim(rtrim({t}, '0'), '.') ELSE {token_text(entity, path)} END"


REASON = "CASE WHEN repeated THEN 'duplicate_key:id' ELSE why END"

CART_ITEM_RAW = """
'{"cart_id":' || cart_id || ',"line":' || line_text || ',"order_date":"' || date_text || '"'
|| CASE WHEN line_text = '"oops"' THEN '' ELSE ',"product_id":' || (line_text::json->'productId')::varchar
        || ',"quantity":' || (line_text::json->'quantity')::varchar END
|| ',"user_id":' || user_id || '}'"""

COUNTS = ("counts AS (" + each(
    "SELECT '{e}' AS entity, count(*) AS input_count, count(*) FILTER (why = '' AND NOT repeated) AS valid_count FROM {e}_all"
) + " UNION ALL SELECT 'cart_items', count(*), count(*) FILTER (reason = '') FROM lines_all)")

ID_FIELDS = "address,email,id,name,password,phone,username"

SOLD = f"""
sold AS (
  SELECT l.*, CASE WHEN p.c = 0 AND p.k % 31 = 2 THEN 1999 ELSE {PRICE_CENTS} END AS price_c
  FROM cart_items_ok l JOIN products_ok p ON p.id = l.product_id)"""

CALENDAR = """
SELECT cast(strftime(d, '%Y%m%d') AS bigint) AS date_key, cast(d AS date) AS full_date, year(d) AS year,
       quarter(d) AS quarter, month(d) AS month, strftime(d, '%B') AS month_name, strftime(d, '%Y-%m') AS year_month,
       weekofyear(d) AS week_of_year, day(d) AS day, isodow(d) AS day_of_week, strftime(d, '%A') AS day_name,
       isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series((SELECT min(day) FROM sold), (SELECT max(day) FROM sold), INTERVAL 1 DAY)) AS d)"""

TITLE = "list_aggregate(list_transform(string_split({x}, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')"


def squash(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{SPACE}]+', ' ', 'g'))"


# The declared fields of each entity.
FIELDS = {
    "products": ["id", "title", "price", "description", "category", "image", "rating.rate", "rating.count"],
    "users": ["id", "email", "username", "phone", "name.firstname", "name.lastname", "address.city", "address.street", "address.number",
              "address.zipcode", "address.geolocation.lat", "address.geolocation.long"],
    "carts": ["id", "userId", "date"],
}

QUERIES |= {
    "ingest_records": with_(*DELIVERY) + each(
        "SELECT '{e}' AS entity, count(*) AS records, cast(count(*) * (count(*) - 1) // 2 AS bigint) AS pos_sum, "
        "count(*) - 1 AS pos_max FROM {e}_in"),
    "redact_fields": delivery(f"""
SELECT pos, CASE WHEN NOT ({shapeless('users')}) THEN concat_ws(',', 'address',
         CASE WHEN NOT (c = 0 AND k % 59 = 4 AND k % 53 <> 3) THEN 'email' END, 'id',
         CASE WHEN NOT (c = 0 AND k % 109 = 13) THEN 'name' END, CASE WHEN k % 7 <> 0 THEN 'phone' END,
         'username') END AS field_names,
       CASE WHEN NOT ({shapeless('users')}) THEN {token_text('users', 'username')} END AS username
FROM users_in"""),
    "ingest_arrays": delivery(" UNION ALL ".join(
        f"SELECT '{e}' AS entity, {record(e)} AS rec FROM {e}_in" for e in ("products", "users", "carts"))),
    "raw_zone_roundtrip": delivery(" UNION ALL ".join(
        f"SELECT '{e}' AS entity, pos, {record(e)} AS rec FROM {e}_in" for e in ("products", "users", "carts"))),
    "incremental_scan": delivery(f"""
SELECT pos FROM (SELECT *, cast(o_orderdate AS date) + CASE WHEN k % 3 = 2 THEN 1 ELSE 0 END AS day FROM carts_in)
WHERE ({shapeless('carts')}) OR (c = 0 AND k % 103 = 1) OR day >= DATE '1998-06-29'"""),
    "rejected_rows": delivery(
        " UNION ALL ".join(
            f"SELECT '{e}' AS entity, {REASON} AS reject_reason, {record(e)} AS raw_record FROM {e}_all WHERE why <> '' OR repeated"
            for e in ("products", "users", "carts"))
        + f" UNION ALL SELECT 'cart_items', reason, {CART_ITEM_RAW} FROM lines_all WHERE reason <> ''"),
    "zone_partitions": delivery(each(
        "SELECT '{e}' AS entity, DATE '2030-01-01' AS dt, count(*) AS records FROM {e}_all WHERE why <> '' OR repeated")
        + " UNION ALL SELECT 'cart_items', DATE '2030-01-01', count(*) FROM lines_all WHERE reason <> ''"),
    "flatten_records": delivery(" UNION ALL ".join(
        f"SELECT '{e}' AS entity, pos, '{p.replace('.', '_')}' AS field, CASE WHEN NOT ({shapeless(e)}){' AND k % 103 <> 9' if p.startswith('rating') else ''} THEN {field_text(e, p)} END AS value FROM {e}_in"
        for e, fields in FIELDS.items() for p in fields)),
    "reject_non_object": with_(*DELIVERY) + each(
        "SELECT '{e}' AS entity, pos FROM {e}_why WHERE why = 'record_not_an_object'"),
    "check_required": delivery(single_reasons("missing_required")),
    "check_types": delivery(single_reasons("invalid_type")),
    "check_ranges": delivery(single_reasons("out_of_range")),
    "check_pattern": delivery(single_reasons("invalid_format")),
    "reject_reasons": with_(*DELIVERY) + each(
        "SELECT '{e}' AS entity, pos, why AS reject_reason FROM {e}_why WHERE why <> ''")
        + f" UNION ALL SELECT 'cart_items', {LINE_POS}, why FROM lines_why WHERE why <> ''",
    "dedup_first_wins": with_(*DELIVERY) + each("SELECT '{e}' AS entity, pos FROM {e}_all WHERE repeated")
        + f" UNION ALL SELECT 'cart_items', {LINE_POS} FROM lines_all WHERE reason = 'duplicate_key:cart_id+product_id'",
    "explode_cart_lines": delivery("SELECT cart_id, user_id, date_text AS order_date, line, line_text FROM lines_in"),
    "orphan_lines": delivery("SELECT cart_id, line, reason FROM lines_all WHERE reason LIKE 'orphan%'"),
    "validation_counts": delivery("""
SELECT entity, input_count, valid_count, input_count - valid_count AS rejected_count,
       (input_count - valid_count) / input_count AS reject_ratio FROM counts""", COUNTS),
    "validate_all": delivery("""
SELECT cart_id, user_id, date_text AS order_date, product_id, quantity FROM cart_items_ok"""),
    # cleaning functions
    "squash_spaces": f"SELECT doc_id, {squash('text')} AS cleaned FROM documents",
    "title_case": f"SELECT c_custkey, {TITLE.format(x=squash('x'))} AS titled FROM (SELECT c_custkey, "
                  f"'  ' || c_mktsegment || chr(9) || ' o''NEIL-' || lower(n_name) || '  ' AS x "
                  f"FROM customer JOIN nation ON c_nationkey = n_nationkey)",
    "price_tier": star("SELECT product_id, price_tier FROM shelf"),
    "rating_band": star("SELECT product_id, rating_band FROM shelf"),
    "email_domain": star("SELECT customer_id, regexp_extract(email, '[^@]*$') AS email_domain FROM people"),
    "utc_order_date": """
SELECT event_id, cast(ts + CASE event_id % 3 WHEN 0 THEN INTERVAL 0 HOUR WHEN 1 THEN INTERVAL 5 HOUR
                      ELSE INTERVAL (-330) MINUTE END AS date) AS order_date FROM events""",
    "date_key": "SELECT o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') AS bigint) AS date_key FROM orders",
    # star builders
    "dim_product": delivery(f"""
SELECT id AS product_id, CASE WHEN c = 1 THEN p_name || ' again' ELSE p_name || ' ' || p_brand END AS title,
       lower(p_type) || ' goods' AS category, upper(p_type[1]) || lower(p_type[2:]) || ' Goods' AS category_display,
       CASE WHEN k % 13 = 0 THEN '' ELSE 'About ' || p_name END AS description,
       CASE WHEN k % 17 = 0 THEN '' ELSE 'http://img/' || k || '.png' END AS image_url,
       {money('price_c')} AS price,
       CASE WHEN price_c < 2500 THEN 'budget' WHEN price_c < 10000 THEN 'standard' ELSE 'premium' END AS price_tier,
       tenths / 10 AS rating_rate, CASE WHEN k % 103 <> 9 THEN k % 500 END AS rating_count,
       CASE WHEN tenths IS NULL THEN 'unrated' WHEN tenths >= 45 THEN 'excellent' WHEN tenths >= 40 THEN 'good'
            WHEN tenths >= 30 THEN 'average' ELSE 'poor' END AS rating_band
FROM (SELECT *, CASE WHEN c = 0 AND k % 31 = 2 THEN 1999 ELSE {PRICE_CENTS} END AS price_c,
             CASE WHEN k % 103 <> 9 AND p_size % 13 <> 0 THEN p_size END AS tenths FROM products_ok)"""),
    "dim_customer": delivery("""
SELECT id AS customer_id, lower(replace(c_name, '#', '') || '@' || c_mktsegment || '.com') AS email,
       'user' || k AS username, first || ' The' AS first_name, 'Van Der ' || k AS last_name,
       first || ' The Van Der ' || k AS full_name, CASE WHEN k % 7 = 0 THEN '' ELSE '1-' || k END AS phone,
       'Old ' || upper(n_name[1]) || lower(n_name[2:]) AS city,
       trim(CASE WHEN k % 11 = 0 AND NOT (c = 0 AND k % 79 = 9) THEN '' ELSE cast(k % 1000 AS varchar) END || ' '
            || CASE WHEN k % 19 = 0 THEN '' ELSE 'Old Mill Road' END) AS street_address,
       (k % 99) || '-1' AS zipcode, k % 90 + 0.25::double AS latitude, -(k % 180) - 0.5::double AS longitude,
       lower(c_mktsegment) || '.com' AS email_domain
FROM (SELECT *, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS first FROM users_ok)"""),
    "fact_sales": delivery(f"""
SELECT cart_id, user_id AS customer_id, product_id, cast(strftime(day, '%Y%m%d') AS bigint) AS date_key,
       day AS order_date, quantity, {money('price_c')} AS unit_price, {money('quantity * price_c')} AS line_total
FROM sold""", SOLD),
    "dim_date": delivery(CALENDAR, SOLD),
    "processed_schema": delivery(f"""
SELECT 'dim_product' AS entity, 'PASS' AS status, count(*) AS frame_rows FROM products_ok
UNION ALL SELECT 'dim_customer', 'PASS', count(*) FROM users_ok
UNION ALL SELECT 'fact_sales', 'PASS', count(*) FROM sold
UNION ALL SELECT 'dim_date', 'PASS', count(*) FROM ({CALENDAR})""", SOLD),
    # whole runs
    "end_to_end_load": delivery(f"""
SELECT cart_id, user_id AS customer_id, product_id, cast(strftime(day, '%Y%m%d') AS bigint) AS date_key, quantity,
       {money('price_c')} AS unit_price, {money('quantity * price_c')} AS line_total FROM sold""", SOLD),
    "run_audit": delivery("""
SELECT 'full' AS run_id, 'SUCCESS' AS status, true AS full_refresh,
       (SELECT input_count FROM counts WHERE entity = 'carts') AS carts_extracted,
       (SELECT valid_count FROM counts WHERE entity = 'products') AS products_valid,
       (SELECT input_count - valid_count FROM counts WHERE entity = 'cart_items') AS cart_items_rejected,
       (SELECT count(*) FROM sold) AS sales_inserted""", COUNTS, SOLD),
    "watermark_advance": delivery("SELECT 'fact_sales' AS entity, max(day) AS watermark_value FROM sold", SOLD),
    "publish_snapshot": delivery(f"""
SELECT 'dim_product' AS table_name, count(*) AS table_rows FROM products_ok
UNION ALL SELECT 'dim_customer', count(*) FROM users_ok
UNION ALL SELECT 'fact_sales', count(*) FROM sold
UNION ALL SELECT 'dim_date', count(*) FROM ({CALENDAR})
UNION ALL SELECT 'agg_daily_sales', count(DISTINCT day) FROM sold
UNION ALL SELECT 'agg_category_sales', count(DISTINCT lower(p_type)) FROM sold JOIN part ON p_partkey = product_id - 1
UNION ALL SELECT 'agg_customer_summary', count(DISTINCT user_id) FROM sold""", SOLD),
}
QUERIES["incremental_load"] = QUERIES["end_to_end_load"]
QUERIES["landed_scan"] = QUERIES["incremental_scan"]

# ---------------------------------------------------------------- upserts on the clean star

BATCH = """
batch AS (
  SELECT cart_id, customer_id, product_id, CASE WHEN cart_id % 13 = 0 THEN day + 40 ELSE day END AS day,
         CASE WHEN cart_id % 11 = 0 THEN quantity + 1 ELSE quantity END AS quantity, price_c FROM sales WHERE cart_id % 2 = 0
  UNION ALL
  SELECT cart_id + 100000000, customer_id, product_id, day, quantity, price_c FROM sales WHERE cart_id % 17 = 0),
acted AS (
  SELECT *, CASE WHEN cart_id > 100000000 THEN 'insert' WHEN cart_id % 13 = 0 OR cart_id % 11 = 0 THEN 'update'
                 ELSE 'unchanged' END AS action FROM batch)"""

QUERIES |= {
    "insert_if_absent": star("SELECT date_key FROM calendar WHERE day > DATE '1998-06-30'"),
    "upsert_dim": star(" UNION ALL ".join(f"""
SELECT '{name}' AS table_name, {key} AS natural_key, {value} AS value, {key} % 10 <> 3 AND {key} % 7 = 1 AS changed, {key} % 10 = 3 AS inserted FROM {table}
UNION ALL SELECT '{name}', {key} + 10000000, {value}, false, false FROM {table} WHERE {key} % 50 = 0"""
        for name, key, value, table in (("dim_customer", "customer_id", "city", "people"), ("dim_product", "product_id", "title", "shelf")))),
    "unmapped_fact_rows": star("""
SELECT count(*) FILTER (customer_id % 19 = 0 OR product_id % 23 = 0 OR strftime(day, '%Y-%m') = '1997-05') AS unmapped,
       count(*) AS staged FROM sales"""),
    "surrogate_lookup": star("""
SELECT cart_id, s.product_id, customer_key, product_key, cast(strftime(day, '%Y%m%d') AS bigint) AS date_key
FROM sales s JOIN people USING (customer_id) JOIN shelf g ON g.product_id = s.product_id"""),
    "surrogate_keys": star("""
SELECT 'dim_customer' AS table_name, customer_id AS natural_key, customer_key AS surrogate_key FROM people
UNION ALL SELECT 'dim_product', product_id, product_key FROM shelf"""),
    "upsert_fact": star(f"""
SELECT cart_id, product_key, cast(strftime(day, '%Y%m%d') AS bigint) AS date_key, quantity, action,
       CASE WHEN cart_id < 100000000 THEN cast(strftime(CASE WHEN cart_id % 13 = 0 THEN day - 40 ELSE day END, '%Y%m')
            AS bigint) END AS old_month
FROM acted JOIN shelf USING (product_id)""", BATCH),
    "load_counts": star("""
SELECT count(*) AS staged, count(*) FILTER (action = 'insert') AS inserted,
       count(*) FILTER (action = 'update') AS updated, count(*) FILTER (action = 'unchanged') AS unchanged
FROM acted""", BATCH),
}

# ---------------------------------------------------------------- checks on a damaged star

DAMAGE = """
bad_fact AS (
  SELECT cart_id, customer_key, CASE WHEN cart_id % 97 <> 0 THEN product_key END AS product_key,
         cast(strftime(day, '%Y%m%d') AS bigint) AS date_key, day, CASE WHEN cart_id % 31 = 0 THEN 0 ELSE quantity END AS quantity,
         CASE WHEN cart_id % 41 = 0 THEN -100 ELSE s.price_c END AS price_c,
         CASE WHEN cart_id % 37 = 0 THEN cents + 1 ELSE cents END AS cents,
         row_number() OVER (ORDER BY cart_id, s.product_id) AS sales_key
  FROM sales s JOIN people USING (customer_id) JOIN shelf g ON g.product_id = s.product_id
  CROSS JOIN (SELECT unnest([0, 1]) AS c) WHERE c = 0 OR cart_id % 89 = 0),
bad_people AS (
  SELECT customer_id, customer_key, CASE WHEN customer_id % 29 <> 0 THEN email END AS email FROM people
  CROSS JOIN (SELECT unnest([0, 1]) AS c) WHERE customer_id % 19 <> 0 AND (c = 0 OR customer_id % 43 = 0)),
bad_shelf AS (
  SELECT product_id, product_key, CASE WHEN product_id % 31 = 0 THEN 0 ELSE price_c END AS price_c,
         CASE WHEN product_id % 53 = 0 THEN 'cheap' ELSE price_tier END AS price_tier,
         CASE WHEN product_id % 59 = 0 THEN 60 ELSE tenths END AS tenths FROM shelf WHERE product_id % 23 <> 0),
bad_days AS (
  SELECT day, date_key, CASE WHEN day(day) = 31 THEN 5 ELSE quarter(day) END AS quarter FROM calendar
  WHERE year_month <> '1997-05'),
buyers AS (SELECT DISTINCT customer_id, customer_key FROM sales JOIN people USING (customer_id))"""


def damaged(body: str) -> str:
    return star(body, DAMAGE)


def _status(actual: str) -> str:
    return f"cast({actual} AS varchar) AS actual, CASE WHEN {actual} = 0 THEN 'PASS' ELSE 'FAIL' END AS status"


def _checks(rows: list[tuple[str, str, str]]) -> str:
    """(check, entity, scalar subquery) -> one row each."""
    parts = [f"SELECT '{c}' AS check_name, '{e}' AS entity, cast(coalesce(({q}), 0) AS bigint) AS a" for c, e, q in rows]
    return f"SELECT check_name, entity, {_status('a')} FROM ({' UNION ALL '.join(parts)})"


def _surplus(table: str, keys: str) -> str:
    return f"SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})"


def _violations(rows: list[tuple[str, str, str, str]]) -> str:
    parts = [f"SELECT '{t}' AS table_name, '{r}' AS rule, '{s}' AS subject, cast(coalesce(({q}), 0) AS bigint) AS violations"
             for t, r, s, q in rows]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE violations > 0"


QUERIES |= {
    "dq_record_counts": delivery("""
SELECT entity, cast(input_count AS varchar) AS expected, cast(input_count AS varchar) AS actual, 'PASS' AS status
FROM counts""", COUNTS),
    "dq_reject_ratio": delivery("""
SELECT entity, printf('%.1f%%', 100 * (input_count - valid_count) / input_count) AS actual,
       CASE WHEN (input_count - valid_count) / input_count <= 0.3 THEN 'PASS' ELSE 'FAIL' END AS status
FROM counts""", COUNTS),
    "dq_null_keys": damaged(_checks([
        ("null_keys", "dim_date", "SELECT 0"), ("null_keys", "dim_customer", "SELECT 0"),
        ("null_keys", "dim_product", "SELECT 0"),
        ("null_keys", "fact_sales", "SELECT count(*) FROM sales CROSS JOIN (SELECT unnest([0, 1]) AS c) "
                                    "WHERE (c = 0 OR cart_id % 89 = 0) AND cart_id % 97 = 0")])),
    "dq_duplicate_keys": damaged(_checks([
        ("duplicate_keys", "dim_date", "SELECT 0"),
        ("duplicate_keys", "dim_customer", "SELECT count(*) FROM people WHERE customer_id % 43 = 0"),
        ("duplicate_keys", "dim_product", "SELECT 0"),
        ("duplicate_keys", "fact_sales", _surplus("bad_fact", "cart_id, product_key"))])),
    "dq_loaded_rows": star("""
SELECT 'fact_sales' AS entity, cast(count(*) AS varchar) AS expected,
       cast(count(*) FILTER (cart_id % 31 <> 0) AS varchar) AS actual,
       CASE WHEN count(*) FILTER (cart_id % 31 = 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM sales
UNION ALL SELECT 'dim_customer', cast(count(*) AS varchar), cast(count(*) FILTER (customer_id % 19 <> 0) AS varchar),
                 'FAIL' FROM people
UNION ALL SELECT 'dim_product', cast(count(*) AS varchar), cast(count(*) AS varchar), 'PASS' FROM shelf
UNION ALL SELECT 'dim_date', cast(count(*) AS varchar), cast(count(*) AS varchar), 'PASS' FROM calendar"""),
    "dq_business_keys": damaged(_checks([
        ("duplicate_business_keys", "dim_customer", _surplus("bad_people", "customer_id")),
        ("duplicate_business_keys", "dim_product", _surplus("bad_shelf", "product_id")),
        ("duplicate_business_keys", "dim_date", _surplus("bad_days", "date_key")),
        ("duplicate_business_keys", "fact_sales",
         "SELECT count(*) FROM (SELECT 1 FROM bad_fact GROUP BY cart_id, product_key HAVING count(*) > 1)")])),
    "dq_orphan_fks": damaged(_checks([
        ("orphan_customer_fk", "fact_sales", "SELECT count(*) FROM bad_fact WHERE customer_key NOT IN (SELECT customer_key FROM bad_people)"),
        ("orphan_product_fk", "fact_sales",
         "SELECT count(*) FROM bad_fact WHERE product_key IS NULL OR product_key NOT IN (SELECT product_key FROM bad_shelf)"),
        ("orphan_date_fk", "fact_sales", "SELECT count(*) FROM bad_fact WHERE date_key NOT IN (SELECT date_key FROM bad_days)")])),
    "dq_measures": damaged(_checks([
        ("non_positive_measures", "fact_sales", "SELECT count(*) FROM bad_fact WHERE quantity <= 0 OR price_c < 0 OR cents < 0")])),
    "dq_line_total": damaged(_checks([
        ("line_total_equals_qty_x_price", "fact_sales", "SELECT count(*) FROM bad_fact WHERE cents <> quantity * price_c")])),
    "dq_agg_reconcile": damaged(_checks([
        ("agg_daily_revenue_reconciles", "agg_daily_sales",
         "SELECT CASE WHEN (SELECT sum(cents) FROM sales) = (SELECT sum(cents) FROM bad_fact) THEN 0 ELSE 1 END"),
        ("agg_category_revenue_reconciles", "agg_category_sales",
         "SELECT CASE WHEN (SELECT sum(cents) FROM sales) = (SELECT sum(cents) FROM bad_fact) THEN 0 ELSE 1 END")])),
    "constraint_not_null": damaged(_violations([
        ("dim_customer", "not null", "email", "SELECT count(*) FROM bad_people WHERE email IS NULL"),
        ("fact_sales", "not null", "product_key", "SELECT count(*) FROM bad_fact WHERE product_key IS NULL"),
        ("agg_daily_sales", "not null", "avg_order_value", "SELECT count(DISTINCT day) FROM sales WHERE day(day) % 10 = 1"),
        ("data_quality_results", "not null", "entity", "SELECT 7")])),
    "constraint_check": damaged(_violations([
        ("dim_date", "check", "quarter between 1 and 4", "SELECT count(*) FROM bad_days WHERE quarter > 4"),
        ("dim_product", "check", "price > 0", "SELECT count(*) FROM bad_shelf WHERE price_c <= 0"),
        ("dim_product", "check", "price_tier in (''budget'', ''standard'', ''premium'')",
         "SELECT count(*) FROM bad_shelf WHERE price_tier = 'cheap'"),
        ("dim_product", "check", "rating_rate between 0 and 5", "SELECT count(*) FROM bad_shelf WHERE tenths > 50"),
        ("fact_sales", "check", "quantity > 0", "SELECT count(*) FROM bad_fact WHERE quantity <= 0"),
        ("fact_sales", "check", "unit_price >= 0", "SELECT count(*) FROM bad_fact WHERE price_c < 0"),
        ("agg_customer_summary", "length", "customer_segment <= 20",
         "SELECT sum(CASE WHEN customer_key % 41 = 0 THEN 2 ELSE 1 END) FROM buyers WHERE customer_key % 37 = 0"),
        ("etl_run_audit", "check", "status in (''RUNNING'', ''SUCCESS'', ''FAILED'')", "SELECT 1"),
        ("data_quality_results", "check", "status in (''PASS'', ''FAIL'', ''WARN'')", "SELECT 4")])),
    "constraint_unique": damaged(_violations([
        ("dim_customer", "unique", "customer_key", _surplus("bad_people", "customer_key")),
        ("dim_customer", "unique", "customer_id", _surplus("bad_people", "customer_id")),
        ("fact_sales", "unique", "sales_key",
         "SELECT count(*) FROM sales WHERE cart_id % 89 = 0"),
        ("fact_sales", "unique", "cart_id+product_key", _surplus("bad_fact", "cart_id, product_key")),
        ("agg_customer_summary", "unique", "customer_key", "SELECT count(*) FROM buyers WHERE customer_key % 41 = 0"),
        ("etl_run_audit", "unique", "run_id", "SELECT 1")])),
    "constraint_fk": damaged(_violations([
        ("fact_sales", "references dim_customer", "customer_key",
         "SELECT count(*) FROM bad_fact WHERE customer_key NOT IN (SELECT customer_key FROM bad_people)"),
        ("fact_sales", "references dim_product", "product_key",
         "SELECT count(*) FROM bad_fact WHERE product_key IS NULL OR product_key NOT IN (SELECT product_key FROM bad_shelf)"),
        ("fact_sales", "references dim_date", "date_key", "SELECT count(*) FROM bad_fact WHERE date_key NOT IN (SELECT date_key FROM bad_days)"),
        ("agg_daily_sales", "references dim_date", "date_key",
         "SELECT count(DISTINCT day) FROM sales WHERE strftime(day, '%Y-%m') = '1997-05'"),
        ("agg_customer_summary", "references dim_customer", "customer_key",
         "SELECT sum(CASE WHEN customer_key % 41 = 0 THEN 2 ELSE 1 END) FROM buyers WHERE customer_id % 19 = 0"),
        ("data_quality_results", "references etl_run_audit", "run_id", "SELECT 4")])),
}
QUERIES["dq_summary"] = star("SELECT status, checks FROM (SELECT 'PASS' AS status, count(*) FILTER (n = 0) AS checks FROM faults "
                             "UNION ALL SELECT 'WARN', 0 UNION ALL SELECT 'FAIL', count(*) FILTER (n > 0) FROM faults)",
                             DAMAGE, f"""
faults AS (
  SELECT coalesce(({_surplus('bad_people', 'customer_id')}), 0) AS n
  UNION ALL SELECT coalesce(({_surplus('bad_shelf', 'product_id')}), 0)
  UNION ALL SELECT coalesce(({_surplus('bad_days', 'date_key')}), 0)
  UNION ALL SELECT count(*) FROM (SELECT 1 FROM bad_fact GROUP BY cart_id, product_key HAVING count(*) > 1))""")


QUERIES["processed_roundtrip"] = delivery(f"""
SELECT 'fact_sales' AS entity, cart_id * 1000000 + product_id AS frame_key,
       concat_ws('|', quantity, price_c, quantity * price_c, day) AS frame_values FROM sold
UNION ALL SELECT 'dim_date', date_key, concat_ws('|', full_date, month_name, week_of_year, is_weekend) FROM days
UNION ALL SELECT 'dim_customer', customer_id, concat_ws('|', email, full_name, street_address, cast(floor(latitude) AS bigint)) FROM people_out
UNION ALL SELECT 'dim_product', product_id, concat_ws('|', title, category, cast(round(price * 100) AS bigint), price_tier, coalesce(cast(rating_count AS varchar), '-'))
FROM goods_out""", SOLD, f"days AS ({CALENDAR})", *[
    f"{name} AS (SELECT * FROM ({QUERIES[query].removeprefix(with_(*DELIVERY))}))" for name, query in (("people_out", "dim_customer"), ("goods_out", "dim_product"))])

# ---------------------------------------------------------------- whole sets of checks

TABLE_ROWS = """
SELECT 'dim_date' AS entity, count(*) AS table_rows FROM calendar
UNION ALL SELECT 'dim_customer', count(*) FROM people
UNION ALL SELECT 'dim_product', count(*) FROM shelf
UNION ALL SELECT 'fact_sales', count(*) FROM sales
UNION ALL SELECT 'agg_daily_sales', count(DISTINCT day) FROM sales
UNION ALL SELECT 'agg_category_sales', count(DISTINCT category) FROM sales JOIN shelf USING (product_id)
UNION ALL SELECT 'agg_customer_summary', count(DISTINCT customer_id) FROM sales"""
FRAME_NAMES = ["dim_date", "dim_customer", "dim_product", "fact_sales"]
AGGREGATE_NAMES = ["agg_daily_sales", "agg_category_sales", "agg_customer_summary"]


def _same(check: str, entities: list[str], status: str) -> str:
    return " UNION ALL ".join(f"SELECT '{check}' AS check_name, '{e}' AS entity, '{status}' AS status" for e in entities)


QUERIES["dq_warehouse_schema"] = star(f"""
SELECT entity, CASE entity WHEN 'dim_product' THEN 'FAIL' ELSE 'PASS' END AS status,
       CASE entity WHEN 'dim_product' THEN 'missing=[''rating_band'']' ELSE 'missing=[]' END AS actual, table_rows FROM ({TABLE_ROWS})""")

_LOADED = damaged("""
SELECT 'loaded_row_count' AS check_name, entity, CASE WHEN lost = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
  SELECT 'dim_date' AS entity, count(*) FILTER (year_month = '1997-05') AS lost FROM calendar
  UNION ALL SELECT 'dim_customer', count(*) FILTER (customer_id % 19 = 0) FROM people
  UNION ALL SELECT 'dim_product', count(*) FILTER (product_id % 23 = 0) FROM shelf
  UNION ALL SELECT 'fact_sales', count(*) FILTER (product_id % 23 = 0 OR cart_id % 97 = 0) FROM sales)""")

# nested, as each part brings its own tables
QUERIES["dq_gate"] = " UNION ALL ".join([
    f"SELECT 'record_count_reconciliation' AS check_name, entity, status FROM ({QUERIES['dq_record_counts']})",
    f"SELECT 'reject_ratio_threshold', entity, status FROM ({QUERIES['dq_reject_ratio']})",
    _same("processed_schema", FRAME_NAMES, "PASS"),
    *[f"SELECT check_name, entity, status FROM ({QUERIES[q]})" for q in (
        "dq_null_keys", "dq_duplicate_keys", "dq_business_keys", "dq_orphan_fks", "dq_measures", "dq_line_total", "dq_agg_reconcile")],
    f"SELECT 'warehouse_schema', entity, status FROM ({QUERIES['dq_warehouse_schema']})",
    f"SELECT * FROM ({_LOADED})"])


def _results(rows: list[tuple[str, str, str, str, str]]) -> str:
    """(check, entity, expected, actual, details), the last three as SQL."""
    return " UNION ALL ".join(
        f"SELECT 'full' AS run_id, '{c}' AS check_name, '{e}' AS entity, 'PASS' AS status, cast({x} AS varchar) AS expected, "
        f"cast({a} AS varchar) AS actual, {d} AS details" for c, e, x, a, d in rows)


def _text(value) -> str:
    return "'" + str(value).replace("'", "''") + "'"


_ZERO = [
    *[(c, n, "0", "0", _text(f"key={FRAME_KEYS[n]}")) for c in ("null_keys", "duplicate_keys") for n in FRAME_NAMES],
    *[("duplicate_business_keys", n, "0", "0", "''") for n in FRAME_NAMES],
    *[(c, "fact_sales", "0", "0", "''") for c in ("orphan_customer_fk", "orphan_product_fk", "orphan_date_fk", "non_positive_measures",
                                                  "line_total_equals_qty_x_price")],
    ("agg_daily_revenue_reconciles", "agg_daily_sales", "0", "0", "''"), ("agg_category_revenue_reconciles", "agg_category_sales", "0", "0", "''"),
    *[("processed_schema", n, _text(FRAME_COLUMNS[n]), _text(FRAME_COLUMNS[n]), "''") for n in FRAME_NAMES],
    *[("warehouse_schema", n, "'all expected columns'", "'missing=[]'", "''") for n in [*FRAME_NAMES, *AGGREGATE_NAMES]],
]
QUERIES["dq_results"] = delivery(f"""
SELECT 'full' AS run_id, 'record_count_reconciliation' AS check_name, entity, 'PASS' AS status, cast(input_count AS varchar) AS expected,
       cast(input_count AS varchar) AS actual, printf('valid=%d rejected=%d', valid_count, input_count - valid_count) AS details FROM counts
UNION ALL SELECT 'full', 'reject_ratio_threshold', entity, 'PASS', '<= 50%', printf('%.1f%%', 100 * (input_count - valid_count) / input_count),
       printf('%d/%d rejected', input_count - valid_count, input_count) FROM counts
UNION ALL SELECT 'full', 'loaded_row_count', entity, 'PASS', cast(frame_rows AS varchar), cast(frame_rows AS varchar), '' FROM ({
    QUERIES['processed_schema'].removeprefix(with_(*DELIVERY, SOLD))})
UNION ALL {_results(_ZERO)}""", COUNTS, SOLD)
