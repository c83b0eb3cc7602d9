"""Independent SQL formulations of the registered queries (DuckDB dialect).

Each string runs on the pre-registered views of the benchmark tables and
must return the same rows, column names and types as the Spark query of
the same key in ``__spark_entry__.queries()``.  Panels are rebuilt here
from the raw tables with window functions (the Spark side uses grouped
aggregates), so the two sides share no code path.
"""

from __future__ import annotations

K = 20

PANEL_A = """
panel_ranked AS (
    SELECT user_id, event_type, CAST(ts AS DATE) AS scrape_date, value,
           ROW_NUMBER() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                              ORDER BY ts DESC, event_id DESC) AS rn,
           MAX(value) OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)) AS day_max
    FROM events
),
products AS (
    SELECT CAST(user_id AS VARCHAR) AS product_id,
           event_type AS store,
           scrape_date,
           'product ' || CAST(user_id AS VARCHAR) AS name,
           'brand-' || CAST(user_id % 7 AS VARCHAR) AS brand,
           event_type AS maincat,
           CAST(NULL AS VARCHAR) AS cat,
           CAST(NULL AS VARCHAR) AS subcat,
           CAST(NULL AS VARCHAR) AS catid,
           'https://img.example.com/' || CAST(user_id AS VARCHAR) || '.jpg' AS image,
           value AS price,
           day_max AS pricewithoutdiscount,
           day_max AS list_price,
           user_id % 10 <> 0 AS is_available,
           'https://shop.example.com/' || event_type || '/' || CAST(user_id AS VARCHAR) AS link,
           event_type AS maincatid
    FROM panel_ranked WHERE rn = 1
)"""

PANEL_B = """
part_regions AS (
    SELECT DISTINCT l.l_partkey AS p_partkey, n.n_regionkey AS r_regionkey
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
                    JOIN nation n ON s.s_nationkey = n.n_nationkey
),
weeks AS (SELECT CAST(w AS INTEGER) AS week FROM range(0, 6) t(w)),
panel_base AS (
    SELECT p.p_partkey, p.p_name, p.p_brand, p.p_type, p.p_size, p.p_retailprice,
           r.r_regionkey, lower(r.r_name) AS store, wk.week,
           FLOOR(p.p_retailprice * (100 + ((p.p_partkey * 7 + r.r_regionkey * 11 + wk.week * 13) % 21) - 10) + 0.5) / 100
               AS list_price
    FROM part_regions pr JOIN part p ON p.p_partkey = pr.p_partkey
                         JOIN region r ON r.r_regionkey = pr.r_regionkey
                         JOIN weeks wk ON TRUE
),
products AS (
    SELECT CAST(p_partkey AS VARCHAR) AS product_id,
           store,
           CAST(DATE '2026-01-06' + week * 7 AS DATE) AS scrape_date,
           p_name AS name,
           p_brand AS brand,
           p_type AS maincat,
           p_brand AS cat,
           'size ' || CAST(p_size AS VARCHAR) AS subcat,
           '/' || lower(p_type) || '/' || CAST(p_size AS VARCHAR) || '/' AS catid,
           'https://img.example.com/p/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS image,
           FLOOR(list_price * (100 - ((p_partkey * 5 + r_regionkey * 17 + week * 19) % 23)) + 0.5) / 100 AS price,
           list_price AS pricewithoutdiscount,
           list_price,
           (p_partkey + r_regionkey * 3 + week) % 17 <> 0 AS is_available,
           'https://shop.example.com/' || replace(store, ' ', '-') || '/p/' || CAST(p_partkey AS VARCHAR) AS link,
           lower(p_type) AS maincatid
    FROM panel_base
)"""

#: One grouped pass: what a product cost on either of the two newest days.
PRICE_CHANGES = """
newest_days AS (
    SELECT newest, (SELECT max(scrape_date) FROM products WHERE scrape_date < newest) AS older
    FROM (SELECT max(scrape_date) AS newest FROM products)
),
two_prices AS (
    SELECT product_id, store,
           max(list_price) FILTER (WHERE scrape_date = older) AS prev_list_price,
           max(price) FILTER (WHERE scrape_date = older) AS prev_price,
           any_value(struct_pack(name := name, brand := brand, link := link, image := image, open := is_available,
                                 day := scrape_date, listed := list_price, paid := price))
               FILTER (WHERE scrape_date = newest) AS cur
    FROM products, newest_days
    GROUP BY product_id, store
),
price_changes AS (
    SELECT product_id, store, cur.name AS name, cur.brand AS brand, cur.link AS link, cur.image AS image,
           cur.open AS is_available, cur.day AS scrape_date, cur.listed AS list_price, cur.paid AS price,
           prev_list_price, prev_price,
           cur.listed - prev_list_price AS list_price_diff,
           (cur.listed - prev_list_price) / prev_list_price * 100 AS list_price_pct_change,
           cur.paid - prev_price AS price_diff,
           (cur.paid - prev_price) / prev_price * 100 AS price_pct_change
    FROM two_prices
    WHERE least(prev_list_price, prev_price) > 0 AND prev_list_price IS NOT NULL AND prev_price IS NOT NULL
      AND cur.open AND NOT (cur.listed = prev_list_price AND cur.paid = prev_price)
)"""

INCREASES = f"""
rep_increases AS (
    SELECT name, product_id, brand, store, link, image, scrape_date, prev_list_price,
           list_price AS current_list_price, list_price_diff AS price_increase,
           FLOOR(list_price_pct_change * 100 + 0.5) / 100 AS pct_increase,
           CAST(ROW_NUMBER() OVER (PARTITION BY store ORDER BY list_price_pct_change DESC, product_id)
                AS INTEGER) AS rank
    FROM price_changes
    WHERE list_price > prev_list_price
    QUALIFY rank <= {K}
)"""

DECREASES = f"""
rep_decreases AS (
    SELECT name, product_id, brand, is_available, store, link, image, scrape_date, prev_list_price,
           list_price AS current_list_price, prev_list_price - list_price AS price_decrease,
           FLOOR((prev_list_price - list_price) / prev_list_price * 100 * 100 + 0.5) / 100 AS pct_decrease,
           CAST(ROW_NUMBER() OVER (PARTITION BY store
                                   ORDER BY (prev_list_price - list_price) / prev_list_price DESC, product_id)
                AS INTEGER) AS rank
    FROM price_changes
    WHERE prev_list_price > 0 AND list_price < prev_list_price AND is_available
    QUALIFY rank <= {K}
)"""

DISCOUNTS = f"""
rep_discounts AS (
    SELECT name, product_id, brand, store, link, image, scrape_date, prev_price,
           price AS current_price, prev_price - price AS price_decrease,
           FLOOR(-price_pct_change * 100 + 0.5) / 100 AS pct_decrease,
           CAST(ROW_NUMBER() OVER (PARTITION BY store ORDER BY price_pct_change, product_id) AS INTEGER) AS rank
    FROM price_changes
    WHERE price < prev_price AND price < list_price
    QUALIFY rank <= {K}
)"""

#: One grouped pass by age in days: the average of ages 1 to 30 beside the row of age 0.
AVG_30D = """
aged AS (
    SELECT *, date_diff('day', scrape_date, max(scrape_date) OVER ()) AS age FROM products
),
price_book AS (
    SELECT product_id, store,
           count(*) FILTER (WHERE age BETWEEN 1 AND 30) AS seen,
           SUM(FLOOR(price * 10000 + 0.5)) FILTER (WHERE age BETWEEN 1 AND 30) AS units,
           count(price) FILTER (WHERE age BETWEEN 1 AND 30) AS priced,
           any_value(struct_pack(name := name, brand := brand, link := link, image := image, paid := price))
               FILTER (WHERE age = 0 AND is_available) AS cur
    FROM aged
    GROUP BY product_id, store
),
trailing_avg AS (
    SELECT product_id, store, cur, FLOOR(units / 10000 / priced * 100 + 0.5) / 100 AS avg_price_30d
    FROM price_book WHERE seen > 0
)"""

#: A deal's rank is one more than the number of better deals of its store.
DEALS = f"""
open_deals AS (
    SELECT *, (avg_price_30d - cur.paid) / avg_price_30d AS gain
    FROM trailing_avg WHERE cur.paid < avg_price_30d AND avg_price_30d > 0
),
placed_deals AS (
    SELECT d.store, d.product_id, count(b.product_id) AS better
    FROM open_deals d LEFT JOIN open_deals b
      ON b.store = d.store AND (b.gain > d.gain OR (b.gain = d.gain AND b.product_id < d.product_id))
    GROUP BY d.store, d.product_id
),
rep_deals AS (
    SELECT cur.name AS name, product_id, cur.brand AS brand, store, cur.link AS link, cur.image AS image,
           cur.paid AS current_price, avg_price_30d, FLOOR(gain * 100 * 100 + 0.5) / 100 AS pct_discount,
           CAST(better + 1 AS INTEGER) AS rank
    FROM placed_deals JOIN open_deals USING (store, product_id)
    WHERE better < {K}
)"""

REPORT_CTES = {
    "list_price_increases": ("rep_increases", [PRICE_CHANGES, INCREASES]),
    "list_price_decreases": ("rep_decreases", [PRICE_CHANGES, DECREASES]),
    "discounts": ("rep_discounts", [PRICE_CHANGES, DISCOUNTS]),
    "avg_deals_30d": ("rep_deals", [AVG_30D, DEALS]),
}


def with_ctes(panel: str, *ctes: str) -> str:
    return "WITH " + ",".join([panel, *ctes])


def products_sql(panel: str) -> str:
    return with_ctes(panel) + "\nSELECT * FROM products"


def price_changes_sql(panel: str) -> str:
    return with_ctes(panel, PRICE_CHANGES) + "\nSELECT * FROM price_changes"


def latest_two_dates_sql(panel: str) -> str:
    return with_ctes(panel) + "\nSELECT DISTINCT scrape_date FROM products ORDER BY scrape_date DESC LIMIT 2"


def avg_price_30d_sql(panel: str) -> str:
    return with_ctes(panel, AVG_30D) + "\nSELECT product_id, store, avg_price_30d FROM trailing_avg"


def report_sql(panel: str, report: str) -> str:
    name, ctes = REPORT_CTES[report]
    return with_ctes(panel, *ctes) + f"\nSELECT * FROM {name} ORDER BY store, rank"


def report_stores_sql(panel: str, report: str) -> str:
    name, ctes = REPORT_CTES[report]
    return with_ctes(panel, *ctes) + f"\nSELECT DISTINCT store FROM {name} ORDER BY store"


def history_sql(panel: str, report: str) -> str:
    name, ctes = REPORT_CTES[report]
    return with_ctes(panel, *ctes) + f"""
SELECT p.product_id, p.store, p.scrape_date, p.list_price, p.price
FROM products p
WHERE EXISTS (SELECT 1 FROM {name} r WHERE r.product_id = p.product_id AND r.store = p.store)
ORDER BY p.product_id, p.store, p.scrape_date"""


_FEED_TABS = [
    ("list_price_increases", "list_increase", "TRUE", "prev_list_price", "current_list_price", "pct_increase"),
    ("list_price_decreases", "list_decrease", "FALSE", "prev_list_price", "current_list_price", "pct_decrease"),
    ("discounts", "price_decrease", "FALSE", "prev_price", "current_price", "pct_decrease"),
    ("avg_deals_30d", "best_deals", "FALSE", "avg_price_30d", "current_price", "pct_discount"),
]

NO_IMAGE_SQL = (
    "'data:image/svg+xml,%3Csvg xmlns=''http://www.w3.org/2000/svg'' width=''72'' height=''72''%3E"
    "%3Crect width=''72'' height=''72'' fill=''%23e0e0e0''/%3E"
    "%3Ctext x=''50%25'' y=''55%25'' dominant-baseline=''middle'' text-anchor=''middle'' "
    "fill=''%23999'' font-size=''10''%3ENo img%3C/text%3E%3C/svg%3E'"
)


def feed_sql(panel: str) -> str:
    ctes = [PRICE_CHANGES, INCREASES, DECREASES, DISCOUNTS, AVG_30D, DEALS]
    parts = []
    for report, tab, inc, before, after, pct in _FEED_TABS:
        rep = REPORT_CTES[report][0]
        parts.append(f"""
    SELECT '{tab}' AS tab, {inc} AS is_increase, store, rank, product_id,
           replace(replace(coalesce(name, ''), '<', '&lt;'), '>', '&gt;') AS name,
           replace(replace(coalesce(brand, ''), '<', '&lt;'), '>', '&gt;') AS brand,
           CASE WHEN starts_with(image, 'http') THEN image ELSE {NO_IMAGE_SQL} END AS image,
           coalesce(link, '#') AS link,
           {before} AS before, {after} AS after, {pct} AS pct_change
    FROM {rep}""")
    entries = "entries AS (" + "\n    UNION ALL".join(parts) + "\n)"
    return with_ctes(panel, *ctes, entries) + """
SELECT e.*, p.scrape_date, p.list_price, p.price
FROM entries e LEFT JOIN products p ON p.product_id = e.product_id AND p.store = e.store
ORDER BY e.tab, e.store, e.rank, p.scrape_date"""


def violations_sql(panel: str, report: str) -> str:
    # A sound report has no violations: the oracle is the typed empty result.
    return with_ctes(panel) + """
SELECT CAST(NULL AS VARCHAR) AS report, CAST(NULL AS VARCHAR) AS store,
       CAST(NULL AS VARCHAR) AS product_id, CAST(NULL AS INTEGER) AS rank,
       CAST(NULL AS VARCHAR) AS rule
FROM products WHERE FALSE"""


# --- normalisers (composed payloads are rebuilt flat from ``part``) -------------------

def _part_cat(expr_ge5: str, expr_lt5: str) -> str:
    return f"CASE WHEN p_size >= 5 THEN {expr_ge5} ELSE {expr_lt5} END"


_LEAF = "'/' || p_type || '/' || p_brand || '/' || CAST(p_size AS VARCHAR) || '/'"
_MID = "'/' || p_type || '/' || p_brand || '/'"
_TOP = "'/' || p_type || '/'"

CATALOG_A_FLAT = f"""
catalog_a AS (
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, 'store_a' AS store, p_name AS name, p_brand AS brand,
           {_part_cat(_LEAF, _MID)} AS maincat,
           {_part_cat(_MID, _TOP)} AS cat,
           CASE WHEN p_size >= 5 THEN {_TOP} END AS subcat,
           CAST(p_size AS VARCHAR) AS catid,
           CASE WHEN p_size % 2 = 0 THEN 'https://img-a.example.com/' || CAST(p_partkey AS VARCHAR) || '.jpg' END
               AS image,
           FLOOR(p_retailprice * 90 + 0.5) / 100 AS price,
           p_retailprice AS pricewithoutdiscount,
           p_retailprice AS list_price,
           p_size > 3 AS is_available,
           'https://shop-a.example.com/p/' || CAST(p_partkey AS VARCHAR) AS link,
           p_size, p_retailprice
    FROM part
)"""

PRODUCT_COLS = ("product_id, store, name, brand, maincat, cat, subcat, catid, image, price, "
                "pricewithoutdiscount, list_price, is_available, link")


def catalog_a_sql() -> str:
    return f"WITH {CATALOG_A_FLAT}\nSELECT {PRODUCT_COLS} FROM catalog_a"


def price_override_sql() -> str:
    return f"""WITH {CATALOG_A_FLAT},
found AS (SELECT *, (p_size % 3 <> 0 AND p_size <= 45) AS hit FROM catalog_a)
SELECT product_id, store, name, brand, maincat, cat, subcat, catid, image,
       CASE WHEN hit THEN FLOOR(p_retailprice * 95 + 0.5) / 100 ELSE price END AS price,
       CASE WHEN hit THEN FLOOR(p_retailprice * 95 + 0.5) / 100 ELSE pricewithoutdiscount END
           AS pricewithoutdiscount,
       CASE WHEN hit THEN FLOOR(p_retailprice * 100 + 0.5) / 100 ELSE list_price END AS list_price,
       hit AS is_available, link
FROM found"""


CATALOG_B_FLAT = """
catalog_b AS (
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, 'store_b' AS store, p_name AS name, p_brand AS brand,
           p_type AS maincat, p_brand AS cat, 'size ' || CAST(p_size AS VARCHAR) AS subcat,
           CAST(p_size AS VARCHAR) AS catid,
           CASE WHEN p_size % 2 = 1 THEN 'https://img-b.example.com/' || CAST(p_partkey AS VARCHAR) || '.png' END
               AS image,
           CASE WHEN p_size % 3 = 0 THEN FLOOR(p_retailprice * 80 + 0.5) / 100 ELSE p_retailprice END AS price,
           p_retailprice AS pricewithoutdiscount,
           p_retailprice AS list_price,
           p_size % 4 IN (0, 1, 2) AS is_available,
           'https://shop-b.example.com/p/' || CAST(p_partkey AS VARCHAR) AS link
    FROM part
)"""


def catalog_b_sql() -> str:
    return f"WITH {CATALOG_B_FLAT}\nSELECT {PRODUCT_COLS} FROM catalog_b"


def price_fold_sql() -> str:
    return f"WITH {CATALOG_B_FLAT}\nSELECT product_id, price, pricewithoutdiscount, list_price FROM catalog_b"


_TREE_JOIN = """
tj AS (
    SELECT s.s_suppkey, s.s_name, n.n_nationkey, n.n_name, r.r_regionkey, r.r_name,
           CAST(r.r_regionkey + 1 AS VARCHAR) AS rid, CAST(n.n_nationkey + 100 AS VARCHAR) AS nid,
           CAST(s.s_suppkey + 10000 AS VARCHAR) AS sid
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
                    JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


def _tree_cte(name: str, store: str, style: str) -> str:
    if style == "names":
        base = "'https://shop-a.example.com'"
        l1 = f"{base} || '/' || replace(r_name, ' ', '-')"
        l2 = f"{l1} || '/' || replace(n_name, ' ', '-')"
        l3 = f"{l2} || '/' || replace(s_name, ' ', '-')"
    else:
        base = "'https://shop-b.example.com/c/'"
        l1 = f"{base} || rid || '/'"
        l2 = f"{l1} || nid || '/'"
        l3 = f"{l2} || sid || '/'"
    return f"""
{name} AS (
    SELECT DISTINCT rid AS id, '{store}' AS store, r_name AS name, CAST(NULL AS VARCHAR) AS parent_id,
           '/' || rid || '/' AS path, CAST(1 AS INTEGER) AS level, {l1} AS link FROM tj
    UNION ALL
    SELECT DISTINCT nid, '{store}', n_name, rid, '/' || rid || '/' || nid || '/', CAST(2 AS INTEGER), {l2} FROM tj
    UNION ALL
    SELECT sid, '{store}', s_name, nid, '/' || rid || '/' || nid || '/' || sid || '/', CAST(3 AS INTEGER), {l3}
    FROM tj
)"""


def tree_sql(store: str, style: str) -> str:
    return f"WITH {_TREE_JOIN}, {_tree_cte('cats', store, style)}\nSELECT * FROM cats"


def categories_sql() -> str:
    return (f"WITH {_TREE_JOIN}, {_tree_cte('cats_a', 'store_a', 'names')}, "
            f"{_tree_cte('cats_b', 'store_b', 'ids')}\n"
            "SELECT * FROM cats_a UNION ALL SELECT * FROM cats_b")


def select_categories_sql(store: str, name: str) -> str:
    return (f"WITH {_TREE_JOIN}, {_tree_cte('cats_a', 'store_a', 'names')}, "
            f"{_tree_cte('cats_b', 'store_b', 'ids')},\n"
            "cats AS (SELECT * FROM cats_a UNION ALL SELECT * FROM cats_b)\n"
            f"SELECT path FROM cats WHERE level = 3 AND store = '{store}' AND split_part(path, '/', 2) IN "
            f"(SELECT id FROM cats WHERE store = '{store}' AND name = '{name}') ORDER BY path")


# --- URL hierarchy and links over ``pages`` --------------------------------------------

_URL_PATH = r"coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '')"


def url_hierarchy_sql(store: str) -> str:
    return rf"""
WITH u AS (
    SELECT page_id, string_split(regexp_replace({_URL_PATH}, '^/+|/+$', '', 'g'), '/') AS parts FROM pages
),
pre AS (
    SELECT page_id, parts, unnest(generate_series(1, len(parts))) AS level FROM u
),
pre2 AS (
    SELECT page_id, level, parts[level] AS part, '/' || array_to_string(parts[1:level], '/') AS full_path FROM pre
),
firsts AS (
    SELECT full_path, min(page_id) AS first, min(level) AS level, arg_min(part, page_id) AS part
    FROM pre2 GROUP BY full_path
),
ided AS (
    SELECT *, 1000 + ROW_NUMBER() OVER (ORDER BY first, level) AS id FROM firsts
)
SELECT CAST(c.id AS BIGINT) AS id, '{store}' AS store,
       array_to_string(list_transform(string_split(lower(replace(c.part, '-', ' ')), ' '),
                                      lambda w: upper(w[1]) || w[2:]), ' ') AS name,
       CAST(coalesce(p.id, 0) AS BIGINT) AS parent_id,
       c.full_path || '/' AS path, CAST(c.level AS INTEGER) AS level
FROM ided c LEFT JOIN ided p
  ON c.level > 1 AND p.full_path = regexp_replace(c.full_path, '/[^/]*$', '')"""


_ANCHOR_SQL = r"""'<a\s[^>]*?href="([^"]*)"[^>]*>([^<]*)</a>'"""


def html_links_sql() -> str:
    return f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, href, trim(text) AS text FROM (
    SELECT page_id,
           unnest(regexp_extract_all(html, {_ANCHOR_SQL}, 1)) AS href,
           unnest(regexp_extract_all(html, {_ANCHOR_SQL}, 2)) AS text,
           unnest(range(1, len(regexp_extract_all(html, {_ANCHOR_SQL}, 1)) + 1)) AS pos
    FROM pages)"""


def store_union_sql() -> str:
    b = PANEL_B.replace("products AS (", "products_b AS (")
    return with_ctes(PANEL_A, b) + "\nSELECT * FROM products UNION ALL SELECT * FROM products_b"


# --- landed files, gates, stored categories, broken tables ------------------------------

def gated_stream_sql() -> str:
    """Run 1 sees the day's first events only, run 2 the last ones."""
    first = PANEL_A.replace("ORDER BY ts DESC, event_id DESC", "ORDER BY ts, event_id")
    return f"""SELECT *, 1 AS run FROM ({with_ctes(first)} SELECT * FROM products)
UNION ALL SELECT *, 2 AS run FROM ({with_ctes(PANEL_A)} SELECT * FROM products)"""


_STORED_CATS = f"""{_TREE_JOIN}, {_tree_cte('cats_a', 'store_a', 'names')}, {_tree_cte('cats_b', 'store_b', 'ids')},
stored AS (
    SELECT id, store, name || CASE WHEN CAST(id AS BIGINT) % 2 = 0 THEN ' v2' ELSE '' END AS name, parent_id, path, level, link
    FROM cats_a UNION ALL SELECT * FROM cats_b
)"""


def stored_categories_sql() -> str:
    return f"WITH {_STORED_CATS}\nSELECT * FROM stored"


def select_stored_sql() -> str:
    return f"""WITH {_STORED_CATS},
leaves AS (SELECT path FROM stored WHERE store = 'store_a' AND level = 3)
SELECT path FROM leaves
WHERE split_part(path, '/', 2) IN (SELECT id FROM stored WHERE store = 'store_a' AND name = 'ASIA' AND level = 1)
  AND path >= coalesce((SELECT min(path) FROM leaves WHERE path LIKE '/3/112/%'), '') ORDER BY path"""


def quarantine_sql() -> str:
    return """SELECT '0003' AS load, '{"totalCount": 1, "products": [{"name": "' || n_name AS raw, CAST(NULL AS BIGINT) AS "totalCount"
FROM nation"""


def landed_override_sql() -> str:
    """Even parts take the later simulation if it has a price for them, all others the earlier one."""
    return f"""WITH {CATALOG_A_FLAT},
chosen AS (
    SELECT *, CAST(product_id AS BIGINT) % 2 = 0 AND p_size % 3 <> 0 AND p_size <= 45 AS later FROM catalog_a
),
priced AS (
    SELECT *, CASE WHEN later THEN FLOOR(p_retailprice * 95 + 0.5) ELSE FLOOR(p_retailprice * 190 + 0.5) END / 100 AS paid,
           CASE WHEN later THEN FLOOR(p_retailprice * 100 + 0.5) ELSE FLOOR(p_retailprice * 200 + 0.5) END / 100 AS listed
    FROM chosen
)
SELECT product_id, store, name, brand, maincat, cat, subcat, catid, image, paid AS price, paid AS pricewithoutdiscount,
       listed AS list_price, TRUE AS is_available, link
FROM priced"""


def dirty_ingest_sql() -> str:
    return with_ctes(PANEL_B) + """
SELECT product_id, store, DATE '2026-04-13' AS scrape_date, name, brand, maincat, cat, subcat, catid, image,
       CASE WHEN CAST(product_id AS BIGINT) % 11 IN (0, 2) THEN NULL ELSE price END AS price, pricewithoutdiscount,
       CASE WHEN CAST(product_id AS BIGINT) % 13 = 0 THEN NULL ELSE list_price END AS list_price,
       CASE WHEN CAST(product_id AS BIGINT) % 5 = 0 THEN NULL ELSE is_available END AS is_available, link, maincatid
FROM products WHERE scrape_date = DATE '2026-01-13'"""


def dropped_partition_sql() -> str:
    return with_ctes(PANEL_B) + "\nSELECT * FROM products WHERE scrape_date > (SELECT min(scrape_date) FROM products)"


def backfill_by_category_sql() -> str:
    return with_ctes(PANEL_B) + """
SELECT * REPLACE (CASE WHEN CAST(product_id AS BIGINT) % 10 = 9 THEN 'gone' WHEN CAST(product_id AS BIGINT) % 4 = 0 THEN catid
                       ELSE md5(maincatid) END AS catid,
                  CASE WHEN CAST(product_id AS BIGINT) % 10 <> 9 THEN maincatid END AS maincatid)
FROM products"""


_VIOLATION = "'{kind}' AS report, store, {product} AS product_id, CAST({rank} AS INTEGER) AS rank, '{rule}' AS rule"


def _violation_rows(kind: str, rules: dict[str, str], rank: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT {_VIOLATION.format(kind=kind, product='product_id', rank=rank, rule=rule)} FROM broken WHERE coalesce({cond}, TRUE)"
        for rule, cond in rules.items())


def broken_report_sql() -> str:
    name, ctes = REPORT_CTES["discounts"]
    broken = f"""
broken AS (
    SELECT store, product_id,
           CASE rank WHEN 2 THEN 0.0 WHEN 3 THEN NULL WHEN 4 THEN 99999.0 ELSE pct_decrease END AS pct,
           CASE rank WHEN 5 THEN NULL ELSE prev_price END AS before,
           CASE rank WHEN 6 THEN prev_price + 1 ELSE current_price END AS after,
           CASE rank WHEN 7 THEN 8 WHEN 20 THEN 25 ELSE rank END AS rank
    FROM {name} WHERE rank <> 9
)"""
    rows = _violation_rows("discounts", {
        "rank_out_of_range": f"rank NOT BETWEEN 1 AND {K}", "non_positive_pct": "NOT pct > 0",
        "missing_before": "before IS NULL", "wrong_direction": "NOT after < before"}, "rank")
    gap = _VIOLATION.format(kind="discounts", product="CAST(NULL AS VARCHAR)", rank="NULL", rule="rank_gap")
    order = _VIOLATION.format(kind="discounts", product="CAST(NULL AS VARCHAR)", rank="rank", rule="rank_order")
    return with_ctes(PANEL_B, *ctes, broken) + f"""
{rows}
UNION ALL SELECT {gap} FROM broken GROUP BY store HAVING max(rank) <> count(*) OR count(DISTINCT rank) <> count(*)
UNION ALL SELECT {order} FROM (SELECT DISTINCT a.store, a.rank FROM broken a JOIN broken b
                               ON a.store = b.store AND a.rank = b.rank + 1 AND a.pct > b.pct)"""


def broken_changes_sql() -> str:
    broken = """
told AS (SELECT *, CAST(product_id AS BIGINT) % 20 AS k, max(scrape_date) OVER () AS newest FROM price_changes),
once AS (
    SELECT * REPLACE (CASE WHEN k = 1 THEN CAST(scrape_date - INTERVAL 7 DAY AS DATE) ELSE scrape_date END AS scrape_date,
                      CASE k WHEN 2 THEN NULL WHEN 3 THEN FALSE ELSE is_available END AS is_available,
                      CASE k WHEN 4 THEN 0.0 WHEN 5 THEN NULL WHEN 6 THEN price ELSE prev_price END AS prev_price,
                      CASE k WHEN 6 THEN list_price ELSE prev_list_price END AS prev_list_price)
    FROM told
),
broken AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE k = 7)"""
    rows = _violation_rows("price_changes", {
        "not_latest_date": "scrape_date <> newest", "not_available": "NOT is_available",
        "missing_previous": "NOT (prev_list_price > 0 AND prev_price > 0)",
        "unchanged": "NOT (list_price <> prev_list_price OR price <> prev_price)"}, "NULL")
    again = _VIOLATION.format(kind="price_changes", product="product_id", rank="NULL", rule="repeated_key")
    return with_ctes(PANEL_B, PRICE_CHANGES, broken) + f"""
{rows}
UNION ALL SELECT {again} FROM broken GROUP BY store, product_id HAVING count(*) > 1"""


def feed_labels_sql(panel: str) -> str:
    body = feed_sql(panel)
    at = body.rindex("SELECT e.*")
    label = """SELECT e.*, printf('%s %.1f%%  ($%.2f \u2192 $%.2f)', CASE WHEN is_increase THEN '\u25b2' ELSE '\u25bc' END,
       pct_change, before, after) AS label"""
    return body[:at] + label + body[at + len("SELECT e.*"):]


def product_tiles_sql() -> str:
    return """
SELECT p_partkey // 24 AS page_id, CAST(ROW_NUMBER() OVER (PARTITION BY p_partkey // 24 ORDER BY p_partkey) AS INTEGER) AS tile,
       CASE WHEN p_size % 3 < 2 THEN CAST(p_partkey AS VARCHAR) END AS pid,
       CASE WHEN p_size % 7 <> 0 THEN p_name || ' & ' || p_brand END AS name,
       CASE WHEN p_size % 7 <> 0 THEN 'https://shop.example.com/p/' || CAST(p_partkey AS VARCHAR) || '?a=1&b=2' END AS url,
       CASE WHEN p_size % 5 <> 0 THEN '$' || CAST(p_retailprice AS VARCHAR) END AS price,
       CASE WHEN p_size % 4 <> 0 THEN '/i/' || CAST(p_partkey AS VARCHAR) || '.jpg' END AS image
FROM part"""


def sitemap_urls_sql() -> str:
    return """SELECT url FROM pages WHERE url IS NOT NULL
UNION ALL SELECT DISTINCT 'https://maps.example.com/' || CAST(page_id // 40 AS VARCHAR) || '.xml' FROM pages WHERE url IS NOT NULL"""


def url_paths_sql() -> str:
    return """
WITH bare AS (
    SELECT page_id, split_part(split_part(split_part(url, '://', 2), '?', 1), '#', 1) AS rest FROM pages WHERE url IS NOT NULL
),
tails AS (SELECT page_id, CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/')) ELSE '' END AS tail FROM bare)
SELECT page_id AS url_index, CASE WHEN page_id % 4 = 3 THEN ltrim(tail, '/') ELSE tail END AS path FROM tails"""
