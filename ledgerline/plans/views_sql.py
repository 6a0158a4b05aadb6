"""The adapter views as plain SQL, for the DuckDB oracle.

Each entry mirrors a function in ``ledgerline.sources.adapters``; the two are
written independently (DataFrame code there, SQL here) so the oracle check
tests the Spark code rather than echoing it.
"""

from __future__ import annotations

VIEW_SQL: dict[str, str] = {}

VIEW_SQL["v_products"] = """
SELECT p.p_partkey AS product_id,
       p.p_name AS name,
       CAST(ROUND(p.p_retailprice * 100) AS BIGINT) AS price,
       p.p_size - 1 AS stock,
       CAST(COALESCE(lc.n_lines, 0) AS INTEGER) AS sales_count_week,
       CAST(CAST(p.p_size AS DECIMAL(4,2)) / 10 AS DECIMAL(4,2)) AS rating_average,
       p.p_size AS rating_count,
       p.p_size % 8 AS preparation_days,
       CAST(SUBSTRING(p.p_brand, 7, 100) AS INTEGER) AS category_id,
       p.p_brand AS category_title,
       p.p_type AS status_title,
       p.p_partkey % 3 = 0 AS is_free_shipping,
       p.p_size > 5 AS is_available,
       p.p_size > 1 AS is_saleable,
       s.s_suppkey AS vendor_id,
       s.s_name AS vendor_name,
       LOWER(s.s_name) AS vendor_identifier,
       CASE WHEN s.s_acctbal < 0 THEN 2 ELSE 1 END AS vendor_status_id,
       CASE WHEN s.s_acctbal < 0 THEN 'blocked' ELSE 'active' END AS vendor_status_title,
       CAST(GREATEST(0, FLOOR(s.s_acctbal / 20)) / 100 AS DECIMAL(4,2)) AS vendor_score,
       s.s_suppkey AS vendor_owner_id,
       n.n_name AS vendor_owner_city,
       NULLIF(s.s_nationkey, 0) AS vendor_province_id,
       s.s_nationkey AS vendor_city_id,
       s.s_suppkey % 2 AS vendor_free_shipping_to_iran,
       1 - s.s_suppkey % 2 AS vendor_free_shipping_to_same_city,
       s.s_acctbal > 0 AS vendor_has_delivery,
       p.p_size % 7 <> 0 AS published,
       lc.last_ship AS updated_at
FROM part p
JOIN supplier s ON s.s_suppkey = p.p_partkey % (SELECT GREATEST(COUNT(*), 1) FROM supplier)
JOIN nation n ON n.n_nationkey = s.s_nationkey
LEFT JOIN (SELECT l_partkey, COUNT(*) AS n_lines, MAX(l_shipdate) AS last_ship
           FROM lineitem GROUP BY l_partkey) lc ON lc.l_partkey = p.p_partkey
"""

VIEW_SQL["v_review_log"] = """
SELECT CONCAT(CAST(l.l_orderkey AS VARCHAR), '-', CAST(l.l_linenumber AS VARCHAR)) AS review_id,
       l.l_partkey AS product_id,
       o.o_custkey AS user_id,
       CAST(1 + CAST(l.l_quantity AS INTEGER) % 5 AS SMALLINT) AS star,
       o.o_orderpriority AS description,
       CAST(ROUND(l.l_discount * 100) AS INTEGER) AS like_count,
       CAST(ROUND(l.l_tax * 100) AS INTEGER) AS dislike_count,
       CASE WHEN l.l_linestatus = 'F' THEN '{''photos'': [], ''video'': None}'
            ELSE '{''photos'': [''https://cdn.example.com/p/1.jpg''], ''video'': None}' END AS attachments,
       l.l_returnflag <> 'R' AS is_public,
       l.l_returnflag = 'A' AS is_post,
       o.o_orderdate AS created_at,
       l.l_shipdate AS updated_at,
       l.l_suppkey AS _ord_supplier,
       l.l_extendedprice AS _ord_amount
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
"""

VIEW_SQL["v_reviews"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY review_id
      ORDER BY updated_at DESC, product_id DESC, _ord_supplier DESC, _ord_amount DESC) AS rn
  FROM v_review_log) t
WHERE rn = 1
"""

VIEW_SQL["v_texts"] = """
SELECT CAST(d.doc_id AS VARCHAR) AS review_id,
       d.source AS user_id,
       CAST(CASE WHEN lb.quality = 0 THEN 1 WHEN lb.quality = 1 THEN 5 END AS SMALLINT) AS star,
       d.text AS description
FROM documents d LEFT JOIN labels lb ON lb.doc_id = d.doc_id
"""

VIEW_SQL["v_hourly"] = """
SELECT event_id,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END AS created_at,
       CAST(NULLIF(event_id % 6, 0) AS SMALLINT) AS star
FROM events
"""

VIEW_SQL["v_audit"] = """
SELECT event_id AS audit_id,
       CASE WHEN user_id % 2 = 0 THEN 'products' ELSE 'reviews' END AS table_name,
       CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS operation,
       CAST(user_id AS VARCHAR) AS record_id,
       CASE WHEN event_type = 'error' THEN props END AS old_data,
       CASE WHEN event_type <> 'error' THEN props END AS new_data,
       ts AS changed_at
FROM events
"""

# Which views each view reads, so a query pulls in what it needs, in order.
VIEW_DEPS = {
    "v_reviews": ("v_review_log",),
}


def with_views(body: str, *views: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """Prefix ``body`` with the CTEs it needs (views first, then ``extra``)."""
    ordered: list[str] = []

    def add(v: str) -> None:
        for dep in VIEW_DEPS.get(v, ()):
            add(dep)
        if v not in ordered:
            ordered.append(v)

    for v in views:
        add(v)
    ctes = [f"{v} AS ({VIEW_SQL[v]})" for v in ordered]
    ctes += [f"{name} AS ({sql})" for name, sql in extra]
    if not ctes:
        return body
    return "WITH " + ",\n".join(ctes) + "\n" + body
