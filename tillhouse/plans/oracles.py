"""The same queries as plain SQL over the given tables."""

from __future__ import annotations

import re

from tillhouse.operators.generate import DRAWS, PRIME, SPREAD

WINDOW = "BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-01-01'"

VIEWS = {
    "store": "SELECT CAST(r_regionkey + 1 AS BIGINT) AS store_id, r_name AS db_name FROM region",
    "card": """
        SELECT CAST(n_regionkey + 1 AS BIGINT) * 10000000 + c_custkey AS card_id,
               CAST(n_regionkey + 1 AS BIGINT) AS store_id, c_custkey AS local_id,
               '4' || lpad(CAST(c_custkey AS VARCHAR), 15, '0') AS number,
               c_mktsegment AS first_name,
               CASE WHEN c_acctbal >= 0 THEN n_name END AS middle_name,
               c_name AS last_name,
               CAST(DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER) AS DATE) AS birth_date,
               TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey * 37 % 2400 AS INTEGER)) AS modified_at,
               c_acctbal AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "maker": """
        SELECT s_suppkey AS supplier_id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS inn,
               s_acctbal AS balance FROM supplier""",
    "product": """
        SELECT p_partkey AS product_id, p_name AS name, p_brand AS vendor_code,
               p_partkey % (SELECT count(*) FROM supplier) AS supplier_id, p_size AS size,
               TIMESTAMP '1995-01-01' + to_days(CAST(p_partkey * 37 % 2400 AS INTEGER)) AS created_at
        FROM part""",
    "chk": """
        SELECT o_orderkey AS check_id, card_id, o_orderdate AS check_date, o_orderstatus = 'F' AS payed,
               CAST(1 + o_orderkey % 2 AS INTEGER) AS payment_form, store_id
        FROM orders JOIN card ON o_custkey = local_id""",
    "line": """
        SELECT l_orderkey AS check_id, l_partkey AS product_id, max(l_suppkey) AS supplier_id,
               max(l_extendedprice / l_quantity) AS price, sum(l_quantity) AS cnt
        FROM lineitem GROUP BY l_orderkey, l_partkey""",
    "price": """
        SELECT l_partkey * 100000 + date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS price_id,
               l_partkey AS product_id, max(l_extendedprice / l_quantity * (1 + l_tax)) AS cost,
               max(l_extendedprice / l_quantity) AS cost_sale, l_shipdate AS set_date
        FROM lineitem GROUP BY l_partkey, l_shipdate""",
    "sale": """
        SELECT product_id, card_id, supplier_id, check_id, payed, payment_form, store_id, check_date,
               price, cnt FROM line JOIN chk USING (check_id)""",
    "date_key": """
        SELECT row_number() OVER (ORDER BY check_date) AS date_id, check_date
        FROM (SELECT DISTINCT o_orderdate AS check_date FROM orders)""",
    "products": f"""
        SELECT price_id, cost, cost_sale, set_date, product_id, product.name, vendor_code,
               product.supplier_id, maker.name AS supplier_name, inn
        FROM price JOIN product USING (product_id) JOIN maker ON product.supplier_id = maker.supplier_id
        WHERE created_at {WINDOW}""",
    "cards": f"""
        SELECT card_id, number, first_name, middle_name, last_name, birth_date, store_id
        FROM card WHERE modified_at {WINDOW}""",
    "lines_of_checks": """
        SELECT check_id, card_id, check_date, payed, payment_form, price, cnt, product_id,
               product.supplier_id AS supplier_id, store_id
        FROM chk JOIN line USING (check_id) JOIN product USING (product_id)""",
    "pairs": """
        SELECT m.product_id, m.supplier_id, s.product_id AS sub_product_id,
               s.supplier_id AS sub_supplier_id, count(m.product_id) AS amount
        FROM sale m JOIN sale s ON m.check_id = s.check_id AND m.store_id = s.store_id
             AND m.product_id > s.product_id
        GROUP BY ALL""",
    "old_card": "SELECT card_id, number, first_name, middle_name, last_name, birth_date FROM card"
                f" WHERE NOT (first_name = 'MACHINERY' AND modified_at {WINDOW})",
    "new_card": f"""
        SELECT card_id, number, first_name, CASE WHEN balance > 5000 THEN middle_name END AS middle_name,
               upper(last_name) AS last_name, birth_date FROM card WHERE modified_at {WINDOW}""",
    "priced": """
        SELECT line.check_id, line.product_id, cnt, chk.check_date, price.cost_sale AS price
        FROM line JOIN chk USING (check_id)
        ASOF LEFT JOIN price ON line.product_id = price.product_id AND chk.check_date >= price.set_date""",
}


def over_views(body: str) -> str:
    """The query with the views it uses, and those that these use, as common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(body)
    views = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    return f"WITH {views}\n{body}" if views else body


def _upsert(old: str, new: str, key: str) -> str:
    return f"""
        SELECT * FROM ({old}) AS o WHERE NOT EXISTS (SELECT 1 FROM ({new}) AS n WHERE {key})
        UNION ALL SELECT * FROM ({new}) AS n"""


def _literal(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'NULL' ELSE '''' || replace(CAST({c} AS VARCHAR), '''', '''''') || '''' END"


def _draw(kind: str, size: str, n: str) -> str:
    a, b = DRAWS[kind]
    u = f"((({n}) % {PRIME}) * {a} + {b}) % {PRIME}"
    return f"((({u}) * ({u})) % {PRIME} % ({size}))"


def _shuffled(x: str) -> str:
    """One pass of the four rounds over a rectangle of width x height places."""
    def mixed(half: str, turn: int, size: str) -> str:
        return _draw(f"round{turn}", size, f"(({half}) * {SPREAD} + check_id)")

    left = f"(({x}) % width + {mixed(f'({x}) // width', 1, 'width')}) % width"
    right = f"(({x}) // width + {mixed(left, 2, 'height')}) % height"
    left2 = f"(({left}) + {mixed(right, 3, 'width')}) % width"
    return f"((({right}) + {mixed(left2, 4, 'height')}) % height) * width + {left2}"


def _code(prefix: str, kind: str, n: str, size: str | None = None) -> str:
    a, b = DRAWS[kind]
    value = _draw(kind, size, n) if size else f"({n} - {n} % {PRIME} + (({n} % {PRIME}) * {a} + {b}) % {PRIME})"
    return f"'{prefix}' || lpad(CAST({value} AS VARCHAR), 18, '0')"


def _days(n: str) -> str:
    return f"CAST({n} AS INTEGER)"


def _cost(n: str) -> str:
    cents = f"({_draw('cost', '100000', n)} + 1)"
    return (f"{cents} / 100 AS cost, "
            f"floor({cents} * ({_draw('share', '71', n)} + 10) / 100) / 100 AS cost_sale")


_CHECKS = "check_id, card_id, check_date, payed, payment_form"
_LINES = f"{_CHECKS}, price, cnt, product_id, supplier_id"
_EUROPE = f"FROM sale JOIN store USING (store_id) WHERE db_name = 'EUROPE' AND check_date {WINDOW}"
_CARD = "card_id, number, first_name, middle_name, last_name, birth_date"
_TARGETS = "(SELECT unnest(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST']) AS target)"
_TWO = "(SELECT unnest(['AMERICA', 'ASIA']) AS target)"
_PARTS = """CAST(year({c}) AS INTEGER) AS year, CAST(month({c}) AS INTEGER) AS month,
    CAST(day({c}) AS INTEGER) AS day, CAST(isodow({c}) AS INTEGER) AS day_of_week,
    CAST(hour({c}) AS INTEGER) AS hour, CAST(minute({c}) AS INTEGER) AS minute,
    CAST(round_even(second({c}) + (microsecond({c}) % 1000000) / 1e6, 0) AS INTEGER) AS second"""
_TOTAL = "(SELECT count(*) FROM {t})"

# Receipts of all stores in the window, with keys for their dates in time order.
_PULLED = f"""
    SELECT *, dense_rank() OVER (ORDER BY check_date) AS date_id FROM lines_of_checks
    WHERE check_date {WINDOW} AND supplier_id IN (SELECT supplier_id FROM maker)"""


def _rules(required: list[str], key: list[str]) -> str:
    """NOT NULL and key rules of the table t."""
    rows = [f"SELECT 'not null' AS rule, '{c}' AS column, (SELECT count(*) - count({c}) FROM t) AS violations" for c in required]
    rows.append(f"SELECT 'unique key', '{', '.join(key)}', (SELECT count(*) FROM (SELECT 1 FROM t GROUP BY {', '.join(key)}"
                " HAVING count(*) > 1) AS twice)")
    return " UNION ALL ".join(rows)


_BODIES = {
    "product_pairs": f"""
        SELECT amount, p1.product_id, p1.name AS product_name, p1.vendor_code, s1.name AS supplier_name,
               p2.product_id AS product_id_2, p2.name AS product_name_2, p2.vendor_code AS vendor_code_2,
               s2.name AS supplier_name_2
        FROM (SELECT m.product_id, m.supplier_id, s.product_id AS sub_product_id,
                     s.supplier_id AS sub_supplier_id, count(m.product_id) AS amount
              FROM sale m JOIN sale s ON m.check_id = s.check_id AND m.store_id = s.store_id
                   AND m.product_id > s.product_id
              WHERE m.check_date {WINDOW} GROUP BY ALL) c
        JOIN product p1 ON p1.product_id = c.product_id JOIN maker s1 ON s1.supplier_id = c.supplier_id
        JOIN product p2 ON p2.product_id = c.sub_product_id
        JOIN maker s2 ON s2.supplier_id = c.sub_supplier_id""",
    "pair_counts": "SELECT * FROM pairs",
    "pair_counts_in_blocks": "SELECT * FROM pairs",
    "incremental_pairs": """
        SELECT * FROM (WITH final AS (SELECT * FROM sale WHERE check_date >= TIMESTAMP '1997-01-01' OR store_id NOT IN (1, 2) OR cnt <= 40)
        SELECT m.product_id, m.supplier_id, s.product_id AS sub_product_id, s.supplier_id AS sub_supplier_id, count(*) AS amount
        FROM final m JOIN final s ON m.check_id = s.check_id AND m.store_id = s.store_id AND m.product_id > s.product_id
        GROUP BY ALL) AS every""",
    "bucketed_pairs": "SELECT * FROM pairs",
    "basket_string": """
        SELECT store_id, check_id, string_agg(CAST(product_id AS VARCHAR), ', ' ORDER BY product_id) AS products
        FROM sale GROUP BY store_id, check_id""",
    "scan_declared": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "extract_products": "SELECT * FROM products",
    "extract_cards": f"SELECT {_CARD} FROM cards",
    "extract_checks": f"SELECT {_LINES} FROM lines_of_checks WHERE check_date {WINDOW}",
    "sql_new_products": "SELECT * FROM products",
    "sql_new_cards": f"SELECT {_CARD} FROM cards",
    "sql_checks": f"SELECT {_LINES} FROM lines_of_checks WHERE check_date {WINDOW}",
    "sql_quoted": f"""
        SELECT card_id, {_literal('number')} AS number, {_literal('middle_name')} AS middle_name,
               {_literal('last_name')} AS last_name, {_literal('birth_date')} AS birth_date FROM card""",
    "sql_lateral_checks": "SELECT card_id, check_id, check_date FROM chk",
    "window_inclusive": f"SELECT check_id, check_date FROM chk WHERE check_date {WINDOW}",
    "distinct_supplier": "SELECT DISTINCT supplier_id, supplier_name AS name, inn FROM products",
    "distinct_product": "SELECT DISTINCT product_id, name, vendor_code, supplier_id FROM products",
    "distinct_price": "SELECT DISTINCT price_id, product_id, cost, cost_sale, set_date FROM products",
    "multi_source_cards": f"SELECT {_CARD}, db_name FROM cards JOIN store USING (store_id)",
    "multi_source_checks": f"""
        SELECT {_LINES}, db_name FROM lines_of_checks JOIN store USING (store_id) WHERE check_date {WINDOW}""",
    "typed_null_union": f"""
        SELECT db_name, CAST(NULL AS BIGINT) AS card_id, NULL AS number, NULL AS first_name, NULL AS middle_name,
               NULL AS last_name, CAST(NULL AS DATE) AS birth_date, 1 AS level FROM store
        UNION ALL SELECT db_name, {_CARD}, 2 FROM card JOIN store USING (store_id)""",
    "load_sale_fact": """
        SELECT product_id, card_id, supplier_id, check_id, payed, payment_form, store_id, date_id, price, cnt
        FROM lines_of_checks JOIN date_key USING (check_date)""",
    "date_surrogate": """
        SELECT row_number() OVER (ORDER BY ts) AS date_id, ts AS moment FROM (SELECT DISTINCT ts FROM events)""",
    "date_dimension_growth": f"""
        SELECT row_number() OVER (ORDER BY date)
                   + (SELECT count(DISTINCT l_shipdate) FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')
                   AS date_id, date, {_PARTS.format(c='date')}
        FROM (SELECT DISTINCT o_orderdate AS date FROM orders) AS d
        WHERE date NOT IN (SELECT l_shipdate FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')""",
    "branch_key_range": """
        SELECT store_id, local_id,
               store_id * 10000000 + row_number() OVER (PARTITION BY store_id ORDER BY local_id) - 1 AS card_id
        FROM card""",
    "date_parts": f"SELECT event_id, ts AS moment, {_PARTS.format(c='ts')} FROM events",
    "upsert_card": _upsert("SELECT * FROM old_card", "SELECT * FROM new_card", "n.card_id = o.card_id"),
    "upsert_supplier": _upsert(
        "SELECT supplier_id, name, inn FROM maker WHERE balance < 5000",
        "SELECT supplier_id, name, '78' || inn AS inn FROM maker WHERE balance > 0",
        "n.supplier_id = o.supplier_id"),
    "upsert_product": _upsert(
        "SELECT product_id, name, vendor_code, supplier_id FROM product WHERE size <= 30",
        "SELECT product_id, name, vendor_code || '-n' AS vendor_code, supplier_id FROM product WHERE size >= 20",
        "n.product_id = o.product_id"),
    "upsert_price": _upsert(
        "SELECT price_id, product_id, cost, cost_sale, set_date FROM price WHERE set_date < TIMESTAMP '1999-01-01'",
        "SELECT price_id, product_id, cost, cost_sale + 1 AS cost_sale, set_date FROM price"
        " WHERE set_date >= TIMESTAMP '1998-01-01'",
        "n.price_id = o.price_id"),
    "upsert_sale_fact": _upsert(
        "SELECT * FROM sale WHERE check_date < TIMESTAMP '1999-01-01'",
        "SELECT * REPLACE (cnt + 1 AS cnt) FROM sale WHERE check_date >= TIMESTAMP '1998-01-01'",
        "n.check_id = o.check_id AND n.product_id = o.product_id AND n.store_id = o.store_id"),
    "upsert_check": _upsert(
        f"SELECT {_CHECKS} FROM chk WHERE check_date < TIMESTAMP '1999-01-01'",
        "SELECT check_id, card_id, check_date, TRUE AS payed, payment_form FROM chk"
        " WHERE check_date >= TIMESTAMP '1998-01-01'",
        "n.check_id = o.check_id"),
    "upsert_line": _upsert(
        "SELECT product_id, check_id, price, cnt FROM line WHERE cnt <= 30",
        "SELECT product_id, check_id, price + 1 AS price, cnt FROM line WHERE cnt >= 20",
        "n.check_id = o.check_id AND n.product_id = o.product_id"),
    "upsert_source_dups": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "audit_stamp": """
        SELECT coalesce(n.card_id, o.card_id) AS card_id,
               CASE WHEN n.card_id IS NULL THEN o.number ELSE n.number END AS number,
               CASE WHEN n.card_id IS NULL THEN o.first_name ELSE n.first_name END AS first_name,
               CASE WHEN n.card_id IS NULL THEN o.middle_name ELSE n.middle_name END AS middle_name,
               CASE WHEN n.card_id IS NULL THEN o.last_name ELSE n.last_name END AS last_name,
               CASE WHEN n.card_id IS NULL THEN o.birth_date ELSE n.birth_date END AS birth_date,
               CASE WHEN o.card_id IS NULL THEN '2002-01-01' ELSE '1995-01-01' END AS created_at,
               CASE WHEN n.card_id IS NULL THEN '1995-01-01' ELSE '2002-01-01' END AS modified_at
        FROM old_card o FULL OUTER JOIN new_card n ON o.card_id = n.card_id""",
    "store_lookup": """
        SELECT store_id, db_name, store_id * 10000000 AS low, (store_id + 1) * 10000000 AS high,
               (SELECT count(*) FROM card WHERE card.store_id = store.store_id) AS cards
        FROM store WHERE db_name = 'EUROPE'""",
    "slice_cards_by_store": f"SELECT {_CARD} FROM card JOIN store USING (store_id) WHERE db_name = 'EUROPE'",
    "slice_check_headers": f"SELECT DISTINCT {_CHECKS} {_EUROPE}",
    "slice_check_lines": f"SELECT product_id, check_id, price, cnt {_EUROPE}",
    "fanout_status": f"SELECT 'card' AS entity, target, (SELECT count(*) FROM cards) AS rows FROM {_TARGETS}",
    "publish_products_status": f"""
        SELECT 'supplier' AS entity, target, (SELECT count(DISTINCT supplier_id) FROM products) AS rows FROM {_TWO}
        UNION SELECT 'product', target, (SELECT count(DISTINCT product_id) FROM products) FROM {_TWO}
        UNION SELECT 'price', target, (SELECT count(DISTINCT price_id) FROM products) FROM {_TWO}""",
    "explode_targets": f"SELECT supplier_id, name, target FROM maker, {_TARGETS}",
    "asof_price": "SELECT * FROM priced",
    "asof_price_window": "SELECT * FROM priced",
    "asof_price_split": "SELECT * FROM priced",
    "latest_price": """
        SELECT product_id, max(set_date) AS set_date, arg_max(cost_sale, set_date) AS cost_sale
        FROM price GROUP BY product_id""",
    "lateral_recent_checks": """
        SELECT card_id, check_id, check_date FROM chk
        QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY check_date DESC, check_id DESC) <= 2""",
    "null_literal": f"""
        SELECT card_id, {_literal('number')} AS number, {_literal('middle_name')} AS middle_name,
               {_literal('last_name')} AS last_name, {_literal('birth_date')} AS birth_date FROM card""",
    "concat_row": f"""
        SELECT card_id, concat_ws(', ', first_name, middle_name, last_name) AS listed,
               '(' || concat_ws(', ', {', '.join(_literal(c) for c in _CARD.split(', '))}) || ')' AS literal
        FROM card""",
    "concat_null": "SELECT card_id, last_name || ' ' || middle_name AS full_name FROM card",
    "apply_defaults": """
        SELECT o_orderkey AS check_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'card' WHEN '2-HIGH' THEN 'cash'
               END AS payment, FALSE AS payed, CAST(0 AS DOUBLE) AS cnt FROM orders""",
    "dq_pk_dups": """
        SELECT l_orderkey, l_partkey, count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_partkey
        HAVING count(*) > 1""",
    "dq_bitmap_keys": """
        SELECT * FROM (WITH t AS (SELECT check_id FROM chk UNION ALL SELECT check_id FROM chk WHERE store_id = 1)
        SELECT count(*) AS rows, count(DISTINCT check_id) AS keys, count(*) - count(DISTINCT check_id) AS surplus FROM t) AS every""",
    "dq_bitmap_rules": """
        SELECT 'unique key' AS rule, count(*) - count(DISTINCT card_id) AS violations FROM card WHERE balance >= 0
        UNION ALL SELECT 'reference', count(DISTINCT card_id) FROM chk WHERE card_id NOT IN (SELECT card_id FROM card WHERE balance >= 0)""",
    "dq_fk_orphans": """
        SELECT check_id, card_id FROM chk WHERE card_id NOT IN (SELECT card_id FROM card WHERE balance >= 0)""",
    "dq_nulls": """
        SELECT 'l_orderkey' AS column, count(*) - count(l_orderkey) AS violations FROM lineitem
        UNION ALL SELECT 'l_returnflag', count(*) - count(nullif(l_returnflag, 'R')) FROM lineitem
        UNION ALL SELECT 'l_linestatus', count(*) - count(nullif(l_linestatus, 'F')) FROM lineitem""",
    "dq_domain": """
        SELECT o_orderkey AS check_id, CAST(left(o_orderpriority, 1) AS INTEGER) AS payment_form FROM orders
        WHERE o_orderstatus <> 'P' AND CAST(left(o_orderpriority, 1) AS INTEGER) NOT IN (1, 2)""",
    "dq_length": """
        SELECT 'p_name' AS column, count(*) FILTER (length(p_name) > 9) AS violations FROM part
        UNION ALL SELECT 'p_brand', count(*) FILTER (length(p_brand) > 7) FROM part
        UNION ALL SELECT 'p_type', count(*) FILTER (length(p_type) > 5) FROM part""",
    "dq_unpriced_lines": "SELECT check_id, product_id, check_date FROM priced WHERE price IS NULL",
    "dq_table_rules": f"""
        SELECT * FROM (WITH one AS (SELECT check_id, CASE WHEN check_id % 5 <> 0 THEN card_id END AS card_id,
                            CASE WHEN check_id % 7 <> 0 THEN check_date END AS check_date, nullif(payed, TRUE) AS payed,
                            payment_form + 1 AS payment_form, store_id FROM chk),
             t AS (SELECT * FROM one UNION ALL SELECT * FROM one WHERE store_id = 1)
        {_rules(['check_id', 'card_id', 'check_date', 'payed'], ['check_id'])}
        UNION ALL SELECT 'domain', 'payment_form', (SELECT count(*) FROM t WHERE payment_form NOT IN (1, 2))
        UNION ALL SELECT 'reference', 'card_id',
            (SELECT count(*) FROM t WHERE card_id NOT IN (SELECT card_id FROM card WHERE balance >= 0))) AS every""",
    "dq_fact_rules": f"""
        SELECT * FROM (WITH one AS (SELECT product_id, card_id, CASE WHEN cnt > 5 THEN supplier_id END AS supplier_id, check_id,
                            nullif(payed, FALSE) AS payed, payment_form * 2 AS payment_form, store_id, check_date AS date_id,
                            CASE WHEN cnt < 40 THEN price END AS price, cnt FROM sale),
             t AS (SELECT * FROM one UNION ALL SELECT * FROM one WHERE cnt > 45)
        {_rules(['product_id', 'card_id', 'supplier_id', 'check_id', 'payed', 'store_id', 'date_id', 'price', 'cnt'],
                ['product_id', 'check_id', 'store_id'])}
        UNION ALL SELECT 'domain', 'payment_form', (SELECT count(*) FROM t WHERE payment_form NOT IN (1, 2))
        UNION ALL SELECT 'reference', 'product_id',
            (SELECT count(*) FROM t WHERE product_id NOT IN (SELECT product_id FROM product))
        UNION ALL SELECT 'reference', 'store_id', (SELECT count(*) FROM t WHERE store_id <= 1)
        UNION ALL SELECT 'reference', 'date_id', (SELECT count(*) FROM t WHERE date_id < TIMESTAMP '1996-01-01')
        UNION ALL SELECT 'reference', 'supplier_id',
            (SELECT count(*) FROM t WHERE supplier_id NOT IN (SELECT supplier_id FROM maker WHERE balance >= 0))
        UNION ALL SELECT 'reference', 'card_id',
            (SELECT count(*) FROM t WHERE card_id NOT IN (SELECT card_id FROM card WHERE balance >= 0))) AS every""",
    "job_pull_checks": f"""
        SELECT product_id, card_id, supplier_id, check_id, payed, payment_form, store_id, date_id, price, cnt
        FROM ({_PULLED}) AS pulled""",
    "job_pull_changes": """
        SELECT product_id, card_id, supplier_id, check_id, payed, payment_form, store_id, check_date, price, cnt
        FROM lines_of_checks WHERE supplier_id IN (SELECT supplier_id FROM maker)""",
    "slice_stored_lines": f"""
        SELECT product_id, check_id, price, cnt FROM ({_PULLED}) AS pulled JOIN store USING (store_id) WHERE db_name = 'EUROPE'""",
    "job_send_checks": f"""
        SELECT s.product_id, s.check_id, p.cost_sale AS price, s.cnt,
               CASE WHEN p.cost_sale IS NULL THEN 'not null: price' ELSE '' END AS broken
        FROM (SELECT * FROM ({_PULLED}) AS pulled JOIN store USING (store_id) WHERE db_name = 'EUROPE') AS s
        ASOF LEFT JOIN (SELECT * FROM price WHERE set_date < TIMESTAMP '1995-01-01') AS p
             ON s.product_id = p.product_id AND s.check_date >= p.set_date""",
    "job_publish_products": """
        SELECT entity, target || holds AS target, rows FROM
            (SELECT 'supplier' AS entity, count(DISTINCT supplier_id) AS rows FROM products
             UNION ALL SELECT 'product', count(DISTINCT product_id) FROM products
             UNION ALL SELECT 'price', count(DISTINCT price_id) FROM products) AS sent,
            (SELECT unnest(['branch', 'warehouse']) AS target) AS targets,
            (SELECT unnest(['', ' holds']) AS holds) AS kinds""",
    "load_rejects": """
        SELECT * FROM (WITH t AS (SELECT *, CASE WHEN cnt > 40 THEN 3 ELSE payment_form END AS form FROM lines_of_checks)
        SELECT * FROM (
            SELECT 'domain: payment_form' AS rule, count(*) AS rows FROM t WHERE form NOT IN (1, 2)
            UNION ALL SELECT 'not null: check_date', count(*) FROM t WHERE cnt <= 2
            UNION ALL SELECT 'reference: card_id', count(*) FROM t
                WHERE card_id NOT IN (SELECT card_id FROM card WHERE balance >= 0)
            UNION ALL SELECT 'reference: supplier_id', count(*) FROM t
                WHERE supplier_id NOT IN (SELECT supplier_id FROM maker WHERE balance >= 0)) AS found
        WHERE rows > 0) AS every""",
    "insert_generated_keys": """
        SELECT 30000000 + row_number() OVER (ORDER BY balance < 0, local_id) - 1 AS card_id, number FROM card""",
    "gen_cards": f"""
        SELECT c_custkey + 10000000 AS card_id, {_code('4', 'number', 'c_custkey')} AS number,
               {_code('first-', 'name', 'c_custkey')} AS first_name,
               {_code('middle-', 'parent', 'c_custkey', '1000')} AS middle_name,
               {_code('last-', 'code', 'c_custkey', '10000')} AS last_name,
               CAST(DATE '1950-01-01' + {_days(_draw('birth', '18993', 'c_custkey'))} AS DATE) AS birth_date
        FROM customer""",
    "gen_checks": f"""
        SELECT o_orderkey AS check_id,
               {_draw('card', _TOTAL.format(t='customer'), 'o_orderkey')} + 10000000 AS card_id,
               TIMESTAMP '2017-01-01' + to_days({_days(_draw('day', '365', 'o_orderkey'))})
                   + to_microseconds({_draw('time', '86400', 'o_orderkey')} * 1000000
                                     + {_draw('first', '1000000', 'o_orderkey')}) AS check_date,
               TRUE AS payed, CAST({_draw('form', '2', 'o_orderkey')} + 1 AS INTEGER) AS payment_form
        FROM orders""",
    "gen_suppliers": f"""
        SELECT s_suppkey AS supplier_id, {_code('company-', 'name', 's_suppkey')} AS name,
               {_code('78', 'code', 's_suppkey')} AS inn FROM supplier""",
    "gen_products": f"""
        SELECT p_partkey AS product_id, {_code('product-', 'name', 'p_partkey', '5000')} AS name,
               {_code('7', 'code', 'p_partkey')} AS vendor_code,
               {_draw('parent', _TOTAL.format(t='supplier'), 'p_partkey')} AS supplier_id FROM part""",
    "gen_price": f"""
        SELECT 'first' AS kind, p_partkey AS revision, p_partkey AS product_id, {_cost('p_partkey')},
               TIMESTAMP '2017-01-01' AS set_date FROM part
        UNION ALL
        SELECT 'later', o_orderkey, {_draw('parent', _TOTAL.format(t='part'), 'o_orderkey')},
               {_cost('o_orderkey')}, TIMESTAMP '2017-01-01' + to_days({_days(_draw('day', '365', 'o_orderkey'))})
        FROM orders""",
    "gen_baskets": f"""
        SELECT * FROM (WITH RECURSIVE sized AS (
            SELECT total, CAST(ceil(sqrt(total)) AS BIGINT) AS width, (total + CAST(ceil(sqrt(total)) AS BIGINT) - 1)
                   // CAST(ceil(sqrt(total)) AS BIGINT) AS height FROM (SELECT count(*) AS total FROM part) AS parts),
        drawn AS (SELECT o_orderkey AS check_id, sized.*, unnest(range(least({_draw('size', '5', 'o_orderkey')} + 1, total))) AS nth
                  FROM orders, sized),
        walk AS (SELECT check_id, nth, total, width, height, {_shuffled('nth')} AS x FROM drawn
                 UNION ALL SELECT check_id, nth, total, width, height, {_shuffled('x')} FROM walk WHERE x >= total)
        SELECT check_id, x AS product_id, CAST(0 AS DOUBLE) AS price,
               CAST({_draw('count', '5', 'check_id * 5 + nth')} + 1 AS DOUBLE) AS cnt FROM walk WHERE x < total) AS every""",
}

ORACLES = {name: over_views(body) for name, body in _BODIES.items()}
