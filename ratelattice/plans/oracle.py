"""DuckDB twins of the registered queries.

Each text is complete in itself: the tables it names are put in front as
common table expressions over the star-schema views.
"""

from __future__ import annotations

import re

from ratelattice.plans.queries import MOMENTS, SEARCHES

TABLES = {
    "business_category": """
SELECT r_regionkey + 1 AS id, r_name AS description, CASE WHEN r_regionkey = 4 THEN 0 ELSE 1 END AS is_active, r_name AS name FROM region""",
    "business_sub_category": """
SELECT n_nationkey + 1 AS id, n_regionkey + 1 AS business_category_id, CASE WHEN n_nationkey % 10 = 9 THEN 0 ELSE 1 END AS is_active, n_name AS name FROM nation""",
    "product_line": """
SELECT s_suppkey + 1 AS id, s_nationkey + 1 AS business_sub_category_id, s_name AS code,
       CASE WHEN s_suppkey % 7 = 6 THEN 0 ELSE 1 END AS is_active, CAST(abs(s_acctbal) AS DECIMAL(18,4)) AS base_rate,
       CAST(1 + s_suppkey % 4 AS INT) AS color_code_id FROM supplier""",
    "color_code": """
SELECT * FROM (VALUES (1,'#111','Q1','24','grey'),(2,'#0a0','Q2','24','green'),(3,'#00a','Q3','24','blue'),(4,'#a00','Q4','24','red')) t(id,code,fy_quarter,fy_year,name)""",
    "node_src": """
SELECT p_partkey, p_name, p_type, p_size, p_brand, CAST(floor((p_size - 1) / 10) AS INT) AS size_band,
       dense_rank() OVER (ORDER BY p_type) AS g_id,
       dense_rank() OVER (ORDER BY p_type, CAST(floor((p_size - 1) / 10) AS INT)) AS l1_id,
       dense_rank() OVER (ORDER BY p_type, CAST(floor((p_size - 1) / 10) AS INT), p_brand) AS l2_id,
       p_partkey + 1 AS l3_id FROM part""",
    "group_node": """
SELECT DISTINCT g_id AS id, 1 + (g_id - 1) % 5 AS business_category_id, CASE WHEN g_id = 6 THEN 0 ELSE 1 END AS is_active, p_type AS name FROM node_src""",
    "node_l1": """
SELECT DISTINCT l1_id AS id, g_id AS parent_id, CASE WHEN l1_id % 10 = 0 THEN 0 ELSE 1 END AS is_active, 'SIZE-BAND-' || size_band AS name FROM node_src""",
    "node_l2": """
SELECT DISTINCT l2_id AS id, l1_id AS parent_id, CASE WHEN l2_id % 11 = 0 THEN 0 ELSE 1 END AS is_active, p_brand AS name FROM node_src""",
    "node_l3": """
SELECT l3_id AS id, l2_id AS parent_id, CASE WHEN l3_id % 13 = 0 THEN 0 ELSE 1 END AS is_active, p_name || '#' || p_partkey AS name FROM node_src""",
    "all_nodes": """
SELECT 0 AS level, id, business_category_id AS parent_id, name, is_active FROM group_node
UNION ALL SELECT 1, id, parent_id, name, is_active FROM node_l1
UNION ALL SELECT 2, id, parent_id, name, is_active FROM node_l2
UNION ALL SELECT 3, id, parent_id, name, is_active FROM node_l3""",
    "line_nodes": """
SELECT lineitem.*, l2_id, l3_id, l_suppkey + 1 AS product_line_id,
       l2_id * 2 * 200000000 + l_suppkey + 1 AS l2_entry_id, (l3_id * 2 + 1) * 200000000 + l_suppkey + 1 AS l3_entry_id,
       ((l_orderkey * 8 + l_linenumber) * 1048573 + (l_partkey * 1009 + l_suppkey + CAST(l_quantity AS BIGINT) * 20011) % 1048573) * 2 AS line_id
FROM lineitem JOIN node_src ON l_partkey = p_partkey""",
    "change_rows": """
SELECT l3_entry_id AS rate_entry_id, 3 AS level, l3_id AS node_id, product_line_id, l_shipdate AS created_on,
       CAST(abs(l_discount) AS DECIMAL(18,4)) AS rate, line_id + 1 AS id FROM line_nodes
UNION ALL
SELECT l2_entry_id, 2, l2_id, product_line_id, l_shipdate, CAST(abs(l_tax) AS DECIMAL(18,4)), line_id FROM line_nodes""",
    "rate_change_log": """
SELECT id, rate_entry_id, created_on, rate, coalesce(prev, rate) AS old_rate,
       CASE WHEN prev IS NULL THEN 1 ELSE 1 + id % 9 END AS attachment_id, 'user' || (id % 17) AS created_by, 'note ' || id AS note
FROM (SELECT *, lag(rate) OVER (PARTITION BY rate_entry_id ORDER BY created_on, id) AS prev FROM change_rows)""",
    "rate_entry": """
SELECT rate_entry_id AS id, product_line_id, CASE WHEN level = 2 THEN node_id END AS l2_id, CASE WHEN level = 3 THEN node_id END AS l3_id,
       arg_max(rate, (created_on, id)) AS rate, min(created_on) AS created_on
FROM change_rows GROUP BY rate_entry_id, product_line_id, level, node_id""",
    "attachment": """
SELECT CAST(i AS INT) AS id, 'doc_' || i || '_202401010000.pdf' AS path FROM range(1, 9) t(i)""",
    "event_change_log": """
SELECT event_id AS id, user_id AS rate_entry_id, ts AS created_on, CAST(value AS DECIMAL(18,4)) AS rate, event_type AS created_by, props AS note FROM events""",
    "entry_cells": """
SELECT id AS rate_entry_id, 2 AS level, l2_id AS node_id, product_line_id, rate FROM rate_entry WHERE l2_id IS NOT NULL
UNION ALL SELECT id, 3, l3_id, product_line_id, rate FROM rate_entry WHERE l3_id IS NOT NULL""",
    # the active path of every reachable node
    "tree": """
SELECT c.id AS category_id, 0 AS level, g.id, CAST(g.business_category_id AS BIGINT) AS parent_id, g.name, g.id AS g, 0 AS a, 0 AS b, 0 AS d
FROM business_category c JOIN group_node g ON g.business_category_id = c.id AND g.is_active = 1
UNION ALL
SELECT c.id, 1, n1.id, n1.parent_id, n1.name, g.id, n1.id, 0, 0
FROM business_category c JOIN group_node g ON g.business_category_id = c.id AND g.is_active = 1 JOIN node_l1 n1 ON n1.parent_id = g.id AND n1.is_active = 1
UNION ALL
SELECT c.id, 2, n2.id, n2.parent_id, n2.name, g.id, n1.id, n2.id, 0
FROM business_category c JOIN group_node g ON g.business_category_id = c.id AND g.is_active = 1 JOIN node_l1 n1 ON n1.parent_id = g.id AND n1.is_active = 1
JOIN node_l2 n2 ON n2.parent_id = n1.id AND n2.is_active = 1
UNION ALL
SELECT c.id, 3, n3.id, n3.parent_id, n3.name, g.id, n1.id, n2.id, n3.id
FROM business_category c JOIN group_node g ON g.business_category_id = c.id AND g.is_active = 1 JOIN node_l1 n1 ON n1.parent_id = g.id AND n1.is_active = 1
JOIN node_l2 n2 ON n2.parent_id = n1.id AND n2.is_active = 1 JOIN node_l3 n3 ON n3.parent_id = n2.id AND n3.is_active = 1""",
    "tree_keys": """
SELECT category_id, row_number() OVER (PARTITION BY category_id ORDER BY g, a, b, d) AS key, kind, level, id, name
FROM (
  SELECT category_id, 'node' AS kind, level, id, name, g, a, b, d FROM tree
  UNION ALL
  SELECT category_id, 'placeholder', level + 1, id, 'Add a sub group', g, CASE WHEN level = 0 THEN 9000000000000000000 ELSE a END,
         CASE WHEN level = 1 THEN 9000000000000000000 ELSE b END, CASE WHEN level = 2 THEN 9000000000000000000 ELSE d END FROM tree WHERE level < 3
)""",
    "tree_rows": """
SELECT 4 + row_number() OVER (ORDER BY category_id, g, a, b, d) AS row_no, level, id, name FROM tree""",
    "tree_columns": """
SELECT row_number() OVER (ORDER BY c.id, s.id, p.id) AS col_no, p.id, p.code FROM business_category c
JOIN business_sub_category s ON s.business_category_id = c.id AND s.is_active = 1
JOIN product_line p ON p.business_sub_category_id = s.id AND p.is_active = 1""",
    "asof_rate": """
SELECT rate_entry_id, arg_max(rate, (created_on, id)) AS rate, max(created_on) AS created_on
FROM rate_change_log WHERE created_on <= TIMESTAMP '1998-06-30 23:59:00' GROUP BY rate_entry_id""",
    "matrix": """
SELECT r.row_no, k.col_no, e.level, e.node_id, e.product_line_id, coalesce(CAST(a.rate AS VARCHAR), '') AS rate
FROM entry_cells e JOIN tree_rows r ON r.level = e.level AND r.id = e.node_id JOIN tree_columns k ON k.id = e.product_line_id
LEFT JOIN asof_rate a ON a.rate_entry_id = e.rate_entry_id""",
    "tree_cells": """
SELECT e.level, e.node_id, replace(p.code, '"', '') AS code, e.rate, p.business_sub_category_id, e.rate_entry_id, e.product_line_id, 2 AS quarter
FROM entry_cells e JOIN tree t ON t.level = e.level AND t.id = e.node_id JOIN product_line p ON p.id = e.product_line_id""",
    "sub_sizes": """
SELECT c.id AS category_id, s.id AS sub_category_id, s.name, count(p.id) AS n FROM business_category c
JOIN business_sub_category s ON s.business_category_id = c.id AND s.is_active = 1
LEFT JOIN product_line p ON p.business_sub_category_id = s.id AND p.is_active = 1 GROUP BY ALL""",
    "category_sizes": """
SELECT c.id AS category_id, c.name, coalesce(sum(z.n), 0) AS n FROM business_category c LEFT JOIN sub_sizes z ON z.category_id = c.id GROUP BY ALL""",
    "l2_rates": """
SELECT l2_id, product_line_id, rate AS l2_rate FROM rate_entry WHERE l2_id IS NOT NULL""",
    "l3_rates": """
SELECT n.parent_id AS l2_id, e.l3_id, e.product_line_id, e.rate FROM rate_entry e JOIN node_l3 n ON n.id = e.l3_id""",
    "l3_totals": """
SELECT l2_id, product_line_id, CAST(sum(rate) AS DECIMAL(18,4)) AS child_total FROM l3_rates GROUP BY ALL""",
    "add_line": """
SELECT s_suppkey * 2 AS req_id, TIMESTAMP '1992-01-01 00:00:00' AS req_ts, s_name AS code, s_nationkey + 1 AS business_sub_category_id,
       CAST(s_acctbal AS DECIMAL(18,4)) AS base_rate FROM supplier
UNION ALL
SELECT o_orderkey * 2 + 1, o_orderdate, c_name, c_nationkey + 1, CAST(o_totalprice AS DECIMAL(18,4)) FROM orders JOIN customer ON c_custkey = o_custkey""",
    "add_line_checked": """
SELECT *, CASE WHEN code IS NULL OR trim(code) = '' THEN 'CODE_BLANK' WHEN business_sub_category_id IS NULL THEN 'SUB_CATEGORY_MISSING'
              WHEN base_rate IS NULL THEN 'RATE_MISSING' WHEN base_rate < 0 THEN 'RATE_NEGATIVE' END AS error FROM add_line""",
    "add_line_ranked": """
SELECT r.*, p.id AS known_id, p.is_active AS known_active,
       row_number() OVER (PARTITION BY r.code, r.error IS NULL ORDER BY r.req_ts, r.req_id) AS nth
FROM add_line_checked r LEFT JOIN product_line p ON p.code = r.code""",
    "add_line_judged": """
SELECT *, CASE WHEN error IS NOT NULL OR nth > 1 OR known_active = 1 THEN 'REJECT' WHEN known_id IS NULL THEN 'INSERT' ELSE 'REACTIVATE' END AS outcome
FROM add_line_ranked""",
    "add_line_done": """
SELECT req_id, code, outcome, coalesce(error, CASE WHEN outcome = 'REJECT' THEN 'EXISTS' END) AS error,
       CASE outcome WHEN 'REACTIVATE' THEN known_id
            WHEN 'INSERT' THEN (SELECT max(id) FROM product_line) + row_number() OVER (PARTITION BY outcome ORDER BY req_ts, req_id) END AS id,
       CASE WHEN outcome <> 'REJECT' THEN base_rate END AS base_rate, CASE WHEN outcome <> 'REJECT' THEN 1 END AS is_active
FROM add_line_judged""",
    "patch_line": """
SELECT o_orderkey AS req_id, o_orderdate AS req_ts, o_custkey + 1 AS product_line_id,
       CASE WHEN o_orderstatus = 'F' THEN 'PL-' || o_orderkey END AS code,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(CAST(o_totalprice AS DECIMAL(18,4)) - 100000 AS DECIMAL(18,4)) END AS base_rate FROM orders""",
    "patch_line_checked": """
SELECT *, CASE WHEN base_rate < 0 THEN 'RATE_NEGATIVE' WHEN code IS NULL AND base_rate IS NULL THEN 'NOTHING_TO_CHANGE' END AS error FROM patch_line""",
    "node_request": """
SELECT p_partkey * 8 + k AS req_id, TIMESTAMP '2024-05-15 00:00:00' + p_size * INTERVAL 1 DAY AS req_ts,
       CASE WHEN k < 2 THEN 3 WHEN k < 4 THEN 2 WHEN k < 6 THEN 1 ELSE 0 END AS level,
       CASE WHEN k < 2 THEN l2_id WHEN k < 4 THEN l1_id WHEN k < 6 THEN g_id ELSE 1 + (g_id - 1) % 5 END AS parent_id,
       CASE k WHEN 0 THEN p_name || '#' || p_partkey WHEN 1 THEN p_name WHEN 2 THEN p_brand WHEN 3 THEN p_name
              WHEN 4 THEN 'SIZE-BAND-' || size_band WHEN 5 THEN p_brand WHEN 6 THEN p_type ELSE p_brand END AS name
FROM node_src, range(0, 8) t(k)""",
    "node_ranked": """
SELECT r.*, n.id AS known_id, n.is_active AS known_active,
       row_number() OVER (PARTITION BY r.level, r.parent_id, r.name ORDER BY r.req_ts, r.req_id) AS nth
FROM node_request r LEFT JOIN all_nodes n ON n.level = r.level AND n.parent_id = r.parent_id AND n.name = r.name""",
    "node_judged": """
SELECT *, CASE WHEN nth > 1 OR known_active = 1 THEN 'REJECT' WHEN known_id IS NULL THEN 'INSERT' ELSE 'REACTIVATE' END AS outcome FROM node_ranked""",
    "node_done": """
SELECT req_id, level, parent_id, name, outcome,
       CASE outcome WHEN 'REACTIVATE' THEN known_id
            WHEN 'INSERT' THEN m.top + row_number() OVER (PARTITION BY level, outcome ORDER BY req_ts, req_id) END AS id
FROM node_judged JOIN (SELECT level, max(id) AS top FROM all_nodes GROUP BY level) m USING (level)""",
    "delete_request": """
SELECT level, id FROM all_nodes WHERE (level = 0 AND name = 'STANDARD') OR (level = 1 AND name = 'SIZE-BAND-2') OR (level = 2 AND name = 'Brand#7')
UNION ALL SELECT 3, o_orderkey + 1 FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "deleted0": """
SELECT id, false AS cascaded FROM group_node WHERE id IN (SELECT id FROM delete_request WHERE level = 0)""",
    "deleted1": """
SELECT id, id NOT IN (SELECT id FROM delete_request WHERE level = 1) AS cascaded FROM node_l1
WHERE id IN (SELECT id FROM delete_request WHERE level = 1) OR (is_active = 1 AND parent_id IN (SELECT id FROM deleted0))""",
    "deleted2": """
SELECT id, id NOT IN (SELECT id FROM delete_request WHERE level = 2) AS cascaded FROM node_l2
WHERE id IN (SELECT id FROM delete_request WHERE level = 2) OR (is_active = 1 AND parent_id IN (SELECT id FROM deleted1))""",
    "deleted3": """
SELECT id, id NOT IN (SELECT id FROM delete_request WHERE level = 3) AS cascaded FROM node_l3
WHERE id IN (SELECT id FROM delete_request WHERE level = 3) OR (is_active = 1 AND parent_id IN (SELECT id FROM deleted2))""",
    "deleted": """
SELECT 0 AS level, id, cascaded FROM deleted0 UNION ALL SELECT 1, id, cascaded FROM deleted1
UNION ALL SELECT 2, id, cascaded FROM deleted2 UNION ALL SELECT 3, id, cascaded FROM deleted3""",
    "rename_request": """
SELECT p_partkey * 8 + k AS req_id, TIMESTAMP '2024-05-15 00:00:00' + p_size * INTERVAL 1 DAY AS req_ts, 3 - k AS level,
       CASE k WHEN 0 THEN l3_id WHEN 1 THEN l2_id WHEN 2 THEN l1_id ELSE g_id END AS id,
       CASE k WHEN 0 THEN upper(p_name) WHEN 1 THEN p_brand || '/' || p_partkey WHEN 2 THEN p_name || ' ' || size_band ELSE p_type || ' ' || p_brand END AS name
FROM node_src, range(0, 4) t(k)
UNION ALL
SELECT o_orderkey * 8 + 7, TIMESTAMP '2024-05-15 00:00:00', 2, o_orderkey + 1, CASE WHEN o_orderstatus <> 'P' THEN 'ORDER ' || o_orderkey ELSE '  ' END FROM orders""",
    "update_request": """
SELECT line_id + 1 AS req_id, l_shipdate AS req_ts, l3_entry_id AS rate_entry_id, CAST(l_tax AS DECIMAL(18,4)) AS rate,
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN '  ' ELSE l_returnflag || l_linestatus END AS note, l_linenumber AS attachment_id FROM line_nodes
UNION ALL
SELECT line_id, l_shipdate, l2_entry_id, CAST(CAST(l_discount AS DECIMAL(18,4)) + CAST(l_tax AS DECIMAL(18,4)) AS DECIMAL(18,4)),
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN '  ' ELSE l_returnflag || l_linestatus END, l_linenumber FROM line_nodes""",
    "add_request": """
SELECT line_id + 1 AS req_id, l_shipdate AS req_ts, coalesce(s_name, 'UNKNOWN-' || l_suppkey) AS product_line_name,
       CAST(NULL AS BIGINT) AS l2_id, l3_id, CAST(l_tax AS DECIMAL(18,4)) AS rate FROM line_nodes LEFT JOIN supplier ON s_suppkey = l_suppkey + 1
UNION ALL
SELECT line_id, l_shipdate, coalesce(s_name, 'UNKNOWN-' || l_suppkey), l2_id, NULL,
       CAST(CAST(l_discount AS DECIMAL(18,4)) + CAST(l_tax AS DECIMAL(18,4)) AS DECIMAL(18,4)) FROM line_nodes LEFT JOIN supplier ON s_suppkey = l_suppkey + 1""",
    "requested_cells": """
SELECT CASE WHEN l3_id IS NOT NULL THEN 3 ELSE 2 END AS level, coalesce(l3_id, l2_id) AS node_id, p.id AS product_line_id
FROM add_request JOIN product_line p ON p.code = product_line_name""",
    "sheet": """
SELECT o_orderkey AS id, o_orderdate AS created_on, o_orderpriority AS created_by, o_orderstatus AS note,
       CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE o_orderkey + 1 END AS l2_id, CAST(NULL AS BIGINT) AS l3_id,
       o_custkey + 1 AS product_line_id, CAST(o_totalprice AS DECIMAL(18,4)) AS rate FROM orders""",
    # update requests, one step of every family per iteration
    "update_known": """
SELECT u.*, e.rate AS own, coalesce(n.parent_id, e.l2_id) AS l2, e.product_line_id AS line, e.l3_id IS NOT NULL AS child,
       CASE WHEN u.rate IS NULL THEN 'RATE_MISSING' WHEN u.rate < 0 THEN 'RATE_NEGATIVE' WHEN u.note IS NULL OR trim(u.note) = '' THEN 'NOTE_BLANK'
            WHEN e.id IS NULL THEN 'NOT_FOUND' END AS static
FROM update_request u LEFT JOIN rate_entry e ON e.id = u.rate_entry_id LEFT JOIN node_l3 n ON n.id = e.l3_id""",
    "update_seq": """
SELECT *, row_number() OVER (PARTITION BY l2, line ORDER BY req_ts, req_id) AS k FROM update_known WHERE static IS NULL""",
    "update_start": """
SELECT s.l2, s.line, max(r.l2_rate) AS lim, coalesce(max(c.child_total), 0) AS total
FROM (SELECT DISTINCT l2, line FROM update_seq) s LEFT JOIN l2_rates r ON r.l2_id = s.l2 AND r.product_line_id = s.line
LEFT JOIN l3_totals c ON c.l2_id = s.l2 AND c.product_line_id = s.line GROUP BY ALL""",
    "update_walk": """
SELECT l2, line, CAST(0 AS BIGINT) AS k, CAST(lim AS DECIMAL(18,4)) AS lim, CAST(total AS DECIMAL(18,4)) AS total,
       CAST(MAP {} AS MAP(BIGINT, DECIMAL(18,4))) AS rates, CAST(NULL AS BIGINT) AS req_id, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS DECIMAL(18,4)) AS old_rate
FROM update_start
UNION ALL
SELECT l2, line, k, CAST(CASE WHEN reason IS NULL AND NOT child THEN rate ELSE lim END AS DECIMAL(18,4)),
       CAST(CASE WHEN reason IS NULL AND child THEN total - cur + rate ELSE total END AS DECIMAL(18,4)),
       CASE WHEN reason IS NULL THEN map_concat(rates, MAP {rate_entry_id: rate}) ELSE rates END, req_id, reason, cur
FROM (
  SELECT *, CASE WHEN rate = cur THEN 'NO_CHANGE' WHEN child AND lim IS NULL THEN 'PARENT_RATE_MISSING'
                 WHEN child AND total - cur + rate > lim THEN 'CHILD_SUM_EXCEEDED' WHEN NOT child AND total > rate THEN 'BELOW_CHILD_SUM' END AS reason
  FROM (SELECT w.l2, w.line, s.k, w.lim, w.total, w.rates, s.req_id, s.rate_entry_id, s.rate, s.child,
               CAST(coalesce(element_at(w.rates, s.rate_entry_id)[1], s.own) AS DECIMAL(18,4)) AS cur
        FROM update_walk w JOIN update_seq s ON s.l2 = w.l2 AND s.line = w.line AND s.k = w.k + 1)
)""",
    "update_done": """
SELECT u.req_id, u.req_ts, u.rate_entry_id, u.rate, u.note, u.attachment_id, coalesce(u.static, w.reason) AS reason, coalesce(w.old_rate, u.own) AS old_rate, w.lim, w.total
FROM update_known u LEFT JOIN update_walk w ON w.req_id = u.req_id""",
    # add requests likewise
    "add_known": """
SELECT a.*, p.id AS line, coalesce(n.parent_id, a.l2_id) AS l2,
       CASE WHEN a.rate IS NULL THEN 'RATE_MISSING' WHEN a.rate < 0 THEN 'RATE_NEGATIVE' WHEN p.id IS NULL THEN 'LINE_NOT_FOUND' END AS static
FROM add_request a LEFT JOIN product_line p ON p.code = a.product_line_name LEFT JOIN node_l3 n ON n.id = a.l3_id""",
    "add_seq": """
SELECT a.*, e.id IS NOT NULL AS taken, row_number() OVER (PARTITION BY a.l2, a.line ORDER BY a.req_ts, a.req_id) AS k
FROM add_known a LEFT JOIN rate_entry e ON e.l3_id = a.l3_id AND e.product_line_id = a.line WHERE static IS NULL""",
    "add_start": """
SELECT s.l2, s.line, max(r.l2_rate) AS lim, coalesce(max(c.child_total), 0) AS total
FROM (SELECT DISTINCT l2, line FROM add_seq) s LEFT JOIN l2_rates r ON r.l2_id = s.l2 AND r.product_line_id = s.line
LEFT JOIN l3_totals c ON c.l2_id = s.l2 AND c.product_line_id = s.line GROUP BY ALL""",
    "add_walk": """
SELECT l2, line, CAST(0 AS BIGINT) AS k, CAST(lim AS DECIMAL(18,4)) AS lim, CAST(total AS DECIMAL(18,4)) AS total,
       CAST([] AS BIGINT[]) AS cells, CAST(NULL AS BIGINT) AS req_id, CAST(NULL AS VARCHAR) AS reason
FROM add_start
UNION ALL
SELECT l2, line, k, CAST(CASE WHEN reason IS NULL AND l3_id IS NULL THEN rate ELSE lim END AS DECIMAL(18,4)),
       CAST(CASE WHEN reason IS NULL AND l3_id IS NOT NULL THEN total + rate ELSE total END AS DECIMAL(18,4)),
       CASE WHEN reason IS NULL AND l3_id IS NOT NULL THEN list_append(cells, l3_id) ELSE cells END, req_id, reason
FROM (
  SELECT w.l2, w.line, s.k, w.lim, w.total, w.cells, s.req_id, s.l3_id, s.rate,
         CASE WHEN s.l3_id IS NOT NULL AND (s.taken OR list_contains(w.cells, s.l3_id)) THEN 'CELL_EXISTS'
              WHEN s.l3_id IS NOT NULL AND w.lim IS NULL THEN 'PARENT_RATE_MISSING'
              WHEN s.l3_id IS NOT NULL AND w.total + s.rate > w.lim THEN 'CHILD_SUM_EXCEEDED'
              WHEN s.l3_id IS NULL AND w.lim IS NOT NULL THEN 'CELL_EXISTS' END AS reason
  FROM add_walk w JOIN add_seq s ON s.l2 = w.l2 AND s.line = w.line AND s.k = w.k + 1
)""",
    "add_done": """
SELECT a.req_id, a.req_ts, a.rate, coalesce(a.static, w.reason) AS reason, w.lim, w.total FROM add_known a LEFT JOIN add_walk w ON w.req_id = a.req_id""",
    "add_numbered": """
SELECT req_id, req_ts, rate, CASE WHEN reason IS NULL THEN 'INSERT' ELSE 'REJECT' END AS outcome, reason,
       CASE WHEN reason IS NULL THEN (SELECT max(id) FROM rate_entry) + row_number() OVER (PARTITION BY reason IS NULL ORDER BY req_ts, req_id) END AS rate_entry_id
FROM add_done""",
}

_RANGES = {0: "Group", 1: "Sub Group Level 1", 2: "Sub Group Level 2", 3: "Sub Group Level 3"}
_NOUN = "CASE level " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _RANGES.items()) + " END"
_PARENT = "CASE level WHEN 0 THEN 'Business Category' WHEN 1 THEN 'Group' WHEN 2 THEN 'Sub Group Level 1' ELSE 'Sub Group Level 2' END"
_MONTHS = "CASE {q} WHEN 1 THEN 'JAN-MAR' WHEN 2 THEN 'APR-JUN' WHEN 3 THEN 'JUL-SEP' WHEN 4 THEN 'OCT-DEC' ELSE 'JAN-MAR' END"
_QUARTER = "CASE {q} WHEN 1 THEN 'Q1' WHEN 2 THEN 'Q2' WHEN 3 THEN 'Q3' WHEN 4 THEN 'Q4' ELSE 'JAN-MAR' END"
_q = "quarter(o_orderdate)"


def _nested_tree(most: int = 1024) -> str:
    """Children folded into their parents level by level, cut where the tree rows before them pass a multiple of ``most``."""
    label = "CASE WHEN name IS NULL THEN 'null' ELSE to_json(name) END"
    steps, rows = [], []
    for level in (3, 2, 1, 0):
        head = f"""'{{"level":{level},"id":' || t.id || ',"name":' || {label}"""
        if level == 3:
            made = f"SELECT category_id, parent_id, t.id AS place, 1 AS size, {head} || '}}' AS doc FROM tree t WHERE level = 3"
        else:
            made = f"""SELECT t.category_id, t.parent_id, t.id, CASE WHEN n = 1 THEN total + 1 ELSE 1 END,
{head} || CASE WHEN n = 1 THEN ',"children":[' || docs || ']}}' ELSE ',"segments":' || n || '}}' END
FROM tree t JOIN whole{level} w ON w.category_id = t.category_id AND w.parent_id = t.id WHERE level = {level}"""
        if level:
            made += f"""
UNION ALL SELECT category_id, id, 9000000000000000000, 1, '{{"level":{level},"parentId":' || id || ',"name":"Add a sub group"}}' FROM tree WHERE level = {level - 1}"""
        up = level - 1
        steps.append(f"""below{level}(category_id, parent_id, place, size, doc) AS ({made}),
parts{up} AS (SELECT category_id, parent_id, before // {most} AS cut, sum(size) AS size, string_agg(doc, ',' ORDER BY place) AS docs
  FROM (SELECT *, coalesce(sum(size) OVER (PARTITION BY category_id, parent_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM below{level}) GROUP BY ALL),
whole{up} AS (SELECT category_id, parent_id, count(*) AS n, sum(size)::BIGINT AS total, min(docs) FILTER (cut = 0) AS docs FROM parts{up} GROUP BY ALL)""".replace(f"parts-1", "parts_top").replace("whole-1", "whole_top"))
        name = "parts_top" if level == 0 else f"parts{up}"
        some = "" if level == 0 else f" WHERE (category_id, parent_id) IN (SELECT (category_id, parent_id) FROM whole{up} WHERE n > 1)"
        rows.append(f"SELECT category_id, {up} AS level, parent_id AS id, row_number() OVER (PARTITION BY category_id, parent_id ORDER BY cut) - 1 AS segment, '[' || docs || ']' AS children FROM {name}{some}")
    return "SELECT * FROM (WITH " + ",\n".join(steps) + "\n" + "\nUNION ALL ".join(rows) + ")"


QUERIES = {
    "rate_matrix_asof": "SELECT * FROM matrix",
    "rate_matrix_sheet": "SELECT row_no, (col_no - 1) // 8 AS band, "
    + ", ".join(f"max(CASE WHEN (col_no - 1) % 8 = {c - 1} THEN rate END) AS c{c}" for c in range(1, 9))
    + " FROM matrix GROUP BY row_no, band",
    "rate_sheet_labelled": """
SELECT * FROM (WITH cols AS (
  SELECT k.col_no, replace(p.code, '"', '') AS code, p.base_rate, s.id AS sid, replace(s.name, '"', '') AS sname, c.id AS cid, replace(c.name, '"', '') AS cname
  FROM tree_columns k JOIN product_line p ON p.id = k.id JOIN business_sub_category s ON s.id = p.business_sub_category_id JOIN business_category c ON c.id = s.business_category_id),
labels AS (SELECT row_no, replace(name, '"', '') AS label FROM tree_rows UNION ALL VALUES (0, ''), (1, ''), (2, ''), (3, 'Base rates')),
cells AS (
  SELECT 0 AS row_no, min(col_no) AS col_no, any_value(cname) AS rate FROM cols GROUP BY cid UNION ALL SELECT 1, min(col_no), any_value(sname) FROM cols GROUP BY sid
  UNION ALL SELECT 2, col_no, code FROM cols UNION ALL SELECT 3, col_no, coalesce(CAST(base_rate AS VARCHAR), '') FROM cols
  UNION ALL SELECT row_no, col_no, rate FROM matrix UNION ALL SELECT row_no, 1, NULL FROM labels)
SELECT row_no, (col_no - 1) // 8 AS band, label, """
    + ", ".join(f"max(CASE WHEN (col_no - 1) % 8 = {c - 1} THEN rate END) AS c{c}" for c in range(1, 9))
    + " FROM cells JOIN labels USING (row_no) GROUP BY row_no, band, label)",
    "rate_asof": "SELECT * FROM asof_rate",
    "rate_asof_snapshots": "SELECT * FROM asof_rate",
    "rate_asof_multi": f"""
SELECT m.as_of, rate_entry_id, arg_max(rate, (created_on, id)) AS rate
FROM rate_change_log JOIN (SELECT unnest([{", ".join(f"TIMESTAMP '{m}'" for m in MOMENTS)}]) AS as_of) m ON created_on <= m.as_of
GROUP BY m.as_of, rate_entry_id""",
    "rate_asof_events": """
SELECT rate_entry_id, arg_max(rate, (created_on, id)) AS rate, max(created_on) AS created_on
FROM event_change_log WHERE created_on <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY rate_entry_id""",
    "rate_asof_probes": """
SELECT p.req_id AS probe_id, p.rate_entry_id, p.req_ts AS as_of, l.rate
FROM update_request p ASOF LEFT JOIN (SELECT rate_entry_id, created_on, arg_max(rate, id) AS rate FROM rate_change_log GROUP BY ALL) l
ON p.rate_entry_id = l.rate_entry_id AND p.req_ts >= l.created_on""",
    "lineage_errors": """
SELECT * FROM (WITH alone AS (SELECT * FROM rate_entry WHERE (l2_id IS NULL) <> (l3_id IS NULL)),
level2 AS (SELECT id, l2_id AS n FROM alone WHERE l2_id IS NOT NULL UNION ALL SELECT a.id, n.parent_id FROM alone a JOIN node_l3 n ON n.id = a.l3_id),
level1 AS (SELECT l.id, n.parent_id AS n FROM level2 l JOIN node_l2 n ON n.id = l.n),
subs AS (SELECT e.id, p.business_sub_category_id AS n FROM rate_entry e JOIN product_line p ON p.id = e.product_line_id),
cats AS (SELECT s.id, b.business_category_id AS n FROM subs s JOIN business_sub_category b ON b.id = s.n)
SELECT id AS rate_entry_id, missing, missing_id FROM (
SELECT id, 'level_3' AS missing, CAST(l3_id AS BIGINT) AS missing_id FROM alone WHERE l3_id IS NOT NULL AND l3_id NOT IN (SELECT id FROM node_l3)
UNION ALL SELECT id, 'level_2', n FROM level2 WHERE n NOT IN (SELECT id FROM node_l2)
UNION ALL SELECT id, 'level_1', n FROM level1 WHERE n NOT IN (SELECT id FROM node_l1)
UNION ALL SELECT id, 'product_line', product_line_id FROM rate_entry WHERE product_line_id NOT IN (SELECT id FROM product_line)
UNION ALL SELECT id, 'sub_category', n FROM subs WHERE n NOT IN (SELECT id FROM business_sub_category)
UNION ALL SELECT id, 'category', n FROM cats WHERE n NOT IN (SELECT id FROM business_category)))""",
    "rate_changes": "SELECT rate_entry_id, created_on, coalesce(lag(rate) OVER (PARTITION BY rate_entry_id ORDER BY created_on, id), rate) AS old_rate, rate FROM rate_change_log",
    "rate_intervals": "SELECT rate_entry_id, rate, created_on AS valid_from, lead(created_on) OVER (PARTITION BY rate_entry_id ORDER BY created_on, id) AS valid_to FROM rate_change_log",
    "rate_intervals_events": "SELECT rate_entry_id, rate, created_on AS valid_from, lead(created_on) OVER (PARTITION BY rate_entry_id ORDER BY created_on, id) AS valid_to FROM event_change_log",
    "entry_history": """
SELECT rate_entry_id, row_number() OVER (PARTITION BY rate_entry_id ORDER BY created_on DESC, l.id DESC) AS seq,
       strftime(created_on, '%m/%d/%Y %H:%M') AS date, old_rate AS base_rate, note AS notes, a.path AS attachment, created_by AS modified_by
FROM rate_change_log l JOIN attachment a ON a.id = l.attachment_id""",
    "missing_attachments": "SELECT rate_entry_id, id AS log_id, attachment_id FROM rate_change_log WHERE attachment_id NOT IN (SELECT id FROM attachment)",
    "entry_lineage": """
SELECT e.id AS rate_entry_id, c.name AS category, CASE WHEN (e.l2_id IS NULL) <> (e.l3_id IS NULL) THEN n1.name END AS group_name, p.code AS product_line,
       CASE WHEN e.l2_id IS NOT NULL AND e.l3_id IS NULL THEN n2.name WHEN e.l2_id IS NULL AND e.l3_id IS NOT NULL THEN n3.name END AS seller, e.rate
FROM rate_entry e LEFT JOIN node_l3 n3 ON n3.id = e.l3_id LEFT JOIN node_l2 n2 ON n2.id = coalesce(e.l2_id, n3.parent_id)
LEFT JOIN node_l1 n1 ON n1.id = n2.parent_id JOIN product_line p ON p.id = e.product_line_id
JOIN business_sub_category s ON s.id = p.business_sub_category_id JOIN business_category c ON c.id = s.business_category_id""",
    "category_names": "SELECT name FROM business_category",
    "category_options": "SELECT id, name AS label FROM business_category",
    "lookup_missing": """
SELECT c_custkey + 1 AS requested_id, 'Product Line not found for id : ' || (c_custkey + 1) AS error FROM customer
WHERE c_custkey + 1 NOT IN (SELECT id FROM product_line)""",
    "sub_categories_by_category": "SELECT business_category_id, id, name, is_active FROM business_sub_category",
    "active_product_lines": "SELECT business_sub_category_id, id, code, base_rate FROM product_line WHERE is_active = 1",
    "resolve_pl_code": "SELECT r.code, p.id AS product_line_id, p.business_sub_category_id FROM (SELECT DISTINCT code FROM add_line) r LEFT JOIN product_line p ON p.code = r.code",
    "colors_of_quarters": """
SELECT o_orderkey, q.fy_quarter, c.id AS color_id, c.code, c.name
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Q9' ELSE 'Q' || quarter(o_orderdate) END AS fy_quarter FROM orders) q LEFT JOIN color_code c ON c.fy_quarter = q.fy_quarter""",
    "color_by_quarter": "SELECT fy_quarter, id, code, name FROM color_code WHERE id IN (SELECT color_code_id FROM product_line)",
    "node_by_name": "SELECT r.level, r.parent_id, r.name, n.id, n.is_active FROM (SELECT DISTINCT level, parent_id, name FROM node_request) r JOIN all_nodes n ON n.level = r.level AND n.parent_id = r.parent_id AND n.name = r.name",
    "l2_children": "SELECT parent_id AS l2_id, id AS l3_id FROM node_l3",
    "entries_by_node": "SELECT level, node_id, rate_entry_id, product_line_id, rate FROM entry_cells",
    "cell_rate": "SELECT l2_id, product_line_id, rate FROM rate_entry WHERE l2_id IS NOT NULL",
    "product_line_detail": """
SELECT p.id, p.code, p.base_rate, c.code AS color_code, c.name AS color_name, (SELECT min(e.id) FROM rate_entry e WHERE e.product_line_id = p.id) AS rate_entry_id
FROM product_line p LEFT JOIN color_code c ON c.id = p.color_code_id""",
    "duplicate_cells": """
SELECT level, node_id, product_line_id, count(*) AS n
FROM (SELECT level, node_id, product_line_id FROM entry_cells UNION ALL SELECT level, node_id, product_line_id FROM requested_cells)
GROUP BY level, node_id, product_line_id HAVING count(*) > 1""",
    "new_cells_only": """
SELECT r.* FROM requested_cells r WHERE NOT EXISTS
(SELECT 1 FROM entry_cells e WHERE e.level = r.level AND e.node_id = r.node_id AND e.product_line_id = r.product_line_id)""",
    "validate_requests": """
SELECT 'add_line' AS kind, req_id, error FROM add_line_checked
UNION ALL SELECT 'patch_line', req_id, error FROM patch_line_checked
UNION ALL SELECT 'update_rate', req_id, CASE WHEN rate IS NULL THEN 'RATE_MISSING' WHEN rate < 0 THEN 'RATE_NEGATIVE' WHEN trim(note) = '' THEN 'NOTE_BLANK' END FROM update_request
UNION ALL SELECT 'node', doc_id, CASE WHEN text IS NULL OR trim(text) = '' THEN 'NAME_BLANK' END FROM documents""",
    "orphan_entries": "SELECT id AS rate_entry_id, product_line_id FROM sheet WHERE product_line_id NOT IN (SELECT id FROM product_line)",
    "tree_search": "\nUNION ALL\n".join(
        f"""
SELECT category_id, level, id, name, '{s}' AS query FROM tree WHERE level = 0 AND contains(lower(name), lower('{s}'))
UNION ALL
SELECT category_id, 1, id, name, '{s}' FROM (
  SELECT *, min(parent_id) OVER (PARTITION BY category_id) AS first_parent FROM (
    SELECT category_id, parent_id, id, name FROM tree WHERE level = 1
    UNION ALL SELECT category_id, id, NULL, 'Add a sub group' FROM tree WHERE level = 0)
  WHERE contains(lower(name), lower('{s}')) AND category_id NOT IN (SELECT category_id FROM tree WHERE level = 0 AND contains(lower(name), lower('{s}'))))
WHERE parent_id = first_parent"""
        for s in SEARCHES
    ),
    "tree_search_table": """
SELECT * FROM (WITH texts AS (SELECT DISTINCT substr(word, 1, 4) AS query FROM (SELECT unnest(string_split(name, ' ')) AS word FROM group_node UNION ALL SELECT unnest(string_split(name, ' ')) FROM node_l1) WHERE word <> ''),
roots AS (SELECT category_id, 0 AS level, id, name, query FROM tree JOIN texts ON contains(lower(name), lower(query)) WHERE level = 0),
below AS (
  SELECT category_id, parent_id, id, name, query FROM (SELECT category_id, parent_id, id, name FROM tree WHERE level = 1
    UNION ALL SELECT category_id, id, NULL, 'Add a sub group' FROM tree WHERE level = 0) JOIN texts ON contains(lower(name), lower(query))
  WHERE (query, category_id) NOT IN (SELECT (query, category_id) FROM roots))
SELECT * FROM roots UNION ALL SELECT category_id, 1, id, name, query FROM below QUALIFY parent_id = min(parent_id) OVER (PARTITION BY query, category_id))""",
    "category_tree_json": _nested_tree(),
    "row_tree": "SELECT category_id, level, id, parent_id, name FROM tree",
    "row_tree_cells": "SELECT * FROM tree_cells",
    "row_tree_keys": "SELECT * FROM tree_keys",
    "row_tree_pivot": "SELECT level, node_id, number // 8 AS band, "
    + ", ".join(f"arg_max(rate, rate_entry_id) FILTER (number % 8 = {c}) AS r{c}" for c in range(8))
    + """ FROM tree_cells JOIN (SELECT code, dense_rank() OVER (ORDER BY code) - 1 AS number FROM (SELECT DISTINCT replace(code, '"', '') AS code FROM product_line)) USING (code)
GROUP BY level, node_id, band""",
    "group_tree_json": """
SELECT category_id, key, segment, '{"key":' || key || ',"level":' || level || ',"id":' || id || ',"isActive":1,"baserate":"' || name || '","cells":{' || coalesce(cells, '') || '}}' AS doc
FROM (
  SELECT k.category_id, k.key, k.level, k.id, k.name, coalesce(s.segment, 0) AS segment, s.cells
  FROM (SELECT * FROM tree_keys WHERE kind = 'node') k LEFT JOIN (
    SELECT level, node_id, (product_line_id - 1) // 1024 AS segment, string_agg('"' || code || '":{"quarter":' || quarter || ',"value":[' || rate
           || '],"businessSubCategoryId":' || business_sub_category_id || ',"rateEntryId":' || rate_entry_id || ',"productLineId":' || product_line_id || '}', ',' ORDER BY code) AS cells
    FROM (SELECT * FROM tree_cells QUALIFY row_number() OVER (PARTITION BY level, node_id, code ORDER BY rate_entry_id DESC) = 1) GROUP BY ALL) s ON s.level = k.level AND s.node_id = k.id)
UNION ALL
SELECT category_id, key, 0, '{"key":' || key || ',"level":' || level || ',"parentId":' || id || ',"baserate":"' || name || '"}' FROM tree_keys WHERE kind = 'placeholder'""",
    "header_rows": """
SELECT s.business_category_id AS category_id, replace(p.code, '"', '') AS code, s.id AS business_sub_category_id, v.row_title, v.quarter,
       CASE WHEN v.quarter = '' THEN p.base_rate END AS value
FROM product_line p JOIN business_sub_category s ON s.id = p.business_sub_category_id AND s.is_active = 1,
     (VALUES ('BASE RATES FY24', ''), ('Effective APR-JUN 2024 (Q2)', '2'), ('Effective JUL-SEP 2024 (Q3)', '3')) v(row_title, quarter)
WHERE p.is_active = 1
QUALIFY row_number() OVER (PARTITION BY s.business_category_id, replace(p.code, '"', ''), v.quarter ORDER BY p.id DESC) = 1""",
    "header_spans": """
SELECT 'category' AS level, category_id AS id, name, CAST(1 + coalesce(sum(n) OVER (ORDER BY category_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_col,
       CAST(sum(n) OVER (ORDER BY category_id) AS BIGINT) AS last_col FROM category_sizes
UNION ALL
SELECT 'sub_category', sub_category_id, name, CAST(1 + coalesce(sum(n) OVER (ORDER BY category_id, sub_category_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT),
       CAST(sum(n) OVER (ORDER BY category_id, sub_category_id) AS BIGINT) FROM sub_sizes""",
    "matrix_axes": """
SELECT 'row' AS axis, row_no AS position, level, id, replace(name, '"', '') AS label FROM tree_rows
UNION ALL SELECT 'col', col_no, NULL, id, replace(code, '"', '') FROM tree_columns""",
    "pl_counts": """
SELECT category_id, sub_category_id, n FROM sub_sizes UNION ALL SELECT category_id, NULL, CAST(n AS BIGINT) FROM category_sizes""",
    "child_sum_violations": "SELECT l2_id, product_line_id, l2_rate, child_total FROM l2_rates JOIN l3_totals USING (l2_id, product_line_id) WHERE child_total > l2_rate",
    "max_allowed_rate": """
SELECT l3_id, product_line_id, CAST(child_total - rate AS DECIMAL(18,4)) AS existing_total, CAST(l2_rate - (child_total - rate) AS DECIMAL(18,4)) AS max_value_allowed
FROM l3_rates JOIN l3_totals USING (l2_id, product_line_id) JOIN l2_rates USING (l2_id, product_line_id)""",
    "parent_rate_check": """
SELECT e.id AS rate_entry_id, CAST(e.rate + 0.03 AS DECIMAL(18,4)) AS new_rate, coalesce(c.child_total, CAST(0 AS DECIMAL(18,4))) AS child_total,
       coalesce(c.child_total, 0) <= CAST(e.rate + 0.03 AS DECIMAL(18,4)) AS ok
FROM rate_entry e LEFT JOIN l3_totals c ON c.l2_id = e.l2_id AND c.product_line_id = e.product_line_id WHERE e.l2_id IS NOT NULL""",
    "quarter_labels": f"""
SELECT o_orderdate AS ts, CAST({_q} AS INT) AS quarter, {_MONTHS.format(q=_q)} AS month_range, {_QUARTER.format(q=_q)} AS quarter_name,
       'BASE RATES FY' || right(CAST(year(o_orderdate) AS VARCHAR), 2) AS fy_title,
       'Effective ' || {_MONTHS.format(q=f"({_q} + 1)")} || ' ' || year(o_orderdate) || ' (' || {_QUARTER.format(q=f"({_q} + 1)")} || ')' AS effective_title,
       'Effective ' || {_MONTHS.format(q=f"({_q} % 4 + 1)")} || ' ' || (year(o_orderdate) + CASE WHEN {_q} = 4 THEN 1 ELSE 0 END) || ' (' || {_QUARTER.format(q=f"({_q} % 4 + 1)")} || ')' AS wrapped_title
FROM orders""",
    "clean_labels": "SELECT doc_id AS id, replace(text, '\"', '') AS label FROM documents",
    "attachment_names": r"""
SELECT original, CASE WHEN error IS NULL THEN split_part(name, '.', 1) || '_202405151020.' || split_part(name, '.', 2) END AS stored, error
FROM (SELECT original, name, CASE WHEN regexp_matches(name, '^[^.]*\.*$') THEN 'NO_EXTENSION' WHEN contains(name, '..') THEN 'INVALID_PATH' END AS error
      FROM (SELECT original, regexp_replace(replace(original, '\', '/'), '(^|/)(\./)+', '\1', 'g') AS name FROM (SELECT url AS original FROM pages UNION ALL SELECT split_part(url, '/', -1) FROM pages UNION ALL SELECT 'page..' || page_id FROM pages)))""",
    "cookie_user": """
SELECT cookie, CASE WHEN token <> '' THEN json_extract_string(decode(from_base64(rpad(token, CAST(4 * ceil(length(token) / 4.0) AS INT), '='))), '$.id_token.user_name') END AS user_name,
       CASE WHEN token = '' THEN 'User Not Authorized !' END AS error
FROM (SELECT cookie, translate(split_part(cookie, '|', 3), '-_', '+/') AS token FROM (
  SELECT 'sid|' || c_custkey || CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE '|' ||
         rtrim(translate(to_base64(encode('{"id_token":{"user_name":"' || c_name || '"}}')), '+/', '-_'), '=') END AS cookie FROM customer))""",
    "parse_requests": """
SELECT raw, CASE WHEN json_valid(raw) THEN CAST(json_extract_string(raw, '$.rate') AS DECIMAL(18,4)) END AS rate,
       CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.note') END AS note
FROM (SELECT '{"rate": ' || CAST(value AS DECIMAL(18,4)) || CASE WHEN event_type = 'error' THEN ', "no' ELSE ', "note": "' || event_type || '"}' END AS raw FROM events)""",
    "import_rate_entries": "SELECT * FROM sheet",
    "upsert_product_lines": "SELECT * FROM add_line_done",
    "patch_product_lines": """
SELECT r.product_line_id AS id, CASE WHEN p.id IS NOT NULL THEN coalesce(r.code, p.code) END AS code,
       CASE WHEN p.id IS NOT NULL THEN coalesce(r.base_rate, p.base_rate) END AS base_rate,
       CASE WHEN p.id IS NULL THEN 'NOT_FOUND' WHEN r.ok > 0 THEN 'PATCHED' ELSE 'REJECT' END AS outcome
FROM (SELECT product_line_id, arg_max(code, (req_ts, req_id)) FILTER (error IS NULL AND code IS NOT NULL) AS code,
             arg_max(base_rate, (req_ts, req_id)) FILTER (error IS NULL AND base_rate IS NOT NULL) AS base_rate, count(*) FILTER (error IS NULL) AS ok
      FROM patch_line_checked GROUP BY product_line_id) r LEFT JOIN product_line p ON p.id = r.product_line_id""",
    "soft_delete_product_lines": """
SELECT id, code, CASE WHEN id IN (SELECT c_custkey + 1 FROM customer WHERE c_acctbal < 0) THEN 0 ELSE is_active END AS is_active FROM product_line""",
    "upsert_nodes": "SELECT * FROM node_done",
    "cascade_delete": "SELECT level, id, cascaded, 0 AS is_active_after FROM deleted",
    "detached_entries": """
SELECT id AS rate_entry_id, CASE WHEN l2_id NOT IN (SELECT id FROM deleted2) THEN l2_id END AS l2_id, CASE WHEN l3_id NOT IN (SELECT id FROM deleted3) THEN l3_id END AS l3_id
FROM rate_entry WHERE l2_id IN (SELECT id FROM deleted2) OR l3_id IN (SELECT id FROM deleted3)""",
    "rename_nodes": """
SELECT level, id, arg_max(name, (req_ts, req_id)) AS name FROM rename_request r WHERE trim(name) <> '' AND EXISTS
(SELECT 1 FROM all_nodes n WHERE n.level = r.level AND n.id = r.id) GROUP BY level, id""",
    "add_rate_entries": "SELECT req_id, outcome, reason, rate_entry_id FROM add_numbered",
    "import_rate_rejects": """
SELECT CASE WHEN k = 0 THEN array_to_string(cells[1:3], ',') ELSE array_to_string(cells, ',') END AS line,
       CASE k WHEN 0 THEN 'row' WHEN 1 THEN 'c0' WHEN 2 THEN 'c1' WHEN 3 THEN 'c7' ELSE 'c6' END AS cell,
       CASE k WHEN 1 THEN cells[1] WHEN 2 THEN cells[2] WHEN 5 THEN cells[7] END AS value,
       CASE k WHEN 0 THEN 'SHORT_ROW' WHEN 2 THEN 'BAD_DATE' WHEN 3 THEN 'MISSING' ELSE 'BAD_NUMBER' END AS reason
FROM (
  SELECT o_orderkey % 6 AS k, [
    CASE WHEN o_orderkey % 6 = 1 THEN 'x' ELSE '' END || o_orderkey, CASE WHEN o_orderkey % 6 = 2 THEN '2024-13-45' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END,
    o_orderpriority, o_orderstatus, CAST(o_orderkey + 1 AS VARCHAR), '', CASE WHEN o_orderkey % 6 = 5 THEN '1.5' ELSE CAST(o_custkey + 1 AS VARCHAR) END,
    CASE WHEN o_orderkey % 6 = 3 THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR) END, ''] AS cells FROM orders)
WHERE k <> 4""",
    "rate_rejections": """
SELECT 'update' AS kind, req_id, total - old_rate AS existing_total, total - old_rate + rate AS new_total, lim - (total - old_rate) AS max_value_allowed
FROM update_done WHERE reason = 'CHILD_SUM_EXCEEDED'
UNION ALL SELECT 'add', req_id, total, total + rate, lim - total FROM add_done WHERE reason = 'CHILD_SUM_EXCEEDED'""",
    "update_rate_entries": "SELECT req_id, CASE WHEN reason IS NULL THEN 'UPDATE' ELSE 'REJECT' END AS outcome, reason, old_rate, rate FROM update_done",
    "change_log_append": """
SELECT m.top + row_number() OVER (ORDER BY created_on, kind, req_id) AS id, attachment_id, 'system' AS created_by, created_on, rate, old_rate, rate_entry_id, note
FROM (SELECT 0 AS kind, req_id, req_ts AS created_on, rate_entry_id, attachment_id, rate, old_rate, note FROM update_done WHERE reason IS NULL
      UNION ALL SELECT 1, req_id, req_ts, rate_entry_id, 1, rate, rate, NULL FROM add_numbered WHERE outcome = 'INSERT'), (SELECT max(id) AS top FROM rate_change_log) m""",
    "rate_asof_after_updates": """
SELECT rate_entry_id, arg_max(rate, (created_on, later, id)) AS rate
FROM (SELECT rate_entry_id, created_on, 0 AS later, id, rate FROM rate_change_log
      UNION ALL SELECT rate_entry_id, req_ts, 1, req_id, rate FROM update_done WHERE reason IS NULL)
WHERE rate_entry_id IN (SELECT rate_entry_id FROM update_done WHERE reason IS NULL) GROUP BY rate_entry_id""",
    "mutation_outcomes": f"""
SELECT 'patch_line' AS kind, req_id, CASE WHEN e IS NULL THEN 'PATCH' ELSE 'REJECT' END AS outcome, e AS error,
       CASE WHEN e IS NULL THEN 'PL with id : ' || product_line_id || ' has been successfully updated !'
            WHEN e = 'NOT_FOUND' THEN 'Update failed, PL with id : ' || product_line_id || ' doesn''t exist !' ELSE e END AS message
FROM (SELECT *, coalesce(error, CASE WHEN product_line_id NOT IN (SELECT id FROM product_line) THEN 'NOT_FOUND' END) AS e FROM patch_line_checked)
UNION ALL
SELECT 'delete_line', c_custkey, CASE WHEN known THEN 'DELETE' ELSE 'REJECT' END, CASE WHEN NOT known THEN 'NOT_FOUND' END,
       CASE WHEN known THEN 'PL with id : ' || c_custkey + 1 || ' has been successfully deleted !' ELSE 'Deletion failed, PL not found for id : ' || c_custkey + 1 END
FROM (SELECT c_custkey, c_custkey + 1 IN (SELECT id FROM product_line) AS known FROM customer WHERE c_acctbal < 0)
UNION ALL
SELECT 'rename', req_id, CASE WHEN e IS NULL THEN 'RENAME' ELSE 'REJECT' END, e,
       CASE WHEN e IS NULL THEN {_NOUN} || ' with id : ' || id || ' has been successfully updated !'
            WHEN e = 'NOT_FOUND' THEN 'Update failed, ' || {_NOUN} || ' with id : ' || id || ' doesn''t exist !' ELSE e END
FROM (SELECT r.*, CASE WHEN trim(r.name) = '' THEN 'NAME_BLANK' WHEN n.id IS NULL THEN 'NOT_FOUND' END AS e
      FROM rename_request r LEFT JOIN all_nodes n ON n.level = r.level AND n.id = r.id)""",
    "audit_rows": f"""
SELECT '' AS ip, 'system' AS username, TIMESTAMP '2024-05-15 00:00:00' AS create_time, a.* FROM (
SELECT '/product-lines' AS endpoint, 'POST' AS type, CASE WHEN outcome = 'REJECT' THEN 'FAILURE' ELSE 'SUCCESS' END AS status,
       CASE WHEN outcome = 'INSERT' THEN 'PL with code : ' || code || ' and id : ' || id || ' has been successfully created !'
            WHEN outcome = 'REACTIVATE' THEN 'PL with code : ' || code || ' and id : ' || id || ' has been successfully reactivated !'
            WHEN error = 'EXISTS' THEN 'PL with code : ' || code || ' already exists !' ELSE error END AS message FROM add_line_done
UNION ALL
SELECT '/nodes', 'POST', CASE WHEN outcome = 'REJECT' THEN 'FAILURE' ELSE 'SUCCESS' END,
       {_NOUN} || ' with name : ' || name || CASE outcome WHEN 'INSERT' THEN ' and id : ' || id || ' has been successfully created !'
            WHEN 'REACTIVATE' THEN ' and id : ' || id || ' has been successfully reactivated !'
            ELSE ' already exists for ' || {_PARENT} || ' with id : ' || parent_id END FROM node_done
UNION ALL
SELECT '/nodes', 'DELETE', 'SUCCESS', {_NOUN} || ' with id : ' || id || ' has been successfully deleted !' FROM deleted
UNION ALL
SELECT '/nodes', 'DELETE', 'FAILURE', 'Deletion failed, ' || {_NOUN} || ' not found for id : ' || id FROM delete_request r
WHERE NOT EXISTS (SELECT 1 FROM all_nodes n WHERE n.level = r.level AND n.id = r.id)
UNION ALL
SELECT CASE kind WHEN 'rename' THEN '/nodes' ELSE '/product-lines' END, CASE kind WHEN 'delete_line' THEN 'DELETE' ELSE 'PATCH' END,
       CASE WHEN error IS NULL THEN 'SUCCESS' ELSE 'FAILURE' END, message FROM (mutation_outcomes_here)
UNION ALL
SELECT '/rates', 'PUT', CASE WHEN reason IS NULL THEN 'SUCCESS' ELSE 'FAILURE' END,
       CASE WHEN reason IS NULL THEN 'Rate Entry with id : ' || rate_entry_id || ' has been successfully updated !'
            WHEN reason = 'NOT_FOUND' THEN 'Rate Entry with id : ' || rate_entry_id || ' does not exist !' ELSE reason END FROM update_done
UNION ALL
SELECT '/rates', 'POST', CASE WHEN outcome = 'INSERT' THEN 'SUCCESS' ELSE 'FAILURE' END,
       CASE WHEN outcome = 'INSERT' THEN 'Rate Entry with id : ' || rate_entry_id || ' has been successfully created !' ELSE reason END FROM add_numbered) a""",
}
QUERIES["audit_rows"] = QUERIES["audit_rows"].replace("mutation_outcomes_here", QUERIES["mutation_outcomes"])


def _column_tree(icons: bool) -> str:
    lead = "CASE WHEN first THEN 1 ELSE 0 END" + (" + 1" if icons else "")
    icon = f"UNION ALL SELECT category_id, id, name, {lead}, 'Icon', '', NULL FROM subs" if icons else ""
    empty = (
        ""
        if icons
        else "UNION ALL SELECT category_id, id, name, NULL, NULL, NULL, NULL FROM subs s WHERE NOT first AND NOT EXISTS (SELECT 1 FROM product_line p WHERE p.business_sub_category_id = s.id AND p.is_active = 1)"
    )
    subs = "SELECT business_category_id AS category_id, id, name, id = min(id) OVER (PARTITION BY business_category_id) AS first FROM business_sub_category WHERE is_active = 1"
    return f"""
SELECT * FROM (WITH subs AS ({subs})
SELECT category_id, id AS sub_category_id, name AS sub_category, 1 AS position, 'PL' AS title, 'baserate' AS data_index, CAST(NULL AS BIGINT) AS product_line_id FROM subs WHERE first
{icon} {empty}
UNION ALL
SELECT category_id, s.id, s.name, CAST(row_number() OVER (PARTITION BY s.id ORDER BY p.id) + {lead} AS INT), p.code, p.code, p.id
FROM subs s JOIN product_line p ON p.business_sub_category_id = s.id AND p.is_active = 1
UNION ALL
SELECT c.id, NULL, NULL, NULL, NULL, NULL, NULL FROM business_category c WHERE c.id NOT IN (SELECT category_id FROM subs))"""


QUERIES["column_tree"] = _column_tree(True)
QUERIES["column_tree_plain"] = _column_tree(False)
QUERIES["column_tree_json"] = f"""
SELECT category_id, sub_category_id, segment, '{{"title":"' || sub_category || '","businessSubCategoryId":' || sub_category_id || ',"children":[' ||
       string_agg('{{"title":"' || title || '","dataIndex":"' || data_index || '"' || CASE WHEN product_line_id IS NULL THEN '' ELSE ',"id":' || product_line_id END || '}}', ',' ORDER BY position) || ']}}' AS doc
FROM (SELECT *, (position - 1) // 1024 AS segment FROM ({_column_tree(True)}) WHERE sub_category_id IS NOT NULL)
GROUP BY category_id, sub_category_id, sub_category, segment"""
QUERIES["header_rows_json"] = f"""
SELECT category_id, row_title, business_sub_category_id, segment, '{{"baserate":"' || row_title || '","cells":{{' ||
       string_agg('"' || code || '":{{"quarter":"' || quarter || '","value":[' || coalesce(CAST(value AS VARCHAR), '') || '],"businessSubCategoryId":' || business_sub_category_id || '}}', ',' ORDER BY code) || '}}}}' AS doc
FROM (SELECT h.*, (p.id - 1) // 1024 AS segment FROM ({QUERIES["header_rows"]}) h JOIN product_line p ON p.code = h.code)
GROUP BY category_id, row_title, business_sub_category_id, segment"""
QUERIES["entry_detail_json"] = f"""
SELECT e.rate_entry_id, coalesce(h.segment, 0) AS segment,
       '{{"category":"' || e.category || '","group":"' || e.group_name || '","productLine":"' || e.product_line || '","seller":"' || e.seller || '","rate":' || e.rate || ',"changes":[' || coalesce(h.changes, '') || ']}}' AS doc
FROM ({QUERIES["entry_lineage"]}) e LEFT JOIN (
  SELECT rate_entry_id, (seq - 1) // 1024 AS segment, string_agg('{{"date":"' || date || '","baseRate":' || base_rate || ',"notes":"' || notes || '","attachment":"' || attachment
         || '","modifiedBy":"' || modified_by || '"}}', ',' ORDER BY seq) AS changes
  FROM ({QUERIES["entry_history"]}) GROUP BY rate_entry_id, segment) h ON h.rate_entry_id = e.rate_entry_id"""


def _needed(text: str) -> list[str]:
    """Names of the tables a text reads, directly or through others, in definition order."""
    found: set[str] = set()
    pending = [text]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        new = (words & TABLES.keys()) - found
        found |= new
        pending.extend(TABLES[name] for name in new)
    return [name for name in TABLES if name in found]


# every table that ``GapTables`` thins out, where it stands for itself and is no label
_GAPS = r"(?<!')\b(node_l1|node_l2|node_l3|product_line|business_sub_category|business_category)\b(?!')"
QUERIES["lineage_errors_with_gaps"] = re.sub(_GAPS, r"(SELECT * FROM \1 WHERE id % 5 <> 0)", QUERIES["lineage_errors"])


def oracle_sql() -> dict[str, str]:
    result = {}
    for name, text in QUERIES.items():
        used = _needed(text)
        head = ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n]})" if not n.endswith("_walk") else f"{n} AS ({TABLES[n]})" for n in used)
        recursive = "RECURSIVE " if any(n.endswith("_walk") for n in used) else ""
        result[name] = f"WITH {recursive}{head}\n{text}" if used else text
    return result
