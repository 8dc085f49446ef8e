SELECT 'region' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM region LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM region)
         AND (SELECT count(*) = 0 FROM (VALUES ('r_regionkey'), ('r_name')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM region))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM region)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('r_regionkey'), ('r_name')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM region))) AS missing_columns
UNION ALL
SELECT 'nation' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM nation LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM nation)
         AND (SELECT count(*) = 0 FROM (VALUES ('n_nationkey'), ('n_name'), ('n_regionkey')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM nation))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM nation)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('n_nationkey'), ('n_name'), ('n_regionkey')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM nation))) AS missing_columns
UNION ALL
SELECT 'customer' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM customer LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM customer)
         AND (SELECT count(*) = 0 FROM (VALUES ('c_custkey'), ('c_name'), ('c_nationkey'), ('c_acctbal'), ('c_mktsegment')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM customer))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM customer)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('c_custkey'), ('c_name'), ('c_nationkey'), ('c_acctbal'), ('c_mktsegment')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM customer))) AS missing_columns
UNION ALL
SELECT 'supplier' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM supplier LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM supplier)
         AND (SELECT count(*) = 0 FROM (VALUES ('s_suppkey'), ('s_name'), ('s_nationkey'), ('s_acctbal')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM supplier))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM supplier)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('s_suppkey'), ('s_name'), ('s_nationkey'), ('s_acctbal')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM supplier))) AS missing_columns
UNION ALL
SELECT 'part' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM part LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM part)
         AND (SELECT count(*) = 0 FROM (VALUES ('p_partkey'), ('p_name'), ('p_brand'), ('p_type'), ('p_size'), ('p_retailprice')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM part))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM part)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('p_partkey'), ('p_name'), ('p_brand'), ('p_type'), ('p_size'), ('p_retailprice')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM part))) AS missing_columns
UNION ALL
SELECT 'orders' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM orders LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM orders)
         AND (SELECT count(*) = 0 FROM (VALUES ('o_orderkey'), ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'), ('o_orderpriority')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM orders))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM orders)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('o_orderkey'), ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'), ('o_orderpriority')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM orders))) AS missing_columns
UNION ALL
SELECT 'lineitem' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM lineitem LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM lineitem)
         AND (SELECT count(*) = 0 FROM (VALUES ('l_orderkey'), ('l_partkey'), ('l_suppkey'), ('l_linenumber'), ('l_quantity'), ('l_extendedprice'), ('l_shipdate')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM lineitem))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM lineitem)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('l_orderkey'), ('l_partkey'), ('l_suppkey'), ('l_linenumber'), ('l_quantity'), ('l_extendedprice'), ('l_shipdate')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM lineitem))) AS missing_columns
UNION ALL
SELECT 'events' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM events LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM events)
         AND (SELECT count(*) = 0 FROM (VALUES ('event_id'), ('ts'), ('user_id'), ('event_type'), ('value'), ('props')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM events))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM events)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('event_id'), ('ts'), ('user_id'), ('event_type'), ('value'), ('props')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM events))) AS missing_columns
UNION ALL
SELECT 'documents' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM documents LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM documents)
         AND (SELECT count(*) = 0 FROM (VALUES ('doc_id'), ('text'), ('lang'), ('source'), ('n_chars')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM documents))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM documents)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('doc_id'), ('text'), ('lang'), ('source'), ('n_chars')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM documents))) AS missing_columns
UNION ALL
SELECT 'embeddings' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM embeddings LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM embeddings)
         AND (SELECT count(*) = 0 FROM (VALUES ('vec_id'), ('embedding'), ('label')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM embeddings))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM embeddings)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('vec_id'), ('embedding'), ('label')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM embeddings))) AS missing_columns
UNION ALL
SELECT 'pages' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM pages LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM pages)
         AND (SELECT count(*) = 0 FROM (VALUES ('page_id'), ('url'), ('html')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM pages))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM pages)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('page_id'), ('url'), ('html')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM pages))) AS missing_columns
UNION ALL
SELECT 'benchmark' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM benchmark LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM benchmark)
         AND (SELECT count(*) = 0 FROM (VALUES ('item_id'), ('text')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM benchmark))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM benchmark)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('item_id'), ('text')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM benchmark))) AS missing_columns
UNION ALL
SELECT 'labels' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM labels LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM labels)
         AND (SELECT count(*) = 0 FROM (VALUES ('doc_id'), ('quality'), ('toxic')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM labels))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM labels)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('doc_id'), ('quality'), ('toxic')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM labels))) AS missing_columns
UNION ALL
SELECT 'conversations' AS table_name, true AS present, true AS readable, (SELECT count(*) FROM (SELECT * FROM conversations LIMIT 5)) AS rows_read,
       (SELECT count(*) > 0 FROM conversations)
         AND (SELECT count(*) = 0 FROM (VALUES ('conv_id'), ('turn'), ('role'), ('text')) AS e(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM conversations))) AS passed,
       (SELECT count(*) FROM (DESCRIBE SELECT * FROM conversations)) AS n_columns,
       (SELECT coalesce(string_agg(c, ',' ORDER BY c), '') FROM (VALUES ('conv_id'), ('turn'), ('role'), ('text')) AS e(c)
        WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM conversations))) AS missing_columns
