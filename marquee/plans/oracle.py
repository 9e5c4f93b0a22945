"""DuckDB SQL oracles for the star-schema bindings (one per query ID).

Written independently of the Spark code, in plain SQL over the test tables:
windows where Spark uses grouped joins, ``len(string_split(...))`` where Spark
uses a substring test, and so on. Shared conventions with ``plans.star``:
integer-valued outputs cast to the Spark type, money means from DECIMAL sums
(conditions on them by plain ``avg``), lists as one numbered row per value.
"""

from __future__ import annotations

from marquee.sources.star import STAR_TABLES


def _mean(col: str) -> str:
    """From a DECIMAL sum of four places, so that digits below cents would show."""
    return f"CAST(sum(CAST({col} AS DECIMAL(18, 4))) AS DOUBLE) / count({col})"


WORDS = "(SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part{where})"

ORACLE_SQL: dict[str, str] = {
    "A1": f"""
        SELECT p.word, count(*) AS count
        FROM lineitem l JOIN {WORDS.format(where='')} p ON l.l_partkey = p.p_partkey
        WHERE l.l_returnflag = 'R'
        GROUP BY p.word""",
    "A2": """
        SELECT p_partkey, l_orderkey, l_linenumber, p_name, l_returnflag, l_linestatus,
               CAST(year(l_shipdate) AS INTEGER) AS ship_year
        FROM part JOIN lineitem ON p_partkey = l_partkey
        WHERE p_type = 'STANDARD' AND l_returnflag = 'R' AND l_linestatus = 'O'
          AND year(l_shipdate) >= 2000""",
    "A3": f"""
        SELECT c_name, {_mean('o_totalprice')} AS avg_totalprice, count(*) AS order_count
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_totalprice >= 1000
        GROUP BY c_name
        HAVING avg(o_totalprice) >= 300000""",
    "A4": """
        SELECT n_name, max(l_linenumber) AS max_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             JOIN customer ON o_custkey = c_custkey
             JOIN nation ON c_nationkey = n_nationkey
        WHERE l_returnflag = 'R'
        GROUP BY n_name""",
    "A5": """
        SELECT o_orderkey, c_name, CAST(year(o_orderdate) AS INTEGER) AS order_year,
               c_mktsegment, o_totalprice
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderstatus = 'F' AND o_totalprice >= 450000""",
    "A6": """
        SELECT l_orderkey, l_linenumber, p_name, CAST(year(l_shipdate) AS INTEGER) AS ship_year,
               l_discount, l_tax, s_name
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
        WHERE l_returnflag <> 'N' AND l_discount = l_tax""",
    "A7": """
        SELECT p_type, avg(p_size) AS avg_size FROM part WHERE p_size IS NOT NULL GROUP BY p_type""",
    "I1": """
        SELECT c_name, count(o_orderkey) AS order_count
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE (contains(c_mktsegment, 'AUTO') OR contains(c_mktsegment, 'MACH'))
          AND o_orderpriority IN ('1-URGENT', '2-HIGH')
        GROUP BY c_name""",
    "I2": """
        SELECT c_name, o_orderkey, l_linenumber,
               CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days_to_ship, c_mktsegment
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        WHERE date_diff('day', o_orderdate, l_shipdate) >= 0
          AND date_diff('day', o_orderdate, l_shipdate) < 18
          AND (contains(c_mktsegment, 'AUTO') OR contains(c_mktsegment, 'MACH'))""",
    "I3": """
        SELECT p_name, line_count
        FROM (SELECT l_partkey, count(*) AS line_count FROM lineitem
              WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
              GROUP BY l_partkey HAVING count(*) > 15) c
        LEFT JOIN part ON c.l_partkey = p_partkey""",
    "I4": """
        SELECT o_orderkey, CAST(2002 - year(o_orderdate) AS INTEGER) AS years_ago, o_orderpriority
        FROM orders
        WHERE o_orderdate IS NOT NULL AND 2002 - year(o_orderdate) > 6
          AND contains(o_orderpriority, 'URGENT')""",
    "I5": """
        SELECT c_name, o_orderkey, o_totalprice
        FROM (SELECT o_custkey, o_orderkey, o_totalprice,
                     row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
              FROM orders) o
        JOIN customer ON o_custkey = c_custkey
        WHERE rn = 1""",
    "I6": """
        WITH w AS (SELECT p_partkey, p_name, p_size, p_retailprice,
                          avg(p_retailprice) OVER (PARTITION BY p_size) AS m
                   FROM part WHERE contains(p_name, 'widget')),
        r AS (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY p_retailprice DESC, p_partkey) AS rn
              FROM w WHERE p_retailprice > m)
        SELECT p_partkey, p_name, p_size, p_retailprice FROM r WHERE rn <= 3""",
    "I7": f"""
        SELECT o_orderkey, order_year, o_totalprice, m AS avg_year_totalprice
        FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, o_totalprice
              FROM orders WHERE o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL)
        JOIN (SELECT year(o_orderdate) AS y, {_mean('o_totalprice')} AS m FROM orders GROUP BY y) ON y = order_year
        WHERE o_totalprice > m""",
    "M1": """
        SELECT d.doc_id, d.lang, l.quality, l.toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        WHERE d.text IS NOT NULL AND len(string_split(d.text, chr(10))) <= 1""",
    "M1_unlabelled": """
        SELECT lang, count(*) AS doc_count FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY lang""",
    "M2": """
        SELECT p_name AS film_name, s_suppkey AS supplier_id, s_name AS supplier_name
        FROM (SELECT s_suppkey, s_name, l_partkey,
                     row_number() OVER (PARTITION BY s_suppkey ORDER BY l_partkey) AS rn
              FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
              WHERE contains(s_name, '01')) x
        JOIN part ON x.l_partkey = p_partkey
        WHERE rn = 1""",
    "M3": """
        SELECT o_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS order_date,
               CAST(l_shipdate AS DATE) AS ship_date,
               CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days_to_ship,
               row_number() OVER (PARTITION BY date_diff('day', o_orderdate, l_shipdate)
                                  ORDER BY CAST(l_shipdate AS DATE), o_orderkey, l_linenumber) AS ship_rank
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE date_diff('day', o_orderdate, l_shipdate) = 50""",
    "M4": """
        SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) AS position,
               p_name AS part_name
        FROM part WHERE contains(p_brand, 'Brand#1')""",
    "M5": """
        SELECT lang, count(*) AS doc_count FROM documents
        WHERE text IS NOT NULL AND source IS NOT NULL AND lang IS NOT NULL
        GROUP BY lang""",
    "M6": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, o_totalprice,
               row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS "top-20"
        FROM orders WHERE year(o_orderdate) = 2000 AND o_totalprice > 400000""",
    "S1": """
        SELECT c_name, part_count
        FROM (SELECT o_custkey, count(DISTINCT l_partkey) AS part_count
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              WHERE l_returnflag = 'R'
                AND l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'STANDARD')
              GROUP BY o_custkey) x
        LEFT JOIN customer ON o_custkey = c_custkey""",
    "S2": f"""
        SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, p.word, count(*) AS count
        FROM lineitem JOIN {WORDS.format(where=" WHERE p_type = 'STANDARD'")} p ON l_partkey = p.p_partkey
        GROUP BY 1, 2""",
    "S3": """
        SELECT n_name, count(DISTINCT o_custkey) AS customer_count
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_name""",
    "L1_bucketed": f"""
        SELECT o_orderstatus, count(*) AS line_count, {_mean('l_quantity')} AS avg_quantity
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus""",
    "T1_text": f"""
        SELECT o_orderstatus, count(*) AS order_count, {_mean('o_totalprice')} AS avg_totalprice
        FROM orders GROUP BY o_orderstatus""",
    "X1_published": """
        SELECT n_name, count(DISTINCT o_custkey) AS customer_count, count(*) OVER () AS result_rows
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_name""",
    "S4": f"""
        SELECT c_name, {_mean('l_extendedprice')} AS avg_price, {_mean('l_quantity')} AS avg_quantity,
               count(*) AS line_count
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        GROUP BY o_custkey, c_name
        HAVING avg(l_quantity) > 27""",
    "S5": """
        SELECT word, p_partkey, p_name, p_retailprice, p_size
        FROM (SELECT w.*, row_number() OVER (PARTITION BY word ORDER BY p_retailprice DESC, p_partkey) AS rn
              FROM (SELECT p_partkey, p_name, p_retailprice, p_size,
                           unnest(string_split(p_name, ' ')) AS word
                    FROM part WHERE p_size > 10) w)
        WHERE rn <= 5""",
    "S6": """
        WITH words AS (SELECT p_partkey, p_name, p_size, unnest(string_split(p_name, ' ')) AS word
                       FROM part WHERE p_size > 0),
        firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY p_size, p_partkey) AS rn
                                  FROM words) WHERE rn = 1),
        crew AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
        named AS (SELECT f.word, f.p_name, f.p_size, s.s_name, c.l_suppkey
                  FROM firsts f JOIN crew c ON c.l_partkey = f.p_partkey
                  LEFT JOIN supplier s ON s.s_suppkey = c.l_suppkey)
        SELECT word, p_name, p_size,
               row_number() OVER (PARTITION BY word, p_name, p_size
                                  ORDER BY s_name NULLS LAST, l_suppkey) AS position,
               s_name AS supplier_name
        FROM named""",
    "ST1": "\n        UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in STAR_TABLES
    ),
    "ST2": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS count
        FROM orders WHERE year(o_orderdate) >= 1800 GROUP BY 1""",
    "ST3": """
        SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS count
        FROM lineitem WHERE year(l_shipdate) >= 1800 GROUP BY 1""",
    "ST4": "SELECT count(*) AS n FROM part WHERE p_type = 'STANDARD'",
    "ST5": f"""
        SELECT word, count(*) AS count FROM {WORDS.format(where=" WHERE p_type = 'STANDARD'")} GROUP BY word""",
    "ST6": """
        SELECT CASE WHEN l_quantity >= 1 AND l_quantity < 10 THEN '1-10'
                    WHEN l_quantity >= 10 AND l_quantity < 20 THEN '10-20'
                    WHEN l_quantity >= 20 AND l_quantity < 30 THEN '20-30'
                    WHEN l_quantity >= 30 AND l_quantity < 40 THEN '30-40'
                    WHEN l_quantity >= 40 AND l_quantity <= 50 THEN '40-50' END AS quantity_range,
               count(*) AS count
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE p_type = 'STANDARD'
        GROUP BY 1""",
    "P1_region": "SELECT * FROM region ORDER BY r_regionkey LIMIT 5",
    "P1_nation": "SELECT * FROM nation ORDER BY n_nationkey LIMIT 5",
    "P1_customer": "SELECT * FROM customer ORDER BY c_custkey LIMIT 5",
    "P1_supplier": "SELECT * FROM supplier ORDER BY s_suppkey LIMIT 5",
    "P1_part": "SELECT * FROM part ORDER BY p_partkey LIMIT 5",
    "P1_orders": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "P1_lineitem": """
        SELECT * FROM lineitem
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                 l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
        LIMIT 5""",
}
