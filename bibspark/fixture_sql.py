"""Test fixtures derived from the driver tables.

The same SQL text builds a Spark temp view and a DuckDB CTE, so both
engines see identical inputs (see FIXTURES.md).
"""

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["fx_lines"] = """
SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS INT) AS n,
       p_name, p_brand, p_type, p_size, s_name, n_name, l_returnflag, l_linestatus
FROM lineitem
JOIN part ON p_partkey = l_partkey
JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey
"""

FIXTURE_SQL["fx_records"] = """
SELECT o_orderkey AS k, 'ord' || CAST(o_orderkey AS STRING) AS record_id,
  '00000' || substr('acnpd', CAST(o_orderkey % 5 AS INT) + 1, 1)
    || substr('acdefgijkmoprt', CAST(o_orderkey % 14 AS INT) + 1, 1)
    || substr('abcdims', CAST(o_orderkey % 7 AS INT) + 1, 1)
    || CASE WHEN o_orderkey % 11 = 0 THEN 'a' ELSE ' ' END
    || 'a2200000' || substr(' 1234578uz', CAST(o_orderkey % 10 AS INT) + 1, 1)
    || substr(' aciprx', CAST(o_orderkey % 7 AS INT) + 1, 1) || ' 4500' AS leader,
  'ord ' || CAST(o_orderkey AS STRING) AS c001,
  'XX-Test' AS c003,
  CAST(year(o_orderdate) AS STRING) || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
    || lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '120000.0' AS c005,
  substr('acdghkmsv', CAST(o_orderkey % 9 AS INT) + 1, 1)
    || substr('adgjkqrsy', CAST(o_orderkey % 8 AS INT) + 1, 1) || ' '
    || substr('abcghmz', CAST(o_orderkey % 7 AS INT) + 1, 1)
    || substr('abcdefgijlnpvw', CAST(o_orderkey % 13 AS INT) + 1, 1)
    || substr('abcdefghi', CAST(o_orderkey % 6 AS INT) + 1, 4) AS c007,
  substr(CAST(year(o_orderdate) AS STRING), 3, 2) || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
    || lpad(CAST(day(o_orderdate) AS STRING), 2, '0')
    || substr('cdeikmnpqrstu|', CAST(o_orderkey % 14 AS INT) + 1, 1)
    || substr('19uu200119952u10', CAST(o_orderkey % 4 AS INT) * 4 + 1, 4)
    || substr('99992004    uuuu', CAST(o_orderkey % 4 AS INT) * 4 + 1, 4)
    || substr('xx cauenkgw ', CAST(o_orderkey % 4 AS INT) * 3 + 1, 3)
    || substr('abcdefghijklmnopq01 abcdefghijklmnopq', CAST(o_orderkey % 20 AS INT) + 1, 17)
    || substr('engfrespa   |||', CAST(o_orderkey % 5 AS INT) * 3 + 1, 3) || ' d' AS c008
FROM orders
"""

FIXTURE_SQL["fx_subfields"] = """
SELECT record_id, ord, tag, ind1, ind2, sf_ord, code, value FROM (
  -- 100: primary agent, roles by market segment
  SELECT 'ord' || CAST(o_orderkey AS STRING) AS record_id, 6 AS ord, '100' AS tag,
    CASE WHEN o_orderkey % 4 = 0 THEN '3' ELSE '1' END AS ind1, ' ' AS ind2, sf_ord, code,
    CASE code WHEN 'a' THEN c_name || ','
      WHEN 'e' THEN CASE c_mktsegment WHEN 'BUILDING' THEN 'author, editor and illustrator.'
        WHEN 'MACHINERY' THEN 'composer & lyricist' WHEN 'HOUSEHOLD' THEN 'editor,'
        WHEN 'FURNITURE' THEN 'author and' ELSE 'translator' END
      ELSE CASE WHEN o_orderkey % 3 = 0 THEN '(uri)http://example.org/a/' || CAST(c_custkey AS STRING)
        ELSE '(DLC)n' || CAST(c_custkey AS STRING) END END AS value
  FROM orders JOIN customer ON c_custkey = o_custkey
  CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'e' UNION ALL SELECT 3, '0') t
  UNION ALL
  -- 240: uniform title on every third order (drives the anti-join with 245)
  SELECT 'ord' || CAST(l_orderkey AS STRING), 7, '240', '1', '0', sf_ord, code,
    CASE code WHEN 'a' THEN p_name || '.' ELSE 'French.' END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'l') t
  WHERE n = 1 AND l_orderkey % 3 = 0
  UNION ALL
  -- 245: title
  SELECT 'ord' || CAST(l_orderkey AS STRING), 8, '245', '1', CAST(l_orderkey % 4 AS STRING), sf_ord, code,
    CASE code WHEN 'a' THEN p_name || ' :' WHEN 'b' THEN lower(p_type) || ' /' ELSE s_name || '.' END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'b' UNION ALL SELECT 3, 'c') t
  WHERE n = 1
  UNION ALL
  -- 264: publication
  SELECT 'ord' || CAST(l_orderkey AS STRING), 9, '264', CASE WHEN l_orderkey % 5 = 0 THEN '3' ELSE ' ' END,
    CAST(l_orderkey % 5 AS STRING), sf_ord, code,
    CASE code WHEN 'a' THEN '[' || n_name || '] :' WHEN 'b' THEN s_name || ',' ELSE '[1999].' END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'b' UNION ALL SELECT 3, 'c') t
  WHERE n = 1
  UNION ALL
  -- 490: series statements: a second $a on returned lines; '=' (parallel) on flag R
  SELECT 'ord' || CAST(l_orderkey AS STRING), 100 + n, '490', '1', ' ', sf_ord, code,
    CASE code WHEN 'v' THEN CAST(p_size AS STRING) || ' ;'
      ELSE p_brand || CASE WHEN l_returnflag = 'R' AND sf_ord = 1 THEN ' =' ELSE ' ;' END END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'a' UNION ALL SELECT 3, 'v') t
  WHERE (sf_ord <> 2 OR l_returnflag IN ('R', 'A'))
  UNION ALL
  -- 650/651/655: subjects
  SELECT 'ord' || CAST(l_orderkey AS STRING), 200 + n,
    CASE n % 3 WHEN 0 THEN '651' WHEN 1 THEN '650' ELSE '655' END, ' ', CAST(p_size % 8 AS STRING), sf_ord, code,
    CASE code WHEN 'a' THEN p_brand WHEN 'x' THEN lower(p_type) || '.' WHEN 'z' THEN n_name || '.' ELSE 'src' END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'x'
    UNION ALL SELECT 3, 'z' UNION ALL SELECT 4, '2') t
  WHERE (code <> 'z' OR p_size % 2 = 0)
  UNION ALL
  -- 700: added agents, with a title on every other line
  SELECT 'ord' || CAST(l_orderkey AS STRING), 300 + n, '700', '1', CASE WHEN n % 2 = 0 THEN '2' ELSE ' ' END,
    sf_ord, code,
    CASE code WHEN 'a' THEN s_name || ',' WHEN '0' THEN 'http://example.org/s/' || s_name
      WHEN 't' THEN p_name || '.' ELSE '(uri)http://example.org/w/' || p_brand END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, '0'
    UNION ALL SELECT 3, 't' UNION ALL SELECT 4, 'w') t
  WHERE (code IN ('a', '0') OR n % 2 = 0)
  UNION ALL
  -- 830: series added entries
  SELECT 'ord' || CAST(l_orderkey AS STRING), 400 + n, '830', ' ', '0', sf_ord, code,
    CASE code WHEN 'a' THEN p_brand || ' series ;' ELSE CAST(n AS STRING) || '.' END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'v') t
  WHERE l_linestatus = 'F'
  UNION ALL
  -- 533 then 535: next-field pair, broken up by a 500 on some orders
  SELECT 'ord' || CAST(l_orderkey AS STRING), 500 + t.d, t.tag, t.i1, ' ', 1, 'a', t.v || n_name
  FROM fx_lines CROSS JOIN (SELECT 1 AS d, '533' AS tag, ' ' AS i1, 'Microfilm ' AS v
    UNION ALL SELECT 2, '500', ' ', 'Note ' UNION ALL SELECT 3, '535', '2', 'Library ') t
  WHERE n = 1 AND (t.tag <> '500' OR l_orderkey % 2 = 0)
  UNION ALL
  -- 541/561: items, with $5 on some
  SELECT 'ord' || CAST(l_orderkey AS STRING), 540 + n, CASE WHEN n % 2 = 0 THEN '561' ELSE '541' END, ' ', ' ',
    sf_ord, code, CASE code WHEN 'a' THEN 'From ' || s_name ELSE 'INST' END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, '5') t
  WHERE (code = 'a' OR p_size % 3 = 0)
  UNION ALL
  -- 856: access
  SELECT 'ord' || CAST(l_orderkey AS STRING), 900, '856', '4', CAST(l_orderkey % 3 AS STRING), 1, 'u',
    'http://example.org/r/' || CAST(l_orderkey AS STRING)
  FROM fx_lines WHERE n = 1 AND l_orderkey % 2 = 1
  UNION ALL
  -- 880: alternate script of the 245 on some
  SELECT 'ord' || CAST(l_orderkey AS STRING), 950, '880', '1', '0', sf_ord, code,
    CASE code WHEN '6' THEN '245-01/(N' ELSE upper(p_name) || ' /' END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, '6' AS code UNION ALL SELECT 2, 'a') t
  WHERE n = 1 AND l_orderkey % 5 = 0
) u
"""

FIXTURE_SQL["fx_fields"] = """
SELECT record_id, ord, tag, ind1, ind2, CAST(count(*) AS BIGINT) AS n_sf
FROM fx_subfields GROUP BY record_id, ord, tag, ind1, ind2
"""

FIXTURE_SQL["fx_frames"] = """
SELECT k, '00000nam a22' || '00049' || ' a 4500'
    || '001' || lpad(CAST(length(f1) AS STRING), 4, '0') || '00000'
    || '245' || lpad(CAST(length(f2) AS STRING), 4, '0') || lpad(CAST(length(f1) AS STRING), 5, '0')
    || chr(30) || f1 || f2 || chr(29) AS frame
FROM (SELECT p_partkey AS k, 'p' || CAST(p_partkey AS STRING) || chr(30) AS f1,
        '10' || chr(31) || 'a' || p_name || ' :' || chr(31) || 'b' || p_type || ' /' || chr(30) AS f2
      FROM part) s
"""

FIXTURE_SQL["fx_log"] = """
SELECT event_id, ts, 'E' || CAST(event_id AS STRING) || '^S01' || event_type
    || CASE WHEN event_type = 'error' THEN '' WHEN event_type = 'view' THEN '^NQ' || CAST(user_id AS STRING)
       ELSE '^IQ' || CAST(user_id AS STRING) END || '^O' AS line
FROM events
"""

FIXTURE_SQL["fx_triples"] = """
SELECT v, subj, pred, obj, kind FROM (
  SELECT CASE WHEN l_orderkey % 10 = 0 THEN 2 ELSE 1 END AS v, 'http://e/' || CAST(l_orderkey AS STRING) || '#Work' AS subj,
    'rdf:type' AS pred, 'bf:Work' AS obj, 'uri' AS kind FROM fx_lines WHERE n = 1
  UNION ALL SELECT 1, 'http://e/' || CAST(l_orderkey AS STRING) || '#Work', 'bf:hasInstance',
    'http://e/' || CAST(l_orderkey AS STRING) || '#Instance', 'uri' FROM fx_lines WHERE n = 1
  UNION ALL SELECT 1, 'http://e/' || CAST(l_orderkey AS STRING) || '#Instance', 'rdf:type', 'bf:Instance', 'uri'
    FROM fx_lines WHERE n = 1 AND l_orderkey % 4 <> 0
  UNION ALL SELECT CASE WHEN n % 2 = 0 THEN 2 ELSE 1 END, 'http://e/' || CAST(l_orderkey AS STRING) || '#Work',
    'rdfs:label', p_name, 'literal' FROM fx_lines
  UNION ALL SELECT 1, '_:b' || CAST(l_orderkey AS STRING), 'rdf:type', 'bf:Work', 'bnode' FROM fx_lines
    WHERE n = 1 AND l_orderkey % 50 = 0
) g
"""
