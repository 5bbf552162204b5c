"""Fixtures for tags not in FIXTURES.md, same style (plain SQL both engines run)."""

from .fixtures import register_extra

# extra data fields of the order records; ords chosen not to collide with fx_subfields
register_extra("fx_more", """
SELECT record_id, ord, tag, ind1, ind2, sf_ord, code, value FROM (
  -- 033: capture date/place: $a date, $b area code, $c sub-area
  SELECT 'ord' || CAST(l_orderkey AS STRING) AS record_id, 10 AS ord, '033' AS tag, '0' AS ind1, ' ' AS ind2, sf_ord, code,
    CASE code WHEN 'a' THEN '1999' || lpad(CAST(p_size % 12 + 1 AS STRING), 2, '0') ELSE CAST(p_size * 10 + sf_ord AS STRING) END AS value
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'b' UNION ALL SELECT 3, 'c'
    UNION ALL SELECT 4, 'b') t
  WHERE n = 1 AND (sf_ord <> 3 OR l_orderkey % 2 = 0)
  UNION ALL
  -- 041 ind1=1: original language in $h, once or twice
  SELECT 'ord' || CAST(l_orderkey AS STRING), 11, '041', CASE WHEN l_orderkey % 4 = 0 THEN '0' ELSE '1' END, ' ', sf_ord, code,
    CASE code WHEN 'a' THEN 'eng' ELSE substr('frespager', CAST((l_orderkey + sf_ord) % 3 AS INT) * 3 + 1, 3) END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'h' UNION ALL SELECT 3, 'h') t
  WHERE n = 1 AND (sf_ord < 3 OR l_orderkey % 3 = 0)
  UNION ALL
  -- 050: LC call number; a second $a on some; $b with or without a leading '.'
  SELECT 'ord' || CAST(l_orderkey AS STRING), 12, '050', ' ', '0', sf_ord, code,
    CASE WHEN code = 'a' AND sf_ord = 1 THEN CASE WHEN l_orderkey % 7 = 0 THEN 'q' ELSE 'QA' END || CAST(p_size AS STRING)
         WHEN code = 'a' THEN 'QB' || CAST(p_size + 1 AS STRING)
         ELSE CASE WHEN l_orderkey % 2 = 0 THEN '.B' ELSE 'B' END || CAST(p_size * 3 + n AS STRING) END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'b' UNION ALL SELECT 3, 'a') t
  WHERE n = 1 AND (sf_ord < 3 OR l_orderkey % 5 = 0)
  UNION ALL
  -- 051: copy statements
  SELECT 'ord' || CAST(l_orderkey AS STRING), 13 + n, '051', ' ', ' ', sf_ord, code,
    CASE code WHEN 'a' THEN 'QA' || CAST(p_size AS STRING) WHEN 'b' THEN '.C' || CAST(n AS STRING) ELSE 'Copy ' || CAST(n AS STRING) END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'b' UNION ALL SELECT 3, 'c') t
  UNION ALL
  -- 336 content type pairs ($a label, $b code, $0 id, $2 source); a trailing $a on some
  SELECT 'ord' || CAST(l_orderkey AS STRING), 60, '336', ' ', ' ', sf_ord, code,
    CASE sf_ord WHEN 1 THEN 'text' WHEN 2 THEN 'txt' WHEN 3 THEN '(uri)http://id.loc.gov/vocabulary/contentTypes/txt'
      WHEN 4 THEN 'still image' WHEN 5 THEN 'sti' WHEN 6 THEN 'rdacontent' ELSE 'notated music' END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'b' UNION ALL SELECT 3, '0'
    UNION ALL SELECT 4, 'a' UNION ALL SELECT 5, 'b' UNION ALL SELECT 6, '2' UNION ALL SELECT 7, 'a') t
  WHERE n = 1 AND (sf_ord NOT IN (4, 5) OR l_orderkey % 2 = 0) AND (sf_ord <> 7 OR l_orderkey % 3 = 0)
  UNION ALL
  -- 337 media type on even records, 338 carrier on every third
  SELECT 'ord' || CAST(l_orderkey AS STRING), 61, '337', ' ', ' ', sf_ord, code,
    CASE code WHEN 'a' THEN 'unmediated' WHEN 'b' THEN 'n' ELSE 'rdamedia' END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'b' UNION ALL SELECT 3, '2') t
  WHERE n = 1 AND l_orderkey % 2 = 0
  UNION ALL
  SELECT 'ord' || CAST(l_orderkey AS STRING), 62, '338', ' ', ' ', sf_ord, code,
    CASE code WHEN 'a' THEN 'volume' WHEN 'b' THEN 'nc' ELSE 'rdacarrier' END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'b' UNION ALL SELECT 3, '2') t
  WHERE n = 1 AND l_orderkey % 3 = 0
  UNION ALL
  -- 382 medium of performance: medium / count pairs, an $s total, a trailing $n on some
  SELECT 'ord' || CAST(l_orderkey AS STRING), 70 + n, '382', '0', '1', sf_ord, code,
    CASE code WHEN 'a' THEN lower(p_type) WHEN 'd' THEN 'flute' WHEN 's' THEN '3'
      ELSE CAST(sf_ord AS STRING) END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'n' UNION ALL SELECT 3, 'd'
    UNION ALL SELECT 4, 'n' UNION ALL SELECT 5, 's' UNION ALL SELECT 6, 'a' UNION ALL SELECT 7, 'n') t
  WHERE (sf_ord < 6 OR l_orderkey % 2 = 0)
  UNION ALL
  -- 600 name subject with title and two identifiers around it
  SELECT 'ord' || CAST(l_orderkey AS STRING), 150 + n, '600', '1', CAST(n % 3 AS STRING), sf_ord, code,
    CASE code WHEN 'a' THEN s_name || ',' WHEN 't' THEN p_name || '.' WHEN 'x' THEN lower(p_type)
      ELSE CASE WHEN sf_ord = 2 THEN '(uri)http://example.org/p/' || s_name ELSE '(DLC)sh' || CAST(p_size AS STRING) || substr(p_brand, 7) END END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, '0' UNION ALL SELECT 3, 't'
    UNION ALL SELECT 4, '0' UNION ALL SELECT 5, 'x') t
  UNION ALL
  -- 852 holdings: $a organisation (code or long name), $b sub-location, $h $i call number parts, $e $n address
  SELECT 'ord' || CAST(l_orderkey AS STRING), 850 + n, '852', '0', ' ', sf_ord, code,
    CASE code WHEN 'a' THEN CASE WHEN n % 2 = 0 THEN 'DLC' ELSE 'Library of ' || n_name END
      WHEN 'b' THEN 'Stacks ' || CAST(n AS STRING) WHEN 'h' THEN 'QA' || CAST(p_size AS STRING) WHEN 'i' THEN '.B' || CAST(n AS STRING)
      WHEN 'e' THEN CAST(n AS STRING) || ' Main Street' ELSE n_name || '.' END
  FROM fx_lines CROSS JOIN (SELECT 1 AS sf_ord, 'a' AS code UNION ALL SELECT 2, 'b' UNION ALL SELECT 3, 'h'
    UNION ALL SELECT 4, 'i' UNION ALL SELECT 5, 'e' UNION ALL SELECT 6, 'n') t
) u
""")

# both subfield sets together: the full test catalogue
register_extra("fx_all", """
SELECT record_id, ord, tag, ind1, ind2, sf_ord, code, value FROM fx_subfields
UNION ALL SELECT record_id, ord, tag, ind1, ind2, sf_ord, code, value FROM fx_more
""")

# identifiers, 3XX properties, notes and acquisition fields (one row of the list per subfield)
_NOTE_SF = [
    (20, "020", 1, "a"), (20, "020", 2, "q"), (20, "020", 3, "c"), (20, "020", 4, "z"),
    (21, "022", 1, "a"), (21, "022", 2, "y"),
    (22, "024", 1, "a"), (23, "028", 1, "a"), (23, "028", 2, "b"),
    (24, "035", 1, "a"), (25, "017", 1, "a"), (25, "017", 2, "d"),
    (26, "037", 1, "a"), (26, "037", 2, "b"), (26, "037", 3, "c"), (26, "037", 4, "f"),
    (64, "340", 1, "a"), (64, "340", 2, "c"), (64, "340", 3, "3"), (64, "340", 4, "2"),
    (65, "344", 1, "a"), (65, "344", 2, "b"), (66, "347", 1, "a"), (66, "347", 2, "b"), (66, "347", 3, "2"),
    (67, "380", 1, "a"),
    (560, "504", 1, "a"), (560, "504", 2, "b"), (561, "520", 1, "a"), (561, "520", 2, "b"),
    (562, "536", 1, "a"), (562, "536", 2, "b"), (562, "536", 3, "c"),
    (563, "545", 1, "a"), (563, "545", 2, "b"), (564, "555", 1, "a"), (565, "581", 1, "a"), (565, "581", 2, "z"),
    (566, "508", 1, "a"), (567, "511", 1, "a"), (568, "518", 1, "a"), (568, "518", 2, "d"), (568, "518", 3, "3"),
    (569, "522", 1, "a"), (570, "502", 1, "a"), (571, "580", 1, "a"), (572, "588", 1, "a"), (572, "588", 2, "u"),
    (30, "246", 1, "i"), (30, "246", 2, "a"), (30, "246", 3, "b"), (30, "246", 4, "f"), (30, "246", 5, "n"),
    (260, "653", 1, "a"), (260, "653", 2, "a"),
    (770, "773", 1, "a"), (770, "773", 2, "t"), (770, "773", 3, "e"), (771, "780", 1, "a"), (771, "780", 2, "t"),
    (772, "785", 1, "t"), (772, "785", 2, "v"), (773, "787", 1, "i"), (773, "787", 2, "t"),
    (775, "752", 1, "a"), (775, "752", 2, "b"), (775, "752", 3, "d"), (775, "752", 4, "2"),
    (27, "048", 1, "a"), (27, "048", 2, "b"),
    (28, "082", 1, "a"), (28, "082", 2, "b"), (28, "082", 3, "2"),
    (29, "060", 1, "a"), (29, "060", 2, "b"),
    (31, "084", 1, "a"), (31, "084", 2, "a"), (31, "084", 3, "b"), (31, "084", 4, "q"), (31, "084", 5, "2"),
    (32, "086", 1, "a"), (32, "086", 2, "z"), (32, "086", 3, "2"),
]
_NOTE_LIST = "\n    UNION ALL ".join(
    (f"SELECT {o} AS ord, '{t}' AS tag, {s} AS sf_ord, '{c}' AS code" if i == 0 else f"SELECT {o}, '{t}', {s}, '{c}'")
    for i, (o, t, s, c) in enumerate(_NOTE_SF))

register_extra("fx_notes", f"""
SELECT 'ord' || CAST(l_orderkey AS STRING) AS record_id, t.ord, t.tag,
  CASE t.tag WHEN '024' THEN substr('0127', CAST(l_orderkey % 4 AS INT) + 1, 1)
    WHEN '028' THEN CASE WHEN l_orderkey % 2 = 0 THEN '2' ELSE '5' END
    WHEN '545' THEN CAST(l_orderkey % 3 AS STRING) WHEN '555' THEN substr(' 08', CAST(l_orderkey % 3 AS INT) + 1, 1)
    WHEN '511' THEN CAST(l_orderkey % 2 AS STRING) WHEN '082' THEN substr('01 ', CAST(l_orderkey % 3 AS INT) + 1, 1)
    WHEN '086' THEN substr('01 ', CAST(l_orderkey % 3 AS INT) + 1, 1)
    ELSE ' ' END AS ind1,
  CASE t.tag WHEN '246' THEN CAST(l_orderkey % 9 AS STRING) WHEN '653' THEN CAST(l_orderkey % 8 AS STRING)
    WHEN '048' THEN CASE WHEN l_orderkey % 5 = 0 THEN '7' ELSE ' ' END
    WHEN '082' THEN CASE WHEN l_orderkey % 2 = 0 THEN '0' ELSE '4' END
    WHEN '060' THEN CASE WHEN l_orderkey % 3 = 0 THEN '0' ELSE '4' END
    WHEN '780' THEN CAST(l_orderkey % 8 AS STRING) WHEN '785' THEN CAST((l_orderkey + 3) % 9 AS STRING) ELSE ' ' END AS ind2, t.sf_ord, t.code,
  CASE t.tag || t.code
    WHEN '048a' THEN substr('bkswvocetp', CAST(l_orderkey % 10 AS INT) + 1, 1) || substr('abcdnuyz', CAST(p_size % 8 AS INT) + 1, 1)
      || CASE WHEN l_orderkey % 7 = 0 THEN '' ELSE lpad(CAST(p_size % 12 AS STRING), 2, '0') END
    WHEN '048b' THEN CASE WHEN l_orderkey % 3 = 0 THEN 'zz01' ELSE 'va' || CASE WHEN l_orderkey % 4 = 0 THEN 'x' ELSE '02' END END
    WHEN '082a' THEN CAST(p_size * 7 AS STRING) || '.' || CAST(l_orderkey % 100 AS STRING) WHEN '082b' THEN 'B' || CAST(p_size AS STRING)
    WHEN '0822' THEN CAST(20 + l_orderkey % 4 AS STRING)
    WHEN '060a' THEN 'W ' || CAST(p_size AS STRING) WHEN '060b' THEN 'B' || CAST(l_orderkey % 50 AS STRING)
    WHEN '084a' THEN 'KB ' || CAST(p_size + t.sf_ord AS STRING) WHEN '084b' THEN 'X' || CAST(p_size AS STRING)
    WHEN '084q' THEN 'DE-101' WHEN '0842' THEN 'rvk'
    WHEN '086a' THEN 'Y 4.' || CAST(p_size AS STRING) WHEN '086z' THEN 'Y 3.' || CAST(p_size AS STRING) WHEN '0862' THEN 'cacodoc'
    WHEN '773e' THEN 'eng' WHEN '752a' THEN n_name WHEN '752b' THEN 'State ' || CAST(p_size % 7 AS STRING)
    WHEN '752d' THEN 'City ' || s_name WHEN '7522' THEN 'naf' WHEN '787i' THEN 'Related to:'
    WHEN '653a' THEN CASE WHEN t.sf_ord = 1 THEN 'keyword ' || p_brand ELSE lower(p_type) || '.-' END
    WHEN '246i' THEN 'Cover title:' WHEN '246a' THEN upper(p_name) || ' :' WHEN '246b' THEN p_brand || ' /'
    WHEN '020a' THEN '978' || lpad(CAST(l_orderkey AS STRING), 10, '0') WHEN '020q' THEN '(pbk.) :'
    WHEN '020c' THEN '$' || CAST(p_size AS STRING) || '.00 ;' WHEN '020z' THEN '979' || CAST(l_orderkey AS STRING)
    WHEN '022a' THEN lpad(CAST(l_orderkey % 10000 AS STRING), 4, '0') || '-' || lpad(CAST(p_size AS STRING), 4, '0')
    WHEN '035a' THEN '(OCoLC)' || CAST(l_orderkey * 7 AS STRING) WHEN '017d' THEN '1999' || lpad(CAST(p_size % 12 + 1 AS STRING), 2, '0') || '15'
    WHEN '037b' THEN s_name WHEN '037c' THEN 'Free' WHEN '340a' THEN lower(p_type) WHEN '3403' THEN 'v. ' || CAST(n AS STRING) || ':'
    WHEN '3402' THEN 'rdamat' WHEN '3472' THEN 'rdaft' WHEN '380a' THEN p_brand || ' form.'
    WHEN '504b' THEN CAST(p_size AS STRING) WHEN '536b' THEN 'N' || CAST(l_orderkey AS STRING) WHEN '536c' THEN 'G-' || CAST(p_size AS STRING)
    WHEN '581z' THEN '978' || CAST(p_size AS STRING) WHEN '5183' THEN 'Disc ' || CAST(p_size % 3 AS STRING)
    WHEN '511a' THEN s_name || ', ' || n_name WHEN '588u' THEN 'http://example.org/d/' || CAST(l_orderkey AS STRING)
    ELSE t.code || ' ' || p_name || ' ' || CAST(p_size AS STRING) || '.' END AS value
FROM fx_lines CROSS JOIN ({_NOTE_LIST}) t
WHERE n = 1 AND (t.code NOT IN ('z', 'y', '3', 'u', 'i') OR l_orderkey % 3 = 0) AND (t.tag NOT IN ('545', '581', '502') OR l_orderkey % 2 = 0)
  AND (t.tag <> '084' OR t.sf_ord <> 2 OR l_orderkey % 4 = 0) AND (t.tag <> '084' OR t.code <> 'q' OR l_orderkey % 5 <> 0)
""")
