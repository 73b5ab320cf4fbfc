"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans: plain SQL over the driver's tables
(pre-registered views), following the feed definitions of FIXTURES.md.
"""

from __future__ import annotations


def cve(x: str) -> str:
    return f"printf('CVE-2024-%06d', cast({x} AS BIGINT))"


def dtext(x: str) -> str:
    """Decimal as short text (trailing zeros dropped, '.0' kept)."""
    s = f"cast({x} AS VARCHAR)"
    t = f"regexp_replace({s}, '0+$', '')"
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN {s} NOT LIKE '%.%' THEN {s} "
            f"WHEN {t} LIKE '%.' THEN {t} || '0' ELSE {t} END)")


def cwe(n: str) -> str:
    return f"('CWE-' || cast(100 + {n} AS VARCHAR))"


FEEDS = f"""
nvd AS (
  SELECT {cve('p_partkey')} AS cve_id, p_partkey, p_size,
    CASE WHEN p_partkey % 11 = 0 THEN NULL
         ELSE cast((p_retailprice - 900) / 10 AS DECIMAL(4,1)) END AS base_score,
    CASE WHEN p_size % 9 = 0 THEN 'Awaiting Analysis' ELSE 'Analyzed' END AS vuln_status,
    TIMESTAMP '2024-01-01 00:00:00' + to_days(cast(p_partkey % 365 AS INTEGER))
      + to_hours(cast(p_partkey % 24 AS INTEGER)) AS last_modified,
    CASE WHEN p_size % 5 = 0 THEN []::VARCHAR[]
         WHEN p_size % 3 = 0 THEN [{cwe('p_size')}, 'NVD-CWE-Other']
         ELSE [{cwe('p_size')}] END AS weaknesses,
    CASE WHEN p_size % 4 = 0
         THEN ['https://vendor.example/' || lower(replace(p_brand, '#', '')) || '/' || cast(p_partkey AS VARCHAR),
               'https://advisory.example/' || lower(p_type)]
         ELSE ['https://vendor.example/' || lower(replace(p_brand, '#', '')) || '/' || cast(p_partkey AS VARCHAR)]
    END AS refs
  FROM part),
kev AS (
  SELECT {cve('p_partkey')} AS cve_id, p_partkey, p_brand AS vendor_project, p_name AS product,
    CASE WHEN p_partkey % 17 = 0 THEN NULL
         ELSE strftime(DATE '2021-11-03' + cast(p_partkey % 900 AS INTEGER), '%Y-%m-%d') END AS date_added,
    CASE WHEN p_size % 2 = 0 THEN 'Apply mitigations per vendor instructions.'
         ELSE 'Remove ' || {cwe('p_size')} || ' exposure.' END AS required_action,
    CASE WHEN p_partkey % 3 = 0 THEN 'Known' ELSE 'Unknown' END AS known_ransomware_campaign_use,
    CASE WHEN p_partkey % 4 = 0 THEN []::VARCHAR[] ELSE [{cwe('p_size')}] END AS cwes
  FROM part WHERE p_size % 7 <> 0),
epss AS (
  SELECT cve, epss, percentile, date FROM (
    SELECT {cve('l_partkey')} AS cve,
      cast(l_discount * 9.87 AS DECIMAL(7,5)) AS epss,
      cast(l_tax * 12.3 AS DECIMAL(7,5)) AS percentile,
      strftime(l_shipdate, '%Y-%m-%d') AS date,
      row_number() OVER (PARTITION BY l_partkey
                         ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC,
                                  l_discount DESC, l_tax DESC) AS rn
    FROM lineitem WHERE l_partkey % 13 <> 0) WHERE rn = 1),
exploit AS (
  SELECT cast(o_orderkey AS VARCHAR) AS id, o_orderkey, o_custkey,
    strftime(o_orderdate, '%Y-%m-%d') AS date_published,
    CASE WHEN o_custkey % 4 = 0 THEN strftime(cast(o_orderdate AS DATE) + 45, '%Y-%m-%d') END AS date_updated,
    CASE WHEN o_custkey % 3 = 0 THEN 'remote' WHEN o_custkey % 3 = 1 THEN 'local' ELSE 'webapps' END AS type,
    CASE WHEN o_custkey % 2 = 0 THEN 'linux' ELSE 'windows' END AS platform,
    CASE WHEN o_custkey % 5 = 0 THEN '80' WHEN o_custkey % 5 = 1 THEN ''
         WHEN o_custkey % 5 = 2 THEN '8080.5' END AS port,
    'https://exploits.example/exploits/' || cast(o_orderkey AS VARCHAR) AS source_url,
    list_sort(list(DISTINCT {cve('l_partkey')})) AS codes
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE o_orderpriority <> '5-LOW'
  GROUP BY o_orderkey, o_custkey, o_orderdate),
exploit_codes AS (SELECT * EXCLUDE (codes), unnest(codes) AS code FROM exploit),
xdb AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY code ORDER BY date_published DESC NULLS LAST,
                                 cast(id AS BIGINT) DESC NULLS LAST, id DESC) AS rn
    FROM exploit_codes) WHERE rn = 1),
mrows AS (
  SELECT * FROM lineitem WHERE l_suppkey % 5 <> 0),
modules AS (
  SELECT 'exploit/s' || cast(l_suppkey AS VARCHAR) AS fullname,
    'module_s' || cast(l_suppkey AS VARCHAR) AS name, 'exploit' AS type,
    CASE WHEN l_suppkey % 3 = 0 THEN 'linux' WHEN l_suppkey % 3 = 1 THEN 'windows' ELSE 'multi' END AS platform,
    strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') || ' +0000' AS mod_time
  FROM mrows GROUP BY l_suppkey),
mrefs AS (
  SELECT 'exploit/s' || cast(l_suppkey AS VARCHAR) AS fullname, {cve('l_partkey')} AS ref FROM mrows
  UNION
  SELECT 'exploit/s' || cast(l_suppkey AS VARCHAR), 'URL-https://ref.example/s' || cast(l_suppkey AS VARCHAR) FROM mrows
  UNION
  SELECT 'exploit/s' || cast(l_suppkey AS VARCHAR), lower({cve('l_suppkey')}) FROM mrows),
msf AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT r.ref, m.*, row_number() OVER (PARTITION BY r.ref ORDER BY m.mod_time DESC NULLS LAST,
                                          m.fullname DESC) AS rn
    FROM mrefs r JOIN modules m USING (fullname) WHERE starts_with(r.ref, 'CVE-')) WHERE rn = 1),
joined AS (
  SELECT n.cve_id, n.base_score, n.weaknesses, n.refs,
    k.cve_id IS NOT NULL AS has_kev, k.required_action, k.known_ransomware_campaign_use, k.product,
    k.vendor_project, k.cwes,
    e.cve IS NOT NULL AS has_epss, e.epss, e.percentile,
    x.code IS NOT NULL AS has_xdb, x.source_url AS x_source_url, x.type AS x_type, x.platform AS x_platform,
    m.ref IS NOT NULL AS has_msf, m.name AS m_name, m.type AS m_type, m.platform AS m_platform
  FROM nvd n
  LEFT JOIN kev k ON k.cve_id = n.cve_id
  LEFT JOIN epss e ON e.cve = n.cve_id
  LEFT JOIN xdb x ON x.code = n.cve_id
  LEFT JOIN msf m ON m.ref = n.cve_id),
addends AS (
  SELECT cve_id,
    cast(CASE WHEN has_kev THEN 30.0 ELSE 0 END AS DECIMAL(12,5)) AS a_kev,
    cast(coalesce(epss, 0) * 10.0 AS DECIMAL(12,5)) AS a_epss,
    cast(CASE WHEN has_xdb THEN 10.0 ELSE 0 END AS DECIMAL(12,5)) AS a_xdb,
    cast(CASE WHEN has_msf THEN 10.0 ELSE 0 END AS DECIMAL(12,5)) AS a_msf,
    cast(coalesce(base_score, 0) * 0.5 AS DECIMAL(12,5)) AS a_cvss
  FROM joined),
fact AS (
  SELECT j.*, cast(round(cast(a.a_kev + a.a_epss + a.a_xdb + a.a_msf + a.a_cvss AS DECIMAL(12,5)), 2)
                   AS DOUBLE) AS vrr_score
  FROM joined j JOIN addends a USING (cve_id)),
threats AS (
  SELECT cve_id, vrr_score,
    nullif(required_action, '') AS CISA_required_action,
    nullif(known_ransomware_campaign_use, '') AS CISA_known_ransomware_campaign_use,
    nullif(product, '') AS CISA_product,
    nullif(vendor_project, '') AS CISA_vendor_project,
    CASE WHEN len(cwes) > 0 THEN cwes END AS CISA_cwe,
    CASE WHEN epss <> 0 THEN epss END AS EPSS_epss_value,
    CASE WHEN percentile <> 0 THEN percentile END AS EPSS_percentile,
    nullif(x_source_url, '') AS ExploitDB_exploit_id,
    nullif(x_type, '') AS ExploitDB_type,
    nullif(x_platform, '') AS ExploitDB_platform,
    CASE WHEN len(weaknesses) > 0 THEN weaknesses END AS NVD_weaknesses,
    CASE WHEN len(list_filter(refs, lambda u: u IS NOT NULL AND u <> '')) > 0
         THEN list_filter(refs, lambda u: u IS NOT NULL AND u <> '') END AS NVD_references,
    nullif(m_name, '') AS Metasploit_module_name,
    nullif(m_type, '') AS Metasploit_type,
    nullif(m_platform, '') AS Metasploit_platform
  FROM fact)
"""


def with_feeds(body: str) -> str:
    return "WITH " + FEEDS.strip() + "\n" + body


ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["vrr_score_per_cve"] = with_feeds("SELECT cve_id, vrr_score FROM fact")

ORACLE_SQL["threat_attributes_per_cve"] = with_feeds(f"""
SELECT cve_id, CISA_required_action, CISA_known_ransomware_campaign_use, CISA_product,
  CISA_vendor_project, array_to_string(CISA_cwe, '|') AS CISA_cwe,
  {dtext('EPSS_epss_value')} AS EPSS_epss_value, {dtext('EPSS_percentile')} AS EPSS_percentile,
  ExploitDB_exploit_id, ExploitDB_type, ExploitDB_platform,
  array_to_string(NVD_weaknesses, '|') AS NVD_weaknesses,
  array_to_string(NVD_references, '|') AS NVD_references,
  Metasploit_module_name, Metasploit_type, Metasploit_platform
FROM threats""")

ORACLE_SQL["score_breakdown_by_rule"] = with_feeds("""
, long AS (
  SELECT 'CISA_KEY' AS name, a_kev AS points FROM addends
  UNION ALL SELECT 'EPSS', a_epss FROM addends
  UNION ALL SELECT 'EXPLOIT_DB', a_xdb FROM addends
  UNION ALL SELECT 'METASPLOIT', a_msf FROM addends
  UNION ALL SELECT 'NVD_CVSS_3', a_cvss FROM addends),
per AS (SELECT name, count(*) FILTER (WHERE points > 0) AS n_cves,
               cast(sum(points) AS DOUBLE) AS total_points FROM long GROUP BY name),
dims(category, name, weight, source_collection) AS (VALUES
  ('CISA', 'CISA_KEY', 30.0::DOUBLE, 'gold_cisa'),
  ('EPSS', 'EPSS', 10.0::DOUBLE, 'gold_epss'),
  ('ExploitDB', 'EXPLOIT_DB', 10.0::DOUBLE, 'gold_exploit'),
  ('Metasploit', 'METASPLOIT', 10.0::DOUBLE, 'gold_metasploit'),
  ('NVD', 'NVD_CVSS_3', 0.5::DOUBLE, 'gold_nvd'))
SELECT d.category, d.name, d.weight, d.source_collection, p.n_cves, p.total_points
FROM dims d LEFT JOIN per p USING (name)""")

ORACLE_SQL["threat_coverage"] = with_feeds("""
, counts AS (
  SELECT 'CISA_required_action' AS key, count(CISA_required_action) AS n_cves FROM threats
  UNION ALL SELECT 'CISA_known_ransomware_campaign_use', count(CISA_known_ransomware_campaign_use) FROM threats
  UNION ALL SELECT 'CISA_product', count(CISA_product) FROM threats
  UNION ALL SELECT 'CISA_vendor_project', count(CISA_vendor_project) FROM threats
  UNION ALL SELECT 'CISA_cwe', count(CISA_cwe) FROM threats
  UNION ALL SELECT 'EPSS_epss_value', count(EPSS_epss_value) FROM threats
  UNION ALL SELECT 'EPSS_percentile', count(EPSS_percentile) FROM threats
  UNION ALL SELECT 'ExploitDB_exploit_id', count(ExploitDB_exploit_id) FROM threats
  UNION ALL SELECT 'ExploitDB_type', count(ExploitDB_type) FROM threats
  UNION ALL SELECT 'ExploitDB_platform', count(ExploitDB_platform) FROM threats
  UNION ALL SELECT 'NVD_weaknesses', count(NVD_weaknesses) FROM threats
  UNION ALL SELECT 'NVD_references', count(NVD_references) FROM threats
  UNION ALL SELECT 'Metasploit_module_name', count(Metasploit_module_name) FROM threats
  UNION ALL SELECT 'Metasploit_type', count(Metasploit_type) FROM threats
  UNION ALL SELECT 'Metasploit_platform', count(Metasploit_platform) FROM threats),
dims(category, name, source_collection) AS (VALUES
  ('CISA', 'required_action', 'gold_cisa'), ('CISA', 'known_ransomware_campaign_use', 'gold_cisa'),
  ('CISA', 'product', 'gold_cisa'), ('CISA', 'vendor_project', 'gold_cisa'), ('CISA', 'cwe', 'gold_cisa'),
  ('EPSS', 'epss_value', 'gold_epss'), ('EPSS', 'percentile', 'gold_epss'),
  ('ExploitDB', 'exploit_id', 'gold_exploit'), ('ExploitDB', 'type', 'gold_exploit'),
  ('ExploitDB', 'platform', 'gold_exploit'),
  ('NVD', 'weaknesses', 'gold_nvd'), ('NVD', 'references', 'gold_nvd'),
  ('Metasploit', 'module_name', 'gold_metasploit'), ('Metasploit', 'type', 'gold_metasploit'),
  ('Metasploit', 'platform', 'gold_metasploit'))
SELECT d.category || '_' || d.name AS key, d.category, d.name, d.source_collection, c.n_cves
FROM dims d LEFT JOIN counts c ON c.key = d.category || '_' || d.name""")

ORACLE_SQL["score_band_counts"] = with_feeds("""
SELECT cast(floor(vrr_score / 10) * 10 AS BIGINT) AS band, count(*) AS n_cves, max(vrr_score) AS max_score
FROM fact GROUP BY 1""")

ORACLE_SQL["latest_epss_per_cve"] = with_feeds("""
SELECT cve, cast(epss AS DOUBLE) AS epss, cast(percentile AS DOUBLE) AS percentile, date FROM epss""")

ORACLE_SQL["exploit_codes_exploded"] = with_feeds("""
SELECT code, id, type, platform, source_url FROM xdb""")

ORACLE_SQL["module_refs_exploded"] = with_feeds("""
SELECT ref, fullname, name, platform, mod_time FROM msf""")

ORACLE_SQL["rule_field_presence"] = with_feeds("""
, mref_counts AS (SELECT fullname, count(ref) AS n FROM mrefs GROUP BY fullname),
pres(source, field, n_rows, collection) AS (
  SELECT 'CISA', 'required_action', count(required_action), 'gold_cisa' FROM kev
  UNION ALL SELECT 'CISA', 'known_ransomware_campaign_use', count(known_ransomware_campaign_use), 'gold_cisa' FROM kev
  UNION ALL SELECT 'CISA', 'product', count(product), 'gold_cisa' FROM kev
  UNION ALL SELECT 'CISA', 'vendor_project', count(vendor_project), 'gold_cisa' FROM kev
  UNION ALL SELECT 'CISA', 'cwes', count(cwes), 'gold_cisa' FROM kev
  UNION ALL SELECT 'CISA', 'cve_id', count(cve_id), 'gold_cisa' FROM kev
  UNION ALL SELECT 'EPSS', 'epss', count(epss), 'gold_epss' FROM epss
  UNION ALL SELECT 'EPSS', 'percentile', count(percentile), 'gold_epss' FROM epss
  UNION ALL SELECT 'ExploitDB', 'source_url', count(source_url), 'gold_exploit' FROM exploit
  UNION ALL SELECT 'ExploitDB', 'type', count(type), 'gold_exploit' FROM exploit
  UNION ALL SELECT 'ExploitDB', 'platform', count(platform), 'gold_exploit' FROM exploit
  UNION ALL SELECT 'NVD', 'weaknesses', count(weaknesses), 'gold_nvd' FROM nvd
  UNION ALL SELECT 'NVD', 'references', count(refs), 'gold_nvd' FROM nvd
  UNION ALL SELECT 'NVD', 'metrics_cvssMetricV31', count(base_score), 'gold_nvd' FROM nvd
  UNION ALL SELECT 'NVD', 'metrics_cvssMetricV40', 0, 'gold_nvd'
  UNION ALL SELECT 'NVD', 'metrics_cvssMetricV2', 0, 'gold_nvd'
  UNION ALL SELECT 'Metasploit', 'name', count(name), 'gold_metasploit' FROM modules
  UNION ALL SELECT 'Metasploit', 'type', count(type), 'gold_metasploit' FROM modules
  UNION ALL SELECT 'Metasploit', 'platform', count(platform), 'gold_metasploit' FROM modules
  UNION ALL SELECT 'Metasploit', 'references', count(c.n), 'gold_metasploit'
    FROM modules m LEFT JOIN mref_counts c USING (fullname))
SELECT source, field, cast(n_rows AS BIGINT) AS n_rows, collection FROM pres""")


FINDINGS = f"""
, fnd AS (
  SELECT event_id AS row_id, cast(event_id % 37 AS VARCHAR) AS plugin,
    '10.0.0.' || cast(user_id AS VARCHAR) AS host, event_type AS risk,
    ' ' || lower(printf('CVE-2024-%06d', event_id % (SELECT max(p_partkey) * 11 // 10 FROM part))) || ',' || chr(10)
      || printf('CVE-2024-%06d', event_id * 7 % (SELECT max(p_partkey) * 11 // 10 FROM part)) || ',' || chr(9) || 'n/a' AS cve_text,
    props AS description,
    CASE WHEN event_type = 'view' THEN NULL ELSE 'Seen ' || event_type END AS synopsis
  FROM events),
norm AS (
  SELECT row_id, md5(host || '-' || plugin) AS fid, host, plugin, risk,
    list_sort(list_distinct(list_filter(list_transform(string_split(cve_text, ','), lambda x: upper(regexp_replace(x, '^\\s+|\\s+$', '', 'g'))),
                                        lambda x: starts_with(x, 'CVE-')))) AS cves
  FROM fnd),
pairs AS (SELECT row_id, unnest(cves) AS cve FROM norm),
hits AS (SELECT p.row_id, p.cve, t.* EXCLUDE (cve_id) FROM pairs p JOIN threats t ON t.cve_id = p.cve),
tlong AS (
  SELECT row_id, 'CISA_required_action' AS key, CISA_required_action AS v FROM hits WHERE CISA_required_action IS NOT NULL
  UNION ALL SELECT row_id, 'CISA_known_ransomware_campaign_use', CISA_known_ransomware_campaign_use FROM hits WHERE CISA_known_ransomware_campaign_use IS NOT NULL
  UNION ALL SELECT row_id, 'CISA_product', CISA_product FROM hits WHERE CISA_product IS NOT NULL
  UNION ALL SELECT row_id, 'CISA_vendor_project', CISA_vendor_project FROM hits WHERE CISA_vendor_project IS NOT NULL
  UNION ALL SELECT row_id, 'CISA_cwe', unnest(CISA_cwe) FROM hits WHERE CISA_cwe IS NOT NULL
  UNION ALL SELECT row_id, 'EPSS_epss_value', {dtext('EPSS_epss_value')} FROM hits WHERE EPSS_epss_value IS NOT NULL
  UNION ALL SELECT row_id, 'EPSS_percentile', {dtext('EPSS_percentile')} FROM hits WHERE EPSS_percentile IS NOT NULL
  UNION ALL SELECT row_id, 'ExploitDB_exploit_id', ExploitDB_exploit_id FROM hits WHERE ExploitDB_exploit_id IS NOT NULL
  UNION ALL SELECT row_id, 'ExploitDB_type', ExploitDB_type FROM hits WHERE ExploitDB_type IS NOT NULL
  UNION ALL SELECT row_id, 'ExploitDB_platform', ExploitDB_platform FROM hits WHERE ExploitDB_platform IS NOT NULL
  UNION ALL SELECT row_id, 'NVD_weaknesses', unnest(NVD_weaknesses) FROM hits WHERE NVD_weaknesses IS NOT NULL
  UNION ALL SELECT row_id, 'NVD_references', unnest(NVD_references) FROM hits WHERE NVD_references IS NOT NULL
  UNION ALL SELECT row_id, 'Metasploit_module_name', Metasploit_module_name FROM hits WHERE Metasploit_module_name IS NOT NULL
  UNION ALL SELECT row_id, 'Metasploit_type', Metasploit_type FROM hits WHERE Metasploit_type IS NOT NULL
  UNION ALL SELECT row_id, 'Metasploit_platform', Metasploit_platform FROM hits WHERE Metasploit_platform IS NOT NULL),
per_row AS (
  SELECT row_id, max(vrr_score) AS vrr_score, list_sort(list(DISTINCT cve)) AS vulns FROM hits GROUP BY row_id),
weak AS (
  SELECT row_id, list_sort(list(DISTINCT v)) AS w FROM tlong WHERE contains(v, 'CWE-') GROUP BY row_id),
report AS (
  SELECT n.row_id, n.fid AS HostFindingsID, coalesce(p.vrr_score, 0.0) AS vrr_score,
    coalesce(array_to_string(p.vulns, '|'), '') AS vulnerabilities,
    n.host AS IPAddress, n.plugin AS ScannerPluginID, n.risk AS ScannerReportedSeverity,
    'Nessus' AS ScannerName, 'Open' AS Status, coalesce(w.w, []::VARCHAR[]) AS weak_list
  FROM norm n LEFT JOIN per_row p USING (row_id) LEFT JOIN weak w USING (row_id))
"""


def with_findings(body: str) -> str:
    return with_feeds(FINDINGS.strip() + "\n" + body)


ORACLE_SQL["finding_cves_normalized"] = with_findings("""
SELECT row_id, fid AS HostFindingsID, array_to_string(cves, '|') AS cves, cast(len(cves) AS INTEGER) AS n_cves
FROM norm""")

ORACLE_SQL["enriched_findings"] = with_findings("""
SELECT row_id, HostFindingsID, vrr_score, vulnerabilities, IPAddress, ScannerPluginID,
  ScannerReportedSeverity, ScannerName, Status FROM report""")

ORACLE_SQL["finding_weaknesses"] = with_findings("""
SELECT row_id, array_to_string(weak_list, '|') AS weaknesses, cast(len(weak_list) AS INTEGER) AS n_weaknesses
FROM report""")

ORACLE_SQL["finding_threats_long"] = with_findings("""
SELECT row_id, key AS threat_key, array_to_string(list_sort(list(DISTINCT v)), '|') AS vals,
  cast(count(DISTINCT v) AS INTEGER) AS n_vals
FROM tlong GROUP BY row_id, key""")

ORACLE_SQL["enrich_simple"] = with_feeds(f"""
, ev AS (SELECT event_id AS row_id, {cve('event_id % (SELECT max(p_partkey) * 11 // 10 FROM part)')} AS cve_id FROM events),
txt AS (
  SELECT cve_id, vrr_score, concat_ws('; ',
    'CISA_required_action: ' || CISA_required_action,
    'CISA_known_ransomware_campaign_use: ' || CISA_known_ransomware_campaign_use,
    'CISA_product: ' || CISA_product,
    'CISA_vendor_project: ' || CISA_vendor_project,
    'CISA_cwe: [''' || array_to_string(CISA_cwe, ''', ''') || ''']',
    'EPSS_epss_value: ' || {dtext('EPSS_epss_value')},
    'EPSS_percentile: ' || {dtext('EPSS_percentile')},
    'ExploitDB_exploit_id: ' || ExploitDB_exploit_id,
    'ExploitDB_type: ' || ExploitDB_type,
    'ExploitDB_platform: ' || ExploitDB_platform,
    'NVD_weaknesses: [''' || array_to_string(NVD_weaknesses, ''', ''') || ''']',
    'NVD_references: [''' || array_to_string(NVD_references, ''', ''') || ''']',
    'Metasploit_module_name: ' || Metasploit_module_name,
    'Metasploit_type: ' || Metasploit_type,
    'Metasploit_platform: ' || Metasploit_platform) AS threat_intel
  FROM threats)
SELECT e.row_id, e.cve_id, coalesce(t.vrr_score, 0.0) AS vrr_score, coalesce(t.threat_intel, '') AS threat_intel
FROM ev e LEFT JOIN txt t USING (cve_id)""")

ORACLE_SQL["intel_coverage"] = with_findings("""
, rc AS (SELECT DISTINCT cve FROM pairs)
SELECT count(*) AS n_report_cves, count(f.cve_id) AS n_matched_cves
FROM rc LEFT JOIN fact f ON f.cve_id = rc.cve""")

ORACLE_SQL["top_risks"] = with_findings("""
SELECT row_id, HostFindingsID, vrr_score, vulnerabilities FROM report
ORDER BY vrr_score DESC, row_id ASC LIMIT 20""")

ORACLE_SQL["report_preview"] = with_findings("""
SELECT row_id, ScannerPluginID, vrr_score, vulnerabilities, IPAddress,
  greatest((SELECT count(*) FROM report) - 10, 0) AS more_rows
FROM report ORDER BY row_id LIMIT 10""")

ORACLE_SQL["finding_report_text"] = with_findings("""
SELECT row_id, trim(coalesce(description, '') || ' ' || coalesce(synopsis, '')) AS Description,
  '' AS PluginOutput, CAST(NULL AS VARCHAR) AS PossiblePatches, 'Upgrade.' AS PossibleSolutions
FROM fnd""")


MERGE_SRC = """
WITH t AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate,
    o_totalprice / 1000 AS VRRScore
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
i AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE 'U' END AS o_orderstatus,
    o_totalprice + CASE WHEN o_orderkey % 2 = 0 THEN 1.0 ELSE 0.0 END AS o_totalprice,
    o_orderpriority, 'delta' AS feed
  FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'),
j AS (
  SELECT coalesce(i.o_orderkey, t.o_orderkey) AS k, i.o_orderkey IS NOT NULL AS in_new,
    t.o_orderkey IS NOT NULL AS in_old,
    t.o_custkey, t.o_orderstatus AS s_old, i.o_orderstatus AS s_new, t.o_totalprice AS p_old,
    i.o_totalprice AS p_new, t.o_orderpriority AS pr_old, i.o_orderpriority AS pr_new, i.feed,
    t.o_orderdate, t.VRRScore
  FROM t FULL OUTER JOIN i ON t.o_orderkey = i.o_orderkey)
"""

ORACLE_SQL["upsert_result"] = MERGE_SRC + """
SELECT k AS o_orderkey, o_custkey,
  CASE WHEN in_new THEN s_new ELSE s_old END AS o_orderstatus,
  CASE WHEN in_new THEN p_new ELSE p_old END AS o_totalprice,
  CASE WHEN in_new THEN pr_new ELSE pr_old END AS o_orderpriority, feed
FROM j"""

ORACLE_SQL["upsert_audit"] = MERGE_SRC + """
SELECT k AS o_orderkey,
  CASE WHEN in_old THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE '2024-06-01 00:00:00' END AS created_at,
  CASE WHEN in_new THEN '2024-06-01 00:00:00' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS updated_at
FROM j"""

ORACLE_SQL["upsert_keep_nulls"] = MERGE_SRC + """
SELECT k AS o_orderkey, o_custkey,
  CASE WHEN in_new THEN coalesce(s_new, s_old) ELSE s_old END AS o_orderstatus,
  CASE WHEN in_new THEN coalesce(p_new, p_old) ELSE p_old END AS o_totalprice,
  feed, CASE WHEN in_new THEN NULL ELSE VRRScore END AS VRRScore
FROM j"""

ORACLE_SQL["insert_if_absent"] = MERGE_SRC + """
SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS feed FROM t
UNION ALL
SELECT o_orderkey, o_orderstatus, o_totalprice, feed FROM i
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = i.o_orderkey)"""

ORACLE_SQL["merge_stats"] = MERGE_SRC + """
, s AS (
  SELECT count(*) FILTER (WHERE in_new) AS processed,
    count(*) FILTER (WHERE in_new AND NOT in_old) AS inserted,
    count(*) FILTER (WHERE in_new AND in_old) AS matched,
    count(*) FILTER (WHERE in_new AND in_old AND (s_new IS DISTINCT FROM s_old OR p_new IS DISTINCT FROM p_old
                                                OR pr_new IS DISTINCT FROM pr_old)) AS modified
  FROM j)
SELECT 'processed' AS status, processed AS n FROM s
UNION ALL SELECT 'inserted', inserted FROM s
UNION ALL SELECT 'matched', matched FROM s
UNION ALL SELECT 'modified', modified FROM s"""

ORACLE_SQL["kev_since"] = with_feeds("""
SELECT cve_id, date_added FROM kev WHERE date_added > '2022-06-01'""")

ORACLE_SQL["exploit_since"] = with_feeds("""
, c AS (SELECT id, coalesce(nullif(date_updated, ''), nullif(date_published, '')) AS change_date FROM exploit)
SELECT id, change_date FROM c WHERE change_date IS NULL OR change_date > '1998-06-01'""")

ORACLE_SQL["module_since"] = with_feeds("""
SELECT fullname, mod_time FROM modules WHERE mod_time IS NULL OR mod_time > '2000-06-01 00:00:00 +0000'""")


def _sane(w: str, default: str) -> str:
    return (f"CASE WHEN {w} IS NULL OR contains({w}, ',') OR contains({w}, 'score_date') "
            f"THEN '{default}' ELSE {w} END")


ORACLE_SQL["watermark_per_source"] = with_feeds(f"""
, w(source, raw_max, dflt) AS (
  SELECT 'nvd', max(strftime(last_modified, '%Y-%m-%dT%H:%M:%S.%g')), '1999-01-01T00:00:00.000' FROM nvd
  UNION ALL SELECT 'cisa', max(date_added), '1970-01-01' FROM kev
  UNION ALL SELECT 'epss', max(date), '1970-01-01' FROM epss
  UNION ALL SELECT 'exploit', max(date_published), '1970-01-01' FROM exploit
  UNION ALL SELECT 'metasploit', max(mod_time), '1970-01-01' FROM modules
  UNION ALL SELECT 'epss_meta', max('model_version:v2023.03.01,score_date:' || strftime(ts, '%Y-%m-%d')),
    '1970-01-01' FROM events)
SELECT source, raw_max,
  CASE WHEN raw_max IS NULL OR contains(raw_max, ',') OR contains(raw_max, 'score_date')
       THEN dflt ELSE raw_max END AS watermark
FROM w""")

ORACLE_SQL["snapshot_gate_newest"] = """
SELECT strftime(ts, '%Y-%m-%d') AS score_date, count(*) AS n_rows
FROM events WHERE strftime(ts, '%Y-%m-%d') > '2024-01-20' GROUP BY 1"""

ORACLE_SQL["rows_per_time_slice"] = """
WITH b AS (SELECT min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders),
lows AS (
  SELECT unnest(CASE WHEN floor(date_diff('second', s, e) / 86400) > 120
                     THEN generate_series(s, e - INTERVAL 1 SECOND, INTERVAL 119 DAY)
                     ELSE [s] END) AS lo, s, e FROM b),
sl AS (
  SELECT row_number() OVER (ORDER BY lo) - 1 AS slice_no, lo,
    CASE WHEN floor(date_diff('second', s, e) / 86400) > 120 THEN least(lo + INTERVAL 119 DAY, e) ELSE e END AS hi
  FROM lows)
SELECT cast(slice_no AS INTEGER) AS slice_no, strftime(lo, '%Y-%m-%d %H:%M:%S') AS lo,
  strftime(hi, '%Y-%m-%d %H:%M:%S') AS hi, count(o.o_orderdate) AS n_rows
FROM sl LEFT JOIN orders o ON o.o_orderdate >= sl.lo AND o.o_orderdate <= sl.hi
GROUP BY slice_no, lo, hi"""

ORACLE_SQL["missing_in_target"] = """
SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'P')"""

ORACLE_SQL["late_rows_repaired"] = """
WITH f AS (SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus = 'F'),
s AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM f)),
loaded AS (SELECT o_orderkey FROM f UNION ALL SELECT o_orderkey FROM s)
SELECT o_orderkey, o_orderstatus, 'initial' AS found_by FROM f
UNION ALL SELECT o_orderkey, o_orderstatus, 'incremental' FROM s
UNION ALL SELECT o_orderkey, o_orderstatus, 'repair' FROM orders o
  WHERE NOT EXISTS (SELECT 1 FROM loaded x WHERE x.o_orderkey = o.o_orderkey)"""

ORACLE_SQL["cutoff_counts"] = """
SELECT 'bronze' AS layer, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS n_before,
  count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS n_after FROM orders
UNION ALL
SELECT 'silver', count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01'),
  count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') FROM orders WHERE o_orderstatus = 'F'"""

ORACLE_SQL["duplicate_keys"] = """
SELECT md5('10.0.0.' || cast(user_id AS VARCHAR) || '-' || cast(event_id % 37 AS VARCHAR)) AS HostFindingsID,
  count(*) AS n
FROM events GROUP BY 1 HAVING count(*) > 1"""

ORACLE_SQL["table_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in
    ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
     "documents", "embeddings", "pages", "benchmark", "labels", "conversations"])

ORACLE_SQL["mirror_include"] = "SELECT c_name, c_acctbal, c_custkey AS id FROM customer"

ORACLE_SQL["mirror_exclude_manual"] = """
SELECT c_custkey AS id, c_name, 0 AS c_nationkey, c_acctbal, 'gold' AS tier FROM customer"""

ORACLE_SQL["factor_table_long"] = with_feeds("""
, f AS (
  SELECT cve_id, 'vendor' AS factor_name, vendor_project AS value, 'CISA' AS category,
    'Static' AS static_or_dynamic, 'cisa' AS source FROM kev
  UNION ALL SELECT cve_id, 'ransomware', known_ransomware_campaign_use, 'CISA', 'Dynamic', 'cisa' FROM kev
  UNION ALL SELECT cve_id, 'first_cwe', cwes[1], 'CISA', 'Dynamic', 'cisa' FROM kev
  UNION ALL SELECT cve_id, 'cvss', cast(cast(base_score AS DOUBLE) AS VARCHAR), 'NVD', 'Static', 'nvd' FROM nvd
  UNION ALL SELECT cve_id, 'in_nvd', 'true', 'General', 'Dynamic', 'nvd' FROM nvd
  UNION ALL SELECT cve_id, 'first_weakness', weaknesses[1], 'NVD', 'Dynamic', 'nvd' FROM nvd)
SELECT md5(cve_id || '_' || factor_name || '_dim_factors') AS s_no, cve_id, factor_name, value, category,
  static_or_dynamic, source
FROM f WHERE value IS NOT NULL""")


ORACLE_SQL["page_metadata"] = r"""
WITH p AS (
  SELECT page_id, html,
    regexp_extract_all(html, '<a\s[^>]*href\s*=\s*["'']([^"'']*)["'']', 1) AS hrefs FROM pages)
SELECT page_id,
  regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
  regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1) AS lang,
  cast(len(hrefs) AS INTEGER) AS n_links,
  hrefs[1] AS first_href,
  nullif(regexp_extract(regexp_extract(html, '(<a\s[^>]*class\s*=\s*["''][^"'']*\bscreenshot-url\b[^"'']*["''][^>]*>)', 1),
                        'href\s*=\s*["'']([^"'']*)["'']', 1), '') AS screenshot_url,
  regexp_matches(html, '<i\s[^>]*class\s*=\s*["''][^"'']*\b(mdi-check|fa-check)\b') AS verified,
  coalesce(nullif(regexp_extract(html, '<a\s[^>]*href\s*=\s*["'']([^"'']*)["''][^>]*>[^<]*Vulnerable App', 1), ''),
           list_filter(hrefs, lambda h: regexp_matches(h, 'software|download') AND NOT contains(h, 'exploit-db.com'))[1])
    AS application_url,
  cast(len(list_filter(kw, lambda k: regexp_matches(k, '(?i)^(CVE-\d{4}-\d+|OSVDB-\d+)'))) AS INTEGER) AS n_codes,
  cast(len(list_filter(kw, lambda k: NOT regexp_matches(k, '(?i)^(CVE-\d{4}-\d+|OSVDB-\d+)')
                                     AND length(k) > 0 AND length(k) < 50)) AS INTEGER) AS n_tags
FROM (SELECT *, CASE WHEN kwt <> '' THEN list_transform(string_split(kwt, ','), lambda k: trim(k))
                     ELSE []::VARCHAR[] END AS kw
      FROM (SELECT *, regexp_extract(html, '<meta\s[^>]*name\s*=\s*["'']keywords["''][^>]*content\s*=\s*["'']([^"'']*)["'']', 1) AS kwt
            FROM p))"""

ORACLE_SQL["tolerant_casts"] = r"""
WITH t AS (
  SELECT event_id,
    CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                      WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
                      WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
                      ELSE 'junk-' || cast(event_id AS VARCHAR) END AS iso_text,
    CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d')
                      WHEN 1 THEN cast(year(ts) AS VARCHAR) || '-' || cast(month(ts) AS VARCHAR) || '-' || cast(day(ts) AS VARCHAR)
                      ELSE 'not-a-date' END AS day_text,
    CASE event_id % 5 WHEN 0 THEN cast(user_id AS VARCHAR) WHEN 1 THEN ' ' || cast(user_id AS VARCHAR) || ' '
                      WHEN 2 THEN cast(value AS VARCHAR) WHEN 3 THEN '' END AS port_text,
    CASE event_id % 4 WHEN 0 THEN cast(cast(value / 100 AS DECIMAL(7,5)) AS VARCHAR) WHEN 1 THEN ''
                      WHEN 3 THEN 'n/a' END AS epss_text
  FROM events),
p AS (
  SELECT *,
    try_strptime(substr(iso_text, 1, 19), '%Y-%m-%dT%H:%M:%S')
      - CASE WHEN iso_text LIKE '%+02:00' THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END AS ts_utc,
    CASE WHEN regexp_full_match(day_text, '\d{4}-\d{1,2}-\d{1,2}')
         THEN make_date(cast(split_part(day_text, '-', 1) AS INTEGER), cast(split_part(day_text, '-', 2) AS INTEGER),
                        cast(split_part(day_text, '-', 3) AS INTEGER)) END AS d,
    CASE WHEN regexp_full_match(trim(port_text), '[+-]?[0-9]+') THEN cast(trim(port_text) AS BIGINT) END AS port,
    CASE WHEN epss_text IS NULL OR trim(epss_text) = '' THEN 0::DECIMAL(7,5)
         ELSE try_cast(trim(epss_text) AS DECIMAL(7,5)) END AS e
  FROM t)
SELECT event_id, iso_text, strftime(ts_utc, '%Y-%m-%d %H:%M:%S') AS parsed_ts, day_text,
  strftime(d, '%Y-%m-%d') AS parsed_day, port_text, port, epss_text, cast(e AS DOUBLE) AS epss,
  e IS NULL AS quarantined
FROM p"""

ORACLE_SQL["cvss_from_nested"] = f"""
WITH m AS (
  SELECT {cve('p_partkey')} AS cve_id, p_partkey,
    '{{"cvssData":{{"baseScore":' || cast(cast((p_retailprice - 900) / 10 AS DECIMAL(4,1)) AS VARCHAR) || '}}}}' AS s
  FROM part),
j AS (
  SELECT cve_id, p_partkey,
    CASE p_partkey % 4 WHEN 0 THEN '{{"cvssMetricV31":[' || s || ']}}'
                       WHEN 1 THEN '{{"cvssMetricV31":[],"cvssMetricV2":[' || s || ']}}'
                       WHEN 2 THEN '{{"cvssMetricV2":[' || s || '],"cvssMetricV30":[' || s || ']}}'
                       ELSE '{{}}' END AS txt
  FROM m),
k AS (
  SELECT *, json_array_length(json_extract(txt, '$.cvssMetricV31')) AS n31 FROM j)
SELECT cve_id,
  array_to_string(list_sort(list_filter(json_keys(txt),
                                        lambda x: json_array_length(json_extract(txt, '$.' || x)) > 0)), '|')
    AS metric_types,
  coalesce(CASE WHEN p_partkey % 8 <> 4 AND n31 > 0
                THEN cast(json_extract(txt, '$.cvssMetricV31[0].cvssData.baseScore') AS DOUBLE)
                WHEN n31 > 0
                THEN cast(json_extract(txt, '$.cvssMetricV31[0].cvssData.baseScore') AS DOUBLE) END, 0.0)
    AS cvss_base,
  cast(json_extract(txt, '$.cvssMetricV2[0].cvssData.baseScore') AS DOUBLE) AS v2_score
FROM k"""

ORACLE_SQL["english_descriptions"] = f"""
WITH d AS (
  SELECT doc_id, [{{'lang': lang, 'value': text}}, {{'lang': lang || '-x', 'value': source}}] AS descs
  FROM documents),
e AS (
  SELECT doc_id, list_transform(list_filter(descs, lambda x: x.lang = 'en'), lambda x: x.value) AS en FROM d)
SELECT {cve('doc_id')} AS cve_id, cast(len(en) AS INTEGER) AS n_en,
  md5(coalesce(array_to_string(en, chr(10)), '')) AS en_md5
FROM e"""

ORACLE_SQL["first_weakness"] = """
WITH w AS (
  SELECT conv_id, turn,
    [{'source': role, 'description': [{'lang': CASE WHEN role = 'user' THEN 'en' ELSE 'es' END, 'value': text},
                                      {'lang': 'en', 'value': role}]},
     {'source': 'none', 'description': []::STRUCT(lang VARCHAR, value VARCHAR)[]}] AS weaknesses
  FROM conversations)
SELECT conv_id, turn,
  md5(array_to_string(list_transform(list_filter(weaknesses, lambda x: len(x.description) > 0),
                                     lambda x: x.description[1].value), '|')) AS first_md5,
  cast(len(flatten(list_transform(weaknesses, lambda x: list_filter(x.description, lambda y: y.lang = 'en'))))
       AS INTEGER) AS n_en,
  array_to_string(list_transform(weaknesses, lambda x: x.source), '|') AS sources
FROM w"""


ORACLE_SQL["stream_upsert_equals_batch"] = """
SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""

ORACLE_SQL["stream_redelivery"] = ORACLE_SQL["stream_upsert_equals_batch"]

ORACLE_SQL["nvd_pages_roundtrip"] = f"""
SELECT {cve('p_partkey')} AS cve_id,
  CASE WHEN p_partkey % 6 = 0 THEN NULL
       ELSE strftime(DATE '2024-01-01' + cast(p_partkey % 300 AS INTEGER), '%Y-%m-%d') || ' 10:00:00' END
    AS last_modified,
  p_name AS descriptions, 'CWE-' || cast(p_size AS VARCHAR) AS weaknesses,
  'https://nvd.example/' || cast(p_partkey AS VARCHAR) AS refs,
  CASE WHEN p_partkey % 5 = 0 THEN 0.0
       ELSE cast(cast((p_retailprice - 900) / 10 AS DECIMAL(4,1)) AS DOUBLE) END AS cvss_v31
FROM part"""

ORACLE_SQL["upsert_bucketed_result"] = ORACLE_SQL["upsert_result"]

ORACLE_SQL["epss_snapshots_roundtrip"] = """
WITH r AS (
  SELECT cast(year(l_shipdate) AS VARCHAR) || '-12-31' AS date, l_linenumber,
    CASE WHEN l_linenumber = 6 THEN cast(0 AS DECIMAL(7,5))
         WHEN l_linenumber = 7 THEN NULL
         ELSE cast(l_discount * 9.87 AS DECIMAL(7,5)) END AS e
  FROM lineitem)
SELECT date, count(*) FILTER (WHERE l_linenumber <> 7) AS n_good,
  count(*) FILTER (WHERE l_linenumber = 7) AS n_quarantined,
  cast(sum(e) AS DOUBLE) AS epss_sum
FROM r WHERE date > '1997-06-01' GROUP BY date"""

ORACLE_SQL["kev_catalog_roundtrip"] = f"""
WITH k AS (
  SELECT {cve('p_partkey')} AS cve_id, p_brand AS vendor_project, p_partkey, p_size,
    CASE WHEN p_partkey % 17 = 0 THEN NULL
         ELSE printf('2021-%02d-%02d', p_partkey % 12 + 1, p_partkey % 28 + 1) END AS added
  FROM part WHERE p_size % 7 <> 0)
SELECT cve_id,
  strftime(make_date(2021, cast(p_partkey % 12 + 1 AS INTEGER), cast(p_partkey % 28 + 1 AS INTEGER)), '%Y-%m-%d')
    AS date_added,
  vendor_project,
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'CWE-' || cast(p_size AS VARCHAR) END AS cwes,
  'CISA Catalog of Known Exploited Vulnerabilities' AS title,
  '2024-12-01 10:00:00' AS date_released
FROM k WHERE added IS NOT NULL AND added > '2021-06-15'"""

ORACLE_SQL["modules_map_roundtrip"] = f"""
WITH li AS (SELECT l_suppkey, max(l_shipdate) AS mt FROM lineitem GROUP BY l_suppkey),
m AS (
  SELECT 'exploit/s' || cast(s_suppkey AS VARCHAR) AS fullname, s_name AS name,
    CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE strftime(mt, '%Y-%m-%d %H:%M:%S') || ' +0000' END AS mod_time,
    cast(s_suppkey % 7 AS INTEGER) AS rank,
    CASE WHEN s_suppkey % 3 = 0 THEN ''
         ELSE {cve('s_suppkey')} || '|URL-https://ref.example/' || cast(s_suppkey AS VARCHAR) END AS refs
  FROM supplier LEFT JOIN li ON l_suppkey = s_suppkey)
SELECT fullname, name, mod_time, rank, refs, 0 AS n_authors FROM m
WHERE mod_time IS NULL OR mod_time > '1998-01-01 00:00:00 +0000'"""

ORACLE_SQL["exploit_index_roundtrip"] = f"""
WITH j AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS pub,
    CASE WHEN o_orderkey % 5 = 0 THEN strftime(cast(o_orderdate AS DATE) + 400, '%Y-%m-%d') END AS upd,
    list_sort(list(DISTINCT {cve('l_partkey')})) AS cves
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE o_orderpriority <> '5-LOW'
  GROUP BY o_orderkey, o_orderdate)
SELECT cast(o_orderkey AS VARCHAR) AS id, pub AS date_published,
  CASE WHEN o_orderkey % 3 = 0 THEN 80::BIGINT END AS port,
  o_orderkey % 2 = 0 AS verified,
  CASE WHEN o_orderkey % 2 = 0 THEN array_to_string(cves, '|')
       ELSE array_to_string(cves, '|') || '|OSVDB-' || cast(o_orderkey AS VARCHAR) END AS codes,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Linux|remote' END AS tags
FROM j WHERE coalesce(upd, pub) > '1996-01-01'"""


# ------------------------------------------------------------------ catalog_layers

ORACLE_SQL["fact_from_layers"] = ORACLE_SQL["vrr_score_per_cve"]

_DELIVERIES = """
WITH d AS (
  SELECT 1 AS run, p_partkey AS k, p_size * 1 AS price, '2024-01-01' AS seen FROM part WHERE p_partkey % 7 <> 0
  UNION ALL SELECT 2, p_partkey, p_size * 2, '2024-02-01' FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 7 = 0)
"""

ORACLE_SQL["custom_source"] = _DELIVERIES + """
SELECT cast(k AS VARCHAR) AS id, cast(arg_max(price, run) AS DOUBLE) AS price, max(seen) AS seen, 'parts' AS origin,
  min(seen) AS gold_created_at, max(seen) AS gold_updated_at
FROM d WHERE k % 11 <> 0 GROUP BY k"""

ORACLE_SQL["gold_any_run_ts"] = """
WITH d AS (
  SELECT 1 AS run, p_partkey AS k, p_size * 1 AS price FROM part WHERE p_partkey % 7 <> 0
  UNION ALL SELECT 2, p_partkey, p_size * 2 FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 7 = 0
  UNION ALL SELECT 3, p_partkey, p_size * 3 FROM part WHERE p_partkey % 5 = 0)
SELECT cast(k AS VARCHAR) AS id, cast(arg_max(price, run) AS DOUBLE) AS price, '2024-0' || max(run) || '-01' AS seen FROM d GROUP BY k"""

ORACLE_SQL["rows_per_interval"] = """
WITH o AS (SELECT p_partkey, DATE '1992-01-01' + CAST(p_partkey * 7 % 2400 AS INT) AS start,
    CAST(CASE WHEN p_partkey % 50 = 0 THEN p_size * 40 ELSE p_size END AS INT) AS days FROM part)
SELECT p_partkey, count(*) AS n_rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM o JOIN lineitem ON CAST(l_shipdate AS DATE) BETWEEN start AND start + days GROUP BY p_partkey"""

ORACLE_SQL["kev_catalog_in_ranges"] = ORACLE_SQL["kev_catalog_roundtrip"]
ORACLE_SQL["modules_map_in_ranges"] = ORACLE_SQL["modules_map_roundtrip"]
ORACLE_SQL["growing_table"] = ORACLE_SQL["upsert_bucketed_result"]
ORACLE_SQL["fact_rows_by_key"] = with_feeds("""
SELECT cve_id, vrr_score, 'few' AS asked FROM fact
WHERE cve_id IN (SELECT printf('CVE-2024-%06d', cast(n_nationkey * 40 AS BIGINT)) FROM nation UNION SELECT printf('CVE-2024-%06d', cast(n_regionkey * 40 AS BIGINT)) FROM nation)
UNION ALL SELECT cve_id, vrr_score, 'many' FROM fact WHERE cve_id IN (SELECT printf('CVE-2024-%06d', cast(l_partkey * 2 AS BIGINT)) FROM lineitem)""")
ORACLE_SQL["fact_colocated"] = ORACLE_SQL["vrr_score_per_cve"]
ORACLE_SQL["fact_incremental"] = ORACLE_SQL["vrr_score_per_cve"]

ORACLE_SQL["layer_status"] = _DELIVERIES + """
, n AS (SELECT run, count(*) AS landed, count(*) FILTER (k % 11 <> 0) AS good FROM d GROUP BY run)
SELECT run, 'parts' AS source, layer, 'ok' AS status, CASE layer WHEN 'bronze' THEN landed ELSE good END AS rows
FROM n, (SELECT unnest(['bronze', 'silver', 'gold']) AS layer)
UNION ALL SELECT run, 'broken', 'bronze', 'failed', 0 FROM n
UNION ALL SELECT run, 'broken', unnest(['silver', 'gold']), 'ok', 0 FROM n"""

ORACLE_SQL["quarantine_rows"] = _DELIVERIES + """
SELECT cast(k AS VARCHAR) AS id, 'price_not_a_number' AS reason, seen, seen AS run FROM d WHERE k % 11 = 0"""

ORACLE_SQL["replicate_tables"] = """
SELECT cast(p_partkey AS VARCHAR) AS id, cast(CASE WHEN p_partkey % 7 <> 0 THEN p_size ELSE p_size * 2 END AS DOUBLE) AS price FROM part"""

ORACLE_SQL["replace_report"] = """
SELECT o_orderkey, o_orderstatus, lower(o_orderstatus) AS state FROM orders WHERE o_orderstatus <> 'F'"""

ORACLE_SQL["scanner_csv_roundtrip"] = with_findings("""
, m AS (SELECT HostFindingsID, row_id, count(*) OVER (PARTITION BY HostFindingsID) AS n_records,
    row_number() OVER (PARTITION BY HostFindingsID ORDER BY row_id DESC) AS nth, vrr_score, vulnerabilities,
    ScannerPluginID, ScannerReportedSeverity FROM report)
SELECT HostFindingsID, CASE WHEN row_id % 9 = 0 THEN 0.0 ELSE vrr_score END AS vrr_score,
  CASE WHEN row_id % 9 = 0 THEN '' ELSE vulnerabilities END AS vulnerabilities,
  'Plugin ' || ScannerPluginID || ' row ' || cast(row_id AS VARCHAR) AS VulnerabilityName, ScannerReportedSeverity, n_records
FROM m WHERE nth = 1""")

ORACLE_SQL["enricher_roundtrip"] = with_feeds(f"""
, ev AS (SELECT event_id, {cve('event_id % (SELECT max(p_partkey) * 11 // 10 FROM part)')} AS cve_id FROM events)
SELECT event_id, cve_id, coalesce(vrr_score, 0.0) AS vrr_score, 1::BIGINT AS n_exported FROM ev LEFT JOIN fact USING (cve_id)""")

ORACLE_SQL["report_columns"] = """
WITH c AS (SELECT unnest(['row_id', 'vrr_score', 'vulnerabilities', 'weaknesses', 'IPAddress', 'VulnerabilityName', 'ScannerReportedSeverity',
    'HostFindingsID', 'threats', 'ScannerName', 'ScannerPluginID', 'ScannerSeverity', 'Description', 'Status', 'Port', 'Protocol',
    'PluginOutput', 'PossibleSolutions', 'PossiblePatches']) AS name, generate_subscripts(range(19), 1) - 1 AS position)
SELECT cast(position AS INTEGER) AS position, name, CASE name WHEN 'PossiblePatches' THEN 0 WHEN 'ScannerSeverity' THEN count(value) ELSE count(*) END AS n_values
FROM c, events GROUP BY position, name"""

ORACLE_SQL["zero_risk_dropped"] = with_findings("SELECT row_id, vrr_score FROM report WHERE vrr_score > 0")

ORACLE_SQL["exploit_page_metadata"] = """
SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN '/shots/' || p_partkey || '.png' END AS screenshot_url,
  p_partkey % 4 IN (0, 3) AS verified,
  CASE p_partkey % 5 WHEN 0 THEN 'https://soft.example/get?id=' || p_partkey || '&v=1'
    WHEN 1 THEN 'https://soft.example/get?id=' || p_partkey || '&v=1&download' END AS application_url,
  'CVE-2024-' || p_partkey || '|OSVDB-' || p_partkey AS codes, 'Remote|R&D' AS tags
FROM part"""

ORACLE_SQL["page_markup"] = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h,
    regexp_extract_all(coalesce(html, ''), '<a\s[^>]*href\s*=\s*["'']([^"'']+)["'']', 1) AS hrefs FROM pages)
SELECT page_id,
  cast(len(hrefs) + (page_id % 2 = 0)::INTEGER + (page_id % 3 < 2)::INTEGER AS INTEGER) AS n_links,
  CASE WHEN page_id % 2 = 0 THEN '/shots/' || page_id || '.png'
       ELSE nullif(regexp_extract(regexp_extract(h, '(<a\s[^>]*class\s*=\s*["''][^"'']*\bscreenshot-url\b[^"'']*["''][^>]*>)', 1),
                                  'href\s*=\s*["'']([^"'']*)["'']', 1), '') END AS screenshot_url,
  page_id % 5 = 0 OR regexp_matches(h, '<i\s[^>]*class\s*=\s*["''][^"'']*\b(mdi-check|fa-check)\b') AS verified,
  CASE WHEN page_id % 3 = 0 THEN '/app/' || page_id || '?q=&lt;A'
       ELSE coalesce(nullif(regexp_extract(h, '<a\s[^>]*href\s*=\s*["'']([^"'']*)["''][^>]*>[^<]*Vulnerable App', 1), ''),
                     CASE WHEN page_id % 3 = 1 THEN '/software/' || page_id END,
                     list_filter(hrefs, lambda x: regexp_matches(x, 'software|download') AND NOT contains(x, 'exploit-db.com'))[1])
  END AS application_url
FROM p"""

ORACLE_SQL["epss_silver"] = """
SELECT strftime(l_shipdate, '%Y') AS date, count(*) FILTER (l_linenumber NOT IN (5, 7)) AS n_good,
  cast(sum(CASE WHEN l_linenumber NOT IN (5, 6, 7) THEN l_partkey WHEN l_linenumber = 6 THEN 0 END) AS BIGINT) AS billionths,
  count(*) FILTER (l_linenumber IN (5, 7)) AS n_bad
FROM lineitem GROUP BY 1"""

ORACLE_SQL["range_rows"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
WHERE cast(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'"""

ORACLE_SQL["incremental_lookback"] = "SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1996-05-22 00:00:00'"

ORACLE_SQL["nvd_slices_backfill"] = """
WITH b AS (SELECT min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders),
w AS (SELECT i AS slice_no, s + to_days(119 * i) AS lo, least(s + to_days(119 * (i + 1)), e) AS hi
  FROM b, (SELECT unnest(range(0, 1000))::INTEGER AS i) WHERE s + to_days(119 * i) < e),
r AS (SELECT o_custkey, o_orderkey, slice_no, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, slice_no DESC) AS n
  FROM orders JOIN w ON o_orderdate BETWEEN lo AND hi)
SELECT o_custkey, o_orderkey, slice_no FROM r WHERE n = 1"""

ORACLE_SQL["key_except"] = "SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 49"

ORACLE_SQL["required_keys"] = "SELECT event_id, event_type AS key FROM events WHERE event_id % 3 = 1 AND event_type <> ''"

ORACLE_SQL["risk_membership"] = """
SELECT upper(event_type[1]) || event_type[2:] AS type, count(*) AS n FROM events WHERE lower(event_type) IN ('view', 'click') GROUP BY 1"""

ORACLE_SQL["sample_ordered"] = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5"

ORACLE_SQL["typed_guards"] = """
SELECT 'CVE-' || p_partkey AS cve_id, CASE WHEN p_partkey % 4 = 3 THEN 'fine' ELSE '' END AS descriptions, 0 AS n_references FROM part"""
