import csv
import datetime as dt
import io
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from threatspark.operators.merge import read_current
from threatspark.plans import fact, findings, layers

HEADER = ["Plugin ID", "CVE", "CVSS", "Risk", "Host", "Protocol", "Port", "Name", "Synopsis",
          "Description", "Solution", "See Also", ""]
ROWS = [
    ("95631", "CVE-2004-2761", "None"), ("10882", "CVE-1999-0001", "Medium"),
    ("10882", "CVE-1999-0002", "Medium"), ("10882", "CVE-1999-0003", "Medium"),
    ("65821", "CVE-2013-2566, cve-2015-2808", "Medium"), ("65821", "CVE-2013-2566", "High"),
    ("20007", "CVE-2016-2183", "High"), ("20008", "CVE-2016-2183", "High"),
    ("20009", "CVE-2017-0144", "Critical"), ("20010", "CVE-2018-0001", "Low"),
    ("20011", "CVE-2019-0002", "Low"), ("20012", "CVE-2020-0003 , CVE-9999-0001", "Low"),
] + [(str(30000 + i), "", "None") for i in range(6)]
HOSTS = ["10.10.1.21", "10.10.1.22", "10.10.1.22", "10.10.1.22", "10.10.1.23", "10.10.1.23",
         "10.10.1.21", "10.10.1.21", "10.10.1.24", "10.10.1.24", "10.10.1.24", "10.10.1.25"] + ["10.10.1.26"] * 6


def write_scan(path):
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(HEADER)
    for (plugin, cves, risk), host in zip(ROWS, HOSTS):
        w.writerow([plugin, cves, "", risk, host, "tcp", "443", f"Plugin {plugin}", "Short.",
                    f"Long text\nsecond line for {plugin}", "Patch.", "https://a\nhttps://b", ""])
    path.write_text(buf.getvalue())


def make_fact(spark):
    known = ["CVE-2004-2761", "CVE-1999-0001", "CVE-1999-0002", "CVE-1999-0003", "CVE-2013-2566",
             "CVE-2015-2808", "CVE-2016-2183", "CVE-2017-0144", "CVE-2018-0001", "CVE-2019-0002", "CVE-2020-0003"]
    nvd = spark.createDataFrame([(c, [f"CWE-{i}"] if i % 2 else [], [(("3.1", 5.0 + i * 0.1),)])
                                 for i, c in enumerate(known)],
                                "cve_id string, weaknesses array<string>, "
                                "metrics_cvssMetricV31 array<struct<cvssData:struct<version:string,baseScore:double>>>")
    kev = spark.createDataFrame([("CVE-2013-2566", "Fix CWE-327 usage", "Unknown", "RC4", "Vendor")],
                                "cve_id string, required_action string, known_ransomware_campaign_use string, "
                                "product string, vendor_project string")
    epss = spark.createDataFrame([("CVE-2013-2566", Decimal("0.5"), Decimal("0.9")),
                                  ("CVE-2015-2808", Decimal("0.25"), Decimal("0.8"))],
                                 "cve string, epss decimal(7,5), percentile decimal(7,5)")
    ex = spark.createDataFrame([], "code string, id string, source_url string, type string, platform string")
    mo = spark.createDataFrame([], "ref string, fullname string, name string, type string, platform string")
    return fact.build_fact(nvd, kev, epss, ex, mo)


def test_scanner_report_and_merge(spark, tmp_path):
    p = tmp_path / "scan.csv"
    write_scan(p)
    f = make_fact(spark)
    root = str(tmp_path / "lake")
    rep = layers.process_scanner_csv(spark, str(p), f, root, run_ts=dt.datetime(2024, 6, 1),
                                     export_dir=str(tmp_path / "out"))
    rows = rep.orderBy("row_id").collect()
    assert len(rows) == 18
    assert rep.columns[:7] == ["row_id", "vrr_score", "vulnerabilities", "weaknesses", "IPAddress",
                               "VulnerabilityName", "ScannerReportedSeverity"]
    assert sum(1 for r in rows if r["ScannerReportedSeverity"] is None) == 7      # Q14
    r5 = rows[4]
    assert r5["vulnerabilities"] == ["CVE-2013-2566", "CVE-2015-2808"]
    assert r5["vrr_score"] == max(x["vrr_score"] for x in f.filter(F.col("cve_id").isin(r5["vulnerabilities"])).collect())
    assert r5["threats"]["EPSS_epss_value"] == ["0.25", "0.5"]                   # G7 union, sorted
    assert "CWE-327" in " ".join(r5["weaknesses"])                               # G6: any value with CWE-
    r12 = rows[11]
    assert r12["vulnerabilities"] == ["CVE-2020-0003"]                           # unknown CVE skipped
    assert rows[12]["vrr_score"] == 0.0 and rows[12]["vulnerabilities"] == []
    assert rows[0]["Description"] == "Long text\nsecond line for 95631 Short." and rows[0]["PluginOutput"] == ""
    merged = read_current(spark, root + "/gold/vrr_risk_report")
    assert merged.count() == 15                                                  # Q11
    root_b = str(tmp_path / "lake_b")
    layers.process_scanner_csv(spark, str(p), f, root_b, run_ts=dt.datetime(2024, 6, 1), buckets=4)
    from threatspark.operators.merge import read_bucketed
    mb = read_bucketed(spark, root_b + "/gold/vrr_risk_report")
    assert mb.count() == 15 and mb.select("HostFindingsID").distinct().count() == 15
    from threatspark.sources.feeds import read_scanner_csv
    cov = findings.intel_coverage(read_scanner_csv(spark, str(p)), f).first()
    assert (cov["n_report_cves"], cov["n_matched_cves"]) == (12, 11)


def test_generic_layout_and_dispatch(spark, tmp_path):
    p = tmp_path / "generic.csv"
    p.write_text("HostFindingsID,Host / IP,Risk.Level\nabc,10.0.0.1,High\n")
    from threatspark.sources.feeds import read_scanner_csv
    raw = read_scanner_csv(spark, str(p))
    assert findings.detect_layout(raw.drop("row_id")) == "generic"
    assert findings.clean_headers(raw, generic=True).columns[:3] == ["HostFindingsID", "Host_IP", "RiskLevel"]
    bad = spark.createDataFrame([("x",)], "Host string")
    with pytest.raises(ValueError):
        findings.detect_layout(bad)


def test_enrich_simple(spark):
    f = make_fact(spark)
    df = spark.createDataFrame([(1, "CVE-2013-2566"), (2, "cve-2013-2566"), (3, None)], "n int, `CVE ID` string")
    out = {r["n"]: r for r in findings.enrich_simple(df, f, "CVE").collect()}
    assert out[1]["vrr_score"] > 30 and out[1]["threat_intel"].startswith("CISA_required_action: Fix CWE-327")
    assert "EPSS_epss_value: 0.5" in out[1]["threat_intel"]
    assert out[2]["vrr_score"] == 0.0 and out[2]["threat_intel"] == ""          # Q23: exact match only
    assert findings.find_cve_column(df) == "CVE ID"
