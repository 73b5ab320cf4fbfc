from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from threatspark.plans import fact


def _sources(spark):
    nvd = spark.createDataFrame(
        [("CVE-2023-9999", ["CWE-123"], ["https://x.example/a"], [(("3.1", 9.8),)]),
         ("CVE-2023-8888", [], [], [(("3.1", 5.0),)]),
         ("CVE-2023-7777", None, None, None),
         ("", None, None, None)],
        "cve_id string, weaknesses array<string>, references array<string>, "
        "metrics_cvssMetricV31 array<struct<cvssData:struct<version:string,baseScore:double>>>")
    kev = spark.createDataFrame([("CVE-2023-9999", "Patch", "Known", "MockServer", "MockCorp", [])],
                                "cve_id string, required_action string, known_ransomware_campaign_use string, "
                                "product string, vendor_project string, cwes array<string>")
    epss = spark.createDataFrame([("CVE-2023-9999", Decimal("0.95000"), Decimal("0.99000")),
                                  ("CVE-2023-7777", Decimal("0.00000"), Decimal("0.10000"))],
                                 "cve string, epss decimal(7,5), percentile decimal(7,5)")
    ex = spark.createDataFrame([("1", "2020-01-01", ["CVE-2023-7777"], "u1", "remote", "linux"),
                                ("2", "2021-01-01", ["CVE-2023-7777"], "u2", "local", "windows"),
                                ("3", "2022-01-01", None, "u3", "x", "y")],
                               "id string, date_published string, codes array<string>, source_url string, "
                               "type string, platform string")
    mods = spark.createDataFrame([("exploit/a", "2020-01-01 00:00:00 +0000", ["CVE-2023-8888", "cve-2023-9999", "URL-x"],
                                   "mod_a", "exploit", "linux")],
                                 "fullname string, mod_time string, references array<string>, name string, "
                                 "type string, platform string")
    return nvd, kev, epss, fact.exploit_lookup(ex), fact.module_lookup(mods)


def test_mock_gold_scores(spark):
    f = fact.build_fact(*_sources(spark))
    got = {r["cve_id"]: r["vrr_score"] for r in f.collect()}
    # the empty id is not scored
    assert set(got) == {"CVE-2023-9999", "CVE-2023-8888", "CVE-2023-7777"}
    assert got["CVE-2023-9999"] == 44.40      # 30 + 9.5 + 4.9
    assert got["CVE-2023-8888"] == 12.50      # 2.5 + Metasploit 10 (exact 'CVE-' prefix)
    assert got["CVE-2023-7777"] == 10.0       # ExploitDB only, EPSS 0


def test_golden_readme_example(spark):
    nvd = spark.createDataFrame([("CVE-1", [(("3.1", 9.8),)])],
                                "cve_id string, metrics_cvssMetricV31 array<struct<cvssData:struct<version:string,baseScore:double>>>")
    kev = spark.createDataFrame([("CVE-1",)], "cve_id string")
    epss = spark.createDataFrame([("CVE-1", Decimal("0.93600"))], "cve string, epss decimal(7,5)")
    empty_x = spark.createDataFrame([], "code string, id string, source_url string")
    empty_m = spark.createDataFrame([], "ref string, fullname string, name string")
    f = fact.build_fact(nvd, kev, epss, empty_x, empty_m)
    assert f.first()["vrr_score"] == 44.26


def test_threats_truthiness_and_keys(spark):
    f = fact.build_fact(*_sources(spark))
    t = {r["cve_id"]: r["threats"].asDict() for r in f.select("cve_id", "threats").collect()}
    a = t["CVE-2023-9999"]
    assert a["CISA_vendor_project"] == "MockCorp" and a["CISA_cwe"] is None  # [] is falsy
    assert a["NVD_weaknesses"] == ["CWE-123"] and a["EPSS_epss_value"] == Decimal("0.95000")
    assert t["CVE-2023-7777"]["EPSS_epss_value"] is None                   # Q24
    assert t["CVE-2023-7777"]["ExploitDB_exploit_id"] == "u2"              # newest exploit wins
    assert t["CVE-2023-8888"]["Metasploit_module_name"] == "mod_a"
    assert len(a) == 15


def test_dims(spark):
    assert fact.dim_threats(spark).count() == 15
    v = fact.dim_vrr(spark)
    assert v.count() == 5
    assert sorted(r["weight"] for r in v.collect()) == [0.5, 10.0, 10.0, 10.0, 30.0]


def test_validate_rules(spark):
    nvd, kev, epss, _, _ = _sources(spark)
    tables = {"CISA": kev, "NVD": nvd, "EPSS": epss,
              "ExploitDB": spark.createDataFrame([("u", "t", "p")], "source_url string, type string, platform string"),
              "Metasploit": spark.createDataFrame([("n", "t", "p", ["r"])],
                                                  "name string, type string, platform string, references array<string>")}
    rows = {(r["source"], r["field"]): r["n_rows"] for r in fact.validate_rules(tables).collect()}
    assert rows[("NVD", "metrics_cvssMetricV40")] == 0
    with pytest.raises(ValueError, match="metrics_cvssMetricV40"):
        fact.assert_rules_valid(tables)


def test_breakdown(spark):
    nvd, kev, epss, x, m = _sources(spark)
    j, shape = fact.joined_sources(nvd, kev, epss, x, m)
    from threatspark.plans.rules import score_addend, score_rules
    add = j.select("cve_id", *[score_addend(r, shape).alias(r.name) for r in score_rules()])
    b = {r["name"]: (r["n_cves"], r["total_points"]) for r in fact.score_breakdown(add, fact.dim_vrr(spark)).collect()}
    assert b["CISA_KEY"] == (1, 30.0) and b["EXPLOIT_DB"] == (1, 10.0)
    assert b["NVD_CVSS_3"] == (2, 7.4)
