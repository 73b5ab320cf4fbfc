import datetime as dt

from threatspark.plans import silver
from threatspark.sources.feeds import NVD_CVE


def test_silver_nvd_cases(spark):
    rows = [
        {"id": "CVE-1", "lastModified": "2024-01-01T00:00:00.000Z", "published": "2023-12-31T00:00:00.000",
         "descriptions": [{"lang": "es", "value": "x"}, {"lang": "en", "value": "Bad"}],
         "weaknesses": [{"description": [{"lang": "en", "value": "CWE-79"}, {"lang": "en", "value": "CWE-80"}]},
                        {"description": []}],
         "metrics": {"cvssMetricV31": [], "cvssMetricV2": [{"cvssData": {"baseScore": 5.0}}]},
         "references": [{"url": "https://a"}]},
        {"id": "CVE-2", "lastModified": "junk", "descriptions": [{"lang": "fr", "value": "y"}]},
        {"id": None, "lastModified": "2024-01-01T00:00:00"},
    ]
    df = spark.createDataFrame(rows, f"struct<{NVD_CVE}>").select("*")
    good, bad = silver.silver_nvd(df)
    g = {r["cve_id"]: r for r in good.collect()}
    assert bad.count() == 1
    a = g["CVE-1"]
    assert a["descriptions"] == ["Bad"] and a["weaknesses"] == ["CWE-79"] and a["references"] == ["https://a"]
    assert a["metrics_cvssMetricV31"] is None and a["metrics_cvssMetricV2"][0]["cvssData"]["baseScore"] == 5.0
    assert "cvssMetricV31" not in a["metrics"]                               # empty list vanished
    assert a["last_modified"] == dt.datetime(2024, 1, 1)
    assert g["CVE-2"]["last_modified"] is None and g["CVE-2"]["descriptions"] == []


def test_silver_kev_and_exploit(spark):
    kev = spark.createDataFrame([("CVE-1", "2024-1-5", None, "2024-12-01T10:00:00.000Z"), (None, "x", None, None)],
                                "cveID string, dateAdded string, cwes array<string>, dateReleased string") \
        .selectExpr("*", "'1' as catalogVersion", "1 as count", "'v' as vendorProject", "'p' as product",
                    "'n' as vulnerabilityName", "'s' as shortDescription", "'r' as requiredAction",
                    "null as dueDate", "'Known' as knownRansomwareCampaignUse", "'' as notes")
    good, bad = silver.silver_kev(kev)
    r = good.first()
    assert r["cwes"] == [] and r["date_added"] == dt.date(2024, 1, 5) and r["title"].startswith("CISA")
    assert bad.count() == 1                                                  # Q18
    ex = spark.createDataFrame([("1", "80"), ("2", ""), ("3", "80.5"), ("", "1")], "id string, port string") \
        .selectExpr("*", "'f' file", "'d' description", "'2020-01-01' date_published", "'a' author",
                    "'t' type", "'p' platform")
    g, b = silver.silver_exploit(ex)
    assert {r["id"]: r["port"] for r in g.collect()} == {"1": 80, "2": None, "3": None}
    assert b.count() == 1 and len(g.columns) == 17


def test_silver_modules(spark):
    df = spark.createDataFrame([("a", None, ["CVE-1"], ["x"]), ("", None, None, None)],
                               "fullname string, author array<string>, references array<string>, aliases array<string>")
    g, b = silver.silver_modules(df)
    r = g.first()
    assert r["author"] == [] and r["references"] == ["CVE-1"] and "aliases" not in g.columns
    assert len(g.columns) == 26 and b.count() == 1
