import pytest
import gzip
import json

from threatspark.sources import epss as epss_src
from threatspark.sources import feeds as src


def test_kev_reader_and_since(spark, tmp_path):
    doc = {"catalogVersion": "2024.12.01", "dateReleased": "2024-12-01T10:00:00.000Z", "count": 3,
           "vulnerabilities": [
               {"cveID": "CVE-1", "vendorProject": "V", "product": "P", "dateAdded": "2024-01-05",
                "requiredAction": "Fix CWE-79 now", "cwes": ["CWE-79"]},
               {"cveID": "CVE-2", "vendorProject": "V2", "dateAdded": "2024-01-01"},
               {"cveID": "CVE-3", "vendorProject": "V3"}]}
    p = tmp_path / "kev.json"
    p.write_text(json.dumps(doc, indent=2))
    rows = src.read_kev(spark, str(p))
    assert rows.count() == 3
    r = {x["cveID"]: x for x in rows.collect()}
    assert r["CVE-1"]["catalogVersion"] == "2024.12.01" and r["CVE-3"]["count"] == 3
    since = src.read_kev(spark, str(p), since="2024-01-01")   # F1: equal and null dropped
    assert [x["cveID"] for x in since.collect()] == ["CVE-1"]


def _epss_file(path, lines):
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n")


def test_epss_snapshots(spark, tmp_path):
    d = tmp_path / "epss"
    d.mkdir()
    _epss_file(d / "a.csv.gz", ["#model_version:v2023.03.01,score_date:2024-12-09T00:00:00+0000",
                                "cve,epss,percentile", "CVE-1,0.00043,0.10", "CVE-2,,0.5", "CVE-3,abc,0.2"])
    _epss_file(d / "b.csv.gz", ["#model_version:v2023.03.01", "#score_date:2024-12-01", "",
                                "cve,epss,percentile", "CVE-4,0.5,0.9"])
    _epss_file(d / "c.csv.gz", ["cve,epss,percentile", "CVE-5,0.1,0.1"])
    raw = epss_src.read_epss(spark, str(d), run_date="2025-01-01")
    got = {r["cve"]: r["date"] for r in raw.collect()}
    assert got == {"CVE-1": "2024-12-09", "CVE-2": "2024-12-09", "CVE-3": "2024-12-09",
                   "CVE-4": "2024-12-01", "CVE-5": "2025-01-01"}
    gated = epss_src.read_epss(spark, str(d), since="2024-12-05", run_date="2025-01-01")
    assert sorted(r["cve"] for r in gated.collect()) == ["CVE-1", "CVE-2", "CVE-3", "CVE-5"]  # F4
    good, bad = epss_src.bronze_epss(raw)
    g = {r["cve"]: float(r["epss"]) for r in good.collect()}
    assert g["CVE-2"] == 0.0 and g["CVE-1"] == 0.00043                   # B3: '' -> 0
    assert [r["cve"] for r in bad.collect()] == ["CVE-3"]                 # Q17: quarantine


def test_nvd_pages(spark, tmp_path):
    item = lambda i, **kw: {"cve": {"id": i, "lastModified": kw.get("lm", "2024-01-01T00:00:00.000"), **kw.get("x", {})}}
    p1 = {"totalResults": 3, "vulnerabilities": [
        item("CVE-1", x={"descriptions": [{"lang": "en", "value": "Bad"}, {"lang": "es", "value": "Malo"}],
                         "metrics": {"cvssMetricV31": [{"cvssData": {"baseScore": 9.8}}], "cvssMetricV2": []},
                         "configurations": [{"nodes": []}]}),
        item("CVE-2", lm="2024-02-01T00:00:00.000Z"), {"other": 1}]}
    p2 = {"totalResults": 3, "vulnerabilities": [item("CVE-2", lm="junk")]}
    (tmp_path / "p1.json").write_text(json.dumps(p1))
    (tmp_path / "p2.json").write_text(json.dumps(p2))
    items = src.read_nvd_pages(spark, str(tmp_path))
    b = src.bronze_nvd(items)
    assert b.count() == 3                                                 # item without cve dropped
    assert len(b.columns) == 11
    one = b.filter("id = 'CVE-1'").first()
    assert one["metrics"]["cvssMetricV31"][0]["cvssData"]["baseScore"] == 9.8
    assert '"nodes"' in one["configurations"]                              # opaque JSON kept as text
    ranged = src.bronze_nvd(items, "2024-01-15T00:00:00", "2024-03-01T00:00:00")
    assert [r["id"] for r in ranged.collect()] == ["CVE-2"]


def test_exploit_index_and_modules(spark, tmp_path):
    csv = tmp_path / "files_exploits.csv"
    csv.write_text('id,file,description,date_published,author,type,platform,port,date_added,date_updated,'
                   'verified,codes,tags,aliases,screenshot_url,application_url,source_url\n'
                   '1,a.txt,"multi\nline",2020-01-01,x,remote,linux,80,2020-01-01,,1,CVE-2009-3699;OSVDB-58387,,,,,\n'
                   '2,b.txt,d,2019-01-01,x,local,aix,,2019-01-01,2021-06-01,0,,,,,,\n'
                   '3,c.txt,d,,x,dos,aix,,,,0,,,,,,\n')
    idx = src.read_exploit_index(spark, str(csv))
    assert idx.count() == 3 and idx.filter("id = '1'").first()["description"] == "multi\nline"
    inc = src.read_exploit_index(spark, str(csv), since="2020-06-01")    # F2: updated wins, null kept
    assert sorted(r["id"] for r in inc.collect()) == ["2", "3"]
    mods = {"exploit/a": {"name": "a", "type": "exploit", "mod_time": "2020-01-01 00:00:00 +0000",
                          "references": ["CVE-2020-1", "URL-x"], "targets": ["Auto"], "rank": 600},
            "exploit/b": {"name": "b", "type": "exploit", "references": None, "notes": {"k": [1]}}}
    mp = tmp_path / "modules.json"
    mp.write_text(json.dumps(mods))
    m = src.bronze_modules(src.read_modules(spark, str(mp)))
    assert m.count() == 2 and len(m.columns) == 27
    assert src.read_modules(spark, str(mp), since="2021-01-01").count() == 1   # F3: null kept


def test_scanner_csv_row_order_across_files(spark, tmp_path):
    # the largest file sorts last by name, so Spark's size-ordered split packing
    # reads it first; row ids must still follow (file name, line)
    d = tmp_path / "upload"
    d.mkdir()
    rows = {"a.csv": 2, "b.csv": 3, "c.csv": 40}
    for name, n in rows.items():
        lines = ["Plugin ID,Host,Description"]
        for i in range(n):
            lines.append(f'{i},h-{name}-{i},"line one\nline two {i}"')
        (d / name).write_text("\n".join(lines) + "\n")
    df = src.read_scanner_csv(spark, str(d))
    got = [r["Host"] for r in df.orderBy("row_id").collect()]
    want = [f"h-{name}-{i}" for name, n in rows.items() for i in range(n)]
    assert got == want
    assert df.select("row_id").distinct().count() == sum(rows.values())
    assert df.columns == ["Plugin ID", "Host", "Description", "row_id"]
    one = src.read_scanner_csv(spark, str(d / "c.csv"))
    assert [r["Host"] for r in one.orderBy("row_id").collect()] == [f"h-c.csv-{i}" for i in range(40)]


def test_epss_files_named_by_day_are_not_opened(spark, tmp_path):
    """F4 by file name: old snapshots are pruned before the scan."""
    import gzip
    from threatspark.sources.epss import read_epss
    for day in range(1, 11):
        with gzip.open(tmp_path / f"epss_scores-2024-01-{day:02d}.csv.gz", "wt") as f:
            f.write(f"#model_version:v1,score_date:2024-01-{day:02d}T00:00:00+0000\ncve,epss,percentile\nCVE-{day},0.{day},0.5\n")
    (tmp_path / "epss_scores-2023-12-31.csv.gz").write_bytes(b"not gzip at all")  # would fail if it were opened
    rows = read_epss(spark, str(tmp_path), since="2024-01-08", trust_names=True).collect()
    assert sorted(r["date"] for r in rows) == ["2024-01-09", "2024-01-10"]


def test_epss_metadata_decides_and_rows_without_a_cve_are_rejected_later(spark, tmp_path):
    import gzip
    from threatspark.sources.epss import bronze_epss, read_epss
    with gzip.open(tmp_path / "epss_scores-2024-01-01.csv.gz", "wt") as f:  # corrected later under its old name
        f.write("#model_version:v1,score_date:2024-02-01T00:00:00+0000\ncve,epss,percentile\nCVE-1,0.1,0.5\n,0.2,0.5\n")
    raw = read_epss(spark, str(tmp_path), since="2024-01-08")
    assert {r["date"] for r in raw.collect()} == {"2024-02-01"}
    good, bad = bronze_epss(raw)
    assert [r["cve"] for r in good.collect()] == ["CVE-1"] and [(r["cve"], r["reason"]) for r in bad.collect()] == [(None, "missing_cve")]


@pytest.mark.parametrize("size", [7, 40, 333, 5000])
def test_multi_line_csv_in_byte_ranges(spark, tmp_path, size):
    """Any range size gives the rows and ids of the reader that takes whole files."""
    import csv
    import random
    random.seed(size)
    for name, end in (("b.csv", "\n"), ("a.csv", "\r\n")):
        with open(tmp_path / name, "w", newline="") as f:
            w = csv.writer(f, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
            w.writerow(["Plugin ID", "Host, name", "Notes"])
            for i in range(60):
                note = "".join(random.choice(["a", "b,", "\n", "\n\n", '"', '""', "ü", " ", "NA"]) for _ in range(random.randint(0, 12)))
                w.writerow([i, f"h{i}" if i % 7 else "", random.choice([note, "N/A", "", "plain"])])
                if i % 9 == 0:
                    f.write(end)  # a blank line between records
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    whole = src.read_scanner_csv(spark, str(tmp_path))
    want = sorted(map(tuple, whole.collect()), key=lambda r: r[-1])
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        split = src.read_scanner_csv(spark, str(tmp_path), range_bytes=1)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 1
        assert split.columns == whole.columns and sorted(map(tuple, split.collect()), key=lambda r: r[-1]) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(want) == 120 and any("\n" in (r[2] or "") for r in want)


@pytest.mark.parametrize("size, indent", [(9, None), (64, 2), (700, None)])
def test_module_map_in_byte_ranges(spark, tmp_path, size, indent):
    """Any range size gives the modules of the reader that takes a whole object: braces
    and quotes in strings, escapes, nested objects, keys in any script."""
    import random
    random.seed(size)
    odd = ['a}b', '{"', '\\', '\\"}', "}}{{", 'ü"東', "plain", "\n\t", ""]
    for f in range(2):
        modules = {f"exploit/{f}/{random.choice(odd)}{i}": {
            "name": random.choice(odd) + random.choice(odd), "rank": i, "mod_time": None if i % 5 == 0 else f"2024-01-{i % 28 + 1:02d} 00:00:00 +0000",
            "description": "".join(random.choice(odd) for _ in range(random.randint(0, 8))), "notes": {"x": {"y": [random.choice(odd), {}]}},
            "references": [f"CVE-{i}", random.choice(odd)]} for i in range(40)}
        (tmp_path / f"m{f}.json").write_text(json.dumps(modules, indent=indent, ensure_ascii=f == 0))
    (tmp_path / "m3.json").write_text("{}\n")
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    rows = lambda df: sorted((tuple(map(str, r)) for r in df.collect()))
    want = rows(src.read_modules(spark, str(tmp_path)))
    since = rows(src.read_modules(spark, str(tmp_path), since="2024-01-10 00:00:00 +0000"))
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert rows(src.read_modules(spark, str(tmp_path), ranges=True)) == want and len(want) == 80
        assert rows(src.read_modules(spark, str(tmp_path), since="2024-01-10 00:00:00 +0000", ranges=True)) == since
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("size, indent", [(9, None), (90, 2), (900, None)])
def test_kev_catalogue_in_byte_ranges(spark, tmp_path, size, indent):
    """Any range size gives the entries of the reader that takes a whole document, with
    the catalogue's fields before or after them and other objects and arrays around."""
    import random
    random.seed(size)
    odd = ['a}b', '{"', '\\', '\\"}', "}}{{", '],"vulnerabilities": [', 'ü"東', "plain", "\n\t", "", '"count": 7,']
    for f in range(4):
        entries = [{"cveID": f"CVE-{f}-{i}", "vendorProject": random.choice(odd) + random.choice(odd), "dateAdded": None if i % 5 == 0 else f"2024-01-{i % 28 + 1:02d}",
                    "notes": "".join(random.choice(odd) for _ in range(random.randint(0, 8))), "cwes": [f"CWE-{i}"] if i % 3 else [],
                    "extra": {"deep": [{"x": random.choice(odd)}]}} for i in range([0, 1, 30, 30][f])]
        fields = {"catalogVersion": f"v{f}", "dateReleased": "2024" + random.choice(odd), "count": len(entries)}
        around = {"meta": {"tags": ["a", {"b": 1}]}, "others": [{"cveID": "no"}, {"cveID": "never"}]}
        doc = [fields | {"vulnerabilities": entries}, {"vulnerabilities": entries} | fields, around | fields | {"vulnerabilities": entries},
               {"count": len(entries), "vulnerabilities": entries} | around | {"catalogVersion": "late"}][f]
        (tmp_path / f"k{f}.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=f % 2 == 0))
    (tmp_path / "k9.json").write_text("{}\n")
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    rows = lambda df: sorted((tuple(map(str, r)) for r in df.collect()))
    want = rows(src.read_kev(spark, str(tmp_path)))
    since = rows(src.read_kev(spark, str(tmp_path), since="2024-01-10"))
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = src.read_kev(spark, str(tmp_path), ranges=True)
        assert got.dtypes == src.read_kev(spark, str(tmp_path)).dtypes
        assert rows(got) == want and len(want) == 61
        assert rows(src.read_kev(spark, str(tmp_path), since="2024-01-10", ranges=True)) == since
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
