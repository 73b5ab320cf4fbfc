import datetime as dt

import pytest
from pyspark.sql import functions as F

from threatspark.operators import merge
from threatspark.plans import layers

RUNS = [dt.datetime(2024, 1, d) for d in range(1, 9)]
EXPLOIT = "id string, date_published string, codes array<string>, type string, source_url string"
MODULE = "fullname string, mod_time string, references array<string>, name string"


@pytest.fixture
def lake(spark, tmp_path):
    root = str(tmp_path / "lake")

    def load(name, rows, schema):
        merge.upsert_bucketed(spark, f"{root}/gold/{name}", spark.createDataFrame(rows, schema), layers._STAR[name][1], buckets=8)

    return root, load


def fact(spark, root):
    return {r["cve_id"]: r for r in merge.read_current(spark, root + "/star/fct_final").collect()}


def same_as_rebuilt(spark, root):
    built = {r["cve_id"]: (r["vrr_score"], r["threats"]) for r in layers.fact_of_gold(layers.gold_tables(spark, root), RUNS[0]).collect()}
    assert {k: (r["vrr_score"], r["threats"]) for k, r in fact(spark, root).items()} == built


def test_refresh_follows_every_kind_of_change(spark, lake):
    root, load = lake
    load("nvd", [(f"CVE-{i}",) for i in range(60)], "cve_id string")
    load("cisa", [("CVE-1", "Known"), ("CVE-2", "Unknown")], "cve_id string, known_ransomware_campaign_use string")
    load("epss", [("CVE-1", 0.5), ("CVE-3", 0.1)], "cve string, epss double")
    load("exploit", [("1", "2024-01-01", ["CVE-1", "CVE-2"], "local", "u1"), ("2", "2024-01-02", ["CVE-1"], "remote", "u2"), ("3", "2020-01-01", None, "x", "u3")], EXPLOIT)
    load("metasploit", [("m/a", "2024-01-01", ["CVE-1", "OSVDB-1"], "a"), ("m/b", "2024-01-02", ["CVE-1", "CVE-5"], "b")], MODULE)
    assert layers.refresh_star(spark, root, RUNS[0]) is None               # nothing to go on from
    url = lambda k: fact(spark, root)[k]["threats"]["ExploitDB_exploit_id"]
    name = lambda k: fact(spark, root)[k]["threats"]["Metasploit_module_name"]
    assert url("CVE-1") == "u2" and name("CVE-1") == "b"
    assert layers.refresh_star(spark, root, RUNS[1]) == 0                  # no change, nothing worked out

    before = merge.current_commit(spark, root + "/star/fct_final")
    load("exploit", [("2", "2024-01-02", ["CVE-7"], "remote", "u2")], EXPLOIT)   # the winner of CVE-1 names another CVE
    assert layers.refresh_star(spark, root, RUNS[2]) == 2
    assert url("CVE-1") == "u1" and url("CVE-7") == "u2"                   # the next best wins
    after = merge.current_commit(spark, root + "/star/fct_final")
    assert sum(before.parts.get(b) != g for b, g in after.parts.items()) <= 2
    rows = fact(spark, root)
    assert {k for k, r in rows.items() if r["date_added"] == RUNS[2]} == {"CVE-1", "CVE-7"}
    same_as_rebuilt(spark, root)

    load("metasploit", [("m/b", "2023-01-01", ["CVE-5"], "b2"), ("m/c", "2024-05-05", ["CVE-9", None], "c")], MODULE)
    load("exploit", [("1", "2024-01-01", [], "local", "u1")], EXPLOIT)
    load("nvd", [("CVE-100",)], "cve_id string")
    load("epss", [("CVE-3", 0.9), ("CVE-777", 0.9)], "cve string, epss double")  # the last isn't an NVD entry
    assert layers.refresh_star(spark, root, RUNS[3]) == 6                  # 1, 2, 3, 5, 9, 100
    assert name("CVE-1") == "a" and url("CVE-1") is None and name("CVE-9") == "c" and "CVE-777" not in fact(spark, root)
    same_as_rebuilt(spark, root)


@pytest.mark.parametrize("after_fact", [False, True])
def test_refresh_after_a_failure_between_its_tables(spark, lake, monkeypatch, after_fact):
    """The held CVEs fail before or after the fact is committed: the next refresh goes back to what they have seen."""
    root, load = lake
    load("nvd", [("CVE-1",), ("CVE-2",)], "cve_id string")
    load("exploit", [("1", "2024-01-01", ["CVE-1"], "local", "u1")], EXPLOIT)
    layers.refresh_star(spark, root, RUNS[0])
    load("exploit", [("1", "2024-01-01", ["CVE-2"], "local", "u1")], EXPLOIT)
    real = layers.upsert_bucketed

    def failing(spark_, path, *args, **kw):
        if "held_" in path and ("seen" in kw) == after_fact:
            raise OSError("lost")
        return real(spark_, path, *args, **kw)

    monkeypatch.setattr(layers, "upsert_bucketed", failing)
    with pytest.raises(OSError):
        layers.refresh_star(spark, root, RUNS[1])
    monkeypatch.setattr(layers, "upsert_bucketed", real)
    load("exploit", [("1", "2024-01-01", [], "local", "u1")], EXPLOIT)
    assert layers.refresh_star(spark, root, RUNS[2]) == (2 if after_fact else 1)   # all that a committed fact ever had
    same_as_rebuilt(spark, root)


def test_refresh_builds_anew_when_columns_or_rules_change_or_too_far_behind(spark, lake, monkeypatch):
    root, load = lake
    load("nvd", [("CVE-1",)], "cve_id string")
    layers.refresh_star(spark, root, RUNS[0])
    load("cisa", [("CVE-1", "Known")], "cve_id string, known_ransomware_campaign_use string")
    assert layers.refresh_star(spark, root, RUNS[1]) is None               # a table that wasn't there
    load("nvd", [("CVE-2", "text")], "cve_id string, vuln_status string")
    assert layers.refresh_star(spark, root, RUNS[2]) is None               # a new column
    monkeypatch.setattr(merge, "KEEP_CHANGES", 1)
    for i in range(3):
        load("nvd", [(f"CVE-{i}", "new")], "cve_id string, vuln_status string")
    assert layers.refresh_star(spark, root, RUNS[3]) is None
    same_as_rebuilt(spark, root)
    monkeypatch.setattr(layers.fact_mod, "rules_text", lambda: "others")
    assert layers.refresh_star(spark, root, RUNS[4]) is None


def test_gold_follows_commits_not_times(spark, tmp_path):
    root, sources = str(tmp_path / "lake"), {}
    spec = layers.SourceSpec("p", lambda s, p, since: s.read.parquet(p), lambda d: d, "id", "seen", "1970-01-01",
                             lambda b: (b, b.limit(0)), "id", ("seen", "seen"), gold_manual={"origin": "x"})
    sources["p"] = spec
    gold = lambda: {r["id"]: (r["price"], r["origin"]) for r in merge.read_current(spark, root + "/gold/p").collect()}

    def deliver(n, rows, ts):
        spark.createDataFrame(rows, "id string, price int, seen string").write.parquet(str(tmp_path / f"l{n}"))
        status = layers.run_layers(spark, root, {"p": str(tmp_path / f"l{n}")}, run_ts=ts, registry=sources)
        return {r["layer"]: (r["status"], r["rows"]) for r in status.collect()}

    deliver(1, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-01")], RUNS[5])
    assert deliver(2, [("a", 2, "2024-01-02")], RUNS[5])["gold"] == ("ok", 1) and gold() == {"a": (2, "x"), "b": (1, "x")}   # equal time
    assert deliver(3, [("b", 3, "2024-01-03")], RUNS[0])["gold"] == ("ok", 1) and gold() == {"a": (2, "x"), "b": (3, "x")}   # an earlier one
    assert layers.run_layers(spark, root, {}, layer="gold", registry=sources).first()["rows"] == 0
    spec.gold_manual["origin"] = "y"                                       # another constant: all rows anew
    assert layers.run_layers(spark, root, {}, layer="gold", registry=sources).first()["rows"] == 2 and gold() == {"a": (2, "y"), "b": (3, "y")}


def test_the_query_works_each_feed_out_once(spark, monkeypatch):
    from threatspark.plans import catalog_layers, feeds
    worked = spark.sparkContext.accumulator(0)
    delivered = []

    @F.udf("boolean")
    def counted(_):
        worked.add(1)
        return True

    rows = {"feed_nvd": ["concat('CVE-', id) cve_id"], "feed_kev": ["concat('CVE-', id) cve_id", "'Unknown' known_ransomware_campaign_use"],
            "feed_epss": ["concat('CVE-', id) cve", "cast(0.5 as decimal(7,5)) epss"],
            "feed_exploit": ["cast(id as string) id", "'2024-01-01' date_published", "array(concat('CVE-', id)) codes"],
            "feed_modules": ["concat('m', id) fullname", "'2024-01-01' mod_time"], "feed_module_refs": ["concat('m', id) fullname", "concat('CVE-', id) ref"]}
    for name, columns in rows.items():
        df = spark.range(20).selectExpr(*columns)
        df = df.filter(counted(df.columns[-1])) if name != "feed_module_refs" else df
        monkeypatch.setattr(feeds, name, lambda s, sf, df=df: df)
    monkeypatch.setattr(catalog_layers, "upsert_bucketed", lambda s, path, df, key: delivered.append(df.count()))
    monkeypatch.setattr(layers, "refresh_star", lambda *args: None)
    monkeypatch.setattr(catalog_layers, "read_current", lambda *args: spark.createDataFrame([], "cve_id string, vrr_score double"))
    catalog_layers.fact_incremental(spark, "unused")
    # nvd in halves; the others wrong, then in halves
    assert sum(delivered) == 20 + 4 * 40 and worked.value == 5 * 20


def test_changed_rows_are_found_once_for_names_and_for_what_is_held(spark, lake, monkeypatch):
    """F2 of round 4: the held rows of a source are joined to its changed keys once in a refresh, before their arrays are exploded."""
    root, load = lake
    load("nvd", [(f"CVE-{i}",) for i in range(20)], "cve_id string")
    load("exploit", [("1", "2024-01-01", ["CVE-1", "CVE-2"], "local", "u1"), ("2", "2024-01-02", ["CVE-1"], "remote", "u2"), (None, "2024-01-03", ["CVE-4"], "x", "u0")], EXPLOIT)
    load("metasploit", [("m/a", "2024-01-01", ["CVE-1", "OSVDB-1"], "a")], MODULE)
    layers.refresh_star(spark, root, RUNS[0])
    load("exploit", [("2", "2024-01-02", ["CVE-7", None, ""], "remote", "u2"), ("5", "2024-01-04", ["CVE-8"], "x", "u5")], EXPLOIT)
    load("metasploit", [("m/a", "2024-01-01", ["CVE-3"], "a")], MODULE)
    read = []
    current = layers.read_current
    monkeypatch.setattr(layers, "read_current", lambda s, path: read.append(path.rsplit("/", 1)[1]) or current(s, path))
    assert layers.refresh_star(spark, root, RUNS[1]) == 4                  # 1, 3, 7, 8
    assert read.count("held_exploit") == read.count("held_metasploit") == 1
    same_as_rebuilt(spark, root)
    held = {r["id"]: r["codes"] for r in current(spark, root + "/star/held_exploit").collect()}
    assert held == {"1": ["CVE-1", "CVE-2"], "2": ["CVE-7", None, ""], None: ["CVE-4"], "5": ["CVE-8"]}
    assert [r["references"] for r in current(spark, root + "/star/held_metasploit").collect()] == [["CVE-3"]]
    assert layers.refresh_star(spark, root, RUNS[2]) == 0
