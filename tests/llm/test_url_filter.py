import random

from pyspark.sql import functions as F

from threatspark.llm import url_filter as U


def plain(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for verdict, rule in U.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    if best:
        return host, path, *best
    names = [".".join(host.split(".")[i:]) for i in range(len(host.split(".")))]
    return host, path, None, "block" if any(n in listed for n in names) else "allow"


def test_equals_plain_rules_and_list(spark):
    random.seed(3)
    hosts = ["a.org", "Sub.B.org", "bad.org", "x.bad.org", "notbad.org", "example.com", "www.example.com", "q.www.EXAMPLE.com", "z.net", "com", "net", ""]
    urls = [f"{s}{h}{p}" for s in ("http://", "HTTPS://", "") for h in hosts
            for p in ("", "/", "/en/", "/en", "/es/1?x=/fr/", "/fr/#a", "?q=://z", "#/en/", "/a?b://c", "/\u00f6 \n/x")]
    urls += [None, "://", "a://b://c/d", "no scheme", "http://" + "w" * 100_000 + ".org/"]
    pages = spark.createDataFrame([(i if i % 9 else None, u, 1, "r") for i, u in enumerate(urls)], "page_id long, url string, listed int, rule string")
    listed = spark.createDataFrame([("bad.org",), ("org.unknown",), (None,), ("bad.org",)], "key string")
    got = sorted(str(tuple(r)) for r in U.filter_urls(pages, listed).collect())
    assert got == sorted(str((i if i % 9 else None, *plain(u, {"bad.org"}))) for i, u in enumerate(urls))


def test_cascade_is_exact_over_its_universe(spark):
    for n, share in ((5000, 3), (400, 1), (300, 10_000), (1000, 2)):
        names = spark.range(n).select(F.format_string("h%d.org", "id").alias("key"), (F.col("id") % share == 0).alias("is"))
        cascade = U.build_cascade(names, names.filter("is").select("key"))
        asked = names.select("key", "is", F.array("key").alias("names"))
        assert U.block_listed(asked, cascade, "names").filter("is <> listed").count() == 0
        assert n < 1000 or len(cascade.levels) > 2


def test_shards_of_a_level(spark, monkeypatch):
    monkeypatch.setattr(U, "SHARD_WORDS", 4)  # files of 256 bits
    names = spark.range(600).select(F.format_string("h%d.org", "id").alias("key"), (F.col("id") % 3 == 0).alias("is"))
    cascade = U.build_cascade(names, names.filter("is").select("key"))
    asked = names.select("is", F.array("key").alias("names"))
    assert U.block_listed(asked, cascade, "names").filter("is <> listed").count() == 0


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = spark.createDataFrame([], "key string")
    assert U.filter_urls(pages, none).first()["verdict"] == "allow"
    assert U.filter_urls(pages.limit(0), none).count() == 0
