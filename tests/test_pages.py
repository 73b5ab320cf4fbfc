import random
import re
from html.parser import HTMLParser

from threatspark.sources.pages import enrich_exploits, page_metadata


def test_page_metadata(spark):
    html1 = ('<html><head><meta name="keywords" content="AIX, dos ,CVE-2009-3699,cve-2010-1,OSVDB-58387,'
             + "t" * 50 + '"></head><body><a class="screenshot-url big" href="/shot.png">s</a>'
             '<i class="mdi mdi-check"></i><a href="https://www.exploit-db.com/download/1">d</a>'
             '<a href="https://vendor.example/software/app.zip">Vulnerable App</a></body></html>')
    html2 = '<html><body><a href="https://x.example/downloads/x.tgz">get</a><i class="fa fa-times"></i></body></html>'
    pages = spark.createDataFrame([("1", "https://www.exploit-db.com/exploits/1", html1),
                                   ("2", "https://www.exploit-db.com/exploits/2", html2)], "id string, url string, html string")
    r = {x["id"]: x for x in page_metadata(pages).collect()}
    assert r["1"]["codes"] == ["CVE-2009-3699", "CVE-2010-1", "OSVDB-58387"]
    assert r["1"]["tags"] == ["AIX", "dos"]                         # 50-char tag dropped
    assert r["1"]["verified"] is True and r["1"]["screenshot_url"] == "/shot.png"
    assert r["1"]["application_url"] == "https://vendor.example/software/app.zip"
    assert r["2"]["verified"] is False and r["2"]["codes"] == [] and r["2"]["screenshot_url"] is None
    assert r["2"]["application_url"] == "https://x.example/downloads/x.tgz"
    assert r["1"]["source_url"] == "https://www.exploit-db.com/exploits/1"


def test_enrich_exploits_keeps_rows_without_page(spark):
    index = spark.createDataFrame([("1", "CVE-2009-3699;osvdb-58387", "1"), ("2", "cve-2020-1", "0")],
                                  "id string, codes string, verified string")
    pages = spark.createDataFrame([("1", "u", "<meta name=\"keywords\" content=\"CVE-2011-9\">")],
                                  "id string, url string, html string")
    out = {x["id"]: x for x in enrich_exploits(index, page_metadata(pages)).collect()}
    assert out["1"]["codes"] == ["CVE-2011-9"]
    assert out["2"]["codes"] == ["CVE-2020-1"] and out["2"]["verified"] is False   # Q25


def test_markup_variants(spark):
    from pyspark.sql import functions as F
    from threatspark.sources.pages import page_metadata
    pages = ["<META CONTENT=' CVE-2020-1 , R&amp;D' NAME=Keywords><I CLASS='x mdi-check'></I><a href=/d?a=1&amp;b=2><b>Vulnerable App</b></a>",
             '<meta name="description" content="CVE-1"><i class="mdi mdi-check-circle"></i><a data-href="/software" href="/ok">x</a>',
             '<a class="xscreenshot-url" href="/no"></a><a href="/yes.png" class=" screenshot-url "></a>', "", None]
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    r = page_metadata(df, url_col=None).orderBy("id").collect()
    assert r[0]["codes"] == ["CVE-2020-1"] and r[0]["tags"] == ["R&D"] and r[0]["verified"] and r[0]["application_url"] == "/d?a=1&b=2"
    assert r[1]["codes"] == [] and not r[1]["verified"] and r[1]["application_url"] is None
    assert r[2]["screenshot_url"] == "/yes.png" and r[3]["codes"] == [] and r[4]["screenshot_url"] is None


def test_steps_of_a_page_are_worked_out_once(spark):
    """a step that an expression uses again is bound, not repeated."""
    from pyspark.sql import functions as F
    from threatspark.sources import pages
    t = F.col("t")
    assert str(pages.attribute(t, "href")).count("regexp_extract_all") == 1
    assert str(pages.keywords(t)).count("regexp_extract_all") == 2      # a name, a content
    assert str(pages.application_url(t)).count("regexp_extract_all") == 2  # links, hrefs
    parts = spark.range(40).selectExpr("id", "'<meta name=keywords content=\"R&amp;D,&#65;&#x42;&#xD800;,CVE-2020-1\">' AS html")
    plan = pages.page_metadata(parts, url_col=None)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS __tokens#") == plan.count("AS __keywords#") == 1  # stay columns, not put in at each use
    r = pages.page_metadata(parts, url_col=None).first()
    assert r["tags"] == ["R&D", "AB&#xD800;"] and r["codes"] == ["CVE-2020-1"]


def test_pages_of_one_file_are_read_by_many_tasks(spark, tmp_path):
    """part is a small file; its pages' work is spread."""
    from threatspark.plans.catalog_layers import exploit_page_metadata
    spark.range(100).selectExpr("id AS p_partkey").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    q = exploit_page_metadata(spark, str(tmp_path))
    assert q.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert q.count() == 100


class Reader(HTMLParser):
    """The same facts by Python's own HTML parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs, self.links, self.icons, self.shots, self.kw, self.inside = [], [], [], [], None, False

    def handle_starttag(self, tag, attrs):
        got = {k: v or "" for k, v in attrs}  # the last of equal names
        classes = got.get("class", "").split()
        if tag == "a":
            self.links.append([got.get("href", ""), ""])
            self.inside = True
            self.shots += [got.get("href", "")] if "screenshot-url" in classes else []
        if tag == "i":
            self.icons.append(bool({"mdi-check", "fa-check"} & set(classes)))
        if tag == "meta" and got.get("name", "").lower() == "keywords" and self.kw is None:
            self.kw = got.get("content", "")

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "a"

    def handle_data(self, data):
        if self.inside and not self.cdata_elem:  # what scripts and styles hold is no text of a link
            self.links[-1][1] += data


def by_parser(html):
    r = Reader()
    r.feed(html)
    r.close()
    hrefs = [h for h, _ in r.links if h]
    app = next((h for h, t in r.links if "Vulnerable App" in t), "") or next(
        (h for h in hrefs if ("software" in h or "download" in h) and "exploit-db.com" not in h), None)
    kw = [k.strip() for k in (r.kw or "").split(",")]
    codes = [k.upper() for k in kw if re.match(r"(?i)CVE-\d{4}-\d+|OSVDB-\d+", k)]
    tags = [k for k in kw if k and len(k) < 50 and not re.match(r"(?i)CVE-\d{4}-\d+|OSVDB-\d+", k)]
    return (r.shots or [""])[0] or None, any(r.icons), app, codes, tags, hrefs


PARTS = ['<a href="/d{}">', "<a class='x screenshot-url' href='/s{}.png'>", "<A HREF=/software/{} title=don't>", '<a title="1 > 0, <b>" href="/t{}">',
         '<a href="/one{}" href="/two{}">', "</a>", "</A >", "<i class=mdi-check>", '<i title="class=fa-check">', "<I Class = 'a fa-check'/>",
         '<img alt="<a class=screenshot-url href=/img{}>">', "<!-- <a class='screenshot-url' href='/c{}'><i class=mdi-check> -->", "<!-- a > b -- c -->",
         '<script>var s = "<a href=/download/{}>Vulnerable App</a><!-- ";</script>', "<STYLE>a > b { content: '<i class=fa-check>' }</style>",
         "Vulnerable App", "Vulnerable <b>App</b>", "Vulnerable<!-- x --> App", " 1 < 2 & 3 ", "<!DOCTYPE html>", "<?php echo 1 ?>", "<br/>",
         '<meta content="CVE-2020-{}, a&amp;b, &#79;SVDB-7, &#38;lt;, x&#x20AC;" name=Keywords>', "<meta name=description content='CVE-1-1'>",
         '<a data-href="/software" href="/ok{}?a=1&amp;b=2&#x26;c">', '<a\nhref\n=\n"/lines{}"\n>', "<a>", "text {} ", "&lt;a href=/no&gt;"]


def test_equal_to_an_html_parser(spark):
    from pyspark.sql import functions as F
    from threatspark.sources.pages import all_hrefs
    rng = random.Random(7)
    pages = ["".join(p.replace("{}", str(i)) for p in rng.choices(PARTS, k=rng.randint(0, 14))) for i in range(800)]
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    got = page_metadata(df.withColumn("hrefs", all_hrefs(F.col("html"))), url_col=None).orderBy("id").collect()
    for html, r in zip(pages, got):
        assert (r["screenshot_url"], r["verified"], r["application_url"], r["codes"], r["tags"], r["hrefs"]) == by_parser(html), html


def test_long_and_open_markup(spark):
    n = 300_000
    pages = ["<a title='" + "x >" * n + "' href=/long>Vulnerable App</a>", "<!--" + "<a href=/no>" * n, "<script>" + "<i class=mdi-check>" * n,
             "<a " + "b=c " * n + "href=/many>Vulnerable App", "<" * n, "\u0000\u0001<a href='/\u0002nul'>Vulnerable App\u0003</a>"]
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    got = page_metadata(df, url_col=None).orderBy("id").collect()
    assert [r["application_url"] for r in got] == ["/long", None, None, "/many", None, "/�nul"]
    assert not any(r["verified"] for r in got)


def test_orders_are_one_row_before_they_meet_their_lines(spark, tmp_path, monkeypatch):
    """repeated orders and lines don't multiply, and index and pages are written from one stored table."""
    from threatspark import session
    from threatspark.plans import catalog, feeds
    stored = []
    whole = session.materialised
    monkeypatch.setattr(session, "materialised", lambda df, name: stored.append(whole(df, name)) or stored[-1])
    monkeypatch.setattr(feeds, "ROWS_PER_TASK", 400)
    spark.range(40).selectExpr("if(id < 38, id % 19, null) o_orderkey", "if(id % 19 = 5, '5-LOW', '1-URGENT') o_orderpriority",
                               "timestamp_ntz'1997-01-01' o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(1900).selectExpr("if(id % 20 < 19, id % 20, null) l_orderkey", "if(id % 20 = 3, null, id % 3) l_partkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = {r["id"]: r for r in catalog.exploit_index_roundtrip(spark, str(tmp_path)).collect()}
    assert sorted(map(int, rows)) == [i for i in range(19) if i != 5]
    assert rows["4"]["codes"] == "CVE-2024-000000|CVE-2024-000001|CVE-2024-000002" and rows["4"]["verified"] and rows["4"]["tags"] == "Linux|remote"
    assert rows["7"]["codes"].endswith("|OSVDB-7") and rows["3"]["codes"] == "OSVDB-3" and not rows["7"]["verified"]
    assert len(stored) == 1 and stored[0].count() == 18
