"""Exploit page HTML -> metadata columns, joined to the index.

Native columns over a table of landed pages, no per-row Python. One regular
expression whose alternatives are the kinds of token (comment, declaration,
script or style with its content, tag) goes through a page once, so what looks
like a tag inside a comment, a script or an attribute's value is none. The
tokens are then split, filtered and transformed with higher-order functions.
All repetitions are possessive or of one character class: Java runs those in a
loop, so very long tags and comments don't exhaust its stack. What an
expression uses more than once is bound (``_let``): Spark works a repeated
expression inside a lambda out at each place, and such places multiply.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threatspark.functions.strings import strip

# Fixed values that must equal the reference's for right results.
CODE_PATTERN = r"(?i)^(CVE-\d{4}-\d+|OSVDB-\d+)"
MAX_TAG_LEN = 50
VERIFIED_CLASSES = ["mdi-check", "fa-check"]
APP_LINK_TEXT = "Vulnerable App"
APP_HREF_WORDS = ["software", "download"]
OWN_DOMAIN = "exploit-db.com"

# The named character references that occur in attributes and link texts.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "amp": "&"}

# Elements whose content is text up to their end tag.
RAW_TEXT = ["script", "style", "textarea", "title"]

# Marks that stand in no page, as they are replaced first: before a token, after it; before a link, after its href, at its end.
_OPEN, _SHUT, _LINK, _HREF, _END = "\u0001", "\u0000", "\u0002", "\u0003", "\u0004"

# The inside of a tag: quotes count only after an equals sign.
_INSIDE = r"""(?:[^=>]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+"""
_TOKEN = (rf"(?is)(<({'|'.join(RAW_TEXT)})(?=[\s/>]){_INSIDE}>).*?(?:(?=</\2[\s/>])|\z)"
          rf"|(</?[a-z]{_INSIDE}>)|<!--.*?(?:-->|\z)|<[!?/][^>]*+>")
_ATTRIBUTE = r"""([^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)"""


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _nz(c: Column) -> Column:
    return _let(c, lambda v: F.when(v != "", v))


def _numbered(name: Column) -> Column:
    """The character of a reference by number ('#65', '#x41')."""
    number = F.when(F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2))).try_cast("bigint")
    valid = lambda n: n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    return _let(number, lambda n: F.when(valid(n), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))


def _reference(piece: Column) -> Column:
    """A piece that begins with a character reference, with the character in its place."""
    named = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def put(name: Column) -> Column:
        char = F.when(name.startswith("#"), _numbered(name)).otherwise(F.try_element_at(named, name))
        return F.coalesce(F.concat(char, F.substr(piece, F.length(name) + 3)), piece)
    return _let(F.regexp_extract(piece, r"^&(#[0-9]+|#[xX][0-9a-fA-F]+|[a-z]+);", 1), put)


def unescape(c: Column) -> Column:
    """Character references, each read once: numbers, and the names of ENTITIES."""
    return _let(c, lambda t: F.when(t.contains("&"), F.array_join(F.transform(F.split(t, "(?=&)"), _reference), "")).otherwise(t))


def tokens(html: Column) -> Column:
    """The page's tags in order, each as (text, tag): the text before it and
    the tag itself. Comments, declarations and what scripts, styles, titles and
    text areas hold are left out; an open comment or script reaches to the end."""
    clean = F.translate(html, _OPEN + _SHUT + _LINK + _HREF + _END, "�" * 5)
    marked = F.concat(F.regexp_replace(clean, _TOKEN, f"{_OPEN}$1$3{_SHUT}"), F.lit(_OPEN))
    return F.transform(F.split(marked, _SHUT), lambda p: F.struct(
        F.substring_index(p, _OPEN, 1).alias("text"), F.substring_index(p, _OPEN, -1).alias("tag")))


def _is(tag: Column, name: str) -> Column:
    return tag.rlike(rf"(?i)^<{name}[\s/>]")


def _tags(parsed: Column, name: str) -> Column:
    """All opening tags of one kind, in any case."""
    return F.transform(F.filter(parsed, lambda t: _is(t["tag"], name)), lambda t: t["tag"])


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value: any case, any place, double, single or no quotes; the last one where it is repeated; '' if absent."""
    own = F.filter(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1)), lambda a: a.rlike(rf"(?i)^{name}(?:\s*=|$)"))
    last = F.coalesce(F.try_element_at(own, F.lit(-1)), F.lit(""))
    pattern = r"(?s)^[^\s=]+\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|(.*))$"
    return unescape(_let(last, lambda a: F.concat(*[F.regexp_extract(a, pattern, g) for g in (1, 2, 3)])))


def _has_class(tag: Column, names: list[str]) -> Column:
    """One of the class names is a whole word of the class attribute."""
    return F.arrays_overlap(F.split(strip(attribute(tag, "class")), r"\s+"), F.array(*[F.lit(n) for n in names]))


def screenshot_url(parsed: Column) -> Column:
    """First <a> with class screenshot-url: its href."""
    own = F.filter(_tags(parsed, "a"), lambda t: _has_class(t, ["screenshot-url"]))
    return _nz(attribute(F.get(own, 0), "href"))


def verified(parsed: Column) -> Column:
    """An <i> icon with class mdi-check or fa-check is present."""
    return F.exists(_tags(parsed, "i"), lambda t: _has_class(t, VERIFIED_CLASSES))


def hrefs(parsed: Column) -> Column:
    return F.filter(F.transform(_tags(parsed, "a"), lambda t: attribute(t, "href")), lambda h: h != "")


def all_hrefs(html: Column) -> Column:
    """The href of every link of a page that has one."""
    return hrefs(tokens(html))


def links(parsed: Column) -> Column:
    """Every link as (href, text), inner tags aside; one ends at its end tag, the next link or the page's end."""
    run = F.array_join(F.transform(parsed, lambda t: F.concat(
        t["text"], F.when(_is(t["tag"], "a"), F.concat(F.lit(_LINK), attribute(t["tag"], "href"), F.lit(_HREF)))
        .when(t["tag"].rlike(r"(?i)^</a[\s/>]"), F.lit(_END)).otherwise(F.lit("")))), "")
    own = F.split(run, _LINK)
    body = lambda x: F.substring_index(F.substring_index(x, _HREF, -1), _END, 1)
    return F.transform(_let(own, lambda o: F.slice(o, F.lit(2), F.size(o))), lambda x: F.struct(
        F.substring_index(x, _HREF, 1).alias("href"), unescape(body(x)).alias("text")))


def application_url(parsed: Column, own_domain: str = OWN_DOMAIN) -> Column:
    """Link whose text holds 'Vulnerable App', inner tags aside; else the first
    href mentioning software or download that is not on the site's own domain."""
    by_text = _nz(F.get(F.filter(links(parsed), lambda a: a["text"].contains(APP_LINK_TEXT)), 0)["href"])
    words = "|".join(APP_HREF_WORDS)
    cands = F.filter(hrefs(parsed), lambda h: h.rlike(words) & ~h.contains(own_domain))
    return F.coalesce(by_text, F.get(cands, 0))


def keywords(parsed: Column) -> Column:
    """Trimmed items of the content of the first <meta name="keywords">, in either attribute order."""
    own = F.filter(_tags(parsed, "meta"), lambda t: F.lower(attribute(t, "name")) == "keywords")
    return _let(attribute(F.get(own, 0), "content"), lambda content: F.when(
        content != "", F.transform(F.split(content, ","), lambda k: strip(k))).otherwise(F.array().cast("array<string>")))


def codes_and_tags(kw: Column) -> tuple[Column, Column]:
    """CVE-/OSVDB- items -> upper-cased codes; other non-empty items shorter
    than 50 characters -> tags."""
    is_code = lambda k: k.rlike(CODE_PATTERN)
    codes = F.transform(F.filter(kw, is_code), lambda k: F.upper(k))
    tags = F.filter(kw, lambda k: ~is_code(k) & (F.length(k) > 0) & (F.length(k) < MAX_TAG_LEN))
    return codes, tags


def page_metadata(pages: DataFrame, html_col: str = "html", url_col: str | None = "url",
                  own_domain: str = OWN_DOMAIN) -> DataFrame:
    """screenshot_url, verified, source_url, application_url, codes, tags."""
    parsed = F.col("__tokens")
    codes, tags = codes_and_tags(F.col("__keywords"))
    extra = [F.col(url_col).alias("source_url")] if url_col else []
    return pages.withColumn("__tokens", tokens(F.col(html_col))).withColumn("__keywords", keywords(parsed)).select(
        *[c for c in pages.columns if c != html_col],
        screenshot_url(parsed).alias("screenshot_url"),
        verified(parsed).alias("verified"),
        *extra,
        application_url(parsed, own_domain).alias("application_url"),
        codes.alias("codes"), tags.alias("tags"))


def enrich_exploits(index: DataFrame, meta: DataFrame, key: str = "id") -> DataFrame:
    """A7 (+Q25 fix): index rows left-joined to their page metadata; a row
    without a page keeps its own fields, its text ``codes`` split on ';' or
    ',' and upper-cased, ``verified`` parsed from text."""
    m = meta.select(key, *[F.col(c).alias(f"_m_{c}") for c in meta.columns if c != key])
    j = index.join(m, key, "left")

    def pick(c: str, fallback: Column) -> Column:
        return F.coalesce(F.col(f"_m_{c}"), fallback) if f"_m_{c}" in j.columns else fallback

    def text_list(c: str, upper: bool) -> Column:
        if c not in index.columns:
            return F.array().cast("array<string>")
        items = F.transform(F.split(F.col(c), "[;,]"), lambda x: F.upper(strip(x)) if upper else strip(x))
        return F.filter(items, lambda x: x != "")

    idx_cols = [c for c in index.columns if c not in
                ("screenshot_url", "verified", "source_url", "application_url", "codes", "tags")]
    return j.select(
        *idx_cols,
        pick("screenshot_url", F.col("screenshot_url") if "screenshot_url" in index.columns
             else F.lit(None).cast("string")).alias("screenshot_url"),
        pick("verified", F.col("verified").try_cast("boolean") if "verified" in index.columns
             else F.lit(None).cast("boolean")).alias("verified"),
        pick("source_url", F.col("source_url") if "source_url" in index.columns
             else F.lit(None).cast("string")).alias("source_url"),
        pick("application_url", F.col("application_url") if "application_url" in index.columns
             else F.lit(None).cast("string")).alias("application_url"),
        pick("codes", text_list("codes", True)).alias("codes"),
        pick("tags", text_list("tags", False)).alias("tags"))
