"""Readers for the landed vulnerability feeds (A1, A3, A5, A8, A9) and the
bronze projections (B1, B2, B4, B5).

Every reader takes an explicit schema: feed files are never inferred. A file
holding one big JSON document (the KEV catalogue, the module map) parses in
one task, or with ``ranges`` in byte ranges by many (``json_members``); pass
``partitions`` to spread the exploded rows before heavy work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threatspark.functions.strings import NA_WORDS
from threatspark.operators.incremental import exploit_change_date, since_filter

# ------------------------------------------------------------------ schemas
# The feeds' published field names.

KEV_ROW = ("cveID:string,vendorProject:string,product:string,vulnerabilityName:string,"
           "dateAdded:string,shortDescription:string,requiredAction:string,dueDate:string,"
           "knownRansomwareCampaignUse:string,notes:string,cwes:array<string>")
KEV_FIELDS = "catalogVersion string, dateReleased string, count int"
KEV_SCHEMA = f"{KEV_FIELDS}, vulnerabilities array<struct<{KEV_ROW}>>"

METRIC = ("array<struct<source:string,type:string,cvssData:struct<version:string,vectorString:string,"
          "baseScore:double,baseSeverity:string>>>")
NVD_CVE = (f"id:string,sourceIdentifier:string,published:string,lastModified:string,vulnStatus:string,"
           f"cveTags:string,descriptions:array<struct<lang:string,value:string>>,"
           f"metrics:map<string,{METRIC}>,"
           f"weaknesses:array<struct<source:string,type:string,description:array<struct<lang:string,value:string>>>>,"
           f"configurations:string,references:array<struct<url:string,source:string,tags:array<string>>>")
NVD_PAGE_SCHEMA = f"totalResults int, vulnerabilities array<struct<cve:struct<{NVD_CVE}>>>"

EXPLOIT_INDEX_COLUMNS = ["id", "file", "description", "date_published", "author", "type", "platform",
                         "port", "date_added", "date_updated", "verified", "codes", "tags", "aliases",
                         "screenshot_url", "application_url", "source_url"]

MODULE_FIELDS = ("title:string,name:string,aliases:array<string>,rank:int,disclosure_date:string,"
                 "type:string,platform:string,arch:string,rport:string,autofilter_ports:array<int>,"
                 "autofilter_services:array<string>,targets:string,mod_time:string,path:string,"
                 "is_install_path:boolean,ref_name:string,check:boolean,post_auth:boolean,"
                 "default_credential:boolean,notes:string,session_types:string,needs_cleanup:boolean,"
                 "actions:string,author:array<string>,description:string,references:array<string>")
MODULE_MAP_SCHEMA = f"map<string,struct<{MODULE_FIELDS}>>"


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions) if partitions else df


# ------------------------------------------------------------------ one big document

def json_members(spark: SparkSession, path: str) -> DataFrame:
    """The objects one level below the root of each JSON file, read in byte
    ranges: file (``_src``), number in the file (``_member``, from 0) and
    ``text``, with all that stands between the last member and this one
    before it; what follows the last member is a member, too.

    The file is cut at closing braces. Whether one closes an object depends on
    the quotes before it, and which object on the braces before it. Each range
    works both out from its own start, for a start inside and outside a
    string; running sums over the ranges (a row each) give every range its
    true state. A member's cuts then meet by its number, so no row holds more
    than one member, wherever ranges begin."""
    cut = spark.read.option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("_src"), F.col("_metadata.file_block_start").alias("_from"), F.monotonically_increasing_id().alias("_at"))
    plain = F.regexp_replace("value", r"(?s)\\.", "")  # without escaped characters
    count = lambda text, c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    opened = lambda text: count(F.regexp_replace(text, '"[^"]*("|$)', ""), "{")  # noqa: E731  outside strings
    cut = cut.withColumn("_odd", count(plain, '"') % 2 == 1).withColumn("_open0", opened(plain)).withColumn("_open1", opened(F.concat(F.lit('"'), plain)))
    own = Window.partitionBy("_src", "_from").orderBy("_at")
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("_odd_after", F.sum(F.col("_odd").cast("long")).over(so_far) % 2 == 1).withColumn("_odd_before", F.col("_odd_after") != F.col("_odd"))

    def change(inside):
        """How a cut changes the depth, if its range starts inside a string or not."""
        return F.when(F.col("_odd_before") != inside, F.col("_open1")).otherwise(F.col("_open0")) - F.when(F.col("_odd_after") != inside, 0).otherwise(1)

    ranges = cut.groupBy("_src", "_from").agg(F.count_if("_odd").alias("odd"), F.sum(change(F.lit(False))).alias("d0"), F.sum(change(F.lit(True))).alias("d1"))
    earlier = Window.partitionBy("_src").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0))
    ranges = ranges.withColumn("_inside", before("odd") % 2 == 1).withColumn("d", F.when(F.col("_inside"), F.col("d1")).otherwise(F.col("d0")))
    ranges = ranges.select("_src", "_from", "_inside", before("d").alias("_depth"))
    cut = cut.join(ranges, ["_src", "_from"])
    depth = F.col("_depth") + F.sum(change(F.col("_inside"))).over(so_far)
    cut = cut.withColumn("_ends", (depth == 1) & (F.col("_odd_after") == F.col("_inside"))).select("_src", "_from", "_at", "value", "_ends")
    ends = cut.groupBy("_src", "_from").agg(F.count_if("_ends").alias("n")).select("_src", "_from", before("n").alias("_first"))
    member = F.col("_first") + F.coalesce(F.sum(F.col("_ends").cast("long")).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    members = cut.join(ends, ["_src", "_from"]).withColumn("_member", member).groupBy("_src", "_member").agg(
        F.array_sort(F.collect_list(F.struct("_from", "_at", "value"))).alias("l"))  # the cuts of one member
    return members.select("_src", "_member", F.concat(F.array_join(F.transform("l", lambda x: x["value"]), "}"), F.lit("}")).alias("text"))


# What stands before a member's own object: no brace outside a string.
_LEAD = r'(?s)^((?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+)'
_VALUE = r'"{}"\s*:\s*("(?:[^"\\]++|\\.)*+"|[^,\s\]}}]++)'


def json_elements(spark: SparkSession, path: str, array: str, element: str, fields: str) -> DataFrame:
    """The objects of one array at the root of each JSON file, read in byte
    ranges (``json_members``): ``v`` (by the schema ``element``) and the root's
    plain ``fields`` (a schema), wherever they stand. The other objects of the
    root are passed over. What a file's members share is worked out from the
    few that have more than a comma before them, one row per file."""
    m = json_members(spark, path).withColumn("text", F.when(F.col("_member") == 0, F.regexp_replace("text", r"^\s*\{", "")).otherwise(F.col("text")))
    m = m.withColumn("_lead", F.regexp_extract("text", _LEAD, 1))
    lead, no = F.col("_lead"), F.col("_member")
    names = [f.strip().split(" ")[0] for f in fields.split(",")]
    raw = {n: F.max(F.nullif(F.regexp_extract(lead, f"(?s){_VALUE.format(n)}", 1), F.lit(""))) for n in names}
    head = m.filter(~lead.rlike(r"^[\s,]*$")).groupBy("_src").agg(
        F.min(F.when(lead.rlike(rf'"{array}"\s*:\s*\[\s*$'), no)).alias("_start"),
        F.collect_list(F.when(lead.rlike(r"^\s*\]"), no)).alias("_ends"),  # an entry for each array of the root
        F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), c) for n, c in raw.items()]), F.lit("}")).alias("_fields"))
    end = F.array_min(F.filter("_ends", lambda x: x > F.col("_start")))
    head = head.select("_src", "_start", end.alias("_end"), F.from_json("_fields", fields).alias("_root"))
    own = m.join(head, "_src").filter((no >= F.col("_start")) & (F.col("_end").isNull() | (no < F.col("_end"))))
    return own.select(F.from_json(F.substr("text", F.length(lead) + 1), element).alias("v"), *[F.col(f"_root.{n}").alias(n) for n in names])


# ------------------------------------------------------------------ A1 / B2

def read_kev(spark: SparkSession, path: str, since: str | None = None,
             partitions: int | None = None, lines: bool = False, ranges: bool = False) -> DataFrame:
    """A1: one row per catalogue entry, catalogue fields copied on each; F1
    incremental filter on dateAdded (text compare, null dropped). ``lines``:
    files hold a document per line, instead of one document; ``ranges``: files
    of one document are read in byte ranges, a row per entry from the start."""
    if ranges:
        doc = json_elements(spark, path, "vulnerabilities", f"struct<{KEV_ROW}>", KEV_FIELDS)
        return _spread(since_filter(doc.select("v.*", "catalogVersion", "dateReleased", "count"), "dateAdded", since, keep_null=False), partitions)
    doc = spark.read.schema(KEV_SCHEMA).option("multiLine", not lines).json(path)
    rows = doc.select("catalogVersion", "dateReleased", "count",
                      F.explode("vulnerabilities").alias("v")) \
        .select("v.*", "catalogVersion", "dateReleased", "count")
    return _spread(since_filter(rows, "dateAdded", since, keep_null=False), partitions)


def bronze_kev(rows: DataFrame) -> DataFrame:
    """B2: identity projection."""
    return rows.select("*")


# ------------------------------------------------------------------ A3 / F5 / B1

def read_nvd_pages(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A3: response pages -> one row per item (column ``cve``, a struct).
    ``lines``: files hold a page per line, instead of one page."""
    pages = spark.read.schema(NVD_PAGE_SCHEMA).option("multiLine", not lines).json(path)
    return pages.select(F.explode("vulnerabilities").alias("v")).select(F.col("v.cve").alias("cve"))


def bronze_nvd(items: DataFrame, lo: str | None = None, hi: str | None = None) -> DataFrame:
    """B1: eleven fields of the item; rows without ``cve`` dropped. F5: the
    source-side closed range on lastModified when given."""
    out = items.filter(F.col("cve").isNotNull()).select(
        *[F.col(f"cve.{c}").alias(c) for c in
          ["id", "sourceIdentifier", "published", "lastModified", "vulnStatus", "cveTags",
           "descriptions", "metrics", "weaknesses", "configurations", "references"]])
    if lo is not None and hi is not None:
        t = F.try_to_timestamp(F.col("lastModified"))
        out = out.filter((t >= F.try_to_timestamp(F.lit(lo))) & (t <= F.try_to_timestamp(F.lit(hi))))
    return out


# ------------------------------------------------------------------ A5 / F2 / B4

def read_exploit_index(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """A5: the index CSV (all text); F2 incremental on updated-else-published,
    strict '>', rows without a date kept."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"') \
        .schema(", ".join(f"{c} string" for c in EXPLOIT_INDEX_COLUMNS)).csv(path)
    if since is None:
        return df
    return since_filter(df.withColumn("_chg", exploit_change_date()), "_chg", since, True).drop("_chg")


def bronze_exploit(rows: DataFrame) -> DataFrame:
    """Fourteen fields. Q19: date_added, date_updated and aliases are
    carried too (the reference drops them, leaving them null in silver)."""
    keep = ["id", "file", "description", "date_published", "author", "type", "platform", "port",
            "screenshot_url", "verified", "source_url", "application_url", "codes", "tags",
            "date_added", "date_updated", "aliases"]
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in keep])


# ------------------------------------------------------------------ A8 / F3 / B5

def read_modules(spark: SparkSession, path: str, since: str | None = None,
                 partitions: int | None = None, lines: bool = False, ranges: bool = False) -> DataFrame:
    """The module JSON object used as a map; key -> ``fullname``. F3
    incremental on mod_time (text compare, strict '>', null kept). ``lines``:
    files hold an object per line, instead of one object; ``ranges``: files of
    such objects are read in byte ranges, a row per module from the start."""
    if ranges:
        one = F.concat(F.lit("{"), F.regexp_replace("text", r"^[\s,{}]*", ""), F.lit("}"))
        m = json_members(spark, path).select(F.from_json(one, MODULE_MAP_SCHEMA).alias("m"))
        rows = m.select(F.explode("m").alias("fullname", "r")).select("fullname", "r.*")
        return _spread(since_filter(rows, "mod_time", since, keep_null=True), partitions)
    text = spark.read.text(path, wholetext=not lines)
    m = text.select(F.from_json("value", MODULE_MAP_SCHEMA).alias("m"))
    rows = m.select(F.explode("m").alias("fullname", "r")).select("fullname", "r.*")
    return _spread(since_filter(rows, "mod_time", since, keep_null=True), partitions)


def bronze_modules(rows: DataFrame) -> DataFrame:
    """The 27 module fields."""
    names = ["fullname"] + [f.split(":")[0] for f in MODULE_FIELDS.split(",")]
    return rows.select(*[c for c in names if c in rows.columns])


# ------------------------------------------------------------------ A9

_LOCAL_SCHEME = "^file:/+"


def read_scanner_csv(spark: SparkSession, path: str, range_bytes: int = 128 << 20) -> DataFrame:
    """Scanner export with quoted multi-line cells; NA words read as
    null (Q14). A stable ``row_id`` follows input order, file by file in name
    order: (file rank << 33) + the row's index in its file. Where a file is
    larger than ``range_bytes`` the files are read in byte ranges
    (``scanner_csv_ranges``), else a task reads a whole file: a multi-line CSV
    file is never split, so its rows' index is that in the partition. Either
    way gives the same rows and ids, at every recomputation."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("inferSchema", False)
    df = reader.csv(path)
    longest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]  # file sizes only, no contents
    if (longest or 0) > range_bytes:
        rows = scanner_csv_ranges(spark, path, df.columns)
    else:
        rows = df.select("*", F.col("_metadata.file_path").alias("_src"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"))
    cols = df.columns
    rows = rows.select(*[F.when(F.col(f"`{c}`").isin(NA_WORDS), F.lit(None)).otherwise(F.col(f"`{c}`")).alias(c) for c in cols],
                       F.regexp_replace("_src", _LOCAL_SCHEME, "/").alias("_src"), "_pos")
    # one row per file that has rows, numbered in name order
    ranks = rows.select("_src").distinct().withColumn("_rank", F.row_number().over(Window.orderBy("_src")) - 1)
    return rows.join(ranks, "_src", "left").withColumn("row_id", F.col("_rank").cast("long") * (1 << 33) + F.col("_pos")) \
        .select(*[F.col(f"`{c}`") for c in cols], "row_id")


def scanner_csv_ranges(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The records of quoted CSV files, read in byte ranges by many tasks:
    ``columns``, the file (``_src``) and the record's index in it (``_pos``).

    Whether a line starts a record depends on how many quotes stand before it
    in the file, odd or even. Each range works that out from its own start,
    counts its record starts for either case, and a running sum over the
    ranges (a row each) tells which case holds and how many records came
    before. The lines of a record then meet by its number, those that lie in
    other ranges too. Quotes count everywhere, so a cell that isn't quoted may
    hold none; line breaks inside cells stay as they are."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_src"), F.col("_metadata.file_block_start").alias("_from"), F.monotonically_increasing_id().alias("_at"))
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    lines = lines.withColumn("_odd", quotes % 2 == 1).withColumn("_blank", F.col("value").isin("", "\r"))
    own = Window.partitionBy("_src", "_from").orderBy("_at")
    odd_before = F.coalesce(F.sum(F.col("_odd").cast("long")).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 1
    lines = lines.withColumn("_odd_before", odd_before)
    ranges = lines.groupBy("_src", "_from").agg(
        F.count_if("_odd").alias("odd"), F.count_if(~F.col("_odd_before") & ~F.col("_blank")).alias("if_even"),
        F.count_if(F.col("_odd_before") & ~F.col("_blank")).alias("if_odd"))
    earlier = Window.partitionBy("_src").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_open", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1)
    ranges = ranges.withColumn("n", F.when(F.col("_open"), F.col("if_odd")).otherwise(F.col("if_even")))
    ranges = ranges.select("_src", "_from", "_open", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    placed = lines.join(ranges, ["_src", "_from"]).withColumn("_inside", F.col("_odd_before") != F.col("_open"))
    placed = placed.filter(F.col("_inside") | ~F.col("_blank"))  # blank lines between records
    number = F.col("_before") + F.sum((~F.col("_inside")).cast("long")).over(own.rowsBetween(Window.unboundedPreceding, 0)) - 1
    records = placed.withColumn("_record", number).groupBy("_src", "_record").agg(
        F.array_sort(F.collect_list(F.struct("_from", "_at", "value"))).alias("l"))  # the lines of one record
    text = F.regexp_replace(F.array_join(F.transform("l", lambda x: x["value"]), "\n"), "\r$", "")
    cells = F.from_csv(text, ", ".join(f"c{i} STRING" for i in range(len(columns))), {"quote": '"', "escape": '"', "multiLine": "true"})
    out = records.filter("_record > 0").select(cells.alias("c"), "_src", (F.col("_record") - 1).alias("_pos"))
    return out.select(*[F.col(f"c.c{i}").alias(c) for i, c in enumerate(columns)], "_src", "_pos")
