"""Silver transforms.

Each transform returns (good, quarantine): rows with a missing key or a
value that cannot be read go to quarantine with a reason instead of failing
or silently vanishing (F12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threatspark.functions.casts import EPSS_DECIMAL, parse_day, parse_iso, split_quarantine, tolerant_int
from threatspark.functions.nested import (english_values, first_descriptions, metric_columns,
                                          non_empty_metrics, pluck)

# Fixed values that must equal the reference's for right results.
KEV_TITLE = "CISA Catalog of Known Exploited Vulnerabilities"


def _missing(c: str):
    return F.col(c).isNull() | (F.col(c).cast("string") == "")


def silver_kev(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """snake_case names, constant title, typed dates, cwes default []."""
    rows = bronze.select(
        F.col("cveID").alias("cve_id"),
        F.lit(KEV_TITLE).alias("title"),
        F.col("catalogVersion").alias("catalog_version"),
        parse_iso(F.col("dateReleased")).alias("date_released"),
        F.col("count"),
        F.col("vendorProject").alias("vendor_project"),
        F.col("product"),
        F.col("vulnerabilityName").alias("vulnerability_name"),
        parse_day(F.col("dateAdded")).alias("date_added"),
        F.col("shortDescription").alias("short_description"),
        F.col("requiredAction").alias("required_action"),
        parse_day(F.col("dueDate")).alias("due_date"),
        F.col("knownRansomwareCampaignUse").alias("known_ransomware_campaign_use"),
        F.col("notes"),
        F.coalesce(F.col("cwes"), F.array().cast("array<string>")).alias("cwes"))
    return split_quarantine(rows, {"missing_key": _missing("cve_id")})


def silver_epss(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Key check, numbers as decimal (unreadable -> quarantine, Q17)."""
    rows = bronze.select("cve", F.col("epss").try_cast(EPSS_DECIMAL).alias("epss"),
                         F.col("percentile").try_cast(EPSS_DECIMAL).alias("percentile"), "date")
    return split_quarantine(rows, {"missing_key": _missing("cve"),
                                   "epss_not_a_number": F.col("epss").isNull(),
                                   "percentile_not_a_number": F.col("percentile").isNull()})


def silver_exploit(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Key check, port as int (tolerant), 17 fields."""
    def opt(c, t="string"):
        return F.col(c) if c in bronze.columns else F.lit(None).cast(t).alias(c)
    rows = bronze.select(
        "id", "file", "description", "date_published", "author", "type", "platform",
        tolerant_int(F.col("port")).alias("port"), opt("screenshot_url"), opt("verified", "boolean"),
        opt("date_added"), opt("date_updated"), opt("codes", "array<string>"), opt("tags", "array<string>"),
        opt("aliases"), opt("application_url"), opt("source_url"))
    return split_quarantine(rows, {"missing_key": _missing("id")})


# The silver module columns.
MODULE_SILVER = ["fullname", "title", "name", "rank", "disclosure_date", "mod_time", "type", "author",
                 "description", "references", "platform", "arch", "rport", "autofilter_ports",
                 "autofilter_services", "targets", "path", "is_install_path", "ref_name", "check",
                 "post_auth", "default_credential", "notes", "session_types", "needs_cleanup", "actions"]


def silver_modules(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Key check, 26 fields (aliases dropped), author/references default []."""
    empty = F.array().cast("array<string>")
    cols = []
    for c in MODULE_SILVER:
        if c in ("author", "references"):
            cols.append(F.coalesce(F.col(c), empty).alias(c) if c in bronze.columns else empty.alias(c))
        elif c in bronze.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).cast("string").alias(c))
    return split_quarantine(bronze.select(*cols), {"missing_key": _missing("fullname")})


def silver_nvd(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Key check; English descriptions (H1); reference URLs (H2); first
    description of each weakness (H3); typed dates (S7); metric lists
    flattened to metrics_<type>, empty lists dropped (H4); non-list -> []
    (H5, typed reading already gives null)."""
    empty = F.array().cast("array<string>")
    rows = bronze.select(
        F.col("id").alias("cve_id"),
        F.col("sourceIdentifier").alias("source_identifier"),
        F.col("vulnStatus").alias("vuln_status"),
        parse_iso(F.col("published")).alias("published"),
        parse_iso(F.col("lastModified")).alias("last_modified"),
        F.coalesce(english_values(F.col("descriptions")), empty).alias("descriptions"),
        F.coalesce(pluck(F.col("references"), "url"), empty).alias("references"),
        F.coalesce(first_descriptions(F.col("weaknesses")), empty).alias("weaknesses"),
        non_empty_metrics(F.col("metrics")).alias("metrics"),
        *metric_columns(F.col("metrics")))
    return split_quarantine(rows, {"missing_key": _missing("cve_id")})
