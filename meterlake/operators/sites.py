"""Site lists and points: differences, countries, what to create."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.identifiers import OPTIMA, country
from meterlake.operators import lake
from meterlake.operators.dedupe import last_write_wins

SITE_KEY = ["project", "nmi"]
COMPARED = ["siteIdStr", "siteName"]
# Field, key suffix and label of the demand points of a site.
DEMAND_POINTS = [("kw", "kw", "Demand kW"), ("kva", "kva", "Demand kVA"), ("pf", "pf", "Demand Power Factor")]


def site_diff(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Each incoming site as NEW, IDENTICAL or CONFLICT, with the fields that differ."""
    old = stored.select(*SITE_KEY, *[F.col(c).alias(f"old_{c}") for c in COMPARED], F.lit(True).alias("_stored"))
    joined = incoming.join(old, SITE_KEY, "left")

    def differs(c: str):
        return F.coalesce(F.col(c), F.lit("")) != F.coalesce(F.col(f"old_{c}"), F.lit(""))

    diff = F.array_compact(F.array(*[F.when(differs(c), F.lit(c)) for c in COMPARED]))
    known = F.col("_stored").isNotNull()
    fields = F.when(known, diff).otherwise(F.array().cast("array<string>"))
    return joined.select(
        *SITE_KEY,
        *COMPARED,
        F.when(~known, F.lit("NEW")).when(F.size(diff) == 0, F.lit("IDENTICAL")).otherwise(F.lit("CONFLICT")).alias("state"),
        fields.alias("changed"),
    )


def to_import(diff: DataFrame, force: bool = False) -> DataFrame:
    """New sites, and conflicting ones only when forced."""
    wanted = ["NEW", "CONFLICT"] if force else ["NEW"]
    return diff.filter(F.col("state").isin(wanted)).select(*SITE_KEY, *COMPARED)


def import_sites(spark: SparkSession, path: str, incoming: DataFrame, batch: str, force: bool = False) -> DataFrame:
    """Insert sites that are not stored; replace those that differ only when forced. Returns the ledger of the batch.

    Of several incoming rows of a site the last one counts, by ``pos`` where there is one. Sites without an id are left
    out. The ledger below ``<path>_ledger`` has one row for each site that was new or in conflict, with the fields that
    differ, the stored values and what was decided. It is written first, and what is done comes from the ledger as
    written: a batch that is in it already, after a failure or a second delivery, is done again as it was decided.
    """
    order = [c for c in ["pos"] if c in incoming.columns] or COMPARED
    usable = incoming.filter(F.col("project").isNotNull() & (F.coalesce("nmi", F.lit("")) != "") & (F.coalesce("siteIdStr", F.lit("")) != ""))
    newest = last_write_wins(usable, SITE_KEY, order).select(*SITE_KEY, *COMPARED)
    held = lake.stored(spark, path, [None], [])
    old = newest.limit(0) if held is None else held
    before = old.select(*SITE_KEY, F.struct(*COMPARED).alias("stored"))
    told = site_diff(newest, old.select(*SITE_KEY, *COMPARED)).filter(F.col("state") != "IDENTICAL").join(before, SITE_KEY, "left")
    decision = F.when(F.col("state") == "NEW", F.lit("inserted")).otherwise(F.lit("replaced" if force else "skipped"))
    ledger = f"{path.rstrip('/')}_ledger"
    entry = told.withColumn("decision", decision).withColumn("batch", F.lit(batch))
    if not lake.exists(spark, f"{ledger}/batch={batch}"):
        entry.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(ledger)
    written = spark.read.schema(entry.schema).parquet(ledger).filter(F.col("batch") == batch)
    lake.upsert(spark, path, written.filter(F.col("decision") != "skipped").select(*SITE_KEY, *COMPARED), SITE_KEY, [], COMPARED)
    return written


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("state").agg(F.count("*").alias("sites"))


def with_country(sites: DataFrame) -> DataFrame:
    return sites.withColumn("country", country(F.col("nmi"), F.coalesce("siteName", F.lit(""))))


def country_summary(sites: DataFrame) -> DataFrame:
    return with_country(sites).groupBy("country").agg(F.count("*").alias("sites"))


def usable_sites(sites: DataFrame) -> DataFrame:
    """Sites with both identifiers; the country defaults to AU."""
    return sites.filter(F.col("nmi").isNotNull() & F.col("siteIdStr").isNotNull()).withColumn(
        "country", F.coalesce("country", F.lit("AU"))
    )


def meters_of_sites(sites: DataFrame, edges: DataFrame) -> DataFrame:
    """Meter of each site through its E1 point, else through its B1 point.

    ``edges`` holds ``(nem12_id, meter_vertex_id)`` and is reduced to one meter
    per point before both lookups share it.
    """
    first = edges.groupBy("nem12_id").agg(F.min("meter_vertex_id").alias("meter"))

    def by(channel: str):
        return first.select(
            F.regexp_replace("nem12_id", f"-{channel}$", "").alias("nmi"), F.col("meter").alias(f"by_{channel}")
        ).filter(F.col("nem12_id").endswith(f"-{channel}"))

    joined = sites.join(by("E1"), "nmi", "left").join(by("B1"), "nmi", "left")
    return joined.select(
        *sites.columns,
        F.coalesce("by_E1", "by_B1").alias("meter_vertex_id"),
        F.when(F.col("by_E1").isNotNull(), F.lit("E1"))
        .when(F.col("by_B1").isNotNull(), F.lit("B1"))
        .otherwise(F.lit("missing"))
        .alias("strategy"),
    )


def demand_points(meters: DataFrame) -> DataFrame:
    """Three points per site."""
    fields = F.array(
        *[F.struct(F.lit(f).alias("field"), F.lit(s).alias("suffix"), F.lit(d).alias("label")) for f, s, d in DEMAND_POINTS]
    )
    bare = F.regexp_replace("nmi", f"^{OPTIMA}", "")
    return meters.select("nmi", "meter_vertex_id", F.explode(fields).alias("f")).select(
        bare.alias("identifier"),
        F.col("f")["field"].alias("field"),
        F.concat(F.col("nmi"), F.lit("-demand-"), F.col("f")["suffix"]).alias("nem12_id"),
        F.concat(bare, F.lit(" "), F.col("f")["label"]).alias("label"),
        F.lit("demand").alias("point_category"),
        F.coalesce("meter_vertex_id", F.lit("")).alias("meter_vertex_id"),
    )


def is_orphan():
    return F.trim(F.coalesce("meter_vertex_id", F.lit(""))) == ""


def orphans(points: DataFrame) -> DataFrame:
    return points.filter(is_orphan())


def attached(points: DataFrame) -> DataFrame:
    return points.filter(~is_orphan())


def points_to_create(points: DataFrame, existing: DataFrame) -> DataFrame:
    """Attached points whose id does not exist yet."""
    return attached(points).join(existing.select("nem12_id"), "nem12_id", "left_anti")


def point_summary(points: DataFrame, existing: DataFrame) -> DataFrame:
    """Points, distinct meters, orphans, existing and new, in one pass over the points."""
    known = existing.select("nem12_id").distinct().withColumn("_known", F.lit(True))
    joined = points.join(known, "nem12_id", "left")
    new = ~is_orphan() & F.col("_known").isNull()
    per_meter = joined.groupBy("identifier").agg(
        F.count("*").alias("points"),
        F.count(F.when(is_orphan(), 1)).alias("orphans"),
        F.count(F.when(F.col("_known"), 1)).alias("existing"),
        F.count(F.when(new, 1)).alias("new"),
    )
    return per_meter.agg(
        F.sum("points").cast("long").alias("points"),
        F.count("*").alias("meters"),
        F.sum("orphans").cast("long").alias("orphans"),
        F.sum("existing").cast("long").alias("existing"),
        F.sum("new").cast("long").alias("to_create"),
    )


def strategy_summary(meters: DataFrame) -> DataFrame:
    return meters.groupBy("strategy").agg(F.count("*").alias("sites"))
