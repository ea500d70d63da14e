"""What reconstruction runs leave behind: nested JSON reports of every run under a folder, as flat tables.

A run is the folder above ``odm_input``; its name is the column ``run``.  Files are found by
listing through Spark's readers, so any store works and absent files give no rows.
A file that is no JSON object (or array, where one is expected) gives nulls or no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the artefacts lie below a run: fixed values.
PLACES = {
    "build_json": "build.json",
    "selection_summary_json": "selection_summary.json",
    "selection_audit_csv": "selection_audit.csv",
    "geo_txt": "odm_input/geo.txt",
    "opensfm_reconstruction": "odm_input/opensfm/reconstruction.json",
    "opensfm_stats": "odm_input/opensfm/stats/stats.json",
    "orthophoto": "odm_input/odm_orthophoto/odm_orthophoto.tif",
    "overlap_raster": "odm_input/opensfm/stats/overlap.tif",
    "georeferenced_point_cloud": "odm_input/odm_georeferencing/odm_georeferenced_model.laz",
}
FEATURES, RECONSTRUCTION, MISSING, TRACKS, STATS = (f"odm_input/opensfm/{p}" for p in ("reports/features.json", "reconstruction.json", "reports/reconstruction.json", "reports/tracks.json", "stats/stats.json"))
CAMERA_MODELS, EXPORTED_CAMERAS = "odm_input/opensfm/camera_models.json", "odm_input/cameras.json"


def read_json(spark: SparkSession, root: str, place: str, schema: str) -> DataFrame:
    """run and ``data`` of the file at that place of each run."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", place.rpartition("/")[2]).text(root, wholetext=True)
    run = F.regexp_extract(F.col("_metadata.file_path"), rf"([^/]+)/{place.replace('.', '[.]')}$", 1).alias("run")
    return files.select(run, F.from_json("value", schema).alias("data") if schema != "text" else F.col("value").alias("data")).where("run <> ''")


def features(spark: SparkSession, root: str) -> DataFrame:
    """run, image, num_features; of an image listed twice the last entry counts."""
    rows = read_json(spark, root, FEATURES, "image_reports array<struct<image: string, num_features: long>>")
    each = rows.select("run", F.posexplode("data.image_reports").alias("at", "r")).where("r.image IS NOT NULL")
    return each.groupBy("run", F.col("r.image").alias("image")).agg(F.max_by(F.coalesce("r.num_features", F.lit(0)), "at").alias("num_features"))


def shots(spark: SparkSession, root: str) -> DataFrame:
    """run and image of every shot of every component."""
    rows = read_json(spark, root, RECONSTRUCTION, "array<struct<shots: map<string, string>>>")
    return rows.select("run", F.explode("data").alias("c")).select("run", F.explode(F.map_keys("c.shots")).alias("image")).distinct()


def reported_missing(spark: SparkSession, root: str) -> DataFrame:
    rows = read_json(spark, root, MISSING, "not_reconstructed_images array<string>")
    return rows.select("run", F.explode("data.not_reconstructed_images").alias("image")).distinct()


def candidate_pairs(spark: SparkSession, root: str) -> DataFrame:
    return read_json(spark, root, MISSING, "num_candidate_image_pairs long").select("run", "data.num_candidate_image_pairs")


def view_graph(spark: SparkSession, root: str) -> DataFrame:
    """run, a, b, weight; entries of under three parts stay, with a null weight."""
    rows = read_json(spark, root, TRACKS, "view_graph array<array<string>>")
    e = rows.select("run", F.explode("data.view_graph").alias("e"))
    return e.select("run", F.get("e", F.lit(0)).alias("a"), F.get("e", F.lit(1)).alias("b"), F.get("e", F.lit(2)).cast("long").alias("weight"))


def track_counts(spark: SparkSession, root: str) -> DataFrame:
    return read_json(spark, root, TRACKS, "num_images long, num_tracks long").select("run", F.col("data.num_images").alias("n_images_in_tracks"), F.col("data.num_tracks").alias("n_tracks"))


def run_stats(spark: SparkSession, root: str) -> DataFrame:
    """Errors and counts of the reconstruction; gps and camera errors as JSON text."""
    names = ("reprojection_error_pixels", "reprojection_error_normalized", "average_track_length", "reconstructed_points_count", "observations_count")
    raw = read_json(spark, root, STATS, "text")
    value = lambda n: F.get_json_object("data", f"$.reconstruction_statistics.{n}").cast("double").alias(n)
    return raw.select("run", *map(value, names), *(F.coalesce(F.get_json_object("data", f"$.{n}"), F.lit("{}")).alias(n) for n in ("gps_errors", "camera_errors")))


def cameras(spark: SparkSession, root: str) -> DataFrame:
    """run and both camera files as JSON text, null where a run has none."""
    models = read_json(spark, root, CAMERA_MODELS, "text").withColumnRenamed("data", "opensfm_camera_models")
    return models.join(read_json(spark, root, EXPORTED_CAMERAS, "text").withColumnRenamed("data", "exported_cameras"), "run", "full")


def presence(spark: SparkSession, root: str) -> DataFrame:
    """run and a flag for each artefact; ``opensfm`` if any file lies in that folder.  Empty files count as absent."""
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    places = "|".join([*(p.replace(".", "[.]") for p in PLACES.values()), "odm_input/opensfm/.*"])
    found = paths.select(F.regexp_extract("path", rf"([^/]+)/(?:{places})$", 1).alias("run"), "path").where("run <> ''")
    flags = {n: F.col("path").endswith(p) for n, p in PLACES.items()} | {"opensfm": F.col("path").contains("/odm_input/opensfm/")}
    return found.groupBy("run").agg(*(F.max(f).alias(n) for n, f in flags.items()))


def audit_rows(spark: SparkSession, root: str) -> DataFrame:
    """Audit CSVs of all runs: run, FrameNumber, selected, easting, northing, altamsl, quality_score, ``image`` and
    ``at``, the order within a file."""
    schema = "FrameNumber long, selected string, easting double, northing double, altamsl double, quality_score double"
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "selection_audit.csv").text(root, wholetext=True)
    lines = text.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/selection_audit[.]csv$", 1).alias("run"), F.split(F.rtrim("value"), "\r?\n").alias("lines"))
    fields = lines.select("run", F.split(F.col("lines")[0], ",").alias("head"), F.posexplode(F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 1, F.lit(0)))).alias("at", "line"))
    cell = lambda n: F.map_from_arrays("head", F.slice(F.split("line", ","), F.lit(1), F.size("head")))[n]
    full = fields.where("trim(line) <> '' AND size(split(line, ',')) >= size(head)")
    typed = [F.nanvl(cell(n).try_cast(t), F.lit(None)).alias(n) if t == "double" else cell(n).try_cast(t).alias(n) for n, t in (c.split() for c in schema.split(", "))]
    out = full.select("run", "at", *typed)
    return out.withColumn("selected", F.lower(F.trim("selected")).isin("true", "1", "yes")).withColumn("image", F.format_string("%06d.png", "FrameNumber"))
