"""What a reconstruction made of a selection: reports keyed by run, and the images to look at.

``selected`` (run, image) narrows each report to the selection of its run; a run without
selected images is judged over all its images.  Lists of images are rows of
:func:`image_flags`, never arrays.  Null images are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framewright.operators.audit import quantiles
from framewright.sources import artefacts

LOW_FEATURES = 100
NEAR_REPEAT_M = 0.1
LOW_BASELINE_M = 1.0
WEAK_DEGREE = 5
WEAK_STRENGTH = 100


def rounded_quantiles(column: str) -> Column:
    """min, p10, p25, p50, p75, p90, max to six places; null without values."""
    return F.transform(quantiles(column), lambda q: F.round(q, 6))


def in_scope(rows: DataFrame, selected: DataFrame) -> DataFrame:
    """Rows (run, image, ...) of selected images, or all rows of a run that selected none."""
    chosen = selected.select("run", "image").distinct().withColumn("chosen", F.lit(True))
    runs = selected.select("run").distinct().withColumn("narrowed", F.lit(True))
    return rows.join(runs, "run", "left").join(chosen, ["run", "image"], "left").where("chosen OR narrowed IS NULL").drop("chosen", "narrowed")


def selection_metrics(rows: DataFrame) -> DataFrame:
    """One row a run of run, at, FrameNumber, selected, easting, northing, altamsl, quality_score.
    Frame gaps follow the order of the rows (``at``), baselines that of the frame numbers."""
    chosen = rows.where("selected")
    lag = lambda c, order: F.col(c) - F.lag(c).over(Window.partitionBy("run").orderBy(*order))
    by_number = ["FrameNumber", "at"]
    steps = chosen.select("*", lag("FrameNumber", ["at"]).cast("double").alias("gap"), F.hypot(lag("easting", by_number), lag("northing", by_number)).alias("baseline"))
    found = steps.groupBy("run").agg(
        F.count("*").alias("n_selected"),
        F.min("FrameNumber").alias("first_frame"),
        F.max("FrameNumber").alias("last_frame"),
        *(rounded_quantiles(c).alias(n) for c, n in (("gap", "frame_gap"), ("altamsl", "altitude_m"), ("baseline", "baseline_m"), ("quality_score", "quality"))),
        F.count_if(F.col("baseline") <= NEAR_REPEAT_M).alias("n_near_repeats"),
        F.count_if(F.col("baseline") < LOW_BASELINE_M).alias("n_low_baselines"),
    )
    total = rows.groupBy("run").agg(F.count("*").alias("n_candidates"))
    return total.join(found, "run", "left").withColumn("n_selected", F.coalesce("n_selected", F.lit(0)))


def feature_flags(features: DataFrame, selected: DataFrame) -> DataFrame:
    """run, image and flag: ``zero_features``, or ``low_features`` below ``LOW_FEATURES``."""
    flag = F.when(F.col("num_features") == 0, "zero_features").when((F.col("num_features") > 0) & (F.col("num_features") < LOW_FEATURES), "low_features")
    return in_scope(features, selected).select("run", "image", flag.alias("flag")).where("flag IS NOT NULL")


def feature_report(features: DataFrame, selected: DataFrame) -> DataFrame:
    n = features.groupBy("run").agg(F.count("*").alias("n_images"))
    counts = in_scope(features, selected).groupBy("run").agg(
        rounded_quantiles("num_features").alias("feature_count"),
        F.count_if(F.col("num_features") == 0).alias("n_zero_features"),
        F.count_if((F.col("num_features") > 0) & (F.col("num_features") < LOW_FEATURES)).alias("n_low_features"),
    )
    return n.join(counts, "run", "left").na.fill(0, ["n_zero_features", "n_low_features"])


def not_reconstructed(shots: DataFrame, missing: DataFrame, selected: DataFrame) -> DataFrame:
    """run, image: selected images without a shot, and those reported as missing."""
    return selected.select("run", "image").join(shots, ["run", "image"], "left_anti").union(missing.select("run", "image")).distinct()


def reconstruction_report(shots: DataFrame, missing: DataFrame, selected: DataFrame) -> DataFrame:
    """Counts of shots, selected and missing images of each run that has shots or missing images."""
    runs = shots.select("run").union(missing.select("run")).distinct()
    made = shots.select("run", "image").distinct()
    chosen = selected.select("run", "image").distinct()
    n_made = made.groupBy("run").agg(F.count("*").alias("n_shots"))
    n_chosen = chosen.join(made.withColumn("made", F.lit(True)), ["run", "image"], "left").groupBy("run").agg(F.count("*").alias("n_selected"), F.count("made").alias("n_both"))
    n_missing = not_reconstructed(shots, missing, selected).groupBy("run").agg(F.count("*").alias("n_not_reconstructed"))
    joined = runs.join(n_made, "run", "left").join(n_chosen, "run", "left").join(n_missing, "run", "left").na.fill(0, ["n_shots", "n_not_reconstructed"])
    return joined.withColumn("selected_ratio", F.round(F.col("n_both") / F.col("n_selected"), 6)).drop("n_both")


def graph_nodes(edges: DataFrame) -> DataFrame:
    """run, image, degree and strength of each end of edges that have a weight."""
    ends = edges.where("weight IS NOT NULL").select("run", F.explode(F.array("a", "b")).alias("image"), "weight")
    return ends.groupBy("run", "image").agg(F.count("*").alias("degree"), F.sum("weight").alias("strength"))


def weak_images(edges: DataFrame, selected: DataFrame) -> DataFrame:
    """run, image of few or light edges; selected images outside the graph have none."""
    nodes = graph_nodes(edges)
    runs = edges.select("run").distinct()
    absent = selected.select("run", "image").distinct().join(runs, "run", "left_semi").join(nodes, ["run", "image"], "left_anti")
    weak = in_scope(nodes, selected).where((F.col("degree") <= WEAK_DEGREE) | (F.col("strength") < WEAK_STRENGTH))
    return weak.select("run", "image").union(absent)


def tracks_report(edges: DataFrame, selected: DataFrame) -> DataFrame:
    """Edges, their weights, degrees and strengths of the images in scope that the graph has."""
    per_edge = edges.groupBy("run").agg(F.count("*").alias("n_edges"), rounded_quantiles("weight").alias("edge_weight"))
    per_node = in_scope(graph_nodes(edges), selected).groupBy("run").agg(rounded_quantiles("degree").alias("node_degree"), rounded_quantiles("strength").alias("node_strength"))
    weak = weak_images(edges, selected).groupBy("run").agg(F.count("*").alias("n_weak"))
    return per_edge.join(per_node, "run", "left").join(weak, "run", "left").na.fill(0, ["n_weak"])


def image_flags(features: DataFrame, shots: DataFrame, missing: DataFrame, edges: DataFrame, selected: DataFrame) -> DataFrame:
    """run, image and one flag a reason, for every image that has one."""
    kinds = ("zero_features", "low_features", "not_reconstructed", "weak_graph")
    have = shots.select("run").union(missing.select("run")).distinct()
    gone = not_reconstructed(shots, missing, selected.join(have, "run", "left_semi"))
    parts = [feature_flags(features, selected), gone.withColumn("flag", F.lit("not_reconstructed")), weak_images(edges, selected).withColumn("flag", F.lit("weak_graph"))]
    return reduce(DataFrame.unionByName, parts).groupBy("run", "image").agg(*(F.max(F.col("flag") == k).alias(k) for k in kinds))


def audit_runs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """A row a run with all reports as structs (null where a run lacks the file), and the flagged images."""
    rows = artefacts.audit_rows(spark, root)
    selected = rows.where("selected AND image IS NOT NULL").select("run", "image").distinct()
    features, shots, missing, edges = (f(spark, root) for f in (artefacts.features, artefacts.shots, artefacts.reported_missing, artefacts.view_graph))
    reports = {
        "selection": selection_metrics(rows),
        "features": feature_report(features, selected),
        "reconstruction": reconstruction_report(shots, missing, selected).join(artefacts.candidate_pairs(spark, root), "run", "left"),
        "tracks": tracks_report(edges, selected).join(artefacts.track_counts(spark, root), "run", "left"),
        "stats": artefacts.run_stats(spark, root),
        "cameras": artefacts.cameras(spark, root),
    }
    packed = [r.select("run", F.struct(*(c for c in r.columns if c != "run")).alias(n)) for n, r in reports.items()]
    present = artefacts.presence(spark, root)
    present = present.select("run", F.struct(*(c for c in present.columns if c != "run")).alias("artefacts"))
    return reduce(lambda a, b: a.join(b, "run", "left"), [present, *packed]), image_flags(features, shots, missing, edges, selected)


def objective() -> Column:
    """What a sweep over matcher profiles maximises; the factors are fixed values."""
    extra = F.greatest(F.col("match_graph_components") - 1, F.lit(0))
    return 2.0 * F.col("cross_track_solid_ratio") + F.col("algebraic_connectivity") + 0.2 * F.col("track_len_mean") - 0.5 * F.col("reproj_err_px") - 0.5 * extra


def best_profiles(results: DataFrame, sweep: bool = True) -> DataFrame:
    """Of each run's results the first by ``position``, or in a sweep the one of the largest
    objective (the first of equals); nulls and NaN lose."""
    score = F.coalesce(F.nanvl(objective(), F.lit(None)), F.lit(float("-inf"))) if sweep else F.lit(0.0)
    best = F.row_number().over(Window.partitionBy("run").orderBy(score.desc(), "position"))
    return results.withColumn("_rank", best).where("_rank = 1").drop("_rank")
