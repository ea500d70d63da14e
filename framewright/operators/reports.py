"""Reports over a finished selection: health with its gate, summary, decisions, and what coverage lacks.

Frames are labelled ones (:func:`selection.select_keyframes`), cells those of their footprints.  Each
function takes written tables or cheap plans: labelled frames are used several times, so materialise them first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.operators import audit, coverage, parallax
from framewright.operators.selection import SelectionParams
from framewright.storage import materialize


class SelectionFailed(Exception):
    """A selection that its health report fails; the report has been written by then."""


def viewed(labelled: DataFrame, cells: DataFrame) -> DataFrame:
    """The cells of selected frames, with where these were."""
    return cells.join(labelled.where("selected").select("flight", "frame", "easting", "northing", "altamsl"), ["flight", "frame"])


def convergence(labelled: DataFrame, cells: DataFrame, cell_e: float, cell_n: float, ground: DataFrame | None = None) -> DataFrame:
    """Views and largest angle of every viewed cell, over ``ground`` or else flat ground at the median altitude of a flight's frames."""
    seen = viewed(labelled, cells)
    if ground is None:
        height = labelled.groupBy("flight").agg(F.median("altamsl").alias("ground_z"))
        ground = seen.select("flight", "cx", "cy").distinct().join(height, "flight")
    return parallax.convergence_by_cell(parallax.cell_directions(parallax.ground_or_viewer(seen, ground), cell_e, cell_n))


def _gaps(labelled: DataFrame) -> DataFrame:
    """Worst gaps in frames and metres of every flight, 0 without one."""
    gaps = audit.selection_gaps(labelled.where("selected")).withColumn("gap_m", F.round("gap_m", 6))
    frames = audit.worst_gap(gaps, "gap_frames").select("flight", F.col("gap_frames").alias("max_temporal_gap"), F.col("frame").alias("temporal_gap_frame"))
    metres = audit.worst_gap(gaps).select("flight", F.col("gap_m").alias("max_motion_gap_m"), F.col("frame").alias("motion_gap_frame"))
    return frames.join(metres, "flight", "full")


def health(labelled: DataFrame, cells: DataFrame, p: SelectionParams, angles: DataFrame) -> DataFrame:
    """One row a flight: gaps, fullest cluster, coverage, parallax, ``warnings``, ``failures`` and ``passed``.
    A flight without mission cells is not gated on coverage; gaps and parallax never fail one."""
    mission = coverage.mission_cells(cells)
    views = coverage.view_counts(labelled.where("selected"), cells)
    found = coverage.coverage_metrics(mission, views, p.target_views, p.bin_m**2)
    chosen = labelled.groupBy("flight").agg(F.count_if("selected").alias("n_selected"))
    dense = audit.local_density(labelled.where("selected"), p.cluster_m).select("flight", F.col("population").alias("max_cluster_size"), F.col("members").alias("largest_cluster"))
    seen = parallax.parallax_metrics(angles, p.parallax_views, p.parallax_deg).select("flight", "n_satisfied", "satisfied_share", F.col("p50").alias("median_convergence_deg"))
    row = chosen
    for part in (_gaps(labelled), dense, found, seen):
        row = row.join(part, "flight", "left")
    row = row.na.fill(0, ["max_temporal_gap", "max_motion_gap_m", "max_cluster_size"])
    percent = F.rint(F.col("covered_share") * 100).cast("long").cast("string")
    share = F.concat(F.lit("only "), percent, F.lit(f"% of mission cells covered (need {p.least_covered:.0%}); budget likely too small"))
    some = (F.col("n_selected") > 0) & (F.col("n_covered") > 0) & (F.col("n_mission") > 0)
    failures = [F.when(F.col("n_selected") == 0, "no frames selected"), F.when(some & (F.col("covered_share") < p.least_covered), share)]
    wide = F.when((F.col("n_selected") > 0) & (F.col("max_motion_gap_m") > p.max_gap_m), "motion gap over the limit")
    row = row.withColumns({"warnings": F.array_compact(F.array(wide)), "failures": F.array_compact(F.array(*failures))})
    return row.withColumn("passed", F.size("failures") == 0)


def require_passed(report: DataFrame) -> None:
    """Raises with the first failures of a written health report."""
    failed = report.where("NOT passed").select("flight", "failures").orderBy("flight").limit(20).collect()
    if failed:
        raise SelectionFailed("; ".join(f"{r.flight}: {', '.join(r.failures)}" for r in failed))


def reason_counts(labelled: DataFrame) -> DataFrame:
    """flight, reason and n of the frames that are not selected; a frame without a reason counts under null."""
    return labelled.where("NOT selected").groupBy("flight", F.col("reject_reason").alias("reason")).agg(F.count("*").alias("n"))


def decisions(audited: DataFrame, most: int = 20) -> DataFrame:
    """Per flight with selected frames: counts of selection reasons as a map, the median and largest bin rank of
    selected frames and, where frames have ``coverage_gain_cells``, how many gained nothing and the first of those."""
    chosen = audited.where("selected")
    reasons = chosen.groupBy("flight", F.coalesce("selection_reason", F.lit("<NA>")).alias("reason")).agg(F.count("*").alias("n"))
    reasons = reasons.groupBy("flight").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("selection_reason_counts"))
    ranks = chosen.groupBy("flight").agg(F.median("bin_rank").alias("bin_rank_median"), F.max("bin_rank").alias("bin_rank_max"))
    out = reasons.join(ranks, "flight")
    if "coverage_gain_cells" in audited.columns:
        none = chosen.where("coalesce(coverage_gain_cells, 0) <= 0")
        order = F.row_number().over(audit.by_frame())
        first = none.withColumn("rn", order).groupBy("flight").agg(F.count("*").alias("n_marginal"), F.array_sort(F.collect_list(F.when(F.col("rn") <= most, F.col("frame")))).alias("marginal_frames"))
        out = out.join(first, "flight", "left").na.fill(0, ["n_marginal"])
    return out


def summary(labelled: DataFrame, cells: DataFrame, p: SelectionParams) -> DataFrame:
    """One row a flight: counts, reject reasons, coverage with its histogram, gaps that warn, and quality of the selected."""
    n = labelled.groupBy("flight").agg(F.count("*").alias("n_candidates"), F.count_if("selected").alias("n_selected"))
    as_map = lambda rows, k, name: rows.groupBy("flight").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, "n")))).alias(name))
    reasons = reason_counts(labelled).withColumn("reason", F.coalesce("reason", F.lit("<NA>")))
    views = coverage.view_counts(labelled.where("selected"), cells)
    metrics = coverage.coverage_metrics(coverage.mission_cells(cells), views, p.target_views, p.bin_m**2)
    histogram = coverage.views_histogram(views).withColumnRenamed("n_cells", "n")
    gaps = audit.selection_gaps(labelled.where("selected")).groupBy("flight").agg(F.count("*").alias("n_gaps"), F.count_if(F.col("gap_m") > p.warn_gap_m).alias("n_coverage_gaps"))
    q = lambda f: F.round(f("quality_score"), 4)
    quality = labelled.where("selected").groupBy("flight").agg(q(F.min).alias("quality_min"), q(F.median).alias("quality_median"), q(F.max).alias("quality_max"))
    for part in (as_map(reasons, "reason", "reject_counts"), metrics, as_map(histogram, "views", "views_histogram"), gaps, quality):
        n = n.join(part, "flight", "left")
    return n.na.fill(0, ["n_gaps", "n_coverage_gaps"])


def gap_lists(labelled: DataFrame, p: SelectionParams) -> DataFrame:
    """Per flight the gaps between its selected frames as arrays, in order: all of them (their number is bounded by the
    budget) in ``temporal_gaps``, and those over ``warn_gap_m`` in ``coverage_gaps``."""
    gaps = audit.selection_gaps(labelled.where("selected"))
    gaps = gaps.select("flight", (F.col("frame") - F.col("gap_frames")).alias("from_frame"), F.col("frame").alias("to_frame"), "gap_frames", F.round("gap_m", 2).alias("gap_m"), (F.col("gap_m") > p.warn_gap_m).alias("wide"))
    each = F.array_sort(F.collect_list(F.struct("from_frame", "to_frame", "gap_frames", "gap_m")))
    wide = F.array_sort(F.collect_list(F.when(F.col("wide"), F.struct("from_frame", "to_frame", "gap_m"))))
    return gaps.groupBy("flight").agg(each.alias("temporal_gaps"), wide.alias("coverage_gaps"))


def hole_lists(holes: DataFrame, grid: DataFrame | None = None, top: int = 10) -> DataFrame:
    """Per flight its largest holes as an array, with centres on the map if ``grid`` has the flights' origins."""
    placed = holes.where(F.col("rank") <= top)
    if grid is not None:
        placed = placed.join(grid, "flight").withColumns({"centroid_e": F.col("centroid_e") + F.col("origin_e"), "centroid_n": F.col("centroid_n") + F.col("origin_n")})
    listed = F.array_sort(F.collect_list(F.struct("rank", "size", "area_m2", "centroid_e", "centroid_n")))
    return placed.groupBy("flight").agg(listed.alias("largest_holes"))


def whole_summary(audited: DataFrame, cells: DataFrame, p: SelectionParams, angles: DataFrame, found: DataFrame, cell_e: float, cell_n: float, grid: DataFrame | None = None) -> DataFrame:
    """All that is known of a selection, a row a flight: the columns of :func:`summary`, and the blocks ``constants``,
    ``decisions``, ``temporal_gaps``, ``coverage_gaps``, ``insight`` (coverage_holes and, with a selected frame, parallax) and ``health``.

    ``audited``: labelled frames with bin_rank (:func:`audit.audit_table`); ``angles``: of :func:`convergence`; ``found``: their
    :func:`health`; ``grid``: flight, origin_e, origin_n of the cells."""
    mission, views = coverage.mission_cells(cells), coverage.view_counts(audited.where("selected"), cells)
    holes = materialize(coverage.coverage_holes(mission, views, p.target_views, cell_e, cell_n), "holes")
    totals = mission.select("flight").distinct().join(coverage.hole_totals(holes).drop("largest"), "flight", "left").na.fill(0, ["n_holes", "n_under_target", "hole_area_m2"])
    lacks = totals.join(hole_lists(holes, grid), "flight", "left")
    seen = parallax.parallax_metrics(angles, p.parallax_views, p.parallax_deg)
    block = lambda df, name: df.select("flight", F.struct(*(c for c in df.columns if c != "flight")).alias(name))
    lacks = block(lacks, "coverage_holes").join(block(seen, "parallax"), "flight", "left")
    constants = F.struct(*((F.array(*map(F.lit, v)) if isinstance(v, tuple) else F.lit(v)).alias(k) for k, v in p.constants().items()))
    out = summary(audited, cells, p).withColumn("constants", constants)
    for part in (block(decisions(audited), "decisions"), gap_lists(audited, p), block(lacks, "insight"), block(found, "health")):
        out = out.join(part, "flight", "left")
    return out


def insight(labelled: DataFrame, cells: DataFrame, p: SelectionParams, angles: DataFrame, cell_e: float, cell_n: float, origin: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """One row a flight with mission cells: holes in numbers, and parallax if anything is selected."""
    mission, views = coverage.mission_cells(cells), coverage.view_counts(labelled.where("selected"), cells)
    holes = materialize(coverage.coverage_holes(mission, views, p.target_views, cell_e, cell_n, origin), "holes")
    flights = mission.select("flight").distinct()
    found = flights.join(coverage.hole_totals(holes), "flight", "left").na.fill(0, ["n_holes", "n_under_target", "hole_area_m2"])
    return found.join(parallax.parallax_metrics(angles, p.parallax_views, p.parallax_deg), "flight", "left")
