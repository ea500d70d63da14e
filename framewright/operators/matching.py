"""Which frames see the same ground, and what a matcher made of it."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.components import connected_components
from framewright.functions.spectrum import ERROR, algebraic_connectivity
from framewright.operators.parallax import angle_deg, with_axis
from framewright.storage import materialize

#: Nodes of a component whose matrix one task may solve (32 MB), and edges of one that it may hold (some 500 MB).
MOST_DENSE, MOST_EDGES = 2_000, 2_000_000
#: Frames that see one block of ground and are paired by a join; of more, those of a tile.
MOST_IN_BLOCK = 512


def covis_vertices(frames: DataFrame, cells: DataFrame) -> DataFrame:
    """The frames that have a cell of a valid footprint: what the graph is made of."""
    return frames.join(cells.where("footprint_valid").select("flight", "frame").distinct(), ["flight", "frame"], "left_semi")


def block_overlaps(cells: DataFrame, most: int = MOST_IN_BLOCK) -> DataFrame:
    """flight, i < j and ``shared``: for every two frames and every block of ground that both see, how many cells of it.

    A flight's blocks are squares as wide as its footprints are on average, so a pair meets in a few blocks (4, if
    no footprint is wider) and not in each of its cells.  Blocks of up to ``most`` frames are an equi-join on the block.
    In fuller ones (hovering) the frames are dealt into tiles of ``most``, and each pair of tiles is a product of
    two matrices of frames by cells in a task of its own."""
    key = ["flight", "bx", "by"]
    wide = cells.groupBy("flight", "frame").agg(F.greatest(F.max("cx") - F.min("cx"), F.max("cy") - F.min("cy")).alias("width"))
    side = wide.groupBy("flight").agg((F.ceil(F.avg("width")) + 1).alias("side"))
    at = cells.select("flight", "frame", "cx", "cy").join(side, "flight")
    within = lambda c: F.pmod(c, "side")
    placed = at.select("flight", F.floor(F.col("cx") / F.col("side")).alias("bx"), F.floor(F.col("cy") / F.col("side")).alias("by"), "frame", (within("cx") * F.col("side") + within("cy")).alias("cell"))
    parts = materialize(placed.groupBy(*key, "frame").agg(F.collect_set("cell").alias("seen")), "block-parts")
    full = parts.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > most)
    full = full.select(*key, F.ceil(F.col("n") / most).cast("int").alias("tiles"))
    few = parts.join(full, key, "left_anti")
    pairs = few.withColumnRenamed("frame", "i").join(few.select(*key, F.col("frame").alias("j"), F.col("seen").alias("also")), key).where("i < j")
    pairs = pairs.select("flight", "i", "j", F.size(F.array_intersect("seen", "also")).cast("long").alias("shared")).where("shared > 0")
    own = F.pmod(F.xxhash64("frame"), F.col("tiles")).cast("int").alias("own")
    tiled = parts.join(full, key).select(*key, "frame", "seen", own, F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    tiled = tiled.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other")

    def product(rows: pa.Table) -> pa.Table:
        import numpy as np

        seen = rows.column("seen").combine_chunks()
        at, cell = np.unique(seen.flatten().to_numpy(), return_inverse=True)
        m = np.zeros((rows.num_rows, len(at)), np.float32)
        m[np.repeat(np.arange(rows.num_rows), seen.value_lengths().to_numpy()), cell] = 1
        frame, tile = (rows.column(c).to_numpy() for c in ("frame", "own"))
        first, second = (np.flatnonzero(tile == rows.column(c)[0].as_py()) for c in ("low", "high"))
        shared = (m[first] @ m[second].T).astype(np.int64)
        a, b = np.nonzero(shared * (frame[first][:, None] < frame[second] if rows.column("low")[0] == rows.column("high")[0] else 1))
        i, j = frame[first][a], frame[second][b]
        flight = rows.column("flight").take(pa.array(np.zeros(len(a), np.int64)))
        return pa.table([flight, pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j)), pa.array(shared[a, b])], names=["flight", "i", "j", "shared"])

    kinds = {c: cells.schema[c].dataType.simpleString() for c in ("flight", "frame")}
    return pairs.union(tiled.groupBy(*key, "low", "high").applyInArrow(product, f"flight {kinds['flight']}, i {kinds['frame']}, j {kinds['frame']}, shared long"))


def covis_edges(cells: DataFrame, frames: DataFrame, min_iom: float = 0.10, max_angle_deg: float | None = 45.0) -> DataFrame:
    """Pairs i < j of one flight that share cells: shared, iom (over the smaller footprint), dist_m and
    view_angle_deg between the optical axes (null if one is unknown), at most ``max_angle_deg`` where known.
    Only frames that see the same block of ground are ever paired (:func:`block_overlaps`); frames: flight, frame, easting,
    northing, pitch_rad, yaw_rad."""
    cells = cells.join(frames.select("flight", "frame"), ["flight", "frame"], "left_semi")
    shared = block_overlaps(cells).groupBy("flight", "i", "j").agg(F.sum("shared").alias("shared"))
    size = cells.groupBy("flight", "frame").agg(F.count("*").alias("n"))
    known = ("n", "easting", "northing", "ax", "ay", "az")
    at = size.join(with_axis(frames).select("flight", "frame", *known[1:]), ["flight", "frame"])
    side = lambda k: at.select("flight", F.col("frame").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in known))
    iom = F.col("shared") / F.least("n_i", "n_j")
    dist = F.hypot(F.col("easting_i") - F.col("easting_j"), F.col("northing_i") - F.col("northing_j"))
    angle = angle_deg(*(tuple(F.col(f"{c}_{k}") for c in ("ax", "ay", "az")) for k in "ij"))
    found = shared.join(side("i"), ["flight", "i"]).join(side("j"), ["flight", "j"])
    found = found.select("flight", "i", "j", "shared", iom.alias("iom"), dist.alias("dist_m"), angle.alias("view_angle_deg")).where(F.col("iom") >= min_iom)
    return found if max_angle_deg is None else found.where(F.coalesce(F.col("view_angle_deg") <= max_angle_deg, F.lit(True)))


def degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """flight, frame, degree; frames without an edge have 0."""
    ends = edges.select("flight", F.explode(F.array("i", "j")).alias("frame")).groupBy("flight", "frame").agg(F.count("*").alias("degree"))
    return vertices.select("flight", "frame").distinct().join(ends, ["flight", "frame"], "left").select("flight", "frame", F.coalesce("degree", F.lit(0)).alias("degree"))


def covis_summary(vertices: DataFrame, edges: DataFrame, far_rank: int = 16) -> DataFrame:
    """Per flight: vertices, edges, edges whose ranks lie over ``far_rank`` apart and their share, quantiles of
    degrees and edge lengths (0 without edges)."""
    rank = vertices.select("flight", "frame").distinct().withColumn("r", F.row_number().over(Window.partitionBy("flight").orderBy("frame")))
    e = edges.join(rank.select("flight", F.col("frame").alias("i"), F.col("r").alias("ri")), ["flight", "i"]).join(rank.select("flight", F.col("frame").alias("j"), F.col("r").alias("rj")), ["flight", "j"])
    reach = [F.percentile("dist_m", F.lit(q)).alias(n) for q, n in ((0.5, "reach_p50"), (0.95, "reach_p95"))]
    e = e.groupBy("flight").agg(F.count("*").alias("n_edges"), F.count_if(F.col("rj") - F.col("ri") > far_rank).alias("n_cross"), *reach, F.max("dist_m").alias("reach_max"))
    d = degrees(vertices, edges).groupBy("flight").agg(F.count("*").alias("n"), F.percentile("degree", F.lit(0.5)).alias("degree_p50"), F.percentile("degree", F.lit(0.95)).alias("degree_p95"), F.max("degree").alias("degree_max"))
    zero = lambda c, t="long": F.coalesce(c, F.lit(0)).cast(t).alias(c)
    share = F.coalesce(F.col("n_cross") / F.col("n_edges"), F.lit(0.0)).alias("cross_share")
    return d.join(e, "flight", "left").select("flight", "n", zero("n_edges"), zero("n_cross"), share, "degree_p50", "degree_p95", "degree_max", *(zero(c, "double") for c in ("reach_p50", "reach_p95", "reach_max")))


def pair_budget(edges: DataFrame, budget: int) -> DataFrame:
    """Edges among the ``budget`` best by iom of either end."""
    best = Window.partitionBy("flight", "node").orderBy(F.col("iom").desc(), "i", "j")
    ends = edges.withColumn("node", F.explode(F.array("i", "j"))).withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= budget)
    return ends.select("flight", "i", "j", "iom").distinct()


def matcher_profile(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Neighbours (95th percentile of degrees, 8 to 64) and distance (of edge lengths)."""
    p = F.percentile("degree", F.lit(0.95))
    d = degrees(vertices, edges).groupBy("flight").agg(F.least(F.greatest(F.ceil(p), F.lit(8)), F.lit(64)).cast("long").alias("neighbours"))
    e = edges.groupBy("flight").agg(F.round(F.percentile("dist_m", F.lit(0.95)), 2).alias("distance_m"))
    return d.join(e, "flight", "left").select("flight", F.when(F.col("distance_m").isNull(), 8).otherwise(F.col("neighbours")).cast("long").alias("neighbours"), F.coalesce("distance_m", F.lit(0.0)).alias("distance_m"))


def footprint_jaccard(cells: DataFrame) -> DataFrame:
    """Jaccard similarity of the footprints of consecutive frames."""
    sets = cells.groupBy("flight", "frame").agg(F.collect_set(F.struct("cx", "cy")).alias("c"))
    w = Window.partitionBy("flight").orderBy("frame")
    pairs = sets.select("flight", "frame", "c", F.lag("c").over(w).alias("before")).where("before IS NOT NULL")
    return pairs.select("flight", "frame", (F.size(F.array_intersect("c", "before")) / F.size(F.array_union("c", "before"))).alias("jaccard"))


def solid_pairs(matches: DataFrame, min_inliers: int) -> DataFrame:
    """a < b with the most inliers of both directions, from ``min_inliers`` up."""
    return matches.where((F.col("inliers") >= min_inliers) & (F.col("a") != F.col("b"))).groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("inliers").alias("inliers"))


def match_images(matches: DataFrame) -> DataFrame:
    """``node``: every image that has matches or is a partner, solid or not; a partner may be null."""
    return matches.select(F.explode(F.array("a", "b")).alias("node")).where("node IS NOT NULL").distinct()


def components_of(images: DataFrame, pairs: DataFrame) -> DataFrame:
    """node and component; images without a pair are components of their own."""
    found = components(pairs)
    return images.select("node").distinct().join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def degree_strength(pairs: DataFrame) -> DataFrame:
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"), "inliers")
    return ends.groupBy("node").agg(F.count("*").alias("degree"), F.sum("inliers").cast("long").alias("strength"))


def weak_nodes(scope: DataFrame, pairs: DataFrame, degree: int = 5, strength: int = 100) -> DataFrame:
    """Nodes of the scope with few or thin edges; those absent from the graph count as degree 0."""
    d = scope.select("node").distinct().join(degree_strength(pairs), "node", "left").select("node", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("strength", F.lit(0)).alias("strength"))
    return d.where((F.col("degree") <= degree) | (F.col("strength") < strength))


def recall_precision(predicted: DataFrame, solid: DataFrame) -> DataFrame:
    """One row: pairs predicted, solid and both; recall is the share of the predicted pairs that are solid,
    precision that of the solid ones that were predicted (so named by those who read these scores)."""
    both = predicted.select("a", "b").join(solid.select("a", "b"), ["a", "b"]).agg(F.count("*").alias("n_both"))
    one = predicted.agg(F.count("*").alias("n_predicted")).crossJoin(solid.agg(F.count("*").alias("n_solid"))).crossJoin(both)  # three rows of one
    return one.select("*", (F.col("n_both") / F.nullif("n_predicted", F.lit(0))).alias("recall"), (F.col("n_both") / F.nullif("n_solid", F.lit(0))).alias("precision"))


def weighted_median(histogram: DataFrame, value: str, weight: str) -> DataFrame:
    """First value at which the weights up to it reach half of all; the rows are a histogram."""
    w = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = histogram.groupBy(value).agg(F.sum(weight).alias("w"))
    total = h.agg(F.sum("w").alias("total"))
    return h.withColumn("cum", F.sum("w").over(w)).crossJoin(total).where("2 * cum >= total").agg(F.min(value).alias("median"))  # total is one row


def components(pairs: DataFrame) -> DataFrame:
    """node and component (its least node) of the nodes that have a pair, by contraction."""
    edges = pairs.select("a", "b")
    if edges.schema["a"].dataType.simpleString() == "bigint":
        found = connected_components(edges)
    else:  # contraction is over longs
        nodes = edges.select("a").union(edges.select("b")).distinct().select(F.col("a").alias("node"), F.monotonically_increasing_id().alias("id"))
        nodes = materialize(nodes, "nodes")
        of = lambda c: nodes.select(F.col("node").alias(c), F.col("id").alias(f"id_{c}"))
        numbered = edges.join(of("a"), "a").join(of("b"), "b").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
        found = connected_components(numbered).withColumnRenamed("node", "id").join(nodes, "id").select("node", "root")
    found = materialize(found, "roots")
    return found.join(found.groupBy("root").agg(F.min("node").alias("component")), "root").select("node", "component")


def _dense_fiedler(edges: DataFrame) -> DataFrame:
    """Of one small component, by its whole matrix."""

    def solve(group):
        import numpy as np
        import pandas as pd

        nodes, at = np.unique(group[["a", "b"]].to_numpy(), return_inverse=True)
        i, j = at.reshape(-1, 2).T
        m = np.zeros((len(nodes), len(nodes)))
        m[i, j] = m[j, i] = 1
        d = 1 / np.sqrt(m.sum(axis=0))
        values = np.linalg.eigvalsh(np.eye(len(nodes)) - d[:, None] * m * d)
        return pd.DataFrame({"component": [group["component"].iloc[0]], "n": [len(nodes)], "fiedler": [float(values[1])]})

    kind = edges.schema["component"].dataType.simpleString()
    return edges.groupBy("component").applyInPandas(solve, f"component {kind}, n long, fiedler double")


def _sparse_fiedler(edges: DataFrame) -> DataFrame:
    """Of one component whose edges fit one task."""

    def solve(group):
        import numpy as np
        import pandas as pd

        nodes, at = np.unique(group[["a", "b"]].to_numpy(), return_inverse=True)
        i, j = at.reshape(-1, 2).T
        return pd.DataFrame({"component": group["component"].iloc[:1], "n": [len(nodes)], "fiedler": [algebraic_connectivity(i, j, len(nodes))]})

    kind = edges.schema["component"].dataType.simpleString()
    return edges.groupBy("component").applyInPandas(solve, f"component {kind}, n long, fiedler double")


def fiedler_value(pairs: DataFrame, comp: DataFrame, rounds: int = 200, dense: int = MOST_DENSE, sparse: int = MOST_EDGES) -> DataFrame:
    """component, n and fiedler: the second least eigenvalue of the normalised Laplacian of the largest component
    (the first of equals); 0 of a lone node, no row without nodes.

    Up to ``dense`` nodes the matrix is solved in one task, and up to ``sparse`` edges the graph is
    (:func:`algebraic_connectivity`).  Beyond that it is never in one place: Lanczos steps multiply a vector, a table of one
    number a node, by the edges in a join and keep it orthogonal to the known eigenvector (roots of degrees); the
    driver holds the two numbers of each step.  A value is returned only when the residual bounds its relative error by
    ``ERROR``; else, after ``rounds`` steps, it raises."""
    import numpy as np

    top = comp.groupBy("component").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "component").limit(1).collect()
    kinds = f"component {comp.schema['component'].dataType.simpleString()}, n long, fiedler double"
    if not top or top[0].n < 2:
        return comp.sparkSession.createDataFrame([(r.component, r.n, 0.0) for r in top], kinds)
    inside = comp.where(F.col("component") == top[0].component)
    edges = pairs.join(inside.select(F.col("node").alias("a")), "a", "left_semi").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    named = edges.withColumn("component", F.lit(top[0].component))
    if top[0].n <= dense:
        return _dense_fiedler(named)
    edges = materialize(edges, "edges")
    if edges.count() <= sparse:
        return _sparse_fiedler(edges.withColumn("component", F.lit(top[0].component)))
    both = edges.union(edges.select("b", "a"))
    degree = both.groupBy("a").agg(F.count("*").alias("d"))
    weight = both.join(degree, "a").join(degree.select(F.col("a").alias("b"), F.col("d").alias("e")), "b").select("a", "b", (1 / F.sqrt(F.col("d") * F.col("e"))).alias("w"))
    weight, degree = materialize(weight, "weights"), materialize(degree.select("a", F.sqrt("d").alias("root")), "degrees")
    total = weight.count()
    # a vector that no symmetry of the graph makes orthogonal to the wanted one
    x = degree.select("a", "root", (F.pmod(F.xxhash64("a"), F.lit(1_000_003)) / 1_000_003 - 0.5).alias("x"), F.lit(0.0).alias("before"))
    away = lambda t, c: F.col(c) - F.lit(t.agg(F.sum(F.col(c) * F.col("root"))).first()[0] / total) * F.col("root")
    x = materialize(x.withColumn("x", away(x, "x")), "vector")
    norm = float(np.sqrt(x.agg(F.sum(F.col("x") * F.col("x"))).first()[0]))
    x, alphas, betas = x.withColumn("x", F.col("x") / norm), [], [0.0]
    for _ in range(rounds):
        moved = weight.join(x.select(F.col("a").alias("b"), F.col("x").alias("y")), "b").groupBy("a").agg(F.sum(F.col("w") * F.col("y")).alias("ax"))
        step = materialize(x.join(moved, "a"), "vector")
        alphas.append(step.agg(F.sum(F.col("ax") * F.col("x"))).first()[0])
        rest = step.select("a", "root", "x", (F.col("ax") - alphas[-1] * F.col("x") - betas[-1] * F.col("before")).alias("r"))
        rest = materialize(rest.withColumn("r", away(rest, "r")), "vector")
        beta = float(np.sqrt(rest.agg(F.sum(F.col("r") * F.col("r"))).first()[0]))
        each, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(betas[1:], 1) + np.diag(betas[1:], -1))
        value, residual = 1 - float(each[-1]), beta * abs(float(vectors[-1, -1]))
        if residual <= max(ERROR * value, 1e-14):
            return comp.sparkSession.createDataFrame([(top[0].component, top[0].n, value)], kinds)
        betas.append(beta)
        x = rest.select("a", "root", (F.col("r") / beta).alias("x"), F.col("x").alias("before"))
    raise ValueError(f"the algebraic connectivity of {top[0].n} images is not known to {ERROR:g} after {rounds} steps: residual {residual:g} of {value:g}")


def scoreboard(matches: DataFrame, named: DataFrame, histogram: DataFrame, stats: DataFrame, predicted: DataFrame, min_inliers: int = 20, far_rank: int = 16) -> DataFrame:
    """One row over one run: images, solid pairs and those across tracks, components, algebraic connectivity, track
    lengths, errors, and recall and precision of the predicted pairs (null where there is nothing to divide by).

    ``matches``: a, b, inliers of images by file name, b null for an image without partner; ``named``: node, the images of
    the geo file; ``histogram``: length, n; ``stats``: one row of average_track_length, reprojection_error_pixels,
    initial_shots, reconstructed_shots, ce90, le90, nulls where unknown; ``predicted``: a < b."""
    pairs = materialize(solid_pairs(matches, min_inliers), "solid-pairs")
    images = match_images(matches).union(named.select("node")).distinct()
    number = F.coalesce(F.split_part("node", F.lit("."), F.lit(1)).try_cast("long"), F.lit(0))
    rank = images.select("node", F.row_number().over(Window.orderBy(number, "node")).alias("r"))  # images of one run
    comp = materialize(components_of(images, pairs), "components")
    ranked = pairs.join(rank.select(F.col("node").alias("a"), F.col("r").alias("ra")), "a").join(rank.select(F.col("node").alias("b"), F.col("r").alias("rb")), "b")
    of_pairs = ranked.agg(F.count("*").alias("solid_pairs"), F.coalesce(F.avg("inliers"), F.lit(0.0)).alias("mean_inliers"), F.count_if(F.abs(F.col("ra") - F.col("rb")) > far_rank).alias("cross_track_solid_pairs"))
    of_comp = comp.agg(F.count("*").alias("n_images"), F.countDistinct("component").alias("match_graph_components"))
    fiedler = fiedler_value(pairs, comp).agg(F.coalesce(F.max("fiedler"), F.lit(0.0)).alias("algebraic_connectivity"))
    median = weighted_median(histogram, "length", "n").select(F.coalesce(F.col("median").cast("double"), F.lit(0.0)).alias("track_len_median"))
    found = recall_precision(predicted, pairs).select("recall", "precision")
    one = of_comp.crossJoin(of_pairs).crossJoin(fiedler).crossJoin(median).crossJoin(found).crossJoin(stats)  # rows of one each
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(b, F.lit(0)), F.lit(0.0))
    return one.select(
        "n_images", "solid_pairs", "mean_inliers", "cross_track_solid_pairs", share("cross_track_solid_pairs", "solid_pairs").alias("cross_track_solid_ratio"), "match_graph_components", "algebraic_connectivity",
        zero("average_track_length").alias("track_len_mean"), "track_len_median", zero("reprojection_error_pixels").alias("reproj_err_px"), share("reconstructed_shots", "initial_shots").alias("recon_shot_frac"),
        F.col("ce90").alias("gps_ce90"), F.col("le90").alias("gps_le90"), F.col("recall").alias("covis_recall"), F.col("precision").alias("covis_precision"),
    )
