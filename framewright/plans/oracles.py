"""Plain SQL for the queries, as chains of named subqueries."""

from __future__ import annotations

from framewright.plans import adapter
from framewright.plans.queries import AUDIT_BIN_M, BIN_M, CELL_M2, DENSITY_M, HEIGHTS, LEAST_INLIERS, MARGIN_M, P, PAIR_BUDGET, RASTER_CELL, RASTER_COLS, RASTER_E, RASTER_N, REACH_M, TOP_HOLES, WARN_GAP_M

_E, _N = adapter.CELL_E, adapter.CELL_N
_SHARE = "({c} - min({c}) OVER f) / (max({c}) OVER f - min({c}) OVER f + 1e-9)"

CHAIN = {
    "frames": adapter.FRAMES.format(events="events"),
    "cells": adapter.FOOTPRINTS.format(frames="frames"),
    "scored": f"SELECT *, {P.feature_weight} * ({_SHARE.format(c='feature_count')}) + {1 - P.feature_weight} * ({_SHARE.format(c='sharpness')}) AS quality_score FROM frames WINDOW f AS (PARTITION BY flight)",
    "p5": "SELECT flight, quantile_cont(altamsl, 0.05) AS p5, min(altamsl) AS rest, min(frame) AS lo, max(frame) AS hi, count(*) AS n FROM frames GROUP BY flight",
    "noise": "SELECT flight, coalesce(stddev_pop(altamsl) FILTER (WHERE altamsl < p5), 0) AS noise FROM frames JOIN p5 USING (flight) GROUP BY flight",
    "up": f"SELECT * FROM (SELECT flight, frame, n, altamsl > rest + greatest({P.rise_m}, 5 * noise) AS up, row_number() OVER (PARTITION BY flight ORDER BY frame) AS rn FROM frames JOIN p5 USING (flight) JOIN noise USING (flight)) WHERE up",
    "runs": f"SELECT flight, count(*) AS len, min(frame) AS a, max(frame) AS b, count(*) >= least({P.min_island}, max(n)) AS long FROM (SELECT *, rn - row_number() OVER (PARTITION BY flight ORDER BY frame) AS island FROM up) GROUP BY flight, island",
    "span": "SELECT flight, min(a) AS a, max(b) AS b FROM (SELECT *, bool_or(long) OVER (PARTITION BY flight) AS any_long FROM runs) WHERE long OR NOT any_long GROUP BY flight",
    "airborne": "SELECT flight, coalesce(a, lo) AS first_frame, coalesce(b, hi) AS last_frame FROM p5 LEFT JOIN span USING (flight)",
    "early": f"""SELECT *, CASE WHEN NOT coalesce(altamsl >= {P.min_altitude_m}, false) THEN 'below_altitude' WHEN frame NOT BETWEEN first_frame AND last_frame THEN 'on_ground'
               WHEN quality_score IS NULL THEN 'missing_quality_score' WHEN NOT coalesce(footprint_valid, false) THEN 'invalid_footprint' END AS e FROM scored JOIN airborne USING (flight)""",
    "floors": f"SELECT flight, quantile_cont(agl_m, 0.5) FILTER (WHERE e IS NULL) / {P.gsd_ratio} AS gsd_floor FROM early GROUP BY flight",
    "gated": "SELECT early.*, gsd_floor, CASE WHEN e IS NULL AND coalesce(agl_m < gsd_floor, false) THEN 'fine_gsd' ELSE e END AS reason FROM early JOIN floors USING (flight)",
    "pool": "SELECT flight, frame, easting, northing, quality_score, row_number() OVER (PARTITION BY flight ORDER BY frame) AS rn FROM gated WHERE reason IS NULL",
    "walk": f"""SELECT flight, frame, rn, easting AS e, northing AS n, true AS keep FROM pool WHERE rn = 1 UNION ALL
              SELECT p.flight, p.frame, p.rn, CASE WHEN far THEN p.easting ELSE e END, CASE WHEN far THEN p.northing ELSE n END, far
              FROM (SELECT p.*, w.e, w.n, (p.easting - w.e) * (p.easting - w.e) + (p.northing - w.n) * (p.northing - w.n) >= {P.spacing_m**2} AS far FROM walk w JOIN pool p ON p.flight = w.flight AND p.rn = w.rn + 1) p""",
    "spaced": "SELECT p.* FROM walk JOIN pool p USING (flight, frame) WHERE keep",
    "kept": f"""SELECT flight, frame FROM (SELECT *, row_number() OVER (PARTITION BY flight, b ORDER BY quality_score DESC, frame) AS k
              FROM (SELECT *, count(*) OVER (PARTITION BY flight) AS n, ntile({P.max_frames}) OVER (PARTITION BY flight ORDER BY frame) AS b FROM spaced)) WHERE n <= {P.max_frames} OR k = 1""",
    "labelled": """SELECT g.*, k.frame IS NOT NULL AS selected, CASE WHEN reason IS NOT NULL THEN reason WHEN k.frame IS NOT NULL THEN NULL WHEN s.frame IS NOT NULL THEN 'thinned_by_budget' ELSE 'redundant_spacing' END AS reject_reason
                 FROM gated g LEFT JOIN spaced s ON g.flight = s.flight AND g.frame = s.frame LEFT JOIN kept k ON g.flight = k.flight AND g.frame = k.frame""",
    "chosen": "SELECT * FROM labelled WHERE selected",
    "views": "SELECT flight, cx, cy, count(*) AS views FROM cells SEMI JOIN chosen USING (flight, frame) GROUP BY ALL",
    "mission": "SELECT DISTINCT flight, cx, cy FROM cells WHERE footprint_valid",
    "status": f"SELECT flight, cx, cy, CASE WHEN views IS NULL THEN 0 WHEN views < {P.target_views} THEN 1 ELSE 2 END AS status FROM mission LEFT JOIN views USING (flight, cx, cy)",
    "metrics": f"""SELECT flight, n_mission, coalesce(n_covered, 0) AS n_covered, coalesce(n_at_target, 0) AS n_at_target, coalesce(n_at_double, 0) AS n_at_double, coalesce(n_covered, 0) / greatest(n_mission, 1)::DOUBLE AS covered_share, coalesce(n_at_target / n_covered::DOUBLE, 0) AS covered_at_target,
                 coalesce(n_at_target, 0) / greatest(n_mission, 1)::DOUBLE AS mission_at_target, coalesce(mean_views, 0) AS mean_views, coalesce(max_views, 0) AS max_views, coalesce(n_at_double * {CELL_M2}::DOUBLE, 0) AS over_coverage_m2
                 FROM (SELECT flight, count(*) AS n_mission FROM mission GROUP BY flight) LEFT JOIN (SELECT flight, count(*) AS n_covered, count(1) FILTER (WHERE views >= {P.target_views}) AS n_at_target, count(1) FILTER (WHERE views >= {2 * P.target_views}) AS n_at_double, avg(views) AS mean_views, max(views) AS max_views FROM views GROUP BY flight) USING (flight)""",
    "gaps": "SELECT * FROM (SELECT flight, frame, frame - lag(frame) OVER w AS gap_frames, round(sqrt((easting - lag(easting) OVER w) * (easting - lag(easting) OVER w) + (northing - lag(northing) OVER w) * (northing - lag(northing) OVER w)), 6) AS gap_m FROM chosen WINDOW w AS (PARTITION BY flight ORDER BY frame)) WHERE gap_frames IS NOT NULL",
    "worst": "SELECT flight, frame, gap_frames, gap_m FROM gaps WHERE gap_m > 0 QUALIFY row_number() OVER (PARTITION BY flight ORDER BY gap_m DESC, frame) = 1",
    "binned": f"SELECT *, floor((easting - min(easting) OVER f) / {AUDIT_BIN_M})::BIGINT AS cell_x, floor((northing - min(northing) OVER f) / {AUDIT_BIN_M})::BIGINT AS cell_y FROM scored WINDOW f AS (PARTITION BY flight)",
    "grid": f"SELECT flight, (floor((min(easting) - {MARGIN_M}) / {BIN_M}) * {BIN_M})::DOUBLE AS origin_e, (floor((min(northing) - {MARGIN_M}) / {BIN_M}) * {BIN_M})::DOUBLE AS origin_n FROM frames GROUP BY flight",
    "valid": "SELECT * FROM cells WHERE footprint_valid",
    "size": "SELECT flight, frame, count(*) AS n FROM valid GROUP BY ALL",
    "axes": "SELECT *, sin(yaw_rad) * sin(pi() / 2 + pitch_rad) AS ax, cos(yaw_rad) * sin(pi() / 2 + pitch_rad) AS ay, -cos(pi() / 2 + pitch_rad) AS az FROM frames",
    "all_edges": """SELECT flight, i, j, shared, shared / least(a.n, b.n)::DOUBLE AS iom, sqrt((f.easting - g.easting) * (f.easting - g.easting) + (f.northing - g.northing) * (f.northing - g.northing)) AS dist_m,
              degrees(acos(greatest(-1, least(1, f.ax * g.ax + f.ay * g.ay + f.az * g.az)))) AS view_angle_deg
              FROM (SELECT a.flight, a.frame AS i, b.frame AS j, count(*) AS shared FROM valid a JOIN valid b ON a.flight = b.flight AND a.cx = b.cx AND a.cy = b.cy AND a.frame < b.frame GROUP BY ALL) p
              JOIN size a USING (flight) JOIN size b USING (flight) JOIN axes f USING (flight) JOIN axes g USING (flight)
              WHERE a.frame = i AND b.frame = j AND f.frame = i AND g.frame = j AND shared / least(a.n, b.n)::DOUBLE >= 0.10""",
    "near_edges": "SELECT * FROM all_edges WHERE NOT coalesce(view_angle_deg > 45, false)",
    "vertices": "SELECT flight, frame, row_number() OVER (PARTITION BY flight ORDER BY frame) AS r FROM chosen SEMI JOIN valid USING (flight, frame)",
    "edges": "SELECT e.*, b.r - a.r AS apart FROM near_edges e JOIN vertices a ON e.flight = a.flight AND e.i = a.frame JOIN vertices b ON e.flight = b.flight AND e.j = b.frame",
    "degree": "SELECT flight, frame, coalesce(d, 0) AS degree FROM vertices LEFT JOIN (SELECT flight, frame, count(*) AS d FROM (SELECT flight, unnest([i, j]) AS frame FROM edges) GROUP BY ALL) USING (flight, frame)",
    "steps": "SELECT * FROM (SELECT *, " + ", ".join(f"lag({c}) OVER w AS {c}_0" for c in ("pitch_rad", "yaw_rad", "ax", "ay", "az")) + " FROM axes WINDOW w AS (PARTITION BY flight ORDER BY frame)) WHERE frame > 0",
    "ground": adapter.GROUND.format(cells="cells"),
    "rays": f"SELECT flight, frame, cx, cy, easting - (cx + 0.5) * {_E} AS x, northing - (cy + 0.5) * {_N} AS y, altamsl - coalesce(ground_z, first(altamsl) OVER (PARTITION BY flight, cx, cy ORDER BY frame)) AS z FROM cells JOIN (SELECT flight, frame, easting, northing, altamsl FROM chosen) USING (flight, frame) JOIN ground USING (flight, cx, cy)",
    "unit": "SELECT flight, frame, cx, cy, [x, y, z] AS v, sqrt(x * x + y * y + z * z) AS norm FROM rays",
    "conv": """SELECT v.flight, v.cx, v.cy, n AS views, round(coalesce(degrees(acos(greatest(-1, least(1, dot)))), 0), 4) AS angle FROM (SELECT flight, cx, cy, count(*) AS n FROM unit GROUP BY ALL) v
             LEFT JOIN (SELECT a.flight, a.cx, a.cy, min(CASE WHEN a.norm > 0 AND b.norm > 0 THEN list_dot_product(a.v, b.v) / a.norm / b.norm ELSE 0 END) AS dot FROM unit a JOIN unit b ON a.flight = b.flight AND a.cx = b.cx AND a.cy = b.cy AND a.frame < b.frame GROUP BY ALL) d ON v.flight = d.flight AND v.cx = d.cx AND v.cy = d.cy""",
    "flat_unit": f"SELECT flight, frame, cx, cy, [x, y, z] AS v, sqrt(x * x + y * y + z * z) AS norm FROM (SELECT flight, frame, cx, cy, easting - (cx + 0.5) * {_E} AS x, northing - (cy + 0.5) * {_N} AS y, altamsl - mid AS z FROM cells JOIN (SELECT flight, frame, easting, northing, altamsl FROM chosen) USING (flight, frame) JOIN (SELECT flight, quantile_cont(altamsl, 0.5) AS mid FROM frames GROUP BY flight) USING (flight))",
    "flat_conv": """SELECT v.flight, v.cx, v.cy, n AS views, round(coalesce(degrees(acos(greatest(-1, least(1, dot)))), 0), 4) AS angle FROM (SELECT flight, cx, cy, count(*) AS n FROM flat_unit GROUP BY ALL) v
             LEFT JOIN (SELECT a.flight, a.cx, a.cy, min(CASE WHEN a.norm > 0 AND b.norm > 0 THEN list_dot_product(a.v, b.v) / a.norm / b.norm ELSE 0 END) AS dot FROM flat_unit a JOIN flat_unit b ON a.flight = b.flight AND a.cx = b.cx AND a.cy = b.cy AND a.frame < b.frame GROUP BY ALL) d ON v.flight = d.flight AND v.cx = d.cx AND v.cy = d.cy""",
    "matches": "SELECT a.l_suppkey % 200 AS a, b.l_suppkey % 200 AS b, max(a.l_quantity::BIGINT + b.l_quantity::BIGINT - 40) AS inliers FROM lineitem a JOIN lineitem b USING (l_orderkey) WHERE a.l_suppkey % 200 <> b.l_suppkey % 200 GROUP BY 1, 2",
    "pairs": "SELECT least(a, b) AS a, greatest(a, b) AS b, max(inliers) AS inliers FROM matches GROUP BY 1, 2",
    "scope": "SELECT range AS node FROM range(220)",
}
for _n in (LEAST_INLIERS, 55, 58):
    CHAIN[f"solid{_n}"] = f"SELECT * FROM pairs WHERE inliers >= {_n}"
    CHAIN[f"strength{_n}"] = f"SELECT node, count(*) AS degree, sum(inliers)::BIGINT AS strength FROM (SELECT unnest([a, b]) AS node, inliers FROM solid{_n}) GROUP BY node"
CHAIN["weak"] = "SELECT node, coalesce(degree, 0) AS degree, coalesce(strength, 0) AS strength FROM scope LEFT JOIN strength55 USING (node) WHERE coalesce(degree, 0) <= 5 OR coalesce(strength, 0) < 100"
CHAIN["predicted"] = f"SELECT a, b FROM solid{LEAST_INLIERS} WHERE inliers >= 50 UNION ALL SELECT range, range + 1 FROM range(1000, 1010)"
CHAIN["both58"] = "SELECT a, b FROM solid58 UNION SELECT b, a FROM solid58"
CHAIN["reach58"] = "SELECT a, b FROM both58 UNION SELECT r.a, e.b FROM reach58 r JOIN both58 e ON r.b = e.a"
CHAIN["reach55"] = "SELECT a, b FROM solid55 UNION SELECT b, a FROM solid55 UNION SELECT r.a, CASE WHEN e.a = r.b THEN e.b ELSE e.a END FROM reach55 r JOIN solid55 e ON r.b = e.a OR r.b = e.b"
CHAIN["heights"] = HEIGHTS.format(customer="customer")
CHAIN["spots"] = f"SELECT flight, frame, easting, northing, (easting - ({RASTER_E})) / {RASTER_CELL} AS c, ({RASTER_N} - northing) / {RASTER_CELL} AS r, (SELECT max(row) FROM heights) AS last FROM frames"
CHAIN["corners"] = f"SELECT flight, frame, c, r, least(floor(c), {RASTER_COLS} - 2)::BIGINT AS c0, least(floor(r), last - 1)::BIGINT AS r0 FROM spots WHERE c BETWEEN 0 AND {RASTER_COLS} - 1 AND r BETWEEN 0 AND last"
CHAIN["touch"] = "SELECT flight, cx, cy FROM status WHERE status < 2"
CHAIN["dense"] = "SELECT flight, frame, n AS population, members FROM (SELECT a.flight, a.frame, count(*) AS n, array_to_string(list(b.frame ORDER BY b.frame)[:10], ',') AS members FROM chosen a JOIN chosen b ON a.flight = b.flight AND (a.easting - b.easting) * (a.easting - b.easting) + (a.northing - b.northing) * (a.northing - b.northing) <= " + str(DENSITY_M**2) + " GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY flight ORDER BY n DESC, frame) = 1"
CHAIN["flood"] = "SELECT flight, cx, cy, cx AS hx, cy AS hy FROM touch UNION SELECT t.flight, t.cx, t.cy, f.hx, f.hy FROM flood f JOIN touch t ON t.flight = f.flight AND abs(t.cx - f.cx) + abs(t.cy - f.cy) = 1"
CHAIN["holes"] = f"""SELECT *, round(size * {CELL_M2}::DOUBLE, 1) AS area_m2, row_number() OVER (PARTITION BY flight ORDER BY size DESC, hole_x, hole_y) AS rank FROM (SELECT flight, h.hx AS hole_x, h.hy AS hole_y, count(*) AS size, round((avg(cx) + 0.5) * {_E}, 1) AS centroid_e, round((avg(cy) + 0.5) * {_N}, 1) AS centroid_n
    FROM (SELECT flight, cx, cy, min([hx, hy]) AS m, m[1] AS hx, m[2] AS hy FROM flood GROUP BY flight, cx, cy) h GROUP BY ALL)"""

FINAL = {
    "tiled_terrain_sample": """SELECT flight, frame, easting, northing, round(z, 6) AS ground_z FROM spots LEFT JOIN (
        SELECT flight, frame, (a.z::DOUBLE * (1 - (c - c0)) + b.z::DOUBLE * (c - c0)) * (1 - (r - r0)) + (e.z::DOUBLE * (1 - (c - c0)) + f.z::DOUBLE * (c - c0)) * (r - r0) AS z FROM corners
        JOIN heights a ON a.row = r0 AND a.col = c0 JOIN heights b ON b.row = r0 AND b.col = c0 + 1 JOIN heights e ON e.row = r0 + 1 AND e.col = c0 JOIN heights f ON f.row = r0 + 1 AND f.col = c0 + 1) USING (flight, frame)""",
    "frames_adapter": "SELECT * FROM frames",
    "pose_dedup_first": "SELECT flight, frame, event_id, value FROM (SELECT user_id AS flight, event_id % 50 AS frame, event_id, value FROM events) QUALIFY row_number() OVER (PARTITION BY flight, frame ORDER BY event_id) = 1",
    "quality_score": "SELECT flight, frame, round(quality_score, 6) AS quality_score FROM scored",
    "assign_bins": "SELECT flight, frame, cell_x, cell_y FROM binned",
    "ground_grid_origin": "SELECT * FROM grid",
    "cell_centers": f"SELECT flight, cx, cy, (cx + 0.5) * {BIN_M} + origin_e AS center_e, (cy + 0.5) * {BIN_M} + origin_n AS center_n FROM (SELECT DISTINCT flight, floor((easting - origin_e) / {BIN_M})::BIGINT AS cx, floor((northing - origin_n) / {BIN_M})::BIGINT AS cy, origin_e::DOUBLE AS origin_e, origin_n::DOUBLE AS origin_n FROM frames JOIN grid USING (flight))",
    "airborne_span": "SELECT * FROM airborne",
    "gsd_floor": "SELECT flight, round(gsd_floor, 6) AS gsd_floor FROM floors",
    "gate_reject_reason": "SELECT flight, frame, reason AS reject_reason FROM gated",
    "spacing_superset": "SELECT flight, frame FROM spaced",
    "thin_to_cap": f"SELECT flight, frame FROM (SELECT *, row_number() OVER (PARTITION BY flight, b ORDER BY quality_score DESC, frame) AS k FROM (SELECT *, count(*) OVER (PARTITION BY flight) AS n, ntile({P.max_frames}) OVER (PARTITION BY flight ORDER BY frame) AS b FROM (SELECT flight, frame, quality_score FROM scored WHERE quality_score IS NOT NULL))) WHERE n <= {P.max_frames} OR k = 1",
    "select_keyframes": "SELECT flight, frame, selected, reject_reason FROM labelled",
    "reject_reason_counts": "SELECT reject_reason, count(*) AS n FROM labelled GROUP BY 1",
    "build_manifest": "SELECT flight, count(*) AS n_frames, count(1) FILTER (WHERE selected) AS n_selected, '[' || coalesce(string_agg(frame::VARCHAR, ',' ORDER BY frame) FILTER (WHERE selected), '') || ']' AS selected_frames FROM labelled GROUP BY flight",
    "view_counts": "SELECT * FROM views",
    "mission_cells": "SELECT * FROM mission",
    "coverage_metrics": "SELECT * REPLACE (round(covered_share, 6) AS covered_share, round(mean_views, 6) AS mean_views) FROM metrics",
    "views_histogram": "SELECT flight, views, count(*) AS n_cells FROM views GROUP BY ALL",
    "mission_status": "SELECT flight, cx, cy, status::BIGINT AS status FROM status",
    "coverage_holes": "SELECT * FROM holes",
    "covered_outline": """SELECT flight, area, n_sides, n_corners FROM (SELECT flight, count(*) AS area FROM views GROUP BY flight)
        JOIN (SELECT flight, count(*) AS n_sides FROM (SELECT flight, a, x, y FROM (SELECT flight, 0 AS a, cx AS x, cy AS y FROM views UNION ALL SELECT flight, 0, cx, cy + 1 FROM views UNION ALL SELECT flight, 1, cx, cy FROM views UNION ALL SELECT flight, 1, cx + 1, cy FROM views)
            GROUP BY ALL HAVING count(*) = 1) GROUP BY flight) USING (flight)
        JOIN (SELECT flight, sum(CASE WHEN q IN (6, 9) THEN 2 WHEN q IN (1, 2, 4, 8, 7, 11, 13, 14) THEN 1 ELSE 0 END)::BIGINT AS n_corners FROM (SELECT flight, x, y, sum(q) AS q
            FROM (SELECT flight, cx AS x, cy AS y, 1 AS q FROM views UNION ALL SELECT flight, cx + 1, cy, 2 FROM views UNION ALL SELECT flight, cx, cy + 1, 4 FROM views UNION ALL SELECT flight, cx + 1, cy + 1, 8 FROM views) GROUP BY ALL) GROUP BY flight) USING (flight)""",
    "selection_gaps": "SELECT * FROM gaps",
    "worst_gap": "SELECT * FROM worst",
    "coverage_warnings": f"SELECT * FROM gaps WHERE gap_m > {WARN_GAP_M}",
    "bin_rank": "SELECT flight, frame, CASE WHEN quality_score IS NOT NULL THEN row_number() OVER (PARTITION BY flight, cell_x, cell_y ORDER BY quality_score DESC NULLS LAST, frame) END AS bin_rank FROM binned",
    "nearest_selected": "SELECT l.flight, l.frame, round(min(CASE WHEN l.selected AND l.easting = c.easting AND l.northing = c.northing THEN NULL ELSE sqrt((l.easting - c.easting) * (l.easting - c.easting) + (l.northing - c.northing) * (l.northing - c.northing)) END), 6) AS dist_m FROM labelled l LEFT JOIN chosen c ON l.flight = c.flight GROUP BY ALL",
    "local_density": "SELECT * FROM dense",
    "matcher_neighbors_radius": f"SELECT flight, CASE WHEN count(*) < 2 THEN 0 ELSE greatest(floor(quantile_cont(n, 0.5)), 1) END::BIGINT AS neighbours FROM (SELECT a.flight, a.frame, count(b.frame) AS n FROM chosen a LEFT JOIN chosen b ON a.flight = b.flight AND a.frame <> b.frame AND (a.easting - b.easting) * (a.easting - b.easting) + (a.northing - b.northing) * (a.northing - b.northing) <= {REACH_M**2} GROUP BY ALL) GROUP BY flight",
    "audit_quantiles": "SELECT flight, " + ", ".join(f"round(quantile_cont(quality_score, {q}), 6) AS {n}" for n, q in zip(("q_min", "p10", "p25", "p50", "p75", "p90", "q_max"), (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0), strict=True)) + " FROM scored GROUP BY flight",
    "adjacent_baselines": "SELECT flight, count(*) AS n, count(1) FILTER (WHERE gap_m <= 50) AS near_repeats, count(1) FILTER (WHERE gap_m < 70) AS low, round(quantile_cont(gap_m, 0.5), 6) AS median_m FROM gaps GROUP BY flight",
    "footprint_jaccard": "SELECT flight, frame, round(len(list_intersect(c, b)) / (len(c) + len(b) - len(list_intersect(c, b)))::DOUBLE, 6) AS jaccard FROM (SELECT flight, frame, c, lag(c) OVER (PARTITION BY flight ORDER BY frame) AS b FROM (SELECT flight, frame, list(DISTINCT [cx, cy]) AS c FROM cells GROUP BY ALL)) WHERE b IS NOT NULL",
    "covis_edges": "SELECT flight, i, j, shared, round(iom, 6) AS iom, round(dist_m, 6) AS dist_m, round(view_angle_deg, 4) AS view_angle_deg FROM edges",
    "covis_degrees": "SELECT * FROM degree",
    "covis_summary": """SELECT flight, n, coalesce(n_edges, 0) AS n_edges, coalesce(n_cross, 0) AS n_cross, round(coalesce(n_cross / n_edges::DOUBLE, 0), 6) AS cross_share, round(degree_p50, 6) AS degree_p50, round(degree_p95, 6) AS degree_p95, degree_max, round(coalesce(reach_p50, 0), 6) AS reach_p50, round(coalesce(reach_p95, 0), 6) AS reach_p95, round(coalesce(reach_max, 0), 6) AS reach_max
        FROM (SELECT flight, count(*) AS n, quantile_cont(degree, 0.5) AS degree_p50, quantile_cont(degree, 0.95) AS degree_p95, max(degree) AS degree_max FROM degree GROUP BY flight)
        LEFT JOIN (SELECT flight, count(*) AS n_edges, count(1) FILTER (WHERE apart > 16) AS n_cross, quantile_cont(dist_m, 0.5) AS reach_p50, quantile_cont(dist_m, 0.95) AS reach_p95, max(dist_m) AS reach_max FROM edges GROUP BY flight) USING (flight)""",
    "pair_budget": f"SELECT DISTINCT flight, i, j, iom FROM (SELECT flight, i, j, iom, row_number() OVER (PARTITION BY flight, node ORDER BY iom DESC, i, j) AS k FROM (SELECT flight, i, j, round(iom, 6) AS iom, unnest([i, j]) AS node FROM near_edges)) WHERE k <= {PAIR_BUDGET}",
    "matcher_profile": "SELECT flight, CASE WHEN m IS NULL THEN 8 ELSE least(greatest(ceil(p), 8), 64) END::BIGINT AS neighbours, coalesce(m, 0) AS distance_m FROM (SELECT flight, quantile_cont(degree, 0.95) AS p FROM degree GROUP BY flight) LEFT JOIN (SELECT flight, round(quantile_cont(dist_m, 0.95), 2) AS m FROM edges GROUP BY flight) USING (flight)",
    "optical_axis": "SELECT flight, frame, round(ax, 6) AS ax, round(ay, 6) AS ay, round(az, 6) AS az FROM axes",
    "rotation_delta": "SELECT flight, frame, round(degrees(sqrt(p * p + y * y)), 4) AS turn_deg FROM (SELECT flight, frame, " + ", ".join(f"(({c}_rad - {c}_rad_0 + pi()) - floor(({c}_rad - {c}_rad_0 + pi()) / (2 * pi())) * 2 * pi()) - pi() AS {c[0]}" for c in ("pitch", "yaw")) + " FROM steps)",
    "view_angle": "SELECT flight, frame, round(degrees(acos(greatest(-1, least(1, ax * ax_0 + ay * ay_0 + az * az_0)))), 4) AS angle_deg FROM steps",
    "convergence_by_cell": "SELECT * FROM conv",
    "parallax_metrics": "SELECT flight, count(*) AS n_covered, count(1) FILTER (WHERE views >= 3 AND angle >= 10) AS n_satisfied, round(count(1) FILTER (WHERE views >= 3 AND angle >= 10) / count(*)::DOUBLE, 6) AS satisfied_share, count(1) FILTER (WHERE views >= 3 AND angle < 10) AS n_low, " + ", ".join(f"round(quantile_cont(angle, {q}) FILTER (WHERE views >= 2), 2) AS {n}" for n, q in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9))) + " FROM conv GROUP BY flight",
    "solid_pairs": f"SELECT * FROM solid{LEAST_INLIERS}",
    "graph_degree_strength": f"SELECT * FROM strength{LEAST_INLIERS}",
    "weak_nodes": "SELECT * FROM weak",
    "bad_images": "SELECT node, node IN (SELECT node FROM weak) AS weak, node NOT IN (SELECT node FROM strength55) AS missing FROM scope WHERE node IN (SELECT node FROM weak) OR node NOT IN (SELECT node FROM strength55)",
    "pair_recall_precision": f"SELECT n_predicted, n_solid, n_both, round(n_both / n_predicted::DOUBLE, 6) AS recall, round(n_both / n_solid::DOUBLE, 6) AS precision FROM (SELECT (SELECT count(*) FROM predicted) AS n_predicted, (SELECT count(*) FROM solid{LEAST_INLIERS}) AS n_solid, (SELECT count(*) FROM predicted JOIN solid{LEAST_INLIERS} USING (a, b)) AS n_both)",
    "match_components": "SELECT a AS node, least(a, min(b)) AS component FROM reach58 GROUP BY a",
    "track_length_median": "SELECT min(length) AS median FROM (SELECT length, sum(n) OVER (ORDER BY length) AS cum, sum(n) OVER () AS total FROM (SELECT length, count(*) AS n FROM (SELECT count(*) AS length FROM lineitem GROUP BY l_orderkey) GROUP BY length)) WHERE 2 * cum >= total",
    "health_report": f"""SELECT n.flight, n_selected, coalesce(max_temporal_gap, 0) AS max_temporal_gap, temporal_gap_frame, coalesce(w.gap_m, 0) AS max_motion_gap_m, w.frame AS motion_gap_frame, coalesce(population, 0) AS max_cluster_size, coalesce(members, '') AS largest_cluster, m.* EXCLUDE (flight) REPLACE ({", ".join(f"round({c}, 6) AS {c}" for c in ("covered_share", "covered_at_target", "mission_at_target", "mean_views"))}, n_at_double * {P.bin_m**2}::DOUBLE AS over_coverage_m2),
        n_satisfied, round(satisfied / n_seen, 6) AS satisfied_share, round(mid, 2) AS median_convergence_deg, CASE WHEN n_selected > 0 AND w.gap_m > {P.max_gap_m} THEN 'motion gap over the limit' ELSE '' END AS warnings,
        CASE WHEN n_selected = 0 THEN 'no frames selected' WHEN n_covered > 0 AND covered_share < 0.5 THEN 'only ' || round_even(covered_share * 100, 0)::BIGINT || '% of mission cells covered (need 50%); budget likely too small' ELSE '' END AS failures, failures = '' AS passed
        FROM (SELECT flight, count(1) FILTER (WHERE selected) AS n_selected FROM labelled GROUP BY flight) n LEFT JOIN metrics m USING (flight) LEFT JOIN worst w USING (flight)
        LEFT JOIN (SELECT flight, gap_frames AS max_temporal_gap, frame AS temporal_gap_frame FROM gaps QUALIFY row_number() OVER (PARTITION BY flight ORDER BY gap_frames DESC, frame) = 1) USING (flight)
        LEFT JOIN dense USING (flight) LEFT JOIN (SELECT flight, count(*)::DOUBLE AS n_seen, count(1) FILTER (WHERE views >= 3 AND angle >= 10) AS n_satisfied, n_satisfied::DOUBLE AS satisfied, quantile_cont(angle, 0.5) FILTER (WHERE views >= 2) AS mid FROM flat_conv GROUP BY flight) USING (flight)""",
}

CHAIN |= {
    "rimages": "SELECT o_custkey % 20 AS run, o_orderkey AS image FROM orders",
    "rselected": "SELECT * FROM rimages WHERE image % 3 = 0 AND run < 15",
    "rfeatures": "SELECT *, CASE WHEN image % 11 = 0 THEN 0 ELSE image % 1000 END AS num FROM rimages",
    "rinscope": "SELECT * FROM rfeatures WHERE run NOT IN (SELECT run FROM rselected) OR (run, image) IN (SELECT (run, image) FROM rselected)",
    "rshots": "SELECT * FROM rimages WHERE image % 4 <> 0 AND run <> 3",
    "rmissing": "SELECT * FROM rimages WHERE image % 50 = 0",
    "rgone": "SELECT * FROM rmissing UNION SELECT * FROM (SELECT * FROM rselected EXCEPT SELECT * FROM rshots) WHERE run IN (SELECT run FROM rshots UNION SELECT run FROM rmissing)",
    "redges": "SELECT o_custkey % 20 AS run, l_orderkey AS a, l_orderkey + 3 * l_linenumber AS b, CASE WHEN l_orderkey % 17 <> 0 THEN l_quantity::BIGINT END AS weight FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "rnodes": "SELECT run, image, count(*) AS degree, sum(weight) AS strength FROM (SELECT run, unnest([a, b]) AS image, weight FROM redges WHERE weight IS NOT NULL) GROUP BY ALL",
    "rscoped": "SELECT coalesce(n.run, c.run) AS run, coalesce(n.image, c.image) AS image, degree, strength FROM rnodes n FULL JOIN rselected c ON n.run = c.run AND n.image = c.image WHERE c.image IS NOT NULL OR n.run NOT IN (SELECT run FROM rselected)",
    "rweak": "SELECT run, image FROM rscoped WHERE (degree IS NULL AND run IN (SELECT run FROM redges)) OR degree <= 5 OR strength < 100",
    "rflags": "SELECT run, image, CASE WHEN num = 0 THEN 'z' ELSE 'l' END AS flag FROM rinscope WHERE num < 100 UNION ALL SELECT *, 'n' FROM rgone UNION ALL SELECT *, 'w' FROM rweak",
}

_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in ("covered_share", "covered_at_target", "mission_at_target", "mean_views"))
FINAL |= {
    "hole_totals": f"SELECT flight, count(*) AS n_holes, sum(size)::BIGINT AS n_under_target, round(sum(area_m2), 1) AS hole_area_m2, string_agg(size::VARCHAR, ',' ORDER BY rank) FILTER (WHERE rank <= {TOP_HOLES}) AS largest FROM holes GROUP BY flight",
    "covis_edges_of_all_frames": "SELECT flight, i, j, shared, round(iom, 6) AS iom, round(dist_m, 6) AS dist_m, round(view_angle_deg, 4) AS view_angle_deg FROM all_edges",
    "audit_table": f"""SELECT flight, frame, floor((easting - min(easting) OVER f) / {AUDIT_BIN_M})::BIGINT AS cell_x, floor((northing - min(northing) OVER f) / {AUDIT_BIN_M})::BIGINT AS cell_y, bin_rank, dist_m, selected, CASE WHEN selected THEN 'keyframe' END AS selection_reason
        FROM labelled JOIN ({FINAL["bin_rank"]}) USING (flight, frame) JOIN ({FINAL["nearest_selected"]}) USING (flight, frame) WINDOW f AS (PARTITION BY flight)""",
    "selection_decisions": f"""SELECT flight, 'keyframe:' || count(*) AS selection_reason_counts, quantile_cont(bin_rank, 0.5) AS bin_rank_median, max(bin_rank) AS bin_rank_max, count(1) FILTER (WHERE event_id % 3 = 0) AS n_marginal, array_to_string((list(frame ORDER BY frame) FILTER (WHERE event_id % 3 = 0))[:3], ',') AS marginal_frames
        FROM chosen JOIN ({FINAL["bin_rank"]}) USING (flight, frame) GROUP BY flight""",
    "selection_summary": f"""SELECT * REPLACE ({_ROUNDED}, n_at_double * {P.bin_m**2}::DOUBLE AS over_coverage_m2) FROM (SELECT flight, count(*) AS n_candidates, count(1) FILTER (WHERE selected) AS n_selected FROM labelled GROUP BY flight)
        LEFT JOIN (SELECT flight, string_agg(reject_reason || ':' || n, ',' ORDER BY reject_reason) AS reject_counts FROM (SELECT flight, reject_reason, count(*) AS n FROM labelled WHERE NOT selected GROUP BY ALL) GROUP BY flight) USING (flight) LEFT JOIN metrics USING (flight)
        LEFT JOIN (SELECT flight, string_agg(views || ':' || n, ',' ORDER BY views) AS views_histogram FROM (SELECT flight, views, count(*) AS n FROM views GROUP BY ALL) GROUP BY flight) USING (flight)
        LEFT JOIN (SELECT flight, count(gap_m) AS n_gaps, count(1) FILTER (WHERE gap_m > {WARN_GAP_M}) AS n_coverage_gaps, round(min(q), 4) AS quality_min, round(quantile_cont(q, 0.5), 4) AS quality_median, round(max(q), 4) AS quality_max FROM (SELECT flight, frame, quality_score AS q FROM chosen) LEFT JOIN gaps USING (flight, frame) GROUP BY flight) USING (flight)""",
    "selection_insight": """SELECT flight, coalesce(n_holes, 0) AS n_holes, coalesce(n_under_target, 0) AS n_under_target, coalesce(hole_area_m2, 0) AS hole_area_m2, coalesce(largest, '') AS largest, c.* EXCLUDE (flight) FROM (SELECT DISTINCT flight FROM mission)
        LEFT JOIN (SELECT flight, count(*) AS n_holes, sum(size)::BIGINT AS n_under_target, round(sum(area_m2), 1) AS hole_area_m2, string_agg(size::VARCHAR, ',' ORDER BY rank) FILTER (WHERE rank <= 10) AS largest FROM holes GROUP BY flight) USING (flight)
        LEFT JOIN (SELECT flight, count(*) AS n_covered, count(1) FILTER (WHERE views >= 3 AND angle >= 10) AS n_satisfied, round(count(1) FILTER (WHERE views >= 3 AND angle >= 10) / count(*)::DOUBLE, 6) AS satisfied_share, count(1) FILTER (WHERE views >= 3 AND angle < 10) AS n_multi_view_low,
                   round(quantile_cont(angle, 0.1) FILTER (WHERE views >= 2), 2) AS p10, round(quantile_cont(angle, 0.5) FILTER (WHERE views >= 2), 2) AS p50, round(quantile_cont(angle, 0.9) FILTER (WHERE views >= 2), 2) AS p90 FROM flat_conv GROUP BY flight) c USING (flight)""",
    "mission_box": "SELECT flight, min(easting) AS min_easting, max(easting) AS max_easting, min(northing) AS min_northing, max(northing) AS max_northing FROM frames GROUP BY flight",
    "cell_ground_heights": "SELECT DISTINCT flight, cx, cy, coalesce(ground_z, first(altamsl) OVER (PARTITION BY flight, cx, cy ORDER BY frame)) AS ground_z FROM cells JOIN (SELECT flight, frame, altamsl FROM chosen) USING (flight, frame) JOIN ground USING (flight, cx, cy)",
    "missing_frames": "SELECT flight, frame FROM frames WHERE event_id % 29 = 0",
    "init_candidates": "SELECT flight, frame, false AS selected, NULL::VARCHAR AS reject_reason, NULL::VARCHAR AS selection_reason, NULL::DOUBLE AS quality_score, NULL::BIGINT AS cell_x FROM frames",
    "rotation_axes": """SELECT flight, frame, round(z * x * (1 - cos(t)) - y * sin(t), 6) AS ax, round(z * y * (1 - cos(t)) + x * sin(t), 6) AS ay, round(cos(t) + z * z * (1 - cos(t)), 6) AS az
        FROM (SELECT flight, frame, t, rx / t AS x, ry / t AS y, rz / t AS z FROM (SELECT *, sqrt(rx * rx + ry * ry + rz * rz) AS t FROM (SELECT flight, frame, pitch_rad AS rx, yaw_rad / 2 AS ry, CASE WHEN frame % 7 = 0 THEN 0 ELSE yaw_rad / 3 END AS rz FROM frames)))""",
    "components_of_images": "SELECT component, count(*) AS n FROM (SELECT node, coalesce(c, node) AS component FROM scope LEFT JOIN (SELECT a AS node, least(a, min(b)) AS c FROM reach58 GROUP BY a) USING (node)) GROUP BY component",
    "match_images": "SELECT a AS node FROM matches WHERE inliers >= 58 UNION SELECT b FROM matches WHERE inliers >= 58 UNION SELECT 7001",
    "scoreboard": f"""SELECT * FROM (WITH sp AS (SELECT * FROM solid55), img AS (SELECT a AS n FROM matches UNION SELECT b FROM matches UNION SELECT range FROM range(210)), rk AS (SELECT n, row_number() OVER (ORDER BY n) AS r FROM img),
        pr AS (SELECT a, b FROM pairs WHERE inliers >= 56 UNION ALL SELECT 800, 801), cp AS (SELECT n, coalesce((SELECT min(b) FROM reach55 WHERE a = n), n) AS c FROM img)
        SELECT (SELECT count(*) FROM img) AS n_images, count(*) AS solid_pairs, round(avg(inliers), 6) AS mean_inliers, count(1) FILTER (WHERE abs(x.r - y.r) > 16) AS cross_track_solid_pairs, round(cross_track_solid_pairs / count(*)::DOUBLE, 6) AS cross_track_solid_ratio, (SELECT count(DISTINCT c) FROM cp) AS match_graph_components,
        5.5::DOUBLE AS track_len_mean, (SELECT median::DOUBLE FROM ({FINAL["track_length_median"]})) AS track_len_median, 0.0::DOUBLE AS reproj_err_px, 0.7::DOUBLE AS recon_shot_frac, 0.5::DOUBLE AS gps_ce90, NULL::DOUBLE AS gps_le90,
        round((SELECT count(*) FROM pr JOIN sp USING (a, b)) / (SELECT count(*) FROM pr)::DOUBLE, 6) AS covis_recall, round((SELECT count(*) FROM pr JOIN sp USING (a, b)) / count(*)::DOUBLE, 6) AS covis_precision
        FROM sp JOIN rk x ON x.n = sp.a JOIN rk y ON y.n = sp.b)""",
}


def _spread(column: str, name: str) -> str:
    return ", ".join(f"round(quantile_cont({column}, {q}), 6) AS {name}_{n}" for n, q in (("min", 0.0), ("p10", 0.1), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("max", 1.0)))


FINAL |= {
    "run_selection_metrics": f"""SELECT run, n_candidates, coalesce(n_selected, 0) AS n_selected, * EXCLUDE (run, n_candidates, n_selected) FROM (SELECT flight AS run, count(*) AS n_candidates FROM labelled GROUP BY flight) LEFT JOIN (
        SELECT flight AS run, count(*) AS n_selected, min(frame) AS first_frame, max(frame) AS last_frame, {_spread("gap", "frame_gap")}, {_spread("altamsl", "altitude_m")}, {_spread("base", "baseline_m")}, {_spread("q", "quality")}, count(1) FILTER (WHERE coalesce(base <= 0.1, false)) AS n_near_repeats, count(1) FILTER (WHERE coalesce(base < 1, false)) AS n_low_baselines
        FROM (SELECT flight, frame, altamsl, quality_score AS q, frame - lag(frame) OVER (PARTITION BY flight ORDER BY (frame * 7) % 1000003) AS gap, sqrt(power(easting - lag(easting) OVER f, 2) + power(northing - lag(northing) OVER f, 2)) AS base FROM labelled WHERE selected WINDOW f AS (PARTITION BY flight ORDER BY frame)) GROUP BY flight) USING (run)""",
    "run_feature_report": f"""SELECT * FROM (SELECT run, count(*) AS n_images FROM rfeatures GROUP BY run) LEFT JOIN (
        SELECT run, {_spread("num", "feature_count")}, count(1) FILTER (WHERE num = 0) AS n_zero_features, count(1) FILTER (WHERE num > 0 AND num < 100) AS n_low_features FROM rinscope GROUP BY run) USING (run)""",
    "run_reconstruction_report": """SELECT r.run, coalesce(n_shots, 0) AS n_shots, n_selected, coalesce(n_gone, 0) AS n_not_reconstructed, round(n_both / n_selected, 6) AS selected_ratio FROM (SELECT run FROM rshots UNION SELECT run FROM rmissing) r
        LEFT JOIN (SELECT run, count(*) AS n_shots FROM rshots GROUP BY run) USING (run) LEFT JOIN (SELECT run, count(*) AS n_gone FROM rgone GROUP BY run) USING (run)
        LEFT JOIN (SELECT run, count(*) AS n_selected, count(1) FILTER (WHERE (run, image) IN (SELECT (run, image) FROM rshots)) AS n_both FROM rselected GROUP BY run) USING (run)""",
    "run_tracks_report": f"""SELECT e.*, n.* EXCLUDE (run), coalesce(n_weak, 0) AS n_weak FROM (SELECT run, count(*) AS n_edges, {_spread("weight", "edge_weight")} FROM redges GROUP BY run) e
        LEFT JOIN (SELECT run, {_spread("degree", "node_degree")}, {_spread("strength", "node_strength")} FROM rscoped WHERE degree IS NOT NULL GROUP BY run) n USING (run) LEFT JOIN (SELECT run, count(*) AS n_weak FROM rweak GROUP BY run) USING (run)""",
    "run_image_flags": "SELECT run, image, " + ", ".join(f"bool_or(flag = '{n[0]}') AS {n}" for n in ("zero_features", "low_features", "not_reconstructed", "weak_graph")) + " FROM rflags GROUP BY run, image",
    "best_matcher_profile": """SELECT run, position, round(o, 6) AS objective FROM (SELECT p_brand AS run, p_partkey AS position, 2.0::DOUBLE * (p_size / 64) + (p_partkey % 16) / 16 + 0.2::DOUBLE * ((p_partkey % 5) * 5.0::DOUBLE) - 0.5::DOUBLE * ((p_partkey % 7) / 2) - 0.5::DOUBLE * greatest(p_partkey % 3 - 1, 0) AS o FROM part)
        QUALIFY row_number() OVER (PARTITION BY run ORDER BY o DESC, position) = 1""",
}


def _needed(text: str, found: dict[str, None]) -> dict[str, None]:
    """The named subqueries that a text uses, in the order of the chain."""
    import re

    for name in set(re.findall(r"\w+", text)) & CHAIN.keys():
        if name not in found:
            found[name] = None
            _needed(CHAIN[name], found)
    return found


def _sql(final: str) -> str:
    used = _needed(final, {})
    return ("WITH RECURSIVE " + ",\n".join(f"{n} AS ({CHAIN[n]})" for n in CHAIN if n in used) + "\n" if used else "") + final


ORACLES = {name: _sql(text) for name, text in FINAL.items()}
