"""The derived tables of `inputs` as SQL views for the side-by-side check."""

from __future__ import annotations

VIEWS = {
    "frames_v": """
SELECT event_id, event_id AS frame_num, user_id AS camera, epoch_us(ts) // 1000 AS ts_ms,
  strftime(ts, '%Y%m%d') AS store_date,
  CASE user_id % 5 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX' WHEN 3 THEN 'Oversea' ELSE 'Unknown' END AS location,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 3 AS n_obj
FROM events""",
    "objects_v": """
SELECT f.camera, f.event_id, f.frame_num, CAST(j.pos AS BIGINT) AS pos,
  1 + (f.k // 3 + j.pos) % 2 AS class_id,
  CASE WHEN (f.k // 3 + j.pos) % 2 = 0 THEN 'person' ELSE 'bicycle' END AS name,
  CAST((f.event_id * 31 + j.pos * 17) % 100 AS DOUBLE) / 100 AS score,
  CAST((f.event_id * 7 + j.pos * 13) % 50 AS DOUBLE) / 100 AS x1,
  CAST((f.event_id * 11 + j.pos * 5) % 50 AS DOUBLE) / 100 AS y1,
  CAST((f.event_id * 7 + j.pos * 13) % 50 + 10 + f.event_id % 10 AS DOUBLE) / 100 AS x2,
  CAST((f.event_id * 11 + j.pos * 5) % 50 + 20 AS DOUBLE) / 100 AS y2
FROM frames_v f JOIN (SELECT 1 AS pos UNION ALL SELECT 2) j ON j.pos <= f.n_obj""",
    "scenes_v": """
SELECT f.camera, f.event_id, f.frame_num, CAST(p.pos AS BIGINT) AS pos,
  CASE (f.event_id * 3 + p.pos * 7) % 10 WHEN 0 THEN 'crosswalk' WHEN 1 THEN 'downtown' WHEN 2 THEN 'street' WHEN 3 THEN 'plaza'
    WHEN 4 THEN 'highway' WHEN 5 THEN 'gas_station' WHEN 6 THEN 'forest_road' WHEN 7 THEN 'office'
    WHEN 8 THEN 'residential_neighborhood' ELSE 'parking_lot' END AS raw_scene
FROM frames_v f JOIN (SELECT 1 AS pos UNION ALL SELECT 2 UNION ALL SELECT 3) p ON p.pos <= f.event_id % 4""",
    "taxonomy_v": """
SELECT * FROM (VALUES ('crosswalk','crosswalk'), ('downtown','downtown'), ('plaza','downtown'), ('highway','highway'),
  ('gas_station','gas'), ('forest_road','wild'), ('residential_neighborhood','neighborhood'), ('parking_lot','parking')) AS t(raw_scene, scene_type)""",
    "coarse_v": """
SELECT DISTINCT f.camera, f.event_id, coalesce(m.scene_type, 'street') AS scene_type
FROM frames_v f LEFT JOIN (SELECT s.event_id, t.scene_type FROM scenes_v s JOIN taxonomy_v t ON t.raw_scene = s.raw_scene) m
  ON m.event_id = f.event_id""",
    "signatures_v": """
SELECT f.camera, f.event_id, f.frame_num, f.ts_ms, f.store_date, f.location,
  count(CASE WHEN o.class_id = 1 THEN 1 END) AS n1, count(CASE WHEN o.class_id = 2 THEN 1 END) AS n2
FROM frames_v f LEFT JOIN objects_v o ON o.event_id = f.event_id GROUP BY ALL""",
    "keyframes_v": """
SELECT *, coalesce(n1 <> lag(n1) OVER w OR n2 <> lag(n2) OVER w, true) AS is_keyframe
FROM signatures_v WINDOW w AS (PARTITION BY camera ORDER BY frame_num)""",
    "statistic_v": """
SELECT 'dashcam_' || k.camera AS dashcam_id, k.camera, k.store_date, k.location, CAST(count(*) AS BIGINT) AS frames,
  CAST(sum(CASE WHEN k.is_keyframe THEN 1 ELSE 0 END) AS BIGINT) AS keyframes, {types}, CAST(sum(c.n) AS BIGINT) AS total
FROM keyframes_v k JOIN (SELECT event_id, count(*) AS n, {type_flags} FROM coarse_v GROUP BY event_id) c ON c.event_id = k.event_id
GROUP BY ALL""",
    "boxes_v": """
SELECT l_orderkey AS image_id, ((l_suppkey % 10007 * 100003 + l_partkey % 100003) * 8 + l_linenumber) * 64 + CAST(l_quantity AS BIGINT) AS box_id,
  CAST(l_partkey % 3 AS INTEGER) AS class_id,
  CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS DOUBLE) / 1000 AS score,
  l_quantity AS x1, CAST(l_suppkey % 20 AS DOUBLE) AS y1, l_quantity + 20 + l_partkey % 10 AS x2, CAST(l_suppkey % 20 + 25 AS DOUBLE) AS y2
FROM lineitem""",
    "truth_v": """
SELECT image_id, box_id AS gt_id, class_id, x1 + 1 AS x1, y1 + 2 AS y1, x2 + 1 AS x2, y2 + 2 AS y2 FROM boxes_v WHERE box_id % 2 = 1""",
    "counters_v": """
SELECT event_type AS topic, user_id % 4 AS part, event_id, epoch_us(ts) // 1000 AS ts_ms, CAST(event_id % 4000 AS DOUBLE) AS value
FROM events""",
    "points_v": """
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE 25 + CAST(event_id * 37 % 2500 AS DOUBLE) / 100 END AS lat,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE -125 + CAST(event_id * 53 % 6000 AS DOUBLE) / 100 END AS lon
FROM events""",
    "regions_v": """
SELECT n_name AS region, CAST(25 + 5 * (n_nationkey // 5) AS DOUBLE) AS lat_lo, CAST(30 + 5 * (n_nationkey // 5) AS DOUBLE) AS lat_hi,
  CAST(-125 + 10 * (n_nationkey % 5) AS DOUBLE) AS lon_lo, CAST(-115 + 10 * (n_nationkey % 5) AS DOUBLE) AS lon_hi
FROM nation""",
    "listing_v": """
SELECT page_id, concat(url, CASE WHEN page_id % 7 = 0 THEN '.txt' ELSE '.mov' END) AS url FROM pages""",
    "ledger_v": """
SELECT url FROM listing_v WHERE page_id % 3 = 0""",
}

TYPES = ["airfield", "alley", "bridge", "crosswalk", "downtown", "gas", "harbor", "highway", "neighborhood", "park",
         "parking", "ruin", "snowfield", "station", "street", "wild", "village"]
VIEWS["statistic_v"] = VIEWS["statistic_v"].format(
    types=", ".join(f"CAST(sum(c.{t}) AS BIGINT) AS {t}" for t in TYPES),
    type_flags=", ".join(f"sum(CASE WHEN scene_type = '{t}' THEN 1 ELSE 0 END) AS {t}" for t in TYPES))


def with_views(body: str, recursive: bool = False) -> str:
    """Prefix `body` with the views it needs, each after those it builds on."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name, text in VIEWS.items():
            if name in sql and name not in needed:
                visit(text)
                needed.append(name)

    visit(body)
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    body = body.strip()
    head = "WITH RECURSIVE " if recursive else "WITH "
    if not needed:
        return body
    if body.upper().startswith("WITH "):
        return f"{head}{views},\n{body[5:]}"
    return f"{head}{views}\n{body}"
