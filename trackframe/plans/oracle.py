"""The catalogue's queries in SQL, written for DuckDB from the definitions, with the same names."""

from __future__ import annotations

SLOTS = ("x", "y", "z", "qx", "qy", "qz", "qw", "width")
_emb = ", ".join(f"embedding[{8 * a + i + 1}]::DOUBLE AS {role}_{c}" for a, role in enumerate(("right", "left")) for i, c in enumerate(SLOTS))
EMB = f"emb AS (SELECT label::BIGINT AS episode_index, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_index, {_emb} FROM embeddings)"
_arm = lambda role: f"SELECT episode_index, frame_index, '{role}' AS role, " + ", ".join(f"{role}_{c} AS {c}" for c in SLOTS) + " FROM emb"
ARMS = f"{EMB}, arms AS ({_arm('right')} UNION ALL {_arm('left')})"
EVT = """evt AS (SELECT user_id AS episode_index, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_index,
  value AS x, json_extract_string(props, '$.k')::DOUBLE AS y, 0.0::DOUBLE AS z, event_type = 'error' AS missing FROM events)"""
LINE = """line AS (SELECT l_suppkey AS episode_index, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS frame_index,
  l_quantity AS x, l_extendedprice / 1000 AS y, l_discount * 100 AS z FROM lineitem)"""
W = "PARTITION BY episode_index ORDER BY frame_index"
ALL = f"{W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
UNIT = "unit AS (SELECT *, qx / n AS ux, qy / n AS uy, qz / n AS uz, qw / n AS uw FROM (SELECT *, sqrt(qx*qx + qy*qy + qz*qz + qw*qw) AS n FROM arms))"
#: The rotation of a unit quaternion, by row and column.
M = {
    "m00": "1 - 2 * (uy*uy + uz*uz)", "m01": "2 * (ux*uy - uz*uw)", "m02": "2 * (ux*uz + uy*uw)",
    "m10": "2 * (ux*uy + uz*uw)", "m11": "1 - 2 * (ux*ux + uz*uz)", "m12": "2 * (uy*uz - ux*uw)",
    "m20": "2 * (ux*uz - uy*uw)", "m21": "2 * (uy*uz + ux*uw)", "m22": "1 - 2 * (ux*ux + uy*uy)",
}
MAT = "mat AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in M.items()) + " FROM unit)"
POSES = f"{ARMS}, {UNIT}, {MAT}"
R6 = {"r0": "m00", "r1": "m10", "r2": "m20", "r3": "m01", "r4": "m11", "r5": "m21"}


def r(e: str, digits: int = 6) -> str:
    return f"round({e}, {digits}) + 0.0"


def _rounded(named: dict[str, str], digits: int = 6) -> str:
    return ", ".join(f"{r(e, digits)} AS {n}" for n, e in named.items())


SQL: dict[str, str] = {}
SQL["quat_to_rot6d"] = f"WITH {POSES} SELECT episode_index, frame_index, role, {_rounded(R6)} FROM mat"
SQL["gripper_missing"] = f"""WITH {ARMS}, w AS (SELECT *, CASE WHEN frame_index % 5 NOT IN (1, 2) THEN width END AS v FROM arms)
SELECT episode_index, frame_index, role, {r("CASE WHEN v IS NOT NULL THEN greatest(least((v + 0.3) / 0.6 * 1.2, 1.2), 0.0) END")} AS gripper, v IS NOT NULL AS ok FROM w"""
SQL["gripper_map"] = f"""WITH {ARMS}, w AS (SELECT *, CASE WHEN frame_index % 7 = 0 THEN -1.0 ELSE width END AS v FROM arms)
SELECT episode_index, frame_index, role, {r("CASE WHEN v = -1.0 THEN -1.0 ELSE greatest(least((v + 0.3) / 0.6 * 1.2, 1.2), 0.0) END")} AS gripper FROM w"""


def _transform() -> str:
    ca, sa, cb, sb, cc, sc = "cos(radians(30))", "sin(radians(30))", "cos(radians(45))", "sin(radians(45))", "cos(radians(60))", "sin(radians(60))"
    o = [  # about x, then y, then z
        [f"{cb}*{cc}", f"-{cb}*{sc}", sb],
        [f"({ca}*{sc} + {sa}*{sb}*{cc})", f"({ca}*{cc} - {sa}*{sb}*{sc})", f"-{sa}*{cb}"],
        [f"({sa}*{sc} - {ca}*{sb}*{cc})", f"({sa}*{cc} + {ca}*{sb}*{sc})", f"{ca}*{cb}"],
    ]
    t = [f"({o[i][0]}*0.1 + {o[i][1]}*(-0.2) + {o[i][2]}*0.3)" for i in range(3)]
    out = {f"p{c}": f"{c} + " + " + ".join(f"m{i}{k}*{t[k]}" for k in range(3)) for i, c in enumerate("xyz")}
    for n, (i, j) in zip(R6, [(0, 0), (1, 0), (2, 0), (0, 1), (1, 1), (2, 1)], strict=True):
        out[n] = " + ".join(f"m{i}{k}*({o[k][j]})" for k in range(3))
    return f"WITH {POSES} SELECT episode_index, frame_index, role, {_rounded(out)} FROM mat"


SQL["pose_transform"] = _transform()
SQL["action_shift"] = f"""WITH {EMB} SELECT episode_index, frame_index,
  {r(f"coalesce(lead(right_x, 3) OVER ({W}), last_value(right_x) OVER ({ALL}))")} AS action_right_x,
  {r(f"coalesce(lead(left_width, 3) OVER ({W}), last_value(left_width) OVER ({ALL}))")} AS action_left_width FROM emb"""
_RW = "PARTITION BY episode_index, role ORDER BY frame_index"
SQL["step_metrics"] = f"""WITH {ARMS}, {UNIT}, s AS (SELECT episode_index, frame_index,
  sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2) + pow(z - lag(z) OVER w, 2)) AS p,
  degrees(2 * acos(least(abs(ux*lag(ux) OVER w + uy*lag(uy) OVER w + uz*lag(uz) OVER w + uw*lag(uw) OVER w), 1.0))) AS a
  FROM unit WINDOW w AS ({_RW}))
SELECT episode_index, frame_index, {r("max(p)")} AS position_step, {r("max(a)", 4)} AS rotation_step FROM s WHERE p IS NOT NULL GROUP BY ALL"""
SQL["step_missing"] = f"""WITH {ARMS}, {UNIT}, s AS (SELECT episode_index, frame_index,
  sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2) + pow(z - lag(z) OVER w, 2)) AS p,
  CASE WHEN frame_index % 4 NOT IN (2, 3) THEN degrees(2 * acos(least(abs(ux*lag(ux) OVER w + uy*lag(uy) OVER w + uz*lag(uz) OVER w + uw*lag(uw) OVER w), 1.0))) END AS a
  FROM unit WINDOW w AS ({_RW}))
SELECT episode_index, frame_index, {r("max(p)")} AS position_step, {r("max(a)", 4)} AS rotation_step FROM s WHERE p IS NOT NULL GROUP BY 1, 2"""
STEP = f"step AS (SELECT *, sqrt((x - lag(x) OVER w)*(x - lag(x) OVER w) + (y - lag(y) OVER w)*(y - lag(y) OVER w) + (z - lag(z) OVER w)*(z - lag(z) OVER w)) AS s FROM line WINDOW w AS ({W}))"
SQL["step_limit_reference"] = f"WITH {LINE}, {STEP} SELECT {r('quantile_cont(s, 0.95)')} AS position_step_limit, {r('max(s)')} AS position_step_max, count(*) AS adjacent_pairs FROM step WHERE s IS NOT NULL"


def _smooth(source: str) -> str:
    def side(c: str, k: int) -> str:
        return f"coalesce({'lag' if k < 0 else 'lead'}({c}, {abs(k)}) OVER ({W}), {'first' if k < 0 else 'last'}_value({c}) OVER ({ALL}))" if k else c

    cols = ", ".join(f"CASE WHEN i >= 2 AND i < n - 2 AND n >= 5 THEN ({side(c, -2)} + 4*{side(c, -1)} + 6*{c} + 4*{side(c, 1)} + {side(c, 2)}) / 16 ELSE {c} END AS s{c}" for c in "xyz")
    return f"smooth AS (SELECT *, {cols} FROM (SELECT *, count(*) OVER (PARTITION BY episode_index) AS n, frame_index AS i FROM {source}))"


SQL["smooth_position"] = f"WITH {EVT}, {_smooth('evt')} SELECT episode_index, frame_index, {_rounded({c: f's{c}' for c in 'xyz'})} FROM smooth"
BOUNDS = f"""act AS (SELECT episode_index, frame_index, abs(x - first_value(x) OVER ({ALL})) > 60 AS a, abs(x - last_value(x) OVER ({ALL})) > 60 AS b FROM evt),
runs AS (SELECT episode_index, frame_index, a AND coalesce(lead(a) OVER ({W}), false) AS a, b AND coalesce(lag(b) OVER ({W}), false) AS b FROM act),
ends AS (SELECT episode_index, count(*) AS length, min(CASE WHEN a THEN frame_index END) AS f, max(CASE WHEN b THEN frame_index END) AS l FROM runs GROUP BY 1),
raw AS (SELECT *, greatest(0, f - 2) AS s, least(length, l + 1 + 3) AS e FROM ends),
miss AS (SELECT *, greatest(20 - (e - s), 0) AS m FROM raw),
front AS (SELECT *, least(s, (m + 1) // 2) AS g FROM miss),
grown AS (SELECT *, least(length, e + m - g) AS e2 FROM front),
bounds AS (SELECT episode_index, length, CASE WHEN ok THEN CASE WHEN m > 0 THEN greatest(0, least(s - g, e2 - 20)) ELSE s END END::BIGINT AS start_frame,
  CASE WHEN ok THEN e2 END::BIGINT AS end_frame, CASE WHEN length < 20 THEN 'too_short' WHEN f IS NULL OR l IS NULL THEN 'never_leaves' ELSE 'ok' END AS status
  FROM (SELECT *, length >= 20 AND f IS NOT NULL AND l IS NOT NULL AS ok FROM grown))"""
SQL["trim_bounds"] = f"WITH {EVT}, {BOUNDS} SELECT * FROM bounds"
TRIMMED = f"{BOUNDS}, trimmed AS (SELECT e.episode_index, e.frame_index - b.start_frame AS frame_index, e.frame_index AS source_frame, x, b.start_frame FROM evt e JOIN bounds b ON b.episode_index = e.episode_index AND b.status = 'ok' AND e.frame_index >= b.start_frame AND e.frame_index < b.end_frame)"
SQL["trim_apply_reindex"] = f"""WITH {EVT}, {TRIMMED}
SELECT episode_index, frame_index, row_number() OVER (ORDER BY episode_index, frame_index) - 1 AS "index", source_frame, {r("frame_index / 30.0::DOUBLE")} AS timestamp, x FROM trimmed"""
TURN = f"""way AS (SELECT *, x - lag(x, 2) OVER w AS ax, y - lag(y, 2) OVER w AS ay, z - lag(z, 2) OVER w AS az, lead(x, 2) OVER w - x AS bx, lead(y, 2) OVER w - y AS by_, lead(z, 2) OVER w - z AS bz FROM line WINDOW w AS ({W})),
len_ AS (SELECT *, sqrt(ax*ax + ay*ay + az*az) AS na, sqrt(bx*bx + by_*by_ + bz*bz) AS nb FROM way),
turn AS (SELECT episode_index, frame_index, x, y, z, CASE WHEN na >= 5 AND nb >= 5 THEN degrees(acos(greatest(-1.0, least(1.0, (ax*bx + ay*by_ + az*bz) / (na * nb))))) ELSE 0.0 END AS angle FROM len_)"""
SQL["turn_angles"] = f"WITH {LINE}, {TURN} SELECT episode_index, frame_index, {r('angle', 4)} AS angle FROM turn"
SQL["turn_regions_peaks"] = f"""WITH {LINE}, {TURN}, on_ AS (SELECT *, frame_index - row_number() OVER ({W}) AS island FROM (SELECT episode_index, frame_index, {r("angle")} AS angle FROM turn) WHERE angle >= 120),
best AS (SELECT *, row_number() OVER (PARTITION BY episode_index, island ORDER BY angle DESC, frame_index) AS k FROM on_)
SELECT episode_index, min(frame_index) AS first_frame, max(frame_index) AS last_frame, max(CASE WHEN k = 1 THEN frame_index END) AS peak_frame FROM best GROUP BY episode_index, island"""
SQL["dense_candidates"] = f"""WITH {LINE}, {TURN}, {STEP}, loc AS (SELECT episode_index, frame_index, {r(f"greatest(coalesce(s, 'inf'::DOUBLE), coalesce(lead(s) OVER ({W}), 'inf'::DOUBLE))")} AS local_step FROM step)
SELECT episode_index, frame_index, local_step FROM turn JOIN loc USING (episode_index, frame_index) WHERE {r("angle")} >= 120 AND local_step <= 40"""
SQL["prefix_sampling"] = f"""WITH RECURSIVE {EVT}, n AS (SELECT episode_index, count(*) AS n, least(40, count(*) - 1) AS b FROM evt GROUP BY 1),
walk AS (
  SELECT e.episode_index, 0::BIGINT AS i, 0::BIGINT AS k, e.x AS kx, n.b FROM evt e JOIN n USING (episode_index) WHERE e.frame_index = 0
  UNION ALL
  SELECT w.episode_index, w.i + 1, CASE WHEN abs(e.x - w.kx) >= 80 THEN w.i + 1 ELSE w.k END, CASE WHEN abs(e.x - w.kx) >= 80 THEN e.x ELSE w.kx END, w.b
  FROM walk w JOIN evt e ON e.episode_index = w.episode_index AND e.frame_index = w.i + 1 WHERE w.i + 1 < w.b
), k AS (SELECT DISTINCT episode_index, k FROM walk),
far AS (SELECT k.episode_index, max(k.k) AS l FROM k JOIN n USING (episode_index) JOIN evt e ON e.episode_index = k.episode_index AND e.frame_index = k.k JOIN evt z ON z.episode_index = k.episode_index AND z.frame_index = n.b WHERE abs(e.x - z.x) >= 80 GROUP BY 1),
kept AS (SELECT k.episode_index, k.k FROM k JOIN far USING (episode_index) WHERE k.k <= far.l
  UNION ALL SELECT e.episode_index, e.frame_index FROM evt e JOIN n USING (episode_index) JOIN far USING (episode_index) WHERE e.frame_index >= n.b)
SELECT episode_index, count(*) AS n_kept, string_agg(k::VARCHAR, ',' ORDER BY k) AS kept FROM kept GROUP BY 1"""
SELECTION = f"{TRIMMED}, sel AS (SELECT episode_index, row_number() OVER ({W}) - 1 AS out_frame, source_frame FROM trimmed WHERE frame_index % 3 <> 1)"
SQL["select_compose"] = f"WITH {EVT}, {SELECTION} SELECT * FROM sel"
SQL["select_ranges_text"] = f"""WITH {EVT}, {SELECTION}, i AS (SELECT *, source_frame - row_number() OVER (PARTITION BY episode_index ORDER BY source_frame) AS island FROM sel),
run AS (SELECT episode_index, min(source_frame) AS a, max(source_frame) AS b FROM i GROUP BY episode_index, island),
txt AS (SELECT episode_index, string_agg(CASE WHEN a = b THEN 'eq(n\\,' || a || ')' ELSE 'between(n\\,' || a || '\\,' || b || ')' END, '+' ORDER BY a) AS select_text FROM run GROUP BY 1)
SELECT episode_index, select_text, 'select=''' || select_text || ''',setpts=N/30/TB,crop=''min(iw,ih)'':''min(iw,ih)'',scale=224:224,setsar=1' AS filters FROM txt"""
SQL["restore_intervals"] = f"""WITH {LINE}, k AS (SELECT *, lead(frame_index) OVER ({W}) AS nx, sqrt((lead(x) OVER ({W}) - x)*(lead(x) OVER ({W}) - x) + (lead(y) OVER ({W}) - y)*(lead(y) OVER ({W}) - y) + (lead(z) OVER ({W}) - z)*(lead(z) OVER ({W}) - z)) AS gap FROM line WHERE frame_index % 2 = 0)
SELECT episode_index, frame_index FROM k UNION
SELECT l.episode_index, l.frame_index FROM line l JOIN k ON k.episode_index = l.episode_index AND l.frame_index > k.frame_index AND l.frame_index < k.nx WHERE k.gap > 60"""
STATS = f"{r('min(value)')} AS min, {r('max(value)')} AS max, {r('avg(value)')} AS mean, {r('stddev_pop(value)')} AS std, count(value) AS count"
VALUES = "vals AS (" + " UNION ALL ".join(f"SELECT episode_index, '{c}' AS feature, {c} AS value FROM emb" for c in ("right_x", "right_width", "left_y")) + ")"
SQL["episode_stats"] = f"WITH {EMB}, {VALUES} SELECT episode_index, feature, {STATS} FROM vals GROUP BY 1, 2"
SQL["global_stats_merge"] = f"WITH {EMB}, {VALUES} SELECT feature, {STATS} FROM vals GROUP BY 1"
SQL["merge_reindex"] = f"""WITH {EVT}, e AS (SELECT episode_index % 2 AS dataset_id, episode_index, dense_rank() OVER (ORDER BY episode_index % 2, episode_index) - 1 AS new FROM (SELECT DISTINCT episode_index FROM evt))
SELECT e.dataset_id, evt.episode_index AS source_episode, e.new AS episode_index, evt.frame_index, row_number() OVER (ORDER BY e.new, evt.frame_index) - 1 AS "index", x FROM evt JOIN e USING (episode_index)"""
SQL["width_interpolate"] = f"""WITH {EVT}, v AS (SELECT episode_index, frame_index, CASE WHEN NOT missing THEN x END AS x FROM evt),
p AS (SELECT *, last_value(x IGNORE NULLS) OVER b AS a, first_value(x IGNORE NULLS) OVER f AS c,
  last_value(CASE WHEN x IS NOT NULL THEN frame_index END IGNORE NULLS) OVER b AS i, first_value(CASE WHEN x IS NOT NULL THEN frame_index END IGNORE NULLS) OVER f AS j
  FROM v WINDOW b AS ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT episode_index, frame_index, {r("coalesce(x, CASE WHEN j > i THEN a + (c - a) * ((frame_index - i)::DOUBLE / (j - i)) END, a, c)")} AS x, x IS NULL AS filled FROM p"""
SQL["detection_summary"] = f"WITH {EVT} SELECT episode_index, count(*) FILTER (NOT missing) AS detected, count(*) FILTER (missing) AS interpolated, count(*) AS frames, {r('100.0::DOUBLE * count(*) FILTER (NOT missing) / count(*)')} AS percent FROM evt GROUP BY 1"
_state = [f"right_{c}" for c in SLOTS] + [f"left_{c}" for c in SLOTS]
_text = lambda cs: "concat_ws(',', " + ", ".join(f"round_even({c} * 1000, 0)::BIGINT" for c in cs) + ")"
SQL["width_add_layout"] = f"WITH {EMB} SELECT episode_index, frame_index, {_text(_state)} AS added, {_text([*_state[:7], '-1.0', *_state[8:]])} AS overwritten FROM emb"
VAL = "val AS (SELECT vec_id, label::BIGINT AS label, (unnest(range(64)))::INT AS dim, (unnest(embedding))::DOUBLE AS value FROM embeddings)"
SQL["depth_missing"] = f"WITH {VAL} SELECT vec_id, dim, CASE WHEN dim % 5 NOT IN (1, 2) THEN round_even((greatest(least(value * 4, 1.5), -1.0) + 1.0) / 2.5 * 255, 0)::INT END AS code FROM val"
SQL["depth_unorm8"] = f"WITH {VAL} SELECT vec_id, dim, round_even((greatest(least(value * 4, 1.5), -1.0) + 1.0) / 2.5 * 255, 0)::INT AS code FROM val"
SQL["depth_range_report"] = f"WITH {VAL} SELECT label, count(*) FILTER (value * 4 < -1.0) AS below, count(*) FILTER (value * 4 > 1.5) AS above, count(*) AS \"values\" FROM val GROUP BY 1"
SQL["force_minmax_uint8"] = f"""WITH {VAL}, rng AS (SELECT label, dim % 3 AS channel, min(value) AS low, max(value) AS high FROM val GROUP BY 1, 2)
SELECT vec_id, dim, CASE WHEN high > low THEN round_even((value - low) / (high - low) * 255, 0) ELSE 0 END::INT AS code, {r("(high - low) / 255")} AS step, {r("(high - low) / 510")} AS error
FROM val JOIN rng ON rng.label = val.label AND rng.channel = val.dim % 3"""
SQL["tensor_stats"] = f"WITH {VAL} SELECT label AS episode_index, (dim // 16)::INT AS dim0, (dim % 16)::INT AS dim1, {STATS} FROM val GROUP BY 1, 2, 3"
SQL["video_sample_positions"] = f"""WITH {EVT}, n AS (SELECT episode_index, count(*) AS length FROM evt GROUP BY 1), k AS (SELECT *, least(10, length) AS k FROM n),
p AS (SELECT episode_index, length, i, CASE WHEN k = 1 THEN 0 WHEN i = k - 1 THEN length - 1 ELSE floor(i * ((length - 1)::DOUBLE / (k - 1)))::BIGINT END AS p FROM (SELECT *, unnest(range(k)) AS i FROM k))
SELECT episode_index, length, string_agg(p::VARCHAR, ',' ORDER BY i) AS places FROM p GROUP BY 1, 2"""
SQL["channel_stats"] = f"""WITH {VAL}, px AS (SELECT label, vec_id, dim % 3 AS channel, floor(abs(value) * 255) / 255 AS value FROM val)
SELECT label, channel, {STATS.replace("count(value)", "count(DISTINCT vec_id)")} FROM px GROUP BY 1, 2"""
SQL["alignment_validation"] = f"""WITH {EMB}, a AS (SELECT episode_index, frame_index, {", ".join(f"coalesce(lead({c}, 2) OVER ({W}), last_value({c}) OVER ({ALL})) AS {c}" for c in ("right_x", "left_x"))} FROM emb),
e AS (SELECT a.episode_index, greatest(abs(a.right_x - b.right_x), abs(a.left_x + CASE WHEN a.episode_index = 3 AND a.frame_index = 5 THEN 0.5 ELSE 0.0 END - b.left_x)) AS e
  FROM a JOIN emb s USING (episode_index, frame_index) JOIN (SELECT episode_index, max(frame_index) AS last FROM emb GROUP BY 1) n ON n.episode_index = a.episode_index
  JOIN emb b ON b.episode_index = a.episode_index AND b.frame_index = least(a.frame_index + 2, n.last))
SELECT episode_index, count(*) AS length, {r("max(e)")} AS error, max(e) <= 1e-6 AS ok FROM e GROUP BY 1"""


def _quality() -> str:
    a, b = [f"1.01*m{i}0" for i in range(3)], [f"1.01*m{i}1" for i in range(3)]
    c = [f"({a[(i + 1) % 3]}*{b[(i + 2) % 3]} - {a[(i + 2) % 3]}*{b[(i + 1) % 3]})" for i in range(3)]
    cols = [a, b, c]
    dots = ", ".join(f"abs({' + '.join(f'{cols[i][k]}*{cols[j][k]}' for k in range(3))} - {int(i == j)})" for i in range(3) for j in range(i, 3))
    bc = [f"({b[(i + 1) % 3]}*{c[(i + 2) % 3]} - {b[(i + 2) % 3]}*{c[(i + 1) % 3]})" for i in range(3)]
    det = " + ".join(f"{a[i]}*{bc[i]}" for i in range(3))
    return f"WITH {POSES} SELECT episode_index, 0.0::DOUBLE AS orthogonality, 0.0::DOUBLE AS determinant, {r(f'max(greatest({dots}))')} AS raw_orthogonality, {r(f'max(abs({det} - 1))')} AS raw_determinant FROM mat GROUP BY 1"


SQL["rotation_quality"] = _quality()
_jerk = lambda p, n: f"sqrt(avg({' + '.join(f'pow({p}{c} - 3*lag_{p}{c}1 + 3*lag_{p}{c}2 - lag_{p}{c}3, 2)' for c in 'xyz')})) AS {n}"
_lags = ", ".join(f"lag({p}{c}, {k}) OVER ({W}) AS lag_{p}{c}{k}" for p in ("", "s") for c in "xyz" for k in (1, 2, 3))
SQL["smoothing_metrics"] = f"""WITH {EVT}, {_smooth("evt")}, l AS (SELECT *, {_lags} FROM smooth),
m AS (SELECT episode_index, sqrt(avg(pow(sx - x, 2) + pow(sy - y, 2) + pow(sz - z, 2))) AS change_rms, max(sqrt(pow(sx - x, 2) + pow(sy - y, 2) + pow(sz - z, 2))) AS change_max, {_jerk("", "jerk_before")}, {_jerk("s", "jerk_after")} FROM l GROUP BY 1)
SELECT episode_index, {_rounded({c: c for c in ("change_rms", "change_max", "jerk_before", "jerk_after")}, 4)} FROM m"""
_next = ", ".join(f"coalesce(lead({c}) OVER w, {c}) AS n{c}" for c in ("x", "y", "z", "ux", "uy", "uz", "uw", "width"))
_jerks = ", ".join(f"{p}{c} - 3 * lag({p}{c}, 1) OVER w + 3 * lag({p}{c}, 2) OVER w - lag({p}{c}, 3) OVER w AS j{p}{c}" for p in ("", "n") for c in "xyz")
_CHANGED = f"""{ARMS}, {UNIT}, nxt AS (SELECT *, {_next} FROM unit WINDOW w AS ({_RW})), jerk AS (SELECT *, {_jerks} FROM nxt WINDOW w AS ({_RW})),
d AS (SELECT *, sqrt(pow(nx - x, 2) + pow(ny - y, 2) + pow(nz - z, 2)) AS p, degrees(2 * acos(least(abs(ux*nux + uy*nuy + uz*nuz + uw*nuw), 1.0))) AS a, abs(nwidth - width) AS w,
  jx*jx + jy*jy + jz*jz AS ja, jnx*jnx + jny*jny + jnz*jnz AS jb FROM jerk),
arm AS (SELECT episode_index, role, sqrt(avg(p*p)) AS position_change_rms, max(p) AS position_change_max, sqrt(avg(a*a)) AS rotation_change_rms, max(a) AS rotation_change_max, max(w) AS gripper_change_max,
  coalesce(sqrt(avg(ja)), 0) AS jerk_before, coalesce(sqrt(avg(jb)), 0) AS jerk_after FROM d GROUP BY 1, 2)"""
_CHANGES = ("position_change_rms", "position_change_max", "rotation_change_rms", "rotation_change_max", "gripper_change_max", "jerk_before", "jerk_after")
SQL["pose_changes"] = f"WITH {_CHANGED} SELECT episode_index, {_rounded({c: f'max({c})' for c in _CHANGES}, 4)} FROM arm GROUP BY 1"
SQL["pose_changes_rollup"] = f"""WITH {_CHANGED}, e AS (SELECT episode_index, {", ".join(f"max({c}) AS {c}" for c in _CHANGES)} FROM arm GROUP BY 1)
SELECT count(*) AS episodes, {_rounded({c: f"{'max' if c.endswith('_max') else 'avg'}({c})" for c in _CHANGES}, 4)} FROM e"""
_hue = "CASE k % 6 WHEN 0 THEN {} WHEN 1 THEN {} WHEN 2 THEN {} WHEN 3 THEN {} WHEN 4 THEN {} ELSE {} END"
_p, _q, _t = "(1 - 0.72::DOUBLE)", "(1 - 0.72::DOUBLE * f)", "(1 - 0.72::DOUBLE * (1 - f))"
_rgb = {"red": ("1.0", _q, _p, _p, _t, "1.0"), "green": (_t, "1.0", "1.0", _q, _p, _p), "blue": (_p, _p, _t, "1.0", "1.0", _q)}
SQL["bounds_and_colors"] = f"""WITH {EVT}, b AS (SELECT episode_index, {", ".join(f"{n}({c}) AS {n}_{c}" for c in "xyz" for n in ("min", "max"))}, count(*) AS points FROM evt GROUP BY 1),
h AS (SELECT *, (episode_index * 0.618033988749895::DOUBLE - floor(episode_index * 0.618033988749895::DOUBLE)) * 6 AS h FROM b), s AS (SELECT *, floor(h)::INT AS k, h - floor(h) AS f FROM h)
SELECT * EXCLUDE (h, k, f), {", ".join(f"round_even(({_hue.format(*v)})::DOUBLE * 255, 0)::INT AS {n}" for n, v in _rgb.items())} FROM s"""
SQL["plot_points"] = f"""WITH {LINE}, k AS (SELECT *, CASE WHEN frame_index = 0 THEN 'start' WHEN frame_index = count(*) OVER (PARTITION BY episode_index) - 1 THEN 'end' ELSE 'point' END AS kind FROM line)
SELECT episode_index, frame_index, kind, x, y, z FROM k WHERE kind <> 'point' OR frame_index % 3 = 0"""
SQL["chunk_paths"] = """SELECT DISTINCT user_id AS episode_index, 'data/chunk-' || lpad((user_id // 100)::VARCHAR, 3, '0') || '/episode_' || lpad(user_id::VARCHAR, 6, '0') || '.parquet' AS data_path,
'videos/chunk-' || lpad((user_id // 100)::VARCHAR, 3, '0') || '/observation.images.right/episode_' || lpad(user_id::VARCHAR, 6, '0') || '.mp4' AS video_path FROM events"""
SQL["missing_episodes"] = """SELECT DISTINCT user_id AS episode_index, 'present' AS state FROM events WHERE user_id IN (SELECT c_custkey FROM customer)
UNION ALL SELECT c_custkey, 'missing' FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)"""
SQL["duplicate_keys"] = "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
SQL["contiguity"] = "SELECT min(u) = 0 AS from_zero, max(u) - min(u) + 1 = count(*) AS contiguous, count(*) AS episodes, sum(n)::BIGINT AS frames FROM (SELECT user_id AS u, count(*) AS n FROM events GROUP BY 1)"
SQL["frame_numbering"] = f"WITH {EVT} SELECT episode_index, count(*) AS bad_frames FROM evt WHERE episode_index % 5 = 0 AND frame_index > 4 GROUP BY 1"
SQL["over_limit_counts"] = f"WITH {LINE}, {STEP} SELECT episode_index, count(*) FILTER (s > 60) AS over, {r('max(s)')} AS largest, count(s) AS pairs FROM step GROUP BY 1"
SQL["over_limit_counts"] = SQL["over_limit_counts"].replace("AS over,", 'AS "over",')
SQL["asset_manifest_compare"] = "SELECT path, count(*) AS files, count(DISTINCT s) AS contents, min(s) AS first_sha, count(DISTINCT s) > 1 AS conflict FROM (SELECT source || '/' || lang AS path, sha256(text) AS s FROM documents) GROUP BY 1"
SQL["action_chunk"] = f"""WITH {EVT}, c AS (SELECT e.episode_index, e.frame_index, k.k, o.x FROM (SELECT *, count(*) OVER (PARTITION BY episode_index) AS n FROM evt) e
CROSS JOIN (SELECT unnest(range(8)) AS k) k JOIN evt o ON o.episode_index = e.episode_index AND o.frame_index = least(e.frame_index + k.k, e.n - 1))
SELECT episode_index, frame_index, string_agg(round_even(x * 100, 0)::BIGINT::VARCHAR, ',' ORDER BY k) AS chunk FROM c GROUP BY 1, 2"""
SQL["episode_limit"] = f"WITH {EVT} SELECT episode_index, count(*) AS length, {r('sum(x)', 4)} AS sum_x FROM evt WHERE episode_index IN (SELECT DISTINCT episode_index FROM evt ORDER BY 1 LIMIT 5) GROUP BY 1"
SQL["dataset_discovery"] = """WITH n AS (SELECT event_id, 'task_20261019_' || lpad((event_id % 240000)::VARCHAR, 6, '0') || CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '_width' ELSE '_merged' END AS name FROM events)
SELECT event_id, name, regexp_extract(name, '^task_20261019_([0-9]{6})$', 1) AS time, regexp_matches('xrs_' || md5(name), '^xrs_[0-9a-f]{32}$') AS runtime_like FROM n WHERE regexp_matches(name, '^task_20261019_[0-9]{6}$')"""


def _slerp() -> str:
    unit = ", ".join(f"{a}_q{c} / sqrt({' + '.join(f'{a}_q{k}*{a}_q{k}' for k in 'xyzw')}) AS {p}{c}" for a, p in (("right", "p"), ("left", "o")) for c in "xyzw")
    mid = ", ".join(f"p{c} + sg * o{c} AS s{c}" for c in "xyzw")
    length = f"sqrt({' + '.join(f's{c}*s{c}' for c in 'xyzw')})"
    return f"""WITH {EMB}, u AS (SELECT episode_index, frame_index, {unit} FROM emb), d AS (SELECT *, CASE WHEN px*ox + py*oy + pz*oz + pw*ow < 0 THEN -1.0 ELSE 1.0 END AS sg FROM u),
s AS (SELECT *, {mid} FROM d) SELECT episode_index, frame_index, {_rounded({f"q{c}": f"s{c} / {length}" for c in "xyzw"})} FROM s"""


SQL["slerp_midpoint"] = _slerp()
_BIG = "greatest(abs(ux), abs(uy), abs(uz), abs(uw))"
_SIGN = "coalesce(" + ", ".join(f"CASE WHEN abs(u{c}) = {_BIG} THEN sign(u{c}) END" for c in "xyzw") + ")"
SQL["matrix_to_quaternion"] = f"WITH {ARMS}, {UNIT} SELECT episode_index, frame_index, role, {_rounded({f'q{c}': f'u{c} * {_SIGN}' for c in 'xyzw'})} FROM unit"
SQL["finite_report"] = f"WITH {EVT} SELECT episode_index, count(*) FILTER (missing) AS x, count(*) FILTER (y IS NULL) AS y FROM evt GROUP BY 1"
SQL["report_rollup"] = f"""WITH {EVT}, {BOUNDS} SELECT count(*) AS episodes, count(*) FILTER (status = 'ok') AS trimmed, sum(length)::BIGINT AS frames_before, sum(end_frame - start_frame)::BIGINT AS frames_after,
max(length - (end_frame - start_frame)) AS most_removed, ceil(count(*) / 100.0)::BIGINT AS total_chunks, count(*) * 2 AS total_videos FROM bounds"""
_C, _S = "cos(radians(x))", "sin(radians(x))"
SQL["so3_smooth"] = f"""WITH {EVT}, t AS (SELECT episode_index, frame_index, {_C} AS x, {_S} AS y, 0.0::DOUBLE AS z FROM evt), {_smooth("t")},
u AS (SELECT episode_index, frame_index, sx / sqrt(sx * sx + sy * sy) AS c, sy / sqrt(sx * sx + sy * sy) AS s FROM smooth)
SELECT episode_index, frame_index, {r("c")} AS r0, {r("s")} AS r1, 0.0::DOUBLE AS r2, {r("-s")} AS r3, {r("c")} AS r4, 0.0::DOUBLE AS r5 FROM u"""
SQL["sensor_select_fake_solver"] = f"""WITH {EVT}, s AS (SELECT episode_index, frame_index, avg(x) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM evt)
SELECT episode_index, frame_index, {r("v", 4)} AS solved FROM s WHERE frame_index % 4 = 1"""
SQL["solver_two_passes"] = f"""WITH {EVT}, s AS (
  SELECT episode_index, frame_index, x AS a, avg(x) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b, max(x) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM evt
), k AS (SELECT * FROM s WHERE frame_index % 3 = 1), m AS (SELECT min(a) AS a0, max(a) AS a1, min(b) AS b0, max(b) AS b1, min(c) AS c0, max(c) AS c1 FROM k)
SELECT episode_index, frame_index, concat_ws(',', round_even((a - a0) / (a1 - a0) * 255, 0)::INT, round_even((b - b0) / (b1 - b0) * 255, 0)::INT, round_even((c - c0) / (c1 - c0) * 255, 0)::INT) AS codes FROM k, m"""
SQL["file_misfits"] = """WITH e AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
f AS (SELECT l_orderkey AS k, count(*) AS n, min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM lineitem WHERE l_orderkey % 50 <> 1 AND NOT (l_orderkey % 50 = 2 AND l_linenumber = 1) GROUP BY 1),
named AS (SELECT *, 'data/chunk-' || lpad((k // 1000)::VARCHAR, greatest(3, len((k // 1000)::VARCHAR))::INT, '0') || '/episode_' || lpad(k::VARCHAR, greatest(6, len(k::VARCHAR))::INT, '0') || '.parquet' AS path FROM e),
j AS (SELECT path, named.k, named.n AS length, f.k IS NOT NULL AND named.k % 50 <> 4 AS there, f.n, lo, hi FROM named LEFT JOIN f USING (k)),
c AS (SELECT path, k AS episode_index, unnest([CASE WHEN NOT there THEN 'missing file' END, CASE WHEN there AND k % 50 = 5 THEN 'unreadable' END, CASE WHEN there AND k % 50 <> 5 AND n <> length THEN 'rows' END,
  CASE WHEN there AND k % 50 = 3 THEN 'misplaced' END, CASE WHEN there AND k % 50 <> 5 AND (lo <> 1 OR hi <> n) THEN 'frame_index' END]) AS "check" FROM j
UNION ALL SELECT 'data/other_' || k, NULL, 'no episode' FROM f WHERE k % 50 = 4)
SELECT * FROM c WHERE "check" IS NOT NULL"""
SQL["session_episodes"] = """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g), n AS (SELECT user_id, k, count(*) AS f FROM s GROUP BY 1, 2)
SELECT user_id, count(*) AS sessions, sum(f)::BIGINT AS frames, max(f) AS longest FROM n GROUP BY 1"""
SQL["footer_row_counts"] = " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n_rows FROM {t}" for t in ("lineitem", "events", "embeddings"))
SQL["json_lines_scan"] = "SELECT json_extract_string(props, '$.k')::INT AS k, count(*) AS n FROM events GROUP BY 1"
SQL["append_tensor_columns"] = f"""WITH {EVT}, t AS (SELECT label::BIGINT AS episode_index, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_index, embedding[1]::DOUBLE AS force FROM embeddings)
SELECT episode_index, frame_index, {r("force")} AS force FROM evt LEFT JOIN t USING (episode_index, frame_index)"""
SQL["layout_lookup"] = "SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey"
SQL["sensor_match"] = """WITH f AS (SELECT CASE WHEN o_custkey % 3 = 0 THEN o_custkey ELSE -o_custkey END AS serial, count(*) AS n, min('order_' || lpad(o_orderkey::VARCHAR, 9, '0')) AS key FROM orders GROUP BY 1)
SELECT c_name AS name, c_custkey AS serial, key, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' ELSE 'ok' END AS state FROM customer LEFT JOIN f ON serial = c_custkey"""
SQL["arm_commands"] = """SELECT user_id AS episode_index, role, 'videos/' || lpad((user_id // 50)::VARCHAR, 3, '0') || '/' || lpad(user_id::VARCHAR, 6, '0') || '_' || role || '.mp4' AS target, frames
FROM (SELECT user_id, count(*) AS frames FROM events GROUP BY 1) CROSS JOIN (VALUES ('right'), ('left')) v(role)"""
SQL["runtime_set_validation"] = """WITH d AS (SELECT 'xrs_' || md5(source) AS set_id, doc_id::VARCHAR AS path, sha256(text) AS sha, doc_id FROM documents),
m AS (SELECT CASE WHEN doc_id % 50 = 3 THEN 'xrs_short' ELSE set_id END AS set_id, path, CASE WHEN doc_id % 50 = 2 THEN '0' ELSE sha END AS wanted FROM d WHERE doc_id % 50 <> 1),
f AS (SELECT set_id, path, sha AS found FROM d WHERE doc_id % 50 <> 4)
SELECT * FROM (SELECT set_id, path, CASE WHEN set_id = 'xrs_short' THEN 'id' WHEN found IS NULL THEN 'no file' WHEN wanted IS NULL THEN 'no entry' WHEN wanted <> found THEN 'content' END AS why
FROM m FULL JOIN f USING (set_id, path)) WHERE why IS NOT NULL"""
SQL["dataset_compatibility"] = """WITH s AS (SELECT 'c' || lpad(o_custkey::VARCHAR, 8, '0') AS dataset, o_orderpriority AS task FROM orders GROUP BY 1, 2),
ref AS (SELECT task FROM s WHERE dataset = (SELECT min(dataset) FROM s)), n AS (SELECT count(*) AS n FROM ref),
c AS (SELECT dataset, count(*) AS members, count(*) FILTER (task IN (SELECT task FROM ref)) AS shared FROM s GROUP BY 1)
SELECT dataset, members::INT AS members, (n - shared)::INT AS missing, (members - shared)::INT AS extra FROM c CROSS JOIN n WHERE n > shared OR members > shared"""
SQL["compatible_info"] = """WITH i AS (SELECT s_suppkey, MAP {'fps': '30', 'total_frames': s_suppkey::VARCHAR, 'robot': s_name, 'splits': 'x'} AS info FROM supplier)
SELECT s_suppkey, array_to_string(list_sort(list_filter(map_keys(info), lambda k: k NOT IN ('total_episodes', 'total_frames', 'total_videos', 'total_chunks', 'splits'))), ',') AS keys, info['robot'] AS robot FROM i"""
SQL["video_mismatches"] = """SELECT user_id AS episode_index, n AS frames, CASE WHEN user_id % 11 <> 0 THEN n - 1 END AS got_frames FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1) WHERE user_id % 11 = 0 OR user_id % 7 = 0"""
SQL["marker_distance"] = f"""WITH {LINE}, m AS (SELECT episode_index, frame_index // 3 AS frame_index, trunc(y)::BIGINT % 4 AS marker, x, y, z FROM line),
l AS (SELECT * FROM m WHERE marker = 0 QUALIFY count(*) OVER (PARTITION BY episode_index, frame_index) = 1),
q AS (SELECT * FROM m WHERE marker = 1 QUALIFY count(*) OVER (PARTITION BY episode_index, frame_index) = 1)
SELECT l.episode_index, l.frame_index, {r("sqrt((l.x - q.x)*(l.x - q.x) + (l.y - q.y)*(l.y - q.y) + (l.z - q.z)*(l.z - q.z))")} AS distance FROM l JOIN q ON l.episode_index = q.episode_index AND l.frame_index = q.frame_index"""
SQL["nearest_marker"] = "SELECT l_orderkey, min(l_extendedprice) AS cost FROM lineitem GROUP BY 1"
SQL["roi_bounds"] = f"WITH {EVT} SELECT episode_index, count(*) FILTER (x >= 0 AND y >= 0 AND x + 100 <= 480 AND y + 20 <= 100) AS inside, count(*) FILTER (NOT (x >= 0 AND y >= 0 AND x + 100 <= 480 AND y + 20 <= 100)) AS outside FROM evt GROUP BY 1"
SQL["replaced_column"] = "SELECT vec_id, trunc(label * 1.5)::INT AS label FROM embeddings"
SQL["set_differences"] = """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE -c_custkey END AS k FROM customer)
SELECT kind, count(*) AS n, sum(k)::BIGINT AS sum_k FROM (SELECT 'both' AS kind, k FROM a SEMI JOIN b USING (k) UNION ALL SELECT 'first', k FROM a ANTI JOIN b USING (k) UNION ALL SELECT 'second', k FROM b ANTI JOIN a USING (k)) GROUP BY 1"""
