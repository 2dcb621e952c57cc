"""DuckDB SQL of the curation queries, built from shared pieces."""

from __future__ import annotations

from tamis.config import Config


def light(one_video: bool = False) -> str:
    video = "'v'" if one_video else "'v' || label"
    return f"""light AS (SELECT {video} AS video_id, vec_id AS idx, vec_id / 30.0::DOUBLE AS t_sec, embedding::DOUBLE[] AS embed,
  40.0::DOUBLE + 4.0::DOUBLE * value AS sharpness, (15 + vec_id * 37 % 70)::DOUBLE AS contrast,
  (vec_id * 53 % 101) / 100.0::DOUBLE AS exposure_score, (user_id * 29 % 101) / 100.0::DOUBLE AS noise_score, value AS hf_energy,
  1.205::DOUBLE + (vec_id * 31 % 90) / 100.0::DOUBLE AS view_entropy, (vec_id * 17 % 101) / 100.0::DOUBLE AS green_cover,
  (60 + vec_id * 13 % 120)::DOUBLE AS lighting_mean FROM embeddings JOIN events ON event_id = vec_id)"""


def scale(x: str, lo: float, hi: float) -> str:
    return f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, ({x} - {lo!r}::DOUBLE) / {hi - lo + 1e-9!r}::DOUBLE))"


def quality(c: Config) -> str:
    w = [f"{x!r}::DOUBLE" for x in c.components]
    return f"{w[0]} * {scale('sharpness', *c.sharpness_range)} + {w[1]} * {scale('contrast', *c.contrast_range)} + {w[2]} * exposure_score + {w[3]} * noise_score"


def prefiltered(c: Config) -> str:
    return f"pre AS (SELECT *, {quality(c)} AS quality FROM light WHERE sharpness >= {c.min_sharpness} AND contrast >= {c.min_contrast})"


UNIT = "list_transform(embed, lambda x: x / (sqrt(list_dot_product(embed, embed)) + 1e-9::DOUBLE))"


def scored(c: Config) -> str:
    """The novelty fold as recursion over each collection's frames with the last prototypes as state."""
    m = c.novelty_memory
    nov = "CASE WHEN len(w.protos) = 0 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1 - list_max(list_transform(w.protos, lambda p: list_dot_product(p, o.unit))))) END"
    return f"""ordered AS (SELECT video_id, idx, {UNIT} AS unit, row_number() OVER (PARTITION BY video_id ORDER BY idx) AS rn FROM pre),
walk AS (SELECT video_id, rn, idx, 1.0::DOUBLE AS novelty, [unit] AS protos FROM ordered WHERE rn = 1
  UNION ALL SELECT video_id, rn, idx, novelty, CASE WHEN novelty > {c.novelty_threshold!r}::DOUBLE THEN list_append(protos, unit)[-{m}:] ELSE protos END
  FROM (SELECT o.video_id, o.rn, o.idx, o.unit, w.protos, {nov} AS novelty FROM walk w JOIN ordered o ON o.video_id = w.video_id AND o.rn = w.rn + 1)),
scored AS (SELECT pre.*, walk.novelty AS content_novelty, {c.quality_weight!r}::DOUBLE * quality + {c.novelty_weight!r}::DOUBLE * walk.novelty AS ml_score
  FROM pre JOIN walk USING (video_id, idx))"""


def binned(c: Config, source: str = "scored") -> str:
    return f"""cuts AS (SELECT video_id, quantile_cont(hf_energy::FLOAT, {c.altitude_quantile}) AS hf_cut FROM {source} GROUP BY video_id),
binned AS (SELECT {source}.*, CASE WHEN hf_energy >= hf_cut THEN 'low' ELSE 'high' END AS altitude,
  CASE WHEN view_entropy >= {c.view_entropy!r}::DOUBLE THEN 'nadir' ELSE 'oblique' END AS view, CASE WHEN green_cover >= {c.cover_ratio!r}::DOUBLE THEN 'dense' ELSE 'sparse' END AS cover,
  CASE WHEN lighting_mean < {c.lighting_mean!r}::DOUBLE THEN 'dark' ELSE 'bright' END AS lighting FROM {source} JOIN cuts USING (video_id))"""


KEY = "concat_ws('|', 'altitude:' || altitude, 'view:' || view, 'cover:' || cover, 'lighting:' || lighting)"
RANKED = f"ranked AS (SELECT *, {KEY} AS combo_key, row_number() OVER (PARTITION BY video_id ORDER BY ml_score DESC, idx) AS rank FROM binned)"


def goals(c: Config) -> str:
    """``goals(combo_ord, combo_key, ratio)`` from the raw weights, shares and products made in SQL."""
    rows = [f"({i}, '{a}', {j}, '{v}', {float((c.targets or {}).get(a, {}).get(v, 1.0))!r}::DOUBLE)" for i, (a, vs) in enumerate(c.axes.items()) for j, v in enumerate(vs)]
    a, b, e, g = (f"(SELECT * FROM share WHERE axis = '{x}')" for x in c.axes)
    return f"""raw(i, axis, j, value, w) AS (VALUES {', '.join(rows)}),
share AS (SELECT *, w / (sum(w) OVER (PARTITION BY axis) + 1e-12::DOUBLE) AS s FROM raw),
grid AS (SELECT (a.j * 8 + b.j * 4 + e.j * 2 + g.j)::INT AS combo_ord, 'altitude:' || a.value || '|view:' || b.value || '|cover:' || e.value || '|lighting:' || g.value AS combo_key, a.s * b.s * e.s * g.s AS p
  FROM {a} a, {b} b, {e} e, {g} g),
goals AS (SELECT combo_ord, combo_key, p / (sum(p) OVER () + 1e-12::DOUBLE) AS ratio FROM grid)"""


def compiled(c: Config, weights: str) -> str:
    """Targets of each collection of ``light``; ``weights`` is a query of (video_id, axis, value, weight)."""
    rows = [f"('{a}', {j}, '{v}')" for a, vs in c.axes.items() for j, v in enumerate(vs)]
    a, b, e, g = (f"(SELECT * FROM share WHERE axis = '{x}')" for x in c.axes)
    return f"""weights AS ({weights}), known(axis, j, value) AS (VALUES {', '.join(rows)}),
raw AS (SELECT v.video_id, axis, j, value, coalesce(weight, 1)::DOUBLE AS w FROM (SELECT DISTINCT video_id FROM light) v CROSS JOIN known LEFT JOIN weights USING (video_id, axis, value)),
share AS (SELECT *, w / (sum(w) OVER (PARTITION BY video_id, axis) + 1e-12::DOUBLE) AS s FROM raw),
grid AS (SELECT a.video_id, (a.j * 8 + b.j * 4 + e.j * 2 + g.j)::INT AS combo_ord, a.value AS altitude, b.value AS view, e.value AS cover, g.value AS lighting, a.s * b.s * e.s * g.s AS p
  FROM {a} a JOIN {b} b USING (video_id) JOIN {e} e USING (video_id) JOIN {g} g USING (video_id))
SELECT video_id, combo_ord, 'altitude:' || altitude || '|view:' || view || '|cover:' || cover || '|lighting:' || lighting AS combo_key, altitude, view, cover, lighting,
  round(p / (sum(p) OVER (PARTITION BY video_id) + 1e-12::DOUBLE), 6) AS ratio FROM grid"""


def stratified(c: Config, size: int) -> str:
    """The stratified fold; the state is the list of accepted combination keys."""
    sparse = "len(list_filter(w.picked, lambda k: contains(k, 'cover:sparse')))"
    n = "len(w.picked)"
    ok = f"""{n} < {size} AND NOT (r.cover = 'sparse' AND {n} > 0 AND {sparse}::DOUBLE / {n} >= {c.sparse_cap!r}::DOUBLE)
    AND (CASE WHEN {n} = 0 THEN 0.0::DOUBLE ELSE len(list_filter(w.picked, lambda k: k = r.combo_key))::DOUBLE / {n} END < r.ratio OR r.ml_score > {c.high_quality!r}::DOUBLE)"""
    return f"""{goals(c)},
shared AS (SELECT ranked.*, coalesce(ratio, 0.0::DOUBLE) AS ratio FROM ranked LEFT JOIN goals USING (combo_key)),
picks AS (SELECT DISTINCT video_id, 0::BIGINT AS rank, false AS accepted, []::VARCHAR[] AS picked FROM shared
  UNION ALL SELECT video_id, rank, accepted, CASE WHEN accepted THEN list_append(picked, combo_key) ELSE picked END
  FROM (SELECT r.video_id, r.rank, r.combo_key, w.picked, {ok} AS accepted FROM picks w JOIN shared r ON r.video_id = w.video_id AND r.rank = w.rank + 1)),
strat AS (SELECT ranked.* FROM ranked JOIN picks USING (video_id, rank) WHERE accepted)"""


def filled(size: int) -> str:
    return f"""short AS (SELECT r.*, row_number() OVER (PARTITION BY video_id ORDER BY rank) AS nth FROM ranked r ANTI JOIN strat USING (video_id, idx)),
had AS (SELECT video_id, count(*) AS have FROM strat GROUP BY video_id),
chosen0 AS (SELECT *, 0 AS phase FROM strat UNION ALL SELECT short.* EXCLUDE (nth), 1 AS phase FROM short LEFT JOIN had USING (video_id) WHERE nth <= {size} - coalesce(have, 0)),
chosen AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY phase, rank) AS prelim_ord FROM chosen0)"""


def top_fraction(ratio: float) -> str:
    return f"""chosen AS (SELECT * EXCLUDE (n), rank AS prelim_ord, 0 AS phase FROM (SELECT *, count(*) OVER (PARTITION BY video_id) AS n FROM ranked)
  WHERE rank <= greatest(1, floor(n * {ratio!r}::DOUBLE)))"""


def greedy(source: str, threshold: float) -> str:
    """Greedy selection as recursion by ``ord``; ``source(video_id, ord, unit)``. The state is the list of kept ordinals, and pairs stand in a table."""
    return f"""sim AS (SELECT a.video_id, b.ord AS ord, list(a.ord) AS near FROM {source} a JOIN {source} b ON a.video_id = b.video_id AND a.ord < b.ord
  AND list_dot_product(a.unit, b.unit) > {threshold!r}::DOUBLE GROUP BY a.video_id, b.ord),
graph AS (SELECT s.video_id, s.ord, coalesce(near, []::BIGINT[]) AS near FROM {source} s LEFT JOIN sim USING (video_id, ord)),
greedy AS (SELECT DISTINCT video_id, 0::BIGINT AS ord, []::BIGINT[] AS kept FROM graph
  UNION ALL SELECT g.video_id, g.ord, CASE WHEN len(list_intersect(k.kept, g.near)) = 0 THEN list_append(k.kept, g.ord) ELSE k.kept END
  FROM greedy k JOIN graph g ON g.video_id = k.video_id AND g.ord = k.ord + 1),
kept AS (SELECT video_id, unnest(kept) AS ord FROM (SELECT video_id, arg_max(kept, ord) AS kept FROM greedy GROUP BY video_id))"""


def reach(source: str, eps: float, min_samples: int = 1) -> str:
    """Density clusters: ``labels(video_id, ord, label)``; ``source(video_id, ord, unit)``."""
    near = f"""near AS (SELECT a.video_id, a.ord AS a, b.ord AS b FROM {source} a JOIN {source} b ON a.video_id = b.video_id AND list_dot_product(a.unit, b.unit) >= {1 - eps - 1e-12!r}::DOUBLE AND a.ord <> b.ord)"""
    core = f"core AS (SELECT s.video_id, s.ord FROM {source} s LEFT JOIN (SELECT video_id, a AS ord, count(*) AS n FROM near GROUP BY ALL) d USING (video_id, ord) WHERE coalesce(n, 0) + 1 >= {min_samples})"
    return f"""{near}, {core},
inner_edges AS (SELECT n.* FROM near n SEMI JOIN core c ON n.video_id = c.video_id AND n.a = c.ord SEMI JOIN core d ON n.video_id = d.video_id AND n.b = d.ord),
spread AS (SELECT video_id, ord, ord AS root FROM core UNION SELECT e.video_id, e.b, s.root FROM spread s JOIN inner_edges e ON e.video_id = s.video_id AND e.a = s.ord AND s.root < e.b),
named AS (SELECT video_id, ord, min(root) AS root FROM spread GROUP BY ALL),
border AS (SELECT n.video_id, n.a AS ord, min(root) AS root FROM near n JOIN named d ON d.video_id = n.video_id AND d.ord = n.b ANTI JOIN core c ON c.video_id = n.video_id AND c.ord = n.a GROUP BY ALL),
labels AS (SELECT s.video_id, s.ord, coalesce(m.root, b.root, -1) AS label FROM {source} s LEFT JOIN named m USING (video_id, ord) LEFT JOIN border b USING (video_id, ord))"""


def refill(size: int | None) -> str:
    """``final``: survivors of ``left_over`` and, where short, the best ranked frames not among them."""
    columns = "video_id, idx, ml_score, altitude, view, cover, lighting, phase, tie"
    base = f"SELECT {columns.replace('phase', '0 AS phase').replace('tie', 'prelim_ord AS tie')} FROM left_over"
    if size is None:
        return f"final AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ml_score DESC, phase, tie) AS final_ord FROM ({base}))"
    return f"""missing AS (SELECT r.*, row_number() OVER (PARTITION BY video_id ORDER BY rank) AS nth FROM ranked r ANTI JOIN left_over USING (video_id, idx)),
got AS (SELECT video_id, count(*) AS have FROM left_over GROUP BY video_id),
again AS ({base} UNION ALL SELECT {columns.replace('phase', '1 AS phase').replace('tie', 'rank AS tie')} FROM missing LEFT JOIN got USING (video_id) WHERE nth <= {size} - coalesce(have, 0)),
final AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY ml_score DESC, phase, tie) AS final_ord FROM again) WHERE final_ord <= {size})"""


NODES = f"nodes AS (SELECT video_id, idx, ml_score, prelim_ord, row_number() OVER (PARTITION BY video_id ORDER BY ml_score DESC, prelim_ord) AS ord, {UNIT} AS unit FROM chosen)"
LEFT_OVER = "left_over AS (SELECT chosen.* FROM chosen SEMI JOIN (SELECT nodes.video_id, nodes.prelim_ord FROM nodes JOIN kept USING (video_id, ord)) k USING (video_id, prelim_ord))"
CLUSTER_NODES = f"nodes AS (SELECT video_id, idx, ml_score, prelim_ord, prelim_ord AS ord, {UNIT} AS unit FROM chosen)"
CLUSTER_KEPT = "kept AS (SELECT video_id, ord FROM (SELECT *, row_number() OVER (PARTITION BY video_id, label ORDER BY ml_score DESC, ord) AS r FROM labels JOIN nodes USING (video_id, ord)) WHERE r = 1)"


def satisfaction(c: Config, normalised: bool) -> str:
    rows = []
    for axis, values in c.axes.items():
        for v in sorted(values):
            raw = (c.targets or {}).get(axis, {}).get(v)
            rows.append(f"('{axis}', '{v}', {float(1.0 if raw is None else raw)!r}::DOUBLE, {float(1.0 / len(values) if raw is None else raw)!r}::DOUBLE)")
    target = "w / (sum(w) OVER (PARTITION BY axis) + 1e-12::DOUBLE)" if normalised else "shown"
    return f"""listed(axis, value, w, shown) AS (VALUES {', '.join(rows)}), want AS (SELECT axis, value, {target} AS target FROM listed),
marks AS (UNPIVOT (SELECT altitude, view, cover, lighting FROM final) ON altitude, view, cover, lighting INTO NAME axis VALUE value),
n AS (SELECT axis, value, count(*) AS n FROM marks GROUP BY ALL), total AS (SELECT count(*) AS total FROM final),
satisfied AS (SELECT axis, value, target, coalesce(n, 0) / greatest(total, 1)::DOUBLE AS actual, coalesce(n, 0) / greatest(total, 1)::DOUBLE >= target - {0.0 if normalised else 0.001} AS satisfied
FROM want LEFT JOIN n USING (axis, value), total)"""


#: Targets against actual counts of each collection; needs ``goals`` and ``final``.
EVALUATED = f"""made AS (SELECT video_id, {KEY} AS combo_key, count(*) AS actual FROM final GROUP BY ALL), sums AS (SELECT video_id, sum(actual)::BIGINT AS total FROM made GROUP BY ALL),
floors AS (SELECT video_id, combo_ord, combo_key, ratio, total, floor(ratio * total) AS low, ratio * total - floor(ratio * total) AS part FROM sums, goals),
rated AS (SELECT *, total - sum(low) OVER (PARTITION BY video_id) AS rest, row_number() OVER (PARTITION BY video_id ORDER BY part DESC, combo_ord) AS nth FROM floors),
evaluated AS (SELECT video_id, combo_ord, combo_key, round(ratio, 6) AS ratio, (low + (nth <= rest)::INT)::BIGINT AS expected, coalesce(actual, 0) AS actual,
  greatest(0, low + (nth <= rest)::INT - coalesce(actual, 0))::BIGINT AS shortfall FROM rated LEFT JOIN made USING (video_id, combo_key)),
result AS (SELECT c.video_id, candidates_count, coalesce(total_expected, 0)::BIGINT AS total_expected, coalesce(total_actual, 0)::BIGINT AS total_actual, coalesce(total_shortfall, 0)::BIGINT AS total_shortfall,
  coalesce(total_actual, 0)::BIGINT AS selected_count, coalesce(total_shortfall, 0) = 0 AS success FROM (SELECT video_id, count(*) AS candidates_count FROM binned GROUP BY ALL) c
  LEFT JOIN (SELECT video_id, sum(expected) AS total_expected, sum(actual) AS total_actual, sum(shortfall) AS total_shortfall FROM evaluated GROUP BY ALL) USING (video_id))"""


# Images --------------------------------------------------------------------------------------------------------------

#: A row for each pixel of the 8 x 8 view: place k, row y, column x, channels and grey.
PIXELS = """px0 AS (SELECT vec_id AS idx, 'v' || label AS video_id, k, greatest(0, least(255, floor(128 + 400 * embedding[k + 1]::DOUBLE)))::INT AS v
  FROM embeddings, (SELECT unnest(range(64)) AS k)),
px AS (SELECT a.video_id, a.idx, a.k, a.k // 8 AS y, a.k % 8 AS x, a.v AS b, g.v AS g, r.v AS r, (9798 * r.v + 19235 * g.v + 3735 * a.v + 16384) // 32768 AS l
  FROM px0 a JOIN px0 g ON g.idx = a.idx AND g.k = (a.k + 21) % 64 JOIN px0 r ON r.idx = a.idx AND r.k = (a.k + 42) % 64)"""


def _mirror(e: str) -> str:
    return f"CASE WHEN {e} < 0 THEN -({e}) WHEN {e} > 7 THEN 14 - ({e}) ELSE {e} END"


#: Sums over each pixel's mirrored 3 x 3 surroundings.
STENCIL = f"""near9 AS (SELECT p.video_id, p.idx, p.k, p.l, dy, dx, q.l AS n FROM px p, (VALUES (-1), (0), (1)) a(dy), (VALUES (-1), (0), (1)) b(dx), px q
  WHERE q.idx = p.idx AND q.k = ({_mirror('p.y + dy')}) * 8 + ({_mirror('p.x + dx')})),
stencil AS (SELECT video_id, idx, k, any_value(l) AS l,
  sum(CASE WHEN dy = 0 AND dx = 0 THEN -4 * n WHEN dy = 0 OR dx = 0 THEN n ELSE 0 END) AS lap,
  (sum((2 - abs(dy)) * (2 - abs(dx)) * n) + 8)::BIGINT // 16 AS blur,
  sum(dx * (2 - abs(dy)) * n) AS gx, sum(dy * (2 - abs(dx)) * n) AS gy FROM near9 GROUP BY video_id, idx, k)"""
