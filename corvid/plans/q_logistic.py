"""Registered logistic-regression queries with SQL oracles.

Input (``inputs.sparse_points``): bag of words of the labelled documents,
y = 2·quality − 1, test rows doc_id % 5 = 0 (train/test split, both used).
A fixed, data-derived probe β_f = ((length(f) % 7) − e)/100 drives the
single-call operators (offset e, see PROBE_OFFSET).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.iterate import Steps
from corvid.operators import logistic as L
from corvid.plans import inputs
from corvid.plans.registry import register
from corvid.plans.sqlfrag import norm, tokens

N_GROUPS = 20
LAM = 0.1
MAX_ITER, EPS = 40, 0.1  # the reference's defaults
DELTA = 1e-4

XL = (f"xl AS (SELECT doc_id AS row_id, word AS feature, CAST(count(*) AS DOUBLE) AS value FROM "
      f"(SELECT doc_id, {norm('t')} AS word FROM (SELECT doc_id, unnest({tokens('text')}) AS t FROM documents "
      f"WHERE doc_id IN (SELECT doc_id FROM labels))) WHERE word <> '' GROUP BY 1, 2)")
PT = "pt AS (SELECT doc_id AS row_id, CAST(quality * 2 - 1 AS INTEGER) AS y, doc_id % 5 = 0 AS is_test FROM labels)"
# probe offset: irrational, so no margin is exactly zero and its sign does not
# depend on the order of summation
PROBE_OFFSET = 2.718281828459045
BP = f"bp AS (SELECT DISTINCT feature, (length(feature) % 7 - {PROBE_OFFSET!r}) / 100.0 AS value FROM xl)"
SOFTPLUS = "(greatest({z}, 0.0) + ln(1 + exp(-abs({z}))))"
MARG = ("mg AS (SELECT pt.row_id, pt.y, pt.is_test, coalesce(m.margin, 0.0) AS margin FROM pt LEFT JOIN "
        "(SELECT xl.row_id, sum(xl.value * bp.value) AS margin FROM xl JOIN bp ON bp.feature = xl.feature GROUP BY xl.row_id) m "
        "ON m.row_id = pt.row_id)")
BASE = f"WITH {XL}, {PT}, {BP}, {MARG}"


def sp(z: str) -> str:
    return SOFTPLUS.format(z=z)


def _data(spark, sf):
    """Points and x_long, written once: every reference to x_long (itself, the
    probe β drawn from it, its blocks) then reads the table instead of
    tokenising the texts again."""
    pts, xl = inputs.sparse_points(spark, sf)
    return pts, Steps(spark, "x-long").write(xl)


def _probe(x_long):
    return L.all_features(x_long).select(
        "feature", ((F.length("feature") % 7 - F.lit(PROBE_OFFSET)) / F.lit(100.0)).alias("value"))


@register("all_features", f"WITH {XL} SELECT DISTINCT feature FROM xl")
def q_all_features(spark, sf):
    return L.all_features(_data(spark, sf)[1])


@register("group_data", f"WITH {PT} SELECT CAST(row_id % {N_GROUPS} AS INTEGER) AS pid, count(*) AS n_rows FROM pt GROUP BY 1")
def q_group_data(spark, sf):
    g = L.group_data(_data(spark, sf)[0], N_GROUPS)
    return g.groupBy("pid").agg(F.count(F.lit(1)).alias("n_rows"))


@register("partition_stats", f"""WITH {XL}, {PT},
r AS (SELECT row_id % {N_GROUPS} AS pid, count(*) AS rows FROM pt GROUP BY 1),
f AS (SELECT row_id % {N_GROUPS} AS pid, count(DISTINCT feature) AS features FROM xl GROUP BY 1),
j AS (SELECT r.pid, r.rows, coalesce(f.features, 0) AS features FROM r LEFT JOIN f ON f.pid = r.pid)
SELECT min(rows) AS rows_min, max(rows) AS rows_max, round(avg(rows), 9) AS rows_avg,
       min(features) AS features_min, max(features) AS features_max, round(avg(features), 9) AS features_avg FROM j""")
def q_partition_stats(spark, sf):
    pts, xl = _data(spark, sf)
    s = L.partition_stats(xl, pts, N_GROUPS)
    return s.select("rows_min", "rows_max", F.round("rows_avg", 9).alias("rows_avg"),
                    "features_min", "features_max", F.round("features_avg", 9).alias("features_avg"))


@register("balanced_groups", f"""WITH RECURSIVE {XL}, {PT},
s AS (SELECT pt.row_id, coalesce(x.entries, 0) AS entries FROM pt LEFT JOIN (SELECT row_id, count(*) AS entries FROM xl GROUP BY 1) x ON x.row_id = pt.row_id),
o AS MATERIALIZED (SELECT entries, row_number() OVER (ORDER BY entries DESC, md5(CAST(row_id AS VARCHAR)), row_id) AS place FROM s),
top AS MATERIALIZED (SELECT * FROM o WHERE place <= {N_GROUPS * L.GREEDY_ROUNDS}),
deal(place, pid, loads) AS (SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), list_transform(range({N_GROUPS}), lambda i: CAST(0 AS BIGINT))
  UNION ALL SELECT top.place, list_position(loads, list_min(loads)), list_transform(loads, lambda v, i: CASE WHEN i = list_position(loads, list_min(loads)) THEN v + entries ELSE v END)
  FROM deal JOIN top ON top.place = deal.place + 1),
turn AS (SELECT row_number() OVER (ORDER BY v, k) - 1 AS r, k FROM (SELECT unnest(loads) AS v, unnest(range({N_GROUPS})) AS k FROM (SELECT loads FROM deal ORDER BY place DESC LIMIT 1))),
later AS (SELECT entries, place - 1 - {N_GROUPS * L.GREEDY_ROUNDS} AS q FROM o WHERE place > {N_GROUPS * L.GREEDY_ROUNDS}),
dealt AS (SELECT pid - 1 AS pid, entries FROM deal JOIN top USING (place) UNION ALL
  SELECT turn.k, entries FROM later JOIN turn ON turn.r = CASE WHEN (q // {N_GROUPS}) % 2 = 1 THEN {N_GROUPS} - 1 - q % {N_GROUPS} ELSE q % {N_GROUPS} END)
SELECT CAST(pid AS INTEGER) AS pid, count(*) AS n_rows, CAST(sum(entries) AS BIGINT) AS n_entries FROM dealt GROUP BY 1""")
def q_balanced_groups(spark, sf):
    """Labelled rows in 20 groups of about equal entries: rows and entries of each."""
    pts, xl = _data(spark, sf)
    return L.balanced_groups(pts, xl, N_GROUPS).groupBy("pid").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("entries").alias("n_entries"))


@register("features_to_partitions", f"WITH {XL} SELECT DISTINCT feature, CAST(row_id % {N_GROUPS} AS INTEGER) AS pid FROM xl")
def q_features_to_partitions(spark, sf):
    return L.features_to_partitions(_data(spark, sf)[1], N_GROUPS)


@register("send_to_partitions", f"WITH {XL}, {BP}, f2p AS (SELECT DISTINCT feature, CAST(row_id % {N_GROUPS} AS INTEGER) AS pid FROM xl) "
          "SELECT f2p.pid, f2p.feature, bp.value FROM f2p JOIN bp ON bp.feature = f2p.feature")
def q_send_to_partitions(spark, sf):
    xl = _data(spark, sf)[1]
    s = L.send_to_partitions(_probe(xl), L.features_to_partitions(xl, N_GROUPS))
    return s.select("pid", "feature", "value")


@register("logistic_loss", f"{BASE} SELECT row_id, round(margin, 9) AS margin, round({sp('-y * margin')}, 9) AS loss FROM mg")
def q_logistic_loss(spark, sf):
    from corvid.functions.vectors import logistic_loss
    pts, xl = _data(spark, sf)
    m = L.margins(pts, xl, _probe(xl))
    return m.select("row_id", F.round("margin", 9).alias("margin"),
                    F.round(logistic_loss(F.col("margin"), F.col("y")), 9).alias("loss"))


@register("logistic_row_gradient", f"{BASE} SELECT row_id, round(-y / (1.0 + exp(y * margin)), 9) AS coef FROM mg")
def q_logistic_row_gradient(spark, sf):
    from corvid.functions.vectors import logistic_coef
    pts, xl = _data(spark, sf)
    m = L.margins(pts, xl, _probe(xl))
    return m.select("row_id", F.round(logistic_coef(F.col("margin"), F.col("y")), 9).alias("coef"))


@register("total_loss", f"{BASE}, r AS (SELECT sum(value * value) AS bb FROM bp) "
          f"SELECT round(sum({sp('-y * margin')}) + {LAM!r} * any_value(r.bb), 6) AS loss FROM mg, r WHERE NOT is_test")
def q_total_loss(spark, sf):
    pts, xl = _data(spark, sf)
    v = L.total_loss(pts.where(~F.col("is_test")), xl, _probe(xl), LAM)
    return spark.createDataFrame([(round(v, 6),)], "loss double")


GRAD = ("gr AS (SELECT bp.feature, coalesce(g.g, 0.0) + 2 * {lam} * bp.value AS value FROM bp LEFT JOIN "
        "(SELECT xl.feature, sum((-mg.y / (1.0 + exp(mg.y * mg.margin))) * xl.value) AS g FROM xl JOIN mg "
        "ON mg.row_id = xl.row_id WHERE NOT mg.is_test GROUP BY xl.feature) g ON g.feature = bp.feature)").format(lam=repr(LAM))


@register("total_gradient", f"{BASE}, {GRAD} SELECT feature, round(value, 9) AS value FROM gr")
def q_total_gradient(spark, sf):
    pts, xl = _data(spark, sf)
    g = L.total_gradient(pts.where(~F.col("is_test")), xl, _probe(xl), LAM)
    return g.select("feature", F.round("value", 9).alias("value"))


LS = (f"""{BASE}, {GRAD},
sl AS (SELECT mg.row_id, mg.y, mg.margin, coalesce(s.s, 0.0) AS s FROM mg LEFT JOIN
       (SELECT xl.row_id, sum(xl.value * gr.value) AS s FROM xl JOIN gr ON gr.feature = xl.feature GROUP BY xl.row_id) s
       ON s.row_id = mg.row_id WHERE NOT mg.is_test),
vt AS (SELECT sum(bp.value * bp.value) AS bb, sum(bp.value * gr.value) AS bg, sum(gr.value * gr.value) AS gg
       FROM bp JOIN gr ON gr.feature = bp.feature),
cand AS (SELECT k, t FROM (WITH RECURSIVE c(k, t) AS (SELECT 0, CAST(1.0 AS DOUBLE) UNION ALL
         SELECT k + 1, t * 0.6 FROM c WHERE k < 63) SELECT * FROM c)),
f0 AS (SELECT sum({sp('-y * margin')}) + {LAM!r} * any_value(vt.bb) AS f0 FROM sl, vt),
ft AS (SELECT cand.k, cand.t, sum({sp('-y * (margin - cand.t * s)')})
         + {LAM!r} * (any_value(vt.bb) - 2 * cand.t * any_value(vt.bg) + cand.t * cand.t * any_value(vt.gg)) AS ft
       FROM sl, cand, vt GROUP BY cand.k, cand.t)
SELECT ft.t AS step, round(ft.ft, 6) AS objective, CAST(ft.k AS INTEGER) AS rejected FROM ft, f0, vt
WHERE ft.ft <= f0.f0 - 0.2 * ft.t * vt.gg ORDER BY ft.k LIMIT 1""")


@register("backtracking_line_search", LS)
def q_line_search(spark, sf):
    """First accepted step along −∇ from the probe β (λ = 0.1), all 64
    candidates in one aggregate."""
    pts, xl = _data(spark, sf)
    tr = pts.where(~F.col("is_test"))
    beta = _probe(xl)
    m = L.margins(tr, xl, beta)
    g = L.gradient_from_rows(m, xl, beta, LAM)
    bb, bg, gg = L._vec_terms(beta, g)
    rows_s = L.slopes(m, xl, g)
    t, ft, f0, k = L.line_search(rows_s, bb, bg, gg, LAM)
    return spark.createDataFrame([(t, round(ft, 6), k)], "step double, objective double, rejected int")


@register("beta_init", f"WITH {XL}, {PT} SELECT DISTINCT xl.feature, 0.0 AS value FROM xl JOIN pt ON pt.row_id = xl.row_id WHERE NOT pt.is_test")
def q_beta_init(spark, sf):
    pts, xl = _data(spark, sf)
    return L.beta_init(xl.join(pts.where(~F.col("is_test")).select("row_id"), "row_id", "left_semi"))


@register("beta_update", f"{BASE}, {GRAD} SELECT bp.feature, round(bp.value - 0.01 * gr.value, 9) AS value FROM bp JOIN gr ON gr.feature = bp.feature")
def q_beta_update(spark, sf):
    """β ← β − γ∇ with γ = 0.01 at the probe β."""
    pts, xl = _data(spark, sf)
    beta = _probe(xl)
    g = L.total_gradient(pts.where(~F.col("is_test")), xl, beta, LAM).withColumnRenamed("value", "_g")
    return beta.join(g, "feature").select("feature", F.round(F.col("value") - F.lit(0.01) * F.col("_g"), 9).alias("value"))


CONF = ("SELECT count_if(margin > 0) AS P, count_if(margin < 0) AS N, count_if(margin > 0 AND y = 1) AS TP, "
        "count_if(margin > 0 AND y = -1) AS FP, count_if(margin < 0 AND y = -1) AS TN, count_if(margin < 0 AND y = 1) AS FN FROM mg")


@register("confusion_counts", f"{BASE} {CONF}")
def q_confusion_counts(spark, sf):
    pts, xl = _data(spark, sf)
    return L.confusion_counts(L.margins(pts, xl, _probe(xl)))


@register("evaluate_logistic", f"{BASE}, c AS ({CONF}) SELECT *, "
          "round(CASE WHEN P + N = 0 THEN NULL ELSE (TP + TN) / (P + N) END, 9) AS acc, "
          "round(CASE WHEN TP + FP = 0 THEN NULL ELSE TP / (TP + FP) END, 9) AS pre, "
          "round(CASE WHEN TP + FN = 0 THEN NULL ELSE TP / (TP + FN) END, 9) AS rec FROM c")
def q_evaluate_logistic(spark, sf):
    """Confusion counts and ACC/PRE/REC of the probe β on all labelled rows."""
    pts, xl = _data(spark, sf)
    e = L.evaluate(pts, xl, _probe(xl))
    return e.select("P", "N", "TP", "FP", "TN", "FN", *[F.round(c, 9).alias(c) for c in ("acc", "pre", "rec")])


@register("sparse_fd_gradient", f"""{BASE},
d AS (SELECT xl.feature, sum({sp('-mg.y * (mg.margin + {d} * xl.value)').replace('{d}', repr(DELTA))} - {sp('-mg.y * mg.margin')}) AS dl,
             sum((-mg.y / (1.0 + exp(mg.y * mg.margin))) * xl.value) AS g
      FROM xl JOIN mg ON mg.row_id = xl.row_id WHERE NOT mg.is_test GROUP BY xl.feature)
SELECT bp.feature,
  round((coalesce(d.dl, 0.0) + {LAM!r} * ((bp.value + {DELTA!r}) * (bp.value + {DELTA!r}) - bp.value * bp.value)) / {DELTA!r}, 4) AS fd,
  round(coalesce(d.g, 0.0) + 2 * {LAM!r} * bp.value, 4) AS analytic
FROM bp LEFT JOIN d ON d.feature = bp.feature""")
def q_sparse_fd_gradient(spark, sf):
    pts, xl = _data(spark, sf)
    r = L.sparse_fd_gradient(pts.where(~F.col("is_test")), xl, _probe(xl), LAM, DELTA)
    return r.select("feature", F.round("fd", 4).alias("fd"), F.round("analytic", 4).alias("analytic"))


def _train_sql(iters: int = 2, final: str | None = None, lam: float = LAM, eps: float = 0.0) -> str:
    """SQL unrolling of ``iters`` training iterations from β = 0 (train
    features), λ = lam: gradient, slopes, 64 candidates, first accepted step,
    β and margin updates — the same arithmetic as the Spark trainer. Once a norm
    is at most ``eps`` the model is no longer live (``lv``) and takes no step."""
    cte = [XL, PT, "lv0 AS (SELECT true AS live)",
           "b0 AS (SELECT DISTINCT xl.feature, 0.0 AS value FROM xl JOIN pt ON pt.row_id = xl.row_id WHERE NOT pt.is_test)",
           "mg0 AS (SELECT row_id, y, is_test, 0.0 AS margin FROM pt)",
           "cand AS (SELECT k, t FROM (WITH RECURSIVE c(k, t) AS (SELECT 0, CAST(1.0 AS DOUBLE) UNION ALL "
           "SELECT k + 1, t * 0.6 FROM c WHERE k < 63) SELECT * FROM c))"]
    for k in range(iters):
        n = k + 1
        cte += [
            f"c{k} AS (SELECT row_id, -y / (1.0 + exp(y * margin)) AS c FROM mg{k} WHERE NOT is_test)",
            f"g{k} AS (SELECT b.feature, b.value AS b, coalesce(s.g, 0.0) + 2 * {lam!r} * b.value AS g FROM b{k} b LEFT JOIN "
            f"(SELECT xl.feature, sum(c.c * xl.value) AS g FROM xl JOIN c{k} c ON c.row_id = xl.row_id GROUP BY xl.feature) s "
            f"ON s.feature = b.feature)",
            f"vt{k} AS (SELECT sum(b * b) AS bb, sum(b * g) AS bg, sum(g * g) AS gg FROM g{k})",
            f"sl{k} AS (SELECT m.row_id, m.y, m.is_test, m.margin, coalesce(s.s, 0.0) AS s FROM mg{k} m LEFT JOIN "
            f"(SELECT xl.row_id, sum(xl.value * g.g) AS s FROM xl JOIN g{k} g ON g.feature = xl.feature GROUP BY xl.row_id) s "
            f"ON s.row_id = m.row_id)",
            f"f{k} AS (SELECT sum({sp('-y * margin')}) + {lam!r} * any_value(vt.bb) AS f0 FROM sl{k}, vt{k} vt WHERE NOT is_test)",
            f"ft{k} AS (SELECT cand.k, cand.t, sum({sp('-y * (margin - cand.t * s)')}) + {lam!r} * (any_value(vt.bb) - "
            f"2 * cand.t * any_value(vt.bg) + cand.t * cand.t * any_value(vt.gg)) AS ft FROM sl{k}, cand, vt{k} vt "
            f"WHERE NOT is_test GROUP BY cand.k, cand.t)",
            f"t{k} AS (SELECT CASE WHEN lv.live THEN a.t ELSE 0.0 END AS t, a.ft, a.rejected FROM lv{k} lv LEFT JOIN (SELECT ft.t, ft.ft, ft.k AS rejected "
            f"FROM ft{k} ft, f{k}, vt{k} vt WHERE ft.ft <= f{k}.f0 - 0.2 * ft.t * vt.gg ORDER BY ft.k LIMIT 1) a ON true)",
            f"lv{n} AS (SELECT lv.live AND sqrt(vt.gg) > {eps!r} AS live FROM lv{k} lv, vt{k} vt)",
            f"b{n} AS (SELECT feature, b - t{k}.t * g AS value FROM g{k}, t{k})",
            f"mg{n} AS (SELECT row_id, y, is_test, margin - t{k}.t * s AS margin FROM sl{k}, t{k})",
        ]
    if final is None:
        final = f"SELECT feature, round(value, 12) AS value FROM b{iters}"
    return "WITH " + ",\n".join(x.replace(" AS (", " AS MATERIALIZED (", 1) for x in cte) + "\n" + final.format(n=iters, last=iters - 1)


def _last_live(iters: int, what: str) -> str:
    """``what`` of vt at the last live iteration, and how many there were."""
    every = " UNION ALL ".join(f"SELECT {k} AS k, gg FROM lv{k}, vt{k} WHERE live" for k in range(iters))
    return f"(SELECT {what} FROM ({every}))"


_NORM = "round(sqrt(arg_max(gg, k)), {digits}) AS grad_norm"


def _trained(spark, sf, max_iter: int):
    pts, xl = _data(spark, sf)
    fit = L.train(pts, xl, lam=LAM, max_iter=max_iter, eps=EPS)
    return fit.beta.select("feature", F.round("value", 9).alias("value"),
                           F.round(F.lit(fit.grad_norm), 6).alias("grad_norm"), F.lit(fit.iterations).alias("iterations"))


def _trained_sql(iters: int) -> str:
    return _train_sql(iters, "SELECT b.feature, round(b.value, 9) AS value, l.grad_norm, l.iterations FROM b{n} b, "
                             + _last_live(iters, _NORM.format(digits=6) + ", CAST(count(*) AS INTEGER) AS iterations") + " l", eps=EPS)


@register("train_logistic", _trained_sql(MAX_ITER))
def q_train_logistic(spark, sf):
    """Training (λ = 0.1, max_iter 40, eps 0.1): β table with the final norm."""
    return _trained(spark, sf, MAX_ITER)


@register("train_logistic_5iter", _trained_sql(5))
def q_train_logistic_5iter(spark, sf):
    """Its first five iterations, value-checked (the norms stay far above eps
    here, so all 5 run)."""
    return _trained(spark, sf, 5)


def _metrics_sql(table: str, key: str | None = None) -> str:
    """ACC, PRE, REC of the test rows of a margin table (per ``key``)."""
    n = lambda c: f"count_if(margin {c})"
    ratio = lambda p, q: f"round(CASE WHEN {q} = 0 THEN NULL ELSE ({p}) / ({q}) END, 9)"
    tp, fp, tn, fn = n("> 0 AND y = 1"), n("> 0 AND y = -1"), n("< 0 AND y = -1"), n("< 0 AND y = 1")
    return (f"SELECT {f'{key}, ' if key else ''}{ratio(f'{tp} + {tn}', f'{tp} + {fp} + {tn} + {fn}')} AS acc, {ratio(tp, f'{tp} + {fp}')} AS pre, "
            f"{ratio(tp, f'{tp} + {fn}')} AS rec FROM {table} WHERE is_test{f' GROUP BY {key}' if key else ''}")


def _history_sql(iters: int, test: bool, lam: float = LAM, eps: float = 0.0) -> str:
    """One row per live iteration."""
    rows = []
    for k in range(iters):
        more = f", m.acc, m.pre, m.rec FROM t{k} t, vt{k} vt, ({_metrics_sql(f'mg{k + 1}')}) m, lv{k} WHERE live" if test else f" FROM t{k} t, vt{k} vt, lv{k} WHERE live"
        rows.append(f"SELECT CAST({k} AS INTEGER) AS k, round(t.ft, 5) AS objective, round(sqrt(vt.gg), 5) AS grad_norm, t.t AS step, "
                    f"CAST(t.rejected AS INTEGER) AS rejected{more}")
    return _train_sql(iters, " UNION ALL ".join(rows), lam, eps)


def _history(spark, fit, test: bool):
    h = L.history_frame(spark, fit)
    keep = ["k", F.round("objective", 5).alias("objective"), F.round("grad_norm", 5).alias("grad_norm"), "step", "rejected"]
    return h.select(*keep, *([F.round(c, 9).alias(c) for c in ("acc", "pre", "rec")] if test else []))


@register("online_test", _history_sql(MAX_ITER, True, eps=EPS))
def q_online_test(spark, sf):
    """History with test ACC/PRE/REC at every iteration (λ = 0.1, max_iter 40,
    eps 0.1); wall times are left out."""
    pts, xl = _data(spark, sf)
    return _history(spark, L.train(pts, xl, lam=LAM, max_iter=MAX_ITER, eps=EPS, online_test=True), True)


@register("online_test_4iter", _history_sql(4, True))
def q_online_test_4iter(spark, sf):
    """Its first four iterations, value-checked."""
    pts, xl = _data(spark, sf)
    return _history(spark, L.train(pts, xl, lam=LAM, max_iter=4, eps=0.0, online_test=True), True)


# Fixed values of the sweep: powers of ten.
SWEEP = [10.0 ** k for k in range(-5, 6)]
SWEEP_ITERS = 2  # of the value-checked part


def _sweep_sql(iters: int, eps: float) -> str:
    """The same unrolling for all λ at once: lam is a key of every table."""
    cte = [XL, PT, "mo AS (SELECT lam, true AS live FROM (VALUES " + ", ".join(f"(CAST({v!r} AS DOUBLE))" for v in SWEEP) + ") t(lam))",
           "lv0 AS (SELECT * FROM mo)",
           "b0 AS (SELECT mo.lam, f.feature, 0.0 AS value FROM (SELECT DISTINCT xl.feature FROM xl JOIN pt ON pt.row_id = xl.row_id WHERE NOT pt.is_test) f, mo)",
           "mg0 AS (SELECT mo.lam, row_id, y, is_test, 0.0 AS margin FROM pt, mo)",
           "cand AS (SELECT k, t FROM (WITH RECURSIVE c(k, t) AS (SELECT 0, CAST(1.0 AS DOUBLE) UNION ALL "
           "SELECT k + 1, t * 0.6 FROM c WHERE k < 63) SELECT * FROM c))"]
    for k in range(iters):
        n = k + 1
        cte += [
            f"g{k} AS (SELECT b.lam, b.feature, b.value AS b, coalesce(s.g, 0.0) + 2 * b.lam * b.value AS g FROM b{k} b LEFT JOIN "
            f"(SELECT m.lam, xl.feature, sum(-m.y / (1.0 + exp(m.y * m.margin)) * xl.value) AS g FROM xl JOIN mg{k} m ON m.row_id = xl.row_id "
            f"WHERE NOT m.is_test GROUP BY 1, 2) s ON s.lam = b.lam AND s.feature = b.feature)",
            f"vt{k} AS (SELECT lam, sum(b * b) AS bb, sum(b * g) AS bg, sum(g * g) AS gg FROM g{k} GROUP BY lam)",
            f"sl{k} AS (SELECT m.*, coalesce(s.s, 0.0) AS s FROM mg{k} m LEFT JOIN (SELECT g.lam, xl.row_id, sum(xl.value * g.g) AS s "
            f"FROM xl JOIN g{k} g ON g.feature = xl.feature GROUP BY 1, 2) s ON s.lam = m.lam AND s.row_id = m.row_id)",
            f"f{k} AS (SELECT sl.lam, sum({sp('-y * margin')}) + sl.lam * any_value(vt.bb) AS f0 FROM sl{k} sl JOIN vt{k} vt USING (lam) WHERE NOT is_test GROUP BY sl.lam)",
            f"ft{k} AS (SELECT sl.lam, cand.k, cand.t, sum({sp('-y * (margin - cand.t * s)')}) AS loss FROM sl{k} sl, cand WHERE NOT is_test GROUP BY ALL)",
            f"t{k} AS (SELECT lv.lam, CASE WHEN lv.live THEN a.t ELSE 0.0 END AS t FROM lv{k} lv LEFT JOIN (SELECT ft.lam, arg_min(ft.t, ft.k) AS t "
            f"FROM ft{k} ft JOIN f{k} f USING (lam) JOIN vt{k} vt USING (lam) WHERE ft.loss + ft.lam * (vt.bb - 2 * ft.t * vt.bg + ft.t * ft.t * vt.gg) "
            f"<= f.f0 - 0.2 * ft.t * vt.gg GROUP BY ft.lam) a USING (lam))",
            f"lv{n} AS (SELECT lv.lam, lv.live AND sqrt(vt.gg) > {eps!r} AS live FROM lv{k} lv JOIN vt{k} vt USING (lam))",
            f"b{n} AS (SELECT g.lam, feature, b - t.t * g AS value FROM g{k} g JOIN t{k} t USING (lam))",
            f"mg{n} AS (SELECT sl.lam, row_id, y, is_test, margin - t.t * s AS margin FROM sl{k} sl JOIN t{k} t USING (lam))",
        ]
    norms = " UNION ALL ".join(f"SELECT {k} AS k, lam, gg FROM lv{k} JOIN vt{k} USING (lam) WHERE live" for k in range(iters))
    return ("WITH " + ",\n".join(x.replace(" AS (", " AS MATERIALIZED (", 1) for x in cte)
            + f"\nSELECT m.*, l.grad_norm FROM ({_metrics_sql(f'mg{iters}', 'lam')}) m JOIN (SELECT lam, {_NORM.format(digits=5)} FROM ({norms}) GROUP BY lam) l USING (lam)")


def _sweep(spark, sf, max_iter: int, eps: float):
    pts, xl = _data(spark, sf)
    fits = L.train_sweep(pts, xl, SWEEP, max_iter=max_iter, eps=eps, online_test=True, betas=False)
    rows = [(lam, *(f.history[-1][c] for c in ("acc", "pre", "rec")), f.grad_norm) for lam, f in zip(SWEEP, fits)]
    out = spark.createDataFrame(rows, "lam double, acc double, pre double, rec double, grad_norm double")
    return out.select("lam", *[F.round(c, 9).alias(c) for c in ("acc", "pre", "rec")], F.round("grad_norm", 5).alias("grad_norm"))


@register("logistic_lambda_sweep", _sweep_sql(MAX_ITER, EPS))
def q_logistic_lambda_sweep(spark, sf):
    """Train + test for the eleven λ ∈ 10^-5 … 10^5 (max_iter 40, eps 0.1), all in
    the same scans: (λ, acc, pre, rec, grad_norm)."""
    return _sweep(spark, sf, MAX_ITER, EPS)


@register("logistic_lambda_sweep_2iter", _sweep_sql(SWEEP_ITERS, 0.0))
def q_logistic_lambda_sweep_2iter(spark, sf):
    """Its first two iterations for each λ, value-checked."""
    return _sweep(spark, sf, SWEEP_ITERS, 0.0)


def _compared(spark, sf, max_iter: int, eps: float):
    pts, xl = _data(spark, sf)
    a = L.train(pts, xl, lam=LAM, max_iter=max_iter, eps=eps, n_partitions=4, broadcast=True).beta
    b = L.train(pts, xl, lam=LAM, max_iter=max_iter, eps=eps, n_partitions=20, broadcast=False).beta
    return L.model_compare(a, b).select("n_features", F.round("max_abs_diff", 9).alias("max_abs_diff"),
                                        F.round("norm_a", 6).alias("norm_a"), F.round("norm_b", 6).alias("norm_b"))


def _compared_sql(iters: int, eps: float) -> str:
    return _train_sql(iters, "SELECT count(*) AS n_features, CAST(0.0 AS DOUBLE) AS max_abs_diff, "
                             "round(sqrt(sum(value * value)), 6) AS norm_a, round(sqrt(sum(value * value)), 6) AS norm_b FROM b{n}", eps=eps)


@register("model_compare", _compared_sql(MAX_ITER, EPS))
def q_model_compare(spark, sf):
    """The broadcast and the blocked implementation of the trainer side by side
    (max_iter 40, eps 0.1): the two β tables must agree; reports max |Δ| and
    both norms."""
    return _compared(spark, sf, MAX_ITER, EPS)


@register("model_compare_2iter", _compared_sql(2, 0.0))
def q_model_compare_2iter(spark, sf):
    """The same after two iterations, value-checked."""
    return _compared(spark, sf, 2, 0.0)


@register("train_logistic_2iter", _train_sql(2))
def q_train_logistic_2iter(spark, sf):
    """Two iterations of the distributed trainer (λ = 0.1) from β = 0, value-
    checked against the SQL unrolling of the same two iterations."""
    pts, xl = _data(spark, sf)
    fit = L.train(pts, xl, lam=LAM, max_iter=2, eps=0.0)
    return fit.beta.select("feature", F.round("value", 12).alias("value"))


@register("train_logistic_smj", _train_sql(2))
def q_train_logistic_smj(spark, sf):
    """The same with no broadcast: only needed entries move to their blocks."""
    pts, xl = _data(spark, sf)
    fit = L.train(pts, xl, lam=LAM, max_iter=2, eps=0.0, broadcast=False)
    return fit.beta.select("feature", F.round("value", 12).alias("value"))


@register("train_logistic_full", _history_sql(MAX_ITER, False, 0.0, EPS))
def q_train_logistic_full(spark, sf):
    """Training at the default 40 iterations (λ = 0, eps = 0.1): history rows
    (objective, norm, step); its first rows are those that SQL checks elsewhere."""
    pts, xl = _data(spark, sf)
    return _history(spark, L.train(pts, xl), False)
