"""Clustering and the correction chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from soundlake.checks.base import check, r, sample
from soundlake.checks.stats import CURVE, WF, ZS, falls
from soundlake.functions import acoustic as A
from soundlake.operators import radiometry as R
from soundlake.operators.lineage import cut

ROUNDS, K = 60, 5  # the SQL runs on after the clusters stay


def splits_sql(top: int) -> str:
    """``ce(k, i, c)``: best centres for every number of clusters, by dynamic programming over all splits; of all values where these are few, else first
    at two decimals, then at three close to the splits found so, then of every value close to those."""

    def layer(t: str, groups: str) -> str:
        return f"""xs{t} AS (SELECT count(*)::DOUBLE AS n, sum(z) AS s, min(z) AS z0 FROM ({groups}) GROUP BY g),
    cu{t} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY z0) AS j, z0, sum(n) OVER (ORDER BY z0) AS n, sum(s) OVER (ORDER BY z0) AS s FROM xs{t}),
    dp{t}(k, j, gain, cuts) AS (SELECT 1, j, s * s / n, []::BIGINT[] FROM cu{t} UNION ALL
      SELECT any_value(d.k) + 1, c.j, max(d.gain + (c.s - p.s) ** 2 / (c.n - p.n)), arg_max(list_append(d.cuts, d.j), d.gain + (c.s - p.s) ** 2 / (c.n - p.n))
      FROM dp{t} d JOIN cu{t} p ON p.j = d.j JOIN cu{t} c ON c.j > d.j WHERE d.k < {top} GROUP BY c.j),
    bs{t} AS MATERIALIZED (SELECT k, list_append(list_prepend(0, cuts), j) AS ends FROM dp{t} WHERE j = (SELECT max(j) FROM cu{t}))"""

    def near(t: str, reach: float) -> str:
        """Values close to a split of step ``t``."""
        return f"""bo{t} AS MATERIALIZED (SELECT DISTINCT z0 AS b FROM (SELECT unnest(ends[2:len(ends) - 1]) + 1 AS j FROM bs{t}) JOIN cu{t} USING (j)),
    nr{t} AS MATERIALIZED (SELECT DISTINCT z FROM zz JOIN bo{t} ON z BETWEEN b - {reach} AND b + {reach})"""

    def centres(t: str) -> str:
        return f"""SELECT k, i, (b.s - coalesce(a.s, 0)) / (b.n - coalesce(a.n, 0)) AS c FROM (SELECT k, unnest(range(1, len(ends))) AS i, ends FROM bs{t}) LEFT JOIN cu{t} a ON a.j = ends[i] JOIN cu{t} b ON b.j = ends[i + 1]"""

    few = "(SELECT few FROM fw)"
    return f"""fw AS MATERIALIZED (SELECT count(DISTINCT z) <= 6000 AS few FROM zz),
    {layer('1', f'SELECT z, CASE WHEN {few} THEN z ELSE ROUND(z, 2) END AS g FROM zz')}, {near('1', 0.02)},
    {layer('2', f'SELECT z, CASE WHEN {few} THEN 0 WHEN nr1.z IS NULL THEN ROUND(zz.z, 2) ELSE 1000 + ROUND(zz.z, 3) END AS g FROM zz LEFT JOIN nr1 USING (z)')}, {near('2', 0.004)},
    {layer('3', f'SELECT z, CASE WHEN {few} THEN 0 WHEN nr2.z IS NOT NULL THEN 2000 + zz.z WHEN nr1.z IS NOT NULL THEN 1000 + ROUND(zz.z, 3) ELSE ROUND(zz.z, 2) END AS g FROM zz LEFT JOIN nr1 USING (z) LEFT JOIN nr2 USING (z)')},
    ce AS MATERIALIZED (SELECT * FROM ({centres('1')}) WHERE {few} UNION ALL SELECT * FROM ({centres('3')}) WHERE NOT {few})"""


def lloyd_sql(k: int, t: str) -> str:
    """From those clusters exact means over ``zz`` in rounds, as a recursion whose state is the row of centres; ``t`` is the last one."""
    seeds = ", ".join(f"any_value(c) FILTER (WHERE i = {i + 1})" for i in range(k))
    means = ", ".join(f"coalesce(avg(z) FILTER (WHERE {label_sql(k, 'k')} = {i}), any_value(k.c{i}))" for i in range(k))
    state = ", ".join(f"c{i}" for i in range(k))
    return f"""{t}_(i, {state}) AS (SELECT 0, {seeds} FROM ce WHERE k = {k} UNION ALL SELECT any_value(k.i) + 1, {means} FROM zz, {t}_ k WHERE k.i < {ROUNDS} HAVING count(*) > 0),
    {t} AS (SELECT * FROM {t}_ WHERE i = {ROUNDS})"""


def label_sql(k: int, t: str) -> str:
    return "(" + " + ".join(["0", *(f"(z > ({t}.c{i} + {t}.c{i + 1}) / 2)::INT" for i in range(k - 1))]) + ")"


def cluster_sql(top: int) -> str:
    """``cen(cs)``: centres after refitting with fewer clusters. All fits are made; a recursion walks from one to the next."""
    fits = splits_sql(top) + ",\n" + ",\n".join(lloyd_sql(k, f"f{k}") for k in range(1, top + 1))
    each = " UNION ALL ".join(
        f"SELECT {k} AS k, [{', '.join(f'any_value(f{k}.c{i})' for i in range(k))}] AS cs, [{', '.join(f'count(*) FILTER (WHERE {label_sql(k, f'f{k}')} = {i})' for i in range(k))}] AS ns FROM zz, f{k}"
        for k in range(1, top + 1)
    )
    return f"""{fits}, al AS ({each}), sp AS (SELECT quantile_cont(z, 0.95) - quantile_cont(z, 0.05) AS spread, count(*) AS total FROM zz),
    bg AS (SELECT k, cs, list_transform(list_filter(range(1, k + 1), lambda j: ns[j] / total >= 0.01), lambda j: cs[j]) AS big, spread FROM al, sp),
    mc AS (SELECT k, cs, CASE WHEN len(big) = 0 THEN 0 ELSE 1 + len(list_filter(range(1, len(big)), lambda j: big[j + 1] - big[j] >= 0.02 * spread)) END AS remain FROM bg),
    walk(k, step) AS (SELECT {top}, 0 UNION ALL SELECT CAST(remain AS INTEGER), step + 1 FROM walk JOIN mc ON mc.k = walk.k WHERE remain NOT IN (0, walk.k) AND step < 9),
    cen AS (SELECT cs FROM mc WHERE k = (SELECT arg_max(k, step) FROM walk))"""


NEAREST = "len(list_filter(range(1, len(cs)), lambda j: z > (cs[j] + cs[j + 1]) / 2))"


ZZ = f"{ZS}, zz AS (SELECT ping, bin, ROUND(z, 6) AS z FROM z WHERE z IS NOT NULL)"


def scores(spark, d):
    z = R.robust_z(falls(spark, d)).select("ping", "bin", F.round("z", 6).alias("z")).where("z is not null")
    return cut(z)  # read once per round


@check("m1_kmeans", "sample", f"WITH RECURSIVE {ZZ}, {splits_sql(K)}, {lloyd_sql(K, 'fit')} SELECT label, count(*) AS n, ROUND(avg(z), 6) AS centre FROM (SELECT z, {label_sql(K, 'fit')} AS label FROM zz, fit) GROUP BY label")
def _(spark, d):
    z = scores(spark, d)
    centres, _ = R.optimal_clusters(z, "z", K)
    return R.label(z, "z", centres).groupBy("label").agg(F.count("*").alias("n"), r(F.avg("z")).alias("centre"))


@check("m1_kmeans_merged", "sample", f"WITH RECURSIVE {ZZ}, {cluster_sql(7)} SELECT CAST(label AS INTEGER) AS label, count(*) AS n, ROUND(avg(z), 4) AS centre FROM (SELECT z, {NEAREST} AS label FROM zz, cen) GROUP BY label")
def _(spark, d):
    z = scores(spark, d)
    centres = R.cluster(z, "z", 7)
    return R.label(z, "z", centres).groupBy("label").agg(F.count("*").alias("n"), r(F.avg("z"), 4).alias("centre"))


CHAIN = f"""kq AS (SELECT median(altitude) AS h0, quantile_cont(bs, 0.995) FILTER (WHERE bs > 0) AS top FROM sample),
    s AS (SELECT * EXCLUDE (lin), CASE WHEN lin > 1e-12 THEN 10 * log10(lin) END AS db FROM (SELECT sample.*, least(bs, top) * least(greatest(h0 / altitude, 0.5), 2.0) AS lin FROM sample, kq)),
    w AS (SELECT ping, CAST(floor(angle - 20) AS INTEGER) AS bin, median(db) AS bs FROM s WHERE angle >= 20 AND angle < 70 GROUP BY ALL){ZS.removeprefix(WF)}, zz AS (SELECT z FROM z WHERE z IS NOT NULL),
    {cluster_sql(4)},
    lb AS (SELECT ping, bin, bs, CASE WHEN z IS NOT NULL THEN CAST({NEAREST} AS INTEGER) END AS l FROM z, cen),
    rk AS (SELECT ping, row_number() OVER (ORDER BY ping) - 1 AS r FROM (SELECT DISTINCT ping FROM w)),
    im AS (SELECT rk.ping, r, b AS c, coalesce(l, -1) AS l FROM (SELECT *, unnest(range(50)) AS b FROM rk) rk LEFT JOIN lb ON lb.ping = rk.ping AND lb.bin = rk.b),
    nb AS (SELECT *, r + dr AS nr, c + dc AS nc FROM im, (SELECT unnest([-1, 0, 1]) AS dr), (SELECT unnest([-1, 0, 1]) AS dc) WHERE l >= 0),
    vo AS (SELECT nb.ping, nb.c, list(im.l) AS ls FROM nb JOIN im ON im.r = nb.nr AND im.c = nb.nc GROUP BY ALL),
    sm AS (SELECT ping, CAST(c AS INTEGER) AS bin, CAST(list_sort(list_concat(ls, list_resize([]::INT[], CAST(9 - len(ls) AS BIGINT), 0)))[5] AS INTEGER) AS label FROM vo),
    wl AS (SELECT lb.ping, lb.bin, lb.bs, sm.label FROM lb LEFT JOIN sm ON sm.ping = lb.ping AND sm.bin = lb.bin), p AS{CURVE.split(" p AS", 1)[1]},
    sl AS (SELECT s.*, coalesce(sm.label, -1) AS label FROM s LEFT JOIN sm ON sm.ping = s.ping AND sm.bin = floor(s.angle - 20)),
    e AS (SELECT label, bin + 20.5 AS a, curve AS v, level, lead(bin + 20.5) OVER w AS na, lead(curve) OVER w AS nv, lag(bin) OVER w IS NULL AS first FROM cv WINDOW w AS (PARTITION BY label ORDER BY bin)),
    j AS (SELECT sl.*, e.a, e.v, e.na, e.nv, e.level FROM sl LEFT JOIN e ON sl.label = e.label AND (sl.angle >= e.a AND (e.na IS NULL OR sl.angle < e.na) OR (e.first AND sl.angle < e.a)))"""


@check("m2_correction_chain", "sample", f"""WITH RECURSIVE {CHAIN} SELECT ping, num, part, line, bs,
    ROUND(CASE WHEN angle BETWEEN 15 AND 65 THEN coalesce(db - CASE WHEN angle < a OR na IS NULL THEN v ELSE v + (nv - v) * (angle - a) / (na - a) END + level, db) END, 4) AS bs_db, label FROM j""")
def _(spark, d):
    far = A.far_cutoff(F.lit("HF"))
    c = R.correct(sample(spark, d), "ping", "bs", "altitude", "angle", far, k=4)
    return c.select("ping", "num", "part", "line", "bs", r("bs_db", 4).alias("bs_db"), "label")


LAB = """im AS (SELECT ping, bin, CASE WHEN bs > 47 THEN 2 WHEN bs > 45 THEN 1 WHEN bs > 43 THEN 0 END AS label FROM w)"""


def image(spark, d):
    bs = F.col("bs")
    return falls(spark, d).withColumn("label", F.when(bs > 47, 2).when(bs > 45, 1).when(bs > 43, 0))


@check("m3_cluster_report", "sample", f"""WITH {WF}, {LAB} SELECT coalesce(max(label) + 1, 0) AS n_clusters, ROUND(1 - count(label) * 1.0::DOUBLE / (50 * count(DISTINCT ping)), 6) AS unlabelled FROM im""")
def _(spark, d):
    out = R.cluster_report(image(spark, d), "ping", "label")
    return out.select("n_clusters", r("unlabelled").alias("unlabelled"))


@check("j8_sample_labels", "sample", f"""WITH {WF}, {LAB} SELECT s.ping, num, part, line, s.bs, coalesce(label, -1) AS label FROM sample s LEFT JOIN im ON im.ping = s.ping AND im.bin = floor(s.angle - 20)""")
def _(spark, d):
    out = R.sample_labels(sample(spark, d), image(spark, d), "ping", "angle")
    return out.select("ping", "num", "part", "line", "bs", "label")
