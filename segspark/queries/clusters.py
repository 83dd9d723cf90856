"""Queries over indices, neighbourhoods and clustering models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from segspark.operators import centroids as ce
from segspark.operators import density as dn
from segspark.operators import indices as ix
from segspark.operators import tuning as tu
from segspark.operators.encode import FeatureEncoder, FeatureSpec
from segspark.operators.models import ClusterSpec, fit_cluster
from segspark.operators.profiles import profile_table
from segspark.operators.tables import attach_labels as attach
from segspark.queries import survey
from segspark.queries.standins import rounded, sql_round, table
from segspark.session import materialize


def vectors(spark, sf_dir):
    """Embeddings with two labellings: the given one and its parity."""
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), "label", (F.col("label") % 2).alias("parity")
    )


VECTORS_SQL = "v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label::BIGINT AS label, (label % 2)::BIGINT AS parity FROM embeddings)"


def _index_ctes(label, tag=""):
    """Moments of one labelling; the centroid is built per dimension."""
    return f"""long{tag} AS (SELECT vec_id, {label} AS l, unnest(x) AS e, unnest(range(1, 65)) AS d FROM v),
mu{tag} AS (SELECT l, list(m ORDER BY d) AS mu FROM (SELECT l, d, avg(e) AS m FROM long{tag} GROUP BY 1, 2) GROUP BY 1),
mo{tag} AS (SELECT {label} AS l, any_value(mu) AS mu, count(*) AS n, avg(list_distance(x, mu)) AS s, sum(pow(list_distance(x, mu), 2)) AS ss
  FROM v JOIN mu{tag} ON {label} = mu{tag}.l GROUP BY 1),
am{tag} AS (SELECT list(m ORDER BY d) AS mu FROM (SELECT d, avg(e) AS m FROM long{tag} GROUP BY 1)),
ch{tag} AS (SELECT sum(mo.n * pow(list_distance(mo.mu, am.mu), 2)) * (sum(mo.n) - count(*)) / (sum(mo.ss) * (count(*) - 1)) AS ch,
  count(*) AS k FROM mo{tag} mo, am{tag} am),
db{tag} AS (SELECT avg(r) AS db FROM (SELECT a.l, max((a.s + b.s) / list_distance(a.mu, b.mu)) AS r
  FROM mo{tag} a JOIN mo{tag} b ON a.l <> b.l GROUP BY 1)),
pd{tag} AS (SELECT a.vec_id, a.{label} AS l, b.{label} AS o, sum(list_distance(a.x, b.x)) AS t, count(*) AS c
  FROM v a JOIN v b ON a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
ab{tag} AS (SELECT vec_id, l, max(CASE WHEN l = o THEN t / c END) AS a, min(CASE WHEN l <> o THEN t / c END) AS b FROM pd{tag} GROUP BY 1, 2),
si{tag} AS (SELECT vec_id, l, CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM ab{tag})"""


def calinski_harabasz(spark, sf_dir):
    moments = ix.cluster_moments(ix.labellings(vectors(spark, sf_dir), "x", ["label"], "vec_id"))
    return rounded(ix.calinski_harabasz(moments))


calinski_harabasz_sql = f"WITH {VECTORS_SQL}, {_index_ctes('label')} SELECT 'label' AS labelling, {sql_round('ch', 'calinski_harabasz')} FROM ch"


def davies_bouldin(spark, sf_dir):
    long = ix.labellings(vectors(spark, sf_dir), "x", ["label", "parity"], "vec_id")
    return rounded(ix.davies_bouldin(materialize(ix.cluster_moments(long))))


davies_bouldin_sql = f"""WITH {VECTORS_SQL}, {_index_ctes('label')}, {_index_ctes('parity', '2')}
SELECT 'label' AS labelling, {sql_round('db', 'davies_bouldin')} FROM db
UNION ALL SELECT 'parity', {sql_round('db', 'davies_bouldin')} FROM db2"""


def silhouette(spark, sf_dir):
    return rounded(ix.silhouettes(vectors(spark, sf_dir), "x", ["label"], "vec_id"))


silhouette_sql = f"WITH {VECTORS_SQL}, {_index_ctes('label')} SELECT 'label' AS labelling, {sql_round('avg(s)', 'silhouette')} FROM si"


def silhouette_per_cluster(spark, sf_dir):
    return rounded(ix.silhouette_per_cluster(vectors(spark, sf_dir), "x", "label", "vec_id"))


silhouette_per_cluster_sql = f"WITH {VECTORS_SQL}, {_index_ctes('label')} SELECT l AS label, {sql_round('avg(s)', 'silhouette')}, count(*) AS size FROM si GROUP BY 1"


def silhouette_samples(spark, sf_dir):
    return rounded(ix.silhouette_samples(vectors(spark, sf_dir), "x", "label", "vec_id"))


silhouette_samples_sql = f"WITH {VECTORS_SQL}, {_index_ctes('label')} SELECT vec_id, {sql_round('s', 'silhouette')} FROM si"


def evaluate_many(spark, sf_dir):
    """All indices of two labellings in one pass over the distances."""
    return rounded(ix.evaluate_many(vectors(spark, sf_dir), "x", ["label", "parity"], "vec_id"))


evaluate_many_sql = f"WITH {VECTORS_SQL}, {_index_ctes('label')}, {_index_ctes('parity', '2')} " + " UNION ALL ".join(
    f"SELECT '{name}' AS labelling, k AS n_clusters, {sql_round(f'(SELECT avg(s) FROM si{tag})', 'silhouette')}, "
    f"{sql_round('ch', 'calinski_harabasz')}, {sql_round(f'(SELECT db FROM db{tag})', 'davies_bouldin')} FROM ch{tag}"
    for name, tag in (("label", ""), ("parity", "2"))
)


def evaluate_one_without_noise(spark, sf_dir):
    """Indices of one labelling whose first label stands for noise, which is left out."""
    rows = vectors(spark, sf_dir).withColumn("label", F.when(F.col("label") == 0, -1).otherwise(F.col("label")))
    return rounded(ix.evaluate(rows, "x", "label", "vec_id", noise="drop", model="given"))


_KEPT_SQL = VECTORS_SQL.replace(" FROM embeddings", " FROM embeddings WHERE label <> 0")
evaluate_one_without_noise_sql = f"""WITH {_KEPT_SQL}, {_index_ctes('label')}
SELECT 'given' AS model, k AS n_clusters, {sql_round('(SELECT avg(s) FROM si)', 'silhouette')},
  {sql_round('ch', 'calinski_harabasz')}, {sql_round('(SELECT db FROM db)', 'davies_bouldin')} FROM ch"""


def attach_labels(spark, sf_dir):
    """Customers with a label of their own, joined by key; both sides must hold the same keys."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    labels = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") > 0).cast("int").alias("cluster"))
    return attach(customers, labels, "c_custkey")


attach_labels_sql = "SELECT c_custkey, c_nationkey, (c_acctbal > 0)::INTEGER AS cluster FROM customer"


def encode_other_rows(spark, sf_dir):
    """State fitted on some customers, applied to all: categories not seen in the fit are all zero."""
    rows = table(spark, sf_dir, "customer").withColumn("nation", F.col("c_nationkey").cast("string"))
    learnt = rows.where("c_acctbal >= 5000 AND c_nationkey < 20")
    spec = FeatureSpec(numeric=["c_acctbal"], categorical=["nation"], scaler="minmax")
    encoded = FeatureEncoder(spec).fit(learnt).transform_array(rows, ["c_custkey"])
    hot = F.slice("features", 2, 1000)
    return rounded(
        encoded.select(
            "c_custkey", F.col("features")[0].alias("acctbal"), F.size("features").cast("long").alias("width"),
            F.array_position(hot, 1.0).alias("place"),
        )
    )


encode_other_rows_sql = f"""WITH l AS (SELECT * FROM customer WHERE c_acctbal >= 5000 AND c_nationkey < 20),
m AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, count(DISTINCT c_nationkey)::BIGINT AS width FROM l),
n AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS place FROM (SELECT DISTINCT c_nationkey::VARCHAR AS v FROM l))
SELECT c_custkey, {sql_round("(c_acctbal - lo) / (hi - lo)", "acctbal")}, width, coalesce(place, 0) AS place
FROM customer CROSS JOIN m LEFT JOIN n ON v = c_nationkey::VARCHAR"""

# ---- density clustering -------------------------------------------------------------

EPS, EPS_MANHATTAN, MIN_SAMPLES = 1.18, 7.4, 5
_MANHATTAN = "list_sum(list_transform(list_zip(a.x, b.x), lambda p: abs(p[1] - p[2])))"


def eps_neighbours(spark, sf_dir):
    """Number of rows within the radius of each row."""
    return dn.neighbour_counts(vectors(spark, sf_dir), "x", "vec_id", EPS)


eps_neighbours_sql = f"""WITH {VECTORS_SQL} SELECT a.vec_id, count(*) AS n FROM v a JOIN v b
ON list_distance(a.x, b.x) <= {EPS} GROUP BY 1"""


def dbscan_euclidean(spark, sf_dir):
    return dn.dbscan(vectors(spark, sf_dir), "x", "vec_id", EPS, MIN_SAMPLES)


def dbscan_manhattan(spark, sf_dir):
    return dn.dbscan(vectors(spark, sf_dir), "x", "vec_id", EPS_MANHATTAN, MIN_SAMPLES, "manhattan")


def _dbscan_sql(distance, eps):
    return f"""WITH RECURSIVE {VECTORS_SQL},
near AS MATERIALIZED (SELECT a.vec_id AS p, b.vec_id AS q FROM v a JOIN v b ON {distance} <= {eps}),
core AS MATERIALIZED (SELECT p FROM near GROUP BY p HAVING count(*) >= {MIN_SAMPLES}),
link AS MATERIALIZED (SELECT p, q FROM near SEMI JOIN core USING (p) WHERE q IN (SELECT p FROM core)),
walk(p, q) AS (SELECT p, q FROM link UNION SELECT w.p, l.q FROM walk w JOIN link l ON w.q = l.p),
comp AS (SELECT p, min(q) AS c FROM walk GROUP BY p),
num AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS k FROM (SELECT DISTINCT c FROM comp)),
lab AS (SELECT p, k FROM comp JOIN num USING (c)),
border AS (SELECT n.p, min(k) AS k FROM near n JOIN lab ON n.q = lab.p WHERE n.p NOT IN (SELECT p FROM core) GROUP BY 1),
al AS (SELECT * FROM lab UNION ALL SELECT * FROM border)
SELECT vec_id, coalesce(k, -1)::INTEGER AS cluster FROM v LEFT JOIN al ON vec_id = p"""


def knn_core_distance(spark, sf_dir):
    return rounded(dn.core_distances(vectors(spark, sf_dir), "x", "vec_id", MIN_SAMPLES))


knn_core_distance_sql = f"""WITH {VECTORS_SQL}, d AS (SELECT a.vec_id, list_distance(a.x, b.x) AS d,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x)) AS rn FROM v a JOIN v b ON a.vec_id <> b.vec_id)
SELECT vec_id, {sql_round("d", "core")} FROM d WHERE rn = {MIN_SAMPLES}"""


def mutual_reachability_mst_weight(spark, sf_dir):
    return rounded(dn.spanning_tree_weight(vectors(spark, sf_dir), "x", "vec_id", MIN_SAMPLES), 4)


# A tree grown vertex by vertex; visited vertices are null in the list of best edges.
_MST_SQL = f"""WITH RECURSIVE {VECTORS_SQL},
i AS (SELECT x, row_number() OVER (ORDER BY vec_id) AS i FROM v),
d AS MATERIALIZED (SELECT a.i, b.i AS j, list_distance(a.x, b.x) AS d FROM i a JOIN i b ON a.i <> b.i),
c AS (SELECT i, d AS core FROM (SELECT i, d, row_number() OVER (PARTITION BY i ORDER BY d) AS rn FROM d) WHERE rn = {MIN_SAMPLES}),
m AS MATERIALIZED (SELECT i, list(w ORDER BY j) AS row FROM (
  SELECT i, j, greatest(d, p.core, q.core) AS w FROM d JOIN c p USING (i) JOIN c q ON q.i = d.j
  UNION ALL SELECT i, i, NULL FROM i) GROUP BY i),
grow(step, total, best) AS (
  SELECT 0, 0.0::DOUBLE, row FROM m WHERE i = 1
  UNION ALL
  SELECT step + 1, total + low, list_transform(best, lambda b, k: CASE WHEN b IS NULL OR k = pos THEN NULL ELSE least(b, m.row[k]) END)
  FROM (SELECT step, total, best, list_min(best) AS low, list_position(best, list_min(best)) AS pos FROM grow) g JOIN m ON m.i = g.pos
  WHERE low IS NOT NULL)
SELECT step::BIGINT AS n_edges, round(total, 4) + 0.0 AS weight FROM grow ORDER BY step DESC LIMIT 1"""


# With one sample the core distance is that of the nearest neighbour, reachability is
# the distance itself, and no two edges tie: the hierarchy is unique.
LEAST = 3


def hdbscan_fit(spark, sf_dir):
    return dn.hdbscan(vectors(spark, sf_dir), "x", "vec_id", min_cluster_size=LEAST, min_samples=1)


# Grow the tree, merge its edges in order, then keep the topmost selected clusters.
_HDBSCAN_SQL = f"""WITH RECURSIVE {VECTORS_SQL},
i AS MATERIALIZED (SELECT vec_id, x, row_number() OVER (ORDER BY vec_id)::INTEGER AS i FROM v),
m AS MATERIALIZED (SELECT i, list(w ORDER BY j) AS row FROM (
  SELECT a.i, b.i AS j, CASE WHEN a.i <> b.i THEN list_distance(a.x, b.x) END AS w FROM i a, i b) GROUP BY i),
grow(step, best, src, u, v, w) AS (
  SELECT 0, row, list_transform(row, lambda r: 1), 0, 0, 0.0::DOUBLE FROM m WHERE i = 1
  UNION ALL
  SELECT step + 1, list_transform(best, lambda b, k: CASE WHEN b IS NULL OR k = pos THEN NULL ELSE least(b, m.row[k]) END),
    list_transform(src, lambda s, k: CASE WHEN m.row[k] < best[k] THEN pos ELSE s END), src[pos], pos, low
  FROM (SELECT *, list_min(best) AS low, list_position(best, list_min(best)) AS pos FROM grow) g JOIN m ON m.i = g.pos
  WHERE low IS NOT NULL),
e AS MATERIALIZED (SELECT u, v, w, row_number() OVER (ORDER BY w)::INTEGER AS e FROM grow WHERE step > 0),
z AS (SELECT max(i) AS n FROM i),
mg(e, comp, born, cl, sz, mass, inr, ca, cb, sela, selb) AS (
  SELECT 0, list_transform(range(1, n + 1), lambda k: k::INTEGER), list_transform(range(n), lambda k: NULL::INTEGER),
    list_transform(range(n), lambda k: NULL::INTEGER), list_transform(range(n), lambda k: 1),
    list_transform(range(n), lambda k: 0.0::DOUBLE), list_transform(range(n), lambda k: 0.0::DOUBLE),
    NULL::INTEGER, NULL::INTEGER, false, false FROM z
  UNION ALL
  SELECT e, comp2, list_transform(born, lambda x, k: coalesce(x, CASE WHEN comp2[k] = a THEN cln END)),
    list_transform(cl, lambda x, k: CASE WHEN k = a THEN cln ELSE x END),
    list_transform(sz, lambda x, k: CASE WHEN k = a THEN tot ELSE x END),
    list_transform(mass, lambda x, k: CASE WHEN k = a THEN CASE WHEN ka IS NOT NULL AND kb IS NULL THEN mass[a] + sb * den
      WHEN kb IS NOT NULL AND ka IS NULL THEN mass[b] + sa * den WHEN cln IS NOT NULL THEN tot * den ELSE 0 END ELSE x END),
    list_transform(inr, lambda x, k: CASE WHEN k = a THEN CASE WHEN ka IS NOT NULL AND kb IS NOT NULL
      THEN greatest(sta, inr[a]) + greatest(stb, inr[b]) WHEN ka IS NOT NULL THEN inr[a] WHEN kb IS NOT NULL THEN inr[b] ELSE 0 END ELSE x END),
    CASE WHEN kb IS NOT NULL THEN ka END, CASE WHEN ka IS NOT NULL THEN kb END, sta >= inr[a], stb >= inr[b]
  FROM (SELECT *, list_transform(comp, lambda c: CASE WHEN c = b THEN a ELSE c END) AS comp2,
      mass[a] - den * sa AS sta, mass[b] - den * sb AS stb,
      CASE WHEN ka IS NOT NULL AND kb IS NOT NULL THEN e WHEN ka IS NOT NULL THEN ka WHEN kb IS NOT NULL THEN kb
        WHEN tot >= {LEAST} THEN e END AS cln
    FROM (SELECT e.e, comp, born, cl, sz, mass, inr, 1 / e.w AS den, comp[e.u] AS a, comp[e.v] AS b,
        cl[comp[e.u]] AS ka, cl[comp[e.v]] AS kb, sz[comp[e.u]] AS sa, sz[comp[e.v]] AS sb,
        sz[comp[e.u]] + sz[comp[e.v]] AS tot
      FROM mg JOIN e ON e.e = mg.e + 1))),
cs AS MATERIALIZED (SELECT ca AS c, e AS up, sela AS sel FROM mg WHERE ca IS NOT NULL AND cb IS NOT NULL
  UNION ALL SELECT cb, e, selb FROM mg WHERE ca IS NOT NULL AND cb IS NOT NULL),
top(c, t) AS (SELECT DISTINCT up, NULL::INTEGER FROM cs WHERE up NOT IN (SELECT c FROM cs)
  UNION ALL SELECT cs.c, coalesce(top.t, CASE WHEN sel THEN cs.c END) FROM top JOIN cs ON cs.up = top.c),
pt AS (SELECT unnest(born) AS c, unnest(range(1, len(born) + 1)) AS i FROM mg WHERE e = (SELECT n - 1 FROM z)),
lb AS (SELECT vec_id, t FROM i LEFT JOIN pt USING (i) LEFT JOIN top ON pt.c = top.c),
nu AS (SELECT t, row_number() OVER (ORDER BY min(vec_id)) - 1 AS k FROM lb WHERE t IS NOT NULL GROUP BY t)
SELECT vec_id, coalesce(k, -1)::INTEGER AS cluster FROM lb LEFT JOIN nu USING (t)"""


# ---- centroid and mixture models ----------------------------------------------------

_START_SQL = f"{VECTORS_SQL}, {_index_ctes('label').split('mo AS')[0].rstrip().rstrip(',')}"


def _label_centers(spark, sf_dir):
    """The mean vector of each label, as start centroids."""
    long = ix.labellings(vectors(spark, sf_dir), "x", ["label"], "vec_id")
    return ix.cluster_moments(long).select(F.col("label").cast("int").alias("cluster"), "mu")


def nearest_centroid_assign(spark, sf_dir):
    """Closest label centroid of every vector."""
    centers = _label_centers(spark, sf_dir).agg(
        F.array_sort(F.collect_list(F.struct("cluster", "mu")))["mu"].alias("c")
    ).scalar()
    rows = vectors(spark, sf_dir).withColumn("_c", centers)
    return rows.select("vec_id", ce.nearest_centroid("x", F.col("_c")).alias("cluster"))


_ASSIGN_SQL = """asg AS (SELECT vec_id, x, arg_min(l, list_distance(x, mu))::INTEGER AS cluster
  FROM v, mu GROUP BY vec_id, x)"""
nearest_centroid_assign_sql = f"WITH {_START_SQL}, {_ASSIGN_SQL} SELECT vec_id, cluster FROM asg"


def _by_dimension(df, *arrays):
    pos = F.posexplode(arrays[0]).alias("d", arrays[0])
    rest = [c for c in df.columns if c not in arrays]
    out = df.select(*rest, *arrays[1:], pos)
    return rounded(out.select(*rest, F.col("d"), arrays[0], *[F.col(a)[F.col("d")].alias(a) for a in arrays[1:]]))


def kmeans_one_step(spark, sf_dir):
    """One assignment and update from the label centroids, long by dimension."""
    step = ce.kmeans_step(vectors(spark, sf_dir), "x", _label_centers(spark, sf_dir))
    return _by_dimension(step, "mu")


kmeans_one_step_sql = f"""WITH {_START_SQL}, {_ASSIGN_SQL},
u AS (SELECT cluster, unnest(x) AS e, unnest(range(0, 64)) AS d FROM asg)
SELECT cluster, count(*) AS n, d::INTEGER AS d, {sql_round("avg(e)", "mu")} FROM u GROUP BY cluster, d"""


def _em_step(kind):
    def run(spark, sf_dir):
        rows = vectors(spark, sf_dir)
        data = rows.select("x", F.col("label").cast("int").alias("label"))
        k = rows.agg(F.max("label")).first()[0] + 1
        shift = ce.column_means(data)
        step = ce.mixture_step(data, ce.mixture_from_labels(data, "label", k, kind, shift), shift)
        return _mixture_rows(spark, step)

    return run


def _mixture_rows(spark, m):
    """Parameters in long form: component, weight, dimension, mean and variance."""
    k, d = m.means.shape
    variance = {
        "full": lambda: np.stack([np.diag(c) for c in m.covariances]),
        "tied": lambda: np.tile(np.diag(m.covariances), (k, 1)),
        "diag": lambda: m.covariances,
        "spherical": lambda: np.tile(m.covariances[:, None], (1, d)),
    }[m.covariance_type]()
    rows = [(j, float(m.weights[j]), m.means[j].tolist(), variance[j].tolist()) for j in range(k)]
    df = spark.createDataFrame(rows, "component int, weight double, mean array<double>, var array<double>")
    return _by_dimension(df, "mean", "var")


def _em_sql(spherical):
    pool = "avg(s) OVER (PARTITION BY j)" if spherical else "s"
    return f"""WITH {VECTORS_SQL},
u AS MATERIALIZED (SELECT vec_id, label AS l, unnest(x) AS e, unnest(range(0, 64)) AS d FROM v),
p0 AS (SELECT l AS j, d, avg(e) AS m, var_pop(e) + 1e-6 AS s, count(*)::DOUBLE / (SELECT count(*) FROM v) AS w FROM u GROUP BY 1, 2),
p AS MATERIALIZED (SELECT j, d, m, {pool} AS s, w FROM p0),
lj AS (SELECT vec_id, j, ln(min(w)) - 0.5 * sum(ln(2 * pi()) + ln(s) + pow(e - m, 2) / s) AS lp FROM u JOIN p USING (d) GROUP BY 1, 2),
mx AS (SELECT vec_id, j, exp(lp - max(lp) OVER (PARTITION BY vec_id)) AS q FROM lj),
r AS MATERIALIZED (SELECT vec_id, j, q / sum(q) OVER (PARTITION BY vec_id) AS r FROM mx),
n0 AS (SELECT j, d, sum(r) AS n, sum(r * e) / sum(r) AS m, sum(r * e * e) / sum(r) - pow(sum(r * e) / sum(r), 2) + 1e-6 AS s
  FROM r JOIN u USING (vec_id) GROUP BY 1, 2)
SELECT j::INTEGER AS component, d::INTEGER AS d, {sql_round("n / (SELECT count(*) FROM v)", "weight")}, {sql_round("m", "mean")},
  {sql_round(pool, "var")} FROM n0"""


# The shared covariance is inverted by Gauss-Jordan elimination; its determinant cancels.
_TIED_SQL = f"""WITH RECURSIVE {VECTORS_SQL},
u AS MATERIALIZED (SELECT vec_id, label AS l, unnest(x) AS e, unnest(range(0, 64)) AS d FROM v),
n AS (SELECT count(*)::DOUBLE AS n FROM v),
mu AS MATERIALIZED (SELECT l AS j, d, avg(e) AS m, count(*)::DOUBLE AS c FROM u GROUP BY 1, 2),
xx AS (SELECT a.d AS p, b.d AS q, sum((a.e - ma.m) * (b.e - mb.m)) / (SELECT n FROM n) + CASE WHEN a.d = b.d THEN 1e-6 ELSE 0 END AS s
  FROM u a JOIN u b USING (vec_id) JOIN mu ma ON ma.j = a.l AND ma.d = a.d JOIN mu mb ON mb.j = b.l AND mb.d = b.d GROUP BY 1, 2),
wide AS (SELECT list(row ORDER BY p) AS mat FROM (SELECT p, list_concat(list(s ORDER BY q),
  list_transform(range(0, 64), lambda i: CASE WHEN i = p THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)) AS row FROM xx GROUP BY p)),
gauss(k, mat) AS (
  SELECT 0, mat FROM wide
  UNION ALL
  SELECT k + 1, list_transform(mat, lambda r, i: CASE WHEN i = k + 1 THEN piv
    ELSE list_transform(r, lambda y, c: y - r[k + 1] * piv[c]) END)
  FROM (SELECT k, mat, list_transform(mat[k + 1], lambda y: y / mat[k + 1][k + 1]) AS piv FROM gauss WHERE k < 64)),
inv AS MATERIALIZED (SELECT p, mat[p + 1][65:128] AS row FROM gauss, range(64) t(p) WHERE k = 64),
qj AS MATERIALIZED (SELECT j, p AS d, list_dot_product(ml, row) AS q FROM (SELECT j, list(m ORDER BY d) AS ml FROM mu GROUP BY j), inv),
lj AS (SELECT vec_id, j, ln(min(c) / (SELECT n FROM n)) + sum(e * q) - 0.5 * sum(m * q) AS lp
  FROM u JOIN qj USING (d) JOIN mu USING (j, d) GROUP BY 1, 2),
mx AS (SELECT vec_id, j, exp(lp - max(lp) OVER (PARTITION BY vec_id)) AS q FROM lj),
r AS MATERIALIZED (SELECT vec_id, j, q / sum(q) OVER (PARTITION BY vec_id) AS r FROM mx),
n0 AS MATERIALIZED (SELECT j, d, sum(r) AS n, sum(r * e) / sum(r) AS m FROM r JOIN u USING (vec_id) GROUP BY 1, 2),
va AS (SELECT d, (sq - nm) / (SELECT n FROM n) + 1e-6 AS s FROM (SELECT d, sum(e * e) AS sq FROM u GROUP BY 1)
  JOIN (SELECT d, sum(n * m * m) AS nm FROM n0 GROUP BY 1) USING (d))
SELECT j::INTEGER AS component, d::INTEGER AS d, {sql_round("n / (SELECT n FROM n)", "weight")}, {sql_round("m", "mean")}, {sql_round("s", "var")}
FROM n0 JOIN va USING (d)"""


# One covariance per component: ten matrices are eliminated side by side.
_FULL_SQL = f"""WITH RECURSIVE {VECTORS_SQL},
u AS MATERIALIZED (SELECT vec_id, label AS l, unnest(x) AS e, unnest(range(0, 64)) AS d FROM v),
n AS (SELECT count(*)::DOUBLE AS n FROM v),
mu AS MATERIALIZED (SELECT l AS j, d, avg(e) AS m, count(*)::DOUBLE AS c FROM u GROUP BY 1, 2),
ce AS MATERIALIZED (SELECT vec_id, l AS j, u.d, e - m AS e FROM u JOIN mu ON mu.j = u.l AND mu.d = u.d),
xx AS (SELECT j, a.d AS p, b.d AS q, avg(a.e * b.e) + CASE WHEN a.d = b.d THEN 1e-6 ELSE 0 END AS s
  FROM ce a JOIN ce b USING (vec_id, j) GROUP BY 1, 2, 3),
wide AS (SELECT j, list(row ORDER BY p) AS mat FROM (SELECT j, p, list_concat(list(s ORDER BY q),
  list_transform(range(0, 64), lambda i: CASE WHEN i = p THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)) AS row FROM xx GROUP BY j, p) GROUP BY j),
gauss(j, k, mat, ld) AS (
  SELECT j, 0, mat, 0.0::DOUBLE FROM wide
  UNION ALL
  SELECT j, k + 1, list_transform(mat, lambda r, i: CASE WHEN i = k + 1 THEN piv
    ELSE list_transform(r, lambda y, c: y - r[k + 1] * piv[c]) END), ld + ln(mat[k + 1][k + 1])
  FROM (SELECT j, k, mat, ld, list_transform(mat[k + 1], lambda y: y / mat[k + 1][k + 1]) AS piv FROM gauss WHERE k < 64)),
inv AS MATERIALIZED (SELECT j, p, ld, mat[p + 1][65:128] AS row FROM gauss, range(64) t(p) WHERE k = 64),
gap AS MATERIALIZED (SELECT vec_id, j, list(e - m ORDER BY d) AS g, min(c) AS c FROM u JOIN mu USING (d) GROUP BY 1, 2),
lj AS (SELECT vec_id, j, ln(min(c) / (SELECT n FROM n)) - 0.5 * (min(ld) + sum(g[p + 1] * list_dot_product(row, g))) AS lp
  FROM gap JOIN inv USING (j) GROUP BY 1, 2),
mx AS (SELECT vec_id, j, exp(lp - max(lp) OVER (PARTITION BY vec_id)) AS q FROM lj),
r AS MATERIALIZED (SELECT vec_id, j, q / sum(q) OVER (PARTITION BY vec_id) AS r FROM mx)
SELECT j::INTEGER AS component, d::INTEGER AS d, {sql_round("sum(r) / (SELECT n FROM n)", "weight")}, {sql_round("sum(r * e) / sum(r)", "mean")},
  {sql_round("sum(r * e * e) / sum(r) - pow(sum(r * e) / sum(r), 2) + 1e-6", "var")}
FROM r JOIN u USING (vec_id) GROUP BY j, d"""


def customer_features(spark, sf_dir):
    """Behaviour of every customer, logged and standardized, as one array."""
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("Visit"), F.round(F.sum("o_totalprice"), 2).alias("Spending"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    rows = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", "Visit", "Spending", (F.col("Spending") / F.col("Visit")).alias("PPA"), "urgent", "c_acctbal"
    )
    spec = FeatureSpec(log_numeric=["Visit", "Spending", "PPA"], numeric=["urgent", "c_acctbal"])
    return FeatureEncoder(spec).fit(rows).transform_array(rows, ["c_custkey"])


def kmeans_fit(spark, sf_dir):
    """Five groups of customers encoded by balance and segment: the best start finds the segments.

    Segments lie at least 1 apart and balances spread over [0, 1], so the lowest cost is
    reached by one labelling only, whatever the starts and the partitioning.
    """
    rows = table(spark, sf_dir, "customer")
    spec = FeatureSpec(numeric=["c_acctbal"], categorical=["c_mktsegment"], scaler="minmax")
    encoded = materialize(FeatureEncoder(spec).fit(rows).transform_array(rows, ["c_custkey"]))
    fit = ce.fit_kmeans(encoded, "features", "c_custkey", k=5, n_init=8)
    return fit.predict(encoded, "features", "c_custkey")


kmeans_fit_sql = """WITH k AS (SELECT c_mktsegment,
  (row_number() OVER (ORDER BY count(*) DESC, avg(c_acctbal)) - 1)::INTEGER AS cluster FROM customer GROUP BY 1)
SELECT c_custkey, cluster FROM customer JOIN k USING (c_mktsegment)"""


_CUSTOMER_Z_SQL = """o AS (SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS s,
  count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS g FROM orders GROUP BY 1),
f AS (SELECT c_custkey, unnest([ln(1 + n), ln(1 + s), ln(1 + s / n), g, c_acctbal]::DOUBLE[]) AS e, unnest(range(1, 6)) AS d
  FROM customer JOIN o ON c_custkey = o_custkey),
st AS (SELECT d, avg(e) AS m, stddev_pop(e) AS sd FROM f GROUP BY d)"""


def gmm_fit_full(spark, sf_dir):
    rows = customer_features(spark, sf_dir)
    fit = ce.fit_mixture(rows, "features", "c_custkey", k=3, covariance_type="full")
    return fit.predict(rows, "features", "c_custkey")


def pca_2d(spark, sf_dir):
    rows = customer_features(spark, sf_dir)
    out, shares = ce.principal_axes(rows, "features", "c_custkey")
    return rounded(out.withColumn("explained", F.lit(sum(shares))), 5)


def _power_sql(name, matrix, steps):
    """Largest eigenvector of a symmetric matrix by repeated multiplication."""
    return f"""{name}_w(k, v) AS (SELECT 0, [1.0, 0.9, 0.8, 0.7, 0.6]::DOUBLE[] UNION ALL
  SELECT k + 1, list_transform(y, lambda e: e / sqrt(list_dot_product(y, y)))
  FROM (SELECT k, list_transform(c, lambda r: list_dot_product(r, v)) AS y FROM {name}_w, {matrix} WHERE k < {steps})),
{name} AS (SELECT v, list_dot_product(v, list_transform(c, lambda r: list_dot_product(r, v))) AS l
  FROM {name}_w, {matrix} WHERE k = {steps})"""


def _signed(v):
    return f"sign({v}[list_position(list_transform({v}, lambda e: abs(e)), list_max(list_transform({v}, lambda e: abs(e))))])"


pca_2d_sql = f"""WITH RECURSIVE {_CUSTOMER_Z_SQL},
z AS MATERIALIZED (SELECT c_custkey, d, (e - m) / sd AS z FROM f JOIN st USING (d)),
cm AS MATERIALIZED (SELECT list(r ORDER BY p) AS c FROM (SELECT p, list(s ORDER BY q) AS r FROM (
  SELECT a.d AS p, b.d AS q, avg(a.z * b.z) AS s FROM z a JOIN z b USING (c_custkey) GROUP BY 1, 2) GROUP BY p)),
{_power_sql("a", "cm", 200)},
cn AS MATERIALIZED (SELECT list_transform(c, lambda r, i: list_transform(r, lambda e, j: e - l * v[i] * v[j])) AS c FROM cm, a),
{_power_sql("b", "cn", 800)},
sg AS (SELECT list_transform(a.v, lambda e: e * {_signed("a.v")}) AS v, list_transform(b.v, lambda e: e * {_signed("b.v")}) AS w,
  (a.l + b.l) / 5 AS share FROM a, b)
SELECT c_custkey, {sql_round("sum(z * v[d])", "pc1", 5)}, {sql_round("sum(z * w[d])", "pc2", 5)}, {sql_round("min(share)", "explained", 5)}
FROM z, sg GROUP BY c_custkey"""


SEGMENT_NUMBERS = ["Visit", "Spending", "PPA", "Age", "Group_size", "NPS_P3M", "Funnel_Depth", "Brand_Loyalty"]
SEGMENT_MODES = ["City", "Occupation", "Brand", "BUMO_Group", "Segmentation"]


def customer_segments(spark, sf_dir):
    """Which customer groups exist and how do they differ? The whole way: the survey tables are cleaned,
    integrated, given features, encoded and clustered, and the clusters profiled."""
    # The starts of KMeans depend on the order of rows: give them one that does not hang on the plan above.
    rows = materialize(survey.featured(spark, sf_dir).repartition("ID", "City").sortWithinPartitions("ID", "City", "Year"))
    encoded = materialize(FeatureEncoder(survey.ENCODE_SPEC).fit(rows).transform_array(rows, ["ID"]))
    labels = fit_cluster(encoded, "features", "ID", ClusterSpec("kmeans", {"n_clusters": 3, "n_init": 2})).labels
    return rounded(profile_table(rows.join(labels, "ID"), SEGMENT_NUMBERS, SEGMENT_MODES))


# ---- trials --------------------------------------------------------------------------

LABELLINGS = {"label": "label", "parity": "label % 2", "third": "label % 3", "half": "label // 5"}


def _scored(spark, sf_dir):
    """Indices of four labellings of the vectors, as a table of trials."""
    rows = vectors(spark, sf_dir).withColumns(
        {"third": F.col("label") % 3, "half": F.floor(F.col("label") / 5)}
    )
    return ix.evaluate_many(rows, "x", list(LABELLINGS), "vec_id").withColumnRenamed("labelling", "model")


def _scored_sql():
    ctes, unions = [], []
    for i, (name, expression) in enumerate(LABELLINGS.items()):
        ctes.append(_index_ctes(name, f"_{i}"))
        unions.append(
            f"SELECT '{name}' AS model, k AS n_clusters, (SELECT avg(s) FROM si_{i}) AS sil, ch, (SELECT db FROM db_{i}) AS db FROM ch_{i}"
        )
    source = "v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, " + ", ".join(
        f"({e})::BIGINT AS {n}" for n, e in LABELLINGS.items()
    ) + " FROM embeddings)"
    return f"WITH {source}, {', '.join(ctes)}, t AS ({' UNION ALL '.join(unions)})"


def composite_rank(spark, sf_dir):
    """Labellings ranked by the composite score."""
    ranked = tu.leaderboard(_scored(spark, sf_dir))
    return rounded(ranked.select("model", "n_clusters", "silhouette", "calinski_harabasz", "davies_bouldin", "composite_score"))


_COMPOSITE_SQL = """0.4 * sil + 0.3 * (ch - min(ch) OVER ()) / (max(ch) OVER () - min(ch) OVER ())
  + 0.3 * (max(db) OVER () - db) / (max(db) OVER () - min(db) OVER ())"""
composite_rank_sql = f"""{_scored_sql()} SELECT model, n_clusters, {sql_round("sil", "silhouette")}, {sql_round("ch", "calinski_harabasz")},
  {sql_round("db", "davies_bouldin")}, {sql_round(_COMPOSITE_SQL, "composite_score")} FROM t"""


def best_per_metric(spark, sf_dir):
    return rounded(tu.best_per_metric(_scored(spark, sf_dir), ["silhouette", "calinski_harabasz", "davies_bouldin"]))


best_per_metric_sql = f"""{_scored_sql()}
SELECT 'silhouette' AS metric, arg_max(model, sil) AS model, {sql_round("max(sil)", "value")} FROM t
UNION ALL SELECT 'calinski_harabasz', arg_max(model, ch), {sql_round("max(ch)", "value")} FROM t
UNION ALL SELECT 'davies_bouldin', arg_min(model, db), {sql_round("min(db)", "value")} FROM t"""


def _trial_rows(search):
    return rounded(tu.leaderboard(search.results).drop("params"))


def grid_search_kmeans(spark, sf_dir):
    rows = customer_features(spark, sf_dir)
    grid = {"n_clusters": [3, 4, 5], "init": ["k-means++"], "n_init": [1, 2], "max_iter": [100]}
    return _trial_rows(tu.grid_search(rows, "features", "c_custkey", "kmeans", grid))


def model_comparison(spark, sf_dir):
    """The four models with their comparison settings on the customer features."""
    specs = {
        "KMeans": ClusterSpec("kmeans", {"n_init": 2}, 5),
        "GMM": ClusterSpec("gmm", {"covariance_type": "full"}, 5),
        "DBSCAN": ClusterSpec("dbscan", {"eps": 0.5, "min_samples": 10}),
        "HDBSCAN": ClusterSpec("hdbscan", {"min_cluster_size": 15, "min_samples": 10}),
    }
    return _trial_rows(tu.compare_models(customer_features(spark, sf_dir), "features", "c_custkey", specs))


QUERIES = {
    "customer_segments": (customer_segments, None),
    "nearest_centroid_assign": (nearest_centroid_assign, nearest_centroid_assign_sql),
    "kmeans_one_step": (kmeans_one_step, kmeans_one_step_sql),
    "gmm_one_em_step_diag": (_em_step("diag"), _em_sql(False)),
    "gmm_one_em_step_spherical": (_em_step("spherical"), _em_sql(True)),
    "gmm_one_em_step_full": (_em_step("full"), _FULL_SQL),
    "gmm_one_em_step_tied": (_em_step("tied"), _TIED_SQL),
    "kmeans_fit": (kmeans_fit, kmeans_fit_sql),
    "gmm_fit_full": (gmm_fit_full, None),
    "pca_2d": (pca_2d, pca_2d_sql),
    "composite_rank": (composite_rank, composite_rank_sql),
    "best_per_metric": (best_per_metric, best_per_metric_sql),
    "grid_search_kmeans": (grid_search_kmeans, None),
    "model_comparison": (model_comparison, None),
    "eps_neighbours": (eps_neighbours, eps_neighbours_sql),
    "dbscan_euclidean": (dbscan_euclidean, _dbscan_sql("list_distance(a.x, b.x)", EPS)),
    "dbscan_manhattan": (dbscan_manhattan, _dbscan_sql(_MANHATTAN, EPS_MANHATTAN)),
    "knn_core_distance": (knn_core_distance, knn_core_distance_sql),
    "mutual_reachability_mst_weight": (mutual_reachability_mst_weight, _MST_SQL),
    "hdbscan_fit": (hdbscan_fit, _HDBSCAN_SQL),
    "calinski_harabasz": (calinski_harabasz, calinski_harabasz_sql),
    "davies_bouldin": (davies_bouldin, davies_bouldin_sql),
    "silhouette": (silhouette, silhouette_sql),
    "silhouette_per_cluster": (silhouette_per_cluster, silhouette_per_cluster_sql),
    "silhouette_samples": (silhouette_samples, silhouette_samples_sql),
    "evaluate_many": (evaluate_many, evaluate_many_sql),
    "evaluate_one_without_noise": (evaluate_one_without_noise, evaluate_one_without_noise_sql),
    "attach_labels": (attach_labels, attach_labels_sql),
    "encode_other_rows": (encode_other_rows, encode_other_rows_sql),
}
