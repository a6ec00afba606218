"""Queries on components, k-means, silhouettes and density clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.session import local_table, materialise
from riskloom.operators import density, kmeans, minibatch, neighbours, preparation, reduction, wide_components
from riskloom.operators.dbscan import dbscan, knee
from riskloom.plans.apps import APPS_SQL, applications, read
from riskloom.plans.catalogue import query, u, with_micro

_DIMS = 64
_SCALED = ["amt_credit", "amt_goods", "qty"]
_EPS, _MIN = 0.012, 5


def _embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


def _flat(spark: SparkSession, sf: str, n: int = 2) -> DataFrame:
    names = [F.get("x", F.lit(i)).alias(f"e{i}") for i in range(n)]
    return materialise(_embeddings(spark, sf).select("vec_id", *names), "points")


def _complete(spark: SparkSession, sf: str) -> DataFrame:
    """Scaled numeric columns of the applications that have them all."""
    apps = materialise(applications(spark, sf).select("app_id", *_SCALED).dropna(), "apps")
    scale = {r["feature"]: r for r in preparation.fit_scaler(apps, _SCALED).collect()}
    z = [preparation.scaled(F.col(c), scale[c]["mean"], scale[c]["scale"]).alias(c) for c in _SCALED]
    return materialise(apps.select("app_id", *z), "scaled")


_EMB = "WITH e AS (SELECT vec_id, label, cast(embedding AS DOUBLE[]) AS x FROM embeddings)"


@query(
    "pca_row_norms",
    f"""{APPS_SQL}, s AS (SELECT app_id, {", ".join(_SCALED)} FROM apps WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _SCALED)}),
    p AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED)} FROM s)
    SELECT app_id, {u(" + ".join(f"(({c} - m_{c}) / s_{c}) ** 2" for c in _SCALED))} AS norm2 FROM s CROSS JOIN p""",
)
def pca_row_norms(spark: SparkSession, sf: str) -> DataFrame:
    """All components keep each row's distance to the mean; the scores must add up to it."""
    z = reduction.feature_array(_complete(spark, sf), _SCALED)
    scores = reduction.Components.fit(z, "features", 3, _SCALED).transform(z, "features")
    norm2 = F.aggregate("pc", F.lit(0.0), lambda s, v: s + v * v)
    return with_micro(scores.select("app_id", norm2.alias("norm2")), "norm2")


@query("pca_scores")
def pca_scores(spark: SparkSession, sf: str) -> DataFrame:
    emb = _embeddings(spark, sf)
    return reduction.Components.fit(emb, "x", 10).transform(emb, "x").select("vec_id", "pc")


@query(
    "pca_total_variance",
    f"{_EMB} SELECT {u('sum(v)')} AS total FROM (SELECT i, var_samp(x[i]) AS v FROM e, range(1, {_DIMS + 1}) g(i) GROUP BY i)",
)
def pca_total_variance(spark: SparkSession, sf: str) -> DataFrame:
    """The variances of all components add up to those of the features."""
    table = reduction.Components.fit(_embeddings(spark, sf), "x", _DIMS).explained_variance(spark)
    return with_micro(table.agg(F.sum("variance").alias("total")), "total")


@query(
    "pca_wide_moments",
    f"""{_EMB}, v AS (SELECT vec_id, i, x[i] AS v FROM e, range(1, {_DIMS + 1}) g(i)),
    c AS (SELECT a.i, b.i AS j, covar_samp(a.v, b.v) AS c FROM v a JOIN v b ON a.vec_id = b.vec_id GROUP BY ALL)
    SELECT {u("sum(CASE WHEN i = j THEN c END)")} AS total, {u("sum(c * c)")} AS squares FROM c""",
)
def pca_wide_moments(spark: SparkSession, sf: str) -> DataFrame:
    """The variances of all components, found in passes, add up to the trace; their squares to the covariances' squares."""
    model = wide_components.fit_wide(_embeddings(spark, sf), "x", _DIMS)
    table = model.explained_variance(spark)
    return with_micro(table.agg(F.sum("variance").alias("total"), F.sum(F.col("variance") * F.col("variance")).alias("squares")), "total", "squares")


@query("pca_explained_variance")
def pca_explained_variance(spark: SparkSession, sf: str) -> DataFrame:
    return reduction.Components.fit(_embeddings(spark, sf), "x", 20).explained_variance(spark)


@query("pca_biplot")
def pca_biplot(spark: SparkSession, sf: str) -> DataFrame:
    return reduction.Components.fit(_embeddings(spark, sf), "x", 10).biplot_table(spark)


@query("pca_importance")
def pca_importance(spark: SparkSession, sf: str) -> DataFrame:
    return reduction.Components.fit(_embeddings(spark, sf), "x", 10).importance_table(spark)


_CENTRES = f"""c AS (SELECT label AS cluster, i, avg(x[i]) AS m, count(*) AS size FROM e, range(1, {_DIMS + 1}) g(i) GROUP BY ALL),
 cl AS (SELECT cluster, max(size) AS size, list(m ORDER BY i) AS centre FROM c GROUP BY 1)"""


@query(
    "nearest_centroid",
    f"""{_EMB}, {_CENTRES}, d AS (SELECT vec_id, cluster, list_distance(x, centre) AS d FROM e CROSS JOIN cl)
    SELECT vec_id, arg_min(cluster, (d, cluster)) AS cluster, {u('min(d)')} AS distance FROM d GROUP BY 1""",
)
def nearest_centroid(spark: SparkSession, sf: str) -> DataFrame:
    emb = _embeddings(spark, sf)
    out = kmeans.assign_nearest(emb, "x", kmeans.centroids(emb, "label", "x"))
    return with_micro(out.select("vec_id", "cluster", "distance"), "distance")


@query(
    "centroid_distances",
    f"""{_EMB}, {_CENTRES} SELECT a.cluster AS cluster_a, b.cluster AS cluster_b, {u('list_distance(a.centre, b.centre)')} AS distance
    FROM cl a JOIN cl b ON a.cluster < b.cluster""",
)
def centroid_distances(spark: SparkSession, sf: str) -> DataFrame:
    emb = _embeddings(spark, sf)
    return with_micro(kmeans.centroid_distances(spark, kmeans.centroids(emb, "label", "x")), "distance")


@query(
    "centroid_sizes",
    f"SELECT label AS cluster, count(*) AS size, {u('count(*) * 100.0 / max(count(*)) OVER ()')} AS scaled FROM embeddings GROUP BY 1",
)
def centroid_sizes(spark: SparkSession, sf: str) -> DataFrame:
    emb = _embeddings(spark, sf)
    return with_micro(kmeans.centroid_sizes(kmeans.centroids(emb, "label", "x")), "scaled")


_SIL = f"""{_EMB}, sz AS (SELECT label, count(*) AS n FROM e GROUP BY 1),
 d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.x, b.x)) AS s FROM e a CROSS JOIN e b GROUP BY ALL),
 ab AS (SELECT vec_id, d.label, max(CASE WHEN other = d.label THEN s / nullif(n - 1, 0) END) AS a,
   min(CASE WHEN other <> d.label THEN s / n END) AS b FROM d JOIN sz ON sz.label = other GROUP BY ALL),
 sil AS (SELECT vec_id, label, CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"""


@query("silhouette_points", f"{_SIL} SELECT vec_id, label AS cluster, {u('s')} AS silhouette FROM sil")
def silhouette_points(spark: SparkSession, sf: str) -> DataFrame:
    return with_micro(neighbours.silhouette_samples(_embeddings(spark, sf), "vec_id", "x", "label"), "silhouette")


@query(
    "silhouette_means",
    f"""{_SIL} SELECT label AS cluster, {u('avg(s)')} AS mean_silhouette, {u('min(s)')} AS min_silhouette,
    {u('max(s)')} AS max_silhouette, count(*) AS n FROM sil GROUP BY ROLLUP (label)""",
)
def silhouette_means(spark: SparkSession, sf: str) -> DataFrame:
    points = neighbours.silhouette_samples(_embeddings(spark, sf), "vec_id", "x", "label")
    return with_micro(neighbours.mean_silhouette(points), "mean_silhouette", "min_silhouette", "max_silhouette")


@query(
    "silhouette_squared",
    f"""{_SIL.replace("sum(list_distance(a.x, b.x))", "sum(list_distance(a.x, b.x) * list_distance(a.x, b.x))")}
    SELECT vec_id, label AS cluster, {u('s')} AS silhouette FROM sil""",
)
def silhouette_squared(spark: SparkSession, sf: str) -> DataFrame:
    """The same with squared distances, from the clusters' moments."""
    return with_micro(neighbours.squared_silhouettes(_embeddings(spark, sf), "vec_id", "x", "label"), "silhouette")


@query("kmeans_labels")
def kmeans_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters on the features and on the first three components."""
    emb = materialise(_embeddings(spark, sf), "emb")
    with_pc = materialise(reduction.Components.fit(emb, "x", 3).transform(emb, "x"), "emb")
    _, out = kmeans.kmeans_labels(with_pc, "x", 4, "pc")
    return out.select("vec_id", "cluster", "pc_cluster")


@query("kmeans_elbow")
def kmeans_elbow(spark: SparkSession, sf: str) -> DataFrame:
    emb = materialise(_embeddings(spark, sf), "emb")
    pc = reduction.Components.fit(emb, "x", 3).transform(emb, "x")
    return kmeans.elbow(pc, "vec_id", "pc", [1, *range(2, 9)])


@query("minibatch_labels")
def minibatch_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters by mini-batches, all rows assigned; checked against plain numpy in the tests."""
    emb = materialise(_embeddings(spark, sf), "emb")
    model = minibatch.fit_minibatch(emb, "vec_id", "x", 4, batch_size=1_000)
    return with_micro(model.transform(emb, "x").select("vec_id", "cluster", "distance"), "distance")


@query("minibatch_elbow")
def minibatch_elbow(spark: SparkSession, sf: str) -> DataFrame:
    emb = materialise(_embeddings(spark, sf), "emb")
    pc = reduction.Components.fit(emb, "x", 3).transform(emb, "x")
    return kmeans.elbow(pc, "vec_id", "pc", [1, *range(2, 9)], batch_size=1_000, steps=10)


@query("kmeans_importance")
def kmeans_importance(spark: SparkSession, sf: str) -> DataFrame:
    z = reduction.feature_array(_complete(spark, sf), _SCALED)
    model, _ = kmeans.fit_kmeans(z, "features", 3)
    # Scored on a sample of 1,000 rows, as the method is defined.
    return kmeans.kmeans_importance(model, z, "app_id", "features", _SCALED, sample_size=1_000)


_KDIST = f"""{_EMB}, p AS (SELECT * FROM e),
 kd AS (SELECT vec_id, d AS distance FROM (SELECT a.vec_id, list_distance(a.x, b.x) AS d,
   row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x)) AS r FROM p a CROSS JOIN p b) WHERE r = 5)"""


@query("k_distances", f"{_KDIST} SELECT vec_id, {u('distance')} AS distance FROM kd")
def k_distances(spark: SparkSession, sf: str) -> DataFrame:
    emb = _embeddings(spark, sf)
    return with_micro(neighbours.k_distances(emb, "vec_id", "x", 5, 10).drop("idx"), "distance")


_KNEE = f"""{_KDIST}, s AS (SELECT distance AS v, row_number() OVER (ORDER BY distance DESC, vec_id) - 1 AS i FROM kd),
    n AS (SELECT v, i, 1.0 - (v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()) - i / (max(i) OVER ())::double AS d,
      1.0 / max(i) OVER () AS step FROM s),
    t AS (SELECT *, lead(d) OVER w AS nx, d >= coalesce(lag(d) OVER w, d) AND d >= coalesce(lead(d) OVER w, d) AS top,
      d <= coalesce(lag(d) OVER w, d) AND d <= coalesce(lead(d) OVER w, d) AS bottom FROM n WINDOW w AS (ORDER BY i)),
    l AS (SELECT *, last_value(CASE WHEN bottom THEN 0 WHEN top THEN d - step END IGNORE NULLS) OVER (ORDER BY i) AS lim,
      last_value(CASE WHEN top THEN i END IGNORE NULLS) OVER (ORDER BY i) AS at_i,
      last_value(CASE WHEN top THEN v END IGNORE NULLS) OVER (ORDER BY i) AS at_v FROM t),
    k AS (SELECT cast(at_i AS int) AS idx, at_v AS value FROM l WHERE at_i IS NOT NULL AND nx < lim ORDER BY i LIMIT 1)"""


@query("chosen_eps", f"{_KNEE} SELECT {u('coalesce(max(value), 0.5)')} AS eps FROM k")
def chosen_eps(spark: SparkSession, sf: str) -> DataFrame:
    """The radius at the knee, one half where the curve has none."""
    eps = density.choose_eps(_embeddings(spark, sf), "vec_id", "x", 5, 10)
    return with_micro(local_table(spark, [(eps,)], "eps double"), "eps")


@query("k_distance_knee", f"{_KNEE} SELECT idx, {u('value')} AS value FROM k")
def k_distance_knee(spark: SparkSession, sf: str) -> DataFrame:
    emb = _embeddings(spark, sf)
    curve = materialise(neighbours.k_distances(emb, "vec_id", "x", 5, 10), "curve")
    return with_micro(knee(curve.select("idx", F.col("distance").alias("value"))), "value")


_DB = f"""WITH RECURSIVE e AS (SELECT vec_id AS id, cast(embedding[1] AS double) AS a, cast(embedding[2] AS double) AS b FROM embeddings),
 nb AS (SELECT p.id, q.id AS other FROM e p JOIN e q ON (p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b) <= {_EPS}::double * {_EPS}::double),
 core AS (SELECT id FROM nb GROUP BY 1 HAVING count(*) >= {_MIN}),
 ce AS (SELECT nb.id, other FROM nb JOIN core USING (id) JOIN core c2 ON c2.id = other),
 walk AS (SELECT id, id AS root FROM core UNION SELECT ce.other, walk.root FROM walk JOIN ce ON ce.id = walk.id),
 roots AS (SELECT id, min(root) AS root FROM walk GROUP BY 1),
 lab AS (SELECT id, dense_rank() OVER (ORDER BY root) - 1 AS label FROM roots),
 border AS (SELECT nb.id, min(label) AS label FROM nb JOIN lab ON lab.id = nb.other WHERE nb.id NOT IN (SELECT id FROM core) GROUP BY 1),
 db AS (SELECT e.id AS vec_id, cast(coalesce(lab.label, border.label, -1) AS int) AS label
   FROM e LEFT JOIN lab ON lab.id = e.id LEFT JOIN border ON border.id = e.id)"""


@query("dbscan_labels", f"{_DB} SELECT vec_id, label FROM db")
def dbscan_labels(spark: SparkSession, sf: str) -> DataFrame:
    return dbscan(_flat(spark, sf), "vec_id", ["e0", "e1"], _EPS, _MIN)


# On all 64 coordinates, where few distances are shorter than this.
_WIDE_EPS = 1.15


@query(
    "dbscan_embeddings",
    _DB.replace("cast(embedding[1] AS double) AS a, cast(embedding[2] AS double) AS b", "cast(embedding AS double[]) AS x")
    .replace("(p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b)", "list_distance(p.x, q.x) * list_distance(p.x, q.x)")
    .replace(str(_EPS), str(_WIDE_EPS))
    + " SELECT vec_id, label FROM db",
)
def dbscan_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return dbscan(_embeddings(spark, sf), "vec_id", "x", _WIDE_EPS, _MIN)


@query("dbscan_applications")
def dbscan_applications(spark: SparkSession, sf: str) -> DataFrame:
    """Three scaled numbers of every application; checked against brute force in the tests."""
    return dbscan(_complete(spark, sf), "app_id", _SCALED, 0.15, 10)


@query("dbscan_sensitivity")
def dbscan_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    return density.parameter_sensitivity(_flat(spark, sf), "vec_id", ["e0", "e1"], _EPS, _MIN)


@query("dbscan_importance")
def dbscan_importance(spark: SparkSession, sf: str) -> DataFrame:
    return density.density_importance(_flat(spark, sf), "vec_id", ["e0", "e1"], _EPS, _MIN)
