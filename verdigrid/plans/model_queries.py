"""Gaps, split, fit, evaluation and counterfactual."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigrid.operators import bands as ob
from verdigrid.operators import gaps
from verdigrid.operators import regression as rg
from verdigrid.operators import spatial as osp
from verdigrid.plans import views, workflows
from verdigrid.plans.raster_queries import MEMBERS, PIX
from verdigrid.plans.registry import query, rounded
from verdigrid.session import materialise, scratch_path
from verdigrid.sources.models import load_model, save_model

FEATURES, TARGET = rg.FEATURES, rg.TARGET
COMPLETE = " AND ".join(f"{b} IS NOT NULL" for b in ob.STACK_BANDS)
# Coefficients given on both sides, where a query is about the table and not about the fit.
GIVEN = rg.OlsModel(
    299.5123456789,
    dict(zip(FEATURES, (-0.004, 0.75, -0.5, 4.25, 0.125, -7.5))),
)
GIVEN_SQL = " + ".join([f"{GIVEN.intercept!r}E0", *(f"{v!r}E0 * {n}" for n, v in GIVEN.coefficients.items())])


def sql_split(seed: int) -> str:
    """CTEs ``fit_rows`` and ``test_rows`` of the complete pixels."""
    return f"""
ranked AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', '{seed}', row_id, col_id)), row_id, col_id) AS rk,
                  count(*) OVER () AS total FROM pixels WHERE {COMPLETE}),
test_rows AS (SELECT * FROM ranked WHERE rk <= ceil(2E-1 * total)),
fit_rows AS (SELECT * FROM ranked WHERE rk > ceil(2E-1 * total))"""


def sql_ols(source: str, name: str, features=FEATURES, target: str = TARGET) -> str:
    """CTEs that solve the centred normal equations by elimination; ``name`` has one column per term."""
    n = len(features)
    cov = [f"covar_pop({features[i]}, {features[j]}) AS c_{i}_{j}" for i in range(n) for j in range(i, n)]
    cov += [f"covar_pop({features[i]}, {target}) AS t_{i}" for i in range(n)]
    means = [f"avg({f}) AS m_{i}" for i, f in enumerate(features)] + [f"avg({target}) AS m_y"]
    steps = [f"{name}_e0 AS (SELECT {', '.join(cov + means)} FROM {source})"]
    for k in range(n - 1):
        changed = [
            f"c_{i}_{j} - c_{k}_{i} * c_{k}_{j} / c_{k}_{k} AS c_{i}_{j}" for i in range(k + 1, n) for j in range(i, n)
        ] + [f"t_{i} - c_{k}_{i} * t_{k} / c_{k}_{k} AS t_{i}" for i in range(k + 1, n)]
        steps.append(f"{name}_e{k + 1} AS (SELECT * REPLACE ({', '.join(changed)}) FROM {name}_e{k})")
    previous = f"{name}_e{n - 1}"
    for k in reversed(range(n)):
        known = "".join(f" - c_{k}_{j} * b_{j}" for j in range(k + 1, n))
        steps.append(f"{name}_b{k} AS (SELECT *, (t_{k}{known}) / c_{k}_{k} AS b_{k} FROM {previous})")
        previous = f"{name}_b{k}"
    intercept = "m_y" + "".join(f" - b_{i} * m_{i}" for i in range(n))
    terms = ", ".join(f"b_{i} AS w_{f}" for i, f in enumerate(features))
    steps.append(f"{name} AS (SELECT {intercept} AS w_intercept, {terms} FROM {previous})")
    return ",\n".join(steps)


FITTED_SQL = "w_intercept + " + " + ".join(f"w_{f} * {f}" for f in FEATURES)
TERMS_SQL = " UNION ALL ".join(
    [f"SELECT 'intercept' AS term, 0 AS position, round(w_intercept, 6) AS coefficient FROM model"]
    + [f"SELECT '{f}', {i}, round(w_{f}, 6) FROM model" for i, f in enumerate(FEATURES, start=1)]
)


def _filled(source: str, *bands: str) -> str:
    """CTEs ``filled``: linear interpolation of the bands by row position."""
    marks = ", ".join(
        f"""last_value(CASE WHEN {b} IS NOT NULL THEN pos END IGNORE NULLS) OVER back AS pp_{b},
   last_value({b} IGNORE NULLS) OVER back AS pv_{b},
   first_value(CASE WHEN {b} IS NOT NULL THEN pos END IGNORE NULLS) OVER ahead AS np_{b},
   first_value({b} IGNORE NULLS) OVER ahead AS nv_{b}"""
        for b in bands
    )
    values = ", ".join(
        f"""CASE WHEN {b} IS NOT NULL THEN {b} WHEN pv_{b} IS NULL THEN NULL WHEN nv_{b} IS NULL THEN pv_{b}
   ELSE pv_{b} + (nv_{b} - pv_{b}) * (pos - pp_{b}) / (np_{b} - pp_{b}) END AS {b}"""
        for b in bands
    )
    return f"""
placed AS (SELECT *, row_number() OVER (ORDER BY row_id, col_id) AS pos FROM {source}),
marked AS (SELECT *, {marks}
 FROM placed
 WINDOW back AS (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        ahead AS (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT * REPLACE ({values}) FROM marked)"""


@query(
    "interpolate_linear",
    f"WITH measured AS (SELECT * FROM pixels WHERE lst IS NOT NULL), {_filled('measured', 'dtm', 'fraction_built')} "
    "SELECT row_id, col_id, round(dtm, 6) AS dtm, round(fraction_built, 6) AS fraction_built FROM filled",
    ("pixels",),
)
def interpolate_linear(spark, sf):
    """Rows without LST are left out first, so positions differ from column numbers."""
    bands = ("dtm", "fraction_built", "lst")
    measured = views.pixels(spark, sf, bands).filter(F.col("lst").isNotNull())
    out = gaps.interpolate_linear(measured, ("dtm", "fraction_built"))
    return rounded(out, 6, "dtm", "fraction_built").select("row_id", "col_id", "dtm", "fraction_built")


@query(
    "row_index",
    "SELECT row_id, col_id, CAST(row_number() OVER (ORDER BY row_id, col_id) - 1 AS BIGINT) AS index FROM pixels WHERE dtm IS NOT NULL",
    ("pixels",),
)
def row_index(spark, sf):
    rows = ob.valid_pixels(views.pixels(spark, sf, ("dtm",)))
    return gaps.row_index(rows, "index").select("row_id", "col_id", "index")


@query(
    "split_rows",
    f"""WITH {sql_split(3)}
SELECT row_id, col_id, 'test' AS part FROM test_rows UNION ALL SELECT row_id, col_id, 'fit' FROM fit_rows""",
    ("pixels",),
)
def split_rows(spark, sf):
    fit, test = rg.split_rows(materialise(views.pixels(spark, sf), "split"), 3)
    label = lambda df, name: df.select("row_id", "col_id", F.lit(name).alias("part"))
    return label(test, "test").unionByName(label(fit, "fit"))


_GRAM = [*FEATURES, TARGET]


@query(
    "gram_matrix",
    "SELECT count(*) AS n, "
    + ", ".join(f"round(sum({a}), 3) AS s_{a}" for a in _GRAM) + ", "
    + ", ".join(f"round(sum({a} * {b}), 3) AS p_{a}_{b}" for i, a in enumerate(_GRAM) for b in _GRAM[i:])
    + f" FROM pixels WHERE {COMPLETE}",
    ("pixels",),
)
def gram_matrix(spark, sf):
    gram = rg.gram_matrix(views.pixels(spark, sf))
    return rounded(gram, 3, *[c for c in gram.columns if c != "n"])


@query(
    "fit_one_feature",
    f"""SELECT round(regr_slope(lst, fraction_canopy), 6) AS slope, round(regr_intercept(lst, fraction_canopy), 6) AS intercept
FROM pixels WHERE lst IS NOT NULL AND fraction_canopy IS NOT NULL""",
    ("pixels",),
)
def fit_one_feature(spark, sf):
    model = rg.fit_ols(views.pixels(spark, sf, ("lst", "fraction_canopy")), ["fraction_canopy"])
    pivoted = model.to_df(spark).agg(
        F.max(F.when(F.col("term") == "fraction_canopy", F.col("coefficient"))).alias("slope"),
        F.max(F.when(F.col("term") == "intercept", F.col("coefficient"))).alias("intercept"),
    )
    return rounded(pivoted, 6, "slope", "intercept")


@query("fit_ols", f"WITH {sql_split(3)}, {sql_ols('fit_rows', 'model')} {TERMS_SQL}", ("pixels",))
def fit_ols(spark, sf):
    """Split and fit on all six features; the check solves the same equations in SQL."""
    model, _ = rg.train(materialise(views.pixels(spark, sf), "fit"), rg.SEEDS["active"])
    return rounded(model.to_df(spark), 6, "coefficient")


@query("save_model", f"WITH {sql_ols('complete', 'model')} {TERMS_SQL}".replace(
    "WITH ", f"WITH complete AS (SELECT * FROM pixels WHERE {COMPLETE}), ", 1), ("pixels",))
def save_load_model(spark, sf):
    """Two versions are stored; the newest is read."""
    path = scratch_path(spark, "model")
    pixels = ob.drop_missing(views.pixels(spark, sf))
    save_model(spark, GIVEN, path)
    save_model(spark, rg.fit_ols(pixels), path)
    return rounded(load_model(spark, path).to_df(spark), 6, "coefficient")


@query(
    "predict",
    f"SELECT row_id, col_id, round({GIVEN_SQL}, 6) AS predicted_lst FROM pixels WHERE {COMPLETE}",
    ("pixels",),
)
def predict(spark, sf):
    rows = rg.predict(ob.drop_missing(views.pixels(spark, sf)), GIVEN)
    return rounded(rows, 6, "predicted_lst").select("row_id", "col_id", "predicted_lst")


R2_SQL = "round(1E0 - sum((lst - p) * (lst - p)) / (count(*) * var_pop(lst)), 6) AS r2, count(*) AS n"


@query(
    "r_squared",
    f"SELECT {R2_SQL} FROM (SELECT lst, {GIVEN_SQL} AS p FROM pixels WHERE {COMPLETE})",
    ("pixels",),
)
def r_squared(spark, sf):
    return rounded(rg.r_squared(rg.predict(ob.drop_missing(views.pixels(spark, sf)), GIVEN)), 6, "r2")


@query(
    "evaluate",
    f"""WITH {sql_split(3)}, {sql_ols('fit_rows', 'model')}
SELECT {R2_SQL} FROM (SELECT lst, {FITTED_SQL} AS p FROM test_rows, model)""",
    ("pixels",),
)
def evaluate(spark, sf):
    model, test = rg.train(materialise(views.pixels(spark, sf), "evaluate"), rg.SEEDS["active"])
    return rounded(rg.evaluate(test, model), 6, "r2")


def _scores(name: str, seed: int) -> str:
    body = f"WITH {sql_split(seed)}, {sql_ols('fit_rows', 'model')} SELECT '{name}' AS model, {R2_SQL} FROM (SELECT lst, {FITTED_SQL} AS p FROM test_rows, model)"
    return f"({body})"


@query(
    "compare_models",
    f"SELECT * FROM {_scores('active', 3)} UNION ALL SELECT * FROM {_scores('candidate', 8)}",
    ("pixels",),
)
def compare_models(spark, sf):
    stored = materialise(views.pixels(spark, sf), "compare")
    return rounded(rg.compare_models(stored), 6, "r2")


def _scenario(source: str) -> str:
    return f"{_filled(source, *gaps.GAP_BANDS)}, scenario AS (SELECT * REPLACE (0E0 AS fraction_canopy) FROM filled)"


# after the gaps are filled only a leading gap is left; the target may be missing
_USABLE = " AND ".join(f"{b} IS NOT NULL" for b in ob.STACK_BANDS if b != TARGET)


@query(
    "counterfactual",
    f"""WITH {_scenario('pixels')}
SELECT row_id, col_id, round(dtm, 6) AS dtm, fraction_canopy, round({GIVEN_SQL}, 6) AS predicted_lst
FROM scenario WHERE {_USABLE}""",
    ("pixels",),
)
def counterfactual(spark, sf):
    """No-trees prediction of every pixel with given coefficients."""
    out = rg.counterfactual(views.pixels(spark, sf), GIVEN)
    return rounded(out.select("row_id", "col_id", "dtm", "fraction_canopy", "predicted_lst"), 6, "dtm", "predicted_lst")


@query(
    "counterfactual_fitted",
    f"""WITH {sql_split(3)}, {sql_ols('fit_rows', 'model')}, {_scenario('pixels')}
SELECT row_id, col_id, round({FITTED_SQL}, 5) AS predicted_lst FROM scenario, model WHERE {_USABLE}""",
    ("pixels",),
)
def counterfactual_fitted(spark, sf):
    """The whole regression step: store the table, split, fit, predict without trees."""
    _, predicted = workflows.data_science(views.pixels(spark, sf), {"active": rg.SEEDS["active"]})
    return rounded(predicted.select("row_id", "col_id", "predicted_lst"), 5, "predicted_lst")


@query(
    "cooling_effect",
    f"SELECT row_id, col_id, round({GIVEN_SQL} - lst, 6) AS cooling FROM pixels WHERE {COMPLETE}",
    ("pixels",),
)
def cooling_effect(spark, sf):
    rows = rg.predict(ob.drop_missing(views.pixels(spark, sf)), GIVEN)
    return rounded(rg.cooling_effect(rows), 6, "cooling").select("row_id", "col_id", "cooling")


@query(
    "district_services",
    f"""WITH {MEMBERS}
SELECT m.district_id, round(avg({GIVEN_SQL} - lst), 6) AS mean_cooling, round(sum({GIVEN_SQL} - lst), 6) AS sum_cooling,
       count(*) AS n_pixels
FROM members m JOIN pixels p ON m.row_id = p.row_id AND m.col_id = p.col_id WHERE {COMPLETE} GROUP BY 1""",
    PIX,
)
def district_services(spark, sf):
    rows = rg.predict(ob.drop_missing(views.pixels(spark, sf)), GIVEN)
    return rounded(osp.district_services(rows, views.district_edges(spark)), 6, "mean_cooling", "sum_cooling")


@query(
    "district_mean_lst",
    f"""WITH {MEMBERS},
clipped AS (SELECT * FROM pixels SEMI JOIN members USING (row_id, col_id) WHERE dtm IS NOT NULL)
SELECT m.district_id, round(avg(c.lst), 6) AS mean_lst, count(c.lst) AS n_pixels
FROM clipped c JOIN members m ON c.row_id = m.row_id AND c.col_id = m.col_id GROUP BY 1""",
    PIX,
)
def district_mean_lst(spark, sf):
    """Valid pixels clipped to the study area, mean surface temperature per district."""
    districts = views.district_edges(spark)
    valid = ob.valid_pixels(views.pixels(spark, sf, ("dtm", "lst")))
    clipped = osp.clip_points(valid, districts, crs=views.CRS, edges_crs=views.CRS)
    means = (
        osp.spatial_inner_join(clipped, districts)
        .groupBy("district_id")
        .agg(F.avg("lst").alias("mean_lst"), F.count("lst").alias("n_pixels"))
    )
    return rounded(means, 6, "mean_lst")
