"""Queries over fitted classifiers and the discrete hazard model. Logistic and discrete-hazard fits are
checked by Newton steps in SQL; forests and boosted trees have no SQL form, their split search has."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import classify as M
from ..operators import encode, metrics, reports, split, trees
from ..operators import panel as P
from ..sources.staging import stage_columns
from . import views as V
from .catalog_metrics import FL, metrics_sql
from .newton_sql import newton_logit
from .registry import query

MODELS = ["LogReg", "RF", "LGBM"]


def _staged(v):
    """Train and test loans with their targets, staged: every encoder, fit and score reads them again."""
    keep = [c for c in v.targets.columns if c in (V.KEY, "VintageYear", "Duration", "Event_Prepay", *K.NUMERIC_FEATURES, *K.CATEGORICAL_FEATURES) or c.startswith("Target_T")]
    return stage_columns(split.vintage_split(v.targets, V.TRAIN_END, V.TEST_START, V.TEST_END).select(*keep, "split").repartition(V.KEY))


def _frames(x, horizons):
    """Encoded train and test frames; encoders see the training vintages only."""
    enc = encode.Encoder.fit(x, fit_on="split = 'train'")
    keep = ["loan_key", "split", *[f"Target_T{h}" for h in horizons]]
    m = encode.feature_matrix(x, enc, keep=keep)
    feats = [c for c in m.columns if c not in keep]
    return m.where("split = 'train'"), m.where("split = 'test'"), feats


def _scored(x, models, horizons):
    train, test, feats = _frames(x, horizons)
    fitted, rows = M.fit_horizons(train, feats, horizons, "loan_key", models)
    keep = ["loan_key", *[f"Target_T{h}" for h in horizons]]
    return M.score_horizons(test, feats, fitted, keep), rows, fitted


def _metrics(v, models, horizons):
    wide, _, fitted = _scored(_staged(v), models, horizons)
    long = metrics.predictions_long(wide, models, horizons, ["loan_key"])
    found = metrics.binary_metrics(long, ["model", "horizon"]).withColumn("reason", F.lit(None).cast("string"))
    return found.unionByName(v.spark.createDataFrame(M.skipped(fitted), "model string, horizon int, reason string"), allowMissingColumns=True)


# --- the design matrix and the fits in SQL -------------------------------------------------------
TRAIN = f"VintageYear <= {V.TRAIN_END}"
_NUM = [c for c in K.NUMERIC_FEATURES if c != "OriginalCombinedLoantoValueCLTV"]  # not in the loan view
DESIGN = {f"lv_{c}": f"""select list_concat(list(level order by r), ['OTHER', 'MISSING']) as l_{c} from (select {c} as level, row_number() over (order by count(*) desc, {c}) as r
              from surv where {TRAIN} and {c} is not null group by {c}) where r <= {K.TOP_LEVELS}""" for c in K.CATEGORICAL_FEATURES}
DESIGN["md"] = "select " + ", ".join(f"median({c}) as md_{c}" for c in _NUM) + f" from surv where {TRAIN}"
DESIGN["dx"] = ("select targets.*, list_concat([" + ", ".join(f"coalesce({c}::double, md_{c}), case when {c} is null then 1e0 else 0e0 end" for c in _NUM) + ", VintageYear::double], "
                + ", ".join(f"list_transform(l_{c}, lambda l: case when l = (case when {c} is not null and list_contains(l_{c}[1:len(l_{c}) - 2], {c}) then {c} else 'OTHER' end) then 1e0 else 0e0 end)"
                            for c in K.CATEGORICAL_FEATURES) + ") as x from targets, md, " + ", ".join(f"lv_{c}" for c in K.CATEGORICAL_FEATURES))
LOGITS = dict(DESIGN)
for _h in V.HORIZONS:
    LOGITS[f"t{_h}"] = f"select Target_T{_h}::int as y, x from dx where {TRAIN} and Target_T{_h} is not null"
    LOGITS |= newton_logit(f"t{_h}", prefix=f"g{_h}_")
    LOGITS[f"p{_h}"] = f"""select loan_key, {_h} as horizon, Target_T{_h}::int as y,
        (1 / (1 + exp(-list_inner_product(list_append(list_transform(x, lambda v, i: (v - m[i]) / s[i]), 1e0), b))))::float::double as p
        from dx, g{_h}_st, g{_h}_be where VintageYear between {V.TEST_START} and {V.TEST_END}"""
LOGITS["lg"] = " union all ".join(f"select 'LogReg' as model, * from p{h}" for h in V.HORIZONS)
LOGITS["lk"] = "select * from lg where y is not null"


@query("logistic_horizons", f"select *, cast(null as varchar) as reason from ({metrics_sql('lk', 'model, horizon')})", ("targets",), FL, digits=5, extra=LOGITS)
def _(v):
    return _metrics(v, ["LogReg"], V.HORIZONS)


@query("logistic_coefficients", " union all ".join(
    f"select {h} as horizon, i, abs(b[i]) as importance from (select unnest(range(1, p + 1)) as i from g{h}_st), g{h}_be" for h in V.HORIZONS),
       ("targets",), "importance", digits=5, extra=LOGITS)
def _(v):
    """Standardised slopes by position in the design matrix: numerics with their flags, vintage, then the levels."""
    train, _, feats = _frames(_staged(v), V.HORIZONS)
    _, rows = M.fit_horizons(train, feats, V.HORIZONS, "loan_key", ["LogReg"])
    last = len(feats)
    cut = 2 * len(_NUM)
    place = {f: i + 1 if i < cut else cut + 1 if i == last - 1 else i + 2 for i, f in enumerate(feats)}
    return v.spark.createDataFrame([(h, place[f], imp) for _, h, f, imp, _ in rows], "horizon int, i bigint, importance double")


@query("forest_horizon")
def _(v):
    return _metrics(v, ["RF"], V.HORIZONS)


@query("boosted_horizon")
def _(v):
    return _metrics(v, ["LGBM"], V.HORIZONS)


@query("feature_importance")
def _(v):
    train, _, feats = _frames(_staged(v), V.HORIZONS)
    fitted, rows = M.fit_horizons(train, feats, V.HORIZONS, "loan_key", MODELS)
    return M.importance_table(v.spark, rows, fitted)


@query("prediction_table")
def _(v):
    return _scored(_staged(v), MODELS, V.HORIZONS)[0]


STATIC = ["FICO", "LTV", "DTI", "UPB_k", "orig_rate", "LP_Purchase", "LP_NoCashRefi", "Occ_Investment", "Occ_SecondHome"]
DYNAMIC = ["ELTV", "mortgage_rate", "unemployment", "hpi_yoy"]


HISTORY = ("rate_incentive", "ELTV", "unemployment")
HAZARD = [*STATIC, *DYNAMIC, "age", "age_log", "age_sq", *[f"{c}_{k}12" for c in HISTORY for k in ("mean", "change")]]


def _hazard_model(v):
    x = v.panel_features.withColumn("UPB_k", F.col("UPB") / 1000.0)
    # built again from the loans where it is read: its months are many times the loans
    x = x.select("loan_id", "loan_age", "prepaid_month", "default_month", *dict.fromkeys([*STATIC, *DYNAMIC, "rate_incentive"]))
    x = encode.fill_medians(x, [*STATIC, *DYNAMIC, "rate_incentive"])
    x, hist = M.history_features(x, HISTORY)
    x = x.withColumn("cause_month", F.col("prepaid_month") + 2 * F.col("default_month"))
    feats = [*STATIC, *DYNAMIC, *hist]
    model = M.DiscreteHazards.fit(x, feats)
    return x, model


def _with_history(rows):
    w = "over (partition by loan_id order by loan_age rows between 11 preceding and current row)"
    return (f"select *, loan_age / 12e0 as age, ln(1e0 + loan_age) as age_log, pow(loan_age / 12e0, 2) as age_sq, "
            + ", ".join(f"avg({c}) {w} as {c}_mean12, {c} - coalesce(lag({c}, 12) over (partition by loan_id order by loan_age), first_value({c}) {w}) as {c}_change12" for c in HISTORY) + f" from {rows}")


_FILLED = [*STATIC, *DYNAMIC, "rate_incentive"]
HAZARDS = {
    "q0": "select *, UPB / 1000e0 as UPB_k from feat",
    "q1": "select " + ", ".join(f"median({c}) as d_{c}" for c in _FILLED) + " from q0",
    "q2": "select loan_id, loan_age, prepaid_month, default_month, " + ", ".join(f"coalesce({c}::double, d_{c}) as {c}" for c in _FILLED) + " from q0, q1",
    "q3": _with_history("q2"),
    "q4": "select loan_id, loan_age, prepaid_month, default_month, prepaid_month + 2 * default_month as y, [" + ", ".join(f"{c}::double" for c in HAZARD) + "] as x from q3",
    **newton_logit("q4", "(1e-6 * n)", 3, 14),
}


def _hazard_sql(rows, keep):
    """h1, h2 of rows with a list x."""
    return f"""select {keep}, e1 / (1 + e1 + e2) as h1, e2 / (1 + e1 + e2) as h2 from (select {keep}, exp(list_inner_product(z, b[1:p + 1])) as e1, exp(list_inner_product(z, b[p + 2:])) as e2
        from (select {keep}, list_append(list_transform(x, lambda v, i: (v - m[i]) / s[i]), 1e0) as z, p, b from {rows}, st, be))"""


HAZARDS["q5"] = _hazard_sql("q4", "loan_id, loan_age, prepaid_month, default_month")


@query("discrete_hazard_model", "select loan_age, count(*) as n, avg(h1) as h1, avg(h2) as h2, avg(prepaid_month) as observed1, avg(default_month) as observed2 from q5 group by 1",
       ("feat",), "h1 h2 observed1 observed2", extra=HAZARDS)
def _(v):
    x, model = _hazard_model(v)
    return model.hazards(x).groupBy("loan_age").agg(
        F.count("*").alias("n"), F.avg("h1").alias("h1"), F.avg("h2").alias("h2"),
        F.avg("prepaid_month").alias("observed1"), F.avg("default_month").alias("observed2"))


def _chain_sql(rows):
    one = "least(greatest({}, 1e-7), 1 - 1e-7)"
    return {"w1": f"select *, {one.format('h1')} as l1, {one.format('h2')} as l2 from {rows}",
            "w2": "select *, exp(coalesce(sum(ln(1 - l1) + ln(1 - l2)) over (partition by loan_id order by loan_age rows between unbounded preceding and 1 preceding), 0)) as sp from w1",
            "w3": """select *, sp * (1 - l1) * (1 - l2) as S, sum(l1 * sp) over w as cif1, sum(l2 * sp) over w as cif2 from w2
                window w as (partition by loan_id order by loan_age rows between unbounded preceding and current row)"""}


SENSITIVE = {**HAZARDS, **_chain_sql("(select * from q5 where loan_age < 60)"),
             "w4": "select *, max(cif1) over (partition by loan_id) - cif1 as rest from w3",
             "w5": """select loan_age, i, abs((sp - rest / (1 - h1)) * h1 * (b1 - mb) + (-rest / (1 - h2)) * h2 * (b2 - mb)) * sd as g from (
                 select *, h1 * b1 + h2 * b2 as mb from w4, (select unnest(range(1, p + 1)) as i, unnest(list_transform(range(1, p + 1), lambda i: b[i] / s[i])) as b1,
                 unnest(list_transform(range(1, p + 1), lambda i: b[p + 1 + i] / s[i])) as b2, unnest(list_transform(range(1, p + 1), lambda i: s[i] * sqrt((n - 1) / n::double))) as sd from st, be))"""}


@query("incidence_sensitivity", f"""select loan_age, {"[" + ", ".join(f"'{c}'" for c in HAZARD) + "]"}[i] as feature, count(*) as n, avg(g) as importance
    from w5 group by grouping sets ((loan_age, i), (i))""", ("feat",), "importance", digits=7, extra=SENSITIVE)
def _(v):
    x, model = _hazard_model(v)
    return model.incidence_sensitivity(model.hazards(x).select("loan_id", "loan_age", "h1", "h2"), 60, 1)


_ARC = " union all ".join(f"select '{n}' as loan_id, {a}::double as FICO, {b}::double as LTV, {r}::double as orig_rate, {d}::double as DTI, {u}::double as UPB" for n, a, b, r, d, u in K.ARCHETYPES)
ARCHETYPES = {
    **HAZARDS, "a0": _ARC,
    "a1": f"""select *, orig_rate - mortgage_rate as rate_incentive, 1 as LP_Purchase, 0 as LP_NoCashRefi, 0 as Occ_Investment, 0 as Occ_SecondHome, UPB / 1000e0 as UPB_k, orig_rate / 1200e0 as rm,
        exp(sum(ln(1 + coalesce(hpi_yoy, 0) / 1200e0)) over (partition by loan_id order by loan_age)) as hc
        from a0 cross join (select *, cast(row_number() over (order by yyyymm) - 1 as int) as loan_age from macro where yyyymm between 199601 and 200012) where loan_age < {K.SEQUENCE_MONTHS}""",
    "a2": """select * replace (coalesce(hpi_yoy, 0) as hpi_yoy, coalesce(mortgage_rate, 0) as mortgage_rate, coalesce(unemployment, 0) as unemployment, coalesce(rate_incentive, 0) as rate_incentive),
        least(greatest(LTV * least(greatest((pow(1 + rm, 360) - pow(1 + rm, loan_age)) / (pow(1 + rm, 360) - 1), 0), 1) / hc, 0), 200) as ELTV from a1""",
    "a3": _with_history("a2"),
    "a4": "select loan_id, loan_age, [" + ", ".join(f"{c}::double" for c in HAZARD) + "] as x from a3",
    "a5": _hazard_sql("a4", "loan_id, loan_age"), **_chain_sql("a5")}


@query("archetype_incidence", "select loan_id, loan_age, S, cif1, cif2 from w3", ("feat",), "S cif1 cif2", extra=ARCHETYPES)
def _(v):
    from ..operators.compete import incidence_rows

    x, model = _hazard_model(v)
    arc = P.archetype_paths(v.macro, 199601, 200012).withColumn("UPB_k", F.col("UPB") / 1000.0)
    arc, _ = M.history_features(arc.fillna(0.0), HISTORY)
    return incidence_rows(model.hazards(arc), "loan_id", "loan_age", "h1", "h2").select("loan_id", "loan_age", "S", "cif1", "cif2")


# --- exact splits ------------------------------------------------------------------------------
CODED = {"age_band": "cast(CreditScore // 20 as int)", "ltv_band": "cast(OriginalLoantoValueLTV // 5 as int)", "dti_band": "cast(OriginalDebttoIncomeRatio // 3 as int)",
         "rate_band": "cast(floor(OriginalInterestRate * 4) as int)", "upb_band": "cast(floor(OriginalUPB / 20000) as int)", "borrowers": "NumberofBorrowers", "year": "VintageYear"}
_GAIN = "round((2e0 * {e} * ({n} - {e}) / {n} - 2e0 * {l} * ({m} - {l}) / {m} - 2e0 * ({e} - {l}) * ({n} - {m} - ({e} - {l})) / ({n} - {m})) / {n}, 12)"


def _level_sql(rows, tag):
    """Best split of every node of `rows` (node, y, codes)."""
    return {f"cc{tag}": f"select node, feature, code, count(*) as n, sum(y) as e from (select node, y, unnest([{', '.join(repr(c) for c in CODED)}]) as feature, unnest([{', '.join(CODED)}]) as code from {rows}) group by 1, 2, 3",
            f"cr{tag}": f"""select *, sum(n) over (partition by node, feature) as tn, sum(e) over (partition by node, feature) as te, sum(n) over w as ln, sum(e) over w as le from cc{tag}
                window w as (partition by node, feature order by code nulls first rows between unbounded preceding and current row)""",
            f"cb{tag}": f"""select * from (select *, row_number() over (partition by node order by gain desc, feature, code) as r from (
                select *, {_GAIN.format(n='tn', e='te', m='ln', l='le')} as gain from cr{tag} where code is not null and ln >= 20 and tn - ln >= 20) where gain > 0) where r = 1"""}


TREE = {"k1": "select 1 as node, Target_T24::int as y, " + ", ".join(f"{e} as {c}" for c, e in CODED.items()) + " from targets where Target_T24 is not null",
        **_level_sql("k1", 1),
        "k2": "select k1.* replace (case when coalesce(list_extract([" + ", ".join(f"k1.{c}" for c in CODED) + "], list_position([" + ", ".join(repr(c) for c in CODED) + "], cb1.feature)) > cb1.code, false) then 3 else 2 end as node) from k1 join cb1 on k1.node = cb1.node",
        **_level_sql("k2", 2)}
_SPLIT = "cast(node as bigint) as node, feature, code, cast(tn as bigint) as n, cast(te as bigint) as events, cast(ln as bigint) as left_n, cast(le as bigint) as left_events, gain"


def _coded(v):
    return v.targets.selectExpr("cast(Target_T24 as int) as y", *[
        f"{e.replace('CreditScore // 20', 'CreditScore div 20').replace('OriginalLoantoValueLTV // 5', 'OriginalLoantoValueLTV div 5').replace('OriginalDebttoIncomeRatio // 3', 'OriginalDebttoIncomeRatio div 3')} as {c}"
        for c, e in CODED.items()])


@query("exact_stump", f"select 0 as depth, {_SPLIT} from cb1", ("targets",), "gain", extra=TREE)
def _(v):
    return trees.grow(_coded(v), list(CODED), "y", 1, 20)


@query("exact_tree", f"select 0 as depth, {_SPLIT} from cb1 union all select 1, {_SPLIT} from cb2", ("targets",), "gain", extra=TREE)
def _(v):
    return trees.grow(_coded(v), list(CODED), "y", 2, 20)


_SPLITS = {**TREE, "sp": "select feature, gain * tn as w from cb1 union all select feature, gain * tn from cb2"}


@query("tree_importance", "select feature, sum(w) / (select sum(w) from sp) as importance from sp group by 1", ("targets",), "importance", extra=_SPLITS)
def _(v):
    return trees.importance(trees.grow(_coded(v), list(CODED), "y", 2, 20))


@query("top_features", """select 'LogReg' as model, horizon, feature, importance, cast(rank as int) as rank from (select *, row_number() over (partition by horizon order by importance desc, feature) as rank from ("""
       + " union all ".join(f"select {h} as horizon, 'x' || i as feature, round(abs(b[i]), 5) as importance from (select unnest(range(1, p + 1)) as i from g{h}_st), g{h}_be" for h in V.HORIZONS)
       + ")) where rank <= 15", ("targets",), "importance", digits=5, extra=LOGITS)
def _(v):
    """The largest standardised slopes of the fitted logistic models; features by place in the design matrix."""
    train, _, feats = _frames(_staged(v), V.HORIZONS)
    _, rows = M.fit_horizons(train, feats, V.HORIZONS, "loan_key", ["LogReg"])
    last, cut = len(feats), 2 * len(_NUM)
    place = {f: i + 1 if i < cut else cut + 1 if i == last - 1 else i + 2 for i, f in enumerate(feats)}
    table = v.spark.createDataFrame([(m, h, f"x{place[f]}", round(imp, 5)) for m, h, f, imp, _ in rows], "model string, horizon int, feature string, importance double")
    return reports.top_features(table)


# --- classifiers and Cox side by side ------------------------------------------------------------
def _cox_beside(v):
    """Logistic and Cox predictions of the test loans; Cox is NULL where a covariate is missing."""
    from ..operators import cox

    x = _staged(v)
    wide, _, _ = _scored(x, ["LogReg"], V.HORIZONS)
    train, test = x.where("split = 'train'"), x.where("split = 'test'")
    enc = encode.fit_cox_encoder(train)
    model = cox.fit(encode.cox_features(train, enc), K.COX_COVARIATES, penalizer=0.001, label="Cox")
    right = cox.horizon_probabilities(encode.cox_features(test, enc), model, V.HORIZONS).select("loan_key", *[f"pred_Cox_T{h}" for h in V.HORIZONS])
    return reports.merge_predictions(wide, right, "loan_key")


from .catalog_models import COX_VIEW, _COX_RAW, _list  # noqa: E402
from .newton_sql import newton_lists  # noqa: E402

_FLAGS = COX_VIEW["c0"][COX_VIEW["c0"].index("cast(OriginalDebttoIncomeRatio is null"):COX_VIEW["c0"].rindex(" from surv")]
_COX_FIT = newton_lists("y0", 7, 0.001)
_RENAMED = {n: "z" + n for n in _COX_FIT}


def _renamed(text):
    import re

    return re.sub(r"\b(" + "|".join(sorted(_RENAMED, key=len, reverse=True)) + r")\b", lambda m: _RENAMED[m.group(1)], text)


BESIDE = {**LOGITS, "yd": f"select median(OriginalDebttoIncomeRatio) as md from surv where {TRAIN}",
          "y1": f"select *, coalesce(OriginalDebttoIncomeRatio, (select md from yd)) as dti, {_FLAGS} from surv",
          "y2": "select " + ", ".join(f"avg({c}) as m_{z}, stddev_samp({c}) as s_{z}" for z, c in _COX_RAW.items()) + f" from y1 where {TRAIN}",
          "y3": "select y1.*, " + ", ".join(f"({c} - m_{z}) / s_{z} as {z}" for z, c in _COX_RAW.items()) + " from y1, y2",
          "y0": f"select Duration as t, Event_Prepay as e, 1e0 as w, {_list(*K.COX_COVARIATES)} as x from y3 where {TRAIN} and FICO_z is not null and LTV_z is not null and Rate_z is not null",
          **{_RENAMED[n]: _renamed(q) for n, q in _COX_FIT.items()},
          # the baseline is taken at x = 0: shift by the means of the fit
          "yb": _renamed("select t, sum(wd / risk * exp(-sh)) over (order by t) as H0 from tt_7, (select list_inner_product(list_transform(b, lambda v, i: v / s[i]), m) as sh from be7, st)"),
          "yp": "select loan_key, " + ", ".join(f"1 - exp(-coalesce((select max(H0) from yb where t <= {h}), 0) * exp(eta)) as pred_Cox_T{h}" for h in V.HORIZONS) + " from ("
                + _renamed(f"select loan_key, case when FICO_z is not null and LTV_z is not null and Rate_z is not null then list_inner_product({_list(*K.COX_COVARIATES)}, list_transform(b, lambda v, i: v / s[i])) end as eta from y3, be7, st") + ")",
          "yl": " union all ".join(f"select model, {h} as horizon, y, p from lk where horizon = {h} union all select 'Cox', {h}, y, pred_Cox_T{h} from lk join yp using (loan_key) where horizon = {h} and pred_Cox_T{h} is not null" for h in V.HORIZONS)}


@query("prediction_metrics", metrics_sql("yl", "model, horizon"), ("targets",), FL, digits=5, extra=BESIDE)
def _(v):
    wide = _cox_beside(v)
    return metrics.binary_metrics(metrics.predictions_long(wide, ["LogReg", "Cox"], V.HORIZONS, ["loan_key"]), ["model", "horizon"])


@query("merge_predictions", f"select lg.loan_key, {', '.join(f'max(case when horizon = {h} then p end) as pred_LogReg_T{h}' for h in V.HORIZONS)}, {', '.join(f'max(pred_Cox_T{h}) as pred_Cox_T{h}' for h in V.HORIZONS)} from lg left join yp using (loan_key) group by 1",
       ("targets",), " ".join(f"pred_{m}_T{h}" for m in ("LogReg", "Cox") for h in V.HORIZONS), digits=5, extra=BESIDE)
def _(v):
    return _cox_beside(v).select("loan_key", *[f"pred_{m}_T{h}" for m in ("LogReg", "Cox") for h in V.HORIZONS])
