"""SQL text of fits, written out as common table expressions and used only to check the library's:
Cox fits with two covariates, and Cox and logistic fits with any number of covariates held in a
list column, where each Newton step is solved by elimination on a list of lists."""

from __future__ import annotations


def _sums(k: int, rows: str, cumulative: bool) -> dict[str, str]:
    terms = {"a": "r", "b1": "r * z1", "b2": "r * z2", "c11": "r * z1 * z1", "c12": "r * z1 * z2", "c22": "r * z2 * z2"}
    inner = f"select t, e, w, z1, z2, w * exp(p1 * z1 + p2 * z2) as r from {rows}, be{k}"
    agg = ", ".join(f"sum({x}) as {n}_, sum(case when e = 1 then {x} else 0 end) as e{n}" for n, x in terms.items())
    extra = ("sum(case when e = 1 then w else 0 end) as wd, count(*) filter (e = 1) as d, "
             "sum(case when e = 1 then w * z1 else 0 end) as g1, sum(case when e = 1 then w * z2 else 0 end) as g2")
    out = {f"s{k}": f"select t, {agg}, {extra} from ({inner}) group by t"}
    over = "over (order by t rows between current row and unbounded following)" if cumulative else "over (partition by t)"
    out[f"k{k}"] = "select *, " + ", ".join(f"sum({n}_) {over} as {n}" for n in terms) + f" from s{k}"
    return out


def _total(k: int, ties: str, risk: str | None = None) -> dict[str, str]:
    f = "l / d::double" if ties == "efron" else "0e0"
    per = f"""select x.*, {f} as f, a - f * ea as phi from {risk or f'k{k}'} x, unnest(range(0, d)) u(l) where d > 0"""
    m1, m2 = "(b1 - f * eb1)", "(b2 - f * eb2)"
    q = f"""select t, max(wd / d) as wbar, max(g1) as g1, max(g2) as g2, max(d) as d, max(wd) as wd, max(a) as a, sum(ln(phi)) as lp,
        sum({m1} / phi) as n1, sum({m2} / phi) as n2,
        sum((c11 - f * ec11) / phi - {m1} * {m1} / (phi * phi)) as v11, sum((c12 - f * ec12) / phi - {m1} * {m2} / (phi * phi)) as v12,
        sum((c22 - f * ec22) / phi - {m2} * {m2} / (phi * phi)) as v22 from ({per}) group by t"""
    return {f"m{k}": q, f"l{k}": f"""select sum(g1 * p1 + g2 * p2 - wbar * lp) as loglik, sum(g1 - wbar * n1) as u1, sum(g2 - wbar * n2) as u2,
        sum(wbar * v11) as i11, sum(wbar * v12) as i12, sum(wbar * v22) as i22, sum(d) as n_events from m{k}, be{k}"""}


def newton(rows: str, steps: int = 7, penalizer: float = 0.0, ties: str = "efron", cumulative: bool = True,
           prefix: str = "") -> dict[str, str]:
    """CTEs ending in be<steps> (standardised coefficients), l<steps> (likelihood there) and
    `fit` (covariate position, coef, se). `rows` names a CTE with t, e, w, x1, x2."""
    out = {"st": f"select count(*) as n, avg(x1) as m1, avg(x2) as m2, stddev_samp(x1) as s1, stddev_samp(x2) as s2 from {rows}",
           "zz": f"select t, e, w, (x1 - m1) / s1 as z1, (x2 - m2) / s2 as z2 from {rows}, st",
           "be0": "select 0e0 as p1, 0e0 as p2"}
    for k in range(steps + 1):
        out.update(_sums(k, "zz", cumulative))
        out.update(_total(k, ties))
        if k < steps:
            rho = f"({penalizer!r} * n)"
            out[f"be{k + 1}"] = f"""select p1 + (j22 * y1 - i12 * y2) / det as p1, p2 + (j11 * y2 - i12 * y1) / det as p2 from (
                select p1, p2, i12, i11 + {rho} as j11, i22 + {rho} as j22, u1 - {rho} * p1 as y1, u2 - {rho} * p2 as y2,
                (i11 + {rho}) * (i22 + {rho}) - i12 * i12 as det from l{k}, be{k}, st)"""
    rho = f"({penalizer!r} * n)"
    out["fin"] = f"""select p1 / s1 as b1, p2 / s2 as b2, j22 / det / (s1 * s1) as var1, j11 / det / (s2 * s2) as var2, -i12 / det as cov, j22 / det as sv1, j11 / det as sv2,
        loglik, n, n_events, m1, m2, s1, s2, p1, p2 from (
        select *, i11 + {rho} as j11, i22 + {rho} as j22, (i11 + {rho}) * (i22 + {rho}) - i12 * i12 as det from l{steps}, be{steps}, st)"""
    if prefix:
        import re

        names = sorted(out, key=len, reverse=True)
        pat = re.compile(r"\b(" + "|".join(names) + r")\b")
        out = {prefix + n: pat.sub(lambda m: prefix + m.group(1), q) for n, q in out.items()}
    return out


def coef_rows(names: tuple[str, str], fin: str = "fin") -> str:
    z = "1.959963984540054e0"
    one = "select '{n}' as covariate, b{i} as coef, sqrt(var{i}) as se from {fin}"
    base = " union all ".join(one.format(n=n, i=i, fin=fin) for i, n in enumerate(names, 1))
    return (f"select covariate, coef, exp(coef) as hazard_ratio, se, coef - {z} * se as coef_lower, coef + {z} * se as coef_upper, "
            f"exp(coef - {z} * se) as hr_lower, exp(coef + {z} * se) as hr_upper, coef / se as z from ({base})")


# --- any number of covariates: rows hold them in a list x ----------------------------------------------
def _eliminated(matrix: str) -> str:
    """Gauss-Jordan on `matrix` (one row: m, a list of p rows of p + q numbers); gives m with the unit matrix in front."""
    return f"""with recursive g(k, m) as (select 1, m from {matrix} union all
        select k + 1, list_transform(m, lambda r, i: case when i = k then list_transform(r, lambda v: v / r[k])
            else list_transform(r, lambda v, j: v - r[k] / m[k][k] * m[k][j]) end) from g where k <= len(m))
        select m from g where k > len(m)"""


def _standardised(rows: str, more: str = "") -> dict[str, str]:
    return {"st": f"""select list(m order by i) as m, list(s order by i) as s, max(n) as n, count(*) as p from (select i, avg(v) as m, coalesce(nullif(stddev_samp(v), 0), 1) as s, count(*) as n
                from (select unnest(x) as v, generate_subscripts(x, 1) as i from {rows}) group by i)""",
            "ij": "select i, j from (select p, unnest(range(1, p + 1)) as i from st), lateral (select unnest(range(i, p + 1)) as j)",
            "zz": f"select t, e, w{more}, list_transform(x, lambda v, i: (v - m[i]) / s[i]) as z from {rows}, st"}


def _cox_sums(tag: str, rows: str, beta: str, cumulative: bool, ties: str, competing: bool) -> dict[str, str]:
    """Month sums a (risk), v (first) and q (second moments) of `rows` at `beta`, and the tie sums tt."""
    over = "over (partition by {} order by t desc)" if cumulative else "over (partition by {}, t)"
    f = "l / d::double" if ties == "efron" else "0e0"
    moment = {"a": ("1 as one", "r", "w"), "v": ("i", "r * y", "w * y"), "q": ("i, j", "r * y", "w * y")}
    out = {f"r{tag}": f"select *, w * exp(list_inner_product(z, b)) as r from {rows}, {beta}"}
    source = {"a": f"(select *, 1 as one from r{tag})", "v": f"(select t, e, w, r{', c' if competing else ''}, unnest(z) as y, generate_subscripts(z, 1) as i from r{tag})",
              "q": f"(select t, e, w, r{', c' if competing else ''}, z[i] * z[j] as y, i, j from r{tag}, ij)"}
    for name, (_, r, w) in moment.items():
        keys = {"a": "one", "v": "i", "q": "i, j"}[name]
        late = f", sum(case when c = 1 then {r} else 0 end) as c_" if competing else ""
        out[f"{name}0{tag}"] = f"""select t, {keys}, sum({r}) as s_, sum(case when e = 1 then {r} else 0 end) as es, sum(case when e = 1 then {w} else 0 end) as g,
            count(*) filter (e = 1) as d{late} from {source[name]} group by t, {keys}"""
        if competing:  # exits by the other cause stay with weight G(t) / G(s)
            out[f"{name}1{tag}"] = f"""select x.*, gg.G * coalesce(sum(case when gg.G > 0 then c_ / gg.G else 0 end) over (partition by {keys} order by x.t rows between unbounded preceding and 1 preceding), 0)
                + sum(s_) over (partition by {keys} order by x.t desc) as s from {name}0{tag} x join gg on gg.t = x.t"""
        else:
            out[f"{name}1{tag}"] = f"select *, sum(s_) {over.format(keys)} as s from {name}0{tag}"
    out[f"tt{tag}"] = f"""select t, max(g / d) as wbar, max(d) as d, max(g) as wd, max(s) as risk, sum(ln(phi)) as s0, sum(1 / phi) as s1, sum(f / phi) as f1, sum(1 / (phi * phi)) as q,
        sum(f / (phi * phi)) as g1, sum(f * f / (phi * phi)) as g2 from (select *, {f} as f, s - {f} * es as phi from a1{tag} x, unnest(range(0, d)) u(l) where d > 0) group by t"""
    out[f"ll{tag}"] = f"""select (select sum(g * b[i]) from v1{tag}, {beta}) - (select sum(wbar * s0) from tt{tag}) as loglik, (select sum(d) from tt{tag})::bigint as n_events"""
    return out


def _cox_step(tag: str, ridge: str, beta: str) -> dict[str, str]:
    return {f"u{tag}": f"select i, sum(g - wbar * (s1 * s - f1 * es)) as u from v1{tag} join tt{tag} using (t) group by i",
            f"h{tag}": f"""select i, j, sum(wbar * (s1 * c.s - f1 * c.es - (q * x.s * y.s - g1 * (x.s * y.es + x.es * y.s) + g2 * x.es * y.es))) as h
                from q1{tag} c join tt{tag} k on k.t = c.t join v1{tag} x on x.t = c.t and x.i = c.i join v1{tag} y on y.t = c.t and y.i = c.j group by c.i, c.j""".replace("select i, j,", "select c.i, c.j,"),
            **_solved(tag, ridge, beta)}


def _solved(tag: str, ridge: str, beta: str) -> dict[str, str]:
    """hr: rows of the ridged information; be<next> and, for the variance, in: its inverse."""
    return {f"hr{tag}": f"""select i, list(h + case when i = j then {ridge} else 0 end order by j) as r from (select i, j, h from h{tag} union all select j, i, h from h{tag} where i <> j), st group by i""",
            f"mm{tag}": f"select list(list_append(r, u - {ridge} * b[x.i]) order by x.i) as m from hr{tag} x join u{tag} y on x.i = y.i, {beta}, st"}


def newton_lists(rows: str, steps: int = 7, penalizer: float = 0.0, ties: str = "efron", cumulative: bool = True,
                 competing: bool = False, validation: str | None = None) -> dict[str, str]:
    """CTEs of a Cox fit on `rows` (t, e, w, x; with `competing` also c, and a table gg of t, G): ends in coefs
    (i, b, se) and ll<k>; with `validation` rows, vl<k> holds their likelihood at step k."""
    ridge = f"({penalizer!r} * n)"
    out = {**_standardised(rows, ", c" if competing else ""), "be0": "select list_transform(range(0, p), lambda i: 0e0) as b from st"}
    if validation:
        out["zv"] = f"select t, e, w, list_transform(x, lambda v, i: (v - m[i]) / s[i]) as z from {validation}, st"
    for k in range(steps + 1):
        out.update(_cox_sums(f"_{k}", "zz", f"be{k}", cumulative, ties, competing))
        out.update(_cox_step(f"_{k}", ridge, f"be{k}"))
        if validation:
            out.update(_cox_sums(f"_v{k}", "zv", f"be{k}", cumulative, ties, False))
        if k < steps:
            out[f"so{k}"] = _eliminated(f"mm_{k}")
            out[f"be{k + 1}"] = f"select list_transform(b, lambda v, i: v + m[i][len(m) + 1]) as b from be{k}, so{k}"
    out.update(_variance(f"_{steps}", f"be{steps}"))
    return out


def _variance(tag: str, beta: str, name: str = "coefs") -> dict[str, str]:
    return {f"un{name}": f"select list(list_concat(r, list_transform(range(1, p + 1), lambda j: case when j = i then 1e0 else 0e0 end)) order by i) as m from hr{tag}, st",
            f"in{name}": _eliminated(f"un{name}"),
            name: f"select i, b[i] / st.s[i] as b, sqrt(v.m[i][len(v.m) + i]) / st.s[i] as se from (select unnest(range(1, p + 1)) as i from st), st, {beta}, in{name} v"}


def prefixed(ctes: dict[str, str], prefix: str) -> dict[str, str]:
    """The same CTEs under other names, for two fits in one query."""
    import re

    pattern = re.compile(r"\b(" + "|".join(sorted(ctes, key=len, reverse=True)) + r")\b")
    return {prefix + n: pattern.sub(lambda m: prefix + m.group(1), q) for n, q in ctes.items()}


def list_coef_rows(names, coefs: str = "coefs") -> str:
    z = "1.959963984540054e0"
    label = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    return (f"select {label}[i] as covariate, b as coef, exp(b) as hazard_ratio, se, b - {z} * se as coef_lower, b + {z} * se as coef_upper, "
            f"exp(b - {z} * se) as hr_lower, exp(b + {z} * se) as hr_upper, b / se as z from {coefs}")


# --- logistic fits: rows hold the class y and a list x ---------------------------------------------------
def newton_logit(rows: str, ridge: str = "1e0", classes: int = 2, steps: int = 10, prefix: str = "") -> dict[str, str]:
    """CTEs of a logistic fit with an intercept: {prefix}st (means m, deviations s, n, p) and {prefix}be, the
    list b of (classes - 1) blocks of p slopes on scaled features and an intercept. `ridge` is SQL over st."""
    e = prefix
    m, q = classes - 1, "(p + 1)"
    out = {f"{e}st": f"""select list(m order by i) as m, list(s order by i) as s, max(n) as n, count(*) as p from (select i, avg(v) as m, coalesce(nullif(stddev_samp(v), 0), 1) as s, count(*) as n
               from (select unnest(x) as v, generate_subscripts(x, 1) as i from {rows}) group by i)""",
           f"{e}zz": f"select y, list_append(list_transform(x, lambda v, i: (v - m[i]) / s[i]), 1e0) as z from {rows}, {e}st",
           f"{e}ij": f"select i, j from (select p, unnest(range(1, {q} + 1)) as i from {e}st), lateral (select unnest(range(i, {q} + 1)) as j)",
           # intercepts start at the log-odds of the classes
           f"{e}be0": "select " + ("list_concat(" * (m - 1)) + ", ".join(
               f"list_append(list_transform(range(0, p), lambda i: 0e0), ln(c{a + 1} / c0))" + (")" if a else "") for a in range(m))
           + f" as b from {e}st, (select " + ", ".join(f"count(*) filter (y = {a})::double as c{a}" for a in range(classes)) + f" from {rows})"}
    for k in range(steps):
        score = ", ".join(f"exp(list_inner_product(z, b[{a} * {q} + 1:{a + 1} * {q}])) as e{a}" for a in range(m))
        total = " + ".join(f"e{a}" for a in range(m))
        out[f"{e}r{k}"] = f"select y, z, [{', '.join(f'e{a} / (1 + {total})' for a in range(m))}] as p_ from (select y, z, {score} from {e}zz, {e}be{k}, {e}st)"
        out[f"{e}u{k}"] = f"""select a * {q} + i as i, u from (select a, i, sum(v * (case when y = a + 1 then 1 else 0 end - p_[a + 1])) as u from (
            select y, p_, unnest(z) as v, generate_subscripts(z, 1) as i from {e}r{k}), (select unnest(range(0, {m})) as a) group by a, i), {e}st"""
        pairs = [(a, b) for a in range(m) for b in range(a, m)]
        weight = {(a, b): f"p_[{a + 1}] * ({int(a == b)} - p_[{b + 1}])" for a, b in pairs}
        out[f"{e}hp{k}"] = "select i, j, " + ", ".join(f"sum(y * {w}) as h{a}{b}" for (a, b), w in weight.items()) + f" from (select p_, i, j, z[i] * z[j] as y from {e}r{k}, {e}ij) group by i, j"
        out[f"{e}h{k}"] = " union all ".join([f"select {a} * {q} + i as i, {b} * {q} + j as j, h{a}{b} as h from {e}hp{k}, {e}st" for a, b in pairs]
                                             + [f"select {a} * {q} + j, {b} * {q} + i, h{a}{b} from {e}hp{k}, {e}st where i < j" for a, b in pairs if a < b])
        free = f"case when (i - 1) % {q} = p then 0e0 else {ridge} end"
        out[f"{e}hr{k}"] = f"""select i, list(h + case when i = j then {free} else 0e0 end order by j) as r from (select i, j, h from {e}h{k} union all select j, i, h from {e}h{k} where i <> j), {e}st group by i"""
        out[f"{e}mm{k}"] = f"""select list(list_append(r, u - w * b[i]) order by i) as m from (select x.i, r, u, b, {free.replace('(i - 1)', '(x.i - 1)')} as w from {e}hr{k} x join {e}u{k} y on x.i = y.i, {e}be{k}, {e}st)"""
        out[f"{e}so{k}"] = _eliminated(f"{e}mm{k}")
        out[f"{e}be{k + 1}"] = f"select list_transform(b, lambda v, i: v + m[i][len(m) + 1]) as b from {e}be{k}, {e}so{k}"
    out[f"{e}be"] = f"select b from {e}be{steps}"
    return out
