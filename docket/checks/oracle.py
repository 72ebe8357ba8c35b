"""SQL twins of the queries, for an engine that shares no code with Spark."""

from __future__ import annotations

from docket import constants as C

CATEGORICAL = ("cargo", "vt", "matricula", *[f"prova_{i}" for i in range(1, 9)])
NUMERIC = ("ultima_remuneracao", "tempo_cargo")
KEPT = ("cargo", "vt", "matricula", "ultima_remuneracao", "tempo_cargo", "prova_1", "prova_2", "prova_3", "prova_7")
NOMINAL = ("cargo", "vt", "prova_1", "prova_2", "prova_3", "prova_7")
BINNED = ("matricula", "ultima_remuneracao", "tempo_cargo")
FLAGS = tuple(f"prova_{i}" for i in range(1, 9))
FLAG_PARTS = (*CATEGORICAL, *NUMERIC)
KEEP = 4

CASES = """
a as (
  select l_orderkey, count(*) n_lines, count(*) filter (l_returnflag = 'R') n_r,
         count(*) filter (l_returnflag = 'A') n_a, min(l_shipdate) first_ship
  from lineitem group by l_orderkey),
cases as (
  select o_orderkey as codigo_processo, c_mktsegment as cargo,
    case when c_nationkey % 2 = 0 then 'True' when c_nationkey % 2 <> 0 then 'False' end as vt,
    cast(o_custkey as varchar) || '-' || cast(year(o_orderdate) as varchar) as matricula,
    case when c_acctbal >= 0 then c_acctbal end as ultima_remuneracao,
    cast(date_diff('day', o_orderdate, first_ship) as integer) as tempo_cargo,
    case when n_lines is null then 'INV' when n_r > 0 then 'SIM' else 'NÃO' end as prova_1,
    case when n_lines is null then 'INV' when n_a > 0 then 'SIM' else 'NÃO' end as prova_2,
    case when coalesce(n_lines, 0) >= 4 then 'SIM' else 'NÃO' end as prova_3,
    case when o_totalprice > 480000 then 'SIM' else 'NÃO' end as prova_4,
    case when n_lines is null then 'INV' else 'SIM' end as prova_5,
    'NÃO' as prova_6,
    case when o_orderpriority = '4-NOT SPECIFIED' then null
         when o_orderpriority in ('1-URGENT', '2-HIGH') then 'SIM' else 'NÃO' end as prova_7,
    case when o_orderkey in (3, 7, 11) then 'PARCIAL' when o_orderkey % 2 = 0 then 'SIM' else 'NÃO' end as prova_8,
    case when (coalesce(n_r, 0) > 0 and coalesce(n_lines, 0) >= 3) <> (o_orderkey % 10 = 0)
         then 'FAVORAVEL' else 'DESFAVORAVEL' end as resultado_processo
  from orders left join customer on o_custkey = c_custkey left join a on o_orderkey = l_orderkey),
labelled as (
  select *, case when resultado_processo = (select min(resultado_processo) from cases) then 0 else 1 end as label
  from cases),
ruled as (select *, case when prova_1 = 'SIM' then 1 else 0 end as prediction from labelled)"""


def q(body: str, *ctes: str) -> str:
    return f"with {', '.join([CASES, *ctes])} {body}"


def text(columns, *keep) -> str:
    return ", ".join([*keep, *[f"cast({c} as varchar) as {c}" for c in columns]])


def long(columns, *keep, source="labelled") -> str:
    """Rows (keep..., feature, value) with nulls kept."""
    return (
        f"select * from (select {text(columns, *keep)} from {source}) t "
        f"unpivot include nulls (value for feature in ({', '.join(columns)}))"
    )


def counts(columns, *by) -> str:
    groups = ", ".join(["feature", "value", *by])
    return f"counts as (select {groups}, count(*) as n from ({long(columns, *by)}) group by {groups})"


SCREEN = """
facts as (
  select feature, count(value) as n_distinct,
    cast(coalesce(sum(n) filter (value <> 'INV'), 0) as bigint) as n_valid,
    max(n) filter (value <> 'INV') as top_n, min(n) filter (value <> 'INV') as rarest_n,
    coalesce(bool_or(value = 'INV'), false) as has_inv, coalesce(bool_or(value = 'SIM'), false) as has_sim
  from counts group by feature),
screen as (
  select feature, n_distinct, n_valid, round(top_n / nullif(n_valid, 0), 6) as top_share, rarest_n,
    case when n_distinct = 0 then 'all_null' when n_distinct = 1 then 'constant'
         when n_distinct = 2 and has_inv then 'one_valid_value' when top_n / n_valid > 0.9 then 'dominant_value'
         when has_sim and rarest_n < 5 then 'rare_value' else 'keep' end as rule
  from facts)"""

FOLDS = """
folded as (
  select *, cast(ntile(10) over (partition by label order by md5(concat(codigo_processo, ':9'))) as integer) as fold,
    cast(ntile(5) over (partition by label order by md5(concat(codigo_processo, ':9'))) as integer) as fold5
  from ruled)"""


def uniform(expression: str) -> str:
    return f"(('0x' || substr(md5({expression}), 1, 8))::bigint / 4294967296.0::double)"


DUMMY = f"""
dummy as (
  select codigo_processo, label, draw,
    case when draw < (select avg(case when label = 0 then 1.0::double else 0 end) from labelled) then 0 else 1 end as prediction
  from (select codigo_processo, label, {uniform("concat(codigo_processo, ':dummy:9')")} as draw from labelled))"""


def sums(source: str, by: str = "") -> str:
    group = f"group by {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""
sums as (
  select {lead}count(*) filter (label = 0 and prediction = 0) h0, count(*) filter (label = 1 and prediction = 1) h1,
    count(*) filter (prediction = 0) s0, count(*) filter (prediction = 1) s1,
    count(*) filter (label = 0) t0, count(*) filter (label = 1) t1
  from {source} {group}),
scores as (
  select *, coalesce(h0 / nullif(t0, 0), 0) r0, coalesce(h1 / nullif(t1, 0), 0) r1, coalesce(h0 / nullif(s0, 0), 0) p0,
    coalesce(h1 / nullif(s1, 0), 0) p1, coalesce(2.0::double * h0 / nullif(s0 + t0, 0), 0) f0,
    coalesce(2.0::double * h1 / nullif(s1 + t1, 0), 0) f1, (h0 + h1) / (t0 + t1) acc
  from sums)"""


REPORT = """
select line, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1, cast(n as bigint) as support from (
  select '0' as line, p0 p, r0 r, f0 f, t0 n from scores
  union all select '1', p1, r1, f1, t1 from scores
  union all select 'accuracy', acc, acc, acc, t0 + t1 from scores
  union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, t0 + t1 from scores
  union all select 'weighted avg', (p0 * t0 + p1 * t1) / (t0 + t1), (r0 * t0 + r1 * t1) / (t0 + t1),
    (f0 * t0 + f1 * t1) / (t0 + t1), t0 + t1 from scores)"""


# Feature codes: nominal values by place, numerics by quantile bins of sixteen.
def _codes() -> str:
    return f"""
freq as (select matricula as m, count(*) as n from cases where matricula is not null group by matricula),
ready as (
  select l.codigo_processo, label, {", ".join(NOMINAL)}, coalesce(f.n, 0)::double as matricula,
    coalesce(ultima_remuneracao, (select avg(ultima_remuneracao) from cases))::double as ultima_remuneracao,
    coalesce(tempo_cargo::double, (select avg(tempo_cargo::double) from cases)) as tempo_cargo
  from labelled l left join freq f on l.matricula = f.m),
num as (
  select * from (select codigo_processo, {", ".join(BINNED)} from ready) t
  unpivot (x for feature in ({", ".join(BINNED)}))),
placed as (
  select feature, x, row_number() over (partition by feature order by x) as rn, count(*) over (partition by feature) as n
  from num),
cuts as (
  select distinct feature, x as cut
  from placed join (select unnest(range(1, 16)) / 16.0::double as p) on rn = greatest(ceil(n * p), 1)),
bins as (
  select codigo_processo, num.feature, cast(1 + count(cut) as integer) as code
  from num left join cuts on num.feature = cuts.feature and cut <= x group by codigo_processo, num.feature),
places as ({" union all ".join(f"select '{c}' as feature, value, row_number() over (order by value) as code from (select distinct {c} as value from cases where {c} is not null)" for c in NOMINAL)}),
nom as (
  select codigo_processo, v.feature, cast(coalesce(code, 0) as integer) as code
  from ({long(NOMINAL, "codigo_processo", source="cases")}) v
  left join places on v.feature = places.feature and v.value = places.value),
coded as (
  select codigo_processo, feature, code, label, fold5 as fold
  from (select * from nom union all select * from bins) join folded using (codigo_processo))"""


CODES = _codes()
MI = """
pairs as (select feature, code, label, count(*)::double as n from coded group by feature, code, label),
margins as (
  select feature, n, sum(n) over (partition by feature, code) as nx, sum(n) over (partition by feature, label) as ny,
    sum(n) over (partition by feature) as total from pairs),
info as (select feature, sum(n / total * ln(n * total / (nx * ny))) as mi from margins group by feature)"""

ODDS = """
cells as (select feature, code, fold, count(*) filter (label = 0) n0, count(*) filter (label = 1) n1 from coded group by feature, code, fold),
outside as (
  select c.feature, c.code, f.fold,
    coalesce(sum(n0) filter (c.fold <> f.fold), 0) n0, coalesce(sum(n1) filter (c.fold <> f.fold), 0) n1
  from cells c cross join (select unnest(range(1, 6)) as fold) f group by c.feature, c.code, f.fold),
odds as (
  select feature, code, fold,
    ln((n1 + 1.0::double) / (sum(n1) over w + count(*) over w)) - ln((n0 + 1.0::double) / (sum(n0) over w + count(*) over w)) as odds
  from outside window w as (partition by feature, fold)),
terms as (select codigo_processo, label, fold, feature, odds from coded join odds using (feature, code, fold)),
subsets as (
  select feature as subset, fold, label, odds as score from terms
  union all select 'all', fold, label, sum(odds) from terms group by codigo_processo, fold, label),
said as (select subset, fold, label, case when round(score, 9) > 0 then 1 else 0 end as prediction from subsets)"""

PARTS = f"""
shares as (
  select feature, value, count(*) filter (label = 0) n0, count(*) filter (label = 1) n1
  from ({long(FLAG_PARTS, "label")}) group by feature, value),
weights as (
  select feature, value,
    ln((n1 + 1.0::double) / (sum(n1) over w + count(*) over w)) - ln((n0 + 1.0::double) / (sum(n0) over w + count(*) over w)) as contribution
  from shares window w as (partition by feature)),
parts as (
  select codigo_processo, l.feature, l.value, contribution
  from ({long(FLAG_PARTS, "codigo_processo")}) l join weights w on l.feature = w.feature and l.value is not distinct from w.value),
totals as (
  select feature, value, count(*) as n, count(*) filter (contribution > 0) as n_pos,
    count(*) filter (contribution < 0) as n_neg, sum(abs(contribution)) as sum_abs
  from parts group by feature, value),
importance as (
  select row_number() over (order by importance desc, feature) as place, feature, importance
  from (select feature, sum(sum_abs) / sum(n) as importance from totals group by feature)),
pos as (select feature, value, row_number() over (partition by feature order by n_pos desc, value nulls first) r from totals where n_pos > 0),
neg as (select feature, value, row_number() over (partition by feature order by n_neg desc, value nulls first) r from totals where n_neg > 0),
favour as (
  select pos.feature, pos.value as value_pos, neg.value as value_neg
  from pos join neg on pos.feature = neg.feature where pos.r = 1 and neg.r = 1),
verdicts as (
  select *, case when value_pos = 'SIM' then 'Positivo' when value_pos in ('NÃO', 'INV') then 'Negativo' end as impact from favour),
proof as (
  select cast(row_number() over (order by place) as integer) as place, i.feature as provas,
    round(importance, 6) as value_importance, impact as impacto
  from importance i join verdicts v on i.feature = v.feature where i.feature like 'prova%')"""


def present(columns, marker: str) -> str:
    rows = " union all ".join(
        f"select '{c}' as feature, coalesce(bool_or(cast({c} as varchar) = '{marker}'), false) as present from cases" for c in columns
    )
    return rows


def _round_one() -> str:
    """One boosting cycle over the features in bin order, step after step."""
    names = [*NOMINAL, *BINNED]
    wide = ", ".join(f"max(code) filter (feature = '{n}') as c{i}" for i, n in enumerate(names))
    parts = [
        f"wide as (select codigo_processo, max(label) as y, {wide} from coded group by codigo_processo)",
        "s0 as (select *, ln((select sum(y)::double from wide) / (select sum(1 - y)::double from wide)) as s from wide)",
    ]
    for i, _ in enumerate(names):
        parts.append(
            f"t{i} as (select c{i} as code, 0.1::double * sum(y - p) / sum(p * (1 - p)) as score "
            f"from (select c{i}, y, 1.0::double / (1.0::double + exp(-s)) as p from s{i}) group by c{i})"
        )
        parts.append(f"s{i + 1} as (select s{i}.* exclude (s), s + score as s from s{i} join t{i} on c{i} = t{i}.code)")
    union = " union all ".join(f"select '{n}' as feature, code, score from t{i}" for i, n in enumerate(names))
    return q(f"select feature, code, round(score, 6) as score from ({union})", FOLDS, CODES, *parts)


def _forward(steps: int) -> str:
    """Greedy additions: every step adds each candidate's terms to the rows' running sum."""
    names = ", ".join(f"'{n}'" for n in (*NOMINAL, *BINNED))
    parts = ["b0 as (select distinct codigo_processo, fold, label, 0.0::double as s from terms)"]
    for i in range(1, steps + 1):
        taken = "".join(f" and feature <> (select feature from c{j})" for j in range(1, i))
        parts += [
            f"d{i} as (select feature, b.fold, b.label, case when round(s + odds, 9) > 0 then 1 else 0 end as prediction "
            f"from b{i - 1} b join terms t using (codigo_processo) where true{taken})",
            f"m{i} as (select feature, fold, "
            "2.0::double * count(*) filter (label = 0 and prediction = 0) / nullif(count(*) filter (label = 0) + count(*) filter (prediction = 0), 0) as f0, "
            "2.0::double * count(*) filter (label = 1 and prediction = 1) / nullif(count(*) filter (label = 1) + count(*) filter (prediction = 1), 0) as f1 "
            f"from d{i} group by feature, fold)",
            f"c{i} as (select feature, avg((coalesce(f0, 0) + coalesce(f1, 0)) / 2) as m from m{i} group by feature "
            f"order by round(m, 9) desc, list_position([{names}], feature) limit 1)",
            f"b{i} as (select b.codigo_processo, b.fold, b.label, s + odds as s from b{i - 1} b "
            f"join terms t using (codigo_processo) where feature = (select feature from c{i}))",
        ]
    union = " union all ".join(f"select {i} as step, feature, round(m, 6) as macro_f1 from c{i}" for i in range(1, steps + 1))
    return q(union, FOLDS, CODES, ODDS, *parts)


def _draws() -> str:
    rows = []
    for kind, space in C.SPACES.items():
        for name, law, low, high, step in space:
            u = uniform(f"concat(c_custkey, ':{name}:{C.SEED}')")
            if law == "loguniform":
                value = f"exp(ln({low}::double) + {u} * (ln({high}::double) - ln({low}::double)))"
            elif law == "quniform":
                value = f"round(({low}::double + {u} * {high - low}::double) / {step}::double) * {step}::double"
            else:
                value = f"{low}::double + {u} * ({high}::double - {low}::double)"
            rows.append(
                f"select c_custkey as trial, '{name}' as parameter, round({value}, 6) as value, '{kind}' as kind from customer"
            )
    return " union all ".join(rows)


def _vote() -> str:
    known = " union all ".join(f"select '{c}' as feature, count({c})::double as known from cases" for c in (*CATEGORICAL, *NUMERIC))
    bottom = "select feature from (select feature, row_number() over (order by {score} desc, feature) r from {table}) where r > {k}"
    lists = " union all ".join(
        bottom.format(score=s, table=t, k=KEEP)
        for s, t in (("mi", "info"), ("importance", "importance"), ("(-top_share)", "shares_top"), ("known", "known"))
    )
    shield = "(contains(feature, 'prova') or contains(feature, 'cargo')) and not contains(feature, 'tempo_cargo')"
    return q(
        f"select feature, count(*) as votes, any_value({shield}) as protected, "
        f"count(*) > 2 and not any_value({shield}) as removed from ({lists}) group by feature",
        FOLDS, CODES, MI, PARTS, counts(CATEGORICAL), SCREEN,
        "shares_top as (select feature, top_n / n_valid as top_share from facts)", f"known as ({known})",
    )


def _numbers(columns=NUMERIC) -> str:
    rows = ", ".join(f"cast({c} as double) as {c}" for c in columns)
    return f"num as (select * from (select {rows} from cases) t unpivot include nulls (x for feature in ({', '.join(columns)})))"


ALL = ("codigo_processo", *CATEGORICAL[:3], *NUMERIC, *FLAGS, "resultado_processo")
_quantiles = ", ".join(
    f"round(quantile_cont(x, {p}), 4) as {n}" for n, p in (("q05", 0.05), ("q25", 0.25), ("q50", 0.5), ("q75", 0.75), ("q95", 0.95))
)

def _views(folds: int) -> str:
    """The dictionary of rows ``t(feature, value, fold, y)``: view 0 of all rows, view k without fold k."""
    return f"""
w as (select feature, value, k, count(*) as n, count(*) filter (y) as n1
  from t join (select unnest(range({folds + 1})) as k) on fold <> k where value is not null group by all),
s as (select feature, k, sum(n1) / sum(n) as share from w group by all),
l as (select feature, value, k, n, least(floor((n1 + 10.0::double * share) / (n + 10.0::double) * 1024), 1023)::integer as level
  from w join s using (feature, k)),
m as (select feature, k, level, sum(n) as mass from l group by all),
c as (select feature, k, level, floor((sum(mass) over (partition by feature, k order by level) - mass) * 255
  / sum(mass) over (partition by feature, k)) as cut from m),
r as (select feature, k, level, cast(dense_rank() over (partition by feature, k order by cut) as integer) as code from c),
d as (select feature, value, k, n, code from l join r using (feature, k, level))"""


def _fold_encoding() -> str:
    numbers = " union all ".join(
        f"select codigo_processo, fold, '{c}' as feature, coalesce({c}::double, (select min({c}::double) - 1 from folded g where g.fold <> f.fold)) as x from folded f"
        for c in NUMERIC
    )
    cells = f"cells as ({long((*NOMINAL, 'matricula'), 'codigo_processo', 'fold', source='folded')})"
    return q(
        "select b.codigo_processo, b.fold, b.feature, case when b.feature = 'matricula' then coalesce(k.n, 0)::double "
        "else coalesce(k.code, z.known)::double end as x from cells b left join known k on k.feature = b.feature and k.value = b.value and k.fold = b.fold "
        "left join sizes z on z.feature = b.feature and z.fold = b.fold union all " + numbers,
        FOLDS,
        cells,
        "inside as (select feature, value, fold, count(*) as n from cells where value is not null group by all)",
        "total as (select feature, value, sum(n) as n from inside group by all)",
        "known as (select t.feature, t.value, f.fold, t.n - coalesce(i.n, 0) as n, row_number() over (partition by t.feature, f.fold order by t.value) - 1 as code "
        "from total t cross join (select unnest(range(1, 11)) as fold) f left join inside i on i.feature = t.feature and i.value = t.value and i.fold = f.fold "
        "where t.n > coalesce(i.n, 0))",
        "sizes as (select feature, fold, count(*) as known from known group by all)",
    )


ORACLE: dict[str, str] = {
    "scan_raw": q("select * replace (tempo_cargo::double as tempo_cargo) from cases"),
    "scan_prepared": q(f"select codigo_processo, {', '.join(KEPT)}, resultado_processo from (select * replace (tempo_cargo::double as tempo_cargo) from cases)"),
    "screened_table": q(f"select codigo_processo, {', '.join(KEPT)}, resultado_processo from (select * replace (tempo_cargo::double as tempo_cargo) from cases)"),
    "conform_schema": q("select codigo_processo, prova_3, cargo, tempo_cargo::double as tempo_cargo from cases"),
    "scores_round_trip": q("select codigo_processo, cargo, prediction as predict, 0.5::double as probability from ruled"),
    "model_lookup": """
        select name, stage, run_id, 'models/' || run_id as path from (
          select o_orderpriority as name, o_orderstatus as stage, cast(o_orderkey as varchar) as run_id,
            row_number() over (partition by o_orderpriority, o_orderstatus
                               order by o_orderdate desc, cast(o_orderkey as varchar) desc) as r from orders) where r = 1""",
    "run_names": "select o_orderkey as run, o_orderstatus || '_' || strftime(o_orderdate, '%Y-%m-%d_%H:%M:%S') as run_name from orders",
    "preview": q("select * replace (tempo_cargo::double as tempo_cargo) from cases order by codigo_processo limit 5"),
    "table_shape": q("select count(*) as n_rows, 15 as n_columns from cases"),
    "column_roles": q(
        " union all ".join(
            f"select '{c}' as feature, '{'key' if c == C.KEY else 'target' if c == C.TARGET else 'numeric' if c in NUMERIC else 'categorical'}' as role, "
            f"{str(c in FLAGS).lower()} as is_evidence, {str('cargo' in c).lower()} as is_job, count({c}) as n_known from cases"
            for c in ALL
        )
    ),
    "cast_types": q("select codigo_processo, vt, cast(tempo_cargo as double) as tempo, cast(tempo_cargo as varchar) as tempo_text from cases"),
    "packed_features": q("select codigo_processo, cargo, vt, prova_1, tempo_cargo::double as tempo_cargo from cases"),
    "unpacked_result": q("select codigo_processo, prova_1 as r0, prova_2 as r1, prova_7 as r2, cast(null as varchar) as r3 from cases"),
    "valid_values": q("select codigo_processo, prova_1 from cases where prova_1 <> 'INV'"),
    "value_present": q(
        f"select *, 'INV' as marker from ({present(ALL[1:], 'INV')}) union all select *, 'SIM' as marker from ({present(ALL[1:], 'SIM')})"
    ),
    "invalid_marker_columns": q(f"select feature from ({present(ALL, 'INV')}) where present"),
    "fill_missing": q(
        "select codigo_processo, coalesce(prova_7, 'Missing') as prova_7, "
        "round(coalesce(ultima_remuneracao, (select avg(ultima_remuneracao) from cases)), 6) as remuneracao, "
        "round(coalesce(tempo_cargo, (select quantile_cont(tempo_cargo::double, 0.5) from cases)), 6) as tempo from cases"
    ),
    "class_balance": q("select resultado_processo as value, count(*) as n from cases group by 1"),
    "contingency": q("select * from counts", counts(CATEGORICAL, "resultado_processo")),
    "distinct_values": q(
        "select feature, cast(sum(n) as bigint) as n_rows, count(value) as n_distinct, count(*) as n_distinct_with_null from counts group by feature",
        f"counts as (select feature, value, count(*) as n from ({long(ALL, source='cases')}) group by feature, value)",
    ),
    "column_modes": q(
        "select feature, value as mode, n as mode_n from (select *, row_number() over (partition by feature order by n desc, value) r "
        "from counts where value is not null) where r = 1",
        counts(CATEGORICAL),
    ),
    "column_centres": q(
        "select feature, round(avg(x), 6) as mean, round(quantile_cont(x, 0.5), 6) as median from num group by feature", _numbers()
    ),
    "crosstab_outcome": q("select prova_1, resultado_processo, count(*) as n from cases group by all"),
    "profile_numeric": q(
        "select feature, count(*) as n_rows, count(*) - count(x) as n_missing, count(distinct x) as n_distinct, "
        "count(*) filter (x = 0) as n_zeros, count(*) filter (x < 0) as n_negative, round(avg(x), 4) as mean, "
        "round(stddev_samp(x), 4) as std, round(min(x), 4) as min, round(max(x), 4) as max, round(max(x) - min(x), 4) as range, "
        "round(stddev_samp(x) / avg(x), 4) as cv, round(sum(x), 4) as total, round(skewness(x), 4) as skewness, "
        f"round(kurtosis(x), 4) as kurtosis, {_quantiles}, "
        "round(quantile_cont(x, 0.75) - quantile_cont(x, 0.25), 4) as iqr from num group by feature",
        _numbers(),
    ),
    "profile_categorical": q(
        "select feature, cast(sum(n) as bigint) as n_rows, cast(coalesce(sum(n) filter (value is null), 0) as bigint) as n_missing, "
        "count(value) as n_distinct, count(*) filter (value is not null and n = 1) as n_unique, "
        "arg_min(value, r) as top_value, max(n) filter (value is not null) as top_n, "
        "cast(min(length(value)) as integer) as min_length, cast(max(length(value)) as integer) as max_length, "
        "round(sum(length(value) * n) / sum(n) filter (value is not null), 6) as mean_length "
        "from (select *, case when value is not null then row_number() over (partition by feature order by value is null, n desc, value) end r from counts) group by feature",
        counts(CATEGORICAL),
    ),
    "frequent_values": q(
        "select feature, value, n, cast(r as integer) as place from (select *, row_number() over (partition by feature order by n desc, value) r "
        "from counts where value is not null) where r <= 10",
        counts(CATEGORICAL),
    ),
    "histogram": q(
        "select feature, cast(bin as integer) as bin, round(low + bin * w, 6) as bin_start, count(*) as n from "
        "(select feature, low, w, least(floor((x - low) / w), 9) as bin from num join ends using (feature) where x is not null) group by all",
        _numbers(),
        "ends as (select feature, min(x) as low, (max(x) - min(x)) / 10 as w from num group by feature)",
    ),
    "duplicate_rows": q(
        "select cast(sum(n) as bigint) as n_rows, count(*) as n_distinct_rows, count(*) filter (n > 1) as n_repeated, "
        f"cast(sum(n - 1) as bigint) as n_duplicates from (select count(*) as n from cases group by {', '.join((C.KEY, *CATEGORICAL, *NUMERIC, C.TARGET))})"
    ),
    "low_variance_screen": q("select *, rule <> 'keep' as dropped from screen", counts(CATEGORICAL), SCREEN),
    "explore_job": q(
        "select *, rule <> 'keep' as dropped from screen",
        f"counts as (select feature, value, count(*) as n from ({long(ALL, source='cases')}) group by feature, value)",
        SCREEN,
    ),
    "low_variance_all_columns": q(
        "select *, rule <> 'keep' as dropped from screen",
        f"counts as (select feature, value, count(*) as n from ({long(ALL, source='cases')}) group by feature, value)",
        SCREEN,
    ),
    "screen_rules": q(
        "select feature, rule, rule <> 'keep' as dropped from screen",
        f"counts as (select feature, value, count(*) as n from ({long(ALL, source='cases')}) group by feature, value)",
        SCREEN,
    ),
    "high_card_columns": q(
        "select feature, count(value) / sum(n) > 0.3 as high_card from counts group by feature", counts(CATEGORICAL)
    ),
    "future_from_csv": q(
        f"select {C.KEY}, {', '.join(c for c in CATEGORICAL)}, ultima_remuneracao, cast(tempo_cargo as double) as tempo_cargo "
        f"from cases where {C.KEY} % 5 = 0"
    ),
    "high_cardinality": q(
        "select feature, cast(sum(n) as bigint) as n_rows, count(value) as n_distinct, round(count(value) / sum(n), 6) as ratio, "
        "count(value) / sum(n) > 0.3 as high_card from counts group by feature",
        counts(CATEGORICAL),
    ),
    "feature_difference": q(
        "select feature from screen except select feature from screen where rule <> 'keep'", counts(CATEGORICAL), SCREEN
    ),
    "label_encode": q(
        "select feature, value, cast(row_number() over (partition by feature order by value) - 1 as integer) as code "
        f"from (select distinct feature, coalesce(value, 'Missing') as value from ({long((*CATEGORICAL, C.TARGET), source='cases')}))"
    ),
    "category_codes": q(
        "select feature, value, case when value is null then -1 else cast(row_number() over (partition by feature order by value nulls last) - 1 as integer) end as code, n from counts",
        counts(CATEGORICAL),
    ),
    "frequency_encode": q(
        "select codigo_processo, coalesce(m.n, 0)::double as matricula_n, coalesce(p.n, 0)::double as prova_7_n from cases "
        "left join (select matricula as v, count(*) as n from cases group by 1) m on matricula = m.v "
        "left join (select prova_7 as v, count(*) as n from cases group by 1) p on prova_7 = p.v"
    ),
    "mean_impute": q(
        "select codigo_processo, round(coalesce(ultima_remuneracao, (select avg(ultima_remuneracao) from cases)), 6) as ultima_remuneracao_filled, "
        "round(coalesce(tempo_cargo, (select avg(tempo_cargo::double) from cases)), 6) as tempo_cargo_filled from cases"
    ),
    "feature_codes": q(
        "select codigo_processo, "
        + ", ".join(f"max(code) filter (feature = '{n}') as {n}" for n in (*NOMINAL, *BINNED))
        + " from coded group by codigo_processo",
        FOLDS,
        CODES,
    ),
    "class_weights": q(
        "select label, count(*) as n, round((select count(*) from labelled) / (2 * count(*)), 6) as weight from labelled group by label"
    ),
    "stratified_folds": q("select codigo_processo, label, fold, fold5 from folded", FOLDS),
    "oof_coverage": q("select codigo_processo, fold, label, true as scored from folded", FOLDS),
    "attribution_gaps": q("select codigo_processo, true as additive from cases"),
    "scored_files": q(
        f"select codigo_processo, cargo, true as scored, {sum(c in FLAGS for c in KEPT)}::integer as evidence_rows from cases where codigo_processo % 5 = 0"
    ),
    "fold_encoding": _fold_encoding(),
    "target_codes": "with t as ("
    + " union all ".join(
        f"select '{c}' as feature, {c}::varchar as value, l_linenumber % 3 + 1 as fold, l_returnflag = 'R' as y from lineitem"
        for c in ("l_partkey", "l_suppkey", "l_linestatus")
    )
    + "), "
    + _views(3)
    + " select feature, value, max(n) filter (k = 0) as rows, max(code) filter (k = 0) as code, "
    + ", ".join(f"max(code) filter (k = {k}) as without_{k}" for k in (1, 2, 3))
    + " from d group by feature, value",
    "wide_codes": q(
        "select codigo_processo, fold, coalesce(code, 0)::double as peca from t left join d on d.value = t.value and d.k = t.fold",
        FOLDS,
        "first_line as (select l_orderkey as codigo_processo, min(struct_pack(a := l_linenumber, b := l_partkey)).b::varchar as value from lineitem group by 1)",
        "t as (select 'peca' as feature, codigo_processo, value, fold5 as fold, label = 1 as y from folded left join first_line using (codigo_processo))",
        _views(5),
    ),
    "oversample": q(
        "select codigo_processo, label, cast(unnest(range(1, copies + 1)) as integer) as copy from "
        "(select codigo_processo, label, largest // n + case when r <= largest % n then 1 else 0 end as copies from sized)",
        "sized as (select codigo_processo, label, n, max(n) over () as largest, r from (select codigo_processo, label, "
        "count(*) over (partition by label) as n, row_number() over (partition by label order by md5(concat(codigo_processo, ':9'))) as r from labelled))",
    ),
    "oversample_labels": """
        select doc_id, lang, quality, cast(largest // n + case when r <= largest % n then 1 else 0 end as integer) as copies from (
          select *, max(n) over () as largest from (
            select doc_id, lang, quality, count(*) over (partition by quality) as n,
              row_number() over (partition by quality order by md5(concat(doc_id, ':9'))) as r
            from labels join documents using (doc_id)))""",
    "dummy_baseline": q(REPORT, DUMMY, sums("dummy")),
    "dummy_draws": q("select codigo_processo, round(draw, 9) as draw, prediction from dummy", DUMMY),
    "confusion_metrics": q(
        "select round(r0, 6) as recall_class0, round(r1, 6) as recall_class1, round(p0, 6) as precision_class0, "
        "round(p1, 6) as precision_class1, round(f0, 6) as f1_class0, round(f1, 6) as f1_class1, round(acc, 6) as accuracy, "
        "round((f0 + f1) / 2, 6) as macro_f1 from scores",
        sums("ruled"),
    ),
    "classification_report": q(REPORT, sums("ruled")),
    "macro_f1": q(
        "select round(avg((f0 + f1) / 2), 6) as macro_f1, 'fold' as average from scores union all "
        "select round((2.0::double * sum(h0) / (sum(s0) + sum(t0)) + 2.0::double * sum(h1) / (sum(s1) + sum(t1))) / 2, 6), 'pooled' from scores",
        FOLDS,
        sums("folded", "fold5"),
    ),
    "mutual_information": q("select feature, round(mi, 6) as mi from info", FOLDS, CODES, MI),
    "top_k_features": q(
        f"select feature, round(mi, 6) as mi, cast(r as integer) as place from (select *, row_number() over (order by mi desc, feature) r from info) where r <= {KEEP}",
        FOLDS, CODES, MI,
    ),
    "bottom_features": q(
        f"select feature, round(mi, 6) as mi, cast(r as integer) as place from (select *, row_number() over (order by mi desc, feature) r from info) where r > {KEEP}",
        FOLDS, CODES, MI,
    ),
    "selector_vote": _vote(),
    "subset_scores": q(
        "select subset, round(avg((f0 + f1) / 2), 6) as macro_f1 from scores group by subset", FOLDS, CODES, ODDS, sums("said", "subset, fold")
    ),
    "forward_step": q(
        "select 1 as step, subset as feature, round(m, 6) as macro_f1 from (select subset, avg((f0 + f1) / 2) as m from scores where subset <> 'all' group by subset) order by m desc limit 1",
        FOLDS, CODES, ODDS, sums("said", "subset, fold"),
    ),
    "forward_selection": _forward(KEEP),
    "trial_tables": _draws(),
    "best_trial": """
        select brand, trial, macro_f1 from (
          select p_brand as brand, p_partkey as trial, p_retailprice as macro_f1,
            row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as r from part) where r = 1""",
    "naive_scores": q(
        "select codigo_processo, case when p1 > 0.5 then 1 else 0 end as predict, round(greatest(p1, 1 - p1), 6) as probability from "
        "(select codigo_processo, 1.0::double / (1.0::double + exp(-round(sum(contribution), 9))) as p1 from parts group by codigo_processo)",
        PARTS,
    ),
    "additive_round1": _round_one(),
    "attribution_totals": q("select feature, value, n, n_pos, n_neg, round(sum_abs, 6) as sum_abs from totals", PARTS),
    "global_importance": q("select cast(place as integer) as place, feature, round(importance, 6) as importance from importance", PARTS),
    "favourable_value": q("select feature, value_pos, value_neg from favour", PARTS),
    "impact_label": q(
        f"select feature, value_pos, present as has_invalid, impact from verdicts join ({present(FLAGS, 'INV')}) using (feature)", PARTS
    ),
    "impact_by_code": q(
        "select feature, value, code, case when code = 2 then 'Positivo' when code = 0 then 'Negativo' when code = 1 and present then 'Negativo' "
        "when code = 1 then 'Positivo' end as impact, present as has_invalid from (select feature, value, cast(row_number() over (partition by feature order by value) - 1 as integer) as code "
        f"from (select distinct feature, value from ({long(FLAGS, source='cases')}) where value is not null)) join ({present(FLAGS, 'INV')}) using (feature)"
    ),
    "evidence_table": q("select * from proof", PARTS),
    "evidence_text_round_trip": q("select * from proof", PARTS),
    "evidence_per_row": q(
        "select codigo_processo, (select provas from proof where place = 1) as first_feature, (select impacto from proof where place = 1) as first_impact from cases",
        PARTS,
    ),
}
