"""The same results in plain SQL, for an independent engine.

Written against the star-schema tables, with joins and one-statement windows
where the Spark side aggregates: the two share input constants, not logic.
"""

from __future__ import annotations

from ledgerwave.plans.standins import ACCOUNTS, CURRENT, PRIOR, SECURITY_KINDS
from ledgerwave.plans import feature_sets as fs
from ledgerwave.sources import schemas as sc

# --- small builders ----------------------------------------------------------


def digits10(key: str) -> str:
    return f"lpad(cast({key} as varchar), 10, '0')"


def cnpj(key: str) -> str:
    d = digits10(key)
    return (
        f"({d}[1:4] || '.' || {d}[5:7] || '.' || {d}[8:10] || '/0001-' || "
        f"lpad(cast({key} % 97 as varchar), 2, '0'))"
    )


def cnpj_digits(key: str) -> str:
    return f"({digits10(key)} || '0001' || lpad(cast({key} % 97 as varchar), 2, '0'))"


def rnd(expr: str, digits: int, name: str) -> str:
    r = f"round({expr}, {digits})"
    return f"case when {r} = 0 then 0.0 else {r} end as {name}"


def text_or_null(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("'", "''") + "'"


def picked(kind: str, part: int) -> str:
    cases = []
    for company_kind, accounts in enumerate(ACCOUNTS[kind]):
        values = ", ".join(text_or_null(a[part]) for a in accounts)
        index = (
            "case when l_linenumber = 1 then 1 "
            f"else 2 + (l_partkey + l_linenumber) % {len(accounts) - 1} end"
        )
        cases.append(f"when {company_kind} then (cast([{values}] as varchar[]))[{index}]")
    return f"case l_suppkey % 4 {' '.join(cases)} end"


def lines(kind: str, annual: bool) -> str:
    """Raw statement lines; dates already typed."""
    y, q = "year(l_shipdate)", "quarter(l_shipdate)"
    end = f"last_day(make_date({y}, {'12' if annual else q + ' * 3'}, 1))"
    odd = "l_discount >= 0.09"
    start = (
        f"make_date({y}, case when {odd} then 7 else 1 end, 1)" if annual
        else f"make_date({y}, case when {odd} then 1 else {q} * 3 - 2 end, 1)"
    )
    return f"""
      select {cnpj('l_suppkey')} as cnpj_cia, {end} as dt_refer,
        'Companhia ' || l_suppkey as denom_cia, {digits10('l_suppkey')} as cd_cvm,
        case when l_linestatus = 'O' then 'MIL' else 'UNIDADE' end as escala_moeda,
        case when l_returnflag = 'R' then '{PRIOR}' else '{CURRENT}' end as ordem_exerc,
        {start} as dt_ini_exerc, {end} as dt_fim_exerc,
        {picked(kind, 0)} as cd_conta, {picked(kind, 1)} as ds_conta,
        case when l_tax = 0.08 and l_linenumber = 6 then null when l_quantity = 1 then 0.0
          when l_linenumber % 3 = 2 then -l_extendedprice else l_extendedprice end as vl_conta
      from lineitem {'' if annual else 'where ' + q + ' < 4'}"""


STOP_WORDS = ["e", "de", "do", "dos", "da", "das", "por"]


def drop_words(expr: str, by: str) -> str:
    for w in STOP_WORDS:
        expr = f"regexp_replace({expr}, '\\s+{w}\\s+', '{by}', 'g')"
    return f"regexp_replace({expr}, '\\s+', '_', 'g')"


def plain(expr: str) -> str:
    return f"regexp_replace({expr}, '[,.\\\\()/&]', '', 'g')"


def ascii_text(expr: str) -> str:
    return f"strip_accents(replace({expr}, 'ß', 'ss'))"


def slug(expr: str) -> str:
    return drop_words(plain(ascii_text(f"lower(trim({expr}))")), "")


def slug_spaced(expr: str) -> str:
    return f"lower({drop_words(plain(ascii_text(f'lower({expr})')), ' ')})"


SCALED = "case when escala_moeda = 'MIL' then vl_conta * 1000 else vl_conta end"


def clean(kind: str, annual: bool) -> str:
    months = "datediff('month', dt_ini_exerc, dt_fim_exerc) + 1"
    length = f"and {months} = {12 if annual else 3}" if kind == "income" else ""
    label = "coalesce(ds_conta, '')" if kind == "income" else "ds_conta"
    return f"""
      select cd_cvm, cnpj_cia, denom_cia, dt_refer, dt_ini_exerc, dt_fim_exerc,
        cast(year(dt_refer) as integer) as dt_year, cast(quarter(dt_refer) as integer) as dt_quarter,
        trim(cd_conta) as c, {slug(label)} as l, {SCALED} as v
      from ({lines(kind, annual)}) where ordem_exerc = '{CURRENT}' {length}"""


TYPE_CASE = {
    "income": """case when c = '3.01' and l = 'receitavendabens_eou_servicos' then 'type_01'
        when c = '3.01' and l = 'receitasintermediacao_financeira' then 'type_02'
        when c = '3.01' and l = 'receitasoperacoes' then 'type_03' end""",
    "assets": """case when c = '1.01' and l = 'ativo_circulante' then 'type_01'
        when c = '1.01' and l = 'caixaequivalentescaixa' then 'type_02'
        when c = '1.01.01' and l = 'caixaequivalentescaixa' then 'type_03' end""",
    "liabilities": """case when c = '2.01' and l = 'passivo_circulante' then 'type_01'
        when c = '2.01' and l = 'passivos_financeiros_ao_valor_justo_atravesresultado'
          then 'type_02'
        when c = '2.02.01' and l = 'passivo_exigivel_a_longo_prazo' then 'type_03' end""",
}


def at(types: str, code: str) -> str:
    """Condition: one of the numbered types, and the code."""
    names = ", ".join(f"'type_0{t}'" for t in types)
    return f"(t in ({names}) and c = '{code}')"


INCOME_WHEN = {
    "amt_sales_revenue": at("1", "3.01") + " or (t = 'type_03' and ((l = 'receitasoperacoes' and "
    "v <> 0) or l = 'outras_receitasdespesas_operacionais'))",
    "amt_cost_goods_and_services": at("1", "3.02")
    + " or (t = 'type_03' and l like '%custoservicos\\_prestados%' escape '\\')",
    "amt_groos_revenue": at("1", "3.03"),
    "amt_operating_revenues_and_expenses": at("12", "3.04"),
    "amt_selling_expenses": at("1", "3.04.01"),
    "amt_general_administrative_expenses": at("1", "3.04.02"),
    "amt_losses_non_recoverability_of_assets": at("1", "3.04.03"),
    "amt_other_operating_income": at("1", "3.04.04"),
    "amt_other_operating_expenses": at("1", "3.04.05"),
    "amt_equity_equivalence": at("1", "3.04.06") + " or c = '3.06'",
    "amt_earnings_before_interest_and_taxes": at("1", "3.05")
    + " or (t = 'type_03' and contains(l, 'resultado_antesresultado_financeirodos_tributos'))",
    "amt_financial_results": at("1", "3.06"),
    "amt_financial_income": at("1", "3.06.01"),
    "amt_financial_expenses": at("1", "3.06.02"),
    "amt_earnings_before_income_tax_and_social_contribution": at("1", "3.07") + " or "
    + at("2", "3.05")
    + " or (t = 'type_03' and contains(l, 'resultado_antestributos_sobre_o_lucro'))",
    "amt_income_tax_social_contribution_on_profit": at("1", "3.08") + " or " + at("2", "3.06")
    + " or (t = 'type_03' and l = 'impostorendacontribuicao_social_sobre_o_lucro')",
    "amt_net_profit": at("1", "3.11")
    + " or (t = 'type_02' and l = 'lucroprejuizo_consolidadoperiodo')"
    + " or (t = 'type_03' and contains(l, 'lucroprejuizo_consolidadoperiodo'))",
    "amt_financial_intermediation_income": at("2", "3.01"),
    "amt_financial_intermediation_expenses": at("2", "3.02"),
    "amt_gross_income_financial_intermediation": at("2", "3.03"),
}
ASSETS_WHEN = {
    "amt_total_assets": at("123", "1"),
    "amt_current_assets": at("13", "1.01"),
    "amt_cash_and_cash_equivalents": at("13", "1.01.01") + " or " + at("2", "1.01"),
    "amt_non_current_assets": at("13", "1.02"),
    "amt_finantial_assets": at("2", "1.02"),
    "amt_investments": at("13", "1.02.02") + " or " + at("2", "1.05"),
    "amt_immobilized": at("13", "1.02.03") + " or " + at("2", "1.06"),
    "amt_intangible": at("1", "1.02.04") + " or " + at("2", "1.07"),
}
LIABILITIES_WHEN = {
    "amt_total_liabilities": at("123", "2"),
    "amt_current_liabilities": at("13", "2.01"),
    "amt_non_current_liabilities": at("13", "2.02"),
    "amt_loans_financing": at("1", "2.02.01"),
    "amt_net_equity": at("13", "2.03") + " or " + at("2", "2.07"),
    "amt_provisions": at("2", "2.03"),
    "amt_long_term_liabilities": at("3", "2.02.01"),
}
CASH_WHEN = {
    "amt_net_cash_operating_activities": "id_account = '6.01'",
    "amt_depreciation_amortization": "regexp_matches(txt, 'depreciacao|depreciacoes')",
    "amt_net_cash_investment_activities": "id_account = '6.02'",
    "amt_net_cash_financing_activities": "id_account = '6.03'",
    "amt_exchange_variation_without_cash_equivalents": "id_account = '6.04'",
    "amt_increase_in_cash_equivalents": "id_account = '6.05'",
    "amt_final_balance_cash_equivalents": "id_account = '6.05.02'",
}
WHEN = {"income": INCOME_WHEN, "assets": ASSETS_WHEN, "liabilities": LIABILITIES_WHEN}


def money_sum(condition: str, value: str, name: str) -> str:
    return (
        f"cast(sum(case when {condition} then cast({value} as decimal(20,2)) end) as double) "
        f"as {name}"
    )


def typed(kind: str, annual: bool, ) -> str:
    """Cleaned lines, repeated for every type their company-period matches."""
    keys = ["cd_cvm", "cnpj_cia", "denom_cia", "dt_refer", "dt_fim_exerc", "dt_year", "dt_quarter"]
    if kind == "income":
        keys.append("dt_ini_exerc")
    return f"""
      with cl as ({clean(kind, annual)}),
      ty as (select distinct {', '.join(keys)}, t from
        (select *, {TYPE_CASE[kind]} as t from cl) where t is not null)
      select cl.*, ty.t from cl left join ty using ({', '.join(keys)})"""


NAMES = (
    "cd_cvm as id_cvm, regexp_replace(cnpj_cia, '[./-]', '', 'g') as id_cnpj, "
    "denom_cia as txt_company_name"
)


def wide(kind: str, annual: bool) -> str:
    start = "dt_ini_exerc, " if kind == "income" else ""
    sums = ",\n        ".join(money_sum(w, "v", n) for n, w in WHEN[kind].items())
    return f"""
      select {NAMES}, dt_refer, {start}dt_fim_exerc, dt_year, dt_quarter, t as cat_type_dre,
        {sums}
      from ({typed(kind, annual)})
      group by cd_cvm, cnpj_cia, denom_cia, dt_refer, {start}dt_fim_exerc, dt_year, dt_quarter, t"""


def filings(annual: bool) -> str:
    return f"""
      select cnpj_cia, denom_cia, cd_cvm, dt_fim_exerc, cd_conta, ds_conta, ordem_exerc,
        cast(sum(cast(vl_conta as decimal(20,2))) as double) as vl_conta,
        max(escala_moeda) as escala_moeda
      from ({lines('cash_flow', annual)})
      group by cnpj_cia, denom_cia, cd_cvm, dt_fim_exerc, cd_conta, ds_conta, ordem_exerc"""


def flow_lines(annual: bool) -> str:
    return f"""
      select {NAMES}, dt_fim_exerc, cast(year(dt_fim_exerc) as integer) as dt_year,
        cast(quarter(dt_fim_exerc) as integer) as dt_quarter, cd_conta as id_account,
        ds_conta as txt_account, cast({SCALED} as decimal(20,2)) as a
      from ({filings(annual)}) where ordem_exerc = '{CURRENT}'"""


def flow_annual() -> str:
    keys = "id_cvm, id_cnpj, txt_company_name, dt_fim_exerc, dt_year, dt_quarter"
    sums = ", ".join(money_sum(w, "a", n) for n, w in CASH_WHEN.items())
    txt = f"lower({ascii_text('txt_account')})"
    return f"""
      select {keys}, {sums}
      from (select *, coalesce({txt}, '') as txt from ({flow_lines(True)})) group by {keys}"""


def flow_accounts() -> str:
    """Quarters joined on all account keys, first quarter leading."""
    keys = "id_cvm, id_cnpj, txt_company_name, dt_year, id_account, txt_account"
    part = "\n".join(
        f", q{q} as (select {keys}, a from al where dt_quarter = {q})" for q in (1, 2, 3, 4)
    )
    return f"""
      with al as ({flow_lines(False)} union all {flow_lines(True)}) {part}
      select id_cvm, id_cnpj, txt_company_name, dt_year, id_account,
        {slug_spaced("coalesce(txt_account, '')")} as txt_account,
        q1.a as a1, q2.a - q1.a as a2, q3.a - q2.a as a3, q4.a - q3.a as a4
      from q1 left join q2 using ({keys}) left join q3 using ({keys}) left join q4 using ({keys})"""


def flow_quarterly(end: str) -> str:
    keys = "id_cvm, id_cnpj, txt_company_name, dt_year"
    parts = []
    for q in (1, 2, 3, 4):
        sums = ", ".join(
            money_sum(w.replace("txt", "txt_account"), f"a{q}", n) for n, w in CASH_WHEN.items()
        )
        parts.append(
            f"select {keys}, cast({q} as integer) as dt_quarter, {sums} from acc group by {keys}"
        )
    amounts = ", ".join(CASH_WHEN)
    return f"""
      with acc as ({flow_accounts()})
      select id_cvm, id_cnpj, txt_company_name, {end} as dt_fim_exerc, dt_year, dt_quarter, {amounts}
      from ({' union all '.join(parts)})"""


OWN_YEAR = "last_day(make_date(dt_year, dt_quarter * 3, 1))"
PINNED = "last_day(make_date(2022, dt_quarter * 3, 1))"

# --- prices ------------------------------------------------------------------

PRICES = f"""
  select dt_date, {cnpj_digits('l_suppkey')} as id_cnpj, id_ticker, floor(pq / q) as amt_adj_close,
    floor(pq / q) + 1 as amt_close, hi as amt_high, lo as amt_low, floor(sp / n) as amt_open,
    q as qty_volume, tax * 50 as amt_dividends
  from (select cast(l_shipdate as date) as dt_date, l_suppkey, id_ticker, sum(p * l_quantity) as pq,
      sum(l_quantity) as q, sum(p) as sp, count(*) as n, max(p) as hi, min(p) as lo,
      max(l_tax) as tax
    from (select *, floor(l_extendedprice * 100 / l_quantity) as p,
        'TK' || l_suppkey || case when l_suppkey % 5 = 0 and l_partkey % 2 = 0 then '4' else '3' end
          as id_ticker
      from lineitem)
    group by 1, 2, 3)"""

BARS = f"""
  select id_cnpj, id_ticker as ticker, dt_date as date, cast(year(dt_date) as integer) as dt_year,
    cast(quarter(dt_date) as integer) as dt_quarter, amt_adj_close as adj_close,
    amt_high as high_price, amt_low as low_price,
    amt_adj_close - amt_high as amplitude_close_high_price
  from ({PRICES})"""

PERIOD_END = f"""
  select id_cnpj, id_ticker, dt_year, dt_quarter, dt_date, amt_adj_close, amt_dividends
  from (select id_cnpj, id_ticker, cast(year(dt_date) as integer) as dt_year,
      cast(quarter(dt_date) as integer) as dt_quarter, dt_date, amt_adj_close, amt_dividends
    from ({PRICES}))
  join (select id_cnpj, id_ticker, max(dt_date) as dt_date from ({PRICES})
    group by id_cnpj, id_ticker, year(dt_date), quarter(dt_date))
  using (id_cnpj, id_ticker, dt_date)"""


class Windows:
    """SQL of the window features over one entity and order."""

    def __init__(self, keys: str, order: str, mean_digits: int = 6):
        self.spec = f"partition by {keys} order by {order}"
        self.mean_digits = mean_digits

    def over(self, call: str, n: int, last: str = "current row") -> str:
        end = last if last == "current row" else "1 preceding"
        return f"{call} over ({self.spec} rows between {n} preceding and {end})"

    def lag(self, v: str, n: int) -> str:
        return f"lag({v}, {n}) over ({self.spec})"

    def change(self, v: str, n: int) -> str:
        before = self.lag(v, n)
        return f"(({v}) - {before}) / nullif(abs({before}), 0)"

    def pct(self, v: str, n: int, span: str) -> str:
        return rnd(self.change(v, n), 6, f"pct_tx_{v}_{span}")

    def moving(self, v: str, n: int, measure: str) -> str:
        call, digits = {
            "avg": ("avg", self.mean_digits), "std": ("stddev_samp", 1), "var": ("var_samp", -3),
            "min": ("min", None), "max": ("max", None),
        }[measure]
        expr, name = self.over(f"{call}({v})", n), f"amt_{measure}_{v}_{n}"
        return f"{expr} as {name}" if digits is None else rnd(expr, digits, name)

    def broke(self, v: str, n: int, kind: str, sign: str = ">", suffix: str = "") -> str:
        bound = self.over(f"{'max' if kind == 'high' else 'min'}({v})", n, "before")
        return (
            f"case when {v} {sign} {bound} then 1 else 0 end as cat_{v}_broke_{kind}_{n}{suffix}"
        )


def beta_sql(source: str, w: Windows, wanted: list[tuple[str, int]], keep: str) -> str:
    """Three steps: lag, the two means, the ratio."""
    variables = list(dict.fromkeys(v for v, _ in wanted))
    lags = ", ".join(f"{w.lag(v, 1)} as y_{v}" for v in variables)
    means = ", ".join(
        f"{w.over(f'avg(y_{v})', n)} as ym_{v}_{n}, {w.over(f'avg({v})', n)} as xm_{v}_{n}"
        for v, n in wanted
    )
    ratios = ", ".join(
        rnd(
            f"(({v} - xm_{v}_{n}) * ({v} - ym_{v}_{n})) / "
            f"nullif(({v} - xm_{v}_{n}) * ({v} - xm_{v}_{n}), 0)",
            6, f"amt_beta_{v}_{n + 1}",
        )
        for v, n in wanted
    )
    return f"""
      select {keep}, {ratios} from (select *, {means} from (select *, {lags} from ({source})))"""


def ifr_sql(source: str, w: Windows, v: str, periods: list[int], keep: str) -> str:
    means = ", ".join(f"{w.over(f'avg({v})', n, 'before')} as m_{n}" for n in periods)
    signed = ", ".join(
        f"case when c > 0 then coalesce(m_{n}, 0) else 0 end as up_{n}, "
        f"case when c < 0 then coalesce(m_{n}, 0) else 0 end as dn_{n}" for n in periods
    )
    totals = ", ".join(
        f"{w.over(f'sum(up_{n})', n, 'before')} as u_{n}, "
        f"{w.over(f'sum(dn_{n})', n, 'before')} as d_{n}" for n in periods
    )
    values = ", ".join(
        rnd(f"100 - 100 / nullif(1 + u_{n} / nullif(d_{n}, 0), 0)", 4, f"amt_IFR_{v}_{n}")
        for n in periods
    )
    return f"""
      select {keep}, {values} from (select *, {totals} from (select *, {signed} from
        (select *, {w.change(v, 1)} as c, {means} from ({source}))))"""


BAR_W = Windows("id_cnpj, ticker", "date")
BAR_KEYS = "id_cnpj, ticker, date, adj_close"


def on_bars(*features: str) -> str:
    return f"select {BAR_KEYS}, {', '.join(features)} from ({BARS})"


ALL_BARS = (
    "id_cnpj, ticker, date, dt_year, dt_quarter, adj_close, high_price, low_price, "
    "amplitude_close_high_price"
)


def features_1() -> str:
    w = BAR_W
    moves = [
        w.moving("adj_close", n, m)
        for n in fs.MOVING_PERIODS for m in ("avg", "std", "min", "max")
    ]
    changes = [
        w.pct(v, n, f"{n}d")
        for v in ("adj_close", "high_price", "low_price", "amplitude_close_high_price")
        for n in fs.MOVING_PERIODS
    ]
    return f"select {ALL_BARS}, {', '.join(moves + changes)} from ({BARS})"


def features_2() -> str:
    w = BAR_W
    breaks = [w.broke(v, n, "high") for v in ("adj_close", "high_price") for n in fs.BREAK_PERIODS]
    breaks += [w.broke(v, n, "low") for v in ("adj_close", "low_price") for n in fs.BREAK_PERIODS]
    betas = beta_sql(BARS, w, [("adj_close", n) for n in fs.BETA_PERIODS],
                     "id_cnpj, ticker, date")
    strength = ifr_sql(BARS, w, "adj_close", fs.STRENGTH_PERIODS, "id_cnpj, ticker, date")
    return f"""
      select * from (select {ALL_BARS}, {', '.join(breaks)} from ({BARS}))
      join ({betas}) using (id_cnpj, ticker, date)
      join ({strength}) using (id_cnpj, ticker, date)"""


def statement_features() -> str:
    w = Windows("id_cvm", "dt_year nulls first, dt_quarter nulls first", mean_digits=4)
    vs = fs.STATEMENT_VARIABLES
    out = []
    for v in vs:
        out += [f"{w.lag(v, 1)} as amt_tot_{v}_1m_lag", f"{w.lag(v, 4)} as amt_tot_{v}_1y_lag",
                w.pct(v, 1, "1m"), w.pct(v, 4, "1y")]
        out += [w.moving(v, n, m) for n in fs.STATEMENT_RUNS for m in ("avg", "std")]
    base = f"select id_cvm, dt_year, dt_quarter, {', '.join(vs)} from ({income_union()})"
    betas = beta_sql(
        base, w, [(v, n) for v in vs for n in fs.STATEMENT_BETAS], "id_cvm, dt_year, dt_quarter"
    )
    return f"""
      select f.*, b.* exclude (id_cvm, dt_year, dt_quarter)
      from (select *, {', '.join(out)} from ({base})) f
      join ({betas}) b on f.id_cvm = b.id_cvm and f.dt_year = b.dt_year
        and f.dt_quarter is not distinct from b.dt_quarter"""


# --- quarters ----------------------------------------------------------------

DAY = "date '2024-01-31'"
IDS = "id_cvm, id_cnpj, txt_company_name, dt_year"


def complete() -> str:
    return f"""
      select distinct id_cvm, dt_year from (
        select {IDS} from ({wide('income', False)}) group by {IDS} having count(*) = 3)
      where (id_cvm, dt_year) in (select (id_cvm, dt_year) from ({wide('income', True)}))"""


def last_quarter() -> str:
    amounts = list(INCOME_WHEN)
    sums = ", ".join(
        f"cast(sum(cast({a} as decimal(20,2))) as double) as {a}" for a in amounts
    )
    negated = ", ".join(f"-{a} as {a}" for a in amounts)
    cols = ", ".join(amounts)
    return f"""
      with itr as ({wide('income', False)}), dfp as ({wide('income', True)}), yes as ({complete()}),
      parts as (
        select {IDS}, cat_type_dre, {cols} from dfp join yes using (id_cvm, dt_year)
        union all
        select {IDS}, cat_type_dre, {negated} from itr join yes using (id_cvm, dt_year)),
      q4 as (select {IDS}, cat_type_dre, {sums} from parts group by {IDS}, cat_type_dre)
      select id_cvm, id_cnpj, txt_company_name, dt_refer, dt_ini_exerc, dt_fim_exerc, dt_year,
        dt_quarter, cat_type_dre, {cols} from itr
      union all
      select q4.id_cvm, q4.id_cnpj, q4.txt_company_name, dfp.dt_refer, dfp.dt_ini_exerc,
        dfp.dt_fim_exerc, q4.dt_year, dfp.dt_quarter, q4.cat_type_dre,
        {', '.join('q4.' + a for a in amounts)}
      from q4 left join dfp using (id_cvm, id_cnpj, txt_company_name, dt_year, cat_type_dre)"""


def last_quarter_legacy() -> str:
    amounts = sc.LEGACY_QUARTER_AMOUNTS
    cols = ", ".join(amounts)
    sums = ", ".join(f"cast(sum(cast({a} as decimal(20,2))) as double) as {a}" for a in amounts)
    dates = "dt_refer, dt_ini_exerc, dt_fim_exerc, dt_quarter"
    return f"""
      with itr as ({wide('income', False)}), dfp as ({wide('income', True)}),
      parts as (
        select {IDS}, {dates}, {cols} from dfp
        union all
        select {IDS}, null, null, null, null, {', '.join('-' + a for a in amounts)} from itr)
      select {DAY} as processed_at, {IDS}, {dates}, {cols} from itr
      union all
      select {DAY}, {IDS}, max(dt_refer), max(dt_ini_exerc), max(dt_fim_exerc), max(dt_quarter),
        {sums}
      from parts group by {IDS}"""


LEGACY_COLUMNS = [
    "processed_at", "id_cvm", "id_cnpj", "txt_company_name", "dt_year", "dt_refer", "dt_ini_exerc",
    "dt_fim_exerc", "dt_quarter", *sc.LEGACY_QUARTER_AMOUNTS,
]


def income_union(legacy: bool = False) -> str:
    first = "id_cnpj, dt_refer, dt_ini_exerc, dt_fim_exerc"
    columns = LEGACY_COLUMNS if legacy else sc.INCOME_KEYS + sc.INCOME_AMOUNTS
    rest = [c for c in columns if c not in first.split(", ")]
    order = ", ".join(f"{c} nulls first" for c in rest)
    return f"""
      select {', '.join(columns)} from (
        select *, count(id_cnpj) over (partition by id_cnpj, dt_year, dt_quarter
          order by dt_fim_exerc nulls first) as running
        from (select *, row_number() over (partition by {first} order by {order}) as rn
          from ({last_quarter_legacy() if legacy else last_quarter()})) where rn = 1)
      where running = 1"""


FILINGS = """
  select case when l_suppkey % 10 <> 0 then l_suppkey end as id_cnpj,
    cast(year(l_shipdate) as integer) as dt_year, cast(quarter(l_shipdate) as integer) as dt_quarter,
    case when l_discount > 0 then cast(l_shipdate as date) + cast(l_linenumber % 2 as integer) end
      as dt_fim_exerc,
    l_partkey, l_extendedprice
  from lineitem"""

# --- integration -------------------------------------------------------------

PERIOD = "id_cvm, id_cnpj, txt_company_name, dt_year, dt_quarter, dt_fim_exerc"


def joined(annual: bool) -> str:
    flow = flow_annual() if annual else flow_quarterly(OWN_YEAR)
    both = f"{PERIOD}, cat_type_dre"
    return f"""
      with i as ({wide('income', annual)}), a as ({wide('assets', annual)}),
        p as ({wide('liabilities', annual)}), f as ({flow})
      select {both}, {', '.join([*INCOME_WHEN, *ASSETS_WHEN, *LIABILITIES_WHEN, *CASH_WHEN])}
      from i left join a using ({both}) left join p using ({both}) left join f using ({PERIOD})"""


EBT = "amt_earnings_before_income_tax_and_social_contribution"
EQ = "amt_equity_equivalence"
EBIT = f"({EBT} + abs(amt_financial_expenses))"
TAX = (
    f"(abs(amt_income_tax_social_contribution_on_profit) / nullif(abs({EBT}) + abs({EQ}), 0) "
    f"* {EBIT})"
)
PROFIT = ", ".join([
    rnd(EBIT, 2, "ebit_amplo"),
    rnd(f"{TAX} + {EQ}", 2, "provisao_ircs_ampla"),
    rnd(f"{EBIT} - ({TAX} + {EQ})", 2, "nopat_amplo"),
    rnd(f"{EBIT} - amt_financial_income + {EQ}", 2, "ebit_restrit"),
    rnd(TAX, 2, "provisao_ircs_restrita"),
])


def integrated(annual: bool) -> str:
    missing = ", ".join(f"cast(null as double) as {c}" for c in sc.UNSUPPLIED_AMOUNTS)
    have = [c for c in sc.FUNDAMENTALS_COLUMNS if c not in sc.UNSUPPLIED_AMOUNTS]
    have = ["f.id_cnpj" if c == "id_cnpj" else c for c in have]
    have = ["cast(dt_fim_exerc as varchar) as dt_fim_exerc" if c == "dt_fim_exerc" else c for c in have]
    return f"""
      select {', '.join(have)}, {missing}, {PROFIT}
      from ({joined(annual)}) f left join ({PERIOD_END}) p
        on f.id_cnpj = p.id_cnpj and f.dt_year = p.dt_year and f.dt_quarter = p.dt_quarter"""


def qualify(sql: str) -> str:
    """The period comes from the statement side of the price join."""
    return sql.replace("cat_type_dre, dt_year, dt_quarter, cast(dt_fim",
                       "cat_type_dre, f.dt_year, f.dt_quarter, cast(dt_fim")


COVERAGE = {
    "type_01": ["3.01", "3.02", "3.03", "3.04", "3.05", "3.06", "3.07", "3.08", "3.11", "3.04.01",
                "3.04.02", "3.04.03", "3.04.04", "3.04.05", "3.04.06", "3.06.01", "3.06.02"],
    "type_02": ["3.01", "3.02", "3.03", "3.04", "3.05", "3.06", "3.11"],
    "type_03": ["outras_receitasdespesas_operacionais", "^receitasoperacoes$",
                "custoservicos_prestados", "resultado_antesresultado_financeirodos_tributos",
                "resultado_antestributos_sobre_o_lucro",
                "^impostorendacontribuicao_social_sobre_o_lucro$",
                "lucroprejuizo_consolidadoperiodo", "3.05", "3.06"],
}


def coverage() -> str:
    values = ", ".join(f"('{t}', '{i}')" for t, items in COVERAGE.items() for i in items)
    key = "cd_cvm || '|' || dt_ini_exerc"
    return f"""
      with tl as ({typed('income', False)}),
      want(t, id_account) as (values {values}),
      n as (select dt_year, dt_quarter, t, count(distinct {key}) as n_companies
        from tl where t is not null group by all)
      select dt_year, dt_quarter, t as cat_type_dre, n_companies, id_account,
        (select count(distinct {key}) from tl where tl.t = n.t and tl.dt_year = n.dt_year
          and tl.dt_quarter = n.dt_quarter and case when regexp_matches(want.id_account, '^[0-9]')
            then tl.c = want.id_account else regexp_matches(tl.l, want.id_account) end)
          as n_reporting
      from n join want using (t)"""


# --- quotes ------------------------------------------------------------------

QUOTES = """
  select cast(cast(o_orderdate as date) as varchar) as date, o_orderstatus as ticker_list,
    max_by(o_totalprice, o_orderkey) as adj_close, max_by(o_totalprice, o_orderkey) as close,
    min(o_totalprice) / 1000 as dividends, max(o_totalprice) as high, min(o_totalprice) as low,
    min_by(o_totalprice, o_orderkey) as open,
    cast(count(case when o_totalprice > 300000 then 1 end) as double) as stock_splits,
    cast(count(*) as double) as volume
  from orders where o_orderstatus in ('F', 'O', 'P') group by 1, 2"""

REGISTRY = f"""
  select {cnpj('n_nationkey')} as id_cnpj, 'ORD' || s as id_ticker, s as ticker_list
  from (select n_nationkey,
      case n_nationkey when 0 then 'F' when 1 then 'O' else 'N' || n_nationkey end as s from nation)"""

LINKED = f"select * from ({QUOTES}) left join ({REGISTRY}) using (ticker_list)"

# --- registers ---------------------------------------------------------------

COMPANIES = f"""
  select {cnpj('doc_id')} as cnpj_companhia,
    case when doc_id % 7 = 0 then null else day end as data_referencia,
    cast(doc_id as varchar) as id_documento, '1' as versao, s_name as nome_empresarial,
    day as data_constituicao, case when doc_id % 11 = 0 then null else day end as data_registro,
    'ATIVO' as situacao_registro, source as setor, text as descricao,
    case when doc_id % 3 = 0 then 'Fase Operacional' end as situacao_emissor,
    case when doc_id % 5 = 0 then null else 31 end as dia,
    cast(1 + doc_id % 12 as integer) as mes, lang
  from (select *, date '2000-01-01' + cast(doc_id % 3000 as integer) as day from documents)
  left join supplier on doc_id = s_suppkey"""

KINDS = ", ".join(f"'{k}'" for k in SECURITY_KINDS)
SECURITIES = f"""
  select {cnpj('(p_partkey % 500)')} as id_cnpj, cast(p_partkey as varchar) as id_document,
    p_size as qty_version, date '2022-01-01' as dt_refer,
    ([{KINDS}])[1 + p_size % 4] as cat_stock_type, '' as cat_preferencial_stock,
    p_type[1:3] || regexp_extract(p_brand, '[0-9]+$') as id_ticker,
    case when p_partkey % 10 = 0 then 'Balcão' else 'Bolsa' end as cat_type_market,
    'B3' as cat_market,
    case when p_partkey % 9 <> 0 then 'Bolsa, Balcão e Mercadorias' end as text_market,
    'Nível 1' as cat_governance_segmentation, date '2001-02-03' as dt_start_negociation,
    cast(null as date) as dt_end_negociation, date '2001-02-03' as dt_start_listing,
    case when p_partkey % 6 = 0 then date '2020-01-01' end as dt_end_listing
  from part"""


def low(name: str) -> str:
    return f"lower(strip_accents(coalesce({name}, ''))) as {name}"


SECURITY = f"""
  select regexp_replace(id_cnpj, '[./-]', '', 'g') as id_cnpj, id_document, qty_version, dt_refer,
    {low('cat_stock_type')}, cat_preferencial_stock, id_ticker, {low('cat_type_market')},
    cat_market, {low('text_market')}, {low('cat_governance_segmentation')}, dt_start_negociation,
    dt_end_negociation, dt_start_listing, dt_end_listing
  from ({SECURITIES})"""

LISTED = f"""
  select distinct id_cnpj, upper(id_ticker) as id_ticker, upper(id_ticker) || '.SA' as ticker_list
  from ({SECURITY}) where length(id_ticker) >= 5 and cat_type_market = 'bolsa'
    and cat_stock_type in ('acoes ordinarias', 'acoes preferenciais', 'units')
    and dt_end_listing is null"""


def units(source: str) -> str:
    def swap(mark: str) -> str:
        return (
            f"select id_cnpj, replace(id_ticker, '11', '{mark}'), "
            f"replace(ticker_list, '11', '{mark}') from s where contains(id_ticker, '11')"
        )

    return f"""
      with s as ({source})
      select id_cnpj, id_ticker, ticker_list from s union {swap('3')} union {swap('4')}"""


BRANDS = """
  select distinct p_type as id_cnpj, upper(p_brand) as id_ticker,
    upper(p_brand) || '.SA' as ticker_list
  from part"""


def hashed(expr: str) -> str:
    return f"""
      select doc_id, md5(t) as txt_hash, length(t) as n_chars
      from (select doc_id, {expr} as t from documents)"""


def null_counts() -> str:
    source = lines("income", False)
    names = [f.name.lower() for f in sc.STATEMENT_LINES.fields]
    have = {
        "cnpj_cia", "dt_refer", "denom_cia", "cd_cvm", "escala_moeda", "ordem_exerc",
        "dt_ini_exerc", "dt_fim_exerc", "cd_conta", "ds_conta", "vl_conta",
    }
    counted = ", ".join(
        f"count(*) - count({n if n in have else '1'}) as {n}" for n in names
    )
    return f"unpivot (select {counted} from ({source})) on {', '.join(names)} " \
        "into name column_name value n_null"


LONG_W = Windows("event_type", "ts, event_id")


def long_entities() -> str:
    base = "select event_type, ts, event_id, floor(value * 100) as value from events"
    w = LONG_W
    parts = [
        f"{w.lag('value', 3)} as amt_tot_value_3d_lag", w.pct("value", 5, "5d"),
        w.moving("value", 20, "avg"), w.moving("value", 20, "max"), w.broke("value", 20, "high"),
    ]
    strength = ifr_sql(base, w, "value", [10], "event_id")
    return f"""
      select * from (select event_type, event_id, value, {', '.join(parts)} from ({base}))
      join ({strength}) using (event_id)"""


def lake_tables() -> str:
    """Rows and amounts per table and year of the file."""
    income, flow = list(INCOME_WHEN), list(CASH_WHEN)
    sources = {
        "dfp_dre": (wide("income", True), "dt_year", income),
        "itr_dre": (wide("income", False), "dt_year", income),
        "itr_dre_complete": (last_quarter(), "dt_year", income),
        "dfp_bpa": (wide("assets", True), "dt_year", list(ASSETS_WHEN)),
        "itr_bpa": (wide("assets", False), "dt_year", list(ASSETS_WHEN)),
        "dfp_bpp": (wide("liabilities", True), "dt_year", list(LIABILITIES_WHEN)),
        "itr_bpp": (wide("liabilities", False), "dt_year", list(LIABILITIES_WHEN)),
        "dfp_dre_ds_conta": (typed("income", True), "dt_year", ["v"]),
        "itr_dre_ds_conta": (typed("income", False), "dt_year", ["v"]),
        "dfp_dfc": (flow_annual(), "dt_year", flow),
        "itr_dfc": (flow_quarterly(PINNED), "dt_year", flow),
        "itr_dfc_own_year": (flow_quarterly(OWN_YEAR), "dt_year", flow),
        "itr_dfc_table": (flow_accounts(), "dt_year", ["a1", "a2", "a3", "a4"]),
        "fca_aberta_geral": (COMPANIES, "year(data_constituicao)", []),
        "fca_valor_mobiliario": (SECURITIES, "2020 + qty_version % 3", []),
    }
    return " union all ".join(
        f"""
      select '{name}' as table_name, cast({year} as integer) as dt_file_year, count(*) as n_rows,
        cast(sum({' + '.join(['0', *[f'cast(coalesce({a}, 0) as decimal(20,2))' for a in amounts]])}) as double)
          as amt_total
      from ({source}) group by 2"""
        for name, (source, year, amounts) in sources.items()
    )


def broken_lines() -> str:
    """Lines that parse, and the text of those that do not, their amount left out."""
    def shown(day: str) -> str:
        return f"cast({day} as varchar)"

    text = " || ';' || ".join([
        "cnpj_cia", shown("dt_refer"), "case when cd_conta = '3.08' then 'v2' else '1' end", "denom_cia", "cd_cvm",
        "'DF Consolidado'", "'REAL'", "escala_moeda", "ordem_exerc", shown("dt_ini_exerc"), shown("dt_fim_exerc"),
        "cd_conta", "ds_conta", "case when cd_conta = '3.05' then 'n/d' else '' end", "'S'",
    ])
    bad = "cd_conta in ('3.05', '3.08')"
    return f"""
      with l as ({lines('income', False)})
      select false as is_corrupt, cd_cvm, cd_conta, vl_conta, null as raw from l where not {bad}
      union all select true, null, null, null, {text} from l where {bad}"""


def sql() -> dict[str, str]:
    n = 20
    w = BAR_W
    lagged = f"select *, {w.lag('adj_close', 1)} as y from ({BARS})"
    frame = f"over ({w.spec} rows between {n} preceding and current row)"
    out = {
        "scan_delimited": f"""
          select cnpj_cia, cast(dt_refer as varchar) as dt_refer, denom_cia, cd_conta, ds_conta,
            vl_conta from ({lines('income', False)})""",
        "scan_file_year": """
          select cast(year(o_orderdate) as integer) as dt_file_year, count(*) as n_lines,
            cast(sum(cast(o_totalprice as decimal(20,2))) as double) as amt_total
          from orders group by 1""",
        "multi_year_union": f"""
          select id_cvm, dt_year, cat_type_dre, amt_sales_revenue, amt_net_profit
          from ({wide('income', True)}) where dt_year between 1990 and 1999""",
        "sink_overwrite": f"""
          select dt_date, id_ticker, case when year(dt_date) >= 0 then amt_adj_close end
            as amt_adj_close, cast(year(dt_date) as integer) as dt_year
          from (select *, case when year(dt_date) <> 1997 then null end from ({PRICES}))""",
        "price_append": f"select dt_date, id_ticker, amt_adj_close, qty_volume from ({PRICES})",
        "price_append_stream": """
          select event_id, user_id, event_type, value, cast(ts as date) as dt_date from events""",
        "stream_dedupe_state": """
          select event_id, user_id, event_type, value from events
          where event_id % 3 <> 0 or ts >= (select max(ts) from events where event_id % 3 <> 0) - interval 1 day""",
        "missing_years": f"""
          select {', '.join(sc.INCOME_KEYS + sc.INCOME_AMOUNTS)} from ({wide('income', True)})
          where dt_year in (1994, 1996)""",
        "preprocess_lake": lake_tables(),
        "scan_quarantine": broken_lines(),
        "income_union_legacy": income_union(legacy=True),
        "null_fill_by_type": """
          select doc_id, case when doc_id % 3 <> 0 then coalesce(lang, '') else '' end as lang,
            case when doc_id % 4 <> 0 then coalesce(source, '') else '' end as source,
            case when doc_id % 5 <> 0 then coalesce(n_chars, 0) else 0 end as n_chars,
            case when doc_id % 7 <> 0 and doc_id % 2 = 0 then coalesce(n_chars / 4, 0) else 0 end as amt_quarter
          from documents""",
        "quotes_many_tickers": """
          select cast(cast(l_shipdate as date) as varchar) as date, 'T' || (l_suppkey % 250) as ticker_list,
            max(l_extendedprice) as high, min(l_extendedprice) as low
          from lineitem group by 1, 2""",
        "quotes_unpivot": QUOTES,
        "quotes_attach_registry": f"""
          select date, ticker_list, id_cnpj, id_ticker, adj_close from ({LINKED})""",
        "typed_quotes": f"""
          select cast(date as date) as dt_date, id_cnpj, id_ticker, adj_close as amt_adj_close,
            close as amt_close, high as amt_high, low as amt_low, open as amt_open,
            volume as qty_volume, cast(trunc(dividends) as integer) as amt_dividends,
            cast(stock_splits as integer) as cat_stock_splits, dividends as amt_dividends_exact
          from ({LINKED})""",
        "rename_catalog": f"""
          select id_cnpj, id_document, cast(qty_version as varchar) as qty_version,
            cast(dt_refer as varchar) as dt_refer, cat_stock_type, cat_preferencial_stock, id_ticker,
            cat_type_market, cat_market, text_market, cat_governance_segmentation,
            cast(dt_start_negociation as varchar) as dt_start_negociation,
            cast(dt_end_negociation as varchar) as dt_end_negociation,
            cast(dt_start_listing as varchar) as dt_start_listing,
            cast(dt_end_listing as varchar) as dt_end_listing
          from ({SECURITIES})""",
        "stamp_processed_at": f"select *, {DAY} as processed_at from supplier",
        "statement_current_only": f"""
          select cd_cvm, cast(dt_refer as varchar) as dt_refer, cd_conta, vl_conta
          from ({lines('income', True)}) where ordem_exerc = '{CURRENT}'""",
        "statement_exercise_months": f"""
          select dt_ini_exerc, dt_fim_exerc, count(*) as n_lines,
            cast(datediff('month', dt_ini_exerc, dt_fim_exerc) + 1 as double) as dt_months_exercise
          from ({lines('income', False)} union all {lines('income', True)}) group by 1, 2""",
        "scale_currency": f"""
          select cd_cvm, escala_moeda,
            cast(sum(cast({SCALED} as decimal(20,2))) as double) as amt_total
          from ({lines('income', True)}) where ordem_exerc = '{CURRENT}' group by 1, 2""",
        "null_fill": f"""
          select id_documento as "ID_Documento", coalesce(situacao_emissor, '')
            as "Situacao_Emissor", lang as "Pais_Origem" from ({COMPANIES})""",
        "null_profile": null_counts(),
        "price_day_filter": f"""
          select dt_date, id_ticker, amt_adj_close, amt_high, amt_low, amt_open
          from ({PRICES}) where dt_date = date '1998-06-15'""",
        "sorted_output": f"select dt_date, id_ticker, amt_adj_close from ({PRICES})",
        "label_slug": hashed(slug("text")),
        "label_slug_spaced": hashed(slug_spaced("text")),
        "strip_accents": hashed("strip_accents(text)"),
        "text_pattern": """
          select conv_id, turn, regexp_replace(regexp_replace(strip_accents(regexp_replace(
            lower(text), '^\\s+|\\s+$', '', 'g')), '[^\\x00-\\x7F]', '', 'g'), '\\s+', '_', 'g')
            as txt_pattern from conversations""",
        "taxid_digits": f"select c_custkey, {cnpj_digits('c_custkey')} as id_cnpj from customer",
        "parse_dates": f"""
          select id_documento as id_document, data_referencia as dt_refer,
            data_registro as dt_cvm_register from ({COMPANIES})""",
        "period_columns": """
          select cast(year(o_orderdate) as integer) as dt_year,
            cast(quarter(o_orderdate) as integer) as dt_quarter, count(*) as n_orders
          from orders group by 1, 2""",
        "quarter_bounds": """
          select distinct cast(year(o_orderdate) as integer) as dt_year,
            cast(quarter(o_orderdate) as integer) as dt_quarter,
            last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1)) as dt_quarter_end,
            last_day(make_date(2022, quarter(o_orderdate) * 3, 1)) as dt_quarter_end_pinned,
            cast(last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1))
              - interval 2 month as date) as dt_two_months_before
          from orders""",
        "register_company": f"""
          select regexp_replace(cnpj_companhia, '[./-]', '', 'g') as id_cnpj,
            data_referencia as dt_refer, id_documento as id_document, versao as qty_version,
            lower(strip_accents(coalesce(nome_empresarial, ''))) as txt_company_name,
            data_constituicao as dt_company_creation, data_registro as dt_cvm_register,
            lower(situacao_registro) as cat_cvm_register_situation,
            data_constituicao as dt_cvm_register_situation,
            lower(strip_accents(coalesce(setor, ''))) as cat_sector,
            md5(lower(strip_accents(coalesce(descricao, '')))) as text_sector,
            lower(situacao_emissor) as cat_situation_issuer,
            data_constituicao as dt_situation_issuer, dia as dt_year_fiscal_end,
            mes as dt_month_fiscal_end, lower(lang) as cat_country_origin
          from ({COMPANIES})""",
        "register_security": SECURITY,
        "ticker_universe": units(LISTED),
        "ticker_units": units(BRANDS),
        "classify_chart": f"""
          select distinct cd_cvm, cnpj_cia, denom_cia, dt_refer, dt_fim_exerc, dt_year, dt_quarter,
            t as cat_type_dre from ({typed('assets', False)})""",
        "income_statement": wide("income", False),
        "income_statement_annual": wide("income", True),
        "income_lines": f"""
          select {NAMES}, dt_refer, dt_fim_exerc, dt_year, dt_quarter, c as cd_conta, l as ds_conta,
            v as vl_conta, t as cat_type_dre, cast(3 as double) as dt_months_exercise
          from ({typed('income', False)})""",
        "balance_assets": wide("assets", False),
        "balance_liabilities": wide("liabilities", False),
        "cash_flow_annual": flow_annual(),
        "cash_flow_quarterly": flow_quarterly(PINNED),
        "cash_flow_quarterly_own_year": flow_quarterly(OWN_YEAR),
        "cash_flow_table": f"""
          select id_cvm, id_cnpj, txt_company_name, dt_year, id_account, txt_account,
            cast(a1 as double) as "Q1", cast(a2 as double) as "Q2", cast(a3 as double) as "Q3",
            cast(a4 as double) as "Q4" from ({flow_accounts()})""",
        "account_coverage": coverage(),
        "complete_years": complete(),
        "last_quarter": last_quarter(),
        "last_quarter_legacy": last_quarter_legacy(),
        "income_union": income_union(),
        "dedupe_subset": f"""
          select id_cnpj, dt_year, dt_quarter, dt_fim_exerc, l_partkey, l_extendedprice
          from (select *, row_number() over (partition by id_cnpj, dt_year, dt_quarter, dt_fim_exerc
            order by l_partkey, l_extendedprice) as rn from ({FILINGS})) where rn = 1""",
        "dedupe_running_count": f"""
          select id_cnpj, dt_year, dt_quarter, dt_fim_exerc, l_partkey, l_extendedprice
          from (select *, count(id_cnpj) over (partition by id_cnpj, dt_year, dt_quarter
            order by dt_fim_exerc nulls first) as running from ({FILINGS})) where running = 1""",
        "lag_features": on_bars(
            f"{w.lag('adj_close', 1)} as amt_tot_adj_close_1d_lag",
            f"{w.lag('adj_close', 5)} as amt_tot_adj_close_1w_lag",
        ),
        "pct_change": on_bars(w.pct("adj_close", 5, "5d")),
        "rolling_mean": on_bars(w.moving("adj_close", n, "avg")),
        "rolling_std": on_bars(w.moving("adj_close", n, "std")),
        "rolling_var": on_bars(w.moving("adj_close", n, "var")),
        "rolling_min": on_bars(w.moving("adj_close", n, "min")),
        "rolling_max": on_bars(w.moving("adj_close", n, "max")),
        "rolling_beta": beta_sql(BARS, w, [("adj_close", n)], BAR_KEYS),
        "rolling_beta_fixed": f"""
          select {BAR_KEYS}, {rnd(
              f"covar_samp(adj_close, y) {frame} / nullif(var_samp(y) {frame}, 0)", 6,
              f"amt_beta_adj_close_{n + 1}_fixed")}
          from ({lagged})""",
        "broke_high": on_bars(w.broke("adj_close", n, "high")),
        "broke_low": on_bars(
            w.broke("low_price", n, "low"), w.broke("low_price", n, "low", "<", "_fixed")
        ),
        "ifr": ifr_sql(BARS, w, "adj_close", [n], BAR_KEYS),
        "ifr_fixed": f"""
          select {BAR_KEYS}, {rnd('100 - 100 / nullif(1 + g / nullif(l, 0), 0)', 4,
                                  f'amt_IFR_adj_close_{n}_fixed')}
          from (select *, sum(greatest(adj_close - y, 0)) {frame.replace(f'{n} pre', f'{n - 1} pre')} as g,
            sum(greatest(y - adj_close, 0)) {frame.replace(f'{n} pre', f'{n - 1} pre')} as l
            from ({lagged}))""",
        "features_long_entities": long_entities(),
        "price_features_1": features_1(),
        "price_features_2": features_2(),
        "income_features": statement_features(),
        "price_period_end": PERIOD_END,
        "fundamentals_join": joined(True),
        "fundamentals_price": f"""
          select f.id_cnpj as id, f.dt_year, f.dt_quarter, id_cvm, f.id_cnpj, cat_type_dre,
            amt_net_profit, id_ticker, amt_adj_close, amt_dividends
          from ({wide('income', False)}) f left join ({PERIOD_END}) p
            on f.id_cnpj = p.id_cnpj and f.dt_year = p.dt_year and f.dt_quarter = p.dt_quarter""",
        "fundamentals_price_inner": f"""
          with i as ({wide('income', False)}), a as ({wide('assets', False)}),
            b as ({wide('liabilities', False)})
          select i.id_cnpj as id, p.id_ticker, id_cvm, txt_company_name, dt_year, dt_quarter,
            {DAY} as processed_at, amt_adj_close, amt_dividends, amt_sales_revenue, amt_net_profit,
            amt_cash_and_cash_equivalents, amt_total_assets, amt_net_equity, amt_total_liabilities
          from i left join a using (id_cvm, id_cnpj, txt_company_name, dt_year, dt_quarter)
            left join b using (id_cvm, id_cnpj, txt_company_name, dt_year, dt_quarter)
            join ({PERIOD_END}) p using (id_cnpj, dt_year, dt_quarter)""",
        "fundamentals_profit": f"""
          select id_cvm, dt_year, cat_type_dre, {PROFIT} from ({wide('income', True)})""",
        "fundamentals_annual": qualify(integrated(True)),
        "fundamentals_quarterly": qualify(integrated(False)),
    }
    out["sink_overwrite"] = f"""
          select dt_date, id_ticker, amt_adj_close, cast(year(dt_date) as integer) as dt_year
          from ({PRICES})"""
    return out
