"""Charts of accounts as data: which line decides a company's type, and which
lines add up to which amount. All entries are fixed values.

Rules turn into SQL conditions over a cleaned line's ``cd_conta`` (account
code), ``ds_conta`` (label key) and ``vl_conta`` (value): one expression per
rule set, however many rules it has.

``GENERAL``, ``BANK`` and ``INSURER`` are the three charts. An amount rule names
its target, the chart it belongs to (``ANY`` for all, including unclassified)
and the line it takes: by account code, by exact label or by a part of the label.
"""

from __future__ import annotations

from dataclasses import dataclass

from ledgerwave.sources.schemas import ASSET_AMOUNTS, INCOME_AMOUNTS, LIABILITY_AMOUNTS

GENERAL, BANK, INSURER = "type_01", "type_02", "type_03"
CHARTS = [GENERAL, BANK, INSURER]
ANY = None


@dataclass(frozen=True)
class TypeRule:
    chart: str
    code: str
    label: str

    def test(self) -> str:
        return f"(cd_conta = '{self.code}' and ds_conta = '{self.label}')"


@dataclass(frozen=True)
class AmountRule:
    target: str
    chart: str | None
    code: str | None = None
    label: str | None = None
    label_part: str | None = None
    non_zero: bool = False

    def test(self) -> str:
        if self.code is not None:
            hit = f"cd_conta = '{self.code}'"
        elif self.label is not None:
            hit = f"ds_conta = '{self.label}'"
        else:
            hit = f"contains(ds_conta, '{self.label_part}')"
        return f"({hit} and vl_conta <> 0)" if self.non_zero else f"({hit})"


@dataclass(frozen=True)
class Chart:
    """One statement: its type rules, amount rules and output order."""

    types: list[TypeRule]
    amounts: list[AmountRule]
    targets: list[str]

    def test_for(self, target: str, chart: str | None) -> str | None:
        """Lines adding to ``target`` in rows of one chart (None: unclassified)."""
        rules = [r for r in self.amounts if r.target == target and r.chart in (ANY, chart)]
        return " or ".join(r.test() for r in rules) or None

    def type_of_line(self) -> str:
        """Chart that one line points to, null for most lines."""
        cases = " ".join(f"when {r.test()} then '{r.chart}'" for r in self.types)
        return f"case {cases} end"


def _by_code(chart: str | None, pairs: list[tuple[str, str]]) -> list[AmountRule]:
    return [AmountRule(target, chart, code=code) for target, code in pairs]


INCOME = Chart(
    types=[
        TypeRule(GENERAL, "3.01", "receitavendabens_eou_servicos"),
        TypeRule(BANK, "3.01", "receitasintermediacao_financeira"),
        TypeRule(INSURER, "3.01", "receitasoperacoes"),
    ],
    amounts=_by_code(GENERAL, [
        ("amt_sales_revenue", "3.01"),
        ("amt_cost_goods_and_services", "3.02"),
        ("amt_groos_revenue", "3.03"),
        ("amt_operating_revenues_and_expenses", "3.04"),
        ("amt_selling_expenses", "3.04.01"),
        ("amt_general_administrative_expenses", "3.04.02"),
        ("amt_losses_non_recoverability_of_assets", "3.04.03"),
        ("amt_other_operating_income", "3.04.04"),
        ("amt_other_operating_expenses", "3.04.05"),
        ("amt_equity_equivalence", "3.04.06"),
        ("amt_earnings_before_interest_and_taxes", "3.05"),
        ("amt_financial_results", "3.06"),
        ("amt_financial_income", "3.06.01"),
        ("amt_financial_expenses", "3.06.02"),
        ("amt_earnings_before_income_tax_and_social_contribution", "3.07"),
        ("amt_income_tax_social_contribution_on_profit", "3.08"),
        ("amt_net_profit", "3.11"),
    ]) + _by_code(BANK, [
        ("amt_financial_intermediation_income", "3.01"),
        ("amt_financial_intermediation_expenses", "3.02"),
        ("amt_gross_income_financial_intermediation", "3.03"),
        ("amt_operating_revenues_and_expenses", "3.04"),
        ("amt_earnings_before_income_tax_and_social_contribution", "3.05"),
        ("amt_income_tax_social_contribution_on_profit", "3.06"),
    ]) + [
        AmountRule("amt_net_profit", BANK, label="lucroprejuizo_consolidadoperiodo"),
        AmountRule("amt_sales_revenue", INSURER, label="receitasoperacoes", non_zero=True),
        AmountRule("amt_sales_revenue", INSURER, label="outras_receitasdespesas_operacionais"),
        AmountRule("amt_cost_goods_and_services", INSURER, label_part="custoservicos_prestados"),
        AmountRule("amt_earnings_before_interest_and_taxes", INSURER,
                   label_part="resultado_antesresultado_financeirodos_tributos"),
        AmountRule("amt_earnings_before_income_tax_and_social_contribution", INSURER,
                   label_part="resultado_antestributos_sobre_o_lucro"),
        AmountRule("amt_income_tax_social_contribution_on_profit", INSURER,
                   label="impostorendacontribuicao_social_sobre_o_lucro"),
        AmountRule("amt_net_profit", INSURER, label_part="lucroprejuizo_consolidadoperiodo"),
        # Applies whatever the chart: it also reaches the other two.
        AmountRule("amt_equity_equivalence", ANY, code="3.06"),
    ],
    targets=INCOME_AMOUNTS,
)

ASSETS = Chart(
    types=[
        TypeRule(GENERAL, "1.01", "ativo_circulante"),
        TypeRule(BANK, "1.01", "caixaequivalentescaixa"),
        TypeRule(INSURER, "1.01.01", "caixaequivalentescaixa"),
    ],
    amounts=_by_code(GENERAL, [
        ("amt_total_assets", "1"),
        ("amt_current_assets", "1.01"),
        ("amt_cash_and_cash_equivalents", "1.01.01"),
        ("amt_non_current_assets", "1.02"),
        ("amt_investments", "1.02.02"),
        ("amt_immobilized", "1.02.03"),
        ("amt_intangible", "1.02.04"),
    ]) + _by_code(BANK, [
        ("amt_total_assets", "1"),
        ("amt_cash_and_cash_equivalents", "1.01"),
        ("amt_finantial_assets", "1.02"),
        ("amt_investments", "1.05"),
        ("amt_immobilized", "1.06"),
        ("amt_intangible", "1.07"),
    ]) + _by_code(INSURER, [
        ("amt_total_assets", "1"),
        ("amt_current_assets", "1.01"),
        ("amt_cash_and_cash_equivalents", "1.01.01"),
        ("amt_non_current_assets", "1.02"),
        ("amt_investments", "1.02.02"),
        ("amt_immobilized", "1.02.03"),
    ]),
    targets=ASSET_AMOUNTS,
)

LIABILITIES = Chart(
    types=[
        TypeRule(GENERAL, "2.01", "passivo_circulante"),
        TypeRule(BANK, "2.01", "passivos_financeiros_ao_valor_justo_atravesresultado"),
        TypeRule(INSURER, "2.02.01", "passivo_exigivel_a_longo_prazo"),
    ],
    amounts=_by_code(GENERAL, [
        ("amt_total_liabilities", "2"),
        ("amt_current_liabilities", "2.01"),
        ("amt_non_current_liabilities", "2.02"),
        ("amt_loans_financing", "2.02.01"),
        ("amt_net_equity", "2.03"),
    ]) + _by_code(BANK, [
        ("amt_total_liabilities", "2"),
        ("amt_provisions", "2.03"),
        ("amt_net_equity", "2.07"),
    ]) + _by_code(INSURER, [
        ("amt_total_liabilities", "2"),
        ("amt_current_liabilities", "2.01"),
        ("amt_non_current_liabilities", "2.02"),
        ("amt_long_term_liabilities", "2.02.01"),
        ("amt_net_equity", "2.03"),
    ]),
    targets=LIABILITY_AMOUNTS,
)

# Cash flow has no chart types: every rule applies to every company.
CASH_FLOW_CODES = [
    ("amt_net_cash_operating_activities", "6.01"),
    ("amt_net_cash_investment_activities", "6.02"),
    ("amt_net_cash_financing_activities", "6.03"),
    ("amt_exchange_variation_without_cash_equivalents", "6.04"),
    ("amt_increase_in_cash_equivalents", "6.05"),
    ("amt_final_balance_cash_equivalents", "6.05.02"),
]
DEPRECIATION = "amt_depreciation_amortization"
DEPRECIATION_WORDS = "depreciacao|depreciacoes"


def cash_flow_test(target: str) -> str:
    """Condition over ``id_account`` and ``txt_account``."""
    if target == DEPRECIATION:
        return f"txt_account rlike '{DEPRECIATION_WORDS}'"
    return f"id_account = '{dict(CASH_FLOW_CODES)[target]}'"


# Accounts a company of each chart should report: account codes, or patterns
# over the label key for charts that are read by label.
COVERAGE = {
    GENERAL: [
        "3.01", "3.02", "3.03", "3.04", "3.05", "3.06", "3.07", "3.08", "3.11", "3.04.01",
        "3.04.02", "3.04.03", "3.04.04", "3.04.05", "3.04.06", "3.06.01", "3.06.02",
    ],
    BANK: ["3.01", "3.02", "3.03", "3.04", "3.05", "3.06", "3.11"],
    INSURER: [
        "outras_receitasdespesas_operacionais", "^receitasoperacoes$", "custoservicos_prestados",
        "resultado_antesresultado_financeirodos_tributos", "resultado_antestributos_sobre_o_lucro",
        "^impostorendacontribuicao_social_sobre_o_lucro$", "lucroprejuizo_consolidadoperiodo",
        "3.05", "3.06",
    ],
}


def covers(item: str) -> str:
    """Whether a line is the account that a coverage entry asks for."""
    return f"cd_conta = '{item}'" if item[0].isdigit() else f"ds_conta rlike '{item}'"
