"""Declared schemas and column lists. All of these are fixed values."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, StringType, StructField, StructType,
)


def _struct(kind_by_name: list[tuple[str, object]]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in kind_by_name])


_S, _I, _D, _F = StringType(), IntegerType(), DateType(), DoubleType()

# Income-statement and cash-flow lines, in file order.
STATEMENT_LINES = _struct([
    ("CNPJ_CIA", _S), ("DT_REFER", _S), ("VERSAO", _I), ("DENOM_CIA", _S), ("CD_CVM", _S),
    ("GRUPO_DFP", _S), ("MOEDA", _S), ("ESCALA_MOEDA", _S), ("ORDEM_EXERC", _S),
    ("DT_INI_EXERC", _S), ("DT_FIM_EXERC", _S), ("CD_CONTA", _S), ("DS_CONTA", _S),
    ("VL_CONTA", _F), ("ST_CONTA_FIXA", _S),
])

# Balance-sheet lines: the same without the start of the exercise.
BALANCE_LINES = StructType([f for f in STATEMENT_LINES.fields if f.name != "DT_INI_EXERC"])

# Company register: source column (any case) -> name.
COMPANY_REGISTER_NAMES = {
    "cnpj_companhia": "id_cnpj",
    "data_referencia": "dt_refer",
    "id_documento": "id_document",
    "versao": "qty_version",
    "nome_empresarial": "txt_company_name",
    "data_constituicao": "dt_company_creation",
    "data_registro_cvm": "dt_cvm_register",
    "situacao_registro_cvm": "cat_cvm_register_situation",
    "data_situacao_registro_cvm": "dt_cvm_register_situation",
    "setor_atividade": "cat_sector",
    "descricao_atividade": "text_sector",
    "situacao_emissor": "cat_situation_issuer",
    "data_situacao_emissor": "dt_situation_issuer",
    "dia_encerramento_exercicio_social": "dt_year_fiscal_end",
    "mes_encerramento_exercicio_social": "dt_month_fiscal_end",
    "pais_origem": "cat_country_origin",
}

# Security register: source column -> name.
SECURITY_REGISTER_NAMES = {
    "cnpj_companhia": "id_cnpj",
    "id_documento": "id_document",
    "versao": "qty_version",
    "data_referencia": "dt_refer",
    "valor_mobiliario": "cat_stock_type",
    "sigla_classe_acao_preferencial": "cat_preferencial_stock",
    "codigo_negociacao": "id_ticker",
    "mercado": "cat_type_market",
    "sigla_entidade_administradora": "cat_market",
    "entidade_administradora": "text_market",
    "segmento": "cat_governance_segmentation",
    "data_inicio_negociacao": "dt_start_negociation",
    "data_fim_negociacao": "dt_end_negociation",
    "data_inicio_listagem": "dt_start_listing",
    "data_fim_listagem": "dt_end_listing",
}

# Statement lines: source column -> name.
STATEMENT_NAMES = {"cd_cvm": "id_cvm", "cnpj_cia": "id_cnpj", "denom_cia": "txt_company_name"}

# Cash-flow lines also rename the account columns.
CASH_FLOW_NAMES = {
    **STATEMENT_NAMES,
    "cd_conta": "id_account", "ds_conta": "txt_account", "vl_conta": "amt_account",
}

INCOME_KEYS = [
    "id_cvm", "id_cnpj", "txt_company_name", "dt_refer", "dt_ini_exerc", "dt_fim_exerc",
    "dt_year", "dt_quarter", "cat_type_dre",
]
INCOME_AMOUNTS = [
    "amt_sales_revenue", "amt_cost_goods_and_services", "amt_groos_revenue",
    "amt_operating_revenues_and_expenses", "amt_selling_expenses",
    "amt_general_administrative_expenses", "amt_losses_non_recoverability_of_assets",
    "amt_other_operating_income", "amt_other_operating_expenses", "amt_equity_equivalence",
    "amt_earnings_before_interest_and_taxes", "amt_financial_results", "amt_financial_income",
    "amt_financial_expenses", "amt_earnings_before_income_tax_and_social_contribution",
    "amt_income_tax_social_contribution_on_profit", "amt_net_profit",
    "amt_financial_intermediation_income", "amt_financial_intermediation_expenses",
    "amt_gross_income_financial_intermediation",
]
BALANCE_KEYS = [k for k in INCOME_KEYS if k != "dt_ini_exerc"]
ASSET_AMOUNTS = [
    "amt_total_assets", "amt_current_assets", "amt_cash_and_cash_equivalents",
    "amt_non_current_assets", "amt_finantial_assets", "amt_investments", "amt_immobilized",
    "amt_intangible",
]
LIABILITY_AMOUNTS = [
    "amt_total_liabilities", "amt_current_liabilities", "amt_non_current_liabilities",
    "amt_loans_financing", "amt_net_equity", "amt_provisions", "amt_long_term_liabilities",
]
CASH_FLOW_KEYS = ["id_cvm", "id_cnpj", "txt_company_name", "dt_fim_exerc", "dt_year", "dt_quarter"]
CASH_FLOW_AMOUNTS = [
    "amt_net_cash_operating_activities", "amt_depreciation_amortization",
    "amt_net_cash_investment_activities", "amt_net_cash_financing_activities",
    "amt_exchange_variation_without_cash_equivalents", "amt_increase_in_cash_equivalents",
    "amt_final_balance_cash_equivalents",
]

# The eight amounts of the older fourth-quarter derivation.
LEGACY_QUARTER_AMOUNTS = [
    "amt_cost_goods_and_services", "amt_earnings_before_income_tax_and_social_contribution",
    "amt_earnings_before_interest_and_taxes", "amt_financial_results", "amt_groos_revenue",
    "amt_net_profit", "amt_operating_revenues_and_expenses", "amt_sales_revenue",
]

# Amounts the integrated table promises although no statement supplies them.
UNSUPPLIED_AMOUNTS = [
    "amt_provision_for_expected_loss_expense_credit_risk", "amt_income_from_service_provision",
    "amt_staff_costs", "amt_other_administrative_expenses", "amt_tax_expenses",
    "amt_other_operational_expenses",
]
FUNDAMENTALS_COLUMNS = (
    ["id_cvm", "id_cnpj", "id_ticker", "txt_company_name", "cat_type_dre", "dt_year",
     "dt_quarter", "dt_fim_exerc"]
    + INCOME_AMOUNTS + UNSUPPLIED_AMOUNTS + ASSET_AMOUNTS + LIABILITY_AMOUNTS
    + ["amt_adj_close", "amt_dividends"] + CASH_FLOW_AMOUNTS
)

PRICE_COLUMNS = [
    "dt_date", "id_cnpj", "id_ticker", "amt_adj_close", "amt_close", "amt_high", "amt_low",
    "amt_open", "qty_volume", "amt_dividends", "cat_stock_splits",
]
DAILY_PRICES = _struct(
    [("dt_date", _D), ("id_cnpj", _S), ("id_ticker", _S)]
    + [(name, _F) for name in PRICE_COLUMNS[3:]]
)
TICKER_REGISTRY = _struct([("id_cnpj", _S), ("id_ticker", _S), ("ticker_list", _S)])

# Quote fields as the provider names them -> column.
QUOTE_FIELDS = {
    "Adj Close": "adj_close", "Close": "close", "Dividends": "dividends", "High": "high",
    "Low": "low", "Open": "open", "Stock Splits": "stock_splits", "Volume": "volume",
}


def wide_schema(keys: list[str], amounts: list[str]) -> StructType:
    """Schema of a wide statement table, for seeding an empty one."""
    kinds = {"dt_year": _I, "dt_quarter": _I}
    return _struct(
        [(k, kinds.get(k, _D if k.startswith("dt_") else _S)) for k in keys]
        + [(a, _F) for a in amounts]
    )


INCOME_WIDE = wide_schema(INCOME_KEYS, INCOME_AMOUNTS)
ASSETS_WIDE = wide_schema(BALANCE_KEYS, ASSET_AMOUNTS)
LIABILITIES_WIDE = wide_schema(BALANCE_KEYS, LIABILITY_AMOUNTS)
CASH_FLOW_WIDE = wide_schema(CASH_FLOW_KEYS, CASH_FLOW_AMOUNTS)
