import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerwave.functions import calendar, text

SLUGS = {
    "Receita de Venda de Bens e/ou Serviços": "receitavendabens_eou_servicos",
    "Receitas da Intermediação Financeira": "receitasintermediacao_financeira",
    "Receitas das Operações": "receitasoperacoes",
    "Resultado Antes do Resultado Financeiro e dos Tributos":
        "resultado_antesresultado_financeirodos_tributos",
    "Lucro/Prejuízo Consolidado do Período": "lucroprejuizo_consolidadoperiodo",
    "Caixa e Equivalentes de Caixa": "caixaequivalentescaixa",
    "Passivos Financeiros ao Valor Justo através do Resultado":
        "passivos_financeiros_ao_valor_justo_atravesresultado",
    "Imposto de Renda e Contribuição Social sobre o Lucro":
        "impostorendacontribuicao_social_sobre_o_lucro",
    "Pré-Operacional": "pre-operacional",
    "  A   e \t de  B ": "ade_b",
    "Nº 1 ª ß æ": "no_1_a_ss_ae",
}


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v string").select(expression(F.col("v"))).first()[0]


def test_label_slug(spark):
    rows = spark.createDataFrame(list(SLUGS.items()), "raw string, want string")
    bad = rows.withColumn("got", text.label_slug(F.col("raw"))).filter("got <> want").collect()
    assert bad == []


def test_spaced_slug_keeps_words_apart(spark):
    assert one(spark, "Caixa e Equivalentes de Caixa", text.label_slug_spaced) == \
        "caixa_equivalentes_caixa"
    assert one(spark, None, text.label_slug_spaced) == ""


def test_accents(spark):
    assert one(spark, "ÁçãoÉ ñ ﬁ ǆ é ß", text.strip_accents) == "AcaoE n ﬁ dz e ß"
    assert one(spark, "Ação § ½ Þ ", text.transliterate) == "Acao SS  1/2  Th "
    assert one(spark, None, text.strip_accents) is None


def test_accents_match_row_wise_decomposition(spark):
    import unicodedata

    letters = "".join(chr(c) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)])
    want = "".join(
        c for c in unicodedata.normalize("NFKD", letters) if not unicodedata.combining(c)
    )
    assert one(spark, letters, text.strip_accents) == want


def test_text_pattern_and_tax_id(spark):
    assert one(spark, "  Olá  Mundo€ ß\n", text.text_pattern) == "ola_mundo_"
    assert one(spark, "01.234.567/0001-89", text.tax_id_digits) == "01234567000189"


@pytest.mark.parametrize("value, want", [
    ("2022-01-31", dt.date(2022, 1, 31)), ("2022-1-31", None), ("", None), (None, None),
    ("2022-02-30", None), ("2022-01-31T00", None), ("abcd-ef-gh", None),
])
def test_iso_date(spark, value, want):
    assert one(spark, value, calendar.iso_date) == want


def test_exercise_months(spark):
    start = F.lit("2022-01-01").cast("date")
    for end, months in (("2022-03-31", 3), ("2022-06-30", 6), ("2022-12-31", 12)):
        assert one(spark, end, lambda c: calendar.exercise_months(start, c.cast("date"))) == months


def test_quarter_bounds(spark):
    assert one(spark, "2020", lambda c: calendar.quarter_end(c.cast("int"), F.lit(1))) == \
        dt.date(2020, 3, 31)
    assert one(spark, "2020", lambda c: calendar.quarter_end_pinned(F.lit(2))) == \
        dt.date(2022, 6, 30)
