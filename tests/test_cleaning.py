import pytest
from pyspark.sql import functions as F

from firmroll.fixed_values import FEED_COLUMNS
from firmroll.functions import cleaning
from firmroll.sources.schemas import feed_schema

CASES = [
    # marks and blanks, any column
    ("nome_fantasia", '"LOJA"', "LOJA"),
    ("nome_fantasia", 'A "B" \\ C', "A B  C"),
    ("nome_fantasia", " \t X \x1f\x85\n", "X"),
    ("nome_fantasia", '" "', ""),
    ("nome_fantasia", None, ""),
    ("nome_fantasia", "São  João", "São  João"),
    ("nome_fantasia", "Ã ", "Ã"),
    ("cnpj_basico", '" 00000001 "', "00000001"),
    # document number at the end of a name
    ("razao_social", "ACME 12.345.678/0001-90", "ACME"),
    ("razao_social", "FOO S/A.", "FOO S/A"),
    ("razao_social", "X 123 456", "X 123"),
    ("razao_social", "GRUPO 1998", "GRUPO"),
    ("razao_social", "BAR - 12  ", "BAR - ".strip() + "" if False else "BAR -"),
    ("razao_social", "123", ""),
    ("razao_social", "3M DO BRASIL", "3M DO BRASIL"),
    ("nome_socio_razao_social", "MARIA ***123456**", "MARIA ***123456**"),
    ("nome_socio_razao_social", "MARIA 12345678901", "MARIA"),
    ("nome_fantasia", "LOJA 12", "LOJA 12"),
    # dates that mean none
    ("data_inicio_atividade", "00000000", ""),
    ("data_inicio_atividade", " 0 ", ""),
    ("data_inicio_atividade", "20200101", "20200101"),
    ("data_opcao_mei", "0", ""),
    ("capital_social", "1.000,50", "1.000.50"),
    ("capital_social", "0", "0"),
    ("cnae_fiscal_principal", "1234-5/01", "1234501"),
    ("cnae_fiscal_secundaria", "11, 22;x", "11,22"),
    ("cnae_fiscal_secundaria", "", ""),
]


@pytest.mark.parametrize("name,raw,clean", CASES)
def test_field(spark, name, raw, clean):
    df = spark.createDataFrame([(raw,)], f"{name} string")
    assert df.select(cleaning.clean_field(name)).first()[0] == clean


@pytest.mark.parametrize("feed", FEED_COLUMNS)
def test_feed_is_text_and_never_null(spark, feed):
    empty = spark.createDataFrame([(None,) * len(FEED_COLUMNS[feed])], feed_schema(feed))
    clean = cleaning.clean_feed(empty, feed)
    assert clean.columns == FEED_COLUMNS[feed]
    assert all(not field.nullable for field in clean.schema)
    assert set(clean.first()) == {""}


def test_cleaning_is_idempotent(spark):
    df = spark.createDataFrame([("A 12 34-5",), ('"B. "',)], "razao_social string")
    once = df.select(F.col("razao_social").alias("raw"), cleaning.clean_field("razao_social"))
    assert [row["razao_social"] for row in once.orderBy("raw").collect()] == ["B", "A 12"]
