import datetime as dt
from collections import Counter

import pytest

from firmroll.checks.fixtures import AS_OF, lookups
from firmroll.checks.queries import feeds
from firmroll.fixed_values import FEED_COLUMNS, LOOKUP_COLUMNS, SIZE_OVERRIDE_TABLE
from firmroll.operators import lookups as lookup_module
from firmroll.plans import enrich as plan
from firmroll.sources.schemas import TARGET_SCHEMA, feed_schema

SMALL = "/root/testdata/sf0.001"


def counted(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def inputs(spark):
    return feeds(spark, SMALL), lookups(spark, SMALL)


@pytest.fixture(scope="module")
def expected(inputs):
    return counted(plan.enriched_rows(*inputs, AS_OF))


def test_contract():
    assert len(TARGET_SCHEMA) == 96
    nullable = [field.name for field in TARGET_SCHEMA if field.nullable]
    assert len(nullable) == 17 and sum(name.startswith("data_") for name in nullable) == 10
    assert TARGET_SCHEMA[46].name == "nome_socio_1" and TARGET_SCHEMA[-1].name == "linha_unica"
    kinds = Counter(field.dataType.simpleString() for field in TARGET_SCHEMA)
    assert kinds == {"string": 82, "timestamp_ntz": 10, "float": 2, "decimal(18,2)": 1, "bigint": 1}


def test_rows_keep_the_contract(inputs):
    rows = plan.enrich(*inputs, AS_OF)
    assert [(field.name, field.dataType) for field in rows.schema] == [
        (field.name, field.dataType) for field in TARGET_SCHEMA
    ]
    must_not_be_null = [field.name for field in TARGET_SCHEMA if not field.nullable]
    assert rows.where(" or ".join(f"{name} is null" for name in must_not_be_null)).count() == 0
    active = plan.active_establishments(inputs[0].establishments).count()
    assert rows.count() == active
    numbers = Counter((row["uf"], row["linha_unica"]) for row in rows.select("uf", "linha_unica").collect())
    assert max(numbers.values()) == 1
    per_uf = Counter(uf for uf, _ in numbers)
    assert all(number <= per_uf[uf] for uf, number in numbers)


@pytest.mark.parametrize("hot", [["00000001", "00000002"], ["absent"]])
def test_salted_joins_give_the_same_rows(inputs, expected, hot):
    assert counted(plan.enriched_rows(*inputs, AS_OF, hot=hot)) == expected


def test_large_dictionaries_give_the_same_rows(inputs, expected, monkeypatch):
    monkeypatch.setattr(lookup_module, "BROADCAST_LIMIT_BYTES", 0)
    assert counted(plan.enriched_rows(*inputs, AS_OF)) == expected


@pytest.mark.parametrize("limit", [None, 0])
def test_repeated_dictionary_codes_multiply_rows_slot_by_slot(spark, monkeypatch, limit):
    """Also for a dictionary that is too large to broadcast, with and without hot codes."""
    if limit is not None:
        monkeypatch.setattr(lookup_module, "BROADCAST_LIMIT_BYTES", limit)

    def feed(name, **values):
        row = dict.fromkeys(FEED_COLUMNS[name], "") | {"cnpj_basico": "1"} | values
        return tuple(row[column] for column in FEED_COLUMNS[name])

    def frame(name, *rows):
        return spark.createDataFrame(list(rows), feed_schema(name))

    tables = plan.Feeds(
        frame("estabelecimentos", feed("estabelecimentos", situacao_cadastral="02", uf="SP", municipio="7")),
        frame("empresas", feed("empresas")),
        frame(
            "socios",
            feed("socios", nome_socio_razao_social="A", qualificacao_socio="49"),
            feed("socios", nome_socio_razao_social="B", qualificacao_socio="49"),
        ),
        frame("simples", feed("simples", opcao_mei="S")),
        spark.createDataFrame([], "cnpj_basico string, porte_empresa string"),
    )
    dictionaries = {
        name: spark.createDataFrame([], f"{code} string, {text} string")
        for name, (code, text) in LOOKUP_COLUMNS.items()
    }
    dictionaries["dict_qualificacao_socio"] = spark.createDataFrame(
        [("49", "x"), ("49", "y"), ("", "blank")], "codigo_qualificacao_socio string, descricao_qualificacao_socio string"
    )
    dictionaries[SIZE_OVERRIDE_TABLE] = tables.size_override
    rows = plan.enriched_rows(tables, dictionaries, dt.date(2026, 1, 1)).collect()
    pairs = Counter((row["desc_qualificacao_socio_1"], row["desc_qualificacao_socio_2"]) for row in rows)
    assert pairs == {(a, b): 1 for a in "xy" for b in "xy"}
    # A partner whose code is blank matches a blank dictionary code, a free slot does not.
    assert {row["desc_qualificacao_representante_1"] for row in rows} == {"blank"}
    assert {row["desc_qualificacao_socio_3"] for row in rows} == {""}
    assert {row["desc_qualificacao_representante_3"] for row in rows} == {""}
    assert {row["tipo_simples_mei"] for row in rows} == {"MEI"}


def test_state_outside_the_list_is_left_out(inputs, expected):
    assert inputs[0].establishments.where("situacao_cadastral = '02' and uf = 'ZZ'").count() > 0
    uf = [field.name for field in TARGET_SCHEMA].index("uf")
    assert "ZZ" not in {row[uf] for row in expected} and "" in {row[uf] for row in expected}
