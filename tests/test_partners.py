from collections import defaultdict

import pytest

from firmroll.fixed_values import FEED_COLUMNS, PIVOT_SOURCES
from firmroll.operators.partners import SENIORITY, partner_rank, top_partners
from firmroll.sources.schemas import feed_schema


def partner(company, name, date, **other):
    row = dict.fromkeys(FEED_COLUMNS["socios"], "")
    row |= {"cnpj_basico": company, "nome_socio_razao_social": name, "data_entrada_sociedade": date} | other
    return tuple(row[column] for column in FEED_COLUMNS["socios"])


ROWS = [
    partner("1", "ANA", "20100101"),
    partner("2", "BEA", "20100101"),
    partner("2", "ANA", "20100101"),
    partner("3", "ANA", "20100101"),
    partner("3", "BEA", ""),
    partner("3", "CAIO", "20090101"),
    partner("4", "ANA", "20100101", cpf_cnpj_socio="9"),
    partner("4", "ANA", "20100101", cpf_cnpj_socio="8"),
    partner("4", "DAVI", "20080101"),
    partner("4", "EVA", "20110101"),
    partner("5", "ANA", "20100101", pais="2", nome_representante="R1"),
    partner("5", "ANA", "20100101", pais="1", nome_representante="R2"),
]


def brute_ranks(rows):
    """Every row with its rank, by sorting each company's rows in Python."""
    position = {name: i for i, name in enumerate(FEED_COLUMNS["socios"])}
    companies = defaultdict(list)
    for row in rows:
        companies[row[0]].append(row)
    order = [position[name] for name in SENIORITY]
    return sorted(
        (*row, rank)
        for group in companies.values()
        for rank, row in enumerate(sorted(group, key=lambda row: [row[i] for i in order]), 1)
    )


def brute_pivot(rows):
    position = {name: i for i, name in enumerate(FEED_COLUMNS["socios"])}
    out = defaultdict(dict)
    for row in brute_ranks(rows):
        if row[-1] <= 3:
            for name, source in PIVOT_SOURCES.items():
                out[row[0]][f"{name}_{row[-1]}"] = row[position[source]]
    columns = [f"{name}_{slot}" for slot in (1, 2, 3) for name in PIVOT_SOURCES]
    return sorted((company, *[values.get(name, "") for name in columns]) for company, values in out.items())


@pytest.fixture(scope="module")
def partners(spark):
    return spark.createDataFrame(ROWS, feed_schema("socios"))


@pytest.fixture(scope="module")
def large_company(spark):
    """A company with a third of all partners among many small ones."""
    rows = [partner("big", f"P{i % 70:03d}", f"20{i % 23:02d}0101", cpf_cnpj_socio=str(i)) for i in range(600)]
    rows += [partner(f"s{i % 500}", f"Q{i}", "", faixa_etaria=str(i % 7)) for i in range(1200)]
    return rows, spark.createDataFrame(rows, feed_schema("socios")).repartition(6).persist()


def test_undated_partners_come_first_and_ties_are_broken(partners):
    ranked = {(r["cnpj_basico"], r["rn"]): r for r in partner_rank(partners).collect()}
    assert [ranked["3", i]["nome_socio_razao_social"] for i in (1, 2, 3)] == ["BEA", "CAIO", "ANA"]
    assert [ranked["2", i]["nome_socio_razao_social"] for i in (1, 2)] == ["ANA", "BEA"]
    assert [ranked["4", i]["cpf_cnpj_socio"] for i in (1, 2, 3, 4)] == ["", "8", "9", ""]
    assert [ranked["5", i]["nome_representante"] for i in (1, 2)] == ["R1", "R2"]


def test_pivot_of_few_partners(partners):
    rows = [tuple(row) for row in top_partners(partners).orderBy("cnpj_basico").collect()]
    assert rows == brute_pivot(ROWS)
    free = top_partners(partners, blank=False).where("cnpj_basico = '1'").first()
    assert free["nome_socio_1"] == "ANA" and free["nome_socio_2"] is None and free["faixa_etaria_3"] is None


def test_company_with_a_third_of_all_partners(large_company):
    rows, df = large_company
    for hot in ([], ["big"]):
        assert sorted(tuple(row) for row in partner_rank(df, hot).collect()) == brute_ranks(rows)
    for hot in (None, [], ["big"], ["big", None]):
        assert sorted(tuple(row) for row in top_partners(df, hot=hot).collect()) == brute_pivot(rows)
