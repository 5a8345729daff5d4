"""Registry-shaped inputs derived from the test tables, in SQL that Spark and DuckDB read alike.

Every view runs over all rows of the tables it reads; misses and odd values come from the way keys and codes are
mapped, not from leaving rows out. Names in braces are the inputs of a view.
"""

from __future__ import annotations

import datetime as dt
import string

from pyspark.sql import DataFrame, SparkSession

from firmroll.fixed_values import FEED_COLUMNS, LOOKUP_COLUMNS, SIZE_OVERRIDE_TABLE

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

AS_OF = dt.date(2003, 6, 30)

VIEWS = {
    # One company per customer. Legal natures 2025-2029 and roles 25-29 have no dictionary entry.
    "empresas": """
select lpad(cast(c_custkey as string),8,'0') as cnpj_basico,
 c_name || case when c_custkey%4=0 then ' SA 12.345.678/0001-90' when c_custkey%4=1 then ' S/A.' when c_custkey%4=2 then ' 1998' else ' LTDA' end as razao_social,
 cast(2000+c_custkey%30 as string) as natureza_juridica,
 lpad(cast(c_custkey%30 as string),2,'0') as qualificacao_responsavel,
 case when c_custkey%50=7 then 'n/d' when c_custkey%50=8 then '' else replace(cast(cast(c_acctbal as decimal(18,2)) as string),'.',',') end as capital_social,
 case c_mktsegment when 'BUILDING' then '00' when 'AUTOMOBILE' then '01' when 'MACHINERY' then '03' when 'HOUSEHOLD' then '05' else '' end as porte_empresa,
 case when c_custkey%25=0 then 'UNIAO' else '' end as ente_federativo_responsavel
from {customer}""",
    # One establishment per order. Urgent orders belong to company numbers of their own, most of them unknown.
    "estabelecimentos": """
select lpad(cast(case when o_orderpriority='1-URGENT' then o_orderkey else o_custkey end as string),8,'0') as cnpj_basico,
 lpad(cast(o_orderkey%10000 as string),4,'0') as cnpj_ordem,
 lpad(cast(o_orderkey%97 as string),2,'0') as cnpj_dv,
 case when o_orderkey%5=0 then '1' when o_orderkey%5<4 then '2' else '' end as identificador_matriz_filial,
 'LOJA ' || cast(o_orderkey as string) as nome_fantasia,
 case o_orderstatus when 'F' then '02' when 'O' then '08' when 'P' then '04' else '' end as situacao_cadastral,
 replace(cast(cast(o_orderdate as date) as string),'-','') as data_situacao_cadastral,
 lpad(cast(o_orderkey%80 as string),2,'0') as motivo_situacao_cadastral,
 case when o_orderkey%30=27 then 'LISBOA' else '' end as nome_cidade_exterior,
 case when o_orderkey%30=27 then '607' else '' end as pais,
 case when o_orderkey%50=0 then '00000000' when o_orderkey%20=1 then '19660102' else replace(cast(cast(o_orderdate as date) as string),'-','') end as data_inicio_atividade,
 lpad(cast(2*o_custkey as string),7,'0') as cnae_fiscal_principal,
 case when o_orderkey%3=0 then '1234-5/01, 9876501' else '' end as cnae_fiscal_secundaria,
 'RUA' as tipo_logradouro, o_orderpriority as logradouro, cast(o_orderkey%1000 as string) as numero,
 case when o_orderkey%6=0 then 'SALA ' || cast(o_orderkey%40 as string) else '' end as complemento,
 'CENTRO' as bairro, lpad(cast(o_orderkey as string),8,'0') as cep,
 split_part('AC,AL,AM,AP,BA,CE,DF,ES,GO,MA,MG,MS,MT,PA,PB,PE,PI,PR,RJ,RN,RO,RR,RS,SC,SE,SP,TO,EX,,ZZ',',',1+cast(o_orderkey%30 as int)) as uf,
 lpad(cast(o_custkey%30 as string),4,'0') as municipio,
 '11' as ddd_1, lpad(cast(o_orderkey as string),8,'0') as telefone_1, '' as ddd_2, '' as telefone_2, '' as ddd_fax, '' as fax,
 'loja' || cast(o_orderkey as string) || '@example.com' as correio_eletronico,
 case when o_orderkey%40=0 then 'FALIDO' else '' end as situacao_especial,
 case when o_orderkey%40=0 then '20251345' when o_orderkey%40=20 then '20190228' else '' end as data_situacao_especial
from {orders}""",
    # One partner per line item; the order number is the company number, so companies have 0, 1, 2, 3 or more.
    "socios": """
select lpad(cast(l_orderkey as string),8,'0') as cnpj_basico,
 cast(1+l_partkey%4 as string) as identificador_socio,
 'P' || lpad(cast(l_partkey as string),7,'0') || ' DA SILVA' as nome_socio_razao_social,
 '***' || lpad(cast(l_suppkey as string),6,'0') || '**' as cpf_cnpj_socio,
 lpad(cast(l_partkey%30 as string),2,'0') as qualificacao_socio,
 case when l_suppkey%10=0 then '' else replace(cast(cast(l_shipdate as date) as string),'-','') end as data_entrada_sociedade,
 case when l_partkey%4=2 then '249' else '' end as pais,
 '***' || lpad(cast(l_linenumber as string),6,'0') || '**' as representante_legal,
 case when l_partkey%6=0 then 'REP ' || cast(l_suppkey as string) || ' X' else '' end as nome_representante,
 lpad(cast(l_suppkey%30 as string),2,'0') as qualificacao_representante_legal,
 cast(l_partkey%10 as string) as faixa_etaria
from {lineitem}""",
    # One status per customer, of the company with twice its number: odd companies have none.
    "simples": """
select lpad(cast(2*c_custkey as string),8,'0') as cnpj_basico,
 case when c_custkey%2=0 then 'S' else 'N' end as opcao_simples,
 case when c_custkey%2=0 then '20070701' else '00000000' end as data_opcao_simples,
 case when c_custkey%7=0 then '20101231' else '' end as data_exclusao_simples,
 case when c_custkey%5=0 then 'S' else 'N' end as opcao_mei,
 case when c_custkey%5=0 then '20090701' else '0' end as data_opcao_mei,
 '' as data_exclusao_mei
from {customer}""",
    "empresa_faixas_opt": """
select lpad(cast(3*s_suppkey as string),8,'0') as cnpj_basico, lpad(cast(1+2*(s_suppkey%3) as string),2,'0') as porte_empresa
from {supplier}""",
    # Dictionaries. Activities grow with the data, the others do not.
    "dict_cnae": """
select lpad(cast(p_partkey as string),7,'0') as codigo_cnae, p_name as descricao_cnae from {part}""",
    "dict_municipios": """
select lpad(cast(n_nationkey as string),4,'0') || ' ' as codigo_municipios, n_name as descricao_municipios from {nation}""",
    "dict_naturezas": """
select cast(2000+n_nationkey as string) as codigo_natureza_juridica, n_name as descricao_natureza_juridica from {nation}""",
    "dict_qualificacoes": """
select lpad(cast(n_nationkey as string),2,'0') as codigo_qualificacao_socio, 'R ' || n_name as descricao_qualificacao_socio from {nation}""",
    "dict_qualificacao_socio": """
select lpad(cast(n_nationkey as string),2,'0') as codigo_qualificacao_socio, 'Q ' || n_name as descricao_qualificacao_socio from {nation}""",
    "dict_faixa_etaria": """
select cast(r_regionkey as string) as codigo, r_name as descricao from {region}""",
    # A third of these rows has no key.
    "estabelecimentos_sem_chave": """
select case when o_orderkey%3=0 then cast(null as string) else lpad(cast(o_custkey as string),8,'0') end as cnpj_basico,
 'LOJA ' || cast(o_orderkey as string) as nome_fantasia
from {orders}""",
    # Every third code has two descriptions, and a blank code has one.
    "dict_qualificacao_socio_repetida": """
select codigo_qualificacao_socio, descricao_qualificacao_socio from {dict_qualificacao_socio}
union all select codigo_qualificacao_socio, 'X ' || descricao_qualificacao_socio from {dict_qualificacao_socio}
 where cast(codigo_qualificacao_socio as int)%3=0""",
    # Companies as a file with quoted fields has them: separators inside fields.
    "raw_empresas_com_separador": """
select cnpj_basico, razao_social || '; ' || case when cnpj_basico like '%7' then 'X;Z' else 'Y' end as razao_social,
 natureza_juridica, qualificacao_responsavel, capital_social, porte_empresa, ente_federativo_responsavel from {empresas}""",
    # Listings to choose a period from: one path, or one line of a page, per order.
    "listagem": """
select '/files/' || case when o_orderkey%9=0 then 'temp' when o_orderkey%9=1 then substr(cast(cast(o_orderdate as date) as string),1,4) || '-13' else substr(cast(cast(o_orderdate as date) as string),1,7) end || case when o_orderkey%2=0 then '/' else '' end as caminho
from {orders}""",
    "pagina_com_links": """
select '<a href="' || substr(cast(cast(o_orderdate as date) as string),1,7) || '/">pasta</a> <b>2099-01/</b>' as texto from {orders}""",
    "pagina_sem_links": """
select '<td>' || substr(cast(cast(o_orderdate as date) as string),1,7) || '/</td>' as texto from {orders}""",
    "periodos": """
select substr(cast(cast(o_orderdate as date) as string),1,7) as periodo, count(*) as n from {orders} group by 1""",
}


def _quoted(name: str) -> str:
    return f"chr(34) || {name} || chr(34)"


_DAY = "replace(cast(cast(o_orderdate as date) as string),'-','')"
_Y, _M, _D = f"substr({_DAY},1,4)", f"substr({_DAY},5,2)", f"substr({_DAY},7,2)"
_TIME = "lpad(cast(o_orderkey%24 as string),2,'0') || ':' || lpad(cast(o_orderkey%60 as string),2,'0')"
_MONTH = f"substr('JanFebMarAprMayJunJulAugSepOctNovDec',3*cast({_M} as int)-2,3)"
# Order dates in one shape per order, some of them no dates at all.
VIEWS["datas"] = f"""
select o_orderkey, case o_orderkey%20
 when 0 then {_DAY} when 1 then {_Y} || '-' || {_M} || '-' || {_D} when 2 then {_Y} || '/' || {_M} || '/' || {_D}
 when 3 then {_D} || '/' || {_M} || '/' || {_Y} when 4 then {_D} || '-' || {_M} || '-' || {_Y}
 when 5 then {_D} || '.' || {_M} || '.' || {_Y} when 6 then {_D} || '/' || {_M} || '/' || substr({_Y},3,2)
 when 7 then {_Y} || '-' || {_M} || '-' || {_D} || ' ' || {_TIME} || ':07'
 when 8 then {_Y} || '-' || {_M} || '-' || {_D} || 'T' || {_TIME} || ':07' when 9 then {_D} || '/' || {_M} || '/' || {_Y} || ' ' || {_TIME}
 when 10 then {_Y} || '-' || {_M} when 11 then {_Y} when 12 then {_D} || ' ' || {_MONTH} || ' ' || {_Y}
 when 13 then {_DAY} || '101112' when 14 then ' ' || {_DAY} || ' ' when 15 then {_Y} || '-13-' || {_D}
 when 16 then '30/02/' || {_Y} when 17 then '' when 18 then cast(null as string) else 'sem data' end as data
from {{orders}}"""


def _dirty(feed: str, special: dict[str, str]) -> str:
    """The feed as its raw file has it: every field quoted, some with blanks, backslashes or nothing at all."""
    columns = ", ".join(f"{special.get(name, _quoted(name))} as {name}" for name in FEED_COLUMNS[feed])
    return f"\nselect {columns} from {{{feed}}}"


VIEWS["raw_empresas"] = _dirty(
    "empresas",
    {
        "cnpj_basico": "chr(34) || cnpj_basico || ' ' || chr(34)",
        "razao_social": "chr(34) || chr(160) || razao_social || chr(9) || chr(34)",
        "natureza_juridica": "chr(34) || natureza_juridica || chr(92) || chr(34)",
        "qualificacao_responsavel": "qualificacao_responsavel",
        "ente_federativo_responsavel": "cast(null as string)",
    },
)
VIEWS["raw_estabelecimentos"] = _dirty(
    "estabelecimentos",
    {
        "cnpj_basico": "chr(34) || ' ' || cnpj_basico || chr(34)",
        "nome_fantasia": "chr(34) || nome_fantasia || chr(92) || chr(160) || chr(133) || chr(34)",
        "logradouro": "chr(34) || chr(31) || logradouro || '  X ' || chr(34)",
        "fax": "cast(null as string)",
    },
)
VIEWS["raw_socios"] = _dirty(
    "socios",
    {
        "nome_socio_razao_social": "chr(34) || nome_socio_razao_social || ' 123.456.789-0' || substr(faixa_etaria,1,1) || chr(34)",
        "nome_representante": "chr(34) || chr(160) || nome_representante || chr(34)",
        "pais": "cast(null as string)",
    },
)
VIEWS["raw_simples"] = _dirty("simples", {"cnpj_basico": "chr(34) || cnpj_basico || ' ' || chr(34)"})


def inputs_of(view: str) -> list[str]:
    return sorted({name for _, name, _, _ in string.Formatter().parse(VIEWS[view]) if name})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table or a derived view as a DataFrame; no temporary views are left in the session."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(VIEWS[name], **{source: view(spark, sf_dir, source) for source in inputs_of(name)})


def views(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [view(spark, sf_dir, name) for name in names]


def lookups(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: view(spark, sf_dir, name) for name in [*LOOKUP_COLUMNS, SIZE_OVERRIDE_TABLE]}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the views it reads and those that they read in turn."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for source in inputs_of(name):
            add(source)
        ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{name} as ({VIEWS[name].format(**{s: s for s in inputs_of(name)})})" for name in ordered]
    return f"with {', '.join(parts)} {sql.strip()}" if parts else sql.strip()
