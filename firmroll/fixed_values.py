"""Values that have to be exactly these for the results to be right.

Column names and their order are set by the registry's file layouts and by the published table; codes and labels
are set by the registry's code book. Nothing in this module computes anything.
"""

# --- fixed values: positional layout of the four raw feeds -------------------------------------------------------

FEED_COLUMNS = {
    "empresas": [
        "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social",
        "porte_empresa", "ente_federativo_responsavel",
    ],
    "estabelecimentos": [
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia", "situacao_cadastral",
        "data_situacao_cadastral", "motivo_situacao_cadastral", "nome_cidade_exterior", "pais", "data_inicio_atividade",
        "cnae_fiscal_principal", "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero", "complemento",
        "bairro", "cep", "uf", "municipio", "ddd_1", "telefone_1", "ddd_2", "telefone_2", "ddd_fax", "fax",
        "correio_eletronico", "situacao_especial", "data_situacao_especial",
    ],
    "socios": [
        "cnpj_basico", "identificador_socio", "nome_socio_razao_social", "cpf_cnpj_socio", "qualificacao_socio",
        "data_entrada_sociedade", "pais", "representante_legal", "nome_representante",
        "qualificacao_representante_legal", "faixa_etaria",
    ],
    "simples": [
        "cnpj_basico", "opcao_simples", "data_opcao_simples", "data_exclusao_simples", "opcao_mei", "data_opcao_mei",
        "data_exclusao_mei",
    ],
}

# --- fixed values: raw file format -------------------------------------------------------------------------------

FIELD_SEPARATOR = ";"
FILE_ENCODING = "ISO-8859-1"
NO_QUOTE = "\u0000"
FEED_QUOTE = {"empresas": NO_QUOTE, "estabelecimentos": NO_QUOTE, "socios": NO_QUOTE, "simples": '"'}
FEED_FILE_PREFIX = {
    "empresas": "Empresas",
    "estabelecimentos": "Estabelecimentos",
    "socios": "Socios",
    "simples": "Simples",
}

# --- fixed values: cleaning --------------------------------------------------------------------------------------

BLANK_CHARACTERS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
DOCUMENT_CHARACTERS = "0123456789./-"
NAME_COLUMNS = {"razao_social", "nome_socio_razao_social"}
DATE_COLUMNS = {
    "data_situacao_cadastral",
    "data_inicio_atividade",
    "data_situacao_especial",
    "data_entrada_sociedade",
    "data_opcao_simples",
    "data_exclusao_simples",
    "data_opcao_mei",
    "data_exclusao_mei",
}
VOID_DATES = ["00000000", "0"]
MONEY_COLUMNS = {"capital_social"}
ACTIVITY_COLUMNS = {"cnae_fiscal_principal", "cnae_fiscal_secundaria"}
NOT_ACTIVITY_PATTERN = "[^0-9,]"
DATE_FORMAT = "yyyyMMdd"

# --- fixed values: which rows are published ----------------------------------------------------------------------

ACTIVE_STATUS = "02"
PUBLISHED_UFS = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR", "RJ",
    "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO", "EX", "",
]

# --- fixed values: labels ----------------------------------------------------------------------------------------

BRANCH_LABELS = {"1": "Matriz", "2": "Filial"}
STATUS_LABELS = {"01": "Nula", "02": "Ativa", "03": "Suspensa", "04": "Inapta", "08": "Baixada"}
SIZE_LABELS = {
    "00": "Nao informado",
    "01": "Micro empresa",
    "03": "Empresa de pequeno porte",
    "05": "Demais",
}
PARTNER_KIND_LABELS = {"1": "Pessoa Juridica", "2": "Pessoa Fisica", "3": "Estrangeiro"}

YES = "S"
REGIME_MEI, REGIME_SIMPLES, REGIME_OTHER = "MEI", "SIMPLES", "OUTROS"

MEI_SIZE_LABEL = "MICRO EMPRESA"
CORRECTED_SIZE_LABELS = {
    "00": "Nao se aplica",
    "01": "ME - Microempresa",
    "03": "EPP - Empresa de Pequeno Porte",
    "05": "Demais (Medio/Grande Porte)",
}

MEI_REVENUE_BAND = "ATE R$ 81.000"
REVENUE_BANDS = {
    "01": "ATE R$ 360.000",
    "03": "R$ 360.000 A R$ 4.800.000",
    "05": "ACIMA DE R$ 4.800.000",
}

AGE_BANDS = [(2, "0-2 ANOS"), (5, "2-5 ANOS"), (10, "5-10 ANOS")]
OLDEST_AGE_BAND = "ACIMA DE 10 ANOS"

REGIONS = {
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
    "Exterior": ["EX"],
}
REGION_UNKNOWN = "Nao Informado"
UF_UNKNOWN = "nao informado"

# --- fixed values: columns of the published table ----------------------------------------------------------------

PARTNER_SLOTS = (1, 2, 3)

# --- fixed values: names of archived tables, by whether the archived period is known ------------------------------

ARCHIVE_OF_PERIOD = "{table}_{period}"
ARCHIVE_BEFORE_PERIOD = "{table}_{period}_bkp"

ESTABLISHMENT_AND_COMPANY_COLUMNS = [
    "cnpj", "cnpj_basico", "cnpj_ordem", "cnpj_dv", "matriz_filial", "desc_matriz_filial", "nome_fantasia",
    "situacao_cadastral", "desc_situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral",
    "cidade_exterior", "pais", "data_inicio_atividade", "cnae_principal", "desc_cnae_principal", "cnae_secundario",
    "tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep", "uf", "municipio", "desc_municipio",
    "ddd_1", "telefone_1", "ddd_2", "telefone_2", "ddd_fax", "fax", "email", "situacao_especial",
    "data_situacao_especial", "latitude", "longitude", "razao_social", "natureza_juridica", "desc_natureza_juridica",
    "qualificacao_responsavel", "desc_qualificacao_responsavel", "capital_social", "porte", "desc_porte",
    "ente_federativo_responsavel",
]

PARTNER_COLUMNS = [
    "nome_socio", "cpf_cnpj_socio", "identificador_socio", "desc_identificador_socio", "qualificacao_socio",
    "desc_qualificacao_socio", "data_entrada_sociedade", "faixa_etaria", "desc_faixa_etaria", "nome_representante",
    "qualificacao_representante", "desc_qualificacao_representante",
]

REGIME_AND_BAND_COLUMNS = [
    "opcao_simples", "data_opcao_simples", "data_exclusao_simples", "opcao_mei", "data_opcao_mei", "data_exclusao_mei",
    "tipo_simples_mei", "porte_empresa", "desc_porteempresa_corrigido", "faixa_faturamento_anual_ajustada",
    "faixa_idade_empresa", "regiao_geo", "uf_geo", "linha_unica",
]

NULLABLE_TEXT_COLUMNS = {
    "desc_cnae_principal",
    "desc_municipio",
    "desc_natureza_juridica",
    "desc_qualificacao_responsavel",
}

# Partner attribute in the pivot -> column of the partner feed.
PIVOT_SOURCES = {
    "nome_socio": "nome_socio_razao_social",
    "cpf_cnpj_socio": "cpf_cnpj_socio",
    "identificador_socio": "identificador_socio",
    "qualificacao_socio": "qualificacao_socio",
    "data_entrada_sociedade": "data_entrada_sociedade",
    "faixa_etaria": "faixa_etaria",
    "nome_representante": "nome_representante",
    "qualificacao_representante": "qualificacao_representante_legal",
}

# Lookup table -> its code and description columns.
LOOKUP_COLUMNS = {
    "dict_cnae": ("codigo_cnae", "descricao_cnae"),
    "dict_municipios": ("codigo_municipios", "descricao_municipios"),
    "dict_naturezas": ("codigo_natureza_juridica", "descricao_natureza_juridica"),
    "dict_qualificacoes": ("codigo_qualificacao_socio", "descricao_qualificacao_socio"),
    "dict_qualificacao_socio": ("codigo_qualificacao_socio", "descricao_qualificacao_socio"),
    "dict_faixa_etaria": ("codigo", "descricao"),
}
SIZE_OVERRIDE_TABLE = "empresa_faixas_opt"
