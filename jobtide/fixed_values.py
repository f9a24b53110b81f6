"""Values that decide results: code tables, layouts, word lists and constants.

Everything here is plain data. Functions take these as default arguments, so another scope, salary table or
value contract can be passed in without touching the code.
"""

from __future__ import annotations

# --- Fixed values: state codes of the flow file. 99 stands for "not identified". -------------------------------
STATE_BY_CODE = {
    "11": "RO", "12": "AC", "13": "AM", "14": "RR", "15": "PA", "16": "AP", "17": "TO",
    "21": "MA", "22": "PI", "23": "CE", "24": "RN", "25": "PB", "26": "PE", "27": "AL", "28": "SE", "29": "BA",
    "31": "MG", "32": "ES", "33": "RJ", "35": "SP",
    "41": "PR", "42": "SC", "43": "RS",
    "50": "MS", "51": "MT", "52": "GO", "53": "DF",
    "99": "NI",
}
UNIDENTIFIED_STATE = "NI"
UNIDENTIFIED_STATE_CODE = "99"

# The same codes are the first two digits of a municipality code; there 99 is not a prefix.
STATE_BY_MUNICIPALITY_PREFIX = {c: s for c, s in STATE_BY_CODE.items() if c != UNIDENTIFIED_STATE_CODE}

# --- Fixed values: states of each region. ----------------------------------------------------------------------
STATES_OF_REGION = {
    "Norte": ["RO", "AC", "AM", "RR", "PA", "AP", "TO"],
    "Nordeste": ["MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"],
    "Sudeste": ["MG", "ES", "RJ", "SP"],
    "Sul": ["PR", "SC", "RS"],
    "Centro-Oeste": ["MS", "MT", "GO", "DF"],
}

# --- Fixed values: residual municipality. ----------------------------------------------------------------------
RESIDUAL_MUNICIPALITY = "999999"
RESIDUAL_MUNICIPALITY_NAME = "Não identificado"

# --- Fixed values: flow layout (normalised header names). ------------------------------------------------------
FLOW_REQUIRED_HEADERS = {
    "competenciamov", "uf", "municipio", "saldomovimentacao", "cbo2002ocupacao", "tipomovimentacao", "salario",
}
FLOW_COLUMN_NAMES = {
    "competenciamov": "competencia_mov",
    "regiao": "regiao_codigo",
    "uf": "uf_codigo",
    "municipio": "municipio_codigo_caged",
    "secao": "cnae_secao",
    "subclasse": "cnae_subclasse",
    "saldomovimentacao": "saldo_movimentacao",
    "categoria": "categoria",
    "cbo2002ocupacao": "cbo_codigo",
    "graudeinstrucao": "grau_instrucao",
    "idade": "idade",
    "horascontratuais": "horas_contratuais",
    "racacor": "raca_cor",
    "sexo": "sexo",
    "tipoempregador": "tipo_empregador",
    "tipoestabelecimento": "tipo_estabelecimento",
    "tipomovimentacao": "tipo_movimentacao",
    "tipodedeficiencia": "tipo_deficiencia",
    "indtrabintermitente": "indicador_trabalho_intermitente",
    "indtrabparcial": "indicador_trabalho_parcial",
    "salario": "salario_mensal",
    "tamestabjan": "tamanho_estabelecimento_janeiro",
    "indicadoraprendiz": "indicador_aprendiz",
    "origemdainformacao": "origem_informacao",
    "competenciadec": "competencia_declarada",
    "competenciaexc": "competencia_exclusao",
    "indicadordeexclusao": "indicador_exclusao",
    "indicadordeforadoprazo": "indicador_fora_prazo",
    "unidadesalariocodigo": "unidade_salario_codigo",
    "valorsalariofixo": "valor_salario_fixo",
}
FLOW_NULL_TOKENS = ["", "NA", "N/A"]
MOVEMENT_LABELS = {1: "admissao", -1: "desligamento"}

# --- Fixed values: adjustment kinds and the months each kind may carry, in order of preference. -----------------
ADJUSTMENT_FACTOR = {"FOR": 1, "EXC": -1}
EFFECTIVE_MONTH_COLUMNS = {
    "FOR": ["competencia_mov", "competencia_declarada"],
    "EXC": ["competencia_mov", "competencia_declarada", "competencia_exclusao"],
}

# --- Fixed values: occupation scope, version 2. ----------------------------------------------------------------
OCCUPATION_FAMILIES = {
    "2122": "Engenheiros em computação",
    "2123": "Administradores de tecnologia da informação",
    "2124": "Analistas de tecnologia da informação",
    "3171": "Técnicos de desenvolvimento de sistemas e aplicações",
    "3172": "Técnicos em operação e monitoração de computadores",
}

# --- Fixed values: salary rule of hires. -----------------------------------------------------------------------
MINIMUM_WAGE_BY_YEAR = {2026: 1621.00}
SALARY_MINIMUM_MULTIPLE = 0.3
SALARY_MAXIMUM_MULTIPLE = 150.0
INTERMITTENT_WORDS = ["1", "1.0", "true", "sim", "s"]

# --- Fixed values: annual layout contract (concept -> accepted normalised headers). -----------------------------
STOCK_REQUIRED_ALIASES = {
    "cbo_occupation": [
        "cbo_2002_ocupacao_codigo", "cbo_ocupacao_2002", "cbo_2002_ocupacao", "cbo_ocupacao", "cbo",
    ],
    "municipality": ["municipio_codigo", "municipio", "municipio_estabelecimento"],
    "active_3112": [
        "ind_vinculo_ativo_31_12_codigo", "vinculo_ativo_31_12", "vinculo_ativo_3112", "emp_em_31_12",
        "emprego_em_31_12",
    ],
    "abandoned_link": ["ind_vinculo_abandonado_codigo", "vinculo_abandonado", "ind_vinculo_abandonado"],
}
STOCK_OPTIONAL_ALIASES = {
    "work_municipality": ["municipio_trab_codigo", "municipio_trabalho", "mun_trab"],
    "december_remuneration_nominal": [
        "vl_rem_dezembro_nom", "vl_remun_dezembro_nom", "remuneracao_dezembro_nominal", "remuneracao_dezembro",
    ],
    "mean_remuneration_nominal": [
        "vl_rem_media_nom", "vl_remun_media_nom", "remuneracao_media_nominal", "remuneracao_media",
    ],
}

# --- Fixed values: annual value contract. ----------------------------------------------------------------------
ACTIVE_VALUES = ["1"]
INACTIVE_VALUES = ["0"]
ABANDONED_ELIGIBLE_VALUES = ["0"]
ABANDONED_EXCLUDED_VALUES = ["1"]

# --- Fixed values: annual reject reasons, in reporting order. ---------------------------------------------------
STOCK_REJECT_REASONS = [
    "invalid_active_status", "invalid_abandoned_status", "invalid_cbo", "invalid_municipality", "invalid_uf",
]
STOCK_COUNTERS = [
    "rows_read", "rows_valid", "rows_rejected", "rows_active", "rows_inactive", "rows_active_source",
    "rows_abandoned_source", "rows_stock_eligible_source", "rows_unknown_abandoned_source", "rows_inactive_source",
    "rows_unknown_status_source", "rows_year_mismatch_source", "rows_residual_municipality", "rows_tech",
]
EXPECTED_PARTS_BY_YEAR = {2025: 7}

# --- Fixed values: annual files and header rules. ---------------------------------------------------------------
STOCK_SUFFIXES = [".comt", ".txt", ".csv"]
HEADER_ENCODINGS = ["utf-8-sig", "utf-8", "latin-1"]
HEADER_DELIMITERS = [";", "|", "\t", ","]
HEADER_MINIMUM_COLUMNS = 5

# --- Fixed values: reference dimensions. ------------------------------------------------------------------------
POPULATION_NULL_MARKS = ["", "-", "..", "...", "x", "X"]
POPULATION_MINIMUM_ENTRIES = 5000
POPULATION_EXPECTED_ENTRIES = 5571
MUNICIPALITY_MINIMUM_ENTRIES = 5000

# --- Fixed values: publication. ---------------------------------------------------------------------------------
MINIMUM_VALID_RATE = 0.99
PUBLISHED_YEAR_RANGE = (1985, 2100)
TOLERATED_BEFORE_ENRICHMENT = [
    "municipality_population_metadata", "municipality_population_report", "manual_methodology_approval",
]
UTF8_BOM = "\ufeff"
FORMULA_STARTERS = ["=", "+", "-", "@"]
