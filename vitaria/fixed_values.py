"""Fixed values of the three record systems.

Code lists, labels, column names and regions have to be exactly these for the
tables to come out right, so they are kept here as plain data and nowhere else.
Spelling in the labels is data and is left as it is.
"""

# --- fixed values: SIM (mortality) ------------------------------------------

SIM_DROP = [
    "ORIGEM", "ESC2010", "SERIESCFAL", "OCUP", "LINHAA", "LINHAB", "LINHAC",
    "LINHAD", "LINHAII", "DTRECORIGA", "ESCMAEAGR1", "ESCFALAGR1",
    "STDOEPIDEM", "STDONOVA", "DIFDATA", "CONTADOR", "DTRECEBIM",
    "VERSAOSIST", "CAUSABAS_O", "ATESTANTE", "STCODIFICA", "CODIFICADO",
    "VERSAOSCB", "NUMEROLOTE", "TPPOS", "CODMUNRES", "CODMUNNATU",
    "CODMUNOCOR", "ATESTADO",
]

SIM_RECODE = {
    "SEXO": {"0": "Ignorado", "1": "Homem", "2": "Mulher"},
    "TIPOBITO": {"1": "Fetal", "2": "Não Fetal"},
    "RACACOR": {"1": "Branca", "2": "Preta", "3": "Amarela", "4": "Parda", "5": "Indígena"},
    "ESTCIV": {
        "1": "Solteito", "2": "Casado", "3": "Viúvo",
        "4": "Separado Judicialmente", "9": "Ignorado",
    },
    "ESC": {
        "1": "Nenhuma", "2": "1 a 3 anos", "3": "4 a 7 anos",
        "4": "8 a 11 anos", "5": "12 a mais", "9": "Ignorado",
    },
    "LOCOCOR": {
        "1": "Hospital", "2": "Outro estado saúde", "3": "Domicílio",
        "4": "Via Pública", "5": "Outros", "9": "Ignorado",
    },
    "GRAVIDEZ": {"1": "Única", "2": "Dupla", "3": "Tripla e mais", "9": "Ignorado"},
    "SEMAGESTAC": {
        "1": "Menos de 22 semanas", "2": "22 a 27 semanas", "3": "28 a 31 semanas",
        "4": "32 a 36 semanas", "5": "37 a 41 semanas", "6": "42 semanas e mais",
        "9": "Ignorado",
    },
    "GESTACAO": {"1": "Vaginal", "2": "Cesáreo", "9": "Ignorado"},
    "PARTO": {"1": "Antes", "2": "Durante", "3": "Depois", "9": "Ignorado"},
    "OBITOPARTO": {"1": "Antes", "2": "Durante", "3": "Depois", "9": "Ignorado"},
    "OBITOGRAV": {"1": "Sim", "2": "Não", "9": "Ignorado"},
    "OBITOPUERP": {
        "1": "Sim até 42 dias", "2": "Sim, de 43 dias a 1 ano", "3": "Não", "9": "Ignorado",
    },
    "ASSISTMED": {"1": "Sim", "2": "Não", "9": "Ignorado"},
    "EXAME": {"1": "Sim", "2": "Não", "9": "Ignorado"},
    "CIRURGIA": {"1": "Sim", "2": "Não", "9": "Ignorado"},
    "NECROPSIA": {"1": "Sim", "2": "Não", "9": "Ignorado"},
}

SIM_RENAME = {
    "DTOBITO": "Data do Óbito",
    "HORAOBITO": "Hora do Óbito",
    "DTNASC": "Data de Nascimento",
    "TIPOBITO": "Tipo de Óbito",
    "NATURAL": "Naturalidade",
    "IDADE": "Idade",
    "SEXO": "Sexo",
    "RACACOR": "Raça/Cor",
    "ESTCIV": "Estado Civil",
    "ESC": "Escolaridade",
    "LOCOCOR": "Local da Ocorrência",
    "CODESTAB": "Hospital",
    "ASSISTMED": "Assintência Médica",
    "NECROPSIA": "Necrópsia",
    "CAUSABAS": "Causa Básica",
    "CAUSABAS_keep": "Categoria CID",
    "DTATESTADO": "Data do Atestado",
    "DTCADASTRO": "Data do Cadastro",
    "COMUNSVOIM": "Cidade do Paciente",
}

SIM_ICD_COLUMNS = ["CAUSABAS", "CAUSABAS_O"]
SIM_KEEP = ["CAUSABAS"]
SIM_AGE_COLUMN = "IDADE"

# --- fixed values: SIA (outpatient) -----------------------------------------

SIA_DROP = ["AP_ETNIA", "AP_MNDIF", "AP_MVM", "AP_TIPPRE", "AP_TPATEN", "AP_CNSPCN"]

SIA_RECODE = {
    "AP_CONDIC": {"EP": "Em processamento", "PG": "Pago"},
    "AP_SEXO": {"F": "Feminino", "M": "Masculino", "I": "Ignorado"},
    "AP_RACACOR": {
        "01": "Branca", "02": "Preta", "03": "Amarela",
        "04": "Parda", "05": "Indígena", "99": "Ignorado",
    },
    "RACA_COR": {
        "01": "Branca", "02": "Preta", "03": "Amarela",
        "04": "Parda", "05": "Indígena", "99": "Ignorado",
    },
    "AP_UFDIF": {"0": "Mesmo UF do estabelecimento", "1": "UF diferente do estabelecimento"},
    "AP_MNDIF": {"0": "Mesmo municipio", "1": "Municipio diferente"},
    "AP_TPAPAC": {"1": "Inicial", "2": "Continuidade", "3": "Unica"},
    "AP_OBITO": {"0": "Não", "1": "Sim"},
    "AP_ENCERR": {"0": "Não", "1": "Sim"},
    "AP_PERMAN": {"0": "Não", "1": "Sim"},
    "AP_ALTA": {"0": "Não", "1": "Sim"},
    "AP_TRANSF": {"0": "Não", "1": "Sim"},
}

SIA_RENAME = {
    "AP_CONDIC": "Condicao de pagamento",
    "AP_CMP": "Data de atendimento",
    "AP_MVM": "Data de processamento",
    "AP_CODUNI": "Codigo CNES",
    "AP_SEXO": "Sexo",
    "AP_RACACOR": "Raça/Cor",
    "AP_OBITO": "Obito",
    "AP_ENCERR": "Encerramento do tratamento",
    "AP_TRANSF": "Transferencia",
    "AP_MUNPCN": "Cidade do paciente",
}

SIA_DATES = ["AP_CMP", "AP_MVM", "AP_DTINIC", "AP_DTFIM", "AP_DTOCOR", "AP_DTSOLIC", "AP_DTAUT"]

# --- fixed values: SIH (hospital admissions) --------------------------------

SIH_DROP = [
    "ANO_CMPT", "MES_CMPT", "UTI_MES_IN", "UTI_MES_AN", "UTI_MES_AL",
    "UTI_INT_IN", "UTI_INT_AN", "UTI_INT_AL", "VAL_SADT", "VAL_RN",
    "VAL_ACOMP", "VAL_ORTP", "VAL_SANGUE", "VAL_SADTSR", "VAL_TRANSP",
    "VAL_OBSANG", "VAL_PED1AC", "DIAG_SECUN", "NATUREZA", "RUBRICA",
    "NUM_PROC", "TOT_PT_SP", "CPF_AUT", "GESTOR_DT", "INFEHOSP", "CID_ASSO",
    "CID_MORTE", "VAL_SH_GES", "VAL_SP_GES", "DIAGSEC8", "DIAGSEC9",
    "TPDISEC8", "TPDISEC9",
]

SIH_RECODE = {}

SIH_RENAME = {
    "CGC_HOSP": "CNPJ do Hospital",
    "ANO_CMPT": "Data de Processamento",
    "N_AIH": "Número da AIH",
    "MUNIC_RES": "Cidade do Paciente",
    "NASC": "Data de Nascimento",
    "SEXO": "Sexo",
    "DT_INTER": "Data de Inicio",
    "DT_SAIDA": "Data de Fim",
    "DIAG_PRINC": "Causa Básica",
    "DIAG_PRINC_keep": "Categoria CID",
    "MUNIC_MOV": "Cidade do Hospital",
    "IDADE": "Idade",
    "MORTE": "Obito",
    "INSTRU": "Escolaridade",
    "CNPJ_MANT": "CNPJ do Hospital",
    "RACA_COR": "Raça/Cor",
    "DIAGSEC1": "Causa Secundaria",
    "DIAGSEC1_keep": "Categoria CID Secundaria",
}

SIH_DATES = ["SP_DTINTER", "SP_DTSAIDA", "DT_INTER", "DT_SAIDA", "NASC"]
SIH_KEEP = ["DIAG_PRINC", "DIAGSEC1"]
SIH_YEARS = ["2020", "2021"]
YEAR_COLUMN = "ano_inter"

# --- fixed values: age code -------------------------------------------------

AGE_UNKNOWN = "Idade não relatada"
AGE_UNDER_ONE = "Menor de 1 ano, mas não se sabe o número de horas, dias ou meses"
AGE_INVALID = "Código inválido"
# position = first digit of the code; digit 5 counts years from 100 on
AGE_UNITS = ["minutos", "horas", "dias", "meses", "anos", "anos"]

# --- fixed values: regions --------------------------------------------------

REGIONS = {
    "SUL": ["PR", "SC", "RS"],
    "SUDESTE": ["SP", "RJ", "MG", "ES"],
    "CENTRO_OESTE": ["DF", "GO", "MT", "MS"],
    "NORDESTE": ["MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"],
    "NORTE": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
}

# --- fixed values: report and catalog fields --------------------------------

AUDIT_FILE = "Arquivo"
AUDIT_ROWS = "Número de Registros"
AUDIT_COLUMNS = "Colunas"

PROCESS_NAME = "{step} do arquivo {dataset}"
PROCESS_DESCRIPTION = "Transformação de {step}"
