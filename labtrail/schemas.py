"""Column contracts: explicit types for every table the operators read or write."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# --- fixed values: field names of the nested sample document -------------------------------------------
SAMPLE_FIELDS = (
    "idAmostra",
    "nomeAmostra",
    "descricaoAmostra",
    "matriz",
    "DataHoraAmostragem",
    "codigoQualidade",
    "frequencia",
    "laboratorio",
    "comentario",
    "parent",
    "dataEnvioLab",
    "dataRecebLab",
    "profInicial",
    "profFinal",
    "composta",
    "coletada",
    "acreditacao",
    "legislacao",
    "finalidade",
    "campanha",
    "motivoNaoColeta",
    "dataLiberacao",
)
PARAMETER_FIELDS = (
    "parametroPadrao",
    "resultadoNumerico",
    "dataHoraAnalise",
    "resultadoTexto",
    "unidadePadrao",
    "qualifier",
    "limiteDeteccao",
    "limiteQuantificacao",
    "parametroOriginal",
    "resultadoOriginal",
    "unidadeOriginal",
    "metodoAnalise",
    "comentario",
    "tipoAnalise",
    "reportavel",
    "qaqcFlag",
    "acreditacaoMetodo",
)
CUSTODY_FIELDS = (
    "tipoAmostra",
    "coordenadas",
    "dataColeta",
    "metodoAmostragem",
    "dataRecebimentoAmostras",
    "temperaturaRecebimentoAmostra",
    "avaliacaoIntegridadeAmostra",
    "planoDeAmostra",
    "observacoes",
    "responsavelPelaColeta",
)
# Output names that differ from the document's field names.
SAMPLE_RENAMES = {"DataHoraAmostragem": "dataHoraAmostragem", "comentario": "comentario_amostra"}
PARAMETER_RENAMES = {"comentario": "comentario_parametro"}

STATION_CODE = "codigoEstacao"


def nested_schema(samples_field: str = "amostras", station_field: str = STATION_CODE) -> StructType:
    """Schema of a landed document. Scalars are read as text, so a number, a boolean or a string all fit."""
    site_note = StructType(
        [StructField("label", StringType()), StructField("value", ArrayType(StringType()))]
    )
    custody = StructType(
        [
            StructField("informacoes", strings(*CUSTODY_FIELDS)),
            StructField("avaliacoesDoLocal", ArrayType(site_note)),
        ]
    )
    sample = StructType(
        strings(station_field, *SAMPLE_FIELDS).fields
        + [
            StructField("parametros", ArrayType(strings(*PARAMETER_FIELDS))),
            StructField("cadeiaDeCustodia", custody),
        ]
    )
    return StructType([StructField(samples_field, ArrayType(sample))])


# --- fixed values: sheet layouts; each canonical key lists the accepted headers ------------------------
FLAT_COLUMNS = {
    "proposta": ["Proposta Comercial"],
    "nome": ["Identificacao", "Identificação"],
    "tipo": ["Tipo de Amostra"],
    "codigo": ["Codigo da Amostra", "Código da Amostra"],
    "coleta": ["Data de Coleta"],
    "recebimento": ["Data de Recebimento"],
    "publicacao": ["Data de Publicacao", "Data de Publicação"],
    "situacao": ["Situacao da Amostra", "Situação da Amostra"],
    "parametro": ["Identificacao da Analise", "Identificação da Análise"],
    "resultado": ["Resultado da Analise", "Resultado da Análise"],
    "unidade": ["Unidade de Medida da Analise", "Unidade de Medida da Análise"],
}
PAIR_SAMPLE_COLUMNS = {
    "ponto": ["Codigo Ponto"],
    "nome": ["Nome Amostra"],
    "codigo": ["Cod Amostra Lab"],
    "coleta": ["Data Coleta"],
    "tipo": ["Matriz Monit"],
    "recebimento": ["Data Recebimento Lab"],
    "proposta": ["Proposta Comercial"],
}
PAIR_SAMPLE_OPTIONAL = {
    "envio": ["Data Envio Lab"],
    "qualidade": ["Tipo Qualidade"],
    "comentario_amostra": ["Comentario"],
}
PAIR_ANALYSIS_COLUMNS = {
    "codigo": ["Cod Amostra Lab"],
    "parametro": ["Cod Parametro"],
    "resultado": ["Resultado Original"],
    "unidade": ["Unidade Original"],
    "analise": ["Data e Hora Analise"],
    "metodo": ["Metodo Analise"],
    "tipo_analise": ["Tipo Analise"],
    "limite": ["LQ"],
}
PAIR_ANALYSIS_OPTIONAL = {"comentario_parametro": ["Comentario"]}

# Columns both sheet layouts deliver.
SHEET_CANONICAL = (
    "campanha",
    "idAmostra",
    "nomeAmostra",
    "descricaoAmostra",
    "matriz",
    "dataHoraAmostragem",
    "dataRecebLab",
    "dataEnvioLab",
    "dataHoraAnalise",
    "dataLiberacao",
    "laboratorio",
    "parametroOriginal",
    "resultadoOriginal",
    "resultadoNumerico",
    "resultadoTexto",
    "qualifier",
    "unidadeOriginal",
    "OrigemArquivo",
    "codigoQualidade",
    "frequencia",
    "metodoAnalise",
    "limiteQuantificacao",
    "comentario_parametro",
    "comentario_amostra",
    "tipoAnalise",
)

# --- rule and dimension tables ---------------------------------------------------------------------------
STATION = strings("SampleName", STATION_CODE, "alternate_name", "codigoQualidade")
CORRECTIONS = strings(
    "descricaoAmostra_de", "descricaoAmostra_para", STATION_CODE, "alternate_name"
)
PARAMETER_LOOKUP = strings("parametro_de", "matriz_de", "parametro_para", "unidade_para")
SCOPE = strings("parametro", "matriz", "planejamento", "metodo", "prazo")
PLAN = StructType(
    [
        StructField("Station", StringType()),
        StructField("totalAmostrasPlanejado", IntegerType()),
        StructField("Planejamento", StringType()),
        StructField("Matriz", StringType()),
    ]
)

# --- run log ---------------------------------------------------------------------------------------------
LOG = StructType(
    [
        StructField("batch_ts", StringType()),
        StructField("projeto", StringType()),
        StructField("notebook", StringType()),
        StructField("ordem", IntegerType()),
        StructField("etapa", StringType()),
        StructField("status", StringType()),
        StructField("registros_lidos", LongType()),
        StructField("registros_escritos", LongType()),
        StructField("flags", StringType()),
        StructField("observacoes", StringType()),
        StructField("ts_registro", StringType()),
    ]
)

# --- fixed values: delivered table, in order, as (output column, column it comes from) -----------------
DELIVERED = (
    ("alternate_name", "alternate_name"),
    ("Station", STATION_CODE),
    ("sample_name", "descricaoAmostra_final"),
    ("sample_date", "dataHoraAmostragem_valida"),
    ("sample_date_received", "dataRecebLab_valida"),
    ("sample_date_sent", "dataEnvioLab_valida"),
    ("DataLiberacao", "dataLiberacao_valida"),
    ("AnalysisDate", "dataHoraAnalise_valida"),
    ("laboratory", "laboratorio"),
    ("quality_code", "codigoQualidade"),
    ("frequency", "frequencia"),
    ("quantification_limit", "limiteQuantificacaoCorrigido"),
    ("sample_comment", "comentario_amostra"),
    ("samp_matrix", "matriz"),
    ("chemical_name", "parametroCorrigido"),
    ("unit", "unidade_para"),
    ("value", "resultadoCorrigido"),
    ("qualifier", "qualifier"),
    ("sample_id", "idAmostra"),
    ("analysis_method", "metodoAnalise"),
    ("original_parameter", "parametroOriginal"),
    ("original_unit", "unidadeOriginal"),
    ("original_result", "resultadoOriginal"),
    ("text_result", "resultadoTexto"),
    ("comment", "flag_conversao"),
    ("result_comment", "comentario_parametro"),
    ("flag_parametro_fora_escopo", "flag_parametro_fora_escopo"),
    ("flag_metodo", "flag_metodo"),
    ("flag_holding_time", "flag_holding_time"),
    ("metodo_planejado", "metodo"),
    ("hodlgin_time_planejado", "prazo"),
    ("holding_time_executado", "diasDecorridos"),
    ("flag_station_sem_mapeamento", "flag_station_sem_mapeamento"),
    ("flag_padronizacao", "flag_padronizacao"),
)
# The sample this one replicates, for the replica check; delivered on request.
PARENT = ("parent", "parent")
