"""Raw text tables of the housing programmes and how each column is typed (P30, P38).

A row is the raw names, which are tried in turn, the typed name and its type. Rows of a type stand together. The names are
fixed values: they are those of the files that the lender sends and of the models' columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from marajo.functions import cleaning as C

Typer = Callable[[Column], Column]

#: A column of a table: raw names, typed name, type.
Row = tuple[list[str], str, str]

TYPES: dict[str, Typer] = {
    "key": C.normalize_key,
    "text": C.clean_text,
    "trimmed": F.trim,
    "text_none": lambda c: C.clean_text(c, none=True),
    "tax_id": C.digits,
    "int": C.parse_int,
    "number": lambda c: C.parse_numeric(c, "double"),
    "percent": lambda c: C.parse_numeric(c, "decimal(6,2)"),
    "degrees": lambda c: C.parse_numeric(c, "decimal(12,8)"),
    "money": C.parse_financial,
    "date": C.parse_date_br,
    "flag": C.flag_s,
    "audit": lambda c: c,
}

#: Programme A's raw tables. Fixed values.
A: dict[str, list[Row]] = {
    "register": [
        (["nu_apf"], "apf", "key"),
        (["no_identificacao_proposta"], "id_proposta", "text"),
        (["no_agente_financeiro"], "agente_financeiro", "text"),
        (["no_empreendimento"], "empreendimento_nome", "text"),
        (["no_construtora"], "construtora_nome", "text"),
        (["co_ente_publico_proponente"], "co_ente_publico", "text"),
        (["no_municipio"], "municipio", "text"),
        (["sg_uf"], "uf", "text"),
        (["co_municipio_ibge"], "cod_ibge", "text"),
        (["no_gps_datum"], "gps_datum", "text"),
        (["nu_cnpj_construtora"], "construtora_cnpj", "tax_id"),
        (["co_tipo_edificacao"], "co_tipo_edificacao", "int"),
        (["co_tipo_administracao"], "co_tipo_administracao", "int"),
        (["co_linha_atendimento"], "co_linha_atendimento", "int"),
        (["co_tipo_demanda"], "co_tipo_demanda", "int"),
        (["co_tipo_empreendimento"], "co_tipo_empreendimento", "int"),
        (["nu_qt_uh"], "qt_uh", "int"),
        (["nu_gps_latitude_grau"], "gps_lat_grau", "number"),
        (["nu_gps_latitude_minuto"], "gps_lat_minuto", "number"),
        (["nu_gps_latitude_segundo"], "gps_lat_segundo", "number"),
        (["nu_gps_longitude_grau"], "gps_long_grau", "number"),
        (["nu_gps_longitude_minuto"], "gps_long_minuto", "number"),
        (["nu_gps_longitude_segundo"], "gps_long_segundo", "number"),
        (["vr_emprestimo_far"], "vr_emprestimo_far", "money"),
        (["vr_total_contrapartidas"], "vr_contrapartida_ente_publico", "money"),
        (["vr_total_investimento"], "vr_total_investimento", "money"),
        (["vr_obra_edificacao"], "vr_obra_edificacao", "money"),
        (["vr_terreno"], "vr_terreno", "money"),
        (["vr_ts"], "vr_trabalho_social", "money"),
        (["vr_equipamento_uso_comum"], "vr_equipamento_uso_comum", "money"),
        (["vr_legalizacao_empreendimento"], "vr_legalizacao", "money"),
        (["vr_seguros_obrigatorios"], "vr_seguro_obrigatorio", "money"),
        (["dt_contratacao"], "dt_contratacao", "date"),
        (["dt_inicio_obra"], "dt_inicio_obra", "date"),
        (["dt_previsao_conclusao_obra"], "dt_previsao_conclusao", "date"),
        (["dt_apresentacao_orcamento"], "dt_apresentacao_orcamento", "date"),
        (["dt_movimento"], "dt_movimento", "date"),
        (["ic_terreno_doado"], "ic_terreno_doado", "flag"),
        (["ic_sistema_aquec_solar"], "ic_aquecimento_solar", "flag"),
        (["ic_energia_alternativa"], "ic_energia_alternativa", "flag"),
        (["ic_previsao_area_comercial"], "ic_area_comercial", "flag"),
        (["arquivo_de_origem"], "arquivo_de_origem", "audit"),
        (["criado_em"], "criado_em", "audit"),
    ],
    "proposals": [
        (["no_identificacao_proposta"], "id_proposta", "trimmed"),
        (["nu_apf"], "apf", "key"),
        (["nu_operacao_af"], "nu_operacao_af", "text"),
        (["nu_portaria_contratacao"], "portaria_contratacao", "text"),
        (["no_proponente"], "proponente_nome", "text"),
        (["no_tomador"], "tomador_nome", "text"),
        (["no_empreendimento_contratacao", "no_nome_empreendimento"], "empreendimento_nome", "text"),
        (["no_agente_financeiro"], "agente_financeiro", "text"),
        (["no_municipio"], "municipio", "text"),
        (["no_uf"], "uf", "text"),
        (["no_regiao"], "regiao", "text"),
        (["co_municipio_ibge"], "cod_ibge", "text"),
        (["no_logradouro_empreendimento"], "logradouro", "text"),
        (["no_bairro"], "bairro", "text"),
        (["co_cep"], "cep", "text"),
        (["nu_cnpj_proponente"], "proponente_cnpj", "tax_id"),
        (["nu_cnpj_tomador"], "tomador_cnpj", "tax_id"),
        (["co_situacao_proposta_contratada"], "co_situacao_contratada", "int"),
        (["co_situacao_proposta_protocolizada"], "co_situacao_protocolizada", "int"),
        (["co_fase"], "co_fase", "int"),
        (["co_etapa"], "co_etapa", "int"),
        (["co_status"], "co_status", "int"),
        (["co_tipo_de_proponente"], "co_tipo_proponente", "int"),
        (["co_tipo_edificacao"], "co_tipo_edificacao", "int"),
        (["nu_qt_uh_empreendimento_contratacao", "nu_qt_uh_empreendimento"], "qt_uh", "int"),
        (["co_tipo_de_demanda"], "co_tipo_demanda", "int"),
        (["co_originacao_empreendimento"], "co_originacao", "int"),
        (["vr_empreendimento_far"], "valor_far", "money"),
        (["vr_total_contrapartidas"], "valor_contrapartidas", "money"),
        (["ic_energia_eletrica_iluminacao_publica"], "ic_energia_eletrica", "flag"),
        (["ic_agua_potavel"], "ic_agua_potavel", "flag"),
        (["ic_rede_esgoto_coleta_lixo"], "ic_esgoto", "flag"),
        (["ic_via_pavimentada"], "ic_via_pavimentada", "flag"),
        (["ic_drenagem_pluvial"], "ic_drenagem", "flag"),
        (["ic_educacao_infantil"], "ic_educacao_infantil", "flag"),
        (["ic_unidade_saude_ubs"], "ic_saude_ubs", "flag"),
        (["ic_terreno_doado"], "ic_terreno_doado", "flag"),
        (["dt_protocolo"], "dt_protocolo", "date"),
        (["dt_recebimento_gfar"], "dt_recebimento_gfar", "date"),
        (["dt_movimento"], "dt_movimento", "date"),
        (["dt_vencimento_portaria_contratacao"], "dt_vencimento_portaria", "date"),
        (["arquivo_de_origem"], "arquivo_de_origem", "audit"),
        (["criado_em"], "criado_em", "audit"),
    ],
    "priority": [
        (["apf"], "apf", "text"),
        (["agente_financeiro"], "agente_financeiro", "text"),
        (["nome_empreendimento"], "empreendimento_nome", "text"),
        (["uf"], "uf", "text"),
        (["municipio"], "municipio", "text"),
        (["codigo_ibge_do_municipio"], "cod_ibge", "text"),
        (["modalidade"], "modalidade", "text"),
        (["situacao_do_empreendimento"], "situacao", "text"),
        (["detalhamento_da_situacao_do_empreendimento"], "situacao_detalhamento", "text"),
        (["logradouro_do_imovel"], "logradouro", "text"),
        (["bairro_do_imovel"], "bairro", "text"),
        (["cep_do_imovel"], "cep", "text"),
        (["observacoes"], "observacoes", "text"),
        (["percentual_exec"], "pct_execucao", "percent"),
        (["valor_contratado"], "valor_contratado", "money"),
        (["valor_aporte_adicional"], "valor_aporte_adicional", "money"),
        (["valor_desembolsado"], "valor_desembolsado", "money"),
        (["valor_desembolsado_do_ano_de_referencia"], "valor_desembolsado_ano", "money"),
        (["uh_contratadas"], "uh_contratadas", "int"),
        (["uh_entregues"], "uh_entregues", "int"),
        (["uh_vigentes"], "uh_vigentes", "int"),
        (["unidades_habitacionais_a_serem_entregues"], "uh_a_entregar", "int"),
        (["quantidade_de_uhs_distratadas"], "uh_distratadas", "int"),
        (["data_de_contratacao"], "dt_contratacao", "date"),
        (["data_da_previsao_da_entrega"], "dt_previsao_entrega", "date"),
        (["data_de_movimento"], "dt_movimento", "date"),
        (["latitude_do_imovel"], "latitude", "degrees"),
        (["longitude_do_imovel"], "longitude", "degrees"),
        (["arquivo_de_origem"], "arquivo_de_origem", "audit"),
        (["criado_em"], "criado_em", "audit"),
    ],
    "disbursements": [
        (["nu_apf"], "apf", "key"),
        (["co_tipo_movimento"], "co_tipo_movimento", "int"),
        (["co_tipo_lib_recurso"], "co_tipo_lib_recurso", "int"),
        (["co_tipo_registro"], "co_tipo_registro", "text"),
        (["ic_credito"], "ic_credito", "text"),
        (["no_identificador"], "identificador", "text"),
        (["vr_liberado"], "vr_liberado", "money"),
        (["vr_movimento"], "vr_movimento", "money"),
        (["vr_pago_obra_empreendimento"], "vr_pago_obra", "money"),
        (["vr_pago_terreno"], "vr_pago_terreno", "money"),
        (["vr_pago_pts"], "vr_pago_trabalho_social", "money"),
        (["vr_pago_equipamentos_publicos"], "vr_pago_equipamentos", "money"),
        (["vr_pago_aporte_suplementacao"], "vr_pago_aporte", "money"),
        (["vr_pago_despesas_manutencao"], "vr_pago_manutencao", "money"),
        (["vr_pago_despesas_incc"], "vr_pago_incc", "money"),
        (["vr_pago_cartorios_legalizacao"], "vr_pago_legalizacao", "money"),
        (["dt_movimento"], "dt_movimento", "date"),
        (["dt_liberacao_recurso"], "dt_liberacao", "date"),
        (["dt_remessa"], "dt_remessa", "date"),
        (["arquivo_de_origem"], "arquivo_de_origem", "audit"),
        (["criado_em"], "criado_em", "audit"),
    ],
    "works": [
        (["nu_apf"], "apf", "key"),
        (["co_situacao_obra"], "co_situacao_obra", "int"),
        (["qt_uh_concluidas_adaptadas"], "qt_uh_concluidas_adaptadas", "int"),
        (["qt_uh_alienada"], "qt_uh_alienadas", "int"),
        (["qt_uh_sem_habitese"], "qt_uh_sem_habitese", "int"),
        (["qt_uh_em_construcao_parcial"], "qt_uh_construcao_parcial", "int"),
        (["qt_uh_ociosas_retomadas"], "qt_uh_ociosas_retomadas", "int"),
        (["qt_unidades_habitacionais_invadidas"], "qt_uh_invadidas", "int"),
        (["nu_qt_uh_a_alienar"], "qt_uh_a_alienar", "int"),
        (["co_classificacao_paralisados"], "co_classificacao_paralisado", "int"),
        (["co_motivo_cancelamento_distrato"], "co_motivo_cancelamento", "int"),
        (["pc_obra_prevista"], "pct_obra_prevista", "percent"),
        (["pc_obra_realizada"], "pct_obra_realizada", "percent"),
        (["vr_total_uh_alienadas"], "vr_uh_alienadas", "money"),
        (["vr_total_uh_a_alienar"], "vr_uh_a_alienar", "money"),
        (["vr_total_uh_sem_habitese"], "vr_uh_sem_habitese", "money"),
        (["vr_total_uh_em_construcao"], "vr_uh_em_construcao", "money"),
        (["vr_total_uh_ociosas_retomadas"], "vr_uh_ociosas_retomadas", "money"),
        (["ic_invadido"], "ic_invadido", "flag"),
        (["no_providencias_adotadas"], "providencias_invasao", "text_none"),
        (["dt_alteracao_situacao"], "dt_alteracao_situacao", "date"),
        (["dt_invasao"], "dt_invasao", "date"),
        (["dt_paralisacao"], "dt_paralisacao", "date"),
        (["dt_previsao_conclusao_obra_retomada"], "dt_previsao_conclusao_retomada", "date"),
        (["dt_conclusao_obra_retomada"], "dt_conclusao_retomada", "date"),
        (["dt_conclusao_obra"], "dt_conclusao_obra", "date"),
        (["dt_repactuacao"], "dt_repactuacao", "date"),
        (["dt_legalizacao"], "dt_legalizacao", "date"),
        (["dt_previsao_entrega_do_empreendimento"], "dt_previsao_entrega", "date"),
        (["dt_entrega_do_empreendimento"], "dt_entrega", "date"),
        (["dt_primeira_assinatura_pf"], "dt_primeira_assinatura_pf", "date"),
        (["dt_ultima_assinatura_pf"], "dt_ultima_assinatura_pf", "date"),
        (["dt_acion_seguradora"], "dt_acionamento_seguradora", "date"),
        (["dt_contratacao_vigilancia"], "dt_contratacao_vigilancia", "date"),
        (["dt_contrata_construtor_substituto"], "dt_construtor_substituto", "date"),
        (["dt_movimento"], "dt_movimento", "date"),
        (["arquivo_de_origem"], "arquivo_de_origem", "audit"),
        (["criado_em"], "criado_em", "audit"),
    ],
}

#: Programme B's raw tables. Fixed values.
B: dict[str, list[Row]] = {
    "register": [
        (["nu_apf"], "apf", "key"),
        (["no_identificacao_proposta"], "id_proposta", "text"),
        (["no_agente_financeiro"], "agente_financeiro", "text"),
        (["no_empreendimento"], "empreendimento_nome", "text"),
        (["no_eo"], "eo_nome", "text"),
        (["no_substituicao_eo"], "eo_substituta_nome", "text"),
        (["no_construtora"], "construtora_nome", "text"),
        (["no_municipio"], "municipio", "text"),
        (["sg_uf"], "uf", "text"),
        (["co_municipio_ibge"], "cod_ibge", "text"),
        (["no_logradouro"], "logradouro", "text"),
        (["no_bairro"], "bairro", "text"),
        (["co_cep"], "cep", "text"),
        (["nu_gps_datum"], "gps_datum", "text"),
        (["nu_apf_aporte_suplementacao"], "apf_aporte", "text"),
        (["nu_apf_mudanca_fase"], "apf_mudanca_fase", "text"),
        (["nu_cnpj_eo"], "eo_cnpj", "tax_id"),
        (["nu_cnpj_substituicao_eo"], "eo_substituta_cnpj", "tax_id"),
        (["nu_cnpj_construtora"], "construtora_cnpj", "tax_id"),
        (["co_nivel_hab_eo"], "co_nivel_hab_eo", "int"),
        (["co_tipo_edificacao"], "co_tipo_edificacao", "int"),
        (["co_regime_obra"], "co_regime_obra", "int"),
        (["co_modalidade"], "co_modalidade", "int"),
        (["co_tipo_empreendimento"], "co_tipo_empreendimento", "int"),
        (["co_modalidade_projeto"], "co_modalidade_projeto", "int"),
        (["co_modalidade_obra"], "co_modalidade_obra", "int"),
        (["nu_qt_uh_construcao"], "qt_uh_construcao", "int"),
        (["nu_qt_uh_projeto"], "qt_uh_projeto", "int"),
        (["co_operacao_retomada"], "co_operacao_retomada", "int"),
        (["nu_gps_latitude_grau"], "gps_lat_grau", "number"),
        (["nu_gps_latitude_minuto"], "gps_lat_minuto", "number"),
        (["nu_gps_latitude_segundo"], "gps_lat_segundo", "number"),
        (["nu_gps_longitude_grau"], "gps_long_grau", "number"),
        (["nu_gps_longitude_minuto"], "gps_long_minuto", "number"),
        (["nu_gps_longitude_segundo"], "gps_long_segundo", "number"),
        (["nu_area_terreno"], "area_terreno", "number"),
        (["vr_financiamento_fds"], "vr_financiamento_fds", "money"),
        (["vr_total_contrapartidas"], "vr_total_contrapartidas", "money"),
        (["vr_total_investimento"], "vr_total_investimento", "money"),
        (["vr_total_operacao"], "vr_total_operacao", "money"),
        (["vr_terreno"], "vr_terreno", "money"),
        (["vr_ts"], "vr_trabalho_social", "money"),
        (["vr_equipamentos_publicos"], "vr_equipamentos_publicos", "money"),
        (["vr_equipamento_uso_comum"], "vr_equipamento_uso_comum", "money"),
        (["vr_infraestrutura_incidente"], "vr_infraestrutura", "money"),
        (["vr_legalizacao"], "vr_legalizacao", "money"),
        (["vr_regularizacao"], "vr_regularizacao", "money"),
        (["vr_seguros_obrigatorios"], "vr_seguros", "money"),
        (["vr_vigilancia_obra"], "vr_vigilancia", "money"),
        (["vr_contrapartida_estado_infra"], "vr_contrapartida_estado_infra", "money"),
        (["vr_contrapartida_estado_terreno"], "vr_contrapartida_estado_terreno", "money"),
        (["vr_contrapartida_estado_complementar"], "vr_contrapartida_estado_complementar", "money"),
        (["vr_contrapartida_municipio_infra"], "vr_contrapartida_municipio_infra", "money"),
        (["vr_contrapartida_municipio_terreno"], "vr_contrapartida_municipio_terreno", "money"),
        (["vr_contrapartida_municipio_complementar"], "vr_contrapartida_municipio_complementar", "money"),
        (["vr_contrapartida_outras"], "vr_contrapartida_outras", "money"),
        (["vr_contratado_aporte_suplementacao"], "vr_aporte_suplementacao", "money"),
        (["vr_total_em_construcao"], "vr_total_em_construcao", "money"),
        (["vr_total_em_projeto"], "vr_total_em_projeto", "money"),
        (["vr_sistema_alternativo_de_energia"], "vr_energia_alternativa", "money"),
        (["vr_sistema_aquecimento_solar"], "vr_aquecimento_solar", "money"),
        (["dt_substituicao_eo"], "dt_substituicao_eo", "date"),
        (["dt_contratacao_aporte_suplementacao"], "dt_aporte_suplementacao", "date"),
        (["dt_assinatura"], "dt_contratacao", "date"),
        (["dt_inicio_obra"], "dt_inicio_obra", "date"),
        (["dt_previsao_conclusao_obra"], "dt_previsao_conclusao", "date"),
        (["dt_apresentacao_orcamento"], "dt_apresentacao_orcamento", "date"),
        (["dt_inicio_obra_retomada"], "dt_inicio_obra_retomada", "date"),
        (["dt_previsao_conclusao_obra_retomada"], "dt_previsao_conclusao_retomada", "date"),
        (["dh_movimento"], "dt_movimento", "date"),
        (["ic_substituicao_eo"], "ic_substituicao_eo", "flag"),
        (["ic_terreno_doado"], "ic_terreno_doado", "flag"),
        (["ic_uniao_imovel"], "ic_uniao_imovel", "flag"),
        (["ic_sistema_aquec_solar"], "ic_aquecimento_solar", "flag"),
        (["ic_energia_alternativa"], "ic_energia_alternativa", "flag"),
        (["ic_previsao_area_comercial"], "ic_area_comercial", "flag"),
        (["ic_mudanca_fase"], "ic_mudanca_fase", "flag"),
        (["arquivo_de_origem"], "arquivo_de_origem", "audit"),
        (["criado_em"], "criado_em", "audit"),
    ],
    "deliveries": [
        (["apf"], "apf", "key"),
        (["agente_financeiro"], "agente_financeiro", "text"),
        (["qt_uh_entregues"], "qt_uh_entregues", "int"),
        (["dt_entrega"], "dt_entrega", "date"),
        (["data_de_movimento"], "dt_movimento", "date"),
        (["arquivo_de_origem"], "arquivo_de_origem", "audit"),
        (["criado_em"], "criado_em", "audit"),
    ],
    "disbursements": [
        (["nu_apf"], "apf", "key"),
        (["co_tipo_movimento"], "co_tipo_movimento", "int"),
        (["co_tipo_registro"], "co_tipo_registro", "text"),
        (["ic_credito"], "ic_credito", "text"),
        (["nu_identificador"], "identificador", "text"),
        (["vr_liberado"], "vr_liberado", "money"),
        (["vr_movimento"], "vr_movimento", "money"),
        (["vr_pago_obra_empreendimento"], "vr_pago_obra", "money"),
        (["vr_pago_terreno"], "vr_pago_terreno", "money"),
        (["vr_pago_trab_social"], "vr_pago_trabalho_social", "money"),
        (["vr_pago_projeto"], "vr_pago_projeto", "money"),
        (["vr_pago_aporte_suplementacao"], "vr_pago_aporte", "money"),
        (["vr_pago_despesas_incc"], "vr_pago_incc", "money"),
        (["vr_pago_cartorios_legalizacao"], "vr_pago_legalizacao", "money"),
        (["vr_pago_seguranca"], "vr_pago_seguranca", "money"),
        (["pc_evolucao"], "pct_evolucao", "percent"),
        (["dt_movimento"], "dt_movimento", "date"),
        (["dt_liberacao_recurso"], "dt_liberacao", "date"),
        (["dt_remessa"], "dt_remessa", "date"),
        (["dt_evento"], "dt_evento", "date"),
        (["arquivo_de_origem"], "arquivo_de_origem", "audit"),
        (["criado_em"], "criado_em", "audit"),
    ],
    "snapshot": [
        (["nu_apf"], "apf", "key"),
        (["no_empreeendmento"], "empreendimento_nome", "text"),
        (["no_selecao_pmcmv_e"], "selecao_pmcmv_e", "text"),
        (["situacao_gefus"], "situacao_gefus", "text"),
        (["fase_contrato"], "fase_contrato", "text"),
        (["situacao_empreendimento"], "situacao_empreendimento", "text"),
        (["razao_social_proponente"], "eo_nome", "text"),
        (["email_entidade"], "eo_email", "text"),
        (["no_municipio"], "municipio", "text"),
        (["sg_uf"], "uf", "text"),
        (["cod_municipio_ibge"], "cod_ibge", "text"),
        (["no_regiao"], "regiao", "text"),
        (["dsc_tipologia"], "tipologia", "text"),
        (["cod_regime_execucao"], "co_regime_execucao", "text"),
        (["regime_construcao"], "regime_construcao", "text"),
        (["modalidade_requalificacao"], "modalidade_requalificacao", "text"),
        (["tipo_de_unidade_do_empreendimento"], "tipo_unidade", "text"),
        (["terreno_doado"], "terreno_doado", "text"),
        (["tipo_terreno"], "tipo_terreno", "text"),
        (["aquecimento_solar"], "aquecimento_solar", "text"),
        (["infraestrutura_externa"], "infraestrutura_externa", "text"),
        (["cnpj_proponente"], "eo_cnpj", "tax_id"),
        (["qt_unidade_financiadas"], "qt_uh_financiadas", "int"),
        (["qt_unidades_concluidas"], "qt_uh_concluidas", "int"),
        (["qt_unidades_entregues"], "qt_uh_entregues", "int"),
        (["quantidade_uh_adaptadas"], "qt_uh_adaptadas", "int"),
        (["percentual_obra_realizado"], "pct_obra_realizado", "percent"),
        (["vr_emprestimo_original"], "vr_emprestimo_original", "money"),
        (["vlr_operacao"], "vr_operacao", "money"),
        (["vr_investimento"], "vr_investimento", "money"),
        (["vr_liberado"], "vr_liberado", "money"),
        (["vr_liberado_sisfin"], "vr_liberado_sisfin", "money"),
        (["vr_projeto"], "vr_projeto", "money"),
        (["vr_obra"], "vr_obra", "money"),
        (["valor_aporte_adicional"], "vr_aporte_adicional", "money"),
        (["valor_aporte_adicional_contratado"], "vr_aporte_contratado", "money"),
        (["dt_assinatura"], "dt_contratacao", "date"),
        (["dt_inicio_obra"], "dt_inicio_obra", "date"),
        (["dt_termino_obra"], "dt_termino_obra", "date"),
        (["dt_legalizacao"], "dt_legalizacao", "date"),
        (["dt_maxima_liberacao"], "dt_maxima_liberacao", "date"),
        (["dt_ultima_entrega"], "dt_ultima_entrega", "date"),
        (["dt_movimento"], "dt_movimento", "date"),
        (["gps_latitude_grau"], "gps_lat_grau", "number"),
        (["gps_latitude_minuto"], "gps_lat_minuto", "number"),
        (["gps_latitude_segundo"], "gps_lat_segundo", "number"),
        (["gps_longitude_grau"], "gps_long_grau", "number"),
        (["gps_longitude_minuto"], "gps_long_minuto", "number"),
        (["gps_longitude_segundo"], "gps_long_segundo", "number"),
        (["arquivo_de_origem"], "arquivo_de_origem", "audit"),
        (["criado_em"], "criado_em", "audit"),
    ],
    "works": [
        (["nu_apf"], "apf", "key"),
        (["co_situacao_operacao"], "co_situacao_operacao", "int"),
        (["co_andamento_operacao"], "co_andamento_operacao", "int"),
        (["qt_uh_concluidas"], "qt_uh_concluidas", "int"),
        (["qt_uh_concluidas_adaptadas"], "qt_uh_concluidas_adaptadas", "int"),
        (["qt_uh_alienada"], "qt_uh_alienadas", "int"),
        (["qt_uh_a_alienar"], "qt_uh_a_alienar", "int"),
        (["qt_uh_sem_habitese"], "qt_uh_sem_habitese", "int"),
        (["qt_uh_em_construcao_parcial"], "qt_uh_construcao_parcial", "int"),
        (["qt_uh_ociosas_retomadas"], "qt_uh_ociosas_retomadas", "int"),
        (["qt_uh_registro_titulos"], "qt_uh_registro_titulos", "int"),
        (["qt_uh_ocupacao_irregular"], "qt_uh_ocupacao_irregular", "int"),
        (["co_classificacao_paralisados"], "co_classificacao_paralisado", "int"),
        (["co_classificacao_nao_retomada"], "co_classificacao_nao_retomada", "int"),
        (["co_motivo_desimobilizacao"], "co_motivo_desimobilizacao", "int"),
        (["co_motivo_distrato_empreendimento"], "co_motivo_distrato", "int"),
        (["pc_obra_prevista"], "pct_obra_prevista", "percent"),
        (["pc_obra_realizada"], "pct_obra_realizada", "percent"),
        (["vr_total_uh_alienadas"], "vr_uh_alienadas", "money"),
        (["vr_total_uh_a_alienar"], "vr_uh_a_alienar", "money"),
        (["vr_total_uh_sem_habitese"], "vr_uh_sem_habitese", "money"),
        (["vr_total_uh_em_construcao"], "vr_uh_em_construcao", "money"),
        (["vr_total_uh_ociosas_retomadas"], "vr_uh_ociosas_retomadas", "money"),
        (["vr_vigilancia"], "vr_vigilancia", "money"),
        (["ic_titularidade_eo"], "ic_titularidade_eo", "flag"),
        (["ic_parcelam_gleba"], "ic_parcelamento_gleba", "flag"),
        (["ic_invadido"], "ic_invadido", "flag"),
        (["no_providencias_adotadas"], "providencias_invasao", "text_none"),
        (["detalhe_paralisacao_retomada"], "detalhe_paralisacao", "text_none"),
        (["dt_alteracao_situacao"], "dt_alteracao_situacao", "date"),
        (["dt_alteracao_andamento"], "dt_alteracao_andamento", "date"),
        (["dt_invasao"], "dt_invasao", "date"),
        (["dt_paralisacao"], "dt_paralisacao", "date"),
        (["dt_informacao_paralisacao_retomada"], "dt_info_paralisacao", "date"),
        (["dt_prev_conclusao_obra_retomada"], "dt_previsao_conclusao_retomada", "date"),
        (["dt_conclusao_obra_retomada"], "dt_conclusao_retomada", "date"),
        (["dt_conclusao_obra"], "dt_conclusao_obra", "date"),
        (["dt_legalizacao_reg"], "dt_legalizacao", "date"),
        (["dt_prev_entrega_emprend"], "dt_previsao_entrega", "date"),
        (["dt_entrega_do_empreendimento"], "dt_entrega", "date"),
        (["dt_primeira_assinatura_pf"], "dt_primeira_assinatura_pf", "date"),
        (["dt_ultima_assinatura_pf"], "dt_ultima_assinatura_pf", "date"),
        (["dt_contratacao_vigilancia"], "dt_contratacao_vigilancia", "date"),
        (["dh_movimento"], "dt_movimento", "date"),
        (["arquivo_de_origem"], "arquivo_de_origem", "audit"),
        (["criado_em"], "criado_em", "audit"),
    ],
    "social_work": [
        (["nu_apf"], "apf", "key"),
        (["co_situacao_trabalho_social"], "co_situacao_trabalho_social", "int"),
        (["nu_portaria_ts"], "nu_portaria_ts", "text"),
        (["pct_execucao_ts"], "pct_execucao_ts", "percent"),
        (["dt_aprovacao_pts"], "dt_aprovacao_pts", "date"),
        (["dt_assinatura_convenio"], "dt_assinatura_convenio", "date"),
        (["dt_termino_convenio"], "dt_termino_convenio", "date"),
        (["dt_primeiro_relatorio"], "dt_primeiro_relatorio", "date"),
        (["dt_ultimo_relatorio"], "dt_ultimo_relatorio", "date"),
        (["dt_publ_portaria_ts"], "dt_publicacao_portaria", "date"),
        (["dh_movimento"], "dt_movimento", "date"),
        (["arquivo_de_origem"], "arquivo_de_origem", "audit"),
        (["criado_em"], "criado_em", "audit"),
    ],
}
