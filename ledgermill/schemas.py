"""Declared schemas of the layer tables."""

from pyspark.sql import types as T


_KINDS = {
    "bigint": T.LongType(), "boolean": T.BooleanType(), "date": T.DateType(), "double": T.DoubleType(),
    "string": T.StringType(),
}


def _table(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in columns.items()])


# Raw feeds are read as text; cleaning decides what a cell means.
RAW = {
    "PS_Meta2025": ["mes_meta", "meta"],
    "PS_Categoria": ["codigo_categoria", "nome_categoria", "tipo_categoria"],
    "PS_Cliente": ["id_cliente", "nome_cliente", "pais_cliente", "data_cadastro_cliente"],
    "PS_Conta_Pagar": [
        "id_conta", "descricao_conta", "destino_pagamento_conta", "codigo_categoria", "valor_conta",
        "data_vencimento", "data_pagamento", "status_conta",
    ],
    "PS_Conta_Receber": [
        "id_conta", "descricao_conta", "id_cliente", "codigo_categoria", "valor_conta",
        "data_vencimento", "data_pagamento",
    ],
}

RATES = _table(moeda="string", data="date", cotacao_compra="double", cotacao_venda="double")

# The rates service's answer for one currency and period.
RATE_PAYLOAD = T.StructType([T.StructField("value", T.ArrayType(
    _table(cotacaoCompra="double", cotacaoVenda="double", dataHoraCotacao="string")
))])

SILVER = {
    "meta_2025_silver": _table(
        mes_ano_meta="date", meta_valor="double", mes="bigint", ano="bigint", nome_mes="string"
    ),
    "categoria_silver": _table(codigo_categoria="string", nome_categoria="string", tipo_categoria="string"),
    "cliente_silver": _table(
        id_cliente="bigint", nome_cliente="string", pais_cliente="string", moeda_pais="string",
        data_cadastro_cliente="date",
    ),
    "conta_pagar_silver": _table(
        id_conta="bigint", descricao_conta="string", destino_pagamento_conta="string", codigo_categoria="string",
        observacao_conta="string", valor_conta="double", valor_conta_brl="double", data_vencimento="date",
        data_pagamento="date", status_conta="string",
    ),
    "conta_receber_silver": _table(
        id_conta="bigint", descricao_conta="string", id_cliente="bigint", codigo_categoria="string",
        observacao_conta="string", valor_conta="double", valor_conta_brl="double", data_vencimento="date",
        data_pagamento="date", status_conta="string",
    ),
}

GOLD = {
    "dim_cliente": _table(
        id_cliente="bigint", nome_cliente="string", pais_cliente="string", moeda_pais="string",
        data_cadastro_cliente="date",
    ),
    "dim_categoria": _table(
        sk_categoria="bigint", codigo_categoria="string", nome_categoria="string", tipo_categoria="string"
    ),
    "dim_data": _table(
        sk_data="bigint", data_calendario="date", ano="bigint", trimestre="bigint", mes="bigint", nome_mes="string",
        dia="bigint", dia_semana_num="bigint", nome_dia_semana="string", fim_de_semana="boolean",
    ),
    "dim_moeda": _table(sk_moeda="bigint", codigo_moeda="string"),
    "fato_conta_receber": _table(
        id_conta_receber="bigint", id_cliente="bigint", sk_categoria="bigint", sk_moeda="bigint",
        sk_data_pagamento="bigint", sk_data_vencimento="bigint", valor_conta="double", valor_conta_brl="double",
        status_conta="string", observacao_conta="string",
    ),
    "fato_conta_pagar": _table(
        id_conta_pagar="bigint", sk_categoria="bigint", sk_moeda="bigint", sk_data_pagamento="bigint",
        sk_data_vencimento="bigint", valor_conta="double", valor_conta_brl="double", status_conta="string",
        destino_pagamento_conta="string", observacao_conta="string",
    ),
    "fato_meta_mensal": _table(
        sk_fato_meta="bigint", sk_data_referencia="bigint", meta_valor="double", mes="bigint", ano="bigint",
        nome_mes="string",
    ),
}

# Key columns by which append loads recognise rows the target already holds, dimensions first.
GOLD_KEYS = {
    "dim_cliente": ["id_cliente"],
    "dim_categoria": ["codigo_categoria"],
    "dim_data": ["data_calendario"],
    "dim_moeda": ["codigo_moeda"],
    "fato_conta_receber": ["id_conta_receber"],
    "fato_conta_pagar": ["id_conta_pagar"],
    "fato_meta_mensal": ["ano", "mes"],
}

# Keys of the star schema: what may not repeat, and where foreign keys must be found.
GOLD_UNIQUE = {
    "pk dim_cliente": ("dim_cliente", "id_cliente"),
    "pk dim_categoria": ("dim_categoria", "sk_categoria"),
    "uk dim_categoria": ("dim_categoria", "codigo_categoria"),
    "pk dim_data": ("dim_data", "sk_data"),
    "pk dim_moeda": ("dim_moeda", "sk_moeda"),
    "uk dim_moeda": ("dim_moeda", "codigo_moeda"),
    "pk fato_conta_receber": ("fato_conta_receber", "id_conta_receber"),
    "pk fato_conta_pagar": ("fato_conta_pagar", "id_conta_pagar"),
    "pk fato_meta_mensal": ("fato_meta_mensal", "sk_fato_meta"),
}
GOLD_FOREIGN = {
    "fk receber cliente": ("fato_conta_receber", "id_cliente", "dim_cliente", "id_cliente"),
    "fk receber categoria": ("fato_conta_receber", "sk_categoria", "dim_categoria", "sk_categoria"),
    "fk receber moeda": ("fato_conta_receber", "sk_moeda", "dim_moeda", "sk_moeda"),
    "fk receber pagamento": ("fato_conta_receber", "sk_data_pagamento", "dim_data", "sk_data"),
    "fk receber vencimento": ("fato_conta_receber", "sk_data_vencimento", "dim_data", "sk_data"),
    "fk pagar categoria": ("fato_conta_pagar", "sk_categoria", "dim_categoria", "sk_categoria"),
    "fk pagar moeda": ("fato_conta_pagar", "sk_moeda", "dim_moeda", "sk_moeda"),
    "fk pagar pagamento": ("fato_conta_pagar", "sk_data_pagamento", "dim_data", "sk_data"),
    "fk pagar vencimento": ("fato_conta_pagar", "sk_data_vencimento", "dim_data", "sk_data"),
    "fk meta data": ("fato_meta_mensal", "sk_data_referencia", "dim_data", "sk_data"),
}

# Quality of the candidate models.
MODEL_METRICS = _table(
    model_name="string", n_clusters="bigint", noise_ratio="double", silhouette="double", davies_bouldin="double",
    calinski_harabasz="double",
)
