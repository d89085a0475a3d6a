"""DuckDB twins of the registered queries, written from the rules and not from the Spark code."""

from __future__ import annotations

from ..functions.fixed_values import CSV_MISSING, COUNTRY_CURRENCY, COUNTRY_SYNONYMS, MONTH_NAMES, NAME_PARTICLES, WEEKDAY_NAMES
from .queries import FEW_NAMES, MIX_NAMES, RATES_FROM, RATES_TO
from .tables import CATEGORIES, CLIENTS, MONTHS_SQL, PAYABLES, QUOTED_CURRENCIES, QUOTES, RECEIVABLES, TARGETS

ORD = "_ingest_order"


def _case(x: str, table: dict, default: str = "null") -> str:
    def q(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    return f"case {x} " + " ".join(f"when {q(k)} then {q(v)}" for k, v in table.items()) + f" else {default} end"


def _num(x: str) -> str:
    pattern = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
    return f"(case when regexp_full_match(trim({x}), '{pattern}') then cast(trim({x}) as double) end)"


def _id(x: str) -> str:
    return f"(case when {_num(x)} = floor({_num(x)}) then cast({_num(x)} as bigint) end)"


def _date(x: str, layouts: str, repair: bool = False) -> str:
    """Parse text whose shape matches one of the layouts y, d, m (year, day, month first)."""
    t = f"trim({x})"
    shapes = {
        "y": (r"\d{4}-\d{1,2}-\d{1,2}", "%Y-%m-%d", r"\d{4}-02-29", f"left({t}, 4)"),
        "d": (r"\d{1,2}/\d{1,2}/\d{4}", "%d/%m/%Y", r"29/02/\d{4}", f"right({t}, 4)"),
        "m": (r"\d{1,2}-\d{1,2}-\d{4}", "%m-%d-%Y", r"02-29-\d{4}", f"right({t}, 4)"),
    }
    arms = []
    for layout in layouts:
        shape, fmt, feb, year = shapes[layout]
        value = f"cast(try_strptime({t}, '{fmt}') as date)"
        if repair:
            value = f"coalesce({value}, case when regexp_full_match({t}, '{feb}') then" \
                    f" make_date(cast({year} as int), 2, 28) end)"
        arms.append(f"when regexp_full_match({t}, '{shape}') then {value}")
    return f"(case {' '.join(arms)} end)"


def _first(key: str, order: str, source: str, columns: str = "*") -> str:
    return f"select {columns} from {source} qualify row_number() over (partition by {key} order by {order}) = 1"


def _bytes(x: str) -> str:
    return f"array_to_string(list_transform(string_split({x}, ''), lambda c: printf('%02X', unicode(c))), '')"


def _repaired(x: str) -> str:
    return (
        f"(case when regexp_matches({x}, '[ÃÂ]') and not regexp_matches({x}, '[^\\x{{00}}-\\x{{FF}}]')"
        f" then coalesce(try(decode(unhex({_bytes(x)}))), {x}) else {x} end)"
    )


_PARTICLES = ", ".join(f"'{p}'" for p in NAME_PARTICLES)
_TITLE = (
    "array_to_string(list_transform(string_split(lower(n2), ' '),"
    f" lambda w: case when w in ({_PARTICLES}) then w else upper(left(w, 1)) || substr(w, 2) end), ' ')"
)

_MONTHS = {i + 1: m for i, m in enumerate(MONTH_NAMES)}
_TOKENS = {t: i for i, m in _MONTHS.items() for t in (m, m[:3])}
_LABEL = "upper(strip_accents(trim({x})))"

CTE: dict[str, str] = {
    "r_clients": CLIENTS.sql(),
    "r_categories": CATEGORIES.sql(),
    "r_receivables": RECEIVABLES.sql(),
    "r_payables": PAYABLES.sql(),
    "r_quotes": QUOTES.sql(),
    "months": MONTHS_SQL,
    "r_targets": TARGETS.sql(),
    "s_clients": f"""
        select id_cliente, case when n2 <> '' then {_TITLE} end as nome_cliente,
               {_case('p2', COUNTRY_SYNONYMS, 'p2')} as pais_cliente, data_cadastro_cliente, {ORD}
        from (select {_id('id_cliente')} as id_cliente,
                     regexp_replace({_repaired('trim(nome_cliente)')}, '\\s+', ' ', 'g') as n2,
                     upper(strip_accents(regexp_replace({_repaired('trim(pais_cliente)')}, '\\s+', ' ', 'g'))) as p2,
                     {_date('data_cadastro_cliente', 'yd')} as data_cadastro_cliente, {ORD}
              from r_clients) where id_cliente is not null""",
    "clients": f"select id_cliente, nome_cliente, pais_cliente, {_case('pais_cliente', COUNTRY_CURRENCY)} as moeda_pais,"
               f" data_cadastro_cliente, {ORD} from s_clients",
    "l_categories": f"""
        select trim(codigo_categoria) as codigo_categoria,
               nullif(trim(regexp_replace({_LABEL.format(x='nome_categoria')}, '[^A-Z0-9]+', ' ', 'g')), '')
                   as nome_categoria,
               nullif(trim(regexp_replace({_LABEL.format(x='tipo_categoria')}, '[^A-Z0-9]+', ' ', 'g')), '')
                   as tipo_categoria, {ORD}
        from r_categories where nullif(trim(codigo_categoria), '') is not null""",
    "categories": _first("codigo_categoria", f"nome_categoria is null, tipo_categoria is null, {ORD}", "l_categories",
                         "codigo_categoria, nome_categoria, tipo_categoria"),
    "l_targets": "select *, translate(lower(trim(coalesce(mes_meta, ''))), 'çáàâãéêíóôõú', 'caaaaeeiooou') as t0"
                 " from r_targets",
    "targets": f"""
        select case when mes between 1 and 12 and ano is not null then make_date(ano, mes, 1) end as mes_ano_meta,
               meta_valor, cast(mes as bigint) as mes, cast(ano as bigint) as ano, {_case('mes', _MONTHS)} as nome_mes,
               {ORD}
        from (select cast(case when regexp_full_match(t, '\\d{{2}}/\\d{{4}}') then cast(left(t, 2) as int)
                          else {_case("regexp_extract(t, '[a-z]+')", _TOKENS)} end as int) as mes,
                     try_cast(regexp_extract(t, '\\d{{4}}') as int) as ano,
                     case when v like '%k' then {_num('left(v, length(v) - 1)')} * 1000 else {_num('v')} end
                         as meta_valor, {ORD}
              from (select replace(t0, '.', '') as t,
                           replace(replace(lower(trim(meta)), '.', ''), ',', '.') as v, {ORD} from l_targets))""",
    "payables": f"""
        select * from (
            select {_id('id_conta')} as id_conta, descricao_conta, destino_pagamento_conta, codigo_categoria,
                   observacao_conta, {_num('valor_conta')} as valor_conta, {_num('valor_conta')} as valor_conta_brl,
                   {_date('data_vencimento', 'ydm', True)} as data_vencimento,
                   {_date('data_pagamento', 'ydm', True)} as data_pagamento, status_conta, {ORD}
            from r_payables)
        where id_conta is not null and valor_conta is not null""",
    "b_receivables": f"""
        select * from (
            select {_id('id_conta')} as id_conta, descricao_conta, {_id('id_cliente')} as id_cliente, codigo_categoria,
                   cast(null as varchar) as observacao_conta, {_num('valor_conta')} as valor_conta,
                   {_date('data_vencimento', 'ydm', True)} as data_vencimento,
                   {_date('data_pagamento', 'ydm', True)} as data_pagamento, status as status_conta, {ORD}
            from r_receivables)
        where id_conta is not null and id_cliente is not null and valor_conta is not null""",
    "paid_months": f"""
        select distinct cast(date_trunc('month', d) as date) as mes
        from (select {_date('data_pagamento', 'ydm')} as d from r_receivables) where d is not null""",
    "days": f"""
        select * from (select cast(unnest(generate_series(mes, last_day(mes), interval 1 day)) as date) as data
                       from paid_months)
        where data between date '{RATES_FROM}' and date '{RATES_TO}'""",
    "l_quotes": f"select *, cast(left(data_hora_cotacao, 10) as date) as data from r_quotes"
                " where data_hora_cotacao is not null and data_hora_cotacao <> ''",
    "quotes": _first("moeda, data", f"data_hora_cotacao desc, {ORD}", "l_quotes",
                     "moeda, data, cotacao_compra, cotacao_venda"),
    "rates": f"""
        select * from (
            select g.moeda, g.data,
                   last_value(cotacao_compra ignore nulls) over w as cotacao_compra,
                   last_value(cotacao_venda ignore nulls) over w as cotacao_venda
            from (select unnest({QUOTED_CURRENCIES}) as moeda, data from days) g
            left join quotes q on q.moeda = g.moeda and q.data = g.data
            window w as (partition by g.moeda order by g.data rows between unbounded preceding and current row))
        where cotacao_compra is not null and cotacao_venda is not null""",
    "d_clients": _first("id_cliente", ORD, "clients",
                        "id_cliente, nome_cliente, pais_cliente, moeda_pais, data_cadastro_cliente"),
    "receivables": f"""
        select id_conta, descricao_conta, r.id_cliente, codigo_categoria, observacao_conta, valor_conta,
               case when coalesce(c.moeda_pais, 'BRL') = 'BRL' or data_pagamento is null then valor_conta
                    when c.moeda_pais = 'ARS' then valor_conta * cast(0.0037 as double)
                    else valor_conta * coalesce(cotacao_venda, 1) end as valor_conta_brl,
               data_vencimento, data_pagamento, status_conta, r.{ORD}
        from b_receivables r left join d_clients c on c.id_cliente = r.id_cliente
        left join rates q on q.moeda = c.moeda_pais and q.data = r.data_pagamento""",
    "d_categories": "select row_number() over (order by codigo_categoria) as sk_categoria, * from categories",
    "d_currencies": "select row_number() over (order by codigo_moeda) as sk_moeda, codigo_moeda from"
                    " (select moeda_pais as codigo_moeda from clients where moeda_pais is not null"
                    " union select 'BRL')",
    "d_dates": f"""
        select row_number() over (order by d) as sk_data, d as data_calendario, year(d) as ano, quarter(d) as trimestre,
               month(d) as mes, {_case('month(d)', _MONTHS)} as nome_mes, day(d) as dia,
               isodow(d) - 1 as dia_semana_num, {_case('isodow(d) - 1', dict(enumerate(WEEKDAY_NAMES)))}
                   as nome_dia_semana, isodow(d) >= 6 as fim_de_semana
        from (select mes_ano_meta as d from targets union select data_vencimento from payables
              union select data_pagamento from payables union select data_vencimento from b_receivables
              union select data_pagamento from b_receivables) where d is not null""",
    "f_receivable": f"""
        select r.id_conta as id_conta_receber, r.id_cliente, k.sk_categoria, m.sk_moeda, p.sk_data as sk_data_pagamento,
               v.sk_data as sk_data_vencimento, valor_conta, valor_conta_brl, status_conta, observacao_conta
        from ({_first('id_conta', ORD + ' desc', 'receivables')}) r
        left join d_clients c on c.id_cliente = r.id_cliente
        left join d_categories k on k.codigo_categoria = trim(r.codigo_categoria)
        left join d_currencies m on m.codigo_moeda = coalesce(c.moeda_pais, 'BRL')
        left join d_dates p on p.data_calendario = r.data_pagamento
        left join d_dates v on v.data_calendario = r.data_vencimento""",
    "f_payable": f"""
        select r.id_conta as id_conta_pagar, k.sk_categoria, m.sk_moeda, p.sk_data as sk_data_pagamento,
               v.sk_data as sk_data_vencimento, valor_conta, valor_conta_brl, status_conta, destino_pagamento_conta,
               observacao_conta
        from ({_first('id_conta', ORD + ' desc', 'payables')}) r
        left join d_categories k on k.codigo_categoria = trim(r.codigo_categoria)
        left join d_currencies m on m.codigo_moeda = 'BRL'
        left join d_dates p on p.data_calendario = r.data_pagamento
        left join d_dates v on v.data_calendario = r.data_vencimento""",
    "f_target": f"""
        select row_number() over (order by t.{ORD}) as sk_fato_meta, d.sk_data as sk_data_referencia, meta_valor,
               t.mes, t.ano, t.nome_mes
        from targets t left join d_dates d on d.data_calendario = t.mes_ano_meta""",
    "v_clients": "select id_cliente, nome_cliente, pais_cliente, data_cadastro_cliente, 'linha 1, \"' || id_cliente || '\"' ||"
                 " case when length(id_cliente) % 2 = 0 then chr(10) || 'linha 2' else '' end as nota from r_clients",
    "t_dates": "select distinct mes_ano_meta as d, true as cedo from targets where mes_ano_meta is not null"
               " union all select data_vencimento, data_vencimento >= date '1998-01-01' from payables"
               " union all select data_pagamento, data_vencimento >= date '1998-01-01' from payables",
    "twice": """
        select 'dim_categoria' as dimensao, codigo_categoria as chave, codigo_categoria >= 'Brand#3' as cedo from categories
        union all select 'dim_moeda', codigo_moeda, codigo_moeda >= 'E' or codigo_moeda = 'BRL' from d_currencies
        union all select 'dim_data', cast(d as varchar), coalesce(bool_or(cedo), false) from t_dates where d is not null group by d""",
    "delays": "select *, coalesce(data_pagamento - data_vencimento, 0) as dias, trim(status_conta) as s"
              " from receivables",
    "modes": "select id_cliente, s from (select id_cliente, s, count(*) as n from delays where s is not null"
             " group by all) qualify row_number() over (partition by id_cliente order by n desc, s) = 1",
    "rfm": """
        select a.id_cliente, frequencia_recebimentos, valor_total_recebido_brl,
               valor_total_recebido_brl / frequencia_recebimentos as valor_medio_recebido_brl, ultimo_pagamento,
               coalesce(s, 'sem_status') as status_mais_comum,
               cast(coalesce((select max(data_pagamento) from receivables) - ultimo_pagamento, 9999) as double)
                   as recencia_dias
        from (select id_cliente, count(id_conta) as frequencia_recebimentos,
                     cast(round(sum(cast(valor_conta_brl as decimal(38, 10))), 6) as double) as valor_total_recebido_brl,
                     max(data_pagamento) as ultimo_pagamento
              from receivables group by id_cliente) a left join modes m on m.id_cliente = a.id_cliente""",
    "behaviour": """
        select id_cliente, avg(dias) as media_dias_atraso, round(var_samp(dias), 6) as variancia_dias_atraso,
               round(stddev_samp(dias), 6) as desvio_dias_atraso,
               count(*) filter (dias <= 0) / count(*) as taxa_pagamento_em_dia,
               count(*) filter (dias > 0) / count(*) as taxa_pagamento_atrasado
        from delays group by id_cliente""",
    "mix": """
        select id_cliente, categoria, linhas, linhas / sum(linhas) over (partition by id_cliente) as parcela
        from (select id_cliente,
                     coalesce(nullif(trim(regexp_replace(lower(nome_categoria), '[^a-z0-9]+', '_', 'g'), '_'), ''),
                              'sem_categoria') as categoria, count(*) as linhas
              from receivables r left join categories k on k.codigo_categoria = r.codigo_categoria group by all)""",
    "wide_mix": "select id_cliente, " + ", ".join(
        f"coalesce(max(parcela) filter (categoria = '{n}'), 0) as mix_cat_{n}" for n in MIX_NAMES
    ) + f", coalesce(sum(parcela) filter (categoria not in ({', '.join(repr(n) for n in MIX_NAMES)})), 0) as mix_resto"
        " from mix group by id_cliente",
    "base": """
        select c.id_cliente, nome_cliente, coalesce(pais_cliente, 'DESCONHECIDO') as pais_cliente,
               coalesce(moeda_pais, 'DESCONHECIDA') as moeda_pais, data_cadastro_cliente,
               coalesce(frequencia_recebimentos, 0) as frequencia_recebimentos,
               coalesce(valor_total_recebido_brl, 0) as valor_total_recebido_brl,
               coalesce(valor_medio_recebido_brl, 0) as valor_medio_recebido_brl, ultimo_pagamento,
               coalesce(status_mais_comum, 'sem_status') as status_mais_comum,
               coalesce(recencia_dias, 0) as recencia_dias, coalesce(media_dias_atraso, 0) as media_dias_atraso,
               coalesce(variancia_dias_atraso, 0) as variancia_dias_atraso,
               coalesce(desvio_dias_atraso, 0) as desvio_dias_atraso,
               coalesce(taxa_pagamento_em_dia, 0) as taxa_pagamento_em_dia,
               coalesce(taxa_pagamento_atrasado, 0) as taxa_pagamento_atrasado
        from d_clients c left join rfm r on r.id_cliente = c.id_cliente
        left join behaviour b on b.id_cliente = c.id_cliente""",
    "ranked": "select *, rank() over (order by valor_total_recebido_brl) + (count(*) over (partition by"
              " valor_total_recebido_brl) - 1) / 2 as rk, count(*) over () as n_all from base",
    "features": """
        select * exclude (rk, n_all), round(ln(1 + valor_total_recebido_brl), 6) as valor_total_recebido_brl_log1p,
               round(ln(1 + valor_medio_recebido_brl), 6) as valor_medio_recebido_brl_log1p, rk / n_all as rank_pct,
               case when 3 * rk > 2 * n_all then 'muito_alto_valor' when 3 * rk > n_all then 'alto_valor'
                    else 'medio_baixo_valor' end as faixa_valor_cliente
        from ranked""",
    "segmented": """
        select id_cliente, nome_cliente, pais_cliente, moeda_pais,
               cast(frequencia_recebimentos >= 30 as int) + 2 * cast(taxa_pagamento_em_dia >= 0.5 as int) as cluster,
               recencia_dias, frequencia_recebimentos, valor_total_recebido_brl, faixa_valor_cliente,
               taxa_pagamento_em_dia, taxa_pagamento_atrasado,
               case when recencia_dias <= 60 then 'recente' else 'inativo' end || '|' ||
               case when frequencia_recebimentos >= 20 then 'alta' else 'baixa' end || '_frequencia|' ||
               faixa_valor_cliente || '|' ||
               case when taxa_pagamento_em_dia >= 0.7 then 'bom_pagador' else 'atrasa_pagamento' end as perfil_cluster,
               'regra' as modelo_vencedor
        from features""",
    "axes": """
        select id_cliente, cast(frequencia_recebimentos >= 30 as int) + 2 * cast(taxa_pagamento_em_dia >= 0.5 as int) as cluster,
               (recencia_dias - avg(recencia_dias) over ()) / stddev_pop(recencia_dias) over () as x,
               (taxa_pagamento_em_dia - avg(taxa_pagamento_em_dia) over ()) / stddev_pop(taxa_pagamento_em_dia) over () as y,
               faixa_valor_cliente
        from features""",
    "centres": "select cluster, count(*) as n, avg(x) as cx, avg(y) as cy from axes group by cluster",
    "spreads": "select cluster, avg(sqrt((x - cx) ** 2 + (y - cy) ** 2)) as s, sum((x - cx) ** 2 + (y - cy) ** 2) as w"
               " from axes join centres using (cluster) group by cluster",
    "apart": """
        select a.id_cliente, a.cluster, b.cluster as other, sum((a.x - b.x) ** 2 + (a.y - b.y) ** 2) as d, count(*) as n
        from axes a join axes b on true group by a.id_cliente, a.cluster, b.cluster""",
    "widths": """
        select id_cliente, max(d / nullif(n - 1, 0)) filter (cluster = other) as own,
               min(d / n) filter (cluster <> other) as near, max(n) filter (cluster = other) as n
        from apart group by id_cliente""",
    "brands": """
        select p_brand as model_name, count(*) as n_clusters, cast(0 as double) as noise_ratio,
               floor(max(l_extendedprice) / 1000) as silhouette, min(l_quantity) as davies_bouldin,
               floor(min(l_extendedprice) / 10) as calinski_harabasz
        from lineitem join part on l_partkey = p_partkey group by p_brand""",
    "brand_ranks": """
        select *, 1.0 / (rank_silhouette + rank_davies_bouldin + rank_calinski_harabasz) as ranking_score
        from (select *,
                 rank() over (order by silhouette desc) + (count(*) over (partition by silhouette) - 1) / 2
                     as rank_silhouette,
                 rank() over (order by davies_bouldin) + (count(*) over (partition by davies_bouldin) - 1) / 2
                     as rank_davies_bouldin,
                 rank() over (order by calinski_harabasz desc) + (count(*) over (partition by calinski_harabasz) - 1)
                     / 2 as rank_calinski_harabasz
              from brands)""",
}

# What each table is read from, in the order of definition.
_NAMES = list(CTE)


def _with(sql: str) -> str:
    """Prefix a query with the tables it needs, directly or through others."""
    import re

    def used(text: str) -> set[str]:
        return {n for n in _NAMES if re.search(rf"\b(from|join)\s+\(?{n}\b", text, re.IGNORECASE)}

    needed, queue = set(), used(sql)
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            queue |= used(CTE[name])
    if not needed:
        return sql
    return "with " + ",\n".join(f"{n} as materialized ({CTE[n]})" for n in _NAMES if n in needed) + "\n" + sql


def _all(table: str, hidden: bool = True) -> str:
    return f"select * exclude ({ORD}) from {table}" if hidden else f"select * from {table}"


_SIX = ["recencia_dias", "frequencia_recebimentos", "valor_total_recebido_brl", "taxa_pagamento_em_dia",
        "taxa_pagamento_atrasado"]
_FIVE = " union all ".join(
    f"select cluster, '{f}' as atributo, cast(min({f}) as double) as minimo,"
    f" round(quantile_cont(cast({f} as double), 0.25), 4) as q1,"
    f" round(quantile_cont(cast({f} as double), 0.5), 4) as mediana,"
    f" round(quantile_cont(cast({f} as double), 0.75), 4) as q3, cast(max({f}) as double) as maximo"
    f" from segmented group by cluster" for f in _SIX
)
_BANDS = ["medio_baixo_valor", "alto_valor", "muito_alto_valor"]
_KEY = "(case when l_orderkey % 13 <> 0 then l_orderkey * 10 + l_linenumber end)"


def _repeats(table: str, key: str) -> str:
    return f"select count(*) from (select {key} from {table} group by 1 having count(*) > 1)"


def _orphans(facts: str, foreign: str, dimension: str, primary: str) -> str:
    return f"select count(distinct {foreign}) from {facts} where {foreign} not in (select {primary} from {dimension})"


_RULES = {
    "pk dim_cliente": _repeats("d_clients", "id_cliente"),
    "pk dim_categoria": _repeats("d_categories", "sk_categoria"),
    "uk dim_categoria": _repeats("d_categories", "codigo_categoria"),
    "pk dim_data": _repeats("d_dates", "sk_data"),
    "pk dim_moeda": _repeats("d_currencies", "sk_moeda"),
    "pk fato_conta_receber": _repeats("f_receivable", "id_conta_receber"),
    "pk fato_conta_pagar": _repeats("f_payable", "id_conta_pagar"),
    "fk receber cliente": _orphans("f_receivable", "id_cliente", "d_clients", "id_cliente"),
    "fk receber categoria": _orphans("f_receivable", "sk_categoria", "d_categories", "sk_categoria"),
    "fk receber moeda": _orphans("f_receivable", "sk_moeda", "d_currencies", "sk_moeda"),
    "fk receber pagamento": _orphans("f_receivable", "sk_data_pagamento", "d_dates", "sk_data"),
    "pk fato_meta_mensal": _repeats("f_target", "sk_fato_meta"),
    "uk dim_moeda": _repeats("d_currencies", "codigo_moeda"),
    "fk receber vencimento": _orphans("f_receivable", "sk_data_vencimento", "d_dates", "sk_data"),
    "fk pagar categoria": _orphans("f_payable", "sk_categoria", "d_categories", "sk_categoria"),
    "fk pagar moeda": _orphans("f_payable", "sk_moeda", "d_currencies", "sk_moeda"),
    "fk pagar pagamento": _orphans("f_payable", "sk_data_pagamento", "d_dates", "sk_data"),
    "fk meta data": _orphans("f_target", "sk_data_referencia", "d_dates", "sk_data"),
    "fk pagar vencimento": _orphans("f_payable", "sk_data_vencimento", "d_dates", "sk_data"),
}

_PROFILE = {"id_cliente": "bigint", "nome_cliente": "string", "pais_cliente": "string", "moeda_pais": "string",
            "data_cadastro_cliente": "date"}

SQL: dict[str, str] = {
    "revenue_by_month_currency_category": """
        select d.ano, d.mes, m.codigo_moeda, k.tipo_categoria, cast(round(sum(cast(valor_conta_brl as decimal(38, 10))), 6) as double) as valor_conta_brl_total,
               count(*) as lancamentos
        from f_receivable f left join d_dates d on d.sk_data = f.sk_data_pagamento
        left join d_currencies m on m.sk_moeda = f.sk_moeda left join d_categories k on k.sk_categoria = f.sk_categoria
        group by all""",
    "revenue_by_client_year": """
        select d.ano, f.id_cliente, c.pais_cliente, cast(round(sum(cast(valor_conta_brl as decimal(38, 10))), 6) as double) as valor_conta_brl_total,
               count(*) as lancamentos
        from f_receivable f left join d_dates d on d.sk_data = f.sk_data_vencimento
        left join d_clients c on c.id_cliente = f.id_cliente group by all""",
    "clean_targets": _all("targets"),
    "clean_categories": _all("categories", False),
    "clean_clients": _all("clients"),
    "clean_payables": _all("payables"),
    "clean_receivables_fx": _all("receivables"),
    "bronze_date_parse": f"select id_conta, {_date('data_vencimento', 'ydm')} as sem_reparo,"
                         f" {_date('data_vencimento', 'ydm', True)} as com_reparo from r_receivables",
    "payment_months": _all("paid_months", False),
    "quote_date_islands": "select min(data) as inicio, max(data) as fim from (select data, data - cast(row_number()"
                          " over (order by data) as int) as g from (select distinct data from quotes)) group by g",
    "latest_quotes": _all("quotes", False),
    "complete_quotes": _all("rates", False),
    "target_currencies": "select distinct moeda_pais as moeda from clients"
                         " where moeda_pais is not null and moeda_pais <> 'BRL'",
    "quote_counts": "select (select count(*) from quotes) as linhas_originais,"
                    " (select count(*) from rates) as linhas_completas",
    "dim_client": _all("d_clients", False),
    "dim_category": _all("d_categories", False),
    "dim_currency": _all("d_currencies", False),
    "dim_date": _all("d_dates", False),
    "fact_receivable": _all("f_receivable", False),
    "fact_payable": _all("f_payable", False),
    "fact_target": _all("f_target", False),
    "new_part_keys_hot": """
        select * from (select cast(case when l_orderkey % 3 = 0 then 1 else l_partkey end as bigint) as chave, l_orderkey,
                              l_linenumber, l_suppkey, l_extendedprice from lineitem)
        where chave not in (select p_partkey from part where p_partkey % 2 = 0)""",
    "hot_client_currency": """
        select o.pedido, o.id_cliente, c.moeda_pais
        from (select cast(o_orderkey as bigint) as pedido,
                     cast(case when o_orderkey % 3 = 0 then 1 else o_custkey end as bigint) as id_cliente from orders) o
        left join d_clients c on c.id_cliente = o.id_cliente""",
    "new_keys_only": f"""
        select i.* from (select {_KEY} as id_conta, l_partkey, l_suppkey, l_extendedprice from lineitem) i
        where not exists (select 1 from (select {_KEY} as k from lineitem where l_returnflag = 'R') e
                          where e.k is not distinct from i.id_conta)""",
    "append_star_twice": "select dimensao, chave, row_number() over (partition by dimensao order by not cedo, chave) as sk from twice",
    "landed_clients_csv": "select " + ", ".join(
        f"case when {c} not in ({', '.join(repr(x) for x in CSV_MISSING)}) then {c} end as {c}"
        for c in ("id_cliente", "nome_cliente", "pais_cliente", "data_cadastro_cliente", "nota")) + " from v_clients",
    "landed_clients_json": "select id_cliente, nome_cliente, pais_cliente, nullif(data_cadastro_cliente, '') as"
                           " data_cadastro_cliente, nota from v_clients",
    "landed_quotes": _all("quotes", False),
    "silver_layer_by_month": _all("payables"),
    "segment_quality": """
        select 'regra' as model_name, count(*) as n_clusters, cast(0 as double) as noise_ratio,
               round((select avg(case when n = 1 then 0 else (near - own) / greatest(near, own) end) from widths), 5) as silhouette,
               round((select avg(m) from (select max((a.s + b.s) / sqrt((p.cx - q.cx) ** 2 + (p.cy - q.cy) ** 2)) as m
                                          from spreads a join spreads b on a.cluster <> b.cluster
                                          join centres p on p.cluster = a.cluster join centres q on q.cluster = b.cluster
                                          group by a.cluster)), 5) as davies_bouldin,
               round(sum(n * (cx ** 2 + cy ** 2)) / (count(*) - 1) / ((select sum(w) from spreads) / (sum(n) - count(*))), 5)
                   as calinski_harabasz
        from centres
        union all
        select 'um_grupo', 1, round(count(*) filter (cluster <> 0) / count(*), 5), -1, 999999, 0 from axes""",
    "feature_vector_entries": """
        select id_cliente, posicao, round(valor, 6) as valor from (
            select id_cliente, 0 as posicao, x as valor from axes union all select id_cliente, 1, y from axes
            union all select id_cliente, 1 + p.p, 1 from axes
            join (select b, row_number() over (order by b) as p from (select distinct faixa_valor_cliente as b from axes)) p
              on p.b = faixa_valor_cliente) where abs(valor) > 1e-9""",
    "pca_of_two": """
        select id_cliente, round(abs(x + s * y) / sqrt(2), 6) as pc1, round(abs(x - s * y) / sqrt(2), 6) as pc2,
               round((1 + abs(r)) / 2, 6) as parte_1, round((1 - abs(r)) / 2, 6) as parte_2
        from axes, (select corr(x, y) as r, sign(corr(x, y)) as s from axes)""",
    "forced_clusters": """
        select f.familia, cast(c_custkey as bigint) as id_cliente,
               cast(min(c_custkey) over (partition by c_custkey % 3) as bigint) as grupo
        from customer, (values ('kmeans'), ('agglomerative')) f(familia) qualify true""",
    "forced_candidates": """
        with points as (
            select c_custkey as id, c_custkey % 8 as g, case when c_custkey % 8 > 0 then 4.0 ** (c_custkey % 8) else 0 end + (c_custkey % 5) / 10 as x
            from customer
        ), placed as (select k, greatest(g, 8 - k) as c, id, x from points, range(2, 9) r(k)),
        clusters as (select k, c, min(id) as grupo, count(*) as clientes, var_pop(x) * count(*) as own from placed group by k, c),
        costs as (select k, count(*) as n, sum(own) as custo from clusters group by k)
        select family || '_k' || k as model_name, cast(grupo as bigint) as grupo, clientes, n as n_clusters, round(custo, 2) as custo
        from clusters join costs using (k), (values ('kmeans'), ('agglomerative')) f(family)""",
    "feature_levels": """
        with lines as (
            select cast(l_orderkey * 10 + l_linenumber as bigint) as id_cliente, l_quantity as q, 'peca ' || l_partkey as a, 'pedido ' || l_orderkey as b
            from lineitem
        ), levels as (
            select c, v, row_number() over (order by c, v) as p from (select distinct 0 as c, a as v from lines union all select distinct 1, b from lines)
        )
        select id_cliente, cast(posicao as integer) as posicao, round(valor, 6) as valor from (
            select id_cliente, 0 as posicao, (q - (select avg(q) from lines)) / (select stddev_pop(q) from lines) as valor from lines
            union all select id_cliente, p, 1 from lines join levels on c = 0 and v = a
            union all select id_cliente, p, 1 from lines join levels on c = 1 and v = b) where abs(valor) > 1e-9""",
    "feature_mix_entries": """
        select * from (with used as (select id_cliente, cast(recencia_dias as double) as x from features),
        names as (
            select categoria, row_number() over (order by categoria) as p,
                   sqrt(greatest(sum(parcela ** 2) / (select count(*) from used) - (sum(parcela) / (select count(*) from used)) ** 2, 0)) as s
            from mix group by categoria
        )
        select id_cliente, cast(posicao as integer) as posicao, round(valor, 6) as valor from (
            select id_cliente, 0 as posicao, (x - (select avg(x) from used)) / (select stddev_pop(x) from used) as valor from used
            union all select id_cliente, p, parcela / s from mix join names using (categoria) where id_cliente in (select id_cliente from used)
        ) where abs(valor) > 1e-9)""",
    "landed_folder": "select 'clientes' as tabela, count(*) as linhas from r_clients union all select 'metas', count(*) from r_targets"
                     " union all select 'categorias', count(*) from r_categories",
    "split_lines_csv": """
        select l_orderkey || '-' || l_linenumber as linha, 'peca "' || l_partkey || '", ' || case l_linenumber % 4
                   when 0 then chr(10) || chr(10) || 'fim' when 1 then 'a' || chr(10) || 'b,"c' || chr(10) || '"' when 2 then ',"' else 'x' end as nota,
               cast(l_suppkey as varchar) as destino from lineitem""",
    "split_orders_json": """
        select case o_orderkey % 4 when 0 then '}, {"' when 1 then '[' || chr(10) when 2 then 'x' end as nota,
               case when o_orderkey % 3 = 0 then '{"cliente":{"id":"' || o_custkey || '","sinal":"{"},"situacao":"' || o_orderstatus || '"}' end as extra,
               cast(o_orderkey as varchar) as o_orderkey from orders""",
    "append_layer_twice": """
        select cast(l_orderkey * 10 + l_linenumber as bigint) as chave, cast(l_partkey as bigint) as l_partkey, 'primeira' as carga
        from lineitem where l_returnflag = 'R'
        union all select cast(l_orderkey * 10 + l_linenumber as bigint), cast(l_partkey + 1 as bigint), 'segunda' from lineitem
        where l_orderkey * 10 + l_linenumber not in (select l_orderkey * 10 + l_linenumber from lineitem where l_returnflag = 'R')""",
    "replaced_months": """
        select cast(date_trunc('month', data_vencimento) as date) as mes_vencimento, case when year(data_vencimento) = 1996 then 'correcao' else 'inicial' end as carga,
               count(*) as contas, round(sum(case when year(data_vencimento) = 1996 then -valor_conta else valor_conta end), 2) as valor
        from payables where year(data_vencimento) <> 1996 or year(data_vencimento) is null or id_conta % 2 = 0 group by all""",
    "sorted_layer_order": """
        select row_number() over (order by valor_conta, id_conta) as posicao, * from (
            select distinct valor_conta, id_conta from payables where id_conta is not null and valor_conta is not null)""",
    "first_clients": "select * from d_clients order by pais_cliente nulls first, id_cliente limit 10",
    "payable_quantiles_by_load": """
        select * from (with numbered as (
            select status_conta, valor_conta as v, p.parte as parte,
                   row_number() over (partition by status_conta, p.parte order by valor_conta) - 1 as place,
                   count(*) over (partition by status_conta, p.parte) as total,
                   case when valor_conta = 0 then 0 else sign(valor_conta) * (40000 + ceil(ln(abs(valor_conta)) / ln(1.02))) end as bucket
            from payables, (select unnest([0.25, 0.5, 0.75]) as parte) p where valor_conta is not null
        ), spans as (
            select *, min(v) over (partition by status_conta, parte, bucket) as lo, max(v) over (partition by status_conta, parte, bucket) as hi
            from numbered
        ), sides as (
            select status_conta, parte, max(total) as total, max((total - 1) * parte - floor((total - 1) * parte)) as f,
                   max((lo + hi) / 2) filter (place = floor((total - 1) * parte)) as m1, max((lo + hi) / 2) filter (place = ceil((total - 1) * parte)) as m2,
                   max(lo) filter (place = floor((total - 1) * parte)) as l1, max(lo) filter (place = ceil((total - 1) * parte)) as l2,
                   max(hi) filter (place = floor((total - 1) * parte)) as h1, max(hi) filter (place = ceil((total - 1) * parte)) as h2,
                   max(v) filter (place = floor((total - 1) * parte)) as v1, max(v) filter (place = ceil((total - 1) * parte)) as v2
            from spans group by status_conta, parte
        )
        select status_conta, cast(parte as double) as parte, total, round(m1 + (m2 - m1) * f, 4) as estimativa, round(l1 + (l2 - l1) * f, 4) as minimo,
               round(h1 + (h2 - h1) * f, 4) as maximo, round(v1 + (v2 - v1) * f, 4) as quantil from sides)""",
    "pca_of_blocks": """
        with z as (
            select c_custkey as id, (c_acctbal - avg(c_acctbal) over ()) / stddev_pop(c_acctbal) over () as u,
                   (c_custkey % 97 - avg(c_custkey % 97) over ()) / stddev_pop(c_custkey % 97) over () as w from customer
        ), r as (select sqrt(6) * corr(u, w) as c from z),
        turn as (select c, 0.5 * atan2(2 * c, 1) as a from r)
        select cast(id as bigint) as id_cliente, round(abs(cos(a) * sqrt(3) * u + sin(a) * sqrt(2) * w), 6) as pc1,
               round(abs(-sin(a) * sqrt(3) * u + cos(a) * sqrt(2) * w), 6) as pc2,
               round((2.5 + sqrt(0.25 + c * c)) / 5, 6) as parte_1, round((2.5 - sqrt(0.25 + c * c)) / 5, 6) as parte_2
        from z, turn""",
    "silver_quality_log": """
        select tabela, m.medida as medida, m.linhas as linhas from (select tabela, unnest(list_concat(
            [{'medida': 'linhas_antes', 'linhas': linhas_antes}, {'medida': 'linhas_depois', 'linhas': linhas_depois},
             {'medida': 'removidas', 'linhas': linhas_antes - linhas_depois}], mais)) as m from (
            select 'meta_2025_silver' as tabela, (select count(*) from r_targets) as linhas_antes, count(*) as linhas_depois,
                   [{'medida': 'validas', 'linhas': count(*) filter (ok)}, {'medida': 'invalidas', 'linhas': count(*) filter (not ok)}] as mais
            from (select mes_ano_meta is not null and meta_valor is not null and mes is not null and ano is not null
                         and nome_mes is not null as ok from targets)
            union all select 'categoria_silver', (select count(*) from r_categories), count(*), [] from categories
            union all select 'cliente_silver', (select count(*) from r_clients), count(*),
                   [{'medida': 'sem_pais_cliente', 'linhas': count(*) - count(pais_cliente)},
                    {'medida': 'sem_moeda_pais', 'linhas': count(*) - count(moeda_pais)},
                    {'medida': 'sem_data_cadastro_cliente', 'linhas': count(*) - count(data_cadastro_cliente)}] from clients
            union all select 'conta_pagar_silver', (select count(*) from r_payables), count(*),
                   [{'medida': 'pagas', 'linhas': count(*) filter (lower(status_conta) = 'pago')},
                    {'medida': 'abertas', 'linhas': count(*) filter (lower(status_conta) = 'em aberto')}] from payables
            union all select 'conta_receber_silver', (select count(*) from r_receivables), count(*),
                   [{'medida': 'pagas', 'linhas': count(*) filter (regexp_matches(lower(status_conta), 'recebido|pago'))},
                    {'medida': 'abertas', 'linhas': count(*) filter (regexp_matches(lower(status_conta), 'aberto|pendente'))}]
            from b_receivables) figures)""",
    "quality_targets": """
        select count(*) filter (ok) as validas, count(*) filter (not ok) as invalidas
        from (select mes_ano_meta is not null and meta_valor is not null and mes is not null and ano is not null
                     and nome_mes is not null as ok from targets)""",
    "quality_categories": "select (select count(*) from r_categories) as linhas_antes, count(*) as linhas_depois,"
                          " (select count(*) from r_categories) - count(*) as removidas from categories",
    "quality_clients": """
        select (select count(*) from r_clients) as linhas_antes, count(*) as linhas_depois,
               (select count(*) from r_clients) - count(*) as removidas,
               count(*) - count(pais_cliente) as sem_pais_cliente, count(*) - count(moeda_pais) as sem_moeda_pais,
               count(*) - count(data_cadastro_cliente) as sem_data_cadastro_cliente from clients""",
    "quality_ledgers": """
        select 'conta_pagar' as tabela, (select count(*) from r_payables) as linhas_antes, count(*) as linhas_depois,
               (select count(*) from r_payables) - count(*) as removidas,
               count(*) filter (lower(status_conta) = 'pago') as pagas,
               count(*) filter (lower(status_conta) = 'em aberto') as abertas from payables
        union all
        select 'conta_receber', (select count(*) from r_receivables), count(*),
               (select count(*) from r_receivables) - count(*),
               count(*) filter (regexp_matches(lower(status_conta), 'recebido|pago')),
               count(*) filter (regexp_matches(lower(status_conta), 'aberto|pendente')) from b_receivables""",
    "quality_keys": " union all ".join(f"select '{r}' as regra, ({q}) as violacoes" for r, q in _RULES.items()),
    "column_profile": " union all ".join(
        f"select '{c}' as coluna, count({c}) as preenchidas, '{k}' as tipo from clients" for c, k in _PROFILE.items()
    ),
    "client_rfm": _all("rfm", False),
    "client_behaviour": _all("behaviour", False),
    "client_category_mix": _all("mix", False),
    "client_features": "select f.* exclude (rank_pct), " + ", ".join(
        f"coalesce(mix_cat_{n}, 0) as mix_cat_{n}" for n in MIX_NAMES
    ) + ", coalesce(mix_resto, 0) as mix_resto from features f left join wide_mix x on x.id_cliente = f.id_cliente",
    "client_category_mix_wide": "select id_cliente, " + ", ".join(
        f"round(coalesce(sum(parcela) filter (categoria = '{n}'), 0), 9) as mix_cat_{n}" for n in FEW_NAMES
    ) + f", round(coalesce(sum(parcela) filter (categoria not in ({', '.join(repr(n) for n in FEW_NAMES)})), 0), 9) as mix_resto"
        " from mix group by id_cliente",
    "client_value_band": "select id_cliente, valor_total_recebido_brl, rank_pct, faixa_valor_cliente from features",
    "band_statistics": """
        select faixa_valor_cliente, count(*) as clientes, round(avg(valor_total_recebido_brl), 4) as media,
               round(quantile_cont(valor_total_recebido_brl, 0.5), 4) as mediana,
               min(valor_total_recebido_brl) as minimo, max(valor_total_recebido_brl) as maximo
        from features group by 1""",
    "tercile_cutoffs": "select round(quantile_cont(valor_total_recebido_brl, 1/3), 4) as corte_1,"
                       " round(quantile_cont(valor_total_recebido_brl, 2/3), 4) as corte_2 from features",
    "country_counts": "select pais_cliente, count(*) as linhas, round(100.0 * count(*) / sum(count(*)) over (), 1)"
                      " as percentual from clients where pais_cliente is not null group by 1",
    "country_band_crosstab": "select coalesce(pais_cliente, 'All') as pais_cliente, " + ", ".join(
        f"count(*) filter (faixa_valor_cliente = '{b}') as {b}" for b in _BANDS
    ) + ', 0 as Outros, count(*) as "All" from features group by rollup (pais_cliente)',
    "distinct_due_dates": "select distinct data_vencimento from payables",
    "segment_output": _all("segmented", False),
    "country_segment_crosstab": """
        select coalesce(pais_cliente, 'All') as pais_cliente, count(*) filter (cluster = 0) as "0",
               count(*) filter (cluster = 1) as "1", count(*) filter (cluster = 2) as "2",
               count(*) filter (cluster not in (0, 1, 2)) as Outros, count(*) as "All"
        from segmented group by rollup (pais_cliente)""",
    "currency_counts": "select moeda_pais, count(*) as linhas, round(100.0 * count(*) / sum(count(*)) over (), 1)"
                       " as percentual from segmented group by 1",
    "band_counts": "select faixa_valor_cliente, count(*) as linhas, round(100.0 * count(*) / sum(count(*)) over (), 1)"
                   " as percentual from segmented group by 1",
    "segment_profile": "select cluster, count(*) as clientes, round(avg(recencia_dias), 4) as recencia_media,"
                       " round(avg(frequencia_recebimentos), 4) as frequencia_media,"
                       " round(avg(valor_total_recebido_brl), 4) as valor_medio,"
                       " round(100 * avg(taxa_pagamento_em_dia), 4) as em_dia_pct, " + ", ".join(
        f"round(100.0 * count(*) filter (faixa_valor_cliente = '{b}') / count(*), 1) as pct_{b}" for b in _BANDS
    ) + ", arg_min(perfil_cluster, id_cliente) as perfil_exemplo from segmented group by cluster",
    "segment_five_numbers": _FIVE,
    "segment_five_numbers_by_sketch": _FIVE,
    "segment_centroids": "select cluster, round(avg(recencia_dias), 4) as x,"
                         " round(avg(valor_total_recebido_brl), 4) as y from segmented group by cluster",
    "model_ranks": _all("brand_ranks", False),
    "top_models": "select * from brand_ranks order by ranking_score desc, model_name limit 5",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in SQL.items()}
