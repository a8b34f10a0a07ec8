"""DuckDB statements with the expected result of each registered query.

They share the input derivations and the fixed values with the library, and nothing
else: the number grammar is a chain of suffix tests instead of one search pattern,
and as-of joins are ordered correlated subqueries or window functions.
"""

from __future__ import annotations

from trunkline.functions import numbering_rules as rules
from trunkline.functions.keys import MISSING_MARKS
from trunkline.plans import inputs

REFERENCE_DATE = "1998-06-30"
EARLIER_DATE = "1996-12-31"


def _with(*ctes: tuple[str, str]) -> str:
    return "with " + ", ".join(f"{name} as ({sql})" for name, sql in ctes) + " "


# --- number grammar -------------------------------------------------------------


def _alternatives(codes: list[str]) -> str:
    return "(" + "|".join(codes) + ")"


_AREA = _alternatives(rules.AREA_CODES)
_CSP = _alternatives(rules.CARRIER_SELECTION_CODES)
_MOBILE_11 = _AREA + "9[0-9]{8}"
_TEN = _alternatives(
    [_AREA + "[2345][0-9]{7}", _alternatives(rules.NON_GEOGRAPHIC_CODES) + "[0-9]{7}"]
    + [
        _alternatives(areas.split()) + _alternatives(leads.split()) + "[0-9]{6}"
        for areas, leads in rules.TRUNKED_LEADS_BY_AREA
    ]
)
_EIGHT = "([2345][0-9]{7}|" + _alternatives(rules.LOCAL_TRUNKED_LEADS) + "[0-9]{6})"


def _utility(size: int) -> str:
    return _alternatives([c for c in rules.PUBLIC_UTILITY_CODES if len(c) == size])


def _suffix_chain(c: str, steps: list[tuple[int, str, int]]) -> str:
    whens = " ".join(
        f"when regexp_full_match(right({c},{size}), '{pattern}') and length({c})>={size} "
        f"then right({c},{keep})"
        for size, pattern, keep in steps
    )
    return f"case {whens} else '' end"


def found(c: str) -> str:
    """The recognised number at the end of ``c``: the earliest possible start wins."""
    country_area = "55" + _AREA
    one = f"(55|{_AREA})"
    full = _suffix_chain(
        c,
        [
            (15, "55" + _CSP + _MOBILE_11, 11),
            (14, "55" + _CSP + _TEN, 10),
            (13, f"(55|{_CSP})" + _MOBILE_11, 11),
            (12, f"(55|{_CSP})" + _TEN, 10),
            (11, _MOBILE_11, 11),
            (10, _TEN, 10),
        ],
    )
    local = _suffix_chain(
        c,
        [
            (9, country_area + _utility(5), 5),
            (9, "9[0-9]{8}", 9),
            (8, country_area + _utility(4), 4),
            (8, _EIGHT, 8),
            (7, country_area + _utility(3), 3),
            (7, one + _utility(5), 5),
            (6, one + _utility(4), 4),
            (5, one + _utility(3), 3),
            (5, _utility(5), 5),
            (4, _utility(4), 4),
            (3, _utility(3), 3),
        ],
    )
    return f"case when length({c})>=10 then {full} else {local} end"


def _given(c: str) -> str:
    return f"replace(split_part({c},';',1),'f','')"


def _clean(c: str) -> str:
    return f"regexp_replace({c},'[ -/:-~]','','g')"


def _stripped(c: str) -> str:
    return f"regexp_replace({c},'^(9090|90|00|0)','')"


def _normalized(source: str, number: str, code: str, out: str) -> list[tuple[str, str]]:
    """CTEs that add ``<out>_number`` and ``<out>_valid`` to ``source``."""
    return [
        (f"{out}_1", f"select *, {_given(number)} {out}_g from {source}"),
        (f"{out}_2", f"select *, {_stripped(_clean(f'{out}_g'))} {out}_c from {out}_1"),
        (f"{out}_3", f"select *, {found(f'{out}_c')} {out}_f from {out}_2"),
        (
            out,
            f"select *, coalesce({out}_f<>'',false) {out}_valid, "
            f"case when {out}_f is null or {out}_f='' then {out}_g "
            f"when length({out}_f) in (8,9) then concat({code},{out}_f) "
            f"else {out}_f end {out}_number from {out}_3",
        ),
    ]


_PAIR = [
    ("dialled", inputs.DIALLED_CALLS),
    *_normalized("dialled", "numero_a", "''", "a"),
    (
        "ctx",
        "select *, case when a_valid and length(a_number) in (10,11) then "
        "coalesce(nullif(ddd,''),substring(a_number,1,2)) else '' end contexto from a",
    ),
    *_normalized("ctx", "numero_b", "contexto", "b"),
]

# --- portability ----------------------------------------------------------------

_TYPED = [
    ("lines", inputs.PORTABILITY_LINES),
    (
        "typed",
        "select try_cast(tipo_registro as bigint) tipo_registro, "
        "try_cast(numero_bp as bigint) numero_bp, try_cast(tn_inicial as bigint) tn_inicial, "
        "try_cast(cod_receptora as int) cod_receptora, "
        "nullif(nome_receptora,'N/A') nome_receptora, "
        "try_cast(cod_doadora as int) cod_doadora, nullif(nome_doadora,'') nome_doadora, "
        "try_strptime(data_agendamento,'%d/%m/%Y %H:%M:%S') data_agendamento, "
        "try_cast(cod_status as int) cod_status, status, "
        "case ind_portar_origem when 'Sim' then 1 when 'Nao' then 0 end::int ind_portar_origem, "
        "nome_arquivo from lines",
    ),
    (
        "judged",
        "select *, case when numero_bp is null then 'numero_bp' "
        "when tn_inicial is null then 'tn_inicial' "
        "when data_agendamento is null then 'data_agendamento' "
        "when cod_status is null then 'cod_status' "
        "when ind_portar_origem is null then 'ind_portar_origem' end motivo from typed",
    ),
    ("good", "select * exclude (motivo) from judged where motivo is null"),
]


def _dedup(source: str) -> str:
    return f"""select tn_inicial, numero_bp, cast(data_agendamento as date) data_agendamento,
      coalesce(cod_receptora,-1) cod_receptora, coalesce(cod_doadora,-1) cod_doadora,
      cod_status, ind_portar_origem,
      cast(substring(cast(tn_inicial as varchar),1,2) as int) cn, nome_arquivo
    from (select *, row_number() over (
        partition by tn_inicial, cast(data_agendamento as date)
        order by nome_arquivo desc, data_agendamento desc, numero_bp desc,
          cod_receptora desc nulls last, cod_doadora desc nulls last,
          cod_status desc nulls last, ind_portar_origem desc nulls last) rn
      from {source}) where rn=1"""


_STAGED = ("staged", inputs.STAGED_PORTABILITY)
_HIST = [_STAGED, ("hist", _dedup("staged"))]
_BATCHES = [
    _STAGED,
    ("lote0", "select * from staged where lote=0"),
    ("lote1", "select * from staged where lote=1"),
    ("h0", _dedup("lote0")),
    ("h1", _dedup("lote1")),
    (
        "merged",
        "select * from h1 union all select * from h0 where not exists (select 1 from h1 "
        "where h1.cn=h0.cn and h1.tn_inicial=h0.tn_inicial "
        "and h1.data_agendamento=h0.data_agendamento)",
    ),
]
_BUCKET = (
    "case when cn=11 then 'cn_11' when cn between 12 and 20 then 'cn_12_20' "
    "when cn between 21 and 40 then 'cn_21_40' when cn between 41 and 70 then 'cn_41_70' "
    "when cn between 71 and 99 then 'cn_71_99' else 'cn_default' end"
)

_NEXT_DAY = "lead(data_agendamento) over (partition by tn_inicial order by data_agendamento)"

# --- plan and names -------------------------------------------------------------

_PLAN = [
    ("sn", inputs.STAGED_NUMBERING),
    ("sc", inputs.STAGED_CNG),
    (
        "plano",
        """select cast(cn as int) cn, cast(prefixo as int) prefixo,
          cast(concat(cn,prefixo,faixa_inicial) as bigint) faixa_inicial,
          cast(concat(cn,prefixo,faixa_final) as bigint) faixa_final,
          cast(coalesce(codigo_cnl,'-1') as int) codigo_cnl,
          cast(cnpj_prestadora as bigint) cod_prestadora from sn
        union all
        select cast(left(codigo_nao_geografico,2) as int),
          cast(substring(codigo_nao_geografico,3,4) as int),
          cast(codigo_nao_geografico as bigint), cast(codigo_nao_geografico as bigint),
          -1, cast(cnpj_prestadora as bigint) from sc""",
    ),
]

#: Rows of the numbering archives, with file and reason.
_NUMBERING = [
    *_PLAN,
    ("ss", inputs.STAGED_SUP),
    (
        "arquivos",
        """select nome_prestadora, cnpj_prestadora,
          concat(case servico when 'STFC' then 'STFC_' else 'SMP_' end, cn, '.zip') nome_arquivo,
          case when cnpj_prestadora is null then 'cnpj_prestadora' end motivo,
          cn, prefixo, faixa_inicial, faixa_final,
          case when servico='STFC' then codigo_cnl end codigo_cnl, servico,
          cast(null as varchar) codigo_nao_geografico, cast(null as varchar) numero_sup
        from sn
        union all
        select nome_prestadora, cnpj_prestadora,
          concat('CNG_', cast(codigo_nao_geografico as bigint)%3, '.zip'),
          case when cnpj_prestadora is null then 'cnpj_prestadora' end,
          null, null, null, null, null, null, codigo_nao_geografico, null
        from sc
        union all
        select nome_prestadora, cnpj_prestadora,
          concat('SUP_', cast(numero_sup as bigint)%3, '.zip'),
          case when cnpj_prestadora is null then 'cnpj_prestadora' end,
          null, null, null, null, null, null, null, numero_sup
        from ss""",
    ),
]

_UNKNOWN = "select cast(-1 as bigint) cod_prestadora, 'NÃO IDENTIFICADO' nome_prestadora"


def _names(pairs: list[tuple[str, str, str]]) -> str:
    union = " union ".join(
        f"select coalesce(cast({code} as bigint),-1) cod_prestadora, "
        f"case when {code} is null then 'NÃO IDENTIFICADO' else {name} end nome_prestadora "
        f"from {source} where {code} is not null or {name} is not null"
        for source, code, name in pairs
    )
    return (
        "select cod_prestadora, max(nome_prestadora) nome_prestadora "
        f"from ({union} union {_UNKNOWN}) group by cod_prestadora"
    )


_PORT_NAMES = _names(
    [
        ("staged", "cod_receptora", "nome_receptora"),
        ("staged", "cod_doadora", "nome_doadora"),
    ]
)
_CARRIERS = [
    ("ss", inputs.STAGED_SUP),
    ("n1", _PORT_NAMES),
    ("n2", _names([("sc", "cnpj_prestadora", "nome_prestadora")])),
    ("n3", _names([("ss", "cnpj_prestadora", "nome_prestadora")])),
    ("n4", _names([("sn", "cnpj_prestadora", "nome_prestadora")])),
    (
        "prestadoras",
        "select cod_prestadora, nome_prestadora from ("
        "select *, row_number() over (partition by cod_prestadora order by ordem desc) rn from ("
        + " union all ".join(f"select *, {i} ordem from n{i}" for i in (1, 2, 3, 4))
        + ")) where rn=1",
    ),
]

# --- carrier resolution ---------------------------------------------------------

_KEYS = """select cast(t as bigint) nu_terminal,
  case when length(t) between 10 and 11 then cast(left(t,2) as int) else -1 end cn,
  case length(t) when 10 then cast(substring(t,3,4) as int)
    when 11 then cast(substring(t,3,5) as int) else -1 end prefixo
from (select distinct {column} t from {source})"""

_NTQ = [
    ("numeros", inputs.NUMBERS),
    ("ntq", _KEYS.format(column="nu_terminal", source="numeros")),
]

_ASSIGNED = """select nu_terminal, cn, prefixo, cod_prestadora from (
  select q.nu_terminal, q.cn, q.prefixo, p.cod_prestadora, row_number() over (
    partition by q.nu_terminal order by p.faixa_inicial desc, p.faixa_final, p.cod_prestadora) rn
  from {source} q left join plano p on p.cn=q.cn and p.prefixo=q.prefixo
    and p.faixa_inicial<=q.nu_terminal and p.faixa_final>=q.nu_terminal) where rn=1"""

# Stretches between all ends of a prefix's ranges, each with the range that counts there;
# neighbours with the same range are one segment.
_SEGMENTS = """select cn, prefixo, min(lo) faixa_inicial, max(hi) faixa_final,
  any_value(cod_prestadora) cod_prestadora
from (select *, sum(case when junto then 0 else 1 end)
    over (partition by cn, prefixo order by lo) trecho
  from (select *, coalesce(lag(hi) over w + 1 = lo and lag(faixa_inicial) over w = faixa_inicial
      and lag(faixa_final) over w = faixa_final, false) junto
    from (select c.cn, c.prefixo, lo, hi, faixa_inicial, faixa_final, cod_prestadora,
        row_number() over (partition by c.cn, c.prefixo, lo
          order by faixa_inicial desc, faixa_final, cod_prestadora) rn
      from (select cn, prefixo, x lo, lead(x) over (partition by cn, prefixo order by x) - 1 hi
        from (select cn, prefixo, faixa_inicial x from plano union
          select cn, prefixo, faixa_final + 1 from plano)) c
      join plano p on p.cn = c.cn and p.prefixo = c.prefixo
        and p.faixa_inicial <= c.lo and p.faixa_final >= c.hi) where rn = 1
    window w as (partition by cn, prefixo order by lo)))
group by cn, prefixo, trecho"""

_PORTED = """select q.nu_terminal, h.cod_receptora from {source} q left join (
  select cn, tn_inicial, cod_receptora, row_number() over (
    partition by cn, tn_inicial order by data_agendamento desc) rn
  from hist where data_agendamento <= date '{day}') h
  on h.cn=q.cn and h.tn_inicial=q.nu_terminal and h.rn=1"""


def _resolved(source: str, day: str, tag: str = "") -> list[tuple[str, str]]:
    return [
        (f"designado{tag}", _ASSIGNED.format(source=source)),
        (f"portado{tag}", _PORTED.format(source=source, day=day)),
        (
            f"resolvido{tag}",
            f"select d.nu_terminal, n.nome_prestadora, "
            f"case when p.cod_receptora is not null then 1 else 0 end ind_portado, "
            f"case when d.cod_prestadora is not null then 1 else 0 end ind_designado "
            f"from designado{tag} d join portado{tag} p using (nu_terminal) "
            f"left join prestadoras n "
            f"on n.cod_prestadora=coalesce(p.cod_receptora,d.cod_prestadora)",
        ),
    ]


_TABLES = [*_HIST, *_PLAN, *_CARRIERS]
_RESOLVED = [*_TABLES, *_NTQ, *_resolved("ntq", REFERENCE_DATE)]

_HIST_COLUMNS = (
    "tn_inicial, numero_bp, data_agendamento, cod_receptora, cod_doadora, "
    "cod_status, ind_portar_origem, cn"
)

_TYPED_COLUMNS = (
    "tipo_registro, numero_bp, tn_inicial, cod_receptora, nome_receptora, cod_doadora, "
    "nome_doadora, data_agendamento, cod_status, status, ind_portar_origem, motivo"
)


def oracle_sql() -> dict[str, str]:
    """Expected results by query name."""
    sql: dict[str, str] = {}

    # Scans and decoding.
    sql["scan_portability"] = (
        _with(*_TYPED) + f"select {_TYPED_COLUMNS}, nome_arquivo from judged"
    )
    sql["scan_numbering"] = _with(*_NUMBERING) + (
        "select nome_prestadora, cnpj_prestadora, nome_arquivo, motivo, cn, prefixo, "
        "faixa_inicial, faixa_final, codigo_cnl, servico, codigo_nao_geografico, numero_sup "
        "from arquivos"
    )
    sql["load_numbering"] = _with(*_PLAN) + "select * from plano"
    sql["load_numbering_report"] = _with(*_NUMBERING) + (
        "select nome_arquivo, count(*) linhas_lidas, "
        "count(*) filter (where motivo is null) linhas, "
        "count(motivo) rejeitadas, max(motivo) erro, "
        "case when count(motivo)=0 then 'success' else 'error' end status "
        "from arquivos group by nome_arquivo "
        "union all select 'SMP_ruim.zip', 1, 0, 1, "
        "'BadZipFile: File is not a zip file', 'error' "
        "union all select 'PLANO_x.zip', 0, 0, 0, 'tipo desconhecido', 'error'"
    )
    sql["query_numbers_carriers"] = _with(
        *_TYPED,
        ("staged", "select * from good"),
        ("hist", _dedup("staged")),
        *_PLAN,
        *_CARRIERS,
        *_NTQ,
        *_resolved("ntq", REFERENCE_DATE),
    ) + (
        "select * from resolvido union all "
        "select null, null, 0, 0 from (values (1), (2), (3)) texto(n)"
    )
    line = (
        "concat(call_id, ',', case when numero_a='' then '\"\"' else coalesce(numero_a,'') end, "
        "',', case when numero_b='' then '\"\"' else coalesce(numero_b,'') end)"
    )
    name = "concat('chamadas_', call_id%4, '.csv.gz')"
    sql["preview_files"] = _with(("d", inputs.DIALLED_CALLS)) + (
        f"select nome_arquivo, cast(null as varchar) membro, cast(n+1 as int) linha_no, linha, "
        f"cast(null as varchar) erro from (select {name} nome_arquivo, trim({line}) linha, "
        "row_number() over (partition by call_id%4 order by call_id, numero_a nulls first, "
        "numero_b nulls first) n from d) where n<=4 "
        f"union all select distinct {name}, null, 1, 'timestamp,origem,destino', null from d"
    )
    sql["header_check"] = _with(("d", inputs.DIALLED_CALLS)) + (
        f"select distinct {name} nome_arquivo, 'duracao' faltando, false valido, "
        "cast(null as varchar) erro from d"
    )
    sql["file_inventory"] = _with(("d", inputs.DIALLED_CALLS)) + (
        f"select distinct {name} nome, {name} caminho, '.gz' extensao, 'gzip' formato, "
        "true com_conteudo from d "
        "union all select 'vazio.log', 'sub/vazio.log', '.log', 'texto', false"
    )
    sql["encoding_probe"] = (
        "select concat('utf8_', lang, '.csv') nome_arquivo, 'utf8' as \"encoding\" "
        "from documents group by lang union all "
        "select concat('latin1_', lang, '.csv'), case when "
        "bool_or(regexp_matches(text, '[\\x{80}-\\x{ff}]')) then 'latin1' else 'utf8' end "
        "from documents group by lang"
    )
    sql["file_type_dispatch"] = (
        _with(("nomes", inputs.FILE_NAMES))
        + "select nome_arquivo, case when nome_arquivo ilike 'STFC%' then 'STFC' "
        "when nome_arquivo ilike 'SMP%' or nome_arquivo ilike 'SME%' then 'SMP_SME' "
        "when nome_arquivo ilike 'CNG%' then 'CNG' "
        "when nome_arquivo ilike 'SUP%' then 'SUP' end tipo from nomes"
    )
    marks = ",".join(f"'{m}'" for m in MISSING_MARKS)
    sql["na_decode"] = (
        _with(("v", inputs.MARKED_VALUES))
        + f"select id, case when valor not in ({marks}) then valor end valor from v"
    )
    sql["load_report"] = (
        _with(*_TYPED)
        + "select nome_arquivo, count(*) linhas_lidas, "
        "count(*) filter (where motivo is null) linhas, "
        "count(*) filter (where motivo is not null) rejeitadas, max(motivo) erro, "
        "case when bool_and(motivo is null) then 'success' else 'error' end status "
        "from judged group by nome_arquivo"
    )
    sql["load_totals"] = (
        _with(*_TYPED)
        + "select count(*) arquivos, count(*) filter (where r=0) sucessos, "
        "count(*) filter (where r>0) erros, cast(sum(n-r) as bigint) linhas, "
        "cast(sum(r) as bigint) rejeitadas from (select nome_arquivo, count(*) n, "
        "count(motivo) r from judged group by nome_arquivo)"
    )
    sql["rejected_rows"] = (
        _with(*_TYPED)
        + f"select {_TYPED_COLUMNS}, nome_arquivo from judged where motivo is not null"
    )

    # Typing.
    sql["flag_mapping"] = (
        _with(("l", inputs.PORTABILITY_LINES))
        + "select ind_portar_origem texto, cast(case when ind_portar_origem='Sim' then 1 "
        "when ind_portar_origem='Nao' then 0 end as int) valor from l"
    )
    sql["code_coercion"] = (
        _with(("l", inputs.PORTABILITY_LINES))
        + "select cod_receptora texto, try_cast(cod_receptora as int) valor from l"
    )
    sql["required_ids"] = (
        _with(*_TYPED)
        + "select numero_bp, tn_inicial from typed "
        "where numero_bp is not null and tn_inicial is not null"
    )
    sql["area_code"] = (
        _with(_STAGED)
        + "select tn_inicial, cast(left(cast(tn_inicial as varchar),2) as int) cn from staged"
    )
    sql["cn_bucket"] = (
        "select l_orderkey*10+l_linenumber id, cast(l_orderkey%120 as int) cn, "
        f"{_BUCKET} cn_bucket from (select *, l_orderkey%120 cn from lineitem) t"
    )
    sql["query_keys"] = _with(("numeros", inputs.NUMBERS)) + _KEYS.replace(
        "select distinct {column} t", "select nu_terminal t"
    ).format(source="numeros")
    sql["parse_ref_date"] = (
        _with(("t", inputs.DATE_TEXTS))
        + "select o_orderkey, cast(coalesce(try_strptime(texto,'%Y-%m-%d'), "
        "try_strptime(texto,'%d/%m/%Y'), try_strptime(texto,'%Y%m%d')) as date) data from t"
    )

    # Numbers.
    sql["clean_number"] = (
        _with(("d", inputs.DIALLED_CALLS))
        + f"select call_id, numero_a, {_clean('numero_a')} limpo from d"
    )
    sql["strip_prefix"] = (
        _with(("d", inputs.DIALLED_CALLS))
        + f"select call_id, {_stripped(_clean('numero_b'))} numero from d"
    )
    sql["normalize_number"] = (
        _with(
            ("dialled", inputs.DIALLED_CALLS),
            *_normalized("dialled", "numero_b", "coalesce(ddd,'')", "b"),
        )
        + "select call_id, numero_b, b_number as \"number\", b_valid as valid from b"
    )
    pair = (
        "select call_id, a_number number_a, a_valid valid_a, "
        "b_number number_b, b_valid valid_b from b"
    )
    sql["normalize_pair"] = _with(*_PAIR) + pair
    sql["normalize_calls"] = (
        _with(*_PAIR)
        + "select call_id, numero_a, numero_b, ddd, a_number numero_a_norm, "
        "a_valid numero_a_valid, b_number numero_b_norm, b_valid numero_b_valid, "
        "a_valid and b_valid ambos_validos from b"
    )
    sql["both_valid"] = _with(*_PAIR) + pair + " where a_valid and b_valid"
    sql["invalid_count"] = (
        _with(*_PAIR)
        + "select count(*) filter (where not (a_valid and b_valid)) invalidos from b"
    )
    kind = (
        "case when not (a_valid and b_valid) then 'INVALIDO' "
        "when length(a_number)<10 or length(b_number)<10 then '{other}' "
        "when left(a_number,2)=left(b_number,2) then 'LOCAL' else '{far}' end"
    )
    sql["classify_call"] = (
        _with(*_PAIR)
        + "select call_id, a_number number_a, b_number number_b, "
        + kind.format(other="INDEFINIDO", far="INTERURBANA")
        + " tipo, "
        + kind.format(other="OUTROS", far="DDD")
        + " tipo_ddd from b"
    )

    # Plan, names and history.
    sql["consolidate_plan"] = _with(*_PLAN) + "select * from plano"
    sql["carriers_from_portability"] = _with(_STAGED) + _PORT_NAMES
    sql["carriers_from_numbering"] = _with(("ss", inputs.STAGED_SUP)) + _names(
        [("ss", "cnpj_prestadora", "nome_prestadora")]
    )
    sql["upsert_carriers"] = (
        _with(_STAGED, *_PLAN, *_CARRIERS) + "select * from prestadoras"
    )
    sql["dedup_portability"] = _with(*_HIST) + "select * from hist"
    sql["upsert_history"] = _with(*_BATCHES) + "select * from merged"
    stored = f"select *, {_BUCKET} cn_bucket, {_NEXT_DAY} valido_ate from "
    sql["history_table"] = _with(*_BATCHES) + stored + "merged"
    sql["rebuild_history"] = _with(*_BATCHES) + stored + "h1"
    sql["load_portability"] = (
        _with(*_TYPED, ("h", _dedup("good"))) + f"select {_HIST_COLUMNS}, nome_arquivo from h"
    )
    sql["incremental_load"] = sql["load_portability"]
    sides = ("receptora", "doadora")
    arrivals = [
        (f"chegada{i}", f"select * from good where year(data_agendamento) {years}")
        for i, years in enumerate(("< 1999", ">= 1999"))
    ]
    names = [
        (f"nomes{i}", _names([(f"chegada{i}", f"cod_{s}", f"nome_{s}") for s in sides]))
        for i in (0, 1)
    ]
    sql["incremental_carriers"] = _with(*_TYPED, *arrivals, *names) + (
        "select * from nomes1 union all select * from nomes0 "
        "where cod_prestadora not in (select cod_prestadora from nomes1)"
    )
    sql["incremental_rejected"] = _with(*_TYPED) + (
        f"select {_TYPED_COLUMNS}, nome_arquivo, "
        "cast(case when coalesce(year(data_agendamento),2010)<1999 then 0 else 1 end as int) lote "
        "from judged where motivo is not null"
    )

    sql["incremental_files"] = _with(*_TYPED) + (
        "select distinct nome_arquivo, "
        "cast(case when coalesce(year(data_agendamento),2010)<1999 then 0 else 1 end as int) lote, "
        "'carregado' estado from judged union all select 'ruim.csv.gz', 1, 'quarentena'"
    )

    # Carrier queries.
    sql["range_join_plan"] = (
        _with(*_PLAN, *_NTQ) + _ASSIGNED.format(source="ntq")
    )
    sql["plan_segments"] = _with(*_PLAN) + _SEGMENTS
    sql["carrier_changes"] = _with(*_HIST) + (
        "select tn_inicial, data_agendamento, cod_anterior, cod_receptora from ("
        "select *, lag(cod_receptora, 1, cod_doadora) over "
        "(partition by tn_inicial order by data_agendamento) cod_anterior from hist) "
        f"where data_agendamento between date '{EARLIER_DATE}' and date '{REFERENCE_DATE}' "
        "and cod_anterior is distinct from cod_receptora"
    )
    sql["asof_single_date"] = (
        _with(*_HIST, *_NTQ)
        + "select q.nu_terminal, (select cod_receptora from hist h where h.cn=q.cn "
        "and h.tn_inicial=q.nu_terminal "
        f"and h.data_agendamento <= date '{REFERENCE_DATE}' "
        "order by data_agendamento desc limit 1) cod_receptora from ntq q"
    )
    sql["asof_per_call"] = (
        _with(*_HIST, ("calls", inputs.CALLS))
        + "select c.call_id, c.origem, c.dia, h.cod_receptora from calls c "
        "asof left join hist h on h.tn_inicial=c.origem and h.data_agendamento<=c.dia"
    )
    sql["resolve_carriers"] = _with(*_RESOLVED) + "select * from resolvido"
    sql["portability_rate"] = (
        _with(*_RESOLVED)
        + "select avg(ind_portado)*100 taxa_portabilidade from resolvido"
    )
    sql["carrier_counts"] = (
        _with(*_RESOLVED)
        + "select nome_prestadora, count(*) numeros from resolvido "
        "where nome_prestadora is not null group by nome_prestadora"
    )
    sql["result_csv"] = (
        _with(*_RESOLVED)
        + "select nu_terminal, nome_prestadora, ind_portado, ind_designado from resolvido"
    )
    sql["carrier_change"] = (
        _with(
            *_TABLES,
            *_NTQ,
            *_resolved("ntq", EARLIER_DATE, "1"),
            *_resolved("ntq", REFERENCE_DATE, "2"),
        )
        + "select nu_terminal, a.nome_prestadora nome_prestadora_antes, "
        "b.nome_prestadora nome_prestadora_depois from resolvido1 a "
        "join resolvido2 b using (nu_terminal) "
        "where a.nome_prestadora is distinct from b.nome_prestadora"
    )
    sql["distinct_numbers"] = (
        _with(("calls", inputs.CALLS))
        + "select origem nu_terminal from calls union select destino from calls"
    )
    sql["enrich_cdr"] = (
        _with(
            *_TABLES,
            ("calls", inputs.CALLS),
            (
                "ambos",
                "select cast(origem as varchar) t from calls "
                "union select cast(destino as varchar) from calls",
            ),
            ("ntq", _KEYS.format(column="t", source="ambos")),
            *_resolved("ntq", REFERENCE_DATE),
        )
        + "select c.*, o.nome_prestadora operadora_origem, "
        "d.nome_prestadora operadora_destino from calls c "
        "left join resolvido o on o.nu_terminal=c.origem "
        "left join resolvido d on d.nu_terminal=c.destino"
    )
    sql["enrich_cdr_stream"] = sql["enrich_cdr"]
    return sql
