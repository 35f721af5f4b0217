"""The same results as ANSI SQL, written independently of the Spark code."""

from __future__ import annotations

from datetime import date

SEGMENT_SITES = {"AUTOMOBILE": ("AMERICA", "ASIA", "EUROPE"), "MACHINERY": ("AMERICA", "ASIA")}
PREFIX = {"AUTOMOBILE": "AUT", "MACHINERY": "MAC"}
# Month columns are named in the statement, so they are fixed to the sample
# tables, whose latest order is dated 2001-08-01 at every scale.
LAST = (2001, 8)


def _months(n: int) -> list[date]:
    last = LAST[0] * 12 + LAST[1] - 1
    return [date(i // 12, i % 12 + 1, 1) for i in range(last - n + 1, last + 1)]


LINES = """
lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS numero_ov, CAST(l_linenumber AS VARCHAR) AS item,
         CAST(o_orderdate AS DATE) AS data, date_trunc('month', CAST(o_orderdate AS DATE)) AS mes,
         o_orderpriority AS tipo_ov, c_mktsegment AS org_vendas, l_returnflag AS canal_dist,
         l_linestatus AS centro, CAST(o_custkey AS VARCHAR) AS emissor_da_ordem,
         CAST(l_suppkey AS VARCHAR) AS autor, CAST(l_partkey AS VARCHAR) AS material,
         l_quantity AS quantidade, l_shipdate AS filed,
         COALESCE(p_brand, CAST(l_partkey AS VARCHAR)) AS item_principal_cadeia,
         CASE WHEN c_acctbal >= 0 THEN r_name END AS centro_original,
         c_name AS razao_social, n_name AS estado, r_name AS pais
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT p_partkey, p_brand FROM part WHERE p_size <= 40) p ON l_partkey = p_partkey
),
latest AS (SELECT max(mes) AS mes FROM lines)"""

SHORT = ("numero_ov, item, CAST(data AS VARCHAR) AS data, tipo_ov, org_vendas, canal_dist, emissor_da_ordem, "
         "material, CAST(quantidade AS DOUBLE) AS quantidade")
RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY numero_ov, item ORDER BY filed DESC, material DESC, autor DESC) AS rn
  FROM {source}
)"""

TITLES = {
    "fechada": "Demanda Fechada", "fechada_novos_modelos": "Demanda Fechada Novos Modelos",
    "aberta": "Demanda Aberta", "linha": "Demanda Linha", "mi": "Demanda MI", "me": "Demanda ME",
    "zpug": "Pedido ZPUG", "zpug_cliente": "Pedido ZPUG Cliente",
}
FILTERS = {
    "fechada_novos_modelos": "tipo_ov <> '5-LOW'", "mi": "canal_dist = 'A'", "me": "canal_dist = 'R'",
    "zpug": "tipo_ov = '1-URGENT'", "zpug_cliente": "tipo_ov = '1-URGENT'",
}
IDS = {"aberta": ["material"], "zpug_cliente": ["item_principal_cadeia", "emissor_da_ordem"]}
ID_TITLES = {"item_principal_cadeia": "Item Principal Cadeia", "material": "Material", "emissor_da_ordem": "Cliente"}
SITE_SHEETS = {
    "fechada": ("AUTOMOBILE", "MACHINERY"), "fechada_novos_modelos": ("AUTOMOBILE", "MACHINERY"),
    "aberta": ("AUTOMOBILE", "MACHINERY"), "linha": ("AUTOMOBILE", "MACHINERY"), "mi": ("AUTOMOBILE",),
}


def _sheets(name: str) -> list[tuple[str, str, str]]:
    """(segment, sheet, predicate) of every sheet of a report."""
    found = []
    for segment in SEGMENT_SITES:
        found.append((segment, "TTL", "TRUE"))
        if segment in SITE_SHEETS.get(name, ()):
            found += [(segment, s, f"centro_original = '{s}'") for s in SEGMENT_SITES[segment]]
    return found


def _file(segment: str, name: str) -> str:
    return f"{PREFIX[segment]} 2001 Ago {TITLES[name]}"


def _measure(name: str) -> str:
    return "CASE WHEN quantidade IS NOT NULL THEN 1 ELSE 0 END" if name == "linha" else "quantidade"


def _wide_body(name: str, columns: list[date] | None = None, back: int = 24, totals_only: tuple[str, ...] = ()) -> str:
    months = _months(12 if name == "zpug_cliente" else back)
    ids = IDS.get(name, ["item_principal_cadeia"])
    cells = ", ".join(
        f"CAST(SUM(CASE WHEN mes = DATE '{m}' THEN {_measure(name)} ELSE 0 END) AS BIGINT) AS \"{m:%Y/%m}\""
        for m in columns or months
    )
    shown = ", ".join(f'{c} AS "{ID_TITLES[c]}"' for c in ids)
    return " UNION ALL ".join(
        f"SELECT '{_file(segment, name)}' AS file, '{sheet}' AS sheet, {shown}, {cells} FROM lines "
        f"WHERE org_vendas = '{segment}' AND mes >= DATE '{months[0]}' AND {FILTERS.get(name, 'TRUE')} AND {where} "
        f"GROUP BY {', '.join(ids)}"
        for segment, sheet, where in _sheets(name)
        if sheet == "TTL" or segment not in totals_only
    )


def _wide(name: str) -> str:
    return f"WITH {LINES} {_wide_body(name)}"


def _long_body() -> str:
    parts = []
    for name in TITLES:
        ids = IDS.get(name, ["item_principal_cadeia"])
        shown = ", ".join(c if c in ids else f"CAST(NULL AS VARCHAR) AS {c}" for c in ID_TITLES)
        back = 11 if name == "zpug_cliente" else 23
        for segment, sheet, where in _sheets(name):
            parts.append(
                f"SELECT '{name}' AS report, org_vendas, '{_file(segment, name)}' AS file, '{sheet}' AS sheet, {shown}, "
                f"mes AS month, CAST(SUM({_measure(name)}) AS BIGINT) AS value FROM lines "
                f"WHERE org_vendas = '{segment}' AND mes >= (SELECT mes - INTERVAL {back} MONTH FROM latest) "
                f"AND {FILTERS.get(name, 'TRUE')} AND {where} GROUP BY org_vendas, mes, {', '.join(ids)}"
            )
    return " UNION ALL ".join(parts)


def _share(value: str, total: str) -> str:
    # Half-up rounding of the shortest decimal form of the quotient.
    quotient = f"CAST({value} AS DOUBLE) / {total} * 100"
    return (f"CASE WHEN {total} > 0 THEN CAST(round(CAST(CAST({quotient} AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE) "
            "ELSE 0.0 END")


SITES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", None]
MARKETS = [("ME", "R"), ("MI", "A"), ("N", "N")]


def _shares_cte(label: str, column: str, values: list[tuple[str, str | None]], back: int, where: str) -> str:
    sums = ", ".join(
        f"CAST(COALESCE(SUM(CASE WHEN {column} {'IS NULL' if v is None else f'= {v!r}'} THEN quantidade END), 0) AS BIGINT) "
        f'AS "DMD_{t}"'
        for t, v in values
    )
    total = "(" + " + ".join(f'"DMD_{t}"' for t, _ in values) + ")"
    shares = ", ".join(_share(f'"DMD_{t}"', total) + f' AS "%_{t}"' for t, _ in values)
    return (
        f"{label}_sums AS (SELECT item_principal_cadeia, {sums} FROM lines WHERE {where} "
        f"AND mes >= (SELECT mes - INTERVAL {back} MONTH FROM latest) GROUP BY item_principal_cadeia), "
        f"{label} AS (SELECT *, {shares} FROM {label}_sums)"
    )


def _site_values(prefix: str = "") -> list[tuple[str, str | None]]:
    return [(f"{prefix}{s or 'null'}", s) for s in SITES]


def _filled(values: list[tuple[str, str | None]]) -> str:
    names = [f'"DMD_{t}"' for t, _ in values] + [f'"%_{t}"' for t, _ in values]
    return ", ".join(f"COALESCE({n}, 0) AS {n}" for n in names)


def _distribution(segment: str = "AUTOMOBILE") -> str:
    site = _shares_cte("site", "centro_original", _site_values(), 5, f"org_vendas = '{segment}'")
    market = _shares_cte("market", "canal_dist", MARKETS, 11, f"org_vendas = '{segment}'")
    return (
        f"WITH {LINES}, {site}, {market} SELECT '{PREFIX[segment]} 2001 Ago Distribuição' AS file, 'TTL' AS sheet, "
        f'item_principal_cadeia AS "Item Principal Cadeia", {_filled(_site_values())}, {_filled(MARKETS)} '
        "FROM site FULL JOIN market USING (item_principal_cadeia)"
    )


def _share_rows() -> str:
    return (
        f"WITH {LINES}, s AS (SELECT item_principal_cadeia, centro_original AS value, CAST(SUM(quantidade) AS BIGINT) AS \"DMD\" "
        "FROM lines WHERE org_vendas IN ('AUTOMOBILE', 'MACHINERY') AND mes >= (SELECT mes - INTERVAL 5 MONTH FROM latest) "
        "GROUP BY 1, 2), t AS (SELECT *, SUM(\"DMD\") OVER (PARTITION BY item_principal_cadeia) AS total FROM s) "
        f"SELECT item_principal_cadeia, value, \"DMD\", {_share(chr(34) + 'DMD' + chr(34), 'total')} AS \"%\" FROM t"
    )


def _as_of(last: tuple[int, int], label: str) -> str:
    """The closed report with another last month; lines after it are left out."""
    end = date(last[0], last[1], 1)
    index = last[0] * 12 + last[1] - 1
    months = [date(i // 12, i % 12 + 1, 1) for i in range(index - 23, index + 1)]
    cells = ", ".join(f"CAST(SUM(CASE WHEN mes = DATE '{m}' THEN quantidade ELSE 0 END) AS BIGINT) AS \"{m:%Y/%m}\"" for m in months)
    return f"WITH {LINES} " + " UNION ALL ".join(
        f"SELECT '{PREFIX[segment]} {label} Demanda Fechada' AS file, '{sheet}' AS sheet, "
        f'item_principal_cadeia AS "Item Principal Cadeia", {cells} FROM lines WHERE org_vendas = \'{segment}\' '
        f"AND mes BETWEEN DATE '{months[0]}' AND DATE '{end}' AND {where} GROUP BY item_principal_cadeia"
        for segment, sheet, where in _sheets("fechada")
    )


def _distribution_all() -> str:
    ctes = [
        _shares_cte(p.lower(), "centro_original", _site_values(f"{p}_"), 5, f"org_vendas = '{s}'")
        for s, p in PREFIX.items()
    ]
    market = _shares_cte("market", "canal_dist", MARKETS, 11, "TRUE")
    return (
        f"WITH {LINES}, {', '.join(ctes)}, {market} SELECT 'AUT MAC 2001 Ago Distribuição' AS file, 'TTL' AS sheet, "
        f'item_principal_cadeia AS "Item Principal Cadeia", {_filled(_site_values("AUT_"))}, '
        f"{_filled(_site_values('MAC_'))}, {_filled(MARKETS)} FROM aut FULL JOIN mac USING (item_principal_cadeia) "
        "FULL JOIN market USING (item_principal_cadeia)"
    )


def _versions() -> str:
    late = "filed >= TIMESTAMP '1999-01-01'"
    rank = "row_number() OVER (PARTITION BY numero_ov, item ORDER BY filed DESC, material DESC, autor DESC)"
    return (
        f"old AS (SELECT * FROM (SELECT *, {rank} AS rn FROM lines WHERE NOT ({late})) WHERE rn = 1), "
        f"new AS (SELECT * FROM (SELECT *, {rank} AS rn FROM lines WHERE {late}) WHERE rn = 1)"
    )


def _merged(keep_author: bool) -> str:
    names = ["tipo_ov", "org_vendas", "canal_dist", "emissor_da_ordem", "material"]
    picked = ", ".join(f"CASE WHEN n.numero_ov IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in names)
    author = "COALESCE(o.autor, n.autor)" if keep_author else "COALESCE(n.autor, o.autor)"
    return (
        f"WITH {LINES}, {_versions()} SELECT COALESCE(n.numero_ov, o.numero_ov) AS numero_ov, "
        f"COALESCE(n.item, o.item) AS item, CAST(COALESCE(n.data, o.data) AS VARCHAR) AS data, {picked}, "
        f"CAST(COALESCE(n.quantidade, o.quantidade) AS DOUBLE) AS quantidade, {author} AS autor "
        "FROM old o FULL JOIN new n ON o.numero_ov = n.numero_ov AND o.item = n.item"
    )


HISTORY = """
WITH versions AS (
  SELECT o_custkey, o_orderdate AS ts, o_orderpriority,
         row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders
), marked AS (
  SELECT *, lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY ts) AS before FROM versions WHERE rn = 1
), changed AS (
  SELECT * FROM marked WHERE before IS NULL OR before <> o_orderpriority
), closed AS (
  SELECT *, lead(ts) OVER (PARTITION BY o_custkey ORDER BY ts) AS until FROM changed
)
SELECT o_custkey, o_orderpriority, strftime(ts, '%Y-%m-%d') AS valid_from_ts, strftime(until, '%Y-%m-%d') AS valid_to_ts,
       until IS NULL AS is_current_flg FROM closed"""

CHAIN = """
WITH master AS (
  SELECT CASE WHEN p_partkey % 2 = 0 THEN '0200' ELSE '0500' END AS empresa,
         CAST(p_partkey AS VARCHAR) || CASE WHEN p_size % 6 = 1 THEN '  C' ELSE '' END AS material,
         CASE p_size % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'Sim' WHEN 3 THEN p_brand || '  C'
              WHEN 4 THEN p_brand || ' G' ELSE p_brand END AS head
  FROM part
), chosen AS (
  SELECT empresa, material, CASE WHEN head IS NULL OR trim(head) IN ('', 'Sim') THEN material ELSE head END AS head FROM master
), cleaned AS (
  SELECT empresa, material, CASE empresa WHEN '0200' THEN regexp_replace(head, '\\s+C$', '')
         ELSE regexp_replace(head, '\\s+[CG]$', '') END AS item_principal_cadeia FROM chosen
)"""


def _rollup() -> str:
    return f"""
WITH {LINES}, long AS ({_long_body()}),
rows_ AS (SELECT DISTINCT org_vendas, report, sheet, item_principal_cadeia, material, emissor_da_ordem FROM long)
SELECT org_vendas, report, sheet, count(*) AS rows,
       CAST(GROUPING(org_vendas, report, sheet) AS INTEGER) AS level FROM rows_ GROUP BY ROLLUP (org_vendas, report, sheet)"""


def _profile() -> str:
    columns = ["numero_ov", "org_vendas", "canal_dist", "centro_original"]
    nulls = " ".join(f"UNION ALL SELECT 'nulls:{c}', count(*) - count({c}) FROM t" for c in columns)
    return (
        f"WITH {LINES}, t AS (SELECT {', '.join(columns)} FROM lines) SELECT 'total_rows' AS metric, count(*) AS value FROM t "
        f"UNION ALL SELECT 'duplicate_rows', (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t)) {nulls}"
    )


# The columns of the sample tables.
COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
}


def _profile_all() -> str:
    odd = ("(SELECT CASE l_orderkey % 3 WHEN 0 THEN l_quantity / 2 WHEN 1 THEN l_quantity END AS quantidade, "
           "CASE WHEN l_orderkey % 3 <> 2 THEN l_returnflag END AS tipo_ov FROM lineitem)")
    parts = []
    for table, source, columns in [*((t, t, c) for t, c in COLUMNS.items()), ("odd_lines", odd, "quantidade tipo_ov")]:
        parts.append(f"SELECT '{table}' AS \"table\", 'total_rows' AS metric, count(*) AS value FROM {source}")
        parts.append(f"SELECT '{table}', 'duplicate_rows', (SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source}))")
        parts += [f"SELECT '{table}', 'nulls:{c}', count(*) - count({c}) FROM {source}" for c in columns.split()]
    return " UNION ALL ".join(parts)


QUALITY = """
WITH n AS (SELECT count(*) AS rows FROM lineitem), checks AS (
  SELECT 'filled:l_orderkey' AS rule, count(*) - count(l_orderkey) AS failed FROM lineitem
  UNION ALL SELECT 'filled:l_linenumber', count(*) - count(l_linenumber) FROM lineitem
  UNION ALL SELECT 'type:l_shipdate', 0
  UNION ALL SELECT 'domain:l_returnflag', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'R')) FROM lineitem
  UNION ALL SELECT 'positive_quantity', count(*) FILTER (WHERE NOT l_quantity > 0) FROM lineitem
  UNION ALL SELECT 'small_discount', count(*) FILTER (WHERE NOT l_discount < 0.05) FROM lineitem
  UNION ALL SELECT 'unique:l_orderkey,l_linenumber',
            (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
  UNION ALL SELECT 'reference:l_partkey', count(*) FROM lineitem
            WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_size <= 40 AND p_partkey = l_partkey)
)
SELECT rule, rows, failed, failed = 0 AS passed FROM checks CROSS JOIN n"""


def _state_months(n: int) -> str:
    cells = ", ".join(
        f"CAST(SUM(CASE WHEN mes = DATE '{m}' THEN quantidade ELSE 0 END) AS BIGINT) AS \"{m:%Y/%m}\"" for m in _months(n)
    )
    return (f"WITH {LINES} SELECT estado, canal_dist AS canal, {cells} FROM lines "
            f"WHERE mes >= DATE '{_months(n)[0]}' GROUP BY estado, canal_dist")


def _segment_months() -> str:
    cells = ", ".join(
        f"CAST(SUM(CASE WHEN mes = DATE '{m}' THEN quantidade ELSE 0 END) AS BIGINT) AS \"{m:%Y/%m}\"" for m in _months(6)
    )
    return (f"WITH {LINES} SELECT CASE WHEN org_vendas = 'AUTOMOBILE' THEN 'AUT' ELSE 'OUT' END AS \"Segmento\", "
            f"item_principal_cadeia AS \"Item Principal Cadeia\", estado AS \"Estado\", {cells} FROM lines "
            f"WHERE mes >= DATE '{_months(6)[0]}' GROUP BY 1, 2, 3")


def _export_plan() -> str:
    def body(name: str) -> str:
        return (f"SELECT file, 'refined_demand_{name}' AS \"table\", sheet, count(*) AS rows "
                f"FROM ({_wide_body(name, _months(1))}) GROUP BY file, sheet")

    return (f"WITH {LINES}, p AS ({body('fechada')} UNION ALL {body('mi')}) SELECT *, CAST(row_number() OVER "
            "(PARTITION BY file ORDER BY sheet <> 'TTL', sheet) AS INTEGER) AS position, sheet AS name FROM p")


READBACK_MONTHS = [date(2001, m, 1) for m in (5, 6, 7, 8)]


def _readback() -> str:
    cells = ", ".join(f'"{m:%Y/%m}" AS "{m:%Y_%m}"' for m in READBACK_MONTHS)
    return (f"WITH {LINES}, w AS ({_wide_body('fechada', READBACK_MONTHS)}) "
            f'SELECT "Item Principal Cadeia" AS item_principal_cadeia, {cells} FROM w WHERE sheet = \'TTL\'')


def _latest(columns: str = SHORT) -> str:
    return f"WITH {LINES}, {RANKED.format(source='lines')} SELECT {columns} FROM ranked WHERE rn = 1"


def oracle_sql() -> dict[str, str]:
    enriched = ("numero_ov, CAST(data AS VARCHAR) AS data, tipo_ov, org_vendas, canal_dist, emissor_da_ordem, centro, material, "
                "CAST(quantidade AS DOUBLE) AS quantidade, item_principal_cadeia, centro_original, razao_social, estado, pais")
    analytics = ("numero_ov AS numero_ordem_venda, CAST(data AS VARCHAR) AS data_ordem, tipo_ov AS tipo_ordem_venda, "
                 "org_vendas AS organizacao_vendas, canal_dist AS canal_distribuicao, emissor_da_ordem AS codigo_cliente, "
                 "centro AS centro_fornecedor, material AS codigo_material, CAST(quantidade AS INTEGER) AS quantidade, "
                 "item_principal_cadeia AS familia_produto, centro_original AS centro_distribuicao_original, "
                 "razao_social AS cliente, estado AS uf_cliente, pais AS pais_cliente")
    all_lines = f"WITH {LINES} SELECT {SHORT} FROM lines"
    market = _shares_cte("market", "canal_dist", MARKETS, 11, "org_vendas = 'AUTOMOBILE'")
    site = _shares_cte("site", "centro_original", _site_values(), 5, "org_vendas = 'AUTOMOBILE'")
    refreshed = (f"WITH {LINES} SELECT {SHORT} FROM lines WHERE canal_dist = 'A' OR year(data) <> 2000 OR "
                 "mes NOT IN (SELECT mes FROM lines WHERE canal_dist = 'A' AND year(data) = 2000)")
    return {
        "j1_j3_enriched_lines": f"WITH {LINES} SELECT {enriched} FROM lines",
        "j1_j3_large_lookups": f"WITH {LINES} SELECT {enriched} FROM lines",
        "a1_reference_window": f"""WITH {LINES}, m AS (SELECT max(data) AS d, max(mes) AS mes FROM lines)
            SELECT CAST(d AS VARCHAR) AS reference_date,
                   CAST(CAST(mes - INTERVAL 23 MONTH AS DATE) AS VARCHAR) AS start_date,
                   CAST(CAST(mes - INTERVAL 11 MONTH AS DATE) AS VARCHAR) AS customer_start,
                   CAST(CAST(mes + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS end_date FROM m""",
        "d1_closed_wide": _wide("fechada"),
        "d2_closed_new_models_wide": _wide("fechada_novos_modelos"),
        "d3_open_wide": _wide("aberta"),
        "d4_line_count_wide": _wide("linha"),
        "d5_domestic_wide": _wide("mi"),
        "d6_export_wide": _wide("me"),
        "d7_urgent_wide": _wide("zpug"),
        "d8_urgent_by_customer_wide": _wide("zpug_cliente"),
        "d1_d8_all_reports_long": f"WITH {LINES} SELECT * REPLACE (CAST(CAST(month AS DATE) AS VARCHAR) AS month) FROM ({_long_body()})",
        "d1_closed_from_long": _wide("fechada"),
        "d9_distribution": _distribution(),
        "d9_distribution_second_segment": _distribution("MACHINERY"),
        "d9_distribution_of_the_run": f"""WITH shares AS (SELECT "Item Principal Cadeia" AS head, CAST(COLUMNS('^(DMD|%)_') AS DOUBLE)
            FROM ({_distribution("MACHINERY")})), cells AS (UNPIVOT shares ON COLUMNS(* EXCLUDE head) INTO NAME cell VALUE value)
            SELECT head, cell, value FROM cells WHERE value <> 0""",
        "d1_as_of_month": _as_of((2000, 6), "2000 Jun"),
        "a4_a5_share_rows": _share_rows(),
        "d9_distribution_all_segments": _distribution_all(),
        "d10_analytics_typed": f"WITH {LINES} SELECT {analytics} FROM lines WHERE mes >= (SELECT mes - INTERVAL 59 MONTH FROM latest)",
        "d11_stacked_sheets": f"WITH {LINES} {_wide_body('fechada_novos_modelos', back=48, totals_only=('MACHINERY',))}",
        "a4_site_share": f"WITH {LINES}, {site} SELECT * FROM site",
        "a5_market_share": f"WITH {LINES}, {market} SELECT * FROM market",
        "j4_shares_full_join": (
            f'WITH {LINES}, {site}, {market} SELECT item_principal_cadeia AS "Item Principal Cadeia", '
            f"{_filled(_site_values())}, {_filled(MARKETS)} FROM site FULL JOIN market USING (item_principal_cadeia)"
        ),
        "a11_customer_totals": f"""WITH {LINES} SELECT razao_social, estado, CAST(sum(quantidade) AS DOUBLE) AS quantidade FROM lines
            WHERE org_vendas = 'AUTOMOBILE' AND mes >= (SELECT mes - INTERVAL 11 MONTH FROM latest) GROUP BY 1, 2""",
        "a12_segment_state_months": _segment_months(),
        "f11_ad_hoc_lines": f"""WITH {LINES} SELECT numero_ov, item, CAST(data AS VARCHAR) AS data, material,
            CAST(quantidade AS DOUBLE) AS quantidade, razao_social, estado FROM lines
            WHERE data BETWEEN DATE '2001-01-01' AND DATE '2001-06-30' AND estado = 'NATION_3'""",
        "a6_latest_per_key": _latest(),
        "k1_upsert": _merged(True),
        "k1_upsert_table": _merged(True),
        "k1_upsert_indexed": _merged(True),
        "k3_swapped_table": "SELECT o_orderkey, o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus <> 'P'",
        "k2_create_or_merge": _merged(False),
        "k3_replace_table": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
        "k5_append_evolving": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) END AS o_custkey,
            o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders""",
        "k6_append_by_name": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
        "k7_configured_replace": "SELECT p_brand, count(*) AS parts FROM part GROUP BY p_brand",
        "k8_materialized_view": "SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY s_nationkey",
        "k8_incremental_cube": f"""SELECT org_vendas, canal_dist, tipo_ov, material, CAST(round(sum(quantidade * 1000)) AS BIGINT) AS milesimos,
            count(quantidade) AS linhas FROM ({_merged(False)}) WHERE data NOT LIKE '1999-03-%' GROUP BY 1, 2, 3, 4""",
        "k9_delete_month": f"WITH {LINES} SELECT {SHORT} FROM lines WHERE NOT (year(data) = 2000 AND month(data) = 6)",
        "t3_replace_period": refreshed,
        "t3_replace_period_table": refreshed,
        "k16_add_columns": """SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS _source_file_name,
            CAST(NULL AS VARCHAR) AS _source_file_path FROM orders""",
        "k19_write_metrics": f"""WITH {LINES} SELECT count(*) AS rows, CAST(sum(quantidade) AS DOUBLE) AS quantity,
            CAST(min(data) AS VARCHAR) AS first_date, CAST(max(data) AS VARCHAR) AS last_date FROM lines""",
        "k20_compacted_table": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
        "k18_rules_on_write": """WITH c AS (SELECT count(*) AS n, count(*) FILTER (o_orderpriority LIKE '1%') AS n1,
                count(*) FILTER (o_orderpriority LIKE '2%' AND o_totalprice > 0) AS n2,
                count(*) FILTER (o_orderpriority LIKE '3%') AS n3 FROM orders)
            SELECT write, reason, rows FROM (
                SELECT write, unnest(['not_null:cust', 'check:price', 'key:taken', 'kept']) AS reason,
                    unnest([n1, n2, CASE WHEN write = 'append' THEN n3 ELSE 0 END,
                            CASE write WHEN 'replace' THEN n - n1 - n2 ELSE n + n - n1 - n2 - n3 END]) AS rows
                FROM c, (VALUES ('append'), ('merge'), ('replace')) AS w(write)) WHERE rows > 0""",
        "w1_dimension_history": HISTORY,
        "w1_extended_history": HISTORY,
        "w1_null_keys": HISTORY.replace(
            "FROM orders", "FROM (SELECT * REPLACE (CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS o_custkey) FROM orders)"),
        "k4_drop_and_recreate": "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cliente FROM orders",
        "k10_clear_outputs": """SELECT 'raw_supplier' AS "table", count(*) AS rows FROM supplier
            UNION ALL SELECT 'raw_nation', count(*) FROM nation""",
        "k17_k18_metadata": """SELECT key, value, rows FROM (VALUES ('business_owner', 'planning'), ('tag.layer', 'raw'),
            ('tag.c_name.pii', 'yes'), ('primary_key', 'c_custkey'), ('comment.c_name', concat('the ', chr(39), 'name', chr(39))))
            AS t(key, value) CROSS JOIN (SELECT count(*) AS rows FROM customer)""",
        "p8_p10_audit_columns": f"""WITH {LINES} SELECT numero_ov, item, CAST(NULL AS VARCHAR) AS numero_pedido,
            'TEST' AS _load_type, 'load-1' AS _load_id, TRUE AS _ingested_at, TRUE AS _last_updated_at, TRUE AS _ingested_by,
            'numero_ov data tipo_ov motivo_ov bloqueio_rem motivo_recusa org_vendas canal_dist setor_ativ centro '
            || 'emissor_da_ordem numero_pedido autor item material categoria_do_item item_superior quantidade um '
            || '_source_file_name _source_file_path _source_file_modification_time _ingested_at _last_updated_at '
            || '_ingested_by _load_type _load_id' AS column_order FROM lines""",
        "t3_full_refresh": f"""WITH {LINES}, {RANKED.format(source='lines')}
            SELECT {SHORT} FROM ranked WHERE rn = 1 AND canal_dist = 'A'""",
        "a9_duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
            GROUP BY 1, 2 HAVING count(*) > 1""",
        "a9_key_summary": """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
            SELECT CAST(sum(n) AS BIGINT) AS total_rows,
                   CAST(COALESCE(sum(n) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL), 0) AS BIGINT) AS null_key_rows,
                   count(*) FILTER (WHERE n > 1) AS duplicate_keys FROM k""",
        "a14_table_profile": _profile(),
        "a14_profile_all_columns": _profile_all(),
        "a15_quality_report": QUALITY,
        "t2_line_rejects": """SELECT load, reject_reason, (SELECT count(*) FROM nation) AS rows
            FROM (VALUES ('load-1'), ('load-2')) AS l(load) CROSS JOIN (VALUES ('header'), ('separator'), ('blank'), ('fields'), ('date')) AS r(reject_reason)
            UNION ALL SELECT 'read', CAST(NULL AS VARCHAR), count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              JOIN customer ON o_custkey = c_custkey""",
        "j7_orphan_orders": """SELECT o_orderkey, o_custkey FROM orders
            WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
        "j7_orphan_documents": """SELECT doc_id, lang FROM documents d
            WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
        "a7_load_summary": f"""WITH {LINES} SELECT strftime(filed, '%Y-%m') AS _source_file_name, count(*) AS rows,
            count(DISTINCT numero_ov) AS orders, strftime(min(data), '%Y/%m/%d') AS data_min,
            strftime(max(data), '%Y/%m/%d') AS data_max FROM lines GROUP BY 1""",
        "a8_report_row_counts": _rollup(),
        "a10_date_span_by_segment": f"""WITH {LINES} SELECT org_vendas, strftime(min(data), '%d/%m/%Y') AS data_inicial,
            strftime(max(data), '%d/%m/%Y') AS data_final, strftime(min(filed), '%d/%m/%Y') AS upload FROM lines GROUP BY 1""",
        "a10_date_span_by_file": f"""WITH {LINES} SELECT org_vendas, strftime(filed, '%Y-%m') AS _source_file_name,
            strftime(min(data), '%Y/%m/%d') AS data_inicial, strftime(max(data), '%Y/%m/%d') AS data_final
            FROM lines WHERE org_vendas = 'MACHINERY' GROUP BY 1, 2""",
        "a13_file_sheets": f"WITH {LINES} SELECT file, count(DISTINCT sheet) AS sheets FROM ({_long_body()}) GROUP BY file",
        "p18_p19_chain_head": f"{CHAIN} SELECT * FROM cleaned",
        "a16_changed_heads": f"{CHAIN} SELECT * FROM cleaned WHERE material <> item_principal_cadeia",
        "j1_chain_closure": """WITH RECURSIVE parts AS (
              SELECT p_partkey AS part, CASE WHEN p_partkey % 40 = 10 THEN p_partkey + 1 WHEN p_partkey % 40 = 11 THEN p_partkey - 1
                WHEN p_size <= 45 THEN p_partkey // 2 END AS successor FROM part
            ), walk AS (
              SELECT part AS origin, part AS spot, [part] AS seen, FALSE AS cycle FROM parts
              UNION ALL
              SELECT origin, p.successor, list_append(seen, p.successor), list_contains(seen, p.successor)
              FROM walk JOIN parts p ON p.part = walk.spot WHERE NOT cycle AND p.successor IS NOT NULL AND p.successor <> walk.spot
            ), ends AS (
              SELECT origin, arg_max(spot, len(seen)) AS head, max(len(seen)) - 1 AS depth, bool_or(cycle) AS cycle FROM walk GROUP BY origin
            )
            SELECT '0200' AS empresa, CAST(origin AS VARCHAR) AS material, CAST(CASE WHEN cycle THEN origin ELSE head END AS VARCHAR)
              AS item_principal_cadeia, CASE WHEN NOT cycle THEN CAST(depth AS BIGINT) END AS depth, cycle FROM ends""",
        "p1_p8_parse_lines": all_lines,
        "s2_read_order_files": f"WITH {LINES} SELECT {SHORT}, TRUE AS from_text FROM lines",
        "s3_read_history": all_lines.replace(
            "CAST(quantidade AS DOUBLE)", "CASE WHEN canal_dist = 'N' THEN 0.0 ELSE CAST(quantidade AS DOUBLE) END"
        ),
        "p5_blank_to_null": """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS status,
            CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority FROM orders""",
        "p6_date_parse": """WITH t AS (SELECT o_orderkey, o_orderdate, lpad(CAST(day(o_orderdate) + 3 AS VARCHAR), 2, '0')
              || strftime(o_orderdate, '.%m.%Y') AS written FROM orders)
            SELECT o_orderkey, written, CASE WHEN day(o_orderdate) + 3 <= day(last_day(o_orderdate))
              THEN strftime(o_orderdate + INTERVAL 3 DAY, '%Y-%m-%d') END AS parsed FROM t""",
        "p7_number_parse": """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> 'N' THEN
            CASE WHEN l_linestatus = 'F' THEN '-' ELSE '' END || format('{:,.2f}', l_extendedprice) END AS parsed FROM lineitem""",
        "p16_strip_zeros": """SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS padded,
            CASE WHEN c_custkey = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS bare FROM customer""",
        "p17_default_site": """WITH t AS (SELECT CASE WHEN c_custkey = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS cliente,
              CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '0200' WHEN 'MACHINERY' THEN '0500' ELSE '0900' END AS orgv,
              unnest(['A', 'N', 'R']) AS cdst, '00' AS sa, CASE WHEN c_acctbal >= 0 AND r_name <> 'ASIA' THEN r_name END AS cen
              FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
            SELECT cliente, orgv, cdst, sa, COALESCE(cen, CASE orgv WHEN '0200' THEN '0203' WHEN '0500' THEN '0503' END) AS cen FROM t""",
        "p15_customer_dimension": """SELECT CASE WHEN c_custkey = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS cliente,
            r_name AS pais, n_name AS estado, c_name AS razao_social, upper(n_name) AS cidade
            FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
        "p14_promote_header": """SELECT CAST(o_orderkey AS VARCHAR) AS pedido_no,
            CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS situacao FROM orders""",
        "p30_p31_cell_text": """WITH t AS (SELECT doc_id, list_extract(['=', '+', '-', '@', chr(9), chr(13), chr(1), ''],
              CAST(doc_id % 8 + 1 AS BIGINT)) || text AS value FROM documents),
            c AS (SELECT doc_id, regexp_replace(value, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g') AS value FROM t),
            s AS (SELECT doc_id, CASE WHEN left(value, 1) IN ('=', '+', '-', '@', chr(9), chr(13)) THEN '''' || value ELSE value END AS value FROM c)
            SELECT doc_id, md5(value) AS digest, length(value) AS length FROM s""",
        "p32_sheet_names": """SELECT page_id, CASE WHEN s = '' THEN 'Planilha' ELSE s END AS sheet FROM (SELECT page_id,
            left(trim(regexp_replace(url, '[\\[\\]:*?/\\\\]', '-', 'g'), ''''), 31) AS s FROM pages)""",
        "p33_unsafe_names": """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN source || '/' || lang ELSE source || '..xlsx' END AS name
            FROM documents WHERE doc_id % 3 <> 2 OR source LIKE '%/%' OR source LIKE '%..%'""",
        "p35_template_audit": "SELECT o_orderkey AS id_order, o_orderstatus, 'sample' AS source_system FROM orders WHERE o_orderstatus <> 'P'",
        "p36_clean_and_standardise": """SELECT o_orderkey AS order_key,
            CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
            CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS VARCHAR) END AS cust_no FROM orders""",
        "s6_table_scan": "SELECT * FROM supplier",
        "s7_file_source": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
        "s7_query_source": "SELECT p_brand, count(*) AS parts FROM part GROUP BY p_brand",
        "s8_metric_view": """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity, count(DISTINCT l_orderkey) AS orders,
            count(*) AS lines FROM lineitem GROUP BY 1, 2""",
        "s8_metric_dimensions": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
        "s9_table_row_counts": """SELECT 'refined_demand_orders' AS "table", count(*) AS rows FROM orders
            UNION ALL SELECT 'refined_demand_customer', count(*) FROM customer
            UNION ALL SELECT 'refined_demand_part', count(*) FROM part""",
        "s11_file_routing": """WITH t AS (SELECT CASE WHEN l_linestatus = 'O' THEN l_returnflag || '_' || CAST(l_orderkey AS VARCHAR) || '_x.txt'
              ELSE l_returnflag || '.tar.gz' END AS name, CASE WHEN l_linestatus = 'O' THEN l_returnflag ELSE l_returnflag || '.tar' END AS prefix
              FROM lineitem)
            SELECT name, 'in/' || name AS path, prefix,
              CASE prefix WHEN 'A' THEN 'dest/a/' || name WHEN 'R.tar' THEN 'dest/r/' || name END AS destination,
              CASE WHEN prefix IN ('A', 'R.tar') THEN 'planned' ELSE 'error' END AS status FROM t""",
        "k11_k12_csv_export": "SELECT l_partkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1",
        "k13_export_plan": _export_plan(),
        "k14_s4_workbook_readback": _readback(),
        "k15_single_csv": _state_months(3),
        "k15_single_json": _state_months(3),
        "k15_single_excel": _state_months(3),
        "t1_stream_ingest": _merged(False).replace(", COALESCE(n.autor, o.autor) AS autor", ""),
        "t3_stream_period_refresh": f"""WITH {LINES}, {RANKED.format(source='lines')}, k AS (SELECT * FROM ranked WHERE rn = 1)
            SELECT {SHORT} FROM k WHERE canal_dist = 'A' OR year(data) <> 2000 OR
            mes NOT IN (SELECT mes FROM k WHERE canal_dist = 'A' AND year(data) = 2000)""",
    }
