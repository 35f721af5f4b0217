"""Business values and report definitions, stated as data.

Nothing in here touches Spark except as plain SQL predicate strings, so the
same definitions serve the production codes and any other code set.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values -----------------------------------------------------------
# Names, codes and formats that outputs must reproduce exactly.

ORDER_FILE_LAYOUT = (
    "numero_ov", "data", "tipo_ov", "motivo_ov", "bloqueio_rem",
    "motivo_recusa", "org_vendas", "canal_dist", "setor_ativ", "centro",
    "emissor_da_ordem", "autor", "item", "material", "categoria_do_item",
    "item_superior", "quantidade", "um",
)
BUSINESS_COLUMNS = (
    "numero_ov", "data", "tipo_ov", "motivo_ov", "bloqueio_rem",
    "motivo_recusa", "org_vendas", "canal_dist", "setor_ativ", "centro",
    "emissor_da_ordem", "numero_pedido", "autor", "item", "material",
    "categoria_do_item", "item_superior", "quantidade", "um",
)
SOURCE_COLUMNS = {
    "_source_file_name": "string",
    "_source_file_path": "string",
    "_source_file_modification_time": "timestamp",
}
AUDIT_COLUMNS = ("_ingested_at", "_last_updated_at", "_ingested_by", "_load_type", "_load_id")
RAW_COLUMNS = BUSINESS_COLUMNS + tuple(SOURCE_COLUMNS) + AUDIT_COLUMNS
LINE_KEY = ("numero_ov", "item")
QUANTITY_TYPE = "decimal(18,3)"
PERIOD = "ano_mes"  # partition column of the raw table: yyyymm, 0 without a date
AUDIT_ZONE = "America/Sao_Paulo"

MONTH_ABBREVIATIONS = (
    "Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez",
)
TOTAL_SHEET = "TTL"
UNKNOWN_PREFIX = "OUT"
DEFAULT_SHEET_NAME = "Planilha"
ID_TITLES = {
    "item_principal_cadeia": "Item Principal Cadeia",
    "material": "Material",
    "emissor_da_ordem": "Cliente",
}
CUSTOMER_RENAMES = {"ps": "pais", "local": "cidade", "rg": "estado", "nome_3": "razao_social"}
CHAIN_SUFFIXES = {"0200": "C", "0500": "CG"}
DEFAULT_SITES = {"0200": "0203", "0500": "0503"}
ROUTES = {"kna1": "dm_customers/kna1_sap", "KNA1": "dm_customers/kna1_sap"}
ENRICHED_COLUMNS = (
    "numero_ov", "data", "tipo_ov", "org_vendas", "canal_dist", "emissor_da_ordem", "centro",
    "material", "quantidade", "item_principal_cadeia", "centro_original", "razao_social",
    "estado", "pais",
)
ANALYTICS_FIELDS = {
    "numero_ov": ("numero_ordem_venda", "string"),
    "data": ("data_ordem", "date"),
    "tipo_ov": ("tipo_ordem_venda", "string"),
    "org_vendas": ("organizacao_vendas", "string"),
    "canal_dist": ("canal_distribuicao", "string"),
    "emissor_da_ordem": ("codigo_cliente", "string"),
    "centro": ("centro_fornecedor", "string"),
    "material": ("codigo_material", "string"),
    "quantidade": ("quantidade", "int"),
    "item_principal_cadeia": ("familia_produto", "string"),
    "centro_original": ("centro_distribuicao_original", "string"),
    "razao_social": ("cliente", "string"),
    "estado": ("uf_cliente", "string"),
    "pais": ("pais_cliente", "string"),
}
SHEET_ROWS = 1_048_576  # of the workbook format, header included; longer tables continue on further sheets
SHEET_NAME_LENGTH = 31

WINDOW_MONTHS = 24
CUSTOMER_WINDOW_MONTHS = 12
LEGACY_WINDOW_MONTHS = 48
ANALYTICS_MONTHS = 60
SITE_SHARE_MONTHS = 6
MARKET_SHARE_MONTHS = 12


# --- Segments, codes and reports --------------------------------------------


@dataclass(frozen=True)
class Segment:
    """One sales organisation: its code, file prefix and site sheets."""

    code: str
    prefix: str
    sites: tuple[str, ...]


@dataclass(frozen=True)
class Codes:
    """The order-type and market codes that the reports test for."""

    urgent: str = "ZPUG"
    initial_export: str = "ZESP"
    domestic: str = "01"
    export: str = "02"
    market_names: dict[str, str] = field(default_factory=lambda: {"01": "MI", "02": "ME"})


@dataclass(frozen=True)
class Report:
    """One demand report: what to group by, what to measure, on which rows.

    ``where`` is a SQL predicate over the line columns (empty: all rows).
    ``site_segments`` names the segments that also get one sheet per site.
    """

    name: str
    title: str
    ids: tuple[str, ...]
    measure: str = "sum"
    where: str = ""
    months: int = WINDOW_MONTHS
    site_segments: frozenset[str] = frozenset()

    def sheets(self, segment: Segment) -> tuple[str, ...]:
        sites = segment.sites if segment.code in self.site_segments else ()
        return (TOTAL_SHEET, *sites)


SEGMENTS = (
    Segment("0200", "HDA", ("0203", "0209", "0232")),
    Segment("0500", "HAB", ("0503", "0505")),
)


def _literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def build_reports(
    segments: tuple[Segment, ...] = SEGMENTS,
    codes: Codes = Codes(),
    site_sheets_for_domestic: tuple[str, ...] | None = None,
    site_sheets_for_new_models: tuple[str, ...] | None = None,
    months: int = WINDOW_MONTHS,
    customer_months: int = CUSTOMER_WINDOW_MONTHS,
) -> tuple[Report, ...]:
    """The eight monthly reports.

    By default the domestic report has site sheets for the first segment only
    and every other total/site report has them for all segments. The older
    layout passes ``site_sheets_for_new_models`` to cut that report as well.
    """
    everywhere = frozenset(s.code for s in segments)
    domestic = frozenset(
        site_sheets_for_domestic if site_sheets_for_domestic is not None else (segments[0].code,)
    )
    new_models = (
        everywhere if site_sheets_for_new_models is None else frozenset(site_sheets_for_new_models)
    )
    head = ("item_principal_cadeia",)
    return (
        Report("fechada", "Demanda Fechada", head, months=months, site_segments=everywhere),
        Report(
            "fechada_novos_modelos", "Demanda Fechada Novos Modelos", head, months=months,
            where=f"tipo_ov <> {_literal(codes.initial_export)}", site_segments=new_models,
        ),
        Report("aberta", "Demanda Aberta", ("material",), months=months, site_segments=everywhere),
        Report("linha", "Demanda Linha", head, "count", months=months, site_segments=everywhere),
        Report(
            "mi", "Demanda MI", head, months=months,
            where=f"canal_dist = {_literal(codes.domestic)}", site_segments=domestic,
        ),
        Report("me", "Demanda ME", head, where=f"canal_dist = {_literal(codes.export)}", months=months),
        Report("zpug", "Pedido ZPUG", head, where=f"tipo_ov = {_literal(codes.urgent)}", months=months),
        Report(
            "zpug_cliente", "Pedido ZPUG Cliente", ("item_principal_cadeia", "emissor_da_ordem"),
            where=f"tipo_ov = {_literal(codes.urgent)}", months=customer_months,
        ),
    )


REPORTS = build_reports()
SHARE_TITLE = "Distribuição"
SHARE_NAME = "distribuicao"
TABLE_PREFIX = "refined_demand_"
