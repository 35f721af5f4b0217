"""From raw text lines and loose files to typed order lines and dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom import config
from demandloom.functions import dates, text


def parse_pipe_lines(lines: DataFrame, layout: Sequence[str] = config.ORDER_FILE_LAYOUT) -> DataFrame:
    """Split ``|a|b|…|`` text lines into the columns of ``layout``.

    Dropped: blank lines, lines with another number of fields, header lines,
    and lines whose second field does not look like ``dd.mm.yyyy``. Columns
    other than ``value`` (file metadata) are kept.
    """
    fields = F.col("fields")
    kept = [c for c in lines.columns if c != "value"]
    # Splitting inside a generator keeps the optimiser from copying the split
    # into every filter and field expression below.
    split = F.explode(F.array(F.split(F.regexp_replace("value", "^\\||\\|$", ""), "\\|")))
    return (
        lines.select(*kept, split.alias("fields"))
        .where(
            (F.size(fields) == len(layout))
            & ~F.startswith(fields[0], F.lit("Doc."))
            & F.trim(fields[1]).rlike("^\\d{2}\\.\\d{2}\\.\\d{4}$")
        )
        .select(*kept, *[F.trim(fields[i]).alias(name) for i, name in enumerate(layout)])
    )


def classify_lines(lines: DataFrame, layout: Sequence[str] = config.ORDER_FILE_LAYOUT) -> DataFrame:
    """The lines with ``reject_reason``: NULL for those that :func:`parse_pipe_lines` keeps, why it drops the others.

    ``blank``, ``separator`` (dashes only), ``fields`` (another number of them),
    ``header`` or ``date``, the first that holds. A NULL line is blank.
    """
    fields = F.col("_fields")
    split = F.explode(F.array(F.split(F.regexp_replace(F.coalesce("value", F.lit("")), "^\\||\\|$", ""), "\\|")))
    text = F.trim(F.coalesce("value", F.lit("")))
    reason = (
        F.when(text == "", "blank").when(text.rlike("^-+$"), "separator").when(F.size(fields) != len(layout), "fields")
        .when(F.startswith(fields[0], F.lit("Doc.")), "header")
        .when(~F.trim(fields[1]).rlike("^\\d{2}\\.\\d{2}\\.\\d{4}$"), "date")
    )
    return lines.select(*lines.columns, split.alias("_fields")).select(*lines.columns, reason.alias("reject_reason"))


def render_pipe_lines(lines: DataFrame, layout: Sequence[str] = config.ORDER_FILE_LAYOUT) -> DataFrame:
    """The inverse of :func:`parse_pipe_lines`; missing columns become blanks."""
    types = dict(lines.dtypes)

    def field(name: str) -> Column:
        if name not in types:
            return F.lit("")
        if types[name] in ("date", "timestamp"):
            value = F.date_format(name, "dd.MM.yyyy")
        elif types[name] == "double" or types[name].startswith("decimal"):
            value = text.format_number(F.col(name))
        else:
            value = F.col(name).cast("string")
        return F.coalesce(value, F.lit(""))

    row = F.concat(F.lit("|"), F.concat_ws("|", *[field(n) for n in layout]), F.lit("|"))
    return lines.select(row.alias("value"))


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Blank text becomes NULL in every string column, in one projection."""
    return df.select(
        *[
            text.blank_to_null(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def audit_columns(load_type: str, load_id: str, user: Column | str | None = None) -> dict[str, Column]:
    who = F.current_user() if user is None else F.lit(user) if isinstance(user, str) else user
    return {
        "_ingested_at": dates.local_now(),
        "_last_updated_at": dates.local_now(),
        "_ingested_by": who,
        "_load_type": F.lit(load_type),
        "_load_id": F.lit(load_id),
    }


def type_order_lines(parsed: DataFrame, load_type: str, load_id: str) -> DataFrame:
    """Parsed text columns to the canonical raw table, in its column order."""
    clean = blanks_to_null(parsed)
    derived = {
        "data": text.parse_date(F.col("data")),
        "quantidade": text.parse_number(F.col("quantidade")),
        "numero_pedido": F.lit(None).cast("string"),
        **audit_columns(load_type, load_id),
    }
    missing = {
        name: F.lit(None).cast(kind)
        for name, kind in config.SOURCE_COLUMNS.items()
        if name not in parsed.columns
    }
    return clean.withColumns({**derived, **missing}).select(*config.RAW_COLUMNS)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df


def type_historical_lines(
    history: DataFrame, load_type: str = "INITIAL_LOAD", load_id: str = "", null_as_zero: bool = True
) -> DataFrame:
    """Bootstrap rows (already columnar) to the canonical raw table.

    Expects the file metadata columns of :func:`demandloom.sources.files.read_history`.
    """
    renamed = require_columns(history.toDF(*text.clean_history_headers(history.columns)), config.BUSINESS_COLUMNS)
    quantity = F.col("quantidade").try_cast(config.QUANTITY_TYPE)
    if null_as_zero:
        quantity = F.coalesce(quantity, F.lit(0).cast(config.QUANTITY_TYPE))
    return renamed.withColumns({"quantidade": quantity, **audit_columns(load_type, load_id)}).select(
        *config.RAW_COLUMNS
    )


def rename_headers(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Clean, rename and de-duplicate all headers in one projection."""
    return df.toDF(*text.clean_headers(df.columns, renames))


def promote_header(df: DataFrame, header: Sequence[str | None]) -> DataFrame:
    """Use ``header`` as column names and drop the rows that repeat it.

    Needed only when a reader took the header for data (``_c0``, ``_c1``…).
    The comparison is null-safe and covers all columns.
    """
    repeats = F.lit(True)
    for position, name in enumerate(df.columns):
        value = header[position] if position < len(header) else None
        repeats = repeats & F.col(f"`{name}`").eqNullSafe(F.lit(value))
    return df.where(~repeats).toDF(*text.clean_headers([*header, *[None] * (len(df.columns) - len(header))]))


def chain_dimension(master: DataFrame) -> DataFrame:
    """Part master to (company, part, chain head)."""
    head = text.chain_head(F.col("item_principal_cadeia"), F.col("material"), F.col("empresa"))
    return master.select("empresa", "material", head.alias("item_principal_cadeia"))


def sales_area_dimension(raw: DataFrame) -> DataFrame:
    """Customer sales areas: bare customer number, serving site filled in."""
    return rename_headers(raw).withColumns(
        {
            "cliente": text.strip_leading_zeros(F.col("cliente")),
            "cen": text.default_when_blank(F.col("cen"), F.col("orgv"), config.DEFAULT_SITES),
        }
    )


def customer_dimension(raw: DataFrame) -> DataFrame:
    """Customer master: business names for columns, bare customer number."""
    return rename_headers(raw, config.CUSTOMER_RENAMES).withColumn(
        "cliente", text.strip_leading_zeros(F.col("cliente"))
    )


def rename_and_cast(df: DataFrame, fields: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """Select, rename and cast by map; absent columns are skipped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(old).cast(kind) if kind else F.col(old)).alias(new)
            for old, (new, kind) in fields.items()
            if old in present
        ]
    )


def clean_and_standardise(
    df: DataFrame, date_columns: Sequence[str] = (), number_columns: Sequence[str] = (),
    date_pattern: str | None = None,
) -> DataFrame:
    """Clean names, turn text into dates and numbers (unreadable: NULL), stamp the time.

    ``date_columns`` and ``number_columns`` are the names after cleaning.
    """
    named = rename_headers(df)

    def as_date(name: str) -> Column:
        if date_pattern:
            return F.try_to_date(F.trim(name), date_pattern)
        return F.trim(name).try_cast("date")

    return named.withColumns(
        {
            **{c: as_date(c) for c in date_columns},
            **{c: F.trim(c).try_cast("double") for c in number_columns},
            "created_ts": F.current_timestamp(),
        }
    )


def template_audit(df: DataFrame, keys: Sequence[str], source_system: str) -> DataFrame:
    """Rows with a complete key, stamped with creation columns."""
    return df.dropna(subset=list(keys)).withColumns(
        {
            "created_ts": F.current_timestamp(),
            "updated_ts": F.current_timestamp(),
            "created_by": F.current_user(),
            "source_system": F.lit(source_system),
        }
    )
