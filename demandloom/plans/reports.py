"""The demand reports: long form, wide form and shares.

A report is a ``config.Report``; one function serves all of them. The total
sheet and the site sheets come out of one aggregation, because every row is
tagged with the sheets it belongs to (the total, and its site if listed).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as SqlWindow
from pyspark.sql import functions as F

from demandloom import config
from demandloom.functions import dates
from demandloom.plans.model import report_rows

ID_COLUMNS = ("item_principal_cadeia", "material", "emissor_da_ordem")
LONG_COLUMNS = ("report", "org_vendas", "file", "sheet", *ID_COLUMNS, "month", "value")


def _case(key: Column, values: dict[str, Column], default: Column) -> Column:
    branches = [(key == k, v) for k, v in values.items()]
    if not branches:
        return default
    first = F.when(*branches[0])
    return reduce(lambda c, b: c.when(*b), branches[1:], first).otherwise(default)


def _file_name(segments: Sequence[config.Segment], as_of, title: str) -> Column:
    names = {s.code: F.lit(dates.file_title(s.prefix, as_of, title)) for s in segments}
    return _case(F.col("org_vendas"), names, F.lit(dates.file_title(config.UNKNOWN_PREFIX, as_of, title)))


def _site_listed(report: config.Report, segments: Sequence[config.Segment]) -> Column:
    """True on rows whose site has its own sheet in this report."""
    tests = [
        (F.col("org_vendas") == s.code) & F.col("centro_original").isin(list(s.sites))
        for s in segments
        if s.code in report.site_segments and s.sites
    ]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def thousandths(quantity: Column) -> Column:
    """A quantity with three decimals as a 64-bit count, which sums fast and exactly."""
    return F.round(quantity * 1000).cast("bigint")


def _amount(measure: str) -> Column:
    """The number to add up per line: quantity, or 1 for a line that has one."""
    quantity = F.col("quantidade")
    if measure == "sum":
        return thousandths(quantity)
    return F.when(quantity.isNotNull(), F.lit(1).cast("bigint"))


def _whole(name: str, measure: str) -> Column:
    """A summed amount as a cell: missing is 0, fractions are cut off."""
    column = f"`{name}`"
    value = F.expr(f"{column} div 1000") if measure == "sum" else F.col(column)
    return F.coalesce(value, F.lit(0).cast("bigint"))


def demand_wide(
    lines: DataFrame,
    report: config.Report,
    segments: Sequence[config.Segment],
    window: dates.Window,
    observed_only: bool = False,
) -> DataFrame:
    """One report straight from placed lines: ids × one column per month.

    One shuffle: each month is a conditional sum under the same grouping, and
    the month list is known from the window, so no discovery job runs.
    ``observed_only`` drops months without any row (an extra job finds them).
    """
    window = window.resized(report.months)
    rows = lines.where(
        dates.rows_in(window, lines)
        & F.col("org_vendas").isin([s.code for s in segments])
        & report_rows(report)
    )
    month = dates.month_start(F.col("data"))
    months = window.month_starts
    if observed_only:
        seen = {r["month"] for r in rows.select(month.alias("month")).distinct().collect()}
        months = [m for m in months if m in seen]
    sheets = F.array(F.lit(config.TOTAL_SHEET))
    if report.site_segments:
        sheets = F.when(
            _site_listed(report, segments), F.array(F.lit(config.TOTAL_SHEET), "centro_original")
        ).otherwise(sheets)
    tagged = rows.select(
        "org_vendas", *report.ids, month.alias("month"), _amount(report.measure).alias("amount"),
        F.explode(sheets).alias("sheet"),
    )
    cells = [
        F.sum(F.when(F.col("month") == F.lit(m), F.col("amount"))).alias(f"{m:%Y/%m}") for m in months
    ]
    counted = tagged.groupBy("org_vendas", "sheet", *report.ids).agg(F.count(F.lit(1)).alias("_rows"), *cells)
    return counted.select(
        _file_name(segments, window.as_of, report.title).alias("file"),
        "sheet",
        *[F.col(c).alias(config.ID_TITLES[c]) for c in report.ids],
        *[_whole(f"{m:%Y/%m}", report.measure).alias(f"{m:%Y/%m}") for m in months],
    )


def demand_long(
    cube: DataFrame,
    reports: Sequence[config.Report],
    segments: Sequence[config.Segment],
    window: dates.Window,
) -> DataFrame:
    """All reports and sheets at once, long form, from the monthly cube.

    Every cube row is tagged with the (report, sheet) pairs it feeds and the
    tags are summed in one shuffle with map-side combine. A tag is a small
    number: twice the report's position, plus one for the site sheet.
    """
    tag, total = F.col("tag"), F.lit(config.TOTAL_SHEET)

    def tags(position: int, report: config.Report) -> list[Column]:
        inside = report_rows(report) & (F.col("month") >= F.lit(window.resized(report.months).start))
        on_site = inside & _site_listed(report, segments)
        found = [F.when(inside, F.lit(2 * position))]
        return [*found, F.when(on_site, F.lit(2 * position + 1))] if report.site_segments else found

    def of(*chosen: config.Report) -> Column:
        positions = [i for i, r in enumerate(reports) if r in chosen]
        return tag.isin([2 * i for i in positions] + [2 * i + 1 for i in positions])

    all_tags = F.array(*chain.from_iterable(tags(i, r) for i, r in enumerate(reports)))
    counted = of(*[r for r in reports if r.measure == "count"])
    ids = [F.when(of(*[r for r in reports if c in r.ids]), F.col(c)).alias(c) for c in ID_COLUMNS]
    tagged = cube.select("*", F.explode(F.array_compact(all_tags)).alias("tag"))
    summed = (
        tagged.select(
            "org_vendas", "month", "tag", *ids,
            F.when(tag % 2 == 0, total).otherwise(F.col("centro_original")).alias("sheet"),
            F.when(counted, F.col("linhas")).otherwise(F.col("milesimos")).alias("amount"),
        )
        .groupBy("tag", "org_vendas", "sheet", *ID_COLUMNS, "month")
        .agg(F.sum("amount").alias("amount"))
    )
    report_name = F.element_at(F.array(*[F.lit(r.name) for r in reports]), F.shiftright(tag, 1) + 1)
    names = {r.name: _file_name(segments, window.as_of, r.title) for r in reports}
    value = F.when(counted, _whole("amount", "count")).otherwise(_whole("amount", "sum"))
    labelled = summed.withColumn("report", report_name)
    return labelled.withColumns(
        {"value": value, "file": _case(F.col("report"), names, F.lit(None))}
    ).select(*LONG_COLUMNS)


def widen(
    long: DataFrame, report: config.Report, window: dates.Window, observed_only: bool = False
) -> DataFrame:
    """The wide form of one report from the stored long form."""
    rows = long.where(F.col("report") == report.name)
    months = window.resized(report.months).month_starts
    if observed_only:
        seen = {r["month"] for r in rows.select("month").distinct().collect()}
        months = [m for m in months if m in seen]
    cells = [
        F.coalesce(F.sum(F.when(F.col("month") == F.lit(m), F.col("value"))), F.lit(0).cast("bigint"))
        .alias(f"{m:%Y/%m}")
        for m in months
    ]
    wide = rows.groupBy("file", "sheet", *report.ids).agg(*cells)
    return wide.select(
        "file", "sheet",
        *[F.col(c).alias(config.ID_TITLES[c]) for c in report.ids],
        *[F.col(f"{m:%Y/%m}") for m in months],
    )


def stack_sheets(parts: Sequence[DataFrame]) -> DataFrame:
    """Sheets of one report below each other (older layout). Absent months become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# --- shares -----------------------------------------------------------------


def share_columns(values: Sequence[tuple[str, Column]]) -> list[Column]:
    """``DMD_x`` whole totals, then ``%_x`` of their sum, rounded to 2 places."""
    total = reduce(lambda a, b: a + b, [v for _, v in values])
    share = [
        F.round(F.when(total > 0, v / total * 100).otherwise(0.0), 2).alias(f"%_{name}")
        for name, v in values
    ]
    return [v.alias(f"DMD_{name}") for name, v in values] + share


def observed_values(rows: DataFrame, column: str) -> list[str | None]:
    """Distinct values that become columns of a wide report; for columns with very many, see :func:`share_rows`."""
    found = [r[0] for r in rows.select(column).distinct().collect()]
    return sorted(found, key=lambda v: "null" if v is None else str(v))


def share_rows(lines: DataFrame, column: str, window: dates.Window) -> DataFrame:
    """The same shares in long form, one row per chain head and value, for any number of values."""
    rows = lines.where(dates.rows_in(window, lines))
    summed = rows.groupBy("item_principal_cadeia", F.col(column).alias("value")).agg(
        F.sum(thousandths(F.col("quantidade"))).alias("milesimos"))
    cells = summed.select("item_principal_cadeia", "value", _whole("milesimos", "sum").alias("DMD"))
    total = F.sum("DMD").over(SqlWindow.partitionBy("item_principal_cadeia"))
    return cells.withColumn("%", F.round(F.when(total > 0, F.col("DMD") / total * 100).otherwise(0.0), 2))


def _matches(column: str, value: str | None) -> Column:
    return F.col(column).isNull() if value is None else F.col(column) == value


def _totals(
    column: str, values: Sequence[str | None], inside: Column, amount: Column, prefix: str
) -> list[tuple[str, Column]]:
    """(name, sum) of the amount in thousandths per value of ``column``."""
    return [
        (f"{prefix}{i}", F.sum(F.when(inside & _matches(column, v), amount))) for i, v in enumerate(values)
    ]


def _named_shares(columns: Sequence[str], names: Sequence[str]) -> list[Column]:
    return share_columns([(n, _whole(c, "sum")) for n, c in zip(names, columns)]) if columns else []


def value_share(
    lines: DataFrame, column: str, window: dates.Window, values: Sequence[str | None] | None = None,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Totals and shares per chain head over the values of ``column`` (A4, A5).

    ``values`` are the column's values in report order; without them an extra
    job lists those that occur. A NULL value gives ``DMD_null``.
    """
    names = names or {}
    rows = lines.where(dates.rows_in(window, lines))
    values = observed_values(rows, column) if values is None else values
    titles = [names.get(v, "null" if v is None else v) for v in values]
    ordered = sorted(zip(titles, values), key=lambda p: p[0])
    totals = _totals(column, [v for _, v in ordered], F.lit(True), thousandths(F.col("quantidade")), "v")
    if not totals:
        return rows.select("item_principal_cadeia").distinct()
    grouped = rows.groupBy("item_principal_cadeia").agg(*[c.alias(n) for n, c in totals])
    return grouped.select(
        "item_principal_cadeia", *_named_shares([n for n, _ in totals], [t for t, _ in ordered])
    )


def distribution(
    lines: DataFrame,
    segments: Sequence[config.Segment],
    window: dates.Window,
    sites: dict[str, Sequence[str | None]] | None = None,
    markets: Sequence[str | None] | None = None,
    codes: config.Codes = config.Codes(),
    file_prefix: str | None = None,
    all_markets: bool = False,
    site_months: int = config.SITE_SHARE_MONTHS,
    market_months: int = config.MARKET_SHARE_MONTHS,
) -> DataFrame:
    """Site shares (6 months) beside market shares (12 months), per chain head.

    The two sides share one aggregation with conditional sums; that equals a
    full outer join of the two pivots with gaps set to 0. NULL heads, which a
    join would not match, are kept as one row per side. With several segments
    the site columns of each stand side by side (older layout), and
    ``all_markets`` then counts the markets over every segment.
    """
    codes_wanted = [s.code for s in segments]
    near, far = window.resized(site_months), window.resized(market_months)
    day = F.col("data")
    in_sites = near.contains(day) & F.col("org_vendas").isin(codes_wanted)
    in_markets = far.contains(day)
    if not all_markets:
        in_markets = in_markets & F.col("org_vendas").isin(codes_wanted)
    longest = window.resized(max(site_months, market_months))
    rows = lines.where((in_sites | in_markets) & dates.rows_in(longest, lines))
    if sites is None:
        sites = {
            s.code: observed_values(
                rows.where(near.contains(day) & (F.col("org_vendas") == s.code)), "centro_original"
            )
            for s in segments
        }
    if markets is None:
        markets = observed_values(rows.where(in_markets), "canal_dist")

    all_sites = [v for s in segments for v in sites[s.code]]
    clash = len(all_sites) != len(set(all_sites))
    # A NULL head gets one row per side; other heads one row.
    sides = F.when(
        F.col("item_principal_cadeia").isNotNull(), F.array(F.lit(None).cast("string"))
    ).otherwise(F.array_compact(F.array(
        *[
            F.when(near.contains(day) & (F.col("org_vendas") == s.code), F.lit(s.code)) for s in segments
        ],
        F.when(in_markets, F.lit("market")),
    )))
    amount = F.col("milesimos") if "milesimos" in rows.columns else thousandths(F.col("quantidade"))
    split = rows.withColumns({"_amount": amount, "_side": F.explode(sides)})

    aggregates: list[tuple[str, Column]] = []
    blocks: list[tuple[list[str], list[str]]] = []
    for s in segments:
        titles = [
            (f"{s.prefix}_" if clash else "") + ("null" if v is None else v) for v in sites[s.code]
        ]
        ordered = sorted(zip(titles, sites[s.code]), key=lambda p: p[0])
        inside = near.contains(day) & (F.col("org_vendas") == s.code) & (
            F.col("_side").isNull() | (F.col("_side") == s.code)
        )
        totals = _totals("centro_original", [v for _, v in ordered], inside, F.col("_amount"), f"s{len(blocks)}_")
        aggregates += totals
        blocks.append(([n for n, _ in totals], [t for t, _ in ordered]))
    titles = [codes.market_names.get(v, "null" if v is None else v) for v in markets]
    ordered = sorted(zip(titles, markets), key=lambda p: p[0])
    inside = in_markets & (F.col("_side").isNull() | (F.col("_side") == "market"))
    totals = _totals("canal_dist", [v for _, v in ordered], inside, F.col("_amount"), "m")
    aggregates += totals
    blocks.append(([n for n, _ in totals], [t for t, _ in ordered]))

    grouped = split.groupBy("item_principal_cadeia", "_side").agg(
        F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in aggregates]
    )
    prefix = file_prefix or " ".join(s.prefix for s in segments)
    return grouped.select(
        F.lit(dates.file_title(prefix, window.as_of, config.SHARE_TITLE)).alias("file"),
        F.lit(config.TOTAL_SHEET).alias("sheet"),
        F.col("item_principal_cadeia").alias(config.ID_TITLES["item_principal_cadeia"]),
        *chain.from_iterable(_named_shares(c, t) for c, t in blocks),
    )
