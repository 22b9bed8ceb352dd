"""Ratio-of-means imputation.

The panel has one row per (reference, period, questioncode).  Windows run along the
months of one (reference, questioncode), so a group never exceeds the calendar.  All of them
take the months in one order and share one sort: a chain multiplies the part of the series' list
of links between its start and the row, forward or backward.  Links are
aggregated per (questioncode, class, period) with map-side partial sums and joined back, so
a class that holds most of the panel never lands on one task.  The join carries no
broadcast hint: Spark decides by the size of the link table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tallyworks import constants as c
from tallyworks.functions.expressions import exact_sum, month_index
from tallyworks.functions.joins import by_partition
from tallyworks.settings import SurveySettings

LINK_KEY = (c.QUESTION, c.CLASS, c.PERIOD)
F_MATCH, B_MATCH = f"f_match_{c.TARGET}", f"b_match_{c.TARGET}"
F_LINK, B_LINK = f"f_link_{c.TARGET}", f"b_link_{c.TARGET}"
F_DEFAULT, B_DEFAULT = f"default_link_{F_MATCH}", f"default_link_{B_MATCH}"
C_MATCH, C_LINK = "flag_construction_matches", "construction_link"
C_DEFAULT = f"default_link_{C_MATCH}"
MANUAL = f"{c.TARGET}_man"


def _months() -> WindowSpec:
    return Window.partitionBy(c.REFERENCE, c.QUESTION).orderBy(c.PERIOD)


def _so_far() -> WindowSpec:
    """Months of the series up to this one."""
    return _months().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _from_here() -> WindowSpec:
    """This month of the series and the later ones."""
    return _months().rowsBetween(Window.currentRow, Window.unboundedFollowing)


def _links_of_series(link: str) -> Column:
    """The link of every month of the series, earliest first; a missing one changes nothing."""
    return F.collect_list(F.coalesce(link, F.lit(1.0))).over(
        _months().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def _chained(start: Column, links: Column) -> Column:
    """A value times the links of its chain, in the order of the list."""
    return start * F.aggregate(links, F.lit(1.0), lambda chain, link: chain * link)


# What an imputation chain is called, by the marker of the value it starts from.
_CHAIN_KIND = {"mc": "fimc", "fimc": "fimc", "c": "fic", "fic": "fic"}


def mark_backdata(df: DataFrame, settings: SurveySettings) -> DataFrame:
    return df.withColumn("is_backdata", F.col(c.PERIOD) == settings.backdata_period)


def returned_value(df: DataFrame) -> Column:
    """The answer, unless back data says it was itself imputed."""
    answer = F.col(c.TARGET)
    if c.MARKER not in df.columns:
        return answer
    marker = F.col(c.MARKER)
    return F.when(marker.isNull() | (marker == "r"), answer)


def match_flags(df: DataFrame) -> DataFrame:
    """Returned in this month and in the calendar month before (f) or after (b)."""
    month, value = month_index(F.col(c.PERIOD)), returned_value(df)
    rows = df.withColumns({"_month": month, "_returned": value})
    rows = rows.withColumns({
        "_before": F.when(F.lag("_month").over(_months()) == F.col("_month") - 1,
                          F.lag("_returned").over(_months())),
        "_after": F.when(F.lead("_month").over(_months()) == F.col("_month") + 1,
                         F.lead("_returned").over(_months())),
    })
    here = F.col("_returned").isNotNull()
    return rows.withColumns({
        F_MATCH: here & F.col("_before").isNotNull(),
        B_MATCH: here & F.col("_after").isNotNull(),
        C_MATCH: here & F.col(c.MONTHLY_AUXILIARY).isNotNull(),
    })


def _link_rows(df: DataFrame, link_filter: DataFrame | None) -> DataFrame:
    """Rows that may enter link sums: all but those the link filter lists."""
    rows = match_flags(df)
    if link_filter is None:
        return rows
    keys = [name for name in link_filter.columns if name in c.CELL_KEY]
    return rows.join(by_partition(link_filter.select(*keys).distinct()), keys, "left_anti")


def _ratio(numerator: Column, denominator: Column) -> Column:
    """A link: missing when nothing matched or the denominator is zero."""
    return F.try_divide(numerator, denominator)


def link_table(df: DataFrame, link_filter: DataFrame | None = None) -> DataFrame:
    """Forward, backward and construction links with match counts per
    (questioncode, class, period).  A link that cannot be formed is 1, flagged as default.
    """
    rows = _link_rows(df, link_filter)
    f, b, k = F.col(F_MATCH), F.col(B_MATCH), F.col(C_MATCH)
    value = F.col("_returned")
    sums = rows.groupBy(*LINK_KEY).agg(
        F.count_if(f).alias(f"{F_MATCH}_count"),
        F.count_if(b).alias(f"{B_MATCH}_count"),
        F.count_if(k).alias(f"{C_MATCH}_count"),
        exact_sum(F.when(f, value)).alias("_f_top"),
        exact_sum(F.when(f, F.col("_before"))).alias("_f_bottom"),
        exact_sum(F.when(b, value)).alias("_b_top"),
        exact_sum(F.when(b, F.col("_after"))).alias("_b_bottom"),
        exact_sum(F.when(k, value)).alias("_c_top"),
        exact_sum(F.when(k, F.col(c.MONTHLY_AUXILIARY))).alias("_c_bottom"),
    )
    links = sums.withColumns({
        F_LINK: _ratio(F.col("_f_top"), F.col("_f_bottom")),
        B_LINK: _ratio(F.col("_b_top"), F.col("_b_bottom")),
        C_LINK: _ratio(F.col("_c_top"), F.col("_c_bottom")),
    })
    out = []
    for link, default in ((F_LINK, F_DEFAULT), (B_LINK, B_DEFAULT), (C_LINK, C_DEFAULT)):
        out += [F.coalesce(F.col(link), F.lit(1.0)).alias(link),
                F.col(link).isNull().alias(default)]
    return links.select(
        *LINK_KEY, *out,
        *[f"{match}_count" for match in (F_MATCH, B_MATCH, C_MATCH)])


def attach_links(df: DataFrame, links: DataFrame) -> DataFrame:
    """Links on every row.  A class whose rows are all filtered out has default links."""
    rows = df.join(links, list(LINK_KEY), "left")
    fill = {name: F.coalesce(F.col(name), F.lit(1.0)) for name in (F_LINK, B_LINK, C_LINK)}
    fill |= {name: F.coalesce(F.col(name), F.lit(True))
             for name in (F_DEFAULT, B_DEFAULT, C_DEFAULT)}
    fill |= {f"{name}_count": F.coalesce(F.col(f"{name}_count"), F.lit(0))
             for name in (F_MATCH, B_MATCH, C_MATCH)}
    return rows.withColumns(fill)


def manual_construction(df: DataFrame, manual: DataFrame | None) -> DataFrame:
    """Values set by hand, beside the answers."""
    if manual is None:
        return df.withColumn(MANUAL, F.lit(None).cast("double"))
    by_hand = manual.select(*c.CELL_KEY, F.col(c.TARGET).cast("double").alias(MANUAL))
    return df.join(by_partition(by_hand), list(c.CELL_KEY), "left")


def _anchored(df: DataFrame) -> DataFrame:
    """Start of each forward chain: an answer, a hand-set value or an imputed back value."""
    marker = F.col(c.MARKER) if c.MARKER in df.columns else F.lit(None).cast("string")
    value, returned = F.col(c.TARGET), returned_value(df)
    kind = F.lit("fir")
    for source, chain in _CHAIN_KIND.items():
        kind = F.when(marker == source, chain).otherwise(kind)
    return df.withColumns({
        "_returned": returned,
        "_anchor": F.coalesce(value, F.col(MANUAL)),
        "_kind": F.when(value.isNotNull(), kind).when(F.col(MANUAL).isNotNull(), "fimc"),
    })


def forward_impute(df: DataFrame) -> DataFrame:
    """Latest anchor times the forward links since: ``forward_value``, ``forward_kind``."""
    rows = _anchored(df).withColumns({
        "_at": F.row_number().over(_months()), "_links": _links_of_series(F_LINK)})
    anchor = F.when(F.col("_anchor").isNotNull(), F.struct("_at", "_anchor"))
    rows = rows.withColumns({
        "forward_kind": F.last("_kind", ignorenulls=True).over(_so_far()),
        "_start": F.last(anchor, ignorenulls=True).over(_so_far()),
    })
    since = F.slice("_links", F.col("_start._at") + 1, F.col("_at") - F.col("_start._at"))
    return (rows.withColumn("forward_value", F.when(
        F.col("_start").isNotNull(), _chained(F.col("_start._anchor"), since)))
        .drop("_at", "_links", "_start", "_anchor", "_kind", "_returned"))


def backward_impute(df: DataFrame) -> DataFrame:
    """Next answer times the backward links up to it: ``backward_value``."""
    rows = df.withColumns({
        "_returned": returned_value(df), "_at": F.row_number().over(_months()),
        "_links": _links_of_series(B_LINK)})
    answer = F.when(F.col("_returned").isNotNull(), F.struct("_at", "_returned"))
    rows = rows.withColumn("_start", F.first(answer, ignorenulls=True).over(_from_here()))
    until = F.reverse(F.slice("_links", F.col("_at"), F.col("_start._at") - F.col("_at")))
    return (rows.withColumn("backward_value", F.when(
        F.col("_start").isNotNull(), _chained(F.col("_start._returned"), until)))
        .drop("_at", "_links", "_start", "_returned"))


def construct(df: DataFrame) -> DataFrame:
    """Auxiliary times the construction link in the first published month, carried by
    forward links after it: ``constructed_value``, ``constructed_kind``.

    The value holds for series without any anchor so far, which is where it is used.
    """
    open_rows = ~F.col("is_backdata")
    rows = df.withColumn(
        "_first", open_rows & (F.count(F.when(open_rows, 1)).over(_so_far()) == 1))
    base = F.when(F.col("_first"), F.col(c.MONTHLY_AUXILIARY) * F.col(C_LINK))
    step = F.when(~open_rows | F.col("_first"), 1.0).otherwise(F.col(F_LINK))
    rows = rows.withColumns({
        "_base": F.last(base, ignorenulls=True).over(_so_far()),
        "_chain": F.product(step).over(_so_far()),
    })
    return rows.withColumns({
        "constructed_value": F.when(open_rows, F.col("_base") * F.col("_chain")),
        "constructed_kind": F.when(F.col("_first"), "c").when(open_rows, "fic"),
    }).drop("_first", "_base", "_chain")


def choose_imputed(df: DataFrame) -> DataFrame:
    """Target and marker by precedence: answer, by hand, forward, backward, constructed."""
    backdata = F.col("is_backdata")
    marker = F.col(c.MARKER) if c.MARKER in df.columns else F.lit(None).cast("string")
    value, by_hand = F.col(c.TARGET), F.col(MANUAL)
    forward, backward = F.col("forward_value"), F.col("backward_value")
    chosen = (
        F.when(value.isNotNull(), F.struct(value.alias("value"),
                                           F.coalesce(marker, F.lit("r")).alias("marker")))
        .when(by_hand.isNotNull(), F.struct(by_hand.alias("value"), F.lit("mc").alias("marker")))
        .when(F.col("forward_kind").isNotNull(),
              F.struct(forward.alias("value"), F.col("forward_kind").alias("marker")))
        .when(backward.isNotNull(), F.struct(backward.alias("value"), F.lit("bir").alias("marker")))
        .otherwise(F.struct(F.col("constructed_value").alias("value"),
                            F.col("constructed_kind").alias("marker"))))
    return (df.withColumn("_chosen", chosen)
            .withColumns({
                f"backdata_{c.TARGET}": F.when(backdata, value),
                f"backdata_flags_{c.TARGET}": F.when(backdata, marker),
                c.TARGET: F.col("_chosen.value"),
                c.MARKER: F.col("_chosen.marker"),
            })
            .drop("_chosen", "forward_value", "forward_kind", "backward_value",
                  "constructed_value", "constructed_kind"))


def ratio_of_means(panel: DataFrame, settings: SurveySettings,
                   manual: DataFrame | None = None,
                   link_filter: DataFrame | None = None,
                   keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Impute every missing target of a staged panel.

    All questions and classes go through together.  ``keep`` stores the link table; read
    back, its exact size lets Spark choose between a broadcast and a shuffled join.
    """
    links = link_table(panel, link_filter)
    if keep is not None:
        links = keep(links, "links")
    rows = mark_backdata(manual_construction(panel, manual), settings)
    rows = attach_links(match_flags(rows), links).drop("_month", "_returned", "_before", "_after")
    return choose_imputed(backward_impute(forward_impute(construct(rows))))


def mark_derived_zeros(df: DataFrame) -> DataFrame:
    return df.withColumn(
        c.MARKER,
        F.when(F.col("derived_zeros").eqNullSafe(True), "d").otherwise(F.col(c.MARKER)))


def filtered_link_counts(df: DataFrame) -> DataFrame:
    """Count columns as they are named when a link filter was used."""
    return df.withColumnsRenamed({
        f"{side}_match_{c.TARGET}_count": f"{side}_match_filtered_{c.TARGET}_count"
        for side in ("f", "b")})


