"""Sales-detail operators: enrichment join, keyword page, share statistics, regional bands.

Scale notes:

* The detail join filters orders by date before joining (pushed to the
  scan) and lets AQE pick broadcast vs sort-merge per join from measured
  sizes; nothing is hinted because no side has a fixed size bound.
* Regional sums pre-aggregate orders per customer *before* the customer
  join, so the join shuffles one row per customer instead of every order;
  the nation dimension is a fixed 25-row table and is broadcast.
* All statistics of a page and its total are one aggregate with grouping sets, so the input is read once and
  no list of groups is gathered.
* The detail page writes its filtered rows once and reads total, statistics and page from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retail_pulse.functions.text import analyze, tokens
from retail_pulse.sources.sinks import materialize

# Age bands and their labels on the sales-detail page.
AGE_BANDS = [(None, 20, "20岁以下"), (20, 30, "20-30岁"), (30, None, "30岁以上")]
AGE_LABELS = [label for *_, label in AGE_BANDS]
# Fixed value: the sales-detail page's date when the request has none.
DEFAULT_DETAIL_DATE = "2019-03-04"
# The map legend's bands (width 100, six bands 0-100 ... 500-600).
MAP_BAND_WIDTH = 100
MAP_BANDS = 6


def keyword_match(col: str, keyword: str | None):
    """Match ``keyword`` against analyzed tokens of ``col`` (any term); empty = no filter."""
    terms = analyze(keyword or "")
    if not terms:
        return F.lit(True)
    tok = tokens(col)
    cond = F.lit(False)
    for t in terms:
        cond = cond | F.array_contains(tok, F.lit(t))
    return cond


def detail_page(detail: DataFrame, cond, order_cols: list[str], page: int = 1, size: int = 20,
                with_total: bool = True) -> DataFrame:
    """Rows ``(page-1)*size .. page*size`` of ``detail`` under ``cond`` in a total order.

    With ``with_total`` each row carries ``total``, the number of matching
    rows: the filtered rows are written once, total and page read them. Deep pages gather
    ``page * size`` rows; to walk through many pages use :func:`detail_page_after`.
    """
    matched = detail.where(cond)
    if with_total:
        matched = materialize(matched, "detail-page")
    out = matched.orderBy(*order_cols)
    start = max(page - 1, 0) * size
    if start:
        out = out.offset(start)
    out = out.limit(size)
    if with_total:
        total = matched.select(F.count(F.lit(1)).cast("bigint")).scalar()
        out = out.withColumn("total", total)
    return out


def detail_page_after(detail: DataFrame, cond, order_cols: list[str], after: tuple | None = None, size: int = 20) -> DataFrame:
    """The ``size`` rows that follow the row whose ``order_cols`` have the values ``after`` (None: the first ones).

    A keyset page costs the same however deep it is; ``order_cols`` must be unique and not NULL.
    """
    matched = detail.where(cond)
    if after is not None:
        if len(after) != len(order_cols):
            raise ValueError("after needs one value for each order column")
        later, same = F.lit(False), F.lit(True)
        for c, v in zip(order_cols, after):
            later = later | (same & (F.col(c) > F.lit(v)))
            same = same & (F.col(c) == F.lit(v))
        matched = matched.where(later)
    return matched.orderBy(*order_cols).limit(size)


def bucket_by(col: str, bands: list[tuple]):
    """CASE over ``[(lo, hi, label)]`` half-open bands; NULL -> NULL."""
    expr = None
    for lo, hi, label in bands:
        c = F.lit(True)
        if lo is not None:
            c = c & (F.col(col) >= F.lit(lo))
        if hi is not None:
            c = c & (F.col(col) < F.lit(hi))
        expr = F.when(c, F.lit(label)) if expr is None else expr.when(c, F.lit(label))
    return expr


def statistics(df: DataFrame, groups: dict, digits: int = 4) -> DataFrame:
    """(stat, name, value, percent): for each of ``groups`` (name -> expression) the count of each of its values and their
    share of all rows, and one row with ``stat`` NULL: the number of all rows. One aggregate with a grouping set for each group;
    without any row there is nothing in it.
    """
    cols = [f"_g{i}" for i in range(len(groups))]
    keyed = df.select(*[e.alias(c) for c, e in zip(cols, groups.values())])
    counts = keyed.groupingSets([[], *[[c] for c in cols]], *cols).agg(
        F.count(F.lit(1)).cast("bigint").alias("value"), *[F.grouping(c).alias(f"_off{c}") for c in cols])
    stat, name = F.lit(None).cast("string"), F.lit(None).cast("string")
    for c, label in zip(cols, groups):
        on = F.col(f"_off{c}") == 0
        stat, name = F.when(on, F.lit(label)).otherwise(stat), F.when(on, F.col(c).cast("string")).otherwise(name)
    rows = counts.select(stat.alias("stat"), name.alias("name"), "value")
    # a few rows by now: the values of each group, and the total
    total = F.max(F.when(F.col("stat").isNull(), F.col("value"))).over(Window.partitionBy())
    pct = F.round(F.lit(100.0) * F.col("value").cast("double") / total.cast("double"), digits)
    return rows.select("stat", "name", "value", pct.alias("percent"))


def shares(df: DataFrame, group_expr, name: str = "name", digits: int = 4) -> DataFrame:
    """(name, value, percent): group counts and their share of all rows in percent."""
    return statistics(df, {"share": group_expr}, digits).where("stat IS NOT NULL") \
        .select(F.col("name").alias(name), "value", "percent")


def _total():
    """The number of all rows in the rows of :func:`statistics`."""
    return F.coalesce(F.max(F.when(F.col("stat").isNull(), F.col("value"))), F.lit(0).cast("bigint"))


def statistics_row(stats: DataFrame, options: dict) -> DataFrame:
    """:func:`statistics` as one row: ``total``, and ``stat``, a JSON list ``[{"group", "options": [{"name", "value"}]}]``.

    ``options`` gives each group's values (the bands and codes of the page); values without rows are left out.
    """
    at = {(g, o): F.max(F.when((F.col("stat") == F.lit(g)) & (F.col("name") == F.lit(o)), F.col("value"))) for g, os in options.items() for o in os}
    one = stats.agg(_total().alias("total"),
                    *[v.alias(f"_v{i}") for i, v in enumerate(at.values())])
    place = {k: f"_v{i}" for i, k in enumerate(at)}
    lists = [F.struct(F.lit(g).alias("group"), F.filter(
        F.array(*[F.struct(F.lit(o).alias("name"), F.col(place[g, o]).alias("value")) for o in os]), lambda x: x["value"].isNotNull()).alias("options"))
        for g, os in options.items()]
    return one.select("total", F.to_json(F.array(*lists)).alias("stat"))


def region_sales(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                 width: float = MAP_BAND_WIDTH, bands: int = MAP_BANDS, digits: int = 2) -> DataFrame:
    """(n_nationkey, n_name, order_amount, n_orders, band): order value per nation.

    ``band = least(floor(order_amount / width), bands - 1)`` (last band open-ended).
    """
    per_cust = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("o_totalprice").alias("_amt"), F.count(F.lit(1)).alias("_n"))
    per_nation = per_cust.join(customer.select("c_custkey", "c_nationkey"), "c_custkey") \
        .groupBy(F.col("c_nationkey").alias("n_nationkey")) \
        .agg(F.sum("_amt").alias("_amt"), F.sum("_n").cast("bigint").alias("n_orders"))
    amount = F.round(F.col("_amt"), digits)
    band = F.least(F.floor(F.col("_amt") / F.lit(float(width))), F.lit(bands - 1)).cast("bigint")
    return per_nation.join(nation.select("n_nationkey", "n_name"), "n_nationkey") \
        .select("n_nationkey", "n_name", amount.alias("order_amount"), "n_orders", band.alias("band"))


def detail_report(detail: DataFrame, users: DataFrame, date_col: str = "dt", date: str | None = None,
                  keyword: str | None = None, keyword_col: str = "sku_name", page: int = 1, size: int = 20,
                  order_cols: list[str] | None = None, user_key: str = "user_id",
                  stat_groups: dict | None = None) -> dict[str, DataFrame]:
    """Sales-detail page: ``total``, ``stat`` (:func:`statistics` of all groups, from one aggregate) and ``detail`` rows.

    ``date`` defaults to the page's fixed default; an empty keyword means no
    keyword filter. The filtered rows with their user columns are written once; all parts read
    that table (a row whose user is unknown keeps NULL user columns and counts in the total).
    """
    cond = (F.col(date_col) == F.lit(date or DEFAULT_DETAIL_DATE)) & keyword_match(keyword_col, keyword)
    return report_parts(detail.where(cond), users, page, size, order_cols or [c for c in detail.columns], user_key, stat_groups)


def report_parts(matched: DataFrame, users: DataFrame, page: int, size: int, order_cols: list[str], user_key: str,
                 stat_groups: dict | None = None) -> dict[str, DataFrame]:
    """The parts of :func:`detail_report` for rows that are filtered already."""
    both = materialize(matched.join(users, user_key, "left"), "detail-report")
    rows = detail_page(both, F.lit(True), order_cols, page, size, with_total=False)
    stats = statistics(both, stat_groups or {})
    return {"total": stats.agg(_total().alias("total")), "stat": stats, "detail": rows}
