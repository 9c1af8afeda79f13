"""Pre-training bias metrics of a label across the values of a facet.

Each facet value in turn is the facet *d*, all other rows form *a*.  With
n_d(y), n_a(y) the label counts of the two sides and P_d, P_a their label
distributions (formulas after Das et al. 2021):

  CI  = (n_a - n_d) / (n_a + n_d)
  DPL = q_a - q_d            q = share of rows whose label is in the positive set
  KL  = sum_y P_a ln(P_a / P_d)               (+inf when P_a > 0 = P_d)
  JS  = (KL(P_a||M) + KL(P_d||M)) / 2         M = (P_a + P_d) / 2
  LP  = sqrt(sum_y (P_a - P_d)^2)
  TVD = sum_y |P_a - P_d| / 2
  KS  = max_y |P_a - P_d|

Plan: one pass over the data -- a partial aggregation to (facet, label)
counts, materialised once (a local relation when proved small, else a
checkpoint).  The per-label totals (a handful of numbers; the label
alphabet is checked to be small) are read from it, and the counts are
pivoted per facet value over the observed labels.  Metrics are column expressions on that per-facet row; nothing is
cross-joined and no data row reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Metric names in report order.
ALL_METHODS = ["CI", "DPL", "KL", "JS", "LP", "TVD", "KS"]
MAX_LABELS = 10_000


def _sum(cols: list[Column]) -> Column:
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total


def _max(cols: list[Column]) -> Column:
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def _cells(df: DataFrame, label: str, facet: str, min_rows_exclusive: int) -> DataFrame:
    """Rows per facet value and label, without nulls and rare facet values."""
    cells = (df.where(F.col(facet).isNotNull()).groupBy(facet, label).agg(F.count(F.lit(1)).alias("n")))
    if min_rows_exclusive > 0:
        of_facet = F.sum("n").over(Window.partitionBy(facet))
        cells = cells.withColumn("_rows", of_facet).where(F.col("_rows") > min_rows_exclusive).drop("_rows")
    return cells.where(F.col(label).isNotNull())


def bias_report(df: DataFrame, label: str = "sentiment", facet: str = "product_category",
                positive_values=(1,), methods=None, max_labels: int = MAX_LABELS,
                max_local_rows: int | None = None, min_rows_exclusive: int = 0) -> DataFrame:
    """One row per facet value: ``facet_value`` and one column per method.

    Facet values with at most ``min_rows_exclusive`` rows (null labels count)
    are left out before anything else, from the counted cells: rows need no
    pass of their own for it."""
    return _report(_cells(df, label, facet, min_rows_exclusive), label, facet, positive_values, methods,
                   max_labels, max_local_rows)


def _report(cells: DataFrame, label: str, facet: str, positive_values, methods, max_labels: int = MAX_LABELS,
            max_local_rows: int | None = None) -> DataFrame:
    """``bias_report`` from the counted cells (facet, label, n)."""
    methods = [m.upper() for m in (methods or ALL_METHODS)]
    unknown = [m for m in methods if m not in ALL_METHODS]
    if unknown:
        raise ValueError(f"unknown bias methods: {unknown}")
    from revlens.operators.joins import LOCAL_COPY_ROWS, small_local_copy
    cell_counts, cell_rows = small_local_copy(
        cells,
        LOCAL_COPY_ROWS if max_local_rows is None else max_local_rows)
    if cell_rows is not None:
        sums: dict = {}
        for r in cell_rows:
            sums[r[label]] = sums.get(r[label], 0) + int(r["n"])
        totals_rows = [{label: k, "n": v} for k, v in sums.items()]
    else:
        totals_rows = (cell_counts.groupBy(label).agg(F.sum("n").alias("n"))
                       .limit(max_labels + 1).collect())
    if len(totals_rows) > max_labels:
        raise ValueError(f"label {label} has more than {max_labels} values")
    totals = sorted((r[label], int(r["n"])) for r in totals_rows)
    labels = [v for v, _ in totals]
    spark = cells.sparkSession
    out_cols = ["facet_value"] + [m.lower() for m in methods]
    if not labels:
        schema = "facet_value string, " + ", ".join(f"{m} double" for m in out_cols[1:])
        return spark.createDataFrame([], schema)

    pivoted = cell_counts.groupBy(facet).pivot(label, labels).agg(F.sum("n"))
    names = [f"_d{i}" for i in range(len(labels))]
    cells = pivoted.select(F.col(facet).cast("string").alias("facet_value"),
                           *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("double").alias(n)
                             for c, n in zip(pivoted.columns[1:], names)])

    # Staged projections: counts -> shares -> metrics.  Later stages refer
    # to columns instead of re-inlining the share formulas into every term.
    k = len(labels)
    total_all = float(sum(n for _, n in totals))
    nd = [F.col(n) for n in names]
    stage1 = cells.select(
        "facet_value", *names,
        *[(F.lit(float(t)) - F.col(n)).alias(f"_a{i}") for i, ((_, t), n) in enumerate(zip(totals, names))],
        _sum(nd).alias("_Nd"))
    stage1 = stage1.withColumn("_Na", F.lit(total_all) - F.col("_Nd"))
    positive = set(positive_values)
    pos_idx = [i for i, v in enumerate(labels) if v in positive]

    def share(prefix: str, n_side: str) -> Column:
        if not pos_idx:
            return F.try_divide(F.lit(0.0), F.col(n_side))
        return F.try_divide(_sum([F.col(f"{prefix}{i}") for i in pos_idx]), F.col(n_side))

    stage2 = stage1.select(
        "facet_value", "_Nd", "_Na",
        *[F.try_divide(F.col(f"_d{i}"), F.col("_Nd")).alias(f"_pd{i}") for i in range(k)],
        *[F.try_divide(F.col(f"_a{i}"), F.col("_Na")).alias(f"_pa{i}") for i in range(k)],
        (share("_a", "_Na") - share("_d", "_Nd")).alias("_dpl"))
    stage3 = stage2.select(
        "*",
        *[((F.col(f"_pa{i}") + F.col(f"_pd{i}")) / F.lit(2.0)).alias(f"_pm{i}") for i in range(k)],
        *[(F.col(f"_pa{i}") - F.col(f"_pd{i}")).alias(f"_df{i}") for i in range(k)])

    def kl_terms(p: str, q: str):
        # p ln(p/q); 0 when p = 0, +inf when p > 0 = q; null if undefined.
        out = []
        for i in range(k):
            pi, qi = F.col(f"{p}{i}"), F.col(f"{q}{i}")
            out.append(F.when(pi.isNull() | qi.isNull(), F.lit(None).cast("double"))
                       .when(pi == 0, F.lit(0.0))
                       .when(qi == 0, F.lit(float("inf")))
                       .otherwise(pi * F.ln(pi / qi)))
        return out

    diffs = [F.col(f"_df{i}") for i in range(k)]
    expr = {
        "CI": F.try_divide(F.col("_Na") - F.col("_Nd"), F.col("_Na") + F.col("_Nd")),
        "DPL": F.col("_dpl"),
        "KL": _sum(kl_terms("_pa", "_pd")),
        "JS": (_sum(kl_terms("_pa", "_pm")) + _sum(kl_terms("_pd", "_pm"))) / F.lit(2.0),
        "LP": F.sqrt(_sum([x * x for x in diffs])),
        "TVD": _sum([F.abs(x) for x in diffs]) / F.lit(2.0),
        "KS": _max([F.abs(x) for x in diffs]),
    }
    return stage3.select("facet_value", *[expr[m].alias(m.lower()) for m in methods])


def _cells_of_all(df: DataFrame, label: str, facets: list[Column]) -> list[DataFrame]:
    """Cells (facet_value, label, n) of several facets from one pass: a row
    gives one entry per facet, which the partial aggregation adds up at once.
    The counts are kept as a local relation when proved small, else written."""
    from revlens.operators.joins import LOCAL_COPY_ROWS, small_local_copy
    entries = F.array(*[F.struct(F.lit(i).alias("at"), f.cast("string").alias("value")) for i, f in enumerate(facets)])
    counted = (df.select(F.col(label).alias("__label"), F.explode(entries).alias("e"))
               .where("e.value is not null and __label is not null")
               .groupBy("e.at", "e.value", "__label").agg(F.count(F.lit(1)).alias("n")))
    counted, _ = small_local_copy(counted, LOCAL_COPY_ROWS)
    return [counted.where(F.col("at") == i).select(F.col("value").alias("facet_value"), F.col("__label").alias(label), "n")
            for i in range(len(facets))]


def column_of(df: DataFrame, name_or_index, headers=()) -> str:
    """A column by its name, or by its place (from 0) in the headers, or, without
    headers, in the data.  A name that looks like a number wins over a place."""
    name = str(name_or_index)
    if name in df.columns:
        return name
    among = list(headers or df.columns)
    if not name.isdecimal() or int(name) >= len(among) or among[int(name)] not in df.columns:
        raise ValueError(f"no column {name_or_index!r} among {df.columns}")
    return among[int(name)]


def _group(df: DataFrame, col: str, values) -> Column:
    """Whether a column's value is of the group that ``values`` describe.

    A fractional column takes one threshold (larger values are of the group);
    any other column a list of values, compared as the column's type.  Null stays null."""
    kind = dict(df.dtypes)[col]
    if kind in ("float", "double") or kind.startswith("decimal"):
        if len(values) != 1:
            raise ValueError(f"{col} is fractional: one threshold expected, got {list(values)}")
        return F.col(col) > F.lit(float(values[0]))
    return F.col(col).isin(*[F.lit(str(v)).try_cast(kind) for v in values])


def group_name(df: DataFrame, col: str, values) -> str:
    """How a report calls such a group: ``>2.5`` or ``a,b``."""
    fractional = dict(df.dtypes)[col] in ("float", "double") or dict(df.dtypes)[col].startswith("decimal")
    return f">{float(values[0])}" if fractional else ",".join(map(str, values))


def bias_report_from_config(df: DataFrame, config) -> DataFrame:
    """Run ``bias_report`` for every facet of a ``BiasConfig``; adds the facet
    column's name (``facet``) and the report name.

    The label and the facets are names or column numbers.  A fractional label
    is cut at its threshold first.  A facet with values or a threshold has one
    row, for that group against all others; without, one row per value.  The data
    is read once, whatever the number of facets.
    Without facets the report is an empty table."""
    label = column_of(df, config.label, config.headers)
    fractional = dict(df.dtypes)[label] in ("float", "double") or dict(df.dtypes)[label].startswith("decimal")
    if fractional:
        above = _group(df, label, config.positive_values)
        df, positive = df.withColumn(label, above.cast("int")), [1]
    else:
        kind = dict(df.dtypes)[label]
        spelled = [F.lit(str(v)).try_cast(kind).alias(f"v{i}") for i, v in enumerate(config.positive_values)]
        positive = list(df.sparkSession.range(1).select(*spelled).first()) if spelled else []
    methods = config.methods or ALL_METHODS
    names, groups, columns = [], [], []
    for i, named in enumerate(config.facets):
        facet = column_of(df, named, config.headers)
        values = (config.facet_values or [None] * len(config.facets))[i]
        if facet == label:
            raise ValueError(f"{facet} is the label and a facet")
        names.append(facet)
        groups.append(group_name(df, facet, values) if values else None)
        columns.append(F.when(_group(df, facet, values), "group").when(F.col(facet).isNotNull(), "rest")
                       if values else F.col(facet))
    parts = []
    for facet, group, cells in zip(names, groups, _cells_of_all(df, label, columns) if names else []):
        rep = _report(cells, label, "facet_value", positive, methods)
        if group is not None:
            rep = rep.where("facet_value = 'group'").withColumn("facet_value", F.lit(group))
        parts.append(rep.select(F.lit(facet).alias("facet"), "*"))
    if not parts:
        schema = "facet string, facet_value string, " + ", ".join(f"{m.lower()} double" for m in methods)
        return df.sparkSession.createDataFrame([], schema).withColumn("report", F.lit(config.report_name))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("report", F.lit(config.report_name))
