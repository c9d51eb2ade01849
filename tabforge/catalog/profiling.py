"""Profiling, quality and bivariate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.catalog.registry import (
    INJECTED_SQL,
    LINEITEM_NUMERIC,
    injected,
    query,
    rounded_doubles,
    table,
    union_sql,
)
from tabforge.operators import bivariate, profile, quality, timeprofile
from tabforge.plans.aggregates import union_all

_DTYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}
_LINEITEM_OTHER = ["l_returnflag", "l_linestatus", "l_shipdate"]
_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _quart(c: str, p: float) -> str:
    return f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6)"


_PROFILE_SQL = (
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{_DTYPES[c]}' AS dtype, count(*) AS n_rows, count(*) - count({c}) AS missing_count, "
        f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS missing_pct, count({c}) AS \"count\", "
        f"round(avg(CAST({c} AS DOUBLE)), 4) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, "
        f"CAST(min({c}) AS DOUBLE) AS min, {_quart(c, .25)} AS p25, {_quart(c, .5)} AS p50, {_quart(c, .75)} AS p75, "
        f"CAST(max({c}) AS DOUBLE) AS max, CAST(NULL AS BIGINT) AS cardinality FROM {INJECTED_SQL}"
        for c in LINEITEM_NUMERIC
    )
    + "\nUNION ALL\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}', '{_DTYPES[c]}', count(*), count(*) - count({c}), "
        f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, "
        f"count(DISTINCT {c}) FROM {INJECTED_SQL}"
        for c in _LINEITEM_OTHER
    )
)


@query("profile_lineitem", _PROFILE_SQL)
def profile_lineitem(spark, sf_dir):
    out = profile.profile_dataframe(injected(spark, sf_dir))
    return rounded_doubles(out, 6, mean=4, std=4)


@query(
    "column_profile_orders",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{_DTYPES[c]}' AS dtype, round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS pct_missing, "
        f"count(DISTINCT {c}) + max(({c} IS NULL)::INT)::BIGINT AS n_unique, "
        f"count(DISTINCT {c}) + max(({c} IS NULL)::INT) <= 1 AS is_constant, "
        f"count(DISTINCT {c}) + max(({c} IS NULL)::INT) >= 0.95 * greatest(count(*), 1) AS is_id_like FROM orders"
        for c in _ORDERS
    ),
)
def column_profile_orders(spark, sf_dir):
    return profile.column_profile(table(spark, sf_dir, "orders"))


@query(
    "notebook_profile_lineitem",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{_DTYPES[c]}' AS dtype, count(*) - count({c}) AS n_missing, "
        f"round((count(*) - count({c}))::DOUBLE / count(*), 4) AS pct_missing, "
        f"count(DISTINCT {c}) + max(({c} IS NULL)::INT)::BIGINT AS n_unique, "
        f"count(DISTINCT {c}) + max(({c} IS NULL)::INT) <= 1 AS is_constant, "
        f"(count(DISTINCT {c}) + max(({c} IS NULL)::INT) >= 0.95 * count(*)) AND count(*) > 10 AS is_id_like FROM {INJECTED_SQL}"
        for c in [*LINEITEM_NUMERIC, *_LINEITEM_OTHER]
    ),
)
def notebook_profile_lineitem(spark, sf_dir):
    return profile.notebook_profile(injected(spark, sf_dir))


@query(
    "missing_summary_inj",
    "SELECT * FROM ("
    + union_sql(
        [*LINEITEM_NUMERIC, *_LINEITEM_OTHER],
        "SELECT '{c}' AS \"column\", round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS pct_missing, "
        "count(*) - count({c}) AS n_missing FROM " + INJECTED_SQL,
    )
    + ") WHERE n_missing > 0",
)
def missing_summary_inj(spark, sf_dir):
    return profile.missing_summary(injected(spark, sf_dir))


_SIGNAL = (
    "SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing, "
    "round(avg(CASE WHEN {c} IS NULL THEN l_extendedprice END), 4) AS mean_target_missing, "
    "round(avg(CASE WHEN {c} IS NOT NULL THEN l_extendedprice END), 4) AS mean_target_present FROM " + INJECTED_SQL
)


@query("missing_target_signal", union_sql(["l_linenumber", "l_quantity", "l_tax"], _SIGNAL))
def missing_target_signal(spark, sf_dir):
    names = ["l_linenumber", "l_quantity", "l_tax"]
    return rounded_doubles(profile.missing_target_signal(injected(spark, sf_dir), names, "l_extendedprice"), 4)


@query("most_missing_signal", union_sql(["l_returnflag", "l_quantity", "l_linenumber"], _SIGNAL))
def most_missing_signal(spark, sf_dir):
    return rounded_doubles(profile.most_missing_signal(injected(spark, sf_dir), "l_extendedprice", 5), 4)


@query(
    "numeric_describe_lineitem",
    union_sql(
        LINEITEM_NUMERIC,
        "SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
        "round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, "
        "round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS p50, "
        "round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max, "
        "round(skewness(CAST({c} AS DOUBLE)), 6) AS skew, round(kurtosis(CAST({c} AS DOUBLE)), 6) AS kurt FROM " + INJECTED_SQL,
    ),
)
def numeric_describe_lineitem(spark, sf_dir):
    return rounded_doubles(profile.numeric_describe(injected(spark, sf_dir)), 6, mean=4, std=4)


_OUTLIER = (
    "SELECT '{c}' AS \"column\", round(avg(({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))::INT), 6) AS outlier_share "
    "FROM events, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM events) "
    "WHERE {c} IS NOT NULL AND q3 > q1"
)


@query("outlier_shares_events", union_sql(["event_id", "user_id", "value"], _OUTLIER))
def outlier_shares_events(spark, sf_dir):
    return rounded_doubles(profile.outlier_shares(table(spark, sf_dir, "events"), digits=None))


@query(
    "zero_shares_lineitem",
    union_sql(
        LINEITEM_NUMERIC,
        "SELECT '{c}' AS \"column\", round(count(*) FILTER (WHERE {c} = 0)::DOUBLE / count(*), 6) AS zero_share FROM " + INJECTED_SQL,
    ),
)
def zero_shares_lineitem(spark, sf_dir):
    return rounded_doubles(profile.zero_shares(injected(spark, sf_dir), digits=None))


@query(
    "categorical_top_segment",
    "SELECT c_mktsegment AS value, round(count(*)::DOUBLE / (SELECT count(*) FROM customer), 6) AS share "
    "FROM customer GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3",
)
def categorical_top_segment(spark, sf_dir):
    return rounded_doubles(profile.categorical_top(table(spark, sf_dir, "customer"), "c_mktsegment", 3, None))


@query(
    "encoding_advice_part",
    union_sql(
        ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
        "SELECT '{c}' AS \"column\", count(*) AS n_unique, CASE "
        "WHEN count(*) = sum(n) THEN 'row_id' "
        "WHEN count(*) > 50 THEN 'hash_or_frequency' "
        "WHEN count(*) FILTER (WHERE n < 0.01 * total) > 0 THEN "
        "'pool_rare' "
        "ELSE 'one_hot' END AS advice, CASE WHEN count(*) <> sum(n) AND count(*) <= 50 AND count(*) FILTER (WHERE n < 0.01 * total) > 0 "
        "THEN count(*) FILTER (WHERE n < 0.01 * total) END AS n_rare "
        "FROM (SELECT {c} AS v, count(*) AS n, (SELECT count(*) FROM part) AS total FROM part GROUP BY 1)",
    ),
)
def encoding_advice_part(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return profile.encoding_advice(part, part.columns)


@query(
    "categorical_candidates_lineitem",
    "SELECT unnest(['l_returnflag', 'l_linestatus']) AS \"column\", 'type' AS reason UNION ALL "
    + "SELECT \"column\", 'few codes' FROM ("
    + union_sql(
        [c for c in LINEITEM_NUMERIC if c != "l_discount"],
        "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n FROM lineitem",
    )
    + ") WHERE n <= 10",
)
def categorical_candidates_lineitem(spark, sf_dir):
    return profile.categorical_columns(table(spark, sf_dir, "lineitem"), target="l_discount")


@query(
    "detect_task_labels",
    "SELECT 'quality' AS target, CASE WHEN count(DISTINCT quality) <= 20 THEN 'classification' ELSE 'regression' END AS task FROM labels "
    "UNION ALL SELECT 'doc_id', CASE WHEN count(DISTINCT doc_id) <= 20 THEN 'classification' ELSE 'regression' END FROM labels "
    "UNION ALL SELECT 'source', 'classification' "
    "UNION ALL SELECT 'n_chars', CASE WHEN count(DISTINCT n_chars) <= 20 THEN 'classification' ELSE 'regression' END FROM documents",
)
def detect_task_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").drop("text")
    joined = profile.detect_tasks(table(spark, sf_dir, "labels"), ["quality", "doc_id"])
    return joined.unionByName(profile.detect_tasks(docs, ["source", "n_chars"]))


# ------------------------------------------------------------------ target ---

_SHARES = (
    "SELECT max(s) / greatest(min(s), 1e-9) AS ratio, min(s) AS least FROM "
    "(SELECT count(*)::DOUBLE / (SELECT count(*) FROM lineitem) AS s FROM " + INJECTED_SQL + " GROUP BY l_returnflag)"
)


@query(
    "target_stats_returnflag",
    f"SELECT 'imbalance_ratio' AS stat, round(ratio, 6) AS value FROM ({_SHARES}) "
    f"UNION ALL SELECT 'minority_share', round(least, 6) FROM ({_SHARES})",
)
def target_stats_returnflag(spark, sf_dir):
    return rounded_doubles(
        profile.target_stats(injected(spark, sf_dir), "l_returnflag", "classification", digits=False)
    )


@query(
    "class_shares_returnflag",
    "SELECT l_returnflag AS label, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM lineitem), 6) AS share "
    f"FROM {INJECTED_SQL} GROUP BY 1",
)
def class_shares_returnflag(spark, sf_dir):
    return rounded_doubles(profile.class_shares(injected(spark, sf_dir), "l_returnflag", None))


@query(
    "target_stats_price",
    "SELECT 'skew' AS stat, round(skewness(l_extendedprice), 6) AS value FROM lineitem "
    "UNION ALL SELECT 'kurt', round(kurtosis(l_extendedprice), 6) FROM lineitem "
    "UNION ALL SELECT 'zero_share', round(avg((l_extendedprice = 0)::INT), 6) FROM lineitem",
)
def target_stats_price(spark, sf_dir):
    return rounded_doubles(
        profile.target_stats(table(spark, sf_dir, "lineitem"), "l_extendedprice", "regression", digits=False)
    )


_DOCS = (
    "(SELECT l.quality, l.toxic, d.doc_id, d.n_chars, length(d.text) - length(replace(d.text, ' ', '')) AS n_blanks "
    "FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"
)


def _labelled_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", F.expr("length(text) - length(replace(text, ' ', ''))").cast("long").alias("n_blanks")
    )
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select("quality", "toxic", "doc_id", "n_chars", "n_blanks")


@query(
    "target_corr_quality",
    union_sql(
        ["toxic", "doc_id", "n_chars", "n_blanks"],
        "SELECT '{c}' AS \"column\", round(corr({c}::DOUBLE, quality::DOUBLE), 6) AS r, "
        "(SELECT count(DISTINCT quality) FROM " + _DOCS + ") AS n_classes FROM " + _DOCS,
    ),
)
def target_corr_quality(spark, sf_dir):
    return rounded_doubles(
        bivariate.target_correlations(_labelled_documents(spark, sf_dir), "quality", "classification")
    )


_RELATED_SQL = (
    "(SELECT l_quantity, l_tax, l_extendedprice, l_extendedprice * (1 - l_discount) AS net, "
    "l_extendedprice * (1 + l_tax) AS gross, l_quantity + l_tax AS near_quantity FROM lineitem)"
)


def _related(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_quantity", "l_tax", "l_extendedprice", "l_extendedprice * (1 - l_discount) AS net",
        "l_extendedprice * (1 + l_tax) AS gross", "l_quantity + l_tax AS near_quantity",
    )


_RELATED = ["l_quantity", "l_tax", "l_extendedprice", "net", "gross", "near_quantity"]


@query(
    "leakage_suspects",
    "SELECT * FROM ("
    + union_sql(
        [c for c in _RELATED if c != "l_extendedprice"],
        "SELECT '{c}' AS \"column\", round(corr({c}, l_extendedprice), 6) AS r FROM " + _RELATED_SQL,
    )
    + ") WHERE abs(r) > 0.9",
)
def leakage_suspects(spark, sf_dir):
    correlations = bivariate.target_correlations(_related(spark, sf_dir), "l_extendedprice", "regression")
    return rounded_doubles(bivariate.leakage_suspects(correlations))


_PAIRS = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {_RELATED_SQL}"
    for i, a in enumerate(_RELATED)
    for b in _RELATED[i + 1 :]
)


@query("multicollinear_lineitem", f"SELECT * FROM ({_PAIRS}) WHERE abs(r) > 0.8")
def multicollinear_lineitem(spark, sf_dir):
    return rounded_doubles(bivariate.multicollinear_pairs(_related(spark, sf_dir), digits=None))


@query(
    "numeric_vs_class",
    union_sql(
        LINEITEM_NUMERIC,
        "SELECT l_returnflag AS label, '{c}' AS \"column\", round(avg(CAST({c} AS DOUBLE)), 4) AS mean FROM "
        + INJECTED_SQL + " GROUP BY 1",
    ),
)
def numeric_vs_class(spark, sf_dir):
    out = bivariate.numeric_vs_target(injected(spark, sf_dir), "l_returnflag", "classification", digits=None)
    return rounded_doubles(out, 4)


@query(
    "numeric_vs_price",
    union_sql(
        [c for c in LINEITEM_NUMERIC if c != "l_extendedprice"],
        "SELECT '{c}' AS \"column\", round(corr(CAST({c} AS DOUBLE), l_extendedprice), 6) AS r FROM " + INJECTED_SQL,
    ),
)
def numeric_vs_price(spark, sf_dir):
    return rounded_doubles(
        bivariate.numeric_vs_target(injected(spark, sf_dir), "l_extendedprice", "regression", digits=None)
    )


@query(
    "crosstab_flag_status",
    "WITH t AS (SELECT coalesce(l_returnflag, '∅_missing') AS level, l_linestatus AS label FROM "
    + INJECTED_SQL
    + "), levels AS (SELECT level, count(*) AS total FROM t GROUP BY 1), classes AS (SELECT DISTINCT label FROM t) "
    "SELECT l.level, c.label, round((SELECT count(*) FROM t WHERE t.level = l.level AND t.label = c.label)::DOUBLE / l.total, 6) AS share "
    "FROM levels l, classes c",
)
def crosstab_flag_status(spark, sf_dir):
    return rounded_doubles(
        bivariate.categorical_vs_target(injected(spark, sf_dir), "l_returnflag", "l_linestatus", "classification", None, zeros=True)
    )


@query(
    "crosstab_type_brand",
    "SELECT p_type AS level, p_brand AS label, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY p_type), 6) AS share "
    "FROM part GROUP BY 1, 2",
)
def crosstab_type_brand(spark, sf_dir):
    """Many levels and classes: the cells that occur."""
    return rounded_doubles(bivariate.categorical_vs_target(table(spark, sf_dir, "part"), "p_type", "p_brand", "classification", None))


@query(
    "mean_target_by_priority",
    "SELECT o_orderpriority AS level, round(avg(o_totalprice), 4) AS mean, count(o_totalprice) AS \"count\" FROM orders GROUP BY 1",
)
def mean_target_by_priority(spark, sf_dir):
    out = bivariate.categorical_vs_target(
        table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", "regression", None
    )
    return rounded_doubles(out, 4)


_FLAGS = (
    "SELECT 'dup_pct' AS flag, '0.0' AS value WHERE (SELECT count(*) FROM orders) = (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) "
    "UNION ALL SELECT 'constant', col FROM u WHERE n_unique <= 1 "
    "UNION ALL SELECT 'id_like', col FROM u WHERE n_unique = n "
    "UNION ALL SELECT 'missing_gt30', col FROM u WHERE miss > 0.3 "
)
_FLAG_BASE = (
    "WITH u AS ("
    + union_sql(
        _ORDERS,
        "SELECT '{c}' AS col, count(DISTINCT {c}) + max(({c} IS NULL)::INT) AS n_unique, count(*) AS n, "
        "avg(({c} IS NULL)::INT) AS miss FROM orders",
    )
    + ") "
)


@query("quality_flags_orders", _FLAG_BASE + _FLAGS)
def quality_flags_orders(spark, sf_dir):
    return quality.quality_flags(table(spark, sf_dir, "orders"))


@query(
    "universal_eda_orders",
    _FLAG_BASE + _FLAGS + "UNION ALL SELECT 'task', 'classification+time' UNION ALL SELECT 'target', 'o_orderstatus'",
)
def universal_eda_orders(spark, sf_dir):
    found = quality.run_universal_eda(table(spark, sf_dir, "orders"), "o_orderstatus", order=["o_orderkey"])
    return found["flags"]


_EDA_COLUMNS = [*LINEITEM_NUMERIC, *_LINEITEM_OTHER]
_LONG = "SELECT '{part}' AS part, name, stat, CAST(value AS DOUBLE) AS value FROM ({rows})"


def _long_sql(part: str, columns: list[str], stats: dict[str, str], source: str = INJECTED_SQL) -> str:
    """Rows (part, name, stat, value), one a column and stat; ``{c}`` is the column."""
    each = union_sql(columns, "SELECT '{c}' AS name, " + ", ".join(f"{v} AS {k}" for k, v in stats.items()) + f" FROM {source}")
    rows = "\nUNION ALL\n".join(f"SELECT name, '{k}' AS stat, CAST({k} AS DOUBLE) AS value FROM ({each})" for k in stats)
    return _LONG.format(part=part, rows=rows)


_X = "CAST({c} AS DOUBLE)"
_UNIQUE = "(count(DISTINCT {c}) + max(({c} IS NULL)::INT))"
_CODED = (
    "(SELECT *, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END::DOUBLE AS code FROM " + INJECTED_SQL + ")"
)
_EDA_PAIRS = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM {INJECTED_SQL}"
    for i, a in enumerate(LINEITEM_NUMERIC)
    for b in LINEITEM_NUMERIC[i + 1 :]
)
_EDA_SQL = "\nUNION ALL\n".join(
    [
        _long_sql("profile", _EDA_COLUMNS, {
            "pct_missing": "round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2)", "n_unique": _UNIQUE,
            "is_constant": f"({_UNIQUE} <= 1)::INT", "is_id_like": f"({_UNIQUE} >= 0.95 * count(*))::INT",
        }),
        "SELECT * FROM (" + _long_sql("missing", _EDA_COLUMNS, {"n_missing": "count(*) - count({c})"}) + ") WHERE value > 0",
        _long_sql("numeric_describe", LINEITEM_NUMERIC, {
            "count": "count({c})", "mean": f"round(avg({_X}), 4)", "std": f"round(stddev_samp({_X}), 4)", "min": "min({c})", "max": "max({c})",
            "p25": f"round(quantile_cont({_X}, 0.25), 4)", "p50": f"round(quantile_cont({_X}, 0.5), 4)",
            "p75": f"round(quantile_cont({_X}, 0.75), 4)", "skew": f"round(skewness({_X}), 4)", "kurt": f"round(kurtosis({_X}), 4)",
        }),
        "SELECT 'outliers' AS part, \"column\" AS name, 'outlier_share' AS stat, round(outlier_share, 4) AS value FROM ("
        + union_sql(LINEITEM_NUMERIC, _OUTLIER.replace("FROM events", f"FROM {INJECTED_SQL}")) + ") WHERE outlier_share IS NOT NULL",
        _long_sql("zeros", LINEITEM_NUMERIC, {"zero_share": "round_even(count(*) FILTER (WHERE {c} = 0)::DOUBLE / count(*), 4)"}),
        "SELECT 'categoricals' AS part, unnest(['l_linenumber', 'l_tax', 'l_linestatus']) AS name, 'categorical' AS stat, 1.0::DOUBLE AS value",
        "SELECT 'target_stats' AS part, '' AS name, unnest(['imbalance_ratio', 'minority_share']) AS stat, "
        "unnest([round(max(s) / min(s), 2), round(min(s), 4)]) AS value FROM (SELECT count(*)::DOUBLE / (SELECT count(*) FROM lineitem) AS s FROM "
        + INJECTED_SQL + " GROUP BY l_returnflag)",
        _long_sql("corr_with_target", LINEITEM_NUMERIC, {
            "r": f"round(corr({_X}, code) FILTER (WHERE {{c}} IS NOT NULL AND code IS NOT NULL), 4)", "n_classes": "3"
        }, _CODED),
        "SELECT 'multicollinear' AS part, a || '~' || b AS name, 'r' AS stat, round(r, 3) AS value FROM ("
        + _EDA_PAIRS + ") WHERE abs(r) > 0.8",
        "SELECT 'flags' AS part, name, 'missing_gt30' AS stat, 1.0::DOUBLE AS value FROM ("
        + union_sql(_EDA_COLUMNS, "SELECT '{c}' AS name, avg(({c} IS NULL)::INT) AS share FROM " + INJECTED_SQL) + ") WHERE share > 0.3",
        "SELECT 'flags' AS part, '' AS name, 'dup_pct' AS stat, round(1 - count(*)::DOUBLE / (SELECT count(*) FROM lineitem), 4) AS value "
        "FROM (SELECT DISTINCT * FROM " + INJECTED_SQL + ")",
    ]
)


@query("universal_eda_lineitem", _EDA_SQL)
def universal_eda_lineitem(spark, sf_dir):
    """All ten tables of one run as (part, name, stat, value)."""
    found = quality.run_universal_eda(injected(spark, sf_dir), "l_returnflag", order=["l_orderkey", "l_linenumber"])
    number = lambda c: F.col(c).cast("double")

    def long(part: str, name, stats: list[str], digits: int = 4):
        cells = F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), F.round(number(s), digits).alias("value")) for s in stats]))
        return found[part].select(F.lit(part).alias("part"), name.alias("name"), cells.alias("r")).select("part", "name", "r.stat", "r.value")

    column = F.col("column")
    flags = found["flags"].where("flag IN ('missing_gt30', 'dup_pct')")
    share = F.col("flag") == "dup_pct"
    parts = [
        long("profile", column, ["pct_missing", "n_unique", "is_constant", "is_id_like"]),
        long("missing", column, ["n_missing"]),
        long("numeric_describe", column, ["count", "mean", "std", "min", "max", "p25", "p50", "p75", "skew", "kurt"]),
        long("outliers", column, ["outlier_share"]),
        long("zeros", column, ["zero_share"]),
        found["categoricals"].select(F.lit("categoricals"), column, F.lit("categorical"), F.lit(1.0)),
        found["target_stats"].select(F.lit("target_stats"), F.lit(""), "stat", "value"),
        long("corr_with_target", column, ["r", "n_classes"]),
        long("multicollinear", F.concat_ws("~", "a", "b"), ["r"], 3),
        flags.select(F.lit("flags"), F.when(share, "").otherwise(F.col("value")), "flag", F.when(share, number("value")).otherwise(1.0)),
    ]
    return union_all([p.toDF("part", "name", "stat", "value") for p in parts])


@query(
    "duplicate_rows_lineitem",
    "SELECT n_rows, n_distinct, round(1 - n_distinct::DOUBLE / n_rows, 6) AS dup_pct FROM ("
    "SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT l_linenumber, l_quantity, l_returnflag, l_tax FROM "
    + INJECTED_SQL + ")) AS n_distinct FROM lineitem)",
)
def duplicate_rows_lineitem(spark, sf_dir):
    some = injected(spark, sf_dir).select("l_linenumber", "l_quantity", "l_returnflag", "l_tax")
    return rounded_doubles(quality.duplicate_rows(some))


@query(
    "data_distributions_lineitem",
    union_sql(
        LINEITEM_NUMERIC,
        "SELECT '{c}' AS \"column\", bin, sum(hit)::BIGINT AS n FROM (SELECT b.bin, "
        "(len(list_filter(e.edges, lambda q: q <= CAST({c} AS DOUBLE))) = b.bin)::INT AS hit "
        "FROM " + INJECTED_SQL + ", (SELECT quantile_cont(CAST({c} AS DOUBLE), [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges FROM "
        + INJECTED_SQL + ") e, (SELECT unnest(range(10)) AS bin) b WHERE {c} IS NOT NULL) GROUP BY bin",
    ),
)
def data_distributions_lineitem(spark, sf_dir):
    numeric = profile.data_distributions(injected(spark, sf_dir), "l_returnflag")["numeric"]
    return numeric.select("column", F.posexplode("counts").alias("bin", "n")).select(
        "column", F.col("bin").cast("long").alias("bin"), "n"
    )


# -------------------------------------------------------------------- time ---


@query(
    "datetime_summary_events",
    "SELECT (min(ts))::VARCHAR AS min, (max(ts))::VARCHAR AS max, count(*) - count(ts) AS n_nat, "
    "round((SELECT quantile_cont(g, 0.5) FROM (SELECT (epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts)))::DOUBLE / 1e6 AS g FROM events)), 6) AS median_gap_seconds, "
    "round((SELECT max(g) FROM (SELECT (epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts)))::DOUBLE / 1e6 AS g FROM events)), 6) AS max_gap_seconds, "
    "CAST(NULL AS VARCHAR) AS inferred_freq FROM events",
)
def datetime_summary_events(spark, sf_dir):
    return rounded_doubles(timeprofile.datetime_summary(table(spark, sf_dir, "events"), "ts"))


#: Derived series: regular ones, and one that is irregular from its 61st day on.
_SERIES = {
    "days": ("customer", "timestamp_ntz'2000-01-01' + make_dt_interval(cast(c_custkey as int))"),
    "late": ("customer", "timestamp_ntz'2000-01-01' + make_dt_interval(cast(if(c_custkey <= 60, c_custkey, c_custkey * 3 + c_custkey % 2) as int))"),
    "hours": ("customer", "timestamp_ntz'2000-01-01' + make_dt_interval(0, cast(c_custkey * 6 as int))"),
    "quarters": ("nation", "cast(add_months(date'2000-01-01', cast(n_nationkey * 3 as int)) as timestamp_ntz)"),
}


@query(
    "datetime_frequency_series",
    "WITH s AS (SELECT 'days' AS series, TIMESTAMP '2000-01-01' + to_days(c_custkey::INT) AS t FROM customer "
    "UNION ALL SELECT 'late', TIMESTAMP '2000-01-01' + to_days((CASE WHEN c_custkey <= 60 THEN c_custkey ELSE c_custkey * 3 + c_custkey % 2 END)::INT) FROM customer "
    "UNION ALL SELECT 'hours', TIMESTAMP '2000-01-01' + to_hours(c_custkey * 6) FROM customer "
    "UNION ALL SELECT 'quarters', TIMESTAMP '2000-01-01' + to_months((n_nationkey * 3)::INT) FROM nation), "
    "g AS (SELECT series, t, epoch(t) - epoch(lag(t) OVER w) AS gap, "
    "year(t) * 12 + month(t) - lag(year(t) * 12 + month(t)) OVER w AS months FROM s WINDOW w AS (PARTITION BY series ORDER BY t)) "
    "SELECT series, CASE WHEN count(DISTINCT gap) = 1 AND min(gap) = 86400 THEN 'D' "
    "WHEN count(DISTINCT gap) = 1 AND min(gap) = 21600 THEN '6h' "
    "WHEN min(months) = 3 AND max(months) = 3 AND max(day(t)) = 1 THEN 'QS-OCT' END AS inferred_freq FROM g GROUP BY series",
)
def datetime_frequency_series(spark, sf_dir):
    found = [
        (name, timeprofile.infer_frequency(table(spark, sf_dir, source).selectExpr(f"{t} AS t"), "t"))
        for name, (source, t) in _SERIES.items()
    ]
    return spark.createDataFrame(found, "series string, inferred_freq string")


@query(
    "time_gaps_orders",
    "SELECT gap_seconds, count(*) AS n FROM (SELECT (epoch_us(o_orderdate) - epoch_us(lag(o_orderdate) OVER (ORDER BY o_orderdate)))::DOUBLE / 1e6 AS gap_seconds "
    "FROM orders) WHERE gap_seconds IS NOT NULL GROUP BY 1",
)
def time_gaps_orders(spark, sf_dir):
    return timeprofile.time_gaps(table(spark, sf_dir, "orders"), "o_orderdate")


def _texts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_text"),
        F.expr("CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END").alias("some_text"),
    )


@query(
    "datetime_parse_rates",
    "SELECT 'o_orderstatus' AS \"column\", round(avg((try_cast(o_orderstatus AS TIMESTAMP) IS NOT NULL)::INT), 6) AS parse_rate FROM orders "
    "UNION ALL SELECT 'o_orderpriority', round(avg((try_cast(o_orderpriority AS TIMESTAMP) IS NOT NULL)::INT), 6) FROM orders "
    "UNION ALL SELECT 'date_text', round(avg((o_orderdate IS NOT NULL)::INT), 6) FROM orders "
    "UNION ALL SELECT 'some_text', round(avg((o_orderkey % 5 <> 0)::INT), 6) FROM orders",
)
def datetime_parse_rates(spark, sf_dir):
    return rounded_doubles(timeprofile.parse_rates(_texts(spark, sf_dir)))


@query("datetime_detect", "SELECT unnest(['o_orderdate', 'date_text']) AS \"column\"")
def datetime_detect(spark, sf_dir):
    found = timeprofile.detect_datetime_columns(_texts(spark, sf_dir))
    return spark.createDataFrame([(c,) for c in found], "`column` string")


@query(
    "volume_trend_orders_month",
    "WITH p AS (SELECT date_trunc('month', o_orderdate)::DATE AS m, count(*) AS n FROM orders GROUP BY 1), "
    "s AS (SELECT unnest(generate_series((SELECT min(m) FROM p), (SELECT max(m) FROM p), INTERVAL 1 MONTH))::DATE AS m) "
    "SELECT last_day(s.m) AS period, coalesce(p.n, 0) AS n FROM s LEFT JOIN p ON s.m = p.m",
)
def volume_trend_orders_month(spark, sf_dir):
    return timeprofile.volume_trend(table(spark, sf_dir, "orders"), "o_orderdate", "month")


@query(
    "volume_trend_events_day",
    "WITH p AS (SELECT ts::DATE AS d, count(*) AS n FROM events GROUP BY 1), "
    "s AS (SELECT unnest(generate_series((SELECT min(d) FROM p), (SELECT max(d) FROM p), INTERVAL 1 DAY))::DATE AS d) "
    "SELECT s.d AS period, coalesce(p.n, 0) AS n FROM s LEFT JOIN p ON s.d = p.d",
)
def volume_trend_events_day(spark, sf_dir):
    return timeprofile.volume_trend(table(spark, sf_dir, "events"), "ts")


@query(
    "time_quartile_target",
    "WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS k, count(*) OVER () AS n FROM orders), "
    "q AS (SELECT *, 'Q' || greatest(1, CAST(ceil(4.0 * (k - 1) / (n - 1)) AS BIGINT)) AS quartile FROM r) "
    "SELECT quartile, 'o_totalprice' AS \"column\", round(avg(o_totalprice), 4) AS mean FROM q GROUP BY 1 "
    "UNION ALL SELECT quartile, 'o_orderkey', round(avg(o_orderkey), 4) FROM q GROUP BY 1 "
    "UNION ALL SELECT quartile, 'o_custkey', round(avg(o_custkey), 4) FROM q GROUP BY 1",
)
def time_quartile_target(spark, sf_dir):
    out = timeprofile.time_quartile_means(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", ["o_orderkey"])
    return rounded_doubles(out, 4)
