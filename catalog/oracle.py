"""DuckDB SQL with the same results as the registered queries."""

from __future__ import annotations

from catalog.inputs import DOCS, EV, LI, SCORED, SCORED_NULLS, SEGMENT_FACTORS

ORACLE: dict[str, str] = {}

KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
METRICS = ("accuracy", "precision", "recall", "f1_score", "demographic_parity_difference", "equalized_odds_difference")


def add(name: str, sql: str) -> None:
    ORACLE[name] = sql


# ---- dataset audit ---------------------------------------------------------------------------

LI_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "label",
]

add("dataset_shape", f"WITH {LI} SELECT count(*) AS row_count, CAST(11 AS BIGINT) AS column_count FROM li")

add(
    "missing_values",
    f"WITH {LI}, m AS (SELECT * REPLACE (nullif(l_returnflag, 'R') AS l_returnflag) FROM li) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing, count(*) AS row_count FROM m"""
        for c in LI_COLUMNS
    ),
)

add(
    "group_distribution",
    f"""WITH {SCORED_NULLS}
SELECT c_mktsegment AS "group", count(*) AS n FROM scored_nulls WHERE c_mktsegment IS NOT NULL GROUP BY 1""",
)

add(
    "target_rate_by_group",
    f"""WITH {DOCS} SELECT source AS "group", round(avg(quality), 6) AS rate FROM docs
WHERE source IS NOT NULL GROUP BY 1""",
)

add(
    "target_rate_difference",
    f"""WITH {LI}, r AS (SELECT avg(label) AS rate FROM li GROUP BY l_returnflag)
SELECT round(max(rate) - min(rate), 6) AS rate_difference FROM r""",
)


def dataset_audit(ctes: str, relation: str, columns: list[str], attr: str, label: str | None) -> str:
    parts = [
        f"SELECT 'shape' AS section, 'rows' AS item, CAST(count(*) AS DOUBLE) AS value FROM {relation}",
        f"SELECT 'shape', 'columns', CAST({len(columns)} AS DOUBLE)",
        *[f"SELECT 'missing', '{c}', CAST(count(*) - count({c}) AS DOUBLE) FROM {relation}" for c in columns],
        f"SELECT 'distribution', {attr}, CAST(count(*) AS DOUBLE) FROM {relation} WHERE {attr} IS NOT NULL GROUP BY 2",
    ]
    if label:
        parts += [
            f"SELECT 'target_rate', {attr}, round(avg({label}), 6) FROM {relation} WHERE {attr} IS NOT NULL GROUP BY 2",
            f"""SELECT 'target_rate_difference', 'max-min', round(max(r) - min(r), 6) FROM
                (SELECT avg({label}) AS r FROM {relation} WHERE {attr} IS NOT NULL GROUP BY {attr})""",
        ]
    return f"WITH {ctes} " + " UNION ALL ".join(parts)


add(
    "dataset_audit",
    dataset_audit(DOCS, "docs", ["doc_id", "lang", "source", "n_chars", "quality", "toxic"], "lang", "quality"),
)
add(
    "dataset_audit_unlabelled",
    dataset_audit(
        SCORED_NULLS,
        "scored_nulls",
        ["id", "c_mktsegment", "o_orderpriority", "n_regionkey", "o_totalprice", "offer", "c_acctbal", "y_true", "y_pred", "y_pred2", "score"],
        "c_mktsegment",
        None,
    ),
)

add(
    "rates_by_attribute",
    f"WITH {SCORED_NULLS} "
    + " UNION ALL ".join(
        f"""SELECT '{a}' AS attr, CAST({a} AS VARCHAR) AS "group", round(avg(y_true), 6) AS rate, count(*) AS n
FROM scored_nulls WHERE {a} IS NOT NULL GROUP BY {a}"""
        for a in ("c_mktsegment", "o_orderpriority", "n_regionkey")
    ),
)

add(
    "intersectional_rates",
    f"""WITH {SCORED_NULLS} SELECT c_mktsegment, o_orderpriority, round(avg(y_true), 6) AS rate, count(*) AS n
FROM scored_nulls WHERE c_mktsegment IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1, 2""",
)

add(
    "rate_matrix",
    f"""WITH {LI} SELECT l_returnflag, round(avg(label) FILTER (WHERE l_linestatus = 'F'), 6) AS F,
round(avg(label) FILTER (WHERE l_linestatus = 'O'), 6) AS O FROM li GROUP BY 1""",
)


def gap(where: str, keys: str, scope: str) -> str:
    return f"""SELECT '{scope}' AS scope, count(*) AS n_groups, CAST(NULL AS DOUBLE) AS overall_rate,
round(max(r) - min(r), 6) AS gap FROM (SELECT avg(y_true) AS r FROM scored_nulls WHERE {where} GROUP BY {keys})"""


add(
    "gap_summary",
    f"""WITH {SCORED_NULLS}
SELECT 'overall' AS scope, CAST(1 AS BIGINT) AS n_groups, round(avg(y_true), 6) AS overall_rate,
CAST(NULL AS DOUBLE) AS gap FROM scored_nulls
UNION ALL {gap("c_mktsegment IS NOT NULL", "c_mktsegment", "c_mktsegment")}
UNION ALL {gap("o_orderpriority IS NOT NULL", "o_orderpriority", "o_orderpriority")}
UNION ALL {gap("c_mktsegment IS NOT NULL AND o_orderpriority IS NOT NULL", "c_mktsegment, o_orderpriority",
               "c_mktsegment*o_orderpriority")}""",
)

# ---- prediction metrics ----------------------------------------------------------------------


def rates(relation: str, attr: str, pred: str = "y_pred") -> str:
    """Group rates from the rows."""
    return f"""SELECT CAST({attr} AS VARCHAR) AS "group", count(*) AS n, avg({pred}) AS selection_rate,
avg({pred}) FILTER (WHERE y_true = 1) AS tpr, avg({pred}) FILTER (WHERE y_true = 0) AS fpr
FROM {relation} WHERE {attr} IS NOT NULL GROUP BY {attr}"""


def wide(relation: str, attr: str, pred: str = "y_pred") -> str:
    """All metrics of one attribute in one row, performance by the label-wise definitions."""
    return f"""SELECT '{attr}' AS attr, p.*, g.* FROM (
  SELECT sum(hit) / sum(rows) AS accuracy,
         sum(support * CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END) / sum(support) AS precision,
         sum(support * CASE WHEN support = 0 THEN 0 ELSE tp / support END) / sum(support) AS recall,
         sum(support * 2 * tp / (support + predicted)) / sum(support) AS f1_score
  FROM (SELECT l.label, CAST(count(*) FILTER (WHERE y_true = l.label) AS DOUBLE) AS support,
               CAST(count(*) FILTER (WHERE {pred} = l.label) AS DOUBLE) AS predicted,
               CAST(count(*) FILTER (WHERE y_true = l.label AND {pred} = l.label) AS DOUBLE) AS tp,
               CAST(count(*) FILTER (WHERE y_true = l.label AND {pred} = l.label) AS DOUBLE) AS hit,
               CAST(count(*) FILTER (WHERE y_true = l.label) AS DOUBLE) AS rows
        FROM {relation}, (VALUES (0), (1)) AS l(label) GROUP BY l.label)) p,
  (SELECT max(selection_rate) - min(selection_rate) AS demographic_parity_difference,
          CASE WHEN max(tpr) IS NOT NULL THEN greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)) END
            AS equalized_odds_difference,
          max(tpr) - min(tpr) AS equal_opportunity_difference,
          max(selection_rate) - min(selection_rate) AS statistical_parity_difference
   FROM ({rates(relation, attr, pred)})) g"""


def r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


add(
    "confusion_cells",
    f"""WITH {SCORED_NULLS} SELECT 'c_mktsegment' AS attr, c_mktsegment AS "group", y_true, y_pred, count(*) AS n
FROM scored_nulls GROUP BY 2, 3, 4""",
)
add(
    "performance_metrics",
    f"WITH {SCORED_NULLS} SELECT attr, {r6(*METRICS[:4])} FROM ({wide('scored_nulls', 'c_mktsegment')})",
)
BAND = "CASE WHEN {0} < 90000 THEN 'low' WHEN {0} < 210000 THEN 'middle' ELSE 'high' END"
add(
    "performance_metrics_multiclass",
    f"""WITH {SCORED_NULLS},
b AS (SELECT {BAND.format('o_totalprice')} AS y, {BAND.format('offer')} AS p FROM scored_nulls),
l AS (SELECT label, count(*) FILTER (y = label) AS r, count(*) FILTER (p = label) AS s,
  count(*) FILTER (y = label AND p = label) AS h FROM b, (VALUES ('low'), ('middle'), ('high')) AS v(label) GROUP BY label)
SELECT 'c_mktsegment' AS attr, round(sum(h) / sum(r), 6) AS accuracy,
  round(sum(r * CASE WHEN s = 0 THEN 0 ELSE h / s END) / sum(r), 6) AS precision,
  round(sum(r * CASE WHEN r = 0 THEN 0 ELSE h / r END) / sum(r), 6) AS recall,
  round(sum(r * CASE WHEN r + s = 0 THEN 0 ELSE 2 * h / (r + s) END) / sum(r), 6) AS f1_score FROM l""",
)
add(
    "selection_rate",
    f"""WITH {SCORED_NULLS} SELECT 'c_mktsegment' AS attr, "group", {r6('selection_rate')}
FROM ({rates('scored_nulls', 'c_mktsegment')})""",
)
add(
    "group_tpr_fpr",
    f"""WITH {SCORED} SELECT 'c_mktsegment' AS attr, "group", n, {r6('selection_rate', 'tpr', 'fpr')}
FROM ({rates('scored', 'c_mktsegment')})""",
)
for query, relation, ctes, attr, metric in (
    ("demographic_parity", "scored_nulls", SCORED_NULLS, "c_mktsegment", "demographic_parity_difference"),
    ("statistical_parity", "scored", SCORED, "o_orderpriority", "statistical_parity_difference"),
    ("equalized_odds", "scored", SCORED, "c_mktsegment", "equalized_odds_difference"),
    ("equal_opportunity", "scored", SCORED, "c_mktsegment", "equal_opportunity_difference"),
):
    add(query, f"WITH {ctes} SELECT attr, {r6(metric)} FROM ({wide(relation, attr)})")


def long(source: str, names=METRICS, keys: str = "attr") -> str:
    prefix = f"{keys}, " if keys else ""
    return " UNION ALL ".join(f"SELECT {prefix}'{m}' AS metric, {m} AS value FROM {source}" for m in names)


add(
    "all_metrics",
    f"""WITH {SCORED}, w AS ({wide('scored', 'c_mktsegment')})
SELECT attr, metric, round(value, 6) AS value FROM ({long('w')})""",
)

AUDIT = f"""attr, {r6(*METRICS)},
  coalesce(demographic_parity_difference > 0.1, false) AS demographic_parity_violation,
  coalesce(equalized_odds_difference > 0.1, false) AS equalized_odds_violation,
  round(1 - CASE WHEN demographic_parity_difference IS NOT NULL
            THEN greatest(demographic_parity_difference, equalized_odds_difference) END, 6) AS overall_fairness_score,
  CAST(0.1 AS DOUBLE) AS threshold"""

add("prediction_audit", f"WITH {SCORED} SELECT {AUDIT} FROM ({wide('scored', 'c_mktsegment')})")
add(
    "prediction_audit_multi",
    f"WITH {SCORED_NULLS} SELECT {AUDIT} FROM ("
    + " UNION ALL ".join(wide("scored_nulls", a) for a in ("c_mktsegment", "o_orderpriority", "n_regionkey"))
    + ")",
)

EXTRA = ("equal_opportunity_difference", "statistical_parity_difference")
add(
    "fairness_status",
    f"""WITH {SCORED}, w AS ({wide('scored', 'c_mktsegment')} UNION ALL {wide('scored', 'o_orderpriority')}),
s AS (SELECT attr, 1 - greatest(demographic_parity_difference, equalized_odds_difference) AS score FROM w),
l AS ({long('w', (*METRICS, *EXTRA))} UNION ALL SELECT attr, 'overall_fairness_score', score FROM s),
k AS (SELECT *, CASE WHEN metric LIKE '%difference' THEN 'fairness'
             WHEN metric = 'overall_fairness_score' THEN 'score' ELSE 'performance' END AS kind FROM l)
SELECT attr, kind, metric, round(value, 6) AS value,
       CASE WHEN kind = 'fairness' THEN CAST(0.1 AS DOUBLE) END AS threshold,
       CASE WHEN kind = 'fairness' THEN coalesce(value > 0.1, false) END AS violation,
       CASE WHEN kind = 'fairness' THEN CASE WHEN abs(value) <= 0.1 THEN 'OK' ELSE 'VIOLATION' END END AS status
FROM k""",
)
add(
    "violation_count",
    f"""WITH {SCORED} SELECT attr, CAST(demographic_parity_difference > 0.1 AS INTEGER)
 + CAST(equalized_odds_difference > 0.1 AS INTEGER) AS violations
FROM ({wide('scored', 'c_mktsegment')} UNION ALL {wide('scored', 'o_orderpriority')})""",
)

# ---- comparison ------------------------------------------------------------------------------

PAIRED = f"""{SCORED}, b AS ({wide('scored', 'c_mktsegment')}), f AS ({wide('scored', 'c_mktsegment', 'y_pred2')}),
bl AS ({long('b', keys='')}), fl AS ({long('f', keys='')}),
j AS (SELECT metric, bl.value AS baseline, fl.value AS final FROM bl JOIN fl USING (metric))"""

add(
    "compare_performance",
    f"""WITH {PAIRED} SELECT metric, {r6('baseline', 'final')}, round(final - baseline, 6) AS change,
round(CASE WHEN baseline <> 0 THEN (final - baseline) / baseline * 100 ELSE 0 END, 6) AS change_pct,
CASE WHEN final > baseline THEN 'Improved' WHEN final < baseline THEN 'Decreased' ELSE 'Unchanged' END AS status
FROM j WHERE metric NOT LIKE '%difference'""",
)
FAIR = """metric, round(baseline, 6) AS baseline, round(final, 6) AS final, round(baseline - final, 6) AS improvement,
round(CASE WHEN baseline <> 0 THEN (baseline - final) / baseline * 100 ELSE 0 END, 6) AS improvement_pct"""
add(
    "compare_fairness",
    f"""WITH {PAIRED} SELECT {FAIR},
CASE WHEN baseline > final THEN 'Better' WHEN baseline < final THEN 'Worse' ELSE 'Same' END AS status,
metric = 'equalized_odds_difference' AS is_primary FROM j WHERE metric LIKE '%difference'""",
)
add(
    "goal_verdict",
    f"""WITH {PAIRED} SELECT primary_metric, baseline, final, improvement, improvement_pct,
improvement > 0 AS goal_achieved, final <= 0.1 AS threshold_met, CAST(0.1 AS DOUBLE) AS threshold,
CASE WHEN final <= 0.1 THEN 'SUCCESS' WHEN improvement > 0 THEN 'IMPROVED' ELSE 'FAILED' END AS verdict
FROM (SELECT {FAIR.replace('metric,', 'metric AS primary_metric,', 1)} FROM j
      WHERE metric = 'demographic_parity_difference')""",
)
SERIES = """SELECT metric, 'Before' AS series, round(baseline, 6) AS value, CAST({t} AS DOUBLE) AS threshold FROM j
WHERE metric IN ({m}) UNION ALL
SELECT metric, 'After', round(final, 6), CAST({t} AS DOUBLE) FROM j WHERE metric IN ({m})"""
add(
    "comparison_series",
    f"WITH {PAIRED} "
    + SERIES.format(t="0.1", m="'demographic_parity_difference', 'equalized_odds_difference'"),
)
add(
    "comparison_series_performance",
    f"WITH {PAIRED} " + SERIES.format(t="NULL", m="'accuracy', 'precision', 'recall'"),
)
add(
    "run_metric_rows",
    f"""WITH {PAIRED}, p AS (SELECT * FROM j WHERE metric = 'demographic_parity_difference'),
u AS (SELECT 'baseline' AS stage, 'baseline_' || metric AS metric, baseline AS value FROM j
UNION ALL SELECT 'final', 'final_' || metric, final FROM j
UNION ALL SELECT 'summary', 'primary_fairness_metric', final FROM p
UNION ALL SELECT 'summary', 'fairness_improvement', baseline - final FROM p
UNION ALL SELECT 'summary', 'fairness_improvement_pct',
  CASE WHEN baseline <> 0 THEN (baseline - final) / baseline * 100 ELSE 0 END FROM p)
SELECT 'run-1' AS run_id, stage, metric, round(value, 6) AS value FROM u WHERE value IS NOT NULL""",
)

# ---- split, cleaning, features ---------------------------------------------------------------


def split(test: float, val: float, seed: int) -> str:
    return f"""SELECT id, y_true, CASE WHEN pos <= floor(n * {test} + 0.5) THEN 'test'
WHEN pos <= floor(n * {test} + 0.5) + floor(n * {val} + 0.5) THEN 'validation' ELSE 'train' END AS split
FROM (SELECT id, y_true, count(*) OVER (PARTITION BY y_true) AS n,
      row_number() OVER (PARTITION BY y_true ORDER BY md5(CAST(id AS VARCHAR) || ':{seed}')) AS pos FROM scored)"""


add("stratified_split", f"WITH {SCORED} {split(0.2, 0.2, 42)}")
add(
    "split_summary",
    f"""WITH {SCORED} SELECT split, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS ratio
FROM ({split(0.25, 0.15, 7)}) GROUP BY split""",
)


def fill(partition: str) -> str:
    window = f"OVER ({partition} ORDER BY ts, event_id ROWS BETWEEN"
    return f"""WITH {EV} SELECT event_id, ts, user_id, event_type,
coalesce(last_value(value IGNORE NULLS) {window} UNBOUNDED PRECEDING AND CURRENT ROW),
         first_value(value IGNORE NULLS) {window} CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM ev"""


add("ffill_bfill", fill("PARTITION BY user_id"))
add("ffill_bfill_global", fill(""))
PIECES = "OVER (PARTITION BY user_id ORDER BY kind, event_id ROWS BETWEEN"
add(
    "ffill_bfill_pieces",
    f"""WITH {EV}, k AS (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE event_type END AS kind FROM ev)
SELECT event_id, user_id, kind,
coalesce(last_value(value IGNORE NULLS) {PIECES} UNBOUNDED PRECEDING AND CURRENT ROW),
         first_value(value IGNORE NULLS) {PIECES} CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM k""",
)
add("clip", f"SELECT {KEY}, least(greatest(l_quantity, 5.0::DOUBLE), 40.0::DOUBLE) AS l_quantity FROM lineitem")
add(
    "scale_by_group",
    f"WITH {SCORED_NULLS} SELECT id, c_mktsegment, round(o_totalprice * CASE c_mktsegment "
    + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in SEGMENT_FACTORS.items())
    + " ELSE 1 END, 4) AS o_totalprice FROM scored_nulls",
)
add(
    "logistic_score",
    f"""SELECT {KEY}, round(1 / (1 + exp(-(
 0.8::DOUBLE - 0.035::DOUBLE * (l_quantity - 20) + 11::DOUBLE * (l_discount - (SELECT avg(l_discount) FROM lineitem))
 + 4.5::DOUBLE * l_tax + CASE WHEN l_linestatus = 'O' AND l_linenumber = 1 THEN -0.7::DOUBLE ELSE 0 END
 + CASE WHEN l_linenumber = 7 THEN 1.1::DOUBLE ELSE 0 END))), 6) AS score FROM lineitem""",
)

FLAGGED = f"flagged AS (SELECT {KEY}, nullif(l_returnflag, 'A') AS l_returnflag, l_linestatus FROM lineitem)"
ENCODED = """codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
  FROM (SELECT DISTINCT coalesce(l_returnflag, 'nan') AS v FROM flagged)),
statuses AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
  FROM (SELECT DISTINCT coalesce(l_linestatus, 'nan') AS v FROM flagged))"""
add(
    "label_encode",
    f"""WITH {FLAGGED}, {ENCODED} SELECT {KEY}, coalesce(c.code, 0) AS l_returnflag, coalesce(s.code, 0) AS l_linestatus
FROM flagged LEFT JOIN codes c ON coalesce(l_returnflag, 'nan') = c.v
LEFT JOIN statuses s ON coalesce(l_linestatus, 'nan') = s.v""",
)
add(
    "label_unseen",
    f"""WITH codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
  FROM (SELECT DISTINCT coalesce(l_returnflag, 'nan') AS v FROM lineitem WHERE l_returnflag <> 'R'))
SELECT {KEY}, coalesce(code, 0) AS l_returnflag FROM lineitem LEFT JOIN codes ON coalesce(l_returnflag, 'nan') = v""",
)
add(
    "label_roundtrip",
    f"""WITH {FLAGGED}, {ENCODED}, shifted AS (
  SELECT {KEY}, l_linestatus, coalesce(c.code, 0) + l_linenumber * 0.5::DOUBLE - 1 AS x
  FROM flagged LEFT JOIN codes c ON coalesce(l_returnflag, 'nan') = c.v),
clipped AS (SELECT *, CAST(least(greatest(round_even(x, 0), 0), (SELECT max(code) FROM codes)) AS BIGINT) AS code FROM shifted)
SELECT {KEY}, codes.v AS l_returnflag, l_linestatus FROM clipped JOIN codes USING (code)""",
)
add(
    "category_codes",
    f"""WITH {FLAGGED}, c AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
  FROM (SELECT DISTINCT l_returnflag AS v FROM flagged WHERE l_returnflag IS NOT NULL)),
s AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
  FROM (SELECT DISTINCT l_linestatus AS v FROM flagged WHERE l_linestatus IS NOT NULL))
SELECT {KEY}, coalesce(c.code, -1) AS l_returnflag, coalesce(s.code, -1) AS l_linestatus
FROM flagged LEFT JOIN c ON l_returnflag = c.v LEFT JOIN s ON l_linestatus = s.v""",
)
add(
    "standard_scale",
    f"""WITH m AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp,
  stddev_pop(l_extendedprice) AS sp FROM lineitem)
SELECT {KEY}, round((l_quantity - mq) / sq, 6) AS l_quantity, round((l_extendedprice - mp) / sp, 6) AS l_extendedprice
FROM lineitem, m""",
)
add(
    "assembled_features",
    f"""WITH {FLAGGED}, {ENCODED}, m AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq,
  avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem)
SELECT {KEY}, round((l_extendedprice - mp) / sp, 6) AS x0, CAST(code AS DOUBLE) AS x1,
round((l_quantity - mq) / sq, 6) AS x2
FROM lineitem JOIN codes ON coalesce(nullif(l_returnflag, 'A'), 'nan') = v, m""",
)

# ---- repair ----------------------------------------------------------------------------------

add(
    "group_stats",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS attr, {a} AS "group", '{f}' AS feature, round(avg({f}), 4) AS mean,
round(stddev_samp({f}), 4) AS std, count(*) AS size FROM lineitem GROUP BY {a} HAVING count(*) > 1"""
        for a in ("l_returnflag", "l_linestatus")
        for f in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
# l_linestatus is a column of neither role in the query, so it is not a feature
add(
    "overall_means",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(avg({f}), 4) AS mean FROM lineitem"
        for f in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)

TAXED = """taxed AS (SELECT l_returnflag, l_quantity, l_discount,
  CASE WHEN l_returnflag = 'R' THEN nullif(l_tax, 0.04) ELSE l_tax END AS l_tax FROM lineitem)"""


def covariances(keys: str, group: str) -> str:
    """Population covariance, or the diagonal of sample variances when a value is missing."""
    features = ("l_quantity", "l_discount", "l_tax")
    complete = " AND ".join(f"count({f}) = count(*)" for f in features)
    parts = []
    for i, a in enumerate(features):
        for b in features[i:]:
            other = f"var_samp({a})" if a == b else "0"
            parts.append(
                f"""SELECT {keys}'{a}' AS f_i, '{b}' AS f_j,
round(CASE WHEN {complete} THEN covar_pop({a}, {b}) ELSE {other} END, 6) + 0.0 AS cov FROM taxed {group}"""
            )
    return " UNION ALL ".join(parts)


add(
    "group_covariance",
    f"""WITH {TAXED} {covariances("'l_returnflag' AS attr, l_returnflag AS \"group\", ", "GROUP BY l_returnflag")}""",
)
WIDE = [f"f{i:02d}" for i in range(1, 31)]
WIDE_ROWS = "wide AS (SELECT l_returnflag, " + ", ".join(
    f"l_quantity * {i} + l_tax * {100 * (i % 3)} AS {f}" for i, f in enumerate(WIDE, 1)
) + " FROM lineitem)"
add(
    "group_covariance_wide",
    f"WITH {WIDE_ROWS} "
    + " UNION ALL ".join(
        f"""SELECT 'l_returnflag' AS attr, l_returnflag AS "group", '{a}' AS f_i, '{b}' AS f_j, round(covar_pop({a}, {b}), 4) AS cov
FROM wide GROUP BY l_returnflag"""
        for i, a in enumerate(WIDE)
        for b in WIDE[i:]
    ),
)
add("overall_covariance", f"WITH {TAXED} {covariances('', '')}")

SIZES = " UNION ALL ".join(
    f"""SELECT '{a}' AS attr, {a} AS "group", count(*) AS size FROM scored_nulls WHERE {a} IS NOT NULL
GROUP BY {a} HAVING count(*) > 1"""
    for a in ("c_mktsegment", "o_orderpriority")
)
add(
    "group_sizes",
    f"""WITH {SCORED_NULLS}, s AS ({SIZES}) SELECT attr, min(size) AS size_min, max(size) AS size_max,
round(avg(size), 6) AS size_mean, round(stddev_pop(size), 6) AS size_std, count(*) AS group_count FROM s GROUP BY attr""",
)
add(
    "group_shares",
    f"""WITH {SCORED_NULLS}, s AS ({SIZES})
SELECT attr, "group", size, round(size / sum(size) OVER (PARTITION BY attr), 6) AS proportion FROM s""",
)

add(
    "repair_mean",
    f"""WITH r AS (SELECT {KEY}, l_quantity, l_extendedprice, nullif(l_returnflag, 'N') AS l_returnflag, l_linestatus
  FROM lineitem),
g AS (SELECT l_returnflag AS k, avg(l_quantity) AS mq, avg(l_extendedprice) AS mp FROM r
  WHERE l_returnflag IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
o AS (SELECT avg(l_quantity) AS oq, avg(l_extendedprice) AS op FROM r)
SELECT {KEY}, round(l_quantity + coalesce(0.8 * (oq - mq), 0), 4) AS l_quantity,
round(l_extendedprice + coalesce(0.8 * (op - mp), 0), 4) AS l_extendedprice, l_returnflag, l_linestatus
FROM r CROSS JOIN o LEFT JOIN g ON l_returnflag = k""",
)


def two_attributes(features: tuple[str, ...], source: str) -> str:
    means = ", ".join(f"avg({f}) AS m_{f}" for f in features)
    return f"""a AS (SELECT l_returnflag AS k, {means} FROM {source} GROUP BY 1),
b AS (SELECT l_linestatus AS k, {means} FROM {source} GROUP BY 1), o AS (SELECT {means} FROM {source})"""


JOINED = "JOIN a ON l_returnflag = a.k JOIN b ON l_linestatus = b.k CROSS JOIN o"
add(
    "repair_mean_two_attrs",
    f"""WITH {two_attributes(('l_quantity', 'l_extendedprice'), 'lineitem')} SELECT {KEY},
round(l_quantity + 2 * o.m_l_quantity - a.m_l_quantity - b.m_l_quantity, 4) AS l_quantity,
round(l_extendedprice + 2 * o.m_l_extendedprice - a.m_l_extendedprice - b.m_l_extendedprice, 4) AS l_extendedprice,
l_returnflag, l_linestatus FROM lineitem {JOINED}""",
)
add(
    "repair_mean_integer",
    f"""WITH t AS (SELECT {KEY}, CAST(l_linenumber * 3 + CASE WHEN l_returnflag = 'R' THEN 5 ELSE 0 END
  + CASE WHEN l_linestatus = 'F' THEN 2 ELSE 0 END AS INTEGER) AS amount, l_returnflag, l_linestatus FROM lineitem),
{two_attributes(('amount',), 't')}
SELECT {KEY}, CAST(round_even(round_even(amount + 0.7 * (o.m_amount - a.m_amount), 0)
  + 0.7 * (o.m_amount - b.m_amount), 0) AS INTEGER) AS amount, l_returnflag, l_linestatus FROM t {JOINED}""",
)
add(
    "repair_mean_digest",
    f"""WITH {SCORED_NULLS}, p AS (SELECT c_mktsegment, o_totalprice * CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1.5
  ELSE 1.0 END AS price FROM scored_nulls),
g AS (SELECT c_mktsegment AS k, avg(price) AS m FROM p WHERE c_mktsegment IS NOT NULL GROUP BY 1),
r AS (SELECT c_mktsegment, price + coalesce((SELECT avg(price) FROM p) - m, 0) AS price
  FROM p LEFT JOIN g ON c_mktsegment = k)
SELECT c_mktsegment, count(*) AS n, round(avg(price), 3) AS mean_price, round(min(price), 3) AS min_price,
round(max(price), 3) AS max_price FROM r GROUP BY 1""",
)
add(
    "repair_covariance",
    f"""WITH c AS (SELECT {KEY}, l_returnflag, l_quantity * 1.5::DOUBLE AS q,
  l_discount * CASE WHEN l_returnflag = 'A' THEN 0.7::DOUBLE ELSE 3.0::DOUBLE END AS d FROM lineitem),
fit AS (SELECT l_returnflag, avg(l_quantity) AS mq, avg(l_discount) AS md, covar_pop(l_quantity, l_quantity) AS fqq,
  covar_pop(l_discount, l_discount) AS fdd, covar_pop(l_quantity, l_discount) AS fqd FROM lineitem GROUP BY 1),
cur AS (SELECT l_returnflag, covar_samp(q, q) AS cqq, covar_samp(d, d) AS cdd, covar_samp(q, d) AS cqd FROM c GROUP BY 1),
o AS (SELECT avg(l_quantity) AS oq, avg(l_discount) AS od FROM lineitem),
s AS (SELECT l_returnflag, mq, md,
  CASE WHEN cqq * cdd - cqd * cqd > 1e-8 AND fqq * fdd - fqd * fqd > 1e-8
       THEN least(greatest(sqrt(fqq / (cqq + 1e-8)), 0.5), 2.0) ELSE 1 END AS sq,
  CASE WHEN cqq * cdd - cqd * cqd > 1e-8 AND fqq * fdd - fqd * fqd > 1e-8
       THEN least(greatest(sqrt(fdd / (cdd + 1e-8)), 0.5), 2.0) ELSE 1 END AS sd
  FROM fit JOIN cur USING (l_returnflag))
SELECT {KEY}, round((q + 0.6 * (oq - mq) - oq) * sq + oq, 6) AS l_quantity,
round((d + 0.6 * (od - md) - od) * sd + od, 6) AS l_discount, l_returnflag
FROM c JOIN s USING (l_returnflag) CROSS JOIN o""",
)
FOUR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def determinant(kind: str, source: str, names: tuple[str, ...], columns: tuple[str, ...] | None = None) -> str:
    """Expansion along the first row."""
    columns = names if columns is None else columns
    if not names:
        return "1"
    parts = [
        f"{'-' if i % 2 else ''}{kind}({source}{names[0]}, {source}{c}) * ({determinant(kind, source, names[1:], columns[:i] + columns[i + 1:])})"
        for i, c in enumerate(columns)
    ]
    return " + ".join(parts)


def four(factors: dict[str, str]) -> str:
    fit = ", ".join(f"avg({f}) AS m_{f}, covar_pop({f}, {f}) AS v_{f}" for f in FOUR)
    now = ", ".join(f"covar_samp({f}, {f}) AS c_{f}" for f in FOUR)
    scaled = ", ".join(f"{f} * {factors.get(f, '1.0')}::DOUBLE AS {f}" for f in FOUR)
    results = ", ".join(
        f"""round(({f} + 0.6 * (o_{f} - m_{f}) - o_{f})
  * CASE WHEN det_fit > 1e-8 AND det_now > 1e-8 THEN least(greatest(sqrt(v_{f} / (c_{f} + 1e-8)), 0.5), 2.0) ELSE 1 END + o_{f}, 6) AS {f}"""
        for f in FOUR
    )
    return f"""WITH c AS (SELECT {KEY}, {scaled}, l_returnflag, l_linestatus, CASE WHEN l_linenumber > 3 THEN 'late' ELSE 'early' END AS kind FROM lineitem),
fit AS (SELECT l_returnflag, {fit}, {determinant('covar_pop', '', FOUR)} AS det_fit FROM lineitem GROUP BY 1),
cur AS (SELECT l_returnflag, {now}, {determinant('covar_samp', '', FOUR)} AS det_now FROM c GROUP BY 1),
o AS (SELECT {', '.join(f'avg({f}) AS o_{f}' for f in FOUR)} FROM lineitem)
SELECT {KEY}, {results}, l_returnflag, l_linestatus, kind FROM c JOIN fit USING (l_returnflag) JOIN cur USING (l_returnflag) CROSS JOIN o"""


add("repair_covariance_four", four({"l_quantity": "1.5", "l_tax": "0.8"}))
add(
    "repair_multivariate_full",
    "WITH "
    + """g AS (SELECT l_returnflag AS k, avg(l_quantity) AS q, avg(l_discount) AS d, avg(l_tax) AS t FROM lineitem GROUP BY 1),
o AS (SELECT avg(l_quantity) AS q, avg(l_discount) AS d, avg(l_tax) AS t FROM lineitem)
SELECT """
    + KEY
    + """, round(l_quantity + o.q - g.q, 6) AS l_quantity, round(l_discount + o.d - g.d, 6) AS l_discount,
round(l_tax + o.t - g.t, 6) AS l_tax, l_returnflag FROM lineitem JOIN g ON l_returnflag = k CROSS JOIN o""",
)
add(
    "repair_categories",
    f"""WITH t AS (SELECT {KEY}, l_quantity, CASE WHEN l_returnflag = 'R' THEN 'c' WHEN l_linenumber > 3 THEN 'b'
  ELSE 'a' END AS kind, l_returnflag, l_linestatus FROM lineitem),
n AS (SELECT *, CASE kind WHEN 'a' THEN 0 WHEN 'b' THEN 1 ELSE 2 END AS code FROM t),
g AS (SELECT l_returnflag AS k, avg(l_quantity) AS q, avg(code) AS c FROM n GROUP BY 1),
o AS (SELECT avg(l_quantity) AS q, avg(code) AS c FROM n),
m AS (SELECT n.*, round_even(code + (o.c - g.c), 0) AS moved, l_quantity + o.q - g.q AS quantity
  FROM n JOIN g ON l_returnflag = k CROSS JOIN o)
SELECT {KEY}, round(quantity, 6) AS l_quantity, l_returnflag, l_linestatus,
CASE WHEN moved <= 0 THEN 'a' WHEN moved >= 2 THEN 'c' ELSE 'b' END AS kind FROM m""",
)
add(
    "reweighing",
    f"""WITH {DOCS} SELECT doc_id, lang, quality, round(CAST(count(*) OVER (PARTITION BY lang) AS DOUBLE)
 * count(*) OVER (PARTITION BY quality) / (count(*) OVER () * CAST(count(*) OVER (PARTITION BY lang, quality) AS DOUBLE)), 6)
 AS weight FROM docs""",
)

# ---- reading and writing -----------------------------------------------------------------------

add(
    "csv_checked_rows",
    """SELECT CASE WHEN o_orderkey % 101 = 0 THEN 'no number' WHEN o_orderkey % 97 = 0 THEN 'too short' ELSE o_orderpriority END AS priority,
count(*) AS n, round(sum(CASE WHEN o_orderkey % 101 <> 0 AND o_orderkey % 97 <> 0 THEN round(o_totalprice, 2) END), 2) AS total
FROM orders GROUP BY 1""",
)
add(
    "run_param_rows",
    """SELECT 'run-1' AS run_id, 'data.sizes.' || o_orderpriority AS key, CAST(count(*) AS VARCHAR) AS value FROM orders GROUP BY o_orderpriority
UNION ALL SELECT 'run-1', 'training.attributes', 'c_mktsegment,o_orderpriority' UNION ALL SELECT 'run-1', 'training.seed', NULL""",
)
add(
    "group_statistics_rows",
    """WITH g AS (SELECT l_returnflag AS k, count(*) AS n, avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_tax) AS mt,
  stddev_samp(l_tax) AS st FROM lineitem GROUP BY 1),
r AS (SELECT k, NULL AS feature, 'size' AS statistic, CAST(n AS DOUBLE) AS value FROM g
  UNION ALL SELECT k, NULL, 'proportion', n / sum(n) OVER () FROM g
  UNION ALL SELECT k, 'l_quantity', 'mean', mq FROM g UNION ALL SELECT k, 'l_quantity', 'std', sq FROM g
  UNION ALL SELECT k, 'l_tax', 'mean', mt FROM g UNION ALL SELECT k, 'l_tax', 'std', st FROM g)
SELECT 'run-1' AS run_id, 'l_returnflag' AS attr, k AS "group", CAST(feature AS VARCHAR) AS feature, statistic, round(value, 6) AS value FROM r""",
)
# ---- thresholds and models -------------------------------------------------------------------


def thresholds(relation: str, attr: str, null_token: str | None) -> str:
    """Every distinct score of a group, and 0.5, as a candidate."""
    group = f"CAST({attr} AS VARCHAR)"
    if null_token is not None:
        group = f"coalesce({group}, '{null_token}')"
    return f"""SELECT '{attr}' AS attr, "group", threshold, n, selected FROM (
  SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY gap, other, threshold) AS pos FROM (
    SELECT "group", threshold, other, n, selected,
           abs(selected / n - (SELECT sum(y_pred) / count(y_pred) FROM {relation})) AS gap FROM (
      SELECT "group", score AS threshold, 1 AS other, sum(c) OVER (PARTITION BY "group") AS n,
             sum(c) OVER (PARTITION BY "group" ORDER BY score DESC) AS selected
      FROM (SELECT {group} AS "group", score, count(*) AS c FROM {relation} WHERE {group} IS NOT NULL GROUP BY 1, 2)
      UNION ALL
      SELECT {group}, 0.5, 0, count(*), count(*) FILTER (WHERE score >= 0.5) FROM {relation}
      WHERE {group} IS NOT NULL GROUP BY 1)))
WHERE pos = 1"""


add(
    "fit_group_thresholds",
    f"""WITH {SCORED_NULLS} SELECT attr, "group", round(CAST(threshold AS DOUBLE), 6) AS threshold,
CAST(n AS BIGINT) AS n, CAST(selected AS BIGINT) AS selected FROM (
{thresholds('scored_nulls', 'c_mktsegment', 'nan')} UNION ALL {thresholds('scored_nulls', 'o_orderpriority', 'nan')})""",
)
DIRTY = """dirty AS (SELECT * REPLACE (CASE id % 11 WHEN 1 THEN 'inf'::DOUBLE
  WHEN 2 THEN '-inf'::DOUBLE WHEN 3 THEN score * 1e-300::DOUBLE WHEN 4 THEN score * -1e250::DOUBLE ELSE score END AS score)
  FROM scored_nulls WHERE id % 11 <> 0)"""
add(
    "fit_group_thresholds_dirty",
    f"""WITH {SCORED_NULLS}, {DIRTY} SELECT attr, "group", CAST(threshold AS DOUBLE) AS threshold,
CAST(n AS BIGINT) AS n, CAST(selected AS BIGINT) AS selected FROM (
{thresholds('dirty', 'c_mktsegment', 'nan')} UNION ALL {thresholds('dirty', 'o_orderpriority', 'nan')})""",
)
add(
    "fit_group_thresholds_approx",
    f"""WITH {SCORED_NULLS} SELECT attr, "group", count(*) AS n, true AS within_error FROM (
SELECT 'c_mktsegment' AS attr, coalesce(c_mktsegment, 'nan') AS "group" FROM scored_nulls
UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM scored_nulls) GROUP BY 1, 2""",
)
add(
    "threshold_predict",
    f"""WITH {SCORED_NULLS}, tr AS ({thresholds('scored_nulls', 'n_regionkey', None)}),
ts AS ({thresholds('scored_nulls', 'c_mktsegment', None)})
SELECT id, CASE WHEN ts.threshold IS NOT NULL THEN CAST(score >= ts.threshold AS INTEGER)
WHEN tr.threshold IS NOT NULL THEN CAST(score >= tr.threshold AS INTEGER) ELSE 0 END AS prediction
FROM scored_nulls LEFT JOIN tr ON CAST(n_regionkey AS VARCHAR) = tr."group" LEFT JOIN ts ON c_mktsegment = ts."group\"""",
)
add(
    "single_class_model",
    f"WITH {SCORED} SELECT c_mktsegment, CAST(1 AS INTEGER) AS prediction, count(*) AS n FROM scored GROUP BY 1",
)


def uniform(*keys: str) -> str:
    """The first 52 bits of an md5 as a number between 0 and 1."""
    return f"""((CAST('0x' || substr(md5(concat_ws('|', {', '.join(keys)})), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)"""


def normal(*keys: str) -> str:
    """Box-Muller on two uniforms."""
    u, v = uniform(*keys, "'radius'"), uniform(*keys, "'angle'")
    return f"(sqrt(-2.0::DOUBLE * ln({u})) * cos(2.0::DOUBLE * pi() * {v}))"


def noisy(feature: str) -> str:
    """Half of the way to the overall mean, and noise of a twentieth of the group's deviation."""
    return f"""round({feature} + 0.5 * (o.m_{feature} - g.m_{feature})
  + 0.05::DOUBLE * g.d_{feature} * {normal("'42'", 'id', "'c_mktsegment'", f"'{feature}'")}, 4) AS {feature}"""


add(
    "repair_multivariate_noise",
    f"""WITH {SCORED},
g AS (SELECT c_mktsegment AS k, avg(o_totalprice) AS m_o_totalprice, avg(c_acctbal) AS m_c_acctbal,
  stddev_samp(o_totalprice) AS d_o_totalprice, stddev_samp(c_acctbal) AS d_c_acctbal FROM scored GROUP BY 1),
o AS (SELECT avg(o_totalprice) AS m_o_totalprice, avg(c_acctbal) AS m_c_acctbal FROM scored)
SELECT id, c_mktsegment, {noisy('o_totalprice')}, {noisy('c_acctbal')} FROM scored JOIN g ON c_mktsegment = k CROSS JOIN o""",
)
add(
    "fair_draws",
    f"""WITH {SCORED}, d AS (SELECT id, CAST(0.3::DOUBLE >= {uniform("'42'", 'id')} AS INTEGER) AS prediction FROM scored)
SELECT id, 0.3::DOUBLE AS expected, prediction, CASE prediction WHEN 1 THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END AS pseudo_probability FROM d""",
)
# ---- what fits promise: the values are those of the definition, not of a fit --------------------

add(
    "baseline_model_gradient",
    """SELECT feature, 0.0::DOUBLE AS gradient FROM (VALUES ('offer'), ('c_acctbal'), ('intercept')) AS t(feature)""",
)
add(
    "retried_fit",
    """SELECT * FROM (VALUES ('hasty', 3, false, true, false), ('patient', 1, true, true, true))
AS t(fit, attempts, converged, gradient_as_reported, flat)""",
)
for name in ("fair_dp_properties", "fair_eo_properties"):
    add(
        name,
        f"""WITH {SCORED} SELECT count(*) AS n, true AS gap_as_reported, true AS converged, true AS fairer,
CAST(0 AS BIGINT) AS wrong_draws, CAST(0 AS BIGINT) AS wrong_scores FROM scored""",
    )
