"""DuckDB SQL equal to each registered query (tables are views).

Fragments are composed as CTEs.  Rounding: Spark rounds a double half-up
on its shortest decimal form; the oracle reproduces that exactly with
integer arithmetic where the inputs are integers."""

from __future__ import annotations

TX = """tx AS (
  SELECT l.l_orderkey AS id, l.l_linenumber AS line, CAST(l.l_shipdate AS DATE) AS date,
         CAST(isoyear(l.l_shipdate) * 100 + week(l.l_shipdate) AS INTEGER) AS week,
         l.l_partkey AS product_id, o.o_custkey AS customer_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

DIRTY_TX = TX + """,
dtx0 AS (
  SELECT id, line, date, week,
         CASE WHEN (id * 7 + line) % 50 = 0 THEN NULL ELSE product_id END AS product_id,
         CASE WHEN (id * 7 + line) % 41 = 0 THEN NULL ELSE customer_id END AS customer_id
  FROM tx),
dtx AS (SELECT * FROM dtx0 UNION ALL SELECT * FROM dtx0 WHERE id % 20 = 0)"""

MASTER = """master AS (SELECT p_partkey AS product_id, p_name AS product_name FROM part)"""

DIRTY_MASTER = MASTER + """,
dmaster AS (
  SELECT CASE WHEN product_id % 97 = 0 THEN NULL ELSE product_id END AS product_id, product_name
  FROM master
  UNION ALL SELECT product_id, product_name FROM master WHERE product_id % 89 = 0)"""


def features_cte(src: str, name: str, master: str) -> str:
    """Clean (non-null product, distinct rows) -> roll-up -> master join."""
    return f"""{name}_agg AS (
  SELECT product_id, count(*) AS volume, count(DISTINCT id) AS order_frequency,
         count(DISTINCT customer_id) AS unique_customers
  FROM (SELECT DISTINCT * FROM {src} WHERE product_id IS NOT NULL) t
  GROUP BY product_id),
{name}_raw AS (
  SELECT product_id, volume, order_frequency, unique_customers,
         CASE WHEN unique_customers = 0 THEN NULL
              ELSE ((200 * volume + unique_customers) // (2 * unique_customers)) / 100.0::DOUBLE
         END AS concentration
  FROM {name}_agg),
{name} AS (
  SELECT f.product_id, m.product_name, f.volume, f.order_frequency, f.unique_customers, f.concentration
  FROM {name}_raw f JOIN {master} m ON f.product_id = m.product_id
  WHERE m.product_id IS NOT NULL)"""


CLEAN_FEATURES = "WITH " + TX + ",\n" + MASTER + ",\n" + features_cte("tx", "feat", "master")
DIRTY_FEATURES = "WITH " + DIRTY_TX + ",\n" + DIRTY_MASTER + ",\n" + features_cte("dtx", "feat", "dmaster")

FEATS = ("volume", "order_frequency", "unique_customers", "concentration")


def _describe_sql(median: bool) -> str:
    parts = []
    for f in FEATS:
        med = f", round(median({f}::DOUBLE), 6) + 0.0 AS median" if median else ""
        parts.append(f"""SELECT '{f}' AS feature, count({f}) AS n, round(avg({f}::DOUBLE), 6) + 0.0 AS mean,
       round(stddev_samp({f}::DOUBLE), 6) + 0.0 AS stddev, min({f}::DOUBLE) AS min, max({f}::DOUBLE) AS max{med}
FROM feat""")
    return CLEAN_FEATURES + "\n" + "\nUNION ALL\n".join(parts)


def _corr_sql() -> str:
    parts = [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}::DOUBLE, {b}::DOUBLE), 6) + 0.0 AS corr FROM feat"
             for a in FEATS for b in FEATS]
    return CLEAN_FEATURES + "\n" + "\nUNION ALL\n".join(parts)


def _hist_sql(bins: int = 50) -> str:
    rng = ",\n".join(f"min({f})::DOUBLE AS {f}_lo, max({f})::DOUBLE AS {f}_hi" for f in FEATS)
    longs = "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, {f}::DOUBLE AS x, {f}_lo AS lo, {f}_hi AS hi FROM feat, rng" for f in FEATS)
    ranges = "\nUNION ALL\n".join(f"SELECT '{f}' AS feature, {f}_lo AS lo, {f}_hi AS hi FROM rng" for f in FEATS)
    return CLEAN_FEATURES + f""",
rng AS (SELECT {rng} FROM feat),
lng AS ({longs}),
adj AS (SELECT feature, x, CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END AS lo2,
               CASE WHEN hi = lo THEN hi + 0.5 ELSE hi END AS hi2 FROM lng WHERE x IS NOT NULL),
cnt AS (SELECT feature, CAST(least(floor((x - lo2) * ({float(bins)} / (hi2 - lo2))), {bins - 1}) AS INTEGER) AS bin,
               count(*) AS n FROM adj GROUP BY 1, 2),
rr AS ({ranges}),
grid AS (SELECT feature, CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END AS glo,
                CASE WHEN hi = lo THEN hi + 0.5 ELSE hi END AS ghi, b.bin
         FROM rr, (SELECT CAST(range AS INTEGER) AS bin FROM range(0, {bins})) b)
SELECT g.feature, g.bin, round(g.glo + g.bin * ((g.ghi - g.glo) / {float(bins)}), 6) AS bin_lower,
       round(CASE WHEN g.bin = {bins - 1} THEN g.ghi ELSE g.glo + (g.bin + 1) * ((g.ghi - g.glo) / {float(bins)}) END, 6) AS bin_upper,
       coalesce(c.n, 0) AS n
FROM grid g LEFT JOIN cnt c ON g.feature = c.feature AND g.bin = c.bin"""


ORACLE: dict[str, str] = {
    "a2_table_profile": "WITH " + TX + """
SELECT column_name, ordinal, data_type, (SELECT count(*) FROM tx) AS n_rows FROM (VALUES
  ('id', 1, 'bigint'), ('line', 2, 'integer'), ('date', 3, 'date'), ('week', 4, 'integer'),
  ('product_id', 5, 'bigint'), ('customer_id', 6, 'bigint')) v(column_name, ordinal, data_type)""",
    "a3_column_range": "WITH " + TX + "\nSELECT min(date) AS min_value, max(date) AS max_value FROM tx",
    "a4_role_binding": "WITH " + TX + "\nSELECT * FROM tx",
    "b1_null_key_filter": "WITH " + DIRTY_TX + "\nSELECT * FROM dtx WHERE product_id IS NOT NULL",
    "b2_cleaning_audit": "WITH " + DIRTY_TX + ",\n" + DIRTY_MASTER + """
SELECT 'products' AS table_name, count(*) AS original, count(*) FILTER (WHERE product_id IS NULL) AS removed,
       count(product_id) AS remaining FROM dmaster
UNION ALL
SELECT 'transactions', count(*), count(*) FILTER (WHERE product_id IS NULL), count(product_id) FROM dtx""",
    "b3_drop_any_null": "WITH " + DIRTY_TX + """
SELECT * FROM dtx WHERE id IS NOT NULL AND line IS NOT NULL AND date IS NOT NULL AND week IS NOT NULL
  AND product_id IS NOT NULL AND customer_id IS NOT NULL""",
    "b4_dedup": "WITH " + DIRTY_TX + "\nSELECT DISTINCT * FROM dtx WHERE product_id IS NOT NULL",
    "b5_duplicate_audit": "WITH " + DIRTY_TX + """,
g AS (SELECT id, line, date, week, product_id, customer_id, count(*) AS copies
      FROM dtx WHERE product_id IS NOT NULL GROUP BY ALL)
SELECT sum(copies)::BIGINT AS rows, count(*) AS distinct_rows, sum(copies - 1)::BIGINT AS removed FROM g""",
    "b5_master_key_audit": "WITH " + DIRTY_MASTER + """,
g AS (SELECT product_id, count(*) AS n FROM dmaster WHERE product_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
SELECT count(*) AS repeated_keys, coalesce(sum(n - 1), 0)::BIGINT AS extra_rows FROM g""",
    "b6_distinct_weeks": "WITH " + DIRTY_TX + "\nSELECT DISTINCT week FROM dtx WHERE product_id IS NOT NULL",
    "b7_null_counts": DIRTY_FEATURES + """
SELECT 'product_id' AS column_name, 1 AS ordinal, count(*) FILTER (WHERE product_id IS NULL) AS null_count FROM feat
UNION ALL SELECT 'product_name', 2, count(*) FILTER (WHERE product_name IS NULL) FROM feat
UNION ALL SELECT 'volume', 3, count(*) FILTER (WHERE volume IS NULL) FROM feat
UNION ALL SELECT 'order_frequency', 4, count(*) FILTER (WHERE order_frequency IS NULL) FROM feat
UNION ALL SELECT 'unique_customers', 5, count(*) FILTER (WHERE unique_customers IS NULL) FROM feat
UNION ALL SELECT 'concentration', 6, count(*) FILTER (WHERE concentration IS NULL) FROM feat""",
    "c3_concentration": "WITH " + DIRTY_TX + ",\n" + MASTER + ",\n" + features_cte("dtx", "feat", "master")
    + "\nSELECT * FROM feat_raw",
    "c4_smoothed_concentration": CLEAN_FEATURES + """
SELECT product_id, volume, unique_customers,
       round(volume::DOUBLE / (unique_customers::DOUBLE + 1.0), 6) AS concentration FROM feat_agg""",
    "c5_truncated_names": "WITH " + MASTER + """
SELECT product_id, substring(repeat(concat_ws('-', product_name, CAST(product_id AS VARCHAR)), 6), 1, 50) AS product_name
FROM master""",
    "a4_timestamp_role": """
SELECT DISTINCT l_orderkey AS id, l_partkey AS product_id, l_suppkey AS customer_id, CAST(l_shipdate AS DATE) AS date, h AS hour
FROM lineitem, (VALUES (0), (9)) v(h) WHERE l_partkey IS NOT NULL""",
    "d1_volume": CLEAN_FEATURES + "\nSELECT product_id, volume FROM feat_agg",
    "d2_order_frequency": CLEAN_FEATURES + "\nSELECT product_id, order_frequency FROM feat_agg",
    "d3_unique_customers": "WITH " + DIRTY_TX + ",\n" + MASTER + ",\n" + features_cte("dtx", "feat", "master")
    + "\nSELECT product_id, unique_customers FROM feat_agg",
    "d4_product_features": CLEAN_FEATURES + "\nSELECT * FROM feat_raw",
    "d5_describe": _describe_sql(False),
    "d6_describe_median": _describe_sql(True),
    "d7_correlation": _corr_sql(),
    "d8_histogram": _hist_sql(50),
    "d9_scatter_pairs": CLEAN_FEATURES + """
SELECT 'volume:order_frequency' AS pair, volume::DOUBLE AS x, order_frequency::DOUBLE AS y, count(*) AS n FROM feat GROUP BY 1, 2, 3
UNION ALL
SELECT 'order_frequency:concentration', order_frequency::DOUBLE, concentration, count(*) FROM feat GROUP BY 1, 2, 3""",
    "e1_features_master_join": CLEAN_FEATURES + "\nSELECT * FROM feat",
    "e1_dirty_features_master_join": DIRTY_FEATURES + "\nSELECT * FROM feat",
    "f3_preview": CLEAN_FEATURES + "\nSELECT * FROM feat ORDER BY product_id LIMIT 10",
}


# ---- scaled features and fixed-center labels --------------------------------

# Fixed values, written out here so that a changed value in the library shows.
CENTERS = ((-1.0, -1.0, 0.0), (0.0, 0.0, 0.0), (1.0, 1.0, 0.0), (0.0, 0.0, 2.0))
SECOND = ((-0.5, -0.5, -0.5), (0.5, 0.5, -0.5), (0.5, 0.5, 1.5))


def _centers():
    return CENTERS


ZF = ("volume", "order_frequency", "concentration")


def scaled_cte(src: str, name: str, ddof: int = 1, stats_src: str | None = None) -> str:
    """Complete rows of ``src`` standardised by ``stats_src`` (default src)."""
    std = "stddev_samp" if ddof == 1 else "stddev_pop"
    stats_src = stats_src or f"{name}_cf"
    st = ", ".join(f"avg({f}::DOUBLE) AS m_{f}, {std}({f}::DOUBLE) AS s_{f}" for f in ZF)
    zs = ",\n       ".join(
        f"CASE WHEN coalesce(s_{f}, 0.0) = 0 THEN 0.0 ELSE ({f}::DOUBLE - m_{f}) / s_{f} END AS z_{f}" for f in ZF)
    notnull = " AND ".join(f"{f} IS NOT NULL" for f in ZF)
    return f"""{name}_cf AS (SELECT * FROM {src} WHERE {notnull}),
{name}_st AS (SELECT {st} FROM {stats_src}),
{name} AS (SELECT c.*, {zs} FROM {name}_cf c, {name}_st)"""


def _dist_sql(center) -> str:
    terms = [f"(z_{f} - ({float(v)!r})) * (z_{f} - ({float(v)!r}))" for f, v in zip(ZF, center)]
    return " + ".join(terms)


def labelled_cte(src: str, name: str, cs=None, label: str = "cluster") -> str:
    cs = cs or _centers()
    ds = ", ".join(f"round({_dist_sql(c)}, 9) AS d{i}" for i, c in enumerate(cs))
    conds = []
    for i in range(len(cs) - 1):
        conds.append("WHEN " + " AND ".join(f"d{i} <= d{j}" for j in range(i + 1, len(cs))) + f" THEN {i}")
    case = "CASE " + " ".join(conds) + f" ELSE {len(cs) - 1} END"
    dcols = ", ".join(f"d{i}" for i in range(len(cs)))
    return f"""{name}_d AS (SELECT *, {ds} FROM {src}),
{name} AS (SELECT * EXCLUDE ({dcols}), CAST({case} AS INTEGER) AS {label} FROM {name}_d)"""


LABELLED = CLEAN_FEATURES + ",\n" + scaled_cte("feat", "zs") + ",\n" + labelled_cte("zs", "lab")

PROFILE = """prof AS (
  SELECT cluster, count(*) AS products,
         sum(volume)::DOUBLE / count(*) AS mean_volume, min(volume) AS min_volume, max(volume) AS max_volume,
         sum(order_frequency)::DOUBLE / count(*) AS mean_frequency, min(order_frequency) AS min_frequency,
         max(order_frequency) AS max_frequency,
         sum(concentration::DECIMAL(18,2))::DOUBLE / count(*) AS mean_concentration,
         min(concentration) AS min_concentration, max(concentration) AS max_concentration
  FROM lab GROUP BY cluster),
med AS (SELECT median(volume::DOUBLE) AS med_volume, median(order_frequency::DOUBLE) AS med_frequency,
               median(concentration::DOUBLE) AS med_concentration FROM lab),
names AS (
  SELECT cluster, CASE
    WHEN mean_volume > med_volume AND mean_frequency > med_frequency AND mean_concentration > med_concentration
      THEN 'high_turnover_centralised'
    WHEN mean_volume > med_volume AND mean_frequency > med_frequency THEN 'high_turnover_dispersed'
    WHEN mean_volume < med_volume AND mean_frequency < med_frequency THEN 'low_turnover'
    ELSE 'medium_turnover' END AS segment
  FROM prof, med)"""

LAB_PROFILE = LABELLED + ",\n" + PROFILE


STRATEGY_VALUES = """strat AS (SELECT * FROM (VALUES
  ('high_turnover_centralised',
   'in high demand, sold mostly to few large customers',
   'easy-access zone next to loading and unloading - strategic location A1',
   'frequency: weekly or bi-weekly - volumes: large',
   'high (3-4 weeks of cover)',
   'very high (under 7 days per cycle)',
   'stock-out rate < 2% | obsolescence rate < 1%'),
  ('high_turnover_dispersed',
   'in high demand, sold to many different customers',
   'easy-access zone with frequent distribution - strategic location A2',
   'frequency: weekly - volumes: medium',
   'medium-high (2-3 weeks of cover)',
   'high (7-14 days per cycle)',
   'stock-out rate < 3% | pick/pack efficiency > 95%'),
  ('medium_turnover',
   'moderate and steady demand',
   'middle zone of the warehouse - strategic location B',
   'frequency: bi-weekly - volumes: small to medium',
   'medium (2 weeks of cover)',
   'medium (14-30 days per cycle)',
   'stock-out rate < 5% | coverage rate > 90%'),
  ('low_turnover',
   'specialised products with low or sporadic demand',
   'deep zone of the warehouse - strategic location C (back)',
   'frequency: monthly or on demand - volumes: very small',
   'low (4+ weeks of cover or on demand)',
   'low (over 30 days per cycle)',
   'obsolescence rate < 10% | storage cost minimised'))
  v(segment, description, storage, replenishment, stock_level, rotation, kpis))"""
ATTRIBUTES = ('description', 'storage', 'replenishment', 'stock_level', 'rotation', 'kpis')


def _strategies_values() -> str:
    return STRATEGY_VALUES


def _strategy_long_sql() -> str:
    parts = [f"SELECT n.cluster, upper(n.segment) AS segment, {i + 1} AS ordinal, "
             f"'{a.replace('_', ' ').upper()}' AS attribute, s.{a} AS value "
             f"FROM names n JOIN strat s ON n.segment = s.segment" for i, a in enumerate(ATTRIBUTES)]
    parts.append(f"SELECT n.cluster, upper(n.segment), 1, 'STRATEGY', 'cluster not mapped to a predefined strategy' FROM names n "
                 f"WHERE n.segment NOT IN (SELECT segment FROM strat)")
    return LAB_PROFILE + ",\n" + _strategies_values() + "\n" + "\nUNION ALL\n".join(parts)


def _short_sql() -> str:
    short = {
        'centralised': ('easy-access zone (area A1)', 'weekly/bi-weekly, large volumes', 'stock-out < 2%, obsolescence < 1%', 'high stock, few suppliers, concentrated distribution'),
        'dispersed': ('easy-access zone (area A2)', 'weekly, medium volumes', 'stock-out < 3%, pick/pack efficiency > 95%', 'high stock, several suppliers, wide distribution'),
        'low_turnover': ('deep zone (area C)', 'monthly or on demand', 'obsolescence < 10%, minimise storage cost', 'low stock, suppliers on demand, special monitoring'),
        'other': ('middle zone (area B)', 'bi-weekly', 'stock-out < 5%, coverage > 90%', 'moderate stock, flexible replenishment'),
    }

    def pick(i):
        return (f"CASE WHEN contains(segment, 'centralised') THEN '{short['centralised'][i]}' "
                f"WHEN contains(segment, 'dispersed') THEN '{short['dispersed'][i]}' "
                f"WHEN contains(segment, 'low_turnover') THEN '{short['low_turnover'][i]}' "
                f"ELSE '{short['other'][i]}' END")
    return LAB_PROFILE + f"""
SELECT cluster, segment, {pick(0)} AS storage, {pick(1)} AS replenishment, {pick(2)} AS kpis, {pick(3)} AS summary
FROM names"""


AWKWARD = """CASE product_id % 4 WHEN 0 THEN product_name || chr(10) || 'second "line", '
  WHEN 1 THEN '"' || product_name || ',"' WHEN 2 THEN '  ' || product_name ELSE product_name END AS product_name"""


def _boxplot_sql() -> str:
    longs = "\nUNION ALL\n".join(f"SELECT cluster, '{f}' AS feature, {f}::DOUBLE AS x FROM lab" for f in ZF)
    return LABELLED + f""",
lng AS ({longs}),
q AS (SELECT cluster, feature, count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM lng GROUP BY 1, 2),
w AS (SELECT q.cluster, q.feature, q.n, q.q1, q.median, q.q3,
             min(x) FILTER (WHERE x >= q.q1 - 1.5 * (q.q3 - q.q1) AND x <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_low,
             max(x) FILTER (WHERE x >= q.q1 - 1.5 * (q.q3 - q.q1) AND x <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_high,
             count(*) FILTER (WHERE NOT (x >= q.q1 - 1.5 * (q.q3 - q.q1) AND x <= q.q3 + 1.5 * (q.q3 - q.q1))) AS outliers
      FROM lng JOIN q ON lng.cluster = q.cluster AND lng.feature = q.feature
      GROUP BY 1, 2, 3, 4, 5, 6)
SELECT cluster, feature, n, round(q1, 6) + 0.0 AS q1, round(median, 6) + 0.0 AS median, round(q3, 6) + 0.0 AS q3,
       round(whisker_low, 6) + 0.0 AS whisker_low, round(whisker_high, 6) + 0.0 AS whisker_high, outliers FROM w"""


def _silhouette_ctes(lab: str, label: str, p: str) -> str:
    """CTE ``{p}sil`` with one value: the squared silhouette of ``lab``."""
    zsq = " + ".join(f"z_{f} * z_{f}" for f in ZF)
    dot = " + ".join(f"p.z_{f} * s.y_{f}" for f in ZF)
    ys = ", ".join(f"sum(z_{f}) AS y_{f}" for f in ZF)
    return f"""{p}pts AS (SELECT product_id, {label} AS cluster, z_volume, z_order_frequency, z_concentration, {zsq} AS sq FROM {lab}),
{p}cs AS (SELECT {label} AS cluster, count(*)::DOUBLE AS n, {ys}, sum({zsq}) AS psi FROM {lab} GROUP BY {label}),
{p}pd AS (SELECT p.product_id, p.cluster AS own, s.cluster AS c, s.n,
              p.sq + s.psi / s.n - 2.0 * ({dot}) / s.n AS d
       FROM {p}pts p, {p}cs s),
{p}per AS (SELECT product_id,
               max(CASE WHEN c = own THEN d * n / (n - 1.0) END) AS a,
               max(CASE WHEN c = own THEN n END) AS own_n,
               min(CASE WHEN c <> own THEN d END) AS b
        FROM {p}pd GROUP BY product_id),
{p}each AS (SELECT CASE WHEN own_n = 1 THEN 0.0 WHEN a < b THEN 1.0 - a / b WHEN a > b THEN b / a - 1.0 ELSE 0.0 END AS s
        FROM {p}per),
{p}sil AS (SELECT CASE WHEN (SELECT count(*) FROM {p}cs) >= 2 THEN round(avg(s), 6) END AS silhouette FROM {p}each)"""


def _silhouette_sql() -> str:
    return LABELLED + ",\n" + _silhouette_ctes("lab", "cluster", "") + "\nSELECT silhouette FROM sil"


def _inertia_expr(cs) -> str:
    return "CASE cluster " + " ".join(f"WHEN {i} THEN {_dist_sql(c)}" for i, c in enumerate(cs)) + " END"


def _fixed_sweep_cte() -> str:
    """CTE ``sweep`` (k, inertia, silhouette) of the first 2, 3 and 4 centers."""
    parts, rows = [], []
    for k in (2, 3, 4):
        cs = CENTERS[:k]
        parts += [labelled_cte("zs", f"lab{k}", cs), _silhouette_ctes(f"lab{k}", "cluster", f"s{k}")]
        rows.append(f"SELECT {k} AS k, round(sum({_inertia_expr(cs)}), 6) AS inertia, "
                    f"(SELECT silhouette FROM s{k}sil) AS silhouette FROM lab{k}")
    return (CLEAN_FEATURES + ",\n" + scaled_cte("feat", "zs") + ",\n" + ",\n".join(parts)
            + ",\nsweep AS (" + "\nUNION ALL\n".join(rows) + ")")


def _two_models_cte() -> str:
    """CTEs ``two`` (both labels) and ``sc`` (a, b: both silhouettes)."""
    return (LAB_PROFILE + ",\n" + labelled_cte("lab", "two", SECOND, "cluster_gmm") + ",\n"
            + _silhouette_ctes("lab", "cluster", "a") + ",\n" + _silhouette_ctes("two", "cluster_gmm", "b")
            + ",\nsc AS (SELECT (SELECT silhouette FROM asil) AS a, (SELECT silhouette FROM bsil) AS b)")


def _inertia_sql() -> str:
    cs = _centers()
    case = "CASE cluster " + " ".join(f"WHEN {i} THEN {_dist_sql(c)}" for i, c in enumerate(cs)) + " END"
    return LABELLED + f"\nSELECT {len(cs)} AS k, round(sum({case}), 6) AS inertia FROM lab"


def _transitions_cte(cut: str) -> str:
    before = features_cte("txb", "fb", "master")
    after = features_cte("txa", "fa", "master")
    return ("WITH " + TX + ",\n" + MASTER + f""",
txb AS (SELECT * FROM tx WHERE date < DATE '{cut}'),
txa AS (SELECT * FROM tx WHERE date >= DATE '{cut}'),
""" + before + ",\n" + after + ",\n" + scaled_cte("fb", "zb") + ",\n"
            + scaled_cte("fa", "za", stats_src="zb_cf") + ",\n" + labelled_cte("zb", "lb") + ",\n"
            + labelled_cte("za", "la") + """,
tr AS (SELECT coalesce(b.product_id, a.product_id) AS product_id, b.cluster AS cluster_before,
              a.cluster AS cluster_after
       FROM lb b FULL OUTER JOIN la a ON b.product_id = a.product_id)""")


ORACLE.update({
    "g1_assemble": CLEAN_FEATURES + """
SELECT product_id, volume::DOUBLE AS f_volume, order_frequency::DOUBLE AS f_order_frequency,
       concentration AS f_concentration FROM feat WHERE concentration IS NOT NULL""",
    "g1_assemble_audit": DIRTY_FEATURES + """
SELECT count(*) FILTER (WHERE volume IS NOT NULL AND order_frequency IS NOT NULL AND concentration IS NOT NULL) AS kept,
       count(*) FILTER (WHERE NOT (volume IS NOT NULL AND order_frequency IS NOT NULL AND concentration IS NOT NULL)) AS dropped
FROM feat""",
    "g2_standardise": CLEAN_FEATURES + ",\n" + scaled_cte("feat", "zs") + """
SELECT product_id, round(z_volume, 6) AS z_volume, round(z_order_frequency, 6) AS z_order_frequency,
       round(z_concentration, 6) AS z_concentration FROM zs""",
    "g2b_standardise_population": CLEAN_FEATURES + ",\n" + scaled_cte("feat", "zs", ddof=0) + """
SELECT product_id, round(z_volume, 6) AS z_volume, round(z_order_frequency, 6) AS z_order_frequency,
       round(z_concentration, 6) AS z_concentration FROM zs""",
    "g3_scaling_audit": CLEAN_FEATURES + ",\n" + scaled_cte("feat", "zs", ddof=0) + "\n" + "\nUNION ALL\n".join(
        f"SELECT 'z_{f}' AS feature, round(avg(z_{f}), 6) + 0.0 AS mean, round(stddev_pop(z_{f}), 6) + 0.0 AS std FROM zs"
        for f in ZF),
    "g5_inertia_fixed": _inertia_sql(),
    "g6_silhouette_fixed": _silhouette_sql(),
    "fixed_labels": LABELLED + "\nSELECT product_id, cluster FROM lab",
    "d10_cluster_sizes": LABELLED + "\nSELECT cluster, count(*) AS products FROM lab GROUP BY cluster",
    "d11_boxplot": _boxplot_sql(),
    "d12_cluster_bars": LABELLED + f"""
SELECT CAST(b.range AS INTEGER) AS cluster, coalesce(s.products, 0) AS products
FROM range(0, {len(_centers())}) b
LEFT JOIN (SELECT cluster, count(*) AS products FROM lab GROUP BY cluster) s ON s.cluster = b.range""",
    "d13_labelled_scatter_2d": LAB_PROFILE + """,
lng AS (SELECT cluster, 'volume:order_frequency' AS pair, volume::DOUBLE AS x, order_frequency::DOUBLE AS y FROM lab
        UNION ALL
        SELECT cluster, 'order_frequency:concentration', order_frequency::DOUBLE, concentration FROM lab)
SELECT g.cluster, coalesce(n.segment, 'undefined') AS segment, g.pair, g.x, g.y, g.products
FROM (SELECT cluster, pair, x, y, count(*) AS products FROM lng GROUP BY ALL) g
LEFT JOIN names n ON g.cluster = n.cluster""",
    "d14_labelled_scatter_3d": LAB_PROFILE + """
SELECT g.cluster, coalesce(n.segment, 'undefined') AS segment, g.volume, g.order_frequency, g.concentration, g.products
FROM (SELECT cluster, volume, order_frequency, concentration, count(*) AS products FROM lab GROUP BY ALL) g
LEFT JOIN names n ON g.cluster = n.cluster""",
    "e3_strategy_lookup": LAB_PROFILE + ",\n" + _strategies_values() + """
SELECT n.cluster, n.segment, s.description, s.storage, s.replenishment, s.stock_level, s.rotation, s.kpis
FROM names n LEFT JOIN strat s ON n.segment = s.segment""",
    "e4_names_to_products": LAB_PROFILE + """
SELECT l.product_id, l.cluster, coalesce(n.segment, 'undefined') AS segment
FROM lab l LEFT JOIN names n ON l.cluster = n.cluster""",
    "e5_cluster_vs_medians": LAB_PROFILE + """
SELECT cluster, round(mean_volume, 6) + 0.0 AS mean_volume, round(mean_frequency, 6) + 0.0 AS mean_frequency,
       round(mean_concentration, 6) + 0.0 AS mean_concentration, round(med_volume, 6) + 0.0 AS median_volume,
       round(med_frequency, 6) + 0.0 AS median_frequency, round(med_concentration, 6) + 0.0 AS median_concentration,
       mean_volume > med_volume AS volume_above, mean_frequency > med_frequency AS frequency_above,
       mean_concentration > med_concentration AS concentration_above
FROM prof, med""",
    "f1_order_by_cluster": LABELLED + "\nSELECT DISTINCT cluster FROM lab ORDER BY cluster",
    "f2_top_products": LABELLED + """
SELECT cluster, CAST(rank AS INTEGER) AS rank, product_id, substring(product_name, 1, 50) AS product_name,
       volume, order_frequency FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY volume DESC, product_id ASC) AS rank FROM lab) t
WHERE rank <= 5""",
    "h1_cluster_profile": LAB_PROFILE + "\nSELECT * FROM prof",
    "h2_segment_names": LAB_PROFILE + "\nSELECT * FROM names",
    "h3_segment_summary": LAB_PROFILE + """,
sums AS (SELECT cluster, count(*) AS products, sum(volume) AS sv, sum(order_frequency) AS sf,
                sum(CAST(round(concentration * 100) AS BIGINT)) AS sc FROM lab GROUP BY cluster)
SELECT s.cluster, coalesce(n.segment, 'undefined') AS segment, s.products,
       ((20 * s.sv + s.products) // (2 * s.products))::DOUBLE / 10.0 AS mean_volume,
       ((20 * s.sf + s.products) // (2 * s.products))::DOUBLE / 10.0 AS mean_frequency,
       (((2 * s.sc + s.products) // (2 * s.products))::DOUBLE / 1.0) / 100.0 AS mean_concentration
FROM sums s LEFT JOIN names n ON s.cluster = n.cluster""",
    "h4_strategy_report": _strategy_long_sql(),
    "h4b_short_strategy": _short_sql(),
    "a1_csv_roundtrip": CLEAN_FEATURES + f"\nSELECT * REPLACE ({AWKWARD}) FROM feat",
    "a5_export_csv": LAB_PROFILE + """
SELECT l.product_id, l.product_name, l.volume, l.order_frequency, l.unique_customers, l.concentration,
       l.cluster, n.segment
FROM (SELECT * REPLACE (""" + AWKWARD + """) FROM lab) l LEFT JOIN names n ON l.cluster = n.cluster""",
    "a6_export_manifest": LABELLED + """
SELECT column_name, ordinal, (SELECT count(*) FROM lab) AS n_rows FROM (VALUES
  ('product_id', 1), ('product_name', 2), ('volume', 3), ('order_frequency', 4), ('unique_customers', 5),
  ('concentration', 6), ('cluster', 7), ('segment', 8)) v(column_name, ordinal)""",
    "x1_history_coverage": "WITH " + TX + """
SELECT count(DISTINCT week) AS weeks, min(week) AS first_week, max(week) AS last_week, 12 AS min_weeks,
       count(DISTINCT week) >= 12 AS sufficient FROM tx WHERE product_id IS NOT NULL""",
    "x2_segment_transitions": _transitions_cte("1998-07-01") + """
SELECT cluster_before, cluster_after, count(*) AS products FROM tr GROUP BY 1, 2""",
    "x3_transition_alerts": _transitions_cte("1998-07-01") + """
SELECT product_id, cluster_before, cluster_after,
       CASE WHEN cluster_before IS NULL THEN 'appeared' WHEN cluster_after IS NULL THEN 'vanished'
            ELSE 'changed' END AS change
FROM tr WHERE cluster_before IS DISTINCT FROM cluster_after""",
})

ORACLE["x3_stream_transition_alerts"] = ORACLE["x3_transition_alerts"]

ORACLE["g4_lloyd_step_fixed"] = LABELLED + "\n" + "\nUNION ALL\n".join(
    f"SELECT cluster, 'z_{f}' AS feature, round(avg(z_{f}), 6) + 0.0 AS center, count(*) AS members "
    f"FROM lab GROUP BY cluster" for f in ZF)

ORACLE["a2_preview_transactions"] = ("WITH " + TX + "\nSELECT * FROM tx "
                                     "ORDER BY id, line, date, week, product_id, customer_id LIMIT 5")

ORACLE["f4_best_of_fixed_sweep"] = _fixed_sweep_cte() + """
SELECT * FROM (SELECT k, inertia, silhouette, 'silhouette' AS choice FROM sweep ORDER BY silhouette DESC, k LIMIT 1)
UNION ALL
SELECT * FROM (SELECT k, inertia, silhouette, 'inertia' AS choice FROM sweep ORDER BY inertia, k LIMIT 1)"""

ORACLE["g12_bic_fixed"] = LABELLED + """,
n AS (SELECT count(*)::DOUBLE AS n FROM lab),
s AS (SELECT CAST(range AS INTEGER) AS k, -n / range AS ll, CAST((range - 1) + range * 3 + range * 6 AS BIGINT) AS parameters, n
      FROM n, range(2, 11))
SELECT k, round(ll, 6) AS log_likelihood, parameters, round(-2.0 * ll + parameters * ln(n), 6) AS bic FROM s"""

ORACLE["g16_comparison_fixed"] = _two_models_cte() + """,
cases AS (SELECT 'as scored' AS "case", a AS silhouette_kmeans, b AS silhouette_gmm FROM sc
          UNION ALL SELECT 'swapped', b, a FROM sc UNION ALL SELECT 'tie', a, a FROM sc
          UNION ALL SELECT 'first missing', NULL, b FROM sc UNION ALL SELECT 'second missing', a, NULL FROM sc)
SELECT *, CASE WHEN silhouette_gmm IS NULL AND silhouette_kmeans IS NOT NULL THEN 'K-means'
               WHEN silhouette_kmeans > silhouette_gmm THEN 'K-means' ELSE 'GMM' END AS recommended FROM cases"""

ORACLE["e2_two_labellings_fixed"] = _two_models_cte() + """
SELECT product_id, cluster AS cluster_kmeans, cluster_gmm FROM two"""

ORACLE["h5_executive_fixed"] = _two_models_cte() + f""",
ine AS (SELECT round(sum({_inertia_expr(CENTERS)}), 6) AS inertia FROM lab)
SELECT CASE WHEN a > b THEN 'K-means' ELSE 'GMM' END AS recommended_model, 4 AS k_kmeans, a AS silhouette_kmeans,
       inertia AS inertia_kmeans, 3 AS k_gmm, b AS silhouette_gmm, CAST(NULL AS DOUBLE) AS bic_gmm,
       prof.cluster, coalesce(segment, 'undefined') AS segment, products
FROM prof LEFT JOIN names ON prof.cluster = names.cluster, sc, ine"""

ORACLE["h6_final_table_fixed"] = _two_models_cte() + """
SELECT product_id, product_name, volume, order_frequency, unique_customers, concentration,
       two.cluster AS cluster_kmeans, cluster_gmm, coalesce(segment, 'undefined') AS segment
FROM two LEFT JOIN names ON two.cluster = names.cluster"""

ORACLE["h1_smoothed_profile"] = LABELLED + """,
sm AS (SELECT cluster, volume / (unique_customers + 1.0::DOUBLE) AS c FROM lab)
SELECT cluster, count(*) AS products, round(avg(c), 6) AS mean_concentration, round(min(c), 6) AS min_concentration,
       round(max(c), 6) AS max_concentration FROM sm GROUP BY cluster"""

# ---- G6b, certificates, matching of two fits ----------------------------------------

_APART = " + ".join(f"(s.z_{f} - l.z_{f}) * (s.z_{f} - l.z_{f})" for f in ZF)
ORACLE["g6b_silhouette_sampled"] = LABELLED + f""",
pick AS (SELECT * FROM lab ORDER BY md5(CAST(product_id AS VARCHAR) || ':42'), product_id LIMIT 1000),
by_cluster AS (SELECT s.product_id AS i, s.cluster AS own, l.cluster AS c, sum(sqrt({_APART})) AS s, count(*) AS n
               FROM pick s, lab l GROUP BY 1, 2, 3),
ab AS (SELECT i, max(CASE WHEN c = own AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN c <> own THEN s / n END) AS b,
              sum(n) AS points FROM by_cluster GROUP BY i),
each AS (SELECT CASE WHEN b IS NULL THEN NULL WHEN a IS NULL THEN 0.0 WHEN a < b THEN 1.0 - a / b
                     WHEN a > b THEN b / a - 1.0 ELSE 0.0 END AS s, points FROM ab)
SELECT round(avg(s), 6) + 0.0 AS silhouette,
       round(coalesce(stddev_samp(s), 0.0) * sqrt((1.0 - count(*)::DOUBLE / max(points)) / count(*)), 6) + 0.0 AS standard_error,
       count(*) AS sampled, CAST(max(points) AS BIGINT) AS points FROM each"""

# what every certified fit must say, whatever its numbers
_PRODUCTS = CLEAN_FEATURES + """,
n AS (SELECT count(*) AS products FROM feat WHERE volume IS NOT NULL AND order_frequency IS NOT NULL AND concentration IS NOT NULL)"""
_KMEANS_TRUE = "true AS nearest, true AS centers_are_means, true AS inertia_matches, true AS sizes_match, true AS unscaled_matches"
_GMM_TRUE = ("true AS memberships_match, true AS labels_match, true AS likelihood_rises, true AS step_gains, true AS settled, true AS sizes_match, "
             "true AS weights_sum_to_one, true AS bic_matches")


def _certificates(ks: str, count: str, claims: str) -> str:
    return _PRODUCTS + f"\nSELECT CAST(k AS BIGINT) AS k, 42::BIGINT AS seed, products, CAST(k AS BIGINT) AS {count}, {claims} FROM n, {ks} t(k)"


ORACLE["g4_kmeans_certificate"] = _certificates("(VALUES (4))", "clusters", _KMEANS_TRUE)
ORACLE["g7_kmeans_sweep_certificates"] = _certificates("range(2, 11)", "clusters", _KMEANS_TRUE)
ORACLE["g11_gmm_certificate"] = _certificates("(VALUES (3))", "components", _GMM_TRUE)
ORACLE["g13_gmm_sweep_certificates"] = _certificates("range(2, 11)", "components", _GMM_TRUE)
for _name in ("g8_choice_certificate", "g14_choice_certificate"):
    ORACLE[_name] = "SELECT CAST(k AS BIGINT) AS k, true AS silhouette_matches, true AS choice_is_best FROM range(2, 11) t(k)"
ORACLE["g9_final_kmeans_certificate"] = _PRODUCTS + f"\nSELECT 42::BIGINT AS seed, products, {_KMEANS_TRUE}, true AS k_is_chosen FROM n"
ORACLE["g15_final_gmm_certificate"] = _PRODUCTS + f"\nSELECT 42::BIGINT AS seed, products, {_GMM_TRUE}, true AS k_is_chosen FROM n"
ORACLE["g10_restart_certificates"] = _PRODUCTS + """
SELECT model, CAST(42 + i AS BIGINT) AS seed, products, true AS certified, true AS not_better_than_chosen
FROM n, (VALUES ('K-means'), ('GMM')) m(model), range(10) r(i)"""

REFIT = ((0.1, 0.1, 1.8), (-0.9, -0.9, 0.1), (1.2, 1.1, 0.0), (0.1, 0.0, 0.1))


def _refit_cte(cut: str) -> str:
    """CTEs ``tr`` (both labels), ``ov`` (their counts) and ``best``: of all
    one-to-one matchings of four labels the one that keeps most products
    (then the least list), tried one by one."""
    total = " + ".join(f"coalesce((SELECT products FROM ov WHERE cluster_before = {i} AND cluster_after = p{i}), 0)" for i in range(4))
    return ("WITH " + TX + ",\n" + MASTER + f""",
txb AS (SELECT * FROM tx WHERE date < DATE '{cut}'),
txa AS (SELECT * FROM tx WHERE date >= DATE '{cut}'),
""" + features_cte("txb", "fb", "master") + ",\n" + features_cte("txa", "fa", "master") + ",\n" + scaled_cte("fb", "zb") + ",\n"
            + scaled_cte("fa", "za") + ",\n" + labelled_cte("zb", "lb") + ",\n" + labelled_cte("za", "la", REFIT) + f""",
tr AS (SELECT coalesce(b.product_id, a.product_id) AS product_id, b.cluster AS cluster_before, a.cluster AS cluster_after
       FROM lb b FULL OUTER JOIN la a ON b.product_id = a.product_id),
ov AS (SELECT cluster_before, cluster_after, count(*) AS products FROM tr
       WHERE cluster_before IS NOT NULL AND cluster_after IS NOT NULL GROUP BY 1, 2),
best AS (SELECT * FROM (SELECT p0, p1, p2, p3, {total} AS kept
         FROM range(4) a(p0), range(4) b(p1), range(4) c(p2), range(4) d(p3)
         WHERE p0 <> p1 AND p0 <> p2 AND p0 <> p3 AND p1 <> p2 AND p1 <> p3 AND p2 <> p3)
         ORDER BY kept DESC, p0, p1, p2, p3 LIMIT 1),
one AS (SELECT 0 AS old, p0 AS new FROM best UNION ALL SELECT 1, p1 FROM best UNION ALL SELECT 2, p2 FROM best
        UNION ALL SELECT 3, p3 FROM best),
same AS (SELECT old, new FROM one JOIN ov ON cluster_before = old AND cluster_after = new),
named AS (SELECT new, old FROM same UNION ALL
          SELECT new, 3 + row_number() OVER (ORDER BY new) FROM range(4) r(new) WHERE new NOT IN (SELECT new FROM same))""")


ORACLE["x2_segment_matching"] = _refit_cte("1998-07-01") + """
SELECT cluster_before, cluster_after, products, EXISTS (SELECT 1 FROM same WHERE old = cluster_before AND new = cluster_after) AS continues
FROM ov"""
ORACLE["x3_matched_alerts"] = _refit_cte("1998-07-01") + """
SELECT product_id, cluster_before, CAST(old AS INTEGER) AS cluster_after,
       CASE WHEN cluster_before IS NULL THEN 'appeared' WHEN old IS NULL THEN 'vanished' ELSE 'changed' END AS change
FROM tr LEFT JOIN named ON new = cluster_after WHERE cluster_before IS DISTINCT FROM old"""

# D13 and D14 once more, on the second labelling: the same text over table
# ``two`` and its label column
for _name, _first in (("d13_second_scatter_2d", "d13_labelled_scatter_2d"), ("d14_second_scatter_3d", "d14_labelled_scatter_3d")):
    _rest = PROFILE + ORACLE[_first][len(LAB_PROFILE):]
    ORACLE[_name] = (LABELLED + ",\n" + labelled_cte("lab", "two", SECOND, "cluster_gmm") + ",\n"
                     + _rest.replace("FROM lab", "FROM two").replace("cluster", "cluster_gmm"))

# X3 by periods of 52 weeks, under the first period's scale: all periods that
# end a week before the last transaction or earlier
ORACLE["x3_stateful_stream_alerts"] = "WITH " + TX + ",\n" + MASTER + """,
ptx AS (SELECT DISTINCT *, CAST(floor(date_diff('day', DATE '1970-01-01', date) / 364.0) AS BIGINT) AS period FROM tx WHERE product_id IS NOT NULL),
cnt AS (SELECT period, product_id, count(*) AS volume, count(DISTINCT id) AS order_frequency, count(DISTINCT customer_id) AS unique_customers
        FROM ptx GROUP BY 1, 2),
pf AS (SELECT *, ((200 * volume + unique_customers) // (2 * unique_customers)) / 100.0::DOUBLE AS concentration
       FROM cnt WHERE unique_customers > 0 AND product_id IN (SELECT product_id FROM master)),
pfirst AS (SELECT * FROM pf WHERE period = (SELECT min(period) FROM ptx)),
""" + scaled_cte("pf", "pz", stats_src="pfirst") + ",\n" + labelled_cte("pz", "pl") + """,
closed AS (SELECT max(date) - 7 AS upto FROM tx),
b AS (SELECT DISTINCT period FROM ptx),
lab2 AS (SELECT product_id, period, cluster FROM pl, closed WHERE DATE '1970-01-01' + CAST((period + 1) * 364 AS INTEGER) <= upto),
pairs AS (SELECT coalesce(y.product_id, x.product_id) AS product_id, coalesce(y.period, x.period + 1) AS period,
                 x.cluster AS cluster_before, y.cluster AS cluster_after
          FROM lab2 x FULL OUTER JOIN lab2 y ON x.product_id = y.product_id AND y.period = x.period + 1)
SELECT product_id, period, cluster_before, cluster_after,
       CASE WHEN cluster_before IS NULL THEN 'appeared' WHEN cluster_after IS NULL THEN 'vanished' ELSE 'changed' END AS change
FROM pairs, closed
WHERE cluster_before IS DISTINCT FROM cluster_after AND period > (SELECT min(period) FROM ptx)
  AND DATE '1970-01-01' + CAST((period + 1) * 364 AS INTEGER) <= upto"""

# state that arrivals merge into: the same answers as from all rows at once
for _name, _same in (("d5_merged_describe", "d5_describe"), ("d7_merged_correlation", "d7_correlation"),
                     ("g2_merged_standardise", "g2_standardise"), ("b4_incremental_dedup", "b4_dedup"),
                     ("b5_incremental_audit", "b5_duplicate_audit"), ("d4_weekly_state", "d4_product_features")):
    ORACLE[_name] = ORACLE[_same]
ORACLE["d11_sketch_quartiles"] = LABELLED + """
SELECT cluster, f AS feature, count(*) AS n, true AS q1_within, true AS median_within, true AS q3_within
FROM lab, (VALUES ('volume'), ('order_frequency'), ('concentration')) t(f) GROUP BY cluster, f"""
