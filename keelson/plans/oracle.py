"""SQL twins of the query catalogue, written for DuckDB over the same tables.

They are independent formulations (window functions, plain joins) of what
the Spark jobs compute with other plans; matching rows, names and types is
the correctness check.
"""

from __future__ import annotations

SEED = 42
SPACE = 1 << 60


def field(col: str) -> str:
    """A field with its length in front; null is ``-1:``."""
    text = f"CAST({col} AS VARCHAR)"
    return f"coalesce(CAST(length({text}) AS VARCHAR) || ':' || {text}, '-1:')"


def h(purpose: str, col: str, seed: int = SEED) -> str:
    """First 60 bits of md5(purpose/seed|field) as BIGINT (twin of ``hash60``)."""
    return f"('0x' || substr(md5('{purpose}/{seed}|' || {field(col)}), 1, 15))::BIGINT"


# Hash bound of a train share of 0.8 of (0.8 + 0.2).
TRAIN = f"{h('split train=0.8,test=0.2', 'o_orderkey')} < {round(0.8 / (0.8 + 0.2) * SPACE)}"


LINEITEM_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                 "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")

ORDERS_X3 = "(SELECT * FROM orders UNION ALL SELECT * FROM orders UNION ALL SELECT * FROM orders)"

DOCS_LABELS = ("(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
               "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")

ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _text_of(cols: list[str]) -> str:
    return " || ".join(field(c) for c in cols)


def _validate_sql(src: str, cols: list[tuple[str, str, bool]], label: str) -> str:
    """One UNION ALL branch per column: rows, missing, constant, classes."""
    parts = []
    for name, dtype, floating in cols:
        present = f"CASE WHEN isnan({name}) THEN NULL ELSE {name} END" if floating else name
        classes = (f"CAST(count(DISTINCT {name}) + max(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END) AS BIGINT)"
                   if name == label else "CAST(NULL AS BIGINT)")
        parts.append(
            f"SELECT '{name}' AS column_name, '{dtype}' AS dtype, CAST(count(*) AS BIGINT) AS n_rows, "
            f"CAST(count(*) - count({present}) AS BIGINT) AS n_missing, "
            f"(count(*) > 0 AND count({present}) = 0) AS all_missing, "
            f"coalesce(CAST(min({present}) AS VARCHAR) = CAST(max({present}) AS VARCHAR), false) AS is_constant, "
            f"{classes} AS n_label_classes FROM {src}")
    return "\nUNION ALL\n".join(parts)


def _shapes_sql(src: str, numbers: list[str], others: list[str]) -> str:
    """One branch per column: distinct share, share of the most frequent value, population skewness."""
    parts = []
    for name in numbers + others:
        skew = (f"(SELECT avg(power({name} - m, 3)) / power(s, 3) FROM {src}, "
                f"(SELECT avg({name}) AS m, nullif(stddev_pop({name}), 0) AS s FROM {src}) GROUP BY s)") if name in numbers else "0"
        parts.append(
            f"SELECT '{name}' AS column_name, CAST(sum(c) AS BIGINT) AS n_present, count(*) >= 0.95 * sum(c) AS id_like, "
            f"max(c) >= 0.95 * sum(c) AS near_constant, coalesce(abs({skew}) >= 2, false) AS skewed "
            f"FROM (SELECT {name}, count(*) AS c FROM {src} WHERE {name} IS NOT NULL GROUP BY {name})")
    return "\nUNION ALL\n".join(parts)


def _stratified() -> str:
    hk = h("stratified 0.2", "o_orderkey")
    return f"""
SELECT o_orderkey, o_orderstatus,
       CASE WHEN rn <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
FROM (SELECT o_orderkey, o_orderstatus,
             row_number() OVER (PARTITION BY o_orderstatus ORDER BY {hk}, o_orderkey) AS rn,
             count(*) OVER (PARTITION BY o_orderstatus) AS n
      FROM orders)"""

ORDERS_FIELDS = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]

# Registry derived from orders: dataset cust_<custkey>, one version per order.
DS = """(SELECT 'cust_' || CAST(o_custkey AS VARCHAR) AS name,
        CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS version,
        '/datasets/cust_' || CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) AS path,
        'run_' || CAST(o_orderkey AS VARCHAR) AS run_id, o_orderdate AS registered_at,
        o_orderkey, o_custkey, o_orderstatus
 FROM orders)"""

# One model version per order: trained on that dataset version, tested on orders v1.
MODELS = f"""(SELECT 'model_' || CAST(o_custkey AS VARCHAR) AS model_name,
        CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY registered_at, o_orderkey) AS INTEGER)
          AS model_version,
        name AS ds_name, version AS ds_version
 FROM {DS})"""

ROLES = f"""(SELECT model_name, model_version, 'featurized training data' AS role,
        ds_name AS dataset_name, ds_version AS dataset_version FROM {MODELS}
 UNION ALL
 SELECT model_name, model_version, 'featurized test data', 'orders', 1 FROM {MODELS})"""


# --- logistic regression by Newton steps ---------------------------------------
# Rows (x, y, t) with their groups; one group is one fit. The three normal
# equations of a step are solved by Cramer's rule.
STEPS = 12

TWO_ROWS = """li AS (SELECT l_orderkey, l_returnflag,
  (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS x,
  (l_discount - avg(l_discount) OVER ()) / stddev_pop(l_discount) OVER () AS y,
  CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS t FROM lineitem)"""


def _newton(points: str, fits: str) -> str:
    """CTEs up to ``fit`` (g, b0, b1, b2): ``points`` has g, x, y, t; ``fits`` has g and lam."""
    ctes = [f"pts AS ({points})", f"step0 AS (SELECT g, lam, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM ({fits}))"]
    for i in range(STEPS):
        ctes.append(f"""sum{i} AS (SELECT s.g, lam, b0, b1, b2, avg(p - t) AS g0, avg((p - t) * x) + lam * b1 AS g1,
  avg((p - t) * y) + lam * b2 AS g2, avg(w) AS a, avg(w * x) AS b, avg(w * y) AS c,
  avg(w * x * x) + lam AS d, avg(w * x * y) AS e, avg(w * y * y) + lam AS f
  FROM (SELECT q.*, p * (1 - p) AS w FROM (SELECT r.g, r.lam, r.b0, r.b1, r.b2, pts.x, pts.y, pts.t,
    1 / (1 + exp(-(r.b0 + r.b1 * pts.x + r.b2 * pts.y))) AS p FROM pts JOIN step{i} r ON pts.g = r.g) q) s
  GROUP BY s.g, lam, b0, b1, b2)""")
        ctes.append(f"""step{i + 1} AS (SELECT g, lam,
  b0 - (g0 * (d * f - e * e) - b * (g1 * f - e * g2) + c * (g1 * e - d * g2)) / det AS b0,
  b1 - (a * (g1 * f - e * g2) - g0 * (b * f - e * c) + c * (b * g2 - g1 * c)) / det AS b1,
  b2 - (a * (d * g2 - g1 * e) - b * (b * g2 - g1 * c) + g0 * (b * e - d * c)) / det AS b2
  FROM (SELECT *, a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c) AS det FROM sum{i}))""")
    return ",\n".join([*ctes, f"fit AS (SELECT g, b0, b1, b2 FROM step{STEPS})"])


FIT_TWO = f"WITH {TWO_ROWS},\n" + _newton("SELECT 0 AS g, x, y, t FROM li", "SELECT 0 AS g, 1.0 / count(*) AS lam FROM li")

COEFFICIENTS = """
SELECT 'l_quantity' AS feature, round(b1, 4) AS coefficient FROM fit
UNION ALL SELECT 'l_discount', round(b2, 4) FROM fit
UNION ALL SELECT '(intercept)', round(b0, 4) FROM fit"""

SCORES_TWO = f"""{FIT_TWO}
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n_rows,
       round(avg(1 / (1 + exp(-(b0 + b1 * x + b2 * y)))), 4) AS mean_score
FROM li, fit GROUP BY l_returnflag"""

# Candidates of the model selection: fits on all folds but one, judged on that one.
GRID_TWO = "(VALUES (0, 0.001::DOUBLE), (1, 1.0::DOUBLE)) c(candidate, lam)"
CV_TWO = f"""WITH {TWO_ROWS},
folded AS (SELECT *, CAST({h('fold 5', 'l_orderkey')} % 5 AS INTEGER) AS fold FROM li),
jobs AS (SELECT candidate * 5 + out AS g, candidate, lam, out FROM {GRID_TWO}, range(5) r(out)),
{_newton("SELECT j.g, x, y, t FROM folded JOIN jobs j ON folded.fold <> j.out", "SELECT g, lam FROM jobs")},
judged AS (SELECT j.g, t, b0 + b1 * x + b2 * y AS score FROM folded JOIN jobs j ON folded.fold = j.out JOIN fit ON fit.g = j.g),
ranked AS (SELECT g, t, rank() OVER (PARTITION BY g ORDER BY score) + (count(*) OVER (PARTITION BY g, score) - 1) / 2.0 AS r FROM judged),
auc AS (SELECT g, (sum(CASE WHEN t = 1 THEN r ELSE 0 END) - sum(t) * (sum(t) + 1) / 2) / (sum(t) * (count(*) - sum(t))) AS auc
  FROM ranked GROUP BY g),
metrics AS (SELECT j.candidate, j.lam, avg(a.auc) AS mean_auc FROM jobs j JOIN auc a ON a.g = j.g GROUP BY j.candidate, j.lam)"""
BEST_LAM = "(SELECT lam FROM metrics ORDER BY mean_auc DESC, candidate LIMIT 1)"


def _second_fit(points: str, fits: str) -> str:
    """The Newton CTEs under other names, to follow the first ones."""
    import re
    return re.sub(r"\b(pts|step\d+|sum\d+|fit)\b", r"\1_best", _newton(points, fits))


# --- the wide fits: Newton steps over thirteen weights -----------------------------
# A step's normal equations are solved by Gauss-Jordan elimination, one recursive
# query a step: ``m`` holds the rows of the system with the gradient as last column.
WIDE = ["l_quantity", "l_discount", "l_tax", "s_acctbal", "p_size", "p_retailprice"]
WIDE_NAMES = [f"{p}_{c}" for p in ("mm", "std") for c in WIDE]
WIDE_STEPS = 9
_D = 2 * len(WIDE) + 1

_KEY_HASH = (f"('0x' || substr(md5('{{purpose}}/{SEED}|' || {field('l_orderkey')} || {field('l_linenumber')}), 1, 15))::BIGINT")
WIDE_ROWS = f"""raw AS (SELECT l.l_orderkey, l.l_linenumber, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in WIDE)}, l.l_returnflag = 'R' AS label,
    {_KEY_HASH.format(purpose='split train=0.8,test=0.2')} < {round(0.8 / (0.8 + 0.2) * SPACE)} AS is_train,
    CAST({_KEY_HASH.format(purpose='fold 5')} % 5 AS INTEGER) AS fold
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN part p ON l.l_partkey = p.p_partkey)"""


def _z(alias: str = "s") -> str:
    """The scaled row as a list, constant first."""
    mm = [f"coalesce((r.{c} - {alias}.lo_{c}) / nullif({alias}.hi_{c} - {alias}.lo_{c}, 0), 0)" for c in WIDE]
    std = [f"coalesce((r.{c} - {alias}.mu_{c}) / nullif({alias}.sd_{c}, 0), 0)" for c in WIDE]
    return f"[1.0::DOUBLE, {', '.join(mm + std)}]"


_STATS = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}, avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in WIDE)


def _newton_wide(points: str, fits: str) -> str:
    """CTEs up to ``wide_fit`` (g, b): ``points`` has g, z, t; ``fits`` has g and lam (on the sum of losses)."""
    ctes = [f"wpts AS MATERIALIZED ({points})", f"w0 AS MATERIALIZED (SELECT g, lam, list_transform(range({_D}), lambda i: 0.0::DOUBLE) AS b FROM ({fits}))"]
    for i in range(WIDE_STEPS):
        rows = []
        for a in range(1, _D + 1):
            cells = [f"sum(w * z[{min(a, c)}] * z[{max(a, c)}])" + (" + any_value(lam)" if a == c else "") for c in range(1, _D + 1)]
            rows.append(f"[{', '.join(cells)}, sum((p - t) * z[{a}]) + any_value(lam * b[{a}])]")
        ctes.append(f"""n{i} AS MATERIALIZED (SELECT g, any_value(lam) AS lam, any_value(b) AS b, [{', '.join(rows)}] AS m FROM (
  SELECT q.*, p * (1 - p) AS w FROM (SELECT r.g, r.lam, r.b, z, t, 1 / (1 + exp(-list_dot_product(r.b, z))) AS p
    FROM wpts JOIN w{i} r ON wpts.g = r.g) q) GROUP BY g)""")
        ctes.append(f"""e{i}(g, lam, b, k, m) AS (SELECT g, lam, b, 1, m FROM n{i} UNION ALL
  SELECT g, lam, b, k + 1, list_transform(m, lambda row, i: CASE WHEN i = k THEN list_transform(row, lambda v: v / row[k])
    ELSE list_transform(row, lambda v, c: v - row[k] * m[k][c] / m[k][k]) END) FROM e{i} WHERE k <= {_D})""")
        ctes.append(f"w{i + 1} AS MATERIALIZED (SELECT g, lam, list_transform(b, lambda v, j: v - m[j][{_D + 1}]) AS b FROM e{i} WHERE k = {_D + 1})")
    return ",\n".join([*ctes, f"wide_fit AS (SELECT g, b FROM w{WIDE_STEPS})"])


FIT_WIDE = f"""WITH RECURSIVE {WIDE_ROWS},
stats AS (SELECT {_STATS} FROM raw WHERE is_train),
{_newton_wide(f"SELECT 0 AS g, {_z()} AS z, CASE WHEN label THEN 1.0 ELSE 0.0 END AS t FROM raw r, stats s WHERE is_train", "SELECT 0 AS g, 1.0::DOUBLE AS lam")}"""

_WIDE_COEFFICIENTS = "SELECT unnest([{names}]) AS feature, round(unnest(b), 4) AS coefficient FROM wide_fit WHERE g = {g}"
_WIDE_LABELS = ", ".join(f"'{n}'" for n in ["(intercept)", *WIDE_NAMES])

# g = candidate * 6 + the fold left out (5: none).
CV_WIDE = f"""WITH RECURSIVE {WIDE_ROWS},
jobs AS (SELECT candidate * 6 + out AS g, candidate, c, 1 / c AS lam, out FROM (VALUES (0, 1.0::DOUBLE), (1, 0.01::DOUBLE)) v(candidate, c), range(6) r(out)),
stats AS (SELECT o.out, {_STATS} FROM raw, (SELECT unnest(range(6)) AS out) o WHERE is_train AND fold <> o.out GROUP BY o.out),
{_newton_wide(f"SELECT j.g, {_z()} AS z, CASE WHEN label THEN 1.0 ELSE 0.0 END AS t FROM raw r JOIN jobs j ON r.is_train AND r.fold <> j.out JOIN stats s ON s.out = j.out", "SELECT g, lam FROM jobs")},
judged AS (SELECT j.g, label, round(list_dot_product(f.b, {_z()}), 10) AS score FROM raw r JOIN jobs j ON r.is_train AND r.fold = j.out
  JOIN stats s ON s.out = j.out JOIN wide_fit f ON f.g = j.g),
ranked AS (SELECT g, label, rank() OVER (PARTITION BY g ORDER BY score) + (count(*) OVER (PARTITION BY g, score) - 1) / 2.0 AS r FROM judged),
areas AS (SELECT g, (sum(r) FILTER (WHERE label) - count(*) FILTER (WHERE label) * (count(*) FILTER (WHERE label) + 1) / 2)
  / (count(*) FILTER (WHERE label) * count(*) FILTER (WHERE NOT label)) AS auc FROM ranked GROUP BY g),
metrics AS (SELECT j.candidate, j.c, avg(a.auc) AS mean_auc FROM jobs j JOIN areas a ON a.g = j.g GROUP BY j.candidate, j.c)"""

_CLASS_ROWS = """scored AS (SELECT v.class, v.score, l_returnflag = v.class AS own FROM lineitem,
  LATERAL (VALUES ('A', CAST(l_quantity AS DOUBLE)), ('N', CAST(l_extendedprice AS DOUBLE)), ('R', CAST(l_discount - l_tax AS DOUBLE))) v(class, score)
  WHERE l_returnflag IN ('A', 'N', 'R')),
ranked AS (SELECT class, own, rank() OVER (PARTITION BY class ORDER BY score) + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0 AS r FROM scored),
per_class AS (SELECT class, count(*) FILTER (WHERE own) AS n_rows, (count(*) FILTER (WHERE own))::DOUBLE / count(*) AS share,
  (sum(r) FILTER (WHERE own) - (count(*) FILTER (WHERE own))::DOUBLE * (count(*) FILTER (WHERE own) + 1) / 2)
  / ((count(*) FILTER (WHERE own))::DOUBLE * count(*) FILTER (WHERE NOT own)) AS auc FROM ranked GROUP BY class)"""


ORACLE: dict[str, str] = {
    "logreg_fit": f"{FIT_WIDE}\n{_WIDE_COEFFICIENTS.format(names=_WIDE_LABELS, g=0)}",
    "logreg_score": f"""{FIT_WIDE}
SELECT l_orderkey, l_linenumber, label, round(1 / (1 + exp(-list_dot_product(f.b, {_z()}))), 6) AS score
FROM raw r, stats s, wide_fit f WHERE NOT is_train""",
    "cv_metrics": f"{CV_WIDE}\nSELECT CAST(candidate AS INTEGER) AS candidate, c, round(mean_auc, 4) AS mean_auc FROM metrics",
    "cv_select": f"""{CV_WIDE}
{_WIDE_COEFFICIENTS.format(names=_WIDE_LABELS, g="(SELECT candidate * 6 + 5 FROM metrics ORDER BY mean_auc DESC, candidate LIMIT 1)")}""",
    "auc_weighted_three": f"WITH {_CLASS_ROWS}\nSELECT round(sum(share * auc) / sum(share), 9) AS auc_weighted FROM per_class",
    "auc_per_class": f"WITH {_CLASS_ROWS}\nSELECT class, n_rows, round(share, 9) AS share, round(auc, 9) AS auc FROM per_class",
    "logreg_fit_two": FIT_TWO + COEFFICIENTS,
    "logreg_score_two": SCORES_TWO,
    "model_roundtrip_two": SCORES_TWO,
    "cv_metrics_two": f"""{CV_TWO}
SELECT CAST(candidate AS INTEGER) AS candidate, lam AS reg_param, round(mean_auc, 4) AS mean_auc FROM metrics""",
    "cv_best_two": f"""{CV_TWO},
{_second_fit("SELECT 0 AS g, x, y, t FROM li", f"SELECT 0 AS g, {BEST_LAM} AS lam")}
{COEFFICIENTS.replace("FROM fit", "FROM fit_best")}""",
    "training_set": f"""
SELECT {', '.join('l.' + c.strip() for c in LINEITEM_COLS.split(','))},
       s.s_acctbal, p.p_size, p.p_retailprice, l.l_returnflag = 'R' AS label
FROM lineitem l
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey""",

    "feature_lookup": f"SELECT * FROM {DOCS_LABELS}",

    "pk_violations": """
SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows,
       (l_orderkey IS NULL OR l_linenumber IS NULL) AS has_null
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",

    "union_feature_sets": f"""
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n_rows FROM {ORDERS_X3} GROUP BY o_orderstatus""",

    "union_missing_columns": """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment, 'customer' AS source FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS VARCHAR), 'supplier' FROM supplier""",

    "project_drop": "SELECT p_partkey, p_size, p_retailprice FROM part",

    "label_features": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment AS label FROM customer",

    "head_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",

    "recode_values": """
SELECT c_custkey, CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
       WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 3 WHEN 'MACHINERY' THEN 4 END AS INTEGER) AS c_mktsegment
FROM customer""",

    "impute_mean": f"""
SELECT doc_id,
       round(coalesce(CAST(quality AS DOUBLE), avg(quality) OVER ()), 6) AS quality,
       round(coalesce(CAST(toxic AS DOUBLE), avg(toxic) OVER ()), 6) AS toxic
FROM {DOCS_LABELS}""",

    "clean_features": f"""
WITH g AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN {h('gap', 'o_orderkey', 0)} % 10 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
         o_orderdate
  FROM {ORDERS_X3})
SELECT o_orderkey, o_custkey,
       CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS INTEGER) AS o_orderstatus,
       round(coalesce(o_totalprice, avg(o_totalprice) OVER ()), 6) AS o_totalprice,
       o_orderdate
FROM g""",

    "row_id": f"""
WITH t AS (SELECT *, {_text_of(ORDERS_COLS)} AS txt FROM {ORDERS_X3})
SELECT {', '.join(ORDERS_COLS)},
       md5(txt || '#' || CAST(row_number() OVER (PARTITION BY txt) AS VARCHAR)) AS id
FROM t""",

    "row_counts": """
SELECT 'lineitem' AS frame, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'customer', count(*) FROM customer
UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'part', count(*) FROM part""",

    "shape_profile": f"""
SELECT 'feature_set_1' AS frame, CAST(count(*) AS BIGINT) AS n_rows, 6 AS n_cols FROM orders
UNION ALL SELECT 'feature_set_2', count(*), 6 FROM orders
UNION ALL SELECT 'feature_set_3', count(*), 6 FROM orders
UNION ALL SELECT 'union', count(*), 6 FROM {ORDERS_X3}""",

    "key_range": """
SELECT min(c_custkey) AS key_min, max(c_custkey) AS key_max, CAST(count(c_custkey) AS BIGINT) AS n_keys
FROM customer""",

    "class_counts": """
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem GROUP BY l_returnflag""",

    "validate_input": _validate_sql(
        f"(SELECT doc_id, n_chars, lang, quality, toxic FROM {DOCS_LABELS})",
        [("doc_id", "bigint", False), ("n_chars", "bigint", False), ("lang", "string", False),
         ("quality", "int", False), ("toxic", "int", False)], "quality"),

    "scaler_stats": """
SELECT 'p_size' AS column_name, CAST(count(p_size) AS BIGINT) AS n, round(min(p_size), 6) AS min,
       round(max(p_size), 6) AS max, round(avg(p_size), 6) AS mean, round(stddev_pop(p_size), 6) AS std
FROM part
UNION ALL
SELECT 'p_retailprice', count(p_retailprice), round(min(p_retailprice), 6), round(max(p_retailprice), 6),
       round(avg(p_retailprice), 6), round(stddev_pop(p_retailprice), 6)
FROM part""",

    # Doubles of at least one are whole multiples of 2**-52 (4503599627370496 = 2**52).
    "exact_moments": """
SELECT 'l_quantity' AS column_name, CAST(count(l_quantity) AS BIGINT) AS n,
       CAST(sum(CAST(l_quantity * 4503599627370496 AS HUGEINT)) AS VARCHAR) AS total_units,
       round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std
FROM lineitem
UNION ALL
SELECT 'l_extendedprice', count(l_extendedprice), CAST(sum(CAST(l_extendedprice * 4503599627370496 AS HUGEINT)) AS VARCHAR),
       round(avg(l_extendedprice), 6), round(stddev_pop(l_extendedprice), 6)
FROM lineitem""",

    "impute_mean_exact": f"""
SELECT doc_id,
       round(coalesce(CAST(quality AS DOUBLE), avg(quality) OVER ()), 6) AS quality,
       round(coalesce(CAST(toxic AS DOUBLE), avg(toxic) OVER ()), 6) AS toxic
FROM {DOCS_LABELS}""",

    "column_shapes": _shapes_sql(
        "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        ["l_returnflag", "l_linestatus", "l_shipdate"]),

    "column_shapes_documents": _shapes_sql(DOCS_LABELS, ["doc_id", "n_chars", "quality", "toxic"], ["lang"]),

    "feature_lookup_bucketed": """
SELECT l_orderkey, l_linenumber, l_partkey, p_size, p_retailprice
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",

    "minmax_scale": """
SELECT p_partkey,
  round(coalesce((p_size - min(p_size) OVER ()) / nullif(max(p_size) OVER () - min(p_size) OVER (), 0), 0), 6) AS p_size,
  round(coalesce((p_retailprice - min(p_retailprice) OVER ())
        / nullif(max(p_retailprice) OVER () - min(p_retailprice) OVER (), 0), 0), 6) AS p_retailprice
FROM part""",

    "standard_scale": """
SELECT p_partkey,
  round(coalesce((p_size - avg(p_size) OVER ()) / nullif(stddev_pop(p_size) OVER (), 0), 0), 6) AS p_size,
  round(coalesce((p_retailprice - avg(p_retailprice) OVER ()) / nullif(stddev_pop(p_retailprice) OVER (), 0), 0), 6)
    AS p_retailprice
FROM part""",

    "scaled_feature_matrix": """
SELECT
  round(coalesce((p_size - min(p_size) OVER ()) / nullif(max(p_size) OVER () - min(p_size) OVER (), 0), 0), 6)
    AS mm_p_size,
  round(coalesce((p_retailprice - min(p_retailprice) OVER ())
        / nullif(max(p_retailprice) OVER () - min(p_retailprice) OVER (), 0), 0), 6) AS mm_p_retailprice,
  round(coalesce((p_size - avg(p_size) OVER ()) / nullif(stddev_pop(p_size) OVER (), 0), 0), 6) AS std_p_size,
  round(coalesce((p_retailprice - avg(p_retailprice) OVER ()) / nullif(stddev_pop(p_retailprice) OVER (), 0), 0), 6)
    AS std_p_retailprice,
  p_partkey
FROM part""",

    "scale_with_train_stats": f"""
WITH o AS (SELECT o_orderkey, o_totalprice, {TRAIN} AS is_train FROM orders),
st AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi, avg(o_totalprice) AS mu,
              stddev_pop(o_totalprice) AS sd FROM o WHERE is_train)
SELECT o_orderkey, CASE WHEN is_train THEN 'train' ELSE 'test' END AS split,
       round(coalesce((o_totalprice - lo) / nullif(hi - lo, 0), 0), 6) AS mm_o_totalprice,
       round(coalesce((o_totalprice - mu) / nullif(sd, 0), 0), 6) AS std_o_totalprice
FROM o, st""",

    "stratified_split": _stratified(),

    "hash_split": f"""
SELECT o_orderkey, CASE WHEN {TRAIN} THEN 'train' ELSE 'test' END AS split
FROM orders""",

    "kfold_assign": f"SELECT o_orderkey, CAST({h('fold 5', 'o_orderkey')} % 5 AS INTEGER) AS fold FROM orders",

    "relative_path": """
SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN split_part(url, '://', 2) END AS rel_path FROM pages""",

    "format_timestamp": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events",

    "scan_parquet": "SELECT * FROM lineitem",
    "scan_csv": "SELECT * FROM orders",
    "csv_typed_rows": f"""
SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_day
FROM orders WHERE {h('dirty', 'o_orderkey', 0)} % 50 NOT IN (1, 2, 3)""",
    "csv_rejects": f"""
SELECT o_orderkey, CASE d WHEN 3 THEN 'fields' ELSE 'type' END AS reason,
       CASE d WHEN 1 THEN 'o_totalprice' WHEN 2 THEN 'o_day' END AS bad_column
FROM (SELECT o_orderkey, {h('dirty', 'o_orderkey', 0)} % 50 AS d FROM orders) WHERE d IN (1, 2, 3)""",
    "csv_column_types": f"""
WITH d AS (SELECT o_orderkey, o_orderstatus, {h('dirty', 'o_orderkey', 0)} % 50 AS d FROM orders),
g AS (SELECT max(o_orderkey) AS top, bool_or(d = 1) AS price, bool_or(d = 2) AS day FROM d WHERE d <> 3)
SELECT v.* FROM g, LATERAL (VALUES ('o_orderkey', 0, CASE WHEN top < 2147483648 THEN 'int' ELSE 'bigint' END),
  ('o_totalprice', 1, CASE WHEN price THEN 'string' ELSE 'double' END), ('o_orderstatus', 2, 'string'),
  ('o_day', 3, CASE WHEN day THEN 'string' ELSE 'date' END)) v("column", "position", "type")""",
    "sink_parquet_roundtrip": "SELECT * FROM orders",
    "sink_overwrite_schema": "SELECT *, c_nationkey + 1 AS nation_code FROM customer",
    "split_write_pair": _stratified(),
    "scan_table": "SELECT * FROM customer",
    "table_ddl": "SELECT * FROM nation",
    "table_append": "SELECT * FROM customer UNION ALL SELECT * FROM customer",
    "feature_table_write": """
SELECT p_partkey, p_size, p_retailprice, round(p_retailprice / p_size, 6) AS p_price_per_size FROM part""",
    "feature_table_append": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_size, p.p_retailprice
FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "feature_table_register": """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, s.s_acctbal, s.s_nationkey
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "values_source": """
SELECT c_custkey, v.segment_code
FROM customer LEFT JOIN (VALUES ('AUTOMOBILE', 0), ('BUILDING', 1), ('FURNITURE', 2), ('HOUSEHOLD', 3),
                                ('MACHINERY', 4)) v(segment, segment_code)
  ON c_mktsegment = v.segment""",
    "synth_table": f"""
SELECT c_custkey AS id,
       CAST(20 + {h('column age', 'c_custkey')} % 81 AS INTEGER) AS age,
       CAST(10000 * (1 + {h('column salary', 'c_custkey')} % 19) AS INTEGER) AS salary
FROM customer""",
    "synth_ground_truth": f"""
SELECT o_orderkey AS gt_id,
       CAST(c.lo + {h('column customer', 'o_orderkey')} % (c.hi - c.lo + 1) AS INTEGER) AS customer,
       CAST(s.lo + {h('column network', 'o_orderkey')} % (s.hi - s.lo + 1) AS INTEGER) AS network,
       {h('column label', 'o_orderkey')} % 2 = 1 AS label
FROM orders,
     (SELECT min(c_custkey) AS lo, max(c_custkey) AS hi FROM customer) c,
     (SELECT min(s_suppkey) AS lo, max(s_suppkey) AS hi FROM supplier) s""",
    "register_versions": f"SELECT name, version, run_id, registered_at FROM {DS}",
    "latest_version": f"""
SELECT name, max(version) AS latest_version, arg_max(path, version) AS path, 'parquet' AS format,
       arg_max(registered_at, version) AS registered_at
FROM {DS} GROUP BY name""",
    "lineage_inputs": f"""
SELECT name, version, 'orders' AS input_name, 1 AS input_version, 'orders: 1' AS input_text FROM {DS}
UNION ALL
SELECT name, version, name, version - 1, name || ': ' || CAST(version - 1 AS VARCHAR) FROM {DS} WHERE version > 1""",
    "schema_fields": f"""
SELECT d.name, d.version, f.position, f.field_name, f.field_type
FROM {DS} d CROSS JOIN (VALUES {", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(ORDERS_FIELDS))})
     f(position, field_name, field_type)""",
    "model_datasets": f"""
SELECT r.model_name, r.model_version, r.role, r.dataset_name, r.dataset_version,
       d.path AS dataset_path, d.run_id AS dataset_run_id
FROM {ROLES} r LEFT JOIN {DS} d ON r.dataset_name = d.name AND r.dataset_version = d.version""",
    "dataset_models": f"""
SELECT d.name AS dataset_name, d.version AS dataset_version, r.model_name, r.model_version, r.role
FROM {DS} d JOIN {ROLES} r ON r.dataset_name = d.name AND r.dataset_version = d.version""",
    "model_lineage": f"""
WITH ins AS (
  SELECT name, version, 'orders' AS input_name, 1 AS input_version FROM {DS}
  UNION ALL SELECT name, version, name, version - 1 FROM {DS} WHERE version > 1)
SELECT r.model_name, r.model_version, r.dataset_name, r.dataset_version, i.input_name, i.input_version
FROM {ROLES} r JOIN ins i ON r.dataset_name = i.name AND r.dataset_version = i.version
WHERE r.role = 'featurized training data'""",
    "model_ancestors": f"""
WITH RECURSIVE ds AS MATERIALIZED (SELECT * FROM {DS}),
ins AS MATERIALIZED (
  SELECT name, version, 'orders' AS input_name, 1 AS input_version FROM ds
  UNION ALL SELECT name, version, name, version - 1 FROM ds WHERE version > 1),
walk(model_name, model_version, name, version, distance) AS (
  SELECT model_name, model_version, dataset_name, dataset_version, 1 FROM {ROLES} WHERE role = 'featurized training data'
  UNION ALL
  SELECT w.model_name, w.model_version, i.input_name, i.input_version, w.distance + 1
  FROM walk w JOIN ins i ON w.name = i.name AND w.version = i.version)
SELECT model_name, model_version, name AS ancestor_name, version AS ancestor_version, CAST(min(distance) AS INTEGER) AS distance
FROM walk GROUP BY model_name, model_version, name, version""",
    "scan_registered": "SELECT * FROM orders",
    "auc_by_rank": """
WITH s AS (SELECT CAST(d.n_chars AS DOUBLE) AS score, l.quality AS y
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rnk FROM s),
c AS (SELECT count(*) FILTER (WHERE y = 1) AS n1, count(*) FILTER (WHERE y = 0) AS n0 FROM s)
SELECT round((sum(rnk) FILTER (WHERE y = 1) - c.n1 * (c.n1 + 1) / 2.0) / (c.n1 * c.n0), 9) AS auc
FROM r, c GROUP BY c.n1, c.n0""",
}
