"""DuckDB twins of the registered queries (used by ``__spark_entry__.oracle_sql``).

Each twin is written the plain SQL way -- global windows, ``quantile_cont``,
textbook formulas -- independently of how the Spark side distributes the work.
Floating outputs are rounded to 6 decimals, like the Spark side.
"""

from __future__ import annotations

from cohort_engine.sources.fixtures import (C1_FEATURES, C1_SQL, C2_FEATURES, C2_SQL, C3_FEATURES, C3_SQL,
                                            C4_SQL, C5_SQL, C6_SQL, CSV_SQL, DIRTY_SQL)


def _r(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0.0 AS {name}"          # + 0.0: no negative zero


def _unpivot(src: str, cols: list[str], keys: list[str] = (), nulls: bool = False) -> str:
    inc = "INCLUDE NULLS " if nulls else ""
    sel = ", ".join(list(keys) + [f"CAST({c} AS DOUBLE) AS {c}" for c in cols])
    return f"(SELECT * FROM (SELECT {sel} FROM ({src})) UNPIVOT {inc}(value FOR feature IN ({', '.join(cols)})))"


def _md5(seed, *parts: str) -> str:
    inner = " || ':' || ".join([f"'{seed}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"md5({inner})"


def _hash60(expr: str) -> str:
    return f"('0x' || substr({expr}, 1, 15))::BIGINT"


C1_SEX = C1_SQL.replace(
    "CASE WHEN o.o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex",
    "CAST(CASE WHEN o.o_custkey % 2 = 0 THEN 0.0 ELSE 1.0 END AS DOUBLE) AS sex")
C1_ENC_FEATURES = ["age", "sex", "totalprice", "qty", "price", "disc", "tax", "lines", "constant_col"]
C1_ALL = ["patient_id", "response", "age", "sex", "batch", "totalprice", "qty", "price", "disc", "tax",
          "lines", "constant_col"]
C1_DOUBLES = ["age", "batch", "totalprice", "qty", "price", "disc", "tax", "lines", "constant_col"]


def _round_all(src: str, cols: list[str]) -> str:
    rep = ", ".join(_r(c, c) for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({src})"


def _anova(long_src: str, vcol: str = "value") -> str:
    """F per feature from a long (feature, response, value) source."""
    return f"""
per AS (SELECT feature, response, count({vcol}) AS n_c, avg({vcol}) AS mean_c, var_pop({vcol}) AS var_c
        FROM {long_src} WHERE {vcol} IS NOT NULL GROUP BY feature, response),
tot AS (SELECT feature, sum(n_c) AS n, sum(n_c * mean_c) / sum(n_c) AS grand, count(*) AS k
        FROM per GROUP BY feature),
fs AS (SELECT p.feature,
              CASE WHEN t.k > 1 THEN (sum(p.n_c * (p.mean_c - t.grand) ^ 2) / (t.k - 1))
                                     / NULLIF(sum(p.n_c * p.var_c) / (t.n - t.k), 0) END AS f_score
       FROM per p JOIN tot t USING (feature) GROUP BY p.feature, t.k, t.n)"""


FLAGSHIP = f"""
WITH l AS (SELECT patient_id, response, batch, feature, value
           FROM {_unpivot(C1_SEX, C1_ENC_FEATURES, ['patient_id', 'response', 'batch'], nulls=True)}),
kept AS (SELECT feature FROM l GROUP BY feature HAVING count(value) > 0 AND min(value) <> max(value)),
neg AS (SELECT coalesce(bool_or(value < 0), false) AS z FROM l WHERE feature IN (SELECT feature FROM kept)),
m AS (SELECT feature, avg(value) AS mu, stddev_pop(value) AS sd FROM l GROUP BY feature),
t AS (SELECT l.patient_id, l.response, l.batch, l.feature,
             CASE WHEN (SELECT z FROM neg) THEN (l.value - m.mu) / NULLIF(m.sd, 0)
                  ELSE CASE WHEN l.value + 1 > 0 THEN log2(l.value + 1) END END AS v
      FROM l JOIN m USING (feature) WHERE l.feature IN (SELECT feature FROM kept)),
med AS (SELECT feature, quantile_cont(v, 0.5) AS md FROM t GROUP BY feature),
f AS (SELECT t.*, coalesce(t.v, med.md, 0.0) AS v2 FROM t JOIN med USING (feature)),
bc AS (SELECT *, v2 - avg(v2) OVER (PARTITION BY feature, batch) AS v3 FROM f),
sc AS (SELECT *, (v3 - avg(v3) OVER (PARTITION BY feature))
                 / coalesce(NULLIF(stddev_pop(v3) OVER (PARTITION BY feature), 0), 1) AS v4 FROM bc),
{_anova('sc', 'v4')}
SELECT feature, round(f_score, 6) AS f_score FROM fs
QUALIFY row_number() OVER (ORDER BY f_score DESC NULLS LAST, feature)
        <= (SELECT CASE WHEN count(*) >= 10 THEN 10 ELSE count(*) END FROM kept)
"""

VIOLATIONS = f"""
WITH d AS ({DIRTY_SQL})
SELECT CAST(patient_id AS VARCHAR) AS row_id, 'response' AS column_name, 'not_nullable' AS check_name,
       CAST(NULL AS VARCHAR) AS failure_case FROM d WHERE response IS NULL
UNION ALL
SELECT CAST(patient_id AS VARCHAR), 'response', 'isin([0, 1])', CAST(response AS VARCHAR)
FROM d WHERE response IS NOT NULL AND response NOT IN (0, 1)
UNION ALL
SELECT CAST(patient_id AS VARCHAR), 'age', 'in_range(0, 120)', CAST(age AS VARCHAR)
FROM d WHERE age IS NOT NULL AND NOT (age BETWEEN 0 AND 120)
UNION ALL
SELECT CAST(patient_id AS VARCHAR), 'sex', 'isin([''M'', ''F''])', sex
FROM d WHERE sex IS NOT NULL AND sex NOT IN ('M', 'F')
UNION ALL
SELECT CAST(patient_id AS VARCHAR), 'priority', 'coerce_dtype(''float'')', priority
FROM d WHERE priority IS NOT NULL AND TRY_CAST(priority AS DOUBLE) IS NULL
"""

CSV_SCAN = f"""
SELECT patient_id, CAST(response AS INTEGER) AS response, round(age, 6) AS age, sex,
       round(TRY_CAST(priority AS DOUBLE), 6) AS priority FROM ({CSV_SQL})
"""

CSV_VIOLATIONS = f"""
WITH d AS ({CSV_SQL})
SELECT patient_id AS row_id, 'response' AS column_name, 'isin([0, 1])' AS check_name, CAST(response AS VARCHAR) AS failure_case
FROM d WHERE response NOT IN (0, 1)
UNION ALL
SELECT patient_id, 'age', 'in_range(0, 120)', CAST(CAST(age AS BIGINT) AS VARCHAR) FROM d WHERE age > 120
UNION ALL
SELECT patient_id, 'priority', 'coerce_dtype(''float'')', priority FROM d WHERE priority IS NOT NULL AND TRY_CAST(priority AS DOUBLE) IS NULL
"""

COERCED = f"""
SELECT patient_id, CAST(response AS INTEGER) AS response, round(age, 6) AS age, sex,
       round(TRY_CAST(priority AS DOUBLE), 6) AS priority, round(totalprice, 6) AS totalprice
FROM ({DIRTY_SQL})
"""

UNION = _round_all(f"SELECT *, 0 AS source FROM ({C1_SQL}) UNION ALL BY NAME SELECT *, 1 AS source FROM ({C5_SQL})",
                   C1_DOUBLES)

CONSTANT = f"""
SELECT feature, count(value) AS n_non_null, round(min(value), 6) AS min_value, round(max(value), 6) AS max_value,
       (count(value) = 0 OR min(value) = max(value)) AS is_constant
FROM {_unpivot(C1_SEX, C1_ENC_FEATURES, nulls=True)} GROUP BY feature
"""

ALIGN = f"""
SELECT patient_id, response, round(n_words, 6) AS n_words, round(n_chars, 6) AS n_chars,
       CAST(0.0 AS DOUBLE) AS absent_marker, round(digit_share, 6) AS digit_share
FROM ({C3_SQL})
"""

BALANCE = f"""
WITH c AS (SELECT response, count(*) AS n FROM ({C2_SQL}) GROUP BY response),
a AS (SELECT min(n) AS n_min, max(n) AS n_max, count(*) AS n_classes FROM c)
SELECT n_min, n_max, n_classes, round(CAST(n_min AS DOUBLE) / n_max, 6) AS ratio,
       CASE WHEN CAST(n_min AS DOUBLE) / n_max < 0.5 AND n_min * 2 < n_max THEN 'oversampling'
            WHEN CAST(n_min AS DOUBLE) / n_max < 0.5 THEN 'undersampling' ELSE 'none' END AS strategy
FROM a
"""

RANGES = f"""
SELECT feature, round(min(value), 6) AS min_value, round(max(value), 6) AS max_value
FROM {_unpivot(C1_SQL, C1_FEATURES)} GROUP BY feature
"""

ANY_NEG = f"SELECT coalesce(bool_or(value < 0), false) AS any_negative FROM {_unpivot(C2_SQL, C2_FEATURES)}"

MOMENTS = f"""
SELECT feature, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std_pop
FROM {_unpivot(C2_SQL, C2_FEATURES)} GROUP BY feature
"""

MEDIANS = f"""
SELECT feature, round(quantile_cont(value, 0.5), 6) AS median
FROM {_unpivot(C1_SQL, C1_FEATURES)} GROUP BY feature
"""

QUARTILES = f"""
SELECT feature, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.75), 6) AS q3
FROM {_unpivot(C2_SQL, C2_FEATURES)} GROUP BY feature
"""


def _log2(c: str) -> str:
    return f"CASE WHEN {c} + 1 > 0 THEN log2({c} + 1) END"


_C1_OTHER = ["patient_id", "response", "sex", "batch"]
LOG2 = ("SELECT patient_id, response, sex, round(batch, 6) AS batch, "
        + ", ".join(_r(_log2(c), c) for c in C1_FEATURES) + f" FROM ({C1_SQL})")

ZSCORE = ("SELECT patient_id, response, "
          + ", ".join(_r(f"({c} - avg({c}) OVER ()) / NULLIF(stddev_pop({c}) OVER (), 0)", c) for c in C2_FEATURES)
          + f" FROM ({C2_SQL})")

_T1 = ("SELECT patient_id, response, sex, batch, "
       + ", ".join(f"{_log2(c)} AS {c}" for c in C1_FEATURES) + f" FROM ({C1_SQL})")
_T3 = ("SELECT patient_id, response, sex, batch, "
       + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM t1), 0.0) AS {c}" for c in C1_FEATURES)
       + " FROM t1")
FILL = (f"WITH t1 AS ({_T1}) SELECT patient_id, response, sex, round(batch, 6) AS batch, "
        + ", ".join(_r(c, c) for c in C1_FEATURES) + f" FROM ({_T3})")
CENTER = (f"WITH t1 AS ({_T1}), t3 AS ({_T3}) SELECT patient_id, response, sex, round(batch, 6) AS batch, "
          + ", ".join(_r(f"{c} - avg({c}) OVER (PARTITION BY batch)", c) for c in C1_FEATURES) + " FROM t3")

CENTER_MANY = CENTER.replace("CAST(n.n_regionkey AS DOUBLE) AS batch", "CAST(o.o_custkey AS DOUBLE) AS batch")
CORRECT = f"SELECT patient_id, {', '.join(C1_FEATURES)} FROM ({CENTER})"

ALL_ROWS = f"SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_off FROM ({C5_SQL})"
SVM_CLASSES = " UNION ALL ".join(f"SELECT '{e}' AS estimator, n_rows, n_off FROM ({ALL_ROWS})" for e in ("linear", "rbf", "cart"))
ICE_LAYOUT = f"""
WITH c AS ({C5_SQL}), v AS (
  SELECT 'qty' AS feature, CAST(qty AS DOUBLE) AS value FROM c UNION ALL SELECT 'disc', CAST(disc AS DOUBLE) FROM c
  UNION ALL SELECT 'sex', CASE sex WHEN 'M' THEN 0.0 ELSE 1.0 END FROM c),
p AS (SELECT feature, least(count(DISTINCT value), 100) AS n_points FROM v GROUP BY feature)
SELECT feature, (SELECT count(*) FROM c) AS n_curves, n_points, n_points * (SELECT count(*) FROM c) AS n_cells FROM p
"""

SCALE = ("SELECT patient_id, response, batch, "
         + ", ".join(_r(f"({c} - avg({c}) OVER ()) / coalesce(NULLIF(stddev_pop({c}) OVER (), 0), 1)", c)
                     for c in C3_FEATURES) + f" FROM ({C3_SQL})")

IMPUTE = (f"WITH c AS ({C1_SQL}) SELECT patient_id, response, sex, round(batch, 6) AS batch, "
          + ", ".join(_r(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM c))", c) for c in C1_FEATURES)
          + " FROM c")

OVERSAMPLE = _round_all(f"""
WITH c AS ({C2_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY response ORDER BY {_md5(42, 'patient_id')}, patient_id) - 1 AS rk
      FROM c),
cnt AS (SELECT response, count(*) AS n FROM c GROUP BY response),
mx AS (SELECT max(n) AS m FROM cnt),
d AS (SELECT cnt.response, cnt.n, unnest(range(0, mx.m - cnt.n)) AS i FROM cnt, mx WHERE cnt.n < mx.m),
p AS (SELECT response, {_hash60(_md5(42, "'draw'", 'response', 'i'))} % n AS rk FROM d)
SELECT * FROM c
UNION ALL
SELECT r.* EXCLUDE (rk) FROM p JOIN r ON p.response = r.response AND p.rk = r.rk
""", C2_FEATURES)

UNDERSAMPLE = _round_all(f"""
WITH c AS ({C5_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY response ORDER BY {_md5(42, 'patient_id')}, patient_id) - 1 AS rk
      FROM c)
SELECT * EXCLUDE (rk) FROM r
WHERE rk < (SELECT min(n) FROM (SELECT count(*) AS n FROM c GROUP BY response))
""", [c for c in C1_DOUBLES if c != "lines"])


def _drawn(src: str) -> str:
    """(patient_id, response, weight): how often the oversampled table holds each row."""
    return f"""
WITH c AS (SELECT patient_id, response FROM ({src})),
r AS (SELECT *, row_number() OVER (PARTITION BY response ORDER BY {_md5(42, 'patient_id')}, patient_id) - 1 AS rk FROM c),
cnt AS (SELECT response, count(*) AS n FROM c GROUP BY response),
mx AS (SELECT max(n) AS m FROM cnt),
d AS (SELECT cnt.response, cnt.n, unnest(range(0, mx.m - cnt.n)) AS i FROM cnt, mx WHERE cnt.n < mx.m),
p AS (SELECT response, {_hash60(_md5(42, "'draw'", 'response', 'i'))} % n AS rk FROM d),
t AS (SELECT response, rk, count(*) AS n FROM p GROUP BY response, rk)
SELECT r.patient_id, r.response, CAST(1 + coalesce(t.n, 0) AS BIGINT) AS weight FROM r LEFT JOIN t ON t.response = r.response AND t.rk = r.rk
"""


def _folds(src: str, k: int, by: str = "response") -> str:
    return (f"SELECT *, CAST((row_number() OVER (PARTITION BY {by} ORDER BY {_md5(42, 'patient_id')}, patient_id) - 1) % {k} AS INTEGER) AS fold FROM ({src})")


OVERSAMPLE_WEIGHTS = f"SELECT patient_id, weight FROM ({_drawn(C2_SQL)})"

# candidates in the query's order: folds, then strengths, then numbers of features; fold 5 leaves nothing out
MULTI_FIT = f"""
WITH w AS ({_drawn(C5_SQL)}), f AS ({_folds(C5_SQL, 5)}),
g AS (SELECT * FROM (VALUES (0, 0), (1, 1), (2, 5)) t(pos, fold)),
n AS (SELECT g.pos, CAST(sum(weight) AS BIGINT) AS n_rows FROM g JOIN f ON f.fold <> g.fold JOIN w USING (patient_id) GROUP BY g.pos),
c AS (SELECT * FROM (VALUES (0, 0.01), (1, 0.1), (2, 1.0), (3, 10.0)) t(pos, c)), k AS (SELECT * FROM (VALUES (0, 3), (1, 5)) t(pos, k))
SELECT CAST(8 * n.pos + 2 * c.pos + k.pos AS INTEGER) AS candidate, CAST(c.c AS DOUBLE) AS c, CAST(k.k AS INTEGER) AS k, CAST(n.pos AS INTEGER) AS fold, n.n_rows, true AS optimal
FROM n, c, k
"""

SEARCH_LEDGER = f"""
WITH o AS ({_folds(f"SELECT patient_id, response FROM ({C5_SQL})", 2)}),
t AS (SELECT patient_id, response, u.outer FROM o JOIN (VALUES (0), (1)) u("outer") ON o.fold <> u.outer),
i AS (SELECT "outer", fold AS "inner" FROM ({_folds("SELECT * FROM t", 2, by='"outer", response')}))
SELECT CAST("outer" AS INTEGER) AS "outer", "inner", CAST(cand AS INTEGER) AS candidate, count(*) AS n_rows, CAST(0 AS BIGINT) AS fitted_again
FROM i, (VALUES (0), (1), (2)) c(cand) GROUP BY ALL
"""

LASSO_PATH = f"""
WITH f AS ({_folds(C5_SQL, 3)}), g AS (SELECT * FROM (VALUES (-1), (0), (1), (2)) t(fold)), a AS (SELECT * FROM (VALUES (0.001), (0.01), (0.1), (1.0)) t(alpha))
SELECT CAST(g.fold AS INTEGER) AS fold, CAST(a.alpha AS DOUBLE) AS alpha, count(*) AS n_rows, true AS optimal FROM g JOIN f ON f.fold <> g.fold, a GROUP BY ALL
"""


def _newton_gains(rows: str, out: str) -> str:
    """The best (node, feature, cut) of every node by second-order gain, from rows (node, g, h, age, qty, tax)."""
    return f"""
{out}_all AS (SELECT node, sum(g) AS gs, sum(h) AS hs FROM {rows} GROUP BY node),
{out}_cut AS (SELECT r.node, c.place, c.feature, c.cut, sum(r.g) AS gl, sum(r.h) AS hl FROM {rows} r
              JOIN cuts c ON CASE c.feature WHEN 'age' THEN r.age WHEN 'qty' THEN r.qty ELSE r.tax END <= c.cut GROUP BY ALL),
{out} AS (SELECT * FROM (
            SELECT c.*, (gl ^ 2 / (hl + 1) + (gs - gl) ^ 2 / (hs - hl + 1) - gs ^ 2 / (hs + 1)) / 2 AS gain FROM {out}_cut c JOIN {out}_all USING (node)
            WHERE hl >= 1 AND hs - hl >= 1) WHERE gain > 0
          QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 7) DESC, place, cut) = 1)"""


NEWTON_TREE = f"""
WITH cuts AS (SELECT 0 AS place, 'age' AS feature, CAST(c AS DOUBLE) AS cut FROM range(10, 120, 10) t(c) UNION ALL SELECT 1, 'qty', CAST(c AS DOUBLE) FROM range(10, 300, 10) t(c)
              UNION ALL SELECT 2, 'tax', c / 1000.0 FROM range(5, 80, 10) t(c)),
r0 AS (SELECT 1 AS node, 0.5 - response AS g, 0.25 AS h, age, CAST(qty AS DOUBLE) AS qty, CAST(tax AS DOUBLE) AS tax FROM ({C5_SQL})),
{_newton_gains('r0', 's0')},
r1 AS (SELECT CASE WHEN s.node IS NULL THEN -1 WHEN CASE s.feature WHEN 'age' THEN age WHEN 'qty' THEN qty ELSE tax END <= s.cut THEN 2 * r.node ELSE 2 * r.node + 1 END AS node,
              g, h, age, qty, tax FROM r0 r LEFT JOIN s0 s USING (node)),
{_newton_gains('r1', 's1')},
r2 AS (SELECT CASE WHEN s.node IS NULL THEN -1 WHEN CASE s.feature WHEN 'age' THEN age WHEN 'qty' THEN qty ELSE tax END <= s.cut THEN 2 * r.node ELSE 2 * r.node + 1 END AS node,
              g, h FROM r1 r LEFT JOIN s1 s USING (node)),
nodes AS (SELECT node, g, h FROM r0 UNION ALL SELECT node, g, h FROM r1 UNION ALL SELECT node, g, h FROM r2),
splits AS (SELECT node, feature, cut, gain FROM s0 UNION ALL SELECT node, feature, cut, gain FROM s1)
SELECT 0 AS tree, CAST(n.node AS INTEGER) AS node, any_value(s.feature) AS feature, round(any_value(s.cut), 6) AS cut, {_r('coalesce(any_value(s.gain), 0.0)', 'gain')},
       {_r('-sum(g) / (sum(h) + 1)', 'weight')}, CAST(count(*) AS DOUBLE) AS cover
FROM nodes n LEFT JOIN splits s USING (node) WHERE n.node > 0 GROUP BY n.node
"""
PROJECT = f"SELECT patient_id, response, {_r('qty', 'qty')}, {_r('disc', 'disc')} FROM ({C1_SQL})"
TOP_FEATURES = f"""
SELECT feature, {_r("abs(avg(value) FILTER (response = 1) - avg(value) FILTER (response = 0))", 'importance')}
FROM {_unpivot(C2_SQL, C2_FEATURES, ['response'])} GROUP BY feature
ORDER BY abs(avg(value) FILTER (response = 1) - avg(value) FILTER (response = 0)) DESC, feature LIMIT 10
"""

WIDE_MOMENTS = f"""
SELECT feature, count(value) AS n, {_r('avg(value)', 'mean')}, {_r('stddev_pop(value)', 'std_pop')}, {_r('min(value)', 'min_value')}, {_r('max(value)', 'max_value')}
FROM ({C6_SQL}) GROUP BY feature
"""
WIDE_ANOVA = f"""
WITH l AS ({C6_SQL}), {_anova('l')}
SELECT feature, round(f_score, 6) AS f_score FROM fs
"""
WIDE_QUARTILES = f"""
SELECT feature, {_r('quantile_cont(value, 0.25)', 'q1')}, {_r('quantile_cont(value, 0.5)', 'median')}, {_r('quantile_cont(value, 0.75)', 'q3')}
FROM ({C6_SQL}) GROUP BY feature
"""
WIDE_PREPARED = f"""
WITH z AS (SELECT patient_id, batch, feature, (value - avg(value) OVER f) / NULLIF(stddev_pop(value) OVER f, 0) AS v FROM ({C6_SQL}) WINDOW f AS (PARTITION BY feature)),
m AS (SELECT feature, quantile_cont(v, 0.5) AS med FROM z GROUP BY feature),
b AS (SELECT batch, feature, patient_id, coalesce(v, med, 0.0) AS v FROM z JOIN m USING (feature)),
c AS (SELECT feature, patient_id, v - avg(v) OVER (PARTITION BY feature, batch) AS v FROM b),
s AS (SELECT feature, patient_id, (v - avg(v) OVER f) / coalesce(NULLIF(stddev_pop(v) OVER f, 0), 1) AS v FROM c WINDOW f AS (PARTITION BY feature))
SELECT feature, count(v) AS n, {_r('avg(abs(v))', 'mean_size')}, {_r('min(v)', 'least')}, {_r('max(v)', 'most')},
       {_r('sum(v * ((patient_id % 7) - 3))', 'by_row')} FROM s GROUP BY feature
"""

OUT_IQR = f"""
WITH l AS (SELECT feature, value FROM {_unpivot(C2_SQL, C2_FEATURES, nulls=True)}),
q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM l GROUP BY feature),
b AS (SELECT feature, q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT b.feature, round(b.q1, 6) AS q1, round(b.q3, 6) AS q3, round(b.lower, 6) AS lower, round(b.upper, 6) AS upper,
       round(avg(CASE WHEN l.value < b.lower OR l.value > b.upper THEN 1.0 ELSE 0.0 END), 6) AS outlier_share,
       avg(CASE WHEN l.value < b.lower OR l.value > b.upper THEN 1.0 ELSE 0.0 END) > 0.05 AS flagged
FROM l JOIN b USING (feature) GROUP BY b.feature, b.q1, b.q3, b.lower, b.upper
"""

_Z2 = ("SELECT " + ", ".join(f"({c} - avg({c}) OVER ()) / NULLIF(stddev_pop({c}) OVER (), 0) AS {c}"
                             for c in C2_FEATURES) + f" FROM ({C2_SQL})")
OUT_Z = f"""
SELECT feature, round(avg(CASE WHEN abs(value) > 3.0 THEN 1.0 ELSE 0.0 END), 6) AS outlier_share,
       avg(CASE WHEN abs(value) > 3.0 THEN 1.0 ELSE 0.0 END) > 0.05 AS flagged
FROM {_unpivot(_Z2, C2_FEATURES, nulls=True)} GROUP BY feature
"""

ANOVA_C3 = f"""
WITH l AS (SELECT response, feature, value FROM {_unpivot(C3_SQL, C3_FEATURES, ['response'])}),
{_anova('l')}
SELECT feature, round(f_score, 6) AS f_score FROM fs
"""

FOLDS = f"""
SELECT patient_id, response,
       CAST((row_number() OVER (PARTITION BY response ORDER BY {_md5(42, 'patient_id')}, patient_id) - 1) % 10
            AS INTEGER) AS fold
FROM ({C5_SQL})
"""

_C4F = f"""SELECT *, CAST((row_number() OVER (PARTITION BY label ORDER BY {_md5(42, 'patient_id')}, patient_id) - 1)
                  % 10 AS INTEGER) AS fold FROM ({C4_SQL})"""

CONFUSION = f"""
WITH s AS ({C4_SQL}),
cls AS (SELECT label AS c FROM s UNION SELECT prediction FROM s),
cnt AS (SELECT label AS actual, prediction AS predicted, count(*) AS n FROM s GROUP BY label, prediction)
SELECT a.c AS actual, p.c AS predicted, coalesce(cnt.n, 0) AS n
FROM cls a CROSS JOIN cls p LEFT JOIN cnt ON cnt.actual = a.c AND cnt.predicted = p.c
"""


def _binary_scores(src: str, group: str | None) -> str:
    """Textbook binary MCC / weighted F1 / accuracy from tp, tn, fp, fn."""
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""
SELECT {g}
  CASE WHEN (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn) > 0
       THEN (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) ELSE 0.0 END AS mcc,
  ((tp + fn) * CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END
   + (tn + fp) * CASE WHEN 2 * tn + fp + fn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0.0 END)
   / (tp + tn + fp + fn) AS f1_weighted,
  (tp + tn) / (tp + tn + fp + fn) AS accuracy
FROM (SELECT {g}
        CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
        CAST(sum(CASE WHEN label <> 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tn,
        CAST(sum(CASE WHEN label <> 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
        CAST(sum(CASE WHEN label = 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fn
      FROM ({src}) {gb})
"""


def _auc(src: str, group: str | None) -> str:
    """Mann-Whitney with average ranks for ties."""
    g = f"{group}, " if group else ""
    pg = f"PARTITION BY {group} " if group else ""
    ties = f"PARTITION BY {group}, score" if group else "PARTITION BY score"
    gb = f"GROUP BY {group}" if group else ""
    return f"""
SELECT {g}
  CASE WHEN n1 > 0 AND n0 > 0 THEN (rs - n1 * (n1 + 1) / 2.0) / (n1 * n0) END AS auc
FROM (SELECT {g} sum(CASE WHEN label = 1 THEN ar ELSE 0 END) AS rs,
             CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS n1,
             CAST(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS DOUBLE) AS n0
      FROM (SELECT {g} label,
                   rank() OVER ({pg}ORDER BY score) + (count(*) OVER ({ties}) - 1) / 2.0 AS ar
            FROM ({src}) WHERE score IS NOT NULL)
      {gb})
"""


def _pr_points(src: str, group: str | None) -> str:
    g = f"{group}, " if group else ""
    pg = f"PARTITION BY {group} " if group else ""
    gb = f"GROUP BY {group}, score" if group else "GROUP BY score"
    return f"""
SELECT {g} score AS threshold, tp / (tp + fp) AS precision,
       CASE WHEN np > 0 THEN tp / np ELSE 1.0 END AS recall
FROM (SELECT {g} score,
             CAST(sum(pos) OVER ({pg}ORDER BY score DESC) AS DOUBLE) AS tp,
             CAST(sum(neg) OVER ({pg}ORDER BY score DESC) AS DOUBLE) AS fp,
             CAST(sum(pos) OVER ({pg.strip()}) AS DOUBLE) AS np
      FROM (SELECT {g} score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
                   sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg
            FROM ({src}) WHERE score IS NOT NULL {gb}))
"""


def _pr_with_anchor(src: str, group: str | None) -> str:
    if group:
        anchor = (f"SELECT DISTINCT {group}, CAST(NULL AS DOUBLE) AS threshold, 1.0 AS precision, 0.0 AS recall "
                  f"FROM ({src})")
    else:
        anchor = "SELECT CAST(NULL AS DOUBLE) AS threshold, 1.0 AS precision, 0.0 AS recall"
    return f"{_pr_points(src, group)} UNION ALL {anchor}"


def _aupr(src: str, group: str | None) -> str:
    g = f"{group}, " if group else ""
    pg = f"PARTITION BY {group} " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""
SELECT {g} sum((recall - pr) * (precision + pp) / 2.0) AS aupr
FROM (SELECT {g} recall, precision,
             lag(recall) OVER ({pg}ORDER BY threshold DESC NULLS FIRST) AS pr,
             lag(precision) OVER ({pg}ORDER BY threshold DESC NULLS FIRST) AS pp
      FROM ({_pr_with_anchor(src, group)}))
WHERE pr IS NOT NULL {gb}
"""


CLASS_SCORES = f"SELECT {_r('mcc', 'mcc')}, {_r('f1_weighted', 'f1_weighted')}, {_r('accuracy', 'accuracy')} " \
               f"FROM ({_binary_scores(C4_SQL, None)})"
ROC_AUC = f"SELECT {_r('auc', 'auc')} FROM ({_auc(C4_SQL, None)})"
PR_CURVE = f"SELECT {_r('threshold', 'threshold')}, {_r('precision', 'precision')}, {_r('recall', 'recall')} " \
           f"FROM ({_pr_with_anchor(C4_SQL, None)})"
AUPR = f"SELECT {_r('aupr', 'aupr')} FROM ({_aupr(C4_SQL, None)})"

FOLD_METRICS = f"""
SELECT s.fold, {_r('s.mcc', 'mcc')}, {_r('s.f1_weighted', 'f1_weighted')}, {_r('s.accuracy', 'accuracy')},
       {_r('a.auc', 'auc')}, {_r('p.aupr', 'aupr')}
FROM ({_binary_scores(_C4F, 'fold')}) s
LEFT JOIN ({_auc(_C4F, 'fold')}) a ON a.fold = s.fold
LEFT JOIN ({_aupr(_C4F, 'fold')}) p ON p.fold = s.fold
"""

FOLD_SUMMARY = f"""
SELECT {_r('avg(s.mcc)', 'cv_mcc')}, {_r('stddev_pop(s.mcc)', 'cv_mcc_std')},
       {_r('(SELECT f1_weighted FROM (' + _binary_scores(C4_SQL, None) + '))', 'cv_f1')},
       {_r('(SELECT auc FROM (' + _auc(C4_SQL, None) + '))', 'cv_auc')}
FROM ({_binary_scores(_C4F, 'fold')}) s
"""

SAMPLE = _round_all(f"SELECT * FROM ({C1_SQL}) ORDER BY {_md5(42, 'patient_id')}, patient_id LIMIT 100", C1_DOUBLES)

PERMUTE = f"""
WITH c AS (SELECT patient_id, response, qty FROM ({C5_SQL})),
a AS (SELECT patient_id, response, row_number() OVER (ORDER BY patient_id) - 1 AS r FROM c),
b AS (SELECT qty, row_number() OVER (ORDER BY {_md5(42, "'0'", "'qty'", 'patient_id')}, patient_id) - 1 AS r FROM c)
SELECT a.patient_id, a.response, round(b.qty, 6) AS qty FROM a JOIN b USING (r)
"""

MUTUAL_INFO = f"""
WITH l AS (SELECT patient_id, response, feature, value
           FROM {_unpivot(C3_SQL, C3_FEATURES, ['patient_id', 'response'])}),
cnt AS (SELECT feature, response, count(*) AS n_c FROM l GROUP BY feature, response),
p AS (SELECT l.*, c.n_c, least(3, c.n_c - 1) AS k FROM l JOIN cnt c USING (feature, response) WHERE c.n_c > 1),
dd AS (SELECT a.feature, a.patient_id, abs(a.value - b.value) AS d,
              row_number() OVER (PARTITION BY a.feature, a.patient_id ORDER BY abs(a.value - b.value)) AS rn
       FROM p a JOIN p b ON a.feature = b.feature AND a.response = b.response AND a.patient_id <> b.patient_id),
r AS (SELECT p.*, dd.d AS r FROM p JOIN dd ON dd.feature = p.feature AND dd.patient_id = p.patient_id
      AND dd.rn = p.k),
m AS (SELECT r.feature, r.patient_id, r.k, r.n_c, count(*) AS m
      FROM r JOIN p b ON b.feature = r.feature
       AND (CASE WHEN r.r > 0 THEN abs(b.value - r.value) < r.r ELSE b.value = r.value END)
      GROUP BY r.feature, r.patient_id, r.k, r.n_c),
h AS (SELECT i AS n,
             sum(CASE WHEN i = 1 THEN 0.0 ELSE 1.0 / (i - 1) END) OVER (ORDER BY i) - 0.5772156649015329 AS psi
      FROM (SELECT unnest(range(1, (SELECT count(*) FROM l) + 2)) AS i)),
agg AS (SELECT m.feature, count(*) AS big_n, avg(hk.psi) AS pk, avg(hn.psi) AS pn, avg(hm.psi) AS pm
        FROM m JOIN h hk ON hk.n = m.k JOIN h hn ON hn.n = m.n_c JOIN h hm ON hm.n = m.m GROUP BY m.feature)
SELECT a.feature, round(greatest(0.0, hb.psi + a.pk - a.pn - a.pm), 6) AS mi FROM agg a JOIN h hb ON hb.n = a.big_n
"""

ANOVA_TOPK_C2 = f"""
WITH l AS (SELECT response, feature, value FROM {_unpivot(C2_SQL, C2_FEATURES, ['response'])}),
{_anova('l')},
n AS (SELECT count(DISTINCT feature) AS p FROM l)
SELECT feature, round(f_score, 6) AS f_score FROM fs
QUALIFY row_number() OVER (ORDER BY f_score DESC NULLS LAST, feature)
        <= (SELECT CASE WHEN p >= 10 THEN (CASE WHEN p >= 60 THEN 60 ELSE p - p % 5 END) ELSE p END FROM n)
"""

MUTUAL_INFO_C2 = MUTUAL_INFO.replace(_unpivot(C3_SQL, C3_FEATURES, ['patient_id', 'response']),
                                     _unpivot(C2_SQL, C2_FEATURES, ['patient_id', 'response']))

ORACLE: dict[str, str] = {
    "flagship_anova_topk": FLAGSHIP,
    "c1_cohort": _round_all(C1_SQL, C1_DOUBLES),
    "c3_cohort": _round_all(C3_SQL, C3_FEATURES),
    "c2_cohort": _round_all(C2_SQL, C2_FEATURES),
    "c4_scores": _round_all(C4_SQL, ["score"]),
    "c5_cohort": _round_all(C5_SQL, [c for c in C1_DOUBLES if c != "lines"]),
    "anova_topk_c2": ANOVA_TOPK_C2,
    "mutual_info_c2": MUTUAL_INFO_C2,
    "dirty_violations": VIOLATIONS,
    "dirty_coerced": COERCED,
    "csv_scan": CSV_SCAN,
    "csv_violations": CSV_VIOLATIONS,
    "cohort_union": UNION,
    "constant_columns": CONSTANT,
    "align_columns": ALIGN,
    "class_balance": BALANCE,
    "feature_ranges": RANGES,
    "any_negative": ANY_NEG,
    "moments": MOMENTS,
    "medians": MEDIANS,
    "quartiles": QUARTILES,
    "log2_normalize": LOG2,
    "zscore_normalize": ZSCORE,
    "fill_bad": FILL,
    "batch_center": CENTER,
    "batch_center_many": CENTER_MANY,
    "batch_correct": CORRECT,
    "tree_shap_additivity": ALL_ROWS,
    "linear_shap_additivity": ALL_ROWS,
    "svm_classes": SVM_CLASSES,
    "ice_layout": ICE_LAYOUT,
    "standard_scale": SCALE,
    "impute_median": IMPUTE,
    "oversample": OVERSAMPLE,
    "oversample_weights": OVERSAMPLE_WEIGHTS,
    "multi_fit_lr": MULTI_FIT,
    "search_ledger": SEARCH_LEDGER,
    "lasso_path": LASSO_PATH,
    "newton_first_tree": NEWTON_TREE,
    "project_features": PROJECT,
    "top_features": TOP_FEATURES,
    "wide_moments": WIDE_MOMENTS,
    "wide_anova": WIDE_ANOVA,
    "wide_quartiles": WIDE_QUARTILES,
    "wide_prepared": WIDE_PREPARED,
    "undersample": UNDERSAMPLE,
    "outliers_iqr": OUT_IQR,
    "outliers_zscore": OUT_Z,
    "anova_scores": ANOVA_C3,
    "mutual_info": MUTUAL_INFO,
    "stratified_folds": FOLDS,
    "oof_layout": FOLDS.replace("% 10", "% 3"),
    "confusion": CONFUSION,
    "class_scores": CLASS_SCORES,
    "roc_auc": ROC_AUC,
    "pr_curve": PR_CURVE,
    "aupr": AUPR,
    "fold_metrics": FOLD_METRICS,
    "fold_summary": FOLD_SUMMARY,
    "sample_rows": SAMPLE,
    "permute_column": PERMUTE,
}
