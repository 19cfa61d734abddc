"""The exact tree (2.11) and its text sinks (2.2)."""

from pyspark.sql import functions as F

from tabprep.catalog.fixtures import COLUMNS, FEAT4, FEATURES, NULLABLE, WIDE, feat4, nullable, wide
from tabprep.catalog.registry import Tables, query, u_sql, with_
from tabprep.catalog.sampling import _order
from tabprep.catalog.splits import _h
from tabprep.functions.seeded import u
from tabprep.operators import evaluate
from tabprep.operators.prefix import with_ordinal
from tabprep.plans import tables, tree
from tabprep.session import scratch_path
from tabprep.sources import readers, writers

_DEPTH = 10


def _fit_sql(src: str, features, classes, depth: int) -> str:
    """CTEs of a tree of the given depth over ``src``, ending in ``nodes``."""
    counts = ", ".join(f"count_if(label = {c}) AS c{c}" for c in classes)
    tot = [f"t{c}" for c in classes]
    left = [f"l{c}" for c in classes]
    right = [f"(t{c}-l{c})" for c in classes]
    n, nl = "(" + "+".join(tot) + ")", "(" + "+".join(left) + ")"
    gain = f"round({_h(*tot)} - (({nl}/{n})*({_h(*left)}) + (({n}-{nl})/{n})*({_h(*right)})), 12)"
    ctes = [f"rows0 AS (SELECT *, CAST(1 AS BIGINT) AS node FROM {src})"]
    for d in range(depth + 1):
        mode = ", ".join(f"[count_if(label = {c}), {-c}]" for c in classes)
        ctes.append(f"""stat{d} AS (SELECT node, count(*) AS n, min(label) = max(label) AS pure,
          -(list_max([{mode}])[2]) AS label FROM rows{d} GROUP BY node)""")
        if d == depth:
            ctes.append(f"""lev{d} AS (SELECT node, {d} AS depth, CAST(NULL AS INTEGER) AS feature_no,
              CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS threshold, label, n FROM stat{d})""")
            break
        long = " UNION ALL ".join(
            f"SELECT node, {i} AS f, '{x}' AS name, {x} AS value, label FROM rows{d}" for i, x in enumerate(features)
        )
        runs = ", ".join(f"sum(c{c}) OVER w AS l{c}, sum(c{c}) OVER g AS t{c}" for c in classes)
        ctes += [
            f"cnt{d} AS (SELECT node, f, name, value, {counts} FROM ({long}) GROUP BY ALL)",
            f"""run{d} AS (SELECT *, {runs}, lead(value) OVER o AS nxt FROM cnt{d}
              WINDOW w AS (PARTITION BY node, f ORDER BY value ROWS UNBOUNDED PRECEDING),
              o AS (PARTITION BY node, f ORDER BY value), g AS (PARTITION BY node, f))""",
            f"""best{d} AS (SELECT node, f, name, (value + nxt) / 2 AS threshold FROM run{d} WHERE nxt IS NOT NULL
              QUALIFY row_number() OVER (PARTITION BY node ORDER BY {gain} DESC, f, (value + nxt) / 2) = 1)""",
            f"""lev{d} AS (SELECT s.node, {d} AS depth, CASE WHEN NOT pure THEN f END AS feature_no,
              CASE WHEN NOT pure THEN name END AS feature, CASE WHEN NOT pure THEN threshold END AS threshold, label, n
              FROM stat{d} s LEFT JOIN best{d} b ON b.node = s.node)""",
            f"""rows{d + 1} AS (SELECT r.* REPLACE (r.node * 2 + CASE WHEN [{', '.join('r.' + x for x in features)}][feature_no + 1]
              > threshold THEN 1 ELSE 0 END AS node) FROM rows{d} r JOIN lev{d} l ON l.node = r.node AND feature IS NOT NULL)""",
        ]
    union = " UNION ALL ".join(f"SELECT * FROM lev{d}" for d in range(depth + 1))
    ctes.append(f"""nodes AS (SELECT node AS node_id, depth, feature_no, feature, threshold,
      CAST(printf('%.2f', threshold) AS DOUBLE) AS threshold_2dp,
      CASE WHEN feature IS NOT NULL THEN node * 2 END AS left_id, CASE WHEN feature IS NOT NULL THEN node * 2 + 1 END AS right_id,
      CAST(label AS INTEGER) AS label, n FROM ({union}))""")
    return ",\n".join(ctes)


def _predict_sql(features, depth: int, src: str = "rows0", bound: str = "threshold_2dp") -> str:
    """CTE ``predicted``: the rows of ``src`` walked down ``nodes``, by the rounded thresholds or the exact ones."""
    ctes = [f"walk0 AS (SELECT * FROM {src})"]
    for d in range(depth):
        ctes.append(f"""walk{d + 1} AS (SELECT w.* REPLACE (CASE WHEN feature IS NULL THEN w.node ELSE w.node * 2
          + CASE WHEN [{', '.join('w.' + x for x in features)}][feature_no + 1] > {bound} THEN 1 ELSE 0 END END AS node)
          FROM walk{d} w LEFT JOIN nodes n ON n.node_id = w.node)""")
    ctes.append(f"predicted AS (SELECT w.*, n.label AS prediction FROM walk{depth} w JOIN nodes n ON n.node_id = w.node)")
    return ",\n".join(ctes)


_FIT_LINES = with_(FEAT4, _fit_sql("feat4", FEATURES, [0, 1, 2], _DEPTH))
_FIT_VEC = with_(WIDE, _fit_sql("wide", COLUMNS, list(range(10)), _DEPTH), _predict_sql(COLUMNS, _DEPTH))


@query("id3_fit", _FIT_LINES + """SELECT node_id, depth, feature, threshold, threshold_2dp, left_id, right_id, label, n FROM nodes""")
def id3_fit(t: Tables):
    return tree.id3_fit(feat4(t), FEATURES, "label", _DEPTH).drop("feature_no")


def _vec_tree(t: Tables):
    df = wide(t)
    return df, tree.id3_fit(df, COLUMNS, "label", _DEPTH)


@query("id3_predict", _FIT_VEC + "SELECT vec_id, label, prediction FROM predicted")
def id3_predict(t: Tables):
    df, nodes = _vec_tree(t)
    return tree.id3_predict(df, nodes, COLUMNS).select("vec_id", "label", "prediction")


_CODES = {"AUTOMOBILE": 0, "BUILDING": 1, "FURNITURE": 2, "HOUSEHOLD": 3, "MACHINERY": 4}
_JOB = ["acctbal", "segment"]


def _job_tables(t: Tables):
    """Customers with gaps, dealt into a labelled and an unlabelled table; the label is of the values before the gaps."""
    label = F.when((F.col("c_acctbal") >= 4500) != (F.col("c_mktsegment") == "MACHINERY"), 1).otherwise(0).alias("good")
    rows = nullable(t).join(t.customer.select("c_custkey", label), "c_custkey")
    asked = u(42, F.col("c_custkey"), "asked") < 0.25
    return rows.filter(~asked), rows.filter(asked).drop("good")


def _filled_sql(part: str, label: str) -> str:
    codes = " ".join(f"WHEN '{name}' THEN {n}" for name, n in _CODES.items())
    mode = f"(SELECT segment FROM {part} WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)"
    return f"""SELECT c_custkey, coalesce(acctbal, (SELECT median(acctbal) FROM {part})) AS acctbal,
      CASE coalesce(segment, {mode}) {codes} END AS segment, {label} FROM {part}"""


_JOB_SQL = with_(
    NULLABLE,
    f"""dealt AS (SELECT n.*, CASE WHEN (c_acctbal >= 4500) <> (c_mktsegment = 'MACHINERY') THEN 1 ELSE 0 END AS label,
      {u_sql(42, 'c_custkey', repr('asked'))} < 0.25 AS asked FROM nullable n JOIN customer USING (c_custkey))""",
    "known AS (SELECT * FROM dealt WHERE NOT asked)", "wanted AS (SELECT * FROM dealt WHERE asked)",
    f"ready AS ({_filled_sql('known', 'label')})",
    f"split AS (SELECT *, {_order('split', 'c_custkey')} <= ceil(0.2 * count(*) OVER ()) AS held FROM ready)",
    "fit AS (SELECT * FROM split WHERE NOT held)",
    _fit_sql("fit", _JOB, [0, 1], _DEPTH),
    f"""every AS (SELECT c_custkey, CAST(acctbal AS DOUBLE) AS acctbal, CAST(segment AS DOUBLE) AS segment, label, true AS told, CAST(1 AS BIGINT) AS node FROM split WHERE held
      UNION ALL SELECT c_custkey, acctbal, segment, label, false, 1 FROM ({_filled_sql('wanted', 'CAST(NULL AS INTEGER) AS label')}))""",
    _predict_sql(_JOB, _DEPTH, "every", "threshold"),
)


@query("table_job", _JOB_SQL + """SELECT c_custkey, CAST(prediction AS INTEGER) AS good FROM predicted WHERE NOT told
  UNION ALL SELECT -1, CAST(count_if(label = prediction) AS INTEGER) FROM predicted WHERE told""")
def table_job(t: Tables):
    """The submission, written and read back as CSV; under key -1 how many held-out rows were told rightly."""
    known, wanted = _job_tables(t)
    prepare = tables.Preparation(medians=["acctbal"], modes=["segment"], codes={"segment": _CODES}, drop=["nationkey"])
    found = tables.table_job(known, wanted, "c_custkey", "good", _JOB, prepare, _DEPTH)
    path = scratch_path(t.spark, "submission.csv")
    writers.write_csv_keyed(found.submission, path, "c_custkey")
    rows = readers.read_csv(t.spark, path, "c_custkey BIGINT, good INT")
    hits = found.held_out.agg(F.sum(evaluate.hit("good", "prediction")).cast("int").alias("good"))
    return rows.unionByName(hits.select(F.lit(-1).cast("bigint").alias("c_custkey"), "good"))


@query("sink_tree_text", _FIT_LINES + """SELECT concat(repeat('  ', depth), CASE WHEN feature IS NULL
  THEN concat('Label: ', label) ELSE printf('%s ≤ %.2f:', feature, threshold_2dp) END) AS value FROM nodes""")
def sink_tree_text(t: Tables):
    path = scratch_path(t.spark, "tree.txt")
    writers.write_tree(tree.id3_fit(feat4(t), FEATURES, "label", _DEPTH), path)
    return t.spark.read.text(path)


@query("sink_prediction_text", _FIT_VEC + """SELECT printf('Sample %d: True Label = %d, Predicted = %d',
  row_number() OVER (ORDER BY vec_id), label, prediction) AS value FROM predicted""")
def sink_prediction_text(t: Tables):
    path = scratch_path(t.spark, "predictions.txt")
    writers.write_predictions(with_ordinal(id3_predict(t), "vec_id"), path, "ordinal", "label", "prediction")
    return t.spark.read.text(path)
