"""Split search (2.5 entropy, 2.6 split scan)."""

from pyspark.sql import functions as F

from tabprep.catalog.fixtures import FEAT4, FEAT4_LONG, FEATURES, feat4
from tabprep.catalog.registry import Tables, query, with_
from tabprep.operators import splits

_COUNTED = """counted AS (SELECT feature_no, feature, value, count_if(label = 0) AS a, count_if(label = 1) AS b,
  count_if(label = 2) AS c FROM long GROUP BY ALL)"""
_RAN = """ran AS (SELECT *, sum(a) OVER w AS la, sum(b) OVER w AS lb, sum(c) OVER w AS lc,
  sum(a) OVER g AS ta, sum(b) OVER g AS tb, sum(c) OVER g AS tc, lead(value) OVER o AS nxt FROM counted
  WINDOW w AS (PARTITION BY feature_no ORDER BY value ROWS UNBOUNDED PRECEDING),
    o AS (PARTITION BY feature_no ORDER BY value), g AS (PARTITION BY feature_no))"""


def _h(*c: str) -> str:
    n = "(" + "+".join(c) + ")"
    return "-(" + "+".join(f"CASE WHEN {x} > 0 THEN ({x}/{n})*log2({x}/{n}) ELSE 0 END" for x in c) + ")"


_NL, _N = "(la+lb+lc)", "(ta+tb+tc)"
_SCAN = f"""scan AS (SELECT feature_no, feature, (value + nxt) / 2 AS threshold,
  round({_h('ta', 'tb', 'tc')} - (({_NL}/{_N})*({_h('la', 'lb', 'lc')})
    + (({_N}-{_NL})/{_N})*({_h('(ta-la)', '(tb-lb)', '(tc-lc)')})), 12) + 0.0 AS gain,
  CAST({_N} AS BIGINT) AS n, CAST({_NL} AS BIGINT) AS n_left FROM ran WHERE nxt IS NOT NULL)"""
SCAN = ",\n".join([FEAT4, FEAT4_LONG, _COUNTED, _RAN, _SCAN])
_OUT = "feature, threshold, round(gain, 9) AS gain, n, n_left"


def _shape(df, places=9):
    gain = F.round("gain", places) + F.lit(0.0)
    return df.select("feature", "threshold", gain.alias("gain"), "n", "n_left")


@query("entropy", with_(FEAT4) + """SELECT round(-sum(p * log2(p)), 9) AS entropy
  FROM (SELECT count(*) / sum(count(*)) OVER () AS p FROM feat4 GROUP BY label)""")
def entropy(t: Tables):
    return splits.entropy(feat4(t)).select(F.round("entropy", 9).alias("entropy"))


@query("split_scan", with_(SCAN) + "SELECT feature, threshold, round(gain, 6) + 0.0 AS gain, n, n_left FROM scan")
def split_scan(t: Tables):
    df = feat4(t)
    out = splits.split_scan(df, FEATURES, "label", splits.class_list(df))
    return _shape(out, 6)


@query("best_split", with_(SCAN) + f"""SELECT {_OUT} FROM scan WHERE feature = 'extendedprice'
  ORDER BY scan.gain DESC, threshold LIMIT 1""")
def best_split(t: Tables):
    df = feat4(t)
    return _shape(splits.best_split(df, "extendedprice", "label", splits.class_list(df)))


@query("best_feature", with_(SCAN) + f"SELECT {_OUT} FROM scan ORDER BY scan.gain DESC, feature_no, threshold LIMIT 1")
def best_feature(t: Tables):
    df = feat4(t)
    return _shape(splits.best_feature(df, FEATURES, "label", splits.class_list(df)))
