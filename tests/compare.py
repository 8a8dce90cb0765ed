"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import datetime as dt
import math


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([norm(x) for x in v])
    if isinstance(v, dict):
        return str(sorted((k, norm(x)) for k, x in v.items()))
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def same_result(spark_df, con, sql):
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(spark_df.columns) == sorted(d_cols), (spark_df.columns, d_cols)
    assert len(s_rows) == len(d_rows)
    a, b = canon(spark_df.columns, s_rows), canon(d_cols, d_rows)
    assert a == b, [(x, y) for x, y in zip(a, b) if x != y][:3]
