import math
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (1, repr(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    if isinstance(v, bool):
        return (4, str(v))
    if isinstance(v, int):
        return (5, str(v))
    return (6, str(v))


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()
