import hashlib
import math

import pandas as pd


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def digest(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = sorted("|".join(norm(r[c]) for c in cols) for r in df[cols].to_dict("records"))
    return hashlib.sha1("\n".join(rows).encode()).hexdigest(), rows


def rows(df):
    return [r.asDict() for r in df.collect()]
