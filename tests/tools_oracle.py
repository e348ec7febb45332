"""Value normalisation shared by the oracle test and tools/oracle_check.py."""

import datetime as dt
import decimal
import math


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return f"f{round(v, 6)!r}"
    if isinstance(v, decimal.Decimal):
        return f"d{v.normalize():f}" if v != 0 else "d0"
    if isinstance(v, bool):
        return f"i{int(v)}"
    if isinstance(v, int):
        return f"i{v}"
    if isinstance(v, dt.datetime):
        return "t" + v.isoformat()
    if isinstance(v, dt.date):
        return "D" + v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return "s" + str(v)
