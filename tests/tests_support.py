"""Plain-Python references for property tests."""

import math
import re

NUMBER = re.compile(r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?")


def py_int_like(v):
    """Integer-like text: what the reference's parser accepts, restricted to plain numerals."""
    if v is None:
        return None
    s = v.strip()
    if not s or not NUMBER.fullmatch(s):
        return None
    f = float(s)
    if math.isnan(f) or math.isinf(f) or not f.is_integer():
        return None
    n = int(f)
    return n if -(2**63) <= n < 2**63 else None


def sequential_claims(rows):
    seen, out = {}, {}
    for ordn, toks in sorted(rows):
        if any(t in seen for t in toks):
            out[ordn] = False
            continue
        out[ordn] = True
        for t in toks:
            seen.setdefault(t, ordn)
    return out
