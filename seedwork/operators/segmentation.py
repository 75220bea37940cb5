"""Ancestry segments by a rigid three-state hidden Markov model, one chromosome of one line at a time.

A state, once entered, lasts at least ``rigidity`` markers (each state is a chain of that many steps, kept as a counter in the dynamic programme), which
suppresses segments that the data do not support. Emissions are binomial with ALT rate 0, 1/2 or 1 blurred by an error. This is
the one grouped Python step of the core: a group is one line and chromosome, whose size is the number of markers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def viterbi_rigid(ref: np.ndarray, alt: np.ndarray, rigidity: int, error: float = 0.02, switch: float = 1e-4) -> np.ndarray:
    """Most likely states (0, 1, 2 copies) under which every run but the first and last has at least ``rigidity`` markers.

    O(markers): a run of length r ending at i is scored from prefix sums, and runs may grow one by one after that.
    """
    n = len(ref)
    rate = np.array([error, 0.5, 1 - error])
    emit = np.log(rate)[:, None] * alt + np.log(1 - rate)[:, None] * ref
    pre = np.concatenate([np.zeros((3, 1)), np.cumsum(emit, axis=1)], axis=1).T.tolist()
    emit = emit.T.tolist()
    r = max(1, min(rigidity, n))
    cost, low = float(np.log(switch)), float("-inf")
    best = [[low] * 3]  # by marker: value of each state as the end of a run that is long enough
    came = [[None] * 3]  # where that run began and the state before it, or null where it grew by one
    for i in range(1, n + 1):
        value, start = [v + e for v, e in zip(best[i - 1], emit[i - 1])], [None] * 3
        if i == r:
            for s in range(3):
                if pre[i][s] > value[s]:
                    value[s], start[s] = pre[i][s], (0, -1)
        elif i > r:
            j = i - r
            old = best[j]
            a = max(range(3), key=lambda t: (old[t], t))
            b = max((t for t in range(3) if t != a), key=lambda t: (old[t], t))
            for s in range(3):
                t = b if s == a else a
                w = old[t] + cost + pre[i][s] - pre[j][s]
                if w > value[s]:
                    value[s], start[s] = w, (j, t)
        best.append(value)
        came.append(start)
    out = np.empty(n, dtype=np.int64)
    i, s = n, max(range(3), key=lambda t: best[n][t]) if n else 0
    while i > 0:
        k = i
        while came[k][s] is None:
            k -= 1
        j, t = came[k][s]
        out[j:i] = s
        i, s = j, t
    return out


def segment_lines(obs: DataFrame, rigidity: int = 20, error: float = 0.02, switch: float = 1e-4) -> DataFrame:
    """(line, contig, start, end, state) from (line, contig, pos, ref, alt); segments end at their last marker. No rows give no segments."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        state = viterbi_rigid(pdf["ref"].to_numpy(float), pdf["alt"].to_numpy(float), rigidity, error, switch)
        cut = np.flatnonzero(np.concatenate([[True], state[1:] != state[:-1]]))
        last = np.append(cut[1:], len(state)) - 1
        pos = pdf["pos"].to_numpy()
        return pd.DataFrame({"line": pdf["line"].iloc[0], "contig": pdf["contig"].iloc[0], "start": pos[cut], "end": pos[last], "state": state[cut].astype("int32")})

    kind = dict(obs.dtypes)
    return obs.select("line", "contig", "pos", "ref", "alt").groupBy("line", "contig").applyInPandas(run, f"line {kind['line']}, contig {kind['contig']}, start bigint, end bigint, state int")
