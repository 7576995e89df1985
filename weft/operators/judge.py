"""Judging candidate lists, in batches that can be taken up again.

A judge is any function from a request (dict) to a verdict (dict with match_dhis2_uid, confidence, reason); the one at
hand follows rules. It runs in the executors, with retries; a row whose judge fails to the end is left out and is tried
again by the next run.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERDICT = "match_dhis2_uid string, confidence string, reason string"


def rule_judge(request: dict) -> dict:
    """The best candidate whose name is near and whose places agree."""
    best = None
    for c in request["candidates"]:
        same = sum(bool(request.get(k)) and request.get(k) == c.get(k) for k in ("zone", "woreda"))
        score = float(c["score"]) / 100 * 0.8 + 0.1 * same
        if best is None or score > best[0]:
            best = (score, same, c)
    if best is None or best[0] < 0.64:
        return {"match_dhis2_uid": None, "confidence": "none", "reason": "No candidate is near enough"}
    level = "high" if best[0] >= 0.85 else "medium" if best[0] >= 0.75 else "low"
    return {"match_dhis2_uid": best[2]["uid"], "confidence": level, "reason": f"Name score {float(best[2]['score']):.1f}, {best[1]} places agree"}


def with_retries(judge: Callable[[dict], dict], tries: int = 3, wait: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Callable[[dict], dict]:
    """Up to so many tries, waiting 1, 2, 4 ... times `wait` in between; the last error is raised."""

    def call(request: dict) -> dict:
        for k in range(tries):
            try:
                return judge(request)
            except Exception:  # noqa: BLE001 - whatever the judge's service raises
                if k == tries - 1:
                    raise
                sleep(wait * 2**k)
        raise AssertionError

    return call


def judge_rows(rows: DataFrame, key: str, judge: Callable[[dict], dict] = rule_judge, *, tries: int = 3, wait: float = 1.0) -> DataFrame:
    """(key, match_dhis2_uid, confidence, reason). rows: key, request fields, candidates as a JSON list or null."""
    columns = [c for c in rows.columns if c not in (key, "candidates")]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = with_retries(judge, tries, wait)
        for pdf in it:
            none = pdf["candidates"].isna() | (pdf["candidates"] == "")
            if none.any():
                yield pd.DataFrame({key: pdf.loc[none, key], "match_dhis2_uid": None, "confidence": "none", "reason": "No candidates in the region"})
            out = []
            for r in pdf[~none].to_dict("records"):
                try:
                    v = call({c: r[c] for c in columns} | {"candidates": json.loads(r["candidates"])})
                except Exception:  # noqa: BLE001 - left for the next run
                    continue
                uid = v.get("match_dhis2_uid")
                out.append((r[key], None if uid in ("", "null", None) else uid, v.get("confidence") or "none", v.get("reason")))
            yield pd.DataFrame(out, columns=[key, "match_dhis2_uid", "confidence", "reason"])

    return rows.mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, {VERDICT}")


def todo(rows: DataFrame, done: DataFrame | None, key: str) -> DataFrame:
    """Rows no earlier run has written."""
    return rows if done is None else rows.join(done.select(key).distinct(), key, "left_anti")


def parse_verdict(c):
    return F.from_json(c, VERDICT)
