"""Randomised runs of SCD2 and upsert against small pure-Python models of their semantics."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from premiumlake.operators import history as H

SCHEMA = "id string, status string, amount int, note string"


def model_scd2(history, current, at):
    """history: list of dicts (id, status, amount, note, valid_from, valid_to, is_current)."""
    out = [dict(h) for h in history if not h["is_current"]]
    open_ = {h["id"]: dict(h) for h in history if h["is_current"]}
    cur = {r["id"]: r for r in current}
    for k, h in open_.items():
        c = cur.get(k)
        if c is None or (c["status"], c["amount"]) != (h["status"], h["amount"]):
            h.update(valid_to=at, is_current=False)
        out.append(h)
    for k, c in cur.items():
        h = open_.get(k)
        if h is None or (c["status"], c["amount"]) != (h["status"], h["amount"]):
            out.append({**c, "valid_from": at, "valid_to": None, "is_current": True})
    return out


def rows_of(df):
    return sorted(
        (tuple(r[c] for c in ("id", "status", "amount", "note", "valid_from", "valid_to", "is_current")) for r in df.collect()),
        key=repr,
    )


def as_tuples(model):
    return sorted(
        (tuple(m[c] for c in ("id", "status", "amount", "note", "valid_from", "valid_to", "is_current")) for m in model),
        key=repr,
    )


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_scd2_matches_model_over_runs(spark, seed):
    rnd = random.Random(seed)
    keys = [str(i) for i in range(40)]
    history_df, model = None, []
    for run in range(4):
        at = dt.datetime(2025, 1 + run, 1)
        present = [k for k in keys if rnd.random() < 0.8]  # some keys vanish, some come back
        current = [
            {"id": k, "status": rnd.choice(["a", "b", None]), "amount": rnd.choice([1, 2, None]), "note": rnd.choice(["x", "y"])}
            for k in present
        ]
        df = spark.createDataFrame([(c["id"], c["status"], c["amount"], c["note"]) for c in current], SCHEMA)
        history_df = H.scd2_snapshot(history_df, df, "id", ["status", "amount"], at)
        history_df = spark.createDataFrame(history_df.collect(), history_df.schema)  # plain input for the next run
        model = model_scd2(model, current, at)
        assert rows_of(history_df) == as_tuples(model), f"run {run}"


@pytest.mark.parametrize("seed", [21, 22])
def test_upsert_matches_model(spark, seed):
    rnd = random.Random(seed)
    target = {i: (f"n{i}", rnd.randint(0, 9), f"keep{i}") for i in range(0, 60, 2)}
    batch = {i: (f"m{i}", rnd.randint(10, 19), f"new{i}") for i in rnd.sample(range(80), 35)}
    tdf = spark.createDataFrame([(k, *v) for k, v in target.items()], "k int, name string, score int, extra string")
    bdf = spark.createDataFrame([(k, *v) for k, v in batch.items()], "k int, name string, score int, extra string")
    got = {r.k: (r.name, r.score, r.extra) for r in H.upsert(tdf, bdf, ["k"], ["score"]).collect()}
    want = dict(target)
    for k, (name, score, extra) in batch.items():
        want[k] = (target[k][0], score, target[k][2]) if k in target else (name, score, extra)
    assert got == want
