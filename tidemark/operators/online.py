"""Change-point filtering of a stream: the run-length posterior as state, one per series.

The state is what `changepoint.run_length_filter` holds between two periods, so a stream gives what
the batch gives. Run lengths whose weight is negligible are pruned; the mass that goes is reported
with every period and added up, so the state stays small and its error is known.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark import knowledge as K
from tidemark.session import ship_package

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PRUNE = 1e-13  # mass that one period may lose
SMALLEST = 1e-300
STATE = ("n long, last double, pruned double, late long, runs array<long>, weight array<double>, "
         "mu array<double>, beta array<double>")


class RunLengths:
    """The posterior over run lengths after some periods; see `changepoint.run_length_filter`."""

    def __init__(self, mu_0: float, beta_0: float):
        self.n, self.last, self.pruned, self.late = 0, -math.inf, 0.0, 0
        self.runs = np.zeros(1, np.int64)
        self.weight, self.mu = np.ones(1), np.array([mu_0])
        self.beta = np.array([max(beta_0, SMALLEST)])

    def state(self) -> tuple:
        return (self.n, self.last, self.pruned, self.late, self.runs.tolist(), self.weight.tolist(),
                self.mu.tolist(), self.beta.tolist())

    @classmethod
    def of(cls, state) -> RunLengths:
        self = cls(0.0, 1.0)
        self.n, self.last, self.pruned, self.late = state[:4]
        self.runs = np.asarray(state[4], np.int64)
        self.weight, self.mu, self.beta = (np.asarray(s, float) for s in state[5:])
        return self

    def observe(self, x: float, mu_0: float, beta_0: float, hazard: float, prune: float,
                short_run: int = K.CP_SHORT_RUN) -> tuple[float, float, float]:
        """P(run <= short_run), E[run] and the mass pruned after one more observation."""
        kappa, alpha = 1.0 + self.runs, 1.0 + self.runs / 2.0
        shape = np.array([math.lgamma(a + 0.5) - math.lgamma(a) - 0.5 * math.log(2 * math.pi * a)
                          for a in alpha])
        spread = self.beta * (kappa + 1.0) / (alpha * kappa)
        off = (x - self.mu) ** 2
        with np.errstate(divide="ignore"):
            joint = (np.log(self.weight) + shape - 0.5 * np.log(spread)
                     - (alpha + 0.5) * np.log1p(off / (2.0 * alpha * spread)))
        joint = np.exp(joint - joint.max())
        weight = np.concatenate(([joint.sum() / hazard], joint * (1.0 - 1.0 / hazard)))
        weight /= weight.sum()
        self.runs = np.concatenate(([0], self.runs + 1))
        self.beta = np.concatenate(([max(beta_0, SMALLEST)],
                                    self.beta + kappa * off / (2.0 * (kappa + 1.0))))
        self.mu = np.concatenate(([mu_0], (kappa * self.mu + x) / (kappa + 1.0)))
        lightest = np.argsort(weight, kind="stable")
        gone = lightest[np.cumsum(weight[lightest]) <= prune]
        lost = float(weight[gone].sum())
        keep = np.ones(len(weight), bool)
        keep[gone] = False
        short = float(weight[self.runs <= short_run].sum())
        expected = float(self.runs @ weight)
        self.runs, self.beta, self.mu = self.runs[keep], self.beta[keep], self.mu[keep]
        self.weight = weight[keep] / (1.0 - lost)
        self.n += 1
        self.pruned += lost
        return short, expected, lost


class OnlineFilter(StatefulProcessor):
    """Periods of a series in order; a period not after the last one is late and only counted."""

    def __init__(self, keys: list[str], prune: float):
        self.keys, self.prune = keys, prune

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("posterior", STATE)

    def handleInputRows(self, key, rows, timerValues):
        came = pd.concat(list(rows)).sort_values("at", kind="stable")
        first = came.iloc[0]
        found = (RunLengths.of(tuple(self.held.get())) if self.held.exists()
                 else RunLengths(first["mu_0"], first["beta_0"]))
        out = []
        for row in came.itertuples(index=False):
            if row.at <= found.last:
                found.late += 1
                continue
            t, found.last = found.n, float(row.at)
            short, expected, lost = found.observe(row.x, row.mu_0, row.beta_0, row.hazard, self.prune)
            out.append((*key, row.at, t, row.x, short, expected, lost, found.pruned, found.late,
                        len(found.runs)))
        self.held.update(found.state())
        yield pd.DataFrame(out, columns=[*self.keys, "at", "t", "x", "cp_prob", "exp_run_length",
                                         "pruned", "pruned_in_all", "late", "held_runs"])

    def close(self) -> None:
        pass


def online_probabilities(stream: DataFrame, priors: DataFrame, keys: list[str], order: str,
                         value: str, hazard: float = K.DEFAULT_HAZARD,
                         prune: float = PRUNE) -> DataFrame:
    """``cp_prob`` and ``exp_run_length`` of every new period of a stream of rolled-up series.

    ``priors`` (keys, ``mu_0``, ``beta_0``) is a static table. The order column is a date or a
    number; a series' periods must arrive in its order, as far as they come in different batches.
    Rows without a value are left out. Returns keys, order column, ``t``, value, ``cp_prob``,
    ``exp_run_length``, ``pruned`` (mass lost in this period), ``pruned_in_all``, ``late`` (periods
    left out so far because they came too late) and ``held_runs``.
    The session needs the RocksDB state store.
    """
    is_date = dict(stream.dtypes)[order] == "date"
    at = F.unix_date(order).cast("double") if is_date else F.col(order).cast("double")
    ready = stream.where(F.col(value).isNotNull()).join(priors, keys).select(
        *keys, at.alias("at"), F.col(value).cast("double").alias("x"),
        F.col("mu_0").cast("double"), F.col("beta_0").cast("double"),
        F.lit(float(hazard)).alias("hazard"))
    types = {f.name: f.dataType.simpleString() for f in ready.schema}
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys),
                        "at double, t long, x double, cp_prob double, exp_run_length double, "
                        "pruned double, pruned_in_all double, late long, held_runs long"])
    ship_package(stream.sparkSession)
    found = ready.groupBy(*keys).transformWithStateInPandas(
        OnlineFilter(keys, prune), schema, "Append", "None")
    back = F.date_from_unix_date(F.col("at").cast("int")) if is_date else F.col("at").cast(
        stream.schema[order].dataType)
    return found.select(*keys, back.alias(order), "t", F.col("x").alias(value), "cp_prob",
                        "exp_run_length", "pruned", "pruned_in_all", "late", "held_runs")
