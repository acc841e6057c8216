"""Audit of filters that run one after another, over every order of them.

A document's failures are a row of the mask matrix (0 where it fails, infinite
where it passes); an order of the filters is a row of its inverse permutation
(the step at which each filter runs). The min-plus product of both, that is the
minimum over the filters of mask plus position, is the step at which the
document leaves under that order. Documents with equal failures leave together,
so they are counted per part and mask first, and the steps drive weighted
scatter counts: removed at a step, and, per filter, failing but removed earlier.

There are at most 2^filters masks per part and filters! orders, whatever the
number of documents; ``MAX_FILTERS`` bounds both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.session import materialize, materialize_counted

MAX_FILTERS = 7
#: Up to so many texts with copies are broadcast; more are joined by a shuffle.
MAX_BROADCAST_COPIES = 500_000
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def positions(filters: int) -> np.ndarray:
    """orders x filters: the step (from 1) at which each filter runs, orders as ``permutations`` has them."""
    orders = np.array(list(permutations(range(filters))))
    steps = np.empty_like(orders)
    np.put_along_axis(steps, orders, np.arange(1, filters + 1)[None, :], axis=1)
    return steps


def removal_steps(masks: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """masks (bit k: fails filter k) x orders: the step of removal, filters + 1 if never."""
    n = steps.shape[1]
    fails = (masks[:, None] >> np.arange(n)) & 1
    return np.where(fails[:, None, :] == 1, steps[None, :, :], n + 1).min(axis=2)


def audit_masks(masks: np.ndarray, counts: np.ndarray, names: Sequence[str]) -> pd.DataFrame:
    """One row per order and step. ``counts``: masks x weights, the first of
    which is the number of documents; the others give ``lost_<i>`` (removed here)."""
    n = len(names)
    steps = positions(n)
    orders = len(steps)
    gone = removal_steps(masks, steps)
    at = np.broadcast_to(np.arange(orders), gone.shape)
    sums = np.zeros((counts.shape[1], orders, n + 2), np.int64)
    for w, out in enumerate(sums):
        np.add.at(out, (at, gone), np.broadcast_to(counts[:, w, None], gone.shape))
    fails = ((masks[:, None] >> np.arange(n)) & 1).astype(bool)
    redundant = np.zeros((orders, n), np.int64)
    for f in range(n):
        earlier = fails[:, f, None] & (gone < steps[None, :, f])
        redundant[:, f] = (earlier * counts[:, 0, None]).sum(axis=0)
    only = np.array([counts[masks == 1 << f, 0].sum() for f in range(n)])
    order = np.argsort(steps, axis=1)  # the filter that runs at each step
    removed = sums[:, :, 1 : n + 1]
    by_filter = np.zeros(n, np.int64)
    np.add.at(by_filter, order, removed[0])
    out = {
        "filter_order": np.repeat(["".join(names[f] for f in o) for o in order], n),
        "step": np.tile(np.arange(1, n + 1), orders),
        "kept": (counts[:, 0].sum() - np.cumsum(removed[0], axis=1)).ravel(),
        "removed": removed[0].ravel(),
        "redundant": np.take_along_axis(redundant, order, axis=1).ravel(),
        "unique_fails": only[order].ravel(),
        "shapley": by_filter[order].ravel(),
    }
    out |= {f"lost_{w}": removed[w].ravel() for w in range(1, len(removed))}
    return pd.DataFrame(out)


def audit(rows: DataFrame, part: str, filters: Mapping[str, Column], lost: Mapping[str, Column]) -> DataFrame:
    """One row per ``part``, order of ``filters`` (name: failure condition) and
    step: kept, removed, redundant, unique_fails, shapley (removed by the step's
    filter over all orders) and, for each of ``lost`` (name: condition), the
    documents of that condition that are removed at the step.

    A NULL part is the empty string, a NULL condition is false. An empty table
    gives no rows, as it has no part.
    """
    names = list(filters)
    if len(names) > MAX_FILTERS or any(len(x) != 1 for x in names):
        raise ValueError(f"at most {MAX_FILTERS} filters, named by single letters")
    mask = sum((F.when(c, F.lit(1 << k)).otherwise(0) for k, c in enumerate(filters.values())), F.lit(0))
    conditions = {f"w{k}": F.when(c, 1).otherwise(0) for k, c in enumerate(lost.values(), 1)}
    rows = rows.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        mask.alias("mask"),
        *[c.alias(k) for k, c in conditions.items()],
    )
    counted = rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("w0"), *[F.sum(k).cast("long").alias(k) for k in conditions]
    )
    lost_names = list(lost)
    weighted = [f"w{k}" for k in range(len(lost) + 1)]
    cols = ["kept", "removed", "redundant", "unique_fails", *lost_names, "shapley"]

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out = audit_masks(group["mask"].to_numpy(np.int64), group[weighted].to_numpy(np.int64), names)
        out = out.rename(columns={f"lost_{k}": x for k, x in enumerate(lost_names, 1)})
        out.insert(0, "part", key[0])
        return out[["part", "filter_order", "step", *cols]]

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in cols)
    return counted.groupBy("part").applyInPandas(run, schema)


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions of a text by itself: few words (A), few distinct words
    (B), many capitals (C), markup characters (D)."""
    words = F.array_remove(F.split(text, SPACE, -1), "")
    upper = F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": upper * 100 > F.char_length(text) * 10,
        "D": text.rlike("[#$%&*|]"),
    }


def document_failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): ``part``, the conditions A to D
    of ``text_failures``, E (the text of a smaller doc_id is identical), ``good``
    and ``toxic`` (some row of ``labels`` says quality 1, toxic 1).

    The texts are read once; what is shuffled is their SHA-256. A NULL text is
    empty, a NULL doc_id has no smaller one and no label. Rows are judged one by
    one: rows repeated with one doc_id are no copies of each other.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.col("lang").alias("lang"), text.alias("text"))
    tests = text_failures(F.col("text"))
    rows = rows.select(
        "doc_id", "lang", *[c.alias(k) for k, c in tests.items()], F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")
    )
    rows = materialize(rows, "audit-rows")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first, seen = materialize_counted(first.where("first < last").drop("last"), "audit-copies")
    first = F.broadcast(first) if seen["rows"] <= MAX_BROADCAST_COPIES else first
    said = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    out = rows.join(first, "digest", "left").join(said, "doc_id", "left")
    return out.select("lang", *tests, (F.col("doc_id") > F.col("first")).alias("E"), "good", "toxic")


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the five filters of ``document_failures`` per language."""
    rows = document_failures(docs, labels)
    lost = {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")}
    return audit(rows, "lang", {k: F.col(k) for k in "ABCDE"}, lost)
