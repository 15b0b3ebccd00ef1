"""Autoregressive moving-average forecasts of differenced closes, refitted on all history at every row.

Least squares needs only sums of products.  Sums up to a row are a running sum inside its block plus the totals of the
blocks before it, so a model per row costs one pass of windows and one batched solve, however long the series is.  The
moving-average part regresses on past innovations, which are the one-step errors of a longer autoregression that is itself refitted at
every row; no row sees a later close.

With coefficients that stay fixed, innovations follow ``e[t] = u[t] - theta1*e[t-1] - theta2*e[t-2]``.  A block folds into a small
matrix map of the state before it, a prefix scan by doubling composes the maps, and each row adds what the true
state still contributes.  Results do not depend on the block length.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.ordered import BLOCK_ROWS, block_window, into_blocks, own_rows, with_positions
from tickloom.session import cut_lineage, measured

AR, MA = 5, 2
#: Lags of the autoregression whose errors stand for the innovations.
LONG_AR = 8
#: Roots of the moving-average part stay this far inside the unit circle, so old innovations fade.
MOST = 0.98


def _series(keys: Sequence[str]) -> Column:
    """Keys as a struct, in which nulls are equal."""
    return F.struct(*[F.col(k) for k in keys], F.lit(0).alias("_all"))


def _block(block_rows: int) -> Column:
    return F.expr(f"(pos - 1) div {block_rows}")


def _solver(k: int):
    """Coefficients of rows of normal equations in one call; NULL where too few rows or dependent columns leave them open."""
    upper = np.triu_indices(k)

    @F.pandas_udf("array<double>")
    def solve(gram: pd.Series, moment: pd.Series, n: pd.Series) -> pd.Series:
        full = np.zeros((len(n), k, k))
        full[:, upper[0], upper[1]] = np.array(gram.tolist()).reshape(-1, len(upper[0]))
        full[:, upper[1], upper[0]] = full[:, upper[0], upper[1]]
        right = np.array(moment.tolist()).reshape(-1, k)
        scale = np.sqrt(np.maximum(np.einsum("nii->ni", full), 0))
        good = (n.to_numpy() >= 2 * k) & (scale > 0).all(axis=1) & np.isfinite(full).all(axis=(1, 2)) & np.isfinite(right).all(axis=1)
        unit = full[good] / (scale[good][:, :, None] * scale[good][:, None, :])
        clear = np.linalg.det(unit) > 1e-9
        good[good] = clear
        found = np.linalg.solve(unit[clear], (right[good] / scale[good])[:, :, None])[:, :, 0] / scale[good]
        answers = iter(found.tolist())
        return pd.Series([next(answers) if g else None for g in good.tolist()], dtype=object)

    return solve


def running_sums(rows: DataFrame, keys: Sequence[str], xs: Sequence[str], y: str, through: bool, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``n``, ``gram`` (upper triangle by rows) and ``moment`` of all rows of the series before this one, or up to it with ``through``.

    ``rows`` is stored and has ``pos``.  A row counts if none of ``xs`` and ``y`` is null.  Block totals are one line a block.
    """
    known = F.col(y).isNotNull()
    for x in xs:
        known &= F.col(x).isNotNull()
    pairs = [(a, b) for i, a in enumerate(xs) for b in xs[i:]]
    parts = {"_n": F.lit(1.0)} | {f"_g{i}": F.col(a) * F.col(b) for i, (a, b) in enumerate(pairs)} | {f"_m{i}": F.col(x) * F.col(y) for i, x in enumerate(xs)}
    placed = rows.withColumns({"_series": _series(keys), "_block": _block(block_rows)} | {c: F.when(known, v).otherwise(0.0) for c, v in parts.items()})
    totals = measured(placed.groupBy("_series", "_block").agg(*[F.sum(c).alias(c) for c in parts]), "block-sums")
    line = Window.partitionBy("_series").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_series", "_block", *[F.coalesce(F.sum(c).over(line), F.lit(0.0)).alias(f"{c}_before") for c in parts])
    inside = Window.partitionBy("_series", "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow if through else -1)
    summed = placed.withColumns({c: F.coalesce(F.sum(c).over(inside), F.lit(0.0)) for c in parts}).join(measured(before, "sums-before"), ["_series", "_block"])
    whole = {c: F.col(c) + F.col(f"{c}_before") for c in parts}
    return summed.select(*rows.columns, whole["_n"].cast("long").alias("n"),
                         F.array(*[whole[f"_g{i}"] for i in range(len(pairs))]).alias("gram"), F.array(*[whole[f"_m{i}"] for i in range(len(xs))]).alias("moment"))


def running_fit(rows: DataFrame, keys: Sequence[str], xs: Sequence[str], y: str, name: str, through: bool, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``name``: least-squares coefficients of ``y`` on ``xs`` over the rows before this one (or up to it)."""
    sums = running_sums(rows, keys, xs, y, through, block_rows)
    return sums.withColumn(name, _solver(len(xs))("gram", "moment", "n")).drop("n", "gram", "moment")


def _dot(coefficients: str, columns: Sequence[Column]) -> Column:
    return sum((F.col(coefficients)[i] * c for i, c in enumerate(columns)), F.lit(0.0))


def with_changes(fact: DataFrame, lags: int, keys: Sequence[str] = ("ticker_id",), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Stored rows with ``pos`` and ``d1..d<lags>``, the latest changes of the close, newest first."""
    placed = with_positions(fact, keys, ["date_id"], F.expr("date_id div 10000"))
    over = block_window(keys)
    closes = [F.col("close"), *[F.lag("close", i).over(over) for i in range(1, lags + 1)]]
    rows = own_rows(into_blocks(placed, back=lags, block_rows=block_rows).withColumns({f"d{i + 1}": closes[i] - closes[i + 1] for i in range(lags)}), "series_rows")
    return cut_lineage(rows, "changes")


def expanding_models(fact: DataFrame, keys: Sequence[str] = ("ticker_id",), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Stored rows with ``model``, the AR and MA coefficients fitted on all closes up to the row, and ``e0, e1``, its last innovations.

    Rows are one per series and ``date_id``.  ``model`` is NULL until the history is long enough, ``e0`` until the longer autoregression has one.
    """
    rows = with_changes(fact, LONG_AR + 1, keys, block_rows)
    longer = running_fit(rows, keys, [f"d{i}" for i in range(2, LONG_AR + 2)], "d1", "_long", through=False, block_rows=block_rows)
    error = F.col("d1") - _dot("_long", [F.col(f"d{i}") for i in range(2, LONG_AR + 2)])
    errors = cut_lineage(longer.withColumn("e0", error).drop("_long"), "innovations")
    over = block_window(keys)
    lagged = own_rows(into_blocks(errors, back=MA, block_rows=block_rows).withColumns({f"e{i}": F.lag("e0", i).over(over) for i in range(1, MA + 1)}))
    lagged = cut_lineage(lagged, "innovations")
    xs = [*[f"d{i}" for i in range(2, AR + 2)], *[f"e{i}" for i in range(1, MA + 1)]]
    return running_fit(lagged, keys, xs, "d1", "model", through=True, block_rows=block_rows)


def expanding_forecast(fact: DataFrame, keys: Sequence[str] = ("ticker_id",), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``fact`` with ``predicted``: the next close from a model of everything known at the row; the close where there is none."""
    rows = expanding_models(fact, keys, block_rows)
    now = [*[F.col(f"d{i}") for i in range(1, AR + 1)], *[F.col(f"e{i}") for i in range(MA)]]
    return rows.select(*fact.columns, F.coalesce(F.col("close") + _dot("model", now), F.col("close")).alias("predicted"))


# --- one fit, kept ---------------------------------------------------------------------------


def _invertible(theta: Sequence[float]) -> list[float]:
    """The same spectrum with all roots inside the unit circle."""
    roots = np.roots([1.0, *theta])
    size = np.maximum(np.abs(roots), 1e-12)
    inner = np.where(size > 1, roots / size ** 2, roots)
    inner = inner * np.minimum(1.0, MOST / np.maximum(np.abs(inner), 1e-12))
    return np.real(np.poly(np.append(inner, np.zeros(len(theta) - len(roots)))))[1:].tolist()


def kept_models(models: DataFrame, keys: Sequence[str] = ("ticker_id",)) -> DataFrame:
    """(keys, date_id, phi, theta): the model of each series' latest row, with an invertible moving-average part.

    ``models`` comes from ``expanding_models``, perhaps filtered to training rows.  A series without a model has none here.
    """
    @F.pandas_udf("array<double>")
    def invertible(theta: pd.Series) -> pd.Series:
        return pd.Series([_invertible(t) for t in theta])

    known = models.filter("model is not null").groupBy(*keys).agg(F.max("date_id").alias("date_id"), F.max_by("model", "date_id").alias("model"))
    return known.select(*keys, "date_id", F.slice("model", 1, AR).alias("phi"), invertible(F.slice("model", AR + 1, MA)).alias("theta"))


def innovations(rows: DataFrame, models: DataFrame, keys: Sequence[str] = ("ticker_id",), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``phi``, ``theta`` and the innovations ``e0`` (of the row) and ``e1`` under them; they are zero before the first full row.

    ``rows`` comes from ``with_changes`` with ``AR + 1`` lags or more.  Series without a model keep NULL coefficients.
    """
    joined = rows.join(measured(models.select(*keys, "phi", "theta"), "kept-models"), list(keys), "left")
    u = F.coalesce(F.col("d1") - _dot("phi", [F.col(f"d{i}") for i in range(2, AR + 2)]), F.lit(0.0))
    blocks = joined.select("*", u.alias("_u"), *[F.coalesce(F.col("theta")[i], F.lit(0.0)).alias(f"_t{i + 1}") for i in range(2)], _block(block_rows).alias("_block"))
    names = ["_z0", "_z1", "_h0", "_h1", "_k0", "_k1"]

    def respond(block: pd.DataFrame) -> pd.DataFrame:
        """Innovations of a block that starts from nothing, and what a state of one would leave at each row."""
        block = block.sort_values("pos")
        first, second = block["_t1"].iloc[0], block["_t2"].iloc[0]
        for name, (now, before), drive in (("_z", (0.0, 0.0), block["_u"].tolist()), ("_h", (1.0, 0.0), None), ("_k", (0.0, 1.0), None)):
            out = []
            for i in range(len(block)):
                now, before = (drive[i] if drive else 0.0) - first * now - second * before, now
                out.append((now, before))
            block[f"{name}0"], block[f"{name}1"] = zip(*out)
        return block

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema.fields] + [f"{n} double" for n in names])
    answered = cut_lineage(blocks.groupBy(*keys, "_block").applyInPandas(respond, schema), "responses").withColumn("_series", _series(keys))
    line = Window.partitionBy("_series").orderBy("_block")
    last = answered.groupBy("_series", "_block").agg(F.max_by(F.struct(*names), "pos").alias("m"))
    maps = measured(last.select("_series", "_block", "m.*"), "maps")
    longest, reach = maps.agg(F.max("_block").alias("n")).first()["n"] or 0, 1
    while reach <= longest:
        # this block after the blocks before it: both the matrix (h, k) and the offset z
        far = {n: F.coalesce(F.lag(n, reach).over(line), F.lit(1.0 if n in ("_h0", "_k1") else 0.0)) for n in names}
        maps = maps.withColumns({f"{c}{i}": F.col(f"_h{i}") * far[f"{c}0"] + F.col(f"_k{i}") * far[f"{c}1"] + (F.col(f"_z{i}") if c == "_z" else 0.0)
                                 for c in ("_z", "_h", "_k") for i in (0, 1)})
        reach *= 2
    carried = maps.select("_series", "_block", *[F.coalesce(F.lag(f"_z{i}").over(line), F.lit(0.0)).alias(f"_s{i}") for i in (0, 1)])
    true = {f"e{i}": F.col(f"_z{i}") + F.col(f"_h{i}") * F.col("_s0") + F.col(f"_k{i}") * F.col("_s1") for i in (0, 1)}
    return answered.join(measured(carried, "states"), ["_series", "_block"]).select(*joined.columns, *[c.alias(n) for n, c in true.items()])


def kept_forecast(fact: DataFrame, models: DataFrame, keys: Sequence[str] = ("ticker_id",), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``fact`` with ``predicted``: the next close under models that stay as they are; the close where a series has none."""
    rows = innovations(with_changes(fact, AR + 1, keys, block_rows), models, keys, block_rows)
    step = _dot("phi", [F.col(f"d{i}") for i in range(1, AR + 1)]) + _dot("theta", [F.col("e0"), F.col("e1")])
    return rows.select(*fact.columns, F.coalesce(F.col("close") + step, F.col("close")).alias("predicted"))
