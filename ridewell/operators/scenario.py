"""The weather scenario model: daily rows with accounted drops, one least-squares fit for each system."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WEATHER = ("temp_max_c", "temp_min_c", "precip_mm", "snow_cm")
SHARED = ("temp_max_c", "temp_min_c", "precip_log1p_mm", "snow_log1p_cm", "is_weekend")
COEFFICIENT_DIGITS, FIT_DIGITS, FOLDS, REFERENCE_DAYS = 9, 6, 5, 20
FIT = "system_id string, intercept double, names array<string>, coefficients array<double>, days long, parameters long, month_levels long, first_day string, last_day string, r2_log double, adj_r2_log double, residual_sd_log double, r2_trips double, mae_trips double, median_abs_pct_error double, max_daily_trips long, max_daily_date string, smearing_factor double, cv_held_out_days long, cv_r2_log double, cv_median_abs_pct_error double, cv_always_in_train long, refused string"


class Undetermined(ValueError):
    """The rows cannot identify the model that is asked for."""


def daily_rows(daily: DataFrame, weather: DataFrame, incomplete: DataFrame, first_day: str) -> DataFrame:
    """Days with their weather and the first reason for which each is left out (null: used).

    daily: system_id, day, trips. weather: system_id, day and WEATHER. incomplete: system_id, trip_month.
    """
    stub = incomplete.select("system_id", F.col("trip_month").alias("_m"), F.lit(True).alias("_stub"))
    rows = daily.join(weather, ["system_id", "day"], "left").withColumn("_m", F.trunc("day", "month")).join(F.broadcast(stub), ["system_id", "_m"], "left").drop("_m")
    missing = F.lit(False)
    for w in WEATHER:
        missing = missing | F.col(w).isNull()
    reason = F.when(F.col("day") < F.lit(first_day).cast("date"), "before_common_window").when(F.col("_stub"), "incomplete_month").when(missing | (F.col("trips") <= 0), "no_weather_observation")
    return rows.withColumns({"is_weekend": F.weekday("day") >= 5, "block": F.date_format("day", "yyyy-MM"), "reason": reason}).drop("_stub")


def reference_year(days: DataFrame) -> DataFrame:
    """The latest year whose twelve months all have enough used days in every system; null if there is none."""
    used = days.filter("reason is null")
    months = used.groupBy("system_id", F.year("day").cast("long").alias("y"), F.month("day").alias("m")).count().filter(F.col("count") >= REFERENCE_DAYS)
    years = months.groupBy("system_id", "y").count().filter(F.col("count") == 12).groupBy("y").agg(F.countDistinct("system_id").alias("n"))
    systems = days.agg(F.countDistinct("system_id").alias("systems"))
    return years.join(F.broadcast(systems), F.col("n") == F.col("systems")).agg(F.max("y").alias("reference_year"))


def envelope(days: DataFrame) -> DataFrame:
    """Observed range and median of the daily maximum for each month of the year."""
    t = F.col("temp_max_c")
    return days.filter("reason is null").groupBy("system_id", F.month("day").cast("long").alias("month")).agg(F.count("*").alias("days"), F.round(F.min(t), 6).alias("low"), F.round(F.max(t), 6).alias("high"), F.round(F.percentile(t, 0.5), 6).alias("middle"))


def month_blocks(days: DataFrame) -> DataFrame:
    """Per system and month of the year: used days, the median of each input to one place, and days and mean trips of the reference year (0 and null without one)."""
    # The reference year is one row.
    rows = days.filter("reason is null").crossJoin(F.broadcast(reference_year(days)))
    at = F.coalesce(F.year("day") == F.col("reference_year"), F.lit(False))
    middles = [F.round(F.percentile(c, 0.5), 1).alias(f"{c}_median") for c in WEATHER]
    return rows.groupBy("system_id", F.month("day").cast("long").alias("month")).agg(F.count("*").alias("days"), *middles, F.count_if(at).alias("reference_days"), F.avg(F.when(at, F.col("trips"))).alias("reference_mean"))


def ranges(days: DataFrame) -> DataFrame:
    """What the model has seen of each input in each month of the year: system_id, month, <input>_min and <input>_max."""
    sides = [f(c).alias(f"{c}_{n}") for c in WEATHER for f, n in ((F.min, "min"), (F.max, "max"))]
    return days.filter("reason is null").groupBy("system_id", F.month("day").cast("long").alias("month")).agg(*sides)


def design(days: pd.DataFrame, blocks: list[str]) -> np.ndarray:
    """Intercept, weather, weekend, and a level for each month but the first."""
    shared = [days["temp_max_c"], days["temp_min_c"], np.log1p(days["precip_mm"]), np.log1p(days["snow_cm"]), days["is_weekend"].astype(float)]
    levels = [(days["block"] == b).astype(float) for b in blocks[1:]]
    return np.column_stack([np.ones(len(days)), *shared, *levels]).astype(float)


def solve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least squares, refused where columns depend on each other, rounded before anything is derived from it."""
    beta, _, rank, _ = np.linalg.lstsq(x, y, rcond=None)
    if rank < x.shape[1]:
        raise Undetermined(f"rank {rank} for {x.shape[1]} columns")
    return np.round(beta, COEFFICIENT_DIGITS)


def held_out_errors(x: np.ndarray, trips: np.ndarray, block: np.ndarray) -> tuple[int, float, float, int]:
    """Held-out days, their R2 of logarithms and median error in per cent, and days that had to stay in training."""
    logs, fold = np.log(trips), np.arange(len(trips)) % FOLDS
    guess, kept = np.full(len(trips), np.nan), 0
    for f in range(FOLDS):
        test = fold == f
        # A month that would lose all its days keeps those of this fold.
        lone = test & ~np.isin(block, block[~test])
        kept += int(lone.sum())
        test &= ~lone
        if test.any():
            guess[test] = x[test] @ solve(x[~test], logs[~test])
    held = ~np.isnan(guess)
    if held.sum() < len(trips) // 2:
        raise Undetermined(f"only {held.sum()} of {len(trips)} days can be held out")
    y = logs[held]
    r2 = 1 - ((y - guess[held]) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    return int(held.sum()), float(r2), float(np.median(np.abs(trips[held] - np.exp(guess[held])) / trips[held]) * 100), kept


def fit_group(days: pd.DataFrame) -> pd.DataFrame:
    """One system's model; a group has a row for each day, so a few thousand at most."""
    days = days.sort_values("day", ignore_index=True)
    blocks = sorted(days["block"].unique())
    x, trips = design(days, blocks), days["trips"].to_numpy(float)
    n, k = x.shape
    if n <= k:
        raise Undetermined(f"{n} usable days for {k} parameters")
    y = np.log(trips)
    beta = solve(x, y)
    rest, guess = y - x @ beta, np.exp(x @ beta)
    r2 = 1 - (rest**2).sum() / ((y - y.mean()) ** 2).sum()
    top = int(trips.argmax())
    out = {
        "system_id": days["system_id"][0], "intercept": beta[0], "names": [*SHARED, *(f"month_{b}" for b in blocks[1:])], "coefficients": beta[1:].tolist(), "days": n, "parameters": k, "month_levels": len(blocks),
        "first_day": str(days["day"].iloc[0]), "last_day": str(days["day"].iloc[-1]), "r2_log": r2, "adj_r2_log": 1 - (1 - r2) * (n - 1) / (n - k), "residual_sd_log": np.sqrt((rest**2).sum() / (n - k)),
        "r2_trips": 1 - ((trips - guess) ** 2).sum() / ((trips - trips.mean()) ** 2).sum(), "mae_trips": np.abs(trips - guess).mean(), "median_abs_pct_error": np.median(np.abs(trips - guess) / trips) * 100,
        "max_daily_trips": int(trips[top]), "max_daily_date": str(days["day"].iloc[top]), "smearing_factor": np.exp(rest).mean(),
    }
    out |= dict(zip(("cv_held_out_days", "cv_r2_log", "cv_median_abs_pct_error", "cv_always_in_train"), held_out_errors(x, trips, days["block"].to_numpy()), strict=True))
    return pd.DataFrame([{c: round(float(v), FIT_DIGITS) if isinstance(v, (float, np.floating)) and c != "intercept" else v for c, v in out.items()}])


def fit_or_refuse(days: pd.DataFrame) -> pd.DataFrame:
    """fit_group(), or a row that says why this system has no model; the others keep theirs."""
    try:
        made = fit_group(days)
    except Undetermined as why:
        made = pd.DataFrame([{"system_id": days["system_id"].iloc[0], "refused": str(why)}])
    made = made.reindex(columns=[c.split()[0] for c in FIT.split(", ")]).astype(object)
    return made.where(made.notna(), None)


def fit(days: DataFrame) -> DataFrame:
    """A model for each system over its used days; a system whose days determine none has a reason in `refused` instead."""
    used = days.filter("reason is null").select("system_id", "day", F.col("trips").cast("double").alias("trips"), *WEATHER, "is_weekend", "block")
    return used.groupBy("system_id").applyInPandas(fit_or_refuse, FIT)


def predict(models: DataFrame, conditions: DataFrame, *also: str) -> DataFrame:
    """Typical trips, a 95 per cent band and the mean for each condition row (system_id, month block, WEATHER, is_weekend).

    Null where the model has no level for the block.
    """
    c = conditions.join(models, "system_id")
    first = F.date_format(F.col("first_day").cast("date"), "yyyy-MM")
    level = F.when(F.col("block") == first, F.lit(0.0)).otherwise(F.col("coefficients")[F.array_position("names", F.concat(F.lit("month_"), F.col("block"))).cast("int") - 1])
    known = (F.col("block") == first) | F.array_contains("names", F.concat(F.lit("month_"), F.col("block")))
    inputs = (F.col("temp_max_c"), F.col("temp_min_c"), F.log1p("precip_mm"), F.log1p("snow_cm"), F.col("is_weekend").cast("double"))
    total = F.col("intercept") + F.when(known, level)
    for i, v in enumerate(inputs):
        total = total + F.col("coefficients")[i] * v
    band = 1.96 * F.col("residual_sd_log")
    return c.withColumn("_l", total).select("system_id", "block", *also, F.exp("_l").alias("typical"), F.exp(F.col("_l") - band).alias("low"), F.exp(F.col("_l") + band).alias("high"), (F.exp("_l") * F.col("smearing_factor")).alias("mean"))


def moments(models: DataFrame, days: DataFrame) -> DataFrame:
    """Mean product of residual and input, for each input of each model: all are zero where the fit is that of least squares."""
    m = models.filter("refused is null").select("system_id", "intercept", "names", "coefficients")
    d = days.filter("reason is null").join(m, "system_id")
    month = F.concat(F.lit("month_"), F.col("block"))
    plain = dict(zip(SHARED, (F.col("temp_max_c"), F.col("temp_min_c"), F.log1p("precip_mm"), F.log1p("snow_cm"), F.col("is_weekend").cast("double")), strict=True))
    value = lambda name: F.when(name.startswith("month_"), (name == month).cast("double")).otherwise(F.coalesce(*[F.when(name == n, v) for n, v in plain.items()]))
    inputs = F.transform("names", value)
    total = F.aggregate(F.zip_with(inputs, "coefficients", lambda a, b: a * b), F.col("intercept"), lambda a, x: a + x)
    rows = d.select("system_id", (F.log("trips") - total).alias("_r"), F.explode(F.arrays_zip(F.concat(F.array(F.lit("intercept")), "names").alias("name"), F.concat(F.array(F.lit(1.0)), inputs).alias("value"))).alias("_x"))
    return rows.groupBy("system_id", F.col("_x.name").alias("name")).agg(F.avg(F.col("_r") * F.col("_x.value")).alias("moment"))


def answers(models: DataFrame, seen: DataFrame, conditions: DataFrame) -> DataFrame:
    """predict(), but for conditions that the model cannot speak of, which have a `refusal` in place of figures.

    seen: ranges(). conditions: system_id, block and the inputs. A block without a level, an input
    outside what that month of the year has shown, or a low above the high are refused, in this order.
    """
    names = F.concat(F.lit("month_"), F.col("block"))
    known = models.filter("refused is null").select("system_id", F.date_format(F.col("first_day").cast("date"), "yyyy-MM").alias("_first"), F.col("names").alias("_names"))
    rows = conditions.withColumn("month", F.substring("block", 6, 2).cast("long")).join(known, "system_id", "left").join(seen, ["system_id", "month"], "left")
    level = F.coalesce((F.col("block") == F.col("_first")) | F.array_contains("_names", names), F.lit(False))
    refusal = F.when(~level, "no level for the month")
    for c in WEATHER:
        refusal = refusal.when(~F.coalesce(F.col(c).between(F.col(f"{c}_min"), F.col(f"{c}_max")), F.lit(False)), f"{c} outside what was seen")
    refusal = refusal.when(F.col("temp_min_c") > F.col("temp_max_c"), "low above high")
    told = rows.withColumn("refusal", refusal).select(*conditions.columns, "refusal").withColumn("_id", F.xxhash64(*conditions.columns))
    figures = predict(models, told.filter("refusal is null").select("system_id", F.col("block"), *WEATHER, "is_weekend", "_id"), "_id").drop("system_id", "block")
    return told.join(figures.dropDuplicates(["_id"]), "_id", "left").drop("_id")


def busiest_day(daily: DataFrame) -> DataFrame:
    order = Window.partitionBy("system_id").orderBy(F.desc("trips"), "day")
    return daily.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select("system_id", "day", "trips")
