"""Weekly demand features, a regression on them, and its evaluation."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.numbers import exact_avg, exact_sum, half_up, safe_divide
from larkspur.operators.ordered import neighbour
from larkspur.operators.sets import replicate
from larkspur.session import cut

TARGET = "next_week_units_sold"

# Product and week attributes with the names the features go by.
PRODUCT_FEATURES = {
    "category": "category", "list_price": "list_price", "cost_price": "cost_price", "margin_pct": "margin_pct",
    "stock_quantity": "stock_quantity", "rating": "rating", "review_count": "review_count",
    "units_sold": "lifetime_units_sold", "revenue": "lifetime_revenue", "rank_in_category": "rank_in_category",
    "overall_revenue_rank": "overall_revenue_rank", "return_rate": "return_rate", "active_sale_days": "active_sale_days",
}
WEEK_FEATURES = {
    "units_sold": "current_week_units_sold", "order_count": "current_week_orders", "weekly_revenue": "current_week_revenue",
    "unique_buyers": "current_week_buyers", "avg_selling_price": "avg_selling_price",
}


def _week(name):
    return F.to_date(F.date_trunc("week", name)).alias("week_start")


def weekly_sales(orders: DataFrame) -> DataFrame:
    """Sales per product and week; staged orders have one row per order."""
    sold = F.col("order_status") != "cancelled"
    return orders.groupBy("product_id", _week("order_date")).agg(
        F.sum(F.when(sold, F.col("quantity")).otherwise(0)).alias("units_sold"),
        F.count_if(sold).alias("order_count"),
        exact_sum(F.when(sold, F.col("total_amount")).otherwise(0.0)).alias("weekly_revenue"),
        F.count_distinct("customer_id").alias("unique_buyers"),
        half_up(exact_avg(F.when(sold, F.col("unit_price"))), 2).alias("avg_selling_price"),
    )


def training_features(orders: DataFrame, performance: DataFrame, daily: DataFrame, copies: int = 1) -> DataFrame:
    """One row per product and week with the units of the next week that had sales; the last week drops out."""
    weeks = neighbour(cut(weekly_sales(orders)), ["product_id"], ["week_start"], "units_sold", -1, TARGET)
    weeks = weeks.filter(F.col(TARGET).isNotNull()).select(
        "product_id", "week_start", TARGET, *[F.col(a).alias(b) for a, b in WEEK_FEATURES.items()]
    )
    products = performance.select("product_id", "product_name", *[F.col(a).alias(b) for a, b in PRODUCT_FEATURES.items()])
    platform = daily.groupBy(_week("order_date")).agg(
        exact_sum("total_revenue").alias("platform_weekly_revenue"), F.sum("order_count").alias("platform_weekly_orders"),
        half_up(exact_avg("total_revenue"), 2).alias("platform_avg_daily_revenue"),
    )
    share = safe_divide("current_week_revenue", F.nullif(F.col("platform_weekly_revenue"), F.lit(0.0))) * 100
    rows = (
        weeks.join(products, "product_id")
        .join(platform, "week_start", "left")
        .withColumn("pct_of_platform_revenue", half_up(share, 4))
        .fillna({"platform_weekly_revenue": 0.0, "platform_weekly_orders": 0, "platform_avg_daily_revenue": 0.0})
    )
    return replicate(rows, copies) if copies > 1 else rows


def training_stats(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("product_id").alias("unique_products"),
        F.count_distinct("week_start").alias("unique_weeks"),
        F.count_distinct("category").alias("unique_categories"),
        half_up(exact_avg(TARGET), 2).alias("avg_target"),
        F.min(TARGET).alias("min_target"),
        F.max(TARGET).alias("max_target"),
        half_up(F.stddev_samp(TARGET), 2).alias("stddev_target"),
        F.count_if(F.col(TARGET).isNull()).alias("null_targets"),
    )


def require_trainable(features: DataFrame) -> int:
    """Row count, or an error when there are no rows or some lack the target."""
    found = training_stats(features).select("total_rows", "null_targets").first()
    if not found.total_rows:
        raise ValueError("no training rows")
    if found.null_targets:
        raise ValueError(f"{found.null_targets} rows have no target")
    return found.total_rows


def prediction_input(features: DataFrame) -> DataFrame:
    """Features of the latest week, without the target."""
    latest = features.agg(F.max("week_start")).scalar()
    return features.filter(F.col("week_start") == latest).drop(TARGET)


def split(features: DataFrame, keys) -> tuple[DataFrame, DataFrame, DataFrame]:
    """80/10/10 by a digest of the keys as text: the same row lands in the same part on every run, in any engine. A null key reads as empty."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    part = F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int") % 10
    placed = features.withColumn("_part", part)
    train, check, test = placed.filter("_part < 8"), placed.filter("_part = 8"), placed.filter("_part = 9")
    return train.drop("_part"), check.drop("_part"), test.drop("_part")


def train(features: DataFrame, numeric, categorical=("category",), target: str = TARGET, rounds: int = 20) -> PipelineModel:
    """Gradient-boosted trees on the features."""
    codes = [f"{c}_code" for c in categorical]
    stages = [StringIndexer(inputCols=list(categorical), outputCols=codes, handleInvalid="keep")] if codes else []
    stages.append(VectorAssembler(inputCols=[*numeric, *codes], outputCol="features", handleInvalid="keep"))
    stages.append(GBTRegressor(labelCol=target, featuresCol="features", maxIter=rounds, maxDepth=4, seed=7))
    return Pipeline(stages=stages).fit(features)


#: The stumps' unit: thousandths of the target, so that all sums are whole numbers; and how much of a mean residual a stump takes.
UNITS, RATE = 1000, (3, 10)


@dataclass(frozen=True)
class Stumps:
    """A sum of one-split trees over binned features. ``ends`` holds the smallest and largest value of each feature in training."""

    numeric: tuple[str, ...]
    ends: tuple[tuple[float | None, float | None], ...]
    bins: int
    start: int
    splits: tuple[tuple[int, int, int, int], ...]  # feature, last bin of the left side, its value, that of the right side

    def bin(self, feature: int) -> Column:
        """Number of the bin of a value, of equal width; 0 for a null, and the outer bins beyond the ends."""
        low, high = self.ends[feature]
        if low is None or high <= low:
            return F.lit(0)
        x = F.col(self.numeric[feature]).cast("double")
        at = F.floor((x - F.lit(low)) * self.bins / (F.lit(high) - F.lit(low)))
        return F.coalesce(F.least(F.greatest(at, F.lit(0)), F.lit(self.bins - 1)), F.lit(0)).cast("int")

    def units(self, binned) -> Column:
        """The prediction in UNITS; ``binned`` gives the column that holds a feature's bin."""
        total = F.lit(self.start).cast("long")
        for feature, last, left, right in self.splits:
            total = total + F.when(binned(feature) <= last, F.lit(left)).otherwise(F.lit(right))
        return total

    def transform(self, df: DataFrame, alias: str = "prediction") -> DataFrame:
        return df.withColumn(alias, self.units(self.bin) / UNITS)


def train_stumps(features: DataFrame, numeric, target: str = TARGET, rounds: int = 20, bins: int = 16) -> Stumps:
    """Gradient boosting whose rounds are aggregates: residuals are summed per feature and bin, which combines before the shuffle, and the driver reads one best split.

    The best split gains most in squared error; ties go to the feature named first, then to the lower bin. Targets are rounded to thousandths and values to whole
    thousandths, downwards, so every sum is exact and the model doesn't depend on how rows are dealt out. Rows without target are left out; without rows the model says 0.
    """
    y = F.round(F.col(target).cast("double") * UNITS).cast("long")
    rows = features.filter(F.col(target).isNotNull()).select(y.alias("y"), *numeric)
    ends = [f(F.col(c).cast("double")) for c in numeric for f in (F.min, F.max)]
    found = rows.agg(F.floor(F.sum("y").cast("double") / F.count(F.lit(1))), *ends).first()
    model = Stumps(tuple(numeric), tuple(zip(found[1::2], found[2::2])), bins, int(found[0] or 0), ())
    stored = cut(rows.select("y", *[model.bin(i).alias(f"_b{i}") for i in range(len(numeric))]))
    for _ in range(rounds):
        residual = F.col("y") - model.units(lambda i: F.col(f"_b{i}"))
        cells = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"_b{i}").alias("k")) for i in range(len(numeric))]))
        sums = stored.select(cells.alias("c"), residual.alias("r")).groupBy("c.f", "c.k").agg(F.count(F.lit(1)).alias("n"), F.sum("r").alias("g"))
        best = _best_split(sums)
        if best is None:
            break
        model = replace(model, splits=(*model.splits, tuple(best)))
    return model


def _best_split(sums: DataFrame):
    """(feature, last bin of the left side, left value, right value) with the largest gain, from the sums of each feature's bins."""
    own = Window.partitionBy("f")
    upto = own.orderBy("k")
    n, g = F.col("n_left").cast("double"), F.col("g_left").cast("double")
    m, h = (F.col("n_all") - F.col("n_left")).cast("double"), (F.col("g_all") - F.col("g_left")).cast("double")
    totals = sums.select("f", "k", F.sum("n").over(upto).alias("n_left"), F.sum("g").over(upto).alias("g_left"), F.sum("n").over(own).alias("n_all"), F.sum("g").over(own).alias("g_all"))
    value = lambda total, count: F.floor(total * RATE[0] / (count * RATE[1]))
    sides = F.struct("f", "k", value(g, n).alias("left"), value(h, m).alias("right"))
    ranked = totals.filter("n_all > n_left").agg(F.max_by(sides, F.struct(g * g / n + h * h / m, -F.col("f"), -F.col("k"))).alias("best")).first()
    return ranked.best


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """RMSE, MAE, R squared, MAPE in percent (zero actuals left out) and RMSLE, in one pass."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    known = df.filter(a.isNotNull() & p.isNotNull())
    log_gap = F.log1p(F.greatest(p, F.lit(0.0))) - F.log1p(F.greatest(a, F.lit(0.0)))
    return known.agg(
        F.sqrt(F.avg(F.pow(p - a, 2))).alias("rmse"),
        F.avg(F.abs(p - a)).alias("mae"),
        (1 - F.try_divide(F.avg(F.pow(p - a, 2)), F.var_pop(a))).alias("r_squared"),
        (F.avg(F.abs(F.try_divide(p - a, a))) * 100).alias("mape"),
        F.sqrt(F.avg(F.pow(log_gap, 2))).alias("rmse_log"),
    )


def forecast_table(predictions: DataFrame, as_of: str) -> DataFrame:
    """Model output, whose prediction is a struct, as a plain table for the week after ``as_of``."""
    return predictions.select(
        "product_id", "product_name", "category", "list_price", "stock_quantity", "current_week_units_sold",
        F.round(F.col(f"predicted_{TARGET}.value"), 0).alias("predicted_units"),
        F.lit(as_of).cast("timestamp").alias("forecast_generated_at"),
        F.date_add(F.lit(as_of).cast("date"), 7).alias("forecast_for_week_starting"),
    ).orderBy(F.desc("predicted_units"), "product_id")


def forecast_by_category(predictions: DataFrame) -> DataFrame:
    sums = predictions.groupBy("category").agg(
        F.sum("current_units_sold").alias("current"), F.sum("predicted_next_week_units_sold").alias("predicted"),
        exact_avg("prediction_confidence", 6).alias("avg_confidence"), F.count("product_id").alias("products"),
    )
    growth = safe_divide(F.col("predicted") - F.col("current"), "current") * 100
    return sums.withColumn("growth_pct", half_up(growth, 1))
