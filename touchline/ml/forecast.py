"""Forecasters: position medians and boosted trees."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.ml import leafwise
from touchline.ml.blend import ML, median_target
from touchline.ml.contract import CATEGORICAL, NUMERIC, TARGET
from touchline.operators.order_stats import Want, order_statistics
from touchline.session import stored


class PositionMedian:
    """Past median target by position; the overall median where unknown."""

    def fit(self, df: DataFrame) -> "PositionMedianModel":
        half = {"median": Want(0.5)}
        by_position = order_statistics(df.where(F.col("position").isNotNull()), ["position"], TARGET, half)
        return PositionMedianModel(
            stored(by_position.select("position", F.col("median").alias("_own")), "position_medians"),
            median_target(df).withColumnRenamed("_fill", "_all"))


@dataclass
class PositionMedianModel:
    by_position: DataFrame
    overall: DataFrame

    def predict(self, df: DataFrame) -> DataFrame:
        return (
            df.join(self.by_position, "position", "left").crossJoin(F.broadcast(self.overall))
            .withColumn(ML, F.coalesce("_own", "_all")).drop("_own", "_all"))


@dataclass
class BoostedTrees:
    """Leaf-wise boosted trees on imputed numbers, missing flags and ordinals."""

    numeric: list[str] = field(default_factory=lambda: list(NUMERIC))
    categorical: list[str] = field(default_factory=lambda: list(CATEGORICAL))
    growth: leafwise.Growth = leafwise.Growth()
    key: str = "training_row_key"

    def fit(self, df: DataFrame) -> "BoostedTreesModel":
        # One value per feature reaches the driver.
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in self.numeric])
        middle = order_statistics(df.select(F.explode(pairs).alias("p")).select("p.*"), ["feature"], "value", {"median": Want(0.5)})
        fills = dict.fromkeys(self.numeric) | {r["feature"]: r["median"] for r in middle.collect()}
        fills |= df.agg(*[F.mode(F.col(c).cast("string"), True).alias(c) for c in self.categorical]).first().asDict()
        prepared = self._prepare(df, fills)
        codes = [c + "_code" for c in self.categorical]
        index = StringIndexer(inputCols=[c + "_text" for c in self.categorical], outputCols=codes,
                              handleInvalid="keep", stringOrderType="alphabetAsc").fit(prepared)
        inputs = [c + "_num" for c in self.numeric] + [c + "_gap" for c in self.numeric] + [c + "_ord" for c in self.categorical]
        ready = stored(self._ordinals(index.transform(prepared)).select(*inputs, F.col(TARGET).cast("double").alias("_target"), self.key), "boosting_rows")
        return BoostedTreesModel(self, fills, index, leafwise.fit(ready, inputs, "_target", self.key, self.growth))

    def _prepare(self, df: DataFrame, fills: dict) -> DataFrame:
        numeric = {}
        for c in self.numeric:
            value = F.col(c).cast("double")
            numeric[c + "_num"] = F.coalesce(value, F.lit(float(fills[c] if fills[c] is not None else 0.0)))
            numeric[c + "_gap"] = value.isNull().cast("double")
        text = {c + "_text": F.coalesce(F.col(c).cast("string"), F.lit(fills[c] or "")) for c in self.categorical}
        return df.withColumns({**numeric, **text})

    def _ordinals(self, df: DataFrame) -> DataFrame:
        # Plain arithmetic drops the category metadata: trees see ordered codes.
        return df.withColumns({c + "_ord": F.col(c + "_code") + F.lit(0.0) for c in self.categorical})


@dataclass
class BoostedTreesModel:
    spec: BoostedTrees
    fills: dict
    index: object
    model: leafwise.Forest

    def predict(self, df: DataFrame) -> DataFrame:
        ready = self.spec._ordinals(self.index.transform(self.spec._prepare(df, self.fills)))
        return self.model.predict(ready, "_p").select(*df.columns, F.greatest(F.col("_p"), F.lit(0.0)).alias(ML))
